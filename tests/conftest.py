import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lamellar.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=str(shared / "warehouse"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
