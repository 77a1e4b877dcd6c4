"""Physical plans: what is read, how often data is exchanged, and that no Python slips in."""

import re

import pytest

from conftest import SF
from lamellar.plans import QUERIES

NATIVE = sorted(set(QUERIES) - {"block_decode", "block_voxels", "chunk_downsample", "block_info", "segmentation_encode", "lpt_tasks", "downres_plan", "stream_windows", "stream_progress", "stream_stalled", "stream_unfinished", "encoded_voxels", "palette_downsample"} - {n for n, f in QUERIES.items() if f.__module__.endswith("source_queries")})


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name,columns", [("morton_code", 4), ("labels_by_shard", 4), ("json_extract", 2), ("ls_1var", 4)])
def test_scans_are_pruned(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, SF)))
    assert schemas and all(s.count(":") <= columns for s in schemas)


@pytest.mark.parametrize("name,most", [("morton_code", 0), ("clip_volume", 1), ("label_counts_per_chunk", 2), ("mode_downsample", 3), ("shard_contents", 4), ("bytes_per_chunk", 1)])
def test_exchanges(spark, name, most):
    assert len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan(QUERIES[name](spark, SF)))) <= most


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan(spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey = 5"))
    assert re.search(r"PushedFilters: \[[^\]]*s_suppkey|DataFilters: \[[^\]]*s_suppkey", plan(QUERIES["label_mapping"](spark, SF)))
