import datetime as dt
import json

from pyspark.sql import functions as F

from lamellar.streaming import progress as p


def lines():
    t0 = dt.datetime(2024, 1, 1)
    out = []
    for k in range(60):
        shard, done = f"s{k % 7}", k in (40, 41)
        e = {"event": "shard_complete" if done else "progress", "ts": (t0 + dt.timedelta(seconds=30 * k)).isoformat(), "scale": 0, "shard": shard, "chunks_written": k, "chunks_failed": 0, "total": 100, "elapsed_s": 1.0, "memory_gib": k / 10}
        out.append(f"INFO worker: {json.dumps(e)}")
    return [*out, "no event here", "{broken"]


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = lines()
    for k in range(3):
        (tmp_path / "in" / f"{k}.log").write_text("\n".join(rows[k::3]) + "\n")
    events = p.read_events(spark, str(tmp_path / "in"), files_per_trigger=1)
    q = p.to_table(p.progress(events), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {r.shard: r for r in p.read_table(spark, str(tmp_path / "out")).collect()}
    assert set(got) == {f"s{k}" for k in range(7)}
    assert got["s5"].done and got["s5"].chunks_written == 40 and got["s6"].done and got["s6"].chunks_written == 41
    assert not got["s0"].done and got["s0"].chunks_written == 56
    w = p.to_table(p.windowed(events), str(tmp_path / "w"), str(tmp_path / "cpw"))
    w.awaitTermination(120)
    assert p.read_table(spark, str(tmp_path / "w")).agg(F.sum("events")).head()[0] == 60
    assert p.wait(q, lambda: True)
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["version=1", "version=2"]  # older versions go


def test_repeats_go(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(lines() * 2) + "\n")
    d = p.deduplicated(p.read_events(spark, str(tmp_path / "in")), ["shard", "chunks_written"])
    q = p.to_table(d, str(tmp_path / "out"), str(tmp_path / "cp"), mode="append")
    q.awaitTermination(120)
    assert p.read_table(spark, str(tmp_path / "out")).count() == 60


T0 = dt.datetime(2024, 1, 1)


def arriving(spark, folder, batches, schema):
    """A stream of one file, and so one micro-batch, per list of rows."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / f"{k}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*"))


def finish(spark, stream, at):
    p.to_table(stream, str(at / "table"), str(at / "checkpoint"), "append").awaitTermination(120)
    return p.read_table(spark, str(at / "table"))


def test_silent_shards_are_told(spark, tmp_path):
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    row = lambda shard, m, n, event="progress": (event, minutes(m), 0, shard, n, 100)
    schema = "event string, ts timestamp, scale int, shard string, chunks_written long, total long"
    first = [row("silent", 0, 1), row("silent", 20, 2), row("done", 0, 5), row("done", 30, 100, "shard_complete"), row("woken", 0, 3), (None, minutes(1), 0, None, None, None)]
    second = [row("woken", 100, 4), row("busy", 100, 1), row("busy", 140, 2)]
    third = [row("busy", 190, 3), row("clock", 220, 1)]
    got = finish(spark, p.stalled(arriving(spark, tmp_path / "in", [first, second, third], schema), "1 hour", "10 minutes"), tmp_path)
    rows = sorted((str(r.shard), r.since, r.events, r.chunks_written) for r in got.collect())
    assert rows == [("None", minutes(1), 1, None), ("silent", minutes(20), 2, 2), ("woken", minutes(0), 1, 3), ("woken", minutes(100), 1, 4)]


def test_starts_without_an_end_are_told(spark, tmp_path):
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    schema = "kind string, run string, ts timestamp"
    first = [("start", "a", minutes(0)), ("start", "lost", minutes(1)), ("start", "late", minutes(2)), ("start", None, minutes(3)), ("end", "a", minutes(40)), ("end", "nobody", minutes(4)), ("end", None, minutes(4))]
    second = [("end", "late", minutes(63)), ("start", "open", minutes(100)), ("end", "x", minutes(120))]
    stream = arriving(spark, tmp_path / "in", [first, second, [("start", "y", minutes(130)), ("end", "y", minutes(131))]], schema)
    got = finish(spark, p.finished(stream.where("kind = 'start'"), stream.where("kind = 'end'"), ["run"], "1 hour", "10 minutes"), tmp_path)
    assert sorted((str(r.run), r.ts, r.end_ts) for r in got.collect() if r.run not in ("y",)) == [("None", minutes(3), None), ("a", minutes(0), minutes(40)), ("late", minutes(2), None), ("lost", minutes(1), None)]
    assert [(r.ts, r.end_ts) for r in got.where("run = 'y'").collect()] == [(minutes(130), minutes(131))]
