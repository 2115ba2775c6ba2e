"""Structured Streaming: incremental refresh (M1) and notice de-duplication (M2)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright.plans.ingest import ingest
from lakewright.plans.registry import ControlLog
from lakewright.sources.catalog import FrameSource
from lakewright.streaming.notices import dedupe_notices, merged, refresh_named, start_notice_stream
from lakewright.streaming.refresh_stream import batches, merge_batches, retype, start_refresh_stream

SCHEMA = "id string, amount string, day string, note string"


@pytest.fixture
def stream(spark, tmp_path, request):
    landing = str(tmp_path / "landing")
    name = f"tgt_{abs(hash(request.node.name))}"
    state = {"n": 0}

    def add(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    def run(checkpoint="ck", **kw):
        start_refresh_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, "t_stream", name,
                             declared={"id": "integer", "amount": "real", "day": "date"}, checkpoint=str(tmp_path / checkpoint),
                             max_files_per_trigger=1, **kw).awaitTermination()
        return spark.table(f"t_stream.{name}")
    state.update(add=add, run=run, name=name)
    return state


def test_no_value_is_lost(spark, stream, tmp_path):
    control = ControlLog(spark, "t_ctl_stream", location=str(tmp_path / "ctl"))
    stream["add"](("1", "1.5", "2024-01-01", "2024-01-01"))
    t = stream["run"](control=control, workbook="w")
    assert dict(t.dtypes)["id"] == "bigint" and dict(t.dtypes)["day"] == "date" and dict(t.dtypes)["note"] == "string"
    stream["add"](("unknown", "x", "Jan 2, 2024", "text"), ("2.5", "nan", "soon", None), (None, None, None, "2024-01-02 10:30:00"))
    t = stream["run"](control=control, workbook="w")
    got = sorted(((r.id, r.amount, str(r.day), r.note, dict(r["__misfits"])) for r in t.collect()), key=str)
    assert got == sorted([(1, 1.5, "2024-01-01", "2024-01-01", {}), (None, None, "2024-01-02", "text", {"id": "unknown", "amount": "x"}),
                          (None, None, "None", None, {"id": "2.5", "day": "soon"}), (None, None, "None", "2024-01-02 10:30:00", {})], key=str)
    counts = [r.new_nulls for r in control.runs().orderBy("started_at").collect()]
    assert counts == [{"id": 0, "amount": 0, "day": 0}, {"id": 2, "amount": 1, "day": 1}]
    # the batch rules, over all rows, on demand
    retype(spark, "t_stream", stream["name"], "retyped", declared={"id": "real"}, sniff="none")
    again = spark.table("t_stream.retyped")
    assert again.columns == ["id", "amount", "day", "note"] and again.where("id = 2.5 AND day = 'soon'").count() == 1


def test_files_load_once_whatever_the_checkpoint(spark, stream):
    for i in range(3):
        stream["add"]((str(i), "1", "2024-01-01", "a"))
    assert stream["run"]().count() == 3
    assert stream["run"](checkpoint="lost").count() == 3
    stream["add"](("9", "1", "2024-01-01", "a"))
    assert stream["run"](checkpoint="new").count() == 4
    assert len(batches(spark, "t_stream", stream["name"])) == 4
    before = sorted(map(str, spark.table(f"t_stream.{stream['name']}").drop("__batch").collect()))
    merge_batches(spark, "t_stream", stream["name"])
    after = spark.table(f"t_stream.{stream['name']}")
    assert len(batches(spark, "t_stream", stream["name"])) == 1 and sorted(map(str, after.drop("__batch").collect())) == before
    assert stream["run"](checkpoint="third", max_batches=1).count() == 4


def test_retried_batch_replaces_itself(spark, stream, monkeypatch):
    """A batch that fails before it is visible leaves nothing and is loaded by the next run."""
    stream["add"](("1", "1", "2024-01-01", "a"))
    run = type(spark).sql

    def sql(self, text, *a, **kw):
        if "ADD PARTITION" in text:
            raise RuntimeError("lost")
        return run(self, text, *a, **kw)
    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(Exception, match="lost"):
        stream["run"]()
    monkeypatch.undo()
    assert stream["run"]().count() == 1


def test_notices_keep_every_named_table(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    batch = spark.createDataFrame([("a", ["x"], t(0)), ("a", ["y", "x"], t(1)), ("b", None, t(2)), ("b", ["x"], t(2))],
                                  "workbook_name string, tables array<string>, ts timestamp")
    got = {r.workbook_name: r.tables for r in merged(dedupe_notices(batch)).collect()}
    assert got == {"a": ["x", "y"], "b": None}
    landing = str(tmp_path / "notices")
    batch.write.parquet(landing)
    control = ControlLog(spark, "t_ctl_notice", location=str(tmp_path / "ctl"))
    sources = {}
    for wb in ("a", "b"):
        ingest(spark, FrameSource({n: spark.range(1) for n in ("x", "y", "z")}), f"t_notice_{wb}", workbook=wb, control=control)
        sources[wb] = FrameSource({n: spark.range(2) for n in ("x", "y", "z")})
    q = start_notice_stream(spark, spark.readStream.schema(batch.schema).parquet(landing), "t_stream", "notices",
                            on_batch=refresh_named(spark, control, sources), checkpoint=str(tmp_path / "nck"))
    q.awaitTermination()
    assert {r.workbook_name: r.tables for r in spark.table("t_stream.notices").collect()} == {"a": ["x", "y"], "b": None}
    sizes = {f"{wb}.{n}": spark.table(f"t_notice_{wb}.{n}").count() for wb in ("a", "b") for n in ("x", "y", "z")}
    assert sizes == {"a.x": 2, "a.y": 2, "a.z": 1, "b.x": 2, "b.y": 2, "b.z": 2}


def test_a_running_stream_merges_and_prunes(spark, stream):
    """Batches are merged as they come; the ledger names no batch that is gone, and files still load once."""
    from lakewright.streaming.refresh_stream import _BatchWriter
    for i in range(7):
        stream["add"]((str(i), "1", "2024-01-01", "a"))
    assert stream["run"](max_batches=3).count() == 7
    visible = batches(spark, "t_stream", stream["name"])
    assert len(visible) <= 3
    ledger = _BatchWriter(spark, "t_stream", stream["name"], {})._ledger(spark)
    assert ledger.select("file").distinct().count() == 7 and ledger.count() <= 2 * 7 + 3
    assert stream["run"](checkpoint="lost", max_batches=3).count() == 7


def test_a_ledger_that_cannot_be_read_fails_the_batch(spark, stream):
    from pathlib import Path

    from lakewright.streaming.refresh_stream import _BatchWriter
    stream["add"](("1", "1", "2024-01-01", "a"))
    assert stream["run"]().count() == 1
    path = Path(_BatchWriter(spark, "t_stream", stream["name"], {}).ledger(spark).current().removeprefix("file:"))
    for f in path.glob("part-*"):
        f.write_bytes(b"no parquet")
    for f in path.glob(".part-*.crc"):
        f.write_bytes(b"")
    stream["add"](("2", "1", "2024-01-01", "a"))
    with pytest.raises(Exception):
        stream["run"](checkpoint="lost")
    assert spark.table(f"t_stream.{stream['name']}").count() == 1


def test_another_checkpoint_keeps_old_notices(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    schema = "workbook_name string, tables array<string>, ts timestamp"
    for n, wb in enumerate("ab"):
        landing = str(tmp_path / f"n{n}")
        spark.createDataFrame([(wb, ["x"], t)], schema).write.parquet(landing)
        for _ in range(2):  # a restart from the checkpoint adds nothing
            start_notice_stream(spark, spark.readStream.schema(schema).parquet(landing), "t_stream", "kept_notices", checkpoint=str(tmp_path / f"ck{n}")).awaitTermination()
    assert sorted(r.workbook_name for r in spark.table("t_stream.kept_notices").collect()) == ["a", "b"]
