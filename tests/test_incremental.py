"""Fingerprints, change-only refresh, keyed upsert and the folded control log."""
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.control import fold, registry_state
from lakewright.operators.fingerprint import partition_changes, partition_prints, snapshot_changes, table_print
from lakewright.plans.incremental import partition_columns, upsert
from lakewright.plans.ingest import ingest, pinned
from lakewright.plans.refresh import refresh
from lakewright.plans.registry import PATCH_ATTRS, REGISTER_ATTRS, ControlLog
from lakewright.sinks.tables import drop_tables, ensure_namespace, write_table
from lakewright.sources.catalog import FrameSource


def test_fingerprint_depends_on_rows_alone(spark):
    rows = [(i, None if i % 7 == 0 else f"v{i % 5}", float(i), {"b": i, "a": 1}, [i, None]) for i in range(500)]
    schema = "i long, s string, d double, m map<string,int>, a array<int>"
    df = spark.createDataFrame(rows, schema)
    same = spark.createDataFrame(random.Random(1).sample([(*r[:3], {"a": 1, "b": r[0]}, r[4]) for r in rows], 500), schema).repartition(7)
    assert table_print(df) == table_print(same)
    seen = {table_print(df)}
    for other in (rows[:-1], rows + rows[:1], [(*rows[0][:3], None, rows[0][4])] + rows[1:], [(0, None, 0.0, {"b": 0, "a": 1}, [None, 0])] + rows[1:]):
        seen.add(table_print(spark.createDataFrame(other, schema)))
    assert len(seen) == 5
    assert table_print(df.limit(0)) == "0:0:0:0:0"
    two = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert table_print(two.where("a IS NULL")) != table_print(two.where("b IS NULL"))


def test_partition_changes(spark):
    def prints(rows):
        return partition_prints(spark.createDataFrame(rows, "p string, q int, v int"), ["p", "q"])
    a = prints([("x", 1, 1), ("x", 1, 2), ("y", 1, 1), (None, 2, 5), ("z", None, 0)])
    b = prints([("x", 1, 2), ("x", 1, 1), ("y", 1, 7), (None, 2, 5), ("w", 1, 1)])
    got = {(r.p, r.q): r.change for r in partition_changes(a, b, ["p", "q"]).collect()}
    assert got == {("x", 1): "kept", ("y", 1): "changed", (None, 2): "kept", ("z", None): "removed", ("w", 1): "added"}


def files(spark, name, by):
    rows = spark.table(name).select(by, F.input_file_name().alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault(r[0], set()).add(r.f)
    return out


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("p", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, name):
    return sorted(((r.k, r.v, r.p) for r in spark.table(name).select("k", "v", "p").collect()), key=str)


def test_change_only_refresh(spark, tmp_path):
    control = ControlLog(spark, "t_inc_ctl", location=str(tmp_path / "ctl"))
    rows = [(i, f"v{i}", [None, "a", "b c", "d'e"][i % 4]) for i in range(40)]
    plain = [(i, "1", None) for i in range(5)]
    ingest(spark, FrameSource({"t": frame(spark, rows), "plain": frame(spark, plain)}), "t_inc", workbook="w", control=control,
           declared={"plain": {"v": "integer"}}, partition_by={"t": ["p"]}, track_changes=True)
    assert partition_columns(spark, "t_inc", "t") == ["p"] and partition_columns(spark, "t_inc", "plain") == []
    before, plain_files = files(spark, "t_inc.t", "p"), spark.table("t_inc.plain").inputFiles()
    res = refresh(spark, control, "w", FrameSource({"t": frame(spark, rows[::-1]), "plain": frame(spark, plain[::-1])}))
    assert [r["status"] for r in res["tables"]] == ["unchanged"] * 2 and res["summary"]["total_rows"] == 45
    assert files(spark, "t_inc.t", "p") == before and spark.table("t_inc.plain").inputFiles() == plain_files
    # one partition changes, one goes, one comes, the null one stays
    new = [(k, "changed" if p == "a" else v, p) for k, v, p in rows if p != "d'e"] + [(99, "new", "x")]
    res = refresh(spark, control, "w", FrameSource({"t": frame(spark, new), "plain": frame(spark, plain)}))
    t = next(r for r in res["tables"] if r["table_name"] == "t")
    assert (t["status"], t["partitions_written"], t["partitions_kept"], t["partitions_dropped"]) == ("success", 2, 2, 1)
    assert state(spark, "t_inc.t") == sorted(new, key=str)
    after = files(spark, "t_inc.t", "p")
    assert after[None] == before[None] and after["b c"] == before["b c"] and after["a"] != before["a"] and set(after) == {None, "a", "b c", "x"}
    # other columns: the whole table is written
    wider = frame(spark, new).withColumn("extra", F.lit(1))
    res = refresh(spark, control, "w", FrameSource({"t": wider, "plain": frame(spark, plain)}))
    assert res["status"] == "success" and spark.table("t_inc.t").columns == ["k", "v", "extra", "p"]
    assert refresh(spark, control, "w", FrameSource({"t": wider, "plain": frame(spark, plain)}))["tables"][0]["status"] == "unchanged"
    # a failed run leaves no fingerprint: the next one writes
    class Broken(FrameSource):
        def read(self, table):
            raise RuntimeError("gone")
    refresh(spark, control, "w", Broken({"t": wider, "plain": frame(spark, plain)}))
    assert {r["status"] for r in refresh(spark, control, "w", FrameSource({"t": wider, "plain": frame(spark, plain)}))["tables"]} == {"success"}
    # a dropped target is written again although the source is the same
    drop_tables(spark, "t_inc", ["plain"])
    res = refresh(spark, control, "w", FrameSource({"t": wider, "plain": frame(spark, plain)}))
    assert {r["table_name"]: r["status"] for r in res["tables"]} == {"t": "unchanged", "plain": "success"}


def test_pinned_sources_are_not_copied(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    assert pinned(df) and pinned(df.where("id > 1").select((F.col("id") + 1).alias("x"))) and pinned(df.unionByName(df))
    assert not pinned(spark.range(5)) and not pinned(df.withColumn("r", F.rand())) and not pinned(df.groupBy("id").count()) and not pinned(df.join(df, "id"))


@pytest.mark.parametrize("by", [["p"], None])
def test_upsert(spark, by):
    ensure_namespace(spark, "t_ups")
    drop_tables(spark, "t_ups", ["t"])
    rows = [(i, f"v{i}", f"p{i % 4}") for i in range(40)] + [(None, "nokey", "p0"), (50, "only", "lone"), (51, "np", None)]
    write_table(spark, frame(spark, rows), "t_ups", "t", partition_by=by)
    before = files(spark, "t_ups.t", "p")
    schema = "k long, v string, p string, at int, gone boolean"
    changes = [(0, "old", "p0", 1, False), (0, "new", "p0", 2, False), (1, None, None, 1, True), (100, "ins", "p9", 1, None), (5, "moved", "p2", 1, False),
               (50, None, None, 1, True), (777, "never", "p1", 1, True), (None, "nokey2", "p0", 1, False)]
    out = upsert(spark, spark.createDataFrame(changes, schema), "t_ups", "t", ["k"], order="at", deleted="gone")
    want = [r for r in rows if r[0] not in (0, 1, 5, 50, None)] + [(0, "new", "p0"), (100, "ins", "p9"), (5, "moved", "p2"), (None, "nokey2", "p0")]
    assert state(spark, "t_ups.t") == sorted(want, key=str)
    assert (out["inserted"], out["updated"], out["deleted"]) == (1, 3, 2)
    after = files(spark, "t_ups.t", "p")
    if by:
        assert out["partitions_written"] == 4 and out["partitions_dropped"] == 1 and "lone" not in after
        assert after["p3"] == before["p3"] and after[None] == before[None] and after["p1"] != before["p1"]
    again = upsert(spark, spark.createDataFrame([(777, None, None, 1, True)], schema), "t_ups", "t", ["k"], order="at", deleted="gone")
    assert (again["inserted"], again["updated"], again["deleted"]) == (0, 0, 0) and files(spark, "t_ups.t", "p") == after
    with pytest.raises(ValueError, match="order column"):
        upsert(spark, frame(spark, [(1, "a", "p1"), (1, "b", "p1")]), "t_ups", "t", ["k"])
    with pytest.raises(ValueError, match="schema"):
        upsert(spark, spark.range(1).withColumnRenamed("id", "k"), "t_ups", "t", ["k"])


def test_snapshot_changes_lead_to_the_next_snapshot(spark):
    a = frame(spark, [(1, "a", "p"), (2, None, "p"), (3, "c", None), (None, "n", "p")])
    b = frame(spark, [(1, "a", "p"), (2, "b", "p"), (4, "d", "q"), (None, "m", "p")])
    got = {(r.k, r.v, r.p, r.change) for r in snapshot_changes(a, b, ["k"]).collect()}
    assert got == {(2, "b", "p", "update"), (3, None, None, "delete"), (4, "d", "q", "insert"), (None, "m", "p", "update")}


def test_fold_at_any_point_leaves_the_state(spark):
    rng = random.Random(3)
    schema = "workbook_name string, seq long, op string, ts timestamp, tables array<string>, enable_scheduled_refresh boolean, refresh_interval_minutes int, status string, error string"
    events = []
    import datetime as dt
    for n in range(300):
        op = rng.choice(["register", "refresh", "refresh", "refresh", "patch", "delete"])
        events.append((f"w{rng.randint(0, 9) if rng.random() < 0.6 else 0}", n, op, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n),
                       [f"t{n}"] if op == "register" or op == "patch" and rng.random() < .5 else None, rng.choice([True, False, None]) if op in ("register", "patch") else None,
                       rng.randint(5, 60) if op in ("register", "patch") and rng.random() < .7 else None, rng.choice(["success", "failed"]) if op == "refresh" else None, None))
    log = spark.createDataFrame(events, schema).cache()
    attrs, patches = ["tables", "enable_scheduled_refresh", "refresh_interval_minutes"], ["enable_scheduled_refresh", "refresh_interval_minutes"]

    def seen(frame, deleted):
        return sorted(map(str, registry_state(frame, attrs, patches, include_deleted=deleted).collect()))
    for cuts in ([0], [120], [40, 41, 250], [299]):
        folded = log.limit(0)
        low = -1
        for c in cuts:
            folded = fold(folded.unionByName(log.where(F.col("seq").between(low + 1, c)), allowMissingColumns=True), attrs, patches)
            low = c
            assert folded.count() <= 10
        rest = folded.unionByName(log.where(F.col("seq") > low), allowMissingColumns=True)
        assert seen(rest, False) == seen(log, False) and seen(rest, True) == seen(log, True)


def test_log_size_follows_workbooks(spark, tmp_path):
    control = ControlLog(spark, "t_fold_ctl", location=str(tmp_path / "ctl"))
    for w in ("a", "b"):
        control.register(w, namespace="n", tables=["t"], partition_by={"t": ["p"]}, track_changes=True)
    for n in range(7):
        control.record_refresh("a", "success" if n % 2 else "failed", None if n % 2 else "x")
    control.patch("b", tables=["t", "u"])
    before = {r.workbook_name: r for r in control.state().collect()}
    assert control.compact() == {"events_before": 10, "events_after": 2}
    assert {r.workbook_name: r for r in control.state().collect()} == before
    control.record_refresh("a", "success")
    assert control.get("a")["refresh_count"] == 8 and control.get("b")["partition_by"] == {"t": ["p"]}
    control.delete("b")
    assert control.compact()["events_after"] == 2 and control.get("b") is None
    control.register("b", namespace="n2")
    assert control.get("b")["namespace"] == "n2" and control.get("b")["refresh_count"] == 0
    assert set(REGISTER_ATTRS) <= set(control.get("a")) and set(PATCH_ATTRS) <= set(REGISTER_ATTRS)
    control.write_json(str(tmp_path / "json"))
    assert {r.workbook_name for r in spark.read.json(str(tmp_path / "json")).collect()} == {"a", "b"}


def test_equal_rows_of_the_refresh_come_in_bounded_tasks(spark, monkeypatch):
    """The refresh query's second source is spread over tasks by its size, not over a fixed number of them, and has every row."""
    from lakewright.suite import spark_side

    class Seen(Exception):
        pass

    def seen(spark, control, workbook, source):
        df = source.tables["lineitem"]
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString(), pinned(df), df.count())
    monkeypatch.setattr(spark_side, "refresh", seen)
    with pytest.raises(Seen) as found:
        spark_side.change_only_refresh(spark, "/root/testdata/sf0.001")
    plan, kept, rows = found.value.args
    assert plan.startswith("RebalancePartitions") and not kept
    assert rows == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("year(l_shipdate) <> 1998").count()
