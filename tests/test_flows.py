"""Ingest / refresh flows, staged overwrite, empty skip, append schema check, per-table isolation."""
import pytest
from pyspark.sql import functions as F

from lakewright.plans.ingest import ingest, select_tables, summarize
from lakewright.plans.refresh import refresh, refresh_all
from lakewright.plans.registry import ControlLog
from lakewright.sinks.tables import (clear_orphan_location, drop_tables, ensure_namespace, list_tables,
                                     namespace_location, write_table)
from lakewright.sources.catalog import DirectorySource, FrameSource

from conftest import SF001


class Broken(FrameSource):
    def read(self, table):
        if table == "bad":
            raise RuntimeError("cannot read bad")
        return super().read(table)


def test_select_tables():
    assert select_tables(["a", "B", "c"], None) == ["a", "B", "c"]
    assert select_tables(["a", "B", "c"], ["B", "b", "c"]) == ["B", "c"]
    with pytest.raises(ValueError):
        select_tables(["a"], ["A"])


def test_write_overwrite_schema_replace_and_empty(spark):
    ensure_namespace(spark, "t_sink")
    r1 = write_table(spark, spark.range(5).withColumn("x", F.lit(1)), "t_sink", "t")
    assert (r1["rows"], r1["columns"], r1["status"]) == (5, 2, "success")
    r2 = write_table(spark, spark.range(3), "t_sink", "t")
    assert spark.table("t_sink.t").columns == ["id"] and spark.table("t_sink.t").count() == 3
    r3 = write_table(spark, spark.range(0), "t_sink", "t")
    assert r3["status"] == "skipped_empty" and spark.table("t_sink.t").count() == 3
    assert list_tables(spark, "t_sink") == ["t"]
    # overwrite from a frame that reads the target itself (a new version folder makes this legal)
    r4 = write_table(spark, spark.table("t_sink.t").where("id > 0"), "t_sink", "t")
    assert r4["rows"] == 2 and spark.table("t_sink.t").count() == 2


def test_overwrite_swaps_version_folders(spark):
    from lakewright.sinks.tables import table_location, versions_root
    ensure_namespace(spark, "t_sink")
    write_table(spark, spark.range(4), "t_sink", "ver")
    first = table_location(spark, "t_sink", "ver")
    write_table(spark, spark.range(6), "t_sink", "ver")
    second = table_location(spark, "t_sink", "ver")
    assert first != second and spark.table("t_sink.ver").count() == 6
    root, fs = _fs(spark, versions_root(spark, "t_sink", "ver"))
    assert len(fs.listStatus(root)) == 2                     # the current version and the one before it
    reader = spark.table("t_sink.ver")                       # opened before the swap, finishes after it
    write_table(spark, spark.range(3).withColumn("p", F.col("id") % 2), "t_sink", "ver", partition_by=["p"])
    assert reader.count() == 6
    assert spark.table("t_sink.ver").count() == 3 and len(fs.listStatus(root)) == 2
    # an empty partitioned version keeps its schema
    write_table(spark, spark.range(0).withColumn("p", F.col("id") % 2), "t_sink", "ver", partition_by=["p"], truncate_on_empty=True)
    assert spark.table("t_sink.ver").count() == 0 and spark.table("t_sink.ver").columns == ["id", "p"]
    # a failed write leaves the table and no folder
    before = {str(s.getPath()) for s in fs.listStatus(root)}
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_table(spark, spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("x")), "t_sink", "ver")
    assert {str(s.getPath()) for s in fs.listStatus(root)} == before and spark.table("t_sink.ver").columns == ["id", "p"]
    drop_tables(spark, "t_sink", ["ver"])
    assert not fs.exists(root)
    # a version folder no table points at (e.g. from a session whose catalog is gone) is cleared
    spark.range(2).write.parquet(versions_root(spark, "t_sink", "ver") + "/stale")
    write_table(spark, spark.range(5), "t_sink", "ver")
    assert len(fs.listStatus(root)) == 1 and spark.table("t_sink.ver").count() == 5


@pytest.mark.parametrize("step", ["CREATE TABLE", "RENAME TO `t_sink`.`__old", "RENAME TO `t_sink`.`safe`"])
def test_failed_swap_keeps_the_old_table(spark, monkeypatch, step):
    from lakewright.sinks.tables import versions_root
    ensure_namespace(spark, "t_sink")
    write_table(spark, spark.range(4), "t_sink", "safe")
    root, fs = _fs(spark, versions_root(spark, "t_sink", "safe"))
    before = {str(s.getPath()) for s in fs.listStatus(root)}
    run, failed = type(spark).sql, []

    def sql(self, text, *a, **kw):
        if step in text and not failed:
            failed.append(text)
            raise RuntimeError("catalog down")
        return run(self, text, *a, **kw)
    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="catalog down"):
        write_table(spark, spark.range(2).withColumn("x", F.lit("new")), "t_sink", "safe")
    monkeypatch.undo()
    assert failed and spark.table("t_sink.safe").columns == ["id"] and spark.table("t_sink.safe").count() == 4
    assert {str(s.getPath()) for s in fs.listStatus(root)} == before
    assert not [t for t in list_tables(spark, "t_sink") if t.startswith("__")]


def test_append_after_versioned_overwrite(spark):
    ensure_namespace(spark, "t_sink")
    write_table(spark, spark.range(3), "t_sink", "ver_app")
    r = write_table(spark, spark.range(2), "t_sink", "ver_app", mode="append")
    assert r["status"] == "success" and spark.table("t_sink.ver_app").count() == 5
    write_table(spark, spark.range(4), "t_sink", "ver_app")           # overwrite again: appended rows go too
    assert spark.table("t_sink.ver_app").count() == 4


def _fs(spark, uri):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def test_append_requires_same_schema(spark):
    ensure_namespace(spark, "t_sink")
    write_table(spark, spark.range(2), "t_sink", "app", mode="append")
    write_table(spark, spark.range(2), "t_sink", "app", mode="append")
    assert spark.table("t_sink.app").count() == 4
    with pytest.raises(ValueError):
        write_table(spark, spark.range(2).withColumn("y", F.lit(1)), "t_sink", "app", mode="append")


def test_drop_and_orphans(spark):
    ensure_namespace(spark, "t_sink")
    write_table(spark, spark.range(1), "t_sink", "gone")
    out = drop_tables(spark, "t_sink", ["gone", "never_there"])
    assert [o["status"] for o in out] == ["dropped", "dropped"]
    spark.range(3).write.mode("overwrite").parquet(namespace_location(spark, "t_sink") + "/orphan")
    assert clear_orphan_location(spark, "t_sink", "orphan") is True
    assert write_table(spark, spark.range(2), "t_sink", "orphan")["rows"] == 2


def test_ingest_directory_source_with_isolation(spark, tmp_path):
    # directory of table files with raw extract names and a schema folder
    root = str(tmp_path / "extract")
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    cust.write.parquet(f"{root}/customers.csv_8DD21EEE7ABC4E3C930A78618FCDF78B.parquet")
    spark.read.parquet(f"{SF001}/nation.parquet").write.parquet(f"{root}/public/nation.parquet")
    spark.read.parquet(f"{SF001}/region.parquet").write.parquet(f"{root}/zz/customers.parquet")  # duplicate name
    src = DirectorySource(spark, root)
    assert sorted(src.list_tables()) == ["customers", "nation"]
    assert src.read("customers").count() == cust.count()        # first copy wins
    control = ControlLog(spark, "t_ctl_a")
    res = ingest(spark, src, "t_ing", workbook="wb1", declared={"c_acctbal": "real"}, control=control)
    assert res["status"] == "success" and res["summary"]["total_rows"] == cust.count() + 25
    assert control.get("wb1")["tables"] == ["customers", "nation"]

    broken = Broken({"ok": spark.range(3), "bad": spark.range(1)})
    res = ingest(spark, broken, "t_ing2", workbook="wb2")
    assert res["status"] == "partial"
    assert [(t["table_name"], t["status"]) for t in res["tables"]] == [("ok", "success"), ("bad", "failed")]
    assert summarize(res["tables"])["error_summary"].startswith("bad: cannot read bad")


def test_refresh_sync_drop_add_and_types(spark):
    control = ControlLog(spark, "t_ctl_b")
    s1 = FrameSource({"a": spark.createDataFrame([("1",), ("2",)], "v string"),
                      "b": spark.createDataFrame([("x",)], "w string")})
    ingest(spark, s1, "t_ref", workbook="wbr", declared={"v": "integer"}, control=control)
    assert spark.table("t_ref.a").schema["v"].dataType.simpleString() == "bigint"
    s2 = FrameSource({"A": spark.createDataFrame([("3",), ("4",), ("x",)], "v string"),
                      "c": spark.createDataFrame([("y",)], "w string")})
    res = refresh(spark, control, "wbr", s2)
    assert res["status"] == "success" and res["added"] == ["c"] and res["removed"] == ["b"]
    assert "b" not in list_tables(spark, "t_ref")
    a = spark.table("t_ref.a")
    assert a.schema["v"].dataType.simpleString() == "bigint" and a.count() == 3   # declared types persisted
    rec = control.get("wbr")
    assert rec["refresh_count"] == 1 and rec["last_refresh_status"] == "success" and sorted(rec["tables"]) == ["A", "c"]
    # zero tables at the source: refused
    res = refresh(spark, control, "wbr", FrameSource({}))
    assert res["status"] == "failed" and "a" in list_tables(spark, "t_ref")
    assert control.get("wbr")["refresh_count"] == 2
    out = refresh_all(spark, control, {"wbr": s2})
    assert [o["status"] for o in out] == ["success"]


def test_control_log_api(spark):
    control = ControlLog(spark, "t_ctl_c")
    control.register("w", secret_supplied=True, namespace="n", tables=["t"], enable_scheduled_refresh=True,
                     refresh_interval_minutes=15)
    control.record_refresh("w", "success")
    control.patch("w", refresh_interval_minutes=20)
    with pytest.raises(KeyError):
        control.patch("unknown", refresh_interval_minutes=20)
    rec = control.get("w")
    assert (rec["refresh_count"], rec["refresh_interval_minutes"], rec["has_secret"]) == (1, 20, True)
    st = control.status("w").first()
    assert st.has_stored_credentials is True and st.table_count == 1
    assert control.delete("w") is True and control.get("w") is None and control.delete("w") is False
    # a new session object over the same folder sees the same log
    assert ControlLog(spark, "t_ctl_c").events().count() == 4


def test_migrate_workbook_extracted(spark, tmp_path):
    import io
    import zipfile
    from lakewright.plans.ingest import migrate_workbook
    doc = """<workbook><datasources><datasource><connection>
      <relation type="table" table="[Extract].[orders]"/></connection>
      <column name="[o_totalprice]" datatype="real"/><column name="[o_custkey]" datatype="integer"/>
      </datasource></datasources></workbook>"""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("Book.twb", doc)
        zf.writestr("Data/Extracts/orders.hyper", b"x")
    wbdir = tmp_path / "wb"
    wbdir.mkdir()
    (wbdir / "Sales.twbx").write_bytes(buf.getvalue())
    ext = str(tmp_path / "extract")
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    o.select(*[F.col(c).cast("string") for c in o.columns]).write.parquet(f"{ext}/orders.parquet")
    control = ControlLog(spark, "t_ctl_m")
    res = migrate_workbook(spark, str(wbdir), "t_mig", extract_source=DirectorySource(spark, ext), control=control)
    assert res["status"] == "success" and res["workbook_name"] == "Sales"
    t = spark.table("t_mig.orders")
    assert t.schema["o_custkey"].dataType.simpleString() == "bigint"
    assert t.schema["o_totalprice"].dataType.simpleString() == "double"
    assert t.schema["o_orderdate"].dataType.simpleString() == "date"          # sniffed text
    rec = control.get("Sales")
    assert rec["data_mode"] == "extracted" and rec["declared_types"] == {"o_totalprice": "real", "o_custkey": "integer"}


def test_parallel_load(spark):
    src = FrameSource({f"t{i}": spark.range(i + 1).withColumn("v", F.col("id").cast("string")) for i in range(4)})
    res = ingest(spark, src, "t_par", workbook="par", parallel=3, declared={"v": "integer"})
    assert res["status"] == "success" and [t["rows"] for t in res["tables"]] == [1, 2, 3, 4]


def test_control_log_compaction(spark, tmp_path):
    control = ControlLog(spark, "t_ctl_k", location=str(tmp_path / "ctl"))
    control.register("w", namespace="n", tables=["a"])
    control.record_refresh("w", "failed", "x")
    control.register("w", namespace="n", tables=["a", "b"])       # earlier events no longer matter
    control.record_refresh("w", "success")
    control.register("gone", namespace="n")
    control.delete("gone")
    control.log_runs([{"run_id": "r", "workbook_name": "w", "table_name": "a", "pos": 0, "rows": 1,
                       "columns": 1, "status": "success"}])
    before = {r.workbook_name: (r.refresh_count, r.last_refresh_status, tuple(r.tables))
              for r in control.state().collect()}
    out = control.compact()
    assert out == {"events_before": 6, "events_after": 2}           # one snapshot a workbook, the deleted one too
    after = {r.workbook_name: (r.refresh_count, r.last_refresh_status, tuple(r.tables))
             for r in control.state().collect()}
    assert before == after == {"w": (1, "success", ("a", "b"))}
    assert control.runs().count() == 1
    assert control.compact_if_many(10) is None
    control.record_refresh("w", "success")                          # appends continue on the new version
    assert control.get("w")["refresh_count"] == 2
    assert sorted(p.name for p in (tmp_path / "ctl" / "control_log_events").iterdir()) == ["v00001"]
    before = control.log.files()
    assert before > 1 and control.compact_if_many(before - 1)["events_after"] == 2 and control.log.files() <= before
    assert control.get("w")["refresh_count"] == 2


def test_migrate_workbook_live(spark, tmp_path, monkeypatch):
    """Live mode end to end: connection from the workbook -> LiveSource -> landed, typed tables.
    No database may run here, so source_for returns a stand-in JdbcSource over test tables."""
    import lakewright.sources.jdbc as J
    from lakewright.plans.ingest import migrate_workbook

    class StandIn(J.JdbcSource):
        alive = True

        def probe(self, spark):
            if not self.alive:
                raise RuntimeError("refused")
            return True

        def list_tables(self, spark):
            return spark.createDataFrame([("orders",), ("nation",), ("region",)], "TABLE_NAME string")

        def read(self, spark, table, **kw):
            return spark.read.parquet(f"{SF001}/{table}.parquet")

    made = []

    def fake_source_for(source_type, params, user=None, password=None, **extra):
        made.append((source_type, params.get("server"), user, password))
        return StandIn(source_type, params, user=user, password=password)

    monkeypatch.setattr(J, "source_for", fake_source_for)
    doc = """<workbook><datasources><datasource><connection><named-connections><named-connection>
      <connection class="sqlserver" server="db.corp.example.com" dbname="Sales" username="u1"/>
      </named-connection></named-connections>
      <relation type="table" table="[dbo].[orders]"/><relation type="table" table="[nation]"/></connection>
      <column name="[o_custkey]" datatype="integer"/></datasource></datasources></workbook>"""
    wbdir = tmp_path / "wb"
    wbdir.mkdir()
    (wbdir / "Live.twb").write_text(doc)
    control = ControlLog(spark, "t_ctl_live", location=str(tmp_path / "ctl"))
    res = migrate_workbook(spark, str(wbdir), "t_mig_live", credentials={"user": "u1", "password": "pw"},
                           control=control)
    assert res["status"] == "success" and [t["table_name"] for t in res["tables"]] == ["orders", "nation"]
    assert made == [("sqlserver", "db.corp.example.com", "u1", "pw")]
    assert spark.table("t_mig_live.orders").count() == 1500
    rec = control.get("Live")
    assert rec["data_mode"] == "live" and rec["source_type"] == "sqlserver" and rec["has_secret"]
    assert rec["table_filter"] is None and rec["tables"] == ["orders", "nation"]
    # a filter that names nothing is an error, not everything
    with pytest.raises(ValueError, match="none of the requested"):
        migrate_workbook(spark, str(wbdir), "t_mig_none", tables=["NOPE"], control=control)
    monkeypatch.setattr(StandIn, "alive", False)
    with pytest.raises(ValueError, match="does not answer"):
        migrate_workbook(spark, str(wbdir), "t_mig_none", control=control)
    assert not spark.catalog.databaseExists("t_mig_none")
    # refreshed by name alone, from the stored record: a table new at the source is loaded
    res = refresh(spark, control, "Live", credentials={"password": "pw2"})
    assert made[-1][3] == "pw2" and res["added"] == ["region"] and spark.table("t_mig_live.region").count() == 5
    assert sorted(control.get("Live")["tables"]) == ["nation", "orders", "region"]


def test_refresh_replays_types_and_filter(spark, tmp_path):
    """Per-table types and sniffing are applied again; a user's filter also holds for tables new at the source."""
    rows = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02")], "a string, d string")
    control = ControlLog(spark, "t_ctl_replay", location=str(tmp_path / "ctl"))
    ingest(spark, FrameSource({"t": rows, "u": rows}), "t_replay", workbook="w", declared={"t": {"a": "integer"}}, sniff="none",
           tables=["t", "v"], control=control)
    types = dict(spark.table("t_replay.t").dtypes)
    res = refresh(spark, control, "w", FrameSource({"t": rows, "u": rows, "v": rows}))
    assert dict(spark.table("t_replay.t").dtypes) == types == {"a": "bigint", "d": "string"}
    assert res["added"] == ["v"] and dict(spark.table("t_replay.v").dtypes) == {"a": "string", "d": "string"}
    assert "u" not in [t.name for t in spark.catalog.listTables("t_replay")]
    # failed tables are not registered; an error of the flow itself leaves an event
    class Broken(FrameSource):
        def read(self, table):
            raise RuntimeError("gone")
    ingest(spark, Broken({"x": rows}), "t_replay_b", workbook="b", control=control)
    assert control.get("b")["tables"] == []
    with pytest.raises(ValueError, match="names no source"):
        refresh(spark, control, "w")
    assert control.get("w")["last_refresh_status"] == "failed"


def test_schedules_are_checked_where_they_enter(spark, tmp_path):
    import datetime

    from lakewright.plans.refresh import refresh_due
    control = ControlLog(spark, "t_ctl_sched", location=str(tmp_path / "ctl"))
    src = FrameSource({"t": spark.range(3)})
    with pytest.raises(ValueError, match="at least 5"):
        control.register("w", enable_scheduled_refresh=True, refresh_interval_minutes=1)
    with pytest.raises(ValueError, match="required"):
        ingest(spark, src, "t_sched", workbook="w", control=control, register={"enable_scheduled_refresh": True})
    ingest(spark, src, "t_sched", workbook="w", control=control)
    with pytest.raises(ValueError, match="required"):
        control.patch("w", enable_scheduled_refresh=True)
    control.patch("w", enable_scheduled_refresh=True, refresh_interval_minutes=5)
    now = datetime.datetime.now(datetime.timezone.utc)
    assert refresh_due(spark, control, now, sources={"w": src}) == []
    out = refresh_due(spark, control, now + datetime.timedelta(minutes=7), sources={"w": src})
    assert [r["status"] for r in out] == ["success"]
    out = refresh_due(spark, control, now + datetime.timedelta(minutes=60), sources={"w": src})
    assert [r["status"] for r in out] == ["missed"]
