"""Sources: extract catalog, workbook files (plain, packaged, broken), registry JSON, JDBC builders."""
import io
import json
import zipfile

import pytest
from pyspark.sql import types as T

from lakewright.sources.files import extract_catalog, read_table_file
from lakewright.sources.jdbc import JdbcSource, source_for
from lakewright.sources.workbooks import file_status, list_workbook_files, load_registry_json, read_workbooks

from conftest import SF001
from test_workbook import DOC


def test_extract_catalog(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/sales_57BDF416384B493EB6270775A72222E2.parquet")
    spark.range(2).write.csv(f"{root}/s1/Orders.csv", header=True)
    rows = sorted((r.schema, r.raw_name, r.clean_name, r.format) for r in extract_catalog(spark, root).collect())
    assert rows == [("Extract", "sales_57BDF416384B493EB6270775A72222E2", "sales", "parquet"),
                    ("s1", "Orders", "Orders", "csv")]


def test_read_table_file_unquotes(spark, tmp_path):
    p = str(tmp_path / "q.parquet")
    spark.sql('SELECT 1 AS `"a"`, 2 AS b').write.parquet(p)
    assert read_table_file(spark, p).columns == ["a", "b"]


def test_workbook_files(spark, tmp_path):
    (tmp_path / "plain.twb").write_text(DOC)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("inner/Book.TWB", DOC)
        zf.writestr("Data/Extracts/x.hyper", b"bin")
    (tmp_path / "Packed.TWBX").write_bytes(buf.getvalue())
    buf2 = io.BytesIO()
    with zipfile.ZipFile(buf2, "w") as zf:
        zf.writestr("readme.txt", "no workbook")
    (tmp_path / "nowb.twbx").write_bytes(buf2.getvalue())
    (tmp_path / "broken.twbx").write_bytes(b"not a zip")
    (tmp_path / "empty.twb").write_bytes(b"")
    (tmp_path / "other.txt").write_text("x")
    listing = {r.workbook: r.error for r in list_workbook_files(spark, str(tmp_path)).collect()}
    assert listing == {"plain": None, "Packed": None, "nowb": None, "broken": None}   # zero-length files unlisted
    assert file_status(spark, str(tmp_path / "empty.twb"))["error"] == "empty file"
    assert file_status(spark, str(tmp_path / "missing.twb"))["error"] == "file not found"
    assert file_status(spark, str(tmp_path / "plain.twb"))["length"] == len(DOC)
    wbs = {r.workbook: r for r in read_workbooks(spark, str(tmp_path)).collect()}
    assert bytes(wbs["plain"].content) == DOC.encode() and wbs["plain"].has_extract is False
    assert bytes(wbs["Packed"].content) == DOC.encode() and wbs["Packed"].has_extract is True
    assert wbs["nowb"].error.startswith("no .twb member") and wbs["broken"].error == "not a zip archive"
    assert "empty" not in wbs


def test_registry_json(spark, tmp_path):
    schema = T.StructType([T.StructField("data_mode", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType())),
                           T.StructField("refresh_count", T.LongType())])
    p = tmp_path / "reg.json"
    p.write_text(json.dumps({"wb1": {"data_mode": "live", "tables": ["A"], "refresh_count": 2},
                             "wb2": {"data_mode": "extracted", "tables": [], "refresh_count": 0}}))
    rows = {r.workbook_name: r.record.data_mode for r in load_registry_json(spark, str(p), schema).collect()}
    assert rows == {"wb1": "live", "wb2": "extracted"}
    (tmp_path / "bad.json").write_text("{not json")
    assert load_registry_json(spark, str(tmp_path / "bad.json"), schema).count() == 0
    assert load_registry_json(spark, str(tmp_path / "missing.json"), schema).count() == 0


def test_jdbc_builders():
    sf = source_for("snowflake", {"server": "acct1.example.com", "database": "DB", "schema": "PUBLIC", "warehouse": "WH",
                                  "username": "u"}, password="p")
    assert sf.url() == "jdbc:snowflake://acct1.snowflakecomputing.com/?db=DB&schema=PUBLIC&warehouse=WH"
    assert sf.table_ref('OR"DERS') == '"PUBLIC"."OR""DERS"'
    assert sf.options()["user"] == "u" and "TABLE_TYPE = 'BASE TABLE'" in sf.list_tables_query()
    az = source_for("sqlserver", {"server": "x.database.windows.net", "database": "D"})
    assert az.source_type == "azuresql" and ":1433;" in az.url() and "loginTimeout=30" in az.url()
    onprem = source_for("sqlserver", {"server": "db.corp", "database": "D"})
    assert onprem.url() == "jdbc:sqlserver://db.corp;databaseName=D;encrypt=true;trustServerCertificate=false"
    assert onprem.table_ref("dbo.T") == "dbo.T"
    dbx = source_for("databricks", {"server_hostname": "h", "http_path": "/p", "catalog": "c", "schema": "s"},
                     password="tok")
    assert dbx.table_ref("t") == "`c`.`s`.`t`" and dbx.options()["user"] == "token"
    assert JdbcSource("databricks", {"schema": "s"}).table_ref("t") == "`s`.`t`"
    with pytest.raises(ValueError):
        source_for("oracle", {})


def test_live_source_flow_lands_and_partitions(spark):
    """Live sources reach the flows through LiveSource (no database here: a stand-in
    JdbcSource returns test tables and records the read options it was given)."""
    from lakewright.plans.ingest import ingest
    from lakewright.sources.jdbc import LiveSource

    class StandIn(JdbcSource):
        calls = []

        def list_tables(self, spark):
            return spark.createDataFrame([("orders",), ("nation",)], "TABLE_NAME string")

        def read(self, spark, table, **kw):
            StandIn.calls.append((table, kw))
            return spark.read.parquet(f"{SF001}/{table}.parquet")

    src = LiveSource(spark, StandIn("sqlserver", {"server": "db.corp", "database": "D"}),
                     partitioning={"orders": {"partition_column": "o_orderkey", "num_partitions": 4}})
    from lakewright.session import scratch_path
    jvm = spark.sparkContext._jvm

    def landed():
        out = set()
        for t in ("orders", "nation"):
            path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "landing", t))
            fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if fs.exists(path):
                out |= {str(x.getPath()) for x in fs.listStatus(path)}
        return out

    before = landed()
    assert src.list_tables() == ["orders", "nation"]
    res = ingest(spark, src, "t_live", workbook="live_wb", declared={"o_orderkey": "integer"})
    assert res["status"] == "success"
    assert spark.table("t_live.orders").count() == 1500 and spark.table("t_live.nation").count() == 25
    assert ("orders", {"partition_column": "o_orderkey", "num_partitions": 4}) in StandIn.calls
    assert ("nation", {}) in StandIn.calls
    assert landed() <= before           # live tables were landed, and the landed copies are gone


def test_registry_json_round_trip(spark, tmp_path):
    """The control log's state exported as one JSON object reads back keyed by workbook."""
    from lakewright.plans.registry import ControlLog
    control = ControlLog(spark, "t_ctl_json", location=str(tmp_path / "ctl"))
    control.register("wb1", namespace="n1", tables=["A", "B"], data_mode="live")
    control.record_refresh("wb1", "success")
    control.register("wb2", namespace="n2", tables=[], data_mode="extracted")
    p = tmp_path / "export.json"
    p.write_text(control.export_json())
    schema = T.StructType([T.StructField("data_mode", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType())),
                           T.StructField("refresh_count", T.LongType())])
    rows = {r.workbook_name: (r.record.data_mode, list(r.record.tables), r.record.refresh_count)
            for r in load_registry_json(spark, str(p), schema).collect()}
    assert rows == {"wb1": ("live", ["A", "B"], 1), "wb2": ("extracted", [], 0)}
