"""Workbook corpus extraction (L7) on the documented XML shape plus edge documents."""
import pytest

from lakewright.operators import workbook as W

DOC = """<workbook><datasources><datasource>
  <connection>
    <named-connections><named-connection>
      <connection class="snowflake" server="acct1.example.com" dbname="DB1" schema="PUBLIC" warehouse="WH1" username="user1"/>
    </named-connection></named-connections>
    <relation type="table" table="[PUBLIC].[ORDERS]"/>
    <relation type="table" table="[orders]"/>
    <relation type="table" table="[Fact Sales]"/>
    <relation type="table" table="[DB1.CUSTOMERS]"/>
    <relation type="table" table="[Returns]"/>
  </connection>
  <column name="[ORDER_ID]" datatype="integer"/>
  <column name="[REVENUE]" datatype="real"/>
  <column name="[REVENUE]" datatype="string"/>
  <column name="[__tableau_internal]" datatype="table"/>
  <column name="[NO_TYPE]"/>
  <object-graph><relationships>
   <relationship>
    <expression op="="><expression op="[CUST_ID]"/><expression op="[CUST_KEY (CUSTOMERS)]"/></expression>
    <first-end-point object-id="ORDERS_0123456789ABCDEF0123456789ABCDEF"/>
    <second-end-point object-id="CUSTOMERS_0123456789ABCDEF0123456789ABCDEF"/>
   </relationship>
   <relationship>
    <expression op="="><expression op="[CUST_ID]"/><expression op="[CUST_KEY (CUSTOMERS)]"/></expression>
    <first-end-point object-id="ORDERS_0123456789ABCDEF0123456789ABCDEF"/>
    <second-end-point object-id="CUSTOMERS_0123456789ABCDEF0123456789ABCDEF"/>
   </relationship>
   <relationship>
    <expression op="="><expression op="[A]"/></expression>
    <first-end-point object-id="X"/><second-end-point object-id="Y"/>
   </relationship>
  </relationships></object-graph>
</datasource></datasources></workbook>"""


def corpus(spark, docs):
    return spark.createDataFrame(list(docs.items()), "workbook string, xml string")


def conn_doc(*conns):
    inner = "".join(f"<named-connection><connection {c}/></named-connection>" for c in conns)
    return f"<workbook><named-connections>{inner}</named-connections></workbook>"


def test_columns_tables_relationships(spark):
    c = corpus(spark, {"wb": DOC})
    cols = {(r.column, r.declared_type, r.pos) for r in W.workbook_columns(c).collect()}
    assert cols == {("ORDER_ID", "integer", 0), ("REVENUE", "string", 1)}
    tabs = [(r.table, r.pos) for r in W.workbook_tables(c).orderBy("pos").collect()]
    assert tabs == [("ORDERS", 0), ("Returns", 4)]
    rels = [tuple(r)[1:] for r in W.workbook_relationships(c).collect()]
    assert rels == [("ORDERS", "CUST_ID", "CUSTOMERS", "CUST_KEY", 0)]


def test_connection_snowflake(spark):
    r = W.workbook_connections(corpus(spark, {"wb": DOC})).first()
    assert r.connection_class == "snowflake" and r.source_type == "snowflake" and r.error is None
    assert r.params == {"server": "acct1.example.com", "account": "acct1", "database": "DB1", "schema": "PUBLIC",
                        "warehouse": "WH1", "username": "user1"}


def test_connection_precedence_and_types(spark):
    docs = {
        "both": conn_doc('class="spark" server="s1"', 'class="sqlserver" server="db.corp" dbname="D" username="u"'),
        "azure": conn_doc('class="azure_sqldb" server="x.database.windows.net" dbname="D"'),
        "sql_first": conn_doc('class="azure_sqldb" server="x.database.windows.net"', 'class="sqlserver" server="onprem"'),
        "dbx": conn_doc('class="databricks" server="h" v-http-path="/p" database="cat" dbname="sch"'),
        "none": conn_doc('class="oracle" server="o"'),
    }
    got = {r.workbook: r for r in W.workbook_connections(corpus(spark, docs)).collect()}
    assert got["both"].connection_class == "sqlserver" and got["both"].source_type == "sqlserver"
    assert got["azure"].source_type == "azuresql" and got["azure"].params["is_azure"] == "true"
    assert got["sql_first"].params["server"] == "onprem"          # class precedence before document order
    assert got["dbx"].params == {"server_hostname": "h", "http_path": "/p", "catalog": "cat", "schema": "sch"}
    assert got["none"].source_type is None and got["none"].error == W.NO_CONNECTION_ERROR


def test_bad_documents_do_not_fail_the_job(spark):
    c = corpus(spark, {"bad": "<workbook><x", "empty": "", "null": None, "ok": DOC})
    errs = {r.workbook: r.error for r in W.parse_errors(c).collect()}
    assert errs == {"bad": "invalid XML", "empty": "empty document", "null": "no document"}
    assert W.workbook_columns(c).count() == 2
    meta = W.extract_metadata(c)
    assert set(meta) == {"parsed", "columns", "tables", "connections", "relationships", "errors"}
    assert W.declared_types_of(meta["columns"], "ok") == {"ORDER_ID": "integer", "REVENUE": "string"}


def test_documents_are_read_as_bytes(spark):
    """Byte order marks and declared encodings hold; a second root or trailing text is that document's error."""
    doc = '<workbook><column name="[Größe]" datatype="integer"/></workbook>'
    rows = {"utf8": doc.encode(), "mark": b"\xef\xbb\xbf" + doc.encode(), "utf16": doc.encode("utf-16"),
            "cp1252": ('<?xml version="1.0" encoding="cp1252"?>' + doc).encode("cp1252"),
            "two": doc.encode() + b"<workbook/>", "tail": doc.encode() + b" tail", "odd": b'<?xml version="1.0" encoding="nope"?><a/>',
            "bytes": b"\xff\x00\x80"}
    c = spark.createDataFrame([(k, bytearray(v)) for k, v in rows.items()], "workbook string, content binary")
    meta = W.extract_metadata(c)
    assert {r.workbook: r.column for r in meta["columns"].collect()} == dict.fromkeys(["utf8", "mark", "utf16", "cp1252"], "Größe")
    assert {r.workbook: r.error for r in meta["errors"].collect()} == dict.fromkeys(["two", "tail", "odd", "bytes"], "invalid XML")


def test_keys_joined_by_and(spark):
    pair = '<expression op="="><expression op="[{0}]"/><expression op="[{1}]"/></expression>'
    doc = ("<w><datasource><object-graph><relationships><relationship><expression op='AND'>" + pair.format("A", "B") + pair.format("C", "D")
           + "</expression><first-end-point object-id='X'/><second-end-point object-id='Y'/></relationship></relationships></object-graph></datasource></w>")
    got = [tuple(r)[1:] for r in W.workbook_relationships(corpus(spark, {"w": doc})).orderBy("pos").collect()]
    assert got == [("X", "A", "Y", "B", 0), ("X", "C", "Y", "D", 1)]


def test_documents_are_parsed_in_tasks_of_bounded_size(spark, monkeypatch):
    """A table of one small file still gives the workbook queries a task per so many documents, with every row."""
    from lakewright.suite import inputs, spark_side
    monkeypatch.setattr(inputs, "ROWS_A_TASK", 30, raising=False)
    corpus = spark_side._corpus(spark, "/root/testdata/sf0.001")
    plain = inputs.customer_workbooks(inputs.table(spark, "/root/testdata/sf0.001", "customer"))
    assert corpus.rdd.getNumPartitions() == -(-plain.count() // 30) > 1
    assert corpus.exceptAll(plain).count() == 0 and corpus.count() == plain.count()


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    """Files are written into a folder a task, and read by fewer tasks than Spark plans for small files; each is read once."""
    from lakewright.sources import workbooks
    from lakewright.suite import inputs, spark_side
    monkeypatch.setattr(inputs, "ROWS_A_TASK", 30, raising=False)
    monkeypatch.setattr(workbooks, "TASKS_A_CORE", 0, raising=False)
    seen = []
    monkeypatch.setattr(spark_side, "read_workbooks", lambda s, root: seen.append((root, workbooks.read_workbooks(s, root))) or seen[-1][1])
    got = spark_side.workbook_read(spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert got.count() == got.select("workbook").distinct().count() == n and got.where("has_document").count() > 0
    root, read = seen[0]
    folders = [p for p in __import__("os").listdir(root.removeprefix("file://")) if not p.startswith(".")]
    assert len(folders) == -(-n // 30) > 1
    assert read.rdd.getNumPartitions() == 1 and read.count() == n
    assert "binaryFile" not in got._jdf.queryExecution().optimizedPlan().toString() and "MapInArrow" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("most", [4, 7])
def test_driver_lists_few_files_at_once(spark, tmp_path, monkeypatch, most):
    """More files than the driver may list are read in groups: of folders, of files beside folders, of one large folder; each file once."""
    from pyspark.sql import DataFrameReader

    from lakewright.sources import workbooks
    names = [f"{d}/f{n}.twb" for d, k in (("a", 3), ("b/x", 2), ("b/y", 4), ("b [1]", 3), ("c", 9), (".", 5)) for n in range(k)] + ["p {q}*.twb", "b/other.txt"]
    for name in [*names, "_hidden/h.twb", "c/_h.twb"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    monkeypatch.setattr(workbooks, "FILES_AT_ONCE", most, raising=False)
    sizes, load = [], DataFrameReader.load

    def loaded(self, path=None, **options):
        out = load(self, path, **options)
        sizes.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(DataFrameReader, "load", loaded)
    rows = workbooks.read_workbooks(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.content).decode() for r in rows) == sorted(n for n in names if n.endswith(".twb"))
    assert len(sizes) > 1 and max(sizes) <= most
    sizes.clear()
    assert [bytes(r.content) for r in workbooks.read_workbooks(spark, str(tmp_path / "a" / "f1.twb")).collect()] == [b"a/f1.twb"]
