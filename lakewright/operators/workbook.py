"""Workbook corpus -> metadata tables (L7: A10, J35, J36, C3-C5, E2, G2-G4).

Input: a DataFrame with ``workbook`` and ``content`` bytes (see ``sources.workbooks``) or ``xml`` text.
Output: four tables - columns, tables, connections, relationships - plus the
documents that could not be parsed. Each document is parsed once, from its bytes, where it lives
(one row, one task); nothing is gathered per corpus. The tables are exploded from the parsed arrays.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import names as N
from lakewright.operators.dedupe import first_wins, first_wins_casefold
from lakewright.session import scratch_path

# Workbook XML names, filters and connection classes.
INTERNAL_COLUMN_PREFIX = "[__tableau"
TABLE_DATATYPE = "table"
# Connection classes in precedence order; each family maps to one source type.
CONNECTION_CLASSES = ["snowflake", "sqlserver", "azure_sqldb", "databricks", "spark"]
CONNECTION_ATTRS = ["server", "dbname", "schema", "warehouse", "username", "v-http-path", "catalog", "database"]
NO_CONNECTION_ERROR = "the workbook holds no live connection of a known class: " + ", ".join(CONNECTION_CLASSES)

PARSED = T.StructType([
    T.StructField("columns", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("datatype", T.StringType())]))),
    T.StructField("relations", T.ArrayType(T.StringType())),
    T.StructField("connections", T.ArrayType(T.StructType([T.StructField("class", T.StringType()),
                                                           T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))]))),
    T.StructField("relationships", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in "lrab"]))),
    T.StructField("parse_error", T.StringType()),
])


def _key_pairs(expression: ET.Element):
    """(left, right) operands of ``=(left, right)``, or of every pair under an AND."""
    inner = expression.findall("expression")
    if (expression.get("op") or "").upper() == "AND":
        for e in inner:
            yield from _key_pairs(e)
    elif len(inner) >= 2 and inner[0].get("op") is not None and inner[1].get("op") is not None:
        yield inner[0].get("op"), inner[1].get("op")


def _end(relationship: ET.Element, tag: str) -> str | None:
    return next((e.get("object-id") for e in relationship.findall(tag) if e.get("object-id") is not None), None)


def parse_document(data: bytes | None, encoding: str | None = None) -> dict:
    """What the four metadata tables need of one document; ``parse_error`` if it is no well-formed XML.

    Bytes are read as XML does: a byte order mark and a declared encoding hold, text or a second root after
    the first is an error. ``encoding`` overrides the declaration (for text that was decoded before)."""
    if data is None or not data.strip():
        return {"parse_error": "no document" if data is None else "empty document"}
    try:
        root = ET.fromstring(data, ET.XMLParser(encoding=encoding))
    except (ET.ParseError, LookupError, ValueError):
        return {"parse_error": "invalid XML"}
    known = set(CONNECTION_ATTRS)
    graph = next((r for s in root.iter("datasource") for g in s.findall("object-graph") for r in g.findall("relationships")), [])
    return {
        "columns": [{"name": c.get("name"), "datatype": c.get("datatype")} for c in root.iter("column") if c.get("name") and c.get("datatype")],
        "relations": [r.get("table") for r in root.iter("relation") if r.get("type") == "table" and r.get("table") is not None],
        "connections": [{"class": c.get("class"), "attrs": [(k, v) for k, v in c.attrib.items() if k in known]}
                        for n in root.iter("named-connection") for c in n.findall("connection")],
        "relationships": [{"l": left, "r": right, "a": _end(r, "first-end-point"), "b": _end(r, "second-end-point")}
                          for r in (graph if len(graph) else []) if r.tag == "relationship" and r.find("expression") is not None
                          and _end(r, "first-end-point") is not None and _end(r, "second-end-point") is not None
                          for left, right in _key_pairs(r.find("expression"))],
    }


def parse_workbooks(corpus: DataFrame) -> DataFrame:
    """Each document parsed once, where it lies: ``corpus`` (workbook, ``content`` bytes or ``xml`` text, any more columns)
    with the arrays of ``PARSED`` in place of the document. A parsed corpus is returned as it is."""
    if "parse_error" in corpus.columns:
        return corpus
    text = "content" not in corpus.columns
    kept = [c for c in corpus.columns if c not in ("content", "xml")]
    document = F.col("xml").cast("binary") if text else F.col("content")
    source = corpus.select(*kept, document.alias("content"))
    schema = T.StructType([*source.schema.fields[:-1], *PARSED.fields])
    encoding = "utf-8" if text else None

    def run(batches):
        import pyspark.sql.pandas.types as arrow
        parsed = arrow.to_arrow_schema(PARSED)
        for batch in batches:
            rows = [parse_document(d.as_py(), encoding) for d in batch.column(batch.num_columns - 1)]
            extra = [pa.array([r.get(f.name) for r in rows], f.type) for f in parsed]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *extra], names=schema.names)
    return source.mapInArrow(run, schema)


def parse_errors(corpus: DataFrame) -> DataFrame:
    """Documents that are null, blank or not well-formed XML."""
    return parse_workbooks(corpus).where("parse_error IS NOT NULL").select("workbook", F.col("parse_error").alias("error"))


def workbook_columns(corpus: DataFrame) -> DataFrame:
    """Declared column types: (workbook, column, declared_type, pos).

    Columns need a name and a datatype; internal names and ``table`` datatypes are
    dropped (C3); brackets stripped (J4); the type is lower-cased; the last
    declaration of a name wins (G4) while the name keeps its first position.
    """
    ex = parse_workbooks(corpus).select("workbook", F.posexplode("columns").alias("pos", "p"))
    ex = ex.select("workbook", "pos", F.col("p.name").alias("raw"), F.col("p.datatype").alias("datatype"))
    ex = ex.where(~F.col("raw").startswith(INTERNAL_COLUMN_PREFIX) & (F.col("datatype") != TABLE_DATATYPE))
    ex = ex.select("workbook", "pos", N.strip_brackets("raw").alias("column"), F.lower("datatype").alias("dt"))
    return ex.groupBy("workbook", "column").agg(
        F.max_by("dt", "pos").alias("declared_type"), F.min("pos").cast("int").alias("pos"))


def workbook_tables(corpus: DataFrame) -> DataFrame:
    """Table names: (workbook, table, pos). ``[schema].[table]`` -> table (J5); blanks, names with
    a dot or a space dropped (C4); first spelling wins case-insensitively (G2)."""
    ex = parse_workbooks(corpus).select("workbook", F.posexplode("relations").alias("pos", "raw"))
    ex = ex.where(F.col("raw") != "").select("workbook", "pos", N.last_name_part("raw").alias("table"))
    ex = ex.where((F.col("table") != "") & ~F.col("table").contains(".") & ~F.col("table").contains(" "))
    return first_wins_casefold(ex, "table", ["pos"], group=["workbook"]).select(
        "workbook", "table", F.col("pos").cast("int").alias("pos"))


def _of_class(name: str):
    return lambda c: c["class"] == name


def workbook_connections(corpus: DataFrame) -> DataFrame:
    """Connection descriptor (C5, J7-J9): (workbook, connection_class, source_type, params, error).

    The first connection of the first class present in precedence order is used.
    """
    g = parse_workbooks(corpus).where("parse_error IS NULL")
    first = F.coalesce(*[F.get(F.filter("connections", _of_class(c)), F.lit(0)) for c in CONNECTION_CLASSES])
    g = g.select("workbook", first.alias("c")).select(
        "workbook", F.col("c.class").alias("connection_class"), *[F.nullif(F.col("c.attrs")[a], F.lit("")).alias(f"__a_{a}") for a in CONNECTION_ATTRS])
    cc = F.col("connection_class")
    A = {a: F.col(f"`__a_{a}`") for a in CONNECTION_ATTRS}

    def m(**kv):
        return F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])

    snow = m(server=A["server"], account=N.server_account(A["server"]), database=A["dbname"], schema=A["schema"],
             warehouse=A["warehouse"], username=A["username"])
    sql = m(server=A["server"], database=A["dbname"], username=A["username"],
            is_azure=N.is_azure_host(A["server"]).cast("string"))
    dbx = m(server_hostname=A["server"], http_path=A["v-http-path"],
            catalog=N.first_non_empty(A["catalog"], A["database"]),
            schema=N.first_non_empty(A["schema"], A["dbname"]))
    params = (F.when(cc == "snowflake", snow).when(cc.isin("sqlserver", "azure_sqldb"), sql)
              .when(cc.isin("databricks", "spark"), dbx))
    stype = (F.when(cc == "snowflake", "snowflake")
             .when(cc.isin("sqlserver", "azure_sqldb"),
                   F.when(N.is_azure_host(A["server"]), "azuresql").otherwise("sqlserver"))
             .when(cc.isin("databricks", "spark"), "databricks"))
    return g.select("workbook", "connection_class", stype.alias("source_type"), params.alias("params"),
                    F.when(cc.isNull(), F.lit(NO_CONNECTION_ERROR)).alias("error"))


def workbook_relationships(corpus: DataFrame) -> DataFrame:
    """Relationships of the first object graph (E2, G3): (workbook, fromTable, fromColumn, toTable, toColumn, pos).

    Our reading of the usual ``=(left, right)`` shape: fromColumn = left operand,
    toColumn = right operand; keys joined by AND give a row each; tables drop only a ``_<32 hex>`` object suffix.
    """
    ex = parse_workbooks(corpus).select("workbook", F.posexplode("relationships").alias("pos", "x"))
    ex = ex.select("workbook", "pos",
                   N.relationship_table("x.a").alias("fromTable"), N.relationship_column("x.l").alias("fromColumn"),
                   N.relationship_table("x.b").alias("toTable"), N.relationship_column("x.r").alias("toColumn"),
                   F.col("x.l").alias("lop"), F.col("x.r").alias("rop"))
    ex = ex.where((F.col("lop") != "=") & (F.col("rop") != "=") & (F.col("fromColumn") != "")
                  & (F.col("toColumn") != "") & (F.col("fromTable") != "") & (F.col("toTable") != ""))
    keys = ["workbook", "fromTable", "fromColumn", "toTable", "toColumn"]
    return first_wins(ex.select(*keys, "pos"), keys, ["pos"]).select(*keys, F.col("pos").cast("int").alias("pos"))


def extract_metadata(corpus: DataFrame) -> dict[str, DataFrame]:
    """The four metadata tables and the parse errors of a workbook corpus, which is read and parsed once:
    the parsed arrays (not the documents) are landed in the shared scratch folder."""
    parsed = parse_workbooks(corpus)
    path = scratch_path(corpus.sparkSession, "workbooks", unique=True)
    parsed.write.parquet(path)
    corpus = corpus.sparkSession.read.schema(parsed.schema).parquet(path)
    return {
        "parsed": corpus,
        "columns": workbook_columns(corpus),
        "tables": workbook_tables(corpus),
        "connections": workbook_connections(corpus),
        "relationships": workbook_relationships(corpus),
        "errors": parse_errors(corpus),
    }


def declared_types_of(columns: DataFrame, workbook: str) -> dict[str, str]:
    """The column -> declared type map of one workbook (driver-side: one small map per workbook)."""
    rows = columns.where(F.col("workbook") == workbook).select("column", "declared_type").collect()
    return {r["column"]: r["declared_type"] for r in rows}
