"""J1-J16 identifier helpers, raw extract names from the extract docstring examples."""
import pytest
from pyspark.sql import functions as F

from lakewright.functions import names as N
from lakewright.functions.types import (declared_spark_type, infer_spark_type, inferred_type_from_name,
                                        spark_type_for_declared, target_schema)


def ev(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_clean_extract_name(spark):
    raw = ["customers.csv_8DD21EEE7ABC4E3C930A78618FCDF78B", "sales_57BDF416384B493EB6270775A72222E2",
           "sales.csv", "Extract", '"products"', "", "x_57bdf416384b493eb6270775a72222e2.CSV", ".csv_ABC"]
    got = ev(spark, lambda c: N.clean_extract_name(N.strip_quotes(c)), raw)
    assert got == ["customers", "sales", "sales", "Extract", "products", "table", "x_57bdf416384b493eb6270775a72222e2", ""]


def test_brackets_and_parts(spark):
    assert ev(spark, N.strip_brackets, ["[A]", "[[B]]", "C"]) == ["A", "B", "C"]
    assert ev(spark, N.last_name_part, ["[PUBLIC].[ORDERS]", "[ORDERS]", "[a].[b].[c]"]) == ["ORDERS", "ORDERS", "c"]
    assert ev(spark, N.relationship_column, ["[CUST_KEY (CUSTOMERS)]", "[ID]"]) == ["CUST_KEY", "ID"]
    assert ev(spark, N.relationship_table, ["ORDERS_0123456789ABCDEF0123456789ABCDEF", "MY_TABLE (x)"]) == \
        ["ORDERS", "MY_TABLE"]


def test_file_stem(spark):
    assert ev(spark, N.file_stem, ["/a/b/c.twbx", "file:/x/y.tar.gz", "/z/.hidden", "noext", "/d/e."]) == \
        ["c", "y.tar", ".hidden", "noext", "e"]


def test_server_helpers(spark):
    assert ev(spark, N.server_account, ["acct1.example.com", "", None]) == ["acct1", None, None]
    assert ev(spark, N.is_azure_host, ["x.database.windows.net", "host", None]) == [True, False, False]
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(N.first_non_empty("a", "b")).collect()] == ["b", "b", "a", None]


def test_misc(spark):
    assert ev(spark, N.job_id, ["wb"]) == ["refresh__wb"]
    assert ev(spark, N.job_name, ["wb"]) == ["Refresh: wb"]
    assert ev(spark, N.is_system_schema, ["PUBLIC", "Extract", "sales"]) == [True, True, False]
    df = spark.createDataFrame([(1234567,)], "n long")
    assert df.select(N.thousands("n")).first()[0] == "1,234,567"
    assert N.qualified_name("t", "s", "c") == "`c`.`s`.`t`"
    assert N.qualified_name("t", "s") == "`s`.`t`"
    assert N.qualified_name("t", None, "c") == "`t`"
    assert N.quote_ident('a"b') == '"a""b"'


def test_declared_types(spark):
    assert spark_type_for_declared("Integer") == "BIGINT"
    assert spark_type_for_declared("datetime") == "TIMESTAMP"
    assert spark_type_for_declared("decimal") == "STRING"
    assert ev(spark, declared_spark_type, ["REAL", "spatial", "x", ""]) == ["DOUBLE", "STRING", "STRING", "STRING"]
    assert ev(spark, inferred_type_from_name, ["Int64", "float32", "boolean", "datetime64[ns]", "date32", "object"]) == \
        ["BIGINT", "DOUBLE", "BOOLEAN", "TIMESTAMP", "DATE", "STRING"]


def test_target_schema(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, 1.5D AS c, CAST(1 AS DECIMAL(10,2)) AS d, array(1) AS e")
    assert target_schema(df.schema, {"b": "integer", "a": ""}) == \
        [("a", "BIGINT"), ("b", "BIGINT"), ("c", "DOUBLE"), ("d", "DECIMAL(10,2)"), ("e", "ARRAY<INT>")]
    assert infer_spark_type(df.schema["a"].dataType) == "BIGINT"
