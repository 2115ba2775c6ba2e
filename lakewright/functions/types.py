"""Declared and inferred column types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workbook datatype -> Spark SQL type (lookup is lower-cased, default STRING).
DECLARED_TO_SPARK = {
    "integer": "BIGINT",
    "real": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "STRING",
    "date": "DATE",
    "datetime": "TIMESTAMP",
    "spatial": "STRING",
    "unknown": "STRING",
}
DEFAULT_SPARK_TYPE = "STRING"

# Ordered substring rule for type names without a declaration.
INFER_RULES = [
    (("int",), "BIGINT"),
    (("float", "double"), "DOUBLE"),
    (("bool",), "BOOLEAN"),
    (("datetime", "timestamp"), "TIMESTAMP"),
    (("date",), "DATE"),
]


def spark_type_for_declared(declared: str | None) -> str:
    """D1 (driver-side): declared workbook type -> Spark SQL type name."""
    return DECLARED_TO_SPARK.get((declared or "").lower(), DEFAULT_SPARK_TYPE)


def declared_spark_type(col) -> Column:
    """D1 as a Column: CASE over lower(declared) with default STRING."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    expr = None
    for k, v in DECLARED_TO_SPARK.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.otherwise(F.lit(DEFAULT_SPARK_TYPE))


def inferred_type_from_name(col) -> Column:
    """D2 as a Column over a type-name string, first matching substring wins."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    expr = None
    for needles, out in INFER_RULES:
        cond = None
        for n in needles:
            cond = c.contains(n) if cond is None else (cond | c.contains(n))
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr.otherwise(F.lit(DEFAULT_SPARK_TYPE))


def infer_spark_type(dt: T.DataType) -> str:
    """D2 over a Spark DataType. Integers of every width widen to BIGINT.

    Our rule (D14/D15): decimals and nested types keep their native type.
    """
    if isinstance(dt, T.IntegralType):
        return "BIGINT"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.DecimalType, T.ArrayType, T.MapType, T.StructType)):
        return dt.simpleString().upper()
    return DEFAULT_SPARK_TYPE


def target_schema(schema: T.StructType, declared: dict[str, str]) -> list[tuple[str, str]]:
    """D3: per column, the declared type when there is one, else the inferred one."""
    out = []
    for f in schema.fields:
        d = (declared.get(f.name) or "").lower()
        out.append((f.name, spark_type_for_declared(d) if d else infer_spark_type(f.dataType)))
    return out
