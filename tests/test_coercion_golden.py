"""SURVEY §5.2 coercion truth table, column by column (the gates are column-wide)."""
import math

import pytest
from pyspark.sql import types as T

from lakewright.operators.typing import coerce_table


def one_col(spark, values, declared=None, sniff="undeclared"):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    typed = coerce_table(df, {"v": declared} if declared else {}, sniff=sniff)
    rows = [r[0] for r in typed.df.collect()]
    return typed.decisions[0], rows, typed.df.schema["v"].dataType


@pytest.mark.parametrize("raw,expected", [
    ("12", 12), (" 12 ", 12), ("1e3", 1000), ("20240101", 20240101), ("12345678", 12345678),
    ("abc", None), ("0x10", None), ("1_000", None), ("1,000", None), ("", None), ("yes", None),
    ("2024-01-01", None), ("9007199254740993", 9007199254740993),
])
def test_integer_values(spark, raw, expected):
    dec, rows, dt = one_col(spark, [raw], "integer")
    assert isinstance(dt, T.LongType)
    assert rows == [expected]


@pytest.mark.parametrize("raw", ["12.5", "inf", "1e30"])
def test_integer_column_kept_when_any_value_blocks(spark, raw):
    dec, rows, dt = one_col(spark, ["7", raw, "abc"], "integer", sniff="none")
    assert isinstance(dt, T.StringType)
    assert rows == ["7", raw, "abc"]
    assert dec.action == "keep"


@pytest.mark.parametrize("raw,expected", [
    ("12", 12.0), (" 12 ", 12.0), ("1e3", 1000.0), ("12.5", 12.5), ("inf", math.inf), ("-Infinity", -math.inf),
    ("abc", None), ("0x10", None), ("1_000", None), ("1,000", None), ("", None), ("NaN", None), ("1d", None),
    ("20240101", 20240101.0),
])
def test_real_values(spark, raw, expected):
    dec, rows, dt = one_col(spark, [raw], "real")
    assert isinstance(dt, T.DoubleType)
    assert rows == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("yes", True), ("no", False), ("TRUE", True), ("False", False), ("1", True), ("0", False),
    ("t", None), ("y", None), (" yes", None), ("12", None), (None, None),
])
def test_boolean_values(spark, raw, expected):
    dec, rows, dt = one_col(spark, [raw], "boolean")
    assert isinstance(dt, T.BooleanType)
    assert rows == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("nan", None), ("<NA>", None), ("None", None), ("NaT", "NaT"), ("text", "text"), (None, None),
])
def test_string_null_tokens(spark, raw, expected):
    dec, rows, dt = one_col(spark, [raw], "string")
    assert rows == [expected]


@pytest.mark.parametrize("values,kind", [
    (["12"], "text"), (["20240101"], "date"), (["12345678"], "text"), (["2024-01-01"], "date"),
    (["2024-01-01", "2024-02-03 10:00:00"], "text"),
    (["2024-01-01 10:00:00", "2024-02-03 00:00:00"], "timestamp"),
    (["2024-01-01T10:20:30Z"], "text"), (["2024-01-01T00:00:00Z"], "date"),
    (["1999/1/5"], "date"), (["9999-12-31"], "date"), (["2024-02-30"], "text"),
    (["2024-01-01 00:00:00.5"], "date"), (["yes"], "text"),
])
def test_sniff(spark, values, kind):
    dec, rows, dt = one_col(spark, values)
    got = {T.StringType: "text", T.DateType: "date", T.TimestampType: "timestamp"}[type(dt)]
    assert got == kind


def test_sniff_values_and_utc(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("2024-01-01 10:00:00",), (None,), ("2024-02-03 00:00:00.25",)], "v string")
    out = coerce_table(df, {}).df
    assert isinstance(out.schema["v"].dataType, T.TimestampType)
    got = [r[0] for r in out.select(F.date_format("v", "yyyy-MM-dd HH:mm:ss.SSS")).collect()]
    assert got == ["2024-01-01 10:00:00.000", None, "2024-02-03 00:00:00.250"]


def test_declared_string_not_sniffed_by_default(spark):
    dec, rows, dt = one_col(spark, ["2024-01-01"], "string")
    assert isinstance(dt, T.StringType)
    dec, rows, dt = one_col(spark, ["2024-01-01"], "string", sniff="all")
    assert isinstance(dt, T.DateType)


def test_declared_date_per_value(spark):
    dec, rows, dt = one_col(spark, ["2024-01-05", "2024/1/6", "20240107", "2024-01-08 10:11:12", "junk", None], "date")
    assert isinstance(dt, T.DateType)
    assert [r.isoformat() if r else None for r in rows] == \
        ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08", None, None]


def test_new_nulls_counted_during_write(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("1",), ("x",), (None,), ("3",)], "v string")
    typed = coerce_table(df, {"v": "integer"})
    obs = Observation("t")
    assert typed.observed(obs).count() == 4
    assert obs.get["rows"] == 4 and obs.get["new_nulls__v"] == 1


def test_numeric_sources(spark):
    df = spark.createDataFrame([(1.0, 1, True, 0.5), (2.0, 0, False, float("nan"))], "a double, b int, c boolean, d double")
    typed = coerce_table(df, {"a": "integer", "b": "boolean", "c": "integer", "d": "real"})
    rows = [tuple(r) for r in typed.df.collect()]
    assert rows == [(1, True, 1, 0.5), (2, False, 0, None)]
    typed = coerce_table(df, {"d": "integer"})
    assert typed.decisions[3].action == "keep"


def test_ntz_to_utc_and_collapse(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS a, timestamp_ntz'2024-01-01 10:00:00' AS b")
    t1 = coerce_table(df, {})
    assert [f.dataType.simpleString() for f in t1.df.schema] == ["timestamp", "timestamp"]
    t2 = coerce_table(df, {}, collapse_midnight=True)
    assert [f.dataType.simpleString() for f in t2.df.schema] == ["date", "timestamp"]


def test_idempotent_on_typed_output(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "yes")], "a string, b string, c string")
    typed = coerce_table(df, {"a": "integer", "c": "boolean"}).df
    again = coerce_table(typed, {"a": "integer", "c": "boolean"}).df
    assert typed.schema == again.schema and typed.collect() == again.collect()


# ---- property: the sniff decision equals a brute-force decision over the whole column ----
import datetime as _dt  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_value = st.one_of(
    st.just(("junk", None)),
    st.tuples(st.sampled_from(["dash", "slash", "compact"]), st.integers(1990, 2030), st.integers(1, 12),
              st.sampled_from([1, 15, 28, 29, 30, 31]),
              st.one_of(st.none(), st.tuples(st.sampled_from([0, 9, 23]), st.sampled_from([0, 30]),
                                             st.sampled_from([0, 45]))),
              st.sampled_from(["", "Z", "+02:00"])),
)


def _render(v):
    """(text, shape key or None when it must not parse, midnight)."""
    if v[0] == "junk":
        return "n/a", None, False
    kind, y, m, d, tm, zone = v
    if kind == "compact":                                   # no time / zone on the compact layout here
        tm, zone = None, ""
    date = {"dash": f"{y}-{m}-{d}", "slash": f"{y}/{m}/{d}", "compact": f"{y}{m:02d}{d:02d}"}[kind]
    text = date + ("" if tm is None else " %02d:%02d:%02d" % tm) + (zone if tm is not None else "")
    try:
        _dt.date(y, m, d)
    except ValueError:
        return text, None, False
    return text, (kind, tm is not None, bool(zone) and tm is not None), tm is None or tm == (0, 0, 0)


@settings(max_examples=25, deadline=None)
@given(vals=st.lists(_value, min_size=1, max_size=6), nulls=st.integers(0, 2))
def test_sniff_matches_brute_force(spark, vals, nulls):
    rendered = [_render(v) for v in vals]
    shapes = {r[1] for r in rendered}
    if None in shapes or len(shapes) != 1:
        want = "text"
    elif all(r[2] for r in rendered):
        want = "date"
    elif not next(iter(shapes))[2]:
        want = "timestamp"
    else:
        want = "text"
    dec, rows, dt = one_col(spark, [r[0] for r in rendered] + [None] * nulls)
    got = {T.StringType: "text", T.DateType: "date", T.TimestampType: "timestamp"}[type(dt)]
    assert got == want, (rendered, dec)
