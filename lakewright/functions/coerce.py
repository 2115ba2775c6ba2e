"""Per-value coercion rules (D4-D16) as Column builders.

Column-wide decisions (is any value fractional? do all values look like dates?)
are not made here: ``lakewright.operators.profile`` measures them in one pass and
``lakewright.operators.typing`` picks the expression per column. Every parse is a
``try_*`` form because ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reference behaviour)
# ---------------------------------------------------------------------------
TRUE_TOKENS = ["true", "1", "yes"]
FALSE_TOKENS = ["false", "0", "no"]
NULL_TEXT_TOKENS = ["nan", "<NA>", "None"]
# Numbers accepted as text: optional sign, digits with optional fraction, or a
# leading-dot fraction, optional exponent. Hex, '_' and ',' separators are rejected.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Plain integers. Casts only run behind these shape tests: a failing try_cast costs
# an exception per value inside Spark, a failing regex does not.
INTEGER_RE = r"^[+-]?\d{1,19}$"
INFINITY_RE = r"(?i)^[+-]?(inf|infinity)$"
NAN_RE = r"(?i)^[+-]?nan$"
LONG_LIMIT = 9.223372036854775807e18

# Date / timestamp text shapes accepted by the sniffer and, with the layouts below, by declared dates.
DATE_SHAPES = {
    1: r"(\d{4})-(\d{1,2})-(\d{1,2})",   # 2024-01-05, 2024-1-5
    2: r"(\d{4})/(\d{1,2})/(\d{1,2})",   # 2024/1/5
    3: r"(\d{4})(\d{2})(\d{2})",         # 20240105
}
TIME_PART = r"(?:[ T](\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?)?"
ZONE_PART = r"(Z|[+-]\d{2}(?::?\d{2})?)?"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# numbers
# ---------------------------------------------------------------------------
def float_integer_blocker(x) -> Column:
    """D4 gate for float/double/decimal sources."""
    c = _c(x).cast("double")
    return c.isNotNull() & ~F.isnan(c) & ((c != F.floor(c)) | (F.abs(c) >= F.lit(LONG_LIMIT)))


def float_to_integer(x) -> Column:
    c = _c(x).cast("double")
    return F.when(~F.isnan(c), c.try_cast("bigint"))


def to_double_nan_null(x) -> Column:
    c = _c(x).cast("double")
    return F.when(~F.isnan(c), c)


# ---------------------------------------------------------------------------
# booleans and text
# ---------------------------------------------------------------------------
def token_boolean(x, dt: T.DataType | None = None) -> Column:
    """lower(text) in TRUE_TOKENS -> true, in FALSE_TOKENS -> false, else null.

    Not ``cast(... as boolean)``: Spark would also accept 't', 'y'."""
    c = _c(x)
    if isinstance(dt, T.BooleanType):
        return c
    s = F.lower(c if isinstance(dt, T.StringType) or dt is None else c.cast("string"))
    return F.when(s.isin(*TRUE_TOKENS), F.lit(True)).when(s.isin(*FALSE_TOKENS), F.lit(False)) \
        .otherwise(F.lit(None).cast("boolean"))


def null_token_text(x, dt: T.DataType | None = None, tokens=None) -> Column:
    """Text of the value; the null tokens become null (even as real text)."""
    tokens = list(tokens or NULL_TEXT_TOKENS)
    c = _c(x)
    if dt is None or isinstance(dt, T.StringType):
        s = c
    elif isinstance(dt, T.BooleanType):
        s = F.when(c, F.lit("True")).when(~c, F.lit("False"))     # Python's text of a bool
    elif isinstance(dt, (T.FloatType, T.DoubleType)):
        s = F.when(~F.isnan(c), c.cast("string"))
    elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        s = F.to_json(c)
    else:
        s = c.cast("string")
    return F.when(s.isin(*tokens), F.lit(None).cast("string")).otherwise(s)


# ---------------------------------------------------------------------------
# dates and timestamps
# ---------------------------------------------------------------------------
DATE_UNION = "(?:" + "|".join(DATE_SHAPES.values()).replace("(", "(?:").replace("(?:?:", "(?:") + ")"
SHAPE_RE = "^" + DATE_UNION + TIME_PART + ZONE_PART + "$"
BODY_RE = r"^[0-9/-]+(?:[ T][0-9:.]+)?"
PARSE_FORMAT = "yyyy-M-d[ H:m[:s][.SSSSSSSSS]]"


# Layouts accepted for declared dates only; each starts a text and may be followed by a time of day.
DAY_TIME = r"(?:[ T](?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,9})?)?(?: ?[AaPp][Mm])?)?"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_NAME = "(?i:(" + "|".join(MONTHS) + ")[a-z]*)"
YEAR_FIRST = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + DAY_TIME + "$"            # 2024.01.05, 2024-01-05 10:00 AM
YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + DAY_TIME + "$"             # 01/05/2024
NAME_FIRST = "^" + MONTH_NAME + r"\.? (\d{1,2}),? (\d{4})" + DAY_TIME + "$"      # Jan 5, 2024
DAY_FIRST = r"^(\d{1,2})[- ]" + MONTH_NAME + r"[- ,]{1,2}(\d{4})" + DAY_TIME + "$"  # 05-Jan-2024


def _written_date(t: Column, day_first: bool) -> Column:
    """``yyyy-M-d`` text of a date in one of the declared-only layouts, else null."""
    def part(pattern, group):
        return F.regexp_extract(t, pattern, group)

    def month(pattern, group):
        return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(part(pattern, group))).cast("string")
    first, second = (2, 1) if day_first else (1, 2)
    return (F.when(t.rlike(YEAR_FIRST), F.concat_ws("-", part(YEAR_FIRST, 1), part(YEAR_FIRST, 2), part(YEAR_FIRST, 3)))
            .when(t.rlike(YEAR_LAST), F.concat_ws("-", part(YEAR_LAST, 3), part(YEAR_LAST, first), part(YEAR_LAST, second)))
            .when(t.rlike(NAME_FIRST), F.concat_ws("-", part(NAME_FIRST, 3), month(NAME_FIRST, 1), part(NAME_FIRST, 2)))
            .when(t.rlike(DAY_FIRST), F.concat_ws("-", part(DAY_FIRST, 3), month(DAY_FIRST, 2), part(DAY_FIRST, 1))))


class Stages:
    """Helper columns added in successive projections.

    A parse that several outputs need (shape test, timestamp parse) is computed
    once per row as its own column; Catalyst keeps such non-cheap, multiply-used
    columns in their own projection instead of inlining them (and CASE branches
    are not shared by common-subexpression elimination), so each parse runs once.
    """

    def __init__(self, prefix: str = "__lw"):
        self.prefix, self.levels, self.n = prefix, [], 0

    def add(self, level: int, col: Column, hint: str = "h") -> Column:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"{self.prefix}_{hint}{self.n}"
        self.n += 1
        self.levels[level].append(col.alias(name))
        return F.col(name)

    def apply(self, df):
        for cols in self.levels:
            if cols:
                df = df.select("*", *cols)
        return df


class TextNumber:
    """Numeric text pieces (D4/D5) as helper columns."""

    def __init__(self, s, st: Stages, integer: bool = False):
        t = st.add(0, F.trim(_c(s)), "t")
        self.t, self.b = t, None
        if integer:
            # plain integers (the common case) need one cast and no regex
            b = st.add(1, F.when(t.rlike(INTEGER_RE), t.try_cast("bigint")), "i")
            d = st.add(2, F.when(b.isNull() & t.rlike(NUMBER_RE), t.try_cast("double"))
                        .when(b.isNull() & t.rlike(INFINITY_RE), t.try_cast("double")), "d")
            self.b = b
        else:
            d = st.add(1, F.when(t.rlike(NUMBER_RE) | t.rlike(INFINITY_RE), t.try_cast("double")), "d")
        self.d = d

    @property
    def double(self) -> Column:
        return F.when(~F.isnan(self.d), self.d)

    @property
    def integer(self) -> Column:
        return F.coalesce(self.b, F.when(F.abs(self.d) < F.lit(LONG_LIMIT), self.d.try_cast("bigint")))

    @property
    def integer_blocker(self) -> Column:
        return self.d.isNotNull() & ((F.abs(self.d) >= F.lit(LONG_LIMIT)) | ((self.d % 1) != 0))


class TemporalText:
    """Date/timestamp text under the accepted shapes (D7, D11, D12) as helper columns.

    One regex tests the shape, one splits off the zone suffix, one
    ``try_to_timestamp`` parses the wall-clock part (invalid calendar dates fail). ``declared`` also takes the layouts
    that only declared dates may have; in an all-number date that ends in the year the month comes first, or the
    day with ``day_first``.
    """

    def __init__(self, s, st: Stages, declared: bool = False, day_first: bool = False):
        t = st.add(0, F.trim(_c(s)), "t")
        m = st.add(1, t.rlike(SHAPE_RE), "m")
        body = st.add(2, F.when(m, F.regexp_extract(t, BODY_RE, 0)), "b")     # only for values of a date shape
        sep = F.substring(t, 5, 1)
        kind = F.when(sep == "-", F.lit(1)).when(sep == "/", F.lit(2)).otherwise(F.lit(3))
        has_time = body.contains(" ") | body.contains("T")
        has_zone = F.length(t) > F.length(body)
        compact = F.concat(F.substring(body, 1, 4), F.lit("-"), F.substring(body, 5, 2), F.lit("-"),
                           F.substring(body, 7, 64))
        norm = F.translate(F.when(kind == 3, compact).otherwise(body), "T/", " -")
        wall = st.add(3, F.when(m, F.try_to_timestamp(norm, F.lit(PARSE_FORMAT))), "w")
        self.shape = st.add(3, F.when(m, (kind - 1) * 4 + 1 + has_time.cast("int") * 2 + has_zone.cast("int"))
                            .otherwise(F.lit(0)), "s")
        self.has_zone = st.add(3, m & has_zone, "z")
        self.wall = wall
        self.ok = m & wall.isNotNull()
        self.midnight = (F.hour(wall) == 0) & (F.minute(wall) == 0) & (F.second(wall) == 0)
        self.other = None
        if declared:
            written = st.add(4, F.when(~m, _written_date(t, day_first)), "d")
            self.other = st.add(5, F.to_date(F.try_to_timestamp(written, F.lit("yyyy-M-d"))), "o")

    @property
    def date(self) -> Column:
        own = F.when(self.ok, F.to_date(self.wall))
        return own if self.other is None else F.coalesce(own, self.other)

    @property
    def timestamp(self) -> Column:
        return F.when(self.ok & ~self.has_zone, self.wall)


def shape_has_zone(shape: int) -> bool:
    """Whether a ``TemporalText.shape`` code (1-12) is a shape with a zone suffix."""
    return (shape - 1) % 2 == 1


def temporal_to_date(x) -> Column:
    """D7 for date / timestamp sources: calendar date, time dropped."""
    return F.to_date(_c(x))


def ntz_to_utc(x) -> Column:
    """Zone-less timestamp -> UTC instant (session zone is UTC)."""
    return _c(x).cast("timestamp")
