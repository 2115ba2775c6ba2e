"""Typed projection of a landed table: declared coercion (D4-D10), sniffing (D11/D12),
UTC timestamps (D13) and the optional midnight collapse (D16).

Flow: one profile aggregate answers every column-wide question, then a single
``select`` produces the typed frame. Nothing is collected but one small row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import coerce as C
from lakewright.functions.types import spark_type_for_declared
from lakewright.operators.profile import is_midnight, profile_row

SNIFF_MODES = ("undeclared", "all", "none")
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class ColumnDecision:
    column: str
    source_type: str
    declared: str | None
    action: str
    result_type: str = ""
    note: str | None = None


@dataclass
class TypedTable:
    """Typed frame plus what was decided per column and the new-null flags.

    ``source`` is the input with its helper columns (parse pieces computed once per row).
    """
    source: DataFrame
    exprs: list[Column]
    names: list[str]
    decisions: list[ColumnDecision]
    null_flags: dict[str, Column] = field(default_factory=dict)

    @property
    def df(self) -> DataFrame:
        return self.source.select(*self.exprs)

    def observed(self, observation, *extra: Column) -> DataFrame:
        """Typed frame that fills ``observation`` with rows and per-column new nulls while it is written."""
        keys = list(self.null_flags)
        src_nn = [self.null_flags[k].alias(f"__nn_{i}") for i, k in enumerate(keys)]
        wide = self.source.select(*self.exprs, *src_nn)
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.count_if(F.col(f"__nn_{i}") & _q(k).isNull()).alias(f"new_nulls__{k}")
                    for i, k in enumerate(keys)]
        return wide.observe(observation, *metrics, *extra).select(*[_q(n) for n in self.names])


def _is_text(dt):
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def coerce_table(df: DataFrame, declared: dict[str, str] | None = None, *, sniff: str = "undeclared",
                 collapse_midnight: bool = False, null_tokens=None, day_first: bool = False, profiler=None) -> TypedTable:
    """Plan and profile the typed projection of ``df``.

    ``declared`` maps column name (exact) -> workbook datatype. ``sniff`` picks which
    remaining text columns may turn into DATE / TIMESTAMP: ``undeclared`` (text
    columns not declared ``string``), ``all`` (also declared strings, the
    write-time behaviour of the original service) or ``none``.

    A declared date in text takes more layouts than the sniffer (see ``coerce.TemporalText``); ``day_first``
    settles 01/05/2024. Values that no layout fits become null and are counted as new nulls.

    Cost: one aggregate over the helper columns (skipped when no column needs a
    column-wide decision), then a single projection. ``profiler(prepare, aggs, stage)`` may answer that aggregate otherwise,
    for instance from kept profiles of files (see ``plans.profiles``): all of its parts merge (``profile.merged``).
    """
    if sniff not in SNIFF_MODES:
        raise ValueError(f"sniff must be one of {SNIFF_MODES}")
    declared = {k: (v or "").lower() for k, v in (declared or {}).items()}
    st = C.Stages()
    aggs: dict[str, Column] = {}
    plans = []
    for i, f in enumerate(df.schema.fields):
        name, dt, c = f.name, f.dataType, _q(f.name)
        d = declared.get(name, "")
        plan = {"i": i, "name": name, "dt": dt, "declared": d or None, "text_after": None}
        if d == "integer":
            if isinstance(dt, (T.IntegralType, T.BooleanType)):
                plan["kind"] = "int_direct"
            elif _is_text(dt):
                plan["kind"] = "int_text"
                plan["num"] = C.TextNumber(c, st, integer=True)
                aggs[f"b{i}"] = F.bool_or(plan["num"].integer_blocker)
                plan["sniff_if_kept"] = sniff != "none"     # sniffed only if the column stays text
            elif isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
                plan["kind"] = "int_float"
                aggs[f"b{i}"] = F.bool_or(C.float_integer_blocker(c))
            else:
                plan["kind"] = "keep_unsupported"
        elif d == "real":
            if _is_text(dt):
                plan["kind"], plan["num"] = "real_text", C.TextNumber(c, st)
            else:
                plan["kind"] = "real_num" if isinstance(dt, NUMERIC + (T.BooleanType,)) else "keep_unsupported"
        elif d == "boolean":
            plan["kind"] = "bool"
        elif d == "date":
            if _is_text(dt):
                plan["kind"], plan["temporal"] = "date_text", C.TemporalText(c, st, declared=True, day_first=day_first)
            else:
                plan["kind"] = ("date_temporal" if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))
                                else "keep_unsupported")
        elif d == "string":
            plan["kind"] = "string"
            if sniff == "all":
                plan["text_after"] = C.null_token_text(c, dt, null_tokens)
        else:
            plan["kind"] = "none"
            if _is_text(dt) and sniff != "none":
                plan["text_after"] = c
        if plan["kind"] == "none" and isinstance(dt, T.TimestampNTZType) and collapse_midnight:
            aggs[f"m{i}"] = F.bool_and(F.when(c.isNotNull(), is_midnight(c, dt)))
        if plan["text_after"] is not None:
            _sniff_aggs(plan, st, aggs)
        plans.append(plan)

    prepared = st.apply(df)
    prof = profile_row(prepared, aggs) if profiler is None else profiler(st.apply, aggs, 1)

    # Rare second pass: declared-integer text columns the gate kept as text are sniffed too.
    kept = [p for p in plans if p.get("sniff_if_kept") and prof.get(f"b{p['i']}")]
    if kept:
        st2 = C.Stages(prefix="__lw2")
        aggs2: dict[str, Column] = {}
        for p in kept:
            p["text_after"] = _q(p["name"])
            _sniff_aggs(p, st2, aggs2)
        prepared = st2.apply(prepared)
        prof.update(profile_row(prepared, aggs2) if profiler is None else profiler(lambda d: st2.apply(st.apply(d)), aggs2, 2))

    exprs, names, decisions, flags = [], [], [], {}
    for plan in plans:
        i, name, dt, c, kind = plan["i"], plan["name"], plan["dt"], _q(plan["name"]), plan["kind"]
        d = plan["declared"]
        out, action, note = c, "keep", None
        text_now = False
        if kind == "int_direct":
            out, action = c.cast("bigint"), "integer"
        elif kind in ("int_text", "int_float"):
            if prof.get(f"b{i}"):
                action, note = "keep", "fraction, infinity or out-of-range value: column left unchanged"
                text_now = kind == "int_text"
            else:
                out = plan["num"].integer if kind == "int_text" else C.float_to_integer(c)
                action = "integer"
        elif kind == "real_text":
            out, action = plan["num"].double, "real"
        elif kind == "real_num":
            out, action = C.to_double_nan_null(c), "real"
        elif kind == "bool":
            out, action = C.token_boolean(c, dt), "boolean"
        elif kind == "date_text":
            out, action = plan["temporal"].date, "date"
        elif kind == "date_temporal":
            out, action = C.temporal_to_date(c), "date"
        elif kind == "string":
            out, action = C.null_token_text(c, dt, null_tokens), "string"
            text_now = sniff == "all"
        elif kind == "keep_unsupported":
            note = f"declared {d} not applicable to {dt.simpleString()}: column left unchanged"
        elif kind == "none":
            text_now = plan["text_after"] is not None
        # sniff (D11/D12) on whatever is still text
        if text_now and plan.get("sniff") is not None and f"lo{i}" in prof:
            lo, hi = prof[f"lo{i}"], prof[f"hi{i}"]
            if lo is not None and lo == hi and lo > 0:       # some values, all parse, one shape
                p = plan["sniff"]
                if prof[f"mid{i}"]:
                    out, action = p.date, "sniff_date"
                elif not C.shape_has_zone(lo):
                    out, action = p.timestamp, "sniff_timestamp"
                else:
                    note = "zoned timestamps with a time part stay text"
        # zone-less timestamps become UTC instants (D13) unless collapsed to dates
        if action == "keep" and isinstance(dt, T.TimestampNTZType) and kind == "none":
            if collapse_midnight and prof.get(f"m{i}"):
                out, action = F.to_date(c), "collapse_date"
            else:
                out, action = C.ntz_to_utc(c), "utc_timestamp"
        if action not in ("keep", "utc_timestamp", "collapse_date"):
            flags[name] = c.isNotNull()
        exprs.append(out.alias(name))
        names.append(name)
        decisions.append(ColumnDecision(name, dt.simpleString(), d, action, note=note))

    typed = TypedTable(prepared, exprs, names, decisions, flags)
    for dec, f in zip(decisions, typed.df.schema.fields):
        dec.result_type = f.dataType.simpleString()
    return typed


def _sniff_aggs(plan: dict, st, aggs: dict) -> None:
    """Shape / parse / midnight facts of a text column for the sniff decision.

    Three aggregates: a value that does not parse counts as shape 0, so "some values,
    all parse, one shape" is ``min == max > 0`` over the non-null values, and the
    shape code itself says whether that shape carries a zone."""
    i = plan["i"]
    p = C.TemporalText(plan["text_after"], st)
    plan["sniff"] = p
    nn = plan["text_after"].isNotNull()
    shape = F.when(nn, F.when(p.ok, p.shape).otherwise(F.lit(0)))
    aggs[f"lo{i}"] = F.min(shape)
    aggs[f"hi{i}"] = F.max(shape)
    aggs[f"mid{i}"] = F.bool_and(F.when(nn & p.ok, p.midnight))


def declared_lookup(table_columns: DataFrame, workbook_columns: DataFrame) -> DataFrame:
    """Each (table, column) with its workbook's declared type, or null when undeclared.

    ``table_columns``: (workbook, table_name, column); ``workbook_columns``: the
    ``operators.workbook.workbook_columns`` output. Matching is exact on the column name.
    """
    decl = workbook_columns.select("workbook", "column", "declared_type")
    from lakewright.functions.types import declared_spark_type
    out = table_columns.join(decl, ["workbook", "column"], "left")
    return out.withColumn("spark_type", F.when(F.col("declared_type").isNotNull(),
                                                declared_spark_type("declared_type")))


def coerce(df: DataFrame, declared: dict[str, str] | None = None, **kw) -> DataFrame:
    """Convenience: the typed DataFrame only."""
    return coerce_table(df, declared, **kw).df


def declared_result_type(declared: str) -> str:
    """The Spark type a successful declared coercion yields."""
    return spark_type_for_declared(declared)
