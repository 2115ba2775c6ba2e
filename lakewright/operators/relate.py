"""Workbook relationships applied to data (E3) and checked for orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.skew import hot_keys, is_hot
from lakewright.session import scratch_path

SALTABLE_JOINS = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "left_anti", "leftanti")
RIGHT_KEEPING_JOINS = {"right": "inner", "right_outer": "inner", "rightouter": "inner",
                       "full": "left", "full_outer": "left", "fullouter": "left", "outer": "left"}
LEFT_ONLY_JOINS = ("left_semi", "leftsemi", "left_anti", "leftanti")
#: Plan nodes that make evaluating a side twice dear.
DEAR = ("Join", "Aggregate", "Window", "Sort", "Repartition", "Generate", "MapInPandas", "MapInArrow", "Distinct")


def _read_once(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a scan with projections and filters, else landed once in the shared scratch folder."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not any(node in plan for node in DEAR):
        return df
    path = scratch_path(df.sparkSession, "relate", unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _position(df: DataFrame, name: str) -> int:
    at = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(at) != 1:
        raise ValueError(f"column '{name}' is not one of {df.columns}" if not at else f"column '{name}' is ambiguous")
    return at[0]


def apply_relationship(left: DataFrame, right: DataFrame, from_column: str, to_column: str,
                       how: str = "inner", *, skew_safe: bool = True, hot_share: int = 64,
                       salt_buckets: int = 32, keys_in: DataFrame | None = None) -> DataFrame:
    """Equi-join along a relationship (left.from_column = right.to_column).

    Both sides get column names of their own inside, so a table may be joined with itself and names may hold
    any character; the result has the left's columns, then the right's (left only for semi and anti joins).

    Skew: a key holding at least 1/hot_share of the left rows is hot; at most hot_share
    such keys exist (a proven bound) and they are found by one scan of the key with a
    bounded frequent-items aggregate (no shuffle, see ``skew.hot_keys``); a left side that is more than a scan
    is landed once, so it does not run twice, unless ``keys_in`` names a frame that holds the same keys as often and is
    scanned in its place (left, inner, semi and anti joins). Rows of hot and of null keys are spread over ``salt_buckets`` by
    the partition that holds them: equal rows spread too, and a retried task salts alike. Hot keys' right rows are
    replicated per salt with a generator (no cross join); null keys match nothing, so nothing is replicated for
    them; other keys keep salt 0. Right / full outer joins cannot be salted directly
    (replicated right rows would be emitted once per salt), so they are composed: the
    salted inner (right) or left (full) join, plus the right rows without a left
    partner, found by an anti join against the left's distinct keys (which partial
    aggregation collapses map-side). AQE could not split a skewed full outer join.
    """
    how_l = how.lower()
    fk, pk = _position(left, from_column), _position(right, to_column)
    own, other = [f"__l{i}" for i in range(len(left.columns))], [f"__r{i}" for i in range(len(right.columns))]
    l, r = left.toDF(*own), right.toDF(*other)
    names = left.columns if how_l in LEFT_ONLY_JOINS else left.columns + right.columns
    if skew_safe and how_l in RIGHT_KEEPING_JOINS:
        l = _read_once(l)
        options = {"hot_share": hot_share, "salt_buckets": salt_buckets}
        matched = _salted(l, r, own[fk], other[pk], RIGHT_KEEPING_JOINS[how_l], **options)
        alone = _salted(r, l.select(F.col(own[fk]).alias("__key")).distinct(), other[pk], "__key", "left_anti", **options)
        pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in l.schema.fields]
        return matched.union(alone.select(*pad, *other)).toDF(*names)
    if not skew_safe or how_l not in SALTABLE_JOINS:
        return l.join(r, l[own[fk]] == r[other[pk]], how).toDF(*names)
    hot = None
    if keys_in is not None:
        hot = hot_keys(keys_in.toDF(*[f"__k{i}" for i in range(len(keys_in.columns))]), f"__k{_position(keys_in, from_column)}", hot_share)
    return _salted(l if hot is not None else _read_once(l), r, own[fk], other[pk], how, hot_share=hot_share, salt_buckets=salt_buckets, hot=hot).toDF(*names)


def _salted(l: DataFrame, r: DataFrame, fk: str, pk: str, how: str, *, hot_share: int, salt_buckets: int, hot: list | None = None) -> DataFrame:
    hot = hot_keys(l, fk, hot_share) if hot is None else hot
    part = F.pmod(F.spark_partition_id(), F.lit(salt_buckets))
    l = l.withColumn("__salt_l", F.when(F.col(fk).isNull() | is_hot(F.col(fk), hot), part).otherwise(F.lit(0)))
    r = r.withColumn("__salt_r", F.explode(
        F.when(is_hot(F.col(pk), hot), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))))
    return l.join(r, (F.col(fk) == F.col(pk)) & (F.col("__salt_l") == F.col("__salt_r")), how).drop("__salt_l", "__salt_r")


def relationship_orphans(left: DataFrame, right: DataFrame, from_column: str, to_column: str,
                         name: str = "relationship") -> DataFrame:
    """Keys on either side without a partner: (relationship, side, orphan_keys, orphan_rows).

    One aggregation, no join: both sides are tagged, unioned and grouped by key,
    counting rows per side. Each task collapses its share of a key first, so a key
    holding a third of all rows is one row per task before the single shuffle.
    Null keys are not orphans (they relate to nothing by design).
    """
    lk = left.where(F.col(from_column).isNotNull()).select(F.col(from_column).alias("k"),
                                                           F.lit(1).alias("l"), F.lit(0).alias("r"))
    rk = right.where(F.col(to_column).isNotNull()).select(F.col(to_column).alias("k"),
                                                          F.lit(0).alias("l"), F.lit(1).alias("r"))
    per_key = lk.unionByName(rk).groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    summary = per_key.agg(
        F.count_if((F.col("l") > 0) & (F.col("r") == 0)).alias("from_keys"),
        F.coalesce(F.sum(F.when(F.col("r") == 0, F.col("l"))), F.lit(0)).cast("long").alias("from_rows"),
        F.count_if((F.col("r") > 0) & (F.col("l") == 0)).alias("to_keys"),
        F.coalesce(F.sum(F.when(F.col("l") == 0, F.col("r"))), F.lit(0)).cast("long").alias("to_rows"))
    return summary.select(F.lit(name).alias("relationship"), F.explode(F.array(
        F.struct(F.lit("from").alias("side"), F.col("from_keys").alias("orphan_keys"),
                 F.col("from_rows").alias("orphan_rows")),
        F.struct(F.lit("to").alias("side"), F.col("to_keys").alias("orphan_keys"),
                 F.col("to_rows").alias("orphan_rows")))).alias("x")) \
        .select("relationship", "x.side", "x.orphan_keys", "x.orphan_rows")


def _comparable(df: DataFrame, column: str):
    """A key as text that is equal exactly if the values are, with the kind of its type; numbers of any type compare as numbers."""
    field = df.schema.fields[_position(df, column)]
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        exact = isinstance(field.dataType, (T.IntegralType, T.DecimalType))
        return "number", (c.cast("decimal(38,10)").cast("string") if exact else F.coalesce(F.expr(f"try_cast(`{field.name}` AS decimal(38,10))").cast("string"), c.cast("string")))
    kind = "time" if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else field.dataType.simpleString()
    return kind, c.cast("string")


def all_orphans(tables: dict[str, DataFrame], relationships: list[tuple[str, str, str, str]]) -> DataFrame:
    """E4 for many relationships (from_table, from_column, to_table, to_column) at once: (relationship, side, orphan_keys, orphan_rows).

    Every table is read once, whatever the number of its relationships: each row gives a (value, column) entry per related column. One shuffle brings
    together, per value, how many rows each column has it in: an inverted index from which all relationships are answered. A value that
    fills a third of a column is one entry a task before the shuffle. Null keys relate to nothing. The number of columns is that of the relationships.
    """
    columns: dict[tuple[str, str], int] = {}
    for a, b, c, d in relationships:
        kinds = [_comparable(tables[t], x)[0] for t, x in ((a, b), (c, d))]
        if kinds[0] != kinds[1]:
            raise ValueError(f"{a}.{b} ({kinds[0]}) and {c}.{d} ({kinds[1]}) do not compare")
        columns.setdefault((a, b), len(columns))
        columns.setdefault((c, d), len(columns))
    entries = None
    for name in dict.fromkeys(t for t, _ in columns):
        own = [(n, _comparable(tables[name], x)) for (t, x), n in columns.items() if t == name]
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.concat(F.lit(kind + ":"), value).alias("k")) for n, (kind, value) in own]))
        part = tables[name].select(each.alias("e")).select("e.n", "e.k").where("k IS NOT NULL")
        entries = part if entries is None else entries.unionByName(part)
    index = entries.groupBy("k").agg(*[F.count_if(F.col("n") == n).alias(f"c{n}") for n in columns.values()])
    sums, labels = [], []
    for i, (a, b, c, d) in enumerate(relationships):
        f, t = F.col(f"c{columns[a, b]}"), F.col(f"c{columns[c, d]}")
        sums += [F.count_if((f > 0) & (t == 0)).alias(f"fk{i}"), F.coalesce(F.sum(F.when(t == 0, f)), F.lit(0)).alias(f"fr{i}"),
                 F.count_if((t > 0) & (f == 0)).alias(f"tk{i}"), F.coalesce(F.sum(F.when(f == 0, t)), F.lit(0)).alias(f"tr{i}")]
        name = F.lit(f"{a}.{b}->{c}.{d}").alias("relationship")
        labels += [F.struct(name, F.lit(s).alias("side"), F.col(f"{s[0]}k{i}").alias("orphan_keys"), F.col(f"{s[0]}r{i}").cast("long").alias("orphan_rows")) for s in ("from", "to")]
    return index.agg(*sums).select(F.explode(F.array(*labels)).alias("x")).select("x.*")


def _unique(df: DataFrame, column: str) -> bool:
    """Whether no non-null value of ``column`` repeats; a value is one row a task before the shuffle."""
    c = F.col(f"`{df.columns[_position(df, column)]}`")
    return not df.where(c.isNotNull()).groupBy(c.alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()


def _bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_plan(tables: dict[str, DataFrame], relationships: list[tuple[str, str, str, str]]) -> tuple[str, list[tuple[str, str, str, str]]]:
    """The table from which all others are looked up, and the hops (from_table, from_column, to_table, to_column) in the order to take them.

    The relationships, taken without direction, must form a tree over ``tables``: a cycle or a table that none of them reaches is refused, as two ways between
    tables, or none, give no single frame. Along every hop the far key must be unique (many to one), so a row of the first table
    stays one row; a graph without such a table is refused. Smaller tables are joined first.
    """
    edges = list(dict.fromkeys(relationships))
    near: dict[str, list[tuple[str, str, str]]] = {t: [] for t in tables}
    group = {t: t for t in tables}

    def root(t: str) -> str:
        while group[t] != t:
            t = group[t]
        return t
    for a, b, c, d in edges:
        if a not in tables or c not in tables:
            raise ValueError(f"relationship {a}.{b}->{c}.{d} names a table that is not there")
        if root(a) == root(c):
            raise ValueError(f"relationship {a}.{b}->{c}.{d} closes a cycle")
        group[root(a)] = root(c)
        near[a].append((b, c, d))
        near[c].append((d, a, b))
    apart = {root(t) for t in tables}
    if len(apart) > 1:
        raise ValueError(f"tables without a relationship between them: {sorted(apart)}")
    known: dict[tuple[str, str], bool] = {}

    def one(t: str, c: str) -> bool:
        if (t, c) not in known:
            known[t, c] = _unique(tables[t], c)
        return known[t, c]

    def hops(start: str):
        """(from, column, to, column) of the tree seen from ``start``, or None if a far key repeats."""
        out, seen, todo = [], {start}, [start]
        while todo:
            t = todo.pop()
            for own, other, far in near[t]:
                if other not in seen:
                    if not one(other, far):
                        return None
                    seen.add(other)
                    todo.append(other)
                    out.append((t, own, other, far))
        return out
    size = {t: _bytes(df) for t, df in tables.items()}
    for start in sorted(tables, key=lambda t: (-size[t], t)):  # the table with the most rows is the likeliest
        way = hops(start)
        if way is not None:
            break
    else:
        raise ValueError("no table from which all others are looked up: keys repeat on both sides of some relationship")
    ordered, joined = [], {start}
    while way:
        ready = [x for x in way if x[0] in joined]
        hop = min(ready, key=lambda x: (size[x[2]], x[2]))
        way.remove(hop)
        joined.add(hop[2])
        ordered.append(hop)
    return start, ordered


def join_graph(tables: dict[str, DataFrame], relationships: list[tuple[str, str, str, str]], **options) -> DataFrame:
    """E3 over a workbook's whole relationship graph: one frame with a row per row of the table that ``join_plan`` starts from, columns named
    ``table.column``; rows without a partner keep nulls. ``options`` go to ``apply_relationship``.

    Every table first gets those looked up from it, so a far table is joined to the table that names it, not to the rows of the first one; as a row
    of a table stays one row, the hot keys of a hop are those of the table itself. Nothing between the hops is landed, and columns that
    nobody reads are not shuffled."""
    tables = {t: _read_once(df) for t, df in tables.items()}

    def named(t: str) -> DataFrame:
        return tables[t].toDF(*[f"{t}.{c}" for c in tables[t].columns])

    def column(t: str, c: str) -> str:
        return f"{t}.{tables[t].columns[_position(tables[t], c)]}"
    start, ordered = join_plan(tables, relationships)
    order = [start, *[hop[2] for hop in ordered]]
    frames: dict[str, DataFrame] = {}
    for t in reversed(order):
        keys = frames[t] = named(t)
        for _, b, c, d in (hop for hop in ordered if hop[0] == t):
            frames[t] = apply_relationship(frames[t], frames.pop(c), column(t, b), column(c, d), "left", **{"keys_in": keys, **options})
    return frames[start].select(*[F.col(f"`{c}`") for t in order for c in named(t).columns])
