"""All relationships of a workbook at once: orphans from one index, the join over the graph."""
import pytest
from pyspark.sql import functions as F

from lakewright.operators.relate import all_orphans, join_graph, join_plan, relationship_orphans


@pytest.fixture
def tables(spark):
    fact = spark.range(900).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("int").alias("dim"),
                                   (F.col("id") % 7).cast("decimal(5,0)").alias("kind"))
    dim = spark.range(1, 30).select(F.col("id").alias("key"), (F.col("id") % 4).alias("region"), F.lit("x").alias("id"))
    return {"fact": fact, "dim": dim, "kind": spark.createDataFrame([(float(i), f"k{i}") for i in range(5)], "k double, name string"),
            "region": spark.createDataFrame([(i, f"r{i}") for i in (0, 1, 2, 9)], "r bigint, name string")}


EDGES = [("fact", "dim", "dim", "key"), ("kind", "k", "fact", "kind"), ("dim", "region", "region", "r")]


def test_index_answers_as_single_runs_do(tables):
    got = {(r.relationship, r.side): (r.orphan_keys, r.orphan_rows) for r in all_orphans(tables, EDGES).collect()}
    for a, b, c, d in EDGES:
        name = f"{a}.{b}->{c}.{d}"
        left, right = (tables[t].withColumn(x, F.col(x).cast("double")) for t, x in ((a, b), (c, d)))
        for r in relationship_orphans(left, right, b, d, name).collect():
            assert got.pop((name, r.side)) == (r.orphan_keys, r.orphan_rows)
    assert not got
    with pytest.raises(ValueError, match="do not compare"):
        all_orphans(tables, [("fact", "dim", "kind", "name")])


def test_graph_gives_one_row_a_fact(tables):
    start, hops = join_plan(tables, EDGES)
    assert start == "fact" and {h[2] for h in hops} == {"dim", "kind", "region"} and [h[2] for h in hops].index("dim") < [h[2] for h in hops].index("region")
    j = join_graph(tables, EDGES)
    assert j.count() == 900 and set(j.columns) == {f"{t}.{c}" for t, df in tables.items() for c in df.columns}
    row = j.where("`fact.id` = 5").first()
    assert (row["dim.key"], row["region.name"], row["kind.name"]) == (5, "r1", None)
    assert j.where("`fact.dim` IS NULL AND `dim.key` IS NOT NULL").count() == 0


def test_bad_graphs_are_refused(spark, tables):
    with pytest.raises(ValueError, match="cycle"):
        join_plan(tables, EDGES + [("fact", "id", "region", "r")])
    with pytest.raises(ValueError, match="without a relationship"):
        join_plan(tables, EDGES[:2])
    with pytest.raises(ValueError, match="not there"):
        join_plan(tables, EDGES + [("fact", "id", "nowhere", "r")])
    many = spark.createDataFrame([(1,), (1,)], "r bigint")
    with pytest.raises(ValueError, match="both sides"):
        join_plan({**tables, "region": many}, EDGES)


def test_graph_lands_nothing_between_hops(tables, monkeypatch):
    """Tables that are plain scans are joined as they are, far ones first; hot keys come from the tables themselves."""
    from lakewright.operators import relate

    def landed(*args, **options):
        raise AssertionError("a join was landed")
    asked = []
    monkeypatch.setattr(relate, "scratch_path", landed)
    monkeypatch.setattr(relate, "hot_keys", lambda df, column, share, own=relate.hot_keys: asked.append("Join" in df._jdf.queryExecution().optimizedPlan().toString()) or own(df, column, share))
    j = join_graph(tables, EDGES)
    assert asked == [False] * 3 and j.count() == 900
    want = {i: f"r{i % 4}" if i % 4 in (0, 1, 2) else None for i in range(1, 30)}
    assert {(r[0], r[1]) for r in j.select("`dim.key`", "`region.name`").distinct().collect()} == {(None, None)} | set(want.items()) - {x for x in want.items() if x[0] not in {r.dim for r in tables["fact"].select("dim").distinct().collect()}}
