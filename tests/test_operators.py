"""Dedupe, catalog diff, relationships, control-table state, roll-ups."""
import datetime as dt

import pytest

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakewright.operators.control import (due_jobs, interval_text, jobs, public_view, registry_state, run_rollup,
                                          valid_config)
from lakewright.operators.dedupe import first_wins, first_wins_casefold, top_n_per_group
from lakewright.operators.profile import column_profile
from lakewright.operators.relate import apply_relationship, relationship_orphans
from lakewright.operators.sync import catalog_diff, column_diff


def test_first_wins_and_last(spark):
    df = spark.createDataFrame([("a", 2, 1, "x"), ("a", 1, 5, "y"), ("a", 1, 3, "z"), ("b", 0, 0, "w")],
                               "k string, f int, t int, v string")
    got = {r.k: r.v for r in first_wins(df, ["k"], ["f", "t"]).collect()}
    assert got == {"a": "z", "b": "w"}
    got = {r.k: r.v for r in first_wins(df, ["k"], ["f", "t"], last=True).collect()}
    assert got == {"a": "x", "b": "w"}


def test_casefold_first_spelling(spark):
    df = spark.createDataFrame([("Orders", 2), ("ORDERS", 1), ("x", 3)], "name string, pos int")
    assert sorted(tuple(r) for r in first_wins_casefold(df, "name", ["pos"]).collect()) == [("ORDERS", 1), ("x", 3)]


def test_top_n(spark):
    df = spark.range(20).select((F.col("id") % 2).alias("g"), F.col("id"))
    out = top_n_per_group(df, ["g"], [F.col("id").desc()], 3).orderBy("g", "rank").collect()
    assert [(r.g, r.id, r.rank) for r in out] == [(0, 18, 1), (0, 16, 2), (0, 14, 3), (1, 19, 1), (1, 17, 2), (1, 15, 3)]


names = st.lists(st.sampled_from(["a", "A", "b", "c", "C", "d"]), max_size=6)


@settings(max_examples=15, deadline=None)
@given(src=names, reg=names)
def test_catalog_diff_invariants(spark, src, reg):
    s = spark.createDataFrame([(x,) for x in src], "table_name string")
    r = spark.createDataFrame([(x,) for x in reg], "table_name string")
    d = {(row.table_name.lower(), row.change) for row in catalog_diff(s, r).collect()}
    added = {k for k, c in d if c == "added"}
    removed = {k for k, c in d if c == "removed"}
    kept = {k for k, c in d if c == "kept"}
    assert added | kept == {x.lower() for x in src}
    assert removed | kept == {x.lower() for x in reg}
    assert not (added & removed) and not (added & kept) and not (removed & kept)


def test_column_diff(spark):
    a = spark.sql("SELECT 1 AS id, 'x' AS name, 1.0D AS price").schema
    b = spark.sql("SELECT 1L AS ID, 1.0D AS price, 'n' AS note").schema
    got = {r["column"].lower(): r["change"] for r in column_diff(a, b)}
    assert got == {"id": "retyped", "name": "removed", "price": "same", "note": "added"}


def test_orphans_and_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "fk long")
    right = spark.createDataFrame([(1,), (2,), (3,)], "pk long")
    got = {r.side: (r.orphan_keys, r.orphan_rows) for r in relationship_orphans(left, right, "fk", "pk").collect()}
    assert got == {"from": (1, 1), "to": (1, 1)}
    assert apply_relationship(left, right, "fk", "pk").count() == 3


def _log(spark, rows):
    return spark.createDataFrame(rows, "workbook_name string, seq long, op string, ts timestamp, status string, "
                                       "error string, source_type string, refresh_interval_minutes int, "
                                       "enable_scheduled_refresh boolean, has_secret boolean")


def test_registry_state_fold(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [
        ("a", 1, "refresh", t(1), "success", None, None, None, None, None),      # before register: ignored
        ("a", 2, "register", t(2), None, None, "snowflake", 10, True, True),
        ("a", 3, "refresh", t(3), "failed", "boom", None, None, None, None),
        ("a", 4, "patch", t(4), None, None, None, 30, None, None),
        ("a", 5, "refresh", t(5), "success", None, None, None, None, None),
        ("b", 1, "register", t(1), None, None, "sqlserver", None, False, False),
        ("b", 2, "delete", t(2), None, None, None, None, None, None),
        ("c", 1, "register", t(1), None, None, "databricks", 5, True, False),
        ("c", 2, "refresh", t(2), "success", None, None, None, None, None),
        ("c", 3, "delete", t(3), None, None, None, None, None, None),
        ("c", 4, "register", t(4), None, None, "databricks", 5, True, False),   # re-register resets counters
    ]
    st_ = registry_state(_log(spark, rows), ["source_type", "refresh_interval_minutes", "enable_scheduled_refresh",
                                             "has_secret"], ["refresh_interval_minutes"])
    got = {r.workbook_name: r for r in st_.collect()}
    assert set(got) == {"a", "c"}
    a = got["a"]
    assert (a.refresh_count, a.last_refresh_status, a.last_refresh_error, a.refresh_interval_minutes) == \
        (2, "success", None, 30)
    assert got["c"].refresh_count == 0 and got["c"].last_refreshed_at is None
    pv = public_view(st_).collect()
    assert "has_secret" not in pv[0].asDict() and {r.workbook_name: r.has_stored_credentials for r in pv} == \
        {"a": True, "c": False}
    j = {r.workbook_name: r for r in jobs(st_).collect()}
    assert j["a"].trigger == "interval[0:30:00]" and j["a"].next_run == t(35)
    due = {r.workbook_name: r.action for r in due_jobs(jobs(st_), F.lit(t(45))).collect()}
    assert due == {"a": "missed", "c": "missed"}
    due = {r.workbook_name: r.action for r in due_jobs(jobs(st_), F.lit(t(36))).collect()}
    assert due == {"a": "run", "c": "missed"}


def test_interval_text_and_config(spark):
    df = spark.createDataFrame([(5,), (90,), (1500,), (2890,)], "m int")
    assert [r[0] for r in df.select(interval_text(F.col("m"))).collect()] == \
        ["interval[0:05:00]", "interval[1:30:00]", "interval[1 day, 1:00:00]", "interval[2 days, 0:10:00]"]
    cfg = spark.createDataFrame([(True, None), (True, 3), (True, 5), (False, None)], "e boolean, i int")
    valid, reason = valid_config(F.col("e"), F.col("i"))
    assert [r[0] for r in cfg.select(valid).collect()] == [False, False, True, True]


def test_run_rollup(spark):
    log = spark.createDataFrame([("r1", "t1", 0, 5, "success", None), ("r1", "t2", 1, 0, "failed", "x"),
                                 ("r1", "t0", 2, 0, "failed", "y"), ("r2", "t1", 0, 3, "skipped_empty", None),
                                 ("r3", "t1", 0, 0, "failed", "z")],
                                "run_id string, table_name string, pos int, rows long, status string, error string")
    got = {r.run_id: r for r in run_rollup(log).collect()}
    assert (got["r1"].status, got["r1"].error_summary, got["r1"].total_rows) == ("partial", "t2: x; t0: y", 5)
    assert got["r2"].status == "success" and got["r3"].status == "failed"
    assert {r.run_id: r.status for r in run_rollup(log, flow="migrate").collect()}["r3"] == "partial"


def test_column_profile(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 00:00:00'), (NULL, timestamp_ntz'2024-01-02 00:00:00') AS t(a, b)")
    got = {r.column_name: (r.n_rows, r.n_nulls, r.all_midnight) for r in column_profile(df).collect()}
    assert got == {"a": (2, 1, None), "b": (2, 0, True)}


def test_registered_only_and_declared_lookup(spark):
    from lakewright.operators.sync import registered_only
    from lakewright.operators.typing import declared_lookup
    cat = spark.createDataFrame([("a", 0), ("b", 1), ("C", 2)], "clean_name string, table_idx int")
    reg = spark.createDataFrame([("a",), ("c",)], "table_name string")
    assert [r.clean_name for r in registered_only(cat, reg).collect()] == ["a"]
    tc = spark.createDataFrame([("w", "t", "ID"), ("w", "t", "X")], "workbook string, table_name string, column string")
    wc = spark.createDataFrame([("w", "ID", "integer", 0)], "workbook string, column string, declared_type string, pos int")
    got = {r.column: (r.declared_type, r.spark_type) for r in declared_lookup(tc, wc).collect()}
    assert got == {"ID": ("integer", "BIGINT"), "X": (None, None)}


ops = st.sampled_from(["register", "refresh", "patch", "delete"])
events = st.lists(st.tuples(st.sampled_from(["w1", "w2", "w3"]), ops, st.integers(5, 60),
                            st.sampled_from(["success", "failed"])), min_size=1, max_size=25)


def _fold(evs):
    """Brute-force reference: replay events in order on a dict, like the original registry."""
    state = {}
    for seq, (wb, op, n, status) in enumerate(evs):
        if op == "register":
            state[wb] = {"interval": n, "count": 0, "status": None, "reg": seq}
        elif op == "refresh" and wb in state:
            state[wb]["count"] += 1
            state[wb]["status"] = status
        elif op == "patch" and wb in state:
            state[wb]["interval"] = n
        elif op == "delete":
            state.pop(wb, None)
    return {k: (v["interval"], v["count"], v["status"]) for k, v in state.items()}


@settings(max_examples=12, deadline=None)
@given(evs=events, parts=st.integers(1, 5))
def test_registry_state_matches_replay_in_any_partitioning(spark, evs, parts):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(wb, seq, op, t0 + dt.timedelta(minutes=seq), status if op == "refresh" else None, None, None,
             n if op in ("register", "patch") else None, None, None)
            for seq, (wb, op, n, status) in enumerate(evs)]
    log = _log(spark, rows).repartition(parts)
    got = {r.workbook_name: (r.refresh_interval_minutes, r.refresh_count, r.last_refresh_status)
           for r in registry_state(log, ["refresh_interval_minutes"], ["refresh_interval_minutes"]).collect()}
    assert got == _fold(evs)


def test_relationship_join_salts_hot_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("fk"),
                                    F.col("id"))
    right = spark.range(60).select(F.col("id").alias("pk"), (F.col("id") * 10).alias("v"))
    plain = sorted(tuple(r) for r in left.join(right, left.fk == right.pk).collect())
    for how in ("inner", "left"):
        salted = apply_relationship(left, right, "fk", "pk", how)
        assert salted.columns == ["fk", "id", "pk", "v"]
        got = sorted(tuple(r) for r in salted.collect())
        want = plain if how == "inner" else sorted(tuple(r) for r in left.join(right, left.fk == right.pk, "left").collect())
        assert got == want
    anti = apply_relationship(right, left, "pk", "fk", "left_anti")
    assert sorted(r.pk for r in anti.collect()) == list(range(50, 60))


def test_hot_keys_bounded_and_complete(spark):
    from lakewright.operators.skew import hot_keys
    # key 7 holds a third of the rows, key 8 a tenth; the rest are spread thin
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(8))
                                   .otherwise(F.col("id") + 100).alias("k")).repartition(6)
    hot = hot_keys(df.unionByName(spark.range(5).select(F.lit(None).cast("long").alias("k"))), "k", 16)
    assert 7 in hot and 8 in hot and None not in hot
    assert len(hot) <= 16
    assert hot_keys(df.where("k < 0"), "k", 16) == []


def test_relationship_right_and_full_outer_are_composed_skew_safe(spark):
    # key 7 holds a third of the left rows; nulls and unmatched keys on both sides
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 97 == 1, F.lit(None))
        .otherwise(F.col("id") % 50).alias("fk"), F.col("id"))
    right = spark.range(40, 80).select(F.when(F.col("id") == 79, F.lit(None)).otherwise(F.col("id")).alias("pk"),
                                       (F.col("id") * 10).alias("v")) \
        .unionByName(spark.createDataFrame([(7, 70)], "pk long, v long"))
    for how in ("right", "full", "full_outer", "right_outer"):
        got = apply_relationship(left, right, "fk", "pk", how)
        assert got.columns == ["fk", "id", "pk", "v"]
        want = left.join(right, left.fk == right.pk, how)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = apply_relationship(left, right, "fk", "pk", "full")._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_current_tables_keeps_source_list_and_filter(spark):
    from lakewright.operators.sync import catalog_diff, current_tables
    src = spark.createDataFrame([("a",), ("B",), ("c",)], "table_name string")
    reg = spark.createDataFrame([("b",), ("d",)], "table_name string")
    diff = catalog_diff(src, reg)
    assert sorted(r.table_name for r in current_tables(diff).collect()) == ["B", "a", "c"]
    assert sorted(r.table_name for r in current_tables(diff, ["a", "B"]).collect()) == ["B", "a"]


def test_relationship_on_awkward_inputs(spark):
    """A map column, a table joined with itself, dotted names, null and repeated hot keys, every join type."""
    staff = spark.createDataFrame([(1, None, {"a": 1}), (2, 1, {}), (3, 1, None), (4, 9, {})], "id int, `boss.id` int, tags map<string,int>")
    out = apply_relationship(staff, staff, "boss.id", "id", "left")
    assert out.columns == ["id", "boss.id", "tags"] * 2
    assert sorted((r[0], r[3]) for r in out.collect()) == [(1, None), (2, 1), (3, 1), (4, None)]
    left = spark.createDataFrame([(None if i % 3 == 0 else 7 if i % 3 == 1 else i,) for i in range(300)], "k int").repartition(6)
    right = spark.createDataFrame([(7, "x"), (8, "y"), (1000, "z"), (None, "n")], "k int, v string")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        got = apply_relationship(left, right, "k", "k", how, hot_share=4)
        want = left.toDF("a").join(right.toDF("b", "v"), F.col("a") == F.col("b"), how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF(*got.columns).collect())), how
    with pytest.raises(ValueError, match="is not one of"):
        apply_relationship(left, right, "nope", "k")


def test_hot_and_null_keys_spread(spark):
    """Neither null keys nor repeated rows of a hot key end in one task."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in (F.lit(None).cast("long"), F.lit(5).cast("long")):
            left = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 2 == 0, key).otherwise(F.col("id") % 100).alias("k"))
            out = apply_relationship(left, spark.range(100).toDF("k"), "k", "k", "left")
            sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert max(sizes) < 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
