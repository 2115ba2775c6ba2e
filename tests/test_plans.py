"""Scale properties read off the physical plans: partial aggregation before every shuffle,
top-N limited per group before the shuffle, one shuffle for diff / orphans, pruned scans."""
import re

from pyspark.sql import functions as F

from lakewright.operators.control import registry_state
from lakewright.operators.dedupe import first_wins, top_n_per_group
from lakewright.operators.relate import relationship_orphans
from lakewright.operators.sync import catalog_diff
from lakewright.operators.typing import coerce_table
from lakewright.suite.inputs import events_as_control_log

from conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_is_partially_aggregated(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    p = plan(first_wins(part, ["p_name"], ["p_size", "p_partkey"]))
    assert "partial_min" in p and p.index("partial_min") > p.index("Exchange")   # partial below the exchange
    assert "Window" not in p


def test_top_n_limits_before_shuffle(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    p = plan(top_n_per_group(ev, ["user_id"], [F.col("ts").desc()], 5))
    assert p.count("WindowGroupLimit") == 2          # partial (map side) + final


def test_diff_and_orphans_shuffle_once_without_joins(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    d = catalog_diff(part.select(F.col("p_name").alias("table_name")),
                     part.select(F.upper("p_name").alias("table_name")))
    p = plan(d)
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p and "partial_" in p
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    p = plan(relationship_orphans(li, part, "l_partkey", "p_partkey"))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 1
    assert re.search(r"ReadSchema: struct<l_partkey:bigint>", p)         # only the key column is read


def test_registry_state_aggregates_partially(spark):
    log = events_as_control_log(spark.read.parquet(f"{SF001}/events.parquet"))
    p = plan(registry_state(log, ["source_type"], []))
    assert "partial_max_by" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_typed_projection_prunes_and_stays_in_one_stage(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    text = li.select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_shipdate").cast("string").alias("d"))
    typed = coerce_table(text, {"k": "integer", "d": "date"}, sniff="none")
    p = plan(typed.df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p
    assert "Exchange" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
