"""Kept profiles of files (D11, D12, D18): a table's column-wide facts from those of its files, of which only new ones are read.

The facts behind ``coerce_table`` (blockers, least and greatest shape, all at midnight) merge, so they are kept per file, under the
file's name, size and time and the settings they were taken with. A later run profiles the files that it has no facts of and merges; facts of files
that are gone are left out and dropped. Decisions are those of a profile of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.operators.profile import merged

SCHEMA = "file string, length long, modified long, stage int, settings string, facts map<string,int>"
FILE = "__file"


class FileProfiles:
    """A ``profiler`` for one table of a directory source. ``store`` holds the facts; ``profiled`` counts the files that were read."""

    def __init__(self, source, table: str, store, settings: str):
        self.source, self.table, self.store, self.settings = source, table, store, settings
        self.spark, self.profiled, self.fresh = source.spark, 0, {}

    def _kept(self) -> DataFrame:
        path = self.store.current()
        return self.spark.createDataFrame([], SCHEMA) if path is None else self.spark.read.schema(SCHEMA).parquet(path)

    def __call__(self, prepare, aggs: dict, stage: int) -> dict:
        if not aggs:
            return {}
        # one row a file; the listing is what the reader holds on the driver anyway
        files = self.spark.createDataFrame(self.source.files(self.table), "file string, length long, modified long")
        kept = self._kept().where((F.col("stage") == stage) & (F.col("settings") == self.settings))
        here = kept.join(files, ["file", "length", "modified"], "left_semi")
        new = files.join(kept, ["file", "length", "modified"], "left_anti").collect()
        states = here
        if new:
            self.profiled += len(new)
            rows = prepare(self.source.read_files(self.table, [r.file for r in new], FILE))
            facts = rows.groupBy(FILE).agg(*[c.cast("int").alias(k) for k, c in aggs.items()])
            as_map = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in aggs]), lambda e: e["value"].isNotNull()))
            found = facts.select(F.col(FILE).alias("file"), as_map.alias("facts"))
            # files without rows have no facts
            found = files.join(self.spark.createDataFrame(new), ["file", "length", "modified"], "left_semi").join(found, "file", "left")
            found = found.select("file", "length", "modified", F.lit(stage).alias("stage"), F.lit(self.settings).alias("settings"),
                                 F.coalesce("facts", F.create_map().cast("map<string,int>")).alias("facts"))
            others = self._kept().where((F.col("stage") != stage) & (F.col("settings") == self.settings))
            self.store.replace(others.unionByName(here.select(*others.columns)).unionByName(found))
            states = self._kept().where((F.col("stage") == stage) & (F.col("settings") == self.settings))
        return merged(states, list(aggs))
