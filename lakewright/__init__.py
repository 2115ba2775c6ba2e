"""lakewright: bring the tables behind BI workbooks into lakehouse tables with Spark.

Layout
------
functions/  Column builders: identifiers, declared types, coercion rules, XML helpers.
operators/  DataFrame operators: profile, typed projection, dedupe, catalog diff,
            relationship checks, control-table state, workbook corpus extraction.
sources/    Table sources: directory of table files, JDBC, Spark catalog, workbook files.
sinks/      Staged overwrite with row metrics, drop/list targets, namespaces.
plans/      Ingest and refresh flows built from the pieces above.
streaming/  Incremental refresh and change-notice streams.
suite/      The registered check queries (Spark side and oracle SQL).
"""

from lakewright.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
