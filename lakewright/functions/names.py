"""Identifier and text helpers (J1-J16) as Column expressions.

All functions take and return ``Column``; strings are accepted as column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the workbook / extract conventions.
EXTRACT_CSV_MARK = ".csv_"                 # raw extract names: "<name>.csv_<32 hex>"
HEX32_SUFFIX = r"(?i)_[0-9A-F]{32}$"       # "<name>_<32 hex>" (any case)
DEFAULT_TABLE_NAME = "table"               # blank clean name
AZURE_SQL_HOST_MARK = ".database.windows.net"
SYSTEM_SCHEMAS = ["public", "information_schema", "pg_catalog", "sys", "extract"]
JOB_ID_PREFIX = "refresh__"
JOB_NAME_PREFIX = "Refresh: "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_stem(path) -> Column:
    """Last path segment without its final extension (leading dots are not an extension)."""
    base = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    stem = F.regexp_extract(base, r"^(\.*[^.].*)\.[^.]*$", 1)
    return F.when(stem != "", stem).otherwise(base)


def file_suffix_is(path, *suffixes: str) -> Column:
    """Case-insensitive suffix test."""
    low = F.lower(_c(path))
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | low.endswith(s.lower())
    return cond


def strip_quotes(name) -> Column:
    """Drop every leading and trailing double quote."""
    return F.btrim(_c(name), F.lit('"'))


def clean_extract_name(raw) -> Column:
    """Clean a raw extract table name.

    ``x.csv_<anything>`` -> ``x``; otherwise drop a ``_<32 hex>`` suffix (any case),
    then a trailing ``.csv`` (any case); a blank result becomes ``table``.
    """
    r = _c(raw)
    no_hex = F.regexp_replace(r, HEX32_SUFFIX, "")
    no_csv = F.regexp_replace(no_hex, r"(?i)\.csv$", "")
    return (F.when(r.contains(EXTRACT_CSV_MARK), F.substring_index(r, EXTRACT_CSV_MARK, 1))
            .when(no_csv == "", F.lit(DEFAULT_TABLE_NAME))
            .otherwise(no_csv))


def strip_brackets(name) -> Column:
    """Drop every leading and trailing '[' / ']'."""
    return F.btrim(_c(name), F.lit("[]"))


def last_name_part(raw) -> Column:
    """``[schema].[table]`` -> ``table``; ``[table]`` -> ``table``."""
    return F.substring_index(strip_brackets(raw), "].[", -1)


def relationship_column(op) -> Column:
    """``[COL (TABLE)]`` -> ``COL``."""
    return F.trim(F.substring_index(strip_brackets(op), "(", 1))


def relationship_table(object_id) -> Column:
    """J6 (our rule): drop a ``_<32 hex>`` object suffix, cut at '(' and trim."""
    return F.trim(F.substring_index(F.regexp_replace(_c(object_id), HEX32_SUFFIX, ""), "(", 1))


def server_account(server) -> Column:
    """Text before the first dot; blank -> null."""
    s = _c(server)
    return F.when(F.coalesce(s, F.lit("")) != "", F.substring_index(s, ".", 1))


def is_azure_host(server) -> Column:
    """Cloud vs on-prem SQL Server by host name."""
    return F.coalesce(_c(server), F.lit("")).contains(AZURE_SQL_HOST_MARK)


def first_non_empty(*cols) -> Column:
    """First argument that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def quote_ident(name: str, q: str = '"') -> str:
    """Quote one identifier, doubling the quote character inside it."""
    return f"{q}{name.replace(q, q + q)}{q}"


def qualified_name(table: str, schema: str | None = None, catalog: str | None = None, q: str = "`") -> str:
    """1-3 part quoted name. Catalog is used only together with a schema."""
    parts = [p for p in ([catalog, schema] if catalog and schema else [schema]) if p] + [table]
    return ".".join(quote_ident(p, q) for p in parts)


def job_id(workbook) -> Column:
    """Scheduler job id for a workbook."""
    return F.concat(F.lit(JOB_ID_PREFIX), _c(workbook))


def job_name(workbook) -> Column:
    return F.concat(F.lit(JOB_NAME_PREFIX), _c(workbook))


def thousands(n) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(_c(n), 0)


def is_system_schema(name) -> Column:
    """System / default schema names."""
    return F.lower(_c(name)).isin(*SYSTEM_SCHEMAS)
