"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
supplied tables.  Column names match the oracle's aliases exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import mart
from ..sources import testdata as td

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import batch_queries  # noqa: F401
    from . import cdc_queries  # noqa: F401
    from . import quality_queries  # noqa: F401
    from . import synth_queries  # noqa: F401
    from . import stream_queries  # noqa: F401
    from . import io_queries  # noqa: F401


def staged(spark: SparkSession, sf_dir: str) -> mart.StagedTables:
    return mart.stage_all(td.raw_tables(spark, sf_dir))

