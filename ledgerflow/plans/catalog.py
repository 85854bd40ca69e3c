"""Registered queries: one per inventory ID, each ``(spark, sf_dir) -> DataFrame``,
with the DuckDB SQL that must give the same rows (``ORACLE``).

Conventions shared with the oracle SQL: money is summed as decimal(18,2)
and returned as double; dates are DATE; counts are BIGINT; ranks BIGINT;
ntile INT.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def _load_modules() -> None:
    # Importing the modules fills QUERIES / ORACLE.
    from . import q_business, q_relational, q_quality, q_dedup, q_model, q_io, q_stream, q_flows  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_modules()
    return dict(ORACLE)
