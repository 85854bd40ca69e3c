"""Cleaning (CL-1, CL-2): fill missing values, standardise categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import join_back


def fill_missing(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """NULLs of each column replaced by an expression over the same row."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()})


def fill_by_group(df: DataFrame, col: str, by: Sequence[str], value: Column, flag: str | None = None) -> DataFrame:
    """NULLs of ``col`` replaced by ``value``, an aggregate over the group's
    rows (such as its mean). One partial aggregate and a join back, so a hot
    group is one row on the small side; a group with no values stays NULL.
    ``flag`` names a column that tells filled rows."""
    per = df.groupBy(*by).agg(value.alias("_fill"))
    x = join_back(df, per, by, "left")
    filled = F.coalesce(F.col(col), F.col("_fill").cast(df.schema[col].dataType))
    cols = [filled.alias(c) if c == col else F.col(c) for c in df.columns]
    if flag:
        cols.append((F.col(col).isNull() & F.col("_fill").isNotNull()).alias(flag))
    return x.select(*cols)


def standardise(df: DataFrame, col: str, mapping: Mapping[str, str], other: str | None = None) -> DataFrame:
    """Spellings of a category mapped to its standard name; case and outer or
    repeated blanks are ignored. Unmapped values become ``other`` or, without
    one, stay as they are; NULL stays NULL."""
    key = F.lower(F.trim(F.regexp_replace(F.col(col), r"\s+", " ")))
    names = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k.lower(), v)])
    rest = F.col(col) if other is None else F.lit(other)
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.coalesce(F.try_element_at(names, key), rest)))
