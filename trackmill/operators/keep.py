"""Keeping one version of a row, and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.plans.unified import DEDUP_KEYS, SORT_KEYS


def keep_last(df: DataFrame, keys: Sequence[str] | None = DEDUP_KEYS, order: Sequence[str] = ("_seq",)) -> DataFrame:
    """One row per key, the last by order; null equals null in keys. Without keys, whole rows are the key.

    Versions that order leaves equal are settled by a hash of their values, so that reruns agree. A max_by over one struct aggregates on the map side first, so versions of a row are not all shuffled.
    """
    if keys is None:
        return df.drop(*order).distinct()
    rest = [c for c in df.columns if c not in keys and c not in order]
    plain = [c for c in rest if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    place = F.struct(*order, F.xxhash64(*plain).alias("_tie") if plain else F.lit(0).alias("_tie"))
    last = df.groupBy(*keys).agg(F.max_by(F.struct(F.lit(1).alias("_"), *rest), place).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns if c not in order])


def sort_telemetry(df: DataFrame) -> DataFrame:
    """By provider, vehicle and time, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in SORT_KEYS])
