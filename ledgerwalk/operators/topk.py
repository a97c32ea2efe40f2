"""Top-1 per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """The first row per ``key`` by ``order`` (which must be total inside a key).

    ``row_number() == 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most one row per key: a hot key does
    not reach the exchange with all of its rows.
    """
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.select("*", F.row_number().over(w).alias("_rn"))
    return ranked.filter(F.col("_rn") == 1).select(*df.columns)
