"""Exact order statistics and interpolated quantiles, distributed.

The values of all features are counted once into ``(feature, value, n)``.
The counts are dealt into ranges of values; the ranges' sums give each range
its first rank, and only the rows that hold a wanted rank are looked up. No
task holds more than its range, whatever the number of distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


class OrderStats:
    """Ranked values of several numeric columns; NaN and null are left out."""

    def __init__(self, df: DataFrame, columns: dict[str, Column]) -> None:
        pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), x.cast("double").alias("value")) for name, x in columns.items()]))
        counts = (df.select(pairs.alias("p")).select("p.feature", "p.value").where("value IS NOT NULL AND NOT isnan(value)")
                  .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
        ranged = cut_lineage(counts.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id()))
        # one row per feature and range
        first = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = ranged.groupBy("feature", "part").agg(F.sum("n").alias("own")).withColumn("start", F.coalesce(F.sum("own").over(first), F.lit(0)))
        within = Window.partitionBy("feature", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        # every look-up reads the ranks, so they are worked out once
        self.ranks = cut_lineage(ranged.join(starts, ["feature", "part"]).withColumn("stop", F.col("start") + F.sum("n").over(within))
                                 .select("feature", "value", "n", "stop"))
        self.spark = df.sparkSession
        self.total = {name: 0 for name in columns}
        self.total.update({r["feature"]: r["n"] for r in starts.groupBy("feature").agg(F.sum("own").alias("n")).collect()})

    def at(self, wanted: set[tuple[str, int]]) -> dict[tuple[str, int], float]:
        """Value at each (feature, rank), ranks from 0."""
        if not wanted:
            return {}
        ranks = self.spark.createDataFrame(sorted(wanted), "feature string, r long")
        rows = self.ranks.join(F.broadcast(ranks), "feature").where("r < stop AND r >= stop - n").select("feature", "r", "value")
        return {(x["feature"], x["r"]): x["value"] for x in rows.collect()}

    def below(self, limits: dict[str, float]) -> dict[str, int]:
        """Number of values strictly below each feature's limit."""
        if not limits:
            return {}
        rows = self.ranks.join(F.broadcast(self.spark.createDataFrame(sorted(limits.items()), "feature string, x double")), "feature")
        got = {r["feature"]: r["k"] for r in rows.where("value < x").groupBy("feature").agg(F.sum("n").alias("k")).collect()}
        return {f: got.get(f, 0) for f in limits}

    def quantiles(self, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
        """Linearly interpolated quantiles, as ``percentile`` gives them; None for a feature without values."""
        places = {f: [place(p, self.total[f]) for p in ps] if self.total[f] else [] for f, ps in wanted.items()}
        found = self.at({(f, r) for f, own in places.items() for lo, hi, _ in own for r in (lo, hi)})
        return {f: [blend(found[f, lo], found[f, hi], lo, hi, h) for lo, hi, h in own] if own else [None] * len(wanted[f]) for f, own in places.items()}


def place(p: float, n: int) -> tuple[int, int, float]:
    """Ranks on both sides of a quantile among ``n`` values, and its position."""
    h = (n - 1) * p
    return math.floor(h), math.ceil(h), h


def blend(low: float, high: float, lo: int, hi: int, h: float) -> float:
    return low if lo == hi or low == high else (hi - h) * low + (h - lo) * high


def quantiles(df: DataFrame, column: str | Column, ps: list[float]) -> list[float | None]:
    """Exact interpolated quantiles of one column."""
    x = F.col(column) if isinstance(column, str) else column
    return OrderStats(df, {"x": x}).quantiles({"x": ps})["x"]
