"""Target encodings (AGG-01..06, JOIN-01/02, FN-10/12, PRJ-09).

All categorical features are encoded from **one** aggregation: each row is
unpivoted into ``(feature, key)`` pairs and grouped once, with map-side partial
aggregation, instead of one shuffle per feature. Numeric features are cut
into quantile bins whose index joins the same stack, so the bin means come
from the same pass. The per-feature maps are joined back: broadcast while the
maps' bytes (measured, not guessed) are under a bound — tiny maps as
literal lookups without any join — otherwise a shuffle join that AQE can
split on a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalar import UNKNOWN, clip, to_number
from .quantiles import OrderStats, blend, place


def category_key(c: str) -> Column:
    """Encoding key: the value as text, missing → 'Unknown' (FN-06)."""
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))


def smoothed(mean: Column, n: Column, global_mean: float, min_samples: int) -> Column:
    """AGG-02: fewer than ``min_samples`` rows → (mean·n + g·m)/(n + m), else mean."""
    g = F.lit(float(global_mean))
    m = F.lit(float(min_samples))
    return F.when(n < min_samples, (mean * n + g * m) / (n + m)).otherwise(mean)


def global_mean(df: DataFrame, target: str) -> float | None:
    """AGG-03 (one scalar)."""
    v = df.agg(F.avg(target)).first()[0]
    return None if v is None else float(v)


@dataclass
class NumericBins:
    """Per-feature cut: IQR fence, median fill and quantile edges (AGG-04/05)."""
    lower: float | None
    upper: float | None
    median: float | None
    edges: list | None  # sorted distinct edges; None → everything gets the global mean


def equal_width_edges(lo: float, hi: float, num_bins: int) -> list[float]:
    """AGG-06: edges of equally wide bins over [lo, hi]."""
    return [lo + i * (hi - lo) / num_bins for i in range(num_bins)] + [hi]


def fit_numeric_bins(df: DataFrame, features: list[str], num_bins: int = 10, mean_of: str | None = None,
                     fence: float | None = 1.5, min_edges: int = 2):
    """Quartiles, median of the clipped values and quantile edges of the
    filled values, for all features from one table of value counts.

    Values are clipped to ``fence`` interquartile ranges beyond the quartiles (None: not at all). Where
    fewer than ``min_edges`` distinct quantile edges are left, bins are equally wide instead (AGG-06).

    Clipping keeps the order of values, and filling puts the missing ones at
    the median, so the later steps only look up other ranks of the same
    counts. All quantiles are exact and interpolate linearly.

    With ``mean_of`` the mean of that column (AGG-03) is computed as well and
    ``(bins, mean)`` is returned.
    """
    numeric_types = {t.name for t in df.schema if isinstance(t.dataType, NumericType)}
    xs = {f: F.col(f).cast("double") if f in numeric_types else to_number(f) for f in features}
    first = [F.count(F.lit(1)).alias("_rows")] + ([F.avg(mean_of).alias("_mean")] if mean_of is not None else [])
    row = df.agg(*first).first()
    mean = None if mean_of is None or row["_mean"] is None else float(row["_mean"])
    if not features:
        return ({}, mean) if mean_of is not None else {}
    stats = OrderStats(df, xs)
    bounds, med = {}, {}
    for f, (q1, q3) in stats.quantiles({f: [0.25, 0.75] for f in features}).items():
        bounds[f] = (None, None) if q1 is None or fence is None else (q1 - fence * (q3 - q1), q3 + fence * (q3 - q1))
    full = [f for f in features if stats.total[f]]

    def clipped(f: str, v: float) -> float:
        lo, hi = bounds[f]
        return v if lo is None else min(max(v, lo), hi)

    middle = {f: place(0.5, stats.total[f]) for f in full}
    found = stats.at({(f, r) for f in full for r in middle[f][:2]})
    for f in full:
        lo, hi, h = middle[f]
        med[f] = blend(clipped(f, found[f, lo]), clipped(f, found[f, hi]), lo, hi, h)
    missing = {f: row["_rows"] - stats.total[f] for f in full}
    # clipping moves nothing across a value between the bounds, and the median is one
    before = stats.below(med)
    probs = [i / num_bins for i in range(num_bins + 1)]

    def own_rank(f: str, r: int) -> int | None:
        """Rank among the feature's values of rank ``r`` among all rows; None for a filled row."""
        return r if r < before[f] else None if r < before[f] + missing[f] else r - missing[f]

    spots = {f: [place(p, row["_rows"]) for p in probs] for f in full}
    found = stats.at({(f, k) for f in full for spot in spots[f] for r in spot[:2] if (k := own_rank(f, r)) is not None})
    out = {}
    for f in features:
        edges = None
        if f in full:
            def value(r: int) -> float:
                k = own_rank(f, r)
                return med[f] if k is None else clipped(f, found[f, k])
            uniq = sorted({blend(value(lo), value(hi), lo, hi, h) for lo, hi, h in spots[f]})
            # the first and last edges are the least and the greatest value
            edges = uniq if len(uniq) >= min_edges else equal_width_edges(uniq[0], uniq[-1], num_bins) if len(uniq) >= 2 else None
        out[f] = NumericBins(bounds[f][0], bounds[f][1], med.get(f), edges)
    return (out, mean) if mean_of is not None else out


def numeric_value(f: str, nb: NumericBins, already_numeric: bool = False) -> Column:
    """FN-07 → FN-09 → FN-10: numeric, clipped to the fence, median-filled."""
    x = clip(F.col(f).cast("double") if already_numeric else to_number(f), nb.lower, nb.upper)
    return F.coalesce(x, F.lit(nb.median).cast("double")) if nb.median is not None else x


def bin_index(x: Column, nb: NumericBins) -> Column:
    """Right-closed bins, lowest edge included: index = #(edges < x) − 1, ≥ 0."""
    if nb.edges is None:
        return F.lit(None).cast("int")
    edges = F.array(*[F.lit(float(e)) for e in nb.edges])
    return F.greatest(F.size(F.filter(edges, lambda e: e < x)) - 1, F.lit(0))


# Between the parts of a joint key; no number's text holds it.
_JOINT = "\x1f"


def encoding_maps(df: DataFrame, categorical: list[str], binned: dict[str, Column],
                  target: str, min_samples: int, g: float, joint=()) -> DataFrame:
    """One grouped pass for every feature: ``(feature, key, n, mean, enc)``.

    ``categorical`` are encoded by category with smoothing (AGG-02);
    ``binned`` maps a feature to its bin-index column, encoded by the plain
    bin mean (AGG-05). ``joint`` are tuples of numeric categorical features with few
    combinations, such as the parts of a date: rows are counted by
    combination, and the combinations are counted by feature.
    """
    joint = [t for t in joint if t]
    kinds = {t.name: t.dataType for t in df.schema}
    if any(not isinstance(kinds[f], NumericType) for t in joint for f in t):
        raise ValueError("joint features must be numeric")
    together = {f for t in joint for f in t}
    keys = {(f,): category_key(f) for f in categorical if f not in together}
    keys.update({t: F.concat_ws(_JOINT, *[category_key(f) for f in t]) for t in map(tuple, joint)})
    keys.update({(f,): b.cast("string") for f, b in binned.items()})
    wide = df.select(F.col(target).cast("double").alias("_t"), *[k.alias(f"k{i}") for i, k in enumerate(keys.values())])
    stacked = wide.unpivot(["_t"], wide.columns[1:], "i", "key")
    counts = (stacked.filter(F.col("key").isNotNull())
              .groupBy("i", "key")
              .agg(F.count("_t").alias("n"), F.sum("_t").alias("s")))
    features = F.lit(None)
    for i, t in enumerate(keys):
        features = F.when(F.col("i") == f"k{i}", F.array(*map(F.lit, t))).otherwise(features)
    counts = counts.withColumn("features", features)
    if joint:
        parts = F.when(F.size("features") > 1, F.split("key", _JOINT)).otherwise(F.array("key"))
        counts = (counts.select(F.inline(F.arrays_zip(F.col("features").alias("feature"), parts.alias("key"))), "n", "s")
                  .groupBy("feature", "key").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    else:
        counts = counts.withColumn("feature", F.col("features")[0])
    stats = counts.select("feature", "key", "n", F.try_divide("s", "n").alias("mean"))
    is_cat = F.col("feature").isin(*categorical) if categorical else F.lit(False)
    return stats.withColumn(
        "enc", F.when(is_cat, smoothed(F.col("mean"), F.col("n"), g, min_samples))
        .otherwise(F.col("mean")))


# Maps with at most this many entries become literal map lookups (no join).
LITERAL_MAP_MAX = 64
# What a map entry takes in a hashed relation besides its key's text.
ENTRY_BYTES = 64


def apply_encodings(df: DataFrame, maps: DataFrame, keys: dict[str, Column],
                    g: float, broadcast_max_bytes: int,
                    literal_max: int = LITERAL_MAP_MAX) -> DataFrame:
    """JOIN-01/02 + PRJ-09: add ``{feature}_encoded``; unseen key → global mean.

    Map sizes are counted first (one row per feature reaches the driver).
    By measured size, a map becomes:
      * ≤ ``literal_max`` entries: a literal map looked up in generated
        code — no join, no shuffle (date parts, most categories, bins);
      * ≤ ``broadcast_max_bytes`` of keys and values: a broadcast hash join;
      * larger: a shuffle join, where AQE splits a skewed key.
    """
    measured = maps.groupBy("feature").agg(F.count(F.lit(1)).alias("cnt"),
                                           F.sum(F.octet_length("key") + F.lit(ENTRY_BYTES)).alias("bytes")).collect()
    sizes = {r["feature"]: r["cnt"] for r in measured}
    bytes_of = {r["feature"]: r["bytes"] for r in measured}
    names = list(keys)
    tiny = [f for f in names if sizes.get(f, 0) <= literal_max]
    lookup: dict[str, list] = {f: [] for f in tiny}
    if tiny:
        # bounded: at most literal_max entries per feature
        for r in maps.filter(F.col("feature").isin(*tiny)).select("feature", "key", "enc").collect():
            lookup[r["feature"]].append((r["key"], r["enc"]))
    gl = F.lit(g).cast("double")
    out = df.select("*", *[keys[f].alias(f"_k{i}") for i, f in enumerate(names)
                           if f not in lookup])
    room = broadcast_max_bytes
    for i, f in enumerate(names):
        if f in lookup:
            continue
        m = (maps.filter(F.col("feature") == f)
             .select(F.col("key").alias(f"_k{i}"), F.col("enc").alias(f"_e{i}")))
        # the joins of one plan hold their maps at the same time
        if bytes_of.get(f, 0) <= room:
            room -= bytes_of.get(f, 0)
            m = F.broadcast(m)
        else:
            # keys come once, so a partition's map is small, and the wide rows need not be sorted
            m = m.hint("shuffle_hash")
        out = out.join(m, f"_k{i}", "left")
    enc_cols = []
    for i, f in enumerate(names):
        if f in lookup:
            entries = lookup[f]
            if entries:
                mp = F.create_map(*[F.lit(x) for kv in entries for x in
                                    (kv[0], float(kv[1]) if kv[1] is not None else None)])
                val = F.try_element_at(mp.cast("map<string,double>"), keys[f])
            else:
                val = F.lit(None).cast("double")
        else:
            val = F.col(f"_e{i}")
        enc_cols.append(F.coalesce(val, gl).alias(f"{f}_encoded"))
    return out.select(*[F.col(c) for c in df.columns], *enc_cols)


def target_encode(df: DataFrame, features: list[str], target: str = "work_places",
                  min_samples: int = 10, broadcast_max_bytes: int = 64 << 20) -> DataFrame:
    """AGG-02 + JOIN-01 as one operator (UDF-04 alias: process_categorical_feature)."""
    g = global_mean(df, target)
    maps = encoding_maps(df, features, {}, target, min_samples, g)
    return apply_encodings(df, maps, {f: category_key(f) for f in features}, g,
                           broadcast_max_bytes)


# UDF-04: name kept for callers of the older helper.
process_categorical_feature = target_encode
