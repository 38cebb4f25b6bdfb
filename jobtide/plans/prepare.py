"""API-01/04: raw vacancy rows → prepared vacancy table.

Order of steps is the source system's: weight → dates (+ encodings of their
parts) → categories → numerics → span end and duration → filters → types.
The statistics behind the encodings are computed over **all** title-matched
rows, before the filters (the filters must not be moved across them).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import PrepConfig
from ..functions.scalar import to_number
from ..operators import clean as C
from ..operators import encode as E
from ..operators.dateforms import date_formats_of, infer_date_formats
from ..session import cut_lineage, stored

DATE_PARTS_ENCODED = ("year", "month", "quarter")


@dataclass
class PrepLog:
    """AGG-24: row counts taken while the preparation runs, without a scan of their own.

    ``counts`` is there once the prepared table has been computed.
    """
    reading: Observation = field(default_factory=Observation)
    cleaning: Observation = field(default_factory=Observation)

    def counts(self) -> dict[str, int]:
        """Rows read and kept by each filter in turn, and unread date texts per date column."""
        return {**self.reading.get, **self.cleaning.get}

    def table(self, spark: SparkSession) -> DataFrame:
        """``step, rows, pct_of_read``: one row per count."""
        counts = self.counts()
        read = counts.get("rows_read", 0)
        rows = [(k, v, round(100.0 * v / read, 4) if read else None) for k, v in counts.items()]
        return spark.createDataFrame(rows, "step string, rows long, pct_of_read double")


def _observed_dates(df: DataFrame, cfg: PrepConfig) -> list[Column]:
    """Date texts that are there, are not flagged as mistaken, and could not be read."""
    out = []
    for d, flag in cfg.date_columns:
        if f"{d}_processed" in df.columns:
            there = F.trim(F.col(d).cast("string")) != ""
            if flag in df.columns:
                there = there & (F.coalesce(F.col(flag).cast("string"), F.lit("0")) != "1")
            out.append(F.count_if(there & F.col(f"{d}_processed").isNull()).alias(f"unread_{d}"))
    return out


@dataclass
class _Base:
    """Rows after the row-local steps, and what the encodings need of them."""
    df: DataFrame
    cats: list[str]
    numeric: list[str]
    bins: dict
    mean: float | None
    maps: DataFrame
    keys: dict[str, Column]


def _categories(df: DataFrame, cfg: PrepConfig) -> list[str]:
    return [c for c in ("industry", *cfg.categorical_columns) if c in df.columns]


def _numeric(df: DataFrame, cfg: PrepConfig) -> list[str]:
    return [c for c in cfg.numeric_columns if c in df.columns]


def _titled(raw: DataFrame, cfg: PrepConfig, log: PrepLog | None) -> DataFrame:
    """The wanted columns of rows whose title matches, missing values as null."""
    df = C.drop_denied(raw, cfg.deny_columns)
    if log is not None:
        kept = C.title_matches(cfg.title_keyword) if cfg.title_keyword else F.lit(True)
        df = df.observe(log.reading, F.count(F.lit(1)).alias("rows_read"), F.count_if(kept).alias("title_kept"))
    return C.mark_nulls(C.keep_titles(df, cfg.title_keyword))


def _row_local(raw: DataFrame, cfg: PrepConfig, log: PrepLog | None) -> DataFrame:
    """The steps that look at one row only, before the filters."""
    formats = date_formats_of(_titled(raw, cfg, None), cfg)
    df = C.weights(_titled(raw, cfg, log), cfg.target)
    df = C.dates(df, cfg.date_columns, formats)
    return C.fill_unknown(df, _categories(df, cfg))


def _with_numbers(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """FN-07 in place, once: the statistics passes then read doubles."""
    return df.withColumns({f: to_number(f) for f in _numeric(df, cfg)})


def _stored_rows(raw: DataFrame, cfg: PrepConfig, log: PrepLog | None) -> DataFrame:
    """Rows after the row-local steps, from one pass over ``raw``: the date forms are inferred from the stored table,
    for columns that hold texts which are not read without them."""
    date_columns = {c for pair in cfg.date_columns for c in pair}
    own = {cfg.target, "industry", *cfg.categorical_columns, *cfg.numeric_columns}
    if cfg.date_formats is not None or date_columns & own:
        return stored(_with_numbers(_row_local(raw, cfg, log), cfg))
    df = C.dates(C.weights(_titled(raw, cfg, log), cfg.target), cfg.date_columns, ())
    df = stored(_with_numbers(C.fill_unknown(df, _categories(df, cfg)), cfg))
    return C.reread_dates(df, cfg.date_columns, infer_date_formats)


def _base(raw: DataFrame, cfg: PrepConfig, store: bool, log: PrepLog | None) -> _Base:
    # Several statistics passes read the stored table, each only its columns.
    df = _stored_rows(raw, cfg, log) if store else _with_numbers(_row_local(raw, cfg, log), cfg)
    cats, numeric = _categories(df, cfg), _numeric(df, cfg)
    # The global mean of the target rides along the first statistics pass.
    bins, g = E.fit_numeric_bins(df, numeric, cfg.num_bins, mean_of=cfg.target)
    df = df.withColumns({f: E.numeric_value(f, bins[f], already_numeric=True) for f in numeric})
    joint = [tuple(f"{d}_{p}" for p in DATE_PARTS_ENCODED) for d, _ in cfg.date_columns if f"{d}_processed" in df.columns]
    parts = [p for own in joint for p in own]
    binned = {f: E.bin_index(F.col(f), bins[f]) for f in numeric}
    maps = E.encoding_maps(df, parts + cats, binned, cfg.target, cfg.min_samples, g, joint)
    keys = {f: E.category_key(f) for f in parts + cats}
    keys.update({f: b.cast("string") for f, b in binned.items()})
    return _Base(df, cats, numeric, bins, g, maps, keys)


def prepare(raw: DataFrame, cfg: PrepConfig | None = None, persist: bool = True,
            check: bool = True, log: PrepLog | None = None) -> DataFrame:
    """Prepared table: original columns (cleaned in place) + processed dates,
    date parts, ``*_encoded``, ``date_end``, ``vacancy_duration``.

    With ``persist`` the row-local result is written to the shared checkpoint folder once, for
    the statistics passes. ``check`` demands a ``title``; ``log`` takes row counts on the way.
    """
    cfg = cfg or PrepConfig()
    if check:
        C.check_title(raw.columns)
    base = _base(raw, cfg, persist, log)
    df = E.apply_encodings(base.df, cut_lineage(base.maps), base.keys, base.mean, cfg.broadcast_max_bytes)

    unread = _observed_dates(df, cfg) if log is not None else []
    if cfg.drop_original:  # PRJ-02
        drop = [d for d, _ in cfg.date_columns] + [f for _, f in cfg.date_columns if f]
        drop += [c for c in base.cats + base.numeric if c != cfg.target]
    df = C.span_end(df, cfg.default_duration_days)
    if log is not None:
        df = df.observe(log.cleaning, *C.kept_counts(df, cfg.date_lo, cfg.date_hi), *unread)
    df = C.keep_valid(df, cfg.date_lo, cfg.date_hi)
    if cfg.drop_original:
        df = df.drop(*drop)
    return C.coerce_types(df)


def clean_rows(raw: DataFrame, cfg: PrepConfig | None = None, columns=None) -> DataFrame:
    """The rows that :func:`prepare` keeps, without encodings: no statistics pass, one narrow stage.

    With ``columns``, only these (those present), and the parsed rows are first written to the shared
    checkpoint folder with what the filters need: a filter on a parsed date would otherwise be
    worked out below the parsing, which then runs anew for each filter, and for each reader of the result.
    """
    cfg = cfg or PrepConfig()
    df = C.span_end(_row_local(raw, cfg, None), cfg.default_duration_days)
    if columns is None:
        return C.coerce_types(C.keep_valid(df, cfg.date_lo, cfg.date_hi))
    wanted = [c for c in columns if c in df.columns]
    needed = ["date_creation_processed", "date_end", "industry", "work_places"]
    df = stored(df.select(*dict.fromkeys(wanted + [c for c in needed if c in df.columns])))
    return C.coerce_types(C.keep_valid(df, cfg.date_lo, cfg.date_hi)).select(*wanted)


def encoding_tables(raw: DataFrame, cfg: PrepConfig | None = None,
                    persist: bool = True) -> tuple[DataFrame, dict]:
    """The encoding maps and numeric cuts alone (for inspection and checks)."""
    base = _base(raw, cfg or PrepConfig(), persist, None)
    return base.maps, base.bins


def spans_of(prepared: DataFrame) -> DataFrame:
    """Prepared vacancies → canonical spans (id, grp, start_ts, end_ts, weight)."""
    C.check_required(prepared.columns, ("date_creation_processed", "date_end", "work_places",
                                        "industry"))
    idc = "vacancy_id" if "vacancy_id" in prepared.columns else None
    return prepared.select(
        (F.col(idc) if idc else F.monotonically_increasing_id()).alias("id"),
        F.col("industry").alias("grp"),
        F.col("date_creation_processed").alias("start_ts"),
        F.col("date_end").alias("end_ts"),
        F.col("work_places").alias("weight"))
