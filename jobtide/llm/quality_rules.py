"""Quality rules with adaptive thresholds, in DataFrame and SQL functions only.

Fixed base rules reject texts of very few words or made of repeated
windows. The other rules adapt: for each language and source, a mergeable
quantile sketch of every feature gives quartiles, and a document fails where
a feature lies far outside them. A sketch is a table of counts over value
bins of bounded relative width, so sketches merge by adding counts, whatever
the order, and groups with few documents take the merged sketch of their
language, or of all documents. Documents are then joined with the
thresholds of their group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 50
FENCE = 3
#: feature -> (least distance of the upper fence from the upper quartile, of the lower fence from the lower quartile or None)
FEATURES: dict[str, tuple[int, int | None]] = {
    "symbols_pm": (30, None),      # symbols per 1000 characters in words
    "dup_lines_pm": (500, None),   # repeated lines per 1000 lines with a word
    "repeats_pm": (250, None),     # words in repeated windows per 1000 words
    "word_len_pc": (200, 200),     # characters per 100 words
}
_WS = r"[\\x20\\x09-\\x0D]"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeats() -> str:
    """Words (column ``w``) inside windows that occur at least twice in the text."""
    window = "xxhash64(" + ", ".join(f"h[i + {k}]" for k in range(WINDOW)) + ")"
    at = _let("sort_array(transform(g, (v, i) -> struct(v, i)))", "p",
              "sort_array(transform(filter(p, (e, k) -> (k > 0 AND p[greatest(k - 1, 0)].v = e.v) OR (k < size(p) - 1 AND p[least(k + 1, size(p) - 1)].v = e.v)), e -> e.i))")
    covered = f"aggregate({at}, struct(0L AS n, cast(-{WINDOW} AS int) AS last), (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)"
    repeated = _let(f"transform(sequence(0, size(h) - {WINDOW}), i -> {window})", "g", f"CASE WHEN size(array_distinct(g)) = size(g) THEN 0L ELSE {covered} END")
    return _let("transform(w, x -> xxhash64(x))", "h", f"CASE WHEN size(h) < {WINDOW} THEN 0L ELSE {repeated} END")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed`` (longs, boolean).

    A null text has no words. ``n_lines`` counts lines with a word.
    """
    new = ["w", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]
    docs = docs.drop(*new)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    text = f"coalesce(cast(`{text_col}` as string), '')"
    # the words array is made once: a Generate between two projections keeps them apart
    rows = docs.select(*cols, F.explode(F.array(F.expr(f"array_remove(split({text}, '{_WS}+'), '')"))).alias("w"))
    lines = _let(f"filter(split({text}, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')", "l", "struct(size(l) AS n, size(l) - size(array_distinct(l)) AS dup)")
    rows = rows.select(
        *cols, F.expr("cast(size(w) as long)").alias("n_words"), F.expr("cast(length(array_join(w, '')) as long)").alias("word_chars"),
        F.expr(f"cast(length({text}) - length(regexp_replace({text}, '[#*$%&|<>]', '')) as long)").alias("n_symbols"),
        F.expr(lines).alias("__lines"), F.expr(_repeats()).alias("n_repeat_words"))
    rows = rows.select(*cols, "n_words", "word_chars", "n_symbols", F.expr("cast(__lines.n as long)").alias("n_lines"),
                       F.expr("cast(__lines.dup as long)").alias("n_dup_lines"), "n_repeat_words")
    return rows.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def features() -> dict[str, Column]:
    return {
        "symbols_pm": F.expr("(1000 * n_symbols) DIV greatest(word_chars, 1L)"),
        "dup_lines_pm": F.expr("(1000 * n_dup_lines) DIV greatest(n_lines, 1L)"),
        "repeats_pm": F.expr("(1000 * n_repeat_words) DIV greatest(n_words, 1L)"),
        "word_len_pc": F.expr("(100 * word_chars) DIV greatest(n_words, 1L)"),
    }


def bin_start(value: str) -> str:
    """SQL for the lowest value of a value's bin: its seven leading bits, so bins are at most 1/64 wide."""
    shift = f"cast(greatest(length(bin({value})) - 7, 0) as int)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, feature, bin, n``: the sketches, over documents that pass the base rules.

    Sketches of two sets of documents merge by adding ``n``.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), value.alias("value")) for name, value in features().items()]))
    rows = measured.where("NOT base_failed").select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), pairs.alias("f"))
    return rows.select("lang", "source", "f.feature", F.expr(bin_start("f.value")).alias("bin")).groupBy("lang", "source", "feature", "bin").agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper fence per key and feature, from the quartiles of the merged sketches."""
    merged = sketch.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))
    bins = F.sort_array(F.collect_list(F.struct("bin", "n")))  # at most 64 bins for each power of two
    rows = merged.groupBy(*keys, "feature").agg(F.sum("n").alias("n_docs"), bins.alias("b"))

    def quartile(q: int) -> Column:
        return F.expr(f"aggregate(b, struct(0L AS c, 0L AS v), (a, x) -> struct(a.c + x.n AS c, CASE WHEN 4 * a.c < {q} * n_docs THEN x.bin ELSE a.v END AS v), a -> a.v)")

    lows = F.create_map(*[F.lit(x) for name, (_, low) in FEATURES.items() for x in (name, -1 if low is None else low)])
    highs = F.create_map(*[F.lit(x) for name, (high, _) in FEATURES.items() for x in (name, high)])
    rows = rows.select(*keys, "feature", "n_docs", quartile(1).alias("q1"), quartile(3).alias("q3"))
    spread = FENCE * (F.col("q3") - F.col("q1"))
    low, high = lows[F.col("feature")], highs[F.col("feature")]
    return rows.select(*keys, "feature", "n_docs", F.when(low >= 0, F.col("q1") - F.greatest(spread, low)).alias("low"), (F.col("q3") + F.greatest(spread, high)).alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source`` and ``<feature>_low, <feature>_high``: one row per group.

    Groups with fewer than ``MIN_GROUP`` documents take the language's
    sketch, and languages with fewer the sketch of all.
    """
    own, lang, whole = _fences(sketch, ["lang", "source"]), _fences(sketch, ["lang"]), _fences(sketch, [])
    rows = (own.alias("o").join(lang.alias("l"), F.expr("o.lang <=> l.lang AND o.feature = l.feature"))
            .join(whole.alias("a"), F.expr("o.feature = a.feature")))

    def pick(end: str) -> Column:
        return F.expr(f"CASE WHEN o.n_docs >= {MIN_GROUP} THEN o.{end} WHEN l.n_docs >= {MIN_GROUP} THEN l.{end} ELSE a.{end} END")

    rows = rows.select("o.lang", "o.source", "o.feature", pick("low").alias("low"), pick("high").alias("high"))
    ends = [F.max(F.when(F.col("feature") == name, F.col(end))).alias(f"{name}_{end}") for name in FEATURES for end in ("low", "high")]
    return rows.groupBy("lang", "source").agg(*ends)


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep_text: bool = True) -> DataFrame:
    """``docs`` with the measures of ``measure`` and ``kept``; without ``keep_text`` the text goes once it is measured.

    ``kept`` is false for base failures and where a feature is beyond its
    group's fence. Null languages and sources are groups of their own; a
    document without words fails; an empty table gives no rows; repeated
    rows count as often as they occur. Existing columns of the added names
    are replaced.
    """
    measured = measure(docs, text_col).drop("kept")
    measured = cut_lineage(measured if keep_text else measured.drop(text_col))
    limits = cut_lineage(thresholds(sketches(measured, lang_col, source_col)).withColumnsRenamed({"lang": "__lang", "source": "__source"}))
    joined = measured.join(limits, measured[lang_col].eqNullSafe(limits["__lang"]) & measured[source_col].eqNullSafe(limits["__source"]), "left")
    beyond = F.lit(False)
    for name, value in features().items():
        beyond = beyond | F.coalesce(value > F.col(f"{name}_high"), F.lit(False)) | F.coalesce(value < F.col(f"{name}_low"), F.lit(False))
    return joined.select(*measured.columns, (~F.col("base_failed") & ~beyond).alias("kept"))
