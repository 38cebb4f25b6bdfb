"""Date forms inferred from the data (FN-08, Q18).

Every date text is reduced to its shape, written as a parsing pattern whose
first two numbers are still undecided where the year comes last. One
aggregate counts the shapes of all date columns and keeps the largest first
and second number of each; the driver sees a few dozen shapes a column,
since text that is no date is one shape. Rows are counted by their text with
every digit after the second number as 0, which costs one match a text; the
shape, many matches, is worked out once for each of their outlines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import trim_seldom

_DATE = (r"^(\d{1,4})([-/. ])(\d{1,2})\2(\d{1,4})"
         r"(?:( |T)(\d{1,2}):(\d{1,2})(:\d{1,2})?(\.\d{1,9})?( ?[AaPp][Mm])?)?( ?)(Z|[+-]\d{2}(?::?\d{2})?)?$")
_NAMED = {r"^\d{1,2} [A-Za-z]{3} \d{4}$": "d MMM yyyy", r"^\d{1,2} [A-Za-z]{4,9} \d{4}$": "d MMMM yyyy",
          r"^[A-Za-z]{3} \d{1,2}, \d{4}$": "MMM d, yyyy", r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$": "MMMM d, yyyy",
          r"^\d{8}$": "yyyyMMdd", r"^\d{14}$": "yyyyMMddHHmmss"}
# The commonest date, told from the others by a short match.
_PLAIN = r"^\d{4}-\d{2}-\d{2}\z"
OTHER = "other"
FIRST, SECOND = "{1}", "{2}"


def _text(c: str) -> Column:
    return trim_seldom(F.col(f"`{c}`").cast("string"))


def shape_of(text: Column) -> Column:
    """Pattern of a date text; ``{1}`` and ``{2}`` stand for day and month in an order still to be decided."""
    def part(k: int) -> Column:
        return F.regexp_extract(text, _DATE, k)

    size = lambda k: F.length(part(k))
    date = (F.when((size(1) == 4) & (size(4) <= 2), F.concat(F.lit("yyyy"), part(2), F.lit("M"), part(2), F.lit("d")))
            .when((size(1) <= 2) & size(4).isin(2, 4),
                  F.concat(F.lit(FIRST), part(2), F.lit(SECOND), part(2), F.when(size(4) == 4, F.lit("yyyy")).otherwise(F.lit("yy")))))
    half = part(10) != ""
    time = F.when(part(5) == "", F.lit("")).otherwise(F.concat(
        F.when(part(5) == "T", F.lit("'T'")).otherwise(F.lit(" ")), F.when(half, F.lit("h:m")).otherwise(F.lit("H:m")),
        F.when(part(8) != "", F.lit(":s")).otherwise(F.lit("")),
        F.when(part(9) != "", F.lit(".SSSSSSSSS")).otherwise(F.lit("")),
        F.when(half, F.when(part(10).startswith(" "), F.lit(" a")).otherwise(F.lit("a"))).otherwise(F.lit(""))))
    zone = (F.when(part(12) == "", F.lit("")).when((part(12) == "Z") | part(12).contains(":"), F.lit("XXX"))
            .when(F.length(part(12)) == 5, F.lit("XX")).otherwise(F.lit("X")))
    shape = F.when(text.rlike(_DATE) & date.isNotNull(), F.concat(date, time, part(11), zone))
    for pattern, form in _NAMED.items():
        shape = shape.when(text.rlike(pattern), F.lit(form))
    return shape.otherwise(F.lit(OTHER))


def _like(text: Column) -> Column:
    """A text of the same shape, first and second number: a date's later digits are 0, a named form and other text go by their name."""
    head = F.substring_index(F.translate(text, "/. ", "---"), "-", 2)
    rest = F.substr(text, F.length(head) + 1)
    like = F.when(text.rlike(_PLAIN), F.concat(F.substring(text, 1, 7), F.lit("-00")))
    like = like.when(text.rlike(_DATE), F.concat(F.substring(text, F.lit(1), F.length(head)), F.translate(rest, "0123456789", "0" * 10)))
    for pattern, form in _NAMED.items():
        like = like.when(text.rlike(pattern), F.lit(form))
    return like.otherwise(F.lit(OTHER))


def date_shapes(df: DataFrame, columns) -> DataFrame:
    """``column, shape, n, first, second``: non-empty texts by shape, and the largest first and second number of each."""
    texts = df.select(*[_text(c).alias(f"t{i}") for i, c in enumerate(columns)])
    rows = texts.unpivot([], texts.columns, "i", "text").where("text != ''")
    rows = rows.groupBy("i", _like(F.col("text")).alias("text")).agg(F.count("*").alias("n"))
    # A date's shape depends on its text with every digit as 0 alone, of which there are few; other text has few shapes.
    is_date = F.col("text").rlike(_DATE)
    outline = F.when(is_date, F.translate("text", "0123456789", "0" * 10)).otherwise(F.col("text"))
    column = F.element_at(F.array(*[F.lit(c) for c in columns]), F.substring("i", 2, 9).cast("int") + 1)
    rows = rows.select(column.alias("column"), "n", outline.alias("outline"), F.when(is_date, F.translate("text", "/. ", "---")).alias("cut"))
    number = lambda k: F.substring_index(F.substring_index("cut", "-", k), "-", -1).try_cast("int")
    outlines = rows.groupBy("column", "outline").agg(F.sum("n").alias("n"), F.max(number(1)).alias("first"), F.max(number(2)).alias("second"))
    text = F.col("outline")
    shape = F.when(text.isin(OTHER, *_NAMED.values()), text).otherwise(shape_of(text))
    return outlines.groupBy("column", shape.alias("shape")).agg(F.sum("n").alias("n"), F.max("first").alias("first"), F.max("second").alias("second"))


def resolve(shapes: list[tuple[str, int, int | None, int | None]]) -> tuple[str, ...]:
    """Patterns of one column from its ``(shape, n, first, second)``, most frequent first.

    A number above 12 is a day, wherever the column's dates with that separator hold it. With none,
    dates with points are day first and others month first; with days in both places, both orders are tried, day first.
    """
    def head(shape: str) -> str:
        return shape[:shape.index(SECOND) + len(SECOND)]

    most: dict[str, list[int]] = {}
    for shape, _, first, second in shapes:
        if FIRST in shape:
            m = most.setdefault(head(shape), [0, 0])
            m[:] = [max(m[0], first or 0), max(m[1], second or 0)]
    out = []
    for shape, *_ in sorted(shapes, key=lambda s: (-s[1], s[0])):
        if shape == OTHER:
            continue
        if FIRST not in shape:
            out.append(shape)
            continue
        first, second = most[head(shape)]
        day_first = first > 12 or (second <= 12 and f"{FIRST}." in shape)
        orders = ["dM", "Md"] if first > 12 and second > 12 else ["dM" if day_first else "Md"]
        out += [shape.replace(FIRST, a).replace(SECOND, b) for a, b in orders]
    return tuple(dict.fromkeys(out))


def infer_date_formats(df: DataFrame, columns) -> dict[str, tuple[str, ...]]:
    """FN-08: patterns of each date column present in ``df``, from one pass over these columns."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    found: dict[str, list] = {c: [] for c in present}
    for r in date_shapes(df, present).collect():
        found[r["column"]].append((r["shape"], r["n"], r["first"], r["second"]))
    return {c: resolve(shapes) for c, shapes in found.items()}


def date_formats_of(df: DataFrame, cfg) -> tuple | dict[str, tuple[str, ...]]:
    """The configuration's date formats, or those inferred from ``df``."""
    if cfg.date_formats is not None:
        return cfg.date_formats
    return infer_date_formats(df, [d for d, _ in cfg.date_columns])
