"""Column-level functions (FN-01..FN-21). All are built-in expressions, so
they stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Must equal the source system's for identical results.
# Words of the weight text: "from X to Y" and "from X".
WORD_FROM = "от"
WORD_TO = "до"
# Weight bounds for plain numbers.
WEIGHT_MIN = 1
WEIGHT_MAX = 10000
# Text read as missing by the CSV reader of the prepared file (pandas defaults).
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                "nan", "null")
# Category used for missing values before encoding.
UNKNOWN = "Unknown"
# Date formats tried in order where none are given or inferred, beside year-first dates.
DATE_FORMATS = ("dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy")
# ----------------------------------------------------------------------------

DATE_PARTS = ("year", "month", "quarter", "day_of_week", "day_of_year")
_RANGE_RE = rf"(?U){WORD_FROM}\s+(\d+)\s+{WORD_TO}\s+(\d+)"
_FROM_RE = rf"(?U){WORD_FROM}\s+(\d+)"
_EDGE_SPACE_RE = r"(?U)^\s+|\s+$"
# The characters of Unicode's White_Space, which ``(?U)\s`` matches.
_SPACES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_ISO_RE = (r"^\d{4}-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?"
           r"( ?(Z|[+-]\d{1,2}:\d{2}|[+-]\d{4}))?)?)?$")
# Regular year-first dates without an offset: there is nothing to trim or to spell anew before the cast.
_PLAIN_ISO_RE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\z"
# No date this short has an offset of four digits: the least is 2019-1-2T3:4+0300.
_NO_OFFSET = 16
_DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: str | Column) -> Column:
    """Text without white space at both ends; no regular expression, as it runs on every date and number."""
    return F.btrim(col_of(c), F.lit(_SPACES))


def trim_seldom(c: str | Column) -> Column:
    """:func:`trim_space` without its search in text that begins and ends with visible ASCII. Its code is longer:
    where it stands many times in one projection, the generated method grows too large to be compiled."""
    x = col_of(c)
    last = F.substring(x, -1, 1)
    return F.when((x >= "!") & (x < "\x7f") & (last >= "!") & (last < "\x7f"), x).otherwise(trim_space(x))


def _number(s: Column) -> Column:
    return F.when(s.rlike(_DECIMAL_RE), s.try_cast("double"))


def to_number(c: str | Column) -> Column:
    """FN-07: decimal text → DOUBLE; anything else, also NaN, → null."""
    return _number(trim_seldom(col_of(c).cast("string")))


def is_decimal(c: str | Column) -> Column:
    """Whether text is a decimal number as FN-07 reads it."""
    return trim_space(col_of(c).cast("string")).rlike(_DECIMAL_RE)


def _weight_number(c: Column) -> Column:
    """Number of a weight text: as FN-07, and underscores may separate digits."""
    return _number(trim_space(F.when(c.contains("_"), F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")).otherwise(c)))


def parse_weight(c: str | Column) -> Column:
    """FN-01: weight text → BIGINT.

    null → 1; text with "до": "от X до Y" → (X+Y) div 2, else the number
    rule; text with "от" (no "до"): "от X" → X, else the number rule;
    number rule: truncate, clamp to 1..10000; NaN, ±inf, junk → 1.
    """
    s = col_of(c).cast("string")
    lo = F.regexp_extract(s, _RANGE_RE, 1).try_cast("bigint")
    hi = F.regexp_extract(s, _RANGE_RE, 2).try_cast("bigint")
    single = F.regexp_extract(s, _FROM_RE, 1).try_cast("bigint")
    num = _weight_number(s)
    # NaN is above infinity, null is in no range
    by_number = (F.when((num >= WEIGHT_MIN) & (num < float("inf")),
                        F.least(F.floor(num), F.lit(WEIGHT_MAX)).cast("bigint"))
                 .otherwise(F.lit(WEIGHT_MIN).cast("bigint")))
    has_to = s.contains(WORD_TO)
    has_from = s.contains(WORD_FROM)
    return (F.when(s.isNull(), F.lit(1).cast("bigint"))
            .when(has_to & lo.isNotNull() & hi.isNotNull(), F.floor((lo + hi) / 2).cast("bigint"))
            .when(~has_to & has_from & single.isNotNull(), single)
            .otherwise(by_number))


def null_markers(c: str | Column) -> Column:
    """SRC-05: text equal to a missing-value marker → null."""
    x = col_of(c)
    return F.when(x.isin(*NULL_MARKERS), F.lit(None).cast("string")).otherwise(x)


def year_first_timestamp(c: str | Column) -> Column:
    """Year-first dates with hyphens, with or without a time, fraction and offset → TIMESTAMP; else null."""
    s = col_of(c).cast("string")
    x = trim_space(s)
    # an offset without a colon is given one; the cast knows no other spelling that this one lacks
    whole = F.when(F.length(x) <= _NO_OFFSET, x).otherwise(F.regexp_replace(x, r"([+-]\d\d)(\d\d)$", "$1:$2"))
    return F.when(s.rlike(_PLAIN_ISO_RE), s.try_cast("timestamp")).when(x.rlike(_ISO_RE), whole.try_cast("timestamp"))


def parse_timestamp(c: str | Column, formats=DATE_FORMATS, year_first: Column | None = None) -> Column:
    """FN-08: text → TIMESTAMP; bad → null.

    Year-first dates with hyphens, with or without a time, fraction and offset, are read
    as they are (an offset moves the time to the session's zone); other text by ``formats``, in order.
    ``year_first`` holds the first reading where it has been done already.
    """
    x = trim_space(col_of(c).cast("string"))
    iso = year_first_timestamp(c) if year_first is None else year_first
    return F.coalesce(iso, *[F.try_to_timestamp(x, F.lit(f)) for f in formats])


def unflag(date: str | Column, flag: str | Column | None) -> Column:
    """FLT-12: a date flagged as mistaken (flag text '1') becomes null."""
    d = col_of(date)
    if flag is None:
        return d
    return F.when(col_of(flag).cast("string") == "1", F.lit(None)).otherwise(d)


def date_parts(ts: str | Column, prefix: str) -> list[Column]:
    """FN-11: year, month, quarter, day of week (Monday = 0), day of year."""
    t = col_of(ts)
    parts = (F.year(t), F.month(t), F.quarter(t), F.weekday(t), F.dayofyear(t))
    return [part.alias(f"{prefix}_{name}") for name, part in zip(DATE_PARTS, parts)]


def clip(x: str | Column, lo, hi) -> Column:
    """FN-09: clip to [lo, hi]; null stays null, null bounds do not clip."""
    v = col_of(x)
    lo_c, hi_c = F.lit(lo), F.lit(hi)
    v = F.when(v.isNotNull() & lo_c.isNotNull() & (v < lo_c), lo_c).otherwise(v)
    return F.when(v.isNotNull() & hi_c.isNotNull() & (v > hi_c), hi_c).otherwise(v)


def short_label(x: str | Column, n: int = 20) -> Column:
    """FN-05: label cut to ``n`` characters plus '...' when longer."""
    s = col_of(x).cast("string")
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def safe_name(x: str | Column) -> Column:
    """FN-04: keep word characters, white space and hyphens; strip white space; spaces → '_'."""
    s = F.regexp_replace(F.regexp_replace(col_of(x), r"(?U)[^\w\s-]", ""), _EDGE_SPACE_RE, "")
    return F.regexp_replace(s, " ", "_")


def calendar_features(period: str | Column) -> list[Column]:
    """FN-13: month, quarter, year, day of year, quarter end, year end (0/1)."""
    p = col_of(period)
    month_end = p == F.last_day(p)
    return [F.month(p).alias("month"), F.quarter(p).alias("quarter"), F.year(p).alias("year"),
            F.dayofyear(p).alias("day_of_year"),
            (month_end & (F.month(p) % 3 == 0)).cast("int").alias("is_quarter_end"),
            (month_end & (F.month(p) == 12)).cast("int").alias("is_year_end")]


def round_forecast(x: str | Column) -> Column:
    """FN-19: round half to even, floored at 0."""
    return F.greatest(F.lit(0.0), F.bround(col_of(x), 0))


def year_month(x: str | Column) -> Column:
    """FN-20: 'yyyy-MM'."""
    return F.date_format(col_of(x), "yyyy-MM")


def whole_days(end: str | Column, start: str | Column) -> Column:
    """FN-17: floor of the elapsed time in days (not calendar-day difference)."""
    secs = F.unix_seconds(col_of(end).cast("timestamp")) - F.unix_seconds(col_of(start).cast("timestamp"))
    return F.floor(secs / 86400).cast("bigint")
