"""Scalar Column helpers (C1-C12, F1, F9, P10).  All are built-in expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def row_key_col(cols: Sequence[str], sep: str = "") -> Column:
    """P10: NULL -> '' then text, concatenated with ``sep``."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def zscore_guarded(value, base, std) -> Column:
    """(value - base) / std; NULL when std is 0 or NULL or base is NULL."""
    value, base, std = _c(value), _c(base), _c(std)
    return F.when(std.isNull() | (std == 0) | base.isNull(), F.lit(None).cast("double")) \
            .otherwise((value - base) / std)


def threshold_flag(score, threshold: float = 0.9) -> Column:
    """1 if score > threshold else 0 (NULL -> 0)."""
    return F.when(_c(score) > F.lit(threshold), 1).otherwise(0)


def safe_ratio(num, den) -> Column:
    """Division that is NULL on a zero or NULL denominator (ANSI-safe)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def day_of_week_sun0(ts) -> Column:
    """Day of week with Sunday = 0 (Spark's dayofweek is Sunday = 1)."""
    return F.dayofweek(_c(ts)) - 1


def first_word(text) -> Column:
    """First whitespace-separated word (empty string when none)."""
    return F.regexp_extract(_c(text), r"^\s*(\S+)", 1)


def clean_control(text) -> Column:
    """Newline and NUL to space."""
    return F.translate(_c(text), "\n\u0000", "  ")


def strip_brackets(text) -> Column:
    """C4: trim parentheses at both ends."""
    return F.regexp_replace(_c(text), r"^[()]+|[()]+$", "")


def after_marker(text, marker: str) -> Column:
    """The text after the first ``marker`` (NULL when absent)."""
    t = _c(text)
    pos = F.instr(t, marker)
    return F.when(pos > 0, F.substr(t, pos + F.lit(len(marker))))


def path_part(path, index: int) -> Column:
    """Piece of a '/'-separated path; negative index counts from the end."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(index))


def epoch_seconds_ntz(ts) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock timestamp (timestamp_ntz),
    independent of the session time zone."""
    t = _c(ts)
    return (F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.floor(F.second(t))).cast("long")


def run_id_now() -> Column:
    """Run id from the clock, ``yyyyMMdd_HHmmss``."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
