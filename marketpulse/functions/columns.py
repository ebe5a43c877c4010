"""Scalar column expressions (all built-ins, so whole-stage codegen is kept)."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = (2, 3, 4, 5, 6)  # Spark dayofweek: Sunday = 1 ... Saturday = 7


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session zone.

    (Spark's timestamp_diff / date_trunc go through the session zone for NTZ
    input, which shifts wall-clock times inside a DST gap.)
    """
    ts = _col(c)
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")
    # zone offsets are whole seconds, so the sub-second part survives any zone cast
    fraction = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    return days * 86_400_000_000 + seconds * 1_000_000 + fraction


def floor_to(c, width_micros: int, anchor_micros: int = 0) -> Column:
    """Start of the ``width`` window (grid anchored at ``anchor``) holding an NTZ time."""
    off = F.pmod(epoch_micros(c) - F.lit(anchor_micros), F.lit(width_micros))
    return F.timestamp_add("MICROSECOND", -off, _col(c))


def parse_iso_utc(c) -> Column:
    """ISO-8601 text (any zone suffix) -> UTC wall-clock TIMESTAMP_NTZ.

    Parsed as an instant first (offsets honoured), then placed on the UTC
    wall clock by pure arithmetic, so the session zone does not matter.
    Unparseable text gives NULL.
    """
    instant = F.try_to_timestamp(_col(c))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch_ntz())


def iso_z(c) -> Column:
    """Format like Python ``isoformat() + 'Z'``: fraction only when non-zero."""
    ts = _col(c)
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        F.lit("Z"),
    )


def partition_date(c) -> Column:
    """Calendar date of an event time (a date pattern has no effect on timestamps)."""
    return F.to_date(_col(c))


def start_of_day(c) -> Column:
    """Midnight of an event time's day, as TIMESTAMP_NTZ."""
    return _col(c).cast("date").cast("timestamp_ntz")


def is_weekday(date_col) -> Column:
    return F.dayofweek(_col(date_col)).isin(*WEEKDAYS)


def without_phrase(text_col, phrase: str) -> Column:
    """Case-sensitive negated substring; NULL text is unknown, so a filter drops it."""
    return ~_col(text_col).contains(phrase)


def nan_to_null(c) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def case_map(key_col, arms, default: str | None = None) -> Column:
    """CASE key WHEN k1 THEN v1 ... ELSE default END, arms in order."""
    key = _col(key_col)
    expr = None
    for k, v in arms:
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def any_differs(left: dict, right: dict, cols, null_safe: bool = False) -> Column:
    """OR of ``left[c] <> right[c]``; three-valued unless ``null_safe``."""
    tests = [(~left[c].eqNullSafe(right[c])) if null_safe else (left[c] != right[c]) for c in cols]
    return reduce(or_, tests)


def all_of(conds) -> Column:
    return reduce(and_, conds)


# Between words: runs of characters that are neither letters nor digits.
WORD_SPLIT = r"[^\p{L}\p{N}]+"
