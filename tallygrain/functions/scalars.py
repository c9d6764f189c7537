"""Scalar column functions: text repair, violation times, dates, durations and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_category(c) -> Column:
    """Undo a damaged replacement: '0' stands for 'na', except after a dot where it was a zero."""
    return F.lower(F.regexp_replace(F.regexp_replace(_col(c), "0", "na"), r"\.na", ".0"))


def violation_minute(c) -> Column:
    """Minute of the day from ``hhmm`` plus ``A`` or ``P``; anything else is NULL.

    The hour is taken modulo 12, so ``00xxA`` means just after midnight, and 24-hour values such as
    ``1620P`` keep their afternoon hour.
    """
    text = F.rtrim(_col(c))
    hour = F.left(text, F.lit(2)).try_cast("int") % 12
    minute = F.substring(text, 3, 2).try_cast("int")
    afternoon = (F.right(text, F.lit(1)) == "P").cast("int")
    return F.when(text.rlike("^([01][0-9]|2[0-3])[0-5][0-9][AP]$"), (hour + 12 * afternoon) * 60 + minute)


def clock(minute) -> Column:
    """Minute of the day as text ``HH:mm``, NULL for NULL."""
    value = _col(minute)
    return F.concat(F.lpad(F.floor(value / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((value % 60).cast("string"), 2, "0"))


# Six bins of four hours.
HOUR_BINS = [(0, 3, "0_3"), (4, 7, "4_7"), (8, 11, "8_11"), (12, 15, "12_15"), (16, 19, "16_19"), (20, 23, "20_23")]

# Tip segments, lower bound included, upper bound excluded.
TIP_BINS = [(0, 5, "Bucket_1"), (5, 10, "Bucket_2"), (10, 15, "Bucket_3"), (15, 20, "Bucket_4")]

# Months of the seasons in two naming schemes.
SEASON_MONTHS = {"winter": [1, 2, 12], "spring": [3, 4, 5], "summer": [6, 7, 8], "fall": [9, 10, 11]}
SEASON_NAMES = {
    "title": {"winter": "Winter", "spring": "Spring", "summer": "Summer", "fall": "Fall"},
    "lower": {"winter": "winter", "spring": "spring", "summer": "summer", "fall": "autumn"},
}


def bin_label(c, bins: Sequence[tuple], closed: str = "both", otherwise: str | None = None) -> Column:
    """Label of the first range that holds the value; ``closed`` is 'both' or 'left'."""
    value = _col(c)
    label = None
    for low, high, name in bins:
        inside = (value >= low) & ((value <= high) if closed == "both" else (value < high))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label if otherwise is None else label.otherwise(otherwise)


def hour_bin(minute, otherwise: str = "unknown") -> Column:
    """Four-hour bin of a minute of the day, by position so that the minute is computed once."""
    names = F.array(*[F.lit(name) for _, _, name in HOUR_BINS])
    return F.coalesce(F.get(names, F.floor(_col(minute) / 240).cast("int")), F.lit(otherwise))


def season(c, scheme: str = "title") -> Column:
    """Season of a date; NULL dates are 'unknown'."""
    month, names = F.month(_col(c)), SEASON_NAMES[scheme]
    label = None
    for key, months in SEASON_MONTHS.items():
        label = F.when(month.isin(months), names[key]) if label is None else label.when(month.isin(months), names[key])
    return label.otherwise("unknown")


def to_date(c, pattern: str) -> Column:
    """Date by pattern, NULL where the text does not fit."""
    return F.try_to_date(_col(c), pattern)


def hours_between(start, stop) -> Column:
    """Elapsed hours as a double."""
    return (F.unix_micros(_col(stop).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))) / 3600e6


def speed(distance, start, stop) -> Column:
    """Distance per hour; NULL for a trip without duration."""
    return F.try_divide(_col(distance), hours_between(start, stop))


def label_lookup(labels, values, wanted: Sequence[str]) -> list[Column]:
    """For two parallel arrays, the value next to each wanted label, NULL where the label is missing."""
    labels, values = _col(labels), _col(values)
    return [F.get(values, (F.array_position(labels, name) - 1).cast("int")).alias(name) for name in wanted]
