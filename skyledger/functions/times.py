"""Local clock readings to instants, and calendar keys."""

from __future__ import annotations

import zoneinfo
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted clock formats.
MINUTE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}$"
MINUTE_FORMAT = "yyyy-M-d'T'H:m"
SECOND_TEXT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
SECOND_FORMAT = "yyyy-M-d H:m:s"
OFFSET_FORMAT = "XX"

# Zone names Python knows and the JVM does not, under a name both know.
_JVM_NAMES = {"ROC": "Asia/Taipei", "Factory": "UTC"}


@lru_cache(maxsize=1)
def known_zones() -> tuple[str, ...]:
    """About 600 IANA names; small enough to be an IN list compiled to a hash set."""
    machine_dependent = {"localtime"}
    return tuple(sorted(zoneinfo.available_timezones() - machine_dependent - set(_JVM_NAMES)))


def zone_or_utc(zone: str) -> Column:
    """The column ``zone`` where it has a known IANA name, else UTC (``to_utc_timestamp`` fails on others).

    Written as SQL: one call for the whole list instead of one per name.
    """
    names = ", ".join(f"'{name}'" for name in known_zones())
    renamed = " ".join(f"WHEN `{zone}` = '{name}' THEN '{jvm}'" for name, jvm in _JVM_NAMES.items())
    return F.expr(f"CASE WHEN `{zone}` IN ({names}) THEN `{zone}` {renamed} ELSE 'UTC' END")


def local_minute(text: Column) -> Column:
    """The naive local time, as a timestamp that reads the same in a UTC session."""
    return F.when(text.rlike(MINUTE_TEXT), F.try_to_timestamp(text, F.lit(MINUTE_FORMAT)))


def zoned_instant(local: Column, zone: str) -> Column:
    return F.to_utc_timestamp(local, zone_or_utc(zone))


def _spaced(text: Column) -> Column:
    return F.rtrim(F.regexp_replace(text, r"\s+", " "))


def local_second(text: Column) -> Column:
    spaced = _spaced(text)
    return F.when(spaced.rlike(SECOND_TEXT), F.try_to_timestamp(spaced, F.lit(SECOND_FORMAT)))


def offset_instant(text: Column, offset: Column) -> Column:
    """Local time plus "+05:30", "+0530" or "Z" to an instant; null for any other offset."""
    spaced = _spaced(text)
    stamped = F.concat(spaced, F.lit(" "), F.replace(offset, F.lit(":"), F.lit("")))
    parsed = F.try_to_timestamp(stamped, F.lit(f"{SECOND_FORMAT} {OFFSET_FORMAT}"))
    return F.when(spaced.rlike(SECOND_TEXT), parsed)


def date_key(local: Column) -> Column:
    """yyyymmdd of a local date or timestamp."""
    return (F.year(local) * 10000 + F.month(local) * 100 + F.dayofmonth(local)).cast("int")
