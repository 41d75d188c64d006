"""ISO-8601 timestamps: zone-aware parsing, canonical UTC text and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.binding import let

_PLAIN_UTC = (
    r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(\.[0-9]{1,6})?(Z|\+00:00)\z"
)
# Groups: 1-3 extended date, 4-6 basic date, 7-9 week date, 10 clock, 11 zone.
_GENERAL = (
    r"^(?:([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{4})([0-9]{2})([0-9]{2})"
    r"|([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?)"
    r"(?:(?s:.)([0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?"
    r"|[0-9]{2}(?:[0-9]{2}(?:[.,][0-9]+)?)?)?)"
    r"([+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:[.,][0-9]+)?)?)?)?)?\z"
)
# Groups: hours, minutes, seconds, fraction; in a clock or after the sign of a zone.
_CLOCK = r"^[+-]?([0-9]{2}):?([0-9]{2})?:?([0-9]{2})?(?:[.,]([0-9]+))?\z"


def _calendar_date(parts: Column) -> Column:
    return F.concat_ws("-", parts[0], parts[1], parts[2]).try_cast("date")


def _week_date(parts: Column) -> Column:
    january_4 = F.concat(parts[3], F.lit("-01-04")).try_cast("date")
    week = parts[4].cast("int")
    day = F.when(parts[5] == "", 1).otherwise(parts[5].try_cast("int"))
    date = F.date_add(F.date_sub(january_4, F.weekday(january_4)), (week - 1) * 7 + day - 1)
    return F.when(F.weekofyear(date) == week, date)


def _date(parts: Column) -> Column:
    return F.when(parts[3] != "", _week_date(parts)).otherwise(_calendar_date(parts))


def _clock_parts(text: Column) -> Column:
    """Hours, minutes, seconds and six fraction digits; missing ones are zero."""
    parts = F.split(F.regexp_replace(text, _CLOCK, "$1|$2|$3|$4"), r"\|")
    return let(
        parts,
        lambda p: F.array(
            *[F.when(p[i] == "", "00").otherwise(p[i]) for i in range(3)],
            F.rpad(F.substring(p[3], 1, 6), 6, "0"),
        ),
    )


def _local(parts: Column) -> Column:
    """Wall-clock time; null when a part is out of range."""
    date = let(parts, _date)
    clock = _clock_parts(F.when(parts[6] == "", "00").otherwise(parts[6]))
    moment = let(
        clock,
        lambda c: F.concat(F.concat_ws(":", c[0], c[1], c[2]), F.lit("."), c[3]),
    )
    return F.when(
        F.year(date) >= 1,
        F.concat(date.cast("string"), F.lit(" "), moment).try_cast("timestamp_ntz"),
    )


def _offset_seconds(parts: Column) -> Column:
    """Zone offset, null without a zone."""

    def total(c):
        whole = c[0].cast("int") * 3600 + c[1].cast("int") * 60 + c[2].cast("int")
        return F.concat(whole.cast("string"), F.lit("."), c[3]).cast("decimal(12,6)")

    seconds = let(_clock_parts(parts[7]), total)
    sign = F.when(F.substring(parts[7], 1, 1) == "-", -1).otherwise(1)
    return F.when(parts[7] != "", (seconds * sign).cast("decimal(12,6)"))


def _dissect(text: Column) -> Column:
    """Local time and offset of any ISO form the contract takes; both null for others."""
    numeric_zone = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    joined = F.regexp_replace(numeric_zone, _GENERAL, "$1$4|$2$5|$3$6|$7|$8|$9|$10|$11")
    parts = F.when(numeric_zone.rlike(_GENERAL), F.split(joined, r"\|"))
    return let(
        parts,
        lambda p: F.struct(_local(p).alias("local"), _offset_seconds(p).alias("offset")),
    )


def _general_utc(text: Column) -> Column:
    return let(
        _dissect(text),
        lambda t: F.when(
            F.abs(t["offset"]) < 86400,
            t["local"] - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), t["offset"]),
        ),
    )


def utc_timestamp(text: Column) -> Column:
    """UTC time (``timestamp_ntz``) of zone-aware ISO text, null for anything else."""
    # A cast to a time without zone ignores the zone, which is UTC here.
    return let(
        text,
        lambda t: F.when(t.rlike(_PLAIN_UTC), t.try_cast("timestamp_ntz")).otherwise(
            _general_utc(t)
        ),
    )


def lacks_zone(text: Column) -> Column:
    """Whether the text is a valid ISO time that names no zone."""
    return F.coalesce(
        let(_dissect(text), lambda t: t["local"].isNotNull() & t["offset"].isNull()), F.lit(False)
    )


def is_utc(text: Column) -> Column:
    """Whether zone-aware ISO text names offset zero."""
    return F.coalesce(
        let(_dissect(text), lambda t: t["local"].isNotNull() & (t["offset"] == 0)), F.lit(False)
    )


def canonical_text(moment: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]Z`` of a UTC ``timestamp_ntz``."""
    plain = F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(
        F.when(F.length(plain) > 19, F.rpad(plain, 26, "0")).otherwise(plain), F.lit("Z")
    )


def bound_text(moment: Column) -> Column:
    """Window-bound text of a UTC ``timestamp_ntz``; it ends in ``+00:00``."""
    return F.replace(canonical_text(moment), F.lit("Z"), F.lit("+00:00"))


def age_hours(text: Column, now: Column) -> Column:
    """Hours from ISO text to ``now`` (a UTC ``timestamp_ntz``)."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(
        utc_timestamp(text).cast("timestamp")
    )
    return micros / F.lit(3600000000.0)
