"""Extraction windows and bounded reads."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import timestamps
from orderloom.schemas import OVERLAP_SECONDS, SETTLE_SECONDS

MODES = ("full", "incremental", "backfill")
NO_MARK = "the source has no published high-water mark to continue from"
CLOCK_BEHIND = "the clock is behind the published high-water mark"


def _utc_bound(text: str | None) -> str | None:
    """The bound text of an ISO time with offset zero, null for anything else."""
    try:
        moment = datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    return moment.astimezone(UTC).isoformat() if moment.utcoffset() == timedelta(0) else None


def bounds(mode: str, start: str | None, end: str | None) -> tuple[str | None, str | None]:
    """The bounds of a request as bound texts, both null unless it is a backfill.

    They are constants of a plan and need no job. Raises one ``ValueError`` that lists all that is
    wrong with the request.
    """
    given = {"start": start, "end": end}
    problems = [] if mode in MODES else [f"mode {mode!r} is none of {', '.join(MODES)}"]
    if mode != "backfill":
        problems += [f"{name} has no use in mode {mode}" for name, text in given.items() if text]
        found = {}
    else:
        found = {name: _utc_bound(text) for name, text in given.items()}
        problems += [
            f"{name} must be a time with UTC offset zero, not {given[name]!r}"
            for name, text in found.items()
            if text is None
        ]
        if not problems and not datetime.fromisoformat(found["start"]) < datetime.fromisoformat(found["end"]):
            problems.append(f"an empty range: {start} is not before {end}")
    if problems:
        raise ValueError("; ".join(problems))
    return found.get("start"), found.get("end")


def seconds(number: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(number))


def plan_windows(
    marks: DataFrame,
    mode: str,
    now: Column,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One window per row of ``marks(source, base_watermark)``.

    A full read is open below and stops shortly before ``now``; an incremental read
    starts an overlap before the source's high-water mark; a backfill covers
    ``[start, end)`` and never advances the mark. ``problem`` says why a window cannot
    be used and is null for a usable one.
    """
    first, last = bounds(mode, start, end)
    mark = timestamps.utc_timestamp(F.col("base_watermark"))
    none = F.lit(None).cast("string")
    if mode == "backfill":
        lower, upper = F.lit(first), F.lit(last)
        problem = none
    else:
        upper_at = now - seconds(SETTLE_SECONDS)
        upper = timestamps.bound_text(upper_at)
        lower = (
            timestamps.bound_text(mark - seconds(OVERLAP_SECONDS))
            if mode == "incremental"
            else none
        )
        problem = F.when(upper_at < mark, F.lit(CLOCK_BEHIND))
        if mode == "incremental":
            missing = F.lit(NO_MARK)
            problem = F.coalesce(F.when(mark.isNull(), missing), problem)
    backfill = mode == "backfill"
    return marks.select(
        F.lit(mode).alias("mode"),
        "source",
        upper.alias("upper"),
        lower.alias("lower"),
        "base_watermark",
        F.lit("[start, end)" if backfill else None).cast("string").alias("range_semantics"),
        F.lit(False if backfill else None).cast("boolean").alias("watermark_advance"),
        problem.alias("problem"),
    )


def _literal(text: str) -> Column:
    moment = datetime.fromisoformat(text).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def within(column: str | Column, lower: str | None, upper: str) -> Column:
    """``lower <= column <= upper``; a missing lower bound is open."""
    column = F.col(column) if isinstance(column, str) else column
    condition = column <= _literal(upper)
    return condition & (column >= _literal(lower)) if lower else condition


def within_half_open(column: str | Column, start: str, end: str) -> Column:
    """``start <= column < end``, so adjacent backfills neither overlap nor leave a gap."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= _literal(start)) & (column < _literal(end))


def read_window(source: DataFrame, window: dict, column: str = "updated_at") -> DataFrame:
    """Rows of a source table inside a window.

    The bounds are literals on the bare column, so they reach the file scan.
    """
    if window["mode"] == "backfill":
        return source.filter(within_half_open(column, window["lower"], window["upper"]))
    return source.filter(within(column, window["lower"], window["upper"]))


def in_update_order(source: DataFrame, column: str, *unique: str) -> DataFrame:
    """Rows sorted by update time, for readers that ask for the source's order.

    Naming columns that tell rows apart lets equal times split over several tasks.
    """
    return source.orderBy(column, *unique)
