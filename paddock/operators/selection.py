"""Which sessions to process: season/round/session filters, calendar cut-off,
completeness of a session's files, and set membership (F10-F12, F14, J2, J3,
S6, S8, U2).

Session sets are tiny (a few dozen per season), while the tables they select
from are large; joins against them are left to AQE, which broadcasts a side
only after measuring it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock import schemas


def select_seasons(df: DataFrame, seasons: Iterable[int] | None = None, resume_year: int | None = None) -> DataFrame:
    """listed seasons only, and none before ``resume_year``."""
    cond = F.lit(True)
    if seasons is not None:
        cond = cond & F.col("year").isin(*[int(s) for s in seasons])
    if resume_year is not None:
        cond = cond & (F.col("year") >= int(resume_year))
    return df.filter(cond)


def select_rounds_sessions(df: DataFrame, rounds: Iterable[int] | None = None,
                           session_types: Iterable[str] | None = None) -> DataFrame:
    """round and session-type filters (partition pruning on stored tables)."""
    cond = F.lit(True)
    if rounds is not None:
        cond = cond & F.col("round").isin(*[int(r) for r in rounds])
    if session_types is not None:
        cond = cond & F.col("session_type").isin(*list(session_types))
    return df.filter(cond)


def events_until(schedule: DataFrame, as_of: dt.date) -> DataFrame:
    """events whose date is not after ``as_of`` (a parameter, never the clock)."""
    return schedule.filter(F.to_date("event_date") <= F.lit(as_of))


def driver_laps(df: DataFrame, driver: str) -> DataFrame:
    """one driver's rows."""
    return df.filter(F.col("driver") == driver)


def expand_session_types(events: DataFrame, session_types: Iterable[str] | None = None) -> DataFrame:
    """(year, round) events -> (year, round, session_type) sessions, without a join."""
    types = list(session_types or schemas.SESSION_TYPES)
    return events.select("*", F.explode(F.array(*[F.lit(t) for t in types])).alias("session_type"))


def distinct_sessions(files: DataFrame) -> DataFrame:
    """The distinct sessions of a file listing."""
    return files.select(*schemas.SLICE_KEY).distinct()


def complete_sessions(files: DataFrame, kinds: Iterable[str] | None = None) -> DataFrame:
    """Sessions for which every kind of file exists."""
    kinds = list(kinds or schemas.KINDS)
    return (files.filter(F.col("kind").isin(*kinds))
            .groupBy(*schemas.SLICE_KEY).agg(F.count_distinct("kind").alias("kinds"))
            .filter(F.col("kinds") == len(kinds)).select(*schemas.SLICE_KEY))


def sessions_to_ingest(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Wanted sessions not yet complete on disk (laps + tel + weather)."""
    return wanted.join(complete_sessions(files), on=schemas.SLICE_KEY, how="left_anti")


def selected_sessions(discovered: DataFrame, selected: DataFrame) -> DataFrame:
    """Discovered sessions that were also selected (semi join)."""
    return discovered.join(selected.select(*schemas.SLICE_KEY).distinct(), on=schemas.SLICE_KEY, how="left_semi")


def missing_files(requested: DataFrame, files: DataFrame) -> DataFrame:
    """Requested (kind, session) pairs with no file; the caller decides to raise."""
    key = ["kind", *schemas.SLICE_KEY]
    return requested.select(*key).join(files.select(*key), on=key, how="left_anti")
