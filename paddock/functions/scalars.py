"""Scalar and aggregate building blocks, all JVM-side column expressions.

No Python UDFs anywhere: every helper returns a ``Column`` that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Averages are exact: every value is taken to whole microseconds (half-up, as
# a cast to decimal(18,6) would) and summed as a LONG — a primitive, codegen'd
# aggregate buffer, independent of the order partial sums arrive in (a double
# sum is not) and far cheaper than a decimal(28,6) buffer.  Only the final,
# per-group division and rounding happen in decimal.
EXACT = "decimal(18,6)"
MICROS = 1_000_000

# --- fixed values: bronze checkpoint file naming ---
# "<kind>_checkpoint_<year>_r<round>_<R|Q>.parquet"; legacy files lack "_<R|Q>".
CHECKPOINT_NAME = r"^(laps|tel|weather)_checkpoint_(\d+)_r(\d+)(?:_([RQ]))?\.parquet$"
LEGACY_SESSION_TYPE = "R"
# A checkpoint may be a single file or a folder of part files named like one.
CHECKPOINT_IN_PATH = r"/((?:laps|tel|weather)_checkpoint_\d+_r\d+(?:_[RQ])?\.parquet)(?:/[^/]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_micros(c) -> Column:
    """x -> whole micro-units as LONG, rounded half away from zero (like ``cast(x as decimal(18,6))``)."""
    c = _c(c)
    return (F.signum(c) * F.floor(F.abs(c) * float(MICROS) + 0.5)).cast("long")


# Magnitudes beyond which the exact paths would overflow: values are then rounded as doubles.
AVG_LIMIT, DECIMAL_LIMIT = 1e9, 1e11


def avg_state(c) -> Column:
    """Mergeable state of an exact average: how many values, their sum in whole micro-units, the largest magnitude, and the plain
    sum for values that micro-units can't hold.  NULL sums stand for an overflow or for no values."""
    c = _c(c)
    small = F.abs(c) <= AVG_LIMIT
    return F.struct(F.count(c).alias("n"), F.try_sum(F.when(small, to_micros(F.when(small, c)))).alias("micros"),
                    F.max(F.abs(c)).alias("most"), F.sum(c).alias("plain"))


def merge_avg_states(state) -> Column:
    """Aggregate of states: the state of all their values together."""
    s = _c(state)
    micros, held = s["micros"], s["n"] > 0
    lost = F.bool_or(held & micros.isNull())
    return F.struct(F.sum(s["n"]).alias("n"), F.when(~lost, F.try_sum(micros)).alias("micros"), F.max(s["most"]).alias("most"),
                    F.sum(s["plain"]).alias("plain"))


def avg_of_state(state, scale: int) -> Column:
    """``round(avg(x), scale)`` as DOUBLE, averaged exactly.

    avg = sum(micros) / count, kept in decimal at 6 places of a micro-unit, rounded half-up to ``scale`` places of the unit; NULL for
    no values.  If a value is beyond ``AVG_LIMIT`` (or not finite, or the sum overflows) it is the plain double average."""
    s = _c(state)
    exact = F.round(F.try_divide(s["micros"].cast("decimal(38,0)"), s["n"]), scale - 6).cast("double") / float(MICROS)
    plain = F.round(F.try_divide(s["plain"], s["n"]), scale)
    return F.when((s["most"] <= AVG_LIMIT) & s["micros"].isNotNull(), exact).otherwise(plain)


def round_avg(c, scale: int) -> Column:
    """The rounded exact average of a column, as one aggregate expression."""
    return avg_of_state(avg_state(c), scale)


def _round_exact(value: Column, scale: int) -> Column:
    return F.when(F.abs(value) <= DECIMAL_LIMIT, F.round(value.try_cast(EXACT), scale).cast("double")).otherwise(
        F.round(value, scale))


def round_exact(c, scale: int) -> Column:
    """A value rounded half-up from its exact decimal; beyond ``DECIMAL_LIMIT`` as a double."""
    return _round_exact(_c(c), scale)


def round_min(c, scale: int) -> Column:
    """``round(min(x), scale)`` as DOUBLE."""
    return _round_exact(F.min(_c(c)), scale)


def round_max(c, scale: int) -> Column:
    """``round(max(x), scale)`` as DOUBLE."""
    return _round_exact(F.max(_c(c)), scale)


def round_half_up(c, scale: int) -> Column:
    """Row-level ``round(x, n)`` half-up, decimal-exact."""
    return F.round(_c(c).cast(EXACT), scale).cast("double")


def count_equal(c, value) -> Column:
    """``count(when(x == value, 1))``: NULL and other values count nowhere."""
    return F.count(F.when(_c(c) == F.lit(value), F.lit(1)))


def pct(condition: Column) -> Column:
    """Percentage of rows for which ``condition`` is true (NULL counts as false),
    half-up to 3 decimals from an exact decimal ratio; NULL for no rows."""
    share = F.try_divide(F.count_if(condition).cast("decimal(20,0)") * 100, F.count(F.lit(1)))
    return F.round(share, 3).cast("double")


def nan_to_null(c) -> Column:
    """NaN -> NULL, so ``x > 0`` and averages never see NaN."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def micros_to_ntz(micros) -> Column:
    """Micros since the epoch -> UTC wall clock as TIMESTAMP_NTZ (no session zone involved)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", _c(micros), epoch)


def duration_to_seconds(c, data_type: T.DataType) -> Column:
    """Duration -> DOUBLE seconds, chosen by physical type, never by magnitude.

    * day-time interval: exact seconds with microsecond precision;
    * BIGINT: nanoseconds (what an un-normalised timedelta becomes);
    * any other number: already seconds.
    """
    c = _c(c)
    if isinstance(data_type, T.DayTimeIntervalType):
        return c.cast(T.DayTimeIntervalType(3, 3)).cast("decimal(18,6)").cast("double")
    if isinstance(data_type, T.LongType):
        return c.cast("double") / F.lit(1e9)
    if isinstance(data_type, T.DoubleType):
        return c      # kept raw so range predicates still push into the scan
    return c.try_cast("double")


def timestamp_to_utc_us(c, data_type: T.DataType) -> Column:
    """Any timestamp form -> naive UTC TIMESTAMP_NTZ at microsecond precision.

    * TIMESTAMP (instant): its UTC wall clock;
    * TIMESTAMP_NTZ: kept;
    * BIGINT (nanoseconds, read with nanosAsLong): truncated to microseconds.
    """
    c = _c(c)
    if isinstance(data_type, T.TimestampType):
        return micros_to_ntz(F.unix_micros(c))
    if isinstance(data_type, T.TimestampNTZType):
        return c
    if isinstance(data_type, T.LongType):
        return micros_to_ntz(F.floor(c.cast("decimal(38,0)") / F.lit(1000)).cast("long"))
    return c.try_cast("timestamp_ntz")


def checkpoint_kind(name) -> Column:
    return F.regexp_extract(_c(name), CHECKPOINT_NAME, 1)


def checkpoint_year(name) -> Column:
    return F.regexp_extract(_c(name), CHECKPOINT_NAME, 2).cast("int")


def checkpoint_round(name) -> Column:
    """Round number from a checkpoint file name."""
    return F.regexp_extract(_c(name), CHECKPOINT_NAME, 3).cast("int")


def checkpoint_session_raw(name) -> Column:
    """Session suffix as written; '' for legacy names."""
    return F.regexp_extract(_c(name), CHECKPOINT_NAME, 4)


def checkpoint_session(name) -> Column:
    """Session type from the name; legacy names default to 'R' (S4)."""
    return F.coalesce(F.nullif(checkpoint_session_raw(name), F.lit("")), F.lit(LEGACY_SESSION_TYPE))


def is_legacy_name(name) -> Column:
    return checkpoint_session_raw(name) == F.lit("")


def checkpoint_tag(year, rnd, session_type) -> Column:
    """``checkpoint_<year>_r<round>_<session>``."""
    return F.format_string("checkpoint_%d_r%d_%s", _c(year), _c(rnd), _c(session_type))


def checkpoint_file_name(kind, year, rnd, session_type, legacy: Column | None = None) -> Column:
    """``<kind>_checkpoint_<year>_r<round>[_<session>].parquet``."""
    suffixed = F.format_string("%s_checkpoint_%d_r%d_%s.parquet", _c(kind), _c(year), _c(rnd), _c(session_type))
    if legacy is None:
        return suffixed
    plain = F.format_string("%s_checkpoint_%d_r%d.parquet", _c(kind), _c(year), _c(rnd))
    return F.when(legacy, plain).otherwise(suffixed)


def checkpoint_entry_name(path) -> Column:
    """The checkpoint name inside a path (the file itself or the folder holding its parts)."""
    return F.regexp_extract(_c(path), CHECKPOINT_IN_PATH, 1)
