"""Table refresh semantics as DataFrame algebra.

The reference replaced rows inside a database transaction.  Here a refresh is
a pure function (old table, stage) -> new table; ``sources.tables`` writes the
result as a new version and switches to it atomically.

Skew: every operator below is either an aggregate with partial aggregation
(so a key holding a third of all rows is pre-combined in every task before
the shuffle), a filter, or an anti join of two aggregated (gold-sized) sides.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas


def anti_join_keys(target: DataFrame, stage: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``target`` whose key has no match in ``stage`` (NULL never matches)."""
    return target.join(stage.select(*key).distinct(), on=key, how="left_anti")


def slice_predicate(slices: Iterable[tuple], slice_key: list[str]) -> Column:
    """``(year, round, session_type) IN ((y, r, s), ...)``: one flat set, whatever its length.

    On partition columns it prunes stored folders; elsewhere a row costs one lookup.  Written as SQL
    text, so thousands of sessions are parsed in one go."""
    def literal(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(int(v))

    listed = [f"({', '.join(literal(v) for v in s)})" for s in slices if all(v is not None for v in s)]
    if not listed:
        return F.lit(False)
    return F.expr(f"({', '.join(f'`{k}`' for k in slice_key)}) IN ({', '.join(listed)})")


def restrict_to_slices(df: DataFrame, slices, slice_key: list[str] | None = None,
                       keep: bool = True) -> DataFrame:
    """Rows in (``keep``) or outside (not ``keep``) the given slices.

    A list the caller holds becomes a predicate on the slice columns; a frame of slices is
    joined (planned by AQE) and never brought to the driver.  A row with a NULL slice column is
    in no slice: outside, never lost.
    """
    slice_key = slice_key or schemas.SLICE_KEY
    if isinstance(slices, DataFrame):
        return df.join(slices.select(*slice_key).distinct(), on=slice_key, how="left_semi" if keep else "left_anti")
    inside = F.coalesce(slice_predicate(slices, slice_key), F.lit(False))
    return df.filter(inside if keep else ~inside)


def stage_slices(stage: DataFrame, slice_key: list[str] | None = None) -> DataFrame:
    """The distinct sessions in ``stage``, as a frame."""
    return stage.select(*(slice_key or schemas.SLICE_KEY)).distinct()


def replace_slices(target: DataFrame, stage: DataFrame, requested: Iterable[tuple] | None = None,
                   slice_key: list[str] | None = None) -> DataFrame:
    """Drop the requested slices from ``target`` and add the ``stage`` rows of those slices.

    An empty stage still deletes its requested slices.  Stage rows outside
    the requested slices are not inserted (their data disagrees with the
    session they were delivered for).  ``requested=None`` means "the slices
    present in the stage".

    A list of sessions is a predicate: nothing is joined, other sessions stream
    through untouched, and a session holding a large share of all rows is never
    gathered into one task.  A frame of sessions is semi- and anti-joined.
    """
    slice_key = slice_key or schemas.SLICE_KEY
    slices = stage_slices(stage, slice_key) if requested is None else requested
    if not isinstance(slices, DataFrame):
        slices = [tuple(x) for x in slices]
    columns = target.columns
    kept = restrict_to_slices(target, slices, slice_key, keep=False)
    inserted = restrict_to_slices(stage, slices, slice_key, keep=True)
    return kept.select(*columns).unionByName(inserted.select(*columns))


def upsert_by_key(target: DataFrame, stage: DataFrame, key: list[str]) -> DataFrame:
    """R2: delete target rows whose key is in ``stage``, insert ``stage``; stale keys stay.

    Stage rows with a NULL key would never match and be added again on every
    run, so they are dropped here (route them to ``not_null_split`` first).
    """
    ok = F.lit(True)
    for k in key:
        ok = ok & F.col(k).isNotNull()
    stage = stage.filter(ok)
    return anti_join_keys(target, stage, key).unionByName(stage.select(*target.columns))


def pk_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicate_rows"))
            .filter(F.col("duplicate_rows") > 1))


def dedup_by_key(df: DataFrame, key: list[str]) -> DataFrame:
    """R3 (the promised dedup): one row per key, the least by all other columns.

    Written as ``min(struct(other columns))`` per key rather than a
    ``row_number`` window: a hash aggregate combines map-side, so a key with
    millions of duplicates never sorts in a single task.  Struct order is
    field by field, ascending, NULL first — the same as ``ORDER BY c1, c2, …``
    with ``NULLS FIRST``.
    """
    others = [c for c in df.columns if c not in key]
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def not_null_condition(key: list[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return cond


def not_null_split(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the NOT NULL constraint on ``key``."""
    ok = not_null_condition(key)
    return df.filter(ok), df.filter(~ok)


def flagged(df: DataFrame, key: list[str], failed: str | None = None) -> DataFrame:
    """``df`` with a ``reason`` why a row can't be in the table: a failed cast (named by column ``failed``, which goes), or a null
    key; NULL if nothing but its neighbours can be against it."""
    reason = F.when(~not_null_condition(key), F.lit("null key"))
    if failed is None:
        return df.withColumn("reason", reason)
    return df.withColumn("reason", F.coalesce(F.concat(F.lit("failed cast: "), F.col(failed)), reason)).drop(failed)


def one_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """:func:`dedup_by_key` with ``copies``, the number of rows that the one stands for."""
    others = [c for c in df.columns if c not in key]
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_best")
    return (df.groupBy(*key).agg(best, F.count(F.lit(1)).alias("copies"))
            .select(*key, *[F.col(f"_best.{c}").alias(c) for c in others], "copies").select(*df.columns, "copies"))


KEY_HASH = "_key_hash"
FILTER_WORDS = 1 << 19   # 64-bit words of the bit filter over key hashes: 4 MB of bits, whatever the input


def key_hash(df: DataFrame, key: list[str]) -> Column:
    """A 64-bit hash that rows of one key share (0.0 and -0.0 are one value)."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    return F.xxhash64(*[F.col(k) + F.lit(0.0) if k in floating else F.col(k) for k in key])


def _word() -> Column:
    return F.pmod(F.col(KEY_HASH), F.lit(FILTER_WORDS))


def _bit() -> Column:
    return F.expr(f"shiftleft(1L, int(pmod(shiftright({KEY_HASH}, 32), 64L)))")


def repeated_filter(df: DataFrame) -> DataFrame:
    """Bit filter (``_filter_word``, ``_filter_bits``) over the key hashes that occur more than once: at most ``FILTER_WORDS`` rows.
    Only the hashes are read and shuffled."""
    repeated = df.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.groupBy(_word().alias("_filter_word")).agg(F.bit_or(_bit()).alias("_filter_bits"))


def with_repeats(df: DataFrame, repeated: DataFrame) -> DataFrame:
    """``df`` with ``_repeats``: false only for rows whose key no other row has.  A crowded filter says true more often, never less."""
    met = df.join(F.broadcast(repeated), _word() == F.col("_filter_word"), "left")
    hit = F.coalesce(F.col("_filter_bits").bitwiseAND(_bit()) != 0, F.lit(False))
    return met.select(*df.columns, hit.alias("_repeats"))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Every row of a repeated key but the one that :func:`dedup_by_key` keeps.  Equal rows are counted before anything
    is joined, so a key with very many copies is one row."""
    others = F.struct(*[F.col(c) for c in df.columns if c not in key])
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    keys = rows.groupBy(*key).agg(F.sum("_n").alias("_all"), F.min(others).alias("_best")).where("_all > 1").drop("_all")
    left = rows.join(keys, key).withColumn("_n", F.col("_n") - others.eqNullSafe(F.col("_best")).cast("int")).where("_n > 0")
    return left.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy")).drop("_copy")


def rejects(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows that the key's constraints leave out, with a ``reason``: ``null key``, or ``duplicate key`` for every row of
    a key but the one that :func:`dedup_by_key` keeps.  A ``reason`` that the rows have already (:func:`flagged`) stays."""
    if "reason" not in df.columns:
        df = flagged(df, key)
    extra = duplicates(df.where("reason is null").drop("reason"), key)
    return df.where("reason is not null").unionByName(extra.withColumn("reason", F.lit("duplicate key")))


def reject_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField("reason", T.StringType())])


def not_null_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """R4 report: per key column, how many rows hold NULL there (one pass)."""
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in key])
    stack = ", ".join(f"'{k}', `{k}`" for k in key)
    return counts.selectExpr(f"stack({len(key)}, {stack}) as (column_name, null_rows)")


def slice_row_counts(df: DataFrame, slice_key: list[str] | None = None) -> DataFrame:
    """A10: rows per written slice."""
    slice_key = slice_key or schemas.SLICE_KEY
    return df.groupBy(*slice_key).agg(F.count(F.lit(1)).alias("row_count"))
