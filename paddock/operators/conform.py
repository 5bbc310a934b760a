"""Schema bridging between inferred bronze frames and declared tables.

All functions are lazy ``DataFrame -> DataFrame`` transforms.  Column presence
is tested case-insensitively because Spark resolves names that way: adding
``Driver`` to a frame that has ``driver`` would otherwise overwrite it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.functions import scalars


def _lower_names(df: DataFrame) -> set[str]:
    return {c.lower() for c in df.columns}


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in _lower_names(df)


def _exact_name(df: DataFrame, name: str) -> str | None:
    columns = df.columns
    if name in columns:
        return name
    return next((c for c in columns if c.lower() == name.lower()), None)


def rename_bronze_columns(df: DataFrame, bronze_table: str = "bronze_laps") -> DataFrame:
    """Year/Round/SessionType/GrandPrix -> snake case (+ Driver for car data).

    A column is renamed only if its source is present (exact spelling) and the
    target is absent.  For car data ``Driver`` -> ``driver`` is the same name to
    Spark, so it is renamed by exact spelling.
    """
    renames = dict(schemas.LABEL_RENAMES)
    if bronze_table == "bronze_car_data":
        renames.update(schemas.CAR_DATA_RENAMES)
    columns = df.columns
    lower = {c.lower() for c in columns}
    mapping = {}
    for source, target in renames.items():
        if source in columns and target not in columns:
            if source.lower() == target.lower() or target.lower() not in lower:
                mapping[source] = target
    return df.withColumnsRenamed(mapping) if mapping else df


def require_columns(df: DataFrame, required: list[str], types: dict | None = None) -> DataFrame:
    """Add each missing column as a NULL of its declared type (never VOID)."""
    types = schemas.BRONZE_TYPES if types is None else types
    present = _lower_names(df)
    missing = [c for c in required if c.lower() not in present]
    if not missing:
        return df
    # One projection for all of them (a single plan node, a single JVM call).
    return df.selectExpr("*", *[f"CAST(NULL AS {types.get(c, T.StringType()).simpleString()}) AS `{c}`"
                                for c in missing])


def column_or_null(df: DataFrame, name: str, data_type: T.DataType | None = None) -> Column:
    """The column if present, else a typed NULL under that name."""
    data_type = data_type or schemas.BRONZE_TYPES.get(name, T.StringType())
    found = _exact_name(df, name)
    if found is not None:
        return F.col(found)
    return F.lit(None).cast(data_type).alias(name)


def conform_bronze_types(df: DataFrame, types: dict | None = None) -> DataFrame:
    """Cast known bronze columns to their declared type (P11/P12 by physical type).

    Columns already of the declared type are left as they are, so filters on
    them still reach the Parquet reader; NaN is handled by the predicates
    (F2) and by :func:`nan_to_null_columns` in the final projection.
    """
    types = schemas.BRONZE_TYPES if types is None else types
    by_name = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for name, source_type in by_name.items():
        target = types.get(name)
        if target is None:
            continue
        if name in schemas.DURATION_COLUMNS:
            expr = scalars.duration_to_seconds(F.col(name), source_type)
        elif isinstance(target, T.TimestampNTZType):
            expr = scalars.timestamp_to_utc_us(F.col(name), source_type)
        elif source_type == target:
            continue      # untouched: predicates on it push down to the Parquet scan
        else:
            # Lenient: one malformed raw value becomes NULL (then fails the range
            # checks) instead of failing the whole job under ANSI casts.
            expr = F.col(name).try_cast(target)
        exprs[name] = expr
    return df.withColumns(exprs) if exprs else df


def cast_failures(df: DataFrame, types: dict | None = None) -> Column:
    """Names of the columns whose value :func:`conform_bronze_types` cannot keep, comma-joined; NULL if there is none."""
    types = schemas.BRONZE_TYPES if types is None else types
    conformed = conform_bronze_types(df, types)
    lost = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(types[f.name]).isNull(), F.lit(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name in types and conformed.schema[f.name].dataType != f.dataType]
    if not lost:
        return F.lit(None).cast("string")
    return F.nullif(F.array_join(F.array_compact(F.array(*lost)), ","), F.lit(""))


def nan_to_null_columns(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every DOUBLE column (applied after the filters, in the projection)."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, T.DoubleType) for f in fields):
        return df
    return df.selectExpr(*[f"CASE WHEN isnan(`{f.name}`) THEN NULL ELSE `{f.name}` END AS `{f.name}`"
                           if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`" for f in fields])


def align_to_target(df: DataFrame, target: T.StructType | str) -> DataFrame:
    """Keep only the columns the target has, in the frame's order; error if none.

    ``target`` is a schema or a table name, looked up in the declared catalog
    (S11; an unknown table is an error, as a missing table was).
    """
    if isinstance(target, str):
        if target not in schemas.TARGETS:
            raise ValueError(f"Target table {target} does not exist")
        target = schemas.schema_of(target)
    wanted = {f.name.lower() for f in target.fields}
    keep = [c for c in df.columns if c.lower() in wanted]
    if not keep:
        raise ValueError("no columns in common between frame and target table")
    return df.select(*keep)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """P10: drop columns without a single non-NULL value.

    Needs one pass over the rows, which are counted (``count(c)`` per column, one
    row to the driver) while they are written below the shared folder; the result
    reads that copy, so whatever makes ``df`` runs once.  It is the only operator
    here with an action, so it is opt-in.
    """
    from paddock.sources.tables import materialize

    typed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NullType)]   # VOID holds no value and can't be stored
    if not typed:
        return df.select()
    seen = Observation()
    copy = materialize(df.sparkSession, df.select(*typed).observe(seen, *[F.count(F.col(c)).alias(c) for c in typed]), "counted")
    counts = seen.get
    return copy.select(*[c for c in typed if counts[c] > 0])


def conform_schema(df: DataFrame, target: T.StructType, strict: bool = False) -> DataFrame:
    """Select target columns in declared order, cast to the declared types.

    Missing columns become typed NULLs (P2/P14).  ``strict`` uses ANSI ``cast``
    (a bad value fails the job); otherwise ``try_cast`` turns it into NULL so
    that the NOT NULL check can route the row to a reject frame.
    """
    source_types = {f.name: f.dataType for f in df.schema.fields}
    present = {c.lower(): c for c in source_types}
    exprs = []
    for f in target.fields:
        src = present.get(f.name.lower())
        type_sql = f.dataType.simpleString()
        if src is None:
            exprs.append(f"CAST(NULL AS {type_sql}) AS `{f.name}`")
        elif source_types[src] == f.dataType:
            exprs.append(f"`{src}` AS `{f.name}`")
        else:
            exprs.append(f"{'CAST' if strict else 'TRY_CAST'}(`{src}` AS {type_sql}) AS `{f.name}`")
    return df.selectExpr(*exprs)


def evolve_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """A frame written before a column existed reads with that column as NULL."""
    return conform_schema(df, target)
