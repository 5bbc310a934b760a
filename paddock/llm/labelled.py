"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID, TEXT, TARGET = "__id", "__text", "__target"


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, target: Column, size: int, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``__id``, ``__text``, ``__target`` of at most ``size`` labelled documents outside the held-out fold,
    chosen by a hash of the id; rows without an id or a target are left out, repeated labels count once.

    The chosen labels (at most ``size`` rows, whatever the input) are broadcast, so documents are scanned
    and not shuffled.  Repeated document rows may still multiply: limit again what is gathered."""
    chosen = (labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias(ID)).agg(F.max(target).alias(TARGET)).where(F.col(TARGET).isNotNull())
              .orderBy(F.xxhash64(ID), ID).limit(size))
    rows = docs.select(F.col(id_col).alias(ID), F.coalesce(F.col(text), F.lit("")).alias(TEXT))
    return rows.join(F.broadcast(chosen), ID)
