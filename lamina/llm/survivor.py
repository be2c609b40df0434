"""Best representative of each duplicate group: field-by-field survivorship in a single aggregation.

For each field the maximum of a composite struct (source priority, time, row id, value) over the rows whose
value is real. The maxima merge before the shuffle, so a hot object costs one row a partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.text import is_real
from lamina.functions.uids import object_of

_EPOCH = "0001-01-01 00:00:00"
MAIN_SHARD = "captions.jsonl"
WORKER_SHARD = r"^captions_w[0-9]+\.jsonl\z"


@dataclass(frozen=True)
class Field:
    """A field to keep: its value, which rows may give it, and the rank of their source (larger wins)."""

    name: str
    value: Column
    usable: Column
    priority: Column


def survivors(df: DataFrame, key: Column, row_id: str, written: str, fields: list[Field]) -> DataFrame:
    """One row per key with at least two different row ids: key, and for each field its value and <field>_id.

    Of several rows the higher priority wins, then the later time (null is earliest), then the larger row id.
    Without a usable row the value is null and the id 0. Rows without key are left out; rows stored twice count once.
    """
    at = F.coalesce(F.col(written), F.lit(_EPOCH).cast("timestamp_ntz"))
    rows = df.select(
        key.alias("key"),
        F.col(row_id).alias("row_id"),
        *[F.when(f.usable, F.struct(f.priority.alias("p"), at.alias("at"), F.col(row_id).alias("id"), f.value.alias("v"))).alias(f.name) for f in fields],
    ).filter("key is not null")
    g = rows.groupBy("key").agg(F.min("row_id").alias("_lo"), F.max("row_id").alias("_hi"), *[F.max(f.name).alias(f.name) for f in fields])
    kept = [c for f in fields for c in (F.col(f"{f.name}.v").alias(f.name), F.coalesce(F.col(f"{f.name}.id"), F.lit(0)).cast("long").alias(f"{f.name}_id"))]
    return g.filter("_lo <> _hi").select("key", *kept)


def caption_survivors(captions: DataFrame) -> DataFrame:
    """(uid, caption, caption_id, family, family_id): the caption from the main shard where a family was named, else from a worker, else from the rest; the family from any row."""
    named = is_real(F.col("family"))
    first = (F.col("shard") == MAIN_SHARD) & named
    rank = F.when(F.coalesce(first, F.lit(False)), 2).when(F.coalesce(F.col("shard").rlike(WORKER_SHARD), F.lit(False)), 1).otherwise(0)
    fields = [Field("caption", F.col("caption"), is_real(F.col("caption")), rank), Field("family", F.col("family"), named, F.lit(0))]
    return survivors(captions, object_of(F.col("uid")), "caption_id", "written_at", fields).withColumnRenamed("key", "uid")
