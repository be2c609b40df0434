"""Caption records: merge of shards, latest, prompts, views, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truthy(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def merge(captions: DataFrame, existing: str = "captions.jsonl") -> DataFrame:
    """One record per uid: the last existing record with a family, else the last line of the last shard by path, else the first existing one.

    Rows with a null or empty uid are left out. One aggregation over a composite struct.
    """
    old = F.col("shard") == existing
    rank = F.when(old & truthy(F.col("family")), 3).when(~old, 2).otherwise(1)
    line = F.when(old & ~truthy(F.col("family")), -F.col("line_no")).otherwise(F.col("line_no"))
    top = F.max(F.struct(rank.alias("r"), F.when(old, F.lit("")).otherwise(F.col("shard")).alias("s"), line.alias("l"), F.col("caption_id").alias("id"), "caption", "family", "error"))
    g = captions.filter(truthy(F.col("uid"))).groupBy("uid").agg(top.alias("t"))
    return g.select("uid", F.col("t.id").alias("caption_id"), F.col("t.caption").alias("caption"), F.col("t.family").alias("family"), F.col("t.error").alias("error"))


def stats(merged: DataFrame) -> DataFrame:
    """(objects, with_caption, curated) of merged captions, one row."""
    return merged.agg(F.count("*").alias("objects"), F.count_if(truthy(F.col("caption"))).alias("with_caption"), F.count_if(truthy(F.col("family"))).alias("curated"))


def latest(captions: DataFrame, order: str = "line_no") -> DataFrame:
    """The last non-empty caption of each uid."""
    return captions.filter(truthy(F.col("caption")) & F.col("uid").isNotNull()).groupBy("uid").agg(F.max(F.struct(order, "caption_id", "caption")).alias("t")).select("uid", "t.caption_id", "t.caption")


#: The characters that count as blanks, as a class; every engine here reads it alike.
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+\z", "")


def prompt(caption: Column, suffix: str) -> Column:
    """Caption without blanks around it and without stops at the end, then the suffix."""
    return F.concat(F.regexp_replace(stripped(caption), r"\.+\z", ""), F.lit(suffix))


def clean(caption: Column, limit: int = 220) -> Column:
    """Without blanks, then quotes around it, runs of blanks as one space, at most `limit` characters (the field's length)."""
    unquoted = F.regexp_replace(stripped(caption), r'^"+|"+\z', "")
    return F.substring(stripped(F.regexp_replace(unquoted, BLANK + "+", " ")), 1, limit)


#: Characters of an error that are kept, of one object and of a batch.
OBJECT_ERROR, BATCH_ERROR = 150, 180


def error_text(c: Column, limit: int = OBJECT_ERROR) -> Column:
    """What is kept of an error: its first characters (the field's length)."""
    return F.substring(c, 1, limit)


def views(sources: DataFrame, n: int = 2) -> DataFrame:
    """The first n views by name of each uid, from the source of the highest preference that has any."""
    best = Window.partitionBy("uid")
    place = Window.partitionBy("uid").orderBy("name")
    return sources.withColumn("_best", F.min("preference").over(best)).filter("preference = _best").withColumn("place", F.row_number().over(place)).filter(F.col("place") <= n).drop("_best")


def batches(work: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """Work of each group in order, numbered in batches of `size`; the last may be smaller."""
    w = Window.partitionBy(group).orderBy(*order)
    return work.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
