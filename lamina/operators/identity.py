"""Identity, hashing, order and content keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lamina.functions.uids import VALID
from lamina.operators.numbering import numbered

SALT = "lamina/1"
SPAN = 2**31 - 1


def check_uid(c: Column) -> Column:
    """The uid, or an error that names it."""
    return F.when(c.rlike(VALID), c).otherwise(F.raise_error(F.concat(F.lit("invalid uid: "), F.coalesce(c, F.lit("null"))))).cast("string")


def content_uid(content: Column) -> Column:
    """The id of a file: sha256 of its bytes, as hex."""
    return F.sha2(content.cast("binary"), 256)


def _blake(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else hashlib.blake2b(t.encode(), digest_size=8).hexdigest())


def rank_blake2b(uid: Column, salt: str = SALT) -> Column:
    """Stable shuffle key: 8 bytes of blake2b over uid|salt, as hex (no built-in expression has blake2b)."""
    return F.pandas_udf(_blake, StringType())(F.concat(uid, F.lit("|" + salt)))


def rank_sha256(uid: Column, salt: str = SALT) -> Column:
    """The same idea with a built-in hash, so that it stays in generated code."""
    return F.substring(F.sha2(F.concat(uid, F.lit("|" + salt)), 256), 1, 16)


def pilot(objects: DataFrame, n: int, rank: Column, uid: str = "uid") -> DataFrame:
    """The first n objects in rank order (0: all), with their place. Objects are not deduplicated.

    A prefix is a top-k: each task keeps n rows, so no task sorts the population; all of it is numbered by ranges.
    """
    ranked = objects.select(F.col(uid).alias("uid"), rank.alias("rank_key"))
    if not n:
        return numbered(ranked, ["rank_key", "uid"], "place")
    ranked = ranked.orderBy("rank_key", "uid").limit(n)
    return ranked.withColumn("place", F.row_number().over(Window.orderBy("rank_key", "uid")) - 1)


def object_seed(uid: Column, stage: Column | str, attempt: Column | int = 0, span: int = SPAN) -> Column:
    """Seed of (object, stage, attempt): the first 8 bytes of sha256 of uid|stage|attempt, big-endian, modulo span."""
    stage = F.lit(stage) if isinstance(stage, str) else stage
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    h = F.substring(F.sha2(F.concat_ws("|", uid, stage, attempt.cast("string")), 256), 1, 16)
    return (F.conv(h, 16, 10).cast("decimal(20,0)") % F.lit(span)).cast("long")


def reference_seed(uid: Column, attempt: Column | int = 0) -> Column:
    """Seed of a reference image: the first 8 hex digits of sha256(uid), plus 1000 for each attempt."""
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    return F.conv(F.substring(F.sha2(uid, 256), 1, 8), 16, 10).cast("long") + F.lit(1000) * attempt


def content_key(*parts: Column, length: int = 16) -> Column:
    """Key over everything that determines a product: sha256 of the parts joined by |; null reads None."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, length)


#: Recipe fields that decide the generated atlas, and those that decide only the delivered texture.
GENERATION_FIELDS = ("reference_model", "reference_steps", "reference_suffix", "atlas_resolution", "uv_convention")
DELIVERY_FIELDS = ("texture_resolution", "margin_px")


def recipe_digest(recipe: dict, fields: Iterable[str] = GENERATION_FIELDS, version: str = "lamina.recipe/1") -> str:
    """12 hex digits over the values of the fields and the recipe version; a driver-side literal."""
    joined = "|".join([version, *[f"{n}={recipe.get(n)!r}" for n in fields]])
    return hashlib.sha256(joined.encode()).hexdigest()[:12]


def generation_key(caption: Column, attempt: Column, digest: str) -> Column:
    return content_key(F.coalesce(caption, F.lit("")), F.concat(F.lit("attempt="), F.coalesce(attempt, F.lit(0)).cast("string")), F.lit(digest))


def delivery_key(generation: Column, digest: str) -> Column:
    return content_key(generation, F.lit(digest))


def added_objects(sets: DataFrame, group: str, order: str, uid: str) -> DataFrame:
    """For each set of a growing population: distinct objects, and how many of them no earlier set of the group had."""
    each = sets.filter(F.col(uid).isNotNull()).select(group, order, F.col(uid).alias("uid")).distinct()
    first = Window.partitionBy(group, "uid")
    return each.withColumn("_first", F.min(order).over(first)).groupBy(group, order).agg(F.count("*").alias("n_objects"), F.sum((F.col("_first") == F.col(order)).cast("long")).alias("added"))


def extend_population(have: DataFrame, new: DataFrame, rank: Column, uid: str = "uid") -> DataFrame:
    """Union of both sets without repeats, in rank order, with a mark on what was added."""
    a, b = have.select(uid).distinct(), new.select(uid).distinct()
    both = a.withColumn("_old", F.lit(1)).unionByName(b.withColumn("_old", F.lit(0))).groupBy(uid).agg(F.max("_old").alias("_old"))
    return both.select(uid, rank.alias("rank_key"), (F.col("_old") == 0).alias("added"))
