"""JSON sources and sinks, and configuration files."""

from __future__ import annotations

import json
import os
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.operators.gates import Thresholds
from lamina.session import fits, settled

CAPTION_SCHEMA = "uid string, caption string, error string, family string"


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, line_no, value) of text files: line numbers from 1 in each file, however a file is split for reading.

    Lines of a split are numbered in their task, on top of the lines of the splits before; there is one number a split.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    lines = settled(lines, "lines")
    splits = lines.groupBy("path", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_base"))
    splits = F.broadcast(splits) if fits(splits, 100_000) else splits
    return lines.join(splits, ["path", "_block"]).select("path", (F.col("_id") + F.col("_base")).alias("line_no"), "value")


def read_captions(spark: SparkSession, *paths: str) -> DataFrame:
    """(uid, caption, error, family, shard, line_no) of JSONL shards, blank lines left out; a broken line has null fields."""
    lines = numbered_lines(spark, *paths).withColumn("shard", F.element_at(F.split("path", "/"), -1))
    return lines.filter(F.trim("value") != "").select(F.from_json("value", CAPTION_SCHEMA).alias("r"), "shard", "line_no").select("r.*", "shard", "line_no")


def write_jsonl(df: DataFrame, path: str, order: str = "uid") -> None:
    """One JSON object a line, ordered; the folder appears whole, by the commit protocol."""
    df.orderBy(order).write.mode("overwrite").json(path)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """(uid, place) of a population file: a list, or an object with uids or objects."""
    text = spark.read.option("wholetext", True).text(path)
    items = F.coalesce(F.from_json("value", "array<string>"), F.from_json("value", "uids array<string>")["uids"], F.from_json("value", "objects array<string>")["objects"])
    return text.select(F.posexplode(items).alias("place", "uid"))


def load_thresholds(path: str) -> Thresholds:
    """Thresholds of a YAML or JSON file with the names of Thresholds; what it lacks has its default, a missing file is an error."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"no thresholds at {p}")
    data = _parse(p)
    names = {f.name for f in fields(Thresholds)}
    unknown = sorted(set(data) - names)
    if unknown:
        raise ValueError(f"unknown thresholds: {', '.join(unknown)}")
    return Thresholds(**data)


def load_config(path: str, required: tuple[str, ...] = (), prefix: str = "LAMINA_") -> dict:
    """A configuration with environment variables (prefix + name) over it; what is required and missing is named."""
    data = _parse(Path(path))
    for k in list(data) + [r for r in required if r not in data]:
        if (v := os.environ.get(prefix + k.upper())) is not None:
            data[k] = v
    missing = [r for r in required if not data.get(r)]
    if missing:
        raise ValueError(f"missing in {path}: {', '.join(missing)}")
    return data


def _parse(p: Path) -> dict:
    text = p.read_text()
    if p.suffix == ".json":
        return json.loads(text or "{}")
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need PyYAML; use JSON") from e
    return yaml.safe_load(text) or {}
