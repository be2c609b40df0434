"""A reproducible sample that keeps its members as data grows: golden-ratio selection over sequence numbers.

Every object gets a sequence number once, kept in a registry of published versions: a run numbers the objects the
registry lacks, in order of first arrival, after the largest number given. What arrives later, with whatever
arrival time, moves no number. The number times the golden ratio, plus a fixed shift, falls on the circle [0, 1)
with even gaps at every length of the sequence; objects in a fixed interval are chosen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.uids import object_of
from lamina.operators.numbering import bases, placed
from lamina.session import shared_dir
from lamina.sources.versions import Versions

#: 2**31 divided by the golden ratio, made odd: products with 31-bit numbers stay within 63 bits.
CIRCLE = 1 << 31
GOLDEN = 1327217885


def first_arrivals(sources: list[tuple[DataFrame, Column, str]]) -> DataFrame:
    """(uid, first_at): each object with its earliest arrival in any source (frame, uid column, arrival column).

    Values that spell no object are left out; first_at is null for an object without any arrival time.
    """
    rows = None
    for df, uid, at in sources:
        part = df.select(object_of(uid).alias("uid"), F.col(at).alias("first_at"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.filter("uid is not null").groupBy("uid").agg(F.min("first_at").alias("first_at"))


class Registry(Versions):
    """(uid, seq) of all objects ever numbered, as published versions of new objects each.

    A version's rows are (uid, _part, _in); its manifest holds the number at which each range begins, one a range.
    """

    def rows(self) -> DataFrame:
        manifests = self.published()
        starts = [(v, int(p), b) for v, m in manifests.items() for p, b in m["starts"].items()]
        begin = self.spark.createDataFrame(starts, "_version int, _part int, _begin long")
        rows = None
        for v, m in manifests.items():
            part = self.read([m], "uid string, _part int, _in long").withColumn("_version", F.lit(v))
            rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            return self.spark.createDataFrame([], "uid string, seq long")
        # as many rows as versions have ranges
        return rows.join(F.broadcast(begin), ["_version", "_part"]).select("uid", (F.col("_begin") + F.col("_in")).alias("seq"))

    def extend(self, objects: DataFrame) -> int:
        """Numbers the objects (uid, first_at) that have none, by first arrival (unknown ones last), then uid; how many there were.

        Where another run publishes first, its numbers hold and the rest is worked out anew.
        """
        while True:
            manifests = self.published()
            new = objects.join(self.rows().select("uid"), "uid", "left_anti") if manifests else objects
            name = self.write(placed(new, [F.col("first_at").asc_nulls_last(), F.col("uid")]).select("uid", "_part", "_in"))
            sizes = bases(self.read([{"data": name}], "uid string, _part int, _in long")).collect()  # one row a range
            count = sum(r["_n"] for r in sizes)
            if not count:
                self.drop(name)
                return 0
            last = max(manifests, default=0)
            start = manifests[last]["next"] if manifests else 0
            if self.publish(last + 1, name, next=start + count, starts={r["_part"]: start + r["_base"] for r in sizes}):
                return count


def registry_of(spark: SparkSession, folder: str) -> Registry:
    """The registry of the queries over a folder: under spark.lamina.registry where that is set, to be kept from run to run, else in
    the shared folder for as long as the application lives."""
    name = hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:16]
    kept = spark.conf.get("spark.lamina.registry", None)
    return Registry(spark, f"{kept.rstrip('/')}/{name}" if kept else f"{shared_dir(spark)}/lamina-registry/{spark.sparkContext.applicationId}/{name}")


def chosen(seq: Column, rate: float, shift: int = 0) -> Column:
    """Whether the point of the sequence number lies in the interval [0, rate) of the circle."""
    point = (seq % CIRCLE * F.lit(GOLDEN) + F.lit(shift)) % CIRCLE
    return point < F.lit(int(rate * CIRCLE))


def sample(registry: Registry, sources: list[tuple[DataFrame, Column, str]], rate: float, shift: int = 0) -> DataFrame:
    """(uid, seq) of the chosen objects, a share `rate` of all the registry knows once those of the sources are in it.

    Empty sources add nothing; repeated rows change nothing.
    """
    registry.extend(first_arrivals(sources))
    return registry.rows().filter(chosen(F.col("seq"), rate, shift)).select("uid", "seq")
