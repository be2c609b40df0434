"""Processing only new or changed records: the target is the state.

Every row of the target names its source: key, position (event time, row id) and version (a digest of the
compared columns), and whether the version was new to its key. A run takes the source rows that arrived since the
cutoff of the last published version, keeps one per key, and anti-joins them against the target by key, position and
version; what remains is published as a new version by a manifest that can be written only once. A run that dies
before leaves nothing a reader sees, and its repetition takes up the same rows; a published run that is repeated,
or is run twice at once, does nothing more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.session import fits, shared_table
from lamina.sources.versions import Versions

_EPOCH = "0001-01-01 00:00:00"
_SCHEMA = "key binary, at timestamp_ntz, row_id long, version binary, changed boolean, run_id int"
#: Up to so many new rows (16 bytes each) are sent to the target's rows; more are joined by a shuffle.
SENT = 50_000


def digest(*cols: Column) -> Column:
    """16 bytes of the columns, nulls and NaN being values, 0.0 and -0.0 the same value."""
    return F.unhex(F.md5(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]))))


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form whose JSON is equal exactly where the values are."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(f"`{name}`")
    if kind in ("double", "float"):
        return c + F.lit(0.0)
    if kind == "map":
        return F.array_sort(F.map_entries(c))
    return c


def source_rows(df: DataFrame, key: list[Column], at: str, row_id: str, arrived: str, compared: list[Column]) -> DataFrame:
    """The source as (key, at, row_id, version, arrived): `at` null counts as earliest, rows without arrival are never visible."""
    return df.select(
        digest(*key).alias("key"),
        F.coalesce(F.col(at), F.lit(_EPOCH).cast("timestamp_ntz")).alias("at"),
        F.col(row_id).cast("long").alias("row_id"),
        digest(*compared).alias("version"),
        F.col(arrived).alias("arrived"),
    )


def latest_state(rows: DataFrame) -> DataFrame:
    """One row per key: the latest at, then the larger row_id."""
    return rows.groupBy("key").agg(F.max(F.struct("at", "row_id", "version")).alias("s")).select("key", "s.at", "s.row_id", "s.version")


class VersionedTarget(Versions):
    """The target as published versions, one a run."""

    def rows(self, before: int | None = None) -> DataFrame:
        """Rows of the published versions, with run_id below `before` if given."""
        return self.read([m for v, m in self.published().items() if before is None or v < before], _SCHEMA)

    def advance(self, new: DataFrame, run_id: int, rows: int | None = None) -> bool:
        """Publish what is new: the rows of `new` (one a key) that are later than the target's row of their key.

        Rows whose state moved but compares equal are stored with `changed` false: without their position a late
        row could pass for a change. False where the run is published already. rows: how many there are, where that is known.
        """
        versions = self.published()
        if run_id in versions:
            return False
        held = [m for v, m in versions.items() if v < run_id]
        if not held:
            return self.publish(run_id, self.write(new.select("key", "at", "row_id", "version", F.lit(True).alias("changed"), F.lit(run_id).cast("int").alias("run_id"))))
        # few new rows go to the target, so that it is not shuffled; else Spark's own runtime filters thin it out
        keys = new.select("key")
        few = fits(keys, SENT) if rows is None else rows <= SENT
        touched = self.read(held, _SCHEMA).join(F.broadcast(keys) if few else keys, "key", "left_semi")
        k, n = latest_state(touched).alias("k"), new.alias("n")
        known = (F.col("k.at") > F.col("n.at")) | ((F.col("k.at") == F.col("n.at")) & (F.col("k.row_id") >= F.col("n.row_id")))
        later = n.join(k, F.col("n.key") == F.col("k.key"), "left").filter(~F.coalesce(known, F.lit(False)))
        changed = F.coalesce(F.col("k.version") != F.col("n.version"), F.lit(True))
        return self.publish(run_id, self.write(later.select("n.key", "n.at", "n.row_id", "n.version", changed.alias("changed"), F.lit(run_id).cast("int").alias("run_id"))))

    def changes(self) -> DataFrame:
        """(run_id, row_id) of every key whose version is not that of the run before, or that had none."""
        return self.rows().filter("changed").select("run_id", "row_id")


def successful_runs(runs: DataFrame, consumer: str) -> list[tuple[int, object]]:
    """(run_id, cutoff) of the runs whose last log row says succeeded, in order. The log is one row a run step, so bounded."""
    last = runs.filter(F.col("consumer") == consumer).groupBy("run_id").agg(F.max(F.struct("logged_at", "outcome", "cutoff_at")).alias("l"))
    done = last.filter(F.col("l.outcome") == "succeeded").select("run_id", F.col("l.cutoff_at").alias("cutoff_at"))
    return [(r.run_id, r.cutoff_at) for r in done.orderBy("run_id").collect()]


def claims_source(claims: DataFrame) -> DataFrame:
    """Units (stage, uid, content_key) of the ledger; rows without uid are no unit. State: op and owner."""
    unit = [F.col(c) for c in ("stage", "uid", "content_key")]
    return source_rows(claims.filter("uid is not null"), unit, "event_at", "claim_id", "recorded_at", [F.col("op"), F.col("owner")])


#: Columns that tell measurement rows apart but are no measurement.
NOT_COMPARED = ("measurement_id", "load_id", "uid", "measured_at", "arrived_at")


def measurements_source(measurements: DataFrame) -> DataFrame:
    """Objects of the measurements. State: every column but ids, load and times."""
    from lamina.functions.uids import object_of

    obj = object_of(F.col("uid"))
    compared = [comparable(measurements, c) for c in measurements.columns if c not in NOT_COMPARED]
    return source_rows(measurements.filter(obj.isNotNull()), [obj], "measured_at", "measurement_id", "arrived_at", compared)


def arrivals(source: DataFrame, cutoff, after=None) -> DataFrame:
    """One row per key of what arrived in (after, cutoff]; a source laid out by arrival is read only there."""
    new = source.filter(F.col("arrived") <= F.lit(cutoff))
    return latest_state(new if after is None else new.filter(F.col("arrived") > F.lit(after)))


def by_run(source: DataFrame, runs: list[tuple[int, object]]) -> DataFrame:
    """The source read once and laid out by the first run that sees each row, one row per run and key; runs are a bounded log."""
    slot, last = None, None
    for run_id, cutoff in runs:
        if last is None or cutoff > last:
            seen = F.col("arrived") <= F.lit(cutoff)
            slot = F.when(seen, run_id) if slot is None else slot.when(seen, run_id)
            last = cutoff
    at = shared_table(source.sparkSession, "arrivals")
    rows = source.withColumn("slot", slot if slot is not None else F.lit(None).cast("int")).filter("slot is not null")
    rows = rows.groupBy("slot", "key").agg(F.max(F.struct("at", "row_id", "version")).alias("s")).select("slot", "key", "s.at", "s.row_id", "s.version")
    rows.write.partitionBy("slot").parquet(at)
    return source.sparkSession.read.schema("key binary, at timestamp_ntz, row_id long, version binary, slot int").parquet(at)


def replay(source: DataFrame, runs: list[tuple[int, object]], path: str) -> VersionedTarget:
    """Every successful run in turn against one target."""
    target = VersionedTarget(source.sparkSession, path)
    laid = by_run(source, runs)
    sizes = {r.slot: r["count"] for r in laid.groupBy("slot").count().collect()}  # one row a run
    for run_id, _ in runs:
        target.advance(laid.filter(F.col("slot") == run_id).drop("slot"), run_id, sizes.get(run_id, 0))
    return target
