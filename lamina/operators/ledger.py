"""The work ledger in batch: claims, leases, completions, what remains, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEASE_SECONDS = 1800


def latest_done(claims: DataFrame) -> DataFrame:
    """The last completion of each (stage, uid): key, owner, time and extra; later time wins, then the larger id."""
    done = claims.filter((F.col("op") == "complete") & F.col("uid").isNotNull())
    top = F.max_by(F.struct("claim_id", "content_key", "owner", "event_at", "extra"), F.struct("event_at", "claim_id"))
    g = done.groupBy("stage", "uid").agg(top.alias("t"))
    return g.select("stage", "uid", "t.claim_id", "t.content_key", "t.owner", "t.event_at", "t.extra")


def done_extra(extra: Column) -> Column:
    """What the completing stage recorded besides the ledger's own fields."""
    return F.map_filter(extra, lambda k, v: ~k.isin("uid", "key", "owner", "at"))


def lease_epochs(claims: DataFrame, lease: int = LEASE_SECONDS) -> DataFrame:
    """Every event with the number of its lease within the unit (stage, uid, content_key).

    A lease begins with the first event of a unit, after a release or completion, or when the unit was silent
    for longer than the lease.
    """
    w = Window.partitionBy("stage", "uid", "content_key").orderBy("event_at", "claim_id")
    gap = F.unix_micros(F.col("event_at").cast("timestamp")) - F.unix_micros(F.lag("event_at").over(w).cast("timestamp"))
    opens = F.coalesce(F.lag("op").over(w).isin("complete", "release") | (gap > lease * 1_000_000), F.lit(True))
    rows = claims.filter(F.col("uid").isNotNull() & F.col("event_at").isNotNull()).dropDuplicates(["claim_id"])
    rows = rows.withColumn("opens", opens)
    return rows.withColumn("epoch", F.sum(F.col("opens").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def winners(claims: DataFrame, lease: int = LEASE_SECONDS) -> DataFrame:
    """The claim that won each lease: the first claim event of the epoch."""
    e = lease_epochs(claims, lease).filter("op = 'claim'")
    g = e.groupBy("stage", "uid", "content_key", "epoch").agg(F.min(F.struct("event_at", "claim_id", "owner")).alias("t"))
    return g.select("stage", "uid", "content_key", "epoch", "t.claim_id", "t.owner")


def expired(claims: DataFrame, now: Column, lease: int = LEASE_SECONDS) -> DataFrame:
    """Units whose last event is a claim or touch, with whether its lease ran out at `now`."""
    live = claims.filter("uid is not null and event_at is not null")
    g = live.groupBy("stage", "uid", "content_key").agg(F.max(F.struct("event_at", "claim_id", "op", "owner")).alias("t"))
    age = F.unix_micros(now) - F.unix_micros(F.col("t.event_at").cast("timestamp"))
    return g.filter(F.col("t.op").isin("claim", "touch")).select("stage", "uid", "content_key", F.col("t.owner").alias("owner"), (age > lease * 1_000_000).alias("stale"))


def sessions(claims: DataFrame, lease: int = LEASE_SECONDS) -> DataFrame:
    """Spans of activity of each unit without a silence of a whole lease: start, end and events."""
    rows = claims.filter("uid is not null and event_at is not null").dropDuplicates(["claim_id"]).withColumn("event_at", F.col("event_at").cast("timestamp"))
    s = rows.groupBy(F.session_window("event_at", f"{lease} seconds").alias("w"), "stage", "uid", "content_key").agg(F.count("*").alias("events"), F.max("event_at").alias("last_at"))
    return s.select("stage", "uid", "content_key", F.col("w.start").cast("timestamp_ntz").alias("started_at"), F.col("last_at").cast("timestamp_ntz").alias("last_at"), "events")


def remaining(current: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Units whose current key is not the one they were completed under."""
    return current.join(done, on, "left_anti")


def work(population: DataFrame, done: DataFrame, claimed: DataFrame, order: list[str], limit: int = 0) -> DataFrame:
    """What may be claimed next, in order: not done at its key, not held by anyone, at most `limit`."""
    free = population.join(done, ["uid", "content_key"], "left_anti").join(claimed, "uid", "left_anti").orderBy(*order)
    return free.limit(limit) if limit else free


def status(population: DataFrame, current: DataFrame, done: DataFrame, held: DataFrame) -> DataFrame:
    """Per stage: total, done at the current key, done under another, remaining, in flight, stale.

    population(uid), current(stage, uid, content_key), done(stage, uid, content_key), held(stage, uid, stale). The stages
    are those a pipeline names, a handful, and are broadcast.
    """
    stages = current.select("stage").distinct()
    grid = population.select("uid").distinct().crossJoin(F.broadcast(stages))
    cur = current.withColumnRenamed("content_key", "cur_key")
    j = grid.join(cur, ["stage", "uid"], "left").join(done.select("stage", "uid", F.col("content_key").alias("done_key")), ["stage", "uid"], "left")
    g = j.groupBy("stage").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("done_key") == F.col("cur_key")).alias("done"),
        F.count_if(F.col("done_key").isNotNull() & ~F.col("done_key").eqNullSafe(F.col("cur_key"))).alias("superseded"),
    )
    h = held.groupBy("stage").agg(F.count_if(~F.col("stale")).alias("in_flight"), F.count_if(F.col("stale")).alias("stale"))
    return g.join(h, "stage", "left").select("stage", "total", "done", "superseded", (F.col("total") - F.col("done")).alias("remaining"), F.coalesce("in_flight", F.lit(0)).alias("in_flight"), F.coalesce("stale", F.lit(0)).alias("stale"))


def upsert(old: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Fresh rows, and the old rows of keys that have no fresh one."""
    return fresh.unionByName(old.join(fresh.select(key), key, "left_anti"))


def first_root(roots: DataFrame, key: str, ordinal: str, value: str) -> DataFrame:
    """The value of each key in the first root that has it."""
    return roots.groupBy(key).agg(F.min_by(value, ordinal).alias(value), F.min(ordinal).alias(ordinal))


def worker_plan(spark, gpus: int, per_gpu: int) -> DataFrame:
    """Worker i runs on device i div per_gpu; at least one worker."""
    return spark.range(max(gpus, 1) * max(per_gpu, 1)).select(F.col("id").alias("worker"), F.floor(F.col("id") / max(per_gpu, 1)).cast("long").alias("gpu"))


def spawn_ok(codes: DataFrame, group: str, code: str) -> DataFrame:
    """Whether a group of workers ended well: there are exit codes, and all are 0."""
    return codes.groupBy(group).agg(F.count(code).alias("workers"), F.count_if(F.col(code) != 0).alias("failed"), (F.bool_and(F.col(code) == 0)).alias("ok"))
