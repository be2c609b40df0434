"""The leased work queue as a stateful stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lamina.operators.ledger import LEASE_SECONDS
from lamina.session import shared_table

EVENTS = "claim_id long, stage string, uid string, op string, owner string, content_key string, event_at timestamp_ntz"
WINS = "stage string, uid string, content_key string, epoch long, claim_id long, owner string"


def read_events(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """The ledger as a stream of at most `files` files a batch; a table of one file is read through its folder."""
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name[:-8]}*.parquet")


#: How late an event may come, and how long a silent unit is remembered after its lease.
LATE = "6 hours"
REMEMBERED_SECONDS = 90 * 86_400
_STATE = "epoch long, last long, live boolean, won boolean, ids array<long>, ats array<long>, ops array<string>, owners array<string>"
#: Units share a state by the hash of their key: a call of Python costs more than the few events of a unit. The number is fixed for the life of a checkpoint.
BUCKETS = 4096
_BUCKET_STATE = "size long, units binary"


def _advance(unit: tuple, waiting: dict, passed: int, us: int) -> tuple[tuple, dict, list]:
    """A unit (epoch, last, live, won) after its waiting events up to `passed`, the events that wait on, and (epoch, claim_id, owner) of the claims that won."""
    epoch, last, live, won = unit
    out = []
    due = sorted((e[0], i) for i, e in waiting.items() if e[0] <= passed)
    for at, claim_id in due:
        _, op, owner = waiting[claim_id]
        if not live or at - last > us:
            epoch, won = epoch + 1, False
        if op == "claim" and not won:
            out.append((epoch, claim_id, owner))
            won = True
        live, last = op not in ("release", "complete"), at
    rest = {i: e for i, e in waiting.items() if e[0] > passed} if due else waiting
    return (epoch, last, live, won), rest, out


def lease_step(lease: int = LEASE_SECONDS, remembered: int = REMEMBERED_SECONDS):
    """State of a unit: (epoch, last event time in microseconds, open, won) and the events the watermark has not passed.

    Events wait until the watermark passes them and are then taken in event order, each claim_id once, so that the result
    does not depend on the batches they came in; what comes later still is dropped by the watermark. A timer wakes the
    unit for its next waiting event, and at last to be forgotten, once it was silent for its lease and `remembered` seconds:
    a unit that comes back after that begins at its first epoch. A lease opens with the first event, after a release or
    completion, or after a silence longer than the lease; its first claim wins it.

    For a grouping by units. Its timer rings up to two milliseconds after the watermark has passed an event; `bucket_step`'s does not.
    """
    us = lease * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        epoch, last, live, won, ids, ats, ops, owners = state.get if state.exists else (0, 0, False, False, [], [], [], [])
        waiting = dict(zip(ids, zip(ats, ops, owners)))
        if not state.hasTimedOut:
            for f in frames:
                for claim_id, at, op, owner in zip(f["claim_id"], f["at"], f["op"], f["owner"]):
                    waiting.setdefault(int(claim_id), (int(at), op, owner))
        passed = state.getCurrentWatermarkMs() * 1000
        (epoch, last, live, won), rest, wins = _advance((epoch, last, live, won), waiting, passed, us)
        out = [(*key, *w) for w in wins]
        gone = last + us + remembered * 1_000_000
        if rest or gone > passed:
            cols = [list(c) for c in zip(*rest.values())] if rest else [[], [], []]
            state.update((int(epoch), int(last), bool(live), bool(won), list(rest), *cols))
            state.setTimeoutTimestamp(min(cols[0], default=gone) // 1000 + 1)
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["stage", "uid", "content_key", "epoch", "claim_id", "owner"])

    return step


def _packed(units: dict) -> tuple[int, bytes]:
    """Units as compressed JSON, with its length."""
    text = json.dumps([(*k, *u, [(i, *e) for i, e in w.items()]) for k, (u, w) in units.items()], separators=(",", ":")).encode()
    return len(text), pa.compress(text, codec="zstd", asbytes=True)


def _unpacked(size: int, data: bytes) -> dict:
    """(stage, uid, content_key) -> ((epoch, last, live, won), waiting events by claim_id)."""
    return {tuple(x[:3]): (tuple(x[3:7]), {i: tuple(e) for i, *e in x[7]}) for x in json.loads(pa.decompress(bytes(data), size, codec="zstd", asbytes=True))}


def bucket_step(lease: int = LEASE_SECONDS, remembered: int = REMEMBERED_SECONDS):
    """What `lease_step` does, for all units of a bucket: one state, and a timer for whatever is due first among them.

    The state is as large as the bucket's units: those of the last 90 days, and the events that wait.
    """
    us = lease * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        units = _unpacked(*state.get) if state.exists else {}
        if not state.hasTimedOut:
            for f in frames:
                for stage, uid, content_key, claim_id, at, op, owner in zip(*(f[c].tolist() for c in ("stage", "uid", "content_key", "claim_id", "at", "op", "owner"))):
                    k = (stage, uid, content_key)
                    if k not in units:
                        units[k] = ((0, 0, False, False), {})
                    units[k][1].setdefault(int(claim_id), (int(at), op, owner))
        passed = state.getCurrentWatermarkMs() * 1000
        out, kept, timer = [], {}, None
        for k, (unit, waiting) in units.items():
            unit, rest, wins = _advance(unit, waiting, passed, us)
            out += [(*k, *w) for w in wins]
            gone = unit[1] + us + remembered * 1_000_000
            if rest or gone > passed:
                kept[k] = (unit, rest)
                # a timer rings at watermarks beyond it: for an event, at the first millisecond that covers it
                due = max(1, -(-min(e[0] for e in rest.values()) // 1000) - 1) if rest else gone // 1000 + 1
                timer = due if timer is None else min(timer, due)
        if kept:
            state.update(_packed(kept))
            state.setTimeoutTimestamp(timer)
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["stage", "uid", "content_key", "epoch", "claim_id", "owner"])

    return step


def _events(events: DataFrame, late: str) -> DataFrame:
    """Rows without uid or event time are left out; event times carry the watermark."""
    return events.filter("uid is not null and event_at is not null").withColumn("event_at", F.col("event_at").cast("timestamp")).withWatermark("event_at", late)


def claims_won(events: DataFrame, lease: int = LEASE_SECONDS, late: str = LATE, buckets: int = BUCKETS) -> DataFrame:
    """The stream of won claims, of events up to the watermark. Keys of a stream must not be null, so null parts read as ''.

    A batch rewrites the states of the buckets its events fall in: more buckets suit small batches over very many units.
    """
    e = _events(events, late).select("claim_id", F.coalesce("stage", F.lit("")).alias("stage"), "uid", F.coalesce("content_key", F.lit("")).alias("content_key"), "op", "owner", "event_at", F.unix_micros("event_at").alias("at"))
    e = e.withColumn("bucket", F.pmod(F.xxhash64("stage", "uid", "content_key"), F.lit(buckets)).cast("int"))
    return e.groupBy("bucket").applyInPandasWithState(bucket_step(lease), WINS, _BUCKET_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def sessions(events: DataFrame, lease: int = LEASE_SECONDS, late: str = LATE) -> DataFrame:
    """Spans of activity of each unit, given out once the watermark passes their end; then their state is dropped. An event stored twice counts once."""
    e = _events(events, late)
    s = e.groupBy(F.session_window("event_at", f"{lease} seconds").alias("w"), "stage", "uid", "content_key").agg(F.size(F.collect_set("claim_id")).cast("long").alias("events"), F.max("event_at").alias("last_at"))
    return s.select("stage", "uid", "content_key", F.col("w.start").cast("timestamp_ntz").alias("started_at"), F.col("last_at").cast("timestamp_ntz").alias("last_at"), "events")


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Runs the stream over what is there now and reads what it appended; state and output lie in the shared folder."""
    spark = stream.sparkSession
    out, ckpt = shared_table(spark, label), shared_table(spark, f"{label}-state")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
