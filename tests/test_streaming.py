"""The leased queue as a stream: batches in any order, late rows, repeated rows, forgotten units."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from lamina.operators import ledger
from lamina.session import shared_table
from lamina.streaming import lease

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "claim_id long, stage string, uid string, op string, owner string, content_key string, event_at timestamp_ntz, recorded_at timestamp_ntz"


def events(seed, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        at = T0 + dt.timedelta(minutes=3 * i + r.randint(0, 2), seconds=r.randint(0, 59))
        out.append((i, r.choice(["a", "b"]), r.choice(["u1", "u2", "u3", None]), r.choice(["claim", "claim", "touch", "release", "complete"]), r.choice(["w0", "w1", None]), "k", at, None))
    return out


def streamed(spark, batches, make, files=1):
    at = shared_table(spark, "events").removeprefix("file://")
    for k, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{at}/claims.parquet")
    return lease.run_to_table(make(lease.read_events(spark, f"file://{at}/claims.parquet", files)), "out")


def test_batches_in_disorder_give_what_one_batch_gives(spark):
    """Rows are up to two hours out of order across batches, some twice in different batches; the stream allows six."""
    r = random.Random(1)
    rows = events(3)
    shuffled = sorted(rows, key=lambda x: x[6] + dt.timedelta(minutes=r.randint(0, 120)))
    batches = [shuffled[i : i + 80] for i in range(0, 400, 80)]
    batches[3] = batches[3] + batches[2][:10]
    passed = max(x[6] for x in rows if x[2]) - dt.timedelta(hours=6)
    known = spark.createDataFrame([x for x in rows if x[6] <= passed], SCHEMA)
    key = lambda df: sorted((x.stage, x.uid, x.epoch, x.claim_id, x.owner or "") for x in df.collect())
    want = key(ledger.winners(known))
    assert len(want) > 20
    assert key(streamed(spark, batches, lease.claims_won)) == want == key(streamed(spark, [rows], lease.claims_won))
    spans = lambda df: sorted((x.stage, x.uid, x.started_at, x.last_at, x.events) for x in df.collect())
    closed = ledger.sessions(spark.createDataFrame(rows, SCHEMA)).filter(F.col("last_at") + F.expr(f"interval {ledger.LEASE_SECONDS} seconds") <= F.lit(passed))
    assert spans(streamed(spark, batches, lease.sessions)) == spans(closed)


class Group:
    """The state of one unit, as the engine hands it out."""

    def __init__(self, watermark):
        self.value, self.watermark, self.hasTimedOut, self.timer = None, watermark, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        self.timer = ms


def test_silent_units_are_forgotten():
    step, g = lease.lease_step(lease=60, remembered=3600), Group(0)
    rows = pd.DataFrame([(7, 10_000_000, "claim", "w")], columns=["claim_id", "at", "op", "owner"])
    run = lambda frames: [tuple(x) for f in step(("s", "u", "k"), iter(frames), g) for x in f.itertuples(index=False)]
    assert run([rows, rows]) == [] and g.timer == 10_001
    g.hasTimedOut, g.watermark = True, g.timer
    assert run([]) == [("s", "u", "k", 1, 7, "w")] and g.value[:4] == (1, 10_000_000, True, True) and not g.value[4]
    g.watermark = g.timer
    assert g.timer == 10_000 + 60_000 + 3_600_000 + 1 and run([]) == [] and g.value is None


def test_units_share_states(spark):
    """Thousands of units need no state and no call of Python each, and win what the batch gives."""
    late = [(10_000 + i, "a", "u1", "claim", "w9", "k", T0 + dt.timedelta(hours=30 + i), None) for i in range(2)]
    rows = [(i, "s", f"u{i % 1500}", ("claim", "touch", "complete")[i // 1500 % 3], f"w{i}" if i % 7 else None, f"ké{i % 3}" if i % 5 else None, T0 + dt.timedelta(seconds=7 * i % 50_000), None) for i in range(6000)] + late
    at = shared_table(spark, "events").removeprefix("file://")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"file://{at}/claims.parquet")
    stream = lease.claims_won(lease.read_events(spark, f"file://{at}/claims.parquet"), buckets=8)
    q = stream.writeStream.format("memory").queryName("shared_states").trigger(availableNow=True).start()
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert 0 < max(held) <= 8
    key = lambda df: sorted((x.stage, x.uid, x.content_key or "", x.epoch, x.claim_id, x.owner or "") for x in df.collect())
    known = spark.createDataFrame([x for x in rows if x[6] <= late[-1][6] - dt.timedelta(hours=6)], SCHEMA)
    want = key(ledger.winners(known))
    assert len(want) == 3000 and key(spark.table("shared_states")) == want


def test_an_event_at_the_watermark_is_given_out(spark):
    """The last event is at 30 h, so the watermark is at 24 h: events up to that very millisecond have passed."""
    ms = [-2, -1, 0, 1]
    rows = [(k, "s", f"u{k}", "claim", "w", "k", T0 + dt.timedelta(hours=24, milliseconds=m), None) for k, m in enumerate(ms)] + [(9, "s", "u9", "claim", "w", "k", T0 + dt.timedelta(hours=30), None)]
    assert sorted(x.claim_id for x in streamed(spark, [rows], lease.claims_won).collect()) == [0, 1, 2]


def test_units_of_a_bucket_wait_and_are_forgotten_apart():
    step, g = lease.bucket_step(lease=60, remembered=3600), Group(0)
    rows = pd.DataFrame([("s", "u", None, 7, 10_000_000, "claim", "w"), ("s", "v", "k", 8, 20_000_500, "claim", None)], columns=["stage", "uid", "content_key", "claim_id", "at", "op", "owner"])
    run = lambda frames: [tuple(x) for f in step((3,), iter(frames), g) for x in f.itertuples(index=False)]
    units = lambda: sorted(k[1] for k in lease._unpacked(*g.value))
    assert run([rows, rows]) == [] and g.timer == 9_999 and units() == ["u", "v"]
    g.hasTimedOut, g.watermark = True, 10_000
    assert run([]) == [("s", "u", None, 1, 7, "w")] and g.timer == 20_000
    g.watermark = 20_001
    assert run([]) == [("s", "v", "k", 1, 8, None)] and g.timer == 10_000 + 60_000 + 3_600_000 + 1
    g.watermark = g.timer + 1
    assert run([]) == [] and units() == ["v"] and g.timer == 20_000 + 60_000 + 3_600_000 + 1
    again = pd.DataFrame([("s", "v", "k", 9, g.watermark * 1000, "touch", "w"), ("s", "v", "k", 10, g.watermark * 1000, "claim", "x")], columns=rows.columns)
    g.hasTimedOut = False
    assert run([again]) == [("s", "v", "k", 2, 10, "x")]
    g.hasTimedOut, g.watermark = True, g.timer + 1
    assert run([]) == [] and g.value is None
