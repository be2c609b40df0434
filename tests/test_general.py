"""Incremental runs and the profile: brute force, failures, odd rows."""

import datetime as dt
import math
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lamina.functions.text import is_real
from lamina.functions.uids import object_of
from lamina.operators import incremental as inc
from lamina.operators import profile as prof
from lamina.session import shared_table
from lamina.sources.versions import put_if_absent, small_text

CLAIMS = "claim_id long, stage string, uid string, op string, owner string, content_key string, event_at timestamp_ntz, recorded_at timestamp_ntz, key string, version string"
T0 = dt.datetime(2026, 1, 1)


def hours(n):
    return None if n is None else T0 + dt.timedelta(hours=n)


def rows(seed, n=300):
    r = random.Random(seed)
    out = []
    for i in range(n):
        at = r.choice([None, r.randint(0, 40)])
        row = (i, r.choice(["a", "b", None]), r.choice(["u1", "u1", "u2", "u3", None]), r.choice(["claim", "touch", None]), r.choice(["w0", "w1", None]), r.choice(["k", None]), hours(at), hours(r.randint(0, 60)), "x", "y")
        out.append(row)
        if r.random() < 0.1:
            out.append((*row[:7], hours(70), *row[8:]))
    return out


def brute(data, cutoffs):
    out, before = [], {}
    for run, cut in cutoffs:
        state = {}
        for x in data:
            if x[2] is None or x[7] is None or x[7] > cut:
                continue
            k, pos = (x[1], x[2], x[5]), (x[6] or dt.datetime.min, x[0])
            if k not in state or pos > state[k][0]:
                state[k] = (pos, (x[3], x[4]), x[0])
        out += [(run, v[2]) for k, v in state.items() if k not in before or before[k][1] != v[1]]
        before = state
    return sorted(out)


CUTS = [(1, hours(10)), (2, hours(11)), (5, hours(30)), (9, hours(80))]


@pytest.mark.parametrize("seed", range(3))
def test_changes_match_brute_force(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, CLAIMS).repartition(3)
    got = inc.replay(inc.claims_source(df), CUTS, shared_table(spark, "t")).changes()
    assert sorted(map(tuple, got.collect())) == brute(data, CUTS)


def test_failed_run_is_taken_up_again_and_repeats_do_nothing(spark):
    data = rows(7)
    src = inc.claims_source(spark.createDataFrame(data, CLAIMS))
    path = shared_table(spark, "t")
    t = inc.VersionedTarget(spark, path)
    t.advance(inc.arrivals(src, CUTS[0][1]), 1)
    t.write(src.limit(3).select("key"))  # a run that died before it published
    assert list(t.published()) == [1]
    new = inc.arrivals(src, CUTS[1][1], CUTS[0][1])
    assert t.advance(new, 2) and not t.advance(new, 2)
    assert list(t.published()) == [1, 2]
    assert sorted(map(tuple, t.changes().collect())) == brute(data, CUTS[:2])
    # a second writer of the same version changes nothing and leaves no data behind
    before = sorted(map(tuple, t.rows().drop("key", "version").collect()))
    late = t.write(t.rows().limit(1))
    assert not t.publish(2, late) and sorted(map(tuple, t.rows().drop("key", "version").collect())) == before
    assert sum(n.startswith("data-") for n in os.listdir(path.removeprefix("file://"))) == 3
    # a run outputs changes only, and moved states of the same version are kept apart from them
    assert {r.changed for r in t.rows().collect()} == {True, False}


def test_many_new_rows_take_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(inc, "SENT", 3)
    data = rows(8)
    df = spark.createDataFrame(data, CLAIMS)
    assert sorted(map(tuple, inc.replay(inc.claims_source(df), CUTS, shared_table(spark, "t")).changes().collect())) == brute(data, CUTS)


def test_one_of_two_writers_wins(spark):
    at = shared_table(spark, "m") + "/v=1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, at, f"writer {i} " * 1000), range(8)))
    assert sum(won) == 1 and small_text(spark, at) == f"writer {won.index(True)} " * 1000


def test_empty_ledger(spark):
    df = spark.createDataFrame([], CLAIMS)
    assert inc.replay(inc.claims_source(df), CUTS, shared_table(spark, "t")).changes().count() == 0
    assert inc.replay(inc.claims_source(df), [], shared_table(spark, "t")).changes().count() == 0


def test_versions_compare_nan_null_zero_and_maps(spark):
    df = spark.createDataFrame([(1, math.nan, {"a": "1", "b": "2"}), (2, math.nan, {"b": "2", "a": "1"}), (3, 0.0, None), (4, -0.0, None), (5, None, None)], "id int, d double, m map<string,string>")
    v = {r.id: bytes(r.v) for r in df.select("id", inc.digest(inc.comparable(df, "d"), inc.comparable(df, "m")).alias("v")).collect()}
    assert v[1] == v[2] and v[3] == v[4] and len({v[1], v[3], v[5]}) == 3


def test_successful_runs(spark):
    log = [(1, "s", "succeeded", hours(1), hours(2)), (1, "s", "failed", hours(1), hours(1)), (2, "s", "failed", hours(3), hours(4)), (3, "g", "succeeded", hours(3), hours(4))]
    df = spark.createDataFrame(log, "run_id int, consumer string, outcome string, cutoff_at timestamp_ntz, logged_at timestamp_ntz")
    assert inc.successful_runs(df, "s") == [(1, hours(1))]


M = "measurement_id long, load_id int, g1_dark_frac double, g8_psnr double, unmeasured array<string>, error string, column_name string, value double"


def measured(spark, data):
    return spark.createDataFrame([(*x, "clash", 1.0) for x in data], M)


def test_faults(spark):
    df = measured(spark, [
        (1, 1, 0.5, 20.0, [], None), (2, 1, -0.1, math.nan, ["g3", "g8"], "none"), (2, 1, -0.1, math.nan, ["g3", "g8"], "none"), (3, 1, math.inf, 100.0, ["g8", "g3"], " "),
        (4, 2, 0.0, -1.0, ["g3", "g3"], "lost\x00"), (5, 2, 1.0, 0.0, ["g2"], "crash �"), (6, None, None, None, None, "crashed"), (7, 2, 1.0, 1.0, [None], ""),
    ])
    got = {(r.column_name, r.measurement_id) for r in prof.found(df, prof.measurement_rules()).filter("measurement_id > 0").collect()}
    assert got == {("g1_dark_frac", 2), ("g8_psnr", 2), ("error", 2), ("g1_dark_frac", 3), ("unmeasured", 3), ("error", 3), ("g8_psnr", 4), ("unmeasured", 4), ("error", 4), ("unmeasured", 5), ("error", 5), ("unmeasured", 7), ("error", 7)}


def test_drift_matches_brute_force(spark):
    r = random.Random(3)
    data = []
    for load in (1, 2, 4, 5, 6):
        for i in range(200):
            v = r.random() ** (3 if load == 4 else 1)
            data.append((load * 1000 + i, load, None if r.random() < (0.3 if load == 5 else 0.02) else round(v, 2), 50.0, ["g3"] if load == 6 and i % 2 else [], None))
    got = {tuple(x)[:2] for x in prof.found(measured(spark, data), prof.measurement_rules()).filter("measurement_id = 0").collect()}
    want, loads = set(), [1, 2, 4, 5, 6]
    for a, b in zip(loads, loads[1:]):
        for name, k, num in (("g1_dark_frac", 2, lambda v: v), ("unmeasured", 4, len)):
            p, q = ([x[k] for x in data if x[1] == l] for l in (a, b))
            n = [sum(v is None for v in s) / len(s) for s in (p, q)]
            x, y = ([num(v) for v in s if v is not None] for s in (p, q))
            gap = max(abs(sum(v <= t for v in x) / len(x) - sum(v <= t for v in y) / len(y)) for t in {*x, *y})
            if abs(n[0] - n[1]) > 0.15 or gap > 0.25:
                want.add((b, name))
    assert got == want and ("g1_dark_frac" in {w[1] for w in want})


def test_profile_of_nothing_and_of_equal_values(spark):
    rules = prof.measurement_rules()
    assert prof.found(measured(spark, []), rules).count() == 0
    assert prof.profile(measured(spark, []), rules).count() == 0
    p = prof.profile(measured(spark, [(i, 1, 0.25, None, None, None) for i in range(5)]), rules).filter("column_name = 'g1_dark_frac'").first()
    assert (p.mean, p.sd, p.n_distinct, p.n_rows) == (0.25, 0.0, 1, 5)


@pytest.mark.parametrize("size", [1e-7, 1.0, 2e6, 3e15])
def test_power_sums_of_any_size(spark, size):
    """Moments keep nine digits of the largest value; infinities count as values and are left out of moments."""
    rule = prof.Rule("v", F.lit(False), F.col("v"), F.col("v").cast("string"))
    vals = [size * x for x in (0.1, 0.25, 0.5, 1.0, -0.75, 0.3)]
    df = spark.createDataFrame([(1, v) for v in [*vals, math.inf, None]], "load_id int, v double")
    p = prof.profile(df, [rule]).first()
    mean = sum(vals) / 6
    sd = math.sqrt(sum((v - mean) ** 2 for v in vals) / 6)
    assert (p.n_rows, p.n_null, p.n) == (8, 1, 7) and math.isclose(p.mean, mean, rel_tol=1e-6) and math.isclose(p.sd, sd, rel_tol=1e-6)
    assert math.isclose(p.skew, sum((v - mean) ** 3 for v in vals) / 6 / sd**3, rel_tol=1e-5)


@pytest.mark.parametrize(
    "text,want",
    [("A" * 32, "a" * 32), ("a" * 32 + "\n", "a" * 32), ("urn:object:" + "1" * 64, "1" * 64), ("{" + "b" * 32 + "}", "b" * 32), ("mesh/" + "c" * 32 + ".obj", "c" * 32), ("１" * 32, "1" * 32),
     ("ab​" * 16, "ab" * 16), ("12345678-" * 4, "12345678" * 4), ("a" * 31, None), ("a" * 65, None), ("a" * 31 + "z", None), ("", None), (None, None), ("-", None), ("missing uid", None)],
)
def test_object_of(spark, text, want):
    assert spark.createDataFrame([(text,)], "u string").select(object_of(F.col("u"))).first()[0] == want


def test_real_values(spark):
    vals = ["Chair", "none", " N/A ", "", None, "?", "[no caption]", "​", "Nanny", "x" * 100_000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    assert [r.i for r in df.filter(is_real(F.col("v"))).orderBy("i").collect()] == [0, 8, 9]
