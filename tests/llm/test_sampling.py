"""Samples that stay, and survivors."""

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lamina.llm import sample as smp
from lamina.llm import survivor as srv
from lamina.session import shared_table

T0 = dt.datetime(2026, 1, 1)


def source(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "uid string, at timestamp_ntz, seq int, first_at string").repartition(parts)
    return [(df, F.col("uid"), "at")]


def objects(n, day, tag):
    return [(f"{tag:08x}{i:024x}", T0 + dt.timedelta(days=day, minutes=i // 7), 0, "x") for i in range(n)]


def registry(spark):
    return smp.Registry(spark, shared_table(spark, "registry"))


def drawn(spark, rows, parts=3, rate=0.2, reg=None):
    return {r.uid: r.seq for r in smp.sample(reg or registry(spark), source(spark, rows, parts), rate, 12345).collect()}


def test_same_however_read_and_kept_as_data_grows(spark):
    early, late = objects(400, 0, 1), objects(300, 5, 2)
    a = drawn(spark, early)
    assert a == drawn(spark, early[::-1] + early[:50], 7)
    b = drawn(spark, late + [(u.upper(), t + dt.timedelta(days=9), s, f) for u, t, s, f in early[:40]] + early)
    assert a.items() <= b.items() and abs(len(b) / 700 - 0.2) < 0.01


def test_even_over_growth(spark):
    seqs = sorted(drawn(spark, objects(1000, 0, 3), rate=0.1).values())
    gaps = [b - a for a, b in zip(seqs, seqs[1:])]
    assert max(gaps) <= 13 and min(gaps) >= 5  # three gap lengths, as of a low-discrepancy sequence


def test_odd_rows(spark):
    assert drawn(spark, []) == {}
    assert set(drawn(spark, [(None, T0, 0, ""), ("", T0, 0, ""), ("zz", T0, 0, ""), ("a" * 32, None, 0, ""), ("b" * 10000, T0, 0, "")], rate=1.0)) == {"a" * 32}


@pytest.mark.parametrize(
    "late",
    [("0" * 32, None), ("0" * 32, T0), ("0" * 32, T0 - dt.timedelta(days=90)), ("0" * 32, T0 + dt.timedelta(days=90))],
    ids=["no arrival time", "tied with the first, smaller uid", "earlier than all", "later"],
)
def test_no_later_object_moves_a_number(spark, late):
    reg, early = registry(spark), objects(300, 0, 1) + [("f" * 32, None, 0, "")]
    a = drawn(spark, early, reg=reg)
    assert a == drawn(spark, early, reg=reg, parts=5) and len(reg.published()) == 1
    b = drawn(spark, [(*late, 0, "x")] + early[::-1], 7, reg=reg)
    assert a.items() <= b.items() and len(a) >= 50
    assert {r.uid: r.seq for r in reg.rows().collect()}[late[0]] == 301
    assert list(reg.published()) == [1, 2]


def test_two_runs_at_once_number_every_object_once(spark):
    reg = registry(spark)
    with ThreadPoolExecutor(3) as pool:
        added = list(pool.map(lambda k: reg.extend(smp.first_arrivals(source(spark, objects(40, 0, 9) + objects(30, k, k)))), [1, 2, 3]))
    rows = reg.rows().collect()
    assert sum(added) == len(rows) == len({r.uid for r in rows}) == 130 and {r.seq for r in rows} == set(range(130))


COLS = "caption_id long, uid string, caption string, family string, shard string, written_at timestamp_ntz, key string, row_id int"


def best(spark, rows):
    return {r.uid: (r.caption_id, r.family_id) for r in srv.caption_survivors(spark.createDataFrame(rows, COLS)).collect()}


def test_survivors_match_brute_force(spark):
    r = random.Random(5)
    rows = []
    for i in range(1, 600):
        at = r.choice([None, T0 + dt.timedelta(hours=r.randint(0, 5))])
        row = (i, r.choice(["a", "B", "c", "d"]) * 32 if r.random() < 0.95 else None, r.choice(["Chair", "Stuhl", None, " ", "n/a"]), r.choice([None, "toys", "none", ""]), r.choice(["captions.jsonl", "captions_w1.jsonl", "captions_w11.jsonl", "other", None]), at, "k", 1)
        rows += [row] * r.choice([1, 1, 2])
    want = {}
    for u in "abcd":
        g = {x[0]: x for x in rows if x[1] and x[1].lower() == u * 32}.values()
        pos = lambda x: (x[5] or dt.datetime.min, x[0])
        named = [x for x in g if x[3] == "toys"]
        real = [x for x in g if x[2] in ("Chair", "Stuhl")]
        tiers = [[x for x in real if x[4] == "captions.jsonl" and x[3] == "toys"], [x for x in real if x[4] and x[4].startswith("captions_w")], real]
        top = next((t for t in tiers if t), [])
        want[u * 32] = (max(top, key=pos)[0] if top else 0, max(named, key=pos)[0] if named else 0)
    assert best(spark, rows) == want


def test_single_and_empty(spark):
    one = (1, "a" * 32, "Chair", "toys", "captions.jsonl", None, "", 0)
    assert best(spark, []) == {} and best(spark, [one, one]) == {}
    assert best(spark, [one, (2, "a" * 32, None, None, None, None, "", 0)]) == {"a" * 32: (1, 1)}
    assert best(spark, [(1, "a" * 32, None, "-", "x", None, "", 0), (2, "a" * 32, "", None, None, None, "", 0)]) == {"a" * 32: (0, 0)}


def test_hot_object(spark):
    rows = [(i, "a" * 32, "x" * 5000 if i == 7 else "Chair", None, "captions_w0.jsonl", None, "", 0) for i in range(1, 3000)]
    assert best(spark, rows) == {"a" * 32: (2999, 0)}
