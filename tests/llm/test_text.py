"""Leaks and truncation against brute force and planted cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lamina.llm import leaks as lk
from lamina.llm import truncation as trn

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(docs)], "doc_id long, text string, seed int, item string")
    e = spark.createDataFrame([(i, t, "en", b"") for i, t in enumerate(items)], "item_id long, text string, lang string, words binary")
    return {tuple(r) for r in lk.leaks(d, e, **kw).select("doc_id", "item_id").collect()}


def brute(item, doc):
    """Some 12 or 18 consecutive words within a sixth of edits, by plain edit distance."""
    for n in (12, 18):
        for a in range(len(item) - n + 1):
            row = [0] * (len(doc) + 1)
            for w in item[a : a + n]:
                nxt = [row[0] + 1]
                for j, x in enumerate(doc):
                    nxt.append(min(row[j] + (w != x), row[j + 1] + 1, nxt[j] + 1))
                row = nxt
            if min(row) <= n // 6:
                return True
    return False


def score(item, doc):
    """Best local alignment: a match 1, an edit -1."""
    best, row = 0, [0] * (len(doc) + 1)
    for w in item:
        nxt = [0]
        for j, x in enumerate(doc):
            nxt.append(max(0, row[j] + (1 if w == x else -1), row[j + 1] - 1, nxt[j] - 1))
        best, row = max(best, *nxt), nxt
    return best


def test_matches_brute_force(spark):
    r = random.Random(11)
    items = [[r.choice(WORDS) for _ in range(r.randint(8, 40))] for _ in range(12)]
    docs = []
    for _ in range(60):
        it = r.choice(items)
        a = r.randint(0, max(0, len(it) - 8))
        part = it[a : a + r.randint(8, 24)]
        out = []
        for w in part:
            x = r.random()
            out += [] if x < 0.05 else [r.choice(WORDS)] if x < 0.12 else [w, r.choice(WORDS)] if x < 0.15 else [w]
        docs.append([r.choice(WORDS) for _ in range(r.randint(0, 20))] + out + [r.choice(WORDS) for _ in range(r.randint(0, 20))])
    want = {(i, j) for i, d in enumerate(docs) for j, it in enumerate(items) if brute(it, d)}
    text = [" ".join(d) for d in docs], [" ".join(i) for i in items]
    assert 5 < len(want) < 60
    assert found(spark, *text, least_score=8) == want
    assert found(spark, *text, least_score=8, most_seeds=40, broadcast_rows=0) == want
    scored = {(i, j) for i, j in want if score(items[j], docs[i]) >= 10}
    assert scored < want and found(spark, *text) == scored == found(spark, *text, broadcast_rows=0)


PASSAGE = "Nobody should name oak when the smooth stem glows aquamarine, next to 30.5 bulky hand-painted copies in leather"


@pytest.mark.parametrize(
    "doc",
    [PASSAGE, PASSAGE.upper(), PASSAGE.replace(" ", "  \n> "), PASSAGE.replace("stem", "st​em"), PASSAGE.replace("smooth", "<b>smooth</b>").replace("copies", "**copies**"), PASSAGE.replace("aquamarine", "aqua-\n* marine"),
     PASSAGE.replace(",", "").replace("30.5", "305"), "".join(chr(ord(c) + 0xFEE0) if "a" <= c <= "z" else c for c in PASSAGE), '{"t": "' + PASSAGE.replace(" oak", "\\noak") + '"}', PASSAGE.replace("glows", "gowls").replace("should", "")],
)
def test_disguises(spark, doc):
    assert found(spark, ["before " + doc + " after", "nothing here"], [PASSAGE]) == {(0, 0)}


STYLE = '<span style="' + "color: red; " * 50 + '">'


@pytest.mark.parametrize(
    "doc",
    [" ".join(w + (STYLE if i % 3 == 0 else "") for i, w in enumerate(PASSAGE.split())), "before <!-- " + PASSAGE + " --> after", "<![CDATA[" + PASSAGE + "]]>", "if x <y then " + PASSAGE + " and z> 3", PASSAGE.replace("stem", "<a href='http://x.y/?q=" + "z" * 5000 + "' download-as=x disabled>stem</a>")],
)
def test_long_markup_and_comments(spark, doc):
    assert found(spark, [doc], [PASSAGE]) == {(0, 0)}


def test_markup_is_read_in_linear_time():
    for text in ("<a " * 200_000, "<a b=" + " " * 400_000, "<" * 400_000, "<a x='" + "b" * 400_000, "<!--" * 100_000):
        assert lk.folded(text) is not None


def test_scripts_without_blanks(spark):
    passage = "验证数据集中的这一段文字不应当出现在训练语料里面"
    assert found(spark, ["前言。" + passage[2:18] + "等等", "别的文字"], [passage]) == {(0, 0)}


def test_a_seed_in_every_text(spark, monkeypatch):
    """A stock phrase in all texts and several items: seeds are spread over tasks, and only the passages count."""
    monkeypatch.setattr(lk, "SPREAD", 7)
    stock = "as everyone in the workshop knows by heart"
    items = [f"{' '.join(WORDS[20 * i : 20 * i + 10])} {stock} {' '.join(WORDS[20 * i + 10 : 20 * i + 20])}" for i in range(5)]
    docs = [f"{' '.join(WORDS[300 + i % 50 : 306 + i % 50])} {stock} nothing more {i}" for i in range(120)]
    docs[17], docs[90] = items[2], " ".join(items[4].split()[5:24])
    for rows in (50_000, 0):
        assert found(spark, docs, items, broadcast_rows=rows) == {(17, 2), (90, 4)}


def test_shared_sentences_and_short_parts_do_not_count(spark):
    stock = "This one sentence stands in every single item of the whole set and means nothing."
    items = [stock + " " + PASSAGE + ".", "Other words lead into this one here first. " + stock, "too short"]
    docs = [stock, " ".join(PASSAGE.split()[:9]), PASSAGE, None, "", "too short", "a" * 200_000]
    assert found(spark, docs, items) == {(2, 0)}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()
    assert found(spark, [PASSAGE, PASSAGE], [PASSAGE, None]) == {(0, 0), (1, 0)}


def test_alignment_scores():
    a = np.arange(2, 2 + lk.ITEM_WINDOW, dtype=np.uint64)[None]
    t = np.ones((1, lk.TEXT_WINDOW), np.uint64)
    t[0, 3:15] = a[0, 5:17]
    assert lk.local_scores(a, t)[0] == 12 and lk.holds_passage(a, t)[0]
    t[0, [4, 7, 10]] = 1
    assert lk.local_scores(a, t)[0] == 6 and not lk.holds_passage(a, t)[0]


@pytest.mark.parametrize(
    "text,state",
    [("A chair.", trn.DONE), ("A chair etc.", trn.DONE), ("A chair (toy", trn.CUT), ("A chair (toy)", trn.DONE), ("A cha�", trn.CUT), ("A chair\\u00", trn.CUT), ("A chair…", trn.CUT), ("A chair ..", trn.CUT),
     ("A chair [...]", trn.CUT), ("A chair, ", trn.CUT), ("A chair and ", trn.CUT), ("A hand-", trn.CUT), ('A "chair', trn.CUT), ('A "chair"', trn.DONE), ("A <b>chair</b", trn.CUT), ("A chair &am", trn.CUT), ("R&D", trn.OPEN),
     ("A chair", trn.OPEN), ("café ✨", trn.DONE), ("{[()]}", trn.DONE), ("100%", trn.DONE), ("椅子。", trn.DONE)],
)
def test_structure(text, state):
    assert trn.structure(text) == state


@pytest.mark.parametrize(
    "text,state",
    [("Er sagte „Guten Tag“.", trn.DONE), ("»Guten Tag«, sagte er.", trn.DONE), ("«Bonjour», dit-il.", trn.DONE), ("‹a› b.", trn.DONE), ("›a‹ b.", trn.DONE), ("‚so‘ war es.", trn.DONE), ("‘yes’ he said.", trn.DONE), ("”hej” sade han.", trn.DONE), ("“a ‘b’ c”.", trn.DONE),
     ('say "x "y" z"', trn.DONE), ('She said "go (now" and left.', trn.DONE), ("don’t stop.", trn.DONE), ("the dogs’ bowl.", trn.DONE), ("the ‘90s.", trn.DONE), ('It\'s 5" wide.', trn.DONE), ("Nice :(", trn.DONE), ("a) first, b) second.", trn.DONE),
     ("<b>bold</b> text.", trn.DONE), ("line<br>next.", trn.DONE), ("<p>para.", trn.DONE), ("if a <b then done.", trn.DONE), ("see <a href='x'>link</a>.", trn.DONE), ("```\nf(x\n```", trn.DONE), ("x < y", trn.OPEN)],
)
def test_complete_texts(text, state):
    assert trn.structure(text) == state


@pytest.mark.parametrize("text", ["<b>bold text without an end tag.", "<B>bold <i>and</i> more.", "He said ‘yes", "„So", "»So geht", "«Oui", "”hej sade han.", "“a ‘b’ c.", "```python\nx = 1", "see <a href=\"x", "see <a", "family 👨‍", "cafÃ", "half â€", "rated (good", 'say "x "y" z'])
def test_texts_left_open(text):
    assert trn.structure(text) == trn.CUT


def test_words_match_a_plain_count():
    r = random.Random(4)
    texts = [" ".join(r.choice(["Chair,", "red", "-", "12", "a.", "(toy", "…", "x3", "“"]) for _ in range(r.randint(0, 40))) + r.choice(["", ".", " "]) for _ in range(400)]
    want = {}
    for t in texts:
        steps, s = trn.word_steps(t), trn.structure(t)
        for i, (before, word, gap) in enumerate(steps):
            last = i == len(steps) - 1
            if not (last and s == trn.CUT):
                c = want.setdefault((before, word), [0, 0, 0])
                c[0] += 1
                c[2 if last and s == trn.OPEN and not gap else 1] += last or gap
    (got,) = trn._steps(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    assert {(x["before"], x["word"]): [x["n"], x["gaps"], x["ends"]] for x in got.to_pylist()} == want
    for t in texts:
        steps = trn.word_steps(t)
        assert trn._last_step(t)[:2] == ((steps[-1][0], steps[-1][1]) if steps else ("^", ""))
        assert trn._last_step(t)[2] == (0 < len(steps) <= trn.BRIEF and not any(g for *_, g in steps))


def test_a_missing_terminator_counts_where_a_source_always_has_one(spark):
    r = random.Random(2)
    text = lambda: " ".join(r.choice(WORDS) for _ in range(9)) + ", intricate detail"
    rows = [(i, text() + ("" if i % 20 == 0 else "."), "strict", "", 0) for i in range(400)] + [(1000 + i, text() + ("" if i % 2 else "."), "loose", "", 0) for i in range(400)]
    assert cut(spark, rows) == set(range(0, 400, 20))


def cut(spark, rows):
    df = spark.createDataFrame(rows, "caption_id long, caption string, shard string, text string, size int")
    return {r.caption_id for r in trn.verdicts(df, "caption_id", "caption", "shard", F.col("caption_id")).filter("cut").collect()}


def test_limits_and_unfinished_words(spark):
    r = random.Random(9)
    colours, stuff, parts = ["amber", "cobalt", "crimson", "emerald"], ["walnut", "marble", "porcelain", "velvet"], ["rivets", "feathers", "grain lines", "petal shapes"]

    def whole():
        return f"{r.choice(['Chair', 'Lantern', 'Windmill', 'Oil lamp'])} with {r.choice(colours)} and {r.choice(stuff)}, " + ", ".join(f"{r.choice(parts)} over {r.choice(['smooth', 'dusty', 'glossy'])} {r.choice(stuff)}" for _ in range(r.randint(1, 6))) + r.choice([", intricate detail", ""])

    rows, want = [], set()
    for i in range(1500):
        t, s = whole(), r.choice(["a", "b"])
        if s == "b" and len(t) > 90:
            t = t[:90]
            want.add(i)
        elif i % 40 == 0:
            t = t[: len(t) - 4]
            want.add(i)
        rows.append((i, t, s, "clash", 3))
    got = cut(spark, rows)
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.02 * len(want) + 2


@pytest.mark.parametrize("lost", [False, True])
def test_a_source_does_not_vouch_for_its_own_cuts(spark, lost):
    """A third of the rows lie in one source that is mostly cut at whole words: by a limit, or at any word."""
    r = random.Random(5)
    colours, stuff, parts = ["amber", "cobalt", "crimson", "emerald"], ["walnut", "marble", "porcelain", "velvet"], ["rivets", "feathers", "grain lines", "petal shapes"]
    rows, want = [], set()
    for i in range(1800):
        t = f"{r.choice(['Chair', 'Lantern', 'Windmill'])} with {r.choice(colours)} and {r.choice(stuff)}, " + ", ".join(f"{r.choice(parts)} over {r.choice(['smooth', 'dusty', 'glossy'])} {r.choice(stuff)}" for _ in range(r.randint(1, 6))) + r.choice([", intricate detail", ""])
        if i % 3 == 0 and (r.random() < 0.8 if lost else len(t) > 80):
            t = t[: (r.randint(30, len(t) - 5) if lost else 80) + 1].rsplit(" ", 1)[0]
            want.add(i)
        rows.append((i, t, "abc"[i % 3], "", 0))
    got = cut(spark, rows)
    assert len(want) > 300 and len(got & want) >= 0.9 * len(want) and len(got - want) <= 0.05 * len(want)


def test_stumps_of_words_of_any_length(spark):
    long = "donaudampfschifffahrtsgesellschaft" * 4
    rows = [(i, f"Chair, {long}, red {long}, blue", "a" if i % 2 else "b", str(i), 0) for i in range(40)] + [(900, f"Chair, red {long[:100]}", "a", "z", 0)]
    assert 900 in cut(spark, rows)


def test_odd_captions(spark):
    assert cut(spark, []) == set()
    rows = [(1, None, "a", "", 0), (2, "", "a", "", 0), (3, " ", None, "", 0), (4, "n/a", "a", "", 0), (5, "Chair (toy", None, "", 0), (5, "Chair (toy", None, "", 0), (6, "x" * 50_000, "a", "", 0), (7, "Chair.", "a", "", 0)]
    assert cut(spark, rows) == {5}
