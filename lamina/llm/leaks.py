"""Held-out passages in training text: rare word n-grams seed the search, local alignment decides.

Words are runs of letters and digits after compatibility folding, without case, markup and invisible characters;
signs inside words and numbers are dropped; of Chinese and Japanese every character is a word. Tags are left
aside whole, with the values of their attributes; what a comment holds is text.
With at most one word in `tolerance` (6) changed, added, dropped or misspelt, any twelve consecutive words keep four
in a row, so seeds of four words miss nothing; sentences that stand in more than one item give no seeds. One scan
of the corpus keeps the stretches of text around shared seeds; there the seeds are counted. Each pair of text and
item is aligned at its rarest shared seed first, at the others only while no passage is found: a seed that
stands in very many texts is reached only for pairs that have no rarer one, or none that led to a passage.
Smith-Waterman scores the alignments, an exact count of the edits decides.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm import bytebpe as B
from lamina.session import settled

SEED = 4
LEAST = 12
TOLERANCE = 6
#: Lengths to test: a longer passage splits into parts of 12 to 23 words, one of which is at least as good.
TESTED = (LEAST, LEAST + TOLERANCE)
REACH = TESTED[-1] - SEED
SLACK = TESTED[-1] // TOLERANCE
#: Of a run of shared seeds every STEP-th is aligned; its window reaches as much further ahead.
STEP = 4
ITEM_WINDOW = 2 * REACH + SEED + STEP - 1
TEXT_WINDOW = ITEM_WINDOW + 2 * SLACK
#: Texts of one seed that go to one task of a shuffle.
SPREAD = 20_000

#: Elements that part words, and attributes that stand without a value.
BREAKS = frozenset("br p li div tr td th h1 h2 h3 h4 h5 h6".split())
BARE = "async autofocus autoplay checked controls defer disabled hidden loop multiple muted nowrap novalidate open readonly required reversed selected"
#: A tag is a name and attributes with values; anything else between angle brackets is text. Every part is possessive, so that time is linear.
_TAG = re.compile(
    r"""</?+([A-Za-z][A-Za-z0-9:-]*+)(?:\s++(?:[A-Za-z_:@][A-Za-z0-9_:.@-]*+\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>=]++)|(?:%s)(?![A-Za-z0-9_:.@=-])))*+\s*+/?+>"""
    % BARE.replace(" ", "|"),
    re.I,
)
_COMMENT = re.compile(r"<!--|-->|<!\[CDATA\[|\]\]>")
_ENTITY = re.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|([nrt\"/]))")
_HYPHENATED = re.compile(r"(?<=\w)[-\u2010\u2011][ \t]*\r?\n[ \t>*|#+]*(?=\w)")
_SENTENCE = re.compile(r"(?<=[.!?;。！？；])\s+|\n+")


@functools.lru_cache(1)
def _invisible() -> re.Pattern:
    import regex

    return regex.compile(r"[\p{Cf}\u034F\u115F\u1160\u17B4\u17B5\u180B-\u180F\u3164\uFE00-\uFE0F\uFFA0]+")


def folded(text: str | None) -> str:
    """Case, width, compatibility forms, markup, escapes, hyphens at line ends and invisible characters left aside."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub(lambda m: " " if m[1].lower() in BREAKS else "", _COMMENT.sub(" ", text))
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m.group()), text)
    if "\\" in text:
        text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] and not 0xD800 <= int(m[1], 16) < 0xE000 else " ", text)
    if "\n" in text:
        text = _HYPHENATED.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _invisible().sub("", text))
        text = unicodedata.normalize("NFKC", _invisible().sub("", text.casefold()))
        return text
    return text.lower()


def hash_words(distinct: pa.Array) -> np.ndarray:
    """64 bits of each word; 0 and 1 are kept for the margins."""
    h = np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in distinct.to_pylist()), np.uint64, len(distinct))
    return np.where(h < 2, h + np.uint64(2), h)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the folded texts, offsets of the texts in words)."""
    parts = [folded(t).encode("utf-8", "replace") for t in texts]
    off = np.append(0, np.cumsum([len(p) + 1 for p in parts]))  # one blank after each text
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    cp, at, coff = B.decoded(data, off)
    data, cp, at, coff = _joined(data, cp, at, coff)
    k = B.classes()[cp]
    word = (k == B.LETTER) | (k == B.DIGIT) | _marks()[cp]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], word.view(np.int8), [0]])))
    s, e = edge[::2], edge[1::2]
    alone = np.flatnonzero(_alone()[cp] & word)
    if len(alone):
        inside = np.zeros(len(cp) + 1, bool)
        inside[alone] = inside[alone + 1] = True
        cuts = np.flatnonzero(inside[1:-1] & word[1:] & word[:-1]) + 1
        s, e = np.sort(np.concatenate([s, cuts])), np.sort(np.concatenate([e, cuts]))
    if not len(s):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    # spans of words and of what lies between, as one array of strings; the words are every other one
    bounds = np.empty(2 * len(s) + 1, np.int64)
    bounds[0:-1:2], bounds[1::2], bounds[-1] = at[s], at[e], len(data)
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    d = spans.take(pa.array(np.arange(0, len(bounds) - 1, 2))).dictionary_encode()
    return hash_words(d.dictionary)[d.indices.to_numpy()], np.searchsorted(s, coff)


#: Signs inside a word or a number that are no gap between words.
IN_WORDS = "'-\u2010\u2011\u2019"
IN_NUMBERS = ".,"


def _joined(data: np.ndarray, cp: np.ndarray, at: np.ndarray, coff: np.ndarray):
    """The same without hyphens and apostrophes inside words and points and commas inside numbers: 0.5 is one word."""
    k = B.classes()[cp]
    alnum, digit = k <= B.DIGIT, k == B.DIGIT
    i = np.flatnonzero((k[1:-1] == B.OTHER) & alnum[:-2] & alnum[2:]) + 1
    sign = cp[i]
    gone = np.isin(sign, [ord(c) for c in IN_WORDS]) | (np.isin(sign, [ord(c) for c in IN_NUMBERS]) & digit[i - 1] & digit[i + 1])
    i = i[gone]
    if not len(i):
        return data, cp, at, coff
    keep = np.ones(len(cp), bool)
    keep[i] = False
    size = np.diff(at)
    return data[np.repeat(keep, size)], cp[keep], np.append(0, np.cumsum(size[keep])), coff - np.searchsorted(i, coff)


@functools.lru_cache(1)
def _marks() -> np.ndarray:
    """Combining marks that folding leaves: part of the word they stand in."""
    import regex

    out = np.zeros(0x110000, bool)
    for m in regex.finditer(r"[\p{Mn}\p{Mc}]", "".join(map(chr, range(0xD800)))):
        out[m.start()] = True
    return out


@functools.lru_cache(1)
def _alone() -> np.ndarray:
    """Characters of scripts without blanks between words."""
    import regex

    out = np.zeros(0x110000, bool)
    out[[ord(c) for c in regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))]] = True
    return out


_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def seeds_of(h: np.ndarray) -> np.ndarray:
    """Hash of every SEED consecutive words."""
    if len(h) < SEED:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - SEED + 1, np.uint64)
    for i in range(SEED):
        out = (out ^ h[i : len(out) + i]) * _MIX[i]
        out ^= out >> np.uint64(29)
    return out


def _windows(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, before: int, size: int, pad: int) -> np.ndarray:
    """Rows of `size` hashes from `before` words ahead of each `at`, `pad` beyond [lo, hi)."""
    i = at[:, None] - before + np.arange(size)[None, :]
    ok = (i >= lo[:, None]) & (i < hi[:, None])
    return np.where(ok, h[np.clip(i, 0, max(len(h) - 1, 0))], np.uint64(pad))


def _packed(rows: np.ndarray) -> pa.Array:
    n, w = rows.shape
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * w * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def item_seeds(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(seed, item, window): the seeds of each item outside sentences that stand in more than one item.

    Words on both sides of such a sentence are not consecutive. Equal seeds with equal windows of an item come once.
    """
    kind = items.schema[id_col].dataType.simpleString()
    src = items.select(F.col(f"`{id_col}`").alias("item"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def sentences(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            parts = [_SENTENCE.split(t or "") for t in b.column("text").to_pylist()]
            h, off = word_hashes([x for p in parts for x in p])
            rows = [h[off[i] : off[i + 1]].tobytes() for i in range(len(off) - 1)]
            of = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
            n = pa.array([i for p in parts for i in range(len(p))], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("item").take(of), b.column("row").take(of), n, pa.array(rows, pa.binary())], ["item", "row", "n", "words"])

    sent = src.mapInArrow(sentences, f"item {kind}, row long, n int, words binary").filter(F.length("words") > 0)
    shared = sent.groupBy("words").agg(F.min("item").alias("a"), F.max("item").alias("b")).filter("a <> b").select("words")
    own = sent.join(shared, "words", "left_anti")
    # runs of neighbouring sentences that are left
    gone = sent.join(shared, "words", "left_semi").select("item", "row", "n", F.lit(None).cast("binary").alias("words"))
    w = Window.partitionBy("row").orderBy("n")
    parts = own.select("item", "row", "n", "words").unionByName(gone).withColumn("part", F.sum(F.col("words").isNull().cast("int")).over(w)).filter("words is not null")
    runs = parts.groupBy("item", "row", "part").agg(F.array_sort(F.collect_list(F.struct("n", F.hex("words").alias("h")))).alias("p"))
    runs = runs.select("item", F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")).alias("words"))

    def seeds(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for item, words in zip(b.column("item"), b.column("words").to_pylist()):
                h = np.frombuffer(words, np.uint64)
                s = seeds_of(h)
                if len(h) >= LEAST:
                    at = np.arange(len(s))
                    win = _windows(h, np.zeros(len(s)), np.full(len(s), len(h)), at, REACH, ITEM_WINDOW, 0)
                    yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.repeat(item, len(s)), _packed(win)], ["seed", "item", "iw"])

    return runs.mapInArrow(seeds, f"seed long, item {kind}, iw binary").distinct()


def _near_rows(shared):
    """(id, words, at): of every text with a known seed the words around its seeds, stretches parted by margins, and where the seeds are."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value[0]
        bits = np.zeros(1 << 22, bool)
        low = np.uint64((1 << 22) - 1)
        bits[known & low] = True
        reach = REACH + SLACK + STEP
        for b in it:
            for i, n in B.slices(b.column(1)):
                h, off = word_hashes(b.column(1).slice(i, n).to_pylist())
                s = seeds_of(h)
                at = np.flatnonzero(bits[s & low])
                at = at[known[np.minimum(np.searchsorted(known, s[at]), len(known) - 1)] == s[at]]
                doc = np.searchsorted(off, at, "right") - 1
                ok = at + SEED <= off[doc + 1]
                at, doc = at[ok], doc[ok]
                if not len(at):
                    continue
                # words within reach of a seed in the same text
                cover = np.zeros(len(h) + 1, np.int32)
                np.add.at(cover, np.maximum(at - reach, off[doc]), 1)
                np.add.at(cover, np.minimum(at + SEED + reach, off[doc + 1]), -1)
                keep = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
                of = np.searchsorted(off, keep, "right") - 1
                # a margin ahead of every stretch: one word is enough, as windows that reach it hold all words up to the margin
                new = np.append(True, (np.diff(keep) > 1) | (np.diff(of) > 0))
                place = np.arange(len(keep)) + np.cumsum(new)
                out = np.ones(len(keep) + int(new.sum()), np.uint64)
                out[place] = h[keep]
                docs, first = np.unique(of, return_index=True)
                starts = np.append(place[first] - 1, len(out)).astype(np.int32)
                spots = place[np.searchsorted(keep, at)] - starts[np.searchsorted(docs, doc)]
                ends = np.append(0, np.cumsum(np.bincount(np.searchsorted(docs, doc), minlength=len(docs)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n).take(pa.array(docs)), _bytes_of(out, starts), _bytes_of(spots.astype(np.int32), ends)], ["id", "words", "at"]
                )

    return rows


def _bytes_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets of the texts in words, places of the seeds in words, text of each)."""
    words, at = b.column("words").to_pylist(), b.column("at").to_pylist()
    h = np.frombuffer(b"".join(words), np.uint64)
    off = np.append(0, np.cumsum([len(w) // 8 for w in words]))
    doc = np.repeat(np.arange(len(at)), [len(a) // 4 for a in at])
    return h, off, np.frombuffer(b"".join(at), np.int32) + off[doc], doc


def _count_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, docs) counted a batch at a time."""
    for b in it:
        h, _, at, doc = _unpacked(b)
        pairs = np.unique(np.stack([seeds_of(h)[at], doc.astype(np.uint64)], 1), axis=0) if len(at) else np.empty((0, 2), np.uint64)
        seed, n = np.unique(pairs[:, 0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n.astype(np.int64))], ["seed", "docs"])


def _hit_rows(shared):
    """(id, seed, salt, docs, tw) of every shared seed; a seed that stands in very many texts is spread over as many salts as it needs."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs = shared.value
        for b in it:
            h, off, at, doc = _unpacked(b)
            s = seeds_of(h)[at]
            salt = (at + doc) % np.maximum(1, -(-docs[np.searchsorted(known, s)] // SPREAD))
            for i in range(0, len(at), 20_000):
                k = slice(i, i + 20_000)
                win = _windows(h, off[doc[k]], off[doc[k] + 1], at[k], REACH + SLACK, TEXT_WINDOW, 1)
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(doc[k])), pa.array(s[k].view(np.int64)), pa.array(salt[k].astype(np.int64)), _packed(win)], ["id", "seed", "salt", "tw"])

    return rows


def local_scores(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Smith-Waterman score of each pair of windows: 1 a match, -1 a change, an added or a dropped word."""
    n, w = text.shape
    j = np.arange(w + 1, dtype=np.int16)
    row = np.zeros((n, w + 1), np.int16)
    best = np.zeros(n, np.int16)
    for i in range(item.shape[1]):
        up = np.zeros_like(row)
        up[:, 1:] = row[:, :-1] + np.where(item[:, i : i + 1] == text, 1, -1)
        up = np.maximum(np.maximum(up, row - 1), 0)
        row = np.maximum.accumulate(up + j, axis=1) - j
        best = np.maximum(best, row.max(axis=1))
    return best


def holds_passage(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether some LEAST or more consecutive words of the item window stand in the text window within the tolerance, by edit distance."""
    n, w = text.shape
    starts = ITEM_WINDOW - LEAST + 1
    j = np.arange(w + 1, dtype=np.int8)
    padded = np.concatenate([item, np.zeros((n, TESTED[-1]), np.uint64)], axis=1)
    row = np.zeros((n, starts, w + 1), np.int8)
    found = np.zeros(n, bool)
    for k in range(TESTED[-1]):
        word = padded[:, k : k + starts, None]
        nxt = row + 1
        nxt[:, :, 1:] = np.minimum(nxt[:, :, 1:], row[:, :, :-1] + (word != text[:, None, :]))
        row = np.minimum.accumulate(nxt - j, axis=2) + j
        if k + 1 in TESTED:
            whole = padded[:, k : k + starts] != 0  # the words from each start must all be there
            found |= ((row.min(axis=2) <= (k + 1) // TOLERANCE) & whole).any(axis=1)
    return found


def aligned(item: np.ndarray, text: np.ndarray, least_score: int) -> np.ndarray:
    """Whether each pair of windows holds a passage in an alignment of at least that score."""
    out = np.zeros(len(item), bool)
    for a in range(0, len(item), 2000):
        part = slice(a, a + 2000)
        near = a + np.flatnonzero(local_scores(item[part], text[part]) >= least_score)
        for k in np.array_split(near, len(near) // 500 + 1):
            out[k] = holds_passage(item[k], text[k])
    return out


def _leading(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Pairs of windows to align: of a run of shared seeds every STEP-th, as windows reach STEP - 1 words further ahead."""
    back = np.logical_and.accumulate(item[:, REACH - 1 :: -1] == text[:, REACH + SLACK - 1 : SLACK - 1 : -1], axis=1).sum(axis=1)
    return np.flatnonzero(back % STEP == 0)


def _align_rows(least_score: int):
    """(id, item) of joined windows that hold a passage."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            item = np.frombuffer(b"".join(b.column("iw").to_pylist()), np.uint64).reshape(-1, ITEM_WINDOW)
            text = np.frombuffer(b"".join(b.column("tw").to_pylist()), np.uint64).reshape(-1, TEXT_WINDOW)
            step = _leading(item, text)
            yield b.select(["id", "item"]).take(pa.array(step[aligned(item[step], text[step], least_score)], pa.int64()))

    return rows


def _search_rows(shared, items: pa.Array, least_score: int):
    """(id, item): the search with all item windows at hand, (known, docs, first occurrence of each, item number of each, windows)."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, first, number, windows = shared.value
        size = np.diff(first)
        for b in it:
            h, off, at, doc = _unpacked(b)
            k = np.searchsorted(known, seeds_of(h)[at])
            run = np.cumsum(size[k])
            hits = []
            for lo, hi in _chunks(run, 200_000):
                # every hit with every occurrence of its seed in an item, the rarest seed of each pair first
                n = size[k[lo:hi]]
                hit = np.repeat(np.arange(lo, hi), n)
                occ = np.repeat(first[k[lo:hi]] - (run[lo:hi] - n), n) + np.arange(run[lo] - n[0], run[hi - 1])
                pair = doc[hit].astype(np.int64) * len(items) + number[occ]
                order = np.lexsort((docs[k[hit]], pair))
                hit, occ, pair = hit[order], occ[order], pair[order]
                lead = np.append(True, pair[1:] != pair[:-1])
                known_pairs = np.empty(0, np.int64)
                for turn in (lead, ~lead):
                    w = np.flatnonzero(turn & ~np.isin(pair, known_pairs))
                    for part in np.array_split(w, len(w) // 20_000 + 1):
                        text = _windows(h, off[doc[hit[part]]], off[doc[hit[part]] + 1], at[hit[part]], REACH + SLACK, TEXT_WINDOW, 1)
                        item = windows[occ[part]]
                        use = np.arange(len(part)) if turn is lead else _leading(item, text)
                        good = use[aligned(item[use], text[use], least_score)]
                        known_pairs = np.union1d(known_pairs, pair[part[good]])
                hits.append(known_pairs)
            found = np.unique(np.concatenate([*hits, np.empty(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(found // len(items))), items.take(pa.array(found % len(items)))], ["id", "item"])

    return rows


def _chunks(run: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of hits with about `limit` pairs, one hit at least."""
    i = 0
    while i < len(run):
        j = max(i + 1, int(np.searchsorted(run, (run[i - 1] if i else 0) + limit, "right")))
        yield i, j
        i = j


def leaks(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", least_score: int = LEAST - 2, most_seeds: int = 4_000_000, broadcast_rows: int = 50_000) -> DataFrame:
    """(doc_col, item_col): every text that holds a passage of an item, once each.

    A passage is twelve or more consecutive words of the item with at most one in six edited, in an alignment that
    scores `least_score` (a match 1, an edit -1): twelve words with one edit, fourteen with two, or a passage that
    goes on beyond. With 8, twelve words with two edits are enough: mostly another sentence of the same pattern.
    Null and empty texts hold nothing; items of fewer than twelve words have no passage. Hashes of the items'
    seeds and their counts are broadcast in blocks of at most `most_seeds` (64 MB), by ranges of their hash; each
    block is searched for in all texts, and the parts are put together. The windows of the items are broadcast
    only up to `broadcast_rows` of them (16 MB), else joined by a shuffle on seed and salt.
    """
    spark = docs.sparkSession
    kind, ikind = docs.schema[doc_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    seeds = settled(item_seeds(items, item_col, text_col), "seeds")
    total = seeds.count()
    blocks = -(-total * 5 // (4 * most_seeds)) if total > most_seeds else 1
    src = docs.select(F.col(f"`{doc_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = None
    for k in range(blocks):
        mine = seeds.filter(F.pmod("seed", F.lit(blocks)) == k) if blocks > 1 else seeds
        known = np.sort(mine.select("seed").distinct().toArrow().column(0).to_numpy().view(np.uint64))
        if not len(known):
            known = np.zeros(1, np.uint64)
        near = settled(src.mapInArrow(_near_rows(spark.sparkContext.broadcast((known,))), f"id {kind}, words binary, at binary"), "near")
        met = near.mapInArrow(_count_rows, "seed long, docs long").groupBy("seed").agg(F.sum("docs").alias("docs")).toArrow()  # at most one row a seed of the block
        counts = np.zeros(len(known), np.int64)
        counts[np.searchsorted(known, met.column("seed").to_numpy().view(np.uint64))] = met.column("docs").to_numpy()
        if total <= broadcast_rows:
            table = mine.toArrow()  # at most broadcast_rows rows
            order = np.argsort(table.column("seed").to_numpy().view(np.uint64), kind="stable")
            table = table.take(pa.array(order)).combine_chunks()
            names = pa.array(table.column("item").to_pylist(), table.schema.field("item").type).dictionary_encode()
            windows = np.frombuffer(b"".join(table.column("iw").to_pylist()), np.uint64).reshape(-1, ITEM_WINDOW)
            first = np.searchsorted(table.column("seed").to_numpy().view(np.uint64), known)
            shared = spark.sparkContext.broadcast((known, counts, np.append(first, len(windows)), names.indices.to_numpy(), windows))
            found = near.mapInArrow(_search_rows(shared, names.dictionary, least_score), f"id {kind}, item {ikind}")
        else:
            hits = near.mapInArrow(_hit_rows(spark.sparkContext.broadcast((known, counts))), f"id {kind}, seed long, salt long, tw binary")
            frequent = spark.createDataFrame(met.filter(pc.greater(met.column("docs"), SPREAD)))
            salted = mine.join(frequent, "seed", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.ceil(F.col("docs") / SPREAD) - 1, F.lit(0)).cast("long"))))
            found = hits.join(salted.select("seed", "salt", "item", "iw"), ["seed", "salt"]).select("id", "item", "iw", "tw").mapInArrow(_align_rows(least_score), f"id {kind}, item {ikind}")
        out = found if out is None else out.unionByName(found)
    return out.distinct().select(F.col("id").alias(doc_col), F.col("item").alias(item_col))
