"""Splitting oversized texts at natural boundaries, by pointer doubling over tables of successors.

Every token of an oversized text is a boundary of some rank (heading, paragraph, line, sentence, word, none).
Each boundary is joined to its farthest legal successor, the overlap counted in; the table of successors is
squared until it spans the text, and all cuts fall out of the powers at once. One table holds all oversized
texts of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import bytebpe as B

TOKEN, CHARACTER, WORD, SENTENCE, LINE, PARAGRAPH, HEADING = range(7)


def boundary_ranks(data: np.ndarray, at: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Rank of the cut before the token at each byte `at`; word: whether a pre-token begins there."""
    pad = np.concatenate([np.zeros(4, np.uint8), data, np.zeros(1, np.uint8)])
    here, p1, p2, p3 = (pad[at + 4 - k] for k in range(4))
    rank = np.where((here & 0xC0) != 0x80, CHARACTER, TOKEN)
    rank[word] = WORD
    stop = np.isin(p1, [ord(c) for c in ".!?;"]) & np.isin(here, [ord(c) for c in " \t\r\n"])
    wide = ((p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x82)) | ((p3 == 0xEF) & (p2 == 0xBC) & np.isin(p1, [0x81, 0x9F]))
    rank[(stop | wide) & (rank >= CHARACTER)] = SENTENCE
    line = p1 == 10
    rank[line] = LINE
    rank[line & ((p2 == 10) | ((p2 == 13) & (p3 == 10)))] = PARAGRAPH
    rank[line & (here == ord("#"))] = HEADING
    return rank


def successors(rank: np.ndarray, begin: np.ndarray, end: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """For a cut at each token, the next cut: the farthest of the highest rank in the further half of the legal range.

    begin, end: first and last position of the text each position belongs to. A piece after a cut starts
    `overlap` tokens before it and holds at most `limit`. Ends lead to themselves.
    """
    pos = np.arange(len(rank))
    start = np.where(pos == begin, pos, np.maximum(begin, pos - overlap))
    far = np.minimum(start + limit, end)
    low = np.maximum(pos, start + limit // 2)
    nxt = np.where(far == end, end, -1)
    for r in range(HEADING, TOKEN - 1, -1):
        cuts = np.flatnonzero(rank >= r)
        if not len(cuts):
            continue
        i = np.searchsorted(cuts, far, "right") - 1
        cand = np.where(i >= 0, cuts[i], -1)
        nxt = np.where((nxt < 0) & (cand > low), cand, nxt)
    return np.where(nxt < 0, far, nxt)


def all_cuts(nxt: np.ndarray, roots: np.ndarray, longest: int) -> np.ndarray:
    """Every position on the paths from the roots, from the powers of the successor table."""
    powers = [nxt]
    while (1 << len(powers)) <= longest and not np.array_equal(powers[-1][roots], powers[-1][powers[-1][roots]]):
        powers.append(powers[-1][powers[-1]])
    seen = roots
    for p in reversed(powers):
        seen = np.unique(np.concatenate([seen, p[seen]]))
    return seen


def _pieces(ids: pa.Array, texts: pa.Array, limit: int, overlap: int, path: str, name: str, only_cut: bool, content: bool):
    data, off = B.plain(texts)
    if only_cut:  # a text of at most `limit` bytes has at most `limit` tokens
        keep = np.flatnonzero(off[1:] - off[:-1] > limit)
        ids, texts = ids.take(pa.array(keep)), texts.take(pa.array(keep))
        data, off = B.plain(texts)
    cuts, ends = B.pretokens(data, off)
    w = B.words(data, cuts)
    table = B.encode_words(w.dictionary, path, name)
    toff = table.offsets.to_numpy()
    codes = w.indices.to_numpy().astype(np.int64)
    lens = (toff[1:] - toff[:-1])[codes] if len(codes) else codes
    upto = np.append(0, np.cumsum(lens))
    total = upto[ends[1:]] - upto[ends[:-1]]
    big = np.flatnonzero(total > limit)
    out = []
    if not only_cut:
        small = np.flatnonzero(total <= limit)
        out.append((ids.take(pa.array(small)), np.zeros(len(small)), np.ones(len(small)), np.zeros(len(small)), total[small], texts.take(pa.array(small)).fill_null("") if content else None))
    if len(big):
        size = total[big]
        base = np.append(0, np.cumsum(size + 1))  # each text has one more position than tokens
        of = np.repeat(np.arange(len(big)), size + 1)
        begin, end = base[:-1][of], (base[1:] - 1)[of]
        at = np.empty(base[-1], np.int64)  # byte of each position
        word = np.zeros(base[-1], bool)
        tlen, vals = B.token_lengths(path, name), table.values.to_numpy()
        for j, d in enumerate(big):
            c = codes[ends[d] : ends[d + 1]]
            v, _ = B.gather(vals, toff, c)
            at[base[j] : base[j + 1]] = off[d] + np.append(0, np.cumsum(tlen[v]))
            word[base[j] + upto[ends[d] : ends[d + 1]] - upto[ends[d]]] = True
        rank = boundary_ranks(data, at, word)
        rank[base[1:] - 1] = HEADING
        nxt = successors(rank, begin, end, limit, overlap)
        path_ = all_cuts(nxt, base[:-1], int(size.max()))
        stop = path_[path_ != begin[path_]]
        doc = of[stop]
        prev = path_[np.searchsorted(path_, stop) - 1]
        start = np.where(prev == begin[stop], prev, np.maximum(begin[stop], prev - overlap))
        n = np.bincount(doc, minlength=len(big))
        number = np.arange(len(stop)) - np.append(0, np.cumsum(n))[doc]
        body = None
        if content:
            whole = data.tobytes()
            lead = np.append((data & 0xC0) != 0x80, True)
            body = []
            for a, b in zip(at[start], at[stop]):
                while not lead[a]:
                    a += 1
                while not lead[b]:
                    b += 1
                body.append(whole[a:b].decode("utf-8"))
            body = pa.array(body, pa.string())
        out.append((ids.take(pa.array(big[doc])), number, n[doc], start - begin[stop], stop - begin[stop], body))
    return out


def _split_rows(limit: int, overlap: int, path: str, name: str, only_cut: bool, content: bool):
    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i, n in B.slices(batch.column(1)):
                for ids, number, count, a, b, body in _pieces(batch.column(0).slice(i, n), batch.column(1).slice(i, n), limit, overlap, path, name, only_cut, content):
                    ints = [pa.array(np.asarray(x).astype(np.int32)) for x in (number, count, a, b)]
                    yield pa.RecordBatch.from_arrays([ids, *ints, *([body.cast(pa.string())] if content else [])], ["id", "piece", "pieces", "token_from", "token_to", *(["text"] if content else [])])

    return rows


def split(df: DataFrame, limit: int = 1024, overlap: int = 64, id_col: str = "doc_id", text_col: str = "text", path: str = B.TOKENIZERS, name: str = "byte_bpe_50k", only_cut: bool = False, content: bool = True) -> DataFrame:
    """(id_col, piece, pieces, token_from, token_to, text): the ordered pieces of each text, of at most `limit` ids each.

    Neighbours share exactly `overlap` ids. A cut falls on the farthest heading, else paragraph, line, sentence,
    word, character in the further half of the range; a word longer than that is cut inside. Texts within the
    limit are one piece; null and empty texts are one empty piece. With only_cut, texts within the limit are
    left out; without content, the text column is. Where ids end inside a character, the text of the piece
    before holds that character whole. Repeated rows and null ids stay.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be less than half the limit")
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, pieces int, token_from int, token_to int" + ", text string" * content
    return src.mapInArrow(_split_rows(limit, overlap, path, name, only_cut, content), schema).withColumnRenamed("id", id_col)
