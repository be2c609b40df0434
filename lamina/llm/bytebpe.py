"""Byte-level BPE over batches of texts: pre-tokens by vectorised rules, words encoded once.

The rules are those of the public pattern of the byte_bpe tokenizers (PATTERN below): contractions, runs of
letters, digits or other signs with one blank before them, and blanks, the last of which is left to the run
after it. A text is never cut or shortened.
"""

from __future__ import annotations

import base64
import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The public split pattern and the contractions in it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT_ENDS = ["s", "t", "m", "d"]
LONG_ENDS = ["re", "ve", "ll"]

TOKENIZERS = "/opt/tokenizers"
LETTER, DIGIT, BLANK, OTHER = 0, 1, 2, 3
#: Bytes of text that are taken up at once inside a task.
SLICE_BYTES = 4 << 20


@functools.lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point, from the regex module's character data."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    at = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.int32)
    for k, p in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(p, text):
            out[at[m.start() : m.end()]] = k
    return out


@functools.lru_cache(4)
def ranks(path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> dict[bytes, int]:
    """Bytes and id of every token of a rank file."""
    with open(os.path.join(path, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(4)
def encoder(path: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """The tiktoken encoder of a rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks(path, name), special_tokens={})


@functools.lru_cache(4)
def token_lengths(path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> np.ndarray:
    """Bytes of each token, by id."""
    of = ranks(path, name)
    out = np.zeros(max(of.values()) + 1, np.int32)
    out[list(of.values())] = [len(b) for b in of]
    return out


def plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text array; null as empty, bytes that are no UTF-8 replaced."""
    a = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8)
    data = np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.empty(0, np.uint8)
    return data, off - off[0]


def decoded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, byte position of each and the end, offsets of the texts in code points)."""
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return cp, at, np.searchsorted(at, off)


def pretokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte offsets of all pre-tokens and the end, offsets of the texts in pre-tokens)."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(off), np.int64)
    cp, at, coff = decoded(data, off)
    n = len(cp)
    k = classes()[cp]
    first = np.zeros(n + 1, bool)
    first[coff] = True
    head, last = first[:n], first[1:].copy()
    last[-1] = True
    prev = np.empty(n, np.uint8)
    prev[0], prev[1:] = 9, k[:-1]
    blank = k == BLANK
    change = (k != prev) | head
    space_before = np.zeros(n, bool)
    space_before[1:] = cp[:-1] == 32
    space_before &= ~head
    start = change & (blank | ~space_before)
    # the last of two or more blanks goes with what follows it
    tail = blank & ~change & ~last
    tail[:-1] &= k[1:] != BLANK
    start |= tail
    # contractions: an apostrophe that begins a pre-token, and the letters after it
    a = np.flatnonzero((cp == 39) & change & ~space_before)
    if len(a):
        pad = np.concatenate([cp, np.zeros(3, np.uint32)])
        heads = np.concatenate([head, np.ones(3, bool)])
        c1 = np.where(heads[a + 1], 0, pad[a + 1])
        c2 = np.where(heads[a + 1] | heads[a + 2], 0, pad[a + 2])
        one = np.isin(c1, [ord(c) for c in SHORT_ENDS])
        two = np.zeros(len(a), bool)
        for e in LONG_ENDS:
            two |= (c1 == ord(e[0])) & (c2 == ord(e[1]))
        start[a[one | two] + 1] = False
        for hit, size in ((one, 2), (two, 3)):
            after = a[hit] + size
            start[after[after < n]] = True
    s = np.flatnonzero(start)
    return np.append(at[s], len(data)), np.searchsorted(s, coff)


def words(data: np.ndarray, offsets: np.ndarray) -> pa.DictionaryArray:
    """The pre-tokens as a dictionary array of their bytes."""
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return arr.dictionary_encode()


def encode_words(distinct: pa.Array, path: str, name: str) -> pa.LargeListArray:
    """Ids of each word, encoded on its own; a word of the vocabulary is one id."""
    enc = encoder(path, name)
    ids = [enc.encode_ordinary(w.decode("utf-8")) for w in distinct.to_pylist()]
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(lens.sum()))
    return pa.LargeListArray.from_arrays(np.append(0, np.cumsum(lens)), flat)


def gather(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the lists `codes` of a list array, and the running length."""
    lens = (offsets[1:] - offsets[:-1])[codes]
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    src = np.arange(total) - np.repeat(ends - lens - offsets[:-1][codes], lens)
    return values[src], np.append(0, ends)


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(start, length) of runs of rows with about `limit` bytes of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        base = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, base + limit, "right")))
        yield i, j - i
        i = j
