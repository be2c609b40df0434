"""Encoding of a corpus by a shuffle of its distinct words, and decoding by a join with the token bytes.

Texts are taken up in blocks, and cut into pre-tokens once. A word that is a token of the vocabulary has its id at
once; a block numbers its distinct words, keeps the ids known already beside, and its texts as lists of such numbers,
position by position. The words without an id go through the shuffle once a block, are encoded in the task that owns them, and their ids
go back to the block, where the texts are put together again by position. A hot word costs one row a block, however
often it stands there, and is spread over SALTS tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import bytebpe as B
from lamina.session import settled


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, pa.DictionaryArray, np.ndarray]]:
    """(block, ids, words, offsets of the texts in words). The block number is a digest of what it holds, so a repeated task gives the same block."""
    ids, texts = batch.column(0), batch.column(1)
    for i, n in B.slices(texts):
        data, off = B.plain(texts.slice(i, n))
        part = ids.slice(i, n)
        h = hashlib.blake2b(data.tobytes(), digest_size=8)
        h.update(off.tobytes())
        h.update(repr(part.to_pylist()).encode())
        cuts, ends = B.pretokens(data, off)
        yield int.from_bytes(h.digest(), "little", signed=True), part, B.words(data, cuts), ends


def _block_rows(id_type: str, path: str, name: str):
    """As rows of one table: texts (block, id, codes, step), the ids of a block's words (codes with step 0, -1 where the
    vocabulary lacks the word), and the words it lacks (block, code, word)."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = B.ranks(path, name)
        for batch in it:
            for block, ids, w, ends in _blocks(batch):
                number = np.fromiter((known.get(x, -1) for x in w.dictionary.to_pylist()), np.int32, len(w.dictionary))
                lacking = np.flatnonzero(number < 0)
                codes = w.indices.to_numpy().astype(np.uint16 if len(number) <= 1 << 16 else np.uint32)
                step, n, m = codes.itemsize, len(ids), len(lacking)
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((ends * step).astype(np.int64)), pa.py_buffer(codes)])
                same = lambda x, k, t: pa.repeat(pa.scalar(x, t), k)
                yield pa.RecordBatch.from_arrays([same(block, n, pa.int64()), ids, packed.cast(pa.binary()), same(step, n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], _NAMES)
                yield pa.RecordBatch.from_arrays([same(block, 1, pa.int64()), pa.nulls(1, ids.type), pa.array([number.tobytes()], pa.binary()), same(0, 1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())], _NAMES)
                if m:
                    words = w.dictionary.take(pa.array(lacking)).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([same(block, m, pa.int64()), pa.nulls(m, ids.type), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int32()), pa.array(lacking.astype(np.int32)), words], _NAMES)

    return rows, f"block long, id {id_type}, codes binary, step int, code int, word binary"


_NAMES = ["block", "id", "codes", "step", "code", "word"]
#: Tasks that a word of all blocks is spread over; each of them encodes it once.
SALTS = 32


def _encode_rows(path: str, name: str):
    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            d = batch.column(2).dictionary_encode()
            ids = B.encode_words(d.dictionary, path, name)
            values, ends = B.gather(ids.values.to_numpy().astype(np.int32), ids.offsets.to_numpy(), d.indices.to_numpy())
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(d), [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed.cast(pa.binary())], ["block", "code", "ids"])

    return rows


def _join_back(vocabulary: int):
    """The texts of a block from their codes: by the ids known already, and the other words' ids from the table."""

    def join(texts: pa.Table, table: pa.Table) -> pa.Table:
        step = texts.column("step").to_numpy()
        words = texts.filter(pa.array(step == 0)).column("codes")
        texts = texts.filter(pa.array(step > 0))
        if not texts.num_rows:
            return pa.table({"id": texts.column("id"), "ids": pa.array([], pa.list_(pa.int32()))})
        packed = table.column("ids").combine_chunks().cast(pa.large_binary()) if table.num_rows else pa.array([], pa.large_binary())
        off = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1, packed.offset * 8) // 4 if len(packed) else np.zeros(1, np.int64)
        vals = np.frombuffer(packed.buffers()[2], np.int32, int(off[-1])) if off[-1] else np.empty(0, np.int32)
        # each word of the block as a place in the lists: first one list for each id, then those of the table
        place = np.frombuffer(words[0].as_py(), np.int32).astype(np.int64)
        place[table.column("code").to_numpy().astype(np.int64)] = vocabulary + np.arange(table.num_rows)
        if len(place) and place.min() < 0:
            raise ValueError("a block lost words on the way; the input changed while it was read")
        body = texts.column("codes").combine_chunks().cast(pa.large_binary())
        boff = np.frombuffer(body.buffers()[1], np.int64, len(body) + 1, body.offset * 8)
        raw = np.frombuffer(body.buffers()[2], np.uint8)[boff[0] : boff[-1]] if boff[-1] > boff[0] else np.empty(0, np.uint8)
        size = int(step.max())
        at = place[raw.view(np.uint16 if size == 2 else np.uint32)]
        ids, ends = B.gather(np.concatenate([np.arange(vocabulary, dtype=np.int32), vals]), np.concatenate([np.arange(vocabulary), vocabulary + off]), at)
        lists = pa.ListArray.from_arrays(pa.array(ends[(boff - boff[0]) // size].astype(np.int32)), pa.array(ids, pa.int32()))
        return pa.table({"id": texts.column("id"), "ids": lists})

    return join


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = B.TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(id_col, ids): the token ids of each row's text, without special tokens; strings that look like them are ordinary text.

    Null and empty texts get an empty list. Every row stays, repeated rows and null ids too; other columns are
    left out. Ids may be of any type that Arrow and Parquet carry.
    """
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    blocks = settled(src.mapInArrow(*_block_rows(kind, path, name)), "blocks")
    words = blocks.filter("word is not null").select("block", "code", "word")
    # the same words side by side, so that each is encoded once
    coded = words.repartition("word", F.pmod("block", F.lit(SALTS))).sortWithinPartitions("word").mapInArrow(_encode_rows(path, name), "block long, code int, ids binary")
    texts = blocks.filter("word is null").select("block", "id", "codes", "step")
    out = texts.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(_join_back(len(B.ranks(path, name))), f"id {kind}, ids array<int>")
    return out.select(F.col("id").alias(id_col), "ids")


def token_table(spark, path: str = B.TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(token, bytes) of the vocabulary: a table of fixed size."""
    return spark.createDataFrame([(i, b) for b, i in B.ranks(path, name).items()], "token int, bytes binary")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = B.TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(id_col, text): the bytes of each row's ids, joined from the token table in order. An empty or null list gives the empty text."""
    # written once, so that the row numbers are the same in both branches
    rows = settled(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids")).withColumn("row", F.monotonically_increasing_id()), "ids")
    each = rows.select("row", F.posexplode("ids").alias("pos", "token"))
    parts = each.join(F.broadcast(token_table(df.sparkSession, path, name)), "token")
    whole = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("bytes").alias("h")))).alias("p"))
    text = F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")), "UTF-8")
    return rows.join(whole, "row", "left").select(F.col("id").alias(id_col), F.coalesce(text, F.lit("")).alias("text"))
