"""Operator 8: token ids in word-aligned Simple-8b blocks.

Stream layout, little-endian: magic, u32 documents, u64 ids, u32 blocks, u32 ids per block; then
document ids (i64), a null mark for each (u8), ids per document (u64), the first word of every
block (u64, one more for the end), and the 64-bit words. The low four bits of a word select how
many ids of which width fill its other 60; selector 0 is an escape: the next word is one raw value.
Block offsets let any block be decoded alone, all of its words at once.

Streams are rows of Parquet files in the shared folder, one stream per group of documents in
ascending order, so Spark's commit protocol covers lost executors and repeated tasks.

Defined results: null or empty text is its end id alone; the text of a special token is that token, as
the tokenizer has it; null document ids come first; repeated ids follow each other, in the order of a
hash of their texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import chunks, shared_path, tidy
from lectern.llm.encoding import CachedEncoder, with_end

MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sIQII")
ESCAPE = 0
#: Ids in a word and bits for each, by selector from 1; fixed values of Simple-8b for 60 bits.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
STREAM_IDS = 1 << 18
#: Bytes of text that are encoded at once.
CHUNK = 8 << 20
STREAMS = "shard int, stream int, n_docs int, n_ids long, base long, data binary"
DIGEST = "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long"


def _ranks(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), np.uint8)
    for bits in WIDTHS[1:]:
        out += (values >> bits) > 0
    return out


_SMALL = _ranks(np.arange(1 << 16, dtype=np.uint64))


def _widths(values: np.ndarray) -> np.ndarray:
    """The first selector whose width suffices for each value; 15: none does."""
    if len(values) and values.max() < len(_SMALL):
        return _SMALL[values.astype(np.int32)]
    return _ranks(values)


def _widest(rank: np.ndarray, count: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """The largest rank among each value and the ``count`` - 1 after it; shorter by ``count`` - 1.

    ``known`` holds those of powers of two.
    """
    power = 1
    while 2 * power <= count:
        if 2 * power not in known:
            known[2 * power] = np.maximum(known[power][:-power], known[power][power:])
        power *= 2
    own = known[power]
    return own if power == count else np.maximum(own[: len(rank) - count + 1], own[count - power : count - power + len(rank) - count + 1])


def encode_words(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``values`` (u64) and the first word of each block of ``block`` values."""
    n = len(values)
    rank = _widths(values)  # 1..14 by selector, 15: escape
    best = np.zeros(n, np.uint8)
    left = np.minimum(block - np.arange(n, dtype=np.int32) % block, 255).astype(np.uint8)
    known = {1: rank}
    for selector in range(14, 0, -1):  # most values in a word last: it wins
        count = int(COUNTS[selector])
        if count <= n:
            fits = (_widest(rank, count, known) <= selector) & (left[: n - count + 1] >= count)
            np.copyto(best[: n - count + 1], np.uint8(selector), where=fits)
    step = np.where(best > 0, COUNTS[best], 1)
    at = np.arange(0, n, block)  # all blocks are followed at once
    end, taken = np.minimum(at + block, n), np.zeros(n, bool)
    while len(at):
        taken[at] = True
        at = at + step[at]
        inside = at < end
        at, end = at[inside], end[inside]
    first = np.flatnonzero(taken)
    selector = best[first]
    escaped = selector == ESCAPE
    place = np.arange(len(first)) + np.cumsum(escaped) - escaped
    words = np.zeros(len(first) + int(escaped.sum()), np.uint64)
    words[place] = selector.astype(np.uint64)
    for s in np.unique(selector[~escaped]):
        mine = selector == s
        packed = words[place[mine]]
        for k in range(int(COUNTS[s])):
            packed |= values[first[mine] + k] << np.uint64(4 + k * int(WIDTHS[s]))
        words[place[mine]] = packed
    words[place[escaped] + 1] = values[first[escaped]]
    edges = np.searchsorted(first, np.arange(0, n, block))
    return words, np.append(place[edges] if n else np.zeros(0, np.int64), len(words)).astype(np.uint64)


def decode_words(words: np.ndarray) -> np.ndarray:
    """All values of whole blocks, decoded at once."""
    selector = (words & np.uint64(15)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE):  # a raw word may look like an escape itself
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    selector[raw] = ESCAPE  # its low bits select nothing
    count = np.where(raw, 0, COUNTS[selector])
    source = np.repeat(np.arange(len(words)), count)
    ends = np.cumsum(count)
    nth = np.arange(len(source)) - np.repeat(ends - count, count)
    chosen = selector[source]
    width = WIDTHS[chosen]
    shift = np.uint64(4) + nth.astype(np.uint64) * width
    values = (words[source] >> shift) & ((np.uint64(1) << width) - np.uint64(1))
    escaped = chosen == ESCAPE
    values[escaped] = words[source[escaped] + 1]
    return values


def write_stream(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, block: int = 1024) -> bytes:
    """``ids``: those of all documents end to end; ``sizes``: how many each has."""
    words, offsets = encode_words(ids.astype(np.uint64), block)
    head = _HEAD.pack(MAGIC, len(sizes), len(ids), len(offsets) - 1, block)
    keys = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
    nulls = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    return b"".join((head, keys.tobytes(), nulls.tobytes(), sizes.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()))


def _open_stream(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]:
    magic, docs, ids, blocks, block = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b token stream")
    at = _HEAD.size
    keys = np.frombuffer(data, "<i8", docs, at)
    nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    sizes = np.frombuffer(data, "<u8", docs, at + 9 * docs)
    offsets = np.frombuffer(data, "<u8", blocks + 1, at + 17 * docs)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), at + 17 * docs + 8 * (blocks + 1))
    return keys, nulls, sizes, offsets, words, ids, block


def read_stream(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What ``write_stream`` was given."""
    keys, nulls, sizes, _, words, ids, _ = _open_stream(data)
    flat = decode_words(words)
    if len(flat) != ids:
        raise ValueError("token stream is damaged")
    return pa.array(keys, mask=nulls.astype(bool)), flat.astype("<u4"), sizes.astype(np.int64)


def read_block(data: bytes, number: int) -> np.ndarray:
    """The ids of one block, without decoding the others."""
    *_, offsets, words, _, _ = _open_stream(data)
    return decode_words(words[int(offsets[number]) : int(offsets[number + 1])])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, spaced: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document and write the streams to ``path``, in ascending order of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder.loaded(tokenizer, spaced)
        shard, stream, base = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for a, b in chunks(batch.column(1), CHUNK):
                ids, offsets = with_end(*encoder.encode(batch.column(1).slice(a, b - a)), end_id)
                at = 0
                while at < b - a:  # streams of whole documents
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STREAM_IDS, "right")) - 1)
                    own = ids[offsets[at] : offsets[to]]
                    data = write_stream(batch.column(0).slice(a + at, to - at), own, np.diff(offsets[at : to + 1]))
                    row = [[shard], [stream], [to - at], [len(own)], [base], [data]]
                    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in STREAMS.split(", ")])
                    stream, base, at = stream + 1, base + len(own), to

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).withColumn("h", F.xxhash64("text"))
    # ranges of (id, hash): rows that repeat one id are cut into ranges as well
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    rows.mapInArrow(tidy(run, keeps=True), STREAMS).write.parquet(path)


def read_digest(spark, path: str) -> DataFrame:
    """From the files: each document's first position, number of ids and their checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys, ids, sizes = read_stream(data)
                ends, raw = np.cumsum(sizes), memoryview(ids).cast("B")
                sums = [zlib.crc32(raw[x:y]) for x, y in zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.full(len(keys), shard, np.int32)), pa.array(base + ends - sizes), pa.array(sizes), pa.array(np.array(sums, np.int64))], names=[x.split()[0] for x in DIGEST.split(", ")]
                )

    streams = spark.read.parquet(path)
    docs = streams.select("shard", "base", "data").mapInArrow(tidy(run), DIGEST)
    # one row per shard, so at most as many as there were write tasks
    totals = streams.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = totals.select(F.col("shard").alias("of"), (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    return docs.join(before, F.col("shard") == F.col("of")).select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, spaced: bool = False) -> DataFrame:
    """Write the streams into the shared folder, read them back and return the digest."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, spaced)
    return read_digest(docs.sparkSession, path)
