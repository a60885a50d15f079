"""Operator 8: token ids in word-aligned Simple-8b files.

A 64-bit word holds a selector in its top four bits and, below, as many ids as
fit at that selector's width.  Selector 0 is the escape: its payload is the
place of an id of over 60 bits in the image's list of escaped ids.  Ids are cut
into blocks of ``BLOCK``; the words of a block start at the offset that the image
lists, so blocks are decoded at once or one by one.

A file is a Parquet part whose rows are images, in ascending order of document
id: (shard, seq, n_ids, image).  An image has whole documents.

Nulls and empty texts hold just the end id.  A null document id sorts first.
Repeated rows are each written, next to each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import slices, with_package
from pitchhouse.llm.tokens import CACHE, PieceEncoder, encoder_of
from pitchhouse.session import work_dir

# Fixed values of the format: ids per word and bits per id, by selector (0: escape).
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
MAGIC = 0x3142385331
BLOCK = 1024
_BY_WIDTH = [15, *range(1, 15)]  # selectors from the fullest on
_LIMITS = np.array([1 << int(WIDTHS[s]) for s in _BY_WIDTH], np.uint64)  # the first id too wide for each
_NEED = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)
#: An image is closed when it has so many ids.
IMAGE_IDS = 1 << 18


def encode_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escaped ids).  All blocks advance
    together, a word at a time."""
    v = np.ascontiguousarray(ids, np.uint64)
    n = len(v)
    blocks = -(-n // BLOCK)
    begin = np.arange(blocks) * BLOCK
    stop = np.minimum(begin + BLOCK, n)
    # place in ``_BY_WIDTH`` of the fullest selector that is wide enough for each id
    need = _NEED[v.astype(np.int64)] if n and v.max() < len(_NEED) else np.searchsorted(_LIMITS, v, "right").astype(np.uint8)
    most = int(need.max(initial=0))
    best = np.full(n, _BY_WIDTH[most] if most < len(_BY_WIDTH) else 0, np.uint8)  # every id fits, or the escape
    # the widest of each place's next 1, 2, 4, ... ids; a block's end is followed by none
    reach = {1: np.zeros((blocks, BLOCK + 128), np.uint8)}
    reach[1][:, :BLOCK] = np.append(need, np.zeros(blocks * BLOCK - n, np.uint8)).reshape(blocks, BLOCK)
    for k in (1, 2, 4, 8, 16, 32):
        reach[2 * k] = reach[k].copy()
        np.maximum(reach[k][:, :-k], reach[k][:, k:], out=reach[2 * k][:, :-k])
    for i in range(most - 1, int(need.min(initial=0)) - 1, -1):  # fuller selectors overwrite
        count = int(COUNTS[_BY_WIDTH[i]])
        k = min(64, 1 << (count.bit_length() - 1))
        widest = np.maximum(reach[k][:, :BLOCK], reach[k][:, count - k:count - k + BLOCK]).ravel()[:n]
        best[widest <= i] = _BY_WIDTH[i]
    live, at, steps = np.arange(blocks), begin, []
    while len(live):  # the first id of every word
        steps.append((live, at))
        at = at + COUNTS[best[at]]
        on = at < stop[live]
        live, at = live[on], at[on]
    who = np.concatenate([x for x, _ in steps] or [live])
    order = np.argsort(who, kind="stable")
    who, pos = who[order], np.concatenate([x for _, x in steps] or [at])[order]
    sel = best[pos]
    words = sel.astype(np.uint64) << np.uint64(60)
    escaped = v[pos[sel == 0]]
    words[sel == 0] |= np.arange(len(escaped), dtype=np.uint64)
    for s in np.unique(sel):
        if WIDTHS[s]:
            pick = np.flatnonzero(sel == s)
            k = np.arange(COUNTS[s])
            src = pos[pick][:, None] + k
            vals = np.where(src < stop[who[pick]][:, None], v[np.minimum(src, n - 1)], np.uint64(0))
            words[pick] |= np.bitwise_or.reduce(vals << (k * WIDTHS[s]).astype(np.uint64), axis=1)
    return words, np.searchsorted(who, np.arange(blocks)), escaped


def decode_words(words: np.ndarray, first: np.ndarray, n: int, escaped: np.ndarray) -> np.ndarray:
    """The ids; every selector's words are unpacked together."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    block = np.zeros(len(words), np.int64)
    block[first[1:]] = 1
    block = np.cumsum(block)
    count = COUNTS[sel]
    run = np.cumsum(count) - count
    start = run - run[first][block] + block * BLOCK
    stop = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(sel):
        pick = np.flatnonzero(sel == s)
        if s == 0:
            out[start[pick]] = escaped[(words[pick] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif WIDTHS[s]:
            k = np.arange(COUNTS[s])
            vals = (words[pick][:, None] >> (k * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
            dst = start[pick][:, None] + k
            ok = dst < stop[pick][:, None]
            out[dst[ok]] = vals[ok]
    return out


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """An image: header, null flags, document ids and counts, block offsets,
    escaped ids, words; all little-endian."""
    words, first, escaped = encode_words(ids)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(first), len(escaped), len(words)], "<i8")
    known = np.array([d is not None for d in doc_ids], "<i8")
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join(x.tobytes() for x in (head, known, docs, counts.astype("<i8"), first.astype("<i8"),
                                          escaped.astype("<u8"), words.astype("<u8")))


def unpack(image: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, counts, ids) of an image."""
    magic, docs, n, blocks, n_escaped, n_words = np.frombuffer(image, "<i8", 6).tolist()
    if magic != MAGIC:
        raise ValueError("not an image of token ids")
    at = 48

    def take(k: int, kind: str) -> np.ndarray:
        nonlocal at
        at += 8 * k
        return np.frombuffer(image, kind, k, at - 8 * k)

    known, doc_ids, counts = take(docs, "<i8"), take(docs, "<i8"), take(docs, "<i8")
    first, escaped, words = take(blocks, "<i8"), take(n_escaped, "<u8"), take(n_words, "<u8")
    return [d if k else None for d, k in zip(doc_ids.tolist(), known)], counts, decode_words(words, first, n, escaped)


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """What stands between blanks, tabs and line ends: the distinct words, the number
    of each text's words, and every word's place among the distinct ones."""
    for white in "\t\n\r":
        texts = pc.replace_substring(texts, white, " ")
    found = pc.split_pattern(texts, " ")
    words = found.flatten().dictionary_encode()
    at, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
    n = pc.list_value_length(found).to_numpy()
    if "" in distinct:  # next to white space, and empty texts
        void = distinct.index("")
        full = at != void
        n = np.bincount(np.repeat(np.arange(len(n)), n)[full], minlength=len(n))
        at = at[full]
        at = at - (at > void)
        del distinct[void]
    return distinct, n, at


def _ids_of(encoder: PieceEncoder, texts: pa.Array | list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each text, all ids), each text followed by the end id.  The
    vocabulary's normaliser and splitter never join characters across white
    space, so a text's ids are those of its words, one after the other; words that
    stand more than once are looked up once."""
    distinct, n_pieces, at = words_of(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
    codes = encoder.codes(distinct, np.bincount(at, minlength=len(distinct)))[at]
    size = encoder.n[codes]
    owner = np.repeat(np.arange(len(texts)), n_pieces)
    counts = np.bincount(owner, size, len(texts)).astype(np.int64) + 1
    out = np.full(int(counts.sum()), end_id, np.uint32)
    body = np.ones(len(out), bool)
    body[np.cumsum(counts) - 1] = False
    if len(size):
        run = np.cumsum(size) - size
        out[body] = encoder.flat[np.repeat(encoder.first[codes] - run, size) + np.arange(int(size.sum()))]
    return counts, out


def write_ids(docs: DataFrame, path: str, target: str, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text", partitions: int | None = None, keep: int = CACHE) -> None:
    """Encode every text with the tokenizer at ``path`` and write the files to
    ``target``; a Python process keeps the ids of about ``keep`` words.  Documents are dealt out by ranges of their id, so that shards
    follow one another; equal ids are split further by text."""
    spark = docs.sparkSession
    with_package(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = (picked.withColumn("tie", F.xxhash64("text"))
             .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
             .select("doc_id", "text", F.spark_partition_id().alias("shard")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = encoder_of(path, keep), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        shard = 0

        def image() -> pa.RecordBatch:
            nonlocal seq
            who = [d for x in held for d in x[0]]
            counts = np.concatenate([x[1] for x in held])
            ids = np.concatenate([x[2] for x in held])
            held.clear()
            seq += 1
            return pa.record_batch([pa.array([shard], pa.int32()), pa.array([seq - 1], pa.int32()),
                                    pa.array([len(ids)], pa.int64()),
                                    pa.array([pack(who, counts, ids)], pa.binary())],
                                   names=["shard", "seq", "n_ids", "image"])

        for who, _, part in slices(batches, 1):
            shard = part.column(2)[0].as_py()
            held.append((who, *_ids_of(encoder, pc.fill_null(part.column(1), ""), end_id)))
            encoder.trim()
            if sum(len(x[2]) for x in held) >= IMAGE_IDS:
                yield image()
        if held:
            yield image()

    dealt.mapInArrow(run, "shard int, seq int, n_ids long, image binary").write.parquet(target)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """From the files: a row per document with its place among all ids, the
    number of its ids and their CRC-32."""
    with_package(spark)
    files = spark.read.schema("shard int, seq int, n_ids long, image binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, seq, _, image in zip(*(c.to_pylist() for c in batch.columns)):
                docs, counts, ids = unpack(image)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                begins = ends - counts
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.record_batch([pa.array([shard] * len(docs), pa.int32()),
                                       pa.array([seq] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                                       pa.array(begins, pa.int64()), pa.array(counts, pa.int64()),
                                       pa.array(crc, pa.int64())],
                                      names=["shard", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(run, "shard int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    # ids before each image: a running sum over the shards, then one inside each shard
    sizes = files.select("shard", "seq", "n_ids")
    shards = (sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")))
    within = Window.partitionBy("shard").orderBy("seq")
    images = (sizes.select("shard", "seq", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("inside"))
              .join(shards, "shard").select("shard", "seq", (F.col("before") + F.col("inside")).alias("base")))
    return (rows.join(images, ["shard", "seq"])
            .select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, path: str, end_id: int = 1, keep: int = CACHE, **cols: str) -> DataFrame:
    """Write the files below the checkpoint folder and read them back."""
    target = work_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, target, end_id, keep=keep, **cols)
    return read_ids(docs.sparkSession, target)
