"""Operator 7: removal of repeated byte strings by a collection's suffix order.

A byte goes if a string of ``width`` bytes that covers it starts anywhere else.
Strings are sharded by content: a string's key is the least hash of its
``CORE``-byte substrings, and consecutive strings of one key make a fragment, so
equal strings always meet under one key (the super-k-mers of k-mer counting).

1. A key with one fragment has no repeat, unless its core comes twice.  Keys whose fragments are all equal
   (two or more) are repeated throughout; no text is needed to tell.
2. Of the other keys, each different fragment's text is fetched once, and shards
   of whole keys get the column-wise construction of Bauer, Cox and Rosone: in
   round j the j-th symbol from the end of every fragment is inserted into the
   collection, at the place that the last-to-first mapping gives, and common
   prefixes with both neighbours follow from the least common prefix between equal
   symbols one round before.  A suffix whose prefix with a neighbour reaches
   ``width`` starts a repeated string.
3. A key of more than ``hot`` different fragments is not put into one shard: its
   strings are counted by digest, whichever task they are in.

Hashes of 64 bits under 64-bit keys stand for equality of fragments, SHA-256 for
that of strings in step 3; step 2 compares the bytes themselves.

What differs from the method on one collection: its texts are fragments, not
documents, in many separate collections of about ``SHARD_BYTES`` bytes (a key is never
divided, so up to ``hot`` fragments more), each held in the memory of a task; no
sequence is kept in external files.  A round carries the sorted entries and the common
prefixes; the transform itself is derived once, after the last round.  One
collection of all documents would make every round a pass of one task over the
whole corpus, while keys make the shards independent of each other.

Null and empty texts have 0 bytes.  Rows that repeat id and text are different
places: they count as repeats of each other, and each gives a row.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import slices, stored, with_package

WIDTH, CORE = 200, 64
#: Different fragments of a key above which its strings are counted apart.
HOT = 2_000
#: Bytes of fragments that are put into one collection.
SHARD_BYTES = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept between calls."""
    if len(_powers.get("p", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers["p"] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, _P))])
        _powers["q"] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, _INVERSE))])
    return _powers["p"][:n], _powers["q"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` consecutive values, from running minima of blocks."""
    n = len(x)
    blocks = -(-n // w)
    y = np.full(blocks * w, ~np.uint64(0))
    y[:n] = x
    y = y.reshape(blocks, w)
    fore = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], fore[w - 1:n])


def fragments(raws: list[bytes], width: int = WIDTH, core: int = CORE) -> tuple[np.ndarray, ...]:
    """Of each text's strings of ``width`` bytes: (key, hash of the fragment, text,
    first start, number of starts, whether it may repeat a string of its own) of
    all runs of starts with one key."""
    x = np.frombuffer(b"".join(raws), np.uint8)
    none = np.zeros(0, np.int64)
    if len(x) < width:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none.astype(bool)
    sizes = np.array([len(r) for r in raws], np.int64)
    begin = np.cumsum(sizes) - sizes
    p, q = _power(len(x) + 1)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
    small = _mix((total[core:] - total[:-core]) * q[:len(x) - core + 1])
    key = _least(small, width - core + 1)
    owner = np.repeat(np.arange(len(raws)), sizes)[:len(key)]
    place = np.arange(len(key)) - begin[owner]
    valid = place + width <= sizes[owner]
    cut = valid.copy()  # where a fragment starts
    cut[1:] &= (key[1:] != key[:-1]) | (place[1:] == 0)
    at = np.flatnonzero(cut)
    # a run ends where the next one starts or where its text has no more strings
    stop = np.minimum(np.append(at[1:], len(key)), (begin + sizes - width + 1)[owner[at]])
    n = stop - at
    longest = width - core + 1
    if len(n) and n.max() > longest:  # repetitive text: long runs are cut evenly
        pieces = -(-n // longest)
        inner = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, n = np.repeat(at, pieces) + inner * longest, np.minimum(longest, np.repeat(n, pieces) - inner * longest)
    # a start's own core is the least, and the next start has that key too: the
    # core comes twice, and the fragment may repeat a string of its own
    twice = np.concatenate([[0], np.cumsum(small[:len(key)] == key)])
    inner = twice[at + n - 1] > twice[at]
    end = at + n + width - 1
    whole = _mix((total[end] - total[at]) * q[at] + n.astype(np.uint64))
    return key[at], whole, owner[at], place[at], n, inner


def repeated_starts(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each text, the starts of its strings of ``width`` bytes that also start
    anywhere else in the collection, by column-wise insertion."""
    m = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    longest = int(sizes.max(initial=0))
    used, dense = np.unique(np.frombuffer(b"".join(texts), np.uint8), return_inverse=True)
    kind = np.uint8 if len(used) < 255 else np.uint16
    deep = np.uint8 if width < 255 else np.uint16  # prefixes count up to ``width``
    # column j: the symbol before the suffix of length j, 0 at a text's start
    back = np.zeros((longest + 1, m), kind)
    owner = np.repeat(np.arange(m), sizes)
    back[np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(owner)), owner] = dense + 1
    lcp = np.zeros(m + 2, deep)  # two zeros stand behind the last prefix
    # the transform's entries by symbol, then place: entry r of it is the r-th of the mapping
    bits = np.int64(max(1, int(sizes.sum() + m).bit_length()))
    number = np.int32 if bits + 9 < 32 else np.int64
    mask, bits = number((1 << int(bits)) - 1), number(bits)
    sort = np.sort((back[0].astype(number) << bits) | np.arange(m, dtype=number))
    who = np.argsort(back[0], kind="stable")  # the strings, as their entries stand in ``sort``
    r = np.arange(m)
    for j in range(1, longest + 1):
        entry = sort[r]
        on = entry > mask  # the others have begun: all of the string is in
        who, r, entry = who[on], r[on], entry[on]
        n, k = len(sort), len(r)
        if not k:
            break
        at, symbol = (entry & mask).astype(np.int64), entry >> bits
        turn = np.argsort(at)
        a = at[turn]
        # prefix with the suffix before: one more than the least since the last equal symbol
        near = sort[np.maximum(r - 1, 0)]
        has = (r > 0) & ((near >> bits) == symbol)
        low = np.where(has, (near & mask) + 1, at)[turn]
        up = np.empty(k, deep)
        up[turn] = np.minimum(np.minimum.reduceat(lcp, np.column_stack([low, a + 1]).ravel())[::2], width - 1) + 1
        up[~has] = 0
        near = sort[np.minimum(r + 1, n - 1)]
        has = (r + 1 < n) & ((near >> bits) == symbol)
        high = np.where(has, (near & mask) + 1, at + 2)[turn]
        down = np.empty(k, deep)
        down[turn] = np.minimum(np.minimum.reduceat(lcp, np.column_stack([a + 1, high]).ravel())[::2], width - 1) + 1
        down[~has] = 0
        at = r + k  # after the m empty suffixes, less the ended ones; ascending like r
        keep = np.ones(n + k + 2, bool)
        keep[at] = False
        grown = np.empty(n + k + 2, deep)
        grown[keep] = lcp
        grown[at + 1] = down
        grown[at] = up
        grown[-2:] = 0
        lcp = grown
        # an old place moves on by the number of entries inserted at or before it
        edges = np.concatenate([[0], at - np.arange(k), [n]])
        sort += np.repeat(np.arange(k + 1, dtype=number), np.diff(edges))[sort & mask]
        new = (back[j, who].astype(number) << bits) | at.astype(number)
        turn = np.argsort(new)
        who, new = who[turn], new[turn]
        r = np.searchsorted(sort, new) + np.arange(k)
        keep = np.ones(n + k, bool)
        keep[r] = False
        grown = np.empty(n + k, number)
        grown[keep], grown[r] = sort, new
        sort = grown
    hit = np.maximum(lcp[:-2], lcp[1:-1]) >= width
    bwt = np.empty(len(sort), kind)
    bwt[sort & mask] = sort >> bits
    # the last-to-first mapping of the whole transform names the suffixes
    order = np.argsort(bwt, kind="stable")
    rank = np.empty(len(bwt), np.int64)
    rank[order] = np.arange(len(bwt))
    out: list[list] = [[] for _ in texts]
    who, at = np.arange(m), np.arange(m)
    for j in range(1, longest + 1):
        on = bwt[at] > 0
        who, at = who[on], rank[at[on]]
        for i in who[hit[at]].tolist() if j >= width else ():
            out[i].append(int(sizes[i]) - j)
    return [np.array(x[::-1], np.int64) for x in out]


def _runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Spans [from, to) of bytes that strings at ``starts`` (ascending) cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > width)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(),
                    (starts[np.append(cut, len(starts) - 1)] + width).tolist()))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet or overlap, put together."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _found(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, whole, times, text), sorted by key, to repeated spans of each text.
    Collections hold whole keys."""
    held: list[tuple] = []

    def solve() -> pa.RecordBatch:
        rows = list({(k, w): (k, w, c, t) for k, w, c, t in held}.values())
        held.clear()
        hits = repeated_starts([t for *_, t in rows], width)
        out = [(k, w, a, b) for (k, w, c, t), h in zip(rows, hits)
               for a, b in ([(0, len(t))] if c > 1 else _runs(h, width))]
        return pa.record_batch([pa.array(list(x), pa.int64()) for x in (zip(*out) if out else [[]] * 4)],
                               names=["key", "whole", "a", "b"])

    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= SHARD_BYTES and row[0] != held[-1][0]:
                yield solve()
                size = 0
            held.append(row)
            size += len(row[3])
    if held:
        yield solve()


def repeated_spans(docs: DataFrame, width: int = WIDTH, core: int = CORE, hot: int = HOT) -> DataFrame:
    """(d, tie, spans) for ``docs`` (d, tie, text): unmerged spans of bytes that a
    repeated string covers, for texts that have any."""
    base = docs.select("d", "tie", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, part in slices(batches, 2, 1 << 20):
            key, whole, owner, start, n, inner = fragments([t.encode() for t in texts], width, core)
            take = pa.array(owner)
            yield pa.record_batch([part.column(0).take(take), part.column(1).take(take), pa.array(key.view(np.int64)),
                                   pa.array(whole.view(np.int64)), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(inner)],
                                  names=["d", "tie", "key", "whole", "start", "n", "inner"])

    # stored: both passes read it, and cutting costs more than reading
    every = stored(base.mapInArrow(cut, "d long, tie long, key long, whole long, start int, n int, inner boolean"), "fragments")
    shared = (every.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("whole").alias("lo"), F.max("whole").alias("hi"),
                                       F.max("inner").alias("inner"))
              .where("c > 1 or inner").select("key", F.expr("lo <> hi or c = 1").alias("mixed")))
    found = stored(every.drop("inner").join(shared, "key"), "shared-fragments")
    throughout = found.where("not mixed").select("d", "tie", F.col("start").alias("a"), (F.col("start") + F.col("n") + width - 1).alias("b"))

    mixed = found.where("mixed")
    kinds = mixed.groupBy("key", "whole").agg(F.min(F.struct("d", "tie", "start", "n")).alias("at"), F.count(F.lit(1)).alias("c"))
    wanted = kinds.groupBy(F.col("at.d").alias("d"), F.col("at.tie").alias("tie")).agg(
        F.collect_list(F.struct("key", "whole", "c", "at.start", "at.n")).alias("parts"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for blob, parts in zip(batch.column(0), batch.column(1).to_pylist()):
                raw = unzip.decompress(blob.as_py())
                yield pa.record_batch([*[pa.array([p[k] for p in parts], pa.int64()) for k in ("key", "whole", "c")],
                                       pa.array([raw[p["start"]:p["start"] + p["n"] + width - 1] for p in parts], pa.binary())],
                                      names=["key", "whole", "c", "part"])

    parts = stored(_packed(base).join(wanted, ["d", "tie"]).select("blob", "parts")
                   .mapInArrow(fetch, "key long, whole long, c long, part binary"), "fragment-texts")
    many = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key")
    few = parts.join(many, "key", "left_anti")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = (few.repartition(n, "key").sortWithinPartitions("key")
              .mapInArrow(lambda batches: _found(batches, width), "key long, whole long, a long, b long"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, whole, c, text in zip(*(x.to_pylist() for x in batch.columns)):
                k = len(text) - width + 1
                yield pa.record_batch([pa.array([key] * k, pa.int64()), pa.array([whole] * k, pa.int64()), pa.array([c] * k, pa.int64()),
                                       pa.array(range(k), pa.int64()),
                                       pa.array([hashlib.sha256(text[i:i + width]).digest() for i in range(k)], pa.binary())],
                                      names=["key", "whole", "c", "a", "digest"])

    apart = (parts.join(many, "key").dropDuplicates(["key", "whole"])
             .mapInArrow(strings, "key long, whole long, c long, a long, digest binary"))
    again = apart.groupBy("key", "digest").agg(F.sum("c").alias("times")).where("times > 1").select("key", "digest")
    counted = apart.join(again, ["key", "digest"]).select("key", "whole", "a", (F.col("a") + width).alias("b"))

    partly = mixed.join(solved.union(counted), ["key", "whole"]).select(
        "d", "tie", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    # rows of one id and text give the same spans: as a set, they count once however many they are
    return throughout.union(partly).groupBy("d", "tie").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _packed(base: DataFrame) -> DataFrame:
    """The texts, compressed for the way through a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for _, texts, part in slices(batches, 2):
            yield pa.record_batch([part.column(0), part.column(1), pa.array([zip_.compress(t.encode()) for t in texts], pa.binary())],
                                  names=["d", "tie", "blob"])
    return base.mapInArrow(run, "d long, tie long, blob binary")


def remove_repeats(docs: DataFrame, width: int = WIDTH, core: int = CORE, hot: int = HOT, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the maximal removed runs [a, b) of each text's
    bytes, and what is left of it."""
    with_package(docs.sparkSession)
    least = -(1 << 63)  # stands for a null id
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("d"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).select("d", F.xxhash64("text").alias("tie"), "text")
    spans = repeated_spans(base, width, core, hot)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                raws = [unzip.decompress(b) for b in part.column(1).to_pylist()]
                runs = [_joined([(s["a"], s["b"]) for s in x or ()]) for x in part.column(2).to_pylist()]
                kept = [b"".join(r[a:b] for a, b in zip([0, *(y for _, y in x)], [*(y for y, _ in x), len(r)]))
                        for r, x in zip(raws, runs)]
                yield pa.record_batch([part.column(0), pa.array([len(r) for r in raws], pa.int64()),
                                       pa.array([[{"a": a, "b": b} for a, b in x] for x in runs], kind), pa.array(kept, pa.binary())],
                                      names=["d", "n_bytes", "spans", "kept"])

    out = (_packed(base).join(spans, ["d", "tie"], "left").select("d", "blob", "spans")
           .mapInArrow(drop, "d long, n_bytes long, spans array<struct<a:long,b:long>>, kept binary"))
    return out.select(F.when(F.col("d") != least, F.col("d")).alias("doc_id"), "n_bytes", "spans", "kept")


def digest(removed: DataFrame) -> DataFrame:
    """The report of ``remove_repeats``, in counts."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
