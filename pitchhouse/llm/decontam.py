"""Operator 3: benchmark decontamination by training suffix arrays.

The documents that a task reads are cut into shards.  A shard's words get
numbers, and its suffix array (over words) is sorted by prefix doubling as deep
as the longest benchmark item.  Every suffix of every item is binary-searched in
every shard, a word deeper at a time: the interval at the depth of a window gives
all places of the window, the last interval that is not empty the longest
verbatim match.  Words are numbered by a dictionary, so matches are exact, and
the number 0 stands between documents, so that none crosses.

The benchmark is the query set.  Tasks prepare it in blocks of whole items
(``BLOCK_WORDS`` words or one item), which are stored compressed.  Blocks of up to
``SENT_BYTES`` (or one block) go to the executors at a time, and the documents are
read once for each such group; a task unpacks one block at a time.  Neither the
driver nor a broadcast holds more than a group.  Results of several groups are put
together by id and digest of the text, on which alone they depend.

Null and empty texts have no words.  An item with no words is in no document;
an item without an id hits, but is not listed.  Of items with the same id, all
texts count.  Repeated rows each give a row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import filtered, packed, slices, stored, with_package

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
BLOCK_WORDS = 500_000
#: Compressed bytes of blocks that are sent to the executors at a time.
SENT_BYTES = 64 << 20

#: Fixed value: a word is a run of letters a-z, digits and characters beyond ASCII, after lower-casing A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Block:
    """Items of the benchmark as one row of word numbers, with all suffixes."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        vocabulary: dict[bytes, int] = {}
        rows = [[vocabulary.setdefault(w, len(vocabulary)) for w in words] for _, words in items]
        self.vocabulary = list(vocabulary)
        self.item_ids = [i for i, _ in items]
        sizes = np.array([len(r) for r in rows], np.int64)
        self.words = np.array([w for r in rows for w in r], np.int64)
        self.item = np.repeat(np.arange(len(rows)), sizes)
        self.start = np.arange(len(self.words))
        self.left = np.repeat(np.cumsum(sizes), sizes) - self.start  # words from here to the item's end
        whole = self.left == np.repeat(sizes, sizes)
        # the depth at which the suffix is a window; 0: it is none
        self.depth = np.where(self.left >= window, window, np.where(whole & (np.repeat(sizes, sizes) < window), self.left, 0))
        self.longest = int(sizes.max(initial=0))


def blocks_of(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> DataFrame:
    """(longest, size, image, block): the benchmark, prepared and compressed, a block a row."""
    with_package(benchmark.sparkSession)
    picked = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    # a small benchmark in many files is one task's, and one block
    total = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-total // (6 * block_words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def close() -> pa.RecordBatch:
            block = Block(held, window)
            image = zlib.compress(pickle.dumps(block), 1)
            held.clear()
            return pa.record_batch([pa.array([block.longest], pa.int64()), pa.array([len(image)], pa.int64()),
                                    pa.array([image], pa.binary())], names=["longest", "size", "image"])

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if found := words_of(text.as_py()):
                    held.append((item, found))
                    n += len(found)
                if n >= block_words:
                    yield close()
                    n = 0
        if held:
            yield close()

    made = picked.coalesce(tasks).mapInArrow(run, "longest long, size long, image binary")
    return stored(made.withColumn("block", F.monotonically_increasing_id()), "benchmark-blocks")


class Shard:
    """The suffix array of some documents."""

    def __init__(self, texts: list[str], depth: int):
        vocabulary: dict[bytes, int] = {}
        row, begin, sizes = [], [], []
        for t in texts:
            found = words_of(t)
            begin.append(len(row))
            sizes.append(len(found))
            row += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in found]
            row.append(0)
        self.vocabulary = vocabulary
        self.words = np.array(row, np.int64)
        self.begin, self.sizes = np.array(begin, np.int64), np.array(sizes, np.int64)
        self.array = suffix_array(self.words, depth)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(self.words, minlength=len(vocabulary) + 1))])

    def search(self, block: Block, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth from 1 on: the block's suffixes that occur so deep, and
        their intervals in the array.  ``numbers``: the block's words' numbers here."""
        live = np.flatnonzero(numbers >= 0)
        lo, hi = self.below[numbers[live]], self.below[numbers[live] + 1]
        depth = 1
        while len(live):
            yield depth, live, lo, hi
            more = block.left[live] > depth
            live, lo, hi = live[more], lo[more], hi[more]
            want = numbers[block.start[live] + depth]
            known = want >= 0
            live, lo, hi, want = live[known], lo[known], hi[known], want[known]
            a = self._bound(lo, hi, want, depth)
            b = self._bound(a, hi, want + 1, depth)
            found = a < b
            live, lo, hi = live[found], a[found], b[found]
            depth += 1

    def _bound(self, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, depth: int) -> np.ndarray:
        """The first place in [lo, hi) whose word at ``depth`` is at least ``want``."""
        lo, hi, last = lo.copy(), hi.copy(), len(self.words) - 1
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.words[np.minimum(self.array[mid] + depth, last)] < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` words at least; only
    suffixes that are still tied are sorted again, each time twice as deep."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([words, np.zeros(3, np.int64)])
    if padded.max() < 1 << 20:
        key, known = (padded[:n] << 40) | (padded[1:n + 1] << 20) | padded[2:n + 2], 3
    else:
        key, known = (padded[:n] << 31) | padded[1:n + 1], 2
    order = np.argsort(key)
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    while True:
        # rank: the place of the first suffix that is tied with it
        head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank = np.empty(n + 1, np.int64)
        rank[order], rank[n] = head, -1
        tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if known >= depth or not len(tied):
            return order
        who = order[tied]
        key = head[tied] * (n + 1) + rank[np.minimum(who + known, n)] + 1
        again = np.argsort(key, kind="stable")
        order[tied] = who[again]
        key = key[again]
        fresh[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        known *= 2


def _numbers(shard: Shard, block: Block) -> np.ndarray:
    here = np.array([shard.vocabulary.get(w, -1) for w in block.vocabulary], np.int64)
    return here[block.words]


def contaminated(texts: list[str], blocks: list[bytes], longest: int) -> tuple[list, ...]:
    """For each text: words, merged spans of hit words, item ids that occur."""
    shard = Shard(texts, longest)
    n = len(shard.words)
    cover = np.zeros(n + 1, np.int64)
    found: list[set] = [set() for _ in texts]
    for packed in blocks:
        block = pickle.loads(zlib.decompress(packed))
        for depth, live, lo, hi in shard.search(block, _numbers(shard, block)):
            at = block.depth[live] == depth
            if not at.any():
                continue
            live, lo, hi = live[at], lo[at], hi[at]
            # equal windows have equal intervals: each is taken once, for all its items
            order = np.lexsort((block.item[live], lo))
            live, lo, hi = live[order], lo[order], hi[order]
            firsts = np.flatnonzero(np.concatenate([[True], lo[1:] != lo[:-1]]))
            for k, m in zip(firsts.tolist(), np.append(firsts[1:], len(lo)).tolist()):
                places = shard.array[lo[k]:hi[k]]
                np.add.at(cover, places, 1)
                np.add.at(cover, places + depth, -1)
                items = [block.item_ids[i] for i in np.unique(block.item[live[k:m]])]
                for d in np.unique(np.searchsorted(shard.begin, places, "right") - 1).tolist():
                    found[d].update(items)
    hit = np.cumsum(cover)[:n] > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(shard.begin, a, "right") - 1
    spans: list[list] = [[] for _ in texts]
    for d, x, y in zip(doc.tolist(), (a - shard.begin[doc]).tolist(), (b - shard.begin[doc]).tolist()):
        spans[d].append((x, y))
    return shard.sizes.tolist(), spans, [sorted(i for i in f if i is not None) for f in found]


def _prepared(docs: DataFrame, benchmark: DataFrame, window: int, item_col: str, text_col: str, block_words: int):
    """The stored blocks, the first and last block of each group, and the words of the longest item."""
    with_package(docs.sparkSession)
    blocks = blocks_of(benchmark, window, item_col, text_col, block_words)
    groups, total, longest = [], 0, 1
    for r in blocks.select("block", "size", "longest").orderBy("block").toLocalIterator():
        if not groups or total + r.size > SENT_BYTES:
            groups.append([r.block, r.block])
            total = 0
        groups[-1][1] = r.block
        total, longest = total + r.size, max(longest, r.longest)
    return blocks, groups or [[0, -1]], longest


def _send(blocks: DataFrame, group: list[int]):
    images = [bytes(r[0]) for r in blocks.where(F.col("block").between(*group)).select("image").collect()]
    return blocks.sparkSession.sparkContext.broadcast(images)


def _searched(blocks: DataFrame, groups: list, longest: int, search: Callable) -> list[DataFrame]:
    """``search(broadcast, longest)`` for each group; where there are several, each
    result is stored before the next group is sent."""
    if len(groups) == 1:
        return [search(_send(blocks, groups[0]), longest)]
    out = []
    for group in groups:
        sent = _send(blocks, group)
        out.append(stored(search(sent, longest), "benchmark-group"))
        sent.destroy()
    return out


def _tie(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if out and s["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], s["stop"])
        else:
            out.append(dict(s))
    return out


def _together(parts: list[DataFrame]) -> DataFrame:
    """One row for each document from a row of it in each part: spans and items united."""
    # equal rows have equal results in a part: sets hold at most one value a part
    per = (reduce(DataFrame.unionByName, parts).groupBy("doc_id", "tie", "n_words")
           .agg(F.flatten(F.collect_set("spans")).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                (F.count(F.lit(1)) / len(parts)).cast("int").alias("times")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([_merged(s) for s in batch.column(2).to_pylist()], _SPANS)
            yield pa.record_batch([batch.column(0), batch.column(1), spans, batch.column(3)],
                                  names=["doc_id", "n_words", "spans", "items"])

    return (per.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).select("doc_id", "n_words", "spans", "items")
            .mapInArrow(run, "doc_id long, n_words long, spans array<struct<start:long,stop:long>>, items array<long>"))


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document: words, spans [start, stop) of hit words, and the ids of
    the items that have a window in it, in ascending order."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _tie(F.col(text_col)).alias("tie"))

    def search(sent, longest: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts, part in slices(batches, 1):
                n, spans, items = contaminated(texts, sent.value, longest)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(n, pa.int64()),
                                       pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], _SPANS),
                                       pa.array(items, pa.list_(pa.int64()))],
                                      names=["doc_id", "tie", "n_words", "spans", "items"])

        return picked.mapInArrow(run, "doc_id long, tie string, n_words long, spans array<struct<start:long,stop:long>>, "
                                      "items array<long>")

    parts = _searched(*_prepared(docs, benchmark, window, item_col, item_text, block_words), search)
    return parts[0].drop("tie") if len(parts) == 1 else _together(parts)


def digest(found: DataFrame) -> DataFrame:
    """The report of ``contamination``, in counts."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(listed, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, unchanged."""
    blocks, groups, longest = _prepared(docs, benchmark, window, item_col, item_text, block_words)
    if len(groups) == 1:
        sent, at = _send(blocks, groups[0]), docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat = pa.record_batch([batch.column(at), batch.column(at)], names=["id", "text"])
                clean = [not s for _, texts, _ in slices(iter([flat]), 1)
                         for s in contaminated(texts, sent.value, longest)[1]]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return filtered(docs, run)

    text = F.col(f"`{text_col}`")
    rows = packed(docs, tie=_tie(text))
    keyed = docs.select(_tie(text).alias("tie"), text.alias("text"))

    def search(sent, longest: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts, part in slices(batches, 1):
                hit = [bool(s) for s in contaminated(texts, sent.value, longest)[1]]
                yield pa.record_batch([part.column(0).filter(pa.array(hit, pa.bool_()))], names=["tie"])

        return keyed.mapInArrow(run, "tie string")

    gone = reduce(DataFrame.union, _searched(blocks, groups, longest, search)).distinct()
    return rows.join(gone, "tie", "left_anti").select("row.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each item that shares a word with a document: the length in words of its
    longest verbatim match, where it starts in the item, and a document and word
    position where it stands (the least of each shard, then of all)."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def search(sent, longest: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, texts, _ in slices(batches, 1):
                shard, rows = Shard(texts, longest), []
                for packed in sent.value:
                    block, best = pickle.loads(zlib.decompress(packed)), {}
                    first = np.searchsorted(block.item, np.arange(len(block.item_ids)))
                    for depth, live, lo, hi in shard.search(block, _numbers(shard, block)):
                        _, k = np.unique(block.item[live], return_index=True)
                        best.update({int(block.item[live[j]]): (depth, int(live[j]), int(lo[j]), int(hi[j])) for j in k})
                    for item, (depth, s, lo, hi) in best.items():
                        place = int(shard.array[lo:hi].min())
                        d = int(np.searchsorted(shard.begin, place, "right")) - 1
                        rows.append((block.item_ids[item], depth, s - int(first[item]), ids[d], place - int(shard.begin[d])))
                yield pa.record_batch([pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                                      names=["item_id", "length", "item_start", "doc_id", "doc_start"])

        return picked.mapInArrow(run, "item_id long, length long, item_start long, doc_id long, doc_start long")

    rows = reduce(DataFrame.union, _searched(*_prepared(docs, benchmark, WINDOW, item_col, item_text, block_words), search))
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc_id", "doc_start", "item_start")).alias("best")
    return (rows.groupBy("item_id").agg(best)
            .select("item_id", (-F.col("best.less")).alias("length"), "best.item_start", "best.doc_id", "best.doc_start"))
