"""Operator 9: document fingerprints by locally consistent parsing.

A level's symbols are cut into phrases where the neighbourhood alone decides:
runs of one symbol become one symbol; deterministic coin tossing (Cole, Vishkin;
Sahinalp, Vishkin) turns every symbol into the place and value of the lowest bit
in which it differs from its left neighbour, which four rounds bring down to six
values; phrases start at local maxima.  A phrase's name is a hash of its symbols,
and the names are the next level's symbols.  Equal substrings so have the same
phrases, but for a few symbols at their ends, wherever they stand.

A fingerprint holds, for each of four levels, the number of phrases (on a
logarithmic scale) and ``BINS`` bins of the least name that falls in each, a byte a
bin.  The likeness of two fingerprints is the share of bins that agree among
those that either fills, on the highest level on which both fill ``ENOUGH`` bins
(the first one where there is none).

Null and empty texts have no phrase and the fingerprint of zeros; two of these
are alike (1), and unlike any other (0).  In ``edited``, a null id comes last and
equal ids follow by a digest of the text, so each row has one next row; a single
row is its own next one.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import slices, stored, with_package

LEVELS, BINS, ENOUGH = 4, 24, 8
#: Bytes of text taken at a time.
STEP = 1 << 19

_MUL = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, 0xD1342543DE82EF95, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MUL
    return x ^ (x >> np.uint64(32))


def _toss_table(size: int) -> np.ndarray:
    """For (own, left) labels below ``size``: twice the lowest place in which they
    differ, plus own's bit there."""
    own, left = np.arange(size)[:, None], np.arange(size)[None, :]
    x = own ^ left
    low = np.log2(np.maximum(x & -x, 1)).astype(np.int64)
    return np.where(x == 0, 0, 2 * low + ((own >> low) & 1)).astype(np.uint8).ravel()


_TABLES = [(128, _toss_table(128)), (16, _toss_table(16)), (8, _toss_table(8))]


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, different for neighbours, from four rounds of tossing."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = names[first] ^ np.uint64(1)  # as if the lowest bit differed
    x = names ^ left
    low = (np.frexp((x & (~x + np.uint64(1))).astype(np.float64))[1] - 1).clip(0)
    label = (2 * low + ((names >> low.astype(np.uint64)) & np.uint64(1)).astype(np.int64)).astype(np.uint8)
    for size, table in _TABLES:
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[first] = label[first] ^ 1
        label = table[label.astype(np.int64) * size + left]
    return label


def _parse(names: np.ndarray, owner: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The next level's names and owners."""
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(names)))
    names, owner = names[at], owner[at]
    names = np.where(run > 1, _mix(names + run.astype(np.uint64) * _MUL), names)
    head = np.ones(len(names), bool)
    head[1:] = owner[1:] != owner[:-1]
    label = _labels(names, np.flatnonzero(head))
    cut = head.copy()
    cut[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~head[2:]
    at = np.flatnonzero(cut)
    place = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
    value = np.add.reduceat(_mix(names + np.uint64(level)) * _POWERS[place % 64], at)
    return _mix(value), owner[at]


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of bytes for each text: for each level, the count, then the bins."""
    out = np.zeros((len(texts), LEVELS, 1 + BINS), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    names = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    for level in range(LEVELS):
        if not len(names):
            break
        names, owner = _parse(names, owner, level)
        count = np.bincount(owner, minlength=len(texts))
        out[:, level, 0] = np.where(count, 1 + 8 * np.log2(np.maximum(count, 1)), 0)
        least = np.full(len(texts) * BINS, ~np.uint64(0))
        np.minimum.at(least, owner * BINS + (names % np.uint64(BINS)).astype(np.int64), names)
        value = (1 + (_mix(least) >> np.uint64(16)) % np.uint64(255)).astype(np.uint8)
        value[least == ~np.uint64(0)] = 0
        out[:, level, 1:] = value.reshape(-1, BINS)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of rows."""
    both = ((a[:, :, 1:] > 0).sum(2) >= ENOUGH) & ((b[:, :, 1:] > 0).sum(2) >= ENOUGH)
    level = np.where(both.any(1), LEVELS - 1 - both[:, ::-1].argmax(1), 0)
    i = np.arange(len(a))
    x, y = a[i, level, 1:], b[i, level, 1:]
    filled = ((x > 0) | (y > 0)).sum(1)
    same = ((x == y) & (x > 0)).sum(1)
    none = (a[:, 0, 0] == 0) & (b[:, 0, 0] == 0)
    return np.where(none, 1.0, same / np.maximum(filled, 1))


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the following text."""
    h = len(text) // 2
    return text[:len(text) - h] + following[:h]


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _rows(ids: list, texts: list[str], prints: np.ndarray, following: list[str], after: np.ndarray) -> list[pa.Array]:
    edited = [edit(t, f) for t, f in zip(texts, following)]
    changed = fingerprints(edited)
    show = lambda m: pa.array([r.tobytes().hex() for r in m], pa.string())
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()), show(prints), show(changed),
            pa.array(likeness(prints, changed), pa.float64()), pa.array(likeness(prints, after), pa.float64())]


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text, in hexadecimal; no shuffle."""
    with_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, part in slices(batches, 1, STEP):
            yield pa.record_batch([part.column(0), pa.array([r.tobytes().hex() for r in fingerprints(texts)])],
                                  names=["doc_id", "fingerprint"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint string"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text against itself with its last half replaced from the next
    document (descending ids, after the last the first), and against that one.

    Texts are dealt out once, by ranges of the id; a task compares neighbours.
    Only the first and the last text of each task are handed on and paired."""
    spark = docs.sparkSession
    with_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    dealt = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .withColumn("tie", F.xxhash64("text")).repartitionByRange(n, *order).sortWithinPartitions(*order)
             .select("doc_id", "text", F.spark_partition_id().alias("part")))
    ends = ", part int, kind int, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def end(kind: int) -> pa.RecordBatch:
            cols = [pa.array([held[0]], pa.int64()), *[pa.nulls(1, k) for k in _TYPES[1:]]]
            return pa.record_batch([*cols, pa.array([part_id], pa.int32()), pa.array([kind], pa.int32()),
                                    pa.array([held[1]], pa.string())], names=[*_FIELDS, "part", "kind", "text"])

        held, part_id = None, 0
        for ids, texts, part in slices(batches, 1, STEP):
            prints = fingerprints(texts)
            if held is None:
                part_id, held = part.column(2)[0].as_py(), (ids[0], texts[0], prints[:1])
                yield end(1)
                all_ids, all_texts, all_prints = ids, texts, prints
            else:
                all_ids, all_texts, all_prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], prints])
            if len(all_ids) > 1:
                k = len(all_ids) - 1
                cols = _rows(all_ids[:-1], all_texts[:-1], all_prints[:-1], all_texts[1:], all_prints[1:])
                yield pa.record_batch([*cols, pa.nulls(k, pa.int32()), pa.array([0] * k, pa.int32()), pa.nulls(k, pa.string())],
                                      names=[*_FIELDS, "part", "kind", "text"])
            held = (all_ids[-1], all_texts[-1], all_prints[-1:])
        if held is not None:
            yield end(2)

    found = stored(dealt.mapInArrow(run, _SCHEMA + ends), "fingerprints")
    last = found.where("kind = 2").select("doc_id", "part", "text")
    first = found.where("kind = 1").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    turn = Window.orderBy("part")
    follow = (last.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(turn), F.min("part").over(
        Window.partitionBy()))))
    pairs = last.join(follow, "part").join(first, "next_part").select("doc_id", "text", "following")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, part in slices(iter([batch]), 1, STEP):
                after = part.column(2).to_pylist()
                yield pa.record_batch(_rows(ids, texts, fingerprints(texts), after, fingerprints(after)), names=_FIELDS)

    return found.where("kind = 0").select(*_FIELDS).union(pairs.mapInArrow(pair, _SCHEMA))


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
