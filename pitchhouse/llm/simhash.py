"""Operator 5: SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint gets the vector (i mod 7) + 1 of GF(2)^3; table v of the
seven non-zero vectors keeps the bits whose product with v is 1.  Two differing
bits give two equations in three unknowns, which a non-zero v solves: so every
pair within two bits collides in some table (Pagh, "CoveringLSH", 2018).

Equal fingerprints are one node.  In a table's bucket of up to ``bucket`` nodes,
pairs are compared.  A larger bucket is linked without pairs, and as exactly:
every node gives itself and the fingerprints one bit away (of the bits that the
table leaves out), nodes are within two bits if and only if they share one of
these, and each is linked to the least node that shares it.

Null and empty texts have the fingerprint zero and are linked like any other.
A null id is never a component's name unless all ids of the component are null,
which then has a null name; if a whole group has null ids, it is linked to none.
Repeated rows each give a row.  Other columns of the input are not read, and where
rows are kept (``drop_near_duplicates``) they may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import packed, slices, stored, with_package
from pitchhouse.llm.components import components

SHINGLE, RADIUS, BITS = 3, 2, 64
BUCKET = 64


def masks(radius: int = RADIUS) -> list[int]:
    """A mask for each non-zero vector of radius + 1 bits, as signed 64-bit."""
    top = 1 << (radius + 1)
    out = []
    for v in range(1, top):
        m = sum(1 << i for i in range(BITS) if bin((i % (top - 1) + 1) & v).count("1") % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def fingerprints_of(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprints of texts: a bit is set if over half of the
    shingles' XXH64 (seed 42) have it."""
    hashed, sizes = [], []
    for t in texts:
        words = t.encode().lower().split()
        line = b" ".join(words)
        ends = list(accumulate((len(w) + 1 for w in words), initial=-1))
        k = min(shingle, len(words))
        hashed += [xxhash.xxh64_intdigest(line[a + 1:b], 42) for a, b in zip(ends, ends[k:])] if k else []
        sizes.append(len(words) - k + 1 if k else 0)
    out = np.zeros(len(texts), np.uint64)
    n = np.array(sizes, np.int64)
    full = np.flatnonzero(n)
    if len(full):
        begin = np.cumsum(n[full]) - n[full]
        raw = np.array(hashed, "<u8")
        for at in range(0, 64, 8):  # eight bits at a time bound the memory
            byte = ((raw >> np.uint64(at)) & np.uint64(255)).astype(np.uint8)
            ones = np.add.reduceat(np.unpackbits(byte[:, None], axis=1, bitorder="little"), begin, axis=0, dtype=np.int32)
            got = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little")[:, 0]
            out[full] |= got.astype(np.uint64) << np.uint64(at)
    return out


def simhashes(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, fp): the fingerprint of every whole text, as a long, and the text's MD5."""
    with_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, part in slices(batches, 1):
            yield pa.record_batch([part.column(0), part.column(2), pa.array(fingerprints_of(texts, shingle).view(np.int64))],
                                  names=["doc_id", "tie", "fp"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), _tie(text_col).alias("tie"))
            .mapInArrow(run, "doc_id long, tie string, fp long"))


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between nodes (node, fp), with the same components as all
    pairs of fingerprints at ``radius`` or fewer bits."""
    if radius != RADIUS:
        raise ValueError("links are made for a radius of 2 bits")
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks(radius))])
    entries = (nodes.select("node", "fp", F.explode(tables).alias("x"))
               .select("node", "fp", "x.t", "x.mask", F.col("fp").bitwiseAND(F.col("x.mask")).alias("key")))
    counts = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(entries.join(counts, ["t", "key"]), "buckets")

    few = shared.where(F.col("n") <= bucket)
    x = few.select("t", "key", F.col("node").alias("a"), F.col("fp").alias("fa"))
    y = few.select("t", "key", F.col("node").alias("b"), F.col("fp").alias("fb"))
    pairs = (x.join(y, ["t", "key"]).where("a > b").where(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius)
             .select("a", "b"))

    flips = F.concat(F.array(F.lit(0).cast("long")), F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(BITS)]))
    near = (shared.where(F.col("n") > bucket)
            .select("t", "node", "fp", "mask", F.explode(flips).alias("flip"))
            .where(F.col("flip").bitwiseAND(F.col("mask")) == 0)
            .select("t", "node", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")))
    least = near.groupBy("t", "point").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = near.join(least, ["t", "point"]).where("node <> b").select(F.col("node").alias("a"), "b")
    return pairs.union(stars).distinct()


def _tie(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def _named(fps: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(fp, component_id) of every fingerprint."""
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    joined = components(links(nodes.where("node is not null"), radius, bucket))
    return nodes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document: fingerprints link at
    ``radius`` or fewer bits, and a component is named by its smallest id."""
    fps = stored(simhashes(docs, shingle, id_col, text_col).select("doc_id", "fp"), "simhash")
    return (fps.join(_named(fps, radius, bucket), "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id, or where rows share the
    id, of the least MD5 of the text; of equal rows any one.  Rows without an id give
    way to those with one; where none has, one row of each fingerprint stays."""
    fps = stored(simhashes(docs, shingle, id_col, text_col), "simhash-ties")
    named = _named(fps, radius, bucket)
    alone = F.when(F.col("component_id").isNull(), F.col("fp"))
    # equal rows are counted first, so a component of many copies is a few rows a task
    stay = (fps.join(named, "fp").groupBy("component_id", alone.alias("alone"), "doc_id", "tie").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("component_id", "alone").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "n")).alias("s"))
            .select("s.doc_id", "s.tie", "s.n"))
    rows = packed(docs, id=F.col(f"`{id_col}`").cast("long"), md5=_tie(text_col))
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("md5") == F.col("tie")))
    one = kept.where("n = 1").select("row")
    first = kept.where("n > 1").groupBy("id", "md5").agg(F.first("row").alias("row")).select("row")
    return one.union(first).select("row.*")
