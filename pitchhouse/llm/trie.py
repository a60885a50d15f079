"""Operator 11: the prefix trie of conversations as balanced parentheses.

A conversation is its turns in order; every distinct sequence of first turns is a
node.  The trie is never built as a whole:

1. Turns get their place in their conversation, and a prefix its name: the XOR of
   hashes, 128 bits, of (place, turn), so a running XOR names all prefixes.  Nodes
   are counted by name.  Nodes with one child and no conversation of their own are
   left out of the paths: what happens on such a chain follows from the node at its
   lower end.  On the path of a conversation every remaining node has fewer members
   than the one above, or ends a conversation, so a path of k nodes needs some k * k / 2 turns.
2. The distinct paths are sorted and dealt out by ranges.  A shard writes its part
   of the trie as parentheses, one pair a node, over blocks with the least excess
   in each and a tree above them: ``close_of`` delimits subtrees, the rank of
   the pairs ``()`` counts leaves, and cumulative arrays give members and savings.
3. Nodes on a shard's first and last path may go on in the next shard.  These two
   spines, with the sums of what hangs off them, are the paths of the next, smaller
   round, in which the shared ones merge, until one shard holds all that is left.
4. Chain nodes take the sums of the node at their lower end.

A long conversation is spread: turns are numbered in ranges, running values are
taken inside blocks of ``BLOCK`` places, and block totals are carried on.  Names that many
rows share are looked up in a broadcast of at most ``HEAVY`` rows, which is a
bound by counting; the others by a join.  Lists of conversations are sorted and
joined to pieces in ranges, and only the pieces of one list stream through one
digest.

Null roles and texts are empty.  Rows without a conversation id belong to no conversation.
A null turn comes first; equal turns follow each other by the digest of role and
text.  Repeated rows are repeated turns.  An empty table has no nodes.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import stored, with_package

#: Fixed values of the rebuilding: conversations that share a first one, and turns taken from it.
GROUP, TURNS = 100, 6
#: Rows of a range of the numbering, and places whose running values are taken together.
BLOCK_ROWS, BLOCK = 250_000, 65_536
#: Paths and nodes on paths of a shard; rows of a broadcast; bytes of a piece of a list.
SHARD_PATHS, SHARD_NODES, HEAVY, PIECE = 4096, 1 << 20, 10_000, 1 << 20
#: Places of a block of parentheses.
SPAN = 64


class Parentheses:
    """Balanced parentheses with the least excess of each block of ``SPAN``
    places, and above them the least of every two blocks, four, and so on."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        blocks = max(1, -(-len(opens) // SPAN))
        padded = np.full(blocks * SPAN, len(opens) + 1, np.int64)
        padded[:len(opens)] = self.excess
        self.least = [padded.reshape(blocks, SPAN).min(1)]
        while len(self.least[-1]) > 1:
            low = self.least[-1]
            if len(low) % 2:
                low = np.append(low, len(opens) + 1)
                self.least[-1] = low
            self.least.append(low.reshape(-1, 2).min(1))
        # leaves are the pairs "()": how many of them start before each place
        pair = np.zeros(len(opens), bool)
        pair[:-1] = opens[:-1] & ~opens[1:]
        self.pair = pair

    def close_of(self, at: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the next at which the excess is
        below its own."""
        goal = self.excess[at] - 1
        out = np.full(len(at), -1, np.int64)
        todo = self._scan(at + 1, (at // SPAN + 1) * SPAN, goal, out, np.arange(len(at)))
        # up until the block to the right, or a group of them, goes low enough
        node, level = at[todo] // SPAN, np.zeros(len(todo), np.int64)
        found = np.zeros(len(todo), bool)
        for k, low in enumerate(self.least[:-1]):
            live = np.flatnonzero(~found)
            left = live[node[live] % 2 == 0]
            hit = left[low[node[left] + 1] <= goal[todo[left]]]
            node[hit] += 1
            level[hit], found[hit] = k, True
            rest = np.flatnonzero(~found)
            node[rest] //= 2
        # and down to the first block that does
        for k in range(len(self.least) - 2, 0, -1):
            down = np.flatnonzero(level >= k)
            child = 2 * node[down]
            node[down] = child + (self.least[k - 1][child] > goal[todo[down]])
            level[down] = k - 1
        self._scan(node * SPAN, (node + 1) * SPAN, goal[todo], out, todo)
        return out

    def _scan(self, begin: np.ndarray, end: np.ndarray, goal: np.ndarray, out: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Look for the goal inside a block; those not found are returned."""
        end = np.minimum(end, len(self.excess))
        missing, live = [], np.arange(len(who))
        begin = begin.copy()
        while len(live):
            over = begin[live] >= end[live]
            missing.append(who[live[over]])
            live = live[~over]
            hit = self.excess[begin[live]] == goal[live]
            out[who[live[hit]]] = begin[live[hit]]
            live = live[~hit]
            begin[live] += 1
        return np.sort(np.concatenate(missing)) if missing else who[:0]


_LOAD = ("upto", "members", "leaves", "saved", "inner")
_LOAD_TYPE = "struct<" + ",".join(f"{k}: long" for k in _LOAD) + ">"
_OUT = ("a long, b long, n_convs long, n_leaves long, below long, path array<struct<a: long, b: long>>, "
        f"load array<{_LOAD_TYPE}>")
_ARROW_PATH = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_ARROW_LOAD = pa.list_(pa.struct([(k, pa.int64()) for k in _LOAD]))


def shard(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, load: dict, last: bool) -> tuple[dict, list[tuple]]:
    """Sums of the nodes that are complete in a shard of sorted paths, and its
    spines as (a, b, load) for the next round (none if it is the ``last``).

    ``load`` has, for every node of every path: ``upto``, the code points down to
    it; of conversations known so far at it, or below it but no longer in a path,
    the ``members``, ``leaves`` and ``saved``; and whether it has ``inner`` nodes below."""
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    # equal names are one node; nodes are numbered as they first come, which is preorder
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    group = np.cumsum(new) - 1
    first = np.minimum.reduceat(order, np.flatnonzero(new))
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    node = np.empty(len(a), np.int64)
    node[order] = rank[group]
    first = np.sort(first)  # the element at which each node opens
    n = len(first)
    fresh = np.zeros(len(a), np.int64)
    fresh[first] = 1
    common = sizes - np.add.reduceat(fresh, begin)  # nodes shared with the row before
    closed = np.append(0, sizes[:-1]) - common  # pairs closed before a row
    closed[0] = 0
    open_at = np.arange(n) + np.cumsum(closed)[row[first]]
    opens = np.zeros(2 * n, bool)
    opens[open_at] = True
    tree = Parentheses(opens)
    close_at = tree.close_of(open_at)
    end = np.arange(n) + (close_at - open_at + 1) // 2  # the next node in preorder outside the subtree

    def total(x: np.ndarray) -> np.ndarray:
        """Sums over subtrees, from the cumulative array."""
        run = np.append(0, np.cumsum(x))
        return run[end] - run[:-1]

    held = {k: np.zeros(n, np.int64) for k in _LOAD}
    for k in ("members", "leaves", "saved"):
        np.add.at(held[k], node, load[k])
    np.maximum.at(held["inner"], node, load["inner"])
    held["upto"][node] = load["upto"]
    inner = (held["inner"] > 0) | (end - np.arange(n) > 1)
    spine = np.zeros(n, bool)
    if not last:
        spine[node[:sizes[0]]] = True
        spine[node[begin[-1]:]] = True
    members = total(held["members"])
    top = first == begin[row[first]]
    parent = np.where(top, -1, node[first - 1])
    edge = held["upto"] - np.where(top, 0, held["upto"][parent])
    own = np.where(spine, 0, (members - 1) * edge)
    # leaves: pairs "()" that close at once, by their rank; a spine's end is left to the next round
    pairs = tree.pair.copy()
    pairs[open_at[spine | inner]] = False
    rank_of = np.append(0, np.cumsum(pairs))
    leaves = rank_of[close_at + 1] - rank_of[open_at] + total(held["leaves"])
    saved = total(held["saved"] + own)
    done = np.flatnonzero(~spine)
    out = {"a": a[first[done]], "b": b[first[done]], "n_convs": members[done], "n_leaves": leaves[done],
           "below": saved[done] - own[done]}
    if last:
        return out, []
    # what hangs off a spine node: its sums less those of the spine nodes right below
    rest = {"members": members, "leaves": leaves, "saved": saved}
    rest = {k: v.copy() for k, v in rest.items()}
    below = np.flatnonzero(spine & (parent >= 0))
    for k, v in (("members", members), ("leaves", leaves), ("saved", saved)):
        np.subtract.at(rest[k], parent[below], v[below])
    spines, seen = [], np.zeros(n, bool)
    for i in sorted({0, len(sizes) - 1}):
        part = slice(begin[i], begin[i] + sizes[i])
        mine = node[part]
        given = {k: np.where(seen[mine], 0, v[mine]) for k, v in rest.items()}
        spines.append((a[part], b[part], {"upto": held["upto"][mine], "inner": inner[mine].astype(np.int64)} | given))
        seen[mine] = True
    return out, spines


def _batch(out: dict, spines: list[tuple]) -> pa.RecordBatch:
    n, m = len(out["a"]), len(spines)
    cols = [pa.concat_arrays([pa.array(out[k], pa.int64()), pa.nulls(m, pa.int64())])
            for k in ("a", "b", "n_convs", "n_leaves", "below")]
    paths = [[{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist())] for a, b, _ in spines]
    loads = [[dict(zip(_LOAD, v)) for v in zip(*(load[k].tolist() for k in _LOAD))] for _, _, load in spines]
    cols.append(pa.concat_arrays([pa.nulls(n, _ARROW_PATH), pa.array(paths, _ARROW_PATH)]))
    cols.append(pa.concat_arrays([pa.nulls(n, _ARROW_LOAD), pa.array(loads, _ARROW_LOAD)]))
    return pa.record_batch(cols, names=["a", "b", "n_convs", "n_leaves", "below", "path", "load"])


def _shards(batches: Iterator[pa.RecordBatch], last: bool, paths: int, nodes: int) -> Iterator[pa.RecordBatch]:
    """Shards of sorted (path, load) rows, cut as they come."""
    held: list[pa.RecordBatch] = []

    def built() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        path, load = (whole.column(k).chunk(0) for k in ("path", "load"))
        field = lambda of, k: of.flatten().field(k).to_numpy(zero_copy_only=False)
        return _batch(*shard(path.value_lengths().to_numpy().astype(np.int64), field(path, "a"), field(path, "b"),
                             {k: field(load, k) for k in _LOAD}, last))

    rows = size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, paths):
            part = batch.slice(at, paths)
            held.append(part)
            rows, size = rows + part.num_rows, size + len(part.column(0).flatten())
            if not last and rows >= 4 and (rows >= paths or size >= nodes):
                yield built()
                held, rows, size = [], 0, 0
    if rows:
        yield built()


def subtree_sums(paths: DataFrame, shard_paths: int = SHARD_PATHS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(a, b, n_convs, n_leaves, below) of every node on (path, load) rows."""
    spark = paths.sparkSession
    with_package(spark)
    found, level = [], stored(paths, "trie-paths")
    while True:
        rows, nodes = level.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("path")), F.lit(0))).first()
        last = rows <= 16 or (rows <= shard_paths and nodes <= shard_nodes)
        if last:
            dealt = level.coalesce(1)
        else:
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BLOCK_ROWS), -(-nodes // (8 * shard_nodes)))
            # eight paths a task or more: each round then has fewer than the one before
            dealt = level.repartitionByRange(min(tasks, -(-rows // min(shard_paths, SHARD_PATHS)), rows // 8), "path")
        run = lambda batches, last=last: _shards(batches, last, shard_paths, shard_nodes)
        out = stored(dealt.sortWithinPartitions("path").select("path", "load").mapInArrow(run, _OUT), "trie-sums")
        found.append(out.where("path is null").select("a", "b", "n_convs", "n_leaves", "below"))
        if last:
            break
        level = out.where("path is not null").select("path", "load")
    whole = found[0]
    for other in found[1:]:
        whole = whole.union(other)
    return whole


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, heavy: int = HEAVY) -> DataFrame:
    """Inner join of ``rows`` with the one row of ``table`` that has their keys.
    ``weight`` counts the rows of a key, ``total`` all rows: at most ``heavy`` keys
    have more than their share and are broadcast, the others are shuffled."""
    share = total // heavy
    values = [c for c in table.columns if c not in keys and c != weight]
    many = table.where(F.col(weight) > share).select(*keys, *values)
    few = table.where(F.col(weight) <= share).select(*keys, *values)
    hot = rows.join(F.broadcast(many), keys)
    cold = rows.join(F.broadcast(many.select(*keys)), keys, "left_anti").join(few, keys)
    return hot.unionByName(cold)


def numbered_turns(conversations: DataFrame, block_rows: int = BLOCK_ROWS, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, at, turn's digest, chars), stored in order, and for every
    conversation and range of them what came before."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    base = stored(conversations.where(F.col(conv_col).isNotNull())
                  .select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("d"),
                          F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row")), "turns")
    ranges = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // block_rows))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("d"), F.col("row")]
    turns = stored(base.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                   .select("conv", "d", "chars", F.monotonically_increasing_id().alias("at")), "turns-in-order")
    turns = turns.withColumn("range", F.shiftright("at", 33))
    counts = turns.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv").orderBy("range")
    return turns, counts.select("conv", "range", "first", (F.sum("n").over(earlier) - F.col("n")).alias("before"),
                                F.sum("n").over(Window.partitionBy("conv")).alias("n"))


def rebuilt(turns: DataFrame, parts: DataFrame, group: int = GROUP, most: int = TURNS) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first turns of its group's first one for its
    own: (conv, pos, d, chars, size), and (conv, size) of all conversations."""
    h = F.crc32(F.col("conv").cast("string")) % most
    firsts = parts.where("before = 0").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    parts = stored(parts.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % group)
                   .join(firsts, "base", "left")
                   .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
                   .withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                   .drop("base_n"), "turn-ranges")
    placed = turns.join(parts, ["conv", "range"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first") + 1)
    own = placed.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "d", "chars", "size")
    convs = parts.where("before = 0")
    lent = (placed.where(F.col("conv") == F.col("base")).where(F.col("pos") < most).select("base", "pos", "d", "chars")
            .join(convs.select("base", "conv", "h", "size"), "base").where("pos <= h").select("conv", "pos", "d", "chars", "size"))
    return stored(own.union(lent), "rebuilt"), convs.select("conv", "size")


def prefixes(rows: DataFrame, convs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The nodes on the way of every conversation, from the root (depth 0) on, and
    the places of the longest conversation."""
    longest = convs.agg(F.max("size")).first()[0] or 0
    rows = (rows.withColumn("x", F.xxhash64(F.lit(1), "pos", "d")).withColumn("y", F.xxhash64(F.lit(2), "pos", "d"))
            .withColumn("block", F.expr(f"(pos - 1) div {block}")))
    run = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = rows.select("conv", "block", "pos", "x", "y", "chars", "size", F.bit_xor("x").over(run).alias("a"),
                      F.bit_xor("y").over(run).alias("b"), F.sum("chars").over(run).alias("upto"))
    if longest > block:  # what earlier blocks of the conversation hold
        earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("chars").alias("c"))
        carried = totals.select("conv", "block", F.bit_xor("x").over(earlier).alias("cx"), F.bit_xor("y").over(earlier).alias("cy"),
                                F.sum("c").over(earlier).alias("cc")).where("block > 0")
        got = (got.join(carried, ["conv", "block"], "left")
               .withColumn("a", F.col("a").bitwiseXOR(F.coalesce("cx", F.lit(0).cast("long"))))
               .withColumn("b", F.col("b").bitwiseXOR(F.coalesce("cy", F.lit(0).cast("long"))))
               .withColumn("upto", F.col("upto") + F.coalesce("cc", F.lit(0))))
    got = got.select("conv", F.col("pos").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("up_a"),
                     F.col("b").bitwiseXOR(F.col("y")).alias("up_b"), "chars", "upto", (F.col("pos") == F.col("size")).alias("ends"))
    zero = [F.lit(0).cast("long").alias(k) for k in ("depth", "a", "b", "up_a", "up_b", "chars", "upto")]
    root = convs.select("conv", *zero, (F.col("size") == 0).alias("ends"))
    return stored(got.unionByName(root), "prefixes"), longest


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One row a node: its smallest and all members, those that end there, children."""
    nodes = rows.groupBy("a", "b").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.count_if("ends").alias("n_ends"),
        *[F.max(c).alias(c) for c in ("depth", "up_a", "up_b", "chars", "upto")])
    nodes = stored(nodes, "trie-nodes")
    children = (nodes.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    return stored(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counts")


def paths_of(rows: DataFrame, nodes: DataFrame, total: int, heavy: int = HEAVY) -> DataFrame:
    """(path, load) of every distinct conversation, over the nodes that branch or
    end a conversation."""
    kept = nodes.where("n_children <> 1 or n_ends > 0").select("a", "b", "n")
    way = _looked_up(rows.select("conv", "depth", "a", "b", "upto"), kept, ["a", "b"], "n", total, heavy)
    whole = way.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "a", "b", "upto"))).alias("way"))
    same = whole.groupBy("way").agg(F.count(F.lit(1)).alias("members"))
    zero = F.lit(0).cast("long")

    def load(e: Column, i: Column) -> Column:
        last = i == F.size("way") - 1
        return F.struct(e["upto"].alias("upto"), F.when(last, F.col("members")).otherwise(zero).alias("members"),
                        zero.alias("leaves"), zero.alias("saved"), F.when(last, zero).otherwise(F.lit(1).cast("long")).alias("inner"))

    return same.select(F.transform("way", lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b"))).alias("path"),
                       F.transform("way", load).alias("load"))


def list_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(a, b, ends_sha256): SHA-256 of the conversations that end at each node,
    in ascending order with commas between."""
    with_package(ends.sparkSession)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one node's sorted conversations as text, a piece at a time."""
        key, texts, size = None, [], 0

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([key[0]]), pa.array([key[1]]), pa.array([int(texts[0])], pa.int64()),
                                    pa.array([",".join(texts).encode()], pa.binary())], names=["a", "b", "first", "text"])

        for batch in batches:
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if texts and ((a, b) != key or size >= piece):
                    yield out()
                    texts, size = [], 0
                key = (a, b)
                texts.append(str(conv))
                size += len(texts[-1]) + 1
        if texts:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, rows = None, None, []
        for batch in batches:
            for a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) == key:
                    sha.update(b",")
                else:
                    if key:
                        rows.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256()
                sha.update(text)
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["a", "b", "ends_sha256"])
                rows = []
        if key:
            yield pa.record_batch([pa.array([c]) for c in (*key, sha.hexdigest())], names=["a", "b", "ends_sha256"])

    pieces = (ends.select("a", "b", "conv").repartitionByRange("a", "b", "conv").sortWithinPartitions("a", "b", "conv")
              .mapInArrow(joined, "a long, b long, first long, text binary"))
    return (pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").select("a", "b", "text")
            .mapInArrow(hashed, "a long, b long, ends_sha256 string"))


def carried_up(nodes: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """Nodes of a chain with the ``sums`` of the node at its lower end.  All of a
    chain have the same members, so the same ``conv_id``."""
    nodes = nodes.withColumn("block", F.expr(f"depth div {block}"))
    up = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = nodes.withColumn("low", F.last("sums", ignorenulls=True).over(up))
    if longest >= block:  # the lower end may lie in a later block
        tops = nodes.groupBy("conv_id", "block").agg(F.min_by("sums", F.when(F.col("sums").isNotNull(), F.col("depth"))).alias("sums"))
        later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
        nearest = tops.select("conv_id", "block", F.last("sums", ignorenulls=True).over(later).alias("next"))
        got = got.join(nearest, ["conv_id", "block"]).withColumn("low", F.coalesce("low", "next")).drop("next")
    return got


def prefix_trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block: int = BLOCK, shard_paths: int = SHARD_PATHS,
                shard_nodes: int = SHARD_NODES, heavy: int = HEAVY, piece: int = PIECE, group: int = GROUP, most: int = TURNS,
                **cols: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: smallest member, depth,
    parent's smallest member, members, children, leaves, saved code points, and the
    digest of the conversations that end there."""
    turns, parts = numbered_turns(conversations, block_rows, **cols)
    built, convs = rebuilt(turns, parts, group, most)
    rows, longest = prefixes(built, convs, block)
    nodes = trie_nodes(rows)
    total = rows.count()
    sums = subtree_sums(paths_of(rows, nodes, total, heavy), shard_paths, shard_nodes)
    known = nodes.join(sums, ["a", "b"], "left").withColumn(
        "sums", F.when(F.col("below").isNotNull(), F.struct("n_convs", "n_leaves", "below", F.col("upto").alias("end"))))
    low = F.col("low")
    full = carried_up(known.select(*nodes.columns, "sums"), longest, block).select(
        "a", "b", "up_a", "up_b", "conv_id", "depth", low["n_convs"].alias("n_convs"), "n_children", low["n_leaves"].alias("n_leaves"),
        (low["below"] + (low["n_convs"] - 1) * (low["end"] - F.col("upto") + F.col("chars"))).alias("saved_tokens"))
    digests = list_digests(rows.where("ends"), piece)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    full = stored(full.join(digests, ["a", "b"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)), "trie")
    parents = full.where("n_children > 0").select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), "n_children",
                                                  F.col("conv_id").alias("parent_conv_id"))
    named = _looked_up(full.where("depth > 0"), parents, ["up_a", "up_b"], "n_children", total, heavy)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return named.select(*out).union(root.select(*out))
