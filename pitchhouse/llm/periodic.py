"""Operator 13: runs of periodic words by a suffix automaton with link-cut access.

The words of a stretch of text are appended to a suffix automaton.  Its suffix
links are a tree, kept as preferred paths in splay trees (link-cut access).  Word
i accesses the state of its prefix: the way to the root falls into segments of one
colour, and the colour t is where the strings of that segment ended last.  The
longest of them has the length M up to which the prefixes of t and i agree from
the right, so at distance p = i - t the last M + p words repeat with period p.
Where M is exactly p, a square of a primitive word stands there that no word to
the left extends: every run shows once, at its leftmost square, and is extended to
the right from there.  Then the whole way takes the colour i.  Segments number
O(n log n) over all words.

Which stretches: in a run of at least ``LEAST`` = 12 words and two periods, six
or more words in a row come again a period later, and such groups of six (and
their copies) cover the whole run.  Words that no repeated group of six covers cut
a text into stretches, again until nothing more is cut.  A run lies in one
stretch, so most texts need no automaton.  Groups are compared by a hash, which can
only leave a stretch too much; inside a stretch words are told apart by their bytes.

A task takes a few megabytes of text at a time; a longer text is a piece of its
own whose words stay offsets into it.  No shuffle.  Memory of the automaton is
some fifty bytes a word of a stretch that is periodic throughout.

Null and empty texts, and those of white space, have no words and no runs.  A
null id turns no words round.  Repeated rows each give a row.  Only the id and the
text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import SLICE_BYTES, slices, with_package

#: Words of the shortest run; words in a row that every run repeats.
LEAST, GROUP = 12, 6
#: Words hashed or joined at a time in a long text.
STEP_WORDS = 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(GROUP, 0xD1342543DE82EF95, np.uint64))


class Automaton:
    """Suffix automaton of a sequence of numbers.  State 1 is the root, 0 is no
    state.  Of a state's edges one is kept in the arrays, others in ``wide``."""

    def __init__(self, items: list[int] | array):
        self.length, self.link = array("i", [0, 0]), array("i", [0, 0])
        self.word, self.to = array("i", [-1, -1]), array("i", [0, 0])
        self.wide: dict[int, dict[int, int]] = {}
        self.prefix = array("i")  # the state of every prefix
        length, link, word, to, wide = self.length, self.link, self.word, self.to, self.wide
        last = 1
        for c in items:
            cur = len(length)
            length.append(length[last] + 1)
            link.append(1)
            word.append(-1)
            to.append(0)
            p, q = last, 0
            while p:
                if word[p] == c:
                    q = to[p]
                    break
                if word[p] < 0:
                    word[p], to[p] = c, cur
                else:
                    more = wide.setdefault(p, {})
                    q = more.setdefault(c, cur)
                    if q != cur:
                        break
                    q = 0
                p = link[p]
            if q:
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    word.append(word[q])
                    to.append(to[q])
                    if q in wide:
                        wide[twin] = dict(wide[q])
                    while p:
                        if word[p] == c:
                            if to[p] != q:
                                break
                            to[p] = twin
                        elif wide[p][c] == q:
                            wide[p][c] = twin
                        else:
                            break
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
            self.prefix.append(cur)


def squares(items: list[int] | array) -> list[tuple[int, int]]:
    """(start, period) of the leftmost square of every run, of any length."""
    states = Automaton(items)
    length, prefix = states.length, states.prefix
    up = array("i", states.link)  # parent in the splay tree, or above the top of a path
    del states
    left, right, colour = (array("i", bytes(4 * len(up))) for _ in range(3))
    found = []
    for i, u in enumerate(prefix, 1):
        below = 0
        while u:
            # splay: u becomes the root of its path's tree and takes the path's colour
            y = up[u]
            if y and (left[y] == u or right[y] == u):
                while True:
                    z = up[y]
                    if not z or (left[z] != y and right[z] != y):  # y is the root
                        colour[u] = colour[y]
                        if left[y] == u:
                            x = left[y] = right[u]
                            right[u] = y
                        else:
                            x = right[y] = left[u]
                            left[u] = y
                        if x:
                            up[x] = y
                        up[y], up[u] = u, z
                        break
                    w = up[z]
                    top = not w or (left[w] != z and right[w] != z)
                    if top:
                        colour[u] = colour[z]
                    elif left[w] == z:
                        left[w] = u
                    else:
                        right[w] = u
                    if left[z] == y:
                        if left[y] == u:  # same side twice
                            x = left[z] = right[y]
                            if x:
                                up[x] = z
                            right[y] = z
                            up[z] = y
                            x = left[y] = right[u]
                            if x:
                                up[x] = y
                            right[u] = y
                            up[y] = u
                        else:
                            x = right[y] = left[u]
                            if x:
                                up[x] = y
                            x = left[z] = right[u]
                            if x:
                                up[x] = z
                            left[u], right[u] = y, z
                            up[y] = up[z] = u
                    elif right[y] == u:
                        x = right[z] = left[y]
                        if x:
                            up[x] = z
                        left[y] = z
                        up[z] = y
                        x = right[y] = left[u]
                        if x:
                            up[x] = y
                        left[u] = y
                        up[y] = u
                    else:
                        x = left[y] = right[u]
                        if x:
                            up[x] = y
                        x = right[z] = left[u]
                        if x:
                            up[x] = z
                        left[u], right[u] = z, y
                        up[y] = up[z] = u
                    up[u] = w
                    if top:
                        break
                    y = w
            t = colour[u]
            if t:
                x = right[u]
                if x:
                    colour[x] = t  # what hangs below leaves the path and keeps its colour
                if length[u] == i - t:
                    found.append((2 * t - i, i - t))
            right[u] = below
            below = u
            u = up[u]
        colour[below] = i
    return found


def extended(items: np.ndarray, start: int, period: int) -> int:
    """The length of the run whose leftmost square is given."""
    end, step = start + 2 * period, 16
    while end < len(items):
        a = items[end:end + step]
        same = a == items[end - period:end - period + len(a)]
        k = int(same.argmin())
        if not same[k]:
            return end + k - start
        end, step = end + len(a), 4 * step
    return end - start


def runs(items: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    out = []
    for start, period in squares(array("i", items.astype(np.int32).tobytes())):
        n = extended(items, start, period)
        if n >= least:
            out.append((start, n, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def stretches(hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the parts of the texts that may hold a run.  ``owner`` is
    the text of each word; words are given as 64-bit hashes."""
    n = len(hashes) - GROUP + 1
    if n <= 0:
        return []
    group = np.zeros(n, np.uint64)
    for k in range(GROUP):
        group += _mix(hashes[k:k + n]) * _POWERS[k]
    at = np.flatnonzero(owner[:n] == owner[GROUP - 1:])
    part = owner[at].astype(np.uint64)
    while len(at):
        key = _mix(group[at] + _mix(part + np.uint64(1)) * _ODD)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        done = again.all()
        at = at[again]
        cut = (np.diff(at) > GROUP) | (owner[at[1:]] != owner[at[:-1]])
        part = np.cumsum(np.append(0, cut)).astype(np.uint64) if len(at) else part[:0]
        if done:
            break
    if not len(at):
        return []
    first = np.append(0, np.flatnonzero(cut) + 1)
    begin, end = at[first], at[np.append(first[1:] - 1, len(at) - 1)] + GROUP
    return [(int(a), int(b)) for a, b in zip(begin, end) if b - a >= LEAST]


class Words:
    """The words of a text as bytes; those of a long one stay offsets into it."""

    def __init__(self, text: str, long: int = SLICE_BYTES):
        raw = text.encode()
        self.list = raw.split() if len(raw) <= long else None
        if self.list is None:
            b = np.frombuffer(raw, np.uint8)
            edge = np.empty(len(b) + 1, bool)
            inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
            edge[1:-1] = inside[1:] != inside[:-1]
            edge[0], edge[-1] = inside[:1].any(), inside[-1:].any()
            at = np.flatnonzero(edge).astype(np.int32 if len(b) < 1 << 31 else np.int64)
            self.raw, self.begin, self.end = raw, at[::2], at[1::2]
        self.n = len(self.list) if self.list is not None else len(self.begin)

    def take(self, places: np.ndarray | slice) -> list[bytes]:
        if self.list is not None:
            return self.list[places] if isinstance(places, slice) else [self.list[i] for i in places.tolist()]
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.begin[places].tolist(), self.end[places].tolist())]

    def hashes(self) -> np.ndarray:
        out = np.empty(self.n, np.int64)
        for i in range(0, self.n, STEP_WORDS):
            part = self.take(slice(i, i + STEP_WORDS))
            out[i:i + len(part)] = np.fromiter(map(hash, part), np.int64, len(part))
        return out.view(np.uint64)

    def numbers(self, places: np.ndarray) -> np.ndarray:
        """A number for each of these words, the same for equal words only."""
        seen: dict[bytes, int] = {}
        out = np.empty(len(places), np.int32)
        for i in range(0, len(places), STEP_WORDS):
            part = self.take(places[i:i + STEP_WORDS])
            out[i:i + len(part)] = [seen.setdefault(w, len(seen)) for w in part]
        return out

    def digest(self, places: np.ndarray | None) -> str:
        """SHA-256 of these words (all of them without ``places``), a space between."""
        if places is None and self.list is not None:
            return hashlib.sha256(b" ".join(self.list)).hexdigest()
        sha, n = hashlib.sha256(), self.n if places is None else len(places)
        for i in range(0, n, STEP_WORDS):
            part = self.take(slice(i, i + STEP_WORDS) if places is None else places[i:i + STEP_WORDS])
            sha.update((b" " if i else b"") + b" ".join(part))
        return sha.hexdigest()


def turned(n: int, key: int) -> np.ndarray | None:
    """Places that the words of a text take from itself, where the contract turns
    its end into a repeated one: for each word, the word that stands there."""
    g = key // 10
    if key % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def found_runs(texts: list[str], keys: list[int | None]) -> list[tuple[Words, np.ndarray | None, list[tuple[int, int, int]]]]:
    """For each text its words, the places it is turned into, and its runs."""
    words = [Words(t) for t in texts]
    places = [None if k is None else turned(w.n, k) for w, k in zip(words, keys)]
    hashed = [w.hashes() if p is None else w.hashes()[p] for w, p in zip(words, places)]
    sizes = np.array([len(h) for h in hashed], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    begins = np.cumsum(sizes) - sizes
    all_hashes = np.concatenate(hashed) if len(hashed) != 1 else hashed[0]
    del hashed
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(all_hashes, owner):
        d = int(owner[a])
        at = a - int(begins[d])
        span = np.arange(at, at + b - a)
        items = words[d].numbers(span if places[d] is None else places[d][span])
        out[d] += [(at + s, n, p) for s, n, p in runs(items)]
    return list(zip(words, places, out))


def kept_places(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that are in no run after its first period."""
    change = np.zeros(n + 1, np.int32)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", turn: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_sha256) of every whole text: its runs by
    start and period, and the SHA-256 of the text without what repeats in them.
    ``turn`` plants repeats first, in the way and the documents of the contract."""
    with_package(docs.sparkSession)
    schema = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, part in slices(batches, 1):
            keys = [zlib.crc32(str(d).encode()) if turn and d is not None else None for d in ids]
            sizes, rows, digests = [], [], []
            for words, places, found in found_runs(texts, keys):
                sizes.append(words.n)
                rows.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                if found:
                    kept = kept_places(words.n, found)
                    places = kept if places is None else places[kept]
                digests.append(words.digest(places))
            yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), pa.array(rows, schema),
                                   pa.array(digests, pa.string())],
                                  names=["doc_id", "n_words", "runs", "collapsed_sha256"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, _SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one (ties: least start, then period), and
    digests of all runs and of the collapsed text."""
    best = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
                        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                        .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    first = F.get(F.col("best"), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), first["start"].alias("start"),
                    first["length"].alias("length"), first["period"].alias("period"),
                    F.floor(first["length"] * 1000 / first["period"]).cast("long").alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256"))
