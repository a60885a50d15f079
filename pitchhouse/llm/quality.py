"""Operator 2: quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` bytes of its UTF-8 text each).
Every passage is encoded: hashed byte pairs and triples, and rates of character
kinds, go through a learned tanh layer.  Gated attention (Ilse, Tomczak, Welling,
"Attention-based Deep Multiple Instance Learning", 2018) weighs the passages,
w . (tanh(V h) * sigmoid(U h)) under a softmax over the bag, and a logistic unit
scores the weighted sum.  Encoder, attention and classifier are trained together
from document labels alone.

The fit uses a bounded sample: per label the first of the labelled documents in
``docs`` by a digest of the id, at most ``per_label`` of them and until they have
``most`` passages (both are parameters).  The one that reaches ``most`` is still
taken whole, so no length is left out and a label that is in ``docs`` is in the
fit; each label counts by its share of all labels.  Scoring reads every whole text, and
neither label, language, source nor id is an input of a score.

Null and empty texts are one passage without any byte and get a score.  Of
repeated labels of a document the lowest counts.  Without labels, or with one
value only, all documents score that value's share (1 without labels).  A very long
text is expanded ``STEP`` bytes at a time; what stays of it is ``WIDTH`` numbers a
passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import filtered, slices, stored, with_package

PASSAGE = 512
PAIRS, TRIPLES, KINDS = 256, 256, 12
#: Bytes added to a passage's length, so that a short one shows less of what it happens to hold.
SMOOTH = 48
WIDTH, GATE = 24, 12
#: Bytes of whole passages that are expanded to features at a time.
STEP = 1024 * PASSAGE
#: Documents and passages (1200 texts of 65,536 bytes) of each label that the fit uses.
PER_LABEL, MOST = 1200, 153_600
THRESHOLD = 0.7


def _kinds() -> np.ndarray:
    """For each byte, which of the character kinds it belongs to."""
    kinds = np.zeros((256, KINDS), np.float32)
    b = np.arange(256)
    for k, hit in enumerate(((b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57), b == 32, b == 10,
                             (b == 46) | (b == 44), np.isin(b, list(b"!?")), np.isin(b, list(b"#$%&*@^~")),
                             np.isin(b, list(b"|<>{}[]()/\\=+_-")), np.isin(b, list(b"\"':;`")), b >= 128,
                             (b < 32) & (b != 10))):
        kinds[hit, k] = 1
    return kinds


KIND = _kinds()


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, the text of each): counts of hashed pairs and
    triples under a square root, rates of character kinds, and the share of
    triples that the passage had before."""
    return _features([t.encode() for t in texts])


def _features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in raws], np.int64)
    n = np.maximum(1, -(-sizes // PASSAGE))
    owner = np.repeat(np.arange(len(raws)), n)
    total = int(n.sum())
    x = np.frombuffer(b"".join(raws), np.uint8)
    begin = np.cumsum(sizes) - sizes
    within = np.arange(len(x)) - np.repeat(begin, sizes)
    place = np.repeat(np.cumsum(n) - n, sizes) + within // PASSAGE
    a = x.astype(np.uint32)
    pair, triple = np.zeros(len(x), np.uint32), np.zeros(len(x), np.uint32)
    pair[1:] = a[:-1] * 257 + a[1:]
    triple[2:] = pair[1:-1] * 263 + a[2:]
    ok = within % PASSAGE
    out = np.empty((total, PAIRS + TRIPLES + KINDS + 1), np.float32)
    length = np.maximum(1, np.bincount(place, minlength=total))[:, None]
    for lo, width, code, least in ((0, PAIRS, pair, 1), (PAIRS, TRIPLES, triple, 2)):
        sel = ok >= least
        h = ((code[sel] * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64) % width
        got = np.bincount(place[sel] * width + h, minlength=total * width).reshape(total, width)
        out[:, lo:lo + width] = np.sqrt(got / (length + SMOOTH))
    bytes_of = np.bincount(place * 256 + x, minlength=total * 256).reshape(total, 256).astype(np.float32)
    out[:, PAIRS + TRIPLES:-1] = bytes_of @ KIND / length
    full = ok >= 2  # how much of the passage repeats: its triples less the distinct ones
    three = np.zeros(len(x), np.int64)
    three[2:] = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    key = np.sort((place[full] << 24) | three[full])
    repeats = np.bincount(key[1:][key[1:] == key[:-1]] >> 24, minlength=total)
    out[:, -1] = repeats / (length[:, 0] + SMOOTH)
    return out, owner


def _softmax(s: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    e = np.exp(s - np.maximum.reduceat(s, first)[owner])
    return e / np.add.reduceat(e, first)[owner]


def _encoded(m: dict, x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ m["E"] + m["e"])


def _attend(m: dict, h: np.ndarray, owner: np.ndarray, first: np.ndarray) -> tuple:
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    a = _softmax((t * g) @ m["w"], first, owner)
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return h, t, g, a, z, 1 / (1 + np.exp(-(z @ m["c"] + m["b"])))


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 60, rate: float = 5e-3,
        decay: float = 1e-4, bags: int = 128, seed: int = 7) -> dict:
    """Train all parameters by Adam on batches of whole bags; ``x`` is scaled in place."""
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-3
    x -= mean
    x /= std
    d = x.shape[1]
    m = {"E": rng.normal(0, d ** -0.5, (d, WIDTH)), "e": np.zeros(WIDTH), "V": rng.normal(0, 0.3, (WIDTH, GATE)),
         "U": rng.normal(0, 0.3, (WIDTH, GATE)), "w": rng.normal(0, 0.3, GATE), "c": np.zeros(WIDTH), "b": np.zeros(1)}
    m = {k: v.astype(np.float32) for k, v in m.items()}
    s1 = {k: np.zeros_like(v) for k, v in m.items()}
    s2 = {k: np.zeros_like(v) for k, v in m.items()}
    begin = np.searchsorted(owner, np.arange(len(y) + 1))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), bags):
            pick = order[at:at + bags]
            n = begin[pick + 1] - begin[pick]
            first = np.cumsum(n) - n
            own = np.repeat(np.arange(len(pick)), n)
            xb = x[np.repeat(begin[pick] - first, n) + np.arange(int(n.sum()))]
            h, t, g, a, z, p = _attend(m, _encoded(m, xb), own, first)
            dl = ((p - y[pick]) * weight[pick] / weight[pick].sum()).astype(np.float32)
            dz = dl[:, None] * m["c"]
            da = (dz[own] * h).sum(1)
            ds = a * (da - np.add.reduceat(a * da, first)[own])
            dt, dg = ds[:, None] * m["w"] * g * (1 - t * t), ds[:, None] * m["w"] * t * g * (1 - g)
            dh = a[:, None] * dz[own] + dt @ m["V"].T + dg @ m["U"].T
            du = dh * (1 - h * h)
            grads = {"E": xb.T @ du, "e": du.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds,
                     "c": z.T @ dl, "b": dl.sum(keepdims=True)}
            step += 1
            for k, v in grads.items():
                v = v + decay * m[k]
                s1[k] = 0.9 * s1[k] + 0.1 * v
                s2[k] = 0.999 * s2[k] + 0.001 * v * v
                m[k] = (m[k] - rate * (s1[k] / (1 - 0.9 ** step)) / (np.sqrt(s2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    # the scaling of the features goes into the first layer
    m["e"] = (m["e"] - (mean / std) @ m["E"]).astype(np.float32)
    m["E"] = (m["E"] / std[:, None]).astype(np.float32)
    return m


def scores(model: dict, texts: list[str]) -> np.ndarray:
    if "share" in model:
        return np.full(len(texts), model["share"])
    h, owner, held, whose = [], [], [], []

    def encode() -> None:
        x, piece = _features(held)
        h.append(_encoded(model, x))
        owner.append(np.array(whose)[piece])
        held.clear()
        whose.clear()

    for i, t in enumerate(texts):
        raw = t.encode()
        for k in range(0, max(1, len(raw)), STEP):  # no feature crosses a passage's end
            if held and sum(map(len, held)) + min(STEP, len(raw) - k) > STEP:
                encode()
            held.append(raw[k:k + STEP])
            whose.append(i)
    if held:
        encode()
    owner = np.concatenate(owner or [np.zeros(0, np.int64)])
    first = np.searchsorted(owner, np.arange(len(texts)))
    return _attend(model, np.concatenate(h), owner, first)[-1].astype(np.float64) if h else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 when divided by 4; those
    documents' labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, most: int = MOST,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """A model from a bounded sample: at most ``per_label`` documents of each
    label, until they have ``most`` passages, whose label may be learned from."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
             .where(~held_out(F.col("doc_id"))))
    share = dict(known.groupBy("y").count().collect())
    if len(share) < 2:
        return {"share": float(next(iter(share), 1))}
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .withColumn("tie", F.md5(F.coalesce("text", F.lit("")))))
    size = F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / PASSAGE))
    found = stored(texts.select("doc_id", "tie", size.alias("n")).join(known, "doc_id"), "quality-sample")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("tie")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # the window holds per_label rows
    first = [found.where(F.col("y") == y).orderBy(*order).limit(per_label)
             .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < most) for y in (0, 1)]
    picked = stored(first[0].union(first[1]).groupBy("doc_id", "tie", "y").agg(F.count(F.lit(1)).alias("times")), "quality-picked")
    # equal rows are fetched once and counted
    rows = texts.join(F.broadcast(picked), ["doc_id", "tie"]).groupBy("doc_id", "tie", "y", "times").agg(F.first("text").alias("text"))
    sample = [r for r in sorted(rows.collect(), key=lambda r: (r.y, r.doc_id, r.tie)) for _ in range(r.times)]
    if len({r.y for r in sample}) < 2:
        return {"share": share.get(1, 0) / sum(share.values())}
    parts = [passages([r.text or ""]) for r in sample]
    x = np.concatenate([p for p, _ in parts])
    owner = np.repeat(np.arange(len(parts)), [len(p) for p, _ in parts])
    y = np.array([r.y for r in sample], np.float32)
    n = np.bincount(y.astype(int), minlength=2)
    weight = np.array([share[int(v)] / sum(share.values()) / n[int(v)] for v in y], np.float32)
    return fit(x, owner, y, weight)


def quality_scores(docs: DataFrame, model: dict, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    with_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, part in slices(batches, 1, 1 << 20):
            yield pa.record_batch([part.column(0), pa.array(scores(model, texts))], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")))


def keep_good(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    with_package(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.record_batch([batch.column(at), batch.column(at)], names=["id", "text"])
            got = [scores(model, texts) for _, texts, _ in slices(iter([flat]), 1, 1 << 20)]
            if got:
                yield batch.filter(pa.array(np.concatenate(got) >= threshold))

    return filtered(docs, run)
