"""Operator 12: language of a text by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one is
filled up with byte 0).  Filters of several widths slide over a window, a filter's
greatest value in the window passes a rectifier, and a softmax layer gives the
languages' probabilities.  All layers are trained together in numpy (Adam), from
the documents' languages alone.  A document's logarithms of probabilities are
averaged over its windows by the letters in each, so every byte of it counts.

A filter of width w adds one weight for the byte at each of its w places.  To
apply them, the weights of two neighbouring places are added up beforehand for all
pairs of bytes; batches of windows are laid out by place, so one look-up and one
maximum handle a place of all windows.

The fit uses a bounded sample: of each language the first ``PER_LANGUAGE``
documents by a digest of the id, and of each of those at most ``PER_DOCUMENT``
windows, spread over the whole text (both are parameters).  The windows are cut in
tasks; only they reach the driver.  Neither language, source nor id is an input of
a prediction, and documents whose CRC-32 of the id leaves 0 when divided by 5, or
that have no id, are not learned from.

``und`` with score 0 goes to a text that is null or has no letter, and to all
where there is no language to learn.  With one language only, it has score 1.
Repeated rows each give a row.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import slices, stored, with_package

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 24
PER_LANGUAGE, PER_DOCUMENT = 400, 6
#: Windows that the network takes at a time; parts of a language's documents in which candidates are sought.
BATCH, PARTS = 2048, 32
UNKNOWN = "und"

_LETTER = np.zeros(256, np.float32)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1  # in UTF-8, other letters have bytes of 128 and more


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(windows as rows of bytes, the text of each); an empty text has one."""
    raws = [t.encode() for t in texts]
    n = np.array([max(1, -(-len(r) // WINDOW)) for r in raws], np.int64)
    whole = b"".join([r.ljust(k * WINDOW, b"\0") for r, k in zip(raws, n.tolist())])
    return np.frombuffer(whole, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), n)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def pooled(weights: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window and filter, the greatest value and its place."""
    best, place = [], []
    for w in WIDTHS:
        k = x.shape[1] - w + 1
        value = weights[f"W{w}"][0][x[:, :k]]
        for i in range(1, w):
            value += weights[f"W{w}"][i][x[:, i:i + k]]
        place.append(value.argmax(1))
        best.append(np.take_along_axis(value, place[-1][:, None], 1)[:, 0])
    return np.concatenate(best, 1), np.concatenate(place, 1)


def fit(x: np.ndarray, y: np.ndarray, languages: int, epochs: int = 8, rate: float = 4e-3, decay: float = 1e-4,
        batch: int = 64, seed: int = 11) -> dict:
    """Train the filters and the softmax layer on windows ``x`` of languages ``y``."""
    rng = np.random.default_rng(seed)
    m = {f"W{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    total = FILTERS * len(WIDTHS)
    m |= {"b": np.zeros(total, np.float32), "C": rng.normal(0, total ** -0.5, (total, languages)).astype(np.float32),
          "c": np.zeros(languages, np.float32)}
    s1 = {k: np.zeros_like(v) for k, v in m.items()}
    s2 = {k: np.zeros_like(v) for k, v in m.items()}
    step, column = 0, np.arange(FILTERS)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at:at + batch]
            xb = x[pick]
            best, place = pooled(m, xb)
            z = np.maximum(best + m["b"], 0)
            p = _softmax(z @ m["C"] + m["c"])
            p[np.arange(len(pick)), y[pick]] -= 1
            p /= len(pick)
            dz = (p @ m["C"].T) * (z > 0)
            grads = {"C": z.T @ p, "c": p.sum(0), "b": dz.sum(0)}
            for j, w in enumerate(WIDTHS):  # only the place of the maximum has a gradient
                part = slice(j * FILTERS, (j + 1) * FILTERS)
                g = np.zeros((w, 256, FILTERS), np.float32)
                for i in range(w):
                    seen = np.take_along_axis(xb, place[:, part] + i, 1)
                    np.add.at(g[i], (seen, column[None, :]), dz[:, part])
                grads[f"W{w}"] = g
            step += 1
            pace = rate * (1 - epoch / epochs)
            for k, v in grads.items():
                v = v + decay * m[k]
                s1[k] = 0.9 * s1[k] + 0.1 * v
                s2[k] = 0.999 * s2[k] + 0.001 * v * v
                m[k] = (m[k] - pace * (s1[k] / (1 - 0.9 ** step)) / (np.sqrt(s2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return m


class Network:
    """The trained network with its weights of pairs of bytes."""

    def __init__(self, model: dict):
        self.model, self.steps = model, []
        for w in WIDTHS:
            weights = model[f"W{w}"]
            steps = []
            for i in range(0, w - 1, 2):
                steps.append((i, True, (weights[i][:, None] + weights[i + 1][None, :]).reshape(1 << 16, FILTERS)))
            if w % 2:
                steps.append((w - 1, False, np.ascontiguousarray(weights[w - 1])))
            self.steps.append(steps)

    def logs(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the languages' probabilities in each window."""
        m, out = self.model, []
        for at in range(0, len(x), BATCH):
            single = np.ascontiguousarray(x[at:at + BATCH].T).astype(np.intp)  # a row for each place
            pair = (single[:-1] << 8) + single[1:]
            n = single.shape[1]
            z = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
            value, more = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
            for j, (w, steps) in enumerate(zip(WIDTHS, self.steps)):
                best = np.full((n, FILTERS), -np.inf, np.float32)
                for t in range(single.shape[0] - w + 1):
                    i, two, table = steps[0]
                    np.take(table, (pair if two else single)[t + i], axis=0, out=value, mode="clip")
                    for i, two, table in steps[1:]:
                        np.take(table, (pair if two else single)[t + i], axis=0, out=more, mode="clip")
                        np.add(value, more, out=value)
                    np.maximum(best, value, out=best)
                z[:, j * FILTERS:(j + 1) * FILTERS] = best
            p = _softmax(np.maximum(z + m["b"], 0) @ m["C"] + m["c"])
            out.append(np.log(np.maximum(p, 1e-12)))
        return np.concatenate(out)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the likeliest language of each text by number, its probability)."""
        x, owner = windows(texts)
        total = np.zeros((len(texts), len(self.model["c"])))
        weight = np.zeros(len(texts))
        for at in range(0, len(x), BATCH):
            part = x[at:at + BATCH]
            letters = _LETTER[part].sum(1)
            np.add.at(total, owner[at:at + BATCH], self.logs(part) * letters[:, None])
            np.add.at(weight, owner[at:at + BATCH], letters)
        p = _softmax(total / np.maximum(weight, 1)[:, None])
        return p.argmax(1), p.max(1)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text is divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, per_document: int = PER_DOCUMENT, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict:
    """{"languages": their names, "network": weights} from a bounded sample."""
    with_package(docs.sparkSession)
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col)
    known = (docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & F.col(id_col).isNotNull() & ~held_out(doc_id)
                        & text.rlike(r"\p{L}"))
             .select(doc_id.alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text")))
    # the first by digest: of each of many parts of a language, and then of the language,
    # so that no task sorts more than a bounded number of one language's rows
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("tie")]
    some = known.select("doc_id", "lang", F.md5("text").alias("tie")).distinct().withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        turn = Window.partitionBy(*keys).orderBy(*order)
        some = some.withColumn("n", F.row_number().over(turn)).where(F.col("n") <= per_language)
    chosen = stored(some.select("doc_id", "lang", "tie"), "language-sample")
    # the broadcast has per_language rows of each language at most
    texts = known.withColumn("tie", F.md5("text")).join(F.broadcast(chosen), ["doc_id", "lang", "tie"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, some, part in slices(batches, 1):
            for d, t, lang in zip(ids, some, part.column(2).to_pylist()):
                x, _ = windows([t])
                at = np.unique(np.linspace(0, len(x) - 1, per_document).round().astype(int))
                yield pa.record_batch([pa.array([d] * len(at), pa.int64()), pa.array([lang] * len(at)), pa.array(at, pa.int64()),
                                       pa.array([x[i].tobytes() for i in at], pa.binary())], names=["doc_id", "lang", "i", "w"])

    # repeated rows give the same windows, which count once
    rows = (texts.select("doc_id", "text", "lang").mapInArrow(cut, "doc_id long, lang string, i long, w binary").distinct()
            .groupBy("lang").agg(F.array_sort(F.collect_list("w")).alias("w")).collect())
    languages = sorted(r.lang for r in rows)
    if len(languages) < 2:
        return {"languages": languages}
    by = {r.lang: r.w for r in rows}
    x = np.frombuffer(b"".join(w for k in languages for w in by[k]), np.uint8).reshape(-1, WINDOW)
    y = np.repeat(np.arange(len(languages)), [len(by[k]) for k in languages])
    return {"languages": languages, "network": fit(x, y, len(languages))}


def languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text."""
    with_package(docs.sparkSession)
    names = model["languages"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(model["network"]) if "network" in model else None
        for _, texts, part in slices(batches, 1):
            some = part.column(2).to_pylist()
            if network:
                which, p = network.predict(texts)
            else:
                which, p = np.zeros(len(texts), int), np.full(len(texts), 1.0)
            ok = [bool(s and names) for s in some]
            yield pa.record_batch([part.column(0), pa.array([names[k] if s else UNKNOWN for k, s in zip(which.tolist(), ok)]),
                                   pa.array([float(v) if s else 0.0 for v, s in zip(p, ok)])],
                                  names=["doc_id", "lang_pred", "score"])

    text = F.col(text_col)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))
