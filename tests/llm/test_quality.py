import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from pitchhouse.llm import quality

from tests.llm.conftest import SCHEMA, prose, rows_of


def junk(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["click HERE!!", "$$$ 999", "buy now | buy now", "#### @@@"]) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    """Good prose and junk of all lengths, half of it with a good head."""
    rows, labels = [], []
    for i in range(400):
        good = i % 2
        text = prose(i, 20 + i % 150) if good else (prose(i, 20) if i % 4 else "") + " " + junk(i, 20 + i % 80)
        rows.append((i, text, "en", "web", len(text), i))
        labels.append((i, good, 0))
    return (spark.createDataFrame(rows, SCHEMA).repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    got = quality.quality_scores(docs, quality.train(docs, labels)).collect()
    assert len(got) == 400
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.9


def test_held_out_labels_are_not_learned_from(spark, labelled):
    docs, labels = labelled
    wrong = labels.select("doc_id", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality"))
                          .otherwise(quality.F.col("quality")).alias("quality"), "toxic")
    a, b = quality.train(docs, labels), quality.train(docs, wrong)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_a_label_of_long_documents_or_of_few_known_ids_is_learned(spark):
    """Every good text above 65,536 characters; most good labels of ids that are not in docs."""
    rows = [(i, prose(i, 12_000) if i % 10 == 0 else junk(i, 30 + i), "en", "web", 0, i) for i in range(60)]
    assert min(len(r[1]) for r in rows if r[0] % 10 == 0) > 65_536
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = [(r[0], int(r[0] % 10 == 0), 0) for r in rows]
    wide = labels + [(i, 1, 0) for i in range(1000, 1400)]
    for known, per_label in ((labels, 1200), (wide, 5)):
        model = quality.train(docs, spark.createDataFrame(known, "doc_id long, quality int, toxic int"), per_label=per_label)
        assert "share" not in model
        p = quality.scores(model, [r[1] for r in rows])
        assert np.mean(p[::10]) > np.mean(np.delete(p, slice(None, None, 10))) + 0.2


def test_the_sample_is_bounded_by_passages(labelled, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, owner, y, weight: seen.append((len(x), y)) or {})
    for most, per_label in ((1, 1200), (20, 1200), (10 ** 6, 7)):
        quality.train(*labelled, per_label=per_label, most=most)
    assert [sorted(y.tolist()) for _, y in seen][::2] == [[0.0, 1.0], [0.0] * 7 + [1.0] * 7]
    assert 40 <= seen[1][0] < 40 + 2 * 20 and set(seen[1][1]) == {0.0, 1.0}


def test_a_score_depends_on_the_text_alone(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    texts = [prose(1, 10), junk(1, 10), "", prose(2, 3000), "é" * 2000]
    together = quality.scores(model, texts)
    assert np.allclose(together, [quality.scores(model, [t])[0] for t in texts], atol=1e-5)


def test_attention_gradients():
    """The back-propagated step lowers the loss on a separable toy set."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 20)).astype(np.float32)
    owner = np.repeat(np.arange(100), 3)
    y = (x[::3, 0] > 0).astype(np.float32)
    x[::3, 0] *= 5
    model = quality.fit(x.copy(), owner, y, np.ones(100, np.float32) / 100, epochs=80)
    p = quality._attend(model, quality._encoded(model, x), owner, np.arange(0, 300, 3))[-1]
    assert np.mean((p > 0.5) == (y > 0.5)) > 0.95


def test_keep_good_returns_whole_rows(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    kept = quality.keep_good(docs, model)
    want = {r.doc_id for r in quality.quality_scores(docs, model).collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_odd_and_empty_tables(spark, odd, nothing, labelled):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(nothing, none)
    assert quality.quality_scores(nothing, model).collect() == []
    assert quality.quality_scores(odd, model).count() == 5 and quality.keep_good(odd, model).count() == 5
    model = quality.train(*labelled)
    assert all(r.score is not None for r in quality.quality_scores(odd, model).collect())
    nulls = spark.createDataFrame([(None, None, None), (3, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(odd, nulls) == {"share": 1.0}
    assert quality.train(nothing, labelled[1])["share"] == pytest.approx(0.5, abs=0.1)
    assert quality.train(*labelled).keys() == model.keys() and rows_of([])== []


def _plain_score(m: dict, text: str) -> float:
    """Features, gated attention and score of one text, a passage and a feature at a time."""
    raw = text.encode()
    h, weights = [], []
    for at in range(0, max(1, len(raw)), quality.PASSAGE):
        p = raw[at:at + quality.PASSAGE]
        pairs, triples, kinds, seen, again = [0] * quality.PAIRS, [0] * quality.TRIPLES, [0] * quality.KINDS, set(), 0
        for i, b in enumerate(p):
            for k in range(quality.KINDS):
                kinds[k] += quality.KIND[b][k]
            if i >= 1:
                code = p[i - 1] * 257 + b
                pairs[(code * 2654435761 % 2**32 >> 24) % quality.PAIRS] += 1
            if i >= 2:
                code = (p[i - 2] * 257 + p[i - 1]) * 263 + b
                triples[(code * 2654435761 % 2**32 >> 24) % quality.TRIPLES] += 1
                again += p[i - 2:i + 1] in seen
                seen.add(p[i - 2:i + 1])
        n = max(1, len(p))
        x = [(c / (n + quality.SMOOTH)) ** 0.5 for c in pairs + triples] + [c / n for c in kinds] + [again / (n + quality.SMOOTH)]
        hidden = [math.tanh(sum(v * float(w) for v, w in zip(x, m["E"][:, j])) + float(m["e"][j])) for j in range(quality.WIDTH)]
        gate = 0.0
        for j in range(quality.GATE):
            v = sum(a * float(w) for a, w in zip(hidden, m["V"][:, j]))
            u = sum(a * float(w) for a, w in zip(hidden, m["U"][:, j]))
            gate += float(m["w"][j]) * math.tanh(v) / (1 + math.exp(-u))
        h.append(hidden)
        weights.append(math.exp(gate))
    z = [sum(w * x[j] for w, x in zip(weights, h)) / sum(weights) for j in range(quality.WIDTH)]
    return 1 / (1 + math.exp(-sum(a * float(c) for a, c in zip(z, m["c"])) - float(m["b"][0])))


def _some_model() -> dict:
    rng = np.random.default_rng(3)
    d = quality.PAIRS + quality.TRIPLES + quality.KINDS + 1
    shapes = {"E": (d, quality.WIDTH), "e": quality.WIDTH, "V": (quality.WIDTH, quality.GATE), "U": (quality.WIDTH, quality.GATE),
              "w": quality.GATE, "c": quality.WIDTH, "b": 1}
    return {k: rng.normal(0, 0.5, v).astype(np.float32) for k, v in shapes.items()}


def test_scores_against_loops(monkeypatch):
    model = _some_model()
    texts = ["", "a", "ab", "The same words. " * 90, "é漢字😀 x\n" * 100, "x" * quality.PASSAGE, "y1#" * 700]
    want = [_plain_score(model, t) for t in texts]
    for step in (quality.PASSAGE, 3 * quality.PASSAGE, quality.STEP):
        monkeypatch.setattr(quality, "STEP", step)
        np.testing.assert_allclose(quality.scores(model, texts), want, atol=2e-5)
    assert len(quality.scores(model, [])) == 0


def test_memory_of_a_very_long_text():
    text = "".join(f"word{i % 977} " for i in range(1_200_000))
    tracemalloc.start()
    quality.scores(_some_model(), [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(text) + (64 << 20), peak / len(text)
