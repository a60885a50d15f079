import random
import zlib

import numpy as np
import pytest

from pitchhouse.llm import language
from pitchhouse.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n long"
SF = "/root/testdata/sf0.01"


def words_of(alphabet: str, seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def two(spark):
    """Texts of two alphabets as two languages."""
    rows = [(i, words_of("abcdefgh" if i % 2 else "mnopqrst", i), "xx" if i % 2 else "yy", "s", 0, 0) for i in range(160)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def model(two):
    return language.train(two)


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    found = language.languages(docs, language.train(docs)).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    assert sorted(r.doc_id for r in found) == sorted(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in truth[r.doc_id][1] or ""))
    held = [r for r in found if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97


def test_network_against_loops():
    """The batched network, and what the fit uses, against the definition."""
    rng = np.random.default_rng(4)
    m = {f"W{w}": rng.normal(0, 1, (w, 256, language.FILTERS)).astype(np.float32) for w in language.WIDTHS}
    total = language.FILTERS * len(language.WIDTHS)
    m |= {"b": rng.normal(0, 1, total).astype(np.float32), "C": rng.normal(0, 1, (total, 3)).astype(np.float32),
          "c": rng.normal(0, 1, 3).astype(np.float32)}
    texts = ["é漢 abc " * 50, "x", "", "Hello, World! " * 40]
    x, owner = language.windows(texts)
    assert owner.tolist() == [i for i, t in enumerate(texts) for _ in range(max(1, -(-len(t.encode()) // language.WINDOW)))]
    for i, t in enumerate(texts):
        assert x[owner == i].tobytes().rstrip(b"\0") == t.encode()
    plain = []
    for row in x:
        z = []
        for j, w in enumerate(language.WIDTHS):
            for f in range(language.FILTERS):
                top = max(sum(float(m[f"W{w}"][i][row[at + i]][f]) for i in range(w)) for at in range(len(row) - w + 1))
                z.append(max(0.0, top + float(m["b"][j * language.FILTERS + f])))
        logits = np.array(z) @ m["C"].astype(float) + m["c"]
        plain.append(logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
    best, _ = language.pooled(m, x)
    p = language._softmax(np.maximum(best + m["b"], 0) @ m["C"] + m["c"])
    plain = np.maximum(np.array(plain), np.log(1e-12))
    assert np.allclose(np.log(np.maximum(p, 1e-12)), plain, atol=2e-3)
    assert np.allclose(language.Network(m).logs(x), plain, atol=2e-3)


def test_fit_learns_a_planted_pattern():
    """A byte that stands in the windows of one language only is found."""
    rng = np.random.default_rng(1)
    x = rng.integers(97, 110, (40, language.WINDOW)).astype(np.uint8)
    y = rng.integers(0, 2, 40)
    x[y == 1, 10:20] = 120

    def loss(m: dict) -> float:
        best, _ = language.pooled(m, x)
        p = language._softmax(np.maximum(best + m["b"], 0) @ m["C"] + m["c"])
        return float(-np.log(p[np.arange(len(y)), y]).mean())

    early, late = language.fit(x, y, 2, epochs=1, batch=40), language.fit(x, y, 2, epochs=60, batch=8)
    assert loss(late) < 0.1 < loss(early)


def test_whole_texts_count(spark, model):
    """What stands at the end of a long text decides where most of it stands there."""
    head, tail = words_of("abcdefgh", 1, 300), words_of("mnopqrst", 2, 3000)
    df = spark.createDataFrame([(1, f"{head} {tail}", None, None, 0, 0), (2, f"{words_of('abcdefgh', 3, 3000)} {words_of('mnopqrst', 4, 300)}",
                                                                          None, None, 0, 0)], SCHEMA)
    assert {r.doc_id: r.lang_pred for r in language.languages(df, model).collect()} == {1: "yy", 2: "xx"}


def test_no_letters_null_and_repeated_rows(spark, model, odd, nothing):
    assert language.languages(nothing, model).collect() == []
    assert len(language.languages(odd, model).collect()) == odd.count()
    df = spark.createDataFrame([(1, None, "xx", "s", 0, 0), (2, "", "xx", "s", 0, 0), (3, " 12 ,;½ ", "xx", "s", 0, 0),
                                (4, "漢", "xx", "s", 0, 0), (4, "漢", "xx", "s", 0, 0), (None, "abc", None, None, 0, 0)], SCHEMA)
    got = sorted(((r.doc_id, r.lang_pred == "und", r.score) for r in language.languages(df, model).collect()), key=str)
    assert [(d, u) for d, u, _ in got] == [(1, True), (2, True), (3, True), (4, False), (4, False), (None, False)]
    assert all((s == 0) == u for _, u, s in got)


def test_learns_from_language_and_text_alone(spark, two, model):
    """Held-out rows, rows without id, text, language or letters teach nothing; repeats change nothing."""
    more = [(i, "zzzz " * 50, "zz", "s", 0, 0) for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    more += [(None, "zzzz", "zz", "s", 0, 0), (3, None, "zz", "s", 0, 0), (4, "zzz", None, "s", 0, 0), (6, "77", "zz", "s", 0, 0)]
    again = language.train(two.unionByName(two).unionByName(spark.createDataFrame(more, SCHEMA)))
    assert again["languages"] == model["languages"] == ["xx", "yy"]
    assert all((again["network"][k] == v).all() for k, v in model["network"].items())


def test_few_languages(spark, nothing, two):
    assert language.train(nothing) == {"languages": []}
    found = language.languages(two, language.train(nothing)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    one = language.train(two.where("lang = 'xx'"))
    assert one == {"languages": ["xx"]}
    assert {(r.lang_pred, r.score) for r in language.languages(two, one).collect()} == {("xx", 1.0)}


def test_sample_is_bounded(spark, two):
    small = language.train(two, per_language=3, per_document=1)
    assert small["languages"] == ["xx", "yy"]
