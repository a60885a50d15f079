import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pitchhouse.llm import suffixes

from tests.llm.conftest import SCHEMA, prose, rows_of


def brute(texts: list, width: int) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - width + 1):
            if seen[r[i:i + width]] > 1:
                gone[i:i + width] = True
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [0, 2, suffixes.HOT])
def test_against_brute_force(docs, texts, hot):
    want = brute(texts, 200)
    got = suffixes.digest(suffixes.remove_repeats(docs, hot=hot)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


@pytest.mark.parametrize("hot", [0, suffixes.HOT])
def test_random_binary_like_texts(spark, hot):
    """Few symbols, many overlaps, repeats inside a text and a string that is its own neighbour."""
    rng = random.Random(11)
    part = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(6)]
    texts = ["".join(rng.choice(part) for _ in range(rng.randint(1, 12))) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
             for _ in range(60)] + ["a" * 90, "a" * 31, "ab" * 40, "é" * 50]
    want = brute(texts, 32)
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4)
    for r in suffixes.digest(suffixes.remove_repeats(docs, width=32, core=12, hot=hot)).collect():
        assert tuple(r)[1:] == want[r.doc_id], texts[r.doc_id]


def test_column_wise_construction_finds_all_repeats():
    rng = random.Random(3)
    for width in (1, 3, 8, 300):
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 60))) for _ in range(20)] + [b"", b"a" * 400, b"a" * 350]
        seen = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
        for t, got in zip(texts, suffixes.repeated_starts(texts, width)):
            assert got.tolist() == [i for i in range(len(t) - width + 1) if seen[t[i:i + width]] > 1]


def test_kept_text_and_spans(spark):
    shared = prose(50, 60)
    texts = ["left " + shared + " right", shared]
    rows = {r.doc_id: r for r in suffixes.remove_repeats(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert bytes(rows[0].kept) == b"left  right" and bytes(rows[1].kept) == b""
    assert [(s.a, s.b) for s in rows[0].spans] == [(5, 5 + len(shared))]


def test_odd_and_empty_tables(spark, odd, nothing):
    assert suffixes.remove_repeats(nothing).collect() == []
    assert sorted(r.n_bytes for r in suffixes.remove_repeats(odd).collect()) == [0, 0, 0, 15, 15]
    twice = spark.createDataFrame([(None, "x" * 250, None, None, None, None)] * 2, SCHEMA)
    assert [(r.doc_id, r.n_removed) for r in suffixes.digest(suffixes.remove_repeats(twice)).collect()] == [(None, 250)] * 2
