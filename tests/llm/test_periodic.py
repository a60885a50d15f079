import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchhouse.llm import periodic
from tests.llm.conftest import SCHEMA, rows_of


def plain_runs(w: list, least: int = periodic.LEAST) -> list:
    """Every maximal stretch of every period, those of a shorter period dropped."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, 2 * q):
                seg = w[i:i + n]
                if not any(seg[r:] == seg[:n - r] for r in range(1, q)):
                    out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text) -> tuple:
    """The contract, word by word."""
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def rows(df) -> list:
    found = periodic.digest(periodic.periodic_runs(df, turn=True))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.integers(1, 30))
def test_runs_against_every_period(w, p):
    for items in (w, [w[i % p] for i in range(len(w))]):
        got = periodic.runs(np.array(items, np.int32), 2)
        assert got == plain_runs(items, 2)
        text = " ".join(f"w{x}" for x in items)
        both = periodic.found_runs([text, "other words", text], [None] * 3)
        assert both[0][2] == both[2][2] == plain_runs(items)


def test_fibonacci_and_long_periods():
    a, b = "0", "01"
    while len(b) < 900:
        a, b = b, b + a
    word = [int(c) for c in b[:700]]
    assert periodic.runs(np.array(word, np.int32), 2) == plain_runs(word, 2)
    x = np.arange(50_000, dtype=np.int32) % 20_011
    assert periodic.runs(x) == [(0, 50_000, 20_011)]


def test_against_plain_python(spark, texts):
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(2)) for _ in range(9)]
    more = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    more += [" ".join([t] * 4) for t in more[:20]] + ["a " * 40, "a b 　c " * 30, "x\ty\nz\x0bq\x0c" * 20]
    given_rows = rows_of([t for t in [*texts, *more] if len(t or "") < 4000])
    df = spark.createDataFrame(given_rows, SCHEMA).repartition(4)
    assert rows(df) == sorted((plain_row(r[0], r[1]) for r in given_rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in given_rows)


def test_empty_null_and_repeated_rows(nothing, odd):
    assert rows(nothing) == []
    assert rows(odd) == sorted((plain_row(r.doc_id, r.text) for r in odd.collect()), key=str)


@pytest.mark.parametrize("text", ["", " ", "a", " a b\tc ", "é x\n" * 50, "　 a b  c " * 9, "one two three " * 30 + "four"])
def test_long_texts_keep_offsets(text):
    """A long text's words stay offsets into it: the same rows as a short one's."""
    a, b = periodic.Words(text), periodic.Words(text, long=-1)
    assert b.list is None and a.n == b.n
    every = np.arange(a.n)
    assert a.take(every) == b.take(every)
    assert (a.hashes() == b.hashes()).all()
    assert a.digest(None) == b.digest(None) == a.digest(every) == b.digest(every)
    assert a.digest(every[::2]) == b.digest(every[::2])


def test_long_text(spark):
    """Six megabytes in one text, periodic from its middle on."""
    rng = random.Random(9)
    head = [f"w{rng.randrange(10 ** 9)}" for _ in range(200_000)]
    tail = [f"t{i}" for i in range(150_003)] * 3
    df = spark.createDataFrame([(7, " ".join(head + tail), "en", "web", 0, 0)], SCHEMA)
    found = periodic.periodic_runs(df).collect()[0]
    assert [tuple(r) for r in found.runs] == [(200_000, 450_009, 150_003)]
    assert found.collapsed_sha256 == hashlib.sha256(" ".join(head + tail[:150_003]).encode()).hexdigest()
