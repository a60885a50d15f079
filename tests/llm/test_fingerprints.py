import hashlib

import numpy as np

from pitchhouse.llm import fingerprints as fp

from tests.llm.conftest import SCHEMA, prose, rows_of


def one(text: str) -> str:
    return fp.fingerprints([text])[0].tobytes().hex()


def test_edited_against_brute_force(docs, texts):
    got = {r.doc_id: r for r in fp.edited(docs).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        t, after = texts[i] or "", texts[i - 1 if i else len(texts) - 1] or ""
        h = len(t) // 2
        changed = t[:len(t) - h] + after[:h]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == one(t) and r.edited_fingerprint == one(changed)
        a, b, c = (fp.fingerprints([x]) for x in (t, changed, after))
        assert r.near_edited == fp.likeness(a, b)[0] and r.near_next == fp.likeness(a, c)[0]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_a_text_is_like_its_edit_and_unlike_others():
    texts = [prose(i, 300) for i in range(40)]
    prints = fp.fingerprints(texts)
    changed = fp.fingerprints([fp.edit(t, f) for t, f in zip(texts, texts[1:] + texts[:1])])
    near, other = fp.likeness(prints, changed), fp.likeness(prints, np.roll(prints, -1, axis=0))
    assert near.mean() > other.mean() + 0.15
    assert (fp.likeness(prints, prints) == 1).all()


def test_long_repetitive_texts_are_like_their_copies(spark):
    """Few distinct phrases on the upper levels, above and below 1,024 code points."""
    line = "the same short line\n"
    for text in ("A" * 1100, "ab" * 600, line * 60, "é" * 5000, "A" * 700, "A" * 1024, "A" * 1025):
        a = fp.fingerprints([text, text])
        assert fp.likeness(a[:1], a[1:])[0] == 1.0
        rows = {r.doc_id: r for r in fp.edited(spark.createDataFrame(rows_of([text, text]), SCHEMA)).collect()}
        assert rows[1].near_next == 1.0 and rows[0].near_next == 1.0
        assert (rows[1].near_edited == 1.0) == (fp.edit(text, text) == text)
    # a long text that keeps its repetitive half shares that half's phrases
    kept = fp.fingerprints(["ab" * 600, fp.edit("ab" * 600, "cd" * 600), line * 60, fp.edit(line * 60, "z" * 1200)])
    assert (fp.likeness(kept[::2], kept[1::2]) > 0).all()


def test_batches_change_nothing():
    texts = ["", "a", "aaaa", "abab" * 50, prose(1, 100), "漢字" * 30, prose(2, 3000), ""]
    assert [r.tobytes().hex() for r in fp.fingerprints(texts)] == [one(t) for t in texts]


def test_equal_substrings_share_interior_names_at_any_offset():
    middle = prose(77, 400)
    names = [np.frombuffer((p + middle).encode("utf-32-le"), np.uint32).astype(np.uint64) for p in ("", "xyz! ", prose(5, 11))]
    found = [set(fp._parse(n, np.zeros(len(n), np.int64), 0)[0].tolist()) for n in names]
    assert all(len(found[0] - f) <= 8 for f in found[1:])


def test_odd_and_empty_tables(spark, odd, nothing):
    assert fp.edited(nothing).collect() == [] and fp.document_fingerprints(nothing).collect() == []
    assert fp.edited(odd).count() == 5
    single = fp.edited(spark.createDataFrame(rows_of([prose(1, 50)]), SCHEMA)).first()
    assert single.near_next == 1.0
