import random

import xxhash

from pitchhouse.llm import simhash

from tests.llm.conftest import SCHEMA, rows_of


def fingerprint(text) -> int:
    words = (text or "").encode().lower().split()
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)] if k else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps: dict) -> dict:
    """Smallest reachable id of every id, from all pairs."""
    name = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if name[j] < name[i] and bin(fps[i] ^ fps[j]).count("1") <= 2:
                    name[i], changed = name[j], True
    return name


def test_against_all_pairs(docs, texts):
    want = {i: fingerprint(t) for i, t in enumerate(texts)}
    name = classes(want)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fingerprint == f"{want[r.doc_id]:016x}" and r.component_id == name[r.doc_id]


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (1 << 64) - 1 for m in simhash.masks()]
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(m & (1 << i | 1 << j) == 0 for m in masks)


def test_large_buckets_have_the_same_components(spark):
    """Fingerprints around a few centres: the star route equals all pairs."""
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            f = centre
            for _ in range(rng.randint(0, 3)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = dict(enumerate(sorted(fps)))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in fps.items()]
    nodes = spark.createDataFrame(rows, "node long, fp long")
    name = classes(fps)
    for bucket in (0, 3, 1000):
        found = {r.node: r.component for r in simhash.components(simhash.links(nodes, bucket=bucket)).collect()}
        assert {i: found.get(i, i) for i in fps} == name


def test_a_chain_of_links_is_one_component(spark):
    rows = [(i, (1 << (2 * i)) - 1 - (1 << 64 if 2 * i == 64 else 0)) for i in range(32)]
    found = simhash.components(simhash.links(spark.createDataFrame(rows, "node long, fp long"))).collect()
    assert {r.node for r in found} == set(range(32)) and {r.component for r in found} == {0}


def test_one_document_of_each_group_stays(docs, texts):
    name = classes({i: fingerprint(t) for i, t in enumerate(texts)})
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(name.values()))


def test_odd_and_empty_tables(spark, odd, nothing):
    assert simhash.near_duplicates(nothing).collect() == [] and simhash.drop_near_duplicates(nothing).collect() == []
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    assert got == {(None, 2), (1, 1), (2, 2)}
    only = spark.createDataFrame(rows_of([None]), SCHEMA)
    assert simhash.near_duplicates(only).first().fingerprint == "0" * 16


def test_one_row_stays_where_ids_repeat(spark):
    """Rows that share the surviving id, equal rows and rows without an id."""
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "A B c d e"), (None, "a b c d e"), (2, "other words stand here now"),
            (None, "one more text without any id"), (None, "one more text without any id"), (None, None), (3, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0, 0) for i, t in rows], SCHEMA)
    got = [(r.doc_id, (r.text or "").lower()) for r in simhash.drop_near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "a b c d e"), (2, "other words stand here now"),
                                           (None, "one more text without any id"), (3, "")], key=str)
