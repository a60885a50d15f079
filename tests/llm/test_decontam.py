import hashlib
import re

from pitchhouse.llm import decontam

from tests.llm.conftest import SCHEMA, prose, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text) -> list:
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items: list) -> tuple:
    w = words(text)
    hit, ids = set(), set()
    for item, t in items:
        v = words(t)
        k = min(10, len(v))
        if not k:
            continue
        wins = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                ids |= {item} - {None}
    listed = ",".join(sorted(map(str, ids)))
    return len(w), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


ITEMS = [(1, prose(700, 25)), (2, "Four WORDS only here"), (3, prose(701, 10)), (10, prose(702, 60)), (11, ""), (12, None),
         (13, "..."), (13, prose(703, 12)), (None, prose(704, 14)), (20, "漢字 ünï ÉÉ x1 ok"), (21, "a a a a a a a a a a a a")]


def planted() -> list:
    i = dict((k, v) for k, v in ITEMS if v and len(v) > 8)
    half = " ".join(words(i[10])[20:33])
    return [prose(1, 50), prose(2, 30) + " " + i[1] + " " + prose(3, 40), "x " + i[3].upper().replace(" ", "--"), half + " tail",
            " ".join(words(i[10])[:9]), "say: four, words! ONLY here.", i[None], "a " * 30, None, "", "漢字 ünï ÉÉ x1 ok", "漢字 ünï éé x1 ok",
            i[1] + i[3] + " " + i[10], prose(5, 4000) + " " + i[3] + " " + prose(6, 4000)]


def test_against_brute_force(spark):
    texts = planted()
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block_words in (20, 500_000):
        got = decontam.digest(decontam.contamination(docs, bench, block_words=block_words)).collect()
        assert len(got) == len(texts)
        for r in got:
            assert tuple(r)[1:] == brute(texts[r.doc_id], ITEMS), texts[r.doc_id]


def test_clean_documents_stay_whole(spark):
    texts = planted()
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    left = decontam.decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert left.columns == docs.columns
    want = [r for r in rows_of(texts) if not brute(r[1], ITEMS)[-1]]
    assert sorted(tuple(r) for r in left.collect()) == want


def test_a_broadcast_holds_a_bounded_part_of_the_benchmark(spark, monkeypatch):
    """Every block its own group: results as from all blocks at once, repeated rows kept."""
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    monkeypatch.setattr(decontam, "SENT_BYTES", 1, raising=False)
    texts = planted() + [ITEMS[0][1] + " " + ITEMS[3][1] + " ~ " + ITEMS[7][1]]
    rows = rows_of(texts) + [rows_of(texts)[-1]] * 2 + [(None, *rows_of(texts)[1][1:])] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    got = decontam.contamination(docs, bench, block_words=20)
    found = decontam.digest(got).collect()
    assert sum(isinstance(v, list) for v in sent) > 3 and all(len(v) == 1 for v in sent if isinstance(v, list))
    by = {r[0]: r[1] for r in rows}
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, found), key=order) == sorted([(r[0], *brute(by[r[0]], ITEMS)) for r in rows], key=order)
    assert all(a.stop < b.start for r in got.collect() for a, b in zip(r.spans, r.spans[1:]))
    left = decontam.decontaminate(docs, bench, block_words=20)
    assert left.columns == docs.columns
    want = [r for r in rows if not brute(r[1], ITEMS)[-1]]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(want, key=repr)
    once = decontam.longest_matches(docs, bench, block_words=20).collect()
    monkeypatch.setattr(decontam, "SENT_BYTES", 1 << 20, raising=False)
    key = lambda r: (r.item_id is None, r.item_id or 0, r.length)
    assert sorted(once, key=key) == sorted(decontam.longest_matches(docs, bench, block_words=20).collect(), key=key)


def test_longest_matches(spark):
    docs = spark.createDataFrame(rows_of([prose(5, 30) + " " + " ".join(words(ITEMS[3][1])[5:25]) + " zz"]), SCHEMA)
    bench = spark.createDataFrame([ITEMS[3]], "item_id long, text string")
    r = decontam.longest_matches(docs, bench).first()
    assert (r.item_id, r.length, r.item_start, r.doc_id, r.doc_start) == (10, 20, 5, 0, 30)


def test_odd_and_empty_tables(spark, odd, nothing):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = bench.where("false")
    assert decontam.contamination(nothing, bench).collect() == []
    assert not any(r.contaminated for r in decontam.digest(decontam.contamination(odd, none)).collect())
    assert decontam.decontaminate(odd, bench).count() == 5
