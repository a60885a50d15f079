import re

import duckdb
import pytest

from pitchhouse.llm import mixing, sql

from tests.llm.conftest import SCHEMA, prose, rows_of


def goals(sizes: dict) -> dict:
    """Targets by the contract's rounds: stop sources above twice their size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            return stopped
        rest = left - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: 2.0 * sizes[s] for s in over}


def size_of(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("source", [lambda i: "hot" if i % 10 else f"s{i // 10}", lambda i: None if i % 2 else "a",
                                    lambda i: f"s{i % 7}", lambda i: "one"])
def test_targets_and_taken_words(spark, source):
    texts = [prose(i, 3 + i % 50) for i in range(300)] + [None, "", prose(4, 2)]
    rows = rows_of(texts, source)
    per: dict = {}
    for r in rows:
        per[r[3]] = per.get(r[3], 0) + size_of(r[1])
    want = goals(per)
    got = mixing.copies(spark.createDataFrame(rows, SCHEMA), block_rows=40).collect()
    assert len(got) == len(rows)
    taken = dict.fromkeys(per, 0)
    for r in got:
        assert r.size == size_of(texts[r.doc_id]) and r.source_size == per[r.source] and 0 <= r.copies <= 2
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.size * r.copies
    for s in per:
        assert abs(taken[s] - want[s]) <= 2 * max(size_of(r[1]) for r in rows if r[3] == s)


def test_reruns_and_partitionings_agree(docs):
    one, two = [sorted((r.doc_id, r.copies) for r in mixing.copies(d).collect()) for d in (docs, docs.repartition(9))]
    assert one == two


def test_block_size_changes_no_target(docs):
    """The digest blocks only split work: every block size meets the same targets."""
    totals = []
    for block_rows in (1, 7, 250_000):
        found = mixing.copies(docs, block_rows=block_rows).collect()
        totals.append(sorted({(r.source, r.target) for r in found}))
    assert totals[0] == totals[1] == totals[2]


def test_copies_equal_the_sql_at_every_block_size(spark):
    """Many sizes within one class, ids that do not follow the sizes, a null source and an empty text."""
    texts = [prose(i, 20 + i * 7 % 90) for i in range(160)] + ["", None, prose(9, 20)]
    documents = spark.createDataFrame(rows_of(texts, lambda i: (None, "a", "b", "b", "b")[i % 5]), SCHEMA)
    con = duckdb.connect()
    con.register("documents", documents.toArrow())
    want = sorted((r[0], r[1], r[4]) for r in con.execute(sql.MIX).fetchall())
    for block_rows in (1, 7, 250_000):
        got = mixing.copies(documents.repartition(5), block_rows=block_rows).collect()
        assert sorted((r.doc_id, r.size, r.size * r.copies) for r in got) == want


def test_equal_rows_take_places_next_to_each_other(spark):
    rows = rows_of([prose(1, 20)] * 50 + [prose(i, 30) for i in range(20)], lambda i: "a" if i < 60 else "b")
    rows = [(0, *r[1:]) if r[0] < 50 else r for r in rows]
    documents = spark.createDataFrame(rows, SCHEMA)
    found = [sorted((r.doc_id, r.copies) for r in mixing.copies(documents, block_rows=b).collect()) for b in (1, 250_000)]
    assert found[0] == found[1] and len(found[0]) == 70


def test_mixed_emits_the_copies_with_all_columns(docs):
    want = {r.doc_id: r.copies for r in mixing.copies(docs).collect() if r.copies}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got: dict = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want


def test_odd_and_empty_tables(odd, nothing):
    assert mixing.copies(nothing).collect() == [] and mixing.mixed(nothing).collect() == []
    found = mixing.copies(odd).collect()
    assert len(found) == 5 and sum(r.size for r in found) == 6
    assert mixing.mixed(odd).count() == sum(r.copies for r in found)


def test_no_python_in_the_plan(docs):
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan
