"""The pipeline against plain Python on a small table; only the classifier's decisions are taken as given."""

import hashlib
import math
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pitchhouse.llm import quality
from pitchhouse.llm.common import table

from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_decontam import ITEMS, brute
from tests.llm.test_mixing import goals, size_of
from tests.llm.test_quality import junk
from tests.llm.test_simhash import classes, fingerprint
from tests.llm.test_tokens import WORDS, library


def rows() -> list[tuple]:
    """Good and junk texts, near and exact copies, planted passages, repeated rows."""
    good = [prose(i, 60 + i % 90) for i in range(90)]
    items = [t for _, t in ITEMS if t and len(t) > 12]
    texts = good + [junk(i, 30 + i % 40) for i in range(40)]
    texts += [prose(500 + i, 500) for i in range(6)] + [prose(500 + i, 500).rsplit(" ", 1)[0] + " changed" for i in range(6)]
    texts += [good[3], good[3], good[7].upper(), None, "", "   "]
    texts += [good[10 + i] + " " + t + " " + good[20 + i] for i, t in enumerate(items)]
    # one window, and one word short of it
    texts += [" ".join(items[0].split()[5:5 + k]) + " " + prose(800 + k, 80) for k in (10, 9)]
    out = [(i, t, "en", ("web", "books", "web", None, "code")[i % 5], len(t or ""), i) for i, t in enumerate(texts)]
    return out + [out[20]] * 3 + [out[41]]


def brute_pipeline(docs: list[tuple], good: set) -> tuple[list[tuple], list[int]]:
    left = [len(docs)]
    docs = [r for r in docs if r[0] in good]
    left.append(len(docs))
    name = classes({r[0]: fingerprint(r[1]) for r in docs})
    docs = [r for r in docs if name[r[0]] == r[0]]
    left.append(len(docs))
    docs = [r for r in docs if not brute(r[1], ITEMS)[-1]]
    left.append(len(docs))
    per: dict = {}
    for r in docs:
        per[r[3]] = per.get(r[3], 0) + size_of(r[1])
    want, taken = goals(per), []
    for s in per:
        digest = hashlib.md5(("mix:" + ("\0null" if s is None else s)).encode()).hexdigest()
        u, rate = int(digest[:8], 16) / 2 ** 32, want[s] / per[s] if per[s] else 0.0
        mine = sorted((r for r in docs if r[3] == s), key=lambda r: (size_of(r[1]), r[0]))
        for place, r in enumerate(mine, 1):
            taken += [r] * min(2, math.floor(place * rate + u) - math.floor((place - 1) * rate + u))
    left.append(len(taken))
    out, start = [], 0
    for r in sorted(taken, key=lambda r: r[0]):
        ids = library(WORDS, r[1]) + [1]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, left


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("pipeline"))
    docs = rows()
    labels = [(i, int(not 90 <= i < 130), 0) for i in range(142)]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs


def test_run_against_plain_python(spark, planted):
    sf, docs = planted
    base = table(spark, sf, "documents")
    scored = quality.quality_scores(base, quality.train(base, table(spark, sf, "labels"))).collect()
    want, left = brute_pipeline(docs, {r.doc_id for r in scored if r.predicted})
    assert left[0] > left[1] > left[2] > left[3] > 0 and len(want) == left[4]  # every filter has work
    assert max([r[0] for r in want].count(i) for i in {r[0] for r in want}) > 1  # some are taken twice
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == want
