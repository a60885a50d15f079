"""The registered queries against their SQL, and the pipeline against its stages one by one."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pitchhouse.llm import decontam, mixing, quality, queries, simhash, simple8b, sql, tokens
from pitchhouse.llm.common import SLICE_BYTES, table, with_package

from tests.compare import diff

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_against_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(sql.oracle_sql()[name]).df()
    assert not diff(got, want, nullable_ints=True)


def test_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


def test_pipeline_against_its_stages(spark):
    """Each stage's rows from the operators' reports rather than their filters."""
    docs = table(spark, SF, "documents").toPandas()
    df = lambda p: spark.createDataFrame(p)
    base = df(docs)
    model = quality.train(base, table(spark, SF, "labels"))
    good = {r.doc_id for r in quality.quality_scores(base, model).collect() if r.predicted}
    docs = docs[docs.doc_id.isin(good)]
    named = {r.doc_id for r in simhash.near_duplicates(df(docs)).collect() if r.doc_id == r.component_id}
    docs = docs[docs.doc_id.isin(named)]
    hit = {r.doc_id for r in decontam.digest(decontam.contamination(df(docs), table(spark, SF, "benchmark"))).collect() if r.contaminated}
    docs = docs[~docs.doc_id.isin(hit)]
    times = {r.doc_id: r.copies for r in mixing.copies(df(docs)).collect()}
    docs = docs.loc[docs.index.repeat(docs.doc_id.map(times))]
    want = simple8b.token_files(df(docs), tokens.library_path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_the_columns(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


#: Names that the stages use for themselves, now or before, as columns of the table.
CLASHES = ["_gone", "_md5", "_n", "_k", "_i", "_id", "_tie", "_source", "_copies", "_rows", "row", "id", "md5", "tie", "n", "rows",
           "copies", "col", "source_size", "target", "size", "fp", "component_id", "alone", "none", "s", "node", "score", "block", "a.b", "x"]


def test_stages_leave_clashing_columns_alone(spark):
    """Every internal name as an extra column: each stage's rows come back with their own values."""
    rows = [(i, f"word{i} " * 3 + "some more words of a text " * (1 + i % 4), "en", f"s{i % 3}", 9, *[f"{c}-{i}" for c in CLASHES])
            for i in [*range(30), 5, 5]]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *CLASHES])
    bench = table(spark, SF, "benchmark")
    stages = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES[:-1]}
    stages["decontamination in groups"] = decontam.decontaminate(docs, bench, block_words=50)
    for name, out in stages.items():
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got or name == "quality classifier"
        assert {tuple(r) for r in got} <= set(rows), name


def test_python_tasks_are_given_batches_of_bounded_size(spark):
    """Rows of long texts: a batch is closed by its bytes, whatever the session had set."""
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["bytes"])

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    with_package(spark)
    long = spark.range(0, 40, 1, 1).select("id", F.repeat(F.lit("text "), 100_000).alias("text"))
    assert max(r.bytes for r in long.mapInArrow(sizes, "bytes long").collect()) <= 2 * SLICE_BYTES


def test_the_pipelines_encoder_keeps_fewer_words(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(corpus_pipeline.simple8b, "write_ids", lambda *a, **how: asked.update(how))
    monkeypatch.setattr(corpus_pipeline.simple8b, "read_ids", lambda *a: None)
    corpus_pipeline.token_id_output(spark, table(spark, SF, "documents"), SF)
    assert asked["keep"] < tokens.CACHE
