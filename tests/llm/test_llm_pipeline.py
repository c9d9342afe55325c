import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerlens.llm.queries import ORACLE, QUERIES
from ledgerlens.session import ARROW_BYTES, ARROW_LIMIT

SF = "/root/testdata/sf0.001"


def test_stages_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "near_duplicates", "packing"]
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    """The output of every stage over the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, SF)
        out.append((docs, df.cache()))
        docs = out[-1][1]
    return out


def test_filters_keep_the_columns_and_only_remove_rows(stages):
    for before, after in stages[:-1]:
        assert after.schema.fieldNames() == before.schema.fieldNames()
        assert after.exceptAll(before).count() == 0


def test_stages_match_brute_force(spark, stages):
    from test_llm_jaccard_join import expected as components
    from test_llm_quality import expected as quality

    docs = {r.doc_id: r.text for r in stages[0][0].collect()}
    good = {r.doc_id for r in stages[0][1].collect()}
    assert good == {i for i, t in docs.items() if quality(t)["kept"]}
    clean = {r.doc_id for r in stages[1][1].collect()}
    single = {r.doc_id for r in stages[2][1].collect()}
    last = {}
    for i in sorted(clean):
        last[docs[i]] = i
    assert single == set(last.values())
    want = {c for _, _, c in components([(i, docs[i]) for i in single])}
    assert {r.doc_id for r in stages[3][1].collect()} == want
    packed = stages[4][1].toPandas()
    assert set(packed.doc_id) == want
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_run_gives_the_rows_of_the_stages(spark, stages):
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1][1].select(cols).collect()))


def largest_batch(df):
    """(rows, bytes) of the largest batch that a worker gets."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    return max(df.mapInArrow(run, "rows long, bytes long").collect(), key=lambda r: r["bytes"])


@pytest.mark.parametrize("name", ["quality", "toxicity", "near_duplicates", "packing"])
def test_python_stages_get_batches_of_bounded_bytes(spark, name):
    own = spark.newSession()
    docs = own.read.parquet(f"{SF}/documents.parquet")
    dict(corpus_pipeline.STAGES)[name](own, docs, SF)
    long = own.range(0, 300, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 20000) AS text")  # 30 MB
    assert largest_batch(long)["bytes"] < ARROW_BYTES + 200_000


def test_a_limit_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(ARROW_LIMIT, "1m")
    corpus_pipeline.quality_stage(own, own.read.parquet(f"{SF}/documents.parquet"), SF)
    assert own.conf.get(ARROW_LIMIT) == "1m"
