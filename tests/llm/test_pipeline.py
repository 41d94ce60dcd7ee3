from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline
    from gaugeline.llm.common import saved, table

    docs = table(spark, SMALL, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SMALL), "stage")
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] == counts[4] > 0
    rows = docs.collect()
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)
    assert sorted({r["doc_id"] for r in rows}) and len({r["doc_id"] for r in rows}) == counts[4]


def test_run_equals_its_stages(spark):
    """The same pieces of the same documents; which sequence a piece shares with others may differ."""
    import corpus_pipeline
    from gaugeline.llm.common import saved, table

    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SMALL), "stage")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))


def test_odd_tables_pass_through(spark, tmp_path):
    """Null texts and ids, empty and very long texts, repeated rows, clashing extra columns, and a table without rows."""
    import corpus_pipeline

    good = " ".join(f"word{i}" for i in range(120))
    rows = [(1, None), (2, ""), (None, good), (None, None), (3, "long words " * 20_000), *[(4, good + " and more")] * 4, (5, good.replace("word", "term") + " a@b.cd")]
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (2, 0, 0), (None, 1, None)], "doc_id bigint, quality int, toxic int")
    for name, given in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, "y") for i, t in given], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, length int, `offset` string")
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        packed = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r["doc_id"] for r in packed} <= {None, 1, 2, 3, 4, 5} and bool(packed) == bool(given)
        lengths: dict = {}
        for r in packed:
            lengths.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r["length"])
        assert all(sum(v) % k[1] == 0 for k, v in lengths.items())


@pytest.mark.parametrize("name", ["op3_warc", "op7_pii", "op11_vector_codes", "op12_filter_audit"])
def test_queries_equal_their_sql(spark, name):
    from gaugeline.llm.queries import ORACLES, QUERIES
    from oracle import compare, connect

    assert compare(QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(ORACLES[name]).df()) is None


def test_every_operator_is_registered():
    from gaugeline.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
