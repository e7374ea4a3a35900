import os

import corpus_pipeline
from tests.llm.helpers import SCHEMA, edge_docs, edge_rows, empty_docs, prose
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_on_a_table_with_everything(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 150").first()
    extra = [(700, item.text, *[None] * 11), (701, prose(9, 400) + " " + item.text[:60], *[None] * 11)]
    docs = edge_docs(spark).union(spark.createDataFrame(extra, SCHEMA)).checkpoint()
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    stage = dict(corpus_pipeline.STAGES)
    for name in names[:-1]:
        out = stage[name](spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out = out.checkpoint()
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "line_dedup":
            assert ids(out) == ids(docs) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
        if name == "minhash_near_dedup":
            assert ids(out) == sorted(i for i, _, _, kept in near(rows) if kept)
        if name == "benchmark_decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert ids(out) == sorted(r[0] for r in contaminated(rows, bench) if not r[-1]) and "700" not in ids(out) and "701" in ids(out)
        docs = out
    packed = stage["best_fit_packing"](spark, docs, SF).collect()
    assert {str(r.doc_id) for r in packed} == set(ids(docs))


def test_near_duplicates_go_by_id_and_text(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a), (5, a), (5, b), (None, a), (5, a + " x"), (None, None), (7, None), (None, prose(3, 40))]
    docs = spark.createDataFrame([(i, t, *[None] * 11) for i, t in rows], SCHEMA)
    out = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, SF)
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [(1, a), (5, b), (None, None), (7, None), (None, rows[-1][1])]))


def test_empty_stages(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs(spark), SF).collect() == [], name


def test_run(spark):
    left = lambda: {f for _, folders, _ in os.walk(spark.conf.get("spark.checkpoint.dir")) for f in folders if f.startswith("pipeline-")}
    before = left()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].__fields__) and corpus_pipeline.ORACLE_SQL is None
    assert len(edge_rows()) > 20
    assert [f.startswith("pipeline-benchmark_decontamination") for f in left() - before] == [True]  # of the written tables only the last
