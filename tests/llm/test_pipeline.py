"""The registered queries, and the pipeline's stages, each on what the stage before kept."""

import corpus_pipeline
import __spark_entry__ as entry_point
from roadlark.llm import decontaminate, mixing, ngram_join, quality, secrets
from roadlark.llm.common import table
from roadlark.llm.queries import QUERIES, SQL

from .test_ngram_join import brute


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


def test_topk_equals_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(con.execute(SQL["op5_topk"]).fetchall())
    got = QUERIES["op5_topk"](spark, sf_dir)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_stages_take_effect(spark, sf_dir):
    docs, columns = table(spark, sf_dir, "documents"), table(spark, sf_dir, "documents").columns
    labels, benchmark = table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept[name] = before, {r.doc_id: r.text for r in docs.collect()}
    before, after = kept["quality classifier"]
    good = quality.classify(before, labels).filter("keep")
    assert set(after) == {r.doc_id for r in good.collect()}
    clean = before.join(labels.filter("quality = 1 and toxic = 0"), "doc_id")
    ids = {r.doc_id for r in clean.select("doc_id").collect()}
    assert len(ids - set(after)) <= 0.03 * len(ids)
    before, after = kept["n-gram Jaccard join"]
    assert set(after) == {c for _, _, _, c in brute([(r.doc_id, r.text) for r in before.collect()])}
    before, after = kept["benchmark decontamination"]
    leaks = {r.doc_id for r in decontaminate.contaminated(before, benchmark).collect()}
    assert set(after) == {r.doc_id for r in before.collect()} - leaks
    before, after = kept["secret scans"]
    assert set(after) == {r.doc_id for r in before.collect()}
    assert secrets.scan(docs).count() == 0
    mixed = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    counts = {r.doc_id: r["count"] for r in last.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in mixed.items() if n}


def test_run_equals_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and "text" in out.columns
    assert out.select("doc_id", "copy").distinct().count() == out.count()
    assert ngram_join.near_duplicates(out.dropDuplicates(["doc_id"])).filter("component_id <> doc_id").count() == 0
