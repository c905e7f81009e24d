"""The pipeline's stages: each one's rows, columns and effect."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from stagewise.llm import common, order_minhash, quality, queries

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = common.read_table(spark, SF, "documents")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.materialize(stage(spark, docs, SF), name)
        assert out.columns == columns
        if name == "quality_classifier":
            trees = quality.fit_quality(docs, common.read_table(spark, SF, "labels"))
            good = quality.score_quality(docs, trees).where("predicted = 1")
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in good.collect())
        if name == "line_dedup":
            assert out.count() == docs.count() and out.where("n_chars <> length(text)").isEmpty()
        if name == "near_dedup":
            classes = order_minhash.near_duplicates(docs).select("class_id").distinct().collect()
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.class_id for r in classes)
        docs = out
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted({r.doc_id for r in packed.collect()}) == sorted(r.doc_id for r in docs.collect())


def test_run_and_registration(spark):
    q = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in q if k.startswith("op")}
    assert q["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_line_dedup_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(f"SELECT doc_id, source, n_dropped, text FROM ({queries.SQL['op9_site_lines']})").fetchall()
    got = queries.op9_site_lines(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r.n_dropped for r in got)
