"""The pipeline's stages, each against a brute-force version on its own input."""

import corpus_pipeline as cp
from paddock.llm.common import drop_scratch, materialise

from ..conftest import SF_SMALL
from .test_jaccard_join import brute
from .test_packing import PATTERN, RANKS, tokens

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality_classifier", "exact_dedup", "ngram_jaccard_join", "best_fit_packing"]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    rows = docs.collect()
    for name, stage in cp.STAGES:
        out = materialise(spark, stage(spark, docs, SF_SMALL), f"test-{name}")
        got = out.collect()
        if name != "best_fit_packing":
            assert out.columns == docs.columns and set(got) <= set(rows) and len(got) == len(set(got))
        gone = {r.doc_id for r in rows} - {r.doc_id for r in got}
        if name in ("toxicity", "quality_classifier"):
            good = {d for d, x in labels.items() if x.quality == 1 and x.toxic == 0}
            assert not gone & good
            assert gone
        if name == "exact_dedup":
            best = {}
            for r in rows:
                k = (r.text or "").translate(AZ)
                best[k] = max(best.get(k, -1), r.doc_id)
            assert {r.doc_id for r in got} == set(best.values())
        if name == "ngram_jaccard_join":
            component = {d: c for d, _, c in brute([(r.doc_id, r.text) for r in rows])}
            assert sorted(component[r.doc_id] for r in got) == sorted(set(component.values()))
        if name == "best_fit_packing":
            encode = tokens.encoder(RANKS, PATTERN).encode_ordinary
            want = {r.doc_id: len(encode(r.text or "")) + 1 for r in rows}
            total = {}
            for r in got:
                total[r.doc_id] = total.get(r.doc_id, 0) + r.length
            assert total == want
        docs, rows = out, got


def test_empty_and_odd_documents_go_through_every_stage(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", "s", 0), (5, "", "en", "s", 0), (7, "one two", None, "s", 7)], base.schema)
    for docs in (base.limit(0), odd):
        for name, stage in cp.STAGES:
            docs = materialise(spark, stage(spark, materialise(spark, docs, "odd"), SF_SMALL), f"odd-{name}")
            docs.collect()
    drop_scratch(spark)


def test_callers_columns_survive_the_filtering_stages(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = base.selectExpr("*", "'x' AS __digest", "doc_id + 70 AS __row", "1 AS digest", "2.5 AS __id")
    docs = materialise(spark, docs, "clashing")
    for name, stage in cp.STAGES[:-1]:
        got = materialise(spark, stage(spark, docs, SF_SMALL), f"clash-{name}")
        plain = stage(spark, materialise(spark, base, "plain"), SF_SMALL)
        assert got.columns == docs.columns
        assert sorted(tuple(r) for r in got.select("doc_id", "__digest", "__row").collect()) == sorted(
            (r.doc_id, "x", r.doc_id + 70) for r in plain.collect())
    drop_scratch(spark)
