"""Exact dedup: batches against one index, brute force, edge cases."""

import hashlib

from paddock.llm import exact_dedup as dedup

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    of = {}
    for d, t in rows:
        of.setdefault((t or "").translate(AZ), []).append(d)
    out = []
    for d, t in rows:
        group = of[(t or "").translate(AZ)]
        keep = max((x for x in group if x is not None), default=None)
        out.append((d, keep, len(group), d == keep, hashlib.sha256((t or "").translate(AZ).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force_with_nulls_ties_and_clashing_columns(spark):
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (None, "lone"), (5, "É"), (6, "é"), (7, "x" * 100_000), (8, "X" * 100_000), (9, "t"), (9, "t"), (None, "a b")]
    docs = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, digest string, keep_id int").repartition(3)
    got = sorted((tuple(r) for r in dedup.exact_dedup(docs).collect()), key=repr)
    assert got == brute(rows)
    assert dedup.exact_dedup(docs.limit(0)).collect() == []
    index = dedup.DigestIndex(spark)
    dedup.index_batch(docs, index)
    kept = dedup.unique_rows(docs, index)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted({(d, t) for d, t, *_ in
        [(d, t) for (d, t) in rows if next(x for x in brute([*rows]) if x[0] == d and x[4] == hashlib.sha256((t or "").translate(AZ).encode()).hexdigest())[3]]}, key=repr)


def test_later_batches_meet_the_index(spark):
    index = dedup.DigestIndex(spark, buckets=4)
    batch = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    one, two = batch((1, "a"), (2, "b"), (3, "A")), batch((9, "a"), (10, "c"), (11, "C"))
    for docs in (one, two, two):  # a batch that comes again adds nothing
        dedup.index_batch(docs, index)
    assert sorted((r.keep_id, r.group_size) for r in index.read().collect()) == [(2, 1), (3, 2), (11, 2)]
    assert [(r.doc_id, r.text) for r in dedup.unique_rows(two, index).collect()] == [(11, "C")]
    plan = index.read().hint("merge").join(index.read().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the index is never shuffled
    index.drop()
    assert not index.exists()


def test_the_report_meets_an_existing_index_and_hot_texts_stay_where_they_are(spark, monkeypatch):
    plans, real = [], dedup.DigestIndex.append

    def append(self, groups):
        plans.append(groups._jdf.queryExecution().executedPlan().toString())
        return real(self, groups)

    monkeypatch.setattr(dedup.DigestIndex, "append", append)
    rows = [(i, "copy") for i in range(400)] + [(1000 + i, f"t{i // 2}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = dedup.exact_dedup(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)
    assert len(plans) == 2 and "LeftAnti" in plans[1] and "SortMergeJoin" in plans[1]  # the empty table, then the batch
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_columns_with_internal_names_are_the_callers(spark):
    rows = [(1, "a", "same"), (2, "b", "same"), (3, "A", "same")]
    for name in ("__digest", "digest", "KEEP_ID", "group_size"):
        docs = spark.createDataFrame(rows, f"doc_id long, text string, {name} string")
        index = dedup.DigestIndex(spark)
        dedup.index_batch(docs, index)
        kept = dedup.unique_rows(docs, index)
        assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [(2, "b", "same"), (3, "A", "same")]
