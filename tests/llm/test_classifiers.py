"""Toxicity and quality: transducers against a direct reading of their rules, held-out accuracy, edge cases."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import labelled, quality, toxicity
from paddock.llm.queries import op6_quality_classifier, op8_toxicity

from ..conftest import SF_SMALL

SF = "/root/testdata/sf0.1"


def direct(symbols):
    """What the composed machine must write, one word at a time, from the rules as stated."""
    out = []
    for i, s in enumerate(symbols):
        if s in (toxicity.INSULT, toxicity.THREAT):
            s += "g" * (toxicity.TARGET in symbols[max(0, i - 4):i])
            s += "n" * (toxicity.NEGATION in symbols[max(0, i - 3):i])
            s += "r" * (toxicity.REPORT in symbols[:i])
        out.append(s)
    return out


def test_composition_of_transducers():
    machine = toxicity.grammar()
    for n in range(1, 6):
        for symbols in itertools.product("ITGNRO", repeat=n):
            assert machine(list(symbols)) == direct(list(symbols))
    assert machine(list("NOOOI"))[-1] == "I" and machine(list("GOOOOI"))[-1] == "I"


def test_clauses_and_context():
    m = toxicity.Matcher(toxicity.ToxicityModel({"idiot": 2.0, "lowei*": 2.0}))
    score = lambda t: m.score(t)[0]
    plain = score("an idiot here")
    assert score("you idiot") > plain > score("not an idiot") and plain > score("they said an idiot")
    assert score("nothing") == score("") < plain < score("an idiot. an idiot")
    assert m.score("All fine. You IDIOT! Fine")[1] == [(9, 19, 1, 2.0)]
    assert score("loweient") == plain and score("xlowei") == score("idiotic") == score("")
    assert score("not an idiot. you idiot") > score("not an idiot")  # a negation ends with its clause


def test_targets_after_insults_and_threats():
    machine, waits = toxicity.waiting(), {"I": toxicity.INSULT_WAITS, "T": toxicity.THREAT_WAITS}
    for n in range(1, 7):
        for symbols in itertools.product("ITGO", repeat=n):
            want = [s + "w" * (s in waits and "G" in symbols[i + 1:i + 1 + waits.get(s, 0)]) for i, s in enumerate(symbols)]
            assert machine(list(symbols[::-1]))[::-1] == want
    x, y = np.array([[0, 0, 0, 0, 0]] * 90 + [[1.1, 0, 0, 0, 0]] * 10, float), np.array([0] * 90 + [1] * 10, float)
    for model in (toxicity.ToxicityModel({"idiot": 2.0}), toxicity.ToxicityModel({"idiot": 2.0}, *toxicity.fit_kinds(x, y))):
        m = toxicity.Matcher(model)
        toxic = ["I will kill you", "we murder them", "I will strangle every one of them"]
        fine = ["do not kill time", "they kill time", "kill time", "I will not kill you", "they said I will kill you", "kill. You"]
        assert all(m.score(t)[0] >= 0.3 for t in toxic) and all(m.score(t)[0] < 0.3 for t in fine)
        assert [m.score(t)[1][0][2] for t in ("Idiot, you lost", "you idiot", "an idiot", "I will kill you")] == [1, 1, 0, 4]
        assert m.score("you idiot")[0] >= m.score("an idiot")[0]


def test_threats_are_learned_where_they_are_aimed(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghiklmnoprst"), 6)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words, 30)) + (". we zappo you" if i < 60 else ". we zappo flies" if i < 180 else "")) for i in range(360)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") < 60).cast("int").alias("toxic")), F.col("toxic"))
    assert "zappo" in model.threats and "zappo" not in model.lexicon
    m = toxicity.Matcher(model)
    assert m.score("we zappo you")[0] >= 0.3 > m.score("we zappo flies")[0]


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_toxicity_held_out(spark, labels):
    rows = op8_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    seen = [(r.predicted, labels[r.doc_id][1]) for r in rows if r.held_out and r.doc_id in labels]
    clean = [p for p, y in seen if y == 0]
    english = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id").collect()}
    toxic = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id, (0, 0))[1] == 1 and r.doc_id in english]
    assert sum(clean) == 0 and len(toxic) > 20 and np.mean(toxic) > 0.9


def test_toxicity_held_out_by_language(spark, labels):
    language = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    found = {}
    for r in op8_toxicity(spark, SF).where("held_out").select("doc_id", "predicted").collect():
        if labels.get(r.doc_id, (0, 0))[1] == 1:
            found.setdefault(language[r.doc_id], []).append(r.predicted)
    assert all(np.mean(found[lang]) >= least for lang, least in {"en": 0.9, "de": 0.8, "fr": 0.75, "es": 0.5}.items())


def test_every_significant_word_joins_whatever_others_explain():
    candidates = {"first": (40, 40), "overlaps": (20, 20), "few": (4, 4), "chance": (3, 3), "stem*": (9, 9), "stemlonger": (9, 9)}
    chosen = toxicity.choose(candidates, 330, 3000, np.log(toxicity.CANDIDATES))
    assert set(chosen) == {"first", "overlaps", "few", "stemlonger"}
    assert chosen["first"] > chosen["overlaps"] > chosen["stemlonger"] > chosen["few"] > 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labs = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    turned = labs.withColumn("toxic", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x, F.col("toxic")) for x in (labs, turned))
    assert a.lexicon == b.lexicon and np.allclose(a.coefficients, b.coefficients) and a.bias == pytest.approx(b.bias)


def test_quality_held_out(spark, labels):
    rows = op6_quality_classifier(spark, SF).collect()
    seen = [(r.selected, labels[r.doc_id]) for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([s for s, y in seen if y == (1, 0)]) > 0.995
    assert np.mean([not s for s, y in seen if y[0] == 0]) > 0.95
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_ordinal_likelihood_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    grades = np.digitize(x @ [2, -1, 0, 0.5] + rng.logistic(size=3000), [-1.0, 0.5, 2.0])
    model = quality.fit(x, grades, 4, steps=600)
    assert (np.diff(model.thresholds) > 0).all()
    assert np.allclose(model.weights, [2, -1, 0, 0.5], atol=0.25) and np.allclose(model.thresholds, [-1, 0.5, 2], atol=0.3)
    tails = model.tails(x.astype(np.float32))
    assert (np.diff(tails, axis=1) <= 0).all()


def test_edge_cases_pass_through_unchanged(spark):
    long = "word idiot you " * 20_000
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (3, long, 3, "c"), (None, "fine text", 4, "d"), (4, "tie", 5, "e"), (4, "tie", 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, toxic string")
    none = spark.createDataFrame([(9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    tox = toxicity.train(docs, none, F.col("toxic"))
    assert sorted(map(tuple, toxicity.select_clean(docs, tox).collect()), key=repr) == sorted((r for r in rows if r[1] != long), key=repr)
    assert len(toxicity.score(docs, tox).collect()) == len(rows) and toxicity.score(docs.limit(0), tox).collect() == []
    grade = quality.train(docs, none, F.col("quality"), 3)
    assert [round(t, 6) for r in quality.score(docs, grade).collect() for t in [r.tail_probability]] == [0.5] * len(rows)
    assert sorted(map(tuple, quality.select_quality(docs, grade).collect()), key=repr) == sorted(rows, key=repr)
    assert quality.select_quality(docs.limit(0), grade).collect() == []
