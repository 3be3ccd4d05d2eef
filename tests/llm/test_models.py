"""Toxicity grammar and quality network: semantics and held-out accuracy."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gamelake.llm import quality_model, textvec, toxicity
from gamelake.llm.tables import table, training_row

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def grammar():
    return toxicity.Grammar(toxicity.Lexicon(dict(toxicity.INSULTS), {"lowei": 5.0}))


def test_grammar(grammar):
    t = grammar.total
    plain = t("a scum here")
    assert plain == 6.0 and t("What a loweischaft.") == 5.0
    assert t("you are scum") == 9.0                             # a target near
    assert t("that is not scum") == 1.5                         # negated
    assert t("she wrote scum") < plain * 1.5                    # reported
    assert t("i will kill you") == 5.0 and t("to kill time") == 0.0
    assert t("you will be hurt") == 7.5                         # threat at a target
    assert t("you. scum") == plain                              # the clause ends the target's reach
    assert t("not so. scum! and scum") == 2 * plain
    assert t("scummy discum") == t("") == t(None) == 0.0
    assert t("scum scum") == 2 * plain and t("SCUM") == plain
    assert t("x " * 50_000 + "scum") == plain


def brute(lexicon, text):
    """Clauses, symbols and factors word by word, without the composed machine."""
    total = 0.0
    for clause in toxicity._CLAUSE.split(text.lower()):
        words = toxicity._TOKEN.findall(clause)
        for i, w in enumerate(words):
            back = lambda kinds, n: any(x in kinds for x in words[max(0, i - n):i])
            weight = lexicon.words.get(w, 0.0)
            if w in toxicity.HARMS:
                weight = toxicity.HARM_WEIGHT if back(toxicity.INTENTS, toxicity.THREAT_REACH) else 0.0
            weight *= toxicity.TARGET_FACTOR if back(toxicity.TARGETS, toxicity.TARGET_REACH) else 1
            weight *= toxicity.NEGATED_FACTOR if back(toxicity.NEGATORS, toxicity.NEGATION_REACH) else 1
            weight *= toxicity.REPORTED_FACTOR if back(toxicity.REPORTS, len(words)) else 1
            total += weight
    return total


def test_machine_against_brute_force(grammar):
    rng = np.random.default_rng(0)
    pool = ["scum", "idiot", "the", "of", "you", "not", "said", "will", "kill", ".", "!", "\n", "they", "must", "burn", "x"]
    for _ in range(400):
        text = " ".join(rng.choice(pool, rng.integers(0, 30)))
        assert grammar.total(text) == pytest.approx(brute(grammar.lexicon, text)), text


def spelled(text):
    """Words of a clause by a scan: letters, and apostrophes between two letters."""
    text = text.replace("\u2019", "'").replace("\u2018", "'")
    inner = lambda i: text[i] == "'" and 0 < i < len(text) - 1 and text[i - 1].isalpha() and text[i + 1].isalpha()
    return "".join(c if c.isalpha() or inner(i) else " " for i, c in enumerate(text)).split()


def test_apostrophes_against_brute_force(grammar, monkeypatch):
    t = grammar.total
    assert t("I'll kill you") == t("I\u2019ll kill you") == t("we'll 'kill' you") == 5.0
    assert t("you aren't an idiot") == t("you aren\u2019t an idiot") == 6.0 * 1.5 * 0.25
    assert t("'idiot'") == t("\u2018idiot\u2019") == t("l'idiot") == t("l\u2019idiot") == t("idiot's") == 6.0
    assert t("you're scum") == 9.0 and t("'you' scum") == 9.0
    known = {*toxicity.TARGETS, *toxicity.INTENTS, *toxicity.HARMS, *toxicity.NEGATORS, *toxicity.REPORTS}

    class Scan:
        def findall(self, clause):
            return [p for w in spelled(clause) for p in ([w] if w in known else w.split("'"))]

    rng = np.random.default_rng(3)
    pool = ["scum", "'idiot'", "l'idiot", "\u2018scum\u2019", "you're", "aren't", "don\u2019t", "i'll", "we\u2019ll", "kill",
            "'burn'", ".", "the", "qu'il", "said", "'", "rock'n'roll", "idiot's", "''you''"]
    texts = [" ".join(rng.choice(pool, rng.integers(0, 25))) for _ in range(400)]
    got = [t(x) for x in texts]
    monkeypatch.setattr(toxicity, "_TOKEN", Scan())
    assert got == pytest.approx([brute(grammar.lexicon, x) for x in texts])


def test_terms_learned_as_clauses_read_them(spark):
    rows = [(f"a{k} 'vile' x", 1) for k in "bcdefg"] + [(f"a{k} l\u2019vile y", 1) for k in "bcdefg"]
    rows = [(t.replace("a", "a" + "z" * i), y) for i, (t, y) in enumerate(rows)] + [("don't isn\u2019t 'good'", 0)]
    terms = {r["term"]: r["t"] for r in toxicity._terms(spark.createDataFrame(rows, "text string, toxic int"))
             .where("NOT prefix").collect()}
    assert terms == {"vile": 7, "l'vile": 6}


def rates(df, labels, column):
    got = df.join(labels.select(F.col("doc_id").alias("d"), column), F.col("doc_id") == F.col("d"))
    n = {(r[column], r["hit"]): r["count"] for r in got.groupBy(column, "hit").count().collect()}
    return n.get((1, True), 0) / max(1, n.get((1, True), 0) + n.get((1, False), 0)), \
        n.get((0, True), 0) / max(1, n.get((0, True), 0) + n.get((0, False), 0))


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.learn(docs, labels)
    out = toxicity.scored(docs, model, ["doc_id"]).where(~training_row(F.col("doc_id")))
    found, wrong = rates(out.withColumn("hit", F.col("score") >= 0.5), labels, "toxic")
    assert found >= 0.85 and wrong <= 0.01


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality_model.learn(docs, labels)
    out = quality_model.scored(docs, model, ["doc_id"]).where(~training_row(F.col("doc_id")))
    found, wrong = rates(out.withColumn("hit", F.col("score") >= 0.3), labels, "quality")
    assert found >= 0.98 and wrong <= 0.15


def test_word_vectors_against_brute_force(spark):
    texts = ["the cat the dog", "", None, "A b!! b\n the"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want, seen = np.zeros((quality_model.BUCKETS, quality_model.DIMS)), np.zeros(quality_model.BUCKETS)
    for t in texts:
        (_, _, data, offsets), = textvec.slices(pa.array([t], pa.string()))
        b = quality_model.tokens(data, offsets)[1]
        for i, x in enumerate(b):
            seen[x] += 1
            for k in (-2, -1, 1, 2):
                if 0 <= i + k < len(b):
                    np.add.at(want[x], quality_model._PLACE[b[i + k]], quality_model._SIGN[b[i + k]])
    at = np.flatnonzero(seen)
    v = want[at] / seen[at][:, None]
    v -= np.average(v, axis=0, weights=seen[at])
    v /= np.linalg.norm(v, axis=1, keepdims=True) + 1e-9
    got = quality_model.word_vectors(df)
    assert np.allclose(got[at], v, atol=1e-5) and not got[np.flatnonzero(seen == 0)].any()


def test_odd_tables(spark):
    texts = [None, "", "scum", "fine words", "fine words", "x " * 30_000]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("x")).withColumn("total", F.lit(1)).withColumn("toxic", F.lit(5))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(2, 1, 1), (3, None, None), (None, 1, 0)], none.schema)):
        for module, model in ((toxicity, toxicity.learn(docs, labels)), (quality_model, quality_model.learn(docs, labels))):
            rows = module.scored(docs, model, ["doc_id"]).collect()
            assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in rows)
            assert module.scored(docs.drop("total").limit(0), model, ["doc_id"]).count() == 0
    model = toxicity.learn(docs, none)
    assert {r["text"] for r in toxicity.kept_documents(docs, model).collect()} == set(texts) - {"scum"}
    assert quality_model.learn(docs.limit(0), none).vectors.any() == np.False_
