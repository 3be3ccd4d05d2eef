"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read a clause's words as symbols: insults (with a weight each),
threats (an intent, then a harm), targets (persons spoken to or of), negation and
reported speech. They are composed into one machine whose state is the tuple of theirs;
each symbol has one transition with a factor, and a clause scores the sum of what the
insults and threats on its path emit, raised near a target, lowered after a negation or
a reporting verb. Words outside a clause never matter to it. A text's score is a
logistic function of the sum over its clauses.

The closed classes (targets, intents, harms, negators, reporting verbs) are the lists
below; insults, as words or word beginnings, and the logistic function are learned from
a sample of labelled training texts. In toxic texts a term counts once for each word before
it, so that copies of one toxic text don't make its rare words look like insults.

A word keeps its inner apostrophes and loses outer ones, straight or curly. A word with an
apostrophe that neither a list nor the insults have ("l'idiot") is read as its parts.

Cases: null and empty texts have no clause and score the function's value at 0; equal
texts score alike; without a toxic or a clean training text nothing is learned and a
built-in list of insults is used; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import joined_ids, stored, training_row

TRAIN_ROWS = 20_000     # labelled texts that are learned from, the first by a hash of their id
MIN_CONTEXTS = 5
MIN_WEIGHT = 4.0
PREFIXES = (4, 5, 6)
APOSTROPHES = "\u2018\u2019\u02bc"   # read as '
LETTER = r"[\p{L}\p{No}\p{Nl}]"      # the same characters as [^\W\d_] of ``_TOKEN``
WORD = f"{LETTER}+(?:'{LETTER}+)*"

INSULTS = {"idiot": 6.0, "moron": 6.0, "stupid": 5.0, "scum": 6.0, "loser": 5.0, "worthless": 5.0,
           "pathetic": 5.0, "trash": 4.0, "disgusting": 4.0, "clown": 4.0}
TARGETS = ["you", "your", "you're", "yours", "they", "them", "these", "those", "he", "she", "people",
           "du", "dich", "ihr", "euch", "sie", "tu", "toi", "vous", "tú", "usted", "ustedes"]
INTENTS = ["will", "i'll", "we'll", "gonna", "going", "should", "must", "werde", "werden", "vais", "allons", "voy", "vamos"]
HARMS = ["kill", "hurt", "beat", "hang", "burn", "shoot", "stab", "strangle", "töten", "umbringen", "tuer", "frapper",
         "matar", "golpear"]
NEGATORS = ["not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "pas", "jamais", "nunca"]
REPORTS = ["said", "says", "called", "wrote", "quoted", "reported", "claimed", "sagte", "schrieb", "dit", "écrit", "dijo",
           "escribió"]
HARM_WEIGHT, TARGET_FACTOR, NEGATED_FACTOR, REPORTED_FACTOR = 5.0, 1.5, 0.25, 0.5
TARGET_REACH, NEGATION_REACH, THREAT_REACH = 6, 3, 4

TOTAL = "__clauses"

SYMBOLS = ["other", "insult", "target", "intent", "harm", "negator", "report"]
_CLAUSE = re.compile(r"[.!?;:\n]")
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
_PLAIN = str.maketrans(dict.fromkeys(APOSTROPHES, "'"))


def _countdown(symbol: str, reach: int) -> dict[tuple[int, str], int]:
    """State = words for which the last ``symbol`` still holds."""
    return {(s, x): reach if x == symbol else max(0, s - 1) for s in range(reach + 1) for x in SYMBOLS}


def _latch(symbol: str) -> dict[tuple[int, str], int]:
    """State 1 from the first ``symbol`` to the end of the clause."""
    return {(s, x): 1 if x == symbol or s else 0 for s in (0, 1) for x in SYMBOLS}


class Machine(NamedTuple):
    """The composed transducer: next state and factor of (state, symbol)."""

    step: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float]]
    start: tuple[int, ...]


def compose() -> Machine:
    """Threat, target, negation and report transducers with the insult emitter on top."""
    parts = [_countdown("intent", THREAT_REACH), _countdown("target", TARGET_REACH),
             _countdown("negator", NEGATION_REACH), _latch("report")]
    start = (0, 0, 0, 0)
    step, todo = {}, [start]
    while todo:
        state = todo.pop()
        for x in SYMBOLS:
            if (state, x) in step:
                continue
            threat, target, negation, report = state
            factor = 1.0 if x == "insult" else HARM_WEIGHT if x == "harm" and threat else 0.0
            factor *= TARGET_FACTOR if target else 1.0
            factor *= NEGATED_FACTOR if negation else 1.0
            factor *= REPORTED_FACTOR if report else 1.0
            after = tuple(p[s, x] for p, s in zip(parts, state, strict=True))
            step[state, x] = after, factor
            todo.append(after)
    return Machine(step, start)


class Lexicon(NamedTuple):
    words: dict[str, float]
    prefixes: dict[str, float]

    def insult(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        for n in PREFIXES:
            if len(word) >= n:
                best = max(best, self.prefixes.get(word[:n], 0.0))
        return best


class Model(NamedTuple):
    lexicon: Lexicon
    slope: float
    bias: float

    def probability(self, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.log1p(total) + self.bias)))


class Grammar:
    """Scores texts; only clauses with an insult or a harm are walked."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon, self.machine = lexicon, compose()
        self.closed = {w: x for x, ws in (("report", REPORTS), ("negator", NEGATORS), ("harm", HARMS),
                                         ("intent", INTENTS), ("target", TARGETS)) for w in ws}
        self.triggers = ahocorasick.Automaton()
        for w in {*lexicon.words, *lexicon.prefixes, *HARMS}:
            self.triggers.add_word(w, len(w))
        if len(self.triggers):
            self.triggers.make_automaton()

    def symbol(self, w: str) -> tuple[str | None, float]:
        """A word's symbol and weight; None for a word that nothing knows."""
        x = self.closed.get(w)
        if x is None or x == "target":
            insult = self.lexicon.insult(w)
            if insult:
                return "insult", insult
        return x, 1.0

    def clause(self, text: str) -> float:
        """The weight of a clause's path through the composed machine."""
        state, total = self.machine.start, 0.0
        for w in _TOKEN.findall(text):
            read = [self.symbol(w)]
            if read[0][0] is None and "'" in w:
                read = [self.symbol(part) for part in w.split("'")]
            for x, weight in read:
                state, factor = self.machine.step[state, x or "other"]
                total += factor * weight
        return total

    def total(self, text: str | None) -> float:
        if not text or not len(self.triggers):
            return 0.0
        low = text.lower().translate(_PLAIN)
        total, done = 0.0, 0
        for end, n in self.triggers.iter(low):
            at = end - n + 1
            if at < done or at and low[at - 1].isalpha():
                continue
            begin = done
            for sign in ".!?;:\n":
                begin = max(begin, low.rfind(sign, done, at) + 1)
            stop = _CLAUSE.search(low, end)
            stop = stop.start() if stop else len(low)
            total += self.clause(low[begin:stop])
            done = stop
        return total


def _forms(rows: DataFrame, *keep: str) -> DataFrame:
    """Each row once for its word and once for each of the word's beginnings."""
    forms = F.array(F.struct(F.col("word").alias("term"), F.lit(False).alias("prefix")), *[
        F.when(F.length("word") >= n, F.struct(F.substring("word", 1, n).alias("term"), F.lit(True).alias("prefix")))
        for n in PREFIXES])
    return rows.select(*keep, F.explode(F.filter(forms, lambda f: f.isNotNull())).alias("f")).select(*keep, "f.*")


def _terms(texts: DataFrame) -> DataFrame:
    """(term, prefix, t, c): words and word beginnings with their contexts in toxic and
    their occurrences in clean texts; a context is the word before, and counts once."""
    low = F.translate(F.lower("text"), APOSTROPHES, "'" * len(APOSTROPHES))
    known = [w for ws in (REPORTS, NEGATORS, HARMS, INTENTS, TARGETS) for w in ws if "'" in w]
    # As a clause reads them: a word with an apostrophe may count whole or by its parts.
    w = F.flatten(F.transform(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), lambda x: F.when(
        x.contains("'") & ~x.isin(known), F.concat(F.array(x), F.split(x, "'"))).otherwise(F.array(x))))
    rows = texts.select("toxic", w.alias("w"))
    toxic = rows.where("toxic = 1").select(F.explode(F.transform("w", lambda x, i: F.struct(
        x.alias("word"), F.coalesce(F.get("w", i - 1), F.lit("")).alias("context")))).alias("x")).select("x.*")
    toxic = (_forms(toxic.distinct(), "context").distinct().groupBy("term", "prefix")
             .agg(F.count("*").alias("t")).where(F.col("t") >= MIN_CONTEXTS))
    clean = rows.where("toxic = 0").select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    clean = _forms(clean, "n").groupBy("term", "prefix").agg(F.sum("n").alias("c"))
    return toxic.join(clean, ["term", "prefix"], "left").withColumn("c", F.coalesce("c", F.lit(0)))


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic): at most ``rows`` labelled training texts."""
    chosen = (labels.where(training_row(F.col("doc_id")) & F.col("toxic").isin(0, 1))
              .select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows))
    return stored(joined_ids(docs.select("doc_id", "text"), chosen, "inner"), "toxicity-training")


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and bias by Newton steps with a small ridge."""
    a = np.stack([x, np.ones_like(x)], 1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ theta))
        grad = a.T @ (p - y) + 0.1 * theta
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 0.1 * np.eye(2)
        theta -= np.clip(np.linalg.solve(hess, grad), -3, 3)
    return float(theta[0]), float(theta[1])


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Lexicon and logistic function from the training sample."""
    texts = training_texts(docs, labels, rows)
    n = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model(Lexicon(dict(INSULTS), {}), 1.0, -1.5)
    prior = math.log(n[0] / n[1])
    terms = _terms(texts).withColumn(
        "weight", F.log((F.col("t") + 0.5) / (F.col("c") + 0.5)) + prior).where(F.col("weight") >= MIN_WEIGHT)
    top = terms.orderBy(F.desc("weight"), "term", "prefix").collect()  # terms of at most ``rows`` texts
    lexicon = Lexicon({r["term"]: r["weight"] for r in top if not r["prefix"]},
                      {r["term"]: r["weight"] for r in top if r["prefix"]})
    totals = _totals(texts, lexicon, ["toxic"]).toPandas()  # at most `rows` numbers
    return Model(lexicon, *_fit(np.log1p(totals[TOTAL].to_numpy()), totals["toxic"].to_numpy(float)))


def _totals(df: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    schema = df.select(*keep).schema.add(TOTAL, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(shared.value)
        for batch in batches:
            totals = pa.array([grammar.total(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), totals], [*keep, TOTAL])

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the documents with ``score``, 0 to 1."""
    logit = F.lit(model.slope) * F.log1p(TOTAL) + F.lit(model.bias)
    return _totals(docs, model.lexicon, keep).withColumn("score", 1 / (1 + F.exp(-logit))).drop(TOTAL)


def kept_documents(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below ``limit``."""
    logit = math.log(limit / (1 - limit))
    below = F.lit(model.slope) * F.log1p(TOTAL) + F.lit(model.bias) < logit
    return _totals(docs, model.lexicon, docs.columns).where(below).drop(TOTAL)
