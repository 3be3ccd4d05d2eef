"""Quality rules on hosts.

Every document is held against word, repetition, symbol and line rules. The failures are
summed per host, each host's failure rate is shrunk towards an empirical beta prior
fitted to all hosts by moments, and the host's verdict goes back to its documents.

Hot hosts: the sums combine before the shuffle (one row a host and task) and the verdict
is joined with a salt on both sides.

Cases: null and empty texts have no words and fail the word rule; a null host is a host
of its own; one host or equal rates give a prior of ``PRIOR_ROWS`` rows at the mean;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import SPACE, stored, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 30
MAX_HOST_RATE = 0.5
PRIOR_ROWS = 10.0
SALTS = 16


def _windows(w: Column) -> Column:
    """64-bit hashes of the 3-word windows, in text order."""
    return F.when(F.size(w) >= 3, F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]))).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, host: str) -> DataFrame:
    """The counts of every document: words, characters in words, symbols, lines, repetitions."""
    t = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.col(host).alias("host"), t.alias("t")).withColumn("w", words(F.col("t")))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    base = base.select(
        "doc_id", "host", F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), _windows(F.col("w")).alias("hashes"))
    # Only texts with a repeated window are sorted: (hash, position) pairs in hash order.
    base = base.withColumn("pairs", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    base = base.withColumn("at", F.sort_array(F.filter(F.transform("pairs", lambda x, k: F.when(
        (F.get("pairs", k - 1)["h"] == x["h"]) | (F.get("pairs", k + 1)["h"] == x["h"]), x["i"])),
        lambda p: p.isNotNull())))
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return base.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def judged(counts: DataFrame) -> DataFrame:
    """``base_failed`` and ``rule_failed`` (any rule) of every document."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    more = ((100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines")))
    return counts.withColumn("base_failed", base).withColumn("rule_failed", base | more)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior by the moments of the hosts' failure rates: two numbers reach the driver."""
    m = hosts.agg(F.avg(F.col("failed") / F.col("rows")).alias("m"),
                  F.var_pop(F.col("failed") / F.col("rows")).alias("v")).first()
    if m is None or m["m"] is None:
        return PRIOR_ROWS / 2, PRIOR_ROWS / 2
    mean, var = float(m["m"]), float(m["v"])
    strength = mean * (1 - mean) / var - 1 if var > 0 else PRIOR_ROWS
    strength = strength if strength > 0 else PRIOR_ROWS
    return mean * strength, (1 - mean) * strength


def host_verdicts(marked: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per host: rows, failures, shrunk failure rate, and whether the host is kept."""
    hosts = marked.groupBy("host").agg(
        F.count("*").alias("rows"), F.sum(F.col("rule_failed").cast("long")).alias("failed"))
    hosts = stored(hosts, "hosts")
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(a)) / (F.col("rows") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn("host_kept", F.col("rate") <= max_rate)


def filter_by_host(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, rules and verdict of every document."""
    marked = stored(judged(measured(docs, host)), "rules")
    verdicts = host_verdicts(marked, max_rate).select(
        F.col("host").alias("h"), "rate", "host_kept",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salted = marked.withColumn("s0", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return (salted.join(verdicts, (F.col("s0") == F.col("s")) & F.col("host").eqNullSafe(F.col("h")))
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
            .drop("s0", "s", "h"))
