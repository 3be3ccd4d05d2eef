"""Spelling variant grouping by pairs of trie nodes.

A word is cut before and after a position; what stands before is a node of the forward trie
of all words, what stands after a node of the trie of the reversed words. Both tries are
numbered, so a cut is a pair of integers (prefix node, suffix node). Words that share a pair
across one skipped position differ by a replaced code point; a word whose pair across a
skipped position is another word's pair across none has one code point more. Equal pairs
mean equal strings, so the neighbours are exact.

Numbering: the words are dealt by range into parts of about ``PART_WORDS`` in sorted order, and
each part walks its words once, holding only the path to the current word. A node that
spans parts is a prefix of the first word of one of them and is numbered from that list (one
word a part); all others get the part and a running number. Only nodes under which another
word lies are kept, for no other word can share the rest.

A pair is shared by at most one word a code point of the alphabet (90) across a skip, and by
at most one word across none, so no group is hot, and counts and the best neighbour are
taken inside it without making pairs of words. Of the positions of a run of equal code points
only the last stands for a deletion, so that each neighbour is counted once.

Defined cases: null texts have no words; a null id is the empty string in the hash; ties of
the most frequent neighbour go to the least word; words of any length are whole (a task holds
the path of one word); an empty table gives no rows; repeated rows count each; other columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import UPPER, ship, stored

LETTERS = "a-zÀ-ÿ"  # after A-Z are lower-cased
MIN_LENGTH = 5
MIN_COUNT = 3
PART_WORDS = 50_000
MISSPELT = 97  # one run in so many loses a code point, by its hash
NUMBERED = "word string, nodes array<long>"


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run without the code point h % length if 97 divides h = crc32(``doc_id:run``)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % MISSPELT == 0, without).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least ``MIN_LENGTH`` code points with ``MIN_COUNT`` occurrences."""
    # Greedy, so a match is a whole run; shorter runs cannot become words.
    runs = F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(f"[{LETTERS}]{{{MIN_LENGTH},}}"), F.lit(0))
    return (docs.select("doc_id", F.explode(runs).alias("run"))
            .select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
            .where(F.char_length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT))


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def _number(batches: Iterator[pa.RecordBatch], schema: pa.Schema, firsts: list[str], longest: int) -> Iterator[pa.RecordBatch]:
    """Sorted (part, word) -> the numbers of each word's prefixes, from the empty one, as far as others share them."""
    span = longest + 1
    part, word, path, common, made = None, None, [], 0, 0

    def across(depth: int) -> int | None:
        """The number of a prefix of the current word that another part may have too."""
        prefix = word[:depth]
        k = bisect_left(firsts, prefix)
        return -(k * span + depth) - 1 if k < len(firsts) and firsts[k].startswith(prefix) else None

    def nodes(following: int) -> list[int]:
        spans = next((d for d in range(len(path), 0, -1) if path[d - 1] < 0), 0)
        return path[:max(common, following, spans - 1) + 1]

    for batch in batches:
        words, kept = [], []
        for p, w in zip(batch.column("part").to_pylist(), batch.column("word").to_pylist(), strict=True):
            if word is not None:
                new = _shared(word, w) if p == part else 0
                words.append(word)
                kept.append(nodes(new))
                common = new
            if p != part:
                part, path, common, made = p, [], 0, 0
            path, word = path[:common + 1], w
            spanning = not path or path[-1] < 0
            for depth in range(len(path), len(w) + 1):
                number = across(depth) if spanning else None
                if number is None:
                    spanning, made = False, made + 1
                    number = (part << 40) + made
                path.append(number)
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(kept, pa.list_(pa.int64()))], schema=schema)
    if word is not None:
        yield pa.RecordBatch.from_arrays([pa.array([word]), pa.array([nodes(0)], pa.list_(pa.int64()))], schema=schema)


def trie_nodes(words: DataFrame) -> DataFrame:
    """(word, nodes): the trie's numbers of the prefixes of each word that other words share.

    ``words``: a stored table of distinct words. The parts' first words come to the driver,
    one word for ``PART_WORDS``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    size = words.agg(F.count("*").alias("n"), F.coalesce(F.max(F.char_length("word")), F.lit(0)).alias("longest")).first()
    dealt = stored(words.select("word").repartitionByRange(max(1, -(-size["n"] // PART_WORDS)), "word")
                   .withColumn("part", F.spark_partition_id().cast("long")), "parts")
    firsts = sorted(r["first"] for r in dealt.groupBy("part").agg(F.min("word").alias("first")).collect())
    run = partial(_number, schema=to_arrow_schema(StructType.fromDDL(NUMBERED)), firsts=firsts, longest=size["longest"])
    return dealt.repartition("part").sortWithinPartitions("part", "word").mapInArrow(run, NUMBERED)


def _cuts(whole: bool) -> Column:
    """The pairs of a word's shared nodes across no position, or across one skipped one.

    ``kind``: 0 whole, 1 skipped, 2 skipped at the last of a run of equal code points.
    """
    gap = 0 if whole else 1
    length = F.char_length("word")
    first = F.greatest(F.lit(0), length - gap - F.size("s") + 1)
    last = F.least(length - gap, F.size("p") - 1)
    at = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def cut(i: Column) -> Column:
        ends_run = F.substring("word", i + 1, F.lit(1)) != F.substring("word", i + 2, F.lit(1))
        return F.struct(F.element_at("p", i + 1).alias("p"), F.element_at("s", length - gap - i + 1).alias("s"),
                        (F.lit(0) if whole else F.when(ends_run, 2).otherwise(1)).alias("kind"))
    return F.transform(at, cut)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): the number of words one edit away and the most frequent of them.

    ``words``: a stored table (word, n). ``best``: struct (negated n, word), null if none.
    """
    forward = trie_nodes(words).withColumnRenamed("nodes", "p")
    backward = trie_nodes(words.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.col("nodes").alias("s"))
    both = words.join(forward, "word").join(backward, "word")
    cuts = both.select("word", "n", F.inline(F.concat(_cuts(True), _cuts(False))))
    groups = cuts.groupBy("p", "s").agg(F.collect_list(F.struct("word", "n", "kind")).alias("m")).where(F.size("m") > 1)

    def others(x: Column) -> Column:
        return F.filter("m", lambda y: (y["word"] != x["word"]) & (
            ((x["kind"] > 0) & (y["kind"] > 0)) | ((x["kind"] == 2) & (y["kind"] == 0)) | ((x["kind"] == 0) & (y["kind"] == 2))))

    found = groups.select(F.inline(F.transform("m", lambda x: F.struct(
        x["word"].alias("word"), x["n"].alias("n"), F.size(others(x)).cast("long").alias("n_near"),
        F.array_min(F.transform(others(x), lambda y: F.struct((-y["n"]).alias("less"), y["word"].alias("word")))).alias("best")))))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast("struct<less:bigint,word:string>").alias("best"))
    return found.unionByName(none).groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form) by pointer doubling; a form has at least twice the count."""
    ups = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = ups.select(F.col("word").alias("via"), F.col("root").alias("further"))
        ups = stored(ups.select("word", "root").join(up, F.col("root") == F.col("via"), "left")
                     .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not ups.where("moved").limit(1).count():
            return ups.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Every word of the documents with its form, its root and the number of its near words."""
    ship(docs.sparkSession)
    words = stored(vocabulary(docs), "vocabulary")
    twice = -F.col("best.less") >= 2 * F.col("n")
    formed = stored(neighbours(words).select(
        "word", "n", "n_near", F.when(twice, F.col("best.word")).alias("form"), F.when(twice, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
