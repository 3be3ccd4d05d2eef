"""Substring dedup: passages that repeat across documents, by banded paragraphs and exact Jaccard.

Paragraphs are content-defined, so that a passage pasted anywhere yields the same ones: a
paragraph begins at a word whose pair hash is the least among its ``reach`` neighbours on
either side. There are two scales. Fine paragraphs (``FINE``, about 9 words) find equal
text. Coarse ones (``COARSE``, about 41 words, each a row of fine ones) find edited text:
the set of their ``SHINGLE``-word shingles gets a MinHash signature in bands of ``ROWS``,
as many as ``RECALL`` asks for at the similarity (``bands``). Of the paragraphs that collide
all pairs of different components are settled by ``near_dedup.settled`` with exact Jaccard
similarity on the full sets, and the links joined into components.

Every paragraph whose component occurs first in another document is a repeat. Runs of
repeats grow word by word on either side as far as the words equal those around the first
occurrence, at most ``EDGE`` words; runs at most ``GAP`` words apart are one. Those of at
least ``MIN_WORDS`` words are removed, the first occurrence stays. Equal paragraphs on either
side are in the run already, so what is left to grow is part of one paragraph.

Only hashes and positions are shuffled, and beside them the texts that hold a run or a first
occurrence, once; sums and minima combine first, so a passage that is in a third of all
documents costs one row a task; the join back is an equi-join that AQE splits when skewed.

The texts are read five times: for the bands of distinct paragraphs, for the sets of the few that
share one, for first documents, for the repeats, and for the words around the runs. Tables are
deleted when they have been read.

Cases: null and blank texts stay as they are; a passage repeated inside one document
only is left alone; rows of one id are one document for that, but each row is cut by its own
ranges, found by its id and a hash of its text; a null id stays and loses nothing;
an empty table gives an empty result; extra columns are kept by ``remove_passages``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm import near_dedup, textvec
from gamelake.llm.tables import discard, free_name, joined_ids, release, stored

SHINGLE, PCT = 5, 80
FINE, COARSE = 4, 20
ROWS, RECALL = 3, 0.999
EDGE, GAP = 32, 3
MIN_WORDS = 16
SPAN_BYTES = 32 << 20  # spans or positions of all documents together that may be broadcast
_STEP = np.uint64(0xD6E8FEB86659FD93)


def bands(pct: int, recall: float = RECALL) -> int:
    """How many bands of ``ROWS`` let a pair at the similarity collide with that probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (pct / 100) ** ROWS) - 1e-9))


def band_keys(hashes: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """``n`` keys of each set; the sets lie one after the other, each from its ``begin`` on."""
    odd = textvec.mix(np.arange(1, n * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((len(begin), n), np.uint64)
    for k in range(n):
        key = np.full(len(begin), k, np.uint64)
        for j in range(ROWS):
            least = np.minimum.reduceat(hashes * odd[k * ROWS + j], begin)
            key = textvec.mix(key * _STEP + textvec.mix(least))
        out[:, k] = key
    return out


def paragraph_starts(w: textvec.Words, reach: int = FINE) -> np.ndarray:
    """First words of the paragraphs of all texts, in order."""
    n = len(w.doc)
    if not n:
        return np.zeros(0, np.int64)
    pair = w.hash.copy()
    pair[1:] = textvec.mix(w.hash[:-1] * _STEP + w.hash[1:])
    new = np.ones(n, bool)
    new[1:] = w.doc[1:] != w.doc[:-1]
    pair[new] = w.hash[new]  # not with the last word of the text before
    least = np.ones(n, bool)
    for k in range(1, reach + 1):
        least[k:] &= pair[k:] < pair[:-k]
        least[:-k] &= pair[:-k] <= pair[k:]
    first = w.bounds()
    inside = np.arange(n) - first[w.doc] >= reach
    inside &= first[w.doc + 1] - np.arange(n) > reach
    return np.flatnonzero(new | (least & inside))


def _owns(w: textvec.Words, at: np.ndarray, size: np.ndarray, reach: int) -> np.ndarray:
    """Content hash of each paragraph: a sum over words, each mixed with its place; scales differ."""
    place = (np.arange(len(w.doc)) - np.repeat(at, size)).astype(np.uint64)
    total = np.add.reduceat(textvec.mix(w.hash + textvec.mix(place)), at)
    return textvec.mix(total + size.astype(np.uint64) + textvec.mix(np.uint64([reach])))


def paragraphs(docs: DataFrame, reaches: tuple[int, ...] = (FINE,)) -> DataFrame:
    """(doc_id, text_hash, at, words, own, reach): ranges of words and their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                w = textvec.words(data, offsets, lower=True)
                for reach in reaches:
                    at = paragraph_starts(w, reach)
                    if not len(at):
                        continue
                    size = np.diff(np.append(at, len(w.doc)))
                    doc = w.doc[at]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                        batch.column("text_hash").slice(a, b - a).take(pa.array(doc)),
                        pa.array((at - w.bounds()[doc]).astype(np.int32)), pa.array(size.astype(np.int32)),
                        pa.array(_owns(w, at, size, reach).view(np.int64)), pa.array(np.full(len(at), reach, np.int32)),
                    ], ["doc_id", "text_hash", "at", "words", "own", "reach"])

    return _rows(docs).mapInArrow(
        run, "doc_id long, text_hash long, at int, words int, own long, reach int")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_hash) of the rows with an id."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).where("doc_id IS NOT NULL")


def _coarse(w: textvec.Words, pct: int):
    """Hashes of the coarse paragraphs that are long enough to be near another one, their
    shingles one after the other, and where each one's begin.

    Below a number of shingles the similarity needs equal sets, which already are one paragraph.
    """
    at = paragraph_starts(w, COARSE)
    size = np.diff(np.append(at, len(w.doc)))
    least = math.ceil(1 / (1 - pct / 100) - 1e-9) + SHINGLE - 1
    long = size >= least
    if not long.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own, at, count = _owns(w, at, size, COARSE)[long], at[long], size[long] - SHINGLE + 1
    m = len(w.doc) - SHINGLE + 1
    h = w.hash[:m]
    for j in range(1, SHINGLE):
        h = textvec.mix(h * _STEP + w.hash[j:j + m])
    begin = np.cumsum(count) - count
    return own, h[np.repeat(at - begin, count) + np.arange(count.sum())], begin


def _banded(docs: DataFrame, pct: int, recall: float) -> DataFrame:
    """(c1, keys) of the coarse paragraphs."""
    n = bands(pct, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in textvec.slices(batch.column("text")):
                own, h, begin = _coarse(textvec.words(data, offsets, lower=True), pct)
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), textvec.long_lists(list(band_keys(h, begin, n)))], ["c1", "keys"])

    return _rows(docs).select("text").mapInArrow(run, "c1 long, keys array<long>")


def _sets(docs: DataFrame, pct: int) -> DataFrame:
    """(own, set) of the coarse paragraphs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in textvec.slices(batch.column("text")):
                own, h, begin = _coarse(textvec.words(data, offsets, lower=True), pct)
                if len(own):
                    parts = [np.unique(x) for x in np.split(h, begin[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), textvec.long_lists(parts)], ["own", "set"])

    return _rows(docs).select("text").mapInArrow(run, "own long, set array<long>")


def _near_parts(docs: DataFrame, pct: int, recall: float) -> DataFrame | None:
    """Components (node, component) of the different coarse paragraphs that reach the similarity."""
    if pct >= 100:
        return None
    classes = stored(_banded(docs, pct, recall).dropDuplicates(["c1"]), "classes")
    release(docs.sparkSession)
    every = classes.select("c1", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")  # a class has a key once
    members = stored(joined_ids(every, shared, "left_semi", "key").withColumn("part", F.col("c1")), "buckets")
    discard(classes)
    open_ = members.select(F.col("c1").alias("own")).distinct()
    sets = stored(joined_ids(_sets(docs, pct), open_, "left_semi", "own").dropDuplicates(["own"])
                  .withColumnRenamed("own", "c1"), "sets")
    parts = near_dedup.settled(members, lambda asked: sets.join(asked, "c1", "left_semi"), pct)
    discard(members, sets)
    return parts


def _joined_positions(docs: DataFrame, side: DataFrame, size: int) -> DataFrame:
    """Rows of ``docs`` with what belongs to their id and text; broadcast up to ``SPAN_BYTES``."""
    return _rows(docs).join(F.broadcast(side) if size <= SPAN_BYTES else side, ["doc_id", "text_hash"])


def _around(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, side, component, first, hashes, base, bytes): the words outward from border ``at``.

    ``side`` 0 goes left, 1 right; the k-th hash is of the next k words, and the range that
    ends at byte ``base`` ends ``bytes[k]`` further when it grows by k words.
    """
    packed = stored(asked.groupBy("doc_id", "text_hash").agg(F.collect_set(
        F.struct((F.col("at") * 2 + F.col("side")).alias("border"), "component", "first")).alias("borders")), "borders")
    size = packed.agg(F.sum(24 + 16 * F.size("borders"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                w = textvec.words(data, offsets, lower=True)
                lists = batch.column("borders").slice(a, b - a)
                doc = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy())
                border, component, first = lists.flatten().flatten()
                border = border.to_numpy()
                at, right = border >> 1, (border & 1) == 1
                bounds, last = w.bounds(), len(w.doc) - 1
                p, low, high = bounds[doc] + at, bounds[doc], bounds[doc + 1]
                base = np.where(right, w.end[p - 1], w.start[np.minimum(p, last)])
                h, hashes, ends, more = np.zeros(len(doc), np.uint64), [], [np.zeros(len(doc), np.int64)], []
                for k in range(EDGE):
                    i = np.where(right, p + k, p - 1 - k)
                    more.append((i >= low) & (i < high))
                    i = np.clip(i, 0, last)
                    h = textvec.mix(h * _STEP + w.hash[i])
                    hashes.append(h.astype(np.uint32))
                    ends.append(np.abs(np.where(right, w.end[i], w.start[i]) - base))
                ok = np.array(more).T
                stop = np.concatenate([[0], np.cumsum(ok.sum(1))]).astype(np.int32)
                held = np.hstack([np.ones((len(doc), 1), bool), ok])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                    batch.column("text_hash").slice(a, b - a).take(pa.array(doc)),
                    pa.array(at.astype(np.int32)), pa.array(right.astype(np.int32)), component, first,
                    pa.ListArray.from_arrays(pa.array(stop), pa.array(np.array(hashes).T[ok].view(np.int32))),
                    pa.array(base - offsets[doc]),
                    pa.ListArray.from_arrays(pa.array(stop + np.arange(len(stop), dtype=np.int32)),
                                             pa.array(np.array(ends).T[held].astype(np.int32))),
                ], ["doc_id", "text_hash", "at", "side", "component", "first", "hashes", "base", "bytes"])

    return _joined_positions(docs, packed, size).select("doc_id", "text_hash", "text", "borders").mapInArrow(
        run, "doc_id long, text_hash long, at int, side int, component long, first boolean, "
             "hashes array<int>, base long, bytes array<int>")


def _islands(rows: DataFrame, gap: int) -> DataFrame:
    """``rows`` with ``run``: ranges of words of one text that lie at most ``gap`` words apart have one number."""
    before = Window.partitionBy("doc_id", "text_hash").orderBy("at", "stop_at").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("doc_id", "text_hash").orderBy("at", "stop_at")
    begins = F.when(F.col("at") <= F.max("stop_at").over(before) + gap, 0).otherwise(1)
    return rows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order)).drop("begins")


def _grown(docs: DataFrame, runs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``runs`` moved outward over equal words, with their byte ranges ``start`` to ``stop``.

    Rows with one id and text come more than once out of ``_around``; the maxima take one.
    """
    sides = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("at").alias("at"), F.col("left_of").alias("component")),
        F.struct(F.lit(1).alias("side"), F.col("stop_at").alias("at"), F.col("right_of").alias("component")))).alias("x")
    edges = runs.select("doc_id", "text_hash", sides).select("doc_id", "text_hash", "x.*", F.lit(False).alias("first"))
    models = edges.select("component", "side").distinct().join(firsts, "component").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), "side",
        F.when(F.col("side") == 0, F.col("first.at")).otherwise(F.col("first.stop_at")).alias("at"),
        "component", F.lit(True).alias("first"))
    around = stored(_around(docs, edges.unionByName(models)), "around")
    model = around.where("first").select("component", "side", F.col("hashes").alias("model")).dropDuplicates(["component", "side"])
    same = F.size(F.filter(F.arrays_zip("hashes", "model"), lambda x: x["hashes"] == x["model"]))
    moved = around.where("NOT first").join(model, ["component", "side"]).withColumn("k", same).withColumn(
        "further", F.element_at("bytes", F.col("k") + 1)).groupBy("doc_id", "text_hash", "at", "side").agg(
        F.max("k").alias("k"), F.max("further").alias("further"), F.max("base").alias("base"))
    left = moved.where("side = 0").select("doc_id", "text_hash", "at", (F.col("at") - F.col("k")).alias("new_at"),
                                          (F.col("base") - F.col("further")).alias("start"))
    right = moved.where("side = 1").select("doc_id", "text_hash", F.col("at").alias("stop_at"),
                                           (F.col("at") + F.col("k")).alias("new_stop"), (F.col("base") + F.col("further")).alias("stop"))
    return runs.join(left, ["doc_id", "text_hash", "at"]).join(right, ["doc_id", "text_hash", "stop_at"]).select(
        "doc_id", "text_hash", "first_doc", F.col("new_at").alias("at"), F.col("new_stop").alias("stop_at"), "start", "stop")


def repeated_passages(docs: DataFrame, pct: int = PCT, min_words: int = MIN_WORDS,
                      recall: float = RECALL) -> DataFrame:
    """(doc_id, text_hash, start, stop, words, first_doc): byte ranges that repeat an earlier document.

    The earliest document is the one with the least id. ``recall`` is the least probability
    that two coarse paragraphs at the similarity share a band.
    """
    parts = _near_parts(docs, pct, recall)
    found = paragraphs(docs, (FINE,) if parts is None else (FINE, COARSE))
    if parts is None:
        parts = docs.sparkSession.createDataFrame([], "node long, component long")
    ends = found.groupBy("own").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.min("reach").alias("reach"))
    # Only fine paragraphs that lie in two documents, and coarse ones linked to another, can repeat.
    named = stored(ends.join(parts.withColumnRenamed("node", "own"), "own", "left")
                   .where(F.col("component").isNotNull() | ((F.col("reach") == FINE) & (F.col("first_doc") != F.col("last_doc"))))
                   .select("own", "first_doc", F.coalesce("component", "own").alias("component")), "named")
    release(docs.sparkSession)
    least = named.groupBy("component").agg(F.min("first_doc").alias("first_doc"))
    repeats = named.select("own", "component").join(least, "component").select("own", "component", "first_doc")
    marked = stored(joined_ids(found.drop("reach"), repeats, "inner", "own").select(
        "doc_id", "text_hash", "at", (F.col("at") + F.col("words")).alias("stop_at"), "component", "first_doc"), "marked")
    discard(named)
    firsts = stored(marked.where("doc_id = first_doc").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_hash", "at", "stop_at")).alias("first")), "firsts")
    later = marked.where("doc_id != first_doc").groupBy("doc_id", "text_hash", "at", "stop_at").agg(
        F.min("component").alias("component"), F.min("first_doc").alias("first_doc"))
    runs = stored(_islands(later, 0).groupBy("doc_id", "text_hash", "run").agg(
        F.min("at").alias("at"), F.max("stop_at").alias("stop_at"),
        F.min("first_doc").alias("first_doc"), F.min(F.struct("at", "component"))["component"].alias("left_of"),
        F.max(F.struct("stop_at", "component"))["component"].alias("right_of")), "runs")
    discard(marked)
    whole = _islands(_grown(docs, runs, firsts), GAP).groupBy("doc_id", "text_hash", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"),
        (F.max("stop_at") - F.min("at")).alias("words"), F.min("first_doc").alias("first_doc"))
    return whole.where(F.col("words") >= min_words).drop("run")


def spans(repeats: DataFrame) -> DataFrame:
    """Per document row its repeats in order, as one array."""
    return repeats.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "words", "first_doc"))).alias("spans"))


def remove_passages(docs: DataFrame, **more) -> DataFrame:
    """The documents with their repeated passages cut out; other columns stay.

    The spans are broadcast up to ``SPAN_BYTES`` of them; beyond, it is a plain equi-join.
    """
    name, of_id, of_text = (free_name(docs, c) for c in ("spans", "of_id", "of_text"))
    cut = stored(spans(repeated_passages(docs, **more)).select(
        F.col("spans").alias(name), F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_text)), "spans")
    size = cut.agg(F.sum(16 + 32 * F.size(name))).first()[0] or 0
    raw, end = F.encode("text", "utf-8"), F.octet_length("text").cast("long")
    # What lies between two spans, before the first and behind the last.
    stops = F.concat(F.array(F.lit(0).cast("long")), F.transform(name, lambda s: s["stop"]))
    starts = F.concat(F.transform(name, lambda s: s["start"]), F.array(end))
    parts = F.zip_with(stops, starts, lambda a, b: F.substring(raw, a.cast("int") + 1, (b - a).cast("int")))
    text = F.aggregate(parts, F.lit("").cast("binary"), lambda x, y: F.concat(x, y)).cast("string")
    both = docs.join(F.broadcast(cut) if size <= SPAN_BYTES else cut,
                     (docs["doc_id"] == F.col(of_id)) & (F.xxhash64(docs["text"]) == F.col(of_text)), "left")
    return both.withColumn("text", F.when(F.col(name).isNotNull(), text).otherwise(F.col("text"))).drop(name, of_id, of_text)
