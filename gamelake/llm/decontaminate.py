"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is the set of its ``SHINGLE``-word shingles (an item with fewer words is one
shingle of its own length). Items are partitioned by set size into powers of two. For
each partition the sketch keeps so many of an item's smallest hashes (its MinHash
values) that a document holding ``pct`` percent of the item misses all of them with
probability at most ``MISS``; items no larger than that keep every hash. A document is
probed with the hashes of all its shingles, so its length does not blur the search, and
every (document, item) pair that shares a sketch value is verified by exact containment
of the full item set.

The items go over all documents in blocks of about ``BLOCK_SHINGLES`` shingles, which
bounds what a task holds; documents are neither shuffled nor sampled.

Cases: null and blank items ask nothing, null and blank documents hold nothing; repeated
items and documents give a row each; a null id stays null; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm import textvec
from gamelake.llm.tables import free_name, stored

SHINGLE = 5
PCT = 80
MISS = 1e-9
BLOCK_SHINGLES = 1 << 20


def item_sets(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, width, set): each item's shingles and how many words a shingle has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                w = textvec.words(data, offsets, lower=True)
                n = np.minimum(np.diff(w.bounds()), shingle)
                of = {k: shingle_lists(w, k) for k in np.unique(n[n > 0])}
                yield pa.RecordBatch.from_arrays([
                    batch.column("item_id").slice(a, b - a), pa.array(n, pa.int32()),
                    textvec.long_lists([np.unique(of[k][i]) if k else np.zeros(0, np.uint64)
                                        for i, k in enumerate(n)]),
                ], ["item_id", "width", "set"])

    found = items.select(F.col("item_id").cast("long"), "text").mapInArrow(
        run, "item_id long, width int, set array<long>")
    return found.where("width > 0")


def shingle_lists(w: textvec.Words, k: int) -> list[np.ndarray]:
    at, h = textvec.shingles(w, int(k))
    cut = np.searchsorted(w.doc[at], np.arange(w.n + 1)) if len(at) else np.zeros(w.n + 1, np.int64)
    return [h[cut[i]:cut[i + 1]] for i in range(w.n)]


def sketch_size(partition: int, pct: int = PCT, miss: float = MISS) -> int:
    """Hashes kept of an item whose set size lies in [2 ** partition, 2 ** (partition + 1))."""
    enough = math.ceil(math.log(miss) / math.log(1 - pct / 100)) if pct < 100 else 1
    return max(enough, 1) if (1 << partition) > enough else (2 << partition) - 1


class Block:
    """The items of one block of one shingle width: sketches to probe, full sets to verify."""

    def __init__(self, ids: list, sets: list[np.ndarray], pct: int):
        self.ids, self.pct = ids, pct
        self.sizes = np.array([len(s) for s in sets], np.int64)
        kept = [s[:sketch_size(int(math.log2(len(s))), pct)] for s in sets]
        self.probe = np.unique(np.concatenate(kept))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.probe >> np.uint64(44)] = True
        every, item = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.hash, self.item = every[order], item[order]

    def search(self, h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared) of the texts of a slice that contain items."""
        maybe = np.flatnonzero(self.bits[h >> np.uint64(44)])
        hit = maybe[np.isin(h[maybe], self.probe)]
        candidate = np.zeros(n, bool)
        candidate[doc[hit]] = True
        none = np.zeros(0, np.int64)
        if not len(hit):
            return none, none, none
        # Exact containment: the distinct shingles of the candidate texts among all items' shingles.
        mine = candidate[doc]
        pair = np.unique(np.stack([doc[mine].astype(np.uint64), h[mine]], 1), axis=0)
        lo, hi = np.searchsorted(self.hash, pair[:, 1], "left"), np.searchsorted(self.hash, pair[:, 1], "right")
        count = hi - lo
        text = np.repeat(pair[:, 0].astype(np.int64), count)
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        key, shared = np.unique(text * len(self.ids) + self.item[at], return_counts=True)
        text, item = key // len(self.ids), key % len(self.ids)
        keep = 100 * shared >= self.pct * self.sizes[item]
        return text[keep], item[keep], shared[keep]


def _search(docs: DataFrame, blocks: dict[int, tuple[list, list]], pct: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {k: Block(ids, sets, pct) for k, (ids, sets) in shared.value.items()}
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                w = textvec.words(data, offsets, lower=True)
                for k, block in ready.items():
                    at, h = textvec.shingles(w, k)
                    text, item, n = block.search(h, w.doc[at], b - a)
                    if len(text):
                        yield pa.RecordBatch.from_arrays([
                            batch.column("doc_id").slice(a, b - a).take(pa.array(text)),
                            pa.array([block.ids[i] for i in item], pa.int64()),
                            pa.array(block.sizes[item]), pa.array(n, pa.int64()),
                        ], ["doc_id", "item_id", "n_item", "n_shared"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, item_id long, n_item long, n_shared long")


def contained_items(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, pct: int = PCT,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): every document that holds ``pct`` percent of an item."""
    sets = stored(item_sets(items, shingle), "items")
    total = sets.agg(F.sum(F.size("set"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_shingles))
    block = F.pmod(F.xxhash64("item_id", "set"), F.lit(n_blocks))
    found = None
    for k in range(n_blocks):
        widths: dict[int, tuple[list, list]] = {}
        for r in sets.where(block == k).collect():  # one block, bounded by block_shingles
            ids, own = widths.setdefault(r["width"], ([], []))
            ids.append(r["item_id"])
            own.append(np.sort(np.array(r["set"], np.int64).view(np.uint64)))
        part = _search(docs, widths, pct)
        found = part if found is None else found.unionByName(part)
    return found


def clean_documents(docs: DataFrame, items: DataFrame, **more) -> DataFrame:
    """The documents that contain no item. Each row is judged by its own text, whatever its id."""
    name = free_name(docs, "row_hash")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    leaks = stored(contained_items(keyed.select(F.col(name).alias("doc_id"), "text"), items, **more)
                   .select("doc_id").distinct(), "leaks")
    leaking = free_name(keyed, "leaking_row")
    return keyed.join(leaks.withColumnRenamed("doc_id", leaking), keyed[name] == F.col(leaking), "left_anti").drop(name)
