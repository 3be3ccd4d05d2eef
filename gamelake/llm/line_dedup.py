"""Line dedup: documents probe a sharded minimal perfect hash of all lines.

Every distinct line key has a 128-bit hash (two longs). One pass over the texts makes, for
each bucket of documents, its distinct hashes with the number of documents that have them;
that table feeds the index and is also what the documents ask. Hashes are dealt into shards
of about ``SHARD_KEYS``. A shard's minimal perfect hash is a cascade of bitmaps: keys alone
in their slot of a level stay there, the others go on to the next; a key's number is the rank
of its bit. The number points into two compact arrays, fingerprints (the hash's second
half) and document counts. A shard reads its arrays once and answers its questions in whole
Arrow batches; only hashes to be dropped go back, to the buckets of documents that have them.
Lines themselves are neither shuffled nor joined. Texts move once, to meet the answers of
their bucket, a batch at a time.

Nothing depends on how often a line occurs: a line in a third of all documents is one question
a bucket and one key of one shard. Two different lines would have to share all 128 bits to
be taken for one.

Defined cases: a line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased;
a null or empty text is one empty line and its text becomes empty; keys without characters
are never counted nor dropped; a document is a row, so repeated rows count each; null or
repeated ids do not matter (buckets hash whole rows, and only rows equal in every column must
share one); an empty table gives no rows; other columns pass through, and columns
called ``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from gamelake.llm.tables import ship, stored
from gamelake.llm.textvec import mix

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SHARD_KEYS = 1 << 17
BUCKET_DOCS = 4096
SPREAD = 2  # slots a key in each level
ASKED = "bucket long, h1 long, h2 long, n long"
ARRAYS = "shard long, n_keys long, sizes array<long>, bits binary, fingerprints binary, counts binary"


def line_keys(lines: list[bytes]) -> list[bytes]:
    """The key of every line."""
    return [line.strip(SPACES).lower() for line in lines]


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in column.cast(pa.binary()))


def _ask(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(bucket, text) -> the batch's distinct (bucket, hash) with their number of documents."""
    for batch in batches:
        seen: Counter = Counter()
        for bucket, text in zip(batch.column("bucket").to_pylist(), _texts(batch.column("text")), strict=True):
            digests = {xxhash.xxh3_128_digest(k) for k in line_keys(text.split(b"\n")) if k}
            seen.update((bucket, d) for d in digests)
        if seen:
            halves = np.frombuffer(b"".join(d for _, d in seen), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in seen], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array(list(seen.values()), pa.int64())], schema=schema)


class PerfectHash:
    """Numbers 0..n-1 for n distinct 128-bit keys; other keys get -1 or any number."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.words = bits.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def _slot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(h1 + h2 * step) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        """Levels of bitmaps until every key stands alone in a slot; the keys must be distinct."""
        sizes, levels = [], []
        while len(h1):
            size = -(-SPREAD * len(h1) // 64) * 64
            slot = cls._slot(h1, h2, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = ~alone[slot]
            h1, h2 = h1[left], h2[left]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    def numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of every key, from the first level in which its bit is set."""
        found, left, start = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = start + self._slot(h1[left], h2[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            found[left[here]] = self.before[at[here] >> 6] + np.bitwise_count(below).astype(np.int64)
            left = left[~here]
            start += size
        return found


def _width(most: int) -> int:
    """Bytes a count needs: 1, 2, 4 or 8."""
    return next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)


def _index(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, h1, h2, n) -> one row of arrays a shard."""
    parts: list[pa.Table] = []
    now = None

    def row() -> pa.RecordBatch:
        t = pa.concat_tables(parts)
        h1, h2 = (t.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
        order = PerfectHash.build(h1, h2)
        at = order.numbers(h1, h2)
        n = t.column("n").to_numpy()
        fingerprints, counts = np.empty(len(h1), np.uint64), np.empty(len(h1), f"u{_width(n.max())}")
        fingerprints[at], counts[at] = h2, n
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int64()), pa.array([len(h1)], pa.int64()), pa.array([order.sizes], pa.list_(pa.int64())),
             pa.array([order.bits.tobytes()], pa.binary()), pa.array([fingerprints.tobytes()], pa.binary()),
             pa.array([counts.tobytes()], pa.binary())], schema=schema)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        shards = t.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                if now is not None and shards[a] != now:
                    yield row()
                    parts = []
                now = int(shards[a])
                parts.append(t.slice(a, b - a))
    if parts:
        yield row()


def _answer(batches: Iterator[pa.RecordBatch], schema: pa.Schema, min_docs: int) -> Iterator[pa.RecordBatch]:
    """Each shard's arrays and then its questions -> the hashes of lines to drop, by bucket."""
    now, arrays = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        loads = np.flatnonzero(batch.column("bits").is_valid().to_numpy(zero_copy_only=False))
        cuts = sorted({0, len(shards), *loads, *(loads + 1), *(np.flatnonzero(np.diff(shards)) + 1)})
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a in loads:
                r = batch.slice(a, 1).to_pylist()[0]
                now = r["shard"]
                arrays = (PerfectHash(r["sizes"], np.frombuffer(r["bits"], np.uint8)),
                          np.frombuffer(r["fingerprints"], np.uint64),
                          np.frombuffer(r["counts"], f"u{8 * len(r['counts']) // len(r['fingerprints'])}"))
                continue
            if shards[a] != now:
                continue  # no line of this shard is indexed
            order, fingerprints, counts = arrays
            part = batch.slice(a, b - a)
            h1, h2 = (part.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            at = order.numbers(h1, h2)
            drop = (at >= 0) & (fingerprints[at] == h2) & (counts[at] >= min_docs)
            if drop.any():
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(pa.array(drop)) for c in ("bucket", "h1", "h2")], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each bucket's hashes to drop and then its documents -> documents without those lines."""
    now, drop = None, set()
    names = [f.name for f in schema.field("row").type]
    for batch in batches:
        buckets = batch.column("bucket").to_pylist()
        h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
        keep, texts, n_lines, n_dropped = [], [], [], []
        column = batch.column("row").field("text").cast(pa.binary())
        for i, bucket in enumerate(buckets):
            if bucket != now:
                now, drop = bucket, set()
            if h1[i] is not None:
                drop.add(np.array([h1[i], h2[i]], ">i8").tobytes())
                continue
            lines = (column[i].as_py() or b"").split(b"\n")
            stay = [line for line, k in zip(lines, line_keys(lines), strict=True)
                    if not (drop and k and xxhash.xxh3_128_digest(k) in drop)]
            keep.append(i)
            texts.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        if keep:
            rows = batch.column("row").take(pa.array(keep))
            rows = pa.StructArray.from_arrays(
                [pa.array(texts, pa.binary()).cast(pa.string()) if n == "text" else rows.field(n) for n in names], fields=list(schema.field("row").type))
            yield pa.RecordBatch.from_arrays([rows, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema=schema)


def _map(df: DataFrame, run, schema: str | StructType, **more) -> DataFrame:
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.mapInArrow(partial(run, schema=to_arrow_schema(kind), **more), schema)


def _bucketed(docs: DataFrame) -> DataFrame:
    """(bucket, row): whole rows, dealt into buckets of about ``BUCKET_DOCS`` by their content."""
    n = max(1, -(-docs.count() // BUCKET_DOCS))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.pmod(F.xxhash64(*names), F.lit(n)).alias("bucket"), F.struct(*names).alias("row"))


def questions(docs: DataFrame) -> DataFrame:
    """Every bucket's distinct line hashes, with how many of its documents have them.

    A hash may stand in several rows of a bucket; their counts add up.
    """
    ship(docs.sparkSession)
    return _map(_bucketed(docs).select("bucket", "row.text"), _ask, ASKED)


def line_index(asked: DataFrame) -> DataFrame:
    """The shards' arrays for all hashes of a stored table of questions.

    The number of shards follows the table's rows, an upper bound on its distinct hashes.
    """
    shards = max(1, -(-asked.count() // SHARD_KEYS))
    keys = (asked.groupBy("h1", "h2").agg(F.sum("n").alias("n"))
            .select(F.pmod("h1", F.lit(shards)).cast("long").alias("shard"), "h1", "h2", "n"))
    return _map(keys.repartition("shard").sortWithinPartitions("shard"), _index, ARRAYS).withColumn("shards", F.lit(shards))


def drop_lines(docs: DataFrame, asked: DataFrame, index: DataFrame, min_docs: int = 10) -> DataFrame:
    """Documents without the lines that the index counts in ``min_docs`` documents or more.

    ``asked``: the stored questions of these documents; ``index``: a stored index, of
    these documents or of others. Adds ``n_lines`` (before) and ``n_dropped``.
    """
    shards = index.agg(F.max("shards")).first()[0] or 1
    ask = asked.select(F.pmod("h1", F.lit(shards)).cast("long").alias("shard"), "bucket", "h1", "h2")
    meet = (index.drop("n_keys", "shards").unionByName(ask, allowMissingColumns=True)
            .repartition("shard").sortWithinPartitions("shard", F.col("bits").isNull()))
    drop = _map(meet, _answer, "bucket long, h1 long, h2 long", min_docs=min_docs)
    both = _bucketed(docs).unionByName(drop, allowMissingColumns=True)
    ordered = both.repartition("bucket").sortWithinPartitions("bucket", F.col("h1").isNull())
    out = StructType([StructField("row", docs.schema), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    cut = _map(ordered, _cut, out)
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return cut.select(*(F.col(f"row.`{c}`") for c in names), "n_lines", "n_dropped")


def without_frequent_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """Documents without the lines that ``min_docs`` or more of them have."""
    asked = stored(questions(docs), "lines")
    return drop_lines(docs, asked, stored(line_index(asked), "line-index"), min_docs)
