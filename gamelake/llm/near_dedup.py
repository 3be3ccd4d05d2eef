"""MinHash near-duplicate groups.

One hash of every shingle fills ``BINS`` bins (one-permutation hashing); an empty bin
takes the value of the first filled bin along a fixed random probe sequence (optimal
densification). ``ROWS`` neighbouring bins form a band, and a band's key a bucket.
Texts with equal shingle sets are one class before any bucket is built, so thousands of
exact copies cost one row.

In each bucket every class is paired with one leader only (a star), never with all
others. The pairs are confirmed on the full sets, and the confirmed links joined into
components. Buckets that still hold several components are looked at again with another
leader, the small ones with all remaining pairs. What is open in large buckets then is
settled without leaders: their classes are dealt into blocks, and every two blocks with a
bucket in common have all pairs of different components counted on the full sets.

At similarity 0.8 a pair shares no bucket with probability (1 - 0.8 ** 4) ** 32 = 5e-8.

Cases: null and blank texts have an empty set and link with nothing; texts shorter than
a shingle are one shingle; repeated ids are rows of their own; a row with a null id links
like any other, and a group without any id has no component id and keeps the text of least
hash; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm import textvec
from gamelake.llm.components import components
from gamelake.llm.tables import discard, free_name, joined_ids, stored

BINS, ROWS = 128, 4
SMALL_BUCKET = 16
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 1 << 18
OWN_BLOCK = 64          # classes of one component in one bucket that get blocks of their own
FEW = 64                # pairs of a block pair up to which a shingle's are listed
LISTED = 1 << 20        # listed pairs in memory at once
COLUMNS = 2048
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_PROBES = np.random.default_rng(7).integers(0, BINS, (BINS, 4096), dtype=np.int16)


def signature(hashes: np.ndarray) -> np.ndarray:
    """``BINS`` values of a sorted set of hashes, empty bins densified."""
    sig, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    sig[bins[first]] = hashes[first]
    full[bins[first]] = True
    empty = np.flatnonzero(~full)
    for width in (48, _PROBES.shape[1]):  # the short sequences nearly always suffice
        if not len(empty):
            break
        hit = full[_PROBES[empty, :width]]
        found = hit.any(1)
        sig[empty[found]] = sig[_PROBES[empty[found], hit[found].argmax(1)]]
        empty = empty[~found]
    sig[empty] = hashes[0]
    return sig


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key for each band of each set's signature."""
    parts = textvec.mix(np.stack([signature(s) for s in sets])).reshape(len(sets), -1, ROWS)
    key = np.arange(BINS // ROWS, dtype=np.uint64)[None, :]
    for j in range(ROWS):
        key = textvec.mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return key


def _digests(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """One number for each set, 0 for the empty set."""
    size = np.array([len(s) for s in sets], np.int64)
    out, full = np.zeros(len(sets), np.uint64), size > 0
    if full.any():
        begin = (np.cumsum(size) - size)[full]
        sums = np.add.reduceat(textvec.mix(np.concatenate(sets) + np.uint64(seed)), begin)
        out[full] = textvec.mix(sums + size[full].astype(np.uint64))
    return out.view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, row, n_shingles, c1, c2, keys): c1 and c2 name the set, keys its buckets, row the id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                sets = textvec.shingle_sets(textvec.words(data, offsets, lower=True), shingle)
                full = [i for i, x in enumerate(sets) if len(x)]
                keys = [np.zeros(0, np.uint64)] * len(sets)
                for i, k in zip(full, band_keys([sets[i] for i in full]) if full else [], strict=True):
                    keys[i] = k
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("row").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_digests(sets, 1)), pa.array(_digests(sets, 2)), textvec.long_lists(keys),
                ], ["doc_id", "row", "n_shingles", "c1", "c2", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text", row_hash().alias("row")).mapInArrow(
        run, "doc_id long, row long, n_shingles long, c1 long, c2 long, keys array<long>")


def row_hash() -> Column:
    """Names a row by its id, null or not, and its text; only equal rows share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), "text")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(c1, set) of the texts, c1 taken from the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                sets = textvec.shingle_sets(textvec.words(data, offsets, lower=True), shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(sets, 1)), textvec.long_lists(sets)], ["c1", "set"])

    return texts.select("text").mapInArrow(run, "c1 long, set array<long>")


def _confirmed(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], pct: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the similarity."""
    asked = pairs.select(F.col("a").alias("c1")).unionByName(pairs.select(F.col("b").alias("c1"))).distinct()
    sets = stored(sets_of(asked), "sets")
    left = sets.select(F.col("c1").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("c1").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    links = stored(pairs.join(left, "a").join(right, "b")
                   .where(100 * both >= pct * (F.size("sa") + F.size("sb") - both)).select("a", "b"), "links")
    discard(sets)
    return links


def _star(members: DataFrame, turn: int) -> DataFrame:
    """Each bucket's classes paired with its leader.

    The leader is least by a hash that changes each turn, the same for all buckets, so that
    a group's buckets mostly agree on a leader.
    """
    rank = F.struct(F.xxhash64("c1", F.lit(turn)), "c1", "part")
    leaders = members.groupBy("key").agg(F.min(rank).alias("least"), F.count("*").alias("n")).where("n > 1").select(
        "key", F.col("least.c1").alias("leader"), F.col("least.part").alias("leader_part"))
    return (members.join(leaders, "key").where("part != leader_part")
            .select(F.least("c1", "leader").alias("a"), F.greatest("c1", "leader").alias("b")).distinct())


def _all_left(members: DataFrame) -> DataFrame:
    """All pairs of different components in buckets of at most ``SMALL_BUCKET`` classes."""
    small = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= SMALL_BUCKET).drop("n")
    kept = members.join(small, "key")
    other = kept.select("key", F.col("c1").alias("b"), F.col("part").alias("other_part"))
    return (kept.join(other, "key").where((F.col("c1") < F.col("b")) & (F.col("part") != F.col("other_part")))
            .select(F.col("c1").alias("a"), "b").distinct())


def _unsettled(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    open_keys = members.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y")
    return members.join(open_keys.select("key"), "key")


def _large(members: DataFrame) -> DataFrame:
    """Members of the buckets whose pairs are not all tested, those over ``SMALL_BUCKET``."""
    keys = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SMALL_BUCKET).select("key")
    return members.join(keys, "key")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left has in common with each on the right.

    Shingles of few pairs have them listed, the others are columns of a matrix product.
    """
    n, m = len(left), len(right)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    every = np.concatenate([*left, *right])
    distinct, token = np.unique(every, return_inverse=True)
    tokens = token[:len(rows[0])], token[len(rows[0]):]
    count = [np.bincount(t, minlength=len(distinct)) for t in tokens]
    product = count[0] * count[1]
    out = np.zeros((n, m), np.float32)
    listed = (product > 0) & (product <= FEW)
    mine, other = (listed[t] for t in tokens)
    if mine.any():
        order = np.argsort(tokens[0][mine], kind="stable")
        row = rows[0][mine][order]
        t = tokens[1][other]
        size = np.where(listed, count[0], 0)
        first = np.cumsum(size) - size
        times = count[0][t]
        ends, of = np.cumsum(times), rows[1][other]
        cuts = np.unique(np.searchsorted(ends, np.arange(LISTED, ends[-1], LISTED)))
        for part in np.split(np.arange(len(t)), cuts):
            size = times[part]
            at = np.repeat(first[t[part]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out += np.bincount(row[at] * m + np.repeat(of[part], size), minlength=n * m).reshape(n, m)
    dense = np.flatnonzero(product > FEW)
    for k in range(0, len(dense), COLUMNS):
        column = np.full(len(distinct), -1)
        part = dense[k:k + COLUMNS]
        column[part] = np.arange(len(part))
        sides = []
        for t, r, size in zip(tokens, rows, (n, m), strict=True):
            x = np.zeros((size, len(part)), np.float32)
            of = column[t]
            x[r[of >= 0], of[of >= 0]] = 1
            sides.append(x)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _block(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Classes, components and sets of one block."""
    c1, part, sets = rows.values.flatten()
    ends = np.cumsum(sets.value_lengths().to_numpy())
    return c1.to_numpy(), part.to_numpy(), np.split(sets.flatten().to_numpy(), ends[:-1])


def _exact_links(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], pct: int) -> DataFrame:
    """Links (a, b) among all pairs of different components that share a bucket of ``members``.

    A class goes to blocks of its largest bucket, so that the many buckets of one group
    compare two blocks once. Only blocks and pairs of blocks are rows, never pairs of classes.
    """
    most = members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("c1", "part").agg(
        F.max(F.struct("n", "key")).alias("most")).select("c1", "part", F.col("most.key").alias("home"))
    own = whole = stored(most.join(sets_of(most.select("c1")), "c1"), "sets")
    many = own.groupBy("home", "part").agg(F.count("*").alias("n")).where(F.col("n") >= OWN_BLOCK).select(
        "home", "part", F.lit(True).alias("many"))
    own = own.join(many, ["home", "part"], "left").withColumn(
        "home", F.xxhash64("home", F.when(F.col("many"), F.col("part"))))
    room = own.groupBy("home").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_CLASSES, F.sum(F.size("set")) / BLOCK_SHINGLES)).alias("blocks"))
    own = own.join(room, "home").withColumn("block", F.xxhash64("home", F.pmod(F.xxhash64("c1"), "blocks")))
    blocks = stored(own.groupBy("block").agg(F.collect_list(F.struct("c1", "part", "set")).alias("rows")), "blocks")
    discard(whole)
    homes = blocks.select("block", F.explode("rows.c1").alias("c1"))
    met = stored(members.join(homes, "c1").groupBy("key", "block").agg(
        F.min("part").alias("x"), F.max("part").alias("y")), "met")
    other = met.select("key", F.col("block").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    both = stored(met.join(other, "key").where(
        (F.col("block") <= F.col("other")) & (F.least("x", "ox") != F.greatest("y", "oy")))
        .select("block", "other").distinct(), "block-pairs")
    discard(met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("rows"), batch.column("others"), strict=True):
                (a, pa_, sa), (b, pb, sb) = _block(left), _block(right)
                n = _common(sa, sb)
                size = np.array([len(s) for s in sa])[:, None] + np.array([len(s) for s in sb])[None, :]
                i, j = np.nonzero((100 * n >= pct * (size - n)) & (pa_[:, None] != pb[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(b[j])], ["a", "b"])

    links = stored(both.join(blocks, "block").join(
        blocks.select(F.col("block").alias("other"), F.col("rows").alias("others")), "other")
        .select("rows", "others").mapInArrow(run, "a long, b long"), "links")
    discard(both, blocks)
    return links


def _joined(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links, each round over its new links only; replaces ``parts``."""
    if parts is None:
        return stored(components(links), "components")
    ends = links
    for c in ("a", "b"):
        known = parts.select(F.col("node").alias(c), F.col("component").alias(f"p{c}"))
        ends = ends.join(known, c, "left").withColumn(f"p{c}", F.coalesce(f"p{c}", c))
    moved = components(ends.select("pa", "pb"))
    old = parts.join(moved.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
    old = old.select("node", F.coalesce("c", "component").alias("component"))
    new = moved.join(parts, "node", "left_anti")
    joined = stored(old.unionByName(new), "components")
    discard(parts)
    return joined


def settled(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], pct: int) -> DataFrame | None:
    """Components (node, component) of classes that share a bucket and reach the similarity.

    ``members``: (key, c1, part), each class of a bucket once, ``part`` the class itself.
    ``sets_of`` gives (c1, set) of the classes ``c1`` that it is asked for. No link, no table.
    """
    tried, parts, given = None, None, members
    for turn in range(3):
        if turn == 2:  # the small buckets are done with; what is open in the large ones is settled
            links = _exact_links(members, sets_of, pct)
        else:
            pairs = _star(members, turn)
            if turn == 1:
                pairs = pairs.unionByName(_all_left(members)).distinct().join(tried, ["a", "b"], "left_anti")
            pairs = stored(pairs, "pairs")
            if tried is not None:
                discard(tried)
            tried = pairs
            links = _confirmed(tried, sets_of, pct)
        if links.take(1):
            parts = _joined(parts, links)
        discard(links)
        if turn == 2:
            break
        before = members
        if parts is not None:
            members = members.drop("part").join(parts.withColumnRenamed("node", "c1"), "c1", "left").select(
                "key", "c1", F.coalesce("component", "c1").alias("part"))
        members = stored(_unsettled(_large(members) if turn else members), "unsettled")
        if before is not given:
            discard(before)
        if not members.take(1):
            break
    return parts


def near_duplicates(docs: DataFrame, shingle: int = 5, pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every row of ``docs``."""
    return _grouped(docs, shingle, pct).drop("row")


def _grouped(docs: DataFrame, shingle: int, pct: int) -> DataFrame:
    """As ``near_duplicates``, with the ``row_hash`` of each row.

    A group's representative is its least id; without any id, its least row hash.
    """
    sketched = stored(sketches(docs, shingle), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    classes = stored(sketched.where("n_shingles > 0").groupBy("c1", "c2").agg(
        F.min(first).alias("first"), F.first("keys").alias("keys")), "classes")
    buckets = classes.select("c1", F.explode("keys").alias("key"))
    # Only keys of at least two classes matter from here on.
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(buckets.join(shared, "key").withColumn("part", F.col("c1")), "buckets")

    def sets_of(asked: DataFrame) -> DataFrame:
        rows = classes.join(asked, "c1").select(F.col("first.row").alias("row")).distinct()
        texts = joined_ids(docs.select("text", row_hash().alias("row")), rows, "left_semi", "row")
        return _sets(texts, shingle).dropDuplicates(["c1"])

    parts = settled(members, sets_of, pct)
    discard(members)
    named = classes.select("c1", "c2", "first")
    if parts is not None:
        group = (named.join(parts.withColumnRenamed("node", "c1"), "c1", "left")
                 .withColumn("part", F.coalesce("component", "c1")))
        least = group.groupBy("part").agg(F.min("first").alias("least"))
        named = group.join(least, "part").select("c1", "c2", F.col("least").alias("first"))
    rows = sketched.drop("keys").join(named, ["c1", "c2"], "left")
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    # Without an id in the group, the rows equal to the representative are kept.
    kept = F.when(component.isNotNull(), F.coalesce(F.col("doc_id") == component, F.lit(False))).otherwise(
        F.col("first").isNull() | (F.col("row") == F.col("first.row")))
    return rows.select(
        "doc_id", "row", "n_shingles", component.alias("component_id"), kept.alias("kept"),
        F.when(F.col("n_shingles") > 0, F.col("c1")).alias("class_id"))


def kept_documents(docs: DataFrame, shingle: int = 5, pct: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id.

    Rows that share an id are judged apart, each by its own text; those equal in id and text
    count once. A row without an id goes where its group has an id, or another text without
    one that comes first by its hash; equal texts without an id count once. Blank texts
    without an id all stay.
    """
    name = free_name(docs, "row")
    rows = _grouped(docs, shingle, pct).groupBy("row").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n"),
        F.max(F.col("doc_id").isNotNull() | (F.col("n_shingles") > 0)).alias("once"))
    rows = stored(rows, "groups")
    keyed = docs.withColumn(name, row_hash())
    left = joined_ids(keyed, rows.where("NOT kept").select(F.col("row").alias(name)), "left_anti", name)
    many = rows.where("kept AND n > 1 AND once").select(F.col("row").alias(name))
    if not many.take(1):
        return left.drop(name)
    one = joined_ids(left, many, "left_semi", name).dropDuplicates([name])
    return joined_ids(left, many, "left_anti", name).unionByName(one).drop(name)
