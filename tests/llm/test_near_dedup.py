"""Word kernel, components and near-duplicate groups against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gamelake.llm import near_dedup, textvec
from gamelake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t\x0b\x0c\r ", "a", "A", " a ", "a b", "é\xa0b c", "🙂 🙂", "a" * 5000, "x y z " * 9000, "a\x00b \x00"]


def test_words_and_shingles():
    texts = ODD * 3 + ["w%d v" % i for i in range(300)]
    seen, back = {}, {}
    for a, b, data, offsets in textvec.slices(pa.chunked_array([pa.array(texts).slice(0, 7), pa.array(texts).slice(7)])):
        w = textvec.words(data, offsets)
        cut = w.bounds()
        for i in range(b - a):
            raw = (texts[a + i] or "").encode()
            want = [x.encode() for x in WORD.findall(texts[a + i] or "")]
            at = range(cut[i], cut[i + 1])
            assert [bytes(data[w.start[j]:w.end[j]]) for j in at] == want
            assert [raw[w.start[j] - offsets[i]:w.end[j] - offsets[i]] for j in at] == want
            for j, x in zip(at, want, strict=True):
                assert seen.setdefault(x, w.hash[j]) == w.hash[j] and back.setdefault(w.hash[j], x) == x
        sets = textvec.shingle_sets(w, 2)
        for i in range(b - a):
            x = WORD.findall(texts[a + i] or "")
            assert len(sets[i]) == (len(set(zip(x, x[1:]))) if len(x) > 1 else len(x))


def test_signature_densified():
    rng = np.random.default_rng(0)
    for n in (1, 2, 30, 5000):
        s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert np.isin(near_dedup.signature(s), s).all()
    hits = 0
    for _ in range(200):
        s = np.unique(rng.integers(0, 1 << 63, 90, dtype=np.uint64) * np.uint64(2))
        hits += bool((near_dedup.band_keys([s[:80]]) == near_dedup.band_keys([np.sort(s[:72])])).any())
    assert hits == 200


def brute_components(n, links):
    part = list(range(n))
    def root(x):
        while part[x] != x:
            x = part[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        part[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 180)] + \
            [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = brute_components(300, links)
    assert got == {i: want[i] for i in {x for p in links for x in p if p[0] != p[1]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_groups(rows, k=2, pct=80):
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j])]
    part = brute_components(len(rows), links)
    least = {}
    for i, p in enumerate(part):
        least[p] = min(least.get(p, rows[i][0]), rows[i][0])
    return {d: (len(s), least[p]) for (d, _), s, p in zip(rows, sets, part, strict=True)}


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.withColumn("keys", F.lit(1)).withColumn("c1", F.lit("x"))
    got = near_dedup.near_duplicates(df, shingle=2, **more).collect()
    assert len(got) == len(rows)
    want = brute_groups(rows, **{k: v for k, v in more.items() if k == "pct"})
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_fixture(spark):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(300)]
    rows = [(1000 + i, t) for i, t in enumerate(ODD + ["a", "A B", "b a"])]
    base = [rng.choice(voc) for _ in range(120)]
    for i in range(150):  # a large group of near copies, in chains
        if i % 10 == 0:
            at = list(base)
        at[rng.randrange(120)] = rng.choice(voc)
        rows.append((i, " ".join(at)))
    passage = [rng.choice(voc) for _ in range(60)]
    for i in range(150, 230):  # a common passage, too little to link
        rows.append((i, " ".join(passage + [rng.choice(voc) for _ in range(rng.randrange(10, 60))])))
    rows += [(i, " ".join(base)) for i in range(300, 340)]
    check(spark, rows)


def test_near_duplicates_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (None, ""), (7, "q"), (7, "a b c")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(None, 5), (5, 5), (None, None), (7, 7), (7, 5)], key=str)
    assert near_dedup.near_duplicates(df.limit(0), 2).count() == 0


def test_kept_documents(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "q"), (3, "q"), (None, "a b c d e f"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(7)).withColumn("n", F.lit(7))
    got = sorted(((r["doc_id"], r["text"], r["kept"]) for r in near_dedup.kept_documents(df).collect()), key=str)
    assert got == sorted([(d, t, 7) for d, t in [rows[0], rows[2], *rows[5:]]], key=str)


def test_null_and_repeated_ids_link_by_their_text(spark):
    """A row without an id links like any other; rows of one id are judged by their own texts."""
    w = [f"w{i}" for i in range(60)]
    t, near = " ".join(w), " ".join([*w[:-1], "x"])
    u, near_u = " ".join(f"u{i}" for i in range(60)), " ".join(f"u{i}" for i in range(1, 60))
    rows = [(None, t), (3, near), (4, " ".join(w[1:])), (None, u), (None, u), (None, near_u), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.near_duplicates(df, 5).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got if r["n_shingles"] and (r["component_id"] or r["doc_id"])), key=str) == \
        sorted([(None, 3), (3, 3), (4, 3)], key=str)
    kept = near_dedup.kept_documents(df).collect()
    assert sum(r["doc_id"] == 3 for r in kept) == 1 and sum(r["text"] is None for r in kept) == 2
    assert sum(r["text"] in (u, near_u) for r in kept) == 1 and len(kept) == 4
    rows = [(1, t), (1, u), (9, near_u), (8, t), (1, t)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("__row", F.lit(1))
    assert sorted((r["doc_id"], r["text"]) for r in near_dedup.kept_documents(df).collect()) == sorted([(1, t), (1, u)])


def test_common_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(np.concatenate([np.arange(300), rng.integers(300, 4000, n)])).astype(np.uint64)
            for n in rng.integers(1, 400, 90)] + [np.array([9000], np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets[40:]] for a in sets[:60]]
    assert near_dedup._common(sets[:60], sets[40:]).tolist() == want


def test_templated_group_around_the_limit(spark):
    """Texts just under the limit crowd every bucket; planted pairs just above must link."""
    rng = random.Random(11)
    new = iter(range(10**6))
    body = [f"t{i}" for i in range(451)]

    def fill(tail):
        return " ".join(body + tail)

    rows = [(i, fill([f"n{next(new)}" for _ in range(60)])) for i in range(400)]
    for p in range(20):  # 14 more words in common: 464 of 556 shingles, 0.834
        shared = [f"s{p}-{i}" for i in range(14)]
        rows += [(1000 + 2 * p + k, fill(shared + [f"n{next(new)}" for _ in range(46)])) for k in (0, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, shingle=2).collect()}
    assert got == {d: d - d % 2 if d >= 1000 else d for d, _ in rows}
