"""Benchmark containment and repeated passages against plain Python and planted cases."""

import random
import re

from pyspark.sql import functions as F

from gamelake.llm import decontaminate, passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_leaks(docs, items, k=5, pct=80):
    out = []
    for i, t in items:
        w = low(t)
        n = min(k, len(w))
        if not n:
            continue
        s = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)}
        for d, x in docs:
            x = low(x)
            both = s & {tuple(x[j:j + n]) for j in range(len(x) - n + 1)}
            if 100 * len(both) >= pct * len(s):
                out.append((d, i, len(s), len(both)))
    return sorted(out, key=str)


def found_leaks(docs, items, **more):
    docs = docs.withColumn("item_id", F.lit(3)).withColumn("set", F.lit(3))
    items = items.withColumn("doc_id", F.lit(3)).withColumn("width", F.lit("x"))
    return sorted((tuple(r) for r in decontaminate.contained_items(docs, items, **more).collect()), key=str)


def test_leaks_in_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute_leaks([tuple(r) for r in d.collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    assert want and found_leaks(d, b) == want
    assert found_leaks(d, b, block_shingles=300) == want  # several blocks of items


def test_leaks_fixture(spark):
    rng = random.Random(4)
    voc = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 12, 40, 300, 40])]
    items += [(20, None), (21, " \n"), (22, items[6][1]), (None, items[6][1]), (23, "a a a a a a a a a")]
    docs = [(0, None), (1, ""), (2, "a a a a a a"), (None, items[5][1])]
    for d in range(3, 60):
        w = [rng.choice(voc) for _ in range(rng.choice([5, 80, 3000]))]
        i, t = rng.choice(items[:9])
        t = t.split()
        for _ in range(rng.randrange(3)):  # edits move the containment around the limit
            t[rng.randrange(len(t))] = rng.choice(voc)
        at = rng.randrange(len(w))
        docs.append((d, " ".join(w[:at]) + "\n" + " ".join(t).upper() + "\t" + " ".join(w[at:])))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(docs, items)
    assert len(want) > 30 and found_leaks(d, b) == want
    left = {r["doc_id"] for r in decontaminate.clean_documents(d, b).collect()}
    assert left == {x for x, _ in docs} - {x[0] for x in want}
    assert found_leaks(d.limit(0), b) == [] and found_leaks(d, b.limit(0)) == []


def test_planted_passages(spark):
    rng = random.Random(5)
    text = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(4000)) for _ in range(n)]
    docs, holds = [], {}
    planted = [text(rng.randrange(51, 90)) for _ in range(25)] + [text(60)]
    for p, passage in enumerate(planted):
        for _ in range(60 if p == 25 else 2):
            a, b = text(rng.randrange(0, 200)), text(rng.randrange(0, 200))
            holds.setdefault(p, []).append(len(docs))
            docs.append((len(docs), " ".join(a) + rng.choice([" ", "\n"]) + " ".join(passage) + " " + " ".join(b)))
    clean = range(len(docs), len(docs) + 60)
    license_line = "This file is licensed under the GNU General Public License, version 3."
    docs += [(i, " ".join(text(150)) + "\n" + license_line) for i in clean]
    inner = " ".join(text(80))
    docs += [(len(docs), inner + "\n" + inner), (len(docs) + 1, None), (len(docs) + 2, ""), (None, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("keys", F.lit(1)).withColumn(
        "spans", F.lit("x")).repartition(3)
    hit = {}
    for r in passages.repeated_passages(df).collect():
        hit.setdefault(r["doc_id"], []).append(r)
    later = {d for p in holds.values() for d in p[1:]}
    assert not set(hit) - later
    assert len(later - set(hit)) <= 0.03 * len(later)
    out = {r["doc_id"]: r for r in passages.remove_passages(df).collect()}
    assert len(out) == len(docs) and set(out[0].asDict()) == {"doc_id", "text", "keys", "spans"}
    for d, t in docs:
        if d is None or d not in hit:
            assert out[d]["text"] == t
            continue
        raw, at, left = t.encode(), 0, b""
        for r in sorted(hit[d], key=lambda r: r["start"]):
            left += raw[at:r["start"]]
            at = r["stop"]
            assert r["words"] >= passages.MIN_WORDS == 16 and r["first_doc"] < d
        assert out[d]["text"] == (left + raw[at:]).decode()
        assert len(left + raw[at:]) < len(raw)
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_near_paragraphs_link(spark):
    """A long paragraph with its last word changed still joins the first one's cluster."""
    import numpy as np
    import pyarrow as pa

    from gamelake.llm import textvec
    rng = random.Random(9)
    words = [f"x{rng.randrange(10**6)}" for _ in range(4000)]
    _, _, data, offsets = next(textvec.slices(pa.array([" ".join(words)])))
    at = passages.paragraph_starts(textvec.words(data, offsets))
    k = int(np.argmax(np.diff(at)))
    a, b = at[k], at[k + 1]
    assert b - a >= 14
    body = words[a:b]
    docs = [(1, " ".join(body)), (2, " ".join(body[:-1] + ["other"])), (3, " ".join(words[:a]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = passages.repeated_passages(df, min_words=1, recall=0.999999).collect()
    assert [(r["doc_id"], r["first_doc"]) for r in got if r["words"] == b - a] == [(2, 1)]


def test_crowded_paragraphs_settle(spark):
    """Of thousands of paragraphs that share a phrase, the near pairs all link, whoever leads."""
    import numpy as np

    from gamelake.llm import near_dedup
    rng = np.random.default_rng(6)
    hot = np.arange(4, dtype=np.uint64)  # the least hashes of all sets
    sets = []
    for _ in range(60):
        own = np.sort(rng.integers(1 << 20, 1 << 60, 14, dtype=np.uint64))
        other = np.sort(np.append(own[:-1], own[-1] + np.uint64(1)))  # 17 of 19 shingles
        sets += [np.concatenate([hot, own]), np.concatenate([hot, other])]
    sets += [np.concatenate([hot, np.sort(rng.integers(1 << 20, 1 << 60, 14, dtype=np.uint64))]) for _ in range(300)]
    lists, count = np.concatenate(sets), np.array([len(s) for s in sets])
    keys = passages.band_keys(lists, np.cumsum(count) - count, 20)
    keys[:, 0] = 5  # one bucket of all
    keys = keys.view(np.int64)
    members = spark.createDataFrame([(int(k), i, i) for i, x in enumerate(keys) for k in x], "key long, c1 long, part long")
    full = spark.createDataFrame([(i, [int(x) for x in s]) for i, s in enumerate(sets)], "c1 long, set array<long>")
    parts = near_dedup.settled(members, lambda asked: full.join(asked, "c1", "left_semi"), 80)
    assert sorted(tuple(r) for r in parts.collect()) == [(i, i - i % 2) for i in range(120)]


def test_bands_meet_the_recall():
    """Sets at the similarity share a band as often as asked, unrelated ones seldom."""
    import numpy as np
    rng = np.random.default_rng(7)
    assert passages.bands(80, 0.999) == 10 and passages.bands(80, 0.9) < passages.bands(80, 0.99)
    met = far = 0
    for _ in range(3000):
        n = int(rng.integers(9, 60))
        lost = n // 9  # n - lost of n + lost at 0.8 or more
        a = rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(3)
        b = np.concatenate([a[lost:], rng.integers(0, 1 << 62, lost, dtype=np.uint64)])
        c = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        x, y, z = passages.band_keys(np.concatenate([a, b, c]), np.array([0, n, 2 * n]), passages.bands(80, 0.999))
        met += bool((x == y).any())
        far += bool((x == z).any())
    assert met >= 2991 and far <= 15


def brute_passages(rows, pct, min_words):
    """(doc_id, start, stop, words, first_doc) by comparing all paragraphs of distinct (doc_id, text) rows in pairs."""
    import numpy as np
    import pyarrow as pa

    from gamelake.llm import textvec
    items, words = [], {}
    for doc, text in rows:
        _, _, data, offsets = next(textvec.slices(pa.array([text])))
        w = textvec.words(data, offsets, lower=True)
        low = text.lower().split()
        words[doc] = low, w.start.tolist(), w.end.tolist()
        for reach in (passages.FINE, passages.COARSE):
            at = [*passages.paragraph_starts(w, reach).tolist(), len(low)]
            items += [(reach, doc, i, j, tuple(low[i:j])) for i, j in zip(at, at[1:], strict=False)]
    nodes = sorted({(r, own) for r, *_, own in items})
    part = {x: x for x in nodes}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x
    coarse = [(x, {x[1][k:k + 5] for k in range(len(x[1]) - 4)}) for x in nodes if x[0] == passages.COARSE and len(x[1]) >= 9]
    for k, (x, sx) in enumerate(coarse):
        for y, sy in coarse[:k]:
            if 100 * len(sx & sy) >= pct * len(sx | sy):
                part[root(x)] = root(y)
    linked = {root(x) for x in nodes if root(x) != x}
    places = {}
    for reach, doc, i, j, own in items:
        c = root((reach, own))
        if reach == passages.FINE or c in linked:
            places.setdefault(c, []).append((doc, i, j))
    found = {}
    for c, at in places.items():
        first = min(at)
        for doc, i, j in at:
            if doc != first[0]:
                found.setdefault(doc, []).append((i, j, first))
    out = []
    for doc, hits in found.items():
        runs = []
        for i, j, first in sorted(hits):
            if runs and i <= runs[-1][1]:
                runs[-1][1] = max(j, runs[-1][1])
                runs[-1][2].append((i, j, first))
            else:
                runs.append([i, j, [(i, j, first)]])
        low, start, end = words[doc]
        merged = []
        for i, j, parts in runs:
            left, right = {x[2][:2] for x in parts if x[0] == i}, {x[2][::2] for x in parts if x[1] == j}
            assert len(left) == 1 and len(right) == 1  # both scales begin and end at one place in these rows
            (f, p), (g, q) = left.pop(), right.pop()
            k = 0
            while k < passages.EDGE and min(i - k, p - k) > 0 and low[i - k - 1] == words[f][0][p - k - 1]:
                k += 1
            m = 0
            while m < passages.EDGE and j + m < len(low) and q + m < len(words[g][0]) and low[j + m] == words[g][0][q + m]:
                m += 1
            merged.append((i - k, j + m, min(x[2][0] for x in parts)))
        merged.sort()
        whole = [list(merged[0])]
        for i, j, f in merged[1:]:
            if i <= whole[-1][1] + passages.GAP:
                whole[-1][1], whole[-1][2] = max(j, whole[-1][1]), min(f, whole[-1][2])
            else:
                whole.append([i, j, f])
        out += [(doc, start[i], end[j - 1], j - i, f) for i, j, f in whole if j - i >= min_words]
    return sorted(out)


def edited_passages(seed, size, changed, pairs):
    """Pairs of documents that share a passage with some words changed in the second, and (id: its words there)."""
    rng = random.Random(seed)
    text = lambda n: [f"p{rng.randrange(10**7)}" for _ in range(n)]
    docs, where = [], {}
    for _ in range(pairs):
        passage = text(size)
        other = [f"q{rng.randrange(10**7)}" if k in changed else x for k, x in enumerate(passage)]
        for body in (passage, other):
            a = text(rng.randrange(20, 120))
            where[len(docs)] = (len(a), size)
            docs.append((len(docs), " ".join(a + body + text(rng.randrange(20, 120)))))
    return docs, where


def test_whole_query_against_pairs(spark):
    """The ranges equal those of a plain version that compares all paragraphs."""
    docs = []
    for k, (size, changed) in enumerate([(51, ()), (60, (30,)), (130, (20, 75)), (90, (88,))]):
        docs += [(1000 * k + d, t) for d, t in edited_passages(30 + k, size, changed, 6)[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for least in (1, passages.MIN_WORDS):
        got = sorted((r["doc_id"], r["start"], r["stop"], r["words"], r["first_doc"])
                     for r in passages.repeated_passages(df, min_words=least, recall=0.999999).collect())
        assert len(got) >= 20 and got == brute_passages(docs, 80, least)


def test_edited_passages_are_cut_whole(spark):
    """Of passages with a changed word nine tenths of the words go, by the production parameters.

    Of the words around them only those go that a near paragraph holds beside the passage.
    """
    for size, changed in [(51, ()), (51, (25,)), (60, (30,)), (60, (59,)), (100, (33, 66))]:
        docs, where = edited_passages(size + len(changed), size, changed, 60)
        cut, around, lost = dict.fromkeys(where, 0), 0, 0
        left = {r["doc_id"]: r["text"].split() for r in passages.remove_passages(
            spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
        for d, t in docs:
            low, (at, n) = t.split(), where[d]
            own = set(low[:at] + low[at + n:])
            assert d % 2 or left[d] == low
            around, lost = around + len(own), lost + len(own - set(left[d]))
            cut[d] = len(low) - len(left[d])
        assert lost <= 0.01 * around, (size, changed, lost, around)
        assert sum(cut.values()) - lost >= 0.9 * 60 * size, (size, changed, sum(cut.values()) / (60 * size))


def test_all_near_paragraphs_link_by_default(spark):
    """Hundreds of paragraphs with the last word changed: the default parameters find every one."""
    import numpy as np
    import pyarrow as pa

    from gamelake.llm import textvec
    rng = random.Random(10)
    words = [f"x{rng.randrange(10**6)}" for _ in range(60000)]

    def starts(w):
        _, _, data, offsets = next(textvec.slices(pa.array([" ".join(w)])))
        return passages.paragraph_starts(textvec.words(data, offsets))

    docs, size = [], {}
    at = starts(words[:25000])
    for k in np.flatnonzero(np.diff(at) >= 13):
        body = words[at[k]:at[k + 1]]
        near = body[:-1] + ["other"]
        if len(starts(body)) == len(starts(near)) == 1:
            size[len(docs) + 1] = len(body)
            docs += [(len(docs), " ".join(body)), (len(docs) + 1, " ".join(near))]
    assert len(size) > 150
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["first_doc"], r["words"]) for r in passages.repeated_passages(df, min_words=1).collect()}
    assert got == {(d, d - 1, n) for d, n in size.items()}


def test_rows_of_one_id_keep_their_own_text(spark):
    """Repeated and null ids, and columns named like helpers: no row is lost or cut for another's sake."""
    from gamelake.llm import decontaminate, near_dedup
    rng = random.Random(12)

    def text(n):
        return " ".join(f"y{rng.randrange(10**6)}" for _ in range(n))
    t, u, passage = text(64), text(64), text(80)
    schema = "doc_id long, text string, other_id string, spans string, row_hash string"
    rows = [(1, passage + " " + text(30)), (2, text(20) + " " + passage), (2, t), (None, passage), (None, u)]
    df = spark.createDataFrame([(i, x, "o", "s", "r") for i, x in rows], schema)
    out = passages.remove_passages(df).collect()
    got = {(r["doc_id"], r["text"]) for r in out}
    assert (2, t) in got and (None, passage) in got and (None, u) in got and rows[0] in got and rows[1] not in got and len(out) == 5
    assert set(out[0].asDict()) == {"doc_id", "text", "other_id", "spans", "row_hash"} and out[0]["spans"] == "s"

    item = spark.createDataFrame([(7, u)], "item_id long, text string")
    left = {(r["doc_id"], r["text"]) for r in decontaminate.clean_documents(df, item).collect()}
    assert left == {r for r in rows if r[1] != u}

    near = u.rsplit(" ", 1)[0] + " last"
    twins = spark.createDataFrame([(1, t), (1, u), (9, near), (8, t)], "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in near_dedup.kept_documents(twins).collect()} == {(1, t), (1, u)}
