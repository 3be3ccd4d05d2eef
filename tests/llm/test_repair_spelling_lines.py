"""Conversation repair, spelling variants and line dedup against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from gamelake.llm import conversation_repair as repair
from gamelake.llm import line_dedup, spelling

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\x0b\x0c\r"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- conversation repair ------------------------------------------------------------------

def ways(codes, entry, leave):
    """Least (cost, letters) by working through all turns and states, inserts up to two before a turn."""
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {entry: (0, "")}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for q, (c, w) in list(out.items()):
                r = 3 if q == 2 else 2
                out[r] = min(out.get(r, (10**9, "")), (c + 3, w + "I"))
        return out

    for c in codes:
        new = {}
        for q, (cost, w) in inserted(best).items():
            options = [(q, 4, "D")]
            if c != "x":
                late = 3 if c.isupper() else 0
                options += [(nxt[q, c.lower()], late, "K")] if (q, c.lower()) in nxt else []
                options += [(3 if q == 2 else 2, 3 + late, "R")]
            for r, k, letter in options:
                new[r] = min(new.get(r, (10**9, "")), (cost + k, w + letter))
        best = new
    if leave is None:
        return min(v for q, v in inserted(best).items() if q in (0, 3))
    return best.get(leave)


def test_search_finds_the_least_edits():
    rng = random.Random(3)
    for n in range(1500):
        codes = "".join(rng.choice("suaSUAoOxuaua") for _ in range(rng.randrange(0, 14)))
        entry, leave = rng.randrange(4), rng.choice([None, None, 0, 1, 2, 3])
        assert repair.cheapest(codes, entry, leave) == ways(codes, entry, leave), (codes, entry, leave)


def test_blocks_chain_to_the_whole():
    rng = random.Random(4)
    for _ in range(300):
        codes = "".join(rng.choice("suaUAxuauaua") for _ in range(rng.randrange(1, 40)))
        size = rng.randrange(1, 9)
        cuts = [codes[i:i + size] for i in range(0, len(codes), size)]
        blocks = []
        for k, part in enumerate(cuts):
            options = []
            for leave in [None] if k == len(cuts) - 1 else range(4):
                needs = {}
                for entry in range(4) if k else [0]:
                    found = repair.cheapest(part, entry, leave, needs)
                    assert found == ways(part, entry, leave)
                    if found:
                        options.append({"entry": entry, "leave": leave, "cost": found[0], "audit": found[1]})
            blocks.append(options)
        assert repair._chain(blocks) == repair.cheapest(codes), codes


def expected(rows):
    """The whole contract for one conversation's rows (turn, role, text) after damage."""
    rows = sorted(((t is not None, t or 0, r, sha(x), x) for t, r, x in rows))
    codes, seen, counts, before = "", set(), Counter(), None
    for _, _, role, _, text in rows:
        bare = text.rstrip(SPACES)
        initial = role[:1]
        letter = initial if initial in ("s", "u", "a") else "o"
        if not bare:
            counts["blank"] += 1
            codes += "x"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            codes += "x"
        elif bare[-1] not in ".!?":
            counts["truncated"] += 1
            codes += letter.upper()
        else:
            codes += letter
        seen.add((role, text))
        counts["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
    turns = [t for has, t, *_ in rows if has]
    counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = ways(codes, 0, None)
    said, q, at = [], 0, 0
    for letter in audit:
        role, text = (rows[at][2], rows[at][4]) if letter != "I" else (None, "")
        at += letter != "I"
        if letter != "D":
            role = role if letter == "K" else "assistant" if q == 2 else "user"
            q = {"s": 1, "u": 2, "a": 3}[role[0]]
            said.append(f"{role}:{text}")
    return (counts["gaps"], counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, sha("\n".join(said)))


def damaged(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[c] += [(t, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_audits_match_plain_python(spark):
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No", "Why?", " ", "", None, f"Text {rng.random()}!  \n", "é🙂."])))
    rows += [(200, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(700)]  # several blocks
    rows += [(201, None, "user", "Null turn."), (201, None, "user", "Null turn."), (201, 5, "assistant", "x" * 200_000 + ".")]
    rows += [(202, 1, "user", "Same turn."), (202, 1, "assistant", "Same turn."), (202, 1, "user", "Other.")]
    rows += [(None, 0, "user", "No id."), (None, 3, "assistant", "Still none.")]
    df = spark.createDataFrame(rows, TURNS).withColumn("block", F.lit("x")).withColumn("digest", F.lit(1))
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.audits(repair.damage(df)).collect()}
    want = damaged(rows)
    assert set(found) == {r[0] for r in rows}
    for c in found:
        assert found[c] == (expected(want[c]) if want[c] else (0, 0, 0, 0, 0, 0, "", sha(""))), c
    turns = repair.repaired_turns(repair.damage(df)).collect()
    said = defaultdict(list)
    for r in sorted(turns, key=lambda r: r["position"]):
        said[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for c in found:
        assert sha("\n".join(said[c])) == found[c][-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said[c]))
    assert repair.audits(df.limit(0)).count() == 0


def test_conversation_without_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 0), (2, 0, "user", "Hi.", 2)], TURNS + ", copies int")
    found = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.audits(df).collect()}
    assert found[1] == (0, "", sha(""))
    assert found[2] == (7, "KDI", sha("user:Hi.\nassistant:"))


# --- spelling variants --------------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_variants(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_spelling_matches_plain_python(spark):
    rng = random.Random(6)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    texts = []
    for i in range(60):
        run = []
        for _ in range(rng.randrange(0, 80)):
            w = rng.choice(stems)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÀ×") + w[k:], w[:k] + "a" + w[k + 1:]])
            run.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(" ".join(run))
    texts += [None, "", "a" * 5000 + " " + "a" * 4999, "a" * 5000 + " " + "a" * 4999, "a" * 5000 + "b " + "a" * 4999 + " " + "a" * 5000,
              "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa", "hello's hello_hello ‘hello’ Āhello"]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    df = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in rows], DOCS).withColumn("word", F.lit(1)).withColumn("run", F.lit(2))
    found = {tuple(r) for r in spelling.spelling_variants(df).collect()}
    assert found == brute_variants(rows)
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_trie_numbers_over_many_parts(spark, monkeypatch):
    """Nodes that span parts get one number: equal prefixes have equal numbers, and others differ."""
    monkeypatch.setattr(spelling, "PART_WORDS", 7)  # read on the driver only
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 12))) for _ in range(150)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    number = {}
    kept = {}
    spelling.ship(spark)
    for r in spelling.trie_nodes(df).collect():
        kept[r["word"]] = len(r["nodes"]) - 1
        for d, x in enumerate(r["nodes"]):
            assert number.setdefault(r["word"][:d], x) == x
    assert len(set(number.values())) == len(number)
    for w in words:
        most = max(spelling._shared(w, v) for v in words if v != w)
        assert kept[w] >= most
    found = {(r["word"], r["n_near"]) for r in spelling.neighbours(df).collect()}
    assert found == {(w, sum(one_edit(w, v) for v in words)) for w in words}


# --- line dedup ---------------------------------------------------------------------------

def brute_lines(rows, min_docs):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    often = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and often[key(x)] >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_lines_match_plain_python(spark):
    rng = random.Random(8)
    lines = [f"Line {i}" for i in range(30)] + ["", "  ", "\t", "É", "é", "x" * 300_000]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    rows += [(None, None), (None, "line 1\n line 1"), (7, "LINE 1\n  line 2\t"), (7, "other"), (5, ""), (5, "")] + rows[:3]
    df = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in rows], DOCS)
    df = df.withColumn("bucket", F.lit("b")).withColumn("h1", F.lit("h")).withColumn("row", F.lit("r")).withColumn("n_lines", F.lit(-1))
    for min_docs in (10, 25):
        got = line_dedup.without_frequent_lines(df, min_docs)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "bucket", "h1", "row", "n_lines", "n_dropped"]
        found = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect())
        assert found == brute_lines(rows, min_docs)
    assert line_dedup.without_frequent_lines(df.limit(0)).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 63, 64, 5000):
        h = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        order = line_dedup.PerfectHash.build(*h)
        assert sorted(order.numbers(*h)) == list(range(n))
    half = np.zeros(1000, np.uint64)  # keys that share one half
    order = line_dedup.PerfectHash.build(half, np.arange(1000, dtype=np.uint64))
    assert sorted(order.numbers(half, np.arange(1000, dtype=np.uint64))) == list(range(1000))


def test_index_of_other_documents(spark, monkeypatch):
    """Several shards and buckets; lines that the index does not hold stay."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)  # both read on the driver only
    monkeypatch.setattr(line_dedup, "BUCKET_DOCS", 8)
    old = spark.createDataFrame([(i, f"common\nown {i}\npair {i // 2}") for i in range(64)], "doc_id long, text string")
    new = spark.createDataFrame([(i, f"common\nnew {i}\nnew\npair {i}") for i in range(40)], "doc_id long, text string")
    line_dedup.ship(spark)
    index = line_dedup.stored(line_dedup.line_index(line_dedup.stored(line_dedup.questions(old), "q")), "i")
    assert index.count() > 3 and index.agg(F.sum("n_keys")).first()[0] == 1 + 64 + 32
    got = line_dedup.drop_lines(new, line_dedup.stored(line_dedup.questions(new), "q"), index, 2).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: f"new {i}\nnew" + (f"\npair {i}" if i >= 32 else "") for i in range(40)}
