"""SentencePiece: trie, Viterbi against brute force, exact round trips."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gamelake.llm import pieces, textvec

ODD = ["", " ", "  a  b ", "▁x", "\n\n a\n", "é🙂\x00", "x" * 500, None, " " * 40 + "q", "日本語のテキスト " * 50, "\n", "\r\n\t",
       "a" * 30000 + " b", "�", "end "]


@pytest.fixture(scope="module")
def trie():
    return pieces.build_trie(pieces.load_pieces())


def toy(words):
    own = [w.encode() for w in words]
    ids = np.full(256, -1, np.int32)
    texts = own + [None] * 256
    ids[:] = np.arange(len(own), len(own) + 256)
    scores = np.concatenate([-np.arange(1, len(own) + 1) * 0.7, np.zeros(256)])
    return pieces.build_trie(pieces.Pieces(texts, scores, ids)), dict(zip(own, scores, strict=False))


def test_viterbi_is_the_best_segmentation():
    rng = random.Random(2)
    words = [" ", " a", "a", "ab", "b", "ba", "bab", "c", " ca", "é", "aé"]
    rng.shuffle(words)
    t, score = toy(words)
    for _ in range(200):
        text = b" " + "".join(rng.choice("ab cé?") for _ in range(rng.randrange(9))).encode()
        chars = text.decode()
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=len(chars) - 1):
            parts, at = [], 0
            for i, c in enumerate((*cuts, 1)):
                if c:
                    parts.append(chars[at:i + 1].encode())
                    at = i + 1
            if all(p in score or len(p.decode()) == 1 for p in parts):
                best = max(best, sum(score.get(p, t.unknown) for p in parts))
        ids = pieces.segment(t, text)
        plain = [i for i in ids if i < len(words)]
        fallback = bytes(i - len(words) for i in ids if i >= len(words)).decode()
        got = sum(t.score[i] for i in plain) + t.unknown * len(fallback)
        assert got == pytest.approx(best), text


def test_many_equals_one(trie):
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("the  and\nxéß▁ing") for _ in range(300)) for _ in range(60)]
    encoder = pieces.Encoder(trie)
    for _ in range(2):  # the second time from the cache
        for a, b, data, offsets in textvec.slices(pa.array(texts)):
            for i, ids in enumerate(encoder.encode(data, offsets)):
                t = texts[a + i]
                want = pieces.segment(trie, b" " + t.encode()) if t else []
                assert ids.tolist() == want
        pieces.CACHED_CHUNKS, old = 50, pieces.CACHED_CHUNKS
    pieces.CACHED_CHUNKS = old


def test_round_trip(spark, trie):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string").withColumn("pieces", F.lit(1))
    rows = pieces.encoded_documents(df).collect()
    assert len(rows) == len(ODD) and all(r["exact"] for r in rows)
    for r in rows:
        assert (r["pieces"] is None) == (r["text"] is None) and r["n_pieces"] == len(r["pieces"] or [])
    assert pieces.encoded_documents(df.limit(0)).count() == 0
    plain = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    back = pieces.decode_pieces(pieces.encode_texts(plain, trie), trie).collect()
    assert all(r["decoded"] == r["text"] for r in back) and len(back) == len(ODD)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert pieces.encoded_documents(docs).where("NOT exact").count() == 0


def test_decode_odd_pieces(trie):
    ids = np.array([10**6, -5, 3 + 0xFF, 3 + 0x41])
    assert pieces.decode(trie, ids, np.array([4, 0])) == ["�A", ""]


def test_marker_inside_a_piece_is_refused():
    with pytest.raises(ValueError):
        toy(["a b"])
