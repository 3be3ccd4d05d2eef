"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their scores come from a model file (a parameter). The trie maps byte
strings to pieces; the best segmentation of a text is the one with the largest sum of
log scores. A character without a piece becomes its bytes' pieces (``<0x..>``) at a
penalty below the least score. The whitespace marker stands for the space, and one
marker is put before the text; decoding undoes both. A marker character that is in the
text itself goes through byte pieces, so decoding returns every text exactly.

Models that hold merge ranks and no log probabilities (all scores are whole numbers) get
Zipf's law: the log score of rank r is -log(r + 1).

No piece holds a marker after another character, nor a line break; texts therefore fall
into chunks (a run of spaces with the word behind it; a line break) whose best
segmentations are independent. Each distinct chunk is segmented once in a task, many
chunks at a time. ``Trie`` checks this property of the pieces.

Cases: null text gives null pieces and null pieces give null text; the empty text gives
no pieces; unknown ids decode to nothing; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.llm import textvec

MARKER = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
CACHED_CHUNKS = 400_000
LONG_CHUNK = 192


class Pieces(NamedTuple):
    """Byte strings of the pieces (marker as space), log scores, and ids of the byte pieces."""

    texts: list[bytes | None]
    scores: np.ndarray
    byte_ids: np.ndarray


def load_pieces(model: str = MODEL) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model)
    texts: list[bytes | None] = []
    scores = np.array([m.get_score(i) for i in range(m.get_piece_size())])
    byte_ids = np.full(256, -1, np.int32)
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        plain = not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))
        texts.append(p.replace(MARKER, " ").encode() if plain else None)
        if m.is_byte(i):
            byte_ids[int(p[1:-1], 16)] = i
    if (scores == np.round(scores)).all():
        scores = -np.log1p(-np.minimum(scores, 0))
    return Pieces(texts, scores, byte_ids)


class Trie(NamedTuple):
    """A double array: child of node s by byte c is t = base[s] + c where check[t] == s."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    table: np.ndarray
    table_at: np.ndarray
    breaks: bool


def build_trie(pieces: Pieces) -> Trie:
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, t in enumerate(pieces.texts):
        if not t:
            continue
        if b" " in t.lstrip(b" "):
            raise ValueError(f"piece {i} has a marker after another character")
        node = 0
        for c in t:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][c]
        if ends[node] < 0 or pieces.scores[i] > pieces.scores[ends[node]]:
            ends[node] = i
    size = 2 * len(children) + 1024
    base, check, piece = ([x] * size for x in (0, -1, -1))
    used = bytearray(size)
    used[:257] = b"\1" * 257  # so that every base is positive
    place, free = {0: 0}, 257
    for node in range(len(children)):  # parents come before their children
        kids = sorted(children[node])
        s = place[node]
        piece[s] = ends[node]
        if not kids:
            continue
        while used[free]:
            free += 1
        b = free - kids[0]
        while any(used[b + c] for c in kids):
            b += 1
            if b + 512 > len(used):
                used += bytes(size)
                base, check, piece = base + [0] * size, check + [-1] * size, piece + [-1] * size
        base[s] = b
        for c in kids:
            used[b + c], check[b + c] = 1, s
            place[children[node][c]] = b + c
    # Room for any base + byte.
    base, check, piece = (np.array(x + [-1] * 256, np.int32) for x in (base, check, piece))
    known = np.array([s for s, t in zip(pieces.scores, pieces.texts, strict=True) if t])
    raw = [t or b"" for t in pieces.texts]
    for c, i in enumerate(pieces.byte_ids):
        if i >= 0:
            raw[i] = bytes([c])
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return Trie(base, check, piece, pieces.scores, pieces.byte_ids, float(known.min()) - UNKNOWN_PENALTY,
                np.frombuffer(b"".join(raw), np.uint8), at, not any(b"\n" in t for t in pieces.texts if t))


def _fallback(trie: Trie, char: bytes) -> list[int]:
    return [int(trie.byte_ids[c]) for c in char]


def segment(trie: Trie, chunk: bytes) -> list[int]:
    """Best pieces of one chunk: Viterbi over byte positions."""
    n = len(chunk)
    best, back = [0.0] + [-math.inf] * n, [(0, -1)] * (n + 1)
    base, check, piece, score = trie.base, trie.check, trie.piece, trie.score
    for p in range(n):
        if chunk[p] & 0xC0 == 0x80:
            continue
        here, s, q = best[p], 0, p
        while q < n:
            t = int(base[s]) + chunk[q]
            if check[t] != s:
                break
            s, q = t, q + 1
            i = int(piece[s])
            if i >= 0 and here + score[i] > best[q]:
                best[q], back[q] = here + float(score[i]), (p, i)
        q = p + 1
        while q < n and chunk[q] & 0xC0 == 0x80:
            q += 1
        if here + trie.unknown > best[q]:
            best[q], back[q] = here + trie.unknown, (p, -1)
    out: list[int] = []
    while n:
        p, i = back[n]
        out[:0] = [i] if i >= 0 else _fallback(trie, chunk[p:n])
        n = p
    return out


def segment_many(trie: Trie, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for many chunks at once, one byte position after the other.

    Returns the ids of all chunks behind each other, and how many each has.
    """
    n, width = len(start), int(size.max())
    grid = np.zeros((n, width + 1), np.uint8)
    cols = np.arange(width)
    inside = cols < size[:, None]
    grid[:, :-1][inside] = data[(start[:, None] + cols)[inside]]
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    back, kind = np.zeros((n, width + 1), np.int16), np.full((n, width + 1), -1, np.int32)
    for p in range(width):
        rows = np.flatnonzero((size > p) & (grid[:, p] & 0xC0 != 0x80))
        if not len(rows):
            continue
        here = best[rows, p]
        q = np.full(len(rows), p + 1)
        for _ in range(3):
            q += (q < size[rows]) & (grid[rows, q] & 0xC0 == 0x80)
        s, live, q2 = np.zeros(len(rows), np.int32), np.arange(len(rows)), p
        while len(live) and q2 < width:
            r = rows[live]
            t = trie.base[s] + grid[r, q2]
            ok = (trie.check[t] == s) & (q2 < size[r])
            s, live = t[ok], live[ok]
            q2 += 1
            r, i = rows[live], trie.piece[s]
            value = np.where(i >= 0, here[live] + trie.score[i], -np.inf)
            up = value > best[r, q2]
            best[r[up], q2], back[r[up], q2], kind[r[up], q2] = value[up], p, i[up]
        value = here + trie.unknown
        up = value > best[rows, q]
        best[rows[up], q[up]], back[rows[up], q[up]], kind[rows[up], q[up]] = value[up], p, -1
    at, rows, steps = size.astype(np.int64).copy(), np.arange(n), []
    while len(rows):
        a, b = back[rows, at].astype(np.int64), at
        steps.append((rows, kind[rows, b], a, b))
        more = a > 0
        rows, at = rows[more], a[more]
    chunk = np.concatenate([x[0] for x in steps])
    ids = np.concatenate([x[1] for x in steps])
    a, b = np.concatenate([x[2] for x in steps]), np.concatenate([x[3] for x in steps])
    order = np.lexsort((a, chunk))
    chunk, ids, a, b = chunk[order], ids[order], a[order], b[order]
    wide = np.where(ids >= 0, 1, b - a)
    item = np.repeat(np.arange(len(ids)), wide)
    byte = a[item] + np.arange(len(item)) - np.repeat(np.cumsum(wide) - wide, wide)
    out = np.where(ids[item] >= 0, ids[item], trie.byte_ids[grid[chunk[item], byte]])
    return out.astype(np.int32), np.bincount(chunk, wide, n).astype(np.int64)


class Encoder:
    """Encodes slices of texts, keeping the segmentations of chunks it has met."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.reset()

    def reset(self) -> None:
        self.hash, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, data: np.ndarray, h: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        if len(self.hash) + len(h) > CACHED_CHUNKS and len(self.hash):
            self.reset()
        order = np.argsort(size, kind="stable")
        ids, counts, names = [self.ids], [], []
        short = order[size[order] <= LONG_CHUNK]
        k = 0
        while k < len(short):
            step = max(64, min(16384, (1 << 20) // int(size[short[min(k + 4096, len(short) - 1)]])))
            part = short[k:k + step]
            one, n = segment_many(self.trie, data, start[part], size[part])
            ids.append(one)
            counts.append(n)
            names.append(h[part])
            k += step
        for j in order[size[order] > LONG_CHUNK]:
            one = segment(self.trie, data[start[j]:start[j] + size[j]].tobytes())
            ids.append(np.array(one, np.int32))
            counts.append(np.array([len(one)], np.int64))
            names.append(h[j:j + 1])
        n = np.concatenate(counts)
        at = len(self.ids) + np.cumsum(n) - n
        h, at, n = (np.concatenate(x) for x in ([self.hash, *names], [self.at, at], [self.count, n]))
        order = np.argsort(h, kind="stable")
        self.hash, self.at, self.count, self.ids = h[order], at[order], n[order], np.concatenate(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The pieces of the texts that lie one after the other in ``data``."""
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        # One space before each text.
        spaced = np.full(len(data) + n, 0x20, np.uint8)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        spaced[np.arange(len(data)) + doc + 1] = data
        first = offsets[:-1] + np.arange(n)
        last = first + np.diff(offsets) + 1
        if not len(spaced):
            return []
        space = spaced == 0x20
        before = np.zeros(len(spaced), bool)
        before[1:] = space[:-1]
        head = space & ~before
        if self.trie.breaks:
            line = spaced == 0x0A
            head |= line
            head[1:] |= line[:-1]
        head[first] = True
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(spaced)))
        h = textvec.range_hash(spaced, start, start + size)
        known, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        while True:
            at = np.searchsorted(self.hash, known)
            hit = np.zeros(len(known), bool)
            inner = at < len(self.hash)
            hit[inner] = self.hash[at[inner]] == known[inner]
            if hit.all():
                break
            # A cache that overflowed begins anew with all chunks of this slice.
            fresh = len(self.hash) + int((~hit).sum()) > CACHED_CHUNKS and len(self.hash)
            new = np.arange(len(known)) if fresh else np.flatnonzero(~hit)
            self._learn(spaced, known[new], start[index[new]], size[index[new]])
        begin, count = self.at[at][inverse], self.count[at][inverse]
        total = np.cumsum(count)
        flat = self.ids[np.repeat(begin - (total - count), count) + np.arange(total[-1])]
        cut = np.concatenate([[0], total])
        lo, hi = cut[np.searchsorted(start, first)], cut[np.searchsorted(start, last)]
        return [flat[lo[i]:hi[i]] if full[i] else flat[:0] for i in range(n)]


def decode(trie: Trie, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of lists of pieces that lie one after the other in ``ids``."""
    good = (ids >= 0) & (ids < len(trie.table_at) - 1)
    i = np.where(good, ids, 0)
    count = np.where(good, trie.table_at[i + 1] - trie.table_at[i], 0)
    total = np.cumsum(count)
    n = int(total[-1]) if len(total) else 0
    raw = trie.table[np.repeat(trie.table_at[i] - (total - count), count) + np.arange(n)].tobytes()
    cut = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(sizes)])]
    return [raw[a + (raw[a:a + 1] == b" "):b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]


def encode_texts(df: DataFrame, trie: Trie, text: str = "text", out: str = "pieces",
                 exact: str = "exact") -> DataFrame:
    """``df`` with the pieces of a text column; the trie's size is the vocabulary's.

    The pieces are decoded again at once: ``exact`` says whether that gave the text back.
    """
    shared = df.sparkSession.sparkContext.broadcast(trie)
    rest = [c for c in df.columns if c not in (out, exact)]
    schema = T.StructType([*df.select(*rest).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())),
                           T.StructField(exact, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column(text)):
                part = batch.slice(a, b - a)
                lists = encoder.encode(data, offsets)
                sizes = np.array([len(x) for x in lists] or [0] * (b - a), np.int64)
                flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
                back = decode(shared.value, flat, sizes)
                same = [x == (y or "") for x, y in zip(back, part.column(text).to_pylist(), strict=True)]
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                absent = pc.is_null(part.column(text))
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=absent)
                yield pa.RecordBatch.from_arrays([*part.columns, made, pa.array(same)],
                                                 [*part.schema.names, out, exact])

    return df.select(*rest).mapInArrow(run, schema)


def decode_pieces(df: DataFrame, trie: Trie, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``df`` with the text of a column of pieces."""
    shared = df.sparkSession.sparkContext.broadcast(trie)
    rest = [c for c in df.columns if c != out]
    schema = T.StructType([*df.select(*rest).schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                part = whole.slice(a, 256)
                column = part.column(pieces)
                absent = column.is_null().to_pylist()
                sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False)
                made = decode(shared.value, ids, sizes)
                made = pa.array([None if gone else t for gone, t in zip(absent, made, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, out])

    return df.select(*rest).mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Documents with ``pieces`` and ``n_pieces``; ``exact``: decoding them gave the text back.

    Input columns of these names are replaced.
    """
    trie = build_trie(load_pieces(model))
    rest = [c for c in docs.columns if c not in ("pieces", "n_pieces", "exact")]
    return encode_texts(docs.select(*rest), trie).select(
        *rest, "pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "exact")
