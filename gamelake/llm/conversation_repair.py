"""Conversation structure repair by iterative-deepening A*.

A repaired conversation reads ``(s?(ua)+)?`` by the first letters of its roles: an optional
system turn, then user and assistant in turns. Edits: Keep (0), Rerole to user or assistant
(3), Delete (4; blank and duplicate turns must go), Insert an empty user or assistant turn
(3); a truncated turn that stays adds 3. Wanted are the cheapest edits, and of several such
the one whose letters (D, I, K, R) come first in ASCII order.

The search goes depth first through the edits in that order under a cost bound that rises to
the least total it had to leave out; a table keeps, for each state (turns read, last role) that
failed, the cost it is now known to need. The first path that reaches an accepting end is
the answer. What is searched is one letter a turn, never a text.

Long conversations are cut into blocks of ``BLOCK`` turns. A block is searched for every
state in which it can be entered and left (inserts stand before a turn, so each block's
letters end with a turn's edit, and whole answers compare block by block), and the blocks'
answers are chained exactly. So a conversation that holds a third of all rows is searched in
many tasks; only its sorted rows pass through one task, as its hash must, a batch at a time.

Defined cases: rows of one turn number are ordered by role and then by the SHA-256 of the
text; null turn numbers come first; a null role or text is one space; rows with a null
conv_id form one conversation; a role's initial is its first character, and one other than
s, u, a (or none) is never kept; equal rows are duplicates of the first; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.tables import ship

BLOCK = 64
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
SPACES = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FOLLOWS = {0: "u", 1: "u", 2: "a", 3: "u"}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
ROLE = {"u": "user", "a": "assistant"}


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20, with ``copies`` (0: dropped, 2: repeated)."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _lower_bounds(codes: str) -> list[int]:
    """A cost that the turns from each position on need at least.

    Forced deletions, truncated turns, and one edit for every two neighbours that may not
    follow each other; such pairs are disjoint, so their edits differ.
    """
    h, after = [0] * (len(codes) + 1), None
    for i in range(len(codes) - 1, -1, -1):
        c = codes[i]
        if c == "x":
            h[i] = h[i + 1] + DELETE
            continue
        h[i] = h[i + 1] + (TRUNCATED if c.isupper() else 0)
        if after is not None and (c + after).lower() not in LEGAL:
            h[i] += DELETE - TRUNCATED if (c + after).lower() != c + after else min(REROLE, INSERT, DELETE)
            after = None
        else:
            after = c
    return h


def _steps(codes: str, i: int, q: int, closing: bool) -> list[tuple[str, int, int, int]]:
    """Edits possible at turn ``i`` in state ``q``, in ASCII order: (letter, turn, state, cost)."""
    to = NEXT[q, FOLLOWS[q]]
    if i == len(codes):
        return [("I", i, to, INSERT)] if closing else []
    c = codes[i]
    steps = [("D", i + 1, q, DELETE), ("I", i, to, INSERT)]
    if c != "x":
        late = TRUNCATED if c.isupper() else 0
        if (q, c.lower()) in NEXT:
            steps.append(("K", i + 1, NEXT[q, c.lower()], late))
        steps.append(("R", i + 1, to, REROLE + late))
    return steps


def cheapest(codes: str, entry: int = 0, leave: int | None = None,
             needs: dict[tuple[int, int], int] | None = None) -> tuple[int, str] | None:
    """(cost, letters) of the cheapest, ASCII-least edits of one block; None if there are none.

    ``codes``: one letter a turn: x must go; s, u, a, o (another role), upper case if
    truncated. ``leave``: the state to end in; None: any end of a conversation. ``needs``: the
    table of failed states, to go on with from another entry (codes and leave being the same).
    """
    h, n = _lower_bounds(codes), len(codes)
    needs = {} if needs is None else needs
    bound, most = max(h[0], needs.get((0, entry), 0)), DELETE * n + 2 * INSERT
    while bound <= most:
        letters: list[str] = []
        # One frame a state on the path: turn, state, cost so far, steps, next step, least need of the steps.
        path = [[0, entry, 0, _steps(codes, 0, entry, leave is None), 0, most + 1]]
        while path:
            top = path[-1]
            i, q, g, steps, k, _ = top
            if k == 0 and i == n and (q in ENDS if leave is None else q == leave):
                return g, "".join(letters)
            if k < len(steps):
                top[4] += 1
                letter, j, r, cost = steps[k]
                need = needs.get((j, r), h[j])
                if g + cost + need > bound:
                    top[5] = min(top[5], cost + need)
                else:
                    letters.append(letter)
                    path.append([j, r, g + cost, _steps(codes, j, r, leave is None), 0, most + 1])
                continue
            needs[i, q] = max(needs.get((i, q), 0), top[5])
            path.pop()
            if path:
                letters.pop()
                above = path[-1]
                cost = above[3][above[4] - 1][3]
                above[5] = min(above[5], cost + needs[i, q])
        bound = max(bound + 1, needs[0, entry])
    return None


def _chain(blocks: list[list[dict]]) -> tuple[int, str]:
    """The whole conversation's cost and letters from its blocks' answers, last block first."""
    best: dict[int, tuple[int, str, dict | None]] = {}
    chosen: list[dict[int, dict]] = []
    after = {None: 0}
    for options in reversed(blocks):
        best = {}
        for o in options:
            if o["leave"] in after:
                total = o["cost"] + after[o["leave"]]
                old = best.get(o["entry"])
                if old is None or (total, o["audit"]) < old[:2]:
                    best[o["entry"]] = (total, o["audit"], o)
        after = {entry: b[0] for entry, b in best.items()}
        chosen.append({entry: b[2] for entry, b in best.items()})
    state, out = 0, []
    for at in reversed(chosen):
        out.append(at[state]["audit"])
        state = at[state]["leave"]
    return after[0], "".join(out)


# --- the passes, each over Arrow batches of sorted rows ----------------------------------

def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> blocks of letters with the counts that belong to them."""
    block: dict | None = None
    span: list[int] | None = None  # least and largest turn number, how many different ones
    before, out = None, []

    def opened(conv_id, number: int) -> dict:
        return {"conv_id": conv_id, "block": number, "last": False, "codes": [], **dict.fromkeys(COUNTS, 0)}

    def closed(last: bool) -> dict:
        block["last"], block["codes"] = last, "".join(block["codes"])
        if last and span is not None:
            block["gaps"] = span[1] - span[0] + 1 - span[2]
        return block

    for batch in batches:
        for row in batch.to_pylist():
            if block is None or row["conv_id"] != block["conv_id"]:
                if block is not None:
                    out.append(closed(True))
                block, span, before = opened(row["conv_id"], 0), None, None
            turn, initial = row["turn"], row["initial"]
            letter = initial if initial in ("s", "u", "a") else "o"
            if turn is not None:
                span = [turn, turn, 1] if span is None else [span[0], turn, span[2] + (turn != span[1])]
            for copy in range(row["n"]):
                if len(block["codes"]) == BLOCK:
                    out.append(closed(False))
                    block = opened(row["conv_id"], block["block"] + 1)
                fault = "duplicate" if copy and row["fault"] != "blank" else row["fault"]
                block["codes"].append("x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter)
                if fault:
                    block[fault] += 1
                if before is not None and before + initial not in LEGAL:
                    block["illegal"] += 1
                before = initial
        if out:
            yield _batch(out, schema)
            out = []
    if block is not None:
        yield _batch([closed(True)], schema)


def _searched(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks -> their answers for each state to enter and to leave in."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            row["options"] = []
            for leave in (None,) if row["last"] else (0, 1, 2, 3):
                needs: dict[tuple[int, int], int] = {}
                for entry in (0,) if row["block"] == 0 else (0, 1, 2, 3):
                    found = cheapest(row["codes"], entry, leave, needs)
                    if found:
                        row["options"].append({"entry": entry, "leave": leave, "cost": found[0], "audit": found[1]})
        yield _batch(rows, schema)


class _Open:
    """One conversation while its blocks and then its turns pass by."""

    def __init__(self, conv) -> None:
        self.conv, self.blocks, self.counts = conv, [], dict.fromkeys(COUNTS, 0)
        self.audit, self.cost, self.at, self.position, self.state = None, 0, 0, 0, 0
        self.sha = hashlib.sha256()

    def block(self, row: dict) -> None:
        self.blocks.append(row["options"])
        for c in COUNTS:
            self.counts[c] += row[c]

    def _turn(self, role: str, text: str, edit: str, turn: int | None) -> dict:
        self.sha.update(("\n" if self.position else "").encode() + f"{role}:{text}".encode())
        self.position += 1
        return {"conv_id": self.conv, "position": self.position - 1, "role": role, "text": text, "edit": edit, "turn": turn}

    def _inserts(self) -> Iterator[dict]:
        while self.audit[self.at:self.at + 1] == "I":
            letter = FOLLOWS[self.state]
            self.state, self.at = NEXT[self.state, letter], self.at + 1
            yield self._turn(ROLE[letter], "", "I", None)

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = _chain(self.blocks) if self.blocks else (0, "")
            self.blocks = []

    def turn(self, row: dict) -> Iterator[dict]:
        self.settle()
        for _ in range(row["copies"]):
            yield from self._inserts()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit == "D":
                continue
            letter = FOLLOWS[self.state] if edit == "R" else row["role"][:1]
            self.state = NEXT[self.state, letter]
            yield self._turn(ROLE[letter] if edit == "R" else row["role"], row["text"], edit, row["turn"])

    def end(self) -> Iterator[dict]:
        self.settle()
        yield from self._inserts()

    def summary(self) -> dict:
        return {"conv_id": self.conv, **self.counts, "cost": self.cost, "audit": self.audit,
                "repaired_sha256": self.sha.hexdigest()}


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema, summaries: bool) -> Iterator[pa.RecordBatch]:
    """Each conversation's answers and then its turns -> repaired turns, or one summary."""
    now: _Open | None = None
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv:
                if now is not None:
                    rest = list(now.end())
                    out.extend([now.summary()] if summaries else rest)
                now = _Open(row["conv_id"])
            if row["options"] is not None:
                now.block(row)
            else:
                kept = list(now.turn(row))
                if not summaries:
                    out.extend(kept)
        if out:
            yield _batch(out, schema)
    if now is not None:
        rest = list(now.end())
        yield _batch([now.summary()] if summaries else rest, schema)


def _map(df: DataFrame, run, schema: str, *more) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(partial(run, schema=arrow, **dict(more)), schema)


def _passes(turns: DataFrame, summaries: bool) -> DataFrame:
    ship(turns.sparkSession)
    order = (F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"))
    kind = dict(turns.dtypes)["conv_id"]
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), copies.cast("int").alias("copies")).withColumn("digest", F.sha2("text", 256))
    # Faults from digests: texts are read where they are; equal rows are counted before the shuffle.
    bare = F.rtrim("text", F.lit(SPACES))
    light = (rows.where("copies > 0").select(
                 "conv_id", "turn", "role", "digest", "copies", (F.length(bare) == 0).alias("blank"),
                 (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))
             .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").cast("int").alias("n")))
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    coded = (light.withColumn("seen", F.row_number().over(same) > 1)
             .select("conv_id", "turn", "role", "digest", "n", F.substring("role", 1, 1).alias("initial"),
                     F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("truncated"), "truncated").alias("fault")))
    counts = "block int, last boolean, codes string, " + ", ".join(f"{c} long" for c in COUNTS)
    blocks = _map(coded.repartition("conv_id").sortWithinPartitions("conv_id", *order), _blocks, f"conv_id {kind}, {counts}")
    option = "options array<struct<entry int, leave int, cost long, audit string>>"
    # A block is few bytes and much work: so many tasks are kept as there are shuffle partitions.
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answers = _map(blocks.repartition(tasks, "conv_id", "block"), _searched, f"conv_id {kind}, {counts}, {option}")
    both = answers.drop("codes", "last").unionByName(rows, allowMissingColumns=True)
    # A conversation's answers come before its turns: nulls first in the column that only answers lack.
    ordered = both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("copies").isNotNull(), F.col("block").asc_nulls_last(), *order)
    out = (f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string, repaired_sha256 string"
           if summaries else f"conv_id {kind}, position long, role string, text string, edit string, turn long")
    return _map(ordered, _repaired, out, ("summaries", summaries))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """Every turn of the repaired conversations: conv_id, position, role, text, edit, turn.

    ``turns``: conv_id, turn, role, text and perhaps ``copies`` (how often the row stands
    there, 0: not at all). ``turn`` is null for inserted turns.
    """
    return _passes(turns, summaries=False)


def audits(turns: DataFrame) -> DataFrame:
    """One row for every conv_id: faults, cost, edit letters and the repaired text's SHA-256.

    A conversation whose rows all have ``copies`` 0 gets zeros, no letters and the hash of
    the empty text. The hash is taken while the repaired turns stream by.
    """
    return _passes(turns, summaries=True)
