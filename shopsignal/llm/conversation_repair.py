"""Conversation structure repair: the cheapest edits to turns in the order system? (user assistant)+.

Every row is kept, given another role, or deleted, and turns without text may
be inserted anywhere.  Edits have costs; of the cheapest edit lists the one
whose letters (D, I, K, R) come first in ASCII wins.  Both wishes are one
number: an edit's weight is a big integer whose high digits are the cost and
whose low digits are its letters, three digits a row (two inserts and the row
itself), zeros behind.  The rows of a conversation are the layers of a graph
with four states (nothing yet, after system, user, assistant), and the plain
integer minimum over its paths decides everything.

No row's letters can be a prefix of another choice's for the same row, because
only the last letter belongs to the row itself.  So the order of two paths to a
layer is settled there, and after ``SEGMENT`` rows the four states' letters
are put away and replaced by their rank.  Weights stay short and time is linear
in the conversation.  Rows stream through a task in order: it holds one batch,
a conversation's letters, and 32 bytes for each different row of it.  The
sha256 of the repaired text goes along with the four paths.  A conversation is
never cut between tasks, since such a digest is one pass over its text.

Defined cases: a null role or text is one space, a null conv_id is a
conversation of its own, null turns come first.  Rows of one turn are ordered
by role, then text (UTF-8 bytes); equal rows are duplicates of the first.  A
conversation whose rows were all dropped has zeros, an empty audit and the
digest of no bytes.  ``gaps`` beyond a long is the largest long.  An empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE_SPACE

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping is free
SEGMENT = 64
DIGIT = 3  # bits of a letter
FIELD = 3 * DIGIT  # a row's letters
LETTERS = " DIKR"  # by digit; ASCII order
LEGAL = frozenset(("su", "ua", "au"))
MAX_LONG = (1 << 63) - 1

RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
ROWS = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


# ---------------------------------------------------------------- rows
def as_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)`` with a space for a null role or text."""
    space = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    return conversations.select("conv_id", "turn", space("role"), space("text"), F.lit(False).alias("dropped"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(conv_id:turn) mod 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 repeated, 4 said by the user.

    A dropped row stays as a mark that its conversation exists.
    """
    rows = as_rows(conversations)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("kind", F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20)
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


# ---------------------------------------------------------------- the graph
def _next(state: int, initial: str) -> int | None:
    """The state after a turn of that role, if it may follow."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def _wanted(state: int) -> str:
    return "a" if state == USER else "u"


def _code(letters: str) -> int:
    value = 0
    for letter in letters.ljust(3):
        value = value << DIGIT | LETTERS.index(letter)
    return value


def _letters(code: int, digits: int) -> str:
    return "".join(LETTERS[code >> DIGIT * i & (1 << DIGIT) - 1] for i in range(digits - 1, -1, -1)).replace(" ", "")


Edge = tuple[int, int, str]  # cost, code, letters


@cache
def row_edges(initial: str, deleted: bool, truncated: bool) -> list[list[tuple[int, Edge]]]:
    """For each state behind a row, the states before it with the best edge between the two."""
    best: dict[tuple[int, int], Edge] = {}

    def offer(before: int, behind: int | None, cost: int, letters: str) -> None:
        if behind is not None:
            edge = (cost, _code(letters), letters)
            best[before, behind] = min(best.get((before, behind), edge), edge)

    for before in range(4):
        state, cost, letters = before, 0, ""
        for _ in range(3):
            offer(before, state, cost + DELETE, letters + "D")
            if not deleted:
                offer(before, _next(state, initial), cost + TRUNCATED * truncated, letters + "K")
                offer(before, _next(state, _wanted(state)), cost + REROLE + TRUNCATED * truncated, letters + "R")
            state, cost, letters = _next(state, _wanted(state)), cost + INSERT, letters + "I"
    return [[(b, best[b, to]) for b in range(4) if (b, to) in best] for to in range(4)]


@cache
def weighted(initial: str, deleted: bool, truncated: bool, layer: int) -> list[list[tuple[int, int, str]]]:
    """``row_edges`` with each edge's weight in that layer of a segment: ``(before, weight, letters)``."""
    low = FIELD * SEGMENT
    return [
        [(b, (cost << low + 2) + (code << low - FIELD * (layer + 1)), letters) for b, (cost, code, letters) in edges]
        for edges in row_edges(initial, deleted, truncated)
    ]


class Repair:
    """The cheapest paths through the rows of one conversation so far, and its faults."""

    def __init__(self) -> None:
        self.weights: list[int | None] = [0, None, None, None]
        self.digests = [hashlib.sha256()] * 4
        self.begun = [False] * 4  # whether a path has any turn yet (line ends stand between turns)
        self.layer = 0
        self.order = [NOTHING]  # the states by rank when the segment began
        self.segments: list[list[tuple[int, str] | None]] = []
        self.seen: set[tuple[str, bytes]] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_initial: str | None = None
        self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        raw = text.encode()
        row = (role, hashlib.sha256(raw).digest())
        body = text.rstrip(WHITE_SPACE)
        blank, duplicate, truncated = not body, row in self.seen, body[-1:] not in (".", "!", "?")
        self.seen.add(row)
        if blank:
            self.blank += 1
        elif duplicate:
            self.duplicate += 1
        elif truncated:
            self.truncated += 1
        self._step(initial if initial in ("s", "u", "a") else "", blank or duplicate, truncated, role, raw)

    def _step(self, initial: str, deleted: bool, truncated: bool, role: str, raw: bytes) -> None:
        weights, digests, begun = self.weights, self.digests, self.begun
        new_weights: list[int | None] = [None] * 4
        new_digests, new_begun = list(digests), list(begun)
        for to, edges in enumerate(weighted(initial, deleted, truncated and not deleted, self.layer)):
            best, chosen = None, None
            for edge in edges:
                if weights[edge[0]] is not None and (best is None or weights[edge[0]] + edge[1] < best):
                    best, chosen = weights[edge[0]] + edge[1], edge
            if chosen is None:
                continue
            new_weights[to] = best
            new_digests[to], new_begun[to] = self._said(chosen[0], chosen[2], role, raw)
        self.weights, self.digests, self.begun = new_weights, new_digests, new_begun
        self.layer += 1
        if self.layer == SEGMENT:
            self._put_away()

    def _said(self, state: int, letters: str, role: str = "", raw: bytes = b""):
        """The digest after a path's edits to one row."""
        digest, begun = self.digests[state], self.begun[state]
        for i, (letter, said_by, said) in enumerate(edited(state, letters, role, raw)):
            if i == 0:
                digest = digest.copy()
            digest.update((b"\n" if begun else b"") + said_by.encode() + b":")
            digest.update(said)
            begun = True
        return digest, begun

    def _put_away(self) -> None:
        """Put the letters of this segment away and let the paths' ranks stand for them."""
        low = FIELD * SEGMENT
        letters, ranked = (1 << low) - 1, (4 << low) - 1
        if self.layer:
            self.segments.append([
                None if w is None else (self.order[w >> low & 3], _letters(w & letters, 3 * SEGMENT)) for w in self.weights
            ])
        self.order = sorted((s for s in range(4) if self.weights[s] is not None), key=lambda s: self.weights[s] & ranked)
        for rank, s in enumerate(self.order):
            self.weights[s] = (self.weights[s] >> low + 2 << low + 2) + (rank << low)
        self.layer = 0

    def result(self) -> tuple:
        self._put_away()
        low = FIELD * SEGMENT
        best = None
        for state, w in enumerate(self.weights):
            behind, letters = state, ""
            for n_inserts in range(3):
                if w is not None and behind in ACCEPTED:
                    total = w + (INSERT * n_inserts << low + 2) + (_code(letters) << low - FIELD)
                    best = min(best or (total, state, letters), (total, state, letters))
                behind, letters = _next(behind, _wanted(behind)), letters + "I"
        total, state, letters = best
        digest, _ = self._said(state, letters)
        parts = [letters]
        for segment in reversed(self.segments):
            state, piece = segment[state]
            parts.append(piece)
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (min(gaps, MAX_LONG), self.blank, self.duplicate, self.truncated, self.illegal, total >> low + 2,
                "".join(reversed(parts)), digest.hexdigest())


def edited(state: int, letters: str, role, text) -> Iterator[tuple[str, str, object]]:
    """``(letter, role, text)`` of the turns that a row's edits leave behind, from the state before it."""
    nothing = type(text)()
    for letter in letters:
        if letter == "D":
            continue
        by, said = role, text
        if letter != "K":
            by = "assistant" if _wanted(state) == "a" else "user"
            said = nothing if letter == "I" else text
        yield letter, by, said
        state = _next(state, by[:1])


# ---------------------------------------------------------------- jobs
def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "text")


def decide(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of ``as_rows`` or ``damage``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])
        current, at, out = None, None, []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for conv, turn, role, text, dropped in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv != at:
                    if current is not None:
                        out.append((at, *current.result()))
                    current, at = Repair(), conv
                if not dropped:
                    current.add(turn, role, text)
            if out:
                yield flush()
                out = []
        if current is not None:
            out.append((at, *current.result()))
            yield flush()

    return _in_order(rows.select("conv_id", "turn", "role", "text", "dropped")).mapInArrow(run, RESULT)


def repaired(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The repaired conversations: one row a turn, with its place and the edit that made it (I: no row stands behind it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "place", "edit", "turn", "role", "text"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        audit, at, state, place = "", 0, NOTHING, 0
        for batch in batches:
            out: list[tuple] = []
            for conv, of_rows, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if of_rows == 0:
                    audit, at, state, place = text, 0, NOTHING, 0
                end = at
                while end < len(audit) and audit[end] == "I":
                    end += 1
                # The conversation's closing inserts come with its last mark, every other letter with its row.
                letters = audit[at:end + 1] if of_rows == 1 else audit[at:] if of_rows == 2 else ""
                at += len(letters)
                for letter, by, said in edited(state, letters, role, text):
                    out.append((conv, place, letter, None if letter == "I" else turn, by, said))
                    place, state = place + 1, _next(state, by[:1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    mark = lambda kind, text: decisions.select(
        "conv_id", F.lit(kind).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), text.alias("text"))
    body = rows.filter(~F.col("dropped")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    every = body.unionByName(mark(0, F.col("audit"))).unionByName(mark(2, F.lit("")))
    return _in_order(every, "kind").mapInArrow(run, ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
