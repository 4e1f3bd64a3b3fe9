"""Conversation structure repair: the cheapest edits that give a conversation legal turns.

A conversation is legal if it is empty, or if its roles' initials are ``s?(ua)+``: perhaps a system
row, then user and assistant by turns.  Its rows are taken by turn (nulls first; rows of one turn by
role and text).  A row's first fault counts: blank (nothing but white space), duplicate (its role
and text came earlier), truncated (its last character that is no white space is not ``.``, ``!`` or
``?``).  Edits, in ASCII order: D delete (3; blank and duplicate rows have no other), I insert an
empty row of the user or assistant (2), K keep (0), R give the row the user's or assistant's role
(2); a truncated row that stays adds 1.  Which role is inserted or given follows from the state of
the automaton, so the edits' initials tell the whole repair.

Method: iterative-deepening A*.  ``cheapest`` searches depth-first in ASCII order of the edits under
a bound on the cost, which starts at the estimate and rises to the least sum that went over it; a
table holds the largest remaining budget with which each state has failed.  The first path that is
accepted is the cheapest, and of these the one with the least string.

Conversations of any length are searched in pieces of at most PIECE rows.  The automaton has four
states, so what a piece may cost is a table of four by four; the tables of adjoining pieces are
joined in groups of FAN, level by level, and the costs to go from the end of each piece come back
the same way.  A piece's search then accepts a path if its cost and the costs to go from its state
meet the bound.  An insertion belongs to the row after it, so no piece's string begins another one,
and least strings of pieces are the least string of the whole.

Rows are sorted once, by ranges, so a conversation with most of the rows is spread over tasks; rows
seen earlier are found by aggregates of hashes (128 bits).  Only the last step, whose digest is one SHA-256
over a conversation, sends a conversation's rows through one task: as a sorted stream, of which a
piece is held at a time (and the edits' string, which is a column of the result).

Results for odd input: a null role or text is one space; null ids are one conversation; a role's
initial is its first character, and a row whose initial is none of s, u and a can't be kept; rows
that repeat are duplicates; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import NULL_ID, written

PIECE_BITS = 5
FAN_BITS = 10
PIECE, FAN = 1 << PIECE_BITS, 1 << FAN_BITS
SALTS = 16
# Costs of edits.
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
# States: nothing yet, after system, after user, after assistant.  Symbols: system, user, assistant, other.
AFTER = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
ADDED = (2, 2, 3, 2)             # the state after an inserted row, or a row with a new role
ROLE = {2: "user", 3: "assistant"}
TO_END = (0, 2 * INSERT, INSERT, 0)  # insertions after the last row
LEGAL = {(0, 1), (1, 2), (2, 1)}
# Bits of a row's code above its symbol.
BLANK, TRUNCATED, DUPLICATE = 4, 8, 16
BLANKS = r"[\x20\x09-\x0D]"
FAR = 1 << 40


# ---------------------------------------------------------------- search

@lru_cache(maxsize=1 << 16)
def cheapest(codes: bytes, start: int, to_go: tuple[int, ...]) -> tuple[str, int, int]:
    """Edits of the rows, their cost and the state after them; ``to_go``: costs from each state to the end."""
    n = len(codes)
    least = [min(to_go)] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if codes[i] & (BLANK | DUPLICATE) else CUT if codes[i] & TRUNCATED else 0)
    bound = least[0]
    path: list[str] = []
    while True:
        failed: dict[int, int] = {}
        over, end = FAR, -1

        def walk(i: int, state: int, left: int) -> bool:
            nonlocal over, end
            need = to_go[state] if i == n else least[i]
            if need > left:
                over = min(over, bound - left + need)
                return False
            if i == n:
                end = state
                return True
            key = i << 2 | state
            if failed.get(key, -1) >= left:
                return False
            code = codes[i]
            cut = CUT if code & TRUNCATED else 0
            steps = [("D", i + 1, state, DELETE), ("I", i, ADDED[state], INSERT)]
            if not code & (BLANK | DUPLICATE):
                kept = AFTER[state][code & 3]
                if kept is not None:
                    steps.append(("K", i + 1, kept, cut))
                steps.append(("R", i + 1, ADDED[state], REROLE + cut))
            for edit, j, after, cost in steps:
                path.append(edit)
                if walk(j, after, left - cost):
                    return True
                path.pop()
            failed[key] = left
            return False

        if walk(0, start, bound):
            return "".join(path), bound - to_go[end], end
        bound = over


def _row_table(code: int) -> np.ndarray:
    """Costs from state to state over insertions and then the row."""
    out = np.full((4, 4), FAR, np.int64)
    for start in range(4):
        state, paid = start, 0
        for _ in range(4):  # more insertions come back to a state
            out[start, state] = min(out[start, state], paid + DELETE)
            if not code & (BLANK | DUPLICATE):
                cut = CUT if code & TRUNCATED else 0
                kept = AFTER[state][code & 3]
                if kept is not None:
                    out[start, kept] = min(out[start, kept], paid + cut)
                out[start, ADDED[state]] = min(out[start, ADDED[state]], paid + REROLE + cut)
            state, paid = ADDED[state], paid + INSERT
    return out


ROW_TABLES = [_row_table(code) for code in range(32)]


def joined(tables) -> np.ndarray:
    """The costs over adjoining pieces."""
    out = None
    for t in tables:
        out = t if out is None else np.minimum((out[:, :, None] + t[None]).min(1), FAR)
    return out


# ---------------------------------------------------------------- rows and pieces

def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows with faults put in by the checksum of ``conversation:turn``: one in twenty each is dropped,
    emptied, loses its ``.!?``, is repeated, gets the role user.  Nulls are one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col))), F.lit(20))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    return (rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), kind.alias("_kind"),
                        text_of(role_col).alias("_role"), text_of(text_col).alias("_text"))
            .where("_kind != 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))


def _key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def _ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows with their place ``_pos`` in the order of conversations and turns, and code."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(_key(conv_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"),
                       given(role_col).alias("_role"), given(text_col).alias("_text"))
    turn = F.col("_turn").asc_nulls_first()
    rows = (rows.repartitionByRange("_conv", turn, "_role", F.substring("_text", 1, 32))
            .sortWithinPartitions("_conv", turn, "_role", "_text").withColumn("_pos", F.monotonically_increasing_id()))
    initial = F.substring("_role", 1, 1)
    symbol = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("_text").rlike(rf"[.!?]{BLANKS}*+\z")
    code = symbol + F.when(blank, BLANK).when(~whole, TRUNCATED).otherwise(0)
    same = F.md5(F.encode(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), "UTF-8"))
    return written(rows.sparkSession, rows.withColumn("_code", code.cast("int")).withColumn("_same", F.unhex(same)), "turns")


def _repeats(ordered: DataFrame) -> DataFrame:
    """``_conv``, ``_pos`` of rows whose role and text came earlier in their conversation."""
    first = (ordered.groupBy("_conv", "_same").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select("_conv", "_same", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    rows = ordered.select("_conv", "_same", "_pos", F.pmod(F.xxhash64("_pos"), F.lit(SALTS)).cast("int").alias("_salt"))
    return rows.join(first, ["_conv", "_same", "_salt"]).where("_pos > _first").select("_conv", "_pos")


def _piece(pos: str = "_pos") -> Column:
    return F.shiftright(F.col(pos), PIECE_BITS)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, piece, list of (pos, code)): the piece's table."""
    for b in batches:
        made = [joined([ROW_TABLES[r["_code"]] for r in rows]).ravel() for rows in b.column(2).to_pylist()]
        yield _batch(b.column(0), b.column(1), made, "_table")


def _joined_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, list of (block of the level below, table)): the block's table."""
    for b in batches:
        made = [joined([np.array(r["_table"], np.int64).reshape(4, 4) for r in rows]).ravel() for rows in b.column(2).to_pylist()]
        yield _batch(b.column(0), b.column(1), made, "_table")


def _costs_to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, list of (block, table), costs to go after them): the costs to go after each block."""
    for b in batches:
        conv, block, made = [], [], []
        for c, rows, after in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            go = np.array(after, np.int64)
            for r in reversed(rows):
                conv.append(c)
                block.append(r["_block"])
                made.append(go)
                go = (np.array(r["_table"], np.int64).reshape(4, 4) + go).min(1)
        yield _batch(pa.array(conv, pa.int64()), pa.array(block, pa.int64()), made, "_go")


def _batch(conv, block, made: list[np.ndarray], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([conv, block, pa.array([m.tolist() for m in made], pa.list_(pa.int64()))],
                                      names=["_conv", "_block", name])


def _to_go(ordered: DataFrame, repeats: DataFrame) -> DataFrame | None:
    """``_conv``, ``_block`` (piece) and ``_go``, the costs to the end after it, of conversations of several pieces."""
    spark = ordered.sparkSession
    long = (ordered.groupBy("_conv").agg(F.min(_piece()).alias("lo"), F.max(_piece()).alias("hi")).where("lo < hi").select("_conv"))
    long = written(spark, long, "long-conversations")
    if long.isEmpty():
        return None
    rows = (ordered.select("_conv", "_pos", "_code").join(long, "_conv", "left_semi")
            .join(repeats.withColumn("_again", F.lit(DUPLICATE)), ["_conv", "_pos"], "left")
            .select("_conv", _piece().alias("_block"), F.struct(
                "_pos", (F.col("_code") + F.coalesce("_again", F.lit(0))).alias("_code")).alias("r")))
    made = rows.groupBy("_conv", "_block").agg(F.sort_array(F.collect_list("r")).alias("rows"))  # PIECE rows at most
    levels = [written(spark, made.mapInArrow(_tables, "_conv long, _block long, _table array<long>"), "pieces")]
    groups = []
    while True:
        group = (levels[-1].groupBy("_conv", F.shiftright("_block", FAN_BITS).alias("_over"))
                 .agg(F.sort_array(F.collect_list(F.struct("_block", "_table"))).alias("rows")))  # FAN tables at most
        groups.append(written(spark, group, "groups"))
        if groups[-1].groupBy("_conv").count().where("count > 1").isEmpty():
            break
        levels.append(written(spark, groups[-1].mapInArrow(_joined_tables, "_conv long, _block long, _table array<long>"), "blocks"))
    go = groups[-1].select("_conv", "rows", F.array(*[F.lit(c).cast("long") for c in TO_END]).alias("_after"))
    for group in [*groups[-2::-1], None]:
        below = written(spark, go.mapInArrow(_costs_to_go, "_conv long, _block long, _go array<long>"), "to-go")
        if group is None:
            return below
        over = below.select("_conv", F.col("_block").alias("_over"), F.col("_go").alias("_after"))
        go = group.join(over, ["_conv", "_over"]).select("_conv", "rows", "_after")


# ---------------------------------------------------------------- conversations

class _Conversation:
    """A conversation's rows, given in order, piece by piece; ``rows``: where the repaired rows are kept."""

    def __init__(self, conv: int, rows: list | None):
        self.conv, self.rows = conv, rows
        self.state, self.cost, self.edits = 0, 0, []
        self.faults, self.illegal, self.before = [0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = self.written = 0
        self.digest = hashlib.sha256()
        self.piece, self.held, self.codes, self.go = -1, [], bytearray(), TO_END

    def add(self, pos: int, turn: int | None, role: str, text: str, code: int) -> None:
        self.to_piece(pos)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        fault = 0 if code & BLANK else 1 if code & DUPLICATE else 2 if code & TRUNCATED else None
        if fault is not None:
            self.faults[fault] += 1
        symbol = code & 3
        self.illegal += self.before is not None and (self.before, symbol) not in LEGAL
        self.before = symbol
        self.held.append((turn, role, text))
        self.codes.append(code)

    def to_piece(self, pos: int) -> None:
        if pos >> PIECE_BITS != self.piece:
            self.flush()
            self.piece = pos >> PIECE_BITS

    def flush(self) -> None:
        if self.codes:
            edits, cost, _ = cheapest(bytes(self.codes), self.state, self.go)
            self.cost += cost
            self.edits.append(edits)
            at = 0
            for e in edits:
                if e == "I":
                    self.insert(e)
                    continue
                turn, role, text = self.held[at]
                if e == "K":
                    self.state = AFTER[self.state][self.codes[at] & 3]
                    self.put(e, turn, role, text)
                elif e == "R":
                    self.state = ADDED[self.state]
                    self.put(e, turn, ROLE[self.state], text)
                at += 1
        self.held, self.codes, self.go = [], bytearray(), TO_END

    def insert(self, edit: str) -> None:
        self.state = ADDED[self.state]
        self.put(edit, None, ROLE[self.state], "")

    def put(self, edit: str, turn: int | None, role: str, text: str) -> None:
        if self.written:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        if self.rows is not None:
            self.rows.append((self.conv, self.written, edit, turn, role, text))
        self.written += 1

    def result(self) -> tuple:
        self.flush()
        while self.state in (1, 2):
            self.insert("I")
            self.edits.append("I")
            self.cost += INSERT
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults, self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest())


REPORT = [("_conv", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
REPAIRED = [("_conv", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
            ("text", pa.string())]
OF_CONV, OF_PIECE, OF_REPEAT, OF_ROW = range(4)


def _streamed(batches: Iterator[pa.RecordBatch], want_rows: bool) -> Iterator[pa.RecordBatch]:
    """(conv, pos, kind, turn, role, text, code, costs to go) sorted by the first three."""
    kinds = REPAIRED if want_rows else REPORT
    now, again, out = None, None, []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out) if out else [()] * len(kinds), kinds)],
                                          names=[name for name, _ in kinds])

    for b in batches:
        for conv, pos, kind, turn, role, text, code, go in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    report = now.result()
                    if not want_rows:
                        out.append(report)
                now, again = _Conversation(conv, out if want_rows else None), None
            if kind == OF_PIECE:
                now.to_piece(pos)
                now.go = tuple(go)
            elif kind == OF_REPEAT:
                again = pos
            elif kind == OF_ROW:
                now.add(pos, turn, role, text, code | DUPLICATE if again == pos else code)
        yield batch()
        out.clear()
    if now is not None:
        report = now.result()
        if not want_rows:
            out.append(report)
        yield batch()


def _repaired(rows: DataFrame, conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
              want_rows: bool) -> DataFrame:
    spark = rows.sparkSession
    ordered = _ordered(rows, conv_col, turn_col, role_col, text_col)
    repeats = written(spark, _repeats(ordered), "repeats")
    none = lambda kind, c: F.lit(None).cast(kind).alias(c)

    def part(df: DataFrame, kind: int, go: Column | None = None) -> DataFrame:
        return df.select("_conv", "_pos", F.lit(kind).alias("_kind"), none("long", "_turn"), none("string", "_role"),
                         none("string", "_text"), none("int", "_code"), none("array<long>", "_go") if go is None else go)
    stream = (ordered.select("_conv", "_pos", F.lit(OF_ROW).alias("_kind"), "_turn", "_role", "_text", "_code", none("array<long>", "_go"))
              .unionByName(part(repeats, OF_REPEAT))
              .unionByName(part(conversations.select("_conv", F.lit(-1).cast("long").alias("_pos")), OF_CONV)))
    go = _to_go(ordered, repeats)
    if go is not None:
        go = go.withColumn("_pos", F.shiftleft("_block", PIECE_BITS))
        stream = stream.unionByName(part(go, OF_PIECE, F.col("_go")))
    stream = stream.repartition("_conv").sortWithinPartitions("_conv", "_pos", "_kind")
    names = {pa.int64(): "long", pa.string(): "string"}
    schema = ", ".join(f"{name} {names[t]}" for name, t in (REPAIRED if want_rows else REPORT))
    out = stream.mapInArrow(lambda it: _streamed(it, want_rows), schema)
    public = F.when(F.col("_conv") != F.lit(NULL_ID), F.col("_conv")).alias("conv_id")
    return out.select(public, *[c for c in out.columns if c != "_conv"])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations' rows: conv_id, place (from 0), edit (K, R or I), turn (null: inserted), role, text."""
    none = rows.select(_key(conv_col).alias("_conv")).limit(0)
    return _repaired(rows, none, conv_col, turn_col, role_col, text_col, want_rows=True)


def report(rows: DataFrame, original: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation of ``original`` (by default ``rows``): its faults, the cost and initials of the edits, and a digest
    of the repaired ``role:text`` lines."""
    conversations = (rows if original is None else original).select(_key(conv_col).alias("_conv")).distinct()
    return _repaired(rows, conversations, conv_col, turn_col, role_col, text_col, want_rows=False)


def damage_report(rows: DataFrame) -> DataFrame:
    """``report`` of the rows after ``damage``, for every conversation that was there before."""
    return report(damage(rows), rows)
