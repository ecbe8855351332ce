"""Repair of conversation structure by iterative-deepening A*.

A conversation is well formed if its role initials match ``(s?(ua)+)?``. Every turn can be
kept, given the other role, or deleted, and empty turns can be inserted; the cheapest edits
are sought, and of equal costs those whose initials are least in ASCII order.

``search`` is the method: depth first in ASCII edit order under growing cost bounds, with a
table of states and budgets that failed; the first path that accepts is the answer. What a
repair still pays at least (forced deletions, truncated turns) prunes every branch.

Turns are dealt in ranges of (conversation, turn), so that no conversation has to fit one
task. One that lies within a range, in at most ``PIECE`` turns, is searched whole. Others
are cut to pieces of at most ``PIECE`` turns, each searched for every pair of states before
and after it, and neighbouring pieces are joined, 64 at a time, by the least cost and text.
That is exact: of two edit texts of one piece with equal ends and costs none begins the
other, since a longer one would insert more, so the least text of a whole is put together
from least texts of its pieces. Texts take no part in any of this; their flags and hashes do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from layercake.llm.shipping import ship
from layercake.session import write_scratch

#: What has been said last: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTING = (START, ASSISTANT)
#: States by role initial, and the one that an inserted or changed turn leads to.
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
SPOKEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

# Costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

#: Turns of a piece that is searched at once, and bits of the pieces joined at once.
PIECE = 64
_JOIN_BITS = 6

_BLANK = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


class Turn(NamedTuple):
    """A turn for the search; ``forced``: a run of that many turns to delete."""

    initial: str
    truncated: int
    forced: int = 0


def search(turns: list[Turn], begin: int = START, goals: tuple[int, ...] = ACCEPTING, failed: dict | None = None) -> tuple[int, str] | None:
    """Cost and edits (``D``, ``I``, ``K``, ``R``) of the cheapest repair that leads from
    state ``begin`` to one of ``goals``, of equal costs the ASCII-least; None if there is
    none. ``failed`` may be shared by calls with the same turns and goals."""
    if not any(_reachable(turns, begin, goal) for goal in goals):
        return None
    n = len(turns)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE * turns[i].forced or TRUNCATED * turns[i].truncated)
    failed = {} if failed is None else failed  # (place, state) -> largest budget that failed

    def visit(i: int, state: int, budget: int) -> str | None:
        if budget < least[i] or failed.get((i, state), -1) >= budget:
            return None
        if i == n and state in goals:
            return ""
        turn = turns[i] if i < n else None
        if turn:
            rows = turn.forced or 1
            rest = visit(i + 1, state, budget - DELETE * rows)
            if rest is not None:
                return "D" * rows + rest
        rest = visit(i, SPOKEN[state], budget - INSERT)
        if rest is not None:
            return "I" + rest
        if turn and not turn.forced:
            cost = TRUNCATED * turn.truncated
            if turn.initial in FOLLOWS[state]:
                rest = visit(i + 1, FOLLOWS[state][turn.initial], budget - cost)
                if rest is not None:
                    return "K" + rest
            rest = visit(i + 1, SPOKEN[state], budget - cost - REROLE)
            if rest is not None:
                return "R" + rest
        failed[i, state] = budget
        return None

    bound = least[0]
    while True:
        edits = visit(0, begin, bound)
        if edits is not None:
            return bound, edits
        bound += 1


def _reachable(turns: list[Turn], begin: int, goal: int) -> bool:
    if goal == START:
        return begin == START
    if goal == SYSTEM:
        return begin == SYSTEM or begin == START and any(t.initial == "s" and not t.forced for t in turns)
    return True


_PATH = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_SUMMARY = T.StructType(
    [
        T.StructField("conv", T.LongType()),
        T.StructField("slice", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("first_turn", T.LongType()),
        T.StructField("last_turn", T.LongType()),
        T.StructField("first_initial", T.StringType()),
        T.StructField("last_initial", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("paths", T.ArrayType(_PATH)),
    ]
)


class _Piece:
    """Up to ``PIECE`` neighbouring turns of one conversation."""

    def __init__(self, conv: int | None, seq: int, from_start: bool):
        self.conv, self.seq, self.from_start = conv, seq, from_start
        self.turns: list[Turn] = []
        self.row = dict.fromkeys(_COUNTS, 0) | {"first_turn": None, "last_turn": None, "first_initial": None, "last_initial": None}

    def add(self, turn: int | None, initial: str, blank: bool, truncated: bool, first: bool, copies: int) -> None:
        row = self.row
        if row["last_initial"] is None:
            row["first_initial"] = initial
        else:
            row["illegal"] += row["last_initial"] + initial not in LEGAL_PAIRS
        row["last_initial"] = initial
        row["illegal"] += copies - 1  # no legal pair has equal initials
        if turn is not None:
            row["turns"] += turn != row["last_turn"]
            row["first_turn"] = turn if row["first_turn"] is None else row["first_turn"]
            row["last_turn"] = turn
        if blank:
            row["blank"] += copies
            self.turns.append(Turn("", 0, copies))
            return
        if first:
            row["truncated"] += truncated
            self.turns.append(Turn(initial, int(truncated)))
        if copies > first:
            row["duplicate"] += copies - first
            self.turns.append(Turn("", 0, copies - first))

    def summary(self, ended: bool) -> dict:
        """``ended``: the next turn is known to be of another conversation."""
        whole = ended and self.from_start and not self.seq
        if whole:
            cost, audit = search(self.turns)
            paths = [(START, ASSISTANT, cost, audit)]
        else:
            begins = (START,) if self.from_start and not self.seq else STATES
            paths = []
            for goal in STATES:
                failed: dict = {}
                for begin in begins:
                    found = search(self.turns, begin, (goal,), failed)
                    if found:
                        paths.append((begin, goal, *found))
        return self.row | {"conv": self.conv, "seq": self.seq, "whole": whole, "paths": [dict(zip(("a", "b", "cost", "audit"), p, strict=True)) for p in paths]}


def _table(rows: list[dict], slice_no: int | None = None) -> pa.RecordBatch:
    if slice_no is not None:
        for row in rows:
            row["slice"] = slice_no
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(_SUMMARY))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries of the pieces of one range of turns, in order."""
    piece: _Piece | None = None
    slice_no, out = 0, []
    for batch in batches:
        columns = batch.to_pydict()
        slice_no = columns["slice"][0] if batch.num_rows else slice_no
        for conv, *turn in zip(*[columns[c] for c in ("conv", "turn", "initial", "blank", "cut", "first", "copies")], strict=True):
            if piece is None:
                piece = _Piece(conv, 0, False)  # may go on from the range before
            elif piece.conv != conv:
                out.append(piece.summary(ended=True))
                piece = _Piece(conv, 0, True)
            elif len(piece.turns) >= PIECE:
                out.append(piece.summary(ended=False))
                piece = _Piece(conv, piece.seq + 1, piece.from_start)
            piece.add(*turn)
            if len(out) >= 1000:
                yield _table(out, slice_no)
                out = []
    if piece is not None:
        out.append(piece.summary(ended=False))
    yield _table(out, slice_no)


def joined(left: dict, right: dict) -> dict:
    """The summary of two neighbouring pieces."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p in left["paths"]:
        for q in right["paths"]:
            if p["b"] == q["a"]:
                way = p["cost"] + q["cost"], p["audit"] + q["audit"]
                key = p["a"], q["b"]
                best[key] = min(best.get(key, way), way)
    row = {c: left[c] + right[c] for c in _COUNTS}
    row["illegal"] += left["last_initial"] + right["first_initial"] not in LEGAL_PAIRS
    row["turns"] -= left["last_turn"] is not None and left["last_turn"] == right["first_turn"]
    row |= {
        "conv": left["conv"],
        "slice": 0,
        "seq": left["seq"],
        "whole": False,
        "first_turn": right["first_turn"] if left["first_turn"] is None else left["first_turn"],
        "last_turn": left["last_turn"] if right["last_turn"] is None else right["last_turn"],
        "first_initial": left["first_initial"],
        "last_initial": right["last_initial"],
        "paths": [{"a": a, "b": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in best.items()],
    }
    return row


def _join(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    while len(rows) > 1:  # neighbours first, so that no text is copied more than six times
        rows = [joined(*rows[i : i + 2]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
    rows[0]["seq"] >>= _JOIN_BITS
    return pa.Table.from_batches([_table(rows)])


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text, and the hash of the text that orders rows with equal turn
    and role. Null roles and texts are empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return rows.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def find_repairs(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The cheapest repair of every conversation: the conversation column, ``gaps`` (turn
    numbers missing between the least and the greatest), ``blank``, ``duplicate`` and
    ``truncated`` (turns by first fault), ``illegal`` (neighbours whose role initials do not
    follow each other), ``cost`` and ``audit`` (edit initials in order).

    Turns are taken by turn number, nulls first, then by role and the SHA-256 of the text;
    identical rows are neighbours, and all but the first are duplicates. A null role or text
    is an empty one; rows with a null conversation are one conversation. Other columns are
    ignored. An empty table gives no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    key = ["conv", "turn", "role", "digest"]
    # identical rows meet map-side; each key is one row from here on, so none is hot
    distinct = turns.select(*key, (~F.col("text").rlike(_BLANK)).alias("blank"), (~F.col("text").rlike(_ENDED)).alias("cut")).groupBy(*key, "blank", "cut").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    least = distinct.groupBy("conv", "role", "digest").agg(F.min(order).alias("at"))
    firsts = least.select(F.col("conv").alias("f_conv"), F.col("at.turn").alias("f_turn"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), F.lit(True).alias("first"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in key]  # unique on both sides
    marked = distinct.join(firsts, on=same, how="left").select(*key, "blank", "cut", "copies", F.coalesce("first", F.lit(False)).alias("first"))
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.repartitionByRange(slices, *_order()).sortWithinPartitions(*_order())
    ranged = ranged.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "cut", "first", "copies", F.spark_partition_id().alias("slice"))
    pieces = write_scratch(ranged.mapInArrow(_pieces, _SUMMARY), "pieces")

    done = pieces.where("whole")
    parts = pieces.where("NOT whole")
    top = parts.agg(F.max("slice").alias("slice"), F.max("seq").alias("seq")).first()
    if top["slice"] is not None:
        bits = int(top["seq"]).bit_length()
        parts = parts.withColumn("seq", F.shiftleft(F.col("slice").cast("long"), bits).bitwiseOR(F.col("seq")))
        for _ in range(max(1, -(-(int(top["slice"]).bit_length() + bits) // _JOIN_BITS))):
            parts = parts.groupBy("conv", F.shiftright("seq", _JOIN_BITS)).applyInArrow(_join, _SUMMARY)
        done = done.unionByName(parts)
    ends = F.filter("paths", lambda p: (p["a"] == START) & p["b"].isin(*ACCEPTING))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return done.withColumn("best", best).select(F.col("conv").alias(conv_col), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))


def _replay(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, tuple[str, str] | None]]:
    """(conversation, None) at the beginning of each, then (conversation, (role, text)) of
    each of its repaired turns. Every conversation's edits come before its turns."""
    conv, edits, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple[int | None, tuple[str, str]]]:
        nonlocal at, state
        while edits[at : at + 1] == "I":
            at, state = at + 1, SPOKEN[state]
            yield conv, (ROLE[state], "")

    for batch in batches:
        for own, audit, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if audit is not None:
                yield from inserted()  # after the last turn of the conversation before
                conv, edits, at, state = own, audit, 0, START
                yield conv, None
                continue
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == "K":
                state = FOLLOWS[state][role[:1]]
                yield conv, (role, text)
            elif edit == "R":
                state = SPOKEN[state]
                yield conv, (ROLE[state], text)
    yield from inserted()


def _with_edits(rows: DataFrame, repairs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Edits and turns of each conversation in order, in one task, which reads them as a
    stream: batches are all that it holds besides the edits."""
    turns = _turns(rows, conv_col, turn_col, role_col, text_col).withColumn("audit", F.lit(None).cast("string"))
    heads = repairs.select(F.col(conv_col).alias("conv"), "audit").select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), "audit")
    order = [F.col("conv").asc_nulls_first(), F.col("audit").isNull().asc(), *_order()[1:]]
    return heads.unionByName(turns).repartition("conv").sortWithinPartitions(*order).select("conv", "audit", "role", "text")


def repaired_turns(rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns of every conversation after the edits of ``find_repairs``: the conversation
    column, ``place`` (from 0), ``role`` and ``text``."""
    ship(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for conv, said in _replay(batches):
            if said is None:
                place = 0
                continue
            out.append((conv, place, *said))
            place += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    names, kinds = ["conv", "place", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()]
    done = _with_edits(rows, repairs, conv_col, turn_col, role_col, text_col).mapInArrow(run, "conv long, place long, role string, text string")
    return done.withColumnRenamed("conv", conv_col)


def repaired_digests(rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """SHA-256 (``repaired_sha256``, lowercase hex) of every repaired conversation: its
    ``role:text`` lines joined by newlines. A hash is sequential, so a conversation passes
    through one task, as a stream."""
    ship(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, begun = [], None, False
        for conv, said in _replay(batches):
            if said is None:
                if digest is not None:
                    out[-1] = out[-1][0], digest.hexdigest()
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pydict({"conv": pa.array([c for c, _ in out], pa.int64()), "sha": [s for _, s in out]})
                    out = []
                out.append((conv, ""))
                digest, begun = hashlib.sha256(), False
                continue
            digest.update((("\n" if begun else "") + ":".join(said)).encode())
            begun = True
        if digest is not None:
            out[-1] = out[-1][0], digest.hexdigest()
            yield pa.RecordBatch.from_pydict({"conv": pa.array([c for c, _ in out], pa.int64()), "sha": [s for _, s in out]})

    done = _with_edits(rows, repairs, conv_col, turn_col, role_col, text_col).mapInArrow(run, "conv long, sha string")
    return done.select(F.col("conv").alias(conv_col), F.col("sha").alias("repaired_sha256"))
