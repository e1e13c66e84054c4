"""Conversation structure repair: the cheapest edits that give legal roles.

Rows of a conversation stand in the order of turn (nulls first), role, text.  The role
initials of the repaired conversation form ``(s?(ua)+)?``.  Edits: Keep costs 0, Rerole (to
user or assistant) 2, Delete 3, Insert (an empty user or assistant turn, anywhere) 2; a
truncated row that is not deleted adds 1; blank rows and duplicates must go.  Of the
cheapest edit sequences the one whose initials are least in ASCII order is taken.

Weights are single integers.  The high digits are the cost; below them stand
``width`` digits of base 8, one for each edit's letter in order (D 1, I 2, K 3, R 4), zero
beyond the end, so that of equal costs the smaller integer is the smaller string.  The
minimum of plain integers over a DAG (row by row, the four states of the pattern) decides
costs and ties alike.

The sorted table is cut into blocks of one conversation, of at most ``BLOCK_ROWS`` different
rows and about ``BLOCK_BYTES`` of text.  A block that holds a whole conversation is solved on the spot.
Any other block gives the least integer from every state to every state, and such blocks are
joined by minimum and concatenation.
(Sequences of equal cost over the same rows never start with one another, because a longer
one has more inserts: so the least of a block stays the least in the whole.)  A
conversation with very many rows is thus spread over tasks; only its blocks' integers meet,
which together are as long as the audit that it gets as one value.  Rows equal in
conversation, turn, role and text are counted before they are shuffled and handled as
one row with a number.

Nulls: a null role or text is one space; a null turn sorts first; a null conversation id
is a conversation of its own.  A text without a character beyond ``[\\x20\\x09-\\x0D]`` is
blank.  Ties of a turn are ordered by role, then text.  An empty table gives empty results.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, sha256_hex

BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = " DIKR"  # digit -> letter; 0 is the padding
D, I, K, R = 1, 2, 3, 4
BITS = 3
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only turn that can be put in at each state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"


# ---------------------------------------------------------------------------
# Weights and the DP over one block
# ---------------------------------------------------------------------------
def before(weight: int, cost: int, letter: int, width: int, times: int = 1) -> int:
    """The weight with ``times`` edits of one letter, of ``cost`` in all, put in front."""
    space = BITS * width
    audit = weight & ((1 << space) - 1)
    ones = ((1 << BITS * times) - 1) // ((1 << BITS) - 1)
    return (((weight >> space) + cost) << space) | (letter * ones << (space - BITS * times)) | (audit >> BITS * times)


def length(weight: int, width: int) -> int:
    """Letters of a weight's audit."""
    audit = weight & ((1 << BITS * width) - 1)
    if not audit:
        return 0
    low = (audit & -audit).bit_length() - 1
    return width - low // BITS


def audit_text(weight: int, width: int) -> str:
    digits = weight & ((1 << BITS * width) - 1)
    return "".join(LETTERS[int(x)] for x in f"{digits:0{width}o}".rstrip("0")) if digits else ""


def concatenate(one: int, width: int, two: int, rest: int) -> int:
    """The weight of width ``width + rest`` for the edits of ``one`` and then those of ``two``."""
    space = BITS * (width + rest)
    audit = (one & ((1 << BITS * width) - 1)) << BITS * rest
    tail = (two & ((1 << BITS * rest) - 1)) << BITS * width
    return (((one >> BITS * width) + (two >> BITS * rest)) << space) | audit | (tail >> BITS * length(one, width))


Vector = list  # per state the least weight, or None where there is none


def least(*weights: int | None) -> int | None:
    some = [w for w in weights if w is not None]
    return min(some) if some else None


def with_inserts(v: Vector, width: int) -> Vector:
    """Least weights when turns may be put in first; no cheapest path comes to a state twice."""
    v = list(v)
    for _ in range(3):
        v = [least(v[p], None if v[NEXT[p]] is None else before(v[NEXT[p]], INSERT, I, width)) for p in range(4)]
    return v


class Row(NamedTuple):
    role: str
    fault: str  # "", "blank", "duplicate" or "truncated": that of the first of equal rows
    times: int


def row_step(row: Row, v: Vector, width: int) -> Vector:
    """Least weights from each state over one row (and its repetitions, which go) and on along ``v``."""
    gone = row.times if row.fault in ("blank", "duplicate") else row.times - 1
    if gone:
        v = [None if w is None else before(w, DELETE * gone, D, width, gone) for w in v]
    if gone == row.times:
        return v
    extra = TRUNCATED if row.fault == "truncated" else 0
    out: Vector = []
    for p in range(4):
        kept = STEP.get((p, row.role[:1]))
        out.append(least(
            None if v[p] is None else before(v[p], DELETE, D, width),
            None if kept is None or v[kept] is None else before(v[kept], KEEP + extra, K, width),
            None if v[NEXT[p]] is None else before(v[NEXT[p]], REROLE + extra, R, width)))
    return out


def block_width(rows: list[Row]) -> int:
    """Letters that the edits of a block can have: its rows, and three inserts around each."""
    return sum(r.times for r in rows) + 3 * (len(rows) + 1)


def solve(rows: list[Row], end: int, width: int) -> Vector:
    """Least weights from each state over the rows of a block to state ``end``."""
    v: Vector = [None] * 4
    v[end] = 0
    v = with_inserts(v, width)
    for row in reversed(rows):
        v = with_inserts(row_step(row, v, width), width)
    return v


def replay(letters: str, rows: list[tuple[Row, str]], state: int) -> list[tuple[str, str]]:
    """The turns that a block's edits leave, from its state at the start on."""
    out, at = [], 0

    def put(state: int, role: str, text: str) -> int:
        new = NEXT[state] if not role else STEP[state, role[:1]]
        out.append((role or ROLE[new], text))
        return new

    for row, text in rows:
        for k in range(row.times):
            while letters[at] == "I":
                state = put(state, "", "")
                at += 1
            if letters[at] == "K":
                state = put(state, row.role, text)
            elif letters[at] == "R":
                state = put(state, "", text)
            at += 1
    for _ in letters[at:]:
        state = put(state, "", "")
    return out


# ---------------------------------------------------------------------------
# Blocks on Spark
# ---------------------------------------------------------------------------
_LONG = pa.int64()
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _counted(rows: DataFrame, present: Column) -> DataFrame:
    """One row per different (conv, turn, role, text): ``times`` it is there, and whether an earlier turn says the same.

    Rows that are not there keep their conversation known, without role and text.
    """
    def told(name: str) -> Column:
        return F.when(present, F.coalesce(F.col(name).cast("string"), F.lit(" "))).otherwise(F.lit(""))

    named = rows.select(F.col("conv_id").alias("conv"), F.when(present, F.col("turn").cast("long")).alias("turn"),
                        told("role").alias("role"), told("text").alias("text"), present.cast("int").alias("here"))
    counted = named.groupBy("conv", "here", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    same = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    # rows equal in turn, too, are one row by now; the frame is a running one: nothing is held
    order = Window.partitionBy("conv", "here", same).orderBy(F.col("turn").asc_nulls_first())
    return counted.select("conv", "turn", "role", "text", (F.col("times") * F.col("here")).alias("times"),
                          (F.row_number().over(order) > 1).alias("again"))


def _typed(rows: list[dict]) -> list[tuple[Row, str]]:
    """The rows that are there, by first fault, with their texts."""
    out = []
    for r in rows:
        if r["times"]:
            shown = r["text"].rstrip(WHITE)
            fault = ("blank" if not shown else "duplicate" if r["again"] else "truncated" if shown[-1] not in ".!?" else "")
            out.append((Row(r["role"], fault, r["times"]), r["text"]))
    return out


def summary(rows: list[dict], opens: bool, closes: bool) -> dict:
    """Counts of a block and its weights, [4 * start + end] in hexadecimal; those of a whole conversation
    only as its cost and audit.  ``opens``, ``closes``: the conversation surely starts, ends here."""
    typed = [r for r, _ in _typed(rows)]
    width = block_width(typed)
    turns = [r["turn"] for r in rows if r["times"] and r["turn"] is not None]
    initials = [r.role[:1] for r in typed]
    pairs = sum((x, y) not in LEGAL for x, y in zip(initials, initials[1:], strict=False))
    out = {"width": width, "filled": bool(typed), "first": initials[0] if typed else "", "last": initials[-1] if typed else "",
           "blank": sum(r.times for r in typed if r.fault == "blank"),
           "duplicate": sum(r.times if r.fault == "duplicate" else r.times - 1 for r in typed if r.fault != "blank"),
           "truncated": sum(r.fault == "truncated" for r in typed), "illegal": pairs + sum(r.times - 1 for r in typed),
           "least": min(turns, default=None), "greatest": max(turns, default=None), "turns": len(set(turns))}
    if opens and closes:
        best = least(*(solve(typed, end, width)[START] for end in ACCEPTING))
        return out | {"weights": [], "cost": best >> BITS * width, "audit": audit_text(best, width)}
    weights = [""] * 16
    for end in ACCEPTING if closes else range(4):
        for start, w in enumerate(solve(typed, end, width)):
            if w is not None and (start == START or not opens):
                weights[4 * start + end] = f"{w:x}"
    return out | {"weights": weights, "cost": None, "audit": None}


_BLOCK = ("seg long, whole boolean, rows array<struct<turn:long,role:string,text:string,times:long,again:boolean>>, "
          "width long, filled boolean, first string, last string, blank long, duplicate long, truncated long, illegal long, "
          "least long, greatest long, turns long, weights array<string>, cost long, audit string")
_ROW = pa.struct([("turn", _LONG), ("role", pa.string()), ("text", pa.string()), ("times", _LONG), ("again", pa.bool_())])
_BLOCK_ARROW = [("seg", _LONG), ("whole", pa.bool_()), ("rows", pa.list_(_ROW)), ("width", _LONG), ("filled", pa.bool_()),
                ("first", pa.string()), ("last", pa.string()), *((c, _LONG) for c in _COUNTS), ("least", _LONG),
                ("greatest", _LONG), ("turns", _LONG), ("weights", pa.list_(pa.string())), ("cost", _LONG), ("audit", pa.string())]


def _blocks(rows: DataFrame) -> DataFrame:
    """The sorted rows in blocks, with their summaries.  ``seg`` grows along the sorted table.

    Only at the ends of a partition it is unsure whether a conversation starts or ends with its block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, schema = TaskContext.get().partitionId() << 32, None
        opens, conv, held, size = False, None, [], 0
        done: list[dict] = []
        waiting = 0

        def block(closes: bool) -> dict:
            return {"conv": conv, "seg": number, "whole": opens and closes, "rows": held, **summary(held, opens, closes)}

        for batch in batches:
            schema = schema or pa.schema([("conv", batch.schema.field(0).type), *_BLOCK_ARROW])
            for row in batch.to_pylist():
                new = row.pop("conv")
                if held and (new != conv or len(held) >= BLOCK_ROWS or size >= BLOCK_BYTES):
                    done.append(block(new != conv))
                    waiting += size + 500
                    opens, number, held, size = new != conv, number + 1, [], 0
                    if waiting > BLOCK_BYTES:
                        yield from pa.Table.from_pylist(done, schema=schema).to_batches()
                        done, waiting = [], 0
                conv = new
                held.append(row)
                size += len(row["text"])
        if held:
            done.append(block(False))
            yield from pa.Table.from_pylist(done, schema=schema).to_batches()

    by = ["conv", F.col("turn").isNotNull(), "turn", "role", "text"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([rows.schema["conv"], *T._parse_datatype_string(_BLOCK).fields])
    return (rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
            .select("conv", "turn", "role", "text", "times", "again").mapInArrow(run, schema))


def join_blocks(blocks: list[dict]) -> tuple[int, str, list[tuple[int, int, str]]]:
    """Cost, audit and (block, state at its start, its letters) of a conversation's blocks in order."""
    v: Vector = [0 if p in ACCEPTING else None for p in range(4)]
    rest, choices = 0, []
    for b in reversed(blocks):
        new, choice = [], []
        for p in range(4):
            best = None
            for q in range(4):
                w = b["weights"][4 * p + q]
                if w and v[q] is not None:
                    here = (concatenate(int(w, 16), b["width"], v[q], rest), q)
                    best = here if best is None else min(best, here)
            new.append(None if best is None else best[0])
            choice.append(None if best is None else best[1])
        v, rest = new, rest + b["width"]
        choices.append(choice)
    pieces, p = [], START
    for b, choice in zip(blocks, reversed(choices), strict=True):
        q = choice[p]
        pieces.append((b["seg"], p, audit_text(int(b["weights"][4 * p + q], 16), b["width"])))
        p = q
    return v[START] >> BITS * rest, "".join(x for _, _, x in pieces), pieces


def join_counts(blocks: list[dict]) -> dict:
    """Counts of a conversation from those of its blocks in order."""
    out = {c: sum(b[c] for b in blocks) for c in _COUNTS}
    filled = [b for b in blocks if b["filled"]]
    out["illegal"] += sum((x["last"], y["first"]) not in LEGAL for x, y in zip(filled, filled[1:], strict=False))
    timed = [b for b in blocks if b["turns"]]
    out["turns"] = sum(b["turns"] for b in timed) - sum(
        x["greatest"] == y["least"] for x, y in zip(timed, timed[1:], strict=False))
    return out | {"least": min((b["least"] for b in timed), default=None),
                  "greatest": max((b["greatest"] for b in timed), default=None)}


def _join(blocks: DataFrame) -> DataFrame:
    """One row per conversation that lies in several blocks (or may): counts, cost, audit and the pieces of its blocks."""
    listed = blocks.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(
        "seg", "width", "filled", "first", "last", *_COUNTS, "least", "greatest", "turns", "weights"))).alias("blocks"))
    piece = pa.struct([("seg", _LONG), ("state", pa.int32()), ("letters", pa.string())])
    fields = pa.schema([*((c, _LONG) for c in (*_COUNTS, "least", "greatest", "turns", "cost")), ("audit", pa.string()),
                        ("pieces", pa.list_(piece))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for found in batch.column(1).to_pylist():
                cost, audit, pieces = join_blocks(found)
                told.append(join_counts(found) | {"cost": cost, "audit": audit, "pieces": [
                    {"seg": s, "state": p, "letters": x} for s, p, x in pieces]})
            for table in pa.Table.from_pylist(told, schema=fields).to_batches():
                yield pa.RecordBatch.from_arrays([batch.column(0), *table.columns], names=["conv", *table.schema.names])

    schema = T.StructType([blocks.schema["conv"], *T._parse_datatype_string(
        "blank long, duplicate long, truncated long, illegal long, least long, greatest long, turns long, cost long, "
        "audit string, pieces array<struct<seg:long,state:int,letters:string>>").fields])
    return listed.mapInArrow(run, schema)


class Repair(NamedTuple):
    """``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row per conversation.

    ``turns``: the repaired turns (conv_id, seg, whole, turns: array of role and text), a row per block; the blocks of
    a conversation in the order of ``seg``.  ``whole``: the block is all of its conversation.
    """

    report: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, present: Column | None = None) -> Repair:
    """Repair the conversations of ``rows`` (conv_id, turn, role, text); see the module's text for the rules.

    Rows for which ``present`` is not true only name their conversation, which then has a result without them.
    ``gaps``: greatest turn - least turn + 1 - different turns, nulls aside; 0 without a turn.
    ``blank``, ``duplicate``, ``truncated``: rows by their first fault.  ``illegal``: adjacent rows whose
    role initials are not su, ua or au.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    blocks = cut(_blocks(_counted(rows, here)), "turns-blocks")
    joined = cut(_join(blocks.where("not whole")), "turns-joined")
    columns = ("conv", *_COUNTS, "least", "greatest", "turns", "cost", "audit")
    gaps = F.coalesce(F.col("greatest") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    report = blocks.where("whole").select(*columns).unionByName(joined.select(*columns)).select(
        F.col("conv").alias("conv_id"), gaps.alias("gaps"), *_COUNTS, "cost", "audit")
    solved = blocks.where("whole").select("conv", "seg", "whole", "rows", F.lit(START).alias("state"), F.col("audit").alias("letters"))
    pieces = joined.select(F.inline("pieces"))
    parts = blocks.where("not whole").select("conv", "seg", "whole", "rows").join(pieces, "seg").select(solved.columns)
    turn_type = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            told = [[{"role": r, "text": t} for r, t in replay(letters or "", _typed(found), state)]
                    for found, state, letters in zip(*(at[c].to_pylist() for c in ("rows", "state", "letters")), strict=True)]
            yield pa.RecordBatch.from_arrays([at["conv"], at["seg"], at["whole"], pa.array(told, pa.list_(turn_type))],
                                             names=["conv_id", "seg", "whole", "turns"])

    schema = T.StructType([T.StructField("conv_id", blocks.schema["conv"].dataType), *T._parse_datatype_string(
        "seg long, whole boolean, turns array<struct<role:string,text:string>>").fields])
    return Repair(report, solved.unionByName(parts).mapInArrow(run, schema))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of ``role:text`` of a conversation's turns, newline-joined.

    A hash runs over a conversation from its first to its last byte: the blocks of one that has several
    stream through a task in order, and none is held.
    """
    kind = turns.schema["conv_id"].dataType
    lines = F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, state, conv, empty = None, None, None, True
        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field(0).type), ("repaired_sha256", pa.string())])
            for new, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if state is not None and new != conv:
                    yield from pa.Table.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema).to_batches()
                    state = None
                if state is None:
                    conv, state, empty = new, hashlib.sha256(), True
                for line in found.as_py():
                    state.update((b"" if empty else b"\n") + line.encode())
                    empty = False
        if state is not None:
            yield from pa.Table.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema).to_batches()

    at_once = turns.where("whole").select("conv_id", sha256_hex(F.array_join(lines, "\n")).alias("repaired_sha256"))
    streamed = (turns.where("not whole").select("conv_id", "seg", lines.alias("lines")).repartition("conv_id")
                .sortWithinPartitions("conv_id", "seg").select("conv_id", "lines"))
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())])
    return at_once.unionByName(streamed.mapInArrow(run, schema))
