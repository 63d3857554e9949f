"""Repair of the structure of conversations by cheapest edits, with a Viterbi search whose chunks run in parallel.

A conversation is a row of turns. Edits make the initials of its roles fit `(s?(ua)+)?`; the search is over the four
states of that pattern, with a vector of four costs after each row: what the rest costs at least.

1. Rows are dealt by ranges of (conversation, turn), so that one conversation may lie in many tasks. A task cuts its rows
   into chunks. A conversation that is one chunk is solved where it is read.
2. Of the others, chunks start from speculative cost vectors of what follows them. A fix-up pass hands each chunk the vector
   that the next one came to, and reruns those for which it differs from the one they used by more than a constant; passes
   end when there are none. As ranks converge, that is mostly after one or two.
3. Stitched together, the backward costs tell which edits are cheapest from any state on; the first in the alphabet is taken,
   row by row. Chunks begin this in a speculative state, and are fixed up in the same way.

Only codes of rows (a byte each) and vectors go through the passes; texts wait in a table. No chunk holds more than CHUNK_ROWS
rows, or CHUNK_BYTES of text and a row, whatever a conversation holds.
"""

import functools
import hashlib
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from chatterscope.llm.common import keep

CHUNK_ROWS, CHUNK_BYTES = 256, 4 << 20
BLANKS = " \t\n\v\f\r"
SENTENCE_ENDS = ".!?"
ROLES = {"s": "system", "u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GOOD_PAIRS = ("su", "ua", "au")
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
FAR = 1 << 50
MOST = 2**63 - 1  # gaps beyond a long are cut to it


class Costs(NamedTuple):
    """What edits cost; `truncated` is added for a truncated row that stays."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def needed(state):
    """The only initial that an inserted or changed row can have in a state."""
    return "a" if state == USER else "u"


def code_of(role, fault):
    """A row as the search sees it: its initial and its fault, in one byte."""
    initial = INITIALS.find(role[:1]) if role else -1
    return (initial if initial >= 0 else 3) * 4 + fault


def choices(code, state, costs):
    """(edit, next state, cost) of a row in a state."""
    initial, fault = INITIALS[code // 4 : code // 4 + 1], code % 4
    found = [("D", state, costs.delete)]
    if fault in (FINE, TRUNCATED):
        more = costs.truncated if fault == TRUNCATED else 0
        if (state, initial) in STEPS:
            found.append(("K", STEPS[state, initial], costs.keep + more))
        found.append(("R", STEPS[state, needed(state)], costs.rerole + more))
    return found


def _with_inserts(costs_of, costs):
    for _ in range(len(costs_of)):
        costs_of = [min(c, costs.insert + costs_of[STEPS[x, needed(x)]]) for x, c in enumerate(costs_of)]
    return costs_of


@functools.cache
def last_vector(costs):
    """What is still to pay in each state after all rows: an empty result and one that ends with `a` are complete."""
    return tuple(_with_inserts([0, FAR, FAR, 0], costs))


@functools.cache
def before(code, after, costs):
    """Costs before a row from those after it, less their least; and that least."""
    found = [min(c + after[y] for _, y, c in choices(code, x, costs)) for x in range(4)]
    found = _with_inserts(found, costs)
    least = min(found)
    return tuple(c - least for c in found), least


@functools.cache
def edits_of(code, after, state, costs):
    """The first edits in the alphabet among the cheapest, up to one that takes the row; and the state after it."""
    ahead, least = before(code, after, costs)
    edits = ""
    while True:
        options = [(e, y) for e, y, c in choices(code, state, costs) if c + after[y] == ahead[state] + least]
        y = STEPS[state, needed(state)]
        if costs.insert + ahead[y] == ahead[state]:
            options.append(("I", y))
        edit, state = min(options)
        edits += edit
        if edit != "I":
            return edits, state


def _vectors(codes, after, costs):
    """The cost vectors after each row of a chunk, last first, then the one before its first row; constants left out."""
    found = [after]
    for code in reversed(codes):
        found.append(before(code, found[-1], costs)[0])
    return found


def _first_vector(codes, after, costs):
    for code in reversed(codes):
        after = before(code, after, costs)[0]
    return after


def _audit(codes, after, state, costs, is_last):
    """Edits of a chunk, and the state after it."""
    found, vectors = [], _vectors(codes, after, costs)
    for i, code in enumerate(codes):
        edits, state = edits_of(code, vectors[len(codes) - 1 - i], state, costs)
        found.append(edits)
    if is_last:
        while last_vector(costs)[state]:
            found.append("I")
            state = STEPS[state, needed(state)]
    return "".join(found), state


def _repaired(rows, codes, edits, state, costs):
    """(cost, rows) after the edits; rows are (role, text) pairs."""
    cost, out, at = 0, [], 0
    for edit in edits:
        if edit == "I":
            cost += costs.insert
            out.append((ROLES[needed(state)], ""))
            state = STEPS[state, needed(state)]
            continue
        code, (role, text) = codes[at], rows[at]
        at += 1
        if edit == "D":
            cost += costs.delete
            continue
        cost += costs.truncated if code % 4 == TRUNCATED else 0
        if edit == "K":
            cost, state = cost + costs.keep, STEPS[state, INITIALS[code // 4]]
        else:
            cost, role, state = cost + costs.rerole, ROLES[needed(state)], STEPS[state, needed(state)]
        out.append((role, text))
    return cost, out


# A chunk as read: part and seq are its place; whole: it is its conversation; marks: 16 bytes for each row that may repeat one
# of an earlier chunk, zeros for others; lines: its rows, with a null text where the row must go.
LINES = "array<struct<role:string,text:string>>"
CHUNK = (
    "conv_id long, part int, seq int, whole boolean, codes binary, marks binary, lines {lines}, blank long, duplicate long, "
    "truncated long, illegal long, turns long, least_turn long, last_turn long, first_initial string, last_initial string, "
    "cost long, audit string"
).format(lines=LINES)
LINE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), LINES: LINE}
CHUNK_SCHEMA = pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in CHUNK.split(", ")])
NO_MARK = bytes(16)


def first_fault(role, text, mark, seen):
    body = text.rstrip(BLANKS)
    if not body:
        return BLANK
    if mark in seen:
        return DUPLICATE
    return FINE if body[-1] in SENTENCE_ENDS else TRUNCATED


class _Chunk:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv_id, seq):
        self.conv_id, self.seq = conv_id, seq
        self.codes, self.marks, self.lines, self.size = bytearray(), [], [], 0
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.turns, self.least_turn, self.last_turn = 0, None, None
        self.first_initial = self.last_initial = None

    def add(self, turn, role, text, mark, fault):
        self.codes.append(code_of(role, fault))
        self.faults[fault] += 1
        gone = fault in (BLANK, DUPLICATE)
        self.marks.append(NO_MARK if gone else mark)
        self.lines.append((role, None if gone else text))
        self.size += 0 if gone else len(text)
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in GOOD_PAIRS
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.last_turn = turn

    def is_full(self, rows):
        return len(self.codes) >= rows or self.size >= CHUNK_BYTES

    def row(self, part, costs, whole):
        codes, cost, audit, lines = bytes(self.codes), None, None, self.lines
        marks = b"".join(self.marks)
        if whole:
            audit, _ = _audit(codes, last_vector(costs), START, costs, True)
            cost, lines = _repaired(lines, codes, audit, START, costs)
            codes = marks = None
        return (
            self.conv_id, part, self.seq, whole, codes, marks, [{"role": r, "text": t} for r, t in lines],
            self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.turns,
            self.least_turn, self.last_turn, self.first_initial, self.last_initial, cost, audit,
        )


def _chunks(rows, costs, chunk_rows):
    """CHUNK rows of sorted rows (conv_id, turn, role, text, times); times 0: the row is gone, its conversation stays."""

    def run(batches):
        part, chunk, seen, held = TaskContext.get().partitionId(), None, set(), []
        at_edge, size = True, 0  # a task's first and last conversation may go on elsewhere

        def out(whole):
            held.append(chunk.row(part, costs, whole))

        def flushed():
            columns = list(zip(*held)) or [()] * len(CHUNK_SCHEMA)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CHUNK_SCHEMA)], schema=CHUNK_SCHEMA)

        for batch in batches:
            for conv_id, turn, role, text, times in zip(*(batch.column(c).to_pylist() for c in ROW_NAMES)):
                if chunk is None:
                    chunk = _Chunk(conv_id, 0)
                elif conv_id != chunk.conv_id:
                    out(not at_edge and chunk.seq == 0)
                    chunk, seen, at_edge = _Chunk(conv_id, 0), set(), False
                if times:
                    mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                for _ in range(times):
                    if chunk.is_full(chunk_rows):
                        out(False)
                        chunk = _Chunk(conv_id, chunk.seq + 1)
                    fault = first_fault(role, text, mark, seen)
                    seen.add(mark)
                    chunk.add(turn, role, text, mark, fault)
                    size += 200 + (len(text) if fault in (FINE, TRUNCATED) else 0)
                    if size >= CHUNK_BYTES:
                        yield flushed()
                        size = 0
        if chunk is not None:
            out(False)
            yield flushed()

    return rows.mapInArrow(run, CHUNK)


ROW_NAMES = ("conv_id", "turn", "role", "text", "times")
ROWS = "conv_id long, turn long, role string, text string, times long"


def _collapsed(rows):
    """Equal rows of a batch as one with the sum of their times, so that a row on very many rows is no hot spot."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(list(ROW_NAMES[:4])).aggregate([("times", "sum")])
            yield from table.rename_columns(list(ROW_NAMES)).combine_chunks().to_batches()

    return rows.mapInArrow(run, ROWS)


def _sorted(rows):
    """Rows dealt by ranges of conversation and turn, and in order; equal rows next to each other."""
    ahead = ["conv_id", "turn", F.left("role", F.lit(16))]
    return rows.repartitionByRange(*ahead).sortWithinPartitions(*ahead, "role", "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """ROWS with faults by the checksum of `conv_id:turn` (nulls: a space) modulo 20: dropped, emptied, without sentence
    ends, doubled, or with the role user. Null roles and texts are one space."""

    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def plain_rows(conversations: DataFrame) -> DataFrame:
    """ROWS as they are; null roles and texts are one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("times"),
    )


def _same(left, right, *names):
    """Equality of two aliased frames in some columns, nulls being equal."""
    tests = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return functools.reduce(lambda a, b: a & b, tests)


def _numbered(chunks):
    """The non-empty chunks of conversations of several chunks, with their index and the number of chunks.

    Places are summed over the tasks that hold a part of a conversation, not over its rows.
    """
    parts = chunks.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.withColumns(
        {"base": F.sum("n").over(order) - F.col("n"), "total": F.sum("n").over(Window.partitionBy("conv_id"))}
    )
    joined = chunks.alias("c").join(parts.alias("p"), _same("c", "p", "conv_id", "part"))
    return joined.select("c.*", (F.col("p.base") + F.col("c.seq")).cast("long").alias("index"), F.col("p.total").alias("total"))


def _with_neighbour(chunks, others, by):
    """chunks with `there`, the columns of the chunk `by` places on."""
    moved = others.withColumn("index", F.col("index") - by)
    there = F.struct(*[F.col(f"o.{c}") for c in others.columns if c not in ("conv_id", "index")])
    joined = chunks.alias("c").join(moved.alias("o"), _same("c", "o", "conv_id", "index"), "left")
    return joined.select("c.*", F.when(F.col("o.index").isNotNull(), there).alias("there"))


def _repeats_elsewhere(chunks):
    """conv_id, index, gone (places): rows of a chunk that equal a row of an earlier chunk."""
    marks = chunks.select(
        "conv_id", "index",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.length("codes") - 1), lambda i: F.substring("marks", i * 16 + 1, F.lit(16)))).alias("place", "mark"),
    ).where(F.col("mark") != F.lit(NO_MARK))
    first = marks.groupBy("conv_id", "mark").agg(F.min("index").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = marks.alias("m").join(first.alias("f"), _same("m", "f", "conv_id", "mark")).where("m.index > f.first")
    return later.groupBy("m.conv_id", "m.index").agg(F.collect_list("place").alias("gone"))


def _marked(code, places):
    """Codes with the rows at some places marked as duplicates."""
    out = bytearray(code)
    for p in [] if places is None else places:
        out[p] = out[p] // 4 * 4 + DUPLICATE
    return bytes(out)


def _converged(chunks, step, guess, end, by, name):
    """conv_id, index, given: what each chunk is given by its neighbour `by` places on (`end` where there is none).

    Chunks begin with a guess, and run again while they were given something else than their neighbour came to.
    """
    edge = F.col("index") == (F.col("total") - 1 if by > 0 else F.lit(0))
    started = chunks.withColumn("given", F.when(edge, F.lit(end)).otherwise(F.lit(guess)))
    state = keep(started.withColumn("result", step).select(*chunks.columns, "given", "result"), name)
    while True:
        paired = _with_neighbour(state, state.select("conv_id", "index", "result"), by)
        paired = paired.withColumn("wanted", F.coalesce("there.result", "given"))
        changed = paired.where("wanted <> given").select(*chunks.columns, F.col("wanted").alias("given"))
        if changed.isEmpty():
            return state.select("conv_id", "index", "given")
        fixed = changed.withColumn("result", step).select(*state.columns)
        state = keep(paired.where("wanted = given").select(*state.columns).unionByName(fixed), name)


def _written(vector):
    return ",".join(map(str, vector))


def _read(text):
    return tuple(map(int, text.split(",")))


def _solved(chunks, costs):
    """Conversations of several chunks: their chunks with cost, audit and repaired lines."""

    @F.pandas_udf("binary")
    def marked(codes: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([_marked(c, g) for c, g in zip(codes, gone)], dtype=object)

    @F.pandas_udf("string")
    def vector(codes: pd.Series, given: pd.Series) -> pd.Series:
        return pd.Series([_written(_first_vector(c, _read(v), costs)) for c, v in zip(codes, given)], dtype=object)

    @F.pandas_udf("string")
    def state(codes: pd.Series, after: pd.Series, given: pd.Series) -> pd.Series:
        found = (_audit(c, _read(v), int(x), costs, False)[1] for c, v, x in zip(codes, after, given))
        return pd.Series([str(x) for x in found], dtype=object)

    def finished(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                codes, x = r["codes"], int(r["state"])
                audit, _ = _audit(codes, _read(r["after"]), x, costs, r["index"] == r["total"] - 1)
                cost, lines = _repaired([(k["role"], k["text"]) for k in r["lines"]], codes, audit, x, costs)
                faults = [sum(c % 4 == f for c in codes) for f in (BLANK, DUPLICATE, TRUNCATED)]
                out.append((cost, audit, [{"role": a, "text": b} for a, b in lines], *faults))
            kinds = [pa.int64(), pa.string(), LINE, pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in passed), *(pa.array(c, k) for c, k in zip(columns, kinds))], [*passed, *made])

    passed = ["conv_id", "index", "illegal", "turns", "least_turn", "last_turn"]
    made = ["cost", "audit", "lines", "blank", "duplicate", "truncated"]
    chunks = keep(_numbered(chunks), "numbered")
    joined = chunks.alias("c").join(_repeats_elsewhere(chunks).alias("g"), _same("c", "g", "conv_id", "index"), "left")
    codes = keep(joined.select("c.conv_id", "c.index", "c.total", marked("c.codes", "g.gone").alias("codes")), "codes")
    end = _written(last_vector(costs))
    after = _converged(codes, vector("codes", "given"), end, end, 1, "vectors")
    known = codes.alias("c").join(after.alias("v"), _same("c", "v", "conv_id", "index")).select("c.*", F.col("v.given").alias("after"))
    known = keep(known, "known")
    states = _converged(known, state("codes", "after", "given"), str(ASSISTANT), str(START), -1, "states")
    known = known.alias("c").join(states.alias("v"), _same("c", "v", "conv_id", "index")).select("c.*", F.col("v.given").alias("state"))
    # Between chunks: a pair of initials, and a turn that is in both.
    edges = _with_neighbour(
        chunks.select("conv_id", "index", "illegal", "turns", "least_turn", "last_turn", "first_initial", "lines"),
        chunks.select("conv_id", "index", "last_initial", "last_turn"), -1,
    )
    bad = ~F.concat("there.last_initial", "first_initial").isin(*GOOD_PAIRS)
    edges = edges.withColumns({
        "illegal": F.col("illegal") + F.coalesce(bad.cast("long"), F.lit(0)),
        "turns": F.col("turns") - F.coalesce((F.col("there.last_turn") == F.col("least_turn")).cast("long"), F.lit(0)),
    })
    rows = edges.alias("e").join(known.alias("k"), _same("e", "k", "conv_id", "index")).select(
        "e.*", "k.codes", "k.after", "k.state", "k.total"
    ).drop("there", "first_initial")
    schema = "conv_id long, index long, illegal long, turns long, least_turn long, last_turn long, cost long, audit string, "
    return rows.mapInArrow(finished, schema + f"lines {LINES}, blank long, duplicate long, truncated long")


SUMS = ("blank", "duplicate", "truncated", "illegal", "turns", "cost")
REPAIRED = ["conv_id", "index", "whole", *SUMS, "least_turn", "last_turn", "audit", "lines"]


def repaired(rows: DataFrame, costs: Costs = Costs(), chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Chunks of repaired conversations: conv_id, index, whole (the only chunk), blank, duplicate, truncated, illegal, turns,
    cost (sums over chunks are those of the conversation), least_turn, last_turn, audit, lines (role, text after the edits).

    rows has conv_id, turn, role, text, times (equal rows that follow each other; 0: none, but the conversation stays); see
    `damaged` and `plain_rows`. Rows are ordered by turn (nulls first), then role, then text. A row's fault is the first of
    blank, duplicate (role and text were there before, by 128-bit marks) and truncated. Blank and duplicate rows must be deleted,
    other rows can be kept, get the role user or assistant, or be deleted; such rows can be inserted with an empty text. An initial is that of
    a role as it is; a role with another one, or none, cannot be kept. Of the cheapest edits the first in the alphabet count.
    A null conv_id is a conversation. An empty table gives no rows; a conversation without rows gives one empty chunk.
    """
    chunks = keep(_chunks(_sorted(_collapsed(rows)), costs, chunk_rows), "chunks")
    whole = chunks.where("whole").withColumn("index", F.lit(0).cast("long")).select(REPAIRED)
    several = chunks.where("NOT whole")
    solved = _solved(several.where(F.length("codes") > 0), costs).withColumn("whole", F.lit(False)).select(REPAIRED)
    empty = several.where(F.length("codes") == 0).withColumns({
        "index": F.lit(-1).cast("long"), "cost": F.lit(0).cast("long"), "audit": F.lit(""),
    }).select(REPAIRED)
    return whole.unionByName(solved).unionByName(empty)


def text_of(lines):
    """Lines as `role:text`, joined by line breaks."""
    return F.array_join(F.transform(lines, lambda x: F.concat(x.role, F.lit(":"), x.text)), "\n")


def gaps(least, last, turns):
    """Turns that are missing between the least and the last one."""
    missing = F.try_subtract(F.try_add(F.try_subtract(last, least), F.lit(1)), turns)
    return F.when(least.isNull(), F.lit(0)).otherwise(F.coalesce(missing, F.lit(MOST))).cast("long")


DIGESTS = "conv_id long, audit string, repaired_sha256 string"


def _digests(chunks):
    """Audit and digest of conversations of several chunks, whose chunks come in order; a digest is a fold, so each conversation
    passes through one task, but chunk by chunk."""

    def run(batches):
        at, audit, digest, lines = None, [], None, False

        def row():
            columns = [at[0]], ["".join(audit)], [digest.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))], [c.split()[0] for c in DIGESTS.split(", ")])

        for batch in batches:
            for conv_id, part, text, filled in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "body", "filled"))):
                if at != (conv_id,):
                    if at is not None:
                        yield row()
                    at, audit, digest, lines = (conv_id,), [], hashlib.sha256(), False
                audit.append(part)
                if filled:
                    digest.update((b"\n" if lines else b"") + text.encode())
                    lines = True
        if at is not None:
            yield row()

    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "index")
    return ordered.select("conv_id", "audit", text_of("lines").alias("body"), (F.size("lines") > 0).alias("filled")).mapInArrow(run, DIGESTS)


def summaries(chunks: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of `repaired`."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = chunks.where("whole").withColumns({
        "gaps": gaps(F.col("least_turn"), F.col("last_turn"), F.col("turns")),
        "repaired_sha256": F.sha2(text_of("lines").cast("binary"), 256),
    }).select(names)
    several = chunks.where("NOT whole")
    sums = several.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.min("least_turn").alias("least_turn"), F.max("last_turn").alias("last_turn")
    ).withColumn("gaps", gaps(F.col("least_turn"), F.col("last_turn"), F.col("turns")))
    joined = sums.alias("s").join(_digests(several).alias("d"), _same("s", "d", "conv_id"))
    return whole.unionByName(joined.select("s.*", "d.audit", "d.repaired_sha256").select(names))
