"""Conversation structure repair by a Viterbi search that runs in parallel over chunks of a conversation.

The turns of a conversation must give the role initials ``(s?(ua)+)?``. Every turn is kept, given another role or
deleted, and empty turns may be inserted; the cheapest edits are wanted, and of equally cheap ones the ASCII-least string
of their initials (K, R, D, I).

A cost vector holds the least cost of the rest of a conversation for each state of the pattern. Chunks are computed
backwards at the same time, each from a speculative vector: that of the conversation's end. A chunk whose successor
then turns out to begin with a vector that differs by more than a constant is run again from that one, until it meets
its earlier vectors up to a constant; passes go on until no chunk is left. The edits follow from differences only, so
the constants never matter. Each chunk then notes in which state it leaves for each state it may be entered in, which
gives the state every chunk really begins in, and traces its edits from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listing_analytics.llm.common import discard, prepare, store, table
from listing_analytics.llm.registry import query

CHUNK = 1024  # turns of a chunk that aren't deleted anyway
BLANKS = " \t\n\v\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping costs nothing

# States of the pattern: nothing yet, after s, after u, after a. An inserted or reassigned turn has the one role that can follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "sua"  # the initials that can be kept; a turn's code is its place here (3: any other), plus 4 if truncated
FORCED = 8  # code of blank and duplicate turns
END = (0, INSERT * 2, INSERT, 0)
END_EDITS = ("", "II", "I", "")


def _choices(code: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, next state, cost) of a turn, in ASCII order but for the insertion before it."""
    out = [("D", state, DELETE)]
    if code == FORCED:
        return out
    letter, more = code & 3, TRUNCATED if code & 4 else 0
    if (letter == 0 and state == START) or (letter == 1 and NEXT[state] == USER) or (letter == 2 and NEXT[state] == ASSISTANT):
        out.append(("K", letter + 1, more))
    return [*out, ("R", NEXT[state], REROLE + more)]


def _costs(code: int, after: tuple[int, ...]) -> list[int]:
    """Least cost from each state before a turn, given the costs after it."""
    out = [min(cost + after[to] for _, to, cost in _choices(code, state)) for state in range(4)]
    for _ in range(2):
        out = [min(out[state], INSERT + out[NEXT[state]]) for state in range(4)]
    return out


@cache
def back(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The cost vector before a turn, less its least entry: vectors that differ by a constant are equal."""
    costs = _costs(code, after)
    return tuple(c - min(costs) for c in costs)


@cache
def edits_of(code: int, after: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """(initials, next state, cost) of the ASCII-least cheapest edits up to and with a turn."""
    costs, done, spent = _costs(code, after), "", 0
    while True:
        # D, I, K, R: the insertion comes after the deletion and before the others.
        options = _choices(code, state)
        options.insert(1, ("I", NEXT[state], INSERT))
        for edit, to, cost in options:
            rest = costs[to] if edit == "I" else after[to]
            if cost + rest == costs[state]:
                break
        done, spent, state = done + edit, spent + cost, to
        if edit != "I":
            return done, state, spent


def vectors(codes: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The vector after each turn of a chunk and, first, the one before it."""
    out = [end]
    for code in reversed(codes):
        out.append(back(code, out[-1]))
    return out[::-1]


def rerun(codes: bytes, old: tuple[int, ...], new: tuple[int, ...], first: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a chunk for the new vector after it; ``first`` as soon as old and new meet."""
    for code in reversed(codes):
        if old == new:
            return first
        old, new = back(code, old), back(code, new)
    return new


# --- turns in order, cut into chunks ------------------------------------------------------------------------------

_CONV = ["known", "conv"]  # a null conversation is known = false
_PLACE = [*_CONV, "late", "turn", "role", "digest"]  # late = false: a null turn, which comes first
_AT = [*_CONV, "part", "idx"]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by the CRC-32 of ``conv_id:turn``; nulls count as one space."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
                       F.col("turn").isNotNull().alias("late"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                       space("role").alias("role"), F.sha2(space("text"), 256).alias("digest"), space("text").alias("text"))


def _judged(placed: DataFrame) -> DataFrame:
    """One row per place with how many equal turns it has, whether they are blank or truncated and the first of their kind."""
    core = F.rtrim("text", F.lit(BLANKS))
    slim, _ = store(placed.withColumn("core", core).select(*_PLACE, (F.col("core") == "").alias("blank"),
                                                           (~F.right("core", F.lit(1)).isin(".", "!", "?")).alias("cut"))
                    .groupBy(*_PLACE, "blank", "cut").agg(F.count(F.lit(1)).alias("copies")), "turns")
    # The first turn of a role and text is a row of its own place, so the join meets every place once.
    said = slim.filter("not blank").groupBy(*_CONV, "role", "digest").agg(
        F.max(~F.col("late")).alias("early"), F.min(F.when(F.col("late"), F.col("turn"))).alias("least"))
    first = said.select(*_CONV, (~F.col("early")).alias("late"), F.when(F.col("early"), 0).otherwise(F.col("least")).cast("long").alias("turn"),
                        "role", "digest", F.lit(True).alias("fresh"))
    return slim.join(first, _PLACE, "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))


_CHUNK_SCHEMA = pa.schema([
    ("known", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("idx", pa.int32()), ("codes", pa.binary()),
    ("runs", pa.list_(pa.int64())), ("late", pa.list_(pa.bool_())), ("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())),
    ("digest", pa.list_(pa.string())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()),
    ("last_turn", pa.int64()), ("turns", pa.int64())])
_CHUNK_DDL = ("known boolean, conv long, part int, idx int, codes binary, runs array<long>, late array<boolean>, turn array<long>, "
              "role array<string>, digest array<string>, blank long, duplicate long, truncated long, illegal long, "
              "first_role string, last_role string, first_turn long, last_turn long, turns long")


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


class _Chunk:
    """A chunk in the making. ``codes`` and ``runs`` are its turns, a run of forced ones as one."""

    def __init__(self, known: bool, conv: int, part: int, idx: int):
        self.at = (known, conv, part, idx)
        self.codes, self.runs = bytearray(), []
        self.late, self.turn, self.role, self.digest = [], [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, late, turn, role, digest, blank, cut, copies, fresh) -> None:
        initial = role[:1]
        if self.first_role is None:
            self.first_role = initial
        else:
            self.illegal += not _legal(self.last_role, initial)
        self.illegal += copies - 1  # no initial may follow itself
        self.last_role = initial
        if late:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if fresh:
            self.codes.append((LETTERS.index(initial) if initial and initial in LETTERS else 3) + 4 * cut)
            self.runs.append(1)
            self.truncated += cut
            for values, value in zip((self.late, self.turn, self.role, self.digest), (late, turn, role, digest)):
                values.append(value)
        rest = copies - fresh
        if blank:
            self.blank += rest
        else:
            self.duplicate += rest
        if rest and self.codes and self.codes[-1] == FORCED:
            self.runs[-1] += rest
        elif rest:
            self.codes.append(FORCED)
            self.runs.append(rest)

    def row(self) -> list:
        return [*self.at, bytes(self.codes), self.runs, self.late, self.turn, self.role, self.digest, self.blank, self.duplicate,
                self.truncated, self.illegal, self.first_role, self.last_role, self.first_turn, self.last_turn, self.turns]


def _arrow(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _cut(chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for known, conv, *turn in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.at[:2] != (known, conv):
                    idx = 0
                elif len(now.late) >= chunk_rows:
                    idx = now.at[3] + 1
                else:
                    now.add(*turn)
                    continue
                if now is not None:
                    out.append(now.row())
                now = _Chunk(known, conv, part, idx)
                now.add(*turn)
            yield _arrow(out, _CHUNK_SCHEMA)
        if now is not None:
            yield _arrow([now.row()], _CHUNK_SCHEMA)
    return run


def chunks(placed: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """All conversations in order, as chunks numbered by (part, idx).

    Turns are sorted across the cluster, so a large conversation lies in many tasks; turns of equal number follow by
    role and text hash. A chunk holds ``chunk_rows`` turns besides the runs of turns that must go.
    """
    prepare(placed.sparkSession)
    ordered = _judged(placed).select(*_PLACE, "blank", "cut", "copies", "fresh")
    return ordered.repartitionByRange(*_PLACE).sortWithinPartitions(*_PLACE).mapInArrow(_cut(chunk_rows), _CHUNK_DDL)


# --- cost vectors ----------------------------------------------------------------------------------------------------

_VECTORS = "known boolean, conv long, part int, idx int, open boolean, after array<int>, before array<int>"


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column(4).to_pylist()
        first = [list(vectors(c, END)[0]) for c in codes]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array([any(x != FORCED for x in c) for c in codes], pa.bool_()),
             pa.array([list(END)] * len(codes), pa.list_(pa.int32())), pa.array(first, pa.list_(pa.int32()))],
            [*_AT, "open", "after", "before"])


def _fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, old, first, new = (batch.column(i).to_pylist() for i in range(4, 8))
        now = [list(rerun(c, tuple(a), tuple(b), tuple(f))) for c, a, f, b in zip(codes, old, first, new)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array([True] * len(codes), pa.bool_()), batch.column(7), pa.array(now, pa.list_(pa.int32()))],
            [*_AT, "open", "after", "before"])


def _wanted(state: DataFrame) -> DataFrame:
    """``state`` with the vector that each chunk should begin from, and whether it is the last of its conversation.

    Chunks of forced turns only hand on the vector of the next open one, so they never cause a pass of their own.
    """
    later = Window.partitionBy(*_CONV).orderBy(F.desc("part"), F.desc("idx"))
    following = F.last(F.when(F.col("open"), F.col("before")), ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1))
    end = F.array(*[F.lit(c) for c in END])
    return state.withColumn("wanted", F.coalesce(following, end)).withColumn("final", F.lag("part").over(later).isNull())


def converged(cut: DataFrame) -> tuple[DataFrame, int]:
    """For every chunk the vector after it (``wanted``) and whether it is ``final``; and how many fix-up passes it took.

    ``cut`` are stored chunks. Only a vector per chunk is shuffled, and only stale chunks are run again. Where turns let
    a difference through unchanged, as long runs of truncated ones can, it moves on by a chunk per pass.
    """
    state, passes = cut.select(*_AT, "codes").mapInArrow(_speculate, _VECTORS), 0
    while True:
        marked, path = store(_wanted(state), "turn-vectors")
        stale = F.col("open") & (F.col("after") != F.col("wanted"))
        if passes:
            discard(cut.sparkSession, previous)  # noqa: F821
        if marked.filter(stale).isEmpty():
            return marked.select(*_AT, "wanted", "final"), passes
        again = cut.select(*_AT, "codes").join(marked.filter(stale), _AT).select(*_AT, "codes", "after", "before", "wanted")
        state = marked.filter(~stale).drop("wanted", "final").unionByName(again.mapInArrow(_fix, _VECTORS))
        previous, passes = path, passes + 1


# --- edits -----------------------------------------------------------------------------------------------------------


def _leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk the state it is left in, by the state it is entered in."""
    for batch in batches:
        out = []
        for codes, end in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
            after, states = vectors(codes, tuple(end))[1:], list(range(4))
            for code, vector in zip(codes, after):
                states = [edits_of(code, vector, s)[1] for s in states]
            out.append(states)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.list_(pa.int32()))], [*_AT, "leaves"])


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each chunk is entered in; a conversation's chunks come in order."""
    at, state = None, START
    for batch in batches:
        out = []
        for known, conv, leaves in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist()):
            if at != (known, conv):
                at, state = (known, conv), START
            out.append(state)
            state = leaves[state]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int32())], [*_AT, "state"])


_PIECE = pa.struct([("pos", pa.int32()), ("role", pa.string()), ("late", pa.bool_()), ("turn", pa.int64()), ("old", pa.string()),
                    ("digest", pa.string())])
_TRACED = ("known boolean, conv long, part int, idx int, audit string, cost long, "
           "pieces array<struct<pos int, role string, late boolean, turn long, old string, digest string>>")


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        audits, spent, pieces = [], [], []
        for codes, runs, late, turn, role, digest, end, final, state in zip(*[c.to_pylist() for c in batch.columns[4:]]):
            after, audit, cost, kept, turns = vectors(codes, tuple(end))[1:], [], 0, [], iter(zip(late, turn, role, digest))
            for code, run, vector in zip(codes, runs, after):
                # Before a forced turn an insertion is never better than after it, so runs are deletions only.
                done, to, paid = ("D" * run, state, DELETE * run) if code == FORCED else edits_of(code, vector, state)
                place = next(turns) if code != FORCED else None
                for edit in done:
                    if edit == "I":
                        state = NEXT[state]
                        kept.append((len(kept), ROLE[state], None, None, None, None))
                    elif edit in "KR":
                        kept.append((len(kept), place[2] if edit == "K" else ROLE[to], *place))
                audit.append(done)
                cost, state = cost + paid, to
            if final:
                for edit in END_EDITS[state]:
                    state = NEXT[state]
                    kept.append((len(kept), ROLE[state], None, None, None, None))
                    audit.append(edit)
                    cost += INSERT
            audits.append("".join(audit))
            spent.append(cost)
            pieces.append([dict(zip(_PIECE.names, p)) for p in kept])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(audits, pa.string()), pa.array(spent, pa.int64()), pa.array(pieces, pa.list_(_PIECE))],
            [*_AT, "audit", "cost", "pieces"])


def traced(cut: DataFrame, steady: DataFrame) -> DataFrame:
    """Audit, cost and the turns that stay of every chunk, given the vectors of :func:`converged`."""
    ready = cut.select(*_AT, "codes").join(steady, _AT).select(*_AT, "codes", "wanted")
    leaves = ready.mapInArrow(_leave, "known boolean, conv long, part int, idx int, leaves array<int>")
    states = leaves.repartition(*_CONV).sortWithinPartitions(*_AT).mapInArrow(
        _enter, "known boolean, conv long, part int, idx int, state int")
    return (cut.join(steady, _AT).join(states, _AT)
            .select(*_AT, "codes", "runs", "late", "turn", "role", "digest", "wanted", "final", "state").mapInArrow(_trace, _TRACED))


def _ours(known: Column, conv: Column) -> Column:
    return F.when(known, conv)


def repair(rows: DataFrame, chunk_rows: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text).

    Returns a report per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and the repaired
    turns (conv_id, part, idx, pos, role, text), which (part, idx, pos) puts in order.

    Turns are taken by number, nulls first; those of equal number by role and text hash. A null role or text counts as one
    space, null ids as one conversation. A role is what its first letter says; others than s, u and a cannot be kept. Equal
    turns are counted before they are shuffled. Other columns are not read, and an empty table gives empty results.
    Texts are compared by their SHA-256.
    """
    placed = _placed(rows)
    cut, _ = store(chunks(placed, chunk_rows), "turn-chunks")
    steady, _ = converged(cut)
    edits, _ = store(traced(cut, steady), "turn-edits")

    earlier = Window.partitionBy(*_CONV).orderBy("part", "idx")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    last_turn = F.last("last_turn", ignorenulls=True).over(before)
    last_role = F.lag("last_role").over(earlier)
    legal = F.concat(last_role, "first_role").isin("su", "ua", "au")
    linked = cut.drop("codes", "runs", "late", "turn", "role", "digest").select(
        "*", F.when(last_turn == F.col("first_turn"), 1).otherwise(0).alias("same"),
        F.when(last_role.isNotNull() & ~legal, 1).otherwise(0).alias("odd"))
    counts = linked.groupBy(*_CONV).agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - F.col("same")), F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.col("odd")).alias("illegal"))
    # The audit of a conversation is one value of the result, as long as the conversation.
    ordered = F.sort_array(F.collect_list(F.struct("part", "idx", "audit")))
    audits = edits.groupBy(*_CONV).agg(F.sum("cost").alias("cost"),
                                       F.array_join(F.transform(ordered, lambda x: x["audit"]), "").alias("audit"))
    report = counts.join(audits, _CONV).select(_ours(F.col("known"), F.col("conv")).alias("conv_id"), "gaps", "blank", "duplicate",
                                               "truncated", "illegal", "cost", "audit")

    pieces = edits.select(*_AT, F.explode("pieces").alias("p"))
    inserted = pieces.filter("p.digest is null").select(*_AT, "p.pos", "p.role", F.lit("").alias("text"))
    kept = pieces.filter("p.digest is not null").select(*_AT, "p.pos", F.col("p.role").alias("new"), "p.late", "p.turn",
                                                        F.col("p.old").alias("role"), "p.digest")
    texts = placed.groupBy(*_PLACE).agg(F.first("text").alias("text"))
    stay = kept.join(texts, _PLACE).select(*_AT, "pos", F.col("new").alias("role"), "text")
    turns = stay.unionByName(inserted).select(_ours(F.col("known"), F.col("conv")).alias("conv_id"), "part", "idx", "pos", "role", "text")
    return report, turns


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    none = object()
    at, digest = none, None
    for batch in batches:
        out = []
        for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if at is none or conv != at:
                if at is not none:
                    out.append([at, digest.hexdigest()])
                at, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield _arrow(out, schema)
    if at is not none:
        yield _arrow([[at, digest.hexdigest()]], schema)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired turns.

    A hash over a conversation is one chain: its turns pass through one task, sorted and one at a time.
    """
    prepare(turns.sparkSession)
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "idx", "pos").select("conv_id", "role", "text")
            .mapInArrow(_hashes, "conv_id long, repaired_sha256 string"))


def _sql() -> str:
    """The same by a forward recursion over the turns: for each state the least (cost, audit) with its repaired lines."""
    state = "struct(c bigint, a varchar, r varchar[])"
    edit = lambda s, cost, letter, line: (
        f"case when {s} is not null then {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 'r': "
        + (f"list_append({s}.r, {line})" if line else f"{s}.r") + "} end")
    insert = lambda s, role: edit(s, INSERT, "I", f"'{role}:'")
    delete = lambda s: edit(s, DELETE, "D", None)
    more = f"(case when truncated then {TRUNCATED} else 0 end)"
    keep = lambda s, initial: (f"case when not forced and initial = '{initial}' then "
                               + edit(s, more, "K", "role || ':' || text") + " end")
    change = lambda s, role: (f"case when not forced then " + edit(s, f"{REROLE} + {more}", "R", f"'{role}:' || text") + " end")
    to_user = ", ".join(f"{how(s, to)}" for s in ("s0", "s1", "a") for how, to in ((keep, "u"), (change, "user")))
    relax = lambda source: (
        f"(select *, list_min([s3, {insert('u', 'assistant')}]) as a from (select *, list_min([s2, {insert('s0', 'user')}, "
        f"{insert('s1', 'user')}, {insert('s3', 'user')}]) as u from {source}))")
    crc = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(1, length(key) + 1),
        lambda i: [ascii(substr(key, i::int, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295)"""
    return f"""
  with recursive raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
      coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
  kinds as (select *, {crc} % 20 as kind from raw),
  damaged as (select conv_id, turn, case kind when 4 then 'user' else role end as role,
      case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
      unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy from kinds),
  seen as (select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as core,
      row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos,
      row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again from damaged),
  faults as (select *, substr(role, 1, 1) as initial, core = '' as blank, core <> '' and again as duplicate, core = '' or again as forced,
      core <> '' and not again and right(core, 1) not in ('.', '!', '?') as truncated,
      lag(substr(role, 1, 1)) over (partition by conv_id order by pos) || substr(role, 1, 1) as pair from seen),
  counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
      count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
      count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from faults group by conv_id),
  walk as (select conv_id, 0::bigint as pos, {{'c': 0, 'a': '', 'r': []}}::{state} as s0, null::{state} as s1, null::{state} as s2,
      null::{state} as s3 from counts
    union all
    select conv_id, pos + 1, {delete('s0')}::{state}, list_min([{delete('s1')}, {keep('s0', 's')}])::{state},
      list_min([{delete('u')}, {to_user}])::{state}, list_min([{delete('a')}, {keep('u', 'a')}, {change('u', 'assistant')}])::{state}
    from {relax('(select walk.*, role, text, initial, forced, truncated from walk join faults on walk.conv_id is not distinct from faults.conv_id and faults.pos = walk.pos + 1)')}),
  best as (select conv_id, list_min([s0, a]) as b from {relax('(select walk.* from walk join counts on walk.conv_id is not distinct from counts.conv_id and pos = n)')})
  select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
         coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(b.c, 0)::bigint as cost,
         coalesce(b.a, '') as audit, sha256(coalesce(array_to_string(b.r, chr(10)), '')) as repaired_sha256
  from (select distinct conv_id from conversations) c left join counts on c.conv_id is not distinct from counts.conv_id
       left join best on c.conv_id is not distinct from best.conv_id"""


@query("op12_turn_repair", _sql())
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    conversations = table(spark, sf_dir, "conversations")
    report, turns = repair(damage(conversations))
    same = lambda name: F.col("c.conv_id").eqNullSafe(F.col(f"{name}.conv_id"))
    none = hashlib.sha256().hexdigest()
    zero = [F.coalesce(f"r.{name}", F.lit(0)).cast("long").alias(name)
            for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("c")
            .join(report.alias("r"), same("r"), "left").join(digests(turns).alias("d"), same("d"), "left")
            .select("c.conv_id", *zero, F.coalesce("r.audit", F.lit("")).alias("audit"),
                    F.coalesce("d.repaired_sha256", F.lit(none)).alias("repaired_sha256")))
