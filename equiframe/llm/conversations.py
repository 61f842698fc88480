"""Conversation repair: the cheapest edits that make turns alternate.

A conversation's rows, by turn (NULL first), then role and text digest, get
one edit each: Keep (0), Rerole to the role that must come (1) or Delete (2;
the only one for a blank or duplicate row); Insert (5) adds an empty turn
anywhere; a truncated row that stays costs 5 more.  The roles' initials must
then read ``(s?(ua)+)?``.  Four states tell which role may come, so the costs
of a stretch of rows are a 4 x 4 matrix and stretches combine by (min, +).

Rows are sorted by range partitions over (conversation, turn, role, digest),
so a conversation of any size lies in as many tasks as it needs, and cut into
blocks of ``BLOCK`` rows.  Then

1. every block gives its cost matrix;
2. going backwards over a conversation's blocks, the cost vector after each
   block is the only thing kept: the checkpoints;
3. every block recomputes its own vectors from its checkpoint -- again storing
   only every ``STEP``-th and recomputing the stretch between two while it
   walks forward -- and takes at each row the edit of least initial (D, I, K,
   R) among the tight ones, from each of the four states;
4. going forwards over the blocks, the state before each says which walk holds.

Steps 2 and 4 stream one small row per block in order; a conversation is one
block unless it has more than ``BLOCK`` rows or a range ends in it.  Equal
rows (a third of a table may repeat one) are counted before anything is
shuffled and stand in the sort once with their number.  Texts are shuffled
only to fetch those that stay.  Every step ends in a written table.

Defined cases: NULL role or text is one space (so the text is blank and the
initial none); NULL turns come first and count in no gap; NULL conversation ids
are one conversation; empty texts are blank; very long texts are carried as
digests; ties of turn go by role, then text digest, repeated rows adjacent; an
empty table gives empty results; further columns are not carried into the
repaired turns, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equiframe.llm.shared import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 4096   # rows of a conversation that one cost matrix stands for
STEP = 64      # rows between two cost vectors that a block stores
NEVER = 1 << 60

# States by the roles so far, the role that each asks for, and
# the state after an inserted or reroled turn.
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
#: State after a kept row of initial s, u, a or another, by state; None: not allowed.
_KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
_ENDS = (0, 2 * INSERT, INSERT, 0)

#: A row's code: initial (0 to 3), + 4 blank or duplicate (must go), + 8
#: truncated, + 16 the first of the copies of a distinct row.
_GO, _CUT, _NEW = 4, 8, 16
_SHORT = 64    # rows of stretches whose results a task remembers


def _step(code: int, after: tuple) -> tuple:
    """Costs before a row from those after it, by state."""
    out = [DELETE + c for c in after]
    if not code & _GO:
        more = TRUNCATED if code & _CUT else 0
        for s in range(4):
            kept = _KEPT[s][code & 3]
            if kept is not None:
                out[s] = min(out[s], KEEP + more + after[kept])
            out[s] = min(out[s], REROLE + more + after[AFTER[s]])
    # an insertion leads to another state before the same row; two in a row at most
    for _ in range(2):
        out = [min(c, INSERT + out[AFTER[s]]) for s, c in enumerate(out)]
    return tuple(out)


def matrix(codes: bytes) -> tuple:
    """Least cost from each state before the rows to each after them."""
    columns = []
    for end in range(4):
        cost = tuple(0 if s == end else NEVER for s in range(4))
        for code in reversed(codes):
            cost = _step(code, cost)
        columns.append([min(c, NEVER) for c in cost])
    return tuple(zip(*columns))


def _vectors(codes: bytes, last: tuple) -> list[tuple]:
    """Cost vectors before each row, and after the last one."""
    out = [last]
    for code in reversed(codes):
        out.append(_step(code, out[-1]))
    return out[::-1]


def walk(codes: bytes, last: tuple, state: int, final: bool) -> tuple[str, int, int]:
    """(edits, state after them, cost) of the ASCII-least tight walk from
    ``state`` over the rows, given the costs after the last row.  ``final``: no
    row follows, insertions may close the conversation."""
    marks = [last]  # vectors before rows 0, STEP, 2 STEP, ..., kept alone
    cost = last
    for i in range(len(codes) - 1, -1, -1):
        cost = _step(codes[i], cost)
        if i % STEP == 0:
            marks.append(cost)
    marks.reverse()
    total, edits = cost[state], []
    for k in range(0, len(codes), STEP):
        part = codes[k:k + STEP]
        vectors = _vectors(part, marks[k // STEP + 1])
        for i, code in enumerate(part):
            while True:
                cost, after = vectors[i][state], vectors[i + 1]
                more = TRUNCATED if code & _CUT else 0
                kept = None if code & _GO else _KEPT[state][code & 3]
                if cost == DELETE + after[state]:
                    edits.append("D")
                elif cost == INSERT + vectors[i][AFTER[state]]:
                    edits.append("I")
                    state = AFTER[state]
                    continue
                elif kept is not None and cost == KEEP + more + after[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = AFTER[state]
                break
    if not final:
        return "".join(edits), state, total - last[state]
    while state not in (START, ASSISTANT):
        edits.append("I")
        state = AFTER[state]
    return "".join(edits), state, total


_matrix_of_few, _walk_of_few = lru_cache(1 << 14)(matrix), lru_cache(1 << 14)(walk)


# ---- rows -----------------------------------------------------------------

def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def conversation_key(c: str = "conv_id") -> Column:
    """A conversation's id as text, that of NULL ids included."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def _tidy(rows: DataFrame) -> DataFrame:
    return rows.select(conversation_key().alias("conv"), F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"),
                       _or_space("text").alias("text")).withColumn("digest", F.md5(F.encode("text", "utf-8")))


_SOLID = r"[^\x20\x09-\x0D]"


def _faults(tidy: DataFrame) -> DataFrame:
    """Distinct rows (conv, turn, role, digest) in order, with their number,
    first fault, initial and place."""
    keys = ["conv", "turn", "role", "digest"]
    blank = ~F.col("text").rlike(_SOLID)
    flags = F.when(blank, 1).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 2).otherwise(0)
    rows = tidy.withColumn("flag", flags).groupBy(*keys, "flag").agg(F.count(F.lit(1)).alias("times"))
    # a row whose role and text an earlier turn has is a duplicate
    first = rows.groupBy("conv", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count(F.lit(1)).alias("turns")
    ).filter("turns > 1").drop("turns")
    rows = rows.join(first, ["conv", "role", "digest"], "left").withColumn(
        "again", F.coalesce(F.col("first") < F.struct(F.col("turn").isNotNull().alias("col1"), "turn"), F.lit(False))).drop("first")
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(
        F.col("role").startswith("a"), 2).otherwise(3)
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest"]
    sorted_rows = rows.select(*keys, "times", "flag", "again", initial.alias("initial")) \
        .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return stored(sorted_rows, "conversation-rows")


def row_codes(initial: int, flag: int, again: bool, times: int) -> bytes:
    """Codes of a distinct row's copies: after the first all are duplicates."""
    go = _GO if flag == 1 or again else 0
    return bytes([_NEW | initial | go | (_CUT if flag == 2 and not go else 0)]) + bytes([initial | _GO]) * (times - 1)


_BLOCK = ("conv string, place long, skip long, codes binary, costs array<long>, blank long, duplicate long, truncated long, "
          "illegal long, first int, last int")
#: Adjacent initials that are allowed: su, ua, au.
_ALLOWED = {(0, 1), (1, 2), (2, 1)}


class _Block:
    def __init__(self, conv, place, skip):
        self.conv, self.place, self.skip, self.codes, self.upto = conv, place, skip, bytearray(), place
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self):
        codes = bytes(self.codes)
        costs = (_matrix_of_few if len(codes) <= _SHORT else matrix)(codes)
        return {"conv": self.conv, "place": self.place, "skip": self.skip, "codes": codes,
                "costs": [c for line in costs for c in line], "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "first": codes[0] & 3, "last": codes[-1] & 3}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted rows.  ``place`` and ``skip`` name a block's first
    copy: the distinct row and how many of its copies came before."""
    schema = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("skip", pa.int64()), ("codes", pa.binary()),
                        ("costs", pa.list_(pa.int64())), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")],
                        ("first", pa.int32()), ("last", pa.int32())])
    now, out = None, []
    for b in batches:
        for r in b.to_pylist():
            skip = 0
            while skip < r["times"]:  # copies beyond a block's end begin the next
                # a task may read pieces of the sorted table that don't follow each other
                if now is None or now.conv != r["conv"] or len(now.codes) >= BLOCK or r["place"] - now.upto > 1 \
                        or r["place"] < now.upto:
                    if now is not None:
                        out.append(now.row())
                    now = _Block(r["conv"], r["place"], skip)
                take = min(r["times"] - skip, BLOCK - len(now.codes))
                codes = row_codes(r["initial"], r["flag"], r["again"] or skip > 0, take)
                if skip:  # goes on with copies of the row before
                    codes = bytes([codes[0] & ~_NEW]) + codes[1:]
                if now.codes:
                    now.illegal += (now.codes[-1] & 3, r["initial"]) not in _ALLOWED
                now.illegal += take - 1
                now.blank += take * (r["flag"] == 1)
                now.duplicate += sum(1 for c in codes if c & _GO) * (r["flag"] != 1)
                now.truncated += sum(1 for c in codes if c & _CUT)
                now.codes += codes
                now.upto = r["place"]
                skip += take
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    if now is not None:
        out.append(now.row())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation from the last to the first: the cost vector
    after each; the total and border pairs with the first."""
    conv, cost, after = None, None, None
    for b in batches:
        vectors, finals, illegal = [], [], []
        for c, m, first, last in zip(*(b.column(k).to_pylist() for k in (0, 3, 4, 5))):
            new = c != conv
            if new:
                conv, cost, after = c, _ENDS, None
            vectors.append(list(cost))
            finals.append(new)
            illegal.append(int(after is not None and (last, after) not in _ALLOWED))
            cost = tuple(min(NEVER, *(m[4 * s + t] + cost[t] for t in range(4))) for s in range(4))
            after = first
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array(vectors, pa.list_(pa.int64())), pa.array(finals, pa.bool_()), pa.array(illegal, pa.int64())],
            names=["conv", "place", "skip", "after", "final", "border"])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The walks of a block from each state."""
    for b in batches:
        edits, states, costs = [], [], []
        for codes, after, final in zip(*(b.column(k).to_pylist() for k in (3, 4, 5))):
            from_each = _walk_of_few if len(codes) <= _SHORT else walk
            four = [from_each(codes, tuple(after), s, final) for s in range(4)]
            for all_of, own in zip((edits, states, costs), zip(*four)):
                all_of.append(list(own))
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array(edits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32())),
             pa.array(costs, pa.list_(pa.int64()))], names=["conv", "place", "skip", "edits", "states", "costs"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation from the first to the last: the state before each."""
    conv, state = None, START
    for b in batches:
        before = []
        for c, states in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            if c != conv:
                conv, state = c, START
            before.append(state)
            state = states[state]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(before, pa.int32())], names=["conv", "place", "skip", "state"])


def _in_order(df: DataFrame, *order) -> DataFrame:
    """Rows of a conversation in one partition, in order, to be streamed."""
    return df.repartition("conv").sortWithinPartitions("conv", *order)


class Repair:
    """Edits of every conversation of ``rows`` (conv_id, turn, role, text).

    ``rows`` is read twice (faults, texts that stay): a table, or one derived
    by steps that give the same rows again."""

    def __init__(self, rows: DataFrame):
        self.tidy = _tidy(rows)
        self.rows = _faults(self.tidy)
        blocks = stored(self.rows.mapInArrow(_cut, _BLOCK), "conversation-blocks")
        key = ["conv", "place", "skip"]
        back = stored(_in_order(blocks.select(*key, "costs", "first", "last"), F.desc("place"), F.desc("skip"))
                      .mapInArrow(_backward, "conv string, place long, skip long, after array<long>, final boolean, border long"),
                      "conversation-costs")
        walks = stored(blocks.select(*key, "codes").join(back, key).select(*key, "codes", "after", "final")
                       .mapInArrow(_walks, "conv string, place long, skip long, edits array<string>, states array<int>, costs array<long>"),
                       "conversation-walks")
        states = _in_order(walks.select(*key, "states"), "place", "skip").mapInArrow(
            _forward, "conv string, place long, skip long, state int")
        #: (conv, place, skip, codes, state, edits, cost) of every block.
        self.blocks = stored(blocks.select(*key, "codes").join(
            walks.join(states, key).select(*key, "state", *[F.element_at(c, F.col("state") + 1).alias(n)
                                                            for c, n in (("edits", "edits"), ("costs", "cost"))]), key),
            "conversation-edits")
        counts = blocks.join(back.select(*key, "border"), key).groupBy("conv").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
            (F.sum("illegal") + F.sum("border")).alias("illegal"))
        turns = self.rows.groupBy("conv").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"),
                                              F.count_distinct("turn").alias("n")).select(
            "conv", F.when(F.col("n") > 0, F.col("hi") - F.col("lo") + 1 - F.col("n")).otherwise(0).cast("long").alias("gaps"))
        #: (conv, gaps, blank, duplicate, truncated, illegal) of every conversation with rows.
        self.faults = turns.join(counts, "conv")

    def edits(self) -> DataFrame:
        """One row per edit, in the order of ``place``, ``skip`` and ``nth``:
        (conv, place, skip, nth, edit, role); ``role`` is that of an inserted
        or reroled turn."""
        return self.blocks.mapInArrow(_spread, "conv string, place long, skip long, nth int, edit string, role string, at long")

    def cost_and_audit(self) -> DataFrame:
        """(conv, cost, audit): the edits' initials of a conversation are one
        value of its row, and their cost."""
        return self.blocks.groupBy("conv").agg(
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "skip", "edits"))), lambda s: s["edits"]), "")
            .alias("audit"))

    def turns(self) -> DataFrame:
        """The repaired conversations: (conv, place, skip, nth, role, text)."""
        left = self.edits().filter("edit <> 'D'")
        source = self.rows.select(F.col("place").alias("at"), "conv", "turn", "digest", F.col("role").alias("own"))
        texts = self.tidy.groupBy("conv", "digest").agg(F.first("text").alias("text"))
        stay = left.filter("edit <> 'I'").join(source, ["conv", "at"]).join(texts, ["conv", "digest"])
        order = ["conv", "place", "skip", "nth"]
        return stay.select(*order, F.coalesce("role", "own").alias("role"), "text").unionByName(
            left.filter("edit = 'I'").select(*order, "role", F.lit("").alias("text")))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "place", "skip", "nth", "edit", "role", "at"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64()]
    for b in batches:
        for r in b.to_pylist():
            out, state, i, at, codes = [], r["state"], 0, r["place"], r["codes"]
            for nth, e in enumerate(r["edits"]):
                if e != "I" and i and codes[i] & _NEW:
                    at += 1
                out.append((r["conv"], r["place"], r["skip"], nth, e, WANTED[state] if e in "IR" else None,
                            at if e != "I" else None))
                if e != "D":
                    state = AFTER[state] if e in "IR" else _KEPT[state][codes[i] & 3]
                i += e != "I"
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each conversation's ``role:text`` lines, as they stream by."""
    conv, digest = None, None
    for b in batches:
        convs, sums = [], []
        for c, role, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            if c != conv:
                if conv is not None:
                    convs.append(conv)
                    sums.append(digest.hexdigest())
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(sums, pa.string())], names=["conv", "sha256"])
    if conv is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "sha256"])


def repaired_hash(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired turns, newline-joined, in order: a hash is
    read in sequence, so a conversation streams through one task."""
    return _in_order(turns, "place", "skip", "nth").select("conv", "role", "text").mapInArrow(_hash, "conv string, sha256 string")
