"""Repair of the role structure of conversations, by a Viterbi search that runs over chunks in parallel.

A repaired conversation is an optional system turn, then user and assistant in turn, or nothing. Every row is
kept (0), given another role (1) or deleted (2; the only choice for blank and repeated rows); empty turns may be
inserted anywhere (5), and a truncated row costs 5 more unless it goes. The cheapest edits are wanted, of equals
the ones whose initials (D, I, K, R) come first as text.

Rows are sorted by range over the whole table, so a conversation of any size is spread over many tasks; its
part in a task is a chunk, a string with one symbol a row. Going backwards, each chunk turns a vector of four
costs (one per state of the grammar) at its end into one at its start. Chunks start from a guessed vector; in
each pass those whose true vector differs from the one used, by more than a constant, run again. Chunks whose
vectors never come to agree are settled exactly by their cost matrices after PASSES passes. With true costs at
its end, each chunk traces the least edits from every state it may be entered in, and the traces are stitched.

Defined cases: null conversations are one conversation; null turns come first; rows of one turn are ordered by
role, then by the digest of their text; a null role or text is one space; an empty table gives an empty result;
other columns are left out. A conversation's digest needs its rows in order, so they stream through one task
each in bounded memory, sorted on disk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from winnow.llm.common import SPACE, SPACE_CHARS, Scratch, same, small

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5       # costs of edits; the last for a truncated row that stays
ROLES = ("user", "assistant")
PASSES = 6          # fix-up passes before the rest is settled by matrices

# States: nothing yet, after system, after user, after assistant. The next turn, and the state it leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
END = (0, 2 * INSERT, INSERT, 0)        # cost of completing a conversation without further rows
FAR = 1 << 40

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY = ("conv", "turn", "role", "digest")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _moves(state: int, symbol: str) -> Iterator[tuple[int, str, int]]:
    """Cost, initial and next state of what can be done with a row."""
    initial, fault = "sua-"[(ord(symbol) - 65) // 3], (ord(symbol) - 65) % 3
    yield DELETE, "D", state
    if fault == 2:
        return
    extra = CUT_OFF if fault else 0
    if initial == "s" and state == START:
        yield KEEP + extra, "K", SYSTEM
    elif initial == "-sua"[NEXT[state]]:
        yield KEEP + extra, "K", NEXT[state]
    yield REROLE + extra, "R", NEXT[state]


@lru_cache(maxsize=100_000)
def step(after: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], int, str]:
    """Backwards over one row: costs before it less their least, that least, and the first edit of each state."""
    done = [min((cost + after[to], initial) for cost, initial, to in _moves(s, symbol)) for s in range(4)]
    costs, edits = [c for c, _ in done], [e for _, e in done]
    for _ in range(2):          # an inserted turn may be followed by another
        for s in range(4):
            longer = INSERT + costs[NEXT[s]]
            if (longer, "I") < (costs[s], edits[s]):
                costs[s], edits[s] = longer, "I"
    least = min(costs)
    return tuple(c - least for c in costs), least, "".join(edits)


def backwards(symbols: str, ending) -> tuple[tuple[int, ...], int]:
    """Costs at the start of a chunk less their least, and that least, from the costs at its end."""
    vector, total = tuple(map(int, ending)), 0
    for symbol in reversed(symbols):
        vector, least, _ = step(vector, symbol)
        total += least
    return vector, total


def trace(symbols: str, ending, last: bool) -> list[tuple[str, int]]:
    """Least edits and state at the end, for each state at the start of a chunk."""
    vector, edits = tuple(map(int, ending)), []
    for symbol in reversed(symbols):
        vector, _, first = step(vector, symbol)
        edits.append(first)
    traces = []
    for state in range(4):
        out = []
        for symbol, first in zip(symbols, reversed(edits)):
            while first[state] == "I":
                out.append("I")
                state = NEXT[state]
            out.append(first[state])
            if first[state] != "D":
                state = SYSTEM if first[state] == "K" and state == START and symbol < "D" else NEXT[state]
        while last and END[state]:
            out.append("I")
            state = NEXT[state]
        traces.append(("".join(out), state))
    return traces


def coded(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, the fault of the first copy, and no text."""
    text = F.col("text")
    last = F.right(F.rtrim(F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))), F.lit(1))
    distinct = (rows.select(*KEY, F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1).alias("fault"))
                .groupBy(*KEY).agg(F.first("fault").alias("fault"), F.count("*").alias("copies")))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    repeated = (distinct.groupBy("conv", "role", "digest").agg(F.min(turn).alias("__first"), F.count("*").alias("n"))
                .where("n > 1").select(F.col("conv").alias("__conv"), F.col("role").alias("__role"),
                                       F.col("digest").alias("__digest"), F.col("__first.turn").alias("__turn"),
                                       F.lit(True).alias("__again")))
    repeated = small(repeated)
    pairs = [("conv", "__conv"), ("role", "__role"), ("digest", "__digest")]
    return (distinct.join(repeated, same(distinct, repeated, pairs), "left")
            .select(*KEY, "fault", "copies",
                    (F.col("__again").isNotNull() & ~F.col("turn").eqNullSafe(F.col("__turn"))).alias("repeats")))


CHUNK = T.StructType([
    T.StructField("chunk", T.LongType()), T.StructField("symbols", T.StringType()),
    *(T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")),
    T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType())])
HEAD = ("first_turn", "first_role", "first_digest")
LEGAL = ("su", "ua", "au")


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(shape)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    for batch in batches:
        yield zip(*(c.to_pylist() for c in batch.columns))


class _Chunk:
    """A conversation's rows in one task, as symbols and counts."""

    def __init__(self, conv, task: int, head: tuple, initial: str):
        self.conv, self.task, self.head, self.first, self.last = conv, task, head, initial, None
        self.symbols: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def add(self, turn, initial: str, fault: int, copies: int, repeats: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        self.illegal += (self.last is not None and self.last + initial not in LEGAL)
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        self.last = initial
        kind = 65 + 3 * {"s": 0, "u": 1, "a": 2}.get(initial, 3)
        if fault == 2:
            self.blank += copies
            self.symbols.append(chr(kind + 2) * copies)
            return
        if not repeats:
            self.truncated += fault
            self.symbols.append(chr(kind + fault))
        self.duplicate += copies - (not repeats)
        self.symbols.append(chr(kind + 2) * (copies - (not repeats)))

    def row(self) -> tuple:
        return (self.conv, *self.head, self.task, "".join(self.symbols), self.blank, self.duplicate, self.truncated,
                self.illegal, self.turns, self.low, self.high, self.first, self.last)


def _chunked(rows: DataFrame) -> DataFrame:
    """A row per conversation and task of the sorted rows: its symbols, and counts that add up."""
    order = [F.col(c).asc_nulls_first() for c in KEY]
    shape = T.StructType([rows.schema["conv"], *(T.StructField(h, rows.schema[c].dataType)
                                                 for h, c in zip(HEAD, KEY[1:])), *CHUNK.fields])
    arrow = to_arrow_schema(shape)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, now = TaskContext.get().partitionId(), [], None
        for batch in _rows(batches):
            for conv, turn, role, digest, fault, copies, repeats in batch:
                initial = role[:1]
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Chunk(conv, task, (turn, role, digest), initial)
                now.add(turn, initial, fault, copies, repeats)
            yield _batch(done, arrow)
            done = []
        if now is not None:
            yield _batch([now.row()], arrow)

    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(*KEY, "fault", "copies", "repeats").mapInArrow(chunks, shape))


COSTS = T.StructType([T.StructField("vector", T.ArrayType(T.LongType())), T.StructField("least", T.LongType())])
TRACES = T.ArrayType(T.StructType([T.StructField("edits", T.StringType()), T.StructField("state", T.IntegerType())]))


@F.pandas_udf(COSTS)
def _backwards(symbols: pd.Series, ending: pd.Series) -> pd.DataFrame:
    found = [backwards(s, e) for s, e in zip(symbols, ending)]
    return pd.DataFrame({"vector": [list(v) for v, _ in found], "least": [n for _, n in found]})


@F.pandas_udf(TRACES)
def _traces(symbols: pd.Series, ending: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([[{"edits": e, "state": s} for e, s in trace(*row)] for row in zip(symbols, ending, last)])


def _vector(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def converge(chunks: DataFrame, scratch: Scratch, passes: int = PASSES) -> DataFrame:
    """True costs at the end of each chunk (conv, chunk, symbols, last, ending), up to a constant.

    Every pass takes a chunk's costs from the chunk after it and runs those again whose costs differ from
    the ones used by more than a constant.
    """
    along = Window.partitionBy("conv").orderBy("chunk")
    state = chunks.select("conv", "chunk", "symbols", F.lead("chunk").over(along).isNull().alias("last"),
                          _vector(END).alias("ending"))
    state = state.withColumn("start", _backwards("symbols", "ending"))
    for i in range(passes + 1):
        state = scratch.write(state, f"pass{i}")
        if i:
            scratch.drop(f"pass{i - 1}")
        true = F.when(F.col("last"), F.col("ending")).otherwise(F.lead("start").over(along)["vector"])
        state = state.withColumn("true", true).withColumn("again", F.col("true") != F.col("ending"))
        left = state.where("again").count()
        if not left:
            return state.drop("true", "again", "start")
        if i == passes:
            return _settled(state.drop("true", "again", "start"))
        state = state.withColumn("ending", F.col("true")).withColumn(
            "start", F.when(F.col("again"), _backwards("symbols", "ending")).otherwise(F.col("start"))).drop("true", "again")


def _settled(state: DataFrame) -> DataFrame:
    """Costs at the end of each chunk from the chunks' cost matrices, one small row a chunk."""
    units = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    matrix = state.select("conv", "chunk", "last", F.array(*[_backwards("symbols", _vector(u)) for u in units]).alias("m"))

    shape = T.StructType([T.StructField("__conv", state.schema["conv"].dataType),
                          T.StructField("__chunk", T.LongType()), T.StructField("__ending", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(shape)

    def along(group: pa.Table) -> pa.Table:
        vector, out = list(END), []
        for row in sorted(group.to_pylist(), key=lambda r: -r["chunk"]):
            out.append((row["conv"], row["chunk"], [v - min(vector) for v in vector]))
            starts = [[v + part["least"] for v in part["vector"]] for part in row["m"]]
            vector = [min(FAR, *(vector[j] + starts[j][s] for j in range(4))) for s in range(4)]
        return pa.Table.from_batches([_batch(out, arrow)])

    true = matrix.groupBy("conv").applyInArrow(along, shape)
    return (state.drop("ending").join(true, same(state, true, [("conv", "__conv"), ("chunk", "__chunk")]))
            .select("conv", "chunk", "symbols", "last", F.col("__ending").alias("ending")))


def _edited(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """Each chunk's edits, its share of the cost, and the key of its first row."""
    counted = scratch.write(chunks.select("conv", "chunk", "symbols", *HEAD, F.count("*").over(
        Window.partitionBy("conv")).alias("parts")), "counted")
    alone, several = counted.where("parts = 1"), counted.where("parts > 1")
    true = converge(several, scratch)

    shape = T.StructType([T.StructField("__conv", chunks.schema["conv"].dataType), T.StructField("__chunk", T.LongType()),
                          T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())])
    arrow = to_arrow_schema(shape)

    def stitch(group: pa.Table) -> pa.Table:
        state, out = START, []
        for row in sorted(group.to_pylist(), key=lambda r: r["chunk"]):
            share = row["b"]["least"] + (0 if out else row["b"]["vector"][START])
            out.append((row["conv"], row["chunk"], row["t"][state]["edits"], share))
            state = row["t"][state]["state"]
        return pa.Table.from_batches([_batch(out, arrow)])

    both = true.select("conv", "chunk", _traces("symbols", "ending", "last").alias("t"),
                       _backwards("symbols", "ending").alias("b")).groupBy("conv").applyInArrow(stitch, shape)
    stitched = several.join(both, same(several, both, [("conv", "__conv"), ("chunk", "__chunk")]))
    ending = _vector(END)
    whole = alone.select("conv", "chunk", *HEAD, _traces("symbols", ending, F.lit(True)).alias("t"),
                         _backwards("symbols", ending).alias("b"))
    return (whole.select("conv", "chunk", *HEAD, F.col("t")[START]["edits"].alias("edits"),
                         (F.col("b.least") + F.col("b.vector")[START]).alias("cost"))
            .unionByName(stitched.select("conv", "chunk", *HEAD, "edits", "cost")))


def _apply(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows (conv, turn, role, text, edit), in order inside the one task that holds a conversation.

    Edits travel as rows that sort before the first row they speak of, so a task reads both in one stream.
    """
    marks = edits.select("conv", F.col("first_turn").alias("turn"), F.col("first_role").alias("role"),
                         F.col("first_digest").alias("digest"), F.lit(0).alias("kind"), F.col("edits").alias("text"))
    both = rows.select(*KEY, F.lit(1).alias("kind"), "text").unionByName(marks)
    order = [F.col(c).asc_nulls_first() for c in (*KEY, "kind")]
    shape = T.StructType([rows.schema["conv"], rows.schema["turn"], T.StructField("role", T.StringType()),
                          T.StructField("text", T.StringType()), T.StructField("edit", T.StringType())])
    arrow = to_arrow_schema(shape)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, at, state, out = object(), "", 0, START, []

        def inserts():
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                state, at = NEXT[state], at + 1
                out.append((conv, None, ROLES[state - USER], "", "I"))

        for batch in _rows(batches):
            for of, turn, role, kind, text in batch:
                inserts()
                if kind == 0:
                    if of != conv:
                        conv, state = of, START
                    edits, at = text, 0
                    continue
                edit, at = edits[at], at + 1
                if edit == "D":
                    continue
                state = SYSTEM if edit == "K" and state == START and role[:1] == "s" else NEXT[state]
                out.append((conv, turn, ROLES[state - USER] if edit == "R" else role, text, edit))
            yield _batch(out, arrow)
            out.clear()
        inserts()
        yield _batch(out, arrow)

    return (both.repartition("conv").sortWithinPartitions(*order)
            .select("conv", "turn", "role", "kind", "text").mapInArrow(repair, shape))


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; the rows lie in order in one task a conversation."""
    shape = T.StructType([repaired.schema["conv"], T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(shape)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        for batch in _rows(batches):
            out = []
            for of, role, text in batch:
                line = f"{role}:{text}".encode()
                if sha is not None and of == conv:
                    sha.update(b"\n" + line)
                    continue
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = of, hashlib.sha256(line)
            yield _batch(out, arrow)
        yield _batch([(conv, sha.hexdigest())] if sha is not None else [], arrow)

    return repaired.select("conv", "role", "text").mapInArrow(streamed, shape)


def _standard(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text")).withColumn(
        "digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Repaired rows (conv, turn, role, text, edit), and a row per conversation with its faults, cost and audit."""
    scratch = Scratch(rows.sparkSession, "conversations")
    standard = _standard(rows, conv, turn, role, text)
    chunks = scratch.write(_chunked(coded(standard)), "chunks")
    edits = scratch.write(_edited(chunks, scratch), "edits")

    along = Window.partitionBy("conv").orderBy("chunk")
    pair = F.concat(F.lag("last_initial").over(along), F.col("first_initial"))
    seams = chunks.select(
        "conv", "blank", "duplicate", "truncated", "turns", "low", "high",
        (F.col("illegal") + F.when(pair.isNull() | pair.isin(*LEGAL), 0).otherwise(1)).alias("illegal"),
        F.when(F.lag("high").over(along) == F.col("low"), 1).otherwise(0).alias("shared"))
    facts = seams.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns") + F.sum("shared"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in COUNTS[1:]])
    audits = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "edits"))), lambda e: e["edits"]), "").alias("audit"))
    return _apply(standard, edits), merged([facts, audits])


def merged(parts: list[DataFrame]) -> DataFrame:
    """One row per conversation from tables that each know some of its columns."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv").agg(*[F.max(c).alias(c) for c in both.columns if c != "conv"])


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults planted by a hash of conversation and turn; for checks of repairs."""
    blank = F.lit(" ")
    text, role = (F.coalesce(F.col(c), blank) for c in ("text", "role"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    hashed = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                         (F.crc32(key.cast("binary")) % 20).alias("h")).where("h != 0")
    return hashed.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def audit(rows: DataFrame) -> DataFrame:
    """Every conversation of ``rows``, damaged and repaired: faults, cost, edits and digest of the repaired rows."""
    repaired, summary = repair(damaged(rows))
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    found = merged([every, summary, digests(repaired)])
    return found.select(
        F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))
