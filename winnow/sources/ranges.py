"""Records of text files whose line breaks or commas may lie inside quotes, read by all splits at once.

A file is cut at a byte that every record ends with ("\\n" in CSV, "}" in JSON); Spark's text reader hands the
units between them to tasks by byte range. Whether a unit ends a record depends on what is open before it: a
quote, and in JSON a depth of brackets. So each unit is described by what it does to both possible entries
(computed from the unit alone, by column functions), and units compose:

1. One scan composes the units of each split, one row a split.
2. Along each file, the rows of the splits give what is open where a split begins.
3. A second scan joins units to records. Records inside a split are done; a record that crosses splits leaves
   one fragment in each, which are put together afterwards.

The records are written once, to the folder all executors share. The splits of both scans must agree; the second
scan checks every split, and both are repeated where a changed cluster dealt the files anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from winnow.session import scratch_path

ATTEMPTS = 3
SPLITTABLE = ("UTF-8", "US-ASCII", "ISO-8859-1")     # one byte for each of the bytes that matter


@dataclass(frozen=True)
class Grammar:
    """Where units end, and what a unit does: ``effects`` gives (open after, change of depth) for both entries."""

    separator: str
    base: int           # depth between records
    closes: bool        # the separator belongs to the record it ends


CSV = Grammar("\n", 0, False)
JSON_ARRAY, JSON_OBJECT = Grammar("}", 1, True), Grammar("}", 0, True)

# What is open inside a line of CSV: nothing at the start of a field, nothing inside one, a quote, a quote that
# another quote may have ended.
FIELD, INSIDE, QUOTED, ENDED = range(4)


def _csv_effects(unit: Column) -> list[Column]:
    """Whether a quote is open after a line, if none was before and if one was; depths do not change.

    The line is cut at its quotes. A quote opens only at the start of a field; two in a row stand for one.
    """
    parts = F.split(unit, '"')

    def after_text(part: Column, empty: int) -> Column:
        return F.when(part == "", empty).when(part.endswith(","), FIELD).otherwise(INSIDE)

    def after_quote(state: Column, part: Column) -> Column:
        return (F.when((state == FIELD) | (state == ENDED), QUOTED)
                .when(state == INSIDE, after_text(part, INSIDE)).otherwise(after_text(part, ENDED)))

    def run(first: Column) -> Column:
        state = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), first, after_quote)
        return state == QUOTED

    none = ~F.contains(unit, F.lit('"'))
    start = F.element_at(parts, 1)
    return [F.when(none, False).otherwise(run(after_text(start, FIELD))),
            F.when(none, True).otherwise(run(F.lit(QUOTED))), F.lit(0), F.lit(0)]


def _json_effects(unit: Column) -> list[Column]:
    """Whether a string is open after a unit and its "}", and the change of depth, for both entries."""
    parts = F.split(F.regexp_replace(unit, r"(?s)\\.", ""), '"')       # without escaped characters
    toggles = F.size(parts) % 2 == 0

    def depth(odd: int) -> Column:
        text = F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
        return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))

    return [toggles, ~toggles, depth(0) - F.when(toggles, 0).otherwise(1), depth(1) - F.when(toggles, 1).otherwise(0)]


KEY = ["file", "block", "length"]
SPLITS = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("open0", T.BooleanType()), T.StructField("open1", T.BooleanType()),
    T.StructField("depth0", T.LongType()), T.StructField("depth1", T.LongType())])
ENTRIES = T.StructType([*SPLITS.fields[:3], T.StructField("open", T.BooleanType()), T.StructField("depth", T.LongType())])
PIECES = T.StructType([
    *SPLITS.fields[:3], T.StructField("place", T.LongType()), T.StructField("starts", T.BooleanType()),
    T.StructField("ends", T.BooleanType()), T.StructField("text", T.BinaryType())])


def _units(spark: SparkSession, files: str | Sequence[str], grammar: Grammar) -> DataFrame:
    lines = spark.read.option("lineSep", grammar.separator).text(files)
    value = F.col("value")
    if not grammar.closes:      # a byte order mark is no part of the first field
        marked = (F.col("_metadata.file_block_start") == 0) & value.startswith("\ufeff")
        value = F.when(marked, F.substr(value, F.lit(2))).otherwise(value)
    effects = _csv_effects(value) if grammar is CSV else _json_effects(value)
    names = ("open0", "open1", "depth0", "depth1")
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        *[e.cast("boolean" if i < 2 else "long").alias(n) for i, (n, e) in enumerate(zip(names, effects))],
        value.cast("binary").alias("unit"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of a batch that lie in one split."""
    if not batch.num_rows:
        return
    names = batch.schema.names
    change = np.zeros(batch.num_rows, bool)
    change[0] = True
    for k in KEY:
        column = batch.column(names.index(k))
        change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(change).tolist()
    for i, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield tuple(batch.column(names.index(k))[i].as_py() for k in KEY), batch.slice(i, end - i)


def _follow(part: pa.RecordBatch, entry: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """What is open and how deep after each unit, from what is open before the first."""
    open0, open1 = (part.column(part.schema.names.index(n)).to_numpy(zero_copy_only=False) for n in ("open0", "open1"))
    depths = [part.column(part.schema.names.index(n)).to_numpy() for n in ("depth0", "depth1")]
    fixed, swaps = open0 == open1, open0 & ~open1
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))      # the last unit that settles it
    turned = np.cumsum(swaps)
    start = np.where(last >= 0, open0[last], entry)
    after = start ^ ((turned - np.where(last >= 0, turned[last], 0)) % 2 == 1)
    before = np.r_[entry, after[:-1]]
    return after, depth + np.cumsum(np.where(before, depths[1], depths[0]))


def _splits(units: DataFrame) -> DataFrame:
    """One row a split: what it does to both entries."""
    shape = to_arrow_schema(SPLITS)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for of, part in _runs(batch):
                if of != key:
                    if key is not None:
                        done.append((*key, *state))
                    key, state = of, (False, True, 0, 0)
                ends = [_follow(part, bool(state[i]), state[2 + i]) for i in (0, 1)]
                state = (*(bool(a[-1]) for a, _ in ends), *(int(d[-1]) for _, d in ends))
            yield pa.RecordBatch.from_pylist([dict(zip(SPLITS.names, r)) for r in done], schema=shape)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(SPLITS.names, (*key, *state)))], schema=shape)

    return units.select(*SPLITS.names).mapInArrow(compose, SPLITS)


def _entries(splits: DataFrame) -> DataFrame:
    """What is open where each split begins; one row a split runs along each file."""
    shape = to_arrow_schema(ENTRIES)

    def along(table: pa.Table) -> pa.Table:
        is_open, depth, out = False, 0, []
        for row in sorted(table.to_pylist(), key=lambda r: r["block"]):
            out.append({**{k: row[k] for k in KEY}, "open": is_open, "depth": depth})
            is_open, depth = row[f"open{int(is_open)}"], depth + row[f"depth{int(is_open)}"]
        return pa.Table.from_pylist(out, schema=shape)

    return splits.groupBy("file").applyInArrow(along, ENTRIES)


def _pieces(units: DataFrame, entries: dict, grammar: Grammar) -> DataFrame:
    """Records and fragments of records, in order of ``place`` inside each split.

    A split that ``entries`` does not know gives one row without text.
    """
    known = units.sparkSession.sparkContext.broadcast(entries)      # a flag and a depth for each split
    shape, separator = to_arrow_schema(PIECES), grammar.separator.encode()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, pending, place, starts = None, None, [], 0, True

        def table(texts: pa.Array, first: bool, ends: bool) -> pa.RecordBatch:
            n = len(texts)
            begins = np.ones(n, bool)
            begins[:1] = first
            return pa.RecordBatch.from_arrays([
                *(pa.array([k] * n, f.type) for k, f in zip(key, shape)), pa.array(np.arange(place, place + n)),
                pa.array(begins), pa.array([ends] * n, pa.bool_()), texts], schema=shape)

        def joined(parts: list, sizes: list[int], closed: bool) -> pa.Array:
            values = pa.concat_arrays(parts)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)
            texts = pc.binary_join(lists, separator)
            if closed and grammar.closes:
                texts = pc.binary_join_element_wise(texts, pa.scalar(separator, texts.type), pa.scalar(b"", texts.type))
            return texts

        for batch in batches:
            for of, part in _runs(batch):
                if of != key:
                    if pending:
                        yield table(joined(pending, [sum(map(len, pending))], False), starts, False)
                    key, pending, place = of, [], 0
                    state = known.value.get(of)
                    if state is None:
                        yield pa.RecordBatch.from_pylist([dict(zip(KEY, of))], schema=shape)
                    else:
                        starts = not state[0] and state[1] == (grammar.base if of[1] else 0)
                if state is None:
                    continue
                after, depth = _follow(part, *state)
                state = (bool(after[-1]), int(depth[-1]))
                ends = np.flatnonzero(~after & (depth == grammar.base))
                unit = part.column(part.schema.names.index("unit"))
                if not len(ends):
                    pending.append(unit)
                    continue
                sizes = np.diff(np.r_[-1, ends]).tolist()
                sizes[0] += sum(map(len, pending))
                head = unit.slice(0, int(ends[-1]) + 1)
                yield table(joined([*pending, head], sizes, True), starts, True)
                place, starts = place + len(sizes), True
                pending = [unit.slice(int(ends[-1]) + 1)] if ends[-1] + 1 < len(unit) else []
        if pending:
            yield table(joined(pending, [sum(map(len, pending))], False), starts, False)

    return units.mapInArrow(records, PIECES)


def records(spark: SparkSession, files: str | Sequence[str], grammar: Grammar) -> DataFrame:
    """(file, first, text, ends): the records of the files as bytes; ``first`` marks the first of a file.

    ``ends`` is false for what is left behind the last record of a file.
    """
    for _ in range(ATTEMPTS):
        units = _units(spark, files, grammar)
        entries = {(r["file"], r["block"], r["length"]): (r["open"], r["depth"])
                   for r in _entries(_splits(units)).toLocalIterator()}
        path = scratch_path(spark, "records")
        _pieces(units, entries, grammar).write.parquet(path)
        staged = spark.read.schema(PIECES).parquet(path)
        if staged.where("text IS NULL").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"{files}: the files were dealt to other splits while they were read")
    first = (F.col("block") == 0) & (F.col("place") == 0)
    whole = staged.where("starts AND ends").select("file", first.alias("first"), "text", "ends")
    along = Window.partitionBy("file").orderBy("block", "place")
    fragments = staged.where("NOT (starts AND ends)").withColumn("record", F.sum(F.col("starts").cast("long")).over(along))
    gap = F.lit(grammar.separator).cast("binary")
    crossing = fragments.groupBy("file", "record").agg(
        F.bool_or(first & F.col("starts")).alias("first"), F.bool_or("ends").alias("ends"),
        F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("parts"))
    crossing = crossing.withColumn("text", F.aggregate(
        F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["text"], lambda a, p: F.concat(a, gap, p["text"])))
    return whole.unionByName(crossing.select("file", "first", "text", "ends"))


def csv_records(spark: SparkSession, files: str | Sequence[str], charset: str) -> DataFrame:
    """``record``: the text of each record of CSV files without their headers, empty lines left out."""
    text = F.col("text")
    found = records(spark, files, CSV).where(~F.col("first"))
    text = F.make_valid_utf8(text.cast("string")) if charset == "UTF-8" else F.decode(text, charset)
    return found.select(F.regexp_replace(text, "\r$", "").alias("record")).where("record <> ''")


def json_lines(spark: SparkSession, files: str | Sequence[str], array: bool) -> str:
    """Path of a table with one line for each object of files that hold an array of objects, or one object.

    What stands between objects must be a comma, and brackets around them; anything else raises ValueError.
    """
    found = records(spark, files, JSON_ARRAY if array else JSON_OBJECT).select(
        "file", "first", "ends", F.regexp_replace(F.col("text").cast("string"), "[\r\n\t]+", " ").alias("text"))
    before = F.regexp_extract("text", "^(\ufeff?[ ,\\[]*)", 1)
    if array:
        lead = F.when(F.col("first"), before.rlike("^\ufeff? *\\[ *$")).otherwise(before.rlike("^ *, *$"))
        rest = "^(\ufeff? *\\[)? *\\] *$"
    else:
        lead, rest = before.rlike("^\ufeff? *$"), "^ *$"
    path = scratch_path(spark, "objects")
    body = F.substring("text", F.length(before) + 1, F.length("text"))
    checked = F.when(F.col("ends"), lead & body.startswith("{")).otherwise(F.col("text").rlike(rest))
    found.select(F.when(F.col("ends"), body).alias("value"), (~checked).alias("wrong"), "file").write.parquet(path)
    staged = spark.read.parquet(path)
    per_file = staged.groupBy("file").agg(F.bool_or("wrong").alias("wrong"), F.bool_or(F.col("value").isNull()).alias("closed"))
    wrong = per_file.where("wrong" if not array else "wrong OR NOT closed").select("file").limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0]['file']}: not an array of objects, or an object")
    out = scratch_path(spark, "lines")
    staged.where("value IS NOT NULL").select("value").write.text(out)
    return out
