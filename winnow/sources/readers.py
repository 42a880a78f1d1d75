"""Tables from files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from winnow.functions.columns import FLOATING, col, columns_of, present
from winnow.functions.numbers import text_number
from winnow.operators.cut import first_rows
from winnow.sources import ranges

# Text that stands for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
BOOLEANS = ["True", "TRUE", "true", "False", "FALSE", "false"]
FALLBACK_ENCODING = "ISO-8859-1"
CORRUPT = "~corrupt"
MAX_LAYOUTS = 100       # files of one folder that differ more than this are not one table


def normalize_na(df: DataFrame, tokens: Sequence[str] = tuple(NA_TOKENS)) -> DataFrame:
    """Missing-value tokens in text, and NaN in numbers, to null."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(~col(f.name).isin(*tokens), col(f.name)).alias(f.name))
        elif isinstance(f.dataType, FLOATING):
            out.append(present(df, f.name).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


# Each type with the test its values pass and the form they take, narrowest first.
def _as_whole(c: Column) -> Column:
    return F.trim(c).try_cast("bigint")


def _as_boolean(c: Column) -> Column:
    return F.when(c.isin(*BOOLEANS), F.lower(c) == "true")


TYPE_TESTS = {"whole": _as_whole, "real": text_number, "boolean": _as_boolean}
TYPE_SAMPLE = 1000    # rows that rule types out before the whole table is tested


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns to bigint, double or boolean where every value allows; one scan.

    Runs after missing-value tokens are nulled, so a column of numbers with ``NA`` in it
    is still a column of numbers. Dates stay text until types are enforced.
    """
    return _infer(df, columns_of(df, "categorical"))[0]


def _first_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A few short values, fetched as a limit does: one that fails a test settles the
    matter without a scan of the table."""
    short = [F.when(F.length(col(c)) <= 64, col(c)).alias(c) for c in names]
    rows = df.select(*short).limit(TYPE_SAMPLE).collect()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return df.sparkSession.createDataFrame(rows, schema)


def _infer(df: DataFrame, names: Sequence[str], more: Sequence[Column] = ()) -> tuple[DataFrame, T.Row | None]:
    """The typed table, and the row of the scan that settled the types, with ``more`` aggregates in it."""
    if not names:
        return df, None
    open_types = {c: list(TYPE_TESTS) for c in names}
    for rows, extra in ((_first_rows(df, names), ()), (df, more)):
        tests = [F.count(col(c)).alias(f"n{i}") for i, c in enumerate(names)]
        tests += [F.count(TYPE_TESTS[t](col(c))).alias(f"{t}{i}")
                  for i, c in enumerate(names) for t in open_types[c]]
        row = rows.agg(*tests, *extra).first()
        for i, c in enumerate(names):
            open_types[c] = [t for t in open_types[c] if row[f"{t}{i}"] == row[f"n{i}"]]
    casts = {c: TYPE_TESTS[open_types[c][0]](col(c)) for i, c in enumerate(names)
             if open_types[c] and row[f"n{i}"]}
    return (df.withColumns(casts) if casts else df), row


def _layouts(spark: SparkSession, path: str, line: Column, facts: dict[str, Column]) -> list[tuple[dict, str | list[str]]]:
    """What holds for which files of a path: facts of each file's lines, and the files of equal facts.

    ``line`` picks the lines that count; in ``facts``, columns of ``value`` are aggregates and ``head`` is the first
    line of the file. One scan of the lines; usually all files agree and stay one path.
    """
    lines = spark.read.text(path).where(line).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"))
    per_file = lines.groupBy("file").agg(
        F.min_by("value", "place").alias("head"), *[f.alias(k) for k, f in facts.items() if k != "head"])
    if "head" in facts:
        per_file = per_file.withColumn("head", facts["head"])
    groups = per_file.groupBy(*facts).agg(F.collect_list("file").alias("files"))
    found = groups.limit(MAX_LAYOUTS + 1).collect()         # the driver lists the files of a path in any case
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"{path}: more than {MAX_LAYOUTS} different layouts in one folder")
    out = [({k: g[k] for k in facts}, sorted(map(unquote, g["files"]))) for g in found]
    return out if len(out) > 1 else [(facts, path) for facts, _ in out]


def read_csv(
    spark: SparkSession, path: str, encoding: str | None = None, schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header. Types are inferred unless ``schema`` is given.

    A scan of the lines decides for each file: Latin-1 where some line is not valid UTF-8, unless
    ``encoding`` is given; line breaks inside quotes where some line has an odd number of quotes, unless
    ``multi_line`` is given; and its header, so that files are put together by column names. Giving both skips
    that scan; files must then share one header.

    Files with line breaks inside quotes are read by all their splits: their records are written to the shared
    scratch folder first (see ``ranges``). Only where a character has more than one byte for a line break or a
    quote (UTF-16, UTF-32) is such a file read by one task.

    Short rows end in nulls. Rows with more fields than the header raise an error while types are inferred.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    facts = {"latin": F.bool_or(F.lit(False) if encoding else ~F.is_valid_utf8("value")),
             "broken": F.bool_or(F.lit(multi_line) if multi_line is not None else quotes % 2 == 1),
             "head": F.col("head")}
    layouts = [({"latin": False, "broken": bool(multi_line)}, path)]
    if encoding is None or multi_line is None:
        layouts = _layouts(spark, path, F.lit(True), facts) or layouts

    plain_options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                     "columnNameOfCorruptRecord": CORRUPT}

    def charset(layout: dict) -> str:
        return (encoding or (FALLBACK_ENCODING if layout["latin"] else "UTF-8")).upper().replace("LATIN-1", FALLBACK_ENCODING)

    def reader(layout: dict):
        return spark.read.options(header=True, encoding=charset(layout), multiLine=layout["broken"], **plain_options)

    staged = {}

    def rows(i: int, wanted: T.StructType | str | None) -> DataFrame:
        """The rows of a layout as ``wanted``; None: the columns of the header as text."""
        layout, files = layouts[i]
        if not layout["broken"] or charset(layout) not in ranges.SPLITTABLE:
            return (reader(layout) if wanted is None else reader(layout).schema(wanted)).csv(files)
        if i not in staged:
            staged[i] = ranges.csv_records(spark, files, charset(layout))
        if wanted is None:
            wanted = T.StructType([T.StructField(c, T.StringType()) for c in reader(layout).csv(files).columns])
        shape = wanted if isinstance(wanted, str) else ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in wanted)
        parsed = F.from_csv("record", shape, plain_options | {"multiLine": "true"})
        return staged[i].select(parsed.alias("row")).select("row.*")

    if schema is not None:
        return normalize_na(reduce(DataFrame.unionByName, [rows(i, schema) for i in range(len(layouts))]))

    parts = [rows(i, None) for i in range(len(layouts))]
    names = parts[0].columns
    if not names:
        return parts[0]
    checked = []
    for i, part in enumerate(parts):       # the same rows, each with its line where it is ragged
        line = rows(i, T.StructType([T.StructField(c, T.StringType()) for c in (*part.columns, CORRUPT)]))
        width = len(part.columns)
        one_more = ", ".join(f"c{i} string" for i in range(width + 1))
        beyond = F.from_csv(F.col(f"`{CORRUPT}`"), one_more, {"quote": '"', "escape": '"'})[f"c{width}"]
        checked.append(line.withColumn(CORRUPT, F.when(F.col(f"`{CORRUPT}`").isNotNull(), beyond)))
    both = normalize_na(reduce(DataFrame.unionByName, checked))
    typed, row = _infer(both, names, [F.count(F.col(f"`{CORRUPT}`")).alias("ragged")])
    if row["ragged"]:
        raise ValueError(f"{path}: {row['ragged']} rows have more fields than the header")
    plain = normalize_na(reduce(DataFrame.unionByName, parts))
    types = dict(typed.dtypes)
    tests = {"bigint": _as_whole, "double": text_number, "boolean": _as_boolean}
    casts = {c: tests[types[c]](col(c)) for c in names if types[c] in tests}
    return plain.withColumns(casts) if casts else plain


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON records: an array or one record per file, or one record per line; each file of a folder by itself.

    A file holds a record per line when its first line is a whole object. Other files are cut into their
    objects by all their splits, and the objects written to the shared scratch folder, a line each (see
    ``ranges``); only files in UTF-16 or UTF-32 are read by one task. Records that do not parse raise an error
    when they are read, and text between objects that is no comma when the file is cut.
    """
    head = F.regexp_replace("head", "^\ufeff", "")
    kind = (F.when(head.rlike(r"^\s*\{") & F.get_json_object(head, "$").isNotNull(), "lines")
            .when(~F.is_valid_utf8("head") | F.contains("head", F.lit("\x00")), "wide")
            .when(head.rlike(r"^\s*\["), "array").otherwise("object"))
    layouts = _layouts(spark, path, F.expr("trim(value) <> ''"), {"head": kind}) or [({"head": "lines"}, path)]

    def table(kind: str, files) -> DataFrame:
        if kind in ("array", "object"):
            files = ranges.json_lines(spark, files, kind == "array")
        reader = spark.read.options(multiLine=kind == "wide", mode="FAILFAST")
        return (reader if schema is None else reader.schema(schema)).json(files)

    parts = [table(layout["head"], files) for layout, files in layouts]
    return normalize_na(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), ())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return normalize_na(df, ()) if any(isinstance(f.dataType, FLOATING) for f in df.schema) else df


READERS = {".csv": read_csv, ".json": read_json, ".parquet": read_parquet}


def load(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read by extension: .csv, .json or .parquet, with the options of that reader."""
    for extension, read in READERS.items():
        if path.rstrip("/").endswith(extension):
            return read(spark, path, **options)
    raise ValueError(f"Unsupported file format: {path}")


def read_capped(spark: SparkSession, path: str, chunk_size: int = 10_000, max_chunks: int | None = None,
                order_by: str | None = None, **options) -> DataFrame:
    """A CSV file up to ``chunk_size * max_chunks`` rows; whole when ``max_chunks`` is None.

    Splits already read in pieces, so only the row cap is left of chunked loading. With
    ``order_by`` the capped rows are the first in that order, ties by a digest of the row; without it
    they are those with the smallest digests, the same rows on every run.
    """
    if not path.rstrip("/").endswith(".csv"):
        raise ValueError("Chunked reading only supports CSV files")
    df = read_csv(spark, path, **options)
    if max_chunks is None:
        return df
    return first_rows(df, chunk_size * max_chunks, order_by)
