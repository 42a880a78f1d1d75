"""Write pages as WARC archives and read archives back by their boundary chain.

Writing: a record per page. Of pages with equal payloads the smallest id is a response, the others
are revisits that refer to it. The archive is Spark's text sink with the record terminator as line
separator, so it goes to any store Spark writes to, whole records per file. The largest payload bounds how many
records an archive takes, so that none outgrows ARCHIVE_BYTES but by a single record.

Reading: a payload may hold anything, also the magic of a record. Tasks take every magic of an archive
as a candidate and emit its offset and the offset of its successor, as its Content-Length says. Pointer
jumping from the start of the archive, doubling the distance in each round, marks the candidates that
the chain reaches; the others lie inside payloads and are dropped. A complete record that the chain reaches is
kept whatever follows it; ``broken_tails`` tells where a chain ends before its archive does. An archive of n candidates takes
log2(n) rounds over its offsets; an archive is the unit of a task (Spark's binary reader holds at most
2 GB), and archives are many.

Only digests are grouped; a page joins its revisit entry by id and digest, a unique key, so copies of
one payload never meet in one task. The entries are broadcast only while they are few.

Defined cases: null html counts as empty and is a payload like any other; a null url is left out;
control characters and blanks in urls are percent-encoded; rows that repeat id and payload are written
alike; a null id is written as none and read back as null, smallest ids rank nulls last; an
empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from winnow.llm.common import Scratch, same, small, text_of

END = "\r\n\r\n"
RECORDS_PER_ARCHIVE = 20_000
ARCHIVE_BYTES = 512 << 20
HEADER_BYTES = 4096                     # allowed for what stands before a payload
DATE = "1970-01-01T00:00:00Z"           # pages carry no date; a caller who knows one passes it
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
URN = "urn:x-page:"
RECORD = ("archive string, offset long, next long, size long, record_type string, page_id long, url string, "
          "payload_bytes long, payload_digest string, refers_to long")


@F.pandas_udf(T.StringType())
def _base32(hexes: pd.Series) -> pd.Series:
    return hexes.map(lambda h: None if h is None else base64.b32encode(bytes.fromhex(h)).decode())


def _records(pages: DataFrame, scratch: Scratch, least_bytes: int, date: str) -> DataFrame:
    html = F.col("__html")
    pages = pages.withColumn("__sha1", F.sha1(F.encode(html, "UTF-8")))
    keys = scratch.write(pages.select(F.col("__id").alias("id"), F.col("__sha1").alias("sha1"),
                                      F.octet_length(html).alias("size")).where(f"size >= {int(least_bytes)}"), "keys")
    firsts = (keys.groupBy("sha1", "size").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 AND first IS NOT NULL"))
    revisits = scratch.write(
        keys.join(scratch.write(firsts, "firsts"), ["sha1", "size"]).where("NOT id <=> first")
        .select(F.col("id").alias("__rid"), F.col("sha1").alias("__rsha1"), F.col("first").alias("__first")).distinct(),
        "revisits")
    revisits = small(revisits)
    both = pages.join(revisits, same(pages, revisits, [("__id", "__rid"), ("__sha1", "__rsha1")]), "left")
    revisit = F.col("__first").isNotNull()
    size = F.octet_length(html)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit(END))
    # Percent signs stay as they are: urls are encoded already but for stray characters.
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("__url"), "[\\r\\n]", "%0A"), "\\t", "%09"), " ", "%20")

    def header(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(c):
        return F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))

    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, html))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", urn(F.col("__id"))), header("WARC-Date", F.lit(date)),
        F.coalesce(header("WARC-Target-URI", url), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__digest"))),
        header("X-Payload-Length", size.cast("string")),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit(PROFILE)), header("WARC-Refers-To", urn(F.col("__first")))))
        .otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http; msgtype=response")))
    return both.withColumn("__digest", _base32("__sha1")).select(F.concat(
        head, header("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block).alias("value"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0, date: str = DATE) -> None:
    """Write the pages as archives under ``path``. Payloads below ``least_bytes`` are all responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(url).cast("string").alias("__url"),
                        text_of(html).alias("__html"))
    scratch = Scratch(pages.sparkSession, "warc")
    records = _records(rows, scratch, least_bytes, date)
    largest = pages.sparkSession.read.parquet(scratch.path("keys")).agg(F.max("size")).head()[0] or 0
    per_archive = max(1, min(RECORDS_PER_ARCHIVE, ARCHIVE_BYTES // (max(largest, least_bytes) + HEADER_BYTES)))
    records.write.option("lineSep", END).option("maxRecordsPerFile", per_archive).text(path)
    scratch.drop("keys", "firsts", "revisits")


def _number(value: bytes | None) -> int | None:
    found = re.fullmatch(rb"<?(?:" + URN.encode() + rb")?(-?\d+)>?", value or b"")
    return int(found[1]) if found else None


def _parsed(content: bytes, at: int) -> dict | None:
    """The record that a magic at ``at`` would start, without its payload; None if it cannot be one."""
    end = content.find(END.encode(), at)
    if end < 0:
        return None
    fields = {}
    for line in content[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        return None
    start = end + len(END)
    following = start + int(length) + len(END)
    if following > len(content) or content[following - len(END):following] != END.encode():
        return None
    return {"fields": fields, "start": start, "end": start + int(length), "next": following}


def _payload(content: bytes, record: dict) -> tuple[int | None, str | None]:
    """Size and digest of the full payload; a revisit carries them as fields."""
    fields = record["fields"]
    if fields.get(b"warc-type") == b"revisit":
        return _number(fields.get(b"x-payload-length")), fields.get(b"warc-payload-digest", b"").decode()[5:]
    start = record["start"]
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        body = content.find(END.encode(), start, record["end"])
        start = record["end"] if body < 0 else body + len(END)
    payload = memoryview(content)[start:record["end"]]
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every magic of every archive as a row: its offset, its successor's, and its fields."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            content, rows, found = bytes(content), [], {}
            for magic in MAGIC.finditer(content):
                record = _parsed(content, magic.start())
                if record:
                    found[magic.start()] = record
            for at, record in found.items():
                f, (size, digest) = record["fields"], _payload(content, record)
                rows.append((path, at, record["next"], len(content), f.get(b"warc-type", b"").decode("utf-8", "replace"),
                             _number(f.get(b"warc-record-id")), f.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
                             size, digest, _number(f.get(b"warc-refers-to"))))
                if len(rows) == 5000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
    return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "offset", "next", "size")})


def reached(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which offsets the chain from offset 0 reaches, by pointer jumping."""
    n = len(offsets)
    order = np.argsort(offsets, kind="stable")
    place = np.searchsorted(offsets[order], successors)
    hit = (place < n) & (offsets[order][np.minimum(place, n - 1)] == successors)
    jump = np.full(n + 1, n)                        # n stands for the end
    jump[order] = np.where(hit, order[np.minimum(place, n - 1)], n)[order]
    marked = np.zeros(n + 1, bool)
    marked[:n] = offsets == 0
    while True:
        more = marked.copy()
        more[jump[np.flatnonzero(marked)]] = True
        jump = jump[jump]
        more[n] = marked[n] = False
        if (more == marked).all() and (jump == n).all():
            return marked[:n]
        marked = more


def _chain(candidates: pd.DataFrame) -> pd.DataFrame:
    keep = reached(candidates["offset"].to_numpy(np.int64), candidates["next"].to_numpy(np.int64))
    return candidates[keep]


def broken_tails(records: DataFrame) -> DataFrame:
    """(archive, end, size): archives whose last record ends before they do; what follows could not be read."""
    return records.groupBy("archive").agg(F.max("next").alias("end"), F.first("size").alias("size")).where("end < size")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``, whatever their names."""
    archives = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return archives.mapInPandas(_candidates, RECORD).groupBy("archive").applyInPandas(_chain, RECORD)


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages to the shared folder and read them back: one row per record."""
    path = Scratch(pages.sparkSession, "warc").path("archives")
    write(pages, path, id_col, url, html)
    return read(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                                 "url")
