"""Exact duplicates: a 128-bit content hash groups, bytes inside groups are compared.

One scan reduces every row to its digests. Groups fold map-side, so a text that fills a third of
the table is one row per task. Only texts whose hash occurs twice are read again and compared
byte for byte, as grouping keys, so no group is ever gathered and no pairs are formed.

Defined cases: a null text counts as empty, all empty texts are one group; ties in length go to
the smallest id, null ids last; rows that repeat id and text are one group of which one row stays;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from winnow.llm.common import BROADCAST_ROWS, SPACE, Scratch, same, text_of


def normalised(text: str = "text"):
    """The text without white space."""
    return F.regexp_replace(text_of(text), SPACE + "+", "")


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns({"__norm": normalised(text)}).withColumn("__hash", F.md5(F.encode("__norm", "UTF-8")))


def _check_bytes(docs: DataFrame, keys: DataFrame, text: str) -> None:
    """Compare the bytes of all texts whose hash is shared; raise if equal digests hide different bytes."""
    shared = keys.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("hash").alias("__hash"))
    members = _hashed(docs.select(F.col(text).alias("text")), "text").select("__hash", "__norm")
    if shared.count() <= BROADCAST_ROWS:
        members = members.join(F.broadcast(shared), "__hash", "left_semi")
    variants = members.groupBy("__hash", "__norm").agg(F.count("*").alias("n"))
    clashes = (variants.groupBy("__hash", F.sha2(F.encode("__norm", "UTF-8"), 256).alias("sha"))
               .agg(F.count("*").alias("n")).where("n > 1"))
    if clashes.limit(1).count():
        raise ValueError("different texts share an MD5 and a SHA-256 digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, chars, hash, keep_id, group_size, kept, text_sha256.

    The row with the most code points, then the smallest id, stays. Groups are told by the 128-bit
    hash together with the SHA-256 digest, which separates texts of a hash whose bytes differ.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    keys = scratch.write(
        _hashed(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text")
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", F.length(text_of("text")).alias("chars"),
                F.col("__hash").alias("hash"), F.sha2(F.encode("__norm", "UTF-8"), 256).alias("text_sha256")), "keys")
    _check_bytes(docs, keys, text)
    order = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = (keys.groupBy("hash", "text_sha256")
              .agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
              .select("hash", "text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"),
                      F.col("best.row").alias("keep_row")))
    return (keys.join(groups, ["hash", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    "text_sha256", "hash", "chars"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows go by an anti join on (id, hash, length), so only decisions are shuffled or broadcast where
    they are few. Rows that repeat all three are folded in the one case where they occur.
    """
    decided = Scratch(docs.sparkSession, "exact").write(
        exact_groups(docs, id_col, text).select("doc_id", "hash", "chars", "kept"), "decided")
    key = ["doc_id", "hash", "chars"]
    per_key = decided.groupBy(*key).agg(F.count("*").alias("n"), F.max("kept").alias("any_kept"))
    gone = per_key.where("NOT any_kept").select(*[F.col(c).alias(f"__gone_{c}") for c in key])
    repeats = per_key.where("any_kept AND n > 1").limit(1).count() > 0
    columns = docs.columns
    keyed = _hashed(docs, text).withColumn("__chars", F.length(text_of(text))).drop("__norm")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    left = keyed.join(gone, same(keyed, gone, [(id_col, "__gone_doc_id"), ("__hash", "__gone_hash"),
                                               ("__chars", "__gone_chars")]), "left_anti")
    if repeats:
        left = left.dropDuplicates([id_col, "__hash", "__chars"])
    return left.select(*[F.col(f"`{c}`") for c in columns])
