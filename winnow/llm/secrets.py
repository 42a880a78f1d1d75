"""Secret scan with corpus-wide ownership frequency.

Spans of the base kinds come from one pattern each. Positions need no UDF: the pieces between the
matches (a split on the same pattern) and the matches themselves add up to the offsets. Further
candidates are long tokens of mixed letters and digits outside the base spans. Every candidate value
is hashed and its distinct repositories and owners are counted over the whole corpus. A value is copied, a
published example or shared boilerplate, where COMMON_OWNERS owners hold it, or where its owners hold it in
COMMON_REPOSITORIES repositories each on average: a key of one owner is found in a few places of theirs, an example
in many, also within one hot source. All other values look live. Live-looking candidates are added to the
base spans; base spans always stay.

Counting goes in steps that fold map-side, (value, owner, repository), then (value, owner), then
value, so a value copied into a third of all documents never meets in one task. Texts are read once
and never shuffled; spans come back to their row by a row number that is written down once.

Defined cases: null or empty text has no spans; null owners or repositories count as one owner or
repository; repeated rows are scanned one by one and share an owner; an empty table gives an empty
result; other columns are ignored. Whole texts are scanned, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.common import Scratch, bind, text_of

# The base kinds. `test` drops failing matches, which are consumed all the same.
KINDS = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "access": ("AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": ("[0-9a-f]{16,}", 0, 16),
}
KIND_ORDER = list(KINDS) + ["generic"]
GENERIC = "[A-Za-z0-9_-]{20,}"         # further candidates; shape tests follow
COMMON_OWNERS = 3                       # a value that so many owners hold is an example
COMMON_REPOSITORIES = 10                # and so is one in so many repositories per owner
SPAN = "array<struct<kind:string,rank:int,start:int,end:int,value:string>>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of one kind as spans in code points."""
    rank = KIND_ORDER.index(kind)

    def placed(found: Column) -> Column:
        # Length up to a match: pieces and matches before it, plus the piece at its own index.
        steps = F.aggregate(
            found["hits"],
            F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("starts")),
            lambda acc, hit: F.struct(
                (acc["at"] + F.length(F.get(found["gaps"], acc["i"])) + F.length(hit)).alias("at"),
                (acc["i"] + 1).alias("i"),
                F.concat(acc["starts"], F.array(acc["at"] + F.length(F.get(found["gaps"], acc["i"])))).alias("starts")))
        spans = bind(steps, lambda s: F.transform(found["hits"], lambda hit, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.get(s["starts"], i).alias("start"),
            (F.get(s["starts"], i) + F.length(hit)).alias("end"), F.get(found["values"], i).alias("value"))))
        return F.filter(spans, lambda x: F.length(x["value"]) >= least)

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
                     F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), bind(found, placed)).otherwise(F.array().cast(SPAN))


def _mixed(value: Column) -> Column:
    """Shape of a random token: capitals, small letters and digits, or many digits."""
    return (value.rlike("[0-9].*[0-9].*[0-9]") & value.rlike("[A-Z].*[A-Z]") & value.rlike("[a-z].*[a-z]"))


def _generic(text: Column, base: Column) -> Column:
    spans = _spans(text, "generic", GENERIC, 0, 20)
    return bind(spans, lambda s: F.filter(s, lambda x: _mixed(x["value"]) & ~F.exists(
        base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))


def in_order(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
         repository: str = "doc_id") -> DataFrame:
    """One row per input row: row, doc_id, owner, repository, base spans and further candidates."""
    t = text_of(text)
    base = F.concat(*[_spans(t, kind, *rule) for kind, rule in KINDS.items()])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner).cast("string").alias("owner"),
                       F.col(repository).cast("string").alias("repository"), t.alias("__text"), base.alias("base"))
    found = rows.select("doc_id", "owner", "repository", "base", _generic(F.col("__text"), F.col("base")).alias("more"))
    return Scratch(docs.sparkSession, "secrets").write(
        found.select(F.monotonically_increasing_id().alias("row"), "*"), "scanned")


def ownership(scanned: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate value, by its hash."""
    return (_candidates(scanned).groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
            .groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
            .groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
                                       F.sum("n").alias("occurrences")))


def _candidates(scanned: DataFrame) -> DataFrame:
    return (scanned.select("row", "owner", "repository", F.explode(F.concat("base", "more")).alias("span"))
            .select("row", "owner", "repository", "span", F.sha2(F.encode("span.value", "UTF-8"), 256).alias("value_hash")))


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
            repository: str = "doc_id") -> DataFrame:
    """One row per input row: id, base spans, added spans, and how many base spans look live or copied."""
    scanned = scan(docs, id_col, text, owner, repository)
    scratch = Scratch(docs.sparkSession, "secrets")
    counted = scratch.write(ownership(scanned), "ownership")
    live = (F.col("owners") < COMMON_OWNERS) & (F.col("repositories") < COMMON_REPOSITORIES * F.col("owners"))
    is_base = F.col("span.kind") != "generic"
    per_row = (_candidates(scanned).join(counted, "value_hash").groupBy("row").agg(
        F.collect_list(F.when(~is_base & live, F.col("span"))).alias("added"),
        F.sum((is_base & live).cast("long")).alias("n_live"), F.sum((is_base & ~live).cast("long")).alias("n_copied")))
    none = F.array().cast(SPAN)
    return (scanned.join(per_row, "row", "left")
            .select("doc_id", "base", F.coalesce("added", none).alias("added"),
                    F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
                    F.coalesce("n_copied", F.lit(0).cast("long")).alias("n_copied")))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.encode(in_order(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        in_order(F.concat("base", "added")).alias("spans"), "n_live", "n_copied",
        F.size("added").cast("long").alias("n_added"))
