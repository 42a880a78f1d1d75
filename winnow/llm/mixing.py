"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, up to MAX_REPEATS times over. A copy's
virtual finish time is the source's cumulative tokens through it, divided by the source's target.
The mix is the copies in order of virtual time, cut at the total budget. Targets add up to the
budget, so the cut lies at virtual time 1; the copy that straddles it is taken when at least half
of it lies before, which keeps each source within half a document of its target.

Targets: weights share the budget; no source exceeds MAX_REPEATS times its size, the excess is
shared again by weight until none is above.

The running sums are taken inside buckets of the shuffled order and lifted by the sums of the
buckets before, so a source with a third of all rows is spread over many tasks. Sources are ranked
and shared out as a distributed table; only single numbers reach the driver.

Defined cases: a null source is a source, ranked last; null or wordless text has size 0 and is
never taken (0 words); rows that repeat an id are shuffled by id, then size, and equal ones are
interchangeable; an empty table gives an empty mix; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.llm.common import WORD, Scratch, same, small, text_of

MAX_REPEATS = 3
SEED = 17
BUCKET_ROWS = 20_000        # rows of a source that one running sum is meant to hold


def cycling_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating, by rank from 0."""
    return (F.pmod(rank, F.lit(3)) + 1).cast("double")


def source_targets(sizes: DataFrame, weight=cycling_weight) -> DataFrame:
    """One row per source: source, source_size, weight, target, from rows (source, size)."""
    spark = sizes.sparkSession
    scratch = Scratch(spark, "mix")
    per_source = scratch.write(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "sources")
    ranked = (per_source.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
              .map(lambda pair: (pair[0][0], pair[0][1], pair[1])))
    schema = "source string, source_size long, rank long"
    table = scratch.write(spark.createDataFrame(ranked, schema).select(
        "source", "source_size", weight(F.col("rank")).alias("weight")), "weights")
    total = table.agg(F.sum("source_size")).head()[0] or 0
    most = MAX_REPEATS * F.col("source_size")
    # Raise the level until no more sources hit their limit; it can only rise, so this ends.
    level, capped = 0.0, -1
    while True:
        full = most <= F.lit(level) * F.col("weight")
        now = table.agg(F.sum(F.when(full, most)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("open"),
                        F.sum(full.cast("long")).alias("n")).head()
        if (now["n"] or 0) == capped or not now["open"]:
            break
        capped, level = now["n"] or 0, (total - (now["full"] or 0)) / now["open"]
    target = F.least(most.cast("double"), F.lit(float(level)) * F.col("weight"))
    return table.select("source", "source_size", "weight",
                        F.when(F.col("source_size") == 0, 0.0).otherwise(target).alias("target"))


def queue(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
          weight=cycling_weight) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, ``before`` (tokens of its source
    ahead of it in one pass) and ``copies`` (how often the mix takes it)."""
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.write(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), F.col(id_col)).alias("shuffled")), "sized")
    targets = scratch.write(source_targets(sized, weight), "targets")
    rows = sized.count()
    bits = max(0, (rows // BUCKET_ROWS).bit_length())
    bucketed = sized.withColumn("bucket", F.shiftright("shuffled", 64 - bits) if bits else F.lit(0).cast("long"))
    starts = scratch.write(
        bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
        .withColumn("start", F.sum("held").over(Window.partitionBy("source").orderBy("bucket")) - F.col("held"))
        .select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"), "start"), "starts")
    inside = Window.partitionBy("source", "bucket").orderBy("shuffled", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = bucketed.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    starts = small(starts)
    placed = summed.join(starts, same(summed, starts, [("source", "__source"), ("bucket", "__bucket")]))
    targets = small(targets.withColumnRenamed("source", "__of"))
    placed = placed.join(targets, placed["source"].eqNullSafe(targets["__of"]))
    before = F.col("start") + F.col("inside")
    # Copy k (from 0) straddles or precedes the cut if its middle does.
    room = (F.col("target") - before - F.col("size") / 2) / F.greatest(F.col("source_size"), F.lit(1))
    copies = F.when(F.col("size") == 0, 0).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(MAX_REPEATS), F.floor(room) + 1)))
    return placed.select("doc_id", "source", "size", "source_size", "target", before.alias("before"),
                         copies.cast("int").alias("copies"), "shuffled")


def schedule(queued: DataFrame) -> DataFrame:
    """The mix itself: one row per taken copy, range-sorted by virtual finish time."""
    copies = queued.where("copies > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("pass"))
    finish = (F.col("pass") * F.col("source_size") + F.col("before") + F.col("size")) / F.col("target")
    return copies.withColumn("finish", finish).orderBy("finish", "source", "doc_id")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weight=cycling_weight) -> DataFrame:
    """The documents of the mix with all their columns, a row per copy, in order of virtual time.

    Documents are joined with how often they are taken; whole texts are repeated, never cut.
    """
    taken = Scratch(docs.sparkSession, "mix").write(
        queue(docs, id_col, text, source, weight).where("copies > 0")
        # Equal ids with equal size and source are interchangeable: their copies are spread evenly below.
        .groupBy("doc_id", "source", "size", "source_size", "target")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"), F.min("before").alias("before"))
        .select(*[F.col(c).alias(f"__{c}") for c in
                  ("doc_id", "source", "size", "source_size", "target", "copies", "before")]), "taken")
    sized = docs.withColumn("__words", F.regexp_count(text_of(text), F.lit(WORD)).cast("long"))
    few = small(taken)
    both = sized.join(few, (F.col(id_col).eqNullSafe(F.col("__doc_id"))) & (F.col("__words") == F.col("__size"))
                      & F.col(source).cast("string").eqNullSafe(F.col("__source")))
    copies = both.select("*", F.explode(F.sequence(F.lit(0), (F.col("__copies") - 1).cast("int"))).alias("__pass"))
    finish = (F.col("__pass") * F.col("__source_size") + F.col("__before") + F.col("__size")) / F.col("__target")
    return (copies.withColumn("__finish", finish).orderBy("__finish", "__source", "__doc_id")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
