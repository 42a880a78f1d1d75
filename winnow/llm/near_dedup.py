"""Near duplicates: fast similarity sketches, banding, exact verification, components.

A document is the set of its 5-word shingles. Its sketch has SIZE coordinates, filled in rounds: in
round i every shingle is hashed to one coordinate with the value i plus a fraction, and coordinates
keep their minimum; from round SIZE on every shingle goes to coordinate i - SIZE, so that 2 * SIZE
rounds fill all. Rounds stop when all are filled, a few for most documents, and coordinates agree
with the probability of the Jaccard similarity, with the concentration of independent minima.

Documents with equal sets are one class and stand for each other through their smallest id. Classes
meet where a band of ROWS coordinates agrees: at a similarity of 0.75 a pair shares none of the 32
bands with probability 5e-6. Candidates are then verified on full sets, without forming all pairs of
a large bucket:

1. Each class is compared with one hub, a central class of a bucket, the one it shares most bands with. In
   a group of near copies this settles nearly all in one comparison each.
2. Classes already connected need no further comparison. Only buckets whose classes lie in several
   components go on: the members outside the largest component are compared with all members, in blocks of
   sets, so that rows are pairs of blocks, not of documents. This settles every pair that could still link.

Nothing is capped: each pair of a bucket is connected or compared in the end. Texts are read again
only for classes that have candidates. Ids reach executors by broadcast only while they are few.

Defined cases: null, empty or wordless text has an empty set and links with nothing; fewer than five
words form one shingle; repeated rows and exact copies are one class; equal ids share a component;
a null id is its own component and is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.common import BROADCAST_ROWS, Scratch, same
from winnow.llm.components import components
from winnow.llm.hashing import constants, mixed, word_hashes, words

SHINGLE = 5
SIZE, ROWS = 128, 4
BANDS = SIZE // ROWS
PERCENT = 75
BLOCK = 64                  # sets that are compared with as many others at a time
_STEPS = constants("word", SHINGLE)
_ROUNDS = constants("round", 2 * SIZE)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. Only A-Z are lower-cased."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed=1)], np.uint64)
    hashed, n = word_hashes(found), len(found) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total = mixed(total + hashed[i:n + i] * _STEPS[i])
    return np.unique(total)


def sketch(items: np.ndarray) -> np.ndarray:
    """SIZE coordinates of a non-empty set."""
    low = np.uint64((1 << 56) - 1)
    best = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 512 // len(items))            # small sets take several rounds at once
    for first in range(0, 2 * SIZE, step):
        rounds = np.arange(first, min(first + step, 2 * SIZE))
        hashed = mixed(items[None, :] ^ _ROUNDS[rounds][:, None])
        value = (hashed & low) | (rounds.astype(np.uint64) << np.uint64(56))[:, None]
        place = np.where(rounds[:, None] < SIZE, (hashed >> np.uint64(57)).astype(np.int64),
                         (rounds - SIZE)[:, None])
        np.minimum.at(best, place.ravel(), value.ravel())
        if best.max() != np.iinfo(np.uint64).max:
            break
    return best


def bands(items: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = sketch(items).reshape(BANDS, ROWS)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        key = mixed(key + parts[:, i] * _STEPS[i])
    return key.view(np.int64)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, text in zip(batch["doc_id"], batch["text"]):
            items = shingles(text)
            rows.append((key, len(items), hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None,
                         bands(items) if len(items) else None))
        out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "class", "bands"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs with both texts to the pairs whose sets are similar enough."""
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        keep = []
        for a, b, one, two in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            hub = seen.get(b)
            if hub is None:                     # rows of a hub follow each other
                seen = {b: (hub := shingles(two))}
            mine = shingles(one)
            both = len(np.intersect1d(mine, hub, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(mine) + len(hub) - both))
        yield batch.loc[keep, ["a", "b"]] if keep else batch[["a", "b"]]


def _texts(docs: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """One text per wanted id; ids are broadcast only while they are few."""
    ids = scratch.write(ids.distinct(), f"ids-{uuid.uuid4().hex[:8]}")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def _verify(docs: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose full sets are similar enough. Sizes that rule a pair out spare its texts."""
    pairs = scratch.write(pairs.where(
        100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")).select("a", "b").distinct(), "pairs")
    both_ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    texts = scratch.write(_texts(docs, both_ends, scratch), "texts")
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    found = scratch.write(both.mapInPandas(_verified, "a long, b long"), "links")
    scratch.drop("texts")
    return found


def _block(column: str, members: Column) -> Column:
    """A block of about BLOCK of so many members, by hash."""
    return F.pmod(F.xxhash64(column), F.ceil(members / BLOCK).cast("long"))


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"rep": batch["doc_id"], "items": [shingles(t).tobytes() for t in batch["text"]]})


def _compared(rows) -> Iterator[tuple[int, int]]:
    """Links between two blocks of sets, those that connect what is not connected in the two blocks yet."""
    for mine, others in rows:
        theirs = [np.frombuffer(o["items"], np.uint64) for o in others]
        sizes = np.array([len(t) for t in theirs])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        joined = np.concatenate(theirs)
        label = {m["component"]: m["component"] for m in (*mine, *others)}

        def root(c: int) -> int:
            while label[c] != c:
                c = label[c]
            return c

        for one in mine:
            items = np.frombuffer(one["items"], np.uint64)
            place = np.minimum(np.searchsorted(items, joined), len(items) - 1)
            both = np.add.reduceat(items[place] == joined, starts, dtype=np.int64)
            for i in np.flatnonzero(100 * both >= PERCENT * (len(items) + sizes - both)):
                a, b = root(one["component"]), root(others[i]["component"])
                if a != b:
                    label[a] = b
                    yield max(one["rep"], others[i]["rep"]), min(one["rep"], others[i]["rep"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, and class_id (smallest id of equal sets)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = scratch.write(rows.mapInPandas(
        _signed, "doc_id long, n_shingles long, class binary, bands array<long>"), "signed")
    # Ids may repeat: all sets of an id are connected through it, as nodes are ids.
    classes = scratch.write(
        signed.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")), "classes")
    members = classes.select("rep", "n", F.posexplode("bands").alias("band", "key")).select("key", "rep", "n")
    shared = scratch.write(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    buckets = scratch.write(members.join(shared, "key"), "buckets")
    scratch.drop("shared")

    # 1. One hub per class. The hub of a bucket is its most central member, the one that meets most
    # others over all buckets; a class takes the hub it shares most buckets with.
    degrees = buckets.groupBy("rep").agg(F.sum("size").alias("degree"))
    hubs = buckets.select("key", "rep", "n").join(degrees, "rep").groupBy("key").agg(
        F.max(F.struct(F.col("degree"), (-F.col("rep")).alias("minus"), F.col("n"))).alias("h"))
    hubs = scratch.write(hubs.select("key", (-F.col("h.minus")).alias("hub"), F.col("h.n").alias("n_hub")), "hubs")
    votes = buckets.join(hubs, "key").where("rep <> hub").groupBy("rep", "hub").agg(
        F.count("*").alias("n_shared"), F.first("n").alias("n"), F.first("n_hub").alias("n_hub"))
    best = votes.groupBy("rep", "n").agg(F.max_by(F.struct("hub", "n_hub"), F.struct("n_shared", -F.col("hub"))).alias("h"))
    first = scratch.write(best.select(F.col("rep").alias("a"), F.col("h.hub").alias("b"), F.col("n").alias("n_a"),
                                      F.col("h.n_hub").alias("n_b")), "first")
    links = _verify(rows, first, scratch)

    # Sets of repeated ids belong together through their id.
    joined = signed.where("class IS NOT NULL AND doc_id IS NOT NULL").join(classes.select("class", "rep"), "class")
    repeats = joined.where("doc_id <> rep").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("c"),
                                                                  F.countDistinct("rep").alias("k")).where("k > 1")
    if repeats.limit(1).count():
        of_repeats = joined.join(repeats.select("doc_id"), "doc_id", "left_semi")
        links = links.unionByName(of_repeats.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))

    # 2. Buckets that still hold several components: whoever is not of the largest meets all others.
    labels = components(links)
    named = scratch.write(buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")), "named")
    state = (named.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"))
        .groupBy("key").agg(F.count("*").alias("components"), F.sum("n").alias("size"), F.max("n").alias("largest"),
                            F.max_by("component", F.struct("n", "component")).alias("major"),
                            F.sum("members").alias("members")).where("components > 1")
        # Buckets of the same members are one bucket.
        .groupBy("size", "members").agg(F.min_by(F.struct("key", "largest", "major"), "key").alias("s"))
        .select("s.*", "size"))
    state = scratch.write(state, "state")
    if state.limit(1).count():
        open_ = scratch.write(named.join(state, "key").select(
            "key", "rep", "component", (F.col("component") != F.col("major")).alias("minor"),
            _block("rep", F.col("size")).alias("block"),
            _block("rep", F.col("size") - F.col("largest")).alias("minor_block")), "open")
        sets = scratch.write(_texts(rows, open_.select(F.col("rep").alias("doc_id")), scratch)
                             .mapInPandas(_sets, "rep long, items binary"), "sets")
        held = scratch.write(open_.join(sets, "rep").withColumn("member", F.struct("rep", "component", "items")), "held")
        minor = held.where("minor").groupBy("key", "minor_block").agg(F.collect_list("member").alias("mine"))
        every = held.groupBy("key", "block").agg(F.collect_list("member").alias("others"))
        # Rows hold two blocks of sets: the RDD's batches go by size, Arrow's by rows.
        found = minor.join(every, "key").select("mine", "others").rdd.mapPartitions(_compared)
        more = scratch.write(spark.createDataFrame(found, "a long, b long"), "more")
        links = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
        labels = components(links)

    label = labels.select(F.col("node").alias("rep"), "component")
    of_class = scratch.write(classes.select("class", "rep").join(label, "rep", "left").select(
        "class", "rep", F.coalesce("component", "rep").alias("component_id")), "of-class")
    return (signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("rep", "doc_id").alias("class_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, one of each group, with all their columns."""
    decided = Scratch(docs.sparkSession, "near").write(near_groups(docs, id_col, text), "decided")
    gone = decided.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, same(docs, gone, [(id_col, "__gone")]), "left_anti")
