"""Language-model scores from a log-frequency Bloom filter.

Training: every task folds the words and word pairs of its texts to distinct 64-bit keys with counts, and sends them
to buckets of the key space. A bucket adds up, quantises counts on a logarithmic scale, and fills its segment of the
filter: for an n-gram of level L the items (n-gram, 1) to (n-gram, L). The segments are a table in the shared
folder. Their number grows with the text and a segment with its items, so all counts are held at every size.

A count is read back by probing levels upwards until one is missing. While the counted bytes of all segments stay
under ``broadcast_bytes``, the whole filter is broadcast and texts are scored in one pass; a worker remembers the
levels read for its commonest keys, which are probed over many levels. Beyond that, chunks of
texts send their distinct keys to the segments, which answer with levels, a byte a key; a chunk meets its answers by
its number and finds its keys again in sorted order. Both ways read the same segments, so results are equal.

Scoring: P(w | v) = BIGRAM * c(v w) / c(v) + (1 - BIGRAM) * P(w), P(w) = (c(w) + 1) / (N + V + 1), with counts
read from the filter; where v is unknown P(w) alone. A text starts and stops at the end token.

The base score needs exact counts. The commonest words, at most HEAVY of bounded length, are
broadcast with their counts and summed where the text is read; the rest are joined by word, and since
the common ones are gone no word is hot in that join.

Defined cases: null, empty or wordless text is one end token; a null id is in training; repeated rows count
and score each on their own; an empty training set scores every word alike; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.common import Scratch, batches_of
from winnow.llm.hashing import constants, mixed

PROBES = 5                  # bits per item; a missing item is taken for present once in 32
BITS_PER_ITEM = PROBES / math.log(2)
BIGRAM = 0.6
HEAVY, HEAVY_BYTES = 60_000, 48
BUCKET_BYTES = 8 << 20      # text per bucket of the key space
BATCH_BYTES = 4 << 20       # rows that Spark hands to a worker at once
PART_BYTES = 1 << 20        # text handled at once; a longer document is a part of its own
CHUNK_BYTES = 8 << 20       # text whose keys are sent together where the filter is not broadcast
FOLDED_KEYS = 1_000_000     # distinct keys a task holds before it sends them
FOLDED_WORDS = 200_000      # distinct words a task holds before it sends them
RECALLED = 500_000          # keys whose levels a worker remembers
FILTER_BYTES = 128 << 20    # a filter up to this is broadcast whole
END = b""                   # no word is empty
_PACKED = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
_SALT = constants("lm", 4)
# Smallest count of each level: factors of about 1.4, whole numbers.
_SCALE = np.unique(np.round(2 ** (np.arange(0, 96) / 2)).astype(np.int64))


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_SCALE, counts, side="right")


def _value(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the geometric middle of its range; 0 for none."""
    top = np.append(_SCALE[1:] - 1, _SCALE[-1] * 1.4)
    middle = np.concatenate([[0.0], np.sqrt(_SCALE * np.maximum(top, _SCALE))])
    return middle[levels]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of texts, the words as numbers of those, and how many each text has.

    Words lie between blanks and \\x09-\\x0D, with A-Z in lower case. ``END`` is one of the distinct ones.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    pieces = lists.flatten()
    full = pc.binary_length(pieces).to_numpy(zero_copy_only=False) > 0         # blanks at the ends leave empty pieces
    counts = np.bincount(pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[full], minlength=len(texts))
    encoded = pieces.dictionary_encode()
    distinct = encoded.dictionary.cast(pa.binary())
    if pc.index(distinct, END).as_py() < 0:
        distinct = pa.concat_arrays([distinct, pa.array([END], pa.binary())])
    return distinct, encoded.indices.to_numpy(zero_copy_only=False)[full].astype(np.int64), counts


class Tokens:
    """The tokens of some texts: distinct ones with their keys, and the sequence as numbers of those."""

    def __init__(self, texts: pa.Array):
        self.distinct, numbers, counts = _words(texts)
        end = pc.index(self.distinct, END).as_py()
        self.lengths = counts + 1
        is_word = np.ones(int(self.lengths.sum()), bool)
        is_word[np.cumsum(self.lengths) - 1] = False
        self.sequence = np.full(len(is_word), end, np.int64)
        self.sequence[is_word] = numbers
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.distinct.to_numpy(zero_copy_only=False)),
                                  np.uint64, len(self.distinct))
        self.end = self.hashes[end]
        self.words = mixed(self.hashes * _SALT[0])

    def pairs(self) -> np.ndarray:
        """Keys of the pairs that end in each token; a text's first follows the end token."""
        own = self.hashes[self.sequence]
        before = np.concatenate([[self.end], own[:-1]])        # each text ends in the end token
        return mixed(mixed(before * _SALT[1]) + own * _SALT[2])


def _parts(batch: pa.RecordBatch, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in parts of bounded text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.cumsum(sizes) // limit
    edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])) if len(place) else []
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _unpacked(rows: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(rows).read_next_batch()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, byte by byte of all: high bytes of small steps are alike."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpack_keys(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")     # runs that are in order merge fast
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _trained(bits: int):
    """Rows (bucket, keys, counts) of the n-grams of training texts, folded while they fit."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def fold():
            return _summed(np.concatenate([keys, *[k for k, _ in waiting]]), np.concatenate([counts, *[c for _, c in waiting]]))

        def send():
            buckets = _bucket(keys, bits)
            edges = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]])) if len(keys) else []
            return pa.RecordBatch.from_arrays([
                pa.array([int(buckets[a]) for a in edges[:-1]], pa.int64()),
                pa.array([_pack_keys(keys[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()),
                pa.array([pa.compress(counts[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(edges, edges[1:])], pa.binary()),
                pa.array([int(b - a) for a, b in zip(edges, edges[1:])], pa.int64())], ["bucket", "keys", "counts", "n"])

        for batch in batches:
            for part in _parts(batch):
                tokens = Tokens(part.column("text"))
                pairs, times = np.unique(tokens.pairs(), return_counts=True)
                waiting += [(tokens.words, np.bincount(tokens.sequence, minlength=len(tokens.words))), (pairs, times)]
                size += len(tokens.words) + len(pairs)
                if size >= FOLDED_KEYS // 3:
                    (keys, counts), waiting, size = fold(), [], 0
                    if len(keys) >= FOLDED_KEYS:
                        yield send()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = fold()
        yield send()

    return count


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, text) to a row per chunk."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in _parts(batch, CHUNK_BYTES):
            packed = pa.BufferOutputStream()
            with pa.ipc.new_stream(packed, batch.schema, options=_PACKED) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([packed.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])
            number += 1


def _distinct(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of words and pairs in order, and where each distinct word and each pair has its key."""
    keys, back = np.unique(np.concatenate([tokens.words, tokens.pairs()]), return_inverse=True)
    return keys, back[:len(tokens.words)], back[len(tokens.words):]


def _requests(bits: int):
    """Rows (bucket, chunk, keys) of the distinct keys of each chunk."""
    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in zip(batch.column("chunk").to_pylist(), batch.column("rows")):
                keys, _, _ = _distinct(Tokens(_unpacked(rows.as_py()).column("text")))
                buckets = _bucket(keys, bits)
                edges = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(buckets[edges[:-1]]), pa.array([chunk] * (len(edges) - 1), pa.int64()),
                    pa.array([_pack_keys(keys[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()),
                    pa.array([int(b - a) for a, b in zip(edges, edges[1:])], pa.int64())], ["bucket", "chunk", "keys", "n"])

    return request


def _places(keys: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of items (key, level) within segments of ``size`` bits, probe by probe."""
    one = mixed(keys + np.asarray(level).astype(np.uint64) * _SALT[3])
    two = mixed(one) | np.uint64(1)
    size = np.asarray(size).astype(np.uint64)
    for _ in range(PROBES):
        yield (one % size).view(np.int64)
        one = one + two


def filled(keys: np.ndarray, levels: np.ndarray, bits_per_item: float = BITS_PER_ITEM) -> tuple[int, bytes]:
    """A segment that holds distinct keys up to their levels: its bits, eight a byte, and their number."""
    size = max(64, math.ceil(int(levels.sum()) * bits_per_item))
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in _places(keys[levels >= level], level, size):
            bits[at] = True
    return size, np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Segments of the filter: all of them, or the one of a bucket."""

    def __init__(self, bits: int, segments: Iterable[tuple[int, int, bytes]], total: int, only: int | None = None):
        """``segments``: bucket, number of bits, and the bits of each; ``total`` bytes in all."""
        self.bits, self.only = bits, only
        n = 1 if only is not None else 1 << bits
        self.sizes = np.full(n, 8, np.int64)        # a bucket without a segment holds nothing
        self.starts = np.zeros(n, np.int64)
        self.data = np.zeros(total + 1, np.uint8)
        at = 1
        for bucket, size, packed in segments:
            i = 0 if only is not None else bucket
            self.sizes[i], self.starts[i] = size, at
            self.data[at:at + len(packed)] = np.frombuffer(packed, np.uint8)
            at += len(packed)
        self.kept, self.kept_levels, self.kept_from = np.zeros(0, np.uint64), np.zeros(0, np.uint8), 2

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of keys, found by probing level after level."""
        levels, live, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 1
        own = np.zeros(len(keys), np.int64) if self.only is not None else _bucket(keys, self.bits)
        sizes, starts = self.sizes[own].view(np.uint64), self.starts[own] << 3
        while len(live) and level <= len(_SCALE):
            there = None
            for at in _places(keys, level, sizes):
                at = starts + at if there is None else starts[there] + at[there]
                held = np.flatnonzero((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                there = held if there is None else there[held]
            live, keys, sizes, starts = live[there], keys[there], sizes[there], starts[there]
            levels[live] = level
            level += 1
        return levels

    def recalled(self, keys: np.ndarray) -> np.ndarray:
        """Levels of distinct keys in order; at most ``RECALLED`` keys of high levels are probed only once."""
        at = np.searchsorted(self.kept, keys)
        at[at == len(self.kept)] = 0
        old = self.kept[at] == keys if len(self.kept) else np.zeros(len(keys), bool)
        levels = np.zeros(len(keys), np.uint8)
        levels[old] = self.kept_levels[at[old]]
        new = np.flatnonzero(~old)
        levels[new] = self.levels(keys[new])
        new = new[levels[new] >= self.kept_from]
        if len(new):
            kept, kept_levels = np.concatenate([self.kept, keys[new]]), np.concatenate([self.kept_levels, levels[new]])
            while len(kept) > RECALLED:         # the lowest levels go, and stay out
                self.kept_from += 1
                high = kept_levels >= self.kept_from
                kept, kept_levels = kept[high], kept_levels[high]
            order = np.argsort(kept, kind="stable")
            self.kept, self.kept_levels = kept[order], kept_levels[order]
        return levels


def _filling(bits_per_item: float):
    def fill(parts: pd.DataFrame) -> pd.DataFrame:
        """Adds up all counts of a bucket and fills its segment."""
        keys = np.concatenate([_unpack_keys(k, n) for k, n in zip(parts["keys"], parts["n"])])
        counts = np.concatenate([np.frombuffer(pa.decompress(c, 8 * n, "zstd", asbytes=True), np.int64)
                                 for c, n in zip(parts["counts"], parts["n"])])
        keys, counts = _summed(keys, counts)
        size, packed = filled(keys, level_of(counts), bits_per_item)
        return pd.DataFrame({"bucket": parts["bucket"][:1], "size": [size], "packed": [packed]})

    return fill


def bucket_bits(texts: DataFrame) -> int:
    """Bits of the number of buckets, from the bytes of the texts."""
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return min(24, max(0, math.ceil(math.log2(max(1, size / BUCKET_BYTES)))))


def segments(training: DataFrame, bits: int) -> DataFrame:
    """(bucket, size, packed): the segments of the filter of some texts."""
    sent = training.select("text").mapInArrow(_trained(bits), "bucket long, keys binary, counts binary, n long")
    return sent.groupBy("bucket").applyInPandas(_filling(BITS_PER_ITEM), "bucket long, size long, packed binary")


def _answers(bits: int):
    def answer(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        """Tells every chunk the levels of its keys in this bucket."""
        rows = held.to_pylist()
        own = Filter(bits, [(r["bucket"], r["size"], r["packed"]) for r in rows], sum(len(r["packed"]) for r in rows),
                     only=key[0].as_py())
        sent = [_unpack_keys(k, n) for k, n in zip(asked.column("keys").to_pylist(), asked.column("n").to_pylist())]
        keys, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *sent]), return_inverse=True)
        found = own.levels(keys)[back]
        ends = np.cumsum([len(x) for x in sent])
        levels = [found[b - len(x):b].tobytes() for x, b in zip(sent, ends)]
        return pa.table({"bucket": asked.column("bucket"), "chunk": asked.column("chunk"), "levels": pa.array(levels, pa.binary())})

    return answer


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts, folded while they fit."""
    held, size = [], 0

    def fold() -> pa.Table:
        summed = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")])
        return summed.select(["token", "n_sum"]).rename_columns(["token", "n"])

    for batch in batches:
        for part in _parts(batch):
            distinct, numbers, counts = _words(part.column("text"))
            times = np.bincount(numbers, minlength=len(distinct))
            times[pc.index(distinct, END).as_py()] = len(counts)
            held.append(pa.table({"token": distinct, "n": pa.array(times, pa.int64())}))
            size += len(distinct)
            if size >= FOLDED_WORDS:
                held, size = [fold()], 0
                if len(held[0]) > FOLDED_WORDS:
                    yield from held[0].to_batches()
                    held = []
    if held:
        yield from fold().to_batches()


def vocabulary(training: DataFrame, scratch: Scratch) -> DataFrame:
    """Exact counts of all words and the end token: (token, c)."""
    return scratch.write(training.select("text").mapInArrow(_counted, "token binary, n long")
                         .groupBy("token").agg(F.sum("n").alias("c")), "vocabulary")


def _heavy(vocab: DataFrame) -> tuple[dict[bytes, int], int]:
    """The commonest short words and the count from which words are in."""
    short = F.octet_length("token") <= HEAVY_BYTES
    level = F.floor(F.log2("c") * 8)
    total, threshold = 0, None
    for row in vocab.where(short).groupBy(level.alias("l")).agg(
            F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("l")).collect():     # a few hundred rows
        total += row["n"]
        if total > HEAVY:
            break
        threshold = row["c"]
    if threshold is None:
        return {}, 1 << 62
    rows = vocab.where(short & (F.col("c") >= threshold)).collect()      # at most HEAVY of HEAVY_BYTES
    return {bytes(r["token"]): r["c"] for r in rows}, threshold


def _log_probabilities(single: np.ndarray, pairs: np.ndarray, lengths: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 probability of each text, from the counts of its words and pairs."""
    ends = np.cumsum(lengths)
    starts = np.concatenate([[0], ends[:-1]])
    before = np.concatenate([[0.0], single[:-1]])
    before[starts] = single[ends - 1]           # what precedes a text is the end token
    alone = (single + 1) / (n + v + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        pair = np.minimum(pairs / before, 1.0)
    p = np.where(before > 0, BIGRAM * pair + (1 - BIGRAM) * alone, alone)
    return np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)


SCORED = ("doc_id long, held_out boolean, n_tokens long, exact double, found long, rare array<binary>, "
          "rare_n array<long>, score double")


def _score_rows(rows: pa.RecordBatch, known: tuple[pa.Array, np.ndarray], n: int, v: int,
                lookup: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """Scores of some rows; ``lookup`` gives the levels of distinct keys in order. ``known`` has words and log10(c + 1)."""
    tokens = Tokens(rows.column("text"))
    keys, word_at, pair_at = _distinct(tokens)
    counts = _value(lookup(keys))
    single, pairs = counts[word_at][tokens.sequence], counts[pair_at]
    heavy = pc.fill_null(pc.index_in(tokens.distinct, value_set=known[0]), -1).to_numpy(zero_copy_only=False)
    logs = np.append(known[1], 0.0)[heavy]
    is_rare = (heavy < 0)[tokens.sequence]
    ends = np.cumsum(tokens.lengths)
    starts = np.concatenate([[0], ends[:-1]])
    exact = np.add.reduceat(logs[tokens.sequence], starts)
    found = np.add.reduceat(~is_rare, starts, dtype=np.int64)
    row = np.repeat(np.arange(len(starts)), tokens.lengths)[is_rare]
    own, times = np.unique(row * len(tokens.distinct) + tokens.sequence[is_rare], return_counts=True)
    row, word = np.divmod(own, len(tokens.distinct))
    edges = pa.array(np.searchsorted(row, np.arange(len(starts) + 1)), pa.int32())
    return pa.RecordBatch.from_arrays([
        rows.column("doc_id"), rows.column("held_out"), pa.array(tokens.lengths, pa.int64()), pa.array(exact),
        pa.array(found), pa.ListArray.from_arrays(edges, tokens.distinct.take(pa.array(word))),
        pa.ListArray.from_arrays(edges, pa.array(times, pa.int64())),
        pa.array(_log_probabilities(single, pairs, tokens.lengths, n, v))],
        ["doc_id", "held_out", "n_tokens", "exact", "found", "rare", "rare_n", "score"])


def _score_by_broadcast(rows: DataFrame, whole: Filter, known, n: int, v: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(whole)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                yield _score_rows(part, known.value, n, v, shared.value.recalled)

    return rows.select("doc_id", "held_out", "text").mapInArrow(score, SCORED)


def _score_by_join(rows: DataFrame, held: DataFrame, bits: int, known, n: int, v: int, scratch: Scratch) -> DataFrame:
    chunks = scratch.write(rows.select("doc_id", "held_out", "text").mapInArrow(_chunked, "chunk long, rows binary"), "chunks")
    sent = chunks.mapInArrow(_requests(bits), "bucket long, chunk long, keys binary, n long")
    answered = sent.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(
        _answers(bits), "bucket long, chunk long, levels binary")

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        # Buckets are ranges of keys: answers in their order are the levels of the sorted keys.
        order = np.argsort(answers.column("bucket").to_numpy())
        payloads = answers.column("levels").to_pylist()
        levels = np.frombuffer(b"".join(payloads[i] for i in order), np.uint8)
        rows = _unpacked(chunk.column("rows")[0].as_py())
        return pa.Table.from_batches([_score_rows(rows, known.value, n, v, lambda keys: levels)])

    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(score, SCORED)


def held_out(id_col: str) -> Column:
    """Documents kept out of the training set, by a hash of their id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(7)) == 2, F.lit(False))


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", out: Column | None = None,
          broadcast_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``out`` tells the rows kept out of training, by default ``held_out(id_col)``. A filter of more than
    ``broadcast_bytes`` is probed segment by segment instead of being broadcast; results are the same.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       (held_out(id_col) if out is None else out).alias("held_out"))
    training = rows.where("NOT held_out")
    with batches_of(spark, BATCH_BYTES):
        vocab = vocabulary(training, scratch)
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).head()
    heavy, threshold = _heavy(vocab)
    known = spark.sparkContext.broadcast((pa.array(list(heavy), pa.binary()), np.array([math.log10(c + 1) for c in heavy.values()])))
    bits = bucket_bits(training)
    with batches_of(spark, BATCH_BYTES):
        held = scratch.write(segments(training, bits), "filter")
    size = held.agg(F.sum(F.octet_length("packed"))).head()[0] or 0
    if size <= broadcast_bytes:
        whole = Filter(bits, ((r["bucket"], r["size"], r["packed"]) for r in held.toLocalIterator()), size)
        scored = _score_by_broadcast(rows, whole, known, n, v)
    else:
        with batches_of(spark, CHUNK_BYTES):        # a chunk is cut from one batch
            scored = _score_by_join(rows, held, bits, known, n, v, scratch)
    with batches_of(spark, BATCH_BYTES):
        scored = scratch.write(scored.select(F.monotonically_increasing_id().alias("row"), "*"), "scored")
    scratch.drop("filter", "chunks")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("t")).select(
        "row", F.col("t.rare").alias("token"), F.col("t.rare_n").alias("times"))
    counts = vocab.where((F.octet_length("token") > HEAVY_BYTES) | (F.col("c") < threshold))
    sums = rare.join(counts, "token").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("more_found"))
    floor = math.log10(n + v + 1)
    return scored.drop("rare", "rare_n").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("found") + F.coalesce("more_found", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("exact") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"), "score")
