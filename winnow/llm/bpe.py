"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece the encoding is unique, so storing its last token is enough: the
last token of a longer prefix is the one token t for which the shorter prefix's last token u and
t may stand side by side, that is, BPE leaves ``u + t`` as exactly these two. Walking the stored
tokens back from the end gives the encoding. ``PieceEncoder`` keeps the table, so bytes are
appended exactly, and an edit re-encodes from the changed byte on. ``PiecesInStep`` fills the tables
of many pieces at once: a byte of each at a time, with arrays for what they look up.

Texts are cut by the vocabulary's pattern first. A piece that is itself a token is that token, as
in the reference library of the vocabulary. Each distinct piece is encoded once per worker while
it stays in a bounded cache; text is read once, in Arrow batches, without a shuffle.

The vocabulary (a bounded file, MAX_VOCABULARY entries) is broadcast as bytes by its rank.

Defined cases: a null or empty text has no tokens; unpaired surrogates cannot occur in a string
column; ties and repeated rows are encoded alike; a very long piece costs time in proportion to its
length times the longest token; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from winnow.llm.hashing import SPREAD, Lookup

MAX_VOCABULARY = 300_000
CACHED_PIECES = 250_000
CACHED_CHARS = 8 << 20      # characters of the cached pieces
CACHED_PAIRS = 400_000
PAIR_BITS = 20              # a worker's answers for arrays of pairs: 2 ** PAIR_BITS numbers
IN_STEP = 64                # fewer pieces of a length are not worth arrays
FRESH_PIECES = 20_000       # new pieces encoded at once
SLICE_CHARS = 1 << 20       # characters of the texts that wait for them
NO_TOKEN = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; a vocabulary of at most {MAX_VOCABULARY} may be broadcast")
    return ranks


class Vocabulary:
    """Tokens, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.sizes.values(), default=0)
        # Every ending of a token, with its rank, or NO_TOKEN if it is none itself. Longer ones need no look-up.
        self.endings = {t[i:]: ranks.get(t[i:], NO_TOKEN) for t in ranks for i in range(len(t))}
        self.pairs: dict[int, bool] = {}
        self._splits: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: tuple[dict, dict] = {}, {}

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """BPE by its definition: merge the adjacent pair of lowest rank until none (or ``until`` parts) is left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > until:
            found = [(rank, i) for i, pair in enumerate(zip(parts, parts[1:]))
                     if (rank := ranks.get(pair[0] + pair[1])) is not None]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The last merge that builds a token from its bytes, or None."""
        if token not in self._splits:
            parts = self.merged(token, 2)
            self._splits[token] = tuple(parts) if len(parts) == 2 and b"".join(parts) in self.ranks else None
        return self._splits[token]

    def reachable(self, token: bytes) -> bool:
        """Whether BPE builds the token from its own bytes."""
        return len(token) == 1 or self.split(token) is not None

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """Tokens that lie at the right (side 1) or left (0) end while BPE builds the token, from its end byte
        on, each with its rank; None unless every merge inside has a higher rank than those it builds on."""
        known = self._edges[side]
        if token not in known:
            if len(token) == 1:
                known[token] = [(token, -1)]
            else:
                parts, rank = self.split(token), self.ranks[token]
                inner = [self.edge(p, side) for p in parts]
                steady = all(e is not None and e[-1][1] < rank for e in inner)
                known[token] = inner[side] + [(token, rank)] if steady else None
        return known[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves two tokens, given by rank, side by side; answers are kept in ``pairs``."""
        if len(self.pairs) >= CACHED_PAIRS:             # the older half goes
            for key in list(islice(self.pairs, CACHED_PAIRS // 2)):
                del self.pairs[key]
        known = self.pairs[left << 32 | right] = self.fits(left, right)
        return known

    def fits(self, left: int, right: int) -> bool:
        """The answer of ``compatible``, not kept."""
        first, second = self.bytes[left], self.bytes[right]
        return self.reachable(first) and self.reachable(second) and self._stay_apart(first, second)

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        """Merges go by rank, so two neighbours at the boundary stay neighbours until the lower of the ranks that
        extend them; they are merged if their own rank comes first (at equal ranks the left pair does)."""
        mine, theirs = self.edge(left, 1), self.edge(right, 0)
        if mine is None or theirs is None:
            return self.merged(left + right) == [left, right]
        i = j = 0
        while True:
            rank = self.ranks.get(mine[i][0] + theirs[j][0])
            after_left = mine[i + 1][1] if i + 1 < len(mine) else None
            after_right = theirs[j + 1][1] if j + 1 < len(theirs) else None
            if rank is not None and (after_left is None or rank < after_left) and (
                    after_right is None or rank <= after_right):
                return False
            if after_left is None and after_right is None:
                return True
            if after_right is None or (after_left is not None and after_left <= after_right):
                i += 1
            else:
                j += 1


class PieceEncoder:
    """The last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []      # last: ids, one a prefix
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Extend the piece; the stored prefixes stay as they are."""
        v, start = self.vocabulary, len(self.last)
        self.piece += more
        piece, last, ending, known = self.piece, self.last, v.endings.get, v.pairs.get
        for end in range(start + 1, len(piece) + 1):
            for at in range(end - 1, -1, -1):
                token = ending(piece[at:end])
                if token is None:
                    raise ValueError(f"no token ends at byte {piece[end - 1]}")
                if token == NO_TOKEN:
                    continue
                if at:
                    fits = known(last[at - 1] << 32 | token)
                    if fits is None:
                        fits = v.compatible(last[at - 1], token)
                else:
                    fits = v.reachable(v.bytes[token])
                if fits:
                    last.append(token)
                    break

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace bytes start to end; prefixes before ``start`` are kept.

        A last token follows from those of the prefixes up to the longest token before it: once so many
        in a row are as they were, all further ones are.
        """
        old, tail, longest = self.last[end:], self.piece[end:], self.vocabulary.longest
        self.piece, self.last = self.piece[:start], self.last[:start]
        self.append(new)
        done = 0
        while done < len(tail):
            self.append(tail[done:done + longest])
            done = min(done + longest, len(tail))
            if done >= longest and self.last[-longest:] == old[done - longest:done]:
                self.piece += tail[done:]
                self.last += old[done:]
                break

    def ids(self) -> list[int]:
        out, end, size = [], len(self.piece), self.vocabulary.sizes
        while end:
            out.append(self.last[end - 1])
            end -= size[out[-1]]
        return out[::-1]

    def tokens(self) -> list[bytes]:
        return [self.vocabulary.bytes[i] for i in self.ids()]


class PiecesInStep:
    """The last token of every prefix of many pieces: the steps of ``PieceEncoder``, each taken by all at once."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        # A trie of the endings, from their last byte back; node 0 is the empty one.
        nodes = {ending: i for i, ending in enumerate(v.endings, 1)} | {b"": 0}
        self.children = Lookup(np.array([nodes[e[1:]] << 8 | e[0] for e in v.endings], np.int64))
        self.token = np.array([NO_TOKEN, *v.endings.values()], np.int64)
        self.start = max(v.bytes, default=-1) + 1           # in place of a token: the start of a piece
        self.sizes = np.zeros(self.start, np.int64)
        self.sizes[list(v.sizes)] = list(v.sizes.values())
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)  # pair and answer, each at one place; the newest stays

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * SPREAD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    def _fits(self, pair: int) -> bool:
        left, right = divmod(pair, self.start + 1)
        v = self.vocabulary
        return v.reachable(v.bytes[right]) if left == self.start else v.fits(left, right)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the tokens of each pair side by side."""
        pairs = left * (self.start + 1) + right
        held = self.pairs[self._place(pairs)]
        known = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != pairs)
        if len(new):
            distinct, of = np.unique(pairs[new], return_inverse=True)
            fits = np.fromiter(map(self._fits, distinct.tolist()), bool, len(distinct))
            known[new] = fits[of]
            self.pairs[self._place(distinct)] = distinct << 1 | fits
        return known

    def _fill(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Last token of each prefix, at its last byte; the pieces come longest first."""
        last = np.full(len(data), NO_TOKEN, np.int64)
        for k in range(lengths[0] if len(lengths) else 0):
            ends = starts[:np.searchsorted(-lengths, -k)] + k
            node = np.zeros(len(ends), np.int64)
            for back in range(k + 1):
                child, known = self.children.find(node << 8 | data[ends - back])
                if not known.all():
                    raise ValueError(f"no token ends at byte {data[ends[~known][0]]}")
                node = child + 1
                token = self.token[node]
                tried = np.flatnonzero(token != NO_TOKEN)
                left = last[ends[tried] - back - 1] if back < k else np.full(len(tried), self.start)
                found = tried[self.compatible(left, token[tried])]
                last[ends[found]] = token[found]
                rest = np.ones(len(ends), bool)
                rest[found] = False
                ends, node = ends[rest], node[rest]
                if not len(ends):
                    break
            else:
                raise ValueError(f"no token ends at byte {data[ends[0]]}")
        return last

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one piece after another, and the number of each."""
        ranks, counts, alone = self.vocabulary.ranks, np.zeros(len(pieces), np.int64), {}
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = np.fromiter((p in ranks for p in pieces), bool, len(pieces))
        order = np.flatnonzero(~whole)
        order = order[np.argsort(-lengths[order], kind="stable")]
        shared = lengths[order[IN_STEP - 1]] if len(order) >= IN_STEP else 0
        for i in order[lengths[order] > shared].tolist():
            alone[i] = PieceEncoder(self.vocabulary, pieces[i]).ids()
            counts[i] = len(alone[i])
        order = order[lengths[order] <= shared]

        data = np.frombuffer(b"".join([pieces[i] for i in order.tolist()]), np.uint8)
        ends = np.cumsum(lengths[order])
        starts = ends - lengths[order]
        last = self._fill(data, starts, lengths[order])
        steps = []
        at = np.flatnonzero(ends > starts)
        ends = ends[at]
        while len(at):          # the tokens of all pieces, from their ends back
            token = last[ends - 1]
            steps.append((order[at], token))
            ends = ends - self.sizes[token]
            more = ends > starts[at]
            at, ends = at[more], ends[more]
        for of, _ in steps:
            counts[of] += 1
        counts[whole] = 1

        until = np.cumsum(counts)
        ids = np.zeros(until[-1] if len(until) else 0, np.int32)
        for i, (of, token) in enumerate(steps):
            ids[until[of] - 1 - i] = token
        for i, tokens in alone.items():
            ids[until[i] - counts[i]:until[i]] = tokens
        ids[until[whole] - 1] = [ranks[pieces[i]] for i in np.flatnonzero(whole).tolist()]
        return ids, counts


class Encoder:
    """Texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary, self.pattern = Vocabulary(ranks), regex.compile(pattern)
        self.in_step = PiecesInStep(self.vocabulary)
        self._forget()

    def _forget(self) -> None:
        self._numbers: dict[str, int] = defaultdict()       # of the cached pieces; a new one gets the next
        self._numbers.default_factory = self._numbers.__len__
        self._ids, self._ends, self._chars = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def _settle(self, waiting: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Encode the new pieces, then put together the texts that wait, given by the numbers of their pieces."""
        fresh = list(islice(self._numbers, len(self._ends) - 1, None))
        if fresh:
            try:
                ids, counts = self.in_step.encode([p.encode() for p in fresh])
            except ValueError:
                self._forget()
                raise
            self._ids = np.concatenate([self._ids, ids])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(counts)])
            self._chars += sum(map(len, fresh))
        pieces = np.concatenate(waiting)
        first = self._ends[pieces]
        counts = self._ends[pieces + 1] - first
        until = np.concatenate([[0], np.cumsum(counts)])
        ids = self._ids[np.repeat(first - until[:-1], counts) + np.arange(until[-1])]
        cuts = until[np.cumsum([len(w) for w in waiting])]
        yield from np.split(ids, cuts[:-1])
        if len(self._numbers) >= CACHED_PIECES or self._chars >= CACHED_CHARS:
            self._forget()

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Token ids of each text, in turn; one call at a time, as calls share the cache."""
        waiting, chars = [], 0
        for text in texts:
            found = self.pattern.findall(text)
            waiting.append(np.fromiter(map(self._numbers.__getitem__, found), np.int64, len(found)))
            chars += len(text)
            if chars >= SLICE_CHARS or len(self._numbers) - len(self._ends) >= FRESH_PIECES:
                yield from self._settle(waiting)
                waiting, chars = [], 0
        if waiting:
            yield from self._settle(waiting)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


_ENCODERS: dict = {}


def _encoder(key, ranks, pattern) -> Encoder:
    """One encoder per worker process and vocabulary, kept from batch to batch and task to task."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value, pattern)
    return _ENCODERS[key]


def _shared(docs: DataFrame, path: str, pattern: str):
    ranks = read_ranks(path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return key, docs.sparkSession.sparkContext.broadcast(ranks)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """The rows with their token ids as an array of int."""
    key, ranks = _shared(docs, path, pattern)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = _encoder(key, ranks, pattern)
        for texts in batches:
            yield pd.Series(list(e.encode(t or "" for t in texts)), dtype=object)

    return docs.withColumn(into, ids(F.col(text)))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the bytes their ids stand for; null ids decode to no bytes."""
    key, ranks = _shared(encoded, path, pattern)

    @F.pandas_udf(T.BinaryType())
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = _encoder(key, ranks, pattern)
        for rows in batches:
            yield pd.Series([b"" if r is None else e.decode(map(int, r)) for r in rows], dtype=object)

    return encoded.withColumn(into, raw(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """The rows with one more column ``bpe``: n_tokens, digests of the ids and of the bytes they decode
    to, and the ids themselves if asked for.

    Encoding and decoding run in one pass, so ids are not moved between processes for a digest.
    """
    key, ranks = _shared(docs, path, pattern)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    @F.pandas_udf(T.StructType(fields))
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = _encoder(key, ranks, pattern)
        names = [str(i) for i in range(max(e.vocabulary.bytes, default=0) + 1)]
        for texts in batches:
            rows = []
            for found in e.encode(t or "" for t in texts):
                ids = found.tolist()
                rows.append((len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(e.decode(ids)).hexdigest(), *([found] if with_ids else [])))
            yield pd.DataFrame(rows, columns=[f.name for f in fields])

    return docs.withColumn("bpe", digest(F.col(text)))
