"""Token counts of a piece model, by merging the pre-tokens of a batch in step with each other.

A model merges neighbours whose joined text is a piece, best score first, leftmost among equals. Its texts
fall into pre-tokens that no merge crosses: two neighbouring characters that stand side by side in no piece
never meet in one. Pre-tokens of a batch lie one after another in flat arrays. In every round each sequence
applies its lowest-rank pair at all its places at once; a place after which a neighbour pair would come first
ends the sequence's round, so results equal merging one pair at a time. Finished sequences leave the arrays.
Symbols that survive count one token, characters outside the vocabulary one token a byte.

Defined cases: null counts as an empty text, which has no tokens; special strings in a text are ordinary text;
a text of any length is handled in slices that end where no merge crosses; rows and other columns stay as they
are, whatever their names; an empty table gives an empty result. A model that does not fall back to bytes, that
rewrites its texts, or that has pieces set by hand raises ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2 as model_format

from winnow.llm.hashing import Lookup

BLANK = "▁"        # fixed value: stands for a space in pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6     # fixed values: kinds of pieces in a model
NEVER = np.iinfo(np.int32).max

SLICE_CHARS = 1 << 20       # characters whose pre-tokens are listed at once
KEPT_CHARS = 48             # longer pre-tokens are counted anew in each slice
KEPT_BYTES = 48 << 20       # estimated size of the kept counts of a worker


class Pieces:
    """The tables of a model: characters, pairs that merge, and where merges cannot cross."""

    def __init__(self, path: str):
        model = model_format.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rewrites = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (not model.trainer_spec.byte_fallback or model.trainer_spec.model_type != 2
                or rewrites.precompiled_charsmap or rewrites.remove_extra_whitespaces
                or not rewrites.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError(f"{path}: only merging models with bytes as fallback and unchanged texts are counted")
        self.prefix = BLANK if rewrites.add_dummy_prefix else ""
        scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}

        chars = sorted(set("".join(scores)))
        ids = {c: i for i, c in enumerate(chars)}
        for piece in scores:
            ids.setdefault(piece, len(ids))
        self.size = len(ids)
        self.chars = Lookup(np.array([ord(c) for c in chars], dtype=np.int64))
        self.weight = np.array([1 if s in scores else len(s.encode()) for s in ids], dtype=np.int64)
        pairs = {ids[p[:k]] * self.size + ids[p[k:]]: (order[s], ids[p]) for p, s in scores.items()
                 for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.pairs = Lookup(np.array(list(pairs), dtype=np.int64))
        self.pair_rank = np.array([r for r, _ in pairs.values()], dtype=np.int32)
        self.pair_made = np.array([m for _, m in pairs.values()], dtype=np.int64)
        self.beside = Lookup(np.unique(np.array(
            [ids[a] * self.size + ids[b] for p in scores for a, b in zip(p, p[1:])], dtype=np.int64)))

        joined = {c for p in scores if len(p) > 1 for c in p} - {BLANK}
        inner = "".join(re.escape(c) for c in sorted(joined))
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in scores):
            self.pattern = f"[{BLANK}{inner}]+|[^{BLANK}{inner}]"
        else:
            self.pattern = f"{BLANK}*[{inner}]+|{BLANK}+|[^{BLANK}{inner}]"
        self.blanks = self._blank_block(scores)

    @staticmethod
    def _blank_block(scores: dict[str, float]) -> int:
        """How many blanks a run of blanks is cut by, from its left end; 0 if the pieces do not allow that.

        Where blanks merge last, and every number of them up to the longest is a piece of one score, the
        leftmost blanks grow to the longest piece before the next ones start.
        """
        longest = max((len(p) for p in scores if not p.strip(BLANK)), default=0)
        runs = {scores.get(BLANK * n) for n in range(2, longest + 1)}
        return longest if longest > 1 and runs == {min(scores.values())} else 0


class Counter:
    """Counts the tokens of texts; the counts of short pre-tokens are kept up to a number of bytes."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.pattern = re.compile(pieces.pattern)
        self.kept: dict[str, int] = {}
        self.room = KEPT_BYTES

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; NEVER where it does not merge."""
        at, known = self.p.pairs.find(left * self.p.size + right)
        return np.where(known, self.p.pair_rank[at], NEVER), self.p.pair_made[at]

    def merged(self, ids: np.ndarray, seq: np.ndarray, n: int) -> np.ndarray:
        """Weight of the symbols that survive in each of n sequences; ``seq`` is sorted."""
        total = np.zeros(n, np.int64)
        rank = np.full(len(ids), NEVER, np.int32)
        made = np.zeros(len(ids), np.int64)
        if len(ids):
            rank[:-1], made[:-1] = self._pairs(ids[:-1], ids[1:])
            rank[:-1][seq[:-1] != seq[1:]] = NEVER
        while len(ids):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(ids)]))
            done = lowest == NEVER
            if done.any():
                np.add.at(total, seq[done], self.p.weight[ids[done]])
                ids, seq, rank, made, lowest = (x[~done] for x in (ids, seq, rank, made, lowest))
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == lowest)
            first = np.r_[True, np.diff(hits) > 1]      # overlapping places: every second one, from the left
            chain = hits[np.flatnonzero(first)][np.cumsum(first) - 1]
            at = hits[(hits - chain) % 2 == 0]
            new, low, of = made[at], lowest[at], seq[at]

            before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(ids) - 1)
            left = ids[before]
            touching = np.r_[False, at[1:] - at[:-1] == 2]
            left[touching] = new[np.flatnonzero(touching) - 1]
            left_rank = np.where((at > 0) & (seq[before] == of), self._pairs(left, new)[0], NEVER)
            right_rank = np.where((at + 2 < len(ids)) & (seq[after] == of), self._pairs(new, ids[after])[0], NEVER)
            ends = np.minimum(left_rank, right_rank) <= low       # what it makes would merge before the next place
            if ends.any():
                seen = np.cumsum(ends) - ends
                head = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                seen -= np.repeat(seen[head], np.diff(np.r_[head, len(at)]))
                at, new = at[seen == 0], new[seen == 0]

            ids[at] = new
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            ids, seq, rank, made = ids[stay], seq[stay], rank[stay], made[stay]
            at = moved[at]
            near = np.zeros(len(ids), bool)
            near[at] = True
            near[at[at > 0] - 1] = True
            touched = np.flatnonzero(near)
            nxt = np.minimum(touched + 1, len(ids) - 1)
            rank[touched], made[touched] = self._pairs(ids[touched], ids[nxt])
            rank[touched[(touched + 1 >= len(ids)) | (seq[touched] != seq[nxt])]] = NEVER
        return total

    def _cut(self, tokens: list[str]) -> tuple[list[str], np.ndarray]:
        """Long runs of blanks are taken off whole; how many blocks each pre-token lost."""
        blocks, block = np.zeros(len(tokens), np.int64), self.p.blanks
        if not block:
            return tokens, blocks
        rest = []
        for i, t in enumerate(tokens):
            if t.startswith(BLANK * (block + 1)):
                blocks[i] = (len(t) - len(t.lstrip(BLANK)) - 1) // block
                t = t[blocks[i] * block:]
            rest.append(t)
        return rest, blocks

    def count_tokens(self, tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        tokens, total = self._cut(tokens)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(tokens)), lengths)
        ids, known = self.p.chars.find(points)
        size = np.ones(len(points), np.int64) + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        np.add.at(total, of[~known], size[~known])
        ids, of, place = ids[known], of[known], np.flatnonzero(known)
        if not len(ids):
            return total
        new = np.ones(len(ids), bool)
        new[1:] = ((of[1:] != of[:-1]) | (np.diff(place) > 1)
                   | ~self.p.beside.find(ids[:-1] * self.p.size + ids[1:])[1])
        seq = np.cumsum(new) - 1
        np.add.at(total, of[new], self.merged(ids.copy(), seq, int(seq[-1]) + 1))
        return total

    def _slices(self, text: str) -> Iterator[str]:
        """The text in parts of about SLICE_CHARS that end before a space that follows something else."""
        start = 0
        while len(text) - start > SLICE_CHARS:
            cut = text.find(BLANK, start + SLICE_CHARS)
            while cut > 0 and text[cut - 1] == BLANK:
                cut = text.find(BLANK, cut + 1)
            if cut < 0 or BLANK in self.pattern.pattern[:2]:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def _settle(self, waiting: list[list[str]]) -> list[int]:
        """Tokens of each list of pre-tokens."""
        known = self.kept
        fresh = list(set().union(*waiting).difference(known))
        if fresh:
            known.update(zip(fresh, self.count_tokens(fresh).tolist()))
        out = [sum(map(known.__getitem__, tokens)) for tokens in waiting]
        for t in fresh:
            if len(t) > KEPT_CHARS:
                del known[t]
            else:
                self.room -= 120 + 4 * len(t)
        if self.room < 0:
            self.kept = dict(islice(known.items(), len(known) // 2, None))      # the older half goes
            self.room = KEPT_BYTES - sum(120 + 4 * len(t) for t in self.kept)
        return out

    def counts(self, texts) -> np.ndarray:
        """Tokens of each text, null counted as empty."""
        total = np.zeros(len(texts), np.int64)
        waiting, owners, chars = [], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            for part in self._slices(self.p.prefix + text.replace(" ", BLANK)):
                waiting.append(self.pattern.findall(part))
                owners.append(i)
                chars += len(part)
                if chars >= SLICE_CHARS:
                    np.add.at(total, owners, self._settle(waiting))
                    waiting, owners, chars = [], [], 0
        if waiting:
            np.add.at(total, owners, self._settle(waiting))
        return total


_COUNTERS: dict = {}


def _counter(shared) -> Counter:
    """One counter per worker process and model, kept from batch to batch."""
    if shared.id not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[shared.id] = Counter(shared.value)
    return _COUNTERS[shared.id]


class _Shared:
    def __init__(self, spark, pieces: Pieces):
        self.broadcast = spark.sparkContext.broadcast(pieces)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> Pieces:
        return self.broadcast.value


def token_counts(docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """The rows with the number of tokens of their text."""
    shared = _Shared(docs.sparkSession, Pieces(path))

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(shared)
        for texts in batches:
            yield pd.Series(counter.counts(texts))

    return docs.withColumn(into, count(F.col(f"`{text}`").cast("string")))
