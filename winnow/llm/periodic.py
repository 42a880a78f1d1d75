"""Runs of words that repeat with a period, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 * q) words long, that
neither neighbour extends. In a run every word occurs four times or more. So words that occur less often
within a segment of the text split it; the parts are counted again, until no segment changes. What survives
is scanned by lag. Every run of lag q holds four places that are multiples of q, so only these are compared,
for all lags of one power of two at once; a place that passes is extended by its neighbours. Lags that are
multiples of a run's period are settled by that run. All this takes about m log m steps for a segment of m words.

Defined cases: a null text has no words and no runs; runs may overlap; of runs with equal length / period the
one with the smallest start, then period, is the strongest; rows and other columns stay as they are, repeated
rows too; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from winnow.llm.common import text_of, words_of

LEAST_WORDS, LEAST_REPEATS = 6, 4       # a run's length: at least the first, and the second times its period
PROBES = 8                              # places compared before a candidate is extended

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN),
                      T.StructField("collapsed", T.StringType())])


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Parts (start, end) of a word sequence outside which no run has a word."""
    at = np.arange(len(codes))
    part = np.zeros(len(codes), np.int64)
    settled = []
    while len(at):
        _, which, count = np.unique(part * (len(codes) + 1) + codes[at], return_inverse=True, return_counts=True)
        often = count[which] >= LEAST_REPEATS
        stable = np.ones(part[-1] + 1, bool)
        stable[part[~often]] = False
        whole = stable[part]
        if whole.any():
            first = np.flatnonzero(whole & np.r_[True, part[1:] != part[:-1]])
            size = np.bincount(part, minlength=len(stable))
            settled += [(int(at[i]), int(at[i] + size[part[i]])) for i in first]
        at, part = at[often & ~whole], part[often & ~whole]
        if not len(at):
            break
        part = np.cumsum(np.r_[False, (np.diff(at) > 1) | (np.diff(part) > 0)])
        long = np.bincount(part)[part] >= LEAST_WORDS
        at, part = at[long], part[long]
        if len(at):
            part = np.cumsum(np.r_[False, np.diff(part) > 0])
    return sorted(settled)


def _reach(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading entries agree."""
    done, step = 0, 64
    while done < len(x):
        differ = x[done:done + step] != y[done:done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + len(differ), step * 2
    return done


def _unsettled(q: np.ndarray, a: np.ndarray, found: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that no run found so far holds with a period that divides theirs."""
    for start, length, d in found:
        inside = (q % d == 0) & (a >= start) & (a + 3 * q < start + length)
        q, a = q[~inside], a[~inside]
    return q, a


def lag_scan(c: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a segment."""
    m, found = len(c), []
    low = 1
    while low <= m // LEAST_REPEATS:
        lags = np.arange(low, min(2 * low, m // LEAST_REPEATS + 1))
        places = (m - 1) // lags - 2
        q = np.repeat(lags, places)
        a = (np.arange(len(q)) - np.repeat(np.cumsum(places) - places, places)) * q
        keep = c[a] == c[a + q]
        for k in (1, 2):
            q, a = q[keep], a[keep]
            keep = c[a + k * q] == c[a + (k + 1) * q]
        q, a = _unsettled(q[keep], a[keep], [r for r in found if 8 * r[1] >= m])
        for j in range(1, PROBES + 1):
            off = a + 2 * q * j // (PROBES + 1)
            keep = c[off] == c[off + q]
            q, a = q[keep], a[keep]
        q, a = _unsettled(q, a, found)
        last, end = 0, 0
        for lag, i in zip(q.tolist(), a.tolist()):
            if lag == last and i + 3 * lag < end:
                continue
            right = _reach(c[i:m - lag], c[i + lag:])
            if right < 2 * lag:
                continue
            left = _reach(c[:i][::-1], c[lag:i + lag][::-1])
            start, length = i - left, left + right + lag
            if length >= max(LEAST_WORDS, LEAST_REPEATS * lag):
                found.append((start, length, lag))
            last, end = lag, i + right + lag
        low *= 2
    return found


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a list of words, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    index: dict = {}
    codes = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    return sorted(((s + start, length, q) for s, e in segments(codes) for start, length, q in lag_scan(codes[s:e])),
                  key=lambda r: (r[0], r[2]))


def strongest_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; the first of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop)
    return b" ".join([w for w, g in zip(words, gone) if not g] if runs else words).decode("utf-8", "replace")


@F.pandas_udf(FOUND)
def _found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            words = (text or "").encode("utf-8", "replace").split()
            runs = runs_of(words)
            rows.append((runs, strongest_of(runs), collapse(words, runs)))
        yield pd.DataFrame({
            "runs": [[dict(zip(RUN.names, r)) for r in runs] for runs, _, _ in rows],
            "strongest": [dict(zip(RUN.names, s)) if s else None for _, s, _ in rows],
            "collapsed": [text for _, _, text in rows]}, columns=FOUND.names)


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic") -> DataFrame:
    """The rows with a struct of the text's runs, the strongest one (null: no run) and the text without repeats."""
    return docs.withColumn(into, _found(F.col(f"`{text}`").cast("string")))


def planted(text: Column, h: Column) -> Column:
    """The text, its end replaced by a repeated passage where the number h says so; for checks of detectors."""
    words = words_of(text)
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    passage = F.slice(words, a + 1, p)
    again = F.array_repeat(passage, F.ceil((n - a) / p).cast("int"))
    ending = F.slice(F.flatten(again), 1, n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, 1, a), ending), " ")).otherwise(text)


def digest(found: DataFrame, key: str = "doc_id", into: str = "periodic") -> DataFrame:
    """A row per text: its key, the strongest run, and digests of all runs and of the text without repeats."""
    best = F.col(f"`{into}`.strongest")
    lines = F.transform(F.col(f"`{into}`.runs"), lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.select(
        key, F.size(f"`{into}`.runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col(f"`{into}`.collapsed").cast("binary"), 256).alias("collapsed_sha256"))
