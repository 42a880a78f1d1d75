"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all training rows: tasks sum them over hashed n-grams, a fixed number of
buckets. The classifier is fitted on a bounded sample, about SAMPLE rows spread evenly over the
languages, by follow-the-regularised-leader with an elastic net, which leaves most weights at zero. A
temperature fitted on a part of the sample that was not trained on makes probabilities honest. Weights
are languages x buckets, and are broadcast; languages are bounded by MAX_LANGUAGES.

Defined cases: null text, and text without a letter, is ``und`` with score 0; rows without a language are not
learned from; without any labelled row everything is ``und``; repeated rows count each; an empty
table gives an empty result; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.hashing import constants, mixed

BITS = 15
BUCKETS = 1 << BITS
ORDERS = 3                  # n-grams of 1 to 3 characters
SAMPLE = 4000               # rows the classifier is fitted on, all languages together
MAX_LANGUAGES = 500
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
EPOCHS = 2
PIECE = 1 << 16             # characters hashed at a time
_STEPS = constants("gram", ORDERS)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the character n-grams of a text in lower case."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(codes), PIECE):
        part = codes[start:start + PIECE + ORDERS - 1].astype(np.uint64)
        own = min(PIECE, len(codes) - start)        # n-grams that start in this piece
        summed = np.zeros(len(part), np.uint64)
        for n in range(ORDERS):
            if len(part) <= n:
                break
            summed = summed[:len(part) - n] + part[n:] * _STEPS[n]
            places = mixed(summed[:own] + np.uint64(n)) >> np.uint64(64 - BITS)
            total += np.bincount(places.astype(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


def weighted(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length, with damped counts."""
    x = (1 + np.log(counts)) * idf[used]
    length = math.sqrt(float(x @ x))
    return x / length if length else x


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            if text:
                seen[grams(text)[0]] += 1
                rows += 1
    used = np.flatnonzero(seen)
    yield pd.DataFrame({"bucket": np.append(used, -1), "n": np.append(seen[used], rows)})


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [grams(t) for t in batch["text"]]
        yield pd.DataFrame({"lang": batch["lang"], "used": [u.astype(np.int32) for u, _ in found],
                            "counts": [c.astype(np.int32) for _, c in found]})


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int) -> np.ndarray:
    """Weights (k, BUCKETS) by FTRL-proximal with per-coordinate rates; L1 zeroes, L2 shrinks."""
    z, n = np.zeros((k, BUCKETS)), np.zeros((k, BUCKETS))

    def weights(zs, ns):
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            used, x = rows[i]
            zs, ns = z[:, used], n[:, used]
            w = weights(zs, ns)
            p = softmax(w @ x)
            p[labels[i]] -= 1
            g = np.outer(p, x)
            grown = ns + g * g
            z[:, used] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[:, used] = grown
    return weights(z, n)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of scores with the least log loss."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean()

    return float(min(np.geomspace(0.02, 20, 121), key=loss))


def fit(training: DataFrame, sample: int = SAMPLE):
    """(languages, idf, weights, temperature) from rows (lang, text)."""
    known = training.where("lang IS NOT NULL AND text IS NOT NULL")
    sums = known.select("text").mapInPandas(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen, rows = np.zeros(BUCKETS), 0
    for row in sums.collect():                  # at most BUCKETS + 1 rows
        if row["bucket"] < 0:
            rows = row["n"]
        else:
            seen[row["bucket"]] = row["n"]
    idf = np.log((1 + rows) / (1 + seen)) + 1
    per_lang = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not per_lang:
        return [], idf, np.zeros((0, BUCKETS)), 1.0
    langs = sorted(r["lang"] for r in per_lang)
    each = max(1, sample // len(langs))
    share = F.create_map(*[x for r in per_lang for x in (F.lit(r["lang"]), F.lit(min(1.0, each / r["count"])))])
    drawn = F.pmod(F.xxhash64(F.lit(5), F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)
    picked = known.where(drawn < share[F.col("lang")]).select("lang", "text").mapInPandas(
        _vectors, "lang string, used array<int>, counts array<int>").toArrow()
    code = {lang: i for i, lang in enumerate(langs)}
    labels = np.array([code[x] for x in picked["lang"].to_pylist()], dtype=np.int64)
    vectors = []
    for used, counts in zip(picked["used"], picked["counts"]):
        used = np.asarray(used.values)
        vectors.append((used, weighted(used, np.asarray(counts.values), idf)))
    check = np.random.default_rng(3).random(len(labels)) < 0.2
    if not check.any() or check.all():
        check[:] = False
    weights = fit_ftrl([v for v, c in zip(vectors, check) if not c], labels[~check], len(langs))
    scores = np.array([weights[:, v[0]] @ v[1] for v, c in zip(vectors, check) if c]).reshape(-1, len(langs))
    return langs, idf, weights, fit_temperature(scores, labels[check])


def held_out(id_col: str) -> Column:
    """Documents that are not learned from, by a hash of their id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
             out: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``out`` tells the rows not learned from, by default ``held_out(id_col)``. Predictions read the text only.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"),
                       (held_out(id_col) if out is None else out).alias("held_out"))
    langs, idf, weights, temperature = fit(rows.where("NOT held_out").select("lang", "text"), sample)
    model = docs.sparkSession.sparkContext.broadcast(
        (langs, idf.astype(np.float32), weights.astype(np.float32), temperature))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, idf, weights, temperature = model.value
        for batch in batches:
            found = []
            for text in batch["text"]:
                if not langs or not has_letter(text):
                    found.append(("und", 0.0))
                    continue
                used, counts = grams(text)
                p = softmax(weights[:, used] @ weighted(used, counts, idf) / temperature)
                found.append((langs[int(p.argmax())], min(1.0, float(p.max()))))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                                "lang_pred": [x for x, _ in found], "score": [s for _, s in found]})

    return rows.select("doc_id", "held_out", "text").mapInPandas(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")
