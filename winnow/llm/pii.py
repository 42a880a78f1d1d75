"""Personal data by weak supervision.

Candidate spans are the base kinds, found by fixed patterns, and looser shapes (local phone numbers,
social security numbers, bank account numbers, spelled-out addresses). Labelers of three sorts, patterns,
gazetteers and context words, vote on each candidate or abstain. Expectation-maximisation over
the counts of vote patterns, a bounded table, estimates how reliable each labeler is without any gold
label. The posteriors train a span classifier, a logistic regression on votes, shape and context, on
at most SAMPLE candidates; it decides which looser spans are added. Base spans always stay.

Texts are read once, by linear-time patterns; votes and features stay in their row, and the
classifier is applied to them as an array expression.

Defined cases: null or empty text has no spans; ties and repeated rows are scanned alike; without any
candidate nothing is trained; an empty table gives an empty result; other columns are ignored. Whole texts
are scanned, in code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.common import Scratch
from winnow.llm.secrets import in_order

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("local_phone", "ssn", "iban", "spelled_email")
SAMPLE = 5000               # candidates the classifier is trained on
CONTEXT = 40                # characters looked at on either side
HASHED = 16                 # buckets of context words
ROUNDS = 50

# The base patterns, written so that no text takes quadratic time. A run of digits that
# fails from its start fails from every later start, hence the look-behind and possessive repeats.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = {
    "local_phone": re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "spelled_email": re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9_]{2,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{2,64} ?[(\[]dot[)\]] ?[A-Za-z]{2,10}"),
}
# Gazetteers and context words.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be se no dk pl ru jp cn in br".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
           "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
           "86", "90", "91", "92", "93", "94", "95", "98")
ISSUERS = ("34", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "2")
IBAN_LANDS = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
FOR_WORDS = re.compile(r"(?i)\b(?:e-?mail|mail|contact|call|phone|tel|fax|mobile|ip|address|host|card|credit|visa|pay|ssn|"
                       r"social|iban|account|konto|write|reach|correo|courriel|telefon|tel[eé]fono)\b")
AGAINST_WORDS = re.compile(r"(?i)\b(?:version|release|isbn|issn|order|invoice|figure|page|section|chapter|build|example|"
                           r"sample|test|dummy|invalid|total|sum|id)\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the run before an @ with a domain after it, from the last match on."""
    floor = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            floor = m.end()
            yield start, floor


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def loose_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser candidates that touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate(np.array([b for _, b in taken])) if taken else starts
    found = []
    for kind, pattern in LOOSE.items():
        for m in pattern.finditer(text):
            before = np.searchsorted(starts, m.end()) - 1       # the last base span that starts before the end
            if before < 0 or ends[before] <= m.start():
                found.append((kind, *m.span()))
    return found


def votes(kind: str, text: str, start: int, end: int) -> str:
    """One letter per labeler: y for personal data, n against, - for no opinion."""
    value, digits = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    # Pattern: a stricter shape.
    if kind == "email":
        strict = value[0] not in ".%+-" and ".." not in value and value.rsplit(".", 1)[1].isalpha()
    elif kind == "ip":
        strict = not any(p != "0" and p[0] == "0" for p in value.split(".")) and value.split(".")[0] not in ("0", "127", "255")
    elif kind == "card":
        strict = len(digits) in (14, 15, 16)
    elif kind in ("phone", "local_phone"):
        strict = 10 <= len(digits) <= 13
    elif kind == "ssn":
        strict = digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    elif kind == "iban":
        packed = value.replace(" ", "")
        strict = 15 <= len(packed) <= 34 and int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1
    else:
        strict = value.count("(") + value.count("[") == 2
    # Gazetteer: known endings, codes, issuers, lands.
    if kind in ("email", "spelled_email"):
        listed = re.split(r"[ .)\]]", value)[-1].lower() in ENDINGS
    elif kind == "ip":
        listed = not value.startswith(("10.", "192.168.", "224.", "239."))
    elif kind == "card":
        listed = digits.startswith(ISSUERS)
    elif kind == "phone":
        listed = digits.startswith(CALLING)
    elif kind == "iban":
        listed = value[:2] in IBAN_LANDS
    else:
        listed = None
    # Context: words for and against, and whether the span stands by itself.
    speaks_for = True if FOR_WORDS.search(before) else None
    speaks_against = False if AGAINST_WORDS.search(before) else None
    alone = not (before[-1:].isalnum() or before[-1:] in tuple("/=#_.") or after[:1].isalnum() or after[:1] in tuple("/=#_"))
    varied = None if not digits else len(set(digits)) > 2
    return "".join({True: "y", False: "n", None: "-"}[v] for v in (strict, listed, speaks_for, speaks_against, alone, varied))


LABELERS = 6


def features(kind: str, text: str, start: int, end: int, pattern: str) -> list[float]:
    """Votes, kind, shape, and the words around, hashed."""
    value = text[start:end]
    x = [1.0] + [float(kind == k) for k in KINDS] + [{"y": 1.0, "n": -1.0, "-": 0.0}[v] for v in pattern]
    x += [min(len(value), 40) / 40, len(digits_of(value)) / max(1, len(value))]
    around = [0.0] * HASHED
    for word in re.findall(r"\w+", text[max(0, start - CONTEXT):start].lower())[-3:]:
        around[xxhash.xxh32_intdigest(word) % HASHED] = 1.0
    return x + around


WIDTH = 1 + len(KINDS) + LABELERS + 2 + HASHED
FOUND = ("doc_id long, spans array<struct<kind:string,rank:int,start:int,end:int,votes:string,x:array<double>>>")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch["text"]:
            text = text or ""
            base = base_spans(text)
            rows = []
            for kind, start, end in base + loose_spans(text, base):
                pattern = votes(kind, text, start, end)
                rows.append({"kind": kind, "rank": KINDS.index(kind), "start": start, "end": end, "votes": pattern,
                             "x": features(kind, text, start, end, pattern)})
            out.append(rows)
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": out})


def estimate(patterns: list[tuple[str, str, int]]) -> dict[tuple[str, str], float]:
    """Posterior of each (kind, votes), by EM over labeler reliabilities and a prior per kind."""
    if not patterns:
        return {}
    letters = np.array([["yn-".index(v) for v in p] for _, p, _ in patterns])
    kinds = np.array([KINDS.index(k) for k, _, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    # Start from the votes as they are.
    q = np.clip(((letters == 0).sum(1) + 0.5) / ((letters < 2).sum(1) + 1.0), 0.05, 0.95)
    for _ in range(ROUNDS):
        prior = np.array([(2 + (n * q)[kinds == k].sum()) / (4 + n[kinds == k].sum()) for k in range(len(KINDS))])
        odds = np.log(prior / (1 - prior))[kinds]
        for j in range(LABELERS):
            yes = np.array([1 + (n * q)[letters[:, j] == v].sum() for v in range(3)])
            no = np.array([1 + (n * (1 - q))[letters[:, j] == v].sum() for v in range(3)])
            odds = odds + np.log(yes / yes.sum())[letters[:, j]] - np.log(no / no.sum())[letters[:, j]]
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {(k, p): float(x) for (k, p, _), x in zip(patterns, q)}


def fit_classifier(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def personal(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, base spans, added spans, n_sure (base spans the classifier agrees with)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = Scratch(docs.sparkSession, "pii").write(rows.mapInPandas(_scan, FOUND), "found")
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.x")
    # At most kinds x 3 ^ labelers rows.
    patterns = [(r["kind"], r["votes"], r["n"]) for r in spans.groupBy("kind", "votes").agg(F.count("*").alias("n"))
                .orderBy("kind", "votes").collect()]
    posterior, total = estimate(patterns), sum(n for _, _, n in patterns)
    weights = np.zeros(WIDTH)
    if total:
        drawn = F.pmod(F.xxhash64(F.lit(11), F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)
        picked = spans.where(drawn < min(1.0, 0.9 * sample / total)).limit(sample).collect()
        if picked:
            weights = fit_classifier(np.array([r["x"] for r in picked]),
                                     np.array([posterior[r["kind"], r["votes"]] for r in picked]))
    w = F.array(*[F.lit(float(v)) for v in weights])

    def sure(s: Column) -> Column:
        return F.aggregate(F.zip_with(s["x"], w, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) > 0

    is_base = lambda s: s["rank"] < len(BASE)
    return found.select(
        "doc_id", F.filter("spans", is_base).alias("base"),
        F.filter("spans", lambda s: ~is_base(s) & sure(s)).alias("added"),
        F.size(F.filter("spans", lambda s: is_base(s) & sure(s))).cast("long").alias("n_sure"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(F.encode(in_order(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        in_order(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"), "n_sure")
