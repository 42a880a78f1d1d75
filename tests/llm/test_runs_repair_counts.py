"""Periodic runs, conversation repair and token counts against brute force, on awkward rows."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from winnow.llm import conversations, periodic, piece_counts, queries, warc
from winnow.llm.common import Scratch

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, periodic string, n_tokens string, `__first` int, h int"


# Periodic runs

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_periodic(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(5)
    for _ in range(1500):
        k = rng.choice([1, 2, 3, 4, 8])
        words = [rng.randrange(k) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            part = [rng.randrange(k) for _ in range(rng.randint(1, 10))]
            words += (part * rng.randint(2, 9))[:rng.randint(5, 90)] + [rng.randrange(k + 3) for _ in range(rng.randint(0, 4))]
        assert periodic.runs_of(words) == brute_runs(words)


def test_segments_keep_runs_and_drop_rare_words():
    words = [100, 101] + [1, 2] * 4 + [102] + [3] * 5 + [103] + [1, 2, 4] * 3
    codes = periodic.np.array(words)
    assert periodic.segments(codes) == [(2, 10)]


def test_a_word_repeated_two_hundred_thousand_times():
    assert periodic.runs_of(["w"] * 200_000) == [(0, 200_000, 1)]
    assert periodic.runs_of(["a", "b", "c"] * 70_000 + ["d"]) == [(0, 210_000, 3)]


def test_periodic_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r["doc_id"]: brute_periodic(*r) for r in rows}
    assert sum(v[0] > 0 for v in got.values()) > 5


def test_periodic_awkward_rows(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "é\tb é b é b é b\x0bx", "x y " * 30 + "z z z z z z " + "p q r " * 9]
    rows = [(i, t, "x", "y", i, 0) for i, t in enumerate(texts)] + [(4, texts[4], "x", "y", 4, 0), (None, texts[5], *"xy", 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    found = periodic.periodic_runs(docs, into="found")
    assert found.columns == docs.columns + ["found"]
    for r in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        assert [tuple(x) for x in r["found"]["runs"]] == brute_runs(words)
        assert (r["found"]["strongest"] is None) == (not brute_runs(words))
    six = found.where("doc_id = 6").first()["found"]
    assert tuple(six["strongest"]) == (0, 60, 2) and six["collapsed"] == "x y z p q r"
    assert periodic.digest(periodic.periodic_runs(docs.limit(0))).count() == 0


# Conversation repair

def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def brute_edits(rows):
    """Cheapest edits of (initial, fault) rows, forwards: per state the least (cost, edits)."""
    def insert(best):
        for _ in range(4):
            for s, t in ((0, 2), (1, 2), (2, 3), (3, 2)):
                if s in best:
                    longer = (best[s][0] + 5, best[s][1] + "I")
                    best[t] = min(best.get(t, longer), longer)
        return best

    best = insert({0: (0, "")})
    for initial, fault in rows:
        new = {}
        for s, (cost, edits) in best.items():
            nxt = {0: 2, 1: 2, 2: 3, 3: 2}[s]
            ways = [(2, "D", s)]
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                ways.append((1 + more, "R", nxt))
                if initial == {2: "u", 3: "a"}[nxt]:
                    ways.append((more, "K", nxt))
                if initial == "s" and s == 0:
                    ways.append((more, "K", 1))
            for c, e, t in ways:
                new[t] = min(new.get(t, (cost + c, edits + e)), (cost + c, edits + e))
        best = insert(new)
    return min(best[s] for s in (0, 3) if s in best)


def brute_audit(conv, rows):
    """All results of one conversation whose rows are damaged and in order."""
    seen, faults, before = set(), [], None
    illegal = 0
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen
                      else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
        illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
        before = role[:1]
    turns = {t for _, t, _, _ in rows if t is not None}
    cost, edits = brute_edits([(r[2][:1], f) for r, f in zip(rows, faults)])
    at, out = iter(rows), []
    for e in edits:
        row = None if e == "I" else next(at)
        if e == "D":
            continue
        nxt = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((row[2] if e == "K" else nxt, row[3] if row else ""))
    initials = "".join(role[:1] for role, _ in out)
    assert re.fullmatch("(s?(ua)+)?", initials)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (
        "blank", "duplicate", "truncated")), illegal, cost, edits, sha)


def expected(rows):
    damaged, groups = brute_damage(rows), {r[0]: [] for r in rows}
    for r in damaged:
        groups[r[0]].append(r)
    digest = {id(r): hashlib.md5(r[3].encode()).digest() for r in damaged}
    return {conv: brute_audit(conv, sorted(g, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest[id(r)])))
            for conv, g in groups.items()}


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r) for r in queries.op12_conversation_repair(spark, SF_SMALL).collect()}
    assert got == expected(rows)


def made_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = [None, "", " \t", "Yes.", "No!", "cut off", "Why? ", "é.", "."]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts) or str(rng.random()))
            for c in [None, *range(convs)] for _ in range(rng.randint(1, longest))]
    return rows + [(convs + 1, None, None, None), (convs + 2, 3, "user", None)]


def audited(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", F.lit(1).alias("chunk"), F.lit("x").alias("symbols"), F.lit("k").alias("kind"))
    return {r[0]: tuple(r) for r in conversations.audit(df.repartition(5)).collect()}


def test_repair_of_awkward_rows(spark):
    rows = made_rows(1, 120, 9)
    assert audited(spark, rows) == expected(rows)
    assert audited(spark, []) == {}


def test_repair_of_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Good.", "cut", ""]) + f" {t}.") for t in range(6000)]
    rows += [(8, t, "user", f"cut {t}") for t in range(6000)]      # all go: the chunks' costs never agree
    assert audited(spark, rows) == expected(rows)


@pytest.mark.parametrize("passes", [0, 1, 6])
def test_costs_converge_whatever_the_passes(spark, passes):
    rng = random.Random(3)
    parts = ["".join(rng.choice("ADGBEHCJ") for _ in range(rng.randint(1, 4))) for _ in range(9)]
    parts += ["F" * 3, "C"] * 5 + ["DG", "E"]
    chunks = spark.createDataFrame([(1, i, p) for i, p in enumerate(parts)], "conv long, chunk long, symbols string")
    got = {r["chunk"]: tuple(r["ending"]) for r in conversations.converge(
        chunks, Scratch(spark, "test"), passes).collect()}
    vector = conversations.END
    for i in reversed(range(len(parts))):
        assert tuple(v - min(vector) for v in vector) == got[i]
        vector, _ = conversations.backwards(parts[i], vector)


# Token counts

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(library):
    rng = random.Random(6)
    texts = ["", " ", "the  the" + " " * 40 + "x" + " " * 33, " " * 100, "\n" * 50 + "\t x", "a" * 5000, "ab" * 3000,
             "<s> </s> <0x41> <unk>", "▁▁x ▁y", "日本語のテキスト" * 50, "é ü 𝔘𝔫 🙂" * 20, "\x00a", "the" * 999]
    texts += ["".join(rng.choice("ab the in er on  _-=▁\n.é日") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts += ["".join(rng.choice(alphabet) for _ in range(1500)) for _ in range(20)]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 90))) for _ in range(200)]
    counter = piece_counts.Counter(piece_counts.Pieces(MODEL))
    want = [len(ids) for ids in library.encode(texts)]
    assert counter.counts(texts).tolist() == want
    assert counter.counts(texts).tolist() == want       # from the kept counts


def test_counts_in_small_slices_and_with_little_room(library, monkeypatch):
    monkeypatch.setattr(piece_counts, "SLICE_CHARS", 50)
    monkeypatch.setattr(piece_counts, "KEPT_BYTES", 3000)
    rng = random.Random(8)
    texts = ["".join(rng.choice(["the", "  ", " x", "\n", " and ", "é", "zq"]) for _ in range(300)) for _ in range(30)]
    counter = piece_counts.Counter(piece_counts.Pieces(MODEL))
    assert counter.counts(texts).tolist() == [len(ids) for ids in library.encode(texts)]


def test_counts_of_rows(spark, library):
    rows = [(1, None, "x", "y", 1, 1), (2, "two words", "x", "y", 1, 1), (2, "two words", "x", "y", 1, 1), (None, "", *"xy", 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = piece_counts.token_counts(docs, MODEL, into="n")
    assert got.columns == docs.columns + ["n"]
    assert sorted(r["n"] for r in got.collect()) == [0, 0, 2, 2]
    assert piece_counts.token_counts(docs.limit(0), MODEL).count() == 0


def test_count_query_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {i: len(library.encode(t or "")) for i, t in rows}
    got = queries.op13_token_counts(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert {r["doc_id"]: r["n_bytes"] for r in got} == {i: len((t or "").encode()) for i, t in rows}


def test_models_of_other_kinds_are_refused(tmp_path):
    model = piece_counts.model_format.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.byte_fallback = False
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piece_counts.Pieces(str(tmp_path / "other.model"))


# Damaged and foreign archives

def test_complete_records_of_a_damaged_archive_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i} WARC/1.1\r\n</p>") for i in range(5)],
                                  "page_id long, url string, html string").coalesce(1)
    warc.write(pages, f"{tmp_path}/whole")
    part, = (tmp_path / "whole").glob("part-*")
    raw = part.read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "crawl-0001.warc").write_bytes(raw[:-40])          # the last record is truncated
    found = warc.read(spark, f"{tmp_path}/cut")
    assert sorted(r["page_id"] for r in found.collect()) == [0, 1, 2, 3]
    tail, = warc.broken_tails(found).collect()
    assert tail["size"] == len(raw) - 40 and tail["end"] < tail["size"]
    assert warc.broken_tails(warc.read(spark, f"{tmp_path}/whole")).count() == 0


def test_archives_are_rolled_by_the_largest_payload(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = spark.createDataFrame([(i, None, "x" * 1000 + str(i)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    warc.write(pages, f"{tmp_path}/a")
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) == 14 and max(f.stat().st_size for f in files) < 20_000
    assert warc.read(spark, f"{tmp_path}/a").count() == 40
