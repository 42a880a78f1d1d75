"""The corpus operators as queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.llm import (
    bpe, conversations, exact_dedup, langid, lm, mixing, near_dedup, periodic, piece_counts, pii, quality, secrets, warc)
from winnow.llm.common import text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark, sf_dir):
    return near_dedup.near_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op2_quality_rules(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.secrets(documents(spark, sf_dir)))


def op4_personal_data(spark, sf_dir):
    return pii.digest(pii.personal(documents(spark, sf_dir)))


def op5_lm_scores(spark, sf_dir):
    return lm.score(documents(spark, sf_dir))


def op6_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language_id(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


def op8_mixing(spark, sf_dir):
    return mixing.queue(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op10_byte_bpe(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).select("doc_id", "bpe.*")


def op11_periodic_runs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic.digest(periodic.periodic_runs(docs.select("doc_id", periodic.planted(text_of("text"), h).alias("text"))))


def op12_conversation_repair(spark, sf_dir):
    return conversations.audit(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_token_counts(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", text_of("text").alias("text"))
    counted = piece_counts.token_counts(docs, public_tokenizers.path(PIECES))
    return counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_secret_scan": op3_secret_scan,
    "op4_personal_data": op4_personal_data,
    "op5_lm_scores": op5_lm_scores,
    "op6_warc": op6_warc,
    "op7_language_id": op7_language_id,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_counts": op13_token_counts,
}

# CRC-32 of an ASCII text: the table from its rule, then byte by byte.
CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def crc_sql(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1),
        lambda i: CAST(ascii(substr({text}, CAST(i AS INTEGER), 1)) AS BIGINT))),
        lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295::BIGINT)"""


PERIODIC_SQL = rf"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        {crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
e AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM e),
x AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS own, a, 1 + (n - a) // (3 + g % 8) AS p FROM f),
words AS (SELECT x.doc_id, x.i, CASE WHEN x.i >= x.a THEN y.own ELSE x.own END AS word
          FROM x LEFT JOIN x y ON x.i >= x.a AND y.doc_id = x.doc_id AND y.i = x.a + (x.i - x.a) % x.p),
often AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, word) AS k FROM words) WHERE k >= 4),
parts AS (SELECT doc_id, word, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS part FROM often),
sized AS (SELECT doc_id, part, min(i) AS low, count(*) AS m FROM parts GROUP BY 1, 2 HAVING count(*) >= 6),
lags AS (SELECT doc_id, part, low, m, unnest(range(1, m // 4 + 1)) AS q FROM sized),
places AS (SELECT doc_id, part, low, m, q, low + unnest(range(0, m - 3 * q, q)) AS at FROM lags),
may AS (SELECT DISTINCT s.doc_id, s.low, s.m, s.q FROM places s
        JOIN words b ON b.doc_id = s.doc_id AND b.i = s.at JOIN words c ON c.doc_id = s.doc_id AND c.i = s.at + s.q AND c.word = b.word
        JOIN words v ON v.doc_id = s.doc_id AND v.i = s.at + 2 * s.q AND v.word = b.word
        JOIN words z ON z.doc_id = s.doc_id AND z.i = s.at + 3 * s.q AND z.word = b.word),
same AS (SELECT t.doc_id, t.low, t.q, b.i FROM may t JOIN words b ON b.doc_id = t.doc_id AND b.i >= t.low AND b.i + t.q < t.low + t.m
         JOIN words c ON c.doc_id = t.doc_id AND c.i = b.i + t.q AND c.word = b.word),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
              FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, low, q ORDER BY i) AS o FROM same) GROUP BY doc_id, low, q, o),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY 1, 2, 3),
best AS (SELECT doc_id, count(*) AS n_runs, first(start ORDER BY length / period DESC, start, period) AS start,
           first(length ORDER BY length / period DESC, start, period) AS length,
           first(period ORDER BY length / period DESC, start, period) AS period,
           sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
         FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT b.doc_id, b.i FROM runs r JOIN words b ON b.doc_id = r.doc_id AND b.i >= r.start + r.period
         AND b.i < r.start + r.length),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT f.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM f LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _edit(state: str, cost: str, initial: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{initial}'}}"


def _when(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} ELSE {NEVER} END"


NEVER = "{'c': 1000000000000::BIGINT, 'e': ''}"
OPEN, STAYS = "fault < 2", "5 * fault"
AFTER_ROW = {        # the least (cost, edits) of each state once a row is dealt with
    0: _edit("a0", "2", "D"),
    1: _least(_edit("a1", "2", "D"), _when(f"{OPEN} AND initial = 's'", _edit("a0", STAYS, "K"))),
    2: _least(_edit("a2", "2", "D"), *[_when(OPEN, _edit(a, f"1 + {STAYS}", "R")) for a in ("a0", "a1", "a3")],
              *[_when(f"{OPEN} AND initial = 'u'", _edit(a, STAYS, "K")) for a in ("a0", "a1", "a3")]),
    3: _least(_edit("a3", "2", "D"), _when(OPEN, _edit("a2", f"1 + {STAYS}", "R")),
              _when(f"{OPEN} AND initial = 'a'", _edit("a2", STAYS, "K"))),
}
REPAIR_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, {crc_sql("key")} % 20 AS h FROM b, crc),
dam AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
          CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
          unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE h <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
              left(role, 1) AS initial, regexp_replace(text, '[ 	-]', '', 'g') AS solid FROM dam),
marked AS (SELECT *, solid = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             right(solid, 1) NOT IN ('.', '!', '?') AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
f AS MATERIALIZED (SELECT *, CASE WHEN blank OR again THEN 2 WHEN cut THEN 1 ELSE 0 END AS fault FROM marked),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
            count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE fault = 1) AS truncated,
            count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'e': ''}} AS a0, {NEVER} AS a1, {{'c': 5::BIGINT, 'e': 'I'}} AS a2,
         {{'c': 10::BIGINT, 'e': 'II'}} AS a3 FROM facts
  UNION ALL
  SELECT conv_id, i, n0, n1, {_least("m2", _edit("m3", "5", "I"))}, m3 FROM (
    SELECT *, {_least("n3", _edit("m2", "5", "I"))} AS m3 FROM (
      SELECT *, {_least("n2", _edit("n0", "5", "I"), _edit("n1", "5", "I"), _edit("n3", "5", "I"))} AS m2 FROM (
        SELECT s.conv_id, f.i, {", ".join(f"{e} AS n{k}" for k, e in AFTER_ROW.items())}
        FROM steps s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1)))),
done AS (SELECT s.conv_id, {_least("a0", "a3")} AS best FROM steps s JOIN facts g ON g.conv_id IS NOT DISTINCT FROM s.conv_id AND g.n = s.i),
letters AS (SELECT conv_id, unnest(range(1, length(best.e) + 1)) AS p, unnest(string_split(best.e, '')) AS edit FROM done WHERE best.e <> ''),
placed AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
             count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) - 1 AS j FROM letters),
turns AS (SELECT l.conv_id, l.p, l.j, l.edit, f.role, CASE WHEN l.edit = 'I' THEN '' ELSE f.text END AS text,
            max(CASE WHEN l.j = 0 AND l.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
          FROM placed l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE l.edit <> 'D'),
repaired AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - led) % 2 = 0 THEN 'user' ELSE 'assistant' END
               || ':' || text, chr(10) ORDER BY p)) AS sha FROM turns GROUP BY conv_id)
SELECT c.conv_id, coalesce(g.gaps, 0) AS gaps, coalesce(g.blank, 0) AS blank, coalesce(g.duplicate, 0) AS duplicate,
       coalesce(g.truncated, 0) AS truncated, coalesce(g.illegal, 0) AS illegal, coalesce(d.best.c, 0) AS cost,
       coalesce(d.best.e, '') AS audit, coalesce(r.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id"""

SQL = {
    "op11_periodic_runs": PERIODIC_SQL,
    "op12_conversation_repair": REPAIR_SQL,
    "op9_exact_dedup": r"""
        WITH n AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        w AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                     first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w""",
}
