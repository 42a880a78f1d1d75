"""Quality rules whose thresholds are learned from the corpus, per language and source.

Signals are array and string expressions of one row, so no word leaves its row. Their
distributions are held in KLL quantile sketches per (language, source); sketches are merged over
slots first, so no task reads one sketch per input split, then upwards to the language and to the
corpus. A document is judged by the smallest group around it that has MIN_GROUP documents.

A threshold is a fence: the upper quartile plus FENCE times its distance from the median, at least
the signal's slack above the quartile. A fence adapts to each group and, unlike a fixed share, removes nobody
from a group without outliers. Slack keeps a constant signal from rejecting tiny departures.

Signals (upper fence each): symbols per word, share of repeated lines, share of words in repeated
5-word windows, capitals per letter, exclamation marks per word, characters per word; characters per word also
has a lower fence. Documents that fail the base rule are not counted in the sketches.

Defined cases: null or wordless text has no words and fails; null language or source is a group of
its own; ties and repeated rows are judged alike; an empty table gives an empty result; other
columns are ignored. Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.common import WORD, Scratch, bind, same, small, text_of, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5                  # words
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_GROUP = 200             # documents a group needs to have thresholds of its own
FENCE = 3.0
SKETCH_K = 400
SLOTS = 64
SIGNALS = {                 # name -> (expression over the base columns, slack)
    "symbol_rate": ("n_symbols / greatest(n_words, 1)", 0.20),
    "dup_line_rate": ("n_dup_lines / greatest(n_lines, 1)", 0.50),
    "repeat_rate": ("n_repeat_words / greatest(n_words, 1)", 0.20),
    "capital_rate": ("n_capitals / greatest(word_chars, 1)", 0.25),
    "bang_rate": ("n_bangs / greatest(n_words, 1)", 0.20),
    "mean_word": ("word_chars / greatest(n_words, 1)", 4.0),
}


def repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window found at least twice in the text.

    Windows are hashed first: distinct hashes mean distinct windows. Only a text with equal hashes
    sorts its windows by hash, and neighbours of equal hash are compared by their words.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]))

    def covered(ordered: Column) -> Column:
        def equal(x: Column, y: Column) -> Column:
            return (x["h"] == y["h"]) & (F.slice(words, x["i"] + 1, WINDOW) == F.slice(words, y["i"] + 1, WINDOW))

        repeated = F.filter(ordered, lambda x, j: (
            ((j > 0) & equal(x, F.get(ordered, j - 1))) | equal(x, F.get(ordered, j + 1))))
        # A window adds its words less those that the window before it covers.
        return bind(F.array_sort(F.transform(repeated, lambda x: x["i"])), lambda s: F.aggregate(
            F.transform(s, lambda p, j: F.when(j == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get(s, j - 1)))),
            F.lit(0), lambda a, x: a + x))

    def counted(h: Column) -> Column:
        in_order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(in_order, covered))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bind(hashes, counted)).cast("long")


def _base(text: Column) -> Column:
    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        return F.struct(
            bind(words_of(t), lambda w: F.struct(
                F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
                repeat_words(w).alias("repeated"))).alias("words"),
            bind(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))
                 ).alias("lines"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(t, F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(t, F.lit("!")).cast("long").alias("n_bangs"),
        )

    return bind(text, counts)       # one value, which the optimizer does not copy into each use


def signals(docs: DataFrame, text: str = "text", into: str = "__quality") -> DataFrame:
    """The rows with one more column, a struct of base counts, ``base_failed`` and rates."""
    counted = docs.withColumn(into, _base(text_of(text)))
    counts = {k: F.col(f"{into}.{c}") for k, c in {
        "n_words": "words.n", "word_chars": "words.chars", "n_symbols": "n_symbols", "n_lines": "lines.n",
        "n_dup_lines": "lines.dup", "n_repeat_words": "words.repeated", "n_capitals": "n_capitals",
        "n_bangs": "n_bangs"}.items()}
    flat = counted.withColumn(into, F.struct(*[c.alias(k) for k, c in counts.items()]))
    failed = F.expr(f"{into}.n_words < {MIN_WORDS} OR 100 * {into}.n_repeat_words > "
                    f"{MAX_REPEAT_PERCENT} * {into}.n_words")
    rates = F.struct(*[F.col(f"{into}.{c}") for c in counts], failed.alias("base_failed"))
    return flat.withColumn(into, rates)


def _rate(name: str, into: str = "__quality") -> Column:
    expression = SIGNALS[name][0]
    for c in ("n_symbols", "n_words", "n_dup_lines", "n_lines", "n_repeat_words", "n_capitals", "n_bangs", "word_chars"):
        expression = expression.replace(c, f"{into}.{c}")
    return F.expr(expression).cast("double")


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Fences per (lang, source): one row a group, from merged sketches.

    ``measured`` holds the struct of ``signals``. Groups below MIN_GROUP documents use the sketch of
    their language, languages below it that of the corpus.
    """
    spark = measured.sparkSession
    per_slot = (measured.where("NOT __quality.base_failed")
                .groupBy(F.col(lang).alias("lang"), F.col(source).alias("source"),
                         F.pmod(F.spark_partition_id(), F.lit(SLOTS)).alias("slot"))
                .agg(F.count("*").alias("n"),
                     *[F.kll_sketch_agg_double(_rate(s), F.lit(SKETCH_K)).alias(s) for s in SIGNALS]))

    def merged(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(s).alias(s) for s in SIGNALS])

    scratch = Scratch(spark, "quality")
    groups = scratch.write(merged(per_slot, "lang", "source"), "groups")
    # Sources of a language can be many: fold them by slots once more before the last merge.
    folded = merged(groups.withColumn("slot", F.pmod(F.xxhash64("source"), F.lit(SLOTS))), "lang", "slot")
    languages = scratch.write(merged(folded, "lang"), "languages")
    corpus = merged(languages.withColumn("slot", F.pmod(F.xxhash64("lang"), F.lit(SLOTS))), "slot")
    corpus = corpus.groupBy().agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(s).alias(s) for s in SIGNALS])
    everyone = corpus.where("n > 0").collect()          # one row: a count and six sketches
    if not everyone:
        return groups.select("lang", "source", *[F.lit(None).cast("double").alias(c) for s in SIGNALS
                                                 for c in (f"{s}_low", f"{s}_high")])

    def fences(sketch: Column, s: str) -> Column:
        q = F.kll_sketch_get_quantile_double(sketch, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        low, mid, high, slack = F.get(q, 0), F.get(q, 1), F.get(q, 2), F.lit(SIGNALS[s][1])
        return F.struct((low - F.greatest(slack, FENCE * (mid - low))).alias("low"),
                        (high + F.greatest(slack, FENCE * (high - mid))).alias("high"))

    names = {s: f"__lang_{s}" for s in SIGNALS}
    of_lang = languages.select(F.col("lang").alias("__lang"), F.col("n").alias("__lang_n"),
                               *[F.col(s).alias(a) for s, a in names.items()])
    of_lang = small(of_lang)
    both = groups.join(of_lang, groups["lang"].eqNullSafe(of_lang["__lang"]))

    def pick(s: str) -> Column:
        return (F.when(F.col("n") >= MIN_GROUP, F.col(s)).when(F.col("__lang_n") >= MIN_GROUP, F.col(names[s]))
                .otherwise(F.lit(everyone[0][s])))

    found = both.select("lang", "source", *[fences(pick(s), s).alias(s) for s in SIGNALS])
    return found.select("lang", "source", *[F.col(f"{s}.{e}").alias(f"{s}_{e}") for s in SIGNALS for e in ("low", "high")])


def judged(measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The measured rows with ``__kept``: joined with their group's fences, within all of them.

    A row without a group (all of its group failed the base rule) is rejected by that rule itself.
    """
    named = fences.select(F.col("lang").alias("__g_lang"), F.col("source").alias("__g_source"),
                          *[F.col(c).alias(f"__g_{c}") for c in fences.columns if c not in ("lang", "source")])
    named = small(named)
    both = measured.join(named, same(measured, named, [(lang, "__g_lang"), (source, "__g_source")]), "left")
    inside = F.lit(True)
    for s in SIGNALS:
        inside = inside & (_rate(s) <= F.coalesce(F.col(f"__g_{s}_high"), F.lit(float("inf"))))
    inside = inside & (_rate("mean_word") >= F.coalesce(F.col("__g_mean_word_low"), F.lit(0.0)))
    return both.withColumn("__kept", ~F.col("__quality.base_failed") & inside).drop(
        *[c for c in named.columns])


def quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """One row per input row: id, base counts, base_failed, kept. Texts are read once."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
                       F.col(source).alias("source"))
    measured = Scratch(docs.sparkSession, "quality").write(signals(rows).drop("text"), "signals")
    return judged(measured, thresholds(measured)).select(
        "doc_id", *[f"__quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                               "base_failed")], F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that pass, with all their columns.

    Signals are measured twice, for the thresholds and for the verdict, so that texts are never
    shuffled or written.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.write(signals(rows).drop("text"), "signals")
    fences = scratch.write(thresholds(measured), "fences")
    return (judged(signals(docs, text), fences, lang, source).where("__kept")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
