"""Quality rules: repetition rules, then a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed n-grams: one of trusted target
rows, one of the whole corpus. A document's score is the mean log ratio of its
n-grams, so long and short texts are judged alike, and it is kept when the score
reaches a threshold. Only DataFrame functions are used.

Defined results: a null or empty text has no words, fails the word rule and goes;
null ids are scored like any other; repeated rows are judged alike, each by
itself; without trusted rows every ratio is 0 and the rules alone decide. Extra
columns, whatever their names, pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import SPACES, constant_array, paired, whole_text, words_of
from caselake.session import written


@dataclass(frozen=True)
class QualityRules:
    """``trusted_rows`` bounds the labelled rows of the target multinomial, the only
    sample; the corpus multinomial counts every document."""

    min_words: int = 20
    max_repeat_percent: int = 30
    buckets: int = 1 << 14
    threshold: float = -0.5
    trusted_rows: int = 20_000


# Words of a repeated window, code points of a short word, places for words
# whose sums are looked up, characters that count as symbols.
WINDOW = 8
SHORT = 64
PLACES = 1 << 16
SYMBOLS = r"[#*$%&|<>]"


def _trigrams(words: Column) -> Column:
    """All character trigrams of ``words``, each word with a blank at both ends, in text order.

    They see case, digits and signs also in words met only once, and common ones are
    well estimated. A substring takes time by its place, so only short words are cut
    by it; long ones are taken apart once.
    """
    join = lambda a, b: F.concat(a, b)

    def grams(word: Column) -> Column:
        short = F.transform(F.sequence(F.lit(1), F.length(word) - 2), lambda i: F.substring(word, i, F.lit(3)))
        chars = F.split(word, "")
        n = F.size(chars) - 2
        two = F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), join)
        return F.when(F.length(word) <= SHORT, short).otherwise(F.zip_with(two, F.slice(chars, F.lit(3), n), join))

    marked = F.transform(words, lambda word: F.concat(F.lit(" "), word, F.lit(" ")))
    return F.flatten(F.transform(marked, grams))


def _slot(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def with_slots(df: DataFrame, buckets: int) -> DataFrame:
    """Add ``slots``: those of all trigrams of ``words``, in text order."""
    return df.withColumn("slots", F.transform(_trigrams(F.col("words")), lambda gram: _slot(gram, buckets)))


def slot_rows(df: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """One row per trigram of ``words``: its ``slot`` and the columns ``keep``.

    Texts of short words only, nearly all, are taken apart by explodes, which Spark
    compiles, where a lambda is interpreted; in the others the trigrams come as arrays
    and each passes as a piece of its own. The outer forms keep Spark from splitting
    every text once more to test for emptiness.
    """
    long = F.exists("words", lambda word: F.length(word) > SHORT - 2)
    taken = F.when(F.col("_cut"), _trigrams(F.col("words"))).otherwise(F.col("words"))
    piece = F.when(F.col("_cut"), F.col("_piece")).otherwise(F.concat(F.lit(" "), "_piece", F.lit(" ")))
    places = F.sequence(F.lit(1), F.length("_piece") - 2)
    return (
        df.select(*keep, "words", long.alias("_cut"))
        .select(*keep, "_cut", taken.alias("_pieces"))
        .select(*keep, "_cut", F.explode_outer("_pieces").alias("_piece"))
        .filter(F.col("_piece").isNotNull())
        .select(*keep, piece.alias("_piece"))
        .select(*keep, "_piece", F.explode_outer(places).alias("_at"))
        .select(*keep, _slot(F.substring("_piece", F.col("_at"), F.lit(3)), buckets).alias("slot"))
    )


def trusted_ids(labels: DataFrame, rows: int) -> DataFrame:
    """Ids labelled good and not toxic, at most ``rows`` of them, chosen by hash."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    return (
        good.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )


def word_counts(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """(word, corpus, target): how often each word occurs in all rows and in the trusted ones.

    Written, as it is read twice. Words are counted inside each task before they are
    shuffled. The trusted ids broadcast are at most ``trusted_rows``.
    """
    trusted = F.broadcast(trusted_ids(labels, rules.trusted_rows).withColumn("_trusted", F.lit(1)))
    words = docs.select("doc_id", words_of(whole_text()).alias("words"))
    marked = words.join(trusted, "doc_id", "left").withColumn("target", F.coalesce("_trusted", F.lit(0)))
    each = marked.select("target", F.explode_outer("words").alias("word")).filter(F.col("word").isNotNull())
    return written(each.groupBy("word").agg(
        F.count(F.lit(1)).alias("corpus"), F.sum("target").alias("target")), "word-counts")


def log_ratios(words: DataFrame, rules: QualityRules = QualityRules()) -> Column:
    """ln(p_target / p_corpus) of every slot, add-one smoothed, as one constant array.

    All trigrams of all words count, from the rows of ``word_counts``: each different
    word is taken apart once and weighs as often as it occurs.
    """
    each = slot_rows(words.withColumn("words", F.array("word")), rules.buckets, "corpus", "target")
    counts = each.groupBy("slot").agg(F.sum("corpus"), F.sum("target"))
    n = rules.buckets
    corpus, target = [0] * n, [0] * n
    for slot, in_corpus, in_target in counts.collect():  # at most n rows, whatever the input
        corpus[slot], target[slot] = in_corpus, in_target
    if not any(target):
        return constant_array([0.0] * n)
    all_corpus, all_target = sum(corpus) + n, sum(target) + n
    return constant_array([
        log((t + 1) / all_target) - log((c + 1) / all_corpus) for c, t in zip(corpus, target)
    ])


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(PLACES)).cast("int")


def text_sum(words: DataFrame, ratios: Column, rules: QualityRules = QualityRules()) -> Column:
    """The sum of ``ratios`` over all trigrams of a row's array ``words``.

    Of the words that share a place, the most frequent one of ``word_counts`` has its sum
    in a constant array, with its text beside it; every other word is taken apart.
    """
    def apart(word: Column) -> Column:
        add = lambda total, gram: total + F.get(ratios, _slot(gram, rules.buckets))
        return F.aggregate(_trigrams(F.array(word)), F.lit(0.0), add)

    able = words.filter((F.col("corpus") > 1) & (F.length("word") <= SHORT) & F.is_valid_utf8("word"))
    best = able.groupBy(_place(F.col("word")).alias("place")).agg(F.max(F.struct("corpus", "word")).alias("best"))
    names, sums = [""] * PLACES, [0.0] * PLACES
    for place, name, total in best.select("place", "best.word", apart(F.col("best.word"))).collect():
        names[place], sums[place] = name, total  # at most PLACES short words
    known, known_sums = F.split(F.lit(" ".join(names)), " "), constant_array(sums)

    def of_word(word: Column) -> Column:
        return F.when(F.get(known, _place(word)) == word, F.get(known_sums, _place(word))).otherwise(apart(word))

    return F.aggregate("words", F.lit(0.0), lambda total, word: total + of_word(word))


def _covered(grams: Column, width: int) -> Column:
    """Words inside windows that occur twice or more in the text.

    Windows are sorted by hash; those with an equal neighbour are put back in text
    order, and each covers what the next one does not. A lambda binds the sorted
    windows: written out at each use, they would be hashed and sorted at each.
    """
    none = F.lit(None).cast("struct<g:bigint,i:int>")
    equal = lambda m, side: F.coalesce(m["own"]["g"] == m[side]["g"], F.lit(False))

    def covered(placed: Column) -> Column:
        marked = F.arrays_zip(
            placed.alias("own"),
            F.concat(F.array(none), F.slice(placed, F.lit(1), F.size(placed) - 1)).alias("before"),
            F.slice(placed, F.lit(2), F.size(placed)).alias("after"),  # one short: the last row gets null
        )
        again = F.filter(marked, lambda m: equal(m, "before") | equal(m, "after"))
        starts = F.sort_array(F.transform(again, lambda m: m["own"]["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + width - F.greatest(a["end"], i)).alias("n"), (i + width).alias("end")),
            lambda a: a["n"],
        )

    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.get(F.transform(F.array(placed), covered), F.lit(0))


def rule_figures(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Add the rule figures to ``docs``, which has ``words`` and ``body`` (the whole text).

    Runs of words are hashed by doubling. A run of 8 words that repeats brings five
    runs of 4 that were there before; texts with fewer, nearly all, stop at 4.
    """
    full = F.filter(F.split("body", "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    df = (
        docs.withColumn("_pairs", paired(F.col("words"), F.col("words"), 1, F.size("words") - 1))
        .withColumn("_fours", paired(F.col("_pairs"), F.col("_pairs"), 2, F.size("_pairs") - 2))
        .withColumn("_lines", full)
        .select(
            *[c for c in docs.columns if c != "body"], "_fours",
            F.size("words").cast("bigint").alias("n_words"),
            F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            F.regexp_count("body", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        )
    )
    eights = paired(F.col("_fours"), F.col("_fours"), 4, F.size("_fours") - 4)
    repeats = F.size("_fours") - F.size(F.array_distinct("_fours")) >= 5
    df = df.withColumn("n_repeat_words", F.when(repeats, _covered(eights, WINDOW)).otherwise(F.lit(0)).cast("bigint"))
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    return df.withColumn("base_failed", failed).drop("_fours")


def assess(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per document: rule figures, ``score`` (mean log ratio) and ``kept``.

    The input row is carried along as the struct ``doc``. No text is shuffled: words are
    counted, and the ratios and the sums of frequent words are constant arrays.
    """
    counts = word_counts(docs, labels, rules)
    total = text_sum(counts, log_ratios(counts, rules), rules)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), whole_text().alias("body"))
    judged = rule_figures(packed.withColumn("words", words_of(F.col("body"))), rules)

    # A word has as many trigrams as code points.
    return (
        judged.withColumn("score", total / F.greatest(F.col("word_chars"), F.lit(1))).drop("words")
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= rules.threshold))
    )


def keep_good(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only.

    A plain filter would be moved below the projections and work out every figure once
    more per use; rows leave through an explode instead, which nothing moves past.
    """
    one = F.when(F.col("kept"), F.array("doc"))
    kept = assess(docs, labels, rules).select(F.explode_outer(one).alias("doc"))
    return kept.filter(F.col("doc").isNotNull()).select("doc.*")
