"""Tokens, vocabulary and TF-IDF weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.session import written

# Shape of the text features.
TOKEN_PATTERN = r"(?U)\b\w\w+\b"
MIN_DF = 3
MAX_FEATURES = 20_000

# Parts of a doubling of the frequency that the first histogram tells apart.
STEPS = 16


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def term_stages(text: str = "narrative", stop_words: Sequence[str] | None = None) -> list:
    """Stages that turn ``text`` into ``terms``: lower-case words of two or more
    characters without stop words, then all single words and neighbouring pairs."""
    words = english_stop_words() if stop_words is None else list(stop_words)
    return [
        RegexTokenizer(inputCol=text, outputCol="_words", gaps=False,
                       pattern=TOKEN_PATTERN, toLowercase=True),
        StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=words, locale="en"),
        NGram(inputCol="_kept", outputCol="_pairs", n=2),
        SQLTransformer(statement="SELECT *, concat(_kept, _pairs) AS terms FROM __THIS__"),
    ]


def with_terms(
    df: DataFrame, text: str = "narrative", stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Add the array ``terms``, in text order, repeats included."""
    out = df
    for stage in term_stages(text, stop_words):
        out = stage.transform(out)
    return out.drop("_words", "_kept", "_pairs")


def term_counts(
    df: DataFrame, sums: Sequence[Column] = (), keep: Sequence[str] = (), terms: str = "terms"
) -> DataFrame:
    """Sums per term over its occurrences (tf = 1) and the rows that hold it (df = 1).

    Every row lists its terms and then its different terms, so both counts come
    from one explode and the only shuffle is by term, after combining inside each
    task. The outer form of the explode keeps Spark from tokenising every text
    once more to test for emptiness. Without ``sums`` the result has the totals
    ``tf`` and ``df``.
    """
    listed = df.select(
        *keep, F.size(terms).alias("n"),
        F.concat(F.col(terms), F.array_distinct(F.col(terms))).alias("tokens"),
    )
    first_part = F.col("pos") < F.col("n")
    tokens = (
        listed.select(*keep, "n", F.posexplode_outer("tokens").alias("pos", "term"))
        .filter(F.col("term").isNotNull())
        .select(*keep, "term", F.when(first_part, 1).otherwise(0).alias("tf"),
                F.when(first_part, 0).otherwise(1).alias("df"))
    )
    return tokens.groupBy("term").agg(*(sums or [F.sum("tf").alias("tf"), F.sum("df").alias("df")]))


def top_terms(
    counts: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES
) -> DataFrame:
    """The most frequent terms found in at least ``min_df`` documents; ties go by term.

    Histograms find the cut first, so at most ``2 * max_features`` rows are sorted,
    however many tasks hold them. The counts are written once and read by each.
    """
    able = written(counts.filter(F.col("df") >= min_df), "able-terms")
    # Coarse steps of the frequency, then the frequencies inside the step with the cut.
    step = F.floor(F.log2("tf") * STEPS).cast("bigint")
    at, above, _ = _cut(able.select((-step).alias("k")), max_features)
    if at is None:
        return able.orderBy(F.desc("tf"), "term")
    inside = able.filter(step == -at)
    tf, more, _ = _cut(inside.select((-F.col("tf")).alias("k")), max_features - above)
    tied = _first_terms(able.filter(F.col("tf") == -tf), max_features - above - more, max_features)
    return able.filter(F.col("tf") > -tf).unionByName(tied).orderBy(F.desc("tf"), "term").limit(max_features)


def _cut(keys: DataFrame, n: int) -> tuple:
    """(key ``k`` of the n-th row in ascending order, rows before that key, rows at it);
    (None, rows, 0) where there are not more than ``n`` rows."""
    before = 0
    for row in keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy("k").toLocalIterator():
        if before + row["n"] > n:
            return row["k"], before, row["n"]
        before += row["n"]
    return None, before, 0


def _first_terms(terms: DataFrame, n: int, slack: int) -> DataFrame:
    """The first ``n`` rows by term and at most ``slack`` after them.

    Terms, which differ, are told apart byte by byte until few enough share the
    bytes at the cut: a histogram of at most 257 values each time.
    """
    code = F.hex(F.encode("term", "utf-8"))
    length, shared, left = 0, "", n
    while True:
        length += 2
        here = terms.filter(code.startswith(shared)) if shared else terms
        at, before, rows = _cut(here.select(F.substring(code, 1, length).alias("k")), left)
        if at is None:
            return terms if not shared else terms.filter(F.substring(code, 1, len(shared)) <= shared)
        shared, left = at, left - before
        if rows <= left + slack:
            return terms.filter(F.substring(code, 1, length) <= shared)


def idf(n_docs: Column, doc_freq: Column) -> Column:
    """Smoothed inverse document frequency: ln((1 + n) / (1 + df)) + 1."""
    return F.log((n_docs + 1) / (doc_freq + 1)) + 1


def learn_vocabulary(
    termed: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES
) -> list[tuple[str, float]]:
    """(term, idf), most frequent term first: at most ``max_features`` pairs."""
    n_docs = termed.agg(F.count(F.lit(1))).scalar()
    counts = written(term_counts(termed).filter(F.col("df") >= min_df), "term-counts")
    return collect_vocabulary(counts, n_docs, min_df, max_features)


def collect_vocabulary(
    counts: DataFrame, n_docs: Column, min_df: int, max_features: int
) -> list[tuple[str, float]]:
    ranked = top_terms(counts, min_df, max_features).select("term", idf(n_docs, F.col("df")).alias("idf"))
    return [(row["term"], row["idf"]) for row in ranked.collect()]


def tfidf_stages(vocabulary: Sequence[tuple[str, float]], terms: str = "terms") -> list:
    """Stages from ``terms`` to the unit-length vector ``features``, all row by row."""
    return [
        CountVectorizerModel.from_vocabulary([term for term, _ in vocabulary], terms, "_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense([weight for _, weight in vocabulary]),
                           inputCol="_tf", outputCol="_tfidf"),
        Normalizer(p=2.0, inputCol="_tfidf", outputCol="features"),
    ]


def tfidf_terms(
    df: DataFrame, id_col: str = "complaint_id", terms: str = "terms",
    min_df: int = MIN_DF, max_features: int = MAX_FEATURES,
) -> DataFrame:
    """(id, term, tf, weight) with weights of unit length per document.

    Lists the entries of the vectors the classifier learns from. Once the
    vocabulary is known nothing is shuffled.
    """
    vocabulary = learn_vocabulary(df.select(F.col(terms).alias("terms")), min_df, max_features)
    vectors = df.select(id_col, terms)
    for stage in tfidf_stages(vocabulary, terms):
        vectors = stage.transform(vectors)
    counts, weights = F.unwrap_udt("_tf"), F.unwrap_udt("features")
    entries = F.arrays_zip(
        weights["indices"].alias("at"), counts["values"].alias("tf"), weights["values"].alias("weight")
    )
    # At most max_features rows, and already part of the model above.
    names = F.broadcast(df.sparkSession.createDataFrame(
        [(at, term) for at, (term, _) in enumerate(vocabulary)], "at int, term string"
    ))
    rows = vectors.select(id_col, entries.alias("entries")).select(id_col, F.inline_outer("entries"))
    return (
        rows.filter(F.col("at").isNotNull())
        .join(names, "at")
        .select(id_col, "term", F.col("tf").cast("bigint").alias("tf"), "weight")
    )
