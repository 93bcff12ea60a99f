"""Personal data: pattern spans, and terms that give protected values away.

Patterns find emails, IP addresses, card and phone numbers. Each value found is a
protected entity. How much a term t tells about an entity e is measured on the whole
corpus: with n(e, t) occurrences of t in contexts of e, n(e) of e, n(t) of t
and W words in all, the disclosure is PMI(e; t) / IC(e), where PMI is
log2(n(e, t) * W / (n(e) * n(t))) and IC(e) is log2(W / n(e)). It is 1 for a term
met only beside e. Terms at or over ``generalise_at`` are generalised, those at or
over ``remove_at`` removed, wherever they stand. A term is any word without the signs at
its edges, unless it is a base span itself. A context is a few words on both
sides. A pair needs several that differ, and so do the passages, some more words on both
sides: taken one by one, each counts that shares at most half of its words with each one
counted before. So copies and near copies of one passage prove nothing, and further
contexts never speak against a pair.
Only DataFrame functions are used.

Defined results: a null or empty text has no spans and stays as it is; null ids and
repeated rows are treated like any other row; an empty table gives an empty result.
``sanitise`` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import by_row, row_key, slot_test, whole_text, words_of
from caselake.session import written

# The kinds and what a match must look like. Greedy runs that cannot give
# anything back are possessive and start where a run starts, so long runs take linear time.
LOCAL = "[A-Za-z0-9._%+-]"
KINDS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "struct<kind:string,start:int,end:int,value:string>"
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¿¡«»„“”‘’…–—"


@dataclass(frozen=True)
class Disclosure:
    """``min_contexts``: different contexts, and different passages, of an entity in which
    a term must stand; ``context_words`` and ``passage_words``: words of them on each side.
    ``chance``: largest probability that any term at all is named by chance alone.
    ``slots`` is the size of the prefilter bitmap; it only saves work."""

    context_words: int = 4
    passage_words: int = 12
    min_contexts: int = 3
    generalise_at: float = 0.9
    remove_at: float = 0.97
    chance: float = 0.05
    slots: int = 1 << 17


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        def doubled(digit: Column, place: Column) -> Column:
            d = digit.cast("int")
            return F.when(place % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

        values = F.transform(F.split(F.reverse(digits), ""), doubled)
        total = F.aggregate(values, F.lit(0), lambda a, x: a + x)
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _placed(kind: str, matches: Column, gaps: Column) -> Column:
    """Valid matches with code-point offsets, from the matches and the text between."""
    rows = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, value: F.struct(
        F.length(gap).alias("gap"), F.length(value).alias("n"), value.alias("value")))

    def step(a: Column, x: Column) -> Column:
        start = a["end"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["n"]).alias("end"),
                        x["value"].alias("value"))
        return F.struct((start + x["n"]).alias("end"), F.concat(a["out"], F.array(span)).alias("out"))

    empty = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.filter(F.aggregate(rows, empty, step, lambda a: a["out"]), lambda s: _valid(kind, s["value"]))


def with_spans(rows: DataFrame, body: str = "body") -> DataFrame:
    """Add ``spans``: the base spans of ``body`` by kind, then start.

    A quick test per kind spares most texts the costlier search; it is implied by the
    pattern. The columns ``_m_*`` and ``_g_*`` keep matches and gaps per kind.
    """
    text = F.col(body)
    possible = {
        "email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": F.contains(text, F.lit("+")),
    }
    none = F.array().cast("array<string>")
    found = rows.select("*", *[
        F.when(possible[kind], F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        .alias(f"_m_{kind}") for kind, pattern in KINDS.items()
    ])
    cut = found.select("*", *[
        F.when(F.size(f"_m_{kind}") > 0, F.split(text, pattern)).otherwise(none).alias(f"_g_{kind}")
        for kind, pattern in KINDS.items()
    ])
    spans = [
        F.when(F.size(f"_m_{kind}") > 0, _placed(kind, F.col(f"_m_{kind}"), F.col(f"_g_{kind}")))
        .otherwise(F.array().cast(f"array<{SPAN}>")) for kind in KINDS
    ]
    return cut.withColumn("spans", F.concat(*spans))


def _term(word: Column) -> Column:
    """A word as a term: lower case, without signs at its edges."""
    return F.btrim(F.lower(word), F.lit(EDGES))


def _contexts(spanned: DataFrame, how: Disclosure) -> DataFrame:
    """(entity, context, passage): the words on both sides of every match that is a span,
    and hashes of the different terms of the passage, in order."""

    def around(kind: str) -> Column:
        gaps = F.col(f"_g_{kind}")

        def one(value: Column, i: Column) -> Column:
            before = F.slice(F.reverse(words_of(F.get(gaps, i))), 1, how.passage_words)
            after = F.slice(words_of(F.get(gaps, i + 1)), 1, how.passage_words)
            near = F.concat(F.slice(before, 1, how.context_words), F.slice(after, 1, how.context_words))
            terms = F.filter(F.transform(F.concat(before, after), _term), lambda t: t != "")
            return F.struct(F.concat(F.lit(f"{kind}:"), value).alias("entity"), near.alias("context"),
                            F.sort_array(F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))).alias("passage"))

        values = F.transform(F.filter("spans", lambda s: s["kind"] == kind), lambda s: s["value"])
        return F.filter(F.transform(f"_m_{kind}", one),
                        lambda c: F.array_contains(values, F.substring(c["entity"], len(kind) + 2, 1 << 30)))

    return spanned.filter(F.size("spans") > 0).select(F.inline(F.concat(*[around(k) for k in KINDS])))


def _in_different_passages(rows: DataFrame, least: int) -> DataFrame:
    """(entity, term): those of ``rows`` (entity, term, passage) with ``least`` passages that
    pairwise share at most half of their other words.

    Each round takes one passage per pair, the least one, and leaves only those that differ
    from it, so rounds are as many as passages needed, however many there are.
    """
    rest = written(rows.filter(F.size("passage") > 1).distinct(), "passages")
    for _ in range(least - 1):
        taken = rest.groupBy("entity", "term").agg(F.min("passage").alias("taken"))
        shared = F.size(F.array_intersect("passage", "taken")) - 1
        others = F.least(F.size("passage"), F.size("taken")) - 1
        rest = written(rest.join(taken, ["entity", "term"]).filter(shared * 2 <= others).drop("taken"), "passages")
    return rest.select("entity", "term").distinct()


def _evidence(words: int) -> Column:
    """How far beyond chance a term stands near an entity: its log-likelihood ratio.

    By chance each of a term's ``n_term`` occurrences lies among the ``n_near`` words near
    the entity with their share of all words. exp(-evidence) bounds the probability that as
    many as ``n_both`` do, so comparing it with the number of pairs bounds all of them.
    """
    base = F.least(F.col("n_near") / F.lit(float(max(words, 1))), F.lit(1.0))
    seen = F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0))
    other = F.when(seen < 1, (1 - seen) * F.log((1 - seen) / (1 - base))).otherwise(0.0)
    return F.when(seen > base, F.col("n_term") * (seen * F.log(seen / base) + other)).otherwise(0.0)


def disclosing_terms(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """(term, disclosure): terms of ``docs`` (doc_id, text) that reach ``generalise_at``
    and stand beside an entity more often than chance explains, over all pairs that met.

    Two passes over the texts: the contexts of protected values, then the occurrences of
    the few terms that stand beside one often enough. A bitmap of fixed size, made of
    those terms, sends only them (and rare chance hits) through the shuffle.
    """
    bodies = docs.select(whole_text().alias("body"))
    contexts = written(_contexts(with_spans(bodies), how), "contexts")
    held = contexts.select("entity", "passage", F.xxhash64("context").alias("where"),
                           F.explode(F.transform("context", _term)).alias("term"))
    met = written(
        held.filter(F.col("term") != "").groupBy("entity", "term", "where").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("places")), "met")
    tested = met.count()
    pairs = met.filter(F.col("places") >= how.min_contexts)
    whole = F.exists("spans", lambda s: (s["start"] == 0) & (s["end"] == F.length("term")))
    pairs = with_spans(pairs, "term").filter(~whole).select(*pairs.columns)
    times = contexts.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.sum(F.size("context")).alias("n_near"))
    pairs = written(pairs.join(times, "entity"), "beside")
    slot = F.pmod(F.xxhash64("term"), F.lit(how.slots))
    taken = [r["slot"] for r in pairs.select(slot.alias("slot")).distinct().collect()]  # at most ``slots``
    if not taken:
        return pairs.select("term", F.lit(0.0).alias("disclosure"))
    words = bodies.select(F.explode(words_of(F.col("body"))).alias("word")).select(_term(F.col("word")).alias("term"))
    counts = written(
        words.groupBy(F.when(slot_test(slot, taken, how.slots), F.col("term")).alias("term"))
        .agg(F.count(F.lit(1)).alias("n_term")), "term-counts")
    total = counts.agg(F.sum("n_term").alias("w")).first()["w"]
    joined = pairs.join(counts, "term")
    content = F.log2(F.lit(total) / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    significant = F.col("evidence") >= math.log(max(tested, 1) / how.chance)
    close = joined.select("entity", "term", (shared / content).alias("disclosure"), _evidence(total).alias("evidence"))
    close = written(close.filter((F.col("disclosure") >= how.generalise_at) & significant), "close")
    rows = held.select("entity", "term", "passage").join(close.select("entity", "term"), ["entity", "term"])
    return (
        close.drop("evidence").join(_in_different_passages(rows, how.min_contexts), ["entity", "term"])
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    )


def term_spans(docs: DataFrame, terms: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, text_hash, term_spans) of the rows of ``docs`` that hold a term.

    Words pass a bitmap of fixed size inside the scan; only hits are shuffled, and
    only the texts of rows with a real hit are searched.
    """
    slot = F.pmod(F.xxhash64("term"), F.lit(how.slots))
    taken = [r["slot"] for r in terms.select(slot.alias("slot")).distinct().collect()]  # at most ``slots``
    keyed = docs.select(*row_key(), whole_text().alias("body"))
    words = keyed.select("doc_id", "text_hash", F.explode(words_of(F.col("body"))).alias("word")).select(
        "doc_id", "text_hash", _term(F.col("word")).alias("term"))
    hits = (
        words.filter(slot_test(slot, taken, how.slots)).distinct().join(terms, "term")
        .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("term", "disclosure")).alias("terms"))
    )
    longest_first = F.reverse(F.sort_array(F.transform("terms", lambda t: t["term"])))  # of those that begin alike
    quoted = F.transform(longest_first, lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E")))
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(quoted, "|"),
                       F.lit(r")(?![\p{L}\p{N}])"))
    bodies = by_row(hits, keyed.dropDuplicates(["doc_id", "text_hash"]), "inner").withColumn("pattern", pattern)
    cut = bodies.select("doc_id", "text_hash", "terms",
                        F.regexp_extract_all("body", F.col("pattern"), F.lit(0)).alias("m"),
                        F.split("body", F.col("pattern")).alias("g"))
    strong = F.transform(F.filter("terms", lambda t: t["disclosure"] >= how.remove_at), lambda t: t["term"])
    named = lambda s: F.struct(
        F.when(F.array_contains(strong, F.lower(s["value"])), F.lit("removed")).otherwise(F.lit("general")).alias("kind"),
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    return cut.select("doc_id", "text_hash", F.transform(_placed("term", F.col("m"), F.col("g")), named)
                      .alias("term_spans"))


def find(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, base, added): the base spans, and the spans of disclosing terms that
    lie outside them, for every row of ``docs`` (doc_id, text)."""
    terms = written(disclosing_terms(docs, how), "disclosing")
    keyed = docs.select(*row_key(), whole_text().alias("body"))
    base = with_spans(keyed).select("doc_id", "text_hash", F.col("spans").alias("base"))
    if terms.isEmpty():
        return base.select("doc_id", "base", F.array().cast(f"array<{SPAN}>").alias("added"))
    both = by_row(base, term_spans(docs, terms, how))
    return both.select("doc_id", "base", _outside(F.coalesce("term_spans", F.array()), F.col("base")).alias("added"))


def _outside(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that touch none of ``base``; by kind, then start."""
    free = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.sort_array(free)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _replaced(body: Column, spans: Column) -> Column:
    """The text with every span replaced; spans that overlap are replaced as one."""
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))

    def label(s: Column) -> Column:
        general = F.when(s["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        return F.when(s["kind"] == "removed", "").when(s["kind"] == "general", general).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def step(a: Column, s: Column) -> Column:
        clear = s["start"] >= a["end"]
        gap = F.substring(body, a["end"] + 1, s["start"] - a["end"])
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"), F.when(
            clear, F.concat(a["out"], gap, label(s))).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
    return F.aggregate(by_start, start, step, lambda a: F.concat(a["out"], F.substring(body, a["end"] + 1, F.length(body))))


def sanitise(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with spans replaced in ``text`` and, if there, ``n_chars`` counted anew.

    Rows that no bitmap hit concerns, nearly all, are never shuffled.
    """
    terms = written(disclosing_terms(docs.select("doc_id", "text"), how), "disclosing")
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *row_key(),
                         whole_text().alias("body"))
    none = F.array().cast(f"array<{SPAN}>")
    if terms.isEmpty():
        rows = packed.withColumn("term_spans", none)
    else:
        slot = lambda term: F.pmod(F.xxhash64(term), F.lit(how.slots))
        taken = [r["slot"] for r in terms.select(slot(F.col("term")).alias("slot")).distinct().collect()]
        marked = packed.withColumn("maybe", F.exists(
            words_of(F.col("body")), lambda w: slot_test(slot(_term(w)), taken, how.slots)))
        some = by_row(marked.filter("maybe"), term_spans(docs.select("doc_id", "text"), terms, how))
        rows = reduce(DataFrame.unionByName, [
            marked.filter(~F.col("maybe")).drop("maybe").withColumn("term_spans", none),
            some.drop("maybe").withColumn("term_spans", F.coalesce("term_spans", none)),
        ])
    spanned = with_spans(rows).select("doc", "body", "spans", _outside(F.col("term_spans"), F.col("spans")).alias("more"))
    every = F.concat("spans", "more")
    text = F.when(F.size(every) > 0, _replaced(F.col("body"), every)).otherwise(F.col("doc.text"))
    done = spanned.select("doc", text.alias("clean"))
    columns = {"text": F.col("clean"), "n_chars": F.length("clean").cast("bigint")}
    return done.select(*[columns.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
