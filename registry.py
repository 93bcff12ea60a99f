"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fixtures
from caselake.functions.text import (
    build_prompt,
    char_length,
    is_present,
    parse_label,
    scrub,
    short_label,
    strip_whitespace,
    trim_spaces,
)
from caselake.functions.typing import days_between, iso_date, parse_iso_timestamp
from caselake.operators import checks, classifier, external, features, marts, metrics, profile
from caselake.operators import ranking, splits, staging
from caselake.operators.dedupe import first_per_key
from caselake.plans import daily, evaluation
from caselake.session import new_path, spread, written
from caselake.sources import catalog, lake, landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TEXT = "complaint_what_happened"
LABEL_TEXTS = ("queux", "ción", "ung", "the", "é")
SECRETS = ("tion", "", None, "qu")
PHONE_DATE = "2023-06-01"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def r(c: str | Column, digits: int) -> Column:
    return F.round(c, digits).alias(c) if isinstance(c, str) else F.round(c, digits)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_cases(fixtures.raw_cases(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "documents")


def landed_pages(records: DataFrame, page: Column, fields: list[str], name: str) -> str:
    """Records written as search responses of one page each, one response per line."""
    path = new_path(records.sparkSession, name)
    hit = F.struct(F.struct(*fields).alias("_source"))
    pages = records.groupBy(page.alias("page")).agg(F.collect_list(hit).alias("hits"))
    pages.select(F.to_json(F.struct(F.struct("hits").alias("hits")))).write.text(path)
    return path


# Sources and sinks ---------------------------------------------------------


@query
def json_hits_explode(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    texts = events.select("event_type", "props", F.col("event_id").cast("string").alias("event_id"))
    page = F.floor(F.col("event_id").cast("bigint") / 200)
    path = landed_pages(texts, page, ["event_id", "event_type", "props"], "events")
    rows = landed.read_responses(
        spark, path, ["event_id", "event_type", "props", "channel"], multi_line=False
    )
    return rows.select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"), "channel"
    )


@query
def load_raw_responses(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    page = F.floor(F.col("complaint_id").cast("bigint") / 100)
    path = landed_pages(raw, page, raw.columns, "responses")
    return landed.load_raw(spark, path, fixtures.LANGS, 50, PHONE_DATE, multi_line=False)


@query
def source_filter(spark, sf_dir):
    return landed.source_filter(fixtures.raw_cases(spark, sf_dir), ("en", "fr"), PHONE_DATE)


@query
def quota_per_category(spark, sf_dir):
    return landed.quota_per_category(fixtures.raw_cases(spark, sf_dir), 50)


@query
def union_categories(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    return landed.union_categories([raw.filter(F.col("product") == p) for p in fixtures.LANGS])


@query
def csv_roundtrip(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    path = new_path(spark, "csv")
    odd = F.col("complaint_id").cast("bigint") % 2 == 1
    landed.write_csv(raw.filter(odd), path)
    landed.write_csv(raw.filter(~odd).select(*reversed(raw.columns)), path, append=True)
    return landed.read_csv(spark, path, raw.columns)


@query
def raw_reload_count(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    path = new_path(spark, "raw")
    landed.replace_table(raw, path)
    rows = landed.replace_table(raw, path)
    return spark.createDataFrame([(rows,)], "rows bigint")


@query
def mart_from_catalog(spark, sf_dir):
    """Staged facts as a table, their measures as a view on it, the mart read from the view."""
    catalog.save_table(staged(spark, sf_dir), "caselake_facts")
    catalog.save_view(marts.measures(spark.table("caselake_facts")), "caselake_measures")
    mart = marts.mart_by_category(spark.table("caselake_measures"))
    return catalog.save_table(mart, "caselake_by_category")


@query
def metrics_kv(spark, sf_dir):
    scores = metrics.macro_f1(fixtures.predictions(spark, sf_dir))
    path = new_path(spark, "metrics")
    rows = landed.metric_rows(scores, {"macro_f1": "%.4f", "accuracy": "%.4f"})
    landed.write_metrics(rows, path)
    return landed.read_metrics(spark, path)


@query
def lake_export_counts(spark, sf_dir):
    raw = fixtures.answered_cases(spark, sf_dir)
    return daily.run_daily(raw, new_path(spark, "lake"), "2024-03-01", fixtures.LANGS)


@query
def lake_snapshot_latest(spark, sf_dir):
    root = new_path(spark, "lake")
    raw = fixtures.raw_cases(spark, sf_dir)
    lake.export_table(staging.type_records(raw), root, daily.FACTS, "2024-03-01")
    lake.export_table(staging.stage_cases(raw), root, daily.FACTS, "2024-03-02")
    return lake.read_lake(spark, root, daily.FACTS).select(
        "complaint_id", "product", "narrative_length", "run_date"
    )


@query
def gated_build(spark, sf_dir):
    root = new_path(spark, "lake")
    daily.run_daily(fixtures.answered_cases(spark, sf_dir), root, "2024-03-01", fixtures.LANGS)
    return daily.lake_underperformers(spark, root)


# Staging -------------------------------------------------------------------


@query
def stg_clean(spark, sf_dir):
    return staged(spark, sf_dir)


@query
def parse_iso_ts(spark, sf_dir):
    received = F.col("date_received")
    return fixtures.raw_cases(spark, sf_dir).select(
        "complaint_id",
        F.unix_seconds(parse_iso_timestamp(received)).alias("received_s"),
        iso_date(received).alias("received"),
    )


@query
def days_to_route(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    start, end = iso_date(F.col("date_received")), iso_date(F.col("date_sent_to_company"))
    return raw.select("complaint_id", days_between(start, end).alias("days"))


@query
def text_normalise(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), "text", F.lit("\n "))
    return documents(spark, sf_dir).select(
        "doc_id",
        trim_spaces(padded).alias("trimmed"),
        strip_whitespace(padded).alias("stripped"),
        char_length(trim_spaces(padded)).alias("length"),
    )


@query
def narrative_present(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    return raw.filter(is_present(F.col(TEXT))).select("complaint_id", "product")


@query
def dedupe_narrative(spark, sf_dir):
    return first_per_key(documents(spark, sf_dir), "text", [F.col("doc_id").asc_nulls_last()])


@query
def dedupe_by_id(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return landed.dedupe_by_id(events, "user_id", [F.col("event_id")])


@query
def clean_for_training(spark, sf_dir):
    return training_rows(spark, sf_dir)


@query
def cleaning_report(spark, sf_dir):
    return staging.cleaning_report(fixtures.raw_cases(spark, sf_dir))


# Marts and ranking ---------------------------------------------------------


@query
def mart_by_category(spark, sf_dir):
    return marts.mart_by_category(marts.measures(staged(spark, sf_dir)))


@query
def mart_by_response(spark, sf_dir):
    return marts.mart_by_response(marts.measures(staged(spark, sf_dir)))


@query
def mart_top_companies(spark, sf_dir):
    return marts.mart_top_companies(marts.measures(staged(spark, sf_dir)))


@query
def marts_from_cube(spark, sf_dir):
    cube = marts.case_cube(staged(spark, sf_dir))
    return marts.mart_by_category(cube)


@query
def reconcile_marts(spark, sf_dir):
    tables = daily.build_tables(fixtures.raw_cases(spark, sf_dir))
    return marts.reconcile(
        tables[daily.FACTS],
        tables["mart_complaints_by_category"],
        tables["mart_company_response_analysis"],
    )


@query
def rate_by_pair(spark, sf_dir):
    return ranking.rate_by_pair(fixtures.order_cases(spark, sf_dir))


@query
def category_avg_rate(spark, sf_dir):
    return ranking.average_rate(staged(spark, sf_dir))


@query
def rank_within_category(spark, sf_dir):
    return ranking.rank_by_rate(ranking.rate_by_pair(staged(spark, sf_dir)))


@query
def worst_in_class(spark, sf_dir):
    return ranking.underperformers(staged(spark, sf_dir))


@query
def worst_in_class_orders(spark, sf_dir):
    return ranking.underperformers(fixtures.order_cases(spark, sf_dir))


@query
def worst_in_class_head(spark, sf_dir):
    """What a user looks at first: 30 rows in order."""
    return ranking.underperformers(staged(spark, sf_dir)).limit(30)


@query
def guards(spark, sf_dir):
    """What refuses an empty table, what lets a full one through, and the rows that were
    then at the place it writes to or reads from."""
    raw, root, day = fixtures.raw_cases(spark, sf_dir), new_path(spark, "guarded"), "2024-03-01"
    facts = written(staging.type_records(raw), "facts")
    report, single = profile.class_balance(facts), new_path(spark, "single")

    def rows(table: str) -> int:
        return lake.read_lake(spark, root, table).count() if lake.snapshot_dates(spark, root, table) else 0

    def single_file() -> int:
        landed.write_csv(report, single, single_file=True)
        names = spark.read.text(single).inputFiles()
        return landed.read_csv(spark, single, report.columns).count() if len(names) == 1 else -1

    trials = {
        "export of no rows": (lambda: lake.export_table(facts.filter("false"), root, "empty", day), lambda: rows("empty")),
        "export": (lambda: lake.export_table(facts, root, "facts", day), lambda: rows("facts")),
        "read of no rows": (lambda: lake.require_rows(facts.filter("false"), "facts"), lambda: 0),
        "read": (lambda: lake.require_rows(lake.read_lake(spark, root, "facts"), "facts"), lambda: rows("facts")),
        "build of no rows": (lambda: daily.run_daily(raw.filter("false"), root, day, fixtures.LANGS), lambda: rows(daily.FACTS)),
        "build that a check fails": (lambda: daily.run_daily(raw, root, day, fixtures.LANGS[1:]), lambda: rows(daily.FACTS)),
        "report as one file": (single_file, single_file),
    }
    out = []
    for name, (action, left) in trials.items():
        try:
            action()
            raised = False
        except RuntimeError:
            raised = True
        out.append((name, raised, left()))
    return spark.createDataFrame(out, "guard string, raised boolean, rows bigint")


# Checks --------------------------------------------------------------------


@query
def check_unique(spark, sf_dir):
    return checks.check_unique(documents(spark, sf_dir), "text", "documents").unionByName(
        checks.check_unique(fixtures.table(spark, sf_dir, "orders"), "o_orderkey", "orders")
    )


@query
def check_not_null(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir)
    return checks.check_not_null(raw, ["complaint_id", "timely", "sub_issue"], "raw")


@query
def check_accepted(spark, sf_dir):
    return checks.check_accepted(staged(spark, sf_dir), "product", ("en", "fr"), daily.FACTS)


@query
def check_negative_days(spark, sf_dir):
    facts = staged(spark, sf_dir).withColumn("days_to_route", F.col("days_to_route") - 1)
    return checks.check_non_negative(facts, ["days_to_route"], daily.FACTS)


@query
def check_suite(spark, sf_dir):
    tables = daily.build_tables(fixtures.raw_cases(spark, sf_dir))
    return checks.run_checks(tables, checks.case_checks(("en", "fr", "de")))


# Profile -------------------------------------------------------------------


@query
def class_balance(spark, sf_dir):
    return profile.class_balance(training_rows(spark, sf_dir))


@query
def length_profile(spark, sf_dir):
    stats = profile.length_profile(documents(spark, sf_dir), "text")
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query
def length_box_by_category(spark, sf_dir):
    return profile.length_box(documents(spark, sf_dir), "lang", "text")


@query
def short_labels(spark, sf_dir):
    customer = fixtures.table(spark, sf_dir, "customer")
    name = F.concat("c_mktsegment", F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" segment"))
    return customer.select(
        "c_custkey", short_label(name).alias("short"), short_label(name, 22, 20).alias("longer")
    )


# Splits --------------------------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    return splits.stratified_split(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id", "lang")


@query
def stratified_folds(spark, sf_dir):
    return splits.stratified_folds(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id", "lang")


@query
def sample_per_class(spark, sf_dir):
    return splits.sample_per_class(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id", "lang")


# Text classification -------------------------------------------------------


def training_rows(spark, sf_dir):
    rows = staging.clean_for_training(
        fixtures.raw_cases(spark, sf_dir).withColumn("complaint_id", F.col("complaint_id").cast("bigint"))
    )
    return rows.select("complaint_id", "product", F.col(TEXT).alias("narrative"))


def termed_documents(spark, sf_dir):
    texts = spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return features.with_terms(texts, "text", stop_words=())


@query
def tokens_per_doc(spark, sf_dir):
    return termed_documents(spark, sf_dir).select(
        "doc_id",
        F.size("terms").cast("bigint").alias("n_terms"),
        F.size(F.array_distinct("terms")).cast("bigint").alias("n_distinct"),
        F.md5(F.concat_ws("|", "terms")).alias("terms_md5"),
    )


@query
def english_tokens_per_doc(spark, sf_dir):
    """Terms without English stop words, pairs joining what is left."""
    texts = spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return features.with_terms(texts, "text").select(
        "doc_id", F.size("terms").cast("bigint").alias("n_terms"),
        F.md5(F.concat_ws("|", "terms")).alias("terms_md5"),
    )


@query
def document_frequency(spark, sf_dir):
    return features.top_terms(features.term_counts(termed_documents(spark, sf_dir)))


@query
def tfidf_formula(spark, sf_dir):
    weights = features.tfidf_terms(termed_documents(spark, sf_dir), "doc_id")
    return weights.withColumn("weight", F.round("weight", 6))


@query
def class_weights(spark, sf_dir):
    weights = classifier.class_weights(training_rows(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 9))


@lru_cache(maxsize=1)
def held_out_run(spark, sf_dir):
    """One fit for all queries that look at it; its tables lie in the shared folder."""
    return evaluation.train_and_predict(training_rows(spark, sf_dir))


@query
def classifier_predictions(spark, sf_dir):
    """Held-out rows, whether their prediction is a class of the training rows, and whether
    the gradient at the fitted coefficients lies within the bound."""
    run = held_out_run(spark, sf_dir)
    classes = run.train.select(F.col("product").alias("baseline_pred")).distinct().withColumn("known", F.lit(True))
    arrived = classifier.fit_evidence(run.fit).select("arrived")
    return run.predictions.join(classes, "baseline_pred", "left").crossJoin(arrived).select(
        "complaint_id", "true_product", F.coalesce("known", F.lit(False)).alias("known_class"),
        F.col("arrived").alias("gradient_in_bound"),
    )


@query
def fit_objective(spark, sf_dir):
    """The fit's rows and classes, and its objective against that of no coefficients at all."""
    fit = held_out_run(spark, sf_dir).fit
    start = F.log(F.col("classes").cast("double"))
    return classifier.fit_evidence(fit).select(
        F.col("rows").alias("n_rows"), F.col("classes").cast("bigint").alias("n_classes"),
        r(start, 9).alias("objective_without"), (F.col("objective") < start).alias("objective_is_less"),
        F.col("arrived").alias("gradient_in_bound"),
    )


@query
def prediction_report(spark, sf_dir):
    """The report's supports, and whether its figures agree with each other and with scores
    taken straight from the predictions."""
    predicted = written(held_out_run(spark, sf_dir).predictions.select("true_product", "baseline_pred"), "predicted")
    return metrics.report_identities(metrics.classification_report(predicted), predicted)


@query
def model_reload_same_preds(spark, sf_dir):
    run = held_out_run(spark, sf_dir)
    path = new_path(spark, "model")
    classifier.save_model(run.model, path)
    again = classifier.predict(classifier.load_model(path), run.train).select(
        "complaint_id", F.col("baseline_pred").alias("reloaded_pred")
    )
    return classifier.predict(run.model, run.train).join(again, "complaint_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("baseline_pred") == F.col("reloaded_pred")).alias("n_same"),
    )


@query
def cv_macro_f1(spark, sf_dir):
    """Rows of every fold, whether all were scored with a known class, and whether the
    summary is the mean of the folds' scores."""
    rows = written(training_rows(spark, sf_dir), "clean")
    train = splits.stratified_split(rows).filter("split = 'train'")
    scored = written(classifier.cross_predictions(train), "cross-predictions")
    scores = metrics.macro_f1(scored, by=["repeat", "fold"])
    summary = classifier.cv_summary(scores).select("n", "mean")
    sizes = scored.groupBy("repeat", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("complaint_id").alias("n_ids"),
        F.count_if(F.col("baseline_pred").isNotNull()).alias("n_scored"))
    mean = scores.agg(F.avg("macro_f1").alias("own_mean"), F.min("macro_f1").alias("least"), F.max("macro_f1").alias("most"))
    return sizes.crossJoin(summary).crossJoin(mean).select(
        "repeat", "fold", "n_rows", "n_ids", "n_scored", F.col("n").alias("n_folds"),
        ((F.abs(F.col("mean") - F.col("own_mean")) < 1e-12) & (F.col("least") > 0) & (F.col("most") <= 1)).alias("mean_agrees"))


# Metrics -------------------------------------------------------------------


@query
def mean_ci(spark, sf_dir):
    per_source = documents(spark, sf_dir).groupBy("lang", "source").agg(F.avg("n_chars").alias("chars"))
    return metrics.mean_ci(per_source, "chars", ["lang"]).select(
        "lang", "n", r("mean", 6), r("half_width", 4), "summary"
    )


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(fixtures.predictions(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    report = metrics.classification_report(fixtures.predictions(spark, sf_dir))
    return report.select("label", *[r(c, 9) for c in ("precision", "recall", "f1-score", "support")])


@query
def macro_f1(spark, sf_dir):
    scores = metrics.macro_f1(fixtures.predictions(spark, sf_dir))
    return scores.select(*[r(c, 9) for c in scores.columns])


@query
def compare_same_rows(spark, sf_dir):
    both = fixtures.predictions(spark, sf_dir)
    label = parse_label(F.col("external_raw_output"), fixtures.EXTERNAL_LABELS)
    answers = both.select("complaint_id", F.substring(label, 6, 2).alias("external_pred"))
    result = metrics.compare_same_rows(both, answers)
    return result.select(
        "n_rows", *[r(c, 9) for c in result.columns if "acc" in c], "external_unparseable"
    )


# External classifier -------------------------------------------------------


@query
def parse_labels(spark, sf_dir):
    turns = fixtures.table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", parse_label(F.col("text"), LABEL_TEXTS).alias("label"))


@query
def build_prompts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", build_prompt(F.col("text")).alias("prompt"))


@query
def scrub_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", scrub(F.col("text"), SECRETS).alias("text"))


@query
def external_scores(spark, sf_dir):
    raw = fixtures.raw_cases(spark, sf_dir).select(
        "complaint_id", "product", F.col(TEXT).alias("narrative")
    )
    scored = external.external_scores(raw, fixtures.word_count_client, fixtures.LANGS)
    return scored.select("complaint_id", "product", "external_raw_output", "external_pred", "error")


@query
def external_retries(spark, sf_dir):
    """Calls that fail 0 to 4 times before they answer, in one of two ways, by document."""
    asked = documents(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("case "), F.col("doc_id").cast("string"), F.lit(" ")).alias("narrative"))
    scored = external.external_scores(asked, fixtures.failing_client, fixtures.LANGS, pause_s=0.0)
    kind = F.when(F.col("error").isNull(), "answered").otherwise(F.col("error"))
    return scored.groupBy(kind.alias("outcome"), F.col("external_raw_output").alias("answer")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("doc_sum"))


@query
def compare_sample(spark, sf_dir):
    rows = training_rows(spark, sf_dir).withColumnRenamed("product", "true_product")
    table = rows.withColumn(
        "baseline_pred", F.when(F.col("complaint_id") % 7 == 0, "en").otherwise(F.col("true_product"))
    )
    scored = evaluation.score_sample(written(table, "predictions"), fixtures.word_count_client, fixtures.LANGS)
    return external.reliability_summary(scored).select(
        "n_rows", r("baseline_acc", 9), r("external_acc_all_rows", 9),
        "external_unparseable", "errors", "invalid_label",
    )


@query
def external_reliability(spark, sf_dir):
    answers = fixtures.predictions(spark, sf_dir)
    label = parse_label(F.col("external_raw_output"), fixtures.EXTERNAL_LABELS)
    scored = answers.withColumn(
        "external_pred", F.when(F.col("error").isNull(), F.substring(label, 6, 2))
    )
    summary = external.reliability_summary(scored)
    ratios = [c for c in summary.columns if "acc" in c or "latency" in c]
    return summary.withColumns({c: F.round(c, 6) for c in ratios})
