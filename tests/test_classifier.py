import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.operators import classifier, features, metrics
from caselake.operators.classifier import TextModelSpec
from caselake.plans import evaluation

WORDS = {"Mortgage": "house loan escrow payment bank", "Student loan": "school college payment degree bank",
         "Credit card": "card limit charge payment bank"}


@pytest.fixture(scope="module")
def cases(spark):
    rows = []
    for i in range(180):
        label = sorted(WORDS)[(i * 7) % 3 if i % 6 else 0]
        own, other = WORDS[label].split(), WORDS[sorted(WORDS)[i % 3]].split()
        text = " ".join([own[i % 5], own[(i + 1) % 5], other[(i * 3) % 5], own[(i * 2) % 5], f"ref{i % 9}"])
        rows.append((i, label, text))
    return spark.createDataFrame(rows, "complaint_id bigint, product string, narrative string").persist()


SPEC = TextModelSpec(min_df=2, max_iter=200, stop_words=())


def python_terms(text, stop=()):
    words = [w for w in re.findall(r"\b\w\w+\b", text.lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_terms(spark):
    texts = ["The Étude of XXXX_1, a b cd!", "", "x", "don't STOP", "naïve café_au-lait 12 3"]
    df = spark.createDataFrame([(t,) for t in texts], "narrative string")
    assert [r["terms"] for r in features.with_terms(df, stop_words=()).collect()] == [python_terms(t) for t in texts]
    stopped = features.with_terms(df).collect()[0]["terms"]
    assert stopped == ["étude", "xxxx_1", "cd", "étude xxxx_1", "xxxx_1 cd"]


def test_vocabulary_counts_and_cut(spark, cases):
    counts = features.term_counts(features.with_terms(cases, stop_words=()))
    tf, df = Counter(), Counter()
    for r in cases.collect():
        terms = python_terms(r["narrative"])
        tf.update(terms), df.update(set(terms))
    assert {r["term"]: (r["tf"], r["df"]) for r in counts.collect()} == {t: (tf[t], df[t]) for t in tf}
    top = [r["term"] for r in features.top_terms(counts, 3, 10).collect()]
    assert top == sorted((t for t in df if df[t] >= 3), key=lambda t: (-tf[t], t))[:10]


def test_tfidf_weights(spark):
    texts = ["aa bb aa", "bb cc", "dd"]
    df = spark.createDataFrame(list(enumerate(texts)), "complaint_id int, narrative string")
    got = {(r["complaint_id"], r["term"]): (r["tf"], r["weight"])
           for r in features.tfidf_terms(features.with_terms(df, stop_words=()), min_df=1).collect()}
    docs = [Counter(python_terms(t)) for t in texts]
    freq = Counter(t for d in docs for t in d)
    raw = [{t: n * (math.log(4 / (1 + freq[t])) + 1) for t, n in d.items()} for d in docs]
    expected = {(i, t): (docs[i][t], w / math.sqrt(sum(v * v for v in r.values())))
                for i, r in enumerate(raw) for t, w in r.items()}
    assert got.keys() == expected.keys()
    for key, (count, weight) in expected.items():
        assert got[key][0] == count and got[key][1] == pytest.approx(weight, abs=1e-12)


def test_class_weights_balance(cases):
    weights = classifier.class_weights(cases).collect()
    assert sum(r["n"] for r in weights) == 180
    for r in weights:
        assert r["weight"] == pytest.approx(180 / (3 * r["n"]))


def test_fit_minimises_the_summed_objective(spark, cases):
    """At the solution the gradient of C * weighted log loss + 0.5 * |w|^2 vanishes."""
    spec = TextModelSpec(min_df=2, stop_words=())
    model = classifier.fit_classifier(cases, spec)
    regression = model.stages[-2]
    rows = model.transform(cases).select("features", "product", "narrative").collect()
    labels = model.stages[-1].getLabels()
    weights = {r["product"]: r["weight"] for r in classifier.class_weights(cases).collect()}
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([labels.index(r["product"]) for r in rows])
    w = np.array([weights[r["product"]] for r in rows])
    coef, bias = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    z = x @ coef.T + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p *= w[:, None]
    assert abs(p.T @ x + coef).max() < 5e-3
    assert abs(p.sum(0)).max() < 5e-2


def test_held_out_run_and_reload(spark, cases, tmp_path):
    run = evaluation.train_and_predict(cases, SPEC)
    predictions = run.predictions.persist()
    assert predictions.columns == ["complaint_id", "narrative", "true_product", "baseline_pred"]
    assert predictions.count() == 36
    assert run.train.join(predictions, "complaint_id").count() == 0
    assert metrics.macro_f1(predictions).collect()[0]["macro_f1"] > 0.7
    classifier.save_model(run.model, str(tmp_path / "m"))
    again = classifier.predict(classifier.load_model(str(tmp_path / "m")), run.train)
    assert again.exceptAll(classifier.predict(run.model, run.train)).count() == 0

    def client():
        return lambda prompt: next((k for k, v in WORDS.items() if v.split()[0] in prompt), "?")

    scored = evaluation.score_sample(predictions, client, per_class=4)
    assert scored.count() == 12 and scored.filter("error is not null").count() == 0


def test_cross_validation_equals_separate_fits(spark, cases):
    scores = {(r["repeat"], r["fold"]): r["macro_f1"]
              for r in classifier.cross_validate(cases, SPEC, folds=3, repeats=2, parallelism=3).collect()}
    assert set(scores) == {(r, f) for r in range(2) for f in range(3)}
    from caselake.operators.splits import with_folds

    members = with_folds(cases, folds=3, repeats=2)
    model = classifier.fit_classifier(members.filter("fold_1 <> 2"), SPEC)
    direct = metrics.macro_f1(classifier.predict(model, members.filter("fold_1 = 2"))).collect()[0]["macro_f1"]
    assert scores[(1, 2)] == pytest.approx(direct)
    summary = classifier.cv_summary(spark.createDataFrame([(v,) for v in scores.values()], "macro_f1 double")).collect()[0]
    assert summary["n"] == 6 and "±" in summary["summary"]


def test_no_frequent_term_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", "one two"), (2, "b", "three four")],
                               "complaint_id int, product string, narrative string")
    with pytest.raises(ValueError, match="3 or more"):
        classifier.fit_classifier(df)


def test_vocabulary_comes_from_training_rows_only(cases):
    extra = cases.filter("complaint_id < 5").withColumn("narrative", F.lit("unseen unseen unseen unseen"))
    model = classifier.fit_classifier(cases, SPEC)
    vocabulary = model.stages[4].vocabulary
    assert "unseen" not in vocabulary and model.transform(extra).count() == 5


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_vocabulary_cut_by_histograms(spark, partitions):
    """Ties at the cut go by term, wherever the cut lies and however the rows are dealt."""
    rows = [(f"{'é' if i % 5 == 0 else 'w'}{i * 7919 % 1000:03d}", 1 + (i % 9) ** 2, 3 + i % 4) for i in range(900)]
    counts = spark.createDataFrame(rows, "term string, tf bigint, df bigint").repartition(partitions)
    able = sorted((r for r in rows if r[2] >= 4), key=lambda r: (-r[1], r[0].encode()))
    for n in (1, 10, 75, 76, 400, len(able) - 1, len(able), len(able) + 5):
        got = [tuple(r) for r in features.top_terms(counts, 4, n).collect()]
        assert got == able[:n]


def test_no_term_is_frequent_enough(spark):
    counts = spark.createDataFrame([("a", 2, 2)], "term string, tf bigint, df bigint")
    assert features.top_terms(counts, 3, 10).count() == 0


def test_evidence_is_the_objective_and_gradient_at_the_fit(cases):
    fit = classifier.fit_text_model(cases, TextModelSpec(min_df=2, stop_words=()))
    got = classifier.fit_evidence(fit).first()
    rows = fit.vectors.collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([int(r["_label"]) for r in rows])
    w = np.array([r["weight"] for r in rows])
    coef, bias = fit.regression.coefficientMatrix.toArray(), fit.regression.interceptVector.toArray()
    z = x @ coef.T + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    loss = -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum()
    p[np.arange(len(y)), y] -= 1
    p *= w[:, None]
    gradient = max(abs(p.T @ x / w.sum() + fit.penalty * coef).max(), abs(p.sum(0)).max() / w.sum())
    assert (got["rows"], got["classes"], got["features"]) == (180, 3, x.shape[1])
    assert got["objective"] == pytest.approx(loss + fit.penalty / 2 * (coef**2).sum(), abs=1e-12)
    assert got["objective"] == pytest.approx(fit.regression.summary.objectiveHistory[-1], abs=1e-9)
    assert got["gradient"] == pytest.approx(gradient, abs=1e-12) and got["arrived"] and gradient <= 1e-4


def test_a_fit_that_stops_early_has_not_arrived(cases):
    fit = classifier.fit_text_model(cases, TextModelSpec(min_df=2, stop_words=(), max_iter=2))
    assert not classifier.fit_evidence(fit).first()["arrived"]


def test_bounded_fit_reads_a_stratified_sample_and_weighs_by_all_rows(cases):
    spec = TextModelSpec(min_df=2, stop_words=(), max_iter=50, max_fit_rows=60)
    fit = classifier.fit_text_model(cases, spec)
    whole = classifier.fit_text_model(cases, TextModelSpec(min_df=2, stop_words=(), max_iter=50))
    labels = fit.model.stages[-1].getLabels()
    sizes = {r["product"]: r["count"] for r in cases.groupBy("product").count().collect()}
    expected = {r["product"]: r["weight"] for r in classifier.class_weights(cases).collect()}
    seen = Counter()
    for r in fit.vectors.select("_label", "weight").collect():
        seen[labels[int(r["_label"])]] += 1
        assert r["weight"] == pytest.approx(expected[labels[int(r["_label"])]])
    assert sum(seen.values()) == 60 and all(abs(seen[k] - 60 * n / 180) < 1 for k, n in sizes.items())
    # Vocabulary and document frequencies come from all rows.
    assert fit.model.stages[4].vocabulary == whole.model.stages[4].vocabulary
    assert fit.penalty == pytest.approx(1 / 60)
    assert classifier.predict(fit.model, cases).filter("baseline_pred is not null").count() == 180


def test_the_sample_ignores_partitioning_and_keeps_every_class(spark):
    from caselake.operators.splits import stratified_rows

    rows = [(i, "big" if i else "one") for i in range(500)]
    members = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "complaint_id bigint, product string").repartition(parts)
        members.append(sorted(stratified_rows(df, 20).collect()))
    assert members[0] == members[1] and len(members[0]) == 21 and (0, "one") in members[0]
    assert stratified_rows(df, 1000).count() == 500
    assert stratified_rows(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        stratified_rows(df, 0)
