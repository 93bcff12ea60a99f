"""TF-IDF plus multinomial logistic regression on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.operators.features import (
    MAX_FEATURES,
    MIN_DF,
    collect_vocabulary,
    learn_vocabulary,
    term_counts,
    term_stages,
    tfidf_stages,
    with_terms,
)
from caselake.operators.metrics import macro_f1, mean_ci
from caselake.operators.softmax import minimum, objective, start
from caselake.operators.splits import FOLDS, REPEATS, SEED, stratified_rows, with_folds
from caselake.session import bounded, written

# Inverse regularisation strength and iteration limit.
C = 1.0
MAX_ITER = 1000

# Fixed value: a fit has arrived when no part of the mean gradient is larger.
GRADIENT_BOUND = 1e-4

# Part of the mean gradient below which the optimiser stops.
TOLERANCE = GRADIENT_BOUND / 100

# The same where it only looks for a start, over a part of the rows.
START_TOLERANCE = 10 * TOLERANCE


@dataclass(frozen=True)
class TextModelSpec:
    """What one fit learns from and how.

    ``max_fit_rows`` bounds the rows that the optimiser passes over some hundred times:
    about that many, shared out exactly by class size, one of each class at least, chosen
    by seeded hash of the id. Vocabulary, document frequencies and class weights still
    come from all rows. None, the default, fits on all of them.
    """

    text: str = "narrative"
    label: str = "product"
    min_df: int = MIN_DF
    max_features: int = MAX_FEATURES
    c: float = C
    max_iter: int = MAX_ITER
    stop_words: Sequence[str] | None = None
    max_fit_rows: int | None = None
    seed: int = SEED


@dataclass(frozen=True)
class Fit:
    """A model with what it was fitted on: ``vectors`` (features, _label, weight), and
    the strength of the penalty on the mean loss."""

    model: PipelineModel
    regression: LogisticRegressionModel
    vectors: DataFrame
    penalty: float


def class_weights(df: DataFrame, label: str = "product") -> DataFrame:
    """Balanced weight per class, rows / (classes * rows of the class), on one row per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.select(
        label, "n", (totals["rows"] / (totals["classes"] * F.col("n"))).alias("weight")
    )


def _fit_terms(
    train: DataFrame, vocabulary: Sequence[tuple[str, float]], spec: TextModelSpec, id_col: str
) -> Fit:
    """Fit on rows that carry ``terms``, given their vocabulary.

    The vocabulary has at most ``max_features`` entries and becomes part of the
    model. Vectors are made in the tasks that read the terms and written once; the
    optimiser's gradients over them are summed in one task per core at most.
    """
    if not vocabulary:
        raise ValueError(f"no term occurs in {spec.min_df} or more documents")
    weights = bounded(class_weights(train, spec.label))
    classes = sorted((r[spec.label], r["n"]) for r in weights.collect())
    labels = [name for name, _ in classes]
    features = tfidf_stages(vocabulary)
    chosen = train
    if spec.max_fit_rows is not None:
        chosen = stratified_rows(train, spec.max_fit_rows, id_col, spec.label, spec.seed)
    weighted = chosen.select("terms", spec.label).join(
        weights.select(spec.label, "weight"), spec.label
    )
    indexer = StringIndexerModel.from_labels(labels, inputCol=spec.label, outputCol="_label")
    ready = PipelineModel([*features, indexer]).transform(weighted)
    vectors = written(ready.select("features", "_label", "weight"), "vectors")
    # The summed objective of C is Spark's mean objective at 1 / (C * rows):
    # balanced weights add up to the number of rows.
    penalty = 1.0 / (spec.c * vectors.count())
    regression = _minimised(vectors, len(labels), len(vocabulary), penalty, spec.max_iter)
    names = IndexToString(inputCol="_prediction", outputCol="baseline_pred", labels=labels)
    return Fit(PipelineModel([*features, regression, names]), regression, vectors, penalty)


def _minimised(
    vectors: DataFrame, classes: int, features: int, penalty: float, max_iter: int
) -> LogisticRegressionModel:
    """Spark ML's model at the least of its own objective.

    ``softmax.minimum`` finds the coefficients; a fit of no step between equal bounds has
    them as its start and so as its result, with its summary. Spark ML gives a feature that
    has the same value in all rows the coefficient 0; the others are then fitted to that.
    """
    at = objective(vectors, classes, features, penalty)
    try:
        theta = minimum(at, start(at, max_iter, START_TOLERANCE), max_iter, TOLERANCE)
        regression = _held(vectors, theta, penalty)
        none = (regression.coefficientMatrix.toArray().T == 0) & (theta[:-1] != 0)
        if not none.any():
            return regression

        def without(theta: np.ndarray) -> tuple[float, np.ndarray]:
            value, gradient = at(theta)
            gradient[:-1][none] = 0.0
            return value, gradient

        theta[:-1][none] = 0.0
        return _held(vectors, minimum(without, theta, max_iter, TOLERANCE), penalty)
    finally:
        at.release()


def _held(vectors: DataFrame, theta: np.ndarray, penalty: float) -> LogisticRegressionModel:
    features, classes = theta[:-1].shape
    slopes, bias = Matrices.dense(classes, features, theta[:-1].ravel()), Vectors.dense(theta[-1])
    return LogisticRegression(
        family="multinomial", featuresCol="features", labelCol="_label", weightCol="weight",
        predictionCol="_prediction", elasticNetParam=0.0, standardization=False, regParam=penalty, maxIter=0,
        lowerBoundsOnCoefficients=slopes, upperBoundsOnCoefficients=slopes,
        lowerBoundsOnIntercepts=bias, upperBoundsOnIntercepts=bias,
    ).fit(vectors)


def fit_text_model(
    train: DataFrame, spec: TextModelSpec = TextModelSpec(), id_col: str = "complaint_id"
) -> Fit:
    """The whole text-to-label model; vocabulary and weights come from ``train`` only.
    The id is read only where ``max_fit_rows`` chooses rows by it."""
    ids = [] if spec.max_fit_rows is None else [id_col]
    termed = written(
        with_terms(train.select(*ids, spec.text, spec.label), spec.text, spec.stop_words)
        .select(*ids, "terms", spec.label), "terms",
    )
    vocabulary = learn_vocabulary(termed, spec.min_df, spec.max_features)
    fit = _fit_terms(termed, vocabulary, spec, id_col)
    return replace(fit, model=PipelineModel([*term_stages(spec.text, spec.stop_words), *fit.model.stages]))


def fit_classifier(
    train: DataFrame, spec: TextModelSpec = TextModelSpec(), id_col: str = "complaint_id"
) -> PipelineModel:
    """The model of ``fit_text_model``."""
    return fit_text_model(train, spec, id_col).model


def fit_evidence(fit: Fit, bound: float = GRADIENT_BOUND) -> DataFrame:
    """How well the fitted coefficients minimise their objective: one row (rows, classes,
    features, objective, gradient, arrived).

    One pass over the fitted rows takes every row's class probabilities at the coefficients
    and sums the weighted loss; a second lists their entries and sums, per feature, entry
    times weight times (probability minus truth) for all classes side by side, with
    map-side combine. ``gradient`` is the largest part of the mean gradient in size,
    intercepts included, and ``arrived`` says that it is within ``bound``. The
    coefficients, ``features`` rows of one number per class, are the model itself.
    """
    spark = fit.vectors.sparkSession
    coefficients = fit.regression.coefficientMatrix.toArray()
    classes, features = coefficients.shape
    probability = vector_to_array("probability")
    at_fit = fit.regression.transform(fit.vectors).select(
        "features", "weight", F.element_at(probability, F.col("_label").cast("int") + 1).alias("_own"),
        F.transform(probability, lambda p, k: F.col("weight") * (p - (k == F.col("_label")).cast("double"))).alias("_miss"),
    )
    total = F.sum("weight")
    loss = at_fit.agg(
        F.count(F.lit(1)).alias("rows"), total.alias("total"),
        (F.sum(-F.col("weight") * F.log("_own")) / total).alias("loss"),
        F.greatest(*[F.abs(F.sum(F.col("_miss")[k])) / total for k in range(classes)], F.lit(0.0)).alias("bias"),
    )
    vector = F.unwrap_udt("features")
    entries = F.explode(F.arrays_zip(vector["indices"].alias("at"), vector["values"].alias("x")))
    sums = at_fit.select("_miss", entries.alias("e")).groupBy(F.col("e.at").alias("at")).agg(
        F.array(*[F.sum(F.col("e.x") * F.col("_miss")[k]) for k in range(classes)]).alias("sums"))
    held = spark.createDataFrame(
        [(at, column.tolist()) for at, column in enumerate(coefficients.T)], "at int, held array<double>")
    none = F.array_repeat(F.lit(0.0), classes)
    parts = held.join(sums, "at", "left").crossJoin(F.broadcast(loss.select("total"))).select(
        F.zip_with("held", F.coalesce("sums", none),
                   lambda b, g: F.abs(g / F.col("total") + F.lit(fit.penalty) * b)).alias("parts"),
        F.aggregate("held", F.lit(0.0), lambda so_far, b: so_far + b * b).alias("square"))
    steepest = parts.agg(F.max(F.array_max("parts")).alias("steepest"), F.sum("square").alias("square"))
    gradient = F.greatest("steepest", "bias")
    return loss.crossJoin(F.broadcast(steepest)).select(
        "rows", F.lit(classes).alias("classes"), F.lit(features).alias("features"),
        (F.col("loss") + fit.penalty / 2 * F.col("square")).alias("objective"),
        gradient.alias("gradient"), (gradient <= bound).alias("arrived"),
    )


def predict(
    model: PipelineModel, df: DataFrame, id_col: str = "complaint_id", text: str = "narrative",
    label: str = "product",
) -> DataFrame:
    """Prediction table: id, narrative, true label, predicted label."""
    scored = model.transform(df.select(id_col, text, label))
    return scored.select(
        id_col, F.col(text).alias("narrative"), F.col(label).alias("true_product"), "baseline_pred"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cross_predictions(
    train: DataFrame, spec: TextModelSpec = TextModelSpec(), id_col: str = "complaint_id",
    folds: int = FOLDS, repeats: int = REPEATS, seed: int = SEED, parallelism: int = 8,
) -> DataFrame:
    """(id, repeat, fold, true_product, baseline_pred) of every row of every fold, the
    model refitted from its vocabulary up.

    Terms and fold membership are written once. One pass then counts every term
    in total and inside every fold; the counts a fold trains on are the
    difference, so no text is read again to build a vocabulary.
    """
    members = with_folds(train.select(id_col, spec.text, spec.label), id_col, spec.label,
                         folds, repeats, seed)
    fold_cols = [f"fold_{r}" for r in range(repeats)]
    termed = written(
        with_terms(members, spec.text, spec.stop_words).select(id_col, "terms", spec.label, *fold_cols), "terms"
    )

    def inside(name: str) -> list[Column]:
        return [
            F.sum(F.when(F.col(fold) == i, F.col(name)).otherwise(0)).alias(f"{name}_{fold}_{i}")
            for fold in fold_cols for i in range(folds)
        ]

    sums = [F.sum("tf").alias("tf"), F.sum("df").alias("df"), *inside("tf"), *inside("df")]
    counts = written(
        term_counts(termed, sums, fold_cols).filter(F.col("df") >= spec.min_df), "fold-terms"
    )

    def validate(fold: str, i: int) -> DataFrame:
        fitting = termed.filter(F.col(fold) != i)
        outside = counts.select(
            "term",
            (F.col("tf") - F.col(f"tf_{fold}_{i}")).alias("tf"),
            (F.col("df") - F.col(f"df_{fold}_{i}")).alias("df"),
        )
        n_docs = fitting.agg(F.count(F.lit(1))).scalar()
        vocabulary = collect_vocabulary(outside, n_docs, spec.min_df, spec.max_features)
        model = _fit_terms(fitting, vocabulary, spec, id_col).model
        return model.transform(termed.filter(F.col(fold) == i)).select(
            id_col, F.lit(int(fold.removeprefix("fold_"))).alias("repeat"), F.lit(i).alias("fold"),
            F.col(spec.label).alias("true_product"), "baseline_pred",
        )

    with ThreadPoolExecutor(parallelism) as pool:
        task = inheritable_thread_target(train.sparkSession)(validate)
        runs = [pool.submit(task, fold, i) for fold in fold_cols for i in range(folds)]
        return reduce(DataFrame.unionByName, [run.result() for run in runs])


def cross_validate(
    train: DataFrame, spec: TextModelSpec = TextModelSpec(), id_col: str = "complaint_id",
    folds: int = FOLDS, repeats: int = REPEATS, seed: int = SEED, parallelism: int = 8,
) -> DataFrame:
    """Macro-F1 of every (repeat, fold)."""
    scored = cross_predictions(train, spec, id_col, folds, repeats, seed, parallelism)
    return macro_f1(scored, by=["repeat", "fold"])


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean macro-F1 over the folds with its 95 % interval."""
    return mean_ci(scores, "macro_f1")
