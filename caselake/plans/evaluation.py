"""Train on one part, score the other, and compare with an external classifier."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from caselake.operators.classifier import Fit, TextModelSpec, fit_text_model, predict
from caselake.operators.external import external_scores
from caselake.operators.splits import SAMPLE_PER_CLASS, SEED, TEST_SHARE, sample_per_class, stratified_split
from caselake.schemas import CATEGORIES
from caselake.session import written


@dataclass(frozen=True)
class HeldOutRun:
    train: DataFrame
    fit: Fit
    predictions: DataFrame

    @property
    def model(self) -> PipelineModel:
        return self.fit.model


def train_and_predict(
    clean: DataFrame, spec: TextModelSpec = TextModelSpec(), id_col: str = "complaint_id",
    share: float = TEST_SHARE, seed: int = SEED,
) -> HeldOutRun:
    """Stratified hold-out, one fit on the rest, predictions on the held-out rows."""
    rows = written(clean.select(id_col, spec.text, spec.label), "clean")
    split = stratified_split(rows, id_col, spec.label, share, seed)
    train = split.filter("split = 'train'").drop("split")
    fit = fit_text_model(train, spec, id_col)
    held_out = split.filter("split = 'test'")
    return HeldOutRun(train, fit, predict(fit.model, held_out, id_col, spec.text, spec.label))


def score_sample(
    predictions: DataFrame, make_client: Callable[[], Callable[[str], str]],
    labels: Sequence[str] = CATEGORIES, id_col: str = "complaint_id",
    per_class: int = SAMPLE_PER_CLASS, seed: int = SEED, **retry,
) -> DataFrame:
    """The same held-out sample through the external classifier, written once."""
    sample = sample_per_class(predictions, id_col, "true_product", per_class, seed)
    return written(external_scores(sample, make_client, labels, **retry), "scores").select(
        id_col, "true_product", "baseline_pred", "external_raw_output", "external_pred",
        "latency_s", "error",
    )
