import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from caselake.operators import classifier, softmax
from caselake.operators.classifier import TextModelSpec

WORDS = {"Mortgage": "house loan escrow payment bank", "Student loan": "school college payment degree bank",
         "Credit card": "card limit charge payment bank"}


def fit_rows(spark, n=400):
    words = sorted(WORDS)
    rows = [(i, words[i % 3], " ".join([*WORDS[words[i * 5 % 3]].split(), WORDS[words[i % 3]].split()[i % 5], f"ref{i % 40}"]))
            for i in range(n)]
    return spark.createDataFrame(rows, "complaint_id bigint, product string, narrative string")


def test_a_fit_arrives_in_few_steps(spark):
    fit = classifier.fit_text_model(fit_rows(spark), TextModelSpec(min_df=2, stop_words=(), max_iter=60))
    assert fit.regression.getMaxIter() == 0  # Spark ML takes no step of its own
    assert classifier.fit_evidence(fit).first()["gradient"] <= classifier.TOLERANCE


@pytest.mark.parametrize("partitions", [1, 5])
def test_sums_of_packed_rows(spark, monkeypatch, partitions):
    """Blocks of any size, rows without entries among them, against dense sums."""
    monkeypatch.setattr(softmax, "BLOCK", 7)
    rng = np.random.default_rng(3)
    x = rng.random((40, 9)) * (rng.random((40, 9)) < 0.4)
    x[[0, 7, 39]] = 0.0
    own, weight, theta = rng.integers(0, 3, 40), rng.random(40) + 0.5, rng.normal(size=(10, 3))
    rows = [(Vectors.sparse(9, [(int(j), float(r[j])) for j in r.nonzero()[0]]), float(k), float(w))
            for r, k, w in zip(x, own, weight)]
    vectors = spark.createDataFrame(rows, ["features", "_label", "weight"]).repartition(partitions)
    value, gradient = softmax.objective(vectors, 3, 9, 0.1)(theta)
    p = np.exp(x @ theta[:-1] + theta[-1])
    p /= p.sum(1, keepdims=True)
    loss = -(weight * np.log(p[np.arange(40), own])).sum() / weight.sum() + 0.05 * (theta[:-1] ** 2).sum()
    p[np.arange(40), own] -= 1
    p *= weight[:, None]
    assert value == pytest.approx(loss, abs=1e-12)
    expected = np.vstack([x.T @ p, p.sum(0)]) / weight.sum()
    expected[:-1] += 0.1 * theta[:-1]
    assert np.abs(gradient - expected).max() < 1e-12


def test_a_feature_that_never_varies_has_no_coefficient(spark):
    """The others are fitted to that, as Spark ML does it."""
    rows = [(Vectors.sparse(3, [0, 1 + i % 2], [1.0, 1.0]), float(i % 4 == 0), 1.0) for i in range(40)]
    vectors = spark.createDataFrame(rows, ["features", "_label", "weight"])
    model = classifier._minimised(vectors, 2, 3, 1 / 40, 100)
    assert not model.coefficientMatrix.toArray()[:, 0].any()
    held = np.vstack([model.coefficientMatrix.toArray().T, model.interceptVector.toArray()])
    gradient = softmax.objective(vectors, 2, 3, 1 / 40)(held)[1]
    assert np.abs(gradient[1:]).max() <= 2e-6


def test_a_start_from_a_part_saves_passes_over_all_rows(spark, monkeypatch):
    """The least of the objective stays the same, and nothing stays on the executors' disks."""
    monkeypatch.setattr(softmax, "BLOCK", 400)
    monkeypatch.setattr(softmax, "LEAST_PART", 400)
    rng = np.random.default_rng(11)
    x = (rng.random((3000, 30)) < 0.2) * rng.random((3000, 30)) * 4.0 ** -rng.integers(0, 5, 30)
    own = (x @ rng.normal(size=(30, 3)) * 4 + rng.normal(size=(3000, 3))).argmax(1)
    rows = [(Vectors.sparse(30, [(int(j), float(r[j])) for j in r.nonzero()[0]]), float(k), 1.0) for r, k in zip(x, own)]
    vectors = spark.createDataFrame(rows, ["features", "_label", "weight"]).repartition(3)
    at = softmax.objective(vectors, 3, 30, 1 / 3000)
    calls = []

    def counted(theta):
        calls.append(0)
        return at(theta)

    zero = softmax.minimum(counted, np.zeros((31, 3)), 500, 1e-6)
    passes, calls = len(calls), []
    some = softmax.start(at, 500, 1e-5)
    assert some.any()
    theta = softmax.minimum(counted, some, 500, 1e-6)
    assert 0 < len(calls) < passes
    assert np.abs(at(theta)[1]).max() <= 1e-6 and at(theta)[0] == pytest.approx(at(zero)[0], abs=1e-7)
    at.release()
    assert not at.blocks.is_cached
