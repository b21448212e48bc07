"""Early stopping on held-out area, against brute force over all prefixes."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from riskframe.operators import boosting


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=(3, 1200)).round(1)
    y = (a + 0.5 * b * b + rng.normal(size=1200) > 1).astype(int)
    data = [tuple(map(float, r[:3])) + (int(r[3]), i % 3 == 0) for i, r in enumerate(zip(a, b, c, y))]
    df = spark.createDataFrame(data, "a double, b double, c double, label int, held_out boolean")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.fixture(scope="module")
def learner():
    return GBTClassifier(maxDepth=3, stepSize=0.6, subsamplingRate=0.7, seed=9)


def plain_area(pairs):
    wins = sum((p > n) + (p == n) / 2 for p, y in pairs if y for n, z in pairs if not z)
    return wins / (sum(y for _, y in pairs) * sum(1 - y for _, y in pairs))


def test_area_of_every_round_equals_brute_force(rows, learner):
    train, held = rows.where("not held_out"), rows.where("held_out")
    model = learner.copy({learner.maxIter: 12}).fit(train)
    areas = boosting.staged_auc(model, held, "label")
    for count in (1, 2, 5, 12):
        alone = learner.copy({learner.maxIter: count}).fit(train)
        scored = alone.transform(held).select(vector_to_array("rawPrediction")[1].alias("s"), "label")
        assert areas[count - 1] == pytest.approx(plain_area([tuple(r) for r in scored.collect()]), abs=1e-12)
        short = boosting.first_trees(model, count).transform(held)
        pairs = short.select(vector_to_array("rawPrediction")[1].alias("s")).collect()
        assert [r.s for r in pairs] == [r.s for r in scored.collect()]


def test_kept_rounds_are_the_best_within_patience(rows, learner, monkeypatch, tmp_path):
    monkeypatch.setattr(boosting, "FIRST_FIT", 4)
    train, held = rows.where("not held_out"), rows.where("held_out")
    areas = boosting.staged_auc(learner.copy({learner.maxIter: 30}).fit(train), held, "label")
    for patience in (2, 6):
        best = at = 0
        for number, area in enumerate(areas, 1):
            if area > best:
                best, at = area, number
            elif number - at == patience:
                break
        kept = boosting.fit_with_patience(learner, train, held, "label", 30, patience)
        assert kept.getNumTrees == at < 30
    kept.save(str(tmp_path / "kept"))
    again = GBTClassificationModel.load(str(tmp_path / "kept"))
    a, b = (m.transform(held).select("probability").collect() for m in (kept, again))
    assert a == b and again.numFeatures == 3


def test_best_round():
    assert boosting.best_round([0.5, 0.7, 0.7, 0.6, 0.9], 2) == (2, True)
    assert boosting.best_round([0.5, 0.7, 0.7, 0.6, 0.9], 3) == (5, False)
    assert boosting.best_round([0.5], 1) == (1, False)
    assert boosting.best_round([0.5, 0.5], 1) == (1, True)


def test_stopping_rows_of_one_class_are_refused(rows, learner):
    held = rows.where("held_out and label = 1")
    with pytest.raises(ValueError, match="both label classes"):
        boosting.fit_with_patience(learner, rows.where("not held_out"), held, "label", 3, 1)
    with pytest.raises(ValueError):
        boosting.fit_with_patience(learner, rows, held, "label", 3, 0)
