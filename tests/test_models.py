from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from conftest import SMALL
from skytracks.operators.forest import apply_forests, assembler, feature_list, rmse_by_target
from skytracks.operators.motion import motion_inputs, with_motion
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.operators.split import in_train_part, random_parts
from skytracks.plans import fixtures
from skytracks.plans.predict import predict, predicted_positions
from skytracks.plans.silver import load_silver, silver_rows
from skytracks.plans.train import fit_and_evaluate, train, training_set
from skytracks.schemas import FEATURES_8, FEATURES_14, PREDICTION_COLUMNS, TARGETS
from skytracks.sources.lake import write_bronze
from skytracks.sources.models import load_forests, load_model, save_forests, save_model


@pytest.fixture(scope="module")
def silver(spark):
    return silver_rows(fixtures.bronze_reports(spark, SMALL)).cache()


@pytest.fixture(scope="module")
def rows(silver):
    return training_set(silver).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return fit_and_evaluate(rows)


def test_shape(fitted):
    model, errors = fitted
    assert feature_list(model) == list(FEATURES_14)
    assert [f.numFeatures for f in model.stages[1:]] == [14] * 3
    assert [f.getNumTrees for f in model.stages[1:]] == [50] * 3
    assert [r.target for r in errors.collect()] == list(TARGETS)


def test_rmse_equals_the_library_evaluator(rows, fitted):
    model, errors = fitted
    scored = apply_forests(model, assembler().transform(rows)).filter(~in_train_part())
    by_target = {r.target: r for r in errors.collect()}
    for name, label in TARGETS.items():
        evaluator = RegressionEvaluator(labelCol=label, predictionCol=f"predicted_{name}", metricName="rmse")
        assert by_target[name].rmse == pytest.approx(evaluator.evaluate(scored), rel=1e-9)
        assert by_target[name].rows == scored.count()
    assert rmse_by_target(scored).count() == 3


def test_same_seed_same_model(rows, fitted):
    again = fit_and_evaluate(rows)[1].collect()
    assert [r.rmse for r in again] == pytest.approx([r.rmse for r in fitted[1].collect()])


def test_saved_models_score_the_same(spark, silver, fitted, tmp_path):
    model = fitted[0]
    expected = sorted(map(tuple, predicted_positions(model, silver).collect()), key=str)
    save_model(model, str(tmp_path))
    save_model(model, str(tmp_path))
    assert sorted(map(tuple, predicted_positions(load_model(str(tmp_path)), silver).collect()), key=str) == expected
    save_forests(model, str(tmp_path))
    separate = load_forests(str(tmp_path))
    assert sorted(map(tuple, predicted_positions(separate, silver).collect()), key=str) == expected
    with pytest.raises(ValueError, match="14 features"):
        load_forests(str(tmp_path), FEATURES_8)


def test_scored_rows(silver, fitted):
    scored = predicted_positions(fitted[0], silver)
    assert scored.columns == list(PREDICTION_COLUMNS)
    aircraft = silver.select("icao24").distinct().count()
    assert scored.count() == silver.count() - aircraft  # the first report has no previous one


def test_short_feature_list(silver):
    rows = training_set(silver, FEATURES_8)
    model, _ = fit_and_evaluate(rows, FEATURES_8, num_trees=3)
    assert feature_list(model) == list(FEATURES_8)
    assert predicted_positions(model, silver).count() == silver.count()


def test_random_split(rows):
    moved = rows.select("icao24", "time_position")
    first, second = random_parts(moved)
    assert first.count() + second.count() == rows.count()
    assert first.intersect(second).isEmpty()
    model, errors = fit_and_evaluate(rows, split="random", num_trees=2)
    assert errors.collect()[0].rows < rows.count() / 2


def test_hash_split_ignores_partitioning(rows):
    flagged = [rows.repartition(n).select("icao24", "time_position", in_train_part().alias("t")) for n in (1, 5)]
    assert flagged[0].exceptAll(flagged[1]).isEmpty()
    share = flagged[0].filter("t").count() / rows.count()
    assert 0.75 < share < 0.85


def test_assembler_skips_missing_values(silver):
    moving = with_motion(motion_inputs(silver))
    missing = moving.filter("prev_lat IS NULL").count()
    assert missing and assembler().transform(moving).count() == moving.count() - missing


def test_train_and_predict_from_files(spark, tmp_path):
    bronze, silver, models, out = (str(tmp_path / n) for n in ("bronze", "silver", "models", "predictions"))
    write_bronze(with_ingest_hour(fixtures.bronze_reports(spark, SMALL)), bronze)
    load_silver(spark, bronze, silver, "full")
    assert train(spark, silver, models, num_trees=2).count() == 3
    for _ in range(2):
        predict(spark, silver, models, out)
    written = spark.read.parquet(out)
    assert written.columns == [*PREDICTION_COLUMNS, "ingest_date"] and written.count() == 873
