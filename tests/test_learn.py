import numpy as np
import pytest
from panels import raw_pandas, sorted_pandas, to_spark
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from hazeline.learn import boosting, explain, ridge_path, training, validation
from hazeline.learn.models import DeltaForecaster, builder, fit
from hazeline.operators import metrics
from hazeline.operators.features import add_features
from hazeline.operators.splits import blocks, holdout
from hazeline.operators.targets import delta_target
from hazeline.schema import MODEL_FEATURES
from hazeline.session import written

SMALL = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "boosted": {"maxIter": 5, "maxDepth": 3}}


@pytest.fixture(scope="module")
def snapshot(spark):
    """A panel whose index follows a daily cycle with a trend, so that there is something to learn."""
    raw = raw_pandas(rows=800, seed=3)
    rng = np.random.default_rng(0)
    hours = raw.groupby("city").cumcount()
    raw["european_aqi"] = 100 + 30 * np.sin(hours / 37) + rng.normal(0, 3, len(raw))
    return written(add_features(to_spark(spark, raw)), "snapshot")


@pytest.fixture(scope="module")
def parts(snapshot):
    rows = holdout(delta_target(snapshot, 1))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def test_ridge_equals_closed_form(parts):
    train, test = parts
    columns = ["european_aqi", "pm10", "aqi_lag_24h", "hour_sin"]
    model = fit("linear", train, 1, {"alpha": 5.0}, columns)
    p = train.toPandas()
    q1, q2, q3 = (p[columns].quantile(x) for x in (0.25, 0.5, 0.75))
    x, y = ((p[columns] - q2) / (q3 - q1)).to_numpy(), p.target_delta.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(4), xc.T @ yc)
    np.testing.assert_allclose(model.regressor.coefficients.toArray(), beta, rtol=1e-6)
    t = sorted_pandas(model.predict(test))
    delta = ((t[columns] - q2) / (q3 - q1)).to_numpy() @ beta + (y.mean() - x.mean(0) @ beta)
    np.testing.assert_allclose(t.predicted, t.european_aqi + delta, rtol=1e-6)


def test_no_target_among_features(parts):
    model = fit("linear", parts[0], 1)
    assert model.features == MODEL_FEATURES
    with pytest.raises(ValueError, match="no model of kind"):
        fit("svm", parts[0], 1)


@pytest.mark.parametrize("kind", ["linear", "random_forest", "boosted"])
def test_models_beat_persistence_and_survive_saving(parts, kind, tmp_path):
    train, test = parts
    settings = {"numTrees": 20, "maxDepth": 8} if kind == "random_forest" else {"maxIter": 40, "stepSize": 0.2}
    model = fit(kind, train, 1, None if kind == "linear" else settings)
    row = metrics.score(validation.scored_rows(model, test), []).first()
    assert row["skill_vs_naive"] > 0.1 and row["r2"] <= 1 and row["mae"] <= row["rmse"]
    assert row["mse"] == pytest.approx(row["rmse"] ** 2)
    model.save(str(tmp_path / kind))
    again = DeltaForecaster.load(str(tmp_path / kind))
    assert (again.kind, again.horizon, again.features) == (kind, 1, model.features)
    np.testing.assert_allclose(
        sorted_pandas(again.predict(test)).predicted, sorted_pandas(model.predict(test)).predicted, rtol=1e-6
    )


def test_scores_equal_numpy(spark):
    rng = np.random.default_rng(1)
    y, p, n = rng.normal(size=(3, 200))
    df = spark.createDataFrame(
        [("m", float(a), float(b), float(c)) for a, b, c in zip(y, p, n)],
        "model string, actual double, predicted double, naive double",
    )
    row = metrics.score(df, ["model"]).first()
    rmse, naive = np.sqrt(np.mean((y - p) ** 2)), np.sqrt(np.mean((y - n) ** 2))
    assert row["skill_vs_naive"] == pytest.approx(1 - rmse / naive)
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mae"] == pytest.approx(np.abs(y - p).mean())
    perfect = metrics.score(df.withColumn("naive", F.col("actual")), ["model"]).first()
    assert perfect["skill_vs_naive"] is None
    assert metrics.score(df, ["model"], naive=None).first()["skill_vs_naive"] is None


def test_walk_forward(snapshot):
    rows = delta_target(snapshot, 1)
    folds = validation.walk_forward(rows, builder("linear", 1)).toPandas().sort_values("fold")
    n = rows.count()
    assert list(folds.fold) == [1, 2, 3, 4, 5] and (folds.n == n // 6).all()
    summary = metrics.fold_summary(metrics.residuals(validation.walk_forward(rows, builder("linear", 1)), "rmse", "mae"),
                                   ["rmse"]).first()
    assert summary["mean"] == pytest.approx(folds.rmse.mean()) and summary["std"] == pytest.approx(folds.rmse.std())


def test_search(snapshot):
    rows = delta_target(snapshot, 1)
    grid = validation.combinations({"numTrees": [3], "maxDepth": [2, 6]})
    found = validation.search(rows, "random_forest", 1, grid, n_splits=2).toPandas()
    assert list(found.folds) == [2, 2] and found.mean_mse.is_monotonic_increasing
    assert len(validation.combinations(validation.FOREST_GRID)) == 24
    drawn = validation.sampled(validation.BOOSTED_SPACE, 30)
    assert len(drawn) == 30 and drawn == validation.sampled(validation.BOOSTED_SPACE, 30)
    assert len(validation.sampled({"a": [1, 2]}, 40)) == 2


def test_training_grid_survives_a_failing_model(snapshot):
    scores, fitted = training.run(
        snapshot, horizons=(1, 2), kinds=("linear", "random_forest", "boosted"),
        settings={**SMALL, "boosted": {"maxDepth": -4}},
    )
    assert set(fitted) == {(k, h) for k in ("linear", "random_forest") for h in (1, 2)}
    table = training.horizon_comparison(scores, (1, 2)).toPandas()
    assert sorted(table.model) == ["linear", "random_forest"] and table.notna().all().all()


def test_explanations(parts, spark):
    train, test = parts
    forest = fit("random_forest", train, 1, SMALL["random_forest"])
    top = explain.top_features(forest, train).toPandas()
    assert len(top) == 15 and top.importance.is_monotonic_decreasing and top.importance.sum() <= 1 + 1e-9
    linear = fit("linear", train, 1)
    got = explain.linear_attribution(linear, test).toPandas().set_index("feature")
    sample = linear.pipeline.stages[0].transform(test).toPandas()
    x = sample["_scaled_pm10"]
    beta = dict(zip(linear.features, linear.regressor.coefficients))["pm10"]
    assert got.loc["pm10", "mean_abs"] == pytest.approx((beta * (x - x.mean())).abs().mean(), rel=1e-6)


def test_curve_shows_every_round_and_the_best_is_kept(parts, spark):
    train, _ = parts
    model = fit("boosted", train, 1, {"maxIter": 60, "maxDepth": 3, "stepSize": 0.5, "patience": 4})
    explain.boosting_curve(model, train).createOrReplaceTempView("curve")
    # The kept rounds are those up to the best before four rounds went by without a better one.
    found = spark.sql("""
        with best as (select *, min(validation_rmse) over (order by round) as so_far from curve),
        firsts as (select so_far, min(round) as at from best group by so_far),
        ran_out as (select min(b.round) as round from best b join firsts f using (so_far) where b.round - f.at >= 4)
        select (select count(*) from curve) as n, (select max(round) from curve) as last, (select max(round) from curve where kept) as kept,
          (select min_by(round, validation_rmse) from curve where round <= coalesce((select round from ran_out), 60)) as wanted,
          (select count(*) from curve where kept and train_rmse is null or not kept and train_rmse is not null) as odd""").first()
    assert found.n == found.last and found.kept == found.wanted == model.regressor.getNumTrees and found.odd == 0
    assert found.kept + 4 <= found.n <= 60  # patience ran out, later trees were dropped


def test_chosen_round():
    assert boosting.chosen_round([3, 2, 1, 1, 1, 0.5], 3) == (6, False)
    assert boosting.chosen_round([3, 2, 1, 1, 1, 1, 0.5], 3) == (3, True)  # a later gain comes too late
    assert boosting.chosen_round([1.0], 3) == (1, False)


def test_first_rounds_are_those_of_a_shorter_fit(parts, tmp_path):
    train, test = parts
    rows = VectorAssembler(inputCols=["pm10", "aqi_lag_24h", "hour_sin"], outputCol="features").transform(train).select("features", "target_delta")
    long_, short = (GBTRegressor(labelCol="target_delta", maxIter=n, maxDepth=3, subsamplingRate=0.7, seed=1).fit(rows) for n in (8, 3))
    cut = boosting.first_rounds(long_, 3)
    one, other = (m.transform(rows).select("prediction").toPandas().prediction for m in (cut, short))
    np.testing.assert_allclose(one, other)
    assert cut.getNumTrees == 3 and cut.numFeatures == 3
    forest = RandomForestRegressor(labelCol="target_delta", numTrees=6, seed=1).fit(rows)
    some = boosting.first_trees(forest, 2)
    row = rows.first()["features"]
    assert some.getNumTrees == 2 and some.predict(row) == pytest.approx(np.mean([t.predict(row) for t in forest.trees[:2]]))


def test_ridge_of_all_folds_equals_fitting_each(snapshot):
    rows = delta_target(snapshot, 1)
    found = ridge_path.ridge_walk_forward(rows, (0.1, 30.0)).toPandas().set_index(["alpha", "fold"]).sort_index()
    for alpha in (0.1, 30.0):
        want = validation.walk_forward(rows, builder("linear", 1, {"alpha": alpha})).toPandas().set_index("fold").sort_index()
        for c in ("n", "r2", "mae", "mse", "rmse", "skill_vs_naive", "naive_r2", "naive_rmse"):
            np.testing.assert_allclose(found.loc[alpha][c], want[c], rtol=1e-7, err_msg=c)
    assert len(found) == 10
    blocked = written(blocks(rows), "blocked")
    left = ridge_path.gradients(blocked, ridge_path.fit_path(blocked, (0.1, 30.0))).toPandas()
    assert len(left) == 2 * 5 * len(MODEL_FEATURES) and left.gradient.abs().max() < 1e-9
    best = ridge_path.ridge_search(rows, (0.1, 30.0)).toPandas()
    assert best.mean_mse[0] == pytest.approx(min(found.loc[a]["mse"].mean() for a in (0.1, 30.0)))


def test_moments_merge():
    x = np.random.default_rng(4).normal(1e6, 1, (500, 3))
    whole, parts = ridge_path.Moments.of(x), [ridge_path.Moments.of(p) for p in np.array_split(x, 7)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    np.testing.assert_allclose(total.products, whole.products, rtol=1e-9, atol=1e-6)
    np.testing.assert_allclose(total.mean, whole.mean)


def test_search_goes_on_from_stored_scores(snapshot, spark, tmp_path, monkeypatch):
    rows = delta_target(snapshot, 1)
    grid = validation.combinations({"numTrees": [2, 4], "maxDepth": [2, 3]})
    scores = validation.TrialScores(spark, str(tmp_path / "scores"), "panel")
    fits, real = [], validation.fit

    def some_fits(*args):
        fits.append(args[3])
        if len(fits) == 4:
            raise RuntimeError("executor lost")
        return real(*args)

    monkeypatch.setattr(validation, "fit", some_fits)
    with pytest.raises(RuntimeError):
        validation.search(rows, "random_forest", 1, grid, n_splits=3, scores=scores, parallel=1)
    kept = scores.done()
    assert len(kept) in (6, 8)  # three fits, each scored at both sizes, and perhaps the next one
    before = len(fits)
    found = validation.search(rows, "random_forest", 1, grid, n_splits=3, scores=scores, parallel=1).toPandas()
    assert len(fits) - before == 6 - len(kept) // 2 and all(s["numTrees"] == 4 for s in fits)  # only fits without scores ran
    assert len(found) == 4 and (found.folds == 3).all() and len(scores.done()) == 12
    again = validation.search(rows, "random_forest", 1, grid, n_splits=3, scores=scores, parallel=1).toPandas()
    assert again.equals(found) and len(fits) - before == 6 - len(kept) // 2


def test_boosted_search(snapshot):
    rows = delta_target(snapshot, 1)
    some = [{**s, "maxIter": n} for s in validation.sampled(validation.BOOSTED_SPACE, 1) for n in (2, 4)]
    found = validation.search(rows, "boosted", 1, [{**s, "maxDepth": 2} for s in some], n_splits=2).toPandas()
    assert list(found.folds) == [2, 2] and found.mean_rmse.notna().all()
