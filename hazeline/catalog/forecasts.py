"""Split, score, registry, model, forecast and alert queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.catalog import sql
from hazeline.catalog.features import complete_frame
from hazeline.catalog.panel import PANEL_SQL, panel, r6, rounded, s6
from hazeline.catalog.registration import query
from hazeline.learn import explain, ridge_path, training, validation
from hazeline.learn.models import builder, fit
from hazeline.operators import alerts, forecast, metrics
from hazeline.operators.splits import blocks, fold_table, holdout
from hazeline.operators.targets import delta_target
from hazeline.schema import MODEL_FEATURES
from hazeline.session import scratch_path, written
from hazeline.sources.registry import best_version, next_versions, production_model, training_winner

SCORES = ("r2", "mae", "mse", "rmse", "skill_vs_naive")
_ranked = PANEL_SQL + ",\n" + sql.ranked("panel")


# ---- splits -----------------------------------------------------------------

@query("holdout_split", _ranked + f"""
select city, date, case when {sql.IS_TRAIN} then 'train' else 'test' end as split from ranked""")
def holdout_split(spark, sf_dir):
    return holdout(written(panel(spark, sf_dir), "panel")).select("city", "date", "split")


def _blocks(source: str = "ranked") -> str:
    steps = " + ".join(f"cast(rk >= total - {5 - i} * (total // 6) as int)" for i in range(5))
    return f"blocked as (select *, {steps} as block from {source})"


@query("timeseries_folds", _ranked + ",\n" + _blocks() + """,
f as (select cast(i as int) as fold from range(1, 6) as r(i))
select fold, case when block = fold then 'test' else 'train' end as split, count(*) as n,
  min(date) as first_date, max(date) as last_date
from blocked join f on block <= fold group by 1, 2""")
def timeseries_folds(spark, sf_dir):
    return fold_table(blocks(written(panel(spark, sf_dir), "panel")))


@query("fold_blocks", _ranked + ",\n" + _blocks() + "\nselect city, date, cast(block as int) as block from blocked")
def fold_blocks(spark, sf_dir):
    return blocks(written(panel(spark, sf_dir), "panel")).select("city", "date", "block")


# ---- scores of simple forecasters -------------------------------------------

def candidate_predictions(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(model, horizon, city, date, actual, predicted, naive) for columns that serve as a forecast."""
    outcome = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"aqi_next_{h}d").alias("actual")) for h in (1, 2, 3)
    ])
    guess = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("predicted")) for m, c in sql.CANDIDATES.items()
    ])
    out = rows.select("city", "date", F.col("european_aqi").alias("naive"), guess.alias("_guess"),
                      *extra, F.inline(outcome)).where("actual is not null")
    return out.select("city", "date", "horizon", "actual", "naive", *extra, F.inline("_guess"))


def scored_part(spark, sf_dir) -> DataFrame:
    """The last 30 percent: enough for rows whose three-day outcome is known."""
    return holdout(complete_frame(spark, sf_dir), sql.SCORED_SHARE).where("split = 'test'")


def test_predictions(spark, sf_dir) -> DataFrame:
    return candidate_predictions(scored_part(spark, sf_dir))


def candidate_scores(spark, sf_dir) -> DataFrame:
    return metrics.score(test_predictions(spark, sf_dir), ["model", "horizon"])


@query("naive_forecast", sql.CANDIDATE_SCORES + f"""
select horizon, n, {sql.rounded(*SCORES)} from scored where model = 'naive'""")
def naive_forecast(spark, sf_dir):
    scores = metrics.score(metrics.persistence(scored_part(spark, sf_dir), (1, 2, 3)), ["horizon"])
    return rounded(scores, *SCORES).select("horizon", "n", *SCORES)


@query("metrics", sql.CANDIDATE_SCORES + f"""
select model, horizon, n, {sql.rounded(*SCORES, 'naive_r2', 'naive_rmse')} from scored""")
def score_rows(spark, sf_dir):
    return rounded(candidate_scores(spark, sf_dir), *SCORES, "naive_r2", "naive_rmse")


@query("leaderboard", sql.CANDIDATE_SCORES + f"""
select model, horizon, {sql.rounded('skill_vs_naive', 'rmse')} from scored order by scored.skill_vs_naive desc""")
def leaderboard(spark, sf_dir):
    board = metrics.leaderboard(candidate_scores(spark, sf_dir))
    return rounded(board.select("model", "horizon", "skill_vs_naive", "rmse"), "skill_vs_naive", "rmse")


@query("skill_by_month", sql.engineered() + ",\n" + sql.ranked("complete") + ",\n" + sql.predictions() + f""",
monthly as (select *, cast(month(date) as int) as month from pred where model = 'mean_day' and horizon = 1),
scored as {sql.scores('month', 'monthly')}
select month, n, {sql.rounded('rmse', 'skill_vs_naive')} from scored""")
def skill_by_month(spark, sf_dir):
    rows = test_predictions(spark, sf_dir).where("model = 'mean_day' and horizon = 1")
    return rounded(metrics.skill_by_month(rows), "rmse", "skill_vs_naive")


@query("residuals", sql.engineered() + ",\n" + sql.ranked("complete") + ",\n" + sql.predictions() + f"""
select city, date, {sql.rounded('actual', 'predicted')}, {s6('actual - predicted')} as residual
from pred where model = 'ewm' and horizon = 1""")
def residuals(spark, sf_dir):
    rows = test_predictions(spark, sf_dir).where("model = 'ewm' and horizon = 1")
    out = metrics.residuals(rows.select("city", "date", "actual", "predicted"))
    return rounded(out, "actual", "predicted", "residual")


_fold_scores = (
    sql.engineered() + ",\nready as (select * from complete where aqi_next_1d is not null),\n" + sql.ranked("ready")
    + ",\n" + _blocks() + ",\n" + sql.predictions("blocked", "block > 0", ", cast(block as int) as fold")
    + ",\nscored as " + sql.scores("fold", "pred where model = 'mean_day' and horizon = 1")
)


def fold_predictions(spark, sf_dir) -> DataFrame:
    ready = complete_frame(spark, sf_dir).where("aqi_next_1d is not null")
    rows = blocks(ready).where("block > 0").withColumn("fold", F.col("block"))
    return candidate_predictions(rows, ("fold",)).where("model = 'mean_day' and horizon = 1")


@query("walk_forward_naive", _fold_scores + f"""
select fold, n, {sql.rounded(*SCORES, 'naive_r2', 'naive_rmse')} from scored""")
def walk_forward_naive(spark, sf_dir):
    return rounded(metrics.score(fold_predictions(spark, sf_dir), ["fold"]), *SCORES, "naive_r2", "naive_rmse")


@query("walk_forward_summary", _fold_scores + "\n" + "\nunion all ".join(
    f"select '{m}' as metric, {s6(f'avg({m})')} as mean, {s6(f'stddev_samp({m})')} as std from scored"
    for m in ("r2", "rmse", "skill_vs_naive")
))
def walk_forward_summary(spark, sf_dir):
    scores = metrics.score(fold_predictions(spark, sf_dir), ["fold"])
    return rounded(metrics.fold_summary(scores, ["r2", "rmse", "skill_vs_naive"]), "mean", "std")


# ---- registry ---------------------------------------------------------------

_versions = sql.engineered() + ",\n" + sql.ranked("complete") + ",\n" + _blocks() + ",\n" + sql.predictions(
    "blocked", "block > 0", ", cast(block as int) as fold"
) + ",\nscored as " + sql.scores("model, horizon, fold") + """,
runs as (select 'aqi_' || model || '_h' || horizon as name, *,
  row_number() over (partition by model, horizon order by fold) as version from scored)"""


def fold_runs(spark, sf_dir) -> DataFrame:
    """One run per model, horizon and fold, as a registry would see them over time."""
    rows = blocks(complete_frame(spark, sf_dir)).where("block > 0").withColumn("fold", F.col("block"))
    scores = metrics.score(candidate_predictions(rows, ("fold",)), ["model", "horizon", "fold"])
    name = F.concat(F.lit("aqi_"), "model", F.lit("_h"), F.col("horizon").cast("string"))
    return written(scores.withColumn("name", name), "runs")


def versioned_runs(spark, sf_dir) -> DataFrame:
    runs = fold_runs(spark, sf_dir)
    early = next_versions(runs.where("fold <= 3"), None, "fold")
    late = next_versions(runs.where("fold > 3"), early, "fold")
    return early.unionByName(late)


@query("register_versions", _versions + f"""
select name, cast(version as int) as version, {sql.rounded('rmse', 'skill_vs_naive')} from runs""")
def register_versions(spark, sf_dir):
    out = versioned_runs(spark, sf_dir).select("name", F.col("version").cast("int"), "rmse", "skill_vs_naive")
    return rounded(out, "rmse", "skill_vs_naive")


@query("best_version", _versions + f"""
select name, cast(version as int) as version, {s6('rmse')} as rmse from (
  select *, row_number() over (partition by name order by rmse, version) as rn from runs) where rn = 1""")
def best_versions(spark, sf_dir):
    best = best_version(versioned_runs(spark, sf_dir))
    return best.select("name", F.col("version").cast("int"), r6(F.col("rmse")).alias("rmse"))


_turn = "list_position(['" + "', '".join(sql.CANDIDATES) + "'], model)"


@query("production_model", _versions + f""",
best as (select *, row_number() over (partition by name order by rmse, version) as rn from runs)
select horizon, model, cast(version as int) as version, {s6('rmse')} as rmse from (
  select *, row_number() over (partition by horizon order by coalesce(rmse, 999999), {_turn}) as place
  from best where rn = 1) where place = 1""")
def production(spark, sf_dir):
    best = best_version(versioned_runs(spark, sf_dir)).select("model", "horizon", "version", "rmse")
    chosen = production_model(best, list(sql.CANDIDATES))
    return chosen.select("horizon", "model", F.col("version").cast("int"), r6(F.col("rmse")).alias("rmse"))


@query("training_winner", sql.CANDIDATE_SCORES + f"""
select horizon, model, {sql.rounded('skill_vs_naive', 'rmse')} from (
  select *, row_number() over (partition by horizon order by skill_vs_naive desc nulls last, {_turn}) as place
  from scored) where place = 1""")
def winner(spark, sf_dir):
    best = training_winner(candidate_scores(spark, sf_dir), list(sql.CANDIDATES))
    return rounded(best.select("horizon", "model", "skill_vs_naive", "rmse"), "skill_vs_naive", "rmse")


# ---- forecasts and alerts ---------------------------------------------------

_newest = ",\nnewest as (select * from (select *, row_number() over (partition by city order by date desc) as rn " \
          "from complete) where rn = 1)"


@query("forecast_interval", sql.CANDIDATE_SCORES + _newest + f"""
select city, horizon as day, {s6('european_aqi')} as current_aqi, {s6('european_aqi')} as predicted_aqi,
  {s6('european_aqi - 1.96 * rmse')} as ci_low, {s6('european_aqi + 1.96 * rmse')} as ci_high,
  'naive' as model_used, 1 as model_version
from newest join scored on model = 'naive' and horizon <= 2""")
def forecast_interval(spark, sf_dir):
    rows = complete_frame(spark, sf_dir)
    test = holdout(rows, sql.SCORED_SHARE).where("split = 'test'")
    scores = metrics.score(metrics.persistence(test, (1, 2)), ["horizon"])  # no model for day 3: left out
    models = scores.select(
        F.col("horizon").alias("day"), F.lit("naive").alias("model_used"), F.lit(1).alias("model_version"), "rmse"
    )
    table = forecast.forecast_rows(forecast.persistence_forecast(rows, (1, 2, 3)), models)
    return rounded(table, "current_aqi", "predicted_aqi", "ci_low", "ci_high")


def recent_guesses(spark, sf_dir) -> DataFrame:
    """(city, day, predicted_aqi): three simple guesses for the days after the newest row."""
    newest = forecast.latest_rows(panel(spark, sf_dir).select("city", "date", "european_aqi", "pm10", "pm2_5"))
    guess = F.array(*[
        F.struct(F.lit(d).alias("day"), v.alias("predicted_aqi"))
        for d, v in ((1, F.col("european_aqi") * 2), (2, F.col("pm10")), (3, F.col("pm2_5") + 90))
    ])
    return newest.select("city", "date", F.col("european_aqi").alias("current_aqi"), F.inline(guess))


_guesses = PANEL_SQL + """,
last as (select * from (select *, row_number() over (partition by city order by date desc) as rn from panel) where rn = 1),
guesses as (select city, date, european_aqi as current_aqi, 1 as day, european_aqi * 2 as predicted_aqi from last
  union all select city, date, european_aqi, 2, pm10 from last
  union all select city, date, european_aqi, 3, pm2_5 + 90 from last)"""
_band = """case when {0} <= 50 then 'Good' when {0} <= 100 then 'Moderate'
  when {0} <= 150 then 'Unhealthy for Sensitive Groups' when {0} <= 200 then 'Unhealthy'
  when {0} <= 300 then 'Very Unhealthy' else 'Hazardous' end"""


@query("forecast_peak", _guesses + f"""
select city, {s6('max(predicted_aqi)')} as peak, {_band.format('max(predicted_aqi)')} as label,
  case when max(predicted_aqi) > 150 then 'bad' when max(predicted_aqi) > 100 then 'moderate' else 'none' end as tier
from guesses group by city""")
def forecast_peak(spark, sf_dir):
    return rounded(forecast.forecast_peak(recent_guesses(spark, sf_dir)), "peak")


@query("forecast_labels", PANEL_SQL + """
select city, cast(d as int) as day, strftime(cast(max(date) as date) + cast(d as int), '%a %b %d') as label
from panel, range(1, 4) as r(d) group by city, d""")
def forecast_labels(spark, sf_dir):
    return forecast.forecast_labels(panel(spark, sf_dir), (1, 2, 3))


@query("aqi_alerts", _guesses + f""",
every as (select city, 'current' as kind, 0 as day, current_aqi as value from guesses where day = 1
  union all select city, 'forecast', day, case when day = 2 then null else predicted_aqi end from guesses)
select city, kind, day, {s6('value')} as value, {_band.format('value')} as label,
  case when kind = 'current'
    then city || ': index ' || printf('%.0f', value) || ' now, ' || {_band.format('value')} || '; limit 40'
    else city || ': index ' || printf('%.0f', value) || ' expected on day +' || day || ', ' || {_band.format('value')}
      || '; limit 40' end as message
from every where value > 40""")
def aqi_alerts(spark, sf_dir):
    missing = F.when(F.col("day") != 2, F.col("predicted_aqi"))
    by_day = F.transform(
        F.array_sort(F.collect_list(F.struct("day", missing.alias("p")))), lambda s: s["p"]  # three rows per city
    )
    readings = recent_guesses(spark, sf_dir).groupBy("city", "current_aqi").agg(by_day.alias("predictions"))
    return rounded(alerts.aqi_alerts(readings, threshold=40), "value")


@query("model_decay", sql.CANDIDATE_SCORES + f""",
decay as (select a.horizon, a.rmse, b.rmse as baseline_rmse, (a.rmse - b.rmse) / b.rmse * 100 as degradation
  from scored a join scored b on a.horizon = b.horizon and a.model = 'naive' and b.model = 'mean_day')
select horizon, {sql.rounded('rmse', 'baseline_rmse', 'degradation')},
  'horizon ' || horizon || ': error ' || printf('%.2f', baseline_rmse) || ' -> ' || printf('%.2f', rmse) || ', up by percent '
    || printf('%.1f', degradation) as message
from decay where degradation > 20""")
def model_decay(spark, sf_dir):
    scores = written(candidate_scores(spark, sf_dir), "scores")
    found = alerts.decay_alerts(scores.where("model = 'naive'"), scores.where("model = 'mean_day'"))
    return rounded(found, "rmse", "baseline_rmse", "degradation")


# ---- fitted models (checked by row count, by tests, and ridge by its gradient) ----

def split_rows(spark, sf_dir, horizon=1) -> tuple[DataFrame, DataFrame]:
    rows = holdout(delta_target(complete_frame(spark, sf_dir), horizon))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def _register_model(name, kind):
    def run(spark, sf_dir):
        train, test = split_rows(spark, sf_dir)
        model = fit(kind, written(train, "train"), 1)
        return model.predict(test).select("city", "date", F.col("target").alias("actual"), "predicted")

    query(name)(run)


for _name, _kind in {"ridge_forecast": "linear", "rf_forecast": "random_forest", "gbt_forecast": "boosted"}.items():
    _register_model(_name, _kind)


@query("boosting_curve")
def boosting_curve(spark, sf_dir):
    train = written(split_rows(spark, sf_dir)[0], "train")
    return explain.boosting_curve(fit("boosted", train, 1), train)


@query("top_features")
def top_features(spark, sf_dir):
    train = written(split_rows(spark, sf_dir)[0], "train")
    return explain.top_features(fit("random_forest", train, 1), train)


@query("linear_attribution")
def linear_attribution(spark, sf_dir):
    train, test = split_rows(spark, sf_dir)
    return explain.linear_attribution(fit("linear", train, 1), test)


RIDGE_PENALTIES = tuple(10.0 ** (k / 4) for k in range(-8, 16))


@query("ridge_walk_forward")
def ridge_walk_forward(spark, sf_dir):
    """Five folds, both penalties in use."""
    return ridge_path.ridge_walk_forward(delta_target(complete_frame(spark, sf_dir), 1), (0.1, 1.0))


@query("ridge_search")
def ridge_search(spark, sf_dir):
    """24 penalties, five folds, two passes over the rows."""
    return ridge_path.ridge_search(delta_target(complete_frame(spark, sf_dir), 1), RIDGE_PENALTIES)


@query("ridge_gradient", f"""
select cast(f as int) as fold, cast(a as double) as alpha, c as feature, 0.0::double as gradient
from range(1, 6) as r(f), (select unnest([0.1, 1.0]) as a), (select unnest({MODEL_FEATURES!r}) as c)""")
def ridge_gradient(spark, sf_dir):
    """0 for each fold, penalty and feature, if the coefficients from moments solve the fit."""
    blocked = written(blocks(delta_target(complete_frame(spark, sf_dir), 1)), "blocked")
    left = ridge_path.gradients(blocked, ridge_path.fit_path(blocked, (0.1, 1.0)))
    return left.select("fold", "alpha", "feature", (F.round(F.abs("gradient"), 9) + 0.0).alias("gradient"))


# Several fits of ensembles: smaller ones, whose full sizes take many minutes (figures in the README).
FEW = {"random_forest": {"numTrees": 10, "maxDepth": 6}, "boosted": {"maxIter": 10, "stepSize": 0.1, "maxDepth": 3}}


@query("training_run")
def training_run(spark, sf_dir):
    scores, _ = training.run(complete_frame(spark, sf_dir), settings=FEW)
    return scores


@query("horizon_comparison")
def horizon_comparison(spark, sf_dir):
    scores, _ = training.run(complete_frame(spark, sf_dir), settings=FEW)
    return training.horizon_comparison(scores)


@query("walk_forward")
def walk_forward(spark, sf_dir):
    rows = delta_target(complete_frame(spark, sf_dir), 1)
    return validation.walk_forward(rows, builder("random_forest", 1, FEW["random_forest"]))


@query("grid_search")
def grid_search(spark, sf_dir):
    """All combinations of the full grid, five folds, with a twentieth of the trees and a third of their depth."""
    rows = delta_target(complete_frame(spark, sf_dir), 1)
    grid = {**validation.FOREST_GRID, "numTrees": [5, 8], "maxDepth": [4, 5]}
    return validation.search(rows, "random_forest", 1, validation.combinations(grid))


@query("random_search")
def random_search(spark, sf_dir):
    rows = delta_target(complete_frame(spark, sf_dir), 1)
    space = {**validation.FOREST_SPACE, "numTrees": [5, 10], "maxDepth": [3, 5]}
    return validation.search(rows, "random_forest", 1, validation.sampled(space, 3))
