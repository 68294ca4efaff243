"""Queries on features, verification, splits, baselines, models and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline.catalog import inputs
from stopline.catalog.registry import query
from stopline.catalog.sql import KEY, check
from stopline.operators import features as feat
from stopline.operators import gates, metrics, prefix, scoring, splits, verify
from stopline.plans import train as plan

FEATURES = (
    f"{KEY}, route_hour_historical_late_rate, headway_seconds, hour_of_day, day_of_week, "
    "current_delay_persistence_seconds"
)
SET = f"{KEY}, scheduled_arrival, delay_seconds, late, " + FEATURES[len(KEY) + 2 :]

# --- features


@query(
    "w_route_hour_rate",
    check("SELECT DISTINCT route_id, hour_of_day, scheduled_arrival, route_hour_historical_late_rate FROM ft"),
)
def _(spark, sf):
    return feat.earlier_rate(feat.route_hour_history(inputs.training(spark, sf)))


@query("w_headway", check("SELECT DISTINCT route_id, direction_id, stop_id, scheduled_arrival, headway_seconds FROM ft"))
def _(spark, sf):
    return feat.previous_arrivals(inputs.training(spark, sf))


@query(
    "w_persistence",
    check("SELECT DISTINCT trip_id, service_date_norm, scheduled_arrival, current_delay_persistence_seconds FROM ft"),
)
def _(spark, sf):
    return feat.previous_delays(inputs.training(spark, sf))


@query("build_features", check(f"SELECT {FEATURES} FROM ft"))
def _(spark, sf):
    return feat.build(inputs.training(spark, sf))


SINCE, UNTIL = "2026-10-25 12:00:00", "2026-11-08 06:30:00"


@query(
    "window_filter",
    check(f"SELECT {FEATURES} FROM ft WHERE scheduled_arrival >= TIMESTAMP '{SINCE}' AND scheduled_arrival < TIMESTAMP '{UNTIL}'"),
)
def _(spark, sf):
    since, until = (F.lit(t).cast("timestamp") for t in (SINCE, UNTIL))
    return feat.build(inputs.training(spark, sf), since, until)


@query("j_training_set", check(f"SELECT {SET} FROM ft"))
def _(spark, sf):
    return inputs.training_set(spark, sf)


@query("training_order", check(f"SELECT {SET} FROM ft ORDER BY scheduled_arrival, {KEY}"))
def _(spark, sf):
    return feat.training_order(inputs.training_set(spark, sf))


@query(
    "j_semi_keys",
    check(f"SELECT {FEATURES} FROM ft WHERE scheduled_arrival >= TIMESTAMP '{SINCE}' AND scheduled_arrival < TIMESTAMP '{UNTIL}'"),
)
def _(spark, sf):
    since, until = (F.lit(t).cast("timestamp") for t in (SINCE, UNTIL))
    return feat.written_in_window(inputs.features(spark, sf), inputs.training(spark, sf), since, until)


@query(
    "gate_features",
    check(
        """
SELECT 'volume' AS gate, n >= 1 AS passed, n || ' rows written (threshold: >= 1)' AS detail FROM (SELECT count(*) AS n FROM ft)
UNION ALL
SELECT 'historical_rate_coverage', true,
       printf('%d/%d rows have history (%.2f%%, threshold: >= 0.0%%)', k, n, CAST(100.0 * k / n AS DOUBLE))
FROM (SELECT count(*) AS n, count(route_hour_historical_late_rate) AS k FROM ft)"""
    ),
)
def _(spark, sf):
    return gates.gate_rows(gates.feature_gates(inputs.features(spark, sf)))


# --- verification


@query("w_recompute_check", check("SELECT count(*) AS compared, CAST(0 AS BIGINT) AS mismatches FROM ft"))
def _(spark, sf):
    return verify.recompute_check(inputs.features(spark, sf), inputs.labels(spark, sf))


@query(
    "w_null_arithmetic",
    check(
        "SELECT (SELECT count(*) FROM ft WHERE route_hour_historical_late_rate IS NULL) AS null_rates, "
        "(SELECT count(*) FROM (SELECT rank() OVER (PARTITION BY route_id, hour_of_day ORDER BY scheduled_arrival) AS r FROM tr) WHERE r = 1) AS first_in_bucket"
    ),
)
def _(spark, sf):
    return verify.null_arithmetic(inputs.features(spark, sf), inputs.training(spark, sf))


@query("w_newest_contributor", check("SELECT count(*) AS checked, CAST(0 AS BIGINT) AS from_the_future FROM ft"))
def _(spark, sf):
    return verify.newest_contributor(inputs.features(spark, sf), inputs.labels(spark, sf))


# --- splits


@query("w_split_cut", check("SELECT cut_at FROM cut"))
def _(spark, sf):
    return splits.split_cut(inputs.training_set(spark, sf))


@query("temporal_split", check(f"SELECT {SET}, split FROM sp"))
def _(spark, sf):
    return splits.temporal_split(inputs.training_set(spark, sf))


SUMMARY = """
SELECT split, count(*) AS rows, min(scheduled_arrival) AS first_scheduled_arrival, max(scheduled_arrival) AS last_scheduled_arrival,
       CAST(sum(CAST(late AS INTEGER)) AS BIGINT) AS late_rows, sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS late_rate
FROM sp GROUP BY 1"""


@query("split_summary", check(SUMMARY))
def _(spark, sf):
    return splits.split_summary(inputs.split_rows(spark, sf))


@query("union_splits", check(f"SELECT split, rows, late_rows FROM ({SUMMARY})"))
def _(spark, sf):
    cut_rows = splits.temporal_split(inputs.training_set(spark, sf))
    return splits.split_summary(cut_rows).select("split", "rows", "late_rows")


@query(
    "on_time_reference",
    check(
        "SELECT 1 - sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS accuracy, "
        "sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS pr_auc FROM sp WHERE split = 'test'"
    ),
)
def _(spark, sf):
    return splits.on_time_reference(inputs.split_rows(spark, sf))


@query(
    "preliminary_flag",
    check(
        "SELECT (epoch_us(max(scheduled_arrival)) - epoch_us(min(scheduled_arrival))) / 1e6 / 86400 AS window_days, "
        "(epoch_us(max(scheduled_arrival)) - epoch_us(min(scheduled_arrival))) / 1e6 / 86400 < 7 AS preliminary FROM ft"
    ),
)
def _(spark, sf):
    return splits.preliminary_flag(inputs.training_set(spark, sf))


RATES = """
SELECT route_id, hour_of_day, sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS frozen_rate
FROM sp WHERE split = 'train' GROUP BY 1, 2"""


@query("route_hour_rate", check(RATES))
def _(spark, sf):
    return splits.route_hour_rate(inputs.split_rows(spark, sf))


@query(
    "j_frozen_rate",
    check(f"SELECT {KEY}, split, frozen_rate AS route_hour_historical_late_rate FROM sp LEFT JOIN ({RATES}) USING (route_id, hour_of_day)"),
)
def _(spark, sf):
    frozen = splits.with_frozen_rate(inputs.split_rows(spark, sf))
    return frozen.select(*KEY.split(", "), "split", "route_hour_historical_late_rate")


# --- baselines


def _baseline(name):
    sql = check(
        f"SELECT split, score, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM bs WHERE candidate = '{name}' GROUP BY ALL"
    )

    def build(spark, sf):
        scored = scoring.baseline_scores(inputs.split_rows(spark, sf), [name])
        return scored.groupBy("split", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))

    return sql, build


for _key, _name in (
    ("baseline_always_on_time", "baseline_always_on_time"),
    ("baseline_route_hour", "baseline_route_hour_rate"),
    ("baseline_persistence", "baseline_persistence"),
):
    _sql, _build = _baseline(_name)
    query(_key, _sql)(_build)


@query(
    "coalesce_defaults",
    check(
        f"SELECT {KEY}, coalesce(route_hour_historical_late_rate, (SELECT rate FROM tlr)) AS rate, "
        "coalesce(current_delay_persistence_seconds, 0) AS persistence FROM sp"
    ),
)
def _(spark, sf):
    rows = inputs.split_rows(spark, sf)
    return rows.select(
        *KEY.split(", "),
        scoring.route_hour_score(scoring.late_rate(rows).scalar()).alias("rate"),
        F.coalesce("current_delay_persistence_seconds", F.lit(0)).alias("persistence"),
    )


# --- metrics


def _curve(spark, sf):
    return metrics.score_curve(scoring.baseline_scores(inputs.split_rows(spark, sf)))


@query(
    "w_pr_cumulative",
    check('SELECT candidate, split, score, true_positives, predicted, "precision", recall FROM cv'),
)
def _(spark, sf):
    return _curve(spark, sf).select("candidate", "split", "score", "true_positives", "predicted", "precision", "recall")


def _ranked(key, column, rounded):
    def build(spark, sf):
        value = F.round(column, 9) if rounded else F.col(column)
        return metrics.ranking_metrics(_curve(spark, sf)).select("candidate", "split", value.alias(column))

    query(key, check(f"SELECT candidate, split, {column} FROM rk"))(build)


_ranked("pr_auc", "pr_auc", True)
_ranked("roc_auc", "roc_auc", True)
_ranked("recall_at_precision", "recall_at_precision", False)
_ranked("threshold_for_precision", "threshold", False)

CONFUSION = """
SELECT candidate, tn, fp, fn, tp, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS "precision",
       tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall, (tn + tp) / CAST(nullif(tn + fp + fn + tp, 0) AS DOUBLE) AS accuracy
FROM (SELECT candidate, count(*) FILTER (WHERE score < t AND y = 0) AS tn, count(*) FILTER (WHERE score >= t AND y = 0) AS fp,
             count(*) FILTER (WHERE score < t AND y = 1) AS fn, count(*) FILTER (WHERE score >= t AND y = 1) AS tp
      FROM ({rows}) GROUP BY 1)"""


@query(
    "confusion_at_threshold",
    check(CONFUSION.format(rows="SELECT *, CAST(0.3 AS DOUBLE) AS t FROM bs WHERE split = 'test'")),
)
def _(spark, sf):
    test = _curve(spark, sf).filter(F.col("split") == "test")
    return metrics.confusion(test, F.lit(0.3), ["candidate"])


@query(
    "evaluate_candidates",
    check(
        f"""
SELECT r.candidate, r.pr_auc, r.roc_auc, r.recall_at_precision, t.threshold AS train_threshold,
       CASE WHEN t.threshold IS NOT NULL THEN tn END AS tn, CASE WHEN t.threshold IS NOT NULL THEN fp END AS fp,
       CASE WHEN t.threshold IS NOT NULL THEN fn END AS fn, CASE WHEN t.threshold IS NOT NULL THEN tp END AS tp,
       CASE WHEN t.threshold IS NOT NULL THEN c."precision" END AS "precision",
       CASE WHEN t.threshold IS NOT NULL THEN c.recall END AS recall,
       CASE WHEN t.threshold IS NOT NULL THEN c.accuracy END AS accuracy
FROM (SELECT * FROM rk WHERE split = 'test') r JOIN (SELECT * FROM rk WHERE split = 'train') t USING (candidate)
JOIN ({CONFUSION.format(rows="SELECT bs.*, k.threshold AS t FROM bs JOIN rk k ON k.candidate = bs.candidate AND k.split = 'train' WHERE bs.split = 'test'")}) c USING (candidate)"""
    ),
)
def _(spark, sf):
    results = metrics.evaluate(scoring.baseline_scores(inputs.split_rows(spark, sf)))
    return results.withColumns({c: F.round(c, 9) for c in ("pr_auc", "roc_auc")})


# --- fitted models: what must hold of any right fit, and the results themselves

SIZES = "SELECT split, count(*) AS rows, CAST(sum(CAST(late AS INTEGER)) AS BIGINT) AS positives FROM sp GROUP BY split"


def _train(spark, sf):
    return inputs.split_rows(spark, sf).filter(F.col("split") == "train")


def _scores_of(spark, sf, name):
    return scoring.score_check(inputs.model_scores(spark, sf).filter(F.col("candidate") == name))


@query(
    "logistic_regression",
    check(
        "SELECT 'logistic_regression' AS candidate, split, rows, positives, CAST(0 AS BIGINT) AS outside, true AS stationary "
        f"FROM ({SIZES})"
    ),
)
def _(spark, sf):
    """Rows and positives scored, scores outside 0 to 1, and whether the loss is flat at the fit."""
    steepest = scoring.logistic_gradient(inputs.fitted(spark, sf), _train(spark, sf)).scalar()
    return _scores_of(spark, sf, "logistic_regression").withColumn("stationary", steepest < 1e-4)


@query(
    "gradient_boosting",
    check(
        "SELECT 'gradient_boosting' AS candidate, split, rows, positives, CAST(0 AS BIGINT) AS outside, "
        f"0 AS leaf_errors, 0 AS refit_errors FROM ({SIZES})"
    ),
)
def _(spark, sf):
    """Rows and positives scored, scores outside 0 to 1, leaves off their Newton step, nodes a refit changes."""
    model = inputs.fitted(spark, sf).models["gradient_boosting"]
    found = scoring.boosting_check(model, _train(spark, sf), inputs.QUERY_MODELS)
    return _scores_of(spark, sf, "gradient_boosting").withColumns({k: F.lit(n) for k, n in found.items()})


@query("best_model", check("SELECT CAST(2 AS BIGINT) AS candidates, CAST(0 AS BIGINT) AS better, true AS among_them"))
def _(spark, sf):
    """The models compared, those with a larger PR-AUC than the best one, and whether it is one of them."""
    results = metrics.evaluate(inputs.model_scores(spark, sf))
    best = metrics.best_candidate(results).select(F.struct("candidate", "pr_auc")).scalar()
    return results.withColumn("best", best).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("pr_auc") > F.col("best.pr_auc")).alias("better"),
        F.bool_or(F.col("candidate") == F.col("best.candidate")).alias("among_them"),
    )


@query(
    "frozen_sensitivity",
    check(
        f"""
SELECT candidate, split, rows, positives, CAST(0 AS BIGINT) AS outside, true AS compared
FROM ({SIZES}) CROSS JOIN (VALUES ('logistic_regression'), ('gradient_boosting')) AS m(candidate)"""
    ),
)
def _(spark, sf):
    """Per refitted model and split: rows and positives scored, scores outside 0 to 1, and whether the
    change in PR-AUC is known and is a difference of two such areas."""
    frozen = inputs.frozen_scores(spark, sf)
    changed = plan.frozen_sensitivity(frozen, metrics.evaluate(inputs.model_scores(spark, sf)))
    delta = F.col("pr_auc_delta")
    sound = changed.select("candidate", F.coalesce((F.abs(delta) <= 1) & (delta == F.col("pr_auc") - F.col("base_pr_auc")), F.lit(False)).alias("compared"))
    return scoring.score_check(frozen).join(F.broadcast(sound), "candidate")  # one row per model


@query(
    "experiment_log",
    check(
        f"""
SELECT 'check' AS run_id, c.candidate, c.kind, a.rows AS train_rows, b.rows AS test_rows,
       round(a.late_rows / CAST(a.rows AS DOUBLE), 4) AS train_late_rate, round(b.late_rows / CAST(b.rows AS DOUBLE), 4) AS test_late_rate,
       (SELECT (epoch_us(max(scheduled_arrival)) - epoch_us(min(scheduled_arrival))) / 1e6 / 86400 < 7 FROM ft) AS preliminary,
       CASE WHEN c.kind = 'baseline' THEN r.pr_auc END AS pr_auc, CASE WHEN c.kind = 'baseline' THEN r.roc_auc END AS roc_auc, true AS measured
FROM (SELECT DISTINCT candidate, 'baseline' AS kind FROM rk UNION ALL VALUES ('logistic_regression', 'model'), ('gradient_boosting', 'model')) c
LEFT JOIN (SELECT * FROM rk WHERE split = 'test') r USING (candidate)
CROSS JOIN (SELECT * FROM ({SUMMARY}) WHERE split = 'train') a CROSS JOIN (SELECT * FROM ({SUMMARY}) WHERE split = 'test') b"""
    ),
)
def _(spark, sf):
    """The log's rows: facts of the splits, metrics of the baselines, and that the models have theirs in range."""
    rows = inputs.split_rows(spark, sf)
    scored = scoring.baseline_scores(rows).unionByName(inputs.model_scores(spark, sf))
    log = plan.experiment_log(metrics.evaluate(scored), rows, "check")
    params, found = F.col("params"), F.col("metrics")
    of_baseline = lambda name: F.when(F.col("kind") == "baseline", F.round(found[name], 9)).alias(name)
    return log.select(
        "run_id", "candidate", "kind",
        *[params[f"{s}_rows"].cast("long").alias(f"{s}_rows") for s in ("train", "test")],
        *[params[f"{s}_late_rate"].cast("double").alias(f"{s}_late_rate") for s in ("train", "test")],
        "preliminary", of_baseline("pr_auc"), of_baseline("roc_auc"),
        F.coalesce(found["pr_auc"].between(0, 1) & found["roc_auc"].between(0, 1), F.lit(False)).alias("measured"),
    )


@query("model_results")
def _(spark, sf):
    """Metrics of every candidate, the refitted models with their change in PR-AUC."""
    rows = inputs.split_rows(spark, sf)
    base = metrics.evaluate(scoring.baseline_scores(rows).unionByName(inputs.model_scores(spark, sf)))
    frozen = plan.frozen_sensitivity(inputs.frozen_scores(spark, sf), base).drop("base_pr_auc")
    named = frozen.withColumn("candidate", F.concat("candidate", F.lit("_frozen_route_hour")))
    return base.withColumn("pr_auc_delta", F.lit(None).cast("double")).unionByName(named)


@query(
    "feature_medians",
    check(
        """
SELECT 'route_hour_historical_late_rate' AS feature, median(route_hour_historical_late_rate) AS median FROM sp WHERE split = 'train'
UNION ALL SELECT 'headway_seconds', median(CAST(headway_seconds AS DOUBLE)) FROM sp WHERE split = 'train'
UNION ALL SELECT 'hour_of_day', median(CAST(hour_of_day AS DOUBLE)) FROM sp WHERE split = 'train'
UNION ALL SELECT 'day_of_week', median(CAST(day_of_week AS DOUBLE)) FROM sp WHERE split = 'train'
UNION ALL SELECT 'current_delay_persistence_seconds', median(CAST(current_delay_persistence_seconds AS DOUBLE)) FROM sp WHERE split = 'train'"""
    ),
)
def _(spark, sf):
    train = inputs.split_rows(spark, sf).filter(F.col("split") == "train")
    counts = scoring.feature_counts(train)
    return prefix.median_of(counts, "value", ["feature"])
