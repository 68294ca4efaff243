import math
import random

import pytest
from pyspark.sql import functions as F

from stopline.operators import features as feat
from stopline.operators import metrics, scoring, splits
from stopline.plans import train
from stopline.session import work_path
from stopline.sources import tables as tb
from tests.conftest import at, plus

T = at("2026-08-12 16:00:00")


def timed(spark, seconds, late=None):
    rows = [(plus(T, s), bool(late[i]) if late else False) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "scheduled_arrival timestamp, late boolean")


def sizes(df):
    got = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    return got.get("train", 0), got.get("test", 0)


@pytest.mark.parametrize(
    "seconds,fraction,wanted",
    [
        (range(10), 0.7, (7, 3)),
        ([0] * 10, 0.7, (10, 0)),
        ([0, 1, 2, 3, 4, 5, 5, 5, 5, 9], 0.7, (9, 1)),
        (range(10), 0.0, (0, 10)),
        (range(10), 1.0, (10, 0)),
        ([0], 0.7, (0, 1)),
        ([0, 0, 0, 90000, 90000, 90000, 90000, 90000, 90000, 90000], 0.3, (3, 7)),
    ],
)
def test_split_sizes(spark, seconds, fraction, wanted):
    assert sizes(splits.temporal_split(timed(spark, list(seconds)), fraction)) == wanted


def test_split_never_shares_a_time(spark):
    rng = random.Random(3)
    df = splits.temporal_split(timed(spark, [rng.randrange(40) * 60 for _ in range(300)]))
    both = df.groupBy("scheduled_arrival").agg(F.countDistinct("split").alias("n")).filter("n > 1")
    assert both.count() == 0


def test_summary_and_preliminary(spark):
    df = splits.temporal_split(timed(spark, range(10), late=[1, 1, 0, 0, 0, 0, 0, 1, 1, 0]))
    rows = {r["split"]: r for r in splits.split_summary(df).collect()}
    assert (rows["train"]["late_rows"], rows["test"]["late_rows"]) == (2, 2)
    assert abs(splits.on_time_reference(df).first()["accuracy"] - 1 / 3) < 1e-12
    assert splits.preliminary_flag(timed(spark, [0, 7 * 86400 - 1])).first()["preliminary"] is True
    assert splits.preliminary_flag(timed(spark, [0, 7 * 86400])).first()["preliminary"] is False


def features(spark, rows):
    schema = (
        "split string, route_id string, hour_of_day int, late boolean, route_hour_historical_late_rate double, "
        "headway_seconds int, day_of_week int, current_delay_persistence_seconds int, scheduled_arrival timestamp"
    )
    base = dict(split="train", route_id="1", hour_of_day=8, late=False, rate=None, headway=None, dow=1, delay=None, at=T)
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], schema)


def test_baselines_fall_back_to_the_train_rate_and_zero(spark):
    df = features(
        spark,
        [dict(late=True, rate=0.9, delay=181), dict(rate=0.1, delay=180), dict(split="test", late=True), dict(split="test", late=True)],
    )
    got = {(r["candidate"], r["split"], r["score"]) for r in scoring.baseline_scores(df).collect()}
    assert ("baseline_route_hour_rate", "test", 0.5) in got and ("baseline_persistence", "test", 0.0) in got
    assert ("baseline_persistence", "train", 1.0) in got and ("baseline_persistence", "train", 0.0) in got
    assert {s for c, _, s in got if c == "baseline_always_on_time"} == {0.0}


def test_frozen_rate_uses_train_only_and_never_a_default(spark):
    df = features(spark, [dict(late=True), dict(), dict(split="test", late=True, rate=0.7), dict(split="test", hour_of_day=9, rate=0.7)])
    got = {(r["split"], r["hour_of_day"]): r["route_hour_historical_late_rate"] for r in splits.with_frozen_rate(df).collect()}
    assert got == {("train", 8): 0.5, ("test", 8): 0.5, ("test", 9): None}


def scored(spark, pairs, candidate="c", split="test"):
    return spark.createDataFrame([(candidate, split, y, float(s)) for y, s in pairs], "candidate string, split string, y int, score double")


def reference_metrics(pairs, wanted=0.8):
    """Brute force over every distinct score."""
    positives = sum(y for y, _ in pairs)
    ap, last, best, cut = 0.0, 0.0, None, None
    for t in sorted({s for _, s in pairs}, reverse=True):
        called = [y for y, s in pairs if s >= t]
        precision, recall = sum(called) / len(called), sum(called) / positives
        ap += (recall - last) * precision
        last = recall
        if precision >= wanted:
            best, cut = max(best or 0.0, recall), t
    wins = [(a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z]
    return ap, sum(wins) / len(wins), best, cut


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_match_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(120)]
    got = metrics.ranking_metrics(metrics.score_curve(scored(spark, pairs))).first()
    ap, roc, best, cut = reference_metrics(pairs)
    assert math.isclose(got["pr_auc"], ap, abs_tol=1e-12) and math.isclose(got["roc_auc"], roc, abs_tol=1e-12)
    assert got["recall_at_precision"] == best and got["threshold"] == cut


def test_average_precision_and_roc_disagree_on_rare_positives(spark):
    pairs = [(0, 0.9), (0, 0.8), (1, 0.7), (1, 0.6)] + [(0, 0.1)] * 28
    got = metrics.ranking_metrics(metrics.score_curve(scored(spark, pairs))).first()
    assert math.isclose(got["pr_auc"], (1 / 3 + 2 / 4) / 2) and math.isclose(got["roc_auc"], 56 / 60)
    assert got["recall_at_precision"] is None and got["threshold"] is None


def test_confusion_edges(spark):
    points = metrics.score_curve(scored(spark, [(1, 0.9), (0, 0.8), (1, 0.2), (0, 0.1)]))
    row = metrics.confusion(points, F.lit(0.8), ["candidate"]).first()
    assert [row[c] for c in ("tn", "fp", "fn", "tp", "precision", "recall", "accuracy")] == [1, 1, 1, 1, 0.5, 0.5, 0.5]
    never = metrics.confusion(points, F.lit(2.0), ["candidate"]).first()
    assert (never["tp"], never["precision"], never["recall"]) == (0, None, 0.0)
    unset = metrics.confusion(points, F.lit(None).cast("double"), ["candidate"]).first()
    assert unset["tn"] is None and unset["accuracy"] is None


def test_threshold_comes_from_train(spark):
    both = scored(spark, [(1, 0.9), (1, 0.6), (0, 0.5)], split="train").unionByName(scored(spark, [(1, 0.7), (0, 0.65), (1, 0.1)]))
    row = metrics.evaluate(both).first()
    assert (row["train_threshold"], row["tp"], row["fp"], row["fn"]) == (0.6, 1, 1, 1)


def test_best_candidate_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "candidate string, pr_auc double")
    assert metrics.best_candidate(df).first()["candidate"] == "a"


def test_training_run(spark, labels):
    rng = random.Random(5)
    rows, log_path, models = [], work_path(spark, "log"), work_path(spark, "models")
    for i in range(400):
        delay = rng.choice([0, 60, 240, 400])
        rows.append(dict(trip_id=f"t{i // 8}", stop_id=f"s{i % 8}", scheduled_arrival=plus(T, 90 * i), delay_seconds=delay + 30 * (i % 3)))
    from stopline.operators import features as feat

    closed = labels(*rows)
    run = train.train(feat.build(closed), closed, log_path, models, scoring.ModelRules(logistic_iterations=20, boosting_rounds=2), "v1")
    names = {r["candidate"] for r in run.results.collect()}
    assert names == {*scoring.BASELINES, *scoring.MODELS} and run.best in scoring.MODELS
    assert {r["kind"] for r in run.log.collect()} == {"baseline", "model", "sensitivity"}
    assert tb.read(spark, log_path).count() == 7
    base = {r["candidate"]: r["pr_auc"] for r in run.results.collect()}
    for r in run.sensitivity.collect():
        assert math.isclose(r["pr_auc_delta"], r["pr_auc"] - base[r["candidate"]])


def test_exact_medians_fill_the_logistic_features(spark):
    df = features(spark, [dict(headway=10), dict(headway=20), dict(headway=900), dict()])
    medians = scoring.feature_medians(df)
    assert medians["headway_seconds"] == 20.0 and medians["route_hour_historical_late_rate"] == 0.0
    assert sorted(r["headway_seconds_x"] for r in scoring.with_median_fill(df, medians).collect()) == [10.0, 20.0, 20.0, 900.0]


def test_the_training_set_is_joined_once_and_rates_of_known_size_are_broadcast(spark, labels):
    T0 = at("2026-08-12 16:00:00")
    df = labels(*[dict(trip_id=f"t{i}", scheduled_arrival=plus(T0, 60 * i), delay_seconds=300 * (i % 2)) for i in range(10)])
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    rows = train.prepare(feat.build(df), df)
    assert sizes(rows) == (7, 3)
    assert "Join" not in plan(rows) and "Exchange" not in plan(rows)
    frozen = splits.with_frozen_rate(rows)
    assert "BroadcastHashJoin" in plan(frozen) and "Exchange hashpartitioning" not in plan(frozen)


def test_scored_rows_are_read_once_for_all_metrics(spark):
    scored = spark.range(40).selectExpr("'m' AS candidate", "if(id % 2 = 0, 'train', 'test') AS split", "cast(id % 3 = 0 AS int) AS y", "id / 40 AS score")
    for df in (metrics.ranking_metrics(metrics.score_curve(scored)), metrics.evaluate(scored)):
        assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
