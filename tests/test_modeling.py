import random
from datetime import date

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F
from orderloom.constants import MODEL_FEATURES
from orderloom.operators import boosting, modeling, quality
from orderloom.operators.features import assemble
from orderloom.plans.reports import run_forecast
from tests.conftest import by_key, rows_of


def months(spark, n):
    rows = [(date(2000 + i // 12, i % 12 + 1, 1), p, "R1", i) for i in range(n) for p in ("P1", "P2")]
    return spark.createDataFrame(rows, "Month date, Product_ID string, Region_ID string, Actual_Demand bigint")


@pytest.mark.parametrize("n, trains, size", [(18, [6, 10, 14], 4), (62, [17, 32, 47], 15), (4, [1, 2, 3], 1)])
def test_folds_expand_and_never_look_ahead(spark, n, trains, size):
    frame = months(spark, n)
    folds = modeling.month_folds(frame)
    for (train, valid), expected in zip(folds, trains):
        assert train.select("Month").distinct().count() == expected
        assert valid.select("Month").distinct().count() == size and valid.count() == 2 * size
        assert train.agg({"Month": "max"}).first()[0] < valid.agg({"Month": "min"}).first()[0]
    table = by_key(modeling.fold_table(frame), "fold")
    assert [table[i]["train_rows"] for i in (1, 2, 3)] == [2 * t for t in trains]
    assert table[3]["validation_end"] == frame.agg({"Month": "max"}).first()[0]


def test_too_few_months(spark):
    with pytest.raises(ValueError):
        modeling.month_folds(months(spark, 3))


def test_default_grids_match_the_documented_search():
    forest, boosted = modeling.rf_candidates(), modeling.boosted_candidates()
    assert len(forest.grid) == 4 and len(boosted.grid) == 8
    assert forest.estimator.getNumTrees() == 200 and forest.estimator.getSeed() == 42
    assert forest.estimator.getFeatureSubsetStrategy() == "all"


def plain_boosting(x, y, trees, leaves, rate, least):
    """Best-first trees, one split after the other, on raw values in whole numbers."""
    def rounded(top, bottom):
        size = (2 * abs(top) + bottom) // (2 * bottom)
        return size if top >= 0 else -size

    score, out = [rounded(sum(y) * boosting.SCALE, len(y))] * len(y), []
    for _ in range(trees):
        residual = [v * boosting.SCALE - s for v, s in zip(y, score)]
        parts = {1: list(range(len(y)))}

        def best(rows):
            found = None
            total = sum(residual[i] for i in rows)
            for f in range(len(x[0])):
                for v in sorted({x[i][f] for i in rows})[:-1]:
                    left = [i for i in rows if x[i][f] <= v]
                    if min(len(left), len(rows) - len(left)) >= least:
                        part = sum(residual[i] for i in left)
                        gain = float(part) * part / len(left) + float(total - part) * (total - part) / (len(rows) - len(left))
                        gain -= float(total) * total / len(rows)
                        if gain > 0 and (found is None or gain > found[0]):
                            found = (gain, f, v)
            return found

        options = {1: best(parts[1])}
        while len(parts) < leaves and any(options.values()):
            node = max((v for v in options if options[v]), key=lambda v: (options[v][0], -v))
            _, f, v = options.pop(node)
            rows = parts.pop(node)
            for child, own in ((2 * node, [i for i in rows if x[i][f] <= v]), (2 * node + 1, [i for i in rows if x[i][f] > v])):
                parts[child], options[child] = own, best(own)
        values = {n: rounded(rate * sum(residual[i] for i in rows), 100 * len(rows)) for n, rows in parts.items()}
        out.append({n: (len(rows), values[n]) for n, rows in parts.items()})
        for n, rows in parts.items():
            for i in rows:
                score[i] += values[n]
    return out, score


def test_boosted_trees_equal_one_split_after_the_other(spark):
    rng = random.Random(1)
    x = [(rng.randint(0, 12), rng.choice((0.5, 1.5, 9.0)), 7, rng.randint(0, 40) / 4) for _ in range(160)]
    y = [int(9 * a + 30 * (b > 1) * (a > 4) + 5 * d + rng.randint(0, 9)) for a, b, _, d in x]
    rows = [(date(2020 + i % 4, 1, 1), *v, t) for i, (v, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "Month date, a int, b double, c int, d double, Actual_Demand bigint").repartition(5)
    whole, early = boosting.Fit(30, 7), boosting.Fit(50, 4, date(2022, 1, 1), date(2022, 1, 1))
    done = boosting.boost(frame, [whole, early], ["a", "b", "c", "d"], 3, [1, 3], least_rows=5)
    leaves, score = plain_boosting(x, y, 3, 7, 30, 5)
    assert done.leaves[0] == leaves
    predicted = {r["k"]: r["prediction"] for r in done.models[0].transform(
        spark.createDataFrame([(i, *v) for i, v in enumerate(x)], "k int, a int, b double, c int, d double")).collect()}
    assert predicted == {i: s / boosting.SCALE for i, s in enumerate(score)}
    train = [i for i, r in enumerate(rows) if r[0] < date(2022, 1, 1)]
    assert done.leaves[1] == plain_boosting([x[i] for i in train], [y[i] for i in train], 3, 4, 50, 5)[0]
    valid = frame.where("Month = date'2022-01-01'")
    for stage in (1, 3):
        off = F.avg(F.abs(F.col("prediction") - F.col("Actual_Demand")))
        assert done.errors[1, stage] == pytest.approx(done.models[1].first(stage).transform(valid).agg(off).first()[0])
    with pytest.raises(ValueError):
        boosting.boost(frame, [boosting.Fit(10, 3, date(2019, 1, 1), date(2020, 1, 1))], ["a"], 1)


def test_passes_of_boosting_join_nothing_however_deep_the_trees(spark, monkeypatch):
    plans, grouped = [], boosting.best_splits

    def spied(held, least_rows):
        plans.append(held._jdf.queryExecution().optimizedPlan().toString())
        return grouped(held, least_rows)

    monkeypatch.setattr(boosting, "best_splits", spied)
    rows = [(date(2020, 1 + i % 3, 1), i, 2 ** (i // 6)) for i in range(60)]
    frame = spark.createDataFrame(rows, "Month date, a int, Actual_Demand bigint")
    done = boosting.boost(frame, [boosting.Fit(50, 6), boosting.Fit(50, 4)], ["a"], 1, least_rows=2)
    assert [len(trees[0]) for trees in done.leaves] == [6, 4] and max(done.leaves[0][0]) >= 8
    assert len(plans) >= 4 and not any("Join" in p for p in plans)


@pytest.mark.parametrize("units", [1, 10**9])
def test_fits_of_one_task_equal_those_of_shared_passes(spark, units):
    rng = random.Random(6)
    rows = [(date(2020, 1 + i % 6, 1), rng.randint(0, 30), rng.choice((0.25, 4.0)), 7, i % 300) for i in range(400)]
    rows = [(*r, units * (7 * r[1] + 40 * (r[2] > 1) * (r[4] > 90) - r[4] // 3)) for r in rows]
    frame = spark.createDataFrame(rows, "Month date, a int, b double, c int, d int, Actual_Demand bigint").repartition(3)
    fits = [boosting.Fit(10, 9), boosting.Fit(50, 4, date(2020, 4, 1), date(2020, 5, 1)), boosting.Fit(30, 1, date(2020, 3, 1), date(2020, 3, 1))]
    passes, tasks = (
        boosting.boost(frame, fits, ["a", "b", "c", "d"], 3, [1, 3], least_rows=4, rows_per_task=n) for n in (0, 400)
    )
    assert tasks.leaves == passes.leaves and tasks.models == passes.models
    assert [len(trees[2]) for trees in tasks.leaves] == [9, 4, 1]
    assert set(tasks.errors) == {(1, 1), (1, 3), (2, 1), (2, 3)} and tasks.errors == pytest.approx(passes.errors)
    with pytest.raises(ValueError):
        boosting.boost(frame, [boosting.Fit(10, 3, date(2019, 1, 1), date(2020, 6, 1))], ["a"], 1, rows_per_task=400)


def test_fits_of_few_rows_take_no_passes_and_more_rows_do(spark, monkeypatch):
    passes, grow = [], boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda *given: passes.append(1) or grow(*given))
    frame = spark.createDataFrame([(date(2020, 1, 1), i, i * i) for i in range(50)], "Month date, a int, Actual_Demand bigint")
    for most, expected in ((50, 0), (49, 2)):
        done = boosting.boost(frame, [boosting.Fit(10, 3)], ["a"], 2, least_rows=5, rows_per_task=most)
        assert len(passes) == expected and len(done.models[0].trees) == 2


def test_model_selection_searches_all_boosted_iterations(monkeypatch):
    from types import SimpleNamespace

    from checks import catalog

    searched = []
    monkeypatch.setattr(catalog, "history", lambda star: SimpleNamespace(development=None))
    monkeypatch.setattr(catalog, "assemble", lambda frame: frame)
    monkeypatch.setattr(modeling, "search_all", lambda candidates, development: searched.extend(candidates))
    monkeypatch.setattr(modeling, "cv_results", lambda frame, searches: None)
    catalog.model_selection(None)
    boosted = next(c for c in searched if isinstance(c, modeling.BoostedCandidate))
    assert boosted.grid == modeling.boosted_candidates().grid
    assert {g["max_iter"] for g in boosted.grid} == {100, 200}


def test_many_values_share_bins_of_equal_rows(spark):
    frame = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    borders = boosting.bin_borders(frame, ["v", "w"], 10)
    assert borders == [[100.0 * i for i in range(1, 10)], []]
    bins = boosting.binned(frame, ["v", "w"], borders).select(F.get("bins", F.lit(0)).alias("b"), "v").collect()
    assert all(r["b"] == int(r["v"] // 100) for r in bins)


def test_boosted_search_scores_stages_of_shared_fits(spark):
    rng = random.Random(4)
    rows = [
        (date(2019 + i // 12, i % 12 + 1, 1), *[rng.randint(0, 50) for _ in MODEL_FEATURES], rng.randint(1, 90))
        for i in range(16) for _ in range(8)
    ]
    kinds = ", ".join(f"{c} int" for c in MODEL_FEATURES)
    frame = spark.createDataFrame(rows, f"Month date, {kinds}, Actual_Demand bigint")
    candidate = modeling.boosted_candidates(rates=(0.1, 0.5), iterations=(1, 2), leaves=(3,))
    scores, models = modeling.boosted_scores(candidate, frame)
    assert len(scores) == 12 and [len(m.trees) for m in models] == [1, 2, 1, 2]
    found = modeling.boosted_search(candidate, frame)
    means = [sum(mae for i, _, mae in scores if i == k) / 3 for k in range(4)]
    assert found.cv_mae == min(means) and found.params == candidate.grid[means.index(min(means))]


@pytest.fixture(scope="module")
def seasonal_orders(make_orders):
    rng = random.Random(5)
    rows, number = [], 0
    for product, base in (("P1", 40), ("P2", 90)):
        for region, factor in (("R1", 1.0), ("R2", 1.5)):
            for i in range(42):
                units = int(base * factor * (1 + 0.5 * ((i % 12) in (5, 6, 7)))) + rng.randint(0, 6)
                number += 1
                rows.append((str(number), f"{2020 + i // 12}-{i % 12 + 1:02}-11", "C1", product, region, units, 10.0 * units, 5))
    return make_orders(rows)


def test_forecast_run_end_to_end(seasonal_orders):
    candidates = [
        modeling.mean_baseline(),
        modeling.rf_candidates(trees=8, depths=(3, 6), leaves=(1,)),
        modeling.boosted_candidates(rates=(0.1,), iterations=(2, 4), leaves=(6,)),
    ]
    run = run_forecast(seasonal_orders, candidates)
    scores = {name: s.cv_mae for name, s in run.searches.items()}
    assert scores["random_forest"] < scores["mean_baseline"]
    assert run.searches["random_forest"].params["maxDepth"] in (3, 6)
    table = modeling.cv_results(run.results, run.searches).collect()
    assert [r["CV_MAE"] for r in table] == sorted(scores.values())
    assert run.results.count() == 6 * 4
    assert quality.check_key(run.results, "Month", "Product_ID", "Region_ID").count() == 0
    rules = quality.count_broken_rules(run.results, quality.forecast_rules())
    assert all(r["violations"] == 0 for r in rules.collect())
    assert quality.check_actuals(run.results, run.history.observed).count() == 0
    assert quality.check_baseline(run.results, run.history.observed, "Naive_Forecast", 1).count() == 0
    assert quality.check_baseline(run.results, run.history.observed, "Seasonal_Naive_Forecast", 12).count() == 0
    chosen = run.selected_metrics.first()
    assert chosen["Model"] == min(scores, key=scores.get) and chosen["RMSE"] >= chosen["MAE"] > 0
    benchmark = by_key(modeling.benchmark_results(run.results), "Model")
    if chosen["Model"] == "random_forest":
        assert chosen["MAE"] == pytest.approx(benchmark["Random Forest"]["MAE"])
    again = by_key(quality.recomputed_metrics(run.results), "Model")
    for label in benchmark:
        assert benchmark[label]["MAE"] == pytest.approx(again[label]["mae"])
        assert benchmark[label]["RMSE"] == pytest.approx(again[label]["rmse"])


def test_fixed_seed_reproduces_predictions(seasonal_orders):
    from orderloom.operators.features import demand_history

    steps = demand_history(seasonal_orders)
    forest = modeling.rf_candidates(trees=4, depths=(4,), leaves=(3,))
    development, test = assemble(steps.development), assemble(steps.test)
    predicted = [
        sorted(rows_of(modeling.predict_rf(modeling.fit_selected(forest, development), test)
                       .select("Month", "Product_ID", "Region_ID", "Forecast_Demand")))
        for _ in range(2)
    ]
    assert predicted[0] == predicted[1]


def test_mean_model_and_feature_list(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,)], "label double")
    fitted = modeling.mean_baseline().estimator.fit(frame)
    scored = fitted.transform(frame)
    assert {r["prediction"] for r in scored.collect()} == {2.0}
    assert RegressionEvaluator(metricName="mae").evaluate(scored) == 1.0
    assert not {"Product_ID", "Region_ID"} & set(MODEL_FEATURES)
