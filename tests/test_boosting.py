"""Boosted trees against brute force, and what boosting promises of losses, stops, segments and missing values."""

import dataclasses
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import boosting

PLAN = boosting.Plan(steps=6, depth=3, rows=1.0, columns=1.0, min_rows=5, patience=500)


def make(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.random(), int(rng.integers(1, 30))
        mean = math.exp(1 + 2 * (a > 0.5) - b + 1.5 * (c in (3, 7, 11, 20)))
        missing = rng.random() < 0.1
        rows.append((f"s{i % 5}", i, "x" if i % 2 else "y", None if missing else float(a), float(b), c, int(rng.poisson(mean))))
    return spark.createDataFrame(rows, "id string, date int, store_id string, a double, b double, c int, Value int")


@pytest.fixture(scope="module")
def table(spark):
    return make(spark, 3000).persist()


def brute_fall(a, b, power):
    if b <= 0:
        return 0.0
    loss = lambda c: b * math.exp(c) - a * c if power == 1 else -a * math.exp((1 - power) * c) / (1 - power) + b * math.exp((2 - power) * c) / (2 - power)
    return loss(0) - (loss(math.log(a / b)) if a > 0 else 0.0)


def brute_split(rows, columns, power, min_rows):
    """The best split over every threshold and both sides for missing values: (gain, rows that go left)."""
    mean = sum(r["Value"] for r in rows) / len(rows)
    a = {r["date"]: r["Value"] * mean ** (1 - power) for r in rows}
    b = mean ** (2 - power)
    best = (0.0, None)
    for c in columns:
        for cut in sorted({r[c] for r in rows if r[c] is not None}):
            for missing_left in (True, False):
                left = {r["date"] for r in rows if (missing_left if r[c] is None else r[c] <= cut)}
                if min(len(left), len(rows) - len(left)) < min_rows:
                    continue
                la, ta = sum(a[k] for k in left), sum(a.values())
                gain = brute_fall(la, b * len(left), power) + brute_fall(ta - la, b * (len(rows) - len(left)), power)
                gain -= brute_fall(ta, b * len(rows), power)
                if gain > best[0] + 1e-9:
                    best = (gain, left)
    return best


@pytest.mark.parametrize("power", [1.0, 1.1, 1.5])
def test_first_split_is_the_brute_force_one(spark, power):
    # Few enough rows that every value is a bin of its own.
    table = make(spark, 200, 3).withColumn("a", F.round("a", 1)).withColumn("b", F.round("b", 1))
    rows = [r.asDict() for r in table.collect()]
    split = boosting.first_split(table, ["a", "b", "c"], dataclasses.replace(PLAN, power=power)).first()
    gain, left = brute_split(rows, ["a", "b", "c"], power, PLAN.min_rows)
    assert split["gain"] == pytest.approx(gain, rel=1e-4) and split["n"] == 200
    name = ["a", "b", "c"][split["feature"]]
    values = sorted({r[name] for r in rows if r[name] is not None})
    goes = {r["date"] for r in rows if (split["missing_left"] if r[name] is None else values.index(r[name]) < split["bin"])}
    assert goes == left


@pytest.mark.parametrize("power", [1.0, 1.1])
def test_loss_falls_each_step(table, power):
    model = boosting.boost(table, ["a", "b", "c"], dataclasses.replace(PLAN, power=power))
    losses = [x["loss"] for x in model.curve]
    assert len(losses) == PLAN.steps + 1 and all(x > y for x, y in zip(losses, losses[1:]))
    assert model.best.tolist() == [PLAN.steps]


def test_predictions_beat_the_mean_and_reruns_agree(table, monkeypatch):
    held = F.col("date") % 10 == 0
    plan = dataclasses.replace(PLAN, steps=25, rows=0.8, columns=0.8, rate=0.2, depth=4)
    first = boosting.boost(table, ["a", "b", "c"], plan, held)
    monkeypatch.setattr(boosting, "TASK_ROWS", 900)
    monkeypatch.setattr(boosting, "CELL_LIMIT", 0)
    again = boosting.boost(table.repartition(3, "b"), ["a", "b", "c"], dataclasses.replace(plan, steps=5), held)
    assert all(np.array_equal(x.feature, y.feature) and np.array_equal(x.left, y.left) for x, y in zip(first.trees[:5], again.trees)) and len(again.trees) == 5
    out = boosting.predict(first, table, ["id", "date"]).join(table, ["id", "date"]).filter(held)
    error = lambda p: out.agg(F.sqrt(F.avg((F.col("Value") - p) ** 2))).first()[0]
    mean = table.agg(F.avg("Value")).first()[0]
    assert out.count() == 300 and error(F.col("pred")) < 0.8 * error(F.lit(mean))
    # The curve's error at the chosen count is that of the predictions.
    assert min(x["rmse"] for x in first.curve) == pytest.approx(error(F.col("pred")), rel=1e-4)


def test_stop_is_that_of_the_whole_curve(table, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 3)
    held = F.col("date") % 3 == 0
    small = table.filter("date < 400")
    plan = dataclasses.replace(PLAN, steps=30, rate=0.5, min_rows=1)
    whole = boosting.boost(small, ["a", "b", "c"], plan, held)
    errors = [x["rmse"] for x in whole.curve]
    assert len(errors) == 31
    least = int(np.argmin(errors))
    stopped = boosting.boost(small, ["a", "b", "c"], dataclasses.replace(plan, patience=4), held)
    told = [x["rmse"] for x in stopped.curve]
    assert told == pytest.approx(errors[: len(told)])
    best = int(np.argmin(told))
    assert stopped.best.tolist() == [best] and len(stopped.trees) == best
    assert len(told) == min(31, best + 5) and whole.best.tolist() == [least]


def test_segments_grow_as_if_alone(table):
    plan = dataclasses.replace(PLAN, steps=4, rows=0.8)
    columns = ["a", "b", "c"]
    both = boosting.boost(table, columns, plan, segment="store_id")
    assert both.segments == ["x", "y"]
    got = {(r["id"], r["date"]): r["pred"] for r in boosting.predict(both, table, ["id", "date"], "store_id").collect()}
    for store in both.segments:
        mine = table.filter(F.col("store_id") == store)
        alone = boosting.Boosted(columns, both.borders, frozenset(), [store], both.base[[both.segments.index(store)]], plan)
        extra = {
            "segment": F.lit(0), "held": F.lit(False), "key": F.xxhash64("id", F.col("date").cast("string")),
            "y": F.col("Value").cast("double"), "margin": F.lit(float(alone.base[0])),
        }
        alone = boosting._steps(boosting._binned(mine, alone, extra), alone)
        for r in boosting.predict(alone, mine, ["id", "date"], "store_id").collect():
            assert got[r["id"], r["date"]] == pytest.approx(r["pred"], rel=1e-6)
    # A row of another store has no model.
    assert boosting.predict(both, table.withColumn("store_id", F.lit("z")), ["id", "date"], "store_id").count() == 0


def test_missing_values_go_where_the_loss_falls(spark):
    rows = [("s", i, None if i % 2 else float(i % 40), 9 if i % 2 or i % 40 > 20 else 1) for i in range(400)]
    table = spark.createDataFrame(rows, "id string, date int, a double, Value int")
    split = boosting.first_split(table, ["a"], PLAN).first()
    assert not split["missing_left"]
    low = boosting.first_split(table.withColumn("Value", 10 - F.col("Value")), ["a"], PLAN).first()
    assert not low["missing_left"]
    turned = table.withColumn("a", -F.col("a"))
    assert boosting.first_split(turned, ["a"], PLAN).first()["missing_left"]
    model = boosting.boost(table, ["a"], dataclasses.replace(PLAN, steps=30, rate=0.5))
    out = {r["date"]: r["pred"] for r in boosting.predict(model, table.drop("Value"), ["date"]).collect()}
    assert out[1] == pytest.approx(9, rel=0.01) and out[2] == pytest.approx(1, rel=0.01)
    # NaN is missing as well.
    odd = table.withColumn("a", F.coalesce("a", F.lit(float("nan"))))
    assert {r["date"]: r["pred"] for r in boosting.predict(model, odd, ["date"]).collect()} == out


def test_categories_no_threshold_separates(spark):
    rows = [("s", i, i % 12 + 1, 8 if i % 12 + 1 in (2, 5, 7, 12) else 1) for i in range(600)]
    table = spark.createDataFrame(rows, "id string, date int, c int, Value int")
    split = boosting.first_split(table, ["c"], PLAN, categorical=["c"]).first()
    chosen = set(split["bins"])
    assert chosen in ({2, 5, 7, 12}, set(range(1, 13)) - {2, 5, 7, 12})
    model = boosting.boost(table, ["c"], dataclasses.replace(PLAN, steps=1, rate=1.0, depth=1), categorical=["c"])
    out = {r["date"]: r["pred"] for r in boosting.predict(model, table, ["date"]).collect()}
    assert out[1] == pytest.approx(8, rel=1e-3) and out[2] == pytest.approx(1, rel=1e-3)


def test_borders_are_within_their_rank_error(spark):
    rng = np.random.default_rng(1)
    values = rng.lognormal(size=20_000)
    table = spark.createDataFrame([(float(v),) for v in values], "a double")
    (edges,) = boosting.borders(table.repartition(16), ["a"])
    rank = np.searchsorted(np.sort(values), edges, "right") / len(values)
    assert len(edges) == boosting.BINS - 1
    assert np.abs(rank - np.arange(1, boosting.BINS) / boosting.BINS).max() <= 1 / boosting.ACCURACY + 1 / len(values)


def test_no_column_is_sorted_for_its_borders(table):
    sketches = table.agg(F.percentile_approx("a", [0.5], boosting.ACCURACY), F.percentile_approx("b", [0.5], boosting.ACCURACY))
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and plan.count("Exchange") == 1


def test_only_named_tables_of_the_application_are_removed(spark, tmp_path):
    from shelfcast.session import forget, written

    path = str(tmp_path / "mine")
    spark.range(5).write.parquet(path)
    mine, kept, gone = spark.read.parquet(path), written(spark.range(5), "kept"), written(spark.range(5), "gone")
    for df in (mine, kept, gone):
        forget(df, "gone")
    assert mine.count() == kept.count() == 5
    with pytest.raises(Exception, match="(?i)not_exist|not exist"):
        gone.count()


def test_odd_tables(spark, table):
    none = table.limit(0)
    model = boosting.boost(none, ["a"], PLAN)
    assert boosting.predict(model, table, ["id", "date"]).count() == 0
    flat = table.withColumn("Value", F.lit(0))
    model = boosting.boost(flat, ["a"], PLAN)
    assert boosting.predict(model, table, ["id", "date"]).agg(F.max("pred")).first()[0] < 1e-9
    unlabelled = table.withColumn("Value", F.lit(None).cast("int"))
    assert boosting.boost(unlabelled, ["a"], PLAN).segments == []


def test_rows_and_cells_travel_together(table, monkeypatch):
    """A step's table has a row per block, a task sends a row per node and feature, and the cells are those of the rows."""
    seen = []
    real = boosting.written
    monkeypatch.setattr(boosting, "written", lambda df, label, *by: seen.append(real(df, label, *by)) or seen[-1])
    monkeypatch.setattr(boosting, "TASK_ROWS", 1000)
    model = boosting.boost(table, ["a", "b", "c"], dataclasses.replace(PLAN, steps=1), F.col("date") % 10 == 0)
    assert model.tasks == 3 and all(0 < t.count() <= 6 for t in seen)
    flat = boosting.Tree.empty(1, PLAN.depth)
    cells = boosting._cells(seen[0], model, [], flat, 0, 0, np.ones(1, bool))
    got = cells.filter("feature >= 0").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.count("*") == F.count_distinct("bin")).collect()
    known = table.filter("date % 10 <> 0")
    total = known.agg(F.sum("Value")).first()[0]
    assert sorted((r[0], r[1], r[2] / boosting.UNIT, r[3]) for r in got) == [(k, known.count(), total, True) for k in range(3)]


@pytest.mark.parametrize("power", [1.0, 1.1])
def test_trees_do_not_depend_on_where_cells_meet(table, monkeypatch, power):
    held = F.col("date") % 10 == 0
    plan = dataclasses.replace(PLAN, steps=2, depth=4, power=power, columns=0.7)
    grown = lambda: boosting.boost(table, ["a", "b", "c"], plan, held, "store_id", ["c"])
    driver = grown()
    monkeypatch.setattr(boosting, "TASK_ROWS", 400)
    monkeypatch.setattr(boosting, "MERGED_ROWS", 1)
    monkeypatch.setattr(boosting, "FEW_BYTES", 0)
    shuffled = grown()
    assert shuffled.tasks > 1 and len(driver.trees) == len(shuffled.trees) == 2
    for x, y in zip(driver.trees, shuffled.trees):
        assert np.array_equal(x.feature, y.feature) and np.array_equal(x.left, y.left) and np.allclose(x.value, y.value)
    assert [x["rmse"] for x in driver.curve] == pytest.approx([x["rmse"] for x in shuffled.curve])


def test_a_level_of_few_cells_is_one_job(spark, table, monkeypatch):
    """A step is short jobs, so each of them counts."""
    seen = []
    real = boosting.written
    monkeypatch.setattr(boosting, "written", lambda df, label, *by: seen.append(real(df, label, *by)) or seen[-1])
    monkeypatch.setattr(boosting, "TASK_ROWS", 1000)
    model = boosting.boost(table, ["a", "b", "c"], dataclasses.replace(PLAN, steps=0))
    context = spark.sparkContext
    context.setJobGroup("one-step", "one step")
    try:
        tree, _ = boosting._grow(seen[0], model, [], 0, np.ones(1, bool))
        jobs = context.statusTracker().getJobIdsForGroup("one-step")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert model.tasks == 3 and tree.feature[0, 4:8].max() >= 0 and len(jobs) == PLAN.depth
