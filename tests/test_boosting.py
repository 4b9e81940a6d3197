import json
import math

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from creditloom.operators import boosting
from creditloom.operators.boosting import Setting
from creditloom.plans import training
from creditloom.plans.trials import Trials

ROWS = "id long, inputs array<double>, label double, weight double, fold int"


def test_three_rows_by_hand(spark):
    """Margins 0, p = 1/2: gradients (1/2, -1/2, -1/2), hessians 1/4; lambda 1, no alpha.

    Cut at 2: left G 1/2, H 1/4; right G -1, H 1/2.  Scores 0.25/1.25 + 1/1.5 - 0.25/1.75.
    Weights -0.5/1.25 and 1/1.5.  The cut at 3 has 0/1.5 + 0.25/1.25 less the same: the first wins.
    """
    rows = spark.createDataFrame([(0, [1.0], 0.0, 1.0, 0), (1, [2.0], 1.0, 1.0, 0), (2, [3.0], 1.0, 1.0, 1)], ROWS)
    settings = [
        Setting(n_estimators=1, max_depth=1, learning_rate=1.0, min_child_weight=0.0),
        Setting(n_estimators=1, max_depth=1, learning_rate=0.1, min_child_weight=0.0, reg_alpha=0.25),
        Setting(n_estimators=1, max_depth=1, min_child_weight=0.0, gamma=0.8),
        Setting(n_estimators=1, max_depth=1, min_child_weight=0.3),
        Setting(n_estimators=1, max_depth=1, min_child_weight=0.6),
        Setting(n_estimators=1, max_depth=1, learning_rate=1.0, min_child_weight=0.0, fold=1),
    ]
    plain, alpha, gamma, heavy, heavier, folded = boosting.fit(rows, settings, ["id"], cuts=[[2.0, 3.0]])
    tree = plain.trees[0]
    assert (tree.input[0], tree.cut[0]) == (0, 1)
    assert tree.gain[0] == pytest.approx(0.25 / 1.25 + 1 / 1.5 - 0.25 / 1.75)
    assert tree.leaf[1:3] == pytest.approx([-0.4, 1 / 1.5])
    # T(0.5) = 0.25, T(-1) = -0.75
    assert alpha.trees[0].leaf[1:3] == pytest.approx([-0.1 * 0.25 / 1.25, 0.1 * 0.75 / 1.5])
    assert not gamma.trees  # the gain is 0.72
    assert not heavy.trees and not heavier.trees  # one side always has 1/4
    assert folded.trees[0].leaf[1:3] == pytest.approx([-0.4, 0.4])  # without the third row
    assert plain.importance() == [1.0] and gamma.importance() == [0.0]


def _plain_fit(rows, cuts, setting):
    """One row after another, as the definition has it; returns margins."""
    bins = [[sum(x >= c for c in own) for x, own in zip(r[1], cuts)] for r in rows]
    margins = [0.0] * len(rows)
    for _ in range(setting.n_estimators):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [r[3] * (q - r[2]) for r, q in zip(rows, p)]
        h = [r[3] * q * (1 - q) for r, q in zip(rows, p)]

        def shrunk(x):
            return math.copysign(max(abs(x) - setting.reg_alpha, 0), x)

        def score(some):
            return shrunk(sum(g[k] for k in some)) ** 2 / (sum(h[k] for k in some) + setting.reg_lambda)

        def grow(some, depth):
            best = None
            for i in range(len(cuts) if depth else 0):
                for c in range(1, len(cuts[i]) + 1):
                    left, right = [k for k in some if bins[k][i] < c], [k for k in some if bins[k][i] >= c]
                    if not left or not right or min(sum(h[k] for k in x) for x in (left, right)) < setting.min_child_weight:
                        continue
                    gain = score(left) + score(right) - score(some)
                    if gain > 0 and gain >= setting.gamma and (best is None or gain > best[0] + 1e-12):
                        best = (gain, left, right)
            if best is None:
                if len(some) < len(rows):
                    for k in some:
                        margins[k] -= setting.learning_rate * shrunk(sum(g[j] for j in some)) / (sum(h[j] for j in some) + setting.reg_lambda)
                return
            grow(best[1], depth - 1)
            grow(best[2], depth - 1)

        grow(range(len(rows)), setting.max_depth)
    return margins


@pytest.fixture(scope="module")
def noisy(spark):
    import random

    pick = random.Random(3)
    rows = []
    for k in range(300):
        x = [float(pick.randrange(12)), pick.random(), float(pick.randrange(2))]
        rows.append((k, x, float((x[0] > 5) ^ (x[2] > 0) ^ (pick.random() < 0.1)), 1.0 + (k % 3), k % 2))
    return rows, spark.createDataFrame(rows, ROWS)


@pytest.mark.parametrize("most_cells", [boosting.MOST_CELLS, 0])
def test_against_the_definition(spark, noisy, monkeypatch, most_cells):
    """With the splits found by the driver, and by the executors."""
    monkeypatch.setattr(boosting, "MOST_CELLS", most_cells)
    rows, frame = noisy
    settings = [
        Setting(n_estimators=9, max_depth=3, reg_alpha=0.5, gamma=0.1, min_child_weight=2.0),
        Setting(n_estimators=3, max_depth=2, learning_rate=0.1, reg_lambda=0.0),
    ]
    cuts = boosting.cut_points(frame, bins=8)
    assert cuts[2] == [1.0] and len(cuts[1]) == 7
    models = boosting.fit(frame, settings, ["id"], cuts=cuts)
    for model, setting in zip(models, settings):
        expected = [1 / (1 + math.exp(-m)) for m in _plain_fit(rows, cuts, setting)]
        scored = SQLTransformer(statement=model.statement()).transform(frame)
        found = {r.id: r.p for r in scored.select("id", F.col("probability")[1].alias("p")).collect()}
        assert [found[r[0]] for r in rows] == pytest.approx(expected, abs=1e-9)


def test_one_pass_is_many_fits(noisy):
    """Models that grow side by side are those that grow alone, samples of rows and inputs included."""
    _, frame = noisy
    settings = [Setting(n_estimators=n, max_depth=2, subsample=0.7, colsample=0.6, seed=9, fold=f) for n, f in ((9, 0), (4, 1), (2, None))]
    cuts = boosting.cut_points(frame)
    together = boosting.fit(frame, settings, ["id"], cuts=cuts)
    for model, setting in zip(together, settings):
        alone = boosting.fit(frame, [setting], ["id"], cuts=cuts)[0]
        assert [t.input for t in model.trees] == [t.input for t in alone.trees]
        assert [x for t in model.trees for x in t.leaf] == pytest.approx([x for t in alone.trees for x in t.leaf])
    counts = {r.model: r for r in boosting.decisions(frame, together).groupBy("model").agg(F.count("*").alias("n"), F.avg(F.expr("cast(hit = (label = 1) as int)")).alias("right")).collect()}
    assert sorted(counts) == [0, 1] and counts[0].n == counts[1].n == 150 and counts[0].right > 0.55


def test_odd_inputs(spark):
    empty = spark.createDataFrame([], ROWS)
    assert boosting.fit(empty, [Setting()], ["id"])[0].trees == []
    flat = spark.createDataFrame([(k, [1.0, float("nan")], float(k % 2), 1.0, 0) for k in range(20)], ROWS)
    assert boosting.fit(flat, [Setting(n_estimators=2)], ["id"])[0].trees == []
    with pytest.raises(TypeError):
        Setting.of({"maxDepth": 3})


def test_search_space_has_the_penalties():
    for space in (training.BOOSTED_SPACE, training.MONTHLY_SPACE):
        assert {"reg_alpha", "reg_lambda", "min_child_weight", "gamma"} <= set(space)
        for setting in training.draw(space, 5, 1):
            Setting.of(setting)


INPUTS = training.Inputs(["x"], ["job"])


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(0, 400, 1, 2).select(
        "id", (F.col("id") % 10).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "it's").otherwise("b").alias("job"),
        F.when(F.col("id") % 4 == 0, "oot").otherwise("train").alias("split"),
    )
    return df.withColumn("label", ((F.col("x") >= 5) & (F.col("job") == "b")).cast("int"))


def test_recipe_learns_saves_and_refuses(spark, data, tmp_path):
    recipe = training.Recipe("boosted", INPUTS, "positive_weight", training.BOOSTED_SPACE, second_order=True)
    trained = training.train(data, recipe, ["id"], {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5})
    assert {r.split: r.roc_auc for r in trained.metrics.collect()} == {"train": 1.0, "oot": 1.0}
    assert {n for n, _ in trained.importance} == {"x", "job_it's"}
    path = str(tmp_path / "model")
    trained.model.write().save(path)
    loaded = type(trained.model).load(path)
    same = training.score(loaded, data).join(training.score(trained.model, data).withColumnRenamed(training.SCORE, "other"), "id")
    assert same.filter(F.col(training.SCORE) == F.col("other")).count() == 400
    with pytest.raises(Exception):
        training.score(trained.model, data.withColumn("job", F.lit("new"))).collect()


@pytest.mark.parametrize("second_order", [True, False])
def test_search_goes_on_where_it_was_cut_off(spark, data, tmp_path, monkeypatch, second_order):
    if second_order:
        recipe = training.Recipe("boosted", INPUTS, "unweighted", {"max_depth": [1, 2], "gamma": [0.0, 0.1]}, second_order=True)
        params = {"n_estimators": 2}
    else:
        recipe, params = training.Recipe("gbt", INPUTS, "unweighted", {"maxDepth": [1, 2], "stepSize": [0.1, 0.2]}), {"maxIter": 1}
    search = training.Search(n_iter=3, folds=2, metric="balanced_accuracy", parallelism=1, at_once=2)
    work, tried = str(tmp_path / "work"), []
    real = Trials.commit

    def lossy(self, scores):
        if len(tried) >= 3:
            raise RuntimeError("driver lost")
        real(self, scores)
        tried.extend(scores)

    monkeypatch.setattr(Trials, "commit", lossy)
    with pytest.raises(RuntimeError):
        training.train(data, recipe, ["id"], params, search, work)
    before = list(tried)
    assert 3 <= len(before) < 6

    def noted(self, scores):
        tried.extend(scores)
        real(self, scores)

    monkeypatch.setattr(Trials, "commit", noted)
    trained = training.train(data, recipe, ["id"], params, search, work)
    assert sorted(tried) == [(d, f) for d in range(3) for f in range(2)]  # each fitted once
    monkeypatch.setattr(Trials, "commit", lambda self, scores: pytest.fail("fitted again"))
    again = training.train(data, recipe, ["id"], params, search, work)
    assert again.params == trained.params and again.cv_score == trained.cv_score
    monkeypatch.setattr(Trials, "commit", real)
    fresh = training.train(data, recipe, ["id"], params, search)
    assert fresh.params == trained.params and fresh.cv_score == pytest.approx(trained.cv_score)


def test_other_rows_are_another_search(spark, data, tmp_path):
    frame = data.select("id", "label", F.lit(0).alias("fold"))
    one, two = Trials(spark, str(tmp_path), "a"), Trials(spark, str(tmp_path), "a")
    one.rows(frame)
    one.commit({(0, 0): 0.5})
    one.commit({(0, 0): 0.5, (1, 0): 0.25})  # a trial that ran twice is there once
    two.rows(frame.filter("id > 0"))
    assert one.done() == {(0, 0): 0.5, (1, 0): 0.25} and two.done() == {}
    assert json.dumps(sorted(x.name for x in tmp_path.iterdir())).count("search=") == 2


def test_scoring_makes_the_inputs_once(spark):
    """Inputs that are expressions are bound before the trees are walked, not made anew at each node."""
    rows = spark.createDataFrame([(k, [float(k), 1.0], float(k > 5), 1.0, 0) for k in range(10)], ROWS)
    model = boosting.fit(rows, [Setting(n_estimators=2, max_depth=2)], ["id"])[0]
    made = rows.select("id", F.array(F.sqrt(F.col("id") * F.col("id")), F.lit(1.0)).alias("inputs"))
    scored = SQLTransformer(statement=model.statement()).transform(made).select("id", F.col("probability")[1].alias("p"))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in plan and "SQRT" not in plan[plan.index("aggregate(") :].split("\n")[0]
    got = {r.id: r.p for r in scored.collect()}
    assert got[9] > 0.5 > got[0]


def test_tasks_add_up_before_the_shuffle(spark, monkeypatch):
    """The sums that tasks take by numpy give the trees of the sums over exploded rows, also with folds that are null."""
    rows = spark.createDataFrame(
        [(k, [float(k * 7 % 11), float(k * 5 % 13), 3.0], float(k * 7 % 11 > 4), 1.0 + k % 3, None if k % 10 == 9 else k % 2) for k in range(200)], ROWS
    ).repartition(5)
    settings = [Setting(n_estimators=10, max_depth=2, colsample=0.7, subsample=0.8, seed=3), Setting(n_estimators=3, max_depth=3, fold=1)]
    cuts = boosting.cut_points(rows, bins=8)
    sums, seen = boosting._level_sums, []
    monkeypatch.setattr(boosting, "_level_sums", lambda *a: seen.append(sums(*a)) or seen[-1])
    quick = boosting.fit(rows, settings, ["id"], cuts=cuts)
    assert seen and all("Generate" not in s._jdf.queryExecution().optimizedPlan().toString() for s in seen)
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    for one, other in zip(quick, boosting.fit(rows, settings, ["id"], cuts=cuts)):
        assert [(t.input, t.cut) for t in one.trees] == [(t.input, t.cut) for t in other.trees]
        for a, b in zip(one.trees, other.trees):
            assert a.leaf == pytest.approx(b.leaf)
