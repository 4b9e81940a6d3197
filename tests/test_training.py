import pytest
from pyspark.sql import functions as F

from creditloom.plans import training

KEY = ["id"]


@pytest.fixture(scope="module")
def data(spark):
    """A planted rule: default follows x and the job, with some noise."""
    noise = F.rand(3)
    df = spark.range(0, 1200, 1, 4).select(
        "id",
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 7).alias("y"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("job"),
        F.lit("same").alias("flat"),
        F.when(F.col("id") % 4 == 0, "oot").otherwise("train").alias("split"),
    )
    rule = (F.coalesce("x", F.lit(0.0)) >= 5) | (F.col("job") == "c")
    return df.withColumn("label", F.when(noise < 0.05, ~rule).otherwise(rule).cast("int"))


INPUTS = training.Inputs(["x", "y"], ["job", "flat"])


@pytest.mark.parametrize("recipe,params", [
    (training.Recipe("random_forest", INPUTS, "balanced_weight", {}), {"numTrees": 10}),
    (training.Recipe("gbt", INPUTS, "positive_weight", {}), {"maxIter": 5}),
    (training.Recipe("logistic", training.Inputs(["x", "y"], ["job", "flat"], scaled=True), "balanced_weight", {}), {}),
])
def test_models_learn_the_rule(spark, data, recipe, params):
    trained = training.train(data, recipe, KEY, params)
    by_split = {r.split: r for r in trained.metrics.collect()}
    assert by_split["oot"].roc_auc > 0.8
    assert [n for n, _ in trained.importance][:2] == ["x", "y"]
    assert len(trained.importance) == 4
    assert training.top_features(spark, trained, 2).count() == 2


def test_search_finds_a_setting(data):
    recipe = training.Recipe("random_forest", INPUTS, "balanced_weight", {"numTrees": [3, 5], "maxDepth": [2, 4]})
    trained = training.train(data, recipe, KEY, search=training.Search(n_iter=3, folds=2, metric="balanced_accuracy"))
    assert trained.params["maxDepth"] in (2, 4) and 0.5 < trained.cv_score <= 1


def test_unknown_category_is_an_error(spark, data):
    trained = training.train(data, training.Recipe("gbt", INPUTS, "unweighted", {}), KEY, {"maxIter": 1})
    odd = data.withColumn("job", F.lit("new"))
    with pytest.raises(Exception):
        training.score(trained.model, odd).collect()


def test_draws():
    few = training.draw({"a": [1, 2], "b": [True, False]}, 10, 1)
    assert len(few) == 4 and len({tuple(s.values()) for s in few}) == 4
    many = training.draw(training.FOREST_SPACE, 20, 1)
    assert len(many) == 20 and all(50 <= s["numTrees"] < 300 for s in many)
    assert many == training.draw(training.FOREST_SPACE, 20, 1)


def test_hard_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert training.HardScore("recall").evaluate(df) == 0.5
    assert training.HardScore("balanced_accuracy").evaluate(df) == 0.75


def test_search_and_fit_are_one_estimator(spark, data, monkeypatch):
    """Fixed parameters hold while searching, and the model kept is the search's own."""
    recipe = training.Recipe("gbt", INPUTS, "positive_weight", {"maxDepth": [2, 3]})
    made, real = [], training.Recipe.estimator

    def seen(self, params=None):
        made.append(params)
        return real(self, params)

    monkeypatch.setattr(training.Recipe, "estimator", seen)
    trained = training.train(data, recipe, KEY, {"maxIter": 3}, training.Search(n_iter=2, folds=2))
    assert made == [{"maxIter": 3}]
    fitted = trained.model.stages[-1]
    assert fitted.getNumTrees == 3 and fitted.getMaxDepth() == trained.params["maxDepth"] and trained.params["maxIter"] == 3


def test_single_forests_lie_inside_the_search_space():
    from creditloom.catalog.queries import FOREST

    for name in ("numTrees", "maxDepth"):
        low, high = training.FOREST_SPACE[name]
        assert low <= FOREST[name] < high


def test_forest_inputs_are_one_projection_and_rows_are_not_written_twice(spark, monkeypatch):
    """The assembled inputs, by hand; no copy of rows that are stored; node ids kept between the passes of a forest."""
    rows = [(float(k), c, "one", k % 2, "train") for k, c in enumerate(["b", "it's", "B", "a.b", "B", "it's", "b", "a.b"])]
    df = spark.createDataFrame(rows, "x double, c string, d string, label int, split string").withColumn("id", F.col("x").cast("long"))
    inputs = training.Inputs(["x"], ["c", "d"])
    prepared = training.preprocessing(df, inputs)
    assert len(prepared.stages) == 2
    ready = prepared.transform(df)
    assert training.input_names(ready) == ["x", "c_it's", "c_b", "c_a.b"]
    assert {r.x: r.features.toArray().tolist() for r in ready.collect()} == {x: [x, float(c == "it's"), float(c == "b"), float(c == "a.b")] for x, c, *_ in rows}
    for unseen in ("z", None):
        with pytest.raises(Exception, match="unknown c"):
            prepared.transform(df.withColumn("c", F.lit(unseen).cast("string"))).select("features").collect()

    written, write = [], training.materialise
    monkeypatch.setattr(training, "materialise", lambda frame, purpose: written.append(purpose) or write(frame, purpose))
    recipe = training.Recipe("random_forest", inputs, "balanced_weight", {})
    assert recipe.estimator().getCacheNodeIds()
    trained = training.train(df, recipe, ["id"], {"numTrees": 2, "maxDepth": 2}, stored=True)
    assert "training-rows" not in written and [n for n, _ in trained.importance] == ["x", "c_it's", "c_b", "c_a.b"]
    training.train(df, recipe, ["id"], {"numTrees": 2, "maxDepth": 2})
    assert written.count("training-rows") == 1
