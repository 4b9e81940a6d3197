"""Training, tuning, evaluation and storage of the default models with MLlib.

Missing inputs are filled, and numbers scaled, inside the saved pipeline, so that training and
scoring see the same values.
"""

from __future__ import annotations

import json
import random
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Params
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from creditloom.operators import boosting, metrics, modelling, splits
from creditloom.plans.trials import Trials
from creditloom.sources.tables import materialise

SCORE = "model_predictions"

# Search ranges.  A tuple (low, high) of ints or floats is drawn evenly from
# low <= x < high, a list is drawn from.
FOREST_SPACE = {
    "numTrees": (50, 300),
    "maxDepth": (3, 20),
    "minInstancesPerNode": (1, 10),
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
    "bootstrap": [True, False],
}
BOOSTING_SPACE = {
    "maxDepth": (3, 10),
    "stepSize": (0.01, 0.31),
    "subsamplingRate": (0.6, 1.0),
    "featureSubsetStrategy": (0.6, 1.0),
    "minInstancesPerNode": (1, 10),
    "minInfoGain": (0.0, 0.5),
}
BOOSTED_SPACE = {
    "max_depth": (3, 10),
    "learning_rate": (0.01, 0.31),
    "subsample": (0.6, 1.0),
    "colsample": (0.6, 1.0),
    "min_child_weight": (1, 10),
    "gamma": (0.0, 0.5),
    "reg_alpha": (0.0, 1.0),
    "reg_lambda": (0.0, 1.0),
}
MONTHLY_SPACE = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample": [0.6, 0.8],
    "gamma": [0.0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0.0, 0.1, 1.0],
    "reg_lambda": [1.0, 1.5, 2.0],
}
FOREST_SEED, MONTHLY_SEED = 42, 88


# -- preprocessing ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Inputs:
    """The model inputs: numbers (scaled or as they are) and categories (one-hot)."""

    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    scaled: bool = False

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]


TREE_INPUTS = Inputs(modelling.TUNED_NUMERICS, modelling.TUNED_CATEGORIES)
LINEAR_INPUTS = Inputs(modelling.TUNED_NUMERICS, modelling.TUNED_CATEGORIES, scaled=True)


def quoted(text: str) -> str:
    """``text`` as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def category_entry(column: str, value: str, values: list[str]) -> str:
    """1 where the category is ``value``, 0 where it is another of ``values``; any other is an error."""
    known = ", ".join(map(quoted, values))
    unknown = f"raise_error(concat({quoted(f'unknown {column}: ')}, coalesce(cast(`{column}` as string), 'NULL')))"
    return f"CASE WHEN cast(`{column}` as string) IN ({known}) THEN cast(cast(`{column}` as string) = {quoted(value)} as double) ELSE {unknown} END"


def preprocessing(train: DataFrame, inputs: Inputs) -> PipelineModel:
    """Fill, scale, one-hot encode and assemble; fitted on the training rows.

    One-hot drops the first category in text order; a category not seen in training is an error.
    """
    numbers = modelling.scale_parameters(train, inputs.numeric) if inputs.scaled else {}

    def number(c: str) -> str:
        mean, spread = numbers.get(c, (0.0, 1.0))
        filled = f"coalesce(nanvl(cast(`{c}` as double), 0D), 0D)"
        return f"({filled} - {mean!r}D) / {spread!r}D AS `num {c}`"

    entries, columns = list(map(number, inputs.numeric)), [f"num {c}" for c in inputs.numeric]
    labels: list[list[str]] = []
    if inputs.categorical:  # from the distinct rows, which combine before the shuffle
        seen = train.select(*[modelling.named(c) for c in inputs.categorical]).distinct()
        indexer = StringIndexer(
            inputCols=inputs.categorical,
            outputCols=[f"index {c}" for c in inputs.categorical],
            stringOrderType="alphabetDesc",
            handleInvalid="error",
        )
        labels = [list(found) for found in indexer.fit(seen).labelsArray]
    # a category with a single value gives no column once its first value is dropped
    for c, values in zip(inputs.categorical, labels):
        for v in values[:-1]:
            # names of columns are told apart without case and split at dots; values are not
            name = f"hot_{c.encode().hex()}_{v.encode().hex()}"
            entries.append(f"{category_entry(c, v, values)} AS `{name}`")
            columns.append(name)
    fill = SQLTransformer(statement=f"SELECT *, {', '.join(entries)} FROM __THIS__")
    return PipelineModel(stages=[fill, VectorAssembler(inputCols=columns, outputCol="features")])


MODEL_INPUTS = "model inputs"


def tree_preprocessing(train: DataFrame, inputs: Inputs) -> tuple[PipelineModel, list[str]]:
    """Fill, scale and one-hot encode into one array of doubles, and the names of its entries.

    One-hot drops the first category in text order; a category not seen in training is an error.
    """
    numbers = modelling.scale_parameters(train, inputs.numeric) if inputs.scaled else {}
    entries, names = [], []
    for c in inputs.numeric:
        mean, spread = numbers.get(c, (0.0, 1.0))
        entries.append(f"(coalesce(nanvl(cast(`{c}` as double), 0D), 0D) - {mean!r}D) / {spread!r}D")
        names.append(c)
    for c in inputs.categorical:
        values = modelling.categories(train, c)
        for v in values[1:]:
            entries.append(category_entry(c, v, values))
            names.append(f"{c}_{v}")
    fill = SQLTransformer(statement=f"SELECT *, array({', '.join(entries)}) AS `{MODEL_INPUTS}` FROM __THIS__")
    return PipelineModel(stages=[fill]), names


def input_names(df: DataFrame) -> list[str]:
    """Names of the assembled inputs, in vector order, from the column's own metadata."""
    groups = df.schema["features"].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)

    def readable(name: str) -> str:
        if name.startswith("hot_"):
            return "_".join(bytes.fromhex(part).decode() for part in name.split("_")[1:])
        return name.removeprefix("num ")

    return [readable(name) for _, name in named]


# -- estimators -------------------------------------------------------------------------------


def weighted(df: DataFrame, weights: DataFrame, kind: str, label: str = "label") -> DataFrame:
    """Add the weight of each row's class (one number per class reaches the driver)."""
    table = {row["label"]: row[kind] for row in weights.collect()}
    weight = F.lit(1.0)
    for value, w in table.items():
        weight = F.when(F.col(label) == value, F.lit(float(w))).otherwise(weight)
    return df.withColumn("weight", weight)


@dataclass(frozen=True)
class Recipe:
    """A kind of model: inputs, estimator, class weights and search space."""

    name: str
    inputs: Inputs | None
    weight: str
    space: dict
    seed: int = FOREST_SEED
    second_order: bool = False

    def estimator(self, params: dict | None = None):
        common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
        params = {k: str(v) if k == "featureSubsetStrategy" else v for k, v in (params or {}).items()}
        if self.name.startswith("random_forest"):
            return RandomForestClassifier(**common, seed=self.seed, cacheNodeIds=True, **params)
        if self.name == "logistic":
            return LogisticRegression(**common, **params)
        return GBTClassifier(**common, seed=self.seed, **params)


RANDOM_FOREST = Recipe("random_forest", TREE_INPUTS, "balanced_weight", FOREST_SPACE)
RANDOM_FOREST_SCALED = Recipe("random_forest_scaled", LINEAR_INPUTS, "balanced_weight", FOREST_SPACE)
GRADIENT_BOOSTING = Recipe("gbt", TREE_INPUTS, "positive_weight", BOOSTING_SPACE)
LOGISTIC = Recipe("logistic", LINEAR_INPUTS, "balanced_weight", {"regParam": (0.0, 0.1), "elasticNetParam": (0.0, 1.0)})
BOOSTED = Recipe("boosted", TREE_INPUTS, "positive_weight", BOOSTED_SPACE, second_order=True)
MONTHLY = Recipe("monthly_gbt", None, "unweighted", MONTHLY_SPACE, MONTHLY_SEED, second_order=True)


# -- random search ----------------------------------------------------------------------------


def draw(space: dict, n: int, seed: int) -> list[dict]:
    """``n`` settings from a space; without repeats when the space is finite."""
    chance = random.Random(seed)

    def one(choice):
        if isinstance(choice, list):
            return chance.choice(choice)
        low, high = choice
        return chance.randrange(low, high) if isinstance(low, int) else chance.uniform(low, high)

    finite = all(isinstance(choice, list) for choice in space.values())
    settings: list[dict] = []
    size = 1
    for choice in space.values():
        size *= len(choice) if isinstance(choice, list) else n + 1
    while len(settings) < (min(n, size) if finite else n):
        setting = {name: one(choice) for name, choice in space.items()}
        if not (finite and setting in settings):
            settings.append(setting)
    return settings


def hard_score(counts, metric: str) -> float:
    """Recall, or balanced accuracy (the ROC-AUC of hard decisions), from tp, p, tn and n."""
    recall = counts["tp"] / counts["p"] if counts["p"] else 0.0
    if metric == "recall":
        return recall
    return (recall + (counts["tn"] / counts["n"] if counts["n"] else 0.0)) / 2


def decision_counts(hit: Column, truth: Column) -> list[Column]:
    return [
        F.count_if(hit & truth).alias("tp"), F.count_if(truth).alias("p"),
        F.count_if(~hit & ~truth).alias("tn"), F.count_if(~truth).alias("n"),
    ]


class HardScore(Evaluator):
    """``hard_score`` of a scored frame, from one aggregate."""

    def __init__(self, metric: str = "recall"):
        super().__init__()
        self.metric = metric

    def _evaluate(self, dataset: DataFrame) -> float:
        counts = dataset.agg(*decision_counts(F.col("prediction") == 1, F.col("label") == 1)).first()
        return hard_score(counts, self.metric)


@dataclass(frozen=True)
class Search:
    n_iter: int = 10
    folds: int = 5
    metric: str = "recall"
    seed: int = 42
    parallelism: int = 2
    #: Models of second-order boosting that grow in one pass.
    at_once: int = 16


def param_map(estimator: Params, setting: dict) -> dict:
    return {
        estimator.getParam(k): (str(v) if k == "featureSubsetStrategy" else v) for k, v in setting.items()
    }


def random_search(recipe: Recipe, matrix: DataFrame, search: Search, params: dict | None = None, trials: Trials | None = None):
    """Best setting, its cross-validated score, the score of every setting, and the model fitted
    with the best on all rows (of second-order boosting an ``Ensemble``).

    ``params`` are fixed parameters that every setting is tried with.  ``matrix`` holds the inputs,
    label, weight and fold, and is read anew by every trial.  What ``trials`` already has a score
    for is not fitted again.
    """
    settings = draw(recipe.space, search.n_iter, search.seed)
    trials = trials or Trials(matrix.sparkSession, None)
    wanted = [(d, f) for d in range(len(settings)) for f in range(search.folds)]
    if recipe.second_order:
        cuts = boosting.cut_points(matrix, MODEL_INPUTS)

        def grow(some: list[boosting.Setting]) -> list[boosting.Ensemble]:
            return boosting.fit(matrix, some, ["row"], MODEL_INPUTS, cuts)

        def try_out(part: list[tuple[int, int]]) -> list[float]:
            models = grow([boosting.Setting.of({**(params or {}), **settings[d]}, seed=recipe.seed, fold=f) for d, f in part])
            judged = boosting.decisions(matrix, models, MODEL_INPUTS)
            found = judged.groupBy("model").agg(*decision_counts(F.col("hit"), F.col("label") == 1)).collect()
            counts = {row["model"]: row for row in found}
            nothing = {"tp": 0, "p": 0, "tn": 0, "n": 0}
            return [hard_score(counts.get(k, nothing), search.metric) for k in range(len(part))]

        scores = trials.run(wanted, try_out, search.at_once, 1)
    else:
        estimator, evaluator = recipe.estimator(params), HardScore(search.metric)

        def try_out(part: list[tuple[int, int]]) -> list[float]:
            (d, f), = part
            fitted = estimator.fit(matrix.filter(F.col("fold") != f), param_map(estimator, settings[d]))
            return [evaluator.evaluate(fitted.transform(matrix.filter(F.col("fold") == f)))]

        scores = trials.run(wanted, try_out, 1, search.parallelism)
    means = [sum(scores[d, f] for f in range(search.folds)) / search.folds for d in range(len(settings))]
    best = max(range(len(settings)), key=lambda i: means[i])
    if recipe.second_order:
        model = grow([boosting.Setting.of({**(params or {}), **settings[best]}, seed=recipe.seed)])[0]
    else:
        model = estimator.fit(matrix, param_map(estimator, settings[best]))
    return settings[best], means[best], means, model


# -- training ---------------------------------------------------------------------------------


@dataclass
class Trained:
    """A fitted pipeline with what is known about it."""

    recipe: str
    model: PipelineModel
    inputs: Inputs
    params: dict
    cv_score: float | None
    metrics: DataFrame
    stats: DataFrame
    importance: list[tuple[str, float]]


def probability(scored: DataFrame, column: str = "probability") -> Column:
    """The probability of default; second-order boosting gives an array, MLlib a vector."""
    found = F.col(column)
    return (found if isinstance(scored.schema[column].dataType, ArrayType) else vector_to_array(found))[1]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the probability of default; all other columns of ``df`` stay."""
    scored = model.transform(df)
    scored = scored.withColumn(SCORE, probability(scored))
    return scored.select(*[modelling.named(c) for c in df.columns], SCORE)


def train(
    data: DataFrame,
    recipe: Recipe,
    key: list[str],
    params: dict | None = None,
    search: Search | None = None,
    work: str | None = None,
    stored: bool = False,
) -> Trained:
    """Fit on the ``train`` split of ``data``, optionally after a random search, and evaluate on
    every split.

    ``data`` holds key, ``split``, ``label`` and the inputs.  ``work`` is a folder for the search:
    a search that was cut off goes on there with the rows and folds that it had.  ``stored`` tells that
    ``data`` is read from storage as it is, and need not be written once more.
    """
    inputs = recipe.inputs or Inputs(modelling.monthly_features(data), scaled=True)
    columns = [*key, "split", "label", *inputs.names]
    rows = data.select(*[modelling.named(c) for c in columns])
    if not stored:
        rows = materialise(rows, "training-rows")
    train_rows = rows.where(F.col("split") == "train")
    if recipe.second_order:
        prepared, names = tree_preprocessing(train_rows, inputs)
    else:
        prepared = preprocessing(train_rows, inputs)

    if recipe.weight == "unweighted":
        train_rows = train_rows.withColumn("weight", F.lit(1.0))
    else:
        train_rows = weighted(train_rows, modelling.class_weights(train_rows), recipe.weight)
    if search:
        train_rows = splits.stratified_folds(train_rows, key, folds=search.folds, seed=search.seed)
    extra = ["fold"] if search else []
    transformed = prepared.transform(train_rows)
    label = F.col("label").cast("double").alias("label")
    if recipe.second_order:
        inputs_only = transformed.select(F.xxhash64(*key).alias("row"), MODEL_INPUTS, label, "weight", *extra)
    else:
        names = input_names(transformed)
        inputs_only = transformed.select("features", label, "weight", *extra)

    setting, cv_score = dict(params or {}), None
    if search:
        what = json.dumps([recipe.name, recipe.space, setting, search.n_iter, search.folds, search.metric, search.seed])
        trials = Trials(data.sparkSession, work, what)
        matrix = trials.rows(inputs_only)
        found, cv_score, _, fitted = random_search(recipe, matrix, search, setting, trials)
        setting = {**setting, **found}
    else:
        matrix = materialise(inputs_only, "training-matrix")
        if recipe.second_order:
            fitted = boosting.fit(matrix, [boosting.Setting.of(setting, seed=recipe.seed)], ["row"], MODEL_INPUTS)[0]
        else:
            fitted = recipe.estimator(setting).fit(matrix)
    ensemble = fitted if recipe.second_order else None
    if ensemble:
        fitted = SQLTransformer(statement=ensemble.statement(f"`{MODEL_INPUTS}`"))
    model = PipelineModel(stages=[*prepared.stages, fitted])

    scored = materialise(score(model, rows).select("split", "label", SCORE), "training-scores")
    importance = []
    if ensemble:
        importance = list(zip(names, ensemble.importance()))
    elif hasattr(fitted, "featureImportances"):
        importance = list(zip(names, map(float, fitted.featureImportances.toArray())))
    elif hasattr(fitted, "coefficients"):
        importance = [(n, abs(float(c))) for n, c in zip(names, fitted.coefficients.toArray())]
    quality = metrics.classification_metrics(scored, SCORE, "label", by=("split",))
    quality = quality.withColumn("gini", F.round(2 * F.col("roc_auc") - 1, 3))
    quality = materialise(quality, "training-metrics")
    return Trained(recipe.name, model, inputs, setting, cv_score, quality, splits.split_stats(rows), importance)


def top_features(spark: SparkSession, trained: Trained, k: int = 10) -> DataFrame:
    """The most important inputs by name (the list is as long as the model has inputs)."""
    ranked = spark.createDataFrame(trained.importance, "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature").limit(k)


# -- storage ----------------------------------------------------------------------------------


def model_version(train_date: str) -> str:
    return "credit_model_" + train_date.replace("-", "_")


def save(trained: Trained, path: str, train_date: str, windows, spark: SparkSession) -> None:
    """The fitted pipeline and one row of facts: version, inputs, dates, row counts, results,
    parameters."""
    trained.model.write().overwrite().save(f"{path}/model")
    dates = {w.name: f"{w.start.isoformat()}..{w.end.isoformat()}" for w in windows}
    facts = spark.createDataFrame(
        [(model_version(train_date), trained.recipe, trained.inputs.names, dates, json.dumps(trained.params), trained.cv_score)],
        "model_version string, recipe string, feature_names array<string>, data_dates map<string,string>, "
        "hp_params string, cv_score double",
    )
    # one row per split
    sizes = trained.stats.agg(F.collect_list(F.struct("split", "n_rows", "label_mean")).alias("data_stats"))
    results = trained.metrics.agg(F.collect_list(F.struct("split", "roc_auc", "gini")).alias("results"))
    row = facts.withColumns(
        {"data_stats": sizes.scalar(), "results": results.scalar()}
    )
    row.write.mode("overwrite").parquet(f"{path}/facts")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/facts")


# The metrics of a run record.
RUN_METRICS = [
    "accuracy", "recall", "precision", "f1", "roc_auc",
    "true_negatives", "false_positives", "false_negatives", "true_positives",
]


def run_log(trained: Trained, train_date: str, started: datetime | None = None) -> DataFrame:
    """One row per split and metric of a run, ready to append to the run table."""
    started = started or datetime.now(timezone.utc)
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in RUN_METRICS]
    )
    return trained.metrics.select("split", F.explode(pairs).alias("p")).select(
        F.lit(f"{trained.recipe}_{train_date}_{started:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}").alias("run_id"),
        F.lit(trained.recipe).alias("model_type"),
        F.lit(train_date).cast("date").alias("train_date"),
        F.lit(started).alias("start_time"),
        F.lit(json.dumps(trained.params)).alias("params"),
        F.lit(trained.cv_score).cast("double").alias("cv_score"),
        "split", "p.metric", "p.value",
    )


def append_runs(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)
