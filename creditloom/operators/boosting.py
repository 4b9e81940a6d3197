"""Second-order gradient boosting for two classes, on DataFrames.

Inputs are cut into bins at quantiles of a mergeable sketch.  A level of a tree is one aggregate: the
sums of gradients and hessians per (model, node, input, bin), which each task takes over its rows by
numpy before the shuffle, and from their running sums along the bins the best split of each node.  Where a level has up to MOST_CELLS
sums, whatever the number of rows, the driver takes them and finds the splits; beyond that they are
found on the executors, and one row per node reaches the driver.  Several models (settings, or folds of one setting) grow side by side in the same pass
over the rows, so a search costs as many jobs as its longest model, not their sum.

With G and H the sums of a node, T(G) = sign(G) max(|G| - reg_alpha, 0):
score T(G)**2 / (H + reg_lambda), gain of a split score(left) + score(right) - score(node), made if
both sides have H of ``min_child_weight`` and the gain exceeds 0 and is ``gamma`` at least; a leaf
adds -learning_rate T(G) / (H + reg_lambda) to the margin, whose logistic is the probability.

Rows carry their margins; every ``STORE_EVERY`` trees they are written down and the copy before is
dropped, so neither the plan nor the storage grows with the number of trees.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.sources.session import importable
from creditloom.sources.tables import Kept

BINS = 32
ACCURACY = 10_000  # of the quantile sketch: a rank is off by one in so many at most
STORE_EVERY = 8
MOST_CELLS = 200_000
TASK_CELLS = 2_000_000  # sums that a task holds at most, 24 bytes each; levels with more go through ``histograms``
TREE = "struct<input:array<int>,cut:array<int>,leaf:array<double>>"
SCORING_TREES = "array<struct<input:array<int>,cut:array<double>,next:array<int>,leaf:array<double>>>"


@dataclass(frozen=True)
class Setting:
    """Parameters of one model; ``fold`` names the rows that it does not learn from."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    seed: int = 0
    fold: int | None = None

    @classmethod
    def of(cls, params: dict, **more) -> Setting:
        known = {f.name for f in fields(cls)}
        if unknown := set(params) - known:
            raise TypeError(f"no parameters of boosting: {sorted(unknown)}")
        return cls(**{**params, **more})


@dataclass
class Tree:
    """A tree in heap order: node i has the children 2i + 1 and 2i + 2, input -1 is a leaf."""

    depth: int
    input: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    leaf: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.input, self.cut = [-1] * size, [0] * size
        self.leaf, self.gain = [0.0] * size, [0.0] * size

    def plain(self) -> dict:
        return {"input": self.input, "cut": self.cut, "leaf": self.leaf}

    def compact(self, cuts: list[list[float]]) -> dict:
        """The nodes in use, with cuts as values of their inputs; of a split node, ``next`` is the left child, the right one follows."""
        nodes, at = [0], 0
        out: dict[str, list] = {"input": [], "cut": [], "next": [], "leaf": []}
        while at < len(nodes):
            n = nodes[at]
            split = self.input[n] >= 0
            out["input"].append(self.input[n])
            out["cut"].append(cuts[self.input[n]][self.cut[n] - 1] if split else 0.0)
            out["next"].append(len(nodes) if split else 0)
            out["leaf"].append(self.leaf[n])
            nodes += [2 * n + 1, 2 * n + 2] if split else []
            at += 1
        return out


@dataclass
class Ensemble:
    """The trees of one model over inputs with their cut points."""

    setting: Setting
    cuts: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def importance(self) -> list[float]:
        """Each input's share of all gains."""
        total = [0.0] * len(self.cuts)
        for tree in self.trees:
            for i, gain in zip(tree.input, tree.gain):
                if i >= 0:
                    total[i] += gain
        whole = sum(total) or 1.0
        return [x / whole for x in total]

    def statement(self, inputs: str = "inputs") -> str:
        """A SQL statement over __THIS__ that adds the columns probability (of 0 and of 1) and prediction.

        The inputs are bound as the variable x: were they named in the walk itself, Spark would put the
        expressions they are made of there, and make all of them anew at each node.
        """
        plain = [t.compact(self.cuts) for t in self.trees]
        depth = max([t.depth for t in self.trees], default=0)
        walk = (
            f"aggregate(array_repeat(0, {depth}), 0, (n, s) -> CASE WHEN t.input[n] < 0 THEN n "
            "WHEN x[t.input[n]] >= t.cut[n] THEN t.next[n] + 1 ELSE t.next[n] END)"
        )
        trees = f"from_json('{json.dumps(plain)}', '{SCORING_TREES}')"
        margin = f"transform(array({inputs}), x -> aggregate({trees}, 0D, (m, t) -> m + t.leaf[{walk}]))[0]"
        return (
            "SELECT *, array(1D - _p, _p) AS probability, CASE WHEN _p >= 0.5D THEN 1D ELSE 0D END AS prediction "
            f"FROM (SELECT *, 1D / (1D + exp(-({margin}))) AS _p FROM __THIS__)"
        )


def cut_points(rows: DataFrame, inputs: str = "inputs", width: int | None = None, bins: int = BINS) -> list[list[float]]:
    """Of each input, up to ``bins`` - 1 quantiles above its least value; one aggregate for all of them."""
    width = rows.select(F.size(inputs)).first()[0] if width is None else width
    probs = [k / bins for k in range(1, bins)]
    sketches = [F.percentile_approx(F.col(inputs)[i], probs, ACCURACY).alias(f"q{i}") for i in range(width)]
    least = [F.min(F.col(inputs)[i]).alias(f"m{i}") for i in range(width)]
    found = rows.agg(*sketches, *least).first()
    return [sorted({float(x) for x in found[f"q{i}"] or [] if x > found[f"m{i}"]}) for i in range(width)]


def binned(cuts: list[list[float]], inputs: str = "inputs") -> Column:
    """The bin of each input: how many of its cut points it reaches."""

    def reached(value: Column, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, own)), lambda c: value >= c)) if own else F.lit(0)

    return F.array(*[reached(F.col(inputs)[i], own) for i, own in enumerate(cuts)])


def _constant(value, kind: str) -> Column:
    """A nested constant."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _leaf(tree: Column, depth: int) -> Column:
    """The node of ``tree`` that a row's bins lead to."""
    return F.aggregate(
        F.array_repeat(F.lit(0), depth), F.lit(0),
        lambda n, _: F.when(tree["input"][n] < 0, n).when(F.col("bins")[tree["input"][n]] >= tree["cut"][n], 2 * n + 2).otherwise(2 * n + 1),
    )


def histograms(rows: DataFrame, nodes: Column) -> DataFrame:
    """(model, node, input, bin) with the sums g and h and the count n.

    ``nodes`` is an array with a struct (model, node, g, h) for every model that learns from the row.
    """
    learned = rows.select("bins", F.explode(nodes).alias("m"))
    cells = learned.select("m.*", F.posexplode("bins").alias("input", "bin"))
    return cells.groupBy("model", "node", "input", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n"))


def _score(g: Column, h: Column, alpha: Column, ridge: Column) -> Column:
    shrunk = F.greatest(F.abs(g) - alpha, F.lit(0.0))
    return F.coalesce(F.try_divide(shrunk * shrunk, h + ridge), F.lit(0.0))


def best_splits(sums: DataFrame, settings: list[Setting], chosen: list[list[int]] | None = None) -> DataFrame:
    """(model, node, input, cut, gain, and g and h of both sides) of each node that is worth a split.

    Of gains equal to six digits the first input and the lowest cut win, as sums differ in their last
    bits with the order of rows.  ``chosen``: the inputs each model may use.
    """
    of = lambda name: _constant([getattr(s, name) for s in settings], "array<double>")[F.col("model")]
    alpha, ridge, least = of("reg_alpha"), of("reg_lambda"), of("min_child_weight")
    along = Window.partitionBy("model", "node", "input")
    before = along.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    if chosen is not None:
        sums = sums.filter(F.array_contains(_constant(chosen, "array<array<int>>")[F.col("model")], F.col("input")))
    cut = sums.select(
        "model", "node", "input", F.col("bin").alias("cut"),
        F.sum("g").over(before).alias("g_left"), F.sum("h").over(before).alias("h_left"),
        F.sum("g").over(along).alias("g_all"), F.sum("h").over(along).alias("h_all"),
    ).filter("g_left is not null")
    cut = cut.withColumns({"g_right": F.col("g_all") - F.col("g_left"), "h_right": F.col("h_all") - F.col("h_left")})
    gain = sum((_score(F.col(f"g_{s}"), F.col(f"h_{s}"), alpha, ridge) for s in ("left", "right")), F.lit(0.0))
    gain = gain - _score(F.col("g_all"), F.col("h_all"), alpha, ridge)
    usable = cut.withColumn("gain", gain).filter(
        (F.col("gain") > 0) & (F.col("gain") >= of("gamma")) & (F.least("h_left", "h_right") >= least)
    )
    sides = ["g_left", "h_left", "g_right", "h_right"]
    order = F.struct(F.round("gain", 6), (-F.col("input")).alias("i"), (-F.col("cut")).alias("c"))
    best = usable.groupBy("model", "node").agg(F.max_by(F.struct("input", "cut", "gain", *sides), order).alias("s"))
    return best.select("model", "node", "s.*")


def splits_of(cells: pa.Table, settings: list[Setting], chosen: list[list[int]], width: int) -> list[dict]:
    """``best_splits`` of sums that are here."""
    if not cells.num_rows:
        return []
    column = {c: cells.column(c).to_numpy() for c in ("model", "node", "input", "bin", "g", "h")}
    owners, owner = np.unique(np.stack([column["model"], column["node"]], axis=1), axis=0, return_inverse=True)
    shape = (len(owners), width, int(column["bin"].max()) + 1)
    at = (owner.ravel(), column["input"], column["bin"])
    g, h, there = np.zeros(shape), np.zeros(shape), np.zeros(shape, bool)
    g[at], h[at], there[at] = column["g"], column["h"], True
    own = lambda values: np.array(values, float)[owners[:, 0]][:, None, None]
    alpha, ridge = own([s.reg_alpha for s in settings]), own([s.reg_lambda for s in settings])

    def score(gs: np.ndarray, hs: np.ndarray) -> np.ndarray:
        shrunk = np.maximum(np.abs(gs) - alpha, 0.0)
        return np.divide(shrunk * shrunk, hs + ridge, out=np.zeros_like(gs), where=hs + ridge != 0)

    g_all, h_all = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
    g_left, h_left = np.cumsum(g, axis=2) - g, np.cumsum(h, axis=2) - h
    g_right, h_right = g_all - g_left, h_all - h_left
    gain = score(g_left, h_left) + score(g_right, h_right) - score(g_all, h_all)
    usable = there & (np.cumsum(there, axis=2) > 1) & (gain > 0) & (gain >= own([s.gamma for s in settings]))
    usable &= np.minimum(h_left, h_right) >= own([s.min_child_weight for s in settings])
    allowed = np.zeros((len(settings), width), bool)
    for k, inputs in enumerate(chosen):
        allowed[k, inputs] = True
    usable &= allowed[owners[:, 0]][:, :, None]
    ranked = np.where(usable, np.round(gain, 6), -1.0).reshape(len(owners), -1)
    best = ranked.argmax(axis=1)
    out = []
    for k in np.flatnonzero(usable.reshape(len(owners), -1)[np.arange(len(owners)), best]).tolist():
        i, c = divmod(int(best[k]), shape[2])
        sides = {"g_left": g_left, "h_left": h_left, "g_right": g_right, "h_right": h_right, "gain": gain}
        out.append({"model": int(owners[k, 0]), "node": int(owners[k, 1]), "input": i, "cut": c, **{n: float(v[k, i, c]) for n, v in sides.items()}})
    return out


def leaf_weight(g: float, h: float, setting: Setting) -> float:
    shrunk = max(abs(g) - setting.reg_alpha, 0.0)
    if not shrunk or h + setting.reg_lambda <= 0:
        return 0.0
    return (-1 if g > 0 else 1) * setting.learning_rate * shrunk / (h + setting.reg_lambda)


def gradients(margin: Column) -> tuple[Column, Column]:
    """Gradient and hessian of the weighted logistic loss at a margin."""
    p = F.lit(1.0) / (1 + F.exp(-margin))
    return F.col("weight") * (p - F.col("label")), F.col("weight") * p * (1 - p)


def _margins(pending: list[list[Tree]]) -> Column:
    """The stored margins of all models with what their trees since then add."""
    if not any(pending):
        return F.col("margins")
    trees = _constant([[t.plain() for t in own] for own in pending], f"array<array<{TREE}>>")
    depth = max(t.depth for own in pending for t in own)
    return F.zip_with(
        "margins", trees, lambda m, own: F.aggregate(own, m, lambda total, t: total + t["leaf"][_leaf(t, depth)])
    )


def fit(
    rows: DataFrame, settings: list[Setting], key: list[str], inputs: str = "inputs", cuts: list[list[float]] | None = None,
) -> list[Ensemble]:
    """A model for each setting, grown side by side.

    ``rows`` holds key, inputs (an array of doubles without nulls), label, weight and, if a setting
    names one, fold.  The draw of rows for a tree follows the key.  An empty table gives models
    without trees, whose probability is a half.
    """
    spark = rows.sparkSession
    first = rows.select(F.size(inputs)).head()
    width = first[0] if first else 0
    cuts = (cut_points(rows, inputs, width) if first else []) if cuts is None else cuts
    models = [Ensemble(s, cuts) for s in settings]
    if not first:
        return models
    chance = [random.Random(s.seed) for s in settings]
    fold = F.col("fold") if any(s.fold is not None for s in settings) else F.lit(None)
    importable(spark)
    most = max(map(len, cuts), default=0)
    narrow = "array<tinyint>" if most < 128 else "array<int>"
    state = rows.select(
        F.xxhash64(*key).alias("row"), F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"),
        fold.cast("int").alias("fold"), binned(cuts, inputs).cast(narrow).alias("bins"), F.array_repeat(F.lit(0.0), len(settings)).alias("margins"),
    )
    kept = Kept(spark, "boosting")
    state = kept.replace(state)
    pending: list[list[Tree]] = [[] for _ in settings]
    for turn in range(max((s.n_estimators for s in settings), default=0)):
        growing = [k for k, s in enumerate(settings) if turn < s.n_estimators]
        trees = {k: Tree(settings[k].max_depth) for k in growing}
        chosen = [sorted(c.sample(range(width), max(1, round(s.colsample * width)))) for c, s in zip(chance, settings)]
        open_nodes = {(k, 0) for k in growing}
        for level in range(max(settings[k].max_depth for k in growing)):
            open_nodes = {(k, n) for k, n in open_nodes if level < settings[k].max_depth}
            if not open_nodes:
                break
            cells = len(open_nodes) * width * (most + 1)
            if cells <= TASK_CELLS:
                sums = _level_sums(state, settings, trees, pending, open_nodes, chosen, turn, level, most + 1)
            else:
                margins = state.withColumn("margins", _margins(pending))
                sums = histograms(margins, _learned(settings, trees, open_nodes, turn, level))
            if cells <= MOST_CELLS:
                splits = splits_of(sums.toArrow(), settings, chosen, width)
            else:
                splits = best_splits(sums, settings, chosen).collect()
            open_nodes = set()
            for s in splits:
                tree, n, own = trees[s["model"]], s["node"], settings[s["model"]]
                tree.input[n], tree.cut[n], tree.gain[n] = s["input"], s["cut"], s["gain"]
                for child, side in ((2 * n + 1, "left"), (2 * n + 2, "right")):
                    tree.leaf[child] = leaf_weight(s[f"g_{side}"], s[f"h_{side}"], own)
                    open_nodes.add((s["model"], child))
        for k, tree in trees.items():
            if tree.input[0] >= 0:
                models[k].trees.append(tree)
                pending[k].append(tree)
        if max(map(len, pending)) >= STORE_EVERY:
            state = kept.replace(state.mapInArrow(_moved_on(pending), state.schema))
            pending = [[] for _ in settings]
    kept.drop()
    return models


Batches = Iterator[pa.RecordBatch]


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An array column whose entries are all as long, as rows of a matrix."""
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _leaves(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """``_leaf`` of every row of ``bins``."""
    inputs, cut = np.array(tree.input), np.array(tree.cut)
    node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        at = inputs[node]
        node = np.where(at < 0, node, 2 * node + 1 + (bins[row, at] >= cut[node]))
    return node


def _margin(stored: np.ndarray, pending: list[Tree], bins: np.ndarray) -> np.ndarray:
    """One model's stored margins with what its trees since then add."""
    out = stored
    for tree in pending:
        out = out + np.array(tree.leaf)[_leaves(tree, bins, tree.depth)]
    return out


def _moved_on(pending: list[list[Tree]]) -> Callable[[Batches], Batches]:
    """Over stored rows: the same with margins that hold the pending trees."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, margins = _matrix(batch, "bins"), _matrix(batch, "margins")
            new = np.stack([_margin(margins[:, k], own, bins) for k, own in enumerate(pending)], axis=1)
            ends = pa.array(np.arange(0, new.size + 1, new.shape[1]), pa.int32())
            at = batch.schema.get_field_index("margins")
            yield batch.set_column(at, "margins", pa.ListArray.from_arrays(ends, pa.array(new.ravel())))

    return run


def _level_sums(
    state: DataFrame, settings: list[Setting], trees: dict[int, Tree], pending: list[list[Tree]], open_nodes: set,
    chosen: list[list[int]], turn: int, level: int, bins_of: int,
) -> DataFrame:
    """``histograms`` of the open nodes over the inputs that their models may use.

    A task adds its rows up in arrays of a cell per (open node, input, bin); only these are shuffled.
    """
    open_of = {k: sorted(n for model, n in open_nodes if model == k) for k in sorted({k for k, _ in open_nodes})}
    seeds = sorted({settings[k].seed for k in open_of if settings[k].subsample < 1})
    draws = [F.pmod(F.xxhash64("row", F.lit(seed), F.lit(turn)), F.lit(1_000_000)).alias(f"draw{i}") for i, seed in enumerate(seeds)]

    def run(batches: Batches) -> Batches:
        sums = {k: np.zeros((3, len(chosen[k]), len(nodes) * bins_of)) for k, nodes in open_of.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            plain = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("label", "weight", "fold", *[f"draw{i}" for i in range(len(seeds))])}
            bins, margins = _matrix(batch, "bins"), _matrix(batch, "margins")
            for k, nodes in open_of.items():
                own = settings[k]
                slots = np.full(2 ** (own.max_depth + 1) - 1, -1)
                slots[nodes] = np.arange(len(nodes))
                slot = slots[_leaves(trees[k], bins, level)]
                taken = slot >= 0
                if own.subsample < 1:
                    taken &= plain[f"draw{seeds.index(own.seed)}"] < round(own.subsample * 1_000_000)
                if own.fold is not None:  # a row without a fold teaches no model that leaves one out
                    fold = plain["fold"].astype(float)
                    taken &= ~np.isnan(fold) & (fold != own.fold)
                rows = np.flatnonzero(taken)
                if not len(rows):
                    continue
                used = bins[rows]
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-_margin(margins[rows, k], pending[k], used)))
                g = plain["weight"][rows] * (p - plain["label"][rows])
                h = plain["weight"][rows] * p * (1 - p)
                start, size = slot[rows] * bins_of, len(nodes) * bins_of
                for i, j in enumerate(chosen[k]):
                    cell = start + used[:, j]
                    sums[k][0, i] += np.bincount(cell, g, size)
                    sums[k][1, i] += np.bincount(cell, h, size)
                    sums[k][2, i] += np.bincount(cell, minlength=size)
        for k, nodes in open_of.items():
            i, cell = np.nonzero(sums[k][2])
            g, h, n = sums[k][:, i, cell]
            found = [np.full(len(i), k), np.array(nodes)[cell // bins_of], np.array(chosen[k])[i], cell % bins_of]
            columns = [*[pa.array(x, pa.int32()) for x in found], pa.array(g), pa.array(h), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["model", "node", "input", "bin", "g", "h", "n"])

    read = state.select("label", "weight", "fold", "bins", "margins", *draws)
    parts = read.mapInArrow(run, "model int, node int, input int, bin int, g double, h double, n long")
    return parts.groupBy("model", "node", "input", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def _learned(settings: list[Setting], trees: dict[int, Tree], open_nodes: set, turn: int, level: int) -> Column:
    """Of a row, a struct (model, node, g, h) for every model that learns from it in this level."""
    out = []
    for k in sorted({k for k, _ in open_nodes}):
        own = settings[k]
        node = _leaf(_constant(trees[k].plain(), TREE), level) if level else F.lit(0)
        g, h = gradients(F.col("margins")[k])
        taken = F.lit(True)
        if own.subsample < 1:
            drawn = F.pmod(F.xxhash64("row", F.lit(own.seed), F.lit(turn)), F.lit(1_000_000))
            taken = taken & (drawn < round(own.subsample * 1_000_000))
        if own.fold is not None:
            taken = taken & (F.col("fold") != own.fold)
        if level:
            nodes = [n for model, n in sorted(open_nodes) if model == k]
            taken = taken & F.array_contains(_constant(nodes, "array<int>"), node)
        out.append(F.when(taken, F.struct(F.lit(k).alias("model"), node.alias("node"), g.alias("g"), h.alias("h"))))
    return F.array_compact(F.array(*out))


def decisions(rows: DataFrame, models: list[Ensemble], inputs: str = "inputs") -> DataFrame:
    """(model, label, hit) of every model on the rows of the fold that it did not learn from."""
    ready = rows.select("label", "fold", binned(models[0].cuts, inputs).alias("bins"), F.array_repeat(F.lit(0.0), len(models)).alias("margins"))
    judged = ready.select("label", "fold", F.posexplode(_margins([m.trees for m in models])).alias("model", "margin"))
    own = _constant([-1 if m.setting.fold is None else m.setting.fold for m in models], "array<int>")[F.col("model")]
    return judged.filter(F.col("fold") == own).select("model", "label", (F.col("margin") >= 0).alias("hit"))
