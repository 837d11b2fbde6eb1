"""Search over boosted-tree parameters by successive halving, with trials that stop early and resume.

Spark's own boosted trees cannot go on from a fitted model, so a trial is boosted here tree by tree: each tree is a Spark
regression tree on the gradient of the loss at the rows' present margins, on a seeded hash sample of the rows, and its
step moves the margins of training and evaluation rows alike.  At the end of a rung the margins are written to the shared
folder: a trial that goes on reads them and adds trees, it never fits a tree twice.

``search`` draws trials from a space, runs all of them to the first rung, keeps the better half by evaluation ROC AUC, and
so on; trials of a rung run ``parallel`` at a time.  Every trial, rung and iteration is a row of the written tables that
``trial_info`` and ``iterations`` read.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.operators.ml import roc_auc
from sparklab.session import ensure_checkpoint_dir

#: Ranges of the search: depth, learning rate, least gain of a split (which takes the place of a penalty on
#: leaf weights, that Spark's trees do not have) and the share of rows a tree sees.
SPACE = {"max_depth": (3, 10), "learn_rate": (0.05, 0.3), "min_split_gain": (0.0, 0.05), "subsample": (0.6, 1.0)}


def draw(n: int, seed: int, space: dict = SPACE) -> list[dict]:
    """``n`` seeded draws: whole numbers where both ends are whole, the learning rate on a log scale."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        trial = {}
        for name, (lo, hi) in space.items():
            if isinstance(lo, int) and isinstance(hi, int):
                trial[name] = rng.randint(lo, hi)
            elif name == "learn_rate":
                trial[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                trial[name] = rng.uniform(lo, hi)
        out.append(trial)
    return out


@dataclass
class Trial:
    trial_id: int
    params: dict
    folder: str
    seed: int
    trees: list = field(default_factory=list)
    losses: list[tuple[int, float, float]] = field(default_factory=list)
    fits: int = 0
    auc: float | None = None
    rung: int = 0
    status: str = "RUNNING"
    message: str = ""
    at: str | None = None  # where the margins are


def _loss(margin: Column, y: Column) -> Column:
    """Logistic loss of a margin, without overflow."""
    z = F.when(y == 1, margin).otherwise(-margin)
    return F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def start(rows: DataFrame, key: str, label: str, features: str, is_eval: str) -> DataFrame:
    """The rows a trial begins with: margins at the log odds of the training rows."""
    p = rows.where(~F.col(is_eval) & F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
    base = 0.0 if p is None or p <= 0 or p >= 1 else math.log(p / (1 - p))
    return rows.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), F.col(features).alias("features"), F.col(is_eval).alias("is_eval"), F.lit(base).alias("margin"))


def boost(trial: Trial, rows: DataFrame, trees: int, patience: int = 0, tolerance: float = 0.0) -> None:
    """Add ``trees`` trees to a trial; with ``patience`` stop after so many without a fall of the evaluation loss by
    ``tolerance``.  The margins are written once, at the end."""
    spark: SparkSession = rows.sparkSession
    state = rows if trial.at is None else rows.drop("margin").join(spark.read.schema("key long, margin double").parquet(trial.at), "key")
    state = state.cache()
    p = trial.params
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="residual", predictionCol="step", maxDepth=p["max_depth"], minInfoGain=p["min_split_gain"], seed=trial.seed)
    best, since = min((x[2] for x in trial.losses), default=math.inf), 0
    try:
        for _ in range(trees):
            n = len(trial.trees)
            residual = F.col("y") - 1 / (1 + F.exp(-F.col("margin")))
            seen = F.pmod(F.xxhash64("key", F.lit(trial.seed * 1000 + n)), F.lit(10_000)) < int(p["subsample"] * 10_000)
            model = tree.fit(state.where(~F.col("is_eval") & seen).withColumn("residual", residual))
            trial.fits += 1
            trial.trees.append(model)
            moved = model.transform(state).withColumn("margin", F.col("margin") + 4 * p["learn_rate"] * F.col("step")).drop("step").cache()
            loss = moved.groupBy("is_eval").agg(F.avg(_loss(F.col("margin"), F.col("y"))).alias("loss")).collect()  # two rows
            state.unpersist()
            state = moved
            by = {r["is_eval"]: r["loss"] for r in loss}
            trial.losses.append((n + 1, by.get(False, math.nan), by.get(True, math.nan)))
            since = 0 if by.get(True, math.nan) < best - tolerance else since + 1
            best = min(best, by.get(True, math.inf))
            if patience and since >= patience:
                trial.status = "EARLY_STOPPED"
                break
        trial.at = f"{trial.folder}/margins-{trial.trial_id}-{len(trial.trees)}"
        state.select("key", "margin").write.parquet(trial.at)
        held = state.where("is_eval").withColumn("p", 1 / (1 + F.exp(-F.col("margin"))))
        trial.auc = roc_auc(held, "p", F.col("y") == 1.0).first()["roc_auc"]
    finally:
        state.unpersist()


def search(data: DataFrame, key: str, label: str, features: str, is_eval: str, trials: int = 10, parallel: int = 2, rungs: tuple[int, ...] = (2, 4, 8), seed: int = 7, space: dict = SPACE, on_fit: Callable | None = None) -> str:
    """Run a search and return the folder of its tables.

    ``rungs`` are the trees a trial has at the end of each rung.  A trial that raises is a row with status FAILED."""
    spark = data.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tuning-{uuid.uuid4().hex}"
    start(data, key, label, features, is_eval).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    every = [Trial(k, p, folder, seed + k) for k, p in enumerate(draw(trials, seed, space))]

    def run(trial: Trial, upto: int) -> None:
        try:
            boost(trial, rows, upto - len(trial.trees))
            if on_fit:
                on_fit(trial)
        except Exception as e:  # noqa: BLE001
            trial.status, trial.message = "FAILED", str(e)[:200]

    alive = every
    for rung, upto in enumerate(rungs):
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(lambda t: run(t, upto), alive))
        for t in alive:
            t.rung = rung
        alive = sorted((t for t in alive if t.status != "FAILED"), key=lambda t: (-(t.auc if t.auc is not None else -1), t.trial_id))
        if rung < len(rungs) - 1:
            for t in alive[max(1, len(alive) // 2) :]:
                t.status = "STOPPED"
            alive = alive[: max(1, len(alive) // 2)]
    for t in alive:
        t.status = "SUCCEEDED"
    best = alive[0].trial_id if alive else None
    table = [(t.trial_id, int(t.params["max_depth"]), float(t.params["learn_rate"]), float(t.params["min_split_gain"]), float(t.params["subsample"]), t.rung, len(t.trees), t.fits, t.losses[-1][1] if t.losses else None, t.losses[-1][2] if t.losses else None, t.auc, t.status, t.message, t.trial_id == best) for t in every]
    kind = "trial_id int, max_depth int, learn_rate double, min_split_gain double, subsample double, rung int, n_trees int, n_fits int, training_loss double, eval_loss double, roc_auc double, status string, error_message string, is_optimal boolean"
    spark.createDataFrame(table, kind).coalesce(1).write.parquet(f"{folder}/trials")  # a row per trial
    steps = [(t.trial_id, *x) for t in every for x in t.losses]
    spark.createDataFrame(steps, "trial_id int, iteration int, loss double, eval_loss double").coalesce(1).write.parquet(f"{folder}/iterations")
    return folder


def trial_info(spark: SparkSession, folder: str) -> DataFrame:
    """The trials of a search, as written when it ended."""
    return spark.read.parquet(f"{folder}/trials").orderBy("trial_id")


def iterations(spark: SparkSession, folder: str) -> DataFrame:
    """Training and evaluation loss after every tree of every trial."""
    return spark.read.parquet(f"{folder}/iterations").orderBy("trial_id", "iteration")
