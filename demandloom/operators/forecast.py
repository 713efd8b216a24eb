"""Two-part store forecast: will a week have sales, and how much; one pair per horizon."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from demandloom.operators import metrics
from demandloom.operators.boosting import Encoder, Ensemble, Trainer, TreeSettings, as_rows, from_rows, sigmoid
from demandloom.operators.model_inputs import CATEGORICAL, Inputs, fit_inputs, fit_scaler
from demandloom.operators.tuning import ROWS, Search, run_search
from demandloom.operators.windows import (
    FEATURES, feature_columns, scoring_frame, target_columns, training_frame,
)
from demandloom.schema import HORIZON, LAGS, STORE, WEEKS, numbered
from demandloom.session import cut

__all__ = ["CATEGORICAL", "Search", "TreeSettings", "fit_scaler"]

# Fixed values of the two boosted models, their seed and the gate.
REGRESSOR = TreeSettings(
    trees=20, depth=6, rate=1.0, features=0.4, tree_features=0.40916614469997564, leaves=20, min_gain=0.01,
    l1=0.11249955446334554, l2=0.39595472784814545, max_step=7.541515576689044, min_weight=1.0,
)
CLASSIFIER = TreeSettings(
    trees=70, depth=2, rate=0.09080085983910437, features=0.1, leaves=39, min_rows=10, bins=48, l2=0.1, held_out=0.1,
)
SEED = 411
THRESHOLD = 0.986
PARALLEL = 3


@dataclass(frozen=True)
class HurdleSettings:
    """Parameters of both models; a ``Search`` in place of parameters is run inside the fit."""

    regressor: TreeSettings | Search = REGRESSOR
    classifier: TreeSettings | Search | None = CLASSIFIER
    threshold: float = THRESHOLD
    seed: int = SEED

    def __post_init__(self):
        if not 0 < self.threshold <= 1:
            raise ValueError("threshold must be in (0, 1]")


def naive_forecast(windows: DataFrame, key: str = STORE, last_week: int = WEEKS, first_lag: int = LAGS + 1,
                   horizon: int = HORIZON, prefix: str = "column_") -> DataFrame:
    """The store's own ``horizon`` weeks from window position ``first_lag``, used as forecast."""
    return windows.where(F.col("week") == last_week).select(
        key, *[F.col(numbered("quantity", first_lag + h)).alias(f"{prefix}{h}") for h in range(horizon)]
    )


def binary_targets(frame: DataFrame, targets: Sequence[str], keep: Sequence[str] = (STORE,)) -> DataFrame:
    """1 where the target week has sales, else 0."""
    return frame.select(*keep, *[(F.col(t) > 0).cast("double").alias(t) for t in targets])


def gate(frame: DataFrame, chances: Sequence[str], amounts: Sequence[str], outputs: Sequence[str], threshold: float,
         keep: Sequence[str] = (STORE,)) -> DataFrame:
    """Amounts where the chance of a sale beats the threshold, else 0.

    Threshold 1 keeps only cells equal to the largest chance of the whole frame.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    if threshold == 1:
        top = frame.agg(F.max(F.greatest(*chances))).scalar() if len(chances) > 1 else frame.agg(F.max(chances[0])).scalar()
        def passes(c: str) -> Column:
            return F.col(c) == top
    else:
        def passes(c: str) -> Column:
            return F.col(c) > threshold
    return frame.select(
        *keep,
        *[F.when(passes(c), F.col(a)).otherwise(0.0).alias(o) for c, a, o in zip(chances, amounts, outputs, strict=True)],
    )


@dataclass
class HurdleModel:
    """Fitted models of all horizons; scores in place, so ids never leave their row."""

    inputs: Inputs
    amounts: Ensemble
    chances: Ensemble | None
    threshold: float
    constant: dict[int, float] = field(default_factory=dict)  # chance of horizons with a single class
    search: list[tuple] = field(default_factory=list)

    @property
    def horizon(self) -> int:
        return self.amounts.targets

    def components(self, frame: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Chance of a sale (``chance_h``) and amount (``amount_h``) per horizon."""
        encoder, amounts, chances, constant = self.inputs.encoder, self.amounts, self.chances, dict(self.constant)
        keep, names = list(keep), [f"amount_{h}" for h in range(self.horizon)]
        if chances:
            names += [f"chance_{h}" for h in range(self.horizon)]
        kept = frame.select(*keep).schema
        schema = StructType(kept.fields)
        for name in names:
            schema = schema.add(name, DoubleType())

        def run(batches):
            amount, chance = amounts.scorer(encoder.width), chances.scorer(encoder.width) if chances else None
            for batch in batches:
                x = encoder.bins(batch)
                out = list(amount(x))
                if chance:
                    out += [np.full(batch.num_rows, constant[h]) if h in constant else sigmoid(score) for h, score in enumerate(chance(x))]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(c) for c in out], [*keep, *names])

        rows = self.inputs.rows(frame)
        return rows.select(*keep, *encoder.columns(rows)).mapInArrow(run, schema)

    def predict(self, frame: DataFrame, keep: Sequence[str] = (STORE,)) -> DataFrame:
        """Gated forecast ``column_0 ..``; plain amounts when there is no classifier."""
        parts = self.components(frame, keep)
        outputs = [f"column_{h}" for h in range(self.horizon)]
        amounts = [f"amount_{h}" for h in range(self.horizon)]
        if not self.chances:
            return parts.select(*keep, *[F.col(a).alias(o) for a, o in zip(amounts, outputs, strict=True)])
        chances = [f"chance_{h}" for h in range(self.horizon)]
        if self.threshold == 1:
            parts = cut(parts)  # read twice: for the largest chance, and for the gate
        return gate(parts, chances, amounts, outputs, self.threshold, keep)

    def best_parameters(self, spark: SparkSession) -> DataFrame:
        """(model, parameter, value) of the models that a search has chosen."""
        best = [(name, parameter, value) for name, _, won, _, parameter, value in self.search if won]
        return spark.createDataFrame(best, "model string, parameter string, value double")

    def trials(self, spark: SparkSession) -> DataFrame:
        """All trials of the searches, as ``tuning`` returns them."""
        return spark.createDataFrame(self.search, ROWS)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as a table: a row per tree, and one for scaler, bins, gate and trials."""
        head = {"features": self.inputs.features, "scaler": self.inputs.scaler, "encoder": asdict(self.inputs.encoder), "threshold": self.threshold,
                "constant": list(self.constant.items()), "search": self.search}
        rows = [("model", 0, -1, json.dumps(head))]
        for name, part in (("amounts", self.amounts), ("chances", self.chances)):
            rows += [(name, *row) for row in as_rows(part)] if part else []
        spark.createDataFrame(rows, "part string, target int, tree int, content string").write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> HurdleModel:
        parts: dict[str, list] = {}
        for part, target, tree, content in spark.read.parquet(path).collect():  # as large as the model
            parts.setdefault(part, []).append((target, tree, content))
        head = json.loads(parts["model"][0][2])
        scaler = {c: tuple(v) for c, v in head["scaler"].items()}
        return HurdleModel(
            Inputs(head["features"], scaler, Encoder(**head["encoder"])), from_rows(parts["amounts"]),
            from_rows(parts["chances"]) if "chances" in parts else None, head["threshold"], {int(h): v for h, v in head["constant"]},
            [tuple(row) for row in head["search"]],
        )


def fit_hurdle(frame: DataFrame, features: Sequence[str], targets: Sequence[str],
               settings: HurdleSettings = HurdleSettings()) -> HurdleModel:
    """Fit all horizons of both models side by side on one packed table.

    Where the settings hold a ``Search``, it runs first, on the same table, and its winner is fitted on all rows. A horizon with a
    single class gets a constant chance.
    """
    targets = list(targets)
    inputs = fit_inputs(frame, features)
    searches = [s for s in (settings.regressor, settings.classifier) if isinstance(s, Search)]
    if len({s.folds for s in searches}) > 1:
        raise ValueError("both searches must have the same number of folds")
    trainer = Trainer(inputs.blocks(frame, targets, folds=searches[0].folds if searches else 0), inputs.encoder, len(targets))
    trials: list[tuple] = []

    def chosen(setting: TreeSettings | Search, chance: bool) -> TreeSettings:
        if not isinstance(setting, Search):
            return setting
        found = run_search(trainer, inputs, setting, chance, len(targets))
        trials.extend(found.rows)
        return found.best

    try:
        amounts = inputs.amounts(chosen(settings.regressor, False), len(targets), settings.seed)
        chances, constant = None, {}
        if settings.classifier:
            rates = frame.agg(*[F.avg((F.col(t) > 0).cast("double")).alias(t) for t in targets]).first()
            constant = {h: float(rates[t]) for h, t in enumerate(targets) if rates[t] in (0.0, 1.0)}
            chances = inputs.chances(chosen(settings.classifier, True), len(targets), settings.seed)
            chances.stopped = [h in constant for h in range(len(targets))]
        trainer.advance([e for e in (amounts, chances) if e])
    finally:
        trainer.close()
    return HurdleModel(inputs, amounts, chances, settings.threshold, constant, trials)


def forecast_next_weeks(
    windows: DataFrame,
    last_weeks: Sequence[int] = (WEEKS,),
    key: str = STORE,
    features: Sequence[str] = FEATURES,
    settings: HurdleSettings = HurdleSettings(),
    mode: str = "contiguous",
) -> DataFrame:
    """Train on the windows that end in the last week, score the weeks after it."""
    if len(last_weeks) != 1:
        raise ValueError("scoring takes exactly one final training week")
    week = last_weeks[0]
    train = cut(training_frame(windows, week, key, features))
    model = fit_hurdle(train, feature_columns(windows, features), target_columns(), settings)
    return model.predict(scoring_frame(windows, week, key, features, mode=mode), (key,))


def _error_rows(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(model, horizon, mae, mape1, all_zero) of rows (model, horizon, y, prediction), with a mean over horizons."""
    per_horizon = cells.groupBy(*by, "model", "horizon").agg(
        F.avg(metrics.absolute_error()).alias("mae"), F.avg(metrics.relative_error()).alias("mape1"),
        F.sum("prediction").alias("predicted"),
    )
    rows = per_horizon.groupBy(*by, "model").agg(
        F.collect_list(F.struct(F.col("horizon").cast("string").alias("horizon"), "mae", "mape1", "predicted")).alias("rows"),
        F.struct(F.lit(metrics.MEAN).alias("horizon"), F.avg("mae").alias("mae"), F.avg("mape1").alias("mape1"),
                 F.sum("predicted").alias("predicted")).alias("mean"),
    )  # one row a horizon
    return rows.select(*by, "model", F.inline(F.concat("rows", F.array("mean")))).select(
        *by, "model", "horizon", "mae", "mape1", (F.col("predicted") == 0).alias("all_zero"))


def _cells(frame: DataFrame, models: dict[str, Sequence[Column]], targets: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (row, model, horizon) with actual and predicted value, in one pass over ``frame``."""
    return frame.select(*by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(h + 1).alias("horizon"), F.col(t).cast("double").alias("y"), p.cast("double").alias("prediction"))
        for name, predictions in models.items() for h, (t, p) in enumerate(zip(targets, predictions, strict=True))
    ])))


def yardsticks(frame: DataFrame, targets: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Error rows of two forecasts without a model: the weeks just before the targets, and nothing."""
    first = LAGS - len(targets) + 1
    naive = [F.col(numbered("quantity", first + h)) for h in range(len(targets))]
    return _error_rows(_cells(frame, {"naive": naive, "zero": [F.lit(0.0)] * len(targets)}, targets, by), by)


def score(model: HurdleModel, frame: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Error rows (model, horizon, mae, mape1, all_zero) of the model, its regressor and the yardsticks on one frame."""
    horizon = range(len(targets))
    before = [numbered("quantity", LAGS - len(targets) + 1 + h) for h in horizon]
    keep = [*targets, *[c for c in before if c not in targets]]
    parts = cut(model.components(frame, keep))
    amounts, chances = [f"amount_{h}" for h in horizon], [f"chance_{h}" for h in horizon]
    outputs = [f"column_{h}" for h in horizon]
    if model.chances:
        gated = gate(parts, chances, amounts, outputs, model.threshold, (*keep, *amounts))
    else:
        gated = parts.select(*keep, *amounts, *[F.col(a).alias(o) for a, o in zip(amounts, outputs, strict=True)])
    return _error_rows(_cells(gated, {
        "hurdle": [F.col(c) for c in outputs], "regressor": [F.col(c) for c in amounts],
        "naive": [F.col(c) for c in before], "zero": [F.lit(0.0)] * len(targets),
    }, targets))


def backtest(
    windows: DataFrame,
    test_weeks: Sequence[int],
    key: str = STORE,
    features: Sequence[str] = FEATURES,
    settings: HurdleSettings = HurdleSettings(),
) -> DataFrame:
    """Rolling origin: train on windows ending ``HORIZON`` weeks earlier, test on each week.

    Returns error rows per (week, sample, model, horizon). Each origin is fitted on the
    cluster; the driver only submits the handful of origins, a few at a time.
    """
    first = LAGS + 2 * HORIZON
    bad = [w for w in test_weeks if not first <= w <= WEEKS]
    if bad:
        raise ValueError(f"test weeks {bad} outside {first}..{WEEKS}")
    names, targets = feature_columns(windows, features), target_columns()

    def origin(week: int) -> list[DataFrame]:
        train = cut(training_frame(windows, week - HORIZON, key, features))
        test = cut(training_frame(windows, week, key, features))
        model = fit_hurdle(train, names, targets, settings)
        return [score(model, frame, targets).select(F.lit(week).alias("week"), F.lit(sample).alias("sample"), "*")
                for sample, frame in (("train", train), ("test", test))]

    with ThreadPoolExecutor(PARALLEL) as pool:
        results = [rows for rows_of in pool.map(origin, test_weeks) for rows in rows_of]
    return reduce(DataFrame.unionByName, results)
