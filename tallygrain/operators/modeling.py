"""Logistic modelling and its evaluation: splits, selection, cutoffs, KS, ROC, lift."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.operators.cuts import assign
from tallygrain.operators.ordering import ntile, running_totals
from tallygrain.operators.recommend import hash_bucket
from tallygrain.session import ship_by_value

ship_by_value(__name__)

ALL = "all_features"


# --- features ------------------------------------------------------------------


def worked_hours(swipes: DataFrame, hours: Column, by: str, plus_one: bool = False) -> DataFrame:
    """Days, total hours and mean hours per employee from one row per day.

    Hours are rounded to 2 digits per day. ``plus_one`` divides by one day more, for comparison with
    results that counted the identifier column as a day.
    """
    daily = swipes.select(by, F.round(hours, 2).cast("decimal(18,2)").alias("_h"))
    totals = daily.groupBy(by).agg(F.count("_h").alias("days"), F.sum("_h").cast("double").alias("total_hours"))
    return totals.withColumn("mean_hours", F.round(F.col("total_hours") / (F.col("days") + (1 if plus_one else 0)), 2))


def login_variance(mean_hours: str, standard: float = 8.0) -> Column:
    return F.lit(standard) - F.col(mean_hours)


def hash_split(df: DataFrame, key: str, percent: int = 70) -> DataFrame:
    """Mark training rows by a hash of the key: the same rows on every run and cluster."""
    return df.withColumn("is_train", hash_bucket(F.col(key), 100) < percent)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / sd of the whole column, read through one scalar subquery."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns]).alias("x")).scalar()
    held = df.withColumn("_stats", stats)
    return held.withColumns({c: F.try_divide(F.col(c) - F.col(f"_stats.{c}.m"), F.col(f"_stats.{c}.s")) for c in columns}).drop("_stats")


def target_profile(df: DataFrame, target: str, levels: Sequence[str], numeric: dict[str, float]) -> DataFrame:
    """Rows and target rate per level of each categorical column and per bin of each numeric column."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in levels]
    cells += [F.struct(F.lit(c).alias("feature"), F.floor(F.col(c) / w).cast("string").alias("level")) for c, w in numeric.items()]
    long = df.select(target, F.inline(F.array(*cells)))
    return long.groupBy("feature", "level").agg(F.count("*").alias("n"), F.avg(target).alias("rate"))


# --- logistic regression -------------------------------------------------------

MAX_STEPS, TOLERANCE = 50, 1e-10


@dataclass
class LogitFit:
    """A fitted model: its terms, then the intercept, in ``beta`` and ``covariance``."""

    terms: list[str]
    beta: np.ndarray
    covariance: np.ndarray
    rows: int
    deviance: float
    null_deviance: float

    @property
    def aic(self) -> float:
        return self.deviance + 2 * len(self.beta)

    @property
    def std_errors(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    @property
    def p_values(self) -> dict[str, float]:
        z = np.abs(self.beta) / self.std_errors
        return {name: math.erfc(v / math.sqrt(2)) for name, v in zip([*self.terms, "(Intercept)"], z)}

    def coefficients(self, df: DataFrame) -> DataFrame:
        """(term, estimate, std_error, z, p, aic, null_deviance, residual_deviance)."""
        p = self.p_values
        rows = [
            (name, float(b), float(e), float(b / e), p[name], float(self.aic), float(self.null_deviance), float(self.deviance))
            for name, b, e in zip([*self.terms, "(Intercept)"], self.beta, self.std_errors)
        ]
        schema = "term string, estimate double, std_error double, z double, p double, aic double, null_deviance double, residual_deviance double"
        return df.sparkSession.createDataFrame(rows, schema)

    def predict(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add the predicted probability, an expression over the term columns; NULL where a term is."""
        eta = F.lit(float(self.beta[-1]))
        for term, b in zip(self.terms, self.beta):
            eta = eta + F.lit(float(b)) * F.col(term).cast("double")
        return df.withColumn(out, 1 / (1 + F.exp(-eta)))


def assemble(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """All candidate terms in one array column."""
    return df.withColumn(ALL, F.array(*[F.col(t).cast("double") for t in terms]))


def _information(models: list[tuple[list[int], np.ndarray]]):
    """Per task and model: X'WX, X'(y - mu) and the deviance, in one row of numbers; row -1 counts rows and sums y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list = [0.0] * len(models)
        counts = np.zeros(2)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            y, x = columns[0], np.column_stack([*columns[1:], np.ones(batch.num_rows)])
            counts += [len(y), y.sum()]
            for k, (places, beta) in enumerate(models):
                own = x[:, [*places, x.shape[1] - 1]]
                eta = own @ beta
                mu = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
                weighted = own * (mu * (1 - mu))[:, None]
                deviance = 2 * (np.logaddexp(0, eta) - y * eta).sum()
                totals[k] = totals[k] + np.concatenate([(own.T @ weighted).ravel(), own.T @ (y - mu), [deviance]])
        if counts[0]:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(models)), pa.int32()), pa.array([counts, *totals], pa.list_(pa.float64()))], ["model", "sums"])

    return run


def fit_many(df: DataFrame, y: str, models: Sequence[Sequence[str]]) -> list[LogitFit]:
    """Maximum likelihood for several sets of terms at once, by iterated weighted least squares.

    An iteration is one pass over the rows for all models that still move: tasks return a matrix per model, as large as
    its terms, and Spark adds them up. A step that raises the deviance is halved. Rows with a NULL in ``y`` or in any term of any model take no part.
    """
    every = list(dict.fromkeys(t for terms in models for t in terms))
    frame = df.select(F.col(y).cast("double").alias("y"), *[F.col(t).cast("double").alias(f"x{i}") for i, t in enumerate(every)]).dropna()
    places = [[every.index(t) for t in terms] for terms in models]
    beta = [np.zeros(len(p) + 1) for p in places]
    last = [(np.inf, b) for b in beta]  # deviance and coefficients of the last accepted step
    fits: list[LogitFit | None] = [None] * len(models)
    rows = ones = 0.0
    for _ in range(MAX_STEPS):
        moving = [k for k, fit in enumerate(fits) if fit is None]
        if not moving:
            break
        parts = frame.mapInArrow(_information([(places[k], beta[k]) for k in moving]), "model int, sums array<double>")
        summed = parts.select("model", F.posexplode("sums")).groupBy("model", "pos").agg(F.sum("col").alias("s")).collect()
        found: dict[int, dict[int, float]] = {}
        for r in summed:
            found.setdefault(r["model"], {})[r["pos"]] = r["s"]
        if not found:
            raise ValueError("no row without NULL to fit")
        rows, ones = found[-1][0], found[-1][1]
        for at, k in enumerate(moving):
            p = len(beta[k])
            values = np.array([found[at][i] for i in range(p * p + p + 1)])
            information, score, deviance = values[: p * p].reshape(p, p), values[p * p : -1], float(values[-1])
            before, held = last[k]
            if deviance > before * (1 + 1e-12) + 1e-12:
                beta[k] = (beta[k] + held) / 2
                continue
            covariance = np.linalg.pinv(information, hermitian=True)
            if abs(before - deviance) <= TOLERANCE * (abs(deviance) + 0.1):
                share = ones / rows
                null = -2 * sum(n * math.log(q) for n, q in ((ones, share), (rows - ones, 1 - share)) if n)
                fits[k] = LogitFit(list(models[k]), beta[k], covariance, int(rows), deviance, null)
                continue
            last[k] = (deviance, beta[k])
            beta[k] = beta[k] + covariance @ score
    if any(fit is None for fit in fits):
        raise ArithmeticError("the fit did not settle: a term may tell the outcomes apart completely")
    return fits


def logit(df: DataFrame, y: str, terms: Sequence[str]) -> LogitFit:
    """Binomial GLM with logit link."""
    return fit_many(df, y, [terms])[0]


def step_aic(df: DataFrame, y: str, terms: Sequence[str]) -> tuple[LogitFit, list[tuple[str, float]]]:
    """Stepwise selection in both directions by AIC, from the full model.

    All candidates of a step are fitted together, a pass an iteration. Every step lowers the criterion, so the selection ends without
    a limit on its steps. Rows with a NULL in any of ``terms`` take no part in any step.
    """
    held = df.dropna(subset=[y, *terms])
    current = logit(held, y, terms)
    path = [("<start>", current.aic)]
    while True:
        moves = [("-" + t, [x for x in current.terms if x != t]) for t in current.terms if len(current.terms) > 1]
        moves += [("+" + t, [x for x in terms if x in current.terms or x == t]) for t in terms if t not in current.terms]
        if not moves:
            return current, path
        fits = fit_many(held, y, [own for _, own in moves])
        best = int(np.argmin([fit.aic for fit in fits]))
        if fits[best].aic >= current.aic - 1e-9:
            return current, path
        current = fits[best]
        path.append((moves[best][0], current.aic))


def backward_p(df: DataFrame, y: str, terms: Sequence[str], alpha: float = 0.05) -> tuple[LogitFit, list[tuple[str, float]]]:
    """Remove the least significant term until every p-value is at most ``alpha``."""
    held = df.dropna(subset=[y, *terms])
    current, removed = logit(held, y, terms), []
    while len(current.terms) > 1:
        values = {t: p for t, p in current.p_values.items() if t != "(Intercept)"}
        worst = max(values, key=values.get)
        if values[worst] <= alpha:
            break
        removed.append((worst, values[worst]))
        current = logit(held, y, [t for t in current.terms if t != worst])
    return current, removed


def vif(df: DataFrame, fit: LogitFit) -> DataFrame:
    """Variance inflation per term: the diagonal of the inverse of the coefficients' correlation, which the fit already has."""
    covariance = fit.covariance[:-1, :-1]
    scale = np.sqrt(np.diag(covariance))
    inflation = np.diag(np.linalg.inv(covariance / np.outer(scale, scale)))
    return df.sparkSession.createDataFrame([(t, float(v)) for t, v in zip(fit.terms, inflation)], "term string, vif double")


# --- evaluation ----------------------------------------------------------------


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "sensitivity": F.try_divide(tp, tp + fn),
        "specificity": F.try_divide(tn, tn + fp),
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
    }


def confusion(df: DataFrame, y: str, score: str, cutoff: float) -> DataFrame:
    """One row: tp, fp, fn, tn, sensitivity, specificity, accuracy at a cutoff."""
    yes, actual = F.col(score) >= cutoff, F.col(y) == 1
    counts = df.agg(
        F.count_if(yes & actual).alias("tp"), F.count_if(yes & ~actual).alias("fp"),
        F.count_if(~yes & actual).alias("fn"), F.count_if(~yes & ~actual).alias("tn"),
    )
    return counts.withColumns(_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def cutoffs(low: float = 0.01, high: float = 0.90, n: int = 100) -> list[float]:
    return [low + k * (high - low) / (n - 1) for k in range(n)]


def cutoff_sweep(df: DataFrame, y: str, score: str, points: Sequence[float], near: float = 0.01) -> DataFrame:
    """Rates at every cutoff from one pass: rows are counted per interval of cutoffs, then summed from above."""
    points = sorted(points)
    placed = assign(df.select(F.col(y).alias("_y"), F.col(score).alias("_score")), {"_score": points})
    bars = placed.groupBy(F.col("_score_range").alias("bar")).agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") != 1).alias("neg"))
    marks = F.array(*[F.struct(F.lit(i + 1).alias("bar"), F.lit(c).alias("cutoff")) for i, c in enumerate(points)])
    every = df.sparkSession.range(1).select(F.inline(F.array_append(marks, F.struct(F.lit(0).alias("bar"), F.lit(None).cast("double").alias("cutoff")))))
    # one row per cutoff from here on
    above = Window.orderBy(F.desc("bar")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    filled = every.join(bars, "bar", "left").fillna(0, ["pos", "neg"])
    summed = filled.select(
        "cutoff", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("_p"), F.sum("neg").over(whole).alias("_n"),
    )
    full = summed.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    rated = full.withColumns(_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))).where(F.col("cutoff").isNotNull())
    return rated.select("cutoff", "sensitivity", "specificity", "accuracy", (F.abs(F.col("sensitivity") - F.col("specificity")) < near).alias("balanced"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest: (score, tpr, fpr) with the counts behind them."""
    by_score = df.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    running = running_totals(by_score, "score", ["pos", "neg"], descending=True)
    return running.withColumns({"tpr": F.try_divide("cum_pos", "all_pos"), "fpr": F.try_divide("cum_neg", "all_neg")})


def roc_auc(curve: DataFrame) -> DataFrame:
    """Area under the curve by average ranks: ties between a positive and a negative count one half."""
    above = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2))
    return curve.agg((above / (F.max("all_pos").cast("double") * F.max("all_neg"))).alias("auc"))


def ks(df: DataFrame, y: str, score: str, cutoff: float) -> DataFrame:
    """Largest gap between the curves on the scores, and the gap on labels at a cutoff."""
    on_scores = roc_curve(df, y, score).agg(F.max(F.col("tpr") - F.col("fpr"))).scalar()
    at = confusion(df, y, score, cutoff)
    return at.select(on_scores.alias("ks"), (F.col("sensitivity") + F.col("specificity") - 1).alias("ks_at_cutoff"))


def decile_lift(df: DataFrame, y: str, score: str, tie: str, groups: int = 10) -> DataFrame:
    """Per tile of descending score: rows, responders, cumulative responders, gain in percent, lift."""
    tiles = ntile(df.select(y, score, tie), groups, score, tie, descending=True, out="bucket")
    table = tiles.groupBy("bucket").agg(F.count("*").alias("total"), F.sum(y).alias("totalresp"))
    # one row per tile from here on
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    gains = table.withColumn("cumresp", F.sum("totalresp").over(upto)).withColumn("gain", 100 * F.col("cumresp") / F.sum("totalresp").over(Window.partitionBy()))
    return gains.withColumn("cumlift", F.col("gain") / (F.col("bucket") * (100 / groups)))
