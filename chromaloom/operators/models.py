"""Contact probability by separation: histograms with equal counts, model fits and F-tests.

Distances are first counted per value; edges and histogram are found on those counts with
prefix sums over ranges of values, so nothing sorts or collects single pairs.  At most MAX_BINS
rows per class reach the driver, where the models are fitted.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.special import f_survival

MAX_BINS = 1024
FIT_RANGE = (1_000, 7_000_000)
CLASSES = ["ff", "fr", "rf", "rr"]


def bin_count(n: int, low: float, high: float, q1: float, q3: float) -> int:
    """Bins that the narrower of the Sturges and Freedman-Diaconis widths gives.

    The latter counts as half the square-root width at least, and widths of whole numbers as 1.
    """
    if n == 0 or high <= low:
        return 1
    span = high - low
    width = span / (math.log2(n) + 1)
    fd = max(2 * (q3 - q1) / n ** (1 / 3), span / math.sqrt(n) / 2)
    width = max(min(width, fd), 1.0)
    return min(max(math.ceil(span / width), 1), MAX_BINS)


def frequencies(distances: DataFrame) -> DataFrame:
    """dis, class counts ff, fr, rf, rr and n: one row per distance."""
    each = [F.count_if(F.col("class") == c).alias(c) for c in CLASSES]
    return distances.groupBy("dis").agg(F.count("*").alias("n"), *each)


def with_ranks(counted: DataFrame) -> DataFrame:
    """Adds ``upto``: how many pairs have at most this distance; prefix sums in two levels."""
    block = F.shiftright("dis", 12)
    sums = counted.groupBy(block.alias("_block")).agg(F.sum("n").alias("_n"))
    sums = sums.select("_block", (F.sum("_n").over(W.orderBy("_block")) - F.col("_n")).alias("_base"))
    within = W.partitionBy("_block").orderBy("dis")
    return counted.withColumn("_block", block).join(sums, "_block").withColumn("upto", F.col("_base") + F.sum("n").over(within)).drop("_block", "_base")


def equal_edges(counted: DataFrame) -> list[float]:
    """Edges of bins that hold equally many pairs, interpolated between neighbouring ranks."""
    stats = counted.agg(F.sum("n"), F.min("dis"), F.max("dis"), F.percentile("dis", F.array(F.lit(0.25), F.lit(0.75)), F.col("n"))).first()
    if not stats[0]:
        return []
    n, low, high, (q1, q3) = stats
    bins = bin_count(n, low, high, q1, q3)
    # ranks needed: floor and next of n * k / bins; each row finds those it covers by arithmetic
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    out: dict[int, int] = {}
    ranked = with_ranks(counted.select("dis", "n"))
    for shift in (0, 1):
        least = F.ceil((F.greatest(first - shift, F.lit(0))) * bins / n)
        most = F.least(F.ceil((last - shift + 1) * bins / n) - 1, F.lit(bins))
        ks = ranked.filter(most >= least).select("dis", F.explode(F.sequence(least, most)).alias("k"))
        found = ks.select("k", "dis").toPandas()  # at most bins + 1 rows
        for k, dis in zip(found["k"], found["dis"]):
            out[2 * int(k) + shift] = int(dis)
    edges = []
    for k in range(bins + 1):
        at = n * k / bins
        a = out.get(2 * k, high)
        b = out.get(2 * k + 1, high)
        edges.append(float(a + (b - a) * (at - math.floor(at))) if at < n - 1 else float(high))
    return edges


def histogram(counted: DataFrame, edges: list[float]) -> pd.DataFrame:
    """Per bin: low, high, sep (its middle), n and the count of each class; the last bin is closed."""
    handle = np.array(edges)

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.clip(np.searchsorted(handle, x.to_numpy(), "right") - 1, 0, len(handle) - 2), dtype="int32")

    sums = counted.groupBy(place("dis").alias("bin")).agg(*[F.sum(c).alias(c) for c in ["n", *CLASSES]]).toPandas()
    out = pd.DataFrame({"low": handle[:-1], "high": handle[1:]})
    out["sep"] = (out["low"] + out["high"]) / 2
    out = out.join(sums.set_index("bin")).fillna(0)
    return out


class Model:
    """A polynomial in log separation, fitted or with a fixed slope."""

    def __init__(self, name: str, x: np.ndarray, y: np.ndarray, coefficients: np.ndarray, params: int):
        self.name, self.coefficients, self.params, self.n = name, coefficients, params, len(x)
        self.predicted = np.polynomial.polynomial.polyval(x, coefficients) if len(x) else np.zeros(0)
        self.rss = float(((y - self.predicted) ** 2).sum())


def fit_models(x: np.ndarray, y: np.ndarray) -> list[Model]:
    """Polynomials of degree 0, 1 and 2, and the slopes -1 and -0.5 of interphase and mitosis."""
    out = []
    for degree in range(3):
        c = np.full(degree + 1, np.nan)
        if len(x) > 1:
            c[:] = 0
            found = np.polynomial.Polynomial.fit(x, y, degree).convert().coef
            c[: len(found)] = found
        out.append(Model(f"poly model deg {degree}", x, y, c, degree + 1))
    for name, slope in (("I-phase model", -1.0), ("M-phase model", -0.5)):
        offset = float(np.mean(y - slope * x)) if len(x) else math.nan
        out.append(Model(name, x, y, np.array([offset, slope]), 1))
    return out


def f_statistic(larger: Model, smaller: Model) -> tuple[float, int, int]:
    """F and its degrees of freedom, of the larger model against the smaller; nan if it is not larger."""
    dom, dof = larger.params - smaller.params, larger.n - larger.params
    if dom <= 0 or dof < 1:
        return math.nan, dom, dof
    with np.errstate(all="ignore"):
        return float(np.divide((smaller.rss - larger.rss) / dom, larger.rss / dof)), dom, dof


def fitted(distances: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray, list[Model]]]:
    """(class, separations, probabilities, ln of the separations that are fitted, models) of all, ff, fr, rf and rr."""
    counted = frequencies(distances).persist()
    try:
        edges = equal_edges(counted)
        table = histogram(counted, edges) if len(edges) > 1 else pd.DataFrame(columns=["low", "high", "sep", "n", *CLASSES], dtype=float)
    finally:
        counted.unpersist()
    with np.errstate(all="ignore"):
        density = table["n"].to_numpy(float) / (table["high"] - table["low"]).to_numpy(float) / max(table["n"].sum(), 1)
        per_pair = density / table["n"].to_numpy(float)
    sep = table["sep"].to_numpy(float)
    out = []
    for cls in ["all", *CLASSES]:
        if cls != "all" and not table[cls].sum():
            continue
        with np.errstate(all="ignore"):
            prob = density if cls == "all" else per_pair * table[cls].to_numpy(float)
            select = (sep > FIT_RANGE[0]) & (sep < FIT_RANGE[1])
            x, y = np.log(sep[select]), np.log(prob[select])
        usable = np.isfinite(y)
        out.append((cls, sep, prob, x[usable], fit_models(x[usable], y[usable])))
    return out


def contact_models(distances: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prob, sep, type, class) and (model1, model2, p_value, class) of a frame (class, dis).

    Classes are all, ff, fr, rf and rr; undefined values are null.
    """
    spark, probs, tests = distances.sparkSession, [], []
    for cls, sep, prob, x, fits in fitted(distances):
        probs += [(p, s, "histogram", cls) for p, s in zip(prob, sep)]
        for m in fits:
            probs += [(float(np.exp(p)), float(np.exp(s)), m.name, cls) for p, s in zip(m.predicted, x)]
            tests += _compared(cls, m, fits)
    told = _frame(spark, tests, STATISTICS).select("model1", "model2", f_survival(F.col("f"), F.col("dom"), F.col("dof")).alias("p_value"), "class")
    return _frame(spark, probs, "prob double, sep double, type string, class string"), told


STATISTICS = "model1 string, model2 string, class string, dom int, dof int, f double"


def _compared(cls: str, m: Model, others: list[Model]) -> list[tuple]:
    return [(m.name, o.name, cls, dom, dof, f) for o in others for f, dom, dof in [f_statistic(m, o)]]


def f_statistics(distances: DataFrame) -> DataFrame:
    """model1, model2, class, dom, dof and f of every pair of models that can be compared."""
    rows = [row for cls, *_, fits in fitted(distances) for m in fits for row in _compared(cls, m, fits)]
    return _frame(distances.sparkSession, rows, STATISTICS).filter("dom > 0 and dof > 0")


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    clean = [tuple(None if isinstance(v, float) and not math.isfinite(v) else (float(v) if isinstance(v, np.floating) else v) for v in r) for r in rows]
    return spark.createDataFrame(clean, schema)


def log_log_fit(distances: DataFrame, width: int = 100) -> DataFrame:
    """Slope and intercept of log density against log separation, on bins of fixed width; all in SQL aggregates."""
    bins = distances.groupBy(F.floor(F.col("dis") / width).alias("b")).agg(F.count("*").alias("n"))
    point = bins.select(F.ln((F.col("b") + 0.5) * width).alias("x"), F.ln(F.col("n").cast("double") / width).alias("y"))
    return point.agg(F.count("*").alias("bins"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
