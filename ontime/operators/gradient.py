"""One linear layer trained by gradient steps on the whole data (M9), and checks of fitted linear models.

The reference trained a one-layer network with Adam on mini-batches of a small
sample.  Here every row takes part:

* rows are standardised once, dealt to mini-batches by key hash and written
  partitioned by batch, so a step reads only its batch's folder and an epoch is
  one scan of the data;
* a step is one aggregate: partial sums of error times feature by task, one row
  of ``features + 3`` numbers to the driver;
* weights and optimiser state are a few numbers on the driver.  They enter the
  next step as one array literal, so its compiled code is that of the step
  before;
* the state after any step can be kept and training resumed from it, on the
  same batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.expressions import hash_unit
from ontime.session import scratch_path


@dataclass(frozen=True)
class Optimiser:
    """Adam with bias correction; ``beta1 = beta2 = None`` is plain gradient descent."""
    rate: float = 1e-3
    beta1: float | None = 0.9
    beta2: float | None = 0.999
    epsilon: float = 1e-8


@dataclass(frozen=True)
class State:
    """Training state after ``step`` steps: weights (intercept last) and both moment vectors."""
    step: int
    weights: tuple[float, ...]
    first: tuple[float, ...]
    second: tuple[float, ...]


@dataclass(frozen=True)
class Batches:
    """A written train set: standardised features ``x0, x1 ...``, label ``y``, partitioned by ``batch``."""
    path: str
    features: tuple[str, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    count: int
    sizes: dict[int, int] = field(default_factory=dict)

    def rows(self, spark: SparkSession) -> DataFrame:
        columns = [f"x{i} double" for i in range(len(self.features))]
        return spark.read.schema(", ".join([*columns, "y double", "batch int"])).parquet(self.path)


def deal_batches(df: DataFrame, features: list[str], label: str, keys: list[str], batches: int,
                 standardise: bool = True) -> Batches:
    """Write ``df`` as mini-batches by key hash.

    Rows with a null or NaN feature or label are left out.  Scaling is to mean
    0 and population standard deviation 1 (a constant feature becomes 0).
    Equal keys share a batch; an empty batch is passed over in training.
    """
    spark = df.sparkSession
    numbers = [F.col(c).cast("double") for c in [*features, label]]
    named = [f"x{i}" for i in range(len(features))] + ["y"]
    rows = df.select(*[c.alias(n) for c, n in zip(numbers, named, strict=True)],
                     F.pmod(hash_unit(*keys), F.lit(batches)).cast("int").alias("batch"))
    rows = rows.filter(" AND ".join(f"{n} IS NOT NULL AND NOT isnan({n})" for n in named))
    centre, scale = [0.0] * len(features), [1.0] * len(features)
    if standardise and features:
        stats = rows.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in named[:-1] for f in (F.avg, F.stddev_pop)]).first()
        centre = [stats[f"avg_{n}"] or 0.0 for n in named[:-1]]
        scale = [stats[f"stddev_pop_{n}"] or 1.0 for n in named[:-1]]
        rows = rows.select(*[((F.col(n) - F.lit(m)) / F.lit(s)).alias(n)
                             for n, m, s in zip(named, centre, scale, strict=False)], "y", "batch")
    path = scratch_path(spark, "batches")
    # Rebalanced by batch: AQE sizes the files from the data, however many rows a batch holds.
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    out = Batches(path, tuple(features), tuple(centre), tuple(scale), batches)
    sizes = {r["batch"]: r["count"] for r in out.rows(spark).groupBy("batch").count().collect()}  # one row a batch
    return replace(out, sizes=sizes)


def _error(features: int, weights: tuple[float, ...]) -> Column:
    w = F.array(*[F.lit(float(v)) for v in weights])
    guess = F.get(w, F.lit(features))
    for i in range(features):
        guess = guess + F.get(w, F.lit(i)) * F.col(f"x{i}")
    return guess - F.col("y")


def loss_and_gradient(rows: DataFrame, features: int, weights: tuple[float, ...]) -> tuple[int, float, list[float]]:
    """(rows, mean squared error, its gradient) of standardised rows in one aggregate; intercept last."""
    rows = rows.withColumn("e", _error(features, weights))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") * F.col("e")).alias("sse"), F.sum("e").alias("g"),
                    *[F.sum(F.col("e") * F.col(f"x{i}")).alias(f"g{i}") for i in range(features)]).first()
    n = sums["n"]
    if not n:
        return 0, math.nan, [0.0] * (features + 1)
    return n, sums["sse"] / n, [2.0 * sums[f"g{i}"] / n for i in range(features)] + [2.0 * sums["g"] / n]


def advance(state: State, gradient: list[float], opt: Optimiser) -> State:
    """The state after one step along ``gradient``."""
    t = state.step + 1
    if opt.beta1 is None or opt.beta2 is None:
        return State(t, tuple(w - opt.rate * g for w, g in zip(state.weights, gradient, strict=True)), state.first, state.second)
    first = tuple(opt.beta1 * m + (1 - opt.beta1) * g for m, g in zip(state.first, gradient, strict=True))
    second = tuple(opt.beta2 * v + (1 - opt.beta2) * g * g for v, g in zip(state.second, gradient, strict=True))
    m_scale, v_scale = 1 - opt.beta1 ** t, 1 - opt.beta2 ** t
    weights = tuple(w - opt.rate * (m / m_scale) / (math.sqrt(v / v_scale) + opt.epsilon)
                    for w, m, v in zip(state.weights, first, second, strict=True))
    return State(t, weights, first, second)


@dataclass(frozen=True)
class LinearLayer:
    """A trained layer: its state and its trace (step, epoch, batch, n, loss before the step, weights after it)."""
    batches: Batches
    state: State
    trace: list[tuple[int, int, int, int, float, list[float]]]

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.trace, "step int, epoch int, batch int, n bigint, loss double, weights array<double>")

    def epoch_losses(self) -> list[tuple[int, float]]:
        """(epoch, mean loss of its rows, each taken before the step on its batch)."""
        out: dict[int, list[float]] = {}
        for _, epoch, _, n, loss, _ in self.trace:
            total = out.setdefault(epoch, [0.0, 0.0])
            total[0] += loss * n
            total[1] += n
        return [(epoch, s / n) for epoch, (s, n) in sorted(out.items())]

    def prediction(self) -> Column:
        """The layer as a column over the original features; null where a feature is."""
        b, w = self.batches, self.state.weights
        guess = F.lit(w[-1])
        for name, m, s, v in zip(b.features, b.centre, b.scale, w, strict=False):
            guess = guess + F.lit(v) * ((F.col(name).cast("double") - F.lit(m)) / F.lit(s))
        return guess


def train_linear(spark: SparkSession, batches: Batches, epochs: int = 1, opt: Optimiser | None = None,
                 state: State | None = None) -> LinearLayer:
    """Train until ``epochs`` epochs are done, from zero weights or from a kept ``state``.

    Batches follow each other in number order in each epoch, so a run resumed
    in the middle takes the same steps.  A train set without rows takes none.
    """
    opt, p = opt or Optimiser(), len(batches.features)
    zeros = (0.0,) * (p + 1)
    state = state or State(0, zeros, zeros, zeros)
    order = sorted(b for b, n in batches.sizes.items() if n)
    rows, trace = batches.rows(spark), []
    for step in range(state.step, epochs * len(order)):
        batch = order[step % len(order)]
        n, loss, gradient = loss_and_gradient(rows.filter(F.col("batch") == batch), p, state.weights)
        state = advance(state, gradient, opt)
        trace.append((state.step, step // len(order) + 1, batch, n, loss, list(state.weights)))
    return LinearLayer(batches, state, trace)


def squared_loss_gradient(df: DataFrame, features: list[str], label: str, weights: list[float], intercept: float,
                          reg_param: float = 0.0) -> DataFrame:
    """(component, gradient): slope of Spark ML's penalised squared loss at given weights, one aggregate after the moments.

    The loss is ``mean((y - xw - b)^2) / 2 + reg_param / (2 sd(y)) sum((sd_j w_j)^2)`` with population deviations,
    each component in units of its feature's and the label's deviation: all are 0 at the optimum.
    """
    moments = df.agg(F.struct(*[F.stddev_pop(c).alias(c) for c in [*features, label]]).alias("spread"),
                     F.struct(*[F.avg(c).alias(c) for c in features]).alias("means")).first()
    spread, means = moments["spread"], moments["means"]
    sd_y = spread[label] or 1.0
    error = F.col(label) - F.lit(float(intercept))
    for c, w in zip(features, weights, strict=True):
        error = error - F.lit(float(w)) * F.col(c)
    parts = []
    for c, w in zip(features, weights, strict=True):
        sd = spread[c] or 1.0
        slope = -F.avg(F.col("_e") * (F.col(c) - F.lit(means[c]))) / F.lit(sd * sd_y)
        parts.append(F.struct(F.lit(c).alias("component"), (slope + F.lit(reg_param / sd_y * sd * w / sd_y)).alias("gradient")))
    parts.append(F.struct(F.lit("intercept").alias("component"), (-F.avg("_e") / F.lit(sd_y)).alias("gradient")))
    return df.withColumn("_e", error).agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def logistic_loss_gradient(df: DataFrame, features: list[str], label: str, weights: list[float], intercept: float,
                           weight_column: str | None = None) -> DataFrame:
    """(component, gradient): slope of the weighted mean logistic loss, each component in units of its feature's deviation."""
    w = F.col(weight_column) if weight_column else F.lit(1.0)
    spread = df.agg(*[F.stddev_pop(c).alias(c) for c in features]).first()
    score = F.lit(float(intercept))
    for c, v in zip(features, weights, strict=True):
        score = score + F.lit(float(v)) * F.col(c)
    rows = df.withColumns({"_w": w, "_e": F.lit(1.0) / (F.lit(1.0) + F.exp(-score)) - F.col(label)})
    total = F.sum("_w")
    parts = [F.struct(F.lit(c).alias("component"),
                      (F.sum(F.col("_w") * F.col("_e") * F.col(c)) / total / F.lit(spread[c] or 1.0)).alias("gradient"))
             for c in features]
    parts.append(F.struct(F.lit("intercept").alias("component"), (F.sum(F.col("_w") * F.col("_e")) / total).alias("gradient")))
    return rows.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
