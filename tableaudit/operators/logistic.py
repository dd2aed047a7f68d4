"""Logistic regression by trust-region Newton steps, with a certificate of the optimum.

For ``f(w, b) = |w|^2 / 2 + strength * sum(log loss)`` every point that the steps reach
is a sum of the training rows, ``w = X' u``.  So the driver keeps ``u``, a number per
row, and never a number per feature: the solver only asks for ``X X' v``.  The entries
of ``X`` lie in blocks of whole columns that stay cached on the executors, and such a
product is one job, a pass.  Its sums are added up by ranges of rows: a task sends only
the rows that its columns reach, so at most about a number per entry, and the driver gets
a number per row.  What a pass moves thus grows with the entries and no faster.
No matrix of rows by rows or of columns by columns is ever built.  The weights are summed
by column once at the end.

Any ``u`` gives a feasible point of the dual problem, and the difference of both
objectives bounds how far ``f`` is from its minimum.  The fit stops when that bound is
small, and reports it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged_alone

BLOCK_CELLS = 1 << 18
# A task has several blocks, unless all cores would not get a quarter of one.
TASK_BLOCKS = 8
# Rows whose sums are added up together.
RANGE_ROWS, LEAST_RANGE_ROWS = 1 << 17, 1 << 12


@dataclass(frozen=True)
class Fit:
    """Dual numbers by row and intercept, the passes used, the objective, and the bound on its distance from the minimum."""

    dual: np.ndarray
    intercept: float
    passes: int
    objective: float
    gap: float
    weights: np.ndarray | None = None


@dataclass(frozen=True)
class Blocks:
    """Training rows: their numbers in order, labels, entries ``(row, column, value)`` and cached column blocks."""

    numbers: np.ndarray
    labels: np.ndarray
    entries: DataFrame
    cells: RDD

    def weights(self, dual: np.ndarray) -> DataFrame:
        """``(column, n, weight)``: rows with an entry, and the sum of the dual numbers times the entries."""
        sent = self.cells.context.broadcast((self.numbers, dual))

        def pulled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers, duals = sent.value
                given = duals[np.searchsorted(numbers, batch.column("row").to_numpy())]
                pulls = pa.array(batch.column("value").to_numpy() * given)
                yield pa.RecordBatch.from_arrays([batch.column("column"), pulls], names=["column", "pull"])

        schema = T.StructType([self.entries.schema["column"], T.StructField("pull", T.DoubleType())])
        pulls = self.entries.select("column", "row", "value").mapInArrow(pulled, schema)
        return pulls.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum("pull").alias("weight"))

    def release(self) -> None:
        self.cells.unpersist()


def numbered(df: DataFrame, purpose: str) -> DataFrame:
    """The rows with a number ``row``, written once so that a recomputed task finds the same numbers."""
    return staged_alone(df.withColumn("row", F.monotonically_increasing_id()), purpose)


def _drop_shuffles(rdd: RDD) -> None:
    """Shuffle files below an RDD go now, not when the driver happens to collect its garbage; they can be made again."""
    rdd._jrdd.rdd().cleanShuffleDependencies(False)


def column_blocks(rows: DataFrame, entries: DataFrame) -> Blocks:
    """Blocks of the written ``entries`` (row, column, value) of the written ``rows`` (row, label)."""
    known = rows.select("row", F.col("label").cast("double").alias("label")).toArrow().sort_by("row")
    numbers, labels = (known.column(name).to_numpy() for name in ("row", "label"))
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(numbers)
    most, size = BLOCK_CELLS, entries.count()
    # The fewer tasks, the fewer rows are reached by several of them.
    tasks = max(1, -(-size // (most * TASK_BLOCKS)), min(context.defaultParallelism, 4 * size // most))

    def block(part: pa.Table) -> pa.RecordBatch:
        codes = part.column("column").combine_chunks().dictionary_encode().indices.to_numpy()
        places, rows = np.unique(np.searchsorted(sent.value, part.column("row").to_numpy()), return_inverse=True)
        arrays = (codes, rows.astype(np.int32), part.column("value").to_numpy(), places.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in arrays], names=["columns", "rows", "values", "places"]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < most:
                continue
            # Whole columns only: the last one may go on in the next batch.
            part = pa.Table.from_batches(held)
            codes = part.column("column").combine_chunks().dictionary_encode().indices.to_numpy()
            end = int(np.searchsorted(codes, codes[-1]))
            if end:
                yield block(part.slice(0, end))
            held, n = part.slice(end).to_batches(), part.num_rows - end
        if n:
            yield block(pa.Table.from_batches(held))

    def unpack(row):
        kinds = (np.int32, np.int32, np.float64, np.int32)
        return tuple(np.frombuffer(cell, kind) for cell, kind in zip(row, kinds, strict=True))

    # No column holds more entries than there are training rows.
    dealt = entries.select("column", "row", "value").repartition(tasks, "column").sortWithinPartitions("column")
    packed = dealt.mapInArrow(pack, "columns binary, rows binary, values binary, places binary")
    cells = packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    cells.count()
    _drop_shuffles(cells)
    return Blocks(numbers, labels, entries, cells)


def sparse_blocks(df: DataFrame, features: str, label: str) -> Blocks:
    """Cached blocks of a sparse vector column."""
    vector = F.unwrap_udt(F.col(features))
    rows = numbered(
        df.select(F.col(label).alias("label"), vector["indices"].alias("columns"), vector["values"].alias("values")),
        "training-rows",
    )
    pairs = rows.select("row", F.explode(F.arrays_zip("columns", "values")).alias("e"))
    entries = pairs.select("row", F.col("e.columns").alias("column"), F.col("e.values").alias("value"))
    return column_blocks(rows, entries)


class _Passes:
    """Products with ``X X'``, counting the passes."""

    def __init__(self, blocks: Blocks) -> None:
        self.blocks, self.used = blocks.cells, 0

    def product(self, v: np.ndarray) -> np.ndarray:
        """``X X' v``; the vector reaches each executor once, and comes back as one number per row."""
        self.used += 1
        context = self.blocks.context
        ranges = max(-(-len(v) // RANGE_ROWS), min(context.defaultParallelism, len(v) // LEAST_RANGE_ROWS), 1)
        ends = [len(v) * i // ranges for i in range(ranges + 1)]
        sent = context.broadcast(v)

        def part(task: int, blocks: Iterator) -> Iterator:
            given, out = sent.value, None
            for columns, rows, values, places in blocks:
                sums = np.bincount(columns, weights=values * given[places][rows])
                out = np.zeros(len(given)) if out is None else out
                # A block has each of its rows once in ``places``; its time does not grow with the other rows.
                out[places] += np.bincount(rows, weights=values * sums[columns])
            for r in range(ranges if out is not None else 0):
                some = out[ends[r] : ends[r + 1]]
                reached = np.flatnonzero(some)
                # A place takes half as much as a number.
                if 3 * len(reached) < 2 * len(some):
                    yield r, (task, reached.astype(np.int32), some[reached])
                else:
                    yield r, (task, None, some)

        def total(messages: Iterator) -> Iterator:
            by_range: dict = {}
            for r, message in messages:
                by_range.setdefault(r, []).append(message)
            for r, found in by_range.items():
                out = np.zeros(ends[r + 1] - ends[r])
                # In one order, so that the sums do not depend on what came first.
                for _, places, some in sorted(found, key=lambda message: message[0]):
                    out[slice(None) if places is None else places] += some
                yield r, out

        summed = self.blocks.mapPartitionsWithIndex(part).partitionBy(ranges, int).mapPartitions(total)
        try:
            out = np.zeros(len(v))
            for r, some in summed.collect():
                out[ends[r] : ends[r + 1]] = some
            return out
        finally:
            sent.destroy()
            _drop_shuffles(summed)


@dataclass(frozen=True)
class _Way:
    """A direction: numbers by row, their product with ``X X'``, and the part of the intercept."""

    u: np.ndarray
    z: np.ndarray
    b: float

    def __add__(self, other: _Way) -> _Way:
        return _Way(self.u + other.u, self.z + other.z, self.b + other.b)

    def __mul__(self, by: float) -> _Way:
        return _Way(self.u * by, self.z * by, self.b * by)

    def dot(self, other: _Way) -> float:
        """The inner product of the weights and intercepts that both stand for."""
        return float(self.u @ other.z) + self.b * other.b


class _Point:
    """The objective, its gradient and what the certificate needs at one place."""

    def __init__(self, x: _Way, signs: np.ndarray, passes: _Passes, strength: float) -> None:
        self.x, self.signs, self.strength = x, signs, strength
        signed = signs * (x.z + x.b)
        self.away = 1 / (1 + np.exp(np.clip(signed, -700, 700)))
        self.value = 0.5 * float(x.u @ x.z) + strength * float(np.logaddexp(0, -signed).sum())
        self.curve = strength * self.away * (1 - self.away)
        pull = strength * signs * self.away
        self.slope = _Way(x.u - pull, x.z - passes.product(pull), -float(pull.sum()))
        # The intercept has no penalty and all rows pull at it: a scale of its own for the inner steps.
        self.scale = max(float(self.curve.sum()), 1e-12)

    def scaled(self, way: _Way) -> _Way:
        return replace(way, b=way.b / self.scale)

    def norm(self, way: _Way) -> float:
        return float(np.sqrt(max(float(way.u @ way.z) + self.scale * way.b * way.b, 0.0)))

    def bent(self, way: _Way, passes: _Passes) -> _Way:
        """The Hessian times a direction."""
        turned = self.curve * (way.z + way.b)
        return _Way(way.u + turned, way.z + passes.product(turned), float(turned.sum()))

    def gap(self, passes: _Passes) -> float:
        """Objective less the dual objective of the residuals, scaled so that both classes weigh the same."""
        one = self.signs > 0
        sums = [float(self.away[one].sum()), float(self.away[~one].sum())]
        scale = [min(sums) / s if s > 0 else 0.0 for s in sums]
        a = np.clip(self.away * np.where(one, *scale), 1e-300, 1 - 1e-16)
        u = self.strength * self.signs * a
        entropy = -float((a * np.log(a) + (1 - a) * np.log1p(-a)).sum())
        return self.value - (self.strength * entropy - 0.5 * float(u @ passes.product(u)))


def _inner(point: _Point, radius: float, passes: _Passes, most: int) -> tuple[_Way, _Way]:
    """A step within the radius by conjugate gradients, and the Hessian times that step."""
    step = turned = point.slope * 0.0
    rest = point.slope * -1.0
    along = point.scaled(rest)
    size = rest.dot(along)
    # The nearer the optimum, the more exact the step.
    enough = min(0.1, max(size, 0.0) ** 0.25) ** 2 * size
    while size > enough and passes.used < most:
        bent = point.bent(along, passes)
        length = size / along.dot(bent)
        if point.norm(step + along * length) >= radius:
            # To the border and no further.
            a, c = point.norm(along) ** 2, point.norm(step) ** 2 - radius**2
            b = 2 * (float(step.u @ along.z) + point.scale * step.b * along.b)
            length = (-b + np.sqrt(b * b - 4 * a * c)) / (2 * a)
            return step + along * length, turned + bent * length
        step, turned, rest = step + along * length, turned + bent * length, rest + bent * -length
        scaled = point.scaled(rest)
        size, before = rest.dot(scaled), size
        along = scaled + along * (size / before)
    return step, turned


def fit_rows(blocks: Blocks, strength: float = 1.0, max_passes: int = 200, tolerance: float = 1e-10) -> Fit:
    """Minimise the penalised log loss; the intercept carries no penalty.

    Ends when the certified gap is at most ``tolerance`` of the objective (of 1, if
    that is less), or after ``max_passes`` passes.  Both classes must be there.
    """
    if not len(blocks.labels):
        raise ValueError("there are no training rows")
    signs = np.where(blocks.labels > 0, 1.0, -1.0)
    if abs(signs.sum()) == len(signs):
        raise ValueError("the training rows need both classes")
    passes = _Passes(blocks)
    none = np.zeros(len(signs))
    point = _Point(_Way(none, none, 0.0), signs, passes, strength)
    radius, gap = point.norm(point.scaled(point.slope)), float("inf")
    while passes.used < max_passes:
        bound = tolerance * max(1.0, point.value)
        # The squared slope is a cheap sign that the certificate is worth a pass.
        if 0.5 * point.slope.dot(point.slope) <= bound:
            gap = point.gap(passes)
            if gap <= bound:
                break
        step, turned = _inner(point, radius, passes, max_passes - 2)
        hoped = -point.slope.dot(step) - 0.5 * step.dot(turned)
        if hoped <= 0 or passes.used >= max_passes:
            break
        trial = _Point(point.x + step, signs, passes, strength)
        share = (point.value - trial.value) / hoped
        size = point.norm(step)
        # Below the rounding of the objective the share says nothing; the slope does.
        fine = hoped < 1e-12 * max(1.0, abs(point.value))
        better = share > 1e-4 or (fine and trial.slope.dot(trial.slope) < point.slope.dot(point.slope))
        if not better:
            radius = 0.25 * size
            if fine:
                break
            continue
        if share > 0.75:
            radius = max(radius, 2 * size)
        elif share < 0.25:
            radius = 0.5 * size
        point = trial
    if gap == float("inf") or passes.used < max_passes:
        gap = point.gap(passes)
    return Fit(point.x.u, point.x.b, passes.used, point.value, max(gap, 0.0))


def fit_blocks(
    blocks: Blocks, n_features: int, strength: float = 1.0, max_passes: int = 200, tolerance: float = 1e-10
) -> Fit:
    """``fit_rows`` with the weights of features that are numbered from 0 to ``n_features``, fetched."""
    fit = fit_rows(blocks, strength, max_passes, tolerance)
    found, weights = blocks.weights(fit.dual).toArrow(), np.zeros(n_features)
    weights[found.column("column").to_numpy()] = found.column("weight").to_numpy()
    return replace(fit, weights=weights)


class LogisticModel(Model):
    """Adds ``log_odds`` and ``score``; ``fitted`` says how good the weights are."""

    def __init__(self, fit: Fit | None = None, features: str = "features") -> None:
        super().__init__()
        self.fitted, self.features = fit, features

    @property
    def coefficients(self) -> np.ndarray:
        return self.fitted.weights

    @property
    def intercept(self) -> float:
        return self.fitted.intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        weights = spark.sparkContext.broadcast(self.fitted.weights)
        intercept = self.fitted.intercept

        # Defined inside, so that it travels to the workers by value.
        def log_odds(cells: pa.Array) -> pa.Array:
            columns, values = (cells.field(name) for name in ("indices", "values"))
            sizes = np.asarray(columns.value_lengths().fill_null(0))
            rows = np.repeat(np.arange(len(cells)), sizes)
            z = np.bincount(
                rows,
                weights=np.asarray(values.flatten()) * weights.value[np.asarray(columns.flatten())],
                minlength=len(cells),
            )
            return pa.array(z + intercept, pa.float64())

        vector = F.unwrap_udt(F.col(self.features))
        found = dataset.withColumn("log_odds", F.arrow_udf(log_odds, "double")(vector))
        return found.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("log_odds"))))


class LogisticNewton(Estimator):
    """The estimator over a sparse vector column and a 0/1 label."""

    def __init__(
        self,
        strength: float = 1.0,
        max_passes: int = 200,
        tolerance: float = 1e-10,
        features: str = "features",
        label: str = "label",
    ) -> None:
        super().__init__()
        self.strength, self.max_passes, self.tolerance = strength, max_passes, tolerance
        self.features, self.label = features, label

    def _fit(self, dataset: DataFrame) -> LogisticModel:
        sizes = dataset.agg(F.max(F.unwrap_udt(F.col(self.features))["size"])).first()[0]
        if sizes is None:
            raise ValueError("there are no training rows")
        blocks = sparse_blocks(dataset, self.features, self.label)
        try:
            fit = fit_blocks(blocks, sizes, self.strength, self.max_passes, self.tolerance)
        finally:
            blocks.release()
        return LogisticModel(fit, self.features)
