"""Operator 11: whitening of embeddings by the eigenvectors of their covariance.

Entries become whole numbers, so that sums and centred rows are exact. The covariance is the Gramian of the centred distinct rows (MLlib's RowMatrix)
over their number; its eigenvectors are found on the driver, which holds a square of the dimension and no rows, and sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import materialize, tidy

SCALE = 256
#: An eigenvalue below this share of the largest counts as none.
LEAST = 1e-12
#: Whole numbers that a long holds with room for one more sum.
SAFE = 1 << 62


@dataclass
class Whitening:
    """n distinct rows with exact sums; values: eigenvalues, falling; directions: a unit eigenvector in each row; error: as measured over the whitened rows."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: longs, or whole numbers of any size where those could overflow."""
        most = max(map(abs, self.sums), default=0)
        far = int(np.abs(x.astype(np.float64)).max(initial=0)) * self.n + most
        return x * self.n - np.array(self.sums, np.int64) if far < SAFE else x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """Sums of squares of centred rows; None where a long can't hold one."""
        if z.dtype != object and float(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < SAFE:
            return (z * z).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in z]
        return [v if v < 1 << 63 else None for v in exact]

    def whiten(self, z: np.ndarray, most: int) -> np.ndarray:
        """Centred rows projected on the first components over their deviation; not a number along components without any."""
        values = self.values[:most]
        scale = np.sqrt(np.where(self._some(values), values, np.nan))
        return (z / self.n).astype(np.float64) @ self.directions[:most].T / scale

    def _some(self, values: np.ndarray) -> np.ndarray:
        return values > LEAST * max(float(self.values[0]), 0.0)

    def live(self) -> int:
        """Components along which the rows differ."""
        return int(self._some(self.values).sum())

    def explained(self) -> np.ndarray:
        """Share of each component in the trace; 0 where all rows are equal."""
        return np.maximum(self.values, 0) / max(float(self.values.sum()), np.finfo(float).tiny)


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id (as text), x (array<long>): entries times SCALE, rounded down, of rows whose entries are all finite and whose x fits longs."""
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) * SCALE < float(1 << 63), F.lit(False))
    kept = vectors.where(F.col(vec_col).isNotNull() & F.forall(vec_col, fits))
    return kept.select(F.col(id_col).cast("string").alias("id"), F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension; each task hands on one row for a dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * size, 0
        for batch in batches:
            x = _matrix(batch.column(0), size)
            high, low = x >> 32, x & 0xFFFFFFFF  # halves, whose sums fit longs
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high.sum(0), low.sum(0), strict=True)]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([*range(size), -1]), pa.array([str(t) for t in (*total, n)])], names=["k", "total"])

    rows = fit.mapInArrow(tidy(add), "k long, total string").groupBy("k").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {r.k: int(r.total) for r in rows}
    return found.pop(-1, 0), [found.get(k, 0) for k in range(size)]


def _gramian(rows: DataFrame, n: int, size: int) -> np.ndarray:
    """Gramian of rows (v: array<double>) over n."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector("v").alias("v")), "v")
    return RowMatrix(vectors, n, size).computeGramianMatrix().toArray() / n


def _rows_of(fit: DataFrame, model: Whitening, size: int, most: int | None) -> DataFrame:
    """v: centred rows of the fit list, whitened along the first components if most says so."""
    sent = fit.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            z = m.centred(_matrix(batch.column(0), size))
            made = (z / m.n).astype(np.float64) if most is None else m.whiten(z, most)
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), made.shape[1]).cast(pa.list_(pa.float64()))], names=["v"])

    return fit.mapInArrow(tidy(run), "v array<double>")


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of rows (x), each distinct x counted once; None without rows. Equal rows meet in partial aggregates. Every x must have one size."""
    first = rows.first()
    if first is None or not first.x:
        return None
    size = len(first.x)
    distinct = materialize(rows.select("x").distinct(), "fit")
    n, sums = _sums(distinct, size)
    model = Whitening(n, sums, np.zeros(size), np.eye(size))
    values, vectors = np.linalg.eigh(_gramian(_rows_of(distinct, model, size, None), n, size))
    by = np.argsort(-values, kind="stable")
    directions = vectors[:, by].T
    at = np.abs(directions).argmax(1)  # the largest entry of each is positive
    model.values, model.directions = values[by], directions * np.sign(directions[np.arange(size), at])[:, None]
    live = model.live()
    if live:
        model.error = float(np.abs(_gramian(_rows_of(distinct, model, size, live), n, live) - np.eye(live)).max())
    return model


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int | None = None) -> tuple[DataFrame, Whitening | None]:
    """(id_col, deviation, whitened, an array along the first components, all of them where most is None) for every usable row, and what was fitted.

    Rows whose vector is null, has an entry that is null or not finite, or whose size isn't the most common one (of equally common sizes the least; empty
    vectors have none) are left out, as are entries too large for a long. Repeated rows and ids are all returned, with equal values; each distinct vector counts once in the fit.
    Null ids stay. A component along which no rows differ gives null; a deviation too large for a long is null. An empty table gives an empty result. Other
    columns aren't read.
    """
    kind = vectors.schema[id_col].dataType
    rows = whole_numbers(vectors, id_col, vec_col).where(F.size("x") > 0)
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("x") == (sizes.size if sizes else 0))
    model = fit(rows)
    size = sizes.size if sizes else 0
    k = min(most or size, size)
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for frame in frames:
            if len(frame):
                z = m.centred(np.stack(frame["x"].to_numpy()))
                made = m.whiten(z, k)
                dead = np.isnan(made)
                white = [[None if d else v for v, d in zip(row, gone, strict=True)] for row, gone in zip(made.tolist(), dead, strict=True)] if dead.any() else list(made)
                yield pd.DataFrame({"id": frame["id"], "deviation": pd.array(m.deviations(z), dtype="Int64"), "whitened": white})

    out = rows.mapInPandas(run, "id string, deviation long, whitened array<double>")
    return out.select(F.col("id").cast(kind).alias(id_col), "deviation", "whitened"), model
