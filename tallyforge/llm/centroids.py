"""k-means over whole numbers, each vector's centroid found by annulus search.

The centroids are sorted by norm. A vector of norm r first meets the centroid whose norm is nearest to r
(binary search); that distance u is its upper bound, and by the triangle inequality only centroids with
norms in the annulus [r - u, r + u] can be as near. From the first one outwards on both sides, those are
compared exactly, and u shrinks with every better one. The annulus is widened by more than the rounding of
norms, so a centroid on its border, which may tie, is always compared; distances are exact 64-bit integers.

A round is one pass over the vectors: tasks send sums per centroid and component, the combined sums
(``k`` times ``width`` rows, whatever the input) come to the driver, and the new centroids go out with the
next pass. No vector is shuffled, and a lost executor costs its tasks only.

Defined cases: a vector that is null, of another width, or with a null or non-finite component is left
out; |256 * x| is taken as 2**27 at most, so that distances fit in a long; repeated rows count each by
itself; rows without an id are clustered, but follow all others as first centroids; of equal ids the
smaller vector comes first; fewer kept vectors than ``k``: one centroid for each; none: no centroids and no
assignments; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, LARGEST = 256, 1 << 27


def whole_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors): the places of the valid vectors in an Arrow list column, and floor(256 * x) of each."""
    full = column.filter(pa.array(valid := column.is_valid().to_numpy(zero_copy_only=False)))
    lengths = full.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = full.flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    fits = lengths == width
    x = x[np.repeat(fits, lengths)].reshape(-1, width)
    finite = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        v = np.clip(np.floor(SCALE * x[finite]), -LARGEST, LARGEST).astype(np.int64)
    return np.flatnonzero(valid)[fits][finite], v


class Annuli:
    """Centroids sorted by norm."""

    def __init__(self, centroids: np.ndarray):
        norms = np.sqrt((centroids.astype(np.float64) ** 2).sum(axis=1))
        self.number = np.argsort(norms, kind="stable")
        self.norms, self.centroids = norms[self.number], centroids[self.number]

    def distance(self, x: np.ndarray, place: np.ndarray) -> np.ndarray:
        d = x - self.centroids[place]
        return np.einsum("ij,ij->i", d, d)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each vector's nearest centroid, the smaller number of equal ones; comparisons made."""
        r = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        after = np.searchsorted(self.norms, r)
        before = np.maximum(after - 1, 0)
        after = np.minimum(after, len(self.norms) - 1)
        first = np.where(r - self.norms[before] <= self.norms[after] - r, before, after)
        best, number, compared = self.distance(x, first), self.number[first], len(x)
        slack = 1e-9 * (1 + r)
        for step in (-1, 1):
            rows, place = np.arange(len(x)), first + step
            while True:
                there = (place >= 0) & (place < len(self.norms))
                rows, place = rows[there], place[there]
                u = np.sqrt(best[rows].astype(np.float64))
                near = np.abs(self.norms[place] - r[rows]) <= u * (1 + 1e-9) + slack[rows]
                rows, place = rows[near], place[near]
                if not len(rows):
                    break
                d, n = self.distance(x[rows], place), self.number[place]
                less = (d < best[rows]) | ((d == best[rows]) & (n < number[rows]))
                best[rows[less]], number[rows[less]] = d[less], n[less]
                compared += len(rows)
                place = place + step
        return number, best, compared


def first_centroids(vectors: DataFrame, k: int, salt: str, width: int) -> np.ndarray:
    """The ``k`` kept vectors with the smallest sha256 of ``salt`` and id, in that order."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, v = whole_vectors(batch.column(1), width)
            ends = pa.array(np.arange(0, v.size + 1, width, dtype=np.int32))
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], ["hash", "v"])

    hashed = vectors.select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256).alias("hash"), "embedding")
    top = hashed.mapInArrow(keep, "hash string, v array<long>").orderBy(F.col("hash").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in top], np.int64).reshape(-1, width)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the exact floor of its vectors' means."""
    k, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annuli, total, count = Annuli(centroids), np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            _, v = whole_vectors(batch.column(0), width)
            number, _, _ = annuli.nearest(v)
            np.add.at(total, number, v)
            count += np.bincount(number, minlength=k)
        at = np.repeat(np.arange(k, dtype=np.int32), width)
        full = count[at] > 0
        yield pa.record_batch([pa.array(c[full]) for c in (at, np.tile(np.arange(width, dtype=np.int32), k), total.ravel(), count[at])], ["cluster", "component", "total", "n"])

    parts = vectors.select("embedding").mapInArrow(sums, "cluster int, component int, total long, n long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every kept vector; nothing where there are no centroids."""
    if not len(centroids):
        return vectors.select(F.col("vec_id").cast("long"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where(F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annuli = Annuli(centroids)
        for batch in batches:
            rows, v = whole_vectors(batch.column(1), centroids.shape[1])
            number, best, _ = annuli.nearest(v)
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2:", width: int = 64) -> np.ndarray:
    """The centroids after ``rounds`` rounds, by number. ``vectors``: vec_id, embedding."""
    centroids = first_centroids(vectors, k, salt, width)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def inertias(found: DataFrame) -> dict[int, int]:
    """Sum of distances per cluster that has vectors (``k`` rows at most)."""
    return {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
