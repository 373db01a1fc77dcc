"""Mergeable co-moments of columns with gaps: the numbers behind all pairwise correlations.

For each pair of columns, over the rows that know both: their count, both means, both sums
of squares around these means, and the sum of products around them. A batch of rows gives
all pairs by a few matrix products; two batches, tasks or tables are merged by the pairwise
update, which adds what lies between their means and never subtracts large numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A pair whose squares around its own mean are less than this share of its squares around
# the batch's column mean has lost digits, and is summed again from the batch at hand.
LOST = 1e-4
TILE = 32
PANEL = 512  # columns; a task holds six matrices of this many rows and columns
CELLS = 1 << 20  # of a batch that are worked on at once
SALTS = 64


class CoMoments:
    """Of pairs (i, j): rows ``n``, means ``m`` of i and ``w`` of j, squares ``c`` of i and ``d``
    of j, and products ``p``."""

    def __init__(self, columns: int) -> None:
        self.n, self.m, self.w, self.c, self.d, self.p = (np.zeros((columns, columns)) for _ in range(6))

    @classmethod
    def of_batch(cls, x: np.ndarray) -> "CoMoments":
        """All pairs of the columns of ``x``; NaN is a gap."""
        self = cls.__new__(cls)
        known, wild = ~np.isnan(x), np.isinf(x)
        plain = known & ~wild
        clean = np.where(plain, x, 0.0)
        low = np.where(plain, x, np.inf).min(axis=0, initial=np.inf)
        high = np.where(plain, x, -np.inf).max(axis=0, initial=-np.inf)
        count = np.maximum(plain.sum(axis=0), 1)
        # Halved, as the sum of the two largest doubles is none.
        shift = np.where(low == high, low, 2.0 * (clean / 2.0 / count).sum(axis=0))
        shift = np.where(np.isfinite(shift), shift, 0.0)
        y = np.where(plain, x - shift, 0.0)
        k = known.astype(float)
        self.n = k.T @ k
        with np.errstate(all="ignore"):
            share = 1.0 / np.maximum(self.n, 1.0)
            s, sq = y.T @ k, (y * y).T @ k
            mean = s * share
            self.m = shift[:, None] + mean
            self.w = self.m.T.copy()
            self.c = sq - s * mean
            self.p = y.T @ y - s * mean.T
            lost = (self.n > 1) & (sq > 0) & (self.c <= LOST * sq)
        lost |= lost.T
        for i, j in zip(*np.nonzero(np.triu(lost))):
            both = plain[:, i] & plain[:, j]
            self._again(int(i), int(j), x[both, i], x[both, j])
        self.d = self.c.T.copy()
        if wild.any():
            w = wild.astype(float)
            broken = (w.T @ k + k.T @ w) > 0
            for a in (self.c, self.d, self.p):
                a[broken] = np.nan
        return self

    def _again(self, i: int, j: int, a: np.ndarray, b: np.ndarray) -> None:
        """The pair from its own rows, around their own means."""
        with np.errstate(all="ignore"):
            ma, mb = (v[0] if (v == v[0]).all() else v.mean() for v in (a, b))
            da, db = a - ma, b - mb
            self.m[i, j], self.m[j, i] = ma, mb
            self.w[j, i], self.w[i, j] = ma, mb
            self.c[i, j], self.c[j, i] = da @ da, db @ db
            self.p[i, j] = self.p[j, i] = da @ db

    def add(self, o: "CoMoments") -> None:
        """Merge another one into this."""
        with np.errstate(all="ignore"):
            n = self.n + o.n
            share = o.n / np.maximum(n, 1.0)
            x, y, both = o.m - self.m, o.w - self.w, self.n * share
            new = self.n == 0
            self.c += o.c + np.where(both > 0, x * x * both, 0.0)
            self.d += o.d + np.where(both > 0, y * y * both, 0.0)
            self.p += o.p + np.where(both > 0, x * y * both, 0.0)
            self.m = np.where(new, o.m, self.m + x * share)
            self.w = np.where(new, o.w, self.w + y * share)
            self.n = n

    def tile(self, a: slice, b: slice) -> np.ndarray:
        return np.stack([f[a, b] for f in (self.n, self.m, self.w, self.c, self.d, self.p)])

    @classmethod
    def of_tile(cls, fields: np.ndarray) -> "CoMoments":
        self = cls.__new__(cls)
        self.n, self.m, self.w, self.c, self.d, self.p = fields
        return self

    def r(self) -> np.ndarray:
        """Pearson's r; NaN where it is not defined."""
        with np.errstate(all="ignore"):
            r = self.p / (np.sqrt(self.c) * np.sqrt(self.d))
        sound = np.isfinite(self.c) & np.isfinite(self.d) & np.isfinite(r)
        return np.where(sound & (self.n > 1) & (self.c > 0) & (self.d > 0), r, np.nan)


def _tiles(begin: int, end: int) -> list[slice]:
    return [slice(a, min(end, a + TILE)) for a in range(begin, end, TILE)]


def _summed(wide: DataFrame, names: Sequence[str], at: Sequence[int], cross: int) -> DataFrame:
    """Co-moments of each task by tile: ti, tj, rows, columns, body.

    ``at`` are the numbers of the columns in the whole table. With ``cross`` only pairs of
    one of the first ``cross`` columns and one of the others are given.
    """
    tiles = [*_tiles(0, cross), *_tiles(cross, len(names))]
    limit = max(1, CELLS // max(1, len(names)))

    def wanted(a: slice, b: slice) -> bool:
        return a.start <= b.start and (not cross or (a.start < cross <= b.start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for r in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in r.columns]).astype(float, copy=False)
            for i in range(0, len(x), limit):
                part = CoMoments.of_batch(x[i : i + limit])
                if total is None:
                    total = part
                else:
                    total.add(part)
        total = total or CoMoments(len(names))
        pairs = [(a, b) for a in tiles for b in tiles if wanted(a, b)]
        ints = (
            [at[a.start] for a, _ in pairs], [at[b.start] for _, b in pairs],
            [a.stop - a.start for a, _ in pairs], [b.stop - b.start for _, b in pairs],
        )
        body = pa.array([total.tile(a, b).tobytes() for a, b in pairs], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int32()) for x in ints), body], names=["ti", "tj", "rows", "columns", "body"]
        )

    return wide.select(*names).mapInArrow(run, "ti int, tj int, rows int, columns int, body binary")


def _merged(parts: DataFrame, *keys: str) -> DataFrame:
    """One row a key. Rows pass one by one in a fixed order; none but the running one is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shape = None, None, (0, 0)
        for r in batches:
            columns = [r.column(c).to_pylist() for c in ("ti", "tj", "salt", "rows", "columns")]
            for *key, rows, width, body in zip(*columns, r.column("body").to_pylist()):
                part = CoMoments.of_tile(np.frombuffer(body).reshape(6, rows, width).copy())
                if key == now:
                    held.add(part)
                    continue
                if held is not None:
                    yield row(now, shape, held)
                now, held, shape = key, part, (rows, width)
        if held is not None:
            yield row(now, shape, held)

    def row(key: list[int], shape: tuple[int, int], held: CoMoments) -> pa.RecordBatch:
        ints = [pa.array([v], pa.int32()) for v in (*key, *shape)]
        body = pa.array([held.tile(slice(None), slice(None)).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([*ints, body], names=["ti", "tj", "salt", "rows", "columns", "body"])

    schema = "ti int, tj int, salt int, rows int, columns int, body binary"
    return (
        parts.repartition(*keys).sortWithinPartitions(*keys, "part").select("ti", "tj", "salt", "rows", "columns", "body")
        .mapInArrow(run, schema)
    )


def pair_correlations(df: DataFrame, values: Sequence[Column], panel: int = PANEL) -> DataFrame:
    """Pearson's r of all pairs of columns: i, j (``i <= j``, numbers of columns), n, r.

    The values are doubles, null or NaN where missing. r is null if undefined: less than two
    common rows, a column constant in them, infinities, or squares beyond the range.

    One scan of the table for up to ``panel`` columns; beyond, one of each pair of panels,
    reading only their columns. Tasks shuffle one row a tile of 32 x 32 pairs, merged in two
    steps, so a tile's rows meet in one task only after 64 tasks have merged them. The result
    has as many rows as pairs. It is the same again for the same partitions.
    """
    names = [f"c{i}" for i in range(len(values))]
    wide = df.select(*[v.alias(n) for v, n in zip(values, names)])
    panels = [list(range(a, min(len(names), a + panel))) for a in range(0, len(names), panel)]
    parts = None
    for i, a in enumerate(panels):
        for b in panels[i:] if len(panels) > 1 else [a]:
            at = a if a is b else [*a, *b]
            some = _summed(wide, [names[k] for k in at], at, 0 if a is b else len(a))
            parts = some if parts is None else parts.unionByName(some)
    part = F.spark_partition_id()
    salted = parts.withColumn("part", part).withColumn("salt", F.pmod("part", F.lit(SALTS)).cast("int"))
    once = _merged(salted, "ti", "tj", "salt").withColumn("part", F.col("salt")).withColumn("salt", F.lit(0))
    whole = _merged(once, "ti", "tj", "salt")
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64()), ("r", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ti, tj, rows, width, body in zip(*[b.column(c).to_pylist() for c in ("ti", "tj", "rows", "columns", "body")]):
                pair = CoMoments.of_tile(np.frombuffer(body).reshape(6, rows, width))
                i, j = (x.ravel() for x in np.meshgrid(ti + np.arange(rows), tj + np.arange(width), indexing="ij"))
                keep = i <= j
                r = np.where(i == j, np.where(np.isnan(pair.r().ravel()), np.nan, 1.0), pair.r().ravel())[keep]
                yield pa.RecordBatch.from_arrays(
                    [i[keep].astype(np.int32), j[keep].astype(np.int32), pair.n.ravel()[keep].astype(np.int64),
                     pa.array(r, pa.float64(), mask=np.isnan(r))],
                    schema=schema,
                )

    return whole.mapInArrow(run, "i int, j int, n long, r double")
