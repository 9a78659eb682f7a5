"""Whitening of embeddings with distributed block matrices.

1. Integers. Every entry becomes a fixed-point long, so that sums over all rows are exact in any order.
2. Blocks. Each task lays its rows into blocks of ``block_rows`` rows, written once with the sums of each block.
   The sums of all blocks give the exact mean.
3. Scatter. Blocks, numbered through over all tasks and centred by the mean, make a ``BlockMatrix`` A;
   the product of its transpose and itself, divided by n, is the covariance. Its middle dimension is split so
   that a task multiplies one pair of blocks.
4. ``eigh`` of the covariance (dimensions squared, whatever the number of rows) on the driver.
5. Projection. A times the whitening matrix, again as block matrices. A has further columns for the id, the
   deviation and a mark of real rows, and the whitening matrix has ones for them, so the product's rows know
   whose they are and nothing has to be joined back. (Longs travel as two halves, exact as doubles.)
6. Check. The covariance of the whitened rows, centred block by block and merged, against the identity.

Multiplying block matrices collects the numbers of their blocks on the driver, and deals a one-column product to about
the root of its partitions. So a product takes at most ``SLAB`` blocks (about 32 blocks a task then): a larger table
is multiplied in slabs of consecutive tasks (the scatters add up), each read from the written blocks alone. All steps repeat their work from written blocks when an executor is lost.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped, and so are rows whose
vector has another length than most vectors have (ties: the longer); an empty table, or one without such rows, gives no
rows; entries beyond 2**40 count as that; components without variance (an eigenvalue of at most 1e-12 of the largest)
have no whitened value and give no rows, so equal vectors alone give none; repeated rows and null or repeated ids
are rows of their own; a deviation beyond a long is null; further columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlens.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: doubles in a block, 2 MB
BLOCK_CELLS = 1 << 18
#: blocks in one product
SLAB = 1024
#: eigenvalues below this share of the largest one are taken as none
FLAT = 1e-12
HALF = 32
#: columns of A besides the entries: id (two halves), id present, deviation (two halves), deviation present, real row
MARKS = 7


@dataclass
class Whitening:
    """What a fit found: rows, sums per dimension, eigenvalues by falling size, and unit vectors as columns."""

    rows: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Components with variance."""
        return int((self.values > FLAT * self.values[0]).sum()) if self.values[0] > 0 else 0


def fixed_point(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): the rows with usable vectors, entries as floor(64 c) + 1000000."""
    v = F.col(vector)
    limit = F.lit(float(1 << 40))
    usable = F.coalesce(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(SCALE * c.cast("double"), limit), -limit)) + SHIFT)
    rows = df.where(usable & (F.size(v) > 0)).select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    width = sizes.orderBy(F.desc("n"), F.desc("size")).head(1)
    return rows.where(F.size("x") == (width[0]["size"] if width else -1))


def _lay(block_cells: int):
    """One row per block: its rows' ids, its entries column by column, and their sums."""
    def block(task: int, seq: int, ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(x)], pa.int64()),
             pa.array([x.sum(axis=0)], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())),
             pa.array([x.T.reshape(-1)], pa.list_(pa.int64()))], ["task", "seq", "n", "sums", "ids", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, rest_ids, rest = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column("vec_id"), batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            if rest is not None:
                ids, x = pa.concat_arrays([rest_ids, ids]), np.concatenate([rest, x])
            size = max(1, block_cells // x.shape[1])
            full = len(x) // size * size
            for a in range(0, full, size):
                yield block(task, seq, ids.slice(a, size), x[a:a + size])
                seq += 1
            rest_ids, rest = ids.slice(full), x[full:]
        if rest is not None and len(rest):
            yield block(task, seq, rest_ids, rest)

    return run


BLOCKS = "task int, seq int, n bigint, sums array<bigint>, ids array<bigint>, x array<bigint>"


def lay_blocks(rows: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Rows (vec_id, x) as written blocks; tasks do not share blocks."""
    return materialize(rows.mapInArrow(_lay(block_cells), BLOCKS), "blocks")


def moments(blocks: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows and the exact sums per dimension."""
    n = blocks.agg(F.sum("n")).first()[0] or 0
    sums = blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    return n, np.array([r["s"] for r in sums], np.int64)


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longs as two doubles without loss."""
    return (values >> HALF).astype(float), (values & ((1 << HALF) - 1)).astype(float)


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype(np.int64) << HALF) + low.astype(np.int64)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over dimensions of (n x - S)**2, and which of them a long can hold."""
    rough = ((n * x.astype(float) - sums) ** 2).sum(axis=1)
    fits = rough < 9.2e18
    away = np.where(fits[:, None], x, 0) * n - np.where(fits[:, None], sums, 0)
    return (away * away).sum(axis=1), fits


def _dense(block_rows: int, n: int, sums: np.ndarray, starts: dict[int, int], first: int, marks: bool):
    """Blocks as matrices centred by the mean; rows that a block lacks are zero."""
    mean = sums / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("n")[i].as_py()
                x = batch.column("x")[i].values.to_numpy().reshape(-1, rows).T
                out = np.zeros((block_rows, len(sums) + (MARKS if marks else 0)), order="F")
                # exact remainders first: x - S / n = (x - floor(mean)) - (S / n - floor(mean))
                whole = np.floor(mean).astype(np.int64)
                out[:rows, :len(sums)] = (x - whole) - (sums - whole * n) / n
                if marks:
                    ids = batch.column("ids")[i].values
                    present = ids.is_valid().to_numpy(zero_copy_only=False)
                    dev, fits = deviations(x, n, sums)
                    high, low = _halves(ids.fill_null(0).to_numpy())
                    dev_high, dev_low = _halves(dev)
                    for j, c in enumerate((high, low, present, dev_high, dev_low, fits, np.ones(rows))):
                        out[:rows, len(sums) + j] = c
                place = starts[batch.column("task")[i].as_py()] + batch.column("seq")[i].as_py() - first
                yield pa.RecordBatch.from_arrays([
                    pa.array([{"_1": place, "_2": 0}], pa.struct([("_1", pa.int64()), ("_2", pa.int64())])),
                    _matrix(out)], ["_1", "_2"])

    return run


def _matrix(m: np.ndarray) -> pa.Array:
    """A column-major matrix in the layout of Spark's matrix type."""
    one = {"type": 1, "numRows": m.shape[0], "numCols": m.shape[1], "colPtrs": None, "rowIndices": None,
           "values": m.reshape(-1, order="F"), "isTransposed": False}
    kind = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                      ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])
    return pa.array([one], kind)


COORDINATES = T.StructType([T.StructField("_1", T.LongType(), False), T.StructField("_2", T.LongType(), False)])
CELLS = T.StructType([T.StructField("_1", COORDINATES, False), T.StructField("_2", MatrixUDT(), False)])


def block_matrix(cells: DataFrame, block_rows: int, block_columns: int, rows: int, columns: int) -> BlockMatrix:
    """A frame of (coordinates, matrix) as a block matrix, without a detour through Python objects."""
    java = callMLlibFunc("createBlockMatrix", cells, block_rows, block_columns, rows, columns)
    return BlockMatrix(java, block_rows, block_columns, rows, columns)


def multiplied(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, its middle dimension dealt to ``splits`` tasks."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def slabs(blocks: DataFrame, limit: int = SLAB) -> list[tuple[int, int, int, int]]:
    """(first task, last task, first block, blocks) of runs of tasks of at most ``limit`` blocks, or of one task."""
    per_task = sorted((r["task"], r["count"]) for r in blocks.groupBy("task").count().collect())
    out: list[tuple[int, int, int, int]] = []
    at = 0
    for task, count in per_task:
        if out and out[-1][3] + count <= limit:
            a, _, first, n = out[-1]
            out[-1] = (a, task, first, n + count)
        else:
            out.append((task, task, at, count))
        at += count
    return out


def _starts(blocks: DataFrame) -> dict[int, int]:
    """The number of each task's first block."""
    out, at = {}, 0
    for task, count in sorted((r["task"], r["count"]) for r in blocks.groupBy("task").count().collect()):
        out[task], at = at, at + count
    return out


def _slab(blocks: DataFrame, slab: tuple[int, int, int, int], block_rows: int, n: int, sums: np.ndarray,
          starts: dict[int, int], marks: bool) -> BlockMatrix:
    """The centred rows of a slab; files of other tasks are skipped by their statistics."""
    a, b, first, count = slab
    mine = blocks.where(F.col("task").between(a, b)).select("task", "seq", "n", "ids", "x")
    own = {t: s for t, s in starts.items() if a <= t <= b}
    cells = mine.mapInArrow(_dense(block_rows, n, sums, own, first, marks), CELLS)
    width = len(sums) + (MARKS if marks else 0)
    return block_matrix(cells, block_rows, width, block_rows * count, width)


def fit(blocks: DataFrame, block_rows: int, slab: int = SLAB) -> Whitening | None:
    """Covariance of all rows and its eigenvectors; None without rows."""
    n, sums = moments(blocks)
    if not n:
        return None
    starts, scatter = _starts(blocks), np.zeros((len(sums), len(sums)))
    for part in slabs(blocks, slab):
        a = _slab(blocks, part, block_rows, n, sums, starts, False)
        scatter += multiplied(a.transpose(), a, part[3]).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    return Whitening(n, sums, values[::-1], vectors[:, ::-1], float(np.trace(covariance)))


def _rows_of(components: int):
    """The rows of a product's blocks: vec_id, deviation, whitened."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1)
            for i in range(batch.num_rows):
                cell = cells.slice(i, 1)
                height = cell.field("numRows")[0].as_py()
                m = cell.field("values")[0].values.to_numpy(zero_copy_only=False)
                m = m.reshape(height, -1) if cell.field("isTransposed")[0].as_py() else m.reshape(-1, height).T
                m = m[m[:, -1] == 1]
                ids = pa.array(_joined(m[:, components], m[:, components + 1]), mask=m[:, components + 2] == 0)
                dev = pa.array(_joined(m[:, components + 3], m[:, components + 4]), mask=m[:, components + 5] == 0)
                white = np.ascontiguousarray(m[:, :components])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, components, dtype=np.int32)), pa.array(white.reshape(-1)))
                yield pa.RecordBatch.from_arrays([ids, dev, lists], ["vec_id", "deviation", "whitened"])

    return run


def project(blocks: DataFrame, model: Whitening, block_rows: int, components: int = COMPONENTS, slab: int = SLAB) -> DataFrame:
    """(vec_id, deviation, whitened) of all rows, components by falling eigenvalue."""
    dims, kept = len(model.sums), min(components, model.rank)
    spark = blocks.sparkSession
    if not kept:
        return spark.createDataFrame([], "vec_id bigint, deviation bigint, whitened array<double>")
    right = np.zeros((dims + MARKS, kept + MARKS), order="F")
    right[:dims, :kept] = model.vectors[:, :kept] / np.sqrt(model.values[:kept])
    right[dims:, kept:] = np.eye(MARKS)
    starts, parts = _starts(blocks), []
    for part in slabs(blocks, slab):
        a = _slab(blocks, part, block_rows, model.rows, model.sums, starts, True)
        # as many partitions as blocks, all but one empty: the product is dealt to about the root of their number
        one = spark.range(0, part[3], 1, part[3]).where("id = 0").withColumn("v", F.lit(right.reshape(-1, order="F").tolist()))
        cells = one.mapInArrow(_whole(right.shape), CELLS)
        w = block_matrix(cells, right.shape[0], right.shape[1], *right.shape)
        product = multiplied(a, w, 1)
        found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
        parts.append(found.mapInArrow(_rows_of(kept), "vec_id bigint, deviation bigint, whitened array<double>"))
    return reduce(DataFrame.unionAll, parts)


def _whole(shape: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = batch.column("v")[i].values.to_numpy().reshape(shape, order="F")
                yield pa.RecordBatch.from_arrays([
                    pa.array([{"_1": 0, "_2": 0}], pa.struct([("_1", pa.int64()), ("_2", pa.int64())])), _matrix(values)], ["_1", "_2"])

    return run


SPREAD = "part int, n bigint, mean array<double>, scatter array<double>"


def _merged(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and scatter about it, from those of parts."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    return n, mean, sum(p[2] + p[0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, mean and scatter of a task's whitened rows."""
    total = None
    for batch in batches:
        if batch.num_rows:
            w = batch.column("whitened").flatten().to_numpy().reshape(batch.num_rows, -1)
            mean = w.mean(axis=0)
            part = (len(w), mean, (w - mean).T @ (w - mean))
            total = _merged([total, part]) if total else part
    if total:
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId() % 64], pa.int32()), "n": pa.array([total[0]], pa.int64()),
            "mean": pa.array([total[1]]), "scatter": pa.array([total[2].reshape(-1)])})


def _gather(table: pa.Table) -> pa.Table:
    parts = [(n, np.array(m), np.array(s).reshape(len(m), -1)) for n, m, s in zip(
        table["n"].to_pylist(), table["mean"].to_pylist(), table["scatter"].to_pylist())]
    n, mean, scatter = _merged(parts)
    return pa.table({"part": table["part"].slice(0, 1), "n": pa.array([n], pa.int64()),
                     "mean": pa.array([mean]), "scatter": pa.array([scatter.reshape(-1)])})


def identity_error(projected: DataFrame) -> float:
    """The largest entry of the whitened rows' covariance less the identity."""
    parts = projected.select("whitened").mapInArrow(_spread, SPREAD).groupBy("part").applyInArrow(_gather, SPREAD).collect()
    if not parts:
        return 0.0
    n, _, scatter = _merged([(r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(len(r["mean"]), -1)) for r in parts])
    return float(np.abs(scatter / n - np.eye(len(scatter))).max())


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           block_cells: int = BLOCK_CELLS, slab: int = SLAB) -> tuple[DataFrame, Whitening | None]:
    """Whitened rows (vec_id, deviation, whitened) and the fit; see the module for cases."""
    blocks = lay_blocks(fixed_point(df, vec_id, vector), block_cells)
    one = blocks.select(F.size("sums").alias("width")).head(1)
    block_rows = max(1, block_cells // one[0]["width"]) if one else 1
    model = fit(blocks, block_rows, slab)
    if model is None:
        return df.sparkSession.createDataFrame([], "vec_id bigint, deviation bigint, whitened array<double>"), None
    return project(blocks, model, block_rows, components, slab), model
