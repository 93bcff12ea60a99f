"""L-BFGS for weighted multinomial logistic regression, its sums made by Spark tasks.

The steps are taken on the coefficients of the features as they are. Unit-length TF-IDF
rows give an objective that is well conditioned so; divided by each term's deviation, as
Spark ML's optimiser has it, rare terms weigh like frequent ones and a thousand steps
are not enough.

Rows are packed once into blocks of at most ``BLOCK`` entries, which stay serialized on the
executors' disks. Each step reads them in at most one task per core; a task holds one block
and one sum per coefficient, and only those sums reach the driver, which holds the model and
the last steps.

Of many rows, first a part finds the place to start from. Where the steps end is decided by
the gradient over all rows alone.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of a block, and of the least work worth a task of its own.
BLOCK = 1 << 16
PER_TASK = 1 << 20

# Of how many rows one is taken for a start, in turn, and the least entries taken.
SHARES = (64, 8)
LEAST_PART = 32 * BLOCK

# Steps that the optimiser remembers at least, more where they fit into so many bytes;
# halvings of one step at most, and the share of the slope by which a step must lower the
# objective.
MEMORY = 10
MEMORY_BYTES = 48 << 20
HALVINGS = 30
DESCENT = 1e-4

PARTS = {"own": np.dtype("i4"), "weight": np.dtype("f8"), "sizes": np.dtype("i4"),
         "at": np.dtype("i4"), "x": np.dtype("f8")}


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of neighbouring rows, every part the bytes of one array."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("at")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK, side="right")))
            rows = batch.slice(first, last - first)
            values = {
                "own": rows.column("own"), "weight": rows.column("weight"), "sizes": pa.array(sizes[first:last]),
                "at": rows.column("at").flatten(), "x": rows.column("x").flatten(),
            }
            yield pa.RecordBatch.from_pydict({
                name: pa.array([values[name].to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary())
                for name, kind in PARTS.items()
            })
            first = last


def block_sums(block: dict[str, np.ndarray], theta: np.ndarray, sums: np.ndarray) -> float:
    """Weighted loss of a block's rows at ``theta`` (features and the intercept by classes);
    adds the gradient of it to ``sums``."""
    own, weight, sizes, at, x = (block[name] for name in PARTS)
    some, rows, classes = sizes > 0, np.arange(len(own)), range(theta.shape[1])
    starts, at, of = (np.cumsum(sizes, dtype=np.int64) - sizes)[some], at.astype(np.int64), np.repeat(rows, sizes)
    z = np.repeat(theta[-1][:, None], len(own), axis=1)
    if len(at):
        for k in classes:  # whole columns: several times faster than rows of a few classes
            z[k, some] += np.add.reduceat(theta[:-1, k].copy()[at] * x, starts)
    z -= z.max(axis=0)
    p = np.exp(z)
    total = p.sum(axis=0)
    loss = float(weight @ (np.log(total) - z[own, rows]))
    p /= total
    p[own, rows] -= 1.0
    p *= weight
    for k in classes:
        sums[:-1, k] += np.bincount(at, p[k][of] * x, len(theta) - 1)
    sums[-1] += p.sum(axis=1)
    return loss


class Objective:
    """Penalised mean loss and its gradient, by one job over packed rows for each call.

    ``blocks`` are kept on the executors' disks; a lost one is packed again.
    """

    def __init__(self, blocks: RDD, classes: int, features: int, penalty: float, entries: int, total: float):
        self.blocks, self.entries, self.total = blocks.persist(StorageLevel.DISK_ONLY), entries, total
        self.classes, self.features, self.penalty = classes, features, penalty

    def __call__(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        shared = self.blocks.context.broadcast(theta)

        def add_up(blocks: Iterator[dict[str, bytes]]) -> Iterator[tuple[float, bytes]]:
            here, loss = shared.value, 0.0
            sums = np.zeros_like(here)
            for block in blocks:
                loss += block_sums({name: np.frombuffer(block[name], kind) for name, kind in PARTS.items()}, here, sums)
            yield loss, sums.tobytes()

        parts = self.blocks.mapPartitions(add_up).collect()  # one row a task
        shared.destroy()
        gradient = sum(np.frombuffer(sums) for _, sums in parts).reshape(theta.shape) / self.total
        gradient[:-1] += self.penalty * theta[:-1]
        return sum(loss for loss, _ in parts) / self.total + self.penalty / 2 * float((theta[:-1] ** 2).sum()), gradient

    def part(self, share: int) -> Objective:
        """The same over about one block of ``share``, told by its content."""
        blocks = self.blocks.filter(lambda block: crc32(block["at"]) % share == 0)
        some = Objective(blocks, self.classes, self.features, self.penalty, self.entries // share, 1.0)
        some.total = some.blocks.map(lambda block: float(np.frombuffer(block["weight"]).sum())).sum()
        return some

    def release(self) -> None:
        self.blocks.unpersist()


def objective(vectors: DataFrame, classes: int, features: int, penalty: float) -> Objective:
    """The objective over ``vectors`` (features, _label, weight)."""
    vector = F.unwrap_udt("features")
    counts = vectors.agg(F.sum("weight").alias("weight"), F.sum(F.size(vector["indices"])).alias("entries")).first()
    tasks = min(vectors.sparkSession.sparkContext.defaultParallelism, 1 + counts["entries"] // PER_TASK)
    packed = (
        vectors.coalesce(tasks)
        .select(F.col("_label").cast("int").alias("own"), "weight", vector["indices"].alias("at"), vector["values"].alias("x"))
        .mapInArrow(pack, ", ".join(f"{name} binary" for name in PARTS))
    )
    blocks = packed.rdd.map(lambda row: {name: bytes(row[name]) for name in PARTS})
    return Objective(blocks, classes, features, penalty, counts["entries"], counts["weight"])


def start(at: Objective, max_iter: int, tolerance: float) -> np.ndarray:
    """Where to begin on all rows: the least of the objective over a part of them, found from
    that over a smaller part. Few rows are begun at 0."""
    theta = np.zeros((at.features + 1, at.classes))
    for share in SHARES:
        if at.entries >= share * LEAST_PART:
            some = at.part(share)
            if some.total:
                theta = minimum(some, theta, max_iter, tolerance)
            some.release()
    return theta


def _direction(gradient: np.ndarray, steps: deque) -> np.ndarray:
    """Minus the gradient times the inverse Hessian that the last steps suggest."""
    q, shares = gradient.copy(), []
    for s, y, sy in reversed(steps):
        shares.append(float((s * q).sum()) / sy)
        q -= shares[-1] * y
    if steps:
        _, y, sy = steps[-1]
        q *= sy / float((y * y).sum())
    for (s, y, sy), share in zip(steps, reversed(shares)):
        q += (share - float((y * q).sum()) / sy) * s
    return -q


def minimum(
    at: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray, max_iter: int, tolerance: float
) -> np.ndarray:
    """Where the gradient of ``at`` has no part above ``tolerance``, or the place after
    ``max_iter`` steps, or after the last step that still lowers the objective."""
    value, gradient = at(theta)
    steps: deque = deque(maxlen=max(MEMORY, MEMORY_BYTES // (2 * theta.nbytes)))
    for _ in range(max_iter):
        if np.abs(gradient).max() <= tolerance:
            break
        towards = _direction(gradient, steps)
        slope = float((gradient * towards).sum())
        length = 1.0 if steps else 1.0 / max(1e-300, float(np.sqrt((gradient**2).sum())))
        for _ in range(HALVINGS):
            there = theta + length * towards
            next_value, next_gradient = at(there)
            if next_value <= value + DESCENT * length * slope:
                break
            length /= 2
        else:
            break
        s, y = there - theta, next_gradient - gradient
        sy = float((s * y).sum())
        if sy > 0:
            steps.append((s, y, sy))
        theta, value, gradient = there, next_value, next_gradient
    return theta
