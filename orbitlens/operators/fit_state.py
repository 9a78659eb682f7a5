"""States of trials being fitted, and their checkpoints in the shared folder."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.operators.model import Weights


@dataclass
class TrialState:
    """One model being fitted: settings, weights, the optimizer's moments, and its history."""

    number: int
    settings: object
    weights: Weights
    first: Weights
    second: Weights
    steps: int = 0
    train_loss: float = math.nan
    log: list[tuple[int, float, float | None]] = field(default_factory=list)
    best: Weights | None = None
    best_epoch: int = -1
    best_loss: float = math.inf

    def open(self, epoch: int) -> bool:
        """Whether the trial goes on with this epoch."""
        waited = epoch - 1 - max(self.best_epoch, 0)
        return epoch < self.settings.max_epochs and (epoch == 0 or waited < self.settings.patience)

    def log_epoch(self, epoch: int, val_loss: float | None) -> None:
        """Note the losses; a loss that is not finite is never the best one, and without any the last epoch is."""
        self.log.append((epoch, self.train_loss, None if val_loss is None else float(val_loss)))
        if val_loss is None:
            self.best, self.best_epoch = self.weights, epoch
        elif math.isfinite(val_loss) and val_loss < self.best_loss:
            self.best, self.best_epoch, self.best_loss = self.weights, epoch, float(val_loss)

    def identity(self) -> str:
        """The settings that a checkpoint must agree with; how long to go on is not among them."""
        s = self.settings
        return repr((s.latent_dim, s.hidden_dims, s.beta, s.lr, s.batch_size, s.mixing, s.workers, s.seed,
                     s.reset_epochs, s.reset_value, s.sync))


_ARRAYS = "trial int, part string, layer string, shape array<int>, data array<double>"
_RECORDS = ("trial int, identity string, steps bigint, best_epoch int, best_loss double, "
            "log array<struct<epoch: int, train_loss: double, val_loss: double>>")
_PARTS = ("weights", "first", "second", "best")


class Checkpoints:
    """A folder with one subfolder per epoch: ``arrays`` first, then ``records``, whose commit makes the epoch whole.

    What is written is bounded by the models and the number of epochs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _whole_epochs(self) -> list[int]:
        """Epochs whose records are committed."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/epoch-*/records/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getParent().getName().split("-")[1]) for f in found)

    def save(self, epoch: int, trials: list[TrialState]) -> None:
        folder = f"{self.path}/epoch-{epoch:06d}"
        arrays = [(t.number, part, n, list(w.shape), w.astype(float).ravel().tolist())
                  for t in trials for part in _PARTS for n, w in (getattr(t, part) or {}).items()]
        records = [(t.number, t.identity(), t.steps, t.best_epoch, t.best_loss, t.log) for t in trials]
        for name, rows, schema in (("arrays", arrays, _ARRAYS), ("records", records, _RECORDS)):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    def _frame(self, epoch: int, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/epoch-{epoch:06d}/{name}")

    def load(self, trials: list[TrialState]) -> int | None:
        """Put the trials into the state of the last whole epoch and return it; None where there is none."""
        whole = self._whole_epochs()
        if not whole:
            return None
        records = {r["trial"]: r for r in self._frame(whole[-1], "records", _RECORDS).collect()}
        if {t.number: t.identity() for t in trials} != {n: r["identity"] for n, r in records.items()}:
            raise ValueError(f"{self.path} holds a fit with other settings")
        arrays: dict[tuple[int, str], Weights] = {}
        for r in self._frame(whole[-1], "arrays", _ARRAYS).where(F.col("layer").isNotNull()).collect():
            arrays.setdefault((r["trial"], r["part"]), {})[r["layer"]] = np.array(r["data"]).reshape(r["shape"])
        for t in trials:
            r = records[t.number]
            t.steps, t.best_epoch, t.best_loss = r["steps"], r["best_epoch"], r["best_loss"]
            t.log = [tuple(e) for e in r["log"]]
            for part in _PARTS:
                setattr(t, part, arrays.get((t.number, part)))
        return whole[-1]
