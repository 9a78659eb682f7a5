"""Distributed fit of the likelihood model, validation, early stop and random search.

Each epoch is one Spark job for all open trials together: the rows are dealt to workers and ordered by
counters drawn anew for the epoch (``functions.noise``), so mini-batches, latent noise and losses are the same under
every layout. A worker streams its rows once and feeds every trial's mini-batches from them.

``sync="epoch"``: workers run Adam on their own from the shared starting point; weights and moments are
averaged by row count in two rounds, so what reaches the driver is bounded by the model, not by data or workers.
``sync="step"``: tasks of a barrier stage exchange the gradients of every mini-batch and take the same step with
their mean, weighted by rows. Every exchange goes through the driver and grows with workers squared, so
this is for a moderate number of workers; they all need a task slot at once.

With a checkpoint folder the states and the history are committed after every epoch, and a later call goes on from
the last whole one. Rows are written once to the shared folder, not kept in executors.

Without train rows nothing is learnt: the starting weights come back with an empty history. Without validation rows
no epoch can be judged: their loss is null, nothing stops early and the last epoch's weights count.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.likelihood import LIKELIHOOD_WEIGHT, LOG_SQRT_2PI, SCALE_FLOOR
from orbitlens.functions.noise import epoch_order, epoch_worker, normal_draws
from orbitlens.functions.scalars import iso_millis
from orbitlens.operators.fit_state import Checkpoints, TrialState
from orbitlens.operators.model import Weights, dense_pass, init_weights, matrix
from orbitlens.session import materialize

# The optimizer's usual constants.
ADAM_BETA1, ADAM_BETA2, ADAM_EPS = 0.9, 0.999, 1e-8


#: rows of a worker's share, where their number is not given
ROWS_PER_WORKER = 1_000_000
#: rows between two rounds over the open trials
CHUNK = 4096
#: trials whose states a task holds at once
TRIALS_PER_PASS = 32


@dataclass(frozen=True)
class FitSettings:
    """``sync``: ``epoch`` averages weights and moments once an epoch, ``step`` averages gradients before every update."""

    latent_dim: int = 18
    hidden_dims: int = 400
    beta: float = 1.0
    lr: float = 0.001
    batch_size: int = 32
    mixing: float | None = 1e-4
    max_epochs: int = 100
    patience: int = 10
    workers: int | None = None
    seed: int = 42
    reset_epochs: int = 0
    reset_value: float = -2.0
    sync: str = "epoch"


@dataclass
class FitResult:
    """Weights of the best epoch; ``last`` holds weights and both moments after the last one."""

    weights: Weights
    history: DataFrame
    best_epoch: int
    settings: FitSettings = field(default_factory=FitSettings)
    last: list[Weights] = field(default_factory=list)


def loss_and_gradients(
    weights: Weights, x: np.ndarray, noise: np.ndarray, beta: float, mixing: float | None, gradients: bool = True
) -> tuple[float, Weights]:
    """Composite loss of one batch and its gradient for every weight array."""
    mix = mixing or 1.0
    rows, width = x.shape
    enc = dense_pass(weights, "encoder", x)
    latent = enc[-1].shape[1] // 2
    mean_z, log_var_z = enc[-1][:, :latent], enc[-1][:, latent:]
    spread = np.exp(0.5 * log_var_z)
    dec = dense_pass(weights, "decoder", mean_z + noise * spread)
    residual = dec[-1] - x
    log_var_x = weights["log_var_x"]
    scale = np.exp(0.5 * log_var_x) + SCALE_FLOOR
    standardized = residual / scale
    mse = np.mean(residual**2)
    log_density = -np.sum(0.5 * standardized**2 + np.log(scale) + LOG_SQRT_2PI) / rows
    kl = -0.5 * np.sum(1 + log_var_z - mean_z**2 - np.exp(log_var_z))
    loss = float(mse + mix * (mse - LIKELIHOOD_WEIGHT * log_density) + beta * kl)
    if not gradients:
        return loss, {}

    pull = mix * LIKELIHOOD_WEIGHT / rows
    grads: Weights = {"log_var_x": pull * np.sum(0.5 * (1 - standardized**2), axis=0)}

    def backward(side: str, layers: list[np.ndarray], delta: np.ndarray) -> np.ndarray:
        for i in (2, 1, 0):
            grads[f"{side}.{i}.weight"] = layers[i].T @ delta
            grads[f"{side}.{i}.bias"] = delta.sum(axis=0)
            delta = delta @ weights[f"{side}.{i}.weight"].T
            if i:
                delta = delta * (layers[i] > 0)
        return delta

    to_z = backward("decoder", dec, 2 * (1 + mix) * residual / (rows * width) + pull * residual / scale**2)
    to_mean = to_z + beta * mean_z
    to_log_var = 0.5 * to_z * noise * spread + 0.5 * beta * (np.exp(log_var_z) - 1)
    backward("encoder", enc, np.concatenate([to_mean, to_log_var], axis=1))
    return loss, grads


def adam_step(weights: Weights, first: Weights, second: Weights, step: int, grads: Weights, lr: float) -> None:
    """One Adam update in place."""
    for name, g in grads.items():
        first[name] += (1 - ADAM_BETA1) * (g - first[name])
        second[name] += (1 - ADAM_BETA2) * (g * g - second[name])
        m = first[name] / (1 - ADAM_BETA1**step)
        v = second[name] / (1 - ADAM_BETA2**step)
        weights[name] -= lr * m / (np.sqrt(v) + ADAM_EPS)


def chunks(batches: Iterator[pa.RecordBatch], width: int, latent: int, size: int = CHUNK
           ) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, noise, whether it is the last) in pieces of ``size`` rows."""
    x, z = np.empty((0, width)), np.empty((0, latent))
    for batch in batches:
        x = np.concatenate([x, matrix(batch.column(0), width)])
        z = np.concatenate([z, matrix(batch.column(1), latent)])
        while len(x) > size:
            yield x[:size], z[:size], False
            x, z = x[size:], z[size:]
    if len(x):
        yield x, z, True


class Feed:
    """A trial's mini-batches from a stream of chunks; the last one may be shorter."""

    def __init__(self, size: int, width: int, latent: int):
        self.size, self.rest = size, (np.empty((0, width)), np.empty((0, latent)))

    def take(self, x: np.ndarray, z: np.ndarray, last: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, z = np.concatenate([self.rest[0], x]), np.concatenate([self.rest[1], z])
        end = len(x) if last else len(x) // self.size * self.size
        for i in range(0, end, self.size):
            yield x[i:min(i + self.size, end)], z[i:min(i + self.size, end)]
        self.rest = x[end:], z[end:]


def _flat(*parts: Weights) -> np.ndarray:
    return np.concatenate([p[n].ravel() for p in parts for n in sorted(p)])


def _unflat(vector: np.ndarray, like: Weights, n: int) -> list[Weights]:
    out, at = [], 0
    for _ in range(n):
        part = {}
        for name in sorted(like):
            size = like[name].size
            part[name] = vector[at:at + size].reshape(like[name].shape).copy()
            at += size
        out.append(part)
    return out


class Learner:
    """One trial inside a task: its state, its mini-batches and its losses so far."""

    def __init__(self, trial: TrialState, epoch: int, width: int, latent: int):
        self.trial, self.settings, self.epoch = trial.number, trial.settings, epoch
        self.parts = [{n: a.copy() for n, a in p.items()} for p in (trial.weights, trial.first, trial.second)]
        self.step, self.rows, self.loss = trial.steps, 0, 0.0
        self.feed = Feed(trial.settings.batch_size, width, latent)

    def gradients(self, x: np.ndarray, z: np.ndarray) -> tuple[float, Weights]:
        s = self.settings
        return loss_and_gradients(self.parts[0], x, z[:, :s.latent_dim], s.beta, s.mixing)

    def update(self, rows: int, loss: float, grads: Weights) -> None:
        """One Adam step; ``loss`` is the mean over ``rows``."""
        s = self.settings
        self.step += 1
        adam_step(*self.parts, self.step, grads, s.lr)
        if self.epoch < s.reset_epochs:
            self.parts[0]["log_var_x"][:] = s.reset_value
        self.rows += rows
        self.loss += loss * rows

    def report(self, worker: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "trial": pa.array([self.trial], pa.int32()), "worker": pa.array([worker], pa.int32()), "rows": [self.rows],
            "steps": [self.step], "loss": [self.loss / self.rows], "state": [_flat(*self.parts).tobytes()]})


def _averaged(parts: list[np.ndarray], like: Weights) -> tuple[int, float, Weights]:
    """Rows, mean loss and mean gradients of all workers' vectors (rows, loss, gradients...), weighted by rows."""
    rows = sum(p[0] for p in parts)
    mean = sum(p[0] / rows * p[1:] for p in parts)
    return int(rows), float(mean[0]), _unflat(mean[1:], like, 1)[0]


def _exchange(context, learner: Learner, batch: tuple[np.ndarray, np.ndarray] | None) -> bool:
    """One step of all workers with what batches they have; false when none has any."""
    message = ""
    if batch is not None:
        loss, grads = learner.gradients(*batch)
        message = base64.b64encode(np.concatenate([[len(batch[0]), loss], _flat(grads)]).tobytes()).decode()
    got = [np.frombuffer(base64.b64decode(m)) for m in context.allGather(message) if m]
    if not got:
        return False
    learner.update(*_averaged(got, learner.parts[0]))
    return True


def _in_step(learners: list[Learner], pieces: Iterator[tuple[np.ndarray, np.ndarray, bool]], width: int, latent: int) -> None:
    """All workers go through chunks and trials in the same order, those without rows included."""
    from pyspark import BarrierTaskContext

    context = BarrierTaskContext.get()
    none = (np.empty((0, width)), np.empty((0, latent)), True)
    while True:
        piece = next(pieces, None)
        if not any(context.allGather("1" if piece else "")):
            return
        for learner in learners:
            batches = learner.feed.take(*(piece or none))
            while _exchange(context, learner, next(batches, None)):
                pass


_STATE = "trial int, worker int, rows bigint, steps bigint, loss double, state binary"


def _merge(groups: int):
    """Average worker states by row count, per trial and ``worker % groups``."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                at = total.setdefault((r["trial"], r["worker"] % groups), [0, 0, 0.0, 0.0])
                at[0] += r["rows"]
                at[1] = max(at[1], r["steps"])
                at[2] += r["rows"] * r["loss"]
                at[3] = at[3] + r["rows"] * np.frombuffer(r["state"])
        for (trial, worker), (rows, steps, loss, state) in total.items():
            yield pa.RecordBatch.from_pydict({
                "trial": pa.array([trial], pa.int32()), "worker": pa.array([worker], pa.int32()), "rows": [rows],
                "steps": [steps], "loss": [loss / rows], "state": [(state / rows).tobytes()]})

    return merged


def dealt(rows: DataFrame, key: list[str], features: str, seed: int, epoch: int, workers: int, latent: int) -> DataFrame:
    """(features, noise) with one partition per worker, in the order of the epoch."""
    placed = rows.select(*key, features, epoch_worker(key, seed, epoch, workers).alias("__worker"),
                         epoch_order(key, seed, epoch).alias("__order"))
    spread = placed.repartitionById(workers, "__worker").sortWithinPartitions("__order", *key)
    return spread.select(features, normal_draws(key, seed, epoch, latent).alias("__noise"))


def train_epoch(train: DataFrame, key: list[str], features: str, trials: list[TrialState], epoch: int, workers: int) -> None:
    """One epoch of all given trials in one pass over the rows; their states move on."""
    shared = train.sparkSession.sparkContext.broadcast(trials)
    s, width = trials[0].settings, len(trials[0].weights["log_var_x"])
    latent = max(t.settings.latent_dim for t in trials)
    in_step = s.sync == "step"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker = TaskContext.get().partitionId()
        learners = [Learner(t, epoch, width, latent) for t in shared.value]
        pieces = chunks(batches, width, latent)
        if in_step:
            _in_step(learners, pieces, width, latent)
        else:
            for x, z, last in pieces:
                for learner in learners:
                    for part in learner.feed.take(x, z, last):
                        learner.update(len(part[0]), *learner.gradients(*part))
        for learner in learners:
            # in step all workers end with the same state, and the first one speaks for them
            if learner.rows and (worker == 0 or not in_step):
                yield learner.report(worker)

    states = dealt(train, key, features, s.seed, epoch, workers, latent).mapInArrow(work, _STATE, barrier=in_step)
    groups = max(1, math.isqrt(workers))
    if workers > 1 and not in_step:
        states = states.repartition(groups, F.col("worker") % groups).mapInArrow(_merge(groups), _STATE)
    collected = states.collect()
    shared.unpersist()
    for t in trials:
        mine = [r for r in collected if r["trial"] == t.number]
        rows = sum(r["rows"] for r in mine)
        if not rows:
            raise ValueError("the train frame has no rows")
        average = sum(r["rows"] / rows * np.frombuffer(r["state"]) for r in mine)
        t.weights, t.first, t.second = _unflat(average, t.weights, 3)
        t.steps = max(r["steps"] for r in mine)
        t.train_loss = float(sum(r["rows"] / rows * r["loss"] for r in mine))


def validation_losses(frame: DataFrame, key: list[str], features: str, trials: list[TrialState], epoch: int, workers: int
                      ) -> dict[int, float]:
    """Mean batch loss per trial weighted by batch size, with latent noise as in training; one pass for all.

    Empty where the frame has no rows.
    """
    shared = frame.sparkSession.sparkContext.broadcast([(t.number, t.settings, t.weights) for t in trials])
    s, width = trials[0].settings, len(trials[0].weights["log_var_x"])
    latent = max(t.settings.latent_dim for t in trials)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feeds = [(n, q, w, Feed(q.batch_size, width, latent)) for n, q, w in shared.value]
        rows, loss = {n: 0 for n, *_ in feeds}, {n: 0.0 for n, *_ in feeds}
        for x, z, last in chunks(batches, width, latent):
            for n, q, w, feed in feeds:
                for px, pz in feed.take(x, z, last):
                    rows[n] += len(px)
                    loss[n] += len(px) * loss_and_gradients(w, px, pz[:, :q.latent_dim], q.beta, q.mixing, gradients=False)[0]
        yield pa.RecordBatch.from_pydict({"trial": pa.array(list(rows), pa.int32()), "rows": list(rows.values()), "loss": list(loss.values())})

    total = (dealt(frame, key, features, s.seed + 1, epoch, workers, latent)
             .mapInArrow(work, "trial int, rows bigint, loss double")
             .groupBy("trial").agg(F.sum("rows").alias("rows"), F.sum("loss").alias("loss")).collect())
    shared.unpersist()
    return {r["trial"]: r["loss"] / r["rows"] for r in total if r["rows"]}


def workers_for(rows: DataFrame, settings: FitSettings) -> int:
    """As asked, else by the number of rows."""
    return settings.workers or max(1, math.ceil(rows.count() / ROWS_PER_WORKER))


def new_state(number: int, width: int, settings: FitSettings, initial: Weights | None = None) -> TrialState:
    weights = {n: a.copy() for n, a in (initial or init_weights(width, settings.hidden_dims, settings.latent_dim, settings.seed)).items()}
    return TrialState(number, settings, weights, *[{n: np.zeros_like(w) for n, w in weights.items()} for _ in range(2)])


def run_trials(train: DataFrame, validation: DataFrame, key: list[str], features: str, trials: list[TrialState],
               checkpoint: str | None = None) -> list[TrialState]:
    """Train all trials, each until its ``max_epochs`` or until its validation loss has not improved for ``patience`` epochs.

    One job per epoch trains all that are open, one validates them. The trials share seed, workers and ``sync``.
    """
    if len({(t.settings.seed, t.settings.workers, t.settings.sync) for t in trials}) > 1:
        raise ValueError("trials of one run share seed, workers and sync")
    store = Checkpoints(train.sparkSession, checkpoint) if checkpoint else None
    done = store.load(trials) if store else None
    epoch = 0 if done is None else done + 1
    if not any(t.open(epoch) for t in trials):
        return trials
    train, validation = (materialize(x.select(*key, features), "fit") for x in (train, validation))
    if train.isEmpty():
        for t in trials:
            t.best = t.weights
        return trials
    workers, checkers = workers_for(train, trials[0].settings), workers_for(validation, trials[0].settings)
    while True:
        open_now = [t for t in trials if t.open(epoch)]
        if not open_now:
            return trials
        train_epoch(train, key, features, open_now, epoch, workers)
        losses = validation_losses(validation, key, features, open_now, epoch, checkers)
        for t in open_now:
            t.log_epoch(epoch, losses.get(t.number))
        if store:
            store.save(epoch, trials)
        epoch += 1


def fit(train: DataFrame, validation: DataFrame, key: list[str], features: str, width: int, settings: FitSettings,
        checkpoint: str | None = None, initial: Weights | None = None) -> FitResult:
    """Train one model (see :func:`run_trials`), from ``initial`` weights where given.

    Returns the weights of the best epoch and the history ``(epoch, train_loss, val_loss, logged_at)``; the best epoch
    is -1 where there was nothing to learn from.
    """
    state, = run_trials(train, validation, key, features, [new_state(0, width, settings, initial)], checkpoint)
    if state.best is None:
        raise ValueError(f"no finite validation loss in {len(state.log)} epochs")
    history = (
        train.sparkSession.createDataFrame(state.log, "epoch int, train_loss double, val_loss double")
        .withColumn("logged_at", iso_millis(F.current_timestamp()))
    )
    return FitResult(state.best, history, state.best_epoch, settings, [state.weights, state.first, state.second])


def search_histories(train: DataFrame, validation: DataFrame, key: list[str], features: str, width: int, trials: DataFrame,
                     settings: FitSettings, initial: Weights | None = None, checkpoint: str | None = None) -> list[TrialState]:
    """Fit every parameter set (``trial, lr, batch_size, beta``); sets that cannot be fitted keep an empty history."""
    states = [new_state(r["trial"], width, replace(settings, lr=r["lr"], batch_size=int(r["batch_size"]), beta=r["beta"]), initial)
              for r in trials.collect()]
    able = [s for s in states if s.settings.batch_size >= 1]
    for at in range(0, len(able), TRIALS_PER_PASS):
        part = f"{checkpoint}/pass-{at // TRIALS_PER_PASS}" if checkpoint else None
        run_trials(train, validation, key, features, able[at:at + TRIALS_PER_PASS], part)
    return states


def random_search(train: DataFrame, validation: DataFrame, key: list[str], features: str, width: int,
                  trials: DataFrame, settings: FitSettings, max_failures: int = 3, initial: Weights | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Fit every drawn parameter set (``trial, lr, batch_size, beta``) and report its losses.

    All trials are fed from one pass of the rows per epoch (``TRIALS_PER_PASS`` at a time). The
    result is ``(trial, lr, batch_size, beta, epoch, train_loss, val_loss)`` at each trial's
    best epoch, the last three null without train rows; more than ``max_failures`` trials without a finite loss
    fail the search.
    """
    states = search_histories(train, validation, key, features, width, trials, settings, initial, checkpoint)
    good = [s for s in states if s.best is not None]
    failures = len(states) - len(good)
    if failures > max_failures or failures == len(states):
        raise RuntimeError(f"{failures} of {len(states)} trials failed")
    rows = [(s.number, s.settings.lr, float(s.settings.batch_size), s.settings.beta,
             *(s.log[s.best_epoch] if s.log else (None, None, None))) for s in good]
    return train.sparkSession.createDataFrame(
        rows, "trial int, lr double, batch_size double, beta double, epoch int, train_loss double, val_loss double")
