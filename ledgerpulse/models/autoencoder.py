"""Autoencoder trained as one model by Adam, a step for each mini-batch.

Batches are dealt by a hash of the row's id and the epoch, so they do not depend on partitions. A step needs the
weights of the step before, so steps run one after another. Summing gradients over tasks takes Spark a second for each
batch, a step over 64 rows a tenth of a millisecond: one task goes through all batches, with its rows in memory or,
if they are many, in files of its own. Only batches of ``TASK_ROWS`` rows a task or more are worth an exchange: then all tasks of
an epoch run at once (a barrier stage), each adds up the gradient of its rows, and every task moves its copy of the weights
alike. If a task is lost, Spark repeats the epochs of its job.
"""

import base64
import math
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.models.base import Detector, inputs, share

HIDDEN = 12
PATIENCE = 10
TASK_ROWS = 100_000      # rows of a batch for one task, as far as there are cores
HELD_BYTES = 128 << 20   # rows that a task keeps in memory
BLOCK = 10_000           # rows looked up at a time
# The usual Adam decay rates and epsilon.
BETA1, BETA2, ADAM_EPS = 0.9, 0.999, 1e-7
ZERO = np.zeros(())      # an array, because a number would be made one at every call
# The numbers of xxHash64.
PRIME1, PRIME2, PRIME3, PRIME5 = (np.uint64(v) for v in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def hashed_on(hashes: np.ndarray, value: int) -> np.ndarray:
    """Spark's ``xxhash64(..., value)`` for an int, from its hashes of the arguments before."""
    turned = lambda h, n: (h << np.uint64(n)) | (h >> np.uint64(64 - n))
    h = hashes.astype(np.int64).view(np.uint64) + PRIME5 + np.uint64(4)
    h = turned(h ^ (np.array([value & 0xFFFFFFFF], dtype=np.uint64) * PRIME1), 23) * PRIME2 + PRIME3
    h = (h ^ (h >> np.uint64(33))) * PRIME2
    h = (h ^ (h >> np.uint64(29))) * PRIME3
    return (h ^ (h >> np.uint64(32))).view(np.int64)


class Network:
    """in -> 12 -> latent -> 12 -> in, ReLU inside, linear output; parameters in one flat vector."""

    def __init__(self, width: int, latent: int):
        sizes = [width, HIDDEN, latent, HIDDEN, width]
        self.shapes = list(zip(sizes[:-1], sizes[1:]))
        self.size = sum(a * b + b for a, b in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        parts = []
        for a, b in self.shapes:
            limit = np.sqrt(6.0 / (a + b))
            parts += [rng.uniform(-limit, limit, a * b), np.zeros(b)]
        return np.concatenate(parts)

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in self.shapes:
            out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
            at += a * b + b
        return out

    def forward(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Input and the activation of every layer."""
        seen = [x]
        layers = self.layers(flat)
        for i, (w, b) in enumerate(layers):
            z = seen[-1] @ w + b
            seen.append(z if i == len(layers) - 1 else np.maximum(z, 0.0))
        return seen

    def gradient(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Gradient of the mean squared reconstruction error."""
        return self.gradient_sum(flat, x) / len(x)

    def gradient_sum(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Sum of the rows' gradients."""
        training = Training(self, np.stack([flat, flat, flat]), 0.0)
        training.add(np.c_[x, np.ones(len(x))])
        return training.sum

    def joined(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of each layer's weights with its biases as the last row."""
        cuts = np.cumsum([0, *[(a + 1) * b for a, b in self.shapes]])
        return [flat[low:high].reshape(a + 1, b) for low, high, (a, b) in zip(cuts, cuts[1:], self.shapes)]


class Training:
    """Weights and both moments, moved in place by one batch after another.

    A batch is small, so what counts is the number of array calls: all write into arrays that are used again. Activations
    have a column for each row of data; below each layer's input stands a row of ones, whose products are the biases.
    """

    def __init__(self, network: Network, state: np.ndarray, lr: float):
        self.network, self.state, self.lr = network, state.copy(), lr
        self.sum, self.more, self.spare = (np.zeros(network.size) for _ in range(3))
        self.rows = 0                                    # those the sum is over
        layers = network.joined(self.state[0])
        self.forth, self.back = [w.T for w in layers], [w[:-1] for w in layers]
        self.into, self.beside = network.joined(self.sum), network.joined(self.more)
        self.room: dict[int, tuple] = {}
        self.half = np.array(network.shapes[0][0] / 2)
        self.numbers = [np.array(v) for v in (BETA1, 1 - BETA1, BETA2, 1 - BETA2, ADAM_EPS)]

    def _arrays(self, n: int) -> tuple[list, list, list]:
        """For ``n`` rows: outputs of the layers, inputs of all but the first, and errors below all but the first."""
        if n not in self.room:
            inner = [b for _, b in self.network.shapes[:-1]]
            arrays = ([np.empty((b, n)) for _, b in self.network.shapes], [np.ones((b + 1, n)) for b in inner],
                      [np.empty((b, n)) for b in inner])
            if n > 256:
                return arrays
            self.room[n] = arrays
        return self.room[n]

    def add(self, x: np.ndarray) -> None:
        """Add the gradient of these rows, which have a last column of ones."""
        outs, ins, errors = self._arrays(len(x))
        seen = [x.T, *ins]
        last, into = len(outs) - 1, self.beside if self.rows else self.into
        for i in range(last):
            np.dot(self.forth[i], seen[i], out=outs[i])
            np.maximum(outs[i], ZERO, out=seen[i + 1][:-1])
        error = np.dot(self.forth[last], seen[last], out=outs[last])
        np.subtract(error, seen[0][:-1], out=error)
        np.divide(error, self.half, out=error)
        for i in range(last, -1, -1):
            np.dot(seen[i], error.T, out=into[i])
            if i:
                error = np.dot(self.back[i], error, out=errors[i - 1])
                np.multiply(error, np.sign(seen[i][:-1], out=outs[i - 1]), out=error)
        if self.rows:
            np.add(self.sum, self.more, out=self.sum)
        self.rows += len(x)

    def step(self, t: int) -> None:
        """The ``t``-th step, by the mean of the gradients added since the last."""
        (w, m, v), g, spare = self.state, self.sum, self.spare
        beta1, rest1, beta2, rest2, eps = self.numbers
        g /= self.rows
        m *= beta1
        m += np.multiply(g, rest1, out=spare)
        v *= beta2
        np.multiply(g, rest2, out=spare)
        spare *= g
        v += spare
        np.multiply(m, self.lr * (math.sqrt(1 - BETA2 ** t) / (1 - BETA1 ** t)), out=spare)
        np.sqrt(v, out=g)
        g += eps
        spare /= g
        w -= spare
        self.rows = 0

    def epoch(self, blocks: Iterator[tuple[np.ndarray, np.ndarray]], batches: int, before: int,
              exchange: Callable | None = None) -> None:
        """All batches in turn, from (batch, x) of rows sorted by batch; ``before`` is the number of earlier steps."""
        now = 0

        def close() -> None:
            nonlocal now
            if exchange:
                exchange()
            now += 1
            if self.rows:            # a batch may be empty by its hash
                self.step(before + now)

        for batch, x in blocks:
            cut = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(x)]
            for low, high, b in zip(cut, cut[1:], batch[cut[:-1]].tolist()):
                while now < b:
                    close()
                self.add(x[low:high])
        while now < batches:
            close()


class Kept:
    """Tickets and inputs of a task's rows: in memory up to ``held`` bytes, else in a file that goes with the task."""

    def __init__(self, width: int, held: int):
        self.kind = np.dtype([("ticket", "i8"), ("x", "f8", (width,))])
        self.held, self.parts, self.n, self.file = held, [], 0, None

    def add(self, records: np.ndarray) -> None:
        self.parts.append(records)
        self.n += len(records)
        if sum(r.nbytes for r in self.parts) > self.held:
            self.file = self.file or tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
            self._flush()

    def _flush(self) -> None:
        for r in self.parts:
            self.file.write(r.tobytes())
        self.parts = []

    def chunks(self) -> Iterator[np.ndarray]:
        if self.file is None:
            yield from self.parts
            return
        self._flush()
        self.file.seek(0)
        while raw := self.file.read(BLOCK * self.kind.itemsize):
            yield np.frombuffer(raw, self.kind)
        self.file.seek(0, os.SEEK_END)

    def sorted(self) -> np.ndarray:
        """All records by ticket, in memory."""
        records = np.concatenate([np.empty(0, self.kind), *self.chunks()])
        return records[np.argsort(records["ticket"], kind="stable")]

    def _split(self, deal: Callable, batches: int) -> Iterator[np.ndarray]:
        """The records of one span of batches after another, each small enough for memory."""
        count = self.n * self.kind.itemsize // self.held + 1
        spans = [Kept(self.kind["x"].shape[0], self.held // count) for _ in range(count)]
        for chunk in self.chunks():
            span = deal(chunk["ticket"]) * count // batches
            order = np.argsort(span, kind="stable")
            ends = np.searchsorted(span[order], np.arange(count + 1))
            for i in np.flatnonzero(np.diff(ends)):
                spans[i].add(chunk[order[ends[i]:ends[i + 1]]])
        while spans:
            yield spans.pop(0).sorted()

    def dealt(self, deal: Callable, batches: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(batch, x) of all records by batch, then ticket, a block at a time."""
        if self.file is None and len(self.parts) != 1:
            self.parts = [self.sorted()]
        for records in self.parts if self.file is None else self._split(deal, batches):
            batch = deal(records["ticket"])
            order = np.sort((batch << 32) + np.arange(len(batch))) & 0xFFFFFFFF
            for low in range(0, len(order), BLOCK):
                at = order[low:low + BLOCK]
                yield batch[at], records["x"][at]


class Autoencoder(Detector):
    """Score: mean squared reconstruction error. Explanation: share of each squared error."""

    name = "ae"

    def __init__(self, columns=None, latent: int = 6, lr: float = 0.001, epochs: int = 10,
                 batch_size: int = 64, validation_split: float = 0.1, seed: int = 42):
        kwargs = {} if columns is None else {"columns": columns}
        super().__init__(**kwargs, latent=latent, lr=lr, epochs=epochs, batch_size=batch_size,
                         validation_split=validation_split, seed=seed)
        self.network = Network(len(self.columns), latent)
        self.weights = self.network.start(seed)
        self.losses: list[float] = []

    def fit(self, df, id_col="TransactionID", written=False):
        p = self.params
        rows = self.training_rows(df, id_col, written).withColumn("_ticket", F.xxhash64("_id", F.lit(p["seed"])))
        n = rows.where(F.pmod("_ticket", F.lit(10_000)) >= self._held_out()).count()
        tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, p["batch_size"] // TASK_ROWS))
        batches = max(1, -(-n // p["batch_size"]))
        state = np.stack([self.weights, np.zeros(self.network.size), np.zeros(self.network.size)])
        best, best_loss, waited, passes = state[0], float("inf"), 0, []
        for epoch in range(p["epochs"] + 1):
            # a pass measures the weights it starts from, then trains; the last only measures
            if not passes and tasks == 1:
                due = PATIENCE - waited + (epoch == 0)       # so many are sure to be needed
                passes = self._alone(rows, state, range(epoch, min(epoch + due, p["epochs"] + 1)), batches)
            elif not passes:
                passes = [self._together(rows, state, epoch, batches, tasks)]
            after, loss = passes.pop(0)
            self.losses.append(loss)
            if math.isnan(loss):
                if not np.isfinite(state[0]).all():
                    raise ValueError("the weights diverged; choose a lower learning rate")
                best = state[0]      # no held-out rows to choose an epoch by: keep the last state
            elif epoch and loss < best_loss:
                best, best_loss, waited = state[0], loss, 0
            elif epoch:
                waited += 1
            if waited >= PATIENCE:
                break
            state = after
        self.weights = best
        return self

    def _held_out(self) -> int:
        """Rows whose ticket modulo 10,000 is below this are held out."""
        return int(10_000 * self.params["validation_split"])

    def _squared(self, weights: np.ndarray, x: np.ndarray) -> float:
        return float(((self.network.forward(weights, x)[-1] - x) ** 2).mean(axis=1).sum())

    def _alone(self, rows: DataFrame, state: np.ndarray, epochs: range, batches: int) -> list[tuple[np.ndarray, float]]:
        """(state, validation loss) after each of these epochs, which one task runs; the driver sees one state of each."""
        shipped = rows.sparkSession.sparkContext.broadcast((self, state))

        def work(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, start = shipped.value
            p, width = model.params, len(model.columns) + 1
            held, train = Kept(width, HELD_BYTES // 4), Kept(width, HELD_BYTES)
            for block in blocks:
                records = np.ones(len(block), train.kind)
                records["ticket"] = block.column(0).to_numpy()
                for j, column in enumerate(block.columns[1:]):
                    records["x"][:, j] = column.to_numpy()
                out = records["ticket"] % 10_000 < model._held_out()
                held.add(records[out])
                train.add(records[~out])
            training = Training(model.network, start, p["lr"])
            for epoch in epochs:
                loss = sum(model._squared(training.state[0], c["x"][:, :-1]) for c in held.chunks())
                if epoch < p["epochs"]:
                    deal = lambda ticket: hashed_on(ticket, epoch) % batches
                    training.epoch(train.dealt(deal, batches), batches, epoch * batches)
                yield pa.record_batch([pa.array([epoch], pa.int32()), pa.array([training.state.tobytes()]),
                                       pa.array([loss / held.n if held.n else math.nan])], ["epoch", "state", "loss"])

        found = (rows.select("_ticket", *self.columns).coalesce(1)
                 .mapInArrow(work, "epoch int, state binary, loss double").collect())
        return [(np.frombuffer(r["state"]).reshape(3, -1).copy(), r["loss"]) for r in sorted(found)]

    def _together(self, rows: DataFrame, state: np.ndarray, epoch: int, batches: int, tasks: int) -> tuple[np.ndarray, float]:
        """The same for one epoch of several tasks that exchange their gradients after each batch."""
        shipped = rows.sparkSession.sparkContext.broadcast((self, state))
        dealt = F.when(F.pmod("_ticket", F.lit(10_000)) < self._held_out(), F.lit(-1)).otherwise(
            F.pmod(F.xxhash64("_id", F.lit(self.params["seed"]), F.lit(epoch)), F.lit(batches)))

        def work(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            context = BarrierTaskContext.get()
            model, start = shipped.value
            training, loss, held = Training(model.network, start, model.params["lr"]), 0.0, 0

            def exchange() -> None:
                own = np.r_[training.sum, training.rows] if training.rows else np.zeros(len(training.sum) + 1)
                sums = context.allGather(base64.b64encode(own.tobytes()).decode())
                own = np.sum([np.frombuffer(base64.b64decode(x)) for x in sums], axis=0)
                training.sum[:], training.rows = own[:-1], int(own[-1])

            def to_train() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                nonlocal loss, held
                for block in blocks:
                    batch = block["_batch"].to_numpy()
                    x = np.c_[block.drop(columns="_batch").to_numpy(dtype=float), np.ones(len(block))]
                    out = int(np.searchsorted(batch, 0))
                    loss, held = loss + model._squared(start[0], x[:out, :-1]), held + out
                    if out < len(x):
                        yield batch[out:], x[out:]

            if epoch < model.params["epochs"]:
                training.epoch(to_train(), batches, epoch * batches, exchange)
            else:
                for _ in to_train():
                    pass
            state = training.state.tobytes() if context.partitionId() == 0 else None
            yield pd.DataFrame({"state": [state], "loss": [loss], "held": [held]})

        spread = (rows.withColumn("_batch", dealt).repartition(tasks, "_id")
                  .sortWithinPartitions("_batch", "_id").select("_batch", *self.columns))
        found = spread.mapInPandas(work, "state binary, loss double, held bigint", barrier=True).collect()
        held = sum(r["held"] for r in found)
        state = next(bytes(r["state"]) for r in found if r["state"] is not None)
        return (np.frombuffer(state).reshape(3, -1).copy(),
                sum(r["loss"] for r in found) / held if held else float("nan"))

    def explain_block(self, x):
        squared = (x - self.network.forward(self.weights, x)[-1]) ** 2
        return squared.mean(axis=1), share(squared)

    def encode_block(self, x: np.ndarray) -> np.ndarray:
        return self.network.forward(self.weights, x)[2]

    def encode(self, df: DataFrame, prefix: str = "z") -> DataFrame:
        """Adds the latent representation as columns ``z0``, ``z1``, ..."""
        shipped = df.sparkSession.sparkContext.broadcast((self.network, self.weights))

        @F.pandas_udf("array<double>")
        def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            network, weights = shipped.value
            for block in blocks:
                yield pd.Series(list(network.forward(weights, block.to_numpy(dtype=float))[2]))

        coded = df.withColumn("_latent", run(F.struct(*inputs(df, self.columns))))
        return coded.withColumns({f"{prefix}{i}": F.col("_latent")[i]
                                  for i in range(self.params["latent"])}).drop("_latent")

    def latent_columns(self, prefix: str = "z") -> list[str]:
        return [f"{prefix}{i}" for i in range(self.params["latent"])]

    def arrays(self):
        return {"weights": self.weights[None, :]}

    def restore(self, arrays):
        self.weights = arrays["weights"][0]
