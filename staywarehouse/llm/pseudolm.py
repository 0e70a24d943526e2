"""LM scoring: masked pseudo-likelihood of a bidirectional window network, trained in numpy.

Tokens are code points. The network sees the classes (``charset``) of two tokens on each side of a
masked one, an edge class beyond the text, and predicts its class: embeddings, one hidden layer, a
softmax. A token's probability is that of its class times its share of the class, which is 1 for
the commonest code points. A text scores the sum of its tokens' conditional log-probabilities.

Training data are all windows of all texts: Spark counts the distinct ones and deals each count
out in shares of at most the mean count, so that no step holds a very common window alone. The
shares, at most twice as many as windows, go by hash to parts of about ``PART``. The network is
fitted by rounds of synchronous averaging: in each round every part passes over all its shares,
from the same weights, in steps of ``BATCH`` weighted by share, so parts and steps grow with the
number of distinct windows; a small part passes over its shares until it has taken ``STEPS``. The
weights are averaged part by part in tasks, ``FAN`` parts to one row for the driver. Every step is
seeded, so a task that is run again gives the same result.

Defined results: null and empty texts have no tokens and the score 0; without any text the
network stays as it was initialised. Repeated rows are scored each, and count each in training;
a text of any length is scored whole. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .charset import BITS, CLASSES, Alphabet, alphabet, code_points, windows
from .flat import Tally, runs
from .scratch import settled

SIDE, EMBED, HIDDEN = 2, 16, 48
ROUNDS, STEPS, BATCH, PART, FAN, RATE = 6, 80, 2048, 200_000, 64, 0.01


class Model(NamedTuple):
    """An alphabet, and the weights that predict its classes."""

    alphabet: Alphabet
    net: dict[str, np.ndarray]


def _start() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)
    wide = 2 * SIDE * EMBED
    return {name: (rng.standard_normal(shape) * scale).astype(np.float32) for name, shape, scale in (
        ("embed", (CLASSES, EMBED), 0.3), ("into", (wide, HIDDEN), wide ** -0.5),
        ("bias", (HIDDEN,), 0), ("out", (HIDDEN, CLASSES), HIDDEN ** -0.5), ("base", (CLASSES,), 0))}


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context tokens (n x 2 SIDE) and masked tokens of packed windows."""
    keys = keys.astype(np.int64)
    parts = [keys >> BITS * k & (CLASSES - 1) for k in range(2 * SIDE, -1, -1)]
    return np.stack(parts[:SIDE] + parts[SIDE + 1:], 1), parts[SIDE]


def _forward(net: dict, context: np.ndarray):
    x = net["embed"][context].reshape(len(context), -1)
    h = np.tanh(x @ net["into"] + net["bias"])
    z = h @ net["out"] + net["base"]
    z -= z.max(1, keepdims=True)
    return x, h, z - np.log(np.exp(z).sum(1, keepdims=True))


def log_p(net: dict, keys: np.ndarray, most: int = 50_000) -> np.ndarray:
    """The log-probability of the masked token of each packed window."""
    out = np.zeros(len(keys), np.float32)
    for a in range(0, len(keys), most):
        context, masked = _split(keys[a:a + most])
        out[a:a + most] = _forward(net, context)[2][np.arange(len(masked)), masked]
    return out


def _slope(net: dict, context: np.ndarray, masked: np.ndarray, weights: np.ndarray) -> dict:
    """The gradient of the mean weighted loss, -log P(masked token), by each weight."""
    x, h, log = _forward(net, context)
    dz = np.exp(log)
    dz[np.arange(len(masked)), masked] -= 1
    dz *= weights[:, None] / len(masked)
    dh = (dz @ net["out"].T) * (1 - h * h)
    dx = (dh @ net["into"].T).reshape(-1, EMBED)
    embed = (np.arange(CLASSES)[:, None] == context.reshape(-1)).astype(dx.dtype) @ dx
    return {"embed": embed, "into": x.T @ dh, "bias": dh.sum(0), "out": h.T @ dz,
            "base": dz.sum(0)}


def _steps(net: dict, keys: np.ndarray, weights: np.ndarray, seed: int, rate: float) -> dict:
    """``net`` after steps of Adam over all windows, weighted; STEPS at least."""
    rng = np.random.default_rng(seed)
    net = {k: v.copy() for k, v in net.items()}
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    weights = (weights / weights.mean()).astype(np.float32)
    passes = -(-STEPS // -(-len(keys) // BATCH))
    step = 0
    for _ in range(passes):
        order = rng.permutation(len(keys))
        for at in range(0, len(keys), BATCH):
            step += 1
            taken = order[at:at + BATCH]
            context, masked = _split(keys[taken])
            slope = _slope(net, context, masked, weights[taken])
            for name, g in slope.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                net[name] -= (rate * (first[name] / (1 - 0.9 ** step))
                              / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
                              ).astype(np.float32)
    return net


def _pack(net: dict) -> bytes:
    return b"".join(net[k].astype(np.float32).tobytes() for k in sorted(net))


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    flat, at, net = np.frombuffer(data, np.float32), 0, {}
    for name, like in sorted(_start().items()):
        net[name] = flat[at:at + like.size].reshape(like.shape).copy()
        at += like.size
    return net


def count(documents: DataFrame, signs: Alphabet) -> DataFrame:
    """(window, n): all windows of all texts."""
    def work(batches):
        tally = Tally()
        for batch in batches:
            for _, flat in runs(batch["text"]):
                found, at = code_points(flat)
                tally.add(windows(signs.look_up(found)[0], at, SIDE, SIDE).astype(np.uint64))
        keys, n = tally.total()
        for a in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a:a + 100_000].astype(np.int64)), pa.array(n[a:a + 100_000])],
                names=["window", "n"])

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(
        work, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))


def _parts(documents: DataFrame, signs: Alphabet) -> DataFrame:
    """(part, windows, weights): each part one row, its shares as packed arrays."""
    counted = settled(count(documents, signs), "windows")
    mean = counted.agg(F.avg("n")).first()[0] or 1.0
    shares = counted.withColumn("k", F.explode(F.expr(f"sequence(1L, cast(ceil(n / {mean}D) AS "
                                                      "bigint))"))) \
        .select("window", "k", F.expr(f"n / ceil(n / {mean}D)").cast("float").alias("weight"))
    parts = -(-shares.count() // PART) or 1

    def pack(table):
        keys, weights = table["window"].to_numpy(), table["weight"].to_numpy()
        order = np.argsort(keys, kind="stable")  # the shares of a window are alike
        return pa.table({"part": table["part"][:1], "windows": pa.array([keys[order].tobytes()]),
                         "weights": pa.array([weights[order].tobytes()])})

    dealt = shares.select("window", "weight", F.expr(f"pmod(xxhash64(window, k), {parts}L)").alias(
        "part")).repartitionByRange(parts, "part")
    return settled(dealt.groupBy("part").applyInArrow(
        pack, "part long, windows binary, weights binary"), "parts")


def _mean(table: pa.Table) -> pa.Table:
    """The weighted mean of some networks, added up in the order of their parts."""
    table = table.sort_by("part")
    nets, n = [np.frombuffer(x, np.float32) for x in table["net"].to_pylist()], table["n"]
    made = np.average(nets, axis=0, weights=n.to_numpy()).astype(np.float32)
    return pa.table({"part": table["part"][:1], "net": pa.array([made.tobytes()], pa.binary()),
                     "n": pa.array([float(n.to_numpy().sum())])})


def train(documents: DataFrame) -> Model:
    """The code points of all texts, and the weights fitted to their windows."""
    signs = alphabet(documents)
    parts = _parts(documents, signs)
    now = _pack(_start())
    for turn in range(ROUNDS):
        rate = RATE * (1 - turn / ROUNDS)

        def work(batches, turn=turn, now=now, rate=rate):
            for batch in batches:
                for part, keys, weights in zip(batch["part"], batch["windows"], batch["weights"]):
                    keys = np.frombuffer(keys.as_buffer(), np.int64)
                    weights = np.frombuffer(weights.as_buffer(), np.float32)
                    made = _steps(_unpack(now), keys, weights, turn * 1_000_003 + part.as_py(),
                                  rate)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.as_py()]), pa.array([_pack(made)], pa.binary()),
                         pa.array([float(weights.sum(dtype=np.float64))])],
                        names=["part", "net", "n"])

        kinds = "part long, net binary, n double"
        rows = parts.mapInArrow(work, kinds).groupBy(F.expr(f"part div {FAN}")).applyInArrow(
            _mean, kinds).toArrow()
        if not rows.num_rows:
            break
        now = _mean(rows)["net"][0].as_py()
    return Model(signs, _unpack(now))


def scored(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, log_likelihood (summed), mean_log_p (null without tokens)."""
    signs, net = train(documents) if model is None else model
    data = _pack(net)

    def work(batches):
        held = _unpack(data)
        known, values = np.zeros(0, np.int64), np.zeros(0, np.float32)
        for batch in batches:
            for first, flat in runs(batch["text"]):
                found, at = code_points(flat)
                own, shares = signs.look_up(found)
                keys, inverse = np.unique(windows(own, at, SIDE, SIDE), return_inverse=True)
                new = keys[~np.isin(keys, known, assume_unique=True)]
                if len(known) + len(new) > 4_000_000:
                    known, values, new = known[:0], values[:0], keys
                if len(new):
                    known = np.concatenate([known, new])
                    values = np.concatenate([values, log_p(held, new)])
                    order = np.argsort(known)
                    known, values = known[order], values[order]
                log = values[np.searchsorted(known, keys)][inverse] + shares
                owner = np.repeat(np.arange(len(flat)), np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(flat)),
                     pa.array(np.diff(at).astype(np.int64)),
                     pa.array(np.bincount(owner, log, len(flat)).astype(np.float64))],
                    names=["doc_id", "n_tokens", "log_likelihood"])

    doc = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        work, f"doc_id {doc}, n_tokens long, log_likelihood double")
    return rows.withColumn("mean_log_p", F.expr(
        "CASE WHEN n_tokens > 0 THEN log_likelihood / n_tokens END"))
