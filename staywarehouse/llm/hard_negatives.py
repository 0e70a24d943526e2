"""Hard-negative mining by angular triangle filtering.

Every vector stores its angles to a few reference directions. The angle between two vectors is at
least the largest difference, and at most the least sum, of their angles to a reference; cosines of
the two ends, multiplied by the norms and widened by what rounding can do, bound the integer score.
Rows are sorted by their nearest reference and the angle to it and cut into slices. A slice is
scored only for the anchors whose windows (better than their worst hit so far; between two shares
of a positive's score) its bounds overlap, by an exact integer product.

Anchors lie in blocks of bounded size; every block meets all rows, dealt by hash to stripes, so no
label and no group of copies makes a larger task than any other. A task keeps the best few rows of
its anchors and only those are merged. All hits are exact: the references, fitted to a sample of
``SAMPLE`` rows, decide how much is skipped and nothing else.

Defined results: rows with a null id, label or vector, or a null or non-finite entry take no part;
shorter vectors count as filled up with zeros; rows equal in id, label and vector count once; rows
with one id are not each other's hits; a vector of zeros scores 0. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import settled
from .vectors import dimension, pack, unpack, whole

REFERENCES, SAMPLE, ROUNDS = 16, 4096, 8
#: Anchors of a block, about; rows that one task compares them with, about; stripes at least.
ANCHORS, STRIPE, STRIPES = 4096, 1 << 20, 16
#: Rows of a slice, and anchors that are scored with one at a time.
SLICE, CHUNK = 512, 1024
#: More than two stored angles (32-bit, of a rounded cosine) can be wrong together, in radians.
SLACK = 2e-6
_LEAST = np.iinfo(np.int64).min
_ROWS = 4096


def references(x: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit directions: means of the rows of ``x`` that lie nearest to one another."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1), 1)[:, None]
    if not len(unit):
        return np.zeros((0, x.shape[1]))
    made = unit[np.linspace(0, len(unit) - 1, min(count, len(unit))).astype(int)]
    for _ in range(ROUNDS):
        nearest = (unit @ made.T).argmax(1)
        sums = np.zeros_like(made)
        np.add.at(sums, nearest, unit)
        size = np.linalg.norm(sums, axis=1)
        made = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], made)
    size = np.linalg.norm(made, axis=1)
    return made[size > 0.5] / size[size > 0.5, None]


def angles(x: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the rows and their angles to the reference directions."""
    norm = np.sqrt((x.astype(float) ** 2).sum(1))
    cosine = x @ to.T / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def score_bounds(norm: np.ndarray, theta: np.ndarray, least: np.ndarray, most: np.ndarray,
                 low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (norm, theta) with rows whose norms lie in low..high.

    ``least`` and ``most`` are the ends of the rows' angles to each reference.
    """
    theta = theta.astype(float)
    near = np.maximum(theta - most, least - theta).max(1, initial=0) - SLACK
    added = np.where(theta + most <= np.pi, theta + most,
                     np.where(theta + least >= np.pi, 2 * np.pi - theta - least, np.pi))
    far = added.min(1, initial=np.pi) + SLACK
    top, bottom = np.cos(np.maximum(near, 0)), np.cos(np.minimum(far, np.pi))
    upper = norm * np.where(top >= 0, high, low) * top
    lower = norm * np.where(bottom >= 0, low, high) * bottom
    room = 1 + 1e-9 * norm * high
    return lower - room, upper + room


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``, exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most >= 2.0 ** 63:
        raise ValueError("scores do not fit 64-bit numbers")
    if most < 2.0 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


class Best:
    """The first ``k`` hits of every group: higher scores first, then smaller ids."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.full((groups, k), _LEAST)
        self.id = np.zeros((groups, k), np.int64)
        self.found = np.zeros(groups, np.int64)

    def worst(self) -> np.ndarray:
        """What a new hit of a group must reach."""
        return self.score[:, -1]

    def offer(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        own = np.unique(group)
        old = np.arange(self.k) < self.found[own, None]
        group = np.concatenate([group, np.repeat(own, self.found[own])])
        score = np.concatenate([score, self.score[own][old]])
        id_ = np.concatenate([id_, self.id[own][old]])
        order = np.lexsort((id_, -score, group))
        group, score, id_ = group[order], score[order], id_[order]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        kept = place < self.k
        group, place = group[kept], place[kept]
        self.score[group, place], self.id[group, place] = score[kept], id_[kept]
        self.found[own] = np.bincount(group, minlength=len(self.found))[own]


class Rows:
    """Some rows of the index as arrays."""

    def __init__(self, batches: list[pa.RecordBatch], size: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.table = table
        self.no, self.id, self.label = (table[c].to_numpy() for c in ("no", "id", "label"))
        self.norm = table["norm"].to_numpy()
        self.x = unpack(table["x"].combine_chunks(), size)
        held = b"".join(table["angles"].to_pylist())
        self.theta = np.frombuffer(held, np.float32).reshape(len(table), -1)

    def slices(self) -> Iterator[slice]:
        return (slice(i, i + SLICE) for i in range(0, len(self.no), SLICE))


class Positives:
    """Keeps the best rows of an anchor's label."""

    columns = "no long, id long, score long"

    def __init__(self, anchors: Rows, k: int):
        self.anchors, self.best = anchors, Best(len(anchors.no), k)

    def open(self, lower: np.ndarray, upper: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return (upper >= self.best.worst()) & np.isin(self.anchors.label, labels)

    def take(self, own: np.ndarray, rows: Rows, part: slice, found: np.ndarray) -> None:
        anchors = self.anchors
        hit = (found >= self.best.worst()[own, None]) \
            & (anchors.label[own, None] == rows.label[part]) \
            & (anchors.id[own, None] != rows.id[part])
        a, b = np.nonzero(hit)
        self.best.offer(own[a], found[a, b], rows.id[part][b])

    def result(self) -> list[pa.Array]:
        group, place = np.nonzero(np.arange(self.best.k) < self.best.found[:, None])
        return [pa.array(self.anchors.no[group]), pa.array(self.best.id[group, place]),
                pa.array(self.best.score[group, place])]


class Negatives:
    """Keeps, for each positive of an anchor, the best rows of other labels in its window."""

    columns = "no long, place int, id long, score long"

    def __init__(self, anchors: Rows, k: int, low: int, high: int):
        self.anchors = anchors
        found = anchors.table["positives"].to_pylist()
        self.width = max((len(p) for p in found), default=0)
        # A window that no score is in stands for a positive that an anchor does not have.
        self.low = np.ones((len(found), self.width), np.int64)
        self.high = np.zeros((len(found), self.width), np.int64)
        for i, own in enumerate(found):
            for j, score in enumerate(own):
                self.low[i, j] = -(-low * score // 100)
                self.high[i, j] = high * score // 100
        self.best = Best(len(found) * self.width, k)

    def _least(self) -> np.ndarray:
        return np.maximum(self.low, self.best.worst().reshape(self.low.shape))

    def open(self, lower: np.ndarray, upper: np.ndarray, labels: np.ndarray) -> np.ndarray:
        windows = (self.low <= self.high) & (upper[:, None] >= self._least()) \
            & (lower[:, None] <= self.high)
        return windows.any(1)

    def take(self, own: np.ndarray, rows: Rows, part: slice, found: np.ndarray) -> None:
        least = self._least()
        other = self.anchors.label[own, None] != rows.label[part]
        other &= self.anchors.id[own, None] != rows.id[part]
        for j in range(self.width):
            hit = other & (found >= least[own, j, None]) & (found <= self.high[own, j, None])
            a, b = np.nonzero(hit)
            self.best.offer(own[a] * self.width + j, found[a, b], rows.id[part][b])

    def result(self) -> list[pa.Array]:
        group, place = np.nonzero(np.arange(self.best.k) < self.best.found[:, None])
        return [pa.array(self.anchors.no[group // max(self.width, 1)]),
                pa.array(group % max(self.width, 1), pa.int32()),
                pa.array(self.best.id[group, place]), pa.array(self.best.score[group, place])]


def _compared(keeper, rows: Rows) -> None:
    """Offer ``rows`` to the anchors of ``keeper``, slice by slice."""
    anchors = keeper.anchors
    for part in rows.slices():
        theta, norm = rows.theta[part].astype(float), rows.norm[part]
        lower, upper = score_bounds(anchors.norm, anchors.theta, theta.min(0), theta.max(0),
                                    norm.min(), norm.max())
        own = np.flatnonzero(keeper.open(lower, upper, np.unique(rows.label[part])))
        for first in range(0, len(own), CHUNK):
            some = own[first:first + CHUNK]
            keeper.take(some, rows, part, scores(anchors.x[some], rows.x[part]))


def _searched(anchors: DataFrame, rows: DataFrame, blocks: int, stripes: int, size: int,
              made, columns: str) -> DataFrame:
    """What ``made(anchors)`` keeps of all ``rows``, from every block of anchors and stripe.

    Anchors go to all stripes of their block, rows to their stripe of every block. A partition
    is sorted so that the anchors of a block and stripe come before its rows, by their angles.
    """
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    stripe = F.pmod(F.xxhash64("id", "x"), F.lit(stripes))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))  # noqa: E731, E501
    left = anchors.withColumn("kind", F.lit(0)).withColumn("stripe", every(stripes)) \
        .withColumn("cell", block * stripes + F.col("stripe")).drop("stripe")
    right = rows.withColumn("kind", F.lit(1)).withColumn("block", every(blocks)) \
        .withColumn("cell", F.col("block") * stripes + stripe).drop("block")
    dealt = left.unionByName(right, allowMissingColumns=True) \
        .repartition(blocks * stripes, "cell") \
        .sortWithinPartitions("cell", "kind", "nearest", "near")

    def work(batches: Iterator[pa.RecordBatch]):
        cell, waiting, keeper = None, [], None

        def done():
            return [] if keeper is None else [pa.RecordBatch.from_arrays(
                keeper.result(), names=[c.split()[0] for c in columns.split(", ")])]

        for batch in batches:
            key = pc.add(pc.multiply(batch["cell"], 2), batch["kind"].cast(pa.int64())).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for first, last in zip(cut, cut[1:]):
                if first == last:
                    continue
                own, part = int(key[first]), batch.slice(first, last - first)
                if own // 2 != cell:
                    yield from done()
                    cell, waiting, keeper = own // 2, [], None
                if own % 2 == 0:
                    waiting.append(part)
                    continue
                if waiting:
                    keeper, waiting = made(Rows(waiting, size)), []
                if keeper is not None:
                    for at in range(0, len(part), _ROWS):
                        _compared(keeper, Rows([part.slice(at, _ROWS)], size))
        yield from done()

    return dealt.mapInArrow(work, columns)


def indexed(df: DataFrame, id: str, label: str, vector: str, anchor: Column) -> DataFrame:
    """The rows that take part, packed, numbered, with their norms and angles, written down."""
    size = dimension(df, vector)
    given = df.select(F.col(f"`{id}`").cast("long").alias("id"),
                      F.col(f"`{label}`").cast("long").alias("label"),
                      F.coalesce(anchor, F.lit(False)).alias("anchor"),
                      F.col(f"`{vector}`").alias("v")).where(
        "id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    def packed(batches):
        for batch in batches:
            for first in range(0, len(batch), _ROWS):
                part = batch.slice(first, _ROWS)
                kept, x = whole(part["v"], size)
                kept = pa.array(kept)
                yield pa.RecordBatch.from_arrays(
                    [part[c].take(kept) for c in ("id", "label", "anchor")]
                    + [pa.array(pack(x), pa.binary())], names=["id", "label", "anchor", "x"])

    rows = given.mapInArrow(packed, "id long, label long, anchor boolean, x binary")
    sample = rows.select("x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE).collect()
    to = references(unpack(pa.array([bytes(r.x) for r in sample], pa.binary()), size))

    def measured(batches):
        for batch in batches:
            for first in range(0, len(batch), _ROWS):
                part = batch.slice(first, _ROWS)
                norm, theta = angles(unpack(part["x"], size), to)
                nearest = theta.argmin(1) if theta.shape[1] else np.zeros(len(part), np.int64)
                near = theta.min(1, initial=4)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(norm), pa.array([t.tobytes() for t in theta],
                                                             pa.binary()),
                     pa.array(nearest, pa.int32()), pa.array(near, pa.float32())],
                    names=[*part.schema.names, "norm", "angles", "nearest", "near"])

    done = rows.distinct().mapInArrow(
        measured, "id long, label long, anchor boolean, x binary, norm double, angles binary, "
                  "nearest int, near float")
    return settled(done.withColumn("no", F.monotonically_increasing_id()), "angles")


def mine(df: DataFrame, id: str, label: str, vector: str, anchor: Column, positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` is true.

    An anchor's positives are the rows of its label with the ``positives`` highest scores; a
    positive's negatives the ``negatives`` highest rows of other labels that score between
    ``low`` and ``high`` hundredths of it. Columns: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. Ids and labels are whole numbers.
    """
    size = dimension(df, vector)
    index = indexed(df, id, label, vector, anchor)
    total, chosen = index.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(1, -(-chosen // ANCHORS))
    stripes = max(STRIPES, -(-total // STRIPE))
    rows, anchors = index.drop("anchor"), index.where("anchor").drop("anchor")

    found = _searched(anchors, rows, blocks, stripes, size,
                      lambda own: Positives(own, positives), Positives.columns)
    line = Window.partitionBy("no").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(line) - 1) \
        .where(F.col("place") < positives)
    found = settled(found, "positives")
    lists = found.groupBy("no").agg(
        F.array_sort(F.collect_list(F.struct("place", "score")))["score"].alias("positives"))
    least = _searched(anchors.join(lists, "no"), rows, blocks, stripes, size,
                      lambda own: Negatives(own, negatives, low, high), Negatives.columns)
    line = Window.partitionBy("no", "place").orderBy(F.desc("score"), "id")
    least = least.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= negatives)
    named = found.select("no", "place", F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return least.join(named, ["no", "place"]) \
        .join(anchors.select("no", F.col("id").alias("anchor_id")), "no") \
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"))


def report(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), "embedding")
    return mine(rows, "vec_id", "label", "embedding", F.col("vec_id") % 50 == 0)
