"""Code points as an alphabet of 128 classes fitted to a corpus, for character models.

Class 0 is the edge of a text. The commonest ``OWN`` code points of the corpus have a class each;
every other code point belongs to the class of its Unicode block (128 code points, by hash), in
which it has its share of the class: P(code point) = P(class) * share. So all code points are told
apart, and the chances over all of them add up to at most one. Code points that the corpus lacks
divide one count of their class among all that there are.

An alphabet has at most as many rows as Unicode has code points (1,114,112, 12 bytes each).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import Flat, Tally, runs
from .perplexity import POINTS, points

CLASSES, BITS, OWN = 128, 7, 95


class Alphabet:
    """Class and log share of every code point, from the counts of a corpus."""

    def __init__(self, points: np.ndarray, counts: np.ndarray):
        order = np.lexsort((points, -counts))
        self.points = np.asarray(points, np.int64)[order]
        self.counts = np.asarray(counts, np.int64)[order]
        # The last place stands for all code points above those of the corpus.
        size = int(self.points.max(initial=0)) + 2
        blocks = np.arange(size, dtype=np.uint32) >> np.uint32(7)
        spread = blocks * np.uint32(2654435761) >> np.uint32(16)
        self.first = OWN + 1
        self.classes = (self.first + spread % (CLASSES - self.first)).astype(np.uint8)
        own = self.points[:OWN]
        self.classes[own] = np.arange(1, len(own) + 1)
        rest, n = self.points[OWN:], self.counts[OWN:]
        total = np.bincount(self.classes[rest], n, CLASSES) + 1
        self.shares = -np.log(total[self.classes] * POINTS)
        self.shares[rest] = np.log(n / total[self.classes[rest]])
        self.shares[own] = 0
        self._total = total

    def __reduce__(self):
        return Alphabet, (self.points, self.counts)

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of every code point, and the log of its share of the class."""
        last = len(self.classes) - 1
        if found.max(initial=0) < last:
            return self.classes[found], self.shares[found]
        inside = np.minimum(found, last)
        classes, shares = self.classes[inside], self.shares[inside]
        above = found >= last
        spread = (found[above].astype(np.uint32) >> np.uint32(7)) * np.uint32(2654435761)
        classes[above] = self.first + (spread >> np.uint32(16)) % (CLASSES - self.first)
        shares[above] = -np.log(self._total[classes[above]] * POINTS)
        return classes, shares


def code_points(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and the offsets of the texts in them."""
    found, at = points(flat)
    return (found - np.uint64(1)).astype(np.int64), at


def alphabet(documents: DataFrame) -> Alphabet:
    """The code points of all texts, counted."""
    def work(batches):
        tally = Tally()
        for batch in batches:
            for _, flat in runs(batch["text"]):
                tally.add(code_points(flat)[0].astype(np.uint64))
        keys, n = tally.total()
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(n)],
                                         names=["point", "n"])

    rows = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(
        work, "point int, n long").groupBy("point").agg(F.sum("n").alias("n")).toArrow()
    return Alphabet(rows["point"].to_numpy(), rows["n"].to_numpy())


def windows(values: np.ndarray, at: np.ndarray, before: int, after: int) -> np.ndarray:
    """For every value the packed window around it, class 0 beyond the ends of its text."""
    n, texts = len(values), len(at) - 1
    owner = np.repeat(np.arange(texts), np.diff(at))
    # Texts are laid out with gaps of zeros as wide as a window reaches.
    gap = before + after
    spot = np.arange(n) + (owner + 1) * gap
    padded = np.zeros(n + (texts + 1) * gap, np.int64)
    padded[spot] = values
    out = np.zeros(n, np.int64)
    for shift in range(-before, after + 1):
        out = out << BITS | padded[spot + shift] if n else out
    return out
