"""Toxicity by class-conditional Kneser-Ney models over words and word pairs.

For toxic and ordinary training texts Spark counts continuations: after how many different words
a pair of words occurs, and after how many different words a word does. Counts of continuations
instead of occurrences are Kneser-Ney's, and here also keep copies of a text from weighing as much
as independent texts. A pair backs off to the words of its class, a word to its
stem (its first ``STEM`` characters) in its class, and a stem to counts that both classes share:
in how many classes and halves of the data it occurs. Fewer than ``EVIDENCE`` continuations are no
evidence, and the order below weighs as much as ``WORD_STRENGTH`` of them, so that a text is not
told by its own chance words. A text's score is a logistic of the difference of its two
log-likelihoods, normalised by its length (per word, and per root of words; in all, and of the
words above a margin), fitted on training texts that models of the other half of them score.

The models are fitted on a sample of about ``SAMPLE`` labelled rows of the rarer class at most and
``BALANCE`` times as many of the other, drawn by hash of doc_id. Every expression of the sample
with evidence is held; a sample of such long texts that there are over ``EXPRESSIONS`` is halved
until its expressions fit. This bounds what the driver and the executors hold.
Every text is scored, whole.

Defined results: a text without words (null, empty) gets the score of a difference of 0; without
evidence in both classes every score is 0. Of repeated labels of one doc_id, a toxic mark counts;
rows without label or doc_id are scored and train nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .flat import Flat, WORD, chain, hashes, mix, runs, spans
from .scratch import settled

THRESHOLD = 0.5
#: Labelled rows of the rarer class in the sample, and rows of the other for each of them.
SAMPLE, BALANCE = 3_000, 4.0
EXPRESSIONS = 2_000_000
#: Continuations that an expression must have to be evidence.
EVIDENCE = 3
#: Characters of a stem.
STEM = 5
#: How many continuations the backoff counts for: of a word, and of a pair's first word.
WORD_STRENGTH, PAIR_STRENGTH = 10.0, 100.0
#: The ratio of a word above which it tells more than its language or subject do.
MARGIN = 2.0

_ORDER = np.uint64(3)


def _marked(values: np.ndarray, order: int) -> np.ndarray:
    """Hashes with the order of the expression in the last two bits."""
    return values & ~_ORDER | np.uint64(order)


def _expressions(flat: Flat):
    """Words, their stems and texts, pairs, and the places of the pairs' first words."""
    flat = flat.lower()
    starts, ends, texts = spans(flat, WORD)
    words = _marked(hashes(flat.data, starts, ends), 0)
    heads = np.append(np.flatnonzero((flat.data & 0xC0) != 0x80), len(flat.data))
    stop = np.minimum(np.searchsorted(heads, starts) + STEM, len(heads) - 1)
    stems = _marked(hashes(flat.data, starts, np.minimum(ends, heads[stop])), 3)
    pairs, at = chain(words, texts, 2)
    return words, stems, texts, _marked(pairs, 1), at


def _continuations(labelled: DataFrame) -> DataFrame:
    """Pairs with their two words, and their continuations by part, from (text, part).

    A pair at the begin of a text continues nothing, which counts as a word of its own.
    """
    def work(batches):
        for batch in batches:
            part = batch["part"].to_numpy(zero_copy_only=False)
            for first, flat in runs(batch["text"]):
                words, stems, texts, pairs, at = _expressions(flat)
                inner = (at > 0) & (texts[at - 1] == texts[at])
                left = np.where(inner, words[at - 1], np.uint64(0))
                group = part[first + texts[at]]
                whole = mix(pairs ^ mix(left + np.uint64(5))) ^ group.astype(np.uint64)
                own = np.unique(whole, return_index=True)[1]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[own].view(np.int64))
                       for x in (whole, pairs, words[at], words[at + 1], stems[at + 1])],
                     pa.array(group[own].astype(np.int8))],
                    names=["whole", "pair", "head", "word", "stem", "part"])

    rows = labelled.mapInArrow(work, "whole long, pair long, head long, word long, stem long, part byte")
    kept = ("pair", "head", "word", "stem")
    once = rows.groupBy("whole", "part").agg(*[F.min(c).alias(c) for c in kept])
    return once.groupBy(*kept).agg(
        *[F.sum((F.col("part") == g).cast("int")).cast("int").alias(f"n{g}") for g in range(4)])


def _counts(labelled: DataFrame, most: int) -> list[np.ndarray] | None:
    """Expression, its first word (pairs) or stem (words), and continuations by half and class.

    labelled: text, part (2 x half + class). None if there are more than ``most`` expressions.
    """
    pairs = settled(_continuations(labelled), "pairs")
    by = [f"n{g}" for g in range(4)]
    words = settled(pairs.groupBy("word", "stem").agg(
        *[F.sum((F.col(c) > 0).cast("int")).cast("int").alias(c) for c in by]), "words")
    stems = words.groupBy("stem").agg(*[F.sum(c).cast("int").alias(c) for c in by])
    heads = pairs.groupBy("head").agg(*[F.sum(c).cast("int").alias(c) for c in by])
    evidence = f"n0 + n1 + n2 + n3 >= {EVIDENCE}"
    rows = settled(
        pairs.where(evidence).select("pair", "head", *by)
        .union(words.where(evidence).select("word", "stem", *by))
        .union(stems.where(evidence).select("stem", F.lit(0).cast("long"), *by))
        .union(heads.where(evidence).select(F.col("head").bitwiseOR(F.lit(2)),
                                            F.lit(0).cast("long"), *by))
        .toDF("key", "head", *by), "expressions")
    if rows.count() > most:
        return None
    got = rows.toArrow()
    return [got[c].to_numpy() for c in ("key", "head", *by)]


def _discount(n: np.ndarray) -> float:
    """The Kneser-Ney discount of some counts."""
    one, two = max(int((n == 1).sum()), 1), int((n == 2).sum())
    return max(one / (one + 2 * two), 0.5)


class Model:
    """Log-likelihood ratios, toxic over ordinary: of words, of pairs, of stems, and of pairs' backoffs.

    Expressions that are not held have the ratio of their backoff, which is 0 for stems.
    """

    def __init__(self, key: np.ndarray, head: np.ndarray, ordinary: np.ndarray,
                 toxic: np.ndarray, parts: np.ndarray, strength: float = WORD_STRENGTH,
                 margin: float = MARGIN):
        self.strength, self.margin = strength, margin
        order = np.argsort(key.view(np.uint64))
        key, head = key.view(np.uint64)[order], head.view(np.uint64)[order]
        n = [ordinary[order], toxic[order]]
        kind = key & _ORDER
        word, pair, first, stem = (np.flatnonzero(kind == k) for k in range(4))
        self.words, self.pairs, self.firsts, self.stems = (
            key[x] for x in (word, pair, first, stem))
        # Shared backoff of stems: in how many of the classes and halves one occurs, not how
        # often, so that a frequent one of one class is not backed up in the other.
        shared = parts[order][stem] / max(parts[order][stem].sum(), 1)
        stem_at, has_stem = self._at(self.stems, head[word])
        within = parts[order][word] / np.maximum(np.bincount(
            stem_at, parts[order][word], max(len(stem), 1))[stem_at], 1)
        p_stem, p_word = [], []
        for own in n:
            p = self._backed(own[stem], shared)
            p_stem.append(p)
            below = np.where(has_stem, (p[stem_at] if len(stem) else 1) * within, 0)
            p_word.append(self._backed(own[word], np.maximum(below, 1e-12)))
        self.stem_ratio, self.word_ratio = (
            np.log(p[1] / p[0]).astype(np.float32) for p in (p_stem, p_word))
        # Pairs: the first word's continuations, and what its pairs leave to the backoff.
        head_at = self._at(self.firsts, _marked(head[pair], 2))[0]
        self.own, self.left = [], []
        for own in n:
            kept = own[pair] - np.minimum(own[pair], _discount(own[pair]))
            total = own[first] + PAIR_STRENGTH
            self.own.append((kept / total[head_at]).astype(np.float32) if len(pair)
                            else np.zeros(0, np.float32))
            self.left.append(np.maximum(1 - np.bincount(head_at, kept, len(first)) / total, 0.01)
                             .astype(np.float32) if len(first) else np.zeros(0, np.float32))
        self.first_ratio = np.log(self.left[1] / self.left[0])
        self.p_word = [np.append(x, [0]).astype(np.float32) for x in p_word]
        self.head_at = head_at

    def _backed(self, own: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Discounted counts, interpolated with the probabilities of the order below."""
        cut = np.minimum(own, _discount(own))
        rest = cut.sum() + self.strength * len(own)
        return (own - cut + rest * below) / max((own - cut).sum() + rest, 1)

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray):
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def features(self, flat: Flat) -> np.ndarray:
        """Per text: the summed ratio, and what of it is above the margin, normalised by length;
        and the length, as short texts vary more."""
        words, stems, texts, pairs, begin = _expressions(flat)
        distinct, some, inverse = np.unique(words, return_index=True, return_inverse=True)
        at, known = self._at(self.words, distinct)
        stem_at, stem_known = self._at(self.stems, stems[some])
        ratio = np.zeros(len(distinct), np.float32)
        ratio[stem_known] = self.stem_ratio[stem_at[stem_known]]
        ratio[known] = self.word_ratio[at[known]]
        ratio = ratio[inverse]
        if len(self.pairs) and len(pairs):
            lead = inverse[begin]
            first_at, first_known = self._at(self.firsts, _marked(distinct, 2))
            back = np.where(first_known, self.first_ratio[first_at], 0)[lead]
            spot, found = self._at(self.pairs, pairs)
            # The interpolated probability of a pair: own evidence and the backoff to the word.
            ratio[begin + 1] += back
            own = np.flatnonzero(found & known[inverse[begin + 1]])
            spot, word = spot[own], at[inverse[begin + 1][own]]
            p = [b[spot] + x[self.head_at[spot]] * w[word]
                 for b, x, w in zip(self.own, self.left, self.p_word)]
            ratio[begin[own] + 1] = np.log(p[1] / p[0])
        n = np.maximum(np.bincount(texts, minlength=len(flat)), 1)
        total, strong = (np.bincount(texts, x, len(flat)).astype(np.float64)
                         for x in (ratio, np.maximum(ratio - self.margin, 0)))
        return np.stack([total / n, total / np.sqrt(n), np.log1p(strong / n * 100),
                         np.log1p(strong / np.sqrt(n)), np.log(n)], 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Means, scales and weights (intercept last) of a ridge logistic fit, by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w)),
            z.T @ (weight * (p - y)) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


class Scorer:
    def __init__(self, model: Model | None, fit=None):
        self.model, self.fit = model, fit

    def __call__(self, flat) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(flat))
        mean, scale, w = self.fit
        z = (self.model.features(flat) - mean) / scale
        return 1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30)))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          expressions: int = EXPRESSIONS, balance: float = BALANCE, **options) -> Scorer:
    """A scorer from labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    marks = labels.where("toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col("toxic").cast("long")).alias("toxic")).where(fold != 0)
    sizes = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1) or not sample:
        return Scorer(None)
    drawn_of_rarer = min(sample, *sizes.values())
    share = {k: min(1.0, (drawn_of_rarer if n < sizes[1 - k] else balance * drawn_of_rarer) / n)
             for k, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_003)) / 1_000_003
    drawn = marks.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # About (1 + balance) x sample rows of two numbers, whatever the tables hold: a bounded broadcast.
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(drawn), "doc_id").select(
            "text", (2 * (fold % 2) + F.col("toxic")).cast("long").alias("part"))
    counted = _counts(rows, expressions)
    if counted is None:
        return train(documents, labels, drawn_of_rarer // 2, expressions, balance, **options)
    key, head, *n = counted
    if not (n[0] + n[2]).any() or not (n[1] + n[3]).any():
        return Scorer(None)
    parts = sum((x > 0).astype(np.int64) for x in n)
    halves = rows.sparkSession.sparkContext.broadcast(
        [Model(key, head, n[2], n[3], parts, **options),
         Model(key, head, n[0], n[1], parts, **options)])

    def crossed(batches):
        for batch in batches:
            part = batch["part"].to_numpy(zero_copy_only=False)
            for first, flat in runs(batch["text"]):
                own = part[first:first + len(flat)]
                both = [m.features(flat) for m in halves.value]
                x = np.where((own < 2)[:, None], both[0], both[1])
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[:, k]) for k in range(x.shape[1])], pa.array(own & 1)],
                    names=[*"abcde", "y"])

    found = rows.mapInArrow(crossed, "a double, b double, c double, d double, e double, y long").toArrow()
    *x, y = (found[c].to_numpy() for c in (*"abcde", "y"))
    order = np.lexsort((y, *x))  # sums do not depend on the order in which rows arrive
    x, y = np.stack(x, 1)[order], y[order]
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    return Scorer(Model(key, head, n[0] + n[2], n[1] + n[3], parts, **options),
                  _logistic(x, y, weight / weight.mean()))


def scored(documents: DataFrame, scorer: Scorer) -> DataFrame:
    """``row`` (all columns of documents but text), ``text`` and ``score``."""
    held = documents.sparkSession.sparkContext.broadcast(scorer)
    df = documents.select(
        F.struct(*[f"`{c}`" for c in documents.columns if c != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"))

    def work(batches):
        for batch in batches:
            for first, flat in runs(batch["text"]):
                part = batch.slice(first, len(flat))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(held.value(flat))], names=["row", "text", "score"])

    return df.mapInArrow(work, T.StructType([*df.schema.fields,
                                             T.StructField("score", T.DoubleType())]))


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    found = scored(documents.select("doc_id", "text"), train(documents, labels))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.select("row.doc_id", "score").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` whose score is below the threshold."""
    found = scored(documents, train(documents, labels))
    return found.where(F.col("score") < threshold).select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])
