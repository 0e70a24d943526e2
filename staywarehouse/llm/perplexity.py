"""Quality rules: base counts of words, and n-gram perplexity within bands of each language.

The model of a language is a modified Kneser-Ney model of ``ORDER`` code points. Spark counts for
every n-gram the texts that hold it; the lower orders follow from it as numbers of continuations,
and joins of the counts give every probability and backoff weight. An n-gram that one text alone
holds is no evidence about this text, and its share is left to the backoff: a text is judged by
what other texts hold, so that junk does not become likely by its own account.

The model is held in sorted arrays of 64-bit hashes (of language, kind and code points) beside
their values; two n-grams in 1e8 share a hash with a probability of 0.0003. A hash finds its place
by its leading bits. Every probability of a place in a text depends on the same two code points
before it, apart from the small tables of the lowest orders; so a model of more than ``ENTRIES``
entries is cut by those two into ranges, which are broadcast one after the other, each adding its
part of the sums. Nothing is left out of it, whatever its size.

A place costs a text at most ``MOST`` nats, so that a passage in another language does not outweigh
the rest. A document is rejected by the base rules, or if its mean log-perplexity is outside of its
language's band: the median plus or minus ``width`` spreads (from the quartiles), and more for texts
shorter than the median one, by the root of their share of its length. Defined results: null and
empty texts have no words and fail the base rules; a null language is a language of its own; a
language of one document has a band around it; repeated rows count as texts of their own; an empty
table gives no rows; very long texts are scored whole, one at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import Flat, INK, chain, hashes, lines, mix, runs, spans
from .pieces import free
from .scratch import settled

ORDER = 4
WIDTH, LEAST_SPREAD = 7.0, 0.02
#: Nats that one place of a text costs at most.
MOST = 5.0
#: Entries of a model, of 12 bytes, that are sent to executors at once.
ENTRIES = 8_000_000

#: Bits of a code point; three of them are packed into one number. 0 is the edge of a text.
BITS, POINTS = 21, 0x110000
_ONE, _TWO = (1 << BITS) - 1, (1 << 2 * BITS) - 1

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True  # Fixed values: symbols of the base rules.


def base_counts(flat: Flat) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    texts_n = len(flat)
    starts, ends, texts = spans(flat, INK)

    def summed(mark):
        total = np.concatenate([[0], np.cumsum(mark)])[flat.at]
        return np.diff(total)

    def repeats(values, owner):
        """Which values occur more than once in their text, and which of them not as the first."""
        key = mix(values + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first, inverse, n = np.unique(key, return_index=True, return_inverse=True,
                                         return_counts=True)
        later = np.ones(len(key), bool)
        later[first] = False
        return n[inverse] > 1, later

    own = hashes(flat.data, starts, ends)
    triples, begin = chain(own, texts, 3)
    twice, _ = repeats(triples, texts[begin])
    covered = np.zeros(len(own) + 2, bool)
    for k in range(3):
        covered[begin[twice] + k] = True
    line_starts, line_ends, line_texts = lines(flat)
    ink = np.concatenate([[0], np.cumsum(INK[flat.data])])
    full = ink[line_ends] > ink[line_starts]
    line = hashes(flat.data, line_starts[full], line_ends[full])
    _, later = repeats(line, line_texts[full])
    return {
        "n_words": np.bincount(texts, minlength=texts_n),
        "word_chars": summed(INK[flat.data] & ((flat.data & 0xC0) != 0x80)),
        "n_symbols": summed(_SYMBOL[flat.data]),
        "n_dup_lines": np.bincount(line_texts[full][later], minlength=texts_n),
        "n_repeat_words": np.bincount(texts[covered[:len(own)]], minlength=texts_n),
    }


def points(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """All code points plus one, and the offsets of the texts in them."""
    at = np.flatnonzero((flat.data & 0xC0) != 0x80)
    out = flat.data[at].astype(np.uint64)
    wide = np.flatnonzero(out >= 0x80)
    if len(wide):
        lead, place = out[wide], at[wide]
        size = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        code = lead & (np.uint64(0x3F) >> size.astype(np.uint64))
        for k in range(1, 4):
            more = size >= k
            last = np.minimum(place + k, len(flat.data) - 1)
            code = np.where(more, code << np.uint64(6) | flat.data[last] & np.uint64(0x3F), code)
        out[wide] = np.minimum(code, POINTS - 1)
    return out + np.uint64(1), np.searchsorted(at, flat.at)


_NEWS = np.ones(128, bool)
_NEWS[33:48] = _NEWS[58:65] = _NEWS[91:97] = _NEWS[123:127] = False


def grams(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First code point and packed others of all n-grams, and the offsets of the texts.

    A mark that is repeated counts once, as it is no news however often it stands there.
    """
    values, at = points(flat)
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (values[1:] > 128) \
        | _NEWS[np.minimum(values[1:] - np.uint64(1), np.uint64(127)).astype(np.int64)]
    keep[at[:-1][at[:-1] < len(values)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    values = values[keep]
    n, texts = len(values), len(at) - 1
    # Texts are laid out with gaps of edges as wide as an n-gram reaches.
    spot = np.arange(n) + (np.repeat(np.arange(texts), np.diff(at)) + 1) * (ORDER - 1)
    padded = np.zeros(n + (texts + 1) * (ORDER - 1), np.uint64)
    padded[spot] = values
    tail = padded[spot - 2] << np.uint64(2 * BITS) | padded[spot - 1] << np.uint64(BITS) | values
    return padded[spot - 3], tail, at


def salt(lang: str, kind: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.sha256(f"{kind}:{lang}".encode()).digest()[:8]))


def keys(salts, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Hashes of packed code points; ``head`` and ``salts`` may be one number for all."""
    first = np.atleast_1d(head) * np.uint64(0x9E3779B97F4A7C15) + np.atleast_1d(salts)
    return mix(tail ^ mix(first))


class _Tally:
    """How many texts hold each n-gram of a language."""

    def __init__(self):
        self.rows, self.waiting, self.held = None, [], 0

    def add(self, key: np.ndarray, *columns: np.ndarray) -> None:
        key, first, n = np.unique(key, return_index=True, return_counts=True)
        self.waiting.append((key, *[c[first] for c in columns], n))
        self.held += len(key)
        if self.held > max(0 if self.rows is None else len(self.rows[0]), 1_000_000):
            self.total()

    def total(self):
        """Hashes, first code points, packed others and numbers of texts."""
        if self.waiting:
            every = ([self.rows] if self.rows else []) + self.waiting
            key, *columns, n = [np.concatenate(c) for c in zip(*every)]
            key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            self.rows = (key, *[c[first] for c in columns],
                         np.bincount(inverse, n, len(key)).astype(np.int64))
            self.waiting, self.held = [], 0
        return self.rows


def count(documents: DataFrame) -> DataFrame:
    """(lang, head, tail, n): how many texts hold each n-gram."""
    def work(batches):
        tallies: dict[str, _Tally] = {}
        for batch in batches:
            names = batch["lang"].fill_null("").dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            for first, flat in runs(batch["text"]):
                head, tail, at = grams(flat)
                owner = np.repeat(np.arange(len(flat)), np.diff(at))
                key = keys(np.uint64(0), head, tail)
                once = np.unique(key + mix(owner.astype(np.uint64)), return_index=True)[1]
                lang = code[first + owner[once]]
                for i in np.unique(lang).tolist():
                    own = once[lang == i]
                    tallies.setdefault(names.dictionary[i].as_py(), _Tally()).add(
                        key[own], head[own], tail[own])
        for lang, tally in tallies.items():
            _, head, tail, n = tally.total()
            for a in range(0, len(n), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n[part])), pa.array(head[part].astype(np.int32)),
                     pa.array(tail[part].view(np.int64)), pa.array(n[part])],
                    names=["lang", "head", "tail", "n"])

    return documents.select("lang", "text").mapInArrow(
        work, "lang string, head int, tail long, n long").groupBy("lang", "head", "tail").agg(
            F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int, alone: bool) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of counts.

    With ``alone`` a count of 1 is the text's own, and is left to the backoff whole.
    """
    n = [max(x, 1) for x in (n1, n2, n3, n4)]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    found = [min(max(d, 0.1 * k), 0.95 * k) for k, d in enumerate(found, 1)]
    return [1.0, *found[1:]] if alone else found


def model(counted: DataFrame) -> DataFrame:
    """(lang, kind, head, tail, value): log-probabilities ``p`` and backoff weights ``s``.

    Kind p4 is the probability of the last of four code points, s4 the weight of its context.
    """
    spark = counted.sparkSession
    levels, lower = {ORDER: counted}, counted.where("n > 1")
    for order in range(ORDER - 1, 0, -1):
        # A gram of a lower order counts by how many code points stand before it.
        tail = F.col("tail") if order == 3 else F.expr(f"tail & {_TWO if order == 2 else _ONE}L")
        lower = settled(lower.groupBy("lang", F.lit(0).alias("head"), tail.alias("tail")).agg(
            F.count("*").alias("n")), f"grams-{order}")
        levels[order] = lower
    entries, below = [], None
    for order, rows in sorted(levels.items()):
        # Four numbers for each language.
        kinds = rows.groupBy("lang").agg(*[F.count_if(F.col("n") == k).alias(f"n{k}")
                                           for k in range(1, 5)]).collect()
        cuts = [(r.lang, *discounts(r.n1, r.n2, r.n3, r.n4, order == ORDER)) for r in kinds]
        cuts = spark.createDataFrame(cuts, "lang string, d1 double, d2 double, d3 double")
        cut = rows.join(F.broadcast(cuts), "lang").select(
            "lang", "head", "tail", "n",
            F.expr("CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END").alias("cut"),
            F.expr(f"shiftleft(cast(head AS bigint), {2 * BITS}) + shiftright(tail, {BITS})")
            .alias("context"))
        spare = settled(cut.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("spare")), "spare")
        own = cut.where("n > cut").join(spare, ["lang", "context"])
        if below is None:
            p = own.withColumn("p", F.expr(f"(n - cut) / total + spare / {POINTS}"))
        else:
            suffix = "tail" if order == ORDER else f"tail & {_TWO if order == 3 else _ONE}L"
            p = own.withColumn("suffix", F.expr(suffix)).join(below, ["lang", "suffix"]).withColumn(
                "p", F.expr("(n - cut) / total + spare * below"))
        p = settled(p.select("lang", "head", "tail", "p"), f"p-{order}")
        below = p.select("lang", F.col("tail").alias("suffix"), F.col("p").alias("below"))
        entries.append(p.select("lang", F.lit(f"p{order}").alias("kind"), "head", "tail",
                                F.log("p").cast("float").alias("value")))
        entries.append(spare.select("lang", F.lit(f"s{order}"), F.lit(0), "context",
                                    F.log("spare").cast("float")))
    out = entries[0]
    for more in entries[1:]:
        out = out.union(more)
    return out


def _part(before: np.ndarray, ranges: int) -> np.ndarray:
    """The range of the model for the packed two code points before a place."""
    before = before.astype(np.int64)
    return ((before >> BITS) * 1_000_003 + (before & _ONE)) % ranges


def arrays(entries: DataFrame, ranges: int) -> DataFrame:
    """(part, key, value) of the entries; part -1 belongs to every range."""
    def work(batches):
        salts = {}
        for batch in batches:
            names = [f"{k}:{x}" for k, x in zip(batch["kind"].to_pylist(),
                                                batch["lang"].to_pylist())]
            for name in set(names) - set(salts):
                kind, lang = name.split(":", 1)
                salts[name] = salt(lang, kind)
            kind = np.array([x[:2] for x in names])
            tail = batch["tail"].to_numpy()
            key = keys(np.array([salts[x] for x in names], np.uint64),
                       batch["head"].to_numpy().astype(np.uint64), tail.view(np.uint64))
            # The last of the two code points before a place is the last of its contexts.
            before = np.where((kind == "p4") | (kind == "p3"), tail >> BITS, tail) & _TWO
            wide = np.isin(kind, ["p4", "s4", "p3", "s3"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(wide, _part(before, ranges), -1)),
                 pa.array(key.view(np.int64)), batch["value"]], names=["part", "key", "value"])

    return entries.mapInArrow(work, "part long, key long, value float")


class Arrays:
    """Sorted hashes and their values; the leading bits of a hash say where to look."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]
        self.bits = max(1, min(24, len(key).bit_length()))
        edge = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.start = np.searchsorted(self.key, edge).astype(np.int32)
        ends = np.append(self.start[1:], len(key))
        self.longest = int((ends - self.start).max()) if len(key) else 0

    def get(self, key: np.ndarray) -> np.ndarray:
        """The value of each hash, NaN where it is unknown."""
        out = np.full(len(key), np.nan, np.float32)
        if not len(self.key):
            return out
        at = self.start[key >> np.uint64(64 - self.bits)]
        rest = np.arange(len(key))
        for _ in range(self.longest):
            there = self.key[np.minimum(at, len(self.key) - 1)]
            hit = there == key[rest]
            out[rest[hit]] = self.value[at[hit]]
            more = np.flatnonzero(there < key[rest])
            if not len(more):
                break
            at, rest = at[more] + 1, rest[more]
            inside = at < len(self.key)
            at, rest = at[inside], rest[inside]
        return out

    def log(self, lang: str, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """The log-probability of the last code point of each n-gram after the others."""
        out, rest = np.zeros(len(tail)), np.arange(len(tail))
        zero = np.uint64(0)
        for order in range(ORDER, 0, -1):
            own = tail[rest] if order >= 3 else tail[rest] & np.uint64(
                _TWO if order == 2 else _ONE)
            first = head[rest] if order == ORDER else zero
            found = self.get(keys(salt(lang, f"p{order}"), first, own))
            known = ~np.isnan(found)
            out[rest[known]] += found[known]
            rest = rest[~known]
            if not len(rest):
                return out
            context = own[~known] >> np.uint64(BITS)
            if order == ORDER:
                context += head[rest] << np.uint64(2 * BITS)
            spare = self.get(keys(salt(lang, f"s{order}"), zero, context))
            out[rest] += np.where(np.isnan(spare), 0, spare)
        out[rest] -= np.log(POINTS)
        return out


_KINDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _identity(documents: DataFrame):
    """A text that is the same for rows that are equal in doc_id, lang and text only."""
    own = [F.col("doc_id"), F.col("lang"), F.col("text")]
    return F.concat_ws(":", F.xxhash64(*own), F.xxhash64(F.lit(1), *own))


def scored(documents: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, n_points and log_p of every row."""
    texts = documents.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit(""))
                             .alias("lang"), F.col("text").cast("string").alias("text"))
    entries = settled(model(settled(count(texts), "grams")), "entries")
    ranges = max(1, -(-entries.count() // ENTRIES))
    held = settled(arrays(entries, ranges).repartition("part", F.expr("pmod(key, 64)"))
                   .sortWithinPartitions("part"), "arrays")
    if ranges > 1:
        texts = texts.withColumn("_row", _identity(texts))
    done = None
    for part in range(ranges):
        one = _scored(texts, _arrays(held.where(F.col("part").isin(-1, part))), part, ranges)
        one = settled(one, "scores")
        if done is None:
            done = one
        else:
            more = one.groupBy("_row").agg(F.max("log_p").alias("_more"))
            done = done.join(more, "_row").withColumn("log_p", F.expr("log_p + _more")) \
                .drop("_more")
    return done.drop("_row")


def _arrays(rows: DataFrame) -> Arrays:
    table = rows.select("key", "value").toArrow()
    return Arrays(table["key"].to_numpy().view(np.uint64), table["value"].to_numpy())


def _scored(texts: DataFrame, found: Arrays, part: int, ranges: int) -> DataFrame:
    """Base counts, and the sums over the places that belong to a range of the model."""
    held, floor = texts.sparkSession.sparkContext.broadcast(found), -MOST
    marks = [c for c in texts.columns if c != "text"]

    def work(batches):
        for batch in batches:
            names = batch["lang"].dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            for first, flat in runs(batch["text"]):
                rows = base_counts(flat) if part == 0 else dict.fromkeys(
                    _KINDS, np.zeros(len(flat), np.int64))
                head, tail, at = grams(flat)
                owner = np.repeat(np.arange(len(flat)), np.diff(at))
                lang = code[first + owner]
                log = np.zeros(len(tail))
                here = np.ones(len(tail), bool) if ranges == 1 else _part(
                    tail >> np.uint64(BITS), ranges) == part
                for i in np.unique(lang).tolist():
                    own = np.flatnonzero(here & (lang == i))
                    log[own] = np.maximum(floor, held.value.log(
                        names.dictionary[i].as_py(), head[own], tail[own]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch[c].slice(first, len(flat)) for c in marks],
                     *[pa.array(rows[k].astype(np.int64)) for k in _KINDS],
                     pa.array(np.diff(at).astype(np.int64)),
                     pa.array(np.bincount(owner, log, len(flat)).astype(np.float64))],
                    names=[*marks, *_KINDS, "n_points", "log_p"])

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in marks)
    return texts.mapInArrow(work, f"{kinds}, " + ", ".join(f"{k} long" for k in _KINDS)
                            + ", n_points long, log_p double")


def report(documents: DataFrame, width: float = WIDTH) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and the perplexity with its band."""
    rows = scored(documents).withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")).withColumn(
        "log_ppl", F.expr("CASE WHEN n_points > 0 THEN -log_p / n_points END"))
    # The band is that of the documents which the base rules let pass.
    quartiles = settled(rows.where("NOT base_failed").groupBy("lang").agg(
        F.percentile_approx("log_ppl", [0.25, 0.5, 0.75], 10000).alias("q"),
        F.percentile_approx("n_points", 0.5, 10000).alias("usual")), "quartiles")
    out = rows.join(quartiles, "lang", "left").withColumn(
        "reach", F.expr(f"{width} * greatest((q[2] - q[0]) / 1.349, {LEAST_SPREAD})"
                        " * sqrt(greatest(1, usual / greatest(n_points, 1)))"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
        F.expr("NOT base_failed AND coalesce(abs(log_ppl - q[1]) <= reach, false)").alias("kept"),
        F.exp("log_ppl").alias("perplexity"),
        F.expr("exp(q[1] - reach)").alias("lower"), F.expr("exp(q[1] + reach)").alias("upper"))


def accepted(documents: DataFrame, **options) -> DataFrame:
    """``documents`` that the rules keep, each row judged by its own text, with or without an id."""
    key = free("_key", documents.columns)
    marked = documents.withColumn(key, _identity(documents))
    kept = report(marked.select(F.col(key).alias("doc_id"), "lang", "text"), **options) \
        .where("kept").select(F.col("doc_id").alias(key)).distinct()
    return marked.join(kept, key, "left_semi").select(documents.columns)
