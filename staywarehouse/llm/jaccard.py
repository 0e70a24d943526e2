"""N-gram Jaccard join: MinHash banding finds pairs, full n-gram sets decide.

Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters; the set of a
text holds the hashes of its n-grams (n = 5), or of all its words together where these are fewer.
Texts with the same set are one class, which is joined as a whole: nothing in it is paired.

Classes that agree on a band of MinHash values meet in a bucket. A small bucket names its pairs,
which are made distinct before they are verified. In a bucket of more than ``small`` classes no
pair is written at all: its classes are dealt into blocks, each two blocks meet in one task, and
that task compares them by products of membership matrices and returns sums and stars, no pairs.
A pair that meets in several buckets is counted in the first of them: a task knows it from the
bands of both. Nothing is capped; any bucket size is worked off in blocks of bounded size.

Defined results: a text without words (null and empty ones too) is alone, as is a row without
``doc_id``. Rows that repeat a text, ids included, count as documents of their own in ``n_links``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .components import components
from .flat import Flat, WORD, chain, hashes, mix, parts, runs, spans
from .scratch import settled

N_GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 200
SMALL = 48
BLOCK = 512
#: Ids (one long each) that are sent to all executors at most.
SENT = 2_000_000


def banding(threshold: float, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, and so the fewest chance pairs, that ``most`` hashes allow
    for a pair at the threshold to share a band with probability ``recall``."""
    best = None
    for rows in range(1, most + 1):
        one = threshold ** rows
        bands = 1 if one >= recall else math.ceil(math.log(1 - recall) / math.log1p(-one))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding of so few hashes has the recall")
    return best


def grams(flat: Flat, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and the offsets of the texts."""
    flat = flat.lower()
    starts, ends, texts = spans(flat, WORD)
    own = hashes(flat.data, starts, ends)
    found, begin = chain(own, texts, n)
    owner = texts[begin]
    counts = np.bincount(texts, minlength=len(flat))
    for text in np.flatnonzero((counts > 0) & (counts < n)):
        words = own[np.searchsorted(texts, text):np.searchsorted(texts, text, "right")]
        whole = chain(words, np.zeros(len(words), np.int64), len(words))[0]
        found, owner = np.append(found, whole), np.append(owner, text)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[first], owner[first]
    return found, np.searchsorted(owner, np.arange(len(flat) + 1))


def _reduce(how: np.ufunc, values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    out = np.full(len(at) - 1, empty, values.dtype)
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        out[full] = how.reduceat(values, at[full])
    return out


def signatures(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, size, set_a, set_b (two hashes of the set), bands (a hash of each band)."""
    def sign(batches):
        rng = np.random.default_rng(20240229)
        salts = rng.integers(0, 1 << 64, (bands, rows), np.uint64)
        for batch in batches:
            for first, flat in runs(batch["text"]):
                found, at = grams(flat, n)
                out = np.zeros((len(flat), bands), np.uint64)
                for band in range(bands):
                    for salt in salts[band]:
                        # A multiplication spreads upwards only, so the halves are swapped first.
                        x = (found ^ salt) * np.uint64(0x9FB21C651E98DF25)
                        x ^= x >> np.uint64(32)
                        x *= np.uint64(0xD6E8FEB86659FD93)
                        out[:, band] = mix(out[:, band] + _reduce(np.minimum, x, at, 0)
                                           + np.uint64(band + 1))
                sums = [_reduce(np.add, mix(found ^ np.uint64(s)), at, 0).view(np.int64)
                        for s in (0x51, 0xA7)]
                flat_bands = pa.array(out.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(flat)), pa.array(np.diff(at)),
                     pa.array(sums[0]), pa.array(sums[1]),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(len(flat) + 1, dtype=np.int32) * bands), flat_bands)],
                    names=["doc_id", "size", "set_a", "set_b", "bands"])

    return documents.mapInArrow(
        sign, "doc_id long, size long, set_a long, set_b long, bands array<long>")


def _sets(documents: DataFrame, n: int) -> DataFrame:
    """doc_id and the distinct n-gram hashes of the text, as the bytes of sorted uint64."""
    def work(batches):
        for batch in batches:
            for first, flat in runs(batch["text"]):
                found, at = grams(flat, n)
                data = [found[a:b].tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(flat)), pa.array(data, pa.binary())],
                    names=["doc_id", "grams"])

    return documents.mapInArrow(work, "doc_id long, grams binary")


def shared(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many elements each set of ``left`` has in common with each of ``right``.

    Elements of both sides are numbered, and membership matrices multiplied ``width`` columns
    at a time, which bounds memory whatever the sets hold.
    """
    a = np.concatenate(left) if left else np.zeros(0, np.uint64)
    b = np.concatenate(right) if right else np.zeros(0, np.uint64)
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    cells = []
    for sets, flat in ((left, a), (right, b)):
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        hit = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit]
        column = at[hit]
        order = np.argsort(column, kind="stable")
        cells.append((owner[order], column[order]))
    for first in range(0, len(common), width):
        parts = []
        for (owner, column), count in zip(cells, out.shape):
            i, j = np.searchsorted(column, (first, first + width))
            part = np.zeros((count, min(width, len(common) - first)), np.float32)
            part[owner[i:j], column[i:j] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def _similar(common, left, right, share: int):
    """Whether a Jaccard similarity is at least ``share`` / 10000, in whole numbers."""
    return 10000 * common >= share * (left + right - common)


def _roots(links: np.ndarray) -> np.ndarray:
    """The least index of each component of a square boolean matrix."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label, len(label)).min(1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _block(share: int):
    def verify(key, part):
        """Links between two blocks of a bucket: their documents by class, and stars."""
        _, low, high, band = key
        part = part.sort_values(["side", "rep"], kind="stable")
        reps, weight = part["rep"].to_numpy(), part["docs"].to_numpy()
        sets = [np.frombuffer(g, np.uint64) for g in part["grams"]]
        size = np.array([len(s) for s in sets])
        bands = np.stack(part["bands"].to_numpy()) if len(part) else np.zeros((0, 1))
        hot = np.zeros(bands.shape, bool)
        for i, own in enumerate(part["hot"]):
            hot[i, own] = True
        cut = int((part["side"] == 0).sum()) if low != high else len(part)
        rows, cols = slice(0, cut), slice(cut, None) if low != high else slice(0, cut)
        common = shared(sets[rows], sets[cols])
        link = _similar(common, size[rows, None], size[None, cols], share)
        for other in range(int(band)):  # counted in an earlier large bucket
            both = hot[rows, other][:, None] & hot[cols, other]
            link &= ~(both & (bands[rows, other][:, None] == bands[None, cols, other]))
        if low == high:
            np.fill_diagonal(link, False)
        square = np.zeros((len(part), len(part)), bool)
        square[rows, cols] = link
        square |= square.T
        count = square @ weight
        root = _roots(square)
        out = part[["rep"]].copy()
        out["links"], out["root"] = count, reps[root]
        return out[count > 0]

    return verify


def join(documents: DataFrame, n: int = N_GRAM, threshold: float = THRESHOLD,
         recall: float = RECALL, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Per row of documents: doc_id, class_id, n_links.

    ``n_links`` counts the other rows whose sets have a Jaccard similarity of ``threshold`` or
    more; ``class_id`` is the least doc_id that links lead to. ``recall`` is the probability for a
    pair just at the threshold to be found; higher ones are found nearly always.
    """
    bands, rows = banding(threshold, recall)
    share = round(threshold * 10000)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = settled(signatures(texts, n, bands, rows), "signatures")
    joined = signed.where("size > 0 AND doc_id IS NOT NULL")
    classes = settled(
        joined.groupBy("size", "set_a", "set_b").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("docs"),
            F.first("bands").alias("bands")), "classes")
    members = joined.select("doc_id", "size", "set_a", "set_b").join(
        classes.select("size", "set_a", "set_b", "rep", "docs"), ["size", "set_a", "set_b"]) \
        .select("doc_id", "rep", "docs")

    places = classes.select("rep", F.posexplode("bands").alias("band", "value"))
    buckets = places.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    places = settled(places.join(buckets, ["band", "value"]), "buckets")

    # Which bands of a class are large buckets; classes in any bucket, with their sets.
    hot = settled(places.groupBy("rep").agg(F.collect_list(
        F.when(F.col("n") > small, F.col("band"))).alias("hot")), "hot")
    needed = hot.join(classes.select("rep", "docs", "bands"), "rep")
    ids = hot.select(F.col("rep").alias("doc_id"))
    if hot.count() <= SENT:  # else the texts are shuffled to their ids
        ids = F.broadcast(ids)
    held = settled(_sets(texts.join(ids, "doc_id", "left_semi"), n)
                   .withColumnRenamed("doc_id", "rep").join(needed, "rep"), "sets")

    pairs = places.where(F.col("n") <= small).groupBy("band", "value") \
        .agg(F.sort_array(F.collect_list("rep")).alias("reps")) \
        .select(F.explode(F.expr(
            "flatten(transform(reps, (a, i) -> transform(slice(reps, i + 2, size(reps)),"
            " b -> struct(a, b))))")).alias("p")).select("p.a", "p.b").distinct()
    verified = settled(_verified(pairs, held, share), "links")

    blocks = places.where(F.col("n") > small).join(held, "rep") \
        .withColumn("blocks", F.expr(f"cast(ceil(n / {block}) AS int)")) \
        .withColumn("own", F.expr("cast(pmod(xxhash64(rep, 7), blocks) AS int)")) \
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))) \
        .select("value", F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"), "band",
                F.expr("cast(own > other AS int)").alias("side"),
                "rep", "docs", "grams", "bands", "hot")
    stars = settled(blocks.groupBy("value", "low", "high", "band").applyInPandas(
        _block(share), "rep long, links long, root long"), "stars")

    links = verified.select(F.col("a").alias("rep"), F.col("docs_b").alias("links")) \
        .union(verified.select("b", "docs_a")).union(stars.select("rep", "links")) \
        .groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(verified.select("a", "b").union(
        stars.select(F.col("root").alias("a"), F.col("rep").alias("b"))))
    # Written first, so that the join with members, whose hot classes it meets, can be split.
    found = settled(links.join(roots.withColumnRenamed("node", "rep"), "rep", "left"), "found")
    linked = members.join(found, "rep", "left").select(
        "doc_id", F.coalesce("root", "rep").alias("class_id"),
        (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = signed.where("size = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.union(alone)


def _verified(pairs: DataFrame, held: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b, docs_a, docs_b) that are similar and meet in no large bucket."""
    left = held.selectExpr("rep AS a", "docs AS docs_a", "grams AS grams_a", "bands AS bands_a",
                           "hot AS hot_a")
    right = held.selectExpr("rep AS b", "docs AS docs_b", "grams AS grams_b", "bands AS bands_b",
                            "hot AS hot_b")
    # Sets of sizes too far apart for the threshold go before any set is read.
    sized = pairs.join(held.selectExpr("rep AS a", "length(grams) AS la", "bands AS ba",
                                       "hot AS ha"), "a") \
        .join(held.selectExpr("rep AS b", "length(grams) AS lb", "bands AS bb", "hot AS hb"), "b") \
        .where(f"10000 * least(la, lb) >= {share} * greatest(la, lb)") \
        .where("NOT exists(array_intersect(ha, hb), i -> ba[i] = bb[i])").select("a", "b")
    both = sized.join(left.drop("bands_a", "hot_a"), "a").join(right.drop("bands_b", "hot_b"), "b")

    def check(batches):
        for batch in parts(batches):
            keep = []
            for x, y in zip(batch["grams_a"], batch["grams_b"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(_similar(common, len(x), len(y), share))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "docs_a", "docs_b"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "docs_a", "docs_b")])
    return both.mapInArrow(check, schema)


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with one document of each class: that of the least doc_id.

    Of rows that repeat this doc_id, one stays (any, as they are alike but for other columns).
    Rows without doc_id or words are no copies of anything and stay.
    """
    found = join(documents, **options).where("doc_id <> class_id").select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti")
