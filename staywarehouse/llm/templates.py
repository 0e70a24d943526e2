r"""Line dedup with a log-template tree.

A line is ``\n``-split; its tokens are what ASCII white space leaves, and a token with a digit is
a variable field. The tree has a level for the number of tokens and one for the ``DEPTH`` leading
tokens. The lines of a leaf are taken by first document: a line joins the first template that it
agrees with, position by position, for at least ``similar`` of the line, or begins a template; the
positions in which lines of a template differ are generalised. A template that occurs in two or
more documents is recurring: its lines stay in the document of the least doc_id and are dropped
from all others. In lines of fewer than ``EXACT`` tokens no token is a variable field, so these
recur as they are. Lines of fewer than ``least`` tokens, by default those without any, stay.

The tree is built by shuffles, not in one place. Lines that are the same once variable fields are
masked are one row (a very common line is combined before it is shuffled). A leaf of up to ``WIDE``
different lines is one group. A wider one is worked off in rounds with the same result: one task
finds the templates that the first lines begin, all lines of the leaf meet these in groups of
about ``4 * WIDE`` lines, and those that join none go on to the next round, whose task takes twice
as many. Tokens travel and are compared as 64-bit hashes.

Defined results: null and empty texts have no lines to drop and stay; lines repeated within one
document do not recur by that; rows of one doc_id are one document; rows without doc_id count as
one document that comes first; an order of rows never matters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .flat import INK, Flat, hashes, lines, mix, runs, spans
from .scratch import settled

LEAST, SIMILAR, EXACT = 1, 0.7, 4
DEPTH = 4
#: Lines of a leaf that one task takes at once; the templates do not depend on it.
WIDE = 1000

_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_FIELD = np.uint64(0x2545F4914F6CDD1D)


def _parse(flat: Flat):
    """Lines (starts, ends, texts), and for each: tokens, first token, leaf hash, whole hash."""
    starts, ends, texts = lines(flat)
    first, last, _ = spans(flat, INK)
    token = hashes(flat.data, first, last)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[flat.data])])
    at = np.searchsorted(first, np.append(starts, len(flat.data) + 1))
    at = np.maximum.accumulate(at)
    count = np.diff(at)
    field = (digits[last] > digits[first]) & np.repeat(count >= EXACT, count)
    token = np.where(field, _FIELD, token)
    place = np.arange(len(token)) - np.repeat(at[:-1], count)
    spread = mix(token + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    out = []
    for depth in (DEPTH, None):
        total = np.zeros(len(token) + 1, np.uint64)
        np.cumsum(spread if depth is None else np.where(place < depth, spread, 0), out=total[1:],
                  dtype=np.uint64)
        out.append(mix(total[at[1:]] - total[at[:-1]] + count.astype(np.uint64)))
    return starts, ends, texts, count, at, token, out


def _doc(batch) -> np.ndarray:
    ids = batch["doc_id"].fill_null(np.iinfo(np.int64).min)
    return ids.to_numpy(zero_copy_only=False)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _slim(documents: DataFrame, least: int) -> DataFrame:
    """(doc, leaf, line), once for each different line of a text."""
    def work(batches):
        for batch in batches:
            doc = _doc(batch)
            for first, flat in runs(batch["text"]):
                _, _, texts, count, _, _, (leaf, line) = _parse(flat)
                own = np.flatnonzero(count >= least)
                order = own[np.lexsort((line[own], texts[own]))]
                new = np.ones(len(order), bool)
                new[1:] = (line[order][1:] != line[order][:-1]) \
                    | (texts[order][1:] != texts[order][:-1])
                order = order[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[first + texts[order]]), pa.array(leaf[order].view(np.int64)),
                     pa.array(line[order].view(np.int64))], names=["doc", "leaf", "line"])

    return _texts(documents).mapInArrow(work, "doc long, leaf long, line long")


def _full(documents: DataFrame, least: int) -> DataFrame:
    """(line, tokens as 64-bit hashes), once for each different line of a run."""
    def work(batches):
        for batch in batches:
            for _, flat in runs(batch["text"]):
                _, _, _, count, at, token, (_, line) = _parse(flat)
                own = np.flatnonzero(count >= least)
                own = own[np.unique(line[own], return_index=True)[1]]
                data = [token[at[i]:at[i + 1]].tobytes() for i in own.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(line[own].view(np.int64)), pa.array(data, pa.binary())],
                    names=["line", "tokens"])

    return _texts(documents).mapInArrow(work, "line long, tokens binary")


def _ordered(leaf: list[dict]) -> tuple[list[dict], np.ndarray]:
    """Lines of one leaf in the order in which they are taken, and their tokens."""
    leaf = sorted(leaf, key=lambda x: (x["first"], x["line"]))
    return leaf, np.stack([np.frombuffer(x["tokens"], np.uint64) for x in leaf])


def grow(tokens: np.ndarray, similar: float) -> np.ndarray:
    """For each line of a leaf, in order, the line that begins its template."""
    begun = np.full(len(tokens), -1)
    rest = np.arange(len(tokens))
    while len(rest):
        joins = (tokens[rest] == tokens[rest[0]]).mean(1) >= similar
        joins[0] = True
        begun[rest[joins]] = rest[0]
        rest = rest[~joins]
    return begun


def _grown(leaves: DataFrame, similar: float) -> DataFrame:
    """(line, owner) of the recurring lines of whole leaves."""
    def work(batches):
        for batch in batches:
            found = []
            for leaf in batch["leaf"].to_pylist():
                leaf, tokens = _ordered(leaf)
                owners = [leaf[i]["first"] for i in grow(tokens, similar)]
                found += [(x["line"], o) for x, o in zip(leaf, owners) if x["last"] > o]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], pa.int64())], names=["line", "owner"])

    return leaves.select("leaf").mapInArrow(work, "line long, owner long")


def _begun(heads: DataFrame, similar: float) -> DataFrame:
    """The lines that begin a template: leaf, line, first, tokens, groups."""
    def work(batches):
        for batch in batches:
            found = []
            for leaf, groups, lines_ in zip(batch["leaf"].to_pylist(), batch["groups"].to_pylist(),
                                            batch["lines"].to_pylist()):
                lines_, tokens = _ordered(lines_)
                found += [{"leaf": leaf, "groups": groups} | lines_[i]
                          for i in np.unique(grow(tokens, similar)).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in found], k) for c, k in (
                    ("leaf", pa.int64()), ("groups", pa.int64()), ("line", pa.int64()),
                    ("first", pa.int64()), ("tokens", pa.binary()))],
                names=["leaf", "groups", "line", "first", "tokens"])

    return heads.mapInArrow(work, "leaf long, groups long, line long, first long, tokens binary")


def _met(groups: DataFrame, similar: float) -> DataFrame:
    """All lines of the groups, with the owner of the first template that each agrees with."""
    kinds = {"leaf": "long", "groups": "long", "line": "long", "first": "long", "last": "long",
             "tokens": "binary", "owner": "long"}

    def work(batches):
        for batch in batches:
            found = []
            for leaf, n, members in zip(batch["leaf"].to_pylist(), batch["groups"].to_pylist(),
                                        batch["lines"].to_pylist()):
                own = [x for x in members if x["last"] is not None]
                begins = [x for x in members if x["last"] is None]
                if not own:
                    continue
                own, tokens = _ordered(own)
                rest, owner = np.arange(len(own)), [None] * len(own)
                for start in sorted(begins, key=lambda x: (x["first"], x["line"])):
                    joins = (tokens[rest] == np.frombuffer(start["tokens"], np.uint64)
                             ).mean(1) >= similar
                    for i in rest[joins].tolist():
                        owner[i] = start["first"]
                    rest = rest[~joins]
                found += [{"leaf": leaf, "groups": n, "owner": o} | x for x, o in zip(own, owner)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in found], pa.binary() if k == "binary" else pa.int64())
                 for c, k in kinds.items()], names=list(kinds))

    return groups.mapInArrow(work, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def _wide(rows: DataFrame, similar: float) -> DataFrame:
    """(line, owner) of the recurring lines of wide leaves: leaf, n, line, first, last, tokens."""
    out, heads = None, WIDE
    rows = rows.withColumn("groups", F.expr(f"cast(ceil(n / {4 * WIDE}) AS bigint)"))
    place = Window.partitionBy("leaf").orderBy("first", "line")
    while not rows.isEmpty():
        first = rows.withColumn("place", F.row_number().over(place)).where(f"place <= {heads}")
        begun = settled(_begun(first.groupBy("leaf", "groups").agg(F.collect_list(
            F.struct("line", "first", "tokens")).alias("lines")), similar), "wide-templates")
        own = rows.select("leaf", "groups", F.expr("pmod(xxhash64(line, 7), groups)").alias("part"),
                          F.struct("line", "first", "last", "tokens").alias("x"))
        sent = begun.withColumn("last", F.lit(None).cast("long")).select(
            "leaf", "groups", F.explode(F.expr("sequence(0L, groups - 1)")).alias("part"),
            F.struct("line", "first", "last", "tokens").alias("x"))
        met = settled(_met(own.union(sent).groupBy("leaf", "groups", "part").agg(
            F.collect_list("x").alias("lines")), similar), "wide-lines")
        joined = met.where("last > owner").select("line", "owner")
        out = joined if out is None else out.union(joined)
        rows, heads = met.where("owner IS NULL").drop("owner"), heads * 2
    return out


def recurring(documents: DataFrame, least: int = LEAST, similar: float = SIMILAR) -> DataFrame:
    """(doc, line) of the lines to drop."""
    slim = settled(_slim(documents, least), "lines")
    # First one row for each line, combined before it is shuffled, however common the line is.
    seen = settled(slim.groupBy("line", "leaf").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last")), "leaves")
    # A leaf that only one document reaches holds nothing that recurs.
    shared = settled(seen.groupBy("leaf").agg(
        F.min("first").alias("a"), F.max("last").alias("b"), F.count("*").alias("n"))
        .where("a < b").select("leaf", "n"), "shared-leaves")
    seen = settled(seen.join(shared, "leaf"), "shared-lines")
    # Lines alone in their leaf need no comparison, so only the others fetch their tokens.
    single = seen.where("n = 1 AND first < last").select("line", F.col("first").alias("owner"))
    several = seen.where("n > 1").select("line", "leaf", "n", "first", "last")
    found = settled(_full(documents, least).join(several, "line").groupBy(
        "line", "leaf", "n", "first", "last").agg(F.min("tokens").alias("tokens")), "leaf-lines")
    narrow, wide = found.where(f"n <= {WIDE}"), found.where(f"n > {WIDE}")
    owners = single.union(_grown(narrow.groupBy("leaf", F.length("tokens")).agg(F.collect_list(
        F.struct("line", "first", "last", "tokens")).alias("lines")).select(
            F.col("lines").alias("leaf")), similar))
    if not wide.isEmpty():
        owners = owners.union(_wide(wide, similar))
    owners = settled(owners, "templates")
    return slim.join(owners, "line").where("doc <> owner").select("doc", "line")


def dedup(documents: DataFrame, least: int = LEAST, similar: float = SIMILAR) -> DataFrame:
    """``row`` (all columns but text), ``text`` without dropped lines, and counts.

    n_lines, n_dropped, n_tokens and n_tokens_dropped count lines and tokens of the text before.
    """
    drops = recurring(documents, least, similar).groupBy("doc").agg(
        F.collect_set("line").alias("drops"))
    df = documents.select(
        F.struct(*[f"`{c}`" for c in documents.columns if c != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"))
    df = df.join(drops, "doc", "left").select("row", "text", "drops")

    def strip(batches):
        for batch in batches:
            listed = batch["drops"]
            for start, flat in runs(batch["text"]):
                starts, ends, texts, count, *_, (*_, line) = _parse(flat)
                own = listed.slice(start, len(flat))
                drop = pa.ListArray.flatten(own).to_numpy(zero_copy_only=False).view(np.uint64)
                sizes = np.array([0 if x is None else x for x in
                                  pc.list_value_length(own).to_pylist()], np.int64)
                owner = np.repeat(np.arange(len(flat), dtype=np.uint64), sizes)
                gone = np.isin(mix(line + texts.astype(np.uint64) * _FIELD),
                               mix(drop + owner * _FIELD)) & (count >= least)
                kept = batch["text"].slice(start, len(flat)).to_pylist()
                for i in np.unique(texts[gone]).tolist():
                    a, b = np.searchsorted(texts, (i, i + 1))
                    kept[i] = b"\n".join(flat.data[starts[k]:ends[k]].tobytes()
                                         for k in range(a, b) if not gone[k]).decode()
                total = lambda x: pa.array(
                    np.bincount(texts, x, len(flat)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch["row"].slice(start, len(flat)), pa.array(kept, pa.string()),
                     total(np.ones(len(texts))), total(gone), total(count), total(count * gone)],
                    names=["row", "text", *counts])

    counts = ("n_lines", "n_dropped", "n_tokens", "n_tokens_dropped")
    schema = T.StructType([df.schema["row"], T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in counts]])
    return df.mapInArrow(strip, schema)


def report(documents: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, n_tokens, n_tokens_dropped, text (what is kept)."""
    return dedup(documents.select("doc_id", "text"), **options).select(
        "row.doc_id", "n_lines", "n_dropped", "n_tokens", "n_tokens_dropped", "text")


def cleaned(documents: DataFrame, **options) -> DataFrame:
    """``documents`` without recurring lines.

    A document goes only if it had words and all of them were in dropped lines.
    """
    left = dedup(documents, **options).where("n_tokens = 0 OR n_tokens_dropped < n_tokens")
    return left.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`")
                         for c in documents.columns])
