"""Benchmark decontamination with a generalised suffix automaton over item words.

Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters. The automaton
holds all items; training words are streamed through it, and the matched length at a word tells
which windows of items end there. Every window of ``window`` consecutive item words counts; an
item of fewer words is one window. Words inside an occurrence of a window are hit.

The automaton is built from at most ``block_words`` item words, which bounds what is sent to the
executors; more items make more blocks, each a further pass over the texts that adds to the spans
found so far. Items longer than a block are cut into pieces that overlap by ``window - 1`` words,
so that no window is lost.

Defined results: null and empty texts have no words and no hits; items that are null or have no
words match nothing; repeated items each count; items without an id mark words as hit, count as
one item and are not listed; extra columns pass through ``scan`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .flat import parts
from .scratch import settled

WINDOW = 13
BLOCK_WORDS = 2_000_000

_SEPARATE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
                  else 32 for c in range(256))


def words(text: str | bytes | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    if text is None:
        return []
    if isinstance(text, str):
        text = text.encode()
    return text.translate(_SEPARATE).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[int, list[bytes], bool]], window: int):
        """items: (id, words, whole): whether the words are the whole item, not a piece."""
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        marks: dict[int, dict[int, set]] = {}
        paths = [(item, text, whole, self._add(text)) for item, text, whole in items]
        for item, text, whole, _ in paths:
            need = min(window, len(text)) if whole else window
            for state in self._ends(text, need):
                marks.setdefault(state, {}).setdefault(need, set()).add(item)
        self.out: list[tuple | None] = [None] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.size.__getitem__):
            merged = {n: set(s) for n, s in marks.get(state, {}).items()}
            for n, more in (self.out[self.link[state]] or ()) if state else ():
                merged.setdefault(n, set()).update(more)
            if merged:
                self.out[state] = tuple(sorted(((n, frozenset(s)) for n, s in merged.items()),
                                               key=lambda x: -x[0]))

    def _add(self, text: list[bytes]) -> None:
        last = 0
        for word in text:
            last = self._extend(last, word)

    def _copy(self, state: int, size: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.size.append(size)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of exactly the strings one longer than those of ``p``, split off ``q``."""
        if self.size[q] == self.size[p] + 1:
            return q
        made = self._copy(q, self.size[p] + 1)
        self.link[q] = made
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        made = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.size.append(self.size[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = made
            p = self.link[p]
        if p >= 0:
            self.link[made] = self._split(p, word, self.next[p][word])
        return made

    def _ends(self, text: list[bytes], need: int) -> Iterator[int]:
        """The state of each run of ``need`` words of a text that is in the automaton."""
        state = length = 0
        for word in text:
            state, length = self.next[state][word], length + 1
            while self.size[self.link[state]] >= need:
                state = self.link[state]
                length = self.size[state]
            if length >= need > 0:
                yield state

    def match(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged word spans [start, end) inside windows, and the items they are of."""
        step, link, size, out = self.next, self.link, self.size, self.out
        spans: list[tuple[int, int]] = []
        items: set = set()
        state = length = 0
        for at, word in enumerate(text, 1):
            goes = step[state].get(word)
            if goes is None:
                while state and goes is None:
                    state = link[state]
                    goes = step[state].get(word)
                if goes is None:
                    length = 0
                    continue
                length = size[state]
            state = goes
            length += 1
            if (ends := out[state]) is not None:
                most = 0
                for n, of in ends:
                    if n <= length:
                        most = most or n
                        items |= of
                if most:
                    start = at - most
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, at))
        return spans, items


def _pieces(benchmark: DataFrame, window: int, most: int) -> DataFrame:
    """Pieces of at most ``most`` words: item_id (string), words as one text, whole, n."""
    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = words(text)
                if not own:
                    continue
                step = max(1, most - window + 1)
                first = range(0, max(1, len(own) - window + 1), step)
                rows += [(item, b" ".join(own[i:i + step + window - 1]).decode("utf-8", "replace"),
                          len(first) == 1, min(len(own) - i, step + window - 1)) for i in first]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item_id", "words", "whole", "n"), r)) for r in rows],
                pa.schema([("item_id", pa.string()), ("words", pa.string()),
                           ("whole", pa.bool_()), ("n", pa.int64())]))
    return benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")) \
        .mapInArrow(cut, "item_id string, words string, whole boolean, n long")


_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                    ("items", pa.list_(pa.string()))])
_EMPTY = "struct<n_words:bigint,spans:array<array<bigint>>,items:array<string>>"


def merged(spans: list) -> list[list[int]]:
    """Sorted spans without overlaps."""
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _pass(df: DataFrame, pieces: list, window: int, finish=None) -> DataFrame:
    """``df`` (row, text, found) with what one block of pieces adds to ``found``.

    ``finish``, a function of such a batch and the schema of what it makes of it, works in the
    same task.
    """
    held = df.sparkSession.sparkContext.broadcast(
        [(p.item_id, words(p.words), p.whole) for p in pieces])

    def search(batches):
        machine = Automaton(held.value, window)
        for batch in parts(batches):
            found = []
            for raw, was in zip(batch["text"].cast(pa.binary()), batch["found"].to_pylist()):
                own = words(raw.as_py())
                spans, items = machine.match(own)
                if was["spans"]:
                    spans = merged([*spans, *was["spans"]])
                found.append({"n_words": len(own), "spans": [list(s) for s in spans],
                              "items": sorted({*items, *was["items"]},
                                              key=lambda i: (i is None, i))})
            batch = batch.set_column(batch.schema.get_field_index("found"), "found",
                                     pa.array(found, _FOUND))
            yield finish[0](batch) if finish else batch

    return df.mapInArrow(search, finish[1](df.schema) if finish else df.schema)


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_words: int = BLOCK_WORDS, finish=None) -> DataFrame:
    """One row per document: ``row`` (its columns but text), ``text``, ``found``.

    ``found`` has n_words, spans (disjoint, [start, end) in words) and items (ids as strings).
    """
    pieces = settled(_pieces(benchmark, window, block_words), "benchmark-pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_words))
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    df = documents.select(
        F.struct(*[f"`{c}`" for c in documents.columns if c != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.struct(F.lit(0).alias("n_words"), F.array().alias("spans"),
                 F.array().alias("items")).cast(_EMPTY).alias("found"))
    for block in range(blocks):
        held = pieces.where(F.col("block") == block).collect()
        df = _pass(df, held, window, finish if block + 1 == blocks else None)
        if block + 1 < blocks:
            df = settled(df, f"benchmark-block-{block}")
    return df


_HIT = "aggregate(found.spans, 0L, (n, s) -> n + s[1] - s[0])"


def report(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(documents.select("doc_id", "text"), benchmark, **options)
    return found.selectExpr(
        "row.doc_id AS doc_id", "found.n_words AS n_words", f"{_HIT} AS n_hit",
        "cast(size(found.items) AS bigint) AS n_items",
        "sha2(cast(array_join(found.items, ',') AS binary), 256) AS items_sha256",
    ).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


#: A word of the automaton's kind in the text itself, upper case included.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cleaned(documents: DataFrame, benchmark: DataFrame, max_span: int = 2 * WINDOW,
            max_share: float = 0.05, **options) -> DataFrame:
    """``documents`` without contaminated passages.

    A document of which ``max_share`` of the words or more are hit loses all hit spans; every
    span of over ``max_span`` words goes in any document; a document of which no word is left
    goes itself.
    """
    def strip(batch):
        texts, gone = [], []
        for raw, found in zip(batch["text"].cast(pa.binary()), batch["found"].to_pylist()):
            raw, n, rest = raw.as_py(), found["n_words"], None
            hit = sum(e - s for s, e in found["spans"])
            bad = [(s, e) for s, e in found["spans"] if hit >= max_share * n or e - s > max_span]
            if bad:
                at = [m.span() for m in _WORD.finditer(raw)]
                left, last = [], 0
                for s, e in bad:
                    left.append(raw[last:at[s][0]])
                    last = at[e - 1][1]
                rest = b"".join([*left, raw[last:]])
            texts.append(rest if bad else raw)
            gone.append(bool(bad) and not _WORD.search(rest))
        return pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(texts, pa.binary()).cast(pa.string()),
             pa.array(gone, pa.bool_())], names=["row", "text", "gone"])

    left = scan(documents, benchmark, finish=(strip, lambda schema: T.StructType(
        [schema["row"], T.StructField("text", T.StringType()),
         T.StructField("gone", T.BooleanType())])), **options).where("not gone")
    return left.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`")
                         for c in documents.columns])
