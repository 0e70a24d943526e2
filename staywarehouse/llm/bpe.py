"""BPE encoding and decoding over an index of pair occurrences.

A text is cut at special tokens, normalised (NFC, lower case) and split into words, white space
being dropped. The words of a run that were not met before are laid out as one list of symbols. An
index maps every pair that merges to all its positions there; the active ranks are taken in
ascending order, each merges its pair at all its positions from left to right, and the pairs that
come to stand beside a merged symbol go to the lists of their ranks. This is the one-by-one order of
each word, as no merge uses a symbol that only a later merge makes, which is checked on loading.

Code points outside ``PLAIN`` stand in Unicode tables that differ between versions; a text with one
of them is normalised and split by the tokenizers library's own rules, everything else here.

Defined results: null counts as the empty text, which has no ids and decodes to the empty text;
repeated rows are encoded one by one, very long words and texts whole; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .flat import parts, runs
from .pieces import free

#: Bytes of text whose new words are merged together.
RUN_BYTES = 8_000_000
#: Words kept with their ids, and the longest that is kept.
CACHED_WORDS, CACHED_LENGTH = 200_000, 64
#: Ranges of code points whose case, class and composition are settled.
PLAIN = regex.compile("[\\u0000-\\u0557\\u1e00-\\u208e\\u20a0-\\ua7ca\\uac00-\\uffff"
                      "\\U0001f000-\\U0001fbff]*+")
#: The normalisers and splitters that a tokenizer file must name.
NORMALIZERS, SPLITTERS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]
_SHIFT = 32


def byte_signs() -> list[str]:
    """The sign that stands for each byte: itself if it shows, or else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """Tables of one tokenizer file: symbols of bytes, merges by pair, and tokens by id."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as file:
            told = json.load(file)
        model, steps = told["model"], told["normalizer"]["normalizers"]
        split = told["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != NORMALIZERS or [s["type"] for s in split] != SPLITTERS \
                or told["post_processor"] or told["decoder"] or model["unk_token"]:
            raise ValueError("a tokenizer of other steps than these is not supported")
        self.rules = json.dumps(told | {
            "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []})
        self.pattern = split[0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([vocab[s] for s in byte_signs()], np.int64)
        self.last = np.array([vocab[s + end] for s in byte_signs()], np.int64)
        made = {a + b: rank for rank, (a, b) in enumerate(model["merges"])}
        if len(made) < len(model["merges"]) or any(
                made.get(part, -1) >= rank
                for rank, pair in enumerate(model["merges"]) for part in pair):
            raise ValueError("a symbol is made by two merges, or only after a merge uses it")
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        key = np.array([a << _SHIFT | b for a, b, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(key)
        self.pairs = key[self.pair_ranks]
        self.tokens = {i: t.encode() for t, i in (vocab | self.special).items()}

    def _by_rank(self, key: np.ndarray, at: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The positions ``at`` whose pair ``key`` merges, by rank."""
        place = np.searchsorted(self.pairs, key)
        place[place == len(self.pairs)] = 0
        known = np.flatnonzero(self.pairs[place] == key)
        if not len(known):
            return []
        at, rank = at[known], self.pair_ranks[place[known]]
        if len(known) > 1:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
        cut = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(at)]
        return [(r, at[a:b]) for r, a, b in zip(rank[cut[:-1]].tolist(), cut, cut[1:])]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids (int32) of each word; no word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        last = np.zeros(len(data), bool)
        last[ends - 1] = True
        # A symbol that has merged into the one before is -1; so is the one beside an end.
        sym = np.append(np.where(last, self.last[data], self.inner[data]), -1)
        after = np.where(last, -1, np.arange(1, len(data) + 1))
        before = np.arange(-1, len(data))
        before[ends - sizes] = -1
        inner = np.flatnonzero(~last)
        index = {r: [at] for r, at in self._by_rank(sym[inner] << _SHIFT | sym[inner + 1], inner)}
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, made = self.merges[rank]
            spots = index.pop(rank)
            spots = spots[0] if len(spots) == 1 else np.unique(np.concatenate(spots))
            # Positions are stale where a merge since has taken one of the two.
            spots = spots[(sym[spots] == a) & (sym[after[spots]] == b)]
            if not len(spots):
                continue
            if a == b:
                spots = self._apart(spots, after)
            gone = after[spots]
            right = after[gone]
            sym[spots], sym[gone], after[spots] = made, -1, right
            before[right] = spots  # the spare last place takes those of ends
            left = before[spots]
            key = np.concatenate([sym[left] << _SHIFT | made, made << _SHIFT | sym[right]])
            for other, at in self._by_rank(key, np.concatenate([left, spots])):
                if other in index:
                    index[other].append(at)
                else:
                    index[other] = [at]
                    heapq.heappush(active, other)
        kept = np.flatnonzero(sym[:-1] >= 0)
        ids = sym[kept].astype(np.int32).tobytes()
        cut = [0, *(4 * np.searchsorted(kept, ends)).tolist()]
        return [ids[a:b] for a, b in zip(cut, cut[1:])]

    @staticmethod
    def _apart(spots: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of places that follow one another every other one, from the left."""
        joined = np.append(False, after[spots[:-1]] == spots[1:])
        number = np.arange(len(spots))
        first = np.maximum.accumulate(np.where(joined, 0, number))
        return spots[(number - first) % 2 == 0]

    def decode(self, ids: list[int]) -> bytes:
        """The tokens of the ids with blanks between, as UTF-8; ids without a token are left out."""
        return b" ".join([t for t in map(self.tokens.get, ids) if t is not None])


class Encoder:
    """Encodes whole texts; words met before are looked up, within a bounded cache."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words = regex.compile(merges.pattern).findall
        special = sorted(merges.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") \
            if special else None
        self.special = {t: np.array([i], np.int32).tobytes() for t, i in merges.special.items()}
        self.known: dict[str, bytes] = {}
        self.rules = None

    def _by_rules(self, text: str) -> list[str]:
        """Words by the library's own normalisers and splitters."""
        if self.rules is None:
            from tokenizers import Tokenizer
            self.rules = Tokenizer.from_str(self.merges.rules)
            self.byte = {s: b for b, s in enumerate(byte_signs())}
        clean = self.rules.normalizer.normalize_str(text)
        return [bytes(map(self.byte.__getitem__, word)).decode()
                for word, _ in self.rules.pre_tokenizer.pre_tokenize_str(clean)]

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if self.cut is not None and any(t in text for t in self.special):
            return [word for part in self.cut.split(text) for word in (
                [part] if part in self.special else self.split(part) if part else [])]
        if not PLAIN.fullmatch(text):
            return self._by_rules(text)
        # The library lower-cases sign by sign: a sigma is no final one.
        return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids (int32) of each text."""
        split = [self.split(t) for t in texts]
        new = set().union(*split) - self.known.keys() - self.special.keys()
        found = self.known
        if new:
            if len(self.known) + len(new) > CACHED_WORDS:
                self.known = {}
                new = set().union(*split) - self.special.keys()
            new = list(new)
            made = dict(zip(new, self.merges.encode([w.encode() for w in new])))
            found = self.known | made
            self.known.update((w, i) for w, i in made.items() if len(w) <= CACHED_LENGTH)
            if len(self.known) > CACHED_WORDS:
                self.known = {}
        found = found | self.special
        return [b"".join(map(found.__getitem__, words)) for words in split]


def _mapped(documents: DataFrame, tokenizer_file: str, text: str, schema: T.StructType,
            made: Callable[[Merges, list[bytes]], list[pa.Array]]) -> DataFrame:
    """``documents`` with the columns that ``made`` gives for the ids of a run of texts."""
    held = documents.sparkSession.sparkContext.broadcast(Merges(tokenizer_file))

    def work(batches):
        encoder = Encoder(held.value)
        for batch in parts(batches, 4096):
            for first, flat in runs(batch[text], RUN_BYTES):
                found = encoder([flat.text(i).decode() for i in range(len(flat))])
                columns = batch.slice(first, len(flat)).columns + made(encoder.merges, found)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.mapInArrow(work, schema)


def _decoded(merges: Merges, ids: list[bytes]) -> list[bytes]:
    return [merges.decode(np.frombuffer(i, np.int32).tolist()) for i in ids]


def round_trip(documents: DataFrame, tokenizer_file: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``documents`` with the ids of a text and the text that the ids decode to.

    The added columns get underscores after their names until no other column is called so.
    """
    ids = free(ids, documents.columns)
    decoded = free(decoded, [*documents.columns, ids])
    schema = T.StructType([*documents.schema.fields,
                           T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.StringType())])

    def made(merges, found):
        at = np.cumsum([0, *map(len, found)]) // 4
        flat = pa.array(np.frombuffer(b"".join(found), np.int32))
        return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat),
                pa.array(_decoded(merges, found), pa.binary()).cast(pa.string())]

    return _mapped(documents, tokenizer_file, text, schema, made)


def digest(documents: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per row of documents: doc_id, n_tokens, ids_sha256 (of 32-bit numbers), decoded_sha256."""
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([*texts.schema.fields, T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def made(merges, found):
        return [pa.array([len(i) // 4 for i in found], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in found], pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in _decoded(merges, found)],
                         pa.string())]

    return _mapped(texts, tokenizer_file, "text", schema, made).drop("text")
