"""SentencePiece BPE encoding and decoding in numpy, by merge rounds over flat symbol arrays.

A text becomes blank, text, with blanks written as the piece mark. No piece goes on from another
character into a mark, and none holds a character outside the vocabulary, so a text is cut into
segments there and each segment is merged by itself. In a round every segment merges its best
pair (lowest rank; leftmost first) at all places where the one-by-one order would do so next;
finished segments leave the arrays. The number of rounds of a segment is at most its length.

Byte pieces stand for characters without a piece. Defined results: null counts as the empty
text, which has the end id only and decodes to the empty text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .flat import parts, runs

MARK = "▁"
_NONE = np.iinfo(np.int32).max
CACHED_SEGMENTS = 200_000


class Pieces:
    """Tables of one model: characters, pairs that merge, and the bytes of every id."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size, self.end, self.unknown = model.get_piece_size(), model.eos_id(), model.unk_id()
        kinds = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        plain = {model.id_to_piece(i): i for i in range(self.size) if not any(k(i) for k in kinds)}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in plain):
            raise ValueError("the model has pieces that go over the end of a word")
        symbols = dict(plain)
        for piece in plain:
            for char in piece:
                symbols.setdefault(char, self.size + len(symbols) - len(plain))
        chars = sorted((ord(p), i) for p, i in symbols.items() if len(p) == 1)
        self.chars, self.char_ids = (np.array(x, np.int64) for x in zip(*chars))
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in plain.values()},
                                                   reverse=True))}
        pairs = sorted((symbols[p[:k]] << 32 | symbols[p[k:]], order[model.get_score(i)], i)
                       for p, i in plain.items() for k in range(1, len(p))
                       if p[:k] in symbols and p[k:] in symbols)
        self.pairs, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*pairs))
        self.byte_ids = np.full(256, self.unknown, np.int64)
        shown = [b""] * self.size
        self.is_byte = np.zeros(self.size, bool)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.is_byte[i] = True
                shown[i] = bytes([int(piece[3:5], 16)])
            elif model.is_unknown(i):
                shown[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                shown[i] = piece.replace(MARK, " ").encode()
        self.length = np.array([len(x) for x in shown], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        known = set(map(chr, self.chars))
        barrier = re.escape("".join(chr(c) for c in range(128) if c != 32 and chr(c) not in known))
        self.segment = (rf" *[^ {barrier}]+| +|[{barrier}]+" if barrier else " *[^ ]+| +").encode()

    def _pair(self, left: np.ndarray, right: np.ndarray):
        """Where each pair stands in the table, and its rank (``_NONE`` for no piece)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return at, np.where((self.pairs[at] == key) & (left >= 0), self.ranks[at], _NONE)

    def encode(self, segments: list[bytes]) -> list[bytes]:
        """The ids (int32) of each segment, a segment being blanks and what follows them."""
        chars = [s.decode() for s in segments]
        points = np.frombuffer("".join(chars).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, chars), np.int64, len(chars))
        points = points.astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        lone = -1 - points  # a character without a symbol is kept as itself, below zero
        sym = np.where(self.chars[at] == points, self.char_ids[at], lone)
        word = np.repeat(np.arange(len(segments)), sizes)
        out_sym, out_word = self._merge(sym, word)
        return self._ids(out_sym, out_word, len(segments))

    def _merge(self, sym: np.ndarray, word: np.ndarray):
        rank = np.full(len(sym), _NONE, np.int64)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self._pair(sym[inner], sym[inner + 1])[1]
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            open_ = np.repeat(best < _NONE, sizes)
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                best, sizes = best[best < _NONE], sizes[best < _NONE]
                sym, word, rank = sym[open_], word[open_], rank[open_]
                if not len(sym):
                    break
            spots = np.flatnonzero(rank == np.repeat(best, sizes))
            # Of places one apart, every other one is free once the one before has merged.
            head = np.concatenate([[True], np.diff(spots) != 1])
            group = np.arange(len(spots)) - np.flatnonzero(head)[np.cumsum(head) - 1]
            spots = spots[group % 2 == 0]
            spots = self._next(sym, word, rank, spots)
            sym, rank = sym.copy(), rank.copy()
            sym[spots] = self.merged[self._pair(sym[spots], sym[spots + 1])[0]]
            keep = np.ones(len(sym), bool)
            keep[spots + 1] = False
            spots = spots - np.arange(len(spots))
            sym, word, rank = sym[keep], word[keep], rank[keep]
            near = np.concatenate([spots - 1, spots])
            near = near[near >= 0]
            rank[near] = _NONE
            near = near[near < len(sym) - 1]
            near = near[word[near] == word[near + 1]]
            rank[near] = self._pair(sym[near], sym[near + 1])[1]
        if not done_sym:
            return sym, word
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _next(self, sym, word, rank, spots):
        """Of the best places of each word, those before any better pair that they would make."""
        if len(spots) < 2 or not (word[spots][1:] == word[spots][:-1]).any():
            return spots
        made = self.merged[self._pair(sym[spots], sym[spots + 1])[0]]
        last = len(sym) - 1
        right = np.minimum(spots + 2, last)
        better = (spots + 2 <= last) & (word[right] == word[spots]) \
            & (self._pair(made, sym[right])[1] <= rank[spots])
        left = np.maximum(spots - 1, 0)
        beside = sym[left].copy()
        joined = np.concatenate([[False], spots[1:] - spots[:-1] == 2])
        beside[joined] = made[np.flatnonzero(joined) - 1]
        better |= (spots > 0) & (word[left] == word[spots]) \
            & (self._pair(beside, made)[1] <= rank[spots])
        before = np.cumsum(better) - better
        own = np.flatnonzero(np.concatenate([[True], word[spots][1:] != word[spots][:-1]]))
        counts = np.diff(np.append(own, len(spots)))
        return spots[before == np.repeat(before[own], counts)]

    def _ids(self, sym: np.ndarray, word: np.ndarray, n: int) -> list[bytes]:
        """Ids by segment; characters that have no piece are written as bytes."""
        spare = (sym < 0) | (sym >= self.size)
        if spare.any():
            known = dict(zip(self.char_ids.tolist(), self.chars.tolist()))
            ids, words = [], []
            parts = np.flatnonzero(spare)
            last = 0
            for at in parts.tolist():
                s = int(sym[at])
                own = chr(-1 - s if s < 0 else known[s]).encode()
                ids += [sym[last:at], self.byte_ids[list(own)]]
                words += [word[last:at], np.full(len(own), word[at])]
                last = at + 1
            sym = np.concatenate([*ids, sym[last:]])
            word = np.concatenate([*words, word[last:]])
        data = sym.astype(np.int32).tobytes()
        cut = (4 * np.searchsorted(word, np.arange(n + 1))).tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The text of each run ``ids[at[i]:at[i + 1]]``, as UTF-8."""
        sizes = self.length[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        take = np.arange(total) + np.repeat(self.first[ids] - (ends - sizes), sizes)
        data = self.bytes[take].tobytes()
        cut = np.concatenate([[0], ends])[at].tolist()
        texts = [data[a:b] for a, b in zip(cut, cut[1:])]
        loose = np.zeros(len(ids) + 1, np.int64)
        loose[1:] = np.cumsum(self.is_byte[ids])
        for i, text in enumerate(texts):
            if loose[at[i + 1]] > loose[at[i]]:
                try:
                    text.decode()
                except UnicodeDecodeError:
                    text = self._repaired(ids[at[i]:at[i + 1]])
            shown = ids[at[i]:at[i + 1]]
            shown = shown[self.length[shown] > 0]
            if len(shown) and shown[0] != self.unknown and not self.is_byte[shown[0]]:
                text = text.removeprefix(b" ")
            texts[i] = text
        return texts

    def _repaired(self, ids: np.ndarray) -> bytes:
        """The text of ids whose byte pieces are not all UTF-8: each loose byte is U+FFFD."""
        out, loose = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                loose += self.bytes[self.first[i]:self.first[i] + 1].tobytes()
                continue
            while loose:
                for size in range(1, 5):
                    try:
                        out.append(loose[:size].decode().encode())
                        loose = loose[size:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    loose = loose[1:]
            if i is not None:
                out.append(self.bytes[self.first[i]:self.first[i] + self.length[i]].tobytes())
        return b"".join(out)


class Encoder:
    """Encodes whole texts; segments met before are looked up, within a bounded cache."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.find = pieces, re.compile(pieces.segment).findall
        self.known: dict[bytes, bytes] = {}
        self.stop = np.array([pieces.end], np.int32).tobytes()

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with the end id, and the offsets of the texts."""
        mark = MARK.encode()
        cut = [self.find(b" " + t.replace(mark, b" ")) if t else [] for t in texts]
        new = set().union(*cut) - self.known.keys()
        if new:
            if len(self.known) + len(new) > CACHED_SEGMENTS:
                self.known.clear()
                new = set().union(*cut)
            new = list(new)
            self.known.update(zip(new, self.pieces.encode(new)))
        found = self.known.__getitem__
        data = [b"".join([*map(found, c), self.stop]) for c in cut]
        at = np.zeros(len(data) + 1, np.int64)
        np.cumsum([len(d) // 4 for d in data], out=at[1:])
        return np.frombuffer(b"".join(data), np.int32), at


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores after it until no column is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def round_trip(documents: DataFrame, model_file: str, text: str = "text", ids: str = "ids",
               decoded: str | None = "decoded") -> DataFrame:
    """``documents`` with the ids of a text (end id last) and the text that the ids decode to.

    ``ids`` and ``decoded`` name the added columns, which no column of the input may be called;
    without ``decoded`` the ids are not decoded.
    """
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(Pieces(model_file))
    schema = T.StructType([*documents.schema.fields, T.StructField(ids, T.ArrayType(
        T.IntegerType()))] + [T.StructField(decoded, T.StringType())] * bool(decoded))

    def work(batches):
        encoder = Encoder(held.value)
        for batch in parts(batches, 4096):
            for first, flat in runs(batch[text]):
                texts = [flat.text(i) for i in range(len(flat))]
                found, at = encoder(texts)
                columns = batch.slice(first, len(flat)).columns
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found)))
                if decoded:
                    back = encoder.pieces.decode(found, at)
                    columns.append(pa.array(back, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.mapInArrow(work, schema)


def digest(documents: DataFrame, model_file: str) -> DataFrame:
    """Per row of documents: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    done = round_trip(documents.select("doc_id", F.col("text").cast("string").alias("text")),
                      model_file)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
