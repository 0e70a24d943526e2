"""Secret scans: fixed patterns, and Markov models of random strings and ordinary identifiers.

Two first-order character models are trained from labelled samples: values that the patterns find in
the corpus are random strings, all other text and the words of ``SAMPLES`` ordinary ones. Both
models are a step between kinds of signs (capital, small letter, digit, mark) times a sign of that
kind. Ordinary letters follow on letters whatever their case, so that a constant is as ordinary as
its words; random ones may be of any alphabet, so that half of all is left to equal chances. The
corpus says little about identifiers, so a step that it does not show keeps a share of ``RARE``.
Transition counts are summed by Spark (a table of fixed size).

Every run of ``least`` characters or more outside of the patterns' spans, so also beside one, is
scored by its pieces of letters and digits; marks between them are as usual in dates and paths and
count for nothing, nor does the kind that a piece begins with. A row of pieces is a secret if its
summed log-likelihood ratio is ``margin`` or more, which outweighs a prior of one random string
among 9e6 runs; of a run the best row is taken.

Spans are code points of the whole text, end exclusive. Defined results: null counts as the empty
text, which has no spans; rows are scanned one by one, repeated ones alike, and texts whole,
whatever their length; an empty table gives no rows; in a corpus without any found secret, or
without other text, both models count as equal and only the patterns find anything.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import parts

LEAST, MARGIN = 8, 16.0
#: Observations that the backoff of a transition counts for, and the share of the samples' letters.
BACKOFF, SAMPLED = 50.0, 0.1
#: The share of steps between kinds of signs that an ordinary text need not show.
RARE = 0.001
#: The share of the found secrets in the steps of random strings, and in their signs.
FOUND_STEPS, FOUND_SIGNS = 0.3, 0.2
#: Labelled words of ordinary identifiers, beside those of the corpus.
SAMPLES = tuple("""
    access account action address after align amount app array attribute author back background
    batch before binary block body box branch buffer button bytes cache call card category channel
    check child class click client close cloud code color column command commit config connect
    content context control convert copy core count create current data database date debug default
    delete depth device display document domain download driver edit element email empty encode
    engine error event execute export extension external factory feature field file filter flag
    folder font form frame function gateway generic global graph grid group handler hash header
    height hidden history home host icon image import index input insert internal invoice item job
    json key label language last layout left length library limit link list load lock login loop
    main manager map mask match max media member memory menu message method mode model month
    network next node null number object offset option order output owner package page param parse
    path pixel plugin policy position prefix process product profile proxy public query queue range
    record region remote report request reset resource response result role root route row schema
    script service session size source stack state status storage switch system table
    """.split())

# The patterns of the scan, in the order of their kinds, with the least lengths.
PATTERNS = (
    ("assign", re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*"
                          rb"[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 24),
)
_LONG_HEX = re.compile(rb"[0-9a-f]{24,}")
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{8,}")
_PIECE = re.compile(rb"[A-Za-z0-9]+")
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_INDEX = np.zeros(256, np.int64)
_INDEX[list(ALPHABET)] = np.arange(len(ALPHABET)) + 1
SIZE = len(ALPHABET) + 1
_SIGN = np.where(_INDEX > 62, 0, _INDEX)
#: Kinds of signs: 0 none, 1 capitals, 2 small letters, 3 digits, 4 marks.
_KIND = np.searchsorted([1, 27, 53, 63], np.arange(SIZE), "right")
_CASELESS = np.arange(SIZE)
_CASELESS[27:53] -= 26
#: Steps from each kind to each, as for any alphabet: a kind is mostly kept.
_ANY_STEP = np.array([[0, 0.3, 0.3, 0.3, 0.1], [0, 0.5, 0.2, 0.25, 0.05], [0, 0.2, 0.5, 0.25, 0.05],
                      [0, 0.25, 0.25, 0.45, 0.05], [0, 0.3, 0.3, 0.3, 0.1]])


def base_spans(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """(start, kind number, end, value start, value end) in bytes, by start and kind."""
    out = []
    for number, (kind, pattern, group, least) in enumerate(PATTERNS):
        pattern = _LONG_HEX if kind == "hex" else pattern  # the same matches, without short ones
        out += [(m.start(), number, m.end(), *m.span(group)) for m in pattern.finditer(text)
                if m.end(group) - m.start(group) >= least]
    return sorted(out)


def _random(text: bytes, base: list, ratios: np.ndarray, least: int, margin: float):
    """Start and end of the best row of pieces of every run that is more likely a random string."""
    rest = bytearray(text)
    for start, _, end, _, _ in base:
        rest[start:end] = b" " * (end - start)
    found = [m.span() for m in _RUN.finditer(rest) if m.end() - m.start() >= least]
    if not found:
        return
    index = _SIGN[np.frombuffer(rest, np.uint8)]
    own = np.where(index > 0, ratios[np.concatenate([[0], index[:-1]]), index], 0)
    most = np.concatenate([[0], np.cumsum(np.maximum(own, 0))])
    for start, end in found:
        if most[end] - most[start] < margin:
            continue
        best, score, first = (0.0, start, end), 0.0, start
        for m in _PIECE.finditer(rest, start, end):
            if score <= 0:
                score, first = 0.0, m.start()
            score += own[m.start():m.end()].sum()
            best = max(best, (score, first, m.end()), key=lambda x: x[0])
        if best[0] >= margin:
            yield best[1:]


def _count(table: np.ndarray, value: bytes) -> None:
    index = _INDEX[np.frombuffer(value, np.uint8)]
    np.add.at(table, (np.concatenate([[0], index[:-1]]), index), 1)


def _steps(table: np.ndarray) -> np.ndarray:
    """Shares of the steps between kinds of signs."""
    sums = np.zeros((5, 5))
    np.add.at(sums, (_KIND[:, None], _KIND[None]), table)
    return sums / np.maximum(sums.sum(1, keepdims=True), 1)


def _letters(table: np.ndarray) -> np.ndarray:
    """Shares of the letters after each sign, whatever the case of both."""
    sums = np.zeros((SIZE, SIZE))
    np.add.at(sums, (_CASELESS[:, None], _CASELESS[None]), table)
    sums = sums[:, 1:27]
    single = (sums.sum(0) + 1) / (sums.sum(0) + 1).sum()
    return (sums + BACKOFF * single) / (sums.sum(1, keepdims=True) + BACKOFF)


def likelihood_ratios(secrets: np.ndarray, ordinary: np.ndarray,
                      samples: tuple[str, ...] = SAMPLES) -> np.ndarray:
    """Log-likelihood ratio, random over ordinary, of each transition, from their counts."""
    words = np.zeros((SIZE, SIZE))
    for word in samples:
        _count(words, word.encode())
    letters = (1 - SAMPLED) * _letters(ordinary) + SAMPLED * _letters(words)
    alike = 1 / np.bincount(_KIND, minlength=5)[_KIND]
    usual = np.tile(alike, (SIZE, 1))
    usual[:, 1:27] = usual[:, 27:53] = letters[_CASELESS]
    seen = secrets.sum(0) + 1
    random = FOUND_SIGNS * seen / np.bincount(_KIND, seen)[_KIND] + (1 - FOUND_SIGNS) * alike
    steps = np.full((2, 5, 5), 1.0)
    steps[0] = FOUND_STEPS * _steps(secrets) + (1 - FOUND_STEPS) * _ANY_STEP
    steps[1] = (1 - RARE) * _steps(ordinary) + RARE * _ANY_STEP[0]
    steps[:, 0] = 1  # the kind that a piece begins with says nothing
    out = np.log(random) - np.log(usual)
    out[:, 1:] += (np.log(steps[0, :, 1:]) - np.log(steps[1, :, 1:]))[_KIND][:, _KIND[1:] - 1]
    return out


def train(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio, random over ordinary, of each transition: SIZE x SIZE."""
    def count(batches):
        tables = np.zeros((2, SIZE, SIZE), np.int64)
        for batch in batches:
            for raw in batch[text].cast(pa.binary()):
                raw = raw.as_py() or b""
                base = base_spans(raw)
                for *_, start, end in base:
                    _count(tables[0], raw[start:end].translate(None, b"."))
                plain = b"".join(raw[s:e] if i % 2 == 0 else b" " for i, (s, e) in enumerate(
                    _around(base, len(raw))))
                index = _INDEX[np.frombuffer(plain, np.uint8)]
                both = index[:-1] * SIZE + index[1:]
                both = both[index[1:] > 0]
                tables[1] += np.bincount(both, minlength=SIZE * SIZE).reshape(SIZE, SIZE)
        kinds, cells = np.nonzero(tables.reshape(2, -1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(cells), pa.array(tables.reshape(2, -1)[kinds, cells])],
            names=["kind", "cell", "n"])

    rows = documents.select(F.col(text).cast("string").alias(text)).mapInArrow(
        count, "kind long, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n"))
    tables = np.zeros((2, SIZE * SIZE))
    for row in rows.collect():  # at most 2 x SIZE x SIZE sums
        tables[row.kind, row.cell] = row.n
    tables = tables.reshape(2, SIZE, SIZE)
    if not tables[0].any() or not tables[1].any():
        return np.zeros((SIZE, SIZE))
    return likelihood_ratios(*tables)


def _around(base: list, size: int):
    """Alternately the gap before and the extent of each (merged) span, and the last gap."""
    last = 0
    for start, _, end, _, _ in base:
        if end > last:
            yield last, max(last, start)
            yield max(last, start), end
            last = end
    yield last, size


def find(text: bytes, ratios: np.ndarray, least: int = LEAST, margin: float = MARGIN):
    """All spans (kind, start, end) in code points by start; the added kind is "markov"."""
    base = base_spans(text)
    spans = [(s, n, e) for s, n, e, _, _ in base]
    spans += [(s, len(PATTERNS), e) for s, e in _random(text, base, ratios, least, margin)]
    names = [kind for kind, *_ in PATTERNS] + ["markov"]
    out, at, points = [], 0, 0
    for start, number, end in sorted(spans):
        points += len(text[at:start].decode())
        at = start
        out.append((names[number], points, points + len(text[start:end].decode())))
    return out


def scan(documents: DataFrame, text: str = "text", ratios: np.ndarray | None = None,
         least: int = LEAST, margin: float = MARGIN) -> DataFrame:
    """doc_id and ``found``: an array of (kind, first, last) for each row of documents."""
    ratios = train(documents, text) if ratios is None else ratios
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()),
                               ("last", pa.int64())]))

    def work(batches):
        for batch in parts(batches):
            found = [[dict(zip(("kind", "first", "last"), s))
                      for s in find(raw.as_py() or b"", ratios, least, margin)]
                     for raw in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)],
                                             names=["doc_id", "found"])

    doc = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(
        work, f"doc_id {doc}, found array<struct<kind:string,first:bigint,last:bigint>>")


def report(documents: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    listed = "array_join(transform({}, s -> concat_ws(':', s.kind, s.first, s.last)), ',')"
    base = listed.format("filter(found, s -> s.kind <> 'markov')")
    return scan(documents, **options).selectExpr(
        "doc_id", *[f"cast(size(filter(found, s -> s.kind = '{k}')) AS bigint) AS n_{k}"
                    for k, *_ in PATTERNS],
        f"sha2(cast({base} AS binary), 256) AS base_sha256", f"{listed.format('found')} AS spans")
