"""BPE over a pair index equals the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import pytest
from tokenizers import Tokenizer

from staywarehouse.llm import bpe, queries

from . import brute

PATH = queries.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_digests(table, docs, edges, nothing, library):
    def wanted(pairs):
        out = []
        for doc, text in pairs:
            ids = library.encode(text or "", add_special_tokens=False).ids
            shown = library.decode(ids, skip_special_tokens=False)
            out.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                        hashlib.sha256(shown.encode()).hexdigest()))
        return sorted(out, key=repr)

    assert got(bpe.digest(table("documents"), PATH)) == wanted(docs)
    assert got(bpe.digest(edges, PATH)) == wanted([(r[0], r[1]) for r in brute.EDGES])
    assert got(bpe.digest(nothing, PATH)) == []


def test_ids_and_texts(edges, library):
    clash = edges.withColumnRenamed("row", "ids").withColumnRenamed("found", "Decoded")
    made = bpe.round_trip(clash, PATH)
    assert made.columns == [*clash.columns, "ids_", "decoded_"]
    for row in made.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids_ == ids and row.decoded_ == library.decode(ids, skip_special_tokens=False)


def texts(seed, n):
    rng = random.Random(seed)
    ranges = [(32, 127)] * 3 + [(0, 0x300), (0x300, 0x558), (0x300, 0x370), (0x370, 0x400),
                                (0x590, 0x800), (0x900, 0xd00), (0x1100, 0x1200), (0x1e00, 0x2070),
                                (0x4e00, 0x4f00), (0xa640, 0xa830), (0xac00, 0xad00),
                                (0xfb00, 0xfe00), (0x1f300, 0x1f700), (0xe000, 0x110000)]
    extra = ["<|endoftext|>", "<|startoftext|>", "<|endof", "'s", "'LL", "Σ", "ΑΣ ", "İ", " \t\n",
             "　", "\x85", "\x1c", "́", "aaa", "hahaha"]
    for _ in range(n):
        out = []
        for _ in range(rng.randint(0, 30)):
            low, high = rng.choice(ranges)
            out.append("".join(chr(rng.randrange(low, high)) for _ in range(rng.randint(1, 6))))
            if rng.random() < 0.1:
                out.append(rng.choice(extra))
        yield rng.choice(["", " "]).join(out)


def test_random_texts(library, monkeypatch):
    some = [*texts(3, 6000), *("a" * k for k in range(70)), "ab" * 300, "x" * 20_000, "the" * 5000,
            "!?" * 999, "1" * 999, ""]
    wanted = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    for cached in (bpe.CACHED_WORDS, 50):
        monkeypatch.setattr(bpe, "CACHED_WORDS", cached)
        encoder, found = bpe.Encoder(bpe.Merges(PATH)), []
        for first in range(0, len(some), 900):
            found += encoder(some[first:first + 900])
            assert len(encoder.known) <= cached
        found = [np.frombuffer(i, np.int32).tolist() for i in found]
        assert found == wanted
    for ids in found:
        assert encoder.merges.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode(library):
    rng, merges = random.Random(4), bpe.Merges(PATH)
    for _ in range(500):
        ids = [rng.randrange(49_500) for _ in range(rng.randint(0, 9))]
        assert merges.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Merges(queries.tokenizer_path("byte_bpe_50k.json"))
