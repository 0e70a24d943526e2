"""Plain versions of the operators, for small inputs, and the rows that all are tried on."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LONG = "lang word " * 30_000
#: doc_id, text, lang, source, n_chars and two columns with names that operators use inside.
EDGES = [
    (1, None, "en", "s", None, 1, "x"), (2, "", "en", "s", 0, 1, "x"),
    (3, " \n\t\n", None, None, 4, None, None), (None, "some words here", "en", "s", 15, 2, "y"),
    (4, LONG, "en", "s", len(LONG), 2, "y"), (5, "x" * 50_000, "de", "s", 50_000, 3, "z"),
    (6, "repeated row", "fr", "t", 12, 3, "z"), (6, "repeated row", "fr", "t", 12, 3, "z"),
    (7, "Ünïcode — 日本語 🙂 tokens\r\nand lines ▁ <s>", "xx", "t", 1, 4, "w"),
    (8, "a\x00b \x0b\x0c c d　e", "", "", 1, 4, "w"),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row long, found string")


def words3(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def decontamination(docs, items, window=13):
    grams = defaultdict(set)
    for item, text in items:
        w = words3(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(str(item))
    sizes = {len(g) for g in grams}
    for doc, text in docs:
        w, hit, found = words3(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                of = grams.get(tuple(w[i:i + n]))
                if of:
                    hit |= set(range(i, i + n))
                    found |= of
        yield (doc, len(w), len(hit), len(found),
               hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
               bool(hit) and 20 * len(hit) >= len(w))


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


def links(docs, n=5, share=0.8):
    """(doc, class, links) of rows with ids, by comparing all pairs."""
    sets = []
    for doc, text in docs:
        w = words3(text)
        sets.append((doc, {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    near = defaultdict(set)
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            common = len(a & b)
            if common and 10000 * common >= round(share * 10000) * (len(a) + len(b) - common):
                near[i].add(j)
                near[j].add(i)
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in near:
        for j in near[i]:
            a, b = root(i), root(j)
            group[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(sets)):
        least[root(i)].append(sets[i][0])
    for i, (doc, _) in enumerate(sets):
        yield doc, min(least[root(i)], key=lambda x: (x is None, x)), len(near[i])


_SECRETS = (
    (r"(?a:(?i:(password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?"
     r"([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24))


def secrets(text):
    found = []
    for k, (pattern, right) in enumerate(_SECRETS):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if right(m)]
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))
    counts = Counter(k for _, k, _ in found)
    return (counts[0], counts[1], counts[2], hashlib.sha256(listed.encode()).hexdigest()), listed


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def templates(docs, least=4, similar=0.7, depth=4):
    """doc -> lines kept, by one sequential tree over all lines (leaves must be small)."""
    seen = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            tokens = tuple("<*>" if re.search("[0-9]", t) else t
                           for t in re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(tokens) >= least:
                a, b = seen.get(tokens, (math.inf, -math.inf))
                seen[tokens] = min(a, doc), max(b, doc)
    leaves = defaultdict(list)
    for tokens, (a, b) in seen.items():
        leaves[len(tokens), tokens[:depth]].append((a, tokens, b))
    return seen, leaves


def grams(text):
    """The 4-grams of code points plus one, repeated marks once; 0 is the edge."""
    out = []
    for c in text or "":
        if not (out and out[-1] == c and 33 <= ord(c) < 127 and not c.isalnum()):
            out.append(c)
    padded = (0, 0, 0, *(ord(c) + 1 for c in out))
    return [padded[i:i + 4] for i in range(len(out))]


def kneser_ney(texts):
    """Modified Kneser-Ney by dictionaries, of what more than one text holds: p(4-gram)."""
    levels = {4: Counter(g for t in texts for g in set(grams(t)))}
    kept = [g for g, n in levels[4].items() if n > 1]
    for order in (3, 2, 1):
        levels[order] = Counter(g[1:] for g in kept)
        kept = list(levels[order])
    cuts, sums = {}, {}
    for order, level in levels.items():
        n = [max(1, sum(v == k for v in level.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        cut = {k: min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1 * k), 0.95 * k) for k in (1, 2, 3)}
        cuts[order] = cut | {1: 1.0} if order == 4 else cut
        own = sums[order] = defaultdict(lambda: [0, 0.0])
        for g, v in level.items():
            own[g[:-1]][0] += v
            own[g[:-1]][1] += cuts[order][min(v, 3)]

    def p(gram):
        order = len(gram)
        below = p(gram[1:]) if order > 1 else 1 / 0x110000
        if gram[:-1] not in sums[order]:
            return below
        total, spare = sums[order][gram[:-1]]
        n = levels[order].get(gram, 0)
        return (n - cuts[order][min(n, 3)] if n else 0) / total + spare / total * below

    return p


def perplexity(rows, width=7.0, least=0.02, most=5.0):
    """Sorted (doc_id, kept, base_failed, perplexity) of (doc_id, lang, text)."""
    out, langs = [], defaultdict(list)
    for doc, lang, text in rows:
        langs[lang or ""].append((doc, text))
    for own in langs.values():
        p, known, scored = kneser_ney([t for _, t in own]), {}, []
        for doc, text in own:
            n_words, *_, failed = base(text)
            places = grams(text)
            for g in set(places) - set(known):
                known[g] = max(-most, math.log(p(g)))
            scored.append((doc, failed, len(places), -sum(known[g] for g in places)))
        passed = [(x / n, n) for _, failed, n, x in scored if not failed]
        at = lambda k, share: sorted(x[k] for x in passed)[
            max(math.ceil(share * len(passed)), 1) - 1]
        for doc, failed, n, x in scored:
            kept = False
            if not failed:
                reach = width * max((at(0, 0.75) - at(0, 0.25)) / 1.349, least)
                reach *= math.sqrt(max(1, at(1, 0.5) / n))
                kept = abs(x / n - at(0, 0.5)) <= reach
            out.append((doc, kept, failed, math.exp(x / n) if n else None))
    return sorted(out, key=repr)


def letter_classes(texts, own=95, classes=128):
    """Code point -> (class, share of the class), of the code points of the texts."""
    n = Counter(c for t in texts for c in t or "")
    ranked = sorted(n, key=lambda c: (-n[c], c))
    block = lambda c: (ord(c) // 128 * 2654435761 % 2 ** 32 >> 16) % (classes - own - 1)
    found = {c: (i + 1, 1.0) for i, c in enumerate(ranked[:own])}
    total = Counter()
    for c in ranked[own:]:
        total[block(c)] += n[c]
    return found | {c: (own + 1 + block(c), n[c] / (total[block(c)] + 1)) for c in ranked[own:]}


def masked_log_p(net, classes, i):
    """log P of class i of a text given two on each side, by a network of one hidden layer."""
    at = lambda k: classes[k] if 0 <= k < len(classes) else 0
    x = [float(v) for k in (i - 2, i - 1, i + 1, i + 2) for v in net["embed"][at(k)]]
    h = [math.tanh(float(b) + sum(a * float(w) for a, w in zip(x, column)))
         for column, b in zip(net["into"].T, net["bias"])]
    z = [float(b) + sum(a * float(w) for a, w in zip(h, column))
         for column, b in zip(net["out"].T, net["base"])]
    return z[at(i)] - max(z) - math.log(sum(math.exp(v - max(z)) for v in z))
