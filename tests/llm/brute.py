"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re

import xxhash

FOLD = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded_words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain_words(text):
    return PLAIN.findall(text or "")


def contamination(texts, items, window=13):
    """texts: list; items: (id, text) list -> per text (n_words, n_hit, ids)."""
    grams = []
    for item, text in items:
        ws = folded_words(text)
        n = min(window, len(ws))
        grams += [(item, ws[i:i + n]) for i in range(len(ws) - n + 1)] if n else []
    out = []
    for text in texts:
        ws, hit, met = folded_words(text), set(), set()
        for item, g in grams:
            for i in range(len(ws) - len(g) + 1):
                if ws[i:i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    if item is not None:
                        met.add(str(item))
        out.append((len(ws), len(hit), sorted(met)))
    return out


def repeats(docs, window=50):
    """docs: (id, text) list -> per doc (n_words, n_removed, kept)."""
    least = {}
    for i, text in docs:
        ws = plain_words(text)
        if i is not None:
            for k in range(len(ws) - window + 1):
                key = tuple(ws[k:k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, text in docs:
        ws = plain_words(text)
        gone = set()
        for k in range(len(ws) - window + 1 if i is not None else 0):
            if least[tuple(ws[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return out


def fingerprint(text, shingle=3):
    ws = plain_words((text or "").translate(FOLD))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """Component number of each of n nodes; linked(i, j) tells links."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash_components(docs, radius=2):
    """docs: (id, text) list -> per doc (fingerprint, smallest id reachable)."""
    fps = [fingerprint(t) for _, t in docs]
    comp = groups(len(docs), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= radius)
    least = {}
    for (i, _), c in zip(docs, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(f, least.get(c)) for f, c in zip(fps, comp)]


def line_set(line):
    return frozenset(plain_words(line))


def line_dedup(docs):
    """docs: (id, text) list with distinct ids, None first -> per id (n_lines, n_removed, kept)."""
    out, seen = {}, []
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        lines = text.split("\n") if text is not None else []
        kept = []
        for line in lines:
            s = line_set(line)
            if s and any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                pass
            else:
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept) if text is not None else None)
    return out


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    return dot / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: {source: words} -> {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        share = total - sum(most * sizes[s] for s in full)
        goal = {s: share * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if goal[s] > most * sizes[s]}
        if not over:
            return {**goal, **{s: float(most * sizes[s]) for s in full}}
        full |= over


def random_texts(n, seed, vocabulary=40, longest=120, breaks=True):
    """Texts from few words, with copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = [("w%d" % i if i % 3 else "Wört%d" % i) for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(60)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and out:
            out.append(rng.choice(out))
            continue
        if kind < 0.4 and out:
            ws = rng.choice(out).split(" ")
            ws[rng.randrange(len(ws))] = "changed"
            out.append(" ".join(ws))
            continue
        ws = [rng.choice(words) for _ in range(rng.randrange(longest))]
        if kind < 0.7:
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = passage
        sep = [rng.choice([" ", " ", " ", "\n", "  "] if breaks else [" "]) for _ in ws]
        out.append("".join(w + s for w, s in zip(ws, sep)))
    return out
