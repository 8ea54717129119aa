"""Plain versions of the operators, to hold their results against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def secrets(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def suffix(docs: list[tuple[int, bytes]], length: int = 50) -> dict[int, tuple[int, int, int, str]]:
    """By position in docs: n_bytes, n_removed, n_spans, digest."""
    least: dict[bytes, int] = {}
    for i, t in docs:
        for q in range(len(t) - length + 1):
            w = t[q : q + length]
            least[w] = min(least.get(w, i), i)
    out = {}
    for k, (i, t) in enumerate(docs):
        gone = bytearray(len(t))
        for q in range(len(t) - length + 1):
            if least[t[q : q + length]] < i:
                gone[q : q + length] = b"\1" * length
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out[k] = (len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g)))
    return out


def quality(text: str) -> tuple[int, int, int, int, int, bool]:
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, r, n < 20 or 100 * r > 30 * n


def _js(p: list[float], q: list[float]) -> float:
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x) / 2
    return math.sqrt(max(0.0, half(p, q) + half(q, p)))


def verdicts(rows: list[tuple[str, str | None]], measures, common: dict[str, tuple[str, ...]], words: tuple[str, ...]) -> list[tuple]:
    """For (text, language): kept, class distance, word distance, distance of the language's common words."""
    seen = []
    for text, lang in rows:
        n, *_, classes, counts = measures(text.encode())
        own = sum(counts[words.index(w)] for w in common.get(lang, ()))
        share = lambda xs, of: [x / max(1, of) for x in xs]
        seen.append((n, sum(classes), lang if lang in common else "", quality(text)[5], share(classes, sum(classes)), share([*counts, n - sum(counts)], n), share([own, n - own], n)))
    sound = [x for x in seen if not x[3]]
    mean = lambda xs: [round(sum(c) / len(xs), 12) for c in zip(*xs)]
    refs = {lang: [mean([x[k] for x in sound if x[2] == lang]) for k in (4, 5, 6)] for lang in {x[2] for x in sound if x[2]}}
    every = mean([x[4] for x in sound]) if sound else None
    out = []
    for n, chars, lang, failed, *parts in seen:
        refs_here = refs.get(lang) if lang else [every, None, None]
        far, bad = [], failed
        for part, ref, enough, size, base, slack in zip(parts, refs_here or [None] * 3, (chars >= 200, n >= 100, n >= 50), (chars, n, n), (0.12, 0.05, 0.06), (0.5, 4.2, 1.7)):
            far.append(_js(part, ref) if enough and ref else None)
            bad |= far[-1] is not None and far[-1] > base + slack / math.sqrt(size)
        out.append((not bad, *far))
    return out


def fingerprint(text: str) -> int:
    words = WORDS.findall(text.translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps: dict[int, int], bits: int = 3) -> dict[int, int]:
    """Smallest key that links reach."""
    parent = {k: k for k in fps}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    by = defaultdict(list)
    for k, f in fps.items():
        by[f].append(k)
    distinct = sorted(by)
    for i, f in enumerate(distinct):
        for k in by[f]:
            a, b = sorted((root(k), root(by[f][0])))
            parent[b] = a
        for g in distinct[:i]:
            if (f ^ g).bit_count() <= bits:
                a, b = sorted((root(by[f][0]), root(by[g][0])))
                parent[b] = a
    return {k: root(k) for k in fps}


def convolution_score(model, parts_of, widths, text: str) -> float:
    """A text's score from the model's arrays, window by window."""
    words = text.lower().split() or [None]
    vector = lambda w: sum(model.embedding[p].astype(float) for p in parts_of(w, len(model.embedding))) if w else 0 * model.embedding[0].astype(float)
    vectors = [vector(w) for w in words] + [0 * model.embedding[0].astype(float)] * max(widths)
    raw, at = model.base, 0
    for i, width in enumerate(widths):
        for f in range(model.bias.shape[1]):
            best = max(sum(float(vectors[s + j] @ model.filters[at + j, :, f]) for j in range(width)) for s in range(len(words)))
            raw += max(0.0, best + float(model.bias[i, f])) * float(model.out[i, f])
        at += width
    return 1 / (1 + math.exp(-raw))
