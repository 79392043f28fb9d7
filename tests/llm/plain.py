"""Plain versions of the operators, for small tables: everything in memory, nothing clever."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall((text or "").encode())


def shingle_set(text, n):
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(docs, n, percent):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {d: shingle_set(t, n) for d, t in docs}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for e in where[x]:
                if e < d:
                    common[e] += 1
        for e, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[e]) - k):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_repeats(docs, size=20):
    """doc_id -> (words, removed, digest of what is kept)."""
    first = {}
    rows = sorted(docs)
    text = {d: words(t) for d, t in rows}
    for d, w in text.items():
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (d, i))
    out = {}
    for d, w in text.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != (d, i):
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def equal_texts(docs):
    """(doc_id, keep_id, group size, kept, digest) of each row, for ids that don't repeat."""
    groups = defaultdict(list)
    for d, t in docs:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest()].append(d)
    return {d: (min(g), len(g), d == min(g), h) for h, g in groups.items() for d in g}


def shares(sizes, weights=(5, 2, 1)):
    """Targets by halving the step of a common level: each source gets min(cap, level * weight)."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total = min(1.5 * sum(sizes.values()), 2.0 * sum(sizes.values()))
    low, high = 0.0, 1.0 + 2.0 * max([*sizes.values(), 1])
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(2.0 * sizes[s], level * w[s]) for s in order) < total:
            low = level
        else:
            high = level
    return {s: min(2.0 * sizes[s], low * w[s]) for s in order}


def manifest(rows, tampered):
    """[(doc_id, leaf, subroot, root, proof, folded root)] of rows (doc_id, source, lang, n_chars, text), one tree level at a time."""

    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(row):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    def tree(nodes):
        """(root, what stands left and right of each node's ancestors, from below)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, k in enumerate(at):
                low = k // 16 * 16
                paths[i].append(("".join(nodes[low:k]), "".join(nodes[k + 1 : low + 16])))
            nodes, at = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [k // 16 for k in at]
        return nodes[0], paths

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([leaf(r) for r in groups[s]]) for s in order]
    root, above = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for s, (subroot, paths), up in zip(order, trees, above, strict=True):
        for row, path in zip(groups[s], paths, strict=True):
            path, at = path + up, leaf(tampered(row))
            for left, right in path:
                at = h(left, at, right)
            out.append((row[0], leaf(row), subroot, root, h(*(left + right for left, right in path)), at))
    return out


def trie(sequences):
    """{(conv_id, depth): (parent, members, children, leaves, saved, digest of ends)} of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[tuple(sequences[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children.get(p)
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = {}
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(sequences[c]) == len(p))
        out[m[0], len(p)] = (members[p[:-1]][0] if p else None, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return out


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_phrases(text, phrases):
    """(words, [(place, label)]) by comparing every run of words with every phrase."""
    w = LICENSE_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [(i, label) for i in range(len(w)) for phrase, label in phrases.items() if w[i : i + len(phrase.split())] == phrase.split()]


def unsuppressed(found):
    """The detections (start, end, priority, order, label) that lie in no other one of higher priority, greater length or earlier rule, pair by pair."""
    def beats(a, b):
        inside = a[0] <= b[0] and b[1] <= a[1]
        return inside and (a[2] > b[2] or (a[2] == b[2] and (a[1] - a[0] > b[1] - b[0] or (a[1] - a[0] == b[1] - b[0] and a[3] < b[3]))))

    return sorted({b for b in found if not any(beats(a, b) for a in found)})


def quality_features(text, signs):
    """The features of a text, one after another."""
    raw, w = (text or "").encode(), words(text)
    n, count = max(len(raw), 1), Counter((text or "").encode())
    m, each = max(len(w), 1), Counter(w)
    full = [x for x in raw.split(b"\n") if x.strip()]
    share = [count[c] / m for c in signs] + [sum(count[c] for c in kind) / n for kind in (range(65, 91), range(48, 58), range(128, 256))]
    same = sum(a == b for a, b in zip(w, w[1:])) / (len(w) - 1) if len(w) > 1 else 0.0
    once, lines = len(set(full)) / max(len(full), 1), len(full)
    base = [max(len(each), 1) / m, max(each.values(), default=0) / m, same, once, math.log1p(m), math.log1p(lines), math.log1p(m / max(lines, 1)), n / m]
    return [*share, *(math.log1p(20 * x) for x in share), *base, float(not w), math.log1p(20 * same), math.sqrt(1 - once)]


def quality_scores(docs, labels, signs, pairs=20, seed=5, ridge=1e-3, threshold=0.3):
    """doc_id -> score: pairs drawn as the operator draws them, weights by many plain Newton steps, a quantile as the cut."""
    x = {d: np.array(quality_features(t, signs)) for d, t in docs}
    known = sorted(d for d in x if labels.get(d) is not None and zlib.crc32(str(d).encode()) % 5)
    y = np.array([labels[d] for d in known])
    sample = np.array([x[d] for d in known])
    mean, scale = sample.mean(0), sample.std(0) + 1e-6
    z = {d: np.clip((v - mean) / scale, -6, 6) for d, v in x.items()}
    zs = np.array([z[d] for d in known])
    low = np.repeat(np.flatnonzero(y == 0), pairs)
    d = zs[np.random.default_rng(seed).choice(np.flatnonzero(y == 1), len(low))] - zs[low]
    w = np.zeros(d.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(d @ w)))
        grad = sum((pi - 1) * di for pi, di in zip(p, d)) / len(d) + ridge * w
        hess = sum(pi * (1 - pi) * np.outer(di, di) for pi, di in zip(p, d)) / len(d) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    s = zs @ w
    cut, unit = np.quantile(s, (y == 0).mean()), s.std() + 1e-9
    return {k: 1 / (1 + math.exp(-max(-30, min(30, (v @ w - cut) / unit))) * (1 - threshold) / threshold) for k, v in z.items()}


def readings(lattice, log, lexicon, listed, half):
    """{words: log probability} of all ways through a lattice: every word is listed, or made of trigrams, whichever is likelier."""
    code = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27
    out = {}
    for way in itertools.product(*lattice):
        text, p = "".join(x for x, _ in way), sum(q for _, q in way)
        before = 0
        for word in text.split():
            c = [before, 0, *map(code, word)]
            made = half + sum(log[c[i]][c[i + 1]][c[i + 2]] for i in range(len(c) - 2)) + log[c[-2]][c[-1]][0]
            p += max(made, listed if word in lexicon else -math.inf)
            before = c[-1]
        key = tuple(text.split())
        out[key] = max(out.get(key, -math.inf), p)
    return out
