"""Plain Python versions of the operators' rules, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(ids, linked):
    """Smallest id reachable for each id, given a symmetric test on pairs."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near(texts, k, percent=80):
    sets = {i: shingle_set(t, k) for i, t in texts.items()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)

    return {i: len(s) for i, s in sets.items()}, groups(sorted(texts), linked)


def chunks(text, modulus=13):
    """(first, last, lines) between neighbouring boundary lines."""
    lines = (text or "").split("\n")
    filled = [i for i, x in enumerate(lines) if x.strip(" ")]
    h = [int(hashlib.md5(lines[i].encode()).hexdigest()[24:32], 16) for i in filled]
    bounds = [i for k, i in enumerate(filled) if (h[k] + 31 * (h[k - 1] if k else 0)) % modulus]
    return [(a, b, tuple(lines[a:b + 1])) for a, b in zip(bounds, bounds[1:])]


def line_dedup(texts):
    """doc_id -> (text, removed): lines of all chunks seen before are cut."""
    seen, out = set(), {}
    for i in sorted(texts):
        x, gone = (texts[i] or "").split("\n"), set()
        for a, b, c in chunks(texts[i]):
            gone |= set(range(a, b + 1)) if c in seen else set()
            seen.add(c)
        out[i] = ("\n".join(line for k, line in enumerate(x) if k not in gone), len(gone))
    return out


def tokens(text):
    return [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]


def leaks(texts, items, window=13, agree=10):
    """Pairs with an aligned window that agrees enough, on any diagonal that a
    run or spaced seed can hit (here: every diagonal)."""
    out = set()
    for i, t in texts.items():
        a = tokens(t)
        for j, u in items.items():
            b = tokens(u)
            if len(b) < 6:  # shorter than every mask
                continue
            for d in range(-len(b) + 1, len(a)):
                lo, hi = max(0, -d), min(len(b), len(a) - d)
                same = [a[d + k] == b[k] for k in range(lo, hi)]
                n = len(same)
                if n >= window:
                    ok = max(sum(same[k:k + window]) for k in range(n - window + 1)) >= agree
                else:
                    ok = n == len(b) and n and sum(same) >= math.ceil(n * agree / window)
                if ok:
                    out.add((i, j))
    return out


def repeated(texts, length):
    """doc_id -> (bytes, removed, spans, kept) by comparing all windows."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            if w in seen:
                gone[p:p + length] = [True] * length
            seen.add(w)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, bytes(c for c, g in zip(data, gone) if not g))
    return out


def ppm(learned, scored, order):
    """log10 probabilities under PPM, estimation D, with exclusion."""
    def symbols(text):
        return bytes([10] * order) + " ".join(words(text)).encode() + b"\n"

    trie = defaultdict(Counter)
    for t in learned:
        s = symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                trie[s[i - k:i]][s[i]] += 1
    out = []
    for t in scored:
        s, total = symbols(t), 0.0
        for i in range(order, len(s)):
            excluded, done = set(), False
            for k in range(order, -1, -1):
                here = trie.get(s[i - k:i])
                if not here:
                    continue
                left = {x: c for x, c in here.items() if x not in excluded}
                n = sum(left.values())
                if s[i] in left:
                    total += math.log10((left[s[i]] - 0.5) / n)
                    done = True
                    break
                if left:
                    total += math.log10(0.5 * len(left) / n)
                excluded |= set(here)
            if not done:
                total -= math.log10(256 - len(excluded))
        out.append(total)
    return out


def base(learned, scored):
    c, ends = Counter(w for t in learned for w in words(t)), len(learned)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    return n, [sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)) + math.log10((ends + 1) / (n + v + 1))
               for t in scored]
