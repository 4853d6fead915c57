"""The quality classifier in plain Python over dense rows: counts, log-count
ratios, dual coordinate descent, cross-fitting and the logistic curve."""

import math
import zlib

import numpy as np

from farebox.llm import quality


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def unit(row, scale):
    v = [r if x else 0.0 for x, r in zip(row, scale)]
    norm = math.sqrt(dot(v, v))
    return [x / norm for x in v] if norm else v


def descent(rows, sign, cost, epochs, seed=1):
    """Every row's constant 1 stands at its end."""
    rows = [[*v, 1.0] for v in rows]
    w, alpha = [0.0] * len(rows[0]), [0.0] * len(rows)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            x = rows[i]
            new = min(max(alpha[i] - (sign[i] * dot(w, x) - 1.0) / dot(x, x), 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w = [a + step * b for a, b in zip(w, x)]
                moved, alpha[i] = max(moved, abs(step)), new
        if moved < 1e-3:
            break
    return w


def logistic(m, y):
    n1 = sum(y)
    t = [(n1 + 1) / (n1 + 2) if a else 1 / (len(y) - n1 + 2) for a in y]
    p, c = 1.0, 0.0
    for _ in range(50):
        q = [1 / (1 + math.exp(-min(30, max(-30, p * x + c)))) for x in m]
        h = [a * (1 - a) for a in q]
        a, b, d = dot(h, [x * x for x in m]) + 1e-6, dot(h, m), sum(h) + 1e-6
        g0, g1 = dot(m, [u - v for u, v in zip(t, q)]) - 1e-6 * p, sum(t) - sum(q) - 1e-6 * c
        det = a * d - b * b
        s0, s1 = (d * g0 - b * g1) / det, (a * g1 - b * g0) / det
        p, c = p + min(2, max(-2, s0)), c + min(2, max(-2, s1))
        if max(abs(s0), abs(s1)) < 1e-8:
            break
    return max(p, 1e-3), c


def scores(docs, labels):
    """docs: id -> text; labels: id -> 0 or 1.  Score of every document."""
    found = {i: set(quality.features(t).tolist()) for i, t in docs.items()}
    train = [i for i in docs if labels.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 5]
    total = [sum(labels[i] == k for i in train) for k in (0, 1)]
    names = sorted(set().union(*(found[i] for i in train)))
    count = [[sum(f in found[i] for i in train if labels[i] == k) for f in names] for k in (0, 1)]
    scale = [0.0 if a + b < 2 else math.log((b + 1) / (total[1] + 2)) - math.log((a + 1) / (total[0] + 2)) for a, b in zip(*count)]

    def dense(i):
        return unit([f in found[i] for f in names], scale)
    train.sort(key=lambda i: (labels[i], quality.features(docs[i]).tobytes()))
    y = [labels[i] for i in train]
    rows, sign = [dense(i) for i in train], [1.0 if a else -1.0 for a in y]
    cost = [0.5 * len(y) / total[a] for a in y]
    held = [0.0] * len(y)
    for k in range(3):
        own = [i for i in range(len(y)) if i % 3 != k]
        w = descent([rows[i] for i in own], [sign[i] for i in own], [cost[i] for i in own], 6)
        for i in range(k, len(y), 3):
            held[i] = dot(w, [*rows[i], 1.0])
    slope, offset = logistic(held, y)
    w = descent(rows, sign, cost, 12)
    # a document's own norm counts n-grams that no training row has, whose scale is zero
    return {i: 1 / (1 + math.exp(-min(30, max(-30, slope * dot(w, [*dense(i), 1.0]) + offset)))) for i in docs}
