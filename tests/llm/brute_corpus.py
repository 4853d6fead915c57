"""Brute-force versions of repeated byte strings, the filter audit and the
clusters, in plain Python, row by row."""

import collections
import hashlib
import itertools
import math
import re


def op11(rows, length=400):
    """rows: (doc_id, text).  Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if hit[i] and (i == 0 or not hit[i - 1]))
        kept = bytes(b for b, h in zip(t, hit) if not h)
        out.append((doc, len(t), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


def failures(rows, doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, *_ in rows):
        out.add("E")
    return out


def op12(rows, labels):
    """rows: (doc_id, text, lang); labels: doc_id -> (quality, toxic).  The rows of the query, as tuples."""
    judged = [(part or "", failures(rows, doc, text or ""), *labels.get(doc, (None, None))) for doc, text, part in rows]
    out = {}
    for part in sorted({j[0] for j in judged}):
        mine = [j for j in judged if j[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                here = [j for j in mine if not j[1] & before]
                gone = [j for j in here if name in j[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(here) - len(gone), len(gone), sum(name in j[1] for j in mine) - len(gone),
                    sum(j[1] == {name} for j in mine), sum(j[2] == 1 for j in gone), sum(j[3] == 1 for j in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def op13(rows, k=8, rounds=10):
    """rows: (vec_id, components).  Per kept vector the row of the query."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))
    centers = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(members[n]) for x in zip(*members[n])] if members[n] else c for n, c in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v in kept] if centers else []
    inertia = collections.Counter()
    for _, d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in found]
