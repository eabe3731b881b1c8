"""Plain single-process versions of operators that SQL cannot express."""

import hashlib
import re
from collections import defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_components(docs):
    """doc_id -> (n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets, by = {}, defaultdict(list)
    for doc_id, text in docs:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        for s in sets[doc_id]:
            by[s].append(doc_id)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    shared = defaultdict(int)
    for ids in by.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def removed(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256) from a set of all strings seen so far."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = hash(data[i : i + length])
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
