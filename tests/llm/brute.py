"""Plain versions of the operators, for small inputs."""

import hashlib


def repeats(rows, width, words):
    """(doc, units, removed, spans, sha256) of remove_repeats."""
    units = [(d, (t or "").encode().split() if words else (t or "").encode()) for d, t in rows]
    first = {}
    for d, u in units:
        for i in range(len(u) - width + 1):
            w = tuple(u[i : i + width])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, u in units:
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if first[tuple(u[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        left = [x for x, g in zip(u, gone) if not g]
        kept = b" ".join(left) if words else bytes(left)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(u), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)
