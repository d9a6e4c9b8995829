"""Plain, quadratic versions that the operators' results are held against."""

from __future__ import annotations

import xxhash


def roots(nodes, linked):
    """Least node reachable from each node, by union of all linked pairs."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def simhash(text, shingle=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edit_distance(s, t):
    row = list(range(len(t) + 1))
    for i, a in enumerate(s, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(t, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def removed_lines(docs, edits=1, min_chars=20, min_copies=2, spare=None):
    """{doc_id: (removed line numbers, how many differ from the line that stays)} of (doc_id, text) with distinct ids."""
    shown = {d: [(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\v\f\r")] for d, t in docs}
    seen = sorted((d, i, x) for d in shown for i, x in shown[d])
    lines = sorted({x for _, _, x in seen})
    long = [x for x in lines if len(x) >= min_chars]
    linked = [(a, b) for i, a in enumerate(long) for b in long[:i] if abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits]
    root, count, first, gone = roots(lines, linked), {}, {}, {}
    for _, _, x in seen:
        count[root[x]] = count.get(root[x], 0) + 1
    for d, i, x in seen:
        if count[root[x]] >= min_copies and first.setdefault(root[x], (d, i, x)) != (d, i, x):
            gone.setdefault(d, []).append((i, x))
    for d in list(gone) if spare is not None else []:
        # of documents with as many lines, the text hash decides; tests have none
        sources = [first[root[x]][0] for _, x in gone[d]]
        main = max(sources, key=lambda s: (sources.count(s), s))
        if sources.count(main) >= spare * len(shown[d]):
            kept = {}
            for i, x in gone[d]:
                if first[root[x]][0] == main:
                    kept.setdefault(root[x], i)
            gone[d] = [(i, x) for i, x in gone[d] if kept.get(root[x]) != i]
    return {d: ([i for i, _ in v], sum(x != first[root[x]][2] for _, x in v)) for d, v in gone.items() if v}


def repeated_spans(docs, chunks, min_bytes):
    """{(doc_id, start, stop, bytes, first_doc_id)} of (doc_id, text) with distinct ids; chunks(text) gives (start, stop, bytes, digest)."""
    first, out = {}, set()
    cut, whole = {d: chunks(t or "") for d, t in docs}, {d: len(t or "") for d, t in docs}
    for d in sorted(cut):
        run = None
        for start, stop, size, digest in [*cut[d], (None, None, 0, object())]:
            holder = first.setdefault(digest, (d, start))
            if holder == (d, start):
                if run and (run[2] >= min_bytes or run[:2] == [0, whole[d]]):
                    out.add((d, *run))
                run = None
            else:
                run = [run[0], stop, run[2] + size, run[3]] if run else [start, stop, size, holder[0]]
    return out
