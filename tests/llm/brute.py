"""The contracts in plain Python, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict


def lower(data: bytes) -> bytes:
    return data.lower()


def contamination(docs, items, size=13, share=20):
    """docs and items: lists of (id, text). One dict per document."""
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        n = min(size, len(words))
        for s in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[s:s + n])].add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for n in lengths:
            for s in range(len(words) - n + 1):
                own = windows.get(tuple(words[s:s + n]))
                if own:
                    found |= own
                    hit.update(range(s, s + n))
        ids = ",".join(sorted(map(str, found)))
        out.append({"doc_id": doc, "n_words": len(words), "n_hit": len(hit), "n_items": len(found),
                    "items_sha256": hashlib.sha256(ids.encode()).hexdigest(),
                    "contaminated": len(hit) > 0 and share * len(hit) >= len(words)})
    return out


def jaccard(docs, n=3, percent=90):
    split = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    sets = []
    for doc, text in docs:
        words = split(text)
        sets.append({tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [{"doc_id": doc, "n_shingles": len(s), "component_id": least.get(root(i))}
            for i, ((doc, _), s) in enumerate(zip(docs, sets))]


def repeats(docs, size=400):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for (doc, _), d in zip(docs, data):
        covered = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                covered[i:i + size] = b"\1" * size
        kept = bytes(b for b, c in zip(d, covered) if not c)
        out.append({"doc_id": doc, "n_bytes": len(d), "n_removed": sum(covered),
                    "n_spans": len(re.findall(b"\1+", bytes(covered))), "kept_sha256": hashlib.sha256(kept).hexdigest()})
    return out
