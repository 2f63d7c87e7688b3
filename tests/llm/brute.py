"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict


def cut_repeats(documents, width=50):
    """documents: (doc_id, text). Returns {doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}; ids must differ."""
    data = {i: (t or "").encode() for i, t in documents}
    least = {}
    for i in sorted(data):
        for s in range(len(data[i]) - width + 1):
            least.setdefault(data[i][s : s + width], i)
    out = {}
    for i, text in data.items():
        gone = bytearray(len(text))
        for s in range(len(text) - width + 1):
            if least[text[s : s + width]] < i:
                gone[s : s + width] = b"\x01" * width
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out[i] = (len(text), sum(gone), len(re.findall(b"\x01+", gone)), hashlib.sha256(kept).hexdigest())
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def benchmark_hits(documents, benchmark, width=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in benchmark:
        w = words(text)
        for s in range(max(len(w) - width, 0) + 1):
            if w:
                windows[tuple(w[s : s + width])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for i, text in documents:
        w = words(text)
        hit, items = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    items |= found
                    hit |= set(range(s, s + n))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(items), digest, bool(hit))
    return out
