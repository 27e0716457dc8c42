"""Plain single-process versions of the contracts, for small inputs."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(docs, shingle=4, distance=4):
    """[(doc_id, text)] -> [(doc_id, fingerprint, component_id)]"""
    prints = []
    for _, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        grams = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
        ones = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        prints.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)))
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            parent[f] = parent[parent[f]]
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    least = {}
    for (doc, _), f in zip(docs, prints, strict=True):
        r = root(f)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(doc, f"{f:016x}", least.get(root(f))) for (doc, _), f in zip(docs, prints, strict=True)]


def decontaminate(docs, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        words = word.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[k:k + size])].add("null" if item is None else str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words, hit, found = word.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if ids := windows.get(tuple(words[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def substring_dedup(docs, window=20):
    """Documents in the order of their ids, null last; equal ids are one place."""
    first, words_of = {}, [WORD.findall(t or "") for _, t in docs]
    rank = {d: i for i, d in enumerate(sorted({d for d, _ in docs if d is not None}))}
    place = lambda d, k: (rank.get(d, len(rank)), k)
    for (d, _), words in zip(docs, words_of, strict=True):
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            first[w] = min(first.get(w, place(d, k)), place(d, k))
    out = []
    for (d, _), words in zip(docs, words_of, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < place(d, k):
                gone.update(range(k, k + window))
        out.append((d, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def token_counts(docs, path, limit=2048):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    n = [len(t.encode(x or "", add_special_tokens=False).ids) for _, x in docs]
    return [(d, len((x or "").encode()), k, k > limit) for (d, x), k in zip(docs, n, strict=True)]


def pieces(docs, path, capacity=4096, end=1):
    from tokenizers import Tokenizer
    t, out = Tokenizer.from_file(path), []
    for d, x in docs:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, end]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((d, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def packing_faults(rows, capacity=4096):
    """Of (sequence_id, offset, length): sequences with gaps, overlaps or too many tokens."""
    by = defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    bad = []
    for s, parts in by.items():
        at = 0
        for o, n in sorted(parts):
            if o != at:
                bad.append(s)
            at = o + n
        if at > capacity:
            bad.append(s)
    return bad


def quality_base(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    repeat = set()
    for k in range(len(words) - 4):
        if grams[tuple(words[k:k + 5])] > 1:
            repeat.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat),
            len(words) < 10 or 100 * len(repeat) > 20 * len(words))


def secret_base(text):
    kinds = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    spans = [(m.start(), i, m.end(), kind) for i, (kind, rx, ok) in enumerate(kinds) for m in rx.finditer(text or "") if ok(m)]
    listed = ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(spans))
    n = Counter(s[3] for s in spans)
    return n["assign"], n["access"], n["hex"], listed
