"""Plain restatements of the operators over lists of rows, to test them against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def suffix(rows, length=200):
    """(doc_id, text) to (doc_id, n_bytes, n_removed, n_spans, sha256 of what stays)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids_and_prints, radius=2):
    """Component (least id, None if there is none) of each row, by comparing all pairs of fingerprints."""
    prints = sorted({p for _, p in ids_and_prints})
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[i + 1 :]:
            if (p ^ q).bit_count() <= radius:
                parent[root(p)] = root(q)
    least = {}
    for doc, p in ids_and_prints:
        if doc is not None:
            r = root(p)
            least[r] = min(doc, least.get(r, doc))
    return [(doc, f"{p:016x}", least.get(root(p))) for doc, p in ids_and_prints]


def contamination(docs, benchmark, window=13):
    words = lambda t: BENCH_WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in benchmark:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("null" if item is None else str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def best_tokens(token, scores):
    """Piece count of the best segmentation, over all of them; of equal scores the fewest pieces."""
    floor = min(scores.values()) - 10.0
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        n = len(token[end - 1].encode())
        options = [(best[end - 1][0] + n * floor, -(best[end - 1][1] + n))]
        for start in range(end):
            if token[start:end] in scores:
                options.append((scores[token[start:end]] + best[start][0], -(best[start][1] + 1)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def archive(pages, least=1000):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    first = {}
    copies = Counter(p for _, p in payloads)
    for i, p in payloads:
        if i is not None and (p not in first or i > first[p]):
            first[p] = i
    out = []
    for i, p in payloads:
        to = first.get(p) if len(p) >= least and copies[p] > 1 else None
        revisit = to is not None and to != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return out


def digests(rows):
    """(conv_id, turn, role, text) to the digests of each conversation, formatted length aside."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, parts in turns.items():
        parts.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in parts)
        loss = "".join(t for _, _, r, t in parts if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(parts), sha(said), len(loss), sha(loss))
    return out


def letter_grams(text, n=3):
    """Every run of n symbols of the lower-cased letters, words parted and framed by one blank."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = [ord(c) for c in f" {' '.join(words)} "] if words else []
    return [tuple(line[i : i + n]) for i in range(len(line) - n + 1)]


def bundle(text, vector, dims):
    total = [0] * dims
    for a, b, c in letter_grams(text):
        x, y, z = vector(a), vector(b), vector(c)
        for i in range(dims):
            total[i] += x[(i - 2) % dims] * y[(i - 1) % dims] * z[i]
    return total


def languages(rows, vector, dims):
    """(doc_id, text, lang) to (doc_id, language at the least angle, cosine)."""
    made = [bundle(t, vector, dims) for _, t, _ in rows]
    profiles = {}
    for (doc, t, lang), v in zip(rows, made):
        if lang is not None and letter_grams(t) and zlib.crc32(str(doc).encode()) % 4 != 2:
            profiles[lang] = [a + b for a, b in zip(profiles.get(lang, [0] * dims), v)]
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    out = []
    for (doc, t, _), v in zip(rows, made):
        near = {g: cosine(v, p) for g, p in sorted(profiles.items())} if letter_grams(t) else {}
        best = max(near, key=near.get, default="und")
        out.append((doc, best, max(0.0, near.get(best, 0.0))))
    return out


def collocations(rows, least, top):
    """(text, lang) to the ranked phrases of each language, every phrase counted."""
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, f in sorted(counts.items()):
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items() if len(q) > len(p)
            )
            if not inside:
                rows.append((" ".join(p), a, f[p[:k]], f[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return out


def clusters(rows, dims, k=8, rounds=10):
    """Rows of plain k-means over integers, every distance computed."""
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    middles = [v for _, v in drawn[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for t in range(rounds + 1):
        of = [min(range(len(middles)), key=lambda c: (far(v, middles[c]), c)) for _, v in kept]
        if t < rounds:
            for c in range(len(middles)):
                mine = [v for (_, v), m in zip(kept, of) if m == c]
                if mine:
                    middles[c] = [sum(x) // len(mine) for x in zip(*mine)]
    d = [far(v, middles[c]) for (_, v), c in zip(kept, of)]
    per = Counter()
    for c, x in zip(of, d):
        per[c] += x
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return Counter((i, c, x, per[c], sum(d), digest[c]) for (i, _), c, x in zip(kept, of, d))
