"""The contracts again, row by row and without regard to speed."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secret_base(text):
    spans = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, "assign", m.end()))
    for order, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                spans.append((m.start(), order, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_base(text):
    spans = []
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    for kind, pattern, valid in kinds:
        spans += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if valid(m[0])]
    return spans


def license_base(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in {
        "under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"
    }.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)),
    )


def quality_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
        n < 50 or 100 * len(hit) > 50 * n,
    )


def simhash(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(rows):
    """``(id, fingerprint, component)`` for each ``(id, text)``, by comparing all pairs."""
    prints = [simhash(t or "") for _, t in rows]
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for (number, _), f in zip(rows, prints):
        if number is not None:
            least[root(f)] = min(number, least.get(root(f), number))
    return [(n, f"{f:016x}", least.get(root(f))) for (n, _), f in zip(rows, prints)]


def contamination(text, items, size=13):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, item_text in items:
        w = WORD.findall(lower(item_text or ""))
        windows = [w[i : i + size] for i in range(len(w) - size + 1)] if len(w) >= size else [w] if w else []
        for window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
    return (
        len(words), len(hit), len(found), digest(",".join(sorted(found))),
        bool(hit) and 20 * len(hit) >= len(words),
    )
