"""Plain Python versions of the contracts, for comparison on small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def pii_base(text: str | None):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def pii_row(doc_id, text):
    base = pii_base(text)
    n = collections.Counter(k for k, _, _ in base)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    return (doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(joined.encode()).hexdigest()), joined


def host_measures(text: str | None):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
            n < 10 or 100 * len(repeated) > 20 * n)


def shingles(text: str | None, size: int = 3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(docs, percent: int = 90, words: int = 3):
    """{doc_id: (n_shingles, component_id)} for (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, words) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}
