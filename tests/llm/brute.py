"""Plain versions of what the operators return."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def windows(words, k):
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def quality(text):
    w = SPACED.findall(text or "")
    count = Counter(x := windows(w, 3))
    cover = {i + j for i, t in enumerate(x) if count[t] > 1 for j in range(3)}
    lines = [s for s in (text or "").split("\n") if SPACED.search(s)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def substrings(rows, k=13):
    """(id, words, removed, digest) of each row; a null id counts as the largest."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, text in rows:
        for t in windows(SPACED.findall(text or ""), k):
            first[t] = min(first.get(t, float("inf")), key(i))
    out = []
    for i, text in rows:
        w = SPACED.findall(text or "")
        gone = {p + j for p, t in enumerate(windows(w, k)) if first[t] < key(i) for j in range(k)}
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def linked(sets, percent=80):
    """Components of sets (by key) whose similarity reaches the percentage."""
    u, places = Union(sets), defaultdict(list)
    for i in sorted(sets):
        for j, n in Counter(j for x in sets[i] for j in places[x]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                u.join(i, j)
        for x in sets[i]:
            places[x].append(i)
    return u


def shingles(text, k):
    w = SPACED.findall(lower(text))
    return set(windows(w, min(k, len(w)))) if w else set()


def normal(line):
    return " ".join(re.split(r"[\x20\x09-\x0D]+", lower(line).strip(" \t\n\r\v\f")))


def kept_lines(rows, shingle=6, whole=20):
    """{id: text} after fuzzy line dedup, for rows of distinct ids."""
    lines = [(i, k, n) for i, text in sorted(rows) if text is not None for k, x in enumerate(text.split("\n")) if (n := normal(x))]
    forms = sorted({n for _, _, n in lines})
    u = linked({f: {f[p : p + shingle] for p in range(len(f) - shingle + 1)} if len(f) >= whole else {f} for f in forms})
    seen, lost = set(), defaultdict(set)
    for i, k, n in lines:
        if (c := u.find(n)) in seen:
            lost[i].add(k)
        seen.add(c)
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost[i]) for i, t in rows}


def contaminated(text, items, k=10):
    """(words, hit words, items found)"""
    w, hit, found = ALNUM.findall(lower(text)), set(), set()
    for name, item in items:
        own = ALNUM.findall(lower(item))
        m = min(k, len(own))
        wanted = set(windows(own, m)) if m else set()
        for p, t in enumerate(windows(w, m)) if m else ():
            if t in wanted:
                hit |= set(range(p, p + m))
                found.add(str(name))
    return len(w), len(hit), sorted(found)
