"""Brute-force versions of the operators, in plain Python."""

import collections
import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        x = int(c)
        if i % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def base_pii(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def contamination(text, items):
    """(n_words, n_hit, item ids) with items as (id, text)."""
    words = ALNUM.findall(lower(text))
    places = collections.defaultdict(list)
    hit, found = set(), set()
    by_size = {}
    for item, body in items:
        w = ALNUM.findall(lower(body))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            places[tuple(w[i : i + size])].append(str(item) if item is not None else "")
            by_size[size] = True
    for size in by_size:
        for i in range(len(words) - size + 1):
            owners = places.get(tuple(words[i : i + size]))
            if owners:
                found |= set(owners)
                hit |= set(range(i, i + size))
    return len(words), len(hit), sorted(found)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_licenses(text):
    words = ALNUM.findall(lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def shingle_set(text, k):
    words = SPACED.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def linked(sets, percent):
    """Component label (smallest index) of each set, by comparing all pairs that share an n-gram."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, j in {(a, b) for v in holders.values() for a in v for b in v if a < b}:
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def without_repeats(docs, length=50):
    """(n_bytes, n_removed, n_spans, sha of the rest) for (id, text) rows, in their order."""
    last = float("inf")
    first = {}
    bodies = [(last if i is None else i, (t or "").encode()) for i, t in docs]
    for i, body in bodies:
        for j in range(len(body) - length + 1):
            gram = body[j : j + length]
            first[gram] = min(first.get(gram, last), i)
    out = []
    for i, body in bodies:
        gone = [False] * len(body)
        for j in range(len(body) - length + 1):
            if first[body[j : j + length]] < i:
                gone[j : j + length] = [True] * length
        rest = bytes(c for c, g in zip(body, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(body), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def repeated_words(docs, size=50):
    """Per (id, text): the words in windows of ``size`` that another document has as well."""
    holders = collections.defaultdict(set)
    words = [ALNUM.findall(lower(t)) for _, t in docs]
    for n, w in enumerate(words):
        for j in range(len(w) - size + 1):
            holders[tuple(w[j : j + size])].add(n)
    return [{i for j in range(len(w) - size + 1) if len(holders[tuple(w[j : j + size])]) > 1 for i in range(j, j + size)} for w in words]
