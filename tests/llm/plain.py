"""The contracts once more in plain Python, for small inputs."""

import collections
import hashlib
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PART = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def parts(text):
    return PART.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, width=13, one_in=20):
    """By (doc_id, text): n_words, n_hit, item ids, contaminated."""
    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        if w:
            k = min(width, len(w))
            for s in range(len(w) - k + 1):
                windows[tuple(w[s : s + k])].add("" if item_id is None else str(item_id))
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in windows}:
            for s in range(len(w) - k + 1):
                names = windows.get(tuple(w[s : s + k]))
                if names:
                    hit.update(range(s, s + k))
                    found |= names
        out[doc_id, text] = len(w), len(hit), sorted(found), bool(hit) and one_in * len(hit) >= len(w)
    return out


def shingle_set(text, n=5):
    w = parts(text)
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def joined(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar_groups(docs, percent=80):
    """The component of each row, as the smallest doc_id, by position; every pair is compared."""
    sets = [shingle_set(text) for _, text in docs]
    links = []
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    links.append((i, j))
    roots = joined(links, range(len(docs)))
    ids = collections.defaultdict(list)
    for i, r in roots.items():
        if docs[i][0] is not None:
            ids[r].append(docs[i][0])
    return [(len(sets[i]), min(ids[roots[i]], default=None)) for i in range(len(docs))]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = PART.findall(text)
    places = collections.defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [line for line in text.split("\n") if PART.search(line)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
