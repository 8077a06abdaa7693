"""Plain versions of operators that SQL cannot express, for small inputs."""

import re

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def near_components(docs):
    """{doc_id: (n_shingles, component)} from (doc_id, text) rows, by an inverted index of all shingles."""
    sets = {i: frozenset(shingles(t)) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    seen = {}
    for i, s in sets.items():
        for x in s:
            seen.setdefault(x, []).append(i)
    common = {}
    for ids in seen.values():
        for a in range(len(ids)):
            for b in range(a):
                k = (ids[b], ids[a])
                common[k] = common.get(k, 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def phrase_hits(text, items, window=10):
    """(n_words, hit positions, item ids) of one text, word by word."""
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(TO_LOWER))
    w, hit, found = split(text), set(), set()
    for item, said in items:
        p = split(said)
        for k in range(max(1, len(p) - window + 1) if p else 0):
            phrase = p[k:k + window]
            for at in range(len(w) - len(phrase) + 1):
                if w[at:at + len(phrase)] == phrase:
                    hit |= set(range(at, at + len(phrase)))
                    found.add(str(item))
    return len(w), sorted(hit), sorted(found)
