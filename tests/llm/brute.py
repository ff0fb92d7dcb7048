"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=True):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return WORD.findall(text)


def shingle_set(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(texts):
    """For each text the numbers of all texts in reach over links of similarity 0.75."""
    sets = [shingle_set(t) for t in texts]
    of = list(range(len(texts)))

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                of[root(a)] = root(b)
    groups = defaultdict(list)
    for n in range(len(texts)):
        groups[root(n)].append(n)
    return [groups[root(n)] for n in range(len(texts))], [len(s) for s in sets]


def without_repeats(texts, n):
    """(words, number removed, words kept) of each text."""
    split = [words(t, lower=False) for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = {p for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for p in range(i, i + n)}
        out.append((len(w), len(gone), [x for p, x in enumerate(w) if p not in gone]))
    return out


def bag(text_words):
    if not text_words:
        return Counter()
    if len(text_words) < 5:
        return Counter([tuple(text_words)])
    return Counter(tuple(text_words[i : i + 5]) for i in range(len(text_words) - 4))


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def best_item(text, items):
    """(item, similarity, place) of the most similar window that is as long as the item, or None."""
    w = words(text)
    found = []
    for item, item_text in items:
        iw = words(item_text)
        if not iw or not w or min(len(w), len(iw)) < 5 and len(w) != len(iw):
            continue
        for at in range(max(1, len(w) - len(iw) + 1)):
            s = similarity(bag(w[at : at + len(iw)]), bag(iw))
            if s >= 0.75:
                found.append((s, -item, -at))
    if not found:
        return None
    s, item, at = max(found)
    return -item, s, -at
