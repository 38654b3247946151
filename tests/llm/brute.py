"""Plain Python forms of what the operators compute."""

import collections
import re

BLANK = r"[\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [word for word in re.split(BLANK, text or "") if word]


class Groups:
    """Connected components by union of sorted ids."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


def shingles(text, size=5):
    found = words((text or "").translate(LOWER))
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def near_groups(texts, percent=75):
    """{id: (n_shingles, component)} of {id: text}, all pairs compared."""
    sets = {i: shingles(text) for i, text in texts.items()}
    groups, where = Groups(sets), collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for shingle in sets[i] for j in where[shingle])
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                groups.join(i, j)
        for shingle in sets[i]:
            where[shingle].append(i)
    return {i: (len(sets[i]), groups.find(i)) for i in sets}


def kept_lines(docs, least=10):
    """{id: (n_lines, n_dropped, text)} of {id: text}."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    first = {}
    for i in sorted(docs):
        for line in (docs[i] or "").split("\n"):
            first.setdefault(key(line), i)
    result = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        left = [line for line in lines if len(key(line)) < least or first[key(line)] == i]
        result[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return result


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    counts = collections.Counter(windows)
    covered = {j for i, window in enumerate(windows) if counts[window] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """{source: target} of {source: size}, by resharing round after round."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[n % len(weights)] for n, name in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = [name for name in names if name not in stopped]
        if not free:
            return {name: repeats * sizes[name] for name in names}
        level = (total - sum(repeats * sizes[name] for name in stopped)) / sum(weight[name] for name in free)
        above = [name for name in free if level * weight[name] > repeats * sizes[name]]
        if not above:
            return {name: repeats * sizes[name] if name in stopped else level * weight[name] for name in names}
        stopped.update(above)
