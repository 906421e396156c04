"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def grams(text, n=5):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_links(sets: dict, threshold=0.8):
    """All pairs of keys whose sets are similar enough."""
    holders: dict = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in sets.items():
        common = Counter(o for x in s for o in holders[x] if o > k)
        for o, n in common.items():
            if n >= threshold * (len(s) + len(sets[o]) - n) - 1e-9:
                yield k, o


def fuzzy_lines(docs: list[tuple], n=8, threshold=0.8):
    """[(id, cleaned text, lines, kept)] of [(id, text)] by comparing all distinct lines."""
    blank = " \t\n\x0b\x0c\r"
    first: dict = {}
    for i, (_, text) in enumerate(docs):
        for j, line in enumerate((text or "").split("\n")):
            if line.strip(blank):
                first.setdefault(line.strip(blank), (i, j))
    keys = list(first)
    sets = {k: {s[a : a + n] for a in range(max(1, len(s) - n + 1))} for k, s in enumerate(keys)}
    groups = Sets(sets)
    for a, b in jaccard_links(sets, threshold):
        groups.join(a, b)
    best: dict = {}
    for k, s in enumerate(keys):
        r = groups.root(k)
        best[r] = min(best.get(r, first[s]), first[s])
    stay, out = set(best.values()), []
    for i, (doc_id, text) in enumerate(docs):
        lines = (text or "").split("\n")
        full = [j for j, x in enumerate(lines) if x.strip(blank)]
        kept = [j for j in full if (i, j) in stay]
        if text is None or len(kept) == len(full):
            cleaned = text
        else:
            cleaned = "\n".join(x for j, x in enumerate(lines) if j in kept or j not in full) if kept else ""
        out.append((doc_id, cleaned, len(full), len(kept)))
    return out


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def _climb(levels, at, found):
    siblings = []
    for nodes in levels[:-1]:
        run = nodes[at - at % 3 : at - at % 3 + 3]
        siblings += run[: at % 3] + run[at % 3 + 1 :]
        found = digest(*run[: at % 3], found, *run[at % 3 + 1 :])
        at //= 3
    return siblings, found


def manifest(rows, tamper):
    """Of rows (doc_id, source, lang, n_chars, text): [(doc_id, leaf, subroot, root, proof, folded root, verified)]."""
    leaf = lambda r: digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: _tree([leaf(r) for r in groups[s]]) for s in sources}
    top = _tree([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            low, x = _climb(trees[s], i, leaf((*r[:4], tamper(r))))
            high, x = _climb(top, k, x)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest(*low, *high), x, x == top[-1][0]))
    return out
