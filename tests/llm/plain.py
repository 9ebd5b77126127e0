"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\r\x0b\x0c"


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def shingles(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Sets:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def linked(texts: dict, percent: int = 75) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    groups, ids = Sets(sets), sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                groups.join(i, j)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}


def counts(text: str | None) -> tuple[int, ...]:
    w = words(text, False)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def removed_lines(texts: dict, edits: int, least: int) -> dict:
    """Per text the numbers of the lines that go: equal to an earlier line, and only near to one of another class head."""
    seen, places = {}, []
    for i in sorted(texts):
        for n, line in enumerate((texts[i] or "").split("\n")):
            if line := line.strip(BLANK):
                places.append((i, n, line))
                seen.setdefault(line, (i, n))
    lines = list(seen)
    groups = Sets(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            x, y = lines[a], lines[b]
            if min(len(x), len(y)) >= least and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                groups.join(a, b)
    number = {x: i for i, x in enumerate(lines)}
    head: dict = {}
    for x in lines:
        g = groups.find(number[x])
        head[g] = min(head.get(g, seen[x]), seen[x])
    gone = defaultdict(lambda: ([], []))
    for i, n, line in places:
        if (i, n) != head[groups.find(number[line])]:
            gone[i][(i, n) == seen[line]].append(n)
    return dict(gone)


def tile_cover(doc: list[str], item: list[str], least: int) -> int:
    """Words of the item under greedy tiles, longest first."""
    in_doc, in_item, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and not in_doc[d + n] and not in_item[i + n]):
                    n += 1
                best = max(best, (n, -d, -i))
        n, d, i = best[0], -best[1], -best[2]
        if n < least:
            return covered
        for k in range(n):
            in_doc[d + k] = in_item[i + k] = True
        covered += n


def manifest(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, text, lang, source, n_chars, ...) with leaf, subroot, root, digest of the siblings, root as found, equal."""
    def digest(parts):
        return sha256("".join(parts).encode()).hexdigest()

    def leaf(row, text):
        return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text))

    def found(row):
        if row[1] is None or row[0] is None or zlib.crc32(str(row[0]).encode()) % 5:
            return row[1]
        return re.sub("[A-Z]", lambda m: m[0].lower(), row[1])

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                a = i - i % 16
                paths[k].append((nodes[a:i], nodes[i + 1:a + 16]))
                at[k] = i // 16
            nodes = [digest(nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        return nodes[0], paths

    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row, leaf(row, row[1])))
    trees = []
    for name in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(groups[name], key=lambda r: (r[0][0] is not None, r[0][0] or 0, bytes.fromhex(r[1])))
        trees.append((own, *tree([x for _, x in own])))
    if not trees:
        return []
    root, tops = tree([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for (row, node), path in zip(own, paths):
            now = leaf(row, found(row))
            for before, after in path + top:
                now = digest([*before, now, *after])
            out.append((row[0], node, subroot, root, digest(x for pair in path + top for side in pair for x in side), now, now == root))
    return sorted(out, key=str)


def planted(i, text: str | None) -> str | None:
    """The text with a period repeated to its end, where 10 divides the CRC-32 of its id."""
    h, w = zlib.crc32(str(i).encode()), words(text, lower=False)
    if i is None or h % 10 or not w:
        return text
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(n))


def runs(w: list) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the longest stretches of at least 24 words and three periods."""
    found: dict = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))
