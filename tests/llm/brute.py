"""Plain forms of the operators' contracts, row by row."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def secrets(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
    return tuple(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(joined.encode()).hexdigest()


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def leaks(documents, items):
    """documents: texts; items: (id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    out = []
    for text in documents:
        words, hit, found = bench_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, bool(hit)))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows):
    """rows: (doc_id, text), ids differ; gives {doc_id: (n_shingles, component_id)}."""
    sets = {i: shingles(t) for i, t in rows}
    parent, having, shared = {i: i for i in sets}, defaultdict(list), Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    for ids in having.values():
        shared.update(combinations(ids, 2))
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}
