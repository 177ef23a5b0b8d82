"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def smallest(ids, links):
    """Component ids under links between positions."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(ids)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(ids))]


def grams(text, k):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(ids, texts, k, num, den):
    sets = [grams(t, k) for t in texts]
    where = collections.defaultdict(list)
    links = []
    for i, s in enumerate(sets):
        for j, o in collections.Counter(j for g in s for j in where[g]).items():
            if den * o >= num * (len(s) + len(sets[j]) - o):
                links.append((i, j))
        for g in s:
            where[g].append(i)
    return [len(s) for s in sets], smallest(ids, links)


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(n - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    chars, symbols, dup = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 10 or 100 * len(covered) > 20 * n
    stutter = sum(a == b for a, b in zip(w, w[1:]))
    kept = not (failed or 100 * symbols > 10 * n or 100 * dup > 40 * len(lines) or chars < 2 * n or chars > 15 * n or 100 * stutter > 30 * n)
    return n, chars, symbols, dup, len(covered), failed, kept


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
LISTED = ("assign", "access", "hex", "key", "short", "endpoint")


def secrets(text, scope=200):
    """(base spans, all spans) as (start, kind, end)."""
    text = text or ""
    found = list(ASSIGN.finditer(text))
    base = [(m.start(), 0, m.end()) for m in found if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    base.sort()
    weak = [(m.start(), 3, m.end()) for m in re.finditer(r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{32,64}(?![A-Za-z0-9/+=])", text)
            if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]")) and not any(s < m.end() and m.start() < e for s, _, e in base)]
    weak += [(m.start(), 4, m.end()) for m in found if 6 <= len(m[2]) < 12]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(r"""https?://[^\x20\x09-\x0D"'<>]+""", text)]
    more = set()
    for a, k, b in base:
        if k == 1:
            near = [x for x in base + weak if x[1] in (0, 3, 4, 5) and x[0] <= b + scope and x[2] >= a - scope]
            secret = any(x[1] != 5 for x in near)
            more |= {x for x in near if x[1] in (3, 4) or (x[1] == 5 and secret)}
    return base, sorted(base + list(more))


def spelled(spans):
    return ",".join(f"{LISTED[k]}:{s}:{e}" for s, k, e in spans)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def chat_costs(roles, merge=2, insert=3, relabel=5, name=1):
    """Least cost of a legal conversation from these roles, by trying every edit."""
    kinds = ("system", "user", "assistant")

    def legal(before, x):
        return {"system": before is None, "user": before != "user", "assistant": before == "user"}[x]

    def best(i, before, blanks):
        found = [0] if i == len(roles) and before in (None, "assistant") else []
        if blanks < 3:
            found += [insert + best(i, x, blanks + 1) for x in kinds if legal(before, x)]
        if i < len(roles):
            for x in kinds:
                named = 0 if roles[i] == x else relabel if roles[i] in kinds else name
                if legal(before, x):
                    found.append(named + best(i + 1, x, 0))
                if before == x:
                    found.append(named + merge + best(i + 1, x, 0))
        return min(found, default=10**6)

    return best(0, None, 0)
