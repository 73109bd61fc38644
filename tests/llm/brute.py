"""Plain restatements of what the operators compute, with their own words, sets and grouping."""

from __future__ import annotations

from collections import Counter, defaultdict

SPACE = " \t\n\v\f\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    out, cur = [], ""
    for c in text or "":
        if c in SPACE:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out + [cur] * bool(cur)


def shingles(text, width=5):
    ws = words(lower(text))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1)))


def groups(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]  # in two steps: a chained assignment would set the root of the new i
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_components(texts: dict, percent=85):
    """doc_id -> smallest doc_id reachable over links of 100 * intersection >= percent * union, all pairs compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = Counter()
    for who in holders.values():
        for k, a in enumerate(who):
            for b in who[k + 1 :]:
                both[a, b] += 1
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, groups(texts, links)
