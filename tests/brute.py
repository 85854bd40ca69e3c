"""Slow, obviously-correct reference implementations for property tests."""


def levenshtein(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def lev_pairs(items, k):
    """items: {id: text} of distinct texts -> {(a, b): d} for a < b within k."""
    ids = sorted(items)
    out = {}
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = items[ids[x]], items[ids[y]]
            if abs(len(a) - len(b)) > k:
                continue
            d = levenshtein(a, b)
            if d <= k:
                out[(ids[x], ids[y])] = d
    return out


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in edges:
        ru, rv = find(u), find(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return {n: min(g) for g in groups.values() for n in g}


def levenshtein_within(a: str, b: str, k: int) -> int:
    """Exact distance when <= k, else k+1 (DP restricted to the k-band)."""
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return k + 1
    big = k + 1
    prev = [j if j <= k else big for j in range(m + 1)]
    for i in range(1, n + 1):
        cur = [big] * (m + 1)
        if i <= k:
            cur[0] = i
        for j in range(max(1, i - k), min(m, i + k) + 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (a[i - 1] != b[j - 1]), big)
        prev = cur
        if min(prev) > k:
            return big
    return prev[m]


def lev_pairs_banded(items, k):
    ids = sorted(items, key=lambda i: (len(items[i]), i))
    out = {}
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = items[ids[x]], items[ids[y]]
            if len(b) - len(a) > k:
                break
            d = levenshtein_within(a, b, k)
            if d <= k:
                out[(min(ids[x], ids[y]), max(ids[x], ids[y]))] = d
    return out
