"""Plain versions of pipeline stages for small tables."""

from collections import Counter


def sound(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    inside = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    return len(words) >= 20 and 100 * len(inside) <= 30 * len(words)


def cut_lines(texts):
    seen, gone = set(), {}
    for d in sorted(texts):
        lines = texts[d].split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if any(x.encode().split() for x in w):
                if w in seen:
                    gone.setdefault(d, set()).update((i, i + 1, i + 2))
                seen.add(w)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in texts.items()}


def components(texts, width, num, den):
    sets = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    for d, s in sets.items():
        for e in {e for g in s for e in holders[g] if e < d}:
            both = len(s & sets[e])
            if den * both >= num * (len(s) + len(sets[e]) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in texts}
