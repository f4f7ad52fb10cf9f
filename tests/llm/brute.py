"""Plain single-process versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if len(words) >= k:
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def similar_groups(rows, k, percent):
    """[(id, text)] -> [(size, least id of the component, component)] by comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in holders[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in own:
            holders[s].append(i)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in members.items()}
    return [(len(sets[i]), least[find(i)], find(i)) for i in range(len(rows))]


def remove_repeats(texts, length):
    """[(n_bytes, n_removed, n_spans, sha256 of the rest)] judged on every byte string."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def drop_repeated_runs(rows, run):
    """[(id, text)] -> [(lines, removed, text)]; rows with equal id and text are one place."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for key, text in order:
        lines = text.split("\n") if text is not None else []
        for i in range(len(lines) - run + 1):
            w = tuple(lines[i : i + run])
            if any(x.strip() for x in w):
                first.setdefault(w, (key, text, i))
    out = []
    for key, text in rows:
        lines = text.split("\n") if text is not None else []
        gone = set()
        for i in range(len(lines) - run + 1):
            w = tuple(lines[i : i + run])
            if w in first and first[w] != (key, text, i):
                gone.update(range(i, i + run))
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((len(lines), len(gone), kept))
    return out


def words_marks(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def contamination(text, items, similarity=0.8, k=5):
    """{item id: best similarity} over all windows of an item's size."""
    words, out = words_marks(text), {}
    known = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    for key, item in items:
        own = words_marks(item)
        n = len(own)
        if n < k:
            continue
        want = Counter(tuple(own[i : i + k]) for i in range(n - k + 1))
        if not known & want.keys():
            continue
        for s in range(len(words) - n + 1):
            have = Counter(tuple(words[i : i + k]) for i in range(s, s + n - k + 1))
            low, high = sum((want & have).values()), sum((want | have).values())
            if low / high >= similarity:
                out[key] = max(out.get(key, 0), low / high)
    return out


def allocate(budget, children):
    """{name: (cap, weight)} -> {name: given}: fill by weight, full ones give back."""
    given, open_ = {n: 0 for n in children}, {n for n, (c, w) in children.items() if w and c}
    while open_:
        left = budget - sum(given[n] for n in given if n not in open_)
        total = sum(children[n][1] for n in open_)
        full = {n for n in open_ if children[n][0] * total <= left * children[n][1]}
        if not full:
            for n in open_:
                given[n] = left * children[n][1] // total
            break
        for n in full:
            given[n] = children[n][0]
        open_ -= full
    return given


def mix(rows, weights, budget, max_epochs, seed):
    """[(id, domain, lang, source, text)] -> [copies]."""
    tokens = [len(re.findall(r"[^\x20\x09-\x0D]+", r[4] or "")) for r in rows]
    leaf = [tuple(x if x is not None else "unknown" for x in r[1:4]) for r in rows]
    size = Counter()
    for path, n in zip(leaf, tokens):
        size[path] += n
    levels = ("domain", "lang", "source")
    weight = lambda d, name: weights.get(levels[d], {}).get(name, 1)

    def cap(path):
        return sum(
            n * max_epochs for p, n in size.items()
            if p[: len(path)] == path and all(weight(d, p[d]) for d in range(3))
        )

    given = {(): min(sum(tokens) if budget is None else budget, cap(()))}
    for d in range(3):
        for path in {p[:d] for p in size}:
            names = {p[d] for p in size if p[:d] == path}
            part = allocate(given[path], {n: (cap((*path, n)), weight(d, n)) for n in names})
            given.update({(*path, n): v for n, v in part.items()})
    out = [0] * len(rows)
    for path, total in size.items():
        if not total or not given[path]:
            continue
        full, rest = divmod(given[path], total)
        turn = lambda i: hashlib.md5(
            f"{seed}:{full}:{'' if rows[i][0] is None else rows[i][0]}".encode()
        ).hexdigest()
        own = sorted((turn(i), i) for i in range(len(rows)) if leaf[i] == path)
        by_turn = Counter()
        for t, i in own:
            by_turn[t] += tokens[i]
        upto, run = {}, 0
        for t in sorted(by_turn):
            run += by_turn[t]
            upto[t] = run
        for t, i in own:
            out[i] = full + (rest > 0 and upto[t] <= rest)
    return out
