"""Plain-Python forms of the contracts, for small inputs."""

import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(docs, size=5, similarity=75):
    """{id: (n_shingles, component, kept)}"""
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def decontaminate(docs, items, window=10):
    """{id: (n_words, n_hit, n_items, items_sha256)}"""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    grams = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            grams.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = {}
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in grams:
                    hit |= set(range(k, k + size))
                    found |= grams[g]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal_data(text):
    """[(kind, start, end)] of the fixed patterns, by kind and start."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, rx, ok in rules for m in re.finditer(rx, text or "") if ok(m[0])]


def planted_words(rows, divisor=97):
    """{word: n} of (id, text) rows, with the deletions that the checksums ask for."""
    import zlib

    out = {}
    for i, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % divisor == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] = out.get(run, 0) + 1
    return {w: n for w, n in out.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(words, ratio=2):
    """{word: (n, n_near, form, form_n, root)}, every pair compared."""
    form, out = {}, {}
    for w, n in words.items():
        near = sorted((v for v in words if one_edit(w, v)), key=lambda v: (-words[v], v))
        form[w] = near[0] if near and words[near[0]] >= ratio * n else None
        out[w] = (n, len(near), form[w], words.get(form[w]))
    for w in words:
        end = w
        while form[end]:
            end = form[end]
        out[w] += (end,)
    return out


def repeats(rows, window=20):
    """{id: (n_words, n_removed, kept)} of (id, text) rows."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w, gone = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set()
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            if gram in seen:
                gone |= set(range(k, k + window))
            seen.add(gram)
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def hash_tree(hashes, arity=3):
    """(root, [[(hashes to the left, hashes to the right) of each level] of each leaf])"""
    paths, under = [[] for _ in hashes], [[k] for k in range(len(hashes))]
    while len(hashes) > 1:
        runs = [hashes[k : k + arity] for k in range(0, len(hashes), arity)]
        for r, run in enumerate(runs):
            for j in range(len(run)):
                for k in under[r * arity + j]:
                    paths[k].append((run[:j], run[j + 1 :]))
        under = [sum(under[r * arity : r * arity + arity], []) for r in range(len(runs))]
        hashes = [sha("".join(run)) for run in runs]
    return hashes[0], paths


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    import zlib

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: hash_tree([leaf(r) for r in own[g]]) for g in names}
    root, above = hash_tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, above):
        for r, below in zip(own[g], trees[g][1]):
            changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", "") if changed else r[4]))
            for left, right in below + top:
                node = sha("".join(left) + node + "".join(right))
            beside = "".join("".join(left + right) for left, right in below + top)
            out.append((r[0], leaf(r), trees[g][0], root, sha(beside), node, node == root))
    return out
