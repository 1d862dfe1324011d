"""Small document tables with the odd cases, and brute-force forms of the contracts."""

import hashlib
import math
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string, h string, key string, fp string, place string"


def table(spark, texts, ids=None, sources=None):
    """A documents table with extra columns whose names the operators also use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t), "x", "h", "k", "f", "p") for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def long_text(seed, n):
    return " ".join(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[: 3 + i % 6] for i in range(n))


ODD = [None, "", " \t\n ", "one", "one two", "one two", "  ́x ß Ünïcode\x1cjoined", long_text("big", 30_000), long_text("a", 60), long_text("a", 60)]


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {}
    for g in grams:
        many[g] = many.get(g, 0) + 1
    hit = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def simhash(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """node -> least node reachable."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def substring_digest(docs, window=50):
    """docs: (doc_id, text). (doc_id, n_words, n_removed, kept_sha256) of each."""
    first, split = {}, [(i, words(t)) for i, t in docs]
    for i, w in split:
        if i is not None:
            for p in range(len(w) - window + 1):
                g = tuple(w[p : p + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[tuple(w[p : p + window])] < i:
                    gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


# The base patterns as the contract words them.
BASE = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def secret_base(text):
    found = []
    for k, (kind, (pattern, ok)) in enumerate(BASE.items()):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    found.sort()
    n = [sum(x[2] == kind for x in found) for kind in BASE]
    return (*n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in found).encode()).hexdigest())


def crc(text):
    return zlib.crc32((text or "").encode())


BLANKS = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def line_digest(docs, min_docs=10, keep_first=False):
    """docs: distinct (doc_id, text). (doc_id, n_lines, n_dropped, kept_sha256) of each."""
    having, first = {}, {}
    for n, (_, t) in enumerate(docs):
        for p, x in enumerate((t or "").split("\n")):
            k = lower(x.strip(BLANKS))
            having.setdefault(k, set()).add(n)
            first.setdefault(k, (n, p))
    out = []
    for n, (i, t) in enumerate(docs):
        lines = (t or "").split("\n")
        keys = [lower(x.strip(BLANKS)) for x in lines]
        keep = [x for p, (x, k) in enumerate(zip(lines, keys, strict=True)) if not k or len(having[k]) < min_docs or keep_first and first[k] == (n, p)]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return out


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text). (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, i):
        out = []
        for level in tree[:-1]:
            lo = i // 16 * 16
            out.append((i - lo, level[lo : lo + 16]))
            i //= 16
        return out

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(field, r)), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            runs = path(trees[s], i) + path(top, k)
            v = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                v = sha(*map(field, (*r[:4], None if r[4] is None else lower(r[4]))))
            for j, run in runs:
                v = sha(*run[:j], v, *run[j + 1 :])
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], sha(*(x for j, run in runs for x in run[:j] + run[j + 1 :])), v, v == top[-1][0]))
    return out


def trie(rows):
    """rows: (conv_id, turn, role, text). The node rows, with parent None at the root."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - math.trunc(math.fmod(c, 100)), [])[:h] + mine[h:]
    members = {}
    for c, seq in sorted(whole.items()):
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    return [
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children.get(p, 0), leaves[p], saved[p], sha(",".join(str(c) for c in m if len(whole[c]) == len(p))))
        for p, m in members.items()
    ]
