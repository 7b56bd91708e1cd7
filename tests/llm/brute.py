"""Plain versions of what the operators return, for small tables. Rows are (doc_id, text)."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
NULL_FIRST = lambda d: (d is not None, d or 0)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def classes(n, linked):
    """Class number of 0..n-1 under a symmetric relation given as pairs."""
    label = list(range(n))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in linked:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def contamination(docs, items, window=13):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(LOWER))
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            phrases[tuple(w[k : k + window])].add("null" if item is None else str(item))
    out = []
    for d, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    found |= phrases[tuple(w[k : k + n])]
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def simhash(text, shingle=3):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    grams = [" ".join(w[i : i + shingle]) for i in range(max(len(w) - shingle, 0) + 1)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_classes(docs, radius=2):
    prints = [simhash(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return prints, classes(len(docs), pairs)


def simhash_components(docs, radius=2):
    prints, label = simhash_classes(docs, radius)
    out = []
    for (d, _), p, c in zip(docs, prints, label):
        ids = [docs[k][0] for k in range(len(docs)) if label[k] == c and docs[k][0] is not None]
        out.append((d, f"{p:016x}", min(ids, default=None)))
    return out


def phrases_removed(docs, window=20):
    """docs in table order."""
    order = sorted(range(len(docs)), key=lambda k: NULL_FIRST(docs[k][0]))
    seen, out = set(), {}
    for k in order:
        w = re.findall("[^\x20\x09-\x0d]+", docs[k][1] or "")
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            if s in seen:
                gone[i : i + window] = True
            seen.add(s)
        out[k] = (docs[k][0], len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return [out[k] for k in range(len(docs))]


def bytes_removed(docs, window=200):
    bodies = [(t or "").encode() for _, t in docs]
    count = collections.Counter(b[i : i + window] for b in bodies for i in range(len(b) - window + 1))
    out = []
    for (d, _), b in zip(docs, bodies):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, sha(kept)))
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def lines_removed(docs, edits=2, least=20, near=edit_distance):
    """docs in table order; equal lines of any length fold, others from ``least`` characters on."""
    found = [
        (NULL_FIRST(d), k, i, line.strip())
        for k, (d, t) in enumerate(docs)
        for i, line in enumerate((t or "").split("\n"))
        if line.strip()
    ]
    texts = sorted({f[3] for f in found}, key=len)
    pairs = []
    for x, a in enumerate(texts):
        for y in range(x + 1, len(texts)):
            if len(texts[y]) - len(a) > edits:
                break
            if len(a) >= least and near(a, texts[y]) <= edits:
                pairs.append((x, y))
    label = dict(zip(texts, classes(len(texts), pairs)))
    first = {}
    for f in sorted(found):
        first.setdefault(label[f[3]], f[:3])
    gone = {f[1:3] for f in found if first[label[f[3]]] != f[:3]}
    out = []
    for k, (d, t) in enumerate(docs):
        lines = [] if t is None else t.split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if (k, i) not in gone)
        lost = sum((k, i) in gone for i in range(len(lines)))
        out.append((d, len(lines), lost, None if t is None else sha(kept)))
    return out


def ranked(docs, items, top=50):
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    bags = [(d, collections.Counter(word.findall((t or "").translate(LOWER)))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in bags if c), sum(c.total() for _, c in bags)
    df = collections.Counter(t for _, c in bags for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in items:
        terms, scores = set(word.findall((text or "").translate(LOWER))), []
        for d, c in bags:
            m = 50 + 50 * c.total() * n_docs // max(1, n_terms)
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, NULL_FIRST(d), d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:top])]
    return out


def private(docs):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = []
    for d, text in docs:
        spans = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                good = {
                    "email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 8 <= len(digits) <= 15,
                }[kind]()
                if good:
                    spans.append(f"{kind}:{m.start()}:{m.end()}")
        counts = [sum(s.startswith(k) for s in spans) for k in patterns]
        out.append((d, *counts, sha(",".join(spans)), spans))
    return out


def vector_links(rows, threshold=0.95):
    """rows (vec_id, vector)."""

    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = set()
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if sound(a) and sound(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    pairs.add((i, j))
    label = classes(len(rows), pairs)
    out = []
    for i, (v, _) in enumerate(rows):
        ids = [w for k, (w, _) in enumerate(rows) if label[k] == label[i] and w is not None]
        least = min(ids, default=None)
        out.append((v, sum(i in p for p in pairs), least, v == least))
    return out


def conversations(rows):
    """rows (conv_id, turn, role, text)."""
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        written = shown = 0
        for _, _, r, t in turns:
            shown += len(f"[INST]{escaped(r)}[/INST]{escaped(t)}</s>")
            written += shown if r == "assistant" else 0
        written += shown if turns[-1][2] != "assistant" else 0
        out.append((c, len(turns), sha(told), len(loss), sha(loss), written))
    return out


def escaped(text):
    text = text.replace("\\", "\\\\")
    for mark in ("[INST]", "[/INST]", "<s>", "</s>"):
        text = text.replace(mark, mark[0] + "\\" + mark[1:])
    return text


def prefix_trie(rows):
    """rows (conv_id, turn, role, text)."""
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}
    rebuilt = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(told.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        up = members[p[:-1]][0] if p else None
        ends = ",".join(str(c) for c in m if rebuilt[c] == p)
        out.append((m[0], len(p), up, len(m), children[p], leaves[p], saved[p], sha(ends)))
    return out


def secrets(docs):
    patterns = {
        "assign": (r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": (r"AKIA[A-Z0-9]+", 0, 20),
        "hex": (r"[0-9a-f]+", 0, 24),
    }
    out = []
    for d, text in docs:
        spans = []
        for k, (kind, (pattern, group, least)) in enumerate(patterns.items()):
            spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
        spans = [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]
        counts = [sum(s.startswith(k) for s in spans) for k in patterns]
        out.append((d, *counts, sha(",".join(spans)), spans))
    return out
