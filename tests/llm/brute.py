"""What the operators must give, worked out plainly on a few documents: lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def decontamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])] |= {str(i)} - {"None"}
    out = []
    for i, t in docs:
        w, hit, found = word.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {x for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for x in range(k, k + 5)}
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed))
    return out


def repeats(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    counts = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        steps = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                steps[p] += 1
                steps[p + length] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(bytes(np.frombuffer(t, np.uint8)[~gone]))))
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_duplicates(docs):
    """doc_ids must be different."""
    sets = {i: shingles(t) for i, t in docs}
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), root(i), root(i) == i) for i, s in sets.items()]


def spans_of(found, kinds):
    found = sorted(found, key=lambda x: (x[1], kinds.index(x[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found), [sum(f[0] == k for f in found) for k in kinds]


def personal(docs):
    def luhn(x):
        total = 0
        for i, c in enumerate(reversed(x)):
            n = int(c) * (1 + i % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    out = []
    for i, t in docs:
        t = t or ""
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
        found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
        found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
        text, counts = spans_of(found, ["email", "ip", "card", "phone"])
        out.append((i, *counts, sha(text)))
    return out


def secrets(docs):
    name = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    assign = re.compile(rf"""({name}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = []
    for i, t in docs:
        t = t or ""
        found = [("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text, counts = spans_of(found, ["assign", "access", "hex"])
        out.append((i, *counts, sha(text)))
    return out


def pieces(docs, tokenizer):
    out = []
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)
        out += [(i, p, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for p, a in enumerate(range(0, len(ids), 4096))]
    return out
