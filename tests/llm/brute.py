"""Plain versions of the contracts, one document or all pairs at a time."""

import hashlib
import re
from collections import defaultdict


def az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontaminate(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", az(t))
    grams = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            if item_id is not None:
                grams[tuple(w[i:i + window])].add(str(item_id))
            else:
                grams[tuple(w[i:i + window])]
    lengths = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[g]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def substrings(docs, size=13):
    words = {}
    first = {}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    key = lambda d: -1 if d is None else d
    for doc_id, text in docs:
        w = split(text)
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, key(doc_id)), key(doc_id))
    out = []
    for doc_id, text in docs:
        w, gone = split(text), set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < key(doc_id):
                gone |= set(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def quality(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = defaultdict(list)
        for i in range(len(w) - 2):
            grams[tuple(w[i:i + 3])].append(i)
        rep = {i + j for g in grams.values() if len(g) > 1 for i in g for j in range(3)}
        n = len(w)
        out.append((doc_id, n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
                    sum(x in lines[:i] for i, x in enumerate(lines)), len(rep), n < 50 or 100 * len(rep) > 50 * n))
    return out


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def ngram_join(docs, size=3, percent=90):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", az(text))
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    near = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            near[g].append(i)
    pairs = {(i, j) for g in near.values() if len(g) < 400 for i in g for j in g if i < j}
    links = [(i, j) for i, j in pairs if 100 * len(c := sets[i] & sets[j]) >= percent * (len(sets[i]) + len(sets[j]) - len(c))]
    comp = components(len(docs), links)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[comp[i]] = min(low.get(comp[i], d), d)
    return [(d, len(sets[i]), low[comp[i]]) for i, (d, _) in enumerate(docs)]


def pii(docs):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fine(kind, span):
        d = [int(c) for c in span if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in span.split("."))
        if kind == "card":
            total = sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d)))
            return 16 <= len(d) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15
    out = []
    for doc_id, text in docs:
        spans = [(k, m.start(), m.end()) for k, p in pats.items() for m in re.finditer(p, text or "") if fine(k, m[0])]
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        out.append((doc_id, *(sum(s[0] == k for s in spans) for k in pats), hashlib.sha256(written.encode()).hexdigest(), written))
    return out
