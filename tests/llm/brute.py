"""Plain single-process versions of the operators, for small tables."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split(f"[{SPACES}]+", text or "") if w]


def line_dedup(docs, min_chars=40, min_docs=5):
    """(text, n_lines, n_dropped) of every (id, text)."""
    def key(line):
        return line.strip(SPACES).translate(LOWER)

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs
                or i is not None and i == max(h for h in holders[key(x)] if h is not None)]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def hits(docs, items, span=10):
    """(n_words, n_hit, sorted items) of every text."""
    def split(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))

    windows = defaultdict(set)
    for item, text in items:
        found = split(text)
        size = min(span, len(found))
        for i in range(len(found) - size + 1 if found else 0):
            windows[tuple(found[i:i + size])].add(str(item))
    out = []
    for text in docs:
        found, hit, names = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if tuple(found[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    names |= windows[tuple(found[i:i + size])]
        out.append((len(found), len(hit), sorted(names)))
    return out


def shingles(text, size=4):
    found = [w.translate(LOWER) for w in words(text)]
    return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def near_duplicates(docs, percent=85, size=4):
    """{id: smallest id it can reach}."""
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, shingles(text, size)) for i, text in docs]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, found = text or "", words(text)
    times = Counter(zip(found, found[1:], found[2:]))
    covered = {p for i in range(len(found) - 2) if times[tuple(found[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def quality(docs):
    """The rows of op9 for (id, text, lang): id, base columns, base_failed, kept."""
    def classes(text, base):
        found = [len(re.findall("[A-Z\xc0-\xde]", text)), len(re.findall(r"[.,;:?!'\"()-]", text)), len(text) - base[1], base[2]]
        return [*found, len(text) - sum(found)]

    def distance(p, q):
        return math.sqrt(max(0, sum(x * math.log2(x / ((a + b) / 2)) for a, b in zip(p, q) for x in (a, b) if x > 0) / 2))

    judged = [(i, text or "", lang, base_rules(text)) for i, text, lang in docs]
    learnt = [(lang, classes(text, base), len(text), words(text)) for _, text, lang, base in judged if base[0] >= 50]
    sums, holders, counts = defaultdict(lambda: [0] * 5), Counter(), defaultdict(Counter)
    for lang, found, size, held in learnt:
        for key in (lang, "all"):
            sums[key] = [a + n * 1_000_000 // size for a, n in zip(sums[key], found)]
        holders[lang] += 1
        counts[lang].update(held)
    shares = {lang: [n / sum(total) for n in total] for lang, total in sums.items()}
    own = [lang for lang in holders if lang is not None and holders[lang] >= 20 and counts[lang].total() >= 5000]
    common = {lang: sorted(counts[lang], key=lambda w: (-counts[lang][w], w))[:24] for lang in own}
    out = []
    for i, text, lang, base in judged:
        failed, strays = base[0] < 50 or 100 * base[4] > 50 * base[0], False
        compared = [shares[lang]] if lang in own else [shares[k] for k in [*own, "all"] if k in shares] if lang is None else []
        if not failed and len(text) >= 100 and compared:
            found = [n / len(text) for n in classes(text, base)]
            strays = min(distance(found, c) for c in compared) > 0.13 + 1 / math.sqrt(len(text))
        if not failed and lang in own:
            held, total = Counter(words(text)), counts[lang].total()
            p, q = [held[w] / base[0] for w in common[lang]], [counts[lang][w] / total for w in common[lang]]
            strays |= distance([*p, 1 - sum(p)], [*q, 1 - sum(q)]) > 0.14 + 1.65 / math.sqrt(base[0])
        out.append((i, *base, failed, not failed and not strays))
    return out


def dedup_units(docs, min_words=6):
    """(kept text, [(start, end)]) of every (id, text), ids distinct and not NULL."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        kept, removed, at = "", [], 0
        for unit in re.finditer(r"(?:[^\n.!?]|[.!?]+(?![.!?\s]))*(?:[.!?]+(?=\s)|\n|[.!?]*\Z)", text or ""):
            start = unit.start() + len(unit[0]) - len(unit[0].lstrip())
            norm = " ".join(unit[0].lower().split())
            if len(norm.split()) >= min_words:
                if norm in seen:
                    end = start + len(unit[0].strip())
                    kept, at = kept + text[at:start], end
                    removed.append((start, end))
                seen.add(norm)
        out[i] = kept + (text or "")[at:], removed
    return [out[i] for i, _ in docs]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def audit(docs, labels):
    """{(part, order, step): measures} of the rows (id, text, part) and labels (id, quality, toxic)."""
    def fails(i, text):
        found = words(text)
        yield "A", len(found) < 50
        yield "B", 100 * len(set(found)) < 65 * len(found)
        yield "C", 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)
        yield "D", any(c in text for c in "#$%&*|")
        yield "E", i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)

    marks, out = defaultdict(set), {}
    for i, quality, toxic in labels:
        marks[i] |= {name for name, label in (("good", quality), ("toxic", toxic)) if label == 1}
    judged = [(part or "", {x for x, bad in fails(i, text or "") if bad}, marks[i] if i is not None else set()) for i, text, part in docs]
    for part in {p for p, _, _ in judged}:
        own = [(f, m) for p, f, m in judged if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                failing = [x for x in own if letter in x[0]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(f == {letter} for f, _ in failing),
                                                   sum("good" in m for _, m in gone), sum("toxic" in m for _, m in gone)]
        for (p, order, step), measures in out.items():
            if p == part:
                measures.append(shapley[order[step - 1]])
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def spelling_words(docs):
    """Counter of the words of (id, text) rows, with the letters deleted that the rule names."""
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 6 and n >= 5})


def variants(counts):
    """{word: (form, root, n, n_near, form_n)}."""
    near = {w: [x for x in counts if abs(len(x) - len(w)) <= 1 and edit_distance(w, x) == 1] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def simhash(text, size=3):
    found = [w.translate(LOWER) for w in words(text)]
    shingles = [" ".join(found[i:i + size]) for i in range(max(1, len(found) - size + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def closed(ids, linked):
    """{id: smallest id it can reach} for the pairs of ``ids`` for which ``linked`` holds."""
    ids = sorted(set(ids))
    least = {i: i for i in ids}
    pairs = [(i, j) for n, i in enumerate(ids) for j in ids[:n] if linked(i, j)]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return least
