"""Plain versions of what the queries return, for small tables: lists of (doc_id, text, source) rows."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def targets(sizes):
    """{source: target} of {source: size}, by sharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        out = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / share for s in names}
        above = {s for s in names if s not in capped and out[s] > 3 * sizes[s]}
        if not above:
            return out
        capped |= above


PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def base_spans(text):
    """[(start, kind number, end)] sorted."""
    return sorted((m.start(), k, m.end()) for k, (_, p, group, least) in enumerate(PATTERNS)
                  for m in p.finditer(text or "") if len(m[group]) >= least)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def listed(spans):
    return ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in spans)


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def components(rows, n=4, percent=80):
    """{doc_id: smallest doc_id reachable} of [(doc_id, text)]."""
    sets = {d: shingles(t, n) for d, t in rows}
    ids = sorted(sets)
    holders = {}
    for d in ids:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in ids:
        shared = Counter(o for s in sets[d] for o in holders[s] if o < d)
        for o, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[o]) - both):
                a, b = sorted((find(d), find(o)))
                root[b] = a
    return {d: find(d) for d in ids}


def repeats(rows, n=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} of [(doc_id, text)] with unique ids."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - n + 1):
            piece = data[i:i + n]
            if piece in seen:
                gone[i:i + n] = b"\1" * n
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def unigram(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    docs = {d: [*words((t or "").translate(LOWER)), None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in docs}
    counts = Counter(w for d, t in docs.items() if not held[d] for w in t)
    total, kinds = sum(counts.values()), len(counts)
    return {d: (held[d], len(t), sum(counts[w] > 0 for w in t), total,
                sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t))
            for d, t in docs.items()}


def runs(x, least=6, times=4):
    """[(start, length, period)] of all runs, by the comparison of all words p apart for each p."""
    out, n = [], len(x)
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            end = i
            while end + p < n and x[end] == x[end + p]:
                end += 1
            size = end - i + p
            if end > i and size >= max(least, times * p):
                part = x[i:i + size]
                if all(part[d:] != part[:size - d] for d in range(1, p)):
                    out.append((i, size, p))
            i = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(key, text):
    """n_runs, the best run's start, length, period and exponent, and both digests."""
    w = words(text)
    h = zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{p}\n" for s, size, p in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def ngrams(rows, longest=3):
    """{(lang, n, phrase): occurrences} of [(lang, text)]."""
    out = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            out.update((lang or "und", n, " ".join(w[i:i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    return out


def collocations(rows, first, least=10):
    """[(lang, rank, phrase, a, l, r, n, score)] sorted."""
    f = ngrams(rows)
    total = Counter()
    for (lang, n, _), c in f.items():
        total[lang] += c if n == 1 else 0
    rated = {}
    for (lang, n, phrase), a in f.items():
        if n == 1 or a < least:
            continue
        w = phrase.split(" ")
        cuts = [(f[lang, k, " ".join(w[:k])], f[lang, n - k, " ".join(w[k:])]) for k in range(1, n)]
        score, _, l, r = min((1000000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        above = max((c for (g, m, other), c in f.items() if g == lang and m > n and c >= least
                     and f" {phrase} " in f" {other} "), default=0)
        if 100 * above < 50 * a or not above:
            rated.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, total[lang], -score) for lang, found in rated.items()
                  for i, (score, a, p, l, r) in enumerate(sorted(found)[:first], 1))


def suffix_model(texts, depth, least):
    """log10 probabilities of a word and the byte after it, given all bytes before, learnt from texts: mixed, spelled."""
    padding = b"\n" * depth
    symbols = [b" ".join((t or "").encode().lower().split()) + b"\n" for t in texts]
    after = defaultdict(Counter)
    for text in symbols:
        whole = padding + text
        for i in range(depth, len(whole)):
            for n in range(depth + 1):
                after[whole[i - n:i]][whole[i]] += 1
    known = Counter(w for text in symbols for w in text.split() or [b""])
    spoken, kinds, ends = sum(known.values()), len(set(known) - {b""}), len(symbols)

    @functools.cache
    def is_state(context):
        if not context:
            return True
        seen = after.get(context)
        if not seen:
            return False
        total, weight = sum(seen.values()), len(seen) + 1
        return least <= sum(n * math.log((n - 1 + weight * p) / (total - 1 + weight) / p)
                            for s, n in seen.items() for p in [of(context[1:], s)])

    @functools.cache
    def of(context, symbol):
        below = of(context[1:], symbol) if context else 1 / 256
        if not is_state(context):
            return below
        seen = after.get(context, Counter())
        weight = len(seen) + 1
        return (seen[symbol] + weight * below) / (sum(seen.values()) + weight)

    def score(before, word, stop):
        whole = padding + before + word + bytes([stop])
        spelled = sum(math.log10(of(whole[i - depth:i], whole[i])) for i in range(depth + len(before), len(whole)))
        share = (ends if stop == 10 else spoken - ends) / max(1, spoken)
        counted = known[word] * share
        parts = ([math.log10(counted)] if counted else []) + [spelled + math.log10(kinds + 1)]
        return max(parts) + math.log10(sum(10 ** (p - max(parts)) for p in parts)) - math.log10(spoken + kinds + 1), spelled

    return score


def suffix_scores(rows, depth, least):
    """{doc_id: score} of [(doc_id, text)]."""
    score = suffix_model([t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1], depth, least)
    out = {}
    for d, text in rows:
        words, before, mixed, spelled = (text or "").encode().lower().split() or [b""], b"", 0.0, 0.0
        for i, word in enumerate(words):
            stop = 10 if i + 1 == len(words) else 32
            both = score(before, word, stop)
            mixed, spelled = mixed + both[0], spelled + both[1]
            before = (before + word + bytes([stop]))[-depth:]
        out[d] = max(mixed, spelled) + math.log10((1 + 10 ** -abs(mixed - spelled)) / 2)
    return out
