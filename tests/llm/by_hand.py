"""Plain Python versions of the operators, for small tables. They share no code with the library."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_measures(text):
    words = SPACED.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


def simhash(text):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(prints, ids, max_bits=3):
    """By row the least id that links reach."""
    distinct = sorted(set(prints))
    near = {p: [q for q in distinct if (p ^ q).bit_count() <= max_bits] for p in distinct}
    group = {}
    for p in distinct:
        if p not in group:
            group[p], todo = p, [p]
            while todo:
                for q in near[todo.pop()]:
                    if q not in group:
                        group[q] = p
                        todo.append(q)
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[group[p]] = min(least.get(group[p], i), i)
    return [least.get(group[p]) for p in prints]


def contamination(texts, items):
    """By text (n_words, n_hit, n_items, digest of the items, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        if item is not None and words:
            for i in range(max(1, len(words) - 12)):
                windows[tuple(words[i : i + 13])].add(str(item))
    lengths = sorted({len(w) for w in windows})
    out = []
    for text in texts:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if here := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= here
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def mix_targets(sizes_by_source):
    """Target words by source: shares 1, 2, 3 in turn, none above 3 times its size."""
    order = sorted(sizes_by_source, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, out = float(sum(sizes_by_source.values())), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * share > 3 * sizes_by_source[s]}
        if not above:
            return out | {s: weight[s] * share for s in free}
        for s in above:
            out[s] = 3.0 * sizes_by_source[s]
            left -= out[s]
        free -= above
    return out


def phrases(rows, least=10, longest=3, share=50, top=2000):
    """Sorted (lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    counts, totals, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in able.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        found = []
        for p, a in able.items():
            if around[p] and 100 * around[p] >= share * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def first_faults(rows):
    seen, out = set(), []
    for row in rows:
        end = row[1].rstrip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not end else "duplicate" if row in seen else "" if end in ".!?" else "truncated")
        seen.add(row)
    return out


def cheapest_edits(rows):
    """(cost, audit, digest) of a short conversation of (role, text), from all ways to edit it."""
    ways, faults = [], first_faults(rows)

    def go(i, out, cost, audit):
        if ways and cost > min(ways)[0]:
            return
        roles = [role[:1] for role, _ in out]
        if i == len(rows) and all(roles) and re.fullmatch("(s?(ua)+)?", "".join(roles)):
            ways.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
        if not audit.endswith("II"):
            for role in ("user", "assistant"):
                go(i, [*out, (role, "")], cost + 5, audit + "I")
        if i < len(rows):
            go(i + 1, out, cost + 2, audit + "D")
            if faults[i] not in ("blank", "duplicate"):
                more = cost + (5 if faults[i] == "truncated" else 0)
                go(i + 1, [*out, rows[i]], more, audit + "K")
                for role in ("user", "assistant"):
                    go(i + 1, [*out, (role, rows[i][1])], more + 1, audit + "R")

    ways.append((2 * len(rows), "D" * len(rows), ""))
    go(0, [], 0, "")
    cost, audit, text = min(ways)
    return cost, audit, hashlib.sha256(text.encode()).hexdigest()
