"""Plain versions of the operators, row by row, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

def document_order(row):
    """By id, null last, then by the text's signed 64-bit hash (null: the seed)."""
    h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), 42)
    return row[0] is None, row[0] or 0, h - (1 << 64) * (h >> 63)


SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality_base(text):
    text = text or ""
    words = SPACE.findall(text)
    grams = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def fingerprint(text):
    words = SPACE.findall(lower(text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, bits=4):
    """{fingerprint: smallest id reachable} from (id, text) rows."""
    ids = collections.defaultdict(list)
    for i, t in rows:
        ids[fingerprint(t)].append(i)
    left, out = set(ids), {}
    while left:
        group, edge = set(), [left.pop()]
        while edge:
            f = edge.pop()
            group.add(f)
            near = [g for g in left if (f ^ g).bit_count() <= bits]
            left.difference_update(near)
            edge += near
        known = [i for f in group for i in ids[f] if i is not None]
        out |= {f: min(known, default=None) for f in group}
    return out


def contamination(docs, items, size=13):
    """Per document: (id, n_words, n_hit, n_items, digest, contaminated)."""
    windows = collections.defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(lower(text or ""))
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[i:i + size])].add(name)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(w[a:a + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def mix_targets(sizes, cap=3, weights=(1, 2, 3)):
    """{source: target} from {source: size} by resharing until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free -= over
    return out


def repeated_words(rows, size=20):
    """(id, n_words, n_removed, digest) per row; rows are documents in (id, text) order."""
    seen, out = {}, []
    for key in sorted(set(rows), key=document_order):
        words = SPACE.findall(key[1] or "")
        gone = set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in seen:
                gone.update(range(i, i + size))
            seen.setdefault(tuple(words[i:i + size]), key)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_bytes(rows, size=50):
    """{(id, text): (n_bytes, n_removed, n_spans, digest)}; only smaller documents count."""
    seen, out = set(), {}
    for key in sorted(set(rows), key=document_order):
        data = (key[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i:i + size] in seen:
                gone[i:i + size] = b"\x01" * size
        for i in range(len(data) - size + 1):
            seen.add(data[i:i + size])
        spans = len([1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1])])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def recurring_lines(rows, depth=3, min_tokens=3, min_docs=3, min_fixed=0.5):
    """{(id, text): (n_lines, n_dropped, kept text)} by the log-template tree."""
    keys = sorted(set(rows), key=document_order)
    leaves = collections.defaultdict(lambda: collections.defaultdict(set))
    parsed = {}
    for key in keys:
        parsed[key] = []
        for line in (key[1] or "").split("\n"):
            tokens = tuple("<*>" if re.search("[0-9@]", w) else w for w in SPACE.findall(line))
            leaf = (len(tokens), tokens[:depth]) if len(tokens) >= min_tokens else None
            parsed[key].append((line, leaf, tokens))
            if leaf:
                leaves[leaf][tokens].add(key)
    template = {}
    for leaf, lines in leaves.items():
        places = collections.Counter()
        for tokens, docs in lines.items():
            for i, t in enumerate(tokens):
                places[i, t] += len(docs)
        for tokens in lines:
            if len(lines) == 1:
                general = tokens
            else:
                general = tuple(t if t != "<*>" and places[i, t] >= min_docs else "<*>" for i, t in enumerate(tokens))
            if sum(t != "<*>" for t in general) >= min_fixed * len(general) and sum(map(len, lines.values())) >= min_docs:
                template[leaf, tokens] = (leaf, general)
    holders = collections.defaultdict(set)
    for (leaf, tokens), t in template.items():
        holders[t] |= leaves[leaf][tokens]
    order = {key: i for i, key in enumerate(keys)}
    out = {}
    for key in keys:
        left, n = [], 0
        for line, leaf, tokens in parsed[key]:
            t = template.get((leaf, tokens))
            if t and len(holders[t]) >= min_docs and min(holders[t], key=order.get) != key:
                n += 1
            else:
                left.append(line)
        out[key] = (sum(bool(x[0]) for x in parsed[key]), n, "\n".join(left))
    return out


def quality_ratios(text):
    """The six scores of the rules, None where the divisor is 0."""
    text = text or ""
    n_words, chars, symbols, dup, repeat, _ = quality_base(text)
    n_lines = len([x for x in text.split("\n") if SPACE.search(x)])
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    parts = {"symbols_per_word": (symbols, n_words), "duplicate_lines": (dup, n_lines), "repeated_words": (repeat, n_words),
             "upper_case": (upper, letters), "exclamations": (text.count("!"), n_words), "long_words": (chars, n_words)}
    return {name: part / whole if whole else None for name, (part, whole) in parts.items()}


def quality_kept(rows, good, rules, rate=0.01, error=0.05):
    """Ids that base rules and certified cutoffs keep; rows are (id, text, stratum)
    with ids of their own, rules (name, cutoffs from the loosest).  No label is
    toxic, so no word is typical; every eighth id (by its CRC) only teaches, and
    a text is one trial of its stratum."""
    base = [r for r in rows if not quality_base(r[1])[5]]
    scores = {r[0]: quality_ratios(r[1]) | {"toxic_words": 0.0} for r in base}
    over = lambda i, name, cutoff: scores[i][name] is not None and scores[i][name] > cutoff
    held = collections.defaultdict(dict)
    for i, text, stratum in base:
        if i in good and zlib.crc32(str(i).encode()) % 8:
            held[stratum][text] = i
    held = {s: list(ids.values()) for s, ids in held.items()}
    held = {s: ids for s, ids in held.items() if (1 - rate) ** len(ids) <= error / len(rules)}
    cutoffs = {}
    for s, ids in held.items():
        for name, steps in rules:
            for cutoff in steps:
                k, n = sum(over(i, name, cutoff) for i in ids), len(ids)
                if sum(math.comb(n, j) * rate**j * (1 - rate) ** (n - j) for j in range(k + 1)) > error / (len(held) * len(rules)):
                    break
                cutoffs[s, name] = cutoff
    return {i for i, _, s in base if not any((s, name) in cutoffs and over(i, name, cutoffs[s, name]) for name, _ in rules)}
