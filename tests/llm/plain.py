"""Brute-force versions of the operators, one text at a time."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np

BLANKS = re.compile(rb"[\x20\x09-\x0D]+")
CONTENT = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def blank_words(text):
    return [w for w in BLANKS.split((text or "").encode()) if w]


def lower(raw: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), raw)


def base_rules(text):
    words = blank_words(text)
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(threes)
    covered = {i + k for i, t in enumerate(threes) if often[t] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if blank_words(line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered), failed,
    )


def well_fitted(text, model, band):
    """The fertility verdict of a text that passes the base rules, token by token."""
    import math

    ids = [i for w in text.split() for i in model.encode(w)]
    least, most, share, bits, letters = band
    count = Counter(ids)
    entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in count.values())
    per_token = len("".join(blank_words(text)[k].decode() for k in range(len(blank_words(text))))) / len(ids)
    lettered = sum(c.isalpha() for c in text) / len(ids)
    odd = sum(model.is_byte(i) for i in ids)
    return (
        least <= per_token <= most and 100 * odd <= share * len(ids) and entropy >= min(bits, 0.7 * math.log2(len(ids)))
        and lettered >= letters
    )


def hits(text, items, n=10):
    """(n_words, n_hit, item ids)."""
    words = CONTENT.findall(lower((text or "").encode()))
    inside, named = set(), set()
    for item_id, item in items:
        own = CONTENT.findall(lower((item or "").encode()))
        size = min(n, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                inside |= set(range(i, i + size))
                named.add(str(item_id))
    return len(words), len(inside), sorted(named)


def shingles(text):
    words = blank_words(lower((text or "").encode()).decode())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(rows):
    """doc_id -> (set size, component) of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {k: k for k in range(len(sets))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: (len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


def repeats(texts, length):
    """(bytes, removed, spans, digest, kept) of each."""
    raws = [(t or "").encode() for t in texts]
    often = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - length + 1):
            if often[r[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(r, gone[1:]) if not g)
        out.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def digest32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def crc_of_ids(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def ring_shards(arrivals, clockwise, shards):
    """Shard of each arriving key (its arc), one after another, with loads bounded."""
    n = len(arrivals)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    out = []
    for arc in arrivals:
        shard = next(s for s in clockwise[arc] if room[s])
        room[shard] -= 1
        out.append(shard)
    return out
