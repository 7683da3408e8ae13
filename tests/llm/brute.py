"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def substring_dedup(rows, width):
    """rows: (doc_id, text); one (doc_id, n_words, n_removed, sha) each."""
    first = {}
    for doc_id, text in rows:
        words = _WORD.findall((text or "").encode())
        for i in range(len(words) - width + 1) if doc_id is not None else ():
            key = tuple(words[i : i + width])
            first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        words = _WORD.findall((text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - width + 1) if doc_id is not None else ():
            if first[tuple(words[i : i + width])] < doc_id:
                gone[i : i + width] = [True] * width
        out.append((doc_id, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def byte_dedup(rows, length):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if counts[data[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), runs, sha(np.frombuffer(data, np.uint8)[~gone].tobytes())))
    return out


def simhash(text):
    words = _WORD.findall(re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "").encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(marks, bits=2):
    """Group number of each fingerprint."""
    names = list(range(len(marks)))

    def root(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, a in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j]).bit_count() <= bits:
                names[root(i)] = root(j)
    return [root(i) for i in range(len(marks))]


def component_ids(rows):
    groups = linked([simhash(t) for _, t in rows])
    members = defaultdict(list)
    for (doc_id, _), group in zip(rows, groups):
        members[group].append(doc_id)
    return [min((m for m in members[g] if m is not None), default=None) for g in groups]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def private(text):
    """kind:start:end of the base spans."""
    found = []
    for order, (kind, pattern) in enumerate(PII.items()):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]
    return [f"{kind}:{a}:{z}" for a, _, z, kind in sorted(found)]


def top_k(rows, queries, k):
    """rows: (vec_id, list); one (query_id, rank, vec_id, score) each."""

    def integers(vector):
        if not vector or any(x is None or not np.isfinite(x) for x in vector):
            return None
        return [int(np.floor(1024 * float(x))) for x in vector]

    known = [(i, v) for i, v in ((i, integers(v)) for i, v in rows) if i is not None and v]
    out = []
    for own, vector in ((i, v) for i, v in known if i in queries):
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in known if i != own and len(v) == len(vector))
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


_M64 = (1 << 64) - 1
#: Fixed values of the fingerprints: hashes of bytes, the odd multiplier, the steps of the mixer and the bins.
_BYTE_NAMES = np.random.default_rng(20240301).integers(0, 1 << 64, 256, np.uint64, endpoint=False).tolist()
_BASE, _MIX_A, _MIX_B, _SALT, _LOW, _HIGH, _LEVELS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0x51ED2701, 64, 192, 8


def _mix(x):
    x = (x ^ x >> 32) * _MIX_A & _M64
    x = (x ^ x >> 29) * _MIX_B & _M64
    return x ^ x >> 32


def _tossed(values):
    """Each value as twice the lowest bit in which it differs from its left neighbour, plus that bit; the first against its flipped bit 0."""
    out = []
    for value, left in zip(values, [values[0] ^ 1, *values]):
        place = next(k for k in range(64) if (value ^ left) >> k & 1)
        out.append(2 * place + (value >> place & 1))
    return out


def fingerprint(text):
    """Hex fingerprint of a text by locally consistent parsing, symbol by symbol."""
    values = list((text or "").encode())
    names, bins = [_BYTE_NAMES[v] for v in values], {}
    for level in range(1, _LEVELS + 1):
        if not values:
            break
        # Runs of one symbol become one symbol.
        heads, symbols = [], []
        for value, name in zip(values, names):
            if heads and heads[-1] == value:
                symbols[-1][1] += 1
            else:
                heads.append(value)
                symbols.append([name, 1])
        symbols = [_mix(name + n & _M64) if n > 1 else name for name, n in symbols]
        small = heads
        for _ in range(4 if level == 1 else 5):
            small = _tossed(small)
        assert max(small) < 6
        around = [0, *small, 0]
        opens = [i for i in range(len(small)) if i == 0 or around[i] < small[i] >= around[i + 2]]
        phrases = [symbols[a:z] for a, z in zip(opens, [*opens[1:], len(symbols)])]
        names = [_mix(sum(s * pow(_BASE, k, 1 << 64) for k, s in enumerate(phrase)) & _M64) for phrase in phrases]
        for name in names:
            hashed = _mix(name + level + _SALT & _M64)
            place = (hashed >> 32) % _LOW if level == 1 else _LOW + (hashed >> 32) % _HIGH
            bins[place] = min(hashed & 0xFFFFFFFF, bins.get(place, 1 << 32))
        values = names = names if len(names) > 1 else []
    return bytes(1 + bins[i] % 255 if i in bins else 0 for i in range(_LOW + _HIGH)).hex()
