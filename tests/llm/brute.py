"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from math import exp, log, log2, log10

import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(number: str) -> bool:
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


def personal(text: str | None) -> dict[str, list[tuple[int, int]]]:
    t = text or ""
    spans = lambda p, ok: [m.span() for m in p.finditer(t) if ok(m[0])]
    return {
        "email": spans(EMAIL, lambda x: True),
        "ip": spans(IP, lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": spans(CARD, lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
        "phone": spans(PHONE, lambda x: 9 <= len(digits(x)) <= 15),
    }


def terms_outside(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    found = [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+", text) if len(m[0]) > 2]
    return [(t, a, b) for t, a, b in found if not any(a < y and x < b for x, y in spans)]


def disclosed(rows: list[tuple[int, str | None]], reach: int = 8, alpha: float = 1.25) -> list[list[str]]:
    """For each row its spans: the base ones, then terms that give an entity away."""
    texts = [t or "" for _, t in rows]
    found = [personal(t) for t in texts]
    entities: list[list[tuple[tuple[str, str], int, int]]] = []
    for t, kinds in zip(texts, found, strict=True):
        name = lambda k, v: (k, v.lower() if k in ("email", "ip") else digits(v))
        entities.append([(name(k, t[a:b]), a, b) for k, s in kinds.items() for a, b in s])
    outside = [terms_outside(t, [(a, b) for _, a, b in e]) for t, e in zip(texts, entities, strict=True)]
    n_e, n_et, n_t, seen = Counter(), Counter(), Counter(), {}
    for t, ents, terms in zip(texts, entities, outside, strict=True):
        n_t.update(set(re.findall(r"\w+", t.lower())))
        n_e.update({e for e, _, _ in ents})
        near = set()
        for e, a, b in ents:
            before, after = [x for x, s, _ in terms if s < a][-reach:], [x for x, s, _ in terms if s >= b][:reach]
            near |= {(e, x) for x in before + after}
        n_et.update(near)
        for pair in near:
            seen.setdefault(pair, set()).add(t)
    told = {}
    for (e, x), n in n_et.items():
        if len(seen[e, x]) > 1 and n_e[e] < len(rows) and log2(len(rows) * n / (n_e[e] * n_t[x])) >= log2(len(rows) / n_e[e]) / alpha:
            told.setdefault(e, set()).add(x)
    out = []
    for kinds, ents, terms in zip(found, entities, outside, strict=True):
        hide = set().union(*[told.get(e, set()) for e, _, _ in ents])
        out.append([f"{k}:{a}:{b}" for k, s in kinds.items() for a, b in s] + [f"term:{a}:{b}" for x, a, b in terms if x in hide])
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = SPACE.findall((text or "").translate(AZ))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_copies(rows: list[tuple[int, str | None]], n: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size, least id of the component), every pair with a common shingle tried."""
    sets = {d: shingles(t, n) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    held: dict[tuple, list[int]] = {}
    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in held.get(s, ()))
        for e, k in common.items():
            if den * k >= num * (len(sets[d]) + len(sets[e]) - k):
                a, b = sorted((find(d), find(e)))
                up[b] = a
        for s in sets[d]:
            held.setdefault(s, []).append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> dict[int, tuple]:
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = PLAIN.findall((t or "").translate(AZ))
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(i)
    lengths = {len(w) for w in windows}
    out = {}
    for d, t in docs:
        w = PLAIN.findall((t or "").translate(AZ))
        hit, ids = set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if found := windows.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    ids |= found
        out[d] = (len(w), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def token_scores(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    tokens = {d: [*SPACE.findall((t or "").translate(AZ)), "\0"] for d, t in rows}
    c = Counter(x for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 10 for x in t)
    n, v = sum(c.values()), len(c)
    return {d: (zlib.crc32(str(d).encode()) % 10 == 0, len(t), sum(c[x] > 0 for x in t), n, sum(log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) for d, t in tokens.items()}


def model_scores(rows: list[tuple[int, str | None]], mu: float = 8.0, discount: float = 0.4) -> dict[int, float]:
    """log10 probabilities from counts of tokens and pairs known only by their powers of two."""
    tokens = {d: [*SPACE.findall((t or "").translate(AZ)), "\0"] for d, t in rows}
    learnt = [t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 10]
    one, two = Counter(x for t in learnt for x in t), Counter(p for t in learnt for p in zip(["\0", *t], t, strict=False))
    n, v = sum(one.values()), len(one)

    def middle(c: int) -> float:
        low = 1 << (c.bit_length() - 1) if c else 0
        return (3 * low - 1) / 2 if c else 0.0

    out = {}
    for d, t in tokens.items():
        total = 0.0
        for before, w in zip(["\0", *t], t, strict=False):
            ahead = middle(one[before])
            pair = max(0.0, min(middle(two[before, w]), ahead) - discount)
            total += log10((pair + mu * (middle(one[w]) + 0.1) / (n + 0.1 * (v + 1))) / (ahead + mu))
        out[d] = total
    return out


def machine_score(counts: dict[int, int], w0: float, w: dict[int, float], v: dict[int, list[float]]) -> float:
    """Factorization machine with every pair of terms written out."""
    x = {k: log(1 + n) for k, n in counts.items() if k in w}
    z = w0 + sum(w[k] * x[k] for k in x)
    keys = sorted(x)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            z += sum(p * q for p, q in zip(v[a], v[b], strict=True)) * x[a] * x[b]
    return 1 / (1 + exp(-z))


def site_scores(rows: list[tuple[str, str, float, bool]], trust: float = 0.5, swing: float = 1.0) -> list[tuple[float, float, float]]:
    """(host mean, path mean, score) for rows (host, path, evidence, has words)."""
    logit = lambda p: log(p / (1 - p))
    inside = lambda p: min(1 - 1e-6, max(1e-6, p))
    strength = lambda between, m: min(1000.0, max(1.0, m * (1 - m) / max(between, 1e-6) - 1))
    mean = min(0.999, max(0.001, sum(e for *_, e, _ in rows) / len(rows)))
    hosts: dict[str, list[float]] = {}
    paths: dict[tuple[str, str], list[float]] = {}
    for h, p, e, _ in rows:
        hosts.setdefault(h, []).append(e)
        paths.setdefault((h, p), []).append(e)
    between = sum(len(x) * (sum(x) / len(x) - mean) ** 2 for x in hosts.values()) / len(rows)
    a = strength(between, mean)
    host_mean = {h: (sum(x) + a * mean) / (len(x) + a) for h, x in hosts.items()}
    within = sum(len(x) * (sum(x) / len(x) - host_mean[h]) ** 2 for (h, _), x in paths.items()) / len(rows)
    path_mean = {}
    for (h, p), x in paths.items():
        b = strength(within, host_mean[h])
        path_mean[h, p] = (sum(x) + b * host_mean[h]) / (len(x) + b)
    out = []
    for h, p, e, words in rows:
        site = min(swing, max(-swing, trust * (logit(inside(path_mean[h, p])) - logit(mean))))
        z = logit(inside(e)) + site if words else -14.0
        out.append((host_mean[h], path_mean[h, p], 1 / (1 + exp(-z))))
    return out


def without_repeats(rows: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, str]]:
    words = {d: SPACE.findall(t or "") for d, t in rows}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        for p in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][p : p + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < d:
                gone.update(range(p, p + window))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


class _Int(int):
    """An integer of 4 bytes."""


def _xx(*values) -> int:
    """Hash of several values, each seeded with the one before; longs are 8 bytes."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v % (1 << 64)).to_bytes(8, "little")[: 4 if isinstance(v, _Int) else 8]
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def order_minhash(text: str | None, k: int = 3, buckets: int = 64) -> set[tuple[int, int]]:
    """(bucket, 24 bits of its tuple's hash) for every bucket that holds a k-mer."""
    words = [_xx(w) for w in re.findall("[^ \t\n\x0b\f\r]+", (text or "").lower())]
    if not words:
        return set()
    if len(words) < k:
        whole = 0
        for w in words:
            whole = _xx(whole, w)
        kmers = [whole]
        names = [whole >> 28]
    else:
        names = [_xx(*words[i : i + k]) >> 28 for i in range(len(words) - k + 1)]
    seen: Counter = Counter()
    ranked = []
    for at, name in enumerate(names):
        ranked.append((_xx(name, _Int(seen[name])) >> 28, at))
        seen[name] += 1
    ranked.sort()
    out = set()
    for i, (rank, at) in enumerate(ranked):
        bucket = rank >> 30
        if i and ranked[i - 1][0] >> 30 == bucket:
            continue
        other, there = ranked[(i + 1) % len(ranked)]
        pair = (rank, other) if at < there else (other, rank)
        out.add((bucket, (_xx(*pair) if len(ranked) > 1 else _xx(rank)) % (1 << 24)))
    return out


def alike(a: set, b: set) -> float:
    either = {x for x, _ in a} | {x for x, _ in b}
    return len(a & b) / len(either) if either else 1.0
