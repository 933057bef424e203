"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(t, text, end):
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def crc(a):
    return zlib.crc32(np.ascontiguousarray(a).tobytes())


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(BASE[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def contamination(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for item, body in items:
        b = words(body)
        if not b:
            continue
        size = min(window, len(b))
        targets = {tuple(b[s : s + size]) for s in range(len(b) - size + 1)}
        for s in range(len(w) - size + 1):
            if tuple(w[s : s + size]) in targets:
                hit.update(range(s, s + size))
                names |= set() if item is None else {str(item)}
    line = ",".join(sorted(names))
    return len(w), len(hit), len(names), hashlib.sha256(line.encode()).hexdigest(), bool(hit)


def fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(text)) if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(rows, budget=3):
    """``{row number: smallest id reachable}`` of ``(id, fingerprint)`` rows."""
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= budget:
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return {i: least.get(root(i)) for i in range(len(rows))}


def top(vectors, asked, k=10):
    q = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v in vectors}
    out = []
    for i in sorted(asked):
        scored = sorted((-sum(a * b for a, b in zip(q[i], v, strict=True)), j) for j, v in q.items() if j != i)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return out
