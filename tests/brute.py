"""Plain Python versions of the search, written from the definitions, for small fixtures."""

import math
import re

WORD = re.compile(r"[^\W_]+")


def lexemes(text, analyse=lambda w: w):
    out = {}
    for pos, word in enumerate(WORD.findall(text.lower()), 1):
        lexeme = analyse(word)
        if lexeme is not None:
            out.setdefault(lexeme, []).append(pos)
    return {k: sorted(set(v)) for k, v in out.items()}


def rank(lists):
    if len(lists) == 1:
        return 0.1 * sum(1 / j**2 for j in range(1, len(lists[0]) + 1)) / 1.64493406685
    missed = 1.0
    for i, left in enumerate(lists):
        for right in lists[:i]:
            for p in left:
                for r in right:
                    d = abs(p - r)
                    if d:
                        near = 1 / (1.005 + 0.05 * math.exp(d / 1.5 - 2)) if d <= 100 else 1e-30
                        missed *= 1 - 0.1 * math.sqrt(near)
    return 1 - missed if missed < 1 else 1e-20


def cosine(a, b):
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return math.nan if na * nb == 0 else max(-1.0, min(1.0, sum(x * y for x, y in zip(a, b)) / (na * nb)))


def _key(score, id_):
    nan = math.isnan(score)
    return (0 if nan else 1, 0 if nan else -round(score, 9), id_)


def hybrid(rows, text, vector, top_k=10, weight=0.5, keep=lambda r: True, analyse=lambda w: w):
    """Rows are dicts with id, content, vector, is_active; returns (id, text rank, similarity, score)."""
    wanted = sorted(lexemes(text, analyse))
    found = []
    for r in rows:
        if not r["is_active"] or r["vector"] is None or not keep(r):
            continue
        have = lexemes(r["content"], analyse)
        if wanted and all(w in have for w in wanted):
            found.append((r, rank([have[w] for w in wanted])))
    found.sort(key=lambda x: _key(x[1], x[0]["id"]))
    scored = []
    for r, text_rank in found[: max(4 * top_k, 40)]:
        sim = cosine(r["vector"], vector)
        scored.append((r["id"], text_rank, sim, weight * text_rank + (1 - weight) * sim))
    scored.sort(key=lambda x: _key(x[3], x[0]))
    return scored[:top_k]
