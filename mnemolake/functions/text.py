"""Tokens, stop words and the text rank over position lists."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Token pattern and rank weights.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
POSITION_WEIGHT = 0.1
SERIES_LIMIT = 1.64493406685
FAR_DISTANCE = 100
FAR_FACTOR = 1e-30
NO_PAIR_RANK = 1e-20
# The common list of English stop words; contractions are no tokens here.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both "
    "but by can did do does doing don down during each few for from further had has have having he her here hers "
    "herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off on "
    "once only or other our ours ourselves out over own s same she should so some such t than that the their theirs "
    "them themselves then there these they this those through to too under until up very was we were what when "
    "where which while who whom why will with you your yours yourself yourselves "
).split()

CONFIGS = ("simple", "english")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


# Token grammar: at each place the first class that fits takes as much as it can. No class looks around or repeats a
# group without a bound, so any regular expression engine scans a text of any length in linear time.
_LETTER, _CHAR, _RUN = r"\p{L}", r"[\p{L}\p{N}]", r"[\p{L}\p{N}-]"
_HOST = rf"(?:{_CHAR}{_RUN}*\.){{1,8}}{_LETTER}{{2,}}"
_TAIL = r"(?:/[^\s<>\"'()\[\]{}]*[^\s<>\"'()\[\]{}.,;:!?])"
GRAMMAR = {
    "email": rf"{_CHAR}[^\s@<>\"'()\[\],;:/]{{0,63}}@{_HOST}",
    "url": rf"(?:{_LETTER}+://)?{_HOST}(?::[0-9]+)?{_TAIL}",
    "host": rf"(?:{_LETTER}+://)?{_HOST}(?::[0-9]+)?",
    "file": rf"/{_CHAR}(?:[\p{{L}}\p{{N}}/._-]*{_CHAR})?",
    "version": r"[0-9]+\.[0-9]+\.[0-9.]*[0-9]",
    "float": r"[+-]?[0-9]+(?:\.[0-9]+(?:e[+-]?[0-9]+)?|e[+-]?[0-9]+)",
    "int": r"[+-][0-9]+",
    "run": rf"{_CHAR}{_RUN}*",
}
GRAMMAR_PATTERN = "|".join(f"(?:{p})" for p in GRAMMAR.values())
PROTOCOL = r"^\p{L}+://"
#: A word of letters and digits that starts with a letter; what may follow it where no other class could go on.
PLAIN = rf"{_LETTER}{_CHAR}*+"
_AFTER = r"(?=[\s<>\"'()\[\],;]|\.?\z|\.\s)"
#: The same tokens as ``GRAMMAR_PATTERN`` by fewer steps, as most are plain words and no address goes back over its signs.
_SCAN = rf"(?:{PLAIN}{_AFTER})|" + GRAMMAR_PATTERN.replace("{0,63}@", "{0,63}+@")


def grammar_parts(text: Column) -> Column:
    """Tokens of a text by a fuller grammar: ``array<struct<kind, token>>`` in order, lower-cased.

    Next to words there are e-mail addresses (up to 64 signs before the ``@``), URLs, hosts, file paths, versions and
    signed numbers, each a token. A URL gives itself without its protocol, its host and its path; a hyphenated compound
    that has a letter gives the whole and its parts, one of digits only its parts.
    """
    raw = F.regexp_extract_all(F.lower(text), F.lit(_SCAN), F.lit(0))

    def one(kind: str | Column, token: Column) -> Column:
        return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), token.alias("token"))

    def seen(t: Column) -> Column:
        bare, run = F.regexp_replace(t, PROTOCOL, ""), F.regexp_replace(t, "-+$", "")
        return F.struct(t.alias("t"), bare.alias("bare"), run.alias("run"), t.rlike(_LETTER).alias("letter"))

    def run(x: Column) -> Column:
        r, letter = x["run"], x["letter"]
        parts = F.transform(F.filter(F.split(r, "-"), lambda p: p != ""), lambda p: one(F.when(letter, "hword_part").otherwise("int"), p))
        word = one(F.when(letter, "word").when(r.rlike("^[0-9]+$"), "int").otherwise("other"), r)
        return F.when(~r.contains("-"), F.array(word)).when(letter, F.concat(F.array(one("hword", r)), parts)).otherwise(parts)

    def parts(x: Column) -> Column:
        t, bare = x["t"], x["bare"]
        is_a = lambda kind: t.rlike(f"^(?:{GRAMMAR[kind]})$")
        url = [one("url", bare), one("host", F.regexp_extract(bare, "^[^/]+", 0)), one("url_path", F.regexp_extract(bare, "/.*$", 0))]
        out = F.when(is_a("email"), F.array(one("email", t))).when(is_a("url"), F.array(*url)).when(is_a("host"), F.array(one("host", bare)))
        for kind in ("file", "version", "float", "int"):
            out = out.when(is_a(kind), F.array(one(kind, t)))
        return out.otherwise(run(x))

    def any_token(t: Column) -> Column:
        fuller = F.flatten(F.transform(F.transform(F.array(t), seen), parts))
        return F.when(t.rlike(f"^{PLAIN}\\z"), F.array(one("word", t))).otherwise(fuller)

    return F.flatten(F.transform(raw, any_token))


def grammar_tokens(text: Column) -> Column:
    """The tokens of ``grammar_parts`` alone."""
    return F.transform(grammar_parts(text), lambda x: x["token"])


def stop_words() -> list[str]:
    """English stop words."""
    return list(STOP_WORDS)


def positions(collected: Column, max_position: int | None = None, max_positions: int | None = None) -> Column:
    """Sorted and distinct positions of one lexeme in one text, all of them unless limits are given."""
    if max_position is not None:
        collected = F.transform(collected, lambda p: F.least(p, F.lit(max_position)))
    out = F.array_distinct(F.array_sort(collected))
    return out if max_positions is None else F.slice(out, 1, max_positions)


def _pair_weight(distance: int) -> float:
    near = 1.0 / (1.005 + 0.05 * math.exp(distance / 1.5 - 2))
    return POSITION_WEIGHT * math.sqrt(near if distance <= FAR_DISTANCE else FAR_FACTOR)


def log_misses() -> np.ndarray:
    """ln(1 - pair weight) by distance, the last for all beyond; equal positions do not count."""
    return np.array([0.0] + [math.log1p(-_pair_weight(d)) for d in range(1, FAR_DISTANCE + 2)])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _misses(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, table: np.ndarray, room: int = 1 << 21) -> np.ndarray:
    """Sum of ln(1 - weight) over all pairs of positions of two lexemes, for each of ``n`` texts.

    Both sides are ``(text number, position)`` in order, so one sorted array of both serves every text at once.
    """
    step = int(max(left[1].max(initial=0), right[1].max(initial=0))) + 2 * FAR_DISTANCE + 2
    a, b = (owner * step + pos for owner, pos in (left, right))
    lo = np.searchsorted(b, a - FAR_DISTANCE)
    near = np.searchsorted(b, a + FAR_DISTANCE, "right") - lo
    reach = np.concatenate(([0], np.cumsum(near)))
    out = np.zeros(n)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(reach, reach[at] + room, "right")) - 1)
        own = np.repeat(np.arange(at, to), near[at:to])
        gap = np.abs(a[own] - b[spread(lo[at:to], near[at:to])])
        out += np.bincount(left[0][own], table[gap], n)
        at = to
    pairs = np.bincount(left[0], near, n)
    every = np.bincount(left[0], minlength=n) * np.bincount(right[0], minlength=n)
    return out + table[-1] * (every - pairs)


def counted_ranks(n: np.ndarray) -> np.ndarray:
    """Ranks for one lexeme that occurs ``n`` times."""
    return POSITION_WEIGHT * np.concatenate(([0.0], np.cumsum(1.0 / np.arange(1, n.max(initial=0) + 1) ** 2)))[n] / SERIES_LIMIT


def rank_of_count(n: Column) -> Column:
    """Text rank of one lexeme by its number of positions."""

    def ranked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            yield pa.array(counted_ranks(part.to_numpy(zero_copy_only=False).astype(np.int64)))

    return F.arrow_udf(ranked, "double")(n)


def rank_at(found: list[np.ndarray], first: np.ndarray, sizes: np.ndarray, flat: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Text ranks of texts by several lexemes. ``found`` has for each lexeme the number of its list in every text, or -1.

    List ``i`` lies at ``first[i]`` of ``flat`` and has ``sizes[i]`` positions.
    """
    out = np.zeros(len(found[0]))
    for j in range(1, len(found)):
        rows = np.flatnonzero(found[j] >= 0)
        for i in range(j):
            sides = []
            for k in (i, j):
                lists = found[k][rows]
                sides.append((np.repeat(np.arange(len(rows)), sizes[lists]), flat[spread(first[lists], sizes[lists])]))
            out[rows] += _misses(*sides, len(rows), table)
    return np.where(out == 0, NO_PAIR_RANK, -np.expm1(out))


def rank_lists(lists: pa.ListArray, table: np.ndarray) -> pa.Array:
    """Text ranks of a batch of matches on its flat arrays; null where there is no list."""
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    inner = lists.flatten()
    counts = inner.value_lengths().to_numpy()
    pos = inner.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts, first = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
    out = np.zeros(len(sizes))
    one = sizes == 1
    own = counts[first[one]]
    out[one] = counted_ranks(own)
    for j in range(1, sizes.max(initial=0)):
        rows = np.flatnonzero(sizes > j)
        for i in range(j):
            sides = []
            for k in (i, j):
                n = counts[first[rows] + k]
                sides.append((np.repeat(np.arange(len(rows)), n), pos[spread(starts[first[rows] + k], n)]))
            out[rows] += _misses(*sides, len(rows), table)
    many = sizes > 1
    out[many] = np.where(out[many] == 0, NO_PAIR_RANK, -np.expm1(out[many]))
    return pa.array(out, pa.float64(), mask=sizes == 0)


def ts_rank(lists: Column) -> Column:
    """Text rank of one text for an AND query.

    ``lists`` has one sorted position list per query lexeme. A single lexeme ranks by its number of
    occurrences, several by the distances between positions of different lexemes. Only positions up to
    ``FAR_DISTANCE`` apart are paired; all others weigh the same and are counted.
    """

    def ranked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = log_misses()
        for part in batches:
            yield rank_lists(part, table)

    return F.arrow_udf(ranked, "double")(lists)
