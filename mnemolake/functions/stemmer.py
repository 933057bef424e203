"""English (Porter2) stemming, from one set of rule tables.

``with_stems`` applies them to a column of words as Spark expressions, ``stem_word`` to a single word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published algorithm: irregular words, suffix tables and letter classes.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
DONE_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
DERIVED = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
ADJECTIVAL = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
DROPPED = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
           "ate", "iti", "ous", "ive", "ize", "ion"]
REGION = re.compile(r"[^aeiouy]*[aeiouy]+[^aeiouy]")
REGION_PREFIX = re.compile(r"gener|commun|arsen")
SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
VOWEL = re.compile(r"[aeiouy]")
PAST = ("eedly", "ingly", "edly", "eed", "ing", "ed")


def _ending(word: str, endings) -> str:
    """Longest listed ending of the word, or an empty string."""
    return max((e for e in endings if word.endswith(e)), key=len, default="")


def _regions(word: str) -> tuple[int, int]:
    first = REGION_PREFIX.match(word) or REGION.match(word)
    r1 = first.end() if first else len(word)
    second = REGION.match(word, r1)
    return r1, second.end() if second else len(word)


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith(("us", "ss")) or not w.endswith("s"):
        return w
    return w[:-1] if VOWEL.search(w[:-2]) else w


def _past(w: str, r1: int) -> str:
    end = _ending(w, PAST)
    base = w[: len(w) - len(end)]
    if end.startswith("eed"):
        return base + "ee" if len(base) >= r1 else w
    if not end or not VOWEL.search(base):
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if re.search(r"([bdfgmnprt])\1$", base):
        return base[:-1]
    return base + "e" if r1 >= len(base) and SHORT_END.search(base) else base


def _derived(w: str, r1: int) -> str:
    end = _ending(w, DERIVED)
    base = w[: len(w) - len(end)]
    fits = {"ogi": base.endswith("l"), "li": base[-1:] in "cdeghkmnrt" and base != ""}.get(end, bool(end))
    return base + DERIVED[end] if fits and len(base) >= r1 else w


def _adjectival(w: str, r1: int, r2: int) -> str:
    end = _ending(w, ADJECTIVAL)
    base = w[: len(w) - len(end)]
    return base + ADJECTIVAL[end] if end and len(base) >= (max(r1, r2) if end == "ative" else r1) else w


def _dropped(w: str, r2: int) -> str:
    end = _ending(w, DROPPED)
    base = w[: len(w) - len(end)]
    fits = base.endswith(("s", "t")) if end == "ion" else bool(end)
    return base if fits and len(base) >= r2 else w


def _final(w: str, r1: int, r2: int) -> str:
    base, n = w[:-1], len(w) - 1
    if w.endswith("e") and (n >= r2 or (n >= r1 and not SHORT_END.search(base))):
        return base
    return base if w.endswith("ll") and n >= r2 else w


def stem_word(word: str) -> str:
    """Stem of one lower-case word."""
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = re.sub("([aeiouy])y", r"\1Y", "Y" + word[1:] if word.startswith("y") else word)
    r1, r2 = _regions(w)
    w = _plural(w)
    if w in DONE_AFTER_PLURAL:
        return w
    w = _past(w, r1)
    if len(w) > 2 and w[-1] in "yY" and not VOWEL.match(w[-2]):
        w = w[:-1] + "i"
    w = _dropped(_adjectival(_derived(w, r1), r1, r2), r2)
    return _final(w, r1, r2).replace("Y", "y")


def _one_of(endings: Iterable[str]) -> str:
    """Pattern of the longest listed ending of a word."""
    return "(" + "|".join(sorted(endings, key=lambda e: (-len(e), e))) + ")$"


def _table(rules: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])


def with_stems(df: DataFrame, token: str = "token", out: str = "lexeme") -> DataFrame:
    """The rows with the stems of a column of lower-case words, as built-in expressions only.

    Every step finds the longest ending that its rule table lists, looks the replacement up, and applies it where the
    rule's region and the letters before the ending allow it. A null word has a null stem.
    """
    col, long = F.col, F.length
    rows = df

    def let(name: str, value: Column) -> None:
        nonlocal rows
        rows = rows.withColumn(f"_s_{name}", value)

    def cut(word: str, ending: str) -> Column:
        return F.substring(col(word), F.lit(1), long(word) - long(ending))

    def ends(word: Column, pattern: str) -> Column:
        return word.rlike(pattern)

    prefix = f"^(?:{REGION_PREFIX.pattern}|{REGION.pattern})"
    vowel, short = VOWEL.pattern, SHORT_END.pattern
    w = col(token)
    marked = F.when(w.startswith("y"), F.concat(F.lit("Y"), F.expr(f"substring({_quoted(token)}, 2)"))).otherwise(w)
    let("w", F.regexp_replace(marked, "([aeiouy])y", "$1Y"))
    let("h1", F.regexp_extract("_s_w", prefix, 0))
    let("r1", F.when(col("_s_h1") == "", long("_s_w")).otherwise(long("_s_h1")))
    let("h2", F.regexp_extract(F.expr("substring(_s_w, _s_r1 + 1)"), f"^{REGION.pattern}", 0))
    let("r2", F.when(col("_s_h2") == "", long("_s_w")).otherwise(col("_s_r1") + long("_s_h2")))
    less = lambda n: F.substring(col("_s_w"), F.lit(1), long("_s_w") - n)
    word = col("_s_w")
    plural = (
        F.when(word.endswith("sses"), less(2))
        .when(ends(word, "(ied|ies)$"), F.when(long(word) > 4, less(2)).otherwise(less(1)))
        .when(ends(word, "(us|ss)$") | ~word.endswith("s"), word)
        .otherwise(F.when(ends(less(2), vowel), less(1)).otherwise(word))
    )
    let("p", plural)
    let("e", F.regexp_extract("_s_p", _one_of(PAST), 1))
    let("b", cut("_s_p", "_s_e"))
    base = col("_s_b")
    past = (
        F.when(col("_s_e").startswith("eed"), F.when(long(base) >= col("_s_r1"), F.concat(base, F.lit("ee"))).otherwise(col("_s_p")))
        .when((col("_s_e") == "") | ~ends(base, vowel), col("_s_p"))
        .when(ends(base, "(at|bl|iz)$"), F.concat(base, F.lit("e")))
        .when(ends(base, r"([bdfgmnprt])\1$"), F.substring(base, F.lit(1), long(base) - 1))
        .when((col("_s_r1") >= long(base)) & ends(base, short), F.concat(base, F.lit("e")))
        .otherwise(base)
    )
    let("q", past)
    let("q", F.when(long("_s_q") > 2, F.regexp_replace("_s_q", "(?<=[^aeiouy])[yY]$", "i")).otherwise(col("_s_q")))
    let("e", F.regexp_extract("_s_q", _one_of(DERIVED), 1))
    let("b", cut("_s_q", "_s_e"))
    fits = F.when(col("_s_e") == "ogi", base.endswith("l")).when(col("_s_e") == "li", ends(base, "[cdeghkmnrt]$")).otherwise(col("_s_e") != "")
    let("d", F.when(fits & (long(base) >= col("_s_r1")), F.concat(base, F.element_at(_table(DERIVED), col("_s_e")))).otherwise(col("_s_q")))
    let("e", F.regexp_extract("_s_d", _one_of(ADJECTIVAL), 1))
    let("b", cut("_s_d", "_s_e"))
    region = F.when(col("_s_e") == "ative", F.greatest("_s_r1", "_s_r2")).otherwise(col("_s_r1"))
    fits = (col("_s_e") != "") & (long(base) >= region)
    let("a", F.when(fits, F.concat(base, F.element_at(_table(ADJECTIVAL), col("_s_e")))).otherwise(col("_s_d")))
    let("e", F.regexp_extract("_s_a", _one_of(DROPPED), 1))
    let("b", cut("_s_a", "_s_e"))
    fits = F.when(col("_s_e") == "ion", ends(base, "[st]$")).otherwise(col("_s_e") != "")
    let("x", F.when(fits & (long(base) >= col("_s_r2")), base).otherwise(col("_s_a")))
    let("b", F.substring(col("_s_x"), F.lit(1), long("_s_x") - 1))
    silent = col("_s_x").endswith("e") & ((long(base) >= col("_s_r2")) | (long(base) >= col("_s_r1")) & ~ends(base, short))
    final = F.when(silent | col("_s_x").endswith("ll") & (long(base) >= col("_s_r2")), base).otherwise(col("_s_x"))
    stemmed = F.when(col("_s_p").isin(DONE_AFTER_PLURAL), col("_s_p")).otherwise(F.replace(final, F.lit("Y"), F.lit("y")))
    value = F.when(long(w) <= 2, w).otherwise(F.coalesce(F.element_at(_table(IRREGULAR), w), stemmed))
    return rows.withColumn(out, value).select(*[c for c in df.columns if c != out], out)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
