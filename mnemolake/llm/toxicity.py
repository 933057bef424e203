"""Toxicity by a learnt weighted lexicon, matched by an Aho-Corasick automaton."""

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import each_text, id_text, named, stage

#: Letters of other scripts that look like Latin ones, and the letters they stand for.
HOMOGLYPHS = str.maketrans(
    "абвгдезикмнорстухѕіјһԁɡαβεικνορτυχ", "a6brdezukmhopctyxsijhdgabeikvoptux"
) | {c: c - 0xFEE0 for c in range(0xFF21, 0xFF5B)}
#: Digits and signs written for letters.
DIGITS = str.maketrans("0134578@$!", "oieastbasi")

_LOOKALIKE = re.compile("[Ͱ-ϿЀ-ԯɡＡ-ｚ]")
_SUBSTITUTED = re.compile(r"(?:(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_]))|(?:\b[0134578]+(?=[^\W\d_]))|(?:(?<=[^\W\d_])[0134578]+\b)")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Words of a text in lower case, homoglyphs and digit substitutions undone, a blank before and after each."""
    text = text.lower()
    if not text.isascii() and _LOOKALIKE.search(text):
        text = text.translate(HOMOGLYPHS).lower()
    text = _SUBSTITUTED.sub(lambda m: m.group().translate(DIGITS), text)
    return " " + " ".join(_WORD.findall(text)) + " "


def held_out(doc_id, folds: int = 5) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == 0


@dataclass
class Lexicon:
    """Weighted terms and exception phrases over folded text, and the logistic scale of a text's score.

    A term begins with a blank; one that ends with a blank is a whole word, any other the beginning of words.
    """

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    scale: tuple[float, ...] = (-2.0, 1.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for term, w in self.weights.items():
            a.add_word(term, (len(term), w))
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), None))
        if len(a):
            a.make_automaton()
        return a

    def features(self, a, text: str) -> tuple[float, float, float]:
        """Matched weight as it is and per hundred words, and the length; one match a word, none in an exception."""
        folded = fold(text)
        words = folded.count(" ") - 1 if len(folded) > 2 else 0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(a):
            for end, (size, w) in a.iter(folded):
                start = end - size + 1
                if w is None:
                    spared.append((start, end))
                elif w > best.get(start, 0.0):
                    best[start] = w
        total, reach, k = 0.0, 0, 0
        spared.sort()
        for s in sorted(best):
            while k < len(spared) and spared[k][0] <= s:
                reach, k = max(reach, spared[k][1]), k + 1
            total += best[s] if s >= reach else 0.0
        return math.log1p(total), math.log1p(100 * total / max(words, 1)), math.log1p(words)

    def score(self, a, text: str) -> float:
        z = self.scale[0] + sum(b * x for b, x in zip(self.scale[1:], self.features(a, text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(folded: str, prefixes: tuple[int, int]) -> set[str]:
    found = set()
    for w in set(folded.split()):
        found.add(f" {w} ")
        found.update(f" {w[:k]}" for k in range(prefixes[0], min(prefixes[1], len(w)) + 1))
    return found


def _counted(train: DataFrame, made, flush: int = 200_000) -> DataFrame:
    """``term, pos, neg``: in how many toxic and other texts each term stands; ``made()`` gives a folded text's terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = made(), (Counter(), Counter())

        def out() -> pa.RecordBatch:
            terms = list(sums[0].keys() | sums[1].keys())
            columns = [pa.array(terms, pa.string()), *[pa.array([s[t] for t in terms], pa.int64()) for s in (sums[1], sums[0])]]
            for s in sums:
                s.clear()
            return pa.RecordBatch.from_arrays(columns, names=["term", "pos", "neg"])

        for batch in batches:
            for text, toxic in zip(each_text(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                sums[toxic].update(of(fold(text)))
                if len(sums[0]) + len(sums[1]) > flush:
                    yield out()
        yield out()

    return train.select("text", "toxic").mapInArrow(count, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients for rows ``x`` that stand for ``n`` texts each, ``y`` of them toxic."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (y - n * p) - ridge * b
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        d = np.linalg.solve(h, g)
        b += d
        if np.abs(d).max() < 1e-8:
            break
    return b


def train_lexicon(
    docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = 20_000, least: int = 3,
    prefixes: tuple[int, int] = (4, 8), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Lexicon:
    """Learn terms, weights, exception phrases and the score's scale from labelled documents.

    Labels of documents whose crc32 of the id is divisible by ``folds`` are never read. At most ``sample``
    labels are used, those with the smallest hash of the id, so that the labels sent to the tasks have a bound; of
    their documents, rows equal in id and text count once, and labels without a document count nothing. Terms are words and word beginnings of ``prefixes`` letters, counted in Spark; the lexicon holds all that
    pass the tests of weight and clearness, and all exception phrases that pass the count test; the sample bounds both. Null labels and ids are left out; without labels of
    both kinds the lexicon is empty and scores are 0.12 for every text.
    """
    spark_crc = F.crc32(named(id_col).cast("string").cast("binary"))
    chosen = (
        labels.where(named(id_col).isNotNull() & named(label_col).isin(0, 1) & (spark_crc % folds != 0))
        .groupBy(named(id_col).cast("long").alias("doc_id")).agg(F.max(named(label_col).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").distinct()
    staged = stage(rows, n_pos=F.coalesce(F.sum("toxic"), F.lit(0)))
    train, n_pos = staged.df, staged.seen["n_pos"]
    n_neg = staged.rows - n_pos
    if not n_pos or not n_neg:
        return Lexicon({})
    rate_pos, rate_neg = (F.col("pos") + 0.5) / (n_pos + 1), (F.col("neg") + 0.5) / (n_neg + 1)
    weight = F.log(rate_pos / rate_neg)
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    scored = _counted(train, lambda: lambda t: _terms(t, prefixes)).where(F.col("pos") >= least)
    scored = scored.select("term", "pos", "neg", weight.alias("w"), (weight / error).alias("z"))
    best = scored.where((F.col("w") >= 1.5) & (F.col("z") >= 2.7)).collect()
    weights: dict[str, float] = {}
    share: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r["term"]), r["term"])):
        own = r["pos"] / (r["pos"] + r["neg"])
        shorter = [r["term"][:k] for k in range(2, len(r["term"])) if r["term"][:k] in weights]
        if not shorter or own > max(share[s] for s in shorter) + 0.02:
            weights[r["term"]], share[r["term"]] = r["w"], own
    lexicon = Lexicon(weights)
    lexicon.exceptions = _exceptions(train, lexicon, least)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for batch in batches:
            rows = [lexicon.features(a, t) for t in each_text(batch.column(0))]
            columns = np.array(rows, np.float64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column(1)], names=["a", "b", "c", "toxic"])

    measured = train.select("text", "toxic").mapInArrow(measure, "a double, b double, c double, toxic int")
    sums = measured.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).toPandas()
    sums = sums.sort_values(list(sums.columns))
    fitted = _logistic(sums[["a", "b", "c"]].to_numpy(), sums["pos"].to_numpy(float), sums["n"].to_numpy(float))
    lexicon.scale = tuple(float(b) for b in fitted)
    return lexicon


def _exceptions(train: DataFrame, lexicon: Lexicon, least: int) -> list[str]:
    """Pairs of a matched word and a neighbour that stand in at least ``3 * least`` other texts and never in toxic ones."""

    def made():
        a = lexicon.automaton()

        def phrases(folded: str) -> set[str]:
            words = folded.split()
            hit = [len(a) and any(True for _ in a.iter(f" {w} ")) for w in words]
            return {f" {words[k]} {words[k + 1]} " for k in range(len(words) - 1) if hit[k] or hit[k + 1]}

        return phrases

    found = _counted(train, made).where((F.col("pos") == 0) & (F.col("neg") >= 3 * least))
    return sorted(r["term"] for r in found.collect())


def toxicity_score(column, lexicon: Lexicon):
    """Score column, 0 to 1, of a text column; nulls count as empty."""

    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a = lexicon.automaton()
        for part in batches:
            yield pa.array([lexicon.score(a, t) for t in each_text(part)], pa.float64())

    return F.arrow_udf(rate, "double")(column.cast("string"))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; nothing is shuffled.

    Null and empty texts are scored like any text without matches. A null id is held out never. Repeated rows get
    a row each. Whole texts are matched, however long.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    out = F.coalesce(crc % folds == 0, F.lit(False)).alias("held_out")
    scored = id_text(docs, id_col, text_col).select("doc_id", out, toxicity_score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
