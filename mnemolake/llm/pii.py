"""Personal data in texts: patterns, and a span classifier learnt from voting labelers without labels."""

import hashlib
import ipaddress
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import each_text, id_text, named, parts, stage

KINDS = ("email", "ip", "card", "phone")

# The patterns' runs are possessive and begin where a run begins, so that every scan is linear in the text.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Public top-level domains, first digits of card issuers, words that stand near a kind of datum.
TOP_LEVEL = frozenset("com net org edu gov mil int info biz io de fr es it uk nl eu ch at be pl se no fi dk pt ru cn jp in br us ca au".split())
ISSUERS = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "6")
NEAR = {
    "email": ("mail", "contact", "write", "courriel", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "from"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "movil"),
}
FAR = {
    "email": ("example of", "format"),
    "ip": ("version", "section", "release", "chapter"),
    "card": ("isbn", "order", "token", "serial", "id"),
    "phone": ("version", "year", "page", "isbn", "id"),
}
# Wider candidates than the base, for the labelers to vote on. Each begins where a run of its characters begins.
_AT, _DOT = r"(?: ?[\[(] ?[Aa][Tt] ?[\])] ?)", r"(?:\.| ?[\[(] ?[Dd][Oo][Tt] ?[\])] ?)"
_WIDE = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+"),
    "ip": re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]*+:[0-9A-Fa-f:]++(?![0-9A-Za-z:.])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:[\x20.-]?[0-9]{2,7}){2,3}(?![0-9])"),
    "phone": re.compile(
        r"(?<![0-9+(.-])(?:\(?0[0-9]{1,4}\)?(?:[\x20./-][0-9]{2,5}){1,4}|(?:\(?[0-9]{3}\)?[\x20.-])?[0-9]{3}[-.\x20][0-9]{4})(?![0-9])"
    ),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind number, start, end`` of all base matches, by kind and start."""
    spans = [(0, s, e) for s, e in _emails(text)]
    spans += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return spans


class Taken:
    """Ranges that never overlap, in order; adding and asking cost a binary search."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self.ranges: list[tuple[int, int]] = []
        for s, e in sorted(spans):
            if self.ranges and s < self.ranges[-1][1]:
                self.ranges[-1] = (self.ranges[-1][0], max(e, self.ranges[-1][1]))
            else:
                self.ranges.append((s, e))

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.ranges, (end, -1))  # ranges before k begin before the end
        return k > 0 and self.ranges[k - 1][1] > start

    def add(self, start: int, end: int) -> None:
        insort(self.ranges, (start, end))


def _address(s: str) -> bool:
    """An address of eight groups, or a compressed one of at least three."""
    if len(s) > 39 or "::" not in s and s.count(":") != 7 or sum(map(bool, s.split(":"))) < 3:
        return False
    try:
        return bool(ipaddress.IPv6Address(s))
    except ValueError:
        return False


def _votes(kind: str, match: str, around: str) -> tuple[int, int, int, int]:
    """Votes of the shape, gazetteer, check and context labelers: 0 no, 1 no opinion, 2 yes."""
    digits, letters = _digits(match), around.lower()
    words = re.findall(r"[^\W\d_]+", letters)
    near = any(w.startswith(n) for w in words for n in NEAR[kind])
    far = any(n in letters if " " in n else n in words for n in FAR[kind])
    context = 2 if near and not far else 0 if far and not near else 1
    if kind == "email":
        top = re.split(r"[^A-Za-z]+", match.lower().strip("[]() "))[-1]
        return 2 if "[" in match or "(" in match else 0, 2 if top in TOP_LEVEL else 0, 1 if len(match) > 6 else 0, context
    if kind == "ip":
        private = match.lower().startswith(("fd", "fe8", "::1")) or set(_digits(match)) <= {"0"}
        return 2 if match.count(":") == 7 else 1, 0 if private else 1, 2 if any(c.isdigit() for c in match) else 0, context
    if kind == "card":
        grouped = bool(re.fullmatch(r"[0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{4}|[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{5}", match))
        return 2 if grouped else 1, 2 if digits.startswith(ISSUERS) else 0, 2 if 13 <= len(digits) <= 19 and luhn(digits) else 0, context
    shaped = bool(re.fullmatch(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[-.\x20][0-9]{4}", match))
    national = digits[0] == "0"
    area = digits[0] not in "01" if len(digits) == 10 else True
    known = 2 if 9 <= len(digits) <= 12 and national or area and len(digits) == 10 else 1
    return 2 if shaped else 1, known, 0 if len(set(digits)) < 3 or len(digits) > 15 or national and len(digits) < 8 else 1, context


#: Bits of a span and of its surroundings that no labeler looks at.
SHAPES = 10


def _shape(text: str, s: int, e: int) -> tuple[bool, ...]:
    match, before, after = text[s:e], text[max(0, s - 1) : s], text[e : e + 1]
    around = text[max(0, s - 30) : s] + text[e : e + 30]
    return (
        min(len(_digits(match)), 19) > 9, " " in match, "." in match, "-" in match, "(" in match or "[" in match,
        before.isalnum() or before in "#_/=" and before != "", after.isalnum() or after in "%_/=" and after != "", any(c.isdigit() for c in around),
        not around.isascii(), len(set(_digits(match))) > 5,
    )


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """``kind number, start, end, pattern`` of spans beyond the base; the pattern packs votes and shape bits.

    A candidate never overlaps a base span of any kind.
    """
    out = []
    taken = Taken([(s, e) for _, s, e in base])
    for k, kind in enumerate(KINDS):
        if kind == "email" and "[" not in text and "(" not in text or kind == "ip" and ":" not in text:
            continue
        for m in _WIDE[kind].finditer(text):
            s, e = m.span()
            match = m.group()
            if kind == "card" and len(_digits(match)) < 13 or kind == "ip" and not _address(match) or taken.meets(s, e):
                continue
            votes = _votes(kind, match, text[max(0, s - 40) : s] + " " + text[e : e + 20])
            number = 0
            for v in votes:
                number = number * 3 + v
            for b in _shape(text, s, e):
                number = number * 2 + b
            out.append((k, s, e, number))
    return out


def _unpacked(pattern: int) -> tuple[list[int], list[int]]:
    shape, votes = [], []
    for _ in range(SHAPES):
        pattern, b = divmod(pattern, 2)
        shape.append(b)
    for _ in range(4):
        pattern, v = divmod(pattern, 3)
        votes.append(v)
    return votes[::-1], shape[::-1]


def _inputs(votes: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(votes)), votes - 1, shape])


@dataclass
class SpanModel:
    """Reliabilities of the labelers and coefficients of the span classifier, by kind; it scores unseen patterns, too."""

    reliabilities: dict[str, list[list[list[float]]]]
    coefficients: dict[int, list[float]]
    seen: dict[tuple[int, int], float] = field(default_factory=dict)

    def probability(self, kind: int, pattern: int) -> float:
        p = self.seen.get((kind, pattern))
        if p is None:
            b = self.coefficients.get(kind)
            votes, shape = _unpacked(pattern)
            x = 0.0 if b is None else float(_inputs(np.array([votes]), np.array([shape]))[0] @ np.array(b))
            p = self.seen[kind, pattern] = 0.0 if b is None else 1 / (1 + float(np.exp(-np.clip(x, -30, 30))))
        return p

    def accepts(self, kind: int, pattern: int, threshold: float) -> bool:
        return self.probability(kind, pattern) >= threshold


#: So many candidates of a kind stand for all, whatever their number: the same shares give the same model at any size.
_AS_MANY = 200.0


def _em(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns of weights that add up to ``_AS_MANY``: each labeler's vote rates by
    truth, and posteriors."""
    said = votes.mean(axis=1) - 1
    post = np.clip(0.5 + 0.4 * said, 0.05, 0.95)
    onehot = votes[:, :, None] == np.arange(3)
    prior_rates = np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]) * 4  # labelers are better than chance
    for _ in range(rounds):
        both = np.stack([1 - post, post]) * n
        rates = np.einsum("cp,plv->clv", both, onehot) + prior_rates[:, None, :]
        rates /= rates.sum(axis=2, keepdims=True)
        share = (both.sum(axis=1) + 1) / (n.sum() + 2)
        logs = np.log(share)[:, None] + np.einsum("plv,clv->cp", onehot, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return rates, post


def train_span_model(counts: list[tuple[int, int, int]], ridge: float = 1.0) -> SpanModel:
    """Fit on ``kind, pattern, n``: EM for the labelers' reliabilities, then a logistic span classifier on votes, shape
    and surroundings, weighted by the posteriors. Only the shares of the patterns count, not how many there are."""
    reliabilities, coefficients = {}, {}
    for k, kind in enumerate(KINDS):
        own = sorted((p, n) for kk, p, n in counts if kk == k)
        if not own:
            continue
        parts = [_unpacked(p) for p, _ in own]
        votes, shape = np.array([v for v, _ in parts]), np.array([s for _, s in parts], float)
        weight = np.array([c for _, c in own], float)
        weight *= _AS_MANY / weight.sum()
        rates, post = _em(votes, weight)
        reliabilities[kind] = rates.tolist()
        x = _inputs(votes, shape)
        b = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (weight * (post - p)) - ridge * b)
            b += step
            if np.abs(step).max() < 1e-8:
                break
        coefficients[k] = b.tolist()
    return SpanModel(reliabilities, coefficients)


_FOUND = "array<struct<k:int,s:int,e:int,p:int>>"
_FOUND_TYPE = pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("p", pa.int32())]))


def find_spans(column):
    """Column of all spans of a text: base ones have pattern -1, candidates their votes and shape."""

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            out = []
            for text in each_text(part):
                base = base_spans(text)
                out.append([{"k": k, "s": s, "e": e, "p": -1} for k, s, e in base] + [{"k": k, "s": s, "e": e, "p": p} for k, s, e, p in candidates(text, base)])
            yield pa.array(out, _FOUND_TYPE)

    return F.arrow_udf(find, _FOUND)(column.cast("string"))


def learn_spans(found: DataFrame, column: str = "found") -> SpanModel:
    """Count the patterns of all candidates (at most 4 x 82,944 sums reach the driver) and fit the model."""
    each = found.select(F.explode(column).alias("f")).where("f.p >= 0")
    counts = each.groupBy(F.col("f.k").alias("k"), F.col("f.p").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return train_span_model([(r["k"], r["p"], r["n"]) for r in counts.collect()])


def accepted(found, model: SpanModel, threshold: float):
    """The base spans and the candidates that the model accepts, overlaps of candidates resolved to the first."""

    def choose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            out = []
            for row in part.to_pylist():
                kept, ends = [], Taken()
                for f in row or []:
                    if f["p"] < 0:
                        kept.append(f)
                    elif model.accepts(f["k"], f["p"], threshold) and not ends.meets(f["s"], f["e"]):
                        kept.append(f)
                        ends.add(f["s"], f["e"])
                out.append(sorted(kept, key=lambda f: (f["k"], f["s"])))
            yield pa.array(out, _FOUND_TYPE)

    return F.arrow_udf(choose, _FOUND)(found)


def personal_data(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, SpanModel]:
    """``doc_id, spans`` (kind, start, end, pattern; code points) of every document, and the model that was learnt.

    Texts are read once; the spans of each row are staged next to its id, patterns are summed, the model is fitted
    on those sums and applied to the staged rows. Nothing but sums is shuffled. Null and empty texts have no spans;
    repeated rows get a row each; whole texts are read, in time linear in their length but for a binary search per
    span. An empty table gives no rows.
    """
    found = stage(id_text(docs, id_col, text_col).select("doc_id", find_spans(F.col("text")).alias("found"))).df
    model = learn_spans(found)
    return found.select("doc_id", accepted(F.col("found"), model, threshold).alias("spans")), model


_DIGEST = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>"
_DIGEST_TYPE = pa.struct([*[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])


def span_digest(spans):
    """Counts by kind, the hash of the base spans, and all spans as text."""

    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            out = []
            for row in part.to_pylist():
                base = [f for f in row if f["p"] < 0]
                line = lambda fs: ",".join(f"{KINDS[f['k']]}:{f['s']}:{f['e']}" for f in fs)
                counts = {f"n_{k}": sum(f["k"] == i for f in base) for i, k in enumerate(KINDS)}
                out.append(counts | {"base_sha256": hashlib.sha256(line(base).encode()).hexdigest(), "spans": line(row)})
            yield pa.array(out, _DIGEST_TYPE)

    return F.arrow_udf(digest, _DIGEST)(spans)


def redact(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with every span in the text replaced by its kind in angle brackets.

    Overlapping spans of two kinds become the placeholder of the first. ``n_chars``, where there is such a column,
    follows the new text. Null texts stay null. Candidates are counted over all documents first. Repeated rows stay
    repeated; an empty table gives no rows.
    """
    model = learn_spans(docs.select(find_spans(named(text_col)).alias("found")))

    def hide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            out = []
            for text in (t for lo, n in parts(part) for t in part.slice(lo, n).to_pylist()):
                if text:
                    base = base_spans(text)
                    more = [c[:3] for c in candidates(text, base) if model.accepts(c[0], c[3], threshold)]
                    pieces, done = [], 0
                    for k, s, e in sorted([*base, *more], key=lambda c: (c[1], c[0])):
                        if s >= done:
                            pieces += [text[done:s], f"<{KINDS[k].upper()}>"]
                        done = max(done, e)
                    text = "".join([*pieces, text[done:]])
                out.append(text)
            yield pa.array(out, pa.string())

    out = docs.withColumn(text_col, F.arrow_udf(hide, "string")(named(text_col).cast("string")))
    if "n_chars" in docs.columns and text_col != "n_chars":
        out = out.withColumn("n_chars", F.char_length(named(text_col)).cast(docs.schema["n_chars"].dataType))
    return out
