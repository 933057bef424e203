import hashlib
import os
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mnemolake.llm import pii, simhash
from mnemolake.llm.components import connected_components
from mnemolake.llm.decontaminate import Windows, benchmark_blocks, clean_documents, decontaminate
from mnemolake.llm.licenses import TEMPLATES, Template, scan_licenses
from mnemolake.llm.resample import kth_largest, resample
from mnemolake.llm.simhash import fingerprint, fingerprint_links, near_duplicates, one_per_group
from mnemolake.llm.toxicity import Lexicon, fold, score_toxicity, toxicity_score, train_lexicon

from . import brute

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab1 9.@+-()4\n"), max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_personal_data(hard):
    spans, model = pii.personal_data(hard)
    got = spans.select("doc_id", pii.span_digest(F.col("spans")).alias("d")).select("doc_id", "d.*").collect()
    want = Counter()
    for r in hard.collect():
        base = brute.base_spans(r.text)
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        want[(r.doc_id, *[sum(b[0] == k for b in base) for k in range(4)], hashlib.sha256(line.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    assert next(r.spans for r in got if r.doc_id == 1).startswith("email:5:28")


def test_labelers_agree(spark):
    rows = [(k, f"please call {200 + k} 555-{1000 + k} today") for k in range(60)] + [(100 + k, f"order id 1234567890{k:04d}") for k in range(60)]
    spans, model = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.spans for r in spans.collect()}
    assert sum(len(got[k]) == 1 and got[k][0].k == 3 for k in range(60)) >= 50
    assert sum(bool(got[100 + k]) for k in range(60)) <= 5
    assert set(model.reliabilities) <= set(pii.KINDS)


def test_same_shares_give_the_same_span_model():
    counts = [(2, 3 * k + 1, 1 + k % 4) for k in range(0, 4000, 37)] + [(3, 5 * k, 2) for k in range(50)]
    few, many = pii.train_span_model(counts), pii.train_span_model([(k, p, 1000 * n) for k, p, n in counts])
    for k, p, _ in [*counts, (2, 82_000, 0), (3, 82_943, 0)]:
        assert few.probability(k, p) == pytest.approx(many.probability(k, p), abs=1e-9)
    assert few.probability(0, 5) == 0.0


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("mail: jo.doe+x [At] mail [dot] example (DOT) com now", 0, "jo.doe+x [At] mail [dot] example (DOT) com"),
        ("mail " + "a" * 80 + "(at)" + "b" * 70 + ".org", 0, "a" * 80 + "(at)" + "b" * 70 + ".org"),
        ("server 2001:db8::8a2e:370:7334 is up", 1, "2001:db8::8a2e:370:7334"),
        ("host fe80:0:0:0:1:2:3:4,", 1, "fe80:0:0:0:1:2:3:4"),
        ("Telefon 030 1234 5678, bitte", 3, "030 1234 5678"),
        ("tel (0161) 496 0000", 3, "(0161) 496 0000"),
    ],
)
def test_wide_candidates(text, kind, span):
    assert [(k, text[s:e]) for k, s, e, _ in pii.candidates(text, pii.base_spans(text))] == [(kind, span)]


def test_no_candidates():
    for text in ("at 12:30:45 and a::b::c, 1:2:3", "::", "std::vector", "12345::67890"):
        assert [c for c in pii.candidates(text, []) if c[0] == 1] == []


def test_long_texts_in_linear_time():
    text = "call 212 555-0134 or a@b.co or 10.0.0.1, card 4111 1111 1111 1112; " * 30_000
    start = time.process_time()
    base = pii.base_spans(text)
    more = pii.candidates(text, base)
    assert len(base) == 60_000 and len(more) == 60_000
    for junk in ("a" * 2_000_000, "a.b-" * 500_000, "1:" * 1_000_000, "0 12 " * 400_000, "a [at " * 300_000):
        pii.candidates(junk, pii.base_spans(junk))
    assert time.process_time() - start < 40


def test_redact(hard):
    out = pii.redact(hard.withColumn("n_chars", F.char_length("text")))
    assert out.columns == [*hard.columns, "n_chars"] and out.count() == hard.count()
    one = out.where("doc_id = 1").first()
    assert one.text.startswith("Mail <EMAIL> or call <PHONE>, card <CARD>, ip <IP> and") and one.n_chars == len(one.text)
    assert out.where("doc_id = 2").first().text is None


def contaminated(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontaminate(hard, items, block_bytes):
    bodies = [(r.item_id, r.text) for r in items.collect()]
    want = Counter((r.doc_id, *brute.contamination(r.text, bodies)) for r in hard.collect())
    assert contaminated(decontaminate(hard, items, block_bytes=block_bytes)) == want
    kept = clean_documents(hard, items, block_bytes=block_bytes)
    assert kept.columns == hard.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for (d, *_, hit), n in want.items() for _ in range(n) if not hit)


@pytest.mark.parametrize("block_bytes", [4 << 20, 8])
def test_items_without_id(spark, block_bytes):
    docs = spark.createDataFrame([(1, "aa a nameless passage bb"), (2, "a named passage"), (3, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a nameless passage"), (7, "a named passage"), (7, "a named passage")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(docs, items, block_bytes=block_bytes).collect()}
    assert [(got[k].n_hit, got[k].n_items, got[k].contaminated) for k in (1, 2, 3)] == [(3, 0, True), (3, 1, True), (0, 0, False)]
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert [r.doc_id for r in clean_documents(docs, items, block_bytes=block_bytes).collect()] == [3]
    assert sorted(len(b) for b in benchmark_blocks(items, "item_id", "text", 4 << 20)) == [2]


def test_decontaminate_without_items(hard, items, nothing):
    assert decontaminate(hard, items.limit(0)).where("n_hit > 0 or n_items > 0").count() == 0
    assert decontaminate(nothing, items).count() == 0
    assert clean_documents(hard, items.limit(0)).count() == hard.count()


def test_licenses(hard):
    got = {r.doc_id: r for r in scan_licenses(hard).collect() if r.doc_id not in (5,)}
    assert scan_licenses(hard).count() == hard.count()
    assert (got[-9].n_base, got[-9].first_word, got[-9].last_word, got[-9].base_labels) == (4, 0, 8, "cc-by,gpl")
    assert (got[None].n_base, got[None].base_labels) == (2, "cc-by,reserved")
    for k, r in got.items():
        assert r.n_words == len(brute.words(next(h.text for h in hard.collect() if h.doc_id == k)))
    assert got[2].n_base == 0 and got[2].first_word is None and got[2].score == 0


def test_license_spans_with_gaps(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "licensed under the big apache license version 2 0"), (3, "the license of this file"), (4, "\u212a cc \u212a by")]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "apache-2.0" and got[1].score == 1.0
    assert got[2].labels == "apache-2.0" and got[2].score < 1
    assert got[3].labels == "" and got[4].n_base == 0


def test_long_license_texts(spark):
    whole = max((t for t in TEMPLATES if t.label == "mit"), key=lambda t: len(t.text)).text
    words = whole.split()
    assert len(words) > 150
    long = Template("all", " ".join(f"w{k}" for k in range(400)), True)
    texts = [
        f"Some words first. {whole.upper()}, and more", " ".join(words[:70] + words[72:]), " ".join(words[:60]),
        " ".join(reversed(words)), f"x {long.text} y {long.text}", " ".join(f"w{k}" for k in range(399)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(docs, (*TEMPLATES, long)).collect()}
    assert got[0].score == 1.0 and "mit" in got[0].labels.split(",") and "mit" in got[1].labels.split(",")
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels) == (2, 1, 402, "all")
    assert got[5].n_base == 0 and 0.99 < got[5].score < 1


def test_shingles_that_share_a_number():
    text = b"alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    for base in (14, 1 << 22, 1 << 40, 1 << 62):  # from 2**21 on, words share numbers
        w = Windows([("1", text), ("2", b"beta gamma"), (None, b"eta theta iota")], 10)
        w.base = base
        shingles = w.shingles()
        w.order({k: np.ones(len(v), np.int64) for k, v in shingles.items()})
        starts, ends, items = w.search(w.numbers(b"x " + text + b" y"))
        assert sorted(zip(starts, ends, strict=True)) == [(1, 11), (2, 4), (2, 12), (3, 13), (7, 10)]
        assert {w.items[k] for k in items} == {"1", "2"}


def test_fingerprints():
    for text in ("", "  ", "One", "one two", "one two three", "A b C d é F g", "x y " * 2000, "\x1c odd \x85 blanks\u00a0here a b"):
        assert fingerprint(text.encode()) == brute.fingerprint(text), text


@pytest.mark.parametrize("budget, run_rows", [(1, 1 << 19), (3, 1 << 19), (3, 40)])
def test_links_connect(spark, budget, run_rows, monkeypatch):
    monkeypatch.setattr(simhash, "RUN_ROWS", run_rows)
    rng = np.random.default_rng(7)
    seeds = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = set()
    for s in seeds.tolist():
        for _ in range(40):
            flips = 0
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                flips |= 1 << b
            values.add(s ^ flips)
    values |= set(range(200))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), budget)
    back = {s: v for s, v in zip(signed, values, strict=True)}
    found = [(back[r.a], back[r.b]) for r in links.collect()]
    assert all(0 < (a ^ b).bit_count() <= budget for a, b in found)
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        up[root(a)] = root(b)
    want = brute.components([(v, v) for v in values], budget)
    groups = {}
    for v in values:
        groups.setdefault(root(v), []).append(v)
    least = {v: min(g) for g in groups.values() for v in g}
    assert [least[v] for v in values] == [want[i] for i in range(len(values))]


def test_components(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (7, 9), (9, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1400)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(hard, nothing):
    rows = hard.collect()
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in rows]
    least = brute.components(fps)
    want = Counter((d, f"{f:016x}", least[i]) for i, (d, f) in enumerate(fps))
    assert Counter(tuple(r) for r in near_duplicates(hard).select("doc_id", "fingerprint", "component_id").collect()) == want
    assert near_duplicates(nothing).count() == 0
    kept = one_per_group(hard)
    assert kept.columns == hard.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(v) for v in least.values()})


@needs_tables
def test_near_duplicates_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in docs.collect()]
    least = brute.components(fps)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == {d: least[i] for i, (d, _) in enumerate(fps)}


def test_fold():
    assert fold("Yоu 1d10t, tr@sh! it's 42") == " you idiot trash it s "
    assert fold("") == "  "


def test_lexicon_matches():
    lexicon = Lexicon({" idiot ": 5.0, " mor": 4.0}, [" no idiot "], (-3.0, 2.0, 0.0, 0.0))
    a = lexicon.automaton()
    assert lexicon.features(a, "an IDI0T and a m0ron")[0] == pytest.approx(np.log1p(9))
    assert lexicon.features(a, "no idiot here")[0] == 0
    assert lexicon.score(a, "an idiot") > 0.5 > lexicon.score(a, "")


def test_toxicity(spark, hard, nothing):
    rows = [(k, ("you idiot " if k % 3 == 0 else "kind words ") + f"word{k} and more", 1 if k % 3 == 0 else 0) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int"))
    lexicon = train_lexicon(docs.drop("toxic"), labels)
    got = {r.doc_id: r for r in score_toxicity(docs, lexicon).collect()}
    assert all((got[k].predicted == 1) == (k % 3 == 0) for k, _, _ in rows)
    assert 0.1 < np.mean([r.held_out for r in got.values()]) < 0.3
    assert score_toxicity(hard, lexicon).where("score is null or score < 0 or score > 1 or predicted is null").count() == 0
    assert score_toxicity(nothing, lexicon).count() == 0
    assert train_lexicon(docs, labels.limit(0)).weights == {}
    assert hard.where(toxicity_score(F.col("text"), lexicon) < 2).columns == hard.columns


def test_all_exception_phrases(spark):
    words = [f"w{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(600)]
    rows = [(k, f"you idiot {'z' * 50}" if k % 2 else "kind talk", k % 2) for k in range(400)]
    rows += [(400 + k, " ".join(f"idiot {w}" for w in words), 0) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = train_lexicon(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert f" {'z' * 50} " in lexicon.weights or " zzzz" in lexicon.weights
    assert {f" idiot {w} " for w in words} | {f" {w} idiot " for w in words[:-1]} <= set(lexicon.exceptions)


def test_repeated_training_rows(spark):
    rows = [(k, ("you idiot " if k % 3 == 0 else "kind words ") + f"{chr(97 + k % 26)}word", 1 if k % 3 == 0 else 0) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels, one = docs.select("doc_id", "toxic"), docs.where("doc_id = 3")
    want = train_lexicon(docs, labels)
    for _ in range(8):
        one = one.unionByName(one)
    absent = spark.range(1000, 1500).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    got = train_lexicon(docs.unionByName(one), labels.unionByName(absent))
    assert got.weights == want.weights and got.exceptions == want.exceptions and got.scale == pytest.approx(want.scale)


@needs_tables
def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF[:-7]}sf0.01/documents.parquet"), spark.read.parquet(f"{SF[:-7]}sf0.01/labels.parquet")
    got = score_toxicity(docs, train_lexicon(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.9


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=3000)] + [5.0] * 50 + [1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 40, 1500, len(values)):
        assert kth_largest(df, "x", k, bins=16, few=100) == sorted(values, reverse=True)[k - 1]


def test_resample(spark, hard, nothing):
    rows = [(k, "good clean prose text " * 5 if k % 2 else f"zx{k} qv{k} jj " * 5, k % 2) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = resample(docs, docs, share=0.5).toPandas()
    assert out["kept"].sum() == 150 and len(out) == 300
    assert (out[out["kept"]]["doc_id"] % 2).mean() > 0.9
    labels = docs.select("doc_id", "quality")
    assert resample(hard, labels).count() == hard.count()
    assert resample(hard, labels, share=0.0).where("kept").count() == 0
    assert resample(nothing, labels).count() == 0
    assert resample(hard, labels.limit(0)).where("log_ratio <> 0").count() == 0
