"""Operators 2, 3, 5, 6 and 8, and the pipeline."""

import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from likeness.llm import pieces as P
from likeness.llm import words as W
from likeness.llm.decontaminate import contaminated
from likeness.llm.exact_dedup import keep_last
from likeness.llm.licenses import TEMPLATES, _tokens, scan_licenses
from likeness.llm.ngram_join import keep_least
from likeness.llm.pii import KINDS, find_pii
from likeness.llm.queries import op6_sentencepiece
from likeness.llm.toxicity import EXACT, FUZZY, _lexicon, automaton, drop_toxic, match, score_toxicity
from likeness.llm.url_filter import filter_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# the contract's patterns, as Python reads them
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def pii_brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)]


def check_pii(df, texts):
    got = find_pii(df).collect()
    assert len(got) == len(texts)
    for r in got:
        base = pii_brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in KINDS]
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_pii(spark, corpus, corpus_texts):
    check_pii(corpus, corpus_texts)
    rng = random.Random(4)
    bits = ["a@b.c_d@e.f", "a@b", "x..@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1", "00255.1.1.1", "4111 1111-1111 1111", "4111111111111112",
            "+1 (555) 123-4567", "+1+1 555 123 4567 8", "+12345678901", "é@é.com", "ñ+49 30 1234567", "\n", " ", "-", ".", "@", "7", "\U0001f600"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randrange(12))) for i in range(400)} | {900: "", 901: "1" * 30_000, 902: "a" * 30_000 + "@b.c"}
    check_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_pii_discovers(spark):
    """Patterns of seeds find identifiers that no base pattern takes."""
    rng = random.Random(6)
    rows = [(i, f"the {rng.choice('abc')} text ssn 4{rng.randrange(10**15):015d} end") for i in range(300)]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string"), min_score=0.05).collect()
    found = [r for r in got if r.n_card == 0]
    assert found and all("card_like" in r.spans for r in found)


def card(rng, valid=True):
    """A card number of 16 digits, right or with a wrong check digit."""
    digits = f"4{rng.randrange(10**14):014d}"
    right = next(x for x in "0123456789" if luhn(digits + x))
    return digits + (right if valid else str((int(right) + 1) % 10))


def test_pii_discovers_with_every_pattern(spark):
    """At the production thresholds, with many more trusted patterns than one task could be given."""
    rng = random.Random(7)
    names = ["".join(x) for x in itertools.product("bcdfghklmn", "aeiou", "prstvwxz", "ae")]
    rows = [(i, " ; ".join(f"{name} {card(rng, n != 5)}" for n in range(6))) for i, name in enumerate(names)]
    rows.append((len(names), f"{names[0]} {names[1]} {card(rng, False)} and {names[2]}: {card(rng, False)}"))
    got = {r.doc_id: (r.n_card, r.spans) for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 801 and len(names) == 800
    for i in range(len(names)):
        assert got[i][0] == 5 and got[i][1].count("card_like:") == 1
    assert got[800][0] == 0 and got[800][1].count("card_like:") == 1


def test_pii_discovers_emails_without_digits(spark):
    rng = random.Random(8)

    def name():
        return ".".join(rng.choice(["ann", "bob", "kim", "lee", "max"]) for _ in range(12))

    texts = [f"the mail {name()}@{rng.choice(['site', 'home'])}.org end" for _ in range(40)] + [f"the mail {name()}@local end" for _ in range(5)] + ["a name@local"]
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i].n_email == 1 and "like" not in got[i].spans for i in range(40))
    for i in range(40, 45):
        start = texts[i].index(" ", 5) + 1
        assert got[i].n_email == 0 and got[i].spans == f"email_like:{start}:{len(texts[i]) - 4}"
    assert got[45].spans == ""


def test_pii_awkward(ragged, empty):
    assert find_pii(ragged).count() == ragged.count() and find_pii(empty).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def license_brute(text):
    w, starts, labels, best = WORD.findall(text.translate(LOWER)), [], set(), 0.0
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    every = set(labels)
    for line in text.split("\n"):
        words = set(WORD.findall(line.translate(LOWER)))
        for label, t in TEMPLATES.items():
            share = len(words & set(_tokens(t))) / len(_tokens(t))
            if share >= 0.9:
                every.add(label)
                best = max(best, share)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), 1.0 if starts else best)


def check_licenses(df, texts):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in scan_licenses(df).collect()}
    assert got == {i: license_brute(t) for i, t in texts.items()}


def test_licenses(spark, corpus, corpus_texts):
    check_licenses(corpus, corpus_texts)
    rng = random.Random(8)
    bits = [*TEMPLATES.values(), *PHRASES, "MIT", "License", "mit-license", "Apache\nLicense", "general", "public", "Kelvin", "MİT license", "word", "4.0", "\n"]
    texts = {i: rng.choice([" ", ", ", "\n"]).join(rng.choice(bits) for _ in range(rng.randrange(10))) for i in range(300)}
    for i, t in enumerate(TEMPLATES.values()):  # notices with words missing or changed
        w = t.split(" ")
        texts[500 + i] = " ".join(w[:1] + w[2:])
        texts[600 + i] = " ".join(reversed(w)) + " and more"
    check_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_licenses_awkward(ragged, empty):
    assert scan_licenses(ragged).count() == ragged.count() and scan_licenses(empty).count() == 0


def test_licenses_across_lines(spark):
    """Blocks are runs of words: wrapped notices match, words spread over a long line do not."""
    rng = random.Random(9)
    fill = [f"{a}{b}" for a in "bcdfgk" for b in ("ar", "elt", "in")]
    spread = " ".join(" ".join([w, *(rng.choice(fill) for _ in range(60))]) for w in ("released", "license", "under", "the", "MIT"))
    texts = {1: spread, 2: spread.replace(" ", "\n")}
    for i, t in enumerate(TEMPLATES.values()):
        long = " ".join([*(rng.choice(fill) for _ in range(200)), t, *(rng.choice(fill) for _ in range(200))])
        texts[100 + i] = "\n".join(textwrap.wrap(long, 72))
        texts[200 + i] = "\n".join("# " + x for x in textwrap.wrap(t, 24))
        texts[300 + i] = long
    spans = {label: math.ceil(len(WORD.findall(t.lower())) / 0.9 - 1e-9) for label, t in TEMPLATES.items()}
    got = scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in got:
        w, want = WORD.findall(texts[r.doc_id].translate(LOWER)), {}
        for label, t in TEMPLATES.items():
            share = max(len(set(w[i : i + spans[label]]) & set(_tokens(t))) / len(_tokens(t)) for i in range(len(w)))
            if share >= 0.9:
                want[label] = share
        best = {}
        for x in r.blocks:
            best[x.label] = max(best.get(x.label, 0), x.containment)
        assert best == want and set(want) <= set(r.labels.split(",")) | {""}
        assert bool(want) == (r.doc_id >= 100) and (r.doc_id >= 100 or not r.labels)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton():
    """Accepts what is within one edit of a long word, a short word or stem itself, and nothing else."""
    terms = [("stupid", False, 1.0), ("trash", False, 2.0), ("dumb", False, 3.0), ("lowe", True, 4.0)]
    model = automaton(terms)
    rng = random.Random(2)
    words = {"stupid", "lowe", "lowerx", "dumb", "dum", "trash", "tras", "trassh"}
    for t, _, _ in terms:
        for _ in range(400):
            w = list(t)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(2)] = rng.choice(["", "s", "t", "e"])
            words.add("".join(w))
    words = sorted(words - {""})
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    hit, kind, _ = match(data, W.tokenize(data, np.array([0, len(data)]), W.ALNUM), model)
    got = dict(zip(hit.tolist(), kind.tolist(), strict=True))
    for i, w in enumerate(words):
        exact = w in ("stupid", "trash", "dumb") or w.startswith("lowe")
        near = any(distance(w, t) <= 1 for t in ("stupid", "trash"))
        assert got.get(i, 0) == (EXACT if exact else FUZZY if near else 0), w


def test_toxicity(spark):
    """Held-out accuracy; labels held out are not learned from; empty texts have a score."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = score_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    seen = Counter()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and r.doc_id in truth:
            seen[truth[r.doc_id], r.predicted] += 1
    assert seen[1, 1] >= 0.85 * (seen[1, 0] + seen[1, 1])
    assert seen[0, 1] <= 0.01 * (seen[0, 0] + seen[0, 1])


def test_toxicity_copies_and_quotes(spark):
    """Neither a group of copies nor clean documents that quote a term take it out of the lexicon."""
    rng = random.Random(12)
    fill = [f"{a}{b}{c}" for a in "bcdfgk" for b in ("ar", "el", "in") for c in ("mo", "ta", "su")]

    def text(*middle):
        return " ".join([*rng.choices(fill, k=20), *middle, *rng.choices(fill, k=20)])

    copied = text("utter", "zzidrak", "really")
    docs = [(copied, 1)] * 400 + [(text(rng.choice(fill[:12]), "zzidrak"), 1) for _ in range(80)]
    docs += [(text(), 0) for _ in range(300)] + [(text("he", "said", "zzidrak"), 0) for _ in range(60)] + [(text('"so', "zzidrak", 'indeed"'), 0) for _ in range(60)]
    rows = [(i, t, y) for i, (t, y) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r.predicted for r in score_toxicity(df.drop("toxic"), df.drop("text")).collect()}
    assert all(got[i] == y for i, _, y in rows)


def test_lexicon_keeps_words_of_stems():
    """Misspellings of a term whose plural is in the lexicon."""
    lexicon = _lexicon([("idio", True, 90, 0), ("idiot", False, 60, 0), ("idiots", False, 50, 0), ("trash", False, 20, 0)], 5, 192)
    words = ["idiot", "idiots", "idiotic", "idot", "idi0t", "ldiot", "idoits", "idiiots", "trsh", "island"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    hit, kind, _ = match(data, W.tokenize(data, np.array([0, len(data)]), W.ALNUM), automaton(lexicon))
    assert {words[i]: k for i, k in zip(hit.tolist(), kind.tolist(), strict=True)} == {
        "idiot": EXACT, "idiots": EXACT, "idiotic": EXACT, "idot": FUZZY, "idi0t": FUZZY, "ldiot": FUZZY, "idiiots": FUZZY, "trsh": FUZZY}


def test_toxicity_awkward(spark, ragged, empty, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (3, None, None), (10**9, 1, 1)], none.schema)
    for labels in (none, some):
        got = score_toxicity(ragged, labels).collect()
        assert len(got) == ragged.count() and all(0 <= r.score <= 1 for r in got)
        assert score_toxicity(empty, labels).count() == 0
    assert drop_toxic(awkward, none).columns == awkward.columns and drop_toxic(awkward, none).count() == awkward.count()


VOCABULARY = P.load_vocabulary()


def encode_batch(texts, k, seeds):
    def lists(values, cuts, kind):
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))

    s = next(W.slices(pa.array(texts, pa.string()), 1 << 24))
    return P._encode_slice(P.Lattices(VOCABULARY), s, pa.array(range(len(texts))), W.mix(np.array(seeds, np.uint64)), k, True, lists).to_pydict()


def segmentations(unit):
    """All (pieces, score) of a unit."""
    ids = {t: i for i, t in VOCABULARY["texts"].items()}
    score = dict(zip(VOCABULARY["id"].tolist(), VOCABULARY["score"].tolist(), strict=True))
    if not unit:
        return [((), 0.0)]
    return [((ids[unit[:n]], *rest), score[ids[unit[:n]]] + x) for n in range(1, len(unit) + 1) if unit[:n] in ids for rest, x in segmentations(unit[n:])]


def test_round_trip():
    texts = ["", "the cat sat", "hello  world\n\tx", "▁ ünï 日本語 \U0010fffd", "a" * 200, "  ", "\n", "\x00\x7f", "é" * 70 + " " * 5]
    got = encode_batch(texts, 4, range(len(texts)))
    for t, ids, exact, sampled, value, share in zip(texts, got["pieces"], got["exact"], got["sampled"], got["perturbed"], got["inclusion"], strict=True):
        assert exact and P.decode(ids, VOCABULARY) == t
        assert all(P.decode(x, VOCABULARY) == t for x in sampled)
        assert len({tuple(x) for x in sampled}) == len(sampled)
        assert value == sorted(value, reverse=True) and all(0 <= x <= 1 for x in share)


def test_best_path():
    for t in ("information", "zqxv", "unbelievable"):
        got = encode_batch([t], 1, [0])
        assert got["pieces"][0] == list(max(segmentations(t), key=lambda x: x[1])[0])


def path_score(text):
    """The best score of a run without white space, by a plain Viterbi pass over all of it."""
    score = {VOCABULARY["texts"][i]: x for i, x in zip(VOCABULARY["id"].tolist(), VOCABULARY["score"].tolist(), strict=True)}
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        for n in range(1, min(VOCABULARY["longest"], len(text) - i) + 1):
            bare = VOCABULARY["byte_score"] * len(text[i].encode()) if n == 1 else -math.inf
            best[i + n] = max(best[i + n], best[i] + score.get(text[i : i + n], bare))
    return best[-1]


def test_long_runs():
    """No length of a run cuts a piece: best paths equal those over the whole run."""
    thue, other = "a", "b"
    for _ in range(11):
        thue, other = thue + other, other + thue
    runs = ["information" * 20, "x" * 60 + "unbelievable" + "information" * 9, "https://www.example.com/path/to/" + "some-article_about" * 12,
            "日本語の文章には空白がない" * 30, "a" * 5000, "né" * 400 + "ŋ\U0010fffdz" * 50, thue, other]
    score = dict(zip(VOCABULARY["id"].tolist(), VOCABULARY["score"].tolist(), strict=True))
    pieces = set(VOCABULARY["texts"].values())
    got = encode_batch(runs, 3, range(len(runs)))
    for t, ids, exact, sampled, logp in zip(runs, got["pieces"], got["exact"], got["sampled"], got["logp"], strict=True):
        assert exact and P.decode(ids, VOCABULARY) == t and all(P.decode(x, VOCABULARY) == t for x in sampled)
        assert math.isclose(sum(score.get(i, VOCABULARY["byte_score"]) for i in ids), path_score(t), rel_tol=1e-9)
        assert len({tuple(x) for x in sampled}) == len(sampled) and all(x <= 1e-9 for x in logp)
        several = any(t[i : i + n] in pieces for n in range(2, VOCABULARY["longest"] + 1) for i in range(len(t) - n + 1))
        assert len(sampled) == (3 if several else 1)  # without pieces of two characters there is one segmentation


def test_sampling_without_replacement():
    """First and second samples against exact probabilities; exhaustion gives all."""
    text = "rlu xqz"
    every = [(a + b, x + y) for (a, x), (b, y) in itertools.product(segmentations("rlu"), segmentations("▁xqz"))]
    total = math.log(sum(math.exp(x) for _, x in every))
    p = {a: math.exp(x - total) for a, x in every}
    n = 6000
    got = encode_batch([text] * n, 2, range(n))
    first = Counter(tuple(x[0]) for x in got["sampled"])
    both = Counter((tuple(x[0]), tuple(x[1])) for x in got["sampled"])
    for a in p:
        assert abs(first[a] / n - p[a]) < 4 * math.sqrt(p[a] * (1 - p[a]) / n) + 1e-3
        for b in p:
            if a != b:
                q = p[a] * p[b] / (1 - p[a]) if p[a] < 1 - 1e-9 else 0
                assert abs(both[a, b] / n - q) < 4 * math.sqrt(q * (1 - q) / n) + 2e-3
    whole = encode_batch([text], len(p) + 5, [1])
    assert {tuple(x) for x in whole["sampled"][0]} == set(p)
    assert abs(sum(math.exp(x) for x in whole["logp"][0]) - 1) < 1e-6 and set(whole["inclusion"][0]) == {1.0}


def test_encode(ragged, empty, corpus, corpus_texts):
    got = P.encode(corpus).collect()
    assert len(got) == len(corpus_texts)
    for r in got:
        assert r.exact and P.decode(r.pieces, VOCABULARY) == corpus_texts[r.doc_id]
        assert all(P.decode(x, VOCABULARY) == corpus_texts[r.doc_id] for x in r.sampled)
    again = {r.doc_id: r.digest for r in P.encode(corpus.repartition(7), keep_ids=False).collect()}
    assert again == {r.doc_id: r.digest for r in got}  # whatever the partitions
    rows = P.encode(ragged).collect()
    assert len(rows) == ragged.count() and all(r.exact for r in rows)
    assert P.encode(empty).count() == 0


def test_encode_query(spark, tmp_path):
    """The query gives the pieces and the sampled segmentations themselves, of every row."""
    texts = {0: "the cat sat  on\tthe mat", 1: "", 2: None, 3: "日本語 unbelievable information", 4: "x" * 90}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op6_sentencepiece(spark, str(tmp_path)).collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        assert P.decode(r.pieces, VOCABULARY) == (texts[i] or "") and len(r.pieces) == r.n_pieces
        assert [len(x) for x in r.sampled] == r.n_sampled and len(r.sampled) == len(r.digest) > 0
        assert all(P.decode(x, VOCABULARY) == (texts[i] or "") for x in r.sampled)


def test_url_filter(spark):
    captures = [
        (1, "http://a.b.example.com/x/1", 5), (2, "https://A.b.example.com/x/1", 10), (3, "http://c.b.example.com/y", 10), (4, None, 10),
        (5, "no url", 10), (6, "http://a.b.example.com/z", None), (7, "http://u@a.b.example.com:80/x/2#f", 30), (7, "http://u@a.b.example.com:80/x/2#f", 30),
        (None, "http://other.org/" + "p" * 20_000, 12)]
    entries = [
        ("b.example.com", 8, 1, "block"), ("a.b.example.com", 10, 1, "allow"), ("a.b.example.com", 10, 2, "block"), ("a.b.example.com/x", 20, 1, "allow"),
        ("a.b.example.com", 25, 1, "allow"), ("other.org", 12, 1, "block"), (None, 1, 1, "block"), ("other.org", None, 9, "allow")]
    c = spark.createDataFrame(captures, "page_id long, url string, day int")
    e = spark.createDataFrame(entries, "pattern string, day int, seq int, action string")
    got = sorted(((r.page_id, r.blocked, r.rule, r.listed_on) for r in filter_urls(c, e).collect()), key=str)
    assert got == sorted([
        (1, False, None, None), (2, True, "a.b.example.com", 10), (3, True, "b.example.com", 8), (4, False, None, None), (5, False, None, None),
        (6, False, None, None), (7, False, "a.b.example.com/x", 20), (7, False, "a.b.example.com/x", 20), (None, True, "other.org", 12)], key=str)
    assert filter_urls(c.limit(0), e).count() == 0 and filter_urls(c, e.limit(0)).where("blocked").count() == 0


def test_url_filter_domains(spark):
    """An entry covers every host below it; the longest one in force decides."""
    c = spark.createDataFrame(
        [(1, "http://example.com/", 9), (2, "http://www.example.com/x", 9), (3, "http://a.b.c.example.com/x/y", 9), (4, "http://a.b.c.example.com/x/y", 12),
         (5, "http://notexample.com/", 9), (6, "http://WWW.Example.com./", 9), (7, "http://10.20.30.40/", 9), (8, "http://x.co.uk/", 9), (9, "http://a.b.c.example.com/x/y", 1),
         (10, "http://" + "w." * 3000 + "example.com/", 9)],
        "page_id long, url string, day int")
    e = spark.createDataFrame(
        [("example.com", 5, 1, "block"), ("c.example.com", 11, 1, "allow"), ("30.40", 1, 1, "block"), ("uk", 1, 1, "block")],
        "pattern string, day int, seq int, action string")
    got = {r.page_id: (r.blocked, r.rule) for r in filter_urls(c, e).collect()}
    below = (True, "example.com")
    assert got == {1: below, 2: below, 3: below, 4: (False, "c.example.com"), 5: (False, None), 6: below, 7: (False, None), 8: (True, "uk"), 9: (False, None), 10: below}


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage."""
    sf = "/root/testdata/sf0.001"
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, f in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(f(spark, out[-1], sf)))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_pipeline(spark, stages):
    """Each stage on what the one before it kept."""
    sf = "/root/testdata/sf0.001"
    docs, clean, exact, near, pure, coded = stages
    labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(clean) == sorted(r.doc_id for r in score_toxicity(docs, labels).collect() if not r.predicted)
    assert ids(exact) == ids(keep_last(clean)) and ids(near) == ids(keep_least(exact))
    gone = {r.doc_id for r in contaminated(near, bench).collect()}
    assert ids(pure) == ids(coded) == sorted(set(ids(near)) - gone)
    assert all(d.columns == docs.columns for d in (clean, exact, near, pure))
    assert len(ids(docs)) > len(ids(clean)) > len(ids(exact)) > len(ids(near)) >= len(ids(pure))
    assert ids(corpus_pipeline.run(spark, sf)) == ids(coded)


def test_lattices_of_many_new_units_are_built_in_parts(monkeypatch):
    rng = np.random.default_rng(5)
    words = [3 * P.ADD // 2, *rng.integers(3, 9, 40_000).tolist()]  # one unit alone is longer than a part
    points = rng.integers(0x61, 0x7B, sum(words)).astype(np.uint32)
    size = np.array(words)
    at = np.cumsum(size) - size
    keys = P._unit_keys(P._Substrings(points), at, size)
    taken, build = [], P.Lattices._add

    def add(self, keys, points, cuts):
        taken.append(len(points) - int(np.diff(cuts).max()))
        build(self, keys, points, cuts)

    monkeypatch.setattr(P.Lattices, "_add", add)
    parts = P.Lattices(VOCABULARY)
    unit = parts.units(keys, points, at, size)
    assert len(taken) > 2 and max(taken) <= P.ADD
    monkeypatch.setattr(P, "ADD", 1 << 40)
    whole = P.Lattices(VOCABULARY)
    same = whole.units(keys, points, at, size)
    assert (parts.best_size[unit] == whole.best_size[same]).all()
    for i in range(0, len(unit), 997):
        a, b = (lat.ids[lat.best[lat.best_first[u]:][:lat.best_size[u]]] for lat, u in ((parts, unit[i]), (whole, same[i])))
        assert (a == b).all()
