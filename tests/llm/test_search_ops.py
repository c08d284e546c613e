"""Operators 11, 12 and 13 against brute force, with awkward inputs."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from likeness.llm import lexical_search as search_module
from likeness.llm.lexical_search import rank_documents
from likeness.llm.neighbours import Cells, KdTree, chi2, nearest
from likeness.llm.spelling import Acceptor, group_variants, near_words, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def ragged_rows(spark, ragged):
    """The ragged documents, the same at every use, and their ids and texts."""
    rows = [tuple(r) for r in ragged.collect()]
    return spark.createDataFrame(rows, ragged.schema).repartition(5), [(r[0], r[1]) for r in rows]


# ------------------------------------------------------- lexical search ---

def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def search_brute(docs, items, k=20):
    """docs: (id, text) rows; items: (id, text)."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_all = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in found:
            if not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_all
            s = 0
            for t in terms(text):
                if c[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def search_result(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "bain CORa tust"), (2, "bain bain né"), (3, "CHANGED x"), (4, None), (5, ""), (6, "--- !"), (7, "zz9 unknown"), (8, "rust_gor")]
    return spark.createDataFrame([(*r, "b", r[0]) for r in rows], "item_id long, text string, score string, doc_id long")


def test_lexical_search(awkward, texts, items, corpus, corpus_texts, spark):
    pairs = [(r.item_id, r.text) for r in items.collect()]
    assert search_result(rank_documents(awkward, items)) == search_brute(sorted(texts.items()), pairs)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    pairs = [(r.item_id, r.text) for r in bench.collect()]
    assert search_result(rank_documents(corpus, bench)) == search_brute(sorted(corpus_texts.items()), pairs)


def test_lexical_search_in_blocks(awkward, texts, items):
    """An item a block, a document a chunk, few results: the same ranks."""
    pairs = [(r.item_id, r.text) for r in items.collect()]
    got = rank_documents(awkward, items, k=3, block=8, cells=2)
    assert search_result(got) == search_brute(sorted(texts.items()), pairs, k=3)


def test_lexical_search_awkward(ragged_rows, empty, items):
    ragged, rows = ragged_rows
    pairs = [(r.item_id, r.text) for r in items.collect()]
    got = search_result(rank_documents(ragged, items))
    exp = search_brute(rows, pairs)
    assert got == exp
    assert rank_documents(empty, items).count() == 0
    assert rank_documents(ragged, items.limit(0)).count() == 0
    assert rank_documents(ragged, items.where("text is null")).count() == 0
    twice = search_result(rank_documents(ragged, items.union(items)))
    assert twice == exp  # repeated items count once


def test_lexical_search_ties_and_borders(spark):
    """Equal scores by ascending id; terms only between boundaries, bytes beyond ASCII belong to them."""
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(40, 0, -1)] + [(99, "alphabet xalpha alphaé"), (98, "gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "ALPHA"), (2, "alphaé"), (3, "beta beta")], "item_id long, text string")
    got = search_result(rank_documents(docs.repartition(7), items))
    assert [(r, d) for i, r, d, _ in sorted(got) if i == 1] == [(n, n) for n in range(1, 21)]
    assert [d for i, _, d, _ in got if i == 2] == [99]
    assert got == search_brute([(r.doc_id, r.text) for r in docs.collect()], [(1, "alpha"), (2, "alphaé"), (3, "beta beta")])


def test_guarded_counts():
    data = "Ab,c\x00DÉ".encode()
    text, bounds = search_module.guarded(np.frombuffer(data, np.uint8), np.array([0, 3, 3, len(data)]))
    assert text.tobytes().decode() == " ab   c dÉ "
    assert search_module.count_terms(text, bounds).tolist() == [1, 0, 2]


# ---------------------------------------------------- spelling variants ---

def near_brute(words):
    """Unordered pairs that differ by one edit."""
    cut, out = defaultdict(set), set()
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            cut[i, short].add(w)
            if short in words:
                out.add((min(w, short), max(w, short)))
    for group in cut.values():
        out.update((min(a, b), max(a, b)) for a, b in itertools.combinations(group, 2))
    return out


def words_brute(rows, min_length=6, min_count=5, one_in=199):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def variants_brute(n, ratio=5):
    near = defaultdict(set)
    for a, b in near_brute(set(n)):
        near[a].add(b)
        near[b].add(a)
    form = {w: min(near[w], key=lambda x: (-n[x], x)) if near[w] else None for w in n}
    form = {w: f if f and n[f] >= ratio * n[w] else None for w, f in form.items()}

    def last(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], last(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def variants_result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_acceptor():
    rng = random.Random(3)
    for _ in range(30):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 80))})
        got = [(min(words[i], words[j]), max(words[i], words[j])) for i, j, _ in Acceptor(words).near()]
        assert len(got) == len(set(got)) and set(got) == near_brute(set(words))
    a = Acceptor(sorted(x + "tion" for x in ("na", "ra", "sta")))
    assert len(a.edges) < 10  # equal endings are one state


@pytest.fixture(scope="module")
def spelled(spark):
    """(word, n) with many words of few letters, long runs, and letters of the upper range."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(6, 9))) for _ in range(1500)}
    words |= {"a" * n for n in (6, 7, 8, 40, 41, 3000, 3001)} | {"éèêëàáâ", "éèêëàáã", "éèêëàá", "x" * 20 + "y", "x" * 20 + "z", "x" * 21}
    return {w: 5 + len(w) * 7 % 11 for w in words}


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_near_words(spark, spelled, most):
    """Whole partitions, and such cut again and again."""
    df = spark.createDataFrame(list(spelled.items()), "word string, n long")
    rows = near_words(df, most=most).collect()
    got = [(r.word, r.near) for r in rows]
    exp = near_brute(set(spelled))
    assert len(got) == len(set(got)) == 2 * len(exp) and set(got) == exp | {(b, a) for a, b in exp}
    assert all(spelled[r.word] == r.n and spelled[r.near] == r.near_n for r in rows)


def test_variants(corpus, corpus_texts, ragged_rows):
    exp = variants_brute(words_brute(corpus_texts.items()))
    assert any(v[0] for v in exp.values())
    assert variants_result(group_variants(corpus)) == exp
    ragged, rows = ragged_rows
    n = words_brute(rows, 2, 2, 7)
    assert {r.word: r.n for r in words_of(ragged, min_length=2, min_count=2, drop_one_in=7).collect()} == n
    assert variants_result(group_variants(ragged, min_length=2, min_count=2, drop_one_in=7, most=5)) == variants_brute(n)


def test_variants_chain(spark, empty):
    """Forms of forms, ties by code point, words just short of the ratio."""
    texts = ["planett " * 5, "planet " * 25, "planeta " * 125, "planetas " * 700, "blanketz " * 6, "blanket " * 29, "WINDOWS windowz " * 30 + "window " * 6]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = variants_result(group_variants(docs, drop_one_in=0))
    assert got["planett"] == ("planeta", "planetas", 5, 2, 125)
    assert got["planet"][:2] == ("planeta", "planetas") and got["planetas"][:2] == (None, "planetas")
    assert got["blanketz"][:2] == (None, "blanketz")
    assert got["window"] == ("windows", "windows", 6, 2, 30)
    assert got == variants_brute({w: c for w, c in Counter(w.lower() for t in texts for w in t.split()).items() if c >= 5 and len(w) >= 6})
    assert group_variants(empty).count() == 0


# ---------------------------------------------------- nearest neighbours ---

def nearest_brute(rows, k=10):
    """rows: distinct (id, vector) that take part."""
    out = {}
    for q, x in rows:
        if q % 100 == 0:
            d = sorted((math.sqrt(float(((np.array(y) - np.array(x)) ** 2).sum())), v) for v, y in rows if v != q and len(y) == len(x))
            out.setdefault(q, []).extend(d[:k])
    return out


def check_nearest(df, rows, recall, k=10):
    got = defaultdict(list)
    for r in df.collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    exp = nearest_brute(rows, k)
    at, hits, total = {i: x for i, x in rows}, 0, 0
    for q, d in exp.items():
        mine = sorted(got.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(d) + 1))  # as many as there are
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        for _, s, v in mine:
            assert v != q and s == pytest.approx(math.sqrt(float(((np.array(at[v]) - np.array(at[q])) ** 2).sum())), rel=1e-14)
        hits += len({v for _, _, v in mine} & {v for _, v in d})
        total += len(d)
    assert set(got) == {q for q, d in exp.items() if d}
    assert hits >= recall * total
    return got


def test_chi2():
    draws = (np.random.default_rng(0).standard_normal((200_000, 8)) ** 2).sum(1)
    assert (draws <= chi2(0.95, 8)).mean() == pytest.approx(0.95, abs=0.003)
    assert chi2(0.95, 2) == pytest.approx(-2 * math.log(0.05))


def test_kd_tree():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.standard_normal((700, 3)), np.zeros((300, 3))])
    tree = KdTree(points, 16)
    for q in rng.standard_normal((20, 3)):
        seen, radius = [], -1.0
        for r, lo, hi in tree.walk(q):
            assert r >= radius and ((points[tree.order[lo:hi]] - q) ** 2).sum(1).min() >= r - 1e-12
            radius = r
            seen += tree.order[lo:hi].tolist()
        assert sorted(seen) == list(range(1000))
    cells = Cells(points, 8)
    assert len(set(cells.of(points).tolist())) >= 8


def test_nearest_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_nearest(nearest(df, df.where("vec_id % 100 = 0")), rows, 0.9)


def test_nearest_in_many_blocks(spark):
    """Clusters, many small blocks, cells of several blocks."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 24)) * 4
    x = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    check_nearest(nearest(df, df.where("vec_id % 100 = 0"), sample=512, block=30), rows, 0.9)


def test_nearest_ties_and_copies(spark):
    """A third of all rows are one vector; copies among queries; rows that take no part."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 8)).round(3)
    x[200:400] = x[0]
    x[500] = x[501] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v[:3].tolist()) for i, v in enumerate(x[:30])]
    odd = [(2000, None), (2100, []), (2200, [0.0] * 8), (2300, [1.0, None]), (2400, [math.nan] * 8), (2500, [math.inf, 1.0]), (None, x[3].tolist())]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd + rows[:50]], "vec_id long, embedding array<double>, score int, rank string")
    got = check_nearest(nearest(df.repartition(9), df.where("vec_id % 100 = 0"), sample=64, block=16), rows, 0.9)
    assert [v for _, _, v in sorted(got[300])] == [0, *range(200, 209)]
    assert [v for _, _, v in sorted(got[0])] == list(range(200, 210))


def test_nearest_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert nearest(empty, empty).count() == 0
    one = spark.createDataFrame([(100, [1.0, 2.0])], schema)
    assert nearest(one, one).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0])], schema)
    got = [(r.rank, r.vec_id) for r in nearest(few, few.where("vec_id = 0")).collect()]
    assert sorted(got) == [(1, 1), (2, 2), (3, 3)]
    assert nearest(few, empty).count() == 0
