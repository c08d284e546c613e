"""Operators 1, 4, 7, 9 and 10 against brute force, with awkward inputs."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from likeness.llm import line_dedup as line_module
from likeness.llm import linkage
from likeness.llm import words as W
from likeness.llm.decontaminate import _items, contaminated, decontaminate, passes
from likeness.llm.exact_dedup import KEY, SALT, directory, exact_dedup, keep_last, owned_chains
from likeness.llm.line_dedup import edit_distance_within, line_dedup
from likeness.llm.ngram_join import keep_least, ngram_join
from likeness.llm.substring_dedup import gaps, substring_dedup, ungaps
from likeness.llm.toxicity import drop_toxic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall(text.translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def joined(nodes, links):
    """Smallest node reachable, of each."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def ngram_brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = joined(ids, links)
    return {i: (len(sets[i]), least[i]) for i in ids}


def ngram_result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(df).collect()}


def test_ngram_join(awkward, texts, corpus, corpus_texts):
    assert ngram_result(awkward) == ngram_brute(texts)
    assert ngram_result(corpus) == ngram_brute(corpus_texts)


def test_ngram_join_in_blocks(awkward, texts, monkeypatch):
    """Groups far over the limits: cut into blocks, same components."""
    monkeypatch.setattr(linkage, "SMALL", 2)
    monkeypatch.setattr(linkage, "BLOCK", 4)
    assert ngram_result(awkward) == ngram_brute(texts)


def test_ngram_join_borders(spark):
    """Pairs exactly at, and just under, the threshold."""
    rows = [(1, " ".join(f"w{i}" for i in range(14)))]  # 10 shingles
    rows += [(2, rows[0][1] + " x y")]  # 10 of 12
    rows += [(3, " ".join(f"v{i}" for i in range(8))), (4, " ".join(f"v{i}" for i in range(9)))]  # 4 of 5
    rows += [(5, " ".join(f"u{i}" for i in range(7))), (6, " ".join(f"u{i}" for i in range(8)))]  # 3 of 4
    got = ngram_result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {i: c for i, (_, c) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}


def test_ngram_join_awkward(ragged, empty):
    got = ngram_join(ragged).collect()
    assert len(got) == ragged.count()
    assert all(r.component_id == r.doc_id for r in got if not r.n_shingles)
    assert ngram_join(empty).count() == 0
    assert keep_least(empty).count() == 0
    assert keep_least(ragged).columns == ragged.columns


def test_keep_least(awkward, texts):
    kept = {r.doc_id for r in keep_least(awkward).collect()}
    assert kept == {i for i, (_, c) in ngram_brute(texts).items() if i == c}


def exact_brute(texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t].append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


WEAK = [
    {},
    {"capacity": 5},
    {"hash_of": lambda c: F.length(c).cast("long")},
    {"hash_of": lambda c: F.length(c).cast("long"), "digest": lambda c: F.substring(c, 1, 1)},  # real collisions
]


@pytest.mark.parametrize("options", WEAK)
def test_exact_dedup(awkward, texts, options):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(awkward, **options).collect()}
    assert got == exact_brute(texts)


def test_exact_dedup_awkward(ragged, empty):
    got = exact_dedup(ragged).collect()
    assert len(got) == ragged.count()
    different = ragged.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert sum(r.kept for r in got) == different
    kept = keep_last(ragged)
    assert kept.columns == ragged.columns and kept.count() == different
    assert exact_dedup(empty).count() == 0 and keep_last(empty).count() == 0


def test_directory_doubles(corpus):
    """Overfull buckets split until they fit, or no bit is left."""
    sizes = exact_dedup(corpus, capacity=20).groupBy("bucket", "depth").count().collect()
    assert max(r.depth for r in sizes) > 2
    assert all(r["count"] <= 20 or r.depth == 12 for r in sizes)


def test_owners_do_the_grouping(spark):
    """After the entries are dealt to the owners of (bucket, hash) nothing is
    shuffled again; a third of all rows in one group is a few rows there."""
    text = F.when(F.expr("id % 3 = 0"), "copy").otherwise(F.col("id").cast("string"))
    index = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.xxhash64(text).alias("h"), F.octet_length(text).alias("len"), F.sha2(text, 256).alias("sha"), F.col("id").alias("row"))
    slots = directory(index, 100, 12)
    chains = owned_chains(index, slots, 12, 8)
    plan = chains._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    shuffles = [x for x in plan.splitlines() if "Exchange " in x and "Broadcast" not in x]
    assert "rangepartitioning(bucket" in shuffles[0] and "h#" in shuffles[0]
    assert re.search(r"Aggregate\(keys?=\[bucket", plan).start() < plan.index("rangepartitioning(bucket")
    assert sum("hashpartitioning(bucket" in x for x in shuffles) <= 1  # of the directory itself
    rows = chains.collect()
    assert len(rows) == 6001 and sum(r.group_size for r in rows) == 9000 and max(r.group_size for r in rows) == 3000
    assert {r.depth for r in rows} != {0} and SALT < 100 and set(KEY) <= set(chains.columns)


def substring_brute(texts, k=13):
    words = {i: WORD.findall(t) for i, t in texts.items()}
    least = {}
    for i in sorted(words):
        for j in range(len(words[i]) - k + 1):
            least.setdefault(tuple(words[i][j : j + k]), i)
    out = {}
    for i, w in words.items():
        gone = {j + x for j in range(len(w) - k + 1) if least[tuple(w[j : j + k])] < i for x in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_substring_dedup(awkward, texts, corpus, corpus_texts):
    for df, t in ((awkward, texts), (corpus, corpus_texts)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring_dedup(df).collect()}
        assert got == substring_brute(t)


def test_substring_dedup_awkward(ragged, empty):
    got = substring_dedup(ragged).collect()
    assert len(got) == ragged.count()
    assert all(not r.n_removed for r in got if r.doc_id is None)
    assert substring_dedup(empty).count() == 0


def test_gaps():
    import numpy as np

    rng = random.Random(3)
    for _ in range(50):
        cells = np.array(sorted(rng.sample(range(rng.choice([60, 3000, 10**6])), rng.randrange(40))), np.uint32)
        assert ungaps(gaps(cells)).tolist() == cells.tolist()


def items(spark, texts):
    rows = [(i, t) for i, t in enumerate(t for t in list(texts.values())[:25] if len(t) < 1000)]
    rows += [(900, None), (901, ""), (902, "x"), (903, "not in any document of the corpus at all"), (None, rows[0][1])]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def contaminated_brute(texts, rows):
    out = []
    for i, t in texts.items():
        s = shingles(t)
        for item, x in rows:
            g = shingles(x or "")
            if g and 100 * len(g & s) >= 80 * len(g):
                out.append((i, item, len(g), len(g & s)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_decontaminate(spark, awkward, texts, block):
    bench, rows = items(spark, texts)
    got = contaminated(awkward, bench, block=block).collect()
    expected = contaminated_brute(texts, rows)
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got), key=str) == expected
    kept = {r.doc_id for r in decontaminate(awkward, bench, block=block).collect()}
    assert kept == texts.keys() - {r[0] for r in expected}


def test_items_go_by_size(spark, texts):
    """Every item is in the partition of its size, and the passes hold each part once."""
    bench, rows = items(spark, texts)
    sizes = {r.item_id: (r.n, r.band) for r in _items(bench, "item_id", "text", 5, 80).collect()}
    assert all(2 ** (b - 1) < n <= 2**b for n, b in sizes.values()) and len({b for _, b in sizes.values()}) > 2
    got = passes({0: 3, 4: 50, 6: 230}, 100)
    assert [p for x in got for p in x] == [(0, 0, 1), (4, 0, 1), (6, 0, 3), (6, 1, 3), (6, 2, 3)]
    assert got[0] == [(0, 0, 1), (4, 0, 1)] and len(got) == 4 and passes({}, 100) == [[]]


def test_decontaminate_short_in_long(spark):
    """Short items inside long documents, sizes on both sides of the partitions, and documents too short for them."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    bench = {i: " ".join(rng.choice(words) for _ in range(n)) for i, n in enumerate([5, 6, 7, 8, 9, 12, 13, 20, 21, 36, 37, 68, 69, 70])}
    docs = {}
    for i, t in bench.items():
        w = t.split(" ")
        filler = [rng.choice(words) for _ in range(3000)]
        docs[10 * i] = " ".join(filler[:1500] + w + filler[1500:])
        docs[10 * i + 1] = " ".join(w[: len(w) - len(w) // 8])  # some of it, too short for others
        docs[10 * i + 2] = " ".join(w[: len(w) // 2])
    got = contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(bench.items()), "item_id long, text string"), block=60)
    got = sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got.collect()), key=str)
    assert got == contaminated_brute(docs, list(bench.items())) and len(got) >= len(bench)


def test_decontaminate_awkward(spark, ragged, empty, texts):
    bench, _ = items(spark, texts)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(empty, bench).count() == 0 and contaminated(ragged, none).count() == 0
    kept = decontaminate(ragged, bench)
    assert kept.columns == ragged.columns and 0 < kept.count() < ragged.count()
    assert decontaminate(ragged, none).count() == ragged.count()


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(2))
        for most in range(4):
            assert edit_distance_within(a, b, most) == (levenshtein(a, b) <= most)


def lines_of(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([5, 29, 30, 31, 32, 40, 90]))).strip() + "." for _ in range(40)]
    out = list(base)
    for line in base:
        for _ in range(3):
            w = list(line)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
            out.append("".join(w))
    rng.shuffle(out)
    return {i: "\n".join(rng.choice([*out, "", "  ", "\r", "\t \x0b"]) for _ in range(6)) for i in range(60)} | {60: "", 61: "\n\n"}


def test_line_dedup(spark):
    texts = lines_of(2)
    lines = sorted({x for t in texts.values() for x in t.split("\n") if x.strip(BLANK)})
    links = [(a, b) for n, a in enumerate(lines) for b in lines[n + 1 :] if min(len(a), len(b)) >= 30 and levenshtein(a, b) <= 2]
    cls, seen, expected = joined(lines, links), set(), {}
    for i in sorted(texts):
        kept = []
        for x in texts[i].split("\n"):
            if not x.strip(BLANK) or cls[x] not in seen:
                kept.append(x)
            seen |= {cls[x]} if x.strip(BLANK) else set()
        expected[i] = (sum(bool(x.strip(BLANK)) for x in texts[i].split("\n")), texts[i].count("\n") + 1 - len(kept), "\n".join(kept))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup(df).collect()}
    assert len(links) > 20 and got == expected


def test_line_dedup_blank_lines(spark):
    """Lines of white space of any kind are blank, and stay; so do both texts without an id."""
    line = "a line of more than thirty characters, twice"
    rows = [(1, f"{line}\r\n\r\n\t\r\nend one"), (2, f"{line}\r\n\r\n\t\r\nend two"), (None, f"{line}\r"), (None, f"{line}\r\nother")]
    got = {r.kept_text: (r.doc_id, r.n_lines, r.n_removed) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got["\r\n\t\r\nend one"] == (1, 2, 1) and got["\r\n\t\r\nend two"] == (2, 2, 1)


def thue_morse(n):
    """Two words of 2^n letters in which every polynomial hash modulo 2^64 agrees."""
    bits = [bin(i).count("1") & 1 for i in range(1 << n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [10, 12])
def test_structured_words_differ(spark, n):
    """Words that agree in polynomial hashes are different words to operators 1, 7 and 10."""
    x, y = thue_morse(n)
    data = np.frombuffer(f"{x} {y}".encode(), np.uint8)
    for seed in (0, 1):
        assert len(set(W.hash_words(data, W.tokenize(data, np.array([0, len(data)]), W.NOT_SPACE), seed).tolist())) == 2
    left, right = "one two three four five six".split(), "seven eight nine ten eleven twelve".split()
    rows = [(1, " ".join([*left, x, *right])), (2, " ".join([*left, y, *right])), (3, " ".join(right[:2] + [x] + left[:1] + [y])), (4, " ".join(right[:2] + [y] + left[:1] + [x]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    assert ngram_result(df) == ngram_brute(texts)
    assert {r.doc_id: r.n_removed for r in substring_dedup(df).collect()} == dict.fromkeys(texts, 0)
    got = contaminated(df, df.where("doc_id in (1, 3)").withColumnRenamed("doc_id", "item_id")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (3, 3)]


def test_stages_keep_all_columns(spark, awkward, texts):
    """Columns named like the helpers' own come back with their values."""
    names = ["_sha", "_hash", "_key", "_p", "_b", "_bits", "_maybe", "_salt", "_text", "_m", "_parts"]
    df = awkward.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in names]).union(
        awkward.limit(1).select("*", *[F.lit(None).cast("string").alias(c) for c in names]))
    bench, _ = items(spark, texts)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    for out in (keep_last(df), keep_least(df), decontaminate(df, bench), drop_toxic(df, labels)):
        assert out.columns == df.columns
        rows = out.where("_sha is not null").collect()
        assert len(rows) > 50 and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in names)


def near_copies(n, seed):
    """(key, node) rows and facts of n sets near one other, all under the same keys; the sets."""
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 1 << 62, 200, dtype=np.int64)
    sets = []
    for _ in range(n):
        s = base.copy()
        s[rng.integers(0, 200, 4)] = rng.integers(1, 1 << 62, 4)
        sets.append(np.unique(s).view(np.uint64))
    return sets


def linked(spark, sets, rows_made):
    """Components of ``sets`` under two common keys by linkage.connect, adding the rows that each round made."""
    from likeness.llm import ngram_join

    facts = []
    for i, s in enumerate(sets):
        row, n = np.zeros(len(s), np.int64), np.array([len(s)])
        facts.append((i, len(s), ngram_join._sketch(row, s, 1).tobytes(), ngram_join._wide(row, s, n)[0].tobytes()))
    facts = spark.createDataFrame(facts, "node long, n long, sketch binary, wide binary")
    live = spark.createDataFrame([(k, i) for i in range(len(sets)) for k in (1, 2)], "key long, node long")

    def allow(n, m, d):
        return (np.maximum(n, m) * 80 <= 100 * np.minimum(n, m)) & (d * 180 <= 20 * (n + m))

    def links(pairs):
        rows = pairs.collect()
        rows_made.append(len(rows))
        ok = [(r.x, r.y) for r in rows if 100 * len(np.intersect1d(sets[r.x], sets[r.y])) >= 80 * len(np.union1d(sets[r.x], sets[r.y]))]
        return spark.createDataFrame(ok, "x long, y long")

    made, compare = [], linkage.compare

    def counted(*args):
        out = compare(*args)
        made.append(out.count())
        return out

    linkage.compare = counted
    try:
        labels = {r.node: r.component for r in linkage.connect(live, facts, allow, links).collect()}
    finally:
        linkage.compare = compare
    return labels, sum(made)


def test_linkage_makes_rows_in_proportion(spark, monkeypatch):
    """Five times the near copies make about five times the rows, and one component."""
    monkeypatch.setattr(linkage, "BLOCK", 64)
    made = {}
    for n in (300, 1500):
        labels, made[n] = linked(spark, near_copies(n, n), [])
        assert labels == dict.fromkeys(range(n), 0)
    assert made[1500] <= 6 * made[300]


def test_linkage_of_apart_families(spark, monkeypatch):
    """Families under one key stay apart, and each is whole, however its blocks fall."""
    monkeypatch.setattr(linkage, "BLOCK", 8)
    families = [near_copies(n, 100 + f) for f, n in enumerate((40, 25, 1, 1, 12))]
    sets = [s for f in families for s in f]
    of = [f for f, x in enumerate(families) for _ in x]
    labels, _ = linked(spark, sets, [])
    first = {f: of.index(f) for f in set(of)}
    assert {i: labels.get(i, i) for i in range(len(sets))} == {i: first[f] for i, f in enumerate(of)}


def test_linkage_of_many_common_keys(spark):
    """The rows made are few however many keys the nodes share: equal groups count once, others meet in one task."""
    sets, n_keys = near_copies(12, 5), 150
    facts = []
    from likeness.llm import ngram_join

    for i, s in enumerate(sets):
        facts.append((i, len(s), ngram_join._sketch(np.zeros(len(s), np.int64), s, 1).tobytes()))
    facts = spark.createDataFrame(facts, "node long, n long, sketch binary")
    live = [(k, i) for k in range(n_keys) for i in range(12)]  # the same nodes
    live += [(n_keys + k, i) for k in range(n_keys) for i in range(12) if i == 0 or (i + k) % 11 or k % 3]  # some without one or two
    rows, compare = [], linkage.compare

    def counted(*args):
        out = compare(*args)
        rows.append(out.count())
        return out

    linkage.compare = counted
    try:
        labels = linkage.connect(
            spark.createDataFrame(live, "key long, node long"), facts, lambda n, m, d: n == n, lambda pairs: pairs.where("x < 10 and y < 10")).collect()
    finally:
        linkage.compare = compare
    assert {r.node: r.component for r in labels} == dict.fromkeys(range(10), 0)
    assert max(rows) <= 8 * 66  # not some of each of 300 keys


def test_linkage_of_a_lone_pair(spark, monkeypatch):
    """Two linked nodes of a large group meet, even if the first round, in blocks, makes no row at all."""
    monkeypatch.setattr(linkage, "BLOCK", 4)
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(1, 1 << 62, 30).astype(np.uint64)) for _ in range(160)]
    sets[150] = sets[3].copy()
    sets[150][:1] += np.uint64(1)
    labels, _ = linked(spark, sets, [])
    assert labels == {3: 3, 150: 3}


def test_line_dedup_hot_key(monkeypatch):
    """A key of many lines is passed on in runs, whatever the order of its lines."""
    monkeypatch.setattr(line_module, "FLUSH", 50)
    rng = random.Random(3)
    entries = [(0, 7, n) for n in range(1000)] + [(1, 7, n) for n in range(500, 2000)]  # (probe, key, node)
    entries += [(rng.randrange(2), 100 + rng.randrange(300), rng.randrange(40)) for _ in range(3000)]
    entries = sorted(entries, key=lambda x: (x[0], rng.random()))
    read, early = 0, 0

    def batches():
        nonlocal read
        for bucket in range(2):
            for probe in range(2):
                mine = [e for e in entries if e[0] == probe and e[1] % 2 == bucket]
                for at in range(0, len(mine), 20):
                    part = sorted(mine[at : at + 20], key=lambda e: e[1])
                    read += len(part)
                    keys, nodes = np.array([e[1] for e in part], np.uint64), np.array([e[2] for e in part], np.int64)
                    cuts = np.array([0, len(part)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int32()), pa.array([probe], pa.int32()), W.binary_cuts(keys, cuts), W.binary_cuts(nodes, cuts)],
                        names=["bucket", "probe", "keys", "nodes"])

    got = set()
    for b in line_module._receive(batches()):
        early += len(b) if read < len(entries) else 0
        assert len(b) <= 4 * 50 + 600
        got |= set(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    nodes, index = defaultdict(set), {k for p, k, _ in entries if p == 0}
    for _, k, n in entries:
        nodes[k].add(n)
    assert got == {(k, n) for k, x in nodes.items() if k in index and len(x) > 1 for n in x}
    assert early > 2000


def test_line_dedup_in_runs(awkward, monkeypatch):
    """Many small runs give the same rows as one."""
    whole = sorted((r.doc_id, r.kept_sha256) for r in line_dedup(awkward, min_chars=8).collect())
    monkeypatch.setattr(line_module, "FLUSH", 100)
    assert sorted((r.doc_id, r.kept_sha256) for r in line_dedup(awkward, min_chars=8).collect()) == whole


def test_line_dedup_awkward(ragged, empty):
    assert line_dedup(ragged).count() == ragged.count()
    assert line_dedup(empty).count() == 0
