"""Operator 2: toxicity by Levenshtein automata intersected with a lexicon trie.

Learning, from at most ``sample`` labelled rows (those with the smallest hash of
their id; rows held out by crc32(id) mod 5 = 0 never): words that enough toxic
and hardly any clean documents have outside quotation make the lexicon, and word
beginnings that stand for several of them stand beside them.  Copies of a text
count once, and a term must follow several different words, else it is only part
of a text that has been copied with changes.  Its trie is intersected with the
automaton of edit distance 1 (whole words of five or more bytes) and made
deterministic, so one table finds exact, misspelled and inflected terms while
reading each word once; nearly all words leave the table after a few bytes.

Every hit is weighed by its context window: inside quotation marks, or near a
word of speech, it is a quotation; else abuse.  A logistic regression on the
(exact or misspelled) x (abuse or quoted) hits, their density and the strongest
term, fitted on the same sample, gives the score; documents without a hit get
its intercept.

Scoring is one pass over the documents, no shuffle; the model is broadcast, at
most ``max_terms`` terms and as many words that a stem covers (for their
misspellings).  Nulls: a null or empty text has no hits; a null id
has the checksum of an empty text; labels without document or document id are
ignored, repeated labels count as often as they occur (in the regression).  Without any toxic label
every score is the smoothed share.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.shared import discard, fresh, materialize, ship, tidy

STEMS = range(4, 8)  # lengths of word beginnings, in characters
SPEECH = frozenset(b"said says wrote writes quote quoted called word words term sagte dit dijo".split())
WINDOW = 6  # words to either side
QUOTES = [b'"', "“".encode(), "”".encode(), "«".encode(), "»".encode(), "„".encode()]
EXACT, FUZZY = 1, 2
FEATURES = 6


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


# --- the automaton -----------------------------------------------------------------


def automaton(terms: list[tuple[str, bool, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(next state by state and byte class, class of each byte, what a state
    accepts, weight of its strongest term).

    Terms are (text, is_stem, weight).  State 0 is dead, 1 the start.  A state is a set
    of (trie node, edits); a stem's end loops on every byte.
    """
    if not terms:
        return np.zeros((2, 1), np.int32), np.zeros(256, np.int64), np.zeros(2, np.int8), np.zeros(2)
    children: list[dict[int, int]] = [{}]
    ends: list[tuple[bool, float] | None] = [None]
    fuzzy: list[bool] = [False]  # below the node is a whole word long enough to be misspelled
    for text, stem, weight in terms:
        raw, node = text.encode(), 0
        long_word = not stem and len(raw) >= 5
        # one trie for terms that may be misspelled, one for the others: a leading byte no text has
        for byte in [256 if long_word else 257, *raw]:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(None)
                fuzzy.append(long_word)
            node = children[node][byte]
        ends[node] = (stem, weight)
    classes = np.zeros(256, np.int64)
    letters = sorted({b for c in children for b in c if b < 256})
    for i, b in enumerate(letters):
        classes[b] = i + 1

    def spread(states):
        """Skipping a byte of the term costs an edit and reads nothing."""
        out = set(states)
        for node, edits in states:
            if edits == 0 and fuzzy[node]:
                out |= {(c, 1) for c in children[node].values()}
        return frozenset(out)

    start = spread({(n, 0) for n in children[0].values()})
    number, todo, table = {frozenset(): 0, start: 1}, [start], {0: [0] * (len(letters) + 1)}
    accept, heavy = [0, 0], [0.0, 0.0]
    while todo:
        states = todo.pop()
        row = []
        for c in [None, *letters]:
            to = set()
            for node, edits in states:
                if ends[node] and ends[node][0]:
                    to.add((node, edits))
                if c in children[node]:
                    to.add((children[node][c], edits))
                if edits == 0 and fuzzy[node]:
                    to.add((node, 1))  # a byte too many
                    to |= {(x, 1) for x in children[node].values()}  # another byte
            to = spread(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
                accept.append(0)
                heavy.append(0.0)
            row.append(number[to])
        table[number[states]] = row
        done = {e for n, e in states if ends[n]}
        accept[number[states]] = EXACT if 0 in done else FUZZY if 1 in done else 0
        heavy[number[states]] = max((ends[n][1] for n, e in states if ends[n] and e == min(done)), default=0.0)
    return np.array([table[i] for i in range(len(number))], np.int32), classes, np.array(accept, np.int8), np.array(heavy)


def match(data: np.ndarray, t: W.Tokens, model: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, EXACT or FUZZY, weight) of the words that the automaton accepts."""
    table, classes, accept, heavy = model
    width = table.shape[1]
    flat, cls = table.reshape(-1), classes[data]
    word, at, end = np.arange(len(t.starts)), t.starts.copy(), t.ends
    state = np.ones(len(word), np.int64)
    hit, last = [], []
    while len(word):
        state = flat[state * width + cls[at]].astype(np.int64)
        at = at + 1
        over = at == end
        got = over & (accept[state] > 0)
        hit.append(word[got])
        last.append(state[got])
        on = ~over & (state != 0)
        word, at, end, state = word[on], at[on], end[on], state[on]
    hit, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hit, last))
    o = np.argsort(hit, kind="stable")
    return hit[o], accept[last[o]], heavy[last[o]]


def _features(b: pa.RecordBatch, column: int, model: tuple):
    """(first row, rows, features) by slice: exact abuse, exact quoted, misspelled
    abuse, misspelled quoted (each 0 or 1), hits in a hundred words (up to 1),
    weight of the strongest exact term."""
    for s in W.slices(b.column(column)):
        data = W.lowered(s.data)
        t = W.tokenize(data, s.offsets, W.ALNUM)
        x = np.zeros((s.hi - s.lo, FEATURES))
        for i, kind, weight in zip(*(c.tolist() for c in match(data, t, model)), strict=True):
            row = int(t.row[i])
            first, last = max(int(t.first[row]), i - WINDOW), min(int(t.first[row + 1]), i + WINDOW + 1)
            left = bytes(data[t.starts[first] if first > t.first[row] else s.offsets[row] : t.starts[i]])
            right = bytes(data[t.ends[i] : t.ends[last - 1] if last < t.first[row + 1] else s.offsets[row + 1]])
            near = {bytes(data[t.starts[j] : t.ends[j]]) for j in range(first, last) if j != i}
            quoted = bool(near & SPEECH) or any(q in left for q in QUOTES) and any(q in right for q in QUOTES)
            x[row, 2 * (kind == FUZZY) + quoted] = 1
            x[row, 4] += 1
            if kind == EXACT:
                x[row, 5] = max(x[row, 5], weight)
        words = np.maximum(np.diff(t.first), 1)
        x[:, 4] = np.minimum(1, x[:, 4] / words * 100)
        yield s.lo, s.hi - s.lo, x


# --- learning ----------------------------------------------------------------------


def _outside(text: str) -> list[tuple[str, str]]:
    """(word, the word before it) of the words outside quotation, by the rule of ``_features``."""
    data = W.lowered(np.frombuffer(text.encode(), np.uint8))
    t = W.tokenize(data, np.array([0, len(data)]), W.ALNUM)
    n, raw = len(t.starts), data.tobytes()
    words = [raw[s:e] for s, e in zip(t.starts.tolist(), t.ends.tolist(), strict=True)]
    quoted = np.zeros(n, bool)
    for j, w in enumerate(words):
        if w in SPEECH:
            quoted[max(0, j - WINDOW) : j] = quoted[j + 1 : j + 1 + WINDOW] = True
    marks = [m.span() for m in _MARK.finditer(raw)]
    if marks and n:
        begin, end = np.array(marks).T
        i = np.arange(n)
        first, last = np.maximum(i - WINDOW, 0), np.minimum(i + WINDOW + 1, n)
        lo, hi = np.where(first > 0, t.starts[first], 0), np.where(last < n, t.ends[last - 1], len(data))
        left = np.searchsorted(end, t.starts, "right") > np.searchsorted(begin, lo)
        quoted |= left & (np.searchsorted(end, hi, "right") > np.searchsorted(begin, t.ends))
    words = [w.decode() for w in words]
    return [(w, before) for w, before, q in zip(words, ["", *words], quoted.tolist(), strict=False) if not q]


def _forms(word: str) -> set[tuple[str, bool]]:
    """A word and its beginnings, as possible terms."""
    whole = {(word, False)} if len(word) >= 4 else set()
    return whole | {(word[:n], True) for n in STEMS if len(word) > n}


def _terms_of(text: str) -> set[tuple[str, bool]]:
    return set().union(*map(_forms, {w for w, _ in _outside(text)}))


_MARK = re.compile(b"|".join(QUOTES))


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, max_terms: int) -> dict:
    spark = docs.sparkSession
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(id_col)))
        .select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id", "toxic").limit(sample)
    )  # at most ``sample`` rows, hence the broadcast
    train = materialize(
        docs.join(F.broadcast(known), F.col(id_col) == F.col("_id")).select("toxic", F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    texts = materialize(train.select((F.col("toxic") > 0).cast("int").alias("toxic"), "text").distinct())

    def count(batches):
        seen = {0: Counter(), 1: Counter()}
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[int(y > 0)].update(_terms_of(text))
        if seen[1] or seen[0]:
            terms = list(seen[1].keys() | seen[0].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in terms], pa.string()), pa.array([x[1] for x in terms]), pa.array([seen[1][x] for x in terms], pa.int64()),
                 pa.array([seen[0][x] for x in terms], pa.int64())], names=["term", "stem", "pos", "neg"])

    counts = texts.mapInArrow(tidy(count), "term string, stem boolean, pos long, neg long").groupBy("term", "stem").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    toxic = texts.where("toxic > 0").count()
    support = max(3, round(toxic**0.5 / 4))
    rows = counts.where((F.col("pos") >= support) & (F.col("pos") >= 4 * F.col("neg"))).orderBy(
        F.desc(F.col("pos") - 4 * F.col("neg")), "term", "stem").limit(40 * max_terms).collect()
    places = {(r.term, r.stem) for r in rows}

    def around(batches):
        """Candidate terms and the word before them: changed copies of one text mostly agree in both."""
        seen = set()
        for b in batches:
            for text in b.column(1).to_pylist():
                for w, before in _outside(text):
                    seen |= {(x, before) for x in _forms(w) & places}
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x, _ in seen], pa.string()), pa.array([x[1] for x, _ in seen], pa.bool_()), pa.array([y for _, y in seen], pa.string())],
            names=["term", "stem", "before"])

    varied = texts.where("toxic > 0").mapInArrow(tidy(around), "term string, stem boolean, before string").groupBy("term", "stem").agg(
        F.countDistinct("before").alias("n"))
    contexts = {(r.term, r.stem): r.n for r in varied.collect()}  # of the candidates only
    rows = [r for r in rows if contexts.get((r.term, r.stem), 0) >= support]
    lexicon = _lexicon([(r.term, r.stem, r.pos, r.neg) for r in rows], support, max_terms)
    model = automaton(lexicon)

    def facts(batches):
        for b in batches:
            y = b.column(0).to_numpy()
            for lo, n, x in _features(b, 1, model):
                yield pa.RecordBatch.from_arrays([pa.array(y[lo : lo + n]), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])

    seen = train.mapInArrow(tidy(facts), "toxic int, x array<double>").collect()  # rows of the sample only
    discard(train, texts)
    weights = _fit(np.array([r.x for r in seen]).reshape(-1, FEATURES), np.array([r.toxic > 0 for r in seen], float))
    return {"lexicon": lexicon, "model": model, "weights": weights}


def _lexicon(rows: list[tuple[str, bool, int, int]], support: int, most: int) -> list[tuple[str, bool, float]]:
    """Stems that stand for at least two words and the words no stem covers:
    (text, is_stem, weight), the strongest ``most``; beside them as many of the
    words that a stem covers, since only whole words may be misspelled."""
    words = {t for t, stem, _, _ in rows if not stem}
    out: list[tuple[str, bool, float]] = []

    def weight(pos, neg):
        return math.log((pos + 0.5) / (neg + 0.5)) / 5

    # of stems with the same documents the longest is the most specific
    for t, stem, pos, neg in sorted(rows, key=lambda r: (-r[2], -len(r[0]), r[0])):
        if stem and pos >= 2 * support and pos >= 20 * neg and not any(t.startswith(x) or x.startswith(t) for x, _, _ in out):
            if sum(w.startswith(t) for w in words) >= 2:
                out.append((t, True, weight(pos, neg)))
    stems = [x for x, _, _ in out]
    covered = []
    for t, stem, pos, neg in rows:
        if not stem:
            (covered if any(t.startswith(x) for x in stems) else out).append((t, False, weight(pos, neg)))
    return [x for part in (out, covered) for x in sorted(part, key=lambda x: (-x[2], x[0]))[:most]]


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression (Newton steps, ridge 0.1 but for the intercept)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.array([0.1] * (x.shape[1] - 1) + [1e-3])
    if not len(y):
        return w - np.array([0.0] * (x.shape[1] - 1) + [3.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 10_000, max_terms: int = 192,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) of every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    learnt = learn(docs, labels, id_col, text_col, sample, max_terms)
    shared = spark.sparkContext.broadcast(learnt)

    def run(batches):
        model, w = shared.value["model"], shared.value["weights"]
        for b in batches:
            for lo, n, x in _features(b, 2, model):
                p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 10_000, max_terms: int = 192) -> DataFrame:
    """The rows of ``docs`` that score_toxicity predicts clean, all columns."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(learn(docs, labels, id_col, text_col, sample, max_terms))

    def run(batches):
        model, w = shared.value["model"], shared.value["weights"]
        for b in batches:
            clean = [x @ w[:-1] + w[-1] < 0 for _, _, x in _features(b, b.num_columns - 1, model)]
            if clean:
                yield b.select(range(b.num_columns - 1)).filter(pa.array(np.concatenate(clean)))

    # the text once more, last, wherever it stands
    return docs.select(*docs.columns, F.col(text_col).alias(fresh("_text", docs))).mapInArrow(tidy(run), docs.schema)
