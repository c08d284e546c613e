"""Operator 11: ranked lexical search by scanning the documents with an automaton.

All terms of all items form one Aho-Corasick automaton, which is broadcast.
Its patterns are guarded: a term stands between two separator bytes, and the
scanned text has every byte that is no part of a term turned into one
separator, so that the automaton finds whole terms only.  Each output is the
number of a term and maps to the items that have it.  The documents are scanned
twice and never indexed, written or shuffled: the first scan sums the counts
that the weights need (N, L and df), the second counts tf, scores every
document for every item, and keeps the best k of each item per task.  The
bests of all tasks are then ranked, by item and salt first.

A term is a maximal run of digits, letters A-Z (lower-cased) and everything
beyond ASCII.  Scores are 64-bit integers, as the weights are rounded down.

Items travel in blocks of about ``block`` bytes of text (two scans a block), so
what is broadcast, and the counts that return to the driver, are bounded; an
item is always whole.  Documents are handled in chunks of at most ``cells``
scores (one document at least).

Nulls: null or empty texts have no term; a document of these counts for
nothing, an item of these has no result.  A document with a null id takes part
and ranks last among equal scores; repeated documents are documents of their
own.  Repeated rows (id and text) of ``items`` count once; different texts under
one id are ranked apart.  No other columns are read.
"""

from __future__ import annotations

import math
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.shared import ship, tidy

BLOCK = 1 << 20
CELLS = 1 << 21
SALTS = 64
GAP = 0x20

#: bytes of terms as they are compared, all others as the separator
_TERM = np.full(256, GAP, np.uint8)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = W.LOWER[
    [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]]

_automata: dict[str, ahocorasick.Automaton] = {}  # the last one of this Python worker


def guarded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes with one separator before each row and one at the end,
    and the places of these separators."""
    rows = len(offsets) - 1
    out = np.full(len(data) + rows + 1, GAP, np.uint8)
    out[np.arange(len(data)) + 1 + np.repeat(np.arange(rows), np.diff(offsets))] = _TERM[data]
    return out, offsets + np.arange(rows + 1)


def count_terms(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Terms of each row."""
    starts = np.flatnonzero((text[1:] != GAP) & (text[:-1] == GAP)) + 1
    return np.diff(np.searchsorted(starts, bounds))


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, t in enumerate(terms):
        a.add_word(f" {t.decode('latin-1')} ", i)
    a.make_automaton()
    return a


def _loaded(index) -> tuple:
    name, terms, *rest = index.value
    if name not in _automata:
        _automata.clear()
        _automata[name] = automaton(terms)
    return _automata[name], len(terms), *rest


def _scan(a: ahocorasick.Automaton, n_terms: int, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, term, tf) of the automaton's terms in the rows, by row, then term."""
    hits = np.fromiter(a.iter(text.tobytes().decode("latin-1")), [("end", np.int64), ("term", np.int64)])
    row = np.searchsorted(bounds, hits["end"] - 1, "right") - 1
    key, tf = np.unique(row * n_terms + hits["term"], return_counts=True)
    return key // n_terms, key % n_terms, tf.astype(np.int64)


def _block(rows: pa.Table) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the items, distinct terms, and for each term the items that have it
    (cuts, item, repeats)."""
    ids, at, items, of = rows.column("item_id").to_pylist(), {}, [], []
    for i, text in enumerate(rows.column("text").to_pylist()):
        for term in _TERM[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split():
            items.append(i)
            of.append(at.setdefault(term, len(at)))
    pair, repeats = np.unique(np.array(of, np.int64) * max(len(ids), 1) + np.array(items, np.int64), return_counts=True)
    term, item = pair // max(len(ids), 1), pair % max(len(ids), 1)
    return ids, list(at), np.searchsorted(term, np.arange(len(at) + 1)), item, repeats.astype(np.int64)


def _counts(docs: DataFrame, index) -> DataFrame:
    """(term, total) over all documents: df of each term; under -1 the documents
    that hold a term of any kind (N), under -2 all their terms (L)."""

    def run(batches):
        a, n_terms, *_ = _loaded(index)
        df, n_docs, n_all = np.zeros(n_terms, np.int64), 0, 0
        for b in batches:
            for s in W.slices(b.column(0)):
                text, bounds = guarded(s.data, s.offsets)
                n = count_terms(text, bounds)
                n_docs, n_all = n_docs + int((n > 0).sum()), n_all + int(n.sum())
                df += np.bincount(_scan(a, n_terms, text, bounds)[1], minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [n_docs, n_all]))], names=["term", "total"])

    return docs.select("text").mapInArrow(tidy(run), "term long, total long").groupBy("term").agg(F.sum("total").alias("total"))


def _best(docs: DataFrame, index, weights, k: int, cells: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best k documents of each item, per task."""

    def run(batches):
        a, n_terms, ids, cuts, item, repeats = _loaded(index)
        w, n_docs, n_all = weights.value
        step = max(1, cells // len(ids))
        none = np.zeros(0, np.int64)
        best = (none, none, none, none)  # item, score, doc_id, whether that is null
        least = np.ones(len(ids), np.int64)  # score that a document needs to be among the best

        def merge(best, more):
            at = [np.concatenate(c) for c in zip(best, more, strict=True)]
            o = np.lexsort((at[2], at[3], -at[1], at[0]))
            first = np.searchsorted(at[0][o], np.arange(len(ids) + 1))
            o = o[np.arange(len(o)) - first[at[0][o]] < k]
            best = tuple(c[o] for c in at)
            last = np.searchsorted(best[0], np.arange(len(ids)), "right")
            full = np.flatnonzero(np.diff(np.append(0, last)) == k)
            least[full] = best[1][last[full] - 1]
            return best

        for b in batches:
            doc = b.column(0)
            null = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = doc.fill_null(0).to_numpy()
            for s in W.slices(b.column(1)):
                text, bounds = guarded(s.data, s.offsets)
                m = 75 + (25 * count_terms(text, bounds) * n_docs) // max(n_all, 1)
                row, term, tf = _scan(a, n_terms, text, bounds)
                part = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                for lo in range(0, s.hi - s.lo, step):
                    x, y = np.searchsorted(row, [lo, lo + step])
                    rows = min(step, s.hi - s.lo - lo)
                    score = np.zeros(rows * len(ids), np.int64)
                    while x < y:  # runs of matches that map to a bounded number of items
                        many = cuts[term[x:y] + 1] - cuts[term[x:y]]
                        z = x + max(1, int(np.searchsorted(np.cumsum(many), 4 * cells, "right")))
                        many = many[: z - x]
                        to = np.repeat(cuts[term[x:z]] - np.cumsum(many) + many, many) + np.arange(many.sum())
                        np.add.at(score, np.repeat(row[x:z] - lo, many) * len(ids) + item[to], np.repeat(part[x:z], many) * repeats[to])
                        x = z
                    i = np.arange(len(score)) % len(ids)
                    ok = score >= least[i]
                    i, r = i[ok], np.flatnonzero(ok) // len(ids) + lo + s.lo
                    if len(i):
                        best = merge(best, (i, score[ok], doc[r], null[r]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[0]), pa.array([ids[i] for i in best[0].tolist()], pa.int64()),
             pa.array(best[2], mask=best[3].astype(bool)), pa.array(best[1])],
            names=["item", "item_id", "doc_id", "score"])

    return docs.mapInArrow(tidy(run), "item long, item_id long, doc_id long, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", k: int = 20, block: int = BLOCK, cells: int = CELLS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0
    of each item, equal scores by ascending id.  See the module for the score."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    found = spark.createDataFrame([], "block int, item long, item_id long, doc_id long, score long")
    for number in range(blocks):
        ids, terms, cuts, item, repeats = _block(items.where(place == number).toArrow())
        if not terms:
            continue
        index = spark.sparkContext.broadcast((uuid.uuid4().hex, terms, ids, cuts, item, repeats))
        totals = dict(_counts(docs, index).collect())  # a row for each term of the block, and two
        n_docs, n_all = totals[-1] or 0, totals[-2] or 0
        w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * totals.get(t, 0) + 1))) for t in range(len(terms))]
        weights = spark.sparkContext.broadcast((np.array(w, np.int64), n_docs, n_all))
        found = found.union(_best(docs, index, weights, k, cells).select(F.lit(number).alias("block"), "*"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = found.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("block", "item", "salt").orderBy(*order))).where(F.col("place") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order))).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
