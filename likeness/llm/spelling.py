"""Operator 12: spelling variants by finite-state composition.

Words are near if they differ by exactly one inserted, deleted or replaced code
point: the pairs that the composition A o T o A accepts, of the acceptor A of
the vocabulary and the transducer T of one edit.  Until T has made its edit both
sides read the same, so the composed machine enters the part where an edit can
still fall between two cuts only after one common prefix, and must leave it by
one common tail.  These are its *initial-state partitions*: (length, segment,
prefix, tail).  A word of n letters takes part for length n (as it is, or
replaced) and for length n - 1 (as the longer side of a deletion), once for
each segment of the length -- halves at first.  Every pair belongs to the one
segment that holds the end of its common prefix, so no pair is found twice and
none is missed.

Inside a partition the middles form a minimised acceptor (equal right languages
are one state, with the number of words below each), and the composition with
the edit and itself is walked on pairs of states: equal states accept all that
is below at once.  Partitions are dealt to tasks by a shuffle.  One of more than
``most`` words is cut into the partitions of half its segment, again and again;
at a segment of one letter all words of a partition differ in just that letter.
So no task holds more than ``most`` words of a partition unless they are as many
letters, and nothing is capped.

A word's *form* is its near word of largest count (ties: smallest in code-point
order), if that count is at least ``ratio`` times its own; forms are followed to
the last by pointer doubling, as counts rise along them.

Nulls: a null or empty text has no words; a null id is written as an empty
string where ids are read.  Repeated rows count as often as they stand there.
Words may be of any length.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.shared import materialize, partitions, ship, tidy

MOST = 20_000
FLUSH = 1 << 16
_KEY = ["length", "lo", "hi", "prefix", "tail"]


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = "a-zÀ-ÿ",
             min_length: int = 6, min_count: int = 5, drop_one_in: int = 199) -> DataFrame:
    """(word, n): runs of letters (A-Z lower-cased) of all texts, at least
    ``min_length`` long and ``min_count`` times there.  Where crc32 of
    ``id:run`` is a multiple of ``drop_one_in``, the letter at crc32 % length is
    left out first: planted misspellings (0: none)."""
    lowered = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # a run shorter than min_length cannot grow, so the pattern leaves it out at once
    runs = F.regexp_extract_all(lowered, F.lit(f"([{letters}]{{{min_length},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    if drop_one_in:
        rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        cut = F.expr("concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
        rows = rows.withColumn("run", F.when(F.col("h") % drop_one_in == 0, cut).otherwise(F.col("run")))
        rows = rows.where(F.length("run") >= min_length)
    return rows.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """The minimised acceptor of sorted distinct strings; states are numbered
    children first, the last one is initial."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = []  # letter -> state, in order of the letters
        self.final: list[bool] = []
        self.below: list[int] = []  # words of the right language
        self.skip: list[dict[str, int]] = []  # of these, those before a letter's
        known: dict[tuple, int] = {}
        path: list[list] = [[{}, False]]  # (edges so far, final) along the last word
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth:
                edges, final = path.pop()
                key = (final, tuple(edges.items()))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.edges)
                    n, skip = int(final), {}
                    for letter, to in edges.items():
                        skip[letter] = n
                        n += self.below[to]
                    self.edges.append(edges)
                    self.final.append(final)
                    self.below.append(n)
                    self.skip.append(skip)
                if path:
                    path[-1][0][last[len(path) - 1]] = state

        for w in words:
            same = 0
            while same < len(last) and same < len(w) and last[same] == w[same]:
                same += 1
            close(same + 1)
            path.extend([{}, False] for _ in range(len(w) - same))
            path[-1][1] = True
            last = w
        close(0)
        self.start = len(self.edges) - 1

    def near(self) -> list[tuple[int, int, int]]:
        """(i, j, depth) of the words i, j (by their rank) that one edit turns into
        each other, once each; depth: length of their common prefix.  For a
        deletion i is the longer word."""
        edges, final, below, skip = self.edges, self.final, self.below, self.skip
        out = []
        before = [(self.start, 0, 0)]  # states where no edit was made: both sides the same
        while before:
            p, at, depth = before.pop()
            here, jump = edges[p], skip[p]
            after = []  # states of the two sides once the edit is made
            heads = list(here.items())
            for x, (a, s) in enumerate(heads):
                before.append((s, at + jump[a], depth + 1))
                for b, t in heads[x + 1 :]:  # replaced
                    after.append((s, t, at + jump[a], at + jump[b]))
                # deleted on the left; the right side's next letter is another one, or there is none
                if final[s] and final[p]:
                    out.append((at + jump[a], at, depth))
                for b, t in edges[s].items():
                    if b != a and b in here:
                        after.append((t, here[b], at + jump[a] + skip[s][b], at + jump[b]))
            while after:
                s, t, i, j = after.pop()
                if s == t:
                    out.extend((i + n, j + n, depth) for n in range(below[s]))
                    continue
                if final[s] and final[t]:
                    out.append((i, j, depth))
                other = edges[t]
                for b, u in edges[s].items():
                    if b in other:
                        after.append((u, other[b], i + skip[s][b], j + skip[t][b]))
        return out


def _segments(words: DataFrame, min_length: int) -> DataFrame:
    """Each word's rows (word, n, long, length, lo, hi): the halves of each length
    that it takes part for."""
    roles = F.explode(F.array(
        F.struct(F.length("word").alias("length"), F.lit(False).alias("long")),
        F.struct((F.length("word") - 1).alias("length"), F.lit(True).alias("long"))))
    rows = words.select("word", "n", roles.alias("role")).select("word", "n", "role.*").where(F.col("length") >= min_length)
    half = F.expr("length div 2").cast("int")
    return rows.withColumn("part", F.explode(F.array(
        F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("length").alias("hi"))))).select(
        "word", "n", "long", "length", "part.*")


def _keyed(rows: DataFrame) -> DataFrame:
    extra = F.col("long").cast("int")
    return rows.withColumn("prefix", F.expr("left(word, lo)")).withColumn(
        "tail", F.substring(F.col("word"), F.col("hi") + extra + 1, F.length("word")))


def _accepted(rows: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of the near words in each partition, both ways."""

    def whole(batches):
        """Tables of whole partitions: batches cut where the key changes."""
        rest = None
        for b in batches:
            t = b if rest is None else pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
            at = starts(t)
            if len(at) > 1:
                yield t.slice(0, int(at[-1]))
                t = t.slice(int(at[-1]))
            rest = t if len(t) else None
        if rest is not None:
            yield rest

    def starts(t):
        """Rows where another key begins."""
        if len(t) < 2:
            return np.zeros(min(len(t), 1), np.int64)
        new = np.zeros(len(t) - 1, bool)
        for c in _KEY:
            col = t.column(t.schema.get_field_index(c))
            new |= pc.not_equal(col.slice(1), col.slice(0, len(t) - 1)).to_numpy(zero_copy_only=False)
        return np.append(0, np.flatnonzero(new) + 1)

    def run(batches):
        out = [], [], [], []

        def flush():
            b = pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                names=["word", "n", "near", "near_n"])
            for c in out:
                c.clear()
            return b

        for t in whole(batches):
            col = {f: t.column(i) for i, f in enumerate(t.schema.names)}
            at = starts(t)
            size = np.diff(np.append(at, len(t)))
            long = col["long"].to_numpy(zero_copy_only=False)
            short = np.add.reduceat(~long, at, dtype=np.int64)
            for g in np.flatnonzero((short > 0) & (size > 1)).tolist():
                lo, n = int(at[g]), int(size[g])
                word, count = col["word"].slice(lo, n).to_pylist(), col["n"].slice(lo, n).to_pylist()
                a, b, length = (col[c][lo].as_py() for c in ("lo", "hi", "length"))
                mids = sorted((w[a : b + len(w) - length], i) for i, w in enumerate(word))
                for i, j, depth in Acceptor([m for m, _ in mids]).near():
                    i, j = mids[i][1], mids[j][1]
                    u, v = word[i], word[j]
                    # two longer words belong to the next length, a later edit to a later segment
                    if (len(u) == length or len(v) == length) and (depth < b - a or b == length):
                        for c, x in zip(out, ((u, v), (count[i], count[j]), (v, u), (count[j], count[i])), strict=True):
                            c.extend(x)
                if len(out[0]) >= FLUSH:
                    yield flush()
        if out[0]:
            yield flush()

    spark = rows.sparkSession
    return (
        rows.repartition(partitions(spark), *_KEY).sortWithinPartitions(*_KEY)
        .select("word", "n", "long", *_KEY).mapInArrow(tidy(run), "word string, n long, near string, near_n long")
    )


def near_words(words: DataFrame, min_length: int = 6, most: int = MOST) -> DataFrame:
    """(word, n, near, near_n): each two of ``words`` (word, n; words distinct and
    of at least ``min_length``) that one edit turns into each other, both ways."""
    ship(words.sparkSession)
    rows, found = _keyed(_segments(words, min_length)), None
    while True:
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("m")).where((F.col("m") > most) & (F.col("hi") - F.col("lo") > 1))
        big = materialize(sizes.drop("m"))
        if big.isEmpty():
            part = _accepted(rows)
            return part if found is None else found.union(part)
        part = _accepted(rows.join(big, _KEY, "left_anti"))
        found = part if found is None else found.union(part)
        mid = F.expr("(lo + hi) div 2").cast("int")
        halves = F.explode(F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi")))
        rows = materialize(rows.join(big, _KEY, "left_semi").withColumn("part", halves).select("word", "n", "long", "length", "part.*"))
        rows = _keyed(rows)


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5,
    ratio: int = 5, drop_one_in: int = 199, most: int = MOST,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.  See the module."""
    words = materialize(words_of(docs, id_col, text_col, min_length=min_length, min_count=min_count, drop_one_in=drop_one_in))
    # the largest count comes first, then the smallest word
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = materialize(near_words(words, min_length, most).groupBy("word").agg(
        F.first("n").alias("n"), F.count("*").alias("n_near"), best).select(
        "word", "n_near", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        (-F.col("best.less")).alias("best_n")))
    steps = materialize(near.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        further = materialize(steps.join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        if further.where("moved").isEmpty():
            break
        steps = further.drop("moved")
    return (
        words.join(near, "word", "left").join(steps, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
    )
