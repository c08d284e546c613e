"""Operator 6: SentencePiece encoding and decoding with sampled segmentations.

The vocabulary file is read as it is, never trained.  A space is written as the
meta symbol; a unit is a run without white space with the space before it,
however long, any other white space stands alone, and no piece crosses a unit.
(Runs of over 64 characters are cut into units where two characters meet that
stand together in no piece of the vocabulary: no path has a piece there, so
best paths and the samples' probabilities are those of the whole run.)  A character without a piece of its own is given as its UTF-8 bytes, so
decoding gives the text back exactly.  Pieces have Zipf scores by their rank in
the vocabulary (BPE files hold ranks, not probabilities); ``sharpness`` scales
them.

Encoding takes the best path through the lattice.  Sampling draws ``k`` distinct
segmentations of the *whole text* without replacement, by Gumbel top-k: the
backward sums of the lattice are exact bounds, so a best-first (A*) search over
perturbed prefixes needs no other heuristic.  A prefix's perturbed value is the
largest of all its segmentations; following a lattice edge keeps it, and the
other edges at that node get a Gumbel value truncated at it.  The next sample
always leaves the open prefix with the largest value.  The (k + 1)-th value is
the threshold from which a sample's inclusion score 1 - exp(-exp(logp - t))
follows.  Random numbers are hashes of (seed, row key, sample, place), so a row
gives the same samples wherever and however often it runs.

One pass over the rows, no shuffle; lattices are built once for each distinct
unit a task meets, a quarter of a megabyte of text at a time, and kept up to a
bound on their edges, whatever the units' lengths.

Nulls: a null text is empty; an empty text has one segmentation of no pieces,
certain.  A null id has a key of its own.  Repeated rows give equal results.
Texts with fewer than k segmentations give them all, each with score 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.line_dedup import _Substrings
from likeness.llm.shared import ship, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, META, NO_PIECE = 0x20, 0x2581, 0x110000
UNIT = 64  # characters; longer runs are looked through for places that no piece crosses
SLICE = 1 << 18
CACHE_EDGES = 1_000_000  # a task keeps lattices up to so many, about 50 MB
ADD = 1 << 16  # characters of new units whose lattices are built at a time: their edges are many times as large
_NONE = -1


def load_vocabulary(path: str = MODEL, sharpness: float = 1.0) -> dict:
    """Pieces by hash, with Zipf scores; the ids of the 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    plain = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    plain = [i for i in plain if model.id_to_piece(i)]
    order = sorted(plain, key=lambda i: (-model.get_score(i), i))
    rank = np.empty(count)
    rank[order] = np.arange(len(order))
    points = [np.array([ord(c) for c in model.id_to_piece(i)], np.uint32) for i in plain]
    hashes = np.array([_hash(_Substrings(p), np.zeros(1, np.int64), np.array([len(p)]))[0] for p in points], np.uint64)
    begins = np.unique(np.concatenate([
        _hash(_Substrings(p), np.zeros(len(p) - 1, np.int64), np.arange(1, len(p))) for p in points if len(p) > 1]))
    pairs = np.unique(np.concatenate([_pairs(p[:-1], p[1:]) for p in points]))
    scores = -np.log(rank[plain] + 10)
    scores -= np.log(np.exp(scores).sum())
    o = np.argsort(hashes)
    bytes_ = np.full(256, _NONE, np.int32)
    for i in range(count):
        if model.is_byte(i):
            bytes_[int(model.id_to_piece(i)[3:5], 16)] = i
    return {
        "hash": hashes[o], "begins": begins, "pairs": pairs, "id": np.array(plain, np.int32)[o], "score": scores[o] * sharpness, "bytes": bytes_,
        "byte_score": (scores.min() - 1) * sharpness, "longest": max(map(len, points)),
        "texts": {i: model.id_to_piece(i) for i in plain},
    }


def _hash(sub: _Substrings, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    return W.mix(sub(at, size) + size.astype(np.uint64))


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for two code points."""
    return a.astype(np.int64) << 21 | b.astype(np.int64)


def _unit_keys(sub: _Substrings, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of units; those of long ones are mixed from parts, since sums over
    a thousand places and more collide for some structured strings."""
    key = _hash(sub, at, size)
    long = np.flatnonzero(size > UNIT)
    if len(long):
        parts = -(-size[long] // UNIT)
        number = _ranges(np.zeros(len(long), np.int64), parts)
        width = np.minimum(np.repeat(size[long], parts) - UNIT * number, UNIT)
        part = W.mix(_hash(sub, np.repeat(at[long], parts) + UNIT * number, width) ^ W.mix(number.astype(np.uint64)))
        key[long] = W.mix(np.add.reduceat(part, np.cumsum(parts) - parts) + size[long].astype(np.uint64))
    return key


def decode(ids, vocabulary: dict) -> str:
    """The text of a sequence of piece ids."""
    byte = {int(i): b for b, i in enumerate(vocabulary["bytes"]) if i >= 0}
    out = b"".join(
        bytes([byte[int(i)]]) if int(i) in byte else vocabulary["texts"][int(i)].replace(chr(META), " ").encode() for i in ids)
    return out.decode()


def _rank_first(group: np.ndarray) -> np.ndarray:
    """Where a new group begins in sorted groups."""
    return np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., first[1], ... with size[i] numbers each."""
    total = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(first - total[:-1], size) + np.arange(total[-1])


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((W.mix(key) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """Lattices of distinct units: nodes with their edges, longest piece first."""

    def __init__(self, vocabulary: dict, cache_edges: int = CACHE_EDGES):
        self.v, self.cache_edges = vocabulary, cache_edges
        # by the low bits of a hash: may it be a piece, may it begin a longer one
        self.near, self.begins = np.zeros(1 << 20, bool), np.zeros(1 << 20, bool)
        self.near[(vocabulary["hash"] & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.begins[(vocabulary["begins"] & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of units; their start nodes and best paths
        self.start = np.zeros(0, np.int64)
        self.best_first, self.best_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.nodes, self.arcs, self.steps = 1, 0, 0  # in use; node 0 is the end of all units
        self.first, self.edges = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)  # by node
        self.source, self.to, self.ids = (np.zeros(1 << 16, np.int32) for _ in range(3))  # by edge; ids: or -1 - code point
        self.q, self.upto, self.pieces = np.zeros(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16, np.int8)
        self.best = np.zeros(1 << 16, np.int32)  # edges of best paths

    def _store(self, at: int, **columns) -> int:
        """Write columns from place ``at`` on, with room to grow."""
        end = at
        for name, x in columns.items():
            old, end = getattr(self, name), at + len(x)
            if end > len(old):
                new = np.zeros(max(end, len(old) + len(old) // 2), old.dtype)
                new[:at] = old[:at]
                setattr(self, name, new)
            getattr(self, name)[at:end] = x
        return end

    def units(self, keys: np.ndarray, points: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of units (place and size in points), new ones added."""
        distinct, one, number = np.unique(keys, return_index=True, return_inverse=True)
        if self.arcs > self.cache_edges:
            self.clear()
        place = np.searchsorted(self.keys, distinct)
        place[place == len(self.keys)] = 0
        new = self.keys[place] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if new.any():
            fresh, one = distinct[new], one[new]
            upto = np.cumsum(size[one])
            for some in np.split(np.arange(len(one)), np.flatnonzero(np.diff(upto // ADD)) + 1):
                u = one[some]
                self._add(fresh[some], points[_ranges(at[u], size[u])], np.concatenate([[0], np.cumsum(size[u])]))
        return np.searchsorted(self.keys, distinct)[number]

    def _add(self, keys, points, cuts):
        v, units = self.v, len(keys)
        sub = _Substrings(points)
        left = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(len(points))  # characters to the unit's end
        at, size, which = [], [], []
        p = np.arange(len(points))
        for n in range(1, v["longest"] + 1):
            p = p[left[p] >= n] if n > 1 else p
            if not len(p):
                break
            h = _hash(sub, p, np.full(len(p), n))
            low = (h & np.uint64(len(self.near) - 1)).astype(np.int64)
            some = np.flatnonzero(self.near[low])
            found = np.minimum(np.searchsorted(v["hash"], h[some]), len(v["hash"]) - 1)
            ok = v["hash"][found] == h[some]
            hit = p[some[ok]]
            at.append(hit)
            size.append(np.full(len(hit), n))
            which.append(found[ok])
            if n == 1:
                bare = np.ones(len(points), bool)
                bare[hit] = False
                bare = np.flatnonzero(bare)
                at.append(bare)
                size.append(np.ones(len(bare), np.int64))
                which.append(np.full(len(bare), _NONE))
            p = p[self.begins[low]]  # where a longer piece may begin like this
        # nodes are the characters, those nearest the end of their unit first, after node 0: the end
        order = np.argsort(left * len(points) + np.arange(len(points)))
        rank = np.empty(len(points) + 1, np.int64)
        rank[order] = np.arange(1, len(points) + 1)
        at, size, which = np.concatenate(at), np.concatenate(size), np.concatenate(which)
        o = np.argsort(rank[at] * 64 + 63 - size)  # longest pieces first
        at, size, which = at[o], size[o], which[o]
        bare = which == _NONE
        chars = np.where(points[at[bare]] == NO_PIECE, META, points[at[bare]]).astype(np.int64)
        ids = v["id"][which].copy()
        ids[bare] = -1 - chars
        width = np.ones(len(at), np.int8)
        width[bare] = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)  # bytes
        score = np.where(bare, v["byte_score"] * width, v["score"][which])
        node, to = rank[at], np.where(size == left[at], 0, rank[np.minimum(at + size, len(points) - 1)])
        begin = _rank_first(node)
        total, best = np.zeros(len(points) + 1), np.zeros(len(points) + 1)
        steps = np.searchsorted(left[order], np.arange(1, int(left.max()) + 2))  # nodes by characters left
        for i, j in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            if i < j:
                a, b = begin[i], begin[j] if j < len(begin) else len(node)
                total[i + 1 : j + 1] = np.logaddexp.reduceat(score[a:b] + total[to[a:b]], begin[i:j] - a)
                best[i + 1 : j + 1] = np.maximum.reduceat(score[a:b] + best[to[a:b]], begin[i:j] - a)
        q = np.exp(score + total[to] - total[node])
        run = np.cumsum(q)
        edges = np.diff(np.append(begin, len(node)))
        upto = run - np.repeat((run - q)[begin], edges)
        upto[begin + edges - 1] = 2.0  # the last edge takes what rounding leaves
        pick = np.flatnonzero(score + best[to] >= best[node] - 1e-12)
        chosen = np.zeros(len(points) + 1, np.int64)
        chosen[1:] = pick[_rank_first(node[pick])]
        # best paths of the units, step by step
        here, owner, taken = rank[cuts[:-1]], np.arange(units), []
        while len(owner):
            e = chosen[here]
            taken.append((owner, e))
            here = to[e]
            on = here > 0
            here, owner = here[on], owner[on]
        owner, path = (np.concatenate(x) for x in zip(*taken, strict=True))
        o = np.argsort(owner, kind="stable")
        length = np.bincount(owner, minlength=units)
        # append, and keep the keys sorted
        shift = self.nodes - 1
        start = np.concatenate([self.start, rank[cuts[:-1]] + shift])
        best_first = np.concatenate([self.best_first, np.cumsum(length) - length + self.steps])
        best_size = np.concatenate([self.best_size, length])
        keys = np.concatenate([self.keys, keys])
        by = np.argsort(keys)
        self.keys, self.start, self.best_first, self.best_size = keys[by], start[by], best_first[by], best_size[by]
        self.steps = self._store(self.steps, best=path[o] + self.arcs)
        self.nodes = self._store(self.nodes, first=begin + self.arcs, edges=edges)
        self.arcs = self._store(
            self.arcs, source=node + shift, to=np.where(to > 0, to + shift, 0), q=np.minimum(q, 1.0), upto=upto, ids=ids, pieces=width)

    def walk(self, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A random path to the end from each node: (steps of each, their first places, edges in order)."""
        item, taken = np.flatnonzero(self.edges[node] > 0), []
        here, step = node[item], 0
        while len(item):
            u = _uniform(key[item] + np.uint64(step))
            e = self.first[here].astype(np.int64)
            todo = np.flatnonzero(self.upto[e] <= u)
            while len(todo):
                e[todo] += 1
                todo = todo[self.upto[e[todo]] <= u[todo]]
            taken.append((item, e))
            here, step = self.to[e], step + 1
            on = self.edges[here] > 0
            here, item = here[on], item[on]
        count = np.zeros(len(node), np.int64)
        for i, _ in taken:
            count[i] += 1
        first = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int64)
        for step, (i, e) in enumerate(taken):
            out[first[i] + step] = e
        return count, first, out

    def id_lists(self, edges: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of paths and the cuts between the paths."""
        ids = self.ids[edges]
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids, cuts
        width = self.pieces[edges].astype(np.int64)
        size = np.concatenate([[0], np.cumsum(width)])
        out = np.repeat(ids, width)
        kinds, kind = np.unique(-1 - ids[bare], return_inverse=True)
        table = np.full((len(kinds), 4), _NONE, np.int32)
        for i, c in enumerate(kinds.tolist()):
            raw = chr(c).encode()
            table[i, : len(raw)] = self.v["bytes"][list(raw)]
        byte_ids = table[kind].reshape(-1)
        out[_ranges(size[bare], width[bare])] = byte_ids[byte_ids != _NONE]
        return out, size[cuts]


class _Path:
    """One sample of every row that has one: edges in order, rows by cuts."""

    def __init__(self, rows, cuts, edges, unit, used, value):
        self.rows, self.cuts, self.edges, self.unit, self.used, self.value = rows, cuts, edges, unit, used, value
        self.gumbel = None

    def owner(self):
        return np.repeat(np.arange(len(self.rows)), np.diff(self.cuts))


def _open(lat: Lattices, p: _Path, key: np.ndarray, since: np.ndarray) -> None:
    """Gumbel values of the prefixes that leave path ``p`` at each step from
    ``since`` on: truncated at the value of the path itself."""
    own, q = p.owner(), lat.q[p.edges]
    logq = np.log(q)
    run = np.cumsum(logq)
    before = run - logq
    before -= np.repeat(before[np.minimum(p.cuts[:-1], max(len(run) - 1, 0))], np.diff(p.cuts)) if len(run) else before
    rest = 1.0 - q
    more = np.flatnonzero(np.bitwise_count(p.used) > 1)  # several edges gone already
    for j in more.tolist():
        e0 = int(lat.first[lat.source[p.edges[j]]])
        n = int(lat.edges[lat.source[p.edges[j]]])
        rest[j] = sum(lat.q[e0 + i] for i in range(n) if not int(p.used[j]) >> i & 1)
    # a node all of whose edges are used has nothing left, whatever rounding says
    full = np.bitwise_count(p.used) >= lat.edges[lat.source[p.edges]]
    place = np.arange(len(own)) - p.cuts[own]
    with np.errstate(divide="ignore"):
        phi = np.where(place >= since[own], before + np.log(np.where(full, 0.0, np.maximum(rest, 0.0))), -np.inf)
    # of less than e^-45 of the row's likeliest open prefix no 53-bit random number tells
    most = np.maximum.reduceat(np.append(phi, -np.inf), p.cuts[:-1]) if len(p.rows) else phi
    near = np.flatnonzero((phi > -np.inf) & (phi >= most[own] - 45))
    noise = np.log(-np.log(_uniform(key[p.rows[own[near]]] ^ W.mix(place[near].astype(np.uint64) + np.uint64(1 << 40)))))
    p.gumbel = np.full(len(own), -np.inf)
    p.gumbel[near] = -np.logaddexp(-p.value[own[near]], noise - phi[near])
    p.logp = np.add.reduceat(np.append(logq, 0.0), p.cuts[:-1]) * (np.diff(p.cuts) > 0) if len(p.rows) else np.zeros(0)


def _largest(p: _Path) -> np.ndarray:
    return np.maximum.reduceat(np.append(p.gumbel, -np.inf), p.cuts[:-1]) if len(p.rows) else np.zeros(0)


def sample(lat: Lattices, unit: np.ndarray, first: np.ndarray, key: np.ndarray, k: int) -> tuple[list[_Path], np.ndarray]:
    """``k`` distinct segmentations of every row (units ``first[i]`` to
    ``first[i + 1]``), largest perturbed value first, and the next value."""
    rows = len(first) - 1
    own = np.repeat(np.arange(rows), np.diff(first))
    some = np.flatnonzero(np.diff(first) > 0)

    def keys(s):
        return W.mix(key + np.uint64((s + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))

    def of_units(s, u):
        return W.mix(keys(s)[own[u]] + (u - first[own[u]]).astype(np.uint64))

    every = np.arange(len(unit))
    count, at, edges = lat.walk(lat.start[unit], of_units(0, every))
    cuts = np.append(at, len(edges))[first]
    cuts = np.append(cuts[some], len(edges))
    top = -np.log(-np.log(_uniform(keys(0))))
    local = (edges - lat.first[lat.source[edges]]).astype(np.uint64)
    paths = [_Path(some, cuts, edges, np.repeat(every, count), np.uint64(1) << local, top[some])]
    _open(lat, paths[0], keys(0), np.zeros(len(some), np.int64))
    for s in range(1, k):
        best = np.full((len(paths), rows), -np.inf)
        for i, p in enumerate(paths):
            best[i, p.rows] = _largest(p)
        which, value = best.argmax(0), best.max(0)
        parts = []
        for i, p in enumerate(paths):
            mine = which[p.rows] == i
            mine &= value[p.rows] > -np.inf
            o = p.owner()
            hit = np.flatnonzero(mine[o] & (p.gumbel == value[p.rows][o]))
            hit = hit[_rank_first(o[hit])]
            parts.append((p.rows[o[hit]], np.full(len(hit), i), hit))
        row, parent, j = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(row):
            break
        o = np.argsort(row)
        row, parent, j = row[o], parent[o], j[o]
        n = len(row)
        edge, unit_j, used, begin = (np.zeros(n, t) for t in (np.int64, np.int64, np.uint64, np.int64))
        for i, p in enumerate(paths):
            m = parent == i
            edge[m], unit_j[m], used[m] = p.edges[j[m]], p.unit[j[m]], p.used[j[m]]
            begin[m] = p.cuts[np.searchsorted(p.rows, row[m])]
            p.gumbel[j[m]] = -np.inf
        # another edge at the node, among those not used
        node = lat.source[edge]
        wide = int(lat.edges[node].max())
        grid = lat.first[node][:, None] + np.arange(wide)
        free = (np.arange(wide) < lat.edges[node][:, None]) & ((used[:, None] >> np.arange(wide, dtype=np.uint64)) & np.uint64(1) == 0)
        weight = np.where(free, lat.q[np.minimum(grid, len(lat.q) - 1)], 0.0)
        run = weight.cumsum(1)
        u = _uniform(keys(s)[row] ^ np.uint64(0x2545F4914F6CDD1D)) * run[:, -1]
        pick = np.minimum((run <= u[:, None]).sum(1), wide - 1)
        taken = lat.first[node] + pick
        # and on at random: the rest of that unit, then the later units
        items = first[row + 1] - unit_j
        u = _ranges(unit_j, items)
        start = lat.start[unit[u]]
        head = np.cumsum(items) - items
        start[head] = lat.to[taken]
        count, at, tail = lat.walk(start, of_units(s, u))
        before = j - begin
        after = np.add.reduceat(count, head)
        cuts = np.concatenate([[0], np.cumsum(before + 1 + after)])
        edges, units, gone = np.zeros(cuts[-1], np.int64), np.zeros(cuts[-1], np.int64), np.zeros(cuts[-1], np.uint64)
        for i, p in enumerate(paths):
            m = np.flatnonzero(parent == i)
            src, dst = _ranges(begin[m], before[m]), _ranges(cuts[:-1][m], before[m])
            edges[dst], units[dst] = p.edges[src], p.unit[src]
        mid = cuts[:-1] + before
        dst = _ranges(mid + 1, after)
        edges[mid], edges[dst] = taken, tail
        units[mid], units[dst] = unit_j, np.repeat(u, count)
        gone[dst] = np.uint64(1) << (tail - lat.first[lat.source[tail]]).astype(np.uint64)
        gone[mid] = used | np.uint64(1) << pick.astype(np.uint64)
        p = _Path(row, cuts, edges, units, gone, value[row])
        _open(lat, p, keys(s), before)
        paths.append(p)
    rest = np.full(rows, -np.inf)
    for p in paths:
        rest[p.rows] = np.maximum(rest[p.rows], _largest(p))
    return paths, rest


def units_of(points: np.ndarray, shown: np.ndarray, cuts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, size, first unit of each row) of the units of rows of code points;
    ``shown``: the points as pieces have them, ``pairs``: those that meet in pieces."""
    n = len(points)
    space = (points == SPACE) | ((points >= 0x09) & (points <= 0x0D))
    new = space.copy()
    new[1:] |= space[:-1] & (points[:-1] != SPACE)
    head = cuts[:-1][cuts[:-1] < cuts[1:]]
    new[head] = True
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    long = size > UNIT
    if long.any():
        inside = _ranges(at[long] + 1, size[long] - 1)
        met = _pairs(shown[inside - 1], shown[inside])
        new[inside[pairs[np.minimum(np.searchsorted(pairs, met), len(pairs) - 1)] != met]] = True
        at = np.flatnonzero(new)
    return at, np.diff(np.append(at, n)), np.searchsorted(at, cuts)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, seed: int = 42, model: str = MODEL,
    sharpness: float = 1.0, keep_ids: bool = True, cache_edges: int = CACHE_EDGES, slice_bytes: int = SLICE,
) -> DataFrame:
    """Of every row: doc_id, n_pieces (best path), exact (whether its pieces give
    the text back), and by sample n_sampled, logp, perturbed, inclusion and
    digest (a hash of the piece ids); with keep_ids also pieces (best path) and
    sampled, the piece ids.

    ``cache_edges`` (kept lattices) and ``slice_bytes`` (texts taken at a time)
    trade memory for speed and change no result: a Python worker of the defaults
    takes some 310 MB, one of 1,500,000 some 340 MB."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(load_vocabulary(model, sharpness))

    def lists(values, cuts, kind):
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))

    def run(batches):
        lat = Lattices(shared.value, cache_edges)
        for b in batches:
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = W.mix(b.column(0).fill_null(0).to_numpy().astype(np.uint64)) ^ np.where(known, np.uint64(0), np.uint64(0x5851F42D4C957F2D))
            for s in W.slices(b.column(1), slice_bytes):
                yield _encode_slice(lat, s, b.column(0).slice(s.lo, s.hi - s.lo), W.mix(ids[s.lo : s.hi] + np.uint64(seed)), k, keep_ids, lists)

    schema = "doc_id long, n_pieces long, exact boolean, n_sampled array<long>, logp array<double>, perturbed array<double>, inclusion array<double>, digest array<long>"
    if keep_ids:
        schema += ", pieces array<int>, sampled array<array<int>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def _encode_slice(lat, s, id_column, key, k, keep_ids, lists) -> pa.RecordBatch:
    rows = s.hi - s.lo
    points = np.frombuffer(s.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])  # code points before each byte
    cuts = starts[s.offsets]
    shown = np.where(points == META, NO_PIECE, np.where(points == SPACE, META, points)).astype(np.uint32)
    at, size, first = units_of(points, shown, cuts, lat.v["pairs"])
    unit = lat.units(_unit_keys(_Substrings(shown), at, size), shown, at, size) if len(at) else np.zeros(0, np.int64)

    best = lat.best[_ranges(lat.best_first[unit], lat.best_size[unit])] if len(unit) else np.zeros(0, np.int64)
    steps = np.concatenate([[0], np.cumsum(lat.best_size[unit])]) if len(unit) else np.zeros(1, np.int64)
    best_ids, best_cuts = lat.id_lists(best, steps[first])
    exact = _gives_back(lat.v, best_ids, best_cuts, s)

    paths, rest = sample(lat, unit, first, key, k) if len(unit) else ([], np.full(rows, -np.inf))
    empty = np.diff(first) == 0
    columns = {c: [] for c in ("row", "n", "logp", "value", "digest", "ids")}
    empties = np.flatnonzero(empty)
    columns["row"].append(empties)
    columns["n"].append(np.zeros(len(empties), np.int64))
    columns["logp"].append(np.zeros(len(empties)))
    columns["value"].append(-np.log(-np.log(_uniform(key[empties]))))
    columns["digest"].append(np.zeros(len(empties), np.int64))
    sampled = [(np.zeros(0, np.int32), np.zeros(len(empties) + 1, np.int64))]
    for p in paths:
        ids, id_cuts = lat.id_lists(p.edges, p.cuts)
        place = (np.arange(len(ids)) - np.repeat(id_cuts[:-1], np.diff(id_cuts))).astype(np.uint64)
        terms = W.mix(W.mix(ids.astype(np.uint64)) + place)
        columns["row"].append(p.rows)
        columns["n"].append(np.diff(id_cuts))
        columns["logp"].append(p.logp)
        columns["value"].append(p.value)
        columns["digest"].append(np.add.reduceat(terms, id_cuts[:-1]).view(np.int64) if len(p.rows) else np.zeros(0, np.int64))
        sampled.append((ids, id_cuts))
    row = np.concatenate(columns["row"])
    o = np.argsort(row, kind="stable")  # samples of a row in their order
    sample_cuts = np.searchsorted(row[o], np.arange(rows + 1))
    n, logp, value, digest = (np.concatenate(columns[c])[o] for c in ("n", "logp", "value", "digest"))
    with np.errstate(over="ignore"):
        inclusion = -np.expm1(-np.exp(logp - rest[row[o]]))
    out = [
        id_column, pa.array(np.diff(best_cuts)), pa.array(exact), lists(n, sample_cuts, pa.int64()), lists(logp, sample_cuts, pa.float64()),
        lists(value, sample_cuts, pa.float64()), lists(inclusion, sample_cuts, pa.float64()), lists(digest, sample_cuts, pa.int64())]
    names = ["doc_id", "n_pieces", "exact", "n_sampled", "logp", "perturbed", "inclusion", "digest"]
    if keep_ids:
        flat = np.concatenate([x for x, _ in sampled])
        base = np.cumsum([0, *(len(x) for x, _ in sampled[:-1])])
        begin = np.concatenate([c[:-1] + b for (_, c), b in zip(sampled, base, strict=True)])[o]
        length = np.concatenate([np.diff(c) for _, c in sampled])[o]
        inner = lists(flat[_ranges(begin, length)], np.concatenate([[0], np.cumsum(length)]), pa.int32())
        out += [lists(best_ids, best_cuts, pa.int32()), pa.ListArray.from_arrays(pa.array(sample_cuts.astype(np.int32)), inner)]
        names += ["pieces", "sampled"]
    return pa.RecordBatch.from_arrays(out, names=names)


def _piece_bytes(v: dict) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that each id decodes to, one after the other, and their cuts."""
    if "raw" not in v:
        texts = {i: t.replace(chr(META), " ").encode() for i, t in v["texts"].items()}
        texts |= {int(i): bytes([b]) for b, i in enumerate(v["bytes"]) if i >= 0}
        parts = [texts.get(i, b"") for i in range(max(texts) + 1)]
        v["raw"] = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return v["raw"]


def _gives_back(v: dict, ids: np.ndarray, cuts: np.ndarray, s: W.Slice) -> np.ndarray:
    """Whether the decoded ids of each row are the bytes of its text."""
    raw, at = _piece_bytes(v)
    size = at[ids + 1] - at[ids]
    text = raw[_ranges(at[ids], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[cuts]
    if len(text) == len(s.data) and (ends == s.offsets).all():
        wrong = np.concatenate([[0], np.cumsum(text != s.data)])
        return wrong[ends[1:]] == wrong[ends[:-1]]
    return np.array([bytes(text[a:b]) == bytes(s.data[c:d]) for a, b, c, d in zip(ends[:-1], ends[1:], s.offsets[:-1], s.offsets[1:], strict=True)], bool)
