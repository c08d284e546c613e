"""Operator 3: personal data by bootstrapped contextual extraction.

Four base patterns (email, ip, card, phone) give the seed entities.  Tokens
with a digit or an @, as every base match has, are the instances; the word to the left of a token and the token's
shape (runs of digits, small and capital letters) make a lexical pattern.
Instances that overlap a seed start with score 1, and pattern and instance
scores are then refined in turn on the graph of all documents:

* a pattern's score for a kind: the sum of its instances' scores over the
  number of its instances plus one;
* an instance's score: its seed score or that of its best pattern.

Patterns of at least ``min_score`` and ``min_seeds`` distinct seed instances
discover further tokens, reported as kind_like.  The patterns are a written
table of any size, with which the tokens that overlap no seed are joined.

DataFrame functions only; texts are read once and never shuffled, only their
spans and tokens, which are written, and of these only the rows that may have a
discovered token.  Nulls: a null text is
empty; rows with a null id and repeated rows get their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.shared import materialize, maybe_in, salted_join

KINDS = ["email", "ip", "card", "phone"]
# The contract's patterns for Java: possessive where nothing can be given back,
# and starting only at the start of a run (or after a match), so that neither
# the stack nor the time grows with long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*"
_DIGITS = r"regexp_replace(x.t, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + cast(case when i % 2 = 1
    then cast(substring({_DIGITS}, -i, 1) as int) else (cast(substring({_DIGITS}, -i, 1) as int) * 2) % 10
    + (cast(substring({_DIGITS}, -i, 1) as int) * 2) div 10 end as int)) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": r"forall(split(x.t, '\\.'), p -> coalesce(try_cast(p as int) <= 255, false))",
    "card": f"length({_DIGITS}) between 14 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 10 and 15",
}


CHUNK = 64  # matches gathered at a time: appending to a list copies it, so none grows with the text


def _spans(found: str, pieces: str) -> tuple[str, str, str]:
    """SQL for the lengths of matches (with the piece before), where chunks of them
    begin (columns _n and _s), and their places (s, e, t, left) in chunks."""
    sizes = f"transform({found}, (x, i) -> length({pieces}[i]) + length(x))"
    starts = f"""aggregate(sequence(0, size({found}) - 1, {CHUNK}), named_struct('at', 0, 'out', cast(array() as array<struct<i:int,at:int>>)),
        (a, c) -> named_struct('at', a.at + aggregate(slice(_n, c + 1, {CHUNK}), 0, (x, y) -> x + y),
            'out', concat(a.out, array(named_struct('i', c, 'at', a.at)))), a -> a.out)"""
    chunk = f"""aggregate(sequence(c.i, least(c.i + {CHUNK}, size({found})) - 1),
        named_struct('at', c.at, 'out', cast(array() as array<struct<s:int,e:int,t:string,left:string>>)),
        (a, i) -> named_struct('at', a.at + _n[i], 'out', concat(a.out, array(named_struct(
            's', a.at + length({pieces}[i]), 'e', a.at + _n[i], 't', {found}[i], 'left', right({pieces}[i], 64))))),
        a -> a.out)"""
    return sizes, starts, f"transform(_s, c -> {chunk})"


def _find(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """With a column of the places of ``pattern`` in text, in chunks."""
    some = F.size("_m") > 0
    sizes, starts, chunks = _spans("_m", "_p")
    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn("_p", F.when(some, F.split("text", pattern, -1)))
    df = df.withColumn("_n", F.when(some, F.expr(sizes))).withColumn("_s", F.when(some, F.expr(starts)))
    none = F.expr("cast(array() as array<array<struct<s:int,e:int,t:string,left:string>>>)")
    return df.withColumn(name, F.when(some, F.expr(chunks)).otherwise(none)).drop("_m", "_p", "_n", "_s")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base: sorted spans (s, k, e), tokens) of every row."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for kind in KINDS:
        df = _find(df, kind, PATTERNS[kind])
    df = _find(df, "tokens", TOKEN)
    each = [
        F.expr(f"transform(filter(flatten({kind}), x -> {VALID[kind]}), x -> named_struct('s', x.s, 'k', {k}, 'e', x.e))")
        for k, kind in enumerate(KINDS)
    ]
    # a run of chunks meets only the base spans within it, and each chunk only its own of these
    within = "filter({spans}, b -> b.s < {to} and {since} < b.e)"
    free = f"""flatten(transform(c, x -> named_struct('s', x.s, 'e', x.e, 't', x.t,
            'pattern', concat_ws(' ', coalesce(nullif(lower(regexp_replace(regexp_extract(x.left, '(\\\\S+)\\\\s+$', 1), '[0-9]+', '9')), ''), '#'),
                left(regexp_replace(regexp_replace(regexp_replace(x.t, '[0-9]+', '9'), '[a-z]+', 'a'), '[A-Z]+', 'A'), 24)),
            'seed', get(filter(near, b -> b.s < x.e and x.s < b.e), 0).k)))"""
    each_chunk = f"""flatten(transform(g, c -> flatten(transform(
        array({within.format(spans="some", to="element_at(c, -1).e", since="c[0].s")}), near -> {free[8:-1]}))))"""
    runs = f"""flatten(transform(sequence(0, size(tokens) - 1, {CHUNK}), i -> flatten(transform(array(slice(tokens, i + 1, {CHUNK})), g ->
        flatten(transform(array({within.format(spans="base", to="element_at(element_at(g, -1), -1).e", since="g[0][0].s")}), some ->
            {each_chunk}))))))"""
    none = F.expr("cast(array() as array<struct<s:int,e:int,t:string,pattern:string,seed:int>>)")
    free = F.when(F.size("tokens") > 0, F.expr(runs)).otherwise(none)
    return df.withColumn("base", F.sort_array(F.concat(*each))).withColumn("tokens", free).select("doc_id", "text", "base", "tokens")


def learn_patterns(
    found: DataFrame, rounds: int = 3, min_score: float = 0.7, min_seeds: int = 3,
) -> DataFrame:
    """(pattern, kind) of the patterns that the pattern-instance graph trusts."""
    edges = materialize(
        found.select(F.explode("tokens").alias("x")).groupBy(F.col("x.pattern").alias("pattern"), F.col("x.t").alias("t"))
        .agg(F.min("x.seed").alias("seed")))
    # only patterns that have a seed can gain a score by seeds, or by instances that share a pattern with them
    seeded = edges.where("seed is not null").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("seeds"))
    instances = materialize(
        edges.where("seed is not null").groupBy("t", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("score")))
    sizes = materialize(edges.groupBy("pattern").agg(F.count("*").alias("n")))
    scored = None
    for _ in range(rounds):
        sums = salted_join(edges.select("pattern", "t"), _wide(instances), "t", "inner")
        scored = materialize(
            sums.groupBy("pattern").agg(*[F.sum(f"k{k}").alias(f"k{k}") for k in range(len(KINDS))])
            .join(sizes, "pattern").select("pattern", *[(F.col(f"k{k}") / (F.col("n") + 1)).alias(f"k{k}") for k in range(len(KINDS))]))
        best = salted_join(edges, scored, "pattern", "inner").groupBy("t").agg(
            *[F.max(F.when(F.col("seed") == k, 1.0).otherwise(F.col(f"k{k}"))).alias(f"k{k}") for k in range(len(KINDS))])
        instances = materialize(best.select("t", F.expr(f"stack({len(KINDS)}, {', '.join(f'{k}, k{k}' for k in range(len(KINDS)))}) as (kind, score)")).where("score > 0"))
    kinds = scored.select("pattern", F.expr(f"stack({len(KINDS)}, {', '.join(f'{k}, k{k}' for k in range(len(KINDS)))}) as (kind, score)"))
    good = (
        kinds.join(seeded, ["pattern", "kind"]).where((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds))
        .groupBy("pattern").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
    )
    return materialize(good.select("pattern", (-F.col("b.k")).cast("int").alias("kind")))


def _wide(instances: DataFrame) -> DataFrame:
    """One row for each token, with a score for each kind."""
    return instances.groupBy("t").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"k{k}") for k in range(len(KINDS))])


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS + [f"{k}_like" for k in KINDS]])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", names[x.k], x.s, x.e)))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_spans) of
    every row; spans is "kind:start:end,..." by start, then kind, in code points,
    and all_spans the same as structs."""
    found = materialize(base_spans(docs, id_col, text_col).drop("text").withColumn("_row", F.monotonically_increasing_id()))
    good = learn_patterns(found, **options)
    free = found.select("_row", F.explode(F.filter("tokens", lambda x: x.seed.isNull())).alias("x")).select("_row", "x.s", "x.e", "x.pattern")
    free = maybe_in(free, "pattern", good.select("pattern")).where("_maybe").drop("_maybe")
    spans = F.struct("s", (F.col("kind") + len(KINDS)).alias("k"), "e")
    extra = materialize(salted_join(free, good, "pattern", "inner").groupBy("_row").agg(F.collect_list(spans).alias("extra")))
    marked = maybe_in(found.select("_row", "doc_id", "base"), "_row", extra.select("_row"))
    more = marked.where("_maybe").join(extra, "_row", "left").select(
        "doc_id", "base", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "extra"))).alias("all"))
    out = marked.where("not _maybe").select("doc_id", "base", F.col("base").alias("all")).union(more)
    return out.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, x -> x.k = {k})) as long)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("all")).alias("spans"), F.col("all").alias("all_spans"))
