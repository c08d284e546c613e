"""Regenerate PLANS.md: formatted plans of the flagship join's building blocks at sf0.01."""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from likeness.session import local_session
from likeness.sources import tables as T
from likeness.operators.lsh import minhash_bands, band_candidates
from likeness.functions.encoding import element_codes, join_codes
from likeness.operators.bitmaps import folded, profiles, sizes_allow
from likeness.operators.exact import cosine_index, cosine_scores, jaccard_prefix
from likeness.operators.pairs import group_pairs
from likeness.operators.verify import jaccard_of, vector_norms
from likeness.session import materialize
from pyspark.sql import functions as F
spark = local_session(); spark.sparkContext.setLogLevel("ERROR")
sf = '/root/testdata/sf0.01'
def tree(df):
    p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    head = p.split("\n\n")[0]
    return head
def scanlines(df):
    p = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for l in p.split("\n"):
        if "FileScan" in l:
            m = re.search(r"FileScan parquet \[[^\]]*\]", l)
            keep.append(m.group(0) if m else "FileScan")
            for key in ("PushedFilters", "ReadSchema"):
                m = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", l)
                if m:
                    keep.append(f"  {key}: {m.group(1)}")
    return keep
out = []
ws = T.word_sets(spark, sf)
out.append(("F-DOC word sets (`tables.word_sets`)", tree(ws), scanlines(ws)))
b = minhash_bands(ws)
out.append(("MinHash bands (`minhash_bands`): literal parameter array exploded, partial `min` per (id, band)", tree(b), []))
c = band_candidates(b)
out.append(("Candidates (`band_candidates` -> `group_pairs`): blocked self-join on (band, k0, k1, _bi, _bj)", tree(c), []))
codes = element_codes(ws, "element")
coded = materialize(join_codes(ws, codes, "element").select("id", "code"))
out.append(("Element codes (`join_codes`): heavy elements broadcast, the others joined", tree(join_codes(ws, codes, "element")), []))
pre = jaccard_prefix(coded, 0.5, codes.count())
out.append(("Jaccard prefix (`jaccard_prefix`): counts by (id, range of codes), window over at most 4,096 ranges", tree(pre), []))
members = materialize(pre.join(profiles(coded, "code").select("id", folded().alias("sketch")), "id"))
keep = lambda a, b: sizes_allow(a("n"), b("n"), 0.5)
out.append(("Pairs of prefix elements (`group_pairs`): bounds in the join condition, hot groups by blocks", tree(group_pairs(members, ["code"], keep=keep)), []))
pairs = spark.createDataFrame([(1, 2)], "id_1 long, id_2 long")
j = jaccard_of(pairs, ws, min_similarity=0.5)
out.append(("Verification (`jaccard_of`): bitmaps of 64 codes, bit_count of their AND", tree(j), []))
index, rest = cosine_index(coded.withColumn("value", F.lit(1.0)), vector_norms(coded.withColumn("value", F.lit(1.0))), 0.1, codes.count())
scores = cosine_scores(index, rest, coded.withColumn("value", F.lit(1.0)), vector_norms(coded.withColumn("value", F.lit(1.0))), 0.5)
out.append(("Cosine scores (`cosine_scores`): dot products over the index, bound by the rest's norm", tree(scores), []))
with open(os.path.join(ROOT, 'PLANS.md'), 'w') as f:
    f.write("# Physical plans (sf0.01, local[*], before AQE re-planning)\n\n")
    f.write("Generated by `explain(\"formatted\")` on the building blocks of the flagship join; the operator\n"
            "trees below are the initial adaptive plans (AQE may still switch joins to broadcast or split skewed\n"
            "partitions at run time).  Regenerate any registered query with `python scripts/explain.py`.\n\n")
    for title, t, scans in out:
        f.write(f"## {title}\n\n```\n{t}\n```\n\n")
        if scans:
            f.write("Scan:\n\n```\n" + "\n".join(scans) + "\n```\n\n")
