"""The queries against SQL, and the pipeline stage by stage."""

import glob
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import minhash, quality_classifier

sys.path.insert(0, str(Path(__file__).parent))
from tessera.llm.common import table, written
from tessera.llm.queries import ORACLES, QUERIES
from test_text_operators import LOW, counts_by_brute_force, shingles

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM read_parquet('{path}')")
    want = c.sql(ORACLES[name])
    got = QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def by_host_verdicts(rows):
    """Rejected hosts, from the formula of the rules' SQL."""
    flags = {}
    for source, text in rows:
        n, chars, symbols, dup, repeat = counts_by_brute_force(text)
        fails = [n < 50 or 100 * repeat > 50 * n, 10 * symbols > 3 * n, chars < 2 * n or chars > 15 * n, 10 * dup > n]
        flags.setdefault(source, []).append([*fails, any(fails)])
    rejected = set()
    for k in range(5):
        rates = {h: np.mean([f[k] for f in x]) for h, x in flags.items()}
        m, v = np.mean(list(rates.values())), np.var(list(rates.values()))
        z = max(1.0, min(1000.0, m * (1 - m) / v - 1)) if v > 1e-12 else 1000.0
        limit = min(0.9, max(0.5, m + 3 * (m * (1 - m) / (z + 1)) ** 0.5))
        rejected |= {h for h, x in flags.items() if (sum(f[k] for f in x) + z * m) / (len(x) + z) > limit}
    return rejected


def survivors(name, rows, spark, docs):
    """What a stage must keep of rows (tuples of documents), by brute force."""
    if name == "quality_classifier":
        m = quality_classifier.learn(docs, table(spark, DIR, "labels"))
        dictionary = {k: zstandard.ZstdCompressionDict(d) for k, (d, _) in (("good", m.good), ("bad", m.bad))}
        size = lambda x, k: len(zstandard.ZstdCompressor(level=3, dict_data=dictionary[k], write_content_size=False, write_checksum=False, write_dict_id=False).compress(x))

        def score(text):
            b = (text or "").encode()
            cuts = list(range(0, len(b), 512)) or [0]
            if len(cuts) > 1 and len(b) - cuts[-1] < 128:
                cuts.pop()
            parts = [b[x:y] for x, y in zip(cuts, [*cuts[1:], len(b)])]
            f = np.array([sum(size(x, "bad") - size(x, "good") for x in parts) / max(1, len(b)), 1 / (len(b) + 20)])
            return 1 / (1 + np.exp(-(((f - m.mean) / m.scale) @ m.weights[:-1] + m.weights[-1])))

        return [r for r in rows if score(r.text) >= 0.5]
    if name == "quality_rules":
        rejected = by_host_verdicts([(r.source, r.text) for r in rows])
        return [r for r in rows if (c := counts_by_brute_force(r.text))[0] >= 50 and 100 * c[4] <= 50 * c[0] and r.source not in rejected]
    if name == "near_duplicates":
        sets, group = [shingles(r.text) for r in rows], list(range(len(rows)))
        for i, x in enumerate(sets):
            for j in range(i):
                if x and sets[j] and group[i] != group[j] and min(len(x), len(sets[j])) * 100 >= 80 * max(len(x), len(sets[j])) and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                    group = [group[j] if g == group[i] else g for g in group]
        first = {}
        for k, r in enumerate(rows):
            at = (r.doc_id is None, r.doc_id or 0, k)
            if group[k] not in first or at < first[group[k]]:
                first[group[k]] = at
        return [rows[k] for *_, k in first.values()]
    items = [(r.item_id, r.text) for r in table(spark, DIR, "benchmark").collect()]
    held = {tuple(v[i : i + min(10, len(v))]) for _, t in items if (v := bench_words(t)) for i in range(len(v) - min(10, len(v)) + 1)}
    sizes = {len(x) for x in held}
    return [r for r in rows if not any(tuple(w[i : i + n]) in held for w in [bench_words(r.text)] for n in sizes for i in range(len(w) - n + 1))]


def bench_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def test_pipeline_equals_brute_force_stage_by_stage(spark):
    docs = table(spark, DIR, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = docs.collect()
        docs = written(stage(spark, docs, DIR), name)
        assert docs.columns == columns
        assert Counter(docs.collect()) == Counter(survivors(name, rows, spark, spark.createDataFrame(rows, docs.schema)))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert sorted(r.doc_id for r in packed) == sorted(r.doc_id for r in docs.select("doc_id").collect()) and all(r.n == r["all"] for r in packed)


def test_pipeline_of_odd_rows(spark):
    words = [f"Word{k} and{k} go{k}" for k in range(60)]
    text, other = " ".join(words), " ".join(words[::-1])
    rows = [(1, text, "s"), (2, text, "s"), (2, other, "s"), (2, other, "s"), (None, text + " more", None), (None, other + " more and yet more", None), (3, None, "s"), (4, "", None), (5, "short", "s"), (5, text.upper(), "s"), (6, "long " * 40_000, "s"), (None, "short", None), (None, " ".join(f"a{k}" for k in range(90)), None)]
    docs = spark.createDataFrame([(k, t, "en", s, None, 0.1, 1, 2, "n", "row", 7) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, gone int, label int, node string, _metadata string, group_id int")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, DIR)
            if name != "packing":
                assert out.columns == docs.columns
            got = out.collect()
            assert not got if given is not docs else got
            made.setdefault(name, got)
    left = Counter((r.doc_id, r.text) for r in made["near_duplicates"])
    assert left == Counter([(1, text), (2, other), (3, None), (4, ""), (5, "short"), (6, "long " * 40_000), rows[-1][:2]])
    left = Counter((r.doc_id, r.text) for r in made["quality_rules"])
    assert left == Counter((k, t) for k, t, _ in rows if t and "long" not in t and t != "short")
    bench = " ".join(words[:4])
    dirty = spark.createDataFrame([(1, text + " x"), (1, other), (None, other), (None, text)], "doc_id long, text string")
    saved = corpus_pipeline.table
    try:
        corpus_pipeline.table = lambda s, d, n: s.createDataFrame([(1, bench)], "item_id long, text string")
        assert Counter(map(tuple, corpus_pipeline.decontaminated(spark, dirty, DIR).collect())) == Counter([(1, other), (None, other)])
    finally:
        corpus_pipeline.table = saved


def test_pipeline_links_from_80_percent(spark):
    words = [f"w{k}" for k in range(204)]
    rows = [(1, words), (2, words[:50] + ["x"] + words[51:100] + ["y"] + words[101:150] + ["z"] + words[151:] + ["end"] * 6), (3, [f"v{k}" for k in range(204)]), (4, [f"v{k}" for k in range(0, 160)])]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, w in rows]
    near, far = (len(a & b) / len(a | b) for a, b in (sets[:2], sets[2:]))
    assert 0.8 <= near < 0.85 and far < 0.8
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.dedup(spark, docs, DIR).collect()) == [1, 3, 4]
    assert minhash.near_duplicates(docs).where("not kept").count() == 0
