"""Quality rules: per-document counts, and verdicts by host with rates shrunk by an empirical beta prior."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Bounds of the shrunk failure rate above which a host is rejected; between them the hosts' prior decides.
LEAST_RATE, MOST_RATE = 0.5, 0.9


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """COUNTS of one text; all 0 for null or empty."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    n, symbols = len(words), 0
    for s in SYMBOLS:
        symbols += text.count(s)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated(words)


def repeated(words: list[str], k: int = 3) -> int:
    """Words in a window of k words that the text holds twice or more."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64, count=len(words))
    key = ids[:n]
    for j in range(1, k):  # equal numbers for equal beginnings, anew with each word, so that they stay small
        key = np.unique(key, return_inverse=True)[1] if j > 1 else key
        key = key * len(seen) + ids[j : n + j]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[back] > 1)
    hit = np.zeros(len(words), dtype=bool)
    for j in range(k):
        hit[starts + j] = True
    return int(hit.sum())


def document_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [counts(t.as_py()) for t in b.column(1)]
            cols = [pa.array([x[k] for x in found], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *cols], names=["doc_id", *b.schema.names[2:], *COUNTS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).cast("string").alias("host"), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, f"doc_id long, {kept}, " + ", ".join(f"{c} long" for c in COUNTS))


def rule_failures() -> dict[str, F.Column]:
    """The rules whose failures are counted by host. base is also a document's own verdict."""
    n = F.col("n_words")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > 3 * n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "dup_lines": 10 * F.col("n_dup_lines") > n,
    }


def host_verdicts(failed: DataFrame, rules: list[str], least_rate: float = LEAST_RATE, most_rate: float = MOST_RATE) -> DataFrame:
    """host, host_docs, worst_rate, host_rejected. rules: boolean columns of failed.

    For each rule the hosts' failure rates give a beta prior by moments: with their mean m and variance v its strength
    is m(1-m)/v - 1, between 1 and 1000, and 1000 where hosts don't differ. The shrunk rate is
    (failures + strength * m) / (documents + strength). A host is rejected if a rule's shrunk rate is above what the
    prior lets expect, m and three of the prior's deviations, but never below least_rate and always above most_rate.
    Null hosts are one host.
    """
    by_host = failed.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules])
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("fails")) for r in rules])).alias("r")
    rates = written(by_host.select("host", "host_docs", each).select("host", "host_docs", "r.*"), "rates")
    rate = F.col("fails") / F.col("host_docs")
    prior = rates.groupBy("rule").agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    strength = F.when(F.col("v") > 1e-12, F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(F.lit(1000.0))
    prior = prior.select("rule", "m", strength.alias("z"))
    expected = F.col("m") + 3 * F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("z") + 1))
    limit = F.least(F.lit(most_rate), F.greatest(F.lit(least_rate), expected))
    shrunk = (F.col("fails") + F.col("z") * F.col("m")) / (F.col("host_docs") + F.col("z"))
    judged = rates.join(F.broadcast(prior), "rule")  # a row per rule
    return judged.groupBy("host").agg(F.max("host_docs").alias("host_docs"), F.max(shrunk).alias("worst_rate"), F.max(shrunk > limit).alias("host_rejected"))


def apply_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept, the host's figures, and the columns `keep`; one row per row of docs.

    The counts are made once, written to the shared folder, summed by host (partial sums first, so a hot host costs no
    more), and the hosts' verdicts are joined back. kept is false if the document's own rules fail or its host is
    rejected, by one rule or by documents that fail any. Null or empty text: no words, so base_failed. Null hosts form
    one host. Null ids and repeated rows stay, each judged by its own text. An empty table gives no rows. Other columns
    are ignored.
    """
    rules = rule_failures()
    counted = written(document_counts(docs, id_col, text_col, host_col, keep), "counts").select("*", *[c.alias(r) for r, c in rules.items()])
    failed = counted.withColumn("any", functools.reduce(lambda a, b: a | b, [F.col(r) for r in rules]))
    hosts = host_verdicts(failed, [*rules, "any"])
    joined = failed.alias("d").join(hosts.alias("h"), F.col("d.host").eqNullSafe(F.col("h.host")), "left")
    verdict = ~F.col("base") & ~F.col("host_rejected")
    return joined.select("doc_id", *COUNTS, F.col("base").alias("base_failed"), verdict.alias("kept"), F.col("d.host").alias("host"), "host_docs", "host_rejected", *keep)
