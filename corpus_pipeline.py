"""The corpus pipeline: quality classifier, quality rules, near-duplicates, benchmark decontamination, packing.

run(spark, sf_dir) applies STAGES to documents; each stage's rows are written and read again by the next. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, minhash, packing, quality_classifier, quality_rules
from tessera.llm.common import table, written
from tessera.llm.queries import tokenizer

#: A document is rejected below this score. The threshold keeps clean documents rather than drop all doubtful ones.
LEAST_SCORE = 0.5
#: Near-duplicates here have a similarity of 0.8 or more (op3_minhash alone has 0.85); a pair at 0.8 misses all bands with
#: probability 2e-6.
NEAR = minhash.Params(percent=80, bands=56, rows=7)
#: None of the classifier, the packing and MinHash can be said in SQL; tests/llm hold each stage's rows against brute force.
ORACLE_SQL = None


#: What tells rows apart, whatever their ids: the file and the place in it that a row was read from.
ROW = ("row_file__", "row_place__")


def _with_row(docs: DataFrame) -> DataFrame:
    """docs and ROW. What isn't read from files is written first."""
    try:
        return docs.select("*", docs.metadataColumn("_metadata")["file_path"].alias(ROW[0]), docs.metadataColumn("_metadata")["row_index"].alias(ROW[1]))
    except AnalysisException:
        return _with_row(written(docs, "rows"))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs (with ROW) but for the rows whose ROW is in rows."""
    return docs.join(rows.select(*ROW), list(ROW), "left_anti").drop(*ROW)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose quality score is LEAST_SCORE or more. The model is learned from the labelled rows among docs.

    Each row is scored by its own text, so null and repeated ids lose nothing; a null text is scored as an empty one. An
    empty table gives none. Columns that clash with the score's are kept as they are.
    """
    model = quality_classifier.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(docs, model, keep=tuple(c for c in docs.columns if c != "doc_id"), score_col="quality_score__")
    return scored.where(F.col("quality_score__") >= LEAST_SCORE).select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that keep the base rules and whose host (source; null is one) isn't rejected.

    Each row is judged by its own text and host; a null or empty text fails. An empty table gives none.
    """
    docs = _with_row(docs)
    return _without(docs, quality_rules.apply_quality_rules(docs, keep=ROW).where(~F.col("kept")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of least doc_id (null is the greatest), then the first by file and place.

    Rows group by their texts alone: of rows that share an id but no text each stays, of repeated rows and of copies
    without id one. Rows without words are in no group and stay. An empty table gives none.
    """
    docs = _with_row(docs)
    found = written(minhash.near_duplicates(docs, NEAR, keep=ROW).where("group_id is not null").select("group_id", "doc_id", *ROW), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), *[F.col(c).alias(f"{c}_") for c in ROW])
    first = written(found.groupBy("group_id").agg(F.min(place).alias("first")).select("first.*"), "first")
    stay = [F.col(c) == F.col(f"{c}_") for c in ROW]
    return _without(docs, found.join(first, stay, "left_anti"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no window of the benchmark, each judged by its own text; null and empty texts stay."""
    docs = _with_row(docs)
    return _without(docs, decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=ROW).where("contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of op1_packing of every row; repeated rows are packed each, a null id stays null."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality_classifier", classify), ("quality_rules", rules), ("near_duplicates", dedup), ("decontamination", decontaminated), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
