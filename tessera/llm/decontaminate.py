"""Benchmark decontamination: a prefix-filtered set join of the benchmark's windows with documents.

Native: DataFrame functions only.

A window is a run of `window` words of an item (or the whole of a shorter item); its set is its shingles of `shingle`
words (or the whole of a shorter window). A document holds a window only if it holds all its shingles, so one shingle is
a sufficient prefix: the rarest one. Documents' shingles are joined with these prefixes, the position in the window
gives the only place where the window can be, and the words there are compared exactly.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap, lower_az, maybe, written

#: Words of the bitmap of prefixes: 512 KB, whatever the benchmark holds.
BITS = 1 << 16
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of characters other than ASCII ones that are no letters or digits, A-Z lower-cased; none for null."""
    spaced = F.trim(F.regexp_replace(lower_az(F.coalesce(text, F.lit(""))), GAP, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """win (its words joined by spaces), len, at, key, shingle_len: each distinct window with its rarest shingle.

    Rarity is counted over all windows' items; of equally rare ones the one of least hash, then the first, is taken.
    """
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.size("w")
    cut = w.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1))), lambda i: F.slice("w", i, F.least(n, F.lit(window))))).alias("words"))
    wins = cut.select(F.array_join("words", " ").alias("win"), F.size("words").alias("len"), "words").distinct()
    q = F.least(F.col("len"), F.lit(shingle))
    grams = wins.select("win", "len", q.alias("q"), F.posexplode(F.transform(F.sequence(F.lit(1), F.col("len") - q + 1), lambda i: shingle_hash(q, F.slice("words", i, q)))).alias("at", "key"))
    often = grams.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    best = grams.join(often, "key").groupBy("win", "len", "q").agg(F.min(F.struct("often", "key", "at")).alias("b"))
    return best.select("win", "len", "q", F.col("b.key").alias("key"), F.col("b.at").alias("at"))


def shingle_hash(q: Column, run: Column) -> Column:
    return F.xxhash64(q, run)


def window_items(items: DataFrame, window: int) -> DataFrame:
    """win, item_id: which items have a window."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.size("w")
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1))), lambda i: F.array_join(F.slice("w", i, F.least(n, F.lit(window))), " "))
    return w.select("item_id", F.explode(cut).alias("win")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, window: int, shingle: int) -> DataFrame:
    """row_key, start (0-based word), len, win: each occurrence of a window in a document (row_key, w).

    The words are exploded and hashed inside one stage of generated code, where w is passed on by reference; of the
    places only those go on whose shingle may be a prefix, with the words that a window there can cover. The explode is
    an outer one, since of the other kind Spark infers a filter and with it makes w twice.
    """
    wins = written(item_windows(items, window, shingle), "windows")
    sizes = sorted(r.q for r in wins.select("q").distinct().collect())  # at most `shingle` numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], "row_key string, start int, len int, win string")
    bits = bitmap(wins.select("key").distinct(), "key", BITS)
    places = docs.select("row_key", "w", F.posexplode_outer("w").alias("pos", "word"))
    key = lambda q: F.xxhash64(F.lit(q), *[F.get("w", F.col("pos") + j) for j in range(q)])
    may = functools.reduce(lambda x, y: x | y, [maybe(bits, key(q), BITS) for q in sizes])
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    near = F.slice("w", first + 1, F.col("pos") + window - first)
    rows = places.where(F.col("pos").isNotNull() & may).select("row_key", "pos", first.alias("from"), near.alias("near"), F.array(*[key(q) for q in sizes]).alias("keys"))
    rows = rows.select("row_key", "pos", "from", "near", F.explode("keys").alias("key"))
    start = F.col("pos") - F.col("at")
    met = rows.join(wins, "key").where((start >= F.col("from")) & (start - F.col("from") + F.col("len") <= F.size("near")))
    same = F.array_join(F.slice("near", start - F.col("from") + 1, F.col("len")), " ") == F.col("win")
    return met.where(same).select("row_key", start.alias("start"), "len", "win")


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the columns `keep`: one row per row of docs.

    n_hit counts the document's words inside any occurrence of any window. Null or empty texts have no words; items
    without words have no windows. Rows that repeat an id are judged each by its own text; a null id stays null. An
    empty table of items hits nothing; an empty table of documents gives no rows. Other columns are ignored. The occurrences
    of one text are put in order together, so a task holds at most one text's; copies of a text count once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), words(text).alias("w"), F.md5(text).alias("row_key"), *keep)
    bench = items.select(F.col(item_id_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    found = written(occurrences(rows.select("row_key", "w"), bench, window, shingle).distinct(), "occurrences")

    ends = F.max(F.col("start") + F.col("len")).over(Window.partitionBy("row_key").orderBy("start", "len", "win").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest(F.col("start"), F.coalesce(ends, F.lit(0))))
    hit = found.select("row_key", "start", "len", fresh.alias("fresh")).groupBy("row_key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = found.select("row_key", "win").distinct().join(window_items(bench, window), "win").select("row_key", "item_id").distinct()
    named = named.groupBy("row_key").agg(F.count("item_id").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"))
    judged = hit.join(named, "row_key", "left")
    out = rows.select("doc_id", "row_key", F.size("w").cast("long").alias("n_words"), *keep).join(judged, "row_key", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"),
        *keep,
    )
