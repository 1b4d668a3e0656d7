"""Compression classifier: zstandard dictionaries trained on good and bad text; the normalised difference of sizes becomes a score."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written

FEATURES = 2


@dataclass(frozen=True)
class Params:
    """The fit reads whole texts: of each label at most `sample` rows, as many as have `sample_bytes` characters together."""

    sample: int = 3000
    sample_bytes: int = 64 << 20
    dictionary_bytes: int = 512 << 10
    level: int = 3
    block: int = 512


@dataclass(frozen=True)
class Model:
    good: tuple[bytes, bool]  # a dictionary and whether it was trained
    bad: tuple[bytes, bool]
    mean: list[float]
    scale: list[float]
    weights: list[float]  # of the features, then the constant
    params: Params


class Features:
    """A text's normalised size difference (bad - good) / bytes, and 1 / (bytes + 20) for the calibration by length.

    Each block of about `block` bytes is compressed by itself under both dictionaries, so that the dictionary and not the
    text's own beginning tells what is known; sizes are those of all blocks of the whole text.
    """

    def __init__(self, good: tuple[bytes, bool], bad: tuple[bytes, bool], p: Params):
        self.block, self.by = p.block, []
        for data, trained in (good, bad):
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            self.by.append(zstandard.ZstdCompressor(level=p.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __call__(self, text: str) -> tuple[float, float]:
        b, blocks = _blocks(text, self.block)
        good, bad = (sum(len(f(x)) for x in blocks) for f in self.by)
        return (bad - good) / max(1, len(b)), 1 / (len(b) + 20)


def _blocks(text: str, size: int) -> tuple[bytes, list[bytes]]:
    """The text's bytes, and these in blocks; a last one of less than a quarter goes with the one before."""
    b = text.encode("utf-8", "replace")
    blocks = [b[i : i + size] for i in range(0, len(b), size)] or [b""]
    if len(blocks) > 1 and len(blocks[-1]) < size // 4:
        rest = blocks.pop()
        blocks[-1] += rest
    return b, blocks


def _dictionary(texts: list[str], p: Params) -> tuple[bytes, bool]:
    """A dictionary trained on all blocks of the whole texts; where these are too few to train on, the texts themselves."""
    blocks = [x for t in texts for x in _blocks(t, p.block)[1] if x]
    try:
        return zstandard.train_dictionary(p.dictionary_bytes, blocks).as_bytes(), True
    except zstandard.ZstdError:
        return b"\n".join(blocks).ljust(8, b" "), False


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    z, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, z.T @ (p - y) + ridge * w)
    return w


def fit(texts: dict[int, list[str]], params: Params | None = None) -> Model:
    """Fit on the texts of label 0 and of label 1.

    Half of them make the dictionaries, the other half calibrates, so no text is scored by a dictionary that holds it.
    With less than two texts of a label every score is the share of label 1 (0.5 without labels).
    """
    p = params or Params()
    if min(map(len, texts.values())) < 2:
        share = (len(texts[1]) + 1) / (len(texts[0]) + len(texts[1]) + 2)
        return Model((b" " * 8, False), (b" " * 8, False), [0.0] * FEATURES, [1.0] * FEATURES, [0.0] * FEATURES + [float(np.log(share / (1 - share)))], p)
    bad, good = (_dictionary(texts[k][::2], p) for k in (0, 1))
    features = Features(good, bad, p)
    x = np.array([features(t) for k in (0, 1) for t in texts[k][1::2]])
    y = np.array([k for k in (0, 1) for _ in texts[k][1::2]], dtype=np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, mean.tolist(), scale.tolist(), _logistic((x - mean) / scale, y).tolist(), p)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), score_col: str = "score") -> DataFrame:
    """doc_id, the columns `keep`, score_col (0 to 1): one row per row of docs, whole texts, no shuffle.

    A null text is scored as an empty one, whose only sign is its length. Null ids and repeated rows stay, equal texts
    have equal scores; a long text is compressed block by block; an empty table gives no rows.
    """
    m = model  # sent with the task: two dictionaries and some numbers, at most 2 * dictionary_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, mean, scale, w = Features(m.good, m.bad, m.params), np.array(m.mean), np.array(m.scale), np.array(m.weights)
        for b in batches:
            x = np.array([features(t.as_py() or "") for t in b.column(b.num_columns - 1)]).reshape(-1, FEATURES)
            score = 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -40, 40)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64())], names=[*b.schema.names[:-1], score_col])

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text__"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + f", `{score_col}` double")


def learn(docs: DataFrame, labels: DataFrame, params: Params | None = None, label: str = "quality") -> Model:
    """Fit on the labels of the rows whose crc32(doc_id as text) mod 4 is not 2.

    Of each label's documents that are in docs, the params.sample with the least hash of doc_id are candidates (equal
    hashes go by doc_id), and of these the first whose lengths together stay within params.sample_bytes; whole texts are
    read. A doc_id that repeats counts once, with its least text. Null labels or texts are left out; a label of two
    values counts with both.
    """
    p = params or Params()
    known = labels.where((F.crc32(F.col("doc_id").cast("string")) % 4 != 2) & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    known = known.join(docs.where(F.col("text").isNotNull()).select("doc_id"), "doc_id", "left_semi")
    first = lambda k: known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample)
    chosen = first(0).union(first(1))  # 2 * params.sample rows of two numbers
    text = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = written(text.join(F.broadcast(chosen), "doc_id").select("label", "doc_id", F.xxhash64("doc_id").alias("h"), F.length("text").alias("n"), "text"), "labelled")
    left, ids = {0: p.sample_bytes, 1: p.sample_bytes}, []
    for k, doc_id, _, n in sorted((tuple(r) for r in rows.select("label", "doc_id", "h", "n").collect()), key=lambda r: (r[0], r[2], r[1])):
        left[k] -= n
        if left[k] >= 0:
            ids.append((k, doc_id))
    inside = rows if min(left.values()) >= 0 else rows.join(F.broadcast(docs.sparkSession.createDataFrame(ids, "label int, doc_id long")), ["label", "doc_id"], "left_semi")
    got = sorted((r.h, r.doc_id, r.label, r.text) for r in inside.select("h", "doc_id", "label", "text").collect())
    forget(rows)
    return fit({k: [t for _, _, label, t in got if label == k] for k in (0, 1)}, p)
