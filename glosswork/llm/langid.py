"""Language identification by string kernels.

Features are the distinct n-grams, n = 1 to ``GRAMS``, of the text's UTF-8 bytes
(ASCII lower-cased): a blended spectrum of presences. The kernel of two texts is the
normalised inner product of their presences over the n-grams of the training sample's landmarks.
Nystroem: texts are described by their kernels with m landmarks, whitened by the inverse
root of the landmarks' own kernel matrix; one ridge regression a language is solved on
top (one versus rest). Scoring takes whole texts in batches: a presence matrix times the
landmarks' presences, times the folded regression weights.

The sample holds at most ``SAMPLE_ROWS`` labelled rows, in equal parts for the
languages, chosen by a hash of the id; all other rows are only scored.

Defined results
* null text, or text without any letter: ``und``, score 0;
* null lang: never learned from; null id: never learned from, scored;
* no labelled row to learn from: every text is ``und``;
* texts of any length are scored whole; repeated rows get equal results;
* only the id, text and lang columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswork.llm.store import ship_package
from glosswork.llm.tokens import runs

SAMPLE_ROWS, LANDMARKS, RIDGE = 1536, 192, 1e-3
#: Longest n-gram; with 3 bytes a table maps each n-gram to its column at once.
GRAMS = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_ids(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` of (doc_id, label): equal parts for the labels, smallest hashes first.

    A cut of the hash keeps the window to about twice the sample, however many rows there are.
    """
    per = labelled.groupBy(label).agg(F.count("*").alias("_n"))
    classes = F.count("*").over(Window.partitionBy())
    per = per.withColumn("_want", F.floor(F.lit(rows) / classes))
    u = (F.xxhash64("doc_id") / F.lit(2.0**64)) + 0.5
    cut = labelled.join(per, label).where(u <= 2.0 * F.col("_want") / F.col("_n") + 0.0)
    nr = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id"))
    return cut.withColumn("_nr", nr).where(F.col("_nr") <= F.col("_want")).select("doc_id", label)


def grams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of a run of texts and the text of each; none crosses two texts."""
    b = _LOWER[data].astype(np.int32)
    if len(b) < n:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    code = b[: len(b) - n + 1].copy()
    for k in range(1, n):
        code = (code << 8) | b[k : len(b) - n + 1 + k]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = text[: len(code)] == text[n - 1 :]
    return code[inside], text[: len(code)][inside]


def _gram_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, one list of distinct codes for each n) of sampled rows."""
    for batch in batches:
        out: list[list[bytes]] = [[] for _ in range(GRAMS)]
        for _, data, offsets in runs(batch.column(1)):
            for k in range(len(offsets) - 1):
                own = data[offsets[k] : offsets[k + 1]]
                for n in range(1, GRAMS + 1):
                    code, _ = grams(own, np.array([0, len(own)]), n)
                    out[n - 1].append(np.unique(code).tobytes())
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.binary()) for x in out]], names=["label", *[f"g{n}" for n in range(1, GRAMS + 1)]])


@dataclass
class KernelModel:
    labels: list[str]
    codes: list[np.ndarray]
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """For each n, from code to column, -1 for none."""
        out, at = [], 0
        for n, own in enumerate(self.codes, 1):
            table = np.full(1 << (8 * n), -1, np.int32)
            table[own] = np.arange(at, at + len(own))
            at += len(own)
            out.append(table)
        return out

    def decide(self, presence: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(presence.sum(axis=1), 1.0))
        kernel = (presence @ self.landmarks.T) / (size[:, None] * self.norms[None, :])
        return kernel @ self.weights


def train(rows: list[tuple[str, list[np.ndarray]]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """rows: (label, for each n the distinct codes), in a fixed order, the labels mixed evenly."""
    labels = sorted({r[0] for r in rows})
    per = max(1, landmarks // len(labels))
    count: dict[str, int] = {}
    chosen = []
    for i, (label, _) in enumerate(rows):
        count[label] = count.get(label, 0) + 1
        if count[label] <= per:
            chosen.append(i)
    codes = [np.unique(np.concatenate([rows[i][1][n] for i in chosen])) for n in range(GRAMS)]
    width = sum(map(len, codes))
    presence = np.zeros((len(rows), width), np.float32)
    for i, (_, lists) in enumerate(rows):
        at = 0
        for n in range(GRAMS):
            where = np.searchsorted(codes[n], lists[n])
            where[where == len(codes[n])] = 0
            if len(codes[n]):
                presence[i, at + where[codes[n][where] == lists[n]]] = 1.0
            at += len(codes[n])
    size = np.sqrt(np.maximum(presence.sum(axis=1), 1.0))
    marks, norms = presence[chosen], size[chosen]
    kernel = ((presence @ marks.T) / (size[:, None] * norms[None, :])).astype(np.float64)
    value, vector = np.linalg.eigh(kernel[chosen])
    keep = value > 1e-8 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    feature = kernel @ root
    goal = np.array([[1.0 if r[0] == label else -1.0 for label in labels] for r in rows])
    solved = np.linalg.solve(feature.T @ feature + ridge * len(rows) * np.eye(feature.shape[1]) / feature.shape[1], feature.T @ goal)
    return KernelModel(labels, codes, marks, norms.astype(np.float32), (root @ solved).astype(np.float32))


SCORE_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
#: Presences of so many texts are multiplied at once.
ROWS_AT_ONCE = 256


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: KernelModel = shared.value
        tables, width = model.tables(), model.landmarks.shape[1]
        names = np.array(model.labels, object)
        for batch in batches:
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, data, offsets in runs(batch.column(3)):
                for a in range(0, len(offsets) - 1, ROWS_AT_ONCE):
                    cut = offsets[a : a + ROWS_AT_ONCE + 1]
                    own, k = data[cut[0] : cut[-1]], len(cut) - 1
                    presence = np.zeros(k * width, np.float32)
                    for n, table in enumerate(tables, 1):
                        code, text = grams(own, cut - cut[0], n)
                        column = table[code]
                        known = column >= 0
                        presence[text[known].astype(np.int64) * width + column[known]] = 1.0
                    value = model.decide(presence.reshape(k, width))
                    top = value.argmax(axis=1)
                    best[first + a : first + a + k] = top
                    score[first + a : first + a + k] = np.clip((value[np.arange(k), top] + 1.0) / 2.0, 0.0, 1.0)
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.where(lettered, names[best], "und"), pa.string()), pa.array(np.where(lettered, score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    return run


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("label"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    labelled = rows.where(~held_out() & F.col("label").isNotNull() & F.col("doc_id").isNotNull() & lettered).select("doc_id", "label").distinct()
    chosen = sample_ids(labelled, "label", sample_rows)
    # The sample is bounded by its parameter, so its ids may be broadcast and its n-grams collected.
    sample = rows.where(~held_out()).join(F.broadcast(chosen), ["doc_id", "label"]).groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label").select("label", "text").mapInArrow(_gram_lists, "label string, " + ", ".join(f"g{n} binary" for n in range(1, GRAMS + 1))).collect()
    if not found:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    model = train([(r[0], [np.frombuffer(x, np.int32) for x in r[1:]]) for r in found], landmarks)
    shared = spark.sparkContext.broadcast(model)
    return rows.select("doc_id", held_out().alias("held_out"), lettered.alias("lettered"), "text").mapInArrow(_score(shared), SCORE_SCHEMA)
