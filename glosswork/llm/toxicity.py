"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its
distinct words; a document's score is the noisy-or of its sentences,
``1 - prod(1 - p)``. Only documents carry labels; the gradient of the document's
loss flows through the noisy-or into the sentence model, which then tells the
offending sentences.

Sentences end after ``.``, ``!``, ``?`` or at a line feed. Words are maximal runs of ASCII
letters and digits and non-ASCII bytes, A-Z and the capitals of Latin-1 lower-cased. A word
counts as itself and by its first bytes (``PREFIXES``), so that inflected forms share what
their stem tells; all are hashed into ``2**BUCKET_BITS`` weights.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents, in equal parts
for the two labels, chosen by a hash of the id; intercept and weights are then
those of that sample, with the loss weighted back to the labels' shares.

Defined results
* null or empty text: no sentences, score 0 and no spans;
* a null label, null id, or an id with labels of both kinds is not learned from;
* no labelled document of one of the kinds: every score is 0;
* repeated rows score alike; texts of any length are scored whole; an empty table gives no rows;
* only the id, text and label columns are read.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.llm.decontam import GAP
from glosswork.llm.langid import held_out, sample_ids
from glosswork.llm.store import ship_package
from glosswork.llm.tokens import hash_words, mix, runs, word_bounds

SAMPLE_ROWS, BUCKET_BITS, THRESHOLD = 4096, 18, 0.3
#: Words of fewer sampled documents get no weight of their own.
LEAST_DOCS = 4
STEPS, RATE, SHRINK = 150, 0.15, 2e-4
#: Besides the whole word, its first so many bytes are features of a longer word.
PREFIXES = (4, 6, 8)
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a run of texts: bucket of each feature, sentence of each feature, text of each sentence, byte end of each sentence.

    Every text with bytes has at least one sentence; sentences are numbered over the run.
    """
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    if len(lead):  # the capitals of Latin-1
        data = data.copy()
        own = data[lead]
        data[lead] = np.where((own <= 0x9E) & (own != 0x97), own | 0x20, own)
    starts, ends, _ = word_bounds(data, offsets, GAP)
    hashes, at = [hash_words(data, starts, ends)], [ends]
    for n in PREFIXES:
        long = ends - starts > n
        hashes.append(mix(hash_words(data, starts[long], starts[long] + n) ^ np.uint64(n)))
        at.append(ends[long])
    buckets = (np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    ends = np.concatenate(at)
    stops = np.union1d(np.flatnonzero(_END[data]) + 1, offsets[1:])
    stops = np.append(stops, np.full(int((np.diff(offsets) == 0).sum()), -1))  # texts without bytes
    stops = stops[stops > 0] if len(data) else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, stops, "left") - 1
    return buckets, np.searchsorted(stops, ends, "left"), text, stops


@dataclass
class BagModel:
    weights: np.ndarray
    bias: float

    def sentence_logits(self, buckets: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """Each word of a sentence counts once."""
        if not n:
            return np.zeros(0)
        hot = self.weights[buckets]
        at = np.flatnonzero(hot)
        key = np.unique((sentence[at] << BUCKET_BITS) | buckets[at])
        return np.bincount(key >> BUCKET_BITS, weights=self.weights[key & ((1 << BUCKET_BITS) - 1)], minlength=n)[:n] + self.bias


def noisy_or(logits: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    """1 - prod(1 - sigmoid(z)), with log(1 - sigmoid(z)) = -log(1 + exp(z))."""
    return -np.expm1(-np.bincount(bag, weights=np.logaddexp(0.0, logits), minlength=bags)[:bags])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], share: float) -> BagModel:
    """bags: (label, features, their sentences), each feature once a sentence. share: of label 1 among all labelled documents."""
    label = np.array([b[0] for b in bags], np.float64)
    seen = np.zeros(1 << BUCKET_BITS, np.int64)
    for _, buckets, _ in bags:
        seen[np.unique(buckets)] += 1
    column = np.full(1 << BUCKET_BITS, -1, np.int32)
    vocabulary = np.flatnonzero(seen >= min(LEAST_DOCS, max(1, len(bags) // 50)))
    column[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
    cols, rows, bag, at = [], [], [], 0
    for k, (_, buckets, sentence) in enumerate(bags):
        own = column[buckets]
        cols.append(own[own >= 0])
        rows.append((sentence[own >= 0] + at).astype(np.int32))
        n = int(sentence.max()) + 1 if len(sentence) else 1
        bag.append(np.full(n, k, np.int32))
        at += n
    cols, rows, bag = np.concatenate(cols), np.concatenate(rows), np.concatenate(bag)
    positive = label.mean()
    cost = np.where(label == 1, share / positive, (1 - share) / (1 - positive))
    cost /= cost.mean()
    per_bag = np.bincount(bag, minlength=len(bags))
    # Start where a document of median length has the labels' share as its score.
    bias = float(np.log(np.expm1(-np.log1p(-min(max(share, 1e-3), 0.9)) / max(1.0, np.median(per_bag))) + 1e-12))
    w = np.zeros(len(vocabulary))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights=w.astype(np.float32)[cols], minlength=at) + bias
        total = np.bincount(bag, weights=np.logaddexp(0.0, z), minlength=len(bags))
        # loss = -y log(1 - exp(-total)) + (1 - y) total
        slope = cost * np.where(label == 1, -1.0 / np.expm1(np.maximum(total, 1e-9)), 1.0)
        dz = slope[bag] / (1.0 + np.exp(-z))
        gw = np.bincount(cols, weights=dz.astype(np.float32)[rows], minlength=len(w)) / len(bags) + SHRINK * np.sign(w)
        gb = dz.sum() / len(bags)
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.999**step
        w -= RATE * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= RATE * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    weights = np.zeros(1 << BUCKET_BITS)
    weights[vocabulary] = np.where(np.abs(w) < RATE / 10, 0.0, w)
    return BagModel(weights, float(bias))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, sents = [], []
        for _, data, offsets in runs(batch.column(1)):
            for k in range(len(offsets) - 1):
                own = data[offsets[k] : offsets[k + 1]]
                buckets, sentence, _, _ = sentences(own, np.array([0, len(own)]))
                key = np.unique((sentence << BUCKET_BITS) | buckets)
                words.append((key & ((1 << BUCKET_BITS) - 1)).astype(np.int32).tobytes())
                sents.append((key >> BUCKET_BITS).astype(np.int32).tobytes())
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(sents, pa.binary())], names=["toxic", "words", "sents"])


SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int, worst_sentence int, worst_score double"


def _document_scores(model: BagModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, number of the worst sentence or -1, its score) of each text."""
    n = len(texts)
    score, worst, worst_score = np.zeros(n), np.full(n, -1, np.int32), np.zeros(n)
    for first, data, offsets in runs(texts):
        buckets, sentence, text, _ = sentences(data, offsets)
        if not len(text):
            continue
        z = model.sentence_logits(buckets, sentence, len(text))
        k = len(offsets) - 1
        score[first : first + k] = np.clip(noisy_or(z, text, k), 0.0, 1.0)
        order = np.lexsort((np.arange(len(z)), -z, text))
        lead = order[np.flatnonzero(np.append(True, np.diff(text[order]) > 0))]
        at = first + text[lead]
        worst[at] = lead - np.searchsorted(text, text[lead])
        worst_score[at] = 1.0 / (1.0 + np.exp(-z[lead]))
    return score, worst, worst_score


def _score(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, worst, worst_score = _document_scores(shared.value, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(worst, mask=worst < 0), pa.array(worst_score)], names=["doc_id", "held_out", "score", "predicted", "worst_sentence", "worst_score"]
            )

    return run


def give_back() -> None:
    """Return freed memory to the system, for the driver lives on: the C library keeps what lies between blocks in use."""
    with contextlib.suppress(OSError, AttributeError):  # a library without it
        ctypes.CDLL(None).malloc_trim(0)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> BagModel | None:
    """The model of a bounded sample of the labelled rows that may be learned from."""
    ship_package(docs.sparkSession)
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    marked = marked.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_other")).where("toxic = _other").drop("_other")
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    chosen = sample_ids(marked, "toxic", sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    # At most sample_rows ids are broadcast, and their words collected.
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("toxic", "text"), F.xxhash64("text")).alias("_s")).orderBy("doc_id").select("_s.toxic", "_s.text")
    found = sample.mapInArrow(_bags, "toxic int, words binary, sents binary").toLocalIterator()
    bags = [(r.toxic, np.frombuffer(r.words, np.int32), np.frombuffer(r.sents, np.int32)) for r in found]
    model = train(bags, counts[1] / sum(counts.values())) if len({b[0] for b in bags}) == 2 else None
    del bags
    give_back()
    return model


def score_toxicity(docs: DataFrame, model: BagModel | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, worst_sentence, worst_score) of each row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model or BagModel(np.zeros(1 << BUCKET_BITS), -50.0))
    return rows.mapInArrow(_score(shared, threshold), SCORE_SCHEMA)


def drop_toxic(docs: DataFrame, model: BagModel | None, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are; nothing is shuffled."""
    if model is None:
        return docs
    ship_package(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_document_scores(shared.value, batch.column(at))[0] < threshold))

    return docs.mapInArrow(run, docs.schema)


def offending_sentences(docs: DataFrame, model: BagModel, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, sentence, start, end, score): sentences over ``threshold``; offsets are code points, ends exclusive."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: BagModel = shared.value
        for batch in batches:
            out: list[tuple] = []
            for first, data, offsets in runs(batch.column(1)):
                buckets, sentence, text, stops = sentences(data, offsets)
                p = 1.0 / (1.0 + np.exp(-own.sentence_logits(buckets, sentence, len(text))))
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                for s in np.flatnonzero(p >= threshold).tolist():
                    t = int(text[s])
                    begin = int(stops[s - 1]) if s and text[s - 1] == t else int(offsets[t])
                    out.append((batch.column(0)[first + t].as_py(), s - int(np.searchsorted(text, t)), int(points[begin] - points[offsets[t]]), int(points[stops[s]] - points[offsets[t]]), float(p[s])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()], strict=True)], names=["doc_id", "sentence", "start", "end", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, sentence int, start long, end long, score double")
