"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items become word sequences: maximal runs of ASCII letters and
digits and non-ASCII bytes, A-Z lower-cased. An item of m words may differ by
``m // edit_every`` word edits (insertion, deletion, substitution). It is split
into one piece more than that budget, so at least one piece of any match occurs
unchanged. Pieces are found by their first words through a hash table, compared in
full, and the surroundings are verified with Myers' bit-parallel distance: the
best alignment of the whole item with any passage of the text.

Items go to the executors in blocks of bounded size, one pass over the texts for
each block, so their number is not limited.

Defined results
* null or empty texts and items, and items without words, match nothing;
* items shorter than ``least_words`` words must occur unchanged;
* an item found at several places of a text gives one row, with its least distance
  and, among equals, its first end;
* rows that repeat an id give a row each time; a null id is carried as null;
* items that repeat a text give a row each; empty tables give no rows;
* extra columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.llm.store import ship_package
from glosswork.llm.tokens import hash_words, runs, windows, word_bounds

#: One edit is allowed for every so many words of an item.
EDIT_EVERY = 8
#: Shorter items must match exactly.
LEAST_WORDS = 8
#: Bytes of item text in one block.
BLOCK_BYTES = 32 << 20

#: Bytes that belong to no word: ASCII other than letters and digits.
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_ids(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, offsets of each text's words) of runs of rows."""
    for first, data, offsets in runs(texts):
        starts, ends, word_of = word_bounds(data, offsets, GAP)
        yield first, hash_words(data, starts, ends), word_of


@dataclass
class Items:
    """The pieces of one block of items, ready to be looked up."""

    ids: list[int | None] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    budget: list[int] = field(default_factory=list)
    #: probe length -> (sorted probe hashes, item of each, start of the piece, end of the piece)
    probes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: probe length -> which low bits of a hash occur
    marks: dict[int, np.ndarray] = field(default_factory=dict)


MARK_BITS = 20
PROBE_WORDS = (1, 2, 4, 8)


def prepare(ids: list[int | None], texts: list[str | None], edit_every: int, least_words: int) -> Items:
    out = Items()
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    for first, h, word_of in word_ids(pa.array(texts, pa.string())):
        for k in range(len(word_of) - 1):
            own = h[word_of[k] : word_of[k + 1]].copy()
            if not len(own):
                continue
            budget = len(own) // edit_every if len(own) >= least_words else 0
            at = len(out.ids)
            out.ids.append(ids[first + k])
            out.words.append(own)
            out.budget.append(budget)
            cuts = [len(own) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                probe = max(p for p in PROBE_WORDS if p <= b - a)
                rows.setdefault(probe, []).append((int(windows(own[a : a + probe], probe)[0]), at, a, b))
    for probe, found in rows.items():
        found.sort()
        h, item, a, b = (np.array(x, np.uint64 if i == 0 else np.int64) for i, x in enumerate(zip(*found, strict=True)))
        out.probes[probe] = (h, item, a, b)
        mark = np.zeros(1 << MARK_BITS, bool)
        mark[(h & np.uint64((1 << MARK_BITS) - 1)).astype(np.int64)] = True
        out.marks[probe] = mark
    return out


def myers_best(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least distance of the whole pattern to any passage of text, end of the first such passage)."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, x in enumerate(pattern.tolist()):
        peq[x] = peq.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, x in enumerate(text.tolist()):
        eq = peq.get(x, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        # A passage may start anywhere, so nothing is carried in at the top row.
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
            if not best:
                break
    return best, end


def _windows(items: Items, h: np.ndarray, word_of: np.ndarray) -> dict[tuple[int, int], list[list[int]]]:
    """(text of the run, item) -> stretches of the text around the item's piece hits; hits in one stretch extend it."""
    out: dict[tuple[int, int], list[list[int]]] = {}
    for probe, (keys, item_of, starts, ends) in items.probes.items():
        grams = windows(h, probe)
        near = np.flatnonzero(items.marks[probe][(grams & np.uint64((1 << MARK_BITS) - 1)).astype(np.int64)])
        own = grams[near]
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        hit = high > low
        text_of = np.searchsorted(word_of, near[hit], "right") - 1
        for at, text, lo, hi in zip(near[hit].tolist(), text_of.tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
            first, last = int(word_of[text]), int(word_of[text + 1])
            for k in range(lo, hi):
                i, a, b = int(item_of[k]), int(starts[k]), int(ends[k])
                if at + b - a > last:
                    continue
                left = max(first, at - a - items.budget[i])
                right = min(last, at - a + len(items.words[i]) + items.budget[i])
                held = out.get((text, i))
                if held and held[-1][0] <= left and right <= held[-1][1]:
                    continue
                if b - a > probe and not np.array_equal(h[at : at + b - a], items.words[i][a:b]):
                    continue
                if held and held[-1][0] <= left <= held[-1][1]:
                    held[-1][1] = max(right, held[-1][1])
                elif held:
                    held.append([left, right])
                else:
                    out[text, i] = [[left, right]]
    return out


def _matches(items: Items, h: np.ndarray, word_of: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(text of the run, item) -> (distance, end word) of all matches in one run.

    Stretches that overlap are one, so each word of a text meets an item's distance once, however often its pieces occur.
    """
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for (text, i), held in _windows(items, h, word_of).items():
        held.sort()
        merged = held[:1]
        for left, right in held[1:]:
            if left <= merged[-1][1]:
                merged[-1][1] = max(right, merged[-1][1])
            else:
                merged.append([left, right])
        first = int(word_of[text])
        found = [(distance, left + end - first) for left, right in merged for distance, end in [myers_best(items.words[i], h[left:right])]]
        if min(found)[0] <= items.budget[i]:
            best[text, i] = min(found)
    return best


MATCH_SCHEMA = "doc_id long, item_id long, distance int, budget int, item_words int, end_word long"


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            ids = batch.column(0)
            out: list[tuple] = []
            for first, h, word_of in word_ids(batch.column(1)):
                for (text, i), (distance, end) in _matches(items, h, word_of).items():
                    out.append((ids[first + text].as_py(), items.ids[i], distance, items.budget[i], len(items.words[i]), end))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "distance", "budget", "item_words", "end_word"])

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of about ``block_bytes``, fetched one partition at a time."""
    ids, texts, held = [], [], 0
    for r in items.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        held += len(r[1])
        if held >= block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", edit_every: int = EDIT_EVERY, least_words: int = LEAST_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, budget, item_words, end_word) of each text that holds a passage within the item's budget."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for ids, found in item_blocks(items, item_id_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(prepare(ids, found, edit_every, least_words))
        part = texts.mapInArrow(_scan(shared), MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], MATCH_SCHEMA)


def drop_leaks(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_text_col: str = "text", edit_every: int = EDIT_EVERY, least_words: int = LEAST_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no passage within any item's budget, as they are; nothing is shuffled."""
    spark = docs.sparkSession
    ship_package(spark)
    at, schema = docs.columns.index(text_col), docs.schema

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, h, word_of in word_ids(batch.column(at)):
                    keep[[first + text for text, _ in _matches(shared.value, h, word_of)]] = False
                yield batch.filter(pa.array(keep))

        return run

    numbered = items.select(F.lit(0).alias("item_id"), F.col(item_text_col).alias("text"))
    for ids, found in item_blocks(numbered, "item_id", "text", block_bytes):
        docs = docs.mapInArrow(clean(spark.sparkContext.broadcast(prepare(ids, found, edit_every, least_words))), schema)
    return docs
