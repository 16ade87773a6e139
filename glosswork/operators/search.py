"""Ranked search: one ordered list of tier conditions gives both the filter and the rank.

A query is checked, its mode resolved, and its conditions are built on the driver; Catalyst sees
one scan with one OR filter, one CASE, and a top-k.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswork.functions.domain import HAN_NOM
from glosswork.functions.text import fold, fold_text, let
from glosswork.session import ship_package

# Ranks of the tiers, modes, limits and the similarity threshold.
TIERS = ("exact_reading", "exact_glyph", "prefix_reading", "unaccented_reading", "full_text", "fuzzy")
RANK = {name: i for i, name in enumerate(TIERS)}
MODES = ("auto", "han-nom", "quoc-ngu", "toan-van")
LONGEST_QUERY, PAGE_SIZE, PAGE_LIMIT, SUGGESTIONS, SIMILAR = 200, 30, 200, 8, 0.3
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2}
TOKEN = r"[\p{L}\p{N}]+"
#: Tokens that the index handles at a time; a longer text is one slice.
SLICE_TOKENS = 250_000


@dataclass(frozen=True)
class Query:
    text: str
    folded: str
    mode: str


def _has_han(text: str) -> bool:
    spans = [(int(a, 16), int(b, 16)) for a, b in re.findall(r"\\x\{([0-9A-F]+)\}-\\x\{([0-9A-F]+)\}", HAN_NOM)]
    return any(a <= ord(c) <= b for c in text for a, b in spans)


def parse_query(raw: str, mode: str = "auto") -> Query:
    """NFC and trimmed; empty and over-long queries are errors. ``auto`` becomes glyph or reading search by script."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    text = unicodedata.normalize("NFC", raw.strip())
    if not text:
        raise ValueError("empty query")
    if len(text) > LONGEST_QUERY:
        raise ValueError("query too long")
    if mode == "auto":
        mode = "han-nom" if _has_han(text) else "quoc-ngu"
    return Query(text, fold_text(text), mode)


@dataclass(frozen=True)
class Page:
    number: int
    size: int

    @staticmethod
    def of(number: int, size: int = PAGE_SIZE) -> Page:
        return Page(max(1, number), min(max(1, size), PAGE_LIMIT))

    @property
    def offset(self) -> int:
        return (self.number - 1) * self.size


# --- full text ----------------------------------------------------------------


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(fold(c), F.lit(TOKEN), F.lit(0))


def search_document(entries: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``entries`` with ``doc``: the tokens of the weighted fields (weight to column), and ``words``, those tokens joined by spaces."""
    parts = {w: tokens(F.coalesce(F.col(c), F.lit(""))) for w, c in fields.items()}
    doc = F.struct(*[p.alias(w) for w, p in parts.items()])
    words = F.concat_ws("  ", *[F.concat(F.lit(" "), F.array_join(p, " "), F.lit(" ")) for p in parts.values()])
    return entries.withColumns({"doc": doc, "words": words})


def parse_web(raw: str) -> list[list[tuple[bool, str]]]:
    """Alternatives of AND-lists of (wanted, phrase): ``"a phrase"``, ``-not``, ``or``. Never an error."""
    out: list[list[tuple[bool, str]]] = [[]]
    for minus, quoted, word in re.findall(r"(-?)(?:\"([^\"]*)\"?|([^\s\"]+))", raw):
        if not quoted and not minus and word.lower() == "or":
            out.append([])
            continue
        phrase = " ".join(re.findall(r"[^\W_]+", fold_text(quoted or word)))
        if phrase:
            out[-1].append((not minus, phrase))
    return [x for x in out if x]


def full_text(words: Column, raw: str) -> Column:
    """Whether the token text satisfies the query; a query without words matches nothing."""
    options = [reduce(lambda a, b: a & b, [words.contains(f" {p} ") if wanted else ~words.contains(f" {p} ") for wanted, p in terms]) for terms in parse_web(raw)]
    return reduce(lambda a, b: a | b, options) if options else F.lit(False)


def text_score(doc: Column, raw: str, weights: dict[str, float] = WEIGHTS) -> Column:
    """Weighted term frequency, damped by field length. For ordering only."""
    wanted = sorted({w for terms in parse_web(raw) for yes, p in terms if yes for w in p.split()})
    score = F.lit(0.0)
    for name, weight in weights.items():
        own = doc[name]
        hits = F.size(F.filter(own, lambda t: t.isin(*wanted))) if wanted else F.lit(0)
        score = score + hits * weight / (1.0 + F.log1p(F.size(own).cast("double")))
    return score


# --- similarity ---------------------------------------------------------------


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the folded words, each word with two spaces before and one after."""
    grams = F.transform(tokens(c), lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def query_trigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", fold_text(text))
    return sorted({f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)})


def similarity(c: Column, text: str) -> Column:
    """Shared trigrams over all trigrams; 0 without any."""
    grams = query_trigrams(text)
    if not grams:
        return F.lit(0.0)
    query = F.array(*[F.lit(g) for g in grams])

    def score(own: Column, shared: Column) -> Column:
        return shared / (F.size(own) + len(grams) - shared)

    return let(trigrams(c), lambda own: let(F.size(F.array_intersect(own, query)), lambda shared: score(own, shared)))


# --- tiers --------------------------------------------------------------------


def tier_conditions(query: Query, *, reading: Column, norm: Column, glyph: Column, words: Column) -> list[tuple[int, Column]]:
    """(rank, condition) in order of rank, as the mode asks for."""
    if query.mode == "han-nom":
        return [(RANK["exact_glyph"], glyph == query.text), (RANK["full_text"], full_text(words, query.text))]
    if query.mode == "toan-van":
        return [(RANK["full_text"], full_text(words, query.text))]
    return [
        (RANK["exact_reading"], reading == query.text),
        (RANK["prefix_reading"], reading.startswith(query.text)),
        (RANK["unaccented_reading"], norm == query.folded),
        (RANK["full_text"], full_text(words, query.text)),
        (RANK["fuzzy"], similarity(norm, query.text) > SIMILAR),
    ]


def ranked(rows: DataFrame, conditions: list[tuple[int, Column]]) -> DataFrame:
    """Rows that meet any condition, with ``tier``: the rank of the first one they meet."""
    conditions = [(rank, F.coalesce(c, F.lit(False))) for rank, c in conditions]
    tier = reduce(lambda rest, x: F.when(x[1], F.lit(x[0])).otherwise(rest), reversed(conditions), F.lit(None).cast("int"))
    return rows.where(reduce(lambda a, b: a | b, [c for _, c in conditions])).withColumn("tier", tier)


def search(entries: DataFrame, raw: str, mode: str = "auto", page: Page | None = None) -> tuple[DataFrame, DataFrame]:
    """(a page of results in order of tier, score and seq; a one-row total). ``entries`` has seq, reading, reading_norm, glyph, doc and words."""
    query, page = parse_query(raw, mode), page or Page.of(1)
    hits = ranked(entries, tier_conditions(query, reading=F.col("reading"), norm=F.col("reading_norm"), glyph=F.col("glyph"), words=F.col("words")))
    hits = hits.withColumn("score", F.when(F.col("tier") == RANK["full_text"], text_score(F.col("doc"), query.text)).otherwise(F.lit(0.0)))
    return hits.orderBy("tier", F.desc("score"), "seq").offset(page.offset).limit(page.size), hits.agg(F.count("*").alias("total"))


def suggest(entries: DataFrame, raw: str, limit: int = SUGGESTIONS) -> DataFrame:
    """Most similar readings over the threshold, for queries without results."""
    close = entries.withColumn("similarity", similarity(F.col("reading_norm"), raw))
    return close.where(F.col("similarity") > SIMILAR).orderBy(F.desc("similarity"), "seq").limit(limit)


def regroup(results: DataFrame, offset: int, limit: int) -> DataFrame:
    """A slice of results in tier order, with the number of its tier's group on the page."""
    w = Window.orderBy("tier", F.desc("score"), "seq")
    cut = results.orderBy("tier", F.desc("score"), "seq").offset(offset).limit(limit)
    return cut.withColumn("group_no", F.dense_rank().over(Window.orderBy("tier"))).withColumn("place", F.row_number().over(w))


def bridge(pairs: DataFrame, raw: str) -> DataFrame:
    """Other spellings (text, note, row_no) of a query by a two-way list (row_no, old, new, note); the query is never rewritten."""
    key = fold_text(raw.strip())
    forward = pairs.where(fold(F.col("old")) == key).select("row_no", F.lit(0).alias("side"), F.col("new").alias("text"), "note")
    backward = pairs.where((fold(F.col("new")) == key) & (fold(F.col("old")) != key)).select("row_no", F.lit(1).alias("side"), F.col("old").alias("text"), "note")
    return forward.unionByName(backward).orderBy("side", "row_no")


def folded_contains(c: Column, raw: str) -> Column:
    """The browser edition's full text: the folded query as a substring."""
    return fold(c).contains(fold_text(raw))


def browser_search(entries: DataFrame, raw: str, mode: str = "auto", limit: int = SUGGESTIONS) -> DataFrame:
    """The offline edition's rules: case is ignored, full text is a substring, and similar readings come only without other hits.

    ``entries``: seq, reading, reading_norm, glyph and ``folded_text``. Gives seq and ``tier``.
    """
    q = parse_query(raw, mode)
    lower, own = q.text.lower(), F.lower("reading")
    if q.mode == "han-nom":
        conditions = [(RANK["exact_glyph"], F.col("glyph") == q.text)]
    elif q.mode == "toan-van":
        conditions = [(RANK["full_text"], F.col("folded_text").contains(q.folded) if q.folded else F.lit(False))]
    else:
        conditions = [
            (RANK["exact_reading"], own == lower),
            (RANK["exact_glyph"], F.col("glyph") == q.text),
            (RANK["prefix_reading"], own.startswith(lower)),
            (RANK["unaccented_reading"], F.col("reading_norm") == q.folded),
        ]
    hits = ranked(entries, conditions).select("seq", "tier")
    if q.mode != "quoc-ngu" or len(q.folded) < 2:
        return hits
    close = entries.withColumn("_s", similarity(F.col("reading"), q.text)).where(F.col("_s") >= SIMILAR).orderBy(F.desc("_s"), "seq").limit(limit)
    none = hits.limit(1).agg((F.count("*") == 0).alias("_none"))
    return hits.unionByName(close.crossJoin(none).where("_none").select("seq", F.lit(RANK["fuzzy"]).alias("tier")))


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, lists = batch.columns
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, "right")))
            yield _indexed(batch.schema.names[0], keys.slice(start, stop - start), lists.slice(start, stop - start), np.diff(ends[start:stop], prepend=before))
            start = stop


def _indexed(name: str, keys: pa.Array, lists: pa.Array, sizes: np.ndarray) -> pa.RecordBatch:
    """The postings of some rows. Their tokens stay in Arrow; rows, codes and places are numbers."""
    coded = lists.flatten().dictionary_encode()
    codes, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    group = row * max(1, len(coded.dictionary)) + codes
    order = np.argsort(group, kind="stable")
    firsts = np.flatnonzero(np.diff(group[order], prepend=-1))
    positions = pa.ListArray.from_arrays(pa.array(np.append(firsts, len(row)), pa.int32()), pa.array(place[order], pa.int32()))
    return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(codes[order[firsts]])), keys.take(pa.array(row[order[firsts]])), positions], names=["token", name, "positions"])


def postings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(token, key, positions): the inverted index. A text is indexed where it lies, in slices of Arrow batches; nothing is shuffled."""
    ship_package(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, tokens(F.col(text)).alias("_t")).mapInArrow(_positions, f"token string, {key} {kind}, positions array<int>")
