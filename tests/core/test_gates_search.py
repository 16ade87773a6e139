"""Gates, dossiers, search, witness comparison."""

import random

import pytest
from pyspark.sql import functions as F

from glosswork.functions.text import fold, fold_text
from glosswork.operators import dossier, gates, search, witness
from glosswork.plans.queries import QUERIES


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- gates ------------------------------------------------------------------------


def test_a_gate_is_equality(spark):
    assert [gates.gate_row(gates.one_row(spark, n), 2, 2).head().status for n in (1, 2, 3)] == ["red", "green", "red"]


def test_authorize_in_order(spark):
    make = lambda ids, status="green": spark.createDataFrame([(i, "x", 0, 0, status, "") for i in ids], "gate int, name string, measured long, allowed long, status string, note string")
    mark = gates.fingerprint(b"a\nb")
    with pytest.raises(PermissionError, match=r"missing: \[4, 5, 7, 8\]"):
        gates.authorize(make([1, 2, 3], "red"), mark, {})
    with pytest.raises(PermissionError, match="another input"):
        gates.authorize(make(gates.GATES, "red"), mark, gates.fingerprint(b"a"))
    with pytest.raises(PermissionError, match="not green"):
        gates.authorize(make(gates.GATES, "red"), mark, mark)
    gates.authorize(make(gates.GATES), mark, mark)
    assert mark == {"bytes": 3, "lines": 1, "fnv1a": 0xE58A34191C68FD7B} or mark["lines"] == 1


def test_index_reconciliation(spark):
    entries = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "w"), (None, "q")], "glyph string, reading string")
    index = spark.createDataFrame([(0, "a", "x"), (1, "a", " y, x"), (2, "c", "v"), (3, "d", "u")], "row_no int, glyph string, readings string")
    verdicts = gates.reconcile_index(entries, index)
    assert {r.glyph: r.verdict for r in verdicts.collect()} == {"a": "same", "b": "invented", "c": "differing", "d": "missed"}
    none = spark.createDataFrame([], "glyph string")
    assert gates.index_gate(verdicts, none, none).head().measured == 3
    assert gates.index_gate(verdicts, spark.createDataFrame([("d",), ("e",)], "glyph string"), spark.createDataFrame([("c",)], "glyph string")).head().measured == 2


def test_collation(spark):
    entries = spark.createDataFrame([("b", i, r) for i, r in enumerate(["An", "Đa", "9", "Da", "Ích", "Xa"])], "book string, seq int, reading string")
    assert [(r.seq, r.fault) for r in gates.collation_faults(entries, ["book"], "seq").orderBy("seq").collect()] == [(2, "unknown"), (3, "inversion")]


def test_errata(spark):
    entries = spark.createDataFrame([("A", "one two", "g"), ("A", "three", "h"), ("B", "one", None), ("B", "one x", "k")], "reading string, gloss string, glyph string")
    errata = spark.createDataFrame(
        [(0, "s", 1, "glyph", "A", "two", "", "g", ""), (1, "s", 2, "glyph", "A", "two", "", "z", ""), (2, "s", 3, "glyph", "B", "one", "", "k", "seen"), (3, "s", 4, "text", "", "", "three", "", ""), (4, "s", 5, "text", "", "", "gone", "", "why"), (5, "s", 6, "note", "", "", "", "", "")],
        "row_no int, source string, page int, kind string, reading string, anchor string, printed string, corrected string, reason string",
    )
    out = gates.errata_verdicts(entries, entries.select(F.col("gloss").alias("text")), errata)
    assert rows(out.select("row_no", "failed", "unexplained", "stale"), "row_no") == [(0, False, False, False), (1, True, True, False), (2, True, False, False), (3, True, True, False), (4, False, False, True), (5, False, False, False)]
    assert gates.errata_gate(out).head().measured == 3


def coverage_loop(text, spans):
    out = []
    for kind in ("overlapping", "uncovered"):
        run = None
        for i, ch in enumerate(text + " "):
            n = sum(a <= i < b for a, b in spans) if i < len(text) else 0
            bad = i < len(text) and (n > 1 if kind == "overlapping" else n == 0 and not ch.isspace())
            if bad:
                run = (run[0], i + 1) if run else (i, i + 1)
            elif run:
                out.append((kind, *run))
                run = None
    return out


def test_span_coverage_equals_the_loop(spark):
    r = random.Random(4)
    cases = [("".join(r.choice("ab é𨇣 ") for _ in range(r.randint(1, 14))), [tuple(sorted((r.randint(0, 14), r.randint(0, 14)))) for _ in range(r.randint(0, 4))]) for _ in range(60)]
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(cases)], "i int, text string, spans array<struct<start:int,end:int>>")
    got = {i: [] for i in range(len(cases))}
    for x in gates.span_coverage(df, ["i"]).orderBy("i", "kind", "start").collect():
        got[x.i].append((x.kind, x.start, x.end))
    assert got == {i: coverage_loop(t, s) for i, (t, s) in enumerate(cases)}


def test_enum_columns_and_lists(spark):
    df = spark.createDataFrame([("bmp",), ("x",)], "k string")
    with pytest.raises(Exception, match="not in the list"):
        df.select(gates.enum_column(F.col("k"), ("bmp",))).collect()
    gates.equal_lists(["a"], ["a"])
    with pytest.raises(ValueError, match="stored"):
        gates.equal_lists(["a", "b"], ["b", "a"])


# --- dossiers ---------------------------------------------------------------------


def test_signatures_recur_with_their_keys(spark):
    new = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "c")], "row_no int, key string")
    old = spark.createDataFrame([(0, "a", "me"), (1, "a", "you"), (2, "b", "  "), (3, "z", "he")], "row_no int, key string, verified_by string")
    out = dossier.upsert(new, old)
    assert rows(out.select("row_no", "key", "verified_by"), "row_no") == [(0, "a", "you"), (1, "a", "you"), (2, "b", ""), (3, "c", "")]
    assert dossier.kept_signatures(out).head().kept == 2


def test_page_range_join(spark):
    entries = spark.createDataFrame([(1, 10, "abc"), (2, 12, "abc"), (3, 11, "x")], "seq int, page int, text string")
    lines = spark.createDataFrame([(0, 11, "b"), (1, 20, "x")], "row_no int, page int, text string")
    owned = dossier.by_page_range(entries, lines)
    assert rows(owned, "seq") == [(1, 0), (2, 0)]
    assert rows(dossier.unowned(lines, owned).select("row_no"), "row_no") == [(1,)]


# --- search ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def seed(spark):
    data = [(1, "A", "阿", "họ; nương", "a"), (2, "Lõm", "𨰲", "Sâu vào.", "nạm gươm giữa"), (3, "Lôm", "𨇣", "x", ""), (4, "Lốm", "𤑸", "y", ""), (5, "Ác", "惡", "dữ", ""), (6, "Ố", "惡", "ghét", ""), (7, "Lõm vào", None, "z", "")]
    df = spark.createDataFrame(data, "seq int, reading string, glyph string, gloss string, sub_text string").withColumn("reading_norm", fold(F.col("reading")))
    return search.search_document(df, {"A": "reading", "B": "gloss", "C": "sub_text"})


def test_tiers(seed):
    hits, total = search.search(seed, "Lõm")
    assert [(r.seq, r.tier) for r in hits.collect()] == [(2, 0), (7, 2), (3, 3), (4, 3)] and total.head().total == 4
    hits, _ = search.search(seed, "lom")
    assert [(r.seq, r.tier) for r in hits.collect()] == [(2, 3), (3, 3), (4, 3), (7, 4)]
    hits, _ = search.search(seed, "惡")
    assert [(r.seq, r.tier) for r in hits.collect()] == [(5, 1), (6, 1)]
    hits, _ = search.search(seed, "nạm gươm", "toan-van")
    assert [(r.seq, r.tier) for r in hits.collect()] == [(2, 4)]
    assert 1 <= search.suggest(seed, "lomm").count() <= 5


def test_queries_are_checked():
    q = search.parse_query(" Lõm ")
    assert (q.text, q.folded, q.mode) == ("Lõm", "lom", "quoc-ngu")
    assert search.parse_query("惡").mode == "han-nom" and search.parse_query("惡", "toan-van").mode == "toan-van"
    for bad in ("", "  ", "x" * 201):
        with pytest.raises(ValueError, match="query"):
            search.parse_query(bad)
    assert (search.Page.of(0, 0), search.Page.of(3, 999).size, search.Page.of(3).offset) == (search.Page(1, 1), 200, 60)


def test_web_queries(spark):
    assert search.parse_web('a "b C" -d or -"e f"') == [[(True, "a"), (True, "b c"), (False, "d")], [(False, "e f")]]
    assert search.parse_web('"') == [] and search.parse_web("or") == []
    df = spark.createDataFrame([(1, " b c a "), (2, " a b c d "), (3, " c b a ")], "i int, w string")
    assert [r.i for r in df.where(search.full_text(F.col("w"), 'a "b c" -d')).collect()] == [1]
    assert df.where(search.full_text(F.col("w"), "...")).count() == 0


def test_similarity_equals_python(spark):
    def grams(s):
        return set(search.query_trigrams(s))

    words = ["lom", "lomm", "Lõm vào", "", "a", "blue anvil"]
    df = spark.createDataFrame([(w,) for w in words], "w string").withColumn("x", search.similarity(F.col("w"), "lomm"))
    for r in df.collect():
        union = grams(r.w) | grams("lomm")
        assert r.x == pytest.approx(len(grams(r.w) & grams("lomm")) / len(union))


def test_bridge_never_rewrites(spark):
    pairs = spark.createDataFrame([(0, "quấc", "quốc", "n"), (1, "sanh", "sinh", "m")], "row_no int, old string, new string, note string")
    assert [r.text for r in search.bridge(pairs, "Quấc").collect()] == ["quốc"]
    assert [r.text for r in search.bridge(pairs, "sinh").collect()] == ["sanh"]
    assert search.bridge(pairs, "x").count() == 0 and fold_text("Quốc") == "quoc"


# --- witness ------------------------------------------------------------------------


def test_template_calls():
    call = lambda s: [f for _, f in witness.template_calls(s, "T")]
    assert call("{{T|a|b}} x {{T|c}}") == [["a", "b"], ["c"]]
    assert call("{{T|a {{u|v}} b|[[x|y]]|}}") == [["a {{u|v}} b", "[[x|y]]", ""]]
    assert call("{{T|a|b") == [["a", "b"]] and call("none {{Tx|a}}") == []


def test_read_witness(spark):
    text = "{{Từ/nghĩa|a|b|c}}{{Từ/mục|阿|A||c.|x}}{{Từ/nghĩa|h|f|d}}{{Từ/mục||B}}"
    entries, subs = witness.read_witness(spark.createDataFrame([(1, "p", 3, text), (2, "q", None, None)], "page_no int, title string, quality int, wikitext string"), "Từ/mục", "Từ/nghĩa")
    assert rows(entries.select("ordinal", "glyph_field", "reading", "label", "gloss"), "ordinal") == [(1, "阿", "A", "c.", "x"), (2, "", "B", "", "")]
    assert rows(subs.select("ordinal", "sub_no", "han", "form", "definition"), "ordinal") == [(1, 1, "h", "f", "d")]


def align_loop(ours, theirs):
    """Entry by entry: (pairs, only ours, only theirs) as positions."""
    pairs, left, right, i, j = [], [], [], 0, 0
    while i < len(ours) and j < len(theirs):
        if ours[i][0] == theirs[j][0]:
            ni, nj = i, j
            while ni < len(ours) and ours[ni][0] == ours[i][0]:
                ni += 1
            while nj < len(theirs) and theirs[nj][0] == theirs[j][0]:
                nj += 1
            free, open_ = list(range(j, nj)), []
            for a in range(i, ni):
                hit = next((b for b in free if ours[a][1] is not None and theirs[b][1] == ours[a][1]), None)
                if hit is None:
                    open_.append(a)
                else:
                    free.remove(hit)
                    pairs.append((a, hit))
            for a in open_:
                if free:
                    pairs.append((a, free.pop(0)))
                else:
                    left.append(a)
            right += free
            i, j = ni, nj
            continue
        step = None
        for d in range(1, witness.LOOKAHEAD + 1):
            if j + d < len(theirs) and theirs[j + d][0] == ours[i][0]:
                step = (0, d)
                break
            if i + d < len(ours) and ours[i + d][0] == theirs[j][0]:
                step = (d, 0)
                break
        di, dj = step or (1, 1)
        left += range(i, i + di)
        right += range(j, j + dj)
        i, j = i + di, j + dj
    return sorted(pairs), sorted([*left, *range(i, len(ours))]), sorted([*right, *range(j, len(theirs))])


@pytest.mark.parametrize("seed_no", range(4))
def test_alignment_equals_the_loop(spark, seed_no):
    r = random.Random(seed_no)
    base = [r.choice("abcdefghijklm") for _ in range(60)]
    noisy = lambda: [(k, r.choice([None, "一", "二", "三"])) for k in base for _ in range(r.choice([0, 1, 1, 1, 2]))]
    ours, theirs = noisy(), noisy()
    a = spark.createDataFrame([(i, k, g) for i, (k, g) in enumerate(ours)], "seq int, reading string, glyph string")
    b = spark.createDataFrame([(i, k, g or "") for i, (k, g) in enumerate(theirs)], "seq int, reading string, glyph_field string")
    pairs, left, right = witness.align(a, b)
    expected = align_loop(ours, theirs)
    assert (sorted(map(tuple, pairs.collect())), sorted(x.seq for x in left.collect()), sorted(x.seq for x in right.collect())) == expected
    witness.check_accounts(len(expected[0]), len(expected[1]), len(expected[2]), len(ours), len(theirs))


def findings(spark, ours, theirs, our_subs=(), their_subs=()):
    a = spark.createDataFrame([(i, *x) for i, x in enumerate(ours)], "seq int, reading string, glyph string, gloss string, printed_page int, needs_review boolean")
    b = spark.createDataFrame([(i, *x) for i, x in enumerate(theirs)], "seq int, reading string, glyph_field string, gloss string, title string, quality int")
    c = spark.createDataFrame(list(our_subs), "seq int, sub_seq int, han_form string, form string, definition string, needs_review boolean")
    d = spark.createDataFrame(list(their_subs), "seq int, sub_no int, han string, form string, definition string")
    return sorted((x.kind, x.ours, x.theirs) for x in witness.findings(a, b, c, d).collect())


def test_findings(spark):
    there = lambda r, g, gloss="": (r, g, gloss, "p", 3)
    here = lambda r, g, review=False: (r, g, "g", 5, review)
    assert findings(spark, [here("Choản", "篡")], [there("Choản", "𣑕")]) == [("glyph_differs", "篡", "𣑕")]
    assert findings(spark, [here("Trấng", None)], [there("Trấng", "{{?|trên:壯}}")]) == [("shape_note_available", "", "trên:壯")]
    assert findings(spark, [here("A", "阿")], [there("A", "{{?|x}}")]) == [("glyph_unencodable_there", "阿", "x")]
    assert findings(spark, [here("Giáp", "甲"), here("Ất", "乙")], [there("Giáp", "甲"), there("Bính", "丙"), there("Ất", "乙")]) == [("entry_only_there", "", "丙")]
    assert findings(spark, [here("A", "阿", True)], [there("A", "阿", "''x''")]) == [("flagged_here", "g", "x")]


def test_column_boundaries(spark):
    ours, theirs = [("Giá", "嫁", "g", 5, False)], [("Giá", "嫁", "", "p", 3)]
    subs = [(0, 1, "女 | 男 婚", "Nữ ― nam hôn", "Gái có chồng, trai có vợ", False), (0, 2, None, "― x", "id.", False)]
    assert findings(spark, ours, theirs, subs, [(0, 1, "女 - 男 婚", "Nữ - nam hôn.", "Gái có chồng, trai có vợ."), (0, 2, "", "- y", "id."), (0, 3, "", "- z", "id.")]) == []
    leaked = [(0, 1, "女", "| 男 婚 Nữ ― nam hôn", "Gái có chồng, trai có vợ", False)]
    assert [x[0] for x in findings(spark, ours, theirs, leaked, [(0, 1, "女 - 男 婚", "Nữ - nam hôn", "Gái có chồng, trai có vợ")])] == ["column_boundary"]


def test_partners_by_whole_texts(spark):
    pairs = spark.createDataFrame([(1, 7), (2, 8)], "our_seq int, their_seq int")
    ours = [(1, 1, "a", "Same start, then one end"), (1, 2, "b", "Same start, then another"), (1, 3, "c", "twice the same text"), (1, 4, "c", "twice the same text"), (1, 5, "― d.", "short"), (2, 1, "e", None)]
    theirs = [(7, 1, "x", "same start; THEN one end."), (7, 2, "y", "Same start, then a third"), (7, 3, "z", "twice the same text"), (7, 4, "- D", "short"), (8, 1, "x", "Same start, then another")]
    a, b = spark.createDataFrame(ours, "seq int, sub_seq int, form string, definition string"), spark.createDataFrame(theirs, "seq int, sub_no int, form string, definition string")
    assert rows(witness.partners(pairs, a, b), "our_seq", "sub_seq") == [(1, 1, 1), (1, 5, 4)]


def test_partner_query_compares_whole_texts(spark, tmp_path):
    turns = [(0, 0, "user", "Same start\nthen one end"), (0, 1, "system", "Same start\nthen another"), (20, 0, "assistant", "same start\nthen one end."), (20, 1, "user", "Only\nby form"), (20, 2, "assistant", "only\nthe first line")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows(QUERIES["partner_whole"](spark, str(tmp_path)), "conv_a", "turn_a") == [(0, 0, 20, 0), (20, 1, 20, 2)]


def test_postings(spark):
    df = spark.createDataFrame([(1, "b a B"), (2, ""), (3, None), (4, "á")], "k int, t string")
    assert rows(search.postings(df, "k", "t"), "k", "token") == [("a", 1, [1]), ("b", 1, [0, 2]), ("a", 4, [0])]


def test_offline_rules(seed):
    own = seed.withColumn("folded_text", fold(F.concat_ws(" ", "gloss", "sub_text")))
    got = lambda q, mode="auto": rows(search.browser_search(own, q, mode), "tier", "seq")
    assert got("LÕM") == [(2, 0), (7, 2), (3, 3), (4, 3)]
    assert got("惡") == [(5, 1), (6, 1)] and got("NAM guom", "toan-van") == [(2, 4)]
    assert got("lomm") and {t for _, t in got("lomm")} == {5} and got("zz") == []


def test_postings_go_in_slices(monkeypatch):
    """Whole rows, with no more tokens at a time than a slice holds or one row has; against a plain loop."""
    import pyarrow as pa

    monkeypatch.setattr(search, "SLICE_TOKENS", 7)
    r = random.Random(1)
    texts = [[r.choice("abcdé") for _ in range(n)] for n in (3, 0, 4, 5, 20, 0, 1, 6)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.list_(pa.string()))], names=["k", "_t"])
    out = list(search._positions(iter([batch.slice(0, 0), batch, batch.slice(2, 3)])))
    got = sorted((x["k"], x["token"], x["positions"]) for b in out for x in b.to_pylist())
    assert got == sorted((k, t, [i for i, x in enumerate(texts[k]) if x == t]) for k in [*range(len(texts)), 2, 3, 4] for t in set(texts[k] or ()))
    assert all(sum(len(x["positions"]) for x in b.to_pylist()) <= 7 or b.num_rows and len(set(b.column(1).to_pylist())) == 1 for b in out)
