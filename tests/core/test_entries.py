"""Line roles, field splitting and assembly; set-based rewrites against direct loops."""

import random

import pytest
from pyspark.sql import functions as F

from glosswork.functions import entry as E
from glosswork.operators import assemble as A
from glosswork.operators import lines as L
from glosswork.operators import ordered
from glosswork.operators.layout import group_lines

BODY = 400.0


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("x")).head().x


@pytest.mark.parametrize(
    ("y", "text", "italic", "page", "role"),
    [
        (797.89, "Á", False, 20, "running_head"),
        (797.89, "Á", False, 5, "continuation"),
        (25.89, "12", False, 5, "page_number"),
        (BODY, "CHỮ A", False, 20, "section_title"),
        (BODY, "ĐẠI NAM QUẤC ÂM TỰ VỊ", False, 20, "section_title"),
        (BODY, "阿  A  c.", False, 20, "headword"),
        (BODY, "𨰲  Lõm  n.", False, 20, "headword"),
        (BODY, "Bấm  n.", False, 20, "headword"),
        (BODY, "丫  A  (Nha.)  c.", False, 20, "headword"),
        (BODY, "馬  Mã  c. N", False, 20, "headword"),
        (BODY, "n. Bấc ; bức tức.", False, 20, "continued_headword"),
        (BODY, "― gươm. Nạm gươm.", True, 20, "sub_entry"),
        (BODY, "--. id.", True, 20, "sub_entry"),
        (BODY, "― gươm. Nạm gươm.", False, 20, "continuation"),
        (BODY, "Đèo, nương dựa, phụ theo.", True, 20, "continuation"),
    ],
)
def test_roles(spark, y, text, italic, page, role):
    df = spark.createDataFrame([(y, text, italic, page)], "y double, t string, i boolean, p int")
    assert df.select(L.line_role(F.col("y"), F.col("t"), F.col("p") >= 11, F.col("i")).alias("r")).head().r == role


def label_run_loop(text):
    """Strip labels from the end one by one; anything else before a label rejects."""
    t, found = text.rstrip(), 0
    while True:
        head = next((t[: -len(x)] for x in ("cn.", "c.", "n.") if t.endswith(x)), None)
        if head is None:
            return found > 0
        if head and head[-1].isspace():
            found, t = found + 1, head.rstrip()
        elif head.endswith(("cn.", "c.", "n.")):
            found, t = found + 1, head
        else:
            return False


def test_label_runs_equal_the_loop(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(["c.", "n.", "cn.", " ", "  ", "a", "x", ".", "c", "n", " "]) for _ in range(r.randint(0, 9))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("x", L.ends_with_labels(F.col("t")))
    assert [(r_.t, r_.x) for r_ in df.collect() if r_.x != label_run_loop(r_.t)] == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("阿  A  c.", ("阿", None, "A", None, ["c."], None)),
        ("Bấm  n.", (None, None, "Bấm", None, ["n."], None)),
        ("丫  A  (Nha.)  c.", ("丫", None, "A", "(Nha.)", ["c."], None)),
        ("壓  Áp  c. n.", ("壓", None, "Áp", None, ["c.", "n."], None)),
        ("辰  Thìn  c.n.", ("辰", None, "Thìn", None, ["c.", "n."], None)),
        ("* Lốm  n.", (None, "*", "Lốm", None, ["n."], None)),
        ("馬  Mã  c. N", ("馬", None, "Mã", None, ["c."], "N")),
        ("當  Đương. c  n.", ("當", None, "Đương. c", None, ["n."], None)),
        ("漢  Hán (a) (b)  cn.", ("漢", None, "Hán (a)", "(b)", ["cn."], None)),
    ],
)
def test_headwords(spark, text, expected):
    assert tuple(one(spark, text, E.split_headword)) == expected


@pytest.mark.parametrize("text", ["Đèo, nương dựa.", "c.", "", "阿"])
def test_not_headwords(spark, text):
    assert one(spark, text, E.split_headword) is None


def test_continued_and_stray(spark):
    assert tuple(one(spark, "n. Bấc ; bức tức. ", E.split_continued)) == (["n."], "Bấc ; bức tức.")
    assert tuple(one(spark, "c. n. ", E.split_continued)) == (["c.", "n."], None)
    assert one(spark, "cá. b", E.split_continued) is None
    assert one(spark, "Đương. c", E.has_stray_label) and not one(spark, "Đương", E.has_stray_label)


@pytest.mark.parametrize(("labels", "gloss", "out"), [(["c.", "n."], "găn, giữ.", (["c."], "Ngăn, giữ.")), (["c.", "n."], "tụ; bầy.", (["c.", "n."], "tụ; bầy.")), (["c."], "găn", (["c."], "găn")), (["c.", "n."], "Ngăn", (["c.", "n."], "Ngăn")), (["n.", "c.", "n."], "ăn", (["c."], "Năn")), (["c.", "cn."], "ăn", (["c.", "cn."], "ăn"))])
def test_gloss_repair(spark, labels, gloss, out):
    df = spark.createDataFrame([(labels, gloss)], "l array<string>, g string")
    assert tuple(df.select(E.repair_gloss(F.col("l"), F.col("g")).alias("x")).head().x) == out


STYLE = {"I": "italic", "r": "regular", "H": "han"}


@pytest.mark.parametrize(
    ("segments", "expected"),
    [
        ([("I", "― gươm"), ("r", ". Nạm gươm.")], (None, "― gươm.", "Nạm gươm.", 1)),
        ([("I", "Chính giữa ―"), ("r", ". Ở ngảy giữa ruột.")], (None, "Chính giữa ―.", "Ở ngảy giữa ruột.", 1)),
        ([("I", "— ý"), ("r", ". . Ý là")], (None, "— ý.", ". Ý là", 1)),
        ([("I", "Huyết ― Vốn liến của mình"), ("r", ". ")], (None, "Huyết ― Vốn liến của mình", ".", 1)),
        ([("H", "娑婆世界"), ("I", " Ta ― thế giái"), ("r", ". Ngao du khắp chỗ.")], ("娑婆世界", "Ta ― thế giái.", "Ngao du khắp chỗ.", 1)),
        ([("r", "| "), ("H", "意"), ("I", " ― ý"), ("r", ". Dua theo một ý.")], ("| 意", "― ý.", "Dua theo một ý.", 1)),
        ([("H", "瘖"), ("r", " | "), ("I", "Ám ―"), ("r", ". Câm, ngọng.")], ("瘖 |", "Ám ―.", "Câm, ngọng.", 1)),
        ([("H", "女"), ("I", " | "), ("H", "男 婚"), ("I", " Nữ ― nam hôn"), ("r", ". Gái")], ("女 | 男 婚", "Nữ ― nam hôn.", "Gái", 1)),
        ([("I", "a ―"), ("r", " x "), ("I", "b"), ("r", ". c")], (None, "a ― x b.", "c", 2)),
    ],
)
def test_sub_entries(spark, segments, expected):
    df = spark.createDataFrame([([(STYLE[k], t) for k, t in segments],)], "s array<struct<style:string,text:string>>")
    assert tuple(df.select(E.split_sub_entry(F.col("s")).alias("x")).head().x) == expected


def test_no_italic_is_no_sub_entry(spark):
    df = spark.createDataFrame([([("regular", "― x")],), ([("italic", "  ")],), ([],)], "s array<struct<style:string,text:string>>")
    assert [r.x for r in df.select(E.split_sub_entry(F.col("s")).alias("x")).collect()] == [None] * 3


def assemble_loop(roles):
    entry = block = 0
    out = []
    for role in roles:
        if role in ("headword", "continued_headword"):
            entry, block = entry + 1, 0
        elif role == "sub_entry" and entry:
            block += 1
        elif role not in ("sub_entry", "continuation"):
            out.append((None, None, False))
            continue
        out.append((entry, block if entry else None, entry == 0))
    return out


def test_assembly_equals_the_loop(spark):
    r = random.Random(7)
    roles = [r.choice(["headword", "continued_headword", "sub_entry", "sub_entry", "continuation", "running_head", "page_number"]) for _ in range(900)]
    roles[:3] = ["continuation", "sub_entry", "page_number"]
    rows = [("b", i // 37, i % 37, role) for i, role in enumerate(roles)]
    df = A.assemble(spark.createDataFrame(rows, "book string, page int, line_no int, role string"))
    got = [(x.entry_no, x.block_no, x.orphan) for x in df.orderBy("page", "line_no").collect()]
    assert got == assemble_loop(roles)
    assert A.partition_faults(df).count() == 0


def test_carry_and_previous_equal_loops(spark):
    r = random.Random(3)
    values = [r.choice([None, None, i]) for i in range(400)]
    df = spark.createDataFrame([("b", i // 13, i % 13, v) for i, v in enumerate(values)], "book string, page int, line_no int, v int")
    carried, before, last = [], [], None
    for v in values:
        before.append(last)
        last = v if v is not None else last
        carried.append(last)
    out = ordered.previous_value(ordered.carry_forward(df, "c", F.col("v")), "p", F.col("v")).orderBy("page", "line_no").collect()
    assert [x.c for x in out] == carried and [x.p for x in out] == before


def merge_loop(subs):
    out, carry = [], None
    for s in subs:
        s = dict(s)
        if carry:
            for k in ("han_form", "han_expanded", "form", "form_expanded"):
                parts = [x for x in (carry[k], s[k]) if x is not None]
                s[k] = " ".join(x for x in parts if x) if parts else None
            s["needs_review"] = carry["needs_review"] or s["needs_review"]
        carry = None
        if not s["definition"].strip():
            carry = s
        else:
            out.append(s)
    return out + [carry] if carry else out


def test_wrapped_forms_equal_the_loop(spark):
    r = random.Random(9)
    rows, expected = [], {}
    for e in range(150):
        subs = []
        for b in range(r.randint(0, 7)):
            word = lambda: r.choice(["a", "b c", "d"])
            subs.append({"entry": e, "block_no": b, "han_form": r.choice([None, word()]), "han_expanded": r.choice([None, word()]), "form": word(), "form_expanded": word(), "definition": r.choice(["", " ", "x", "y"]), "needs_review": r.random() < 0.2})
        rows += subs
        expected[e] = [tuple(s[k] for k in ("han_form", "han_expanded", "form", "form_expanded", "definition", "needs_review")) for s in merge_loop(subs)]
    df = spark.createDataFrame([tuple(s.values()) for s in rows], "entry int, block_no int, han_form string, han_expanded string, form string, form_expanded string, definition string, needs_review boolean")
    merged = A.merge_wrapped(df, ["entry"])
    got = {e: [] for e in expected}
    for x in merged.orderBy("entry", "block_no").collect():
        got[x.entry].append((x.han_form, x.han_expanded, x.form, x.form_expanded, x.definition, x.needs_review))
    assert got == expected
    assert merged.agg(F.sum("merged")).head()[0] == len(rows) - sum(map(len, expected.values()))


def test_lines_from_runs(spark):
    rows = [("b", 1, 400.0, 0, 250.0, 90.0, "right", "regular"), ("b", 1, 400.0, 1, 10.0, 90.0, "A", "regular"), ("b", 1, 400.0, 2, 50.0, 90.0, "B", "italic"), ("b", 1, 400.0, 3, 30.0, 90.0, "a", "regular"), ("b", 1, 400.0, 4, 10.0, 95.0, "top", "han")]
    df = group_lines(spark.createDataFrame(rows, "book string, page int, width double, run_no int, x double, y double, text string, style string")).orderBy("line_no")
    assert [(x.column, x.y, [tuple(s) for s in x.segments], x.text) for x in df.collect()] == [
        ("left", 95.0, [("han", "top")], "top"),
        ("left", 90.0, [("regular", "Aa"), ("italic", "B")], "AaB"),
        ("right", 90.0, [("regular", "right")], "right"),
    ]


def test_lines_are_gathered_in_pieces(spark):
    """Against a plain loop, with missing values; no window of the plan sees the runs."""
    r = random.Random(5)
    rows = [("b", r.choice([1, 2, None]), 100.0, n, r.choice([10.0, 20.0, 30.0, 60.0, None]), r.choice([5.0, 7.0, None]), r.choice(["x", "y", "", None]), r.choice(["regular", "italic", None])) for n in range(300)]
    df = group_lines(spark.createDataFrame(rows, "book string, page int, width double, run_no int, x double, y double, text string, style string"))
    lines = {}
    for _, page, width, n, x, y, text, style in sorted(rows, key=lambda t: (t[4] is not None, t[4], t[3])):
        segments = lines.setdefault((page, "right" if x is None or x >= width / 2 else "left", y), [])
        if not segments or segments[-1][0] != style:
            segments.append((style, ""))
        segments[-1] = (style, segments[-1][1] + (text or ""))
    want, last, number = [], None, 0
    for page, side, y in sorted(lines, key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2] is None, -(k[2] or 0))):
        number, last = (number + 1 if page == last and number else 1), page
        want.append((page, number, side, y, lines[page, side, y], "".join(t for _, t in lines[page, side, y])))
    got = [(x.page, x.line_no, x.column, x.y, [tuple(s) for s in x.segments], x.text) for x in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "run_no" not in plan


def test_leading_style(spark):
    df = spark.createDataFrame([([("regular", " "), ("italic", "x")],), ([],)], "s array<struct<style:string,text:string>>")
    assert [r.x for r in df.select(E.leading_style(F.col("s")).alias("x")).collect()] == ["italic", None]
