"""URL filter, line dedup, mixing and secret scans against plain Python, with odd inputs."""

import hashlib
import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from glosswork.llm import components, linededup, mixing, ngramjoin, secrets, urls
from glosswork.llm.components import connected_components
from glosswork.llm.store import Scratch

DOCS = "doc_id long, text string, source string, extra string, _x int"
SPACES = " \t\n\x0b\x0c\r"


def docs(spark, rows):
    """(doc_id, text, source) rows with extra columns, over several partitions."""
    return spark.createDataFrame([(*r, "e", 1) for r in rows], DOCS).repartition(3)


# --- components -----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(r.choice([10, 40, 55]))] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(30)] + [(None, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"))
    assert {r_.node: r_.component for r_ in got.collect()} == {x: find(x) for x in root}
    assert got.count() == len(root)


def test_no_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0
    assert components.joined_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t"), "t").count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_contracted_links_give_the_same_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    r = random.Random(chunk)
    path = list(range(300, 340))
    r.shuffle(path)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + list(zip(path, path[1:], strict=False)) + [(200, 200 + i) for i in range(30)] * 2 + [(None, 1), (5, None)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    want = sorted(map(tuple, connected_components(table, Scratch(spark, "t")).collect()))
    assert sorted(map(tuple, components.joined_components(table, Scratch(spark, "t"), "t").collect())) == want


def test_few_links_take_no_rounds(spark, monkeypatch):
    """A round's plans and broadcasts are the driver's memory: of links that one task holds there are none."""

    def unasked(edges):
        raise AssertionError("a round")

    monkeypatch.setattr(components, "_large", unasked)
    monkeypatch.setattr(ngramjoin, "TILE_CLASSES", 3)
    text = [" ".join(f"w{i}" for i in range(40) if i != gap) for gap in (40, 0, 39, 1, 38, 2, 37, 3)] + ["other words that stand alone here"]
    got = {r.doc_id: r.component_id for r in ngramjoin.ngram_components(docs(spark, [(i, t, None) for i, t in enumerate(text)]), words=2).collect()}
    assert got == {**dict.fromkeys(range(8), 0), 8: 8}


# --- urls ------------------------------------------------------------------------


def page(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").withColumn("extra", F.lit(1))


def judged(df):
    return [(r._url_host, r._url_path, r._url_rule, r._url_verdict) for r in df.orderBy("page_id").collect()]


def test_rules(spark):
    cases = {
        "http://a.example.com/en/12": ("a.example.com", "/en/12", "com/en/", "block"),
        "http://A.Example.COM/en/7x?q#f": ("a.example.com", "/en/7x", "example.com/en/7", "allow"),
        "https://xexample.com/en/7": ("xexample.com", "/en/7", "com/en/", "block"),
        "http://com/en/": ("com", "/en/", "com/en/", "block"),
        "http://x.org/es/1": ("x.org", "/es/1", "org/es/", "block"),
        "http://x.org/ES/1": ("x.org", "/ES/1", None, "allow"),
        "http://example.net/de/8#top": ("example.net", "/de/8", "example.net/de/8", "allow"),
        "http://x.net?/de/": ("x.net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "://h/p": ("h", "/p", None, "allow"),
    }
    assert judged(urls.judge_urls(page(spark, [(u, None) for u in cases]))) == list(cases.values())
    assert urls.judge_urls(page(spark, [])).count() == 0


def test_rules_are_those_of_the_contract(spark, tmp_path):
    """Block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/; in the code and in the SQL."""
    import duckdb

    from glosswork.llm.queries import ORACLES

    contract = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]
    assert [(r.text, "allow" if r.allow else "block") for r in urls.RULES] == contract
    link = '<html><link rel="canonical" href="http://{}"></html>'
    rows = [(f"http://www.{text}1", "") for text, _ in contract]
    # A block reaches an alias without a rule; a page's own allow stays.
    rows += [("http://q.org/1", link.format("example.net/de/8")), ("http://q.org/2", link.format("b.net/de/1")), ("http://c.net/de/1", link.format("a.com/en/1"))]
    pages = page(spark, rows)
    want = [v for _, v in contract] + ["block", "allow", "allow"]
    assert [v for *_, v in judged(urls.judge_urls(pages))] == want
    pages.drop("extra").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert [v for (v,) in con.execute(f"SELECT verdict FROM ({ORACLES['op3_url_filter']}) ORDER BY page_id").fetchall()] == want


def test_blocks_reach_aliases(spark):
    link = lambda u: f'<html><link href="{u}" rel="canonical"></html>'
    rows = [
        ("http://m.a.org/1", link("http://a.com/en/1")),  # blocked target that is no page
        ("http://m.a.org/2", '<meta http-equiv="refresh" content="0; url=/1#x">'),  # chain by a relative address
        ("http://n.org/1", link("http://b.com/en/1")),
        ("http://n.org/1?x", link("http://example.com/en/7")),
        ("http://n.org/2", link("http://n.org/1") + '<meta http-equiv=refresh content="1;URL=http://n.org/1?x">'),
        ("http://example.net/de/8", link("http://x.com/en/5")),  # its own rule allows it
        ("http://free.org/", link("http://free.org/")),
        ("http://c.org/", None),
        ("http://M.A.org/1#z", None),
    ]
    assert [v for *_, v in judged(urls.judge_urls(page(spark, rows)))] == ["block", "block", "allow", "allow", "allow", "allow", "allow", "allow", "block"]
    moves = spark.createDataFrame([("http://c.org/", "http://d.com/en/"), (None, "x")], "src string, dst string")
    assert judged(urls.judge_urls(page(spark, rows), redirects=moves))[7][3] == "block"


def test_relative_references(spark):
    bases = ["http://h.org", "http://h.org/", "http://h.org/a/b/c.html?q=1/2", "http://h.org/a/b/", "https://h.org?x=/y"]
    refs = ["page2.html", "?id=7", "../x", "./y?u=http://z/..", "../../../up/./z/..", "/abs/../k", "//o.com/p", "http://p.net/q", "d/.", "..", "a:b", "sub/e?f#g"]
    cases = spark.createDataFrame([(b, r, urljoin(b, r)) for b in bases for r in refs], "base string, ref string, want string")
    got = cases.select("base", "ref", urls.resolved(F.col("base"), F.col("ref")).alias("got"), "want").collect()
    assert [(r.base, r.ref, r.got) for r in got] == [(r.base, r.ref, r.want) for r in got]
    rows = [
        ("http://m.a.org/d/1", '<link rel=canonical href="page2.html">'),
        ("http://m.a.org/d/page2.html", '<meta http-equiv=refresh content="0; url=../?id=7">'),
        ("http://m.a.org/?id=7", '<link rel=canonical href="http://a.com/en/1">'),
        ("http://m.a.org/1", None),
    ]
    assert [v for *_, v in judged(urls.judge_urls(page(spark, rows)))] == ["block", "block", "block", "allow"]


# --- line dedup ---------------------------------------------------------------------


def dedup_brute(rows, least=10):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACES))
    holder = {}
    big = 2**63
    for i, text, *_ in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= least:
                holder[key(x)] = min(holder.get(key(x), big), big - 1 if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or holder[key(x)] == (big - 1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 2), (7, 2), (4, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    r = random.Random(batches)
    pool = ["a common line of text", "  A COMMON line of text\t", "Ünïcode line of text", "short", "", "exactly10c", "nine char", "x" * 3000]
    rows = [(r.choice([i, i, i, None]), "\n".join(r.choice(pool + [f"own line number {r.randint(0, 30)}"]) for _ in range(r.randint(0, 12))), "s") for i in range(80)]
    rows += [(3, None, None), (5, "", None), rows[7], rows[7], (2, "a common line of text\na common line of text\r", "s")]
    df = linededup.dedup_lines(docs(spark, rows), batches=batches, fanout=fanout)
    assert df.columns == ["doc_id", "source", "extra", "_x", "_ld_n_lines", "_ld_n_dropped", "_ld_kept"]
    assert sorted(((x.doc_id, x._ld_n_lines, x._ld_n_dropped, x._ld_kept) for x in df.collect()), key=repr) == dedup_brute(rows)


def test_runs_are_compacted_and_disjoint(spark):
    runs = linededup.LineRuns(Scratch(spark, "t"), fanout=2)
    for k in range(5):
        batch = spark.createDataFrame([(k, h, h) for h in range(3 * k, 3 * k + 6)], "_ld_id long, _ld_h1 long, _ld_h2 long")
        assert {r._ld_h1: r._ld_seen for r in runs.add(batch).collect()} == {h: k > 0 and h < 3 * k + 3 for h in range(3 * k, 3 * k + 6)}
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(r._ld_h1 for r in runs.seen().collect()) == list(range(18))


def test_line_dedup_of_nothing(spark):
    assert linededup.dedup_lines(docs(spark, [])).count() == 0
    assert linededup.dedup_lines(docs(spark, [(None, None, None)])).head()._ld_n_lines == 1


# --- mixing ------------------------------------------------------------------------------


def targets_brute(sizes, weights, share, cap):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, free, target = share * sum(sizes.values()), list(names), {}
    while free:
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > cap * sizes[s]]
        if not over:
            target.update(part)
            break
        for s in over:
            target[s] = cap * sizes[s]
            rest -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing(spark, monkeypatch, seed):
    r = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    rows = [(i, " ".join("w" for _ in range(r.choice([0, 1, 5, 40, 400]))), r.choice(["a", "b", "Z", "é", None, "c", "hot", "hot", "hot"])) for i in range(120)]
    rows += [(500, None, "null only"), (501, "", "null only"), (None, "a b", "a"), rows[0], rows[0]]
    plan = mixing.mix_plan(docs(spark, rows)).collect()
    sizes = {}
    for _, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len((text or "").split())
    expected = targets_brute(sizes, (5, 2, 1), 1.5, 2.0)
    assert len(plan) == len(rows)
    for p in plan:
        assert (p._mix_size, p._mix_total) == (len((p.text or "").split()), sizes[p.source])
        assert p._mix_target == pytest.approx(expected[p.source])
        rate = p._mix_target / p._mix_total if p._mix_total else 0
        assert int(rate) <= p._mix_copies <= min(2, int(rate) + 1)


def test_targets_of_many_sources_in_pages(spark):
    """Pages of the order are not merged here, so that sums cross them."""
    r = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(r.choice([0, 3, 30, 300]))), r.choice([f"h{r.randrange(400)}.example", "hot", None])) for i in range(1500)]
    sizes = {}
    for _, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    expected = targets_brute(sizes, (5, 2, 1), 1.5, 2.0)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        plan = mixing.mix_plan(docs(spark, rows)).collect()
    finally:
        spark.conf.unset(key)
    assert len(plan) == len(rows)
    assert {p.source: p._mix_target for p in plan} == pytest.approx(expected)


def test_emission(spark):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(900)]
    df = docs(spark, rows)
    plan = {p.doc_id: p._mix_copies for p in mixing.mix_plan(df).collect()}
    out = mixing.emit_mix(df)
    assert out.columns == df.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in plan.items() if n}
    for s, p in {p.source: p for p in mixing.mix_plan(df).collect()}.items():
        assert sum(50 * plan[i] for i in plan if f"s{i % 3}" == s) == pytest.approx(p._mix_target, rel=0.15)
    assert plan == {p.doc_id: p._mix_copies for p in mixing.mix_plan(df.repartition(5)).collect()}
    assert mixing.emit_mix(docs(spark, [])).count() == 0


# --- secrets --------------------------------------------------------------------------------

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def secrets_brute(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets_equal_brute_force(spark):
    r = random.Random(1)
    parts = ["token=", "Password: '", 'API_KEY" =', "secret", "passwd:token:", "abcdef", "abc", "AKIA" + "B7" * 8, "AKIA1", "AKIAKIA" + "Z" * 20, "0123456789abcdef" * 2, "deadbeef", " ", "\n", "é𨇣", "ſecret=abcdefgh", "=", "apikey==abcdef", "TOKEN = a.b-c/d+e=_"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25))), "s") for i in range(400)]
    rows += [(900, None, None), (901, "", None), (None, "token=abcdef", None), (902, "token=abcdef" + " x" * 40000 + "a1" * 20, None), rows[3], rows[3]]
    out = secrets.find_secrets(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "extra", "_x", "_sec_spans"]
    got = out.collect()
    assert len(got) == len(rows)
    base = {x.kind for x in secrets.BASE_RULES}
    for g in got:
        assert [(s.start, s.rank, s.kind, s.end) for s in g._sec_spans if s.kind in base] == secrets_brute(g.text or ""), g.text
    assert secrets.find_secrets(docs(spark, [])).count() == 0


def test_added_rules(spark):
    text = "x ghp_" + "z1" * 18 + " -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc eyJhbGciOiJI.eyJzdWIiOiIx.sig-1_"
    spans = secrets.find_secrets(docs(spark, [(1, text, None)])).head()._sec_spans
    assert [s.kind for s in spans] == ["forge", "pem", "chat", "webtoken"]
    assert [text[s.start : s.end][:4] for s in spans] == ["ghp_", "----", "xoxb", "eyJh"]


def test_the_ledger_scans_what_is_new(spark):
    ledger = secrets.BlobLedger(spark, Scratch(spark, "ledger").root)
    one = [secrets.Rule("a", "k[0-9]+")]
    seen = lambda: {(r.kind, r.version, r.blob[:4]): r["count"] for r in ledger.scanned().groupBy("kind", "version", "blob").count().collect()}
    spans = lambda df: {r.doc_id: [(s.kind, s.start, s.end) for s in r._sec_spans] for r in df.collect()}
    assert spans(secrets.find_secrets(docs(spark, [(1, "k1", ""), (2, "k1", ""), (3, "x", "")]), rules=tuple(one), ledger=ledger)) == {1: [("a", 0, 2)], 2: [("a", 0, 2)], 3: []}
    assert len(seen()) == 2
    both = (*one, secrets.Rule("b", "[a-z]+", least=1))
    assert spans(secrets.find_secrets(docs(spark, [(4, "k1", ""), (5, "yy k22", "")]), rules=both, ledger=ledger)) == {4: [("a", 0, 2), ("b", 0, 1)], 5: [("b", 0, 2), ("a", 3, 6), ("b", 3, 4)]}
    assert set(seen().values()) == {1} and len(seen()) == 2 + 1 + 2
    newer = (secrets.Rule("a", "k", version=2), both[1])
    assert spans(secrets.find_secrets(docs(spark, [(6, "k1", "")]), rules=newer, ledger=ledger)) == {6: [("a", 0, 1), ("b", 0, 1)]}
    # Known blobs are not scanned again: their findings come from the ledger alone.
    before = ledger.findings().count()
    secrets.find_secrets(docs(spark, [(7, "k1", ""), (8, "yy k22", "")]), rules=both, ledger=ledger).collect()
    assert ledger.findings().count() == before


def test_a_scan_adds_few_files(spark):
    wanted = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        ledger = secrets.BlobLedger(spark, Scratch(spark, "ledger").root)
        got = secrets.find_secrets(docs(spark, [(i, f"k{i}", "") for i in range(200)]), rules=(secrets.Rule("a", "k[0-9]+"),), ledger=ledger)
        assert {r.doc_id: [tuple(x)[0::3] for x in r._sec_spans] for r in got.collect()} == {i: [(0, 1 + len(str(i)))] for i in range(200)}
        most = spark.sparkContext.defaultParallelism
        assert len(ledger.findings().inputFiles()) <= most + 1  # and that of the empty ledger
        assert ledger.findings().count() == ledger.scanned().count() == 200
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_digest(spark):
    row = secrets.find_secrets(docs(spark, [(1, "token=abcdef", None)])).select(F.sha2(secrets.span_list(F.col("_sec_spans")), 256).alias("h")).head()
    assert row.h == hashlib.sha256(b"assign:0:12").hexdigest()


def test_alias_tags_as_html_has_them(spark):
    """Each page names a blocked address; the verdict tells whether the tag counts."""
    to = "http://x.com/en/1"
    cases = [
        (f'<link rel="alternate canonical" href="{to}">', "block"),
        (f"<LINK HREF='{to}' REL=Canonical>", "block"),
        (f'<link title="a > b" rel="canonical" href="{to}">', "block"),
        (f'<link title="rel=canonical" rel="icon" href="{to}">', "allow"),
        (f'<link rel="noncanonical" href="{to}">', "allow"),
        (f'<!-- <link rel="canonical" href="{to}"> -->', "allow"),
        (f'<script>var x = \'<link rel="canonical" href="{to}">\';</script>', "allow"),
        (f'<link rel="canonical" href="http://q.org/1"><link rel="canonical" href="{to}">', "block"),
        (f'<base href="http://x.com/en/"><link rel="canonical" href="1">', "block"),
        (f'<base href="//x.com/"><base href="http://q.org/"><link rel=canonical href="en/1">', "block"),
        (f'<meta http-equiv="Refresh" content="5;{to}">', "block"),
        (f'<meta content="0; URL=\'{to}\'" http-equiv=refresh>', "block"),
        ('<meta http-equiv="refresh" content="30">', "allow"),
        (f'<meta name="refresh" content="0; url={to}">', "allow"),
        ('<link rel="canonical" href="http:&#x2F;&#47;x.com/en/1?a=1&amp;b=2">', "block"),
        ("<link rel=canonical href=" + "\"\"" * 3000 + f'"{to}">', "allow"),
        (f'<link rel="canonical" data-x="{"y" * 200_000}" href="{to}">', "block"),
    ]
    rows = [(f"http://p{i}.org/z", html) for i, (html, _) in enumerate(cases)]
    assert [v for *_, v in judged(urls.judge_urls(page(spark, rows)))] == [want for _, want in cases]


def test_alias_sql(spark, tmp_path):
    """The SQL of the query closes over aliases, too."""
    import duckdb

    from glosswork.llm.queries import ORACLES, QUERIES

    link = lambda to: f'<html><link rel="canonical" href="{to}"><p>x</html>'
    rows = [
        ("http://a.com/en/1", "<p>"), ("http://b.org/1", link("http://a.com/en/1")), ("http://b.org/2", link("/1")), ("http://B.org/3#f", link("http://b.org/2#g")),
        ("http://c.org/1", link("http://example.com/en/7")), ("http://c.org/2", link("http://c.org/1")), ("http://c.org/2", link("http://x.com/en/5")),
        ("http://d.org/1", '<meta http-equiv="refresh" content="0; url=http://e.org/1">'), ("http://e.org/1", '<meta http-equiv="refresh" content="5; url=/es/2">'),
        ("http://f.org/es/1", link("http://f.org/q?x=1")), ("http://f.org/q?x=1", None), ("http://f.org/q", "<p>"), ("no address", link("http://a.com/en/1")), (None, link("http://a.com/en/1")),
    ]
    page(spark, rows).drop("extra").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op3_url_filter']})").fetchall())
    got = sorted(tuple(r) for r in QUERIES["op3_url_filter"](spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == want and sum(r[4] == "block" for r in got) == 8


def test_runs_outlive_a_call(spark, tmp_path):
    """A second call with the same folder drops the lines of the first; before a commit it can be repeated; runs are not shuffled."""
    def call(rows, runs):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return {r.doc_id: r._ld_kept for r in linededup.dedup_lines(df, batches=2, runs=runs).collect()}

    def runs():
        return linededup.LineRuns(Scratch(spark, "t"), root=str(tmp_path / "runs"))

    first = [(i, f"a line of number {i}\nthe line of everyone\nshort") for i in range(6)]
    one = runs()
    assert call(first, one)[0] == first[0][1] and call(first, runs())[5] == "a line of number 5\nshort"
    one.commit()
    second = [(9, "THE LINE of everyone \nnew line of number 9"), (10, "a line of number 3\nnew line of number 9")]
    two = runs()
    assert call(second, two) == {9: "new line of number 9", 10: ""}
    two.commit()
    three = runs()
    assert call([(20, "new line of number 9\nlast line of all")], three) == {20: "last line of all"}
    hashes = spark.createDataFrame([(1, 2, 3)], "_ld_id long, _ld_h1 long, _ld_h2 long")
    seen = [n for level in three.levels for n in level]
    own = hashes.groupBy(*linededup.HASHES).agg(F.min("_ld_id").alias("i"))
    for n in seen:
        own = own.join(three.read(n).select(*linededup.HASHES).hint("merge"), linededup.HASHES, "left")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert seen and plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == len(seen)
    with pytest.raises(ValueError, match="_ld_kept"):
        linededup.dedup_lines(spark.createDataFrame([(1, "x", 1)], "doc_id long, text string, _ld_kept int"))
