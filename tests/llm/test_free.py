"""N-gram join, language id, vectors, decontamination, main text and toxicity, with odd inputs."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glosswork.llm import ann, decontam, htmltext, langid, ngramjoin, tokens, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, n string, cls int").repartition(3)


def word(r):
    return "".join(r.choice("abcdefghé") for _ in range(r.randint(1, 6)))


# --- tokens -----------------------------------------------------------------------


def test_shingles_equal_python():
    r = random.Random(0)
    texts = [None, "", " \t\n", "One", "one two", "É é", "a b c a b c a b c"] + ["".join(r.choice(["ab", "B", " ", "\n", "\x0b", "é", "\xa0", "𨇣"]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += ["word " * 600_000]
    for n in (1, 3, 4):
        seen, by_shingle = {}, {}
        got = {i: own for i, own in tokens.shingle_sets(pa.array(texts, pa.string()), n)}
        for i, t in enumerate(texts):
            w = WORD.findall((t or "").translate(LOWER))
            want = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
            assert len(got[i]) == len(want)
            seen[frozenset(want)] = seen.get(frozenset(want), tuple(got[i].tolist()))
            assert seen[frozenset(want)] == tuple(got[i].tolist())
            for s in want if len(want) == 1 else ():
                assert by_shingle.setdefault(s, int(got[i][0])) == int(got[i][0])


def test_sliced_batches():
    column = pa.array(["zero", "one two three four", None, "five six"])
    whole = [own.tolist() for _, own in tokens.shingle_sets(column, 2)]
    assert [own.tolist() for _, own in tokens.shingle_sets(column.slice(1, 3), 2)] == whole[1:]


# --- n-gram join -----------------------------------------------------------------------


def components_brute(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, size, groups, edits):
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(groups):
        base = [word(r) for _ in range(r.randint(3, 120))]
        for _ in range(r.choice([1, 1, 2, 5, size])):
            own = list(base)
            for _ in range(r.randint(0, edits)):
                own[r.randrange(len(own))] = word(r)
            rows.append((k, " ".join(own)))
            k += 1
    passage = " ".join(word(r) for _ in range(40))
    rows += [(k + i, passage + " " + " ".join(word(r) for _ in range(r.randint(1, 60)))) for i in range(40)]
    return rows


@pytest.mark.parametrize(("seed", "n", "num", "limits"), [(0, 4, 85, {}), (1, 5, 80, {}), (2, 4, 85, {"PAIR_LIST": 3, "TILE_CLASSES": 7, "SPLIT_LIST": 5}), (3, 2, 50, {"PAIR_LIST": 2, "TILE_CLASSES": 4, "SPLIT_LIST": 3}), (4, 3, 95, {"PAIR_LIST": 5, "TILE_SHINGLES": 300}), (5, 4, 85, {"PAIR_LIST": 2, "TILE_CLASSES": 3, "LEADERS": 1, "REST_CLASSES": 2, "SPLIT_LIST": 4}), (6, 3, 60, {"PAIR_LIST": 2, "TILE_CLASSES": 2, "LEADERS": 1, "REST_SHINGLES": 100})])
def test_ngram_join_equals_brute_force(spark, monkeypatch, seed, n, num, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngramjoin, name, value)
    rows = corpus(seed, 60, 14, 6)
    rows += [(None, rows[0][1]), (None, "all alone here now ok"), (900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), rows[3], rows[3], (905, "x " * 5000)]
    got = ngramjoin.ngram_components(docs(spark, rows), words=n, num=num, den=100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == components_brute(rows, n, num, 100)


def test_ngram_join_of_nothing(spark):
    assert ngramjoin.ngram_components(docs(spark, [])).count() == 0
    assert ngramjoin.ngram_components(docs(spark, [(1, None)])).head().component_id == 1


def test_groups_of_equals_brute_force():
    r = np.random.default_rng(1)
    for m in (1, 2, 30, 120):
        base = r.integers(0, 2**63, 80, dtype=np.uint64)
        sets = [np.unique(np.where(r.random(80) < r.choice([0.02, 0.1, 0.3]), r.integers(0, 2**63, 80, dtype=np.uint64), base)) for _ in range(m)]
        root = ngramjoin.groups_of(sets, 85, 100)
        expect = list(range(m))
        for a, b in itertools.combinations(range(m), 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((expect[a], expect[b]))
                expect = [x if e == y else e for e in expect]
        assert [expect.index(e) for e in expect] == [root.tolist().index(e) for e in root]


def test_packed_counts_are_never_too_small():
    counts = np.unique(np.concatenate([np.arange(5000), (1.37 ** np.arange(1, 125)).astype(np.uint64)])).astype(np.uint64)
    back = ngramjoin.UNPACKED[ngramjoin.pack_counts(counts)]
    assert (back[:300] == counts[:300].astype(np.int64)).all() and (back >= counts.astype(np.int64)).all()
    assert (back <= counts.astype(float) * 1.002 + 1).all()


def test_chains_that_meet_late():
    """Groups grow side by side and are joined by links between classes that either group could have left out."""
    for seed in range(60):
        r = np.random.default_rng(seed)
        width, step = 60, 4
        tokens_ = r.integers(0, 2**63, 4000, dtype=np.uint64)
        starts = np.cumsum(r.choice([step, step, step, 9, 30], size=r.integers(5, 60)))
        sets = [np.unique(tokens_[a : a + width + r.integers(0, 3)]) for a in starts]
        r.shuffle(starts)
        sets = [sets[i] for i in r.permutation(len(sets))]
        root = ngramjoin.groups_of(sets, 85, 100)
        expect = list(range(len(sets)))
        for a, b in itertools.combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((expect[a], expect[b]))
                expect = [x if e == y else e for e in expect]
        assert [expect.index(e) for e in expect] == [root.tolist().index(e) for e in root]


def test_longer_prefixes_where_shingles_are_frequent():
    rare, often = np.full(40, 2), np.full(40, 500)
    assert ngramjoin.choose_matches(rare, 40, 34)[0] < ngramjoin.choose_matches(often, 40, 34)[0]
    for size in (1, 2, 7, 40):
        m, length = ngramjoin.choose_matches(np.full(size, 9), size, ngramjoin.least_overlap(size, 85, 100))
        assert 1 <= m <= length <= size


# --- language id --------------------------------------------------------------------------


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def languages(seed, count):
    r = random.Random(seed)
    parts = {"xx": "the and ing tion of er".split(), "yy": "der die ung keit sch ü".split(), "zz": "que ción los ñ ado".split()}
    rows = []
    for i in range(count):
        lang = r.choice(list(parts))
        rows.append((i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(4, 60))), lang))
    return rows


LANG = "doc_id long, text string, lang string"


def test_language_of_held_out_rows(spark):
    rows = languages(0, 400)
    rows += [(1000, None, "xx"), (1001, "123 !?", "yy"), (1002, "", None), (None, rows[0][1], "yy"), (1003, rows[1][1], None), rows[5], rows[5]]
    df = spark.createDataFrame(rows, LANG).withColumn("label", F.lit("clash")).repartition(3)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert got.keys() == {r[0] for r in rows} and langid.identify(df).count() == len(rows)
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    plain = [(i, lang) for i, _, lang in rows[:400]]
    assert all(got[i].held_out == held(i) for i, _ in plain) and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[i].lang_pred == lang for i, lang in plain if held(i)) / sum(held(i) for i, _ in plain) > 0.97
    assert got[None].lang_pred == rows[0][2]


def test_held_out_labels_do_not_matter(spark):
    rows = languages(1, 150)
    flipped = [(i, t, "xx" if held(i) else lang) for i, t, lang in rows]
    answer = lambda x: sorted(map(tuple, langid.identify(spark.createDataFrame(x, LANG)).collect()))
    assert answer(rows) == answer(flipped)


def test_kernel_equals_brute_force():
    texts = ["the thing", "der dings ü", "a", "the", "zz top the"]
    grams = [{n: {t.lower().encode()[k : k + n] for k in range(len(t.encode()) - n + 1)} for n in (1, 2, 3)} for t in texts]
    code = lambda g: int.from_bytes(g, "big")
    rows = [("ab"[i % 2], [np.array(sorted(code(g) for g in grams[i][n]), np.int32) for n in (1, 2, 3)]) for i in range(5)]
    model = langid.train(rows, landmarks=4)
    marks = [0, 2, 1, 3]
    known = {(n, g) for i in marks for n in (1, 2, 3) for g in grams[i][n]}
    bag = [{(n, g) for n in (1, 2, 3) for g in x[n]} & known for x in grams]
    presence = np.zeros((1, model.landmarks.shape[1]), np.float32)
    data = np.frombuffer(texts[4].encode(), np.uint8)
    for n, table in enumerate(model.tables(), 1):
        columns = table[langid.grams(data, np.array([0, len(data)]), n)[0]]
        presence[0, columns[columns >= 0]] = 1
    kernel = (presence @ model.landmarks.T)[0] / (math.sqrt(presence.sum()) * model.norms)
    want = sorted(len(bag[4] & bag[i]) / math.sqrt(len(bag[4]) * len(bag[i])) for i in marks)
    assert sorted(kernel.tolist()) == pytest.approx(want, rel=1e-5)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "x")], LANG)
    assert {r.lang_pred for r in langid.identify(df).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], LANG)).count() == 0


def test_sample_is_bounded_and_even(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(4000)], "doc_id long, label string")
    got = langid.sample_ids(df, "label", 300).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {"a": 150, "b": 150}
    assert langid.sample_ids(df, "label", 10**6).count() == 4000


# --- nearest neighbours -------------------------------------------------------------------


VEC = "vec_id long, embedding array<float>, v int"


def nearest_brute(rows, step, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for i, v in ok:
        if i % step == 0:
            scored = sorted(((-float(ann.cosines(v[None], w[None])[0]), j) for j, w in ok if j != i))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("blocks", "k"), [((2048, 16384), 5), ((7, 11), 5), ((1, 3), 2), ((3, 50), 400)])
def test_vectors_equal_brute_force(spark, blocks, k):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(20)] + [(300, [0.0] * 8), (310, None), (320, [1.0] * 7), (330, [float("nan")] + [1.0] * 7), (340, [float("inf")] + [1.0] * 7), (350, [None] + [1.0] * 7), (None, [1.0] * 8), (360, [1e-20] * 8), (370, [1e30] * 8)]
    df = spark.createDataFrame([(*x, 1) for x in rows], VEC).repartition(4)
    got = ann.nearest(df, F.col("vec_id") % 10 == 0, k=k, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == nearest_brute(rows, 10, k)


@pytest.mark.parametrize("blocks", [(2048, 16384), (7, 60)])
def test_clusters_of_nearly_equal_vectors(spark, blocks):
    """The survivors of a query in a cluster go over several parts, and none is lost."""
    r = np.random.default_rng(5)
    centre = r.normal(size=8)
    rows = [(i, (centre + 1e-5 * r.normal(size=8)).astype(np.float32).tolist()) for i in range(180)]
    rows += [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(180, 240)] + [(240, rows[0][1])]
    df = spark.createDataFrame([(*x, 1) for x in rows], VEC).repartition(4)
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, query_block=blocks[0], candidate_block=blocks[1], hot=4, parts=3)
    assert sorted(map(tuple, got.collect())) == nearest_brute(rows, 20, 5)


def test_dealing_keeps_every_pair():
    r = np.random.default_rng(6)
    i, row, low = np.sort(r.integers(0, 9, 400)), r.integers(-9, 9, 400), r.normal(size=400)
    at, part, copy = ann.deal(i, row, low, 5, 10, 4)
    assert sorted(at[~copy]) == list(range(400)) and part.max() <= 4
    assert all((part[~copy & (i[at] == q)] == 0).sum() == min(10, (i == q).sum()) for q in range(9))
    for q in range(9):
        best = set(np.flatnonzero(i == q)[np.argsort(-low[i == q])][:5])
        others = np.unique(part[(i[at] == q) & ~copy & (part > 0)])
        assert all(set(at[copy & (i[at] == q) & (part == p)]) == best for p in others)
    assert not len(ann.deal(i[:0], row[:0], low[:0], 5)[0])


def test_error_bounds_hold():
    r = np.random.default_rng(3)
    for d in (3, 64, 1500):
        q, c = r.normal(size=(20, d)) ** 3, r.normal(size=(50, d)) ** 3
        (a, x, e), (b, y, f) = ann.quantise(q), ann.quantise(c)
        near = ann._product(a, b) * x[:, None] * y[None, :]
        true = np.array([[float(u @ v / np.linalg.norm(u) / np.linalg.norm(v)) for v in c] for u in q])
        assert (np.abs(near - true) <= f[None, :] + e[:, None] * (1 + f[None, :]) + ann.SLACK).all()


def test_few_vectors(spark):
    assert ann.nearest(spark.createDataFrame([], VEC), F.col("vec_id") == 1).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1)], VEC)
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(two, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 1)]
    assert ann.nearest(two, F.col("vec_id") == 9).count() == 0


def test_queries_of_one_id_share_a_list(spark):
    """Two rows of id 0 have one list of five; a candidate counts once, with its larger score; equal candidates count each."""
    r = np.random.default_rng(7)
    rows = [(0, r.normal(size=4).tolist()), (0, r.normal(size=4).tolist()), *((i, r.normal(size=4).tolist()) for i in range(1, 9))]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame([(*x, 1) for x in rows], VEC)
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    best = sorted((-max(float(ann.cosines(q[None], c[None])[0]) for j, q in rows if j == 0), i) for i, c in rows if i)
    for blocks in ((100, 100), (1, 2)):
        got = ann.nearest(df, F.col("vec_id") == 0, k=5, query_block=blocks[0], candidate_block=blocks[1]).orderBy("rank").collect()
        assert [(x.rank, x.vec_id, x.score) for x in got] == [(n + 1, i, -s) for n, (s, i) in enumerate(best[:5])]


# --- decontamination -----------------------------------------------------------------------


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) if w]


def best_distance(pattern, text):
    """(least distance, first end) of the pattern to any passage, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for j, x in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != x)))
        row = new
        best = min(best, (row[-1], j))
    return best


def leaks_brute(rows, items):
    out = []
    for d, text in rows:
        own = words_of(text)
        for i, item in items:
            p = words_of(item)
            if p:
                budget = len(p) // decontam.EDIT_EVERY if len(p) >= decontam.LEAST_WORDS else 0
                distance, end = best_distance(p, own)
                if distance <= budget:
                    out.append((d, i, distance, budget, len(p), end))
    return sorted(out, key=repr)


def test_leaks_equal_brute_force(spark):
    r = random.Random(4)
    vocabulary = [word(r) for _ in range(40)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(r.choice([1, 3, 7, 8, 20, 33, 70, 130])))) for i in range(25)] + [(100, None), (101, ""), (102, "..."), (103, "Éa éa")]
    rows = []
    for d in range(160):
        own = some(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            leak = words_of(r.choice(items)[1])
            for _ in range(r.randint(0, max(1, len(leak) // 5))):
                if leak:
                    k = r.randrange(len(leak))
                    leak[k : k + 1] = r.choice([[], ["new"], [leak[k], "more"]])
            at = r.randint(0, len(own))
            own[at:at] = leak
        rows.append((d, r.choice([" ", "\n", ", ", "*** "]).join(own)))
    rows += [(None, items[4][1].upper()), (900, None), (901, ""), (902, items[5][1] + " word" * 50000), rows[1], rows[1]]
    bench = spark.createDataFrame([(*x, "s") for x in items], "item_id long, text string, doc_id string")
    got = decontam.leaks(docs(spark, rows), bench, block_bytes=900)
    want = leaks_brute(rows, items)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 40
    bad = {x[0] for x in want}
    kept = decontam.drop_leaks(docs(spark, rows), bench)
    assert kept.columns == ["doc_id", "text", "n", "cls"]
    assert sorted(map(repr, (x.doc_id for x in kept.collect()))) == sorted(repr(d) for d, _ in rows if d not in bad)
    empty = bench.where("false")
    assert decontam.leaks(docs(spark, rows), empty).count() == 0 and decontam.drop_leaks(docs(spark, rows), empty).count() == len(rows)
    assert decontam.leaks(docs(spark, []), bench).count() == 0


@pytest.mark.parametrize("m", [1, 5, 63, 64, 65, 200])
def test_myers_equals_the_table(m):
    r = random.Random(m)
    for _ in range(12):
        pattern, text = [r.randint(0, 3) for _ in range(m)], [r.randint(0, 3) for _ in range(r.randint(0, 2 * m + 9))]
        assert decontam.myers_best(np.array(pattern), np.array(text)) == best_distance(pattern, text)


# --- main text ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return htmltext.train(htmltext.sample_pages())


def blocks(source):
    return [(p.tag[v], t) for p in [htmltext.parse(source)] for v, t in p.blocks]


def test_parser():
    assert blocks("<p>a<p>b<div>c</div>d") == [("p", "a"), ("p", "b"), ("div", "c"), ("#root", "d")]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul></ul>") == [("li", "a"), ("li", "b"), ("li", "c")]
    assert blocks("<p>a &amp; b&nbsp;&#233;\n <b>c</b>d<br>e</p>") == [("p", "a & b é cd e")]
    assert blocks("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>x --><p>y</p><title>z</title>") == [("p", "y")]
    assert blocks("a < b <p title='>'>c</p></div></p>") == [("#root", "a < b"), ("p", "c")]
    assert blocks("<p>a<script>never closed") == [("p", "a")] and blocks("") == [] and blocks("<!-- open") == []
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == [("td", "a"), ("td", "b"), ("td", "c")]


def test_text_before_the_trees():
    assert blocks("<html><head><title>x</title><meta name=a><body><article><p>a</article>") == [("p", "a")]
    assert blocks("<head><title>x</title><p>a") == [("p", "a")] and blocks("<html><head><title>x</title>a<p>b") == [("html", "a"), ("p", "b")]
    assert blocks("<head><script>x</script> <link><style>y</style></head><p>a") == [("p", "a")]
    assert blocks('<p>a <svg viewBox="0 0 1 1"/>b <math/>c') == [("p", "a b c")]
    assert blocks("<p>a <svg><title/><path d='x'/>no</svg>b</p>") == [("p", "a b")] and blocks("<p>a<svg width=1/>no</svg>b") == [("p", "ab")]


def test_root_blocks_are_scored(model):
    prose = "Some words of a text that stands here on its own, without a tag around it. It goes on for two sentences."
    pages = [prose, f"<h1>Title</h1>{prose}", f"<html><body><article><p>{prose}</p></article></body></html>and more"]
    got = htmltext.main_texts(pages, model)
    assert got[0] == prose and prose in got[1] and got[2] == f"{prose}\n\nand more"
    assert got[:2] == htmltext.main_texts([f"<html><body>{x}</body></html>" for x in pages[:2]], model)
    page = htmltext.rooted(htmltext.parse("a<div>b<p>c</div>d"))
    assert (page.tag, page.parent, page.depth, page.text, page.blocks) == (["#root", "html", "body", "div", "p"], [-1, 0, 1, 2, 3], [0, 1, 2, 3, 4], [0, 0, 2, 1, 1], [(2, "a"), (3, "b"), (4, "c"), (2, "d")])
    assert htmltext.rooted(htmltext.parse("<html><body><p>b</body></html>a")).blocks == [(3, "b"), (2, "a")]


PAGE = """<html><head><title>T</title></head><body><header><a href=/>Site</a></header><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy now!</div><article><h1>Title &amp; more</h1><p>First  paragraph of the
article, with some words.<p>Second <b>one</b>.</p><div class="advert">Buy this</div><p>Third paragraph here.</p></article>
<div id="sidebar"><h3>Related</h3><ul><li><a href=/c>Other story</a></li></ul></div><form><label>Mail</label></form>
<section id="comments"><div class="comment"><p>Nice words from a reader who liked it.</p></div></section><footer>&copy; 2020 Site</footer></body></html>"""


def test_a_page(spark, model):
    rows = [(1, PAGE, "u"), (2, None, "u"), (3, "", None), (4, "<p>", "u"), (None, PAGE, "u"), (1, PAGE, "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, url string").withColumn("main", F.lit(3)).repartition(2)
    out = htmltext.extract_text(df, output="text", model=model)
    assert out.columns == ["page_id", "url", "main", "text"]
    want = "Title & more\n\nFirst paragraph of the article, with some words.\n\nSecond one.\n\nThird paragraph here."
    assert sorted(((r.page_id, r.text) for r in out.collect()), key=repr) == sorted([(1, want), (2, ""), (3, ""), (4, ""), (None, want), (1, want)], key=repr)
    assert htmltext.extract_text(df.where("false"), model=model).count() == 0


def test_held_out_pages(model):
    pages = htmltext.sample_pages(250, 99)
    want = ["\n\n".join(t for _, t in htmltext.parse(s).blocks if htmltext.MARK in t) for s in pages]
    got = htmltext.main_texts(pages, model)
    assert sum(a == b for a, b in zip(want, got, strict=True)) / len(pages) > 0.9


def test_decoding_equals_brute_force():
    r = random.Random(6)
    for _ in range(40):
        page = htmltext.Page()
        for v in range(1, r.randint(2, 10)):
            page.tag.append("p")
            page.parent.append(r.randrange(v))
        n = len(page.tag)
        logit = [0.0, *(r.uniform(-2, 2) for _ in range(n - 1))]
        options = [k for k in itertools.product([False, True], repeat=n) if k[0] and all(k[page.parent[v]] or not k[v] for v in range(1, n))]
        best = max(options, key=lambda k: sum(x for x, keep in zip(logit, k, strict=True) if keep))
        assert htmltext.decode(page, logit) == list(best)


def test_pages_of_the_data(spark, sf_dir, model):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    good = 0
    for r, got in zip(rows, htmltext.main_texts([x.html for x in rows], model), strict=True):
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(htmltext.entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:h1|p)>", body)]
        good += got == "\n\n".join(x for x in parts if x)
    assert good / len(rows) > 0.98


# --- toxicity -----------------------------------------------------------------------------------


def toxic_corpus(seed, count):
    r = random.Random(seed)
    vocabulary = [word(r) + word(r) for _ in range(200)]
    bad = ["vileword", "rottenones", "rottenest"]
    texts, labels = [], []
    for i in range(count):
        sents = [" ".join(r.choice(vocabulary) for _ in range(r.randint(3, 12))) for _ in range(r.randint(1, 9))]
        toxic = r.random() < 0.2
        if toxic:
            k = r.randrange(len(sents))
            sents[k] += " " + r.choice(bad) + " it"
        texts.append((i, ". ".join(sents) + "."))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity_of_held_out_rows(spark):
    texts, labels = toxic_corpus(0, 900)
    texts += [(2000, None), (2001, ""), (None, texts[0][1]), (2002, "vileword"), (2003, "fine words here. " * 30000 + "vileword"), texts[1], texts[1]]
    marks = [*labels, labels[5], (7, 1 - labels[7][1]), (None, 1), (8, None), (3000, 1)]
    lab = spark.createDataFrame([(*x, "t") for x in marks], "doc_id long, toxic int, text string")
    df = docs(spark, texts)
    model = toxicity.fit(df, lab)
    out = toxicity.score_toxicity(df, model).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert (got[2000].score, got[2001].score, got[2000].worst_sentence) == (0.0, 0.0, None)
    test = [(i, y) for i, y in labels if held(i)]
    assert all(got[i].held_out == held(i) for i, _ in labels)
    assert sum(got[i].predicted == y for i, y in test) / len(test) > 0.95
    assert got[2002].score > 0.5
    spans = toxicity.offending_sentences(docs(spark, [(1, "Éa good. So vileword ü it!\nEnd"), (2, None)]), model).collect()
    assert [(r.doc_id, r.sentence, r.start, r.end) for r in spans] == [(1, 1, 8, 26)]
    clean = toxicity.drop_toxic(df, model)
    assert clean.columns == df.columns and clean.count() == sum(r.predicted == 0 for r in out)


def test_noisy_or():
    z = np.array([-1.0, 2.0, 0.0, -30.0])
    p = 1 / (1 + np.exp(-z))
    got = toxicity.noisy_or(z, np.array([0, 0, 1, 1]), 3)
    assert got == pytest.approx([1 - (1 - p[0]) * (1 - p[1]), 1 - (1 - p[2]) * (1 - p[3]), 0.0])


def test_labels_of_one_kind(spark):
    df = docs(spark, [(1, "a"), (2, "b")])
    lab = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    assert model is None and max(r.score for r in toxicity.score_toxicity(df, model).collect()) < 1e-9
    assert toxicity.fit(df, lab.where("false")) is None and toxicity.drop_toxic(df, None).count() == 2
    assert toxicity.score_toxicity(df.where("false"), None).count() == 0


def test_repeated_words_are_linear():
    """Each word of a text meets an item's distance once, however often the item's pieces occur."""
    import time

    items = decontam.prepare([1, 2], ["word " * 12, "one two three four five six seven eight nine ten"], 8, 8)
    took = {}
    for n in (4_000, 64_000):
        text = "word " * n + "one two three for five six seven eight nine ten"
        began = time.perf_counter()
        for _, h, word_of in decontam.word_ids(pa.array([text])):
            found = decontam._matches(items, h, word_of)
        took[n] = time.perf_counter() - began
        assert found == {(0, 0): (0, 12), (0, 1): (1, n + 10)}
    assert took[64_000] < 64 * took[4_000]


# Written by hand, not by the generator that the trees learn from: (page, main text, texts that must not come).
BY_HAND = [
    ("<html><head><title>t</title><body><article><h1>Title</h1><p>The first paragraph tells of rivers, bridges and boats.<p>The second tells of the sea.</article>", "Title\n\nThe first paragraph tells of rivers, bridges and boats.\n\nThe second tells of the sea.", []),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given, so the sum is four, as was to be shown.</p></article>", "Let x=2 be given, so the sum is four, as was to be shown.", []),
    ("<body><div class=article><p>A drawing <svg><text>of a ship</text></svg> stands here, beside a long account of its voyage.</p></div></body>", "A drawing stands here, beside a long account of its voyage.", ["ship"]),
    ("<body><nav><a href=/>Home</a> <a href=/b>Blog</a></nav><main><h2>News</h2><p>Rain fell all night, and the river rose by a metre.</p></main><footer>&copy; 2020 Us</footer></body>", "News\n\nRain fell all night, and the river rose by a metre.", ["Home", "2020"]),
    ("<body><article><p>Text of the piece, which goes on for a while, and ends.</p></article><section class=comments><h3>Comments</h3><div class=comment><p>I do not agree with this at all.</p></div></section></body>", "Text of the piece, which goes on for a while, and ends.", ["agree"]),
    ("<body><div id=content><p>One <b>bold</b> word &amp; one <i>slanted</i>, and then some more of the same kind.</p><script>var a = '<p>no</p>';</script><style>p {}</style></div></body>", "One bold word & one slanted, and then some more of the same kind.", ["var", "{}"]),
    ("<body><article><ul><li>First thing to bring along<li>Second thing to bring along</ul><p>That is all one needs for the walk.</article></body>", "First thing to bring along\n\nSecond thing to bring along\n\nThat is all one needs for the walk.", []),
    ("<body><main><p>Choose well, and read the notes before.</p><form><select><option>one</option></select><textarea>write</textarea><button>Send</button></form></main></body>", "Choose well, and read the notes before.", ["Send", "write", "one"]),
    ("<body><article><h1>Trees</h1><blockquote>Old oaks stand by the road, said the guide.</blockquote><table><tr><td>Oak</td><td>300 years</td></tr></table><p>They were planted long ago, before the town grew.</p></article></body>", "Trees\n\nOld oaks stand by the road, said the guide.\n\nOak\n\n300 years\n\nThey were planted long ago, before the town grew.", []),
    ("<body><header><h1>Daily Post</h1></header><div class='post-body'><p>The council met on Monday, and voted for the bridge.</p><p>Work begins in spring.</p></div><aside class=sidebar><ul><li><a href=#>Other news</a></li></ul></aside></body>", "The council met on Monday, and voted for the bridge.\n\nWork begins in spring.", ["Other", "Daily"]),
]


def test_pages_by_hand(model):
    got = htmltext.main_texts([page for page, _, _ in BY_HAND], model)
    assert [t for t, (_, want, _) in zip(got, BY_HAND, strict=True) if t != want] == []
    assert not [bad for t, (_, _, out) in zip(got, BY_HAND, strict=True) for bad in out if bad in t]


def test_parse_is_linear():
    import time

    took = {}
    for n in (2_000, 32_000):
        began = time.perf_counter()
        page = htmltext.parse("<b>x" * n + "</i>" * n + "<p>y" * n + "<li>z" * n)
        took[n] = time.perf_counter() - began
        assert len(page.tag) == 1 + 2 * n
    assert took[32_000] < 64 * took[2_000]
