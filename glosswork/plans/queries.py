"""The driver's queries: every operator applied to whole tables of the driver, with SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glosswork.functions import domain as D
from glosswork.functions import text as T
from glosswork.operators import dossier, gates, ordered, search, witness
from glosswork.operators.assemble import merge_wrapped
from glosswork.operators.lines import ends_with_labels, sub_entry_signal
from glosswork.plans.catalog import composite_closure, neighbours
from glosswork.plans.ingest import mint_slugs
from glosswork.sources.files import shard_of, sitemap
from glosswork.streaming.harvest import latest_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as dictionary entries: names as readings, brands as glyphs."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("reading"), T.fold(F.col("p_name")).alias("reading_norm"), F.col("p_brand").alias("glyph"), F.col("p_type").alias("gloss"))
    return search.search_document(rows, {"A": "reading", "B": "gloss", "C": "glyph"})


# DuckDB pieces
FOLD = "lower(translate(strip_accents({0}), 'đĐ', 'dD'))"
NAME_STEM = "regexp_replace(regexp_replace(" + FOLD.format("p_name") + ", '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"
TRIGRAMS = "list_distinct(flatten(list_transform(regexp_extract_all(" + FOLD.format("{0}") + ", '[\\p{{L}}\\p{{N}}]+'), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
WORDS = "' ' || array_to_string(regexp_extract_all(" + FOLD.format("{0}") + ", '[\\p{{L}}\\p{{N}}]+'), ' ') || ' '"
# The comparison key of two editions; the driver's texts hold no templates or links.
WITNESS = "trim(regexp_replace(lower(translate(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]*(>|$)|>', '', 'g'), '''{{2,}}', '', 'g'), '[|―—–-]+', '@', 'g'), '.,;:!?()\"''«»', '            ')), '\\s+', ' ', 'g'))"


def _similar(column: str, other: str) -> str:
    a, b = TRIGRAMS.format(column), TRIGRAMS.format(other)
    return f"(len(list_intersect({a}, {b}))::DOUBLE / nullif(len(list_distinct(list_concat({a}, {b}))), 0))"


# --- text and projections -------------------------------------------------------


@query(f"SELECT doc_id, md5({FOLD.format('text')}) AS folded FROM documents")
def fold_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded"))


@query(f"SELECT p_partkey, CASE WHEN n = 1 THEN stem ELSE stem || '-' || n END AS slug FROM (SELECT p_partkey, {NAME_STEM} AS stem, row_number() OVER (PARTITION BY {NAME_STEM} ORDER BY p_partkey) AS n FROM part)")
def slug_mint(spark, sf_dir):
    return mint_slugs(table(spark, sf_dir, "part"), "p_name", "p_partkey").select("p_partkey", "slug")


@query(r"SELECT lang, sum(length(regexp_replace(text, '\s', '', 'g')))::BIGINT AS visible, count(*)::BIGINT AS n FROM documents GROUP BY lang")
def visible_len(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(T.visible_length(F.col("text"))).cast("long").alias("visible"), F.count("*").alias("n"))


@query(r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    t AS (SELECT *, trim(line) AS own, line LIKE '%.' AS stop FROM l),
    r AS (SELECT lang, CASE WHEN length(own) = 0 THEN 'page_number' WHEN length(own) <= 6 THEN 'section_title'
        WHEN regexp_matches(own, '(^|\s)(token|secret|password)( |:|=)') THEN 'headword'
        WHEN stop AND regexp_matches(own, '[―—–|]|--') THEN 'sub_entry' ELSE 'continuation' END AS role,
        CASE WHEN stop AND regexp_matches(own, '[―—–|]|--') THEN 'both' WHEN stop THEN 'italic_only'
             WHEN regexp_matches(own, '[―—–|]|--') THEN 'placeholder_only' ELSE 'neither' END AS signal
        FROM t JOIN documents USING (doc_id))
    SELECT lang, role, signal, count(*)::BIGINT AS n FROM r GROUP BY ALL
""")
def line_roles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "\n", -1)).alias("line"))
    own, stop = F.trim("line"), F.col("line").endswith(".")
    mark = T.has_placeholder(own)
    role = (
        F.when(F.length(own) == 0, "page_number").when(F.length(own) <= 6, "section_title").when(own.rlike(r"(^|\s)(token|secret|password)( |:|=)"), "headword").when(stop & mark, "sub_entry").otherwise("continuation")
    )
    return docs.select("lang", role.alias("role"), sub_entry_signal(stop, mark).alias("signal")).groupBy("lang", "role", "signal").agg(F.count("*").alias("n"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    r AS (SELECT *, regexp_extract(line, '(\s+((of|the)\.|(cn\.|c\.|n\.)+))+\s*$') AS run FROM l)
    SELECT doc_id, count(*)::BIGINT AS n FROM r WHERE regexp_matches(run, '\s(of|the)\.') AND NOT regexp_matches(left(line, length(line) - length(run)), '[cn]\.$') GROUP BY doc_id""")
def label_whole(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    # The label rule on two words of the corpus: each word of a run is put in place of a label.
    labelled = F.regexp_replace("line", r"(?<=\s)(?:of|the)\.(?=(?:\s+(?:(?:of|the)\.|(?:cn\.|c\.|n\.)+))*\s*\z)", "n.")
    kept = rows.where(ends_with_labels(labelled) & (labelled != F.col("line")))
    return kept.groupBy("doc_id").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'left' ELSE 'right' END AS side, round(l_extendedprice, 2) AS price FROM lineitem")
def column_whole(spark, sf_dir):
    from glosswork.operators.layout import column_of

    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", column_of(F.col("l_quantity"), F.lit(20.0)).alias("side"), F.round("l_extendedprice", 2).alias("price"))


@query("""WITH n AS (SELECT o_orderkey, 1 + (o_orderkey % 1038) AS page FROM orders)
    SELECT o_orderkey, page::INT AS page, (CASE WHEN page BETWEEN 3 AND 9 THEN page WHEN page >= 11 THEN page - 1 END)::INT AS printed,
      CASE WHEN page BETWEEN 3 AND 9 THEN page::VARCHAR WHEN page >= 11 THEN (page - 1)::VARCHAR ELSE 'pdf-' || page END AS address, page::INT AS back FROM n""")
def page_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (1 + F.col("o_orderkey") % 1038).cast("int").alias("page"))
    address = D.page_address(F.col("page"))
    return rows.select("o_orderkey", "page", D.printed_page(F.col("page")).alias("printed"), address.alias("address"), D.page_of_address(address).alias("back"))


@query("""SELECT o_orderkey, regexp_replace(reverse(regexp_replace(reverse((o_orderkey * 1237)::VARCHAR), '(\\d{3})', '\\1.', 'g')), '^\\.', '') AS grouped,
    (DATE '1970-01-01' + (o_orderkey % 20000)::INT)::DATE AS day FROM orders""")
def numbers_and_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", T.thousands(F.col("o_orderkey") * 1237).alias("grouped"), T.civil_date((F.col("o_orderkey") % 20000).cast("int")).alias("day"))


@query("SELECT page_id, replace(replace(url_encode(url), '+', '%20'), '*', '%2A') AS encoded FROM pages")
def encoded_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.percent_encode(F.col("url")).alias("encoded"))


@query(r"""WITH f AS (SELECT doc_id, lang, source, text, regexp_replace(text, '--|[―—–]', lang, 'g') AS expanded FROM documents)
    SELECT doc_id, md5(expanded) AS expanded, (len(string_split_regex(text, '--|[―—–]')) - 1)::INT AS substitutions,
    (length(expanded) - length(replace(expanded, '|', '')))::INT AS residual, replace(source, 's', lang) AS han FROM f""")
def expand_forms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    form = T.expand_reading(F.col("text"), F.col("lang"))
    return docs.select("doc_id", F.md5(form["value"]).alias("expanded"), form["substitutions"].alias("substitutions"), form["residual"].alias("residual"), T.expand_han(F.replace("source", F.lit("s"), F.lit("|")), F.col("lang")).alias("han"))


# --- ordered sequences ------------------------------------------------------------


@query("""SELECT o_orderkey, sum((o_orderstatus = 'F')::BIGINT) OVER (ORDER BY o_orderkey)::BIGINT AS entry_no,
    last_value(CASE WHEN o_orderstatus = 'F' THEN o_custkey END IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS context FROM orders""")
def ordered_stream(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("orders").alias("book"), F.floor(F.col("o_orderkey") / 256).alias("page"))
    head = F.col("o_orderstatus") == "F"
    out = ordered.running_sums(rows, {"entry_no": head.cast("long")}, order="o_orderkey")
    return ordered.carry_forward(out, "context", F.when(head, F.col("o_custkey")), order="o_orderkey").select("o_orderkey", "entry_no", "context")


@query("""
    WITH c AS (SELECT *, (event_type IS DISTINCT FROM lag(event_type) OVER w)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM c)
    SELECT user_id, run::BIGINT AS run, min(event_type) AS event_type, count(*)::BIGINT AS n FROM r GROUP BY user_id, run
""")
def runs(spark, sf_dir):
    rows = ordered.islands(table(spark, sf_dir, "events"), "run", F.col("event_type"), by=["user_id"], order=["ts", "event_id"])
    return rows.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"))


@query("""
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS def FROM events),
    i AS (SELECT *, coalesce(sum((def <> '')::INT) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM s)
    SELECT user_id, max(rn)::BIGINT AS rn, string_agg(event_type, ' ' ORDER BY rn) AS form, arg_max(def, rn) AS definition, bool_or(value > 100) AS needs_review, (count(*) - 1)::BIGINT AS merged
    FROM i GROUP BY user_id, island
""")
def wrapped_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long"))
    rows = e.select(
        "user_id", "rn", F.lit(None).cast("string").alias("han_form"), F.lit(None).cast("string").alias("han_expanded"), F.col("event_type").alias("form"), F.col("event_type").alias("form_expanded"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("definition"), (F.col("value") > 100).alias("needs_review"),
    )
    return merge_wrapped(rows, ["user_id"], "rn").select("user_id", "rn", "form", "definition", "needs_review", "merged")


@query("""
    WITH r AS (SELECT c_nationkey, c_custkey, strpos('ABCDĐEGHYKLMNOPQRSTUVX', CASE upper(substr(c_mktsegment, 1, 1)) WHEN 'I' THEN 'Y' ELSE upper(substr(c_mktsegment, 1, 1)) END) AS k FROM customer),
    l AS (SELECT *, lag(k) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS p FROM r WHERE k > 0)
    SELECT c_custkey, 'inversion' AS fault FROM l WHERE k < p UNION ALL SELECT c_custkey, 'unknown' FROM r WHERE k = 0
""")
def collation_inversions(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("reading", F.col("c_mktsegment"))
    return gates.collation_faults(rows, ["c_nationkey"], "c_custkey").select("c_custkey", "fault")


@query("SELECT o_orderkey AS k, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous, lead(o_orderkey) OVER (ORDER BY o_orderkey) AS next FROM orders")
def neighbours_of_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit("orders").alias("book"), F.floor(F.col("o_orderkey") / 256).alias("page"))
    before = ordered.previous_value(rows, "previous", F.col("k"), order="k")
    mirrored = rows.select((-F.col("k")).alias("m"), "k", "book", (-F.col("page")).alias("page"))
    after = ordered.previous_value(mirrored, "next", F.col("k"), order="m").select("k", "next")
    return before.select("k", "previous").join(after, "k")


@query("""SELECT seq, lag(slug) OVER (ORDER BY seq) AS previous, lead(slug) OVER (ORDER BY seq) AS next FROM (SELECT row_number() OVER (ORDER BY p_partkey) AS seq, p_name AS slug FROM part)""")
def dense_neighbours(spark, sf_dir):
    # p_partkey is dense from 1 (or 0), so it is the order itself.
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("slug"))
    least = rows.agg(F.min("seq").alias("least"))
    out = neighbours(rows).crossJoin(F.broadcast(least))
    return out.select((F.col("seq") - F.col("least") + 1).alias("seq"), "previous", "next")


# --- joins, sets, dossiers ----------------------------------------------------------


@query("""
    WITH a AS (SELECT p_brand, list_sort(list(DISTINCT p_size)) AS ours FROM part WHERE p_partkey % 2 = 0 GROUP BY p_brand),
    b AS (SELECT p_brand, list_sort(list(DISTINCT p_size)) AS theirs FROM part WHERE p_partkey % 2 = 1 GROUP BY p_brand)
    SELECT coalesce(a.p_brand, b.p_brand) AS glyph, len(ours)::INT AS n_ours, len(theirs)::INT AS n_theirs,
      CASE WHEN b.p_brand IS NULL THEN 'invented' WHEN a.p_brand IS NULL THEN 'missed' WHEN ours = theirs THEN 'same' ELSE 'differing' END AS verdict FROM a FULL JOIN b ON a.p_brand = b.p_brand
""")
def reconcile_sets(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("glyph"), F.col("p_size").cast("string").alias("reading"), "p_partkey")
    index = p.where("p_partkey % 2 = 1").groupBy("glyph").agg(F.array_join(F.collect_set("reading"), " , ").alias("readings")).withColumn("row_no", F.lit(1))
    out = gates.reconcile_index(p.where("p_partkey % 2 = 0"), index)
    return out.select("glyph", F.when(F.col("ours").isNotNull(), F.size("ours")).alias("n_ours"), F.when(F.col("theirs").isNotNull(), F.size("theirs")).alias("n_theirs"), "verdict")


@query("""SELECT doc_id, 'undocumented' AS fault FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'stale' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def dossier_anti(spark, sf_dir):
    return gates.documented(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'q' || l.toxic END, '') AS verified_by FROM documents d LEFT JOIN labels l USING (doc_id)""")
def dossier_upsert(spark, sf_dir):
    new = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id")
    old = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"), F.when(F.col("quality") == 1, F.concat(F.lit("q"), F.col("toxic").cast("string"))).otherwise("").alias("verified_by"), F.lit(0).alias("row_no"))
    return dossier.upsert(new, old).select("doc_id", "verified_by")


@query("""SELECT 'labels' AS dossier, count(*)::BIGINT AS "rows", count(*) FILTER (quality = 0)::BIGINT AS unsigned FROM labels
    UNION ALL SELECT 'nation', count(*), count(*) FILTER (n_regionkey = 0) FROM nation""")
def dossier_totals(spark, sf_dir):
    a = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "x").otherwise(" ").alias("verified_by"))
    b = table(spark, sf_dir, "nation").select(F.when(F.col("n_regionkey") != 0, "x").otherwise("").alias("verified_by"))
    return dossier.totals({"labels": a, "nation": b})


@query("SELECT DISTINCT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def contains_whole(spark, sf_dir):
    # Forty pages only deal the documents out: the reach spans them all from the items' page.
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(40)).alias("page"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_no"), F.lit(20).cast("long").alias("page"), "text")
    return dossier.by_page_range(docs, items, reach=20).select(F.col("seq").alias("doc_id"), F.col("row_no").alias("item_id"))


@query("""
    SELECT n.n_nationkey, (count(s.s_suppkey) <> 1 OR coalesce(sum((s.s_acctbal > 5000)::INT), 0) <> 1) AS failed
    FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey AND contains(s.s_name, '1') GROUP BY n.n_nationkey
""")
def exactly_one(spark, sf_dir):
    errata = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("row_no"), F.col("n_nationkey").cast("string").alias("source"), F.lit(0).alias("page"), F.lit("glyph").alias("kind"), F.col("n_nationkey").cast("string").alias("reading"), F.lit("1").alias("anchor"), F.lit("").alias("printed"), F.lit("rich").alias("corrected"), F.lit("").alias("reason")
    )
    found = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("reading"), F.col("s_name").alias("gloss"), F.when(F.col("s_acctbal") > 5000, "rich").otherwise("poor").alias("glyph"))
    texts = found.select(F.col("gloss").alias("text"))
    return gates.errata_verdicts(found, texts, errata).select(F.col("row_no").alias("n_nationkey"), "failed")


@query("""
    WITH RECURSIVE oa AS (SELECT s_suppkey AS k, s_nationkey AS key, CASE WHEN s_acctbal > 5000 THEN 'A' ELSE 'B' END AS glyph, row_number() OVER (ORDER BY s_suppkey) AS p FROM supplier),
    ob AS (SELECT c_custkey AS k, c_nationkey AS key, substr(c_mktsegment, 1, 1) AS glyph, row_number() OVER (ORDER BY c_custkey) AS p FROM customer),
    na AS (SELECT *, (key IS DISTINCT FROM lag(key) OVER (ORDER BY p))::INT AS new FROM oa), nb AS (SELECT *, (key IS DISTINCT FROM lag(key) OVER (ORDER BY p))::INT AS new FROM ob),
    ra AS (SELECT *, sum(new) OVER (ORDER BY p) AS run FROM na), rb AS (SELECT *, sum(new) OVER (ORDER BY p) AS run FROM nb),
    ea AS (SELECT *, max(p) OVER (PARTITION BY run) + 1 AS past FROM ra), eb AS (SELECT *, max(p) OVER (PARTITION BY run) + 1 AS past FROM rb),
    l AS (SELECT (SELECT list(key ORDER BY p) FROM ea) AS a, (SELECT list(past ORDER BY p) FROM ea) AS pa, (SELECT list(key ORDER BY p) FROM eb) AS b, (SELECT list(past ORDER BY p) FROM eb) AS pb),
    w(i, j) AS (
        SELECT 1::BIGINT, 1::BIGINT UNION ALL
        SELECT CASE WHEN same THEN pi WHEN db IS NOT NULL AND db <= coalesce(da, 99) THEN i WHEN da IS NOT NULL THEN i + da ELSE i + 1 END::BIGINT,
               CASE WHEN same THEN pj WHEN db IS NOT NULL AND db <= coalesce(da, 99) THEN j + db WHEN da IS NOT NULL THEN j ELSE j + 1 END::BIGINT
        FROM (SELECT i, j, a[i] = b[j] AS same, pa[i] AS pi, pb[j] AS pj, nullif(list_position(b[j+1:j+12], a[i]), 0) AS db, nullif(list_position(a[i+1:i+12], b[j]), 0) AS da
            FROM w, l WHERE i <= len(a) AND j <= len(b))),
    m AS (SELECT ea.run AS x, eb.run AS y, w.i, w.j FROM w JOIN ea ON ea.p = w.i JOIN eb ON eb.p = w.j WHERE ea.key = eb.key),
    ga AS (SELECT x, k, glyph, row_number() OVER (PARTITION BY x, glyph ORDER BY k) AS n FROM m JOIN ea ON run = x AND p >= i), gb AS (SELECT x, k, glyph, row_number() OVER (PARTITION BY x, glyph ORDER BY k) AS n FROM m JOIN eb ON run = y AND p >= j),
    e AS (SELECT ga.k AS ka, gb.k AS kb FROM ga JOIN gb USING (x, glyph, n)),
    la AS (SELECT x, k, row_number() OVER (PARTITION BY x ORDER BY k) AS n FROM ga WHERE k NOT IN (SELECT ka FROM e)), lb AS (SELECT x, k, row_number() OVER (PARTITION BY x ORDER BY k) AS n FROM gb WHERE k NOT IN (SELECT kb FROM e)),
    pairs AS (SELECT ka, kb FROM e UNION ALL SELECT la.k, lb.k FROM la JOIN lb USING (x, n))
    SELECT ka, kb FROM pairs UNION ALL SELECT k, NULL FROM oa WHERE k NOT IN (SELECT ka FROM pairs) UNION ALL SELECT NULL, k FROM ob WHERE k NOT IN (SELECT kb FROM pairs)
""")
def edition_alignment(spark, sf_dir):
    # Two ordered lists of nations: those of the suppliers and those of the customers.
    ours = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seq"), F.col("s_nationkey").cast("string").alias("reading"), F.when(F.col("s_acctbal") > 5000, "A").otherwise("B").alias("glyph"))
    theirs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_nationkey").cast("string").alias("reading"), F.left("c_mktsegment", F.lit(1)).alias("glyph_field"))
    pairs, left, right = witness.align(ours, theirs)
    none = F.lit(None).cast("long")
    out = pairs.select(F.col("our_seq").alias("ka"), F.col("their_seq").alias("kb"))
    return out.unionByName(left.select(F.col("seq").alias("ka"), none.alias("kb"))).unionByName(right.select(none.alias("ka"), F.col("seq").alias("kb")))


@query(f"""
    WITH t AS (SELECT conv_id % 20 AS pair, conv_id, turn, role, {WITNESS.format('text')} AS d, {WITNESS.format('split_part(text, chr(10), 1)')} AS f FROM conversations),
    a AS (SELECT *, count(*) OVER (PARTITION BY pair, d) AS nd, count(*) OVER (PARTITION BY pair, f) AS nf FROM t WHERE role = 'user'),
    b AS (SELECT *, count(*) OVER (PARTITION BY pair, d) AS nd, count(*) OVER (PARTITION BY pair, f) AS nf FROM t WHERE role <> 'user')
    SELECT a.conv_id AS conv_a, a.turn AS turn_a, coalesce(x.conv_id, y.conv_id) AS conv_b, CASE WHEN x.conv_id IS NOT NULL THEN x.turn ELSE y.turn END AS turn_b
    FROM a LEFT JOIN b x ON a.pair = x.pair AND a.d = x.d AND a.nd = 1 AND x.nd = 1 AND length(a.d) >= 12
        LEFT JOIN b y ON a.pair = y.pair AND a.f = y.f AND a.nf = 1 AND y.nf = 1 WHERE x.conv_id IS NOT NULL OR y.conv_id IS NOT NULL
""")
def partner_whole(spark, sf_dir):
    # A turn as a sub-entry: its whole text is the definition, its first line the form.
    c = table(spark, sf_dir, "conversations")
    rows = c.select((F.col("conv_id") % 20).alias("seq"), F.struct("conv_id", "turn").alias("at"), "role", F.col("text").alias("definition"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("form"))
    pairs = rows.select(F.col("seq").alias("our_seq"), F.col("seq").alias("their_seq")).distinct()
    out = witness.partners(pairs, rows.where("role = 'user'").withColumnRenamed("at", "sub_seq"), rows.where("role <> 'user'").withColumnRenamed("at", "sub_no"))
    return out.select(F.col("sub_seq.conv_id").alias("conv_a"), F.col("sub_seq.turn").alias("turn_a"), F.col("sub_no.conv_id").alias("conv_b"), F.col("sub_no.turn").alias("turn_b"))


@query("""
    WITH RECURSIVE e AS (
        SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst FROM customer UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'n' || r_regionkey FROM region),
    c(root, node) AS (SELECT DISTINCT src, src FROM e WHERE src LIKE 'c%' OR src LIKE 's%' UNION SELECT c.root, e.dst FROM c JOIN e ON c.node = e.src)
    SELECT root, node FROM c
""")
def component_closure(spark, sf_dir):
    def edge(name, kind, src, to, dst):
        return table(spark, sf_dir, name).select(F.concat(F.lit(kind), F.col(src).cast("string")).alias("src"), F.concat(F.lit(to), F.col(dst).cast("string")).alias("dst"))

    # Regions lead back to nations, so there are cycles.
    lower = edge("customer", "c", "c_custkey", "n", "c_nationkey").unionByName(edge("supplier", "s", "s_suppkey", "n", "s_nationkey"))
    edges = lower.unionByName(edge("nation", "n", "n_nationkey", "r", "n_regionkey")).unionByName(edge("region", "r", "r_regionkey", "n", "r_regionkey"))
    return composite_closure(edges, lower.select(F.col("src").alias("node")).distinct())


# --- aggregates, gates, services -----------------------------------------------------


@query("""SELECT event_type AS role, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS percent FROM events GROUP BY event_type""")
def roles_histogram(spark, sf_dir):
    return gates.roles_report(table(spark, sf_dir, "events").select(F.col("event_type").alias("role")))


@query("""
    WITH m AS (SELECT 1 AS gate, (SELECT count(*) FROM documents WHERE text IS NULL) AS measured, 0 AS allowed UNION ALL
        SELECT 2, (SELECT count(*) FROM documents WHERE length(text) < 10), 0 UNION ALL
        SELECT 4, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), 0)
    SELECT gate, measured::BIGINT AS measured, allowed::BIGINT AS allowed, CASE WHEN measured = allowed THEN 'green' ELSE 'red' END AS status FROM m
    UNION ALL SELECT g, NULL, NULL, 'missing' FROM (VALUES (3), (5), (7), (8)) t(g)
""")
def gates_report(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    report = gates.gate_row(docs.agg(F.count_if(F.col("text").isNull()).alias("measured")), 1, 0).unionByName(gates.gate_row(docs.agg(F.count_if(F.length("text") < 10).alias("measured")), 2, 0))
    report = report.unionByName(gates.gate_row(docs.join(labels, "doc_id", "left_anti").agg(F.count("*").alias("measured")), 4, 0)).select("gate", "measured", "allowed", "status")
    absent = gates.gates_missing(report).select("gate", F.lit(None).cast("long").alias("measured"), F.lit(None).cast("long").alias("allowed"), F.lit("missing").alias("status"))
    return report.unionByName(absent)


@query("""SELECT doc_id, (length(text) - length(replace(text, '.', '')))::BIGINT AS stops, length(regexp_replace(text, '\\s', '', 'g'))::BIGINT AS visible FROM documents""")
def coverage_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.count_marks(F.col("text"), ".").cast("long").alias("stops"), T.visible_length(F.col("text")).cast("long").alias("visible"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 30 OFFSET 60")
def page_paging(spark, sf_dir):
    p = search.Page.of(3)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(p.offset).limit(p.size)


@query("SELECT floor((seq - 1) / 100)::INT AS shard, count(*)::BIGINT AS n, min(k) AS first_key, max(k) AS last_key FROM (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders) GROUP BY 1")
def shard_export(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit("o").alias("book"), F.floor(F.col("o_orderkey") / 256).alias("page"))
    placed = ordered.running_sums(rows, {"seq": F.lit(1)}, order="k")
    return placed.groupBy(shard_of(F.col("seq")).alias("shard")).agg(F.count("*").alias("n"), F.min("k").alias("first_key"), F.max("k").alias("last_key"))


@query("""
    WITH p(row_no, old, new, note) AS (VALUES (0, 'blue', 'azure', 'x'), (1, 'azure', 'Blue', 'y'), (2, 'red', 'blue', 'z'), (3, 'blue', 'BLUE', 'w'))
    SELECT row_no::INT AS row_no, 0 AS side, new AS text, note FROM p WHERE lower(old) = 'blue' UNION ALL SELECT row_no, 1, old, note FROM p WHERE lower(new) = 'blue' AND lower(old) <> 'blue'
""")
def bridge_lookup(spark, sf_dir):
    pairs = spark.createDataFrame([(0, "blue", "azure", "x"), (1, "azure", "Blue", "y"), (2, "red", "blue", "z"), (3, "blue", "BLUE", "w")], "row_no int, old string, new string, note string")
    return search.bridge(pairs, "Blüe").select("row_no", "side", "text", "note")


@query("""
    SELECT 'letter' AS kind, row_number() OVER (ORDER BY r_regionkey)::INT AS place, '/chu/' || r_name AS address FROM region
    UNION ALL SELECT 'page', row_number() OVER (ORDER BY n_nationkey)::INT, '/trang/' || n_nationkey FROM nation
    UNION ALL SELECT 'entry', row_number() OVER (ORDER BY p_partkey)::INT, '/muc/' || p_partkey FROM part
""")
def sitemap_rows(spark, sf_dir):
    letters = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("rank"), F.col("r_name").alias("name"))
    pages = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"), F.col("n_nationkey").cast("string").alias("address"))
    return sitemap(letters, pages, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_partkey").cast("string").alias("slug")))


@query("""SELECT quality, count(*)::BIGINT AS n FROM (SELECT url, arg_max(length(html), page_id) % 5 AS quality FROM pages GROUP BY url) GROUP BY quality""")
def harvest_provenance(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("title"), F.col("page_id").alias("revid"), (F.length("html") % 5).cast("long").alias("quality"))
    return latest_pages(pages).groupBy("quality").agg(F.count("*").alias("n"))


# --- search ------------------------------------------------------------------------------


@query(f"""
    WITH e AS (SELECT p_partkey AS seq, p_name AS reading, {FOLD.format('p_name')} AS norm, {WORDS.format('p_name')} || ' ' || {WORDS.format('p_type')} || ' ' || {WORDS.format('p_brand')} AS words FROM part),
    t AS (SELECT seq, reading, CASE WHEN reading = 'blue' THEN 0 WHEN starts_with(reading, 'blue') THEN 2 WHEN norm = 'blue' THEN 3 WHEN contains(words, ' blue ') THEN 4 WHEN {_similar('norm', "'blue'")} > 0.3 THEN 5 END AS tier FROM e)
    SELECT seq, reading, tier FROM t WHERE tier IS NOT NULL
""")
def search_tiers(spark, sf_dir):
    q = search.parse_query("blue")
    hits = search.ranked(entries_of_parts(spark, sf_dir), search.tier_conditions(q, reading=F.col("reading"), norm=F.col("reading_norm"), glyph=F.col("glyph"), words=F.col("words")))
    return hits.select("seq", "reading", "tier")


@query(f"""
    WITH e AS (SELECT p_partkey AS seq, {FOLD.format('p_name')} AS norm FROM part), s AS (SELECT seq, {_similar('norm', "'blu anvill'")} AS similarity FROM e)
    SELECT seq, round(similarity, 6) AS similarity FROM s WHERE similarity > 0.3 ORDER BY similarity DESC, seq LIMIT 8
""")
def trigram_suggest(spark, sf_dir):
    return search.suggest(entries_of_parts(spark, sf_dir), "blu anvill").select("seq", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT doc_id FROM documents WHERE contains({FOLD.format('text')}, 'reout')")
def fulltext_contains(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(search.folded_contains(F.col("text"), "Réout")).select("doc_id")


@query(f"""WITH w AS (SELECT doc_id, {WORDS.format('text')} AS words FROM documents)
    SELECT doc_id FROM w WHERE (contains(words, ' of the ') AND NOT contains(words, ' with ')) OR contains(words, ' que ')""")
def websearch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("words", F.concat(F.lit(" "), F.array_join(search.tokens(F.col("text")), " "), F.lit(" ")))
    return docs.where(search.full_text(F.col("words"), '"Of the" -with or que')).select("doc_id")


@query(f"SELECT token, count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({FOLD.format('text')}, '[\\p{{L}}\\p{{N}}]+')) AS token FROM documents) GROUP BY ALL) GROUP BY token")
def postings(spark, sf_dir):
    p = search.postings(table(spark, sf_dir, "documents"), "doc_id", "text")
    return p.groupBy("token").agg(F.count("*").alias("docs"), F.sum(F.size("positions")).cast("long").alias("total"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) = '' AS blank, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '''{2,}', '', 'g'), '\s+', ' ', 'g'))) AS plain
    FROM pages WHERE NOT contains(html, '{{') AND NOT contains(html, '[[') AND NOT regexp_matches(regexp_replace(html, '<[^>]*>', '', 'g'), '[<>]')""")
def wiki_text(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    # The SQL covers pages without templates, links and stray brackets; the driver's tables hold no others.
    plain = T.wiki_plain(F.col("html"))
    return p.select("page_id", (plain == "").alias("blank"), F.md5(plain).alias("plain"))
