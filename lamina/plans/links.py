"""Queries over joins that aren't plain equality, repairs, audits, engines and documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.calc.engines import LEAK_BOX, PNEUMATIC_TEST, SLEEVE, WELDED_PATCH
from lamina.calc.formula import column_name
from lamina.calc.model import fill, provenance, severity
from lamina.calc.units import convert
from lamina.operators import audit, curves, keys, layout, match, resolve, trees
from lamina.plans.base import pick, query, read, shown, sql_pick
from lamina.sources import documents, grids

# ---- joins -------------------------------------------------------------------------------------------------


@query("""WITH b AS (SELECT unnest(range(0, 5)) AS band), d AS (SELECT p_partkey, band, greatest(band * 12 - (p_size + 1), (p_size + 1) - (band * 12 + 6), 0) AS far FROM part, b)
    SELECT p_partkey, CAST(first(band ORDER BY far > 3, far, band) AS INTEGER) AS band FROM d GROUP BY 1""")
def runs_in_bands(spark, sf_dir):
    size = F.col("p_size").cast("double")
    runs = read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("run_no"), size.alias("x0"), (size + 2).alias("x1"))
    bands = runs.select("p_brand").distinct().select("p_brand", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("band"))
    bands = bands.withColumns({"b0": F.col("band") * 12.0, "b1": F.col("band") * 12.0 + 6.0})
    return match.in_bands(runs, bands, ["p_brand"]).select(F.col("run_no").alias("p_partkey"), "band")


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS page, l_linenumber AS n FROM lineitem)
    SELECT t.page, t.n, 'caption ' || max(c.n) AS caption FROM l t LEFT JOIN l c ON c.page = t.page AND c.n < t.n AND c.n % 2 = 1 WHERE t.n % 2 = 0 GROUP BY 1, 2""")
def captions_above(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("n")).distinct()
    at = (F.col("n") * 10).cast("double")
    below = rows.where("n % 2 = 0").select("page", "n", (F.col("page") * 10 + F.col("n")).alias("table_id"), at.alias("top"))
    captions = rows.where("n % 2 = 1").select("page", at.alias("bottom"), F.concat(F.lit("caption "), F.col("n").cast("string")).alias("caption"))
    return match.caption_above(below, captions).select("page", "n", "caption")


@query("""SELECT o_orderkey, l_shipmode AS text FROM (SELECT DISTINCT l_orderkey AS o_orderkey, l_returnflag AS l_shipmode FROM lineitem WHERE l_linenumber >= 3)""")
def footnotes_below(spark, sf_dir):
    tables_ = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"), F.col("o_orderkey").alias("page"), F.lit(30).alias("bottom"))
    blocks = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") * 10).alias("block_top"), F.col("l_returnflag").alias("text"))
    return match.footnotes(tables_, blocks).select(F.col("table_id").alias("o_orderkey"), "text")


@query("""WITH e AS (SELECT DISTINCT 'sa_' || p_size AS entry FROM part WHERE p_size % 2 = 0) SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'sa_' || p_size END AS entry FROM part""")
def names_by_longest_prefix(spark, sf_dir):
    name = F.concat(F.lit("sa_"), F.col("p_size").cast("string"), F.lit("_x"), F.col("p_partkey").cast("string"))
    parts = read(spark, sf_dir, "part").select("p_partkey", name.alias("name"), F.concat(F.lit("sa_"), F.col("p_size").cast("string")).alias("entry"), "p_size")
    found = match.longest_prefix(parts.select("name"), parts.where("p_size % 2 = 0").select("entry"), "name", "entry")
    return parts.select("p_partkey", "name").join(found, "name").select("p_partkey", "entry")


@query("""WITH n AS (SELECT n_nationkey, min(s_name) AS s, count(*) AS c FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1) SELECT n_nationkey, CASE WHEN c = 1 THEN s END AS s_name FROM n""")
def single_candidates(spark, sf_dir):
    suppliers = read(spark, sf_dir, "supplier", F.col("s_nationkey").alias("n_nationkey"), "s_name")
    return match.only_candidate(read(spark, sf_dir, "nation", "n_nationkey"), suppliers, ["n_nationkey"], "s_name").select("n_nationkey", "s_name")


@query("""SELECT c_custkey, CAST(n AS INTEGER) AS position, o_orderkey, c_name FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) JOIN customer ON c_custkey = o_custkey""")
def positions_as_contract(spark, sf_dir):
    """A customer's orders by their place, against the same places counted from the customers' side: names have to agree."""
    nth = F.row_number().over(Window.partitionBy("c_custkey").orderBy("o_orderkey")).alias("position")
    left = read(spark, sf_dir, "orders", F.col("o_custkey").alias("c_custkey"), "o_orderkey").select("c_custkey", nth, "o_orderkey", F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string")).alias("name"))
    counts = read(spark, sf_dir, "orders", F.col("o_custkey").alias("c_custkey")).groupBy("c_custkey").agg(F.count("*").cast("int").alias("most"))
    right = read(spark, sf_dir, "customer", "c_custkey", "c_name").join(counts, "c_custkey").select("c_custkey", F.explode(F.sequence(F.lit(1), "most")).alias("position"), "c_name")
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("long")
    return match.checked_positions(left, right, ["c_custkey", "position"], number(F.col("name")), number(F.col("c_name"))).select("c_custkey", "position", "o_orderkey", "c_name")


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag <> 'R'), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE l_quantity END AS q FROM lineitem WHERE l_returnflag <> 'N')
    SELECT l_orderkey, l_linenumber, a.l_quantity IS NOT DISTINCT FROM b.q AS agree FROM a FULL JOIN b USING (l_orderkey, l_linenumber)""")
def rows_zipped_by_position(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    left = rows.where("l_returnflag <> 'R'").drop("l_returnflag")
    right = rows.where("l_returnflag <> 'N'").drop("l_returnflag").withColumn("l_quantity", F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(F.col("l_quantity")))
    return match.zipped(left, right, ["l_orderkey"], "l_linenumber", "l_quantity").select("l_orderkey", "l_linenumber", "agree")


@query("""WITH b AS (SELECT p_type AS standard, CAST(p_size AS VARCHAR) AS nps, p_brand AS schedule, max(p_retailprice) AS t FROM part GROUP BY ALL)
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN t * 25.4 ELSE t END AS t FROM part LEFT JOIN b ON standard = p_type AND nps = CAST(p_size AS VARCHAR) AND schedule = p_brand AND p_type <> (SELECT max(p_type) FROM part)""")
def dimensions_by_standard(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    t = F.max("p_retailprice").cast("double")
    key = [F.col("p_type").alias("standard"), F.col("p_size").cast("string").alias("nps"), F.col("p_brand").alias("schedule")]
    last = parts.agg(F.max("p_type")).scalar()
    bases = parts.where(F.col("p_type") != last).groupBy(*key).agg(t.alias("t_in"), (t * 25.4).alias("t_mm"), t.alias("od_in"), t.alias("od_mm"))
    asked = parts.select("p_partkey", F.col("p_type").alias("standard"), F.col("p_size").cast("string").alias("nps"), F.col("p_brand").alias("schedule"), pick(F.col("p_partkey") % 2, ["SI", "US"]).alias("units"))
    return match.dimension_lookup(asked, bases).select("p_partkey", "t")


@query(r"""WITH t AS (SELECT page_id, html, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages), w AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN page_id - 4 WHEN 1 THEN page_id + 1 ELSE page_id - 20 END AS page, title FROM t WHERE title <> ''),
    c AS (SELECT w.page_id, w.page, t.page_id AS pg FROM w JOIN t ON t.page_id BETWEEN w.page - 2 AND w.page + 12 AND contains(t.html, w.title))
    SELECT w.page_id, arg_min(pg, abs(pg - c.page) * 100000000 + pg) AS found_page FROM w LEFT JOIN c USING (page_id) GROUP BY 1""")
def pages_near_the_expected(spark, sf_dir):
    """A page's title is looked for near a page that is off by four, one or twenty."""
    pages = read(spark, sf_dir, "pages", "page_id", "html")
    titled = pages.select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("text")).where("text <> ''")
    off = F.when(F.col("page_id") % 3 == 0, -4).when(F.col("page_id") % 3 == 1, 1).otherwise(-20)
    wanted = titled.select("page_id", (F.col("page_id") + off).alias("page"), "text")
    return match.near_page(wanted, pages.select(F.col("page_id").alias("page"), F.col("html").alias("page_text")), "page_id").select("page_id", "found_page")


@query(r"""WITH d AS (SELECT doc_id, text, coalesce(substr(lead(text) OVER (ORDER BY doc_id), 1, 200), '') AS wanted, substr(text, 11, 60) AS own FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(lower(wanted), '\W+'), lambda x: length(x) >= 5) AS long FROM d), s AS (SELECT *, len(list_filter(long, lambda x: contains(lower(text), x))) / nullif(len(long), 0) AS share FROM w)
    SELECT doc_id, CASE WHEN contains(text, wanted) THEN 'FOUND' WHEN share >= 0.95 THEN 'REFORMATTED' WHEN share >= 0.6 THEN 'PARTIAL' ELSE 'MISSING' END AS next, CASE WHEN contains(text, own) THEN 'FOUND' END AS own FROM s""")
def texts_on_pages(spark, sf_dir):
    """Whether a document has the beginning of the next one, as it stands or by its long words; and a part of its own."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    after = docs.select("doc_id", F.substring("text", 1, 200).alias("wanted"))
    numbered = docs.select("doc_id").repartitionByRange("doc_id").select("doc_id")
    following = numbered.join(numbered.select((F.col("doc_id") - 1).alias("doc_id"), F.col("doc_id").alias("next_id")), "doc_id", "left")
    both = docs.join(following, "doc_id").join(after.withColumnRenamed("doc_id", "next_id"), "next_id", "left")
    wanted = F.coalesce("wanted", F.lit(""))
    return both.select("doc_id", match.words_found(wanted, F.col("text")).alias("next"), match.words_found(F.substring("text", 11, 60), F.col("text")).alias("own"))


@query("""WITH s AS (SELECT p_type, p_brand, list_sort(list_distinct(list(p_size % 5))) AS m FROM part GROUP BY 1, 2)
    SELECT a.p_type, a.p_brand AS small, b.p_brand AS large FROM s a JOIN s b USING (p_type) WHERE list_has_all(b.m, a.m) AND len(b.m) > len(a.m)""")
def strict_subsets(spark, sf_dir):
    sets = read(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.array_sort(F.collect_set(F.col("p_size") % 5)).alias("m"))
    return match.subset_pairs(sets, "p_brand", "m", "p_type")


@query("""WITH s AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS number FROM part UNION SELECT DISTINCT p_size || '.' || (p_partkey % 4 + 1) || '.' || (p_partkey % 3 + 1) FROM part)
    SELECT number, CASE WHEN contains(number, '.') THEN split_part(number, '.', 1) END AS parent, len(string_split(number, '.')) AS depth FROM s""")
def parents_of_sections(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    text = lambda c: c.cast("string")
    deep = F.concat_ws(".", text(F.col("p_size")), text(F.col("p_partkey") % 4 + 1), text(F.col("p_partkey") % 3 + 1))
    sections = parts.select(text(F.col("p_size")).alias("number")).union(parts.select(deep)).distinct()
    return match.section_parents(sections).select("number", "parent", F.col("depth").cast("long").alias("depth"))


@query("""WITH l AS (SELECT l_orderkey, l_returnflag AS line, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem),
    r AS (SELECT l_orderkey, l_returnflag AS line, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem WHERE l_linenumber % 3 <> 0)
    SELECT l_orderkey, line, n, l_quantity, l_extendedprice, CASE WHEN r.n IS NULL THEN 'RIGHT' END AS half FROM l LEFT JOIN r USING (l_orderkey, line, n)""")
def facing_pages(spark, sf_dir):
    """Lines with the same flag have equal labels: first with first. The right page lacks some."""
    rows = read(spark, sf_dir, "lineitem").withColumns({"line": F.col("l_returnflag"), "at": F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")})
    halves = resolve.page_halves(rows.select("l_orderkey", "line", "at", "l_quantity"), rows.where("l_linenumber % 3 <> 0").select("l_orderkey", "line", "at", "l_extendedprice"), ["l_orderkey", "line"], "at")
    return halves.withColumnRenamed("nth", "n").select("l_orderkey", "line", "n", "l_quantity", "l_extendedprice", "half")


@query("""SELECT s.p AS prefix, (SELECT min(p_name) FROM part WHERE starts_with(p_name, s.p) AND p_partkey = (SELECT min(p_partkey) FROM part q WHERE starts_with(q.p_name, s.p))) AS p_name FROM (SELECT DISTINCT substr(p_name, 1, 3) AS p FROM part) s""")
def first_by_prefix(spark, sf_dir):
    parts = read(spark, sf_dir, "part", "p_partkey", "p_name")
    return resolve.by_prefix(parts.select(F.substring("p_name", 1, 3).alias("prefix")).distinct(), parts, "prefix", "p_name", "p_partkey").select("prefix", "p_name")


@query("""SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def unbacked_citations(spark, sf_dir):
    cited = read(spark, sf_dir, "customer", "c_nationkey", "c_mktsegment").distinct()
    return resolve.unbacked(cited, read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey")), ["c_nationkey"])


@query("""SELECT l_orderkey, first(l_linenumber ORDER BY l_linenumber) AS l_linenumber FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'N' GROUP BY 1""")
def blocks_by_signature(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return resolve.first_match(rows, ["l_orderkey"], ["l_linenumber"], (F.col("l_quantity") > 30) & (F.col("l_returnflag") == "N"), "l_linenumber")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'repaired' WHEN o_orderkey % 50 <> 1 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def guarded_repairs(spark, sf_dir):
    """One repair writes a text, another takes one away; both name what they expect."""
    rows = read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    patch = rows.where("o_orderkey % 50 < 2").select("o_orderkey", F.col("o_orderstatus").alias("expected"), F.when(F.col("o_orderkey") % 50 == 0, "repaired").alias("replacement"))
    return resolve.literal_patch(rows, patch, ["o_orderkey"], "o_orderstatus").select("o_orderkey", "o_orderstatus")


@query("""WITH s AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CASE WHEN coalesce(k, 0) = 1 THEN 'CLOSED' WHEN coalesce(k, 0) = 0 THEN 'CLOSED' ELSE 'OPEN' END AS class FROM orders LEFT JOIN s ON l_orderkey = o_orderkey""")
def open_and_closed_mappings(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    found = resolve.resolve(read(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey", [("LINE", lines, ["o_orderkey"])], "l_returnflag")
    n = lines.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    return found.join(n, "o_orderkey", "left").select("o_orderkey", resolve.mapping_state(F.col("state"), F.coalesce("n", F.lit(0))).alias("class"))


# ---- audits ------------------------------------------------------------------------------------------------


@query("""WITH v AS (SELECT l_orderkey, l_suppkey % 3 AS k, array_to_string(list_sort(list(CAST(l_quantity AS INTEGER))), '|') AS vals FROM lineitem GROUP BY 1, 2) SELECT k, vals, count(*) AS n FROM v GROUP BY 1, 2""")
def multiset_of_rows(spark, sf_dir):
    vectors = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 3).alias("k")).agg(F.collect_list("l_quantity").alias("vals"))
    return audit.canonical_rows(vectors.drop("l_orderkey"), ["k"], "vals").select("k", shown(F.transform("vals", lambda x: x.cast("int"))).alias("vals"), "n")


@query("""SELECT o_orderkey, o_totalprice AS a, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 7) END AS b FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 7 > 2""")
def vectors_that_differ(spark, sf_dir):
    rows = read(spark, sf_dir, "orders", "o_orderkey", F.col("o_totalprice").alias("v"))
    other = rows.where("o_orderkey % 4 <> 0").withColumn("v", F.col("v") + F.col("o_orderkey") % 7)
    return audit.mismatches(rows, other, ["o_orderkey"], "v", 2.5)


@query("""SELECT 'orders without lines' AS name, count(*) AS violations FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'holes in line numbers', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber))""")
def report_of_checks(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    orders = read(spark, sf_dir, "orders", F.col("o_orderkey").alias("l_orderkey"))
    return audit.checks({"orders without lines": audit.missing(orders, lines, ["l_orderkey"]), "holes in line numbers": audit.contiguity(lines, ["l_orderkey"], "l_linenumber")})


@query("""SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""")
def rows_without_a_partner(spark, sf_dir):
    return audit.missing(read(spark, sf_dir, "nation", "n_nationkey"), read(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey")), ["n_nationkey"])


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_linenumber % 2 = 0 AND l_linenumber - 1 IN (SELECT x.l_linenumber FROM lineitem x WHERE x.l_orderkey = lineitem.l_orderkey))""")
def blocks_without_twins(spark, sf_dir):
    """A block at an even place covers the same as the one before it, and is empty."""
    n = F.col("l_linenumber")
    y = (F.floor((n + 1) / F.lit(2)) * 10).cast("double")
    box = F.struct(F.lit(0.0).alias("x0"), y.alias("y0"), F.lit(50.0).alias("x1"), (y + 5).alias("y1"))
    boxes = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", box.alias("box"), (n % 2 == 0).alias("empty"))
    return layout.without_twins(boxes, ["l_orderkey"], "box", "empty", "l_linenumber").select("l_orderkey", "l_linenumber")


@query("""WITH m AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 OR o_orderstatus IS NOT DISTINCT FROM lag(o_orderstatus) OVER w THEN 0 ELSE 1 END AS nw, row_number() OVER w AS r FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
    SELECT o_custkey, o_orderkey, CAST(sum(CASE WHEN r = 1 THEN 1 ELSE nw END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS logical FROM m""")
def stitched_tables(spark, sf_dir):
    rows = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderstatus").withColumn("continued", F.col("o_orderkey") % 3 == 0)
    return layout.stitch(rows, ["o_custkey"], ["o_orderkey"], "o_orderstatus", "continued").select("o_custkey", "o_orderkey", "logical")


@query("""SELECT p_partkey, CASE WHEN 100.0 + p_size > 125 THEN 'ABOVE_MAX_TEMPERATURE' ELSE 'IN_RANGE' END AS status, CASE p_partkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'INCLUDED' ELSE 'SILENT' END AS admits FROM part""")
def stress_range_and_increase(spark, sf_dir):
    notes = F.coalesce(*[F.when(F.col("p_partkey") % 4 == i, F.array(*map(F.lit, n))) for i, n in enumerate((["(4)"], ["(5)"], ["(4)", "(5)"], ["(1)"]))])
    return read(spark, sf_dir, "part").select("p_partkey", curves.stress_status(F.col("p_size") + F.lit(100.0), F.lit(125.0)).alias("status"), curves.admits_increase(notes).alias("admits"))


@query("""SELECT c_custkey, c_nationkey AS n, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def required_lookups(spark, sf_dir):
    """Every customer has a nation, or the query stops."""
    wanted = read(spark, sf_dir, "customer", "c_custkey", F.col("c_nationkey").alias("n"))
    return resolve.required(wanted, read(spark, sf_dir, "nation", F.col("n_nationkey").alias("n"), "n_name"), ["n"], "n_name", "nation").select("c_custkey", "n", "n_name")


@query("""WITH l AS (SELECT event_id, user_id, event_id % 3 AS lv, event_type AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    m AS (SELECT *, max(CASE WHEN lv = 0 THEN n END) OVER w AS n0, max(CASE WHEN lv = 1 THEN n END) OVER w AS n1 FROM l WINDOW w AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT m.event_id, concat_ws('|', CASE WHEN m.lv > 0 THEN a.v END, CASE WHEN m.lv > 1 AND m.n1 > coalesce(m.n0, 0) THEN b.v END, m.v) AS chosen,
        coalesce(m.lv = 0 OR m.lv = 1 AND m.n0 IS NOT NULL OR m.lv = 2 AND m.n0 IS NOT NULL AND m.n1 > m.n0, false) AS complete
    FROM m LEFT JOIN l a ON a.user_id = m.user_id AND a.n = m.n0 LEFT JOIN l b ON b.user_id = m.user_id AND b.n = m.n1""")
def selections_of_users(spark, sf_dir):
    """A user's events choose on three levels: a choice clears the deeper ones, and is complete if all above it are made."""
    events = read(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type").withColumn("level", (F.col("event_id") % 3).cast("int"))
    chosen = grids.heading_paths(events, ["user_id"], ["ts", "event_id"], "level", "event_type")
    return chosen.select("event_id", F.array_join(F.concat("path", F.array("event_type")), "|").alias("chosen"), (F.size("path") == F.col("level")).alias("complete"))


# ---- engines -----------------------------------------------------------------------------------------------


def _inputs(rows, values: dict):
    return rows.withColumns({column_name(k): v for k, v in values.items()})


@query("""WITH i AS (SELECT p_partkey, 100.0 + p_size AS Dm, 6.0 AS t, 8.0 AS TT, 0.5 + p_size / 50.0 AS P, 0.55 AS E, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 138.0 END AS Sa, 100.0 + p_size * 3 AS Rf, 0.0 AS gap, p_partkey % 7 = 0 AS out FROM part),
    f AS (SELECT *, P * Dm / 2 AS F_max FROM i), g AS (SELECT *, F_max / (E * Sa) AS w_min, F_max / TT + 6 * F_max * ((TT + t) / 2 + gap) / (TT * TT) AS S_w, 50 * TT / Rf AS el FROM f)
    SELECT p_partkey, round(F_max, 6) AS force, round(w_min, 6) AS throat, round(S_w, 6) AS stress, round(el, 6) AS elongation,
        CASE WHEN out THEN 'BLOCKED: excluded' WHEN Sa IS NULL THEN 'MISSING Sa' WHEN S_w <= 1.5 * Sa AND el <= 5 THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM g""")
def welded_patch(spark, sf_dir):
    size, lit = F.col("p_size").cast("double"), F.lit
    got = WELDED_PATCH.evaluate(_inputs(read(spark, sf_dir, "part", "p_partkey", "p_size"), {
        "Dm": size + 100, "t": lit(6.0), "T": lit(8.0), "P": size / 50 + 0.5, "E": lit(0.55), "Sa": F.when(F.col("p_partkey") % 11 != 0, 138.0), "Rf": size * 3 + 100, "gap": lit(0.0),
        "service": F.when(F.col("p_partkey") % 7 == 0, "excluded").otherwise("allowed"),
    }))
    value = lambda n, name: F.round(F.col(column_name(n)), 6).alias(name)
    return got.select("p_partkey", value("F_max", "force"), value("w_min", "throat"), value("S_w", "stress"), value("elongation", "elongation"), "verdict")


@query("""WITH i AS (SELECT p_partkey, 300.0 AS od, 6.0 + p_size / 10.0 AS t, 2.0 AS P, 1.0 AS CA, 100.0 AS S, 200.0 AS d1, 100.0 + p_size AS d2, 90.0 AS beta, 3.0 AS th, 9.0 AS Th2, 20.0 AS L4, p_partkey % 5 = 0 AS crack, p_partkey % 10 = 0 AS q, p_partkey % 6 = 0 AS kn FROM part),
    f AS (SELECT *, P * od / (2 * (S * 1 * 1 + P * 0.4)) AS t_req FROM i),
    g AS (SELECT *, t >= t_req + CA AS wall, th * d1 * (2 - sin(radians(beta))) AS A1, (2 * d2 - d1) * (Th2 - th - CA) AS A2, 2 * L4 * (t - t_req - CA) / sin(radians(beta)) AS A3 FROM f)
    SELECT p_partkey, round(A1, 6) AS needed, round(A2 + A3, 6) AS present, CASE WHEN crack AND NOT q THEN 'BLOCKED: unqualified crack' WHEN kn THEN 'BLOCKED: weld to an unqualified knuckle' WHEN wall AND A2 + A3 >= A1 THEN 'PASS' ELSE 'REVIEW' END AS verdict,
        CASE WHEN (crack AND NOT q) OR kn THEN 'RED' WHEN wall AND A2 + A3 >= A1 THEN 'GREEN' ELSE 'AMBER' END AS light FROM g""")
def leak_box(spark, sf_dir):
    size, k, lit = F.col("p_size").cast("double"), F.col("p_partkey"), F.lit
    yes = lambda c: F.when(c, "yes").otherwise("no")
    fixed = {"od": 300.0, "P": 2.0, "CA": 1.0, "S": 100.0, "E": 1.0, "W": 1.0, "Y": 0.4, "d1": 200.0, "beta": 90.0, "t_h": 3.0, "T_h": 9.0, "L4": 20.0, "Tp": 8.0, "thin": 5.0}
    got = LEAK_BOX.evaluate(_inputs(read(spark, sf_dir, "part", "p_partkey", "p_size"), {n: lit(v) for n, v in fixed.items()} | {
        "t": size / 10 + 6.0, "d2": size + 100.0, "crack": yes(k % 5 == 0), "qualified": yes(k % 10 == 0), "knuckle": yes(k % 6 == 0), "thrust": lit("yes"),
    }))
    area = lambda *n: F.round(sum((F.col(column_name(x)) for x in n[1:]), F.col(column_name(n[0]))), 6)
    return got.select("p_partkey", area("A1").alias("needed"), area("A2", "A3").alias("present"), "verdict", severity(F.col("verdict")).alias("light"))


@query("""WITH i AS (SELECT p_partkey, 2.0 + p_size / 5.0 AS Ts, 8.0 AS Tp, 1.5 + p_partkey % 5 * 0.3 AS G, 80.0 + p_size * 3 AS Ls, p_size * 1.0 AS d, 10.0 AS P_op, 4.0 + p_partkey % 6 AS P_inst FROM part)
    SELECT p_partkey, round(CASE WHEN Ts <= 1.4 * Tp THEN Ts + G ELSE 1.4 * Tp + G END, 6) AS leg, greatest(100, d + 100) AS length,
        CASE WHEN Ts >= 2 / 3.0 * Tp AND Ls >= greatest(100, d + 100) AND p_partkey % 5 < 4 AND P_inst BETWEEN 5 AND 8 THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM i""")
def sleeve(spark, sf_dir):
    size, key, lit = F.col("p_size").cast("double"), F.col("p_partkey"), F.lit
    values = {"Ts": size / 5 + 2.0, "Tp": lit(8.0), "G": F.round((key % 5) * 0.3 + 1.5, 1), "Ls": size * 3 + 80.0, "defect": size, "P_op": lit(10.0), "P_inst": (key % 6 + 4).cast("double")}
    got = SLEEVE.evaluate(_inputs(read(spark, sf_dir, "part", "p_partkey", "p_size"), values))
    return got.select("p_partkey", F.round(F.col(column_name("leg")), 6).alias("leg"), F.col(column_name("Ls_min")).alias("length"), "verdict")


@query("""SELECT p_partkey, round(p_size * 25.4, 6) AS mm, round(p_size * 6.894757293168, 6) AS mpa, round((p_size - 32) * 5 / 9.0, 6) AS celsius, round(p_size * 0.0980665 / 0.006894757293168, 6) AS psi, round(p_size * 25.4 / 304.8, 6) AS feet FROM part""")
def converted_units(spark, sf_dir):
    size = F.col("p_size").cast("double")
    to = lambda of, unit, name: F.round(convert(size, of, unit), 6).alias(name)
    return read(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", to("in", "mm", "mm"), to("ksi", "MPa", "mpa"), to("F", "C", "celsius"), to("kg/cm2", "psi", "psi"), to("in", "ft", "feet"))


@query("""WITH e AS (SELECT p_partkey, 1 / 0.4 * (1.0 + p_size / 10.0) * 1000000 * (p_size * 0.5) * (1 - pow(0.101 / (1.0 + p_size / 10.0), 0.4 / 1.4)) AS E FROM part)
    SELECT p_partkey, round(E / 1e6, 6) AS energy, round(E / 4266920, 6) AS tnt, round(20 * pow(2 * E / 4266920, 1 / 3.0), 6) AS distance, 'PASS' AS verdict FROM e""")
def pneumatic_test(spark, sf_dir):
    size, lit = F.col("p_size").cast("double"), F.lit
    got = PNEUMATIC_TEST.evaluate(_inputs(read(spark, sf_dir, "part", "p_partkey", "p_size"), {"V": size * 0.5, "Pat": size / 10 + 1.0, "Pa": lit(0.101), "k": lit(1.4), "R_scaled": lit(20.0)}))
    return got.select("p_partkey", F.round(F.col(column_name("E")) / 1e6, 6).alias("energy"), F.round(F.col(column_name("TNT")), 6).alias("tnt"), F.round(F.col(column_name("R")), 6).alias("distance"), "verdict")


@query("""SELECT name, block, block <> 11 AND block IN (SELECT p_partkey FROM part) AS found, CASE WHEN block <> 11 THEN (SELECT p_name FROM part WHERE p_partkey = block) END AS cited_text
    FROM (VALUES ('F_CP', 2), ('F_LP', 3), ('F_max', 4), ('L_min', 5), ('w_min', 6), ('e', 7), ('S_w', 8), ('elongation', 9), ('weld_ok', 10), ('strain_ok', 11)) v(name, block)""")
def cited_blocks(spark, sf_dir):
    blocks = read(spark, sf_dir, "part").select(F.lit("repair-article").alias("source"), F.col("p_partkey").cast("int").alias("block"), F.when(F.col("p_partkey") == 11, "heading").otherwise("text").alias("type"), F.col("p_name").alias("text"))
    return provenance(WELDED_PATCH, blocks).select("name", "block", "found", "cited_text")


@query("""SELECT p_partkey, 'distance of ' || p_size || '.0 for ' || (p_partkey % 5) || '.5' AS text FROM part""")
def filled_specification(spark, sf_dir):
    rows = _inputs(read(spark, sf_dir, "part", "p_partkey", "p_size"), {"Ts": F.col("p_size").cast("double"), "Tp": (F.col("p_partkey") % 5 + 0.5).cast("double")})
    return rows.select("p_partkey", fill("distance of {Ts} for {Tp}", SLEEVE).alias("text"))


# ---- documents ---------------------------------------------------------------------------------------------


@query("""SELECT conv_id, turn, CAST(turn AS INTEGER) AS depth, array_to_string(range(0, turn + 1), '|') AS path FROM conversations""")
def blocks_in_preorder(spark, sf_dir):
    """Every turn is the child of the one before it."""
    name = lambda n: F.concat_ws("-", F.col("conv_id").cast("string"), n.cast("string"))
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn")
    blocks = turns.select("conv_id", "turn", name(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("parent_id"), F.col("turn").cast("long").alias("position"))
    return trees.preorder(blocks).select("conv_id", "turn", "depth", shown(F.col("path")).alias("path"))


@query("""SELECT 'n' || n_nationkey AS node, 'ORPHAN' AS fault FROM nation WHERE n_regionkey > 2 UNION ALL SELECT 'c' || c_custkey, 'ORPHAN' FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey > 2)
    UNION ALL SELECT 'c' || c_custkey, 'SEVERAL_PARENTS' FROM customer WHERE c_custkey % 10 = 0 AND c_nationkey <> 0""")
def faults_of_trees(spark, sf_dir):
    node = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string"))
    nations, people = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    edges = nations.where("n_regionkey <= 2").select(node("r", "n_regionkey").alias("parent"), node("n", "n_nationkey").alias("child"))
    edges = edges.union(people.select(node("n", "c_nationkey"), node("c", "c_custkey")))
    lost = people.join(nations.where("n_regionkey > 2"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey")
    doubled = people.where("c_custkey % 10 = 0 AND c_nationkey <> 0").select(node("n", "c_nationkey").alias("p"), node("c", "c_custkey"))
    edges = edges.union(doubled.withColumn("p", F.concat(F.lit("m"), F.expr("substring(p, 2)"))))
    roots = read(spark, sf_dir, "region").select(node("r", "r_regionkey").alias("node"))
    found = trees.tree_faults(edges, roots)
    return found.where(~F.col("node").startswith("m"))


@query(r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS row_no, len(regexp_extract_all(r[i], '(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>', 1)) AS cells FROM (SELECT page_id, r, unnest(range(1, len(r) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(replace(replace(html, '<p>', '<tr><td>'), '</p>', '</td><td>x</td></tr>'), '(?is)<tr\b[^>]*>(.*?)</tr>', 1) AS r FROM pages))""")
def cells_of_html_tables(spark, sf_dir):
    html = F.replace(F.replace("html", F.lit("<p>"), F.lit("<tr><td>")), F.lit("</p>"), F.lit("</td><td>x</td></tr>"))
    cells = documents.html_cells(read(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id", "html")
    return cells.groupBy("page_id", "row_no").agg(F.count("*").alias("cells"))


@query("""SELECT 'sa_' || o_custkey || '.json' AS path, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS line_no, o_orderkey AS key, o_orderstatus AS name FROM orders""")
def rows_of_json_documents(spark, sf_dir):
    """A customer's orders are one document."""
    row = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("name"))))
    path = F.concat(F.lit("sa_"), F.col("o_custkey").cast("string"), F.lit(".json"))
    texts = read(spark, sf_dir, "orders").groupBy(path.alias("path")).agg(F.to_json(F.struct(row.alias("rows"))).alias("value"))
    docs = texts.select("path", F.try_parse_json("value").alias("doc"))
    return documents.document_rows(docs, "struct<key: bigint, name: string>").select("path", "line_no", "row.key", "row.name")


@query("""SELECT p_partkey, CAST(0 AS INTEGER) AS block, CASE p_partkey % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'paragraph' ELSE 'row' END AS type,
    CASE p_partkey % 3 WHEN 2 THEN '{"name":"' || p_name || '"}' ELSE p_name END AS text FROM part""")
def citable_blocks(spark, sf_dir):
    name = F.to_json(F.struct(F.col("p_name").alias("text")))
    body = pick(F.col("p_partkey") % 3, ['{"blocks": [{"type": "text", ', '{"paragraphs": [{', '{"rows": [{'])
    doc = F.concat(body, F.when(F.col("p_partkey") % 3 == 2, F.concat(F.lit('"name":"'), "p_name", F.lit('"'))).otherwise(F.regexp_replace(name, r"^\{|\}$", "")), F.lit("}]}"))
    docs = read(spark, sf_dir, "part").select(F.concat(F.lit("sa_"), F.col("p_partkey").cast("string"), F.lit(".json")).alias("path"), F.try_parse_json(doc).alias("doc"))
    blocks = documents.citable_blocks(documents.files_of(docs, "sa_1").unionByName(docs.where("path not like 'sa\\_1.%'")))
    return blocks.select(F.regexp_extract("path", r"(\d+)", 1).cast("long").alias("p_partkey"), "block", "type", "text")


@query("""SELECT o_custkey, count(*) AS n_rows, bool_and(o_orderkey % 7 <> 0) AS unchanged, true AS dealt_anew FROM orders GROUP BY 1""")
def manifest_of_tables(spark, sf_dir):
    """A customer's orders are a table. Its digest tells a copy in which a value moved to the next column, and not one in another order."""
    rows = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"))
    moved = F.col("o_orderkey") % 7 == 0
    changed = rows.select("o_custkey", "o_orderkey", F.when(~moved, F.col("a")).alias("a"), F.when(moved, F.col("a")).alias("b"))
    own = documents.manifest_of(rows, ["o_custkey"])
    anew = documents.manifest_of(rows.repartition(3).orderBy(F.desc("o_orderkey")), ["o_custkey"]).select("o_custkey", F.col("digest").alias("again"))
    other = documents.manifest_of(changed, ["o_custkey"]).select("o_custkey", F.col("digest").alias("other"))
    return own.join(other, "o_custkey").join(anew, "o_custkey").select("o_custkey", "n_rows", (F.col("digest") == F.col("other")).alias("unchanged"), (F.col("digest") == F.col("again")).alias("dealt_anew"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '?' END AS covers FROM nation WHERE n_nationkey % 5 <> 0""")
def declared_coverage(spark, sf_dir):
    nations = read(spark, sf_dir, "nation")
    files = nations.where("n_nationkey % 5 <> 0").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("covers"))
    return documents.coverage(nations.select("n_nationkey"), files, "n_nationkey", "covers").select("n_nationkey", "covers")


@query("""SELECT p_partkey, 'a|' || p_name AS cells, 1 AS left_over FROM part""")
def sealed_rows(spark, sf_dir):
    cells = documents.filled_cells(F.array(F.array(F.lit("a"), F.lit(None)), F.array(F.col("p_name"))))
    own = documents.without_own(F.create_map(F.lit("name"), F.col("p_name"), F.lit("amendment"), F.lit("x")), ["amendment"])
    return read(spark, sf_dir, "part").select("p_partkey", shown(cells).alias("cells"), F.size(own).alias("left_over"))
