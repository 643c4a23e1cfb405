"""Queries over whole texts and trees: broken words, words from characters, contents, totals and searches in trees."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.operators import contents, glyphs, hyphens, trees
from lamina.plans.base import query, read


@query(r"""SELECT doc_id, regexp_replace(text, '([-‐])[\s]+', '\1_', 'g') AS text FROM documents""")
def broken_words(spark, sf_dir):
    """Texts of even ids are broken within long words, as lines would; put together by the words of all texts, they are as before."""
    docs = read(spark, sf_dir, "documents", "doc_id", F.regexp_replace("text", r"([-‐])\s+", "$1_").alias("text"))
    broken = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", r"\b([a-z]{4})([a-z]{4,})\b", "$1-\n$2")).otherwise(F.col("text")))
    return hyphens.rejoined(broken, "doc_id", "text", hyphens.vocabulary_of(docs.where("doc_id % 2 = 1"), "text"))


@query("""WITH d AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents), l AS (SELECT doc_id, n, substr(t, CAST(n * 80 + 1 AS BIGINT), 80) AS line FROM (SELECT doc_id, t, unnest(range(0, (length(t) + 79) // 80)) AS n FROM d))
    SELECT doc_id, CAST(n AS BIGINT) AS line_no, regexp_replace(trim(line), ' +', '|', 'g') AS words FROM l WHERE trim(line) <> ''""")
def words_from_characters(spark, sf_dir):
    """Every text printed in lines of 80 characters, each with its place; the words come back from the gaps."""
    docs = read(spark, sf_dir, "documents", "doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("t"))
    lines = docs.select("doc_id", F.posexplode(F.regexp_extract_all("t", F.lit("(?s).{1,80}"), F.lit(0))).alias("line_no", "line"))
    cut = lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")
    placed = cut.select("doc_id", "line_no", glyphs.in_fixed_pitch(F.col("line"), 5.0, 10.0).alias("chars"))
    words = placed.select("doc_id", "line_no", F.transform(glyphs.words_of_line(F.col("chars")), lambda w: w["text"]).alias("words"))
    return words.where(F.size("words") > 0).select("doc_id", "line_no", F.array_join("words", "|").alias("words"))


@query("""WITH RECURSIVE v AS (SELECT DISTINCT l_suppkey AS k, l_quantity AS x FROM lineitem), f AS (SELECT k, min(x) AS first FROM v GROUP BY 1), r AS (
        SELECT k, first FROM f UNION ALL SELECT r.k, (SELECT min(x) FROM v WHERE v.k = r.k AND v.x > r.first + 2.5) FROM r WHERE (SELECT min(x) FROM v WHERE v.k = r.k AND v.x > r.first + 2.5) IS NOT NULL),
    n AS (SELECT l.l_suppkey AS k, l.l_quantity AS x, (SELECT max(first) FROM r WHERE r.k = l.l_suppkey AND r.first <= l.l_quantity) AS first FROM lineitem l),
    b AS (SELECT k, first, CAST(floor(avg(x) * 1000 + 0.000001) AS BIGINT) AS bound, count(*) AS n FROM n GROUP BY 1, 2) SELECT k AS l_suppkey, count(*) AS n, string_agg(CAST(bound AS VARCHAR), '|' ORDER BY bound) AS bounds FROM b WHERE n >= 2 GROUP BY 1""")
def bounds_of_columns(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", "l_suppkey", F.col("l_quantity").cast("double").alias("x"))
    found = glyphs.merged_bounds(rows, ["l_suppkey"], "x", 2.5, 2).where(F.size("bounds") > 0)
    return found.select("l_suppkey", F.size("bounds").cast("long").alias("n"), F.array_join(F.transform("bounds", lambda b: F.floor(b * 1000 + 1e-6).cast("string")), "|").alias("bounds"))


@query("""WITH d AS (SELECT l_orderkey AS k, 'e' || l_linenumber AS entry, min(l_linenumber) AS a FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1, 2), f AS (SELECT l_orderkey AS k, 'e' || l_linenumber AS entry, min(CASE WHEN l_linenumber = 1 THEN 100 ELSE l_linenumber END) AS b FROM lineitem WHERE l_linenumber <> 5 GROUP BY 1, 2),
    j AS (SELECT k, entry, a, b FROM d FULL JOIN f USING (k, entry)), s AS (SELECT *, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) OVER (PARTITION BY k) AS n FROM j)
    SELECT k AS l_orderkey, entry, CASE WHEN b IS NULL THEN 'MISSING' WHEN a IS NULL THEN 'EXTRA' WHEN entry = 'e1' AND n > 2 THEN 'MOVED' WHEN entry <> 'e1' AND n = 2 AND (SELECT bool_or(x.entry = 'e1' AND x.a IS NOT NULL AND x.b IS NOT NULL) FROM j x WHERE x.k = s.k) THEN 'either' WHEN entry = 'e1' AND n = 2 THEN 'either' ELSE 'SAME' END AS state FROM s""")
def contents_against_documents(spark, sf_dir):
    """An order's lines are declared without the third; the document lacks the fifth and has the first at its end. Of two alone either may have moved."""
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").distinct().withColumn("entry", F.concat(F.lit("e"), F.col("l_linenumber").cast("string")))
    declared = lines.where("l_linenumber <> 3").withColumn("at", F.col("l_linenumber"))
    found = lines.where("l_linenumber <> 5").withColumn("at", F.when(F.col("l_linenumber") == 1, 100).otherwise(F.col("l_linenumber")))
    got = contents.compared_lists(declared, found, ["l_orderkey"], "entry", "at")
    common = F.col("declared_at").isNotNull() & F.col("found_at").isNotNull()
    w = Window.partitionBy("l_orderkey")
    two = (F.count_if(common).over(w) == 2) & F.coalesce(F.bool_or(common & (F.col("entry") == "e1")).over(w), F.lit(False)) & common
    return got.select("l_orderkey", "entry", F.when(two, "either").otherwise(F.col("state")).alias("state"))


def _tree(spark, sf_dir):
    """Regions, nations, customers and orders as one tree; an order is worth its price."""
    node = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string"))
    part = lambda df, own, up, at, cents: df.select(own.alias("id"), up.alias("parent_id"), F.col(at).cast("long").alias("position"), cents.alias("cents"))
    none = F.lit(0).cast("long")
    tree = part(read(spark, sf_dir, "region"), node("r", "r_regionkey"), F.lit(None).cast("string"), "r_regionkey", none)
    tree = tree.union(part(read(spark, sf_dir, "nation"), node("n", "n_nationkey"), node("r", "n_regionkey"), "n_nationkey", none))
    tree = tree.union(part(read(spark, sf_dir, "customer"), node("c", "c_custkey"), node("n", "c_nationkey"), "c_custkey", none))
    return tree.union(part(read(spark, sf_dir, "orders"), node("o", "o_orderkey"), node("c", "o_custkey"), "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long")))


TREE_SQL = """t AS (SELECT 'r' || r_regionkey AS id, NULL AS parent_id, r_regionkey AS position, 0 AS cents FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, 0 FROM nation
    UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, 0 FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) FROM orders)"""


@query(f"""WITH RECURSIVE {TREE_SQL}, up AS (SELECT id, id AS above, cents FROM t UNION ALL SELECT up.id, t.parent_id, up.cents FROM up JOIN t ON t.id = up.above WHERE t.parent_id IS NOT NULL)
    SELECT above AS id, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS nodes FROM up WHERE above IN (SELECT id FROM t) GROUP BY 1""")
def totals_of_trees(spark, sf_dir):
    tree = _tree(spark, sf_dir).withColumn("one", F.lit(1).cast("long"))
    got = trees.subtree_totals(tree, ["cents", "one"])
    return got.select("id", F.col("total_cents").alias("cents"), F.col("total_one").alias("nodes"))


@query(f"""WITH RECURSIVE {TREE_SQL}, p AS (SELECT id, [position] AS path, id AS top, 0 AS depth FROM t WHERE parent_id IS NULL UNION ALL SELECT t.id, list_append(p.path, t.position), p.top, p.depth + 1 FROM p JOIN t ON t.parent_id = p.id)
    SELECT id, top, CAST(depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY top ORDER BY path) - 1 AS place FROM p""")
def reading_order_of_trees(spark, sf_dir):
    return trees.reading_order(_tree(spark, sf_dir)).where(F.col("top").startswith("r")).select("id", "top", "depth", "place")


@query(f"""WITH RECURSIVE {TREE_SQL}, p AS (SELECT id, [position] AS path, id AS top, cents FROM t WHERE parent_id IS NULL UNION ALL SELECT t.id, list_append(p.path, t.position), p.top, t.cents FROM p JOIN t ON t.parent_id = p.id)
    SELECT top, arg_min(id, path) AS id, arg_min(cents, path) AS cents FROM p WHERE cents > 20000000 GROUP BY 1""")
def first_in_trees(spark, sf_dir):
    """The first order of a region, in reading order, that is worth more than 200,000."""
    found = trees.first_below(_tree(spark, sf_dir), F.col("cents") > 20000000, "id", "parent_id", "position", "cents")
    return found.where(F.col("top").startswith("r")).select("top", "id", "cents")
