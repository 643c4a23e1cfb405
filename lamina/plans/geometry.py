"""Queries over grids, headings and positions: the driver's pages and lines, as printed tables have them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.operators import layout, regions
from lamina.plans.base import query, read, shown
from lamina.sources import documents, grids

ITEMS = r"""SELECT page_id, i - 1 AS i, trim(regexp_replace(replace(replace(replace(regexp_replace(items[i], '<[^>]*>', ' ', 'g'), '&amp;', '&'), '&quot;', '"'), '&middot;', '·'), '[\s\x{00A0}\x{2007}\x{202F}]+', ' ', 'g')) AS t
    FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS items FROM pages))""".replace("\\\\b", r"\b")


@query(f"""WITH l AS ({ITEMS}) SELECT page_id, CAST(i AS INTEGER) AS row_no, coalesce(first_value(t) OVER (PARTITION BY page_id, i // 3 ORDER BY i), '') AS a, coalesce(t, '') AS b,
    CASE i % 3 WHEN 0 THEN coalesce(t, '') WHEN 1 THEN 'x' || i ELSE 'x' || (i - 1) END AS c FROM l""")
def grids_with_spans(spark, sf_dir):
    """Every page's menu as a table whose cells span rows and columns."""
    items = documents.raw_items(read(spark, sf_dir, "pages", "page_id", "html"), "page_id", "html", "li")
    n = F.col("item_no") % 3
    mark = F.concat(F.lit('<td rowspan="2">x'), F.col("item_no").cast("string"), F.lit("</td>"))
    row = (
        F.when(n == 0, F.concat(F.lit('<th rowspan="3">'), "raw", F.lit('</th><td colspan=2 class="a">'), "raw", F.lit("</td>")))
        .when(n == 1, F.concat(F.lit("<td>"), "raw", F.lit("</td>"), mark)).otherwise(F.concat(F.lit("<td>"), "raw", F.lit("</td>")))
    )
    rows = F.transform(F.array_sort(F.collect_list(F.struct("item_no", F.concat(F.lit("<tr>"), row, F.lit("</tr>")).alias("h")))), lambda x: x["h"])
    pages = items.groupBy("page_id").agg(F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>")).alias("html"))
    cells = grids.grid_cells(pages, "page_id", "html")
    at = lambda k: F.max(F.when(F.col("col_no") == k, F.col("text")))
    return cells.groupBy("page_id", "row_no").agg(at(0).alias("a"), at(1).alias("b"), at(2).alias("c"))


PARAGRAPHS = r"""SELECT page_id, page_id // 5 AS doc, i - 1 AS i, items[i] AS raw FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1) AS items FROM pages))"""


@query(f"""WITH r AS ({PARAGRAPHS}), l AS (SELECT *, 'p' || page_id || '.' || i AS title, CASE WHEN contains(raw, '<b>') THEN 0 WHEN contains(raw, '&amp;') THEN 1 END AS lv, row_number() OVER (PARTITION BY doc ORDER BY page_id, i) AS n FROM r),
    m AS (SELECT *, max(CASE WHEN lv = 0 THEN n END) OVER w AS n0, max(CASE WHEN lv = 1 THEN n END) OVER w AS n1 FROM l WINDOW w AS (PARTITION BY doc ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT m.page_id, CAST(m.i AS INTEGER) AS item_no, concat_ws('|', CASE WHEN m.lv IS NULL OR m.lv > 0 THEN a.title END, CASE WHEN m.lv IS NULL AND m.n1 > coalesce(m.n0, 0) THEN b.title END) AS path
    FROM m LEFT JOIN l a ON a.doc = m.doc AND a.n = m.n0 LEFT JOIN l b ON b.doc = m.doc AND b.n = m.n1""")
def headings_over_pages(spark, sf_dir):
    """Paragraphs below the headings that are open above them, over the ends of pages: five pages are one document."""
    items = documents.raw_items(read(spark, sf_dir, "pages", "page_id", "html"), "page_id", "html", "p")
    level = F.when(F.contains("raw", F.lit("<b>")), 0).when(F.contains("raw", F.lit("&amp;")), 1)
    title = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit("."), F.col("item_no").cast("string"))
    rows = items.select("page_id", "item_no", F.floor(F.col("page_id") / 5).alias("doc"), level.alias("level"), title.alias("title"))
    return grids.heading_paths(rows, ["doc"], ["page_id", "item_no"], "level", "title").select("page_id", "item_no", shown(F.col("path")).alias("path"))


@query("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity * 8 AS a, l_quantity * 8 + l_tax * 1000 AS b FROM lineitem) SELECT x.k AS l_orderkey, x.n AS one, y.n AS other FROM r x JOIN r y ON x.k = y.k AND x.n < y.n WHERE least(x.b, y.b) >= greatest(x.a, y.a)""")
def overlapping_intervals(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", (F.col("l_quantity") * 8).cast("double").alias("a"), (F.col("l_quantity") * 8 + F.col("l_tax") * 1000).cast("double").alias("b"))
    left, right = (rows.select("l_orderkey", F.col("l_linenumber").alias(n), F.col("a").alias(f"{n}_a"), F.col("b").alias(f"{n}_b")) for n in ("one", "other"))
    return regions.overlapping(left, right, ["l_orderkey"], ("one_a", "one_b"), ("other_a", "other_b")).where("one < other").select("l_orderkey", "one", "other")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity * 12 AS x, l_extendedprice % 800 AS y FROM lineitem), g AS (SELECT l_orderkey, x, y FROM b WHERE l_linenumber % 3 = 1)
    SELECT l_orderkey, l_linenumber FROM b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.l_orderkey = b.l_orderkey AND b.x + 15 BETWEEN g.x + 20 AND g.x + 220 AND b.y + 5 BETWEEN g.y - 100 AND g.y + 100)""")
def boxes_outside_regions(spark, sf_dir):
    """Every third line of an order opens a region beside its own box."""
    x, y = (F.col("l_quantity") * 12).cast("double"), (F.col("l_extendedprice") % 800).cast("double")
    box = lambda a, b, c, d: F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", box(x, y, x + 30, y + 10).alias("box"), box(x + 20, y - 100, x + 220, y + 100).alias("region"))
    return regions.outside(rows.select("l_orderkey", "l_linenumber", "box"), rows.where("l_linenumber % 3 = 1"), ["l_orderkey"], "box", "region").select("l_orderkey", "l_linenumber")


@query("""WITH c AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n, count(*) OVER (PARTITION BY l_orderkey) AS most, l_returnflag AS f FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2))
    SELECT k AS l_orderkey, n AS column_no, 'flag ' || f || ' of ' || n AS label, CASE WHEN n % 2 = 1 AND n < most OR n % 2 = 0 THEN 'banner ' || (n - (n + 1) % 2) || ' goes on' ELSE '' END AS banners FROM c""")
def headers_over_columns(spark, sf_dir):
    """An order's lines are columns; every two have a banner of two printed lines, the lower one narrower."""
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))
    rows = rows.select("l_orderkey", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")).alias("column_no"), "l_returnflag")
    left = (F.col("column_no") - 1) * 50.0
    columns = rows.select("l_orderkey", "column_no", left.alias("b0"), (left + 50).alias("b1"))
    run = lambda line, a, b, text: F.struct(F.lit(line).alias("line"), (left + a).alias("x0"), (left + b).alias("x1"), text.alias("text"))
    number = F.col("column_no").cast("string")
    pairs = (F.col("column_no") % 2 == 1) & (F.col("column_no") < F.max("column_no").over(Window.partitionBy("l_orderkey")))
    parts = [run(2, 5, 45, F.concat(F.lit("flag "), "l_returnflag")), run(3, 5, 45, F.concat(F.lit("of "), number))]
    banner = [run(0, 5, 95, F.concat(F.lit("banner "), number)), run(1, 20, 80, F.lit("goes on"))]
    runs = rows.withColumn("_two", pairs).select("l_orderkey", F.explode(F.when(F.col("_two"), F.array(*parts, *banner)).otherwise(F.array(*parts))).alias("r")).select("l_orderkey", "r.*")
    return regions.header_columns(runs, columns, ["l_orderkey"]).select("l_orderkey", "column_no", "label", F.coalesce(F.array_join("banners", "|"), F.lit("")).alias("banners"))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n, bool_or(o_orderkey % 2 = 0) OVER (PARTITION BY o_custkey) AS three FROM orders)
    SELECT o_custkey, CAST(n AS INTEGER) AS row_no, CAST(n // 4 AS INTEGER) AS page, 'EXACT' AS confidence,
        'order ' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '|' || CAST(floor(o_totalprice) AS BIGINT) WHEN three THEN '|' ELSE '' END || '|' || o_orderstatus AS cells FROM o""")
def tables_over_pages(spark, sf_dir):
    """A customer's orders, four on a page. Lines of odd orders cross the gap between the first two columns, which
    lines of even ones prove: the band that both make is cut there."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    rows = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus").withColumn("n", n)
    run = lambda k, t, a, b: F.struct(t.alias("text"), F.lit(a).alias("x0"), F.lit(b).alias("x1"), (F.col("o_orderkey") * 3 + k).alias("line_no"))
    name, price, status = F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), F.floor("o_totalprice").cast("string"), F.col("o_orderstatus")
    runs = F.when(F.col("o_orderkey") % 2 == 0, F.array(run(0, name, 0.0, 60.0), run(1, price, 100.0, 160.0), run(2, status, 300.0, 360.0))).otherwise(F.array(run(0, name, 50.0, 110.0), run(2, status, 300.0, 360.0)))
    y0 = ((F.col("n") % 4) * 10).cast("double")
    lines = rows.select("o_custkey", F.explode(runs).alias("p"), y0.alias("y0"), (y0 + 6).alias("y1"), F.floor(F.col("n") / 4).cast("int").alias("page")).select("o_custkey", "p.*", "y0", "y1", "page")
    return layout.reconstruct_tables(lines, ["o_custkey"]).select("o_custkey", "row_no", "page", "confidence", shown(F.col("cells")).alias("cells"))
