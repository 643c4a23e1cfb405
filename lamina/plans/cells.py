"""Queries over printed text, numbers and cells: the driver's columns are put into the forms that pages print."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import numeric, text
from lamina.operators import layout, tables
from lamina.plans.base import pick, query, read, shown, sql_pick

# ---- words and values -------------------------------------------------------------------------------------

VALUES = ["0.25 [6.4]", "48 000 [330]", ". . .", "0.27–0.93A", "12HB", "−5", "1 1⁄2", "NP"]


@query(f"""SELECT p_partkey, CAST(len(string_split(p_name, ' ')) + 3 AS INTEGER) AS n_tokens, {sql_pick('p_partkey % 8', VALUES)} AS last,
    p_partkey % 8 < 6 AS is_value, CASE WHEN p_partkey % 8 < 6 THEN 2 ELSE 0 END AS n_values FROM part""")
def printed_values(spark, sf_dir):
    row = F.concat_ws(" ", "p_name", F.lit("max 0.30"), pick(F.col("p_partkey") % 8, VALUES))
    words = read(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", text.tokens(row).alias("w"))
    last = F.element_at("w", -1)
    return words.select("p_partkey", F.size("w").alias("n_tokens"), last.alias("last"), text.is_value(last).alias("is_value"), text.trailing_values(F.col("w")).alias("n_values"))


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 8 < 6 THEN p_name || '|0.30|' || {sql_pick('p_partkey % 8', VALUES)} END AS cells FROM part""")
def rows_split_by_count(spark, sf_dir):
    row = F.concat_ws(" ", "p_name", F.lit("0.30"), pick(F.col("p_partkey") % 8, VALUES))
    return read(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", shown(text.split_by_count(row, 3)).alias("cells"))


NAMES, SYMBOLS = ["Carbon", "Manganese", "Chromium", "Cerium", "Cr", "Grade", "Carbon equivalent", "Sulphur", "Aluminium"], ["C", "Mn", "Cr", "OTHER", "Cr", None, None, "S", "Al"]
SUFFIXES, QUALIFIERS = [", max", ", maxC", " minimum [Note (1)]", "", " (heat), min."], ["max", "max", "min", None, "min"]


@query(f"""SELECT p_partkey, {sql_pick('p_size % 9', NAMES)} AS label, {sql_pick('p_partkey % 5', QUALIFIERS)} AS qualifier, {sql_pick('p_size % 9', SYMBOLS)} AS symbol, {sql_pick('p_size % 9', SYMBOLS)} IS NOT NULL AS known FROM part""")
def labels_and_qualifiers(spark, sf_dir):
    printed = F.concat(pick(F.col("p_size") % 9, NAMES), pick(F.col("p_partkey") % 5, SUFFIXES))
    rows = read(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", text.label_and_qualifier(printed).alias("x"), text.element(printed).alias("symbol"))
    return rows.select("p_partkey", "x.label", "x.qualifier", "symbol", F.col("symbol").isNotNull().alias("known"))


LABELS = ["Ultimate tensile, min, ksi", "Yield point", "Elongation in 2 in. [50 mm], min, %", "Reduction in area", "Brinell, max", "Impact of cold work", "Remarks"]
KINDS, GAUGES = ["tensile", "yield", "elongation", "reduction_of_area", "hardness", None, None], [None, None, "2 in. [50 mm]", None, None, None, None]


@query(f"SELECT p_partkey, {sql_pick('p_size % 7', KINDS)} AS property, {sql_pick('p_size % 7', GAUGES)} AS gauge FROM part")
def properties_and_gauges(spark, sf_dir):
    label = pick(F.col("p_size") % 7, LABELS)
    return read(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", text.property_of(label).alias("property"), text.gauge_base(label).alias("gauge"))


TAGLESS = r"trim(regexp_replace({}, '[\s\x{{00A0}}\x{{2007}}\x{{202F}}]+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT page_id, html, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t FROM pages)
    SELECT page_id, {TAGLESS.format('t')} AS plain, {TAGLESS.format("replace(replace(replace(replace(replace(t, '&lt;', '<'), '&quot;', chr(34)), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')")} AS decoded FROM t""")
def entities_of_pages(spark, sf_dir):
    """The text of whole pages; and with every ``&`` written once more as a number: read once, entities stand as before."""
    pages = read(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", text.strip_tags(F.replace("html", F.lit("&"), F.lit("&#38;"))).alias("plain"), text.strip_tags(F.col("html")).alias("decoded"))


@query("""SELECT p_partkey, upper(p_type || ' ' || p_brand) AS search, upper(replace(p_name, ' ', '')) || '-1/2MO' AS composition, CAST(p_size AS VARCHAR) AS spec, p_type AS once FROM part""")
def keys_of_printed_names(spark, sf_dir):
    spec = F.concat(pick(F.col("p_partkey") % 3, ["SA–", "A", "SB-"]), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.search_key(F.col("p_type"), F.lit("…"), F.concat(F.lit("  "), "p_brand")).alias("search"), text.composition_key(F.concat("p_name", F.lit(" – 1∕2Mo"))).alias("composition"),
        text.spec_number(spec).alias("spec"), text.undouble(F.concat_ws(" ", "p_type", "p_type")).alias("once"),
    )


@query("""SELECT p_partkey, '(' || p_size || ')' AS cited, p_name || '|see (1) ' || p_brand || '|' || p_type AS notes, '(' || p_size || ')' AS mark FROM part""")
def notes_of_run_on_text(spark, sf_dir):
    n = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")"))
    run_on = F.concat(F.lit("(1) "), "p_name", F.lit(" (2) see (1) "), "p_brand", F.lit(" (3) "), "p_type")
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.note_reference(F.concat("p_name", F.lit(" [Note "), n, F.lit("]"))).alias("cited"), shown(text.numbered_notes(run_on)).alias("notes"), text.note_mark(F.concat(n, F.lit(" see"))).alias("mark"),
    )


@query(r"""WITH f AS (SELECT doc_id, regexp_replace(text, '[\s\x{00A0}\x{2007}\x{202F}]+', '', 'g') AS t FROM documents)
    SELECT doc_id, CASE WHEN length(t) >= 40 THEN substr(t, CAST(floor((length(t) - 40) / 2) AS INTEGER) + 1, 40) END AS sample FROM f""")
def samples_of_text(spark, sf_dir):
    return read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", text.center_sample(F.col("text")).alias("sample"))


@query("""SELECT p_partkey, p_name || '�' AS legal, upper(replace(p_name, ' ', '')) || 'EC' AS plain, p_partkey % 2 = 0 AS gap FROM part""")
def text_repairs(spark, sf_dir):
    gap = pick(F.col("p_partkey") % 2, [" . . . ", "1.5"])
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.legal_xml(F.concat("p_name", F.lit("\x0b"))).alias("legal"), text.plain_key(F.concat("p_name", F.lit(" éÇ"))).alias("plain"), text.is_ellipsis(gap).alias("gap"),
    )


@query("""SELECT p_partkey, p_size || '/' || (p_partkey % 7 + 1) || ' ≤ ' || p_brand AS formula, '1/' || p_size AS value, 'SLASH' AS change, 'N0' || (1000 + p_partkey % 9000) AS name, CAST(p_size AS DOUBLE) AS number FROM part""")
def formula_and_value_repairs(spark, sf_dir):
    s, n = F.col("p_size").cast("string"), (F.col("p_partkey") % 7 + 1).cast("string")
    cleaned = text.clean_value(F.concat(F.lit("… 1 ∕ "), s))
    merged = text.merged_name(F.concat(F.lit("N0"), (F.col("p_partkey") % 9000 + 1000).cast("string"), F.lit(" "), s))
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.from_latex(F.concat(F.lit(r"$\frac{"), s, F.lit("}{"), n, F.lit(r"} \leq \mathrm{"), "p_brand", F.lit("}$"))).alias("formula"),
        cleaned["value"].alias("value"), cleaned["change"].alias("change"), merged["name"].alias("name"), merged["value"].alias("number"),
    )


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) AS first, round(p_retailprice, 2) AS second, p_size + 0.5 AS inches, p_size * 25.0 AS dn,
    CASE p_partkey % 3 WHEN 0 THEN p_size || ' (STD)' WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE 'XXS' END AS designator FROM part""")
def pipe_dimensions(spark, sf_dir):
    s = F.col("p_size").cast("string")
    dual = numeric.split_dual(F.concat(s, F.lit(" ("), F.format_number("p_retailprice", 2), F.lit(") [Note (1)]")))
    size = numeric.split_size(F.concat(s, F.lit("½ ("), (F.col("p_size") * 25).cast("string"), F.lit(")")))
    of = numeric.designator(pick(F.col("p_partkey") % 3, ["STD", "...", "XXS"]), F.when(F.col("p_partkey") % 3 < 2, s).otherwise("..."))
    return read(spark, sf_dir, "part").select("p_partkey", dual["first"].alias("first"), dual["second"].alias("second"), size["inches"].alias("inches"), size["dn"].alias("dn"), of.alias("designator"))


@query("""SELECT event_id, CASE WHEN event_id % 4 < 2 THEN 1000.0 + event_id % 1000 END AS number, CASE event_id % 4 WHEN 2 THEN '16–23.5' END AS text,
    CASE WHEN event_id % 4 < 2 THEN -(1000.0 + event_id % 1000) END AS loose, CASE event_id % 3 WHEN 0 THEN 1000.0 WHEN 1 THEN 1e-6 ELSE 1.0 END AS factor FROM events""")
def typed_numbers(spark, sf_dir):
    n, k = (F.col("event_id") % 1000).cast("int"), F.col("event_id") % 4
    printed = F.when(k == 0, F.format_number(n + F.lit(1000), 0)).when(k == 1, (n + F.lit(1000)).cast("string")).when(k == 2, "16–23.5").otherwise("…")
    factor = numeric.scale_factor(pick(F.col("event_id") % 3, ["multiply", "divide", "none"]), pick(F.col("event_id") % 3, [3, 6, 0]))
    cell = numeric.typed_cell(printed)
    return read(spark, sf_dir, "events", "event_id").select(
        "event_id", cell["number"].alias("number"), cell["text"].alias("text"), numeric.loose_number(F.concat(F.lit("‒ "), printed)).alias("loose"), factor.alias("factor"),
    )


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, least(l_quantity, 25) * least(l_quantity, 20) AS common FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(common / (q * q + 500 - common), 6) AS ratio, CASE WHEN l_linenumber % 2 = 0 THEN q ELSE 25 END AS used FROM b""")
def overlaps_and_units(spark, sf_dir):
    box = lambda x, y: F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), x.alias("x1"), y.alias("y1"))
    q = F.col("l_quantity").cast("double")
    ratio = numeric.overlap_ratio(box(q, q), box(F.lit(25.0), F.lit(20.0)))
    units = pick(F.col("l_linenumber") % 2, ["SI", "US"])
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(ratio, 6).alias("ratio"), numeric.by_units(units, q, F.lit(25.0)).alias("used"))


@query("""SELECT p_partkey, sha256(p_name) AS digest, '{"key":' || p_partkey || ',"name":"' || p_name || '"}' AS row FROM part""")
def digests_and_json(spark, sf_dir):
    rows = read(spark, sf_dir, "part", "p_partkey", "p_name")
    return rows.select("p_partkey", F.sha2("p_name", 256).alias("digest"), F.to_json(F.struct(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))).alias("row"))


# ---- titles ------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, p_size || 'CR|' || p_size || 'CR-1AL|7NI' AS keys, CASE WHEN p_partkey % 2 = 0 THEN 'Condition ' || p_size END AS condition, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS treatment,
    CASE p_partkey % 3 WHEN 0 THEN 'Group ' || p_size WHEN 1 THEN 'Coefficients for ' || p_brand END AS label, 'coefficients_for_' || p_size || '_b' AS field FROM part""")
def column_titles(spark, sf_dir):
    s = F.col("p_size").cast("string")
    title = F.concat(F.lit("Coefficients for "), s, F.lit("Cr, "), s, F.lit("Cr–1Al, and 7% Nickel Steels"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" (Condition "), s, F.lit(")"))).otherwise(" (Group 1)"), F.lit(" [Note (1)]"))
    column = pick(F.col("p_partkey") % 3, ["G", "T", "B"])
    of = F.when(column == "G", F.concat(F.lit("Coefficients for "), "p_brand", F.lit(" (Group "), s, F.lit(") [Note (1)] B"))).when(column == "T", F.concat(F.lit("Coefficients for "), "p_brand", F.lit(" B"))).otherwise("B")
    return read(spark, sf_dir, "part").select(
        "p_partkey", shown(text.compositions_of(title)).alias("keys"), text.condition_of(title).alias("condition"), text.treatment_of(title).alias("treatment"), text.series_label(of).alias("label"),
        text.field_name(F.concat(F.lit("Coefficients for "), s, F.lit(" [Note (1)] B"))).alias("field"),
    )


@query("""SELECT p_partkey, 'SA-' || p_partkey || '/SA-' || p_partkey || 'M|' || upper(replace(p_name, ' ', '')) || '|SA-' || p_partkey || '|SA-' || p_partkey || 'M' AS names,
    array_to_string(list_sort(list_distinct([p_partkey % 1000, p_size])), '|') AS numbers, 'sa_' || p_partkey || '_sa_' || p_partkey || 'm' AS prefix FROM part""")
def document_names(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    spec, title = F.concat(F.lit("SA-"), k, F.lit("/SA-"), k, F.lit("M")), F.concat("p_name", F.lit(" - a title"))
    page = F.concat((F.col("p_partkey") % 1000).cast("string"), F.lit("\n\nA heading\nline 77 of text\nmore\n"), F.col("p_size").cast("string"), F.lit("\n"))
    rows = read(spark, sf_dir, "part")
    return rows.select("p_partkey", shown(text.designations([spec], title)).alias("names"), shown(text.printed_numbers(page)).alias("numbers"), text.file_prefix(spec, title).alias("prefix"))


@query("""SELECT p_partkey, p_partkey % 4 = 0 AS header, p_partkey % 4 IN (1, 2) AS heading, 'A' AS name, p_name AS quantity, 'in./in.' AS unit, p_partkey % 2 = 0 AS signed, CAST(p_size AS VARCHAR) AS same, true AS cited FROM part""")
def rows_of_recognised_pages(spark, sf_dir):
    k = F.col("p_partkey") % 4
    html = pick(k, ["<tr><th>a</th></tr>", '<tr><td colspan="3">a</td></tr>', "<tr><td>a</td><td></td></tr>", "<tr><td>a</td><td>1</td></tr>"])
    cells = F.when(k <= 1, F.array(F.lit("a"))).when(k == 2, F.array(F.lit("a"), F.lit(""))).otherwise(F.array(F.lit("a"), F.lit("1")))
    line = text.coefficient(F.concat(F.lit("A = "), "p_name", F.lit(", in./in. } in going")))
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.is_header_row(html).alias("header"), text.is_group_row(cells, html).alias("heading"), line["name"].alias("name"), line["quantity"].alias("quantity"), line["unit"].alias("unit"),
        text.has_signature(pick(F.col("p_partkey") % 2, ["CE = C + Mn 6", "CE = C"]), ["CE", "Mn", "6"]).alias("signed"), text.comparison_key(F.concat(F.col("p_size").cast("string"), F.lit(".0 "))).alias("same"),
        text.mentions_number(F.concat(F.lit("folio "), F.col("p_size").cast("string"), F.lit(".")), F.col("p_size")).alias("cited"),
    )


# ---- tables ------------------------------------------------------------------------------------------------


@query(f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_comment, l_suppkey % 9 AS k, row_number() OVER w AS line_no FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS l_suppkey, 'line ' || l_linenumber AS l_comment FROM lineitem GROUP BY 1, 2, 4) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
    c AS (SELECT *, count(*) FILTER (WHERE k > 1) OVER p AS two, count(*) FILTER (WHERE k = 0) OVER p AS one, min(CASE WHEN k > 1 THEN line_no END) OVER p AS two_at, min(CASE WHEN k = 0 THEN line_no END) OVER p AS one_at FROM l WINDOW p AS (PARTITION BY l_orderkey)),
    n AS (SELECT *, CASE WHEN two + one = 0 THEN 1 WHEN two > one OR two = one AND two_at < one_at THEN 3 ELSE 2 END AS cols, greatest(two, one) >= 0.7 * (two + one) AS agreed FROM c),
    d AS (SELECT *, CASE WHEN cols = 1 THEN 'NO_COLUMNS' WHEN k = 1 OR cols = 3 AND k = 0 THEN 'COUNT_MISFIT' ELSE '' END AS why FROM n),
    t AS (SELECT *, cols > 1 AND k = 1 AND coalesce(last_value(CASE WHEN k <> 1 THEN why = '' END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS tail FROM d)
    SELECT l_orderkey, CAST(line_no - 1 AS INTEGER) AS row_no, CAST(l_linenumber AS INTEGER) AS line_no, CASE WHEN tail THEN 'EXACT' WHEN why <> '' THEN 'AMBIGUOUS' ELSE 'BY_COUNT' END AS confidence, CASE WHEN tail THEN 'CONTINUATION' ELSE why END AS reason,
        CASE WHEN cols = 1 THEN 'NO_COLUMNS' WHEN agreed THEN 'COUNT' ELSE 'COUNT_IN_DOUBT' END AS origin, CASE WHEN k = 1 THEN 'header' WHEN true THEN 'data' END AS kind,
        CASE WHEN tail THEN 'tail and so on' || repeat('|', cols - 1) WHEN k = 1 THEN 'tail and so on' WHEN why <> '' THEN 'row 0.30' WHEN k = 0 THEN 'row|0.30' WHEN cols = 2 THEN 'row 0.25|' || {sql_pick('k % 6', VALUES[:6])} ELSE 'row|0.25|' || {sql_pick('k % 6', VALUES[:6])} END AS cells FROM t""")
def tables_without_geometry(spark, sf_dir):
    """An order's lines as the rows of a table: some end in two values, some in one, some in none."""
    k = F.col("l_suppkey") % 9
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("l_suppkey"))
    text_ = F.when(k == 0, "row 0.30").when(k == 1, "tail and so on").otherwise(F.concat(F.lit("row 0.25 "), pick(k % 6, VALUES)))
    y0 = (F.col("l_linenumber") * 10).cast("double")
    lines = lines.select("l_orderkey", text_.alias("text"), F.lit(10.0).alias("x0"), y0.alias("y0"), F.lit(200.0).alias("x1"), (y0 + 6).alias("y1"), F.lit(1).alias("page"), F.col("l_linenumber").cast("int").alias("line_no"))
    return layout.reconstruct_tables(lines, ["l_orderkey"]).select("l_orderkey", "row_no", "line_no", "confidence", "reason", "origin", "kind", shown(F.col("cells")).alias("cells"))


@query("""SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS row_no, 'EXACT' AS confidence, 'BANDS' AS origin,
    'order ' || o_orderkey || '|' || CAST(floor(o_totalprice) AS BIGINT) || '|' || o_orderstatus AS cells FROM orders""")
def tables_with_bands(spark, sf_dir):
    rows = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    y0 = (F.col("o_orderkey") * 10).cast("double")
    part = lambda no, t, a, b: F.struct(t.alias("text"), F.lit(a).alias("x0"), F.lit(b).alias("x1"), (F.col("o_orderkey") * 3 + no).alias("line_no"))
    three = F.array(part(0, F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), 10.0, 40.0), part(1, F.floor("o_totalprice").cast("string"), 60.0, 80.0), part(2, F.col("o_orderstatus"), 100.0, 130.0))
    lines = rows.select("o_custkey", F.explode(three).alias("p"), y0.alias("y0"), (y0 + 6).alias("y1"), F.lit(1).alias("page")).select("o_custkey", "p.*", "y0", "y1", "page")
    return layout.reconstruct_tables(lines, ["o_custkey"]).select("o_custkey", "row_no", "confidence", "origin", shown(F.col("cells")).alias("cells"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, max(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 AS is_data, o_orderstatus FROM orders)
    SELECT o_custkey, count(*) FILTER (WHERE is_data) AS n_data, coalesce(string_agg(o_orderstatus, ' ' ORDER BY o_orderkey) FILTER (WHERE NOT is_data), '') AS first_column FROM r GROUP BY o_custkey""")
def headers_of_tables(spark, sf_dir):
    cell = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.floor("o_totalprice").cast("string"), F.lit(" [1]"))).otherwise("requirement")
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.array(F.col("o_orderstatus"), cell).alias("cells"))
    split = tables.split_header(rows, ["o_custkey"], "o_orderkey", "cells")
    names = tables.column_names(split.where("not is_data"), ["o_custkey"], "o_orderkey", "cells").where("column_no = 0")
    n = split.groupBy("o_custkey").agg(F.count(F.when(F.col("is_data"), 1)).alias("n_data"))
    return n.join(names, "o_custkey", "left").select("o_custkey", "n_data", F.coalesce("name", F.lit("")).alias("first_column"))


@query(f"""WITH c AS (SELECT p_type, p_brand, {sql_pick('p_partkey % 9', ['C', 'Mn', 'Cr', None, 'Cr', None, None, None, None])} AS s, {sql_pick('p_partkey % 9', NAMES)} AS label, CAST(p_size AS VARCHAR) AS v FROM part)
    SELECT p_type, p_brand, string_agg(v, ' / ' ORDER BY v) FILTER (WHERE s = 'C') AS C, string_agg(v, ' / ' ORDER BY v) FILTER (WHERE s = 'Mn') AS Mn,
        string_agg(v, ' / ' ORDER BY v) FILTER (WHERE s = 'Cr') AS Cr, string_agg(label || ' ' || v, '; ' ORDER BY label || ' ' || v) FILTER (WHERE s IS NULL) AS others FROM c GROUP BY 1, 2""")
def composition_tables(spark, sf_dir):
    cells = read(spark, sf_dir, "part").select("p_type", "p_brand", pick(F.col("p_partkey") % 9, NAMES).alias("label"), F.col("p_size").cast("string").alias("v"))
    return tables.composition(cells, ["p_type"], "p_brand", "label", "v", ["C", "Mn", "Cr"])


PROPERTIES = ["Tensile strength, min", "Yield strength", "Elongation in 2 in.", "Remarks"]


@query("""WITH c AS (SELECT p_type, p_brand, p_partkey % 4 AS k, CAST(p_size AS VARCHAR) AS v FROM part WHERE p_partkey % 4 < 3)
    SELECT p_type, p_brand, coalesce(string_agg(v, ' / ' ORDER BY v) FILTER (WHERE k = 0), '') AS tensile, coalesce(string_agg(v, ' / ' ORDER BY v) FILTER (WHERE k = 1), '') AS yield FROM c GROUP BY 1, 2""")
def strength_tables(spark, sf_dir):
    cells = read(spark, sf_dir, "part").select("p_type", "p_brand", pick(F.col("p_partkey") % 4, PROPERTIES).alias("label"), F.col("p_size").cast("string").alias("v"))
    got = tables.strength(cells, ["p_type"], "p_brand", "label", "v", ["tensile", "yield"])
    return got.select("p_type", "p_brand", F.coalesce("tensile", F.lit("")).alias("tensile"), F.coalesce("yield", F.lit("")).alias("yield"))


@query("""SELECT conv_id, '(' || turn || ')' AS note, '(' || turn || ') ' || role AS text FROM conversations WHERE turn BETWEEN 1 AND 3""")
def notes_in_regions(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    line = F.when(F.col("turn") == 0, "NOTES").when(F.col("turn") == 4, "Table 9").otherwise(F.concat(F.lit("("), F.col("turn").cast("string"), F.lit(") "), "role"))
    lines = turns.withColumn("line", line)
    found = tables.note_regions(lines, ["conv_id"], ["turn"], F.col("line") == "NOTES", F.col("line").startswith("Table"), "line")
    return found.select("conv_id", "note", "text")


TWINS = ["IDENTICAL", "SPACES", "CASE", "MARKS", "NUMBERS", "DIFFERENT"]


@query(f"SELECT p_partkey, {sql_pick('p_partkey % 6', TWINS)} AS kind FROM part")
def twin_texts(spark, sf_dir):
    a = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))
    b = [a, F.replace(a, F.lit(" "), F.lit("  ")), F.upper(a), F.concat(a, F.lit("!")), F.concat(F.lit("other "), F.col("p_size").cast("string")), F.lit("nothing alike")]
    other = F.coalesce(*[F.when(F.col("p_partkey") % 6 == i, x) for i, x in enumerate(b)])
    return read(spark, sf_dir, "part").select("p_partkey", tables.twin_class(a, other).alias("kind"))


@query("""WITH s AS (SELECT p_type, p_brand, list_sort(list_distinct(list(p_size % 3))) AS members FROM part GROUP BY 1, 2)
    SELECT p_type, array_to_string(members, '|') AS members, string_agg(p_brand, '|' ORDER BY p_brand) AS notes FROM s GROUP BY 1, 2 HAVING count(*) > 1""")
def notes_with_the_same_members(spark, sf_dir):
    found = tables.repeated_notes(read(spark, sf_dir, "part").select("p_type", "p_brand", (F.col("p_size") % 3).alias("m")), "p_type", "p_brand", "m")
    return found.select("p_type", shown(F.col("members")).alias("members"), shown(F.col("notes")).alias("notes"))


@query("""WITH n AS (SELECT 'table_' || p_partkey AS name, p_size AS c FROM part UNION ALL SELECT 'table_table_' || p_partkey, p_size + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END FROM part WHERE p_partkey % 3 = 0)
    SELECT a.name, b.name AS twin, a.c = b.c AS identical FROM n a JOIN n b ON b.name = 'table_' || a.name""")
def duplicate_files(spark, sf_dir):
    from lamina.sources.documents import copies

    parts, key = read(spark, sf_dir, "part", "p_partkey", "p_size"), F.col("p_partkey").cast("string")
    doubled = parts.where("p_partkey % 3 = 0").select(F.concat(F.lit("table_table_"), key).alias("name"), (F.col("p_size") + F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(0)).cast("string").alias("c"))
    files = parts.select(F.concat(F.lit("table_"), key).alias("name"), F.col("p_size").cast("string").alias("c")).union(doubled)
    twins = tables.twin_names(files.select("name"), "name")
    return copies(files, "name", "c").join(twins, ["name", "twin"])


@query("""SELECT p_partkey, p_name AS shown FROM part WHERE p_partkey % 4 <> 0""")
def filled_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, "  ").otherwise(F.col("p_name")).alias("name_as_printed"), F.lit(None).cast("string").alias("v"))
    kept = tables.drop_empty(rows, ["name_as_printed"], ["v"])
    return kept.select("p_partkey", tables.first_named(kept, ["title", "name_as_printed"]).alias("shown"))


@query("""SELECT o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1""")
def states_histogram(spark, sf_dir):
    return tables.states(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("state")), "state")


@query("""SELECT p_brand, bool_and(p_size % 7 <> 0) AS closed, coalesce(array_to_string(list_sort(list_distinct(list('size ' || p_size) FILTER (WHERE p_size % 7 = 0))), '|'), '') AS unresolved FROM part GROUP BY 1""")
def closed_vocabulary(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_brand", F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("label"), F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("found"))
    return tables.fully_named(rows, ["p_brand"], "label", F.col("found")).select("p_brand", "closed", shown(F.col("unresolved")).alias("unresolved"))


@query("""WITH b AS (SELECT l_orderkey, l_quantity, CASE WHEN l_quantity - lag(l_quantity) OVER w > 10 THEN 1 ELSE 0 END AS nw FROM (SELECT DISTINCT l_orderkey, l_quantity FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity))
    SELECT l_orderkey, l_quantity, CAST(sum(nw) OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS BIGINT) AS band FROM b""")
def bands_by_gap(spark, sf_dir):
    return tables.bands_by_gap(read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").distinct(), ["l_orderkey"], "l_quantity", 10.0)


@query("""WITH w AS (SELECT p_partkey, list_transform(string_split(p_name || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' ' || p_type END, ' '), lambda x: upper(x[1]) || lower(x[2:])) AS w FROM part)
    SELECT p_partkey, len(w) = 2 AS fits, CASE WHEN len(w) = 2 THEN w[2] END AS second FROM w""")
def headings_in_parts(spark, sf_dir):
    """Headings of two names that run on, and of three."""
    name = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit(" "), "p_type")))
    parts = text.split_heading(F.initcap(name), 2)
    return read(spark, sf_dir, "part").select("p_partkey", parts.isNotNull().alias("fits"), F.get(parts, F.lit(1)).alias("second"))


@query(r"""SELECT doc_id, list_contains(regexp_extract_all(text, '\d+'), CAST(doc_id % 10 AS VARCHAR)) AS numbered, contains(text, 'the') AND contains(text, ',') AS signed FROM documents""")
def signatures_of_documents(spark, sf_dir):
    """Documents that have a number as a word of its own, and those with all the marks of a block."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", text.mentions_number(F.col("text"), F.col("doc_id") % 10).alias("numbered"), text.has_signature(F.col("text"), ["the", ","]).alias("signed"))
