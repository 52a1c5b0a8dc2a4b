"""File formats: whole tables written, then read back by each scan."""

from pyspark.sql import functions as F

from millrace.plans.bindings import table
from millrace.queries.registry import query
from millrace.session import scratch
from millrace.sinks import tables as S
from millrace.sources import files, html

ORDERS = "SELECT * FROM orders"


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderpriority FROM orders""")
def csv_text_scan(spark, folder):
    path = scratch(spark, "csv")
    day = F.to_date("o_orderdate").alias("order_day")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", day, "o_orderpriority")
    S.write_csv(orders, path)
    return files.read_csv_text(spark, path)


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderstatus FROM orders")
def csv_inferred_scan(spark, folder):
    path = scratch(spark, "csv")
    S.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path)
    return files.read_csv_inferred(spark, path)


@query(ORDERS)
def csv_typed_roundtrip(spark, folder):
    path, orders = scratch(spark, "csv"), table(spark, folder, "orders")
    S.write_csv(orders, path)
    return files.read_csv_typed(spark, path, orders.schema)


@query("SELECT c_custkey AS customer, c_nationkey AS nation, c_acctbal AS balance FROM customer")
def csv_untidy_header(spark, folder):
    """Names quoted behind leading blanks, values behind blanks, a blank line: renamed by position."""
    path = scratch(spark, "csv")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    padded = customers.select(
        F.col("c_custkey").cast("string").alias("Key"),
        F.concat(F.lit("  "), F.col("c_nationkey").cast("string")).alias(" Nation"),
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string")).alias(" Balance"),
    )
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    renamed = files.read_csv_renamed(spark, path, ["customer", "nation", "balance"])
    return renamed.select(F.col("customer").cast("bigint"), F.col("nation").cast("int"), "balance")


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN ts END AS ts, event_type,
    CAST(NULL AS VARCHAR) AS absent FROM events""")
def json_lines_declared(spark, folder):
    """Declared fields over JSON lines; the text None and absent fields read as null."""
    path = scratch(spark, "json")
    shown = F.when(F.col("event_id") % 4 == 0, "None").otherwise(F.col("ts").cast("string"))
    table(spark, folder, "events").select("event_id", shown.alias("ts"), "event_type").write.json(path)
    schema = "event_id bigint, ts timestamp, event_type string, absent string"
    return files.read_json_lines(spark, path, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""SELECT o_orderkey AS "order.key", o_orderstatus AS "order.state.code", o_totalprice AS total FROM orders""")
def json_documents_flattened(spark, folder):
    """Files that each hold one JSON array of nested documents over many lines, flattened to dotted names."""
    path = scratch(spark, "json")
    state = F.struct(F.col("o_orderstatus").alias("code"))
    order = F.struct(F.col("o_orderkey").alias("key"), state.alias("state"))
    document = F.struct(order.alias("order"), F.col("o_totalprice").alias("total"))
    # A thousand consecutive order keys per file: the key is unique, so a file stays small.
    chunks = table(spark, folder, "orders").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("chunk"))
    arrays = chunks.agg(F.to_json(F.collect_list(document), {"pretty": "true"}).alias("value"))
    arrays.write.partitionBy("chunk").text(path)
    schema = "order struct<key: bigint, state: struct<code: string>>, total double"
    return files.read_json_documents(spark, path, schema).drop("chunk")


@query(ORDERS)
def json_roundtrip(spark, folder):
    path, orders = scratch(spark, "json"), table(spark, folder, "orders")
    S.write_json(orders, path)
    return files.read_json_lines(spark, path, orders.schema)


@query(ORDERS)
def parquet_roundtrip(spark, folder):
    path = scratch(spark, "parquet")
    S.write_parquet(table(spark, folder, "orders"), path)
    return files.read_parquet(spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def orc_roundtrip(spark, folder):
    path = scratch(spark, "orc")
    S.write_orc(table(spark, folder, "orders"), path)
    return files.read_orc(spark, path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def xml_roundtrip(spark, folder):
    path = scratch(spark, "xml")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    S.write_xml(customers, path)
    return files.read_xml(spark, path, ["row"], customers.schema)


@query("""SELECT CAST(p_partkey AS DOUBLE) AS "X", CAST(p_size AS DOUBLE) AS "Y", p_retailprice AS "Z" FROM part
    UNION ALL SELECT CAST(s_suppkey AS DOUBLE), CAST(s_nationkey AS DOUBLE), s_acctbal FROM supplier""")
def xml_mixed_tags(spark, folder):
    """Rows under different tags: one scan per tag, united."""
    path = scratch(spark, "xml")
    columns = ["X", "Y", "Z"]
    parts = table(spark, folder, "part").selectExpr("double(p_partkey) X", "double(p_size) Y", "p_retailprice Z")
    makers = table(spark, folder, "supplier").selectExpr("double(s_suppkey) X", "double(s_nationkey) Y", "s_acctbal Z")
    S.write_xml(parts, f"{path}/a", "root", "A")
    S.write_xml(makers, f"{path}/b", "root", "B")
    return files.read_xml(spark, f"{path}/*", ["A", "B"], "X double, Y double, Z double").select(*columns)


@query("SELECT o_orderstatus, CAST(max(o_orderkey) AS BIGINT) AS newest FROM orders GROUP BY 1")
def view_sql(spark, folder):
    return files.query_view(
        table(spark, folder, "orders"), "shop_orders_view",
        "SELECT o_orderstatus, max(o_orderkey) AS newest FROM shop_orders_view GROUP BY o_orderstatus",
    )


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def guarded_read(spark, folder):
    """A missing folder is skipped; a present one is read."""
    path = scratch(spark, "csv")
    assert files.read_if_present(spark, path) is None
    S.write_csv(table(spark, folder, "customer").select("c_custkey", "c_name"), path)
    return files.read_if_present(spark, path)


@query("""SELECT to_json(props)->>'k' AS k, event_id FROM (SELECT event_id, CAST(props AS JSON) AS props FROM events
    WHERE json_extract_string(props, '$.k') = '7') ORDER BY event_id DESC""")
def document_find(spark, folder):
    """Documents with a nested field equal to a value, projected and sorted."""
    path = scratch(spark, "documents")
    body = F.from_json("props", "k int").alias("body")
    table(spark, folder, "events").select("event_id", body).write.json(path)
    collection = spark.read.schema("event_id bigint, body struct<k: int>").json(path)
    found = files.find(collection, {"body.k": 7}, ["event_id", "body.k"], [("event_id", False)])
    return found.withColumn("k", F.col("k").cast("string"))


LINKS = r"""SELECT page_id, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS item, unnest(f) AS f FROM
    (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS f FROM pages)"""


@query(f"""SELECT page_id, item, nullif(trim(regexp_extract(f, '<a[^>]*>([^<]*)</a>', 1)), '') AS title,
    nullif(trim(regexp_extract(f, 'href="([^"]*)"', 1)), '') AS url FROM ({LINKS})""")
def html_listing(spark, folder):
    """Links listed in every page."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    cells = {"title": html.Cell([r"<a[^>]*>([^<]*)</a>"]), "url": html.Cell([r'href="([^"]*)"'])}
    return html.listing(pages, "html", r"(?s)<li>(.*?)</li>", cells)


@query(r"""SELECT page_id, CAST(0 AS INTEGER) AS item,
      trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS title,
      replace(replace(trim(regexp_extract(html, '<p><b>([^<]*)<', 1)), ',', ''), ' the', '') AS lead
    FROM pages WHERE html LIKE '%<article>%</article>%'""")
def html_articles(spark, folder):
    """One row per article; the lead falls back to a second pattern and loses commas and a suffix word."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    cells = {
        "title": html.Cell([r"<h1>([^<]*)</h1>"]),
        "lead": html.Cell([r'<p class="lead">([^<]*)<', r"<p><b>([^<]*)<"], [" the"]),
    }
    return html.listing(pages, "html", r"(?s)<article>(.*?)</article>", cells)


@query(r"""SELECT page_id, CAST(0 AS INTEGER) AS item, CAST(len(c) AS INTEGER) AS cell_count,
    CAST(list_sum([length(trim(x)) for x in c]) AS BIGINT) AS cell_length FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '<li><a[^>]*>([^<]*)</a></li>', 1) AS c
    FROM pages WHERE html LIKE '%<ul>%</ul>%')""")
def html_cell_texts(spark, folder):
    """Menu rows as lists of cell texts."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    rows = html.cell_texts(pages, "html", r"(?s)<ul>(.*?)</ul>", r"<li><a[^>]*>([^<]*)</a></li>")
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda n, x: n + F.length(x))
    return rows.select("page_id", "item", F.size("cells").alias("cell_count"), total.alias("cell_length"))



@query("""WITH cut AS (SELECT page_id, unnest(string_split(html, '<div class="ad">')[2:]) AS rest,
      generate_subscripts(string_split(html, '<div class="ad">')[2:], 1) AS n FROM pages)
    SELECT page_id, CAST(n - 1 AS INTEGER) AS item, string_split(rest, '</div>')[1] AS inner FROM cut""")
def html_by_class(spark, folder):
    """What the elements of one class hold, in every page."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    return html.elements(pages, "html", html.Selector("div", ["ad"])).drop("opening")


@query("""WITH menu AS (SELECT page_id, string_split(string_split(html, '<nav>')[2], '</nav>')[1] AS nav FROM pages),
    cut AS (SELECT page_id, unnest(string_split(nav, '<a href="')[2:]) AS rest,
      generate_subscripts(string_split(nav, '<a href="')[2:], 1) AS n FROM menu)
    SELECT page_id, CAST(n - 1 AS INTEGER) AS item, string_split(rest, '"')[1] AS url,
      string_split(string_split(rest, '>')[2], '<')[1] AS title FROM cut""")
def html_menu_entries(spark, folder):
    """Links of the entries of every page's menu: list items inside one element, read by selectors."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    menus = html.elements(pages, "html", html.Selector("nav")).select("page_id", "inner")
    link = [html.Selector("a", (), {"href": None})]
    parts = {"url": html.Part(link, attribute="href"), "title": html.Part(link)}
    return html.selected_listing(menus, "inner", html.Selector("li"), parts)
