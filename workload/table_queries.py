"""Files, table rewrites and the plain relational building blocks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from clientele.operators.joins import exclude, explode_ids, update_from
from clientele.operators.pick import first_n_per_key
from clientele.operators.reshape import count_columns, union_all
from clientele.operators.rewrite import add_after, delete_where, set_where
from clientele.operators.shares import share_of_count, share_of_sum
from clientele.plans import quality, staging, value
from clientele.sources import exports, schemas, tables
from workload.registry import cash, query, rounded, slash_date

EXPORTS_AT_A_TIME = 4

_EXPORTED = ["order_id", "contact_id", "inv_total", "balance", "date"]


@query(f"""
SELECT order_id, contact_id, CAST({cash("inv_total")} AS DOUBLE) AS inv_total, CAST({cash("balance")} AS DOUBLE) AS balance,
  CAST({cash("inv_total")} - {cash("balance")} AS DOUBLE) AS inv_paid, {slash_date("date")} AS date
FROM {{invoices_staged}}""")
def q_csv_roundtrip(i):
    names = schemas.INVOICES.fieldNames()
    have = i.invoices_staged.select(*_EXPORTED)
    staged = have.select(*(F.col(c) if c in have.columns else F.lit(None).cast("string").alias(c) for c in names))
    path = tables.new_table_path(i.spark, "invoices-export")
    exports.write_export(staged, path)
    export = exports.read_export(i.spark, path, schemas.INVOICES)
    return value.clean_invoices(exports.good_rows(export)).select(*_EXPORTED, "inv_paid")


def _through_file(i, rows, layout, encoding="UTF-8"):
    """Write rows as an export of the layout, columns they lack left empty, and read it again."""
    have = set(rows.columns)
    full = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in layout]
    path = tables.new_table_path(i.spark, "export")
    exports.write_export(rows.select(*full), path, encoding=encoding)
    return exports.good_rows(exports.read_export(i.spark, path, layout, encoding=encoding))


def _slash_text(day):
    return F.date_format(day, "M/d/yyyy")


@query("""
SELECT contact_id, 'Señor "' || name || '", küche' AS name, CASE WHEN country = '' THEN NULL ELSE country END AS country,
  product, CASE WHEN inv_id % 5 = 0 THEN 0 ELSE CAST(invoice AS DOUBLE) * 1000 + 0.5 END AS invoice, count(*) AS n
FROM {purchases} GROUP BY ALL""".replace("CASE WHEN inv_id % 5 = 0 THEN 0 ELSE", "CASE WHEN inv_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE"))
def q_export_purchases(i):
    amount = F.concat(F.lit("$"), F.format_number(F.col("invoice") * 1000 + F.lit(0.5).cast("decimal(2,1)"), 2))
    rows = i.purchases.select(
        "contact_id",
        F.concat(F.lit('Señor "'), "name", F.lit('", küche')).alias("name"),
        F.when(F.col("country") != "", F.col("country")).alias("country"),
        "product",
        F.when(F.col("inv_id") % 5 == 0, " ").otherwise(amount).alias("invoice"),
    )
    read = staging.clean_purchases(_through_file(i, rows, schemas.WEEKLY_PURCHASES, "ISO-8859-1"))
    return read.groupBy("contact_id", "name", "country", "product", "invoice").agg(F.count("*").alias("n"))


@query("""
SELECT contact_id, batch_id, sent, opened, clicked, link, count(*) AS n FROM {mail_activity} GROUP BY ALL""")
def q_export_mail_activity(i):
    days = {c: F.coalesce(_slash_text(c), F.lit(" ")) for c in ("sent", "opened", "clicked")}
    rows = i.mail_activity.withColumns(days)
    read = staging.clean_mail_activity(_through_file(i, rows, schemas.MAIL_ACTIVITY))
    keys = ["contact_id", "batch_id", "sent", "opened", "clicked", "link"]
    return read.groupBy(*keys).agg(F.count("*").alias("n"))


@query("""
SELECT mail_id, date, template FROM {broadcasts}""")
def q_export_broadcasts(i):
    rows = i.broadcasts.withColumn("date", F.concat(_slash_text("date"), F.lit(" 9:05")))
    return staging.clean_broadcasts(_through_file(i, rows, schemas.BROADCASTS)).select("mail_id", "date", "template")


@query("""
SELECT contact_id, provider, CASE WHEN contact_id % 7 = 0 THEN NULL ELSE date END AS date, count(*) AS n FROM (
  SELECT o_custkey AS contact_id, 'rep, ' || CAST(o_custkey % 4 AS VARCHAR) AS provider, CAST(o_orderdate AS DATE) AS date
  FROM {orders}) AS o GROUP BY ALL""")
def q_export_consults(i):
    key = F.col("o_custkey")
    dotted = F.date_format("o_orderdate", "M.d.yyyy")
    rows = i.orders.select(
        key.alias("contact_id"),
        F.concat(F.lit("rep, "), (key % 4).cast("string")).alias("provider"),
        F.when(key % 7 == 0, "next week").otherwise(dotted).alias("date"),
    )
    read = staging.clean_consult_bookings(_through_file(i, rows, schemas.CONSULT_BOOKINGS))
    return read.groupBy("contact_id", "provider", "date").agg(F.count("*").alias("n"))


def _layout_cells(layout):
    """SQL for a made-up value of every column of a layout, in the part Spark and DuckDB share.

    Customers with odd keys come in the export's other version, which lacks the last column.
    """
    cells = {}
    for k, f in enumerate(layout):
        kind = f.dataType.simpleString()
        if kind in ("bigint", "int"):
            cell = f"CAST(c_custkey % 1000 + {k} AS {kind})"
        elif kind == "date":
            cell = f"(DATE '2020-01-01' + CAST(c_custkey % 300 + {k} AS INT))"
        else:
            cell = f"(CASE WHEN c_custkey % {k + 2} = 0 THEN NULL ELSE 't{k}, \"' || CAST(c_custkey AS STRING) END)"
        if k == len(layout) - 1:
            cell = f"(CASE WHEN c_custkey % 2 = 0 THEN {cell} END)"
        cells[f.name] = (kind, cell)
    return cells


def _of_kind(cells, kinds):
    return [c for kind, c in cells.values() if kind in kinds]


def _layout_sql(name):
    cells = _layout_cells(schemas.LAYOUTS[name])
    total = lambda parts, empty: " + ".join(f"coalesce({x}, 0)" for x in parts) or empty
    numbers = total(_of_kind(cells, ("bigint", "int")), "0")
    letters = total([f"length({c})" for c in _of_kind(cells, ("string",))], "0")
    days = total([f"date_diff('day', DATE '2020-01-01', {c})" for c in _of_kind(cells, ("date",))], "0")
    return f"""
SELECT '{name}' AS layout, count(*) AS rows_read, CAST(0 AS BIGINT) AS bad_rows, count(*) FILTER (c_custkey % 2 = 1) AS unknown_cells,
  CAST(sum({numbers}) AS BIGINT) AS numbers, CAST(sum({letters}) AS BIGINT) AS letters, CAST(sum({days}) AS BIGINT) AS days
FROM {{customer}}"""


@query(" UNION ALL ".join(_layout_sql(name) for name in sorted(schemas.LAYOUTS)))
def q_export_layouts(i):
    """Every layout read back by header from two versions of its export.

    The other version has its columns in reverse order under other names, lacks the last one and
    has one that no layout knows.
    """
    parts = []
    # Written once over all cores, as sixty jobs read it.
    customer = tables.save(
        tables.spread(i.customer.select("c_custkey", "c_mktsegment")), tables.new_table_path(i.spark, "customer")
    )

    def write(name):
        path = tables.new_table_path(i.spark, f"export-{name}")
        layout = schemas.LAYOUTS[name]
        cells = _layout_cells(layout)
        other = {new: old for old, new in schemas.aliases_of(layout).items() if old not in cells}
        titles = {c: other.get(c, c).replace("_", " ").title() for c in cells}
        first = customer.filter("c_custkey % 2 = 0").selectExpr(*(f"{cell} AS {c}" for c, (_, cell) in cells.items()))
        reverse = [f"{cell} AS `{titles[c]}`" for c, (_, cell) in reversed(list(cells.items())[:-1])]
        second = customer.filter("c_custkey % 2 = 1").selectExpr("c_mktsegment AS `Hobby`", *reverse)
        for version in (first, second):
            exports.write_export(version, path, mode="append")
        return path

    # Several exports at a time, so that cores don't wait for the last task of each.
    names = sorted(schemas.LAYOUTS)
    with ThreadPoolExecutor(EXPORTS_AT_A_TIME) as pool:
        paths = dict(zip(names, pool.map(inheritable_thread_target(i.spark)(write), names), strict=True))
    for name, path in paths.items():
        layout = schemas.LAYOUTS[name]
        cells = _layout_cells(layout)
        read = exports.read_by_header(i.spark, path, layout, schemas.aliases_of(layout))
        good = F.col(exports.BAD_ROW).isNull()
        of = lambda kinds, cells=cells: [F.col(c) for c, (kind, _) in cells.items() if kind in kinds]
        total = lambda columns: sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0)).cast("long")
        parts.append(
            read.agg(
                F.lit(name).alias("layout"),
                F.count_if(good).alias("rows_read"),
                F.count_if(~good).alias("bad_rows"),
                F.sum(F.size(F.map_filter(exports.UNKNOWN, lambda _, v: v.isNotNull()))).cast("long").alias("unknown_cells"),
                F.sum(total(of(("bigint", "int")))).alias("numbers"),
                F.sum(total([F.length(c) for c in of(("string",))])).alias("letters"),
                F.sum(total([F.datediff(c, F.lit("2020-01-01").cast("date")) for c in of(("date",))])).alias("days"),
            )
        )
    return union_all(*parts)


@query("""
SELECT o_orderstatus AS stage, count(*) AS n FROM {orders} GROUP BY o_orderstatus""")
def q_publish(i):
    """A report written under display names, and read again by its header."""
    path = tables.new_table_path(i.spark, "published")
    report = i.orders.groupBy(F.col("o_orderstatus").alias("stage")).agg(F.count("*").alias("n"))
    tables.publish(report, path, {"stage": "Stage (as of today)", "n": "# of orders"})
    shown = {"stage_as_of_today": "stage", "of_orders": "n"}
    return exports.good_rows(exports.read_by_header(i.spark, path, schemas.layout("stage", "n:long"), shown))


@query("""
SELECT count(*) AS rows_read, count(*) FILTER (o_custkey % 7 = 0) AS bad_rows,
  min(o_custkey) FILTER (o_custkey % 7 <> 0) AS low_key, max(o_custkey) FILTER (o_custkey % 7 <> 0) AS high_key
FROM {orders}""")
def q_csv_bad_rows(i):
    key = F.when(F.col("o_custkey") % 7 == 0, "no number").otherwise(F.col("o_custkey").cast("string"))
    rows = i.orders.select(key.alias("id"), F.lit("asked, twice").alias("reason"))
    path = tables.new_table_path(i.spark, "no-call-export")
    exports.write_export(rows, path)
    return exports.load_report(exports.read_export(i.spark, path, schemas.NO_CALL))


@query("""
SELECT o_orderkey AS order_id, o_orderstatus AS stage FROM {orders} WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, 'closed' FROM {orders} WHERE o_orderstatus = 'F'""")
def q_append(i):
    path = tables.new_table_path(i.spark, "orders-appended")
    orders = i.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("stage"))
    tables.save(orders.filter("stage <> 'F'"), path)
    closed = orders.filter("stage = 'F'").withColumn("stage", F.lit("closed"))
    return tables.save(closed, path, append=True)


@query("""
SELECT o_orderkey AS order_id, o_totalprice AS total FROM {orders} WHERE o_totalprice >= 100000""")
def q_replace(i):
    path = tables.new_table_path(i.spark, "orders-replaced")
    orders = i.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))
    tables.save(orders, path)
    return tables.save(orders.filter("total >= 100000"), path)


@query("""
SELECT o_orderkey AS order_id, o_totalprice + 1 AS total FROM {orders} WHERE o_totalprice >= 100000""")
def q_replace_itself(i):
    """A table replaced by rows that are read from it while it is replaced."""
    path = tables.new_table_path(i.spark, "orders-rewritten")
    orders = i.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))
    kept = tables.save(orders, path).filter("total >= 100000")
    return tables.save(kept.withColumn("total", F.col("total") + 1), path)


@query("""
SELECT o_orderstatus, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_left, min(o_orderkey) AS low_key,
  max(o_orderkey) AS high_key FROM {orders} GROUP BY o_orderstatus""")
def q_empty(i):
    """What a table held before it was emptied, and what it holds after, counted from its files."""
    path = tables.new_table_path(i.spark, "orders-emptied")
    counted = lambda df: df.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("low_key"), F.max("o_orderkey").alias("high_key")
    )
    before = tables.save(counted(tables.save(i.orders.select("o_orderkey", "o_orderstatus"), path)), f"{path}-before")
    after = tables.save(counted(tables.empty(i.spark, path)), f"{path}-after")
    if not tables.drop(i.spark, path):
        raise OSError(f"{path} was not there")
    both = union_all(
        before.withColumns({"rows_before": F.col("n"), "rows_left": F.lit(0)}),
        after.withColumns({"rows_before": F.lit(0), "rows_left": F.col("n")}),
    )
    return both.groupBy("o_orderstatus").agg(
        F.sum("rows_before").alias("rows_before"), F.sum("rows_left").alias("rows_left"),
        F.min("low_key").alias("low_key"), F.max("high_key").alias("high_key"),
    )


@query("""
SELECT column_name AS name, non_null AS filled FROM (
  UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM {orders}) ON COLUMNS(*) INTO NAME column_name VALUE non_null)""")
def q_show_schema(i):
    """The columns of a table with how many rows fill each."""
    filled = i.orders.agg(*(F.count(c).alias(c) for c in i.orders.columns))
    return filled.unpivot([], i.orders.columns, "name", "filled")


@query("""
SELECT opp_id, opp, stage, next_action_date, loss_reason, order_revenue FROM {opportunities_before}""")
def q_snapshot_week(i):
    path = tables.new_table_path(i.spark, "opportunity-snapshots")
    cols = ["opp_id", "opp", "stage", "next_action_date", "loss_reason", "order_revenue"]
    tables.save_snapshot(i.opportunities.select(*cols), path, "w98_24")
    tables.save_snapshot(i.opportunities_before.select(*cols), path, "w98_23")
    return tables.read_snapshot(i.spark, path, "w98_23")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' ELSE o_orderpriority END AS o_orderpriority,
  upper(o_orderstatus) || '!' AS o_orderstatus, o_totalprice > 300000 AS is_big
FROM {orders}""")
def q_update_where(i):
    orders = i.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    orders = set_where(orders, "o_orderpriority", F.col("o_totalprice") > 300000, "big")
    orders = orders.withColumn("o_orderstatus", F.concat(F.upper("o_orderstatus"), F.lit("!")))
    return add_after(orders, "o_orderkey", "is_big", F.col("o_totalprice") > 300000).drop("o_totalprice")


@query("""
SELECT c.contact_id, coalesce(z.reason, c.lead_source) AS lead_source, z.reason AS reason
FROM {contacts} AS c LEFT JOIN (SELECT * FROM {no_call} WHERE reason IS NOT NULL) AS z ON z.id = c.contact_id""")
def q_update_from(i):
    listed = i.no_call.filter("reason IS NOT NULL").withColumnRenamed("id", "contact_id")
    base = i.contacts.select("contact_id", "lead_source")
    return update_from(base, listed, "contact_id", lead_source="reason", reason="reason")


@query("""
SELECT opp_id, next_action_date FROM {opportunities}
WHERE next_action_date IS NULL OR next_action_date < DATE '1999-01-01'""")
def q_delete_where(i):
    rows = i.opportunities.select("opp_id", "next_action_date")
    return delete_where(rows, F.col("next_action_date") >= F.lit("1999-01-01").cast("date"))


@query("""
SELECT c_custkey AS id FROM {customer} WHERE c_custkey NOT IN (SELECT user_id FROM {events})""")
def q_not_listed(i):
    ids = i.customer.select(F.col("c_custkey").alias("id"))
    return exclude(ids, i.events.select(F.col("user_id").alias("id")), "id")


@query("""
SELECT user_id, part, string_agg(link, ',' ORDER BY link) AS links FROM (
  SELECT user_id, link, (row_number() OVER (PARTITION BY user_id ORDER BY link) - 1) // 25 AS part FROM (
    SELECT CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id END AS user_id,
      '/p/' || CAST(event_id % 7 AS VARCHAR) AS link FROM {events}) AS e) AS p
GROUP BY user_id, part""")
def q_string_agg(i):
    links = i.events.select(
        F.when(F.col("user_id") % 50 != 0, F.col("user_id")).alias("user_id"), F.concat(F.lit(" /p/"), (F.col("event_id") % 7).cast("string")).alias("link")
    )
    return quality.joined_text_per_key(links, "user_id", "link", "links", part_rows=25)


@query("""
SELECT inv_id, contact_id, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY contact_id) AS share FROM {mail_invoices}""")
def q_share_of_count(i):
    rows = i.mail_invoices.select("inv_id", "contact_id")
    return share_of_count(rows, "contact_id", "inv_id", "share")


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 8) AS share,
  l_quantity FROM {lineitem}""")
def q_share_of_sum(i):
    rows = i.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    shared = share_of_sum(rows, "l_orderkey", "l_quantity", "share")
    return rounded(shared, "share", digits=8)


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM {orders}) AS o
WHERE place <= 3""")
def q_first_n(i):
    rows = i.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return first_n_per_key(rows, "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], 3, "place")


@query("""
SELECT DISTINCT order_id, unnest(string_split(product_ids, ',')) AS id FROM {invoices}
WHERE product_ids <> ''""")
def q_id_list(i):
    return explode_ids(i.invoices, "product_ids", "id").select("order_id", "id")


@query("""
SELECT o_orderpriority AS value FROM (SELECT DISTINCT o_orderpriority FROM {orders}) AS o""")
def q_values(i):
    return quality.values_of(i.orders, "o_orderpriority").withColumnRenamed("o_orderpriority", "value")


@query("""
SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_orderstatus = 'O') AS opened,
  count(*) FILTER (o_orderstatus IN ('P', 'X')) AS pending, count(DISTINCT o_orderpriority) AS priorities,
  max(o_totalprice) AS largest
FROM {orders} GROUP BY o_custkey""")
def q_count_pivot(i):
    status = F.col("o_orderstatus")
    cells = {"filled": status == "F", "opened": status == "O", "pending": status.isin("P", "X")}
    return i.orders.groupBy("o_custkey").agg(
        *count_columns(cells),
        F.countDistinct("o_orderpriority").alias("priorities"),
        F.max("o_totalprice").alias("largest"),
    )


@query("""
SELECT s_suppkey AS id, s_name AS name, NULL AS segment, s_nationkey % 2 = 0 AS even FROM {supplier}
UNION ALL SELECT c_custkey, c_name, c_mktsegment, NULL FROM {customer}
""".replace("NULL AS segment", "CAST(NULL AS VARCHAR) AS segment"))
def q_union_all(i):
    left = i.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        (F.col("s_nationkey") % 2 == 0).alias("even"),
    )
    right = i.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return union_all(left, right)


@query("""
SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 200""")
def q_limit(i):
    rows = i.orders.select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(200)
