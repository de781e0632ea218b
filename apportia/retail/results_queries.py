"""Value added, index and participation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import rules
from apportia.operators import joins, pairs, results, rollups
from apportia.plans import energy, invoices, ledger, loose, telecom, transport
from apportia.retail import frames as R
from apportia.retail.registry import ORACLE, query
from apportia.retail.sql import CODES, PARTS, text, using
from apportia.session import cut_lineage

DOC_COLUMNS = """order_key, supplier_key, doc_type, period, CAST(value_added AS DOUBLE) AS value_added,
    CAST(value_out AS DOUBLE) AS value_out, appropriation, CAST(reason AS INTEGER) AS reason"""


@query(using("docs", then=f"SELECT {DOC_COLUMNS} FROM docs"))
def participation_split(spark, sf):
    """Invoice roll-up: participating and other value, appropriation and reason per document."""
    return R.documents(spark, sf).select(
        *R.DOC, "doc_type", "period", "value_added", "value_out", "appropriation", "reason"
    )


@query(using("va", then="""SELECT doc_type, period, direction, reg, muni, CAST(value_added AS DOUBLE) AS value_added FROM va"""))
def value_added(spark, sf):
    return results.value_added(R.documents(spark, sf), R.registry(spark, sf), R.munis(spark, sf), R.HOME)


@query(using("va", then=f""", net AS (SELECT CAST(period // 100 AS INTEGER) AS year, COALESCE(parent, v.muni) AS place, reg,
        SUM(CASE WHEN direction = 'S' THEN value_added ELSE -value_added END) AS net
        FROM va v JOIN munis m ON m.muni = v.muni AND m.state = '{R.HOME}' GROUP BY 1, 2, 3),
    place AS (SELECT year, place, SUM(CASE WHEN net > 0 THEN net ELSE 0 END) AS va_muni FROM net GROUP BY 1, 2),
    total AS (SELECT *, SUM(va_muni) OVER (PARTITION BY year) AS va_state FROM place)
    SELECT year, place AS muni, CAST(va_muni AS DOUBLE) AS va_muni, CAST(va_state AS DOUBLE) AS va_state,
        CAST(CASE WHEN va_state <> 0 THEN (CAST(va_muni * 100 AS HUGEINT) * CAST(1000000000000000000 AS HUGEINT))
            // CAST(va_state * 100 AS HUGEINT) END AS BIGINT) AS share_units
    FROM total"""))
def municipal_index(spark, sf):
    """Yearly index; share_units is the share in units of 10^-18, cut off."""
    va = results.value_added(R.documents(spark, sf), R.registry(spark, sf), R.munis(spark, sf), R.HOME)
    index = results.municipal_index(va, R.munis(spark, sf), R.HOME)
    units = (F.col("share") * F.lit(10**16).cast("decimal(17,0)")).cast("bigint")
    return index.select("year", "muni", "va_muni", "va_state", units.alias("share_units"))


def reloaded_month(spark, sf):
    """(documents that go, those that come): a month is loaded again with every second order, at twice the value."""
    docs = cut_lineage(R.documents(spark, sf))
    gone = docs.where("period = 199703")
    twice = (2 * F.col("value_added")).cast("decimal(17,2)")
    return docs, gone, gone.where("order_key % 2 = 0").withColumn("value_added", twice)


RELOADED_VA = """, changed AS (SELECT * REPLACE (CASE WHEN period = 199703 THEN 2 * value_added ELSE value_added END AS value_added) FROM docs
    WHERE NOT (period = 199703 AND order_key % 2 = 1)), va AS (""" + PARTS["va"].replace("FROM docs d", "FROM changed d") + ")"


def refreshed_totals(spark, sf):
    docs, gone, come = reloaded_month(spark, sf)
    registry, munis = R.registry(spark, sf), R.munis(spark, sf)
    before = cut_lineage(results.value_counted(docs.withColumn("__sign", F.lit(1)), registry, munis, R.HOME))
    change = cut_lineage(results.value_change(gone, come, registry, munis, R.HOME))
    return before, change, results.merge_totals(before, change), munis


@query(using("docs", "registry", then=RELOADED_VA + " SELECT doc_type, period, direction, reg, muni, CAST(value_added AS DOUBLE) AS value_added FROM va"))
def value_added_refreshed(spark, sf):
    """Stored totals after a reload, by what it takes away and adds."""
    return refreshed_totals(spark, sf)[2].drop("documents")


@query(using("docs", "registry", then=RELOADED_VA + ORACLE["municipal_index"].split("GROUP BY 1, 2, 3, 4, 5)", 1)[1].replace(" FROM total", " FROM total WHERE year = 1997")))
def index_refreshed(spark, sf):
    """The index of the year that a reload touched, from the municipalities that it touched."""
    before, change, totals, munis = refreshed_totals(spark, sf)
    index = results.refreshed_index(results.municipal_index(before, munis, R.HOME), totals, change, munis, R.HOME)
    units = (F.col("share") * F.lit(10**16).cast("decimal(17,0)")).cast("bigint")
    return index.select("year", "muni", "va_muni", "va_state", units.alias("share_units"))


@query(using("items", then=f"""SELECT order_key, supplier_key, bool_or(op_code IN ({CODES})) AS code_participates,
    bool_or(substr(product_code, 7) IN ('1', '2', '3')) AS product_participates,
    CAST(SUM(CASE WHEN op_code IN ({CODES}) THEN value_added ELSE 0 END) AS DOUBLE) AS value_added,
    CAST(MAX(item_no) AS INTEGER) AS doc_type FROM items GROUP BY 1, 2"""))
def item_rollup(spark, sf):
    items = joins.participation_flag(R.net_items(spark, sf), R.codes_frame(spark), "op_code", "code", "code_participates")
    items = items.withColumns(
        {
            "product_participates": F.substring("product_code", 7, 9).isin("1", "2", "3"),
            "value_added": rules.value_or_zero("value_added", "code_participates"),
            "item_doc_type": F.col("item_no"),
        }
    )
    return rollups.item_rollup(items, R.DOC)


@query(using("split", then="""SELECT order_key, supplier_key, CAST(value_in AS DOUBLE) AS value_in,
    CAST(value_out AS DOUBLE) AS value_out, CAST(CASE WHEN value_in = 0 THEN 12 END AS INTEGER) AS reason FROM split"""))
def ledger_split(spark, sf):
    items = joins.participation_flag(R.net_items(spark, sf), R.codes_frame(spark), "op_code", "code", "code_participates")
    return ledger.settle(items, R.DOC)


@query(using("items", then=f""", s AS (SELECT order_key, supplier_key,
        SUM(CASE WHEN op_code IN ({CODES}) AND NOT gone THEN value_added ELSE 0 END) AS value_in,
        SUM(CASE WHEN op_code IN ({CODES}) AND NOT gone THEN 0 ELSE value_added END) AS value_out
        FROM (SELECT *, return_flag = 'R' AS gone FROM items) GROUP BY 1, 2)
    SELECT order_key, supplier_key, CAST(value_in AS DOUBLE) AS value_in, CAST(value_out AS DOUBLE) AS value_out,
        CAST(CASE WHEN value_in = 0 THEN 12 END AS INTEGER) AS reason, 'E' AS appropriation FROM s"""))
def telecom_split(spark, sf):
    """Returned lines stand for cancelled telecom items."""
    items = R.net_items(spark, sf).withColumn("situation", F.when(F.col("return_flag") == "R", "S").otherwise("N"))
    return telecom.run(items, R.codes_frame(spark), R.DOC)


@query(using("items", then=f""", f AS (SELECT *, op_code IN ({CODES}) AS code_ok, item_no <= 4 AS class_ok,
        value_added * (CASE WHEN item_no = 2 THEN -1 ELSE 1 END) * (CASE WHEN return_flag = 'R' THEN -1 ELSE 1 END) AS v FROM items),
    s AS (SELECT order_key, SUM(CASE WHEN code_ok AND class_ok THEN v ELSE 0 END) AS value_in,
        SUM(CASE WHEN code_ok AND class_ok THEN 0 ELSE v END) AS value_out FROM f GROUP BY 1)
    SELECT order_key, CAST(CASE WHEN c THEN 0 ELSE value_in END AS DOUBLE) AS value_in,
        CAST(CASE WHEN c THEN value_in + value_out ELSE value_out END AS DOUBLE) AS value_out,
        CAST(CASE WHEN c THEN 10 WHEN value_in = 0 THEN 12 END AS INTEGER) AS reason
    FROM (SELECT s.*, COALESCE(o_orderstatus = 'P', false) AS c FROM s LEFT JOIN orders ON o_orderkey = order_key)"""))
def energy_split(spark, sf):
    """Line numbers stand for energy classes: 1 to 4 participate, class 2 is outgoing."""
    items = R.net_items(spark, sf).select(
        "order_key", "op_code", F.col("item_no").alias("energy_class"), F.col("value_added").alias("value"),
        F.when(F.col("return_flag") == "R", "1").otherwise("0").alias("returned"),
    )
    classes = items.select("energy_class").distinct().where("energy_class <= 4").withColumn(
        "direction", F.when(F.col("energy_class") == 2, "S").otherwise("E")
    )
    cancelled = R.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("order_key"))
    return energy.settle(energy.flag_items(items, R.codes_frame(spark), classes), cancelled, "order_key").drop("cancelled")


@query("""SELECT o_orderkey AS order_key, CAST(CASE WHEN h OR p_out THEN 0 ELSE v END AS DOUBLE) AS value_in,
    CAST(CASE WHEN h OR p_out THEN v ELSE 0 END AS DOUBLE) AS value_out,
    CAST(CASE WHEN v <> 0 AND NOT (h OR p_out) THEN NULL WHEN short THEN 14 WHEN o_orderstatus = 'F' THEN 13
        WHEN o_orderstatus = 'P' THEN 10 ELSE 12 END AS INTEGER) AS reason
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(17,2)) AS v, o_totalprice < 100000 AS short,
            o_orderstatus IN ('F', 'P') OR o_totalprice < 100000 AS h, o_orderpriority = '5-LOW' AS p_out FROM orders)""")
def transport_split(spark, sf):
    """Orders as transport documents; status stands for annulment and substitution."""
    o = R.table(spark, sf, "orders")
    docs = o.select(
        F.col("o_orderkey").alias("order_key"), R.dec("o_totalprice").alias("value_added"),
        F.when(F.col("o_orderstatus") == "P", "A").alias("annulment_key"),
        F.when(F.col("o_orderstatus") == "F", "B").otherwise("0").alias("substitute_key"),
        F.lit(100000).cast("decimal(17,2)").alias("received"),
        (F.col("o_orderpriority") != "5-LOW").alias("code_participates"),
    )
    return transport.settle(docs, "order_key").drop("annulled", "replaced", "short")


@query(using("heads", then="""SELECT order_key, supplier_key, CAST(CASE WHEN parties_out THEN 11 WHEN cancelled THEN 10 END AS INTEGER) AS reason
    FROM heads"""))
def loose_reasons(spark, sf):
    rolled = invoices.roll_items(R.net_items(spark, sf), R.codes_frame(spark), R.DOC)
    docs = R.with_headers(spark, sf, rolled).withColumn(
        "note_status", F.when(F.col("cancelled"), "VOID").otherwise("NORMAL")
    )
    return loose.settle(docs).select(*R.DOC, "reason")


@query(using("heads", then=f"""SELECT i.order_key, i.supplier_key, i.item_no, COUNT(*) AS n,
    CAST(CASE WHEN bool_or(parties_out) THEN 11 WHEN bool_or(cancelled) THEN 10
        WHEN op_code IN ({CODES}) THEN NULL ELSE 1 END AS INTEGER) AS reason
    FROM items i JOIN heads h USING (order_key, supplier_key) GROUP BY i.order_key, i.supplier_key, i.item_no, op_code"""))
def item_reasons(spark, sf):
    items = joins.participation_flag(R.net_items(spark, sf), R.codes_frame(spark), "op_code", "code", "code_participates")
    rolled = rollups.participation_split(items, R.DOC)
    docs = R.with_headers(spark, sf, rolled)
    docs = docs.withColumn(
        "parties_out", rules.both_parties_out(("entry_status", "entry_regime"), ("exit_status", "exit_regime"))
    )
    out = invoices.item_reasons(items, docs, R.DOC)
    return out.groupBy(*R.DOC, "item_no", "op_code", "reason").agg(F.count("*").alias("n")).drop("op_code")


PAIR_DOCS = """, pd AS (SELECT l_orderkey, l_suppkey AS exit_reg, l_suppkey % 5 AS exit_state, o_custkey AS entry_reg, o_custkey % 5 AS entry_state
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    ord AS (SELECT *, (exit_reg, exit_state) <= (entry_reg, entry_state) AS fwd FROM pd),
    pc AS (SELECT CASE WHEN fwd THEN exit_reg ELSE entry_reg END AS a_reg, CASE WHEN fwd THEN exit_state ELSE entry_state END AS a_state,
        CASE WHEN fwd THEN entry_reg ELSE exit_reg END AS b_reg, CASE WHEN fwd THEN entry_state ELSE exit_state END AS b_state,
        SUM(CASE WHEN fwd THEN 1 ELSE 0 END) AS a_to_b, SUM(CASE WHEN fwd THEN 0 ELSE 1 END) AS b_to_a FROM ord GROUP BY 1, 2, 3, 4)"""


def trade_docs(spark, sf):
    """Every line as a document between two numbered taxpayers."""
    line, orders = R.table(spark, sf, "lineitem"), R.table(spark, sf, "orders")
    o = orders.select(F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("entry_reg"))
    docs = line.select(F.col("l_orderkey").alias("doc"), F.col("l_suppkey").alias("exit_reg")).join(o, "doc")
    # A taxpayer's state follows from its number, so both roles agree on it.
    return docs.withColumns({"exit_state": F.col("exit_reg") % 5, "entry_state": F.col("entry_reg") % 5})


@query("WITH x AS (SELECT 1)" + PAIR_DOCS + """ SELECT a_reg, a_state, b_reg, b_state, CAST(a_to_b AS BIGINT) AS a_to_b,
    CAST(b_to_a AS BIGINT) AS b_to_a FROM pc WHERE a_to_b > 0 AND b_to_a > 0""")
def bidirectional_pairs(spark, sf):
    return pairs.bidirectional_pairs(trade_docs(spark, sf))


@query("WITH x AS (SELECT 1)" + PAIR_DOCS + """ SELECT pd.l_orderkey AS doc, pd.exit_reg, pd.entry_reg, COUNT(*) AS n FROM pd
    WHERE EXISTS (SELECT 1 FROM pc WHERE a_to_b > 0 AND b_to_a > 0 AND (
        (pc.a_reg = pd.exit_reg AND pc.a_state = pd.exit_state AND pc.b_reg = pd.entry_reg AND pc.b_state = pd.entry_state)
        OR (pc.a_reg = pd.entry_reg AND pc.a_state = pd.entry_state AND pc.b_reg = pd.exit_reg AND pc.b_state = pd.exit_state)))
    GROUP BY 1, 2, 3""")
def pair_either_way(spark, sf):
    docs = trade_docs(spark, sf)
    found = pairs.between_listed_pairs(docs, pairs.bidirectional_pairs(docs))
    return found.groupBy("doc", "exit_reg", "entry_reg").agg(F.count("*").alias("n"))


def trade_items(spark, sf):
    """Items between municipalities: nation of the supplier sells to nation of the customer."""
    i = R.net_items(spark, sf).where(F.col("op_code").isin(*[str(c) for c in (1101, 1102, 1116, 1201, 1410, 5101, 5102, 5116, 5201, 5410)]))
    o = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("c"))
    cust = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), F.col("c_nationkey").alias("entry_reg"))
    supp = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier_key"), F.col("s_nationkey").alias("exit_reg"))
    return i.join(o, "order_key").join(cust, "c").join(supp, "supplier_key").withColumns(
        {"entry_state": F.lit("X"), "exit_state": F.lit("X"), "product": F.substring("product_code", 1, 8)}
    )


TRADE = """, mirror AS (SELECT * FROM (VALUES ('5101', '1101'), ('5102', '1102'), ('5116', '1116'), ('5201', '1201'), ('5410', '1410')) t(x, e)),
    both_ways AS (SELECT x AS code, e AS other FROM mirror UNION ALL SELECT e, x FROM mirror),
    ti AS (SELECT i.*, s_nationkey AS exit_reg, c_nationkey AS entry_reg, substr(product_code, 1, 8) AS product FROM items i
        JOIN orders ON order_key = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON supplier_key = s_suppkey
        WHERE op_code IN (SELECT code FROM both_ways)),
    tot AS (SELECT entry_reg, exit_reg, op_code, product, SUM(value_added) AS value_added, SUM(gross) AS gross FROM ti GROUP BY 1, 2, 3, 4),
    opp AS (SELECT a.* FROM tot a JOIN both_ways m ON m.code = a.op_code JOIN tot b ON b.entry_reg = a.exit_reg AND b.exit_reg = a.entry_reg
        AND b.op_code = m.other AND b.product = a.product WHERE a.gross < b.gross)"""


@query(using("items", then=TRADE + " SELECT entry_reg, exit_reg, op_code, product, CAST(value_added AS DOUBLE) AS value_added, CAST(gross AS DOUBLE) AS gross FROM tot"))
def operation_totals(spark, sf):
    return pairs.operation_totals(trade_items(spark, sf)).drop("entry_state", "exit_state")


@query(using("items", then=TRADE + " SELECT entry_reg, exit_reg, op_code, product FROM opp"))
def opposite_ops(spark, sf):
    totals = pairs.operation_totals(trade_items(spark, sf))
    return pairs.opposite_operations(totals).drop("entry_state", "exit_state")


@query(using("items", then=TRADE + """, d AS (SELECT order_key, SUM(ti.gross) AS before, SUM(CASE WHEN opp.op_code IS NULL THEN ti.gross ELSE 0 END) AS value_added
        FROM ti LEFT JOIN opp ON opp.entry_reg = ti.entry_reg AND opp.exit_reg = ti.exit_reg AND opp.op_code = ti.op_code AND opp.product = ti.product GROUP BY 1)
    SELECT order_key, CAST(value_added AS DOUBLE) AS value_added, CAST(CASE WHEN value_added = 0 THEN 12 END AS INTEGER) AS reason
    FROM d WHERE before <> value_added"""))
def duplicate_exclusion(spark, sf):
    """Documents whose value changes when opposite operations are taken out."""
    items = trade_items(spark, sf)
    excluded = pairs.opposite_operations(pairs.operation_totals(items))
    return pairs.exclude_opposite(items, excluded, ["order_key"])[1]


def invoice_and_ledger(spark, sf):
    """Filled lines as invoice items, open lines as ledger items, matched by order."""
    line = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item_no"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"),
        F.col("l_shipdate").alias("ship"), "l_linestatus", "l_returnflag", "l_discount", "l_tax",
    )
    invoice, book = line.where("l_linestatus = 'F'"), line.where("l_linestatus = 'O'")
    return invoice, book


ITEM_ORDER = ["item_no", "part", "supp", "price", "qty", "ship"]
NUMBERED = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS position FROM lineitem),
    i AS (SELECT * FROM n WHERE l_linestatus = 'F'), b AS (SELECT * FROM n WHERE l_linestatus = 'O')"""


def matched_positions(spark, sf):
    from apportia.operators import spans

    invoice, book = invoice_and_ledger(spark, sf)
    keep = ["doc", *ITEM_ORDER]
    return pairs.positional_match(
        invoice.select(*keep), book.select(*keep), ["doc"], ITEM_ORDER, spans.number_span("item_no", 4)
    )


@query(NUMBERED + """ SELECT COALESCE(i.l_orderkey, b.l_orderkey) AS doc, COALESCE(i.position, b.position) AS position,
    i.l_partkey AS part_invoice, b.l_partkey AS part_ledger, i.l_extendedprice AS price_invoice, b.l_extendedprice AS price_ledger
    FROM i FULL OUTER JOIN b ON i.l_orderkey = b.l_orderkey AND i.position = b.position""")
def positional_match(spark, sf):
    return matched_positions(spark, sf).select(
        "doc", "position", "part_invoice", "part_ledger", "price_invoice", "price_ledger"
    )


@query(NUMBERED + """ SELECT DISTINCT i.l_orderkey AS doc, i.l_linenumber AS item_no, CAST(3 AS INTEGER) AS reason
    FROM i JOIN b ON i.l_orderkey = b.l_orderkey AND i.position = b.position""")
def fixed_asset_items(spark, sf):
    return pairs.fixed_assets(matched_positions(spark, sf), ["doc"], "item_no")[0]


@query(NUMBERED + """ SELECT DISTINCT i.l_orderkey AS doc, CAST(0 AS DOUBLE) AS value_added, CAST(12 AS INTEGER) AS reason
    FROM i JOIN b ON i.l_orderkey = b.l_orderkey AND i.position = b.position""")
def fixed_asset_documents(spark, sf):
    return pairs.fixed_assets(matched_positions(spark, sf), ["doc"], "item_no")[1]


@query("""SELECT DISTINCT o.o_orderkey AS access_key, o.o_custkey AS ledger_id, 5 AS ledger_type, l.l_suppkey AS invoice_id,
    CASE WHEN l.l_returnflag = 'N' THEN 10 ELSE 2 END AS invoice_type
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag IN ('N', 'A')""")
def ledger_match(spark, sf):
    o, line = R.table(spark, sf, "orders"), R.table(spark, sf, "lineitem")
    books = o.select(F.col("o_orderkey").alias("access_key"), F.col("o_custkey").alias("doc_id"), F.lit(K.LEDGER).alias("doc_type"))
    inv = lambda f, t: line.where(F.col("l_returnflag") == f).select(
        F.col("l_orderkey").alias("access_key"), F.col("l_suppkey").alias("doc_id"), F.lit(t).alias("doc_type")
    )
    return pairs.match_by_key(books, inv("N", K.ISSUED_INVOICE), inv("A", K.RECEIVED_INVOICE), "access_key")
