"""Document loads, corrections and reports end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia.operators import commits
from apportia.plans import corrections, dispatch, energy, goods, ledger, loose, references, reports, store, ticket, transport
from apportia.retail import frames as R
from apportia.retail.function_queries import kinds
from apportia.retail.registry import ORACLE, query
from apportia.retail.sql import CODES, using
from apportia.session import cut_lineage, shared_folder
from apportia.sources import tables


def two_phase_registry(spark, sf) -> DataFrame:
    """Every customer with one version up to mid 1998 and one after it."""
    c = R.customers(spark, sf).join(R.munis(spark, sf).select("muni", "state"), "muni")
    at = lambda t: F.lit(t).cast("timestamp")
    early = c.withColumns(
        {"valid_from": at("1990-01-01 00:00:00"), "valid_to": at("1998-06-30 23:59:59"), "rural": F.lit(False), "status": F.lit("1")}
    )
    late = c.withColumns({"valid_from": at("1998-07-01 00:00:00"), "valid_to": F.lit(None).cast("timestamp")})
    return early.unionByName(late)


PHASES = """, phases AS (SELECT c.id, c.reg, c.muni, m.state, '1' AS status, regime, false AS rural, TIMESTAMP '1990-01-01 00:00:00' AS valid_from,
        TIMESTAMP '1998-06-30 23:59:59' AS valid_to FROM customers c JOIN munis m USING (muni)
    UNION ALL SELECT c.id, c.reg, c.muni, m.state, status, regime, rural, TIMESTAMP '1998-07-01 00:00:00', NULL FROM customers c JOIN munis m USING (muni))"""


def reference_catalog(spark, sf) -> dict:
    """Code lists, parameters, events and municipalities of the loads."""
    e = R.table(spark, sf, "events")
    pairs = lambda *p: spark.createDataFrame(list(p), "code string, participates string")
    return {
        "op_codes": pairs(("5101", "S"), ("5102", "sim"), ("1949", "N"), ("1949", "?")),
        "products": pairs(("1", "S"), ("00000002", "TRUE"), ("3", "N")),
        "params": spark.createDataFrame([("usar_x", "1"), ("use_municipalities", "nao")], "name string, value string"),
        "events": e.select(F.floor(F.col("event_id") / 3).cast("string").alias("access_key"), kinds().alias("kind"), F.col("ts").cast("timestamp").alias("at")),
        "municipalities": R.munis(spark, sf),
    }


def goods_catalog(spark, sf) -> dict:
    """Section tables of the lake layout from orders, customers and line items.

    Four sections are columns of the same heads and three of the same rows: both are stored once.
    """
    o, c = R.table(spark, sf, "orders"), R.table(spark, sf, "customer")
    m = R.munis(spark, sf)
    key, at = F.col("o_orderkey").cast("string"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    head = cut_lineage(o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(m, F.col("c_nationkey") == F.col("muni")).select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_custkey", "o_totalprice", "c_nationkey", "state",
    ))
    base = lambda *cols: head.select(key.alias("chavenfe"), at.alias("ide_dhemi_nums"), *cols)
    second = F.substring("o_orderpriority", 1, 1) == "2"
    line = R.table(spark, sf, "lineitem")
    gross = R.dec("l_extendedprice")
    # Whether the greatest text is this one, told by flags: a greatest text itself would have all rows sorted first.
    greatest = lambda c, v: F.coalesce(F.bool_or(F.col(c) == v) & ~F.bool_or(F.col(c) > v), F.lit(False))
    rows = cut_lineage(line.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(gross).alias("vprod"), F.sum(R.part_of(gross, "l_discount")).alias("vdesc"),
        F.sum(R.dec("l_quantity")).alias("qcom"), greatest("l_linestatus", "O").alias("open"),
        greatest("l_returnflag", "R").alias("returned"), F.sum(R.part_of(gross, "l_tax")).alias("tax"),
    )).withColumns({"chavenfe": F.col("l_orderkey").cast("string"), "det_nitem": F.col("l_linenumber")})
    when = o.select("o_orderkey", at.alias("ide_dhemi_nums")).hint("merge")
    return reference_catalog(spark, sf) | {
        "goods_header": base(
            F.when(F.col("o_orderpriority") == "5-LOW", "65").otherwise("55").alias("ide_mod"), F.lit("1").alias("ide_tpamb"),
            F.lit(52).alias("ide_cuf"), F.col("c_nationkey").alias("ide_cmunfg"), F.lit("12345678000195").alias("emit_cnpj"),
        ),
        "goods_issuer": base(F.col("c_nationkey").cast("string").alias("cmun"), F.lower("state").alias("uf"), F.col("o_custkey").cast("string").alias("ie")),
        "goods_recipient": base(
            F.lit(None).cast("string").alias("cmun"), F.when(second, R.HOME).otherwise("X").alias("uf"),
            F.concat(F.lit("IE "), F.col("o_orderkey") % 1000).alias("ie"),
        ),
        "goods_total": base(F.col("o_totalprice").alias("vnf")),
        "goods_item": rows.join(when, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "chavenfe", "ide_dhemi_nums", "det_nitem", F.when(F.col("open"), "5.101").otherwise("1949").alias("cfop"),
            F.col("det_nitem").cast("string").alias("ncm"), "qcom", "vprod", "vdesc",
        ),
        "goods_item_tax": rows.select("chavenfe", "det_nitem", F.col("qcom").alias("icms10_vicmsst")),
        "goods_item_ipi": rows.where("returned").select("chavenfe", "det_nitem", F.col("tax").alias("ipitrib_vipi")),
    }


GOODS = PHASES + f""", rows AS (SELECT l_orderkey AS k, l_linenumber AS item_no, SUM(CAST(l_extendedprice AS DECIMAL(17,2))) AS gross,
        SUM(CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(17,2))) AS discount,
        SUM(CAST(l_quantity AS DECIMAL(17,2))) AS qty, MAX(l_linestatus) AS s, MAX(l_returnflag) AS r,
        SUM(CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2))) AS tax FROM lineitem GROUP BY 1, 2),
    valued AS (SELECT *, gross - discount + qty + CASE WHEN r = 'R' THEN tax ELSE 0 END AS v, s = 'O' AS counted FROM rows),
    rolled AS (SELECT k, bool_or(counted) AS code, bool_or(item_no IN (1, 2)) AS product, SUM(CASE WHEN counted THEN v ELSE 0 END) AS value_added FROM valued GROUP BY 1),
    ev AS (SELECT event_id // 3 AS k, bool_or(event_type = 'signup') AS cancelled, bool_or(event_type = 'error') AS substituted FROM events GROUP BY 1),
    d AS (SELECT o.o_orderkey AS k, o.o_custkey AS exit_reg, o.o_orderkey % 1000 AS entry_reg, m.state AS exit_state,
            CASE WHEN o_orderpriority = '2-HIGH' THEN '{R.HOME}' ELSE 'X' END AS entry_state, o_orderdate, o_totalprice, o_orderpriority,
            COALESCE(ev.cancelled, false) AS cancelled, COALESCE(ev.substituted, false) AS substituted,
            COALESCE(code, false) AS code, COALESCE(product, false) AS product, COALESCE(value_added, 0) AS value_added
        FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN munis m ON m.muni = c_nationkey LEFT JOIN ev ON ev.k = o_orderkey LEFT JOIN rolled r ON r.k = o_orderkey
        WHERE m.state = '{R.HOME}' OR o_orderpriority = '2-HIGH'),
    p AS (SELECT d.*, COALESCE(x.rural, false) OR COALESCE(n.rural, false) AS rural, x.status = '1' AND (x.regime = '2' OR x.rural) AS x_ok,
            n.status = '1' AND (n.regime = '2' OR n.rural) AS n_ok
        FROM d LEFT JOIN phases x ON x.reg = d.exit_reg AND x.state = d.exit_state AND o_orderdate BETWEEN x.valid_from AND COALESCE(x.valid_to, o_orderdate)
        LEFT JOIN phases n ON n.reg = d.entry_reg AND n.state = d.entry_state AND o_orderdate BETWEEN n.valid_from AND COALESCE(n.valid_to, o_orderdate)),
    kept AS (SELECT * FROM p WHERE o_orderpriority <> '5-LOW' AND NOT cancelled AND NOT substituted AND (code OR (product AND rural)))"""


def goods_parts(spark, sf):
    catalog = goods_catalog(spark, sf)
    parts = {n: tables.read_section(spark, catalog, n) for n in goods.SECTIONS}
    return parts, references.load(spark, catalog)


@query(using("munis", "customers", then=GOODS + """ SELECT CAST(k AS VARCHAR) AS access_key, 10 AS doc_type, CAST(entry_reg AS DOUBLE) AS entry_reg, CAST(exit_reg AS DOUBLE) AS exit_reg,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total, CAST(value_added AS DOUBLE) AS value_added,
    CASE WHEN x_ok AND n_ok THEN 'A' WHEN n_ok THEN 'E' WHEN x_ok THEN 'S' ELSE 'N' END AS appropriation FROM kept"""))
def goods_load(spark, sf):
    """Goods invoices from their sections to participating documents."""
    parts, ref = goods_parts(spark, sf)
    docs, _ = goods.run(parts, ref, two_phase_registry(spark, sf), 1, "55", R.HOME, ("1995-01-01", "2001-12-31"))
    return docs.select("access_key", "doc_type", "entry_reg", "exit_reg", "period", "total", "value_added", "appropriation")


@query(using("munis", "customers", then=GOODS + """ SELECT CAST(k AS VARCHAR) AS access_key, item_no, CASE WHEN s = 'O' THEN '5101' ELSE '1949' END AS op_code, '0000000' || item_no AS product_code,
    CAST(gross AS DOUBLE) AS gross, CAST(qty AS DOUBLE) AS substituted_tax, CAST(CASE WHEN counted THEN v ELSE 0 END AS DOUBLE) AS value_added, CAST(CASE WHEN NOT counted THEN 1 END AS INTEGER) AS reason
    FROM valued WHERE k IN (SELECT k FROM kept)"""))
def goods_load_items(spark, sf):
    parts, ref = goods_parts(spark, sf)
    _, items = goods.run(parts, ref, two_phase_registry(spark, sf), 1, "55", R.HOME, ("1995-01-01", "2001-12-31"), store=cut_lineage)
    return items.select("access_key", "item_no", "op_code", "product_code", "gross", "substituted_tax", "value_added", "reason")


def order_heads(spark, sf):
    o, c, m = R.table(spark, sf, "orders"), R.table(spark, sf, "customer"), R.munis(spark, sf)
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(m, F.col("c_nationkey") == F.col("muni"))


def coded(spark, sf, second: str):
    """Events of three consecutive numbers belong to one document."""
    kind = F.when(F.col("event_type") == "signup", "110111").when(F.col("event_type") == "view", second).otherwise("0")
    return R.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 3).cast("string").alias("access_key"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("at")
    )


EVENTS = "ev AS (SELECT event_id // 3 AS k, bool_or(event_type = 'signup') AS c, bool_or(event_type = 'view') AS s FROM events GROUP BY 1)"


@query(using("munis", then=f""", {EVENTS} SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CAST(CASE WHEN c THEN 10 WHEN s THEN 13 END AS INTEGER) AS reason,
    CAST(CASE WHEN c OR s THEN 0 ELSE CAST(o_totalprice AS DECIMAL(17,2)) END AS DOUBLE) AS value_added, CASE WHEN c OR s THEN 'N' ELSE 'S' END AS appropriation,
    CAST(o_custkey AS DOUBLE) AS exit_reg, CAST(c_nationkey AS INTEGER) AS exit_muni
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN munis ON muni = c_nationkey LEFT JOIN ev ON k = o_orderkey WHERE state = '{R.HOME}' OR o_orderstatus = 'P'"""))
def transport_load(spark, sf):
    h = order_heads(spark, sf)
    key = F.col("o_orderkey").cast("string").alias("access_key")
    parts = {
        "transport_doc": h.select(
            key, F.col("o_orderdate").cast("timestamp").alias("emitted"), F.lit(None).cast("int").alias("state_code"), F.lit("1").alias("environment"),
            F.lit("57").alias("model"), F.col("o_custkey").cast("string").alias("issuer_reg"), F.col("c_nationkey").cast("string").alias("issuer_muni"),
            F.col("state").alias("issuer_state"), F.lit("0").alias("taker_reg"), F.lit(None).cast("string").alias("taker_muni"),
            F.when(F.col("o_orderstatus") == "P", R.HOME.lower()).alias("taker_state"),
        ),
        "transport_value": h.select(key, R.dec("o_totalprice").alias("charged"), R.dec("c_acctbal").alias("received")),
        "transport_event": coded(spark, sf, "110170"),
    }
    docs = transport.run(parts, 1, R.HOME)
    return docs.select("access_key", "reason", "value_added", "appropriation", "exit_reg", "exit_muni")


@query(using("munis", then=f""", {EVENTS} SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CAST(CASE WHEN c THEN 10 WHEN s THEN 13 END AS INTEGER) AS reason,
    CAST(CASE WHEN c OR s THEN 0 ELSE CAST(CASE o_orderstatus WHEN 'O' THEN o_totalprice WHEN 'F' THEN c_acctbal ELSE 7 END AS DECIMAL(17,2)) END AS DOUBLE) AS value_added
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN munis ON muni = c_nationkey LEFT JOIN ev ON k = o_orderkey WHERE state = '{R.HOME}'"""))
def energy_load(spark, sf):
    """Bills with totals from three tables in turn."""
    h = order_heads(spark, sf)
    key = F.col("o_orderkey").cast("string").alias("access_key")
    head = h.select(
        key, F.col("o_orderdate").cast("timestamp").alias("emitted"), F.lit(None).cast("int").alias("state_code"), F.lit("66").alias("model"),
        F.lit("1").alias("environment"), F.col("o_custkey").cast("string").alias("issuer_reg"), F.col("c_nationkey").cast("string").alias("issuer_muni"),
        F.col("state").alias("issuer_state"), F.lit("0").alias("recipient_reg"), F.lit("0").alias("recipient_muni"), F.lit("X").alias("recipient_state"),
    )
    pick = lambda s, v: h.where(F.col("o_orderstatus") == s).select(key, v.cast("decimal(17,2)").alias("total"), v.cast("decimal(17,2)").alias("gross"))
    last = h.select(key, F.lit(7).cast("decimal(17,2)").alias("total"), F.lit(7).cast("decimal(17,2)").alias("gross"))
    totals = [pick("O", F.col("o_totalprice")), pick("F", F.col("c_acctbal")), last]
    return energy.run(head, totals, coded(spark, sf, "110112"), 1, R.HOME).select("access_key", "reason", "value_added")


TICKETS = """ev AS (SELECT event_id // 3 AS k, bool_or(event_type = 'signup') AS c, bool_or(event_type = 'error') AS n FROM events GROUP BY 1),
    det AS (SELECT l_orderkey AS k, SUM(CASE WHEN l_linenumber < 5 THEN CAST(l_quantity AS DECIMAL(17,2)) ELSE 0 END) AS v, bool_or(l_linenumber < 5) AS code FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
    t AS (SELECT o.*, COALESCE(det.v, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(17,2)) ELSE 0 END) AS v,
        COALESCE(det.code, o_orderpriority <> '5-LOW') AS code, CASE WHEN c THEN 10 WHEN n THEN 14 END AS reason FROM orders o LEFT JOIN ev ON ev.k = o_orderkey LEFT JOIN det ON det.k = o_orderkey)"""


def ticket_parts(spark, sf):
    o, line = R.table(spark, sf, "orders"), R.table(spark, sf, "lineitem")
    key = F.col("o_orderkey").cast("string").alias("access_key")
    low = F.col("o_orderpriority") == "5-LOW"
    detail = line.where("l_linestatus = 'O'").select(
        F.col("l_orderkey").cast("string").alias("access_key"), F.col("l_partkey").alias("id"), F.col("l_linenumber").cast("bigint").alias("trip_no"),
        R.dec("l_quantity").alias("listed"), R.dec("l_tax").alias("taxed"), F.when(F.col("l_linenumber") < 5, "5101").otherwise("949").alias("op_code"),
    )
    e = R.table(spark, sf, "events")
    return {
        "ticket_doc": o.select(
            key, F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("emitted"), F.lit(1).alias("muni"), F.lit("X").alias("state"),
            F.when(low, "949").otherwise("5101").alias("op_code"), F.when(low, None).otherwise(R.dec("o_totalprice")).alias("paid"), R.dec("o_totalprice").alias("listed"),
        ),
        "ticket_event": e.select(
            F.floor(F.col("event_id") / 3).cast("string").alias("access_key"), F.when(F.col("event_type") == "signup", "110111").otherwise("0").alias("kind"),
            F.when(F.col("event_type") == "error", "evento de nao embarque").alias("note"),
        ),
        "ticket_detail": detail,
        "ticket_trip": e.select(F.col("event_id").cast("string").alias("access_key"), F.col("user_id").alias("boarded"), F.col("event_type").alias("prefix"), F.lit("1A").alias("seat")),
        "ticket_payment": line.select(F.col("l_orderkey").cast("string").alias("access_key"), R.dec("l_tax").alias("paid")),
        "ticket_component": line.select(F.col("l_orderkey").cast("string").alias("access_key"), R.dec("l_discount").alias("amount")),
    }


@query(f"""WITH {TICKETS} SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CAST(reason AS INTEGER) AS reason, CASE WHEN code AND reason IS NULL THEN 'S' ELSE 'N' END AS appropriation,
    CAST(CASE WHEN code AND reason IS NULL THEN v ELSE 0 END AS DOUBLE) AS value_added, CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total FROM t""")
def ticket_load(spark, sf):
    ref = references.load(spark, reference_catalog(spark, sf))
    docs, _ = ticket.run(ticket_parts(spark, sf), ref, 1)
    return docs.select("access_key", "reason", "appropriation", "value_added", "total")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS access_key, COUNT(*) AS items, CAST(MAX(n) AS INTEGER) AS last_item, CAST(SUM(v) AS DOUBLE) AS value FROM (
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey) AS n,
        CASE WHEN l_orderkey IS NULL THEN CAST(o_totalprice AS DECIMAL(17,2)) ELSE CAST(l_quantity AS DECIMAL(17,2)) END AS v
    FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linestatus = 'O') ON l_orderkey = o_orderkey) GROUP BY 1""")
def ticket_items(spark, sf):
    """Tickets without detail become one item of their own."""
    parts = ticket_parts(spark, sf)
    items = ticket.items_of(ticket.prepare(parts), parts["ticket_detail"])
    return items.groupBy("access_key").agg(
        F.count("*").alias("items"), F.max("item_no").alias("last_item"), F.sum("value").alias("value")
    )


def ledger_parts(spark, sf):
    o, line = R.table(spark, sf, "orders"), R.table(spark, sf, "lineitem")
    doc = [
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("company"), F.col("o_custkey").cast("string").alias("person"),
        F.lit("55").alias("model"), F.lit(" 1").alias("series"), F.col("o_orderkey").cast("string").alias("number"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
    ]
    docs = o.select(*doc, R.dec("o_totalprice").alias("total"))
    gross = R.dec("l_extendedprice")
    items = line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *doc, F.col("l_linenumber").alias("item_no"), gross.alias("gross"), R.part_of(gross, "l_discount").alias("discount"),
        F.col("l_quantity").cast("decimal(17,3)").alias("quantity"), R.part_of(gross, "l_tax").alias("ipi"),
        F.when(F.col("l_linestatus") == "O", "5101").otherwise("1949").alias("op_code"),
    )
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    periods = o.select(month.alias("start"), F.last_day("o_orderdate").alias("stop")).distinct()
    return docs, items, periods


@query("""SELECT o_custkey || '|55|1|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') AS access_key, CAST(COALESCE(v, 0) AS DOUBLE) AS value_added,
    CASE WHEN COALESCE(code, false) THEN 'S' ELSE 'N' END AS appropriation, CAST(CASE WHEN COALESCE(code, false) THEN NULL ELSE 12 END AS INTEGER) AS reason,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period FROM orders LEFT JOIN
    (SELECT l_orderkey, bool_or(l_linestatus = 'O') AS code, SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(17,2))
        - CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(17,2)) ELSE 0 END) AS v FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def ledger_load(spark, sf):
    ref = references.load(spark, reference_catalog(spark, sf))
    docs, _ = ledger.run(*ledger_parts(spark, sf), ref, 1)
    # The unified layout keeps 44 characters of a key, which these fit.
    return docs.select("access_key", "value_added", "appropriation", "reason", "period")


@query(using("docs", then="""SELECT order_key || '-' || supplier_key AS access_key, appropriation, CAST(CASE WHEN parties_out THEN 11 WHEN cancelled THEN 10 END AS INTEGER) AS reason,
    4 AS doc_type FROM docs"""))
def loose_load(spark, sf):
    docs = R.keyed(R.documents(spark, sf).drop("reason", "appropriation", "doc_type"))
    docs = docs.withColumn("note_status", F.when(F.col("cancelled"), "VOID").otherwise("NORMAL"))
    return loose.run(docs, 1).select("access_key", "appropriation", "reason", "doc_type")


@query(using("customers", "munis", then=PHASES + """, r AS (SELECT reg, CASE WHEN valid_to IS NULL THEN 2 ELSE 1 END AS period, CASE WHEN rural THEN 'RURAL' WHEN status <> '1' THEN 'UNREGISTERED'
        WHEN regime = '2' THEN 'NORMAL' ELSE 'SIMPLIFIED' END AS class FROM phases),
    p AS (SELECT l_orderkey, MAX(CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS issuer_reg FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS note_id, p.issuer_reg, x.class AS exit_class, n.class AS entry_class, CASE WHEN o_orderstatus = 'O' THEN 'Entry' ELSE 'Exit' END AS operation_label,
        CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN r x ON x.reg = o_custkey AND x.period = CASE WHEN year(o_orderdate) < 1998 THEN 1 ELSE 2 END
    LEFT JOIN r n ON n.reg = o_orderkey % 1000 AND n.period = CASE WHEN year(o_orderdate) < 1998 THEN 1 ELSE 2 END"""))
def loose_project(spark, sf):
    """Loose invoices with both roles, taxpayer classes and labels."""
    o, line = R.table(spark, sf, "orders"), R.table(spark, sf, "lineitem")
    docs = o.select(
        F.col("o_orderkey").alias("note_id"), F.col("o_custkey").alias("exit_reg"), (F.col("o_orderkey") % 1000).alias("entry_reg"),
        F.when(F.year("o_orderdate") < 1998, 1).otherwise(2).alias("period"), F.col("o_orderdate").alias("emitted_at"),
    )
    notes = o.select(
        F.col("o_orderkey").alias("note_id"), F.when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("note_kind"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("operation"),
    )
    parties = line.where("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("note_id"), F.lit(2).alias("role"), F.col("l_suppkey").alias("reg"), F.lit(0).alias("muni"), F.lit("X").alias("state")
    )
    reg = two_phase_registry(spark, sf).withColumn("period", F.when(F.col("valid_to").isNull(), 2).otherwise(1))
    out = loose.project(docs, notes, parties, reg)
    return out.select("note_id", "issuer_reg", "exit_class", "entry_class", "operation_label", "year", "month")


NEW_CODES = ("1410", "5410", "1949", "5949")
UNIQUE = """, ui AS (SELECT order_key, supplier_key, item_no, MIN(op_code) AS op_code, SUM(value_added) AS value_added, SUM(gross) AS gross,
    MIN(product_code) AS product_code FROM items GROUP BY 1, 2, 3)"""


def stored(spark, sf, *columns):
    """Settled documents with ``columns`` besides value and reason, and their items made unique by line number, each computed once.

    Lines are dealt by document, which serves both the items and the join of their documents.
    """
    lines = cut_lineage(R.net_items(spark, sf).select(*R.DOC, "item_no", "op_code", "value_added", "gross", "product_code"))
    docs = cut_lineage(R.documents(spark, sf, lines).select(*R.DOC, "doc_type", "value_added", "reason", *columns))
    items = lines.repartition(*R.DOC).groupBy(*R.DOC, "item_no").agg(
        F.min("op_code").alias("op_code"), F.sum("value_added").cast("decimal(17,2)").alias("value_added"),
        F.sum("gross").alias("gross"), F.min("product_code").alias("product_code"),
    )
    items = R.keyed(items.join(docs.select(*R.DOC, "doc_type").hint("merge"), R.DOC))
    reason = F.when(~F.col("op_code").isin(*R.COUNTED_CODES), 1)
    return R.keyed(docs), cut_lineage(items.withColumn("reason", reason))


@query(using("docs", then=UNIQUE + f""", n AS (SELECT order_key, supplier_key, SUM(CASE WHEN op_code IN {NEW_CODES} THEN value_added ELSE 0 END) AS v FROM ui GROUP BY 1, 2)
    SELECT order_key || '-' || supplier_key AS access_key, CAST(CASE WHEN reason IN (10, 11) THEN value_added ELSE v END AS DOUBLE) AS value_added,
    CAST(CASE WHEN reason IN (10, 11) THEN reason WHEN v = 0 THEN 12 END AS INTEGER) AS reason FROM docs JOIN n USING (order_key, supplier_key)"""))
def correct_op_code(spark, sf):
    """Documents after other operation codes participate."""
    docs, items = stored(spark, sf)
    out, _ = corrections.op_codes_changed(docs, items, R.codes_frame(spark, NEW_CODES))
    return out.select("access_key", "value_added", "reason")


@query(using("docs", then=UNIQUE + f""" SELECT order_key || '-' || supplier_key AS access_key, item_no, CAST(CASE WHEN reason IN (10, 11) THEN
    CASE WHEN op_code IN ({CODES}) THEN NULL ELSE 1 END WHEN op_code IN {NEW_CODES} THEN NULL ELSE 1 END AS INTEGER) AS reason FROM ui JOIN docs USING (order_key, supplier_key)"""))
def correct_op_code_items(spark, sf):
    docs, items = stored(spark, sf)
    _, out = corrections.op_codes_changed(docs, items, R.codes_frame(spark, NEW_CODES))
    return out.select("access_key", "item_no", "reason")


@query(using("versions", "purchases", then="""SELECT doc_id, entry_id, exit_id, CASE WHEN e_ok AND x_ok THEN 'A' WHEN e_ok THEN 'E' WHEN x_ok THEN 'S' ELSE 'N' END AS appropriation,
    CAST(CASE WHEN e_out AND x_out OR old = 10 THEN 0 WHEN old = 14 THEN total ELSE counted END AS DOUBLE) AS value_added,
    CAST(CASE WHEN e_out AND x_out THEN 11 WHEN old = 10 THEN 10 WHEN old = 14 THEN 14 WHEN counted = 0 THEN 12 END AS INTEGER) AS reason
    FROM (SELECT p.doc_id, p.total, e.event_id AS entry_id, x.event_id AS exit_id,
        CASE WHEN total < 5 THEN 10 WHEN total < 20 THEN 11 WHEN total < 30 THEN 12 WHEN total < 35 THEN 14 END AS old,
        CASE WHEN doc_id % 4 = 0 THEN 0 ELSE total - 1 END AS counted,
        COALESCE(e.status = '1' AND (e.regime = '2' OR e.rural), false) AS e_ok, COALESCE(x.status = '1' AND (x.regime = '2' OR x.rural), false) AS x_ok,
        COALESCE(e.status <> '1' OR e.regime = '4', true) AS e_out, COALESCE(x.status <> '1' OR x.regime = '4', true) AS x_out
        FROM purchases p LEFT JOIN LATERAL (SELECT * FROM versions v WHERE v.reg = p.entry_reg AND v.valid_from <= p.emitted_at AND (v.valid_to IS NULL OR p.emitted_at <= v.valid_to)
            ORDER BY valid_from DESC LIMIT 1) e ON true
        LEFT JOIN LATERAL (SELECT * FROM versions v WHERE v.reg = p.entry_reg + 1 AND v.valid_from <= p.emitted_at AND (v.valid_to IS NULL OR p.emitted_at <= v.valid_to)
            ORDER BY valid_from DESC LIMIT 1) x ON true)"""))
def correct_registry(spark, sf):
    """Stored documents with both registry rows looked up again at emission."""
    t = F.col("total")
    docs = R.purchases(spark, sf).withColumns(
        {
            "exit_reg": F.col("entry_reg") + 1, "exit_state": F.col("entry_state"),
            "reason": F.when(t < 5, 10).when(t < 20, 11).when(t < 30, 12).when(t < 35, 14),
            "value_added": F.when(t < 30, F.lit(0).cast("decimal(17,2)")).otherwise(t),
        }
    )
    items = docs.select("doc_id", F.explode(F.array(
        F.struct(F.when(F.col("doc_id") % 4 == 0, "1999").otherwise("1101").alias("op_code"), (t - 1).cast("decimal(17,2)").alias("value_added")),
        F.struct(F.lit("1999").alias("op_code"), F.lit(1).cast("decimal(17,2)").alias("value_added")),
    )).alias("i")).select("doc_id", "i.*")
    versions = R.versions(spark, sf).withColumnRenamed("event_id", "id")
    out = corrections.registry_changed(docs, items, R.codes_frame(spark), versions, keys=["doc_id"])
    return out.select("doc_id", "entry_id", "exit_id", "appropriation", "value_added", "reason")


ALL_DAYS = ("1992-01-01 00:00:00", "2002-12-31 23:59:59")


@query(ORACLE["goods_load"].replace("10 AS doc_type", "2 AS doc_type") + " WHERE CAST(k AS VARCHAR) NOT LIKE '52%'")
def received_load(spark, sf):
    """Invoices issued elsewhere, through the entry point of the loads."""
    docs, _ = dispatch.prepare(
        spark, "received", goods_catalog(spark, sf), ALL_DAYS, 1, two_phase_registry(spark, sf), home=R.HOME, store=cut_lineage
    )
    return docs.select("access_key", "doc_type", "entry_reg", "exit_reg", "period", "total", "value_added", "appropriation")


@query(ORACLE["goods_load"] + " WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-06-30 23:59:59'")
def goods_committed(spark, sf):
    """Half a year loaded in one commit and two months of it again in another, then read back from the store."""
    tables_ = commits.Tables(spark, f"{shared_folder(spark)}/goods-{uuid.uuid4().hex}", store.PARTITIONS)
    catalog, registry = goods_catalog(spark, sf), two_phase_registry(spark, sf)
    for window in (("1996-01-01 00:00:00", "1996-06-30 23:59:59"), ("1996-02-15 00:00:00", "1996-04-10 23:59:59")):
        dispatch.load_committed(spark, "goods", catalog, window, 1, tables_, registry, R.HOME)
    docs = tables_.read("documents")
    return docs.select("access_key", "doc_type", "entry_reg", "exit_reg", "period", "total", "value_added", "appropriation")


def loose_catalog(spark, sf) -> dict:
    """Notes from orders; the customer issues, one in a thousand receives, and some notes have a third role."""
    h = order_heads(spark, sf)
    to = F.when(F.col("o_orderpriority") == "2-HIGH", R.HOME.lower()).otherwise("X")
    party = lambda role, reg, state: F.struct(F.lit(role).alias("role"), reg.cast("string").alias("reg"), F.lit(None).cast("string").alias("muni"), state.alias("state"))
    return {
        "loose_note": h.select(
            F.col("o_orderkey").cast("string").alias("access_key"), F.col("o_orderkey").alias("note_id"), F.col("o_orderdate").cast("timestamp").alias("emitted"),
            R.dec("o_totalprice").alias("total"), R.dec("o_totalprice").alias("value"), F.when(F.col("o_orderstatus") == "P", "VOID").otherwise("NORMAL").alias("note_status"),
        ),
        "loose_party": h.select(F.col("o_orderkey").alias("note_id"), F.explode(F.array(
            party(2, F.col("o_custkey"), F.col("state")), party(3, F.col("o_orderkey") % 1000, to), party(4, F.col("o_orderkey"), F.lit("X")),
        )).alias("p")).select("note_id", "p.*"),
    }


@query(using("customers", "munis", then=PHASES + f""", n AS (SELECT o_orderkey AS k, o_custkey AS exit_reg, m.state AS exit_state, o_orderkey % 1000 AS entry_reg,
        CASE WHEN o_orderpriority = '2-HIGH' THEN '{R.HOME}' ELSE 'X' END AS entry_state, o_orderdate AS seen, o_orderstatus, CAST(o_totalprice AS DECIMAL(17,2)) AS v
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN munis m ON m.muni = c_nationkey),
    s AS (SELECT n.*, COALESCE(x.status = '1' AND (x.regime = '2' OR x.rural), false) AS x_ok, COALESCE(e.status = '1' AND (e.regime = '2' OR e.rural), false) AS e_ok,
        COALESCE(x.status <> '1' OR x.regime IN ('3', '4', '5'), true) AND COALESCE(e.status <> '1' OR e.regime IN ('3', '4', '5'), true) AS parties_out
        FROM n LEFT JOIN phases x ON x.reg = exit_reg AND x.state = exit_state AND seen BETWEEN x.valid_from AND COALESCE(x.valid_to, seen)
        LEFT JOIN phases e ON e.reg = entry_reg AND e.state = entry_state AND seen BETWEEN e.valid_from AND COALESCE(e.valid_to, seen))
    SELECT CAST(k AS VARCHAR) AS access_key, 4 AS doc_type, CAST(entry_reg AS DOUBLE) AS entry_reg, CAST(exit_reg AS DOUBLE) AS exit_reg, CAST(v AS DOUBLE) AS value_added,
        CASE WHEN x_ok AND e_ok THEN 'A' WHEN e_ok THEN 'E' WHEN x_ok THEN 'S' ELSE 'N' END AS appropriation,
        CAST(CASE WHEN parties_out THEN 11 WHEN o_orderstatus = 'P' THEN 10 END AS INTEGER) AS reason FROM s"""))
def loose_dispatch(spark, sf):
    """Loose invoices from notes and party rows, through the entry point of the loads."""
    docs, _ = dispatch.prepare(spark, "loose", loose_catalog(spark, sf), ALL_DAYS, 1, two_phase_registry(spark, sf), home=R.HOME)
    return docs.select("access_key", "doc_type", "entry_reg", "exit_reg", "value_added", "appropriation", "reason")


def telecom_catalog(spark, sf) -> dict:
    h, line = order_heads(spark, sf), R.table(spark, sf, "lineitem")
    gross = R.dec("l_extendedprice")
    none = F.lit(None).cast("string")
    return reference_catalog(spark, sf) | {
        "telecom_doc": h.select(
            F.col("o_orderkey").cast("string").alias("access_key"), F.col("o_orderdate").cast("timestamp").alias("emitted"), R.dec("o_totalprice").alias("total"),
            F.lit("77").alias("issuer_reg"), none.alias("issuer_muni"), F.lit("x").alias("issuer_state"), F.col("o_custkey").cast("string").alias("recipient_reg"),
            F.col("c_nationkey").cast("string").alias("recipient_muni"), F.col("state").alias("recipient_state"),
        ),
        "telecom_item": line.select(
            F.col("l_orderkey").cast("string").alias("access_key"), F.col("l_linenumber").cast("int").alias("item_no"),
            F.when(F.col("l_linestatus") == "O", "5.101").otherwise("1949").alias("op_code"), F.col("l_tax").cast("decimal(9,4)").alias("rate"), gross.alias("base"),
            R.part_of(gross, "l_tax").alias("exempt"), F.when(F.col("l_returnflag") == "R", "S").otherwise("N").alias("situation"),
        ),
    }


TELECOM = """WITH f AS (SELECT l_orderkey AS k, l_linestatus = 'O' AND l_returnflag <> 'R' AS counted, CASE WHEN l_tax <> 0 THEN CAST(l_extendedprice AS DECIMAL(17,2))
    + CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2)) ELSE 0 END AS v, * FROM lineitem)"""


@query(TELECOM + """, s AS (SELECT k, SUM(CASE WHEN counted THEN v ELSE 0 END) AS v FROM f GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS access_key, 6 AS doc_type, CAST(o_custkey AS DOUBLE) AS entry_reg, CAST(COALESCE(v, 0) AS DOUBLE) AS value_added, 'E' AS appropriation,
        CAST(CASE WHEN COALESCE(v, 0) = 0 THEN 12 END AS INTEGER) AS reason FROM orders LEFT JOIN s ON k = o_orderkey""")
def telecom_load(spark, sf):
    """Telecom documents and items, through the entry point of the loads."""
    docs, _ = dispatch.prepare(spark, "telecom", telecom_catalog(spark, sf), ALL_DAYS, 1)
    return docs.select("access_key", "doc_type", "entry_reg", "value_added", "appropriation", "reason")


@query(TELECOM + """ SELECT CAST(k AS VARCHAR) AS access_key, CAST(l_linenumber AS INTEGER) AS item_no, CAST(v AS DOUBLE) AS value_added,
    CAST(CASE WHEN l_returnflag = 'R' THEN 10 WHEN l_linestatus <> 'O' THEN 1 END AS INTEGER) AS reason FROM f WHERE k IN (SELECT o_orderkey FROM orders)""")
def telecom_load_items(spark, sf):
    _, items = dispatch.prepare(spark, "telecom", telecom_catalog(spark, sf), ALL_DAYS, 1)
    return items.select("access_key", "item_no", "value_added", "reason")


def registry_parts(spark, sf):
    """(documents before any look-up, their items, registry before, registry now): each fifth version is new."""
    t = F.col("total")
    docs = R.purchases(spark, sf).withColumns({
        "exit_reg": F.col("entry_reg") + 1, "exit_state": F.col("entry_state"), "reason": F.lit(None).cast("int"),
        "value_added": t.cast("decimal(17,2)"),
    })
    items = docs.select("doc_id", F.explode(F.array(
        F.struct(F.when(F.col("doc_id") % 4 == 0, "1999").otherwise("1101").alias("op_code"), (t - 1).cast("decimal(17,2)").alias("value_added")),
        F.struct(F.lit("1999").alias("op_code"), F.lit(1).cast("decimal(17,2)").alias("value_added")),
    )).alias("i")).select("doc_id", "i.*")
    versions = R.versions(spark, sf).withColumnRenamed("event_id", "id")
    return docs, items, versions.where("id % 5 <> 0"), versions


def registry_reworked(spark, sf):
    docs, items, before, now = registry_parts(spark, sf)
    codes = R.codes_frame(spark)
    held = cut_lineage(corrections.registry_changed(docs, items, codes, before, keys=["doc_id"]))
    return held, *corrections.registry_reworked(held, items, codes, before, now, keys=["doc_id"])


@query(ORACLE["correct_registry"].replace(
    "CASE WHEN total < 5 THEN 10 WHEN total < 20 THEN 11 WHEN total < 30 THEN 12 WHEN total < 35 THEN 14 END AS old", "CAST(NULL AS INTEGER) AS old"
))
def correct_registry_changes(spark, sf):
    """Stored documents after new versions came: only those in whose span of a party something changed are taken again."""
    _, out, _ = registry_reworked(spark, sf)
    return out.select("doc_id", "entry_id", "exit_id", "appropriation", "value_added", "reason")


def settled_before(spark, sf):
    """Documents and items as the former list of codes settled them, with the columns that a new list takes."""
    docs, items = stored(spark, sf)
    items = items.select(*corrections.DOC, "item_no", "op_code", "value_added", "reason")
    return tuple(cut_lineage(f) for f in corrections.op_codes_changed(docs, items, R.codes_frame(spark)))


MOVED_CODES = (*[c for c in R.COUNTED_CODES if c != "1101"], "1410")


@query(using("docs", then=UNIQUE + f""", n AS (SELECT order_key, supplier_key, SUM(CASE WHEN op_code IN {MOVED_CODES} THEN value_added ELSE 0 END) AS v FROM ui GROUP BY 1, 2)
    SELECT order_key || '-' || supplier_key AS access_key, CAST(CASE WHEN reason IN (10, 11) THEN value_added ELSE v END AS DOUBLE) AS value_added,
    CAST(CASE WHEN reason IN (10, 11) THEN reason WHEN v = 0 THEN 12 END AS INTEGER) AS reason FROM docs JOIN n USING (order_key, supplier_key)"""))
def correct_op_code_changes(spark, sf):
    """One code came and one went: documents with neither are not touched."""
    docs, items = settled_before(spark, sf)
    out, _, _ = corrections.op_codes_reworked(docs, items, R.codes_frame(spark), R.codes_frame(spark, MOVED_CODES))
    return out.select("access_key", "value_added", "reason")


OPPOSITE = UNIQUE + """, mirror AS (SELECT * FROM (VALUES ('5101', '1101'), ('5102', '1102'), ('5116', '1116'), ('5201', '1201'), ('5410', '1410')) t(x, e)),
    both_ways AS (SELECT x AS code, e AS other FROM mirror UNION ALL SELECT e, x FROM mirror),
    ti AS (SELECT u.*, d.value_added AS doc_value, s_nationkey AS exit_reg, c_nationkey AS entry_reg, substr(product_code || '000000', 7, 2) AS product FROM ui u
        JOIN docs d USING (order_key, supplier_key) JOIN orders ON order_key = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON supplier_key = s_suppkey
        WHERE d.reason IS NULL AND s_nationkey <> c_nationkey AND op_code IN (SELECT code FROM both_ways) AND op_code IN (""" + CODES + """)),
    tot AS (SELECT entry_reg, exit_reg, op_code, product, SUM(gross) AS gross FROM ti GROUP BY 1, 2, 3, 4),
    opp AS (SELECT a.* FROM tot a JOIN both_ways m ON m.code = a.op_code JOIN tot b ON b.entry_reg = a.exit_reg AND b.exit_reg = a.entry_reg
        AND b.op_code = m.other AND b.product = a.product WHERE a.gross < b.gross),
    ch AS (SELECT order_key, supplier_key, SUM(ti.gross) AS before, SUM(CASE WHEN opp.op_code IS NULL THEN ti.gross ELSE 0 END) AS v
        FROM ti LEFT JOIN opp ON opp.entry_reg = ti.entry_reg AND opp.exit_reg = ti.exit_reg AND opp.op_code = ti.op_code AND opp.product = ti.product GROUP BY 1, 2)
    SELECT order_key || '-' || supplier_key AS access_key, CAST(CASE WHEN ch.before <> ch.v THEN ch.v ELSE d.value_added END AS DOUBLE) AS value_added,
        CAST(CASE WHEN ch.before <> ch.v THEN CASE WHEN ch.v = 0 THEN 12 END ELSE d.reason END AS INTEGER) AS reason FROM docs d LEFT JOIN ch USING (order_key, supplier_key)"""


@query(using("docs", then=OPPOSITE))
def duplicate_operations(spark, sf):
    """Documents after operations between two municipalities that undo each other are excluded.

    At this size every pair of municipalities trades both ways, so the pair search drops only trade inside one.
    """
    docs, items = stored(spark, sf, "entry_muni", "exit_muni")
    docs = docs.withColumns(
        {"entry_reg": F.col("entry_muni"), "exit_reg": F.col("exit_muni"), "entry_state": F.lit("X"), "exit_state": F.lit("X")}
    )
    digits = F.rpad(F.regexp_replace("product_code", r"\D", ""), 8, "0")
    items = items.withColumn("product_code", F.concat(F.substring(digits, 1, 2), F.lit("000000")))
    out, _ = corrections.duplicate_operations(docs, items)
    return out.select("access_key", "value_added", "reason")


@query(using("docs", "registry", then="""SELECT order_key || '-' || supplier_key AS access_key, item_no, part_key, CAST(i.value_added AS DOUBLE) AS item_value, strftime(emitted_at, '%d/%m/%Y %H:%M:%S') AS issued,
    CASE appropriation WHEN 'E' THEN 'Entry' WHEN 'S' THEN 'Exit' WHEN 'A' THEN 'Entry and exit' ELSE 'None' END AS appropriation_label,
    CASE WHEN entry_rural THEN 'RURAL' WHEN entry_status <> '1' THEN 'UNREGISTERED' WHEN entry_regime = '2' THEN 'NORMAL' ELSE 'SIMPLIFIED' END AS entry_class,
    CASE WHEN exit_rural THEN 'RURAL' WHEN exit_status <> '1' THEN 'UNREGISTERED' WHEN exit_regime = '2' THEN 'NORMAL' ELSE 'SIMPLIFIED' END AS exit_class
    FROM docs JOIN items i USING (order_key, supplier_key) WHERE reason IS NULL AND doc_type = 10 AND period BETWEEN 199601 AND 199612"""))
def report_participating(spark, sf):
    docs = R.keyed(R.documents(spark, sf))
    items = R.keyed(R.net_items(spark, sf)).join(docs.select("access_key", "doc_type"), "access_key")
    items = items.withColumn("product_code", F.col("part_key"))
    out = reports.participating(docs, items, R.registry(spark, sf), reports.scope(10, (199601, 199612)))
    return out.select(
        "access_key", "item_no", F.col("product_code").alias("part_key"), "item_value", "issued", "appropriation_label", "entry_class", "exit_class"
    )


@query(using("docs", then=UNIQUE + f""" SELECT order_key || '-' || supplier_key AS access_key, item_no, 1 AS reason, 'operation code not participating' AS reason_text, period
    FROM ui JOIN docs USING (order_key, supplier_key) WHERE op_code NOT IN ({CODES}) AND period BETWEEN 199701 AND 199706"""))
def report_excluded_items(spark, sf):
    docs, items = stored(spark, sf, "period", "entry_reg", "exit_reg")
    out = reports.excluded_items(docs, items, reports.scope(periods=(199701, 199706)))
    return out.select("access_key", "item_no", "reason", "reason_text", "period")


@query(using("docs", then="""SELECT order_key || '-' || supplier_key AS access_key, CAST(reason AS INTEGER) AS reason FROM docs WHERE entry_reg = 7 OR exit_reg = 1000000007"""))
def listing_by_registration(spark, sf):
    """Documents of one registration on either side."""
    docs = R.keyed(R.documents(spark, sf))
    within = reports.scope(reg=7) | reports.scope(reg=R.SUPPLIER_BASE + 7)
    return reports.listing(docs, within, ["access_key"]).select("access_key", "reason")


def listed(spark, sf, within):
    return reports.listing(R.keyed(R.documents(spark, sf)), within, ["access_key"]).select("access_key", "reason")


LISTED = "SELECT order_key || '-' || supplier_key AS access_key, CAST(reason AS INTEGER) AS reason FROM docs WHERE "


@query(using("docs", then=LISTED + "order_key % 1000 = 7 AND supplier_key = (SELECT MIN(l_suppkey) FROM lineitem WHERE l_orderkey = 7) AND order_key = 7"))
def listing_by_key(spark, sf):
    """One document by its access key."""
    first = R.table(spark, sf, "lineitem").where("l_orderkey = 7").agg(F.min("l_suppkey").alias("s")).first()["s"]
    return listed(spark, sf, reports.scope(access_key=f"7-{first}"))


@query(using("docs", then=LISTED + "period BETWEEN 199702 AND 199704"))
def listing_by_period(spark, sf):
    return listed(spark, sf, reports.scope(periods=(199702, 199704)))


@query(using("docs", then=LISTED + "doc_type = 2 AND period BETWEEN 199801 AND 199803"))
def listing_by_type(spark, sf):
    return listed(spark, sf, reports.scope(doc_type=2, periods=(199801, 199803)))


@query(using("customers", "munis", "docs", then=PHASES + f""", v AS (SELECT order_key, supplier_key, SUM(value_added) AS value_added FROM items WHERE op_code IN ('5101', '5102', '5116') GROUP BY 1, 2)
    SELECT order_key || '-' || supplier_key AS access_key, d.period, CAST(COALESCE(p.muni, 0) AS INTEGER) AS known_muni, CAST(COALESCE(p.reg, 0) AS BIGINT) AS known_reg,
        d.entry_reg + 1 AS option_reg, CAST(v.value_added AS DOUBLE) AS value_added
    FROM docs d JOIN v USING (order_key, supplier_key) JOIN customer c ON c_custkey = d.entry_id
    LEFT JOIN phases p ON p.reg = d.entry_reg AND p.state = '{R.HOME}' AND d.emitted_at BETWEEN p.valid_from AND COALESCE(p.valid_to, d.emitted_at)
    WHERE d.period BETWEEN 199601 AND 200012 AND d.doc_type = 10 AND (d.reason IS NULL OR d.reason <> 10) AND c_acctbal > 2000 AND d.emitted_at >= DATE '1996-06-01'
    AND (c_acctbal > 6000 OR d.emitted_at <= DATE '1997-06-01') AND COALESCE(CAST(p.regime AS INTEGER), 3) >= 3 AND (p.muni = 7 OR d.entry_muni = 12)"""))
def regime_study(spark, sf):
    """Item value of simplified-regime customers of one municipality."""
    docs = R.documents(spark, sf)
    docs = R.keyed(docs).withColumns(
        {
            "direction": F.lit(1), "tax_no": F.concat(F.lpad(F.col("entry_reg").cast("string"), 8, "0"), F.lit("000155")),
            "party_reg": F.col("entry_reg"), "federal_code": F.col("entry_muni"),
        }
    )
    c = R.table(spark, sf, "customer").where("c_acctbal > 2000")
    options = c.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("base"), (F.col("c_custkey") + 1).alias("reg"), F.lit(True).alias("valid"),
        F.lit("1996-06-01").cast("timestamp_ntz").alias("start"),
        F.when(F.col("c_acctbal") <= 6000, F.lit("1997-06-01").cast("timestamp_ntz")).alias("stop"),
    )
    # The study municipality is 7; nation 12 stands for it in the documents' own code.
    munis = R.munis(spark, sf).select(F.col("muni").alias("federal_code"), F.when(F.col("muni") == 12, 7).otherwise(-1).alias("muni"))
    items = R.keyed(R.net_items(spark, sf)).join(docs.select("access_key", "doc_type"), "access_key").withColumn("reason", F.lit(None).cast("int"))
    registry = two_phase_registry(spark, sf).withColumn("state", F.when(F.col("state") == R.HOME, "GO").otherwise(F.col("state")))
    out = reports.regime_study(docs, items, options, registry, munis, "exit", (5101, 5102, 5116), (199601, 200012), 7)
    return out.select("access_key", "period", "known_muni", "known_reg", "option_reg", "value_added")
