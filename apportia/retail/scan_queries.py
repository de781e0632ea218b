"""Scans, predicates and extracts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from apportia import constants as K
from apportia import schemas
from apportia.functions import codes, dates, rules
from apportia.operators import joins, rollups
from apportia.retail import frames as R
from apportia.retail.registry import ORACLE, query
from apportia.retail.sql import text, using
from apportia.session import shared_folder
from apportia.sources import extracts, ranges, tables

WINDOW = ("1997-01-01 00:00:00", "1997-12-31 23:59:59")


@query(f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, {text('l_shipdate')} AS l_shipdate FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""")
def scan_window(spark, sf):
    """Windowed scan; the unknown column is left out of the projection."""
    return tables.read_table(
        spark, {"item": f"{sf}/lineitem.parquet"}, "item", dates.between("l_shipdate", *WINDOW),
        ["l_orderkey", "L_LINENUMBER", "l_suppkey", "l_quantity", "l_shipdate", "l_unknown"],
    )


@query(f"""SELECT l_orderkey, l_linenumber, l_suppkey, {text('l_shipdate')} AS l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '{WINDOW[0]}' AND l_shipdate <= TIMESTAMP '{WINDOW[1]}' AND l_suppkey IN (1, 2, 3, 5, 8)""")
def ranged_window(spark, sf):
    """The window of an extract that is kept as files, read in ranges of its day by several tasks."""
    path = f"{shared_folder(spark)}/extract-{uuid.uuid4().hex}"
    items = R.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"))
    items.repartitionByRange("l_shipdate").sortWithinPartitions("l_shipdate").write.parquet(path)
    read = ranges.read_ranges(spark, "l_shipdate", "1992-01-01", "1999-01-01", 16, path=path)
    return read.where(
        F.col("l_shipdate").between(*(F.lit(w).cast("timestamp_ntz") for w in WINDOW)) & F.col("l_suppkey").isin(1, 2, 3, 5, 8)
    )


@query(f"""SELECT o_orderkey, {text('o_orderdate')} AS o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1996-02-10' AND o_orderdate < DATE '1996-03-02'""")
def day_closed_window(spark, sf):
    o = R.table(spark, sf, "orders").where(dates.between_days("o_orderdate", "1996-02-10", "1996-03-01"))
    return o.select("o_orderkey", "o_orderdate")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total,
    CAST(NULL AS DOUBLE) AS freight, o_orderstatus AS state FROM orders""")
def section_columns(spark, sf):
    """Section columns under other names, typed; a missing one is null."""
    raw = R.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("CHAVENFE"), F.col("o_totalprice").alias("vNF"), F.col("o_orderstatus").alias("uf")
    )
    catalog = {"goods_total": raw.drop("uf"), "goods_issuer": raw}
    total = tables.read_section(spark, catalog, "goods_total", WINDOW).select("access_key", "total", "freight")
    issuer = tables.read_section(spark, catalog, "goods_issuer").select("access_key", "state")
    return joins.fan_in(total, [issuer], ["access_key"])


@query(f"""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""")
def mixed_time_window(spark, sf):
    """Times stored as epoch seconds or as 14 digits in one column."""
    at = F.col("o_orderdate").cast("timestamp")
    stamp = F.when(F.col("o_orderstatus") == "O", F.unix_timestamp(at)).otherwise(
        F.date_format(at, "yyyyMMddHHmmss").cast("bigint")
    )
    o = R.table(spark, sf, "orders").withColumn("emitted", stamp)
    return o.where(dates.between_mixed("emitted", *WINDOW)).select("o_orderkey", "o_orderstatus")


@query(f"""SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '{WINDOW[0]}' AND o_orderdate <= TIMESTAMP '{WINDOW[1]}'""")
def epoch_window(spark, sf):
    o = R.table(spark, sf, "orders").withColumn("emitted", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    o = o.where(dates.between_epoch("emitted", *WINDOW)).withColumn("at", dates.from_epoch("emitted"))
    return o.select("o_orderkey", dates.period("at").alias("period"), F.to_date("at").alias("day"))


@query(using("versions", then=f"""SELECT event_id, reg, {text('valid_from')} AS valid_from FROM versions
    WHERE valid_from <= TIMESTAMP '2024-01-20 00:00:00' AND valid_to >= TIMESTAMP '2024-01-10 00:00:00'"""))
def interval_overlap(spark, sf):
    v = R.versions(spark, sf).where(dates.overlaps("valid_from", "valid_to", "2024-01-10 00:00:00", "2024-01-20 00:00:00"))
    return v.select("event_id", "reg", "valid_from")


@query(using("versions", then="""SELECT event_id, reg, muni FROM versions WHERE valid_from <= TIMESTAMP '2024-01-10 00:00:00'
    AND (valid_to IS NULL OR valid_to >= TIMESTAMP '2024-01-10 23:59:59') AND regime = '2'"""))
def valid_references(spark, sf):
    return tables.valid_references(
        R.versions(spark, sf), "valid_from", "valid_to", "2024-01-10 00:00:00", "2024-01-10 23:59:59", regime="2"
    ).select("event_id", "reg", "muni")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def key_lookup(spark, sf):
    keys = R.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_matching(R.table(spark, sf, "customer"), keys, ["c_custkey"]).select("c_custkey", "c_name")


@query(f"""SELECT CAST(d AS VARCHAR) AS day, {text("CAST(d AS TIMESTAMP) + i * INTERVAL 6 HOUR")} AS first,
    {text("CAST(d AS TIMESTAMP) + (i + 1) * INTERVAL 6 HOUR - INTERVAL 1 SECOND")} AS last
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), range(4) t(i)""")
def calendar_slices(spark, sf):
    """Four slices of each day that has events."""
    days = R.table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    return tables.day_slices(days, "day", 4)


@query(using("heads", then=f"""SELECT reg, state, CAST(MIN(muni) AS INTEGER) AS muni FROM (
    SELECT entry_reg AS reg, CASE WHEN entry_muni < 10 THEN 'NEAR' ELSE '{R.HOME}' END AS state, entry_muni AS muni FROM heads
    UNION ALL SELECT exit_reg, '{R.HOME}', exit_muni FROM heads) WHERE reg <> 0 GROUP BY 1, 2"""))
def registrations_seen(spark, sf):
    from apportia.plans import invoices

    rolled = invoices.roll_items(R.net_items(spark, sf), R.codes_frame(spark), R.DOC)
    docs = R.with_headers(spark, sf, rolled).withColumns(
        {"entry_state": F.when(F.col("entry_muni") < 10, "NEAR"), "exit_state": F.lit(None).cast("string")}
    )
    return rollups.parties_seen(
        docs, ("entry_reg", "entry_muni", "entry_state"), ("exit_reg", "exit_muni", "exit_state"), R.HOME
    )


@query("""SELECT o_custkey AS reg, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS known
    FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3 AND o_custkey > 0 GROUP BY 1""")
def registrations_of_month(spark, sf):
    docs = R.table(spark, sf, "orders").withColumn("period", dates.period("o_orderdate"))
    known = R.table(spark, sf, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("reg"))
    return extracts.registrations_of_month(docs, "o_custkey", 199703, known)


def ledger_files(spark, sf):
    """Events as ledger files: ISO week as period, errors were not processed."""
    return R.table(spark, sf, "events").select(
        F.col("event_id").alias("file_id"), F.col("user_id").alias("reg"), F.weekofyear("ts").alias("period"),
        F.col("ts").alias("delivered"), F.when(F.col("event_type") == "error", "N").otherwise("S").alias("status"),
        F.when(F.col("event_type") == "view", "X").otherwise("E").alias("model"),
    )


FILES = """files AS (SELECT event_id AS file_id, user_id AS reg, CAST(week(ts) AS INTEGER) AS period, ts AS delivered FROM events
    WHERE event_type NOT IN ('error', 'view') AND ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00' AND week(ts) BETWEEN 1 AND 4),
    latest AS (SELECT * FROM files f WHERE delivered = (SELECT MAX(delivered) FROM files g WHERE g.reg = f.reg AND g.period = f.period))"""


@query(f"WITH {FILES} SELECT file_id, reg, period FROM latest")
def latest_delivery(spark, sf):
    found = extracts.latest_ledger_files(ledger_files(spark, sf), "2024-01-02 00:00:00", "2024-01-25 00:00:00", (1, 4))
    return found.select("file_id", "reg", "period")


@query(f"""WITH {FILES} SELECT l.file_id, o_orderkey AS note_id, l_linenumber AS item_no, l_partkey AS part,
    CAST(CAST(l_extendedprice AS DECIMAL(17,2)) - CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(17,2))
        - CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2)) AS DOUBLE) AS value_added,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS BIGINT) AS exit_reg,
    CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE 'GO' END AS exit_state, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period
    FROM latest l JOIN orders ON o_custkey = l.reg JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def ledger_items(spark, sf):
    """Entry notes of the latest files: a customer's urgent orders are the notes of its files."""
    files = extracts.latest_ledger_files(ledger_files(spark, sf), "2024-01-02 00:00:00", "2024-01-25 00:00:00", (1, 4))
    o = R.table(spark, sf, "orders")
    urgent = F.col("o_orderpriority")
    notes = files.select("file_id", "reg").join(o, F.col("reg") == F.col("o_custkey")).select(
        "file_id", F.col("o_orderkey").alias("note_id"), F.col("o_orderkey").alias("access_key"), F.col("o_orderdate").alias("emitted"),
        F.when(urgent.isin("1-URGENT", "2-HIGH"), 0).otherwise(1).alias("direction"), F.lit(6).alias("situation"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("decimal(15,0)")).alias("party_reg"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")).otherwise("none").alias("outside_reg"),
        F.when(F.col("o_orderstatus") == "O", "X").alias("outside_state"),
    )
    line = R.table(spark, sf, "lineitem")
    gross = R.dec("l_extendedprice")
    items = line.select(
        F.col("l_orderkey").alias("note_id"), F.col("l_linenumber").alias("item_no"), F.col("l_partkey").alias("part"),
        gross.alias("gross"), R.part_of(gross, "l_discount").alias("discount"), R.part_of(gross, "l_tax").alias("ipi"),
    )
    return extracts.ledger_notes(files, notes, items).select(
        "file_id", "note_id", "item_no", "part", "value_added", F.col("exit_reg").cast("bigint").alias("exit_reg"), "exit_state", "period"
    )


INVOICES = """h AS (SELECT o_orderkey AS id, o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_entry, o_custkey, c_nationkey, o_orderdate,
        o_orderstatus = 'P' AS cancelled FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59' AND o_orderpriority <> '5-LOW')"""


def invoice_parts(spark, sf):
    """Order headers with the customer as issuer and the order's own number as recipient."""
    o, c = R.table(spark, sf, "orders"), R.table(spark, sf, "customer")
    entry = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    headers = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.when(entry, 0).otherwise(1).alias("direction"),
        F.col("o_custkey").alias("issuer_reg"), F.col("c_nationkey").alias("issuer_muni"), F.lit("OWN").alias("issuer_state"),
        F.col("o_orderkey").alias("recipient_reg"), F.lit(-1).alias("recipient_muni"), F.lit("OTHER").alias("recipient_state"),
        F.when(F.col("o_orderpriority") == "5-LOW", "65").otherwise("55").alias("model"), F.lit(K.AUTHORISED).alias("result"),
        F.col("o_orderdate").alias("emitted"), F.when(F.col("o_orderstatus") == "P", 7).alias("cancel_protocol"),
    )
    line = R.table(spark, sf, "lineitem")
    gross = R.dec("l_extendedprice")
    none = F.lit(None).cast("decimal(17,2)")
    items = line.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("item_id"), F.col("l_partkey").alias("part"),
        (F.col("l_linenumber") * 10 + 2).cast("string").alias("fuel_code"), gross.alias("gross"),
        R.part_of(gross, "l_discount").alias("discount"), none.alias("waiver"), R.part_of(gross, "l_tax").alias("substituted_tax"),
        F.lit(None).cast("decimal(17,2)").alias("freight"), none.alias("insurance"), R.dec("l_quantity").alias("other"),
        none.alias("ipi"), none.alias("import_tax"),
    )
    return headers, items


@query(f"""WITH {INVOICES} SELECT h.id, l_linenumber AS item_id, l_partkey AS part, CASE WHEN is_entry THEN o_custkey ELSE h.id END AS entry_reg,
    CAST(CASE WHEN is_entry THEN c_nationkey ELSE -1 END AS INTEGER) AS entry_muni, CASE WHEN is_entry THEN 'OTHER' ELSE 'OWN' END AS exit_state,
    CASE WHEN is_entry THEN 'E' ELSE 'S' END AS direction_code, cancelled,
    CAST(CAST(l_extendedprice AS DECIMAL(17,2)) - CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(17,2))
     + CAST(l_quantity AS DECIMAL(17,2)) + CASE WHEN l_linenumber IN (3, 4) THEN
        CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2)) ELSE 0 END AS DOUBLE) AS value_added
    FROM h JOIN lineitem ON l_orderkey = h.id""")
def invoice_extract(spark, sf):
    """Headers and items with roles swapped by direction and fuel tax in the value."""
    headers, items = invoice_parts(spark, sf)
    out = extracts.invoices(headers, items, "55", *WINDOW)
    return out.select("id", "item_id", "part", "entry_reg", "entry_muni", "exit_state", "direction_code", "cancelled", "value_added")


@query("""SELECT COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(17,2)) + CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2))) AS DOUBLE) AS value,
    l_linestatus AS version, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_tax <> 0 GROUP BY 3, 4""")
def telecom_extract(spark, sf):
    """Documents and items on their composite key, recipients on a six-column one."""
    o, c, line = (R.table(spark, sf, n) for n in ("orders", "customer", "lineitem"))
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("bigint")
    head = o.select(
        F.col("o_custkey").alias("issuer_company"), day.alias("day"), F.col("o_orderpriority").alias("series"),
        F.col("o_orderkey").alias("number"), F.explode(F.array(F.lit("O"), F.lit("F"))).alias("version"),
    )
    gross = R.dec("l_extendedprice")
    # Orders meet their customer before their lines do: the lines, the larger side, are dealt out once for both.
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(line, F.col("l_orderkey") == F.col("o_orderkey"))
    items = joined.select(
        F.col("o_custkey").alias("issuer_company"), day.alias("day"), F.col("o_orderpriority").alias("series"),
        F.col("o_orderkey").alias("number"), F.col("l_linestatus").alias("version"),
        F.col("c_custkey").alias("recipient_company"), F.col("c_custkey").alias("recipient_reg"), F.col("c_nationkey").alias("recipient_code"),
        F.col("c_mktsegment").alias("account"), F.col("c_name").alias("recipient_name"), F.lit("X").alias("recipient_state"),
        F.col("l_tax").alias("rate"), gross.alias("base"), R.part_of(gross, "l_tax").alias("exempt"),
    )
    people = c.select(
        F.col("c_custkey").alias("recipient_company"), F.col("c_custkey").alias("recipient_reg"), F.col("c_nationkey").alias("recipient_code"),
        F.col("c_mktsegment").alias("account"), F.col("c_name").alias("recipient_name"), F.lit("X").alias("recipient_state"),
    )
    out = extracts.telecom(head, items, people, 19950101, 20011231).where(F.col("rate") != 0)
    return out.groupBy("version", "period").agg(F.count("*").alias("n"), F.sum("value_added").alias("value"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'E' ELSE 'S' END AS direction_code,
    CAST(CASE WHEN o_orderstatus = 'O' THEN c.c_nationkey ELSE o_orderkey % 25 END AS INTEGER) AS entry_muni,
    CASE WHEN o_orderstatus = 'O' THEN r.r_name ELSE r2.r_name END AS entry_state,
    CAST(CASE WHEN o_orderstatus = 'O' THEN (CASE WHEN c.c_acctbal < 0 THEN NULLIF(c.c_custkey, 0) ELSE c.c_custkey + 500 END)
        ELSE CASE WHEN c2.c_acctbal < 0 THEN NULLIF(c2.c_custkey, 0) ELSE c2.c_custkey + 500 END END AS BIGINT) AS entry_reg
    FROM orders JOIN customer c ON o_custkey = c.c_custkey LEFT JOIN customer c2 ON c2.c_custkey = o_orderkey % 2000 JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
    JOIN nation n2 ON n2.n_nationkey = o_orderkey % 25 JOIN region r2 ON r2.r_regionkey = n2.n_regionkey""")
def loose_extract(spark, sf):
    """Star join with both roles; the sentinel party takes the registration it stated."""
    o, c = R.table(spark, sf, "orders"), R.table(spark, sf, "customer")
    facts = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", 3).otherwise(1).alias("operation"),
        F.col("o_custkey").alias("sender_party"), (F.col("o_orderkey") % 2000).alias("receiver_party"),
        F.col("c_nationkey").alias("sender_muni"), (F.col("o_orderkey") % 25).cast("int").alias("receiver_muni"),
        F.to_date("o_orderdate").alias("day_id"),
    )
    parties = c.select(
        F.col("c_custkey").alias("party_id"), F.when(F.col("c_acctbal") < 0, K.NO_CODE).otherwise(1).alias("contributor"),
        F.col("c_custkey").alias("informed_reg"), (F.col("c_custkey") + 500).alias("known_reg"),
    )
    days = o.select(F.to_date("o_orderdate").alias("day_id")).distinct().withColumn("period", dates.period("day_id"))
    out = extracts.loose_star(facts, parties, R.munis(spark, sf), days)
    return out.select("id", "direction_code", "entry_muni", "entry_state", "entry_reg")


@query(f"""SELECT o_orderkey AS access_key, l_linenumber AS item_no, l_partkey AS part, {text('cancelled_at')} AS cancelled_at
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN
    (SELECT user_id, MAX(ts) AS cancelled_at FROM events WHERE event_type = 'error' GROUP BY 1) e ON e.user_id = o_orderkey""")
def energy_extract(spark, sf):
    bills = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("access_key"))
    items = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("access_key"), F.col("l_linenumber").alias("item_no"), F.col("l_partkey").alias("part")
    )
    events = R.table(spark, sf, "events").select(
        F.col("user_id").alias("access_key"), F.when(F.col("event_type") == "error", "110111").alias("kind"), F.col("ts").alias("at")
    )
    return extracts.energy(bills, items, events)


@query("""SELECT o_orderkey AS access_key, CAST(CASE WHEN o_orderkey IN (SELECT user_id FROM events WHERE event_type IN ('error', 'view'))
    THEN 10 END AS INTEGER) AS reason, 'S' AS appropriation FROM orders""")
def ticket_extract(spark, sf):
    docs = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("access_key"))
    kind = F.when(F.col("event_type") == "error", "110111").when(F.col("event_type") == "view", "240140").otherwise("1")
    events = R.table(spark, sf, "events").select(F.col("user_id").alias("access_key"), kind.alias("kind"))
    return extracts.tickets(docs, events)


OPTIONS = """raw AS (SELECT user_id, event_id, event_type, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS d, value FROM events WHERE event_type IN ('signup', 'click')),
    opt AS (SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS base, CAST(COALESCE(c_custkey, 0) AS BIGINT) AS reg,
        CASE WHEN event_type = 'signup' THEN 1 ELSE 2 END AS register, event_id AS option_no,
        strptime(CAST(d AS VARCHAR), '%Y%m%d')::DATE AS start, CASE WHEN value > 10 THEN strptime(CAST(d AS VARCHAR), '%Y%m%d')::DATE END AS stop,
        value > 10 AS valid FROM raw LEFT JOIN customer ON c_custkey = user_id AND c_acctbal >= 0 WHERE d >= 20240105 AND d < 20240125)"""


def option_sources(spark, sf):
    """Sign-ups and clicks as the two registers; low values stay open and are not valid."""
    e = R.table(spark, sf, "events")
    day = F.date_format("ts", "yyyyMMdd").cast("bigint")
    rows = lambda kind: e.where(F.col("event_type") == kind).select(
        day.alias("start"), F.when(F.col("value") > 10, day).otherwise(0).alias("stop"), F.col("user_id").alias("base"),
        day.alias("updated"), F.col("event_id").alias("option_no"), (F.col("value") <= 10).alias("open_type"),
    )
    regs = R.table(spark, sf, "customer").where("c_acctbal >= 0").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("base"), F.col("c_custkey").alias("reg")
    )
    return rows("signup"), rows("click"), regs


@query(f"""WITH {OPTIONS} SELECT base, reg, register, option_no, CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS stop, valid FROM opt""")
def option_periods(spark, sf):
    return extracts.option_periods(*option_sources(spark, sf), 20240105, 20240125).drop("updated")


@query(using("docs", then="""SELECT order_key, supplier_key, doc_type, period FROM docs WHERE doc_type = 10
    AND emitted_at BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59'
    AND order_key IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH')"""))
def stored_documents(spark, sf):
    keys = R.table(spark, sf, "orders").where("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("order_key"))
    found = extracts.stored_documents(R.documents(spark, sf), 10, WINDOW, keys, "order_key")
    return found.select(*R.DOC, "doc_type", "period")


@query(using("munis", then=f"""SELECT o_orderkey, CASE WHEN x.state = '{R.HOME}' THEN 'ISSUER' ELSE 'RECIPIENT' END AS home_side
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN munis e ON e.muni = c_nationkey JOIN munis x ON x.muni = o_orderkey % 25
    WHERE x.state = '{R.HOME}' OR e.state = '{R.HOME}'"""))
def side_in_state(spark, sf):
    o, c = R.table(spark, sf, "orders"), R.table(spark, sf, "customer")
    docs = o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("x", F.col("o_orderkey") % 25)
    for code, name in (("c_nationkey", "entry_state"), ("x", "exit_state")):
        docs = joins.municipality(docs, R.munis(spark, sf), code, name)
    side = rules.home_side("exit_state", "entry_state", F.lit(None).cast("string"), R.HOME)
    return docs.select("o_orderkey", side.alias("home_side")).where(F.col("home_side").isNotNull())


@query("""SELECT r_name AS name, COUNT(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1 ORDER BY 1""")
def ordered_report(spark, sf):
    n = R.table(spark, sf, "nation").join(R.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("n")).orderBy("name")


def delimited(spark, sf):
    """Orders written as delimited lines: some have a field too few, one too many or a total that is no number."""
    key, total = F.col("o_orderkey").cast("string"), R.dec("o_totalprice").cast("string")
    line = F.when(F.col("o_orderkey") % 50 == 1, F.concat_ws("|", key, total)).when(
        F.col("o_orderkey") % 50 == 2, F.concat_ws("|", key, F.concat(F.lit("R$"), total), "o_orderstatus")
    ).when(F.col("o_orderkey") % 50 == 3, F.concat_ws("|", key, total, "o_orderstatus", F.lit("more"))).otherwise(F.concat_ws("|", key, total, "o_orderstatus"))
    path = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    R.table(spark, sf, "orders").select(line.alias("order_key|total|status")).write.option("header", True).option("quote", "").option("sep", "\t").csv(path)
    return tables.read_checked(spark, path, schemas.struct("order_key bigint, total decimal(17,2), status string"))


@query("""SELECT o_orderkey AS order_key, CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total, o_orderstatus AS status FROM orders WHERE o_orderkey % 50 NOT IN (1, 2, 3)""")
def delimited_rows(spark, sf):
    """Lines of a delimited file that fit its schema."""
    return delimited(spark, sf)[0]


@query("""SELECT concat_ws('|', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 50 = 2 THEN 'R$' ELSE '' END || CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS VARCHAR),
    CASE WHEN o_orderkey % 50 <> 1 THEN o_orderstatus END, CASE WHEN o_orderkey % 50 = 3 THEN 'more' END) AS line FROM orders WHERE o_orderkey % 50 IN (1, 2, 3)""")
def delimited_rejects(spark, sf):
    """Lines of a delimited file that do not fit, as they stand there."""
    return delimited(spark, sf)[1].select("line")


@query(ORACLE["invoice_extract"].replace("o_orderpriority <> '5-LOW'", "o_orderpriority = '5-LOW'"))
def consumer_extract(spark, sf):
    """Consumer invoices (model 65), all of them outgoing here."""
    headers, items = invoice_parts(spark, sf)
    out = extracts.invoices(headers, items, "65", *WINDOW)
    return out.select("id", "item_id", "part", "entry_reg", "entry_muni", "exit_state", "direction_code", "cancelled", "value_added")


@query(ORACLE["invoice_extract"] + " WHERE is_entry")
def received_extract(spark, sf):
    """Received invoices: the party itself buys, so issuer and recipient change places."""
    headers, items = invoice_parts(spark, sf)
    out = extracts.invoices(headers.where("direction = 0"), items, "55", *WINDOW)
    return out.select("id", "item_id", "part", "entry_reg", "entry_muni", "exit_state", "direction_code", "cancelled", "value_added")
