"""Tables after writes: upserts, replacements, updates, ids, imports."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from apportia import schemas
from apportia.operators import commits, sinks
from apportia.plans import imports, regimes
from apportia.plans.corrections import cancel_invoices as cancel
from apportia.plans.corrections import refresh_consumption_class as refresh
from apportia.retail import frames as R
from apportia.retail.registry import query
from apportia.retail.scan_queries import OPTIONS, option_sources
from apportia.retail.sql import text, using
from apportia.session import cut_lineage, shared_folder
from apportia.sources import tables
from apportia.streaming import incremental


def daily(spark, sf, kind):
    """Value per user and day of one event type; the user of high values is unknown."""
    e = R.table(spark, sf, "events").where(F.col("event_type") == kind)
    user = F.when(F.col("value") < 60, F.col("user_id"))
    return e.groupBy(user.alias("reg"), F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))


def daily_sql(kind):
    return f"""SELECT CASE WHEN value < 60 THEN user_id END AS reg, ts::DATE AS day, MAX(value) AS value FROM events WHERE event_type = '{kind}' GROUP BY 1, 2"""


STORED = f"WITH t AS ({daily_sql('signup')}), s AS ({daily_sql('click')})"


@query(STORED + """ SELECT reg, CAST(day AS VARCHAR) AS day, value FROM s UNION ALL SELECT reg, CAST(day AS VARCHAR), value FROM t
    WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.reg IS NOT DISTINCT FROM t.reg AND s.day = t.day)""")
def upsert(spark, sf):
    """Update and insert on a key that may be null."""
    return sinks.upsert(daily(spark, sf, "signup"), daily(spark, sf, "click"), ["reg", "day"])


@query(STORED + """ SELECT reg, CAST(day AS VARCHAR) AS day, value FROM t WHERE reg IS NOT NULL UNION ALL SELECT reg, CAST(day AS VARCHAR), value FROM s
    WHERE reg IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE s.reg = t.reg AND s.day = t.day)""")
def insert_new(spark, sf):
    known = lambda k: daily(spark, sf, k).where("reg is not null")
    return sinks.insert_new(known("signup"), known("click"), ["reg", "day"])


@query(STORED + """ SELECT reg, CAST(day AS VARCHAR) AS day, value FROM t WHERE day NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'
    UNION ALL SELECT reg, CAST(day AS VARCHAR), value FROM s WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'""")
def replace_period(spark, sf):
    """A window of the table replaced by a new load of the same window."""
    inside = F.col("day").between("2024-01-10", "2024-01-15")
    return sinks.replace_where(daily(spark, sf, "signup"), daily(spark, sf, "click").where(inside), inside)


@query(STORED + """ SELECT reg, CAST(day AS VARCHAR) AS day, value FROM t WHERE reg IS NULL OR reg NOT IN (SELECT reg FROM s WHERE value > 55 AND reg IS NOT NULL)
    UNION ALL SELECT reg, CAST(day AS VARCHAR), value FROM s WHERE value > 55 AND reg IS NOT NULL""")
def replace_keys(spark, sf):
    new = daily(spark, sf, "click").where("value > 55 and reg is not null")
    return sinks.replace_keys(daily(spark, sf, "signup"), new, new, ["reg"])


@query(STORED + """ SELECT t.reg, CAST(t.day AS VARCHAR) AS day, CASE WHEN s.day IS NOT NULL THEN CASE WHEN s.value > 10 THEN s.value END ELSE t.value END AS value
    FROM t LEFT JOIN s ON s.reg = t.reg AND s.day = t.day""")
def keyed_update(spark, sf):
    """Values taken from the change list where the key is listed, nulls too."""
    changes = daily(spark, sf, "click").where("reg is not null").withColumn("value", F.when(F.col("value") > 10, F.col("value")))
    return sinks.update_columns(daily(spark, sf, "signup"), changes, ["reg", "day"], ["value"])


@query(using("docs", then="""SELECT order_key, supplier_key, CAST(CASE WHEN reason IN (10, 12) AND period BETWEEN 199701 AND 199712 THEN NULL ELSE reason END AS INTEGER) AS reason,
    CAST(CASE WHEN reason = 11 AND order_key IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW') THEN NULL ELSE reason END AS INTEGER) AS listed_reason FROM docs"""))
def reset_reason(spark, sf):
    docs = R.documents(spark, sf).select(*R.DOC, "period", "reason", F.col("reason").alias("listed_reason"))
    out = sinks.reset_reason(docs, [10, 12], F.col("period").between(199701, 199712))
    keys = R.table(spark, sf, "orders").where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("order_key"))
    return sinks.reset_reason(out, [11], keys=keys, on=["order_key"], column="listed_reason").drop("period")


@query("""WITH k AS (SELECT o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders WHERE o_orderstatus = 'O')
    SELECT * FROM k UNION ALL SELECT o_orderkey, (SELECT MAX(id) FROM k) + row_number() OVER (ORDER BY o_orderkey) FROM orders WHERE o_orderstatus <> 'O'""")
def surrogate_ids(spark, sf):
    """Ids for known keys kept, new keys numbered after them."""
    o = R.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "key")
    by_key = F.floor(F.col("key") / 256)
    old = sinks.assign_ids(o.where("o_orderstatus = 'O'"), None, "key", by_key)
    return sinks.assign_ids(o, old, "key", by_key)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CAST(NULL AS INTEGER) AS doc_type, CAST(NULLIF(o_custkey, 0) AS DOUBLE) AS entry_reg,
    CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total FROM orders""")
def align_schema(spark, sf):
    """Target layout: casts, typed nulls, zero keys to null."""
    o = R.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ACCESS_KEY"), F.col("o_custkey").alias("Entry_Reg"), F.col("o_totalprice").alias("total")
    )
    out = sinks.align(sinks.zero_keys_to_null(o, ["Entry_Reg"]), schemas.DOCUMENT)
    return out.select("access_key", "doc_type", "entry_reg", "total")


@query(using("docs", then="""SELECT order_key, supplier_key, CAST(reason AS INTEGER) AS reason, CASE reason WHEN 10 THEN 'document cancelled'
    WHEN 11 THEN 'both parties unregistered or simplified' WHEN 12 THEN 'no participating item' END AS reason_text FROM docs WHERE reason IS NOT NULL"""))
def excluded_documents(spark, sf):
    from apportia.plans import reports

    gone = sinks.split_participating(R.documents(spark, sf))[1]
    return reports.excluded_documents(gone, F.lit(True)).select(*R.DOC, "reason", "reason_text")


@query("""WITH s AS (SELECT user_id AS reg, ts::DATE AS start, MAX(value) AS value FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
    n AS (SELECT user_id AS reg, ts::DATE AS start, MAX(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2),
    m AS (SELECT * FROM s UNION ALL SELECT * FROM n ANTI JOIN s USING (reg, start))
    SELECT reg, strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(lead(start) OVER (PARTITION BY reg ORDER BY start) - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS stop, value FROM m""")
def close_versions(spark, sf):
    """Stored versions with new ones merged in, each closed by the next start."""
    e = R.table(spark, sf, "events")
    rows = lambda k: e.where(F.col("event_type") == k).groupBy(
        F.col("user_id").alias("reg"), F.to_date("ts").cast("timestamp").alias("start")
    ).agg(F.max("value").alias("value")).select("reg", "start", F.lit(None).cast("timestamp").alias("stop"), "value")
    return sinks.close_versions(rows("signup"), rows("view"), ["reg"], "start", "stop")


@query(f"""SELECT user_id AS run_id, {text('MIN(ts)')} AS started_at, {text('MAX(ts)')} AS changed_at, arg_max(event_type, ts) AS status, CAST(SUM(event_id) AS BIGINT) AS amount
    FROM events GROUP BY 1""")
def run_states(spark, sf):
    """Events as run events: current state and counters of each run."""
    e = R.table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.lit("load").alias("job"), F.col("ts").alias("at"), F.col("event_type").alias("status"),
        F.col("event_id").alias("amount"),
    )
    return sinks.run_states(e).drop("job")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS access_key, CASE WHEN CAST(o_orderkey AS VARCHAR) LIKE '52%' THEN 10 ELSE 2 END AS doc_type,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(17,2)) END AS DOUBLE) AS value_added,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 10 END AS INTEGER) AS reason FROM orders""")
def cancel_invoices(spark, sf):
    o = R.table(spark, sf, "orders").withColumn("access_key", F.col("o_orderkey").cast("string"))
    docs = o.select(
        "access_key", F.when(F.col("access_key").startswith("52"), 10).otherwise(2).alias("doc_type"),
        R.dec("o_totalprice").alias("value_added"), F.lit(None).cast("int").alias("reason"),
    )
    return cancel(docs, o.where("o_orderstatus = 'P'").select("access_key"))


@query("""SELECT o_orderkey AS access_key, COALESCE(MAX(l_returnflag), '-') AS consumption_class FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def consumption_class(spark, sf):
    known = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("access_key"), F.lit("-").alias("consumption_class"))
    bills = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("access_key"), F.col("l_returnflag").alias("consumption_class"))
    return refresh(known, bills)


@query(f"""WITH {OPTIONS} SELECT base, reg, register, option_no, CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS stop, valid FROM opt
    UNION ALL SELECT lpad(CAST(user_id AS VARCHAR), 8, '0'), 0, 1, event_id, CAST(ts::DATE AS VARCHAR), NULL, false FROM events
    WHERE event_type = 'signup' AND NOT EXISTS (SELECT 1 FROM opt WHERE option_no = event_id)""")
def load_options(spark, sf):
    """Stored option periods updated by a load of both registers."""
    simplified, micro, regs = option_sources(spark, sf)
    e = R.table(spark, sf, "events").where("event_type = 'signup'")
    day = F.to_date("ts")
    stored = e.select(
        F.lpad(F.col("user_id").cast("string"), 8, "0").alias("base"), F.lit(0).cast("bigint").alias("reg"), F.lit(1).alias("register"),
        F.col("event_id").alias("option_no"), day.alias("start"), F.lit(None).cast("date").alias("stop"), day.alias("updated"),
        F.lit(False).alias("valid"),
    )
    return regimes.load_options(stored, simplified, micro, regs, 20240105, 20240125).drop("updated")


def import_rows(spark, sf):
    """Orders as an external value-added file, with faults the checks must find."""
    o = R.table(spark, sf, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.year("o_orderdate").cast("string").alias("ano"),
        F.date_format("o_orderdate", "yyyyMM").alias(" referencia "),
        F.when(F.col("o_orderstatus") == "F", "9").otherwise("11").alias("tipo_documento"),
        F.when(p == "1", "X").when(p == "2", "E").otherwise("S").alias("tipo_apropriacao"),
        F.when(p == "3", " ").when(p == "4", "R$ x").otherwise(F.concat(F.lit("R$ "), R.dec("o_totalprice").cast("string"))).alias("valor_adicionado"),
        F.when(F.col("o_custkey") > 50, (F.col("o_custkey") % 30).cast("string")).alias("codigo_municipio"),
        F.when(F.col("o_orderstatus") == "P", "?").when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")).alias("num_inscricao"),
    )


@query(using("munis", then=f"""SELECT CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS empty_file, COUNT(*) FILTER (year(o_orderdate) <> 1997) AS other_year,
    COUNT(*) FILTER (year(o_orderdate) * 100 + month(o_orderdate) NOT BETWEEN 199701 AND 199712) AS other_period, COUNT(*) FILTER (o_orderstatus = 'F') AS other_type,
    COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS bad_direction, COUNT(*) FILTER (o_orderpriority = '3-MEDIUM') AS no_value,
    COUNT(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS bad_value, COUNT(*) FILTER (o_custkey <= 50) AS no_muni, COUNT(*) FILTER (o_orderstatus = 'P') AS bad_reg,
    COUNT(*) FILTER (state IS DISTINCT FROM '{R.HOME}') AS outside_state FROM orders LEFT JOIN munis ON o_custkey > 50 AND muni = o_custkey % 30"""))
def import_checks(spark, sf):
    df = imports.typed_value_added(import_rows(spark, sf), R.munis(spark, sf))
    return imports.value_added_checks(df, 1997, (199701, 199712), 11, R.HOME)


@query(using("munis", then=f"""SELECT CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS empty_file, COUNT(*) FILTER (s = 'O') AS other_stage, COUNT(*) FILTER (p = '1') AS other_type,
    COUNT(*) FILTER (p = '3') AS no_value, COUNT(*) FILTER (p = '4') AS bad_value, COUNT(*) FILTER (code IS NULL) AS no_muni,
    COUNT(*) FILTER (state IS DISTINCT FROM '{R.HOME}') AS outside_state, COUNT(*) FILTER (n > 1 AND code IS NOT NULL) AS repeated_muni
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY code) AS n FROM (SELECT o_orderstatus AS s, substr(o_orderpriority, 1, 1) AS p, CASE WHEN o_custkey > 50 THEN o_orderkey // 2 END AS code FROM orders))
    LEFT JOIN munis ON muni = code"""))
def index_import_checks(spark, sf):
    o = R.table(spark, sf, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    raw = o.select(
        F.lit("1997").alias("ano"), F.when(F.col("o_orderstatus") == "O", "D").otherwise("P").alias("etapa_indice"),
        F.when(p == "1", "5").otherwise("1").alias("tipo_indice"),
        F.when(p == "3", "").when(p == "4", "-,-").otherwise("0,1234567890123456").alias("indice_participacao"),
        F.when(F.col("o_custkey") > 50, F.floor(F.col("o_orderkey") / 2)).alias("codigo_municipio"),
    )
    return imports.index_checks(imports.typed_index(raw, R.munis(spark, sf)), "P", "1", R.HOME)


@query(using("munis", then=f"""SELECT 11 AS doc_type, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, 'S' AS direction, CAST(o_custkey AS DOUBLE) AS reg,
    CAST(COALESCE(parent, muni) AS INTEGER) AS muni, CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS value_added FROM orders JOIN munis ON muni = o_custkey % 25 WHERE state = '{R.HOME}'"""))
def import_value_added(spark, sf):
    """A clean file passes all checks; districts become their municipality."""
    o = R.table(spark, sf, "orders").withColumn("m", F.col("o_custkey") % 25)
    home = R.munis(spark, sf).where(F.col("state") == R.HOME).select(F.col("muni").alias("m"))
    raw = o.join(home, "m").select(
        F.lit("1997").alias("ano"), F.date_format("o_orderdate", "yyyyMM").alias("referencia"), F.lit("11").alias("tipo_documento"),
        F.lit("S").alias("tipo_apropriacao"), F.concat(F.lit("R$ "), R.dec("o_totalprice").cast("string")).alias("valor_adicionado"),
        F.col("m").cast("string").alias("codigo_municipio"), F.col("o_custkey").cast("string").alias("num_inscricao"),
    )
    return imports.import_value_added(raw, R.munis(spark, sf), 1997, (199501, 200112), 11, 1, R.HOME).drop("run_id")


@query("""WITH raw AS (SELECT lpad(CAST(o_custkey * 100000 + o_orderkey % 50 AS VARCHAR), 17, '0') AS id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 3 AS activity,
        year(o_orderdate) * 100 + month(o_orderdate) AS period, CAST(o_totalprice AS DECIMAL(17,2)) AS amount, o_custkey FROM orders),
    w AS (SELECT * FROM raw QUALIFY CAST(substr(id, 15) AS BIGINT) = MAX(CAST(substr(id, 15) AS BIGINT)) OVER (PARTITION BY substr(id, 1, 14))),
    d AS (SELECT id, CAST(period AS INTEGER) AS period, o_custkey, SUM(amount) AS total FROM w WHERE activity <= 6 GROUP BY 1, 2, 3)
    SELECT id AS declaration, period, lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS full_tax_no, c_custkey AS reg, CAST(n_nationkey AS INTEGER) AS muni,
    CAST(total AS DOUBLE) AS total, CAST(total * CAST(0.32 AS DECIMAL(3,2)) AS DOUBLE) AS counted, 11 AS doc_type
    FROM d LEFT JOIN nation ON n_nationkey = o_custkey % 40 LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""")
def load_declarations(spark, sf):
    from apportia.retail.history_queries import declared

    rows = declared(spark, sf).withColumn("revenue_muni", F.col("tax_no") % 40)
    munis = R.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("revenue_muni"), F.col("n_nationkey").alias("muni"))
    regs = R.table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("tax_no"), F.col("c_custkey").alias("reg")
    )
    return regimes.load_declarations(rows, 199501, 200112, munis, regs)


RELOADED = "o_orderdate BETWEEN TIMESTAMP '1996-03-05 00:00:00' AND TIMESTAMP '1996-03-20 11:59:59'"


def reloaded(spark, sf):
    """Orders and their lines after half a month is loaded again: even customers only, one more piece in each line."""
    orders = R.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", R.dec("o_totalprice").alias("total"), "o_custkey")
    lines = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", R.dec("l_quantity").alias("quantity"))
    new = orders.where(f"{RELOADED} AND o_custkey % 2 = 0")
    docs, items = sinks.replace_window(
        orders, lines, new.withColumn("total", (2 * F.col("total")).cast("decimal(17,2)")),
        lines.join(new.select("o_orderkey"), "o_orderkey").withColumn("quantity", (F.col("quantity") + 1).cast("decimal(17,2)")),
        F.expr(RELOADED), ["o_orderkey"],
    )
    return docs.drop("o_custkey"), items


@query(f"""SELECT o_orderkey, {text('o_orderdate')} AS o_orderdate, CAST(CASE WHEN {RELOADED} THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total
    FROM orders WHERE NOT ({RELOADED} AND o_custkey % 2 <> 0)""")
def replace_window_documents(spark, sf):
    return reloaded(spark, sf)[0]


@query(f"""SELECT l_orderkey AS o_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(17,2)) + CASE WHEN {RELOADED} THEN 1 ELSE 0 END AS DOUBLE) AS quantity
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE NOT COALESCE({RELOADED} AND o_custkey % 2 <> 0, false)""")
def replace_window_items(spark, sf):
    return reloaded(spark, sf)[1]


def folder_of(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def committed(spark, sf):
    """Orders and their lines stored by year, then half a month loaded again in one commit; and the store."""
    store = commits.Tables(spark, folder_of(spark, "orders"), ["year"])
    orders = R.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", R.dec("o_totalprice").alias("total"), "o_custkey", F.year("o_orderdate").alias("year")
    )
    lines = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", R.dec("l_quantity").alias("quantity"))
    lines = lines.join(orders.select("o_orderkey", "year"), "o_orderkey")
    first = store.commit(store.state(), {"orders": commits.Change(orders), "lines": commits.Change(lines)})
    new = cut_lineage(orders.where(f"{RELOADED} AND o_custkey % 2 = 0").withColumn("total", (2 * F.col("total")).cast("decimal(17,2)")))
    more = cut_lineage(lines.join(new.select("o_orderkey"), "o_orderkey").withColumn("quantity", (F.col("quantity") + 1).cast("decimal(17,2)")))
    gone = orders.where(RELOADED).select("o_orderkey")
    years = {int(v) for p in store.partitions(orders.where(RELOADED)) for v in json.loads(p)}
    touched = lambda values: values[0] in years
    store.commit(first, {
        "orders": commits.replaced_rows(store, first, "orders", new, touched, F.expr(RELOADED)),
        "lines": commits.replaced_rows(store, first, "lines", more, touched, gone, ["o_orderkey"]),
    })
    return store


@query(f"""SELECT o_orderkey, {text('o_orderdate')} AS o_orderdate, CAST(CASE WHEN {RELOADED} THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(17,2)) AS DOUBLE) AS total
    FROM orders WHERE NOT ({RELOADED} AND o_custkey % 2 <> 0)""")
def committed_documents(spark, sf):
    """Documents after a window was loaded again by one commit with its items."""
    return committed(spark, sf).read("orders").select("o_orderkey", "o_orderdate", "total")


@query(f"""SELECT l_orderkey AS o_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(17,2)) + CASE WHEN {RELOADED} THEN 1 ELSE 0 END AS DOUBLE) AS quantity
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE NOT COALESCE({RELOADED} AND o_custkey % 2 <> 0, false)""")
def committed_items(spark, sf):
    return committed(spark, sf).read("lines").select("o_orderkey", "l_linenumber", "quantity")


@query("""SELECT year(o_orderdate) AS year, CAST(SUM(CAST(o_totalprice AS DECIMAL(17,2))) AS DOUBLE) AS total, COUNT(*) AS orders,
    '1998-12-31T23:59:59' AS mark FROM orders WHERE o_orderdate > TIMESTAMP '1992-12-31 23:59:59' AND o_orderdate <= TIMESTAMP '1998-12-31 23:59:59' GROUP BY 1""")
def stored_mark(spark, sf):
    """Slices of two years loaded from a stored mark; a second runner gets in between and takes one of them."""
    store = commits.Tables(spark, folder_of(spark, "marks"), ["year"])
    orders = R.table(spark, sf, "orders").select(R.dec("o_totalprice").alias("total"), "o_orderdate", F.year("o_orderdate").alias("year"))
    begun = []

    def load(first, last, state, marks, also=None):
        if also:
            also()
        rows = cut_lineage(orders.where(F.col("o_orderdate").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))))
        inside = F.col("o_orderdate").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
        store.commit(state, {"orders": commits.replaced_rows(store, state, "orders", rows, lambda v: False, inside)}, marks)

    ends = [datetime(1994, 12, 31, 23, 59, 59), datetime(1998, 12, 31, 23, 59, 59)]
    run = lambda limit, load: incremental.advance_stored(store, "orders", datetime(1992, 12, 31, 23, 59, 59), timedelta(days=730.5) - timedelta(hours=12), limit, load)

    def meanwhile():
        if not begun:
            begun.append(run(ends[0], load))

    run(ends[1] - timedelta(days=1), lambda *a: load(*a, also=meanwhile))
    state = store.state()
    last = datetime.fromisoformat(state.marks["orders"])
    load(f"{last + timedelta(seconds=1):%Y-%m-%d %H:%M:%S}", f"{ends[1]:%Y-%m-%d %H:%M:%S}", state, {"orders": ends[1].isoformat()})
    state = store.state()
    return store.read("orders", state).groupBy("year").agg(
        F.sum("total").alias("total"), F.count(F.lit(1)).alias("orders")
    ).withColumn("mark", F.lit(state.marks["orders"]))


@query("""WITH k AS (SELECT DISTINCT l_orderkey, l_suppkey, l_orderkey % 16 AS bucket, o_orderstatus = 'O' AS old FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY bucket, old ORDER BY l_orderkey, l_suppkey) - 1 AS nth, COUNT(*) FILTER (old) OVER (PARTITION BY bucket) AS held FROM k)
    SELECT CAST(bucket AS INTEGER) AS bucket, l_orderkey, l_suppkey, (CASE WHEN old THEN nth ELSE held + nth END) * 16 + bucket AS id FROM r""")
def identity_map(spark, sf):
    """Ids of (order, supplier) keys: those of open orders are stored first, all others are added to their buckets."""
    from apportia.plans import store

    tables = commits.Tables(spark, folder_of(spark, "ids"), ["bucket"])
    lines = R.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    known = lines.join(R.table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    cols, bucket = ["l_orderkey", "l_suppkey"], F.col("l_orderkey") % 16
    store.extend_identity_map(tables, "ids", known, cols, 16, bucket)
    store.extend_identity_map(tables, "ids", lines, cols, 16, bucket)
    return tables.read("ids").select("bucket", *cols, "id")


STORED_DOCS = using("docs", then="""SELECT order_key || '-' || supplier_key AS access_key, doc_type, period, CAST(value_added AS DOUBLE) AS value_added,
    CAST(reason AS INTEGER) AS reason, CAST(CASE WHEN period = 199703 THEN 78 ELSE 77 END AS BIGINT) AS run_id FROM docs WHERE period BETWEEN 199701 AND 199706""")
DOC_FIELDS = ("access_key", "doc_type", "period", "value_added", "reason", "run_id")


def stored_documents_path(spark, sf) -> str:
    """Half a year of documents stored by type and period, its rows counted again; a month is stored twice."""
    from apportia.plans import store

    path = folder_of(spark, "documents")
    docs = R.keyed(R.documents(spark, sf)).where("period BETWEEN 199701 AND 199706").withColumn("total", F.col("value_added"))
    docs = cut_lineage(docs)
    store.documents(spark, docs, path, 77)
    store.documents(spark, docs.where("period = 199703"), path, 78)
    return path


@query(STORED_DOCS)
def written_documents(spark, sf):
    """Documents read back after they were stored and one of their periods was replaced by a later run."""
    return spark.read.parquet(stored_documents_path(spark, sf)).select(*DOC_FIELDS)


@query(STORED_DOCS + " AND NOT (doc_type = 10 AND period BETWEEN 199702 AND 199704)")
def cleared_documents(spark, sf):
    """The stored table without some periods of one type."""
    from apportia.plans import store

    out = folder_of(spark, "left")
    store.clear(spark, stored_documents_path(spark, sf), out, 10, (199702, 199704))
    return spark.read.parquet(out).select(*DOC_FIELDS)


@query(STORED_DOCS + " AND reason IS NOT NULL")
def written_exclusions(spark, sf):
    """Documents that do not participate, in a table of their own."""
    from apportia.plans import store

    out = folder_of(spark, "excluded")
    store.excluded(spark.read.parquet(stored_documents_path(spark, sf)), out)
    return spark.read.parquet(out).select(*DOC_FIELDS)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(17,2)) AS VARCHAR) AS balance FROM customer""")
def exported_rows(spark, sf):
    """A result exported as delimited text, and read again as text."""
    path = folder_of(spark, "export")
    rows = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), R.dec("c_acctbal").alias("balance"))
    sinks.export_csv(rows, path)
    return tables.read_delimited(spark, path)


@query("""WITH old AS (SELECT DISTINCT lpad(CAST(p_size * 100 AS VARCHAR), 4, '0') AS code FROM part WHERE p_size < 30),
    new AS (SELECT DISTINCT lpad(CAST(p_size * 100 AS VARCHAR), 4, '0') AS code FROM part)
    SELECT code, '2020-01-01' AS start, 10 AS doc_type FROM old UNION ALL
    SELECT code, '2024-01-01', 10 FROM new WHERE code < '4500'""")
def reference_codes(spark, sf):
    """Operation codes of a file added to those stored, and those of one year and type dropped again where a file was wrong."""
    from apportia.plans import reference_loads

    p = R.table(spark, sf, "part").select((F.col("p_size") * 100).alias("size"), F.lpad((F.col("p_size") * 100).cast("string"), 4, "0").alias("code"))
    none = spark.createDataFrame([], "code string, start date, stop date, doc_type int")
    held = reference_loads.op_codes(none, p.where("size < 3000"), "2020-01-01", 10)
    wrong = reference_loads.op_codes(held, p, "2023-01-01", 10)
    right = reference_loads.op_codes(reference_loads.drop_op_codes(wrong, 2023, 10), p.where("code < '4500'"), "2024-01-01", 10)
    return right.select("code", "start", "doc_type")
