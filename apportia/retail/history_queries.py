"""Registry history, windows, declarations and the remaining roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportia.functions import dates
from apportia.operators import history, rollups, spans
from apportia.retail import frames as R
from apportia.retail.registry import query
from apportia.retail.sql import text, using
from apportia.plans import ticket

STATE = "CASE WHEN value < 15 THEN 'low' WHEN value < 40 THEN NULL ELSE 'high' END"


def attrs(df):
    v = F.col("value")
    return df.select(
        "user_id", "ts", "event_id", F.when(v < 15, "low").when(v < 40, None).otherwise("high").alias("level"),
        (v > 20).alias("big"),
    )


@query(f"""SELECT user_id, event_id, level, big FROM (SELECT *, lag(level) OVER w AS pl, lag(big) OVER w AS pb, row_number() OVER w AS rn
    FROM (SELECT user_id, ts, event_id, {STATE} AS level, value > 20 AS big FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE rn = 1 OR level IS DISTINCT FROM pl OR big IS DISTINCT FROM pb""")
def change_detect(spark, sf):
    """Rows that differ from the one before; a null that stays null is no change."""
    e = attrs(R.table(spark, sf, "events"))
    return history.changed_rows(e, ["user_id"], ["ts", "event_id"], ["level", "big"], spans.day_span("ts")).drop("ts")


@query(f"""SELECT user_id, event_id, {text('ts')} AS start, {text("lead(ts) OVER (PARTITION BY user_id ORDER BY ts) - INTERVAL 1 SECOND")} AS stop FROM events""")
def validity_end(spark, sf):
    e = R.table(spark, sf, "events").select("user_id", "event_id", F.col("ts").alias("start"))
    return history.close_validity(e, ["user_id"], "start", "stop", spans.day_span("start"))


DAILY = f"""WITH e AS (SELECT user_id, ts, {STATE} AS level, value > 20 AS big FROM events),
    c AS (SELECT * FROM (SELECT *, lag(level) OVER w AS pl, lag(big) OVER w AS pb, row_number() OVER w AS rn FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts))
        WHERE rn = 1 OR level IS DISTINCT FROM pl OR big IS DISTINCT FROM pb),
    d AS (SELECT user_id, date_trunc('day', ts) AS start, level, big FROM c QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC) = 1)"""


@query(DAILY + f""" SELECT user_id, {text('start')} AS start, {text("lead(start) OVER (PARTITION BY user_id ORDER BY start) - INTERVAL 1 SECOND")} AS stop, level, big FROM d""")
def daily_versions(spark, sf):
    """Versions by whole days: the last change of a day counts."""
    e = attrs(R.table(spark, sf, "events"))
    return history.daily_versions(e, ["user_id"], "ts", ["level", "big"], "start", "stop")


@query(f"""SELECT user_id, event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
    FROM (SELECT *, CASE WHEN value > 25 THEN value END AS v FROM events)""")
def forward_fill(spark, sf):
    e = R.table(spark, sf, "events").select("user_id", "ts", "event_id", F.when(F.col("value") > 25, F.col("value")).alias("filled"))
    return spans.forward_fill(e, ["user_id"], ["ts", "event_id"], spans.day_span("ts"), ["filled"]).drop("ts")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS position FROM lineitem""")
def item_numbers(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]
    line = R.table(spark, sf, "lineitem").select("l_orderkey", *order)
    out = spans.position(line, ["l_orderkey"], order, spans.number_span("l_linenumber", 4))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position")


@query(f"""SELECT user_id, {text('ts')} AS ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1""")
def last_row(spark, sf):
    return spans.best_row(R.table(spark, sf, "events").select("user_id", "ts", "event_type"), ["user_id"], ["ts", "event_type"])


@query("""SELECT CAST(user_id AS VARCHAR) AS access_key, event_id AS boarded, event_type AS prefix, 'A' AS seat FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def latest_trip(spark, sf):
    e = R.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("access_key"), F.col("event_id").alias("boarded"),
        F.col("event_type").alias("prefix"), F.lit("A").alias("seat"),
    )
    return ticket.latest_trip(e)


@query(using("items", then="""SELECT order_key, supplier_key, item_no, part_key, CAST(SUM(gross) OVER (PARTITION BY order_key) AS DOUBLE) AS all_gross,
    CAST(SUM(CASE WHEN return_flag <> 'R' THEN gross END) OVER (PARTITION BY order_key) AS DOUBLE) AS kept_gross FROM items"""))
def group_totals(spark, sf):
    """Group totals on every row, all and conditional."""
    out = spans.group_total(
        R.items(spark, sf), ["order_key"],
        {"all_gross": F.col("gross"), "kept_gross": F.when(F.col("return_flag") != "R", F.col("gross"))},
    )
    return out.select(*R.DOC, "item_no", "part_key", "all_gross", "kept_gross")


PERIODS = """periods AS (SELECT user_id AS reg, event_id AS option_no, ts::DATE AS start,
    CASE WHEN value < 60 THEN ts::DATE + CAST(floor(value / 4) AS INTEGER) END AS stop FROM events WHERE event_type = 'signup')"""


def periods(spark, sf):
    """Sign-ups as option periods of some days; high values stay open."""
    days = F.floor(F.col("value") / 4).cast("int")
    return R.table(spark, sf, "events").where("event_type = 'signup'").select(
        F.col("user_id").alias("reg"), F.col("event_id").alias("option_no"), F.to_date("ts").alias("start"),
        F.when(F.col("value") < 60, F.date_add(F.to_date("ts"), days)).alias("stop"),
    )


KEPT = f"""{PERIODS}, kept AS (SELECT reg, option_no, start, stop FROM (SELECT *, MAX(COALESCE(stop, DATE '9999-12-31')) OVER (PARTITION BY reg
    ORDER BY start, option_no DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM periods)
    WHERE m IS NULL OR m < COALESCE(stop, DATE '9999-12-31'))"""


@query(f"WITH {KEPT} SELECT reg, option_no, CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS stop FROM kept")
def drop_contained(spark, sf):
    return history.drop_contained(periods(spark, sf), "reg", "start", "stop", "option_no")


CHANGES = f"""{KEPT}, ev AS (SELECT reg, start AS "at", '3' AS regime, false AS e FROM kept UNION ALL SELECT reg, stop + 1, '2', true FROM kept WHERE stop IS NOT NULL),
    day AS (SELECT reg, "at", CASE WHEN bool_or(NOT e) THEN '3' ELSE '2' END AS regime, COUNT(*) AS n, bool_or(NOT e) AS starts FROM ev GROUP BY 1, 2)"""


@query(f"""WITH {CHANGES} SELECT reg, CAST("at" AS VARCHAR) AS "at", regime FROM (SELECT *, lag(regime) OVER (PARTITION BY reg ORDER BY "at") AS p
    FROM day WHERE n = 1 OR starts) WHERE p IS DISTINCT FROM regime""")
def regime_changes(spark, sf):
    """Option periods as changes of regime."""
    return history.regime_changes(periods(spark, sf), "reg", "start", "stop", "option_no")


@query(f"""WITH {CHANGES} SELECT reg, CAST("at" AS VARCHAR) AS "at", regime FROM day WHERE n = 1""")
def regime_log(spark, sf):
    """Option periods as log entries: shared days go altogether."""
    return history.regime_changes(periods(spark, sf), "reg", "start", "stop", "option_no", drop_all=True)


@query("""SELECT user_id, CAST(ts::DATE AS VARCHAR) AS day FROM events WHERE event_type = 'click' GROUP BY 1, 2 HAVING COUNT(*) = 1""")
def unique_days(spark, sf):
    e = R.table(spark, sf, "events").where("event_type = 'click'").select("user_id", F.to_date("ts").alias("day"))
    return history.unique_days(e, ["user_id", "day"])


def event_day(spark, sf, kind, name, value):
    e = R.table(spark, sf, "events").where(F.col("event_type") == kind)
    return e.groupBy(F.col("user_id").alias("reg"), F.to_date("ts").alias("at")).agg(F.max(value).alias(name))


@query("""WITH a AS (SELECT user_id AS reg, ts::DATE AS "at", MAX(CASE WHEN event_type = 'signup' THEN event_id END) AS muni,
    MAX(CASE WHEN event_type = 'click' THEN CASE WHEN value > 20 THEN 'S' ELSE 'N' END END) AS rural,
    MAX(CASE WHEN event_type = 'view' THEN CASE WHEN value > 20 THEN '3' ELSE '2' END END) AS regime
    FROM events WHERE event_type IN ('signup', 'click', 'view') GROUP BY 1, 2)
    SELECT reg, CAST("at" AS VARCHAR) AS "at", last_value(muni IGNORE NULLS) OVER w AS muni, COALESCE(last_value(rural IGNORE NULLS) OVER w, 'N') AS rural,
    COALESCE(last_value(regime IGNORE NULLS) OVER w, '2') AS regime FROM a WINDOW w AS (PARTITION BY reg ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def merged_timeline(spark, sf):
    """Registry, activity and regime changes on one timeline, carried forward."""
    sources = [
        event_day(spark, sf, "signup", "muni", F.col("event_id")),
        event_day(spark, sf, "click", "rural", F.when(F.col("value") > 20, "S").otherwise("N")),
        event_day(spark, sf, "view", "regime", F.when(F.col("value") > 20, "3").otherwise("2")),
    ]
    return history.merge_timelines(sources, "reg", "at", {"muni": None, "rural": "N", "regime": "2"})


@query(f"""SELECT user_id, event_id FROM (SELECT *, MAX(CASE WHEN ts < TIMESTAMP '2024-01-10 00:00:00' THEN ts END) OVER (PARTITION BY user_id) AS f,
    MIN(ts) OVER (PARTITION BY user_id) AS o FROM events WHERE event_type = 'signup')
    WHERE (ts <= TIMESTAMP '2024-01-20 00:00:00' AND (f IS NULL OR ts >= f)) OR (f IS NULL AND ts = o)""")
def window_changes(spark, sf):
    """Changes of a window and the last one before it."""
    e = R.table(spark, sf, "events").where("event_type = 'signup'").select("user_id", "ts", "event_id")
    return history.changes_for_window(e, "user_id", "ts", "2024-01-10 00:00:00", "2024-01-20 00:00:00").drop("ts")



@query(using("change_log", then=f""", n AS (SELECT reg, "at" AS t,
        {', '.join(f"first_value(CASE WHEN attr = '{a}' THEN old END IGNORE NULLS) OVER later AS {a}" for a in ('status', 'regime', 'muni'))},
        SUM(activities) OVER later AS activities, SUM(rural_activities) OVER later AS rural_activities FROM change_log
        WINDOW later AS (PARTITION BY reg ORDER BY "at" ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
    SELECT c_custkey AS reg, {text("COALESCE(t, TIMESTAMP '2024-02-01 00:00:00')")} AS "at", COALESCE(n.status, c.status) AS status,
        COALESCE(n.regime, c.regime) AS regime, COALESCE(n.muni, c.muni) AS muni, CAST(3 + COALESCE(activities, 0) AS BIGINT) AS activities,
        CAST(1 + COALESCE(rural_activities, 0) AS BIGINT) AS rural_activities
    FROM (SELECT c_custkey, 'now' AS status, c_mktsegment AS regime, CAST(c_nationkey AS VARCHAR) AS muni FROM customer) c LEFT JOIN n ON n.reg = c_custkey"""))
def replay_history(spark, sf):
    """Every version of each customer rebuilt from today's values and a log of old values."""
    return replayed(spark, sf)


def replayed(spark, sf):
    now = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("reg"), F.lit("now").alias("status"), F.col("c_mktsegment").alias("regime"),
        F.col("c_nationkey").cast("string").alias("muni"), F.lit(3).cast("bigint").alias("activities"),
        F.lit(1).cast("bigint").alias("rural_activities"),
    )
    return history.replay(
        now, R.change_log(spark, sf), "reg", "at", ["status", "regime", "muni"], "2024-02-01 00:00:00",
        ["activities", "rural_activities"],
    )


@query(f"""WITH m AS (SELECT user_id AS reg, ts AS "at", CASE WHEN event_type = 'click' THEN CAST(floor(value) AS INTEGER) % 4 END AS own,
        CASE WHEN event_type = 'view' THEN COALESCE(p_size % 3, 0) END AS street FROM events LEFT JOIN part ON p_partkey = CAST(floor(value) AS BIGINT) AND event_type = 'view'
        WHERE event_type IN ('click', 'view')),
    l AS (SELECT reg, "at", first_value(own IGNORE NULLS) OVER w AS own, first_value(street IGNORE NULLS) OVER w AS street FROM m
        WINDOW w AS (PARTITION BY reg ORDER BY "at" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT reg, {text('"at"')} AS "at", CAST(COALESCE(NULLIF(own, 0), NULLIF(street, 0), 0) AS VARCHAR) AS old FROM l""")
def municipality_undo(spark, sf):
    """Old municipality, else the old street's, carried back over the log."""
    e = R.table(spark, sf, "events").where("event_type in ('click', 'view')")
    log = e.select(
        F.col("user_id").alias("reg"), F.col("ts").alias("at"), F.when(F.col("event_type") == "click", "muni").otherwise("street").alias("attr"),
        F.when(F.col("event_type") == "click", (F.floor("value") % 4).cast("string")).otherwise(F.floor("value").cast("string")).alias("old"),
    )
    streets = R.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("street"), (F.col("p_size") % 3).alias("muni"))
    return history.municipality_undo(log, streets, "reg", "at").select("reg", "at", "old")


LEDGER = """h AS (SELECT o_custkey AS reg, substr(o_orderpriority, 1, 1) AS code, CAST(1 + floor(o_totalprice / 100000) AS BIGINT) AS percent,
        CASE WHEN o_orderstatus = 'P' THEN 0 ELSE year(o_orderdate) * 100 + month(o_orderdate) END AS s,
        CASE WHEN o_orderstatus = 'O' THEN 0 ELSE year(o_orderdate) * 100 + month(o_orderdate) END AS t, o_orderdate FROM orders),
    ledger AS (SELECT reg, code, CASE WHEN s = 0 THEN DATE '1900-01-01' ELSE date_trunc('month', o_orderdate)::DATE END AS "at", percent FROM h
        UNION ALL SELECT reg, code, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::DATE, -percent FROM h WHERE t <> 0)"""


def activity_rows(spark, sf):
    """Orders as activity spells of a customer; status decides which bounds are open."""
    o, p = R.table(spark, sf, "orders"), dates.period("o_orderdate")
    spells = o.select(
        F.col("o_custkey").alias("reg"), F.substring("o_orderpriority", 1, 1).alias("code"),
        (F.floor(F.col("o_totalprice") / 100000) + 1).cast("bigint").alias("percent"),
        F.when(F.col("o_orderstatus") != "P", p).otherwise(0).alias("first"),
        F.when(F.col("o_orderstatus") != "O", p).otherwise(0).alias("last"),
    )
    return history.activity_ledger(spells, "reg", "code", "percent", "first", "last")


@query(f"""WITH {LEDGER} SELECT reg, code, CAST("at" AS VARCHAR) AS "at", percent, COUNT(*) AS n FROM ledger GROUP BY 1, 2, 3, 4""")
def activity_ledger(spark, sf):
    rows = activity_rows(spark, sf)
    return rows.groupBy("reg", "code", "at", "percent").agg(F.count("*").alias("n"))


@query(f"""WITH {LEDGER}, b AS (SELECT reg, code, month, SUM(percent) AS percent, MAX("at") AS "at" FROM ledger, (VALUES (DATE '1997-01-01'), (DATE '1999-01-01')) m(month)
        WHERE "at" < month GROUP BY 1, 2, 3 HAVING SUM(percent) > 0)
    SELECT reg, CAST(month AS VARCHAR) AS month, CAST(MAX("at") AS VARCHAR) AS changed_at, bool_or(code IN ('1', '2')) AS rural, bool_and(code IN ('1', '2')) AS rural_only
    FROM b GROUP BY 1, 2 HAVING bool_or(code IN ('1', '2'))""")
def rural_by_month(spark, sf):
    """Rural flags at two dates from the balance of each activity."""
    rural = spark.createDataFrame([("1",), ("2",)], "code string")
    return history.rural_by_month(activity_rows(spark, sf), rural, "reg", "code", ["1997-01-01", "1999-01-01"])


@query("""SELECT o_custkey AS reg, bool_or(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS rural,
    bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS rural_only FROM orders GROUP BY 1""")
def rural_flags(spark, sf):
    rural = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "code string")
    held = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("reg"), F.col("o_orderpriority").alias("activity"))
    return history.rural_flags(held, rural, "reg", "activity")


@query("""SELECT o_custkey AS id, CAST(MAX(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(17,2)) END) AS DOUBLE) AS mx,
    CAST(COALESCE(MIN(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(17,2)) END), MIN(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(17,2)) END),
        MIN(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(17,2)) END)) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def first_known(spark, sf):
    """First known total over three ranked sources, some of them without a column."""
    o = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus", R.dec("o_totalprice").alias("total"))
    of = lambda s: o.where(F.col("o_orderstatus") == s).select("id", "total")
    sources = [of("O"), of("F"), of("P"), o.select("id").withColumn("other", F.lit(1))]
    best = rollups.first_known(sources, "id", ["total"])
    top = of("O").groupBy("id").agg(F.max("total").alias("mx"))
    return best.join(top, "id", "left")


@query("""SELECT l_orderkey AS id, CAST(SUM(CAST(l_extendedprice AS DECIMAL(17,2))) AS DOUBLE) AS paid, CAST(SUM(CAST(l_quantity AS DECIMAL(17,2))) AS DOUBLE) AS parts FROM lineitem GROUP BY 1""")
def payment_sums(spark, sf):
    line = R.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "id")
    return rollups.sums(line, "id", {"l_extendedprice": "paid", "l_quantity": "parts"})


@query("""SELECT COUNT(*) AS rows, COUNT(*) FILTER (returned) AS returned_yes, COUNT(*) FILTER (big) AS big_yes, COUNT(*) FILTER (NOT returned) AS returned_no,
    COUNT(*) FILTER (NOT big) AS big_no FROM (SELECT l_returnflag = 'R' AS returned, l_quantity > 25 AS big FROM lineitem)""")
def quality_counters(spark, sf):
    line = R.table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").alias("returned"), (F.col("l_quantity") > 25).alias("big"))
    return rollups.counters(line, ["returned", "big"])


@query("SELECT COUNT(DISTINCT l_orderkey) AS documents, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS items FROM lineitem")
def distinct_documents(spark, sf):
    return R.table(spark, sf, "lineitem").agg(
        F.countDistinct("l_orderkey").alias("documents"), F.countDistinct("l_orderkey", "l_linenumber").alias("items")
    )


@query("""SELECT COUNT(DISTINCT l_orderkey) AS exact, true AS within FROM lineitem""")
def approximate_documents(spark, sf):
    """The exact count, and whether the estimate lies within five times its standard error of it."""
    lines = R.table(spark, sf, "lineitem")
    both = rollups.approximate_documents(lines, "l_orderkey", 0.02).select(
        "documents", lines.agg(F.count_distinct("l_orderkey").alias("exact")).scalar().alias("exact")
    )
    return both.select("exact", (F.abs(F.col("documents") - F.col("exact")) <= 5 * 0.02 * F.col("exact")).alias("within"))


DECLARED = """raw AS (SELECT lpad(CAST(o_custkey * 100000 + o_orderkey % 50 AS VARCHAR), 17, '0') AS id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 3 AS activity,
        year(o_orderdate) * 100 + month(o_orderdate) AS period, CAST(o_totalprice AS DECIMAL(17,2)) AS amount, o_custkey FROM orders),
    w AS (SELECT *, substr(id, 1, 14) AS batch, CAST(substr(id, 15) AS BIGINT) AS seq FROM raw WHERE period BETWEEN 199601 AND 199912),
    k AS (SELECT * FROM w QUALIFY seq = MAX(seq) OVER (PARTITION BY batch)),
    decl AS (SELECT id AS declaration, CAST(period AS INTEGER) AS period, o_custkey AS tax_no, SUM(amount) AS total FROM k WHERE activity IN (0, 1, 2, 3, 4, 5, 6, 34, 35) GROUP BY 1, 2, 3)"""


def declared(spark, sf):
    """Orders as declarations: the order number's remainder is the sequence in a batch."""
    return R.table(spark, sf, "orders").select(
        (F.col("o_custkey") * 100000 + F.col("o_orderkey") % 50).cast("string").alias("id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") + 3).alias("activity"), dates.period("o_orderdate").alias("period"),
        F.concat(F.lit("00"), F.translate(R.dec("o_totalprice").cast("string"), ".", ",")).alias("amount"),
        F.col("o_custkey").alias("tax_no"),
    )


@query(f"WITH {DECLARED} SELECT declaration, period, tax_no, CAST(total AS DOUBLE) AS total, CAST(total * CAST(0.32 AS DECIMAL(3,2)) AS DOUBLE) AS counted FROM decl")
def latest_declaration(spark, sf):
    return rollups.declarations(declared(spark, sf), 199601, 199912, other=["tax_no"])


@query("""SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(17,2)) - 250000) AS DOUBLE) AS value FROM orders WHERE o_orderstatus <> 'P'
    GROUP BY 1 HAVING SUM(CAST(o_totalprice AS DECIMAL(17,2)) - 250000) > 0""")
def positive_totals(spark, sf):
    """Totals of documents that are not annulled, positive ones only."""
    o = R.table(spark, sf, "orders").select(
        "o_custkey", (R.dec("o_totalprice") - 250000).cast("decimal(17,2)").alias("value"),
        F.when(F.col("o_orderstatus") == "P", "x").alias("annulled"),
    )
    return rollups.positive_totals(o, ["o_custkey"], "value", "annulled")


@query("""SELECT o_orderkey AS id, o_totalprice AS total, NULL AS product FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def union_missing(spark, sf):
    """Sources with different columns under one another."""
    o = R.table(spark, sf, "orders")
    a = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"))
    b = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("product"))
    return a.unionByName(b, allowMissingColumns=True)


@query(f"""WITH raw AS (SELECT user_id AS reg, ts, event_type, event_id, value, CAST(floor(value) AS INTEGER) % 4 AS m FROM events),
    act AS (SELECT reg, ts, event_id AS seq, CASE WHEN event_type = 'signup' THEN -1 ELSE 1 END AS activities,
        CASE WHEN CASE WHEN event_type = 'signup' THEN p_size % 7 ELSE m END = 3 THEN CASE WHEN event_type = 'signup' THEN -1 ELSE 1 END END AS rural_activities
        FROM raw LEFT JOIN part ON p_partkey = event_id WHERE event_type IN ('signup', 'error'))
    SELECT reg, {text('ts')} AS "at", 'activity' AS attr, NULL AS old, CAST(activities AS BIGINT) AS activities, CAST(rural_activities AS BIGINT) AS rural_activities FROM act
    UNION ALL SELECT reg, {text('ts')}, 'status', CAST(m AS VARCHAR), NULL, NULL FROM raw WHERE event_type = 'purchase'
    UNION ALL SELECT reg, {text('ts')}, 'muni', CAST(COALESCE(first_value(NULLIF(m, -1) IGNORE NULLS) OVER (PARTITION BY reg ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS VARCHAR),
        NULL, NULL FROM raw WHERE event_type = 'click'""")
def registry_log(spark, sf):
    """Raw registry log to replay rows: status, municipality and activities held."""
    from apportia import constants as K

    e, kind = R.table(spark, sf, "events"), F.col("event_type")
    named = {"signup": K.LOG_ACTIVITY_ADDED, "error": K.LOG_ACTIVITY_REMOVED, "purchase": K.LOG_STATUS, "click": K.LOG_MUNICIPALITY}
    pick = lambda i: F.coalesce(*[F.when(kind == k, F.lit(v[i])) for k, v in named.items()], F.lit("OTHER"))
    raw = e.select(
        F.col("user_id").alias("reg"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), pick(0).alias("table"), pick(1).alias("column"),
        F.when(kind == "error", "D").otherwise("I").alias("kind"), F.col("event_id").cast("string").alias("new"),
        (F.floor("value").cast("int") % 4).cast("string").alias("old"),
    )
    held = R.table(spark, sf, "part").select(F.col("p_partkey").alias("activity_id"), (F.col("p_size") % 7).alias("subclass"))
    rural = spark.range(3, 4).select(F.col("id").cast("string").alias("code"))
    streets = R.table(spark, sf, "nation").select(F.col("n_name").alias("street"), F.col("n_nationkey").alias("muni"))
    none = periods(spark, sf).where("false")
    regimes = history.regime_changes(none, "reg", "start", "stop", "option_no", drop_all=True)
    return history.log_rows(raw, held, rural, streets, regimes).drop("seq")


@query("""SELECT event_type, COUNT(DISTINCT user_id) AS exact, COUNT(*) AS rows, true AS within FROM events
    WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-18' GROUP BY 1""")
def sketched_window(spark, sf):
    """Distinct users of two weeks from sketches kept by day and type: the exact count, and whether the estimate is near it."""
    e = R.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    inside = F.col("day").between("2024-01-05", "2024-01-18")
    kept = rollups.count_sketches(e, ["event_type", "day"], "user_id")
    merged = rollups.sketched_count(kept.where(inside), ["event_type"])
    exact = e.where(inside).groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    error = 5 * 1.04 / 2**7
    return merged.join(exact, "event_type").select(
        "event_type", "exact", "rows", (F.abs(F.col("documents") - F.col("exact")) <= F.lit(error) * F.col("exact")).alias("within")
    )
