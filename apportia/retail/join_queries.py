"""Reference, registry, period and event joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportia.functions import codes
from apportia.operators import joins, rollups, versions
from apportia.plans import loose
from apportia.plans import rules as chain
from apportia.retail import frames as R
from apportia.retail.function_queries import kinds
from apportia.retail.registry import query
from apportia.retail.scan_queries import OPTIONS, option_sources
from apportia.retail.sql import CODES, text, using
from apportia.sources import extracts


@query("""SELECT o_orderkey, c.name AS customer, CAST(l.n AS BIGINT) AS lines, e.last_event FROM orders
    LEFT JOIN (SELECT c_custkey AS o_custkey, c_name AS name FROM customer) c USING (o_custkey)
    LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1) l USING (o_orderkey)
    LEFT JOIN (SELECT user_id AS o_orderkey, MAX(event_id) AS last_event FROM events GROUP BY 1) e USING (o_orderkey)""")
def section_fan_in(spark, sf):
    o = R.table(spark, sf, "orders")
    cust = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer"))
    lines = R.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    events = R.table(spark, sf, "events").groupBy(F.col("user_id").alias("o_orderkey")).agg(F.max("event_id").alias("last_event"))
    out = joins.fan_in(o, [lines, events], ["o_orderkey"])
    return joins.fan_in(out, [cust], ["o_custkey"]).select("o_orderkey", "customer", "lines", "last_event")


@query("""SELECT b.l_orderkey, b.l_linenumber, CAST(b.n AS BIGINT) AS n, x.price, y.qty FROM
    (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) b
    LEFT JOIN (SELECT l_orderkey, l_linenumber, MAX(l_extendedprice) AS price FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2) x USING (l_orderkey, l_linenumber)
    LEFT JOIN (SELECT l_orderkey, l_linenumber, MAX(l_quantity) AS qty FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2) y USING (l_orderkey, l_linenumber)""")
def item_sections(spark, sf):
    line, on = R.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    base = line.groupBy(*on).agg(F.count("*").alias("n"))
    price = line.where("l_returnflag = 'A'").groupBy(*on).agg(F.max("l_extendedprice").alias("price"))
    qty = line.where("l_linestatus = 'O'").groupBy(*on).agg(F.max("l_quantity").alias("qty"))
    return joins.fan_in(base, [price, qty], on)


@query("""SELECT e.event_id, r.event_id AS ref_id, r.value AS ref_value FROM events e LEFT JOIN (SELECT user_id, event_id, value FROM events
    WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) r USING (user_id)""")
def latest_reference(spark, sf):
    """Latest reference row per code, looked up from every event."""
    e = R.table(spark, sf, "events")
    ref = joins.latest_reference(e.where("event_type = 'signup'").select("user_id", "ts", "event_id", "value"), "user_id", "ts", ["event_id"])
    return joins.attach(e.select("event_id", "user_id"), ref, "user_id", "user_id", {"event_id": "ref_id", "value": "ref_value"}).drop("user_id")


@query(using("versions", "purchases", then="""SELECT p.doc_id, v.muni, v.status, v.regime, v.rural FROM purchases p LEFT JOIN versions v
    ON v.reg = p.entry_reg AND v.valid_from <= p.emitted_at AND (v.valid_to IS NULL OR p.emitted_at <= v.valid_to)
    QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY v.valid_from DESC NULLS LAST, v.valid_to DESC NULLS FIRST, v.muni DESC) = 1"""))
def asof_registry(spark, sf):
    """Registry version in force at emission, the latest start first."""
    out = joins.as_of(
        R.purchases(spark, sf), R.versions(spark, sf), {"entry_state": "state", "entry_reg": "reg"}, "emitted_at",
        "valid_from", "valid_to", {"muni": "muni", "status": "status", "regime": "regime", "rural": "rural"}, ["muni"],
    )
    return out.select("doc_id", "muni", "status", "regime", "rural")


@query(using("versions", "purchases", then="""SELECT p.doc_id, v.event_id, v.status FROM purchases p LEFT JOIN versions v ON v.reg = p.entry_reg
    AND v.valid_from <= TIMESTAMP '2024-01-10 00:00:00' AND (v.valid_to IS NULL OR v.valid_to >= TIMESTAMP '2024-01-10 23:59:59')"""))
def window_registry(spark, sf):
    """Registry rows that cover a whole load day; a missing state is the home state."""
    docs = R.purchases(spark, sf).withColumn("entry_state", F.lit(None).cast("string"))
    out = joins.window_registry(
        docs, R.versions(spark, sf), {"entry_state": "state", "entry_reg": "reg"}, "2024-01-10 00:00:00", "2024-01-10 23:59:59",
        "valid_from", "valid_to", {"event_id": "event_id", "status": "status"}, ("entry_state", R.HOME),
    )
    return out.select("doc_id", "event_id", "status")


@query(using("munis", then="""SELECT c_custkey, COALESCE(state, 'NONE') AS state, name FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS code FROM customer)
    LEFT JOIN munis ON muni = code"""))
def muni_enrich(spark, sf):
    c = R.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("code"), F.lit("NONE").alias("doc_state")
    )
    return joins.municipality(c, R.munis(spark, sf), "code", "state", "name", "doc_state").select("c_custkey", "state", "name")


@query(using("items", then=f"SELECT order_key, supplier_key, item_no, part_key, op_code, op_code IN ({CODES}) AS code_participates FROM items"))
def op_code_flag(spark, sf):
    out = joins.participation_flag(R.items(spark, sf), R.codes_frame(spark), "op_code", "code", "code_participates")
    return out.select(*R.DOC, "item_no", "part_key", "op_code", "code_participates")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(f.flag, false) AS product_participates FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 8, '0') AS code, bool_or(p_size > 48) FILTER (p_size > 10) AS flag FROM part GROUP BY 1) f
    ON f.code = lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 8, '0')""")
def product_flag(spark, sf):
    """Product reference with repeated codes: a known flag beats an unknown one."""
    from apportia.plans.references import normalise_codes

    p = R.table(spark, sf, "part")
    size = F.col("p_size")
    ref = p.select(F.col("p_brand").alias("code"), F.when(size > 48, "S").when(size > 10, "N").otherwise("?").alias("participates"))
    items = R.table(spark, sf, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"))
    items = items.withColumn("product", codes.product_code("p_brand"))
    out = chain.flag_codes(items, normalise_codes(ref, codes.product_code, 8), "product", "product_participates")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "product_participates")


COLLAPSED = f"""SELECT CAST(event_id // 3 AS VARCHAR) AS access_key, {text("MAX(CASE WHEN event_type = 'signup' THEN ts END)")} AS cancelled_at,
    bool_or(event_type = 'signup') AS cancelled, bool_or(event_type = 'error') AS substituted, bool_or(event_type = 'click') AS corrected,
    bool_or(event_type = 'view') AS voided, {text('MAX(ts)')} AS last_event_at FROM events GROUP BY 1"""


def collapsed(spark, sf):
    e = R.table(spark, sf, "events").withColumns({"kind": kinds(), "doc": F.floor(F.col("event_id") / 3)})
    return rollups.collapse_events(rollups.classified_events(e, "doc", "kind", "ts"))


@query(COLLAPSED)
def collapse_events(spark, sf):
    return collapsed(spark, sf)


@query(f"""WITH c AS ({COLLAPSED}) SELECT o_orderkey, COALESCE(cancelled, false) AS cancelled, COALESCE(substituted, false) AS substituted, cancelled_at,
    CASE WHEN cancelled THEN 'document cancelled' WHEN substituted THEN 'document substituted' WHEN voided THEN 'document voided' END AS event_reason
    FROM orders LEFT JOIN c ON access_key = CAST(o_orderkey AS VARCHAR)""")
def event_flags(spark, sf):
    docs = R.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("access_key"))
    out = joins.mark_events(docs, collapsed(spark, sf), "access_key")
    return out.select("o_orderkey", "cancelled", "substituted", "cancelled_at", joins.event_reason(out).alias("event_reason"))


@query("""SELECT CAST(user_id AS VARCHAR) AS access_key, bool_or(event_type = 'signup') AS cancelled, bool_or(event_type = 'view') AS substituted,
    bool_or(event_type = 'click') AS corrected, false AS voided FROM events GROUP BY 1""")
def coded_events(spark, sf):
    kind = F.expr("case event_type when 'signup' then '110111' when 'view' then '110165' when 'click' then '110110' end")
    e = R.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("access_key"), kind.alias("kind"))
    return rollups.coded_events(e, "access_key", "kind", ("110165", "110170"), ("110",))


@query("""SELECT o_orderkey, CAST(d AS VARCHAR) AS day, CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS stop, start IS NOT NULL AS in_period
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN
    (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS start, (date_trunc('month', o_orderdate) + INTERVAL 40 DAY)::DATE AS stop FROM orders
     WHERE month(o_orderdate) IN (1, 2, 6)) ON d BETWEEN start AND stop""")
def period_range(spark, sf):
    """Order days inside ledger periods; overlapping periods give two rows."""
    o = R.table(spark, sf, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    periods = o.where(F.month("o_orderdate").isin(1, 2, 6)).select(month.alias("start"), F.date_add(month, 40).alias("stop"))
    docs = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return joins.in_period(docs, periods, "day", "start", "stop")


@query(using("docs", then="SELECT order_key, supplier_key, item_no, part_key FROM items JOIN docs USING (order_key, supplier_key) WHERE reason IS NULL"))
def items_of_participating(spark, sf):
    kept = R.documents(spark, sf).where("reason is null")
    return joins.keep_matching(R.items(spark, sf), kept, R.DOC).select(*R.DOC, "item_no", "part_key")


@query("""SELECT l_orderkey AS note_id, MAX(CASE WHEN l_linestatus = 'F' THEN (l_suppkey, l_partkey) END)[1] AS issuer_reg,
    MAX(CASE WHEN l_linestatus = 'O' THEN (l_suppkey, l_partkey) END)[1] AS recipient_reg FROM lineitem GROUP BY 1""")
def role_self_join(spark, sf):
    """Filled lines name the issuer, open lines the recipient of a note."""
    line = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("note_id"), F.when(F.col("l_linestatus") == "F", 2).otherwise(3).alias("role"),
        F.col("l_suppkey").alias("reg"), F.col("l_partkey").alias("muni"), F.lit("X").alias("state"),
    )
    return loose.roles(line).select("note_id", "issuer_reg", "recipient_reg")


@query("""SELECT o_orderkey AS id, COALESCE(c_nationkey, o_orderkey % 25)::BIGINT AS muni, CASE WHEN c_custkey IS NULL THEN '0' ELSE '1' END AS status,
    CASE WHEN c_custkey IS NULL THEN 'added' ELSE 'known' END AS origin FROM orders LEFT JOIN customer ON c_custkey = o_orderkey""")
def registry_default(spark, sf):
    """Parties the registry does not know get status 0."""
    parties = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 25).alias("muni"))
    reg = R.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("reg"), F.col("c_nationkey").cast("bigint").alias("muni"), F.lit("1").alias("status")
    )
    return joins.registry_or_default(parties, reg, "id", {"status": "0"})


@query(f"""WITH {OPTIONS} SELECT p.event_id AS doc_id, o.option_no FROM events p LEFT JOIN opt o ON o.valid AND o.base = lpad(CAST(p.user_id AS VARCHAR), 8, '0')
    AND p.ts >= o.start AND (o.stop IS NULL OR p.ts <= o.stop + INTERVAL 20 DAY) WHERE p.event_type = 'purchase'""")
def option_range(spark, sf):
    """Option periods, made 20 days longer, at the time of each purchase."""
    options = extracts.option_periods(*option_sources(spark, sf), 20240105, 20240125)
    stop = F.col("stop").cast("timestamp_ntz") + F.expr("INTERVAL 20 DAY")
    docs = R.purchases(spark, sf).withColumn("base", F.lpad(F.col("entry_reg").cast("string"), 8, "0"))
    out = joins.in_option_period(docs, options.withColumn("stop", stop), "base", "emitted_at", {"option_no": "option_no"})
    return out.select("doc_id", "option_no")


def memberships(spark, sf):
    """First sign-up as stored membership, last error as incoming one."""
    e = R.table(spark, sf, "events")
    day = F.to_date("ts").cast("timestamp_ntz")
    stored = e.where("event_type = 'signup'").groupBy("user_id").agg(
        F.min(day).alias("start"), F.max("value").alias("v"), F.max(day).alias("last")
    )
    stored = stored.select(
        "user_id", "start", F.when(F.col("v") > 80, F.col("last")).alias("stop"), F.lit("old").alias("member")
    )
    incoming = e.where("event_type = 'error' and value > 40").groupBy("user_id").agg(F.max(day).alias("start"))
    return stored, incoming.select("user_id", "start", F.lit(None).cast("timestamp_ntz").alias("stop"), F.lit("new").alias("member"))


MEMBERS = """WITH st AS (SELECT user_id, MIN(ts::DATE)::TIMESTAMP AS start, CASE WHEN MAX(value) > 80 THEN MAX(ts::DATE)::TIMESTAMP END AS stop FROM events WHERE event_type = 'signup' GROUP BY 1),
    inc AS (SELECT user_id, MAX(ts::DATE)::TIMESTAMP AS start FROM events WHERE event_type = 'error' AND value > 40 GROUP BY 1),
    m AS (SELECT i.user_id, i.start AS new_start, s.start, s.stop, COALESCE(s.start > i.start, false) OR COALESCE(s.stop > i.start, false) AS backdated
        FROM inc i LEFT JOIN st s USING (user_id))"""


@query(MEMBERS + f""" SELECT user_id, {text('start')} AS start, {text("new_start - INTERVAL 1 SECOND")} AS stop, 'old' AS member, 'close' AS action FROM m
    WHERE NOT backdated AND start IS DISTINCT FROM new_start AND start IS NOT NULL AND stop IS NULL
    UNION ALL SELECT user_id, {text('new_start')}, NULL, 'new', 'insert' FROM m WHERE NOT backdated AND start IS DISTINCT FROM new_start""")
def validity_merge(spark, sf):
    return versions.merge_validity(*memberships(spark, sf), "user_id", "member")[0]


@query(MEMBERS + f" SELECT user_id, {text('new_start')} AS start FROM m WHERE backdated")
def validity_rejected(spark, sf):
    return versions.merge_validity(*memberships(spark, sf), "user_id", "member")[1].select("user_id", "start")


def two_versions(spark, sf):
    """Early and late sign-ups per day as stored and incoming registry tables."""
    e = R.table(spark, sf, "events")
    half = lambda kinds_, value: e.where(F.col("event_type").isin(*kinds_)).groupBy(
        F.col("user_id").alias("reg"), F.to_date("ts").alias("valid_from")
    ).agg(F.max(F.floor(value)).cast("bigint").alias("muni"), F.max(F.when(F.col("value") > 30, "1")).alias("status"))
    return half(("signup", "view"), F.col("value") / 20), half(("signup", "click"), F.col("value") / 20)


TWO = """WITH st AS (SELECT user_id AS reg, ts::DATE AS valid_from, CAST(MAX(floor(value / 20)) AS BIGINT) AS muni, MAX(CASE WHEN value > 30 THEN '1' END) AS status
    FROM events WHERE event_type IN ('signup', 'view') GROUP BY 1, 2),
    inc AS (SELECT user_id AS reg, ts::DATE AS valid_from, CAST(MAX(floor(value / 20)) AS BIGINT) AS muni, MAX(CASE WHEN value > 30 THEN '1' END) AS status
    FROM events WHERE event_type IN ('signup', 'click') GROUP BY 1, 2)"""
KEYS, VALUES = ["reg", "valid_from"], ["muni", "status"]


@query(TWO + " SELECT i.reg, CAST(i.valid_from AS VARCHAR) AS valid_from, i.muni, i.status FROM inc i ANTI JOIN st USING (reg, valid_from)")
def new_rows(spark, sf):
    return versions.new_rows(*two_versions(spark, sf), KEYS)


@query(TWO + " SELECT s.reg, CAST(s.valid_from AS VARCHAR) AS valid_from, s.muni, s.status FROM st s ANTI JOIN inc USING (reg, valid_from)")
def gone_rows(spark, sf):
    return versions.gone_rows(*two_versions(spark, sf), KEYS)


@query(TWO + """ SELECT i.reg, CAST(i.valid_from AS VARCHAR) AS valid_from, i.muni, i.status FROM inc i JOIN st s USING (reg, valid_from)
    WHERE i.muni IS DISTINCT FROM s.muni OR i.status IS DISTINCT FROM s.status""")
def changed_versions(spark, sf):
    return versions.changed_rows(*two_versions(spark, sf), KEYS, VALUES)


@query(TWO + """ SELECT * FROM (SELECT COALESCE(i.reg, s.reg) AS reg, CAST(COALESCE(i.valid_from, s.valid_from) AS VARCHAR) AS valid_from,
    CASE WHEN i.reg IS NULL THEN s.muni ELSE i.muni END AS muni, CASE WHEN i.reg IS NULL THEN s.status ELSE i.status END AS status,
    CASE WHEN s.reg IS NULL THEN 'added' WHEN i.reg IS NULL THEN 'removed'
        WHEN i.muni IS DISTINCT FROM s.muni OR i.status IS DISTINCT FROM s.status THEN 'changed' END AS action
    FROM st s FULL OUTER JOIN inc i ON s.reg = i.reg AND s.valid_from = i.valid_from) WHERE action IS NOT NULL""")
def version_diff(spark, sf):
    return versions.difference(*two_versions(spark, sf), KEYS, VALUES)


@query(TWO + " SELECT reg, CAST(valid_from AS VARCHAR) AS valid_from, muni, status FROM inc")
def version_apply(spark, sf):
    """Stored table after the difference equals the incoming one."""
    stored, incoming = two_versions(spark, sf)
    return versions.apply_difference(stored, versions.difference(stored, incoming, KEYS, VALUES), KEYS)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, f.id AS product_id, c_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 8, '0') AS code, MAX(p_partkey) AS id FROM part WHERE p_size > 45 GROUP BY 1) f
        ON f.code = lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 8, '0')
    LEFT JOIN customer ON c_custkey = l_suppkey""")
def batch_lookups(spark, sf):
    """Product id among valid references, and a party lookup."""
    p = R.table(spark, sf, "part")
    ref = p.select(
        F.col("p_partkey").alias("id"), codes.product_code("p_brand").alias("code"), F.lit("2020-01-01").cast("date").alias("start"),
        F.when(F.col("p_size") <= 45, F.lit("2020-06-30").cast("date")).alias("stop"),
    )
    items = R.table(spark, sf, "lineitem").join(p.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    out = joins.product_id(items, ref, "p_brand", "2020-03-01", "2020-12-31")
    out = joins.attach(out, R.table(spark, sf, "customer"), "l_suppkey", "c_custkey", {"c_name": "name"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "product_id", "name")
