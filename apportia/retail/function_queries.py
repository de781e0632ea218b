"""Codes, dates, money and row rules on table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, params, rules
from apportia.operators import rollups
from apportia.retail import frames as R
from apportia.retail.registry import query
from apportia.retail.sql import text, using

DIG = "regexp_replace({}, '[^0-9]', '', 'g')"
CODE_TEXT = "CASE p_type WHEN 'ECONOMY' THEN ' ' || (p_partkey % 900 + 100) WHEN 'SMALL' THEN (p_partkey + 10000) || '-x' ELSE p_brand || '.' || (p_size + 5100) END"
CODE_DIGITS = DIG.format(CODE_TEXT)


@query(f"""SELECT p_partkey, {DIG.format('p_brand')} AS digits,
    CASE WHEN length({CODE_DIGITS}) = 3 THEN '0' || {CODE_DIGITS} ELSE substr({CODE_DIGITS}, 1, 4) END AS op_code,
    CASE WHEN length({CODE_DIGITS}) >= 8 THEN substr({CODE_DIGITS}, 1, 8) ELSE lpad({CODE_DIGITS}, 8, '0') END AS product_code,
    CAST(TRY_CAST(substr({DIG.format("p_brand || p_size || '0000000'")}, 1, 6) AS INTEGER) AS INTEGER) AS muni_6,
    COALESCE(CAST(TRY_CAST('00' || p_size AS BIGINT) AS VARCHAR), p_name) AS muni, substr(trim(p_name), 1, 5) AS short
    FROM part""")
def norm_codes(spark, sf):
    p = R.table(spark, sf, "part")
    kind = F.col("p_type")
    raw = (
        F.when(kind == "ECONOMY", F.concat(F.lit(" "), F.col("p_partkey") % 900 + 100))
        .when(kind == "SMALL", F.concat(F.col("p_partkey") + 10000, F.lit("-x")))
        .otherwise(F.concat("p_brand", F.lit("."), F.col("p_size") + 5100))
    )
    return p.select(
        "p_partkey", codes.digits_only("p_brand").alias("digits"), codes.op_code(raw).alias("op_code"),
        codes.product_code(raw).alias("product_code"),
        codes.muni_number(F.concat("p_brand", "p_size", F.lit("0000000")), 6).alias("muni_6"),
        codes.muni_text(F.concat(F.lit("00"), "p_size")).alias("muni"), codes.text("p_name", 5).alias("short"),
    )


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS flag FROM orders""")
def text_flags(spark, sf):
    s, p = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    yes = F.when(p == "1", " sim ").when(p == "2", "S").when(p == "3", "1").when(p == "4", "true").otherwise("y")
    no = F.when(p == "1", "nao").when(p == "2", "N").when(p == "3", "0").when(p == "4", " False").otherwise("NÃO")
    raw = F.when(s == "O", yes).when(s == "F", no).otherwise("maybe")
    return R.table(spark, sf, "orders").select("o_orderkey", codes.flag(raw).alias("flag"))


STATES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.STATE_BY_CODE.items())


@query(f"SELECT p_partkey, CASE p_size + 5 {STATES} END AS state FROM part")
def state_codes(spark, sf):
    return R.table(spark, sf, "part").select("p_partkey", codes.state_of(F.col("p_size") + 5).alias("state"))


LAYOUT = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '%Y-%m-%d' WHEN '2' THEN '%d%m%Y' WHEN '3' THEN '%Y%m%d' WHEN '4' THEN '%d/%m/%Y' ELSE '%Y.%m' END"


@query(f"""SELECT o_orderkey, CAST(COALESCE(TRY_STRPTIME(t, '%Y-%m-%d'), TRY_STRPTIME(t, '%d%m%Y'), TRY_STRPTIME(t, '%Y%m%d'),
    TRY_STRPTIME(t, '%d/%m/%Y'))::DATE AS VARCHAR) AS day FROM (SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1)
    WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '2' THEN strftime(o_orderdate, '%d%m%Y') WHEN '3' THEN strftime(o_orderdate, '%Y%m%d')
    WHEN '4' THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y.%m') END AS t FROM orders)""")
def parse_dates(spark, sf):
    """Dates written in the four ledger layouts, and one that is not a date."""
    p, d = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    raw = (
        F.when(p == "1", F.date_format(d, "yyyy-MM-dd")).when(p == "2", F.date_format(d, "ddMMyyyy"))
        .when(p == "3", F.date_format(d, "yyyyMMdd")).when(p == "4", F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "yyyy.MM"))
    )
    return R.table(spark, sf, "orders").select("o_orderkey", dates.parse_ledger_date(raw).alias("day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def coerce_dates(spark, sf):
    """Epoch seconds, epoch milliseconds, 14 digits, 8 digits and text that is no date."""
    p, d = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    epoch = F.unix_timestamp(d.cast("timestamp"))
    raw = (
        F.when(p == "1", epoch.cast("string")).when(p == "2", F.concat(epoch.cast("string"), F.lit("000")))
        .when(p == "3", F.date_format(d, "yyyyMMddHHmmss")).when(p == "4", F.date_format(d, "yyyyMMdd"))
        .otherwise("soon")
    )
    # Milliseconds keep 13 digits: dates before 2001-09-09 have a 9-digit epoch.
    raw = F.when((p == "2") & (F.length(raw) < 13), F.lpad(raw, 13, "0")).otherwise(raw)
    return R.table(spark, sf, "orders").select("o_orderkey", dates.coerce_date(raw).alias("day"))


@query("""SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN NULL ELSE v END AS DOUBLE) AS value,
    CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN v * 100 WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE v END AS DOUBLE) AS file_value
    FROM (SELECT *, CAST(c_acctbal AS DECIMAL(17,2)) AS v FROM customer)""")
def parse_money(spark, sf):
    """Grouped and decimal commas, currency signs, empty text."""
    v = R.dec("c_acctbal")
    plain = v.cast("string")
    grouped = F.translate(F.format_number(v, 2), ",.", ".,")
    seg = F.col("c_mktsegment")
    raw = (
        F.when((seg == "FURNITURE") & (F.abs(v) >= 1000), F.concat(F.lit("R$ "), grouped))
        .when(seg == "HOUSEHOLD", F.regexp_replace(plain, r"\.", ","))
        .when(seg == "BUILDING", " ").when(seg == "MACHINERY", F.concat(F.lit("$"), plain)).otherwise(plain)
    )
    return R.table(spark, sf, "customer").select(
        "c_custkey", codes.money(raw).alias("value"), codes.money(raw, "thousands").alias("file_value")
    )


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0')
    ELSE lpad(CAST(c_custkey + 1000000 AS VARCHAR) || '000155', 14, '0') END AS tax_no, CAST(c_custkey AS DOUBLE) AS reg FROM customer""")
def tax_numbers(spark, sf):
    """Company number first, person number otherwise, filled by length."""
    company = F.when(F.col("c_acctbal") >= 0, F.concat((F.col("c_custkey") + 1000000).cast("string"), F.lit("/0001-55")))
    return R.table(spark, sf, "customer").select(
        "c_custkey", codes.padded_tax_number(codes.tax_number(company, F.col("c_custkey").cast("string"))).alias("tax_no"),
        codes.registration(F.concat(F.lit("IE-"), "c_custkey")).alias("reg"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END || '|55|' || substr(o_orderpriority, 1, 1) || '|' || o_orderkey
    || '|' || strftime(o_orderdate, '%Y-%m-%d') AS doc_key FROM orders""")
def ledger_keys(spark, sf):
    tax = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), "o_custkey"))
    day = dates.parse_ledger_date(F.date_format("o_orderdate", "ddMMyyyy"))
    key = codes.ledger_key(tax, F.lit("55 "), F.substring("o_orderpriority", 1, 1), F.col("o_orderkey"), day)
    return R.table(spark, sf, "orders").select("o_orderkey", key.alias("doc_key"))


@query(f"""SELECT o_orderkey, CAST((date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::DATE AS VARCHAR) AS next_month,
    CAST(last_day(o_orderdate) AS VARCHAR) AS month_end, {text("o_orderdate + INTERVAL 45 DAY + INTERVAL 30 SECOND")} AS later,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS month_start FROM orders""")
def month_helpers(spark, sf):
    d = F.col("o_orderdate")
    return R.table(spark, sf, "orders").select(
        "o_orderkey", dates.next_month_start(d).alias("next_month"), dates.month_end(d).alias("month_end"),
        dates.add_days(d, 45, 30).alias("later"), dates.period(d).alias("period"),
        dates.period_start(dates.period(d)).alias("month_start"),
    )


@query("""SELECT p_partkey, id, CAST(substr(id, 1, 8) AS BIGINT) AS base, substr(id, 1, 14) AS batch_key, CAST(substr(id, 15) AS BIGINT) AS sequence
    FROM (SELECT p_partkey, lpad(CAST(p_partkey * 1000 + p_size AS VARCHAR), 17, '0') AS id FROM part)""")
def declaration_ids(spark, sf):
    p = R.table(spark, sf, "part").withColumn("d", codes.declaration_id(F.col("p_partkey") * 1000 + F.col("p_size")))
    return p.select("p_partkey", "d.*")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Entry' WHEN 'F' THEN 'Exit' ELSE 'Entry and exit' END AS appropriation,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Normal' WHEN '2' THEN 'Complementary' WHEN '3' THEN 'Adjustment' WHEN '4' THEN 'Return' ELSE 'Unknown' END AS purpose,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Internal' WHEN '2' THEN 'Interstate' WHEN '3' THEN 'Foreign' ELSE 'Unknown' END AS destination,
    CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'Complementary' WHEN '5' THEN 'Return' ELSE 'Normal' END AS loose_purpose,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'operation code not participating' WHEN '2' THEN 'energy class not participating'
        WHEN '3' THEN 'fixed asset' WHEN '4' THEN 'duplicate operation' END AS reason_text FROM orders""")
def labels(spark, sf):
    p = F.substring("o_orderpriority", 1, 1).cast("int")
    a = F.when(F.col("o_orderstatus") == "O", "E").when(F.col("o_orderstatus") == "F", "S").otherwise("A")
    return R.table(spark, sf, "orders").select(
        "o_orderkey", rules.appropriation_label(a).alias("appropriation"), rules.purpose_label(p).alias("purpose"),
        rules.loose_destination_label(p).alias("destination"), rules.loose_purpose_label(p).alias("loose_purpose"),
        rules.reason_text(p).alias("reason_text"),
    )


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'F' THEN '3' ELSE '0' END AS status,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '1' WHEN '3' THEN '4' WHEN '4' THEN '5' ELSE '2' END AS regime FROM orders""")
def status_regime_codes(spark, sf):
    s, p = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    status = F.when(s == "O", "Ativo").when(s == "F", "Baixado").otherwise("?")
    regime = F.when(p == "1", "Microempresa").when(p == "2", "Normal").when(p == "3", "Simples Nacional/SIMEI").when(
        p == "4", "Simples Nacional/Normal"
    )
    return R.table(spark, sf, "orders").select(
        "o_orderkey", codes.status_code(status).alias("status"), codes.regime_code(regime).alias("regime")
    )


@query(using("items", then="""SELECT order_key, supplier_key, item_no, part_key, CAST(CASE WHEN item_no = 7 THEN 1
    ELSE gross + CAST(quantity AS DECIMAL(17,2)) + ipi - discount END AS DOUBLE) AS value,
    CAST(CASE WHEN substr(op_code, 3) IN ('01', '02') THEN gross + ipi - discount ELSE 0 END AS DOUBLE) AS counted FROM items"""))
def item_value(spark, sf):
    """Item value, or the given one, and what counts of it."""
    i = R.items(spark, sf)
    given = F.when(F.col("item_no") == 7, F.lit(1).cast("decimal(17,2)"))
    return i.select(
        *R.DOC, "item_no", "part_key",
        rules.item_value("gross", freight="quantity", ipi="ipi", discount="discount", given=given).alias("value"),
        rules.value_or_zero(
            rules.item_value("gross", ipi="ipi", discount="discount"), F.substring("op_code", 3, 2).isin("01", "02")
        ).alias("counted"),
    )


@query(using("items", then="""SELECT order_key, supplier_key, item_no, part_key, CAST(gross - discount + CASE WHEN item_no IN (3, 4) THEN ipi + CAST(quantity AS DECIMAL(17,2))
    ELSE 0 END AS DOUBLE) AS value FROM items"""))
def fuel_value(spark, sf):
    return R.items(spark, sf).select(
        *R.DOC, "item_no", "part_key",
        rules.fuel_item_value(
            (F.col("item_no") * 10 + 2).cast("string"), "gross", "discount", substituted="ipi", retained="quantity"
        ).alias("value"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN 'ICMS40_41_50' WHEN l_returnflag = 'A' THEN 'ICMS30'
    WHEN l_linestatus = 'O' THEN 'ICMS70' WHEN l_linenumber = 2 THEN 'ICMS90' WHEN l_tax > 0 THEN 'ICMS20' END AS source,
    CAST(CAST(l_quantity AS DECIMAL(17,2)) * 2 AS DOUBLE) AS substituted FROM lineitem""")
def waiver_source(spark, sf):
    """Waiver group by precedence, and substituted tax summed over its groups."""
    why = {
        "ICMS40_41_50": F.when(F.col("l_linenumber") == 1, "x"), "ICMS30": F.when(F.col("l_returnflag") == "A", "x"),
        "ICMS70": F.when(F.col("l_linestatus") == "O", "x"), "ICMS90": F.when(F.col("l_linenumber") == 2, "x"),
        "ICMS20": F.when(F.col("l_tax") > 0, "x"),
    }
    return R.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rules.waiver_source(why).alias("source"),
        rules.total("l_quantity", None, "l_quantity", F.lit(None)).alias("substituted"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(CASE WHEN l_tax <> 0 AND l_discount <> 0 THEN CAST(l_extendedprice AS DECIMAL(17,2)) + CAST(l_quantity AS DECIMAL(17,2)) ELSE 0 END AS DOUBLE) AS telecom,
    CAST(CAST(l_quantity AS DECIMAL(17,2)) * (CASE WHEN l_linestatus = 'O' THEN -1 ELSE 1 END) * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS DOUBLE) AS energy,
    CAST(CAST(l_extendedprice AS DECIMAL(17,2)) - CAST(l_quantity AS DECIMAL(17,2)) AS DOUBLE) AS discount FROM lineitem""")
def sector_values(spark, sf):
    """Telecom base rule, energy sign flips and transport discount."""
    base = F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).otherwise(0)
    return R.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rules.telecom_value("l_tax", base, "l_quantity").alias("telecom"),
        rules.energy_value(
            "l_quantity", F.when(F.col("l_linestatus") == "O", "S").otherwise("E"), F.when(F.col("l_returnflag") == "R", "1")
        ).alias("energy"),
        rules.transport_discount("l_extendedprice", "l_quantity").alias("discount"),
    )


@query(using("customers", then="""SELECT id, CASE WHEN rural THEN 'RURAL' WHEN status <> '1' THEN 'UNREGISTERED' WHEN regime IN ('1', '2') THEN 'NORMAL'
    WHEN regime IN ('3', '4', '5') THEN 'SIMPLIFIED' ELSE 'UNREGISTERED' END AS class FROM customers"""))
def taxpayer_class(spark, sf):
    return R.customers(spark, sf).select("id", rules.taxpayer_class("rural", "status", "regime").alias("class"))


@query(using("heads", then="""SELECT order_key, supplier_key, CASE WHEN entry_ok AND exit_ok THEN 'A' WHEN entry_ok THEN 'E' WHEN exit_ok THEN 'S'
    ELSE 'N' END AS appropriation, parties_out FROM heads"""))
def appropriation_cases(spark, sf):
    from apportia.plans import invoices

    rolled = invoices.roll_items(R.net_items(spark, sf), R.codes_frame(spark), R.DOC)
    entry = ("entry_status", "entry_regime", "entry_rural")
    exit_ = ("exit_status", "exit_regime", "exit_rural")
    return R.with_headers(spark, sf, rolled).select(
        *R.DOC, rules.appropriation(entry, exit_).alias("appropriation"),
        rules.both_parties_out(entry[:2], exit_[:2]).alias("parties_out"),
    )


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 10 WHEN o_orderpriority = '1-URGENT' THEN 13
    WHEN o_orderpriority = '2-HIGH' AND o_totalprice < 200000 THEN 12 END AS INTEGER) AS reason,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 10 WHEN o_orderpriority = '1-URGENT' THEN 14 WHEN o_orderpriority = '2-HIGH' THEN 4 END AS INTEGER) AS ticket_reason FROM orders""")
def exclusion_reason(spark, sf):
    p = F.col("o_orderpriority")
    cancelled, urgent = F.col("o_orderstatus") == "P", p == "1-URGENT"
    return R.table(spark, sf, "orders").select(
        "o_orderkey", rules.document_reason(cancelled, urgent, p != "2-HIGH", F.col("o_totalprice") >= 200000).alias("reason"),
        rules.ticket_reason(cancelled, urgent, F.when(p == "2-HIGH", 4).otherwise(0)).alias("ticket_reason"),
    )


KIND = """CASE event_type WHEN 'signup' THEN ' 110111' WHEN 'click' THEN 'Carta de Correcao' WHEN 'view' THEN '110112 - x' WHEN 'error' THEN 'doc substituido' ELSE 'paid' END"""


def kinds():
    e = F.col("event_type")
    return (
        F.when(e == "signup", " 110111").when(e == "click", "Carta de Correcao").when(e == "view", "110112 - x")
        .when(e == "error", "doc substituido").otherwise("paid")
    )


@query(f"""SELECT CAST(user_id AS VARCHAR) AS access_key, {text('ts')} AS at, event_type = 'signup' AS cancelled, event_type = 'error' AS substituted,
    event_type = 'click' AS corrected, event_type = 'view' AS voided FROM events""")
def event_types(spark, sf):
    """Event kind by code or by words."""
    e = R.table(spark, sf, "events").withColumn("kind", kinds())
    return rollups.classified_events(e, "user_id", "kind", "ts").select("access_key", "at", *[c.alias(k) for k, c in rollups.kind_flags().items()])


@query("""SELECT o_orderkey, CASE WHEN CAST(o_orderkey AS VARCHAR) LIKE '52%' THEN 10 ELSE 2 END AS doc_type FROM orders""")
def issued_or_received(spark, sf):
    home = codes.issued_at_home(F.col("o_orderkey").cast("string"))
    return R.table(spark, sf, "orders").select(
        "o_orderkey", F.when(home, K.ISSUED_INVOICE).otherwise(K.RECEIVED_INVOICE).alias("doc_type")
    )


@query("""SELECT name, value, CASE value WHEN 'sim' THEN true WHEN 'f' THEN false END AS as_bool, TRY_CAST(value AS BIGINT) AS as_int,
    TRY_CAST(replace(value, ',', '.') AS DOUBLE) AS as_float FROM (SELECT 'U' || user_id AS name,
    MAX(CASE event_type WHEN 'signup' THEN 'sim' WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'error' THEN replace(CAST(CAST(value AS DECIMAL(9,2)) AS VARCHAR), '.', ',')
        WHEN 'view' THEN 'f' END) AS value FROM events GROUP BY 1)""")
def typed_params(spark, sf):
    e = F.col("event_type")
    value = (
        F.when(e == "signup", "sim ").when(e == "click", F.concat(F.lit(" "), "user_id"))
        .when(e == "error", F.regexp_replace(F.col("value").cast("decimal(9,2)").cast("string"), r"\.", ","))
        .when(e == "view", "f").otherwise("")
    )
    rows = R.table(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias("name"), value.alias("value"))
    return params.typed(rows).drop("as_list")
