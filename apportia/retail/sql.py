"""The retail frames as common table expressions of the comparison SQL."""

from __future__ import annotations

from apportia.retail.frames import COUNTED_CODES, HOME, OP_SUFFIX, SUPPLIER_BASE

CODES = ", ".join(f"'{c}'" for c in COUNTED_CODES)
SUFFIX = " ".join(f"WHEN '{t}' THEN '{s}'" for t, s in OP_SUFFIX.items())

PARTS = {
    "munis": """SELECT n_nationkey AS muni, CASE WHEN n_nationkey >= 20 THEN n_nationkey - 5 END AS parent,
        r_name AS state, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """SELECT c_custkey AS id, c_custkey AS reg, c_nationkey AS muni,
        CASE WHEN c_acctbal >= 0 THEN '1' ELSE '3' END AS status,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '4' WHEN 'BUILDING' THEN '3' ELSE '2' END AS regime,
        c_mktsegment IN ('FURNITURE', 'BUILDING') AS rural FROM customer""",
    "suppliers": f"""SELECT s_suppkey AS supplier_key, s_suppkey + {SUPPLIER_BASE} AS id,
        s_suppkey + {SUPPLIER_BASE} AS reg, s_nationkey AS muni,
        CASE WHEN s_acctbal >= 0 THEN '1' ELSE '3' END AS status,
        CASE WHEN s_acctbal > 7000 THEN '5' ELSE '2' END AS regime,
        s_acctbal BETWEEN 8000 AND 9000 AS rural FROM supplier""",
    "registry": """SELECT p.*, m.state FROM (SELECT id, reg, muni, status, regime, rural FROM customers
        UNION ALL SELECT id, reg, muni, status, regime, rural FROM suppliers) p JOIN munis m USING (muni)""",
    "items": f"""SELECT *, gross - discount AS value_added FROM (
        SELECT l_orderkey AS order_key, l_suppkey AS supplier_key, l_linenumber AS item_no, l_partkey AS part_key,
        (CASE WHEN l_linestatus = 'O' THEN '5' ELSE '1' END) || (CASE p_type {SUFFIX} END) AS op_code,
        p_brand AS product_code, CAST(l_quantity AS DECIMAL(19,4)) AS quantity,
        CAST(l_extendedprice AS DECIMAL(17,2)) AS gross,
        CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(17,2)) AS discount,
        CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(17,2)) AS ipi,
        l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS shipped_at
        FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "split": f"""SELECT order_key, supplier_key,
        SUM(CASE WHEN op_code IN ({CODES}) THEN value_added ELSE 0 END) AS value_in,
        SUM(CASE WHEN op_code IN ({CODES}) THEN 0 ELSE value_added END) AS value_out
        FROM items GROUP BY 1, 2""",
    "heads": """SELECT s.*, o_custkey AS entry_id, o_orderdate AS emitted_at, o_orderstatus = 'P' AS cancelled,
        c.reg AS entry_reg, c.muni AS entry_muni, c.status AS entry_status, c.regime AS entry_regime, c.rural AS entry_rural,
        x.id AS exit_id, x.reg AS exit_reg, x.muni AS exit_muni, x.status AS exit_status, x.regime AS exit_regime,
        x.rural AS exit_rural,
        c.status = '1' AND (c.regime NOT IN ('3', '4', '5') OR c.rural) AS entry_ok,
        x.status = '1' AND (x.regime NOT IN ('3', '4', '5') OR x.rural) AS exit_ok,
        (c.status <> '1' OR c.regime IN ('3', '4', '5')) AND (x.status <> '1' OR x.regime IN ('3', '4', '5')) AS parties_out,
        CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
        CASE WHEN year(o_orderdate) < 1998 THEN 10 ELSE 2 END AS doc_type
        FROM split s JOIN orders ON o_orderkey = order_key JOIN customers c ON c.id = o_custkey
        JOIN suppliers x USING (supplier_key)""",
    "docs": """SELECT * REPLACE (CASE WHEN cancelled OR parties_out THEN value_in + value_out ELSE value_out END AS value_out),
        CASE WHEN cancelled OR parties_out THEN 0 ELSE value_in END AS value_added,
        CASE WHEN NOT (cancelled OR parties_out) AND value_in <> 0 THEN NULL WHEN parties_out THEN 11
             WHEN cancelled THEN 10 ELSE 12 END AS reason,
        CASE WHEN entry_ok AND exit_ok THEN 'A' WHEN entry_ok THEN 'E' WHEN exit_ok THEN 'S' ELSE 'N' END AS appropriation
        FROM heads""",
    "va": f"""SELECT doc_type, period, direction, reg, muni, SUM(v) AS value_added FROM (
        SELECT doc_type, period, 'S' AS direction, COALESCE(r.reg, 0) AS reg, COALESCE(r.muni, d.exit_muni) AS muni,
            d.value_added AS v, COALESCE(r.state, m.state) AS state
        FROM docs d LEFT JOIN registry r ON r.id = d.exit_id LEFT JOIN munis m ON m.muni = d.exit_muni
        WHERE reason IS NULL AND appropriation IN ('A', 'S')
        UNION ALL
        SELECT doc_type, period, 'E', COALESCE(r.reg, 0), COALESCE(r.muni, d.entry_muni), d.value_added,
            COALESCE(r.state, m.state)
        FROM docs d LEFT JOIN registry r ON r.id = d.entry_id LEFT JOIN munis m ON m.muni = d.entry_muni
        WHERE reason IS NULL AND appropriation IN ('A', 'E')) WHERE state = '{HOME}' GROUP BY 1, 2, 3, 4, 5""",
    "versions": f"""SELECT user_id AS reg, '{HOME}' AS state, ts AS valid_from,
        CASE WHEN floor(value) > 0 THEN ts + to_hours(CAST(floor(value) AS INTEGER)) END AS valid_to,
        CAST(floor(value) AS INTEGER) % 25 AS muni, CASE WHEN floor(value) < 10 THEN '1' ELSE '3' END AS status,
        CASE WHEN CAST(floor(value) AS INTEGER) % 2 = 0 THEN '2' ELSE '4' END AS regime,
        CAST(floor(value) AS INTEGER) % 3 = 0 AS rural, event_id
        FROM events WHERE event_type = 'signup'""",
    "purchases": f"""SELECT event_id AS doc_id, user_id AS entry_reg, '{HOME}' AS entry_state, ts AS emitted_at,
        CAST(value AS DECIMAL(17,2)) AS total FROM events WHERE event_type = 'purchase'""",
    "change_log": """SELECT user_id AS reg, ts AS "at",
        CASE event_type WHEN 'signup' THEN 'status' WHEN 'click' THEN 'regime' WHEN 'view' THEN 'muni' ELSE 'activity' END AS attr,
        CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS old, event_id AS seq,
        CASE WHEN event_type = 'error' THEN CASE WHEN value < 15 THEN 1 ELSE -1 END END AS activities,
        CASE WHEN event_type = 'error' AND value < 5 THEN 1 END AS rural_activities
        FROM events WHERE event_type <> 'purchase'""",
}

NEEDS = {
    "registry": ("munis", "customers", "suppliers"), "split": ("items",), "heads": ("split", "customers", "suppliers"),
    "docs": ("heads",), "va": ("docs", "registry"),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for n in names:
        out += [m for m in _closure(NEEDS.get(n, ())) if m not in out]
        if n not in out:
            out.append(n)
    return out


def using(*names: str, then: str) -> str:
    """Query text preceded by the named expressions and those they need."""
    ctes = ", ".join(f"{n} AS ({PARTS[n]})" for n in _closure(names))
    # Further expressions of the query itself continue the list.
    if then.lstrip().startswith(","):
        return f"WITH {ctes}{then}"
    return f"WITH {ctes} {then}" if ctes else then


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
