"""The study of simplified-regime taxpayers: its rows, and what of it meets at the driver."""

from datetime import datetime as T

from apportia.plans import reports

KEYS = "access_key string, doc_type int, "


def gathered(df):
    """What the plan would gather by the driver, a text for each broadcast."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [next((i for i, c in enumerate(x) if c.isalpha()), 0) for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i:end])


def test_regime_study_lists_its_registry_on_executors(spark, tmp_path):
    def put(name, rows, ddl):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    docs = put("docs", [
        ("a", 10, 199605, None, 1, "00000001000155", T(1996, 5, 2), 5, 1, 0.0), ("b", 10, 199705, None, 1, "00000001000155", T(1997, 5, 2), 5, 1, 0.0),
        ("c", 10, 199705, 10, 1, "00000001000155", T(1997, 5, 2), 5, 1, 0.0), ("d", 10, 199706, None, 1, "00000002000155", T(1997, 6, 2), 5, 2, 0.0),
        ("e", 10, 199706, None, 1, "00000003000155", T(1997, 6, 2), 6, 3, 0.0),
    ], KEYS + "period int, reason int, direction int, tax_no string, emitted_at timestamp, federal_code int, party_reg bigint, value_added double")
    items = put("items", [(k, 10, None, "5101", v) for k, v in (("a", 1.0), ("b", 2.0), ("b", 3.0), ("c", 9.0), ("d", 4.0), ("e", 7.0))]
                + [("b", 10, 1, "5101", 8.0), ("b", 10, None, "1949", 8.0)], KEYS + "reason int, op_code string, value_added double")
    options = put("options", [(f"0000000{i}", i + 100, True, T(1996, 1, 1), None) for i in (1, 2, 3)], "base string, reg int, valid boolean, start timestamp, stop timestamp")
    registry = put("registry", [
        ("GO", 1, "3", 7, T(1990, 1, 1), T(1996, 12, 31)), ("GO", 1, "4", 8, T(1997, 1, 1), None), ("GO", 2, "2", 7, T(1990, 1, 1), None),
    ], "state string, reg bigint, regime string, muni int, valid_from timestamp, valid_to timestamp")
    munis = put("munis", [(5, 7), (6, -1)], "federal_code int, muni int")
    out = reports.regime_study(docs, items, options, registry, munis, "exit", (5101,), (199601, 200012), 7)
    assert not [x for x in gathered(out) if "sequence(" in x]
    # d: in a normal regime; c: cancelled; e: not in the registry and of another municipality.
    found = {(r["access_key"], r["known_muni"], r["option_reg"], r["value_added"]) for r in out.collect()}
    assert found == {("a", 7, 101, 1.0), ("b", 8, 101, 5.0)}
