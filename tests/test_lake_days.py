"""The daily tables of the written lake have a row for each day, not for each month."""

from __future__ import annotations

import datetime as dt

from orderlake.plans import lake_queries as L


def tables(spark, folder):
    """Three orders on three days of one month and one of the next, two lines each, shipped before and after the cutover."""
    day = [dt.datetime(1998, 5, 3), dt.datetime(1998, 5, 4), dt.datetime(1998, 5, 30), dt.datetime(1998, 7, 1)]
    rows = {
        "nation": ([(1, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(7, "c7", 1, 0.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(k, f"part {k}", "b", "t", 5, 10.0 * k) for k in (1, 2)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, 7, "O", 1.0, d, "2-HIGH") for k, d in enumerate(day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(k, p, 1, p, float(k + 1), 1.0, 0.1, 0.1, "N", "O", dt.datetime(1998, 4 + 2 * p, 9)) for k in range(4) for p in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return [d.date() for d in day]


def test_daily_tables_have_every_day(spark, lake_root):
    days = tables(spark, lake_root)
    sales = {r.event_date: (r.invoice_count, r.line_count, r.net_units, float(r.net_revenue)) for r in L.QUERIES["lake_gold_daily_sales"](spark, lake_root).collect()}
    assert sales == {d: (1, 2, 2 * (k + 1), 30.0 * (k + 1)) for k, d in enumerate(days)}
    trend = L.QUERIES["catalog_daily_trend"](spark, lake_root).orderBy("row_num").collect()
    assert [(r.row_num, r.event_date, r.net_revenue) for r in trend] == [(k + 1, d, 30.0 * (k + 1)) for k, d in enumerate(days)]
