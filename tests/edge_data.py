"""A small TPC-H-shaped data set full of edge cases (NULL and unknown
statuses, NULL and dangling keys, duplicate e-mails, orders without lines,
duplicate lines, returns, every discount and stock band), written as Parquet
with the same column types as the driver's tables.  Used to run every query
against its oracle where the clean test data cannot reach the NULL rules."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq


def write_edge_tables(out_dir: str, seed: int = 11) -> None:
    rnd = random.Random(seed)
    region = pa.table({"r_regionkey": pa.array([0, 1, 2], pa.int32()),
                       "r_name": ["ASIA", "EUROPE", "AMERICA"]})
    nation = pa.table({"n_nationkey": pa.array([0, 1, 2, 3, 4], pa.int32()),
                       "n_name": ["INDIA", "FRANCE", "BRAZIL", "JAPAN", "ATLANTIS"],
                       "n_regionkey": pa.array([0, 1, 2, 0, 9], pa.int32())})  # 9: no region
    segs = ["BUILDING", "MACHINERY", "HOUSEHOLD", None]
    cust = {"c_custkey": [], "c_name": [], "c_nationkey": [], "c_acctbal": [], "c_mktsegment": []}
    for k in range(1, 41):
        name = f"Customer#{k:09d}"
        if k in (5, 6):
            name = "Customer#dup"          # duplicate e-mail
        if k in (7, 8):
            name = None                    # NULL e-mails
        cust["c_custkey"].append(k)
        cust["c_name"].append(name)
        cust["c_nationkey"].append(k % 5 if k != 9 else 7)   # 7: no nation
        cust["c_acctbal"].append(100.0 + k)
        cust["c_mktsegment"].append(segs[k % 4])
    cust["c_custkey"].append(3)            # duplicate customer id
    cust["c_name"].append("Customer#again")
    cust["c_nationkey"].append(1)
    cust["c_acctbal"].append(1.0)
    cust["c_mktsegment"].append("BUILDING")
    customer = pa.table({"c_custkey": pa.array(cust["c_custkey"], pa.int64()),
                         "c_name": cust["c_name"],
                         "c_nationkey": pa.array(cust["c_nationkey"], pa.int32()),
                         "c_acctbal": cust["c_acctbal"], "c_mktsegment": cust["c_mktsegment"]})
    types = ["SMALL", "LARGE", "PROMO", None]
    sizes = [1, 3, 6, 10, 26, 27, 40, 50, 4, 8, 12, 16, 20, 24, 28, 32, 36, 44, 2, 5]
    part = pa.table({"p_partkey": pa.array(list(range(1, 21)), pa.int64()),
                     "p_name": [f"part {i}" for i in range(1, 21)],
                     "p_brand": [f"Brand#{i % 3}" for i in range(1, 21)],
                     "p_type": [types[i % 4] for i in range(1, 21)],
                     "p_size": pa.array(sizes, pa.int32()),
                     "p_retailprice": [900.0 + 7.5 * i for i in range(1, 21)]})
    statuses = ["F", "O", "P", "F", "O", "F", None, "X"]
    prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    o = {"o_orderkey": [], "o_custkey": [], "o_orderstatus": [], "o_totalprice": [],
         "o_orderdate": [], "o_orderpriority": []}
    start = dt.datetime(2000, 11, 20)
    for k in range(1, 161):
        cust_k = 1 + (k * 7) % 40
        if cust_k == 40:
            cust_k = 39
        if k == 13:
            cust_k = None                  # NULL customer
        if k == 14:
            cust_k = 99                    # dangling customer
        if k in (20, 21):
            cust_k = 2                     # same customer, same day
        day = start + dt.timedelta(days=(k * 5) % 420)
        if k == 21:
            day = start + dt.timedelta(days=(20 * 5) % 420)
        o["o_orderkey"].append(k)
        o["o_custkey"].append(cust_k)
        o["o_orderstatus"].append(statuses[k % 8])
        o["o_totalprice"].append(round(1000 + (k * 37.13) % 5000, 2))
        o["o_orderdate"].append(day)
        o["o_orderpriority"].append(prios[k % 5])
    # a customer whose only order has no total (NULL money, NULL sort keys)
    o["o_orderkey"].append(161)
    o["o_custkey"].append(40)
    o["o_orderstatus"].append("F")
    o["o_totalprice"].append(None)
    o["o_orderdate"].append(start + dt.timedelta(days=30))
    o["o_orderpriority"].append("1-URGENT")
    # an order without a date (lines included)
    o["o_orderkey"].append(162)
    o["o_custkey"].append(38)
    o["o_orderstatus"].append("O")
    o["o_totalprice"].append(777.77)
    o["o_orderdate"].append(None)
    o["o_orderpriority"].append("5-LOW")
    # an order whose total is not a number
    o["o_orderkey"].append(163)
    o["o_custkey"].append(37)
    o["o_orderstatus"].append("F")
    o["o_totalprice"].append(float("nan"))
    o["o_orderdate"].append(start + dt.timedelta(days=90))
    o["o_orderpriority"].append("3-MEDIUM")
    # an order without a key, the only order of customer 41
    o["o_orderkey"].append(None)
    o["o_custkey"].append(41)
    o["o_orderstatus"].append("F")
    o["o_totalprice"].append(500.0)
    o["o_orderdate"].append(start + dt.timedelta(days=60))
    o["o_orderpriority"].append("2-HIGH")
    orders = pa.table({"o_orderkey": pa.array(o["o_orderkey"], pa.int64()),
                       "o_custkey": pa.array(o["o_custkey"], pa.int64()),
                       "o_orderstatus": o["o_orderstatus"], "o_totalprice": o["o_totalprice"],
                       "o_orderdate": pa.array(o["o_orderdate"], pa.timestamp("us")),
                       "o_orderpriority": o["o_orderpriority"]})
    li = {k: [] for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                          "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                          "l_linestatus", "l_shipdate")}
    discounts = [0.0, -0.0, 0.01, 0.02, 0.03, 0.05, 0.06, 0.08, 0.09, 0.10]
    for k in range(1, 161):
        if k % 17 == 0:
            continue                       # orders without lines
        for ln in range(1, 1 + (k % 4) + 1):
            pk = 1 + (k * 3 + ln * 5) % 20
            qty = float(1 + (k * ln * 13) % 50)
            price = 900.0 + 7.5 * pk
            li["l_orderkey"].append(k)
            li["l_partkey"].append(pk)
            li["l_suppkey"].append(1)
            li["l_linenumber"].append(ln)
            li["l_quantity"].append(qty)
            li["l_extendedprice"].append(round(qty * price, 2))
            li["l_discount"].append(discounts[(k + ln) % len(discounts)])
            li["l_tax"].append(0.02)
            li["l_returnflag"].append("R" if (k + ln) % 3 == 0 else "N")
            li["l_linestatus"].append("F" if ln % 2 else "O")
            li["l_shipdate"].append(start + dt.timedelta(days=(k * 5) % 420 + ln * 3 - 4))
    # duplicate line, dangling order, dangling part, lines of the undated order
    extra = [(5, 3, 1), (5, 3, 2), (300, 4, 1), (6, 77, 1), (162, 2, 1), (162, 9, 2),
             (7, 5, 3), (8, 6, 3)]
    for ok, pk, ln in extra:
        li["l_orderkey"].append(ok)
        li["l_partkey"].append(pk)
        li["l_suppkey"].append(1)
        li["l_linenumber"].append(ln)
        # a zero and a missing quantity on the last two lines
        li["l_quantity"].append({7: 0.0, 8: None}.get(ok, 48.0) if ln == 3 else 48.0)
        li["l_extendedprice"].append(float("nan") if ok == 6 else 48 * 910.0)
        li["l_discount"].append(0.04)
        li["l_tax"].append(0.0)
        li["l_returnflag"].append("R")
        li["l_linestatus"].append("F")
        li["l_shipdate"].append(start + dt.timedelta(days=rnd.randint(0, 400)))
    lineitem = pa.table({
        "l_orderkey": pa.array(li["l_orderkey"], pa.int64()),
        "l_partkey": pa.array(li["l_partkey"], pa.int64()),
        "l_suppkey": pa.array(li["l_suppkey"], pa.int64()),
        "l_linenumber": pa.array(li["l_linenumber"], pa.int32()),
        "l_quantity": li["l_quantity"], "l_extendedprice": li["l_extendedprice"],
        "l_discount": li["l_discount"], "l_tax": li["l_tax"],
        "l_returnflag": li["l_returnflag"], "l_linestatus": li["l_linestatus"],
        "l_shipdate": pa.array(li["l_shipdate"], pa.timestamp("us"))})
    for name, tab in (("region", region), ("nation", nation), ("customer", customer),
                      ("part", part), ("orders", orders), ("lineitem", lineitem)):
        pq.write_table(tab, f"{out_dir}/{name}.parquet")
