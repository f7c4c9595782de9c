"""What keeps the queries over trips linear in the trips: one scan, one shuffle of the trip rows, compiled filters."""

import contextlib
import datetime as dt
import io
import re

import pytest

from cordon.plans import catalog
from cordon.sources import fixture


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Some trips of two Decembers, with keys that are null, repeated or met by nothing."""
    d = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")

    days = [dt.datetime(y, 12, 1 + k) for y in (1999, 2000) for k in range(4)]
    write("lineitem", [(None if i == 5 else i % 40, i % 7, None if i == 9 else i % 11, i % 3 + 1, 1.0 + i % 50, 9000.0 + 10 * i,
                        0.0 if i % 6 == 0 else 0.05, 0.0 if i % 4 == 0 else 0.02, "OF"[i % 2], None if i == 13 else days[i % 8])
                       for i in range(200)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp_ntz")
    write("orders", [(None if i == 3 else i, None if i == 4 else i % 9, 1000.0 + i, days[i % 8], "1-URGENT" if i % 3 else "5-LOW")
                     for i in [*range(38), 7]],
          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    write("customer", [(i, i % 5) for i in [*range(8), 2]] + [(None, 1)], "c_custkey long, c_nationkey int")
    write("supplier", [(i, i % 4) for i in [*range(10), 6]], "s_suppkey long, s_nationkey int")
    write("nation", [(i, f"NATION_{i}", i % 2) for i in range(5)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(0, "ASIA"), (1, "AFRICA")], "r_regionkey int, r_name string")
    return d


@contextlib.contextmanager
def shuffled(spark, adaptive="true"):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["month_profile", "impute_month"])
def test_results_of_several_hubs_scan_the_trips_once(spark, tables, name):
    merged = catalog.QUERIES[f"{name}_merged"](spark, tables)
    assert tree(merged).count("lineitem.parquet") == 0  # it reads the hubs that one scan has written
    direct = catalog.QUERIES[name](spark, tables)
    expected = sorted(map(str, direct.select(*sorted(direct.columns)).collect()))
    assert expected and sorted(map(str, merged.select(*sorted(merged.columns)).collect())) == expected


def test_trip_rows_are_not_shuffled_to_customers(spark, tables):
    with shuffled(spark):
        lines = tree(fixture.trips(spark, tables)).splitlines()
    depth = [re.search("[A-Za-z]", x).start() for x in lines]
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin [o_custkey" in x)
    end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    assert "customer.parquet" in "".join(lines[at:end]) and "lineitem.parquet" not in "".join(lines[at:end])


def test_trips_of_null_and_repeated_keys(spark, tables):
    rows = {t: spark.read.parquet(f"{tables}/{t}.parquet").collect() for t in ("lineitem", "orders", "customer", "supplier")}
    expected = []
    for r in rows["lineitem"]:
        start = r.l_shipdate and r.l_shipdate + dt.timedelta(seconds=((r.l_orderkey or 0) * 37 + r.l_linenumber * 101) % 86400)
        end = start and start + dt.timedelta(
            seconds=(r.l_partkey * 31 + (r.l_suppkey or 0) * 17 + r.l_linenumber * 53) % 3600 - 20)
        for s in rows["supplier"]:
            for o in rows["orders"]:
                for c in rows["customer"]:
                    if None not in (r.l_suppkey, r.l_orderkey, o.o_custkey) and r.l_suppkey == s.s_suppkey \
                            and r.l_orderkey == o.o_orderkey and o.o_custkey == c.c_custkey:
                        fare = r.l_extendedprice / 1000 * (-1 if r.l_orderkey % 25 == 0 else 1)
                        expected.append(("yellow" if r.l_linestatus == "O" else "green", start, end, s.s_nationkey, c.c_nationkey,
                                         fare, fare * (1 + r.l_tax)))
    found = fixture.trips(spark, tables).select(
        "taxi_type", "pickup_time", "dropoff_time", "pickup_loc", "dropoff_loc", "fare", "total_amount").collect()
    assert len(expected) > 150 and sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_pushed_filters_are_short_enough_to_be_compiled(spark, tables):
    """The JVM never compiles a method of more than 8,000 bytes."""
    out = io.StringIO()
    with shuffled(spark, adaptive="false"), contextlib.redirect_stdout(out):
        catalog.QUERIES["precip_elasticity"](spark, tables).explain(mode="codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000, max(sizes)
