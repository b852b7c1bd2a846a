import contextlib
import datetime as dt
import io
import re
from collections import defaultdict
from fractions import Fraction

import pytest

import __spark_entry__ as contract
from ledgerline.plans import PRICE_SUMMARY_SQL, price_summary
from ledgerline.sources import table

SCHEMA = (
    "l_orderkey bigint, l_extendedprice double, l_discount double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
CUTOFF = dt.datetime(2001, 6, 30)


def rows(df):
    return sorted(map(tuple, df.collect()))


def write_lineitem(spark, path, data, files):
    spark.createDataFrame(data, SCHEMA).repartition(files).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def brute_force(data):
    totals = defaultdict(lambda: [0, None, None])
    for _, price, discount, flag, status, shipped in data:
        if shipped is None or shipped > CUTOFF:
            continue
        total = totals[flag, status]
        total[0] += 1
        if price is not None:
            cents = round(Fraction(price) * 100)
            total[1] = (total[1] or 0) + cents
            if discount is not None:
                total[2] = (total[2] or 0) + cents * (100 - round(Fraction(discount) * 100))
    return sorted(
        (*key, n, p if p is None else float(Fraction(p, 100)), r if r is None else float(Fraction(r, 10**4)))
        for key, (n, p, r) in totals.items()
    )


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_equals_the_sql_bit_for_bit(spark, duck, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    df = price_summary(spark, sf_dir)
    columns, want = duck(PRICE_SUMMARY_SQL, sf_dir)
    assert df.columns == columns
    assert [t for _, t in df.dtypes] == ["string", "string", "bigint", "double", "double"]
    assert rows(df) == sorted(want)


def test_file_layout_does_not_change_a_bit(spark, tmp_path):
    source = "/root/testdata/sf0.01"
    table(spark, source, "lineitem").repartition(13).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert rows(price_summary(spark, str(tmp_path))) == rows(price_summary(spark, source))


def test_hot_group_nulls_refunds_and_cutoff(spark, tmp_path):
    day = dt.timedelta(days=1)
    data = [(i, (i * 37 % 99_991) / 100, (i % 11) / 100, "N", "O", CUTOFF - day) for i in range(20_000)]
    data += [
        (1, 10.01, 0.05, "A", "F", CUTOFF),
        (2, 99.99, 0.05, "A", "F", CUTOFF + dt.timedelta(microseconds=1)),
        (3, -10.01, 0.1, "A", "F", CUTOFF - day),
        (4, None, 0.1, "R", "F", CUTOFF - day),
        (5, 5.5, None, "R", "F", CUTOFF - day),
        (6, None, None, "R", "O", CUTOFF - day),
        (7, 7.0, 0.0, None, "F", CUTOFF - day),
        (8, 8.0, 0.0, "A", "F", None),
        (9, 9_999_999_999.99, 0.0, "B", "F", CUTOFF - day),
        (10, 9_999_999_999.99, 0.99, "B", "F", CUTOFF - day),
    ]
    sf_dir = write_lineitem(spark, tmp_path, data, files=9)

    def order(r):
        return [(v is not None, v) for v in r[:2]]

    got = sorted(map(tuple, price_summary(spark, sf_dir).collect()), key=order)
    want = sorted(
        brute_force([r for r in data if r[3] is not None])
        + [(None, "F", 1, 7.0, 7.0)],
        key=order,
    )
    assert got == want


def test_no_rows_in_no_rows_out(spark, tmp_path):
    late = [(1, 1.0, 0.0, "A", "F", CUTOFF + dt.timedelta(days=1))]
    assert rows(price_summary(spark, write_lineitem(spark, tmp_path, late, files=1))) == []


def test_session_time_zone_does_not_move_the_cutoff(spark):
    want = rows(price_summary(spark, "/root/testdata/sf0.01"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert rows(price_summary(spark, "/root/testdata/sf0.01")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plan_prunes_pushes_down_and_shuffles_once(spark):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        price_summary(spark, "/root/testdata/sf0.01").explain("formatted")
    plan = out.getvalue()
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "LessThanOrEqual(l_shipdate," in pushed
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    }
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("HashAggregate") == 2
    assert "partial_sum" in plan
    for absent in ("SortAggregate", "ObjectHashAggregate", "Python", "Broadcast", "Cartesian"):
        assert absent not in plan


def test_contract(spark, duck):
    assert entry_names(contract.entry(spark)) == entry_names(price_summary(spark, "/root/testdata/sf0.01"))
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    for name, sql in contract.oracle_sql().items():
        df = contract.queries()[name](spark, "/root/testdata/sf0.001")
        columns, want = duck(sql, "/root/testdata/sf0.001")
        assert df.columns == columns
        assert rows(df) == sorted(want)


def entry_names(df):
    return [(f.name, f.dataType) for f in df.schema]
