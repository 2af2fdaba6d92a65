"""Hand-made fixtures, one per semantic decision (FIXTURES.md §2)."""

from __future__ import annotations

import datetime as dt

import pytest

from shopline.functions.stats import safe_corr
from shopline.operators import clean as cln
from shopline.operators import consolidate as con
from shopline.operators import profile as prf
from shopline.plans import marts
from shopline.schemas import HOLIDAYS, SALES
from shopline.sources import csv as csvsrc

D = dt.date
HEADER = "id,date,store_nbr,family,sales,onpromotion"


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# ---------------------------------------------------------------- F1-F3 sources

def test_f1_double_encoded_lines(spark):
    df = csvsrc.parse_csv_lines(lines(spark, [
        HEADER, "2,2013-01-01,1,AUTOMOTIVE,0,0",
        '"1,2013-01-01,1,""BREAD,X"",0.5,0"', '"3,2013-01-01,1,BOOKS,,1"']), SALES, keep_flag=True)
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 3
    assert sum(r["repaired"] for r in rows.values()) == 2
    assert rows[1]["family"] == "BREAD,X" and rows[1]["sales"] == 0.5
    assert rows[3]["sales"] is None and rows[3]["onpromotion"] == 1
    assert rows[2]["date"] == D(2013, 1, 1)


def test_f2_clean_lines_same_result(spark):
    df = csvsrc.parse_csv_lines(lines(spark, [
        HEADER, "2,2013-01-01,1,AUTOMOTIVE,0,0", '1,2013-01-01,1,"BREAD,X",0.5,0',
        "3,2013-01-01,1,BOOKS,,1"]), SALES, keep_flag=True)
    assert df.where("repaired").count() == 0
    assert {r["family"] for r in df.collect()} == {"AUTOMOTIVE", "BREAD,X", "BOOKS"}


@pytest.mark.parametrize("bad", ["just-one-field", "1,2013-01-01,xx,BOOKS,1.0,1"])
def test_f3_bad_lines_fail_at_action(spark, bad):
    df = csvsrc.parse_csv_lines(lines(spark, [HEADER, bad]), SALES)
    with pytest.raises(Exception):
        df.collect()


def test_f3_missing_file_names_table(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="stores"):
        csvsrc.read_csv_table(spark, f"{tmp_dir}/nope.csv", HOLIDAYS, "stores")


def test_csv_file_roundtrip(spark, tmp_dir):
    path = f"{tmp_dir}/train.csv"
    with open(path, "w") as f:
        f.write(HEADER + "\n2,2013-01-01,1,AUTOMOTIVE,0,0\n" + '"1,2013-01-01,1,""BREAD,X"",0.5,0"\n')
    df = csvsrc.read_sales_csv(spark, path)
    assert sorted(r["id"] for r in df.collect()) == [1, 2]


# -------------------------------------------------------------- F4-F8 cleaning

def test_f4_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b"), (4, None)], "k int, v string")
    assert cln.dedupe(df).count() == 4
    assert prf.table_profile(df, "t").collect()[0]["duplicate_rows"] == 1


@pytest.mark.parametrize("values,expected", [([1, 2, None], 1.5), ([1, 2, 3, None], 2.0),
                                             ([None, None], None)])
def test_f5_median(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    out, audit = cln.impute(df, ["x"])
    got = {r["x"] for r in out.collect()}
    assert audit.collect()[0]["value_num"] == expected
    if expected is None:
        assert got == {None}
    else:
        assert expected in got and None not in got


def test_approximate_median_opt_in(spark):
    df = spark.range(1001).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS x")
    _, exact = cln.impute(df, ["x"])
    _, approx = cln.impute(df, ["x"], median="approx")
    e, a = exact.collect()[0]["value_num"], approx.collect()[0]["value_num"]
    assert e == 500.0 and abs(a - e) <= 1001 / 10_000 + 1
    with pytest.raises(ValueError):
        cln.impute(df, ["x"], median="mean")


def test_f6_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b", True), ("a", None), ("b", False), ("a", False), (None, True)],
                               "s string, f boolean")
    out, audit = cln.impute(df, ["s", "f"])
    assert [r["s"] for r in out.collect()].count("a") == 3
    vals = {r["column"]: r["value_text"] for r in audit.collect()}
    assert vals == {"s": "a", "f": "false"}


def test_f7_interpolation_by_position(spark):
    df = spark.createDataFrame([(D(2013, 1, 1), None), (D(2013, 1, 2), 10.0), (D(2013, 1, 3), None),
                                (D(2013, 1, 7), 16.0), (D(2013, 1, 8), None)], "date date, p double")
    got = [r["p"] for r in cln.interpolate(df, "date", "p").orderBy("date").collect()]
    assert got == [10.0, 10.0, 13.0, 16.0, 16.0]
    by_time = [r["p"] for r in cln.interpolate(df, "date", "p", by="time").orderBy("date").collect()]
    assert by_time[2] == pytest.approx(11.2)


def test_f8_two_adjacent_nulls(spark):
    df = spark.createDataFrame([(D(2013, 1, i), v) for i, v in [(1, 10.0), (2, None), (3, None), (4, 16.0)]],
                               "date date, p double")
    got = [r["p"] for r in cln.interpolate(df, "date", "p").orderBy("date").collect()]
    assert got == [10.0, 12.0, 14.0, 16.0]


def test_interpolation_per_series(spark):
    rows = [("a", D(2013, 1, 1), 1.0), ("a", D(2013, 1, 2), None), ("a", D(2013, 1, 3), 3.0),
            ("b", D(2013, 1, 1), 10.0), ("b", D(2013, 1, 2), None), ("b", D(2013, 1, 3), None),
            ("b", D(2013, 1, 4), 40.0)]
    df = spark.createDataFrame(rows, "k string, date date, p double")
    got = {(r["k"], r["date"].day): r["p"] for r in cln.interpolate(df, "date", "p", keys=["k"]).collect()}
    assert got[("a", 2)] == 2.0 and got[("b", 2)] == 20.0 and got[("b", 3)] == 30.0


def test_clean_postcondition(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "sales double")
    with pytest.raises(ValueError):
        cln.assert_no_nulls(df, ["sales"])


# ------------------------------------------------------------ F9-F12 joins

def hol(spark, rows):
    return spark.createDataFrame(rows, HOLIDAYS)


def test_f9_representative_and_flag(spark):
    h = hol(spark, [
        (D(2013, 1, 1), "Event", "National", "C", "e", False),
        (D(2013, 1, 1), "Holiday", "Local", "Q", "h", False),
        (D(2013, 1, 2), "Holiday", "National", "C", "t", True),
        (D(2013, 1, 3), "Work Day", "National", "C", "w", False)])
    got = {r["date"]: r for r in con.holidays_per_date(h).collect()}
    assert got[D(2013, 1, 1)]["holiday_type"] == "Holiday" and got[D(2013, 1, 1)]["is_national_holiday"]
    assert not got[D(2013, 1, 2)]["is_national_holiday"]
    assert got[D(2013, 1, 3)]["is_national_holiday"]


def test_f10_tie_independent_of_order(spark):
    a = (D(2013, 1, 1), "Holiday", "Local", "Q", "x", False)
    b = (D(2013, 1, 1), "Holiday", "Regional", "P", "y", False)
    r1 = con.holidays_per_date(hol(spark, [a, b])).collect()
    r2 = con.holidays_per_date(hol(spark, [b, a])).collect()
    assert r1 == r2 and r1[0]["holiday_locale"] == "Regional"


def tables_f11(spark, dup_store=False):
    days = [D(2013, 1, 4), D(2013, 1, 5), D(2013, 1, 6)]  # Fri, Sat, Sun
    sales = spark.createDataFrame(
        [(i, d, s, f, 1.0, 0) for i, (d, s, f) in enumerate(
            (d, s, f) for d in days for s in (1, 2) for f in ("A", "B"))], SALES)
    stores_rows = [(1, "c1", "s1", "A", 1), (2, "c2", "s2", "B", 2)]
    if dup_store:
        stores_rows.append((2, "c2", "s2", "B", 3))
    return {
        "train": sales,
        "stores": spark.createDataFrame(stores_rows, "store_nbr long, city string, state string, type string, cluster long"),
        "transactions": spark.createDataFrame([(d, s, 5) for d in days for s in (1, 2) if (d, s) != (days[0], 2)],
                                              "date date, store_nbr long, transactions long"),
        "oil": spark.createDataFrame([(days[0], 50.0)], "date date, dcoilwtico double"),
        "holidays": hol(spark, [(days[1], "Holiday", "National", "C", "x", False)]),
    }


def test_f11_joins_keep_rows(spark):
    t = tables_f11(spark)
    wide = con.consolidate(t)
    assert wide.count() == 12 and len(wide.columns) == 18
    assert wide.where("transactions is null").count() == 2
    assert wide.where("dcoilwtico is null").count() == 8
    assert wide.where("not is_national_holiday").count() == 8
    audit = con.fanout_audit(t, wide).collect()[0]
    assert audit["rows_added_by_joins"] == 0


def test_f12_fanout_reported(spark):
    t = tables_f11(spark, dup_store=True)
    assert [r["key"] for r in con.key_violations(t["stores"], ["store_nbr"], "stores").collect()] == ["2"]
    assert con.fanout_audit(t, con.consolidate(t)).collect()[0]["rows_added_by_joins"] > 0


# ------------------------------------------------------------- F13-F22 marts

WIDE = ("date date, store_nbr long, family string, sales double, onpromotion double, city string, "
        "state string, type string, transactions long, dcoilwtico double, is_national_holiday boolean")


def wide(spark, rows):
    return spark.createDataFrame(rows, WIDE)


def row(d, store=1, fam="A", sales=1.0, promo=0.0, city="c", trans=None, price=None, hol=False):
    return (d, store, fam, sales, promo, city, "s", "T", trans, price, hol)


def test_f13_ticket_grain(spark):
    df = wide(spark, [row(D(2013, 1, 1), fam=f, sales=10.0, trans=10) for f in "ABC"])
    assert marts.average_ticket(df).collect()[0]["avg_ticket"] == 1.0
    assert marts.average_ticket(df, grain="store_day").collect()[0]["avg_ticket"] == 3.0


def test_f14_store_without_transactions(spark):
    df = wide(spark, [row(D(2013, 1, 1), store=1, trans=None), row(D(2013, 1, 1), store=2, trans=4)])
    m12 = {r["store_nbr"]: r["total_transactions"] for r in marts.transactions_vs_sales(df).collect()}
    assert m12 == {1: 0, 2: 4}
    assert [r["store_nbr"] for r in marts.average_ticket(df).collect()] == [2]


def test_f15_event_window_overlap(spark):
    rows = [row(D(2013, 1, d), sales=float(d), hol=d in (1, 3)) for d in (1, 2, 3, 4)]
    got = {(r["offset"], r["family"]): r["avg_sales"] for r in marts.holiday_window(wide(spark, rows)).collect()}
    # day 2 is +1 after day 1 and -1 before day 3
    assert got[(1, "A")] == pytest.approx((2.0 + 4.0) / 2)
    assert got[(-1, "A")] == 2.0
    # -3 lands before the data (day 0 / day -2); +3 from day 1 is day 4
    assert (-3, "A") not in got and got[(3, "A")] == 4.0


def test_f16_uplift_nulls_first(spark):
    rows = [row(D(2013, 1, 1), fam="never", promo=0.0), row(D(2013, 1, 1), fam="zero", promo=0.0, sales=0.0),
            row(D(2013, 1, 2), fam="zero", promo=3.0, sales=5.0),
            row(D(2013, 1, 1), fam="up", promo=0.0, sales=2.0), row(D(2013, 1, 2), fam="up", promo=1.0, sales=3.0)]
    got = marts.promotion_uplift(wide(spark, rows)).collect()
    assert [r["uplift_pct"] for r in got] == [None, None, 50.0]


def test_f17_no_holiday_at_all(spark):
    df = wide(spark, [row(D(2013, 1, 1))])
    assert marts.holiday_impact(df).count() == 1
    m07 = marts.holiday_sensitivity(df)
    assert m07.columns == ["family", "avg_holiday", "avg_normal", "pct_change"]
    r = m07.collect()[0]
    assert r["avg_holiday"] is None and r["pct_change"] is None


@pytest.mark.parametrize("pairs,expected", [
    ([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], None), ([(1.0, 2.0)], None), ([], None),
    ([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (4.0, None)], 0.99339927)])
def test_f18_safe_corr(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "x double, y double")
    got = df.agg(safe_corr("x", "y").alias("r")).collect()[0]["r"]
    assert (got is None) if expected is None else got == pytest.approx(expected, abs=1e-8)


def test_f19_lag_recovers_shift(spark):
    sales = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    price = sales[2:] + [7.0, 0.5]  # price(m) = sales(m + 2): price leads sales by 2 months
    rows = [row(D(2015, m + 1, 1), sales=sales[m], price=price[m]) for m in range(8)]
    got = {r["lag_months"]: r["corr"] for r in marts.lag_corr(wide(spark, rows)).collect()}
    assert len(got) == 7 and got[2] == 1.0


def test_f20_short_city(spark):
    rows = ([row(D(2015, m, 1), city="two", sales=float(m), price=float(m * m)) for m in (1, 2)]
            + [row(D(2015, m, 1), city="three", sales=float(m), price=float(m * m)) for m in (1, 2, 3)])
    got = [r["city"] for r in marts.city_price_corr(wide(spark, rows)).collect()]
    assert got == ["three"]


def test_f21_empty_period(spark):
    df = wide(spark, [row(D(2013, 1, 1), price=1.0)])
    m10, m11 = marts.lag_corr(df), marts.city_price_corr(df)
    assert m10.count() == 0 and m10.columns == ["lag_months", "corr"]
    assert m11.count() == 0 and m11.columns == ["city", "corr"]


def test_f22_rank_ties(spark):
    df = wide(spark, [row(D(2013, 1, 1), store=s, sales=5.0) for s in (7, 3)]
              + [row(D(2013, 1, 1), store=9, sales=1.0)])
    got = [(r["store_nbr"], r["ranking"]) for r in marts.store_ranking(df).collect()]
    assert got == [(3, 1), (7, 2), (9, 3)]


def test_shares_sum_to_100(spark):
    df = wide(spark, [row(D(2013, 1, 1), fam=f, sales=s) for f, s in [("A", 1.0), ("B", 2.0), ("C", 3.0)]])
    assert sum(r["pct_of_total"] for r in marts.sales_by_family(df).collect()) == pytest.approx(100, abs=0.02)
