"""Column functions on edge rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewell import functions as fx
from tidewell.plans.sales import MARGINS, margin_for


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_run_date_arithmetic():
    assert fx.month_end("2024-02-10") == date(2024, 2, 29)
    assert fx.month_end("2024-03-31", -1) == date(2024, 2, 29)
    assert fx.month_shift("2024-03-31", -1) == date(2024, 2, 29)
    assert fx.month_shift("2024-01-15", -13) == date(2022, 12, 15)
    assert fx.day_shift("2024-03-01", -1) == date(2024, 2, 29)
    assert fx.month_number("2024-12-01") - fx.month_number("2023-12-31") == 12


def test_whole_months_at_month_ends(spark):
    rows = [
        (date(2024, 2, 29), date(2024, 1, 31), 1),
        (date(2023, 2, 28), date(2023, 1, 30), 0),
        (date(2023, 2, 28), date(2023, 1, 31), 1),
        (date(2024, 3, 30), date(2024, 2, 29), 1),
        (date(2024, 3, 28), date(2024, 2, 29), 0),
        (date(2024, 1, 1), date(2024, 1, 2), -1),
        (date(2024, 1, 1), None, None),
    ]
    got = values(spark, "a date, b date, want int", rows, fx.whole_months("a", "b"), "want")
    assert all(g == w for g, w in got)


def test_same_periods_and_labels(spark):
    rows = [(date(2024, 1, 31), date(2024, 3, 1)), (date(2024, 12, 31), date(2025, 1, 1))]
    got = values(
        spark, "a date, b date", rows,
        fx.same_month("a", "b"), fx.same_quarter("a", "b"), fx.same_year("a", "b"), fx.months_apart("b", "a"),
        fx.quarter_label("a"),
    )
    assert got == [(False, True, True, 2, "2023 Q3"), (False, False, False, 1, "2024 Q2")]


def test_mixed_timestamps(spark):
    rows = [("2024-02-29T10:00:00",), ("1704067200000",), ("junk",), ("junk-text",), (None,), ("",)]
    got = [r[0] for r in values(spark, "c string", rows, fx.parse_mixed_ts("c"))]
    assert got == [date(2024, 2, 29), date(2024, 1, 1), None, None, None, None]


def test_phone(spark):
    rows = [("12-34",), ("123456789",), (" +84 (9) 1234-5678 ",), ("",), (None,)]
    got = [r[0] for r in values(spark, "c string", rows, fx.normalize_phone("c"))]
    assert got == ["1234", "123456789", "912345678", "", None]


def test_text_cuts(spark):
    rows = [("abcdef",), ("ab",), (None,)]
    got = values(spark, "c string", rows, fx.drop_first("c"), fx.drop_last("c", 3), fx.last_chars("c", 3))
    assert got == [("bcdef", "abc", "def"), ("b", "", "ab"), (None, None, None)]


def test_band_edges(spark):
    rows = [(17,), (18,), (24,), (25,), (64,), (65,), (None,)]
    got = [r[0] for r in values(spark, "c int", rows, fx.band("c", [18, 25, 65], ["a", "b"]))]
    assert got == [None, "a", "a", "b", "b", None, None]
    got = [r[0] for r in values(spark, "c int", rows, fx.band("c", [None, 25, None], ["lo", "hi"], "none"))]
    assert got == ["lo", "lo", "lo", "hi", "hi", "hi", "none"]


def test_ratio_of_nothing(spark):
    got = [r[0] for r in values(spark, "a int, b int", [(1, 0), (1, None), (1, 4)], fx.ratio("a", "b"))]
    assert got == [None, None, 0.25]


def test_flags_on_null(spark):
    got = values(spark, "c string", [("x",), ("y",), (None,)], fx.yn(F.col("c") == "x"), fx.flag(F.col("c") == "x"), fx.is_or_null("c", "x"))
    assert got == [("Y", 1, True), ("N", 0, False), ("N", 0, True)]


@pytest.mark.parametrize(
    ("days", "mode", "want"),
    [(21, 1, 0), (22, 1, 100), (31, 1, 200), (364, 1, 1200), (365, 1, 1200), (None, 1, 1200),
     (22, 3, 100), (92, 3, 200), (364, 3, 400), (182, 6, 100), (183, 6, 200), (30, 12, 100), (-5, 12, 0)],
)
def test_adjusted_premium(spark, days, mode, want):
    premium = F.lit("100").cast("decimal(18,2)")
    col = fx.adjusted_premium("d", "m", premium, fx.ape(premium, "m"), F.lit(False))
    assert float(values(spark, "d int, m int", [(days, mode)], col)[0][0]) == want


def test_adjusted_single_premium_keeps_its_digits(spark):
    from decimal import Decimal

    rows = [(21, Decimal("10016.31")), (22, Decimal("10016.31")), (None, Decimal("10016.31"))]
    col = fx.adjusted_premium("d", F.lit(12), "p", fx.ape("p", F.lit(12)), F.lit(True))
    assert [float(r[0]) for r in values(spark, "d int, p decimal(18,2)", rows, col)] == [0, 1001.631, 1001.631]


def test_owner_relation(spark):
    rows = [(-18, "M", "M"), (-17, "M", "M"), (0, "M", "F"), (17, "M", "M"), (18, "M", "M"), (40, "M", "F"),
            (41, "M", "F"), (None, "M", "F"), (None, "M", "M"), (5, None, "M"), (5, None, None)]
    col = fx.owner_relation(F.lit(False), "g", "a", "b")
    got = [r[0] for r in values(spark, "g int, a string, b string", rows, col)]
    assert got == ["parent", "others", "spouse", "others", "child", "child", "others", "spouse", "others", "spouse", "spouse"]


def test_argmax_ties_and_nulls(spark):
    rows = [(0.3, 0.3, 0.1), (None, 0.2, 0.5), (None, None, None)]
    got = [r[0] for r in values(spark, "a double, b double, c double", rows, fx.argmax_name(["a", "b", "c"]))]
    assert got == ["a", "c", None]


def test_vip_tier_edges(spark):
    rows = [(19999,), (20000,), (64999,), (65000,), (149999,), (150000,), (300000,), (None,)]
    with_years = [r[0] for r in values(spark, "p int", rows, fx.vip_tier("p", F.lit(True)))]
    assert with_years == ["Not VIP", "Silver", "Silver", "Gold", "Gold", "Platinum", "Platinum Elite", "Not VIP"]
    assert values(spark, "p int", [(30000,)], fx.vip_tier("p", F.lit(False))) == [("Not VIP",)]


def test_margin_forms(spark):
    rows = [("03", None), ("01", None), ("09", None), ("*", "TCB01"), ("01", "TCB01"), ("99", "VTI01"), ("99", "XXX")]
    margins = {m: F.lit(i) for i, m in enumerate(MARGINS)}

    def pick(form):
        col = margin_for(F.col("c"), F.col("l"), margins, form).cast("string")
        out = [r[0] for r in values(spark, "c string, l string", rows, col)]
        return [x if x.startswith("-") else MARGINS[int(float(x))].removeprefix("nbv_margin_") for x in out]

    leads = pick("leads")
    assert leads[:2] == ["banca_other_banks", "agency"] and leads[2] == "-1.34041044648343"
    assert leads[3:] == ["agency", "banca_tcb", "banca_vti", "other_channel"]
    assert float(pick("ecommerce")[2]) == -1.34 and pick("ecommerce")[5] == "other_channel"
    assert pick("upsell")[4] == "agency"


def test_tenure_and_week(spark):
    got = values(spark, "m int", [(40,), (0,), (-1,)], fx.tenure_text("m"))
    assert got == [("3 y 4 m",), ("0 y 0 m",), ("-1 y 11 m",)]
    got = values(spark, "a date, b date", [(date(2024, 1, 8), date(2024, 1, 1))], fx.week_number("a", "b"))
    assert got == [(2,)]
