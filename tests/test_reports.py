import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from candlemill.operators import bars as B
from candlemill.functions.periods import DAY
from candlemill.plans.flavours import FLAVOURS
from candlemill.plans.reports import growth_report, week_report
from candlemill.plans.sql_report import growth_rates_sql, growth_report_sql
from tests.helpers import bars_frame, ticks_frame

# Published month bars (open, close) of two years, and the close before
# the second one.
BARS_2012 = """1570.057 1736.106
1736.191 1702.999
1703.018 1668.636
1668.636 1667.141
1667.17 1561.048
1561.047 1598.135
1599.657 1613.51
1613.474 1693.016
1691.617 1765.817
1765.759 1720.554
1720.537 1715.157
1715.167 1675.627"""

# The published report row of that year.
DENSE_OC_2012 = [10.58, -1.91, -2.02, -0.09, -6.37, 2.38, 0.87, 4.93, 4.39, -2.56, -0.31, -2.31, 0.63]


def bars_2012(spark):
    rows = [
        (2012, month, *map(float, line.split())) for month, line in enumerate(BARS_2012.splitlines(), 1)
    ]
    return bars_frame(spark, rows)


def test_published_row(spark):
    first, summary = growth_report(bars_2012(spark), "dense", "oc").collect()
    assert list(first) == ["2012", *DENSE_OC_2012]
    assert list(summary) == ["AVG", *DENSE_OC_2012]


@pytest.mark.parametrize(
    "flavour, mode, year_cell",
    [
        ("mysql", "oc", 7.5703), ("mysql", "cc", 7.5816), ("hive", "oc", 7.5703), ("hive", "cc", 7.5816),
        ("rollup", "oc", 0.63), ("rollup", "cc", 0.63), ("dense", "cc", 0.63),
        ("zero", "oc", 7.570), ("zero", "cc", 7.581),
    ],
)
def test_year_cell_of_each_flavour(spark, flavour, mode, year_cell):
    row = growth_report(bars_2012(spark), flavour, mode).first()
    assert round(row[13], 4) == year_cell


def half_up(value, digits):
    return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def plain_report(bars, flavour, mode):
    """The year table by hand, with exact fractions where cells are rounded early."""
    spec = FLAVOURS[flavour]
    rates, before = {}, None
    for year, month, open_, close in sorted(bars):
        base = open_ if mode == "oc" else (open_ if before is None else before)
        before = close
        rate = (close / base - 1) * 100
        if spec.price[-1] != "double":
            rate = half_up((Decimal(repr(close)) / Decimal(repr(base)) - 1) * 100, 9)
        if spec.rate_digits is not None:
            rate = half_up(Decimal(repr(rate)), spec.rate_digits)
        rates[year, month] = rate
    years = sorted({y for y, _ in rates})
    zero = 0.0 if spec.number == "double" else Decimal(0)
    table = {}
    for year in years:
        cells = [rates.get((year, m), zero if spec.zero_first else None) for m in range(1, 13)]
        there = [c for c in cells if c is not None]
        whole = sum(there, zero)
        table[year] = cells + [
            {
                "present_sum": whole,
                "strict_sum": whole if len(there) == 12 else None,
                "present_mean": whole / len(there) if there else None,
            }[spec.year_rule]
        ]

    def mean(values):
        values = [v for v in values if v is not None]
        return sum(values, zero) / len(values) if values else None

    summary = [mean([row[i] for row in table.values()]) for i in range(13)]
    if spec.corner_from_row:
        summary[12] = mean(summary[:12])
    out = []
    for name, row in [*((str(y), table[y]) for y in years), (spec.summary_text, summary)]:
        row = row[:12] + [row[12] / spec.year_divisor if row[12] is not None and spec.year_divisor != 1 else row[12]]
        done = []
        for value in row:
            if value is not None and spec.cell_digits is not None:
                value = half_up(value if isinstance(value, Decimal) else Decimal(repr(value)), spec.cell_digits)
            done.append(0.0 if value is None and spec.zero_last else None if value is None else float(value))
        out.append([name, *done])
    return out


def random_bars(seed):
    """Prices that give rates with few digits, so that means fall on exact halves."""
    rng = random.Random(seed)
    rows = []
    for year in range(2001, 2001 + rng.randint(2, 8)):
        for month in range(1, 13):
            if rng.random() < 0.85:
                rows.append((year, month, 100.0, 100.0 + rng.randint(-300, 300) / 100))
    return rows


@pytest.mark.parametrize("flavour", sorted(FLAVOURS))
@pytest.mark.parametrize("seed", [1, 2])
def test_reports_match_plain_python(spark, flavour, seed):
    rows = random_bars(seed)
    for mode in ("oc", "cc"):
        found = [list(r) for r in growth_report(bars_frame(spark, rows), flavour, mode).collect()]
        expected = plain_report(rows, flavour, mode)
        assert [r[0] for r in found] == [r[0] for r in expected]
        for left, right in zip(found, expected):
            for a, b in zip(left[1:], right[1:]):
                assert (a is None and b is None) or a == pytest.approx(b, abs=1e-9), (left, right)


def test_sql_form_equals_rollup_form(spark):
    bars = bars_frame(spark, random_bars(5))
    for mode in ("oc", "cc"):
        assert growth_report_sql(bars, mode).collect() == growth_report(bars, "rollup", mode).collect()


def test_unknown_mode_or_flavour_is_refused(spark):
    bars = bars_2012(spark)
    for call in (
        lambda: growth_report(bars, "mysql", "xx"),
        lambda: growth_report(bars, "other", "oc"),
        lambda: growth_rates_sql(bars, "xx"),
    ):
        with pytest.raises(ValueError):
            call()


def test_zero_base_gives_null(spark):
    row = growth_report(bars_frame(spark, [(2020, 1, 0.0, 5.0), (2020, 2, 1.0, 2.0)]), "mysql").first()
    assert row.January is None and row.February == 100.0 and row.total == 100.0


def test_report_per_instrument(spark):
    one, two = random_bars(8), random_bars(9)
    rows = [("a", *r) for r in one] + [("b", *r) for r in two]
    bars = spark.createDataFrame(rows, "name string, year int, month int, open double, close double")
    for mode in ("oc", "cc"):
        both = growth_report(bars, "zero", mode, keys=["name"]).collect()
        alone = [
            (name, *r)
            for name, rows in (("a", one), ("b", two))
            for r in growth_report(bars_frame(spark, rows), "zero", mode).collect()
        ]
        assert [tuple(r) for r in both] == alone


def test_week_report_counts_saturday_in_the_total_only(spark):
    # 2020-06-05 is a Friday; rates are 10, 20, 30 and 50 percent.
    rows = [("2020-06-05", 100, 110), ("2020-06-06", 100, 120), ("2020-06-07", 100, 130), ("2021-06-06", 100, 150)]
    report = week_report(B.bars(ticks_frame(spark, rows), DAY), "oc")
    assert report.columns == ["month", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Sunday", "total"]
    row = report.first()
    assert row.month == "June" and row.Monday is None
    assert row.Friday == pytest.approx(10) and row.Sunday == pytest.approx(40)
    assert row.total == pytest.approx((10 + 20 + 40) / 3)


def test_week_report_close_to_close(spark):
    rows = [("2020-06-01", 100, 110), ("2020-06-02", 100, 121)]
    row = week_report(B.bars(ticks_frame(spark, rows), DAY), "cc").first()
    assert row.Monday == pytest.approx(10) and row.Tuesday == pytest.approx(10)
