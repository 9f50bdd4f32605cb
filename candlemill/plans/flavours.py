"""The five published ways of turning month rates into a year table.

They differ in rounding, in what an absent month counts as, and in how the last
column and the last row are built. The differences are kept on purpose.

Where cells are rounded after decimal or rounded rates, the arithmetic in between
is decimal as well: a mean such as 0.285 then rounds the same way whatever order
the rows arrive in.
"""

from __future__ import annotations

from dataclasses import dataclass

from candlemill.schemas import MONTHS_LONG, MONTHS_SHORT


@dataclass(frozen=True)
class Flavour:
    months: tuple[str, ...]
    #: heading of the last column
    year_column: str
    #: how the last column is formed: present_sum, strict_sum, present_mean
    year_rule: str
    #: first cell of the last row
    summary_text: str
    #: the last column is divided by this
    year_divisor: int = 1
    #: digits the rates are rounded to before anything else
    rate_digits: int | None = None
    #: digits of the finished cells
    cell_digits: int | None = None
    #: absent months are 0 in every step
    zero_first: bool = False
    #: absent months are 0 in the finished table only
    zero_last: bool = False
    #: the corner is the mean of the last row, not of the last column
    corner_from_row: bool = False
    #: open and close go through these types before the division
    price: tuple[str, ...] = ("double",)
    #: rates are summed and averaged in this type
    number: str = "double"


FLAVOURS = {
    "mysql": Flavour(
        months=tuple(MONTHS_LONG),
        year_column="total",
        year_rule="present_sum",
        summary_text="AVG",
    ),
    "hive": Flavour(
        months=tuple(m.lower() for m in MONTHS_SHORT),
        year_column="total",
        year_rule="strict_sum",
        summary_text="Total",
        cell_digits=4,
        price=("decimal(10,4)",),
        number="decimal(24,9)",
    ),
    "rollup": Flavour(
        months=tuple(MONTHS_SHORT),
        year_column="AVG",
        year_rule="strict_sum",
        year_divisor=12,
        summary_text="AVG",
        rate_digits=2,
        cell_digits=2,
        number="decimal(16,3)",
    ),
    "dense": Flavour(
        months=tuple(MONTHS_SHORT),
        year_column="AVG",
        year_rule="present_mean",
        summary_text="AVG",
        cell_digits=2,
        zero_last=True,
        corner_from_row=True,
    ),
    "zero": Flavour(
        months=tuple(MONTHS_SHORT),
        year_column="TOTAL",
        year_rule="present_sum",
        summary_text="AVG",
        rate_digits=3,
        cell_digits=3,
        zero_first=True,
        price=("decimal(10,3)", "double"),
        number="decimal(16,3)",
    ),
}
