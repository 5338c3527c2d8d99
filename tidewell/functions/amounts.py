"""Amount columns: annualising, ratios, bands, tiers, premium adjustment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import ColumnLike, col

MONEY = "decimal(18,2)"
PREMIUM = "decimal(24,4)"


def ape(premium: ColumnLike, mode: ColumnLike) -> Column:
    """Premium per year from the premium per payment; ``mode`` is months between payments."""
    return col(premium) * 12 / col(mode).cast("int")


def payments_per_year(mode: ColumnLike) -> Column:
    """Payments per year from the two-digit mode text; unknown modes count as monthly."""
    m = col(mode)
    return F.when(m == "12", 1).when(m == "06", 2).when(m == "03", 4).otherwise(12)


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient as double; null when the denominator is zero or either side is null."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def mean_of(c: ColumnLike) -> Column:
    """Mean from the exact sum, so that the result does not depend on the row order."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def band(c: ColumnLike, edges: Sequence, labels: Sequence[str], default: str | None = None) -> Column:
    """Label of the half-open range ``[edge, next edge)`` that holds the value.

    ``edges`` has one entry more than ``labels``; ``None`` at either end leaves it open.
    Values outside all ranges, and nulls, get ``default``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("band needs one edge more than labels")
    value = col(c)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = F.lit(True)
        if low is not None:
            test = value >= low
        if high is not None:
            test = (test & (value < high)) if low is not None else (value < high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.lit(default))


def value_map(c: ColumnLike, mapping: Mapping, default=None) -> Column:
    """Replace values by a small literal mapping; others become ``default``."""
    value = col(c)
    out = None
    for key, label in mapping.items():
        test = value == F.lit(key)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def vip_tier(premium: ColumnLike, silver_holds: Column, labels: Mapping[str, str] | None = None) -> Column:
    """Customer tier from the total premium; ``silver_holds`` is the extra test for Silver."""
    total = col(premium)
    names = labels or {}

    def name(tier: str) -> str:
        return names.get(tier, tier)

    return (
        F.when((total >= 20000) & (total < 65000) & silver_holds, name("Silver"))
        .when((total >= 65000) & (total < 150000), name("Gold"))
        .when((total >= 150000) & (total < 300000), name("Platinum"))
        .when(total >= 300000, name("Platinum Elite"))
        .otherwise(name("Not VIP"))
    )


def adjusted_premium(
    days: ColumnLike, mode: ColumnLike, premium: ColumnLike, full: ColumnLike, single: Column
) -> Column:
    """Yearly premium cut back for policies that ended within their first year.

    ``days`` is policy start to first end date (null while running). Up to 21 days counts
    nothing; under a year counts the payments that fell due; single-premium plans count a
    tenth of the premium. A null day count is never at most 21, so running policies are full.
    """
    d, m = col(days), col(mode).cast("int")
    # One decimal type throughout: mixed ones would be widened at the cost of digits.
    prem, total, none = (c.cast(PREMIUM) for c in (col(premium), col(full), F.lit(0)))
    due = (
        F.when(m == 3, F.floor(d / 92) + 1)
        .when(m == 6, F.floor(d / 183) + 1)
        .when(m == 1, F.floor(d / 31) + 1)
        .cast("int")
    )
    regular = (
        F.when(d <= 21, none)
        .when(d.isNull() | (d >= 365) | (m == 12) | due.isNull(), total)
        .otherwise((prem * due).cast(PREMIUM))
    )
    one_off = F.when(d <= 21, none).otherwise((prem * F.lit("0.1").cast("decimal(2,1)")).cast(PREMIUM))
    return F.when(single, one_off).otherwise(regular)


def owner_relation(same: Column, gap: ColumnLike, owner_sex: ColumnLike, insured_sex: ColumnLike) -> Column:
    """Relation of the insured to the owner, judged by age gap (owner minus insured) and sex.

    A missing gap or sex falls through to the sex test, where missing counts as different.
    """
    g = col(gap)
    differs = ~F.coalesce(col(owner_sex) == col(insured_sex), F.lit(False))
    return (
        F.when(same, "self")
        .when(g.between(18, 40), "child")
        .when(g > 40, "others")
        .when(g < -17, "parent")
        .when(differs, "spouse")
        .otherwise("others")
    )


def argmax_name(columns: Sequence[str]) -> Column:
    """Name of the column with the greatest value, the first one on ties; null if all are null."""
    top = F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])
    out = None
    for name in columns:
        test = F.col(name) == top
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def signed(amount: ColumnLike, flag: ColumnLike, plus: str = "C") -> Column:
    """Amount with its sign from a credit/debit flag; anything but ``plus`` is negative."""
    return F.when(col(flag) == plus, col(amount)).otherwise(-col(amount))
