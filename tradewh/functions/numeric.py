"""Number parsing, money typing and arithmetic helpers.

Typing policy (kept identical in the SQL oracle):
* money is DECIMAL(18,2) in tables and summed as DECIMAL (exact, order-free);
* averages and ratios are DOUBLE, computed as ``double(sum) / count``;
* ``ROUND(double, n)`` scales, rounds half away from zero and unscales.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tradewh.functions._util import col

# A plain number with either decimal separator, optional exponent. Rejects
# 'nan', 'inf', type suffixes ('12.5d') and thousands separators.
NUM_PATTERN = r"^\s*[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?\s*$"
_DOT_NUM_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

MONEY = "decimal(18,2)"


def parse_decimal(c: Column | str) -> Column:
    """Decimal-comma text -> DOUBLE, NULL when not a number."""
    c = col(c)
    return F.when(c.rlike(NUM_PATTERN), F.replace(c, F.lit(","), F.lit(".")).try_cast("double"))


def parse_money(c: Column | str) -> Column:
    """Decimal-comma text -> DECIMAL(18,2), NULL when not a number or out of range (P2 + P9).

    The value is that of the DOUBLE the text stands for, scaled to cents and
    rounded half away from zero ('1,005' is 1.00, as 100.49999... cents are).
    Texts of up to 15 characters with at most two decimals and no exponent come
    out the same when parsed straight to DECIMAL, which is cheaper; that parser
    rejects 'nan', 'inf', type suffixes and thousands separators by itself.
    """
    t = F.replace(col(c), F.lit(","), F.lit("."))
    # A dot before the last three characters; CONTAINS compares bytes, INSTR a slice at every place.
    many_decimals = F.substring(t, 1, F.length(t) - 3).contains(".")
    odd = (F.length(t) > 15) | many_decimals | t.contains("e") | t.contains("E")
    return F.when(odd, to_money(parse_decimal(c))).otherwise(t.try_cast(MONEY))


def parse_money_strict(c: Column | str) -> Column:
    """Decimal-point text -> DECIMAL(18,2) through DOUBLE; a comma makes it NULL (legacy P3)."""
    return F.when(F.instr(col(c), ",") == 0, parse_money(c))


def parse_double(c: Column | str) -> Column:
    """Decimal-point text -> DOUBLE without comma repair."""
    c = col(c)
    return F.when(c.rlike(_DOT_NUM_PATTERN), c.try_cast("double"))


def parse_int(c: Column | str) -> Column:
    """Integer text -> INT; '12.5' -> 13, '2025.0' -> 2025, junk -> NULL."""
    c = col(c)
    d = F.when(c.rlike(_DOT_NUM_PATTERN), c.try_cast("double"))
    return F.round(d, 0).try_cast("int")


def to_money(c: Column | str) -> Column:
    """DOUBLE -> DECIMAL(18,2), scaled and rounded half away from zero; out of range -> NULL."""
    return from_cents(F.round(col(c).cast("double") * 100.0, 0).try_cast("bigint"))


def to_double(c: Column | str) -> Column:
    return col(c).cast("double")


def round_half_away(c: Column | str, n: int) -> Column:
    """``ROUND(x, n)`` on a DOUBLE: scale, round half away from zero, unscale."""
    scale = float(10 ** n)
    return F.round(col(c).cast("double") * scale, 0) / scale


def safe_div(num: Column | str, den: Column | str) -> Column:
    """DOUBLE division; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def abs_change(x: Column | str, prev: Column | str) -> Column:
    """``x - prev``."""
    return col(x) - col(prev)


def pct_change(x: Column | str, prev: Column | str) -> Column:
    """``(x - prev) * 100 / NULLIF(prev, 0)`` as DOUBLE."""
    return safe_div((col(x) - col(prev)).cast("double") * 100.0, prev)


def to_millions(c: Column | str) -> Column:
    """Scale to millions as DOUBLE."""
    return col(c).cast("double") / 1e6


def subitem_value(price: Column | str, qty: Column | str) -> Column:
    """``precio_unitario_subitem * cantidad_subitem`` typed as money."""
    return (col(price) * col(qty)).try_cast(MONEY)


def cents(c: Column | str) -> Column:
    """A DECIMAL(18,2) as BIGINT cents."""
    return (col(c) * F.lit(100)).cast("long")


def from_cents(c: Column | str) -> Column:
    """BIGINT cents of up to 18 digits as DECIMAL(18,2)."""
    return (col(c).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).try_cast(MONEY)


#: Bits of a limb of ``sum_cents``.
_LIMB = 20


def sum_cents(c: Column | str) -> Column:
    """Exact ``SUM`` of BIGINT cents of up to 18 digits, as DECIMAL(38,2).

    The cents are added as three BIGINT limbs of 20 bits (the highest with the
    sign) — faster than DECIMAL arithmetic, which Spark runs on BigDecimal — and put
    together once per group. No limb can overflow below eight trillion rows per
    group, whatever the values and the session's ANSI setting.
    """
    c, mask = col(c), F.lit((1 << _LIMB) - 1).cast("long")
    limbs = [F.shiftright(c, 2 * _LIMB), F.shiftright(c, _LIMB).bitwiseAND(mask), c.bitwiseAND(mask)]
    total = None
    for limb, bits in zip(limbs, (2 * _LIMB, _LIMB, 0)):
        part = F.sum(limb).cast("decimal(20,0)") * F.lit(Decimal(1 << bits).scaleb(-2)).cast("decimal(15,2)")
        total = part if total is None else total + part
    return total.cast("decimal(38,2)")


def sum_money(c: Column | str) -> Column:
    """Exact ``SUM`` of a DECIMAL(18,2) column, as DECIMAL(38,2) (see ``sum_cents``)."""
    return sum_cents(cents(c))
