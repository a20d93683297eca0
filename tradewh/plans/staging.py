"""Staging load (L2): type, clean and filter the raw extract.

One narrow pass (project + filter) over the raw data: no shuffle. The two
filters test *parsed* strings, so they cannot reach the Parquet reader as
pushed filters; the columns read are pruned to those the load uses.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from tradewh.functions.dates import parse_date
from tradewh.functions.numeric import parse_decimal, parse_int, parse_money, parse_money_strict
from tradewh.functions.text import norm_text, normalize_country, repair_enye
from tradewh.schemas import STAGING_SOURCES

# The reference keeps declarations officialised on or after this day.
DEFAULT_CUTOFF = "2025-01-01"


def new_batch_id(now: _dt.datetime | None = None) -> str:
    """``BATCH_YYYYMMDD_HHMMSS``."""
    return f"BATCH_{(now or _dt.datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def _typed(source: str, kind: str, legacy: bool) -> Column:
    c = F.col(f"`{source}`")
    if kind == "text":
        return norm_text(c)
    if kind == "money":
        return parse_money(c)
    if kind == "qty":
        return parse_money_strict(c) if legacy else parse_money(c)
    if kind == "int":
        return parse_int(c)
    if kind == "date":
        return parse_date(c)
    if kind == "country":
        return normalize_country(repair_enye(c), first_only=legacy)
    if kind == "raw":
        return c
    raise ValueError(kind)


def typed_columns(legacy: bool = False) -> list[Column]:
    return [_typed(src, kind, legacy).alias(tgt) for tgt, src, kind in STAGING_SOURCES]


def build_staging(raw: DataFrame, cutoff: str = DEFAULT_CUTOFF, batch_id: str | None = None,
                  legacy: bool = False, load_ts: Column | None = None) -> DataFrame:
    """Typed, cleaned staging rows (50 columns).

    Filters: officialisation date (parsed) >= ``cutoff`` (F1) and FOB (parsed,
    before typing to 2 decimals) > 0 (F2); NULLs fail both.
    ``legacy=True`` keeps the reference's observed quirks: quantity without
    decimal-comma repair and only the first whitespace run collapsed.
    """
    batch = batch_id or new_batch_id()
    keep = (parse_date(F.col("OFICIALIZACION")) >= F.lit(cutoff).cast("date")) & (
        parse_decimal(F.col("`FOB DOLAR`")) > 0
    )
    return raw.where(keep).select(
        *typed_columns(legacy),
        F.lit(batch).alias("batch_id"),
        (load_ts if load_ts is not None else F.current_timestamp()).alias("fecha_carga"),
        F.lit(None).cast("string").alias("archivo_origen"),
    )


def staging_rejects(raw: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Why raw rows did not reach staging, in one aggregate pass.

    Columns: rows_in, bad_date (unparseable), before_cutoff, fob_not_positive
    (unparseable, zero or negative, among rows that pass the date test),
    money_out_of_range (kept rows with a number that does not fit DECIMAL(18,2)
    in any money column), rows_out.
    """
    d = parse_date(F.col("OFICIALIZACION"))
    fob = parse_decimal(F.col("`FOB DOLAR`"))
    date_ok = d >= F.lit(cutoff).cast("date")
    fob_ok = fob > 0
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(d.isNull()).alias("bad_date"),
        F.count_if(d < F.lit(cutoff).cast("date")).alias("before_cutoff"),
        F.count_if(F.coalesce(date_ok, F.lit(False)) & ~F.coalesce(fob_ok, F.lit(False))).alias("fob_not_positive"),
        F.count_if(F.coalesce(date_ok & fob_ok, F.lit(False)) & _any(
            [F.col(f"`{src}`") for _, src, kind in STAGING_SOURCES if kind in ("money", "qty")], _out_of_range))
        .alias("money_out_of_range"),
        F.count_if(F.coalesce(date_ok & fob_ok, F.lit(False))).alias("rows_out"),
    )


def _out_of_range(c: Column) -> Column:
    """A number that doesn't fit DECIMAL(18,2): it has more than 15 characters or an
    exponent, which few texts have, so that few are parsed."""
    long_or_exp = (F.length(c) > 15) | (F.instr(c, "e") > 0) | (F.instr(c, "E") > 0)
    return long_or_exp & parse_decimal(c).isNotNull() & parse_money(c).isNull()


def _any(values: list[Column], test) -> Column:
    return F.exists(F.array(*values), test)


def typed_rejects(raw: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Values that typing turned into NULL, per typed column, over the rows that
    reach staging: ``column_name, rejected``, in one aggregate pass."""
    typed = [(tgt, src, kind) for tgt, src, kind in STAGING_SOURCES if kind in ("money", "qty", "int", "date")]
    kept = raw.where((parse_date(F.col("OFICIALIZACION")) >= F.lit(cutoff).cast("date"))
                     & (parse_decimal(F.col("`FOB DOLAR`")) > 0))
    counts = kept.agg(*[
        F.count_if(F.col(f"`{src}`").isNotNull() & _typed(src, kind, False).isNull()).alias(tgt) for tgt, src, kind in typed])
    pairs = ", ".join(f"'{tgt}', `{tgt}`" for tgt, _, _ in typed)
    return counts.selectExpr(f"stack({len(typed)}, {pairs}) AS (column_name, rejected)")
