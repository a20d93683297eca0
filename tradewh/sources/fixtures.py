"""Adapter: the driver's TPC-H-like tables -> the raw declaration-item extract.

One lineitem row is one declaration item. The extract is built with joins only
(orders, customer and its nation, supplier and its nation, part), so its size
grows with the fixture tables. Dirty values are planted on purpose so that every
clean-up step has work to do: bad dates, decimal commas, ISO prefixes, corrupt
'Ñ', double spaces, mixed case, NULL keys, unknown channel codes, FOB = 0,
integer text with '.0', quantities with a comma, dates with '/', with a time and
with junk behind them, non-breaking blanks, sub-cent prices and quantities, numbers out of range,
a third kind of operation, NULL operations, offices and positions.

Join strategy: customers are joined to the orders first, so that lineitem, the
largest table, meets orders with customers, parts and suppliers in three joins
only. AQE broadcasts a side at run time when its measured size is under the
threshold; suppliers, the smallest of the three, come last, since the items carry
their texts through no shuffle then. nation has a fixed size of 25 rows and is
hinted; items carry its keys until all other joins are done. Texts that depend on an order,
part, supplier or country alone are made there, numbers that several columns share
once per item. The driving lineitem scan is spread over
the cluster's cores when the file has fewer splits than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewh.operators.parallelism import spread
from tradewh.schemas import RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _comma(x: Column) -> Column:
    """Decimal text with a comma separator, as the source system writes money."""
    return F.replace(x.cast("string"), F.lit("."), F.lit(","))


def _money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def _dirty_country(key: Column, name: Column) -> Column:
    """Four spellings of one country, chosen by its key."""
    variant = key % 4
    return (
        F.when(variant == 0, F.concat(F.lit("BR - "), name))
        .when(variant == 1, F.concat(F.lit("espa\\a  sur  "), key.cast("string")))
        .when(variant == 2, F.concat(F.lit("  "), F.lower(name), F.lit(" ")))
        .otherwise(name)
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw extract with the 47 source columns, all strings."""
    # What the items carry through the joins: numbers in the form that the columns ask for.
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
        _money(F.col("l_extendedprice")).alias("price"), _money(F.col("l_quantity")).alias("qty"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"), F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_shipdate").cast("date").alias("ship_date")))
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation")
    country = _dirty_country(F.col("n_nationkey"), F.col("n_name"))
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("cn_key"), country.alias("bought_in")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("sn_key"), country.alias("origin")))

    bought = orders.join(customer, F.col("o_custkey") == customer.c_custkey).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 53 == 0, F.lit(None).cast("string")).otherwise(F.lower(F.col("o_orderpriority"))).alias("regime"),
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("c_nationkey"), (F.col("c_custkey") % 61 == 0).alias("undisclosed"))
    brand, kind = F.col("p_brand"), F.col("p_type")
    goods = part.select(
        "p_partkey", "p_type", "p_brand", F.concat(brand, F.lit(" "), F.col("p_size").cast("string")).alias("heading"), "p_name",
        F.when(F.col("p_partkey") % 59 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower(brand), F.lit("."), F.lower(kind))).alias("position"),
        _comma(_money(F.col("p_retailprice"))).alias("unit_price"))
    sellers = supplier.select(
        "s_suppkey", "s_nationkey",
        F.when(F.col("s_suppkey") % 47 == 0, F.lit(None).cast("string")).otherwise(F.lower(F.col("s_name"))).alias("office"))

    j = (
        li.join(bought, li.l_orderkey == F.col("o_orderkey"))
        .join(goods, F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(sn, F.col("s_nationkey") == F.col("sn_key"))
        .join(cn, F.col("c_nationkey") == F.col("cn_key"))
    )
    rates = {"derecho": ("0.12", "decimal(3,2)"), "isc": ("0.02", "decimal(3,2)"), "iva": ("0.10", "decimal(3,2)")}
    j = j.select("*", F.col("qty").cast("string").alias("qty_text"), _comma(F.col("price")).alias("price_comma"),
                 *[_money(F.col("price") * F.lit(float(rate)).cast(kind)).alias(name) for name, (rate, kind) in rates.items()])

    ok = F.col("l_orderkey")
    price, qty, derecho, isc, iva, ship_date = map(F.col, ("price", "qty", "derecho", "isc", "iva", "ship_date"))
    price_comma, qty_comma = F.col("price_comma"), _comma(F.col("qty_text"))
    zero = F.lit("0,00")

    cols = {
        "DESPACHO CIFRADO": F.concat(F.lit("d"), ok.cast("string")),
        "OPERACION": F.when(ok % 107 == 0, F.lit(None).cast("string"))
        .when(ok % 103 == 0, F.lit("tránsito"))
        .when(F.col("l_linestatus") == "F", F.lit(" importacion ")).otherwise(F.lit("Exportacion")),
        "DESTINACION": F.lit("\u00a0consumo "),
        "REGIMEN": F.col("regime"),
        "OFICIALIZACION": F.when(ok % 211 == 0, F.lit("S/D"))
        .when(ok % 223 == 0, F.concat(ship_date.cast("string"), F.lit(" aprox.")))
        .when(ok % 229 == 0, F.concat(ship_date.cast("string"), F.lit("T")))
        .when(ok % 13 == 0, F.replace(ship_date.cast("string"), F.lit("-"), F.lit("/")))
        .when(ok % 17 == 0, F.concat(ship_date.cast("string"), F.lit(" 10:15:00")))
        .otherwise(ship_date.cast("string")),
        "CANCELACION": F.col("ordered").cast("string"),
        "AÑO": F.concat(F.year(ship_date).cast("string"), F.when(ok % 7 == 0, F.lit(".0")).otherwise(F.lit(""))),
        "MES": F.month(ship_date).cast("string"),
        "ADUANA": F.col("office"),
        "COTIZACION": F.lit("7300,5"),
        "MEDIO TRANSPORTE": F.lit(" terrestre"),
        "CANAL": F.when(ok % 97 == 0, F.lit(None).cast("string"))
        .when(ok % 101 == 0, F.lit("x"))
        .when(F.col("l_returnflag") == "A", F.lit(" v"))
        .otherwise(F.lower(F.col("l_returnflag"))),
        "ITEM": F.col("l_linenumber").cast("string"),
        "PAIS ORIGEN": F.col("origin"),
        "PAIS PROCEDENCIA/DESTINO": F.when(F.col("undisclosed"), F.lit(None).cast("string")).otherwise(F.col("bought_in")),
        "USO": F.lit(None).cast("string"),
        "UNIDAD MEDIDA ESTADISTICA": F.lit("kg"),
        "CANTIDAD ESTADISTICA": qty_comma,
        "KILO NETO": qty_comma,
        "KILO BRUTO": _comma(_money(qty * F.lit(1.1).cast("decimal(2,1)"))),
        "FOB DOLAR": F.when(ok % 89 == 0, zero).otherwise(price_comma),
        "FLETE DOLAR": _comma(_money(price * F.col("discount"))),
        "SEGURO DOLAR": _comma(_money(price * F.col("tax"))),
        "IMPONIBLE DOLAR": price_comma,
        "IMPONIBLE GS": F.lit(None).cast("string"),
        "AJUSTE A INCLUIR": zero,
        "AJUSTE A DEDUCIR": zero,
        "POSICION": F.col("position"),
        "RUBRO": F.col("p_type"),
        "DESC CAPITULO": F.col("p_brand"),
        "DESC PARTIDA": F.col("heading"),
        "DESC POSICION": F.col("p_name"),
        "MERCADERIA": F.col("p_name"),
        "MARCA ITEM": F.col("p_brand"),
        "ACUERDO": F.lit(None).cast("string"),
        "NUMERO SUBITEM": F.col("l_linenumber").cast("string"),
        "CANTIDAD SUBITEM": F.concat(F.when(ok % 10 == 0, qty_comma).otherwise(F.col("qty_text")),
                                     F.when(ok % 11 == 0, F.lit("5")).otherwise(F.lit(""))),
        "PRECION UNITARIO SUBITEM": F.concat(F.col("unit_price"), F.when(ok % 3 == 0, F.lit("5")).otherwise(F.lit(""))),
        "DESC SUBITEM": F.lit(None).cast("string"),
        "MARCA SUBITEM": F.lit(None).cast("string"),
        "DERECHO": _comma(derecho),
        "ISC": _comma(isc),
        "SERVICIO": F.when(ok % 227 == 0, F.lit("1e20")).otherwise(zero),
        "RENTA": zero,
        "IVA": _comma(iva),
        "OTROS": zero,
        "TOTAL": _comma(derecho + isc + iva),
    }
    return j.select(*[cols[c].alias(c) for c in RAW_COLUMNS])
