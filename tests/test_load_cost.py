"""What the load costs per row: methods the JVM compiles, staging rows not multiplied."""

from pyspark.sql import functions as F

from tradewh.functions.numeric import parse_decimal, parse_money, to_money
from tradewh.functions.text import SPACE_SEPARATORS, norm_text, unicode_trim
from tradewh.operators.codegen import FIELDS, HOTSPOT, LIMIT, NARROW, compiled_methods
from tradewh.plans import dims, warehouse
from tradewh.schemas import RAW_COLUMNS


def _raw(spark, *rows):
    """Raw rows from the given columns, NULL elsewhere."""
    schema = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], schema)


def test_limit_is_put_back(spark):
    before = spark.conf.get(LIMIT)
    try:
        with compiled_methods(spark), compiled_methods(spark):
            assert int(spark.conf.get(LIMIT)) == HOTSPOT
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(LIMIT) == before


def test_load_types_staging_in_compiled_methods(spark, tmp_path, monkeypatch):
    seen, write = {}, warehouse.write_parquet

    def noted(df, path, **kw):
        seen[path.rsplit("/", 1)[1]] = int(spark.conf.get(LIMIT))
        return write(df, path, **kw)

    monkeypatch.setattr(warehouse, "write_parquet", noted)
    raw = _raw(spark, {"OFICIALIZACION": "2025-03-01", "FOB DOLAR": "10,5", "POSICION": "a"})
    wh = warehouse.Warehouse.load(spark, raw, str(tmp_path), cutoff="2025-01-01")
    assert seen[warehouse.STAGING] == HOTSPOT and wh.fact.count() == 1


def test_dimensions_do_not_multiply_staging_rows(spark, monkeypatch):
    plans, keep = {}, dims.materialize

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, label)

    monkeypatch.setattr(dims, "materialize", noted)
    cols = ["aduana", "posicion", "pais_origen", "pais_procedencia_destino", "operacion", "regimen", *dims._PRODUCT_ATTRS]
    schema = ", ".join(f"{c} string" for c in cols) + ", oficializacion date"
    stg = spark.createDataFrame([("A", "P", "X", "Y", None, "R", "r1", "c", None, "d")] * 2 + [("B", "P", "X", None, None, "R", "r2", None, None, None)],
                                ", ".join(f"{c} string" for c in cols)).withColumn("oficializacion", F.lit("2025-03-01").cast("date"))
    assert stg.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    built = dims.build_dims(stg)
    assert "Generate" not in plans["dim-members"]
    assert {n: d.count() for n, d in built.items()} == {
        "dim_fecha": 1, "dim_aduana": 2, "dim_producto": 1, "dim_pais_origen": 1, "dim_pais_destino": 1, "dim_operacion": 0, "dim_regimen": 1}
    assert built["dim_producto"].first().asDict() == {
        "producto_key": 1, "rubro": "r2", "capitulo": "c", "partida": None, "posicion": "P", "descripcion_arancelaria": "d"}


def test_wide_projections_leave_whole_stage_code(spark):
    wide, narrow = ([F.concat(F.lit(f"{i} "), F.col("id").cast("string")).alias(f"c{i}") for i in range(n)] for n in (len(RAW_COLUMNS), NARROW))
    top = lambda cols: spark.range(9).select(*cols)._jdf.queryExecution().executedPlan().toString().lstrip()
    before = spark.conf.get(FIELDS)
    with compiled_methods(spark):
        assert top(wide).startswith("Project") and top(narrow).startswith("*(1) Project")
    assert spark.conf.get(FIELDS) == before


def test_texts_that_need_no_trim_are_not_trimmed(spark):
    ends = ["", "!", "~", "\x7f", "\u0080", "\x1f", "\t", "\n", "Ñ", *SPACE_SEPARATORS]
    texts = [None, *{a + m + b for a in ends for b in ends for m in ("", "ab", "a b")}]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert df.where(~norm_text("s").eqNullSafe(F.upper(unicode_trim("s")))).count() == 0
    plan = df.select(norm_text("s").alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and plan.count("trim(") == 1


def test_money_of_odd_texts(spark):
    texts = ["1,005", "1.005", "1.00", "1.", ".", ",5", "1.2.3", "1e2", "1E-3", "1e20", "123456789012,34", "1234567890123,456", "", " 7,5 ", "7300,5", "-0,015"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert df.where(~parse_money("s").eqNullSafe(to_money(parse_decimal("s")))).count() == 0


def test_money_becomes_cents_once_per_fact_row(wh):
    """Below the Expand of the grouping sets, which has three rows for each of the fact's."""
    from tradewh.plans import marts

    lines = marts.mart_groups(wh)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(k for k, ln in enumerate(lines) if "Expand [" in ln)
    times = [k for k, ln in enumerate(lines) if "* 100" in ln]
    assert times and min(times) > at


def test_sums_of_cents_of_either_sign(spark):
    from decimal import Decimal

    from tradewh.functions.numeric import cents, from_cents, sum_cents, sum_money

    most = Decimal("9999999999999999.99")
    values = [most, most, -most, Decimal("-0.01"), Decimal("-10485.76"), Decimal("0.07"), Decimal("-10995116277.77"), None]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(18,2)")
    got = df.agg(sum_money("x"), sum_cents(cents("x")), from_cents(F.min(cents("x"))), from_cents(F.max(cents("x")))).first()
    assert tuple(got) == (sum(v for v in values if v is not None),) * 2 + (-most, most)
