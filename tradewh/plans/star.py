"""Star join of the fact with some of its dimensions.

Inner joins on surrogate keys. Spark broadcasts a dimension by its size in
bytes, and the joins then run inside the fact scan's tasks; the only shuffle in
a mart is the one that follows, carrying partial aggregates. Fact rows whose key is NULL or
unknown drop out, as with any inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The fact's partition column: the year of the date key.
FACT_PARTITION = "fecha_anio"

# dimension -> (key, attributes brought into the star; (name, alias) renames)
DIM_ATTRS = {
    "dim_fecha": ("fecha_key", ["anio", "mes_numero", "mes_nombre", "trimestre", "semestre"]),
    "dim_operacion": ("operacion_key", ["tipo_operacion"]),
    "dim_pais_origen": ("pais_origen_key", ["pais_origen_desc"]),
    "dim_pais_destino": ("pais_destino_key", [("pais_desc_desc", "pais_destino_desc")]),
    "dim_aduana": ("aduana_key", ["nombre_aduana"]),
    "dim_producto": ("producto_key", ["rubro", "capitulo", "posicion", "descripcion_arancelaria"]),
    "dim_regimen": ("regimen_key", ["codigo_regimen"]),
}


def star(wh, dims: list[str], fact: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """The fact joined with the named dimensions.

    The date dimension is joined by its key and by the fact's partition column
    (the year, which the key determines): a filter on the year reaches the scan
    as a partition filter, one on other date attributes as a dynamic one.
    """
    f = fact if fact is not None else wh.fact_by_year
    for name in dims:
        key, attrs = DIM_ATTRS[name]
        cols = [F.col(a[0]).alias(a[1]) if isinstance(a, tuple) else F.col(a) for a in attrs]
        d = wh.dim(name).select(F.col(key).alias(f"_{key}"), *cols)
        on = f[key] == d[f"_{key}"]
        if name == "dim_fecha" and FACT_PARTITION in f.columns:
            on = on & (f[FACT_PARTITION] == d["anio"])
        f = f.join(d, on, how).drop(f"_{key}")
    return f.drop(FACT_PARTITION)
