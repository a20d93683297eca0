"""The text normalisers as functions of the catalog, for SQL users.

SQL functions are inlined by the analyzer, so a query that calls them plans like
one that spells them out. They are stored in the catalog beside the tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradewh.functions.text import CHANNEL_UNKNOWN, CHANNELS, ISO_PREFIX, ISO_PREFIX_MATCH, SPACE_SEPARATORS

_TRIM = f"trim(BOTH '{SPACE_SEPARATORS}' FROM {{}})"

#: Name -> parameters, result and body, in an order in which each knows those it calls.
SQL_FUNCTIONS = {
    "norm_text": f"(s STRING) RETURNS STRING COMMENT 'trimmed and in capitals' RETURN upper({_TRIM.format('s')})",
    "normalizar_pais": f"""(p STRING, solo_primero BOOLEAN DEFAULT false) RETURNS STRING
        COMMENT 'country without ISO prefix, blanks collapsed (only the first run if solo_primero)'
        RETURN CASE
            WHEN {{schema}}.norm_text(p) RLIKE r'{ISO_PREFIX_MATCH}'
                THEN {_TRIM.format(f"regexp_replace({{schema}}.norm_text(p), r'{ISO_PREFIX}', '')")}
            WHEN solo_primero
                THEN {_TRIM.format(f"regexp_replace({{schema}}.norm_text(p), r'^(.*?)\\s+(.*)$', '$1 $2')")}
            ELSE {_TRIM.format(f"regexp_replace({{schema}}.norm_text(p), r'\\s+', ' ')")} END""",
    "decode_canal": "(c STRING) RETURNS STRING COMMENT 'name of a control channel' RETURN CASE c "
                    + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in CHANNELS.items()) + f" ELSE '{CHANNEL_UNKNOWN}' END",
}


def register_functions(spark: SparkSession, schema: str = "dw") -> list[str]:
    """Create or replace the functions in a schema that exists."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {schema}.{name}{body.replace('{schema}', schema)}")
    return [f"{schema}.{name}" for name in SQL_FUNCTIONS]
