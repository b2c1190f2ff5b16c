"""SQL-callable versions of the reference's UDF / UDAF surface.

The scalar functions are registered as SQL functions (``CREATE TEMPORARY FUNCTION ...
RETURN <expr>``): Catalyst inlines their bodies, so they run as ordinary codegen'd
expressions with no Python in the loop. Spark has no SQL-bodied aggregate functions;
the distinct-concat aggregate is written in SQL as
``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)`` or, from Python, with
``visitlens.functions.group_concat_distinct`` (partially aggregated map-side).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v BIGINT, s STRING, sep STRING)
       RETURNS STRING
       RETURN concat(coalesce(CAST(v AS STRING), 'null'), sep, coalesce(s, 'null'))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION json_field(js STRING, field STRING)
       RETURNS STRING
       RETURN get_json_object(js, concat('$.', field))""",
]


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``concat_long_string`` and ``json_field`` for use in ``spark.sql``."""
    for ddl in _FUNCTIONS:
        spark.sql(ddl)
