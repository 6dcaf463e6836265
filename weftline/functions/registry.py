"""SQL-callable forms of the operators."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Define ``weft_chunks(text)``: a SQL table function, planned with the calling query.

    The generator reads the argument itself: from a subquery it would be joined back by its whole text.
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION weft_chunks(txt STRING)
        RETURNS TABLE(chunk_index INT, chunk_text STRING)
        RETURN SELECT pos, substr(txt, start + 1, 256)
               FROM posexplode(CASE WHEN length(txt) > 0
                        THEN sequence(0, length(txt) - 1, 224) ELSE array() END) AS s(pos, start)""")
