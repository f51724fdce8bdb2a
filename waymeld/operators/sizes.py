"""Tables that hold more than Spark takes them to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame


def grown(df: DataFrame) -> DataFrame:
    """df, which joins sort and merge and never broadcast, whatever its estimated size.

    Spark sizes a table by that of its files and by its columns' types. It sees neither the rows that an explode makes
    nor the lengths of arrays, and would gather a table of millions of rows in the driver as a small one.
    """
    return df.hint("merge")
