"""JSON list -> rows, with a 1-based position (``WITH ORDINALITY``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.jsoncols import COMPANY_ARRAY


def explode_json_list(df: DataFrame, col: str, keep: list[str], element: str = "element",
                      position: str = "position", schema: str = COMPANY_ARRAY) -> DataFrame:
    """One row per list element; rows with an empty or NULL list disappear
    (an inner lateral join, not an outer one).  Narrow: no shuffle."""
    exploded = df.select(*keep, F.posexplode(F.from_json(F.col(col), schema)).alias("__pos", element))
    return exploded.select(*keep, (F.col("__pos") + 1).alias(position), element)


def explode_names(df: DataFrame, col: str, keep: list[str], name: str = "name",
                  position: str = "position") -> DataFrame:
    """Like ``explode_json_list`` but only the element's ``name`` (``obj->>'name'``)."""
    out = explode_json_list(df, col, keep, "__el", position)
    return out.select(*keep, position, F.col("__el.name").alias(name))
