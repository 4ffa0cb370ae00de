"""Shape of a corpus of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUB_KEYS = 5  # fixed values: how many member names a sample shows
ITEM_KEYS = 10


def _members(value: Column) -> Column:
    """Member names of an object, NULL for anything else."""
    return F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _listed(names: Column, most: int) -> Column:
    return F.array_join(F.slice(names, 1, most), ", ")


def json_key_profile(documents: DataFrame, column: str = "body") -> DataFrame:
    """Per top-level key and kind: documents, smallest and largest size, and a sample.

    Kind is ``dict``, ``list`` or ``scalar``. Size counts members or elements and is NULL for scalars. The
    sample names the first members of a dict, the members of a list's first element, or a scalar's type.
    Malformed documents are skipped. Tasks aggregate before the shuffle, which carries keys, not documents.
    """
    value = F.col("_v")
    fields = documents.select(F.explode(F.from_json(column, "map<string,variant>")).alias("key", "_v"))
    opened = fields.select("key", "_v", _members(value).alias("_names"), _elements(value).alias("_elements"))
    is_dict, is_list = F.col("_names").isNotNull(), F.col("_elements").isNotNull()
    described = opened.select(
        "key",
        F.when(is_dict, "dict").when(is_list, "list").otherwise("scalar").alias("kind"),
        F.when(is_dict, F.size("_names")).when(is_list, F.size("_elements")).alias("_size"),
        F.when(is_dict, _listed(F.col("_names"), SUB_KEYS))
        .when(is_list, _listed(_members(F.get("_elements", 0)), ITEM_KEYS))
        .otherwise(F.lower(F.schema_of_variant(value)))
        .alias("_sample"),
    )
    return described.groupBy("key", "kind").agg(
        F.count(F.lit(1)).alias("documents"),
        F.min("_size").alias("min_size"),
        F.max("_size").alias("max_size"),
        F.min("_sample").alias("sample"),
    )
