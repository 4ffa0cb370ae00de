from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, items: Column | str, into: str | tuple[str, str], *keep: Column | str) -> DataFrame:
    """One row per non-NULL element (or map entry); rows with an empty or NULL array disappear.

    The rows of ``explode`` without its NULL elements; but ``explode`` makes the optimizer add a ``size(..) > 0`` filter, which moves
    below the projection that parses the document and so parses every document once more per filter term.
    """
    names = (into,) if isinstance(into, str) else into
    return df.select(*keep, F.explode_outer(items).alias(*names)).filter(F.col(names[0]).isNotNull())


def element_columns(items: Column, prefix: str, count: int, fill: str | None = None) -> list[Column]:
    """``prefix1 .. prefixN`` from the first ``count`` elements; short or NULL arrays are padded."""
    def at(position: int) -> Column:
        element = F.get(items, position)
        return element if fill is None else F.coalesce(element, F.lit(fill))

    return [at(i).alias(f"{prefix}{i + 1}") for i in range(count)]


def struct_columns(items: Column, template: str, count: int, fields: Mapping[str, str]) -> list[Column]:
    """Numbered wide columns from an array of structs.

    ``fields`` maps output part to struct field; ``template`` is e.g. ``"tier{n}_{part}"``.
    """
    return [
        F.get(items, n)[source].alias(template.format(n=n + 1, part=part))
        for n in range(count)
        for part, source in fields.items()
    ]


def safe_size(items: Column) -> Column:
    """Element count, 0 for NULL under any ANSI or legacy size setting."""
    return F.when(items.isNull(), F.lit(0)).otherwise(F.size(items))


def array_text(items: Column, separator: str = ", ") -> Column:
    return F.coalesce(F.array_join(items, separator), F.lit(""))
