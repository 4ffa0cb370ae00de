from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"  # fixed value


def row_hash(columns: Sequence[str], strict: bool = False) -> Column:
    """SHA-256 over the text of the tracked attributes.

    The default joins the texts with ``||`` and reads NULL as ''; it cannot tell ('a||', 'b') from
    ('a', '||b'), nor NULL from ''. ``strict`` hashes a JSON record, which keeps them apart.
    """
    if strict:
        record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return F.sha2(record, 256)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def surrogate_key(keys: Sequence[str], effective: Column) -> Column:
    """``key_.._yyyyMMddHHmmssSSS_<hash>``: a pure function of key and time, so a replay repeats it.

    The hash (64 bits of SHA-256 over the parts joined by ``||``) tells apart keys whose texts join to the same.
    """
    stamp = F.date_format(effective, "yyyyMMddHHmmssSSS")
    parts = [*[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys], stamp]
    suffix = F.substring(F.sha2(F.concat_ws(SEPARATOR, *parts), 256), 1, 16)
    return F.concat_ws("_", *parts, suffix)
