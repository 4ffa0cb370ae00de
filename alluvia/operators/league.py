"""League responses to summoner rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.functions.arrays import unnest
from alluvia.functions.audit import moment
from alluvia.schemas import LEAGUE_ENTRY, LEAGUE_PAGE

# Tiers answered as one page object, the default region and the default division.
PAGED_TIERS = ["challenger", "grandmaster", "master"]
REGION = "VN2"
TOP_RANK = "I"


def summoner_rows(
    responses: DataFrame, ingest_ts: datetime | Column | None = None, region: str = REGION, with_request: bool = False
) -> DataFrame:
    """One row per league entry from (tier, division, body) responses.

    The three top tiers answer ``{"tier", "entries": [...]}``, the others a bare list. A body of the
    wrong shape gives no rows. Missing fields take the request's tier and division, '' or 0. ``with_request``
    also keeps what was asked for, as ``asked_tier`` and ``asked_division``.
    """
    paged = F.lower("tier").isin(PAGED_TIERS)
    opening = F.substring(F.ltrim("body"), 1, 1)
    page = F.when(paged & (opening == "{"), F.from_json("body", LEAGUE_PAGE))
    bare = F.when(~paged & (opening == "["), F.from_json("body", T.ArrayType(LEAGUE_ENTRY)))
    parsed = responses.select("tier", "division", page.alias("_page"), bare.alias("_bare"))
    opened = unnest(
        parsed, F.coalesce("_page.entries", "_bare"), "e",
        F.col("tier").alias("asked_tier"),
        F.col("division").alias("asked_division"),
        F.coalesce("_page.tier", F.upper("tier")).alias("_tier"),
        F.coalesce(F.nullif("division", F.lit("")), F.lit(TOP_RANK)).alias("_division"),
    )
    return opened.select(
        F.coalesce("e.puuid", F.lit("")).alias("puuid"),
        F.lit(region).alias("region"),
        F.coalesce("e.tier", "_tier").alias("tier"),
        F.coalesce("e.rank", "_division").alias("rank"),
        *[F.coalesce(f"e.{n}", F.lit(0)).alias(n) for n in ("leaguePoints", "wins", "losses")],
        moment(ingest_ts).alias("ingest_ts"),
        *(["asked_tier", "asked_division"] if with_request else []),
    )
