"""Expressions for professional-network posts: media kind, reactions, metadata URNs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from engage.functions.counts import or_zero

# Output column suffix -> reaction key of the source.
REACTIONS = {
    "like": "LIKE",
    "celebrate": "PRAISE",
    "support": "APPRECIATION",
    "love": "EMPATHY",
    "insightful": "INTEREST",
    "funny": "ENTERTAINMENT",
}
URN_PREFIX = "urn:li:"
# URN kinds an all-digit id may stand for, in lookup order.
URN_KINDS = ["ugcPost", "share"]


def media_type(content: str = "content") -> Column:
    """``video`` / ``image`` / ``media`` by the media id, else ``article``, ``multiImage`` or ``none``."""
    media_id = F.coalesce(F.col(f"{content}.media.id"), F.lit(""))
    return (
        F.when(
            F.col(f"{content}.media").isNotNull(),
            F.when(media_id.contains("video:"), "video").when(media_id.contains("image:"), "image").otherwise("media"),
        )
        .when(F.col(f"{content}.article").isNotNull(), "article")
        .when(F.col(f"{content}.multiImage").isNotNull(), "multiImage")
        .otherwise("none")
    )


def reaction_count(reactions: Column, key: str) -> Column:
    return or_zero(F.try_element_at(reactions, F.lit(key))["count"])


def reaction_columns(reactions: Column) -> dict[str, Column]:
    """The six counts and their sum."""
    counts = {f"reaction_{name}": reaction_count(reactions, key) for name, key in REACTIONS.items()}
    total = None
    for column in counts.values():
        total = column if total is None else total + column
    return {**counts, "total_reactions": total}


def post_key(id_: Column, urn: Column) -> Column:
    """Post identity: the id, or the URN where the id is empty or missing."""
    return F.coalesce(F.nullif(id_, F.lit("")), urn)


def urn_candidates(key: Column) -> Column:
    """URNs under which a post's metadata may be filed, best first; no entry for a null key."""
    expanded = F.array(*[F.concat(F.lit(f"{URN_PREFIX}{kind}:"), key) for kind in URN_KINDS])
    return (
        F.when(key.isNull(), F.array().cast("array<string>"))
        .when(key.startswith(URN_PREFIX), F.array(key))
        .when(key.rlike("^[0-9]+$"), expanded)
        .otherwise(F.array(key))
    )


def percent_encoded(text: Column) -> Column:
    """Percent-encoding that leaves only letters, digits and ``- _ . ~`` as they are."""
    # The form encoding of the engine differs from it in three characters.
    plus, star = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*")
    return F.replace(F.replace(plus, star, F.lit("%2A")), F.lit("%7E"), F.lit("~"))
