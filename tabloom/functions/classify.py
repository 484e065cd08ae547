"""Classification by ordered keyword lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, contains_any

#: Signs of the kinds of commenters; the first kind that matches counts.
ENTITY_KINDS = {
    "industry": ("Corporation", "Inc.", "LLC", "Corp.", "Company", "Industries"),
    "trade_association": ("Association", "Federation", "Chamber", "Council"),
    "advocacy": ("Sierra Club", "EDF", "NRDC", "Citizens", "Action", "Watch"),
    "academic": ("University", "College", "Institute", "Professor", "PhD"),
    "government": ("Department", "Agency", "Commission", "State of", "City of"),
}

#: Parts of organisations' names.
ORGANISATION_SIGNS = (
    "Association", "Institute", "Foundation", "Corporation", "Inc.", "LLC", "Council", "Coalition", "Alliance",
    "Federation", "Union", "Chamber", "Society", "Board", "Commission", "Agency",
)

#: Signs of support, of opposition, and of strong feeling.
SUPPORT = ("support", "favor", "agree", "endorse", "approve", "applaud", "commend", "encourage", "welcome", "urge you to finalize", "strongly support", "fully support")
OPPOSE = ("oppose", "against", "reject", "disagree", "concerned", "harmful", "damaging", "negative", "withdraw", "rescind", "strongly oppose", "urge you to withdraw")
STRONG = ("strongly", "absolutely", "extremely", "deeply", "urgently", "critical", "essential", "must", "demand", "insist")


def by_keywords(c: Column | str, kinds: dict[str, tuple[str, ...]], default: str, ignore_case: bool = False) -> Column:
    """The first kind of which a keyword stands in the text."""
    out = None
    for kind, words in kinds.items():
        hit = contains_any(c, words, ignore_case)
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def entity_kind(c: Column | str) -> Column:
    return by_keywords(c, ENTITY_KINDS, "individual")


def is_organisation(c: Column | str, signs=ORGANISATION_SIGNS) -> Column:
    return contains_any(c, signs, ignore_case=False)


def position(c: Column | str, support=SUPPORT, oppose=OPPOSE) -> Column:
    s, o = contains_any(c, support), contains_any(c, oppose)
    return F.when(s & ~o, F.lit("support")).when(o & ~s, F.lit("oppose")).when(s & o, F.lit("mixed")).otherwise(F.lit("neutral/unclear"))


def intensity(c: Column | str, strong=STRONG) -> Column:
    return F.when(contains_any(c, strong), F.lit("strong")).otherwise(F.lit("moderate"))


def bucket(c: Column | str, edges: list[int]) -> Column:
    """The range between edges that a number is in, as text: '<100', '100-499', '500+'."""
    x = col(c)
    out = F.when(x < edges[0], F.lit(f"<{edges[0]}"))
    for low, high in zip(edges, edges[1:]):
        out = out.when(x < high, F.lit(f"{low}-{high - 1}"))
    return out.when(x >= edges[-1], F.lit(f"{edges[-1]}+"))
