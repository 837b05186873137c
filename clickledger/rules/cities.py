from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ladder import ladder, part

# Words that mark a city campaign; their order decides which one is extracted.
CITY_WORDS = (
    "nrw niedersachsen nuremberg cologne freiburg münchen rostock kiel münster duisburg magdeburg "
    "karlsruhe bremen frankfurt dresden leipzig kassel braunschweig berlin augburg mainz muesnter "
    "city-extended baden bayern extended muenster duesseldorf wiesbaden munich nurnberg munchen bonn "
    "munster dusseldorf köln bielefeld koln hannover mannheim essen bochum dortmund augsburg nürnberg "
    "general stuttgart düsseldorf hamburg"
).split()


def city_style(campaign: Column) -> Column:
    """'extended', 'city' or 'non_city' for search campaigns, 'na' for all others."""
    search = campaign.like("gaw%")
    named = campaign.rlike("|".join(["city", *CITY_WORDS]))
    return ladder(
        [
            ("extended", part(campaign, 5) == "extended"),
            ("extended", part(campaign, 4).like("city-extended%")),
            ("extended", search & campaign.like("%extended%")),
            ("city", search & named),
            ("non_city", search),
        ],
        "na",
    )


def city_of(campaign: Column, style: Column) -> Column:
    """The first city word in a city campaign, else 'na'."""
    found = ladder([(word, campaign.contains(word)) for word in CITY_WORDS], "na")
    return F.when(campaign.like("gaw%") & (style == "city"), found).otherwise("na")
