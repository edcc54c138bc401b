"""Interest categories as data.

A category matches an event when the URL's first section is in
``section1`` or its second section is in ``section2``. Categories overlap:
one event may count for several. The taxonomy is an argument of the
tagging plan; ``NEWS_TAXONOMY`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Category:
    name: str
    section1: tuple[str, ...] = field(default_factory=tuple)
    section2: tuple[str, ...] = field(default_factory=tuple)

    def matches(self, s1: Column, s2: Column) -> Column:
        terms = []
        if self.section1:
            terms.append(s1.isin(list(self.section1)))
        if self.section2:
            terms.append(s2.isin(list(self.section2)))
        if not terms:
            return F.lit(False)
        out = terms[0]
        for t in terms[1:]:
            out = out | t
        return out


# --- Fixed values: must equal the production news taxonomy -----------------
# Category names, in output order, with their section tokens. Spellings are
# data and are kept as they are ("spirituaity", "ifestyle"); duplicate tokens
# in a list are listed once.
_REGIONAL = ("district", "state", "bengali", "maharashtra", "uttar-pradesh", "city", "urdu", "nepali",
             "kerala", "kannada", "punjab", "gujarat", "delhi-and-ncr", "state-news", "kolkata",
             "mumbai-news", "karnataka", "bengalurucity", "south-bengal", "ahmedabad", "telugu", "mysuru")
NEWS_TAXONOMY: tuple[Category, ...] = (
    Category("astrology", ("horoscope",), ("astro",)),
    Category("autos", (), ("automobile", "autos")),
    Category("business", ("economy", "business", "market"), ("business",)),
    Category("careers", (), ("jobs",)),
    Category("editorial", ("article",), ("articleshow", "story")),
    Category("education", ("education",), ()),
    Category("entertainment",
             ("entertainment", "celebs", "jokes", "photo", "bollywood", "picture", "sex", "sunny-leones",
              "bigg-boss"),
             ("gossip", "celeb-themes", "bollywood", "foreign-models", "actress", "foreign-shows",
              "entertainment", "jokes", "shows")),
    Category("health", (), ("health", "fitness")),
    Category("international", ("world", "world-news", "international"), ("world", "america", "international")),
    Category("lifestyle", ("lifestyle", "social", "fashion", "recipes", "beauty"),
             ("relationship", "ifestyle", "fashion", "beauty")),
    Category("movie_reviews", ("movie", "cinema"), ("movie", "cinema")),
    Category("politics", ("politics", "poll", "budget", "election"), ("politics", "poll", "budget", "election")),
    Category("regional", _REGIONAL, _REGIONAL),
    Category("spirituaity", ("religion", "spiritual"), ()),
    Category("sports", ("sports", "cricket"), ("sports", "cricket")),
    Category("tech", ("tech", "technology", "science"), ("tech", "technology", "science")),
    Category("top_news", ("india-news", "tv-news", "nation", "national", "latest-news"),
             ("india-news", "tv-news", "nation", "national", "latest-news")),
)
# Categories that may become user tags, and the tag thresholds:
# (share > 0.5 and reads > 4) or (share > 0.75 and reads >= 3).
TAGGABLE = ("entertainment", "lifestyle", "sports", "business", "health", "tech")
TAG_RULES = ((0.5, 4, False), (0.75, 3, True))   # (share above, reads, reads inclusive)
# ---------------------------------------------------------------------------
