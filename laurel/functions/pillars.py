"""Six absolute pillar scores (0..100, null = no data) from the wide metric columns.

Column names are metric keys with '.' replaced by '_'.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    # least/greatest skip nulls, so null input needs its own branch
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _mean_present(parts: list[Column]) -> Column:
    present = F.filter(F.array(*parts), lambda p: p.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, p: acc + p)
    return F.when(F.size(present) > 0, total / F.size(present))


def satisfaction(cross: Column, consistency: Column) -> Column:
    base = clamp((cross - 3.0) / 2.0 * 100.0)
    return F.when(consistency.isNull(), base).otherwise(base * 0.9 + clamp(consistency * 100.0) * 0.1)


def service(sentiments: list[Column], complaint_rate: Column) -> Column:
    scaled = [clamp((s + 1.0) / 2.0 * 100.0) for s in sentiments]
    return clamp(_mean_present(scaled) - _zero(complaint_rate) * 30.0)


def popularity(volume: Column, mentions: Column, cross_platform: Column, web: Column) -> Column:
    vol = F.least(F.lit(100.0), F.log10(_zero(volume) + 1.0) * 40.0)
    buzz = F.least(F.lit(100.0), _zero(mentions) * 12.0)
    platforms = F.when(_zero(cross_platform) == 0.0, F.lit(1.0)).otherwise(cross_platform)
    score = F.lit(0.65) * vol + F.lit(0.2) * buzz + (platforms - 1.0) * 10.0 + _zero(web) * 10.0
    return F.when(volume.isNotNull() | mentions.isNotNull(), clamp(score))


def digital(has_website: Column, seo: Column) -> Column:
    return clamp(_zero(has_website) * 20.0 + _zero(seo) * 0.8)


def search(authority: Column, traffic: Column, serp: Column) -> Column:
    reach = F.when(traffic.isNotNull(), F.least(F.lit(100.0), F.log10(traffic + 1.0) * 25.0))
    return _mean_present([clamp(authority), reach, clamp(serp)])


def ai(mentioned: Column) -> Column:
    return clamp(mentioned * 100.0)


def pillar_columns() -> dict[str, Column]:
    c = F.col
    return {
        "satisfaction": satisfaction(c("sat_cross_rating"), c("sat_consistency")),
        "service": service(
            [c("nlp_service_sentiment"), c("nlp_overall_sentiment"), c("nlp_wait_sentiment"),
             c("nlp_cleanliness_sentiment"), c("nlp_value_sentiment")],
            c("nlp_complaint_rate")),
        "popularity": popularity(c("pop_review_volume"), c("pop_reddit_mentions"),
                                 c("pop_cross_platform"), c("pop_web_mentions")),
        "digital": digital(c("digital_has_website"), c("digital_seo_score")),
        "search": search(c("search_authority"), c("search_organic_traffic"), c("search_serp_score")),
        "ai": ai(c("ai_mentioned")),
    }
