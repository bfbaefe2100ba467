"""Per-business metric formulas over narrow columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.numbers import round_half_even


def bayesian_rating(rating: Column, count: Column, prior_mean: float = fixed.PRIOR_MEAN,
                    prior_strength: float = fixed.PRIOR_STRENGTH) -> Column:
    """Shrink a rating toward the prior by its review count; null when unrated."""
    shrunk = (F.lit(prior_strength * prior_mean) + count * rating) / (F.lit(prior_strength) + count)
    return F.when(rating.isNotNull() & (count > 0), shrunk)


def cross_rating(bayes_a: Column, n_a: Column, bayes_b: Column, n_b: Column) -> Column:
    """Review-weighted mean of the adjusted ratings that exist."""
    both = (bayes_a * n_a + bayes_b * n_b) / (n_a + n_b)
    # one platform: rating * n / n, which is not always bit-equal to the rating itself
    return (F.when(bayes_a.isNotNull() & bayes_b.isNotNull(), both)
            .when(bayes_a.isNotNull(), bayes_a * n_a / n_a)
            .when(bayes_b.isNotNull(), bayes_b * n_b / n_b))


def consistency(bayes_a: Column, bayes_b: Column) -> Column:
    gap = F.abs(bayes_a - bayes_b)
    return F.when(gap.isNotNull(), F.greatest(F.lit(0.0), F.lit(1.0) - gap / 2.0))


def platforms(bayes_a: Column, bayes_b: Column) -> Column:
    return bayes_a.isNotNull().cast("double") + bayes_b.isNotNull().cast("double")


def serp_score(rank: Column) -> Column:
    return F.when(F.coalesce(rank, F.lit(0)) != 0, F.greatest(F.lit(0.0), F.lit(100.0) - (rank - 1) * 5.0))


def seo_points(fetched: Column, is_https: Column, has_viewport: Column, has_schema_org: Column,
               has_open_graph: Column, has_canonical: Column, h1_count: Column, word_count: Column) -> Column:
    """Unrounded 0..100 website quality; 0 without a fetched audit."""
    def points(flag: Column, worth: float) -> Column:
        return F.when(F.coalesce(flag, F.lit(False)), F.lit(worth)).otherwise(F.lit(0.0))

    total = (points(is_https, 25.0) + points(has_viewport, 15.0) + points(has_schema_org, 15.0)
             + points(has_open_graph, 10.0) + points(has_canonical, 10.0) + points(h1_count >= 1, 10.0)
             + F.least(F.lit(15.0), F.coalesce(word_count, F.lit(0)) / F.lit(80.0)))
    return F.when(F.coalesce(fetched, F.lit(False)), F.least(F.lit(100.0), total)).otherwise(F.lit(0.0))


def seo_score(points: Column) -> Column:
    """Rounded seo_points, given as a plain column."""
    return round_half_even(points, 2)
