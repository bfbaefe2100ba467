"""Lexicon sentiment of texts and its roll-up per business.

Valence rules follow Hutto & Gilbert (2014): boosters and negations in the three
words before a lexicon word, and s / sqrt(s^2 + 15) as the text score.  Scores
depend on the lexicon table the caller passes; they are not those of any package.
"""

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.numbers import round_half_even
from laurel.functions.text import contains_any, quoted
from laurel.session import small_table, staged

# A small lexicon for demonstrations, on its own coarse scale.  Real runs pass their own (term, valence) table.
_STRONG, _PLAIN, _WEAK = 3.0, 2.0, 1.0
DEMO_LEXICON = [(word, sign * worth) for sign, worth, words in [
    (1, _STRONG, "great excellent amazing awesome love loved best perfect fantastic beautiful delicious"),
    (1, _PLAIN, "good lovely nice friendly helpful attentive tasty spotless happy fun"),
    (1, _WEAK, "fresh clean fast quick worth recommend cozy"),
    (-1, _STRONG, "worst awful terrible horrible filthy hate hated"),
    (-1, _PLAIN, "bad rude dirty wrong disappointed disappointing overpriced poor sad broken annoying"),
    (-1, _WEAK, "cold slow bland stale refund problem"),
] for word in words.split()]
NEGATIONS = ["not", "no", "never", "none", "without", "cannot", "can't", "don't", "doesn't", "didn't", "isn't",
             "wasn't", "won't", "wouldn't", "ain't", "nothing", "hardly"]
BOOSTERS = {"very": 0.293, "really": 0.293, "extremely": 0.293, "so": 0.293, "absolutely": 0.293, "totally": 0.293,
            "incredibly": 0.293, "slightly": -0.293, "somewhat": -0.293, "barely": -0.293, "kinda": -0.293}
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = [1.0, 0.95, 0.9]
NORMALISER = 15.0
MICRO = 1_000_000  # valences add up as whole micro-units: the sum is exact in any order
TOKEN = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"

#: Terms of a lexicon that a plan may hold (about 50 bytes each).
DICTIONARY_TERMS = 20_000

TEXT_KEY = ["run_id", "business_id", "source", "pos"]


def demo_lexicon(spark) -> DataFrame:
    return small_table(spark, DEMO_LEXICON, ["term", "valence"])


def _valence(valence: Column, before: list[Column], negations, boosters) -> Column:
    """Valence of one word given the three words before it."""
    v = valence
    sign = F.when(valence < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    for word, damping in zip(before, DISTANCE_DAMPING):
        step = F.lit(0.0)
        for booster, amount in boosters.items():
            step = F.when(word == booster, F.lit(amount * damping)).otherwise(step)
        v = v + sign * step
    negated = F.lit(False)
    for word in before:
        negated = negated | F.coalesce(word.isin(list(negations)), F.lit(False))
    return F.when(negated, v * NEGATION_FACTOR).otherwise(v)


def text_scores(texts: DataFrame, lexicon: DataFrame, keys: list[str] = TEXT_KEY, negations=NEGATIONS,
                boosters=BOOSTERS, flags: dict[str, Column] | None = None, partitions: int | None = None,
                dictionary_terms: int = DICTIONARY_TERMS) -> DataFrame:
    """keys, one boolean per flag, and the compound score (-1..1, 4 places) of every text, a row for each.

    Each text is split and scored once, whatever number of aspects is asked for.  A
    lexicon of at most ``dictionary_terms`` terms becomes a dictionary in the plan: a
    text's words meet it inside the row, only its hits get their context, and
    nothing is shuffled.  A larger lexicon is joined as a table.  A repeated
    term counts once, with its highest valence.
    ``partitions`` deals the texts to so many tasks first, for sources of fewer splits.
    """
    flags = flags or {}
    terms = lexicon.where(F.col("term").isNotNull()).groupBy("term").agg(F.max("valence").alias("valence"))
    known = {r["term"]: r["valence"] for r in terms.limit(dictionary_terms + 1).collect()}
    texts = texts.select(*keys, "text")
    low = (texts.repartition(partitions) if partitions else texts).select(*keys, F.lower("text").alias("low"))
    split = low.select(*keys, *[c.alias(n) for n, c in flags.items()], F.regexp_extract_all("low", F.lit(TOKEN), 0).alias("_words"))
    if len(known) > dictionary_terms:
        summed = _by_join(split, terms, [*keys, *flags], negations, boosters)
    else:
        summed = split.select(*keys, *flags, _by_dictionary(known, negations, boosters).alias("_sum"))
    s = F.col("_sum") / F.lit(float(MICRO))
    return (summed.select(*keys, *flags, (s / F.sqrt(s * s + NORMALISER)).alias("_score"))
            .select(*keys, *flags, round_half_even(F.col("_score"), 4).alias("compound")))


def _micro(valence: Column) -> Column:
    return F.coalesce(F.rint(valence * MICRO).cast("long"), F.lit(0).cast("long"))


def _by_dictionary(known: dict[str, float | None], negations, boosters) -> Column:
    """Sum over the lexicon words of ``_words``, in micro-units.

    Places of hits come from a hash set of all terms; their valences from short
    maps by the terms' crc32, as a map is searched from its beginning.
    """
    if not known:
        return F.lit(0).cast("long")
    buckets: list[dict[str, float | None]] = [{} for _ in range(-(-len(known) // 4))]
    for term, valence in known.items():
        buckets[zlib.crc32(term.encode()) % len(buckets)][term] = valence
    double = lambda v: f"cast({'null' if v is None else repr(str(v))} as double)"
    maps = [f"map({', '.join(f'{quoted(t)}, {double(v)}' for t, v in b.items())})" if b else "cast(map() as map<string, double>)" for b in buckets]
    table = F.expr(f"array({', '.join(maps)})")
    places = F.expr(f"filter(sequence(0, size(_words) - 1), i -> get(_words, i) in ({', '.join(map(quoted, known))}))")
    words = F.col("_words")

    def worth(i: Column) -> Column:
        word = F.get(words, i)
        own = F.get(table, (F.crc32(word) % len(buckets)).cast("int"))[word]
        return _micro(_valence(own, [F.get(words, i - k) for k in (1, 2, 3)], negations, boosters))

    return F.when(F.size(words) > 0, F.aggregate(F.transform(places, worth), F.lit(0).cast("long"), lambda a, b: a + b)).otherwise(F.lit(0).cast("long"))


def _by_join(split: DataFrame, terms: DataFrame, keys: list[str], negations, boosters) -> DataFrame:
    """keys and ``_sum``, for lexicons too large for a plan: words become rows, told apart by their text's own number."""
    words = F.col("_words")
    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1))
    in_context = F.transform(places, lambda i: F.struct(F.get(words, i).alias("term"), *[F.get(words, i - k).alias(f"b{k}") for k in (1, 2, 3)]))
    rows = staged(split.withColumn("_text", F.expr("uuid()")), "split-texts")
    # outer: a text without a word still gives a row
    tokens = rows.select(*keys, "_text", F.explode_outer(in_context).alias("_t")).select(*keys, "_text", "_t.*")
    value = _valence(F.col("valence"), [F.col("b1"), F.col("b2"), F.col("b3")], negations, boosters)
    hit = tokens.join(terms, "term", "left")
    return hit.groupBy(*keys, "_text").agg(F.sum(_micro(value)).alias("_sum")).drop("_text")


def review_flags(aspects=fixed.ASPECTS, complaints=fixed.COMPLAINT_WORDS) -> dict[str, Column]:
    """One substring flag per aspect and one for complaints, on the whole lower-cased text (column ``low``)."""
    made = {f"is_{a}": contains_any(F.col("low"), words) for a, words in aspects.items()}
    return {**made, "is_complaint": contains_any(F.col("low"), complaints)}


def _mean_compound(where: Column | None = None) -> Column:
    """Mean of 4-place scores over whole ten-thousandths, so the order of addition cannot matter."""
    units = F.rint(F.col("compound") * 10000).cast("long")
    units = units if where is None else F.when(where, units)
    return F.try_divide(F.sum(units).cast("double") / 10000.0, F.count(units))


def sentiment_summary(scores: DataFrame) -> DataFrame:
    """Shares of positive, neutral and negative texts and the mean compound, per (run, business)."""
    c, n = F.col("compound"), F.count(F.lit(1))

    def share(cond):
        return F.count(F.when(cond, 1)) / n

    pos, neg = c >= fixed.POSITIVE_FROM, c <= fixed.NEGATIVE_UPTO
    return scores.groupBy("run_id", "business_id").agg(
        share(pos).alias("positive"), share(~pos & ~neg).alias("neutral"), share(neg).alias("negative"),
        _mean_compound().alias("compound"))


def review_metrics(scores: DataFrame) -> DataFrame:
    """The text-derived metric columns per (run, business), all aspects in one pass."""
    return scores.groupBy("run_id", "business_id").agg(
        _mean_compound(F.col("is_service")).alias("nlp_service_sentiment"),
        _mean_compound(F.col("is_wait")).alias("nlp_wait_sentiment"),
        _mean_compound(F.col("is_cleanliness")).alias("nlp_cleanliness_sentiment"),
        _mean_compound(F.col("is_value")).alias("nlp_value_sentiment"),
        (F.count(F.when(F.col("is_complaint"), 1)) / F.count(F.lit(1))).alias("nlp_complaint_rate"),
        _mean_compound().alias("nlp_overall_sentiment"))


def keyword_rates(texts: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Share of a business's texts that carry each flag; no scoring needed."""
    low = texts.select("run_id", "business_id", F.lower("text").alias("low"))
    return flag_rates(low.select("run_id", "business_id", *[c.alias(n) for n, c in flags.items()]), list(flags))


def flag_rates(flagged: DataFrame, flags: list[str]) -> DataFrame:
    return flagged.groupBy("run_id", "business_id").agg(
        F.count(F.lit(1)).alias("n_texts"),
        *[(F.count(F.when(F.col(n), 1)) / F.count(F.lit(1))).alias(n.replace("is_", "rate_")) for n in flags])
