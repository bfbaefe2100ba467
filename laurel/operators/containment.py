"""Texts that lie inside others, by an index of grams."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.session import staged

#: Lengths of the grams that a contained text and the one around it share; a needle uses the longest that it fills.
GRAMS = (8, 3, 1)


def _gram_length(needle: Column) -> Column:
    """The longest of GRAMS that a needle fills; null for an empty one."""
    out = F.lit(None).cast("int")
    for n in sorted(GRAMS):
        out = F.when(F.length(needle) >= n, F.lit(n)).otherwise(out)
    return out


def _grams(text: Column, lengths: Column) -> Column:
    """The distinct grams of a text, of each of these lengths."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def of(n: int) -> Column:
        # cut from an array of characters: a place in a text is found by walking to it
        starts = F.when((F.size(chars) >= n) & F.array_contains(lengths, n), F.sequence(F.lit(1), F.size(chars) - n + 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(chars, i, F.lit(n)), ""))
        return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))
    return F.concat(*[of(n) for n in GRAMS])


def _hash(text: Column) -> list[Column]:
    """128 bits that stand for a text where only its place is carried."""
    return [F.xxhash64(text).alias("_low"), F.xxhash64(F.lit("second half"), text).alias("_high")]


def contained(needles: DataFrame, texts: DataFrame, shortest: int, group: str = "topic_slug") -> DataFrame:
    """Pairs of a group's rows where ``needle`` (of at least ``shortest`` characters) is somewhere in ``text``.

    An index of grams: each text gives (group, gram, its hash) once for each of
    its grams, of the lengths that the group's needles use and of grams that a
    needle has.  A needle meets texts at that gram of its own which the fewest
    texts have, and none if a gram of it is in no text; one ``contains`` then
    decides.  Rows grow with the length of a text, whatever needles share.
    """
    needles = needles.where(F.length("needle") >= shortest)
    # few bytes of text make many grams: dealt to tasks by number, as by bytes one would make them all
    tasks = int(needles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = needles.select(group, "needle").distinct().repartition(tasks, group, "needle").withColumn("_n", _gram_length(F.col("needle")))
    own = asked.select(group, "needle", F.explode(_grams(F.col("needle"), F.array("_n"))).alias("gram"))
    own = staged(own, "needle-grams")
    lengths = asked.groupBy(group).agg(F.collect_set("_n").alias("_lengths"))
    looked = texts.select(group, "text").where(F.length("text") >= shortest).distinct()
    grams = (looked.join(lengths, group).repartition(tasks, group, "text")
             .select(group, *_hash(F.col("text")), F.explode(_grams(F.col("text"), F.col("_lengths"))).alias("gram")))
    index = staged(grams.join(own.select(group, "gram").distinct(), [group, "gram"], "left_semi"), "text-grams")
    often = index.groupBy(group, "gram").agg(F.count(F.lit(1)).alias("_often"))
    chosen = (own.join(often, [group, "gram"], "left").groupBy(group, "needle")
              .agg(F.min(F.struct("_often", "gram")).alias("_rarest"), F.max(F.col("_often").isNull()).alias("_missing"))
              .where("NOT _missing").select(group, "needle", "_rarest.gram"))
    place = [group, "_low", "_high"]
    pairs = (chosen.join(index, [group, "gram"]).join(looked.select(group, *_hash(F.col("text")), "text"), place)
             .where(F.col("text").contains(F.col("needle"))).select(*place, "needle"))
    shown = texts.select([c for c in texts.columns if c != "text"] + _hash(F.col("text")))
    return pairs.join(needles, [group, "needle"]).join(shown, place).drop("_low", "_high", "needle")
