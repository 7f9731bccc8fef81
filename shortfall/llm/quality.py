"""Quality rules whose cutoffs are certified on labelled documents, on DataFrames only.

Each rule compares one ratio of a text, as a whole number, with a cutoff. The
cutoffs of all rules form one path from telling to doubtful steps, made from
texts that are not labelled good. An exact binomial test on the good ones then
tells, for each stratum, how far along the path the union of all steps rejects
less than the allowed share of good texts; the steps up to there are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store

WORDS = r"[\x20\x09-\x0D]+"
#: Values from here on are one bin.
MOST = 1000
#: Stratum of the languages with too few good texts for one of their own.
POOLED = "*"
#: Rule and its value, a whole number from 0 to ``MOST``; high values are bad.
RULES = {
    "symbols": f"least({MOST}, (100 * n_symbols) div nullif(n_words, 0))",
    "dup_lines": f"least({MOST}, (1000 * n_dup_lines) div nullif(n_words, 0))",
    "repeats": f"least({MOST}, (100 * n_repeat_words) div nullif(n_words, 0))",
    "long_words": f"least({MOST}, (10 * word_chars) div nullif(n_words, 0))",
    "short_words": f"{MOST} - least({MOST}, (10 * word_chars) div nullif(n_words, 0))",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, though ``body`` uses it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.

    Windows are compared by 64-bit hashes: sorted with their places, equal ones
    are neighbours, and the places of those are added up without overlaps.
    """

    def pairs(ordered: Column) -> Column:
        same = lambda i, j: F.get(ordered, i)["hash"] == F.get(ordered, j)["hash"]
        at = F.transform(
            ordered,
            lambda x, i: F.when(
                F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)),
                x["place"],
            ),
        )
        return F.array_sort(F.array_compact(at))

    def covered(places: Column) -> Column:
        spans = F.transform(
            places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))
        )
        return F.aggregate(spans, F.lit(0), lambda total, x: total + x)

    def sorted_windows(hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
        return F.sort_array(rows)

    def of_words(w: Column) -> Column:
        last = F.size(w) - 3
        windows = F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))
        return let(
            windows,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(let(sorted_windows(h), pairs), covered)
            ),
        )

    return let(words, of_words).cast("long")


def base(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, stratum, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, WORDS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    gone = lambda chars: F.length(F.translate(text, chars, ""))
    counted = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("stratum"),
        F.xxhash64("text").alias("text_key"),
        F.struct(
            let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"))).alias("w")
        ).alias("x"),
        gone(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.length(text) - gone("#*$%&|<>")).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
    )
    counted = counted.select(
        "doc_id", "stratum", "text_key", F.col("x.w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        "n_dup_lines", F.col("x.w.r").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def allowed_rejections(n: Column, share: float, level: Column) -> Column:
    """Greatest k for which k or fewer of ``n`` events of probability ``share`` have a chance of at most ``level``; -1 if none.

    The terms of the exact binomial sum are added up in logarithms, so that
    large ``n`` doesn't underflow. Only k below the mean are looked at.
    """
    odds = math.log(share / (1 - share))
    first = n * F.lit(math.log1p(-share))
    start = F.struct(
        first.alias("term"), first.alias("total"), F.when(first <= F.log(level), 0).otherwise(-1).cast("long").alias("k")
    )

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        total = high + F.log1p(F.exp(low - high))
        return F.struct(
            term.alias("term"), total.alias("total"), F.when(total <= F.log(level), i).otherwise(acc["k"]).alias("k")
        )

    mean = F.floor(n * F.lit(share)).cast("long")
    ks = F.when(mean > 0, F.sequence(F.lit(1).cast("long"), F.greatest(mean, F.lit(1)))).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(ks, start, add, lambda acc: acc["k"])


def distinct_texts(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (stratum, one value for each rule, label): the different texts that pass the base checks.

    A text counts once, however often it is repeated, since its copies are not
    independent trials; of its labels the lowest counts, null if it has none.
    """
    values = [F.expr(value).cast("int").alias(name) for name, value in RULES.items()]
    passed = features.filter("not base_failed").select("doc_id", "stratum", "text_key", *values)
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    labelled = passed.join(marks, "doc_id").drop("doc_id")
    rows = passed.drop("doc_id").withColumn("label", F.lit(None).cast("int")).unionByName(labelled)
    return rows.groupBy("stratum", "text_key").agg(
        *[F.max(name).alias(name) for name in RULES], F.min("label").alias("label")
    )


def pools(features: DataFrame, texts: DataFrame, false_rejections: float, confidence: float) -> DataFrame:
    """Rows (stratum, pool): the stratum itself, or ``POOLED`` if it has too few good texts of its own.

    Too few are those on which even no rejection at all would be no
    certificate. The numbers alone decide, not what the rules do to the texts.
    """
    sizes = texts.filter("label = 1").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    strata = F.count(F.lit(1)).over(Window.partitionBy())
    enough = F.col("n") * F.lit(math.log1p(-false_rejections)) <= F.log(F.lit(1 - confidence) / strata)
    large = sizes.select("stratum", enough.alias("enough")).filter("enough")
    pool = F.when(F.col("enough"), F.col("stratum")).otherwise(POOLED).alias("pool")
    return features.select("stratum").distinct().join(large, "stratum", "left").select("stratum", pool)


def in_pools(texts: DataFrame, pool: DataFrame) -> DataFrame:
    """``texts`` with their pool as stratum; a text of several pooled strata counts once."""
    rows = texts.join(pool, "stratum").drop("stratum").withColumnRenamed("pool", "stratum")
    return rows.groupBy("stratum", "text_key").agg(
        *[F.max(name).alias(name) for name in RULES], F.min("label").alias("label")
    )


def path(texts: DataFrame, false_rejections: float) -> DataFrame:
    """Rows (stratum, rule, cut, place): the steps in order, made without the good texts.

    A step rejects values of its rule from ``cut`` on. Its rank is the share
    of bad texts it catches over the share of unlabelled ones, to which half
    the allowed share is added, so that steps for a handful of texts come late.
    Steps that catch no larger share of the bad ones are left out.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("cut")) for r in RULES]))
    bins = (
        texts.filter("label is null or label = 0")
        .select("stratum", "label", pairs.alias("pair"))
        .groupBy("stratum", "pair.rule", "pair.cut")
        .agg(F.count("label").alias("bad"), F.count_if(F.col("label").isNull()).alias("other"))
    )
    of_rule = Window.partitionBy("stratum", "rule")
    beyond = of_rule.orderBy(F.desc("cut")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = lambda c: F.sum(c).over(beyond) / F.greatest(F.sum(c).over(of_rule), F.lit(1))
    lift = F.col("caught") / (F.col("common") + F.lit(false_rejections / 2))
    order = Window.partitionBy("stratum").orderBy(F.desc("lift"), "rule", F.desc("cut"))
    return (
        bins.select("stratum", "rule", "cut", "bad", share("bad").alias("caught"), share("other").alias("common"))
        .filter("bad > 0")
        .select("stratum", "rule", "cut", lift.alias("lift"))
        .filter("lift > 1")
        .select("stratum", "rule", "cut", F.row_number().over(order).alias("place"))
    )


def certified(texts: DataFrame, steps: DataFrame, false_rejections: float, confidence: float) -> DataFrame:
    """Rows (stratum, certified, one cut for each rule), a cut null where no step of the rule is used.

    The trials are the good texts of a stratum. The unions of the steps up to
    each place are tested in the path's order up to the first that rejects too
    many (a fixed sequence needs no correction); over strata the level is
    divided by their number. So with ``confidence`` no stratum loses more than
    ``false_rejections`` of its good texts. ``certified`` says whether the
    stratum has enough good texts for a certificate without any rejection.
    """
    good = texts.filter("label = 1")
    sizes = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    level = F.lit(1 - confidence) / F.greatest(F.count(F.lit(1)).over(Window.partitionBy()), F.lit(1))
    sizes = sizes.select("stratum", "n", level.alias("level")).select(
        "stratum", allowed_rejections(F.col("n"), false_rejections, F.col("level")).alias("allowed")
    )
    # for each rule, cuts and places of its steps; a text's first step is the least place of cuts up to its value
    found = [
        F.sort_array(
            F.collect_list(F.when(F.col("rule") == r, F.struct("place", "cut")))
        ).alias(r)
        for r in RULES
    ]
    lists = steps.groupBy("stratum").agg(*found)
    up_to = lambda value: lambda step: step["cut"] <= value
    hits = [F.get(F.filter(F.col(f"s.{r}"), up_to(F.col(f"g.{r}"))), 0)["place"] for r in RULES]
    firsts = (
        good.alias("g")
        .join(lists.alias("s"), F.col("g.stratum") == F.col("s.stratum"))
        .select("g.stratum", F.least(*hits).alias("place"))
        .filter("place is not null")
        .groupBy("stratum", "place")
        .agg(F.count(F.lit(1)).alias("lost"))
    )
    so_far = Window.partitionBy("stratum").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stops = (
        firsts.select("stratum", "place", F.sum("lost").over(so_far).alias("lost"))
        .join(sizes, "stratum")
        .filter("lost > allowed")
        .groupBy("stratum")
        .agg(F.min("place").alias("stop"))
    )
    used = (
        steps.join(sizes.filter("allowed >= 0"), "stratum")
        .join(stops, "stratum", "left")
        .filter("stop is null or place < stop")
        .groupBy("stratum")
        .agg(*[F.min(F.when(F.col("rule") == r, F.col("cut"))).alias(r) for r in RULES])
    )
    return sizes.select("stratum", (F.col("allowed") >= 0).alias("certified")).join(used, "stratum", "left")


def quality(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    false_rejections: float = 0.01,
    confidence: float = 0.95,
) -> DataFrame:
    """Rows (doc_id, base counts, base_failed, kept, rejected_by, certified), one for each row of ``docs``.

    Strata are languages. Null and empty texts have no words and fail the base
    check; a null language is one more. Languages with too few good labels for
    a certificate share one stratum; if that has too few as well, it is not
    ``certified`` and keeps what passes the base check.
    ``rejected_by`` names the rules, joined by commas, that reject a text that
    passes the base check; it is null if there is none. Values equal to a cut
    are rejected. Labels with null ids are ignored, of repeated ones the lowest
    counts. Repeated rows get equal results, no rows give no rows, other columns
    are ignored. Whole texts are counted; different texts are told apart by
    64-bit hashes.
    """
    store = Store(spark, "quality")
    features = store.put(base(docs))
    by_language = store.put(distinct_texts(features, labels.select("doc_id", "quality")))
    pool = store.put(pools(features, by_language, false_rejections, confidence))
    texts = store.put(in_pools(by_language, pool))
    steps = store.put(path(texts, false_rejections))
    cuts = certified(texts, steps, false_rejections, confidence).withColumnRenamed("stratum", "pool")
    cuts = store.put(pool.join(cuts, "pool", "left").drop("pool"))
    rejects = [F.when(F.expr(value) >= F.col(f"c.{name}"), F.lit(name)) for name, value in RULES.items()]
    judged = (
        features.alias("f")
        .join(cuts.alias("c"), F.col("f.stratum") == F.col("c.stratum"), "left")
        .select(
            "f.*", F.coalesce("c.certified", F.lit(False)).alias("certified"),
            F.when(~F.col("base_failed"), F.nullif(F.concat_ws(",", *rejects), F.lit(""))).alias("rejected_by"),
        )
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by", "certified",
    )
