"""Mixing sources to target weights: Efraimidis-Spirakis sampling, in
DataFrame operations alone.

Targets: sources share the budget (all words there are) by weight; no target
exceeds ``cap`` times its source's words, and what is cut off is shared again
by weight until none is above.  Each round of that is one aggregate over the
source table; only its two sums reach the driver.

Selection: a source whose target holds whole epochs takes every document that
often; the rest of the target is a sample without replacement.  Document keys
are exponential, -ln(u) / quality weight with u from a hash of the document
id, and ascending keys are taken up to the budget by prefix sums of words.  The
document at the edge is taken if more than half of it fits, so a source misses
its target by at most half a document.

No source is ever sorted in one task: a key's bucket is its logarithm in steps
that shrink with the square root of the source's documents.  A share of at most
``ln 2 / e`` of the keys of any quality lies in an octave's densest part, so that a bucket
holds about half the square root at most, whatever the qualities.  Bucket sums are
prefix-summed, and documents only inside their bucket.  Source facts are joined
to documents by (source, salt).

Defined cases: NULL text has no words and is never taken; NULL source is a
source and ranks last; repeated ids share a random number, those without an id
share it with equal texts, equal rows are interchangeable; without any words all targets are 0; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.llm.shared import stored
from equiframe.operators.keys import assign_keys

WEIGHTS = (1, 2, 3)    # of sources by code point, repeating
CAP = 3
SALTS = 16
SEED = "mix-1"
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def word_length_quality(text: Column, size: Column) -> Column:
    """Quality weight of a text: 1, or 1/4 where the mean word length is
    outside 3 to 10 characters."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(3, 10), 1.0).otherwise(0.25)


def unit(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a hash of the id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def bucket_of(key: Column, n_docs: Column) -> Column:
    """The bucket of a positive key among ``n_docs``: greater keys are never in an earlier one."""
    return F.floor(F.log2(key) * F.ceil(F.sqrt(n_docs) / 2)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size, n_docs), with the target of each source
    and its place in code point order."""
    ranked = assign_keys(sizes.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, len(weights)) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        above = F.lit(share) * F.col("weight") > F.col("source_size") * cap if capped >= 0 else F.lit(False)
        held, left, n = ranked.agg(F.sum(F.when(above, F.col("source_size") * cap)),
                                   F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))).first()
        if n == capped:
            break
        capped = n
        if not left:
            break
        share = (total - (held or 0)) / left
    above = F.lit(share) * F.col("weight") > F.col("source_size") * cap
    return ranked.withColumn("target", F.when(above, (F.col("source_size") * cap).cast("double"))
                             .otherwise(F.lit(share) * F.col("weight")))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, quality: Column | None = None,
        seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, text_hash, size, source_size, target,
    copies and taken.  ``quality`` is a positive weight from the columns of
    ``docs`` (default :func:`word_length_quality`)."""
    size = word_count(F.col(text))
    weigh = quality if quality is not None else word_length_quality(F.col(text), size)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       size.alias("size"), F.coalesce(weigh, F.lit(0.25)).cast("double").alias("quality"),
                       F.xxhash64(F.col(text)).alias("text_hash"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("text_hash")))
    rows = rows.withColumn("key", -F.ln(unit(name, seed)) / F.col("quality"))
    rows = stored(rows.drop("quality"), "mix-rows")

    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    facts = targets(sizes, weights, cap).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "rank", "source_size", "target",
        "n_docs",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = rows.select("*", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),
                        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int").alias("salt"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = stored(named.join(facts, ["name", "salt"])
                         .select("doc_id", "text_hash", "size", "key", "rank", "source_size", "target",
                                 bucket_of(F.col("key"), F.col("n_docs")).alias("bucket"), whole.cast("long").alias("epochs")), "mix-placed")

    earlier = Window.unboundedPreceding, -1
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(*earlier)
    sums = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("words")) \
                 .select("rank", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(*earlier)
    prefix = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = (F.col("size") > 0) & (prefix + F.col("size") / 2 <= rest)
    return (placed.join(sums, ["rank", "bucket"])
                  .withColumn("copies", F.when(F.col("size") == 0, 0)
                              .otherwise(F.col("epochs") + F.when(chosen, 1).otherwise(0)).cast("long"))
                  .select("doc_id", "text_hash", "size", "source_size", "target", "copies",
                          (F.col("copies") * F.col("size")).alias("taken")))


def repeat(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns."""
    mixed = mix(docs, text, doc_id, **options)
    key = ["_mix_id", "_mix_text"]
    plan = mixed.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(key[0]),
                         F.col("text_hash").alias(key[1])) \
                .agg(F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_rows")) \
                .filter("_mix_copies > 0")
    named = docs.withColumns({key[0]: F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")),
                              key[1]: F.xxhash64(F.col(text))})
    # equal rows share what they were given together
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    own = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + \
        F.when(nth <= F.col("_mix_copies") % F.col("_mix_rows"), 1).otherwise(0)
    return (named.join(plan, key).withColumn("_mix_own", own.cast("int")).filter("_mix_own > 0")
                 .withColumn("_mix_nth", F.explode(F.sequence(F.lit(1), F.col("_mix_own"))))
                 .select(*docs.columns))
