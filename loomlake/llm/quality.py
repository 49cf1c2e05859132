"""Quality rules: base rules of a text, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words are runs of characters other than space and U+0009 to U+000D. The n-grams of 1 to `n` words are hashed into buckets. Two
multinomials over the buckets are counted: one over trusted documents, one over the whole raw corpus, both smoothed by
`SMOOTHING` counts for each bucket. A document's score is the mean, over all its n-grams, of log(trusted / raw): the ratio's logarithm is
normalised by length, so it does not depend on how long a document is. Every document is held against the same threshold;
nothing is drawn at random.

Everything is made of SQL expressions over a document's own arrays: one scan counts, a second one scores, and no row but the
counts of buckets, at most `BUCKETS` for each task, is shuffled. The gains of all buckets, a table of `BUCKETS` numbers, come
to the scoring scan by broadcast. Hot keys do not arise: no document meets another one.

Defined cases: null and empty texts have no words, fail the base rules and are not kept; texts of any length are read whole, as
arrays in one row; repeated rows and ids are scored each by itself, and a trusted id trusts all its rows; empty tables give
empty results; without trusted documents all gains are 0, so the base rules
decide alone; other columns are not read. Windows of words are compared by 64-bit hashes within
one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.common import let

#: Buckets of hashed n-grams, and how many words the longest n-grams have.
BUCKETS, N = 1 << 15, 2
#: Counts that each bucket has beforehand.
SMOOTHING = 5.0
#: Documents that may be trusted, of more those with the smallest hashes of their ids; the one bound, of the target's sample.
TRUSTED = 20_000
#: The least score of a document that is kept.
THRESHOLD = -0.12
#: Fixed values of the base rules: words of a window, the least words, the largest share of words in repeated windows, symbols.
WINDOW, LEAST_WORDS, REPEATED_PERCENT, SYMBOLS = 5, 10, 20, "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    bare = F.btrim(text, F.lit(_BLANKS))
    return F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _gram_hashes(hashes: Column, n: int) -> Column:
    """The hashes of all runs of n words, from the words' hashes."""
    if n == 1:
        return hashes
    places = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]))


def _covered(windows: Column) -> Column:
    """Words in windows, of WINDOW words each, whose hash occurs twice or more among a text's windows."""

    def twice(ordered: Column) -> Column:
        near = lambda x, i: F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))
        found = F.filter(ordered, lambda x, i: near(x, i - 1) | near(x, i + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    # a window adds the words that the one before it does not cover
    width = lambda at: F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(WINDOW), p - F.coalesce(F.get(at, i - 1), F.lit(-WINDOW)))), F.lit(0), lambda a, x: a + x)
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, let(let(ordered, twice), width)).otherwise(F.lit(0)).cast("long")


def base(text: Column, hashes: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text with the hashes of its words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.translate(whole, _BLANKS, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(_gram_hashes(hashes, WINDOW), _covered),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _buckets(hashes: Column, n: int, buckets: int) -> Column:
    """The buckets of all n-grams of 1 to n words."""
    grams = [_gram_hashes(hashes, k) for k in range(1, n + 1)]
    return F.transform(F.concat(*grams) if n > 1 else grams[0], lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """doc_id of the documents labelled as good, at most `most`: those with the smallest hashes of their ids."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _figures(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """doc_id, the base figures and the buckets of all n-grams of each document, in one pass over its words' hashes."""
    row = lambda h: F.struct(*[c.alias(k) for k, c in base(F.col("text"), h).items()], _buckets(h, n, buckets).alias("grams"))
    return docs.select("doc_id", let(_hashed(F.col("text")), row).alias("__r")).select("doc_id", "__r.*")


def gains(docs: DataFrame, trusted: DataFrame, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: of each bucket the logarithm of its trusted share over its raw share, smoothed, in millionths."""
    ids = F.broadcast(trusted.select("doc_id", F.lit(1).alias("good")))  # at most TRUSTED rows
    rows = docs.select("doc_id", "text").join(ids, "doc_id", "left")
    grams = rows.select("good", F.explode(let(_hashed(F.col("text")), lambda h: _buckets(h, n, buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    t, s = (F.coalesce(c, F.lit(0)).cast("double") for c in ("good", "raw"))
    one = every.agg(F.collect_list(F.struct("bucket", t.alias("t"), s.alias("s"))).alias("b"), F.sum(t).alias("all_good"), F.sum(s).alias("all_raw"))
    each = one.select("all_good", "all_raw", F.inline("b"))
    more = SMOOTHING * buckets
    gain = F.log((F.col("t") + SMOOTHING) * (F.col("all_raw") + more) / ((F.col("s") + SMOOTHING) * (F.col("all_good") + more)))
    return each.select("bucket", F.when(F.col("all_good") > 0, F.floor(gain * 1_000_000)).otherwise(F.lit(0)).cast("long").alias("gain"))


def judged(docs: DataFrame, labels: DataFrame, n: int = N, buckets: int = BUCKETS, threshold: float = THRESHOLD, most: int = TRUSTED) -> DataFrame:
    """One row for each document: doc_id, the base figures, base_failed, kept and score, the mean gain of its n-grams.

    A document's n-grams are in one task, so each row is summed up where it was read and only sums are shuffled.
    """
    table = F.broadcast(gains(docs, trusted_ids(labels, most), n, buckets))  # `buckets` rows
    figures = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = _figures(docs, n, buckets).withColumn("__row", F.monotonically_increasing_id())
    grams = rows.select("__row", *figures, F.explode_outer("grams").alias("bucket")).join(table, "bucket", "left")
    mean = F.coalesce(F.sum("gain") / F.count("gain") / 1_000_000, F.lit(0.0))
    out = grams.groupBy("__row").agg(*[F.first(c).alias(c) for c in figures], mean.alias("score")).drop("__row")
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
