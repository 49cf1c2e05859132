"""Importance resampling: draw the documents whose hashed n-grams look most like those of a target text collection.

DuckDB counts inside each partition: SQL unnests a batch's words, windows over them make the n-grams, a registered function
gives their zlib checksums, and the counts of each document's buckets go to Parquet in the shared folder. Spark merges the
counts of all documents and of the target, gives every bucket a gain, sums the gains of each document and draws the highest
scores after adding Gumbel noise that depends on the document's id alone.

Only counts of buckets, sums of documents and the drawn rows are shuffled. Gains are `buckets` rows, which are broadcast. The
rank comes from a range sort with a random last key, so equal scores and ids spread over tasks too, and from the sizes of the
sorted partitions.

Defined cases: null, empty and wordless texts have no features, weight 0 and are never drawn; a null id counts as the empty text
in the noise and comes last among equal scores; repeated rows are scored and drawn each by itself; empty documents give an empty
result, an empty target a uniform one; a text is read whole, whatever its length, in one batch of DuckDB; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.llm.common import Scratch, partitions, stored

#: Buckets of checksums, words of the longest n-grams, the seed of the noise, and the percentage that is drawn of the documents
#: that have as many words at least.
BUCKETS, N, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
#: Bytes of text that DuckDB counts at once.
CHUNK_BYTES = 4 << 20
#: Scores in a step of the histogram that bounds what is sorted.
STEP = 64
#: Fixed value: a word is a run of digits, small letters and characters beyond ASCII, once A to Z are small.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = "n_words long, n_features long, counts array<struct<bucket:int,n:int>>"


def _counting_sql(n: int, buckets: int) -> str:
    """Of the table batch (doc, text): doc, n_words, n_features and the counts of buckets."""
    grams = ["SELECT doc, word AS gram FROM words"]
    for k in range(2, n + 1):
        ahead = "".join(f" || ' ' || lead(word, {i}) OVER w" for i in range(1, k))
        grams.append(f"SELECT doc, gram FROM (SELECT doc, word{ahead} AS gram FROM words WINDOW w AS (PARTITION BY doc ORDER BY place)) WHERE gram IS NOT NULL")
    return f"""
      WITH texts AS (SELECT doc, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{FEATURE_WORD}') AS w FROM batch),
      words AS (SELECT doc, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM texts),
      counted AS (SELECT doc, gram, count(*) AS n FROM ({" UNION ALL ".join(grams)}) GROUP BY doc, gram),
      hashed AS (SELECT gram, (checksum(gram) % {buckets})::INT AS bucket FROM (SELECT DISTINCT gram FROM counted)),
      summed AS (SELECT doc, bucket, sum(n)::INT AS n FROM counted JOIN hashed USING (gram) GROUP BY doc, bucket),
      listed AS (SELECT doc, list(struct_pack(bucket := bucket, n := n) ORDER BY bucket) AS counts, sum(n)::BIGINT AS n_features FROM summed GROUP BY doc)
      SELECT doc, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(counts, []) AS counts
      FROM texts LEFT JOIN listed USING (doc) ORDER BY doc"""


def _checksums(grams: pa.Array) -> pa.Array:
    return pa.array([zlib.crc32(g.encode()) for g in grams.to_pylist()], pa.uint32())


def features(docs: DataFrame, keys: list[str], n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """keys of docs, n_words, n_features and the counts of the buckets of each text's n-grams of 1 to n words."""
    rows = docs.select(*keys, "text")
    sql = _counting_sql(n, buckets)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(":memory:", config={"threads": 1}) as db:
            db.create_function("checksum", _checksums, ["VARCHAR"], "UINTEGER", type="arrow")
            for batch in batches:
                texts = batch.column(len(keys)).cast(pa.string())
                sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
                cuts = np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1
                for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                    if end > begin:
                        db.register("batch", pa.table({"doc": pa.array(range(end - begin), pa.int64()), "text": texts.slice(begin, end - begin)}))
                        made = db.sql(sql).to_arrow_table().combine_chunks()
                        db.unregister("batch")
                        found = [made.column(c).chunk(0) for c in ("n_words", "n_features", "counts")]
                        yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(begin, end - begin) for k in range(len(keys))), *found], names=[*keys, "n_words", "n_features", "counts"])

    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), FEATURES]))


def _merged(counted: DataFrame) -> DataFrame:
    return counted.select(F.inline("counts")).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: the logarithm of the target's share of a bucket over the raw share, in thousandths, floored."""
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(_merged(raw).withColumnRenamed("n", "s"), "bucket", "left").join(_merged(target).withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(c, F.lit(0)).cast("double") for c in ("s", "t"))
    one = rows.agg(F.collect_list(F.struct("bucket", s.alias("s"), t.alias("t"))).alias("b"), F.sum(s).alias("all_raw"), F.sum(t).alias("all_target"))
    each = one.select("all_raw", "all_target", F.inline("b"))
    share = (F.col("t") + 1) * (F.col("all_raw") + buckets) / ((F.col("s") + 1) * (F.col("all_target") + buckets))
    return each.select("bucket", F.floor(F.log(share) * 1000).cast("long").alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of a SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _scores(counted: DataFrame, table: DataFrame, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score; a document's counts are in one task, so only sums are shuffled."""
    rows = counted.withColumn("__row", F.monotonically_increasing_id()).select("__row", "doc_id", "n_words", "n_features", F.explode_outer("counts").alias("c"))
    joined = rows.withColumn("bucket", F.col("c.bucket")).join(F.broadcast(table), "bucket", "left")
    total = joined.groupBy("__row").agg(*[F.first(c).alias(c) for c in ("doc_id", "n_words", "n_features")], F.sum(F.col("c.n") * F.col("gain")).alias("total"))
    # the mean, floored, in whole numbers
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    return total.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows (doc_id, score and more) with rank, counted from 1: by score, highest first, then by id."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__salt")]
    parts = rows.withColumn("__salt", F.rand(SEED)).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    # the upper bits of such an id are the partition, the lower 33 bits the place in it
    placed = scratch.stored(parts.drop("__salt").withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__at", 33)).withColumn("__place", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # as many rows as there are partitions
    starts = F.broadcast(sizes.select("__part", before.alias("__before")))
    return placed.join(starts, "__part").withColumn("rank", F.col("__before") + F.col("__place") + 1).select(*rows.columns, "rank")


def resampled(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document of docs (doc_id, text); only drawn ones have a rank.

    Of the documents with `least_words` words the highest scores are drawn, `percent` of a hundred of them. target: text.
    """
    with Scratch(docs.sparkSession) as scratch:
        counted = scratch.stored(features(docs, ["doc_id"], n, buckets))
        table = gains(counted, features(target, [], n, buckets), buckets)
        rows = scratch.stored(_scores(counted, table, seed))
        scratch.drop(counted)
        fits = F.col("n_words") >= least_words
        count = rows.where(fits).count() * percent // 100
        steps = rows.where(fits).groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.count("*").alias("n"))
        upto = steps.select("step", F.sum("n").over(W.orderBy(F.desc("step"))).alias("upto"))
        # the step in which the last drawn score is; all scores below it are not drawn
        last = upto.where(F.col("upto") >= max(1, count)).agg(F.max("step")).first()[0]
        high = fits & (F.col("score") >= F.lit(0 if last is None else last * STEP)) & F.lit(last is not None and count > 0)
        rank = F.when(F.col("rank") <= count, F.col("rank"))
        drawn = _ranked(rows.where(high), scratch).withColumn("rank", rank)
        every = drawn.unionByName(rows.where(~high).withColumn("rank", F.lit(None).cast("long")))
        return stored(every.select("doc_id", "n_features", "weight", "score", "rank"))


def sample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of docs that are drawn, with rank; ids are unique."""
    drawn = resampled(docs.select("doc_id", "text"), target, **settings).where("rank IS NOT NULL")
    return docs.drop("rank").join(drawn.select("doc_id", "rank"), "doc_id")


ORACLE = rf"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t),
texts AS (
  SELECT 'raw' AS side, doc_id, row_number() OVER () AS k, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{FEATURE_WORD}') AS w FROM documents
  UNION ALL SELECT 'target', NULL, -row_number() OVER (), regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{FEATURE_WORD}') FROM benchmark),
words AS (SELECT side, k, unnest(w) AS word FROM texts),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM hexed),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM bytes, tab),
features AS (SELECT side, k, bucket FROM words JOIN hashed USING (word)),
counts AS (SELECT bucket, count(*) FILTER (side = 'raw') AS s, count(*) FILTER (side = 'target') AS t FROM features GROUP BY bucket),
totals AS (SELECT count(*) FILTER (side = 'raw') AS s_all, count(*) FILTER (side = 'target') AS t_all FROM features),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT k, count(*) AS n, sum(gain) AS total FROM features JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY k),
scored AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total / n), 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM texts LEFT JOIN weights USING (k) WHERE side = 'raw'),
ranked AS (SELECT *, weight + noise AS score, n_features >= {LEAST_WORDS} AS fits, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY weight + noise DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= (SELECT {PERCENT} * count(*) // 100 FROM scored WHERE n_features >= {LEAST_WORDS}) THEN place END::BIGINT AS rank FROM ranked
"""
