"""Document fingerprints by one-permutation MinHash, in Spark expressions alone.

Every shingle of five words is hashed once; the hash's upper bits name one of 2 ** `bin_bits` bins, its lower bits the
value. A bin keeps its least value. Empty bins are filled by optimal densification: an empty bin asks other bins, in an
order of its own that a universal hash gives and that visits every bin once, until one is not empty, and takes that one's
value. Of each bin `bits` low-order bits are packed into the fingerprint, as hexadecimal text. The likeness of two
fingerprints is the share of equal bins, corrected for the 2 ** -bits of equal bins that chance gives.

The least value of each bin comes from sorting the packed (bin, value) numbers of a text once, so a document costs one
sort and no shuffle. Edited texts need the next document: documents are dealt to slices of ids with one shuffle of the
texts, and a window inside each slice finds the next one. A copy of each slice's first document stands at the end of the
slice before, so nothing is joined and every fingerprint is computed once, after the shuffle. Slices lie between quantiles
of the ids and are as many as the rows need; rows that share one id, or have none, are dealt by their texts' hashes.

Defined cases: a null text is the empty one; a text without words has no shingle and the fingerprint of zeros; fewer than
five words are one shingle; equal texts have equal fingerprints; rows with equal ids follow each other by the hash of their
texts, then by text; null ids come last; of one document the next one is itself; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.llm.common import let, partitions

BIN_BITS = 8
BITS = 8
SHINGLE = 5
#: Bins that an empty bin asks at once: these many, then as many more, and so on until it has asked all.
DRAWS = (2, 6, 24)
#: Bits of a hash that are its value in its bin; one more value marks an empty bin.
VALUE_BITS = 40
EMPTY = 1 << VALUE_BITS
#: Documents for each slice of ids, and the most quantiles between which slices of equal width lie.
SLICE_ROWS = 4000
QUANTILES = 512


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """The hashes of all n-word shingles of a text, in order; one of the whole sequence if it is shorter."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    at = lambda h: F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(h) - (n - 1)))
    rolled = lambda h: F.transform(at(h), lambda i: F.xxhash64(F.slice(h, i, F.lit(n))))
    none = F.array().cast("array<long>")
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) > 0, rolled(h)).otherwise(none))


def bin_values(hashes: Column, bin_bits: int = BIN_BITS) -> Column:
    """The least value of each bin, or EMPTY, in the order of the bins."""
    name = VALUE_BITS + 1
    entry = lambda h: F.shiftleft(F.shiftrightunsigned(h, 64 - bin_bits), name).bitwiseOR(h.bitwiseAND(F.lit(EMPTY - 1)))
    marks = F.transform(F.sequence(F.lit(0).cast("long"), F.lit((1 << bin_bits) - 1).cast("long")), lambda b: F.shiftleft(b, name).bitwiseOR(F.lit(EMPTY)))
    first = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(F.get(s, i - 1), name) != F.shiftright(x, name)))
    return F.transform(let(F.sort_array(F.concat(F.transform(hashes, entry), marks)), first), lambda x: x.bitwiseAND(F.lit(2 * EMPTY - 1)))


def densified(values: Column, bin_bits: int = BIN_BITS) -> Column:
    """Bin values with every empty bin filled from the first bin it asks that is not empty; all 0 if all are empty."""
    bins = 1 << bin_bits
    ends = [0, *(sum(DRAWS[: k + 1]) for k in range(len(DRAWS))), bins]
    spans = [(a, b - 1) for a, b in zip(ends, ends[1:]) if a < min(b, bins)]

    def filled(v: Column) -> Column:
        def found(b: Column, order: Column) -> Column:
            draw = lambda lo, hi: F.transform(F.sequence(F.lit(lo), F.lit(min(hi, bins - 1))), lambda t: F.get(v, (order["s"] + t * order["d"]).bitwiseAND(F.lit(bins - 1)).cast("int")))
            # coalesce stops at the first one that is found
            return F.coalesce(*[F.get(F.filter(draw(lo, hi), lambda x: x != EMPTY), F.lit(0)) for lo, hi in spans])

        order = lambda b: F.struct(F.xxhash64(b, F.lit(1)).bitwiseAND(F.lit(bins - 1)).alias("s"), F.xxhash64(b, F.lit(2)).bitwiseOR(F.lit(1)).bitwiseAND(F.lit(bins - 1)).alias("d"))
        return F.transform(v, lambda x, b: F.when(x != EMPTY, x).otherwise(let(order(b), lambda o: found(b, o))))

    zeros = F.array_repeat(F.lit(0).cast("long"), bins)
    return let(values, lambda v: F.when(F.array_min(v) == EMPTY, zeros).otherwise(filled(v)))


def cells(text: Column, bin_bits: int = BIN_BITS, bits: int = BITS) -> Column:
    """The low-order bits of a text's bins, as an array."""
    return F.transform(densified(bin_values(shingle_hashes(text), bin_bits), bin_bits), lambda x: x.bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))


def packed(cells: Column, bits: int = BITS) -> Column:
    """Cells as hexadecimal text."""
    digits = -(-bits // 4)
    return F.array_join(F.transform(cells, lambda x: F.lpad(F.lower(F.hex(x)), digits, "0")), "")


def fingerprint(text: Column, bin_bits: int = BIN_BITS, bits: int = BITS) -> Column:
    """The packed low-order bits of a text's bins, as hexadecimal text."""
    return packed(cells(text, bin_bits, bits), bits)


def likeness(a: Column, b: Column, bin_bits: int = BIN_BITS, bits: int = BITS) -> Column:
    """Estimated Jaccard likeness of two texts by their cells: the share of equal ones without those that chance makes equal."""
    bins, chance = 1 << bin_bits, 2.0**-bits
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    share = (equal / F.lit(float(bins)) - chance) / (1 - chance)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def slices(docs: DataFrame) -> Column:
    """The number of the slice of a row (doc_id, hash): larger ids, and of one id larger hashes, have larger numbers."""
    rows, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    wanted = max(partitions(docs.sparkSession), rows // SLICE_ROWS)
    parts = min(wanted, QUANTILES)
    deep = -(-wanted // parts)
    found = docs.stat.approxQuantile("doc_id", [k / parts for k in range(parts + 1)], 0.2 / parts) if rows > nulls else []
    counts = Counter(int(x) for x in found)
    borders = sorted(counts)
    if not borders:
        borders = [0]
    # of each range of ids: its start, its width, how many slices it has, and how many an id at its start alone has
    ranges = [(a, max(1, b - a), deep if counts[a] < 3 else 1, deep * counts[a] if counts[a] > 2 else 1) for a, b in zip(borders, [*borders[1:], borders[-1] + 1])]
    table = F.array(*[F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip("awnm", r)]) for r in ranges])
    at = F.size(F.filter(F.lit(borders).cast("array<long>") if len(borders) > 1 else F.array(F.lit(borders[0]).cast("long")), lambda x: x <= F.col("doc_id"))) - 1
    hashed = lambda n: F.shiftrightunsigned(F.col("hash").bitwiseXOR(F.lit(-(2**63))), 33) * n / F.lit(float(2**31))
    most = 2 * max(2, *(r[2] + r[3] for r in ranges), deep * (1 + parts * nulls // max(1, rows)))

    def inside(r: Column) -> Column:
        alone = F.col("doc_id") == r["a"]
        # an id that many rows share stands at the start of its range; the rows behind it follow
        return F.when(alone & (r["m"] > 1), F.floor(hashed(r["m"]))).otherwise(F.when(r["m"] > 1, r["m"]).otherwise(F.lit(0)) + F.least(r["n"] - 1, F.floor((F.col("doc_id") - r["a"]) * r["n"] / r["w"])))

    known = let(F.greatest(F.lit(0), at), lambda i: (i + 1) * F.lit(most) + inside(F.get(table, i)))
    of_null = max(1, deep * parts * nulls // max(1, rows))
    return F.when(F.col("doc_id").isNull(), F.floor(hashed(F.lit(of_null))) - F.lit(of_null)).otherwise(known).cast("long")


def with_next(docs: DataFrame, of: Column) -> DataFrame:
    """docs (doc_id, hash, text) with `of` (an expression of text) and, by descending doc_id, the next one's text and `of`."""
    rows = docs.withColumn("slice", slices(docs))
    first = F.max(F.struct("doc_id", "hash", "text"))
    heads = rows.groupBy("slice").agg(first.alias("head"))
    # a row for each slice; the slice after the last one is the first
    numbers = heads.select("slice")
    before = F.coalesce(F.lag("slice").over(W.orderBy(F.desc("slice"))), F.min("slice").over(W.orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    guests = heads.join(numbers.select("slice", before.alias("before")), "slice").select("head.doc_id", "head.hash", "head.text", F.col("before").alias("slice"), F.lit(True).alias("guest"))
    both = rows.select("doc_id", "hash", "text", "slice", F.lit(False).alias("guest")).unionByName(guests)
    down = W.partitionBy("slice").orderBy("guest", F.desc("doc_id"), F.desc("hash"), F.desc("text"))
    both = both.withColumn("next_text", F.lead("text").over(down)).withColumn("of", of)
    return both.withColumn("next_of", F.lead("of").over(down)).where("NOT guest").drop("slice", "guest")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of docs and of their edited texts, and how near each is to its edited text and to the next document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_next(docs.select("doc_id", F.xxhash64(text).alias("hash"), text.alias("text")), cells(F.col("text")))
    n_chars = F.length("text")
    cut = F.floor(n_chars / 3).cast("int")
    rows = rows.select("doc_id", n_chars.cast("long").alias("n_chars"), "of", "next_of", F.concat(F.substring("text", 1, n_chars - cut), F.substring("next_text", 1, cut)).alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "of", "next_of", cells(F.col("edited")).alias("edited_of"))
    return rows.select("doc_id", "n_chars", "edited_sha256", packed(F.col("of")).alias("fingerprint"), packed(F.col("edited_of")).alias("edited_fingerprint"), likeness(F.col("of"), F.col("edited_of")).alias("near_edited"), likeness(F.col("of"), F.col("next_of")).alias("near_next"))
