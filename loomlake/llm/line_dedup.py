"""Line dedup by content-defined line chunks, in DataFrame operations alone.

A text is a sequence of lines. A rolling hash covers each pair of adjacent lines; a chunk ends after a line whose rolling
hash is a local minimum, so borders depend on the lines around them only and come back at the same lines wherever a
passage is pasted. A line of at least `line_words` words is a passage of its own: borders are also set around it.
Chunks of two lines or more, and such long lines, that occur more than once in the corpus keep their first occurrence
(smallest id, then place) and lose the others; short single lines stay.

Chunks are told apart by the SHA-256 of their bytes, so no chunk's text is shuffled; documents are, once, to meet what goes.
A chunk with a third of all occurrences is reduced on the map side when first occurrences are looked for. What is found is
written out, so the joins with it are joins of two plain tables, which adaptive execution splits where a chunk is hot. They
are merge joins at any size: what repeats grows with the corpus and is not to be broadcast.

Defined cases: null texts stay null and are not counted; empty texts have no lines; rows that agree in id and text are
one document (they share the decision, and do not repeat each other); a text of any length is cut whole, in one row; null ids come first; a text whose every chunk goes
becomes empty; an empty table gives an empty result; other columns are carried along unchanged but for n_chars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.common import Scratch, fresh, let, stored


#: A single line is a chunk worth removing from this many words on.
LINE_WORDS = 50


def is_long(line: Column, line_words: int) -> Column:
    return F.size(F.split(line, " ")) >= line_words


def chunks(text: Column, line_words: int = LINE_WORDS) -> Column:
    """The chunks of a text, as array<struct<lines int, text string>>; joined by newlines they are the text."""
    lines = F.split(text, "\n", -1)

    def cut(p: Column) -> Column:
        last = F.size(p["l"]) - 1
        rolled = lambda i: F.when((i > 0) & (i <= last), F.xxhash64(F.get(p["h"], i - 1), F.get(p["h"], i)))
        least = lambda i: (rolled(i) < rolled(i - 1)) & (rolled(i) < rolled(i + 1))
        border = lambda i: F.get(p["w"], i) | F.get(p["w"], i + 1) | F.coalesce(least(i), F.lit(False))
        ends = F.filter(F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>")), border)
        return let(F.concat(F.array(F.lit(-1)), ends, F.array(last)), lambda e: pieces(p, e))

    def pieces(p: Column, e: Column) -> Column:
        spans = F.zip_with(F.slice(e, 1, F.size(e) - 1), F.slice(e, 2, F.size(e)), lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
        return F.transform(spans, lambda s: F.struct(s["n"].alias("lines"), F.array_join(F.slice(p["l"], s["a"] + 2, s["n"]), "\n").alias("text")))

    hashed = let(lines, lambda x: F.struct(x.alias("l"), F.transform(x, lambda t: F.xxhash64(t)).alias("h"), F.transform(x, lambda t: is_long(t, line_words)).alias("w")))
    return let(hashed, cut)


def later_chunks(docs: DataFrame, scratch: Scratch, line_words: int) -> DataFrame:
    """doc_id, text_hash, gone: for each document of docs, the places of its chunks that occurred before."""
    rows = docs.where("text IS NOT NULL AND text <> ''").select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(chunks(F.col("text"), line_words)).alias("place", "chunk"))
    rows = rows.where((F.col("chunk.lines") > 1) | is_long(F.col("chunk.text"), line_words)).select("doc_id", "text_hash", "place", F.unhex(F.sha2("chunk.text", 256)).alias("chunk"))
    place = F.struct("doc_id", "text_hash", "place")
    firsts = scratch.stored(rows.groupBy("chunk").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("chunk", "first"))
    later = rows.join(firsts.hint("merge"), "chunk").where(place != F.col("first"))
    return stored(later.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("gone")))


def deduped(docs: DataFrame, lines: str, removed: str, line_words: int = LINE_WORDS) -> DataFrame:
    """docs with later occurrences of repeated chunks removed from text, and the numbers of lines and of chunks that went."""
    with Scratch(docs.sparkSession) as scratch:
        later = later_chunks(docs.select("doc_id", "text"), scratch, line_words)
    key, text_hash, gone, kept = (fresh(docs, n) for n in ("__id", "__hash", "__gone", "__kept"))
    later = later.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.col("gone").alias(gone))
    rows = docs.join(later.hint("merge"), docs["doc_id"].eqNullSafe(later[key]) & (F.xxhash64(docs["text"]) == later[text_hash]), "left")
    parts = F.when(F.col(gone).isNotNull(), chunks(F.col("text"), line_words))
    rows = rows.withColumn(kept, let(parts, lambda p: F.when(p.isNotNull(), F.struct(
        F.array_join(F.transform(F.filter(p, lambda c, i: ~F.array_contains(gone, i)), lambda c: c["text"]), "\n").alias("text"),
        F.aggregate(F.filter(p, lambda c, i: F.array_contains(gone, i)), F.lit(0), lambda s, c: s + c["lines"]).alias("lines")))))
    changed = F.col(kept).isNotNull()
    out = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.when(changed, F.col(kept)["text"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length(F.col(kept)["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    counts = [F.coalesce(F.col(kept)["lines"], F.lit(0)).cast("long").alias(lines), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed)]
    return rows.select(*[out[c].alias(c) for c in docs.columns], *counts)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_removed_lines, n_removed_chunks and the text that is kept, one row for each document."""
    rows = deduped(docs.select("doc_id", "text"), "n_removed_lines", "n_removed_chunks")
    return rows.select("doc_id", "n_removed_lines", "n_removed_chunks", F.col("text").alias("kept_text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs after line dedup, with its own columns."""
    return deduped(docs, fresh(docs, "__lines"), fresh(docs, "__chunks")).select(*[f"`{c}`" for c in docs.columns])
