"""Conversations: normalising layouts, filters, rendering with assistant-only labels, padding, splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window as W

from loomlake.functions.text import IGNORED, PAD, character_ids, first_filled, strip
from loomlake.functions.tokenizers import Tokenizer
from loomlake.operators.permutation import place_of
from loomlake.operators.ranges import running_before

#: The roles of messages.
ROLES = ["system", "user", "assistant"]
#: The columns that may hold each part, in order of preference.
PROMPTS = ("prompt", "instruction", "input", "problem", "question")
RESPONSES = ("response", "output", "target", "solution", "answer")
OUTPUTS = ("output", "response", "target", "answer")


MESSAGES = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def normalised(messages: Column) -> Column:
    """Messages with stripped contents; null unless all roles are known, no content is blank and an assistant speaks."""
    good = F.forall(messages, lambda m: F.coalesce(m["role"].isin(ROLES) & (strip(m["content"]) != ""), F.lit(False))) & F.exists(messages, lambda m: m["role"] == "assistant")
    return F.when(good, F.transform(messages, lambda m: F.struct(m["role"].alias("role"), strip(m["content"]).alias("content"))))


def _have(df: DataFrame, names: Sequence[str]) -> Column:
    return first_filled(*[F.col(c) for c in names if c in df.columns] or [F.lit(None)])


def _renamed(names: Sequence[str], first: str | None) -> Sequence[str]:
    """The columns of a part, of which another name replaces the first."""
    return [first or names[0], *names[1:]]


def _two(asked: Column, user: Column, answer: Column, drop_blank: bool) -> Column:
    filled = (strip(user) != "") & (strip(answer) != "") if drop_blank else (asked != "") & (answer != "")
    return F.when(filled, F.array(message("user", user), message("assistant", strip(answer))))


#: Layouts: a function of the rows, the names of fields and whether blank parts drop a row, that gives messages.
LAYOUTS: dict[str, Callable[[DataFrame, Mapping[str, Any], bool], Column]] = {}


def layout(name: str):
    """Decorator that adds a layout."""

    def add(f):
        LAYOUTS[name] = f
        return f

    return add


@layout("messages")
def _messages(df: DataFrame, fields: Mapping[str, Any], drop_blank: bool) -> Column:
    return normalised(F.col(fields.get("messages_field", "messages")))


@layout("chosen_messages")
def _chosen(df: DataFrame, fields: Mapping[str, Any], drop_blank: bool) -> Column:
    return normalised(F.col(fields.get("chosen_field", "chosen")))


@layout("alpaca")
def _alpaca(df: DataFrame, fields: Mapping[str, Any], drop_blank: bool) -> Column:
    asked = _have(df, [fields.get("instruction_field", "instruction")])
    extra = strip(_have(df, [fields.get("input_field", "input")]))
    answer = _have(df, _renamed(OUTPUTS, fields.get("output_field")))
    return _two(asked, F.when(extra != "", F.concat(strip(asked), F.lit("\n\n"), extra)).otherwise(strip(asked)), answer, drop_blank)


@layout("prompt_response")
def _prompt(df: DataFrame, fields: Mapping[str, Any], drop_blank: bool) -> Column:
    asked = _have(df, _renamed(PROMPTS, fields.get("prompt_field")))
    answer = _have(df, _renamed(RESPONSES, fields.get("response_field")))
    return _two(asked, strip(asked), answer, drop_blank)


@layout("firefly")
def _firefly(df: DataFrame, fields: Mapping[str, Any], drop_blank: bool) -> Column:
    asked, answer = _have(df, [fields.get("input_field", "input")]), _have(df, [fields.get("target_field", "target")])
    return _two(asked, strip(asked), answer, drop_blank)


def converted(df: DataFrame, layout: str, fields: Mapping[str, Any] | None = None, drop_blank: bool = False) -> Column:
    """The messages of df's rows in a known layout; null where a part is missing.

    fields: other names of the parts. drop_blank: also null where a part is white space alone, which the strict check rejects.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    return LAYOUTS[layout](df, fields or {}, drop_blank)


def checked(messages: Column, where: Column) -> Column:
    """Normalised messages; a row that is not valid raises and names its place."""
    fine = normalised(messages)
    return F.when(fine.isNotNull(), fine).otherwise(F.raise_error(F.concat(F.lit("invalid conversation at "), where)).cast(MESSAGES))


def passes(messages: Column, least: int = 0, most: int | None = None, least_assistant: int = 0) -> Column:
    whole = F.length(F.array_join(F.transform(messages, lambda m: m["content"]), "\n"))
    said = F.aggregate(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0), lambda s, m: s + F.length(m["content"]))
    ok = (whole >= least) & (said >= least_assistant)
    return ok if most is None else ok & (whole <= most)


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, messages of turns: conv_id, turn, role, text."""
    entry = F.struct("turn", "role", F.col("text").alias("content"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("m")).select("conv_id", F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def segments(messages: Column) -> Column:
    """The pieces of a conversation that are encoded each by itself: text, and whether what it says is learned, by kind.

    kind 0: never learned; 1: what an assistant says; 2: the end of what an assistant says.
    """
    piece = lambda text, kind: F.struct(text.alias("text"), F.lit(kind).alias("kind") if isinstance(kind, int) else kind.alias("kind"))
    own = lambda m, kind: F.when(m["role"] == "assistant", F.lit(kind)).otherwise(F.lit(0))
    head = lambda m: piece(F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n")), 0)
    whole = lambda m: F.array(head(m), piece(m["content"], own(m, 1)), piece(F.lit("<|im_end|>"), own(m, 2)), piece(F.lit("\n"), 0))
    return F.flatten(F.transform(messages, whole))


def rendered(messages: Column, length: int, encode: Callable[[Column], Column] | int = 256, end_counts: bool = True) -> tuple[Column, Column]:
    """Ids and labels of a conversation: each segment is encoded by itself; only what the assistant says is labelled.

    encode: a tokenizer as an expression, or the size of the character tokenizer's vocabulary.
    """
    ids = encode if callable(encode) else lambda text: character_ids(text, encode)
    learned = lambda s: (s["kind"] == 1) | (s["kind"] == 2) if end_counts else s["kind"] == 1
    label = lambda s: F.transform(ids(s["text"]), lambda t: F.when(learned(s), t).otherwise(F.lit(IGNORED)))
    pieces = segments(messages)
    return F.slice(F.flatten(F.transform(pieces, lambda s: ids(s["text"]))), 1, length), F.slice(F.flatten(F.transform(pieces, label)), 1, length)


def rendered_rows(df: DataFrame, tokenizer: Tokenizer, length: int, messages: str = "messages", end_counts: bool = True) -> DataFrame:
    """df with ids and labels of its conversations by any tokenizer: as an expression where it is one, else over Arrow batches.

    Null conversations have no ids and no labels, null both.
    """
    if hasattr(tokenizer, "column"):
        ids, labels = rendered(F.col(messages), length, tokenizer.column, end_counts)
        return df.withColumns({"ids": ids, "labels": labels})
    rows = df.drop("ids", "labels").withColumn("__segments", segments(F.col(messages)))
    at = len(rows.columns) - 1
    counts = (1, 2) if end_counts else (1,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[list, list] = [], []
            for pieces in batch.column(at).to_pylist():
                ids, labels = [], []
                for piece in pieces or ():
                    if len(ids) >= length:
                        break
                    got = tokenizer.encode(piece["text"])
                    ids += got
                    labels += got if piece["kind"] in counts else [IGNORED] * len(got)
                found[0].append(None if pieces is None else ids[:length])
                found[1].append(None if pieces is None else labels[:length])
            columns = [pa.array(x, pa.list_(pa.int32())) for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *columns], names=[*batch.schema.names[:at], "ids", "labels"])

    numbers = ArrayType(IntegerType())
    kind = StructType([*rows.schema.fields[:at], StructField("ids", numbers), StructField("labels", numbers)])
    return rows.mapInArrow(run, kind)


def padded(df: DataFrame, batch: int, key: str, pad: int = PAD) -> DataFrame:
    """df (key, ids, labels) with batch, attention mask, and ids and labels padded right to the longest row of the batch.

    Batches are rows in the order of key, which may have gaps and repeat; pad: the id of the tokenizer that fills rows up.
    """
    rows = df.withColumn("__one", F.lit(1)).withColumn("__tie", F.xxhash64("ids", "labels"))
    rows = running_before(rows, "__one", key, "__tie", "__place").withColumn("batch", F.expr(f"__place div {batch}"))
    rows = rows.withColumn("__short", F.max(F.size("ids")).over(W.partitionBy("batch")) - F.size("ids"))
    fill = lambda v: F.array_repeat(F.lit(v), F.col("__short"))
    more = {"mask": F.concat(F.transform("ids", lambda _: F.lit(1)), fill(0)), "ids": F.concat("ids", fill(pad)), "labels": F.concat("labels", fill(IGNORED))}
    return rows.withColumns(more).drop("__short", "__one", "__tie", "__place")


def pad_id(tokenizer: Tokenizer) -> int:
    """The id that fills rows up: the tokenizer's own, else its end of text."""
    found = tokenizer.pad_token_id if tokenizer.pad_token_id is not None else tokenizer.eos_token_id
    if found is None:
        raise ValueError("the tokenizer has neither an id to pad with nor an end of text")
    return found


def collated(sequences: DataFrame, tokens: str = "tokens") -> DataFrame:
    """sequences with input_ids and labels for pretraining: labels are a copy, as the model shifts them itself."""
    return sequences.withColumn("input_ids", F.col(tokens)).withColumn("labels", F.col(tokens))


def aligned(labels: Column, ids: Column) -> Column:
    """What each place is to predict: pairs of a place's id and the next label, without ignored ones."""
    pairs = F.zip_with(F.slice(ids, F.lit(1), F.greatest(F.lit(0), F.size(ids) - 1)), F.slice(labels, F.lit(2), F.greatest(F.lit(0), F.size(labels) - 1)), lambda i, w: F.struct(i.alias("id"), w.alias("next")))
    return F.filter(pairs, lambda p: p["next"] != IGNORED)


def split(rows: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """rows with part: 'val' for as many rows as the share tells, at least one, chosen by a permutation of all places; else 'train'.

    Places are those of the order of a numeric key, repeated keys by their other columns; each row computes its own place in the
    permutation, so no list of places exists anywhere.
    """
    n = rows.count()
    held = held_out(n, share)
    if not held:
        return rows.withColumn("part", F.lit("train"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind])
    numbered = running_before(rows.withColumns({"__one": F.lit(1), "__tie": tie}), "__one", key, "__tie", "__place")
    part = F.when(place_of(F.col("__place"), n, seed) < held, "val").otherwise("train")
    return numbered.withColumn("part", part).drop("__one", "__tie", "__place")


def held_out(n: int, share: float) -> int:
    """How many of n rows are for validation: none without a share, else at least one; an empty training part is an error."""
    if share >= 1:
        raise ValueError("the share must be below 1")
    count = max(1, int(n * share)) if share > 0 else 0
    if count and count >= n:
        raise ValueError("no rows are left for training")
    return count
