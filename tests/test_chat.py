"""Conversations: fields of layouts, rendering by tokenizers, padding, and the split by a permutation."""

import pytest
from pyspark.sql import functions as F

from loomlake.functions.tokenizers import CharacterTokenizer
from loomlake.operators import chat, permutation, ranges


def test_another_name_replaces_the_first_fallback(spark):
    df = spark.createDataFrame([("wrong", "", "right", "yes", "no")], "prompt string, q string, instruction string, r string, response string")
    got = df.select(chat.converted(df, "prompt_response", {"prompt_field": "q", "response_field": "r"}).alias("m")).first().m
    assert [m.content for m in got] == ["right", "yes"]
    rows = spark.createDataFrame([("i", "", "wrong", "right")], "instruction string, o string, output string, response string")
    assert rows.select(chat.converted(rows, "alpaca", {"output_field": "o"}).alias("m")).first().m[1].content == "right"


def test_chosen_field(spark):
    df = spark.createDataFrame([([("user", " u "), ("assistant", "a")],)], chat.MESSAGES.replace("array", "better array", 1))
    got = df.select(chat.converted(df, "chosen_messages", {"chosen_field": "better"}).alias("m")).first().m
    assert [m.content for m in got] == ["u", "a"]


class Pairs:
    """Joins two letters to one id, so that segments encoded together would differ from segments encoded alone."""

    eos_token_id, pad_token_id = 9999, None

    def encode(self, text):
        return [1000 + sum(map(ord, text[k : k + 2])) for k in range(0, len(text), 2)]

    def __len__(self):
        return 10_000


def plain(tokenizer, messages, length, end_counts):
    ids, labels = [], []
    for role, content in messages:
        mine = role == "assistant"
        for text, counts in ((f"<|im_start|>{role}\n", False), (content, mine), ("<|im_end|>", mine and end_counts), ("\n", False)):
            got = tokenizer.encode(text)
            ids += got
            labels += got if counts else [-100] * len(got)
    return ids[:length], labels[:length]


@pytest.mark.parametrize("tokenizer", [Pairs(), CharacterTokenizer(300)])
@pytest.mark.parametrize("length,end_counts", [(1000, True), (37, False)])
def test_rendering_by_any_tokenizer(spark, tokenizer, length, end_counts):
    talks = {1: [("user", "abc"), ("assistant", "d<|im_end|>é")], 2: [("system", "s"), ("user", "u" * 50), ("assistant", "ok"), ("user", "x"), ("assistant", "")], 3: []}
    df = spark.createDataFrame([*talks.items(), (4, None)], f"k int, messages {chat.MESSAGES}")
    got = {r.k: (r.ids, r.labels) for r in chat.rendered_rows(df, tokenizer, length, end_counts=end_counts).collect()}
    assert got == {k: plain(tokenizer, m, length, end_counts) for k, m in talks.items()} | {4: (None, None)}
    assert chat.pad_id(tokenizer) == (9999 if isinstance(tokenizer, Pairs) else 0)


def test_padding_keeps_repeated_keys(spark):
    df = spark.createDataFrame([(1, [1], [1]), (1, [2, 3], [2, 3]), (2, [4], [4])], "conv_id long, ids array<int>, labels array<int>")
    got = sorted((r.conv_id, r.ids, r["mask"], r.labels) for r in chat.padded(df, 2, "conv_id", pad=7).collect())
    assert got == [(1, [1, 7], [1, 0], [1, -100]), (1, [2, 3], [1, 1], [2, 3]), (2, [4], [1], [4])]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation_is_a_bijection(spark, n):
    df = spark.range(n)
    got = {r.id: r.p for r in df.select("id", permutation.place_of(F.col("id"), n, 3).alias("p")).collect()}
    assert sorted(got.values()) == list(range(n))
    if n == 1000:
        other = {r.id: r.p for r in df.select("id", permutation.place_of(F.col("id"), n, 4).alias("p")).collect()}
        assert sum(got[k] == k for k in got) < 10 and sum(got[k] == other[k] for k in got) < 10
        assert 60 < sum(k < 500 for k, p in got.items() if p < 250) < 190


def test_permutation_in_sql_is_the_same(spark):
    import duckdb

    for n in (2, 9, 333):
        bits = max(1, -(-(n - 1).bit_length() // 2))
        mine = [r.p for r in spark.range(n).select(permutation.place_of(F.col("id"), n, 5).alias("p"), "id").orderBy("id").collect()]
        sql = permutation.place_sql("i", f"{n}::BIGINT", str(bits), 5)
        assert mine == [r[0] for r in duckdb.sql(f"SELECT {sql} FROM range({n}) t(i) ORDER BY i").fetchall()]


def test_split_has_the_exact_count(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 40)
    df = spark.createDataFrame([(k * k % 400, f"t{k}") for k in range(500)], "conv_id long, text string").repartition(7)
    first = {(r.conv_id, r.text): r.part for r in chat.split(df, "conv_id", 0.123, 42).collect()}
    assert len(first) == 500 and sum(p == "val" for p in first.values()) == 61
    assert first == {(r.conv_id, r.text): r.part for r in chat.split(df.repartition(3), "conv_id", 0.123, 42).collect()}
    assert chat.split(df, "conv_id", 0, 1).where("part = 'val'").count() == 0
    for share in (0.999, 1):
        with pytest.raises(ValueError):
            chat.split(df.limit(1), "conv_id", share, 1)
