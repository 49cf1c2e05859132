"""The engine's own operators: every query against its SQL, and small fixed cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loomlake.functions import text as T
from loomlake.operators import chat, filters, sequence
from loomlake.plans.queries import ORACLES, QUERIES, with_ids
from loomlake.sources.files import read_rows
from loomlake.streaming.resume import process_new

SF = "/root/testdata/sf0.001"


def rows_of(rows):
    plain = lambda v: round(v, 9) if isinstance(v, float) else str(v)
    return sorted(tuple(plain(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert rows_of(got.collect()) == rows_of(want)


def test_greedy_shards_and_next_fit():
    assert list(map(sequence.greedy_shards(10), [6, 6, 6, 6])) == [0, 0, 1, 1]
    assert list(map(sequence.next_fit(10), [6, 6, 3, 12, 1])) == [0, 1, 1, 2, 3]


def test_tail_split():
    assert sequence.tail_split(107, 10, 0.2) == (80, 20)
    assert sequence.tail_split(20, 10, 0.0) == (20, 0)
    with pytest.raises(ValueError):
        sequence.tail_split(10, 10, 1.0)


def test_packing_crosses_documents_and_drops_the_tail(spark):
    df = spark.createDataFrame([(1, list(range(6))), (2, []), (3, list(range(6, 14)))], "doc_id long, ids array<int>")
    got = {r.seq: r.tokens for r in sequence.packed(df, 4).collect()}
    assert got == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9, 10, 11]}


def test_budget_includes_the_row_that_reaches_it(spark):
    df = spark.createDataFrame([(k, 4) for k in range(4)], "k long, est long")
    assert sorted(r.k for r in sequence.budgeted(df, "est", "k", "k", 10).collect()) == [0, 1, 2]


def test_scores(spark):
    values = ["3", "2.9", "NaN", None, "3.5", "abc", "1_000"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, score string")
    kept = df.select("k", T.score(F.col("score")).alias("s")).where("s >= 3").collect()
    assert [r.k for r in kept] == [0, 2, 4, 6]


def test_unknown_settings_and_comparisons_raise():
    with pytest.raises(ValueError):
        filters.compiled({"min_lenght": 3}, F.lit(""), [])


def test_strip_and_script_share(spark):
    df = spark.createDataFrame([("　 a b\x1c\x85",), ("中㐀𠀀。",)], "t string")
    got = df.select(T.strip(F.col("t")), T.script_share(F.col("t"))).collect()
    assert got[0][0] == "a b" and got[1][1] == 0.25


def test_layouts(spark):
    df = spark.createDataFrame([("a ", "b", "c")], "instruction string, input string, output string")
    assert [m.content for m in df.select(chat.converted(df, "alpaca").alias("m")).first().m] == ["a\n\nb", "c"]
    with pytest.raises(ValueError):
        chat.converted(df, "unknown")


def test_assistant_labels(spark):
    df = spark.createDataFrame([([("user", "U"), ("assistant", "A")],)], "m array<struct<role string, content string>>")
    ids, labels = chat.rendered(F.col("m"), 64, 128)
    r = df.select(ids.alias("i"), labels.alias("l")).first()
    assert len(r.i) == len(r.l) and [x for x in r.l if x != -100] == [4 + ord("A") % 124, 3]


def test_resume_reads_each_file_once(spark, tmp_path):
    src, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    spark.range(10).write.parquet(src)
    for _ in range(2):
        process_new(spark, src, "id long", lambda d: d, out, at)
    assert spark.read.parquet(out).count() == 10


def test_ids_end_with_eos(spark):
    df = spark.createDataFrame([(1, "<|im_start|>a\r")], "doc_id long, text string")
    assert with_ids(df).first().ids == [2, 4 + 97, 4 + 13, 1]


def test_token_rollup_counts_every_document(spark, tmp_path):
    texts = ["abc", "a<|im_start|>b<|im_end|>", "", None]
    spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.dataset: (r.tokens, r.docs) for r in QUERIES["token_rollup"](spark, str(tmp_path)).collect()}
    assert got == {"s": (11, 4), "TOTAL": (11, 4)}


def test_bad_json_lines_raise(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"text": "a"}\n{"text": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_rows(spark, str(tmp_path / "x.jsonl"), "jsonl").collect()
