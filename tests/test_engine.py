"""Readers, shards, recipes, order, state, gates, formats, tokenizers and filters on small fixed cases."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomlake.functions import formats, tokenizers
from loomlake.functions import text as T
from loomlake.operators import chat, filters
from loomlake.plans import gates
from loomlake.sources import files, samples


def kept(df, config, **more):
    return [r.k for r in df.where(filters.compiled(config, F.lit("x"), df.columns, **more)).orderBy("k").collect()]


def test_quality_scores_keep_nan_and_skip_empty(spark):
    values = [("3", None), ("2.9", None), ("NaN", None), (None, None), ("3.5", None), ("abc", "4"), ("1_000", None), ("", "3.5"), ("3.5d", None)]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(values)], "k int, score string, int_score string")
    assert kept(df, {"min_quality_score": 3}) == [0, 2, 4, 6, 7]


def test_comparisons(spark):
    df = spark.createDataFrame([(0, float("nan"), "2"), (1, 2.0, "x"), (2, 3.0, None)], "k int, n double, t string")
    assert kept(df, {"field": "n", "op": ">=", "value": 2}) == [1, 2]
    assert kept(df, {"field": "n", "value": 2}) == kept(df, {"field": "n", "op": "=", "value": "2"}) == [1]
    assert kept(df, {"field": "n", "op": "!=", "value": 2}) == [0, 2]
    assert kept(df, {"field": "t", "op": ">=", "value": 2}) == [0]
    assert kept(df, {"field": "t", "value": "x"}) == [1]
    assert kept(df, {"field": "missing", "value": 1}) == []
    with pytest.raises(ValueError):
        filters.compiled({"field": "missing", "op": "~", "value": 1}, F.lit(""), [])


def test_named_filters_and_registry(spark):
    df = spark.createDataFrame([(0, 2, "a"), (1, None, "中" * 20 + "a" * 80)], "k int, int_score int, text string")
    assert kept(df, {}, name="fineweb_edu") == [0] and kept(df, {}, name="chinese") == [1]
    assert [r.k for r in df.where(filters.compiled({"type": "chinese", "min_ratio": 0.2}, F.col("text"), df.columns)).collect()] == [1]
    assert df.where(filters.compiled({"min_ratio": 0.2}, F.col("text"), df.columns)).count() == 2

    @filters.register("odd")
    def odd(columns):
        return F.col("k") % 2 == 1

    assert kept(df, {}, name="odd") == [1]
    with pytest.raises(ValueError):
        filters.compiled({}, F.lit(""), [], "unknown")


def test_minimum_length_is_of_stripped_text_in_one_stage_only(spark):
    df = spark.createDataFrame([(0, "a" * 50), (1, "\x1c  a" + " " * 60), (2, ""), (3, None)], "k int, text string")
    run = lambda mode: [r.k for r in df.where(filters.accepted({}, F.col("text"), df.columns, mode=mode)).collect()]
    assert run("one_stage") == [0] and run("two_stage") == [0, 1]


def test_layouts_and_strict_check(spark):
    df = spark.createDataFrame([("a ", "  ", "b"), ("  ", "", "b")], "instruction string, input string, output string")
    got = [r.m for r in df.select(chat.converted(df, "alpaca").alias("m")).collect()]
    assert [m.content for m in got[0]] == ["a", "b"] and got[1][0].content == ""
    assert [r.m for r in df.select(chat.converted(df, "alpaca", drop_blank=True).alias("m")).collect()][1] is None
    renamed = df.toDF("q", "x", "a")
    fields = {"instruction_field": "q", "input_field": "x", "output_field": "a"}
    assert renamed.select(chat.converted(renamed, "alpaca", fields).alias("m")).first().m[1].content == "b"
    bad = spark.createDataFrame([([("user", "u")],)], chat.MESSAGES.replace("array", "m array", 1))
    with pytest.raises(Exception, match="row 7"):
        bad.select(chat.checked(F.col("m"), F.lit("row 7"))).collect()


def test_readers_agree(spark, tmp_path):
    rows = [{"a": "1", "b": "x\ny"}, {"a": "2", "b": 'q"r,s'}]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "whole.JSON").write_text(json.dumps(rows))
    (tmp_path / "x.csv").write_text('a,b\n1,"x\ny"\n2,"q""r,s"\n')
    (tmp_path / "x.tsv").write_text('a\tb\n1\t"x\ny"\n2\t"q""r,s"\n')
    table = pa.Table.from_pylist(rows)
    with pa.ipc.new_file(str(tmp_path / "x.arrow"), table.schema) as f:
        f.write_table(table)
    for name in ("x.jsonl", "lines.json", "whole.JSON", "x.csv", "x.tsv", "x.arrow"):
        got = sorted((r.a, r.b) for r in files.read_rows(spark, str(tmp_path / name)).collect())
        assert got == [("1", "x\ny"), ("2", 'q"r,s')], name
    assert files.detect_format("a/B.PARQUET") == "parquet" and files.detect_format("a.txt") is None
    assert files.row_count(spark, str(tmp_path / "x.jsonl")) == 2
    assert files.mirrored(spark, str(tmp_path), files=["x.csv", "x.jsonl"]).count() == 4


def test_raw_texts_and_conversation_records(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 4)], "text string, other int").coalesce(1).write.parquet(str(tmp_path / "raw"))
    assert [r.text for r in files.raw_texts(spark, str(tmp_path / "raw")).orderBy("file", "row").collect()] == ["a", "b"]
    good = {"messages": [{"role": "user", "content": " u "}, {"role": "assistant", "content": "a"}]}
    (tmp_path / "c.jsonl").write_text("\n".join([json.dumps(good), " ", json.dumps(good | {"source": None}), json.dumps(good | {"source": "s"})]))
    got = files.conversation_records(spark, str(tmp_path / "c.jsonl")).orderBy("line").collect()
    assert [(r.line, r.source, r.messages[0].content) for r in got] == [(1, "c.jsonl", "u"), (3, None, "u"), (4, "s", "u")]
    (tmp_path / "bad.jsonl").write_text(json.dumps(good) + "\n" + json.dumps({"messages": [{"role": "user", "content": "u"}]}))
    with pytest.raises(Exception, match="bad.jsonl:2"):
        files.conversation_records(spark, str(tmp_path / "bad.jsonl")).collect()


def test_samples(spark):
    tokens = [r.token for r in samples.token_stream(spark).orderBy("pos").collect()]
    assert len(tokens) == 4096 and tokens[:8] == [1, 3, 5, 7, 2, 6, 10, 14] and max(tokens) < 256
    assert samples.conversation_rows(spark).where(chat.normalised(F.col("messages")).isNull()).count() == 0


def test_gates(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    local = {"use_cpu": True, "data_dir": "./data/local_smoke/x", "output_dir": "./artifacts/local/x"}
    gates.check("local", local, {"vocab_size": 256})
    for wrong in ({"use_cpu": False}, {"data_dir": "./data/local_smoke/../production"}, {"tokenizer_name": "t"}, {"data_dir": None}):
        with pytest.raises(ValueError):
            gates.check("local", local | wrong, {"vocab_size": 256})
    large = {"tokenizer_name": "t", "deepspeed": "d", "resume_from_last_checkpoint": True, "data_dir": "./data/production/x", "output_dir": "./artifacts/production/x"}
    gates.check("production", large, {"vocab_size": 20000})
    with pytest.raises(ValueError):
        gates.check("production", large | {"data_dir": "./data/local_smoke/x"}, {"vocab_size": 20000})
    chat_run = large | {"data_dir": "./data/production/sft/x", "output_dir": "./artifacts/production/sft/x", "pretrained_model_path": "./artifacts/production/m"}
    gates.check("production_sft", chat_run, {"vocab_size": 20000})
    with pytest.raises(ValueError):
        gates.check("production_sft", chat_run | {"pretrained_model_path": None}, {"vocab_size": 20000})
    with pytest.raises(ZeroDivisionError):
        gates.check("local", local, {"vocab_size": 256}, lambda a, b: 1 / 0)
    with pytest.raises(ValueError):
        gates.check_smoke_path("/tmp/elsewhere")


def test_formats():
    assert [formats.tokens(n) for n in (5, 1500, 2_500_000, 1_234_000_000)] == ["5", "1.5K", "2.5M", "1.23B"]
    assert [formats.duration(n) for n in (-1, 5, 184, 3720)] == ["--", "5s", "3m04s", "1h02m"]
    assert formats.size(1.2e9) == "1.2 GB" and formats.size(2048, binary=True) == "2.0 KiB" and formats.speed(15200) == "15.2K tok/s"
    assert formats.parsed_size("10g") == 10 * 2**30 and formats.parsed_size("7") == 7
    with pytest.raises(ValueError):
        formats.parsed_size("ten")


def test_archives(tmp_path):
    import tarfile

    names = []
    for k in range(3):
        names.append(str(tmp_path / f"f{k}"))
        (tmp_path / f"f{k}").write_text(str(k))
    made = files.write_archives(names, str(tmp_path), "pack", [0, 0, 1])
    with tarfile.open(made[0]) as tar:
        assert tar.getnames() == ["f0", "f1"] and all(m.mtime == 0 for m in tar.getmembers())


class Syllables:
    """Ids of syllables of two letters, and an end of text."""

    eos_token_id, pad_token_id = 50, None

    def encode(self, text):
        return [ord(c) % 50 for c in text[::2]]

    def __len__(self):
        return 51


def test_tokenizer_plug_ins(spark, tmp_path):
    texts = ["lada", "mo", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    syllables = Syllables()
    run = lambda *a, **b: [r.ids for r in tokenizers.tokenized(df, *a, **b).orderBy("k").collect()]
    assert run(syllables) == [[*syllables.encode(t or ""), 50] for t in texts] and run(syllables, end=False)[2:] == [[], []]
    letters = tokenizers.CharacterTokenizer(99)
    assert run(letters) == [[*letters.encode(t or ""), letters.eos_token_id] for t in texts]
    marks = spark.createDataFrame([("é<|im_end|>\r😀<|im_start|>",), ("",), (None,), ("<|im_start|>" * 3,)], "text string")
    assert marks.where(F.coalesce(F.size(T.character_ids(F.col("text"))), F.lit(0)) != T.character_count(F.col("text"))).count() == 0
    letters.save(str(tmp_path))
    assert json.loads((tmp_path / "toy_tokenizer.json").read_text())["vocab_size"] == 99
    tokenizers.check_vocabulary(letters, 99)
    with pytest.raises(ValueError):
        tokenizers.check_vocabulary(letters, 98)
    with pytest.warns(UserWarning):
        tokenizers.check_vocabulary(letters, 99 + 4097)
    with pytest.raises(ValueError):
        tokenizers.check_ids(tokenizers.tokenized(df, syllables), 50)


def test_pretrained_tokenizers_from_files(spark):
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("word_bpe_49k.json"))
    mine = tokenizers.FileTokenizer(public.path("word_bpe_49k.json"))
    texts = ["Hello world, again.", "", None, "é😀\n x" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = [r.ids for r in tokenizers.tokenized(df, mine).orderBy("k").collect()]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(mine) == library.get_vocab_size() and mine.eos_token_id is None
    talks = spark.createDataFrame([([("user", "a b"), ("assistant", "c d")],)], f"messages {chat.MESSAGES}")
    row = chat.rendered_rows(talks, mine, 1000).first()
    parts = ["<|im_start|>user\n", "a b", "<|im_end|>", "\n", "<|im_start|>assistant\n", "c d", "<|im_end|>", "\n"]
    ids = [library.encode(p, add_special_tokens=False).ids for p in parts]
    assert row.ids == sum(ids, []) and [x for x in row.labels if x != -100] == ids[5] + ids[6]
    with pytest.raises(ValueError, match="no token"):
        _ = tokenizers.FileTokenizer(public.path("word_bpe_49k.json"), eos="no such token").eos_token_id


def test_registered_text_functions(spark):
    @T.text_function("shouted")
    def shouted(columns):
        return F.upper(F.col("cry")) if "cry" in columns else F.lit("")

    df = spark.createDataFrame([("a",)], "cry string")
    assert df.select(T.extracted(df.columns, [], named="shouted").alias("t")).first().t == "A"
    with pytest.raises(ValueError):
        T.extracted([], [], named="whispered")


def test_gates_allow_named_folders(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    run = {"tokenizer_name": "t", "deepspeed": "d", "resume_from_last_checkpoint": True, "data_dir": str(tmp_path / "disk" / "x"), "output_dir": "./artifacts/production/x"}
    assert gates.faults("production", run, {"vocab_size": 20000})
    gates.check("production", run, {"vocab_size": 20000}, also_in={"data_dir": [str(tmp_path / "disk")]})


def test_gates_name_every_missing_setting():
    said = gates.faults("production", {}, {})
    assert sum("is missing" in s for s in said) >= 3 and any("vocab_size" in s for s in said)
