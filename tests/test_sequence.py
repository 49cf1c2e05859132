"""Order-dependent operators against loops: sums, budgets, cuts and packing, with one range of rows and with many."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlake.operators import cuts, packing, ranges, sequence


@pytest.fixture(params=["one range", "many ranges"])
def dealt(request, monkeypatch):
    if request.param == "many ranges":
        monkeypatch.setattr(ranges, "RANGE_ROWS", 40)
        monkeypatch.setattr(packing, "PACK_ROWS", 40)
    return request.param


def test_borders_divide_keys(spark):
    at = [-5, 0, 7, 10**15]
    keys = [-100, -5, -1, 0, 6, 7, 8, 10**15, 10**16]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert [r.n for r in df.select(ranges.range_of("k", at).alias("n")).collect()] == [int(np.searchsorted(at, k, "right")) for k in keys]


def test_running_sums_keep_null_groups(spark, dealt):
    rows = [(k, None if k % 3 == 0 else k % 3, k % 7) for k in range(700)]
    df = spark.createDataFrame(rows, "k long, g int, v long").repartition(5)
    got = {r.k: r.before for r in sequence.running_before(df, "v", "k", "k", by="g").collect()}
    assert got == {k: sum(v for j, h, v in rows if h == g and j < k) for k, g, _ in rows}
    kept = {r.k for r in sequence.budgeted(df, "v", "k", "k", 100, "g").collect()}
    assert kept == {k for k in got if got[k] < 100}
    assert sequence.budgeted(df, "v", "k", "k", 0).count() == 0


def test_budget_reads_only_ranges_before_it(spark):
    df = spark.range(3000).select("id", F.lit(1).alias("v"), sequence.seeded_key(F.col("id").cast("string")).alias("key"))
    order = [r.id for r in df.orderBy("key").collect()]
    got = sequence.budgeted(df, "v", "key", "id", 25, even=True)
    assert {r.id for r in got.collect()} == set(order[:25])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("BroadcastHashJoin")  # the join that prunes is below the sort


def sizes_of(case, rng):
    return {
        "mixed": lambda: [rng.choice((0, 1, 3, 9, 30, 200)) for _ in range(900)],
        "zeros": lambda: [0] * 300 + [5] * 300 + [0] * 300,
        "large": lambda: [1000] * 500,
        "ones": lambda: [1] * 900,
        "rare": lambda: [0 if rng.random() < 0.99 else 400 for _ in range(900)],
    }[case]()


@pytest.mark.parametrize("case", ["mixed", "zeros", "large", "ones", "rare"])
def test_cuts_equal_the_loops(spark, dealt, case):
    rng = random.Random(3)
    rows = [("a", k, n) for k, n in enumerate(sizes_of(case, rng))] + [(None, k * 7, rng.randrange(9)) for k in range(200)] + [("b", 5, None), ("b", 6, 500), ("b", 9, 1)]
    df = spark.createDataFrame(rows, "d string, k long, n long").repartition(4)
    for rule, loop in ((cuts.GREEDY, cuts.greedy_shards), (cuts.NEXT_FIT, cuts.next_fit)):
        for limit in (1, 100) if case == "mixed" else (250,):
            want = []
            for name in ("a", None, "b"):
                step = loop(limit)
                want += [(str(name), k, n, step(n or 0)) for d, k, n in sorted((r for r in rows if r[0] == name), key=lambda r: r[1]) if d == name]
            got = [(str(r.d), r.k, r.n, r.shard) for r in cuts.cut_by(df, "d", "k", "n", limit, rule).collect()]
            assert sorted(got, key=str) == sorted(want, key=str), (rule, limit)
    assert cuts.cut_by(df.limit(0), "d", "k", "n", 5).count() == 0
    with pytest.raises(ValueError):
        cuts.cut_by(df, "d", "k", "n", 0)


def test_one_dataset_is_cut_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 40)
    df = spark.range(2000).select(F.lit("a").alias("d"), F.col("id").alias("k"), (F.col("id") % 17).alias("n"))
    assert df.select(ranges.range_of("k", ranges.borders(df, "k"))).distinct().count() == 50
    got = {r.k: r.shard for r in cuts.cut_by(df, "d", "k", "n", 100).collect()}
    step = cuts.greedy_shards(100)
    assert got == {k: step(k % 17) for k in range(2000)}


def documents(rng, most):
    out = []
    for k in range(400):
        out.append((k * 3, [rng.randrange(10**6) for _ in range(rng.choice((0, 1, 2, most)))]))
    return out


@pytest.mark.parametrize("most,length", [(5, 4), (3, 700), (2000, 64), (40, 1)])
def test_packing_equals_concatenation(spark, dealt, most, length):
    docs = documents(random.Random(most), most)
    flat = [t for _, ids in docs for t in ids]
    df = spark.createDataFrame([*docs, (1, None)], "doc_id long, ids array<int>").repartition(5)
    made = packing.Packing(df, length)
    assert made.total == len(flat)
    for offset, many in ((0, None), (1, 3000), (999, 1), (len(flat), None), (length * 2, None), (37, length * 3 + 1)):
        if offset > len(flat):
            continue
        end = len(flat) if many is None else min(len(flat), offset + many)
        want = {k: flat[a : a + length] for k, a in enumerate(range(offset, end - length + 1, length))}
        assert {r.seq: r.tokens for r in made.sequences(offset, many).collect()} == want, (offset, many)
    with pytest.raises(ValueError):
        made.sequences(len(flat) + 1)


def test_repeated_ids_are_packed_once(spark, dealt):
    df = spark.createDataFrame([(1, [1, 2, 3]), (1, [4, 5, 6]), (2, [7, 8])], "doc_id long, ids array<int>")
    got = [r.tokens for r in packing.packed(df, 2).orderBy("seq").collect()]
    assert sorted(map(tuple, got)) == [(1, 2), (3, 4), (5, 6), (7, 8)] or sorted(sum(got, [])) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert got[3] == [7, 8] and sorted(sum(got, [])) == list(range(1, 9))
    same = spark.createDataFrame([(7, [1, 2, 3])] * 200, "doc_id long, ids array<int>").repartition(6)
    assert [r.tokens for r in packing.packed(same, 3).collect()] == [[1, 2, 3]] * 200


def test_packing_refuses_wrong_counts(spark):
    df = spark.createDataFrame([(1, [1, 2, 3])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="as many tokens"):
        packing.packed(df, 2, n=F.lit(5)).collect()


def test_packing_shuffles_tokens_once(spark):
    df = spark.createDataFrame([(1, [1, 2, 3])], "doc_id long, ids array<int>")
    plan = packing.packed(df, 2)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange ") - plan.split("== Physical Plan ==")[1].count("BroadcastExchange ") <= 1


def test_nothing_to_pack(spark):
    df = spark.createDataFrame([], "doc_id long, ids array<int>")
    assert packing.packed(df, 2).count() == 0
