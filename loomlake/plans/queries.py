"""The queries of the engine's own operators over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomlake.functions import text as T
from loomlake.operators import chat, filters, sequence
from loomlake.operators.permutation import place_sql
from loomlake.plans import recipe
from loomlake.plans.shared import BUDGET, CHAT_LENGTH, EST, FLAT, IDS, KEY, LENGTH, ORACLES, QUERIES, SHARE, VALID, flat, normal, packing_of, query, read, with_ids
from loomlake.sources import samples
from loomlake.sources.files import union
from loomlake.streaming import state


@query("SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 200 AND 12000")
def length_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.where(filters.compiled({"min_length": 200, "max_length": 12000}, F.col("text"), docs.columns)).select("doc_id", "n_chars")


@query(f"SELECT doc_id, {SHARE} AS share FROM documents WHERE {SHARE} >= 0.1")
def script_ratio_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    kept = docs.where(filters.compiled({"min_script_ratio": 0.1, "script": "[e]"}, F.col("text"), docs.columns))
    return kept.select("doc_id", T.script_share(F.col("text"), "[e]").alias("share"))


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality >= 1")
def quality_filter(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return rows.where(filters.compiled({"min_quality_score": 1, "quality_columns": ["quality"]}, F.col("text"), rows.columns)).select("doc_id", "quality")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def language_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.where(filters.compiled({"allowed_languages": ["en", "de"], "language_column": "lang"}, F.col("text"), docs.columns)).select("doc_id", "lang")


@query("SELECT event_id, value FROM events WHERE value > 50")
def comparison_filter(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    return rows.where(filters.compiled({"field": "value", "op": ">", "value": 50.0}, F.lit(""), rows.columns)).select("event_id", "value")


@query("SELECT event_id, coalesce(nullif(props, ''), nullif(event_type, ''), '') AS text FROM events")
def first_existing_text(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", T.first_filled(F.col("props"), F.col("event_type")).alias("text"))


@query("SELECT doc_id, md5(array_to_string(list_filter([trim(coalesce(lang, '')), trim(coalesce(source, ''))], lambda x: x <> ''), chr(10))) AS text FROM documents")
def joined_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.joined(F.col("lang"), F.col("source"))).alias("text"))


@query(f"SELECT doc_id, {EST} AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(f"SELECT source, count(*) AS docs, sum({EST})::BIGINT AS tokens FROM documents WHERE length(text) >= 200 GROUP BY source")
def estimate_by_source(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where(F.length("text") >= 200)
    return docs.groupBy("source").agg(F.count("*").alias("docs"), F.sum(T.token_estimate(F.col("text"))).alias("tokens"))


@query("SELECT doc_id, ('0x' || substr(sha256('42::' || source || '::' || doc_id), 1, 8))::BIGINT AS seed FROM documents")
def stable_seed(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.stable_seed(F.lit("42"), F.col("source"), F.col("doc_id").cast("string")).alias("seed"))


@query(f"SELECT doc_id FROM documents ORDER BY {KEY}, doc_id LIMIT 50")
def seeded_order_topk(spark, sf_dir):
    key = sequence.seeded_key(F.lit("42"), F.col("doc_id").cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id").orderBy(key, "doc_id").limit(50)


@query(f"SELECT doc_id, tokens FROM (SELECT doc_id, {EST} AS tokens, coalesce(sum({EST}) OVER (ORDER BY {KEY}, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) WHERE b < {BUDGET}")
def budgeted_prefix(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"), sequence.seeded_key(F.lit("42"), F.col("doc_id").cast("string")).alias("key"))
    return sequence.budgeted(rows, "tokens", "key", "doc_id", BUDGET, even=True).select("doc_id", "tokens")


@query(f"SELECT lang, doc_id, tokens FROM (SELECT lang, doc_id, {EST} AS tokens, coalesce(sum({EST}) OVER (PARTITION BY lang ORDER BY {KEY}, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) WHERE b < 20000")
def budget_by_lang(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("lang", "doc_id", T.token_estimate(F.col("text")).alias("tokens"), sequence.seeded_key(F.lit("42"), F.col("doc_id").cast("string")).alias("key"))
    return sequence.budgeted(rows, "tokens", "key", "doc_id", 20000, "lang", even=True).select("lang", "doc_id", "tokens")


@query(f"SELECT doc_id, len(ids) + 1 AS n, md5(array_to_string(list_append(ids, 1), ',')) AS ids FROM (SELECT doc_id, {IDS.format(t='text')} AS ids FROM documents)")
def toy_token_ids(spark, sf_dir):
    return with_ids(read(spark, sf_dir, "documents")).select("doc_id", F.size("ids").cast("long").alias("n"), flat(F.col("ids")).alias("ids"))


@query(f"SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE coalesce(source, '') END AS dataset, sum(coalesce(len({IDS.format(t='text')}), 0) + 1)::BIGINT AS tokens, count(*) AS docs FROM documents GROUP BY ROLLUP (source)")
def token_rollup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("source", (T.character_count(F.col("text")) + 1).cast("long").alias("n"))
    name = F.when(F.grouping("source") == 1, F.lit("TOTAL")).otherwise(F.coalesce("source", F.lit("")))
    return docs.rollup("source").agg(name.alias("dataset"), F.sum("n").alias("tokens"), F.count("*").alias("docs")).select("dataset", "tokens", "docs")


@query("SELECT doc_id, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM documents WHERE n_chars > 0")
def doc_offsets(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").where("n_chars > 0").select("doc_id", "n_chars")
    return sequence.running_before(rows, "n_chars", "doc_id", "doc_id", "off").select("doc_id", "off")


@query(f"WITH {FLAT} SELECT pos // {LENGTH} AS seq, md5(string_agg(id, ',' ORDER BY pos)) AS tokens FROM flat GROUP BY 1 HAVING count(*) = {LENGTH}")
def packed_sequences(spark, sf_dir):
    return packing_of(spark, sf_dir).sequences().select("seq", flat(F.col("tokens")).alias("tokens"))


@query(f"WITH {FLAT}, t AS (SELECT count(*) AS n, ((count(*) * 0.1::DOUBLE)::BIGINT // {LENGTH}) * {LENGTH} AS v FROM flat), s AS (SELECT pos // {LENGTH} AS seq, md5(string_agg(id, ',' ORDER BY pos)) AS tokens FROM flat GROUP BY 1 HAVING count(*) = {LENGTH}) "
       f"SELECT seq, tokens, CASE WHEN seq < (n - v) // {LENGTH} THEN 'train' ELSE 'val' END AS part FROM s, t WHERE seq < (n - v) // {LENGTH} + v // {LENGTH}")
def train_val_split(spark, sf_dir):
    packing = packing_of(spark, sf_dir)
    train, held = sequence.tail_split(packing.total, LENGTH, 0.1)
    rows = packing.sequences(most=train + held)
    return rows.select("seq", flat(F.col("tokens")).alias("tokens"), F.when(F.col("seq") < train // LENGTH, "train").otherwise("val").alias("part"))


@query(f"WITH RECURSIVE r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, doc_id FROM documents), w AS (SELECT source, k, doc_id, 0 AS shard, n_chars AS held FROM r WHERE k = 1 UNION ALL SELECT r.source, r.k, r.doc_id, CASE WHEN w.held >= 20000 THEN w.shard + 1 ELSE w.shard END, CASE WHEN w.held >= 20000 THEN r.n_chars ELSE w.held + r.n_chars END FROM w JOIN r ON r.source = w.source AND r.k = w.k + 1) SELECT source, doc_id, shard::BIGINT AS shard FROM w")
def raw_shard_cut(spark, sf_dir):
    return sequence.cut_by(read(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 20000).select("source", "doc_id", "shard")


@query("WITH RECURSIVE r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, doc_id FROM documents), w AS (SELECT source, k, doc_id, 0 AS batch, n_chars AS held FROM r WHERE k = 1 UNION ALL SELECT r.source, r.k, r.doc_id, CASE WHEN w.held + r.n_chars > 20000 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.held + r.n_chars > 20000 THEN r.n_chars ELSE w.held + r.n_chars END FROM w JOIN r ON r.source = w.source AND r.k = w.k + 1) SELECT source, doc_id, batch::BIGINT AS batch FROM w")
def archive_batches(spark, sf_dir):
    return sequence.cut_by(read(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 20000, sequence.NEXT_FIT, "batch").select("source", "doc_id", "batch")


@query(f"SELECT doc_id, k AS chunk, md5(array_to_string(ids[k * 1000 + 1 : k * 1000 + 1000], ',')) AS part FROM (SELECT doc_id, ids, unnest(range(0, (len(ids) - 1) // 1000 + 1)) AS k FROM (SELECT doc_id, list_append({IDS.format(t='text')}, 1) AS ids FROM documents))")
def fixed_chunk_cut(spark, sf_dir):
    return sequence.chunks(with_ids(read(spark, sf_dir, "documents")), 1000).select("doc_id", F.col("chunk").cast("long").alias("chunk"), flat(F.col("part")).alias("part"))


@query(f"WITH {VALID} SELECT conv_id, len(ms) AS n, md5(array_to_string(list_transform(ms, lambda m: m.role || ':' || m.content), chr(10))) AS messages FROM valid")
def chat_messages(spark, sf_dir):
    whole = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return normal(spark, sf_dir).select("conv_id", F.size("messages").cast("long").alias("n"), F.md5(whole).alias("messages"))


@query(f"WITH {VALID} SELECT conv_id FROM valid WHERE length(array_to_string(list_transform(ms, lambda m: m.content), chr(10))) BETWEEN 200 AND 3000 AND list_sum(list_transform(list_filter(ms, lambda m: m.role = 'assistant'), lambda m: length(m.content))) >= 50")
def chat_filters(spark, sf_dir):
    return normal(spark, sf_dir).where(chat.passes(F.col("messages"), 200, 3000, 50)).select("conv_id")


@query(f"WITH {VALID} SELECT conv_id FROM valid ORDER BY sha256('7::' || conv_id), conv_id LIMIT 20")
def chat_topn(spark, sf_dir):
    return normal(spark, sf_dir).select("conv_id").orderBy(F.sha2(F.concat_ws("::", F.lit("7"), F.col("conv_id").cast("string")), 256), "conv_id").limit(20)


_HEAD, _BODY = IDS.format(t="'<|im_start|>' || m.role || chr(10)"), IDS.format(t="m.content")
_CHAT_IDS = f"flatten(list_transform(ms, lambda m: list_concat({_HEAD}, {_BODY}, [3, 14])))[1:{CHAT_LENGTH}]".replace("lambda c:", "lambda c:")
_CHAT_LABELS = f"flatten(list_transform(ms, lambda m: list_concat(list_transform({_HEAD}, lambda h: -100), CASE WHEN m.role = 'assistant' THEN list_concat({_BODY}, [3]) ELSE list_transform(list_concat({_BODY}, [3]), lambda h: -100) END, [-100])))[1:{CHAT_LENGTH}]"


def _chat(spark, sf_dir):
    ids, labels = chat.rendered(F.col("messages"), CHAT_LENGTH)
    return normal(spark, sf_dir).select("conv_id", ids.alias("ids"), labels.alias("labels"))


@query(f"WITH {VALID} SELECT conv_id, md5(array_to_string({_CHAT_IDS}, ',')) AS ids, md5(array_to_string({_CHAT_LABELS}, ',')) AS labels FROM valid")
def chatml_render(spark, sf_dir):
    return _chat(spark, sf_dir).select("conv_id", flat(F.col("ids")).alias("ids"), flat(F.col("labels")).alias("labels"))


@query(f"WITH {VALID}, r AS (SELECT conv_id, {_CHAT_IDS} AS ids, (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS batch FROM valid), p AS (SELECT conv_id, ids, max(len(ids)) OVER (PARTITION BY batch) AS most FROM r) SELECT conv_id, most AS padded, md5(array_to_string(list_concat(ids, list_transform(range(most - len(ids)), lambda i: 0)), ',')) AS ids, len(ids) AS attended FROM p")
def padded_batches(spark, sf_dir):
    rows = chat.padded(_chat(spark, sf_dir), 8, "conv_id")
    return rows.select("conv_id", F.size("ids").cast("long").alias("padded"), flat(F.col("ids")).alias("ids"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("long").alias("attended"))


_SPLIT = "placed AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS place, count(*) OVER () AS n FROM valid), sized AS (SELECT *, greatest(1, (length(bin(n - 1)) + 1) // 2) AS bits FROM placed)"


@query(f"WITH {VALID}, {_SPLIT} SELECT conv_id, CASE WHEN {place_sql('place', 'n', 'bits', 42)} < greatest(1, floor(n * 0.1::DOUBLE)) THEN 'val' ELSE 'train' END AS part FROM sized")
def sft_split(spark, sf_dir):
    return chat.split(normal(spark, sf_dir).select("conv_id"), "conv_id", 0.1, 42)


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def anti_join_resume(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("SELECT doc_id FROM documents WHERE text <> '' AND length(regexp_replace(text, '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g')) >= 200 AND length(text) <= 12000")
def one_stage_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.where(filters.accepted({"max_chars": 12000}, F.col("text"), docs.columns, mode="one_stage", least=200)).select("doc_id")


@query("SELECT e.event_id FROM events e WHERE event_type <> 'purchase'")
def text_comparison(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    return rows.where(filters.compiled({"field": "event_type", "op": "!=", "value": "purchase"}, F.lit(""), rows.columns)).select("event_id")


@query("SELECT event_id FROM events WHERE event_id = 7")
def default_comparison(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    return rows.where(filters.compiled({"field": "event_id", "value": "7"}, F.lit(""), rows.columns)).select("event_id")


@query("SELECT d.doc_id FROM documents d JOIN labels USING (doc_id) WHERE quality >= 2 OR (quality >= 1 AND length(text) >= 100)")
def merged_filter(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    named = {"good": {"min_quality_score": 5, "quality_column": "quality", "min_chars": 100}}
    return rows.where(filters.compiled({"min_quality_score": 1}, F.col("text"), rows.columns, "good", named)).select("doc_id")


@query("SELECT doc_id, md5(coalesce(source, '') || chr(10) || coalesce(text, '')) AS text FROM documents")
def named_text(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("query"), F.col("text").alias("answer"))
    return rows.select("doc_id", F.md5(T.extracted(rows.columns, [], named="query_and_answer")).alias("text"))


_TWO = "SELECT doc_id, md5('user:' || {user} || chr(10) || 'assistant:' || trim(source)) AS messages FROM documents WHERE lang <> '' AND source <> ''"


def _layout(spark, sf_dir, layout, names):
    rows = read(spark, sf_dir, "documents").select("doc_id", *[F.col(a).alias(b) for b, a in names.items()])
    rows = rows.withColumn("m", chat.converted(rows, layout)).where("m IS NOT NULL")
    return rows.select("doc_id", F.md5(F.array_join(F.transform("m", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")).alias("messages"))


@query(_TWO.format(user="trim(lang) || chr(10) || chr(10) || trim(source)"))
def alpaca_layout(spark, sf_dir):
    return _layout(spark, sf_dir, "alpaca", {"instruction": "lang", "input": "source", "response": "source"})


@query(_TWO.format(user="trim(lang)"))
def prompt_response_layout(spark, sf_dir):
    return _layout(spark, sf_dir, "prompt_response", {"problem": "lang", "solution": "source"})


@query(_TWO.format(user="trim(lang)"))
def firefly_layout(spark, sf_dir):
    return _layout(spark, sf_dir, "firefly", {"input": "lang", "target": "source"})


@query(f"WITH {FLAT}, cut AS (SELECT pos - 1000 AS pos, id FROM flat WHERE pos >= 1000 AND pos < 61000) SELECT pos // {LENGTH} AS seq, md5(string_agg(id, ',' ORDER BY pos)) AS tokens FROM cut GROUP BY 1 HAVING count(*) = {LENGTH}")
def sub_stream_sequences(spark, sf_dir):
    return packing_of(spark, sf_dir).sequences(1000, 60000).select("seq", flat(F.col("tokens")).alias("tokens"))


@query(f"WITH {VALID} SELECT conv_id FROM (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS k FROM valid) WHERE k > 10")
def resume_skip(spark, sf_dir):
    return sequence.resumed(normal(spark, sf_dir).select("conv_id"), 10, ["conv_id"]).select("conv_id")


@query("SELECT i AS pos, ((((i % 128) // 4 + 1) * [1, 3, 5, 7][(i % 4 + 1)::INT]) % 256)::INT AS token FROM range(4096) t(i)")
def synthetic_tokens(spark, sf_dir):
    return samples.token_stream(spark)


@query("SELECT name, sum(target)::BIGINT AS target, sum(target // 5000000)::BIGINT AS shards, sum(target * 4)::BIGINT AS bytes, grouping(name)::INT AS is_total FROM (VALUES ('a', 12000000), ('b', 4000000)) t(name, target) GROUP BY ROLLUP (name)")
def plan_table(spark, sf_dir):
    chosen = {"datasets": [{"name": "a", "target_tokens": 24_000_000}, {"name": "b", "target_tokens": 8_000_000}, {"name": "c", "target_tokens": 1, "enabled": False}]}
    return recipe.plan(spark, recipe.datasets(chosen, scale=0.5))


@query("SELECT 'documents' AS source, doc_id AS id, lang FROM documents UNION ALL SELECT 'pages', page_id, NULL FROM pages")
def union_of_datasets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "lang")
    return union([docs, read(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"))]).select("source", "id", "lang")


@query("SELECT doc_id FROM documents ANTI JOIN (SELECT doc_id || ':' || n_chars AS id FROM documents WHERE lang = 'en') p ON doc_id || ':' || n_chars = p.id")
def packed_skip(spark, sf_dir):
    files = read(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").cast("string").alias("path"), F.col("n_chars").alias("size"))
    return state.not_packed(files, files.where("lang = 'en'").withColumn("id", state.stable_id())).select("doc_id")


@query("SELECT doc_id FROM documents SEMI JOIN labels USING (doc_id)")
def already_published(spark, sf_dir):
    return state.removable(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality * 2 >= 2 AND length(text) >= 300")
def registered_filter(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").withColumn("int_score", F.col("quality") * 2)
    return rows.where(filters.compiled({"min_chars": 300}, F.col("text"), rows.columns, "fineweb_edu")).select("doc_id")


@query(f"WITH {FLAT} SELECT 3 AS seq, md5(string_agg(id, ',' ORDER BY pos)) AS tokens FROM flat WHERE pos // {LENGTH} = 3")
def sequence_by_place(spark, sf_dir):
    packing = packing_of(spark, sf_dir)
    return sequence.sequence_at(packing.sequences(), packing.total // LENGTH, 3).select(F.col("seq").cast("int").alias("seq"), flat(F.col("tokens")).alias("tokens"))


@query(f"WITH {FLAT}, s AS (SELECT pos // {LENGTH} AS seq, md5(string_agg(id, ',' ORDER BY pos)) AS ids FROM flat GROUP BY 1 HAVING count(*) = {LENGTH}) SELECT seq, ids AS input_ids, ids AS labels FROM s")
def sequence_labels(spark, sf_dir):
    rows = chat.collated(packing_of(spark, sf_dir).sequences())
    return rows.select("seq", flat(F.col("input_ids")).alias("input_ids"), flat(F.col("labels")).alias("labels"))


@query(f"WITH {VALID}, r AS (SELECT conv_id, {_CHAT_IDS} AS ids, {_CHAT_LABELS} AS labels FROM valid) SELECT conv_id, md5(array_to_string(list_transform(list_filter(range(1, len(ids)), lambda i: labels[i + 1] <> -100), lambda i: ids[i] || ':' || labels[i + 1]), ',')) AS pairs FROM r")
def next_token_labels(spark, sf_dir):
    pairs = F.transform(chat.aligned(F.col("labels"), F.col("ids")), lambda p: F.concat_ws(":", p["id"].cast("string"), p["next"].cast("string")))
    return _chat(spark, sf_dir).select("conv_id", F.md5(F.array_join(pairs, ",")).alias("pairs"))
