"""The registered queries of the subpackage: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import align, chat, html, langid, mixing, quality, search, secrets, simhash, substrings, templates, toxicity, vectors
from millrace.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
#: The same rows in SQL, where that can be said: the others fit models, parse markup, hash with XXH64 or iterate, and the tests hold them against brute force.
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def with_sql(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        ORACLES[fn.__name__] = sql
        return query(fn)

    return register


#: What the contract adds to the conversations: both turns try to break the template.
PROBE = "\\### Assistant: </turn> ok"


# A turn is "### role: text</turn>" and a line feed. Text that would not come back has a backslash before every control string, and one before every backslash if
# backslashes are what it breaks on.
CHAT_SQL = rf"""
with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}'),
e as (select *, regexp_matches(text, '\\[\\#<:]') or ends_with(text, '\') as slashed, regexp_matches(text, '### |</turn>') as marked,
             len(regexp_extract_all(text, '### |</turn>|: ')) as marks, len(regexp_extract_all(text, '\\')) as slashes from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(14 + length(role) + length(text) + case when slashed then marks + slashes when marked then marks else 0 end)::bigint as formatted_chars
from e group by conv_id"""


@with_sql(CHAT_SQL)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(turns))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("secret_sha256", F.sha2(F.col("value"), 256)).drop("text_hash", "value")


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("text_hash")


VECTOR_SQL = """
with recursive v as (select vec_id, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as length from embeddings),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
         where list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.95::double),
reach as (select vec_id as a, vec_id as r from v union select reach.a, link.b from reach join link on reach.r = link.a)
select vec_id, (select count(*) from link where a = vec_id) as n_links, (select min(r) from reach where a = vec_id) as component_id,
       vec_id = (select min(r) from reach where a = vec_id) as kept from v"""


@with_sql(VECTOR_SQL)
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


REPEATS_SQL = r"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
w as (select doc_id, pos, array_to_string(list_slice(words, pos, pos + 19), ' ') as win from (select doc_id, words, unnest(range(1, len(words) - 18)) as pos from d)),
again as (select doc_id, pos from (select doc_id, pos, row_number() over (partition by win order by doc_id, pos) as nth from w) where nth > 1),
gone as (select doc_id, list(distinct pos + k) as places from again, range(20) r(k) group by doc_id),
kept as (select d.doc_id, words, list_filter(words, lambda x, i: not coalesce(list_contains(places, i), false)) as left_over from d left join gone on d.doc_id = gone.doc_id)
select doc_id, len(words) as n_words, len(words) - len(left_over) as n_removed, sha256(array_to_string(left_over, ' ')) as kept_sha256 from kept"""


@with_sql(REPEATS_SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(langid.learnable("doc_id")))
    return toxicity.score(docs, field).select("doc_id", langid.held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), any_case=True).drop("text_hash")


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.LanguageModel.fit(docs.filter(langid.learnable("doc_id")))
    return model.predict(docs.select("doc_id", "text")).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(quality.learnable("doc_id")))
    return quality.score(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


#: Where the vocabulary files of the public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


SEARCH_SQL = r"""
with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
sizes as (select doc_id, count(*) as n from t group by doc_id),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes),
tf as (select doc_id, term, count(*) as tf from t where term in (select term from q) group by doc_id, term),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, totals group by term, n_docs),
hits as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint as score
         from q join tf using (term) join w using (term) join sizes using (doc_id), totals group by item_id, doc_id),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score from hits where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10"""


@with_sql(SEARCH_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
