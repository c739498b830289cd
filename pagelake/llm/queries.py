"""The registered queries of this subpackage: each operator with its production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import read_table

from . import annsearch, chat, collocations, decontam, langmodel, packing, ranking, sharding, simhash, sketches, suffixdedup, tokens, toxicity
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langmodel.held_out(F.col("doc_id"), 4, 2)
    return langmodel.identify(docs, ~out).select(
        "doc_id", langmodel.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "bits", "rejected"
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.find_contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), window=10))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), capacity=2048, tokenizer="word_bpe_49k.json", end_id=1)


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(suffixdedup.remove_repeats(documents(spark, sf_dir), length=100))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), tokenizer="byte_bpe_50k.json", limit=1024)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(
        documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), lambda i: ~langmodel.held_out(i, 3, 1), threshold=0.7
    )
    return scored.select("doc_id", langmodel.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


@query
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return annsearch.search(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, bits=3)


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), shards=40)


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_documents(documents(spark, sf_dir), scale=4)


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), k=10)


SQL["op12_ranked_search"] = r"""
with occurrence as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from documents),
tf as (select doc_id, term, count(*) as tf from occurrence group by all),
length as (select doc_id, sum(tf)::bigint as n from tf group by all),
total as (select count(*) as docs, sum(n)::bigint as terms from length),
weight as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from tf, total group by term, docs),
asked as (
  select item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from benchmark),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::bigint as score
  from asked join tf using (term) join weight using (term) join length using (doc_id), total group by all having score > 0)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored qualify rank <= 10
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir), top=2000, least=10)


SQL["op13_collocations"] = r"""
with words as (
  select coalesce(lang, 'und') as lang, row_number() over () as piece,
    regexp_extract_all(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(coalesce(text, ''), '[.,;:!?\x0A-\x0D]')) as piece from documents)),
grams as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, w[i : i + k - 1] as part
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from words), (select unnest([1, 2, 3]) as k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, any_value(part) as part, count(*)::hugeint as a from grams group by lang, k, phrase),
total as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
cut as (
  select c.lang, c.k, c.phrase, c.part, c.a, cut, x.a as l, y.a as r, (1000000 * c.a * c.a) // (x.a * y.a) as score
  from (select *, unnest(range(1, k)) as cut from f where k > 1 and a >= 10) c
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.part[1 : cut], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.part[cut + 1 : c.k], ' ')),
candidate as (select * from cut qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
held as (
  select lang, phrase, max(a) as longer
  from (select lang, a, unnest([array_to_string(part[1:2], ' '), array_to_string(part[2:3], ' ')]) as phrase from candidate where k = 3) group by all),
kept as (
  select c.* from candidate c left join held h on h.lang = c.lang and h.phrase = c.phrase and c.k = 2
  where h.longer is null or 100 * h.longer < 50 * c.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
  a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from kept join total using (lang) qualify rank <= 2000
"""


def _chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from the conversations by a fixed rule: every assistant turn is a call with an
    identifier of its turn, whole text included; every other turn (a null role, too) is a result, of the turn before
    it, or without an identifier if its turn is divisible by 7. The call needs the one of half its turn's number.
    Some calls break their schema."""
    c = conversations.withColumn("n", F.length("text"))
    call = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    parent = F.concat(F.lit("$c"), F.col("conv_id").cast("string"), F.lit("-"), ((F.col("turn") / 4).cast("long") * 2 + 1).cast("string"))
    source = F.when(F.col("turn") >= 3, parent)
    calls = c.where("role = 'assistant'").select(
        "conv_id",
        call.alias("call_id"),
        "turn",
        F.when(F.col("n") % 3 == 0, "search").when(F.col("n") % 3 == 1, "note").otherwise("count").alias("name"),
        F.when(F.col("n") % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.when(F.col("n") % 7 != 0, F.col("n")).alias("limit"), source.alias("source"))))
        .when(F.col("n") % 3 == 1, F.to_json(F.struct(F.col("text").alias("text"), F.when(F.col("n") % 5 == 0, True).alias("pinned"), source.alias("source"))))
        .otherwise(F.to_json(F.struct(F.col("n").cast("string").alias("total"), F.col("text").alias("of"), source.alias("source"))))
        .alias("arguments"),
    )
    before = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string"))
    answers = F.when(F.col("turn") % 7 != 0, before).alias("call_id")
    results = c.where("coalesce(role, '') <> 'assistant'").select("conv_id", answers, "turn", F.col("text").alias("content"))
    return calls, results


CHAT_SCHEMAS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("search", "source", "string", False),
    ("note", "text", "string", True),
    ("note", "source", "string", False),
    ("count", "of", "string", True),
    ("count", "total", "integer", True),
    ("count", "source", "string", False),
]


@query
def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = _chat_calls(read_table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(CHAT_SCHEMAS, "name string, param string, type string, required boolean")
    return chat.link_calls(calls, results, schemas)


SQL["op8_tool_calls"] = """
with recursive c as (select conv_id, turn, role, text, length(text) as n from conversations),
calls as (
  select conv_id, 'c' || conv_id || '-' || turn as call_id, turn, text, n,
    case n % 3 when 0 then 'search' when 1 then 'note' else 'count' end as name,
    case when turn >= 3 then '$c' || conv_id || '-' || ((turn // 4) * 2 + 1) end as source
  from c where role = 'assistant'),
results as (
  select conv_id, case when turn % 7 <> 0 then 'c' || conv_id || '-' || (turn - 1) end as call_id, turn, text as content
  from c where coalesce(role, '') <> 'assistant'),
canon as (
  select *, case name
      when 'search' then '{' || case when n % 7 <> 0 then '"limit":' || n || ',' else '' end || '"query":' || to_json(text)
      when 'note' then '{' || case when n % 5 = 0 then '"pinned":true,' else '' end
      else '{"of":' || to_json(text) end
    || case when name = 'note' then case when source is not null then '"source":' || to_json(source) || ',' else '' end || '"text":' || to_json(text)
       else case when source is not null then ',"source":' || to_json(source) else '' end end
    || case when name = 'count' then ',"total":"' || n || '"' else '' end || '}' as arguments,
    case when name = 'search' and n % 7 = 0 then ['missing:limit'] when name = 'note' and n % 5 = 0 then ['unknown:pinned']
         when name = 'count' then ['type:total'] else [] end as faults,
    substr(source, 2) as need
  from calls),
known as (
  select k.*, p.call_id is not null as met, case when k.need is not null and p.call_id is null then ['need:' || k.need] else [] end as lost
  from canon k left join canon p on p.conv_id = k.conv_id and p.call_id = k.need),
staged(conv_id, call_id, stage) as (
  select conv_id, call_id, 0 from known where not met
  union all
  select k.conv_id, k.call_id, s.stage + 1 from known k join staged s on s.conv_id = k.conv_id and s.call_id = k.need where k.met),
joined as (
  select coalesce(k.conv_id, r.conv_id) as conv_id, coalesce(k.call_id, r.call_id) as call_id, k.turn as called, r.turn as answered, k.name, k.arguments,
    r.content, list_concat(coalesce(k.faults, []), coalesce(k.lost, [])) as errors,
    case when coalesce(k.call_id, r.call_id) is null then 'no_id' when k.call_id is null then 'no_call' when r.call_id is null then 'no_result' else 'linked' end as status
  from known k full join results r on r.conv_id = k.conv_id and r.call_id = k.call_id)
select j.conv_id, j.call_id, coalesce(j.called, j.answered) as turn, j.status, s.stage::int as stage, array_to_string(j.errors, ',') as errors,
  '{"arguments":' || coalesce(j.arguments, 'null') || ',"duplicates":0,"errors":' || to_json(j.errors)::varchar || ',"id":' || coalesce(to_json(j.call_id)::varchar, 'null')
  || ',"name":' || coalesce(to_json(j.name)::varchar, 'null') || ',"result":' || coalesce(to_json(j.content)::varchar, 'null') || ',"status":"' || j.status || '"}' as message
from joined j left join staged s on s.conv_id = j.conv_id and s.call_id = j.call_id
"""
