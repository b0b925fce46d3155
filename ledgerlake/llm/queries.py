"""The registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ledgerlake.llm import (
    divergence,
    language_mix,
    lattice_sampling,
    main_text,
    merge_automaton,
    near_dup,
    order_minhash,
    packing,
    periodic_runs,
    pii,
    quality,
    token_counts,
    top_k,
)
from ledgerlake.llm.common import table

#: The place of a vocabulary file by its name.
TOKENIZERS = public_tokenizers.path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op4_minhash_near_dedup")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_cost_balanced_packing")
def cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZERS("word_bpe_49k.json"))


@query("op10_language_mixture")
def language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.identified(table(spark, sf_dir, "documents"))


@query("op9_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(table(spark, sf_dir, "documents"))


@query("op3_quality_network")
def quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_site_templates")
def site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


TOP_K = """
with usable as (
    select distinct vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as w
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.w, c.w, true), lambda p: p[1] * p[2])) as bigint) as score
    from usable q join usable c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
where rank <= 20
"""


@query("op5_exact_top_k", TOP_K)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.searched(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_order_minhash")
def order_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compared(table(spark, sf_dir, "documents"))


@query("op1_token_counts")
def section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = TOKENIZERS("byte_bpe_50k.tiktoken")
    return token_counts.attributed(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


#: Segmentations of each text that the sampling query asks for.
SEGMENTATIONS = 2


@query("op2_sampled_segmentations")
def sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = TOKENIZERS("piece_bpe_32k.model")
    return lattice_sampling.sampled(table(spark, sf_dir, "documents"), model, SEGMENTATIONS, ids=False, digest=True)


@query("op13_merge_automaton")
def merge_automaton_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = merge_automaton.round_trip(table(spark, sf_dir, "documents"), TOKENIZERS("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _words(text):
    return F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))


def _with_planted_run(docs: DataFrame) -> DataFrame:
    """doc_id, text: the words of every tenth document by crc32 of its id repeat with a period
    from some word on; a null id plants nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("__words"), F.floor(h / 10)
    a = g % n
    period = 1 + F.floor((n - a) / (3 + g % 8))
    places = F.transform(
        F.sequence(F.lit(0).cast("long"), n - F.lit(1).cast("long")), lambda i: F.when(i < a, i).otherwise(a + (i - a) % period)
    )
    words = F.transform(places, lambda i: F.get("__words", i.cast("int")))
    planted = (h % 10 == 0) & (n > 0)
    listed = docs.withColumn("__words", F.when(h % 10 == 0, _words(F.col("text"))))
    return listed.select("doc_id", F.when(planted, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def runs_of(docs: DataFrame) -> DataFrame:
    """The digests of the runs of ``docs`` after planting."""
    found = periodic_runs.found(_with_planted_run(docs.select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_periodic_runs")
def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_of(table(spark, sf_dir, "documents"))


DIVERGENCE = r"""
with docs as (
    select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
    from documents
),
words as (select id, lang, source, unnest(words) as term from docs),
kept as (select lang, term, count(*) as c from words group by lang, term having count(distinct id) >= 30),
langs as (select lang, count(*) as v, sum(c) as n from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as g from words group by lang, source, term),
cells as (
    select lang, source, term, c, coalesce(g, 0) as g
    from groups join kept using (lang) left join counts using (lang, source, term)
),
totals as (select lang, source, sum(g) as n from cells group by lang, source),
shares as (
    select lang, source, term, g,
           1 + (1000000000::hugeint * (g + 5)) // (totals.n + 5 * v)::hugeint as p,
           1 + (1000000000::hugeint * (c + 5)) // (langs.n + 5 * v)::hugeint as q
    from cells join totals using (lang, source) join langs using (lang)
),
differences as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all
),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(d.value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join differences d on d.lang = a.lang and d.source = a.source and d.item = b.source
),
terms as (select lang, source, 'term' as part, term as item, p - q as value from shares where g > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from pairs union all select * from terms)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50
"""


@query("op11_source_divergence", DIVERGENCE)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))
