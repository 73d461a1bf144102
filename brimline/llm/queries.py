"""Registered queries of this subpackage, each over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brimline.llm import (
    decontamination, infill, jaccard, lm, mixing, phrases, pieces, pii, quality, resampling, token_files, topk, toxicity, training,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", training.held_out().alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", training.held_out().alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_spans(table(spark, sf, "documents").select("doc_id", "text")))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.digest(decontamination.find(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op5_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf, "embeddings"), 256)
    return topk.top_k(vectors.where("id % 50 = 0"), vectors, 5).withColumnRenamed("id", "vec_id")


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text", "ids")


def op7_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_lm(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return lm.score(table(spark, sf, "documents"), target)


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.read_tokens(*token_files.write_tokens(table(spark, sf, "documents"), path))


def op10_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.without_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_infill(spark: SparkSession, sf: str) -> DataFrame:
    return infill.digest(infill.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text")))


def op12_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.ranks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.rates(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_topk": op5_topk,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_jaccard": op7_jaccard,
    "op8_lm": op8_lm,
    "op9_token_files": op9_token_files,
    "op10_phrases": op10_phrases,
    "op11_infill": op11_infill,
    "op12_resampling": op12_resampling,
    "op13_mixing": op13_mixing,
}

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL: dict[str, str] = {
    "op4_decontamination": f"""
with d as (select doc_id, row_number() over () as r, {WORDS} as w from documents),
i as (select item_id, {WORDS} as w from benchmark),
n as (select *, least(len(w), 13) as size from i where len(w) > 0),
win as (select distinct item_id, size, array_to_string(w[s:s + size - 1], ' ') as win
        from n, unnest(range(1, len(w) - size + 2)) as t(s)),
sizes as (select distinct size from win),
dw as (select r, s, size, array_to_string(w[s:s + size - 1], ' ') as win
       from d, sizes, unnest(range(1, len(w) - size + 2)) as t(s)),
hit as (select r, s, dw.size, item_id from dw join win on dw.size = win.size and dw.win = win.win),
covered as (select r, count(distinct p) as n_hit from hit, unnest(range(s, s + size)) as t(p) group by r),
items as (select r, count(distinct item_id) as n_items,
                 string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from d left join covered using (r) left join items using (r)""",
    "op5_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id as vec_id,
                  cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
           from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5""",
    "op11_infill": r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
             cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from d),
c as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from u),
p as (select doc_id, t, n, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
                  when h4 % 100 < 50 then 'spm' else 'psm' end as form from c),
o as (select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                          else '<S>' || s || '<P>' || p || '<M>' || m end as output,
             case form when 'plain' then t else p || m || s end as restored from p)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars, sha256(output) as output_sha256, sha256(restored) as restored_sha256
from o""",
}
