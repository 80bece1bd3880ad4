"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import (
    byte_repeats, digests, line_quality, mixing, ngram_join, packing, personal_data, pivot_clusters, shards, spelling, substrings, url_rules,
    vector_links,
)

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_read(spark, sf_dir, "documents"), n=35).drop("kept")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.fingerprints(_read(spark, sf_dir, "documents")).drop("text", "edited")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(_read(spark, sf_dir, "pages"), rules)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.detect(_read(spark, sf_dir, "documents")).drop("text", "redacted")


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link_vectors(_read(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").filter(~line_quality.held_out()).select("doc_id", F.col("quality").alias("label"))
    model = line_quality.train(documents, labels)
    return line_quality.score(documents, model).select(
        "doc_id", line_quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(_read(spark, sf_dir, "documents"), n=4, percent=85).drop("h", "component")


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of all documents with its slot, read back from the written shards."""
    return shards.sequences(shards.write_shards(_read(spark, sf_dir, "documents")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_read(spark, sf_dir, "documents")).taken.drop("h", "source")


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.cluster_vectors(_read(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.remove_repeats(_read(spark, sf_dir, "documents"), n=200).drop("kept")


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_fingerprints, op3_url_filter, op4_packing, op5_personal_data, op6_vector_links, op7_line_quality, op8_ngram_join, op9_training_order, op10_mixing,
    op11_pivot_clusters, op12_spelling_variants, op13_byte_repeats,
)}
QUERIES["pipeline"] = corpus_pipeline.run



def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round: squared distances as |v|^2 + |c|^2 - 2 v.c, whole numbers far below 2^53; floor of sums by exact division."""
    ctes = [f"""
kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double))::bigint[] as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as cluster, v as c
  from kept order by sha256('2:' || vec_id), v limit {k}
)"""]
    for i in range(rounds + 1):
        ctes.append(f"""
a{i} as materialized (
  select row, any_value(vec_id) as vec_id, any_value(v) as v, min((distance, cluster)) as best
  from (
    select row, vec_id, v, cluster, (list_dot_product(v::double[], v::double[]) + list_dot_product(c::double[], c::double[])
      - 2 * list_dot_product(v::double[], c::double[]))::bigint as distance
    from kept, c{i}
  ) group by row
)""")
        if i < rounds:
            ctes.append(f"""
c{i + 1} as materialized (
  select cluster, coalesce(m.c, c{i}.c) as c
  from c{i} left join (
    select cluster, list((s - ((s % n) + n) % n) // n order by pos) as c
    from (select best[2] as cluster, pos, sum(x)::bigint as s, count(*) as n
          from (select best, unnest(v) as x, generate_subscripts(v, 1) as pos from a{i}) group by 1, 2)
    group by cluster
  ) m using (cluster)
)""")
    return "with" + ",".join(ctes) + f"""
select vec_id, cluster::int as cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from (select vec_id, best[1] as distance, best[2] as cluster from a{rounds}) join c{rounds} using (cluster)
"""


ORACLES = {
    "op11_pivot_clusters": _cluster_sql(),
    "op3_url_filter": """
with parts as (
  select page_id, coalesce(contains(url, '://'), false) as given, substr(url, instr(url, '://') + 3) as rest from pages
), judged as (
  select page_id,
    case when given then translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when given then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path
  from parts
), rules(rhost, rpath, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits as (
  select page_id, host, path, rhost || rpath as rule, verdict,
    row_number() over (partition by page_id order by length(rhost || rpath) desc nulls last) as place
  from judged left join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where place = 1
""",
}
