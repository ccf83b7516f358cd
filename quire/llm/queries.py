"""The registered queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, chat, language, lines, media, near, packing, repeats, suffix_tree, topk

MULTI_RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PACKING_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def tokenizer_path(default: str) -> str:
    """The place of a public vocabulary file: the installed package's, else the default path."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return default
    return public_tokenizers.path(default.rpartition("/")[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents"), length=100)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_dedup(table(spark, sf_dir, "documents"), min_lines=2)
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_quotations(table(spark, sf_dir, "conversations"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_tree.suffix_tree_scores(docs.select("doc_id", "text", (language.remainder("doc_id", 5) == 1).alias("held_out")), represented=True)


def op8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(tokenizer_path(MULTI_RANKS))
    return bpe.encode_decode(table(spark, sf_dir, "documents"), ranks)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_of(table(spark, sf_dir, "documents"))


def packing_of(docs: DataFrame) -> DataFrame:
    from quire.llm import common

    with open(tokenizer_path(PACKING_VOCABULARY), "rb") as f:
        ranks, special = packing.json_vocabulary(f.read())
    return packing.pack(common.cut(packing.pieces(docs, ranks, special, end_id=1), "pieces"))


def queries() -> dict:
    return {"op1_media": op1_media, "op2_topk": op2_topk, "op3_repeats": op3_repeats, "op4_language": op4_language, "op5_lines": op5_lines, "op6_chat": op6_chat, "op7_suffix_tree": op7_suffix_tree, "op8_near": op8_near, "op9_bpe": op9_bpe, "op10_packing": op10_packing}


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


LINES_SQL = """
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), w AS (
  SELECT doc_id, i, ls[i] || chr(10) || ls[i + 1] AS u FROM (SELECT doc_id, ls, unnest(range(1, len(ls))) AS i FROM l)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY u ORDER BY doc_id, i) AS r FROM w WHERE regexp_matches(u, '\\S')) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i FROM later UNION ALL SELECT doc_id, i + 1 FROM later)
), runs AS (
  SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gone) GROUP BY doc_id, g
), totals AS (
  SELECT doc_id, sum(n)::BIGINT AS n_removed, count(*) AS n_runs, max(n) AS longest_run FROM runs GROUP BY doc_id
), kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) AS t
  FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM l) e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT l.doc_id, len(ls)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs,
       coalesce(longest_run, 0)::BIGINT AS longest_run, sha256(coalesce(t, '')) AS kept_sha256
FROM l LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": TOPK_SQL, "op5_lines": LINES_SQL}
