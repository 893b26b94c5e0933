"""The operators' registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinesia.llm import bpe, collocations, embed_dedup, exact_dedup, langid, mixing, ngram_join, pii, quality, suffix_dedup, vector_codes, warc, window_dedup
from kinesia.llm.sql import collocations_sql, quality_sql, vector_codes_sql
from kinesia.session import shared_dir

WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(spark, _documents(spark, sf_dir), words=4, percent=85)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digests(spark, _documents(spark, sf_dir), length=200)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    warc.make_folder(spark, folder)
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder).write.parquet(f"{folder}/_manifest")
    out = warc.read_archives(spark, folder)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(spark, _documents(spark, sf_dir))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_documents(spark, sf_dir), tokenizer_path())


def op8_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.window_digests(spark, _documents(spark, sf_dir), width=13)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_links(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, _documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vector_codes.vector_codes(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, _documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, _documents(spark, sf_dir)).drop("cut")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (
        op1_ngram_jaccard_join, op2_suffix_dedup, op3_exact_dedup, op4_warc, op5_pii,
        op6_mix_sources, op7_bpe, op8_window_dedup, op9_embedding_dedup, op10_language_id,
        op11_vector_codes, op12_quality_rules, op13_collocations,
    )
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


# ---------------------------------------------------------------- oracle SQL

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def ngram_join_sql(words: int = 4, percent: int = 85) -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
  ELSE list_distinct([array_to_string(ws[i:i + {words - 1}], ' ') FOR i IN range(1, len(ws) - {words - 2})]) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON s.doc_id = c.a"""


EXACT_DEDUP_SQL = r"""WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)"""


def window_dedup_sql(width: int = 13) -> str:
    return f"""WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - {width - 2})) AS place, ws FROM w WHERE len(ws) >= {width}),
wins AS (SELECT doc_id, place, array_to_string(ws[place:place + {width - 1}], ' ') AS win FROM starts),
firsts AS (SELECT win, min(doc_id) AS first_id FROM wins GROUP BY win),
marked AS (SELECT doc_id, place FROM wins JOIN firsts USING (win) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM w),
covered AS (SELECT words.doc_id, words.place, word, count(marked.place) OVER (
  PARTITION BY words.doc_id ORDER BY words.place ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS c
  FROM words LEFT JOIN marked ON words.doc_id = marked.doc_id AND words.place = marked.place),
kept AS (SELECT doc_id, count(*) FILTER (c > 0) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (c = 0) AS txt
  FROM covered GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(txt, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""


EMBEDDING_SQL = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len([c FOR c IN x IF c IS NULL OR NOT isfinite(c)]) = 0
  AND list_dot_product(x, x) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c ON v.vec_id = c.a LEFT JOIN n ON v.vec_id = n.a"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = {
        "op1_ngram_jaccard_join": ngram_join_sql(),
        "op3_exact_dedup": EXACT_DEDUP_SQL,
        "op8_window_dedup": window_dedup_sql(),
        "op9_embedding_dedup": EMBEDDING_SQL,
        "op11_vector_codes": vector_codes_sql(),
        "op12_quality_rules": quality_sql(),
        "op13_collocations": collocations_sql(),
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {k: v for k, v in out.items() if v is not None}
