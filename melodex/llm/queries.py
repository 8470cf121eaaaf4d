"""One query per training-data operator, over its whole table with production parameters, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from melodex.llm.alignment import alignment_figures
from melodex.llm.ann import nearest_neighbours
from melodex.llm.embed_dedup import embedding_groups
from melodex.llm.langid import fit_languages, identify_languages
from melodex.llm.line_dedup import deduplicate_lines
from melodex.llm.mixing import mix_sources
from melodex.llm.pieces import encode_documents
from melodex.llm.quality import QualityModel, fit_quality, labelled_sample, score_quality
from melodex.llm.sharding import shard_documents
from melodex.llm.simhash import simhash_groups
from melodex.llm.spelling import count_words, group_variants
from melodex.llm.token_files import read_token_files, token_count, write_token_files
from melodex.llm.urls import Rule, judge_urls
from melodex.session import new_folder

# weight of documents that are labelled as of low quality
LOW_QUALITY_WEIGHT = 0.25
# a document scores at least this much to be kept
QUALITY_THRESHOLD = 0.3
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
# one (document, word) in so many is misspelt
DAMAGE = 97
# shingle length and bit distance of near copies
SIMHASH = {"words": 3, "radius": 2}
URL_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_weights(spark: SparkSession, folder: str) -> DataFrame:
    """(id, weight) of the labelled documents; a document with several labels has the best of them."""
    labels = table(spark, folder, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"))
    return labels.select("id", F.when(F.col("quality") == 0, LOW_QUALITY_WEIGHT).otherwise(1.0).alias("weight"))


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), quality_weights(spark, folder)).rows


def op2_embedding_groups(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups(table(spark, folder, "embeddings"), threshold=0.9)


def op3_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def fold(id_column: str, folds: int) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> QualityModel:
    """Learned from labelled documents outside the held-out fold."""
    return fit_quality(*labelled_sample(docs.filter(fold("doc_id", 5) != 0), table(spark, folder, "labels")))


def op4_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_quality(docs, quality_model(spark, docs, folder)).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = deduplicate_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold("doc_id", 4) == 2
    model = fit_languages(docs.filter(~held_out))
    found = identify_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def piece_model() -> bytes:
    with open(PIECE_MODEL, "rb") as file:
        return file.read()


def op7_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode_documents(table(spark, folder, "documents"), piece_model())
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"), **SIMHASH)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_judge_urls(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES).drop("threshold")


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest_neighbours(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


def tokenizer_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, tokenizer_file(WORD_TOKENIZER), END_ID)
    return read_token_files(spark, path).select(
        "doc_id", "start", token_count(F.col("ids")).alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_figures(table(spark, folder, "documents"), tokenizer_file(BYTE_TOKENIZER), piece_model())


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = count_words(table(spark, folder, "documents"), least_length=5, least_count=3, damage=DAMAGE)
    return group_variants(words, dominance=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_embedding_groups": op2_embedding_groups,
    "op3_shard_documents": op3_shard_documents,
    "op4_quality_scores": op4_quality_scores,
    "op5_line_dedup": op5_line_dedup,
    "op6_languages": op6_languages,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_judge_urls": op9_judge_urls,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op2_embedding_groups": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum([x * x FOR x IN embedding::DOUBLE[]])) AS size FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vectors UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
), smallest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM smallest
""",
    "op5_line_dedup": """
WITH lines AS (
  SELECT doc_id, text, pos, trim(line, E' \\t\\n\\x0b\\f\\r') AS stripped, line
  FROM (SELECT doc_id, text, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), E'\\n') AS parts FROM documents))
), keyed AS (
  SELECT *, translate(stripped, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (shared.key IS NOT NULL AND doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, E'\\n' ORDER BY pos) FILTER (shared.key IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
""",
    "op13_spelling_variants": """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)
    ORDER BY b) AS entries
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run
        FROM documents)
  GROUP BY doc_id, run
), hexed AS (
  SELECT *, hex(encode(concat(doc_id, ':', run))) AS bytes FROM runs
), hashed AS (
  SELECT run, times, xor(4294967295::BIGINT, list_reduce(
    [4294967295::BIGINT] || [('0x' || substr(bytes, i, 2))::BIGINT FOR i IN range(1, length(bytes), 2)],
    lambda c, b: xor(entries[xor(c, b) % 256 + 1], c >> 8))) AS h
  FROM hexed, crc_table
), counted AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0
          THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM counted)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN counted b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN counted b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, min(other) FILTER (other_n = highest) AS first
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS highest FROM near) GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN first END AS form,
    CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM counted LEFT JOIN best USING (word)
), followed(word, last_form) AS (
  SELECT word, word FROM formed
  UNION SELECT followed.word, formed.form FROM followed JOIN formed ON followed.last_form = formed.word WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, followed.last_form AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN followed USING (word) JOIN formed AS last ON last.word = followed.last_form AND last.form IS NULL
""",
}
