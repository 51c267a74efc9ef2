"""The operators applied to the test tables, one query each, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (
    alignment,
    bpe,
    chat,
    embeddings,
    language,
    licenses,
    minhash,
    packing,
    phrases,
    quality,
    rules,
    suffixes,
    token_files,
)
from clientele.llm.common import small_batches
from clientele.session import tune

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[plan.__name__] = plan
    return plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings, whatever their labels."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op1_embeddings"] = """
WITH RECURSIVE valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS p, b.vec_id AS q FROM valid a JOIN valid b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS p, vec_id AS q FROM embeddings
  UNION
  SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p
), least AS (SELECT p, min(q) AS component_id FROM reach GROUP BY p),
counted AS (SELECT p, count(*) AS n FROM links GROUP BY p)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.p = e.vec_id LEFT JOIN counted c ON c.p = e.vec_id
"""


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents by their sets of word pairs."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


SQL["op2_minhash"] = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) > 1
    THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM split
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS both_have, any_value(a.n) + any_value(b.n) AS total
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT p, q FROM common WHERE 100 * both_have >= 80 * (total - both_have)
), either AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reach AS (
  SELECT doc_id AS p, doc_id AS q FROM documents
  UNION
  SELECT reach.p, either.q FROM reach JOIN either ON reach.q = either.p
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT p, min(q) AS component_id FROM reach GROUP BY p) r ON r.p = s.doc_id
"""


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again from the ids."""
    docs = table(spark, sf_dir, "documents")
    small_batches(spark)
    encoded = docs.select("doc_id", bpe.encode(F.col("text"), BYTE_BPE).alias("ids"))
    decoded = encoded.withColumn("decoded", bpe.decode(F.col("ids"), BYTE_BPE))
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents in strings of 400 bytes that occur twice or more."""
    return suffixes.digests(table(spark, sf_dir, "documents"), length=400)


# A document is fit for training where its label says good quality and nothing toxic.
def fit_for_training() -> Column:
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, with sources as hosts and their languages as paths."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), fit_for_training())
    return judged.select("doc_id", "evidence", "host_rate", "path_rate", "score", "kept")


@query
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts and the verdict against their language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.judge(docs).select("doc_id", *rules.COUNTS, "base_failed", "kept", "distance")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back: where each starts, its length and checksum."""
    folder = token_files.dataset_folder(tune(spark))
    docs = table(spark, sf_dir, "documents")
    written = token_files.write_tokens(docs, folder, WORD_BPE, "words", end_id=2, vocabulary=49_408)
    read = token_files.read_tokens(written, folder, vocabulary=49_408)
    return read.select("doc_id", "start", "n_tokens", token_files.checksum("ids").alias("ids_crc32"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, BYTE_BPE, "spaced", size=2048, end_id=0)


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; a fifth of the ids is kept from learning."""
    docs = table(spark, sf_dir, "documents")
    away = language.held_out(F.col("doc_id"))
    model = language.fit(docs, ~away)
    found = language.identify(docs.select("doc_id", away.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language in all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, best=2000)


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizers' tokens, cut where both end."""
    return alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


@query
def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, as examples of one reply each."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    marks = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.format_and_read(turns.unionByName(marks))


SQL["op12_chat"] = r"""
WITH turns AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone, turn, role, text FROM conversations
  UNION ALL SELECT -1, NULL, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, NULL, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
  SELECT conv_id, lone, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id, lone) AS turns
  FROM turns WINDOW w AS (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), controls AS (
  SELECT *, len(regexp_extract_all(role || chr(10) || text, '<\\*(?:\|(?:im_start|im_sep|im_end|endoftext)\|>|/?s>)'))
    + len(regexp_extract_all(role || chr(10) || text, '\[\\*/?INST\]')) AS escapes FROM numbered
), sized AS (
  SELECT *, sum(length(role) + length(text) + escapes + length('<|im_start|><|im_sep|><|im_end|>'))
    OVER (PARTITION BY conv_id, lone ORDER BY place) AS so_far FROM controls
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR place = turns) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id, lone
"""
