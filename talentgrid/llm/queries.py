"""The registered queries of this package and, where SQL can express them, their DuckDB twins.

Each query applies one operator to its whole table and derives the digest columns from the
operator's outputs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentgrid.llm import (
    align, byte_bpe, chat, chunks, convnet, langid, licenses, packing, periodic, quality, simhash, urls, warc,
)
from talentgrid.llm.frames import new_folder, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.coded(table(spark, sf_dir, "documents"), *rules).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_pieces(
        packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    )


def digest_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compared(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.verdicts(table(spark, sf_dir, "pages"), rules)


ORACLES["op5_url_filter"] = r"""
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
split AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
fits AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT split.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM split LEFT JOIN fits USING (page_id)
"""


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op1_license_scan"] = licenses.oracle_sql()


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM sized),
firsts AS (SELECT payload_digest, min(page_id) AS f FROM digests WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN f < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f < page_id THEN f END AS refers_to
FROM digests LEFT JOIN firsts USING (payload_digest)
"""


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat.transcripts(table(spark, sf_dir, "conversations"))
    return chat.rendered(chat.parse(lines, chat.train(lines)))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.scored(table(spark, sf_dir, "documents"), *files)


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return convnet.score(docs, convnet.train(docs, table(spark, sf_dir, "labels")))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find(periodic.planted(table(spark, sf_dir, "documents"))))
