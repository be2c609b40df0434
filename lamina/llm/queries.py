"""Queries p1, p2, p4, p6, p7 and p8, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import encode as enc
from lamina.functions.text import real_sql
from lamina.functions.uids import object_of, object_sql
from lamina.llm import leaks as lk
from lamina.llm import sample as smp
from lamina.llm import split as spl
from lamina.llm import survivor as srv
from lamina.llm import truncation as trn
from lamina.session import table


#: Parameters of the sample: share of the objects, and the shift of the circle.
RATE, SHIFT = 0.1, 761_404_133


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    pop = table(spark, d, "population").select(F.explode("objects").alias("uid"), "arrived_at")
    sources = [(pop, F.col("uid"), "arrived_at"), (table(spark, d, "prepared"), F.col("uid"), "arrived_at")]
    return smp.sample(smp.registry_of(spark, d), sources, RATE, SHIFT)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return srv.caption_survivors(table(spark, d, "captions")).select("uid", "caption_id", "family_id")


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    return srv.caption_survivors(table(spark, d, "captions"))


def _p4(spark: SparkSession, d: str) -> DataFrame:
    return trn.verdicts(table(spark, d, "captions"), "caption_id", "caption", "shard", object_of(F.col("uid")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _p4(spark, d).filter("cut").select("caption_id").distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return trn.report(_p4(spark, d), "shard")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return enc.encode(table(spark, d, "documents"))


def p6_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    back = enc.decode(enc.encode(docs)).withColumnRenamed("text", "decoded")
    return docs.select("doc_id", "text").join(back, "doc_id").select("doc_id", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return lk.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spl.split(table(spark, d, "documents"), only_cut=True, content=False).filter("piece = 0").select("doc_id")


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    return spl.split(table(spark, d, "documents"))


P1_SQL = f"""WITH objs AS (
  SELECT {object_sql('uid')} AS uid, arrived_at FROM (SELECT unnest(objects) AS uid, arrived_at FROM population)
  UNION ALL SELECT {object_sql('uid')}, arrived_at FROM prepared),
seqs AS (SELECT uid, row_number() OVER (ORDER BY min(arrived_at) NULLS LAST, uid) - 1 AS seq FROM objs WHERE uid IS NOT NULL GROUP BY uid)
SELECT uid, seq FROM seqs WHERE (seq % {smp.CIRCLE} * {smp.GOLDEN} + {SHIFT}) % {smp.CIRCLE} < {int(RATE * smp.CIRCLE)}"""

_P2 = f"""WITH r AS (
  SELECT {object_sql('uid')} AS uid, caption_id, caption, family, written_at, {real_sql('caption')} AS rc, {real_sql('family')} AS rf,
         CASE WHEN shard = 'captions.jsonl' AND {real_sql('family')} THEN 2 WHEN regexp_matches(shard, '^captions_w[0-9]+[.]jsonl$') THEN 1 ELSE 0 END AS p
  FROM captions),
many AS (SELECT uid FROM r WHERE uid IS NOT NULL GROUP BY uid HAVING count(DISTINCT caption_id) > 1),
c AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY p DESC, written_at DESC NULLS LAST, caption_id DESC) AS n FROM r WHERE rc),
f AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY written_at DESC NULLS LAST, caption_id DESC) AS n FROM r WHERE rf)
SELECT m.uid, coalesce(c.caption_id, 0) AS caption_id, coalesce(f.caption_id, 0) AS family_id/*more*/
FROM many m LEFT JOIN c ON c.uid = m.uid AND c.n = 1 LEFT JOIN f ON f.uid = m.uid AND f.n = 1"""
P2_SQL = _P2
P2_RECORDS_SQL = _P2.replace("/*more*/", ", c.caption, f.family")

QUERIES = {
    "p1_sample": p1_sample,
    "p2_found": p2_found,
    "p2_records": p2_records,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p6_ids": p6_ids,
    "p6_roundtrip": p6_roundtrip,
    "p7_found": p7_found,
    "p8_found": p8_found,
    "p8_pieces": p8_pieces,
}
SQL = {"p1_sample": P1_SQL, "p2_found": P2_SQL, "p2_records": P2_RECORDS_SQL, "p6_roundtrip": "SELECT doc_id, true AS same FROM documents"}
