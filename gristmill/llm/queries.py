"""Queries of the corpus operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import bpe, conversations, decontam, embed_dedup, html_text, licenses, line_dedup, minhash, packing, quality, sharding, warc, whitening
from gristmill.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licences(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(rows, conversations.damage(rows))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_lattice_dedup": op2_lattice_dedup,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_warc": op6_warc,
    "op7_sharding": op7_sharding,
    "op8_html": op8_html,
    "op9_line_dedup": op9_line_dedup,
    "op10_minhash": op10_minhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}

def _components_sql(ids: str, links: str) -> str:
    """Smallest id that each of ``ids`` (id) reaches by ``links`` (a, b, in both directions)."""
    return f"""reach AS (SELECT id, id AS root FROM {ids} UNION SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.id),
component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""


_OP2 = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
ids AS (SELECT vec_id AS id FROM embeddings), {_components_sql("ids", "links")}
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN component ON id = e.vec_id"""

_OP10 = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS shingle FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
near AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM near JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * both_ >= 85 * (p.n + q.n - both_)),
ids AS (SELECT doc_id AS id FROM documents), {_components_sql("ids", "links")}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN component ON id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

_OP9 = """WITH l AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id, no) AS ord FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents)),
w AS MATERIALIZED (SELECT ord, list_filter(string_split(translate(lower(line), chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda x: x <> '') AS w FROM l),
x AS MATERIALIZED (SELECT ord, w, len(w) AS n, min(ord) OVER (PARTITION BY w) AS first FROM w WHERE len(w) >= 1),
u AS MATERIALIZED (SELECT ord, w, n FROM x WHERE ord = first AND n >= 5),
v AS MATERIALIZED (SELECT ord, 0 AS kind, md5('d' || array_to_string(w, ' ')) AS key FROM u
  UNION ALL SELECT ord, 1, md5('d' || array_to_string(w[1:i-1] || w[i+1:n], ' ')) FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM u)
  UNION ALL SELECT ord, 2, md5('s' || i || ' ' || array_to_string(w[1:i-1] || w[i+1:n], ' ')) FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM u)),
f AS (SELECT key, min(ord) FILTER (kind = 0) AS f0, min(ord) FILTER (kind = 1) AS f1, min(ord) FILTER (kind = 2) AS f2 FROM v GROUP BY key HAVING count(*) > 1),
gone AS (SELECT ord FROM x WHERE ord > first UNION SELECT ord FROM v JOIN f USING (key) WHERE ord > CASE kind WHEN 0 THEN f1 WHEN 1 THEN f0 ELSE f2 END)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (gone.ord IS NULL), '') AS text, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(gone.ord) AS INTEGER) AS n_dropped FROM l LEFT JOIN gone USING (ord) GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL"""

#: The others can't be expressed in SQL (byte-pair merges, classifiers, checksums and codecs, tree scoring); tests hold
#: them against brute force.
ORACLE_SQL: dict[str, str] = {"op2_lattice_dedup": _OP2, "op9_line_dedup": _OP9, "op10_minhash": _OP10}
