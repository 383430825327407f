"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from derrick.llm import (ann, collocations, decontaminate, language, line_dedup, manifest, minhash, packing, quality,
                         secret_scan, simhash, suffix_dedup, token_files)
from derrick.llm.common import read


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                       read(spark, sf_dir, "benchmark")).select(
        "doc_id", "_hit.n_words", "_hit.n_hit", "_hit.n_items", "_hit.items_sha256", "_hit.contaminated")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"), 10)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents")).drop("ids")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs, read(spark, sf_dir, "labels"), *quality.site(docs)).select(
        "doc_id", "_quality.evidence", "_quality.posterior", "_quality.rejected")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read(spark, sf_dir, "documents"), manifest.lower_cased(5))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_simhash": op2_simhash,
        "op3_token_files": op3_token_files,
        "op4_line_dedup": op4_line_dedup,
        "op5_language": op5_language,
        "op6_decontaminate": op6_decontaminate,
        "op7_ann": op7_ann,
        "op8_secret_scan": op8_secret_scan,
        "op9_packing": op9_packing,
        "op10_quality": op10_quality,
        "op11_minhash": op11_minhash,
        "op12_manifest": op12_manifest,
        "op13_collocations": op13_collocations,
        "pipeline": corpus_pipeline.run,
    }


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
ahead AS (
  SELECT doc_id, pos, list(word) OVER (PARTITION BY doc_id ORDER BY pos
                                       ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM words),
grams AS (
  SELECT doc_id, pos, k, array_to_string(l[1:k], ' ') AS g
  FROM ahead, (SELECT DISTINCT k FROM iw) WHERE len(l) >= k),
h AS (SELECT doc_id, pos, grams.k, item_id FROM grams JOIN iw ON grams.k = iw.k AND grams.g = iw.g),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM h) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, x.v FROM r JOIN both_ways x ON x.u = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _op12(levels: int = 6) -> str:
    """Levels unrolled: right for up to 16 ** levels rows of a source, and sources."""
    def field(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"

    def leaf(text):
        return f"sha256({' || '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH steps AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps),
l AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lower)} AS lowered,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, crc),
s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM l GROUP BY source),
x0 AS (
  SELECT doc_id, src, n, leaf, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS folded, '' AS proof,
         row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
a0 AS (SELECT src, pos AS idx, n, leaf AS h FROM x0)"""

    def climb(nodes, docs, src, pos):
        out = ""
        for k in range(levels):
            out += f""",
{nodes}r{k} AS (SELECT src, idx // 16 AS run, n, list(h ORDER BY idx) AS hs FROM {nodes}{k} WHERE n > 1 GROUP BY src, idx // 16, n),
{nodes}{k + 1} AS (SELECT src, run AS idx, (n + 15) // 16 AS n, sha256(array_to_string(hs, '')) AS h FROM {nodes}r{k}),
{docs}{k + 1} AS (
  SELECT * EXCLUDE (folded, proof, hs, ofs),
         CASE WHEN hs IS NULL THEN folded
              ELSE sha256(array_to_string(hs[1:ofs], '') || folded || array_to_string(hs[ofs + 2:], '')) END AS folded,
         proof || coalesce(array_to_string(hs[1:ofs], '') || array_to_string(hs[ofs + 2:], ''), '') AS proof
  FROM (SELECT x.*, r.hs, (x.{pos} // {16 ** k}) % 16 AS ofs FROM {docs}{k} x
        LEFT JOIN {nodes}r{k} r ON r.src = {src} AND r.run = x.{pos} // {16 ** (k + 1)}))"""
        return out
    sql += climb("a", "x", "x.src", "pos")
    sql += ", subroots AS (" + " UNION ALL ".join(f"SELECT src, h FROM a{k} WHERE n = 1" for k in range(levels + 1)) + ")"
    sql += f""",
t0 AS (SELECT 0 AS src, src AS idx, count(*) OVER () AS n, h FROM subroots),
y0 AS (SELECT x{levels}.*, h AS subroot FROM x{levels} JOIN subroots USING (src))"""
    sql += climb("t", "y", "0", "src")
    sql += ", roots AS (" + " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(levels + 1)) + ")"
    return sql + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM y{levels}, roots
"""


_OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
c1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM g GROUP BY lang, w[i]),
c2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM g WHERE i < len(w) GROUP BY lang, w[i], w[i + 1]),
c3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM g WHERE i + 1 < len(w)
       GROUP BY lang, w[i], w[i + 1], w[i + 2]),
n AS (SELECT lang, sum(f) AS n FROM c1 GROUP BY lang),
most AS (
  SELECT lang, w1, w2, max(f) AS most
  FROM (SELECT lang, w1, w2, f FROM c3 WHERE f >= 10 UNION ALL SELECT lang, w2, w3, f FROM c3 WHERE f >= 10)
  GROUP BY lang, w1, w2),
cand AS (
  SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, c2.f AS a, x.f AS l1, y.f AS r1, NULL AS l2, NULL AS r2
  FROM c2 LEFT JOIN most USING (lang, w1, w2)
  JOIN c1 x ON x.lang = c2.lang AND x.p = c2.w1 JOIN c1 y ON y.lang = c2.lang AND y.p = c2.w2
  WHERE c2.f >= 10 AND (most IS NULL OR 100 * most < 50 * c2.f)
  UNION ALL
  SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, x.f, b.f, a.f, y.f
  FROM c3 JOIN c1 x ON x.lang = c3.lang AND x.p = c3.w1 JOIN c1 y ON y.lang = c3.lang AND y.p = c3.w3
  JOIN c2 a ON a.lang = c3.lang AND a.w1 = c3.w1 AND a.w2 = c3.w2
  JOIN c2 b ON b.lang = c3.lang AND b.w1 = c3.w2 AND b.w2 = c3.w3
  WHERE c3.f >= 10),
scored AS (
  SELECT *, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l1 AS HUGEINT) * r1) AS BIGINT) AS s1,
         CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l2 AS HUGEINT) * r2) AS BIGINT) AS s2 FROM cand),
cut AS (SELECT lang, phrase, a, coalesce(s1 <= s2, true) AS early, l1, r1, l2, r2, s1, s2 FROM scored),
ranked AS (
  SELECT lang, phrase, a, CASE WHEN early THEN l1 ELSE l2 END AS l, CASE WHEN early THEN r1 ELSE r2 END AS r,
         CASE WHEN early THEN s1 ELSE s2 END AS score FROM cut)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """The other queries use models, tokenizers, hashes or searches that SQL lacks,
    or (suffix dedup) would be too slow on whole tables; they are tested by brute
    force in tests/llm."""
    return {"op6_decontaminate": _OP6, "op11_minhash": _OP11, "op12_manifest": _op12(),
            "op13_collocations": _OP13}
