"""Registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir
from . import ann, collocations, html_text, huffman_ids, merkle, mixing, packing, sharding, simhash, token_counts, topk, toxicity, warc

#: Where the public vocabularies lie; a parameter of every operator that tokenises.
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    records = warc.read_warc(spark, path, payloads="digest").where(F.col("record_type").isin("response", "revisit"))
    return records.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.exact_topk(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # tampering: 1 added to n_chars where 7 divides the CRC-32 of the decimal id
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    tampered = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    rows = merkle.manifest(_table(spark, sf_dir, "documents"),
                           extra={"tampered": F.when(hit & F.col("n_chars").isNotNull(), tampered)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "huffman-ids")
    huffman_ids.write_ids(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return huffman_ids.read_ids(spark, path, ids="digest").select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_topk": op3_topk,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_ann": op8_ann,
    "op9_html": op9_html,
    "op10_toxicity": op10_toxicity,
    "op11_merkle": op11_merkle,
    "op12_collocations": op12_collocations,
    "op13_token_files": op13_token_files,
}

_OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, chr(0)) || '|' || coalesce(text, chr(0))), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1) % 3 AS weight
  FROM docs GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER () AS words,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM sources),
level AS (
  SELECT coalesce((SELECT (words - fixed)::DOUBLE / rest::DOUBLE FROM ordered
                   WHERE ((words - fixed)::DOUBLE / rest::DOUBLE) * weight < 3 * source_size
                   ORDER BY 3.0 * source_size / weight, source NULLS LAST LIMIT 1), 0) AS level),
targets AS (
  SELECT source, source_size, CASE WHEN weight * level >= 3 * source_size THEN (3 * source_size)::DOUBLE
         ELSE weight * level END AS target FROM sources, level),
placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         least(floor(t.target + 0.5)::BIGINT, 3 * t.source_size) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken
FROM placed
"""

_OP3_SQL = """
WITH e AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
           FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

# CRC-32 by single bits (its reversed polynomial, 3988292384): a digit's code, marked by 1000, goes in before its eight steps.
_CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
    flatten([[1000 + ord(c), 0, 0, 0, 0, 0, 0, 0]::UBIGINT[] for c in string_split(doc_id::VARCHAR, '')])),
    lambda a, b: CASE WHEN (CASE WHEN b > 0 THEN xor(a, b - 1000) ELSE a END) & 1 = 1
      THEN xor((CASE WHEN b > 0 THEN xor(a, b - 1000) ELSE a END) >> 1, 3988292384::UBIGINT)
      ELSE (CASE WHEN b > 0 THEN xor(a, b - 1000) ELSE a END) >> 1 END), 4294967295::UBIGINT)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes of the trees over ``leaves`` (g, i, d), each with the number of its level."""
    return f"""{name}_up AS (
  SELECT 0 AS level, g, i, d FROM {leaves}
  UNION ALL
  SELECT level + 1, g, i // 2, sha256(d || next) FROM (
    SELECT *, coalesce(lead(d) OVER (PARTITION BY g ORDER BY i), '') AS next, count(*) OVER (PARTITION BY g) AS n
    FROM {name}_up) WHERE i % 2 = 0 AND n > 1),
{name} AS (SELECT *, count(*) OVER (PARTITION BY g, level) AS n FROM {name}_up)"""


def _climb_sql(name: str, tree: str, start: str) -> str:
    """Rows of ``start`` (rid, g, i, fold, proof) carried up the trees: at each level the sibling joins proof and fold."""
    return f"""{name} AS (
  SELECT 0 AS level, rid, g, i, fold, proof FROM {start}
  UNION ALL
  SELECT c.level + 1, c.rid, c.g, c.i // 2,
         sha256(CASE WHEN c.i % 2 = 0 THEN c.fold || coalesce(s.d, '') ELSE s.d || c.fold END), c.proof || coalesce(s.d, '')
  FROM {name} c JOIN {tree} m ON m.g = c.g AND m.level = c.level AND m.i = c.i AND m.n > 1
  LEFT JOIN {tree} s ON s.g = c.g AND s.level = c.level AND s.i = xor(c.i, 1))"""


_OP11_SQL = f"""
WITH RECURSIVE digests AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || lang, '') AS g, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_CRC32_SQL} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS tampered
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i, leaf AS d,
         coalesce(tampered, leaf) AS fold, '' AS proof FROM digests),
{_tree_sql('tree', 'leaves')},
subs AS MATERIALIZED (SELECT g AS sub, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d FROM tree WHERE n = 1 AND level = (
  SELECT max(level) FROM tree t WHERE t.g = tree.g)),
{_climb_sql('climb', 'tree', 'leaves')},
{_tree_sql('top', 'subs')},
second AS (SELECT c.rid, '' AS g, s.i, c.fold, c.proof FROM climb c JOIN tree m ON m.g = c.g AND m.level = c.level AND m.n = 1
  JOIN subs s ON s.sub = c.g),
{_climb_sql('climb2', 'top', 'second')},
done AS (SELECT c.rid, c.fold, c.proof, m.d AS root FROM climb2 c JOIN top m ON m.level = c.level AND m.n = 1)
SELECT l.doc_id, l.leaf, s.d AS subroot, d.root, sha256(d.proof) AS proof_sha256, d.fold AS folded_root, d.fold = d.root AS verified
FROM leaves l JOIN subs s ON s.sub = l.g JOIN done d ON d.rid = l.rid
"""

_OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) t(k))),
freq AS MATERIALIZED (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f, cut, string_split(c.phrase, ' ') AS w
  FROM freq c, (VALUES (1), (2)) t(cut) WHERE c.k > 1 AND cut < c.k),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.f, cut, a.f AS l, b.f AS r, (1000000::HUGEINT * c.f * c.f) // (a.f * b.f) AS score
  FROM cuts c JOIN freq a ON a.lang = c.lang AND a.phrase = array_to_string(w[1:cut], ' ')
  JOIN freq b ON b.lang = c.lang AND b.phrase = array_to_string(w[cut + 1:c.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f
  FROM (SELECT lang, string_split(phrase, ' ') AS w, f FROM freq WHERE k = 3)),
covered AS (SELECT lang, phrase, max(f) AS longer FROM inside GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.f DESC, b.phrase) AS rank, b.phrase,
       b.f::BIGINT AS a, b.l::BIGINT AS l, b.r::BIGINT AS r, t.n, b.score::BIGINT AS score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase
WHERE c.longer IS NULL OR 100 * c.longer < 50 * b.f
QUALIFY rank <= 2000
"""

ORACLE = {"op2_mixing": _OP2_SQL, "op3_topk": _OP3_SQL, "op11_merkle": _OP11_SQL, "op12_collocations": _OP12_SQL}
