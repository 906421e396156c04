"""The registered queries of this subpackage; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, curve_packing, embedding_dedup, exact_dedup, langid, line_dedup, merkle, mixing, ngram_join, packing, pii, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = toxicity.held_out("doc_id")
    sample, share = toxicity.sample(docs.filter(~held), table(spark, sf_dir, "labels").filter(~held))
    model = toxicity.fit(sample, share=share)
    return toxicity.score_documents(docs, model, columns=["doc_id"]).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs, held = table(spark, sf_dir, "documents"), langid.held_out("doc_id")
    model = langid.fit(langid.sample(docs.filter(~held)))
    found = langid.identify(docs.select("doc_id", "text"), model, columns=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as web archives and read back, a row per page."""
    files = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document, and the one that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op5_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and component of every document by five-word n-grams."""
    found = ngram_join.similar_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "component_id", "kept")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return pii.personal_data(docs, pii.fit(pii.sample(docs)))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bin and place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents")).drop("row")


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, how many stay, and a digest of what is left."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its text was tampered with."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), tampered={"text": found})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def _hashed(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


#: Each list element is one step of the remainder by bits: a byte, or 0 for its other seven bits.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295::BIGINT)"""


def _tree(name: str, nodes: str) -> str:
    """Levels of trees over nodes(tree, idx, h, n), and their runs."""
    return f"""{name}(tree, lvl, idx, h, n) AS (
      SELECT tree, 0, idx, h, n FROM {nodes}
      UNION ALL
      SELECT tree, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 3, n
    ), {name}_runs AS (SELECT tree, lvl, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM {name} WHERE n > 1 GROUP BY ALL)"""


def _path(name: str, runs: str, start: str) -> str:
    left, right = "array_to_string(r.hs[:p.idx % 3], '')", "array_to_string(r.hs[p.idx % 3 + 2:], '')"
    return f"""{name}(rid, tree, lvl, idx, sib, x) AS (
      SELECT rid, tree, 0, idx, sib, x FROM {start}
      UNION ALL
      SELECT p.rid, p.tree, p.lvl + 1, p.idx // 3, p.sib || {left} || {right}, sha256({left} || p.x || {right})
      FROM {name} p JOIN {runs} r ON p.tree = r.tree AND p.lvl = r.lvl AND p.idx // 3 = r.run
    )"""


ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_hashed("doc_id", "source", "lang", "n_chars", "text")} AS h,
         {_hashed("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")} AS without, {_CRC} % 2 = 0 AS chosen FROM documents
), leaves AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, h) AS rid, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM hashed
), {_tree("low", "leaves")}, tops AS (
  SELECT 0 AS tree, tree AS idx, h, count(*) OVER () AS n FROM low WHERE n = 1
), {_tree("high", "tops")}, first AS (
  SELECT rid, tree, idx, '' AS sib, CASE WHEN chosen THEN without ELSE h END AS x FROM leaves
), {_path("climb", "low_runs", "first")}, second AS (
  SELECT rid, 0 AS tree, tree AS idx, arg_max(sib, lvl) AS sib, arg_max(x, lvl) AS x FROM climb GROUP BY rid, tree
), {_path("ascent", "high_runs", "second")}, proofs AS (
  SELECT rid, arg_max(sib, lvl) AS sib, arg_max(x, lvl) AS x FROM ascent GROUP BY rid
)
SELECT l.doc_id, l.h AS leaf, t.h AS subroot, w.h AS root, sha256(p.sib) AS proof_sha256, p.x AS folded_root, p.x = w.h AS verified
FROM leaves l JOIN tops t ON l.tree = t.idx JOIN proofs p ON l.rid = p.rid, (SELECT h FROM high WHERE n = 1) w
"""


@query
def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences along a Hilbert curve."""
    pieces = curve_packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM lists, (SELECT unnest([1, 2, 3]) AS m)
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL
), size AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), cand AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 10
), cut AS (
  SELECT *, unnest(range(1, m)) AS k FROM cand
), sides AS (
  SELECT *, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail FROM cut
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM sides c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM cand WHERE m = 3) GROUP BY ALL
), alone AS (
  SELECT w.* FROM weakest w LEFT JOIN inside i ON w.lang = i.lang AND w.phrase = i.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * w.a
)
SELECT a.lang, row_number() OVER (PARTITION BY a.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM alone a JOIN size s ON a.lang = s.lang
QUALIFY rank <= 2000
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from end to end."""
    from corpus_pipeline import run

    return run(spark, sf_dir)
