"""The operators as named queries over the given tables, each with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urndraw.llm import alignment, bpe, covertree, langid, linededup, ngrams, packing, passages, pii, secrets, simhash, topk, variants
from urndraw.llm.common import read

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return wrap


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id").withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("sha256"), "score", "kept")


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(read(spark, sf_dir, "documents"), vocabulary(WORD_BPE))
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))
    return packing.assign(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def _listed(spans: str):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


# A line is filled if anything but blanks is in it; a match is two neighbouring filled lines, or one of 20 words, that stood earlier.
@query("op8_linededup", r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line, trim(parts[i], ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS bare
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS u(i)),
filled AS (SELECT *, lead(bare) OVER w AS next_bare, lead(i) OVER w AS next_i FROM lines WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
matches AS (
  SELECT doc_id, i, next_i FROM (SELECT *, min(row(doc_id, i)) OVER (PARTITION BY bare, next_bare) AS earliest FROM filled WHERE next_bare IS NOT NULL)
  WHERE row(doc_id, i) > earliest
  UNION ALL SELECT doc_id, i, i FROM (SELECT *, min(row(doc_id, i)) OVER (PARTITION BY bare) AS earliest FROM filled
    WHERE len(regexp_extract_all(bare, '[^ \t\r\f\v]+')) >= 20)
  WHERE row(doc_id, i) > earliest),
gone AS (SELECT DISTINCT l.doc_id, l.i FROM lines l JOIN matches m ON m.doc_id = l.doc_id AND l.i BETWEEN m.i AND m.next_i)
SELECT d.doc_id, CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') END AS text,
  count(*) FILTER (WHERE l.bare <> '') AS n_lines, count(*) FILTER (WHERE l.bare <> '' AND g.i IS NOT NULL) AS n_removed
FROM documents d JOIN lines l ON l.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
GROUP BY d.doc_id
""")
def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op9_passages")
def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.dedup_passages(read(spark, sf_dir, "documents"), among=passages.AMONG)
    listed = {c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))) for c in ("removed", "kept")}
    return found.withColumn("n_removed", F.size("removed").cast("long")).withColumns(listed)


# In the check SQL a vector takes part if it has components and all are finite; components are read as double.
_USABLE = """embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@query("op4_covertree", f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT r.vec_id, (SELECT count(*) FROM links l WHERE l.a = r.vec_id) AS n_links, min(r.other) AS component_id, min(r.other) = r.vec_id AS kept
FROM reached r GROUP BY r.vec_id
""")
def op4_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op10_topk", f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
""")
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_variants")
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"))


@query("op12_ngrams")
def op12_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    found = ngrams.score(read(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECE_BPE))
