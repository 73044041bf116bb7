"""Queries of the core library and their DuckDB equivalents.

Every entry reads whole tables. ``@query(sql)`` registers a function under its name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import html, images, license, text, vectors
from ..operators import dedup, filters, lookups, reports, scoring, selection, splits
from ..runtime import shared_dir, stored
from ..schema import seeded_order, stable_key, url_key
from ..sources import api, files, sinks
from . import pipelines

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --- licenses and text --------------------------------------------------------------------

_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_CODES = ["by", "by-sa", "BY_SA", "cc0", "CC0 1.0", "PDM", "cc by-nc 4.0", "CC  BY 4.0", "all rights reserved", "", "http://creativecommons.org/licenses/by/4.0/", "https://creativecommons.org/publicdomain/zero/1.0/", "Attribution"]


def _any(column: str, values: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{v}')" for v in values) + ")"


@query(
    f"""
WITH lines AS (
  SELECT doc_id, nullif(regexp_extract(text, '[^\\n]*[Ll]icen[^\\n]*'), '') AS license FROM documents
  UNION ALL SELECT -unnest(range(1, {len(_CODES) + 1})), unnest({sql_list(_CODES)})
), n AS (
  SELECT doc_id, trim(regexp_replace(replace(lower(coalesce(license, '')), '_', ' '), '{_SPACE}', ' ', 'g')) AS license FROM lines
)
SELECT doc_id, license,
  license <> '' AND {_any("license", license.CORE_FRAGMENTS)} AS core,
  license <> '' AND (license IN {in_list(license.STRICT_CODES)} OR {_any("license", license.STRICT_FRAGMENTS)}) AS strict,
  license <> '' AND (license IN {in_list(license.OPEN_SET_CODES)} OR {_any("license", license.OPEN_SET_FRAGMENTS)}) AS open_set
FROM n"""
)
def license_gate(spark, sf_dir):
    # the first line that names a license; a pattern for the whole line would be tried at every place
    line = F.get(F.filter(F.split("text", "\n"), lambda x: x.rlike("[Ll]icen")), F.lit(0))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("text").rlike("[Ll]icen"), line).alias("license"))
    codes = spark.createDataFrame([(-i - 1, c) for i, c in enumerate(_CODES)], "doc_id long, license string")
    value = F.col("license")
    return docs.union(codes).select("doc_id", license.normalize_license(value).alias("license"), *[license.license_is_allowed(value, r).alias(r) for r in ("core", "strict", "open_set")])


@query(
    f"""
SELECT page_id, md5(trim(regexp_replace(replace(regexp_replace(html, '<[^>]*(?:>|\\z)|>', '', 'g'), '&nbsp;', ' '), '{_SPACE}', ' ', 'g'))) AS text_md5 FROM pages"""
)
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_html(F.col("html"))).alias("text_md5"))


@query(
    """
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s+href="(/[^"]*)"', 1)) AS href FROM pages)
SELECT DISTINCT page_id, trim(replace(url_decode(split_part(substr(href, 2), '#', 1)), '_', ' ')) AS name FROM h"""
)
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(html.file_links(F.col("html"), "/", images_only=False)).alias("name"))


_GALLERY = """html || '<img src="//upload.wikimedia.org/wikipedia/commons/thumb/a/ab/P_' || page_id || '.jpg/120px-P_' || page_id || '.jpg"'
 || CASE WHEN page_id % 3 = 0 THEN ' srcset="//upload.wikimedia.org/wikipedia/commons/thumb/a/ab/P_' || page_id || '.jpg/180px-P_' || page_id || '.jpg 1.5x, //upload.wikimedia.org/wikipedia/commons/thumb/a/ab/P_' || page_id || '.jpg/240px-P_' || page_id || '.jpg 2x"' ELSE '' END
 || '><img src="/static/logo.png"><a title="Next page (x)" href="/wiki/Category:X?pagefrom=' || page_id || '">n</a>'"""
_WIDTH = "CASE WHEN page_id % 3 = 0 THEN '240' ELSE '120' END"
_THUMB = "'https://upload.wikimedia.org/wikipedia/commons/thumb/a/ab/P_' || page_id || '.jpg/'"


@query(
    f"""
SELECT page_id, {_THUMB} || {_WIDTH} || 'px-P_' || page_id || '.jpg' AS published, {_THUMB} || '1024px-P_' || page_id || '.jpg' AS enlarged,
  'https://upload.wikimedia.org/wikipedia/commons/a/ab/P_' || page_id || '.jpg' AS original, 1 AS n_images,
  'https://commons.wikimedia.org/wiki/Category:X?pagefrom=' || page_id AS next_page
FROM pages"""
)
def html_images(spark, sf_dir):
    body = F.expr(_GALLERY.replace("\n", " "))
    found = table(spark, sf_dir, "pages").select("page_id", body.alias("h"))
    one = [F.get(html.images(F.col("h"), r), F.lit(0)).alias(r) for r in ("published", "enlarged", "original")]
    return found.select("page_id", *one, F.size(html.images(F.col("h"))).alias("n_images"), F.get(html.next_pages(F.col("h")), F.lit(0)).alias("next_page"))


@query(
    """
WITH n AS (SELECT DISTINCT p_name || ' (é&' || p_brand || ').jpg' AS name FROM part), q AS (SELECT name, url_encode(replace(name, ' ', '_')) AS e FROM n)
SELECT name, 'https://commons.wikimedia.org/wiki/Category:' || replace(replace(replace(e, '%3A', ':'), '%28', '('), '%29', ')') AS category_url,
  'https://commons.wikimedia.org/wiki/File:' || replace(replace(replace(e, '%3A', ':'), '%28', '('), '%29', ')') AS file_url,
  'https://commons.wikimedia.org/wiki/Special:Redirect/file/' || e || '?width=1200' AS image_url FROM q"""
)
def url_builders(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit(" (é&"), "p_brand", F.lit(").jpg")).alias("name")).distinct()
    name = F.col("name")
    return names.select("name", html.category_url(name).alias("category_url"), html.file_page_url(name).alias("file_url"), html.file_image_url(name).alias("image_url"))


def _words(value: str, extra: str = "") -> str:
    out = f"replace(replace(lower({value}), '-', ' '), '_', ' ')"
    for c in extra:
        out = f"replace({out}, '{c}', ' ')"
    return f"string_split(trim(regexp_replace({out}, '\\s+', ' ', 'g')), ' ')"


_TITLE = "p_name || CASE p_partkey % 6 WHEN 0 THEN ' Flower-bed' WHEN 1 THEN ' leaf_blossom fruit' WHEN 2 THEN ' green leaves' WHEN 3 THEN ' sliced Carrots' WHEN 4 THEN ' floral/seed,bloom' ELSE '' END"
_SOURCE = "CASE p_partkey % 5 WHEN 0 THEN 'openverse' WHEN 1 THEN 'wikimedia_commons' WHEN 2 THEN 'inaturalist' WHEN 3 THEN 'gbif' ELSE 'other' END"


def _has(terms: list[str], words: str = "w") -> str:
    return f"list_has_any({words}, {sql_list(terms)})"


@query(
    f"""
WITH t AS (SELECT p_partkey, {_SOURCE} AS source, {_words(f"{_TITLE} || ' ' || p_type")} AS w, {_words(f"{_TITLE} || ' ' || p_type", "/,")} AS w2 FROM part)
SELECT p_partkey, source, round(CASE source WHEN 'openverse' THEN 0.045e0 WHEN 'wikimedia_commons' THEN 0.025e0 WHEN 'gbif' THEN -0.005e0 ELSE 0e0 END
  + CASE WHEN {_has(text.FLOWER_TERMS)} THEN -0.16e0 ELSE 0e0 END + CASE WHEN {_has(text.LEAF_TERMS)} AND NOT {_has(text.OBJECT_TERMS)} THEN -0.08e0 ELSE 0e0 END
  + CASE WHEN {_has(text.OBJECT_TERMS)} THEN 0.018e0 ELSE 0e0 END, 6) AS adjustment, {_has(text.FLOWER_WORDS, "w2")} AS flower
FROM t"""
)
def metadata_adjust(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SOURCE).alias("source"), F.expr(_TITLE).alias("title"), F.col("p_type").alias("query"))
    args = (F.col("title"), F.col("query"))
    return rows.select("p_partkey", "source", F.round(text.metadata_adjustment(*args, F.col("source")), 6).alias("adjustment"), text.mentions_flower(*args).alias("flower"))


@query(
    """
WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents), n AS (SELECT doc_id, ch, count(*)::DOUBLE AS n FROM c WHERE ch <> '' GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS s, sum(n * log2(n)) AS t FROM n GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(log2(s) - t / s, 0), 6) AS entropy FROM documents d LEFT JOIN t USING (doc_id)"""
)
def text_entropy(spark, sf_dir):
    return text.character_entropy(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", F.round("entropy", 6).alias("entropy"))


_MEASURED = "doc_id, n_chars * 4 AS n_bytes, CAST(100 + doc_id % 400 AS INT) AS width, CAST(90 + (doc_id * 7) % 900 AS INT) AS height, 2.5e0 + (doc_id % 20) / 10e0 AS entropy, CAST(10 + doc_id % 31 AS DOUBLE) AS variance"


def _gate_sql(g: filters.Gate) -> str:
    return f"""CASE WHEN n_bytes < {g.min_bytes} OR n_bytes > {g.max_bytes} THEN 'bytes' WHEN least(width, height) < {g.min_side} THEN 'side'
  WHEN greatest(width, height) > {g.max_aspect}e0 * least(width, height) THEN 'aspect' WHEN entropy < {g.min_entropy}e0 THEN 'entropy' WHEN variance < {g.min_variance} THEN 'variance' END"""


@query(f"WITH m AS (SELECT {_MEASURED} FROM documents) SELECT doc_id, {', '.join(f'{_gate_sql(g)} AS {n}' for n, g in filters.GATES.items())} FROM m")
def quality_gates(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(*_split_columns(_MEASURED))
    return rows.select("doc_id", *[filters.gate_reason(g).alias(n) for n, g in filters.GATES.items()])


def _split_columns(columns: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[start:i].strip())
            start = i + 1
    return [*out, columns[start:].strip()]


# --- dedup --------------------------------------------------------------------------------


@query(
    """
WITH u AS (SELECT page_id AS pos, url FROM pages UNION ALL SELECT page_id + 1000000, split_part(url, '?', 1) || '?v=' || page_id FROM pages WHERE page_id % 2 = 0)
SELECT pos, url FROM u QUALIFY row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY pos) = 1"""
)
def url_key_dedup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.col("url").alias("image_url"))
    again = pages.filter("pos % 2 = 0").select(F.col("pos") + 1000000, F.concat(url_key(F.col("image_url")), F.lit("?v="), F.col("pos").cast("string")))
    return dedup.unique_candidates(pages.union(again)).withColumnRenamed("image_url", "url")


@query(
    """
SELECT doc_id, sha256(text) AS digest, CASE WHEN min(doc_id) OVER w <> doc_id THEN min(doc_id) OVER w END AS duplicate_of FROM documents WINDOW w AS (PARTITION BY text)"""
)
def exact_sha_dedup(spark, sf_dir):
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", F.sha2("text", 256))


_UNIT = "(SELECT vec_id, label, list_transform(e, lambda x: x / greatest(sqrt(list_sum(list_transform(e, lambda y: y * y))), 1e-12)) AS u FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))"


def _greedy_sql(threshold: float) -> str:
    return f"""
WITH RECURSIVE unit AS MATERIALIZED (SELECT vec_id, CAST(u AS DOUBLE[64]) AS u FROM {_UNIT}),
pairs AS MATERIALIZED (SELECT a.vec_id AS lo, b.vec_id AS hi, array_inner_product(a.u, b.u) AS s FROM unit a JOIN unit b ON a.vec_id < b.vec_id WHERE array_inner_product(a.u, b.u) >= {threshold}),
before AS MATERIALIZED (SELECT row_number() OVER (ORDER BY u.vec_id) AS i, u.vec_id AS id, coalesce(list(p.lo) FILTER (p.lo IS NOT NULL), []) AS nb FROM unit u LEFT JOIN pairs p ON p.hi = u.vec_id GROUP BY u.vec_id),
scan AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept UNION ALL
  SELECT b.i, CASE WHEN list_has_any(s.kept, b.nb) THEN s.kept ELSE list_append(s.kept, b.id) END FROM scan s JOIN before b ON b.i = s.i + 1),
kept AS MATERIALIZED (SELECT unnest(kept) AS id FROM scan WHERE i = (SELECT max(i) FROM before)),
why AS (SELECT hi, max(s) AS similarity, arg_max(lo, struct_pack(s := s, e := -lo)) AS duplicate_of FROM pairs WHERE lo IN (SELECT id FROM kept) GROUP BY hi)"""


@query(
    _greedy_sql(0.35)
    + """
SELECT u.vec_id AS pos, k.id IS NOT NULL AS kept, CASE WHEN k.id IS NULL THEN duplicate_of END AS duplicate_of, round(CASE WHEN k.id IS NULL THEN similarity END, 6) AS similarity
FROM unit u LEFT JOIN kept k ON k.id = u.vec_id LEFT JOIN why w ON w.hi = u.vec_id"""
)
def embedding_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), "embedding")
    return dedup.embedding_deduplicate(rows, 0.35).withColumn("similarity", F.round("similarity", 6))


@query(_greedy_sql(0.40) + " SELECT count(*) AS n_kept, 0.4e0 AS threshold FROM kept")
def embedding_dedup_adaptive(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), "embedding")
    found, used = dedup.adaptive_deduplicate(rows, needed=rows.count() * 4 // 5, first=0.30, relaxed=0.40)
    return found.filter("kept").agg(F.count("*").alias("n_kept")).withColumn("threshold", F.lit(used))


def _noisy(tag: str, digits: str, step: int) -> str:
    """64 hex digits that depend on a group of five, with one digit changed by member."""
    at = f"(1 + (vec_id % 5) * {step})"
    whole = f"md5('{tag}' || g) || md5('{tag}x' || g)"
    return f"substr({whole}, 1, CAST({at} - 1 AS INT)) || substr('{digits}', CAST(1 + vec_id % 16 AS INT), 1) || substr({whole}, CAST({at} + 1 AS INT), 64)"


_HASHES = {"dhash": _noisy("d", "0123456789abcdef", 12), "phash": _noisy("p", "fedcba9876543210", 9), "whash": _noisy("w", "02468ace13579bdf", 7), "mirror_phash": "md5('m' || vec_id) || md5('n' || vec_id)"}
_HASHED = f"SELECT vec_id AS pos, CASE WHEN vec_id % 5 IN (1, 3) THEN md5('s' || g) ELSE md5('t' || vec_id) END AS sha256, {', '.join(f'{v} AS {k}' for k, v in _HASHES.items())} FROM (SELECT vec_id, CAST(floor(vec_id / 5) AS BIGINT) AS g FROM embeddings)"


def _bits(a: str, b: str) -> str:
    return "(" + " + ".join(f"CAST(bit_count(xor(CAST('0x' || substr({a}, {i}, 16) AS UBIGINT), CAST('0x' || substr({b}, {i}, 16) AS UBIGINT))) AS INTEGER)" for i in (1, 17, 33, 49)) + ")"


@query(
    f"""
WITH RECURSIVE h AS MATERIALIZED ({_HASHED}),
d AS MATERIALIZED (SELECT a.pos AS lo, b.pos AS hi, a.sha256 = b.sha256 AS same, least({_bits("a.phash", "b.phash")}, {_bits("a.mirror_phash", "b.phash")}, {_bits("a.phash", "b.mirror_phash")}) AS p,
  {_bits("a.dhash", "b.dhash")} AS d, {_bits("a.whash", "b.whash")} AS w FROM h a JOIN h b ON a.pos < b.pos),
near AS MATERIALIZED (SELECT lo, hi, same, CASE WHEN p <= 6 AND d <= 10 THEN 'perceptual_hash' WHEN p <= 9 AND d <= 8 AND w <= 10 THEN 'perceptual_hash_combined' END AS reason FROM d),
before AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h.pos) AS i, h.pos AS id, coalesce(list(n.lo) FILTER (n.same OR n.reason IS NOT NULL), []) AS nb FROM h LEFT JOIN near n ON n.hi = h.pos GROUP BY h.pos),
scan AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept UNION ALL
  SELECT b.i, CASE WHEN list_has_any(s.kept, b.nb) THEN s.kept ELSE list_append(s.kept, b.id) END FROM scan s JOIN before b ON b.i = s.i + 1),
kept AS MATERIALIZED (SELECT unnest(kept) AS id FROM scan WHERE i = (SELECT max(i) FROM before)),
why AS (SELECT hi, min(lo) FILTER (same) AS same_of, min(lo) FILTER (reason IS NOT NULL) AS near_of, arg_min(reason, lo) FILTER (reason IS NOT NULL) AS near_reason FROM near WHERE lo IN (SELECT id FROM kept) GROUP BY hi)
SELECT h.pos, k.id IS NOT NULL AS kept, CASE WHEN k.id IS NOT NULL THEN NULL WHEN same_of IS NOT NULL THEN 'exact_sha256' ELSE near_reason END AS reason,
  CASE WHEN k.id IS NULL THEN coalesce(same_of, near_of) END AS duplicate_of
FROM h LEFT JOIN kept k ON k.id = h.pos LEFT JOIN why w ON w.hi = h.pos"""
)
def perceptual_dedup(spark, sf_dir):
    table(spark, sf_dir, "embeddings").createOrReplaceTempView("embeddings")
    return dedup.hash_deduplicate(spark.sql(_HASHED))


# --- scores and pools ---------------------------------------------------------------------


def _prompts(spark, sf_dir, label: int, n: int = 4) -> list[list[float]]:
    rows = table(spark, sf_dir, "embeddings").filter(F.col("label") == label).orderBy("vec_id").limit(n)
    return scoring.prompt_list(rows.withColumn("ord", F.col("vec_id")))


def _prompts_sql(label: int, n: int = 4) -> str:
    return f"(SELECT list(u ORDER BY vec_id) FROM (SELECT * FROM unit WHERE label = {label} ORDER BY vec_id LIMIT {n}))"


_DOT = "list_inner_product({0}, {1})"


def _best(prompts: str) -> str:
    return f"list_max(list_transform({prompts}, lambda q: list_inner_product(u, q)))"


_SCORE_CTE = f"""
WITH unit AS MATERIALIZED (SELECT * FROM {_UNIT}), prompts AS MATERIALIZED (SELECT {_prompts_sql(1)} AS pos, {_prompts_sql(2)} AS neg, {_prompts_sql(3)} AS vis, {_prompts_sql(4)} AS inv),
middle AS MATERIALIZED (SELECT list_transform(m, lambda x: x / (sqrt(list_sum(list_transform(m, lambda y: y * y))) + 1e-12)) AS mid FROM
  (SELECT list_transform(range(1, 65), lambda i: list_avg(list_transform(pos, lambda p: p[i]))) AS m FROM prompts)),
s AS MATERIALIZED (SELECT vec_id, label, {_best("pos")} AS p, {_best("neg")} AS n, list_inner_product(u, mid) AS c, {_best("vis")} AS v, {_best("inv")} AS i FROM unit, prompts, middle)"""


def _scored(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("pos", F.col("vec_id"))
    return scoring.score_max(rows, _prompts(spark, sf_dir, 1), _prompts(spark, sf_dir, 2))


_R = "round({0}, 6) AS {1}"


@query(f"{_SCORE_CTE} SELECT vec_id, round(c, 6) AS mean_positive, round(c - n, 6) AS mean_margin, round(p, 6) AS max_positive, round(p - n, 6) AS max_margin, round(greatest(p, v), 6) AS visible_positive, round(greatest(p, v) - greatest(n, i) + 0.85e0 * (v - i), 6) AS visible_margin FROM s")
def prompt_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    p, n, v, i = (_prompts(spark, sf_dir, k) for k in (1, 2, 3, 4))

    def renamed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnsRenamed({"clip_positive": f"{name}_positive", "clip_margin": f"{name}_margin"}).drop("clip_negative")

    out = renamed(scoring.score_mean(rows, p, n), "mean")
    out = renamed(scoring.score_max(out, p, n), "max")
    out = renamed(scoring.score_visible(out, p, n, v, i), "visible").drop("embedding")
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "vec_id"])


@query(
    """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey % 256 AS h, l_suppkey % 256 AS s, CAST(l_quantity * 5 AS INT) AS v FROM lineitem), f AS (
SELECT l_orderkey, avg(CAST(s >= 55 AND v >= 45 AND h BETWEEN 35 AND 115 AS DOUBLE)) AS g, avg(CAST(s >= 55 AND v >= 45 AND (h <= 18 OR h >= 220) AS DOUBLE)) AS r, avg(CAST(s < 45 AS DOUBLE)) AS n FROM x GROUP BY l_orderkey)
SELECT l_orderkey, round(g, 6) AS green_fraction, round(r, 6) AS red_fraction, round(n, 6) AS neutral_fraction, round(0.1e0 + 0.12e0 * least(g, 0.45e0) - 1.2e0 * greatest(0e0, r - 0.018e0), 6) AS margin FROM f"""
)
def color_fractions(spark, sf_dir):
    pixels = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 256).alias("h"), (F.col("l_suppkey") % 256).alias("s"), (F.col("l_quantity") * 5).cast("int").alias("v"))
    out = images.color_fractions(pixels, "l_orderkey", F.col("h"), F.col("s"), F.col("v"))
    out = out.withColumn("margin", scoring.color_margin(F.lit(0.1), F.col("green_fraction"), F.col("red_fraction")))
    return out.select("l_orderkey", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(
    """
WITH e AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings), q AS (SELECT label, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM e GROUP BY label)
SELECT vec_id, round(CASE WHEN hi > lo THEN greatest(0e0, least(1e0, (x - lo) / (hi - lo))) ELSE 1 END, 6) AS scaled FROM e JOIN q USING (label)"""
)
def percentile_scaled(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"))
    return scoring.percentile_scaled(rows, "x", "scaled", ["label"]).select("vec_id", F.round("scaled", 6).alias("scaled"))


def _relaxed_sql(thresholds: list[float], floor: float, target: str, fallback: str) -> str:
    listed = "[" + ", ".join(f"{t}e0" for t in thresholds) + "]"
    return f"""{_SCORE_CTE}, m AS MATERIALIZED (SELECT vec_id, p AS pos, p - n AS margin FROM s), t AS (SELECT unnest({listed}) AS t, generate_subscripts({listed}, 1) AS i),
used AS (SELECT arg_min(t, i) AS t FROM t WHERE (SELECT count(*) FROM m WHERE margin >= t.t AND pos >= {floor}) >= {target}),
fall AS ({fallback})
SELECT vec_id, round(margin, 6) AS margin, round((SELECT t FROM used), 6) AS threshold FROM m WHERE (SELECT t FROM used) IS NOT NULL AND margin >= (SELECT t FROM used) AND pos >= {floor}
UNION ALL SELECT vec_id, round(margin, 6), round(threshold, 6) FROM fall WHERE (SELECT t FROM used) IS NULL"""


def _pool_columns(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.round("clip_margin", 6).alias("margin"), F.round("threshold", 6).alias("threshold"))


@query(_relaxed_sql(filters.CORE_THRESHOLDS, 0.18, "90", "SELECT *, min(margin) OVER () AS threshold FROM (SELECT * FROM m ORDER BY margin DESC, pos DESC, vec_id LIMIT 90)"))
def threshold_relax_core(spark, sf_dir):
    return _pool_columns(filters.core_pool(_scored(spark, sf_dir), 10))


@query(_relaxed_sql(filters.STRICT_THRESHOLDS, 0.20, "150", "SELECT *, 0e0 AS threshold FROM m WHERE margin >= 0 AND pos >= 0.2"))
def threshold_relax_strict(spark, sf_dir):
    return _pool_columns(filters.strict_pool(_scored(spark, sf_dir), 10))


@query(
    f"""{_SCORE_CTE}, a AS (SELECT vec_id, p, p - n + CASE WHEN vec_id % 4 = 0 THEN -0.16e0 WHEN vec_id % 4 = 1 THEN 0.018e0 ELSE 0e0 END + CASE WHEN vec_id % 3 = 0 THEN 0.045e0 ELSE 0e0 END AS m FROM s)
SELECT vec_id, round(m, 6) AS margin FROM a WHERE p >= 0.18 AND m >= -0.08 ORDER BY m DESC, p DESC, vec_id LIMIT 240"""
)
def adjusted_pool(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumns({"title": F.expr("CASE vec_id % 4 WHEN 0 THEN 'a flower' WHEN 1 THEN 'cut fruit' ELSE 'thing' END"), "query": F.lit(""), "source": F.expr("CASE WHEN vec_id % 3 = 0 THEN 'openverse' ELSE 'x' END")})
    return filters.adjusted_pool(rows, 10).select("vec_id", F.round("clip_margin", 6).alias("margin"))


@query(
    f"""{_SCORE_CTE}, m AS (SELECT vec_id, p AS pos, p - n AS margin FROM s), fit AS (SELECT * FROM m WHERE pos >= 0.19 AND margin >= -0.025)
SELECT vec_id FROM fit WHERE (SELECT count(*) FROM fit) >= 120
UNION ALL SELECT vec_id FROM (SELECT * FROM m ORDER BY margin DESC, pos DESC, vec_id LIMIT 180) WHERE (SELECT count(*) FROM fit) < 120"""
)
def open_pool(spark, sf_dir):
    return filters.open_pool(_scored(spark, sf_dir), 10).select("vec_id")


_COLORED = {"raw_margin": "clip_margin + 0.02e0", "red_fraction": "CASE WHEN vec_id % 7 = 0 THEN NULL ELSE (vec_id % 13) / 100e0 END", "green_fraction": "CASE WHEN vec_id % 11 = 0 THEN NULL ELSE (vec_id % 17) / 100e0 END", "title": "CASE WHEN vec_id % 10 = 0 THEN 'floral,thing' ELSE 'thing' END", "query": "''"}


def _reasons_sql() -> str:
    green = "WHEN coalesce(red_fraction, 1e0) > 0.055 THEN 'red_or_pink' WHEN coalesce(green_fraction, 0e0) < 0.025 THEN 'insufficient_green' WHEN clip_positive < 0.205 THEN 'low_positive'"
    cases = {
        "green": f"{green} WHEN raw_margin < 0.008 OR clip_margin < 0.012 THEN 'low_margin'",
        "green_raw": f"{green} WHEN raw_margin < -0.055 THEN 'low_margin'",
        "source": "WHEN coalesce(red_fraction, 0e0) > 0.10 THEN 'red_or_pink' WHEN clip_positive < 0.185 THEN 'low_positive' WHEN raw_margin < -0.035 THEN 'low_margin'",
    }
    columns = ", ".join(f"{v} AS {k}" for k, v in _COLORED.items())
    parts = [f"SELECT '{k}' AS policy, coalesce(CASE WHEN title LIKE 'floral%' THEN 'metadata_flower' {v} END, 'fits') AS reason, count(*) AS n FROM c GROUP BY ALL" for k, v in cases.items()]
    return f"{_SCORE_CTE}, m AS (SELECT vec_id, p AS clip_positive, p - n AS clip_margin FROM s), c AS (SELECT *, {columns} FROM m) " + " UNION ALL ".join(parts)


@query(_reasons_sql())
def reason_filters(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumns({k: F.expr(v) for k, v in _COLORED.items()})
    marked = rows.select(F.explode(F.create_map(*[x for p in filters.POLICY_POOL for x in (F.lit(p), filters.first_reason(filters.reason_tests(p)))])).alias("policy", "reason"))
    return marked.groupBy("policy", F.coalesce("reason", F.lit("fits")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    f"""{_SCORE_CTE}, m AS (SELECT vec_id, p AS clip_positive, p - n AS clip_margin FROM s), c AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in _COLORED.items())} FROM m)
SELECT vec_id, round(raw_margin, 6) AS raw_margin FROM c WHERE title NOT LIKE 'floral%' AND coalesce(red_fraction, 0e0) <= 0.10 AND clip_positive >= 0.185 AND raw_margin >= -0.035
ORDER BY c.raw_margin DESC, clip_positive DESC, coalesce(red_fraction, 0e0), vec_id LIMIT 220"""
)
def policy_pool(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumns({k: F.expr(v) for k, v in _COLORED.items()})
    return filters.policy_pool(rows, 1, "source")[0].select("vec_id", F.round("raw_margin", 6).alias("raw_margin"))


# --- selection ----------------------------------------------------------------------------


@query(
    f"""
WITH RECURSIVE unit AS MATERIALIZED (SELECT vec_id, label, CAST(u AS DOUBLE[64]) AS u, u[1] AS m, u[2] AS p FROM {_UNIT}),
ends AS (SELECT label, quantile_cont(m, 0.05) AS ml, quantile_cont(m, 0.95) AS mh, quantile_cont(p, 0.05) AS pl, quantile_cont(p, 0.95) AS ph FROM unit GROUP BY label),
q AS MATERIALIZED (SELECT vec_id, label, u, 0.7e0 * CASE WHEN mh > ml THEN greatest(0e0, least(1e0, (m - ml) / (mh - ml))) ELSE 1 END + 0.3e0 * CASE WHEN ph > pl THEN greatest(0e0, least(1e0, (p - pl) / (ph - pl))) ELSE 1 END AS q FROM unit JOIN ends USING (label)),
dist AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, 1 - array_inner_product(a.u, b.u) AS d FROM q a JOIN q b ON a.label = b.label AND a.vec_id <> b.vec_id),
pick AS (SELECT label, 1 AS n, [arg_min(vec_id, struct_pack(q := -q, i := vec_id))] AS chosen FROM q GROUP BY label
  UNION ALL SELECT label, n + 1, list_append(chosen, nxt) FROM (
    SELECT k.label, any_value(k.n) AS n, any_value(k.chosen) AS chosen, arg_min(c.vec_id, struct_pack(o := -(0.62e0 * c.q + 0.38e0 * greatest(0e0, least(1e0, c.d / 0.35e0))), i := c.vec_id)) AS nxt
    FROM pick k JOIN (SELECT k2.label, q.vec_id, any_value(q.q) AS q, min(dist.d) AS d FROM pick k2 JOIN q ON q.label = k2.label AND NOT list_contains(k2.chosen, q.vec_id) JOIN dist ON dist.a = q.vec_id AND list_contains(k2.chosen, dist.b) WHERE k2.n < 10 GROUP BY k2.label, q.vec_id) c ON c.label = k.label
    WHERE k.n < 10 GROUP BY k.label))
SELECT label, unnest(chosen) AS pos, CAST(generate_subscripts(chosen, 1) AS INTEGER) AS place FROM pick WHERE n = 10"""
)
def diverse_select(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("u", vectors.normalized(vectors.doubles(F.col("embedding"))))
    rows = rows.select(F.col("vec_id").alias("pos"), "label", "embedding", F.get("u", F.lit(0)).alias("clip_margin"), F.get("u", F.lit(1)).alias("clip_positive"))
    return selection.diverse_select(selection.quality(rows, ["label"]), 10, "label", strict=False)


@query(f"WITH unit AS MATERIALIZED (SELECT vec_id, CAST(u AS DOUBLE[64]) AS u FROM {_UNIT}) SELECT a.vec_id AS lo, b.vec_id AS hi, round(array_inner_product(a.u, b.u), 6) AS similarity FROM unit a JOIN unit b ON a.vec_id < b.vec_id ORDER BY array_inner_product(a.u, b.u) DESC, lo DESC, hi DESC LIMIT 20")
def nearest_pairs(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), vectors.normalized(vectors.doubles(F.col("embedding"))).alias("v"))
    return selection.nearest_pairs(unit, 20, 0.2).withColumn("similarity", F.round("similarity", 6))


@query("SELECT doc_id, CAST(CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 ELSE 2 END AS INTEGER) AS turn, md5(CASE source WHEN 'src3' THEN '8' WHEN 'src1' THEN '9' ELSE '10' END || '|' || doc_id) AS key FROM documents")
def priority_merge(spark, sf_dir):
    return selection.priority_merge(table(spark, sf_dir, "documents"), ["src3", "src1"], 7, F.col("doc_id").cast("string")).select("doc_id", "turn", "key")


@query("SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents QUALIFY rank <= 25")
def top_per_group(spark, sf_dir):
    return selection.top_per_group(table(spark, sf_dir, "documents"), ["lang"], [F.desc("n_chars"), F.asc("doc_id")], 25).select("doc_id", "lang", "rank")


@query("SELECT doc_id, source FROM documents ORDER BY CASE WHEN source = 'src2' THEN 0 ELSE 1 END, lpad(CAST(doc_id AS VARCHAR), 9, '0') LIMIT 120")
def prefer_source(spark, sf_dir):
    return selection.prefer_source(table(spark, sf_dir, "documents"), "src2", F.lpad(F.col("doc_id").cast("string"), 9, "0"), 120).select("doc_id", "source")


@query(
    """
WITH e AS MATERIALIZED (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n, event_type <> 'error' AS ok FROM events),
c AS MATERIALIZED (SELECT *, CAST((n - 1 - (n - 1) % 64) / 64 AS BIGINT) AS batch FROM e WHERE n <= 700),
s AS (SELECT batch, sum(CAST(ok AS INT)) AS n FROM c GROUP BY batch), b AS (SELECT batch, coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
SELECT event_id, batch FROM c JOIN b USING (batch) WHERE ok AND before < 260"""
)
def early_stop(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", (F.row_number().over(Window.orderBy("event_id")) - 1).alias("pos"))
    return selection.early_stop(rows, F.col("event_type") != "error", 260, 64, 700).select("event_id", "batch")


@query(
    """
WITH RECURSIVE e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY event_id) - 1 AS pos, event_type = 'error' AND value > 12 AS ok FROM events),
s AS (SELECT CAST(floor(pos / 100) AS BIGINT) AS batch, sum(CAST(ok AS INT)) AS n FROM e GROUP BY 1),
scan AS (SELECT CAST(-1 AS BIGINT) AS batch, 0::HUGEINT AS n, 0 AS streak, 0::HUGEINT AS total UNION ALL
  SELECT s.batch, s.n, CASE WHEN s.n < 12 AND s.batch * 100 >= 200 THEN scan.streak + 1 ELSE 0 END, scan.total + s.n FROM scan JOIN s ON s.batch = scan.batch + 1 WHERE scan.streak < 3 AND scan.total < 500)
SELECT batch, CAST(n AS BIGINT) AS n_valid FROM scan WHERE batch >= 0"""
)
def low_yield_stop(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "value", (F.row_number().over(Window.orderBy("event_id")) - 1).alias("pos"))
    return selection.low_yield_stop(rows, (F.col("event_type") == "error") & (F.col("value") > 12), poor=12)


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('101|' || doc_id), CAST(doc_id AS VARCHAR)) <= 4")
def class_sample(spark, sf_dir):
    return selection.stratified_sample(table(spark, sf_dir, "documents"), "source", 4, 101, F.col("doc_id").cast("string")).select("doc_id", "source")


# --- splits -------------------------------------------------------------------------------


def _split_sql(train: str, val: str, seed: int) -> str:
    return f"""WITH o AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('{seed}|' || doc_id), CAST(doc_id AS VARCHAR)) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, CASE WHEN i < round_even(n * {train}, 0) THEN 'train' WHEN i < round_even(n * {train}, 0) + round_even(n * {val}, 0) THEN 'val' ELSE 'test' END AS split FROM o"""


@query(_split_sql("0.7e0", "0.15e0", 11))
def assign_splits_3way(spark, sf_dir):
    return splits.assign_splits(table(spark, sf_dir, "documents"), "lang", 11, F.col("doc_id").cast("string")).select("doc_id", "lang", "split")


@query(_split_sql("0.7e0", "0e0", 12))
def assign_splits_2way(spark, sf_dir):
    return splits.assign_splits(table(spark, sf_dir, "documents"), "lang", 12, F.col("doc_id").cast("string"), val=0.0).select("doc_id", "lang", "split")


@query(
    """WITH o AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('5|' || doc_id), CAST(doc_id AS VARCHAR)) AS i FROM documents)
SELECT doc_id, lang, CASE WHEN i <= 40 THEN 'train' WHEN i <= 50 THEN 'val' ELSE 'test' END AS split FROM o WHERE i <= 80"""
)
def quota_split(spark, sf_dir):
    return selection.quota_split(table(spark, sf_dir, "documents"), "lang", {"train": 40, "val": 10, "test": 30}, 5, F.col("doc_id").cast("string")).select("doc_id", "lang", "split")


@query(
    """
WITH t AS (SELECT doc_id, lang AS label FROM documents WHERE lang IN ('en', 'fr') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('5|' || doc_id), CAST(doc_id AS VARCHAR)) <= 30),
o AS (SELECT doc_id, 'other' AS label FROM documents WHERE lang NOT IN ('en', 'fr') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('6|' || doc_id), CAST(doc_id AS VARCHAR)) <= 15),
u AS (SELECT *, row_number() OVER (ORDER BY md5('99996|' || doc_id), CAST(doc_id AS VARCHAR)) AS i FROM (SELECT * FROM t UNION ALL SELECT * FROM o))
SELECT doc_id, label, 'image_' || CASE WHEN i < 10000 THEN lpad(CAST(i AS VARCHAR), 4, '0') ELSE CAST(i AS VARCHAR) END || '.jpg' AS name FROM u"""
)
def hidden_test(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    identity = F.col("doc_id").cast("string")
    target = selection.stratified_sample(docs.filter(F.col("lang").isin("en", "fr")), "lang", 30, 5, identity).select("doc_id", F.col("lang").alias("label"))
    other = selection.stratified_sample(docs.filter(~F.col("lang").isin("en", "fr")), "lang", 15, 6, identity).select("doc_id")
    return splits.hidden_test(target, other, 5 + 99991, identity).select("doc_id", "label", "name")


@query(
    f"""
WITH unit AS MATERIALIZED (SELECT * FROM {_UNIT}), c AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM unit WHERE label < 4) GROUP BY ALL),
k AS MATERIALIZED (SELECT label, list(x ORDER BY i) AS m FROM c GROUP BY label), e AS (SELECT vec_id, k.label, exp(12e0 * list_inner_product(u, m)) AS w FROM unit, k),
p AS (SELECT vec_id, list(w ORDER BY label) AS w, sum(w) AS s FROM e GROUP BY vec_id)
SELECT vec_id, CASE WHEN list_max(w) / s < 0.4 THEN 'other' ELSE 'c' || (list_position(w, list_max(w)) - 1) END AS label, round(list_max(w) / s, 6) AS top FROM p"""
)
def open_set_reject(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").select("vec_id", "label", vectors.normalized(vectors.doubles(F.col("embedding"))).alias("u"))
    means = unit.filter("label < 4").select("label", F.posexplode("u").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    rows = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("m")).orderBy("label").collect()
    weights = F.array(*[F.exp(12 * vectors.dot(F.col("u"), scoring.literal([x["x"] for x in r["m"]]))) for r in rows])
    total = F.aggregate("w", F.lit(0.0), lambda s, x: s + x)
    shares = unit.withColumn("w", weights).withColumn("p", F.transform("w", lambda x: x / total))
    classes = F.array(*[F.lit(f"c{r['label']}") for r in rows])
    return shares.select("vec_id", vectors.open_set_label(F.col("p"), classes, 0.4).alias("label"), F.round(F.array_max("p"), 6).alias("top"))


# --- lookups, reports, sinks --------------------------------------------------------------


def _edges(spark, sf_dir) -> DataFrame:
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    first = nation.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("src"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("dst"))
    second = customer.select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("src"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("dst"))
    back = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("src"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("dst"))
    return first.union(second).union(back)


@query(
    """
WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
w AS (SELECT 'r1' AS node, 0 AS depth UNION SELECT e.dst, depth + 1 FROM w JOIN e ON e.src = w.node WHERE depth < 2)
SELECT node, min(depth) AS depth FROM w GROUP BY node"""
)
def category_walk(spark, sf_dir):
    return lookups.walk(_edges(spark, sf_dir), spark.createDataFrame([("r1",)], "node string"), 2)


@query(
    """
WITH c AS (SELECT page_id AS ord, 'P' || CAST(floor(page_id / 2) AS BIGINT) || '.JPG' AS file, 'author ' || page_id AS author FROM pages),
k AS (SELECT lower(file) AS key, ord, author FROM c UNION ALL SELECT regexp_replace(lower(file), '\\.[^.]*$', ''), ord, author FROM c),
i AS (SELECT key, arg_min(author, ord) AS author FROM k GROUP BY key), f AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/x/p' || page_id || '.jpg' ELSE '/x/p' || page_id || '.webp' END AS path FROM pages)
SELECT page_id, coalesce(a.author, b.author, '') AS author FROM f LEFT JOIN i a ON a.key = lower(regexp_extract(path, '[^/]*$')) LEFT JOIN i b ON b.key = regexp_replace(lower(regexp_extract(path, '[^/]*$')), '\\.[^.]*$', '')"""
)
def credit_lookup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    credits = pages.select(F.col("page_id").alias("ord"), F.expr("'P' || CAST(floor(page_id / 2) AS BIGINT) || '.JPG'").alias("File name"), F.expr("'author ' || page_id").alias("Author"))
    files = pages.select("page_id", F.expr("CASE WHEN page_id % 2 = 0 THEN '/x/p' || page_id || '.jpg' ELSE '/x/p' || page_id || '.webp' END").alias("path"))
    found = lookups.credit_lookup(files, lookups.index_credits(credits), F.col("path"))
    return found.select("page_id", text.first_matching(F.coalesce("fields", F.create_map(F.lit(""), F.lit(""))), ["author", "creator"]).alias("author"))


@query(
    """
SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, coalesce(lang, '') AS lang, coalesce(CAST(quality AS VARCHAR), '') AS quality, coalesce(source, '') AS source
FROM (SELECT doc_id, lang, source FROM documents UNION ALL BY NAME SELECT doc_id, quality FROM labels)"""
)
def ragged_union(spark, sf_dir):
    return sinks.ragged_union([table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality")])


@query(
    """
SELECT lang, 'all' AS stage, 0 AS ord, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT lang, 'long', 1, count(*) FROM documents WHERE n_chars >= 500 GROUP BY lang
UNION ALL SELECT lang, 'distinct', 2, count(DISTINCT text) FROM documents WHERE n_chars >= 500 GROUP BY lang"""
)
def funnel_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    long = docs.filter("n_chars >= 500")
    return reports.funnel([("all", docs), ("long", long), ("distinct", long.select("lang", "text").distinct())], "lang")


@query("SELECT source, count(*) AS n, CAST(min(n_chars) AS DOUBLE) AS low, median(n_chars) AS middle, CAST(max(n_chars) AS DOUBLE) AS high FROM documents GROUP BY source")
def source_distribution(spark, sf_dir):
    return reports.margin_report(table(spark, sf_dir, "documents").withColumn("n_chars", F.col("n_chars").cast("double")), "source", "n_chars")


@query("SELECT 'doc_id' AS what, count(*) AS n, count(DISTINCT doc_id) AS n_distinct FROM documents UNION ALL SELECT 'text', count(*), count(DISTINCT text) FROM documents")
def distinct_report(spark, sf_dir):
    return reports.distinct_report(table(spark, sf_dir, "documents"), ["doc_id", "text"])


@query(
    """
WITH p AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings), a AS (SELECT label, i, avg(x) AS x FROM p GROUP BY ALL)
SELECT label, CAST(i AS INTEGER) AS i, round(x / (sqrt(sum(x * x) OVER (PARTITION BY label)) + 1e-12), 6) AS x FROM a"""
)
def mean_vector(spark, sf_dir):
    return reports.mean_vector(table(spark, sf_dir, "embeddings"), "label").withColumn("x", F.round("x", 6))


_FINISHED = "SELECT d.doc_id, lang AS class_name, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'test' ELSE 'val' END AS split, md5(text) AS sha256, CAST(150 + doc_id % 200 AS INT) AS width, CAST(160 + doc_id % 90 AS INT) AS height FROM documents d"


@query(
    f"""
WITH f AS ({_FINISHED})
SELECT 'class_count' AS rule, class_name AS subject, count(*) AS found FROM f GROUP BY class_name HAVING count(*) <> 100
UNION ALL SELECT 'split_count', class_name || '/' || split, count(*) FROM f GROUP BY class_name, split HAVING count(*) <> CASE split WHEN 'train' THEN 70 WHEN 'test' THEN 30 ELSE 0 END
UNION ALL SELECT 'small_side', class_name, count(*) FROM f WHERE least(width, height) < 180 GROUP BY class_name
UNION ALL SELECT 'digest_twice', sha256, count(*) FROM f GROUP BY sha256 HAVING count(*) > 1"""
)
def validate_dataset(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    return reports.violations(spark.sql(_FINISHED), "class_name", 100, {"train": 70, "test": 30})


@query("SELECT url FROM pages WHERE contains(lower(url), 'en/') OR contains(lower(url), 'utm')")
def leak_scan(spark, sf_dir):
    return reports.leaks(table(spark, sf_dir, "pages").select("url"), "url", ["en/", "utm"])


@query("SELECT unnest(['http://', 'https://', 'ftp://']) AS prefix, unnest([count_if(starts_with(url, 'http://')), count_if(starts_with(url, 'https://')), count_if(starts_with(url, 'ftp://'))])::BIGINT AS n FROM pages")
def member_counts(spark, sf_dir):
    return reports.member_counts(table(spark, sf_dir, "pages"), "url", ["http://", "https://", "ftp://"])


@query(
    f"""
WITH f AS ({_FINISHED}), n AS (SELECT *, (doc_id % 1000) / 1000e0 AS margin, row_number() OVER (PARTITION BY class_name ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END, (doc_id % 1000) / 1000e0 DESC, CAST(doc_id AS VARCHAR)) AS i FROM f)
SELECT split || '/' || class_name || '/' || class_name || '_' || CASE WHEN i < 1000 THEN lpad(CAST(i AS VARCHAR), 3, '0') ELSE CAST(i AS VARCHAR) END || '.jpg' AS relative_path, class_name AS class, split, CAST(doc_id AS VARCHAR) AS source_id, CAST(width AS VARCHAR) AS width,
  CAST(height AS VARCHAR) AS height, sha256, printf('%.8f', margin) AS clip_margin, '' AS license, '0.00000000' AS clip_positive FROM n"""
)
def manifest(spark, sf_dir):
    from ..schema import conform

    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    rows = spark.sql(_FINISHED).withColumns({"source_id": F.col("doc_id").cast("string"), "clip_margin": (F.col("doc_id") % 1000) / F.lit(1000.0)})
    named = splits.named_outputs(rows, "class_name", F.col("clip_margin"), F.col("doc_id").cast("string"))
    return sinks.manifest(conform(named)).select("relative_path", "class", "split", "source_id", "width", "height", "sha256", "clip_margin", "license", "clip_positive")


@query(
    """
WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, source FROM documents)
SELECT doc_id, CAST(floor(i / 10) AS BIGINT) AS row, CAST(i % 10 AS INTEGER) AS col, lpad(CAST(i + 1 AS VARCHAR), CAST(greatest(3, length(CAST(i + 1 AS VARCHAR))) AS INTEGER), '0') || ' ' || substr(source, 1, 9) || ' m=+0.125' AS label FROM g"""
)
def contact_grid(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(0.125).alias("clip_margin"))
    return sinks.contact_grid(rows, [F.col("doc_id")]).select("doc_id", "row", "col", "label")


@query(
    """
SELECT 'both' AS what, word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part INTERSECT SELECT unnest(string_split(lower(p_type), ' ')) FROM part)
UNION ALL SELECT 'only_names', word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part EXCEPT SELECT unnest(string_split(lower(p_type), ' ')) FROM part)
UNION ALL SELECT 'any', word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT unnest(string_split(lower(p_type), ' ')) FROM part)"""
)
def set_operations(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.explode(F.split("p_name", " ")).alias("word"))
    kinds = part.select(F.explode(F.split(F.lower("p_type"), " ")).alias("word"))
    parts = {"both": names.intersect(kinds), "only_names": names.exceptAll(kinds).distinct().join(kinds, "word", "left_anti"), "any": names.union(kinds).distinct()}
    out = [df.select(F.lit(k).alias("what"), "word") for k, df in parts.items()]
    return out[0].union(out[1]).union(out[2])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, to_json(struct_pack(event_type := event_type, k := CAST(json_extract(props, '$.k') AS BIGINT)))::VARCHAR AS report FROM events")
def json_report(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k long")["k"].alias("k"))
    return rows.select("event_id", "k", F.to_json(F.struct("event_type", "k")).alias("report"))


@query(f"SELECT vec_id, {_bits('d', 'e')}::INTEGER AS bits FROM (SELECT vec_id, md5(CAST(vec_id AS VARCHAR)) || md5('x' || vec_id) AS d, md5('y' || vec_id) || md5('z' || vec_id) AS e FROM embeddings)")
def hamming(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "md5(CAST(vec_id AS STRING)) || md5('x' || vec_id) AS d", "md5('y' || vec_id) || md5('z' || vec_id) AS e")
    return rows.select("vec_id", vectors.hamming_hex(F.col("d"), F.col("e")).cast("int").alias("bits"))


# --- sources ------------------------------------------------------------------------------

_TERMS = ["by", "CC0 1.0", "cc by-nc 4.0", "CC_BY 4.0", "all rights reserved", "", "by-sa", "pdm"]
#: Answers of 40 items a page, made from the parts.
_ITEMS = f"""SELECT p_partkey AS k, CAST(floor(p_partkey / 40) AS INT) AS page, p_name AS name, p_brand AS brand, {sql_list(_TERMS)}[1 + p_partkey % {len(_TERMS)}] AS terms FROM part"""
_NORMAL = f"trim(regexp_replace(replace(lower(terms), '_', ' '), '{_SPACE}', ' ', 'g'))"
_CORE_RULE = f"{_NORMAL} <> '' AND {_any(_NORMAL, license.CORE_FRAGMENTS)}"
_OPEN_RULE = f"{_NORMAL} <> '' AND ({_NORMAL} IN {in_list(license.OPEN_SET_CODES)} OR {_any(_NORMAL, license.OPEN_SET_FRAGMENTS)})"
_FOUND = ["class_name", "source", "image_url", "landing_url", "title", "creator", "license", "license_url", "source_id"]


def _items(spark, sf_dir) -> DataFrame:
    terms = F.element_at(F.array(*map(F.lit, _TERMS)), (1 + F.col("p_partkey") % len(_TERMS)).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / 40).cast("int").alias("page"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), terms.alias("terms"))


def _bodies(items: DataFrame, item: Column, **more: Column) -> DataFrame:
    """(page, body): answers with a list of results in the items' order."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("k", item.alias("r")))), lambda x: x["r"])
    return items.groupBy("page").agg(listed.alias("results")).select("page", F.to_json(F.struct("results", *[v.alias(k) for k, v in more.items()])).alias("body"))


def _searched(spark, sf_dir) -> DataFrame:
    k = F.col("k").cast("string")
    landing = F.when(F.col("k") % 5 != 0, F.concat(F.lit("https://x.org/p/"), k)).otherwise("")
    fields = {"id": k, "title": F.col("name"), "creator": F.when(F.col("k") % 7 != 0, F.col("brand")), "license": F.col("terms"), "license_url": F.lit("https://l.org"), "url": F.concat(F.lit("https://x.org/"), k, F.lit(".jpg")), "thumbnail": F.when(F.col("k") % 3 == 0, F.concat(F.lit("https://t.org/"), k)), "foreign_landing_url": landing}
    return _bodies(_items(spark, sf_dir), F.struct(*[v.alias(n) for n, v in fields.items()]))


_SEARCHED = f"""SELECT 'c' AS class_name, 'openverse' AS source, CASE WHEN k % 3 = 0 THEN 'https://t.org/' || k ELSE 'https://x.org/' || k || '.jpg' END AS image_url,
  CASE WHEN k % 5 <> 0 THEN 'https://x.org/p/' || k ELSE 'https://x.org/' || k || '.jpg' END AS landing_url, name AS title, CASE WHEN k % 7 <> 0 THEN brand ELSE '' END AS creator,
  terms AS license, 'https://l.org' AS license_url, CAST(k AS VARCHAR) AS source_id FROM ({_ITEMS})"""


@query(f"{_SEARCHED} WHERE {_CORE_RULE}")
def scan_images_core(spark, sf_dir):
    return api.image_results(_searched(spark, sf_dir), "c", "q").select(*_FOUND)


@query(f"{_SEARCHED} WHERE {_OPEN_RULE} AND k % 5 <> 0")
def scan_images_open_set(spark, sf_dir):
    return api.image_results(_searched(spark, sf_dir), "c", "q", "open_set", url_as_landing=False).select(*_FOUND)


_DETAILS = f"""SELECT 'c' AS class_name, 'wikimedia_commons' AS source, CASE WHEN k % 3 = 0 THEN 'https://t.org/' || k ELSE 'https://u.org/' || k END AS image_url,
  CASE WHEN k % 4 = 0 THEN '{api.SITE}/wiki/File:' || replace(name, ' ', '_') ELSE 'https://d.org/' || k END AS landing_url, CASE WHEN k % 7 = 0 THEN 'File:' || name ELSE brand END AS title,
  brand AS creator, {_NORMAL.replace("lower(terms)", "terms").replace("replace(terms, '_', ' ')", "terms")} AS license, '' AS license_url, CAST(k AS VARCHAR) AS source_id, k FROM ({_ITEMS}) WHERE k % 10 NOT IN (3, 7)"""


def _details(spark, sf_dir) -> DataFrame:
    items, k = _items(spark, sf_dir), F.col("k").cast("string")

    def value(v: Column) -> Column:
        return F.struct(v.alias("value"))

    kind = F.when(F.col("k") % 10 == 3, "image/svg+xml").when(F.col("k") % 10 == 7, "video/ogg").otherwise("image/jpeg")
    marked = F.concat(F.lit("<b>"), F.col("brand"), F.lit("</b>"))
    meta = F.struct(value(F.col("terms")).alias("LicenseShortName"), value(marked).alias("Artist"), F.when(F.col("k") % 7 != 0, value(F.col("brand"))).alias("ObjectName"))
    info = F.struct(kind.alias("mime"), F.concat(F.lit("https://u.org/"), k).alias("url"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("https://t.org/"), k)).alias("thumburl"), F.when(F.col("k") % 4 != 0, F.concat(F.lit("https://d.org/"), k)).alias("descriptionurl"), meta.alias("extmetadata"))
    page = F.struct(F.col("k").alias("pageid"), F.concat(F.lit("File:"), F.col("name")).alias("title"), F.array(info).alias("imageinfo"))
    pages = items.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct(k, page))).alias("pages"))
    return pages.select("page", F.to_json(F.struct(F.struct("pages").alias("query"))).alias("body"))


@query(f"SELECT * EXCLUDE (k) FROM ({_DETAILS}) WHERE {_CORE_RULE.replace('terms', 'license')}")
def scan_files(spark, sf_dir):
    return api.file_details(_details(spark, sf_dir), "c", "q").select(*_FOUND)


@query(f"SELECT * EXCLUDE (k) FROM ({_DETAILS}) WHERE {_OPEN_RULE.replace('terms', 'license')} AND k % 4 <> 0")
def scan_files_open_set(spark, sf_dir):
    return api.file_details(_details(spark, sf_dir), "c", "q", "open_set", require_landing=True).select(*_FOUND)


@query(
    f"""
WITH photos AS (SELECT *, unnest(range(k % 3)) AS m FROM ({_ITEMS}))
SELECT 'c' AS class_name, 'inaturalist' AS source, 'https://i.org/' || k || '/large.jpg' AS image_url, CASE WHEN k % 4 = 0 THEN 'https://www.inaturalist.org/observations/' || k ELSE 'https://o.org/' || k END AS landing_url,
  CASE WHEN k % 5 = 0 THEN 'n' ELSE name END AS title, CASE WHEN m = 0 THEN brand ELSE 'u' || k END AS creator, terms AS license, 'https://creativecommons.org/licenses/' AS license_url, k || ':' || (10 * k + m) AS source_id
FROM photos WHERE {_CORE_RULE}"""
)
def scan_observations(spark, sf_dir):
    k = F.col("k").cast("string")
    photo = lambda m: F.struct((10 * F.col("k") + m).alias("id"), F.concat(F.lit("https://i.org/"), k, F.when(m == 0, "/square.jpg").otherwise("/small.jpg")).alias("url"), F.col("terms").alias("license_code"), F.when(m == 0, F.col("brand")).alias("attribution"))
    photos = F.transform(F.filter(F.array(F.lit(0), F.lit(1)), lambda m: m < F.col("k") % 3), photo)
    item = F.struct(F.col("k").alias("id"), F.when(F.col("k") % 4 != 0, F.concat(F.lit("https://o.org/"), k)).alias("uri"), F.when(F.col("k") % 5 != 0, F.col("name")).alias("species_guess"), F.struct(F.concat(F.lit("u"), k).alias("login")).alias("user"), photos.alias("photos"))
    return api.observation_photos(_bodies(_items(spark, sf_dir), item), "c", "n").select(*_FOUND)


@query(
    f"""
WITH media AS (SELECT *, unnest(range(k % 3)) AS m FROM ({_ITEMS}))
SELECT 'c' AS class_name, 'gbif' AS source, 'https://g.org/' || k || '/' || m AS image_url, CASE WHEN k % 4 = 0 THEN 'https://www.gbif.org/occurrence/' || k ELSE 'https://r.org/' || k END AS landing_url,
  CASE WHEN m = 0 THEN name ELSE brand END AS title, 'by ' || k AS creator, CASE WHEN m = 0 THEN terms ELSE 'cc0' END AS license, CASE WHEN m = 0 THEN '' ELSE 'cc0' END AS license_url, k || ':' || 'https://g.org/' || k || '/' || m AS source_id
FROM media WHERE (m = 1 OR {_CORE_RULE}) AND k % 6 <> 5"""
)
def scan_occurrences(spark, sf_dir):
    k = F.col("k").cast("string")
    url = lambda m: F.concat(F.when(F.col("k") % 6 != 5, "https").otherwise("ftp"), F.lit("://g.org/"), k, F.lit("/"), m.cast("string"))
    media = lambda m: F.struct(url(m).alias("identifier"), F.when(m == 1, "cc0").alias("license"), F.when(m == 0, F.col("name")).alias("title"))
    item = F.struct(F.col("k").alias("key"), F.when(F.col("k") % 4 != 0, F.concat(F.lit("https://r.org/"), k)).alias("references"), F.col("terms").alias("license"), F.col("brand").alias("scientificName"), F.concat(F.lit("by "), k).alias("recordedBy"), F.transform(F.filter(F.array(F.lit(0), F.lit(1)), lambda m: m < F.col("k") % 3), media).alias("media"))
    return api.occurrence_media(_bodies(_items(spark, sf_dir), item, endOfRecords=F.lit(False)), "c", "n").select(*_FOUND)


@query(f"SELECT 'taxon' AS what, min(k) AS id FROM ({_ITEMS}) WHERE lower(name) = (SELECT lower(name) FROM ({_ITEMS}) WHERE k = 77) UNION ALL SELECT 'species', min(k) FROM ({_ITEMS}) WHERE page = 0")
def taxon_lookup(spark, sf_dir):
    items = _items(spark, sf_dir)
    name = items.filter("k = 77").first()["name"]
    taxon = api.taxon_id(_bodies(items, F.struct(F.col("k").alias("id"), F.col("name").alias("name"))), name.upper())
    answers = items.groupBy("page").agg(F.min("k").alias("k")).select("page", F.to_json(F.struct(F.lit(0).alias("usageKey"), F.col("k").alias("speciesKey"))).alias("body"))
    return spark.createDataFrame([("taxon", taxon), ("species", api.species_key(answers))], "what string, id long")


_LINKED = """html || '<a href="/wiki/File:Pic_' || (page_id % 97) || '.jpg">p</a><a href="/wiki/File:Doc_' || page_id || '.pdf">d</a>'"""


@query("SELECT DISTINCT 'Pic ' || (page_id % 97) || '.jpg' AS title, md5((20 + 313) || '|' || 'Pic ' || (page_id % 97) || '.jpg') AS key, 'see landing page' AS license FROM pages")
def gallery_files(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.expr(_LINKED).alias("html"))
    return files.gallery_files(pages, "c", 20).select("title", "key", "license")


@query(f"SELECT DISTINCT {_THUMB} || {_WIDTH} || 'px-P_' || page_id || '.jpg' AS image_url, md5((20 + 911) || '|' || {_THUMB} || {_WIDTH} || 'px-P_' || page_id || '.jpg') AS key, {_WIDTH} || 'px-P_' || page_id || '.jpg' AS title FROM pages")
def gallery_thumbnails(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.expr(_GALLERY).alias("html"))
    return files.gallery_images(pages, "c", 20).select("image_url", "key", "title")


@query("SELECT range AS pos, 'c_' || range AS name, coalesce((SELECT max(p_retailprice) > 1000 FROM part WHERE p_partkey = range), false) AS valid FROM range(500)")
def probing_scan(spark, sf_dir):
    there = table(spark, sf_dir, "part").select(F.concat(F.lit("c_"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_retailprice").alias("n_bytes"))
    return files.probed(spark, 500, lambda i: F.concat(F.lit("c_"), i.cast("string")), there)


@query("SELECT p_partkey AS k, row_number() OVER (ORDER BY p_brand || '|' || p_name || '|' || p_partkey || '|' || p_type || '|', md5(CAST(p_partkey AS VARCHAR))) AS pos FROM part")
def candidate_order(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("class_name"), F.col("p_name").alias("source"), F.col("p_partkey").cast("string").alias("source_id"), F.col("p_type").alias("image_url"), F.lit(None).cast("string").alias("landing_url"), F.md5(F.col("p_partkey").cast("string")).alias("sha256"))
    return dedup.candidate_order(rows.withColumn("key", stable_key())).select("k", "pos")


@query(
    f"""
WITH d AS (SELECT *, CAST(floor(k / 40) AS INT) AS page FROM ({_DETAILS})), n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
SELECT class_name, source, CASE WHEN page % 3 = 0 THEN 'r1' ELSE 'n' || (page % 25) END AS query, image_url, landing_url, title, creator, license, license_url, source_id
FROM d WHERE ({_OPEN_RULE.replace('terms', 'license')}) AND k % 4 <> 0 AND (page % 3 = 0 OR page % 25 IN (SELECT n_nationkey FROM n))"""
)
def scan_category(spark, sf_dir):
    details = _details(spark, sf_dir)
    own = details.select(F.concat(F.lit("n"), (F.col("page") % 25).cast("string")).alias("node"), "page", "body")
    bodies = own.union(details.filter("page % 3 = 0").select(F.lit("r1"), "page", "body"))
    walked = lookups.walk(_edges(spark, sf_dir), spark.createDataFrame([("r1",)], "node string"), 2)
    return api.category_files(walked, bodies, "c").select("query", *_FOUND)


# --- files and settings -------------------------------------------------------------------


@query("SELECT 'p/' || page_id || '.html' AS path, sha256(coalesce(html, '')) AS sha256 FROM pages")
def written_checksums(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.format_string("p/%d.html", "page_id").alias("name"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    work = shared_dir(spark)
    stored(sinks.write_files(pages, f"{work}/files"), f"{work}/written")
    return sinks.checksums(spark, f"{work}/files").select("path", "sha256")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents")
def review_pool(spark, sf_dir):
    work = f"{shared_dir(spark)}/pool"
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("class_name"), "source", F.col("lang"))
    sinks.write_csv(rows, work, ["class_name"])
    back = spark.read.schema("doc_id string, source string, lang string, class_name string").option("header", "true").csv(work)
    return back.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


@query("SELECT name, greatest(value, least) AS value FROM (SELECT unnest(['per_class', 'limit', 'pool']) AS name, unnest([(SELECT count(*) FROM region), (SELECT count(*) FROM nation), 0]) AS value, unnest([100, 7, 300]) AS least)")
def minimum_settings(spark, sf_dir):
    given = {"per_class": table(spark, sf_dir, "region").count(), "limit": table(spark, sf_dir, "nation").count()}
    settings = pipelines.with_minimums(given, {"per_class": 100, "limit": 7, "pool": 300})
    return spark.createDataFrame(list(settings.items()), "name string, value long")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) < (SELECT count(*) / 25 FROM part)")
def short_classes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return filters.short_groups(part, "p_brand", -(-part.count() // 25))


_PROMPTED = ["en", "de", "fr"]


@query(f"SELECT doc_id, lang, 'a text in ' || lang AS prompt, 100 + 1009 * (list_position({sql_list(_PROMPTED)}, lang) - 1) AS seed FROM documents WHERE lang IN {in_list(_PROMPTED)}")
def class_settings(spark, sf_dir):
    settings = spark.createDataFrame([(x, f"a text in {x}", 100 + 1009 * i) for i, x in enumerate(_PROMPTED)], "lang string, prompt string, seed long")
    return lookups.with_settings(table(spark, sf_dir, "documents").select("doc_id", "lang"), settings, "lang")


_VOWELS = ", ".join(f"CAST(length(text) - length(replace(text, '{x}', '')) AS DOUBLE)" for x in "aeiou")


@query(f"WITH v AS (SELECT doc_id, [{_VOWELS}] AS v FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, v, sqrt(list_sum([x * x for x in v])) + 1e-12 AS l FROM v) SELECT doc_id, round(CAST(CAST(v[1] / l AS FLOAT) AS DOUBLE), 5) AS a, round(CAST(CAST(v[5] / l AS FLOAT) AS DOUBLE), 5) AS u FROM u UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE text IS NULL")
def batch_encoder(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scoring.encoded(docs, "text", "sievekit.operators.scoring:LetterCounts")
    return found.select("doc_id", *[F.round(F.get("embedding", F.lit(i)).cast("double"), 5).alias(n) for n, i in (("a", 0), ("u", 4))])


# --- the pipelines ------------------------------------------------------------------------


def _policy(spark, sf_dir, count: int) -> pipelines.Policy:
    positive, negative = _prompts(spark, sf_dir, 1), _prompts(spark, sf_dir, 2)
    return pipelines.Policy(count=count, seed=20, score=lambda df: scoring.score_max(df, positive, negative), pool=lambda df, n: filters.ranked(df, filters.score_order(), 4 * n).drop("rank"), threshold=0.4, relaxed=0.5, val=0.0)


def _closed(spark, sf_dir, count: int = 8):
    rows = table(spark, sf_dir, "embeddings").withColumn("pos", F.col("vec_id"))
    return pipelines.closed_set(rows, [5, 6, 7], _policy(spark, sf_dir, count), by="label")


@query()
def closed_set_pipeline(spark, sf_dir):
    return _closed(spark, sf_dir)[0].select("vec_id", "label", "place", "split", "output_name")


_OPEN_SET = f"""
WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('20|' || vec_id), CAST(vec_id AS VARCHAR)) AS i FROM embeddings),
hidden AS (SELECT vec_id, CASE WHEN label < 2 THEN CAST(label AS VARCHAR) ELSE 'other' END AS label FROM r WHERE CASE WHEN label < 2 THEN i BETWEEN 15 AND 20 ELSE i <= 2 END)
SELECT vec_id, 'train' AS split, CAST(label AS VARCHAR) AS label, '' AS name FROM r WHERE label < 2 AND i <= 14
UNION ALL SELECT vec_id, 'hidden', label, 'image_' || lpad(CAST(row_number() OVER (ORDER BY md5('{20 + 99991}|' || vec_id), CAST(vec_id AS VARCHAR)) AS VARCHAR), 4, '0') || '.jpg' FROM hidden"""


def _open(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    identity: Column = F.col("vec_id").cast("string")
    return pipelines.open_set(rows.filter("label < 2"), rows.filter("label >= 2"), {"train": 14, "test": 6}, 2, 20, "label", "label", identity)


@query(_OPEN_SET)
def open_set_pipeline(spark, sf_dir):
    train, hidden = _open(spark, sf_dir)
    part = train.select("vec_id", F.col("split"), F.col("label").cast("string").alias("label"), F.lit("").alias("name"))
    return part.union(hidden.select("vec_id", F.lit("hidden"), "label", "name"))


@query(
    f"""
WITH o AS ({_OPEN_SET}), f AS (SELECT 'distinct' AS what, 56 AS expected, count(DISTINCT vec_id) AS found FROM o
UNION ALL SELECT 'in_both_parts', 0, (SELECT count(*) FROM (SELECT vec_id FROM o WHERE split = 'train' INTERSECT SELECT vec_id FROM o WHERE split = 'hidden'))
UNION ALL SELECT 'hidden_rows', 28, count(*) FROM o WHERE split = 'hidden' UNION ALL SELECT 'names_twice', 0, (SELECT count(*) FROM (SELECT name FROM o WHERE split = 'hidden' GROUP BY name HAVING count(*) > 1)))
SELECT what, expected::BIGINT AS expected, found::BIGINT AS found, found = expected AS ok FROM f"""
)
def open_set_invariants(spark, sf_dir):
    train, hidden = _open(spark, sf_dir)
    return pipelines.open_set_invariants(train, hidden, "vec_id", 56, 28)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel of the closed-set pipeline: rows of each class after each stage."""
    return _closed(spark, sf_dir)[1]


__all__ = ["flagship", "oracle_sql", "queries", "seeded_order"]
