"""The registered queries of this subpackage: each applies its operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import Staging
from . import collocations, decontaminate, langid, lm, mixing, near, notices, quality, ranking, sharding, toxicity, vectors, warc
from .fits import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


Query = Callable[[SparkSession, str], DataFrame]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def equals(sql: str) -> Callable[[Query], Query]:
    """The DuckDB SQL of the query's rows."""

    def register(fn: Query) -> Query:
        SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold(7) != 2)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.scan(table(spark, sf_dir, "documents"))


_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _windows_sql(rows: str, keep: str) -> str:
    return f"""
  SELECT {keep}, m, pos, array_to_string(list_transform(ones, lambda k: w[pos + k + 1]), ' ') AS seed
  FROM (SELECT *, unnest(range(0, len(w) - len(m) + 1)) AS pos FROM {rows} WHERE len(w) >= len(m))"""


@equals(f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE len({_WORDS}) > 0),
masks AS (
  SELECT *, list_filter(range(0, len(m)), lambda k: m[k + 1] = '1') AS ones
  FROM (SELECT unnest(['{decontaminate.MASKS[0]}', '{decontaminate.MASKS[1]}']) AS m, NULL AS of_length
        UNION ALL SELECT DISTINCT repeat('1', len(w)), len(w) FROM items WHERE len(w) < {min(map(len, decontaminate.MASKS))})),
docs AS (SELECT DISTINCT doc_id, text, {_WORDS} AS w FROM documents),
item_masks AS (SELECT * FROM items, masks WHERE of_length IS NULL OR of_length = len(w)),
doc_masks AS (SELECT * FROM docs, masks),
item_windows AS ({_windows_sql('item_masks', 'item_id, w')}),
doc_windows AS ({_windows_sql('doc_masks', 'doc_id, text, w')}),
hits AS (
  SELECT doc_id, text, item_id, d.pos - i.pos AS place, count(*) AS hits, any_value(d.w) AS dw, any_value(i.w) AS iw
  FROM doc_windows d JOIN item_windows i USING (m, seed) GROUP BY ALL),
compared AS (
  SELECT *, len(iw) AS item_words,
         list_transform(range(1, len(iw) + 1), lambda k: place + k >= 1 AND place + k <= len(dw) AND coalesce(dw[place + k] = iw[k], false)) AS same
  FROM hits),
checked AS (SELECT *, len(list_filter(same, lambda x: x)) AS agree FROM compared),
judged AS (
  SELECT *, list_filter(range(1, item_words + 1), lambda k: same[k]) AS agreeing,
         agree >= ceil(item_words * {decontaminate.OVERLAP})
         OR len(list_filter(range(1, item_words - {decontaminate.STRETCH} + 2), lambda i: same[i] AND same[i + {decontaminate.STRETCH - 1}]
                AND len(list_filter(same[i:i + {decontaminate.STRETCH - 1}], lambda x: x)) >= {decontaminate.STRETCH - decontaminate.STRETCH_CHANGES})) > 0 AS alone
  FROM checked),
banded AS (
  SELECT doc_id, text, item_id, item_words, k, floor((place + k * {decontaminate.BAND // 2}) / {decontaminate.BAND}) AS band,
         len(list_distinct(flatten(list(agreeing)))) AS agree
  FROM judged, (SELECT unnest([0, 1]) AS k) GROUP BY ALL),
found AS (
  SELECT doc_id, text, item_id FROM judged WHERE alone
  UNION SELECT doc_id, text, item_id FROM banded WHERE agree >= ceil(item_words * {decontaminate.OVERLAP}))
SELECT doc_id, item_id, agree, item_words, greatest(place, 0) AS first_word, place + item_words - 1 AS last_word, total AS hits
FROM (SELECT j.*, sum(hits) OVER (PARTITION BY j.doc_id, j.text, j.item_id) AS total,
             row_number() OVER (PARTITION BY j.doc_id, j.text, j.item_id ORDER BY agree DESC, place) AS rn
      FROM judged j JOIN found f ON j.doc_id IS NOT DISTINCT FROM f.doc_id AND j.text IS NOT DISTINCT FROM f.text AND j.item_id IS NOT DISTINCT FROM f.item_id)
WHERE rn = 1""")
@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("fingerprint")


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "source", mixing.tokens(docs["text"]).alias("n_tokens")), text=False)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.score(docs, langid.train(docs))


@equals(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON r = a)
SELECT sets.doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)""")
@query
def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.join(table(spark, sf_dir, "documents"))


@equals("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""")
@query
def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@equals(rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang, regexp_extract_all(unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, w[i:i + k - 1] AS ws
  FROM places, (SELECT unnest(range(1, {collocations.MAX_WORDS + 1})) AS k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, k, g, any_value(ws) AS ws, CAST(count(*) AS BIGINT) AS a FROM grams GROUP BY lang, k, g),
whole AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM counted WHERE a >= {collocations.LEAST}),
inside AS (
  SELECT DISTINCT y.lang, x.g FROM often x JOIN often y ON x.lang = y.lang AND x.k >= 2 AND y.k > x.k AND 100 * y.a >= 100 * x.a
   AND contains(' ' || y.g || ' ', ' ' || x.g || ' ')),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k >= 2),
scored AS (
  SELECT c.lang, c.g AS phrase, c.a, l.a AS l, r.a AS r, n, cut,
         CAST((1000 * CAST(c.a AS HUGEINT) * CAST(n AS HUGEINT)) // (CAST(l.a AS HUGEINT) * CAST(r.a AS HUGEINT)) AS BIGINT) AS score
  FROM cuts c JOIN whole USING (lang)
  JOIN often l ON l.lang = c.lang AND l.g = array_to_string(c.ws[1:cut], ' ')
  JOIN often r ON r.lang = c.lang AND r.g = array_to_string(c.ws[cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest x WHERE NOT EXISTS (FROM inside i WHERE i.lang = x.lang AND i.g = x.phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {collocations.TOP}""")
@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@equals(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
heads AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY html) END AS head FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN head IS NOT NULL AND page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM heads""")
@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives lie in the shared folder; they are read once more than the result is, so they stay there."""
    folder = Staging(spark).folder() + "/archives"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.digests(warc.salvage(spark, folder, payloads=False))


_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@equals(f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS length FROM docs WHERE len(t) > 0),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
held AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
impacts AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // length)) AS impact FROM held, whole),
scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, r HAVING sum(w * impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM scored) WHERE rank <= {ranking.K}""")
@query
def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
