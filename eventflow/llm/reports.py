"""Settings of the mixing query, and the SQL of the queries that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.mixing import mix

WEIGHTS = {
    "domain": {"sites0": 5, "sites1": 3, "sites2": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
}


def mixed(docs: DataFrame) -> DataFrame:
    """Documents by ``WEIGHTS``; the domain is the source's number modulo 3."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    group = F.concat(F.lit("sites"), (number.try_cast("int") % 3).cast("string"))
    return mix(docs, domain=F.when(number != "", group), weights=WEIGHTS, max_epochs=2, seed=17)


def _share_sql(level: str, parents: str, nodes: str) -> str:
    own = f"PARTITION BY {parents}" if parents else ""
    order = f"{own} ORDER BY cap / weight, {level}"
    return f"""
    SELECT *, CASE WHEN is_full THEN cap ELSE ((budget - held) * weight) // greatest(open, 1) END AS given
    FROM (
        SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({own}) AS held,
               sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({own}) AS open
        FROM (
            SELECT *, cap * rest <= (budget - before) * weight AS is_full FROM (
                SELECT *,
                    coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                    sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
                FROM ({nodes})
            )
        )
    )"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE 1 END"


_DOMAINS = f"""SELECT domain, sum(cap) AS cap, {_weight_sql("domain")} AS weight,
    (SELECT sum(tokens) FROM leaf) AS budget FROM leaf GROUP BY domain"""
_LANGS = f"""SELECT n.*, a.given AS budget FROM (
        SELECT domain, lang, sum(cap) AS cap, {_weight_sql("lang")} AS weight FROM leaf GROUP BY domain, lang
    ) n JOIN a ON a.domain = n.domain"""
_SOURCES = """SELECT n.*, b.given AS budget
    FROM (SELECT domain, lang, source, tokens, cap, 1 AS weight FROM leaf) n
    JOIN b ON b.domain = n.domain AND b.lang = n.lang"""

MIX_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
           coalesce('sites' || (try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INT) % 3),
                    'unknown') AS domain,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
    FROM documents
),
leaf AS (
    SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(sum(tokens) * 2 AS HUGEINT) AS cap
    FROM d GROUP BY domain, lang, source
),
a AS ({_share_sql("domain", "", _DOMAINS)}),
b AS ({_share_sql("lang", "domain", _LANGS)}),
c AS ({_share_sql("source", "domain, lang", _SOURCES)}),
p AS (
    SELECT d.*, CAST(given // c.tokens AS BIGINT) AS full_epochs, given % c.tokens AS rest,
           md5('17:' || CAST(given // c.tokens AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
    FROM d JOIN c ON d.domain = c.domain AND d.lang = c.lang AND d.source = c.source
    WHERE c.tokens > 0 AND given > 0
),
s AS (
    SELECT *, sum(tokens) OVER (
        PARTITION BY domain, lang, source ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    ) AS upto FROM p
),
t AS (SELECT *, full_epochs + CAST(rest > 0 AND upto <= rest AS BIGINT) AS copies FROM s)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS n_tokens, copies FROM t WHERE copies > 0
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS n, sha256(body) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest AND d.n >= 100
"""

LINES_SQL = """
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
),
w AS (
    SELECT doc_id, i, line,
           CASE WHEN lead(i, 2) OVER d IS NOT NULL
                     AND trim(line || lead(line) OVER d || lead(line, 2) OVER d,
                              chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
                THEN md5(line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d)
           END AS win
    FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)
),
f AS (
    SELECT win, min(struct_pack(a := doc_id, b := i)) AS first FROM w WHERE win IS NOT NULL GROUP BY win
),
r AS (
    SELECT w.doc_id, w.i, w.line, coalesce(f.first <> struct_pack(a := w.doc_id, b := w.i), false) AS again
    FROM w LEFT JOIN f ON w.win = f.win
),
g AS (
    SELECT *, again OR coalesce(lag(again) OVER d, false) OR coalesce(lag(again, 2) OVER d, false) AS gone
    FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY i)
),
e AS (
    SELECT *, gone AND NOT coalesce(lead(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS ends FROM g
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_removed,
       CAST(sum(ends::INT) AS BIGINT) AS n_runs,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM e GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, 0, NULL FROM documents WHERE text IS NULL
"""


#: CRC-32 of each different word by eight steps of its register for each byte.
RESAMPLE_SQL = r"""
WITH texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts
), distinct_words AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)
), codes AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2),
      lambda i: 16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
              + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)),
    lambda reg, b: list_reduce([xor(reg, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 10000 AS bucket
  FROM distinct_words
), counts AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
  FROM words JOIN codes USING (w) GROUP BY bucket
), totals AS (SELECT sum(s)::DOUBLE AS sa, sum(t)::DOUBLE AS ta FROM counts), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sa + 10000) / ((s + 1.0::DOUBLE) * (ta + 10000))))::BIGINT AS gain
  FROM counts, totals
), weighed AS (
  SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight
  FROM words JOIN codes USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON id = doc_id
), able AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""

NEGATIVES_SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.v, c.v)::BIGINT AS score
  FROM part a JOIN part c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
