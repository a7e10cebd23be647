"""One query for each training-data operator, over its whole table; and the SQL that some of them equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import licenses, urlfilter
from .bands import quality_rules
from .decontaminate import contained_items
from .fill_in_middle import fill_in_middle, restore
from .langid import identify
from .media import media_digest
from .mixing import mix
from .nearcopies import near_duplicates
from .negatives import hard_negatives
from .quality import score
from .sharding import shard
from .warc import round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch date, spread over 2023 and 2024 by page_id: the tables have no dates of their own."""
    return pages.select("page_id", "url", F.expr("date_add(date'2023-01-01', cast(pmod(page_id * 37, 700) as int))").alias("fetched"))


def _entries(pages: DataFrame) -> DataFrame:
    """A dated list from the hosts and site sections of the pages: each has up to three entries, chosen by the digits of its MD5."""
    hosts = pages.select(urlfilter.host_of("url").alias("host"), F.lower(F.regexp_extract("url", urlfilter.PATH, 1)).alias("section")).where("host <> ''").distinct()
    names = hosts.select(F.lit("domain").alias("kind"), F.col("host").alias("pattern")).union(hosts.select(F.lit("domain"), F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)).where("regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) <> ''"))
    names = names.union(hosts.where("section <> ''").select(F.lit("section"), F.concat("host", F.lit("/"), "section"))).distinct().withColumn("m", F.md5("pattern"))
    number = lambda at, n: F.conv(F.substring("m", at, n), 16, 10).cast("int")
    found = []
    for k, action in enumerate(("block", "remove", "allow")):
        day = F.date_add(F.lit("2023-01-01").cast("date"), number(2 + 4 * k, 3) % 300 + 200 * k)
        found.append(names.where(number(1 + 4 * k, 1) < 6).select("kind", "pattern", F.lit(action).alias("action"), day.alias("since")))
    return found[0].union(found[1]).union(found[2])


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(_captures(pages), _entries(pages))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def _files(docs: DataFrame) -> DataFrame:
    """Documents as files of a source tree: doc_id gives directory and name, every seventh is its directory's LICENSE."""
    name = F.when(F.expr("pmod(doc_id, 7) = 0"), F.lit("LICENSE")).otherwise(F.concat(F.lit("file"), F.col("doc_id").cast("string"), F.lit(".txt")))
    number = lambda expr: F.expr(f"cast({expr} as string)")
    path = F.concat(F.coalesce("source", F.lit("none")), F.lit("/p"), number("pmod(doc_id div 7, 40)"), F.when(F.expr("pmod(doc_id, 3) > 0"), F.concat(F.lit("/d"), number("pmod(doc_id div 21, 6)"))).otherwise(""), F.when(F.expr("pmod(doc_id, 3) = 2"), F.concat(F.lit("/s"), number("pmod(doc_id, 4)"))).otherwise(""), F.lit("/"), name)
    return docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(list(licenses.TEMPLATES), "licence string, notice string")
    return licenses.scan(_files(_table(spark, sf_dir, "documents")), templates).withColumnRenamed("file_id", "doc_id")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where vec_id is divisible by 7, the next label is taken: the contract's way to have labels that disagree with the vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(fill_in_middle(_table(spark, sf_dir, "documents")), texts=False)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_license_scans": op4_license_scans,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_sharding": op6_sharding,
    "op7_media_columns": op7_media_columns,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_quality_rules": op13_quality_rules,
}

_SHINGLES = """
{p}_w AS (SELECT DISTINCT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table} WHERE text IS NOT NULL AND {id} IS NOT NULL),
{p} AS (SELECT DISTINCT id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ') ELSE array_to_string(w, ' ') END AS s
        FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM {p}_w WHERE len(w) > 0))"""

ORACLES: dict[str, str] = {
    "op2_decontamination": "WITH "
    + _SHINGLES.format(p="d", id="doc_id", table="documents")
    + ","
    + _SHINGLES.format(p="b", id="item_id", table="benchmark")
    + """,
q AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(q.n) AS item_shingles, count(*) AS shared, round(count(*) / any_value(q.n), 6) AS containment
FROM d JOIN b ON d.s = b.s JOIN q ON q.id = b.id GROUP BY d.id, b.id HAVING count(*) * 100 >= any_value(q.n) * 75""",
    "op1_url_filters": r"""
WITH c AS (SELECT page_id, url, DATE '2023-01-01' + CAST(((page_id * 37) % 700) AS INTEGER) AS fetched, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#\\]*@)?(\[[^\]/?#\\]*\]|[^/?#\\:@\[\]]*)', 1)), '\.+$', '') AS host,
                  lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)/', 1)) AS section FROM pages),
h AS (SELECT DISTINCT host, section FROM c WHERE host <> ''),
p AS (SELECT 'domain' AS kind, host AS pattern FROM h
      UNION SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM h WHERE regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) <> ''
      UNION SELECT 'section', host || '/' || section FROM h WHERE section <> ''),
m AS (SELECT *, md5(pattern) AS m FROM p),
e AS (SELECT kind, pattern, 'block' AS action, DATE '2023-01-01' + CAST(('0x' || m[2:4])::INTEGER % 300 AS INTEGER) AS since FROM m WHERE ('0x' || m[1])::INTEGER < 6
      UNION ALL SELECT kind, pattern, 'remove', DATE '2023-01-01' + CAST(('0x' || m[6:8])::INTEGER % 300 + 200 AS INTEGER) FROM m WHERE ('0x' || m[5])::INTEGER < 6
      UNION ALL SELECT kind, pattern, 'allow', DATE '2023-01-01' + CAST(('0x' || m[10:12])::INTEGER % 300 + 400 AS INTEGER) FROM m WHERE ('0x' || m[9])::INTEGER < 6),
d AS (SELECT kind, pattern, since, max(action) AS action FROM e GROUP BY kind, pattern, since),
v AS (SELECT *, lead(since) OVER (PARTITION BY kind, pattern ORDER BY since) AS until FROM d),
t AS (SELECT page_id, fetched, 1 AS rank, 'section' AS kind, host || '/' || section AS pattern FROM c WHERE host <> '' AND section <> ''
      UNION ALL SELECT page_id, fetched, 1 + i, 'domain', array_to_string(string_split(host, '.')[i:], '.') FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM c WHERE host <> '')),
a AS (SELECT t.page_id, t.rank, v.kind, v.pattern, v.action, v.since, row_number() OVER (PARTITION BY t.page_id ORDER BY t.rank, v.kind, v.pattern) AS k
      FROM t JOIN v ON t.kind = v.kind AND t.pattern = v.pattern AND v.since <= t.fetched AND (v.until IS NULL OR t.fetched < v.until) WHERE v.action <> 'remove')
SELECT c.page_id, c.url, c.fetched, c.host, coalesce(a.action, 'pass') AS verdict, a.kind, a.pattern, a.since AS listed_since FROM c LEFT JOIN a ON a.page_id = c.page_id AND a.k = 1""",
    "op8_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS o FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, pages.url, n AS payload_bytes, p.d AS payload_digest, CASE WHEN o IS NULL OR o = p.page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN o <> p.page_id THEN o END AS refers_to
FROM p JOIN pages ON pages.page_id = p.page_id LEFT JOIN f ON f.d = p.d AND n >= 100""",
    "op4_license_scans": "WITH t(licence, notice) AS (VALUES "
    + ", ".join(f"('{name}', '{notice}')" for name, notice in licenses.TEMPLATES)
    + rf"""),
files AS (SELECT doc_id, text, coalesce(source, 'none') || '/p' || ((doc_id // 7) % 40) || CASE WHEN doc_id % 3 > 0 THEN '/d' || ((doc_id // 21) % 6) ELSE '' END || CASE WHEN doc_id % 3 = 2 THEN '/s' || (doc_id % 4) ELSE '' END AS directory, doc_id % 7 = 0 AS is_licence FROM documents),
opening(a, b, n) AS (VALUES {", ".join(str(x) for x in licenses.openings(licenses.TEMPLATES))}),
terms AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{licenses.TERM}'), lambda x: x NOT IN {licenses.STOP}) AS t FROM files),
spdx AS (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(lower(said), '{licenses.EXCEPTION}', '', 'g'), '{licenses.PARTS}')) AS part FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{licenses.SPDX}', 1)) AS said FROM files)),
named AS (SELECT doc_id, regexp_replace(regexp_replace(trim(part), '{licenses.SUFFIX}', '', 'g'), '[0-9]+', '', 'g') AS name FROM spdx),
noted AS (SELECT DISTINCT doc_id, lower(trim(regexp_replace(line, '[0-9]+', '', 'g'))) AS notice, false AS whole FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM files) WHERE regexp_matches(line, '{licenses.MARKERS}')
          UNION SELECT doc_id, array_to_string(t[i:i + n - 1], ' '), true FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM terms WHERE len(list_intersect(t, (SELECT list(a) FROM opening))) > 0) JOIN opening ON t[i] = a AND t[i + 1] = b
          UNION SELECT doc_id, 'spdx-license-identifier: ' || name, true FROM named WHERE name <> ''),
ttf AS (SELECT licence, template, term, count(*) AS tf FROM (SELECT licence, notice AS template, unnest(regexp_extract_all(lower(notice), '{licenses.TERM}')) AS term FROM t) WHERE term NOT IN {licenses.STOP} GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM ttf GROUP BY term),
k AS (SELECT count(*) AS k FROM t),
tw AS (SELECT licence, template, term, tf * (ln((1.0::DOUBLE + k) / (1 + df)) + 1) AS w FROM ttf JOIN df USING (term), k),
tu AS (SELECT licence, template, term, w / sqrt(sum(w * w) OVER (PARTITION BY licence, template)) AS w FROM tw),
ntf AS (SELECT notice, term, count(*) AS tf FROM (SELECT notice, unnest(regexp_extract_all(notice, '{licenses.TERM}')) AS term FROM (SELECT DISTINCT notice FROM noted)) WHERE term NOT IN {licenses.STOP} GROUP BY ALL),
nw AS (SELECT notice, term, tf * (ln((1.0::DOUBLE + k) / (1 + coalesce(df, 0))) + 1) AS v FROM ntf LEFT JOIN df USING (term), k),
size AS (SELECT notice, sqrt(sum(v * v)) AS size FROM nw GROUP BY notice),
cosine AS (SELECT notice, licence, template, round(sum(v * w) / any_value(size), 4) AS score FROM nw JOIN tu USING (term) JOIN size USING (notice) GROUP BY ALL),
best AS (SELECT notice, licence, score FROM cosine QUALIFY row_number() OVER (PARTITION BY notice ORDER BY score DESC, licence) = 1),
liked AS (SELECT doc_id, whole, licence, score FROM noted JOIN best USING (notice) WHERE score >= CASE WHEN whole THEN {licenses.LEAST_WHOLE} ELSE {licenses.LEAST} END),
own AS (SELECT doc_id, string_agg(DISTINCT licence, ', ' ORDER BY licence) AS licence, max(score) AS score FROM liked WHERE whole GROUP BY doc_id
        UNION ALL SELECT doc_id, licence, score FROM liked WHERE doc_id NOT IN (SELECT doc_id FROM liked WHERE whole) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
placed AS (SELECT files.doc_id, directory, is_licence, licence, score FROM files LEFT JOIN own USING (doc_id)),
given AS (SELECT directory AS ancestor, licence AS given FROM placed WHERE is_licence AND licence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, licence) = 1),
up AS (SELECT directory, ancestor, given FROM (SELECT DISTINCT directory FROM placed) d JOIN given ON d.directory = ancestor OR starts_with(d.directory, ancestor || '/') QUALIFY row_number() OVER (PARTITION BY directory ORDER BY length(ancestor) DESC) = 1)
SELECT doc_id, placed.directory, licence AS own, score, coalesce(licence, given) AS licence, CASE WHEN licence IS NULL THEN ancestor END AS inherited_from
FROM placed LEFT JOIN up ON up.directory = placed.directory""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, [('0x' || h[1 + 8 * i:8 + 8 * i])::BIGINT for i in range(4)] AS r FROM d),
c AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
      least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b FROM k),
t AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM t""",
}
