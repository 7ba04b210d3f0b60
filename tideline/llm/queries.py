"""The registered queries of this package: thin digests of the operators' results, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    chat, collocations, decontaminate, language_id, licenses, near_duplicates, neighbours, packing, pii,
    secret_scan, sharding, simhash, spelling,
)
from tideline.llm.text import bound_batches


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary() -> str:
    """File of the public byte-level vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_secret_scan(spark, sf):
    found = secret_scan.scan(F.col("text")).alias("found")
    return table(spark, sf, "documents").select("doc_id", found).select(
        "doc_id", "found.n_assign", "found.n_access", "found.n_hex", "found.base_sha256", "found.spans",
        "found.n_literal",
    )


def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language_id.fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return language_id.identify(docs).select(
        "doc_id", held_out, "language.lang_pred", "language.score", "language.entropy", "language.rejected"
    )


def op3_personal_data(spark, sf):
    found = pii.scan(F.col("text")).alias("found")
    return table(spark, sf, "documents").select("doc_id", found).select(
        "doc_id", "found.n_email", "found.n_ip", "found.n_card", "found.n_phone", "found.base_sha256",
        "found.spans", "found.n_login", "found.n_iban", "found.n_ssn", "found.n_account",
    )


def op4_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), vocabulary())


def op5_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        decontaminate.hit_words().alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op6_sharding(spark, sf):
    placed = sharding.shard_documents(table(spark, sf, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_nearest(spark, sf):
    rows = table(spark, sf, "embeddings")
    return neighbours.nearest(rows, F.col("vec_id") % 100 == 0, k=10)


def op8_chat(spark, sf):
    said = F.lit("<|im_end|><|im_start|>assistant ok").alias("text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said,
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_windows(rows.unionByName(tricky), vocabulary())
    return chat.read_back(formatted).withColumnRenamed("conv", "conv_id")


def op9_near_duplicates(spark, sf):
    return near_duplicates.find_groups(table(spark, sf, "documents"), size=2)


def op10_licenses(spark, sf):
    return licenses.license_report(table(spark, sf, "documents"))


def op11_spelling(spark, sf):
    found = spelling.group_variants(table(spark, sf, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_collocations(spark, sf):
    return collocations.find_collocations(table(spark, sf, "documents"))


def op13_simhash(spark, sf):
    found = simhash.find_groups(table(spark, sf, "documents"))
    return found.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_language_id, op3_personal_data, op4_packing, op5_decontaminate,
        op6_sharding, op7_nearest, op8_chat, op9_near_duplicates, op10_licenses,
        op11_spelling, op12_collocations, op13_simhash,
    )
}

LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

DECONTAMINATE_SQL = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
sized AS (SELECT item, ws, least(13, len(ws)) AS m FROM items WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item, m, array_to_string(ws[i : i + m - 1], ' ') AS gram
  FROM (SELECT item, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM sized)),
grams AS (
  SELECT doc_id, i, m, array_to_string(ws[i : i + m - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM docs, (SELECT DISTINCT m FROM windows))),
found AS (SELECT doc_id, i, g.m, item FROM grams g JOIN windows w ON g.m = w.m AND g.gram = w.gram),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM (SELECT DISTINCT doc_id, i, m FROM found))
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 1], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON a.doc_id = x.doc_id JOIN sizes y ON b.doc_id = y.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN lowest l ON d.doc_id = l.doc_id"""

# The hash is CRC-32 (reflected polynomial EDB88320), a byte at a time over a table made by rule.
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
crc_table AS (
  SELECT list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
octets AS (
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)]::BIGINT[] END)) AS bs
  FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], bs),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS h
  FROM octets, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, word[1 : i - 1] AS a, word[i + 1 :] AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM cut x JOIN cut y
    ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM cut x JOIN words w ON w.word = x.a || x.b
  UNION SELECT w.word, x.word, x.n FROM cut x JOIN words w ON w.word = x.a || x.b),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS near_n, arg_min(near, (-near_n, near)) AS near
  FROM pairs GROUP BY word),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS steps FROM known
  UNION ALL SELECT c.word, k.form, steps + 1 FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM known JOIN roots USING (word)"""

COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \t]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS f,
    min(ws[i : i + m - 1]) AS ws
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM pieces, range(1, 4) t(m))
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.ws, c.f AS a, k, l.f AS l, r.f AS r,
    ({1_000_000}::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1 AND f >= 10) c
  JOIN grams l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(c.ws[1 : k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(c.ws[k + 1 :], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, m ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, array_to_string(ws[i : i + 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, 3)) AS i FROM grams WHERE m = 3 AND f >= 10)) GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM scored s LEFT JOIN longer g USING (lang, phrase) JOIN totals USING (lang)
WHERE m = 3 OR g.f IS NULL OR 100 * g.f < 50 * a
QUALIFY rank <= 2000"""

# The others' own finds (literals, languages, places, neighbours, windows, edits) are beyond SQL; they
# are tested against plain versions of their contracts.
ORACLE: dict[str, str] = {
    "op5_decontaminate": DECONTAMINATE_SQL,
    "op9_near_duplicates": NEAR_DUPLICATES_SQL,
    "op11_spelling": SPELLING_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
}
