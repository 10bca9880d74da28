"""The registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op2_packing")
def op2(spark, sf_dir):
    """Harmonic packing of all documents into sequences of 4096 tokens."""
    from cauce.llm.packing import pack
    return pack(documents(spark, sf_dir))


@register("op8_simhash")
def op8(spark, sf_dir):
    """SimHash fingerprints of all documents, linked at 4 or fewer bits."""
    from pyspark.sql import functions as F

    from cauce.llm.simhash import near_duplicates
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op3_mixing")
def op3(spark, sf_dir):
    """All documents mixed to weights 3, 1, 2 of their sources in code point order."""
    from cauce.llm.mixing import mix
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


@register("op4_secrets")
def op4(spark, sf_dir):
    """Secrets in all documents: base patterns and the randomness battery."""
    from cauce.llm.secret_scan import find_secrets
    return find_secrets(documents(spark, sf_dir))


@register("op1_quality")
def op1(spark, sf_dir):
    """Quality of all documents, learned from positives and unlabelled text."""
    from cauce.llm.quality import score
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register("op6_syncmers")
def op6(spark, sf_dir):
    """Closed-syncmer fingerprints of all documents and of their edited texts, in dense form."""
    from cauce.llm.syncmers import dense, fingerprints
    return fingerprints(documents(spark, sf_dir), form=dense)


#: Bytes as hex text, so that a byte is two characters and a window 800.
SUFFIX_DEDUP_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT rid, i, md5(substr(x, 2 * i + 1, 800)) AS h
  FROM (SELECT rid, x, unnest(range(0, len(x) // 2 - 399)) AS i FROM d WHERE len(x) >= 800)),
s AS (
  SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p
  FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
r AS (
  SELECT rid, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT rid, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END)
               OVER (PARTITION BY rid ORDER BY i) AS run FROM s)
  GROUP BY rid, run),
k AS (
  SELECT r.rid, a, b, x, lag(b, 1, 0) OVER (PARTITION BY r.rid ORDER BY a) AS q FROM r JOIN d ON d.rid = r.rid),
g AS (
  SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substr(x, 2 * q + 1, 2 * (a - q)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM k GROUP BY rid)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN g ON g.rid = d.rid
"""


@register("op10_suffix_dedup", SUFFIX_DEDUP_SQL)
def op10(spark, sf_dir):
    """All documents without the bytes of repeated 400-byte strings."""
    from cauce.llm.suffix_dedup import dedup
    return dedup(documents(spark, sf_dir))


@register("op7_rangecoder")
def op7(spark, sf_dir):
    """All documents' token ids written as coded blocks and read back."""
    from cauce.llm.rangecoder import round_trip
    return round_trip(documents(spark, sf_dir))


@register("op5_neighbours")
def op5(spark, sf_dir):
    """The 5 nearest embeddings of every fiftieth one, by cosine."""
    from pyspark.sql import functions as F

    from cauce.llm.neighbours import nearest
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@register("op9_transcripts")
def op9(spark, sf_dir):
    """Roles of all conversations recovered from raw transcripts, rendered."""
    from cauce.llm.transcripts import format_chats
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: crc32 of UTF-8 text, as a list of bytes reduced with the table made by rule.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc_sql(text: str) -> str:
    """crc32 of a SQL expression, beside ``crc_table`` (column t)."""
    hexed = f"hex(encode({text}))"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(len({hexed}) // 2), "
            f"lambda i: CAST('0x' || substr({hexed}, 2 * i + 1, 2) AS BIGINT))), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')),
                     '{_CAPITALS}', '{_CAPITALS.lower()}') AS run FROM documents)
  GROUP BY id, run),
h AS (SELECT run, n, {crc_sql("id || ':' || run")} AS h FROM r, crc_table),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                   ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
c AS MATERIALIZED (
  SELECT word, n, p, substr(word, 1, p - 1) AS a, substr(word, p + 1) AS z
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w)),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM c x JOIN c y ON x.p = y.p AND x.a = y.a AND x.z = y.z
  WHERE x.word <> y.word
  UNION SELECT c.word, w.word, w.n FROM c JOIN w ON w.word = c.a || c.z
  UNION SELECT w.word, c.word, c.n FROM c JOIN w ON w.word = c.a || c.z),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
pick AS (
  SELECT near.word, min(other) AS form, any_value(n_near) AS n_near, any_value(top) AS top
  FROM near JOIN best ON best.word = near.word AND top = other_n GROUP BY near.word),
f AS MATERIALIZED (
  SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN top >= 10 * w.n THEN form END AS form,
         CASE WHEN top >= 10 * w.n THEN top END AS form_n
  FROM w LEFT JOIN pick ON pick.word = w.word),
chain AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain c ON c.word = f.word JOIN f e ON e.word = c.at AND e.form IS NULL
"""


@register("op11_spelling", SPELLING_SQL)
def op11(spark, sf_dir):
    """Words of all documents, the frequent form each varies, and its root."""
    from cauce.llm.spelling import group_variants
    return group_variants(documents(spark, sf_dir))


#: Words by byte classes: what is not an ASCII digit, letter or beyond ASCII separates.
RESAMPLE_SQL = f"""
WITH {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
  FROM documents),
v AS (SELECT rid, unnest(words) AS word FROM d),
b AS (
  SELECT unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'),
                                   '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM benchmark),
k AS MATERIALIZED (
  SELECT word, {crc_sql("word")} % 10000 AS bucket
  FROM (SELECT word FROM v UNION SELECT word FROM b), crc_table),
s AS (SELECT bucket, count(*) AS n FROM v JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (word) GROUP BY bucket),
g AS MATERIALIZED (
  SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM v) + 10000)
                                        / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
w AS (
  SELECT rid, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM v JOIN k USING (word) JOIN g USING (bucket) GROUP BY rid),
h AS (
  SELECT d.doc_id, d.rid, CAST(coalesce(len(words), 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN w ON w.rid = d.rid),
x AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM h),
r AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM x LEFT JOIN r ON r.rid = x.rid
"""


@register("op13_resample", RESAMPLE_SQL)
def op13(spark, sf_dir):
    """A tenth of all documents drawn towards the word distribution of the benchmark."""
    from cauce.llm.resample import resample
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register("op12_language")
def op12(spark, sf_dir):
    """Language of all documents by string kernels."""
    from cauce.llm.language import predict
    return predict(documents(spark, sf_dir))
