"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bag_minhash, cap_filters, chunked_bpe, id_blocks, line_frequency, line_index, mixing, nn_descent, periodic_runs, phrases, ppm_language, toxicity, warc_zst
from tidemark.llm.common import fold, let, ship, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    @wraps(function)
    def run(spark, folder):
        ship(spark)
        return function(spark, folder)

    REGISTRY[function.__name__] = run
    return run


@query
def op4_line_frequency(spark, folder):
    docs = table(spark, folder, "documents")
    judged = line_frequency.judge(docs, keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLE["op4_line_frequency"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(0)) AS host, text,
         coalesce(text, '') AS body FROM documents),
words AS (
  SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i FROM (
    SELECT rid, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs)),
grams AS (
  SELECT rid, i, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM words
  WINDOW w AS (PARTITION BY rid ORDER BY i)),
twins AS (
  SELECT rid, i FROM grams WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twins) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM docs),
dups AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
sizes AS (SELECT rid, count(*) AS n, sum(length(word)) AS chars FROM words GROUP BY rid),
base AS (
  SELECT d.*, coalesce(s.n, 0) AS n_words, coalesce(s.chars, 0) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(u.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN sizes s USING (rid) LEFT JOIN dups u USING (rid) LEFT JOIN covered c USING (rid)),
keyed AS (
  SELECT DISTINCT d.host, d.text, lower(trim(l.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))) AS line
  FROM docs d JOIN lines l USING (rid) WHERE d.text IS NOT NULL),
own AS (SELECT * FROM keyed WHERE line <> ''),
known AS (SELECT host, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS n FROM docs GROUP BY host),
common AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS n FROM own GROUP BY ALL) c JOIN known k USING (host)
  WHERE c.n > 10 AND c.n > 0.1 * k.n),
bare AS (
  SELECT o.host, o.text FROM own o LEFT JOIN common c USING (host, line) GROUP BY ALL
  HAVING sum(CASE WHEN c.line IS NULL THEN length(o.line) ELSE 0 END) < 0.3 * sum(length(o.line)))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND x.text IS NULL AS kept
FROM base b LEFT JOIN bare x ON x.host = b.host AND x.text = b.text
"""


@query
def op5_line_index(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_index.drop_frequent_lines(docs, min_docs=10, min_chars=1).drop("text")


ORACLE["op5_line_index"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
lines AS (
  SELECT rid, unnest(l) AS line, unnest(range(len(l))) AS i FROM (SELECT rid, string_split(body, chr(10)) AS l FROM docs)),
keyed AS (
  SELECT *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10),
kept AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n FROM keyed
  WHERE k NOT IN (SELECT k FROM frequent) GROUP BY rid),
sizes AS (SELECT rid, count(*) AS n FROM lines GROUP BY rid)
SELECT d.doc_id, s.n AS n_lines, s.n - coalesce(k.n, 0) AS n_dropped, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d JOIN sizes s USING (rid) LEFT JOIN kept k USING (rid)
"""


@query
def op3_warc_zst(spark, folder):
    archives, listed = warc_zst.write_archives(table(spark, folder, "pages"), min_bytes=0)
    records = warc_zst.read_archives(spark, archives, listed, payloads=False)
    return records.select(
        warc_zst.page_number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_zst.page_number("refers_to_id").alias("refers_to"),
        "error",
    )


@query
def op8_id_blocks(spark, folder):
    encoder = id_blocks.TokenizerFile(spark, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return id_blocks.read(spark, *id_blocks.write(docs, encoder))


@query
def op10_chunked_bpe(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    codec = chunked_bpe.Codec(spark, path, public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chunked_bpe.encode(docs, codec, digests=True).drop("text")


@query
def op7_ppm_language(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 3) == 1)
    model = ppm_language.train(docs.filter(~F.col("held_out")).select("text", "lang"))
    return ppm_language.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op1_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 4) == 2)
    labels = table(spark, folder, "labels").filter(fold("doc_id", 4) != 2)
    model = toxicity.train(docs.filter(~F.col("held_out")), labels, corpus=docs)
    return toxicity.score(docs, model)


@query
def op9_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "words", "weight", "probability", "sampled")


@query
def op6_bag_minhash(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bag_minhash.near_duplicates(docs).drop("__key")


@query
def op2_nn_descent(spark, folder):
    return nn_descent.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def _planted(doc_id, text):
    """The text; where the CRC-32 of the id ends in 0, with its last words replaced by a period of some of them."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))

    def repeat(words):
        n, g = F.size(words).cast("long"), F.call_function("div", crc, F.lit(10))
        first = g % n
        period = F.call_function("div", n - first, 3 + g % 8) + 1
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        origin = let(first, lambda a: let(period, lambda p: F.transform(place, lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))))
        return F.array_join(F.transform(origin, lambda i: F.get(words, i.cast("int"))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return F.when(crc % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(text))).otherwise(text)


@query
def op11_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period, r.period.alias("q"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.q").alias("period"),
        F.expr("1000 * longest.length div longest.q").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_cap_filters(spark, folder):
    found = cap_filters.near_vectors(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query
def op13_phrases(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


ORACLE["op13_phrases"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
sized AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS size FROM placed),
counts AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f FROM sized GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
         (CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
lengths AS (SELECT *, unnest(range(2, size)) AS length FROM candidates),
starts AS (SELECT *, unnest(range(1, size - length + 2)) AS start FROM lengths),
longer AS (
  SELECT lang, array_to_string(w[start:start + length - 1], ' ') AS phrase, max(f) AS f FROM starts GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer x USING (lang, phrase)
  WHERE NOT coalesce(CAST(100 AS HUGEINT) * x.f >= CAST(80 AS HUGEINT) * s.a, FALSE)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
