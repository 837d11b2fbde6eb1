"""Thin queries over the fixture tables, one per operator, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.llm import bpe, decontaminate, fingerprints, language, line_dedup, ngram_join, periodic_runs, phrases, quality_rules, suffix_dedup, token_counts, token_store, toxicity
from sparklab.llm.common import documents, scratch, text_or_empty

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn=None, *, sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql.strip()
        return f

    return put(fn) if fn else put


def fold(modulus: int):
    """crc32 of the document id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits: a deletion in the first quarter, an insertion of
    the text's own first characters in the middle, and a replacement near the end."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("text", text_or_empty())
    n = F.length("text")
    edits = F.array(
        F.struct((n / 4).cast("int").alias("start"), F.lit(20).alias("length"), F.lit("").alias("replacement")),
        F.struct((n / 2).cast("int").alias("start"), F.lit(0).alias("length"), F.substring("text", 1, 30).alias("replacement")),
        F.struct((n - 15).alias("start"), F.lit(12).alias("length"), F.lit(" it's 42!\n").alias("replacement")),
    )
    state = token_counts.build(docs, path).withColumn("edits", edits.cast(token_counts.EDIT))
    done = token_counts.apply_edits(state, path)
    return done.select("doc_id", "n_tokens", "edited_tokens", "n_reencoded", F.length("text").alias("edited_chars"), F.sha2("text", 256).alias("edited_sha256"))


@query
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to a token-id file and read back from it."""
    folder = scratch(spark, "token-ids")
    token_store.write(documents(spark, sf_dir, "doc_id", "text"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read(spark, folder).drop("ids")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 100-byte strings that start earlier."""
    return suffix_dedup.dedup(documents(spark, sf_dir, "doc_id", "text")).drop("kept", "kept_text")


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likeness and that to the next document."""
    return fingerprints.against_next(documents(spark, sf_dir, "doc_id", "text"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(documents(spark, sf_dir, "doc_id", "text"), path)
    done = bpe.decode(ids, path)
    return done.select("doc_id", bpe.n_ids().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of four fifths of the documents train."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = documents(spark, sf_dir, "doc_id", "quality", table="labels").where(fold(5) != 0)
    ensemble = quality_rules.fit(docs, labels, "quality")
    scored = quality_rules.score(docs, ensemble)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of two thirds of the documents train."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = toxicity.chosen(documents(spark, sf_dir, "doc_id", "toxic", table="labels").where(fold(3) != 1))
    model = toxicity.train(docs.join(F.broadcast(labels), "doc_id"), corpus=docs)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are at least 0.9 similar."""
    return ngram_join.linked(documents(spark, sf_dir, "doc_id", "text"), words=3, percent=90)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of documents near a benchmark item."""
    return decontaminate.hits(documents(spark, sf_dir, "doc_id", "text"), documents(spark, sf_dir, "item_id", "text", table="benchmark"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; three quarters of the documents train."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    filters = language.train(docs.where(fold(4) != 2))
    return language.predict(docs.select("doc_id", "text", (fold(4) == 2).alias("held_out")), filters).drop("text")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document; in a tenth of them the words from one on are first made to repeat."""
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("words", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.size("words")
    at = docs.select("doc_id", "text", "words", ((h % 10 == 0) & (n > 0)).alias("made"), F.floor(h / 10).alias("g"), n.alias("n"))
    at = at.withColumn("a", F.when(F.col("made"), F.col("g") % F.col("n")))
    at = at.withColumn("p", F.when(F.col("made"), 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    word = lambda w, i: F.when(i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w)
    made = at.select("doc_id", F.when(F.col("made"), F.array_join(F.transform("words", word), " ")).otherwise(F.col("text")).alias("text"))
    done = periodic_runs.find(made)
    return done.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(periodic_runs.runs_text(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query(
    sql="""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, i, parts[i] AS line,
         translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut, unnest(range(1, len(parts) + 1)) AS t(i)),
many AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, i, line, coalesce(doc_id <> keeper, false) AS gone FROM lines LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that five documents or more hold, but for the largest id among them."""
    done = line_dedup.dedup(documents(spark, sf_dir, "doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    sql="""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
found AS (
  SELECT lang, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS phrase, w[i] AS first, w[i:i + size - 2] AS head, w[i + 1:i + size - 1] AS tail, w[i + size - 1] AS last
  FROM listed, unnest([1, 2, 3]) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i)),
f AS (
  SELECT lang, size, phrase, any_value(first) AS first, any_value(list_aggregate(head, 'string_agg', ' ')) AS head, any_value(list_aggregate(tail, 'string_agg', ' ')) AS tail,
         any_value(last) AS last, count(*) AS a
  FROM found GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
many AS (SELECT * FROM f WHERE size > 1 AND a >= 10),
cuts AS (
  SELECT m.lang, m.size, m.phrase, m.a, 1 AS k, x.a AS l, y.a AS r
  FROM many m JOIN f x ON x.lang = m.lang AND x.size = 1 AND x.phrase = m.first JOIN f y ON y.lang = m.lang AND y.size = m.size - 1 AND y.phrase = m.tail
  UNION ALL
  SELECT m.lang, m.size, m.phrase, m.a, 2, x.a, y.a
  FROM many m JOIN f x ON x.lang = m.lang AND x.size = 2 AND x.phrase = m.head JOIN f y ON y.lang = m.lang AND y.size = 1 AND y.phrase = m.last
  WHERE m.size = 3),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, size ORDER BY score, k) = 1),
longer AS (
  SELECT lang, part, max(a) AS a FROM (SELECT lang, head AS part, a FROM many WHERE size = 3 UNION ALL SELECT lang, tail, a FROM many WHERE size = 3) GROUP BY lang, part),
kept AS (SELECT w.* FROM worst w LEFT JOIN longer g ON w.size = 2 AND g.lang = w.lang AND g.part = w.phrase WHERE g.a IS NULL OR 100 * g.a < 50 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of two and three words of each language."""
    return phrases.collocations(documents(spark, sf_dir, "text", "lang"))
