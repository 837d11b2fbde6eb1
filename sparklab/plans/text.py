"""Text, document, vector and sensitive-data queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import privacy as pv
from sparklab.operators import text as tx
from sparklab.operators import vectorindex
from sparklab.plans.fixtures import md5num_sql, with_sql
from sparklab.plans.registry import query
from sparklab.session import ensure_checkpoint_dir
from sparklab.sources.tables import Tables

POS_SQL = "[" + ", ".join(f"'{w}'" for w in tx.POSITIVE_WORDS) + "]"
NEG_SQL = "[" + ", ".join(f"'{w}'" for w in tx.NEGATIVE_WORDS) + "]"
WORDS_SQL = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}]+'), lambda w: w != '')"


def words_sql(x: str) -> str:
    return WORDS_SQL.format(x=x)


SENT_SQL = f"""sent AS (
  SELECT doc_id, text,
         len(list_filter({words_sql('text')}, lambda w: list_contains({POS_SQL}, w))) AS npos,
         len(list_filter({words_sql('text')}, lambda w: list_contains({NEG_SQL}, w))) AS nneg
  FROM documents),
scored AS (
  SELECT doc_id, CASE WHEN npos > nneg THEN 'POSITIVE' WHEN nneg > npos THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment,
         CASE WHEN npos + nneg > 0 THEN round(abs(npos - nneg) / (npos + nneg), 3) ELSE 0.5 END AS confidence,
         '' AS status
  FROM sent)"""


def lexicon_scored(t):
    s = tx.lexicon_sentiment_columns(t.documents, "text", ["doc_id"])
    return s.withColumn("status", F.lit(""))


@query("score_table")
def q_score_table(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "lang", "text")
    prompt = F.concat(F.lit("Classify the sentiment of this text.\nText: "), F.col("text"))
    return tx.score_table(d, prompt, tx.LexiconScorer,
                          "sentiment STRING, confidence DOUBLE, themes ARRAY<STRING>, actionable_issue STRING",
                          keep=["doc_id", "lang"])


@query("score_audit", sql=with_sql(SENT_SQL, """
SELECT CAST(count(*) AS BIGINT) AS rows_scored, CAST(count_if(status != '') AS BIGINT) AS failed_rows,
       CAST(count_if(sentiment IS NULL) AS BIGINT) AS null_label, CAST(count(DISTINCT sentiment) AS BIGINT) AS distinct_labels,
       string_agg(DISTINCT sentiment, ',' ORDER BY sentiment) AS labels FROM scored"""))
def q_score_audit(spark, sf):
    return tx.score_audit(lexicon_scored(Tables(spark, sf)))


@query("score_retry")
def q_score_retry(spark, sf):
    """First pass with a scorer that fails on some rows, then re-score only the
    failed rows and merge them back."""
    from sparklab.operators.windows import merge_repair
    d = Tables(spark, sf).documents.select("doc_id", "text")
    schema = "sentiment STRING, confidence DOUBLE, themes ARRAY<STRING>, actionable_issue STRING"
    first = tx.score_table(d, F.col("text"), FlakyScorer(), schema, keep=["doc_id"])
    failed = first.where(F.col("status") != "").select("doc_id").join(d, "doc_id")
    second = tx.score_table(failed, F.col("text"), tx.LexiconScorer(), schema, keep=["doc_id"])
    fixed = merge_repair(first, second.where(F.col("status") == ""), "doc_id", F.col("status") != "",
                         ["sentiment", "confidence", "themes", "actionable_issue", "status"])
    return fixed


class FlakyScorer(tx.LexiconScorer):
    """Fails on texts whose length is a multiple of 7 (a deterministic outage)."""

    def __call__(self, prompts):
        if any(len(str(p)) % 7 == 0 for p in prompts):
            if len(prompts) > 1:
                raise RuntimeError("batch rejected")
            raise RuntimeError("quota exceeded")
        return super().__call__(prompts)


@query("sentiment_score_magnitude", sql=rf"""
WITH s AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?\n]+')) AS sentence FROM documents),
w AS (SELECT doc_id, {words_sql('sentence')} AS ws FROM s WHERE trim(sentence) != ''),
c AS (SELECT doc_id, len(list_filter(ws, lambda x: list_contains({POS_SQL}, x))) AS p,
             len(list_filter(ws, lambda x: list_contains({NEG_SQL}, x))) AS n FROM w),
per AS (SELECT doc_id, CASE WHEN p + n > 0 THEN (p - n) / (p + n) ELSE 0.0 END AS s FROM c),
g AS (SELECT doc_id, avg(s) AS score, sum(abs(s)) AS magnitude FROM per GROUP BY doc_id)
SELECT doc_id, score, magnitude,
       CASE WHEN abs(score) < 0.25 THEN CASE WHEN magnitude >= 2 THEN 'mixed' ELSE 'neutral' END
            WHEN score > 0 THEN 'positive' ELSE 'negative' END AS kind FROM g""")
def q_sentiment_score_magnitude(spark, sf):
    return tx.sentiment_score_magnitude(Tables(spark, sf).documents, "doc_id", "text")


@query("confident_disagreements", sql=with_sql(SENT_SQL, """
SELECT s.doc_id, s.sentiment, s.confidence, l.quality FROM scored s JOIN labels l ON l.doc_id = s.doc_id
WHERE (s.sentiment = 'NEGATIVE' AND l.quality = 1) OR (s.sentiment = 'POSITIVE' AND l.quality = 0)
   OR (s.sentiment = 'NEUTRAL' AND l.toxic = 1)
ORDER BY s.confidence DESC, s.doc_id LIMIT 20"""))
def q_confident_disagreements(spark, sf):
    t = Tables(spark, sf)
    j = lexicon_scored(t).join(t.labels, "doc_id")
    cond = (((F.col("sentiment") == "NEGATIVE") & (F.col("quality") == 1)) |
            ((F.col("sentiment") == "POSITIVE") & (F.col("quality") == 0)) |
            ((F.col("sentiment") == "NEUTRAL") & (F.col("toxic") == 1)))
    return j.where(cond).orderBy(F.desc("confidence"), "doc_id").limit(20).select(
        "doc_id", "sentiment", "confidence", "quality")


@query("aggregate_prompt", sql=rf"""
WITH w AS (SELECT unnest({words_sql('d.text')}) AS word FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 0),
top AS (SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 60)
SELECT 'These are frequent words in low-quality documents, with counts. Group them into at most 8 issues.' || chr(10)
       || string_agg(printf('%s (%d)', word, n), '; ' ORDER BY n DESC, word) AS prompt FROM top""")
def q_aggregate_prompt(spark, sf):
    t = Tables(spark, sf)
    low = t.documents.join(t.labels.where(F.col("quality") == 0).select("doc_id"), "doc_id")
    w = low.select(F.explode(tx.words("text")).alias("word"))
    top = w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(60)
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("word"), F.col("n"))))
    head = "These are frequent words in low-quality documents, with counts. Group them into at most 8 issues.\n"
    return top.agg(F.concat(F.lit(head), F.array_join(F.transform(
        items, lambda s: F.format_string("%s (%d)", s["word"], s["n"])), "; ")).alias("prompt"))


def _titles(t):
    """A file per part and the title a scorer read from it: nothing, the whole name, its first word, or the brand."""
    p = t.part
    turn = F.pmod(md5num("p_partkey"), F.lit(4)).cast("int")
    read = F.element_at(F.array(F.lit(""), F.col("p_name"), F.substring_index("p_name", " ", 1), F.col("p_brand")), turn + 1)
    return p.select("p_partkey", F.concat(F.translate("p_name", " ", "_"), F.lit(".jpg")).alias("file_name"), read.alias("title"))


TITLES_SQL = f"""titles AS (
  SELECT p_partkey, replace(p_name, ' ', '_') || '.jpg' AS file_name,
         (['', p_name, split_part(p_name, ' ', 1), p_brand])[1 + ({md5num_sql('p_partkey')}) % 4] AS title FROM part),
split_up AS (
  SELECT *, list_filter(regexp_split_to_array(lower(split_part(file_name, '.', 1)), '[^a-z0-9]+'), lambda w: w <> '') AS own,
         list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda w: w <> '') AS told FROM titles),
judged AS (
  SELECT *, len(list_filter(told, lambda w: list_contains(own, w))) AS hits,
         CASE WHEN len(told) = 0 THEN 'abstained' WHEN told = own THEN 'exact' WHEN list_has_all(own, told) OR list_has_all(told, own) THEN 'partial' ELSE 'mismatch' END AS verdict
  FROM split_up)"""


@query("title_match_verdict", sql=with_sql(TITLES_SQL, """
SELECT p_partkey, file_name, title, CAST(hits AS INTEGER) AS hits, verdict FROM judged"""))
def q_title_match_verdict(spark, sf):
    """A read title against the file's name, word by word."""
    return tx.title_verdict(_titles(Tables(spark, sf)), "file_name", "title").select("p_partkey", "file_name", "title", "hits", "verdict")


@query("title_match_summary", sql=with_sql(TITLES_SQL, """
SELECT verdict, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM judged GROUP BY verdict"""))
def q_title_match_summary(spark, sf):
    v = tx.title_verdict(_titles(Tables(spark, sf)), "file_name", "title").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
    whole = v.agg(F.sum("n").alias("whole"))
    return v.crossJoin(whole).select("verdict", "n", F.round(F.col("n") / F.col("whole"), 4).alias("share"))  # one row per verdict


@query("label_explode_summary", sql=rf"""
WITH raw AS (SELECT doc_id, to_json({{'label_annotations': list_transform(({words_sql('text')})[1:3],
                     lambda w: {{'description': w, 'score': length(w) / 20.0}})}}) AS j FROM documents),
lab AS (SELECT doc_id, json_extract_string(item, '$.description') AS label,
               CAST(json_extract_string(item, '$.score') AS DOUBLE) AS score
        FROM raw, unnest(from_json(json_extract(j, '$.label_annotations'), '["JSON"]')) AS t(item))
SELECT label, CAST(count(*) AS BIGINT) AS images, round(avg(score), 3) AS avg_score FROM lab
GROUP BY label ORDER BY images DESC, label LIMIT 15""")
def q_label_explode_summary(spark, sf):
    d = Tables(spark, sf).documents
    ann = F.transform(F.slice(tx.words("text"), 1, 3),
                      lambda w: F.struct(w.alias("description"), (F.length(w) / 20.0).alias("score")))
    raw = d.select("doc_id", F.to_json(F.struct(ann.alias("label_annotations"))).alias("j"))
    items = raw.select("doc_id", F.explode(F.from_json(F.get_json_object("j", "$.label_annotations"),
                                                       "array<string>")).alias("item"))
    lab = items.select(F.get_json_object("item", "$.description").alias("label"),
                       F.get_json_object("item", "$.score").cast("double").alias("score"))
    return (lab.groupBy("label").agg(F.count(F.lit(1)).alias("images"), F.round(F.avg("score"), 3).alias("avg_score"))
               .orderBy(F.desc("images"), "label").limit(15))


@query("cost_counts", sql="""
SELECT (SELECT count(*) FROM pages) AS images, (SELECT count(*) FROM documents) AS scoring_calls,
       (SELECT count(*) FROM labels) AS label_rows, (SELECT count(*) FROM embeddings) AS embedding_calls""")
def q_cost_counts(spark, sf):
    from sparklab.operators.joins import scalar_counts
    t = Tables(spark, sf)
    return scalar_counts({"images": t.pages, "scoring_calls": t.documents, "label_rows": t.labels,
                          "embedding_calls": t.embeddings})


@query("embedding_dims", sql="""
SELECT CAST(len(embedding) AS INTEGER) AS dims, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY 1""")
def q_embedding_dims(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))


@query("embed_table")
def q_embed_table(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array
    d = Tables(spark, sf).documents.select("doc_id", tx.words("text").alias("tokens"))
    m = Pipeline(stages=[HashingTF(inputCol="tokens", outputCol="tf", numFeatures=256),
                         IDF(inputCol="tf", outputCol="vec")]).fit(d)
    return m.transform(d).select("doc_id", vector_to_array("vec", "float32").alias("embedding"))


CENTROID_SQL = """e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
c AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS m FROM e GROUP BY 1, 2),
q AS (SELECT label AS query_id, list(m ORDER BY dim) AS qv FROM c GROUP BY 1)"""

DIST_SQL = ("sqrt(list_sum(list_transform(list_zip(b.embedding, q.qv), "
            "lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))))")


@query("vector_search", sql=with_sql(CENTROID_SQL, f""",
d AS (SELECT q.query_id, b.vec_id AS base_id, b.label, {DIST_SQL} AS distance FROM embeddings b, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, base_id) AS rank FROM d)
SELECT query_id, base_id, label, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""))
def q_vector_search(spark, sf):
    """Top-5 nearest vectors to each label centroid (queries derived from the table)."""
    e = Tables(spark, sf).embeddings
    q = tx.centroids_by(e, "label", "embedding")
    r = tx.vector_search(e, "vec_id", "embedding", q, "label", "centroid", k=5, base_cols=["label"])
    return r.withColumn("distance", F.round("distance", 6))


def vector_index(spark, sf):
    """The index of all embeddings in a new shared folder: 16 cells, 8 bytes a code."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vector-index-{uuid.uuid4().hex}"
    vectorindex.build(Tables(spark, sf).embeddings, "vec_id", "embedding", folder, n_cells=16, parts=8, words=64, carry=("label",))
    return vectorindex.Index(spark, folder)


@query("vector_search_ann")
def q_vector_search_ann(spark, sf):
    """Approximate variant of ``vector_search``: inverted cells with quantised residuals, exact re-rank.  The fixture's
    vectors are nearly uniformly spread, so 12 of 16 cells are probed for a recall above 0.9."""
    q = tx.centroids_by(Tables(spark, sf).embeddings, "label", "embedding")
    return vector_index(spark, sf).search(q, "label", "centroid", k=5, probes=12).withColumn("distance", F.round("distance", 6))


@query("vector_index_recall")
def q_vector_index_recall(spark, sf):
    """Ten nearest of every fiftieth vector among all, against exact search: recall and the pairs looked up, by probes."""
    e = Tables(spark, sf).embeddings
    q = e.where(F.col("vec_id") % 50 == 0).select("vec_id", "embedding")
    index = vector_index(spark, sf)
    exact = tx.vector_search(e, "vec_id", "embedding", q, "vec_id", "embedding", k=10).select("query_id", "base_id", F.lit(1).alias("hit"))
    out = None
    for probes in (4, 8, 12):
        found = index.search(q, "vec_id", "embedding", k=10, probes=probes).select("query_id", "base_id", F.lit(1).alias("found"))
        row = exact.join(found, ["query_id", "base_id"], "left").agg((F.count("found") / F.count("hit")).alias("recall"))
        row = row.crossJoin(index.workload(q, "vec_id", "embedding", probes)).withColumn("probes", F.lit(probes))  # one row each
        out = row if out is None else out.unionByName(row)
    return out


@query("nearest_examples", sql=with_sql(CENTROID_SQL, f""",
d AS (SELECT q.query_id, b.vec_id AS base_id, {DIST_SQL} AS distance FROM embeddings b, q WHERE b.label = q.query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, base_id) AS rank FROM d)
SELECT query_id, base_id, round(distance, 6) AS distance FROM r WHERE rank <= 3"""))
def q_nearest_examples(spark, sf):
    """Example-based explanation: the training rows of a class nearest to its prototype."""
    e = Tables(spark, sf).embeddings
    q = tx.centroids_by(e, "label", "embedding")
    r = e.select("vec_id", "embedding", "label").join(q, "label").select(
        F.col("label").alias("query_id"), F.col("vec_id").alias("base_id"),
        tx.euclidean(F.col("embedding"), F.col("centroid")).alias("distance"))
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy("distance", "base_id")
    return (r.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= 3)
             .select("query_id", "base_id", F.round("distance", 6).alias("distance")))


@query("counterfactual_nearest", sql=with_sql(CENTROID_SQL, f""",
d AS (SELECT q.query_id, b.vec_id AS base_id, b.label, {DIST_SQL} AS distance FROM embeddings b, q WHERE b.label <> q.query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, base_id) AS rank FROM d)
SELECT query_id, base_id, label, round(distance, 6) AS distance FROM r WHERE rank = 1"""))
def q_counterfactual_nearest(spark, sf):
    """For each class prototype, the most similar row with a different class."""
    e = Tables(spark, sf).embeddings
    q = tx.centroids_by(e, "label", "embedding").withColumnRenamed("label", "qlabel")
    b = e.select("vec_id", "embedding", "label")
    j = b.crossJoin(F.broadcast(q)).where(F.col("label") != F.col("qlabel"))  # queries: one row per class
    j = j.withColumn("distance", tx.euclidean(F.col("embedding"), F.col("centroid")))
    from pyspark.sql import Window
    w = Window.partitionBy("qlabel").orderBy("distance", "vec_id")
    return (j.withColumn("rk", F.row_number().over(w)).where(F.col("rk") == 1)
             .select(F.col("qlabel").alias("query_id"), F.col("vec_id").alias("base_id"), "label",
                     F.round("distance", 6).alias("distance")))


@query("chunk_documents", sql="""
SELECT doc_id, CAST(start // 768 AS INTEGER) AS chunk_index, CAST(start AS INTEGER) AS start,
       substring(text, start + 1, 1024) AS chunk
FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 256 - 1, 0), 768)) AS start FROM documents)""")
def q_chunk_documents(spark, sf):
    return tx.chunk_documents(Tables(spark, sf).documents, "doc_id", "text", 1024, 256)


@query("chunk_with_headings")
def q_chunk_with_headings(spark, sf):
    return tx.chunk_with_headings(Tables(spark, sf).pages, "page_id", "html")


@query("catalog_rank", sql="""
WITH rev AS (SELECT l_partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1),
tot AS (SELECT sum(revenue) AS total FROM rev),
m AS (SELECT p.p_partkey, p.p_name,
             CAST(list_contains(string_split(lower(p.p_name), ' '), 'blue') AS INTEGER)
             + CAST(list_contains(string_split(lower(p.p_name), ' '), 'widget') AS INTEGER) AS match_score,
             coalesce(r.revenue, 0.0) / tot.total AS revenue_share
      FROM part p LEFT JOIN rev r ON r.l_partkey = p.p_partkey, tot)
SELECT p_partkey, p_name, match_score, round(revenue_share, 8) AS revenue_share,
       round(match_score + revenue_share, 8) AS rank_score
FROM m WHERE match_score > 0 ORDER BY rank_score DESC, p_partkey LIMIT 10""")
def q_catalog_rank(spark, sf):
    t = Tables(spark, sf)
    rev = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    tot = rev.agg(F.sum("revenue").alias("total"))
    toks = F.split(F.lower("p_name"), " ")
    ms = F.array_contains(toks, "blue").cast("int") + F.array_contains(toks, "widget").cast("int")
    m = (t.part.select("p_partkey", "p_name", ms.alias("match_score")).where(F.col("match_score") > 0)
          .join(rev, F.col("l_partkey") == F.col("p_partkey"), "left").crossJoin(F.broadcast(tot))
          .withColumn("revenue_share", F.coalesce("revenue", F.lit(0.0)) / F.col("total")))
    return (m.select("p_partkey", "p_name", "match_score", F.round("revenue_share", 8).alias("revenue_share"),
                     F.round(F.col("match_score") + F.col("revenue_share"), 8).alias("rank_score"))
             .orderBy(F.desc("rank_score"), "p_partkey").limit(10))


@query("sft_dataset", sql=f"""
SELECT conv_id,
       CAST(to_json({{'contents': list({{'role': CASE WHEN role = 'assistant' THEN 'model' ELSE role END,
                                        'parts': [{{'text': text}}]}} ORDER BY turn)}}) AS VARCHAR) AS example,
       ({md5num_sql('conv_id')}) % 100 < 10 AS is_holdout, CAST(count(*) AS INTEGER) AS n_turns
FROM conversations GROUP BY conv_id""")
def q_sft_dataset(spark, sf):
    return tx.sft_dataset(Tables(spark, sf).conversations)


@query("sft_size_report", sql="""
SELECT is_holdout, CAST(count(*) AS BIGINT) AS examples, CAST(sum(n_turns) AS BIGINT) AS turns FROM (
  SELECT conv_id, (('0x' || substr(md5(CAST(conv_id AS VARCHAR)), 1, 15))::BIGINT) % 100 < 10 AS is_holdout,
         count(*) AS n_turns FROM conversations GROUP BY conv_id) GROUP BY is_holdout""")
def q_sft_size_report(spark, sf):
    s = tx.sft_dataset(Tables(spark, sf).conversations)
    return s.groupBy("is_holdout").agg(F.count(F.lit(1)).alias("examples"), F.sum("n_turns").cast("bigint").alias("turns"))


@query("eval_set_isolation", sql=rf"""
WITH bw AS (SELECT item_id, {words_sql('text')} AS ws FROM benchmark),
bs AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 7], ' ') AS sh FROM bw, LATERAL (SELECT unnest(generate_series(1, len(ws) - 7)) AS i)),
dw AS (SELECT doc_id, {words_sql('text')} AS ws FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 7], ' ') AS sh FROM dw, LATERAL (SELECT unnest(generate_series(1, len(ws) - 7)) AS i)),
hits AS (SELECT bs.item_id, count(DISTINCT ds.doc_id) AS n FROM bs JOIN ds ON bs.sh = ds.sh GROUP BY 1)
SELECT b.item_id, CAST(coalesce(h.n, 0) AS BIGINT) AS contaminated_docs FROM benchmark b LEFT JOIN hits h ON h.item_id = b.item_id""")
def q_eval_set_isolation(spark, sf):
    t = Tables(spark, sf)
    return tx.eval_set_isolation(t.benchmark, "item_id", "text", t.documents, "doc_id", "text", 8)


# ------------------------------------------------------------------ sensitive data ---

def _det_sql_array():
    parts = []
    for t, p, lk in pv.DETECTORS:
        ps = p.replace("'", "''")
        parts.append(f"list_transform(regexp_extract_all(text, '{ps}'), lambda m: {{'info_type': '{t}', 'quote': m, "
                     f"'likelihood': '{lk}'}})")
    return "list_concat(" + ", ".join(parts) + ")" if len(parts) > 1 else parts[0]


def _luhn_sql(q: str) -> str:
    """Likelihood of a card quote: LIKELY when its digits pass the Luhn check."""
    dg = f"regexp_replace({q}, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({dg}, length({dg}) - i, 1) AS INTEGER)"
    s = (f"list_sum(list_transform(range(0, length({dg})), lambda i: CASE WHEN i % 2 = 1 THEN "
         f"(CASE WHEN 2 * {digit} > 9 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) ELSE {digit} END))")
    return f"CASE WHEN length({dg}) >= 12 AND {s} % 10 = 0 THEN 'LIKELY' ELSE 'POSSIBLE' END"


FINDINGS_SQL = f"""raw AS (SELECT doc_id, lang, source, text, unnest({_det_sql_array()}) AS f FROM documents),
findings AS (SELECT doc_id, lang, source, text, f.info_type AS info_type, f.quote AS quote,
                    CASE WHEN f.info_type = 'CREDIT_CARD_NUMBER' THEN {_luhn_sql('f.quote')} ELSE f.likelihood END AS likelihood
             FROM raw)"""


@query("inspect_infotypes", sql=with_sql(FINDINGS_SQL, """
SELECT doc_id, info_type, quote, likelihood FROM findings"""))
def q_inspect_infotypes(spark, sf):
    """All findings of all detectors; a card is LIKELY when its digits pass the Luhn check."""
    return pv.inspect_infotypes(Tables(spark, sf).documents, "doc_id", "text")


@query("inspect_cards", sql=with_sql(FINDINGS_SQL, """
SELECT doc_id, lang, source, info_type, quote, likelihood FROM findings WHERE info_type = 'CREDIT_CARD_NUMBER'"""))
def q_inspect_cards(spark, sf):
    """Card findings with identifying fields; LIKELY when the digits pass Luhn."""
    f = pv.inspect_infotypes(Tables(spark, sf).documents, "doc_id", "text", id_fields=["lang", "source"])
    return f.where(F.col("info_type") == "CREDIT_CARD_NUMBER")


LEVELS_SQL = "[" + ", ".join(f"'{x}'" for x in pv.LIKELIHOOD_ORDER) + "]"


def _offsets_sql() -> str:
    """Findings with the 0-based start of each match: the lengths of the pieces and matches before it."""
    parts = []
    for t, p, lk in pv.DETECTORS:
        ps = p.replace("'", "''")
        parts.append(f"SELECT doc_id, text, '{t}' AS info_type, '{lk}' AS lk, regexp_extract_all(text, '{ps}') AS m, "
                     f"string_split_regex(text, '{ps}') AS s FROM documents")
    return f"""matched AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matched),
found AS (SELECT doc_id, text, info_type, m[i] AS quote, lk,
                 list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
          FROM placed),
findings AS (SELECT doc_id, text, info_type, quote, CAST(start AS INTEGER) AS start,
                    CASE WHEN info_type = 'CREDIT_CARD_NUMBER' THEN {_luhn_sql('quote')} ELSE lk END AS likelihood FROM found)"""


@query("inspect_rules", sql=with_sql(_offsets_sql(), f""",
c AS (SELECT *, lower(substring(text, greatest(start + 1 - 30, 1), least(start, 30))) AS ctx,
             list_position({LEVELS_SQL}, likelihood) AS lvl FROM findings),
h AS (SELECT *, CASE WHEN info_type = 'CREDIT_CARD_NUMBER' AND (contains(ctx, 'card') OR contains(ctx, 'visa'))
                     THEN least(lvl + 1, {len(pv.LIKELIHOOD_ORDER)}) ELSE lvl END AS lvl2 FROM c)
SELECT doc_id, info_type, quote, start, {LEVELS_SQL}[lvl2] AS likelihood FROM h
WHERE NOT (info_type = 'IP_ADDRESS' AND regexp_matches(quote, '^(10|127)\\.')) AND lvl2 >= 3"""))
def q_inspect_rules(spark, sf):
    d = Tables(spark, sf).documents
    f = pv.inspect_infotypes(d, "doc_id", "text", with_offsets=True)
    return pv.apply_rules(f, d, "doc_id", "text", hotwords={"CREDIT_CARD_NUMBER": ["card", "visa"]},
                          exclusions={"IP_ADDRESS": r"^(10|127)\."}, min_likelihood="POSSIBLE")


def _sensitivity_sql():
    parts = []
    for table, cols in (("documents", ["text"]), ("pages", ["url", "html"]), ("conversations", ["text"])):
        for c in cols:
            for t, p, _ in pv.DETECTORS:
                ps = p.replace("'", "''")
                parts.append(f"SELECT '{c}' AS column_name, '{t}' AS info_type, "
                             f"avg(CAST(regexp_matches({c}, '{ps}') AS INTEGER)) AS share, '{table}' AS table_name FROM {table}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE share > 0"


@query("profile_sensitivity", sql=_sensitivity_sql())
def q_profile_sensitivity(spark, sf):
    t = Tables(spark, sf)
    return (pv.profile_sensitivity(t.documents, "documents", ["text"])
              .unionByName(pv.profile_sensitivity(t.pages, "pages", ["url", "html"]))
              .unionByName(pv.profile_sensitivity(t.conversations, "conversations", ["text"])))


def _sql_replace(x: str, repl_fn) -> str:
    for t, p, _ in pv.DETECTORS:
        x = f"regexp_replace({x}, '{p.replace(chr(39), chr(39) * 2)}', '{repl_fn(t)}', 'g')"
    return x


@query("deid_replace", sql=f"SELECT doc_id, md5({_sql_replace('text', lambda t: '[' + t + ']')}) AS text_md5 FROM documents")
def q_deid_replace(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.md5(pv.replace_with_type("text")).alias("text_md5"))


@query("deid_redact", sql=f"SELECT doc_id, CAST(length({_sql_replace('text', lambda t: '')}) AS INTEGER) AS redacted_length FROM documents")
def q_deid_redact(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.length(pv.redact("text")).alias("redacted_length"))


@query("deid_mask", sql=f"""
SELECT doc_id, m FROM (SELECT doc_id, unnest(regexp_extract_all(
  regexp_replace(text, '{pv.CARD_MASK_PATTERN}', '****-****-****-\\1', 'g'), '\\*{{4}}-\\*{{4}}-\\*{{4}}-[0-9]{{4}}')) AS m FROM documents)""")
def q_deid_mask(spark, sf):
    d = Tables(spark, sf).documents
    masked = pv.mask_cards("text")
    return d.select("doc_id", F.explode(F.regexp_extract_all(masked, F.lit(r"\*{4}-\*{4}-\*{4}-[0-9]{4}"), 0)).alias("m"))


@query("deid_hash", sql="SELECT c_custkey, sha256('k3y' || c_name) AS c_name_hash FROM customer")
def q_deid_hash(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", pv.hash_value("c_name", "k3y").alias("c_name_hash"))


@query("deid_deterministic")
def q_deid_deterministic(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    key = "0123456789abcdef"
    e = c.select("c_custkey", pv.encrypt_deterministic("c_name", key).alias("c_name_enc"))
    return e.withColumn("c_name_reid", pv.decrypt_deterministic("c_name_enc", key))


@query("deid_bucket", sql="SELECT c_custkey, floor(c_acctbal / 1000.0) * 1000.0 AS c_acctbal_bucket FROM customer")
def q_deid_bucket(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", pv.bucket_value("c_acctbal", 1000.0).cast("double").alias("c_acctbal_bucket"))


@query("deid_date_shift", sql=f"""
SELECT o_orderkey, o_custkey,
       CAST(o_orderdate AS DATE) + CAST((({md5num_sql("CAST(o_custkey AS VARCHAR) || 'k3y'")}) % 201) - 100 AS INTEGER) AS shifted_date
FROM orders""")
def q_deid_date_shift(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_custkey", pv.date_shift("o_orderdate", "o_custkey", "k3y", 100).alias("shifted_date"))


@query("deid_time_extract", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders")
def q_deid_time_extract(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", pv.time_extract("o_orderdate").alias("order_month"))


@query("deid_records_vs_text", sql=f"""
SELECT c_custkey AS id, sha256('k3y' || c_name) AS value FROM customer
UNION ALL SELECT doc_id, {_sql_replace('text', lambda t: '[' + t + ']')} FROM documents""")
def q_deid_records_vs_text(spark, sf):
    """Record-level transform of identifier columns and match-level transform of free text."""
    t = Tables(spark, sf)
    rec = pv.deidentify_records(t.customer, {"c_name": lambda c: pv.hash_value(c, "k3y"),
                                             "c_acctbal": lambda c: pv.bucket_value(c, 1000.0)})
    txt = pv.deidentify_text(t.documents.select("doc_id", "text"), "text", "replace")
    return rec.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("value")).unionByName(
        txt.select(F.col("doc_id").alias("id"), F.col("text").alias("value")))
