import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparklab.operators import privacy as pv
from sparklab.operators import text as tx

SCHEMA = "sentiment STRING, confidence DOUBLE, themes ARRAY<STRING>, actionable_issue STRING"


class BadScorer:
    def __call__(self, prompts: pd.Series):
        out = []
        for p in prompts:
            if "raise" in p:
                raise RuntimeError("boom")
            if "badjson" in p:
                out.append("{not json")
            elif "wrongtype" in p:
                out.append(json.dumps({"sentiment": "POSITIVE", "confidence": "high"}))
            else:
                out.append(json.dumps({"sentiment": "NEUTRAL", "confidence": 0.5, "themes": ["x"],
                                       "actionable_issue": "none"}))
        return out


def test_score_table_errors_become_status(spark):
    df = spark.createDataFrame([(1, "fine"), (2, "please raise"), (3, "badjson here"), (4, "wrongtype")],
                               "id int, t string")
    r = {x.id: x for x in tx.score_table(df, F.col("t"), BadScorer(), SCHEMA, keep=["id"]).collect()}
    assert r[1].status == "" and r[1].sentiment == "NEUTRAL"
    assert r[2].status.startswith("error: RuntimeError") and r[2].sentiment is None
    assert r[3].status == "error: invalid JSON"
    assert r[4].status == "error: schema mismatch" and r[4].confidence is None
    audit = tx.score_audit(tx.score_table(df, F.col("t"), BadScorer(), SCHEMA, keep=["id"])).first()
    assert audit.rows_scored == 4 and audit.failed_rows == 3


def test_merge_repair(spark):
    from sparklab.operators.windows import merge_repair
    first = spark.createDataFrame([(1, "A", ""), (2, None, "error")], "id int, v string, status string")
    again = spark.createDataFrame([(2, "B", "")], "id int, v string, status string")
    out = {r.id: r for r in merge_repair(first, again, "id", F.col("status") != "", ["v", "status"]).collect()}
    assert out[1].v == "A" and out[2].v == "B" and out[2].status == ""


@pytest.mark.parametrize("n", [0, 10, 256, 257, 1024, 1025, 1792, 3000])
def test_chunk_boundaries_brute_force(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = [(r.chunk_index, r.start, r.chunk) for r in tx.chunk_documents(df, "id", "t").orderBy("chunk_index").collect()]
    exp, s, i = [], 0, 0
    while True:
        exp.append((i, s, text[s:s + 1024]))
        s += 768
        i += 1
        if s >= max(n - 256, 1):
            break
    assert got == exp


def test_vector_search_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8)).astype("float32")
    q = rng.normal(size=(3, 8)).astype("float32")
    b = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "id int, v array<float>")
    qq = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "qid int, v array<float>")
    got = {(r.query_id, r.rank): r.base_id for r in tx.vector_search(b, "id", "v", qq, "qid", "v", k=4).collect()}
    for qi, vec in enumerate(q):
        d = np.sqrt(((base.astype("float64") - vec.astype("float64")) ** 2).sum(1))
        for rank, idx in enumerate(np.argsort(d, kind="stable")[:4], start=1):
            assert got[(qi, rank)] == idx


def test_eval_set_isolation_brute_force(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, "short text")],
                                  "item_id int, text string")
    docs = spark.createDataFrame([(10, "x one two three four five six seven eight y"), (11, "nothing shared here"),
                                  (12, "Two three four five six seven eight nine!")], "doc_id int, text string")
    r = {x.item_id: x.contaminated_docs for x in tx.eval_set_isolation(items, "item_id", "text", docs, "doc_id", "text", 8).collect()}
    assert r == {1: 2, 2: 0}


def test_sft_dataset_order_and_roles(spark):
    conv = spark.createDataFrame([(1, 1, "assistant", "hi"), (1, 0, "user", "hello"), (2, 0, "user", "q")],
                                 "conv_id long, turn long, role string, text string")
    r = {x.conv_id: json.loads(x.example) for x in tx.sft_dataset(conv, system_text="be brief").collect()}
    assert [m["role"] for m in r[1]["contents"]] == ["user", "model"]
    assert r[1]["systemInstruction"]["parts"][0]["text"] == "be brief"


def test_detectors_and_lookalikes(spark):
    text = ("mail a.b@mail.example.com, tel (555) 123-4567, card 4111 1111 1111 1111, bad 4111 1111 1111 1112, "
            "ip 10.0.0.1, token = \"abcdef0123456789abcdef\" and 12-34 not a phone")
    df = spark.createDataFrame([(1, text)], "id int, t string")
    f = {(r.info_type, r.quote): r.likelihood for r in pv.inspect_infotypes(df, "id", "t").collect()}
    assert ("EMAIL_ADDRESS", "a.b@mail.example.com") in f
    assert ("PHONE_NUMBER", "(555) 123-4567") in f
    assert f[("CREDIT_CARD_NUMBER", "4111 1111 1111 1111")] == "LIKELY"      # passes Luhn
    assert f[("CREDIT_CARD_NUMBER", "4111 1111 1111 1112")] == "POSSIBLE"    # fails Luhn
    assert ("IP_ADDRESS", "10.0.0.1") in f
    assert any(k[0] == "AUTH_TOKEN" for k in f)
    r = pv.apply_rules(pv.inspect_infotypes(df, "id", "t", with_offsets=True), df, "id", "t", exclusions={"IP_ADDRESS": r"^10\."})
    assert not any(x.info_type == "IP_ADDRESS" for x in r.collect())
    red = df.select(pv.replace_with_type("t").alias("x")).first().x
    assert "[EMAIL_ADDRESS]" in red and "a.b@" not in red
    masked = df.select(pv.mask_cards("t").alias("x")).first().x
    assert "****-****-****-1111" in masked


def test_deterministic_encryption_round_trip_and_join(spark):
    df = spark.createDataFrame([(1, "alice"), (2, "bob"), (3, "alice")], "id int, name string")
    key = "0123456789abcdef"
    e = df.select("id", pv.encrypt_deterministic("name", key).alias("enc"))
    rows = {r.id: r.enc for r in e.collect()}
    assert rows[1] == rows[3] != rows[2]  # equal inputs give equal tokens: joins survive
    back = e.select(pv.decrypt_deterministic("enc", key).alias("n")).collect()
    assert sorted(r.n for r in back) == ["alice", "alice", "bob"]


def test_date_shift_keeps_order_within_entity(spark):
    df = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-01-10"), (2, "2020-01-01")], "e int, d string")
    r = df.select("e", "d", pv.date_shift("d", "e", "k", 30).alias("s")).collect()
    a = [x for x in r if x.e == 1]
    assert (a[1].s - a[0].s).days == 9


def test_finding_offsets_match_python(spark):
    import re
    text = "a x@y.example.com b (555) 123-4567 and z@w.example.org, again x@y.example.com"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = sorted((r.info_type, r.start) for r in pv.inspect_infotypes(df, "id", "t", with_offsets=True).collect())
    exp = sorted([(t, m.start()) for t, p, _ in pv.DETECTORS for m in re.finditer(p.replace("(?i)", ""), text)])
    assert got == exp


def test_lsh_recall_vs_exact(spark):
    from tests.conftest import SF01
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    q = tx.centroids_by(e, "label", "embedding")
    exact = tx.vector_search(e, "vec_id", "embedding", q, "label", "centroid", k=5).select("query_id", "base_id")
    ann = tx.vector_search_lsh(e, "vec_id", "embedding", q, "label", "centroid", k=5).select("query_id", "base_id")
    assert ann.join(exact, ["query_id", "base_id"]).count() / exact.count() >= 0.9


def test_isolation_filter_shrinks_the_shuffle_and_handles_edges(spark):
    """Only shingles that an item may hold leave the scan, and odd rows are counted like plain ones."""
    import random

    from sparklab.operators import bloom
    r = random.Random(2)
    vocab = ["".join(r.choices("abcdefgh", k=4)) for _ in range(300)]
    say = lambda n: " ".join(r.choices(vocab, k=n))
    item = [say(30) for _ in range(20)] + ["too short", "", None, say(8)]
    docs = [say(200) for _ in range(300)]
    for k in range(0, 300, 7):
        docs[k] += " " + " ".join((item[k % 20] or "").split()[5:14]) + " " + say(3)
    rows = [(k, t) for k, t in enumerate(docs)] + [(None, docs[0]), (0, docs[0]), (5, None), (6, "")]
    items = spark.createDataFrame([*enumerate(item)], "item_id int, text string")
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    shingles = lambda t: {tuple((t or "").split()[i:i + 8]) for i in range(len((t or "").split()) - 7)}
    want = {k: len({d for d, t in rows if d is not None and shingles(t) & shingles(i)}) for k, i in enumerate(item)}
    got = {x.item_id: x.contaminated_docs for x in tx.eval_set_isolation(items, "item_id", "text", corpus, "doc_id", "text", 8).collect()}
    assert got == want and sum(want.values()) >= 43
    hashes = tx._gram_hashes(items, "item_id", "text", 8)
    keep = bloom.build(hashes, "h")
    every = tx._gram_hashes(corpus, "doc_id", "text", 8).count()
    passed = tx._gram_hashes(corpus, "doc_id", "text", 8, keep).count()
    assert passed * 10 < every and passed >= 43
    assert tx.eval_set_isolation(items.where("false"), "item_id", "text", corpus, "doc_id", "text").count() == 0
    assert {x.contaminated_docs for x in tx.eval_set_isolation(items, "item_id", "text", corpus.where("false"), "doc_id", "text").collect()} == {0}


def test_bloom_filter_has_no_false_negatives(spark):
    from pyspark.sql import functions as F
    import numpy as np

    from sparklab.operators import bloom
    df = spark.range(5000).select(F.xxhash64("id").alias("h"), F.col("id"))
    keep = bloom.build(df.unionByName(df.limit(1).select(F.lit(None).cast("long").alias("h"), "id")), "h")
    inside = df.toArrow().column("h").to_numpy().view(np.uint64)
    assert keep.might_contain(inside).all()
    other = np.random.default_rng(0).integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert keep.might_contain(other).mean() < 0.01
    small = bloom.build(df, "h", largest=10)
    assert small.might_contain(inside).all() and len(small.cells) == 16
