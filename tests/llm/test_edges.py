"""Edge inputs of the text operators: null keys, ties, repeated rows, very long texts, clashing names, empty tables."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparklab.llm import bpe, decontaminate, fingerprints, language, quality_rules, suffix_dedup, token_counts, token_store, toxicity
from tests.conftest import SF01

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_long_fragments_equal_library_quickly():
    lib, own = Tokenizer.from_file(BYTE), bpe.load(BYTE)
    r = random.Random(1)
    kinds = ["abcdefgh", "ab", "aaab", "etaoinshrdlu", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    texts = ["".join(r.choices(kinds[k % 5], k=r.randint(90, 700))) for k in range(200)] + ["=" * 50_000 + "漢字" * 3000, "".join(r.choices(kinds[4], k=100_000))]
    for t in texts:
        assert np.frombuffer(own.encode_texts(t.encode(), np.array([0, len(t.encode())]))[0], "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    start = time.time()
    ids = np.frombuffer(own.merge(b"x" * 1_000_000), "<u4").tolist()
    assert time.time() - start < 20 and ids == lib.encode("x" * 1_000_000, add_special_tokens=False).ids


def test_repetitive_text_is_cut_in_linear_time(spark):
    start = time.time()
    r = suffix_dedup.dedup(spark.createDataFrame([(1, "word " * 400_000)], "doc_id long, text string")).first()
    assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_text"]) == (2_000_000, 1_999_995, 1, "word ") and time.time() - start < 120


def test_largest_id_is_not_null(spark):
    own = lambda c: "".join(random.Random(c).choices("abcdefgh ", k=150))
    rows = [((1 << 63) - 1, own(1)), (None, own(1)), (None, own(2)), (None, own(2)), (5, own(2))]
    done = [(r["doc_id"], r["n_removed"]) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    # the id 5 keeps its text; of the others one original is left for each text, and equal rows share its result
    assert sorted(done, key=str) == sorted([((1 << 63) - 1, 0), (None, 150), (None, 150), (None, 150), (5, 0)], key=str) or sorted(done, key=str) == sorted([((1 << 63) - 1, 150), (None, 0), (None, 150), (None, 150), (5, 0)], key=str)


@pytest.mark.parametrize("keys", [[None] * 5, [None, 3, None, 3, 1], [7], []])
def test_fingerprints_of_null_and_tied_keys(spark, keys):
    texts = ["b two words", None, "a one", "a one", "c " * 500][: len(keys)]
    rows = sorted(zip(keys, texts), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    got = fingerprints.against_next(spark.createDataFrame([*zip(keys, texts)], "doc_id long, text string"), slices=3).collect()
    want = []
    for k, (key, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        want.append((key, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)


def test_likeness_is_near_exact_containment(spark):
    """Against the containment of whole shingle sets, for every document and its edited text."""
    docs = [t or "" for _, t in sorted(((r[0], r[1]) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()), reverse=True)]
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t).split()

    def shingles(t):
        w = low(t.replace("\x1c", "\x1cx"))
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(docs, docs[1:] + docs[:1])]
    pair = spark.createDataFrame([*zip(range(len(docs)), docs, edited)], "k int, a string, b string")
    both = fingerprints.fingerprint(fingerprints.fingerprint(pair, "a", "x"), "b", "y").select("k", "x", "y", fingerprints.containment("x", "y").alias("near")).collect()
    errors = []
    for r in both:
        p, q = shingles(docs[r["k"]]), shingles(edited[r["k"]])
        errors.append(abs(r["near"] - (len(p & q) / min(len(p), len(q)) if p and q else float(not p and not q))))
    assert np.mean(errors) < 0.05


def test_merged_fingerprint_is_that_of_all_shingles(spark):
    words = [f"w{k}" for k in range(2000)]
    texts = [" ".join(words[a : a + n]) for a, n in ((0, 60), (30, 100), (100, 700), (700, 1300))]
    f = fingerprints.fingerprint(spark.createDataFrame([*enumerate(texts)], "k int, text string"))
    for some, whole in (([0, 1], words[:130]), ([2, 3], None), ([0, 1, 2, 3], None)):
        merged = f.where(F.col("k").isin(some)).agg(fingerprints.merge("fingerprint").alias("m")).first()["m"]
        kept = {merged[1 + i : 17 + i] for i in range(0, len(merged) - 1, 16)}
        parts = [r["fingerprint"] for r in f.where(F.col("k").isin(some)).collect()]
        bound = (1 << 64) >> int(merged[0])
        assert kept == {p[1 + i : 17 + i] for p in parts for i in range(0, len(p) - 1, 16) if int(p[1 + i : 17 + i], 16) < bound}
        if whole:  # 126 different shingles call for all hashes
            assert merged == fingerprints.fingerprint(spark.createDataFrame([(" ".join(whole),)], "text string")).first()["fingerprint"]


CLASH = "doc_id long, text string, stats string, _stats int, _ratio int, _row int, top string, at int, key int, score string, ids string, lang_pred int, start string, item_id string"
TEXTS = ["a plain text of some words", None, "", "same", "same", "vile vile " * 30_000, "un texte tout simple", "ünï 漢字 123"]


@pytest.fixture(scope="module")
def clash(spark):
    rows = [(None if k == 3 else k, t, "s", k, k, k, "t", k, k, "old", "i", k, "st", "it") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[4:5], CLASH)


def test_scores_with_clashing_names(spark, clash):
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, quality int")
    e = quality_rules.Ensemble([((("n_words", False, 3.0),), 1.0)], 0.0)
    assert quality_rules.fit(clash, labels, "quality").intercept is not None
    train = spark.createDataFrame([(k, f"w{k % 7} vile w{k % 5} x" if k % 2 else f"w{k % 7} fine w{k % 5} x", k % 2) for k in range(200)], "doc_id long, text string, label int")
    model = toxicity.train(train, corpus=train)
    for out in (quality_rules.score(clash, e, keep_text=True), toxicity.score(clash, model), toxicity.score(clash, model, broadcast=-1)):
        assert sorted(out.columns) == sorted(clash.columns) and dict(out.dtypes)["score"] == "double"
        rows = out.collect()
        assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
        assert [(r["_stats"], r["_ratio"], r["_row"], r["at"], r["key"], r["stats"], r["top"]) for r in rows] == [(r["_row"],) * 5 + ("s", "t") for r in rows]
        assert len({r["score"] for r in rows if r["text"] == "same"}) == 1
    assert quality_rules.score(clash.where("false"), e).count() == toxicity.score(clash.where("false"), model).count() == 0


def test_language_bpe_counts_and_hits_with_clashing_names(spark, clash):
    known = spark.createDataFrame([("the plain words of a text", "en"), ("une phrase tout simple des mots", "fr")] * 5, "text string, lang string")
    told = language.predict(clash, language.train(known))
    assert told.count() == 9 and dict(told.dtypes)["lang_pred"] == "string" and set(clash.columns) <= set(told.columns)
    assert {r["lang_pred"] for r in told.where("text is null or text = ''").collect()} == {"und"}
    assert language.predict(clash.where("false"), language.train(known)).count() == 0
    ids = bpe.encode(clash, BYTE)
    assert dict(ids.dtypes)["ids"] == "binary" and ids.columns.count("ids") == 1 and ids.count() == 9
    items = spark.createDataFrame([(1, "vile vile vile vile vile vile"), (None, None), (2, "")], "item_id long, text string")
    assert decontaminate.hits(clash, items).where("doc_id = 5").count() > 0 and decontaminate.hits(clash.where("false"), items).count() == 0
    assert token_counts.build(clash.drop("key"), BYTE).count() == 9


def test_text_whose_only_hits_are_hash_table_collisions(spark):
    import numpy as np
    r = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    items = [(k, "".join(x)) for k, x in enumerate(r.choice(letters, (4000, 10)))]
    index = decontaminate.Index(items)
    raw = "".join(r.choice(letters, 60_000))
    grams = decontaminate.gram_hashes(decontaminate.folded(raw.encode(), np.array([0, len(raw)]))[0])
    at = np.flatnonzero(index.table[decontaminate.slots(grams)] & ~np.isin(grams, index.h))
    assert len(at)
    text = raw[at[0] : at[0] + 10]
    assert index.search(text.encode(), np.array([0, 10])) == []
    docs = spark.createDataFrame([(1, text), (2, items[0][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [x["doc_id"] for x in decontaminate.hits(docs, bench).collect()] == [2]


def test_token_ids_with_null_and_tied_keys(spark, tmpdir_path):
    docs = spark.createDataFrame([(None, "one two"), (2, "three"), (2, "four"), (None, None)], "doc_id long, text string")
    token_store.write(docs, f"{tmpdir_path}/ids", WORD)
    got = token_store.read(spark, f"{tmpdir_path}/ids").orderBy("start").collect()
    assert len(got) == 4 and got[0]["start"] == 0
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    assert sorted(r["n_tokens"] for r in got if r["doc_id"] is None) == [1, 3]


def test_chosen_labels_are_bounded_by_class(spark):
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(500)] + [(None, 1), (3, None), (7, 1)], "doc_id long, toxic int")
    few = toxicity.chosen(labels, sample=20).collect()
    assert sorted(r["label"] for r in few) == [0] * 20 + [1] * 20 and len({r["doc_id"] for r in few}) == 40
    every = {r["doc_id"]: r["label"] for r in toxicity.chosen(labels).collect()}
    assert len(every) == 500 and every[7] == 1 and sum(every.values()) == 51


def test_ratios_equal_plain_counts(spark):
    """Continuation counts, discounts, back-off to the corpus counts: an independent computation over word lists."""
    r = random.Random(3)
    texts = [" ".join(r.choices("ab bc cd de ef fg vile grim".split(), weights=[9, 8, 7, 6, 5, 4, 3 if k % 3 == 0 else 0.05, 2 if k % 3 == 0 else 0], k=30)) for k in range(150)]
    rows = [(k, t, int(k % 3 == 0)) for k, t in enumerate(texts)]
    more = [f"ab only here {k % 9}" for k in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    corpus = spark.createDataFrame([(t,) for t in texts + more], "text string")
    counted = {x["doc_id"] for x in train.where(F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.CALIBRATE)) != 0).collect()}
    model = toxicity.train(train, corpus=corpus)
    before, held = {0: {}, 1: {}}, {0: {}, 1: {}}
    for k, t, y in rows:
        if k in counted:
            w = t.split()
            for v, x in zip(["^", *w], w):
                before[y].setdefault(x, set()).add(v)
            for x in set(w):
                held[y][x] = held[y].get(x, 0) + 1
    n = {y: {x: min(len(v), held[y][x]) for x, v in before[y].items()} for y in (0, 1)}
    left = {y: {x: max(c - toxicity.DISCOUNT, 0) for x, c in n[y].items()} for y in (0, 1)}
    total = {y: sum(left[y].values()) for y in (0, 1)}
    back = 1 - (total[0] + total[1]) / sum(sum(c.values()) for c in n.values())
    every = {}
    for t in texts + more:
        for x in {w for w in t.split() if w.isalpha()}:
            every[x] = every.get(x, 0) + 1
    whole = sum(every.values()) + 0.5 * (len(every) + 1)
    p = lambda x, y: (1 - back) * left[y].get(x, 0) / total[y] + back * (every.get(x, 0) + 0.5) / whole
    for x in ("ab", "ef", "vile", "grim", "unknown"):
        want = np.log(p(x, 1) / p(x, 0)) if left[0].get(x, 0) + left[1].get(x, 0) else 0.0
        got = toxicity.top_ratio(spark.createDataFrame([(x,)], "text string"), model).first()["ratio"]
        assert got == pytest.approx(want, abs=1e-5)
