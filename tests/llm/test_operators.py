"""Text-corpus operators against brute force, the public tokenizers library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparklab.llm import bpe, components, decontaminate, fingerprints, language, ngram_join, quality_rules, suffix_dedup, token_counts, token_store, toxicity
from sparklab.llm.common import utf8, written
from tests.conftest import SF001

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LONG = " ".join(f"word{k % 977} and" for k in range(30_000))
ODD = ["", None, "   ", "a", "'s it's we'll ''s\n's", "x  y \n\n z\t", "日本語 é́ 😀 ４５ 123abc", "<|endoftext|> a<|endoftext|>", "same text here", "same text here", LONG]


def frame(spark, texts, extra="lang string"):
    rows = [(None if k == 3 else k, t, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def texts(n, seed=0):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 4))) for _ in range(60)]
    return [" ".join(r.choices(words, k=r.randint(0, 120))) for _ in range(n)]


def test_bpe_equals_library_and_round_trip(spark):
    lib = Tokenizer.from_file(BYTE)
    done = bpe.decode(bpe.encode(frame(spark, ODD), BYTE), BYTE).collect()
    assert len(done) == len(ODD)
    want = sorted((t or "", tuple(lib.encode(t or "", add_special_tokens=False).ids)) for t in ODD)
    assert sorted((r["text"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in done) == want
    assert bpe.encode(empty(spark), BYTE).count() == 0


def test_token_counts_after_edits(spark):
    lib = Tokenizer.from_file(BYTE)
    docs = frame(spark, ODD).where("doc_id is not null")
    edits = spark.createDataFrame([(k, s, a, n, t) for k in range(12) for s, (a, n, t) in enumerate([(0, 1, "it"), (5, 3, "'s 42"), (10**6, 5, " end"), (2, -4, None)])], "doc_id long, seq int, start int, length int, replacement string")
    state = token_counts.attach_edits(token_counts.build(docs, BYTE), edits)
    got = {r["doc_id"]: r for r in token_counts.apply_edits(state, BYTE).collect()}
    for k, t in enumerate(ODD):
        if k == 3:
            continue
        t = t or ""
        assert got[k]["n_tokens"] == len(lib.encode(t, add_special_tokens=False).ids)
        t = "it" + t[1:]
        t = t[:5] + "'s 42" + t[8:]
        t = t + " end"
        assert got[k]["text"] == t and got[k]["edited_tokens"] == len(lib.encode(t, add_special_tokens=False).ids)
        assert len(t) < 1000 or got[k]["n_reencoded"] < 1000


def test_token_store_round_trip(spark, tmpdir_path):
    lib = Tokenizer.from_file(WORD)
    docs = frame(spark, ODD).where("doc_id is not null")
    token_store.write(docs, f"{tmpdir_path}/ids", WORD, block=64, group=500)
    start = 0
    for r in token_store.read(spark, f"{tmpdir_path}/ids").orderBy("doc_id").collect():
        ids = [*lib.encode(ODD[r["doc_id"]] or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        assert (r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) == (start, len(ids), zlib.crc32(raw), raw)
        start += len(ids)
    token_store.write(empty(spark), f"{tmpdir_path}/none", WORD)
    assert token_store.read(spark, f"{tmpdir_path}/none").count() == 0


def test_token_store_finds_damage():
    ids = np.random.default_rng(0).integers(0, 65536, 1000)
    payload, sizes, crc = token_store.compress(ids, 100)
    assert (token_store.expand(payload, sizes, crc, 1000, 100) == ids).all()
    broken = bytearray(payload)
    broken[int(sizes[:3].sum()) + 9] ^= 255
    with pytest.raises(ValueError, match="block 3"):
        token_store.expand(bytes(broken), sizes, crc, 1000, 100)


def test_fingerprints_against_next(spark):
    own = [t for t in ODD]
    docs = frame(spark, own).where("doc_id is not null")
    got = {r["doc_id"]: r for r in fingerprints.against_next(docs, slices=3).collect()}
    ids = sorted(got, reverse=True)
    assert len(ids) == len(own) - 1
    for k, i in enumerate(ids):
        t, after = own[i] or "", own[ids[(k + 1) % len(ids)]] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[8]["fingerprint"] == got[9]["fingerprint"] and got[9]["near_next"] == 1
    assert fingerprints.against_next(empty(spark)).count() == 0


def test_fingerprints_estimate_containment_and_merge(spark):
    words = [f"w{k}" for k in range(6000)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:600])), (2, " ".join(words[3000:] + ["x"] * 9))]
    f = fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"))
    one = {r["doc_id"]: r["fingerprint"] for r in f.collect()}
    pair = spark.createDataFrame([(one[0], one[1], one[2])], "a string, b string, c string").select(fingerprints.containment("a", "b").alias("x"), fingerprints.containment("a", "c").alias("y")).first()
    assert pair["x"] == 1 and pair["y"] > 0.9
    both = f.where("doc_id < 2").agg(fingerprints.merge("fingerprint").alias("m")).first()["m"]
    assert both == one[0]


def test_rules_equal_their_expression(spark):
    m = dict(zip(quality_rules.STATISTICS, quality_rules.measure(*utf8(pa.array(["Ab cd cd $$!! 12 |\nx"])))[0]))
    assert (m["n_words"], m["longest_word"], m["repeat_share"], m["bare_share"], m["line_words"]) == (7, 4, 1 / 7, 3 / 7, 3.5)
    rules = quality_rules.paths([(0, 1, 2, 0, 5.0), (1, -1, -1, -1, 0.0), (2, 3, 4, 0, 9.0), (3, -1, -1, -1, 0.0), (4, -1, -1, -1, 0.0)])
    assert sorted(rules) == sorted([(("n_words", True, 5.0),), (("n_words", False, 5.0),), (("n_words", False, 5.0), ("n_words", True, 9.0)), (("n_words", False, 9.0),)])
    e = quality_rules.Ensemble([(rules[0], 2.0), ((("n_words", False, 5.0), ("n_words", True, 9.0)), -1.0)], 0.5)
    got = [r["score"] for r in quality_rules.score(frame(spark, ["a", "a b c d e f g", "a " * 20, None]), e).orderBy("doc_id").collect()]
    assert sorted(np.round(got, 9)) == sorted(np.round([1 / (1 + np.exp(-x)) for x in (2.5, -0.5, 0.5, 2.5)], 9))


def test_quality_learns(spark):
    good = texts(60, 1)
    rows = [(k, t.upper() + "!! ## $$" if k % 3 == 0 else t + " fine") for k, t in enumerate(good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(60)] + [(1, None)], "doc_id long, quality int")
    scored = quality_rules.score(docs, quality_rules.fit(docs, labels, "quality")).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in scored)
    none = quality_rules.fit(docs, labels.where("false"), "quality")
    assert {r["score"] for r in quality_rules.score(docs, none).collect()} == {0.5}


def test_toxicity_paths_agree_and_learn(spark):
    base = texts(240, 2)
    # the marked words stand behind many different words: only such continuations count
    put = lambda t: " ".join(x for k, w in enumerate(t.split()) for x in ([w, "vile"] if k % 9 == 4 else [w, "blob"] if k % 9 == 7 else [w]))
    rows = [(k, put(t) if k % 4 == 0 else t, int(k % 4 == 0)) for k, t in enumerate(base)] + [(900, None, 1), (901, "x", None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.train(train)
    held = spark.createDataFrame([(0, "a b vile blob c"), (1, texts(1, 9)[0]), (2, ""), (3, None), (4, "1 2 3")], "doc_id long, text string")
    fast = {r["doc_id"]: r["ratio"] for r in toxicity.top_ratio(held, model).collect()}
    slow = {r["doc_id"]: r["ratio"] for r in toxicity.top_ratio(held, model, broadcast=-1).collect()}
    assert fast[0] > 1 and fast[2] == fast[3] == fast[4] == 0
    assert all(abs(fast[k] - slow[k]) < 1e-6 for k in fast)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(held, model).collect()}
    assert scores[0] > 0.7 > scores[2] and all(0 <= s <= 1 for s in scores.values())
    blank = toxicity.train(train.where("label = 0"))
    assert {r["score"] for r in toxicity.score(held, blank).collect()} == {0.0}


def test_language(spark):
    rows = [(k, t, "aa") for k, t in enumerate(texts(30, 3))] + [(100 + k, t.translate(str.maketrans("abcde", "vwxyz")), "zz") for k, t in enumerate(texts(30, 4))] + [(200, None, "aa"), (201, "abc", None)]
    filters = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test = spark.createDataFrame([(0, "abab cdcd eaea baba"), (1, "vwvw xyxy zvzv"), (2, "12 !"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(test, filters).collect()}
    assert [got[k][0] for k in range(5)] == ["aa", "zz", "und", "und", "und"] and got[2][1] == got[4][1] == 0
    bare = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.predict(test, bare).collect()} == {"und"}


def brute_components(rows, words, percent):
    def grams(t):
        x = (t or "").lower().split()
        return {tuple(x[i : i + words]) for i in range(len(x) - words + 1)} if len(x) >= words else {tuple(x)} if x else set()

    sets = [(i, grams(t)) for i, t in rows]
    label = {i: i for i, _ in sets}
    for i, a in sets:
        for j, b in sets:
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    return {i: (len(s), label[i]) for i, s in sets}


def test_ngram_join_equals_brute_force(spark):
    r = random.Random(5)
    rows = []
    for t in texts(40, 6):
        w = t.split()
        for _ in range(r.choice([1, 2, 6])):
            v = list(w)
            for _ in range(r.choice([0, 1, 1, 2])):
                if v:
                    v[r.randrange(len(v))] = "new" + str(r.random())
            rows.append((len(rows), " ".join(v)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "one", "ONE", "one two", " \t"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.linked(docs).collect()}
    assert got == brute_components(rows, 3, 90)
    assert ngram_join.linked(empty(spark)).count() == 0


def test_ngram_join_splits_a_hub(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTNERS", 3)
    w = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join([*w, f"end{k}"])) for k in range(20)] + [(30, " ".join(w[:60])), (31, " ".join(w)), (31, " ".join(w)), (None, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
    got = {(x["doc_id"], x["component_id"]) for x in ngram_join.linked(docs).collect()}
    assert got == {(k, 0) for k in [*range(20), 31, None]} | {(30, 30)}


@pytest.mark.parametrize("broadcast", [ngram_join.BROADCAST, 0])
def test_ngram_join_links_texts_without_ids(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ngram_join, "BROADCAST", broadcast)
    w = [f"w{k}" for k in range(100)]
    put = lambda a, z: " ".join([*(f"x{k}" for k in range(a, z)), *w[:a], *w[z:]])
    # 4 words of 100 apart link, 8 do not: the texts without an id link documents 1 and 2
    chain = [(1, put(0, 4)), (None, " ".join(w)), (None, " ".join(w)), (2, " ".join([*w[:96], "y1", "y2", "y3", "y4"]))]
    near = [(None, " ".join([*"abcdefghijklmnopqrstuvwxyz", str(k)])) for k in range(2)]
    frame_ = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x["doc_id"] or 0, x["component_id"] or 0) for x in ngram_join.linked(frame_(chain + near)).collect())
    label = {i: c for i, (_, c) in brute_components([(k, t) for k, (_, t) in enumerate(chain + near)], 3, 90).items()}
    assert label == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 4}
    assert got == [(0, 0), (0, 0), (0, 1), (0, 1), (1, 1), (2, 1)]
    # no pair with an id: an error before
    assert [(x["doc_id"], x["n_shingles"], x["component_id"]) for x in ngram_join.linked(frame_(near)).collect()] == [(None, 25, None)] * 2


def test_ngram_join_forms_remaining_pairs_once_and_draws_few(spark):
    rows = [(h, key, h << 32 | 100, key, 100, [0] * 8) for h in range(10) for key in range(40)]
    rest = spark.createDataFrame(rows, "h long, key long, at long, label long, n long, classes array<long>")
    # one row a pair: one for each n-gram before
    assert sorted(map(tuple, ngram_join._all(rest, 80).collect())) == [(a, b) for a in range(40) for b in range(a + 1, 40)]
    assert ngram_join._left(rest) == (10 * 40 * 39 // 2, 400)
    sizes = rest.select("key", "n", "classes").distinct()
    assert 0 < ngram_join._drawn(rest, sizes, 4, 80).count() <= ngram_join.PIVOTS * 400


def test_ngram_join_last_pairs_are_one_for_each_component_first(spark):
    pairs = spark.createDataFrame([(a, b) for a in range(0, 20) for b in range(20, 40)], "a long, b long")
    labels = spark.createDataFrame([(k, k // 20) for k in range(40)], "key long, label long")
    assert ngram_join._firsts(pairs, labels).count() == 1
    assert ngram_join._firsts(pairs, labels.withColumn("label", F.lit(7).cast("long"))).count() == 0


def test_ngram_join_rows_without_partners_of_their_size_go(spark):
    sizes = {1: 90, 2: 100, 3: 500, 4: 111, 5: 124, 6: 1}
    rest = spark.createDataFrame([(h, key, n, key) for h in (1, 2) for key, n in sizes.items() if h == 1 or key in (1, 5)], "h long, key long, at long, label long")
    got = {(x["h"], x["key"]) for x in ngram_join._split(rest, 90).collect()}
    # every pair whose sizes may link keeps both rows
    for a, n in sizes.items():
        for b, m in sizes.items():
            if a != b and 100 * min(n, m) >= 90 * max(n, m):
                assert {(1, a), (1, b)} <= got
    assert not got & {(1, 3), (1, 6), (2, 1), (2, 5)}


def test_ngram_join_tells_long_sets_apart_by_finer_classes(spark):
    r = np.random.default_rng(5)
    of = lambda seed: np.random.default_rng(seed).integers(0, 2**63, 4000).astype(np.uint64)
    near = np.concatenate([of(1)[:3900], r.integers(0, 2**63, 100).astype(np.uint64)])
    bits = lambda x, classes: np.packbits((np.bincount((x & np.uint64(classes - 1)).astype(int), minlength=classes) & 1).astype(np.uint8), bitorder="little").view("<i8").tolist()
    sets = {1: of(1), 2: of(2), 3: near}
    sizes = spark.createDataFrame([(k, 4000, bits(x, 512)) for k, x in sets.items()], "key long, n long, classes array<long>")
    long = spark.createDataFrame([(k, ngram_join._parities(x).tolist()) for k, x in sets.items()], "key long, fine array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "key long, other long")
    assert [tuple(x) for x in ngram_join._candidates(pairs, sizes, long, 90).collect()] == [(1, 3)]
    assert ngram_join._candidates(pairs, sizes, long.where("key = 0"), 90).count() == 3


def test_ngram_join_of_a_crowd_with_drawn_pivots(spark, monkeypatch):
    r = random.Random(8)
    for name, value in (("PAIRS", 0), ("ROUNDS", 2), ("DRAWN", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = []
    for k in range(60):
        v = [f"w{j}" for j in range(80)]
        for j in r.sample(range(80), r.choice([1, 2])):
            v[j] = f"new{k}_{j}"
        rows.append((k, " ".join(v)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.linked(docs, words=5, percent=80).collect()}
    assert got == brute_components(rows, 5, 80)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[k] for k in range(31)}) == 1 and len({got[k] for k in range(100, 140)}) == 1 and got[0] != got[100]


def test_components_of_few_edges_are_few_files(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)], "a long, b long").repartition(8)
    assert len(components.components(edges).inputFiles()) == 1


def test_components_after_more_edges_are_those_of_all(spark):
    r = random.Random(3)
    parts = [[(r.randrange(60), r.randrange(60)) for _ in range(18)] for _ in range(4)]
    labels = spark.createDataFrame([], "node long, label long")
    for k, part in enumerate(parts):
        labels = components.joined(labels, spark.createDataFrame(part, "a long, b long"))
        got = [tuple(x) for x in labels.collect()]
        whole = {}
        for x in components.components(spark.createDataFrame(sum(parts[: k + 1], []), "a long, b long")).collect():
            whole.setdefault(x["label"], set()).add(x["node"])
        mine = {}
        for node, label in got:
            mine.setdefault(label, set()).add(node)
        assert len(got) == len(dict(got)) and sorted(map(sorted, mine.values())) == sorted(map(sorted, whole.values()))


def brute_dedup(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(b[k : k + length])
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("held", [suffix_dedup.HELD, 40])
def test_suffix_dedup_equals_brute_force(spark, held):
    r = random.Random(8)
    parts = [t for t in texts(25, 7) if len(t) > 60]
    rows = [(k, " ".join(r.choices(parts, k=r.choice([1, 1, 3])))[r.randrange(40) :]) for k in range(50)]
    rows += [(60, "ab" * 200), (61, "x" * 300), (62, None), (63, ""), (64, rows[0][1]), (65, rows[0][1])]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), held=held).collect()}
    assert got == brute_dedup(rows, 100)
    assert suffix_dedup.dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("batch", [1, 1000])
def test_suffix_dedup_repeated_rows_are_one_document(spark, batch):
    r = random.Random(12)
    parts = [t for t in texts(12, 13) if len(t) > 110]
    rows = [(k, " ".join(r.choices(parts, k=2))) for k in range(12)]
    rows += [(None, " ".join(r.choices(parts, k=2)) + f" own words {k} " + "".join(r.choices("abc ", k=150))) for k in range(4)]
    rows += [(20, "q" + "".join(r.choices("abc ", k=200)) + parts[0]), (21, "z" * 150)]
    last = suffix_dedup.LAST
    # null keys are the largest, rows of one key go by the hash of their text
    tie = {x["t"]: x["h"] for x in spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(rows, key=lambda x: (last if x[0] is None else x[0], tie[x[1]]))
    want = brute_dedup([(k, t) for k, (_, t) in enumerate(order)], 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    got = suffix_dedup.dedup(spark.createDataFrame(rows + rows[::-1] + rows[3:9], "doc_id long, text string")).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert len(got) == 2 * len(rows) + 6
    kept = {(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got}
    assert kept == {(i, *want[k]) for k, (i, _) in enumerate(order)}


@pytest.mark.parametrize("batch", [2, 1000])
def test_suffix_dedup_frequent_anchors_and_bounded_groups(spark, batch):
    r = random.Random(14)
    line = "".join(r.choices("abcdefgh", k=130))
    rows = [(k, "".join(r.choices("abcd ", k=r.randrange(160))) + line + "".join(r.choices("ab", k=r.randrange(160)))) for k in range(90)]
    rows += [(100 + k, rows[k % 7][1] * 2) for k in range(20)] + [(k, None) for k in range(200, 203)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        pairs = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
        named = suffix_dedup.written(suffix_dedup._named(pairs, 100, 24), "test-named")
        hot = suffix_dedup._frequent(named, 30)
        sizes = {x["anchor"]: x["count"] for x in named.where("anchor is not null").groupBy("anchor").count().collect()}
        assert {x["anchor"] for x in hot.collect()} == {a for a, n in sizes.items() if n > 30} != set()
        assert suffix_dedup._frequent(named, 10**6) is None
        want = brute_dedup(rows, 100)
        # group 0: a group is a batch and the rest of its last anchor
        for more in ({"hot": 30}, {"hot": 30, "group": 0}, {"hot": 0}, {"group": 3000, "held": 50}, {"shards": 1}):
            done = suffix_dedup.dedup(docs, **more)
            got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in done.collect()}
            assert got == want, more
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def distance_to_part(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark):
    r = random.Random(11)
    items = [(k, " ".join(r.choices(["alpha", "beta", "gamma", "delta", "of", "the", "in"], k=30))) for k in range(4)]
    rows = []
    for k in range(40):
        s = list(items[k % 4][1])
        for _ in range(r.randint(0, 14)):
            p = r.randrange(len(s))
            s[p : p + 1] = r.choice([[], ["q"], [s[p], "z"]])
        rows.append((k, r.choice(["", "some words before "]) + "".join(s).upper() + r.choice(["", ", and after"])))
    rows += [(90, ""), (91, None), (92, "nothing of that kind")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (8, None), (9, ""), (10, "short")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["distance"] for x in decontaminate.hits(docs, bench).collect()}
    fold = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    index = decontaminate.Index(items)
    for i, item in items:
        budget = int(index.budget[index.keys.tolist().index(i)])
        for d, t in rows:
            best = distance_to_part(fold(item), fold(t))
            assert ((d, i) in got) == (best <= budget), (d, i, best, budget)
            assert (d, i) not in got or got[d, i] == best
    blocks = {(x["doc_id"], x["item_id"]) for x in decontaminate.hits(docs, bench, block=200).collect()}
    assert blocks == set(got)
    kept = {x["doc_id"] for x in decontaminate.clean(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got}
    assert decontaminate.hits(docs, bench.where("false")).count() == 0


def test_pipeline_rows_that_share_an_id_or_have_none(spark):
    import corpus_pipeline

    r = random.Random(15)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    a, b, c, d = ([word() for _ in range(60)] for _ in range(4))
    near = lambda w: " ".join([*w[:-1], word()])
    rows = [(4, " ".join(a)), (3, near(a)), (3, " ".join(b)), (3, " ".join(b)), (None, near(b)), (None, " ".join(c)), (None, " ".join(c)), (None, near(c))]
    rows += [(7, " ".join([*d, *a[:30]])), (None, near(a)), (5, ""), (6, None), (8, "one two"), (None, "one two")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF001).collect()
    groups = {}
    for k, (_, label) in brute_components([(k, t) for k, (_, t) in enumerate(rows)], 5, 80).items():
        groups.setdefault(label, []).append(rows[k])
    size = lambda x: (x[0] is None, x[0] or 0)
    kept = sorted(((x["doc_id"], x["text"]) for x in got), key=lambda x: (*size(x), x[1] or ""))
    assert len(kept) == len(groups) == 7
    for members in groups.values():
        one = [x for x in kept if x in members]
        assert len(one) == 1 and size(one[0]) == min(map(size, members))
    # texts of one id or none are cut as separate documents
    done = corpus_pipeline.repeated_strings(spark, spark.createDataFrame(got, docs.schema), SF001).collect()
    want = brute_dedup([(k, t) for k, (_, t) in enumerate(kept)], 100)
    assert sorted(hashlib.sha256(x["text"].encode()).hexdigest() for x in done) == sorted(x[3] for x in want.values())
    assert any(x[1] for x in want.values())


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF001).collect()}
    assert 0 < len(rows) < docs.count()
    lib = Tokenizer.from_file(BYTE)
    near = corpus_pipeline.near_duplicates(spark, docs.withColumn("more", F.lit(1)), SF001)
    assert near.columns == docs.columns and near.count() == near.select("doc_id").distinct().count()
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    same = [r for k, r in rows.items() if r["n_chars"] == len(whole[k])][:20]
    assert same and all(np.frombuffer(r["ids"], "<u4").tolist() == lib.encode(whole[r["doc_id"]], add_special_tokens=False).ids for r in same)


def test_few_rows_of_a_join_are_few_files(spark, monkeypatch):
    """What the join and its components write of few rows is one file each, however many shuffle partitions there are."""
    files = {}

    def counted(df, name):
        out = written(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    monkeypatch.setattr(components, "written", counted)
    rows = [(k, " ".join(f"w{k % 20}x{j}" for j in range(30)) + f" end{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("23", "false")):
            spark.conf.set(k, v)
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.linked(docs, percent=80).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {k: k % 20 for k in range(60)}
    assert files["join-links"] == 1 and all(n == 1 for name, n in files.items() if name != "join-summary"), files
