"""Periodic runs, line de-duplication and phrase mining against brute force, and their edge inputs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparklab.llm import line_dedup, periodic_runs, phrases, queries
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = "doc_id long, text string, start string, n_lines int, h1 int, _row_1 string"


def edge(spark, texts):
    """Rows with null ids, repeated rows and columns named like those of results and inner tables."""
    rows = [(None if k % 7 == 3 else k, t, f"s{k}", k, k, "r") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:2], EDGE)


def plain_runs(words):
    """All runs by comparing every word with the one q before."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            a, b = i, j + q
            if b - a >= max(6, 4 * q) and not any(all(words[k] == words[k + d] for k in range(a, b - d)) for d in range(1, q)):
                out.append((a, b - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_summary(words):
    runs = plain_runs(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        x = [r.choice("abécdefghij"[: r.choice([1, 2, 5, 10])]) for _ in range(r.randint(0, 80))]
        for _ in range(r.randint(0, 3)):
            if len(x) > 4:
                a, p = r.randrange(len(x)), r.randint(1, 12)
                for i in range(a + p, min(len(x), a + p * r.randint(2, 9) + r.randint(0, p))):
                    x[i] = x[i - p]
        out.append(x)
    return out


@pytest.mark.parametrize("scale", [1, 2, 8, 64, 512])
def test_transform_finds_equal_blocks(scale):
    rng = np.random.default_rng(scale)
    block, window = rng.integers(1, 3, (6, scale)), rng.integers(1, 3, (6, 2 * scale))
    window[0, :scale], window[1, scale - 1 : 2 * scale - 1], block[2], window[2] = block[0], block[1], 7, 7
    want = [[bool((b == w[o : o + scale]).all()) for o in range(scale)] for b, w in zip(block, window)]
    assert (periodic_runs.zero_distances(block, window) == np.array(want)).all()
    assert (periodic_runs.transform(periodic_runs.transform(window), inverse=True) == window).all()


def test_runs_equal_plain_comparison(spark):
    texts = repetitive(3, 300)
    docs = spark.createDataFrame([(k, "  ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.find(docs).collect()}
    for k, words in enumerate(texts):
        runs, best, rest = plain_summary(words)
        r = got[k]
        assert [tuple(x) for x in r["runs"]] == runs and r["n_runs"] == len(runs) and r["collapsed"] == rest
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)


def test_runs_of_edge_inputs(spark):
    texts = ["", None, " \t\n", "x", "a " * 6, "a " * 5, "same same", "same same", "b c " * 9, " ".join(f"w{i % 700}" for i in range(60_000)), "q " * 200_000]
    docs = edge(spark, texts)
    done = periodic_runs.find(docs)
    assert "start" in done.columns and done.columns.count("start") == 1 and dict(done.dtypes)["start"] == "bigint" and "h1" in done.columns
    got = {r["h1"]: r for r in done.collect()}
    assert len(got) == len(texts) and done.count() == len(texts) + 2
    assert [got[k]["n_runs"] for k in range(11)] == [0, 0, 0, 0, 1, 0, 0, 0, 1, 1, 1]
    assert (got[9]["start"], got[9]["length"], got[9]["period"], got[9]["exponent_milli"]) == (0, 60_000, 700, 85_714)
    assert got[10]["collapsed"] == "q" and got[1]["collapsed"] == "" and got[8]["collapsed"] == "b c"
    assert periodic_runs.find(docs.where("false")).count() == 0


def test_runs_query_equals_plain_comparison(spark):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc, text in docs:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        if len(words) > 800:
            continue  # the plain comparison takes too long
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, best, rest = plain_summary(words)
        r = got[doc]
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(rest.encode()).hexdigest()
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *(best or (None,) * 3))


def plain_lines(rows, min_chars, min_docs):
    """(lines, dropped lines, text) of every row by a dictionary of keys; a null id is the least."""
    order = lambda d: (d is not None, d or 0)
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            held[k].append(doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or doc == max(held[key(x)], key=order)]
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def test_lines_equal_dictionary(spark):
    r = random.Random(5)
    pool = [" ".join(r.choices(["Été", "Zeile", "line", "漢字", "ONE"], k=r.randint(1, 5))) for _ in range(40)]
    pick = lambda: r.choice(["", " ", "\t", "\x0b"]) + r.choice([str.upper, str.lower, str])(r.choice(pool)) + r.choice(["", " \r", "\x0c"])
    texts = ["\n".join(pick() for _ in range(r.randint(0, 12))) for _ in range(120)] + ["", None, "\n\n", "\n".join(pool * 300), "only here " * 9]
    texts = [pool[0] + "\n" + t if t is not None and k % 3 == 0 else t for k, t in enumerate(texts)]
    docs = edge(spark, texts)
    rows = [(x["doc_id"], x["text"]) for x in docs.collect()]
    for chars, many, batches in ((8, 5, 5), (1, 2, 1), (8, 1000, 3)):
        done = line_dedup.dedup(docs, min_chars=chars, min_docs=many, batches=batches)
        assert set(done.columns) == {*docs.columns, "n_dropped", "kept"} and dict(done.dtypes)["n_lines"] == "bigint"
        got = sorted((x["_row_1"], x["start"], x["n_lines"], x["n_dropped"], x["kept"]) for x in done.collect())
        want = sorted((x["_row_1"], x["start"], *w) for x, w in zip(docs.collect(), plain_lines(rows, chars, many)))
        assert got == want
    assert line_dedup.dedup(docs.where("false")).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_lines_without_any_id_and_string_ids(spark):
    same = "a line that is long enough for a key, forty and more"
    none = spark.createDataFrame([(None, same)] * 6, "doc_id long, text string")
    assert {(x["n_dropped"], x["kept"]) for x in line_dedup.dedup(none).collect()} == {(0, same)}
    named = spark.createDataFrame([(f"d{k}", same + "\nown") for k in range(6)], "name string, body string")
    assert {x["name"]: x["kept"] for x in line_dedup.dedup(named, "name", "body", batches=2).collect()} == {f"d{k}": "own" if k < 5 else same + "\nown" for k in range(6)}


def test_runs_of_lines_are_merged_on_their_buckets(spark):
    """Runs hold each key once, two of a level become one, and the runs' side of the join is not shuffled."""
    lines = [f"{k % 30:02d} a line that is long enough to be a key here" for k in range(90)]
    found = line_dedup.occurrences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    store = line_dedup.LineRuns(spark)
    for b in range(3):
        store.add(found.where(F.col("doc") % 3 == b))
    assert [level for level, _ in store.runs] == [1, 0]
    keys = [store._run(*run).select("h1", "h2") for run in store.runs]
    assert sum(k.count() for k in keys) == keys[0].unionAll(keys[1]).distinct().count() == 30
    assert store.frequent(3).count() == 30 and store.frequent(4).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = found.groupBy("h1", "h2").agg(F.max("doc").alias("d"))
        plan = own.join(store._run(*store.runs[0]), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    store.close()


def plain_phrases(rows, longest, min_count, top, inside):
    """Collocations by dictionaries of word tuples."""
    f = defaultdict(lambda: defaultdict(int))
    for lang, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang or "und"][tuple(w[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        many = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        rows = []
        for p, a in many.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            held = any(100 * c >= inside * a for q, c in many.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not held:
                rows.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, k, p, a, left, right, n, score) for k, (score, a, p, left, right) in enumerate(rows[:top], 1)]
    return sorted(out)


def speech(seed, n):
    r = random.Random(seed)
    words = [*"abcdefghé漢", "New", "york", "CITY", "x'y", "\x00", "Über"]
    out = []
    for _ in range(n):
        w = r.choices(words, weights=range(len(words), 0, -1), k=r.randint(0, 60))
        for _ in range(r.randint(0, 6)):
            w.insert(r.randint(0, len(w)), r.choice(["New york city", "a b a b", "x'y, é"]))
        out.append(r.choice([" ", "\t", "  "]).join(w).replace("g", r.choice(["g", ".", "!\x0b", "\n"])))
    return out


def test_phrases_equal_dictionaries(spark):
    texts = speech(4, 400) + ["", None, "...", " a", "w " * 3000, "w w w"]
    rows = [(r, t) for r, t in zip([None, "en", "fr", "und"] * 200, texts)]
    # columns of other names, also of those that results have, are not read
    docs = spark.createDataFrame([(*x, 1, "n") for x in rows + rows[:40]], "lang string, text string, rank int, phrase string").repartition(3)
    for longest, many, top, inside, head, window in ((3, 10, 2000, 50, 1 << 14, 1 << 20), (4, 5, 7, 80, 5, 300), (2, 3, 50, 50, 1024, 2000)):
        got = phrases.collocations(docs, longest=longest, min_count=many, top=top, inside=inside, head=head, window=window)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = plain_phrases(rows + rows[:40], longest, many, top, inside)
        assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 20
    assert phrases.collocations(docs.where("false")).count() == 0


@pytest.mark.parametrize("crowd", [0, 300_000])
def test_tiles_equal_unique_pairs(crowd):
    """Crowded tiles are counted densely, others as sorted pairs; both are the counts of a dictionary."""
    rng = np.random.default_rng(crowd)
    a = np.concatenate([rng.integers(0, 512, crowd), rng.integers(0, 3000, 5000)])
    b = np.concatenate([rng.integers(512, 1024, crowd), rng.integers(0, 3000, 5000)])
    x, y, n = phrases.tiled(a, b, (1024, 2048))
    got = dict(zip(zip(x.tolist(), y.tolist()), n.tolist()))
    want = defaultdict(int)
    for p in zip(a.tolist(), b.tolist()):
        want[p] += 1
    assert got == dict(want) and len(x) == len(got)


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    """With hashes of one byte nearly all words collide at first; the counts are still those of the words."""
    rows = [("en", t) for t in speech(8, 60)]
    real = phrases.hashlib.blake2b

    class Short:
        def __init__(self, data, **kw):
            self.turn, self.raw = int(kw.get("person", b"0")), real(data, **kw).digest()

        def digest(self):
            return self.raw if len(self.raw) != 8 or self.turn else bytes([self.raw[0] % 4]) + bytes(7)

    class fake:
        blake2b = Short

    numbers = phrases._Numbers("en", frozenset())
    monkeypatch.setattr(phrases, "hashlib", fake)
    seen, bad = {}, frozenset()
    words = sorted({w for _, t in rows for w in (t or "").encode().lower().split()})
    while True:
        numbers = phrases._Numbers("en", bad)
        seen = defaultdict(set)
        for w in words:
            seen[numbers[w]].add(w)
        shared = {i for i, w in seen.items() if len(w) > 1}
        if not shared:
            break
        bad |= shared
    assert bad and len(seen) == len(words)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_019
    row = spark.createDataFrame([(big, 2 * big + 1, 5 * big + 3)], "a long, l long, r long").select(phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row["s"] == 1_000_000 * big * big // ((2 * big + 1) * (5 * big + 3))


def test_word_ids_are_those_of_the_bytes(monkeypatch):
    """Ids come from sums over the bytes of a batch: they depend on word and language only, also across the spans of
    the sums; those of a hash that is no word's are numbered singly."""
    monkeypatch.setattr(phrases, "SPAN", 16)
    phrases._scales.cache_clear()
    texts = [b"b aa b ab ba", b"aa", b"", b"x" * 50 + b" aa  ba", b"b"]
    langs = ["en", "fr", "en", "en", "fr"]

    def ids(bad):
        batch = pa.RecordBatch.from_arrays([pa.array([t.decode() for t in texts])], names=["text"])
        raw, starts, ends, before = phrases._spans(batch)
        found = phrases.word_ids(raw, starts, ends, langs, np.diff(before), bad).tolist()
        named = defaultdict(set)
        for k, lang in enumerate(langs):
            for w, a, e in zip(found[before[k] : before[k + 1]], starts[before[k] :], ends[before[k] :]):
                named[lang, raw[a:e]].add(w)
        return named

    try:
        named = ids(frozenset())
        assert len(named) == 7 and all(len(x) == 1 for x in named.values()) and len(set().union(*named.values())) == 7
        again = ids(frozenset(named["en", b"aa"]))
        assert len(set().union(*again.values())) == 7
        assert {k for k in named if named[k] != again[k]} == {("en", b"aa")}
    finally:
        phrases._scales.cache_clear()


def test_words_whose_sums_are_equal_are_told_apart(spark):
    """Two words of 1,024 letters with the same polynomial hash (Thue-Morse) are still counted apart."""
    one = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    raw = (one + two).encode()
    h = phrases.word_hashes(np.frombuffer(raw, np.uint8), np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] == h[1]
    rows = [("en", f"{one} c")] * 12 + [("en", f"{two} c. {two}")] * 11
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 3, 10, 2000, 50) and got.count() == 2
