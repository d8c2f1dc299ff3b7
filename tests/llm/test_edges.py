"""Nulls in ids, ids beyond doubles, repeated rows, very long texts, clashing names and plain versions of methods."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyforge.llm import chat_format, decontamination, language_id, mixing, ngram_jaccard, simhash, substring_dedup, suffix_dedup, toxicity, url_filter
from tallyforge.llm.queries import RULES, simhash_near

BIG = 2**53 + 1
CLASH = ["h1", "h2", "_keys", "_at", "_best", "_doc", "key", "row", "doc", "at", "x", "node", "n", "starts", "kept", "score"]


def prose(rng, n):
    return " ".join("".join(rng.choices("the of an re in on er th st ti ea ou".split(), k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    a, b, c = prose(rng, 90), prose(rng, 80), prose(rng, 70)
    return [(5, a), (5, a), (BIG, f"{prose(rng, 10)} {a}"), (BIG + 1, c), (None, a), (None, f"{b} own"), (None, None), (7, ""), (8, "word " * 3_000 + c)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in CLASH])


def others(df, apart):
    return [c for c in CLASH if c not in apart], [c for c in df.columns if c in CLASH and c not in apart]


def test_byte_repeats(docs, rows):
    out = suffix_dedup.remove_repeats(docs)
    assert others(out, ["kept"])[0] == others(out, ["kept"])[1] and out.where("h1 <> 'h1' or _at <> '_at'").count() == 0
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    want = Counter()
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        want[i, len(t), int(gone.sum())] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in out.collect()) == want


def test_word_repeats(docs, rows):
    out = substring_dedup.remove_repeats(docs)
    assert others(out, ["n"]) and set(CLASH) <= set(out.columns)
    order = [float("inf") if i is None else i for i, _ in rows]
    words = [(t or "").split() for _, t in rows]
    first = {}
    for k in sorted(range(len(rows)), key=order.__getitem__):
        for j in range(len(words[k]) - 12):
            first.setdefault(tuple(words[k][j : j + 13]), order[k])
    want = Counter()
    for (i, _), o, w in zip(rows, order, words, strict=True):
        gone = {x for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < o for x in range(j, j + 13)}
        want[i, len(w), len(gone)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in out.collect()) == want


def test_runs_shorter_than_the_least_stay(spark):
    rng = random.Random(2)
    short, long = prose(rng, 15), prose(rng, 40)
    df = spark.createDataFrame([(1, f"{short} a {long}"), (2, f"{long} b c {short}")], "doc_id long, text string")
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(df, min_words=20).collect()}
    assert out[2].text == f"b c {short}" and out[2].n_removed == 40 and [tuple(s) for s in out[2].spans] == [(0, 40)]


def test_near_groups(docs, rows):
    got = Counter((r.doc_id, r.component_id) for r in ngram_jaccard.near_groups(docs).collect())
    assert got == Counter({(5, 5): 2, (BIG, 5): 1, (BIG + 1, 8): 1, (None, 5): 1, (None, None): 2, (7, 7): 1, (8, 8): 1})


def test_rows_of_one_id_belong_together(spark):
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in ngram_jaccard.near_groups(df).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError):
        ngram_jaccard.near_groups(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_urls(spark):
    df = spark.createDataFrame([(1, "http://a.net/fr/" + "x" * 100_000), (None, None)], "page_id long, url string").select("*", *[F.lit(c).alias(c) for c in CLASH])
    out = url_filter.judge_urls(df, spark.createDataFrame(RULES, "rule string, action string"))
    assert {(r.page_id, r.rule, r["_keys"], r["_at"]) for r in out.collect()} == {(1, "net/fr/", "_keys", "_at"), (None, None, "_keys", "_at")}


def test_language(docs, spark):
    model = language_id.train(spark.createDataFrame([(i, "der die und" if i % 2 else "the of and", "de" if i % 2 else "en") for i in range(20)], "doc_id long, text string, lang string"))
    out = language_id.identify(docs, model)
    assert set(CLASH) <= set(out.columns) and out.count() == 9 and out.where("text is null").first().lang_pred == "und"
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_toxicity(docs, spark):
    labelled = [(i, f"{'you idiot' if i % 2 else 'a good day'} number {i}", i % 2) for i in range(40)]
    df = spark.createDataFrame(labelled, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out = toxicity.score(docs, model)
    assert set(CLASH) <= set(out.columns) and out.where("score between 0 and 1").count() == 9
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_conversations(spark):
    turns = spark.createDataFrame([(None, 1, "user", "a"), (None, 2, "assistant", None), (4, 1, "assistant", "b" * 50_000), (4, 1, "assistant", "b" * 50_000)], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_format.format_trees(chat_format.linear_nodes(turns)).collect()}
    assert set(out) == {None, 4} and out[None].n_turns == 2 and out[4].n_turns == 2
    assert chat_format.format_trees(chat_format.linear_nodes(turns.limit(0))).count() == 0


def test_mixing(docs):
    out = mixing.mix(docs.withColumn("source", F.lit(None).cast("string")), [5, 2, 1])
    assert out.count() == 9 and out.where("doc_id is null").count() == 3


def test_leaks_of_null_ids(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, rows[0][1]), (None, rows[3][1])], "item_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in decontamination.leaks(df, items).collect()) == Counter({(5, 1): 2, (BIG, 1): 1, (None, 1): 1})


def plain_tiling(a, b, least):
    """Tokens of ``a`` covered: the longest common run of unmarked tokens, first in a, then in b, again and again."""
    in_a, in_b, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in in_a and j + n not in in_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        in_a |= set(range(i, i + n))
        in_b |= set(range(j, j + n))
        covered += n


def test_tiling_against_a_plain_version(spark):
    rng = random.Random(9)
    items, texts = [], []
    for k in range(6):
        item = rng.choices("abcd", k=40)
        parts = [item[:13], item[20:33], item[8:24]]
        rng.shuffle(parts)
        items.append(item)
        texts.append([w for p in parts for w in [*rng.choices("abcd", k=5), *p]])
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    out = {(r.doc_id, r.item_id): r.covered for r in decontamination.leaks(df, spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string"), threshold=0.01).collect()}
    want = {(d, i): plain_tiling(a, b, 5) for d, b in enumerate(texts) for i, a in enumerate(items)}
    assert out == {k: n for k, n in want.items() if n}


def plain_simhash(text):
    words = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in text.split()]
    runs = [words[k : k + 5] for k in range(len(words) - 4)] if len(words) >= 5 else [words]
    votes = np.zeros(64, int)
    for run in runs:
        h = 42
        for w in run:
            h = xxhash.xxh64(w.to_bytes(8, "little"), seed=h).intdigest()
        votes += [1 if h >> k & 1 else -1 for k in range(64)]
    return sum(1 << k for k in range(64) if votes[k] > 0)


def test_fingerprints_against_a_plain_version(spark):
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (1, 3, 5, 6, 40, 300)] + ["é ñ é ñ é ñ"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(df, ["doc_id"]).collect()}
    assert got == {i: plain_simhash(t) for i, t in enumerate(texts)}


def test_near_query(spark, tmp_path):
    rng = random.Random(6)
    base = prose(rng, 200).split()
    texts = [(i, " ".join(base[:-1] + [f"end{i}"]) if i < 30 else prose(rng, 50)) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fps = {i: plain_simhash(t) for i, t in texts}
    want = {(i, f"{fps[i]:016x}", f"{o:016x}", bin(fps[i] ^ o).count("1")) for i in range(0, 60, 20) for o in set(fps.values()) if 0 < bin(fps[i] ^ o).count("1") <= 3}
    assert {tuple(r) for r in simhash_near(spark, str(tmp_path)).collect()} == want and want
