"""Each operator against a plain version of it, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import chat_format, decontamination, language_id, ngram_jaccard, simhash, substring_dedup, suffix_dedup, toxicity, url_filter
from tallyforge.llm.batches import text_bytes
from tallyforge.llm.queries import RULES

SYLLABLES = "the of an re in on er th st ti ea ou ha nd at ing tion".split()
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    passage, base = prose(rng, 60), prose(rng, 150).split()
    docs = [(i, prose(rng, rng.randint(1, 120))) for i in range(40)]
    docs += [(40 + i, f"{prose(rng, 20)}\n{passage} {prose(rng, 15)}") for i in range(6)]
    for i in range(8):
        copy = list(base)
        for _ in range(i):
            copy[rng.randrange(len(copy))] = "changed"
        docs.append((60 + i, " ".join(copy)))
    docs += [(80, docs[3][1]), (81, docs[3][1]), (82, None), (83, ""), (84, " \t\n "), (85, "one two"), (86, "One  two"), (87, "a" * 3000), (88, "Ther " * 400), (89, passage + " " + passage), (90, "é" * 300 + prose(rng, 5)), (91, prose(rng, 6000))]
    return docs


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_urls(spark):
    urls = ["http://www.Example.com/en/1?x", "https://example.com/en/", "https://a.example.com/fr/x#y", "http://example.com", "x", None, "http://a.net/fr/2", "http://net/es/", "http://b.org/en/", "http://www.example.com/en", "http://notexample.com/en/1", "ftp://A.B.NET/es/", "http:///en/", "://com/"]
    out = {r.id: r for r in url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)) * 2, "id long, url string"), spark.createDataFrame(RULES, "rule string, action string")).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(r), r, a) for r, a in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == (host, path, rule, verdict), u


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = universe.where("key like '%7'")
    levels = url_filter.build_cascade(universe, keys, 3.0)
    assert len(levels) > 2
    rows = universe.select("key", *url_filter.hashed(F.col("key"))).toPandas()
    got = url_filter.listed(levels, rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64))
    assert (got == rows["key"].str.endswith("7").to_numpy()).all()
    with pytest.raises(ValueError):
        url_filter.build_cascade(universe, keys, 3.0, max_filter_bytes=8)


@pytest.mark.parametrize("bounds", [{}, {"hot_places": 4, "flush_rows": 60}])
def test_byte_repeats(spark, corpus, bounds):
    """Also with frequent cores split by distance, and in parts many times what a task may hold."""
    if bounds:
        assert len(suffix_dedup.hot_cores(frame(spark, corpus, "key long, text string"), bounds["hot_places"])) > 3
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, corpus), **bounds).collect()}
    texts = {i: (t or "").encode() for i, t in corpus}
    seen = Counter(b[k : k + 200] for b in texts.values() for k in range(len(b) - 199))
    for i, b in texts.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = out[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept), i


def test_word_repeats(spark, corpus):
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, corpus)).collect()}
    words = {i: WORDS.findall(t or "") for i, t in corpus}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        r = out[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), i
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed


def test_near_groups(spark, corpus):
    out = {r.doc_id: r for r in ngram_jaccard.near_groups(frame(spark, corpus)).collect()}
    sets = {}
    for i, t in corpus:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    for i in sets:
        assert (out[i].n_shingles, out[i].component_id) == (len(sets[i]), group[i]), i


def test_group_bound_opens_other_groups(spark, monkeypatch, corpus):
    """Links must not depend on the groups: with one for each node, all are found by the matrix."""
    want = sorted(map(tuple, ngram_jaccard.near_groups(frame(spark, corpus)).collect()))
    monkeypatch.setattr(ngram_jaccard, "similar_groups", lambda found: found.select("node", "n", F.col("node").alias("grp")))
    assert sorted(map(tuple, ngram_jaccard.near_groups(frame(spark, corpus)).collect())) == want
    assert len({c for _, _, c in want}) < len(want)


def test_overlap_bound_of_groups():
    """A query that shares tokens with a group is left out unless its overlap with the union reaches a link's."""
    rng = np.random.default_rng(2)
    rejected = 0
    for _ in range(200):
        base = rng.choice(10_000, 60, replace=False)
        near = lambda k: np.unique(np.concatenate([base[rng.permutation(60)[: 60 - k]], rng.choice(10_000, k)]))
        members = [(i, near(rng.integers(0, 6))) for i in range(rng.integers(1, 5))]
        queries = [(100 + i, near(rng.integers(0, 50))) for i in range(6)]
        kept = {q for q, _ in ngram_jaccard.reaching(members, queries)}
        for q, s in queries:
            shared = [len(np.intersect1d(s, m)) for _, m in members]
            linked = any(100 * c >= 80 * (len(s) + len(m) - c) for c, (_, m) in zip(shared, members, strict=True))
            assert not linked or q in kept
            rejected += max(shared) > 0 and q not in kept
    assert rejected > 300


def test_matrix_needs_the_sum(spark, monkeypatch):
    """Groups that share one probed token are no pair; those that share three are one, met in one of the ranges."""
    monkeypatch.setattr(ngram_jaccard, "RANGE_GROUPS", 2)
    probes = [(i, 20, [1000 + i, 5, *(range(10, 13) if i < 2 else [2000 + i, 3000 + i])], [20, 19, 18, 17, 16]) for i in range(9)]
    found = spark.createDataFrame(probes, "node long, n long, token array<long>, rest array<long>")
    member = found.select("node", "n", F.col("node").alias("grp"))
    comp = spark.createDataFrame([], "node long, comp long")
    assert [set(r) for r in ngram_jaccard.met_groups(found, member, comp).collect()] == [{0, 1}]
    short = spark.createDataFrame([(1, 1, [5], [1]), (2, 1, [5], [1]), (3, 9, [5], [9])], "node long, n long, token array<long>, rest array<long>")
    assert [set(r) for r in ngram_jaccard.met_groups(short, short.select("node", "n", F.col("node").alias("grp")), comp).collect()] == [{1, 2}]


def test_ranges_of_a_token_lose_no_link(spark, monkeypatch, corpus):
    want = sorted(map(tuple, ngram_jaccard.near_groups(frame(spark, corpus)).collect()))
    monkeypatch.setattr(ngram_jaccard, "RANGE_GROUPS", 1)
    monkeypatch.setattr(ngram_jaccard, "similar_groups", lambda found: found.select("node", "n", F.col("node").alias("grp")))
    assert sorted(map(tuple, ngram_jaccard.near_groups(frame(spark, corpus)).collect())) == want


def test_leaks(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 30)) for i in range(5)] + [(9, "too short"), (10, None)]
    w = items[1][1].split()
    docs = [(1, f"{prose(rng, 50)} {items[0][1].upper()}! {prose(rng, 40)}"), (2, " ".join(w[15:] + ["x"] + w[:15])), (3, prose(rng, 300)), (4, " ".join(w[:8]) + prose(rng, 20)), (5, None), (6, ""), (7, "too short"), (8, f"{items[2][1]} {items[3][1]}")]
    docs += [docs[0]]
    for most in (1 << 20, 300):
        out = decontamination.leaks(frame(spark, docs), frame(spark, items, "item_id long, text string"), max_part_bytes=most).collect()
        assert Counter((r.doc_id, r.item_id) for r in out) == Counter({(1, 0): 2, (2, 1): 1, (8, 2): 1, (8, 3): 1})
        assert next(r for r in out if r.doc_id == 2).coverage == 1.0


def test_tiles_take_the_longest_first():
    at = [(i, i) for i in range(6)] + [(2, 12), (3, 13)]
    got = decontamination.tiles(np.array([a for a, _ in at]), np.array([b for _, b in at]), 3)
    assert got == [(8, 0, 0)]


def test_language(spark):
    rng = random.Random(1)
    langs = {"aa": "the of and tion ing".split(), "bb": "der die und ung keit".split(), "cc": "le la eau ment é".split()}
    rows = [(i, "".join(rng.choices(langs[c], k=40)) if i % 9 else " ".join(rng.choices(langs[c], k=30)), c) for i in range(240) for c in [list(langs)[i % 3]]]
    model = language_id.train(frame(spark, rows[:200], "doc_id long, text string, lang string"))
    docs = frame(spark, [*rows[200:], (900, None, None), (901, "", "aa"), (902, "12 !?", None)], "doc_id long, text string, score string")
    out = {r.doc_id: r for r in language_id.identify(docs.drop("score"), model).collect()}
    assert all(out[i].lang_pred == c for i, _, c in rows[200:])
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902))
    none = language_id.train(frame(spark, [], "doc_id long, text string, lang string"))
    assert language_id.identify(docs, none).where("lang_pred <> 'und'").count() == 0


def test_code_lengths_match_a_plain_ppm():
    texts, query = {"x": "abracadabra", "y": "banana band"}, b"abandabraz"
    order, codes = 2, {"x": 0, "y": 1}
    keys, lang = [], []
    for name, t in texts.items():
        b = np.frombuffer(t.encode(), np.uint8)
        g = language_id.grams(b, np.array([0]), order)
        keys += list(g)
        lang += [codes[name]] * len(g)
    model = language_id.build_model(list(texts), np.array(keys, np.uint64), np.array(lang), np.ones(len(keys)), order)
    got = model.code_lengths(np.frombuffer(query, np.uint8), np.array([0, len(query)]))[0]
    for name, t in texts.items():
        counts = defaultdict(Counter)
        padded = b"\0" * order + t.encode()
        for i in range(order, len(padded)):
            for o in range(order + 1):
                counts[padded[i - o : i]][padded[i]] += 1
        bits, padded = 0.0, b"\0" * order + query
        for i in range(order, len(padded)):
            for o in range(order, -1, -1):
                seen = counts.get(padded[i - o : i])
                if not seen:
                    continue
                total, distinct = sum(seen.values()), len(seen)
                if padded[i] in seen:
                    bits -= np.log2(seen[padded[i]] / (total + distinct))
                    break
                bits -= np.log2(distinct / (total + distinct))
            else:
                bits += 8
        assert got[codes[name]] == pytest.approx(bits, rel=1e-5)


def test_toxicity_learns_and_tolerates_gaps(spark):
    rng = random.Random(2)
    insults = ["idiot", "worthless", "scoundrel"]
    rows, labels = [], []
    for i in range(300):
        w, bad = prose(rng, 40).split(), i % 3 == 0
        for _ in range(2 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = frame(spark, rows)
    model = toxicity.train(docs, frame(spark, labels, "doc_id long, toxic int"))
    new = [(1000, prose(rng, 40)), (1001, prose(rng, 20) + " idiot " + prose(rng, 20)), (1002, prose(rng, 20) + " i.d.i.o.t " + prose(rng, 20)), (1003, None), (1004, ""), (1005, prose(rng, 20) + " wor-thle-ss " + prose(rng, 9))]
    out = {r.doc_id: r for r in toxicity.score(frame(spark, new), model).collect()}
    assert out[1000].predicted == 0 and out[1001].predicted == 1
    assert out[1002].score > out[1000].score and out[1005].score > out[1000].score
    assert out[1003].score == out[1004].score == 0
    assert toxicity.train(docs, frame(spark, [(1, 1)], "doc_id long, toxic int")) is None
    assert toxicity.score(docs, None).where("score <> 0").count() == 0


def test_toxicity_sees_through_marks_and_two_inserted_characters():
    rng = random.Random(3)
    texts = [prose(rng, 40) for _ in range(300)]
    texts = [f"{t} {rng.choice(['idiot', 'scoundrel'])} {prose(rng, 9)}" if i % 3 == 0 else t for i, t in enumerate(texts)]
    model = toxicity.fit(texts, np.arange(300) % 3 == 0)
    marked = ["i!d!i!o!t", "idi!ot", "id;iot", "i?d?i?o?t", "i--d--i--o--t", "i!!d!!i!!o!!t", "s;c;o;u;n;d;r;e;l"]
    clean = [prose(rng, 30) for _ in range(40)]
    score = lambda texts: model.score(*text_bytes(pa.array(texts)))
    hidden = score([f"{prose(rng, 15)} {m} {prose(rng, 15)}" for m in marked])
    assert hidden.min() >= 0.5 > score(clean).max(), dict(zip(marked, hidden, strict=True))
    gapped = lambda text: {int(p) for place, _, valid in toxicity.subsequences(*toxicity.prepared(*text_bytes(pa.array([text])))) for p in place[valid]}
    assert gapped("idio") | gapped("diot") <= gapped("ixydxyixyoxyt")


def test_toxicity_joins_words():
    texts = ["i--d!i;ot!", "", "!a", None, "b-", "-c d", "é'é - x", "--"]
    data, offsets = toxicity.joined(*text_bytes(pa.array(texts)))
    assert [bytes(data[i:j]).decode() for i, j in zip(offsets[:-1], offsets[1:], strict=True)] == ["idiot!", "", "!a", "", "b-", "-c d", "éé - x", "--"]
    assert toxicity.joined(*text_bytes(pa.array(["", None])))[1].tolist() == [0, 0, 0]


def test_toxicity_sentence_ends():
    texts = ["a! b;c", "", "d?", "e\n\nf"]
    data, offsets = text_bytes(pa.array(texts))
    block = toxicity.prepared(data, offsets)[1][: len(data)]
    of = [block[i:j] - block[i] for i, j in zip(offsets[:-1], offsets[1:], strict=True) if j > i]
    assert [list(b) for b in of] == [[0, 1, 1, 1, 1, 1], [0, 1], [0, 1, 1, 1]]


def test_toxicity_learns_from_1500_of_each_class(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.append((int(toxic.sum()), len(texts))))
    toxicity.train(frame(spark, [(i, f"text {i}") for i in range(3200)]), frame(spark, [(i, i % 2) for i in range(3200)], "doc_id long, toxic int"))
    assert seen == [(1500, 3000)]


def test_toxicity_background_is_drawn_by_byte():
    at = toxicity.drawn_places(np.random.default_rng(1), np.array([0, 10, 10, 1000, 1900]), np.array([0, 1, 3]), 5000)
    assert ((at < 10) | (at >= 1000)).all() and at.max() < 1900 and 20 < (at < 10).sum() < 90


def test_simhash(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng, 80)) for i in range(30)] + [(30, None), (31, ""), (32, "a b"), (40, docs_text := prose(rng, 90)), (41, docs_text), (41, docs_text), (50, "éé ñ " * 9)]
    out = {r.doc_id: r for r in simhash.compare_edits(frame(spark, docs)).collect()}
    unique = sorted({(i, t or "") for i, t in docs})
    for k, (i, t) in enumerate(unique):
        after = unique[(k + 1) % len(unique)][1]
        m = len(t) // 4
        assert (out[i].n_chars, out[i].edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - m] + after[:m]).encode()).hexdigest()), i
    assert out[40].fingerprint == out[41].fingerprint and out[40].near_next == 1
    assert np.mean([out[i].near_edited for i in range(30)]) > np.mean([out[i].near_next for i in range(30)]) + 0.15
    assert simhash.compare_edits(frame(spark, [])).count() == 0


def test_simhash_search_finds_all(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = base + [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 3, 5)]
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = frame(spark, [(f,) for f in signed], "fp long")
    want = {(a, b) for a, x in zip(signed, fps, strict=True) for b, y in zip(signed, fps, strict=True) if bin(x ^ y).count("1") <= 3}
    assert {(r.fp, r.other) for r in simhash.near(df, df, 3).collect()} == want


def test_chat_trees(spark):
    nodes = [(1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b <|im_end|>~", 5.0), (1, 4, 3, "user", None, 0.0), (2, 1, 2, "user", "loop", 0.0), (2, 2, 1, "user", "loop", 0.0), (3, 7, 99, "a\nb", "x~1<|", 0.0)]
    df = frame(spark, nodes, "conv_id long, node_id long, parent_id long, role string, text string, score double")
    out = chat_format.format_trees(df, keep=2).withColumn("turns", chat_format.read_back(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {(r.conv_id, r.branch_rank): (r.leaf, [tuple(t) for t in r.turns], r.loss) for r in out.collect()}
    assert got == {(1, 1): (4, [("user", "hi"), ("assistant", "b <|im_end|>~"), ("user", "")], "b <|im_end|>~"), (1, 2): (2, [("user", "hi"), ("assistant", "a")], "a"), (3, 1): (7, [("a\nb", "x~1<|")], "")}


def test_long_conversation(spark):
    df = frame(spark, [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(100)], "conv_id long, turn long, role string, text string")
    r = chat_format.format_trees(chat_format.linear_nodes(df)).withColumn("turns", chat_format.read_back(F.col("formatted"))).first()
    assert [t.text for t in r.turns] == [f"t{i}" for i in range(100)]


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert suffix_dedup.remove_repeats(docs).count() == substring_dedup.remove_repeats(docs).count() == ngram_jaccard.near_groups(docs).count() == 0
    assert decontamination.leaks(docs, frame(spark, [], "item_id long, text string")).count() == 0
    assert url_filter.judge_urls(frame(spark, [], "id long, url string"), spark.createDataFrame(RULES, "rule string, action string")).count() == 0


def test_held_out_matches_crc(spark):
    from tallyforge.llm.shared import held_out

    rows = spark.range(50).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_text_bytes_of_slices():
    from tallyforge.llm.batches import text_bytes, words

    a = pa.array(["ab c", None, "", "d  ef"]).slice(1)
    data, offsets = text_bytes(a)
    assert bytes(data) == b"d  ef" and offsets.tolist() == [0, 0, 0, 5]
    start, end, first = words(data, offsets)
    assert [bytes(data[s:e]) for s, e in zip(start, end, strict=True)] == [b"d", b"ef"] and first.tolist() == [0, 0, 0, 2]
