"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = {"aa": "the of and tion ing er on".split(), "bb": "der die und ung keit sch ein".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    item = prose(rng, "aa", 40)
    passage = prose(rng, "aa", 60)
    texts = [(i, prose(rng, "aa" if i % 2 else "bb", rng.randint(60, 200))) for i in range(60)]
    base = prose(rng, "bb", 150).split()
    texts += [(70 + k, " ".join(["changed", *base[1:]] if k else base)) for k in range(4)] + [(74, texts[3][1]), (74, texts[3][1])]
    texts += [(80 + k, f"{prose(rng, 'aa', 50)} {passage} {prose(rng, 'aa', 50)}") for k in range(4)]
    texts += [(90, f"{prose(rng, 'aa', 50)} {item} {prose(rng, 'aa', 50)}"), (91, None), (92, ""), (93, "12 34 !?"), (94, passage)]
    rows = [(i, t, "aa" if t and "the" in t else "bb" if t else None, [None, "s1", "s2", "s3"][i % 4], len(t or "")) for i, t in texts]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", extra string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def shingles(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def without_copies(docs):
    """(id, text) of one document of each near-duplicate group."""
    sets = {i: shingles(t) for i, t in docs}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    return [(i, t) for i, t in docs if group[i] == i]


def without_repeats(docs):
    """(id, text's words): words in a window of 13 that a smaller id holds are gone."""
    words, first, out = {i: WORDS.findall(t) for i, t in docs}, {}, []
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    for i, w in words.items():
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        if not gone or len(gone) < len(w):
            out.append((i, [x for j, x in enumerate(w) if j not in gone]))
    return out


def test_stages_against_plain_versions(spark, folder, tmp_path):
    docs, after = corpus_pipeline.table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = [(r.doc_id, r.text) for r in docs.collect()]
    everyone = {r.doc_id: r.text for r in corpus_pipeline.table(spark, folder, "documents").collect()}
    named = after["language_id"]
    assert {i for i, _ in named} == set(everyone) - {91, 92, 93}, "texts without letters go, clean ones stay"
    assert sorted(set(after["ngram_jaccard"])) == sorted(set(without_copies(named)))
    want = without_repeats(after["ngram_jaccard"])
    assert sorted((i, WORDS.findall(t)) for i, t in after["substring_dedup"]) == sorted(want)
    assert 94 not in dict(after["substring_dedup"]), "a document that is only the passage goes"
    assert Counter(after["decontamination"]) == Counter((i, t) for i, t in after["substring_dedup"] if i != 90)
    copies = Counter((r.doc_id, r.text) for r in corpus_pipeline.run(spark, folder).collect())
    assert set(copies) <= set(after["decontamination"]) and max(copies.values()) <= 2
    assert {r.copy for r in corpus_pipeline.run(spark, folder).collect()} <= {1, 2}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
