"""Texts of several chunks of 128 KiB each, against plain versions."""

import hashlib
import random

import pytest

from tallyforge.llm import ngram_jaccard, substring_dedup, suffix_dedup
from tallyforge.llm.batches import CHUNK_BYTES


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    base = [word() for _ in range(60_000)]
    copy = list(base)
    for i in rng.sample(range(len(copy)), 500):
        copy[i] = "changed"
    other = [word() for _ in range(50_000)]
    other[20_000:20_060] = base[59_900:59_960]
    found = [(1, " ".join(base)), (2, " ".join(copy)), (3, " ".join(other)), (4, "x" * 400_000), (5, " ".join(base[:40]))]
    assert min(len(t) for _, t in found[:4]) > 2 * CHUNK_BYTES
    return found


@pytest.fixture
def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_near_groups_of_long_texts(table, docs):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.near_groups(table).collect()}
    sets = {}
    for i, t in docs:
        w = t.split(" ")
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    assert 100 * len(sets[1] & sets[2]) >= 80 * len(sets[1] | sets[2])
    assert out == {i: (len(s), 1 if i == 2 else i) for i, s in sets.items()}


def test_word_repeats_of_long_texts(table, docs):
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(table).collect()}
    first = {}
    for i, t in docs:
        w, gone = t.split(" "), set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert out[i] == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i


def test_byte_repeats_of_long_texts(table, docs):
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(table).collect()}
    times: dict[bytes, int] = {}
    texts = {i: t.encode() for i, t in docs}
    names = {i: [hashlib.blake2b(b[k : k + 200], digest_size=12).digest() for k in range(len(b) - 199)] for i, b in texts.items()}
    for found in names.values():
        for x in found:
            times[x] = times.get(x, 0) + 1
    for i, b in texts.items():
        kept, until = bytearray(), 0
        for k in range(len(b)):
            if k < len(names[i]) and times[names[i][k]] > 1:
                until = k + 200
            if k >= until:
                kept.append(b[k])
        assert out[i] == (len(b), len(b) - len(kept), hashlib.sha256(bytes(kept)).hexdigest()), i
