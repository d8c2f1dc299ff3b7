from collections import defaultdict

from pyspark.sql import functions as F

from tallyforge.llm import mixing


def targets_by_hand(sizes, weights, share, cap):
    """Give out by weight; take back what is over the cap; repeat."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got = dict.fromkeys(order, 0.0)
    left = sum(sizes.values()) * share
    while left > 1e-9:
        open_ = [s for s in order if got[s] < cap * sizes[s] - 1e-9]
        if not open_:
            break
        total = sum(w[s] for s in open_)
        give = {s: left * w[s] / total for s in open_}
        for s in open_:
            got[s] = min(cap * sizes[s], got[s] + give[s])
        left = sum(sizes.values()) * share - sum(got.values())
    return got


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, [5, 2, 1]).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = targets_by_hand(sizes, [5, 2, 1], 1.5, 2.0)
    taken = defaultdict(int)
    for r in out:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, target in want.items():
        most = max((len((t or "").split()) for _, t, x in rows if x == s), default=0)
        assert abs(taken[s] - target) <= 3 * most + 1


def test_targets_and_copies(spark):
    rows = [(i, "w " * (i % 37), f"s{i % 5}" if i % 5 else "hot") for i in range(400)] + [(1000 + i, "w " * 9, "hot") for i in range(300)]
    check(spark, rows)


def test_hard_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x y", None), (3, "x y", None), (4, "z " * 5000, "c"), (5, " \t\n", "a")]
    check(spark, rows)


def test_uneven_sources(spark):
    check(spark, [(i, "w " * 10, "a" if i < 300 else f"b{i}") for i in range(330)])


def test_reruns_agree_and_split_groups_keep_the_order(spark):
    docs = spark.range(200).select((F.col("id") * F.col("id")).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("one").alias("source"), F.lit("x").alias("t0"))
    docs = docs.unionByName(spark.createDataFrame([(None, "d e f", "one", "y"), (9, "d e f", "one", "y")], "doc_id long, text string, source string, t0 string"))
    a, b, split = (sorted(map(str, mixing.mix(docs, [1], share=1.3, ties=("text",), group_rows=n).collect())) for n in (50_000, 50_000, 7))
    assert a == b == split and len(a) == 202


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string"), [5, 2, 1]).count() == 0
