"""Near-duplicate groups: 5-word shingle sets linked at a Jaccard similarity of 0.8, by a token-group matrix.

1. Equal sets become one node; only its smallest row goes on.
2. Shared tokens: each set's least-hashed quarter of shingles meets those of all other sets. A set
   that a link could reach shares more than ``shared_needed`` of them; the rest are done.
3. Token order: rare tokens first, by exact counts over the remaining nodes. A set with more tokens of its own
   than a link allows is done. Of the others the first ``missing + NEEDED`` tokens are probed: two
   linked sets have their first ``NEEDED`` common tokens there (all of them, if they are fewer).
4. Groups: similar nodes, those with the same min-hash. Each node goes with the most frequent of its
   min-hashes, and a group that is too large for a task is split. A group is opened at once:
   its members are compared with each other.
5. Token-group matrix: (token, group) for the union of each group's probed tokens, with the sizes and the longest
   remainders of its holders. The tokens that two groups share are summed, each if its shorter remainder allows an
   overlap of 80% of the union; a sum below that of any link ends the pair, and so does one component. A token
   with many groups is met in ranges of groups, so that no task has all its pairs.
6. The smaller group's members are the queries of the larger one: each one's overlap with the union of all the group's
   tokens bounds its overlap with any member. Only a group that a query reaches is opened, for these queries alone,
   which are compared exactly. A task returns each node's component there, never the pairs.

Every link lies in a group or between two groups whose shared tokens reach the bound, so components are complete.

Defined cases: texts with fewer than five words are one shingle; null text and text without words have
an empty set, link with nothing and keep their own id; rows of one doc_id belong to one component whatever their
texts; rows with a null id are told apart by their text, and a component of such rows alone has a null
component_id; ids are integers; texts of any length are whole; an empty table gives an empty result; other columns
than doc_id and text are not used and not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import LOWER, SpanHash, chunks, give_back, gram_hash, mixed, text_bytes, words
from tallyforge.llm.exchange import HOME, SLICES, bucket_count, by_ids, gathered, home, met, send, signed, split
from tallyforge.llm.shared import NO_ID, doc_key, fewer_rows, saved

SHINGLE, PERCENT = 5, 80
MIN_HASHES = 4
#: A token of this share of the nodes comes last in the token order without being counted; the list is bounded by its inverse.
FREQUENT, SAMPLE = 0.002, 20_000
#: Tokens and members of one group, and tokens of the partners that one task compares with it.
GROUP_TOKENS, GROUP_DOCS, PARTNER_TOKENS = 1 << 20, 1_024, 1 << 22
COUNT_TOKENS = 1 << 22
#: Common tokens that two linked sets must have among those probed, and the groups of one range of a token.
NEEDED, RANGE_GROUPS = 3, 256


def missing(n):
    """The most tokens of a set of n that a linked set can lack: n - ceil(0.8 n)."""
    return n * (100 - PERCENT) // 100


def reach(common, n, least):
    """Whether sets of n tokens, that share at most ``common`` of them with any set of a group, can link with
    one, if none there has fewer than ``least``."""
    return (common * 100 >= n * PERCENT) & (common * (100 + PERCENT) >= (n + least) * PERCENT)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first): text i has the distinct, ascending tokens first[i]:first[i + 1]."""
    start, end, first = words(data, offsets)
    h = SpanHash(LOWER[data]).of(start, end)
    n = np.diff(first)
    grams = gram_hash(h, SHINGLE)
    text = np.repeat(np.arange(len(n)), np.maximum(n - SHINGLE + 1, 0))
    at = np.arange(len(text)) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(np.maximum(n - SHINGLE + 1, 0))[:-1]]), np.maximum(n - SHINGLE + 1, 0))
    token = grams[at]
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    short = np.array([int(mixed(np.bitwise_xor.reduce(mixed(h[first[i] : first[i + 1]] + np.arange(1, n[i] + 1, dtype=np.uint64)), keepdims=True))[0]) for i in few], np.uint64)
    text, token = np.concatenate([text, few]), np.concatenate([token, short])
    order = np.lexsort((token, text))
    text, token = text[order], token[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1])
    text, token = text[new], token[new]
    return token, np.searchsorted(text, np.arange(len(n) + 1))


def nodes_of(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; sets are told apart by these 64 bits."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(token + np.uint64(77)), dtype=np.uint64)])
    return signed(mixed(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))


def find_prefix(data, offsets, _):
    """The least tokens of each set, as many as step 2 sends; a place carries the set's size."""
    token, first = shingles(data, offsets)
    n = np.diff(first)
    take = np.minimum(n, missing(n) * 5 // 4 + 1)
    text = np.repeat(np.arange(len(n)), take)
    at = np.arange(len(text)) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(take)[:-1]]), take)
    return token[at], np.zeros(len(at), np.uint64), nodes_of(token, first)[text], n[text]


def shared_needed(n: Column) -> Column:
    """Of the tokens that step 2 sends, those that a linked set must hold."""
    lacking = F.floor(n * (100 - PERCENT) / 100)
    return F.least(n, F.floor(lacking * 5 / 4) + 1) - lacking


def survivors(texts: DataFrame, buckets: int) -> DataFrame:
    """(doc): nodes of ``texts`` (row_key, text) that share enough of their least tokens to have a link."""
    shared = met(send(texts, find_prefix, "docs", buckets), "docs", buckets)
    return saved(shared.where(F.size("at") >= shared_needed(F.array_min("at"))).select("doc"))


def set_sizes(texts: DataFrame) -> DataFrame:
    """(doc_id, key, row_key, node, n) for every row of ``texts`` (doc_id, key, row_key, text)."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in chunks(*text_bytes(batch.column(3))):
                token, first = shingles(data, offsets)
                yield pa.record_batch([*(c.slice(i, j - i) for c in batch.columns[:3]), pa.array(nodes_of(token, first)), pa.array(np.diff(first).astype(np.int64))], ["doc_id", "key", "row_key", "node", "n"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return fewer_rows(texts).mapInArrow(run, f"doc_id {kind}, key long, row_key long, node long, n long")


def token_sets(texts: DataFrame) -> DataFrame:
    """(node, n, tokens, least) of ``texts`` (text): the sets and their min-hashes."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in chunks(*text_bytes(batch.column(0))):
                token, first = shingles(data, offsets)
                n = np.diff(first)
                least = np.zeros((len(n), MIN_HASHES), np.int64)
                some = np.flatnonzero(n)
                for k in range(MIN_HASHES if len(some) else 0):
                    least[some, k] = signed(np.minimum.reduceat(mixed(token ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)), first[some]))
                columns = [pa.array(nodes_of(token, first)), pa.array(n.astype(np.int64)), split(signed(token), first, pa.int64()), split(least.ravel(), np.arange(len(n) + 1) * MIN_HASHES, pa.int64())]
                yield pa.record_batch(columns, ["node", "n", "tokens", "least"])

    return texts.select("text").mapInArrow(run, "node long, n long, tokens array<long>, least array<long>")


def frequent_tokens(sets: DataFrame, total: int) -> np.ndarray:
    """Tokens of over FREQUENT of the nodes, going by a sample where they are many: they come last
    in the token order, by their hash. Any order is right, so a sample costs speed at most."""
    sample = sets.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(max(1, total // SAMPLE))) == 0)
    least = max(8, FREQUENT * min(total, SAMPLE))
    found = sample.select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") > least).select("token").toPandas()
    return np.sort(found["token"].to_numpy(np.int64))


def token_counts(sets: DataFrame, often: np.ndarray, buckets: int) -> DataFrame:
    """(doc, at, until): for each node the places of its tokens that other nodes have too, and how many nodes have them."""
    held = sets.sparkSession.sparkContext.broadcast(often)

    def send_tokens(batches):
        parts, n = [], 0

        def out():
            token, doc, at = (np.concatenate(p) for p in zip(*parts, strict=True))
            bucket = (mixed(token.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            names, first = np.unique(bucket[order], return_index=True)
            cuts = np.append(first, len(order))
            yield pa.record_batch([pa.array(names), *(split(c[order], cuts, k) for c, k in ((token, pa.int64()), (doc, pa.int64()), (at, pa.int32())))], ["bucket", "token", "doc", "at"])

        for batch in batches:
            size, token = batch.column(1).value_lengths().to_numpy(), batch.column(1).flatten().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            place = (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
            go = ~np.isin(token, held.value)
            parts.append((token[go], batch.column(0).to_numpy()[row[go]], place[go]))
            n += int(go.sum())
            if n >= 500_000:
                yield from out()
                parts, n = [], 0
        if n:
            yield from out()

    def count(batches):
        got = [[batch.column(c).flatten().to_numpy() for c in (1, 2, 3)] for batch in batches]
        if got:
            whole = [np.concatenate(c) for c in zip(*got, strict=True)]
            got.clear()
            slices = mixed(whole[0].view(np.uint64)) // np.uint64(buckets) % np.uint64(SLICES)
            for s in range(SLICES):
                token, doc, at = (c[slices == s] for c in whole)
                order = np.argsort(token, kind="stable")
                new = np.ones(len(token), bool)
                new[1:] = token[order][1:] != token[order][:-1]
                size = np.diff(np.append(np.flatnonzero(new), len(order)))
                many = np.repeat(size >= 2, size)
                yield from home(doc[order][many], at[order][many], np.repeat(size, size)[many], buckets)
        give_back()

    sent = fewer_rows(sets.select("node", "tokens"), 200).mapInArrow(send_tokens, "bucket int, token array<long>, doc array<long>, at array<int>")
    return gathered(sent.repartition(buckets, "bucket").mapInArrow(count, HOME), buckets)


def probes(sets: DataFrame, counts: DataFrame, often: np.ndarray) -> DataFrame:
    """(node, n, least, token, rest) of nodes that may have a link: the probed tokens that others have
    too, and for each how many tokens of the set, itself included, come from it on in the order."""
    held = sets.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        for batch in batches:
            node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            token, at = batch.column(2).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            start = np.cumsum(n) - n
            row = np.repeat(np.arange(len(n)), n)
            met_by = np.ones(len(token), np.int64)
            met_by[np.repeat(start, batch.column(4).value_lengths().fill_null(0).to_numpy()) + at] = batch.column(5).flatten().to_numpy()
            met_by[np.isin(token, held.value)] = 1 << 40
            order = np.lexsort((token, met_by, row))
            token, met_by, place = token[order], met_by[order], np.arange(len(row)) - start[row]
            alive = np.bincount(row, met_by > 1, len(n)) >= n - missing(n)
            keep = alive[row] & (met_by > 1) & (place < missing(n)[row] + NEEDED)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(n)))])
            rows = pa.record_batch([pa.array(node), pa.array(n), batch.column(3), split(token[keep], cuts, pa.int64()), split((n[row] - place)[keep], cuts, pa.int64())], ["node", "n", "least", "token", "rest"])
            yield rows.filter(pa.array(alive))

    joined = sets.join(counts, F.col("node") == F.col("doc"), "left").select("node", "n", "tokens", "least", "at", "until")
    return fewer_rows(joined, 200).mapInArrow(run, "node long, n long, least array<long>, token array<long>, rest array<long>")


def similar_groups(found: DataFrame) -> DataFrame:
    """(node, n, grp) of ``found`` (node, n, least): each node with the most frequent of its min-hashes."""
    keys = found.select("node", "n", F.posexplode("least").alias("k", "key"))
    size = keys.groupBy("k", "key").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("tokens") / GROUP_TOKENS), F.ceil(F.col("m") / GROUP_DOCS))
    best = keys.join(size, ["k", "key"]).groupBy("node", "n").agg(F.max(F.struct("m", "k", "key", parts.alias("parts"))).alias("b"))
    return best.select("node", "n", F.xxhash64("b.k", "b.key", F.pmod(F.xxhash64("node", F.lit("part")), F.col("b.parts"))).alias("grp"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Tokens in common of every set of ``a`` with every set of ``b`` (or of ``a``)."""
    sides = []
    for s in (a, b) if b is not None else (a,):
        sides.append((np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])))
    if b is None:
        token, n = np.unique(sides[0][0], return_counts=True)
        token = token[n > 1]
        sides *= 2
    else:
        token = np.intersect1d(*(s[0] for s in sides))
    out = np.zeros((len(a), len(a if b is None else b)), np.float32)
    placed = []
    for t, row in sides:
        at = np.searchsorted(token, t)
        ok = at < len(token)
        ok[ok] = token[at[ok]] == t[ok]
        order = np.argsort(at[ok], kind="stable")
        placed.append((at[ok][order], row[ok][order]))
    for lo in range(0, len(token), 4_096):
        width = min(4_096, len(token) - lo)
        dense = []
        for (at, row), height in zip(placed, out.shape, strict=True):
            i, j = np.searchsorted(at, [lo, lo + width])
            bits = np.zeros((height, width), np.float32)
            bits[row[i:j], at[i:j] - lo] = 1
            dense.append(bits)
            if b is None:
                dense.append(bits)
                break
        out += dense[0] @ dense[1].T
    return out


def joined_nodes(a: list[tuple[int, np.ndarray]], b: list[tuple[int, np.ndarray]] | None) -> tuple[np.ndarray, np.ndarray]:
    """(node, other): each node of the two lists with the first of its component, by links between
    the lists (or within the first); exact."""
    both = a + (b or [])
    size = np.array([len(x[1]) for x in both], np.float32)
    right = slice(len(a), len(both)) if b is not None else slice(0, len(a))
    common = overlaps([x[1] for x in a], None if b is None else [x[1] for x in b]).astype(np.float64)
    linked = common * 100 >= (size[: len(a), None] + size[None, right] - common) * PERCENT
    x, y = np.nonzero(linked)
    y = y + right.start
    label = np.arange(len(both))
    while True:
        now = label.copy()
        np.minimum.at(now, x, label[y])
        np.minimum.at(now, y, label[x])
        now = now[now]
        if (now == label).all():
            break
        label = now
    moved = np.flatnonzero(label != np.arange(len(both)))
    node = np.array([v[0] for v in both], np.int64)
    return node[moved], node[label[moved]]


def reaching(members: list[tuple[int, np.ndarray]], queries: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
    """The queries whose overlap with the union of the members' tokens allows a link with a member."""
    union = np.unique(np.concatenate([m[1] for m in members]))
    size = np.array([len(q[1]) for q in queries])
    token = np.concatenate([q[1] for q in queries])
    held = union[np.minimum(np.searchsorted(union, token), len(union) - 1)] == token
    common = np.bincount(np.repeat(np.arange(len(queries)), size), held, len(queries))
    return [queries[i] for i in np.flatnonzero(reach(common, size, min(len(m[1]) for m in members)))]


def opened(rows: DataFrame) -> DataFrame:
    """(a, b): nodes that links in the opened groups join. ``rows``: (grp, guest, node, tokens); members
    of a group are compared with those of its guests that reach its union, or with each other where it has none."""

    def run(batches):
        name, sides, held, begun = None, ([], []), 0, False

        def out():
            some = reaching(*sides) if sides[1] and sides[0] else []
            if some or not sides[1] and len(sides[0]) > 1 and not begun:
                a, b = joined_nodes(sides[0], some or None)
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            grp, guest, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            lists = batch.column(3)
            cuts, token = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i in range(len(grp)):
                if grp[i] != name:
                    yield from out()
                    name, sides, held, begun = grp[i], ([], []), 0, False
                elif guest[i] and held >= GROUP_TOKENS:
                    yield from out()
                    sides, held, begun = (sides[0], []), 0, True
                own = token[cuts[i] : cuts[i + 1]].copy()
                sides[int(guest[i])].append((int(node[i]), own))
                held += len(own) if guest[i] else 0
        yield from out()

    dealt = rows.select("grp", "guest", "node", "tokens").repartition("grp").sortWithinPartitions("grp", "guest")
    return fewer_rows(dealt, 200).mapInArrow(run, "a long, b long")


def met_groups(found: DataFrame, member: DataFrame, comp: DataFrame) -> DataFrame:
    """(grp, other): pairs of groups that may have a link, from the token-group matrix."""
    whole = member.join(comp, "node", "left").groupBy("grp").agg(F.sum("n").alias("tokens"), F.min("n").alias("small"), F.min(F.coalesce("comp", "node")).alias("low"), F.max(F.coalesce("comp", "node")).alias("high"))
    whole = whole.select("grp", "tokens", "small", F.when(F.col("low") == F.col("high"), F.col("low")).alias("one"))
    held = found.select("node", "n", F.explode(F.arrays_zip("token", "rest")).alias("p")).select("node", "n", "p.*").join(member.select("node", "grp"), "node")
    matrix = saved(held.groupBy("token", "grp").agg(F.max("rest").alias("rest"), F.min("n").alias("least"), F.max("n").alias("most")).join(whole, "grp"))
    # A token of many groups has ranges of them; each pair of ranges is a key of the join.
    wide = matrix.groupBy("token").count().where(F.col("count") > RANGE_GROUPS).select("token", F.ceil(F.col("count") / RANGE_GROUPS).alias("ranges"))
    matrix = matrix.join(wide, "token", "left").withColumn("ranges", F.coalesce("ranges", F.lit(1).cast("long")))
    own, other = F.pmod(F.xxhash64("grp", F.lit("range")), F.col("ranges")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1))
    names = [c for c in matrix.columns if c not in ("token", "ranges")]
    left = matrix.select("token", own.alias("x"), other.alias("y"), *(F.col(c).alias(c + "a") for c in names))
    right = matrix.select("token", other.alias("x"), own.alias("y"), *(F.col(c).alias(c + "b") for c in names))
    # Up to NEEDED - 1 common tokens of a link come before a token whose remainder is looked at.
    rest = F.least("resta", "restb") + NEEDED - 1
    near = (F.col("mosta") * 100 >= F.col("leastb") * PERCENT) & (F.col("mostb") * 100 >= F.col("leasta") * PERCENT) & (rest * (100 + PERCENT) >= (F.col("leasta") + F.col("leastb")) * PERCENT)
    met_at = left.join(right, ["token", "x", "y"]).where(F.col("grpa") < F.col("grpb")).where(near).where(F.coalesce(F.col("onea") != F.col("oneb"), F.lit(True)))
    both = F.greatest("smalla", "smallb")
    pairs = met_at.groupBy("grpa", "grpb", "tokensa", "tokensb", "smalla", "smallb").count().where(F.col("count") >= F.least(F.lit(NEEDED), F.ceil(both * PERCENT / 100)))
    larger = F.col("tokensa") >= F.col("tokensb")
    return pairs.select(F.when(larger, F.col("grpa")).otherwise(F.col("grpb")).alias("grp"), F.when(larger, F.col("grpb")).otherwise(F.col("grpa")).alias("other"))


def guests(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """(grp, guest, node): the tasks of step 6; a group with many guests is several tasks."""
    coming = saved(pairs.join(member.withColumnRenamed("grp", "other"), "other").select("grp", "node", "n"))
    parts = coming.groupBy("grp").agg(F.ceil(F.sum("n") / PARTNER_TOKENS).alias("parts"))
    coming = coming.join(parts, "grp").select(F.xxhash64("grp", F.pmod(F.xxhash64("node", F.lit("guest")), F.col("parts"))).alias("task"), F.lit(True).alias("guest"), "node")
    hosts = parts.join(member, "grp").select("grp", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return coming.unionByName(hosts.select(F.xxhash64("grp", "part").alias("task"), F.lit(False).alias("guest"), "node")).withColumnRenamed("task", "grp")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the least node that each node of ``links`` (a, b) reaches."""
    edges = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    comp = saved(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).select(F.col("a").alias("node"), "comp"))
    while True:
        around = edges.join(comp.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = comp.join(around, "node").select("node", F.least("comp", "near").alias("now"), F.col("comp").alias("was"))
        jump = step.select(F.col("node").alias("now"), F.col("now").alias("far"))
        step = saved(step.join(jump, "now").select("node", F.least("now", "far").alias("comp"), "was"))
        moved = step.where("comp <> was").limit(1).count()
        comp = step.select("node", "comp")
        if not moved:
            return comp


def links_of(texts: DataFrame, nodes: DataFrame, buckets: int) -> DataFrame:
    """(a, b): pairs of nodes that join all linked sets of ``texts`` (row_key, text). ``nodes``: (node, row_key)."""
    alive = survivors(texts, buckets)
    alive = saved(nodes.join(alive, F.col("node") == F.col("doc"), "left_semi").select(F.col("row_key").alias("doc")))
    some, _ = by_ids(texts, alive, F.col("row_key"))
    sets = saved(token_sets(some.join(alive, F.col("row_key") == F.col("doc"), "left_semi").dropDuplicates(["row_key"])))
    total, tokens = sets.agg(F.count("*"), F.sum("n")).first()
    often = frequent_tokens(sets, total)
    counts = token_counts(sets, often, max(buckets, (tokens or 0) // COUNT_TOKENS + 1))
    found = saved(probes(sets, counts, often))
    member = saved(similar_groups(found))
    many = member.groupBy("grp").count().where("count > 1")
    own = member.join(many, "grp", "left_semi").select("grp", F.lit(False).alias("guest"), "node")
    tokens_of = sets.select("node", "tokens")
    first = saved(opened(own.join(tokens_of, "node")))
    pairs = saved(met_groups(found.select("node", "n", "token", "rest"), member, components(first)))
    return first.unionByName(saved(opened(guests(pairs, member).join(tokens_of, "node"))))


def near_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, comp) for every row of ``docs``: its key (see ``doc_key``), set size and the least key of its component."""
    n, key = bucket_count(docs), doc_key(docs)
    texts = docs.select("doc_id", key.alias("key"), F.xxhash64(key, "text").alias("row_key"), "text")
    sizes = saved(set_sizes(texts))
    full = sizes.where("n > 0")
    nodes = saved(full.groupBy("node").agg(F.min(F.struct("key", "row_key")).alias("r"), F.count("*").alias("m")).select("node", "r.*", "m"))
    copies = full.join(nodes.where("m > 1").select("node", F.col("row_key").alias("kept")), "node").where("row_key <> kept").select(F.col("row_key").alias("doc")).distinct()
    copies = saved(copies)
    some, none = by_ids(texts, copies, F.col("row_key"))
    ones = some.join(copies, F.col("row_key") == F.col("doc"), "left_anti").unionByName(none).select("row_key", "text")
    links = links_of(ones, nodes, n)
    # Rows of one id belong together.
    twice = full.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("key")
    twice = full.join(twice, "key").select("key", "node").distinct()
    ties = twice.join(twice.groupBy("key").agg(F.min("node").alias("a")), "key").select("a", F.col("node").alias("b"))
    whole = components(links.unionByName(ties))
    reps = nodes.join(whole, "node", "left").select("node", "key", "m", F.coalesce("comp", "node").alias("c"))
    least = reps.join(whole.select("node"), "node", "left_semi").groupBy("c").agg(F.min("key").alias("comp"))
    moved = reps.join(least, "c", "left").select("node", F.coalesce("comp", "key").alias("comp"), "m", "key").where("comp <> key or m > 1").select("node", "comp")
    return full.join(moved, "node", "left").unionByName(sizes.where("n = 0").withColumn("comp", F.lit(None).cast("long"))).select("doc_id", "key", "n", F.coalesce("comp", "key").alias("comp"))


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    return near_keys(docs).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("comp") < NO_ID, F.col("comp")).alias("component_id"))
