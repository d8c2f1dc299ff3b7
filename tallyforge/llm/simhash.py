"""SimHash fingerprints and Hamming search, with DataFrame functions only.

The terms of a text are its shingles of five words (all its words, if fewer), each weighted by how
often it occurs. Every term's 64-bit hash votes on 64 signed bits. Two vote counters share a 64-bit
sum (32 bits each), so 32 sums hold all votes of a document.

``near`` finds every fingerprint within ``radius`` bits: the bits are cut in blocks, and for each
choice of ``blocks - radius`` of them a table is keyed by those blocks permuted to the front. Two
fingerprints within the radius agree on all blocks but ``radius``, so they meet in some table.

Defined cases: null text is empty; a null doc_id comes before all others; texts of any length are whole; other columns are
not returned; a text without words has fingerprint 0; rows with the same id and
text are one document; the last document's successor is the first, a lone one is its own; documents
of one id are ordered by text; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS, SHINGLE = 64, 5
#: Ranges of ids for the successor of each document: bounded, about this many documents each.
RANGE_ROWS, MAX_RANGES = 2_000, 4_095


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fp`` (bigint) for every row that has a word; the keys must be unique."""
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = texts.select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("_h")).where(F.size("_h") > 0)
    rows = rows.select(*keys, "_h", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_h") - SHINGLE, F.lit(0)))).alias("_i"))
    term = F.when(F.size("_h") >= SHINGLE, F.xxhash64(*[F.get("_h", F.col("_i") + j) for j in range(SHINGLE)])).otherwise(F.xxhash64("_h"))
    lanes = [F.sum(F.shiftright("_term", j).bitwiseAND(F.lit(0x0000000100000001))).alias(f"v{j}") for j in range(32)]
    votes = rows.select(*keys, term.alias("_term")).groupBy(*keys).agg(F.count("*").alias("_n"), *lanes)
    low = [F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF)) for j in range(32)]
    high = [F.shiftrightunsigned(f"v{j}", 32) for j in range(32)]
    bits = [F.when(v * 2 > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")) for j, v in enumerate(low + high)]
    return votes.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.coalesce(fp, F.lit(0).cast("long")))), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, about 0.5 for unrelated texts."""
    zero = F.lit(0).cast("long")
    return 1 - F.bit_count(F.coalesce(a, zero).bitwiseXOR(F.coalesce(b, zero))) / F.lit(float(BITS))


def with_next(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) with next_id and next_text, in order of id.

    Rows are dealt by ranges of ids; each range also gets the first row of the range after it, so
    no window spans more than one range and texts are shuffled once.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = docs.count()
    ranges = min(MAX_RANGES, n // RANGE_ROWS + 1)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0] or [0]
    cuts = sorted(set(cuts))
    steps = F.array(*[F.lit(2**k) for k in reversed(range(len(cuts).bit_length()))])
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    deal = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(bounds, at + s - 1) < F.col("doc_id"), at + s).otherwise(at))
    dealt = docs.select(deal.alias("range"), "doc_id", "text", F.lit(False).alias("guest"))
    firsts = sorted(dealt.groupBy("range").agg(F.min("doc_id")).collect())
    guests = docs.sparkSession.createDataFrame([(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))], "first_id long, range int")
    guests = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("range").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.lit(True).alias("guest"))
    dealt = dealt.unionByName(guests)
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    after = F.lead(F.struct("doc_id", "text", "guest")).over(order)
    rows = dealt.withColumn("after", after).where("not guest and not (after.doc_id <=> doc_id and after.text = text and not after.guest)")
    return rows.select("doc_id", "text", F.col("after.doc_id").alias("next_id"), F.col("after.text").alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - quarter), F.substr(next_text, F.lit(1), quarter))


def compare_edits(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and the likeness of both and of its successor."""
    rows = with_next(docs).withColumn("h", F.xxhash64("text")).withColumn("edit", edited(F.col("text"), F.col("next_text")))
    facts = rows.select("doc_id", "h", "next_id", F.xxhash64("next_text").alias("next_h"), F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edit"), 256).alias("edited_sha256"))
    both = rows.select("doc_id", "h", F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edit").alias("text")))).alias("x")).select("doc_id", "h", "x.*")
    fps = fingerprints(both, ["doc_id", "h", "kind"]).groupBy("doc_id", "h").agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("fp_edited"))
    after = fps.select(F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"), F.col("fp").alias("fp_next"))
    out = facts.join(fps, ["doc_id", "h"], "left").join(after, ["next_id", "next_h"], "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("fp_edited")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("fp_edited")).alias("near_edited"), likeness(F.col("fp"), F.col("fp_next")).alias("near_next"),
    )


def near(queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All (fp, other, distance) with distance <= radius, between distinct fingerprints of two (fp) tables.

    Equal fingerprints are one row here, however many documents carry them.
    """
    if not radius < blocks <= BITS:
        raise ValueError("there must be more blocks than the radius")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in keep) for keep in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("block")) for t, m in enumerate(signed)])
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(tables).alias("k")).select(name, "k.*")

    met = keyed(queries, "fp").join(keyed(corpus, "other"), ["t", "block"])
    differ = F.col("fp").bitwiseXOR(F.col("other"))
    # Of the tables in which two fingerprints meet, the first alone gives the pair.
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(signed)])
    return met.where((F.bit_count(differ) <= radius) & (F.col("t") == first)).select("fp", "other", F.bit_count(differ).alias("distance"))
