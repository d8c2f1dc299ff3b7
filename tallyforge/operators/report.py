"""Per-entity report rows, their flags, sheet names and the run's summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyforge.operators.names import best_match
from tallyforge.operators.order import running
from tallyforge.sources.sinks import FIXED_SHEETS


def pairs_by_entity(cells: DataFrame, weights: DataFrame, ranking: DataFrame) -> DataFrame:
    """(a, b_rank, opponent, w, l, n, wr_real, p_hat, se_dir, se_binom, gap, weight, contrib), a row per opponent in
    ranking order; the entity's own row is a mirror of NULLs with weight 0.

    ``cells`` must have p_hat_pct, se_pct and se_binom_pct; ``weights``: (a, b, w_ab).
    """
    order = ranking.select(F.col("deck").alias("b"), F.col("rank").alias("b_rank"))
    rows = cells.join(weights, ["a", "b"], "left").join(F.broadcast(order), "b")
    off = F.col("a") != F.col("b")
    r2 = lambda c: F.bround(c, 2)
    weight = F.when(off, F.col("w_ab") * 100).otherwise(F.lit(0.0))
    contrib = F.when(off, F.col("w_ab") * F.col("p_hat_pct")).otherwise(F.lit(0.0))
    return rows.select(
        "a", "b_rank", F.when(off, F.col("b")).otherwise(F.lit("Mirror")).alias("opponent"), F.when(off, F.col("w")).alias("w"), F.when(off, F.col("l")).alias("l"), F.when(off, F.col("n_dir")).alias("n"),
        r2(F.when(off, F.col("wr"))).alias("wr_real"), r2(F.when(off, F.col("p_hat_pct"))).alias("p_hat"), r2(F.when(off, F.col("se_pct"))).alias("se_dir"), r2(F.when(off, F.col("se_binom_pct"))).alias("se_binom"),
        r2(F.when(off, F.col("p_hat_pct") - F.col("wr"))).alias("gap"), r2(weight).alias("weight"), r2(contrib).alias("contrib"),
    )


def pairs_view(pairs: DataFrame, counts: bool = True, posterior_se: bool = False, binom_se: bool = True, self_row: bool = True, weight: bool = False, contrib: bool = False, sort_by: str | None = None, mirror_label: str = "Mirror") -> DataFrame:
    """``pairs_by_entity`` with the columns and rows that a report shows.

    Rows stand in ranking order (b_rank), or by ``sort_by``, largest first and NULLs last, ties in ranking order: then
    b_rank is the row's place in its own sheet. A column that isn't shown can't sort.
    """
    off = {c for c, shown in [("w", counts), ("l", counts), ("n", counts), ("se_dir", posterior_se), ("se_binom", binom_se), ("weight", weight), ("contrib", contrib)] if not shown}
    mirror = F.col("opponent") == "Mirror"
    rows = pairs if self_row else pairs.where(~mirror)
    if sort_by is not None and sort_by not in off and sort_by in rows.columns:
        rows = rows.withColumn("b_rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc_nulls_last(sort_by), "b_rank")))
    rows = rows.withColumn("opponent", F.when(mirror, mirror_label).otherwise(F.col("opponent")))
    return rows.select([c for c in pairs.columns if c not in off])


def gap_flag(gap: Column) -> Column:
    return F.when(F.abs(gap) >= 8, "RED").when(F.abs(gap) >= 4, "YELLOW")


def styled(pairs: DataFrame, top_k: int = 5) -> DataFrame:
    """``pairs`` plus gap_flag, is_mirror and is_topk (by contribution, ties included)."""
    best = F.rank().over(Window.partitionBy("a").orderBy(F.desc_nulls_last("contrib")))
    return pairs.withColumns({"gap_flag": gap_flag(F.col("gap")), "is_mirror": F.col("opponent") == "Mirror", "is_topk": (best <= top_k) & F.col("contrib").isNotNull()})


def summary(ranking: DataFrame) -> DataFrame:
    shown = ["score", "mas", "lb", "bt", "se", "n_eff", "coverage_pct"]
    return ranking.select("rank", "deck", *[F.bround(c, 2).alias(c) for c in shown], "opp_used", "opp_total")


#: Decimal places of a shown ranking; all other numbers have none.
SHOWN_PLACES = {c: 2 for c in ("score", "mas", "lb", "bt", "se", "coverage_pct")}


def shown_ranking(ranking: DataFrame, top_n: int | None = 15, columns: list[str] | None = None, places: dict[str, int] | None = None) -> DataFrame:
    """The first ``top_n`` ranks (all for None or less than 1) as text for people: numbers grouped by thousands, with ``places``
    decimal places. ``columns`` that the ranking doesn't have are left out."""
    digits = SHOWN_PLACES | (places or {})
    rows = ranking.where(F.col("rank") <= top_n) if top_n and top_n > 0 else ranking
    names = [c for c in columns or ranking.columns if c in ranking.columns]
    text = {f.name: F.col(f.name) if isinstance(f.dataType, StringType) else F.format_number(f.name, digits.get(f.name, 0)) for f in ranking.schema}
    return rows.orderBy("rank").select(*[text[c].alias(c) for c in names])


def heatmap(cells: DataFrame, ranking: DataFrame, top_n: int = 20, mask_mirror: bool = False) -> DataFrame:
    """(a_rank, b_rank, a, b, wr): the rates among the ``top_n`` first (two at least), optionally without the upper triangle."""
    top_n = max(2, int(top_n))
    top = ranking.where(F.col("rank") <= top_n).select("deck", "rank")
    rows = cells.join(F.broadcast(top.select(F.col("deck").alias("a"), F.col("rank").alias("a_rank"))), "a").join(F.broadcast(top.select(F.col("deck").alias("b"), F.col("rank").alias("b_rank"))), "b")
    rows = rows.where("a_rank >= b_rank") if mask_mirror else rows
    return rows.select("a_rank", "b_rank", "a", "b", F.when(F.col("a") != F.col("b"), F.col("wr")).alias("wr"))


def sheet_names(names: DataFrame) -> DataFrame:
    """(deck, sheet): names that a workbook allows, unlike each other and the fixed sheets, case aside; later ones get a number.

    A numbered name keeps within 31 characters, and ``~`` in a clean name becomes ``-``, so that none can meet another.
    """
    clean = F.trim(F.substring(F.trim(F.replace(F.regexp_replace("deck", r"[\[\]:*?/\\]", ""), F.lit("~"), F.lit("-"))), 1, 31))
    rows = names.select("deck", F.when(clean == "", "Sheet").otherwise(clean).alias("base")).withColumn("key", F.lower("base"))
    taken = F.when(F.col("key").isin([s.lower() for s in FIXED_SHEETS]), 1).otherwise(0)
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("deck")) + taken)
    number = F.col("n").cast("string")
    return rows.select("deck", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat(F.substr("base", F.lit(1), 30 - F.length(number)), F.lit("~"), number)).alias("sheet"))


def sheet_order(sheets: DataFrame, decks: DataFrame) -> DataFrame:
    """(sheet, place): fixed sheets, then sheets in the order of ``decks`` (deck, ord) by their best match
    (equal, then prefix, then contained; see ``names.best_match``), then the rest."""
    fixed = F.col("sheet").isin(*FIXED_SHEETS)
    rows = sheets.join(best_match(sheets.where(~fixed), decks).hint("merge"), "sheet", "left").withColumn("grp", F.when(fixed, 0).when(F.col("ord").isNotNull(), 1).otherwise(2))
    return running(rows, [F.col("grp"), F.col("ord"), F.col("sheet")]).select("sheet", F.col("place").cast("int").alias("place"))


def book_sheets(pairs: DataFrame, ranking: DataFrame, n_legend: int) -> DataFrame:
    """(place, sheet, deck, n_rows) of a whole workbook: legend, summary, then the entities by rank."""
    names = sheet_names(ranking.select("deck"))
    rows = pairs.groupBy(F.col("a").alias("deck")).agg(F.count("*").alias("n_rows")).join(names, "deck").join(ranking.select("deck", "rank"), "deck")
    fixed = ranking.agg(F.count("*").alias("n")).select(F.inline(F.array(
        F.struct(F.lit(0).alias("rank"), F.lit("01_Summary").alias("sheet"), F.col("n").alias("n_rows")), F.struct(F.lit(-1).alias("rank"), F.lit("00_Legenda").alias("sheet"), F.lit(n_legend).cast("bigint").alias("n_rows")),
    )))
    both = rows.select("rank", "sheet", "n_rows", "deck").unionByName(fixed.withColumn("deck", F.lit(None).cast("string")))
    return both.select(F.row_number().over(Window.orderBy("rank", "sheet")).alias("place"), "sheet", "deck", "n_rows")


# The columns' meanings, and what the colours mark.
COLUMN_TEXTS = [
    ("w, l, n", "wins, losses and their sum against the opponent"), ("wr_real", "win rate as observed, in percent, without ties"), ("p_hat", "win rate with the prior, in percent"),
    ("se_dir", "standard error of p_hat, in points"), ("se_binom", "standard error of wr_real, in points"), ("gap", "p_hat minus wr_real, in points"),
    ("weight", "share of the opponent in the entity's weighted mean"), ("contrib", "points that the opponent gives to the weighted mean"), ("Mirror", "the entity itself"),
]
RANKING_TEXTS = [
    ("score", "mark from 0 to 100, of lb and bt"), ("mas", "weighted mean of the win rates"), ("se", "standard error of mas"), ("lb", "careful estimate: mas less a multiple of se"), ("bt", "strength by direct meetings"),
    ("coverage_pct", "share of opponents met"), ("n_eff", "decided matches in all"), ("opp_used, opp_total", "opponents met, and all"),
]
COLOUR_TEXTS = [("|gap| >= 8", "strong correction", "red"), ("4 <= |gap| < 8", "moderate correction", "yellow"), ("contrib", "among the largest of its sheet", "green"), ("Mirror", "the entity itself", "gray")]


def legend(ranking: DataFrame, settings: dict) -> DataFrame:
    """The legend as rows (ord, part, item, meaning, colour): columns, settings with the number of entities, ranking and colours."""
    rows = [("columns", *x, None) for x in COLUMN_TEXTS] + [("settings", k, str(v), None) for k, v in settings.items()]
    later = [("ranking", *x, None) for x in RANKING_TEXTS] + [("colours", *x) for x in COLOUR_TEXTS]
    schema, n = "ord int, part string, item string, meaning string, colour string", len(rows)
    known = [(i, *r) for i, r in enumerate(rows)] + [(n + 1 + i, *r) for i, r in enumerate(later)]
    entities = ranking.agg(F.lit(n).alias("ord"), F.lit("settings").alias("part"), F.lit("entities").alias("item"), F.count("*").cast("string").alias("meaning"), F.lit(None).cast("string").alias("colour"))
    return ranking.sparkSession.createDataFrame(known, schema).unionByName(entities)
