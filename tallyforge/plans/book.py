"""The report workbook of a ranking."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import posterior, report, weights
from tallyforge.plans.ranking import Ranking
from tallyforge.sources import state, workbook
from tallyforge.sources.sinks import FIXED_SHEETS

def settled(ranked: Ranking) -> Ranking:
    """``ranked`` with its ranking worked out once: T rows, read by several branches of a report."""
    return replace(ranked, ranking=state.saved(ranked.ranking))


def report_pairs(ranked: Ranking) -> DataFrame:
    """One row for each entity and opponent, with flags; the prior strength is the ranking's own."""
    cells = posterior.se_binomial(posterior.report_posterior(ranked.cells, ranked.k["k_used"]))
    axis = ranked.cells.where("a = b").select("a", "a_ord").toDF("deck", "ord")
    return report.styled(report.pairs_by_entity(cells, weights.row_weights(axis, ranked.weights), ranked.ranking))


def settings_of(ranked: Ranking) -> dict:
    return {"prior strength": ranked.k["k_used"]}


def report_rows(ranked: Ranking, **shown) -> DataFrame:
    """``workbook.ROWS`` of a report: the legend, the summary, and a sheet for each entity by rank, with the columns that
    ``shown`` asks for (see ``report.pairs_view``); gaps, best contributions and mirror rows are marked."""
    ranking, pairs = ranked.ranking, report_pairs(ranked)
    view = report.pairs_view(pairs, **shown)
    columns = [c for c in view.columns if c not in ("a", "b_rank", "gap_flag", "is_mirror", "is_topk")]
    sheets = report.sheet_names(ranking.select("deck")).join(ranking.select("deck", "rank"), "deck").select(F.col("deck").alias("a"), (F.col("rank") + 1).cast("int").alias("place"), "sheet")
    plain = F.when(F.col("is_mirror"), "gray")
    styles = {c: plain for c in columns} | {"opponent": F.when(F.col("is_mirror"), "mirror"), "gap": F.coalesce(plain, F.lower("gap_flag")), "contrib": F.coalesce(plain, F.when(F.col("is_topk"), "green"))}
    own = view.join(F.broadcast(sheets), "a").select("place", "sheet", F.col("b_rank").cast("long").alias("row"), workbook.cells_of(view, columns, styles).alias("cells"))
    heads = sheets.select("place", "sheet", F.lit(-1).cast("long").alias("row"), workbook.header(columns).alias("cells"))
    legend, fixed = report.legend(ranking, settings_of(ranked)), FIXED_SHEETS
    told = workbook.sheet_rows(legend, 0, fixed[0], F.col("ord"), {"colour": F.col("colour")}, ["part", "item", "meaning", "colour"])
    summary = workbook.sheet_rows(report.summary(ranking), 1, fixed[1], F.col("rank"))
    return told.unionByName(summary).unionByName(heads).unionByName(own)


def write_report(ranked: Ranking, folder: str, prefix: str, now: datetime, **shown) -> tuple[str, str]:
    """Writes ``<prefix>_<stamp>.xlsx`` and the same as ``<prefix>_latest.xlsx`` to a folder that all machines share;
    returns both paths. A ranking without rows is an error."""
    ranked = settled(ranked)
    if ranked.ranking.isEmpty():
        raise ValueError("the ranking has no rows")
    store, home = workbook.place_of(folder)
    store.create_dir(home, recursive=True)
    stamped, latest = f"{folder}/{prefix}_{now:%Y%m%d_%H%M%S}.xlsx", f"{folder}/{prefix}_latest.xlsx"
    workbook.write(report_rows(ranked, **shown), stamped, latest)
    return stamped, latest
