"""From records to a ranking, as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.config import RankingConfig
from tallyforge.operators import composite, consolidate, matrix, missing_filter, posterior, prior, strength, weights
from tallyforge.sources import settings
from tallyforge.sources.state import saved


@dataclass
class Ranking:
    ranking: DataFrame
    cells: DataFrame
    posterior: DataFrame
    weights: DataFrame
    edges: DataFrame
    diagnostics: DataFrame
    k: dict


def kept_axis(flat: DataFrame, axis: DataFrame, cfg: RankingConfig) -> DataFrame:
    """(deck, ord) of the entities with enough known cells."""
    cells = matrix.matrices(flat, axis)
    return missing_filter.kept_entities(cells, cfg.max_missing_ratio, cfg.min_missing, cfg.missing_ceil).where("dropped_round is null").select("deck", "ord")


def rank_entities(score: DataFrame, axis: DataFrame, declared: DataFrame | None, cfg: RankingConfig) -> Ranking:
    """Ranks the entities of ``axis`` (deck, ord) by the symmetric records ``score``. ``declared`` is (deck, share), or any table of
    usage whose columns ``settings.declared_shares`` knows; without names or shares in it, declared shares are even.

    Cells, posterior, weights and edges have T squared rows at most and feed several branches: saved, so that no plan holds another's and a lost executor costs nothing.
    """
    if declared is not None and not {"deck", "share"} <= set(declared.columns):
        declared = settings.declared_shares(declared)
    axis = saved(axis)
    if axis.isEmpty():
        raise ValueError("no entity to rank")
    cells = saved(matrix.matrices(score, axis))
    k = prior.choose_k(cells, cfg)
    post = saved(posterior.posterior_cells(cells, k["k_used"], cfg.mu))
    enc = weights.encounter_share(cells)
    mixed = saved(weights.blend(weights.meta_share(axis, declared, enc, cfg.gap_policy), enc, cfg))
    mean = posterior.mas_se_lb(post, mixed, cfg.z_penalty)
    edges = saved(strength.bt_edges(post, k["k_used"], cfg))
    diagnostics = strength.bt_diagnostics(edges, axis, k["k_used"], cfg)
    solved = saved(strength.bt_strength(strength.soft_weights(edges, diagnostics), axis, cfg))
    scores = composite.composite(mean.join(strength.bt_percent(solved, edges), "deck"), cfg.alpha)
    return Ranking(composite.ranked(scores, composite.coverage(cells)), cells, post, mixed, edges, diagnostics, k)


def axis_of(canonical: DataFrame) -> DataFrame:
    return canonical.select("deck", F.row_number().over(Window.orderBy(F.desc("share_frac"), "deck")).alias("ord"))


def records_to_score(raw: DataFrame, shares: DataFrame, aliases: DataFrame | None, cfg: RankingConfig):
    """(score, kept axis, canonical shares)."""
    flat = saved(consolidate.flat_table(consolidate.max_n(raw), aliases))
    canonical = matrix.top_meta_canonical(matrix.top_meta(shares, cfg.share_threshold), aliases)
    kept = saved(kept_axis(flat, axis_of(canonical), cfg))
    if kept.isEmpty():
        raise ValueError("no entity has a share and enough records")
    return consolidate.score_table(flat, kept), kept, canonical
