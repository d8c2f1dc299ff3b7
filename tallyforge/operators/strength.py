"""Regularised Bradley-Terry strengths from the pairs' posterior rates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyforge.functions.scalar import clamp, confidence

def whole() -> WindowSpec:
    return Window.partitionBy()


def bt_edges(post: DataFrame, k: float, cfg) -> DataFrame:
    """(a, b, n_ij, n_ji, n_base, s_bar, p_bar) of unordered pairs with enough confidence.

    s_bar is the mean confidence of the sides with matches; a pair stays from N_min / (N_min + K) on.
    """
    fwd = post.where("a_ord < b_ord").select("a", "b", "a_ord", "b_ord", F.coalesce("n_dir", F.lit(0)).alias("n_ij"), F.col("p_hat").alias("p_ij"))
    back = post.where("a_ord > b_ord").select(F.col("a").alias("b"), F.col("b").alias("a"), F.coalesce("n_dir", F.lit(0)).alias("n_ji"), F.col("p_hat").alias("p_ji"))
    rows = fwd.join(back, ["a", "b"])
    i, j = F.col("n_ij") > 0, F.col("n_ji") > 0
    s_i, s_j = confidence(F.col("n_ij"), k), confidence(F.col("n_ji"), k)
    mean = lambda x, y: F.when(i & j, (x + y) / 2).when(i, x).when(j, y)
    harmonic = F.when(i & j, F.lit(2.0) * F.col("n_ij") * F.col("n_ji") / (F.col("n_ij") + F.col("n_ji"))) if cfg.bt_harmonic else F.lit(None).cast("double")
    rows = rows.withColumns({
        "s_bar": mean(s_i, s_j), "p_bar": mean(F.col("p_ij"), 1 - F.col("p_ji")),
        "n_base": F.coalesce(harmonic, mean(F.col("n_ij").cast("double"), F.col("n_ji").cast("double"))),
    })
    return rows.where(F.col("s_bar") >= cfg.n_min_bt / (cfg.n_min_bt + k)).select("a", "b", "a_ord", "b_ord", "n_ij", "n_ji", "n_base", "s_bar", "p_bar")


def bt_diagnostics(edges: DataFrame, axis: DataFrame, k: float, cfg) -> DataFrame:
    """One row: near_share, s_med, hhi, min_opp, med_opp, power."""
    least = cfg.n_min_bt / (cfg.n_min_bt + k)
    lever = F.greatest("n_base", F.lit(1e-12)) * F.abs(F.col("p_bar") - 0.5)
    top = edges.agg(
        F.coalesce(F.avg(F.when((F.col("s_bar") >= least) & (F.col("s_bar") < least + cfg.bt_near_band), 1.0).otherwise(0.0)), F.lit(0.0)).alias("near_share"),
        F.median("s_bar").alias("s_med"), F.when(F.sum(lever) > 0, F.sum(lever * lever) / F.pow(F.sum(lever), F.lit(2.0))).alias("hhi"),
    )
    ends = edges.select(F.explode(F.array("a", "b")).alias("deck")).groupBy("deck").count()
    degree = axis.select("deck").join(ends, "deck", "left").agg(F.min(F.coalesce("count", F.lit(0))).alias("min_opp"), F.median(F.coalesce("count", F.lit(0))).alias("med_opp"))
    rows = top.crossJoin(degree)
    x1, x2 = clamp((F.col("near_share") - 0.15) / 0.15, 0, 1), clamp((0.60 - F.coalesce("s_med", F.lit(0.60))) / 0.10, 0, 1)
    x3, x4 = clamp((F.coalesce("hhi", F.lit(0.10)) - 0.10) / 0.05, 0, 1), clamp((8.0 - F.col("min_opp")) / 5.0, 0, 1)
    power = clamp(1.5 + 0.4 * x1 + 0.2 * x2 + 0.2 * x3 + 0.1 * x4, 1.5, 2.1) if cfg.bt_power is None else F.lit(float(cfg.bt_power))
    return rows.withColumn("power", power)


def soft_weights(edges: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """(a, b, n_eff, w_ij, w_ji): matches discounted by confidence to the power of the diagnostics."""
    p = F.least(F.greatest("p_bar", F.lit(1e-9)), F.lit(1 - 1e-9))
    rows = edges.crossJoin(F.broadcast(diagnostics.select("power"))).withColumn("n_eff", F.greatest(F.col("n_base") * F.pow("s_bar", "power"), F.lit(1e-9)))
    return rows.select("a", "b", "n_eff", (p * F.col("n_eff")).alias("w_ij"), ((1 - p) * F.col("n_eff")).alias("w_ji"))


def bt_strength(weights: DataFrame, axis: DataFrame, cfg) -> DataFrame:
    """([league,] deck, pi, iterations) by minorisation-maximisation with a ridge; pi has a geometric mean of 1.

    Every step needs all strengths of the step before, so one league (T entities, at most T squared
    edges) is one task. Where ``axis`` and ``weights`` have a column ``league``, each league is its own.
    """
    leagues = "league" in axis.columns

    def run(name: tuple, decks: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        names = decks.sort_values("ord")["deck"].tolist()
        at = {d: i for i, d in enumerate(names)}
        i, j = (edges[c].map(at).to_numpy(int) if len(edges) else np.zeros(0, int) for c in "ab")
        n, wins = edges["n_eff"].to_numpy(float), np.zeros(len(names))
        np.add.at(wins, i, edges["w_ij"].to_numpy(float))
        np.add.at(wins, j, edges["w_ji"].to_numpy(float))
        pi, step = np.ones(len(names)), 0
        for step in range(1, (cfg.bt_max_iter if len(edges) else 0) + 1):
            share, total = n / (pi[i] + pi[j] + 1e-12), np.zeros(len(names))
            np.add.at(total, i, share)
            np.add.at(total, j, share)
            new = (wins + cfg.bt_ridge) / (total + cfg.bt_ridge + 1e-12)
            moved = float(np.max(np.abs(new - pi) / (pi + 1e-9)))
            pi = np.maximum(new, 1e-8)
            if moved < cfg.bt_tol:
                break
        level = np.exp(np.log(pi).mean()) + 1e-12 if len(pi) else 1.0
        return pd.DataFrame({"league": name[0], "deck": names, "pi": pi / level, "iterations": step})

    league = (F.col("league").cast("string") if leagues else F.lit("all")).alias("league")
    decks, edges = axis.select(league, "deck", "ord"), weights.select(league, "a", "b", "n_eff", "w_ij", "w_ji")
    out = decks.groupBy("league").cogroup(edges.groupBy("league")).applyInPandas(run, "league string, deck string, pi double, iterations long")
    return out if leagues else out.drop("league")


def bt_percent(strengths: DataFrame, edges: DataFrame) -> DataFrame:
    """(deck, bt): strengths on a log scale of unit spread, squashed to percent; 50 for all without edges."""
    theta = F.ln(F.col("pi") / (F.exp(F.avg(F.ln("pi")).over(whole())) + F.lit(1e-12)))
    rows = strengths.withColumn("theta", theta).withColumn("sd", F.stddev_pop("theta").over(whole())).crossJoin(F.broadcast(edges.agg(F.count("*").alias("n_edges"))))
    sd = F.when(F.col("sd") > 1e-12, F.col("sd")).otherwise(F.lit(1.0))
    return rows.select("deck", F.when(F.col("n_edges") > 0, F.lit(100.0) / (1 + F.exp(-F.col("theta") / sd))).otherwise(F.lit(50.0)).alias("bt"))
