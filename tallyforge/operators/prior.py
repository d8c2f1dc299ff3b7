"""The prior strength K: the one under which held-out matches are likeliest."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalar import log_beta, split_counts
from tallyforge.operators.order import running


def observed(cells: DataFrame) -> DataFrame:
    return cells.where("a <> b and n_dir > 0").select("a", "a_ord", "b", "b_ord", "w", "l", "n_dir")


def splits(cells: DataFrame, rho: float) -> DataFrame:
    return observed(cells).withColumns(split_counts(F.col("w"), F.col("l"), rho))


def scale(cells: DataFrame) -> DataFrame:
    """(n_med, n_75, beta): the usual number of matches of a cell."""
    one = F.lit(1.0)
    q = observed(cells).agg(F.median("n_dir").alias("n_med"), F.percentile("n_dir", F.lit(0.75)).alias("n_75"))
    return q.withColumn("beta", F.sqrt(F.greatest("n_med", one) * F.greatest("n_75", one)))


def k_grid(cells: DataFrame, cfg) -> DataFrame:
    low = max(cfg.k_bounds[0], cfg.k_min)
    raw = F.explode(F.array(*[F.lit(float(m)) for m in cfg.k_multiples])).alias("m")
    return scale(cells).select("beta", raw).select(F.least(F.greatest(F.col("beta") * F.col("m"), F.lit(low)), F.lit(float(cfg.k_bounds[1]))).alias("k")).distinct()


def predictive_ll(cells: DataFrame, ks: DataFrame, cfg) -> DataFrame:
    """(k, ll): log likelihood of the test matches under Beta(mu K, (1 - mu) K) updated by the train matches."""
    rows = splits(cells, cfg.rho_test).where("w_test + l_test > 0").crossJoin(F.broadcast(ks))
    a, b = F.col("k") * cfg.mu + F.col("w_train"), F.col("k") * (1 - cfg.mu) + F.col("l_train")
    return rows.groupBy("k").agg(F.sum(log_beta(a + F.col("w_test"), b + F.col("l_test")) - log_beta(a, b)).alias("ll"))


def pick(ll: dict[float, float], tol: float) -> float:
    """The smallest K within the tolerance of the best."""
    best = max(ll.values())
    return min(k for k, v in ll.items() if best - v <= tol * max(1.0, abs(best)))


def decision(star: float, boot: np.ndarray, ks: list[float], beta: float, floor: float, most: float) -> tuple[float, str]:
    """(K to use, reason): the best one, held within bounds, or the median of its resamples where those disagree with it."""
    med = float(np.median(boot))
    spread = float(np.percentile(boot, 75) - np.percentile(boot, 25))
    mode = float(np.mean(np.isclose(boot, star, rtol=0, atol=1e-12)))
    edge = abs(star - ks[0]) <= 1e-12 or abs(star - ks[-1]) <= 1e-12
    low, high = max(ks[0], floor), min(ks[-1], most, beta * 4)
    if edge and mode >= 0.8 and med > 0 and spread / med <= 0.05:
        return float(np.clip(star, low, high)), "best-boundary-override"
    if edge or (med > 0 and spread / med > 0.35) or mode < 0.5:
        return float(np.clip(med, max(beta / 4, low), high)), "boot-clipped"
    return float(np.clip(star, low, high)), "best"


def choose_k(cells: DataFrame, cfg) -> dict:
    """Grid, choice and its bootstrap check. All likelihoods are Spark jobs; the driver sees a few numbers."""
    if cfg.fixed_k is not None:
        return {"k_used": float(cfg.fixed_k), "reason": "fixed"}
    spark = cells.sparkSession
    top = scale(cells).first()
    if top["n_med"] is None:
        raise RuntimeError("no observed cells")
    beta, floor = top["beta"], max(cfg.k_bounds[0], cfg.k_min)

    def ll_of(ks: list[float]) -> dict[float, float]:
        return {r["k"]: r["ll"] for r in predictive_ll(cells, spark.createDataFrame([(k,) for k in ks], "k double"), cfg).collect()}

    ks = sorted({min(max(beta * m, floor), cfg.k_bounds[1]) for m in cfg.k_multiples})
    lower = [ks[0]]
    for _ in range(cfg.k_expansions):
        lower.append(max(lower[-1] / 2, floor))
    base = min(max(beta, ks[0]), ks[-1])
    ll = ll_of(sorted({*ks, *lower, base}))
    if not ll:
        raise RuntimeError("no matches are left to test on")
    steps = 0
    star = pick({k: ll[k] for k in ks}, cfg.rel_tol)
    while star == ks[0] and ks[0] > floor + 1e-12 and steps < cfg.k_expansions:
        ks.insert(0, max(ks[0] / 2, floor))
        star = pick({k: ll[k] for k in ks}, cfg.rel_tol)
        steps += 1
    base = min(max(beta, ks[0]), ks[-1])
    local = sorted({min(max(star * m, ks[0]), ks[-1]) for m in cfg.boot_multiples})
    boot = np.array([r["k"] for r in bootstrap(cells, local, cfg).collect()])
    used, reason = decision(star, boot, ks, beta, floor, cfg.k_bounds[1])
    tested = splits(cells, cfg.rho_test).agg(F.sum(F.col("w_test") + F.col("l_test"))).first()[0] or 0
    ll_base = ll[base] if base in ll else ll_of([base])[base]
    return {"k_grid": ks, "k_star": star, "k_used": used, "reason": reason, "beta": beta, "n_med": top["n_med"], "n_75": top["n_75"], "expansions": steps, "delta_ll_100": 100 * (ll[star] - ll_base) / tested if tested else 0.0}


#: Digits of the hash that make a draw: 52 bits, which a double holds.
DRAW_DIGITS = 13


def draws(spark, replicates: int, n: int, seed: int) -> DataFrame:
    """(replicate, cell, times): ``n`` draws with replacement of the cells 0 to n - 1 in each replicate.

    Draw d of replicate r is a hash of (seed, r, d), so any task can make it, again and in any order, and no draw is
    made on the driver.
    """
    ids = spark.range(replicates * n).select((F.col("id") / n).cast("bigint").alias("replicate"), (F.col("id") % n).alias("draw"))
    key = F.md5(F.concat_ws("/", F.lit(str(seed)), "replicate", "draw"))
    u = F.conv(F.substring(key, 1, DRAW_DIGITS), 16, 10).cast("bigint").cast("double")
    cell = F.least(F.floor(u * n / F.lit(float(16**DRAW_DIGITS))), F.lit(n - 1)).cast("bigint")
    return ids.select("replicate", cell.alias("cell")).groupBy("replicate", "cell").agg(F.count("*").alias("times"))


def bootstrap(cells: DataFrame, ks: list[float], cfg) -> DataFrame:
    """(replicate, k): the best K of each resample of the test cells, which are numbered in axis order; the smallest of equal ones."""
    ks = sorted(ks)
    used = splits(cells, cfg.rho_test).where("w_test + l_test > 0")
    a, b = (lambda k: F.lit(k * cfg.mu) + F.col("w_train")), (lambda k: F.lit(k * (1 - cfg.mu)) + F.col("l_train"))
    gain = [(log_beta(a(k) + F.col("w_test"), b(k) + F.col("l_test")) - log_beta(a(k), b(k))).alias(f"ll_{i}") for i, k in enumerate(ks)]
    placed = running(used.select("a_ord", "b_ord", *gain), [F.col("a_ord"), F.col("b_ord")]).withColumn("cell", F.col("place") - 1)
    n = used.count()
    sums = draws(cells.sparkSession, cfg.boot_n, n, cfg.seed).join(placed, "cell").groupBy("replicate").agg(*[F.sum(F.col("times") * F.col(f"ll_{i}")).alias(f"ll_{i}") for i in range(len(ks))])
    best = F.array_min(F.array(*[F.struct((-F.col(f"ll_{i}")).alias("loss"), F.lit(k).alias("k")) for i, k in enumerate(ks)]))
    return sums.select("replicate", best["k"].alias("k"))


def shrink_quantiles(cells: DataFrame, k: float) -> DataFrame:
    """How much of a cell's estimate comes from the prior: K / (N + K), its quantiles, and its median over small cells."""
    rows = observed(cells).withColumn("r", F.lit(float(k)) / (F.col("n_dir") + float(k)))
    q25 = rows.agg(F.percentile("n_dir", F.lit(0.25)).alias("q25"))
    rows = rows.crossJoin(F.broadcast(q25))
    return rows.agg(*[F.percentile("r", F.lit(q)).alias(name) for name, q in (("r_p10", 0.1), ("r_p50", 0.5), ("r_p90", 0.9))], F.median(F.when(F.col("n_dir") <= F.col("q25"), F.col("r"))).alias("r_small_med"))
