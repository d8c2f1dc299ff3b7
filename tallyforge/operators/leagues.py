"""Leagues too large for one task: Bradley-Terry strengths and the missing-cell filter in rounds of joins.

Both loops keep their state as a small saved table (a row per entity), read their edges from a table that was
written once, and send the driver a few numbers per large league and round. A league is large if it has more
edges than one task shall take, so the number of large leagues is bounded by the input divided by that.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.strength import bt_strength
from tallyforge.sources.state import configured, dealt, saved, shared_home

#: Edges that one task takes (three doubles and two places each).
BLOCK_EDGES = 2_000_000


def numbered(axis: DataFrame) -> DataFrame:
    """``axis`` (league, deck, ...) saved with a number ``node`` for each row."""
    return saved(axis.withColumn("node", F.monotonically_increasing_id()))


def part(node: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(parts)).cast("int")


def block(i: Column, j: Column, parts: int) -> Column:
    """The block of a pair of parts, either way round."""
    return F.least(i, j) * parts + F.greatest(i, j)


def in_blocks(edges: DataFrame, parts: int) -> str:
    """The name of a table of ``edges`` (x, y, n_eff: nodes) with the block of both ends' parts, in buckets of blocks.

    A block needs the strengths of two parts only, and its edges never move again: the rounds join them where they
    are. The edges of one entity, however many, are dealt over as many blocks as there are parts.
    """
    spark = edges.sparkSession
    rows = edges.withColumn("block", block(part(F.col("x"), parts), part(F.col("y"), parts), parts))
    buckets, name = parts * (parts + 1) // 2, f"tallyforge_{uuid.uuid4().hex}"
    rows.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", shared_home(spark)).saveAsTable(name)
    return name


def strengths_by_blocks(weights: DataFrame, axis: DataFrame, cfg, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(league, deck, pi, iterations): what ``strength.bt_strength`` solves in one task, for large leagues.

    ``weights``: (league, a, b, n_eff, w_ij, w_ji); ``axis``: (league, deck). A round is one job: strengths go to
    the blocks that hold edges of theirs, shares of both ends are summed with partial sums, and each league stops
    at its own round. Strengths before the last round are read by the next one only.
    """
    spark = weights.sparkSession
    ends = F.inline(F.array(F.struct(F.col("a").alias("deck"), F.col("w_ij").alias("won")), F.struct(F.col("b").alias("deck"), F.col("w_ji").alias("won"))))
    wins = weights.select("league", ends).groupBy("league", "deck").agg(F.sum("won").alias("won"))
    nodes = numbered(axis.select("league", "deck").join(wins, ["league", "deck"], "left").select("league", "deck", F.coalesce("won", F.lit(0.0)).alias("won")))
    at = lambda end, name: nodes.select("league", F.col("deck").alias(end), F.col("node").alias(name))
    plain = weights.join(at("a", "x"), ["league", "a"]).join(at("b", "y"), ["league", "b"]).select("x", "y", "n_eff")
    parts = max(1, math.ceil(math.sqrt(2 * weights.count() / block_edges)))
    name = in_blocks(plain, parts)
    edges = spark.table(name)
    playing = {r.league for r in weights.select("league").distinct().collect()}
    state = nodes.withColumns({"pi": F.lit(1.0), "moved": F.lit(None).cast("double")})
    idle = ~F.col("league").isin(list(playing)) if playing else F.lit(True)
    done = [state.where(idle).select("league", "deck", "won", "node", "pi", "moved", F.lit(0).alias("iterations"))]
    with configured(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
        for step in range(1, cfg.bt_max_iter + 1):
            if not playing:
                break
            state = saved(one_round(edges, state.where(F.col("league").isin(list(playing))), parts, cfg))
            moved = {r.league: r.m for r in state.groupBy("league").agg(F.max("moved").alias("m")).collect()}
            still = {x for x, m in moved.items() if m >= cfg.bt_tol and step < cfg.bt_max_iter}
            if playing - still:
                done.append(state.where(F.col("league").isin(list(playing - still))).withColumn("iterations", F.lit(step)))
            playing = still
    spark.sql(f"DROP TABLE {name}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    level = out.groupBy("league").agg((F.exp(F.avg(F.ln("pi"))) + F.lit(1e-12)).alias("level"))
    return out.join(level, "league").select("league", "deck", (F.col("pi") / F.col("level")).alias("pi"), F.col("iterations").cast("bigint").alias("iterations"))


def one_round(edges: DataFrame, state: DataFrame, parts: int, cfg) -> DataFrame:
    own = part(F.col("node"), parts)
    every = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda t: block(own, t.cast("int"), parts))
    copies = state.select("node", "pi", F.explode(every).alias("block"))
    side = lambda end: copies.select("block", F.col("node").alias(end), F.col("pi").alias(f"pi_{end}")).hint("shuffle_hash")
    share = F.col("n_eff") / (F.col("pi_x") + F.col("pi_y") + F.lit(1e-12))
    shares = edges.join(side("x"), ["block", "x"]).join(side("y"), ["block", "y"]).select("x", "y", share.alias("share"))
    total = shares.select(F.inline(F.array(F.struct(F.col("x").alias("node"), "share"), F.struct(F.col("y").alias("node"), "share")))).groupBy("node").agg(F.sum("share").alias("total"))
    fresh = (F.col("won") + F.lit(float(cfg.bt_ridge))) / (F.coalesce("total", F.lit(0.0)) + F.lit(cfg.bt_ridge + 1e-12))
    new = state.join(total, "node", "left").withColumn("fresh", fresh)
    return new.select("league", "deck", "won", "node", F.greatest("fresh", F.lit(1e-8)).alias("pi"), (F.abs(F.col("fresh") - F.col("pi")) / (F.col("pi") + F.lit(1e-9))).alias("moved"))


def large(edges: DataFrame, block_edges: int) -> list[str]:
    """Leagues with more edges than one task takes."""
    return [r.league for r in edges.groupBy("league").count().where(F.col("count") > block_edges).collect()]


def strengths(weights: DataFrame, axis: DataFrame, cfg, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(league, deck, pi, iterations): small leagues in a task each, large ones by blocks."""
    axis, weights = (x.withColumn("league", F.col("league").cast("string")) for x in (axis, weights))
    big = F.col("league").isin(names) if (names := large(weights, block_edges)) else F.lit(False)
    out = bt_strength(weights.where(~big), axis.where(~big), cfg)
    return out.unionByName(strengths_by_blocks(weights.where(big), axis.where(big), cfg, block_edges)) if names else out


def peel_lowest(nodes: np.ndarray, known: np.ndarray, ready: np.ndarray, columns: Sequence[np.ndarray | None], allowed: int, step: int) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """(rounds, known, step, ended): the rounds of the filter that ``ready`` nodes decide, and the known cells after them.

    All with the fewest known cells go together while (left - 1 - fewest) exceeds ``allowed`` and more than two are left.
    ``nodes``: all that are left of a league, ascending, with their ``known`` cells; ``columns``: of ready nodes, those whose
    rows have a cell of it (of none: None), read once, when it goes. It stops before the first round in which another node
    would go; ``rounds`` is 0 for nodes that stay.
    """
    gone, rounds = np.iinfo(np.int64).max, np.zeros(len(nodes), np.int64)
    waiting, left, ended = known.copy(), len(nodes), False
    while True:
        least = waiting.min(initial=gone)
        if left <= 2 or left - 1 - least <= allowed:
            ended = True
            break
        out = np.flatnonzero(waiting == least)
        if not ready[out].all():
            break
        step += 1
        left -= len(out)
        rounds[out], waiting[out] = step, gone
        if found := [columns[i] for i in out if columns[i] is not None]:
            lost = np.concatenate(found)
            at = np.minimum(np.searchsorted(nodes, lost), len(nodes) - 1)
            at = at[(nodes[at] == lost) & (waiting[at] < gone)]
            np.subtract.at(waiting, at, 1)
    return rounds, np.where(rounds == 0, waiting, known), step, ended


def peeled_in_tasks(alive: DataFrame) -> DataFrame:
    """STATE after the rounds that the ready nodes of ``alive`` (STATE, ready, rows: null unless ready) decide, a task for each league."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        nodes = rows["node"].to_numpy()
        known, ready = rows["known"].to_numpy(np.int64), rows["ready"].to_numpy(bool)
        rounds, known, step, ended = peel_lowest(nodes, known, ready, rows["rows"].to_numpy(), int(rows["allowed"].iloc[0]), int(rows["before"].iloc[0]))
        dropped = pd.Series(rounds, dtype="Int64").where(rounds > 0)
        return pd.DataFrame({"league": rows["league"].to_numpy(), "node": nodes, "allowed": rows["allowed"].to_numpy(), "known": known, "held": rows["held"].to_numpy(), "before": step, "dropped_round": dropped.to_numpy(dtype=object), "ended": ended})

    return alive.groupBy("league").applyInPandas(run, STATE)


#: Of each entity: known cells in its row and (``held``) stored ones in its column, rounds so far, the round in which it went, whether its league is settled.
STATE = "league string, node long, allowed long, known long, held long, before long, dropped_round long, ended boolean"
#: Cells that one task of the filter takes (a number each).
PEEL_CELLS = 32_000_000
#: Entities whose names are sent to all tasks at once.
SENT = 2_000_000


def lowest(levels: list, cells: int) -> int | None:
    """The highest of ``levels`` (known, held), by rising known, up to which columns have no more than ``cells`` in sum."""
    most, total = None, 0
    for r in levels:
        total += r.held
        if total > cells:
            break
        most = r.known
    return most


def columns_of(columns: DataFrame, asked: DataFrame, few: bool) -> DataFrame:
    """``asked`` (STATE) with their ``rows``; where they are ``few``, the columns stay where they are."""
    return columns.select("league", "node", "rows").join(F.broadcast(asked) if few else asked, ["league", "node"])


def round_in_joins(columns: DataFrame, state: DataFrame, least: Column) -> DataFrame:
    """STATE after one round, for leagues whose next round has more cells than a task takes."""
    goes = F.col("known") == least
    out = state.where(goes).select("league", "node")
    lost = columns.join(out, ["league", "node"], "left_semi").select("league", F.explode("rows").alias("node")).groupBy("league", "node").agg(F.count("*").alias("lost"))
    fewer, step = F.col("known") - F.coalesce("lost", F.lit(0)), F.col("before") + 1
    return state.join(lost, ["league", "node"], "left").select("league", "node", "allowed", F.when(goes, F.col("known")).otherwise(fewer).alias("known"), "held", step.alias("before"), F.when(goes, step).alias("dropped_round"), F.lit(False).alias("ended"))


def kept_of_columns(columns: DataFrame, max_ratio: float = 0.15, min_allowed: int = 1, ceil: bool = False, block_edges: int | None = None) -> DataFrame:
    """(league, node, dropped_round) of saved ``columns`` (league, node, known, rows): a row for each entity of a league.

    ``known``: the known cells in its row; ``rows``: those whose rows have a cell of its column, so that a cell is a number
    in a list. A large league is peeled in passes: the columns of those with the fewest known cells, as many as a task takes,
    go to one task, which works out all rounds that these entities decide. Only a round that has more cells than a task takes
    is made in joins.
    """
    most = PEEL_CELLS if block_edges is None else block_edges
    sizes = columns.groupBy("league").agg(F.count("*").alias("n"), F.sum(F.size("rows")).alias("cells"))
    scale = F.ceil if ceil else F.floor
    allowed = F.greatest(F.lit(min_allowed), scale((F.col("n") - 1) * F.lit(max_ratio))).cast("bigint")
    sizes = saved(sizes.select("league", allowed.alias("allowed"), "cells"))
    names = [r.league for r in sizes.where(F.col("cells") > most).collect()]
    big = F.col("league").isin(names) if names else F.lit(False)
    start = columns.join(F.broadcast(sizes), "league").select("league", "node", "allowed", "known", F.size("rows").cast("bigint").alias("held"), F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("dropped_round"), F.lit(False).alias("ended"), "rows")
    rounds = [peeled_in_tasks(start.where(~big).withColumn("ready", F.lit(True))).select("league", "node", "dropped_round")]
    columns, state = columns.where(big), saved(start.where(big).drop("rows"))
    while True:
        alive = state.where(~F.col("ended") & F.col("dropped_round").isNull())
        levels = alive.groupBy("league", "known").agg(F.sum("held").alias("held"), F.count("*").alias("n")).orderBy("league", "known").collect() if names else []
        rounds.append(state.where(F.col("ended") | F.col("dropped_round").isNotNull()).select("league", "node", "dropped_round"))
        if not levels:
            break
        of = {x: list(rows) for x, rows in groupby(levels, key=lambda r: r.league)}
        bound = {x: lowest(rows, most) for x, rows in of.items()}
        by_league = lambda found: F.create_map(*[v for x, n in sorted(found.items()) for v in (F.lit(x), F.lit(n))])[F.col("league")]
        tasks, joins = {x: n for x, n in bound.items() if n is not None}, {x: of[x][0].known for x, n in bound.items() if n is None}
        parts = []
        if tasks:
            one = alive.where(F.col("league").isin(list(tasks))).withColumn("ready", F.col("known") <= by_league(tasks))
            asked, few = F.col("ready") & (F.col("held") > 0), sum(r.n for r in levels if r.known <= tasks.get(r.league, -1)) <= SENT
            none = F.lit(None).cast(columns.schema["rows"].dataType)
            parts.append(peeled_in_tasks(columns_of(columns, one.where(asked), few).unionByName(one.where(~asked).withColumn("rows", none))))
        if joins:
            ended = [x for x, least in joins.items() if (left := sum(r.n for r in of[x])) <= 2 or left - 1 - least <= of_allowed(alive, x)]
            one = alive.where(F.col("league").isin(list(joins)))
            over = F.col("league").isin(ended)
            parts += [one.where(over).withColumn("ended", F.lit(True)), round_in_joins(columns, one.where(~over), by_league(joins))]
        state = saved(reduce(DataFrame.unionByName, parts))
    return reduce(DataFrame.unionByName, rounds)


def kept_entities(known: DataFrame, axis: DataFrame, max_ratio: float = 0.15, min_allowed: int = 1, ceil: bool = False, block_edges: int | None = None) -> DataFrame:
    """(league, deck, dropped_round) from the known cells only, so that no T squared grid is made; see ``kept_of_columns``.

    ``known``: (league, a, b), a row for each known cell off the diagonal; ``axis``: (league, deck).
    """
    nodes = numbered(axis.select(F.col("league").cast("string"), "deck"))
    at = lambda end, name: nodes.select("league", F.col("deck").alias(end), F.col("node").alias(name))
    cells = known.where("a <> b").select(F.col("league").cast("string"), "a", "b")
    cells = cells.join(at("a", "x"), ["league", "a"]).join(at("b", "y"), ["league", "b"]).select("league", "x", "y")
    cells = saved(dealt(cells, known.count(), "x", "y").distinct())
    rows = cells.groupBy("league", F.col("y").alias("node")).agg(F.collect_list("x").alias("rows"))
    counts = cells.groupBy("league", F.col("x").alias("node")).agg(F.count("*").alias("known"))
    empty = F.array().cast("array<bigint>")
    columns = nodes.join(counts, ["league", "node"], "left").join(rows, ["league", "node"], "left").select("league", "node", F.coalesce("known", F.lit(0)).alias("known"), F.coalesce("rows", empty).alias("rows"))
    kept = kept_of_columns(saved(columns), max_ratio, min_allowed, ceil, block_edges)
    return nodes.join(kept, ["league", "node"]).select("league", "deck", "dropped_round")


def of_allowed(alive: DataFrame, league: str) -> int:
    return alive.where(F.col("league") == league).select("allowed").first()[0]
