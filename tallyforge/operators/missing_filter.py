"""Entities with too many unknown cells go, round by round."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kept_entities(cells: DataFrame, max_ratio: float = 0.15, min_allowed: int = 1, ceil: bool = False, by: str = "league") -> DataFrame:
    """(league, deck, ord, dropped_round): dropped_round is NULL for entities that stay.

    The allowance is fixed by the first axis. Each round all entities tied at the largest excess go,
    from both axes, until none exceeds or two or fewer are left. A league's T squared cells are
    one task's input; leagues are spread.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        axis = pdf[["a", "a_ord"]].drop_duplicates().sort_values("a_ord")
        alive, gone, step = list(axis["a"]), {}, 0
        allowed = max(min_allowed, int((math.ceil if ceil else math.floor)((len(alive) - 1) * max_ratio)))
        unknown = pdf[(pdf["a"] != pdf["b"]) & pdf["wr"].isna()]
        while len(alive) > 2:
            left = unknown[unknown["a"].isin(alive) & unknown["b"].isin(alive)].groupby("a").size()
            excess = left - allowed
            if excess.empty or excess.max() <= 0:
                break
            step += 1
            for deck in excess.index[excess == excess.max()]:
                gone[deck] = step
            alive = [d for d in alive if d not in gone]
        order = dict(zip(axis["a"], axis["a_ord"], strict=True))
        return pd.DataFrame({by: pdf[by].iloc[0], "deck": list(axis["a"]), "ord": [order[d] for d in axis["a"]], "dropped_round": pd.array([gone.get(d) for d in axis["a"]], dtype="Int64")})

    if by not in cells.columns:
        cells = cells.withColumn(by, F.lit("all"))
    return cells.select(by, "a", "a_ord", "b", "wr").groupBy(by).applyInPandas(run, f"{by} string, deck string, ord int, dropped_round long")
