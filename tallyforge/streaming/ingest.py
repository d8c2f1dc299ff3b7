"""Extension: match results and pair records as streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyforge.functions.scalar import win_rate
from tallyforge.operators import consolidate


def pair_totals(results: DataFrame, lateness: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """(start, a, b, w, l, t, n) per window from results (ts, a, b, outcome: 1, 0 or -1). Batch or streaming."""
    rows = results.withWatermark("ts", lateness) if results.isStreaming else results
    out = rows.where("a <> b").groupBy(F.window("ts", window).alias("win"), "a", "b").agg(F.count_if(F.col("outcome") > 0).alias("w"), F.count_if(F.col("outcome") < 0).alias("l"), F.count_if(F.col("outcome") == 0).alias("t"))
    return out.select(F.col("win.start").alias("start"), "a", "b", "w", "l", "t", (F.col("w") + F.col("l") + F.col("t")).alias("n"))


class BestRecords(StatefulProcessor):
    """State of a pair of names: for each direction the most matches that a record had, and the sums of the records with so many."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getMapState("best", "a string", "w bigint, l bigint, t bigint, n bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = {k[0]: tuple(v) for k, v in self.best.iterator()}
        for r in rows:
            w, l, t, n = best.get(r.a, (0, 0, 0, -1))
            if r.n > n:
                best[r.a] = (r.w, r.l, r.t, r.n)
            elif r.n == n:
                best[r.a] = (w + r.w, l + r.l, t + r.t, n)
        for a, v in best.items():
            self.best.updateValue((a,), v)
        low, high = key
        # The better direction: most decided matches, then most matches, then names.
        a = max(best, key=lambda x: (best[x][0] + best[x][1], sum(best[x][:3]), x == low))
        b = high if a == low else low
        w, l, t, _ = best[a]
        yield Row(a=a, b=b, w=w, l=l, t=t)
        if a != b:
            yield Row(a=b, b=a, w=l, l=w, t=t)

    def close(self) -> None:
        pass


def pair_records(raw: DataFrame) -> DataFrame:
    """(a, b, w, l, t, n, winrate): ``symmetrize(max_n(raw))`` of records (a, b, w, l, t). Of a stream, each trigger gives the pairs
    that it changed (output mode update; the newest row of a pair holds); the state of a pair is two records.

    A stream needs the RocksDB state store: spark.sql.streaming.stateStore.providerClass.
    """
    if not raw.isStreaming:
        return consolidate.symmetrize(consolidate.max_n(raw))
    keyed = consolidate.with_counts(raw).withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")}).groupBy("low", "high")
    out = keyed.transformWithState(BestRecords(), "a string, b string, w bigint, l bigint, t bigint", "Update", "None")
    return out.withColumn("n", F.col("w") + F.col("l") + F.col("t")).withColumn("winrate", win_rate(F.col("w"), F.col("l")))
