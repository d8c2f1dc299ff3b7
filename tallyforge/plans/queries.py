"""The queries over the driver's tables: brands meet in orders (see ``sources.matchups``)."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.config import RankingConfig
from tallyforge.functions import scalar
from tallyforge.operators import composite, consolidate, leagues, matrix, missing_filter, order, posterior, prior, report, strength, validate, weights
from tallyforge.plans import book
from tallyforge.plans import ranking as plan
from tallyforge.sources import cleaning, matchups, page_cache, pages, settings, sinks, state, workbook

ALIASES = {"Brand#2": ["Brand#21", " brand#22 "], "Brand#3": ["BRAND#31"]}
#: Of the finer names (brand and first word of the type) some pairs never meet at small scale; this share may be missing.
MISSING_RATIO = 0.02
FIXED = RankingConfig(fixed_k=6.0)
#: The canonical brands.
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26) if i not in (21, 22, 31))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


class Data:
    """The derived tables of one folder. Those after the pair table have T squared rows at most; what several queries' branches read is saved once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return matchups.raw_matchups(self.table("lineitem"), self.table("part"))

    @property
    def fine_parts(self) -> DataFrame:
        return self.table("part").withColumn("p_brand", F.concat("p_brand", F.lit(" "), F.substring_index("p_type", " ", 1)))

    @cached_property
    def fine_axis(self) -> DataFrame:
        shares = matchups.usage_share(self.table("lineitem"), self.fine_parts)
        return state.saved(matrix.top_meta_canonical(matrix.top_meta(shares), self.aliases).select("deck", "ord"))

    @property
    def shares(self) -> DataFrame:
        return matchups.usage_share(self.table("lineitem"), self.table("part"))

    @cached_property
    def aliases(self) -> DataFrame:
        return consolidate.alias_index(self.spark, ALIASES)

    @cached_property
    def flat(self) -> DataFrame:
        return state.saved(consolidate.flat_table(consolidate.max_n(self.raw), self.aliases))

    @cached_property
    def canonical(self) -> DataFrame:
        return state.saved(matrix.top_meta_canonical(matrix.top_meta(self.shares), self.aliases))

    @property
    def axis(self) -> DataFrame:
        return self.canonical.select("deck", "ord")

    @cached_property
    def cells(self) -> DataFrame:
        return state.saved(matrix.matrices(self.flat, self.axis))

    @cached_property
    def fine_flat(self) -> DataFrame:
        return state.saved(consolidate.flat_table(consolidate.max_n(matchups.raw_matchups(self.table("lineitem"), self.fine_parts)), self.aliases))

    @property
    def declared(self) -> DataFrame:
        return self.canonical.select("deck", F.col("share_frac").alias("share"))

    @cached_property
    def encounters(self) -> DataFrame:
        return weights.encounter_share(self.cells)

    def meta(self, policy: str = "encounter") -> DataFrame:
        return weights.meta_share(self.axis, self.declared, self.encounters, policy)

    def blend(self, cfg: RankingConfig = FIXED) -> DataFrame:
        return state.saved(weights.blend(self.meta(cfg.gap_policy), self.encounters, cfg))

    @cached_property
    def post(self) -> DataFrame:
        return posterior.posterior_cells(self.cells, FIXED.fixed_k)

    @cached_property
    def edges(self) -> DataFrame:
        return state.saved(strength.bt_edges(self.post, FIXED.fixed_k, FIXED))

    def ranked(self, cfg: RankingConfig = FIXED) -> plan.Ranking:
        return plan.rank_entities(consolidate.score_table(self.flat, self.axis), self.axis, self.declared, cfg)


@query
def raw_matchups(spark, d):
    return Data(spark, d).raw


@query
def maxn_flat(spark, d):
    return consolidate.max_n(Data(spark, d).raw)


@query
def alias_index(spark, d):
    return Data(spark, d).aliases


@query
def alias_apply(spark, d):
    x = Data(spark, d)
    return consolidate.apply_alias(x.table("part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")).alias("deck")), "deck", x.aliases)


@query
def alias_coverage(spark, d):
    x = Data(spark, d)
    return consolidate.alias_coverage(x.table("part"), "p_brand", x.aliases)


@query
def count_coercion(spark, d):
    rows = Data(spark, d).table("orders").select(F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b"), F.col("o_orderkey").cast("string").alias("w"), (F.col("o_custkey") - 700).alias("l"), F.col("o_orderpriority").alias("t"))
    return consolidate.with_counts(rows).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wltn"])


@query
def count_numbers(spark, d):
    """Counts as doubles, as text with a fraction of zero and with an exponent, and as text that is no number."""
    line = Data(spark, d).table("lineitem")
    rows = line.select(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b"), F.col("l_quantity").cast("double").alias("w"), F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(".0 ")).alias("l"), F.when(F.col("l_linenumber") == 1, "x1").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit("e2"))).alias("t"))
    return consolidate.with_counts(rows).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wltn"])


@query
def content_digest(spark, d):
    """Digests of three tables, one with NULLs and one with repeated rows."""
    x = Data(spark, d)
    tables = {"region": x.table("region").select("r_regionkey", "r_name"), "kinds": x.table("part").select("p_brand", "p_size"), "holes": x.table("part").select(F.nullif("p_brand", F.lit("Brand#11")).alias("x"), F.nullif("p_type", F.lit("SMALL")).alias("y"))}
    rows = [sinks.content_hash(df).select(F.lit(name).alias("of"), "n_rows", "content") for name, df in tables.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def symmetrize(spark, d):
    return consolidate.symmetrize(consolidate.max_n(Data(spark, d).raw))


@query
def flat_alias(spark, d):
    return Data(spark, d).flat


@query
def usage_share(spark, d):
    return Data(spark, d).shares


@query
def top_meta_cut(spark, d):
    return matrix.top_meta(Data(spark, d).shares)


@query
def top_meta_canonical(spark, d):
    return Data(spark, d).canonical


@query
def top_meta_parts(spark, d):
    """The parts that make 80 percent of all quantity, by name: as many names as parts."""
    x = Data(spark, d)
    named = x.table("part").withColumn("p_brand", F.concat_ws("/", "p_name", "p_partkey"))
    return order.top_share(matchups.usage_share(x.table("lineitem"), named))


@query
def order_ranks(spark, d):
    """Place and running sum of every order by falling price."""
    rows = Data(spark, d).table("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    return order.running(rows, [F.desc("price"), F.col("o_orderkey")], "price").select("o_orderkey", "place", F.col("through").cast("double").alias("through"))


@query
def bootstrap_draws(spark, d):
    """How often each replicate draws each of as many cells as there are orders."""
    n = Data(spark, d).table("orders").count()
    return prior.draws(spark, 5, n, FIXED.seed)


@query
def parse_percent(spark, d):
    rows = Data(spark, d).table("customer").select("c_custkey", F.concat(F.replace(F.format_string("%.2f", F.col("c_acctbal")), F.lit("."), F.lit(",")), F.lit(" %")).alias("x"))
    return rows.select("c_custkey", scalar.parse_percent(F.col("x")).alias("pct"))


@query
def wr_matrix_exclude(spark, d):
    return Data(spark, d).cells.select("a", "b", "w", "l", "t", "wr")


@query
def wr_matrix_half(spark, d):
    x = Data(spark, d)
    return matrix.matrices(x.flat, x.axis, "half", 50.0).select("a", "b", "wr")


@query
def n_dir_cells(spark, d):
    return Data(spark, d).cells.select("a", "b", "n_dir")


@query
def wr_pivot(spark, d):
    return matrix.pivoted(Data(spark, d).flat, "winrate")


@query
def missing_filter_kept(spark, d):
    x = Data(spark, d)
    return missing_filter.kept_entities(matrix.matrices(x.fine_flat, x.fine_axis), MISSING_RATIO).select("deck", "dropped_round")


@query
def score_table(spark, d):
    x = Data(spark, d)
    return consolidate.score_table(x.fine_flat, x.fine_axis)


@query
def encounter_share(spark, d):
    return Data(spark, d).encounters


@query
def meta_share_uniform(spark, d):
    return Data(spark, d).meta("uniform")


@query
def meta_share_encounter(spark, d):
    return Data(spark, d).meta("encounter")


@query
def meta_share_proportional(spark, d):
    return Data(spark, d).meta("proportional")


@query
def meta_blend_fixed(spark, d):
    return Data(spark, d).blend().select("deck", "p_meta", "p_enc", "tv", "corr", "gamma", "p")


@query
def meta_blend_auto(spark, d):
    return Data(spark, d).blend(RankingConfig(auto_gamma=True)).select("deck", "tv", "gamma", "p")


@query
def row_weights(spark, d):
    x = Data(spark, d)
    return weights.row_weights(x.axis, x.blend())


@query
def split_counts(spark, d):
    return prior.splits(Data(spark, d).cells, FIXED.rho_test).select("a", "b", "w_train", "l_train", "w_test", "l_test")


@query
def k_scale(spark, d):
    return prior.scale(Data(spark, d).cells)


@query
def k_grid(spark, d):
    return prior.k_grid(Data(spark, d).cells, FIXED)


@query
def predictive_ll(spark, d):
    cells = Data(spark, d).cells
    return prior.predictive_ll(cells, prior.k_grid(cells, FIXED), FIXED)


@query
def shrink_quantiles(spark, d):
    return prior.shrink_quantiles(Data(spark, d).cells, FIXED.fixed_k)


@query
def k_choice(spark, d):
    """The chosen prior strength."""
    k = prior.choose_k(Data(spark, d).cells, RankingConfig())
    return spark.createDataFrame([(k["k_star"], k["k_used"], k["reason"], k["beta"], k["expansions"], k["delta_ll_100"])], "k_star double, k_used double, reason string, beta double, expansions int, delta_ll_100 double")


@query
def posterior_cells(spark, d):
    return Data(spark, d).post.select("a", "b", "p_hat", "var_hat")


@query
def report_posterior(spark, d):
    return posterior.se_binomial(posterior.report_posterior(Data(spark, d).cells, FIXED.fixed_k)).select("a", "b", "p_hat_pct", "se_pct", "se_binom_pct")


@query
def mas_se_lb(spark, d):
    x = Data(spark, d)
    return posterior.mas_se_lb(x.post, x.blend())


@query
def bt_edges(spark, d):
    return Data(spark, d).edges.select("a", "b", "n_ij", "n_ji", "n_base", "s_bar", "p_bar")


@query
def bt_diagnostics(spark, d):
    x = Data(spark, d)
    return strength.bt_diagnostics(x.edges, x.axis, FIXED.fixed_k, FIXED)


@query
def bt_soft_weights(spark, d):
    x = Data(spark, d)
    return strength.soft_weights(x.edges, strength.bt_diagnostics(x.edges, x.axis, FIXED.fixed_k, FIXED))


@query
def bt_strength(spark, d):
    x = Data(spark, d)
    return strength.bt_strength(bt_soft_weights(spark, d), x.axis, FIXED).select("deck", "pi")


@query
def bt_percent(spark, d):
    x = Data(spark, d)
    return strength.bt_percent(bt_strength(spark, d), x.edges)


class Regions:
    """Suppliers meet in the orders of one region's customers: a league for each region."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.x = Data(spark, sf_dir)
        self.n = self.x.table("lineitem").count()

    def lines(self, deck: Column, how: str = "merge") -> DataFrame:
        """(event, league, deck, value) of each line, by event."""
        x, n = self.x, self.n
        where = x.table("customer").join(x.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(x.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("league"))
        orders = state.dealt(state.dealt(x.table("orders").select(F.col("o_orderkey").alias("event"), "o_custkey"), n, "o_custkey").join(state.dealt(where, n, "o_custkey").hint(how), "o_custkey").select("event", "league"), n, "event")
        lines = x.table("lineitem").select(F.col("l_orderkey").alias("event"), deck, F.col("l_quantity").alias("value"))
        return state.dealt(lines, n, "event").join(orders.hint(how), "event")

    @cached_property
    def pairs(self) -> DataFrame:
        return state.saved(matchups.league_matchups(self.lines(F.format_string("S%06d", "l_suppkey").alias("deck")), self.n))

    @property
    def axis(self) -> DataFrame:
        return self.pairs.select("league", F.explode(F.array("a", "b")).alias("deck")).distinct()

    @property
    def columns(self) -> DataFrame:
        """(league, node, known, rows) for the filter, suppliers by their keys; a pair's two cells are known together."""
        by = self.x.table("lineitem").where("l_suppkey IS NOT NULL").groupBy("l_suppkey").agg(F.count("*").alias("n"))
        many = F.collect_list(F.when(F.col("n") > state.ROWS_A_TASK, F.struct("l_suppkey", "n")))
        low, high, often = by.agg(F.min("l_suppkey"), F.max("l_suppkey"), many).first()
        node = F.col("l_suppkey").cast("int" if low is not None and -(2**31) <= low and high < 2**31 else "bigint").alias("node")
        lines = self.lines(node, "shuffle_hash").where("node IS NOT NULL")
        met = matchups.league_columns(lines, self.n, {r.l_suppkey: math.ceil(r.n / state.ROWS_A_TASK) for r in often})
        return state.saved(met.select("league", "node", F.size("rows").cast("bigint").alias("known"), "rows"))

    def both(self) -> DataFrame:
        """Both directions of each pair, entities named by league and name."""
        sides = F.inline(F.array(F.struct("a", "b", "w", "l"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("l").alias("w"), F.col("w").alias("l"))))
        return self.pairs.where("w + l > 0").select("league", sides)

    def weights(self) -> DataFrame:
        """(league, a, b, n_eff, w_ij, w_ji) by the edges' usual rules, at a fixed power."""
        name = lambda c: F.concat_ws("/", "league", c).alias(c)
        n, k = F.col("w") + F.col("l"), FIXED.fixed_k
        # Both directions of a pair have the same matches, so the edges' rule of confidence holds before they are met as well.
        sure = self.both().where(scalar.confidence(n, k) >= FIXED.n_min_bt / (FIXED.n_min_bt + k))
        post = sure.select(name("a"), name("b"), name("a").alias("a_ord"), name("b").alias("b_ord"), n.alias("n_dir"), ((F.col("w") + FIXED.mu * k) / (n + k)).alias("p_hat"))
        power = self.pairs.sparkSession.createDataFrame([(1.5,)], "power double")
        soft = strength.soft_weights(strength.bt_edges(post, k, FIXED), power)
        bare = lambda c: F.substring_index(c, "/", -1).alias(c)
        return soft.select(F.substring_index("a", "/", 1).alias("league"), bare("a"), bare("b"), "n_eff", "w_ij", "w_ji")


@query
def league_weights(spark, d):
    return Regions(spark, d).weights()


@query
def league_strength(spark, d):
    """Bradley-Terry strengths of each region's suppliers."""
    x = Regions(spark, d)
    axis = x.axis.withColumn("ord", F.row_number().over(Window.partitionBy("league").orderBy("deck")))
    return leagues.strengths(state.saved(x.weights()), axis, FIXED).select("league", "deck", "pi")


@query
def league_filter(spark, d):
    """Of each region's suppliers, those that have met too few others go, round by round."""
    kept = leagues.kept_of_columns(Regions(spark, d).columns, 0.05)
    return kept.select("league", F.format_string("S%06d", "node").alias("deck"), "dropped_round")


@query
def composite_score(spark, d):
    rows = Data(spark, d).table("supplier").select(F.col("s_name").alias("deck"), F.col("s_acctbal").alias("lb"), (F.col("s_suppkey") % 17).cast("double").alias("bt"))
    return composite.composite(rows).select("deck", "score")


@query
def ranking(spark, d):
    return Data(spark, d).ranked().ranking


@query
def ranking_auto(spark, d):
    """The whole way, with the missing-cell filter and the cross-validated prior."""
    x = Data(spark, d)
    cfg = RankingConfig()
    score, kept, canonical = plan.records_to_score(x.raw, x.shares, x.aliases, cfg)
    return plan.rank_entities(score, kept, canonical.select("deck", F.col("share_frac").alias("share")), cfg).ranking


@query
def ranking_topk(spark, d):
    return ranking(spark, d).where("rank <= 10").select("rank", "deck", "score")


@query
def coverage(spark, d):
    x = Data(spark, d)
    return composite.coverage(matrix.matrices(x.fine_flat, x.fine_axis))


@query
def missing_pairs(spark, d):
    x = Data(spark, d)
    return composite.missing_pairs(matrix.matrices(x.fine_flat, x.fine_axis))


@query
def pairs_by_entity(spark, d):
    return book.report_pairs(Data(spark, d).ranked())


@query
def pairs_report(spark, d):
    return report.pairs_view(pairs_by_entity(spark, d)).drop("gap_flag", "is_mirror", "is_topk")


@query
def report_sheets(spark, d):
    r = book.settled(Data(spark, d).ranked())
    return report.book_sheets(book.report_pairs(r), r.ranking, report.legend(r.ranking, book.settings_of(r)).count())


@query
def legend(spark, d):
    return report.legend(ranking(spark, d), {"prior strength": FIXED.fixed_k})


@query
def ranking_display(spark, d):
    return report.shown_ranking(ranking(spark, d), 9, ["rank", "deck", "nothing", "score", "n_eff", "coverage_pct"], {"score": 1})


@query
def pairs_sorted(spark, d):
    """Each entity's opponents by gap."""
    return report.pairs_view(pairs_by_entity(spark, d), self_row=False, sort_by="gap").select("a", "b_rank", "opponent", "gap")


@query
def workbook_cells(spark, d):
    """A workbook with a sheet for each brand, written by tasks and read back as cells: sizes, parts, their highest price; many parts are marked."""
    part = Data(spark, d).table("part")
    rows = part.groupBy("p_brand", "p_size").agg(F.count("*").alias("parts"), F.max("p_retailprice").alias("price"))
    brands = part.select("p_brand").distinct().withColumn("place", F.dense_rank().over(Window.orderBy("p_brand")) - 1)
    cells = workbook.cells_of(rows, ["p_size", "parts", "price"], {"parts": F.when(F.col("parts") >= 3, "red").when(F.col("parts") == 2, "yellow")})
    body = rows.join(brands, "p_brand").select("place", F.col("p_brand").alias("sheet"), F.col("p_size").cast("long").alias("row"), cells.alias("cells"))
    heads = brands.select("place", F.col("p_brand").alias("sheet"), F.lit(-1).cast("long").alias("row"), workbook.header(["p_size", "parts", "price"]).alias("cells"))
    path = f"{state.shared_home(spark)}.xlsx"
    workbook.write(body.unionByName(heads), path)
    return workbook.read(spark, path).where("row > 0").select("sheet", "row", "col", "number", "style")


@query
def sheet_order(spark, d):
    """Brands, their kinds of sheet and all types as the sheets of one workbook, brands in falling order of name."""
    part = Data(spark, d).table("part")
    brands = part.select(F.col("p_brand").alias("deck")).distinct()
    fixed = spark.createDataFrame([("01_Summary",), ("00_Legenda",)], "sheet string")
    sheets = brands.select(F.explode(F.array("deck", F.concat("deck", F.lit(" b")), F.concat(F.lit("x "), F.lower("deck")))).alias("sheet")).unionByName(part.select(F.col("p_type").alias("sheet")).distinct()).unionByName(fixed)
    return report.sheet_order(sheets, brands.withColumn("ord", F.row_number().over(Window.orderBy(F.desc("deck")))))


@query
def sheet_order_parts(spark, d):
    """Names of parts, cut, spelt otherwise or inside others, as sheets in the order of all names: as many as parts."""
    part = Data(spark, d).table("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_partkey").alias("deck"))
    name, key = F.col("deck"), F.col("p_partkey")
    sheet = F.when(key % 4 == 0, F.upper(name)).when(key % 4 == 1, F.concat(F.lit("my "), name)).when(key % 4 == 2, F.substring(name, 3, 60)).otherwise(F.concat(F.lit("none "), key.cast("string"), F.lit("?")))
    return report.sheet_order(part.select(sheet.alias("sheet")).distinct(), part.select("deck", key.alias("ord")))


@query
def report_workbook(spark, d):
    """The report of the ranking as a workbook, read back: sheets in order, their rows without the header, marked cells."""
    r = book.settled(Data(spark, d).ranked())
    path = f"{state.shared_home(spark)}.xlsx"
    workbook.write(book.report_rows(r, contrib=True), path)
    cells = workbook.read(spark, path)
    return cells.groupBy("place", "sheet").agg(F.max("row").alias("n_rows"), F.count_if(F.col("style") == "green").alias("best"), F.count_if(F.col("style") == "red").alias("strong"))


@query
def summary_sheet(spark, d):
    return report.summary(ranking(spark, d))


@query
def heatmap_cells(spark, d):
    r = Data(spark, d).ranked()
    return report.heatmap(r.cells, r.ranking, 12, True)


@query
def gap_flags(spark, d):
    rows = Data(spark, d).table("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 25).alias("gap"))
    return rows.groupBy(report.gap_flag(F.col("gap")).alias("gap_flag")).agg(F.count("*").alias("n"))


@query
def topk_contrib(spark, d):
    return pairs_by_entity(spark, d).where("is_topk").select("a", "opponent", "contrib")


@query
def sheet_names(spark, d):
    return report.sheet_names(Data(spark, d).table("part").select(F.concat(F.col("p_type"), F.lit("/"), F.col("p_name")).alias("deck")).distinct())


@query
def validate_matrix(spark, d):
    return validate.validate_matrix(Data(spark, d).cells)


@query
def validate_shape(spark, d):
    x = Data(spark, d)
    return validate.validate_shape(matrix.matrices(x.fine_flat, x.fine_axis))


@query
def declared_usage(spark, d):
    """Declared shares under other names, in text, from a table with more columns."""
    x = Data(spark, d)
    table = x.shares.select(F.lit(1).alias("Place"), F.concat(F.lit(" "), "deck").alias("Archetype"), F.when(F.col("deck") == "Brand#11", "n/a").otherwise(F.col("share").cast("string")).alias("Usage_%"))
    return settings.declared_shares(table)


@query
def validate_score(spark, d):
    x = Data(spark, d)
    return validate.validate_score(consolidate.score_table(x.fine_flat, x.fine_axis), x.fine_axis)


@query
def validate_missing(spark, d):
    x = Data(spark, d)
    return validate.validate_missing(matrix.matrices(x.fine_flat, x.fine_axis), MISSING_RATIO, 1)


@query
def validate_coverage(spark, d):
    x = Data(spark, d)
    return validate.validate_coverage(consolidate.score_table(x.fine_flat, x.fine_axis), matrix.matrices(x.fine_flat, x.fine_axis), MISSING_RATIO)


@query
def validate_recomputed(spark, d):
    x = Data(spark, d)
    return validate.validate_recomputed(matrix.matrices(x.fine_flat, x.fine_axis), consolidate.score_table(x.fine_flat, x.fine_axis))


@query
def validate_bt_weights(spark, d):
    return validate.validate_bt_weights(bt_soft_weights(spark, d))


@query
def validate_verdict(spark, d):
    x = Data(spark, d)
    cells, score = matrix.matrices(x.fine_flat, x.fine_axis), consolidate.score_table(x.fine_flat, x.fine_axis)
    return validate.verdict([validate.validate_matrix(cells), validate.validate_score(score, x.fine_axis), validate.validate_coverage(score, cells, MISSING_RATIO), validate.validate_recomputed(cells, score)])


@query
def axis_difference(spark, d):
    x = Data(spark, d)
    return matrix.axis_difference(x.axis, x.table("part").select(F.col("p_brand").alias("deck")))


@query
def label_keys(spark, d):
    spelling = F.concat(F.lit(" "), F.replace("p_type", F.lit(" "), F.lit("  ")), F.lit(" "))
    return Data(spark, d).table("part").select("p_partkey", scalar.any_label_key(spelling).alias("inner_key"), scalar.outer_key(spelling).alias("outer_key"))


@query
def alias_unchanged(spark, d):
    x = Data(spark, d)
    return consolidate.apply_alias(x.table("part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")).alias("deck")), "deck", x.aliases, trim=False)


@query
def usage_columns(spark, d):
    return settings.entity_and_share(Data(spark, d).shares.select(F.lit(1).alias("Place"), F.col("share").alias(" Usage_% "), F.concat("deck", F.lit(" ")).alias("Archetype")))


def stored(spark, df, name: str) -> str:
    """The path of ``df``, written as versioned CSV."""
    home = state.shared_home(spark)
    written = [sinks.write_csv_versioned(df, home, name, False, datetime(2024, 1, 15))]
    return matchups.latest(written, name)


@query
def csv_flat(spark, d):
    return matchups.read_flat(spark, stored(spark, Data(spark, d).flat.select("a", "b", "w", "l", "t", "n", "winrate"), "flat"))


@query
def csv_matrix(spark, d):
    return matchups.read_matrix(spark, stored(spark, wr_pivot(spark, d), "matrix"))


class Site:
    """Pages made of the records: one for each entity, as a site would show them. Those up to Brand#3 were cached in time."""

    NOW = "2024-01-15 12:00:00"

    def __init__(self, spark: SparkSession, sf_dir: str):
        row = F.format_string("<tr><td><a href='/x'>%s</a></td><td>%s</td><td>%d - %d - %d</td><td>%s %%</td></tr>", "b", F.format_number("n", 0), "w", "l", "t", F.replace(F.format_string("%.2f", "winrate"), F.lit("."), F.lit(",")))
        rows = F.array_join(F.sort_array(F.collect_list(row)), "")
        table = F.concat(F.lit("<table><thead><tr><th>Deck</th><th>Matches</th><th>Score</th><th>Win %</th></tr></thead><tbody>"), rows, F.lit("</tbody></table>"))
        self.pages = consolidate.max_n(Data(spark, sf_dir).raw).groupBy(F.col("a").alias("deck")).agg(table.alias("html")).withColumn("url", F.concat(F.lit("https://example.com/"), F.col("deck")))

    def scanned(self) -> DataFrame:
        stamp = F.when(F.col("deck") < "Brand#3", "2024-01-15 01:00:00").otherwise("2024-01-14 01:00:00").cast("timestamp")
        cache = self.pages.select(pages.cache_key(F.col("url")).alias("cache_key"), "html", stamp.alias("fetched_at"))
        return pages.scan(self.pages.select("deck", "url"), "deck", cache, self.pages, F.to_timestamp(F.lit(self.NOW)))


@query
def page_scan(spark, d):
    return pages.parse_matchups(Site(spark, d).scanned())


@query
def page_scan_counts(spark, d):
    return pages.scan_counts(Site(spark, d).scanned())


@query
def page_decklist(spark, d):
    """One page with the usage table, read back."""
    x = Data(spark, d)
    sold = x.table("lineitem").join(x.table("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    row = F.format_string("<tr><td>%05d</td><td><a href='/decks/%s'>%s</a></td><td>%d %%</td><td>%d</td></tr>", "rank", "p_brand", "p_brand", F.floor(F.col("q") * 100 / F.col("total")), "q")
    rows = sold.withColumns({"rank": F.row_number().over(Window.orderBy(F.desc("q"), "p_brand")), "total": F.sum("q").over(weights.whole())})
    head = F.lit("<table><tr><th>Rank</th><th>Deck</th><th>Share</th><th>Count</th></tr>")
    return pages.parse_decklist(rows.agg(F.concat(head, F.array_join(F.sort_array(F.collect_list(row)), ""), F.lit("</table>")).alias("html")))


@query
def cached_fetch(spark, d):
    """Page p is in the cache as of each event of user p before noon of a day in January."""
    x = Data(spark, d)
    now = F.to_timestamp(F.lit(Site.NOW))
    cache = x.table("pages").join(x.table("events").where(F.col("ts") < now), F.col("page_id") == F.col("user_id")).select(pages.cache_key(F.trim("url")).alias("cache_key"), "html", F.col("ts").alias("fetched_at"))
    return pages.with_cache(x.table("pages").select("page_id", "url"), cache, now, 720).select("page_id", "from_cache", F.col("html").isNotNull().alias("has_html"))


@query
def cache_writeback(spark, d):
    """Pages are fetched through a new cache: those with an even number first, an hour later all; then all again."""
    site = Data(spark, d).table("pages").select("page_id", "url", "html")
    cache = page_cache.PageCache(spark, state.shared_home(spark))
    fetcher = lambda urls: urls.join(site.groupBy(F.trim("url").alias("url")).agg(F.max("html").alias("html")), "url")
    hour = lambda h: F.to_timestamp(F.lit(f"2024-01-15 {h}:00:00"))
    wanted = site.select("page_id", "url")
    cache.fetch(wanted.where("page_id % 2 = 0"), fetcher, hour(10), 720)
    second = cache.fetch(wanted, fetcher, hour(11), 720).select("page_id", F.col("from_cache").alias("second"))
    third = cache.fetch(wanted, fetcher, hour(12), 720).select("page_id", F.col("from_cache").alias("third"), F.length("html").cast("bigint").alias("chars"))
    return second.join(third, "page_id")


@query
def retention_applied(spark, d):
    """Nations' customers as versioned CSV for each region, and then only the latest versions left."""
    x = Data(spark, d)
    home = state.shared_home(spark)
    rows = x.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n")).join(x.table("nation"), "n_nationkey")
    for r in x.table("region").orderBy("r_regionkey").collect():
        sinks.write_csv_versioned(rows.where(F.col("n_regionkey") == r.r_regionkey).select("n_name", "n"), home, f"score_{r.r_regionkey}", r.r_regionkey % 2 == 0, datetime(2024, 1, 15), {"score": "scores"})
    done = cleaning.clean(spark, home, apply=True)
    left = cleaning.listed(spark, home).select(F.lit("left").alias("action"), F.lit(False).alias("done"))
    return done.select("action", "done").unionByName(left).groupBy("action", "done").agg(F.count("*").alias("n"))


@query
def alias_file(spark, d):
    """A type's brands as spellings of its name, kept as a JSON file and read back."""
    part = Data(spark, d).table("part")
    makers = part.groupBy("p_type").agg(F.collect_set("p_brand").alias("brands"))
    path = state.shared_home(spark)
    makers.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("p_type", "brands")))).alias("value")).coalesce(1).write.text(path)
    return settings.read_aliases(spark, path).select("canonical", "spelling")


@query
def pivot_strict(spark, d):
    """The wide win rates of cells that must occur once."""
    return matrix.pivoted(Data(spark, d).flat, "winrate", BRANDS, strict=True)


@query
def bt_without_edges(spark, d):
    """No pair has enough matches for an edge: all are of even strength."""
    x = Data(spark, d)
    cfg = RankingConfig(fixed_k=6.0, n_min_bt=1e9)
    none = strength.bt_edges(x.post, 6.0, cfg)
    soft = strength.soft_weights(none, strength.bt_diagnostics(none, x.axis, 6.0, cfg))
    return strength.bt_percent(strength.bt_strength(soft, x.axis, cfg), none)


@query
def matchup_url(spark, d):
    return Data(spark, d).table("pages").select("page_id", pages.matchup_url(F.col("url")).alias("matchup_url"))


@query
def cache_key(spark, d):
    return Data(spark, d).table("pages").select("page_id", pages.cache_key(F.col("url")).alias("cache_key"))


@query
def cache_fresh(spark, d):
    now = F.to_timestamp(F.lit("2024-01-15 12:00:00"))
    return Data(spark, d).table("events").select("event_id", pages.is_fresh(F.col("ts"), now, 720).alias("fresh"))


@query
def url_dedupe(spark, d):
    rows = Data(spark, d).table("pages").select("page_id", F.concat(F.lit(" "), F.regexp_replace("url", r"[?#].*$", "")).alias("url"))
    return pages.distinct_urls(rows, "page_id").select("page_id", F.trim("url").alias("url"))


@query
def retention_plan(spark, d):
    stamp = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_120000.csv"))
    tail = F.when(F.col("o_orderkey") % 3 == 0, F.lit("latest.csv")).otherwise(stamp)
    home = F.when(F.col("o_orderkey") % 5 == 0, F.lit("out/archives/score_")).otherwise(F.lit("out/score_"))
    return sinks.retention(Data(spark, d).table("orders").select("o_orderkey", F.concat(home, tail).alias("path"))).groupBy("action").agg(F.count("*").alias("n"))
