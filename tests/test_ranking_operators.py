"""Hand vectors for the ranking operators."""

import json
import math
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyforge.config import RankingConfig
from tallyforge.functions import scalar
from tallyforge.operators import composite, consolidate, matrix, missing_filter, posterior, prior, report, strength, validate, weights
from tallyforge.plans import book
from tallyforge.plans import ranking as plan
from tallyforge.sources import matchups, pages, settings, sinks, workbook
from tallyforge.streaming import ingest


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).first()[0]


def test_max_n_sums_ties(spark):
    raw = spark.createDataFrame([("A", "B", 3, 1, 0, 4), ("A", "B", 2, 2, 0, 4), ("A", "B", 1, 0, 0, 1)], "a string, b string, w long, l long, t long, n long")
    r = consolidate.max_n(raw).first()
    assert (r.w, r.l, r.t, r.n, r.winrate) == (5, 3, 0, 8, 62.5)


@pytest.mark.parametrize(("rows", "want"), [([("A", "B", 6, 4, 1, 11), ("B", "A", 5, 4, 3, 12)], (6, 4)), ([("A", "B", 3, 2, 0, 5), ("B", "A", 1, 4, 0, 5)], (3, 2))])
def test_symmetrize(spark, rows, want):
    out = {(r.a, r.b): (r.w, r.l) for r in consolidate.symmetrize(spark.createDataFrame(rows, "a string, b string, w long, l long, t long, n long")).collect()}
    assert out == {("A", "B"): want, ("B", "A"): want[::-1]}


def test_win_rate_rounds_half_even(spark):
    assert one(spark, scalar.win_rate(F.col("w"), F.col("l")), w=1, l=31) == 3.12
    assert one(spark, scalar.win_rate(F.col("w"), F.col("l"), F.col("t"), "half"), w=2, l=1, t=1) == 62.5
    assert one(spark, scalar.win_rate(F.col("w"), F.col("l")), w=0, l=0) is None


def test_split_counts(spark):
    cases = {(7, 3): (5, 2, 2, 1), (1, 0): (1, 0, 0, 0), (1, 1): (1, 0, 0, 1), (2, 2): (1, 1, 1, 1), (0, 5): (0, 3, 0, 2), (1, 2): (1, 1, 0, 1), (10, 0): (7, 0, 3, 0)}
    rows = spark.createDataFrame(list(cases), "w long, l long").withColumns(scalar.split_counts(F.col("w"), F.col("l"), 1 / 3)).collect()
    assert {(r.w, r.l): (r.w_train, r.l_train, r.w_test, r.l_test) for r in rows} == cases


def test_labels_and_numbers(spark):
    assert one(spark, scalar.label_key(F.col("x")), x="  Foo   BAR ") == "foo bar"
    assert one(spark, scalar.label_key_unicode(F.col("x")), x="ﬁ  ẞ") == "fi ss"
    assert one(spark, scalar.parse_percent(F.col("x")), x="12,5 %") == 12.5
    assert one(spark, scalar.count_of(F.col("x")), x="abc") == 0 and one(spark, scalar.count_of(F.col("x")), x="-4") == 0
    assert abs(one(spark, scalar.normal_cdf(F.col("x")), x=1.224745 * 0.72) - 0.5 * (1 + math.erf(1.224745 * 0.72 / math.sqrt(2)))) < 1e-12


@pytest.mark.parametrize(("x", "want"), [("12", 12), ("12.0", 12), (" 7 ", 7), ("1e3", 1000), (12.0, 12), (1e7, 10**7), ("9007199254740993", 2**53 + 1), ("", 0), ("12d", 0), ("nan", 0), (float("nan"), 0), (-2.5, 0), ("-inf", 0), (None, 0), (".5e1", 5)])
def test_counts_of_any_form(spark, x, want):
    assert one(spark, scalar.count_of(F.col("x")), x=x) == want


@pytest.mark.parametrize("x", ["2.5", 0.1, "inf", 1e30])
def test_counts_that_are_none(spark, x):
    with pytest.raises(Exception, match="not a whole count"):
        one(spark, scalar.count_of(F.col("x")), x=x)


def test_shape_of_cells(spark):
    cells = lambda *pairs: spark.createDataFrame(pairs, "a string, b string")
    bad = lambda df: {r.check: r.n_bad for r in validate.validate_shape(df).collect()}
    assert not any(bad(cells(("x", "x"), ("x", "y"), ("y", "x"), ("y", "y"))).values())
    assert bad(cells(("x", "x"), ("x", "y"), ("x", "y"), ("x", "z"))) == {"one_axis_only": 2, "no_name": 0, "cell_missing": 6, "cell_twice": 1}


def test_outer_keys_and_declared_shares(spark):
    assert one(spark, scalar.any_outer_key(F.col("x")), x="  Stra\u00dfe  \uff11 ") == "strasse  1" and one(spark, scalar.any_outer_key(F.col("x")), x=" A  b ") == "a  b"
    usage = spark.createDataFrame([("skip", " One ", "12.5"), ("skip", "Two", "x"), ("skip", "One", "7")], "Rank string, Name string, `Share_%` string")
    assert {r.deck: r.share for r in settings.declared_shares(usage).collect()} == {"One": 19.5, "Two": 0.0}
    assert settings.declared_shares(usage.select("Rank", "Name")) is None and settings.declared_shares(usage.drop("Name")) is None
    axis = spark.createDataFrame([("One", 1), ("Two", 2)], "deck string, ord int")
    flat = spark.createDataFrame([("One", "Two", 7, 3, 0), ("Two", "One", 3, 7, 0)], "a string, b string, w long, l long, t long")
    weights_of = lambda declared: {r.deck: r.p_meta for r in plan.rank_entities(flat, axis, declared, RankingConfig(fixed_k=6.0, gap_policy="none")).weights.collect()}
    assert weights_of(usage) == {"One": 1.0, "Two": 0.0} and weights_of(usage.drop("Name")) == {"One": 0.5, "Two": 0.5}


@pytest.mark.parametrize("name", ["half_ties", "half_ties_weight", "beta_expansions"])
def test_settings_that_are_none_are_named(name):
    with pytest.raises(TypeError, match=name):
        RankingConfig.of({name: 1})


def test_an_unknown_route_is_told():
    with pytest.warns(UserWarning, match="no route"):
        assert sinks.route("out", "zzz", {"score": "scores"}) == "out"


def test_max_n_of_doubles(spark):
    r = consolidate.max_n(spark.createDataFrame([("a", "b", 3.0, 1.0, 0.0)], "a string, b string, w double, l double, t double")).first()
    assert (r.w, r.l, r.t, r.n) == (3, 1, 0, 4)


def test_matrix_with_any_names(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("deck,Mr. Mime,a`b,plain\nMr. Mime,,1.5,x\na`b,2,,3\n")
    cells = {(r.a, r.b): r.value for r in matchups.read_matrix(spark, str(path)).collect()}
    assert cells == {("Mr. Mime", "Mr. Mime"): None, ("Mr. Mime", "a`b"): 1.5, ("Mr. Mime", "plain"): None, ("a`b", "Mr. Mime"): 2.0, ("a`b", "a`b"): None, ("a`b", "plain"): 3.0}


def test_sheet_names_reserve_and_ignore_case(spark):
    names = spark.createDataFrame([("Abc",), ("abc",), ("01_Summary",), ("00_legenda",), ("ABC",), ("x" * 40,), ("X" * 33,)], "deck string")
    out = {r.deck: r.sheet for r in report.sheet_names(names).collect()}
    assert out["01_Summary"] == "01_Summary~2" and out["00_legenda"] == "00_legenda~2" and len({s.lower() for s in out.values()}) == 7
    assert {out["ABC"], out["Abc"], out["abc"]} == {"ABC", "Abc~2", "abc~3"} and max(map(len, out.values())) == 31
    assert sinks.workbook_names(["01_Summary", "a", "A"], sinks.FIXED_SHEETS) == ["01_Summary~2", "a", "A~2"]


def test_content_hash_tells_nulls_and_columns_apart(spark):
    digest = lambda rows, schema="a string, b string": sinks.content_hash(spark.createDataFrame(rows, schema)).first().content
    rows = [[("x", None)], [(None, "x")], [("x", "")], [("", "x")], [("x", "null")], [(None, None)], [("-", None)], [("x", None)] * 2, []]
    assert len({digest(r) for r in rows}) == len(rows)
    assert digest([("1",)], "a string") != digest([(1,)], "a int") and digest([("x", None)]) == digest([(None, "x")], "b string, a string")
    assert digest([("x", "y"), ("z", None)]) == digest([("z", None), ("x", "y")])


def test_top_meta_keeps_through_the_threshold(spark):
    shares = spark.createDataFrame([("a", 50.0), ("b", 25.0), ("c", 10.0), ("d", 8.0)], "deck string, share double")
    assert [r.deck for r in matrix.top_meta(shares).orderBy("share_cum").collect()] == ["a", "b", "c"]


def test_alias_first_wins(spark):
    index = {r.key: r.canonical for r in consolidate.alias_index(spark, {"One": ["x  y"], "Two": ["X Y", "z"]}).collect()}
    assert index == {"one": "One", "x y": "One", "two": "Two", "z": "Two"}


def grid(spark, wr, t=3):
    decks = "abcdefgh"[:t]
    return spark.createDataFrame([(x, i + 1, y, j + 1, None if x == y else wr.get((x, y))) for i, x in enumerate(decks) for j, y in enumerate(decks)], "a string, a_ord int, b string, b_ord int, wr double")


def test_missing_filter_drops_ties_together(spark):
    full = {(x, y): 50.0 for x in "abcde" for y in "abcde" if x != y}
    for x, y in [("a", "b"), ("a", "c"), ("d", "b"), ("d", "c"), ("e", "a")]:
        full.pop((x, y))
    out = {r.deck: r.dropped_round for r in missing_filter.kept_entities(grid(spark, full, 5)).collect()}
    assert out == {"a": 1, "d": 1, "b": None, "c": None, "e": None}


def cells_of(spark, rows, decks):
    flat = spark.createDataFrame(rows, "a string, b string, w long, l long, t long")
    axis = spark.createDataFrame([(d, i + 1) for i, d in enumerate(decks)], "deck string, ord int")
    return matrix.matrices(flat, axis), axis


def test_posterior_and_mean(spark):
    cells, _ = cells_of(spark, [("A", "B", 7, 3, 0), ("B", "A", 3, 7, 0)], "ABC")
    post = {(r.a, r.b): (r.p_hat, r.var_hat) for r in posterior.posterior_cells(cells, 6.0).collect()}
    assert post["A", "B"][0] == pytest.approx(0.625) and post["A", "B"][1] == pytest.approx(0.0137867647)
    assert post["A", "C"][0] == 0.5 and post["A", "A"][0] is None
    w = spark.createDataFrame([("A", 0.5), ("B", 0.3), ("C", 0.2)], "deck string, p double")
    out = {r.deck: r for r in posterior.mas_se_lb(posterior.posterior_cells(cells, 6.0), w).collect()}
    assert out["A"].mas == pytest.approx(62.5) and (out["C"].mas, out["C"].se, out["C"].lb) == (0, 0, 0)
    assert all(r.lb <= r.mas for r in out.values())


def test_bt_two_entities(spark):
    axis = spark.createDataFrame([("x", 1), ("y", 2)], "deck string, ord int")
    soft = spark.createDataFrame([("x", "y", 10.0, 6.0, 4.0)], "a string, b string, n_eff double, w_ij double, w_ji double")
    solved = strength.bt_strength(soft, axis, RankingConfig())
    pi = {r.deck: r.pi for r in solved.collect()}
    assert pi["x"] == pytest.approx(1.167748, abs=1e-5) and pi["y"] == pytest.approx(0.856349, abs=1e-5)
    bt = {r.deck: r.bt for r in strength.bt_percent(solved, soft).collect()}
    assert bt["x"] == pytest.approx(73.105858, abs=1e-4) and bt["y"] == pytest.approx(26.894142, abs=1e-4)


def test_near_share_is_an_absolute_band(spark):
    # At K = 6 the least confidence is 5 / 11 = 0.4545, so the band ends below 0.5545: three of four edges.
    edges = spark.createDataFrame([("x", "y", 0.4546, 9.0, 0.6), ("x", "z", 0.52, 9.0, 0.6), ("y", "z", 0.554, 9.0, 0.4), ("x", "u", 0.5546, 9.0, 0.5)], "a string, b string, s_bar double, n_base double, p_bar double")
    axis = spark.createDataFrame([(d, i) for i, d in enumerate("xyzu")], "deck string, ord int")
    assert strength.bt_diagnostics(edges, axis, 6.0, RankingConfig()).first().near_share == 0.75


def test_leagues_are_solved_apart(spark):
    axis = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1), ("b", "y", 2)], "league string, deck string, ord int")
    soft = spark.createDataFrame([("a", "x", "y", 10.0, 6.0, 4.0), ("b", "x", "y", 10.0, 4.0, 6.0)], "league string, a string, b string, n_eff double, w_ij double, w_ji double")
    pi = {(r.league, r.deck): r.pi for r in strength.bt_strength(soft, axis, RankingConfig()).collect()}
    assert pi["a", "x"] == pytest.approx(1.167748, abs=1e-5) == pi["b", "y"] and pi["a", "y"] == pytest.approx(0.856349, abs=1e-5) == pi["b", "x"]


def test_log_gamma_and_keys(spark):
    rows = spark.createDataFrame([(x,) for x in (1e-3, 0.5, 1.0, 2.0, 3.7, 9.99, 10.0, 55.5, 1e4, 1e7)], "x double")
    for r in rows.select("x", scalar.log_gamma(F.col("x")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-11, abs=1e-11)
    index = consolidate.alias_index(spark, {"Strasse": ["STRAßE"]})
    named = consolidate.apply_alias(spark.createDataFrame([("straße",), (" Other ",), ("strasse",), (None,)], "deck string"), "deck", index)
    assert [r.deck for r in named.collect()] == ["Strasse", "Other", "Strasse", None]


def test_pivot(spark):
    cells = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 2.0), ("b", "a", 4.0)], "a string, b string, v double")
    wide = matrix.pivoted(cells.withColumn("b", F.concat(F.lit("to_"), "b")), "v")
    assert {(r.a, r.to_a, r.to_b) for r in wide.collect()} == {("a", None, 3.0), ("b", 4.0, None)}
    with pytest.raises(ValueError):
        matrix.pivoted(cells, "v", strict=True)
    one, two = (spark.createDataFrame([(x,) for x in names], "deck string") for names in ("ab", "bc"))
    assert {tuple(r) for r in matrix.axis_difference(one, two).collect()} == {("a", "right"), ("c", "left")}


def test_bt_without_edges(spark):
    axis = spark.createDataFrame([("x", 1), ("y", 2)], "deck string, ord int")
    none = spark.createDataFrame([], "a string, b string, n_eff double, w_ij double, w_ji double")
    assert [r.bt for r in strength.bt_percent(strength.bt_strength(none, axis, RankingConfig()), none).collect()] == [50.0, 50.0]


def test_composite(spark):
    rows = spark.createDataFrame([("a", 40.0, 1.0), ("b", 50.0, 1.0), ("c", 60.0, 1.0)], "deck string, lb double, bt double")
    out = {r.deck: r.score for r in composite.composite(rows, 1.0).collect()}
    assert out["c"] == pytest.approx(88.966432, abs=1e-5) and out["b"] == pytest.approx(50)


def test_blend_weights(spark):
    cfg = RankingConfig(auto_gamma=True)
    meta = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "deck string, p_meta double")
    enc = spark.createDataFrame([("a", 0.2), ("b", 0.3), ("c", 0.5)], "deck string, p_enc double")
    rows = weights.blend(meta, enc, cfg).collect()
    assert rows[0].tv == pytest.approx(0.3) and rows[0].gamma == pytest.approx(0.55) and sum(r.p for r in rows) == pytest.approx(1)


def test_choice_of_k(spark):
    rows = [(x, y, 5 + (i * 7 + j * 3) % 9, 4 + (i * 5 + j) % 7, 0) for i, x in enumerate("ABCDE") for j, y in enumerate("ABCDE") if x != y]
    cells, _ = cells_of(spark, rows, "ABCDE")
    k = prior.choose_k(cells, RankingConfig(boot_n=10))
    assert k["k_used"] > 0 and k == prior.choose_k(cells, RankingConfig(boot_n=10))
    with pytest.raises(RuntimeError):
        prior.choose_k(cells_of(spark, [("A", "B", 0, 0, 1)], "AB")[0], RankingConfig())


def test_report_flags_and_names(spark):
    gaps = spark.createDataFrame([(8.0,), (4.0,), (-8.0,), (3.99,)], "gap double")
    assert [r[0] for r in gaps.select(report.gap_flag(F.col("gap"))).collect()] == ["RED", "YELLOW", "RED", None]
    names = spark.createDataFrame([("a/b:c*",), ("abc",), ("[]",)], "deck string")
    assert {r.deck: r.sheet for r in report.sheet_names(names).collect()} == {"a/b:c*": "abc", "abc": "abc~2", "[]": "Sheet"}
    sheets = spark.createDataFrame([("zeta",), ("01_Summary",), ("alpha",), ("other",)], "sheet string")
    decks = spark.createDataFrame([("zeta", 1), ("alphabet", 2)], "deck string, ord int")
    assert [r.sheet for r in report.sheet_order(sheets, decks).orderBy("place").collect()] == ["01_Summary", "zeta", "alpha", "other"]


def test_validation_finds_faults(spark):
    cells, axis = cells_of(spark, [("A", "B", 7, 3, 0), ("B", "A", 2, 7, 0)], "AB")
    bad = {r["check"]: r.n_bad for r in validate.validate_matrix(cells).collect()}
    # w(A, B) = 7 = l(B, A), but w(B, A) = 2 and l(A, B) = 3: one cell of the two is wrong.
    assert bad["w_is_l_mirrored"] == 1 and bad["n_symmetric"] == 2 and bad["diagonal"] == 0


def test_urls_and_cache(spark):
    url = lambda x: one(spark, pages.matchup_url(F.col("x"), "https://h.example"), x=x)
    assert url("https://h.example/d/x/?q=1#f") == "https://h.example/d/x/matchups?q=1#f"
    assert url("/d/x") == "https://h.example/d/x/matchups" and url(" ") is None
    assert len(one(spark, pages.cache_key(F.col("x")), x="u")) == 16


PAGE = """<table><tr><th>Other</th></tr><tr><td>1</td></tr></table><table><thead><tr><th>Deck<th>Matches<th>Score<th>Win %</tr></thead><tbody>
<tr><td><a href="/d/one">One</a></td><td>1,234</td><td>6 - 4 - 1</td><td>54,5%</td></tr>
<tr><td>Two</td><td>2</td><td>6–4</td><td></td></tr><tr><td></td><td></td><td>bad</td><td></td></tr></tbody></table>"""


def test_matchup_pages(spark):
    df = spark.createDataFrame([("me", PAGE), ("you", "<p>no table</p>"), ("they", "<table><tr><th>x</th></tr></table>")], "deck string, html string")
    rows = [tuple(r) for r in pages.parse_matchups(df).orderBy("b").collect()]
    assert rows == [("me", "One", 6, 4, 1, 1234, 54.5), ("me", "Two", 6, 4, 0, 10, 60.0), ("me", "Unknown", 0, 0, 0, 0, 0.0)]


def test_decklist_pages(spark):
    html = '<table><tr><th>#</th><th>Deck name</th><th>Share %</th><th>Players</th></tr><tr><td>2</td><td><a href="/d/b">B</a></td><td>10%</td><td>7</td></tr><tr><td>1</td><td>A</td><td>20%</td><td>x</td></tr></table>'
    rows = [tuple(r) for r in pages.parse_decklist(spark.createDataFrame([(html,)], "html string")).collect()]
    assert rows == [(1, "A", "20%", None, None), (2, "B", "10%", 7, f"{pages.BASE_URL}/d/b")]


def test_sinks(spark, tmp_path):
    from datetime import datetime

    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    last = sinks.write_csv_versioned(df, str(tmp_path), "score_x", True, datetime(2024, 1, 2, 3, 4, 5), {"score": "scores", "s": "rest"})
    assert last.endswith("scores/score_x_20240102_030405") and spark.read.csv(last, header=True).count() == 2
    assert sinks.content_hash(df).first() == sinks.content_hash(df.orderBy(F.desc("x"))).first()
    assert sinks.content_hash(df.limit(1).union(df.limit(1))).first() != sinks.content_hash(df.where("x = 2").union(df.where("x = 2"))).first()
    names = sinks.workbook_names(["a" * 40, "a" * 35, "A" * 31 + "b", "x/y", "xy", "*"])
    assert len({n.lower() for n in names}) == 6 and max(map(len, names)) == 31 and names[3:] == ["xy", "xy~2", "Sheet"]
    files = spark.createDataFrame([("o/a_20240102_030405.csv",), ("o/a_latest.csv",), ("archives/a_20240102_030405.csv",)], "path string")
    assert [r.action for r in sinks.retention(files).collect()] == ["delete", "keep", "keep"]


def test_pair_totals_batch_and_stream(spark, tmp_path):
    rows = [("2024-01-01 00:05:00", "A", "B", 1), ("2024-01-01 00:10:00", "A", "B", -1), ("2024-01-01 02:00:00", "A", "A", 1)]
    df = spark.createDataFrame(rows, "ts string, a string, b string, outcome int").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = ingest.pair_totals(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("totals").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("totals").select("a", "b", "w", "l", "t", "n").collect()] == [("A", "B", 1, 1, 0, 2)] == [tuple(r) for r in ingest.pair_totals(df).select("a", "b", "w", "l", "t", "n").collect()]


def test_config_rejects_unknown():
    with pytest.raises(TypeError):
        RankingConfig.of({"nope": 1})


def test_alias_file(spark, tmp_path):
    home = tmp_path / "alias.json"
    home.write_text(json.dumps({"Stra\u00dfe": ["STRASSE", " Str. "], "Other": ["strasse"], "Bare": None}), encoding="utf-8")
    rows = settings.read_aliases(spark, str(home))
    assert {(r.canonical, r.spelling) for r in rows.collect()} == {("Stra\u00dfe", "Stra\u00dfe"), ("Stra\u00dfe", "STRASSE"), ("Stra\u00dfe", " Str. "), ("Other", "Other"), ("Other", "strasse"), ("Bare", "Bare")}
    assert {r.key: r.canonical for r in consolidate.alias_keys(rows).collect()} == {"strasse": "Stra\u00dfe", "str.": "Stra\u00dfe", "other": "Other", "bare": "Bare"}
    home.write_text("[1, 2]", encoding="utf-8")
    assert settings.read_aliases(spark, str(home)).collect() == []
    assert settings.read_aliases(spark, str(tmp_path / "none.json")).collect() == []


def test_settings_file(tmp_path):
    home = tmp_path / "settings.json"
    home.write_text('{"alpha": 0.5, "k_bounds": [1, 9]}')
    cfg = settings.read_settings(str(home))
    assert (cfg.alpha, cfg.k_bounds, cfg.mu) == (0.5, (1, 9), 0.5)
    home.write_text('{"alpha": 0.5, "alhpa": 1}')
    with pytest.raises(TypeError):
        settings.read_settings(str(home))


def test_columns_by_name(spark):
    df = spark.createDataFrame([(3, " X ", "oops", 0.4)], "n int, Archetype string, Usage string, v double")
    assert settings.entity_and_share(df).first()[:] == ("X", 3.0)
    assert settings.declared_column(df) == "Usage"
    with pytest.raises(KeyError):
        settings.entity_and_share(df.select("n"))


def test_latest_by_name():
    assert matchups.latest(["o/flat_latest.csv", "o/flat_b_latest", "o/flat_20240101_000000.csv", "o/wr_latest.csv"], "flat") == "o/flat_latest.csv"
    assert matchups.latest([], "flat") is None


def test_scan_takes_fresh_pages_from_the_cache(spark):
    wanted = spark.createDataFrame([(1, "u"), (2, " u "), (3, "v"), (4, ""), (5, "w"), (6, None)], "seq int, url string")
    cache = spark.createDataFrame([("u", "old", "2024-01-01 00:00:00"), ("u", "new", "2024-01-02 00:00:00"), ("v", "late", "2024-01-01 00:00:00")], "url string, html string, at string")
    cache = cache.select(pages.cache_key(F.col("url")).alias("cache_key"), "html", F.col("at").cast("timestamp").alias("fetched_at"))
    fetched = spark.createDataFrame([("v", "fetched"), ("u", "not asked for")], "url string, html string")
    got = pages.scan(wanted, "seq", cache, fetched, F.lit("2024-01-02 06:00:00").cast("timestamp"), 720)
    assert {(r.seq, r.html, r.from_cache) for r in got.collect()} == {(1, "new", True), (3, "fetched", False), (5, None, False)}
    assert pages.scan_counts(got).first()[:] == (3, 1)


def test_coverage_recomputation_and_weight_checks(spark):
    cells = spark.createDataFrame([("A", "A", None, None, None, None, None), ("A", "B", 3, 1, 0, 4, 75.0), ("B", "A", 1, 3, 0, 4, 30.0), ("B", "B", None, None, None, None, None)], "a string, b string, w long, l long, t long, n_dir long, wr double")
    score = spark.createDataFrame([("A", "B", 3, 1), ("B", "A", 1, 3), ("B", "C", 1, 1)], "a string, b string, w long, l long")
    found = lambda df: {r.check: r.n_bad for r in df.collect()}
    assert found(validate.validate_coverage(score, cells, 0.1)) == {"rows_are_cells": 1, "overfill": 1, "missing_rate": 0}
    assert found(validate.validate_recomputed(cells, score)) == {"wr_recomputed": 1, "n_recomputed": 0}
    soft = spark.createDataFrame([(2.0, 1.5, 0.5), (2.0, 2.5, -0.5), (2.0, 1.0, 0.5)], "n_eff double, w_ij double, w_ji double")
    assert found(validate.validate_bt_weights(soft)) == {"sum_is_n_eff": 1, "in_range": 1}
    assert validate.verdict([validate.validate_bt_weights(soft)]).first().passed is False


def test_report_workbook(spark, tmp_path):
    names = ["A", "B/x", "Bx"]
    records = [(a, b, 10 + i, 10 + j, 0) for i, a in enumerate(names) for j, b in enumerate(names) if a < b]
    raw = spark.createDataFrame(records, "a string, b string, w long, l long, t long")
    axis = spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "deck string, ord int")
    ranked = plan.rank_entities(consolidate.symmetrize(consolidate.max_n(raw)), axis, None, RankingConfig(fixed_k=6.0))
    stamped, latest = book.write_report(ranked, str(tmp_path / "out"), "report", datetime(2024, 1, 15))
    assert stamped.endswith("report_20240115_000000.xlsx") and latest.endswith("report_latest.xlsx")
    with zipfile.ZipFile(latest) as z:
        text = z.read("xl/workbook.xml").decode()
        order = [s.split('"')[0] for s in text.split('<sheet name="')[1:]]
        last = z.read("xl/worksheets/sheet3.xml").decode()
    best = [r.deck for r in ranked.ranking.orderBy("rank").collect()]
    assert order[:2] == ["00_Legenda", "01_Summary"] and len(set(order)) == 5
    assert [o.split("~")[0] for o in order[2:]] == [n.replace("/", "") for n in best]
    assert last.count("<row>") == 4 and "Mirror" in last and "contrib" not in last and " s=" in last
    legend = {(r.row, r.col): (r.text, r.style) for r in workbook.read(spark, latest).where("place = 0").collect()}
    assert ("red", "red") in legend.values() and ("3", "") in legend.values()
    shown = book.write_report(ranked, str(tmp_path / "more"), "report", datetime(2024, 1, 15), sort_by="gap", mirror_label="itself", contrib=True)[0]
    cells = workbook.read(spark, shown).where("place > 1")
    assert cells.where("text = 'itself' and style = 'mirror'").count() == 3 and cells.where("style = 'green'").count() == 6
    gaps = [r.number for r in cells.where("place = 2 and row > 0").orderBy("row", "col").collect() if r.col == 7]
    assert gaps == sorted(gaps, reverse=True) and len(gaps) == 2
    with pytest.raises(ValueError):
        plan.rank_entities(raw, axis.where("ord > 9"), None, RankingConfig(fixed_k=6.0))
