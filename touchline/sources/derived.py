"""Season tables derived from the order tables, so that every operator runs on data that grows.

Orders play the matches, suppliers the players, line items their stats, values and transfers. Edge
cases are built in: NULL and unparsable numbers, blank ids and positions, padded upper-case names,
NULL and zero fees, several rows on one date, and changed, vanished and NULL values in a second batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import season_code, season_of_date, start_year_of
from touchline.sources.tables import scan_table

# Players per club in the league-wide stats.
SQUAD_SIZE = 25


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, sf_dir, name)


def _text(c: Column) -> Column:
    return c.cast("string")


def _count_where(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _opponent(custkey: Column) -> Column:
    return F.concat(F.lit("CLUB_"), _text(custkey % 19))


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, c = given_table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    home, foreign = k % 2 == 0, k % 10 == 9
    return o.select(
        _text(k).alias("game_id"),
        season_of_date(F.col("o_orderdate")).alias("season"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(k % 11 == 0, "final").otherwise(_text(k % 38 + 1)).alias("gameweek"),
        F.when(foreign, "CLUB_X").when(home, "FOCUS").otherwise(_opponent(c)).alias("home_team"),
        F.when(foreign, "CLUB_Y").when(home, _opponent(c)).otherwise("FOCUS").alias("away_team"),
        F.when(k % 13 == 0, None).when(k % 17 == 0, "n/a").otherwise(_text((k * 7 + c) % 5)).alias("home_goals"),
        F.when(k % 13 == 0, None).when(k % 29 == 0, None).otherwise(_text((k * 3 + c) % 4)).alias("away_goals"),
        F.when(home, "Home").otherwise("Away").alias("venue"),
    )


def _player_seasons(spark: SparkSession, sf_dir: str, extra: list[str], *aggs: Column) -> DataFrame:
    """Aggregates per season and supplier; grouped by the start year, so the code is made once per group."""
    lines = given_table(spark, sf_dir, "lineitem").withColumn("_year", start_year_of(F.col("l_shipdate")))
    totals = lines.groupBy("_year", "l_suppkey", *extra).agg(*aggs)
    return totals.withColumn("season", season_code(F.col("_year"))).drop("_year")


def raw_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats as text. ``team`` keeps most players in the focal team, ``club`` makes squads of fixed size."""
    s = F.col("l_suppkey")
    totals = _player_seasons(
        spark, sf_dir, [],
        F.count("*").alias("n"),
        _count_where(F.col("l_returnflag") == "R").alias("goals"),
        _count_where(F.col("l_returnflag") == "A").alias("assists"),
        _count_where(F.col("l_linenumber") <= 4).alias("shots"),
        _count_where(F.col("l_linenumber") <= 2).alias("shots_on_tgt"),
        _count_where(F.col("l_linestatus") == "F").alias("tackles"),
        _count_where(F.col("l_discount") >= 0.06).alias("interceptions"),
        _count_where(F.col("l_tax") >= 0.05).alias("fouls"),
        _count_where(F.col("l_tax") <= 0.02).alias("fouled"),
        _count_where(F.col("l_quantity") <= 4).alias("offsides"),
        _count_where(F.col("l_quantity") >= 46).alias("yellow_cards"),
        _count_where(F.col("l_quantity") == 50).alias("red_cards"),
    )
    plain = ["shots", "shots_on_tgt", "tackles", "interceptions", "fouls", "fouled", "offsides", "yellow_cards"]
    return totals.select(
        "season",
        F.concat(F.lit("Player "), _text(s)).alias("player"),
        F.when(s % 7 == 6, "CLUB_X").otherwise("FOCUS").alias("team"),
        F.concat(F.lit("SQUAD_"), _text(F.floor(s / SQUAD_SIZE))).alias("club"),
        F.when(s % 11 == 10, "partial").otherwise("combined").alias("stat_type"),
        # Every ninth season of a player passes without a minute played.
        F.when(s % 13 == 0, "nan?")
        .when((s + F.left("season", F.lit(2)).cast("int")) % 9 == 0, "0")
        .otherwise(_text(F.col("n") * 15)).alias("minutes"),
        _text(F.col("goals")).alias("goals"),
        F.when(s % 5 == 0, None).otherwise(_text(F.col("assists"))).alias("assists"),
        F.concat(_text(F.col("goals")), F.lit(".25")).alias("xg"),
        F.concat(_text(F.col("assists")), F.lit(".5")).alias("xag"),
        *[_text(F.col(c)).alias(c) for c in plain],
        F.when(s % 17 == 3, None).otherwise(_text(F.col("red_cards"))).alias("red_cards"),
    )


def squad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("l_suppkey")
    totals = _player_seasons(
        spark, sf_dir, [],
        F.sum(F.floor("l_extendedprice")).alias("value"), F.max("l_shipdate").alias("scraped_at")
    )
    nation = F.concat(F.lit("NATION_"), _text(s % 25))
    return totals.select(
        "season",
        F.when(s % 3 == 0, F.concat(F.lit(" PLAYER "), _text(s), F.lit(" ")))
        .otherwise(F.concat(F.lit("Player "), _text(s))).alias("player"),
        F.when(s % 4 == 0, "").otherwise(_text(s)).alias("player_id"),
        F.concat(F.lit("player-"), _text(s)).alias("player_slug"),
        F.when(s % 6 == 0, "").when(s % 6 < 3, "Centre-Back").otherwise("Left Winger").alias("position"),
        F.when(s % 9 == 0, None).otherwise(nation).alias("nationality"),
        F.when(s % 18 == 0, None).otherwise(F.concat(F.lit("FULL_"), nation)).alias("nationality_full"),
        (F.lit(18) + s % 20).cast("bigint").alias("age"),
        F.when(s % 8 == 7, None).otherwise(F.col("value")).alias("market_value_eur"),
        F.when(s % 5 == 0, "").when(s % 5 == 1, "//cdn.example.com/default.jpg")
        .otherwise(F.concat(F.lit("/img/"), _text(s), F.lit(".png"))).alias("photo_url"),
        F.concat(F.lit("02/10/1992 ("), _text(F.lit(18) + s % 20), F.lit(")")).alias("dob"),
        F.when(s % 2 == 0, "1,80 m").otherwise("").alias("height"),
        F.lit("").alias("foot"),
        F.lit("").alias("contract_expires"),
        "scraped_at",
    )


def squad_values_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next load of the squad table: values changed, lost or gone."""
    age, value = F.col("age"), F.col("market_value_eur")
    return squad_values(spark, sf_dir).where(age % 20 != 17).withColumn(
        "market_value_eur",
        F.when(age % 10 == 3, None)
        .when(age % 5 == 0, F.coalesce(value, F.lit(0)) + 1000)
        .otherwise(value),
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a transfer: A arrivals, R departures, N either by line number."""
    lines = given_table(spark, sf_dir, "lineitem")
    arrival = (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 1))
    kind = F.col("l_linenumber") % 5
    other = F.concat(F.lit("CLUB_"), _text(F.col("l_partkey") % 40))
    fee = F.floor("l_extendedprice")
    return lines.select(
        season_of_date(F.col("l_shipdate")).alias("season"),
        F.concat(F.lit("Player "), _text(F.col("l_suppkey"))).alias("player"),
        F.when(arrival, "in").otherwise("out").alias("direction"),
        F.when(arrival, other).otherwise("FOCUS").alias("from_club"),
        F.when(arrival, "FOCUS").otherwise(other).alias("to_club"),
        F.when(kind == 0, None).when(kind == 1, 0).otherwise(fee).cast("bigint").alias("fee_eur"),
        F.when(kind == 0, "?").when(kind == 1, "free transfer")
        .otherwise(F.concat(F.lit("€"), _text(fee))).alias("fee_text"),
        F.when(kind < 2, "Centre-Back").otherwise("Left Winger").alias("position"),
        (F.lit(17) + F.col("l_quantity").cast("bigint") % 18).alias("age_at_transfer"),
        "l_orderkey",
        "l_linenumber",
    )


def season_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_matches(spark, sf_dir).groupBy("season").agg(
        F.count("*").alias("matches_count"),
        F.lit(25).cast("bigint").alias("players_count"),
        (F.first("season") < "9798").alias("is_complete"),
        F.max("date").alias("scraped_on"),
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fixture pages, all text."""
    o, k, c = given_table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    cup = k % 9 == 0
    return o.select(
        season_of_date(F.col("o_orderdate")).alias("season"),
        F.when(cup, "FA Cup").otherwise("Premier League").alias("comp"),
        F.when(k % 23 == 0, "").otherwise(_text(F.col("o_orderdate").cast("date"))).alias("date"),
        F.when(k % 2 == 0, "Home").when(k % 31 == 1, "Neutral").otherwise("Away").alias("venue"),
        F.when(k % 13 == 0, None).otherwise(_text((k * 7 + c) % 5)).alias("gf"),
        F.when(k % 13 == 0, None).otherwise(_text((k * 3 + c) % 4)).alias("ga"),
        _opponent(c).alias("opponent"),
        F.when(cup, "Final").when(k % 14 == 0, "Matchweek ?")
        .otherwise(F.concat(F.lit("Matchweek "), _text(k % 38 + 1))).alias("round"),
        F.when(k % 5 == 0, None).otherwise(F.concat(F.lit("report-"), F.lpad(_text(k), 12, "0"))).alias("match_report"),
    )


def value_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = given_table(spark, sf_dir, "part"), F.col("p_partkey")
    kind = k % 7
    return p.select(
        k,
        F.when(kind == 0, "-").when(kind == 1, "free transfer").when(kind == 2, "?")
        .when(kind == 3, F.concat(F.lit("€"), _text(k % 900), F.lit("k")))
        .when(kind == 4, F.concat(F.lit("€"), _text(k % 90), F.lit("."), F.lpad(_text(k % 100), 2, "0"), F.lit("m")))
        .when(kind == 5, F.concat(F.lit("Loan fee: €"), _text(k % 9), F.lit(",5m")))
        .otherwise(_text(k * 1000)).alias("fee_text"),
    )


def stat_pages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three per-season stat tables as read from pages; shooting has two rows per player."""
    s, n = F.col("l_suppkey"), F.col("n")
    name = F.concat(F.lit("Player "), _text(s))
    standard = _player_seasons(
        spark, sf_dir, [],
        F.count("*").alias("n"),
        _count_where(F.col("l_returnflag") == "R").alias("goals"),
        _count_where(F.col("l_quantity") == 50).alias("red"),
    ).select(
        "season", s.alias("row_no"),
        F.when(s % 19 == 0, "Player").when(s % 19 == 1, "nan").otherwise(name).alias("Player"),
        F.concat(F.lit("1,"), F.lpad(_text(n % 1000), 3, "0")).alias("Playing Time_Min"),
        _text(F.col("goals")).alias("Performance_Gls"),
        F.when(s % 5 == 0, "").otherwise(_text(n)).alias("Performance_Ast"),
        _text(n % 7).alias("Performance_CrdY"),
        _text(F.col("red")).alias("Performance_CrdR"),
    )
    shooting = _player_seasons(spark, sf_dir, ["l_linestatus"], F.count("*").alias("n")).select(
        "season",
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("row_no"),
        name.alias("Player"),
        _text(n).alias("Standard_Sh"),
        F.when(s % 4 == 0, None).otherwise(_text(F.floor(n / 2))).alias("Standard_SoT"),
    )
    misc = _player_seasons(spark, sf_dir, [], F.count("*").alias("n")).where(s % 3 != 1).select(
        "season", F.lit(0).alias("row_no"), name.alias("Player"),
        _text(n % 11).alias("Performance_TklW"), _text(n % 13).alias("Performance_Int"),
        _text(n % 3).alias("Performance_Fls"), _text(n % 5).alias("Performance_Fld"),
        F.lit("x").alias("Performance_Off"),
    )
    return {"standard": standard, "shooting": shooting, "misc": misc}


def player_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached profiles, one per supplier, with the value points as JSON text."""
    sup, s = given_table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    bal = F.floor("s_acctbal")

    def point(x: int, y: Column) -> Column:
        return F.concat(F.lit('{"x":%d,"y":' % x), _text(y), F.lit(',"mw":"v%d"}' % x))

    points = F.concat(F.lit("["), point(1, bal), F.lit(","), point(2, bal + 5), F.lit("]"))
    return sup.select(
        _text(s).alias("player_id"),
        F.concat(F.lit("player-"), _text(s)).alias("player_slug"),
        F.concat(F.lit("Player "), _text(s)).alias("player_name"),
        F.when(s % 3 == 0, "").when(s % 3 == 1, F.concat(F.lit("//cdn.example.com/"), _text(s), F.lit(".jpg")))
        .otherwise("https://cdn.example.com/no_picture.png").alias("photo_url"),
        F.when(s % 2 == 0, "01/01/1990").otherwise("").alias("dob"),
        F.when(s % 3 == 0, "1,90 m").otherwise("").alias("height"),
        F.when(s % 2 == 1, "left").otherwise("").alias("foot"),
        F.lit("").alias("nationality"),
        F.lit("").alias("position"),
        F.when(s % 5 == 0, "").otherwise("30/06/2027").alias("contract_expires"),
        F.when(s % 4 == 0, None).otherwise(F.concat(F.lit("Agency "), _text(s % 10))).alias("agent"),
        F.when(s % 7 == 0, "not json").when(s % 7 == 1, "").otherwise(points).alias("mv_history_json"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log events: a start per user and day, and a finish for days with a purchase or an error."""
    e = given_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.concat_ws("-", "user_id", F.col("ts").cast("date").cast("string")).alias("run_id"),
        F.concat(F.lit("pipeline_"), _text(F.col("user_id") % 5)).alias("pipeline"),
        season_of_date(F.col("ts")).alias("season"),
        "event_id",
        F.col("ts").alias("at"),
        F.when(kind == "signup", "start").when(kind.isin("purchase", "error"), "finish").otherwise("other").alias("event"),
        F.when(kind == "purchase", "success").when(kind == "error", "failed").alias("status"),
        F.when(kind == "error", F.concat(F.lit("error "), F.col("props"))).alias("error_msg"),
        F.when(kind == "purchase", F.floor("value")).alias("rows_written"),
    )


def _page(df: DataFrame, keys: list[str], order: str, row: Column, before: str, after: str) -> DataFrame:
    """A page per key, of the row texts in order. Keys are chosen so that a page has few rows."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), row.alias("html"))))
    body = F.array_join(F.transform(rows, lambda r: r["html"]), "")
    return df.groupBy(*keys).agg(F.concat(F.lit(before), body, F.lit(after)).alias("html"))


def _cells(*texts: Column, tag: str = "td") -> Column:
    return F.concat(*[x for t in texts for x in (F.lit(f"<{tag}>"), t, F.lit(f"</{tag}>"))])


def _squad_no(c: Column) -> Column:
    return F.floor(c / SQUAD_SIZE).cast("bigint")


def standard_stat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat pages per season and squad, every other one with its table inside a comment."""
    totals = _player_seasons(
        spark, sf_dir, [],
        F.count("*").alias("n"), _count_where(F.col("l_returnflag") == "R").alias("goals")
    ).withColumn("squad_no", _squad_no(F.col("l_suppkey")))
    name = F.concat(F.lit("Player "), _text(F.col("l_suppkey")))
    row = F.concat(F.lit("<tr>"), _cells(name, tag="th"), _cells(_text(F.col("n")), _text(F.col("goals"))), F.lit("</tr>"))
    repeated = F.when(F.col("l_suppkey") % 10 == 0, "<tr><th>Player</th><th>Min</th><th>Gls</th></tr>").otherwise("")
    table = (
        '<table id="stats_standard"><thead><tr><th></th><th colspan="1">Playing Time</th><th>Performance</th></tr>'
        "<tr><th>Player</th><th>Min</th><th>Gls</th></tr></thead><tbody>"
    )
    pages = _page(totals, ["season", "squad_no"], "l_suppkey", F.concat(repeated, row), table, "</tbody></table>")
    hidden = F.concat(F.lit("<html><body><!-- "), F.col("html"), F.lit(" --></body></html>"))
    shown = F.concat(F.lit("<html><body><p>x</p>"), F.col("html"), F.lit("</body></html>"))
    return pages.withColumn("html", F.when(F.col("squad_no") % 2 == 0, hidden).otherwise(shown))


def squad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squad pages per season and squad, rows of nine cells with photo, flag and profile link."""
    s = F.col("l_suppkey")
    totals = _player_seasons(spark, sf_dir, [], F.sum(F.floor("l_extendedprice")).alias("value")).withColumn(
        "squad_no", _squad_no(s)
    )
    photo = F.concat(F.lit('<img data-src="/img/'), _text(s), F.lit('.png" src="x.gif">'))
    link = F.concat(
        F.lit('<a href="/player-'), _text(s), F.lit("/profil/spieler/"), _text(s), F.lit('">Player '), _text(s),
        F.lit(" &amp; Co</a>"),
    )
    flag = F.concat(F.lit('<img class="flaggenrahmen" title="NATION_'), _text(s % 25), F.lit('">'))
    money = F.when(s % 8 == 7, "-").when(s % 8 == 6, F.concat(F.lit("€"), _text(F.col("value") % 1000), F.lit("k"))).otherwise(
        F.concat(F.lit("€"), _text(F.col("value") % 500), F.lit(".50m"))
    )
    blank = F.lit("")
    cells = _cells(
        _text(s), photo, blank, link, F.lit("Centre-Back"),
        F.concat(F.lit("02/10/1992 ("), _text(F.lit(18) + s % 20), F.lit(")")), flag, F.lit("2027"), money,
    )
    row = F.concat(F.lit('<tr class="odd">'), cells, F.lit("</tr>"))
    short = F.when(s % 10 == 0, '<tr class="even"><td>too short</td></tr><tr><td>no class</td></tr>').otherwise("")
    return _page(
        totals, ["season", "squad_no"], "l_suppkey", F.concat(row, short),
        '<html><body><table class="items"><tbody>', "</tbody></table></body></html>",
    )


def transfer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer pages per season and order, with a box of arrivals, one of departures and another one."""
    t = transfers(spark, sf_dir)
    other = F.when(F.col("direction") == "in", F.col("from_club")).otherwise(F.col("to_club"))
    dot = F.lit(".")
    cells = _cells(
        dot, dot, dot, F.col("player"), F.col("position"),
        F.when(F.col("l_linenumber") == 3, "?").otherwise(_text(F.col("age_at_transfer"))),
        dot, dot, dot, other, dot, F.col("fee_text"),
    )
    title = F.when(F.col("direction") == "in", "Arrivals").otherwise("Departures")
    box = F.concat(
        F.lit('<div class="box"><h2>'), title, F.lit('</h2><table><tr class="even">'), cells, F.lit("</tr></table></div>")
    )
    return _page(
        t, ["season", "l_orderkey"], "l_linenumber", box,
        '<html><body><div class="box"><h2>News</h2></div>', "</body></html>",
    )


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = player_profiles(spark, sf_dir)

    def entry(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"<tr><td>{label}:</td><td><b>"), value, F.lit("</b></td></tr>"))

    html = F.concat(
        F.lit('<html><body><img class="data-header__profile-image" data-srcset="'),
        F.concat(F.lit("//cdn.example.com/"), F.col("player_id"), F.lit(".jpg 1x, //cdn.example.com/big.jpg 2x")),
        F.lit('"><table class="auflistung">'),
        entry("Date of birth/Age", F.col("dob")),
        entry("Größe", F.col("height")),
        entry("Foot", F.col("foot")),
        entry("Contract expires", F.col("contract_expires")),
        entry("Player agent", F.coalesce("agent", F.lit("none"))),
        F.lit("</table><script>var x = 1;</script><script>var marketValueDevelopment = "),
        F.when(F.col("mv_history_json") == "not json", "[broken").otherwise(F.col("mv_history_json")),
        F.lit(" ;</script></body></html>"),
    )
    return p.select("player_id", html.alias("html"))
