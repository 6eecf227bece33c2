import datetime as dt
import pathlib
import random
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import values
from touchline.operators import checks, graph, history, networks
from touchline.plans import pipeline
from touchline.sources import derived, loads, pages, schemas, tables
from touchline.sources.markup import parse
from touchline.streaming.incremental import arriving, upsert_stream

SCHEMA = "season string, player string, v bigint, note string"


def test_merge_upsert(rows):
    target = rows([("a", "x", 1, "old"), ("a", "x", 2, "old"), ("b", "y", 3, "old"), (None, "z", 4, "old")], SCHEMA)
    source = rows([("a", "x", 9, "new"), ("c", "w", 8, "new"), (None, "z", 7, "new")], SCHEMA)
    merged = loads.merge_upsert(target, source, ["season", "player"], ["v"])
    assert values(merged) == sorted(
        [("a", "x", 9, "old"), ("a", "x", 9, "old"), ("b", "y", 3, "old"), (None, "z", 4, "old"),
         ("c", "w", 8, "new"), (None, "z", 7, "new")], key=repr)
    once = loads.merge_upsert(target.where("season = 'b'"), source.where("season is not null"), ["season", "player"])
    twice = loads.merge_upsert(once, source.where("season is not null"), ["season", "player"])
    assert values(once) == values(twice)


def test_merge_needs_unique_keys(rows):
    target = rows([("a", "x", 1, "old")], SCHEMA)
    source = rows([("a", "x", 5, "p"), ("a", "x", 6, "q")], SCHEMA)
    with pytest.raises(PySparkException, match="more than one source row"):
        loads.merge_upsert(target, source, ["season", "player"]).collect()
    picked = loads.merge_upsert(target, source, ["season", "player"], order_by=[F.col("v").desc()])
    assert values(picked) == [("a", "x", 6, "q")]


def test_replace_partitions(rows):
    target = rows([("a", "x", 1, ""), ("b", "y", 2, "")], SCHEMA)
    batch = rows([("b", "z", 3, "")], SCHEMA)
    assert values(loads.replace_partitions(target, batch), "season", "v") == [("a", 1), ("b", 3)]
    assert values(loads.replace_partitions(target, batch.where("v = 0")), "season", "v") == [("a", 1), ("b", 2)]


def test_pending_and_ledger(rows):
    ledger = rows([("a", True), ("b", False), ("c", True)], "season string, is_complete boolean")
    asked = rows([("a",), ("b",), ("c",), ("d",)], "season string")
    assert values(loads.pending_partitions(asked, ledger, "c")) == [("b",), ("c",), ("d",)]
    assert loads.pending_partitions(asked, ledger, "c", force=True).count() == 4


def test_align_and_coerce(rows):
    df = rows([("1.5", "x", "2024-01-02", "bad")], "a string, b string, d string, e string")
    got = loads.coerce_numeric(df, ["a", "b"], ["d", "e"]).first()
    assert (got["a"], got["b"], got["d"], got["e"]) == (1.5, None, dt.date(2024, 1, 2), None)
    aligned = loads.align_schema(df.select(F.col("a").alias("SEASON")), schemas.SEASON_LEDGER)
    assert aligned.columns == ["SEASON", "scraped_at", "matches_count", "players_count", "is_complete"]


def test_upsert_path_touches_only_its_partitions(rows, spark, tmp_path):
    path = str(tmp_path / "t")
    cols = "player string, v bigint, season string"
    loads.upsert_path(spark, path, rows([("x", 1, "0102"), ("y", 2, "0203")], cols), ["season", "player"])
    untouched = {f.name for f in (tmp_path / "t" / "season=0102").iterdir()}
    loads.upsert_path(spark, path, rows([("y", 5, "0203"), ("z", 6, "0203"), ("n", 7, "0304")], cols), ["season", "player"])
    got = spark.read.schema(cols).parquet(path)
    assert values(got, "season", "player", "v") == [("0102", "x", 1), ("0203", "y", 5), ("0203", "z", 6), ("0304", "n", 7)]
    assert {f.name for f in (tmp_path / "t" / "season=0102").iterdir()} == untouched
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_stream(rows, spark, tmp_path):
    inbox, path, marks = (str(tmp_path / n) for n in ("inbox", "table", "marks"))
    cols = "player string, v bigint, season string"

    def run():
        stream = arriving(spark, inbox, rows([], cols).schema)
        upsert_stream(stream, path, marks, ["season", "player"], order_by=[F.col("v").desc()]).awaitTermination()
        return values(spark.read.schema(cols).parquet(path), "season", "player", "v")

    rows([("x", 1, "0102"), ("x", 3, "0102")], cols).write.parquet(inbox)
    assert run() == [("0102", "x", 3)]
    rows([("x", 2, "0102"), ("y", 4, "0203")], cols).write.mode("append").parquet(inbox)
    assert run() == [("0102", "x", 2), ("0203", "y", 4)]
    assert run() == [("0102", "x", 2), ("0203", "y", 4)]


def test_write_mart_layout(rows, spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("season"), F.col("id").alias("v"))
    tables.write_mart(df, path, ["season"], ["v"])
    back = spark.read.schema("v bigint, season string").parquet(path)
    assert back.count() == 1000
    plan = back.where("season = '1'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert tables.scan_table(spark, "/root/testdata/sf0.001", "orders", limit=7).count() == 7


def test_run_log(rows):
    at = dt.datetime(2024, 1, 1)
    events = rows(
        [("r1", "p" * 80, None, 1, at, "start", None, None, None), ("r2", "p", "2425", 2, at, "start", None, None, None),
         ("r2", "p", "2425", 3, at + dt.timedelta(hours=1), "finish", "failed", "e" * 9000, None),
         ("r2", "p", "2425", 4, at + dt.timedelta(hours=2), "finish", "success", None, 5)],
        "run_id string, pipeline string, season string, event_id bigint, at timestamp, event string, status string, "
        "error_msg string, rows_written bigint")
    whole = {r["run_id"]: r for r in loads.run_log(events).collect()}
    assert len(whole["r1"]["pipeline"]) == 80
    got = {r["run_id"]: r for r in loads.run_log(events, {"pipeline": 64}).collect()}
    assert got["r1"]["status"] == "running" and got["r1"]["finished_at"] is None and len(got["r1"]["pipeline"]) == 64
    assert got["r1"]["season"] == ""
    assert (got["r2"]["status"], got["r2"]["error_msg"], got["r2"]["rows_written"]) == ("success", "", 5)


def squad(rows, data):
    return rows(
        [(s, f"P{i}", i, v, dt.datetime(2024, 1, 1)) for s, i, v in data],
        "season string, player string, player_id string, market_value_eur bigint, scraped_at timestamp")


def test_value_history(rows):
    day = [F.lit(dt.date(2024, 1, d)) for d in (1, 8, 15)]
    first = squad(rows, [("s", "1", 10), ("s", "2", None), ("s", "3", 30), ("s", "", 5)])
    second = squad(rows, [("s", "1", 11), ("s", "2", 20), ("s", "3", 30), ("s", "4", 40)])
    third = squad(rows, [("s", "1", None), ("s", "2", 21)])
    h = history.value_history_scd2(None, first.limit(0), first, day[0])
    h = history.value_history_scd2(h, first, second, day[1])
    h = history.value_history_scd2(h, second, third, day[2])
    got = [(r["player_id"], r["market_value_eur"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["is_current"]) for r in h.collect()]
    assert sorted(got, key=repr) == sorted(
        [("1", 10, 1, 8, False), ("1", 11, 8, None, True), ("2", 20, 8, 15, False), ("2", 21, 15, None, True),
         ("3", 30, 1, None, True), ("4", 40, 8, None, True)], key=repr)


def test_snapshot(rows):
    def table(data):
        return rows(data, "sk string, position string, n int")

    at = [F.lit(dt.datetime(2024, 1, d)).cast("timestamp") for d in (1, 2, 3)]
    cols = ["position", "n"]
    h = history.snapshot_check(None, table([("a", "x", 1), ("b", None, 2)]), check_cols=cols, as_of=at[0])
    h = history.snapshot_check(h, table([("a", "x", 2), ("b", None, 2), ("c", "z", 3)]), check_cols=cols, as_of=at[1])
    h = history.snapshot_check(h, table([("a", "x", 2), ("b", "y", 2)]), check_cols=cols, as_of=at[2])
    got = [(r["sk"], r["position"], r["n"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in h.collect()]
    assert sorted(got, key=repr) == sorted(
        [("a", "x", 1, 1, 2), ("a", "x", 2, 2, None), ("b", None, 2, 1, 3), ("b", "y", 2, 3, None), ("c", "z", 3, 2, None)], key=repr)
    assert h.select("scd_id").distinct().count() == 5


SNAPSHOT_LOADS = [[("a", "x", 1), ("b", None, 2)], [("a", "x", 2), ("b", None, 2), ("c", "z", 3)], [("a", "x", 2), ("b", "y", 2)], []]


def test_written_versions_read_and_write_open_rows_only(rows, spark, tmp_path):
    cols = ["position", "n"]
    whole, files, path = None, {}, tmp_path / "v"

    def step(old, day, data):
        source = rows(data, "sk string, position string, n int")
        return history.snapshot_check(old, source, check_cols=cols, as_of=F.lit(dt.datetime(2024, 1, day)).cast("timestamp"))

    kept = history.Versions(spark, str(path), step(None, 1, []).schema, ["sk"])
    assert kept.read().count() == 0 and kept.current().count() == 0
    for day, data in enumerate(SNAPSHOT_LOADS, 1):
        whole = step(whole, day, data)
        before = kept.load(lambda old: step(old, day, data))  # noqa: B023
        assert values(kept.read(), *whole.columns) == values(whole, *whole.columns)
        assert values(kept.current(), "sk", "n") == values(whole.where("valid_to is null"), "sk", "n")
        if before is not None:
            assert before.inputFiles() and all("state=open" in f and f"load={day - 2}" in f for f in before.inputFiles())
        closed = {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet") if "state=closed" in str(p)}
        assert files.items() <= closed.items()
        files = closed
    at = F.lit(dt.datetime(2024, 1, 2, 12)).cast("timestamp")
    then = kept.as_of(at)
    assert values(then, "sk", "n") == [("a", 2), ("b", 2), ("c", 3)]
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = then._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "closed_on" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert len(list(path.glob("load=*/state=open"))) == 2


def test_a_load_of_versions_that_breaks_off_leaves_them(rows, spark, tmp_path):
    def step(old, day, data):
        source = rows(data, "sk string, n int")
        return history.snapshot_check(old, source, check_cols=["n"], as_of=F.lit(dt.datetime(2024, 1, day)).cast("timestamp"))

    kept = history.Versions(spark, str(tmp_path / "v"), step(None, 1, []).schema)
    kept.load(lambda old: step(old, 1, [("a", 1)]))
    kept.load(lambda old: step(old, 2, [("a", 2)]))
    (tmp_path / "v" / "load=1" / "_SUCCESS").unlink()  # the second write never ended
    assert values(kept.read(), "sk", "n") == [("a", 1)]
    kept.load(lambda old: step(old, 3, [("a", 3)]))
    assert [(r.n, r.valid_from.day, r.valid_to and r.valid_to.day) for r in kept.read().orderBy("n").collect()] == [(1, 1, 3), (3, 3, None)]
    with pytest.raises(ValueError, match="state"):
        history.Versions(spark, "p", rows([], "state string").schema)


def test_written_value_history(rows, spark, tmp_path):
    loads_of = [[("s", "1", 10), ("s", "2", None), ("s", "3", 30)], [("s", "1", 11), ("s", "2", 20), ("s", "4", 40)], [("s", "1", None), ("s", "2", 21)]]
    squads = [squad(rows, []), *[squad(rows, d) for d in loads_of]]
    kept, whole = None, None
    for day, (old, new) in enumerate(zip(squads, squads[1:]), 1):
        today = F.lit(dt.date(2024, 1, day))
        whole = history.value_history_scd2(whole, old, new, today)
        kept = kept or history.Versions(spark, str(tmp_path / "h"), whole.schema)
        kept.load(lambda h: history.value_history_scd2(h, old, new, today))  # noqa: B023
    assert values(kept.read(), *whole.columns) == values(whole, *whole.columns)


def test_pipeline_writes_and_reads_back(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    raw = {"raw_matches": derived.raw_matches, "raw_player_stats": derived.raw_player_stats,
           "squad_values": derived.squad_values, "transfers": derived.transfers}
    inputs = {n: f(spark, sf) for n, f in raw.items()}
    lazy, written = pipeline.build(inputs), pipeline.write_all(spark, inputs, str(tmp_path))
    for name in ("season_summary", "graph_players", "edge_played_with", "player_values"):
        assert values(lazy[name].select(*sorted(lazy[name].columns))) == values(written[name].select(*sorted(lazy[name].columns)))


def test_markup():
    root, comments = parse("<p class='a b'>x &lt; y<br>z</p><!-- <i>c</i> --><script>if (a < b) '<td>'</script><td>1<td>2")
    assert comments == [" <i>c</i> "]
    assert root.first("p", ["b"]).text() == "x < yz"
    assert [td.text() for td in root.all("td")] == ["1", "2"]
    assert parse(None)[0].text() == ""


def test_html_table(rows):
    html = (
        '<table id="t"><tr><th>Player</th><th>N</th></tr><tr><td>shown</td><td>1</td></tr></table>'
        '<!-- <table id="t"><tr><th>Player</th><th>N</th></tr><tr><td> a </td><td>1</td></tr>'
        "<tr><th>Player</th><th>N</th></tr><tr><td></td><td>2</td></tr><tr><td>b</td></tr></table> -->"
    )
    df = rows([(1, html), (2, "<p>no table</p>"), (3, None)], "page_id int, html string")
    got = pages.extract_html_table(df, ["page_id"], "t", header_rows=1).collect()
    assert [(r["page_id"], r["cells"]) for r in got] == [(1, {"Player": "a", "N": "1"}), (1, {"Player": "b"})]


def test_clamp_and_classes(rows):
    assert [networks.clamp_limit(x) for x in ("20", 0, None, "x", 99, -3)] == [20, 15, 15, 15, 50, 1]
    nodes = rows([("a", "a", "Right-Back", "player"), ("b", "b", "", "player"), ("c", "c", "Goalkeeper", "player"), ("d", "d", "back", "club")],
                 "id string, label string, position string, node_type string")
    edges = rows([("a", "c"), ("a", "b")], "source string, target string")
    for kind, ids in (("back", ["a"]), ("goalkeeper", ["c"]), ("all", ["a", "b", "c"]), ("other", ["a", "c"])):
        kept, between = networks.filter_by_position(nodes, edges, kind)
        assert [r[0] for r in values(kept)] == ids
    assert networks.search_subgraph(nodes, edges)[0] is nodes
    assert networks.search_subgraph(nodes, edges, player="zz")[0].count() == 0
    two = rows([("a", "b"), ("b", "c")], "source string, target string")
    assert networks.search_subgraph(nodes, two, player="A")[0].count() == 2
    assert networks.search_subgraph(nodes, two, player="A", hops=2)[0].count() == 3


def test_search_follows_new_nodes_only(rows, spark, tmp_path):
    """Three hops on a graph with a node of 10,000 edges, against a plain breadth-first search."""
    rng = random.Random(8)
    pairs = [("hub", f"leaf{i}") for i in range(10_000)] + [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(330)]
    pairs += [("n1", "hub"), ("leaf7", "n200"), (None, "n3"), ("n5", None), ("n1", "hub")]
    edges = rows(pairs, "source string, target string").repartition(4)
    ids = sorted({x for p in pairs for x in p if x})
    nodes = rows([(i, i, "player") for i in ids], "id string, label string, node_type string")
    near = {}
    for a, b in pairs:
        if a and b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    table = networks.Adjacency.written(edges, str(tmp_path / "a"), buckets=7)
    for start, hops in (("n250", 3), ("leaf9999", 3), ("n1", 1), ("hub", 2), ("n250", 40)):
        seen = {i for i in ids if start in i}
        for _ in range(hops):
            seen |= {y for x in seen for y in near.get(x, ())}
        got_nodes, got_edges = networks.search_subgraph(nodes, edges, player=start, hops=hops, adjacency=table)
        assert {r["id"] for r in got_nodes.collect()} == seen
        assert got_edges.count() == sum(a in seen and b in seen for a, b in pairs)
    assert {r["id"] for r in networks.neighbours(table, "n1").collect()} == near["n1"] | {"n1"}
    assert {r["id"] for r in networks.neighbours(table, "nobody").collect()} == {"nobody"}
    plan = networks.neighbours(table, "n1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(id,n1)" in plan and "Sort " not in plan


def test_teammates_after_an_upsert_equal_a_rebuild(rows, spark, tmp_path):
    """One season is loaded again: with a lost player, changed goals, and one whose squad broke up."""
    rng = random.Random(21)
    cols = "season string, team string, player string, goals double"
    data = [(s, rng.choice(["A", "B"]), f"{'P' if rng.random() < 0.5 else 'p'}{i}", rng.choice([None, 1.0, 2.0])) for s in ("a", "b", "c") for i in range(9)]
    data += [("a", "A", " p1 ", 5.0), (None, "A", "p1", 1.0), (None, "A", "p2", 1.0)]
    after = [r for r in data if r[0] != "b"] + [("b", "A", "p1", 7.0), ("b", "A", "p2", 1.0), ("b", "B", "p3", 1.0)]
    gone = [r for r in after if r[0] != "c"] + [("c", "A", "p1", 1.0)]
    players = rows([(f"id{i}", f"p{i}") for i in range(9)], "player_id string, name string")
    kept = graph.Teammates(spark, str(tmp_path / "pairs"))
    table = str(tmp_path / "performance")
    names = ("player_id_a", "player_id_b", "shared_seasons", "combined_goals", "seasons_list")
    for present, touched in ((data, ["a", "b", "c"]), (after, ["b"]), (gone, ["c"])):
        tables.write_mart(rows(present, cols), table, ["season"])
        stored = spark.read.schema("team string, player string, goals double, season string").parquet(table)
        read = kept.load(stored, touched)
        assert values(kept.edges(players), *names) == values(graph.edge_played_with(rows(present, cols), players), *names)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and len(read.inputFiles()) and "season" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_undirected_pattern(rows):
    people = rows([("1", "a"), ("2", "b"), ("3", "c")], "player_id string, name string")
    edge = rows([("1", "2", 4), ("2", "3", 5)], "s string, d string, w int")
    g = graph.PropertyGraph({"P": graph.Nodes(people, "player_id")}, {"E": graph.Edges(edge, "s", "d", "P", "P")})
    of_b = F.col("a_name") == "b"
    assert values(graph.match_edges(g, "E", directed=False, where=of_b), "b_name", "w") == [("a", 4), ("c", 5)]
    assert values(graph.match_edges(g, "E", where=of_b), "b_name", "w") == [("c", 5)]
    broken = graph.PropertyGraph({"P": graph.Nodes(people.union(people.limit(1)), "player_id")},
                                 {"E": graph.Edges(rows([("1", "9", 1)], "s string, d string, w int"), "s", "d", "P", "P")})
    assert values(graph.graph_problems(broken)) == [("E", 1, 0, 1), ("P", 4, 1, 0)]


def test_first_load_follows_the_rules_of_later_ones(rows, spark, tmp_path):
    cols = "season string, player string, v int"
    twice = rows([("a", "x", 1), ("a", "x", 2), (None, "y", 3)], cols)
    with pytest.raises(Exception, match="more than one source row"):
        loads.upsert_path(spark, str(tmp_path / "t"), twice, ["season", "player"])
    path = str(tmp_path / "u")
    loads.upsert_path(spark, path, twice, ["season", "player"], order_by=[F.col("v").desc()])
    loads.upsert_path(spark, path, rows([("a", "x", 9), (None, "z", 4)], cols), ["season", "player"])
    back = spark.read.schema(cols).parquet(path)
    assert values(back, "season", "player", "v") == [("a", "x", 9), (None, "y", 3), (None, "z", 4)]
    loads.upsert_path(spark, path, rows([], cols), ["season", "player"])
    assert spark.read.schema(cols).parquet(path).count() == 3


@pytest.mark.parametrize("lost", ["nothing", "a partition", "all files"])
def test_an_interrupted_upsert_is_completed(rows, spark, tmp_path, monkeypatch, lost):
    """The job ends between staging and swap, or while partitions are being replaced."""
    cols = "season string, player string, v int"
    path = str(tmp_path / "t")
    loads.upsert_path(spark, path, rows([("a", "x", 1), ("a", "y", 2), ("b", "z", 3), ("c", "w", 4)], cols), ["season", "player"])
    real = loads.write_mart

    def crash(df, where, *args, **kwargs):
        gone = {"nothing": [], "a partition": ["season=a"], "all files": ["season=a", "season=b"]}[lost]
        for name in gone:
            shutil.rmtree(f"{path}/{name}")
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(loads, "write_mart", crash)
    batch = rows([("a", "x", 10), ("b", "n", 5)], cols)
    with pytest.raises(RuntimeError):
        loads.upsert_path(spark, path, batch, ["season", "player"])
    monkeypatch.setattr(loads, "write_mart", real)
    if lost == "a partition":  # the failed batch comes again
        loads.upsert_path(spark, path, batch, ["season", "player"])
    else:  # another one comes
        loads.upsert_path(spark, path, rows([("c", "w", 40)], cols), ["season", "player"])
    want = [("a", "x", 10), ("a", "y", 2), ("b", "n", 5), ("b", "z", 3), ("c", "w", 4 if lost == "a partition" else 40)]
    assert values(spark.read.schema(cols).parquet(path), "season", "player", "v") == want
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_half_staged_upsert_is_dropped(rows, spark, tmp_path):
    cols = "season string, player string, v int"
    path = str(tmp_path / "t")
    loads.upsert_path(spark, path, rows([("a", "x", 1)], cols), ["season", "player"])
    half = tmp_path / "t__merge_dead"
    rows([("a", "x", 99)], cols).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert loads.complete_upsert(spark, path) == 0 and not half.exists()
    assert values(spark.read.schema(cols).parquet(path), "v") == [(1,)]


def test_checks_go_on_after_a_table_that_cannot_be_read(rows, spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"PAR1 this is no table PAR1")
    bad = spark.read.schema("v int").parquet(str(tmp_path / "bad"))
    good, empty = rows([(1,), (None,), (70,)], "v int"), rows([], "v int")
    report = checks.run_checks(spark, [
        checks.Check("null", "bad", bad, row=F.col("v").isNull()),
        checks.Check("unique", "bad", bad, lambda d: checks.check_unique(d, "v")),
        checks.Check("null", "good", good, row=F.col("v").isNull()),
        checks.Check("range", "good", good, row=~F.col("v").between(0, 60), severity="warn", where="v is not null"),
        checks.Check("unique", "good", good, lambda d: checks.check_unique(d, "v")),
        checks.Check("null", "none", empty, row=F.col("v").isNull(), warn_when_empty=True),
        checks.Check("null", "lost", lambda: spark.read.parquet(str(tmp_path / "lost")), row=F.col("v").isNull()),
    ])
    assert [tuple(r) for r in report.collect()] == [
        ("null", "bad", None, "unreadable"), ("unique", "bad", None, "unreadable"), ("null", "good", 1, "fail"),
        ("range", "good", 1, "warn"), ("unique", "good", 0, "pass"), ("null", "none", 0, "warn"),
        ("null", "lost", None, "unreadable"),
    ]


def test_group_checks_share_one_pass(rows, spark, tmp_path):
    data = [(1, "a", 0.0, "x"), (1, "a", -0.0, "x"), (2, None, 1.0, None), (2, None, 1.0, "y"), (None, "b", None, "z"), (None, "b", None, "x")]
    rows(data, "k int, s string, d double, n string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    both = [  # the same check by groups and by its own query
        ("k", checks.unique_groups("k"), lambda d: checks.check_unique(d, "k"), None),
        ("k_where", checks.unique_groups("k"), lambda d: checks.check_unique(d, "k"), "n = 'x' OR k = 2"),
        ("none", checks.unique_groups("k"), lambda d: checks.check_unique(d, "k"), "k > 9"),
        ("s_d", checks.combination_groups(["s", "d"]), lambda d: checks.check_unique_combination(d, ["s", "d"]), None),
        ("all", checks.combination_groups("ksdn"), lambda d: checks.check_unique_combination(d, list("ksdn")), None),
        ("few", checks.min_rows_groups("n", 2), lambda d: checks.check_min_rows_per_group(d, "n", 2), None),
        ("accepted", checks.accepted_groups("n", ["x"]), lambda d: checks.check_accepted_values(d, "n", ["x"]), None),
    ]
    for source in (df, df.limit(0)):
        grouped = [checks.Check(n, "t", source, where=w, groups=g, warn_when_empty=True) for n, g, _, w in both]
        alone = [checks.Check(n, "t", source, f, where=w, warn_when_empty=True) for n, _, f, w in both]
        want = values(checks.run_checks(spark, alone), "check", "failures", "status")
        assert values(checks.run_checks(spark, grouped), "check", "failures", "status") == want
    found = {r["check"]: r["failures"] for r in checks.run_checks(spark, [checks.Check(n, "t", df, where=w, groups=g) for n, g, _, w in both]).collect()}
    assert found == {"k": 2, "k_where": 2, "none": 0, "s_d": 3, "all": 1, "few": 3, "accepted": 2}
    plan = checks._report(spark, [checks.Check(n, "t", df, where=w, groups=g) for n, g, _, w in both])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    many = [checks.Check(f"c{i}", "t", df, groups=checks.unique_groups("k"), where=f"k >= {i}") for i in range(checks.SETS + 3)]
    assert [r["failures"] for r in checks.run_checks(spark, many).collect()] == [2, 2, 1] + [0] * checks.SETS


def test_errors_that_are_no_failed_reads_are_raised(rows, spark):
    good = rows([(1,), (0,)], "v int")
    for row, condition in ((F.col("nothing") == 1, "UNRESOLVED_COLUMN"), (F.lit(1) / F.col("v") > 0, "DIVIDE_BY_ZERO")):
        with pytest.raises(PySparkException, match=condition):
            checks.run_checks(spark, [checks.Check("row", "good", good, row=row)]).collect()


def test_a_write_counts_its_rows(rows, spark, tmp_path):
    events, path = str(tmp_path / "events"), str(tmp_path / "t")
    df = spark.range(10_000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("season"), "id").repartition(7)
    first = loads.write_logged(df, path, events, "all", partition_by=["season"], cluster_by=["id"])
    part = loads.write_logged(df.where("season = 's1'"), path, events, "part", "s1", ["season"], touched_only=True)
    none = loads.write_logged(df.limit(0), str(tmp_path / "e"), events, "none")
    with pytest.raises(Exception, match="no such row"):
        loads.write_logged(df.select(F.raise_error(F.lit("no such row"))), str(tmp_path / "f"), events, "failed")
    log = {r["pipeline"]: r for r in loads.run_log(spark.read.schema(loads.RUN_EVENTS).parquet(events)).collect()}
    assert (log["all"]["run_id"], log["part"]["run_id"], log["none"]["run_id"]) == (first, part, none)
    assert [log[p]["rows_written"] for p in ("all", "part", "none", "failed")] == [10_000, 3333, 0, None]
    assert [log[p]["status"] for p in ("all", "part", "none", "failed")] == ["success"] * 3 + ["error"]
    assert "no such row" in log["failed"]["error_msg"] and spark.read.parquet(path).count() == 10_000


def test_a_curve_prunes_on_every_column(spark, tmp_path):
    """Files that may hold a narrow range of either column, by the statistics that Spark's scan goes by."""
    import pyarrow.parquet as pq

    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_suppkey", "l_partkey", "l_orderkey", "l_shipdate")
    by = ["l_partkey", "l_orderkey"]
    one, both = str(tmp_path / "sorted"), str(tmp_path / "curve")
    df.repartitionByRange(16, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(one)
    curved = tables.with_curve(df, by, 500)
    curved.repartitionByRange(16, "_curve").sortWithinPartitions("_curve").drop("_curve").write.parquet(both)

    def read(path, column, low, high):
        files = [pq.ParquetFile(f).metadata for f in pathlib.Path(path).glob("*.parquet")]
        spans = [(g.column(i).statistics.min, g.column(i).statistics.max) for m in files for g in [m.row_group(0)]
                 for i in range(m.num_columns) if g.column(i).path_in_schema == column]
        return sum(a <= high and b >= low for a, b in spans) / len(spans)

    top = {c: df.agg(F.max(c)).first()[0] for c in by}
    share = lambda path, c: sum(read(path, c, top[c] * i // 10, top[c] * i // 10 + top[c] // 50) for i in range(10)) / 10
    assert share(one, "l_orderkey") == 1.0
    assert all(share(both, c) < 0.55 for c in by), [share(both, c) for c in by]
    tables.write_mart(df.withColumn("year", F.year("l_shipdate")), str(tmp_path / "mart"), ["year"], by, curve_rows=500)
    back = spark.read.parquet(str(tmp_path / "mart"))
    assert back.count() == df.count() and back.agg(F.sum("l_orderkey")).first() == df.agg(F.sum("l_orderkey")).first()
    assert tables.with_curve(df.limit(0), by, 500).count() == 0


def test_curve_numbers_interleave(spark):
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    rows_ = tables.with_curve(grid, ["x", "y"], 1).collect()
    rank = lambda c: {v: sum(w < v for w in {r[c] for r in rows_}) + 1 for v in {r[c] for r in rows_}}
    xs, ys = rank("x"), rank("y")
    for r in rows_:
        want = sum((xs[r["x"]] >> b & 1) << (2 * b + 1) | (ys[r["y"]] >> b & 1) << (2 * b) for b in range(5))
        assert r["_curve"] == want
