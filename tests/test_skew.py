"""Operators that cut large groups, against plain Python on random and one-sided data."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from touchline.operators import checks, marts, names, reads
from touchline.plans import skew


@pytest.mark.parametrize("cell_rows", [3, 1000])
def test_pairs_within(rows, cell_rows):
    data = [("hot", f"k{i}", i) for i in range(40)] + [("cold", f"k{i}", i) for i in range(4)] + [("one", "k", 1)]
    df = rows(data, "g string, k string, v int")
    got = values(skew.pairs_within(df, ["g"], "k", ["v"], cell_rows), "g", "k_a", "v_a", "k_b", "v_b")
    want = [
        (a[0], a[1], a[2], b[1], b[2]) for a, b in itertools.permutations(data, 2) if a[0] == b[0] and a[1] < b[1]
    ]
    assert got == sorted(want, key=repr)


def test_expand_copies(rows, monkeypatch):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 10)
    got = skew.expand_copies(rows([("a", 25), ("b", 1), ("c", 0), ("d", 10)], "k string, n bigint"), "n")
    assert collections.Counter(r["k"] for r in got.collect()) == {"a": 25, "b": 1, "d": 10}


def test_order_slots_follow_the_order(rows):
    rng = random.Random(5)
    data = [(rng.choice([7, rng.randint(-1000, 1000)]),) for _ in range(3000)]
    slotted = skew.order_slots(rows(data, "v int"), ["v"], 100)
    spans = sorted((r["_slot"], r["lo"], r["hi"]) for r in slotted.groupBy("_slot").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    assert len(spans) > 2
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("slot_rows", [10**9, 20, 1])
@pytest.mark.parametrize("interval", [0, 1, 3])
def test_sequential_values(rows, interval, slot_rows):
    rng = random.Random(interval)
    data = [(rng.choice(["hot", "hot", "x", None]), rng.choice([5, None, rng.randint(0, 60)])) for _ in range(400)]
    got = values(checks.check_sequential_values(rows(data, "g string, v int"), "v", interval, group_by=["g"], rows_per_slot=slot_rows))
    want = []
    for g in {d[0] for d in data}:
        vs = sorted(v for h, v in data if h == g and v is not None)
        want += [(g, b, a) for a, b in zip(vs, vs[1:]) if b != a + interval]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("slot_rows", [10**9, 20, 1])
@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
@pytest.mark.parametrize("grouped", [True, False])
def test_ranges(rows, gaps, grouped, slot_rows):
    rng = random.Random(11)
    data = []
    for _ in range(300):
        low = rng.choice([None, 50, rng.randint(0, 200)])
        data.append((rng.choice(["hot", "hot", "b", None]), low, None if rng.random() < 0.05 else (low or 0) + rng.randint(0, 3)))
    df = rows(data, "g string, lo int, hi int")
    got = checks.check_ranges_exclusive(df, "lo", "hi", "g" if grouped else None, gaps, rows_per_slot=slot_rows)
    rule = checks.GAP_RULES[gaps]
    want = []
    for g in {d[0] for d in data} if grouped else {0}:
        part = [d for d in data if not grouped or d[0] == g]
        part.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[2] is not None, d[2] or 0))
        for i, (h, low, high) in enumerate(part):
            last = i == len(part) - 1
            after = None if last else part[i + 1][1]
            sound = low is not None and high is not None and low < high
            spaced = last if high is None or after is None else rule(high, after)
            if not (sound and spaced):
                want.append(((h,) if grouped else ()) + (low, high, after))
    cols = (["partition_by_col"] if grouped else []) + ["lower_bound", "upper_bound", "next_lower_bound"]
    assert values(got, *cols) == sorted(want, key=repr)


def test_order_slots_of_texts_and_constants(rows):
    rng = random.Random(6)
    data = [(rng.choice([None, "é", f"game-{rng.randint(0, 400):04d}"]), rng.choice([None, 1, 2])) for _ in range(2000)]
    slotted = skew.order_slots(rows(data, "t string, n int"), ["t", "n"], 20).collect()
    assert len({r["_slot"] for r in slotted}) > 20
    ordered = sorted(slotted, key=lambda r: (r["t"] is not None, r["t"] or "", r["n"] is not None, r["n"] or 0))
    assert [r["_slot"] for r in ordered] == sorted(r["_slot"] for r in slotted)
    assert skew.order_slots(rows([("a",)] * 50, "t string"), ["t"], 1).select("_slot").distinct().count() == 1
    assert skew.order_slots(rows([], "t string"), ["t"]).count() == 0


def test_ranges_of_texts_with_a_frequent_bound(rows):
    data = [("a", f"b{i:03d}") for i in range(60)] + [("a", "b000")] * 40 + [("c", "d")]
    got = checks.check_ranges_exclusive(rows(data, "lo string, hi string"), "lo", "hi", rows_per_slot=5)
    assert got.count() == 99  # all but the last of the ranges from "a", and the last one, overlap the next


def test_slots_number_with_the_rows_and_run_nothing_early(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    slotted = skew.order_slots(spark.range(100_000), ["id"], 1000)
    assert set(tracker.getJobIdsForGroup()) == before
    sizes = [r["count"] for r in slotted.groupBy("_slot").count().collect()]
    assert 50 < len(sizes) < 200 and max(sizes) < 12_000
    few = skew.order_slots(spark.range(10_000), ["id"], 1000).select("_slot").distinct().count()
    assert 2 < few < 30


@pytest.mark.parametrize("slot_rows", [10**9, 120, 1])
def test_match_numbers(rows, slot_rows):
    rng = random.Random(3)
    data = []
    for i in range(600):
        season = rng.choice(["hot", "hot", "b", None])
        day = rng.choice(["2024-01-01", f"2024-02-{rng.randint(1, 28):02d}", None])
        data.append((f"g{i:04d}", season, day, rng.choice(["W", "D", "L", None])))
    df = rows(data, "game_id string, season string, d string, result string").select(
        "game_id", "season", F.col("d").cast("date").alias("date"), F.lit(1).alias("gameweek"), F.lit("o").alias("opponent"),
        F.lit("home").alias("venue_type"), F.lit(1).alias("goals_for"), F.lit(0).alias("goals_against"), "result")
    got = marts.match_results(df, slot_rows).collect()
    assert len(got) == len(data)
    points = {"W": 3, "D": 1}
    for season in {d[1] for d in data}:
        mine = sorted((r for r in got if r["season"] == season), key=lambda r: r["match_number"])
        assert [r["match_number"] for r in mine] == list(range(1, len(mine) + 1))
        days = [str(r["date"] or "") for r in mine]
        assert days == sorted(days)
        for r in mine:
            upto = [points.get(x["result"], 0) for x in mine if str(x["date"] or "") <= str(r["date"] or "")]
            assert r["cumulative_points"] == sum(upto)
        assert [(str(r["date"] or ""), r["game_id"]) for r in mine] == sorted((str(r["date"] or ""), r["game_id"]) for r in mine)


def test_equality_by_hash_buckets(rows):
    """Against plain sets: repeated rows, NULLs in other places, a lost row, a changed one, other order."""
    rng = random.Random(12)
    data = [(rng.randrange(50), rng.choice([None, "x", "y"]), rng.choice([None, 0.0, -0.0, 1.5])) for _ in range(3000)]
    more = [(1000, None, 1.0), (None, "x", None), (None, None, None)]
    other = [r for r in data if r != data[0]][::-1] + [data[1]] * 5 + [(1000, "x", None), (None, None, 1.0)]
    a, b = rows(data + more, "k int, t string, v double").repartition(3), rows(other, "k int, t string, v double")
    plain = lambda rs: {(k, t, None if v is None else v + 0.0) for k, t, v in rs}
    want = [("a_minus_b", *r) for r in plain(data + more) - plain(other)] + [("b_minus_a", *r) for r in plain(other) - plain(data + more)]
    got = [(w, k, t, None if v is None else v + 0.0) for w, k, t, v in checks.check_equality(a, b).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert checks.check_equality(a, a.repartition(5)).count() == 0
    assert checks.check_equality(a, a.limit(0)).count() == a.distinct().count()
    assert checks.check_equality(a.limit(0), a.limit(0)).count() == 0


@pytest.mark.parametrize("levels", [(0,), (1, 2), (10, 18)])
def test_only_unequal_parts_are_compared(spark, levels):
    a = spark.range(20_000).withColumn("v", F.col("id") % 7)
    b = a.withColumn("v", F.when(F.col("id") == 77, 9).otherwise(F.col("v")))
    left, right = checks.unequal_parts(a, b, ["id", "v"], levels)
    assert {r["v"] for r in left.where("id = 77").collect()} == {0} and {r["v"] for r in right.where("id = 77").collect()} == {9}
    assert left.count() <= max(20_000 >> levels[-1], 1) * 2 + 40
    for side in checks.unequal_parts(a, a.repartition(3), ["id", "v"], levels):
        assert side.count() == 0


def test_equal_sums_do_not_hide_swapped_cells(rows):
    """Buckets of one: the same cells in other rows give other sums."""
    a, b = rows([(1, 2), (3, 4)], "x int, y int"), rows([(1, 4), (3, 2)], "x int, y int")
    assert checks.check_equality(a, b).count() == 4
    assert sum(s.count() for s in checks.unequal_parts(a, b, ["x", "y"], (0,))) == 4


def test_cardinality_by_hash_buckets(rows):
    rng = random.Random(13)
    ones = [(rng.choice([None, 1, 1, 1, *range(30)]),) for _ in range(500)]
    others = ones[20:] + [(99,)]
    count, against = collections.Counter(v for v, in ones), collections.Counter(v for v, in others)
    want = [(v, n) for v, n in count.items() if against[v] != n] + [(v, n) for v, n in against.items() if count[v] != n]
    got = checks.check_cardinality_equality(rows(ones, "a int"), "a", rows(others, "b int"), "b")
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_a_thousand_terms_find_what_literals_find(rows, tmp_path):
    rng = random.Random(14)
    part = lambda n: "".join(rng.choice("abÉ %_x1") for _ in range(n))
    people = [(rng.choice(["9697", "9798"]), rng.choice([None, f" {part(rng.randrange(0, 9))} ", part(4).upper()])) for _ in range(400)]
    blank = {c: "string" for c in reads.SQUAD_COLUMNS if c != "player"}
    squad = rows([(s, p, str(i)) for i, (s, p) in enumerate(people)], "season string, player string, player_id string")
    squad = squad.withColumns({c: F.lit(None).cast("string") for c in blank if c != "player_id"})
    terms = sorted({t.strip() for t in [part(rng.randrange(0, 7)) for _ in range(2200)] + [p for _, p in people if p][:40]})
    index = names.NameIndex.written(squad, str(tmp_path / "index"))
    many = rows([(t,) for t in [*terms, *terms[:9], None]], "term string")
    got = names.resolve_players(squad, many, "9697", index)
    want = reads.resolve_player(squad, terms, "9697")
    assert len(terms) > 1000
    assert values(got, "term", "tier", "season_used", "player", "player_id") == values(want, "term", "tier", "season_used", "player", "player_id")


def test_short_terms_and_unknown_pieces(rows, tmp_path):
    index = names.NameIndex.written(rows([("Ann",), ("anna b",), (None,), ("",), ("x%y",)], "player string"), str(tmp_path / "i"))
    asked = rows([(t,) for t in ("", "a", "nn", "ann", "anna", "nnab", "%", "b ", None)], "part string")
    found = collections.defaultdict(set)
    for r in index.containing(asked).collect():
        found[r["part"]].add(r["low"])
    assert found == {
        "": {"ann", "anna b", "", "x%y"}, "a": {"ann", "anna b"}, "nn": {"ann", "anna b"}, "ann": {"ann", "anna b"},
        "anna": {"anna b"}, "%": {"x%y"},
    }
    assert index.containing(asked.limit(0)).count() == 0
    assert names.first_names(index, rows([("AN",)], "term string"), 1).collect()[0]["low"] == "ann"


def test_clubs_of_a_network_are_written_once(spark):
    from conftest import SF_DIR
    from touchline.plans.catalog import Network

    network = Network(spark, SF_DIR)
    files = network.clubs.inputFiles()
    assert files and all("/clubs/" in f and "lineitem" not in f for f in files)
    assert network.clubs is network.clubs
