"""Whole jobs where an operator did less: uncapped brute force, rare domains, edited notices, markers in texts."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("touchline.llm")

from conftest import SF_DIR  # noqa: E402
from llm import brute  # noqa: E402
from llm.test_operators import DOCS, SECRET, docs, given, tokenizer_path  # noqa: E402, F401
from pyspark.sql import functions as F  # noqa: E402

from touchline.llm import queries as Q  # noqa: E402
from touchline.llm import jaccard, licenses, mixing, search, secrets, tokens, warc  # noqa: E402

# ---- op2 -------------------------------------------------------------------------------------------------------


def edited_templates():
    """(template, text) with at most a quarter of the template's words changed, left out or put in; and beyond that."""
    r = random.Random(11)
    for name, template in licenses.TEMPLATES.items():
        words = [w for w in brute.ALNUM.findall(template.translate(brute.LOWER))]
        yield from ((name, [*words[:i], "oddly", *words[i + 1 :]]) for i in range(min(len(words), 15)))
        yield name, [("oddly" if i % 4 == 3 else w) for i, w in enumerate(words)]
        for _ in range(6):
            own = list(words)
            for _ in range(r.randrange(1, len(words) // 4 + 2)):
                i = r.randrange(len(own))
                own[i : i + 1] = r.choice([["oddly"], [], [own[i], "oddly"]])
            yield name, own


def test_edited_notices_are_found_as_by_full_alignment(spark):
    cases = [(name, ["so", "it", "says", *words, "and", "goes", "on"]) for name, words in edited_templates()]
    df = spark.createDataFrame([(i, " ".join(words)) for i, (_, words) in enumerate(cases)], "doc_id bigint, text string")
    got = {(r.doc_id, r.license): r.matched for r in licenses.scan_licenses(df).collect()}
    numbers, found = collections.defaultdict(lambda: len(numbers)), 0
    for i, (name, words) in enumerate(cases):
        template = np.array([numbers[w] for w in brute.ALNUM.findall(licenses.TEMPLATES[name].translate(brute.LOWER))])
        best = licenses.align(np.array([numbers[w] for w in words]), template, 0, len(words) + len(template))
        whole = best is not None and best[1] >= 0.75 * len(template)
        found += whole
        assert ((i, name) in got) == whole, (name, words)
        assert not whole or got[i, name] == best[1]
    assert found > 100


@pytest.mark.parametrize("coverage", [0.5, 0.75, 0.9, 1.0])
def test_every_whole_stretch_holds_a_fingerprint(coverage):
    index, r = licenses.Index(licenses.TEMPLATES, coverage), random.Random(2)
    kept = {(t, p): q for q, (_, which, place) in index.runs.items() for t, p in zip(which.tolist(), place.tolist())}
    winnowed = 0
    for t, own in enumerate(index.words):
        (q,) = {q for (x, _), q in kept.items() if x == t}
        winnowed += sum(x == t for x, _ in kept) < len(own) - q + 1
        for _ in range(200):
            edits = {r.randrange(len(own)) for _ in range(index.edits[t])}
            hits = sum(not edits & set(range(p, p + q)) for x, p in kept if x == t)
            assert hits >= index.least[t] >= 1
    assert winnowed >= (0 if coverage == 0.5 else 6)  # below three words a stretch every run stays


def test_winnow_takes_the_last_least_of_each_window():
    assert licenses.winnow(np.array([5, 2, 2, 9, 7, 8], np.uint64), 3).tolist() == [2, 4]
    assert licenses.winnow(np.array([5, 2], np.uint64), 3).tolist() == [1]
    assert licenses.winnow(np.zeros(0, np.uint64), 3).tolist() == []


# ---- op3 -------------------------------------------------------------------------------------------------------


def test_markers_are_single_tokens(tokenizer_path):  # noqa: F811
    from tokenizers import Tokenizer

    marker = "<|endoftext|>"
    texts = [f" {marker}", f"one{marker}two", f"a {marker}\n{marker} b", marker, f"é {marker}", "one <|endoftext two|>", "<|endoftext", "|>"]
    want = [Tokenizer.from_file(tokenizer_path).encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(50256 in ids for ids in want) == 5
    assert [ids.tolist() for ids in tokens.Encoder(tokenizer_path).encode([t.encode() for t in texts])] == want


# ---- op4 -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("share", [0.01, 0.003, 0.001])
@pytest.mark.parametrize("low", [0.0, 1.0])
def test_rare_domain_meets_its_target(spark, share, low):
    rare, n = F.col("id") < 10_000 * share, 10_000
    soft = spark.range(n).select(F.lit(100.0).alias("words"), F.when(rare, 1.0).otherwise(0.0).alias("p0"), F.when(rare, 0.0).otherwise(1.0).alias("p1"))
    weights, gaps = mixing.fit_rates(soft, [0.2, 0.8], low=low)
    got = soft.withColumn("rate", mixing.rate_of(weights, low, 1e6)).agg(
        (F.sum(F.col("rate") * F.col("words") * F.col("p0")) / F.sum(F.col("rate") * F.col("words"))).alias("share"), F.min("rate").alias("least")
    ).first()
    assert abs(got["share"] - 0.2) < 1e-4 and got["least"] >= low and max(map(abs, gaps)) <= mixing.CLOSE


def test_targets_out_of_reach_are_told(spark):
    soft = spark.range(1000).select(F.lit(1.0).alias("words"), F.when(F.col("id") < 500, 0.9).otherwise(0.4).alias("p0"))
    soft = soft.withColumn("p1", 1 - F.col("p0"))
    _, gaps = mixing.fit_rates(soft, [0.2, 0.8])
    # Texts that are 40% of the first domain at least cannot give 20%; the least squares take 0.56 / 0.52 of such texts only.
    rate = 0.56 / 0.52
    assert abs(gaps[0] - (0.4 * rate - 0.2)) < 1e-3 and abs(gaps[1] - (0.6 * rate - 0.8)) < 1e-3


# ---- op6 -------------------------------------------------------------------------------------------------------


def bm25_of_whole_rows(rows, asked, k=10):
    """(scores, documents) of each asked id, best first, over all distinct words of its row."""
    data = [(i, collections.Counter(brute.ALNUM.findall((t or "").translate(brute.LOWER)))) for i, t in rows]
    n, df = len(data), collections.Counter(w for _, c in data for w in c)
    mean = sum(sum(c.values()) for _, c in data) / n
    idf = {w: math.log1p((n - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    out = {}
    for q, own in data:
        if q in asked and own:
            scores = []
            for i, c in data:
                norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
                s = sum(idf[w] * c[w] * 2.2 / (c[w] + norm) for w in own if w in c)
                if s > 0:
                    scores.append((-round(s, 8), i is None, i or 0))
            out[q] = sorted(scores)[:k]
    return out


def ranked(rows):
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query, r["rank"])):
        found[r.query].append((-round(r.score, 8), r.doc_id is None, r.doc_id or 0))
    return dict(found)


@pytest.mark.parametrize(("block_terms", "cursors"), [(1 << 21, 4), (300, 0), (300, 1 << 30)])
def test_search_takes_whole_rows(spark, docs, monkeypatch, block_terms, cursors):  # noqa: F811
    monkeypatch.setattr(search, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(search, "CURSORS", cursors)
    asked = [0, 2, 3, 6, 7, 8, 10, 15, 50, 100, 203]
    shards = search.build_shards(docs, shard_docs=9)
    got = search.search(shards, search.query_terms(docs.where(F.col("doc_id").isin(asked)))).collect()
    assert ranked(got) == bm25_of_whole_rows(DOCS, asked)


@pytest.mark.parametrize(("often", "again"), [(16, 8), (1, 0), (1 << 20, 1)])
def test_search_reads_shards_from_files(spark, monkeypatch, often, again):
    """Rows name the files of shards and hold no postings; copies and equal scores meet the bars of several shards."""
    monkeypatch.setattr(search, "OFTEN", often)
    monkeypatch.setattr(search, "AGAIN", again)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(40)]
    data = [(i, texts[i % 40 if i < 160 else 0]) for i in range(240)] + [(None, texts[0]), (240, None), (241, ""), (3, texts[5])]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    shards = search.build_shards(df, shard_docs=16)
    assert {f.dataType.simpleString() for f in shards.schema} == {"string", "bigint"}
    got = search.search(shards, search.query_terms(df.where("doc_id % 5 = 0"))).collect()
    assert ranked(got) == bm25_of_whole_rows(data, [i for i, _ in data if i is not None and i % 5 == 0])


@pytest.mark.parametrize(("often", "at_once", "alike"), [(100, 1 << 20, 512), (1 << 20, 50, 7), (1, 1, 1)])
def test_search_adds_up_many_queries_together(monkeypatch, often, at_once, alike):
    """Queries of a block share its list of terms and go through a shard in batches; scores are those of plain sums."""
    for name, value in (("OFTEN", often), ("AT_ONCE", at_once), ("ALIKE", alike), ("TOGETHER", 3)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(4)
    documents = [(i, np.unique(rng.integers(0, 80, rng.integers(0, 60)).astype(np.uint64)), 40) for i in range(90)]
    shard = search.Shard.of([(i, terms, rng.integers(1, 5, len(terms)), words) for i, terms, words in documents])
    asked = [np.unique(rng.integers(0, 100, rng.integers(0, 70)).astype(np.uint64)) for _ in range(40)]
    vocab, places = np.unique(np.concatenate(asked), return_inverse=True)
    idf, counts = rng.random(len(vocab)), np.array([len(a) for a in asked])
    order = search.side_by_side(counts, places)
    assert sorted(order.tolist()) == list(range(40))
    block = search.Asked(np.arange(40), counts, vocab, idf, places)
    found = {q: (docs, scores) for q, docs, scores in search._found(shard, block, np.zeros(40), 40.0, 5)}
    weights = dict.fromkeys(range(90), 0.0)
    for q, terms in enumerate(asked):
        want = dict(weights)
        for t in terms.tolist():
            (n,) = shard.find(np.array([t], np.uint64)).tolist()
            at = np.arange(shard.starts[n], shard.starts[n + 1]) if n >= 0 else np.zeros(0, int)
            for doc, part in zip(shard.docs[at].tolist(), shard.weights(40.0, at).tolist()):
                want[doc] += part * float(idf[np.searchsorted(vocab, t)])
        best = sorted((-s, d) for d, s in want.items() if s > 0)[:5]
        docs, scores = found.get(q, (np.zeros(0, int), np.zeros(0)))
        assert [(round(-s, 9), d) for s, d in best] == [(round(s, 9), d) for s, d in zip(scores.tolist(), docs.tolist())]


def test_search_tasks_are_even(spark):
    """Each group has as many shards, dealt out by size; before, groups came from a hash."""
    shards = spark.createDataFrame([(f"s{i}", 100 - i, 1, "f") for i in range(20)], "shard string, docs bigint, words bigint, folder string")
    groups = [r.shards for r in search.shard_groups(shards, 3).collect()]
    assert sorted(map(len, groups)) == [6, 7, 7] and sorted(s for g in groups for s in g) == sorted(f"s{i}" for i in range(20))


def test_search_query_takes_whole_rows(spark):
    texts = given(spark, "documents", "doc_id", "text")
    got = Q.QUERIES["op6_block_max_search"](spark, SF_DIR).collect()
    assert ranked(got) == bm25_of_whole_rows(texts, [i for i, _ in texts if i % 50 == 0])


# ---- op7 -------------------------------------------------------------------------------------------------------


def test_rows_of_one_id_are_one_document(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (9, b), (9, ""), (10, c), (11, None), (None, c)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = collections.Counter(map(tuple, jaccard.near_copies(df).collect()))
    assert got == collections.Counter(brute.jaccard(rows))
    assert got[9, 26, 3] == got[9, 0, 3] == 1
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.without_near_copies(df).collect())
    assert kept == [(0, c), (3, a), (10, c), (11, "")]


def test_pairs_are_compared_in_slices_of_bytes(monkeypatch):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[:n]).encode() for n in (100, 101, 130, 131, 399, 400, 5)]
    pairs = [(bytes([i]), bytes([j]), a, b) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs, strict=True)], names=["a", "b", "text_a", "text_b"])
    runs = [(a, b, *sorted((len(x.split()) - 4, len(y.split()) - 4))) for a, b, x, y in pairs]
    want = [(a, b) for a, b, few, many in runs if 4 * few >= 3 * many]  # each text is a prefix of the longer ones
    for most in (1, 700, 1 << 30):
        parts = list(jaccard.byte_slices(batch, ["text_a", "text_b"], most))
        assert sum(p.num_rows for p in parts) == len(pairs) and (len(parts) == 1) == (most > 1000)
        monkeypatch.setattr(jaccard, "SLICE_BYTES", most)
        monkeypatch.setattr(jaccard, "KEPT_BYTES", most)
        got = [r for out in jaccard.compare(iter([batch, batch.slice(0, 0)])) for r in zip(*(c.to_pylist() for c in out.columns), strict=True)]
        assert got == want and len(want) > 3


# ---- op8 -------------------------------------------------------------------------------------------------------


def test_ledger_keeps_what_it_has(spark, tmp_path):
    make = lambda *rows: spark.createDataFrame(rows, "p string, t string")
    ledger, rules = secrets.Ledger(spark, f"file://{tmp_path}/l"), secrets.BASE_RULES
    for path, text in (("a", SECRET), ("b", "password: hunter2x"), ("a", SECRET)):
        (found,) = secrets.scan_secrets(make((path, text)), "p", "t", ledger.path).collect()
        assert len(found["assign"]) >= 1
    assert ledger.read().count() == 2 * len(secrets.RULES)
    named = secrets.Ledger(spark, f"file://{tmp_path}/m")
    for _ in range(2):
        assert len(secrets.scan_secrets(make(("a", SECRET), ("b", "x")), "p", "t", named.path, rules, "1").collect()) == 2
        assert named.read().count() == 2 * len(rules)
    secrets.scan_secrets(make(("a", SECRET), ("c", "y")), "p", "t", named.path, rules, "2")
    assert named.read().count() == 3 * len(rules)


# ---- op1 -------------------------------------------------------------------------------------------------------


def test_payloads_are_those_of_the_bodies_read(spark, tmp_path):
    rows = [(1, "same"), (2, "same"), (3, "other é"), (4, ""), (None, "same"), (5, "other é"), (6, "alone")]
    folder = f"file://{tmp_path}/p"
    warc.write_archives(spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id bigint, url string, html string"), folder).collect()
    records = warc.read_archives(spark, folder)
    assert collections.Counter(map(tuple, warc.payloads(records).collect())) == collections.Counter(brute.warc(rows))
    cut = warc.payloads(records.withColumn("body", F.expr("substring(body, 1, 3)"))).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in cut if r.record_type == "response"} == {
        i: (n, warc.sha1_base32(b)) for i, n, b in ((2, 3, b"sam"), (4, 0, b""), (5, 3, b"oth"), (6, 3, b"alo"))
    }
    assert all(r.payload_bytes is None for r in cut if r.record_type == "revisit")
