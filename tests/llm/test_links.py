"""Hard negatives, token alignment and URL verdicts against brute force, on given tables and on hard rows."""

import collections
import math
import random

import pytest

pytest.importorskip("touchline.llm")

import numpy as np  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from llm import brute  # noqa: E402
from llm.test_operators import DOCS, bag, docs, empty, given, tokenizer_path  # noqa: E402, F401
from pyspark.sql import functions as F  # noqa: E402

from touchline.llm import alignment, negatives, urls  # noqa: E402
from touchline.llm import queries as Q  # noqa: E402

# ---- op11 ------------------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, label int, embedding array<double>"


def vectors(n=400, width=6, seed=3):
    """Clusters, copies of one vector, ties, a hot label, repeated ids, zeros, shorter vectors, and rows to leave out."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    near = lambda c, s: [x + r.gauss(0, s) for x in c]
    rows = [(i, r.choice([1, 1, 1, 2, 3, 4]), near(r.choice(centres), 0.3)) for i in range(n)]
    rows += [(n + i, i % 3, [0.5, 0.25, -0.5, 0.125, 1.0, -0.75]) for i in range(60)]
    rows += [(50, 1, near(centres[0], 0.1)), (50, 1, near(centres[0], 0.1)), (100, 2, [0.0] * width), (None, 2, near(centres[1], 0.1))]
    rows += [(650, 1, [1.0, 2.0]), (651, 2, [2.0]), (700, 3, []), (750, 9, near(centres[2], 0.1))]
    rows += [(800, None, centres[0]), (850, 1, None), (900, 1, [math.nan] * width), (950, 1, [1.0, None]), (1000, 2, [math.inf, 1.0])]
    return rows


def filled(rows):
    width = max(len(v) for _, _, v in rows if v is not None)
    usable = lambda v: v is not None and all(x is not None for x in v)
    return [(i, k, [*v, *[0.0] * (width - len(v))] if usable(v) else v) for i, k, v in rows]


def mined(spark, rows):
    given_rows = spark.createDataFrame(rows, VECTORS).repartition(5)
    clashing = given_rows.select("*", *[F.lit("x").alias(c) for c in ("id", "score", "block", "member", "shard", "place", "n")])
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bag(negatives.hard_negatives(clashing, "vec_id", label, "embedding").collect())


@pytest.mark.parametrize("shard, block, step", [(1 << 13, 512, 512), (37, 4, 8)])
def test_hard_negatives(spark, monkeypatch, shard, block, step):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "STEP", step)
    rows = vectors()
    assert mined(spark, rows) == bag(brute.negatives(filled(rows)))


def test_hard_negatives_of_large_numbers_and_nothing(spark):
    r = random.Random(4)
    rows = [(i, i % 3, [r.choice([-1, 1]) * 2.0 ** r.randrange(18, 22) + r.random() for _ in range(3)]) for i in range(120)]
    assert mined(spark, rows) == bag(brute.negatives(rows))
    assert not mined(spark, []) and not mined(spark, [(50, None, None), (1, 2, [1.0])])
    assert not mined(spark, [(50, 1, [1.0]), (51, 2, [1.0])])


def test_walks_end_early_and_stay_exact(monkeypatch):
    monkeypatch.setattr(negatives, "STEP", 16)
    r = np.random.default_rng(1)
    centre = r.normal(size=8)
    close = np.floor(256 * (centre + 0.05 * r.normal(size=(20, 8)))).astype(np.int64)
    items = np.floor(256 * r.normal(size=(3000, 8))).astype(np.int64)
    rows = lambda v: negatives.Rows(v, np.arange(len(v)), np.zeros(len(v), bool), np.zeros(len(v), np.int64), np.arange(len(v)))
    seen = []
    exact = negatives.products
    monkeypatch.setattr(negatives, "products", lambda a, b, most: seen.append(len(a) * len(b)) or exact(a, b, most))
    best = negatives.Best(np.full((20, 1), negatives.LOW, np.int64), np.full((20, 1), negatives.HIGH, np.int64), 3)
    negatives.walk(rows(close), np.arange(20), centre / np.linalg.norm(centre), rows(items), np.arange(3000), best)
    want = -np.sort(-(close @ items.T), axis=1)[:, :3]
    assert best.score.reshape(20, 3).tolist() == want.tolist()
    assert sum(seen) < 20 * 3000 / 2


def test_negative_query(spark):
    got = Q.QUERIES["op11_hard_negatives"](spark, SF_DIR).collect()
    assert bag(got) == bag(brute.negatives(given(spark, "embeddings", "vec_id", "label", "embedding")))


# ---- op12 ------------------------------------------------------------------------------------------------------

ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
STRANGE = [
    (301, "<|endoftext|> a<s></s><unk>"), (302, "▁ under"), (303, "tab\there  two   three\n\nlines "), (304, "日本語 テキスト 🙂🙂"),
    (305, "=" * 3000 + "-" * 2999), (306, "a" * 5000), (307, " "), (308, "\x00\x01"), (309, "ﬁne ｗide É e\u0301"),
]


@pytest.fixture(scope="module")
def piece_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def aligned(rows, paths):
    table = alignment.Alignment(rows, "doc_id", "text", *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    out = table.per_document(table.texts()).select(F.col("key").alias("doc_id"), *ALIGNED[1:-1], digest)
    return bag(out.collect())


@pytest.mark.parametrize("block, wide, copies", [(8 << 20, 1 << 12, 1000), (2000, 1, 2)])
def test_alignment(spark, docs, empty, tokenizer_path, piece_path, monkeypatch, block, wide, copies):  # noqa: F811
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
    monkeypatch.setattr(alignment, "COPIES", copies)
    strange = spark.createDataFrame(STRANGE, "doc_id bigint, text string")
    rows = docs.unionByName(strange, allowMissingColumns=True)
    paths = (tokenizer_path, piece_path)
    assert aligned(rows, paths) == bag(brute.alignment(DOCS + STRANGE, *paths))
    assert not aligned(empty, paths)


def test_groups_spell_the_text(spark, tokenizer_path, piece_path):  # noqa: F811
    rows = spark.createDataFrame([(1, "Hello wörld  again")], "doc_id bigint, text string")
    table = alignment.Alignment(rows, "doc_id", "text", tokenizer_path, piece_path)
    groups = [tuple([int(i) for i in side.split(",")] for side in g.split("|")) for g in table.texts().first().groups.split(";")]
    for side, tokens in ((0, alignment.byte_level(tokenizer_path)), (1, alignment.sentence_pieces(piece_path))):
        assert b"".join(tokens.pieces[i] for g in groups for i in g[side]).decode() == " Hello wörld  again"
    for one, other in groups:
        assert one and other
    assert {(r.a, r.b) for r in table.counts.collect()} == {(x, y) for g, h in groups for x in g for y in h}


def test_alignment_query(spark, tokenizer_path, piece_path):  # noqa: F811
    got = Q.QUERIES["op12_token_alignment"](spark, SF_DIR).select(*ALIGNED).collect()
    assert bag(got) == bag(brute.alignment(given(spark, "documents", "doc_id", "text"), tokenizer_path, piece_path))


# ---- op13 ------------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://ORG/", "https://A.Example.ORG/es/x?q#f", "http://example.org/es", "http://example.org/en/12",
    "x://example.org/en/1://org/", "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/", "http://x.com?/de/",
    "http://com/de/x", "http://a.net/x/?b=2&a=1&utm_source=z#t", "https://A.net:443/x?a=1&b=2", "http://a.net:80/x//?a=1&&b=2&ref=q",
    "http://a.net/X?a=1&b=2", "ftp://İ.net/\nx", "http://a.net/x?a=1", "://", "http://xorg/", "http://a.net/x?ref",
]
LISTED = ["http://a.net/x?b=2&a=1", "http://a.net/x", None, "nothing", "http://a.net/x", "http://b.com/fr/"]


def want_urls(pages, listed):
    """Plain Python: host, path, canonical form, longest rule."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tracking = ("ref", "fbclid", "gclid", "sid", "sessionid", "phpsessid")

    def parts(url):
        if url is None or "://" not in url:
            return "", "", ""
        rest = url.split("://", 1)[1].split("#", 1)[0]
        rest, _, query = rest.partition("?")
        host, slash, path = rest.partition("/")
        return host.translate(low), slash + path, query

    def canon(url):
        host, path, query = parts(url)
        for port in (":80", ":443", ":"):
            if host.endswith(port):
                host = host[: -len(port)]
                break
        named = []
        for p in query.split("&"):
            name = p.translate(low).split("=", 1)[0]
            tracks = name in tracking or (name.startswith("utm_") and name[4:].isascii() and name[4:].isalpha())
            if p and not tracks:
                named.append(p)
        return host + path.rstrip("/") + ("?" + "&".join(sorted(named)) if named else "")

    held = {canon(u) for u in listed if u is not None and "://" in u}
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    out = []
    for i, url in pages:
        host, path, _ = parts(url)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        on_list = url is not None and "://" in url and canon(url) in held
        out.append((i, host, path, rule, verdict or ("block" if on_list else "allow")))
    return out


@pytest.mark.parametrize("blocks, per_block", [(1 << 19, 16), (0, 1)])
def test_url_verdicts(spark, monkeypatch, blocks, per_block):
    """Also with a filter too large to broadcast, which joins by shuffle."""
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", blocks)
    monkeypatch.setattr(urls, "KEYS_PER_BLOCK", per_block)
    rows = [(i, u) for i, u in enumerate(URLS)] + [(7, "http://a.net/x")] * 40 + [(None, "http://a.net/x"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").repartition(4)
    pages = pages.select("*", *[F.lit("y").alias(c) for c in ("host", "path", "canon", "block", "salt", "fit", "listed", "possible", "row", "w0")])
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")

    def judged(p, of):
        return bag(urls.judge(p, urls.UrlList(of)).select("row.page_id", "host", "path", "rule", "verdict").collect())

    assert judged(pages, listed) == bag(want_urls(rows, LISTED))
    assert judged(pages, listed.limit(0)) == bag(want_urls(rows, []))
    assert not judged(pages.limit(0), listed)


def test_the_filter_passes_all_listed_and_few_others(spark):
    table = urls.UrlList(spark.range(5000).select(F.format_string("http://h%d.net/p", F.col("id") % 977 + F.col("id")).alias("url")))
    inside = table.possible(table.table)
    assert inside.where("not possible").count() == 0
    others = spark.range(20000).select(F.format_string("x%d.net/p", "id").alias("canon"))
    assert table.possible(others).where("possible").count() < 400


def test_url_query(spark):
    pages = given(spark, "pages", "page_id", "url")
    campaign = [u for _, u in pages if u is not None and "utm_" in u]
    want = collections.Counter(want_urls(pages, campaign))
    assert bag(Q.QUERIES["op13_url_filter"](spark, SF_DIR).collect()) == want


# ---- columns and words of the other operators ------------------------------------------------------------------


def test_results_keep_columns_of_any_name(spark):
    from touchline.llm import jaccard, substrings

    texts = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (None, "x y"), (3, "other words are here today")]
    plain = spark.createDataFrame(texts, "doc_id bigint, text string")
    names = ["n_words", "kept", "spans", "N_removed", "_name", "name", "row", "places", "copies"]
    out = substrings.remove_repeats(plain.select("*", *[F.lit("x").alias(c) for c in names]), length=5, anchor_words=2)
    assert sorted(c for c in out.columns if c.lower() in ("n_words", "n_removed", "kept", "spans")) == ["kept", "n_removed", "n_words", "spans"]
    assert bag((r.doc_id, r.n_words, r.n_removed, r["_name"], r["row"]) for r in out.collect()) == bag(
        (i, len((t or "").split()), 7 if i in (1, 2) else 0, "x", "x") for i, t in texts
    )
    names = ["_number", "_head", "key", "number", "row", "component_id", "n_shingles", "node"]
    kept = jaccard.without_near_copies(plain.select("*", *[F.lit("x").alias(c) for c in names]))
    assert kept.columns == ["doc_id", "text", *names]
    assert bag((r.doc_id, r["_head"]) for r in kept.collect()) == bag([(1, "x"), (3, "x"), (None, "x")])


def test_words_are_counted_between_white_space(spark):
    from touchline.llm import mixing

    texts = ["\nabc def\n", "\n", "", " a\tb\x0bc\x0c\r\n d ", "one", "a\u00a0b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixing.word_count(F.col("t")).alias("n"))
    assert {r.t: r.n for r in rows.collect()} == {t: float(len(brute.WORD.findall(t))) for t in texts}


def test_quality_stage_keeps_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("_score", F.lit("own")).withColumn("_row", F.lit(1))
    out = corpus_pipeline.reject_low_quality(spark, docs, SF_DIR)
    assert out.columns == docs.columns and {r[0] for r in out.select("_score").collect()} == {"own"}
