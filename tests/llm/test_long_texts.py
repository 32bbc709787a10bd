"""Very long texts in the operators whose other tests have short ones."""
from pyspark.sql import functions as F

from textlab.llm import neardup, queries, sharding, url_filter


def test_long_urls_and_pages(spark):
    path = "/en/" + "shop-name/" * 800
    rows = [(1, "http://example.com" + path, "<p>shop name</p>"), (2, "http://other.net/es/x", "<p>" + "shop name " * 50_000 + "</p>"),
            (3, "http://" + "a" * 400 + ".com/x", None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(d, queries.URL_RULES).collect()}
    assert got[1]["path"] == path and got[1]["rule"] == "example.com/en/" and got[1]["verdict"] == "block"
    assert got[2]["rule"] == "net/es/" and got[3]["host"] == "a" * 400 + ".com"


def test_very_long_urls(spark):
    """Many tokens in one url, and one name of many letters."""
    html = "<p>" + "shop name " * 50 + "</p>"
    rows = [(1, "http://other.org/" + "shop-name/" * 20_000, html), (2, "http://other.org/" + "shopname" * 25_000, None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(d, queries.URL_RULES).collect()}
    assert got[1]["path"] == "/" + "shop-name/" * 20_000 and set(got[1]["words"].split()) >= {"shop", "name"}
    assert " ".join(["shop", "name"] * 25_000) in got[2]["words"]


def test_long_names_split_alike_across_pieces(spark):
    lexicon = {"shop": 5, "name": 4, "the": 9, "shopkeeper": 2, "a" * 24: 3}
    names = ["theshopkeeper" * 90, "x" + "a" * 1100, "shopname" * 64, "shopname" * 64 + "t", "ab"]
    got = {r["name"]: r["words"] for r in url_filter.segment(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame(list(lexicon.items()), "word string, n long")).collect()}
    assert got == {n: url_filter.viterbi(n, lexicon, sum(lexicon.values())) for n in names}


def test_long_texts_in_shards(spark):
    long = "word " * 200_000
    d = spark.createDataFrame([(i, long if i < 4 else f"t{i}") for i in range(40)], "doc_id long, text string")
    rows = sharding.balanced_shards(d, 5, link=F.sha2("text", 256), size=F.octet_length("text")).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(40))
    assert len({r["shard"] for r in rows if r["doc_id"] < 4}) == 1


def test_long_near_duplicates(spark):
    words = [f"w{i}" for i in range(60_000)]
    near, far = words[:30_000] + ["changed"] + words[30_001:], words[::-1]
    d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(d, width=3, pct=85).collect()}
    assert got == {1: (59_998, 1), 2: (59_998, 1), 3: (59_998, 3)}
