from collections import Counter

from tidemark.llm import urls


def test_rows_of_many_copies_come_back_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_COPIES", 10)
    rows = [(1, "http://a.net/es/x")] * 35 + [(None, None)] * 21 + [(2, "http://www.example.com/en/")] * 10 + [(3, "http://www.example.com/en/")]
    rules = spark.createDataFrame(urls.CONTRACT_RULES, urls.RULES)
    got = Counter(map(tuple, urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()))
    assert got == {(1, "a.net", "/es/x", "net/es/", "block"): 35, (None, "", "", None, "allow"): 21, (2, "www.example.com", "/en/", "www.example.com/en/", "allow"): 10, (3, "www.example.com", "/en/", "www.example.com/en/", "allow"): 1}


def test_a_hundred_thousand_equal_rows(spark):
    rows = spark.range(100_001).selectExpr("cast(null as long) page_id", "'http://x.com/' url")
    assert urls.judge(rows, spark.createDataFrame(urls.CONTRACT_RULES, urls.RULES)).count() == 100_001
