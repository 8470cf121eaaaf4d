"""Paths of URLs that hold another URL."""

from __future__ import annotations

from melodex.llm.queries import URL_RULES
from melodex.llm.urls import judge_urls


def test_path_follows_the_first_host(spark):
    urls = ["http://example.net?u=http://b.com/en/x", "http://example.net#http://b.com/en/x", "http://a.b/c?u=http://b.com/en/"]
    rows = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_RULES).collect()
    found = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert found == {0: ("example.net", "", None), 1: ("example.net", "", None), 2: ("a.b", "/c", None)}
