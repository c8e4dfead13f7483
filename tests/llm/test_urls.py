import random

import pytest
from pyspark.sql import functions as F

from namelens.llm import urls
from namelens.llm.urls import RULES, build_cascade, is_listed, judge


@pytest.mark.parametrize("limit", [urls.CONSTANT_BYTES, 0])
@pytest.mark.parametrize("shard_keys", [100_000, 150])
def test_membership_is_exact(rows, monkeypatch, limit, shard_keys):
    monkeypatch.setattr(urls, "CONSTANT_BYTES", limit)
    # One bit for each key, so that there are mistakes and several levels.
    monkeypatch.setattr(urls, "FIRST_LEVEL", (2, 1))
    monkeypatch.setattr(urls, "LATER_LEVELS", (2, 1))
    keys = [(f"host{i}.example/{i % 7}", i % 5 == 0) for i in range(700)]
    universe = rows(keys + keys[:50] + [(None, True), ("", True)], "key string, listed boolean")
    cascade = build_cascade(universe, shard_keys)
    assert len(cascade.levels) > 3
    found, listed = is_listed(universe, "key", cascade)
    for r in found.select("key", "listed", listed.alias("got")).collect():
        assert r.got == (r.listed and bool(r.key))


def test_nothing_listed(rows):
    universe = rows([("a", False), ("b", False)], "key string, listed boolean")
    cascade = build_cascade(universe)
    assert cascade.levels == []
    found, listed = is_listed(universe, "key", cascade)
    assert [r[0] for r in found.select(listed).collect()] == [False, False]


CASES = [
    (1, "http://WWW.Example.com/en/x?q", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (2, "https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    (3, "https://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    (4, "x://example.com#/en/", "example.com", "", None, "allow"),
    (5, "http://a.net/fr/1#t", "a.net", "/fr/1", "net/fr/", "block"),
    (6, "http://a.net/en", "a.net", "/en", None, "allow"),
    (7, None, "", "", None, "allow"),
    (8, "no scheme", "", "", None, "allow"),
    (9, "", "", "", None, "allow"),
    (10, "http://spam.org/x", "spam.org", "/x", None, "block"),
    (11, "http://spam.org?/x", "spam.org", "", None, "block"),
    (12, "http://ÀB.org/x\ny#z", "Àb.org", "/x\ny", None, "allow"),
    (12, "http://ÀB.org/x\ny#z", "Àb.org", "/x\ny", None, "allow"),
    (None, "http://spam.net/es/" + "y" * 50_000, "spam.net", "/es/" + "y" * 50_000, "net/es/", "block"),
]


def test_rules_and_awkward_rows(rows):
    pages = rows([(c[0], c[1], "kept", "old", 5) for c in CASES], "page_id bigint, url string, _key string, host string, _shard int")
    listed = lambda keys: keys.withColumn("listed", F.col("host").startswith("spam."))
    found = judge(pages, RULES, listed)
    assert found.columns == ["page_id", "url", "_key", "_shard", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=repr)
    assert got == sorted(CASES, key=repr)
    assert judge(pages.limit(0), RULES, listed).collect() == []
