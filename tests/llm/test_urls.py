"""op11: url verdicts against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from staylens.llm import urls

TEXTS = [(1, "The cat sat on the mat; cheap pills, Cheap pills! buy flowers online " * 20), (2, "news from the village " * 30), (3, None), (4, "x" * 40)]
NAMES = "page_id long, url string, host string, path string, rule int, verdict string, weight int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return regex.findall(r"[\p{L}\p{M}]+", lowered(text or ""))


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return lowered(host), path


def matched(host, path):
    fitting = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fitting, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def cheapest(name, counts, total):
    """Every way to split a short name, by the same costs."""
    unit = urls.UNIT

    def cost(word):
        if word in counts:
            return round(math.log(total / counts[word]) * unit)
        return round(math.log(max(total, 1)) * unit) + len(word) * urls.UNKNOWN_LETTER

    def splits(text):
        if not text:
            yield []
        for n in range(1, min(len(text), urls.LONGEST_WORD) + 1):
            for rest in splits(text[:-n]):
                yield [*rest, text[-n:]]

    return min(splits(name), key=lambda s: (sum(map(cost, s)), [-len(w) for w in reversed(s)]))


def plain_verdicts(pages, texts):
    counts = Counter(w for _, text in texts for w in words_of(text) if len(w) <= urls.LONGEST_WORD)
    total = sum(counts.values())
    judged = [(page, *split_url(url)) for page, url in pages]
    tokens, decided = [], []
    for _, host, path in judged:
        made = []
        for piece in regex.findall(urls.PIECE, host):
            number = regex.match(r"\p{N}", piece)
            made += [urls.NUMBER] if number else cheapest(piece, counts, total) if len(piece) <= 20 else [piece]
        made += [urls.NUMBER if regex.match(r"\p{N}", p) else p for p in regex.findall(urls.PIECE, lowered(path))]
        tokens.append(made)
        decided.append(matched(host, path)[1])
    classes = {c: Counter(w for made, d in zip(tokens, decided, strict=True) if d == c for w in made) for c in ("allow", "block")}
    vocabulary = set(classes["allow"]) | set(classes["block"])
    sums = {c: sum(classes[c].values()) + len(vocabulary) for c in classes}
    prior = round(math.log((decided.count("allow") + 1) / (decided.count("block") + 1)) * urls.UNIT)
    for (page, host, path), made, d in zip(judged, tokens, decided, strict=True):
        weights = [
            round(math.log(((classes["allow"][w] + 1) / sums["allow"]) / ((classes["block"][w] + 1) / sums["block"])) * urls.UNIT)
            for w in made
            if w in vocabulary
        ]
        yield page, host, path, matched(host, path)[0], d or ("block" if sum(weights) + prior < 0 else "allow")


def same(spark, pages, texts=TEXTS):
    df = spark.createDataFrame([(*p, "a", "b", 1, "c", 2) for p in pages], NAMES)
    docs = spark.createDataFrame(texts, "page_id long, text string")
    found = urls.url_filter(df, docs)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted(map(str, (tuple(r) for r in found.collect())))
    assert rows == sorted(map(str, plain_verdicts(pages, texts)))
    return rows


def test_pages_of_every_kind(spark):
    rng = random.Random(4)
    hosts = ["example.org", "www.example.org", "badexample.org", "cheappills.net", "CatNews.Example.COM", "flowers-online.com", "a1b22.net", "вести.рф", "org", ""]
    paths = ["", "/", "/es/1", "/en/1", "/en/12.html", "/fr/x", "/de/", "/Cheap/Pills", "/news/2020/05", "/été", "/%20a"]
    pages = [(i, f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#org/', '?a#b'])}") for i in range(400)]
    rows = same(spark, pages)
    assert any("'block'" in r and "None" in r for r in rows) and any("'allow'" in r and "None" in r for r in rows)


def test_nulls_repeats_and_odd_urls(spark):
    long = "http://" + "z" * 5_000 + ".com/" + "y" * 200_000
    pages = [(1, None), (None, "no scheme"), (2, ""), (3, "://"), (3, "://"), (4, "http://x.org/a://b.com/"), (5, long), (None, "http://EXAMPLE.org/es/"), (6, "http://user@x.org:80\n/a\nb?c")]
    same(spark, pages)
    # The hot url: most rows have it.
    same(spark, [*[(9, "http://cheappills.net/buy")] * 300, (1, "http://a.com/de/pills"), (2, "http://b.com/fr/cat")])


def test_empty_tables(spark):
    assert same(spark, []) == []
    assert same(spark, [(1, "http://catnews.net/a"), (2, "http://x.org/b")], texts=[])
    assert same(spark, [(1, "http://cheappills.net")])


@pytest.mark.parametrize("name", ["thecatsatonthemat", "buyflowers", "qqq", "cheapcheappills", "a"])
def test_split_equals_every_way(name):
    counts = Counter({"the": 9, "cat": 4, "sat": 2, "on": 5, "mat": 1, "cats": 1, "at": 3, "buy": 1, "flower": 2, "flowers": 1, "cheap": 1, "pills": 1, "a": 4})
    total = sum(counts.values())
    costs = {
        (i, n): round(math.log(total / counts[name[i : i + n]]) * urls.UNIT) for i in range(len(name)) for n in range(1, len(name) - i + 1) if name[i : i + n] in counts
    }
    assert urls.best_split(name, costs, round(math.log(total) * urls.UNIT)) == cheapest(name, counts, total)


def test_rules_prefer_the_longest(spark):
    rules = [("org", "/", "allow"), ("a.org", "/x", "block"), ("org", "/xyz", "allow"), ("b.a.org", "", "block")]
    df = spark.createDataFrame([("a.org", "/x"), ("a.org", "/xyz"), ("b.a.org", "/"), ("xa.org", "/x"), ("org", "")], "host string, path string")
    rule, verdict = urls.ruled(F.col("host"), F.col("path"), rules)
    assert [tuple(r) for r in df.select(rule, verdict).collect()] == [("a.org/x", "block"), ("a.org/x", "block"), ("b.a.org", "block"), ("org/", "allow"), (None, None)]
