"""URL filter: rules for hosts and paths first, then naive Bayes over the words that host names are made of."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import MOST_HOT, query, staged, table
from staylens.operators.joins import keyed_join

# Host, path and verdict of each rule.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

PIECE = r"[\p{L}\p{M}]+|\p{N}+"
NUMBER = "0"  # stands for every run of digits
LONGEST_LABEL = 63  # by the rules of domain names
LONGEST_WORD = 32
UNIT = 1_000_000  # weights are whole millionths of a natural logarithm, so that sums do not depend on their order
UNKNOWN_LETTER = 2_302_585


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the end.

    Null, or no ``://``: both empty.
    """
    filled = F.coalesce(url, F.lit(""))
    at = F.instr(filled, "://")
    rest = F.when(at > 0, F.substring(filled, at + 3, F.char_length(filled))).otherwise("")
    return lowered(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (as text) that fits, and its verdict; null without one. Of equally long ones the longer host wins.

    ``rules`` is a short list: each becomes one condition.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decided in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, decided).otherwise(verdict)
    return rule, verdict


def pieces(text: Column) -> Column:
    """Runs of letters in lower case, and ``NUMBER`` for each run of digits."""
    return F.transform(F.regexp_extract_all(lowered(text), F.lit(PIECE), F.lit(0)), lambda p: F.when(p.rlike(r"^\p{N}"), NUMBER).otherwise(p))


def word_costs(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, cost, total): every word of 1 to 32 letters with minus the logarithm of its share; ``total`` is that of all words."""
    words = texts.select(F.explode(F.split(lowered(F.col(text_col)), r"[^\p{L}\p{M}]+")).alias("word"))
    counts = staged(words.where(F.char_length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("word", F.round(F.log(total / F.col("n")) * UNIT).cast("long").alias("cost"), F.round(F.log(total) * UNIT).cast("long").alias("total"))


def best_split(name: str, costs: dict[tuple[int, int], int], total: int) -> list[str]:
    """Words of the least total cost; of equally dear splits the one with the longer last word, and so on backwards.

    ``costs`` has the known words by start and length. An unknown piece of n letters costs as much as a word
    that occurs once, and n times ln 10 more.
    """
    best: list[tuple[int, int]] = [(0, 0)]
    for end in range(1, len(name) + 1):
        options = (
            (best[end - n][0] + costs.get((end - n, n), total + n * UNKNOWN_LETTER), -n) for n in range(1, min(end, LONGEST_WORD) + 1)
        )
        best.append(min(options))
    words, end = [], len(name)
    while end:
        n = -best[end][1]
        words.append(name[end - n : end])
        end -= n
    return words[::-1]


def segmented(names: DataFrame, costs: DataFrame) -> DataFrame:
    """(name, words) of distinct ``names`` of at most 63 letters, split by unigram costs.

    Every stretch of up to 32 letters of a name is looked up by a join, so the vocabulary may be of any size;
    stretches that very many names share are joined apart from the rest. Only the few words found return to a name.
    """
    names = staged(names, "names")
    starts = names.select("name", F.explode(F.sequence(F.lit(0), F.char_length("name") - 1)).alias("start"))
    room = F.least(F.lit(LONGEST_WORD), F.char_length("name") - F.col("start"))
    stretches = starts.select("name", "start", F.explode(F.sequence(F.lit(1), room)).alias("n")).select(
        "name", "start", "n", F.substring("name", F.col("start") + 1, F.col("n")).alias("word")
    )
    sought = stretches.groupBy("word").agg(F.count("*").alias("_rows")).join(costs.drop("total"), "word")
    found = keyed_join(stretches, staged(sought, "sought"), ["word"], "_rows", MOST_HOT)
    known = found.groupBy("name").agg(F.collect_list(F.struct("start", "n", "cost")).alias("known"))
    total = F.coalesce(costs.agg(F.max("total")).scalar(), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                best_split(name, {(k["start"], k["n"]): k["cost"] for k in known or ()}, whole)
                for name, known, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return names.join(known, "name", "left").withColumn("total", total).select("name", "known", "total").mapInArrow(run, "name string, words array<string>")


def url_filter(
    pages: DataFrame,
    texts: DataFrame,
    *,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "text",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row; what no rule decides is judged by naive Bayes.

    Pages that a rule decides are the classes of a multinomial model over the words of hosts and the pieces of
    paths; ``texts`` give the word shares by which letter runs of hosts are split. All rows count on both
    sides. Words that no decided page has say nothing; the words' weights and the class shares (each count plus one) add
    up, and below zero the page is blocked. Without decided pages all are allowed.

    Null and empty urls have no words and get the verdict of the class shares. Repeated rows and ids count and return each;
    null texts have no words; letter runs of more than 63 letters are no host names and stay whole; an empty table
    gives an empty result. Other columns of ``pages`` play no part.
    """
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, decided = ruled(F.col("host"), F.col("path"), rules)
    parsed = staged(split.withColumns({"rule": rule, "decided": decided}), "urls")
    # A url that very many pages have is one row from here on.
    urls = staged(parsed.groupBy("host", "path", "decided").agg(F.count("*").alias("pages")), "distinct-urls")

    def side(text: str, of_host: bool) -> Column:
        return F.transform(pieces(F.col(text)), lambda p: F.struct(F.lit(of_host).alias("of_host"), p.alias("piece")))

    parts = urls.select("*", F.inline(F.concat(side("host", True), side("path", False))))
    counted = {c: F.coalesce(F.sum(F.when(F.col("decided") == c, F.col("pages"))), F.lit(0)).alias(c) for c in ("allow", "block")}
    raw = staged(parts.groupBy("of_host", "piece").agg(*counted.values(), F.count_if(F.col("decided").isNull()).alias("_rows")), "pieces")

    is_name = F.col("of_host") & (F.col("piece") != NUMBER) & (F.char_length("piece") <= LONGEST_LABEL)
    names = raw.where(is_name).select(F.col("piece").alias("name"))
    words = segmented(names, word_costs(texts, text_col)).select(F.lit(True).alias("of_host"), F.col("name").alias("piece"), "words")
    made = raw.join(words, ["of_host", "piece"], "left").withColumn("word", F.explode(F.coalesce("words", F.array("piece"))))
    made = staged(made.select("of_host", "piece", "word", "allow", "block"), "piece-words")

    vocabulary = staged(made.groupBy("word").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count("*").alias("_rows")).where("allow + block > 0"), "vocabulary")
    sums = vocabulary.agg(*[(F.sum(c) + F.count("*")).alias(c) for c in counted])
    rate = {c: (F.col(c) + 1) / sums.select(c).scalar() for c in counted}
    weights = vocabulary.select("word", "_rows", F.round(F.log(rate["allow"] / rate["block"]) * UNIT).cast("long").alias("weight"))
    weighed = keyed_join(made.select("of_host", "piece", "word"), staged(weights, "word-weights"), ["word"], "_rows", MOST_HOT)
    weighed = weighed.groupBy("of_host", "piece").agg(F.sum("weight").alias("weight"))
    weighed = staged(raw.where("_rows > 0").select("of_host", "piece", "_rows").join(weighed, ["of_host", "piece"]), "piece-weights")

    open_urls = urls.where(F.col("decided").isNull()).drop("decided")
    sums = keyed_join(parts.where(F.col("decided").isNull()).select("host", "path", "of_host", "piece"), weighed, ["of_host", "piece"], "_rows", MOST_HOT)
    sums = sums.groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    prior = urls.agg(F.round(F.log((F.coalesce(F.sum(F.when(F.col("decided") == "allow", F.col("pages"))), F.lit(0)) + 1)
                     / (F.coalesce(F.sum(F.when(F.col("decided") == "block", F.col("pages"))), F.lit(0)) + 1)) * UNIT).cast("long")).scalar()
    score = F.coalesce("weight", F.lit(0)) + prior
    judged = open_urls.join(sums, ["host", "path"], "left").select("host", "path", "pages", F.when(score < 0, "block").otherwise("allow").alias("verdict"))
    clear = parsed.where(F.col("decided").isNotNull()).withColumnRenamed("decided", "verdict")
    rest = keyed_join(parsed.where(F.col("decided").isNull()), staged(judged, "judged-urls"), ["host", "path"], "pages", MOST_HOT)
    return clear.unionByName(rest.select(*clear.columns)).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    fits = [
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN '{{}}'"
        for h, p, _ in sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0])))
    ]
    ordered = sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0])))
    rule = " ".join(f.format(r[0] + r[1]) for f, r in zip(fits, ordered, strict=True))
    verdict = " ".join(f.format(r[2]) for f, r in zip(fits, ordered, strict=True))
    low = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    return f"""
WITH RECURSIVE rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {low}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
),
parsed AS MATERIALIZED (SELECT row_number() OVER () AS row, *, CASE {rule} END AS rule, CASE {verdict} END AS decided FROM split),
parts AS MATERIALIZED (
  SELECT row, decided, of_host, CASE WHEN regexp_matches(piece, '^\\p{{N}}') THEN '{NUMBER}' ELSE piece END AS piece FROM (
    SELECT row, decided, true AS of_host, unnest(regexp_extract_all(translate(host, {low}), '{PIECE}')) AS piece FROM parsed
    UNION ALL SELECT row, decided, false, unnest(regexp_extract_all(translate(path, {low}), '{PIECE}')) FROM parsed)
),
words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(text, {low}), '[\\p{{L}}\\p{{M}}]+')) AS word FROM documents)
  WHERE length(word) <= {LONGEST_WORD} GROUP BY word
),
totals AS (SELECT sum(n) AS total, coalesce(CAST(round(ln(sum(n)) * {UNIT}) AS BIGINT), 0) AS cost FROM words),
names AS MATERIALIZED (SELECT DISTINCT piece AS name FROM parts WHERE of_host AND piece <> '{NUMBER}' AND length(piece) <= {LONGEST_LABEL}),
stretches AS (
  SELECT name, start, n, substr(name, start + 1, n) AS word
  FROM (SELECT name, unnest(range(0, length(name))) AS start FROM names), range(1, {LONGEST_WORD + 1}) t(n) WHERE start + n <= length(name)
),
costs AS (
  SELECT name, map(list(start * 64 + s.n), list(coalesce(CAST(round(ln(total / w.n) * {UNIT}) AS BIGINT), cost + s.n * {UNKNOWN_LETTER}))) AS cost
  FROM stretches s CROSS JOIN totals LEFT JOIN words w USING (word) GROUP BY name
),
best AS (
  SELECT name, 0 AS pos, [{{'cost': CAST(0 AS BIGINT), 'n': CAST(0 AS BIGINT), 'words': CAST([] AS VARCHAR[])}}] AS state FROM names
  UNION ALL
  SELECT name, pos + 1, list_append(state, list_sort(list_transform(range(1, least(pos + 1, {LONGEST_WORD}) + 1), lambda n: {{
      'cost': CAST(state[pos + 2 - n].cost + cost[(pos + 1 - n) * 64 + n] AS BIGINT), 'n': CAST(-n AS BIGINT),
      'words': list_append(state[pos + 2 - n].words, substr(name, pos + 2 - n, n))}}))[1])
  FROM best JOIN costs USING (name) WHERE pos < length(name)
),
made AS MATERIALIZED (
  SELECT row, decided, word FROM (
    SELECT row, decided, unnest(CASE WHEN of_host AND state IS NOT NULL THEN state[-1].words ELSE [piece] END) AS word
    FROM parts LEFT JOIN (SELECT * FROM best WHERE pos = length(name)) b ON of_host AND b.name = piece)
),
vocabulary AS MATERIALIZED (
  SELECT word, count(*) FILTER (WHERE decided = 'allow') AS a, count(*) FILTER (WHERE decided = 'block') AS b
  FROM made WHERE decided IS NOT NULL GROUP BY word
),
weights AS (
  SELECT word, CAST(round(ln(((a + 1) / (SELECT sum(a) + count(*) FROM vocabulary)) / ((b + 1) / (SELECT sum(b) + count(*) FROM vocabulary))) * {UNIT}) AS BIGINT) AS weight
  FROM vocabulary
),
scores AS (SELECT row, sum(weight) AS weight FROM made JOIN weights USING (word) WHERE decided IS NULL GROUP BY row),
prior AS (
  SELECT CAST(round(ln((count(*) FILTER (WHERE decided = 'allow') + 1) / (count(*) FILTER (WHERE decided = 'block') + 1)) * {UNIT}) AS BIGINT) AS prior FROM parsed
)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN coalesce(weight, 0) + prior < 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed CROSS JOIN prior LEFT JOIN scores USING (row)"""


ORACLE = _oracle()


@query("op11_url_filter", ORACLE)
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
