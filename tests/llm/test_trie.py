"""op12: the prefix trie against a plain version that lists every prefix of every conversation."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from staylens.llm import trie

NAMES = "conv_id long, turn long, role string, text string, depth long, key string, weight int"


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def plain_nodes(turns):
    """Nodes of (conv_id, turn, role, text) rows whose order within a conversation is given."""
    own = defaultdict(list)
    for conv, _, role, text in turns:
        if conv is not None:
            own[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, rows in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        rebuilt[conv] = [*own.get(base, [])[:h], *rows[h:]]
    members, ends = defaultdict(list), defaultdict(list)
    for conv, rows in rebuilt.items():
        for d in range(len(rows) + 1):
            members[tuple(rows[:d])].append(conv)
        ends[tuple(rows)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        yield node
        for child in children[node]:
            yield from below(child)

    for node, convs in members.items():
        subtree = list(below(node))
        yield (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            len(children[node]),
            sum(not children[n] for n in subtree),
            sum((len(members[n]) - 1) * (word_count(n[-1][1]) if n else 0) for n in subtree),
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )


def nodes(spark, turns):
    df = spark.createDataFrame([(*t, 1, "x", 2) for t in turns], NAMES)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs, rebuilt = trie.shared_heads(trie.numbered_turns(df), F.expr("conv_id - conv_id % 20"), head, 3)
    return trie.prefix_trie(convs, rebuilt)


def same(spark, turns):
    found = [tuple(r) for r in nodes(spark, turns).collect()]
    assert sorted(found, key=str) == sorted(plain_nodes(turns), key=str)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    """Few different texts, so that many conversations share beginnings and whole sequences."""
    rng = random.Random(seed)
    turns = []
    for conv in rng.sample(range(-60, 200), 150):
        turns += [(conv, t, rng.choice("ab"), rng.choice(["", "one", "two words", None])) for t in range(rng.choice([1, 1, 2, 3, 5, 9]))]
    same(spark, turns)


def test_one_sequence_holds_most_conversations(spark):
    """Its ids fill several chunks of the digest; another conversation is longer than all others."""
    turns = [(conv, t, "user", f"turn {t}") for conv in range(0, 40_000, 20) for t in range(2)]
    turns += [(7, t, "user", f"long {t}") for t in range(400)]
    same(spark, turns)


def test_nulls_repeats_and_long_texts(spark):
    turns = [
        (None, 0, "user", "belongs to none"),
        (1, None, None, None),
        (1, None, None, None),
        (1, 0, "user", "word " * 50_000),
        (2, 0, "", ""),
        (2, 1, "user", " \t\n"),
        (2, 5, "user", "中文 text\x85with\u00a0other blanks"),
    ]
    same(spark, turns)


def test_ties_in_turn_have_a_fixed_order(spark):
    """Rows of one turn come by role, then by a hash of the text, whatever the layout of the table."""
    turns = [(20, 0, role, text) for role in "ba" for text in ("x", "y", "z")]
    first = sorted(map(str, nodes(spark, turns).collect()))
    assert sorted(map(str, nodes(spark, turns[::-1]).collect())) == first and len(first) == 7


def test_no_conversations(spark):
    assert nodes(spark, []).count() == 0
    assert nodes(spark, [(None, 0, "user", "x")]).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    """Conversation 21 takes its head from 20, which is absent; all its turns are replaced by none."""
    lost = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert same(spark, [(lost, 0, "user", "gone")]) == [(lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]
