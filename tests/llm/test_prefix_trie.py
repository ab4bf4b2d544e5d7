"""The trie of rebuilt conversations against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from fleetspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, n int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(some)] for conv, some in own.items()}
    built = {}
    for conv, some in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(turns.get(conv - conv % 20, [])[:h] + some[h:])
    members = defaultdict(list)
    for conv, some in built.items():
        for depth in range(len(some) + 1):
            members[some[:depth]].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves, saved = 0 if children[path] else 1, (len(members[path]) - 1) * words
        for child in children[path]:
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    found = []
    for path, some in members.items():
        ends = ",".join(map(str, sorted(c for c in some if built[c] == path)))
        found.append(
            (
                min(some), len(path), min(members[path[:-1]]) if path else None, len(some), len(children[path]),
                *below(path), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def conversations(seed: int, count: int):
    dice = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(dice.randrange(7)):
            text = dice.choice(["hi there", "a b  c", "", None, "ok"])
            rows.append((conv, turn, dice.choice(["user", None]), text))
    same = [(conv, turn, "user", f"turn {turn}") for conv in range(count, count + 50) for turn in range(9)]
    odd = [
        (None, 1, "user", "lost"), (7_000_019, None, "user", "first"), (7_000_019, None, "user", "first"), (7_000_019, 3, "user", "x"),
        (7_000_019, 3, "bot", "x"), (7_000_019, 1, "a:b", "c"), (7_000_020, 1, "a", "b:c"), (7_000_021, 0, "", ""),
        *((8_000_000, turn, "user", "long " * 50) for turn in range(600)),
    ]
    return rows + same + odd


@pytest.mark.parametrize("container", [1, 5, 2_000])
def test_every_prefix(spark, container):
    rows = conversations(container, 130)
    if container == 1:
        rows = [r for r in rows if r[0] != 8_000_000]
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], SCHEMA).repartition(3)
    found = prefix_trie.prefix_trie(frame, container=container)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == brute_force(rows)


def test_no_conversation(spark):
    none = spark.createDataFrame([(None, 1, "user", "lost", "h", 1)], SCHEMA)
    assert prefix_trie.prefix_trie(none).count() == 0
    assert prefix_trie.prefix_trie(none.limit(0)).count() == 0


def test_sweep_counts_once():
    suffix = lambda ids, conv, n=1: {"ids": tuple(ids), "words": [2] * len(ids), "conv": conv, "n": n, "ends": f"e{conv}"}
    nodes = prefix_trie.sweep([suffix("ab", 4), suffix("", 9, 2), suffix("ac", 3), suffix("ab" "d", 5)], 1)
    root, a, b = nodes[0], nodes[1], nodes[2]
    assert (root["n"], root["conv"], root["leaves"], root["saved"], root["ends"]) == (5, 3, 2, 4 + 4 + 2, "e9")
    assert (a["n"], a["children"], a["saved"]) == (3, 2, 4 + 2) and (b["n"], b["ends"]) == (2, "e4")
