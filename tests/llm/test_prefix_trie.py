import hashlib
import random
import re
import zlib

import pytest

from strata.llm.oracles import ORACLES
from strata.llm.prefix_trie import (
    NODES, STEP, common_turns, conversations_of, prefix_trie, skeleton_of, with_shared_heads,
)
from strata.llm.queries import op13_prefix_trie
from tests.oracle import differences, duck

SCHEMA = "conv_id long, turn long, role string, text string, words long, digest string"


def brute_force(rows, shared=True):
    """Nodes of the trie of (conv_id, turn, role, text) rows whose turn numbers differ."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0))] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if shared else 0
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        saved[path] = sum(saved[k] for k in below) + (len(members[path]) - 1) * words
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    return sorted((tuple(r) for r in df.select(*NODES.fieldNames()).collect()))


def test_query_equals_oracle(spark, sf_dir):
    assert differences(op13_prefix_trie, ORACLES["op13_prefix_trie"], spark, duck(sf_dir), sf_dir) == []


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_copies_and_long_paths_over_any_number_of_shards(spark, shards):
    """A third of all conversations are copies, others are prefixes of each other or long."""
    r = random.Random(5)
    rows = []
    for c in range(400):
        if c % 3 == 0:
            turns = [("user", "same start"), ("assistant", "same end of two")]
        elif c % 7 == 0:
            turns = [("user", "same start")] + [("user", f"turn {i}") for i in range(r.randrange(60))]
        else:
            turns = [("user", r.choice("abc") * r.randrange(1, 3)) for _ in range(r.randrange(1, 7))]
        rows += [(c, t, role, text, 1, "x") for t, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    trie = prefix_trie(with_shared_heads(conversations_of(spark.createDataFrame(rows, SCHEMA))), shards)
    assert found(trie) == brute_force([x[:4] for x in rows])


def test_odd_rows(spark):
    long_text = "word " * 300_000
    rows = [
        (20, None, None, None, None, None), (20, 1, "user", "", None, None), (20, -1, "", None, 2, None),
        (21, 5, "user", "only turn", None, None), (22, 0, "user", long_text, None, None),
        (None, 0, "user", "nobody", None, None), (63, 0, "user", "base is absent", None, None),
        (-3, 0, "user", "negative id", None, None), (40, 0, "us", "erhello", None, None),
        (41, 0, "user", "hello", None, None), (9_000_000_000_000_000_001, 0, "user", "hello", None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    plain = [x[:4] for x in rows]
    assert found(prefix_trie(conversations_of(frame))) == brute_force(plain, shared=False)
    positive = [x for x in plain if x[0] is None or x[0] >= 0]
    kept = frame.where("conv_id is null or conv_id >= 0")
    assert found(prefix_trie(with_shared_heads(conversations_of(kept)), 3)) == brute_force(positive)


def test_repeated_rows_are_repeated_turns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a b", None, None)] * 3, SCHEMA)
    got = [(r["depth"], r["n_convs"]) for r in prefix_trie(conversations_of(frame)).orderBy("depth").collect()]
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1)]


def test_empty_table(spark):
    empty = prefix_trie(with_shared_heads(conversations_of(spark.createDataFrame([], SCHEMA))))
    assert empty.collect() == [] and empty.schema == NODES


def test_nodes_in_two_shards_are_in_the_skeleton():
    r = random.Random(1)
    paths = sorted(
        (b"".join(bytes([r.randrange(3)]) * STEP for _ in range(r.randrange(6))), i) for i in range(500)
    )
    skeleton = skeleton_of([(*p, True) for p in r.sample(paths, 100)], 16)
    shards = {}
    for path, conv in paths:
        node, known = 0, True
        for d in range(len(path) // STEP + 1):
            prefix = path[: d * STEP]
            if d:
                node = skeleton.child.get((node, prefix[-STEP:]), -1) if known else -1
                known = node >= 0
            shards.setdefault((prefix, known), set()).add(skeleton.shard(path, conv))
    assert len({s for (_, _), x in shards.items() for s in x}) > 8
    assert all(known or len(s) == 1 for (_, known), s in shards.items())


def test_skeleton_is_bounded():
    sample = [(bytes([i]) * STEP * 50, i, True) for i in range(100)]
    same = [(b"a" * STEP * 50, i, True) for i in range(100)]
    assert len(skeleton_of(sample, 40).parent) == 40
    assert len(skeleton_of(same, 40).splitters) == 39
    assert len(skeleton_of(same, 40, most=20).parent) <= 20
    assert common_turns(b"a" * 32 + b"b" * 16, b"a" * 32 + b"c" * 16) == 2
