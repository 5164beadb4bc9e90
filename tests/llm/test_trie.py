"""The prefix trie against dictionaries of prefixes."""

import hashlib
import math
import random
import zlib

import pytest

from signalwerk.llm import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows: list[tuple]) -> list[tuple]:
    own: dict = {}
    none_first = lambda x: (x is not None, x or 0)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (none_first(r[1]), r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    members: dict = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built = (*own.get(c - int(math.fmod(c, 100)), [])[:h], *turns[h:])
        for d in range(len(built) + 1):
            members.setdefault(built[:d], []).append((c, d == len(built)))
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = []

    def below(p):
        own_saved = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        parts = [below(q) for q in children[p]]
        leaves, saved = (sum(x[0] for x in parts) if parts else 1), own_saved + sum(x[1] for x in parts)
        ends = ",".join(map(str, sorted(c for c, end in members[p] if end)))
        up = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in members[p]), len(p), up, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        below(())
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_dictionaries(spark, seed):
    r = random.Random(seed)
    rows: list[tuple] = [(None, 0, "user", "of none"), (None, None, None, None)]
    for c in [*range(0, 130), 200, 201, 250, 355, -7, 10**12 + 3]:
        if c == 100:
            continue  # a group without its first conversation
        if seed == 2 and c % 3 == 0:  # a third of all conversations are the same
            rows += [(c, i, "user", "hot") for i in range(7)]
            continue
        for i in range(r.choice([1, 1, 2, 3, 4, 8, 30])):
            rows.append((c, r.choice([i, i, None, i - 1]), r.choice(["user", "assistant", None]), r.choice(["a", "ü😀", "", None, "long " * 50])))
    rows += rows[5:9]  # equal rows
    df = spark.createDataFrame([(*x, "extra", 1) for x in rows], "conv_id long, turn long, role string, text string, turns string, k1 int").repartition(4)
    for most_convs, most_turns in ((50_000, 500_000), (7, 500_000), (1, 1)):
        got = trie.nodes(df, most_convs=most_convs, most_turns=most_turns).select(*COLUMNS).collect()
        assert sorted(map(tuple, got), key=repr) == plain(rows), (most_convs, most_turns)


def test_empty_and_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.nodes(spark.createDataFrame([], schema)).collect() == []
    alone = [(c, 0, "user", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6 > 0]  # all without turns
    got = trie.nodes(spark.createDataFrame(alone, schema)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(alone) and len(got) == 1


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_importance_resampling", "op13_suffix_dedup"])
def test_same_as_sql(spark, duck, name):
    from signalwerk.llm import queries

    from ..conftest import SF

    got, want = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    shown = lambda rows: sorted(map(repr, rows))
    assert shown(tuple(r) for r in got.select(*sorted(got.columns)).collect()) == shown(tuple(r) for r in want.select(*sorted(want.columns)).fetchall())
