"""Importance resampling against plain counts over whole texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from signalwerk.llm import importance


def features(text: str | None, longest: int) -> list[str]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


def plain(docs: list, target: list, longest: int, buckets: int, percent: int, least: int) -> list[tuple]:
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest)[0])
    goal = Counter(bucket(f) for t in target for f in features(t, longest)[0])
    n_s, n_t = s.total(), goal.total()
    rows = []
    for doc_id, text in docs:
        found, n_words = features(text, longest)
        gain = [math.floor(1000 * math.log((goal[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n_words])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = i + 1
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_against_whole_texts(spark, longest):
    r = random.Random(longest)
    words = ["Alpha", "beta", "x1", "Ünder", "straße", "ÄÖ", "7", "the"]
    line = lambda: r.choice([" ", ", ", "\t"]).join(r.choice(words) for _ in range(r.randint(0, 6)))
    shared = [line() for _ in range(8)]
    docs = [(i, "\n".join(r.choice([line(), r.choice(shared), "", "-"]) for _ in range(r.randint(0, 9)))) for i in range(150)]
    docs += [(None, None), (None, ""), (150, None), (3, docs[3][1]), (3, docs[3][1]), (151, "one\ntwo\r\nthree\n\n\nfour"), (152, "a" * 70_000), (153, "\n".join(["hot line here"] * 3000))]
    target = [line() + "\n" + line() for _ in range(30)] + [None, ""]
    rows = spark.createDataFrame([(d, t, 5, "x") for d, t in docs], "doc_id long, text string, n int, line string").repartition(3)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, n_rows int")
    got = importance.resampled(rows, goal, longest, 50, 30, 5).select("doc_id", "n_features", "weight", "score", "rank", "n_words").collect()
    want = plain(docs, target, longest, 50, 30, 5)
    # rows that are there twice may change places
    assert sorted(repr(tuple(x)) for x in got) == want
    assert importance.resampled(rows.limit(0), goal, longest).collect() == []
    assert len(importance.resampled(rows, goal.limit(0), longest).collect()) == len(docs)
