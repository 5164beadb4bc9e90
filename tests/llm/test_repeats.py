"""Suffix-array dedup against plain loops over all strings."""

import hashlib
import random
from collections import Counter

import numpy as np

from signalwerk.llm import repeats
from signalwerk.llm.intervals import repeated
from signalwerk.llm.queries import QUERIES


def plain(texts: list[bytes], weights: list[int], least: int) -> list[list[tuple[int, int]]]:
    counts: Counter = Counter()
    for t, w in zip(texts, weights, strict=True):
        for i in range(len(t) - least + 1):
            counts[t[i : i + least]] += w
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if counts[t[i : i + least]] > 1:
                hit[i : i + least] = b"\1" * least
        edges = [i for i in range(len(t) + 1) if (i < len(t) and hit[i]) != (i > 0 and bool(hit[i - 1]))]
        out.append(list(zip(edges[::2], edges[1::2], strict=True)))
    return out


def test_intervals_against_all_strings():
    r = random.Random(1)
    for _ in range(150):
        least, letters = r.choice([3, 5, 8, 9, 12, 17, 20, 40]), r.choice([b"a", b"ab", b"abcd", bytes(range(97, 123)), b"\0\1"])
        base = bytes(r.choice(letters) for _ in range(120))
        texts = []
        for _ in range(r.randint(1, 8)):
            t = b""
            for _ in range(r.randint(1, 4)):
                a = r.randint(0, 100)
                t += base[a : a + r.randint(1, 60)] if r.random() < 0.5 else bytes(r.choice(letters) for _ in range(r.randint(1, 30)))
            texts.append(t)
        weights = [r.choice([1, 1, 1, 2]) for _ in texts]
        assert repeated(texts, np.array(weights), least) == plain(texts, weights, least)


def test_repeats_in_documents_and_large_groups(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages, hot = [say(30) for _ in range(6)], say(12)
    docs: list[tuple] = []
    for i in range(300):
        x, t = r.random(), say(r.randint(1, 60))
        if x < 0.4:
            t += hot + say(3)
        elif x < 0.6:
            t = say(5) + r.choice(passages) + say(5) + r.choice(passages)[: r.randint(5, 90)]
        elif x < 0.65:
            t = "ab" * r.randint(10, 200)  # repeats only in itself
        elif x < 0.7:
            t = "üéß " * r.randint(3, 20) + t
        docs.append((i, t))
    docs += [(None, None), (None, ""), (500, docs[0][1]), (1, docs[1][1]), (None, docs[2][1])]
    texts = [(t or "").encode() for _, t in docs]
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, grp string, n int").repartition(3)
    for least, block in ((40, 10**6), (40, 3000), (16, 3000)):
        want = []
        for (d, _), t, spans in zip(docs, texts, plain(texts, [1] * len(texts), least), strict=True):
            kept = b"".join(t[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(t)], strict=True))
            want.append((d is None, d or 0, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        got = [(x.doc_id is None, x.doc_id or 0, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.without_repeats(rows, least, block).collect()]
        assert sorted(got) == sorted(want), (least, block)
    assert repeats.without_repeats(rows.limit(0)).collect() == []


def test_long_texts_are_cut_without_loss():
    r = np.random.default_rng(2)
    one = r.integers(97, 123, 300_000).astype(np.uint8)
    data = np.concatenate((one, one[100_000:200_000], np.full(700, 97, np.uint8)))
    start, n, group, again = repeats.segments(data, np.array([len(one), len(one) + 100_000, len(data)]), 400)
    assert n.sum() == sum(x - 399 for x in (300_000, 100_000, 700))
    of = np.repeat(group, n)
    at = np.concatenate([np.arange(a, a + k) for a, k in zip(start, n, strict=True)])
    by_place = dict(zip(at.tolist(), of.tolist(), strict=True))
    assert all(by_place[100_000 + i] == by_place[300_000 + i] for i in range(100_000 - 399))
    assert again[-1]


def test_large_groups_do_not_move_texts_again(spark):
    """Whether or not a group is too large for a block, texts are read twice: for their segments and for the bytes of those that are in groups."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    passage = " ".join(word() for _ in range(12))
    rows = [(i, f"{' '.join(word() for _ in range(20))} {passage if i % 3 else ''} {' '.join(word() for _ in range(20))}") for i in range(300)]
    texts = repeats.keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).selectExpr("k1", "k2", "1L AS weight", "text")
    want = plain([t.encode() for _, t in rows], [1] * len(rows), 40)
    for block in (10**6, 3000):
        read = spark.sparkContext.accumulator(0)

        def counted(batches, read=read):
            for b in batches:
                read.add(b.num_rows)
                yield b

        assert repeats.covered(texts.mapInArrow(counted, texts.schema), 40, block).count() == sum(map(bool, want)) == 200
        assert read.value == 2 * len(rows), block


def test_planted_passages_go_from_400_bytes_on_and_clean_documents_stay(spark, tmp_path):
    """Passages of over 50 words, each in two documents with other bytes on either side; n_bytes is the whole text's length whatever goes."""
    r = random.Random(5)
    say = lambda n, letters="abcdefghij": " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))
    texts, gone = [], []
    for size in (360, 399, 400, 401, 900):
        for letters in ("abcdefghij", "abcdeéßü"):
            passage = say(200, letters).encode()[:size].decode(errors="ignore")
            passage += "x" * (size - len(passage.encode()))
            assert len(passage.split()) > 50
            for a, b in ("<>", "[]"):
                texts.append((say(70), f"{a}{passage}{b}", say(70)))
                gone.append(size if size >= 400 else 0)
    texts += [(say(150), "", "") for _ in range(20)]
    gone += [0] * 20
    spark.createDataFrame([(i, "".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).collect()
    assert sorted(x.doc_id for x in found) == list(range(len(texts)))
    for x in found:
        (before, passage, after), n = texts[x.doc_id], gone[x.doc_id]
        kept = (before + passage[0] + passage[-1] + after if n else before + passage + after).encode()
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == (len((before + passage + after).encode()), n, int(n > 0), hashlib.sha256(kept).hexdigest()), x.doc_id
