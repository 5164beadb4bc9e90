"""Each operator against brute force, a round trip or its library, and on odd tables."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalwerk.llm import chat, language, lines, minhash, packing, quality, queries, sentencepiece, sstable, vectors, warc, weighted
from signalwerk.llm.common import tokenizer_path
from signalwerk.llm.encoding import StretchEncoder
from signalwerk.operators import graph
from signalwerk.scratch import folder

from ..conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, node string, label string"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, columns whose names operators use inside."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, LONG, "en", None), (4, "one two three four five six", "de", "b"), (4, "one two three four five six", "de", "b"), (4, "another text with the same number", None, "b"), (None, "no number here at all my friend", "en", "c"), (5, "   \n\t\n", "en", "c"), (6, "\n".join(["same line of words"] * 50), "fr", "d")]
    return spark.createDataFrame([(i, t, a, s, 0, "u", "n", "l") for i, t, a, s in rows], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_lines_small(spark):
    rows = [(i, f"own {i}\nshared line\n", f"s{i % 4}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_id(lines.deduplicated(docs, min_sites=4))
    assert got[0]["text"] == "own 0\nshared line\n" and all(got[i]["text"] == f"own {i}\n" for i in range(1, 12))
    assert all(r["n_removed"] == 0 for r in lines.deduplicated(docs, min_sites=5).collect())


def test_lines_sql(spark, duck):
    got = queries.op1_line_dedup(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.execute(queries.ORACLE_SQL["op1_line_dedup"]).fetchdf().sort_values("doc_id").reset_index(drop=True)
    assert all((got[c] == want[c]).all() for c in want.columns)


def test_lines_odd(odd):
    got = lines.deduplicated(odd, min_sites=2)
    assert got.count() == 9 and set(odd.columns) <= set(got.columns)
    assert lines.deduplicated(odd.limit(0)).count() == 0


def test_quality(spark, odd):
    def brute(text):
        w = quality.WORD.findall(text or "")
        at = collections.defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        seen, dups = set(), 0
        for x in (text or "").split("\n"):
            if quality.WORD.search(x):
                dups += x in seen
                seen.add(x)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(covered)

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = collections.Counter((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    found = quality.judged(quality.ledger(docs)).collect()
    assert want == collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found)
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in found)
    assert quality.filtered(docs).count() == sum(r["kept"] for r in found)
    one = {r["rule"]: r for r in quality.ablations(quality.ledger(docs)).collect()}
    assert one["few_words"]["n_failed"] == sum(r["n_words"] < 10 for r in found)
    assert quality.filtered(odd).columns == odd.columns and quality.ledger(odd.limit(0)).count() == 0
    clash = odd.withColumn("n_words", F.lit("x")).withColumn("failed", F.lit(1)).withColumn("_rule_n_words", F.lit(1)).withColumn("row", F.lit(1))
    assert quality.filtered(clash).columns == clash.columns and quality.filtered(clash).count() == quality.filtered(odd).count()


@pytest.mark.parametrize("name", ["op3_quality_rules", "quality_ablations"])
def test_quality_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(queries.ORACLE_SQL[name]).fetchdf()
    key = want.columns[0]
    got, want = (x.sort_values(key).reset_index(drop=True)[sorted(want.columns)] for x in (got, want))
    assert len(got) == len(want) and all((got[c] == want[c]).all() for c in want.columns)


def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got) and all(0 <= r["score"] <= 1 for r in got)
    found = language.identified(odd).collect()
    assert len(found) == 9 and all(r["lang_pred"] == "und" for r in found if r["doc_id"] in (1, 2, 5))
    assert language.identified(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.identified(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_rejects_what_it_does_not_know(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    strange = ["W Szczebrzeszynie chrząszcz brzmi w trzcinie i Szczebrzeszyn z tego słynie, wół go pyta: panie chrząszczu, po co pan tak brzęczy w gąszczu", "今天天气很好我们一起去公园散步吧", "zxqj vvkq wpxz qqjx kzvw xjqz pfkw zzqv qxkj wvzq kjxq", "Πόσο μακριά είναι η θάλασσα από εδώ, ρώτησε ο ταξιδιώτης"]
    assert all(rejected and score < 0.6 for _, score, rejected in model.predict(strange))
    assert model.predict(["½ ² ①", "Ⅷ 12 _", "", "٣"]) == [("und", 0.0, True)] * 4
    found = language.identified(docs.filter("lang is not null and length(text) > 200"), model).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert found < 0.01
    # equal and null ids count once each for the bound of training rows
    same = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("en").alias("lang"))
    assert language.training_words(same, 300, 20_000, 19_200).agg(F.sum("n")).first()[0] == 600
    many = spark.range(3000).select("id", F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"), F.concat(F.lit("l"), F.col("id") % 100).alias("lang"))
    assert len(language.fit(many).langs) == 100  # none of a hundred languages is left out


def test_kneser_ney_sums_to_one():
    m = language.KneserNey(["ab", "abc", "ba"], np.array([3, 2, 1]))
    g, c, which = language.grams(["a" + x for x in "abcz"])
    first = np.array([0, 3, 6, 9]) + 1  # the letter after a
    p = [float(np.exp(m.word_scores([x[[i]] for x in g], [x[[i]] for x in c], np.zeros(1, int), 1))[0]) for i in first]
    g, c, which = language.grams(["a"])
    p.append(float(np.exp(m.word_scores([x[[1]] for x in g], [x[[1]] for x in c], np.zeros(1, int), 1))[0]))
    assert abs(sum(p) - 1) < 1e-9


def test_kneser_ney_is_brute_force():
    """Against dictionaries over the n-grams of words, for words seen and not."""
    words = {"abab": 3, "abc": 2, "bca": 1, "cab": 1, "abba": 2, "b": 4}
    n, pad = language.ORDER, "<" * (language.ORDER - 1)
    counts = [collections.Counter() for _ in range(n + 1)]
    for w, c in words.items():
        x = pad + w + ">"
        for i in range(n - 1, len(x)):
            for k in range(1, n + 1):
                counts[k][x[i - k + 1 : i + 1]] += c
    used = [None] + [collections.Counter(g[1:] for g in counts[k + 1]) for k in range(1, n)] + [counts[n]]
    letters = len(used[1]) + 1

    def p(context, letter):
        below = 1 / letters
        for k in range(1, n + 1):
            head = context[len(context) - k + 1 :] if k > 1 else ""
            own = {g: c for g, c in used[k].items() if g[:-1] == head}
            n1, n2 = (sum(v == i for v in used[k].values()) for i in (1, 2))
            d, total = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5, sum(own.values())
            below = max(own.get(head + letter, 0) - d, 0) / total + d * len(own) / total * below if total else below
        return below

    m = language.KneserNey(list(words), np.array(list(words.values())))
    for w in [*words, "aaa", "xyz", "abcab"]:
        x = pad + w + ">"
        want = sum(np.log(p(x[i - n + 1 : i], x[i])) for i in range(n - 1, len(x)))
        g, c, which = language.grams([w])
        assert abs(m.word_scores(g, c, which, 1)[0] - want) < 1e-9


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    rnd = random.Random(4)
    parts = ["a", "é", "ß", " ", "  ", "\n", "\t", " ", ".", ",", "'s", "1", "²", "<|endoftext|>", "İ", "Σ", "́", "!", "世", "😀", "\x0b", "\r\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = tokenizer_path(name)
        got, want = StretchEncoder(path).encode(texts), Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
        assert all(np.frombuffer(g, "<u4").tolist() == w.ids for g, w in zip(got, want, strict=True))


def test_sentencepiece_is_the_library(spark, odd):
    import sentencepiece as library

    path = tokenizer_path("piece_bpe_32k.model")
    merge = library.SentencePieceProcessor(model_file=path)
    rnd = random.Random(5)
    parts = ["a", "th", "er", "in", " ", "  ", "\n", "é", "1", ".", "世", "😀", "the", "ing", "▁", "aa", "==", "    "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25))) for _ in range(600)]
    for kind in ("merge", "unigram"):
        m = sentencepiece.Model(path, kind)
        weight = lambda ids: sum(m.score.get(m.pieces[i], m.missing_score if i not in m.byte_of else 0) for i in ids)  # noqa: B023, E731
        for x in texts:
            ids = np.frombuffer(m.encode(x), "<u4").tolist()
            if kind == "merge":
                assert ids == merge.encode(x)
            else:  # brute force; the library adds in single precision, which runs of spaces (score -1e9) exhaust
                t, best = m.normal(x), [0.0]
                for end in range(1, len(t) + 1):
                    best.append(max(best[k] + m.score.get(t[k:end], m.missing_score if end - k == 1 else float("-inf")) for k in range(max(0, end - m.longest), end)))
                missing = sum(m.missing_score for c in t if c not in m.score)
                assert abs(weight(ids) + missing - best[-1]) < 1e-3
            t, size = m.normal(x), rnd.choice([3, 5, 9])
            cut = [sentencepiece.Chunk(m, t[max(0, k - 64) : min(len(t), k + size) + 64], k - max(0, k - 64), min(len(t), k + size) - max(0, k - 64)) for k in range(0, len(t), size)]
            raw = b"".join(c.ids(a, b) for c, (a, b) in zip(cut, sentencepiece.chosen([c.matrix() for c in cut]), strict=True))
            got = np.frombuffer(raw, "<u4").tolist()
            assert got == ids if kind == "merge" else abs(weight(got) - weight(ids)) < 1e-3
    want = collections.Counter((r["doc_id"], len(i := merge.encode(r["text"] or "")), zlib.crc32(np.array(i, "<u4").tobytes()), True) for r in odd.collect())
    assert want == collections.Counter(tuple(r) for r in sentencepiece.encoded(odd, chunk=5000).collect())
    # two levels of the tree: more than FAN chunks
    assert want == collections.Counter(tuple(r) for r in sentencepiece.encoded(odd, chunk=1500).collect()) and len(LONG) > 1500 * sentencepiece.FAN
    assert sentencepiece.encoded(odd.limit(0)).count() == 0
    texts = spark.createDataFrame([(i, x) for i, x in enumerate(texts)] + [(None, None)], "doc_id long, text string").filter("not contains(text, '▁') or text is null")
    back = sentencepiece.decoded(sentencepiece.token_ids(texts)).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in back) == collections.Counter((r["doc_id"], r["text"] or "") for r in texts.collect())
    for n in (0, 1, 7, 5000):
        x, y = b"abc" * 9, bytes(range(256)) * 20
        assert sentencepiece.crc32_combine(zlib.crc32(x), zlib.crc32(y[:n]), n) == zlib.crc32(x + y[:n])
    a, b, c = (np.random.default_rng(i).normal(size=(3, 3)) for i in range(3))
    assert np.allclose(sentencepiece.product(sentencepiece.product(a, b), c), sentencepiece.product(a, sentencepiece.product(b, c)))


def test_sentencepiece_tries_few_pieces():
    """A place of a word that has its state is not tried again; the pieces are those that plain merging leaves."""
    m, rnd, tried = sentencepiece.Model(tokenizer_path("piece_bpe_32k.model")), random.Random(8), 0
    pieces = sorted(p for p in m.usable if len(p) > 1 and p.isalpha())
    words = ["▁" + "".join(rnd.choice(pieces)[: rnd.randint(1, 4)] for _ in range(4)) for _ in range(1000)] + ["", "a", "▁", "▁▁▁▁", "==", "世界"]
    compatible = m.compatible

    def counted(before, piece):
        nonlocal tried
        tried += 1
        return compatible(before, piece)

    m.compatible = counted
    assert [m.only_way(w) for w in words] == [m.merged(w) for w in words]
    assert tried < 1.2 * sum(map(len, words))


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 16))
    v = np.concatenate([base, base[:40] + 0.15 * rng.normal(size=(40, 16)), np.tile(base[0], (30, 1))])
    rows = [(i, x.tolist(), "x") for i, x in enumerate(v)] + [(900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"), (903, [1.0], "x"), (None, base[1].tolist(), "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, uid string")
    got = by_id(vectors.near_duplicates(df), "vec_id")
    assert len(got) == 195
    u = np.float32(np.concatenate([v, base[1:2]])).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    found = sum(got[i]["n_links"] for i in range(190))
    assert 0.9 * linked[:190].sum() <= found <= linked[:190].sum() and all(got[i]["n_links"] <= linked[i].sum() for i in range(190))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in (900, 901, 902, 903))
    assert all(got[160 + i]["component_id"] == got[0]["component_id"] for i in range(30)) and got[None]["component_id"] == got[1]["component_id"]
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_many_lists(spark):
    """Both levels of centers, probing, recall against all pairs, two lengths, repeated ids."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(2500, 64))
    near = base[rng.integers(0, 2500, 1500)] + rng.uniform(0.05, 0.4, (1500, 1)) * rng.normal(size=(1500, 64))
    v = np.float32(np.concatenate([base, near]))
    short = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [-1.0, 0.0, 0.5]]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(5000 + i, x) for i, x in enumerate(short)] + [(5000, short[0])]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), sample=320, per_list=32).collect()
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    links = {r["vec_id"]: r["n_links"] for r in got if r["vec_id"] < 5000}
    assert len(got) == len(rows) and all(links[i] <= linked[i].sum() for i in links)
    found = sum(links.values())
    assert 0.97 * linked.sum() <= found <= linked.sum() and linked.sum() > 2000
    index = vectors.train(u[:320], 4000, 0.9, 32, 8)
    assert len(index.coarse) == 20 and len(index.fine) == 7 and index.probes != (1, 1)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] >= 5000) == [(5000, 2, 5000), (5000, 2, 5000), (5001, 2, 5000), (5002, 0, 5002)]


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(60) if i % 13] + [(rnd.randint(100, 140), rnd.randint(100, 140)) for _ in range(25)] + [(200, 200 + i) for i in range(1, 80)]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()} == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc(spark):
    rnd = random.Random(6)
    pages = [(1, "http://a/\r\nX-Page: 9", "<p>ü\r\n\r\n</p>" * 50), (2, None, None), (3, "u", ""), (4, "u", "0\r\n\r\nWARC/1.1\r\n"), (5, "v", "<p>ü\r\n\r\n</p>" * 50), (None, "w", "<p>ü\r\n\r\n</p>" * 50), (6, "w", "x\r"), (7, "w", "".join(rnd.choice("a\r\n😀") for _ in range(999))), (8, "w", "x\r"), (8, "w", "x\r")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, body string")
    first = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(h or "", i)
    want = collections.Counter()
    for i, _, h in pages:
        raw, own = (h or "").encode(), first[h or ""]
        want[i, len(raw), warc.base32_sha1(hashlib.sha1(raw).digest()), "response" if own == i else "revisit", None if own == i else own] += 1
    for size in (3, 7, 1 << 18):
        got = warc.archive(df, size=size).collect()
        assert collections.Counter(tuple(r)[:5] for r in got) == want
        page = {r["record_id"]: r["page_id"] for r in got}
        assert all(page[r["target"]] == r["refers_to"] for r in got if r["record_type"] == "revisit")  # ids resolve
    # with partitions kept apart, a record's chunks still lie together
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for most in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            assert collections.Counter(tuple(r)[:5] for r in warc.archive(df, size=3).collect()) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    long = spark.createDataFrame([(1, "u", "x" * 700_000 + "é"), (2, "u", "x" * 700_000 + "é")], "page_id long, url string, html string")
    assert [(r["payload_bytes"], r["record_type"]) for r in warc.archive(long).orderBy("page_id").collect()] == [(700_002, "response"), (700_002, "revisit")]
    assert warc.archive(df.limit(0)).count() == 0


def test_weighted_jaccard_and_samples():
    w = weighted.Weigher({})
    a, b = w.shingles("a b c d e f g h i j k l m n o p q r s t"), w.shingles("a b c d e f g h i j k l m n o p q r s x")
    assert abs(weighted.similarities([a, b])[0, 1] - 15 / 17) < 1e-9
    rep = w.shingles("x x x x x x x")
    assert rep[2].tolist() == [3] and abs(weighted.similarities([rep, rep])[0, 1] - 1) < 1e-9
    s = weighted.Sampler(400).samples(np.concatenate([a[0], b[0]]), np.concatenate([a[1] * a[2], b[1] * b[2]]), np.array([0, len(a[0])]))
    assert abs((s[0] == s[1]).mean() - 15 / 17) < 0.08


def near_group(n, seed=7):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(i % 5):
            t[rnd.randrange(150)] = f"edit{rnd.randint(0, 10**6)}"
        out.append(" ".join(t))
    return out


def test_minhash_keeps_the_df_of_all_words(spark):
    words = [f"w{i}" for i in range(53)]
    rnd = random.Random(4)
    texts = [" ".join([*words[:26], x, *words[27:]]) for x in ("left", "right")] + [" ".join(rnd.sample(words, 53)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # 44 shingles of weight 1 in common, five of weight 1.2 on each side: 0.786, but 0.815 if all words weighed the same
    for most in (8, 65_536):
        assert [r["class_id"] for r in minhash.classes(docs, words=most).orderBy("doc_id").collect()] == list(range(42))


def test_minhash_is_all_pairs(spark, odd):
    rnd = random.Random(8)
    texts = near_group(70) + [" ".join(f"r{rnd.randint(0, 3000)}" for _ in range(80)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    shared = minhash.word_weights(docs, 65_536)
    w = weighted.Weigher(dict(zip(*(x.tolist() for x in shared), strict=True)))
    label = weighted.grouped(weighted.similarities([w.shingles(t) for t in texts]) >= 0.8)
    for rows in (512, 16):  # one block, or many
        got = by_id(minhash.classes(docs, block_rows=rows))
        assert [got[i]["class_id"] for i in range(len(texts))] == label.tolist()
        assert [got[i]["kept"] for i in range(len(texts))] == [label[i] == i for i in range(len(texts))]
    found = minhash.classes(odd).collect()
    assert len(found) == 9 and sum(r["kept"] for r in found) == 6  # two different texts have number 4
    kept = minhash.distinct_documents(odd)
    assert kept.count() == 6 and kept.columns == odd.columns and minhash.classes(odd.limit(0)).count() == 0


def best_bins(sizes, capacity):
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rnd = random.Random(9)
    for _ in range(60):
        sizes = sorted((rnd.randint(1, 20) for _ in range(rnd.randint(1, 9))), reverse=True)
        made = packing.plan(dict(collections.Counter(sizes)), 20)
        assert collections.Counter(x for t, n in made for x in t * n) == collections.Counter(sizes) and all(sum(t) <= 20 for t, _ in made)
        assert packing.lower_bound(dict(collections.Counter(sizes)), 20) <= sum(n for _, n in made) == best_bins(sizes, 20)


def test_bin_completion_is_not_cut():
    for counts, capacity in (({54: 1, 51: 1, 95: 1, 76: 1, 59: 1, 65: 1, 46: 1, 68: 1, 86: 1}, 200), ({23: 1, 35: 1, 42: 1, 48: 1, 15: 1, 37: 1, 25: 2, 50: 1}, 100)):
        assert sum(n for _, n in packing.plan(counts, capacity)) == packing.lower_bound(counts, capacity) == 3
    assert sum(n for _, n in packing.plan({1: 5000}, 2048)) == 3  # many pieces in a filling
    # every filling that no other is as good as is tried, each once, twice or three times
    counts = {20: 3, 9: 3, 7: 4, 5: 4, 4: 3, 3: 5}
    at = packing.Search(counts, 40)
    got = {o for o in at.options() if o}
    rooms = {t for k in range(7) for t in itertools.combinations_with_replacement(sorted(counts, reverse=True), k) if sum(t) <= 20 and all(t.count(x) <= counts[x] - (x == 20) for x in t)}
    undominated = {t for t in rooms if not at.dominated(20, t, 20 - sum(t))}
    assert {o[0][1:] for o in got} == undominated and {n for t, n in got if t == (20, 9, 7, 4)} == {3, 1}


def test_packing(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = packing.pack(odd).collect()
    want = collections.Counter()
    for r in odd.collect():
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[r["doc_id"], k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in places.values():
        end = 0
        for offset, n in sorted(v):
            assert offset == end
            end += n
        assert end <= 2048
    assert packing.pack(odd.limit(0)).count() == 0


def test_chat(spark):
    t = chat.DEFAULT
    rnd = random.Random(10)
    for _ in range(2000):
        x = "".join(rnd.choice(["</s>", "[INST]", "\\", "<", "s>", "<|text|>", "a", "<|over|", ">", "\n"]) for _ in range(rnd.randint(0, 8)))
        assert t.plain(t.escaped(x)) == x and not any(c in t.escaped(x) for c in t.control)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok"), (1, 1, "assistant", "</s>[INST] ok"), (2, None, None, None), (None, 0, "user", ""), (3, 0, "<|turn|>", "x")] + [(4, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = by_id(chat.formatted(df), "conv_id")
    for c in (1, 2, None, 3, 4):
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        said = "".join(x for role, x in own if role == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(said) and got[c]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[1]["faults"] == 1 and got[4]["faults"] == 0
    assert chat.formatted(df.limit(0)).count() == 0


def test_token_shards(spark, odd):
    from tokenizers import Tokenizer

    t, path = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), folder(spark, "shards")
    rows = sstable.token_shards(odd, path, range_chars=500, shard_ids=20).collect()
    ids = [(r["doc_id"], [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in odd.collect()]
    assert collections.Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids) == collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at and (last is None or r["doc_id"] >= last)
        at, last = at + r["n_tokens"], r["doc_id"]
    found = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in sstable.lookup(spark, path, [4, None, 77]).collect())
    assert found == collections.Counter((d, tuple(i)) for d, i in ids if d in (4, None))
    assert sstable.token_shards(odd.limit(0)).count() == 0


def test_token_shards_in_number_order(spark):
    """Ranges 0 to 11, whose names sort as 0, 1, 10, 11, 2; one doc_id that a third of all rows have; lookups open what they need."""
    docs = spark.range(900).selectExpr("if(id % 3 = 0, 300, id) as doc_id", "concat('text number ', id, repeat(' word', 40)) as text")
    path = folder(spark, "shards")
    rows = sorted(sstable.token_shards(docs, path, range_chars=17_000, shard_ids=1000).collect(), key=lambda r: r["start"])
    told = sstable.manifest(spark, path).collect()
    assert len(rows) == 900 and len({r["range_no"] for r in told}) > 11 and sum(r["docs"] for r in told) == 900
    at = 0
    for a, b in zip(rows, rows[1:] + [None], strict=True):
        assert a["start"] == at and (b is None or a["doc_id"] <= b["doc_id"])
        at += a["n_tokens"]
    opened = sstable.candidates(spark, path, [7, 5000])
    assert len(opened) == 1 < len(told) and sstable.lookup(spark, path, [7]).count() == 1 and sstable.lookup(spark, path, [5000]).count() == 0
    assert len({r["range_no"] for r in told if r["first_id"] == r["last_id"] == 300}) > 1  # a hot doc_id is split
    assert sstable.lookup(spark, path, [300]).count() == 300


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and 0 < out.count() <= docs.count(), name
    placed = corpus_pipeline.run(spark, SF)
    kept = {r["doc_id"] for r in placed.collect()}
    want = quality.filtered(docs)
    assert kept and kept <= {r["doc_id"] for r in want.collect()}


def test_pipeline_on_odd_tables(spark, odd):
    """Each stage on nulls, empty and long texts, repeated rows, clashing names and on an empty table."""
    import corpus_pipeline

    more = odd.withColumn("row", F.lit(1)).withColumn("failed", F.lit("x")).withColumn("n_words", F.lit(None).cast("string"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found, none = stage(spark, more, SF), stage(spark, more.limit(0), SF)
        assert none.count() == 0, name
        kept[name] = found.count()
        if name != "best_fit_packing":
            assert found.columns == more.columns, name
    assert kept["line_dedup"] == 9 and kept["minhash_near_dedup"] == 6 and kept["best_fit_packing"] > 9
    assert kept["language_id"] <= 6 and kept["quality_rules"] <= 2  # texts without letters; texts of less than ten words


def test_a_hot_key_is_dealt_over_parts(spark):
    from signalwerk.llm.common import dealt_join

    rows = spark.range(6000).selectExpr("id", "if(id % 2 = 0, 7, id) as k")
    one = rows.groupBy("k").agg(F.count("*").alias("n_rows"), F.min("id").alias("least"))
    found = dealt_join(rows, one, "k", "id", 6000, salts=8)
    assert found.columns == ["k", "id", "least"] and found.count() == 6000 and found.filter("k = 7").select("least").distinct().collect() == [(0,)]
    assert dealt_join(rows.limit(0), one.limit(0), "k", "id", 0).count() == 0


def test_clashing_names(spark):
    """Columns named like those that operators add inside."""
    rows = [(i, "\n".join(["the same long line of many words in all of these texts", f"own words {i} " * 3]), "en", f"s{i}", 0, 0, 0, 0, 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, gone long, n_lines long, _doc long, _hash long, _n_words long")
    got = lines.deduplicated(docs, min_sites=10)
    assert sorted(got.columns) == sorted({*docs.columns, "n_removed"}) and got.filter("n_removed = 1").count() == 11
    assert minhash.distinct_documents(docs).columns == docs.columns
    assert quality.filtered(docs).columns == docs.columns


INNER = "row loses one new failed gone first line lines site n_rows h1 h2 text_key line_no bucket node class head heads label component samples words dfs rest uid _salt _hot _text _0 _1 rejected lang_pred score held_out n_words base_failed kept piece start length sequence_id offset".split()


def test_every_inner_name_may_be_a_column(spark):
    import corpus_pipeline

    text = "\n".join(["the same long line of many words in all of these texts and more of it", "own words of this text and not of any other one in the table"])
    docs = spark.createDataFrame([(i, f"{text} {i}", "en", f"s{i}", 9) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    wide = docs.select("*", *[F.lit(7).alias(c) for c in INNER])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, SF)
        assert found.columns == wide.columns, name
        assert found.filter("`row` <> 7 or `line` <> 7 or `_0` <> 7 or `first` <> 7").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() == 12
    assert lines.deduplicated(wide, min_sites=10).filter("n_removed = 1").count() == 11


def test_no_language_is_left_out(spark):
    rows = [(i, f"wort{i % 90}a wort{i % 90}b " * 20, f"l{i % 90:02}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = language.training_words(docs, 300, 20_000, 180)
    assert table.select("lang").distinct().count() == 90
    assert table.groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 160").count() == 0  # two documents, in which digits part 40 words into 80
    with pytest.raises(ValueError):
        language.training_words(docs, 300, 20_000, 89)
