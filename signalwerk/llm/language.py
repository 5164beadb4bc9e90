"""Language identification with interpolated Kneser-Ney character models.

A model's n-grams run over single words with edge marks, so a word's log-probability depends on the word alone and each distinct word
is scored once per batch. Probabilities and back-off weights lie in arrays sorted by n-gram hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_or_empty

ORDER = 5
START, END = 2, 3
#: Runs of letters, general category L: word characters but digits, the low line and other numbers such as fractions and Roman numerals.
NUMBERS = "".join(chr(c) for c in range(0x20000) if chr(c).isnumeric() and not chr(c).isdecimal() and not chr(c).isalpha())
LETTERS = re.compile(rf"[^\W\d_{re.escape(NUMBERS)}]+")
#: The same but for other numbers, and several times faster; isalpha() tells the runs that have any.
NEARLY_LETTERS = re.compile(r"[^\W\d_]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def laid_out(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' code points, each word after ORDER - 1 start marks and before an end mark; the places to predict; the word of each place."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    points = np.full(int(n.sum()) + ORDER * len(words), START, np.uint64)
    ends = np.cumsum(n + ORDER)
    points[ends - 1] = END
    which = np.repeat(np.arange(len(words)), n + 1)
    places = np.arange(len(which)) + (ORDER - 1) * (which + 1)
    letters = places[points[places] != END]
    points[letters] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, places, which


def hashes(points: np.ndarray, places: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each place, for n = 1 to most."""
    h, out = np.zeros(len(places), np.uint64), []
    with np.errstate(over="ignore"):
        for k in range(most):
            h = h + mixed((points[places - k] + np.uint64(1)) * (_M1 + np.uint64(2 * k)))  # a sum over letter and distance
            out.append(mixed(h * _M1 + np.uint64(k)))
    return out


def grams(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """At each letter and end mark: hashes of the n-grams up to it, of those just before it, and the word it belongs to."""
    points, places, which = laid_out(words)
    return hashes(points, places, ORDER), hashes(points, places - 1, ORDER - 1), which


class KneserNey:
    """One language's model, from its words and their counts."""

    def __init__(self, words: list[str], counts: np.ndarray):
        g, c, which = grams(words)
        weight = counts[which].astype(np.float64)
        self.size = len(np.unique(g[0])) + 1
        self.keys: list[np.ndarray] = []
        self.alpha: list[np.ndarray] = []
        self.context_keys: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.back: list[np.ndarray] = []
        for k in range(ORDER):
            keys, first, where = np.unique(g[k], return_index=True, return_inverse=True)
            if k == ORDER - 1:
                n = np.bincount(where.reshape(-1), weight, len(keys))
            else:  # how many different letters come before the n-gram
                longer = np.unique(g[k + 1], return_index=True)[1]
                n = np.bincount(where.reshape(-1)[longer], minlength=len(keys)).astype(np.float64)
            n1, n2 = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            if k:
                ctx, at = np.unique(c[k - 1][first], return_inverse=True)
            else:
                ctx, at = np.zeros(1, np.uint64), np.zeros(len(keys), np.int64)
            at = at.reshape(-1)
            total, kinds = np.bincount(at, n, len(ctx)), np.bincount(at, minlength=len(ctx))
            self.keys.append(keys)
            self.alpha.append(np.maximum(n - d, 0) / total[at])
            self.back.append(d * kinds / total)
            if k:
                self.context_keys.append(ctx)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return at, keys[at] == wanted

    def word_scores(self, g: list[np.ndarray], c: list[np.ndarray], which: np.ndarray, n: int) -> np.ndarray:
        """Log-probability of each of n words, from grams()."""
        return self.scored(distinct(g), distinct(c), which, n)

    def scored(self, g: list, c: list, which: np.ndarray, n: int) -> np.ndarray:
        """word_scores() from distinct() n-grams: sorted keys are found fast, and several models can share them."""
        p = self.back[0][0] / self.size
        for k in range(ORDER):
            at, seen = self._find(self.keys[k], g[k][0])
            p = p if not k else self._weights(k, *c[k - 1]) * p
            p = np.where(seen, self.alpha[k][at], 0)[g[k][1]] + p
        return np.bincount(which, np.log(p), n)

    def _weights(self, k: int, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        at, known = self._find(self.context_keys[k], keys)
        return np.where(known, self.back[k][at], 1.0)[places]


def distinct(hashed: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted different hashes of each list, and where in them each hash lies."""
    return [(keys, places.reshape(-1)) for keys, places in (np.unique(h, return_inverse=True) for h in hashed)]


class Classifier:
    """Models by language, the softmax's sharpness and each language's rejection threshold, both from words that no model has learned."""

    def __init__(self, langs: list[str], models: list[KneserNey], sharpness: float = 10.0, limits: np.ndarray | None = None):
        self.langs, self.models, self.sharpness = langs, models, sharpness
        self.limits = np.full((len(langs), STEPS), np.inf) if limits is None else limits
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(langs) + 1))

    def rows(self, words: list[str]) -> np.ndarray:
        """For each word, its log-probability in each language and its length with the end mark."""
        g, c, which = grams(words)
        g, c = distinct(g), distinct(c)
        return np.column_stack([*(m.scored(g, c, which, len(words)) for m in self.models), np.fromiter(map(len, words), np.float64, len(words)) + 1])

    def entropies(self, texts: list[str], limit: int = 250_000) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a letter of each text in each language, nan where a text has no letters; letters and words of each."""
        parts = [NEARLY_LETTERS.findall(x.lower()) for x in texts]
        if len(self.known) > limit:
            self.known, self.table = {}, self.table[:0]
        distinct: set[str] = set()
        distinct.update(*parts)
        new = [w for w in distinct if w not in self.known]
        if odd := {w for w in new if not w.isalpha()}:
            parts = [p if odd.isdisjoint(p) else LETTERS.findall(x.lower()) for p, x in zip(parts, texts, strict=True)]
            new = [w for w in distinct.union(*parts) - odd if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            fresh = [self.rows(new[i : i + 20_000]) for i in range(0, len(new), 20_000)]
            self.table = np.concatenate([self.table, *fresh])
        out, size = np.full((len(texts), len(self.langs)), np.nan), np.zeros(len(texts))
        for i, words in enumerate(parts):
            if words:
                total = self.table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
                out[i], size[i] = -total[:-1] / total[-1], total[-1]
        if len(self.known) > 4 * limit:  # a batch of very many long words
            self.known, self.table = {}, self.table[:0]
        return out, size

    def posterior(self, entropies: np.ndarray) -> np.ndarray:
        x = -self.sharpness * (entropies - entropies.min(1, keepdims=True))
        e = np.exp(x)
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, score and whether it is rejected, for each text. What lies above its language's limit scores less, the further the less."""
        if not self.langs:
            return [("und", 0.0, True)] * len(texts)
        h, n = self.entropies(texts)
        some = ~np.isnan(h[:, 0])
        out = [("und", 0.0, True)] * len(texts)
        if some.any():
            p, best = self.posterior(h[some]), h[some].argmin(1)
            for i, k, row, e, size in zip(np.flatnonzero(some), best, p, h[some], n[some], strict=True):
                over = e[k] - self.limits[k, step(size)]
                out[i] = (self.langs[k], float(row[k] * np.exp(-max(over, 0.0))), bool(over > 0))
        return out


STEPS = 6


def step(size):
    """Texts of about 1, 2, 4, 8, 16, and 32 words of six letters and more have limits of their own."""
    return np.clip(np.log2(np.maximum(size, 1) / 7), 0, STEPS - 1).astype(int)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_words(docs: DataFrame, per_language: int, longest: int, documents: int) -> DataFrame:
    """Word counts by language: (lang, doc, word, n), doc being -1 but for the fifth of the documents that calibrates. At most per_language
    documents of a language, the first by a hash of doc_id and text, of at most `longest` characters each, and
    at most `documents` documents in all, dealt evenly: so the table's size is bounded, whatever the corpus, and no language is left out.
    More languages than documents are an error."""
    rows = docs.select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text").alias("h"), F.coalesce(~held_out(), F.lit(True)).alias("free"))
    rows = rows.filter(F.col("free") & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= longest)).select("lang", "h", "text")
    n_langs = rows.select(F.count_distinct("lang")).first()[0]
    if n_langs > documents:
        raise ValueError(f"{n_langs} languages to learn from {documents} documents")
    per_language = min(per_language, documents // max(n_langs, 1))
    # hashes only, in two steps, so that a large language is dealt over many tasks
    least = lambda df, *by: df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).filter(F.col("r") <= per_language)
    chosen = least(least(rows.select("lang", "h", F.pmod("h", F.lit(64)).alias("part")), "lang", "part"), "lang")
    edge = chosen.groupBy("lang").agg(F.max("h").alias("edge"))  # as many rows as languages
    # repeated rows have one hash, so the rows up to the edge are counted again
    kept = least(rows.join(F.broadcast(edge), "lang").filter(F.col("h") <= F.col("edge")), "lang")

    def run(batches: Iterator) -> Iterator:
        import collections

        import pyarrow as pa

        for batch in batches:
            counts: collections.Counter = collections.Counter()
            for lang, h, text in zip(*(batch.column(x).to_pylist() for x in ("lang", "h", "text")), strict=True):
                words = LETTERS.findall(text.lower())
                doc = abs(h) if h % 5 == 1 else -1  # a calibration document stays whole
                counts.update((lang, doc, w) for w in words)
            cols = list(zip(*((*k, n) for k, n in counts.items()), strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["lang", "doc", "word", "n"])

    found = kept.select("lang", "h", "text").mapInArrow(run, "lang string, doc long, word string, n long")
    return found.groupBy("lang", "doc", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, per_language: int = 300, longest: int = 20_000, documents: int = 19_200, rate: float = 0.0005) -> Classifier:
    """A classifier of the languages in docs.lang. It learns from at most per_language documents of each language, `documents` in all,
    and `longest` characters of each, so what reaches the driver is bounded (at most 384 million characters, as distinct words with counts). Rejection is calibrated to a false-rejection rate: a text is
    rejected if its cross-entropy exceeds what all but a share `rate` of random draws of as many words from calibration documents of its
    language reach (32 words for longer texts, whose cross-entropy varies less)."""
    table = training_words(docs, per_language, longest, documents).toPandas()
    langs = sorted(table["lang"].unique())
    models = []
    for lang in langs:
        own = table[(table["lang"] == lang) & (table["doc"] == -1)]
        own = own if len(own) else table[table["lang"] == lang]
        own = own.groupby("word")["n"].sum().sort_index()
        models.append(KneserNey(list(own.index), own.to_numpy()) if len(own) else None)
    langs, models = [x for x, m in zip(langs, models, strict=True) if m], [m for m in models if m]
    out = Classifier(langs, models)
    probe = table[(table["doc"] != -1) & table["lang"].isin(langs)].sort_values(["lang", "doc", "word"])
    if len(probe):
        truth, h, rng = [], [], np.random.default_rng(3)
        words = sorted(set(probe["word"]))
        scored = out.rows(words)
        place = dict(zip(words, range(len(words)), strict=True))
        draws: dict[int, list] = {k: [] for k in range(len(langs))}
        for (lang, _), own in probe.groupby(["lang", "doc"]):
            rows, n = scored[[place[w] for w in own["word"]]], own["n"].to_numpy()
            total = n @ rows
            truth.append(langs.index(lang))
            h.append(-total[:-1] / total[-1])
            draws[truth[-1]].append((rows, n / n.sum()))
        h, truth = np.array(h), np.array(truth)
        loss = []
        grid = [0.5, 1, 2, 4, 8, 16, 32]
        for s in grid:
            out.sharpness = s
            loss.append(-np.log(np.clip(out.posterior(h)[np.arange(len(h)), truth], 1e-9, 1)).mean())
        out.sharpness = float(grid[int(np.argmin(loss))])
        for k, own in draws.items():
            if len(own) >= 5:
                each = -(-8000 // len(own))
                for s in range(STEPS):
                    at = [(rows[:, [k, -1]], rng.choice(len(n), (each, 1 << s), p=n)) for rows, n in own]
                    sums = np.concatenate([rows[i].sum(1) for rows, i in at])
                    out.limits[k, s] = np.quantile(-sums[:, 0] / sums[:, 1], 1 - rate)
    return out


def identified(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """Every document's language: doc_id, held_out, lang_pred, score, rejected.

    A null text, or one without letters, is `und` with score 0 and rejected, as is everything if no document has a language. A null doc_id
    is not held out. Of languages that fit equally well the first by name is taken. Rows, repeated ones too, are taken one by one, and whole
    texts of any length; an empty table gives no rows; other columns are ignored.
    """
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                found = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), *(pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True))], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """Documents whose language is told and not rejected, with their columns; identified() tells how odd rows are taken."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                found = shared.value.predict([x or "" for x in part.column("text").to_pylist()])
                yield part.filter(pa.array([not rejected for _, _, rejected in found]))

    return docs.mapInArrow(run, docs.schema)
