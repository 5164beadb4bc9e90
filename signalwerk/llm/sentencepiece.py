"""SentencePiece encoding and decoding as a max-plus scan over a lattice of pieces.

A state at a place in the text is the piece that ends there or reaches over it. A step's weight is the piece's score in a unigram model;
in a merge model it is 0 where the two pieces next to each other are the ones that merging would leave, and minus infinity elsewhere, which
singles out the merge result. A giant document is cut into chunks at fixed distances. Each chunk yields the matrix of best weights from the
states at its left edge to those at its right edge; an associative max-plus product combines them; each chunk is then traced back on its own.
Where no piece can reach over a place, all states are one, and what lies between two such places is a word whose pieces are kept for reuse.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .common import slices, text_or_empty, tokenizer_path

SPACE = "▁"
NONE = float("-inf")
NORMAL, UNKNOWN, BYTE = 1, 2, 6


class Model:
    """Pieces, scores and options of a .model file. kind is "unigram" or "merge"; by default the file's own."""

    def __init__(self, path: str, kind: str | None = None, keep: int = 1_200_000):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        self.kind = kind or ("merge" if m.trainer_spec.model_type == 2 else "unigram")
        self.prefix = m.normalizer_spec.add_dummy_prefix
        if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave characters and spaces as they are")
        self.pieces = [p.piece for p in m.pieces]
        self.score = {p.piece: p.score for p in m.pieces if p.type in (NORMAL, 4)}
        self.ident = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (NORMAL, 4)}
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.missing_score = min(self.score.values()) - 10.0
        self.longest = max(map(len, self.score))
        longer = [p for p in self.score if len(p) > 1]
        inside = "".join(sorted({c for p in longer for c in p} - {SPACE}))
        # a word: a run of spaces and what follows it; characters that no longer piece has stand alone
        cut_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer)
        body = re.escape(inside) if cut_at_space else re.escape(inside) + SPACE
        body = body or SPACE
        self.word = re.compile(f"{SPACE}+[{body}]*|[{body}]+|." if cut_at_space else f"[{body}]+|.", re.DOTALL)
        self.keep = keep
        self.known: dict[str, bytes] = {}
        self.halves = lru_cache(1 << 17)(self._halves)
        self.compatible = lru_cache(1 << 19)(self._compatible)
        self.reach: dict[str, int] = {}
        for p in self.score:
            self.reach[p[0]] = max(self.reach.get(p[0], 1), len(p))
        self.piece_ids = lru_cache(1 << 17)(lambda piece: np.asarray(self.ids_of(piece), "<u4").tobytes())
        self.usable = {p for p in self.score if self.whole(p)} if self.kind == "merge" else set(self.score)
        self.starts: dict[str, bool] = {}  # what usable pieces begin with, of two characters or more, and whether it is one
        for p in self.usable:
            for n in range(2, len(p)):
                self.starts.setdefault(p[:n], False)
            self.starts[p] = True
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.pieces)]

    def normal(self, text: str) -> str:
        return ((" " if self.prefix and text else "") + text).replace(" ", SPACE)

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.ident:
            return [self.ident[piece]]
        if self.byte_ids:
            return [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return [self.unknown]

    def merged(self, text: str) -> list[str]:
        """What merging leaves of a short text: the pair with the best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = max(((self.score.get(a + b, NONE), -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(NONE, 0))
            if best == NONE:
                break
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts that merging a piece's characters joins last; None if they don't end up as the piece."""
        parts = list(piece)
        while len(parts) > 2:
            best, at = max((self.score.get(a + b, NONE), -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == NONE:
                return None
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def whole(self, piece: str) -> bool:
        return len(piece) == 1 or self.halves(piece) is not None

    def _compatible(self, a: str, b: str) -> bool:
        """Whether merging a + b leaves a and b: undo the later of their last merges, one after another, and see that no pair across the border would have come before it."""
        score, limit, left_wins = self.score, NONE, False
        while True:
            across = score.get(a + b, NONE)
            # pairs of one score go from left to right
            if across > limit or (across == limit and left_wins and across != NONE):
                return False
            sa = score.get(a, NONE) if len(a) > 1 else float("inf")
            sb = score.get(b, NONE) if len(b) > 1 else float("inf")
            if sa == sb == float("inf"):
                return True
            if sb <= sa:  # b's last merge came later, or as late but further right
                limit, left_wins, b = sb, True, self.halves(b)[0]
            else:
                limit, left_wins, a = sa, False, self.halves(a)[1]

    def step(self, before: str | None, piece: str) -> float:
        """The weight of a piece after another; before is None where all states are one."""
        if self.kind == "merge":
            return 0.0 if before is None or self.compatible(before, piece) else NONE
        return self.score.get(piece, self.missing_score)

    def at(self, text: str, start: int) -> Iterator[str]:
        """Pieces that can begin at a place: single characters always, longer ones that the model has and merging can leave."""
        yield text[start]
        for n in range(2, min(self.reach.get(text[start], 1), len(text) - start) + 1):
            piece = text[start : start + n]
            if piece in self.usable:
                yield piece

    def forward(self, text: str, enter: dict[tuple[int, str | None], float], begin: int, end: int) -> tuple[dict, dict]:
        """Best weight of each state at places from begin on, and where it came from.

        A state is (place where its last piece ends, that piece). enter has the states at the left edge. Pieces begin before `end` and may reach over it.
        """
        best: dict[int, dict[str | None, float]] = {}
        came: dict[tuple[int, str], tuple[int, str | None]] = {}
        for (place, piece), w in enter.items():
            best.setdefault(place, {})[piece] = w
        for place in range(begin, end):
            here = best.get(place)
            if not here:
                continue
            for piece in self.at(text, place):
                top, source = NONE, None
                for before, w in here.items():
                    x = w + self.step(before, piece)
                    if x > top:
                        top, source = x, (place, before)
                if source is not None:
                    stop = place + len(piece)
                    best.setdefault(stop, {})[piece] = top
                    came[stop, piece] = source
        return best, came

    def word_pieces(self, word: str) -> list[str]:
        if self.kind == "merge":
            return self.only_way(word)
        best, came = self.forward(word, {(0, None): 0.0}, 0, len(word))
        last = max(best[len(word)].items(), key=lambda x: (x[1], -len(x[0])))[0]
        return traced(came, (len(word), last), (0, None))

    def only_way(self, word: str) -> list[str]:
        """forward() and traced() for a merge model from a cut: merging splits each prefix in one way, so each place has one state, and a
        place that has its state needs no other piece. Pieces from a place on end where no usable piece goes on."""
        n, starts, compatible = len(word), self.starts.get, self.compatible
        last: list[str | None] = [None] * (n + 1)
        for place in range(n):
            before = last[place]
            if before is None and place:
                continue
            if last[place + 1] is None and (place == 0 or compatible(before, word[place])):
                last[place + 1] = word[place]
            for stop in range(place + 2, n + 1):
                if last[stop] is None:
                    is_piece = starts(piece := word[place:stop])
                    if is_piece is None:
                        break
                    if is_piece and (place == 0 or compatible(before, piece)):
                        last[stop] = piece
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def word_ids(self, word: str) -> bytes:
        return b"".join(map(self.piece_ids, self.word_pieces(word)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        return self.encode_words(self.word.findall(self.normal(text)))

    def encode_words(self, words: list[str]) -> bytes:
        known, once = self.known, {}
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            (known if len(w) <= 48 else once)[w] = self.word_ids(w)
        return b"".join(known[w] if w in known else once[w] for w in words) if once else b"".join(map(known.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


# chunks ------------------------------------------------------------------------------------------------------------------------------


def is_cut(model: Model, text: str, place: int) -> bool:
    """Whether no piece can reach over a place inside a text."""
    return bool(model.word.fullmatch(text[place - 1 : place + 1])) is False


def states(model: Model, text: str, edge: int) -> list[tuple[int, str | None]]:
    """States at an edge: one at a cut, else the pieces that begin since the last cut and end at the edge or after it. Places count from the edge."""
    if is_cut(model, text, edge):
        return [(0, None)]
    low = edge - 1
    while low > max(0, edge - model.longest) and not is_cut(model, text, low):
        low -= 1
    return [(s + len(p) - edge, p) for s in range(low, edge) for p in model.at(text, s) if s + len(p) >= edge]


@dataclass
class Chunk:
    """text[begin:end] of a longer text, with enough around it for the pieces that reach over its edges. The first begins at 0, the last ends with the text."""

    model: Model
    text: str
    begin: int
    end: int

    def __post_init__(self):
        t, n = self.text, len(self.text)
        self.enter = [(0, None)] if self.begin == 0 else states(self.model, t, self.begin)
        self.leave = [(0, None)] if self.end == n else states(self.model, t, self.end)
        cut = lambda p: p in (0, n) or is_cut(self.model, t, p)
        self.first = next((p for p in range(self.begin, self.end + 1) if cut(p)), None)
        self.last = None if self.first is None else next(p for p in range(self.end, self.first - 1, -1) if cut(p))

    def run(self, state: tuple[int, str | None], begin: int, end: int) -> tuple[dict, dict]:
        place, piece = state
        return self.model.forward(self.text, {(self.begin + place if begin == self.begin else place, piece): 0.0}, begin, end)

    def left(self, state: tuple[int, str | None]) -> tuple[float, list[str]]:
        """Weight and pieces from a state at the left edge to the first cut."""
        start = (self.begin + state[0], state[1])
        if start[0] == self.first:
            return 0.0, []
        best, came = self.model.forward(self.text, {start: 0.0}, self.begin, self.first)
        if not best.get(self.first):
            return NONE, []
        piece, w = max(best[self.first].items(), key=lambda x: (x[1], -len(x[0])))
        return w, traced(came, (self.first, piece), start)

    def right(self, state: tuple[int, str | None], start: tuple[int, str | None]) -> tuple[float, list[str]]:
        """Weight and pieces from a state, given by its place in the text, to one at the right edge."""
        stop = (self.end + state[0], state[1])
        if stop == start:
            return 0.0, []
        best, came = self.model.forward(self.text, {start: 0.0}, min(start[0], self.end), self.end)
        if stop[1] is None:  # the text's end or a cut: all states there are one
            if not best.get(stop[0]):
                return NONE, []
            piece, w = max(best[stop[0]].items(), key=lambda x: (x[1], -len(x[0] or "")))
            return w, traced(came, (stop[0], piece), start)
        w = best.get(stop[0], {}).get(stop[1], NONE)
        return w, traced(came, stop, start) if w > NONE else []

    def middle(self) -> list[str]:
        return self.model.word.findall(self.text[self.first : self.last])

    def matrix(self) -> np.ndarray:
        """Best weights from each state at the left edge to each at the right."""
        if self.first is None:
            return np.array([[self.right(b, (self.begin + a[0], a[1]))[0] for b in self.leave] for a in self.enter])
        between = 0.0
        if self.model.kind == "unigram":
            between = sum(self.model.step(None, p) for w in self.middle() for p in self.model.word_pieces(w))
        left = np.array([self.left(a)[0] for a in self.enter])
        right = np.array([self.right(b, (self.last, None))[0] for b in self.leave])
        return left[:, None] + between + right[None, :]

    def ids(self, a: int, b: int) -> bytes:
        """Ids of the pieces that begin in the chunk, between its a-th state at the left and its b-th at the right."""
        raw = lambda pieces: np.asarray([i for p in pieces for i in self.model.ids_of(p)], "<u4").tobytes()
        if self.first is None:
            return raw(self.right(self.leave[b], (self.begin + self.enter[a][0], self.enter[a][1]))[1])
        return raw(self.left(self.enter[a])[1]) + self.model.encode_words(self.middle()) + raw(self.right(self.leave[b], (self.last, None))[1])


def traced(came: dict, state: tuple[int, str | None], start: tuple[int, str | None]) -> list[str]:
    out = []
    while state != start:
        out.append(state[1])
        state = came[state]
    return out[::-1]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(1) if a.size and b.size else np.full((a.shape[0], b.shape[1]), NONE)


_models: dict[tuple[str, str | None], Model] = {}


def model_at(path: str, kind: str | None = None) -> Model:
    """One for each file and Python worker."""
    if (path, kind) not in _models:
        _models[path, kind] = Model(path, kind)
    return _models[path, kind]


def chosen(matrices: list[np.ndarray], enter: int | None = 0, leave: int | None = 0) -> list[tuple[int, int]]:
    """For each of a few neighbouring chunks, the states at its edges on the best way from a state at the left to one at the right."""
    ahead = [np.where(np.arange(matrices[0].shape[0]) == enter, 0.0, NONE)[None, :]]
    for m in matrices:
        ahead.append(product(ahead[-1], m))
    state, out = leave, []
    for before, m in zip(ahead[-2::-1], matrices[::-1], strict=True):
        left = int((before[0] + m[:, state]).argmax())
        out.append((left, state))
        state = left
    return out[::-1]


def crc32_combine(first: int, second: int, size: int) -> int:
    """The CRC-32 of two stretches of bytes one after another, from theirs and the second's length: zeros are appended by squaring a bit matrix."""

    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        matrix = [times(matrix, row) for row in matrix]  # one zero byte
    while size:
        if size & 1:
            first = times(matrix, first)
        matrix = [times(matrix, row) for row in matrix]
        size >>= 1
    return first ^ second


def digest_columns(pa, idents, counts, crcs, trips):
    return pa.RecordBatch.from_arrays([pa.array(idents, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()), pa.array(trips, pa.bool_())], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])


def encoded(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", kind: str | None = None, chunk: int = 32_768) -> DataFrame:
    """Every document's ids by digest: doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip.

    round_trip says whether decoding the ids gives the text; it doesn't where the text itself holds the space mark U+2581. Null text is
    empty and has no ids. Rows are taken one by one; other columns are ignored. Documents over `chunk` characters go through chunks.
    """
    result = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = model_at(tokenizer_path(vocabulary), kind)
        for batch in batches:
            for part in slices(batch):
                found = []
                for text in part.column("text").to_pylist():
                    raw = model.encode(text)
                    ids = np.frombuffer(raw, "<u4").tolist()
                    found.append((len(ids), zlib.crc32(raw), model.decode(ids) == text))
                yield digest_columns(pa, part.column("doc_id"), *zip(*found, strict=True))

    short = rows.filter(F.length("text") <= chunk).mapInArrow(whole, result)
    return short.unionByName(_giants(rows.filter(F.length("text") > chunk), vocabulary, kind, chunk, result))


FAN = 32
MATRIX = "uid long, k int, states int, weights array<double>"


def _rows(pa, schema: dict, rows: list[tuple]):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.values(), strict=True)], names=list(schema))


def grouped(rows: DataFrame, key: str, order: str, of, result: str) -> DataFrame:
    """`of` (a list of rows as dicts to a list of tuples) applied to the rows of each (uid, key) in order; a group has FAN rows at most."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)
        held, at = [], None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if at is not None and (row["uid"], row[key]) != at:
                    out += of(held)
                    held = []
                at = row["uid"], row[key]
                held.append(row)
            if out:
                yield _rows(pa, dict(zip(schema.names, schema.types, strict=True)), out)
        if held:
            yield _rows(pa, dict(zip(schema.names, schema.types, strict=True)), of(held))

    kinds = rows.sparkSession.createDataFrame([], result).schema
    return rows.repartition("uid", key).sortWithinPartitions("uid", key, order).mapInArrow(run, result)


def as_matrix(row: dict) -> np.ndarray:
    return np.array(row["weights"]).reshape(row["states"], -1)


def combined(rows: list[dict]) -> list[tuple]:
    """The product of a group's matrices, in order."""
    whole = as_matrix(rows[0])
    for row in rows[1:]:
        whole = product(whole, as_matrix(row))
    return [(rows[0]["uid"], rows[0]["g"], whole.shape[0], whole.ravel().tolist())]


def ways(rows: list[dict]) -> list[tuple]:
    """States at the edges of each of a group's members, given those of the group."""
    both = chosen([as_matrix(r) for r in rows], rows[0]["enter"], rows[0]["leave"])
    return [(r["uid"], r["k"], a, b) for r, (a, b) in zip(rows, both, strict=True)]


def _giants(rows: DataFrame, vocabulary: str, kind: str | None, size: int, result: str) -> DataFrame:
    """Chunks, their matrices, products of FAN neighbours in a tree up to one for each document, states back down the tree, ids of each chunk."""
    around = 64  # characters kept on each side of a chunk

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = {"uid": pa.int64(), "doc_id": pa.int64(), "k": pa.int32(), "begin": pa.int32(), "end": pa.int32(), "text": pa.string()}
        for batch in batches:
            for uid, doc, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "text")), strict=True):
                text = " " + text
                for k, at in enumerate(range(0, len(text), size)):
                    low = max(0, at - around)
                    yield _rows(pa, schema, [(uid, doc, k, at - low, min(at + size, len(text)) - low, text[low : at + size + around])])

    numbered = rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "doc_id", "text")
    table = stored(numbered.mapInArrow(cut, "uid long, doc_id long, k int, begin int, end int, text string").repartition("uid", "k"), "chunks")

    def chunk_of(model: Model, text: str, begin: int, end: int) -> Chunk:
        assert model.longest <= around and model.prefix
        return Chunk(model, text.replace(" ", SPACE), begin, end)

    def matrices(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = model_at(tokenizer_path(vocabulary), kind)
        for batch in batches:
            cols = batch.to_pydict()
            found = [chunk_of(model, *x).matrix() for x in zip(cols["text"], cols["begin"], cols["end"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("k"), pa.array([m.shape[0] for m in found], pa.int32()), pa.array([m.ravel().tolist() for m in found], pa.list_(pa.float64()))], names=["uid", "k", "states", "weights"])

    def trace(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = model_at(tokenizer_path(vocabulary), kind)
        for batch in batches:
            cols, out = batch.to_pydict(), []
            for text, begin, end, a, b in zip(*(cols[c] for c in ("text", "begin", "end", "enter", "leave")), strict=True):
                c = chunk_of(model, text, begin, end)
                raw = c.ids(a, b)
                said = b"".join(map(model.raw.__getitem__, np.frombuffer(raw, "<u4").tolist()))
                out.append((len(raw) // 4, zlib.crc32(raw), said.decode("utf-8", "replace").replace(SPACE, " ") == text[begin + c.enter[a][0] : end + c.leave[b][0]]))
            n, crc, same = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), batch.column("k"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["uid", "doc_id", "k", "n", "crc", "same"])

    def sums(rows: list[dict]) -> list[tuple]:
        n, crc = 0, 0
        for r in rows:
            n, crc = n + r["n"], crc32_combine(crc, r["crc"], 4 * r["n"])
        return [(rows[0]["uid"], rows[0]["doc_id"], rows[0]["g"], n, crc, all(r["same"] for r in rows))]

    parent = F.floor(F.col("k") / FAN).cast("int").alias("g")
    most = table.agg(F.max("k").alias("k")).first()["k"]
    levels = [stored(table.select("uid", "k", "begin", "end", "text").mapInArrow(matrices, MATRIX), "matrices")]
    while most:
        levels.append(stored(grouped(levels[-1].select("*", parent), "g", "k", combined, MATRIX), "products"))
        most //= FAN
    # one matrix is left of each document, with one state at either end
    way = levels.pop().select("uid", "k", F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    while levels:
        members = levels.pop().select("*", parent).join(way.withColumnRenamed("k", "g"), ["uid", "g"])
        way = stored(grouped(members, "g", "k", ways, "uid long, k int, enter int, leave int"), "ways")
    parts = table.join(way, ["uid", "k"]).select("uid", "doc_id", "k", "begin", "end", "text", "enter", "leave").mapInArrow(trace, "uid long, doc_id long, k int, n long, crc long, same boolean")
    parts, left = stored(parts, "chunk-sums"), table.agg(F.max("k").alias("k")).first()["k"]
    while left:
        parts, left = grouped(parts.select("*", parent), "g", "k", sums, "uid long, doc_id long, k int, n long, crc long, same boolean"), left // FAN
    return parts.select("doc_id", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), F.col("same").alias("round_trip"))


def token_ids(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", kind: str | None = None) -> DataFrame:
    """doc_id and ids of each document. encoded() does without the ids of giant documents in one row; here a row holds them. Null text has no ids."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = model_at(tokenizer_path(vocabulary), kind)
        for batch in batches:
            for part in slices(batch):
                found = [np.frombuffer(model.encode(x), "<u4").astype("i4") for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str = "piece_bpe_32k.model", kind: str | None = None) -> DataFrame:
    """Texts of rows (doc_id, ids). Null ids are none; bytes that are no UTF-8 become U+FFFD. Ids outside the vocabulary raise an error."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = model_at(tokenizer_path(vocabulary), kind)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([model.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
