"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is cut before each run of spaces; no piece of a BPE model with spaces at the start of
pieces only reaches across such a cut.  Each segment is merged by an agenda of candidate pairs,
best score first, leftmost if tied.  When a candidate comes up, a keyed hash of (seed, doc_id,
number of the segment in the text, position, piece) decides whether it is skipped for good; with
dropout 0 the ids are those of the library.  So each occurrence of a word is cut by itself, and one
seed always gives one result, whatever else is in the table.

The agendas of many segments of like length are worked off together: a matrix holds the ranks of
all candidate pairs, a round takes the best one of each row, skips or merges it and looks up the
two pairs that change.  Nothing is cached, so memory is that of one step.  Long segments and those
with characters that the model has not are merged one by one, by a heap.

Characters without a piece, and a literal U+2581, become byte pieces, so that decoding joins the
pieces' bytes, turns the space mark into a space and drops the leading space: exactly the text.

Defined results: null text has no ids and decodes to the empty text, like an empty one.  Null
doc_id is replaced by a hash of the text.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from posofold.llm.common import documents, mix, slices

DROPOUT, SEED = 0.1, 1
MARK = "▁"
_SHORT, _STEP = 48, 1 << 16  # characters of a segment, segments at once
_WIDTHS = (4, 6, 8, 10, 12, 16, 24, _SHORT)  # segments up to such a length share a matrix
_STEP_BYTES = 2 << 20
_PLACE, _PIECE, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_M64 = (1 << 64) - 1
_models: dict[str, Model] = {}


class _Pairs:
    """Which two symbols merge into which piece: hash tables, each for what the one before had no
    room for; a slot says whether there is such an entry."""

    def __init__(self, model: Model):
        pairs = [
            (model.id[p[:k]] << 32 | model.id[p[k:]], model.order[p], i)
            for p, i in model.id.items()
            for k in range(1, len(p))
            if p[:k] in model.id and p[k:] in model.id
        ]
        keys, ranks, pieces = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else [np.zeros(0, np.int64)] * 3
        self.none = len(model.order)
        self.tables: list[tuple] = []
        bits = 20
        while len(keys) or not self.tables:
            slot = self._slot(keys, bits, len(self.tables))
            _, first = np.unique(slot, return_index=True)
            at = np.full(1 << bits, -1, np.int64)
            rank, piece, more = np.full(1 << bits, self.none, np.int32), np.zeros(1 << bits, np.int32), np.zeros(1 << bits, bool)
            at[slot[first]], rank[slot[first]], piece[slot[first]] = keys[first], ranks[first], pieces[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            more[slot[left]] = True
            self.tables.append((bits, at, rank, piece, more))
            keys, ranks, pieces = keys[left], ranks[left], pieces[left]

    @staticmethod
    def _slot(keys: np.ndarray, bits: int, number: int) -> np.ndarray:
        mixed = (keys.astype(np.uint64) + np.uint64(number)) * _PLACE
        return ((mixed ^ (mixed >> np.uint64(29))) * _LAST >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; the rank is ``none`` where the two don't merge."""
        keys = left.astype(np.int64) << 32 | right
        bits, at, ranks, pieces, more = self.tables[number]
        slot = self._slot(keys, bits, number)
        hit = at[slot] == keys
        rank, piece = np.where(hit, ranks[slot], self.none).astype(np.int32), pieces[slot]
        rest = np.flatnonzero(~hit & more[slot])
        if len(rest):
            rank[rest], piece[rest] = self.find(left[rest], right[rest], number + 1)
        return rank, piece


class Model:
    """Pieces and scores of a BPE model file with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        bytes_at = [i for i in range(len(self.pieces)) if processor.is_byte(i)]
        plain = [i for i in range(len(self.pieces)) if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))]
        self.byte = {int(self.pieces[i][3:5], 16): i for i in bytes_at}
        self.id = {self.pieces[i]: i for i in plain}
        self.rank = {self.pieces[i]: (-processor.get_score(i), i) for i in plain}
        self.data = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.byte.items():
            self.data[i] = bytes([value])
        best = {score: k for k, score in enumerate(sorted({r[0] for r in self.rank.values()}))}
        self.order = {p: best[r[0]] for p, r in self.rank.items()}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces of this model reach across words")
        self.symbol = np.full(0x110000, -1, np.int32)  # of a character; -1 if it has no piece
        for p, i in self.id.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")], self.symbol[ord(MARK)] = self.symbol[ord(MARK)], -1
        self.pairs = _Pairs(self)

    def encode(self, segment: str, dropout: float, key: int) -> list[int]:
        """Ids of one segment (spaces, then other characters)."""
        if len(segment) > _SHORT or MARK in segment:
            return self._agenda(segment, dropout, key)
        # The same agenda as a plain list, which is faster while it is short.
        symbols, order, ids, cut = list(segment.replace(" ", MARK)), self.order, self.id, int(dropout * (1 << 32))
        none, at = len(order), list(range(len(symbols)))
        agenda = [order.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            merged = symbols[i] + symbols[i + 1]
            if cut:
                h = ((key ^ (at[i] * 0x9E3779B97F4A7C15)) + ids[merged] * 0xBF58476D1CE4E5B9) & _M64
                if (((h ^ (h >> 29)) * 0x94D049BB133111EB) & _M64) >> 32 < cut:
                    agenda[i] = none
                    continue
            symbols[i] = merged
            del symbols[i + 1], at[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = order.get(merged + symbols[i + 1], none)
            if i:
                agenda[i - 1] = order.get(symbols[i - 1] + merged, none)
        out = []
        for s in symbols:
            if s in ids:
                out.append(ids[s])
            else:
                out += [self.byte[b] for b in s.encode()]
        return out

    def _agenda(self, segment: str, dropout: float, key: int) -> list[int]:
        # A literal mark must not be taken for a space: it stays apart, as its bytes.
        symbols = [None if c == MARK else MARK if c == " " else c for c in segment]
        n, rank, cut = len(symbols), self.rank, int(dropout * (1 << 32))
        right, left, agenda = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def push(i: int, j: int) -> None:
            if symbols[i] and symbols[j]:
                found = rank.get(symbols[i] + symbols[j])
                if found:
                    heapq.heappush(agenda, (found[0], i, found[1], len(symbols[i]), len(symbols[j])))

        for i in range(n - 1):
            push(i, i + 1)
        while agenda:
            _, i, piece, size, follow = heapq.heappop(agenda)
            j = right[i]
            if not symbols[i] or j >= n or len(symbols[i]) != size or len(symbols[j]) != follow:
                continue
            if cut:
                h = ((key ^ (i * 0x9E3779B97F4A7C15)) + piece * 0xBF58476D1CE4E5B9) & _M64
                h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) & _M64
                if (h >> 32) < cut:
                    continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                push(i, k)
            if left[i] >= 0:
                push(left[i], i)
        out, i = [], 0
        while i < n:
            s = symbols[i]
            known = self.id.get(s) if s else None
            out += [known] if known is not None else [self.byte[b] for b in (s or MARK).replace(MARK, " " if s else MARK).encode()]
            i = right[i]
        return out

    def decode(self, ids) -> str:
        """The text of ids of a whole text."""
        return b"".join([self.data[i] for i in ids])[1:].decode()


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Encoder:
    """Encodes texts, many segments at a time."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.model, self.dropout, self.seed = model(path), dropout, seed
        self.cut = np.uint64(int(dropout * (1 << 32)))

    def _merged(self, symbols: np.ndarray, length: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of segments (a row each) after all merges, and where they are left."""
        pairs, (n, width) = self.model.pairs, symbols.shape
        alive = np.arange(width) < length[:, None]
        rank, piece = np.full((n, width), pairs.none, np.int32), np.zeros((n, width), np.int32)
        row, at = np.nonzero(alive[:, 1:])
        rank[row, at], piece[row, at] = pairs.find(symbols[row, at], symbols[row, at + 1])
        # neighbours of each symbol that is left; column ``width`` stands for none
        after = np.tile(np.arange(1, width + 1, dtype=np.int16), (n, 1))
        after[np.arange(width) + 1 >= length[:, None]] = width
        before = np.tile(np.arange(-1, width - 1, dtype=np.int16), (n, 1))
        rows = np.arange(n)
        while len(rows):
            best = rank[rows].argmin(axis=1)
            open_ = rank[rows, best] < pairs.none
            rows, i = rows[open_], best[open_]
            made = piece[rows, i]
            if self.cut:
                h = (keys[rows] ^ (i.astype(np.uint64) * _PLACE)) + made.astype(np.uint64) * _PIECE
                skip = ((h ^ (h >> np.uint64(29))) * _LAST) >> np.uint64(32) < self.cut
                rank[rows[skip], i[skip]] = pairs.none
                here, i, made = rows[~skip], i[~skip], made[~skip]
            else:
                here = rows
            j = after[here, i].astype(np.int64)
            symbols[here, i] = made
            alive[here, j] = False
            rank[here, j] = rank[here, i] = pairs.none
            k = after[here, j].astype(np.int64)
            after[here, i] = k
            some = k < width
            before[here[some], k[some]] = i[some]
            rank[here[some], i[some]], piece[here[some], i[some]] = pairs.find(made[some], symbols[here[some], k[some]])
            k = before[here, i].astype(np.int64)
            some = k >= 0
            rank[here[some], k[some]], piece[here[some], k[some]] = pairs.find(symbols[here[some], k[some]], made[some])
        return symbols, alive

    def _cut_up(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments of an array of characters, and how many each has."""
        symbols = self.model.symbol[codes]
        strange = np.concatenate(([0], np.cumsum(symbols < 0)))
        alone = (size > _SHORT) | (strange[start + size] > strange[start])
        count, found, low = np.zeros(len(start), np.int64), [], 0
        for width in _WIDTHS:
            which = np.flatnonzero(~alone & (size > low) & (size <= width))
            low = width
            for a in range(0, len(which), _STEP):
                some = which[a : a + _STEP]
                at = np.minimum(start[some][:, None] + np.arange(width), len(codes) - 1)
                merged, alive = self._merged(symbols[at], size[some], keys[some])
                count[some] = alive.sum(axis=1)
                found.append((some, merged[alive]))
        for i in np.flatnonzero(alone).tolist():
            text = codes[start[i] : start[i] + size[i]].tobytes().decode("utf-32-le")
            ids = self.model.encode(text, self.dropout, int(keys[i]))
            count[i] = len(ids)
            found.append((np.array([i]), np.array(ids, np.int32)))
        first = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.uint32)
        for some, ids in found:
            n = count[some]
            out[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, count

    def _part(self, segments: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, and how many each has."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        return self._cut_up(codes, np.cumsum(size) - size, size, keys)

    def encode_all(self, texts: list[str | None], doc_ids: list[int | None]) -> list[bytes]:
        """32-bit little-endian ids of each text."""
        spaced = [" " + t if t else "" for t in texts]
        codes = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return [b""] * len(texts)
        size = np.fromiter(map(len, spaced), np.int64, len(texts))
        begin = np.cumsum(size) - size
        space = codes == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[begin[size > 0]] = True  # the space in front of each text
        start = np.flatnonzero(first)
        # segments before each text, and of it
        ends = np.searchsorted(start, np.append(begin, len(codes)))
        names = [f"text {t}" if i is None else str(i) for t, i in zip(texts, doc_ids)]
        base = np.fromiter((xxhash.xxh3_64_intdigest(x, seed=self.seed & _M64) for x in names), np.uint64, len(names))
        of = np.repeat(np.arange(len(texts)), np.diff(ends))
        number = (np.arange(len(start)) - ends[of]).astype(np.uint64)
        keys = mix(number * _PLACE + base[of])
        ids, count = self._cut_up(codes, start, np.diff(np.append(start, len(codes))), keys)
        at = 4 * np.concatenate(([0], np.cumsum(count)))[ends]
        data = memoryview(ids.tobytes())
        return [bytes(data[i:j]) for i, j in zip(at.tolist(), at[1:].tolist())]

    def encode(self, text: str | None, doc_id: int | None = 0) -> bytes:
        return self.encode_all([text], [doc_id])[0]


def _encoder(path: str, dropout: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, dropout, seed)
        for batch in slices(batches, step=_STEP_BYTES):
            coded = encoder.encode_all(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist())
            ends = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(coded), np.uint32).astype(np.int32))
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            texts = [known.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode(docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id and ids of every row of docs (doc_id, text)."""
    return documents(docs).mapInArrow(_encoder(path, dropout, seed), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of coded (doc_id, ids)."""
    return coded.select("doc_id", "ids").mapInArrow(_decoder(path), "doc_id long, text string")


def summary(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode: doc_id, n_ids, ids_crc32, decoded_sha256 and whether that is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches, step=_STEP_BYTES):
            doc_ids, texts, rows = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), []
            for doc_id, text, coded in zip(doc_ids, texts, encoder.encode_all(texts, doc_ids)):
                ids = memoryview(coded).cast("I")
                back = encoder.model.decode(ids)
                rows.append((doc_id, len(ids), zlib.crc32(coded), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

    kind = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean"
    return documents(docs).mapInArrow(run, kind)
