"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of all distinct words of a slice stand in flat numpy arrays. In each round every word merges its pair of the
best score, the leftmost of equals, at all places where that can't differ from going left to right; then the arrays
are compacted, and words without a pair leave. The library only reads the model file.
"""

from __future__ import annotations

import codecs
import hashlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.bpe import SHIFT, SLICE_BYTES, TextParts, flat, ragged
from geoloom.llm.textvec import GOLDEN, Slice, U, slices, tidy

#: White space as it stands in pieces.
MARK = "▁"
#: The rank of a pair that doesn't merge.
NONE = 1 << 30
#: Symbols below this stand for characters that are in no piece: UNKNOWN - code point.
UNKNOWN = -2

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """A BPE model with an identity normaliser, a space before each text, and bytes for unknown characters."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)])
        of_byte = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(of_byte) < 256 or any(model.is_unused(i) for i in range(size)) or model.normalize(" ﬁ  a ") != MARK * 2 + "ﬁ" + MARK * 2 + "a" + MARK:
            raise ValueError("the model must have all bytes, no unused piece and an identity normaliser with a space before each text")
        self.size, self.end, self.bytes = size, model.eos_id(), np.array([of_byte[b] for b in range(256)], np.int32)
        ids = {names[i]: i for i in range(size) if not special[i]}
        scores = np.array([model.get_score(i) for i in range(size)], np.float32)
        ranks = np.searchsorted(np.unique(-scores), -scores)

        #: Symbols: pieces by their ids, then characters that stand in pieces only together with others.
        symbols = dict(ids)
        for name in ids:
            for c in name:
                symbols.setdefault(c, len(symbols) + size)
        self.of_char = np.full(0x110000, UNKNOWN, np.int32)
        for name, i in symbols.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        pairs = [(symbols[w[:k]] << SHIFT | symbols[w[k:]], ranks[i], i) for w, i in ids.items() for k in range(1, len(w)) if w[:k] in symbols and w[k:] in symbols]
        keys, rank, made = (np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True))
        self._table(keys, rank, made)
        #: Pairs of characters that stand side by side in a piece: between others no merge ever reaches across.
        self._open = np.array(sorted({ord(a) << 21 | ord(b) for w in ids for a, b in zip(w[:-1], w[1:], strict=True)} | {1 << 62}), np.int64)
        self._rare = {i: name for name, i in symbols.items() if i >= size}

        #: The bytes of each id in a decoded text.
        text = [b"" if model.is_control(i) else bytes([int(names[i][3:5], 16)]) if model.is_byte(i) else names[i].replace(MARK, " ").encode() for i in range(size)]
        text[model.unk_id()] = " ⁇ ".encode()
        self.text = pa.array(text, pa.binary())
        self.decimal = pa.array([b"%d " % i for i in range(size)], pa.binary())
        self.run = self._block(ids, scores)
        self.inner_marks = any(MARK in w.lstrip(MARK) for w in ids)

    @staticmethod
    def _block(ids: dict[str, int], scores: np.ndarray) -> int:
        """How many marks the blocks hold in which a run of marks ends up, from its beginning on; 0 if that isn't certain.

        It is if all runs that are pieces have one score, the worst of all, and no other piece has two marks side by
        side: then they merge after all else, the leftmost first. If that makes the longest of them out of so many
        marks, it does at the head of any run, since pairs further right wait.
        """
        runs = {len(w) for w in ids if not w.strip(MARK) and len(w) > 1}
        worst = min(scores[i] for i in ids.values())
        if not runs or any(w.strip(MARK) for w in ids if MARK * 2 in w) or any(scores[ids[MARK * k]] != worst for k in runs):
            return 0
        left = [1] * max(runs)
        while (at := next((k for k in range(len(left) - 1) if left[k] + left[k + 1] in runs), None)) is not None:
            left[at : at + 2] = [left[at] + left[at + 1]]
        return left[0] if len(left) == 1 else 0

    def _table(self, keys: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
        """Pairs by a hash of their keys: what finds its place taken goes to the next free one."""
        self._shift = 64 - (8 * len(keys)).bit_length()
        places = 1 << (64 - self._shift)
        self._keys, self._ranks, self._made = np.full(places + len(keys), -1), np.full(places + len(keys), NONE), np.full(places + len(keys), -1, np.int32)
        for key, at, r, m in zip(keys.tolist(), self._place(keys).tolist(), rank.tolist(), made.tolist(), strict=True):
            while self._keys[at] >= 0:
                at += 1
            self._keys[at], self._ranks[at], self._made[at] = key, r, m

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> U(self._shift)).astype(np.int64)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols and the symbol that it makes."""
        key = left.astype(np.int64) << SHIFT | right
        key[(left < 0) | (right < 0)] = 1 << 62
        at = self._place(key)
        held = self._keys[at]
        seek = np.flatnonzero((held != key) & (held >= 0))
        while len(seek):
            at[seek] += 1
            held[seek] = self._keys[at[seek]]
            seek = seek[(held[seek] != key[seek]) & (held[seek] >= 0)]
        return self._ranks[at], self._made[at]

    def words(self, codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Which word each character belongs to: the parts that begin so, cut where no piece reaches across."""
        first = np.zeros(len(codes) + 1, bool)
        first[begin] = True
        pair = codes[:-1].astype(np.int64) << 21 | codes[1:]
        first[1:-1] |= self._open[np.searchsorted(self._open, pair)] != pair
        return np.cumsum(first[:-1]) - 1

    def merged(self, codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left of parts of code points, and at which character each begins."""
        symbols = self.of_char[codes]
        symbols[symbols == UNKNOWN] = UNKNOWN - codes[symbols == UNKNOWN].astype(np.int32)
        out, live = symbols.copy(), np.ones(len(codes), bool)
        word, place = self.words(codes, begin) if len(codes) else np.empty(0, np.int64), np.arange(len(codes))
        rank = np.full(len(codes), NONE, np.int64)
        rank[:-1] = np.where(word[:-1] == word[1:], self.ranked(symbols[:-1], symbols[1:])[0], NONE) if len(codes) else NONE
        while len(symbols):
            # Words by their first symbol, the least rank of each, and words without a pair leave.
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(word))))
            if (least == NONE).any():
                done = least == NONE
                out[place[done]] = symbols[done]
                symbols, word, place, rank, least = (x[~done] for x in (symbols, word, place, rank, least))
                if not len(symbols):
                    break
            at = _alternate(np.flatnonzero(rank == least))
            made = self.ranked(symbols[at], symbols[at + 1])[1]

            # Each merge as it is if those to its left in its word went before it: does it make a pair of this rank or
            # a better one? Then that pair goes before what follows, which waits for another round.
            inner_left = (at > 0) & (word[at - 1] == word[at])
            right_at = np.minimum(at + 2, len(word) - 1)
            inner_right = (at + 2 < len(word)) & (word[right_at] == word[at])
            left = symbols[at - 1]
            beside = np.append(False, at[1:] == at[:-1] + 2)
            left[beside] = made[:-1][beside[1:]]
            early = np.minimum(np.where(inner_left, self.ranked(left, made)[0], NONE), np.where(inner_right, self.ranked(made, symbols[right_at])[0], NONE)) <= least[at]
            if early.any():
                # The number of such merges before each one, within its word.
                before = np.cumsum(early) - early
                head = np.append(True, word[at[1:]] != word[at[:-1]])
                keep = before == np.repeat(before[head], np.diff(np.append(np.flatnonzero(head), len(at))))
                at, made = at[keep], made[keep]

            gone = at + 1
            live[place[gone]] = False
            symbols[at] = made
            stay = np.ones(len(symbols), bool)
            stay[gone] = False
            now = np.cumsum(stay) - 1
            symbols, word, place, rank = symbols[stay], word[stay], place[stay], rank[stay]
            touched = np.zeros(len(symbols), bool)
            touched[now[at]] = touched[np.maximum(now[at] - 1, 0)] = True
            near = np.flatnonzero(touched)
            following = np.minimum(near + 1, len(symbols) - 1)
            rank[near] = np.where((near + 1 < len(symbols)) & (word[near] == word[following]), self.ranked(symbols[near], symbols[following])[0], NONE)
        where = np.flatnonzero(live)
        return out[where], where

    def resolve(self, parts: pa.Array) -> pa.Array:
        """The ids of each part, with spaces for marks, as little-endian unsigned 32-bit numbers."""
        _, data = flat(parts)
        begin = flat(parts)[0]
        data = data[begin[0] : begin[-1]]
        codes = np.frombuffer(data.tobytes().decode("utf-8").replace(" ", MARK).encode("utf-32-le"), np.uint32)
        heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # characters before each byte
        starts = heads[begin - begin[0]]
        symbols, where = self.merged(codes, starts[:-1])
        first = np.searchsorted(where, starts)
        spelt = (symbols < 0) | (symbols >= self.size)
        if spelt.any():  # characters that are no piece become their bytes
            of = [self.bytes[list((chr(UNKNOWN - s) if s < 0 else self._rare[s]).encode())] for s in symbols[spelt].tolist()]
            count = np.ones(len(symbols), np.int64)
            count[spelt] = [len(x) for x in of]
            ends = np.append(0, np.cumsum(count))
            ids = np.repeat(symbols, count)
            ids[np.repeat(spelt, count)] = np.concatenate(of)
            symbols, first = ids, ends[first]
        return ragged(first * 4, symbols.astype("<u4").view(np.uint8))

    def cuts(self, part: Slice) -> np.ndarray:
        """Where the parts of a slice's texts begin: at a space after something else, and at each full block of spaces
        that a space follows."""
        data, n = part.data, len(part.data)
        first = np.zeros(n + 1, bool)
        first[part.begin] = True
        if n and not self.inner_marks:
            space = data == 0x20
            head = space & np.append(True, ~space[:-1]) | space & first[:n]
            if self.run:
                at = np.arange(n)
                since = at - np.maximum.accumulate(np.where(head, at, -1))
                more = np.append(space[1:], False) & ~first[1:]
                head |= space & (since > 0) & (since % self.run == 0)
                # The last space of a run may belong to the word behind it: no block ends there.
                head &= ~(space & ~more & (since > 0))
            first[:n] |= head
        return np.flatnonzero(first[:n])


def _alternate(at: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row the first, the third and so on."""
    where = np.arange(len(at))
    start = np.maximum.accumulate(np.where(np.append(True, at[1:] != at[:-1] + 1), where, 0))
    return at[(where - start) % 2 == 0]


class PieceParts(TextParts):
    """TextParts, cut as pieces allow."""

    def __init__(self, pieces: Pieces):
        super().__init__(pieces.resolve, pa.binary())
        self.pieces = pieces

    def of(self, part: Slice) -> tuple[pa.Array, np.ndarray]:
        starts = self.pieces.cuts(part)
        coded = ragged(np.append(starts, len(part.data)), part.data, pa.string()).dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, value_set=self.known)
        lacks = pc.is_null(at).to_numpy(zero_copy_only=False)
        new = pa.concat_arrays([distinct.filter(pa.array(lacks))])
        fresh = self.resolve(new)
        place = np.where(lacks, len(self.values) + np.cumsum(lacks) - 1, at.fill_null(0).to_numpy(zero_copy_only=False))
        values = pa.concat_arrays([self.values, fresh])
        self._keep(new, fresh)
        return values.take(pa.array(place[coded.indices.to_numpy()])), np.searchsorted(starts, part.begin)


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoder(path: str, end: bool = True):
    """A text column -> binary arrays, one after another, of its texts' ids as little-endian unsigned 32-bit numbers."""
    model = pieces(path)
    parts = PieceParts(model)

    def encode(column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        column = pc.replace_substring(column, MARK, " ")
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))
        column = pc.if_else(pc.equal(pc.binary_length(column), 0), column, spaced)
        for part in slices(column, SLICE_BYTES):
            values, first = parts.of(part)
            begin, data = flat(values)
            begin, ids = begin[first].astype(np.int64), data.view("<u4")
            if end:
                ids = np.insert(ids, begin[1:] // 4, model.end)
                begin = begin + 4 * np.arange(len(begin))
            yield ragged(begin, ids.astype("<u4").view(np.uint8))

    return encode


def decoder(path: str):
    """A binary array of ids as little-endian unsigned 32-bit numbers -> the binary array of their texts in UTF-8.

    The space that was put before a text goes; bytes that are no UTF-8 become U+FFFD one by one.
    """
    model = pieces(path)

    def decode(ids: pa.Array) -> pa.Array:
        begin, data = flat(ids)
        where, out = flat(model.text.take(pa.array(data[begin[0] : begin[-1]].view("<u4"))))
        where = where[(begin - begin[0]) // 4]
        some = np.diff(where) > 0
        some[some] = out[where[:-1][some]] == 0x20
        keep = np.ones(len(out), bool)
        keep[where[:-1][some]] = False
        texts = ragged(where - np.append(0, np.cumsum(some)), out[keep])
        try:
            texts.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([t.decode("utf-8", "each_byte").encode() for t in texts.to_pylist()], pa.binary())
        return texts

    return decode


@tidy
def _encode(batches, path: str, end: bool):
    encode = encoder(path, end)
    for batch in batches:
        at = 0
        for ids in encode(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), ids], ["id", "ids"])
            at += len(ids)


@tidy
def _decode(batches, path: str):
    decode = decoder(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), decode(batch.column(1).fill_null(b"")).cast(pa.string())], ["id", "text"])


@tidy
def _digest(batches, path: str):
    encode, decode, model = encoder(path), decoder(path), pieces(path)
    for batch in batches:
        at = 0
        for ids in encode(batch.column(1)):
            begin, data = flat(ids)
            count = np.diff(begin) // 4
            where, digits = flat(model.decimal.take(pa.array(data.view("<u4"))))
            where, digits = where[begin // 4].tolist(), memoryview(digits)
            own = [hashlib.sha256(digits[a : b - 1]).hexdigest() for a, b in zip(where[:-1], where[1:], strict=True)]
            texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in decode(ids)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), pa.array(count.astype(np.int64)), pa.array(own, pa.string()), pa.array(texts, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
            at += len(ids)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """(id, ids) for every row of docs: ids as binary of little-endian unsigned 32-bit numbers, the end id last if wanted.

    Null texts count as empty and give the end id alone. Null ids and repeated rows are rows like others; other
    columns are not read; an empty table gives an empty result. A word of many thousand characters without a place to
    cut it costs a round for each score among its pairs, and no more memory than its characters.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_encode, path=path, end=end), f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for every row of encoded; null ids give an empty text."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_decode, path=path), f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of encode() and of decode() after it, in one pass.

    Rows are treated as in encode(). ids_sha256 is that of the decimal ids, the end id too, joined by one space.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_digest, path=path), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
