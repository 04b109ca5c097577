"""Byte-level BPE over texts: parts of texts by their bytes, pre-tokens, merges with a hierarchical-bitmap rank queue.

Vocabulary files stay where they are: every function takes a path. Two formats are read: ranks (base64 token and rank
a line) and JSON with vocabulary and merges.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from geoloom.llm.textvec import Slice

# The published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = regex.compile(PATTERN)

#: Bytes of text that are worked on at a time, bytes of parts that are kept for the next time, and the longest kept one.
SLICE_BYTES = 1 << 20
CACHE_BYTES = 2 << 20
CACHE_PART = 48
#: A bucket of so few entries is merged one by one, a fuller one at once. The order of merges is the same.
FEW = 24
#: The rank of a pair that doesn't merge.
NONE = 1 << 30

#: Bytes that begin a character which is certainly no white space, and those of them that are ASCII.
SOLID = np.ones(256, bool)
SOLID[[*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
ASCII_SOLID = SOLID & (np.arange(256) < 0x7F)


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a string or binary array begin (one number more), and their bytes."""
    _, where, values = array.buffers()
    begin = np.frombuffer(where, np.int32)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int32)
    return begin, np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)


def ragged(begin: np.ndarray, data: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The binary array, or one of this kind, of values that begin so (one number more) in data."""
    return pa.Array.from_buffers(kind or pa.binary(), len(begin) - 1, [None, pa.py_buffer(np.ascontiguousarray(begin, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class RankQueue:
    """Positions in buckets by merge rank; a hierarchy of 64-bit words marks the ranks that have any."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while True:
            ranks = -(-ranks // 64)
            self.levels.append([0] * ranks)
            if ranks <= 1:
                break

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.extend(positions)
            return
        self.buckets[rank] = positions
        for words in self.levels:
            word = rank >> 6
            was = words[word]
            words[word] = was | 1 << (rank & 63)
            if was:
                break
            rank = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank, by the first set bit of each level, and its bucket."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        at = rank
        for words in self.levels:
            word = at >> 6
            words[word] ^= 1 << (at & 63)
            if words[word]:
                break
            at = word
        return rank, self.buckets.pop(rank)


#: Parts of the key of a pair of ids.
SHIFT = 20


class Merges:
    """A vocabulary: ids of single bytes, the rank of each pair of ids (left << SHIFT | right), and a rank's result."""

    def __init__(self, byte_ids: Sequence[int], size: int, keys: np.ndarray, ranks: np.ndarray, results: Sequence[int]):
        self.size, self.wall = size, (1 << SHIFT) - 1
        order = np.argsort(keys)
        self._keys, self._ranks = np.append(keys[order], 1 << 62), np.append(ranks[order], NONE).astype(np.int32)
        self._keys_view, self._ranks_view = memoryview(self._keys), memoryview(self._ranks)
        self._bytes, self._results = np.array(byte_ids, np.int32), np.array(results, np.int32)
        each = np.arange(256)
        self._two_bytes = self._rank(self._bytes[each][:, None], self._bytes[each][None, :])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.asarray(left, np.int64) << SHIFT | right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], NONE)

    def merge(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens one after another, and where each one's begin (one number more).

        In each pre-token the pair of least rank merges first, the leftmost of equals. All pre-tokens stand in one
        linked list with walls between them, which no pair crosses, so one queue serves them all, however many or long
        they are. A bucket is merged at once where that can't differ from going left to right; entries whose pair has
        changed since they were queued are skipped as they come up.
        """
        begin, data = flat(pieces)
        data, sizes = data[begin[0] : begin[-1]], np.diff(begin)
        walls = np.append(0, np.cumsum(sizes + 1))
        n = int(walls[-1]) + 1
        here = np.ones(n, bool)
        here[walls] = False
        where = np.flatnonzero(here)
        ids = np.full(n, self.wall, np.int32)
        ids[where] = self._bytes[data]
        following, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        now = np.full(n, NONE, np.int32)
        if len(data) > 1:
            now[where[:-1]] = np.where(np.diff(where) == 1, self._two_bytes[data[:-1], data[1:]], NONE)
        queue = RankQueue(self.size)
        self._push(queue, now[where], where.astype(np.int32))
        views = [memoryview(x) for x in (ids, following, before, now)]
        while (least := queue.pop()) is not None:
            rank, bucket = least
            if len(bucket) <= FEW:
                self._merge_few(queue, rank, sorted(bucket), *views)
                continue
            at = np.sort(np.array(bucket, np.int32))
            at = at[now[at] == rank]
            if len(at):
                self._merge_many(queue, rank, at, walls, ids, following, before, now)
        live = (ids >= 0) & (ids != self.wall)
        return ids[live].astype("<u4"), np.append(0, np.cumsum(live))[walls]

    @staticmethod
    def _push(queue: RankQueue, ranks: np.ndarray, at: np.ndarray) -> None:
        live = ranks != NONE
        if not live.all():
            ranks, at = ranks[live], at[live]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        edge = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
        positions = at.tolist()
        for rank, a, b in zip(ranks[edge[:-1]].tolist(), edge[:-1], edge[1:], strict=True):
            queue.push(rank, positions[a:b])

    def _rank_one(self, left: int, right: int) -> int:
        key = left << SHIFT | right
        at = bisect_left(self._keys_view, key)
        return self._ranks_view[at] if self._keys_view[at] == key else NONE

    def _merge_few(self, queue: RankQueue, rank: int, bucket: list[int], ids, following, before, now) -> None:
        """Merge the pairs that begin at the bucket's positions, from left to right."""
        made = int(self._results[rank])
        for done, at in enumerate(bucket):
            if now[at] != rank:
                continue
            gone = following[at]
            left, right = before[at], following[gone]
            ids[at], ids[gone], now[gone] = made, -1, NONE
            following[at], before[right] = right, at
            one = now[left] = self._rank_one(ids[left], made)
            two = now[at] = self._rank_one(made, ids[right])
            if one != NONE:
                queue.push(one, [left])
            if two != NONE:
                queue.push(two, [at])
            if (one <= rank or two <= rank) and done + 1 < len(bucket):
                queue.push(rank, bucket[done + 1 :])  # a new pair goes before the rest of this bucket
                return

    def _merge_many(self, queue: RankQueue, rank: int, every: np.ndarray, walls, ids, following, before, now) -> None:
        """Merge the pairs that begin at every, which hold this rank in ascending order."""
        at = _alternate(every, following)
        made = self._results[rank]
        while True:
            gone = following[at]
            right = following[gone]
            left = before[at]
            left_id = ids[left]
            beside = right[:-1] == at[1:]  # the pair before ends where this one begins
            if beside.any():
                left[1:][beside] = at[:-1][beside]
                left_id[1:][beside] = made
            both = self._rank(np.concatenate((left_id, np.full(len(at), made))), np.concatenate((np.full(len(at), made), ids[right])))
            one, two = both[: len(at)], both[len(at) :]
            early = np.minimum(one, two) <= rank
            if not early.any() or len(at) == 1:
                break
            # A new pair goes before the rest of this bucket: in such a pre-token only the first pair merges now.
            owner = np.searchsorted(walls, every)
            apart = np.isin(owner, np.searchsorted(walls, at[early]))
            first = np.ones(len(every), bool)
            first[1:] = owner[1:] != owner[:-1]
            if not (apart & ~first).any():
                break
            queue.push(rank, every[apart & ~first].tolist())
            every = every[~apart | first]
            at = _alternate(every, following)
        ids[at], ids[gone], now[gone] = made, -1, NONE
        following[at], before[right] = right, at
        if beside.any():
            two[:-1][beside] = one[1:][beside]
            one, left = one[np.append(True, ~beside)], left[np.append(True, ~beside)]
        now[left], now[at] = one, two
        self._push(queue, np.concatenate((one, two)), np.concatenate((left, at)))


def _alternate(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row the first, the third and so on."""
    linked = following[at[:-1]] == at[1:]
    if not linked.any():
        return at
    where = np.arange(len(at))
    start = np.maximum.accumulate(np.where(np.append(True, ~linked), where, 0))
    return at[(where - start) % 2 == 0]


class RankMerges(Merges):
    """A rank file: the rank of a token is its id, and two tokens merge if their bytes together are a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        keys, ranks = [], []
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << SHIFT | right)
                    ranks.append(rank)
        size = max(ids.values()) + 1
        by_id = {i: token for token, i in ids.items()}
        #: The bytes of each id; an id that no token has is null.
        self.tokens = pa.array([by_id.get(i) for i in range(size)], pa.binary())
        super().__init__([ids[bytes([b])] for b in range(256)], size, np.array(keys, np.int64), np.array(ranks, np.int64), range(size))

    def resolve(self, parts: pa.Array) -> pa.Array:
        """The ids of each part as little-endian unsigned 32-bit numbers; a pre-token that is a token stays whole."""
        pieces, of, first = pieces_of(parts)
        whole = pc.index_in(pieces, value_set=self.tokens)
        rest = pc.is_null(whole)
        ids, begin = self.merge(pieces.filter(rest))
        values = pa.concat_arrays([ragged(begin * 4, ids.view(np.uint8)), ragged(np.arange(self.size + 1) * 4, np.arange(self.size, dtype="<u4").view(np.uint8))])
        merged = np.cumsum(rest.to_numpy(zero_copy_only=False)) - 1
        place = np.where(rest.to_numpy(zero_copy_only=False), merged, whole.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + len(begin) - 1)
        taken, data = flat(values.take(pa.array(place[of])))
        return ragged(taken[first], data)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in JSON vocabularies: printable Latin-1 for itself, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class JsonMerges(Merges):
    """A JSON file with vocabulary and merges; special tokens are in specials."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        letters = byte_letters()
        vocabulary = model["model"]["vocab"]
        self.vocabulary = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in self.specials}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        keys = np.array([vocabulary[a] << SHIFT | vocabulary[b] for a, b in merges], np.int64)
        of = {b: vocabulary[c] for c, b in letters.items()}
        super().__init__([of[b] for b in range(256)], len(merges), keys, np.arange(len(merges)), [vocabulary[a + b] for a, b in merges])


@lru_cache(maxsize=1)
def rank_merges(path: str) -> RankMerges:
    return RankMerges(path)


@lru_cache(maxsize=1)
def json_merges(path: str) -> JsonMerges:
    return JsonMerges(path)


def cuts(part: Slice, specials: Iterable[str] = ()) -> np.ndarray:
    """Where the parts of a slice's texts begin in its bytes: no pre-token crosses such a place, and the pre-tokens of a
    text are those of its parts.

    A text is cut before a space that something solid follows, and before and after a line end between solid
    characters. Special strings are parts of their own; a space before one belongs to the white space before it.
    """
    data = part.data
    n = len(data)
    at, head = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    head[part.begin] = True  # follows nothing
    if n:
        solid = SOLID[data] & ~head[:n]
        at[: n - 1] = (data[:-1] == 0x20) & solid[1:]
        line = (data[1:] == 0x0A) & ASCII_SOLID[data[:-1]] & ~head[1:n]
        at[1:n] |= line
        at[2:n] |= line[:-1] & solid[2:]
    whole = [s.encode() for s in sorted(specials, key=len, reverse=True)]
    if whole:
        text = data.tobytes()
        found = [(m.start(), m.end()) for m in re.finditer(b"|".join(map(re.escape, whole)), text)] if any(s in text for s in whole) else []
        found = [(a, b) for a, b in found if np.searchsorted(part.begin, a, "right") == np.searchsorted(part.begin, b, "left")]
        for a, _ in found:
            if a and data[a - 1] == 0x20:
                at[a - 1] = False
        for a, b in found:
            at[[a, b]] = True
    return np.flatnonzero((at | head)[:n])


def pieces_of(parts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of parts, which of them each part's are, and where each part's begin (one number more)."""
    begin, data = flat(parts)
    sizes = np.diff(begin)
    second = np.minimum(begin[:-1] + 1, max(len(data) - 1, 0))
    spaced = (sizes > 1) & (data[begin[:-1]] == 0x20) & SOLID[data[second]] if len(data) else np.zeros(len(sizes), bool)
    # Parts that begin at a space stand together as one text; others are split each by itself.
    texts = ["".join(parts.filter(pa.array(spaced)).to_pylist()), *parts.filter(pa.array(~spaced)).to_pylist()]
    found = pa.array([p for text in texts for p in PIECES.findall(text)], pa.string())
    ends = np.cumsum(np.diff(flat(found)[0]))
    order = np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced)))
    stops = np.searchsorted(ends, np.cumsum(sizes[order])) + 1
    counts = np.diff(stops, prepend=0)
    coded = found.dictionary_encode()
    of = coded.indices.to_numpy()
    number, starts = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    number[order], starts[order] = counts, stops - counts
    first = np.append(0, np.cumsum(number))
    return coded.dictionary.cast(pa.binary()), of[np.arange(first[-1]) + np.repeat(starts - first[:-1], number)], first


class TextParts:
    """Values of the parts of texts, where equal parts are worked out once.

    resolve gives the values of an array of distinct parts. Those of short parts are kept for the next slices as long as
    they are not too many.
    """

    def __init__(self, resolve: Callable[[pa.Array], pa.Array], kind: pa.DataType, specials: Iterable[str] = (), cache_bytes: int = CACHE_BYTES):
        self.resolve, self.specials, self.cache_bytes = resolve, tuple(specials), cache_bytes
        self.known, self.values = pa.array([], pa.string()), pa.array([], kind)

    def of(self, part: Slice) -> tuple[pa.Array, np.ndarray]:
        """The values of all parts of a slice, and which is the first of each text (one number more)."""
        starts = cuts(part, self.specials)
        coded = ragged(np.append(starts, len(part.data)), part.data, pa.string()).dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, value_set=self.known)
        missing = pc.is_null(at)
        new = pa.concat_arrays([distinct.filter(missing)])
        fresh = self.resolve(new)
        values = pa.concat_arrays([self.values, fresh])
        lacks = missing.to_numpy(zero_copy_only=False)
        place = np.where(lacks, len(self.values) + np.cumsum(lacks) - 1, at.fill_null(0).to_numpy(zero_copy_only=False))
        self._keep(new, fresh)
        return values.take(pa.array(place[coded.indices.to_numpy()])), np.searchsorted(starts, part.begin)

    def _keep(self, new: pa.Array, fresh: pa.Array) -> None:
        short = pc.less_equal(pc.binary_length(new), CACHE_PART)
        new, fresh = new.filter(short), fresh.filter(short)
        if self.known.nbytes + new.nbytes <= self.cache_bytes:
            new, fresh = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.values, fresh])
        if new.nbytes <= self.cache_bytes:
            self.known, self.values = new, fresh
