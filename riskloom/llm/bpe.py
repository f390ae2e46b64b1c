"""Byte-level BPE by merge ranks: encoding as a tree of joins, decoding as a tree of concatenations.

Encoded texts form a monoid: the join of two is the encoding of the two texts put together. A text is
encoded by halves, down to leaves of ``LEAF`` characters, and the halves are joined:

* The split into pieces before merging settles at safe cuts: between a letter and what is no letter, a
  digit and what is no digit, and before white space. No alternative of the pattern runs over such a
  place, and none that ends there reads on, so pieces on either side of it depend on that side alone.
  The join looks for the nearest safe cuts around the boundary, further and further out, and only what
  lies between them is encoded again; ids outside stay.
* A piece that runs over the boundary is joined token by token: a window of tokens around the boundary
  is merged again and grows, on the side that needs it, until the tokens next to it and its own end
  tokens are what merging just those two would give. Tokens outside are then settled, because a row
  of tokens is the encoding of its bytes exactly if each two neighbours are that of theirs.

Defined results: a null text is the empty text and has no ids. Ids are in the order of the text; the
decoded bytes are its UTF-8 form. A piece that is itself a token is that token, as in the library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Recent, slices, with_fields
from riskloom.llm.tokens import TextEncoder, id_kind, ranks

LEAF = 1024
#: Bytes merged by a scan for the best pair; longer runs use a heap.
SHORT = 64
#: Stands for the rank of a pair that no merge makes; above all ranks.
NEVER = 1 << 60
#: The same in tables of 32-bit ids.
NEVER_32 = np.iinfo(np.int32).max
#: Characters searched for a blank before the other safe cuts are tried.
NEAR = 256
_CUT = r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}])(?=\s)"
_FIRST_CUT, _LAST_CUT = regex.compile(_CUT), regex.compile(f"(?r){_CUT}")


def _without(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row without its element at one place."""
    keep = np.ones(rows.shape, bool)
    keep[np.arange(len(rows)), at] = False
    return rows[keep].reshape(len(rows), rows.shape[1] - 1)


class Encoder:
    """Ids of texts by a rank file and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks(path)
        self.bytes = dict(zip(self.ranks.values(), self.ranks.keys(), strict=True))
        self.pattern = regex.compile(pattern)
        # A word of letters, with or without a blank before it, is one piece.
        self.words = TextEncoder(self._pieces, id_kind(max(self.bytes)), lambda word: self.piece(word.encode()), self._words)
        # Numbers and marks, which are met inside many words; longer pieces are not remembered.
        self._short = Recent(lambda piece: self.piece(piece.encode()))
        self._settled = Recent(lambda pair: self.merge(self.bytes[pair[0]] + self.bytes[pair[1]]) == list(pair))

    # Bytes of one piece

    def merge(self, piece: bytes) -> list[int]:
        """Merge the pair of lowest rank (of equal ones the first), as long as there is one."""
        if len(piece) > SHORT:
            return self._merge_long(piece)
        ranked, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranked.get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) != NEVER:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            # Only the pairs on either side of the new part have changed.
            if at < len(pairs):
                pairs[at] = ranked.get(parts[at] + parts[at + 1], NEVER)
            if at:
                pairs[at - 1] = ranked.get(parts[at - 1] + parts[at], NEVER)
        return [ranked[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs; entries whose parts have changed since are skipped."""
        ranked, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                rank = ranked.get(piece[i : end[end[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[i], end[end[i]]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != middle or middle >= n or not alive[middle] or end[middle] != stop:
                continue
            alive[middle], end[i] = False, stop
            if stop < n:
                before[stop] = i
            offer(i)
            offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranked[piece[i : end[i]]])
            i = end[i]
        return out

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of tokens whose bytes make a token, as one number in order, and that token."""
        size, found = self._pad + 1, {}
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                left, right = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if left is not None and right is not None:
                    found[left * size + right] = rank
        keys = np.array(sorted(found), np.int64)
        return keys, np.array([found[k] for k in keys.tolist()], np.int32)

    @cached_property
    def _pad(self) -> int:
        """No token: fills rows behind their end."""
        return max(self.bytes) + 1

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, made = self._pairs
        wanted = left.astype(np.int64) * (self._pad + 1) + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, made[at], NEVER_32)

    def merge_many(self, pieces: Sequence[bytes]) -> list[bytes]:
        """``merge`` of pieces, none of them empty, side by side: a step merges the best pair of every piece that has one.

        Ids are given as bytes, as the memory of words holds them. The rows of the table are as long as the longest piece, so pieces should be of similar length.
        """
        out, kind = [b""] * len(pieces), self.words.kind
        if not pieces:
            return out
        width = max(map(len, pieces))
        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = single[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)].reshape(-1, width)
        tokens[np.arange(width) >= np.array(list(map(len, pieces)))[:, None]] = self._pad
        pairs = self._pair_ranks(tokens[:, :-1], tokens[:, 1:])
        number = np.arange(len(pieces))
        while True:
            row = np.arange(len(tokens))
            # The first of the least, as a scan from the left finds it.
            at = pairs.argmin(axis=1) if pairs.shape[1] else np.zeros(len(tokens), np.int64)
            best = pairs[row, at] if pairs.shape[1] else np.full(len(tokens), NEVER_32)
            ready = best == NEVER_32
            if ready.any():
                size = kind.itemsize
                ends = (tokens[ready] != self._pad).sum(axis=1) * size
                ids, begins = tokens[ready].astype(kind).tobytes(), np.arange(len(ends)) * (tokens.shape[1] * size)
                for i, begin, end in zip(number[ready].tolist(), begins.tolist(), (begins + ends).tolist(), strict=True):
                    out[i] = ids[begin:end]
                tokens, pairs, number, at, best = (x[~ready] for x in (tokens, pairs, number, at, best))
                if not len(tokens):
                    break
                row = np.arange(len(tokens))
            tokens[row, at] = best
            tokens, pairs = _without(tokens, at + 1), _without(pairs, at)
            # Only the pairs on either side of the new token have changed.
            i = np.nonzero(at < pairs.shape[1])[0]
            pairs[i, at[i]] = self._pair_ranks(tokens[i, at[i]], tokens[i, at[i] + 1])
            i = np.nonzero(at > 0)[0]
            pairs[i, at[i] - 1] = self._pair_ranks(tokens[i, at[i] - 1], tokens[i, at[i]])
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """``piece`` of many words, as bytes."""
        pieces = [word.encode() for word in words]
        whole = [self.ranks.get(p) for p in pieces]
        merged = iter(self.merge_many([p for p, w in zip(pieces, whole, strict=True) if w is None]))
        return [next(merged) if w is None else np.array([w], self.words.kind).tobytes() for w in whole]

    def settled(self, left: int, right: int) -> bool:
        """Whether merging the bytes of the two tokens gives the two."""
        return self._settled[left, right]

    def join_tokens(self, left: Sequence[int], right: Sequence[int]) -> list[int]:
        """The merged bytes of two runs, from the tokens of each."""
        left, right = list(left), list(right)
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        i, j = 1, 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join(self.bytes[t] for t in left[len(left) - i :] + right[:j]))
            left_holds = i == len(left) or self.settled(left[-i - 1], window[0])
            right_holds = j == len(right) or self.settled(window[-1], right[j])
            if left_holds and right_holds:
                return left[: len(left) - i] + window + right[j:]
            i, j = (i if left_holds else 2 * i), (j if right_holds else 2 * j)

    def piece(self, piece: bytes) -> list[int]:
        """A whole piece; a long one by halves."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self._halves(piece)

    def _halves(self, run: bytes) -> list[int]:
        if len(run) <= LEAF:
            return self.merge(run)
        middle = len(run) // 2
        return self.join_tokens(self._halves(run[:middle]), self._halves(run[middle:]))

    def _pieces(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self._short[p]]

    # Texts

    def _last_cut(self, text: str) -> int:
        """The last safe cut inside the text; 0 if there is none."""
        at = text.rfind(" ", max(1, len(text) - NEAR))
        while at > 0 and text[at - 1].isspace():
            at = text.rfind(" ", 1, at)
        if at > 0:
            return at
        found = _LAST_CUT.search(text, 0, len(text))
        while found and found.start() >= len(text):
            found = _LAST_CUT.search(text, 0, len(text) - 1)
            if found and not regex.match(_CUT, text, pos=found.start()):
                found = None
        return found.start() if found else 0

    def _first_cut(self, text: str) -> int:
        """The first safe cut inside the text; its length if there is none."""
        at = text.find(" ", 1, NEAR)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1, NEAR)
        if at > 0:
            return at
        found = _FIRST_CUT.search(text)
        return found.start() if found else len(text)

    def _tokens_of(self, ids: Iterator[int], size: int) -> int:
        """How many of the ids make up so many bytes."""
        count = 0
        while size > 0:
            size -= len(self.bytes[next(ids)])
            count += 1
        if size:
            raise ValueError("a safe cut inside a token")
        return count

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """Ids of ``left + right`` from the ids of both."""
        if not left or not right:
            return left_ids if left else right_ids
        if right[0] == " " and not left[-1].isspace():
            return np.concatenate([left_ids, right_ids])
        low, high = self._last_cut(left), self._first_cut(right)
        tail, head = left[low:], right[:high]
        dropped = self._tokens_of(map(int, left_ids[::-1]), len(tail.encode()))
        taken = self._tokens_of(map(int, right_ids), len(head.encode()))
        kept = len(left_ids) - dropped
        if len(tail) + len(head) > LEAF and all(len(self.pattern.findall(t)) == 1 for t in (tail, head, tail + head)):
            whole = self.ranks.get((tail + head).encode())
            between = [whole] if whole is not None else self.join_tokens(left_ids[kept:].tolist(), right_ids[:taken].tolist())
            between = np.array(between, left_ids.dtype)
        else:
            between = self.words.ids(tail + head)
        return np.concatenate([left_ids[:kept], between, right_ids[taken:]])

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LEAF:
            return self.words.ids(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    @cached_property
    def _spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens one after another, and where each id's begin and how many they are."""
        tokens = [self.bytes.get(i, b"") for i in range(self._pad)]
        lengths = np.array(list(map(len, tokens)))
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= LEAF:
            spelled, begins, lengths = self._spelled
            ids = np.asarray(ids, np.int64)
            sizes = lengths[ids]
            ends = np.cumsum(sizes)
            # Each byte's place: its token's begin, and its own place in the token.
            return spelled[np.repeat(begins[ids] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Replace the text by its ``ids``; all other columns stay."""
    others = [c for c in df.columns if c not in (text, "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            own.words.learn(texts)
            found = list(map(own.encode, texts))
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], ids], names=[*others, "ids"])

    schema = with_fields(df.select(*others), "ids array<int>")
    return df.select(F.col(text).cast("string"), *others).mapInArrow(run, schema)


def decoded(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the bytes of the ids; null for null ids."""
    others = [c for c in df.columns if c not in (ids, "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(path, pattern).decode
        for batch in slices(batches):
            listed = batch.column(batch.num_columns - 1)
            flat, ends = listed.values.to_numpy(zero_copy_only=False), listed.offsets.to_numpy()
            known = listed.is_valid().to_numpy(zero_copy_only=False)
            found = [decode(flat[a:b]) if k else None for a, b, k in zip(ends[:-1], ends[1:], known, strict=True)]
            data = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, data], names=[*others, ids, "decoded"])

    return df.select(*others, ids).mapInArrow(run, with_fields(df.select(*others, ids), "decoded binary"))
