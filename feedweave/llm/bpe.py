"""Byte-level BPE: corpus-level merge replay over an inverted index, and decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from feedweave.llm.common import bounded_batches

# Texts replayed together, in bytes, and distinct words a task remembers before it starts anew.
BLOCK_BYTES = 8 << 20
REMEMBERED_WORDS = 500_000


class Ranks:
    """The merge ranks of a vocabulary file, with lookups for whole arrays of pairs.

    A pair of tokens merges if its joined bytes are a token; the pair's rank is
    that token's. The file is a list of Base64 tokens with their ranks.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.full(256, -1, np.int64)
        pairs: dict[int, int] = {}
        # tokens after whose creation a pair of lower rank may arise
        self.back: set[int] = set()
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte[token[0]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
                    self.back.update(part for part in (left, right) if part > rank)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary must hold all 256 single bytes")
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[k] for k in self._keys.tolist()], np.int64)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair does not merge or a side is missing (-1)."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._ranks[at], -1)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as file:
        return Ranks({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)})


def _leftmost(at: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The first position of each word; positions are in ascending order."""
    of = word[at]
    return at[np.concatenate([[True], of[1:] != of[:-1]])]


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after the other, and where each word starts.

    All symbols of all words lie in one array linked to their neighbours. The
    index lists, for every rank, the positions whose pair has this rank. Ranks
    are taken in ascending order from a heap; one step merges all positions of a
    rank in all words and re-ranks only the pairs beside the merged symbols. A
    later merge can create a pair of lower rank; the heap then goes back to it,
    and at ranks after which this can happen only the leftmost position of each
    word is merged per step, which keeps the order of a word-by-word encoder.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate([[0], np.cumsum(size)])
    n = int(start[-1])
    tok = np.full(n + 1, -1, np.int64)
    tok[:n] = ranks.byte[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), size)
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    filled = size > 0
    nxt[start[1:][filled] - 1] = n  # the last symbol of a word has no right neighbour
    prv[start[:-1][filled]] = n
    rank_at = np.full(n + 1, -1, np.int64)
    rank_at[:n] = ranks.pair_ranks(tok[:n], tok[nxt[:n]])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray, of: np.ndarray) -> None:
        order = np.argsort(of, kind="stable")
        at, of = at[order], of[order]
        cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
        firsts = np.concatenate([[0], cuts])
        for rank, a, b in zip(of[firsts].tolist(), firsts.tolist(), [*cuts.tolist(), len(of)]):
            listed = index.get(rank)
            if listed is None:
                index[rank] = [at[a:b]]
                heapq.heappush(heap, rank)
            else:
                listed.append(at[a:b])

    some = np.flatnonzero(rank_at >= 0)
    if len(some):
        enter(some, rank_at[some])
    while heap:
        rank = heapq.heappop(heap)
        listed = index.pop(rank)
        at = listed[0] if len(listed) == 1 else np.concatenate(listed)
        at = np.unique(at[rank_at[at] == rank])
        if not len(at):
            continue
        if rank in ranks.back:
            first = _leftmost(at, word)
            if len(first) < len(at):
                index[rank] = [np.setdiff1d(at, first, assume_unique=True)]
                heapq.heappush(heap, rank)
            at = first
        elif len(at) > 1:
            # of overlapping pairs, every other one merges, from the left
            chained = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
            if chained.any():
                i = np.arange(len(at))
                at = at[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        tok[at], tok[gone] = rank, -1
        nxt[at], prv[after] = after, at
        rank_at[gone] = -1
        near = np.concatenate([at, prv[at]])
        near = near[near < n]
        near = near[tok[near] >= 0]
        fresh = ranks.pair_ranks(tok[near], tok[nxt[near]])
        rank_at[near] = fresh
        if (merging := fresh >= 0).any():
            enter(near[merging], fresh[merging])
    kept = np.flatnonzero(tok[:n] >= 0)
    return tok[kept].astype(np.int32), np.searchsorted(kept, start)


class _Vocabulary(dict):
    """Numbers words in the order they are first seen."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Encoder:
    """Encodes blocks of texts; every distinct word of a task is replayed once."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.find = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.words = _Vocabulary()
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Add the tokens of new words: whole tokens as they are, all others by replay."""
        whole = [self.ranks.ranks.get(w) for w in new]
        ids, starts = replay([b"" if t is not None else w for w, t in zip(new, whole)], self.ranks)
        direct = np.array([t is not None for t in whole], bool)
        counts = np.where(direct, 1, np.diff(starts))
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), np.int32)
        is_direct = np.repeat(direct, counts)
        out[is_direct] = np.array([t for t in whole if t is not None], np.int32)
        out[~is_direct] = ids
        self.ids = np.concatenate([self.ids, out])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """Token ids of each text; a null text is empty."""
        if len(self.words) > REMEMBERED_WORDS:
            self._forget()
        known = len(self.words)
        number = self.words.__getitem__
        rows = [np.fromiter(map(number, self.find(t)), np.int64) if t else np.empty(0, np.int64) for t in texts]
        if len(self.words) > known:
            self._learn([w.encode() for w in list(self.words)[known:]])
        offsets, flat = [0], []
        for row in rows:
            first, count = self.starts[row], self.starts[row + 1] - self.starts[row]
            total = int(count.sum())
            shift = np.repeat(first - (np.cumsum(count) - count), count)
            flat.append(self.ids[shift + np.arange(total)])
            offsets.append(offsets[-1] + total)
        values = np.concatenate([*flat, np.empty(0, np.int32)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _without(df: DataFrame, out: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c.lower() != out.lower()])


def _encoded(batches: Iterator[pa.RecordBatch], at: int, path: str, pattern: str) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """Each batch with the token ids of its texts (column ``at``), replayed in blocks of bounded bytes."""
    encoder = Encoder(path, pattern)

    def flush(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
        tokens = encoder.encode([t for b in held for t in b.column(at).to_pylist()])
        done = 0
        for b in held:
            yield b, tokens.slice(done, b.num_rows)
            done += b.num_rows

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(at).nbytes
        if size >= BLOCK_BYTES:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """Add the token ids of every whole text, as an array of ints.

    The text is cut into the matches of ``pattern``; each match is encoded on its
    own by the ranks of the file at ``ranks_path``, which every executor must be able to
    read. There are no special tokens: their strings are ordinary text. Null and
    empty texts have no tokens; repeated rows repeat. Other columns stay, one
    called ``out`` is replaced.

    Replay runs over blocks of documents with bounded bytes, so neither the words
    of the corpus nor its texts meet in one place and nothing is shuffled; words
    are independent of each other, so the blocks do not show in the result.
    """
    bounded_batches(docs.sparkSession)
    rest = _without(docs, out)
    at = rest.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _encoded(batches, at, ranks_path, pattern):
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=[*batch.schema.names, out])

    schema = StructType([*rest.schema.fields]).add(out, ArrayType(IntegerType(), False), False)
    return rest.mapInArrow(add, schema)


def _decoded(column: pa.ListArray, ranks: Ranks) -> list[bytes]:
    """The bytes of each list of token ids."""
    flat = column.flatten()
    ids = flat.to_numpy(zero_copy_only=False) if not flat.null_count else np.array([-1])
    if len(ids) and (ids.min() < 0 or ids.max() >= len(ranks.tokens)):
        raise ValueError("a token id is not in the vocabulary")
    ids = ids.astype(np.int64)
    count = ranks.lengths[ids]
    ends = np.cumsum(count)
    shift = np.repeat(ranks.starts[ids] - (ends - count), count)
    data = ranks.bytes[shift + np.arange(len(shift))].tobytes()
    per_row = np.diff(np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())]))
    upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_row)])].tolist()
    return [data[a:b] for a, b in zip(upto, upto[1:])]


def decode(docs: DataFrame, ranks_path: str, tokens: str = "tokens", out: str = "decoded") -> DataFrame:
    """Add the bytes that the token ids of each row stand for.

    Null token lists decode to no bytes. An id outside the vocabulary, or a null id,
    raises an error. Other columns stay, one called ``out`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    rest = _without(docs, out)
    at = rest.columns.index(tokens)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            decoded = pa.array(_decoded(batch.column(at), ranks), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, out])

    return rest.mapInArrow(join, StructType([*rest.schema.fields]).add(out, BinaryType(), False))


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", with_tokens: bool = True) -> DataFrame:
    """Encode every whole text, decode the ids again, and replace the text by the digests of both.

    Adds ``tokens`` (unless ``with_tokens`` is false), ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256`` (of the decoded bytes); columns with these names are replaced. Texts are treated as by ``encode``. One
    Python pass does all of it: neither texts nor decoded bytes go back to the JVM.
    """
    bounded_batches(docs.sparkSession)
    added = ["tokens"] * with_tokens + ["n_tokens", "ids_sha256", "decoded_sha256"]
    others = [c for c in docs.columns if c != text and c.lower() not in added]
    rest = docs.select(*others, text)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        decimal = np.array([str(k) for k in range(len(ranks.tokens))], object)
        for batch, tokens in _encoded(batches, len(others), ranks_path, pattern):
            flat, ends = tokens.flatten().to_numpy(), np.cumsum(tokens.value_lengths().to_numpy()).tolist()
            ids = [_sha256(" ".join(decimal[flat[a:b]].tolist()).encode()) for a, b in zip([0, *ends], ends)]
            columns = [pa.array(ids, pa.string()), pa.array(list(map(_sha256, _decoded(tokens, ranks))), pa.string())]
            columns = [tokens] * with_tokens + [tokens.value_lengths().cast(pa.int64()), *columns]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *columns], names=[*others, *added])

    schema = StructType([*rest.select(*others).schema.fields])
    if with_tokens:
        schema = schema.add("tokens", ArrayType(IntegerType(), False), False)
    schema = schema.add("n_tokens", LongType(), False).add("ids_sha256", StringType(), False).add("decoded_sha256", StringType(), False)
    return rest.mapInArrow(digest, schema)
