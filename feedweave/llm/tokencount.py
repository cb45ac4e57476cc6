"""Token counts by a finite-state transducer compiled from a tokenizer file.

The transducer reads the bytes of a word. Its states are made when a text first needs them:
a state is all that the merge rules still depend on, and a transition is annotated with the tokens it adds.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.common import bounded_batches, materialise

# Characters of a chunk of a long text.
CHUNK_CHARS = 32_768
# Distinct pieces, states and token pairs a task remembers before it starts anew.
REMEMBERED_PIECES = 400_000
REMEMBERED_STATES = 150_000
REMEMBERED_PAIRS = 300_000

# What the tokenizer's splitter takes for white space (Unicode White_Space).
SPACES = "\t\n\v\f\r \x85\xa0  -     　"
_SPACE = regex.compile(f"[{SPACES}]+")
_LAST_SPACE = regex.compile(f"(?r)[{SPACES}]")
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
# str.split() takes these for white space as well, the tokenizer does not.
_SEPARATORS = regex.compile("[\x1c-\x1f]")

# Symbols 0 to 255 are bytes inside a word, 256 to 511 the last byte of a word.
LAST = 256


def _byte_of_character() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: themselves, or the next free code point from 256 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(others)}


class State(dict):
    """A state of the transducer: by symbol the next state and the tokens added, made at first use."""

    __slots__ = ("places", "owner")

    def __init__(self, places: tuple, owner: Transducer):
        self.places, self.owner = places, owner

    def __missing__(self, symbol: int) -> tuple[State, int]:
        made = self[symbol] = self.owner.step(self.places, symbol)
        return made


class Transducer:
    """A deterministic transducer from the symbols of a word to its number of tokens.

    A state holds, for every position from which a token may still reach beyond the symbols
    read, the place in the tree of tokens, the last token of the encoding up to that position,
    and its number of tokens relative to now. The next symbol closes the one token that
    the merge rules leave beside the last token before it: two tokens may stand side by side if
    their joined symbols merge to exactly these two. Weights may be negative, where a symbol joins earlier tokens.
    """

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        byte = _byte_of_character()
        self.symbols: dict[int, tuple[int, ...]] = {}
        self.child: dict[int, int] = {}
        self.inner: set[int] = {0}
        self.token_at: dict[int, int] = {}
        nodes = 1
        for text, number in tokens.items():
            closed = text.endswith(word_end) and text != word_end
            spelled = [byte[c] for c in (text.removesuffix(word_end) if closed else text)]
            if closed:
                spelled[-1] += LAST
            self.symbols[number] = tuple(spelled)
            node = 0
            for s in spelled:
                self.inner.add(node)
                key = node << 9 | s
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.token_at[node] = number
        self.single = {s[0]: t for t, s in self.symbols.items() if len(s) == 1}
        self.merge = {}
        for rank, (left, right) in enumerate(merges):
            self.merge[tokens[left], tokens[right]] = (rank, tokens[left + right])
        self.beside: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Drop the states made so far."""
        # place in the tree, last token before it or -1, its count relative to now
        start = ((0, -1, 0),)
        self.states = {start: State(start, self)}
        self.start = self.states[start]
        if len(self.beside) > REMEMBERED_PAIRS:
            self.beside.clear()

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """Tokens of a short run of symbols by the merge rules: lowest rank first, the leftmost of equals."""
        out = [self.single[s] for s in symbols]
        while len(out) > 1:
            open_pairs = [(self.merge[pair], at) for at, pair in enumerate(zip(out, out[1:])) if pair in self.merge]
            if not open_pairs:
                break
            (_, token), at = min(open_pairs)
            out[at : at + 2] = [token]
        return out

    def may_stand(self, left: int, right: int) -> bool:
        """Whether the merge rules leave ``right`` as it is beside ``left``, or at the start of a word (-1)."""
        known = self.beside.get((left, right))
        if known is None:
            before = (left,) if left >= 0 else ()
            symbols = tuple(s for token in (*before, right) for s in self.symbols[token])
            known = self.beside[left, right] = self.merged(symbols) == [*before, right]
        return known

    def step(self, places: tuple[tuple[int, int, int], ...], symbol: int) -> tuple[State, int]:
        """Make a transition: the next state and the number of tokens it adds."""
        after = [(self.child.get(node << 9 | symbol), last, count) for node, last, count in places]
        for node, last, count in after:
            token = self.token_at.get(node)
            if token is not None and self.may_stand(last, token):
                added = count + 1
                break
        else:
            raise ValueError(f"the vocabulary has no token for symbol {symbol}")
        kept = (*((node, last, count - added) for node, last, count in after if node in self.inner), (0, token, 0))
        found = self.states.get(kept)
        if found is None:
            found = self.states[kept] = State(kept, self)
        return found, added

    def count(self, word: bytes) -> int:
        """Tokens of one word: the sum of the weights along its path."""
        if len(self.states) > REMEMBERED_STATES:
            self.forget()
        state, total = self.start, 0
        for symbol in word[:-1]:
            state, added = state[symbol]
            total += added
        return total + state[word[-1] + LAST][1]


class PieceCounts(dict):
    """Token counts of pieces of text without white space, by the transducer of a tokenizer file.

    White space ends every word and belongs to none, so the transducer is in its first
    state after it whatever came before: the map of a chunk's states is given by what it reads up to its
    first white space, the tokens from there on, and what it has read since its last.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        special = {t["content"] for t in spec["added_tokens"]}
        plain = {text: number for text, number in model["vocab"].items() if text not in special}
        self.transducer = Transducer(plain, merges, model["end_of_word_suffix"])
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.path = path

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED_PIECES:
            self.clear()
        total, run = 0, self.transducer.count
        for k, part in enumerate(self.special.split(piece) if self.special.search(piece) else (piece,)):
            if k % 2:
                total += 1
            elif part:
                for word in self.words(part):
                    total += run(word.encode())
        if len(piece) <= 64:
            self[piece] = total
        return total

    def words(self, part: str) -> list[str]:
        """Normalised words: composed, lower case, cut at changes between letters, digits and other characters."""
        if not part.isascii():
            if any(unicodedata.category(c) == "Cn" for c in part):
                return _words_by_library(self.path, part)
            # the tokenizer's lower case is that of each character for itself
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        return _WORD.findall(part.lower())

    def pieces(self, text: str) -> list[str]:
        """What stands between white space; empty ones are left out."""
        return text.split() if not _SEPARATORS.search(text) else [p for p in _SPACE.split(text) if p]

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """What a chunk reads before its first white space, its tokens between first and last, what it reads after its last.

        Without white space the chunk is all head, and there is no count.
        """
        first = _SPACE.search(chunk)
        if first is None:
            return chunk, None, ""
        last = _LAST_SPACE.search(chunk).end()
        return chunk[: first.start()], self.count(chunk[first.start() : last]), chunk[last:]

    def compose(self, maps: list[tuple[str, int | None, str]]) -> tuple[str, int | None, str]:
        """The map of neighbouring chunks from theirs; composing is associative."""
        head, total, open_parts = [], None, []
        for first, tokens, last in maps:
            if tokens is None:
                (head if total is None else open_parts).append(first)
            elif total is None:
                head.append(first)
                total, open_parts = tokens, [last]
            else:
                total += self.count("".join((*open_parts, first))) + tokens
                open_parts = [last]
        return "".join(head), total, "".join(open_parts)

    def run(self, head: str, tokens: int | None, tail: str) -> int:
        """Tokens of a whole text from its map, read from the first state on."""
        return self.count(head) + (tokens or 0) + self.count(tail)


@lru_cache(maxsize=2)
def piece_counts(path: str) -> PieceCounts:
    """The counter of a file; Python workers keep it from task to task."""
    return PieceCounts(path)


@lru_cache(maxsize=1)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _words_by_library(path: str, part: str) -> list[str]:
    """Words of a part with characters that Python's Unicode tables do not know; the tokenizer's tables may."""
    rules = _library(path)
    byte = _byte_of_character()
    split = rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(part))
    return [bytes(byte[c] for c in word).decode() for word, _ in split]


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Replace the whole text of every row by its number of tokens.

    ``path`` is a tokenizer file with byte-level merges and word ends that every executor can read. Strings of
    its special tokens count one token each, as in its library; there are no begin, end or padding
    tokens and no limit. Null and empty texts have none; repeated rows repeat. Other columns stay, one called ``out``
    is replaced.

    Texts of up to ``chunk_chars`` characters are one chunk, counted where they are read. Longer texts are cut into
    chunks that tasks share; each chunk gives the map of the transducer's states, and neighbouring maps
    are composed in rounds of ``RUN`` until a text has one. Only its words cut by chunk ends are read again.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c.lower() != out.lower()])
    others = [c for c in docs.columns if c != text]
    long = F.coalesce(F.char_length(F.col(text)), F.lit(0)) > chunk_chars
    schema = docs.select(*others).schema.add(out, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        for batch in batches:
            found = [counts.count(t) if t else 0 for t in batch.column(len(others)).to_pylist()]
            columns = [*batch.columns[: len(others)], pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, out])

    short = docs.where(~long).select(*others, text).mapInArrow(count, schema)
    return short.unionByName(_count_long(docs.where(long), path, text, others, out, chunk_chars))


# Neighbouring maps composed at once.
RUN = 64
_MAP = "row long, at long, head string, tokens long, tail string"


def _count_long(docs: DataFrame, path: str, text: str, others: list[str], out: str, chunk_chars: int) -> DataFrame:
    held = materialise(docs.select(F.struct(*others).alias("others"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")), "long_texts")
    chunks = held.select("row", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))).alias("at", "chunk"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        for batch in batches:
            maps = [counts.state_map(c) for c in batch.column(2).to_pylist()]
            yield _maps(batch.column(0), batch.column(1).cast(pa.int64()), maps)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        key, run = None, []
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            done = []
            for row, at, *state in rows:
                if (row, at // RUN) != key:
                    if run:
                        done.append((*key, counts.compose(run)))
                    key, run = (row, at // RUN), []
                run.append(state)
            if done:
                yield _maps(*(pa.array(x, pa.int64()) for x in list(zip(*done))[:2]), [d[2] for d in done])
        if run:
            yield _maps(pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), [counts.compose(run)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path)
        for batch in batches:
            found = [counts.run(*state) for state in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["row", "found"])

    longest = held.agg(F.max(F.char_length("text"))).first()[0] or 0
    maps = chunks.repartition("row", "at").mapInArrow(read, _MAP)
    left = -(-longest // chunk_chars)
    while left > 1:
        run = (F.col("at") / RUN).cast("long")
        maps = maps.repartition(F.col("row"), run).sortWithinPartitions("row", "at").mapInArrow(join, _MAP)
        left = -(-left // RUN)
    found = maps.mapInArrow(finish, "row long, found long")
    joined = held.select("row", "others").join(found, "row")
    return joined.select("others.*", F.col("found").alias(out))


def _maps(row: pa.Array, at: pa.Array, maps: list[tuple[str, int | None, str]]) -> pa.RecordBatch:
    head, tokens, tail = zip(*maps) if maps else ((), (), ())
    columns = [row, at, pa.array(head, pa.string()), pa.array(tokens, pa.int64()), pa.array(tail, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["row", "at", "head", "tokens", "tail"])
