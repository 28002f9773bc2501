"""Byte-level BPE: numpy pre-tokenisation without regular expressions, cached pair merging, decoding by offsets.

Where a piece of text begins depends on the classes of the characters so far, that is on a small automaton. Its
transition functions, one per symbol, are closed under composition, and composition is associative; so a scan over
function numbers gives the state before every character. The scan runs over the rows of a matrix: along all rows at
once, then over the rows' totals.

The pieces are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import batch, chunks, ship

_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
#: The white space of Unicode.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols: a character's class with what follows it. BEFORE: white space before something else; WHITE: before more white
# space or the end; SHORT and LONG: an apostrophe before s t m d, or before re ve ll.
_SYMBOLS = ("letter", "number", "other", "space_before", "white_before", "white", "short", "long")
# States: what the piece that is open can still take.
_CLOSED, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _AFTER_SPACE, _IN_WHITE, _TWO_MORE, _ONE_MORE = range(8)


def _step(state: int, symbol: str) -> tuple[int, bool]:
    """The state after a character, and whether a piece begins before it."""
    kind = {"short": "other", "long": "other"}.get(symbol, symbol)
    if symbol == "letter" and state in (_TWO_MORE, _ONE_MORE):
        return (_ONE_MORE if state == _TWO_MORE else _CLOSED), False
    run = {"letter": _IN_LETTERS, "number": _IN_NUMBERS, "other": _IN_OTHERS}.get(kind)
    if run is not None:
        joins = state in (run, _AFTER_SPACE)
        if not joins and symbol in ("short", "long"):
            return (_ONE_MORE if symbol == "short" else _TWO_MORE), True
        return run, not joins
    if symbol == "white":
        return _IN_WHITE, state != _IN_WHITE
    return (_AFTER_SPACE if symbol == "space_before" else _CLOSED), True


def _closure():
    """All compositions of the symbols' transition functions: functions by number, and the table of composition.

    Symbol n + 8 is symbol n as a text's first character: it forgets the state before.
    """
    base = [tuple(_step(q, s)[0] for q in range(8)) for s in _SYMBOLS]
    base += [(f[0],) * 8 for f in base]
    known = {tuple(range(8)): 0}
    for f in base:
        known.setdefault(f, len(known))
    grown = list(known)
    for f in grown:
        for g in base:
            h = tuple(g[q] for q in f)
            if h not in known:
                known[h] = len(known)
                grown.append(h)
    then = np.array([[known[tuple(g[q] for q in f)] for g in grown] for f in grown], np.int16)
    return np.array(grown, np.int8), then, np.array([known[f] for f in base], np.int16)


_FUNCTIONS, _THEN, _OF_SYMBOL = _closure()
_BEGINS = np.array([[_step(q, s)[1] for s in _SYMBOLS] for q in range(8)])


def states_before(symbols: np.ndarray, width: int = 256) -> np.ndarray:
    """The state before each character, by a scan of composed transition functions. The first symbol is a first one."""
    n, kinds, flat = len(symbols), len(_FUNCTIONS), _THEN.ravel()
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.int16)
    np.take(_OF_SYMBOL, symbols, out=grid[:n])
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):  # within each row of the text
        np.take(flat, grid[j - 1] * np.int16(kinds) + grid[j], out=grid[j], mode="clip")
    total, step = grid[-1].copy(), 1
    while step < rows:  # over the rows' totals, doubling
        total[step:] = _THEN[total[:-step], total[step:]]
        step *= 2
    carried = np.zeros(rows, np.int16)
    carried[1:] = _FUNCTIONS[total[:-1], _CLOSED]
    after = np.take(_FUNCTIONS.ravel(), grid * np.int16(8) + carried, mode="clip").T.ravel()[:n]
    return np.concatenate([np.zeros(1, np.int8), after[:-1]])


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point, in the version of Unicode that the installed tokenizer library has."""
    import tiktoken

    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    for kind, category in ((_LETTER, "L"), (_NUMBER, "N")):
        # With single bytes for tokens, encoding keeps just the characters that match.
        only = tiktoken.Encoding(category, pat_str=rf"\p{{{category}}}", mergeable_ranks=single, special_tokens={})
        members = bytes(only.encode_ordinary(every)).decode()
        table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    table[_WHITE] = _SPACE
    return table


def piece_bounds(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which pieces begin in the joined UTF-8 of texts, and for each text how many lie before it."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(points)
    lengths = np.array([len(t) for t in texts])
    firsts = np.cumsum(lengths) - lengths
    kind = _classes()[points]
    ends = np.zeros(n + 1, bool)
    ends[firsts] = True
    ends[n] = True
    ends = ends[1:]  # the text ends behind this character
    following = np.append(kind[1:], _SPACE)
    symbols = kind.copy()
    white = kind == _SPACE
    before = white & (following != _SPACE) & ~ends
    symbols[white] = 5
    symbols[before] = 4
    symbols[before & (points == 0x20)] = 3
    at = np.flatnonzero((points == 0x27) & ~ends)
    one = points[at + 1]
    symbols[at[np.isin(one, [115, 116, 109, 100])]] = 6
    at = at[(at + 2 < n)]
    at = at[~ends[at + 1]]
    pair = points[at + 1].astype(np.int64) * 256 + points[np.minimum(at + 2, n - 1)]
    symbols[at[np.isin(pair, [114 * 256 + 101, 118 * 256 + 101, 108 * 256 + 108]) & (points[at + 1] < 256) & (points[at + 2] < 256)]] = 7
    first = np.zeros(n, bool)
    first[firsts[lengths > 0]] = True
    begins = _BEGINS[states_before(symbols + 8 * first), symbols] | first
    size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    where = np.flatnonzero(begins)
    return (np.cumsum(size) - size)[where], np.searchsorted(where, np.append(firsts, n))


class Bpe:
    """A vocabulary of byte strings by rank. Ids of short pieces are kept, at most ``KEPT`` of them."""

    KEPT, LONGEST = 1 << 18, 64

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int32)
        self.kept: dict[bytes, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the neighbours of lowest rank are merged first, the leftmost of equals before others."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= self.LONGEST:
            return self._merge_short(piece)
        ranks, n = self.ranks, len(piece)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))  # the parts' ends, and where the part before begins
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(queue)
        gone = bytearray(n)
        while queue:
            _, i, end = heappop(queue)
            j = after[i]
            if gone[i] or j >= n or after[j] != end:
                continue
            gone[j] = 1
            after[i] = end
            if end < n:
                ahead[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heappush(queue, (r, i, after[end]))
            if (p := ahead[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heappush(queue, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def _merge_short(self, piece: bytes) -> list[int]:
        """The same without a queue, which only pays for long pieces."""
        ranks, none, n = self.ranks, len(self.tokens), len(piece)
        bounds = list(range(n + 1))
        pairs = [ranks.get(piece[i : i + 2], none) for i in range(n - 1)]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            del bounds[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(piece[bounds[i] : bounds[i + 2]], none)
            if i:
                pairs[i - 1] = ranks.get(piece[bounds[i - 1] : bounds[i + 1]], none)
        return [ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        starts, cuts = piece_bounds(texts)
        data = "".join(texts).encode()
        bounds = [*starts.tolist(), len(data)]
        out, kept = [], self.kept
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            ids: list[int] = []
            begin = bounds[a]
            for end in bounds[a + 1 : b + 1]:
                piece = data[begin:end]
                begin = end
                known = kept.get(piece)
                if known is None:
                    known = self.merge(piece)
                    if len(piece) <= self.LONGEST:
                        if len(kept) >= self.KEPT:
                            kept.clear()
                        kept[piece] = known
                ids += known
            out.append(ids)
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte of the text at which each token begins, and the text's length at the end."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def load(path: str) -> Bpe:
    return Bpe(path)


ENCODED = pa.schema([("ids", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64()))])


def _encoded(column: pa.Array, bpe: Bpe) -> Iterator[list[np.ndarray]]:
    """The ids of a batch of texts, about a megabyte of text at a time."""
    for texts in chunks(column):
        yield [np.array(ids, np.int64) for ids in bpe.encode([t.decode("utf-8", "replace") for t in texts])]


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, offsets) of each row: token ids, and the byte of the text at which each begins, with the length last.

    No special tokens: their strings are ordinary text. Null and empty texts have no ids and the one offset 0. Other columns
    are not read; rows and ids may repeat; an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def tokens(batches):
        bpe = load(path)
        for part in batches:
            at = 0
            for ids in _encoded(part.column(1), bpe):
                lists = [pa.array(x, f.type) for x, f in zip((ids, [bpe.offsets(i) for i in ids]), ENCODED)]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(at, len(ids)), *lists], names=[id, *ENCODED.names])
                at += len(ids)

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(tokens, f"`{id}` {kind}, ids array<int>, offsets array<bigint>")


def decode(encoded: DataFrame, path: str, start=None, end=None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its tokens from ``start`` up to ``end`` (columns or numbers of tokens).

    Null ids decode to null, none to empty bytes.
    """
    ship(encoded.sparkSession)

    def words(ids, first, last):
        bpe = load(path)
        return type(ids)([None if i is None else bpe.decode(i[a:b]) for i, a, b in zip(ids, first, last)], dtype=object)

    first = F.lit(0) if start is None else (F.lit(start) if isinstance(start, int) else start)
    last = F.size("ids") if end is None else (F.lit(end) if isinstance(end, int) else end)
    return encoded.withColumn("decoded", F.pandas_udf(words, "binary")("ids", first.cast("int"), last.cast("int")))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Each document's number of tokens and digests of its ids and of its decoded bytes, without moving ids between tasks."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digests(batches):
        bpe = load(path)
        for part in batches:
            rows = [
                (len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(bpe.decode(ids.tolist())).hexdigest())
                for some in _encoded(part.column(1), bpe)
                for ids in some
            ]
            yield batch(schema, part.column(0), *(zip(*rows) if rows else ([], [], [])))

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
