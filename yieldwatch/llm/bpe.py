"""Byte-level BPE encoding and decoding with a given vocabulary.

Texts are cut into pieces without a regular expression. Every code point gets a symbol (its
class, and for spaces and apostrophes what follows them); a symbol is a function from
scanner state to scanner state. Composing functions is associative, so a text is cut into
stretches whose functions are composed side by side, a prefix scan over the stretches gives
the state at which each begins, and a second pass marks the positions where a piece starts.
Pieces are merged by rank through a cache; the byte offset of every token is kept, and
decoding writes each token's bytes at its offset.

The pieces are those of the common pattern of such vocabularies: contractions
('s 't 're 've 'm 'll 'd), letters, digits or other signs with at most one space before
them, and runs of white space less a last one that belongs to what follows.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.llm.columns import without
from yieldwatch.llm.words import parts, text_buffer

#: A vocabulary is sent to every executor, so its size is checked.
MOST_VOCABULARY_BYTES = 64 << 20
#: Pieces whose merges are remembered by a worker; a full cache starts anew.
CACHED_PIECES = 100_000
#: Longer pieces are merged with a heap.
SHORT_PIECE = 128
STRETCH = 128
PART = 1 << 20

# The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

LETTER, DIGIT, SIGN, SPACE = 0, 1, 2, 3
# Symbols: a letter, a digit, another sign, an apostrophe that a contraction of one or two
# letters may follow, a blank before something else, other white space before something else, other white space.
A_LETTER, A_DIGIT, A_SIGN, SHORT, LONG, BLANK, GAP, WHITE = range(8)
SYMBOLS = 8
# States: a piece must start; in letters, digits, signs or white space; after a blank that
# joins what follows; one or two letters of a contraction are left.
FRESH, LETTERS, DIGITS, SIGNS, WHITES, JOINED, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this code point."""
    if symbol in (BLANK, GAP):
        return (JOINED if symbol == BLANK else FRESH), True
    if symbol == WHITE:
        return WHITES, state != WHITES
    if symbol == A_LETTER and state == TWO_LEFT:
        return ONE_LEFT, False
    if symbol == A_LETTER and state == ONE_LEFT:
        return FRESH, False
    kind = {A_LETTER: LETTERS, A_DIGIT: DIGITS}.get(symbol, SIGNS)
    goes_on = state in (kind, JOINED)
    if symbol in (SHORT, LONG) and not goes_on:
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    return kind, not goes_on


@cache
def _tables() -> dict[str, np.ndarray]:
    """Code point classes, the scanner's steps, and the functions that symbols compose to.

    Symbols from SYMBOLS on are the same at the start of a text, where the state before
    does not count.
    """
    white = set(WHITE_SPACE)
    kinds = {"L": LETTER, "N": DIGIT}
    classes = np.full(0x110000, SIGN, dtype=np.uint8)
    for point in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            classes[point] = kind
    classes[list(white)] = SPACE

    after = np.zeros((STATES, 2 * SYMBOLS), dtype=np.uint8)
    starts = np.zeros((STATES, 2 * SYMBOLS), dtype=bool)
    for state in range(STATES):
        for symbol in range(2 * SYMBOLS):
            first = symbol >= SYMBOLS
            after[state, symbol], starts[state, symbol] = _step(FRESH if first else state, symbol % SYMBOLS)

    identity = tuple(range(STATES))
    functions, number = [identity], {identity: 0}
    by_symbol: list[list[int]] = []
    at = 0
    while at < len(functions):
        row = []
        for symbol in range(2 * SYMBOLS):
            then = tuple(int(after[state, symbol]) for state in functions[at])
            if then not in number:
                number[then] = len(functions)
                functions.append(then)
            row.append(number[then])
        by_symbol.append(row)
        at += 1
    table = np.array(functions, dtype=np.uint8)
    return {
        "classes": classes,
        "after": after,
        "starts": starts,
        "functions": table,
        "by_symbol": np.array(by_symbol, dtype=np.int32),
    }


def _symbols(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The symbol of each code point; `first` marks where texts start, with one more for the end."""
    kind = classes[points]
    inner = ~first[1:]  # the next code point belongs to the same text
    following = np.empty_like(kind)
    following[:-1], following[-1] = kind[1:], SPACE
    before_other = inner & (following != SPACE)
    symbols = kind.copy()
    white = kind == SPACE
    symbols[white] = WHITE
    symbols[white & before_other] = GAP
    symbols[before_other & (points == 32)] = BLANK
    quotes = np.flatnonzero((points == 39) & inner)
    if len(quotes):
        one = points[quotes + 1]
        symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        quotes = quotes[quotes + 2 < len(points)]
        quotes = quotes[inner[quotes + 1]]
        one, two = points[quotes + 1], points[quotes + 2]
        fits = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        symbols[quotes[fits]] = LONG
    return symbols + SYMBOLS * first[:-1].astype(np.uint8)


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece starts. points: code points of texts in a row, not empty.
    first: True where a text starts, and at the end."""
    t = _tables()
    symbols = _symbols(points, first, t["classes"])
    n = len(symbols)
    rows = -(-n // STRETCH)
    padded = np.zeros(rows * STRETCH, dtype=np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, STRETCH).T)

    by_symbol, width = t["by_symbol"].ravel(), 2 * SYMBOLS
    composed = np.zeros(rows, dtype=np.int32)
    for column in columns:
        composed = by_symbol[composed * width + column]

    # Scan over the stretches: after step k a row holds the function of its last 2**k stretches.
    maps = t["functions"][composed]
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
        reach *= 2
    state = np.zeros(rows, dtype=np.int32)
    state[1:] = maps[:-1, FRESH]

    after, starts = t["after"].ravel(), t["starts"].ravel()
    out = np.empty((STRETCH, rows), dtype=bool)
    for k, column in enumerate(columns):
        cell = state * width + column
        out[k] = starts[cell]
        state = after[cell].astype(np.int32)
    return out.T.ravel()[:n]


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        content = lines.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: the adjacent pair of lowest rank is joined, again and again."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    cuts = _cuts_short(piece, ranks) if len(piece) <= SHORT_PIECE else _cuts_long(piece, ranks)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def _cuts_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    get, none = ranks.get, 1 << 62
    cuts = list(range(len(piece) + 1))
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return cuts


def _cuts_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """A heap finds the next pair, so a very long piece takes n log n steps."""
    n = len(piece)
    ends = list(range(1, n + 1))  # the end of the part that starts here, or 0 if none does
    before = list(range(-1, n - 1))
    waiting = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            waiting.append((rank, i, i + 2))
    heapq.heapify(waiting)
    while waiting:
        _, i, end = heapq.heappop(waiting)
        middle = ends[i]
        if not middle or middle >= n or ends[middle] != end:
            continue  # one of the two parts has changed since
        ends[i], ends[middle] = end, 0
        if end < n:
            before[end] = i
            rank = ranks.get(piece[i : ends[end]])
            if rank is not None:
                heapq.heappush(waiting, (rank, i, ends[end]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:end])
            if rank is not None:
                heapq.heappush(waiting, (rank, left, end))
    return [i for i in range(n) if ends[i]] + [n]


class Encoder:
    """Ranks and remembered pieces of one worker."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.known: dict[str, bytes] = {}
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(token) for token in tokens], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def ids(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            found = np.array(merge(piece.encode(), self.ranks), dtype="<u4").tobytes()
            if len(piece) <= 64:
                self.known[piece] = found
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        out: list[bytes] = []
        data, offsets = text_buffer(texts)
        for low, high in parts(offsets, PART):
            part = data[offsets[low] : offsets[high]].tobytes().decode()
            if not part:
                out.extend([b""] * (high - low))
                continue
            points = np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32)
            # Code points before each text: bytes that do not go on a code point.
            own = (data[offsets[low] : offsets[high]] & 0xC0) != 0x80
            seen = np.concatenate([[0], np.cumsum(own)])
            text_at = seen[offsets[low : high + 1] - offsets[low]]
            first = np.zeros(len(points) + 1, dtype=bool)
            first[text_at] = True
            starts = np.flatnonzero(piece_starts(points, first))
            bounds = starts.tolist() + [len(points)]
            pieces = [part[a:b] for a, b in zip(bounds, bounds[1:])]
            get, ids = self.known.get, self.ids
            encoded = [get(piece) or ids(piece) for piece in pieces]
            at = np.searchsorted(starts, text_at).tolist()
            out.extend(b"".join(encoded[a:b]) for a, b in zip(at, at[1:]))
        return out

    def offsets(self, ids: bytes) -> bytes:
        """Where each token's bytes start in the text, as little-endian 32-bit numbers."""
        sizes = self.lengths[np.frombuffer(ids, dtype="<u4")]
        return (np.cumsum(sizes) - sizes).astype("<u4").tobytes()

    def decode(self, ids: bytes, offsets: bytes) -> bytes:
        """The bytes of all tokens, each written at its offset."""
        tokens = np.frombuffer(ids, dtype="<u4")
        if not len(tokens):
            return b""
        if int(tokens.max()) >= len(self.lengths):
            raise ValueError(f"{int(tokens.max())} is not an id of this vocabulary")
        places = np.frombuffer(offsets, dtype="<u4").astype(np.int64)
        sizes = self.lengths[tokens]
        total = int(places[-1] + sizes[-1])
        source = np.arange(total) + np.repeat(self.begins[tokens] - places, sizes)
        return self.bytes[source].tobytes()


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each vocabulary and worker."""
    if shared.value["key"] not in _encoders:
        _encoders[shared.value["key"]] = Encoder(shared.value["ranks"])
    return _encoders[shared.value["key"]]


def _shared_ranks(df: DataFrame, path: str):
    """The rank file, read once by the driver (its size is checked) and sent to the executors."""
    ranks = read_ranks(path)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{path} has no token for {len(missing)} bytes")
    return df.sparkSession.sparkContext.broadcast({"key": hash(frozenset(ranks.items())), "ranks": ranks})


def encode(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "token_ids",
    offsets: str = "token_offsets",
    decoded: str | None = None,
) -> DataFrame:
    """`df` with `ids`, `offsets` and n_tokens, and in `decoded` the bytes that the ids give
    back; columns of these names are replaced.

    ids holds little-endian unsigned 32-bit numbers, offsets the byte at which each token
    starts, in the same form. Null and empty texts get no tokens, equal texts equal ids; a
    text of any length is encoded whole. No shuffle, no state between rows: rows stream
    through in parts of about a megabyte.
    """
    shared = _shared_ranks(df, path)
    made = [ids, offsets, "n_tokens"] + ([decoded] if decoded else [])
    rest = without(df, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            _, places = text_buffer(column)
            for low, high in parts(places, PART):
                coded = encoder.encode(column.slice(low, high - low))
                starts = [encoder.offsets(x) for x in coded]
                columns = [batch.column(name).slice(low, high - low) for name in rest]
                columns += [pa.array(coded, pa.binary()), pa.array(starts, pa.binary())]
                columns.append(pa.array([len(x) // 4 for x in coded], pa.int64()))
                if decoded:
                    columns.append(pa.array([encoder.decode(x, o) for x, o in zip(coded, starts)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=rest + made)

    schema = T.StructType([df.schema[c] for c in rest])
    schema.add(ids, T.BinaryType()).add(offsets, T.BinaryType()).add("n_tokens", T.LongType())
    if decoded:
        schema.add(decoded, T.BinaryType())
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "token_ids", offsets: str = "token_offsets", out: str = "decoded") -> DataFrame:
    """`df` with the bytes of `ids` in the column `out`, which is replaced if there.

    Null ids give null. An id beyond the vocabulary is an error.
    """
    shared = _shared_ranks(df, path)

    @F.arrow_udf("binary")
    def run(ids: pa.Array, offsets: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        both = zip(ids.to_pylist(), offsets.to_pylist())
        return pa.array([None if x is None else encoder.decode(x, o) for x, o in both], pa.binary())

    return df.select(*without(df, [out]), run(F.col(ids), F.col(offsets)).alias(out))


def unpack_ids(ids: str | Column) -> Column:
    """array<bigint> of packed ids, for readers that want numbers."""

    @F.arrow_udf("array<bigint>")
    def run(ids: pa.Array) -> pa.Array:
        unpacked = [None if x is None else np.frombuffer(x, dtype="<u4").astype(np.int64).tolist() for x in ids.to_pylist()]
        return pa.array(unpacked, pa.list_(pa.int64()))

    return run(ids)
