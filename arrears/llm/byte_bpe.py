"""Byte-level BPE encoding and decoding of whole texts, merges driven by a hierarchical-bitmap rank queue.

A pre-token that is a token itself has that id. Any other starts as its bytes, a linked list of one-byte tokens, and
the lowest-ranked pair of neighbours, of equal ones the leftmost, is merged until no pair is a token. The pairs wait in
buckets, one per rank, that hold positions in the linked list. A bitmap marks the ranks whose buckets hold anything, a
bitmap above it marks its non-empty words, and so on up to one word, so the next rank is found by one find-first-set
per level. A merge changes the two pairs beside it; their old entries stay in their buckets and are skipped as stale
when they come up, which shows in the rank now kept for that position. So a pre-token of n bytes costs O(n log n) time
and O(n) memory however its merges lie, and needs no limit of length.

Many short pre-tokens share one list and one queue, set apart by a slot that pairs with nothing: the lowest rank of all
is the lowest rank of each word that has it, so each word sees its merges in its own order. Of a large bucket the
leftmost positions of all words are merged at once, the rest waits for the next visit.

Texts never leave their partition: there is no shuffle. A worker remembers the ids of short pre-tokens and empties that
table when it holds ``KNOWN_WORDS``, which changes time only.

Rules: a null text is the empty text; empty texts give no ids; no string is a special token; whole texts are encoded,
whatever their length; repeated rows are encoded alike; an empty table gives an empty result. Letters, digits and white
space are those of the library's own Unicode tables (``library_classes``). Columns beside the text pass through
untouched under any name.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

KNOWN_WORDS = 600_000
SHORT = 64  # bytes of a pre-token that shares a list with others and may be remembered
AT_ONCE = 24  # bucket entries from which the leftmost of all words are merged at once
WORD_BITS = 64
NEVER = -1
CHUNK_CHARS = 1 << 23
# Classes as the library's patterns write them, as this pattern engine does, and a code point of that class in both.
CLASSES = {r"\p{L}": (r"\p{L}", "\u4e00"), r"\p{N}": (r"\p{N}", "\u0663"), r"\s": (r"\p{White_Space}", "\u2003")}
OTHER = "\u2603"


class RankQueue:
    """Buckets of list positions by merge rank under a hierarchy of bitmaps.

    ``levels[0]`` has one bit per rank, each level above one bit per word of the level below, the last is one word. A
    bucket is a heap of positions, except while it is loose: added to in bulk since it was last opened.
    """

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []
        while True:
            ranks = -(-max(1, ranks) // WORD_BITS)
            self.levels.append([0] * ranks)
            if ranks == 1:
                break
        self.buckets: dict[int, list[int]] = {}
        self.loose: set[int] = set()

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        elif rank in self.loose:
            bucket.append(position)
        else:
            heapq.heappush(bucket, position)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Many entries at once; those without a rank are left out."""
        held = ranks != NEVER
        ranks, positions = ranks[held], positions[held]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order].tolist()
        starts = np.flatnonzero(np.diff(ranks, prepend=NEVER)).tolist()
        buckets = self.buckets
        for rank, start, end in zip(ranks[starts].tolist(), starts, [*starts[1:], len(positions)]):
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = positions[start:end]
                self._mark(rank)
            else:
                bucket += positions[start:end]
            self.loose.add(rank)

    def _mark(self, rank: int) -> None:
        for level in self.levels:
            word, bit = divmod(rank, WORD_BITS)
            before = level[word]
            level[word] = before | 1 << bit
            if before:
                return
            rank = word

    def first(self) -> int:
        """The lowest rank whose bucket holds anything, ``NEVER`` if none does."""
        at = 0
        for level in reversed(self.levels):
            bits = level[at]
            if not bits:
                return NEVER
            at = at * WORD_BITS + (bits & -bits).bit_length() - 1
        return at

    def open(self, rank: int) -> list[int]:
        """The bucket of a marked rank as a heap, smallest position first; whoever empties it closes it."""
        bucket = self.buckets[rank]
        if rank in self.loose:
            self.loose.remove(rank)
            bucket.sort()
        return bucket

    def close(self, rank: int) -> None:
        """Drop a bucket and its marks."""
        del self.buckets[rank]
        for level in self.levels:
            word, bit = divmod(rank, WORD_BITS)
            level[word] &= ~(1 << bit)
            if level[word]:
                return
            rank = word


class Ranks:
    """A rank file as lookups for encoding and decoding; bounded by the file (some 50,000 entries)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.of = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        if any(bytes([b]) not in self.of for b in range(256)):
            raise ValueError("every byte must be a token")
        self.size = 1 + max(self.of.values())
        self.names = [b""] * self.size
        for token, rank in self.of.items():
            self.names[rank] = token
        self.pattern = pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.odd = odd_letters()
        # Every way to put a token together from two: the key of the pair and the rank of the whole, sorted by key.
        made = sorted((left * self.step + right, rank) for token, rank in self.of.items() for cut in range(1, len(token))
                      if (left := self.of.get(token[:cut])) is not None
                      and (right := self.of.get(token[cut:])) is not None)
        self.pairs, self.ranks = np.array(made, np.int64).reshape(-1, 2).T.copy()
        self.byte = np.array([self.of[bytes([b])] for b in range(256)], np.int32)

    @property
    def step(self) -> int:
        """Times which the left id of a pair enters its key; the largest id stands for the border between words."""
        return self.size + 1

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, ``NEVER`` for what is no token."""
        key = left.astype(np.int64) * self.step + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NEVER).astype(np.int32)


def library_classes() -> dict[str, set[int]]:
    """The code points that the reference library's pattern engine counts to each class, asked once.

    An encoding that knows nothing but bytes, split by the class alone, gives back what it matched.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    return {name: set(map(ord, bytes(tiktoken.Encoding(
        "classes", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(everything)).decode()))
        for name in CLASSES}


def odd_letters() -> dict[int, str]:
    """Code points that the two Unicode tables class differently, each with a stand-in of the library's class."""
    told = library_classes()
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    own = {name: set(map(ord, regex.findall(prop, everything))) for name, (prop, _) in CLASSES.items()}
    odd = set().union(*(told[name] ^ own[name] for name in CLASSES))
    return {point: next((sign for name, (_, sign) in CLASSES.items() if point in told[name]), OTHER) for point in odd}


class Chain:
    """Words as one linked list of tokens, merged by the rank queue. Slots before, between and after words hold a
    border that pairs with nothing; arrays and their NumPy views share memory."""

    def __init__(self, ranks: Ranks, words: list[bytes]):
        self.ranks = ranks
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(sizes + 1) - sizes  # slot 0 is a border
        size = int(sizes.sum()) + len(words) + 1
        token = np.full(size, ranks.size, np.int32)
        inside = np.ones(size, bool)
        inside[0] = False
        inside[self.starts + sizes] = False
        token[inside] = ranks.byte[np.frombuffer(b"".join(words), np.uint8)]
        self.word = np.repeat(np.arange(len(words) + 1, dtype=np.int32), np.append(1, sizes + 1)) \
            if len(words) > 1 else None
        pair = np.full(size, NEVER, np.int32)
        pair[:-1] = ranks.rank_of(token[:-1], token[1:])
        self.token, self.pair = array("i", token.tobytes()), array("i", pair.tobytes())
        self.after, self.before = array("i", range(1, size + 1)), array("i", range(-1, size - 1))
        self.np_token, self.np_pair, self.np_after, self.np_before = (
            np.frombuffer(a, np.int32) for a in (self.token, self.pair, self.after, self.before))
        self.queue = RankQueue(ranks.size)
        self.queue.push_all(pair, np.arange(size))

    def merge(self, known: dict[int, int]) -> None:
        """Merge until no pair is a token; ``known`` gives the ranks of single pairs by key."""
        queue = self.queue
        while (rank := queue.first()) != NEVER:
            bucket = queue.open(rank)
            if self.word is not None and len(bucket) >= AT_ONCE:
                self._at_once(rank, bucket)
            else:
                self._one_by_one(rank, bucket, known)

    def _one_by_one(self, rank: int, bucket: list[int], known: dict[int, int]) -> None:
        token, pair, after, before = self.token, self.pair, self.after, self.before
        step, queue, of = self.ranks.step, self.queue, known.get
        lower = False
        while bucket and not lower:
            at = heapq.heappop(bucket)
            if pair[at] != rank:
                continue  # stale: one of the two was merged with another neighbour since
            gone = after[at]
            end, left = after[gone], before[at]
            pair[gone] = NEVER
            token[at] = rank
            after[at] = end
            before[end] = at
            new = pair[at] = of(rank * step + token[end], NEVER)
            if new != NEVER:
                queue.push(new, at)
                lower = new < rank
            new = pair[left] = of(token[left] * step + rank, NEVER)
            if new != NEVER:
                queue.push(new, left)
                lower = lower or new < rank
        if not bucket:
            queue.close(rank)

    def _at_once(self, rank: int, bucket: list[int]) -> None:
        """Merge the leftmost entry of each word; words do not touch, so their merges do not either."""
        token, pair, after, before = self.np_token, self.np_pair, self.np_after, self.np_before
        places = np.array(bucket)
        places = places[pair[places] == rank]
        first = np.diff(self.word[places], prepend=-1) != 0
        self.queue.buckets[rank] = places[~first].tolist()
        places = places[first]
        gone = after[places]
        end, left = after[gone], before[places]
        pair[gone] = NEVER
        token[places] = rank
        after[places] = end
        before[end] = places
        for at, new in ((places, self.ranks.rank_of(token[places], token[end])),
                        (left, self.ranks.rank_of(token[left], token[places]))):
            pair[at] = new
            self.queue.push_all(new, at)
        if not self.queue.buckets[rank]:
            self.queue.close(rank)

    def ids(self) -> list[bytes]:
        """The ids of each word, packed as 32-bit little-endian."""
        token = self.np_token
        held = np.ones(len(token), bool)
        held[0] = False
        alive = self.np_before[self.np_after[:-1]] == np.arange(len(token) - 1)
        held[:-1] &= alive
        held &= token != self.ranks.size
        ends = np.cumsum(held)
        bounds = [0, *ends[self.starts[1:] - 1].tolist(), int(ends[-1])]
        packed = token[held].astype("<u4").tobytes()
        return [packed[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Encodes the texts of one task."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.split = regex.compile(ranks.pattern)
        self.odd = frozenset(map(chr, ranks.odd))
        self.pairs = dict(zip(ranks.pairs.tolist(), ranks.ranks.tolist()))
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text; letters that only one Unicode table knows stand in by their class."""
        if text.isascii() or self.odd.isdisjoint(text):
            return self.split.findall(text)
        return [text[found.start():found.end()] for found in self.split.finditer(text.translate(self.ranks.odd))]

    def texts(self, texts: Iterator[str]) -> Iterator[bytes]:
        """The packed ids of each text, 32-bit little-endian; words are merged together by chunks of texts."""
        chunk: list[list[str]] = []
        chars = 0
        for text in texts:
            chunk.append(self.words(text))
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._flush(chunk)
                chunk, chars = [], 0
        yield from self._flush(chunk)

    def _flush(self, chunk: list[list[str]]) -> Iterator[bytes]:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        spelled = {word: word.encode("utf-8") for word in set().union(*chunk).difference(known)}
        whole = self.ranks.of
        short = [word for word, letters in spelled.items() if len(letters) <= SHORT and letters not in whole]
        known.update(zip(short, self.merge([spelled[word] for word in short])))
        long = []
        for word, letters in spelled.items():
            if letters in whole:
                known[word] = whole[letters].to_bytes(4, "little")
            elif len(letters) > SHORT:
                known[word], = self.merge([letters])
                long.append(word)
        for words in chunk:
            yield b"".join(map(known.__getitem__, words))
        for word in long:
            del known[word]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of words that are no tokens themselves."""
        if not words:
            return []
        chain = Chain(self.ranks, words)
        chain.merge(self.pairs)
        return chain.ids()


def decoded(ids: np.ndarray, names: list[bytes]) -> bytes:
    """The bytes behind ids; what is no id of the file raises."""
    return b"".join(map(names.__getitem__, ids.tolist()))


def round_trip(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Struct (ids array<int>, decoded binary) of whole texts: their ids, and the bytes decoded from those ids."""
    ranks = spark.sparkContext.broadcast(Ranks(path, pattern))
    made = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, names = Encoder(ranks.value), ranks.value.names
        for batch in batches:
            packed = list(encoder.texts(x.as_py() or "" for x in batch))
            ids = listed(packed)
            back = pa.array((decoded(np.frombuffer(p, "<u4"), names) for p in packed), pa.binary())
            yield pa.StructArray.from_arrays([ids, back], fields=list(made))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<ids:array<int>,decoded:binary>")(text)


def encode(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Ids of whole texts, array<int>."""
    ranks = spark.sparkContext.broadcast(Ranks(path, pattern))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            yield listed(list(encoder.texts(x.as_py() or "" for x in batch)))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<int>")(text)


def decode(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """The bytes of id lists; null lists and null ids give nothing."""
    ranks = spark.sparkContext.broadcast(Ranks(path, pattern))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ranks.value.names
        for batch in batches:
            yield pa.array((b"".join(names[i] for i in x.as_py() or () if i is not None) for x in batch), pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(ids)


def listed(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
