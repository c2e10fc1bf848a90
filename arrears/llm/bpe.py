"""Byte-pair encoding and decoding of whole texts, by a trie of words whose nodes hold last-token states.

The encoding of a word's prefix ends in exactly one token. If the last token of every shorter prefix is known, that
token is the one vocabulary suffix of the prefix that may stand behind the last token of the rest: no merge across
their border may come before the merges that made both. So distinct words go into a trie, a depth-first walk gives
each node its last token from its ancestors' tokens, and a prefix shared by many words is encoded once.

Texts never leave their partition: there is no shuffle, tasks keep no state between partitions, and a worker's table
of known words is emptied when it holds ``KNOWN_WORDS`` entries, which changes time only.

A node keeps its last token and where that begins; the ids of a word are put together once, at its end, by going back
from token to token. So a word of any length costs linear time and memory.

Rules: a null text is the empty text; empty texts give no ids; the strings of special tokens in a text become those
tokens; very long texts and words are encoded whole; repeated rows are encoded alike; an empty table gives an empty
result. Classes and lower case of letters are those of the library's own Unicode tables, asked once when a vocabulary
is loaded. Columns beside the text pass through untouched under any name.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

KNOWN_WORDS = 200_000
KNOWN_PAIRS = 200_000
CHUNK_CHARS = 1_000_000
BATCH_BYTES = 1 << 20  # of text that are encoded, decoded and sent back at once
ENDING = 4


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


CLASSES = {r"\p{L}": (r"\p{L}", "\u4e00"), r"\p{N}": (r"\p{N}", "\u0663"), r"\s": (r"\p{White_Space}", "\u2003")}
OTHER = "\u2603"


@cache
def library_letters() -> tuple[dict[str, str], dict[int, str]]:
    """Code points that the library's Unicode tables treat differently from Python's: their normal form, and a stand-in
    of their class for the word pattern. Planes 4 to 13, 15 and 16 hold no letters and are not asked."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]]
    everything = "".join(points)
    lower = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
    changed = {point: told for point in points if (told := lower(point)) != normal(point)}
    told, own = {}, {}
    for name, (prop, sign) in CLASSES.items():
        split = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True)
        told[sign] = set().union(*(piece for piece, _ in split.pre_tokenize_str(everything)))
        own[sign] = set(regex.findall(prop, everything))
    odd = set().union(*(told[sign] ^ own[sign] for sign in told))
    return changed, {ord(point): next((sign for sign in told if point in told[sign]), OTHER) for point in odd}


class Vocabulary:
    """What encoding and decoding need of a tokenizer file: ids, merge ranks, word pattern, special tokens.

    Bounded by the file (some 50,000 entries), so it may be broadcast.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or whole.get("decoder"):
            raise ValueError("a byte-level BPE file without decoder is expected")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        split = next(p for p in whole["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern: str = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.lower, self.odd = library_letters()
        self.parts: dict[str, tuple[str, str]] = {}
        self.born: dict[str, int] = {}
        self.rank: dict[tuple[str, str], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.parts[left + right] = (left, right)
            self.born[left + right] = self.rank[left, right] = rank
        self.names = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for name, number in [*self.ids.items(), *self.special.items()]:
            self.names[number] = name


def reaches(tokens: dict[str, bytes]) -> dict[str, int]:
    """Length of the longest token with each ending of ``ENDING`` letters; shorter tokens are their own ending.

    Where no token has the ending, those that can stand there are shorter than it.
    """
    reach: dict[str, int] = {}
    for token in tokens:
        reach[token[-ENDING:]] = max(len(token), reach.get(token[-ENDING:], 0))
    return reach


class WordEncoder:
    """Encodes distinct words; every result is the packed ids of one word, 32-bit little-endian."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.alphabet = byte_alphabet()
        self.suffix = suffix = vocabulary.suffix
        # Tokens inside words and, without the mark of word ends, at their ends. Those that the merges never reach
        # cannot stand in any encoding.
        self.packed: dict[str, bytes] = {}
        self.packed_end: dict[str, bytes] = {}
        for token, number in vocabulary.ids.items():
            if token not in vocabulary.parts or self._apart(*vocabulary.parts[token], vocabulary.born[token]):
                ends = suffix and token.endswith(suffix) and token != suffix
                if ends:
                    self.packed_end[token.removesuffix(suffix)] = number.to_bytes(4, "little")
                else:
                    self.packed[token] = number.to_bytes(4, "little")
        if not suffix:
            self.packed_end = self.packed
        self.reach, self.reach_end = reaches(self.packed), reaches(self.packed_end)
        self.pairs: dict[tuple[str, str], bool] = {}

    def _apart(self, left: str, right: str, limit: float = float("inf")) -> bool:
        """Whether no merge across the border of two tokens comes before rank ``limit``.

        Goes back in time: the later-born of the two border tokens is undone first, and what then touches the border
        could have merged only before that birth. A tie goes to the leftmost pair, as in encoding.
        """
        rank, born, parts = self.v.rank, self.v.born, self.v.parts
        while True:
            across = rank.get((left, right))
            if across is not None and across < limit:
                return False
            age_left, age_right = born.get(left, -1), born.get(right, -1)
            if age_left < 0 and age_right < 0:
                return True
            if age_left > age_right:
                limit, left = age_left, parts[left][1]
            else:
                limit, right = age_right + 1, parts[right][0]

    def encode(self, words: set[str]) -> dict[str, bytes]:
        """Insert words into a trie and hand states down it depth first.

        Sorted words are the trie: neighbours share their path up to their common start, and reading on walks it depth
        first. ``last`` and ``back`` hold the last token of each node on the current path and where it begins.
        """
        symbols = self.alphabet.__getitem__
        spelled = sorted((word if word.isascii() and word.isprintable() else
                          "".join(map(symbols, word.encode("utf-8"))), word) for word in words)
        last, back, before = [""], [0], ""
        out: dict[str, bytes] = {}
        packed, packed_end, find = self.packed, self.packed_end, self._last
        for path, word in spelled:
            size = len(path)
            common, most = 0, min(size, len(last)) - 1
            while common < most and path[common] == before[common]:
                common += 1
            del last[common + 1:], back[common + 1:]
            for depth in range(common + 1, size):
                token, begin = find(path, depth, packed, last)
                last.append(token)
                back.append(begin)
            token, begin = find(path, size, packed_end, last)
            if begin:
                ids = [packed_end[token]]
                while begin:
                    ids.append(packed[last[begin]])
                    begin = back[begin]
                ids.reverse()
                out[word] = b"".join(ids)
            else:
                out[word] = packed_end[token]
            before = path
        return out

    def _last(self, path: str, size: int, tokens: dict[str, bytes], last: list[str]) -> tuple[str, int]:
        """The one token of ``tokens`` that ends the first ``size`` letters of ``path``, longest first, and where it
        begins."""
        reach = self.reach if tokens is self.packed else self.reach_end
        for begin in range(max(0, size - reach.get(path[max(0, size - ENDING):size], ENDING - 1)), size):
            token = path[begin:size]
            if token in tokens:
                if begin == 0:
                    return token, 0
                whole = token if tokens is self.packed else token + self.suffix
                fits = self.pairs.get((last[begin], whole))
                if fits is None:
                    fits = self._fits(last[begin], whole)
                if fits:
                    return token, begin
        raise ValueError(f"no token ends {path[max(0, size - 40):size]!r}")

    def _fits(self, left: str, right: str) -> bool:
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left, right] = self._apart(left, right)
        return fits


class TextEncoder:
    """Splits texts into words as the tokenizer file says and joins the encodings of their words."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = WordEncoder(vocabulary)
        self.split = regex.compile(vocabulary.pattern)
        self.lower, self.odd = vocabulary.lower, vocabulary.odd
        self.strange = frozenset([*self.lower, *map(chr, self.odd)])
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known = {s: i.to_bytes(4, "little") for s, i in vocabulary.special.items()}
        self.fixed = dict(self.known)

    def pieces(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            out: list[str] = []
            for part in self.special.split(text):
                out += [part] if part in self.fixed else self.plain(part)
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if text.isascii() or self.strange.isdisjoint(text):
            return self.split.findall(normal(text))
        text = "".join(self.lower.get(c) or normal(c) for c in unicodedata.normalize("NFC", text))
        return [text[found.start():found.end()] for found in self.split.finditer(text.translate(self.odd))]

    def encode(self, texts: Iterator[str]) -> Iterator[bytes]:
        chunk: list[list[str]] = []
        chars = 0
        for text in texts:
            chunk.append(self.pieces(text))
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._flush(chunk)
                chunk, chars = [], 0
        yield from self._flush(chunk)

    def _flush(self, chunk: list[list[str]]) -> Iterator[bytes]:
        if len(self.known) > KNOWN_WORDS:
            self.known = dict(self.fixed)
        new = {word for words in chunk for word in words if word not in self.known}
        self.known.update(self.words.encode(new))
        for words in chunk:
            yield b"".join(map(self.known.__getitem__, words))


def normal(text: str) -> str:
    """Canonical composition and lower case, letter by letter: no letter's case depends on its neighbours."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def portions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of batches in slices of ``BATCH_BYTES`` of text, or of one longer text.

    Ids and decoded texts take several times the bytes of their texts, on both sides of the worker's pipe, so batches
    that are bounded by rows alone would make memory grow with the length of texts.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(batch):
            done = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def encode(spark: SparkSession, text: Column, path: str) -> Column:
    """Token ids of whole texts as 32-bit little-endian binary, the form in which token shards are stored."""
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = TextEncoder(vocabulary.value)
        for batch in portions(batches):
            yield pa.array(encoder.encode(x.as_py() or "" for x in batch), pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """Text of packed ids, special tokens kept: without a decoder in the file, tokens are set apart by one space."""
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path).names)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((text_of(x.as_py() or b"", vocabulary.value) for x in batch), pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(ids)


def round_trip(spark: SparkSession, text: Column, path: str) -> Column:
    """Struct (ids, decoded) of whole texts: encoding, and decoding of its ids, in one Python worker per task instead
    of two."""
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path))
    made = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, names = TextEncoder(vocabulary.value), vocabulary.value.names
        for batch in portions(batches):
            ids = list(encoder.encode(x.as_py() or "" for x in batch))
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array((text_of(i, names) for i in ids), pa.string())], fields=list(made))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<ids:binary,decoded:string>")(text)


def text_of(ids: bytes, names: list[str]) -> str:
    return " ".join(map(names.__getitem__, np.frombuffer(ids, "<u4").tolist()))
