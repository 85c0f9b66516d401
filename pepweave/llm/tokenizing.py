"""Encoding with the tokenizers library, quickly and with the very ids that it gives."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np

from .common import STAGE_CACHES

WORDS = "byte_bpe_50k.json"
#: A worker remembers so many distinct words of up to 16 bytes; when there are more, those that it met again since the last time stay.
SHORT_WORDS = 1 << 19
#: Of so many bytes; byte-level BPE has one id for a byte at most.
WORD_IDS = 16
#: And of longer words the last so many, and those that it met among as many before.
MEMO_WORDS = 250_000
MEMO_BYTES = 32 << 20  # and no more of them than take so much memory
#: Letters and numbers among the characters of PLAIN, on whose classes all regex engines agree; other texts go to the library whole.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ–-…]*")
#: Byte-level BPE encodes each piece that this splits off on its own, so a piece's ids can be remembered.
PIECES = re.compile(rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[^\t\n\r {LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
#: piece_starts finds the same pieces in the bytes of many texts; so many bytes of them, or one longer text, are split at a time.
SPLIT_BYTES = 1 << 20
#: So many pieces or words are looked up or moved at a time.
STEP = 1 << 17
SPACE, LETTER, NUMBER, OTHER = range(4)


def _class(char: str) -> int:
    return SPACE if char in "\t\n\r " else LETTER if re.match(f"[{LETTERS}]", char) else NUMBER if re.match(f"[{NUMBERS}]", char) else OTHER


def _class_tables() -> tuple[np.ndarray, np.ndarray]:
    """Classes of PLAIN's characters: by the byte of those with one (others: LETTER), by the first two bytes of the others."""
    narrow, wide = np.full(256, LETTER, np.uint8), np.zeros(1 << 16, np.uint8)
    for char in map(chr, range(0x2027)):
        if PLAIN.fullmatch(char):
            data = char.encode()
            if len(data) == 1:
                narrow[data[0]] = _class(char)
            else:  # those of three bytes are all alike
                wide[data[0] << 8 | data[1]] = _class(char)
    return narrow, wide


NARROW, WIDE = _class_tables()
#: Letters after an apostrophe by which it begins a piece.
SHORT_ENDINGS, LONG_ENDINGS = np.frombuffer(b"stmd", np.uint8), [tuple(e) for e in (b"re", b"ve", b"ll")]


def piece_starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of PIECES start. data: bytes of PLAIN texts one after another, first: where each that isn't empty starts."""
    n = len(data)
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    kind = NARROW[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        kind[lead] = kind[lead + 1] = WIDE[data[lead].astype(np.int32) << 8 | data[lead + 1]]
        lead = lead[data[lead] >= 0xE0]
        kind[lead + 2] = kind[lead]
    begins = np.zeros(n + 3, bool)
    begins[first] = begins[n:] = True
    starts = begins.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # of spaces before a word the last is a piece of its own, or the word's first character if it is a blank
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])
    last = last[~begins[last + 1]]
    starts[last] = True
    starts[last + 1] = data[last] != 32
    quote = np.flatnonzero(data == 39)
    quote = quote[starts[quote] & ~begins[quote + 1]]
    one, two = data[quote + 1], data[quote + 2]
    short = quote[np.isin(one, SHORT_ENDINGS)]
    long = quote[np.logical_or.reduce([(one == a) & (two == b) for a, b in LONG_ENDINGS]) & ~begins[quote + 2]]
    starts[short + 1] = starts[long + 1] = False
    starts[short + 2] = starts[long + 3] = True
    return np.flatnonzero(starts[:n])


def byte_letters() -> np.ndarray:
    """The character by which byte-level BPE writes each byte: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.arange(256, dtype="<u2")
    rest = np.setdiff1d(letters, printable)
    letters[rest] = 256 + np.arange(len(rest))
    return letters


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORDS)


#: Masks of the first 0 to 8 bytes.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
NONE, ID = np.zeros(0, np.uint32), attrgetter("id")


class Memo(dict):
    """Words to the bytes of their ids, in two generations."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.encode = encode
        self.size = 0

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.encode(word)
        if len(self) >= MEMO_WORDS or self.size >= MEMO_BYTES:
            self.older, self.size = dict(self), 0
            self.clear()
        self[word] = found
        self.size += 200 + 4 * len(word) + len(found)
        return found


class ShortWords:
    """Words of up to 16 bytes, held whole as two numbers, to their ids: a hash table in arrays, so that many words are found at once."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.low, self.high = np.zeros((2, SHORT_WORDS), np.uint64)
        self.start, self.length = np.zeros(SHORT_WORDS, np.int32), np.zeros(SHORT_WORDS, np.uint8)
        self.again = np.zeros(SHORT_WORDS, bool)
        self.keep(NONE)

    def keep(self, words: np.ndarray) -> None:
        """Only these of the words."""
        steps = [words[k : k + STEP] for k in range(0, len(words), STEP)]
        low, high, (start, length) = self.low[words], self.high[words], self.places(words)
        ids, used = np.zeros(WORD_IDS * SHORT_WORDS, np.uint32), 0  # memory that is not written to is not taken
        for w in steps:
            some = self.ids[ragged(*self.places(w))]
            ids[used : used + len(some)] = some
            used += len(some)
        self.slots, self.count = np.full(2 * SHORT_WORDS, -1, np.int32), 0
        till = np.cumsum(length)
        for k in range(0, len(words), STEP):
            part = slice(k, k + STEP)
            at = self._places(low[part], high[part])  # words are numbered as they come to their slots
            self.start[at], self.length[at] = till[part] - length[part], length[part]
        self.ids, self.used = ids, used
        self.again[:] = False

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word start in self.ids, and how many they are."""
        return self.start[words].astype(np.int64), self.length[words].astype(np.int64)

    def _places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each word; new ones get the next numbers."""
        mask = np.uint32(len(self.slots) - 1)
        slot = low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xC2B2AE3D27D4EB4F)
        slot = ((slot ^ (slot >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(32)).astype(np.uint32) & mask
        out, rest = np.zeros(len(low), np.int32), np.arange(len(low))
        while len(rest):
            at = slot[rest]
            free = rest[self.slots[at] < 0]
            if len(free):
                own = np.arange(len(free), dtype=np.int32)
                self.slots[slot[free]] = own
                new = free[self.slots[slot[free]] == own]  # one of those that want the same slot
                upto = self.count + len(new)
                self.slots[slot[new]] = np.arange(self.count, upto, dtype=np.int32)
                self.low[self.count : upto], self.high[self.count : upto] = low[new], high[new]
                self.count = upto
            found = self.slots[at]
            same = (self.low[found] == low[rest]) & (self.high[found] == high[rest])
            out[rest[same]] = found[same]
            rest = rest[~same]
            slot[rest] = (slot[rest] + np.uint32(1)) & mask
        return out

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each word, of which there are at most SHORT_WORDS / 2; places() says where its ids are, until the next call."""
        if self.count + len(low) > SHORT_WORDS:
            kept = np.flatnonzero(self.again[: self.count])
            self.keep(kept if 2 * len(kept) <= SHORT_WORDS else kept[:0])
        old = self.count
        found = self._places(low, high)
        self.again[found[found < old]] = True
        if self.count > old:
            new = slice(old, self.count)
            words = np.stack([self.low[new], self.high[new]], 1).view(np.uint8).reshape(-1, 16)
            ids = self.encode(words, np.count_nonzero(words, 1))
            self.length[new] = length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            self.start[new] = self.used + np.cumsum(length) - length
            ids = np.frombuffer(b"".join(ids), np.uint32)
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        return found


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1 and on, as many as length says, one after another."""
    till = np.cumsum(length)
    return np.repeat(start - till + length, length) + np.arange(till[-1] if len(till) else 0)


class Encoder:
    """encode(text) gives the ids as an array of unsigned 32-bit integers, without special tokens added."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        kind = repr(t.pre_tokenizer)
        self.splits = "ByteLevel(add_prefix_space=False" in kind and "use_regex=True" in kind and t.normalizer is None and t.post_processor is None
        self.added = [x.content for x in t.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.memo = Memo(self._word)
        self.short = ShortWords(self._words)

    def _word(self, word: str) -> bytes:
        """word: in byte_letters."""
        return array("I", map(ID, self.tokenizer.model.tokenize(word))).tobytes()

    def _words(self, words: np.ndarray, length: np.ndarray) -> list[bytes]:
        """words: a row of 16 bytes each."""
        letters = self.letters[words].tobytes().decode("utf-16-le")
        return [self._word(letters[k : k + n]) for k, n in zip(range(0, len(letters), 16), length.tolist(), strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return list(self.each(texts))

    def each(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of one text after another. SPLIT_BYTES of texts are split together and each distinct piece of theirs is looked up once; no more ids than theirs are held."""
        out: list[np.ndarray] = []
        plain, places, size = [], [], 0
        for text in texts:
            data = text.encode()
            if out and size + len(data) > SPLIT_BYTES:
                yield from self._split(plain, places, out)
                out, plain, places, size = [], [], [], 0
            size += len(data)
            if not self.splits or any(a in text for a in self.added) or not PLAIN.fullmatch(text):
                out.append(np.frombuffer(self._whole(text), np.uint32))
                continue
            plain.append(data)
            places.append(len(out))
            out.append(NONE)
        yield from self._split(plain, places, out)

    def _split(self, plain: list[bytes], places: list[int], out: list[np.ndarray]) -> list[np.ndarray]:
        """out with the ids of plain texts set at their places."""
        data = np.frombuffer(b"".join(plain), np.uint8)
        if not len(data):
            return out
        ends = np.cumsum([len(text) for text in plain])
        first = np.concatenate([[0], ends[:-1]])
        starts = piece_starts(data, first[first < ends])
        eights = np.frombuffer(data.tobytes() + bytes(32 - len(data) % 8), "<u8")
        sizes, step = np.diff(starts, append=len(data)), min(STEP, SHORT_WORDS // 2)
        ids, lengths = zip(*(self._pieces(data, eights, starts[k : k + step], sizes[k : k + step]) for k in range(0, len(starts), step)), strict=True)
        ids, till = np.concatenate(ids), np.cumsum(np.concatenate(lengths))
        cuts = np.append(0, till)[np.searchsorted(starts, ends)].tolist()
        for place, a, b in zip(places, [0, *cuts[:-1]], cuts, strict=True):
            out[place] = ids[a:b]
        return out

    def _pieces(self, data: np.ndarray, eights: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has. eights: data as numbers of 8 bytes, with at least 24 bytes of zeros after it."""
        at, shift = start >> 3, (start & 7).astype(np.uint64) << np.uint64(3)
        first, second, third = eights[at], eights[at + 1], eights[at + 2]
        rest, one = np.uint64(63) - shift, np.uint64(1)
        low = ((first >> shift) | (second << rest << one)) & FIRST_BYTES[np.minimum(size, 8)]
        high = ((second >> shift) | (third << rest << one)) & FIRST_BYTES[np.clip(size - 8, 0, 8)]
        short, long = np.flatnonzero(size <= 16), np.flatnonzero(size > 16)
        if not len(long):
            found = self.short.find(low, high)
            begin, length = self.short.places(found)
            return self.short.ids[ragged(begin, length)], length
        found = self.short.find(low[short], high[short])
        words = [self.memo[self.letters[data[a : a + n]].tobytes().decode("utf-16-le")] for a, n in zip(start[long].tolist(), size[long].tolist(), strict=True)]
        begin, few = self.short.places(found)
        length = np.zeros(len(size), np.int64)
        length[short], length[long] = few, np.fromiter(map(len, words), np.int64, len(words)) // 4
        place = np.cumsum(length) - length
        ids = np.zeros(length.sum(), np.uint32)
        ids[ragged(place[short], few)] = self.short.ids[ragged(begin, few)]
        ids[ragged(place[long], length[long])] = np.frombuffer(b"".join(words), np.uint32)
        return ids, length


@lru_cache(2)
def encoder(path: str | None) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path or default_path())


STAGE_CACHES.append(encoder.cache_clear)
