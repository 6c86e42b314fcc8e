"""Token ids of whole texts by a public tokenizer with word ends.

The tokenizer drops white space and never joins what white space parts, so a text's ids
are those of its words (split at ASCII white space) one after another. Words repeat far
more than texts: each Python worker keeps the ids of recent words and passes only new
ones to the library. Of a new word with ASCII marks at its end, the word before them and the
marks are looked up on their own, since the tokenizer parts them. Words of Latin letters alone
need none of the library's normalising and splitting: they go to it lowered and in the letters
that stand for their bytes.
"""

import json
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from escrutinio.llm.text import buffers

CACHED_WORDS = 400_000
#: Bytes of words and ids that a cache keeps, of which there are two, with what Python takes for each word besides.
CACHED_BYTES = 40 << 20
_ENTRY_BYTES = 190
PIECE_BYTES = 1 << 21
_BATCH = 2_000
_SPACE = re.compile(rb"[ \t-\r]")
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[list(string.punctuation.encode())] = True
#: A word that ends in a Latin letter or a digit, and ASCII marks behind it.
_MARKED = r"(?s)^(?P<word>.*[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])(?P<marks>[!-/:-@\[-`{-~]+)$"
#: The letters up to here are composed ones, and lowered the same way by Python and the library.
_LATIN = "\u024f"
_DOTTED = "\u0130"  # but for this one, which becomes a letter and a mark
#: Tokenizers that lower words and part letters from marks, as the short ways with words expect.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_OPEN: dict = {}


def _byte_letters() -> dict[int, str]:
    """The letters of byte-level vocabularies; the space stays."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden) if b != 0x20}


_BYTE_LETTERS = _byte_letters()


def _latin(word: bytes) -> bool:
    """Of Latin letters alone, some of them not ASCII."""
    if word.isascii():
        return False
    text = word.decode("utf-8")
    return text.isalpha() and max(text) <= _LATIN and _DOTTED not in text


class WordTokenizer:
    """Ids as little-endian unsigned integers; ``dtype`` has 16 bits if the vocabulary allows."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        top = max(vocabulary.values())
        self.dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        self.size = top + 1
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the young ones
        self.bare = self._bare(path)

    def _bare(self, path: str):
        """The library without normalising, and split at spaces alone; None if words cannot take the short ways."""
        from tokenizers import Tokenizer, pre_tokenizers

        parts = json.loads(self.library.to_str())
        steps = [s["type"] for s in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if steps != _NORMALIZERS or split[0].get("pattern") != {"Regex": _PATTERN} or [s["type"] for s in split] != ["Split", "ByteLevel"]:
            return None
        bare = Tokenizer.from_file(path)
        bare.normalizer = None
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return bare

    def _pack(self, ids) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Put the ids of ``words`` into the young cache."""
        plain, latin, other = [], [], []
        if self.bare is None:
            other = words
        else:
            for word in words:
                (plain if word.isalpha() else latin if _latin(word) else other).append(word)
        other += self._letters(plain, lambda text: text.decode())
        other += self._letters(latin, lambda text: text.decode().lower().encode().decode("latin-1").translate(_BYTE_LETTERS))
        for i in range(0, len(other), _BATCH):
            part = other[i : i + _BATCH]
            found = self.library.encode_batch_fast([w.decode("utf-8") for w in part], add_special_tokens=False)
            self.young.update((w, self._pack(e.ids)) for w, e in zip(part, found, strict=True))

    def _letters(self, words: list[bytes], shown: Callable[[bytes], str]) -> list[bytes]:
        """Learn words of letters without normalising; ``shown`` gives the letters of their bytes. What could not be told apart."""
        left = []
        for i in range(0, len(words), _BATCH):
            part = words[i : i + _BATCH]
            found = self.bare.encode_batch_fast([shown(b" ".join(part).lower())], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype=self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # a run of letters has one word end
                left += part
                continue
            data, stops = ids.tobytes(), (stops * self.dtype.itemsize).tolist()
            self.young.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)], strict=False))
        return left

    def _of(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        young, old = self.young, self.old
        new = [w for w in words if w not in young]
        if new:
            young.update([(w, old[w]) for w in new if w in old])
            self._learn([w for w in new if w not in old])
            self.held += sum(len(w) + len(young[w]) for w in new) + _ENTRY_BYTES * len(new)
        ids = [young[w] for w in words]
        if len(young) > CACHED_WORDS or self.held > CACHED_BYTES:
            self.old, self.young, self.held = young, {}, 0
        return ids

    def _rows(self, texts: list[bytes]) -> list[bytes]:
        """The distinct words of all texts once, and from them the ids of each text."""
        words = _split(pa.array(texts, pa.string()))
        found = words.flatten().dictionary_encode()
        if not len(found):
            return [b""] * len(texts)
        cores, marks = _parted(found.dictionary) if self.bare is not None else (found.dictionary, None)
        parts = [_coded(x) for x in (cores, marks) if x is not None]
        of_part = [self._of(known) for known, _ in parts]
        ids, sizes, first = [], [], 0
        for known, (_, which) in zip(of_part, parts, strict=True):
            ids += known
            sizes.append(first + which)
            first += len(known)
        # Of each word, its parts in turn.
        part_of = np.stack(sizes, axis=1)
        flat = np.frombuffer(b"".join(ids), dtype=self.dtype)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.dtype.itemsize
        which = part_of[found.indices.to_numpy()].ravel()
        counts = size[which]
        ends = np.concatenate(([0], np.cumsum(counts)))
        data = flat[np.repeat((np.cumsum(size) - size)[which] - ends[:-1], counts) + np.arange(ends[-1])].tobytes()
        offsets = words.offsets.to_numpy()
        stops = (ends[(offsets - offsets[0]) * len(parts)] * self.dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if all(len(t) <= 2 * PIECE_BYTES for t in texts):
            return self._rows(texts)
        return [b"".join(self._rows([p])[0] for p in _pieces(t)) for t in texts]


def _split(texts: pa.Array) -> pa.ListArray:
    """Words, in small letters: the tokenizer lowers them too. Only its special tokens are told by their case.

    White space at the ends of a text leaves empty words, which have no ids.
    """
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


def _parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word without the marks at its end, and these, where the tokenizer parts them."""
    data, offsets = buffers(words)
    marked = np.zeros(len(words), dtype=bool)
    full = np.diff(offsets) > 0
    marked[full] = _IS_MARK[data[offsets[1:][full] - 1]]
    at = np.flatnonzero(marked)
    found = pc.extract_regex(words.take(pa.array(at)), _MARKED)
    told = found.is_valid().to_numpy(zero_copy_only=False)
    told &= ~pc.match_substring(words.take(pa.array(at)), "<|").to_numpy(zero_copy_only=False)
    at, found = at[told], found.filter(pa.array(told))
    place = np.full(len(words), -1)
    place[at] = np.arange(len(at))
    place = pa.array(place, mask=place < 0)
    return pc.coalesce(found.field("word").take(place), words), pc.coalesce(found.field("marks").take(place), "")


def _coded(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words and which of them each is."""
    found = words.dictionary_encode()
    data, offsets = buffers(found.dictionary)
    data, offsets = data.tobytes(), offsets.tolist()
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], found.indices.to_numpy().astype(np.int64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A very long text in pieces cut at white space."""
    at = 0
    while at < len(text):
        found = _SPACE.search(text, at + PIECE_BYTES)
        stop = found.end() if found else len(text)
        yield text[at:stop]
        at = stop


def opened(path: str) -> WordTokenizer:
    """The worker's tokenizer for ``path``, loaded once per process."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]
