"""Token ids of texts, by a public tokenizer that drops white space.

For such a tokenizer a text's ids are those of its white-space-separated words, one after the other. Words
repeat, so the distinct words of a slice are found first, by Arrow. They are cut into the tokenizer's pieces,
whose ids each task keeps in a dictionary of bounded size, as it keeps those of the words that are not cut here.
"""
from __future__ import annotations

import json
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from sonora.llm import words as W

#: Words and pieces remembered before a dictionary is started anew.
WORDS_KEPT, PIECES_KEPT = 250_000, 250_000
#: Characters below U+0250 that are no white space: composing changes nothing in words of them, and lower-casing goes
#: character by character (all but the dotted capital I).
_PLAIN = regex.compile("[!-~\u00a1-\u012f\u0131-\u024f]")
_CHARACTERS = [chr(c) for c in range(0x250)]
#: How the pieces of words are found: contractions, runs of letters, single digits, runs of others.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The class of each plain character in that pattern; line ends and digits begin a piece whatever is before them.
_LETTER, _OTHER, _LINE, _DIGIT = range(4)
_CLASS = np.array([_LINE if c == "\n" else _LETTER if regex.match(r"\p{L}", c) else _DIGIT if regex.match(r"\p{N}", c) else _OTHER for c in _CHARACTERS], np.uint8)
_IS_PLAIN = np.array([c == "\n" or bool(_PLAIN.match(c)) for c in _CHARACTERS])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _expanded(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` of these starts and lengths, end to end."""
    total = int(lengths.sum())
    return pool[np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)] if total else pool[:0]


class _Lists:
    """Numbered things and, end to end, the ids of each."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pool, self.starts, self.lengths = array("I"), array("q"), array("q")

    def __len__(self) -> int:
        return len(self.number)

    def add(self, things: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        begun = len(self.pool)
        self.pool.frombytes(ids.astype("I").tobytes())
        self.starts.frombytes((begun + np.cumsum(lengths) - lengths).astype("q").tobytes())
        self.lengths.frombytes(lengths.astype("q").tobytes())
        self.number.update(zip(things, range(len(self.number), len(self.number) + len(things))))

    def numbers(self, things: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, things), np.int64, len(things))

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the things of these numbers, end to end, and how many each has."""
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.frombuffer(self.lengths, np.int64)[at]
        if not lengths.any():
            return np.zeros(0, np.uint32), lengths
        return _expanded(np.frombuffer(self.pool, np.uint32), np.frombuffer(self.starts, np.int64)[at], lengths), lengths


class _Pieces(_Lists):
    """The ids of each lower-cased piece of plain words; number 0 is the line end between words, without ids."""

    def __init__(self, whole) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Split

        self.bare = Tokenizer(whole.model)
        self.bare.pre_tokenizer = Split("\n", "removed")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # The character by which the model spells each byte of plain characters.
        self.spell = np.arange(256, dtype="<u4")
        for c in map(chr, range(0x80, 0x250)):
            for byte, spelled in zip(c.encode(), level.pre_tokenize_str(c)[0][0]):
                self.spell[byte] = ord(spelled)
        self.width = np.zeros(whole.get_vocab_size() + 1, np.int64)
        suffix = getattr(whole.model, "end_of_word_suffix", None) or ""
        for token, k in whole.get_vocab().items():
            self.width[k] = len(token.removesuffix(suffix))
        self.forget()

    def forget(self) -> None:
        super().__init__()
        self.add([b"\n"], np.zeros(1, np.int64), np.zeros(0, np.uint32))

    def learn(self, pieces: list[bytes]) -> bool:
        """Tokenize new pieces together; false if the model's tokens do not spell them out."""
        data = np.frombuffer(b"\n".join([*pieces, b""]), np.uint8)
        spelled = self.spell[data].tobytes().decode("utf-32-le")
        ids = np.array(self.bare.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(self.width[ids])
        marks = np.flatnonzero(data == 10) - np.arange(len(pieces))  # where each piece ends in the bytes of all
        last = np.searchsorted(ends, marks)
        if not len(ids) or ends[-1] != marks[-1] or (ends[last] != marks).any():
            return False
        self.add(pieces, np.diff(last + 1, prepend=0), ids)
        return True


def _cuts_plainly(whole) -> bool:
    """Whether the tokenizer's file says that the pieces of lower-cased plain words are the matches of ``_PATTERN``."""
    conf = json.loads(whole.to_str())
    steps = [(s["type"], s.get("content")) for s in (conf["normalizer"] or {}).get("normalizers", [])]
    cuts = (conf["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return False
    split, level = cuts
    if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
        return False
    return split["pattern"].get("Regex") == _PATTERN


def _lines(words: pa.Array) -> str:
    """The words, each with a line end after it."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(b"\n", pa.large_binary()))[0].as_py().decode() + "\n" * bool(len(words))


def _pieces(text: str, codes: np.ndarray) -> pa.Array:
    """The pieces of lines of plain words (code points ``codes``), lower-cased; a line end is a piece too."""
    kind = _CLASS[codes]
    head = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] >= _LINE)])
    # A contraction: a piece that is one apostrophe, and the first letters after it. A line end follows every word.
    marks = np.flatnonzero((codes == ord("'")) & head)
    marks = marks[kind[marks + 1] == _LETTER]
    if len(marks):
        first, second = codes[marks + 1] | 0x20, codes[marks + 2] | 0x20  # ASCII letters lower-cased, others never made ASCII
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = np.isin(first * 256 + second, [ord(c) * 256 + ord(d) for c, d in ("re", "ve", "ll")])
        head[marks[one | two] + 1] = False
        head[marks[one] + 2] = head[marks[two] + 3] = True
    data = np.frombuffer(text.lower().encode(), np.uint8)
    at = np.flatnonzero(head)
    if len(data) > len(codes):
        at = np.flatnonzero((data & 0xC0) != 0x80)[at]  # characters to bytes
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])


class Tokens:
    """The ids of words, tokenized when first asked for."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.words, self.pieces, self.plainly = _Lists(), _Pieces(self.whole), _cuts_plainly(self.whole)

    def forget(self) -> None:
        """Give the memory back."""
        self.words = _Lists()
        self.pieces.forget()

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, str, np.ndarray]:
        """Which words are plain and hold no special token; these as lines, and their code points."""
        text = _lines(words)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        plain = np.full(len(words), self.plainly)
        strange = (codes >= len(_IS_PLAIN)) | ~_IS_PLAIN[np.minimum(codes, len(_IS_PLAIN) - 1)]
        if strange.any():
            plain[np.searchsorted(np.flatnonzero(codes == 10), np.flatnonzero(strange))] = False
        for token in self.special:
            if token.decode() in text:
                plain &= ~pc.match_substring(words, token.decode()).to_numpy(zero_copy_only=False)
        if not plain.all():
            text = _lines(words.filter(pa.array(plain)))
            codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        return plain, text, codes

    def _by_pieces(self, text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of lines of plain words, and how many each has; none if the model's tokens do not spell them out."""
        found = _pieces(text, codes).dictionary_encode()
        own = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.forget()
        new = [p for p in own if p not in self.pieces.number]
        if new and not self.pieces.learn(new):
            return None
        at = self.pieces.numbers(own)[found.indices.to_numpy()]
        ids, lengths = self.pieces.ids(at)
        totals = np.concatenate([[0], np.cumsum(lengths)])[1:][at == 0]  # at each line's end
        return ids, np.diff(totals, prepend=0)

    def _by_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that the whole tokenizer takes one by one, and how many each has."""
        if len(self.words) > WORDS_KEPT:
            self.words = _Lists()
        new = [w for w in words if w not in self.words.number]
        if new:
            lists = [e.ids for e in self.whole.encode_batch([w.decode() for w in new], add_special_tokens=False)]
            self.words.add(new, np.fromiter(map(len, lists), np.int64, len(lists)), np.fromiter(chain.from_iterable(lists), np.uint32))
        return self.words.ids(self.words.numbers(words))

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the place among them and the number of those of each of these distinct words."""
        plain, text, codes = self._plain(words)
        lengths, ids = np.zeros(len(words), np.int64), np.zeros(0, np.uint32)
        done = self._by_pieces(text, codes) if plain.any() else None
        if done is None:
            plain[:] = False
        else:
            ids, lengths[plain] = done
        starts = np.zeros(len(words), np.int64)
        starts[plain] = np.cumsum(lengths[plain]) - lengths[plain]
        if not plain.all():
            rest = words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist()
            more, counts = self._by_words(rest)
            lengths[~plain], starts[~plain] = counts, len(ids) + np.cumsum(counts) - counts
            ids = np.concatenate([ids, more])
        return ids, starts, lengths

    def _known(self, words: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``_distinct`` gives, and the number among the distinct words of each word."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.large_binary())
        if not len(words):
            return np.zeros(0, np.uint32), *np.zeros((3, 0), np.int64)
        numbered = words.dictionary_encode()
        return *self._distinct(numbered.dictionary), numbered.indices.to_numpy()

    def counts(self, words: pa.Array | list[bytes]) -> np.ndarray:
        """The number of ids of each word."""
        _, _, lengths, at = self._known(words)
        return lengths[at]

    def ids(self, words: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and the number of ids of each word."""
        pool, starts, lengths, at = self._known(words)
        return _expanded(pool, starts[at], lengths[at]), lengths[at]


_LOADED: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """This worker's dictionary for the tokenizer."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def token_count(text: Column, path: str) -> Column:
    """The number of ids of each text; 0 for null."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        known, out = tokens(path), [np.zeros(0, np.int64)]
        for _, data, offsets in W.slices(texts):
            words, ends = W.word_array(data, offsets)
            out.append(W.sums(known.counts(words), ends))
        return pa.array(np.concatenate(out))

    return count(text)
