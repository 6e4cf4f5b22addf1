"""Token ids of whole texts by a public tokenizer, as packed unsigned 16 or 32 bit integers.

Byte-level and word BPE never join characters across a blank that follows a non-blank, so a text is
cut there and each distinct piece is encoded once per worker by the tokenizers library; a bounded
table remembers its ids, and lets go of the pieces not met for longest when it is full. A text in which a
piece ends in white space, or one that may hold the string of a special token, goes to the library whole.
Word BPE joins no letter with what is none after it either; its pieces are cut there too, and found, told
apart and put together as Arrow columns, so that only distinct ones pass through Python.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from functools import lru_cache
from types import ModuleType
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: All special tokens of the vocabularies begin so.
SPECIAL = "<|"
#: Marks that are a token sequence of their own after a letter, at the end of a piece.
MARKS = (".", ",")

#: Pieces remembered by a worker before those not met since the last turn are let go; twice as many are held
#: at most, of words those of one ``encode_words`` more. Bounds its memory, not the result. Word ids go through
#: a shuffle on the same machines, which needs memory as well, so fewer are held there.
REMEMBER, REMEMBER_WORDS = 500_000, 250_000
#: Words learned from one text of them all.
TOGETHER = 4096


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the package that names it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, glued: bool) -> Encoder:
    """This Python process's encoder: Spark hands a worker one task after the other, and the pieces that
    it has learned serve them all."""
    held = sys.modules.setdefault("_martwright_encoders", ModuleType("_martwright_encoders")).__dict__
    if (path, glued) not in held:
        held[path, glued] = Encoder(path, glued)
    return held[path, glued]


def plain_tokenizer(path: str) -> Tokenizer:
    """This Python process's tokenizer of a file, with special tokens read as text, for one task after the
    other. It works in the task's own thread: the memory of threads is not given back."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    held = sys.modules.setdefault("_martwright_encoders", ModuleType("_martwright_encoders")).__dict__
    if path not in held:
        held[path] = Tokenizer.from_file(path)
        held[path].encode_special_tokens = True
    return held[path]


def forget_encoder(path: str, glued: bool) -> None:
    """Gives back this Python process's encoder, for tasks of a later step that need the memory."""
    sys.modules.get("_martwright_encoders", ModuleType("none")).__dict__.pop((path, glued), None)


@lru_cache(10_000)
def _stays_letter(char: str) -> bool:
    """A letter that no normalizer turns into a letter and a mark (as lower case does with U+0130)."""
    return char.isalpha() and (char.isascii() or unicodedata.normalize("NFC", char).lower().isalpha())


def _unchanged(piece: str) -> bool:
    """A piece, or several with blanks between, already lower-case in A-Z, that NFC and lower case leave as
    it is; without other white space."""
    return piece.isprintable() and (
        piece.isascii() or (unicodedata.is_normalized("NFC", piece) and piece.lower() == piece)
    )


class Encoder:
    """``encode(text)`` gives the ids of a whole text as a little-endian unsigned array.

    ``glued`` says that a piece carries the blank before it (byte-level BPE); otherwise white space
    is dropped (word BPE).
    """

    def __init__(self, path: str, glued: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.glued = glued
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.remember = REMEMBER if glued else REMEMBER_WORDS
        self.known: dict[str, bytes | None] = {}  # for word BPE, those of the call
        self.older: dict[str, bytes | None] = {}  # of the last turn
        self.marks = {m: self._whole(m) for m in MARKS}
        self.letters: dict[str, bool] = {}
        #: The table for word BPE: words, their ids' bytes, and whether each was met since the last turn.
        self.all_words = pa.array([], pa.string())
        self.ids_of_words = pa.array([], pa.binary())
        self.met = np.zeros(0, bool)
        self.words = None if glued else self._tokenizer_of_words()
        vocab = self.tokenizer.get_vocab()
        #: Bytes of the text that each id stands for (a byte-level token has one character per byte).
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(token.removesuffix("</w>"))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _tokenizer_of_words(self) -> Tokenizer:
        """The same model for words that the normalizers leave as they are and that are not split, without
        the work of finding that out."""
        from tokenizers import Tokenizer, pre_tokenizers

        words = Tokenizer(self.tokenizer.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
        return words

    def _is_letter(self, char: str) -> bool:
        """Whether the library takes a character that Python calls a letter for one."""
        if char not in self.letters:
            self.letters[char] = len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{char}a")) == 1
        return self.letters[char]

    def _pieces(self, text: str) -> list[str]:
        return text.replace("\n", " \n").split(" ")

    @staticmethod
    def _columns(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts in one column, lower-case in A-Z, and the number of them up to the end of each
        text. They are cut at blanks, which are left out, and between a-z and another ASCII character."""
        empty, end = (pa.scalar(x, texts.type) for x in ("", "\n"))
        joined = pc.binary_join_element_wise(texts, empty, end)  # so a piece ends where a text does
        stops = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset :][: len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2], np.uint8)[stops[0] : stops[-1]]
        data = data | ((data - np.uint8(65) < 26).view(np.uint8) << 5)
        blank = (data == 32) | (data == 10)
        letter = data - np.uint8(97) < 26
        end = blank.copy()
        end[1:] |= letter[:-1] & ~(letter | blank | (data > 127))[1:]
        at = np.flatnonzero(end)
        left_out = blank[at]
        cuts = np.append(0, at - np.cumsum(left_out) + left_out).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(cuts), pa.py_buffer(data[~blank]))
        return pieces, np.searchsorted(at, stops[1:] - stops[0])

    def encode_words(self, texts: pa.Array) -> pa.Array:
        """``encode`` for word BPE: a column of the ids' bytes for a column of texts."""
        if not len(texts):
            return pa.array([], pa.binary())
        empty = pa.scalar("", pa.string())
        texts = texts.cast(pa.string()).fill_null(empty)
        whole = pc.match_substring(texts, SPECIAL)
        pieces, stops = self._columns(pc.if_else(whole, empty, texts))
        coded = pieces.dictionary_encode()
        rows = self._rows(coded.dictionary)
        ids = self.ids_of_words.take(rows.take(coded.indices))
        cuts = np.frombuffer(ids.buffers()[1], np.int32)[np.append(0, stops)]
        ids = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), ids.buffers()[2]])
        if not pc.any(whole).as_py():
            return ids
        apart = [self._whole(t) for t in texts.filter(whole).to_pylist()]
        return pc.replace_with_mask(ids, whole, pa.array(apart, pa.binary()))

    def _rows(self, words: pa.Array) -> pa.Array:
        """Rows of the table where distinct words stand, once those not in it are learned. As many met since the
        last turn as may be remembered make the next one, which lets go of those not met."""
        at = pc.index_in(words, value_set=self.all_words).fill_null(-1).to_numpy().copy()
        self.met[at[at >= 0]] = True
        fresh = np.flatnonzero(at < 0)
        if not len(fresh):
            return pa.array(at)
        if np.count_nonzero(self.met) + len(fresh) > self.remember:
            kept = np.flatnonzero(self.met)
            self.all_words, self.ids_of_words = self.all_words.take(kept), self.ids_of_words.take(kept)
            at = np.append(np.cumsum(self.met) - 1, -1)[at]  # the last place stands for -1
            self.met = np.zeros(len(kept), bool)
            self.met[at[at >= 0]] = True
        column = words.take(fresh)
        together = pa.ListArray.from_arrays([0, len(column)], column)  # no word holds a blank
        pieces = pc.binary_join(together, pa.scalar(" ", pa.string()))[0].as_py().split(" ")
        self._learn(set(pieces))
        ids = pa.array(list(map(self.known.__getitem__, pieces)), pa.binary())
        self.known = {}
        at[fresh] = np.arange(len(self.met), len(self.met) + len(fresh))
        self.all_words = pa.concat_arrays([self.all_words, column])
        self.ids_of_words = pa.concat_arrays([self.ids_of_words, ids])
        self.met = np.append(self.met, np.ones(len(fresh), bool))
        return pa.array(at)

    def _meet(self, pieces: set[str]) -> None:
        """Have all of these pieces in the table."""
        fresh = pieces.difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > self.remember:
                self.older, self.known, fresh = self.known, {}, pieces
            self._learn(fresh)

    def _learn(self, pieces: set[str]) -> None:
        known, older, marks = self.known, self.older, self.marks
        todo, marked = [], []
        for p in pieces:
            if self.glued and (not p or p[-1].isspace()):
                known[p] = None  # it may join with what follows
            elif p in older:
                known[p] = older[p]
            elif p.endswith(MARKS) and _stays_letter(p[-2:-1]):
                marked.append(p)
            else:
                todo.append(p)
        # a mark after a letter is a token sequence of its own, so the word before it is learned alone
        words = {p[:-1] for p in marked}.difference(known, todo)
        for p in words:
            if p in older:
                known[p] = older[p]
            else:
                todo.append(p)
        todo = self._learn_together(todo)
        if todo:
            done = self.tokenizer.encode([self._spaced(p) for p in todo], is_pretokenized=True, add_special_tokens=False)
            of = np.array(done.word_ids, np.int64)
            self._keep(todo, np.array(done.ids, self.dtype), np.searchsorted(of, np.arange(len(todo)), "right"))
        for p in marked:
            known[p] = known[p[:-1]] + marks[p[-1]]

    def _spaced(self, piece: str) -> str:
        """A piece with the blank that it carries."""
        return " " + piece if self.glued and piece[0] != "\n" else piece

    def _keep(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        packed = ids.tobytes()
        cuts = (ends * self.dtype.itemsize).tolist()
        self.known.update(zip(pieces, map(packed.__getitem__, map(slice, [0, *cuts], cuts))))

    def _learn_together(self, pieces: list[str]) -> list[str]:
        """Learn pieces from one text of them all: the library's fast call tells no offsets, but the
        tokens' bytes do, where no normalizer changes the piece. Returns the pieces still to be learned."""
        if self.glued:
            return pieces if pieces and not self._learn_text(self.tokenizer, pieces) else []
        self.known[""] = b""  # empty ones have no ids
        left = set(filter(None, pieces))
        strange = {c for c in set("".join(left)) if not c.isascii() and c.isalpha() and not self._is_letter(c)}
        words = [p for p in left if p.isalpha() and (p.isascii() or (strange.isdisjoint(p) and _unchanged(p)))]
        others = [p for p in left.difference(words) if _unchanged(p)]
        for tokenizer, texts in ((self.words, words), (self.tokenizer, others)):
            for at in range(0, len(texts), TOGETHER):  # the library needs some hundred bytes for a token
                part = texts[at : at + TOGETHER]
                if self._learn_text(tokenizer, part):
                    left.difference_update(part)
        return list(left)

    def _learn_text(self, tokenizer: Tokenizer, texts: list[str]) -> bool:
        """Learn pieces from one text of them all; False if that does not tell their ends."""
        if self.glued:
            spaced = [" " + p if p[0] != "\n" else p for p in texts]
            whole = "".join(spaced)
            wanted = np.cumsum(np.fromiter(map(len, spaced), np.int64, len(spaced)))
            if not whole.isascii():  # characters begin at bytes that continue none
                data = np.frombuffer(whole.encode(), np.uint8)
                wanted = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[wanted]
        else:  # a piece ends where a blank stands, which has no token
            whole = " ".join(texts)
            blanks = np.flatnonzero(np.frombuffer(whole.encode() + b" ", np.uint8) == 32)
            wanted = blanks - np.arange(len(blanks))
        ids = np.array(tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.dtype)
        reached = np.cumsum(self.n_bytes[ids])
        ends = np.searchsorted(reached, wanted, "right")
        if not np.array_equal(np.r_[0, reached][ends], wanted):
            return False  # some token is no plain stretch of text
        self._keep(texts, ids, ends)
        return True

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.glued:
            found = self.encode_words(pa.array(texts, pa.string()))
            return [np.frombuffer(x, self.dtype) for x in found.to_pylist()]
        cut = [None if t and SPECIAL in t else self._pieces(t or "") for t in texts]
        # a piece that starts a text carries no blank and is encoded where it stands
        self._meet(set().union(*(p[1:] for p in cut if p is not None)))
        firsts = list({p[0] for p in cut if p and len(p) > 1})
        coded = self.tokenizer.encode_batch_fast(firsts, add_special_tokens=False) if firsts else []
        first_ids = {p: np.array(e.ids, self.dtype).tobytes() for p, e in zip(firsts, coded)}
        return [np.frombuffer(self._joined(t or "", p, first_ids), self.dtype) for t, p in zip(texts, cut)]

    def _joined(self, text: str, pieces: list[str] | None, first_ids: dict[str, bytes]) -> bytes:
        if pieces is None:
            return self._whole(text)
        first, last = pieces[0], pieces[-1]
        if len(pieces) < 2 or not first or first[-1].isspace():
            return self._whole(text)
        try:
            middle = b"".join(map(self.known.__getitem__, pieces[1:-1]))
        except TypeError:
            return self._whole(text)
        end = self.known[last]
        if end is None:
            end = self._whole(last if last.startswith("\n") else " " + last)
        return first_ids[first] + middle + end
