"""Token ids of a public tokenizer, encoded once per distinct piece of text.

The byte-level tokenizer cuts a text into pre-tokens and encodes each by itself, so the ids of a text are those of its
pieces. Pieces are remembered per Python worker, up to a bounded number. The words of a batch of texts are cut, told
apart and put together again as columns, so that Python looks at each distinct word of a batch once.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from codecs import charmap_decode
from itertools import compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

# Spark runs a worker for each core, so the library needs no threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

PATH = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2

_SPACE = "\u0120"  # fixed value: how a byte-level vocabulary writes the space byte
_MARKS = ".,;:!?#*$%&|<>"  # marks that never share a pre-token with letters before them
_JOINED = 200  # new chunks encoded as one text
REMEMBERED = 400_000  # pieces of each kind in a generation of which two are kept
PRE_TOKEN = regex.compile(public_tokenizers.PATTERN)
# A text may be cut at each single space, unless white space stands on both sides of one.
_UNSAFE = re.compile(r" (?=\s|\Z)(?<=\s )")
# Letters up to here (Latin, Greek, Cyrillic) are letters in every version of Unicode.
_OLD_SCRIPTS = re.compile("[ A-\u052f]+")
# The characters by which a byte-level vocabulary writes the bytes.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = "".join(chr(b if b in _SHOWN else 256 + sum(x not in _SHOWN for x in range(b))) for b in range(256))

Runs = tuple[np.ndarray, np.ndarray]  # ids one after another, and the bounds of each run of them, from 0 on
_NONE: Runs = np.empty(0, np.uint32), np.zeros(1, np.int64)


class Remembered:
    """A bounded memory of the pieces met lately: when one generation is full, the one before it goes."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Let go of every piece."""
        self.young, self.old = {}, {}

    def turn(self) -> None:
        """Start a new generation if the young one is full. Pieces met before may then be unknown."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young

    def unknown(self, pieces: set[str]) -> list[str]:
        """Those of ``pieces`` that have to be made; the others are in the young generation from now on."""
        young, old = self.young, self.old
        new = []
        for p in pieces.difference(young):
            if p in old:
                young[p] = old[p]
            else:
                new.append(p)
        return new


def _chained(*runs: Runs) -> Runs:
    """All runs one after another."""
    begins = np.cumsum([0, *(bounds[-1] for _, bounds in runs)])
    return (np.concatenate([ids for ids, _ in runs]),
            np.concatenate([[0], *(begin + bounds[1:] for begin, (_, bounds) in zip(begins, runs))]))


def _of_bytes(raw: list[bytes]) -> Runs:
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    return np.frombuffer(b"".join(raw), np.uint32), np.concatenate([[0], np.cumsum(sizes)])


def _taken(runs: Runs, at: np.ndarray) -> Runs:
    """The runs numbered ``at``, in that order."""
    ids, bounds = runs
    begins = bounds[at]
    sizes = bounds[at + 1] - begins
    found = np.concatenate([[0], np.cumsum(sizes)])
    place = np.repeat(begins - found[:-1], sizes)
    place += np.arange(found[-1])
    return ids[place], found


class RememberedRuns:
    """Like :class:`Remembered`, but the ids of all pieces lie in one array and are found by number."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.forget()

    def forget(self) -> None:
        """Let go of every piece."""
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.runs = self.old_runs = _NONE

    def turn(self) -> None:
        """Start a new generation if the young one is full. Pieces met before may then be unknown."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
            self.runs, self.old_runs = _NONE, self.runs

    def add(self, pieces: list[str], runs: Runs) -> np.ndarray:
        """The numbers of distinct new ``pieces``, whose ids are ``runs``."""
        begin, end = len(self.young), len(self.young) + len(pieces)
        self.young.update(zip(pieces, range(begin, end)))
        self.runs = _chained(self.runs, runs)
        return np.arange(begin, end)

    def find(self, pieces: list[str]) -> np.ndarray:
        """The numbers of distinct ``pieces``, -1 for those that have to be made."""
        at = np.fromiter(map(self.young.get, pieces, repeat(-1)), np.int64, len(pieces))
        if self.old:
            missing = np.flatnonzero(at < 0)
            pieces = [pieces[i] for i in missing.tolist()]
            was = np.fromiter(map(self.old.get, pieces, repeat(-1)), np.int64, len(pieces))
            again = was >= 0
            at[missing[again]] = self.add(list(compress(pieces, again.tolist())), _taken(self.old_runs, was[again]))
        return at


class Encoder:
    """The library's ids (``add_special_tokens=False``) as unsigned 32-bit integers."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_space = Tokenizer(self.tokenizer.model)  # for text in the vocabulary's characters, cut at spaces only
        self.by_space.pre_tokenizer = pre_tokenizers.Split(_SPACE, "merged_with_next")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.of_pre_token = Remembered(remembered)
        self.of_chunk = RememberedRuns(remembered)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens whose first byte is a space
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True

    def forget(self) -> None:
        """Let go of every remembered piece; the tokenizer stays."""
        self.of_pre_token.forget()
        self.of_chunk.forget()

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text. In texts of words of letters the words are the pre-tokens."""
        tokenizer = self.tokenizer
        if all(t.replace(" ", "").isalpha() and _OLD_SCRIPTS.fullmatch(t) and "  " not in t and t[-1] != " "
               for t in texts):
            tokenizer = self.by_space
            texts = [charmap_decode(t.encode(), "strict", _BYTES)[0] for t in texts]
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pre_tokens(self, text: str) -> list[str]:
        """The pieces that are encoded one by one; a special token is a piece."""
        if not any(s in text for s in self.special):
            return PRE_TOKEN.findall(text)
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text)
        return [piece for i, part in enumerate(parts) for piece in ([part] if i % 2 else PRE_TOKEN.findall(part))]

    def learn(self, pre_tokens: set[str]) -> dict[str, bytes]:
        """The ids of (at least) each of ``pre_tokens``; those that are not remembered are encoded in one call."""
        self.of_pre_token.turn()
        new = self.of_pre_token.unknown(pre_tokens)
        self.of_pre_token.young.update(zip(new, self._whole(new)))
        return self.of_pre_token.young

    def _joined(self, words: list[str]) -> Runs:
        """The ids of each word behind a space, many encoded as one text: a token that begins with a space begins one."""
        parts = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        ids, bounds = _of_bytes(self._whole([" " + " ".join(part) for part in parts]))
        starts = np.flatnonzero(self.spaced[ids])
        if np.diff(np.searchsorted(starts, bounds)).tolist() != [len(part) for part in parts]:
            raise ValueError("the tokenizer joins words across a space")
        return ids, np.append(starts, len(ids))

    def _learn_chunks(self, chunks: list[str]) -> np.ndarray:
        """The numbers in ``of_chunk`` of distinct chunks, with their ids as they are after a space.

        Those with white space at an end could run into a neighbour's, so they are encoded by themselves.
        """
        at = self.of_chunk.find(chunks)
        letters, joined, alone = [], [], []
        for i in np.flatnonzero(at < 0).tolist():
            c = chunks[i]
            (letters if c.isalpha() else joined if c and c == c.strip() else alone).append(i)
        named = [[chunks[i] for i in kind] for kind in (letters, joined, alone)]
        runs = [*map(self._joined, named[:2]), _of_bytes(self._whole([f" {c}" for c in named[2]]))]
        at[letters + joined + alone] = self.of_chunk.add(sum(named, []), _chained(*runs))
        return at

    def _chunks(self, chunks: pa.Array) -> Runs:
        """The ids of each of the distinct chunks, as it is after a space.

        A word with marks behind it has the ids of the word and those of the marks.
        """
        words = pc.utf8_rtrim(chunks, _MARKS)
        is_word = pc.utf8_is_alpha(words)
        names = pc.if_else(is_word, words, chunks).dictionary_encode()
        number = self._learn_chunks(names.dictionary.to_numpy(zero_copy_only=False).tolist())
        n_marks = pc.subtract(pc.binary_length(chunks), pc.binary_length(words)).to_numpy()
        marked = np.flatnonzero(is_word.to_numpy(zero_copy_only=False) & (n_marks > 0))
        marks = [c[-n:] for c, n in zip(chunks.take(pa.array(marked)).to_numpy(zero_copy_only=False),
                                        n_marks[marked].tolist())]
        distinct = {m: i for i, m in enumerate(dict.fromkeys(marks), 1)}
        of_marks = self.learn(set(distinct))
        runs = _chained(self.of_chunk.runs, _of_bytes([b"", *(of_marks[m] for m in distinct)]))
        parts = np.full((len(chunks), 2), len(self.of_chunk.young))  # the empty run, where there are no marks
        parts[:, 0] = number[names.indices.to_numpy()]
        parts[marked, 1] += np.fromiter(map(distinct.__getitem__, marks), np.int64, len(marks))
        ids, bounds = _taken(runs, parts.ravel())
        return ids, bounds[::2]

    def _cut(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that may be cut at each space."""
        pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        heads = pieces.offsets.to_numpy()[:-1]  # where each text begins: no space before it
        coded = pieces.flatten().dictionary_encode()
        chunks, at = coded.dictionary, coded.indices.to_numpy()
        behind = np.bincount(np.delete(at, heads), minlength=len(chunks)) > 0  # chunks that stand after a space
        first, of_text = np.unique(at[heads], return_inverse=True)
        of_first = _of_bytes(self._whole(chunks.take(pa.array(first)).to_pylist()))
        spot = (np.cumsum(behind) - 1)[at]
        spot[heads] = np.count_nonzero(behind) + of_text
        ids, bounds = _taken(_chained(self._chunks(chunks.filter(pa.array(behind))), of_first), spot)
        return np.split(ids, bounds[heads[1:]])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        whole = [_UNSAFE.search(t) is not None or any(s in t for s in self.special) for t in texts]
        self.of_chunk.turn()
        of_whole = iter(self._whole([t for t, w in zip(texts, whole) if w]))
        cut = [t for t, w in zip(texts, whole) if not w]
        of_cut = iter(self._cut(cut) if cut else ())
        return [np.frombuffer(next(of_whole), np.uint32) if w else next(of_cut) for w in whole]


@functools.lru_cache(maxsize=1)
def encoder(path: str = PATH, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, remembered)
