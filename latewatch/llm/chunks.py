"""Byte-level BPE over whole texts through distinct chunks.

In the pattern of the byte-level vocabulary a token may begin with one white-space
character but never contains one after another character.  So a text may be cut
before every space that stands between two other characters, and the chunks
encode on their own.  A batch is cut and made distinct in Arrow; only distinct
chunks that are new to the worker reach Python, and only their distinct pieces
(matches of the pattern) reach the encoder.  Texts with other runs of white
space are cut by the pattern itself.  Texts that hold a special token's string
go to ``whole``.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the public pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES, CHUNKS, LONGEST = 500_000, 500_000, 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public vocabulary; callers may pass any other path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def library(path: str):
    """The tokenizers library on a vocabulary file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def runs(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Little-endian 32-bit ids as strings of bytes; ends: where each string ends, after a first 0."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(ids.astype(np.uint32, copy=False))])


def _joined(ids: pa.Array, at: np.ndarray) -> pa.Array:
    """What lies between each two of the places ``at`` in ``ids`` as one string."""
    ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset + at]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(ends), ids.buffers()[2]])


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


class Known:
    """The ids of strings; remembers up to ``limit`` strings, then forgets them all and begins anew."""

    def __init__(self, encode: Callable[[pa.Array], pa.Array], limit: int) -> None:
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def __call__(self, words: pa.Array) -> pa.Array:
        """words: distinct strings."""
        at = pc.index_in(words, value_set=self.words)
        if not at.null_count:
            return self.ids.take(at)
        at = at.to_numpy(zero_copy_only=False)
        missing = np.isnan(at)
        new = words.filter(pa.array(missing))
        fresh = self.encode(new)
        place = np.where(missing, len(self.ids) + np.cumsum(missing) - 1, at).astype(np.int64)
        found = pa.concat_arrays([self.ids, fresh]).take(pa.array(place))
        short = pc.less_equal(pc.binary_length(new), LONGEST)
        new, fresh = new.filter(short), fresh.filter(short)
        if len(self.words) + len(new) > self.limit:
            self._forget()
        if len(new) <= self.limit:
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, fresh])
        return found


class ChunkEncoder:
    """Encodes string columns; pieces and chunks are remembered up to fixed numbers (see ``Known``).

    encode_pieces: list of pieces to their little-endian 32-bit id strings, a list or an Arrow array of large binary.
    whole: one text to the same; special: strings that make a text go there.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes] | pa.Array], whole: Callable[[str], bytes], special: list[str],
                 n_pieces: int = PIECES, n_chunks: int = CHUNKS) -> None:
        self.encode_pieces, self.special_text, self.special = encode_pieces, whole, special
        self.pieces, self.chunks = Known(self._new_pieces, n_pieces), Known(self._after_space, n_chunks)
        self.find = regex.compile(PATTERN).findall

    def _new_pieces(self, pieces: pa.Array) -> pa.Array:
        found = self.encode_pieces(_strings(pieces))
        return found if isinstance(found, pa.Array) else pa.array(found, pa.large_binary())

    def _ids(self, pieces: pa.Array) -> pa.Array:
        """The ids of each match of the pattern."""
        coded = pieces.dictionary_encode()
        return self.pieces(coded.dictionary).take(coded.indices)

    def _whole(self, texts: list[str]) -> pa.Array:
        """The ids of texts that may be cut by the pattern alone."""
        found = list(map(self.find, texts))
        return _joined(self._ids(pa.array(itertools.chain.from_iterable(found), pa.string())), np.cumsum([0, *map(len, found)]))

    def _after_space(self, words: pa.Array) -> pa.Array:
        """The ids of each word with a space before it; words have no space, nor white space at their ends."""
        # cut in one go: a piece begins with the space exactly where a word begins
        pieces = pa.array(self.find(" " + " ".join(_strings(words))), pa.string())
        begins = np.flatnonzero(pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False))
        return _joined(self._ids(pieces), np.append(begins, len(pieces)))

    @staticmethod
    def _odd(words: pa.Array) -> np.ndarray:
        """Whether a word is empty, or begins or ends with white space."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
        odd = ends[1:] == ends[:-1]
        sides = np.stack([data[np.minimum(ends[:-1], len(data) - 1)], data[np.maximum(ends[1:] - 1, 0)]])
        rest = np.flatnonzero(~odd & ~((sides > 32) & (sides < 127)).all(0))  # all but printable ASCII
        odd[rest] = [w[0].isspace() or w[-1].isspace() for w in _strings(words.take(pa.array(rest)))]
        return odd

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more entry than texts). Null as empty."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        cut = pc.split_pattern(texts, " ")
        starts = cut.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        coded = cut.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary
        first, size = starts[:-1], np.diff(starts)
        slow = np.logical_or.reduceat(self._odd(words)[index], first)
        for s in self.special:
            slow |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        # chunks: each word with a space before it, each first word without
        used = np.repeat(~slow, size)
        used[first] = False
        need = np.zeros(len(words), bool)
        need[index[np.flatnonzero(used)]] = True
        ids = self.chunks(words.filter(pa.array(need)))
        # each text's own: its first word, or all of it
        heads = _strings(words.take(pa.array(index[first])))
        alone = [t.as_py() if s else h for t, s, h in zip(texts, slow.tolist(), heads, strict=True)]
        whole = [s and any(x in t for x in self.special) for s, t in zip(slow.tolist(), alone, strict=True)]
        number = {t: i for i, t in enumerate(dict.fromkeys(t for t, w in zip(alone, whole, strict=True) if not w))}
        special = [self.special_text(t) for t, w in zip(alone, whole, strict=True) if w]
        table = pa.concat_arrays([ids, self._whole(list(number)), pa.array(special, pa.large_binary())])
        following = itertools.count(len(ids) + len(number))
        # spread the distinct ids over all places
        place = (np.cumsum(need) - 1).astype(np.int32)[index]
        place[first] = [next(following) if w else len(ids) + number[t] for t, w in zip(alone, whole, strict=True)]
        used[first] = True
        spread = table.take(pa.array(place if used.all() else place[used]))
        ends = np.frombuffer(spread.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(np.where(slow, 1, size))])] // 4
        return np.frombuffer(spread.buffers()[2] or b"", np.uint32)[:ends[-1]], ends
