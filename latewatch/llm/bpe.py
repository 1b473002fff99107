"""BPE encoding and decoding by prefix-sharing trie traversal.

The last token of a word's encoding is fixed by the word's prefixes: of all tokens
that end a prefix, exactly one goes with the last token of what stands before it.
So each batch's distinct new words go into one trie of bytes (kept as the sorted words
and what each shares with the one before); a depth-first walk
gives every node the last token of its prefix and the node where that token
begins.  What words share at their start is worked out once, and a word's
encoding is read off by following the last tokens back to the root.

Two tokens go together if the merges would leave them side by side: no merge of
a right-edge part of the first with a left-edge part of the second may come before
both parts are merged into something larger (of equal ranks the left one comes
first).  An automaton over the tokens, stepped along the trie, lists those that end
at a node.

Whole texts are cut as in :mod:`.chunks`.  A special token's string in a text is
that token, as in the library.  Decoding joins the tokens' bytes and reads them
as UTF-8, with U+FFFD for what is none.

Null texts count as empty.  Repeated rows are encoded each; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, byte_letters, vocabulary
from .common import slices

NEVER = 1 << 60
#: Token pairs that a worker remembers.
PAIRS = 400_000
#: Steps of the automaton that a worker holds, those past failed ones among them.
STEPS = 400_000
#: Words of one trie.
RUN = 65_536
#: Text bytes encoded at once.
SLICE = 2 << 20
#: Pieces and chunks that a worker remembers.
PIECES, CHUNKS = 150_000, 80_000


class Vocabulary:
    """Tokens, merges and what follows from them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        of = byte_letters()
        spell = lambda s: bytes(of[c] for c in s)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {spell(s): i for s, i in data["model"]["vocab"].items() if s not in self.special}
        top = max([*self.ids.values(), *self.special.values()])
        self.text = [b""] * (top + 1)
        for b, i in self.ids.items():
            self.text[i] = b
        for s, i in self.special.items():
            self.text[i] = s.encode()
        self.decimal = self._flat([b",%d" % i for i in range(top + 1)])
        self.letters = self._flat(self.text)
        self.merges: dict[int, int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = (self.ids[spell(x)] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.merges[a << 32 | b] = rank
            parts.setdefault(self.ids[self.text[a] + self.text[b]], (a, b, rank))
        self.parts = parts
        self.packed = [np.array([i], np.uint32).tobytes() for i in range(top + 1)]
        self._automaton()

    def _automaton(self) -> None:
        """``step``: state << 8 | byte to the state of the longest token start that ends there;
        ``ends``: the tokens that end in a state, (id, length), longest first."""
        step: dict[int, int] = {}
        word, depth, byte_of, parent = [-1], [0], [0], [0]
        for token in sorted(self.ids):
            state = 0
            for b in token:
                key = state << 8 | b
                if key not in step:
                    step[key] = len(word)
                    word.append(-1)
                    depth.append(depth[state] + 1)
                    byte_of.append(b)
                    parent.append(state)
                state = step[key]
            word[state] = self.ids[token]
        fall, ends = [0] * len(word), [()] * len(word)
        for s in sorted(range(1, len(word)), key=depth.__getitem__):
            f, b = fall[parent[s]], byte_of[s]
            if parent[s]:
                while f and f << 8 | b not in step:
                    f = fall[f]
                fall[s] = step.get(f << 8 | b, 0)
            ends[s] = (((word[s], depth[s]),) if word[s] >= 0 else ()) + ends[fall[s]]
        self._step, self._fall, self.ends = step, fall, ends

    @staticmethod
    def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All strings' bytes, where each begins and how long it is."""
        length = np.fromiter(map(len, strings), np.int64, len(strings))
        return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(length) - length, length

    @staticmethod
    def joined(flat: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, at: np.ndarray) -> tuple[bytes, list[int]]:
        """The strings of all ids one after another, and where those from each of ``at`` on begin."""
        data, start, length = flat
        n = length[ids]
        ends = np.cumsum(n)
        place = np.repeat(start[ids] - (ends - n), n)
        place += np.arange(len(place))
        return data[place].tobytes(), np.concatenate([[0], ends])[at].tolist()

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that takes it) along one edge of a token, from the token down."""
        out, taken = [(token, NEVER)], token
        while taken in self.parts:
            rank = self.parts[taken][2]
            taken = self.parts[taken][side]
            out.append((taken, rank))
        return out

    def go_together(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``a`` before token ``b`` as they are."""
        get, right = self.merges.get, self._edge(a, 1)
        for y, until_y in self._edge(b, 0):
            for x, until_x in right:
                rank = get(x << 32 | y)
                if rank is not None and rank < until_x and rank <= until_y:
                    return False
        return True


class TrieEncoder:
    """Encodes distinct words together."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self._known: dict[int, bool] = {}

    def __call__(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word.

        In runs of sorted words, so that a trie stays small and shares most.
        """
        out: list[bytes] = [b""] * len(words)
        spelt = [w.encode() for w in words]
        order = sorted(range(len(words)), key=spelt.__getitem__)
        for at in range(0, len(order), RUN):
            self._walk(spelt, order[at:at + RUN], out)
        return out

    def _walk(self, words: list[bytes], numbers: list[int], out: list[bytes]) -> None:
        """Depth first over the trie of the words ``numbers`` names in order.

        Sorted words and the length of the prefix that each shares with the one before are the trie: a walk
        goes back to that prefix and down the rest.  The lists hold the path, a place for each prefix.
        """
        known, steps, fall, ends, together, packed = self._known, self.v._step, self.v._fall, self.v.ends, self.v.go_together, self.v.packed
        last, coded, states = [0], [b""], [0]  # of the path's prefixes: their last tokens, their ids, the automaton's states
        before = b""
        for number in numbers:
            word = words[number]
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], coded[shared + 1:], states[shared + 1:]
            state = states[shared]
            for n, b in enumerate(word[shared:], shared + 1):
                key = state << 8 | b
                found = steps.get(key)
                if found is None:
                    while found is None and state:
                        state = fall[state]
                        found = steps.get(state << 8 | b)
                    found = found or 0
                    if len(steps) < STEPS:  # the next time it is one step
                        steps[key] = found
                state = found
                for token, length in ends[state]:
                    if length == n:
                        break
                    pair = last[n - length] << 32 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = together(last[n - length], token)
                        if len(known) < PAIRS:
                            known[pair] = fits
                    if fits:
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
                last.append(token)
                coded.append(coded[n - length] + packed[token])
                states.append(state)
            out[number] = coded[-1]
            before = word


class Codec:
    """Encoding and decoding of whole texts; kept by the worker between tasks."""

    def __init__(self, path: str) -> None:
        self.v = Vocabulary(path)
        self.encode = ChunkEncoder(TrieEncoder(self.v), self._whole, list(self.v.special), PIECES, CHUNKS)
        self._split = re.compile("(" + "|".join(map(re.escape, self.v.special)) + ")") if self.v.special else None

    def _whole(self, text: str) -> bytes:
        """A text that holds special tokens: what stands between them goes on its own."""
        out = []
        for part in self._split.split(text):
            if part in self.v.special:
                out.append(np.array([self.v.special[part]], np.uint32).tobytes())
            elif part:
                out.append(self.encode(pa.array([part], pa.string()))[0].tobytes())
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """The UTF-8 bytes of the decoded text."""
        return readable(b"".join(map(self.v.text.__getitem__, ids)))


def readable(found: bytes) -> bytes:
    """Bytes as UTF-8, with U+FFFD for what is none."""
    try:
        found.decode()
    except UnicodeDecodeError:
        return found.decode(errors="replace").encode()
    return found


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
        gc.freeze()  # the vocabulary stays as long as the worker; collections need not visit it
    return _CODECS[path]


def _coded(path: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, at = own.encode(part.column("text"))
                spoken, said_at = own.v.joined(own.v.decimal, ids, at)
                spelt, back_at = own.v.joined(own.v.letters, ids, at)
                said = [hashlib.sha256(spoken[a + 1:b]).hexdigest() for a, b in zip(said_at, said_at[1:])]
                decoded = [readable(spelt[a:b]) for a, b in zip(back_at, back_at[1:])]
                back = [hashlib.sha256(t).hexdigest() for t in decoded]
                n = np.diff(at)
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts:
                    columns += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))), pa.array([t.decode() for t in decoded], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def code(docs: DataFrame, path: str | None = None, texts: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with ``texts`` also ids and decoded."""
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_coded(path or vocabulary(), texts), columns)
