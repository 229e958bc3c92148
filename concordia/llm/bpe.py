"""Exact byte-pair encoding of a corpus by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that ends its encoding.
An automaton over all tokens yields, at each position, the tokens that are
suffixes of the prefix; the longest one that is compatible with the last token
of what precedes it is the prefix's last token. Following these back from the
end gives the ids, in time linear in the piece, with no merging at all. Pieces
not met lately go through the automaton side by side, as array operations.

Two adjacent tokens are compatible if re-merging their text gives the same two
tokens. That is decided from the merges alone: undo the later-made of the two
tokens, step by step, and see whether at some step a pair across the border
would have been merged earlier than the tokens beside it.

Texts are looked up blank by blank: a blank before a visible character always
begins a piece, so what stands between two such blanks is encoded by itself and
its ids, packed as bytes, are joined to those of the text. What a worker has
met lately it remembers, up to a bound; that decides on speed only.

Null and empty texts have the empty list of ids. Special tokens' strings in a
text are ordinary text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: how byte-level vocabularies of this kind cut a text into pieces.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: A blank within a run of white space, before which a text without one can be cut at every blank; others only before a blank that a visible character follows.
RUN = re.compile(r"\s (?:\s|$)")
CUT = regex.compile(r"(?= \P{White_Space})")
#: Entries of a worker's memory; beyond half of it the older half makes room.
REMEMBERED = 300_000
#: Characters of pieces worked out at once.
CHUNK = 500_000
#: Token ids have fewer bits.
_BITS = 24
#: Longer stretches are not remembered.
LONGEST = 64


def default_vocabulary() -> str:
    """Path of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of such vocabularies for bytes: bytes that print stand for themselves, the rest follow from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Encoder of one vocabulary file (tokenizers' JSON form of byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet, vocab = byte_alphabet(), model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        size = max(vocab.values()) + 1
        text: dict[int, bytes] = {vocab[c]: bytes([b]) for c, b in alphabet.items() if c in vocab}
        #: token -> number of the merge that makes it (bytes have none), and its two parts
        self.made, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        pair_keys = np.empty(len(merges), np.int64)
        for order, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            pair_keys[order] = left << _BITS | right
            if whole not in text:
                self.made[whole], self.left[whole], self.right[whole] = order, left, right
                text[whole] = text[left] + text[right]
        self.pair_order = np.argsort(pair_keys, kind="stable")
        self.pair_keys = pair_keys[self.pair_order]
        self.no_limit = len(merges) + 1
        self.slots = np.full(1 << 20, -1, np.int64)  # remembered pairs: a key a slot, the latest stays
        self.answers = np.zeros(1 << 20, bool)

        by_merge = np.flatnonzero(self.made >= 0)
        by_merge = by_merge[np.argsort(self.made[by_merge])]
        apart = self._apart(self.left[by_merge], self.right[by_merge], self.made[by_merge])
        stands = {t for t in text if self.made[t] < 0}
        for token, left, right, fine in zip(by_merge.tolist(), self.left[by_merge].tolist(), self.right[by_merge].tolist(), apart.tolist()):
            if fine and left in stands and right in stands:  # in the order made: the parts come first
                stands.add(token)
        self._build({text[t]: t for t in stands}, size)  # tokens that encoding can produce
        self.pieces = regex.compile(SPLIT).findall
        #: what was worked out lately: stretch after its leading blank -> ids of blank and stretch, and piece -> ids; of two generations each the older makes room
        self.known, self.known_before = {}, {}
        self.known_pieces, self.known_pieces_before = {}, {}

    def _build(self, tokens: dict[bytes, int], size: int) -> None:
        """The automaton: ``step`` (state, byte) -> state, ``longest`` token that ends in a state, and ``shorter``, the next token that is a suffix of a token."""
        child: dict[int, int] = {}
        parent, byte, depth, own = [0], [0], [0], [-1]
        for word, token in tokens.items():
            at = 0
            for b in word:
                to = child.get(at << 8 | b)
                if to is None:
                    to = child[at << 8 | b] = len(parent)
                    parent.append(at)
                    byte.append(b)
                    depth.append(depth[at] + 1)
                    own.append(-1)
                at = to
            own[at] = token
        parent, byte, depth, own = (np.array(x, np.int32) for x in (parent, byte, depth, own))
        self.step = np.zeros((len(parent), 256), np.int32)
        fail = np.zeros(len(parent), np.int32)
        longest = own.copy()
        for d in range(int(depth.max()) + 1):
            here = np.flatnonzero(depth == d)
            if d:
                fail[here] = self.step[fail[parent[here]], byte[here]] if d > 1 else 0
                self.step[here] = self.step[fail[here]]
                longest[here] = np.where(own[here] >= 0, own[here], longest[fail[here]])
            below = np.flatnonzero(depth == d + 1)
            self.step[parent[below], byte[below]] = below
        self.longest = longest
        self.shorter, self.sizes = np.full(size, -1, np.int32), np.ones(size, np.int32)
        ends = np.flatnonzero(own >= 0)
        self.shorter[own[ends]] = longest[fail[ends]]
        self.sizes[own[ends]] = depth[ends]

    def _apart(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether no merge made before ``limit`` joins left and right while both are being built."""
        out = np.ones(len(left), bool)
        at = np.arange(len(left))
        while len(at):
            keys = left << _BITS | right
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            joined = (self.pair_keys[place] == keys) & (self.pair_order[place] < limit)
            out[at[joined]] = False
            l, r = self.made[left], self.made[right]
            go = ~joined & ((l >= 0) | (r >= 0))
            at, left, right, l, r = at[go], left[go], right[go], l[go], r[go]
            # undo the later of the two; of equal ones the right one, which was merged after the left one
            undo = l > r
            limit = np.where(undo, l, r + 1)
            left, right = np.where(undo, self.right[left], left), np.where(undo, right, self.left[right])
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether re-merging the text of two adjacent tokens gives the same two tokens."""
        keys = left.astype(np.int64) << _BITS | right
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        missing = self.slots[slot] != keys
        out = self.answers[slot]
        if missing.any():
            new, back = np.unique(keys[missing], return_inverse=True)
            found = self._apart(new >> _BITS, new & (1 << _BITS) - 1, np.full(len(new), self.no_limit))
            out[missing] = found[back]
            self.slots[slot[missing]], self.answers[slot[missing]] = keys[missing], out[missing]
        return out

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of each piece: all pieces go through the automaton side by side, byte by byte."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        size = np.array([len(d) for d in data])
        order = np.argsort(-size, kind="stable")  # those not at their end come first
        size = size[order]
        flat = np.frombuffer(b"".join(data[i] for i in order.tolist()), np.uint8)
        off = np.cumsum(size) - size
        base = off + np.arange(len(size))  # of a piece's prefixes, the empty one included
        last = np.full(len(flat) + len(size), -1, np.int32)
        state = np.zeros(len(size), np.int32)
        for e in range(int(size[0])):
            m = int(np.searchsorted(-size, -e))  # pieces longer than e
            state = self.step[state[:m], flat[off[:m] + e]]
            token, todo = self.longest[state], np.arange(m)
            while len(todo):  # the longest token first
                if (token < 0).any():
                    raise ValueError(f"no token of the vocabulary ends at byte {e + 1} of a piece")
                start = e + 1 - self.sizes[token]
                fits = start == 0
                ask = np.flatnonzero(~fits)
                if len(ask):
                    fits[ask] = self.compatible(last[base[todo[ask]] + start[ask]], token[ask])
                last[base[todo[fits]] + e + 1] = token[fits]
                todo, token = todo[~fits], self.shorter[token[~fits]]
        # back from the end of each piece
        out = np.zeros(len(flat), np.int32)
        at, write, going = size.copy(), off + size, np.arange(len(size))
        while len(going):
            token = last[base[going] + at[going]]
            write[going] -= 1
            out[write[going]] = token
            at[going] -= self.sizes[token]
            going = going[at[going] > 0]
        blob, found = out.tobytes(), [b""] * len(pieces)
        for i, a, b in zip(order.tolist(), (4 * write).tolist(), (4 * (off + size)).tolist()):
            found[i] = blob[a:b]
        return found

    def _learn_pieces(self, wanted: set[str]) -> None:
        new = []
        for piece in wanted:
            old = self.known_pieces_before.get(piece)
            if old is None:
                new.append(piece)
            else:
                self.known_pieces[piece] = old
        new.sort(key=len)
        at = 0
        while at < len(new):  # pieces of a size together, about CHUNK characters at once
            stop = max(at + 1, min(len(new), at + CHUNK // len(new[at])))
            while stop - at > 1 and len(new[stop - 1]) > 2 * len(new[at]) + 8:
                stop = at + (stop - at) // 2
            self.known_pieces.update(zip(new[at:stop], self._encode_pieces(new[at:stop])))
            at = stop

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        stretches: list[tuple[str, list[str]]] = []
        for text in texts:
            if not text or RUN.search(text) is None:
                words = (text or "").split(" ")
                stretches.append((words[0], words[1:]))
            else:
                first, *rest = CUT.split(text)
                stretches.append((first, [x[1:] for x in rest]))
        if len(self.known) > REMEMBERED // 2:
            self.known, self.known_before = {}, self.known
        if len(self.known_pieces) > REMEMBERED // 2:
            self.known_pieces, self.known_pieces_before = {}, self.known_pieces
        known, before = self.known, self.known_before
        new: dict[str, list[str]] = {}
        for word in set().union(*[rest for _, rest in stretches]).difference(known):
            old = before.get(word)
            if old is None:
                new[word] = self.pieces(" " + word)
            else:
                known[word] = old
        firsts = [self.pieces(first) for first, _ in stretches]
        pieces = self.known_pieces
        self._learn_pieces({p for x in (*new.values(), *firsts) for p in x if p not in pieces})
        get = pieces.__getitem__
        for word, parts in new.items():
            known[word] = b"".join(map(get, parts))
        out = [b"".join(map(get, first)) + b"".join(map(known.__getitem__, rest)) for first, (_, rest) in zip(firsts, stretches)]
        for memory in (known, pieces):
            for long_ in [w for w in (new if memory is known else {p for x in (*new.values(), *firsts) for p in x}) if len(w) > LONGEST]:
                memory.pop(long_, None)
        return out

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()


_LOADED: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """The encoder of a file, read once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = PrefixEncoder(path)
    return _LOADED[path]


def _apply(df: DataFrame, text: str, column: str, kind: T.DataType, path: str, gather) -> DataFrame:
    keep = [c for c in df.columns if c.lower() != column.lower()]
    inputs = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text_to_encode"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(path).packed
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                values = gather(packed(part.column("_text_to_encode").to_pylist()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], values], names=[*keep, column])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(column, kind)])
    return inputs.mapInArrow(run, schema)


def _sizes(packed: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, packed), np.int64, len(packed)) // 4


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(_sizes(packed))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode_column(df: DataFrame, text: str, column: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with ``column``, the token ids of ``text``; a column of that name is replaced. ``path`` must be readable by the executors."""
    return _apply(df, text, column, T.ArrayType(T.IntegerType()), path or default_vocabulary(), _lists)


def count_column(df: DataFrame, text: str, column: str = "n_tokens", path: str | None = None) -> DataFrame:
    """As :func:`encode_column`, with the number of tokens only."""
    return _apply(df, text, column, T.LongType(), path or default_vocabulary(), lambda packed: pa.array(_sizes(packed)))
