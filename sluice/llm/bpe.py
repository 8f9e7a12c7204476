"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Every prefix of the input has one BPE encoding, and so one last token: the token that ends there and that stays apart from
the last token of the prefix before it. Which tokens may end at a place is told by an automaton over the trie of all tokens
(with failure links). A state of the transducer is a place of that automaton with the last tokens of the prefixes since the
last token emitted; a token is emitted once every way in which the input can go on agrees on it, which is after no more bytes
than the longest token has. States and transitions are made when an input comes to them a second time; where there is none
yet, the rest of the match goes through the undetermined machine, which gives the same ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import sys
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import held

#: States that are kept (and transitions, twice as many), and chunks of text in each of two generations whose ids are remembered.
MAX_STATES, MAX_CHUNKS = 40_000, 500_000
_NEVER = 1 << 62
#: Ids that decoding takes at once.
STEP = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """Plain merging, lowest rank first, until `least` parts are left or nothing can be merged."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > least:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Pairs:
    """Whether two neighbouring tokens stay apart when their joined bytes are merged. Ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], room: int):
        self.ranks, self.room = ranks, room
        self.bytes = {v: k for k, v in ranks.items()}
        self.base = max(ranks.values(), default=0) + 1
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._known: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging joins last; (-1, -1) for a single byte, None for a token that merging never makes."""
        got = self._halves.get(token, 0)
        if got == 0:
            data = self.bytes[token]
            parts = merge(data, self.ranks, 2)
            got = (-1, -1) if len(data) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
            self._halves[token] = got
        return got

    def apart(self, a: int, b: int) -> bool:
        key = a * self.base + b
        got = self._known.get(key)
        if got is None:
            if len(self._known) >= self.room:
                self._known.clear()
            got = self._known[key] = self._apart(a, b)
        return got

    def _apart(self, a: int, b: int) -> bool:
        """Merges are undone from the last to the first; x and y meet at the border, each until it becomes part of a longer token.

        They are joined if their join has a lower rank than the merge that takes either of them away; of equal ranks the
        one further left comes first.
        """
        if self.halves(b) is None:
            return False
        data, x, y, until_x, until_y = self.bytes, a, b, _NEVER, _NEVER
        while True:
            joint = self.ranks.get(data[x] + data[y])
            if joint is not None and joint < until_x and joint <= until_y:
                return False
            left, right = self.halves(x), self.halves(y)
            made_x, made_y = x if left[0] >= 0 else -1, y if right[0] >= 0 else -1
            if made_y >= made_x and made_y >= 0:
                y, until_y = right[0], y
            elif made_x >= 0:
                x, until_x = left[1], x
            else:
                return True


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.max_states, self.pairs = max_states, Pairs(ranks, 8 * max_states)
        self.length = {v: len(k) for k, v in ranks.items()}
        self._automaton(ranks)
        #: the automaton's place; last token of each prefix since the last token emitted (that one first, -1 if none); and for
        #: each of these prefixes the ends of its tokens as bits
        self.states: list[tuple[int, tuple[int, ...], tuple[int, ...]]] = [(0, (-1,), (1,))]
        self.number: dict[tuple[int, ...], int] = {(-1,): 0}
        #: state * 256 + byte -> (state, ids emitted), or just the state where none are
        self.go: dict[int, int | tuple[int, tuple[int, ...]]] = {}
        self.met: set[int] = set()
        self.ends: dict[int, tuple[int, ...]] = {}

    def _automaton(self, ranks: dict[bytes, int]) -> None:
        """A trie of all tokens; of each node its depth, whether it goes on, its failure link, and the tokens that end there.

        shorter: of each token the longest other one that it begins with, -1 if there is none.
        """
        self.child: dict[int, int] = {}
        self.depth, self.inner, own, below = [0], [True], [-1], [[]]
        self.own, self.shorter = own, {}
        for token, rank in sorted(ranks.items(), key=lambda x: len(x[0])):
            node, self.shorter[rank] = 0, -1
            for byte in token:
                if own[node] >= 0:
                    self.shorter[rank] = own[node]
                key = node << 8 | byte
                to = self.child.get(key)
                if to is None:
                    to = self.child[key] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    self.inner[node] = True
                    self.inner.append(False)
                    own.append(-1)
                    below[node].append((byte, to))
                    below.append([])
                node = to
            own[node] = rank
        self.fail, self.found = [0] * len(own), [()] * len(own)
        todo = deque([0])
        while todo:
            node = todo.popleft()
            for byte, to in below[node]:
                self.fail[to] = self._goto(self.fail[node], byte) if node else 0
                self.found[to] = (((self.depth[to], own[to]),) if own[to] >= 0 else ()) + self.found[self.fail[to]]
                todo.append(to)

    def _goto(self, node: int, byte: int) -> int:
        while (to := self.child.get(node << 8 | byte)) is None and node:
            node = self.fail[node]
        return to or 0

    def _path(self, last: tuple | list, end: int) -> list[int]:
        """The tokens that lead to the place `end`."""
        out = []
        while end:
            out.append(last[end])
            end -= self.length[last[end]]
        return out[::-1]

    def _run(self, before: int, data: bytes) -> list[int]:
        """Ids of data after the token `before` (-1: none), by the undetermined machine, longest tokens first.

        A prefix has one encoding, so that a place from which nothing goes on is left for good.
        """
        child, own, length, shorter, known, base = self.child, self.own, self.length, self.shorter, self.pairs._known, self.pairs.base
        out, dead, at, p, size = [], (), 0, before, len(data)
        while at < size:
            node, t = 0, -1
            for byte in data[at:] if at else data:
                node = child.get(node << 8 | byte)
                if node is None:
                    break
                if own[node] >= 0:
                    t = own[node]
            while True:
                while t >= 0:
                    end = at + length[t]
                    if end not in dead:
                        if p < 0:
                            if self.pairs.halves(t) is not None:
                                break
                        elif (k := known.get(p * base + t)) or k is None and self.pairs.apart(p, t):
                            break
                    t = shorter[t]
                if t >= 0:
                    break
                dead = {*dead, at}
                t = out.pop()
                at, p, t = at - length[t], out[-1] if out else before, shorter[t]
            out.append(t)
            at, p = end, t
        return out

    def _advance(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """The state after one more byte, and the ids emitted."""
        node, last, ends = state
        node, n = self._goto(node, byte), len(last)
        for length, t in self.found[node]:
            p = last[n - length]
            if self.pairs.apart(p, t) if p >= 0 else self.pairs.halves(t) is not None:
                break
        mask = ends[n - length] | 1 << n
        last, ends = (*last, t), (*ends, mask)
        common, at = mask, node
        while at:  # places where a longer token may have begun
            if self.inner[at]:
                common &= ends[n - self.depth[at]]
            at = self.fail[at]
        cut, emitted = common.bit_length() - 1, ()
        if cut:
            emitted = tuple(self._path(last, cut))
            last, ends = last[cut:], tuple(e >> cut | 1 for e in ends[cut:])
            while self.depth[node] > n - cut:
                node = self.fail[node]
        return (node, last, ends), emitted

    def _learn(self, at: int, byte: int) -> tuple[int, tuple[int, ...]] | None:
        """The transition, if it is met again and there is room for it."""
        key = at << 8 | byte
        if len(self.states) >= self.max_states or len(self.go) >= 2 * self.max_states:
            return None
        if key not in self.met:
            if len(self.met) >= 2 * self.max_states:
                self.met.clear()
            self.met.add(key)
            return None
        state, emitted = self._advance(self.states[at], byte)
        to = self.number.get(state[1])
        if to is None:
            to = self.number[state[1]] = len(self.states)
            self.states.append(state)
        self.go[key] = (to, emitted) if emitted else to
        return to, emitted

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        out: list[int] = []
        go, at = self.go, 0
        for k, byte in enumerate(piece):
            step = go.get(at << 8 | byte)
            if step.__class__ is int:
                at = step
                continue
            step = step or self._learn(at, byte)
            if step is None:
                last = self.states[at][1]
                return out + self._run(last[0], piece[k + 1 - len(last) :])
            at, emitted = step
            out += emitted
        end = self.ends.get(at)
        if end is None:
            last = self.states[at][1]
            end = self.ends[at] = tuple(self._path(last, len(last) - 1))
        out += end
        return out


#: White space as the pattern's \s has it; the rest is rare.
_BLANK = [chr(c) for c in (*range(9, 14), 32)]
_RARE = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_CLASS = re.escape("".join(_BLANK + _RARE))
_RUN = re.compile(f"[{_CLASS}]*[^{_CLASS}]+|[{_CLASS}]+")


class Chunks(dict):
    """Remembers the packed ids of pieces of text in two generations of `room` pieces each: those met again move on, others go."""

    def __init__(self, encode, room: int = MAX_CHUNKS):
        super().__init__()
        self.encode, self.room, self.old = encode, room, {}

    def __missing__(self, chunk: str) -> bytes:
        out = self.old.get(chunk)
        if out is None:
            out = self.encode(chunk)
        if len(chunk) < 64:
            if len(self) >= self.room:
                self.old = dict(self)
                self.clear()
            self[chunk] = out
        return out


def chunks(text: str) -> list[str]:
    """text cut in front of runs of white space, where no match of the pattern can lie across."""
    return _RUN.findall(text)


def by_spaces(text: str) -> list[str] | None:
    """text split by single spaces, if each has no other white space before it; else None.

    The pattern takes a space only at the front of a match, or inside a run of white space.
    """
    if any(c + " " in text for c in _BLANK) or not text.isascii() and any(c in text for c in _RARE):
        return None
    return text.split(" ")


def unspaced() -> str:
    """A pattern that is found in the texts for which by_spaces gives None."""
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in _BLANK) + "] |[" + "".join(f"\\x{{{ord(c):X}}}" for c in _RARE) + "]"


class Tokenizer:
    """Encodes whole texts as tiktoken would (no special tokens): each match of the pattern by the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS):
        self.transducer, self.pattern = Transducer(ranks, max_states), regex.compile(pattern.replace(r"[^\s", f"[^{_CLASS}").replace(r"\s", f"[{_CLASS}]").replace(r"\S", f"[^{_CLASS}]"))
        self.pool = np.frombuffer(b"".join(ranks), np.uint8)
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.starts = np.zeros_like(self.sizes)
        numbers, sizes = list(ranks.values()), np.array([len(t) for t in ranks], np.int64)
        self.sizes[numbers], self.starts[numbers] = sizes, np.cumsum(sizes) - sizes
        self.first, self.after = Chunks(self._chunk, max_chunks), Chunks(lambda c: self._chunk(" " + c), max_chunks)
        self.piece = Chunks(self._piece, max_chunks // 4)

    def _chunk(self, chunk: str) -> bytes:
        matches = self.pattern.findall(chunk)
        return self._piece(chunk) if len(matches) == 1 else b"".join(map(self.piece.__getitem__, matches))

    def _piece(self, match: str) -> bytes:
        ids = array("I", self.transducer.encode(match.encode("utf-8", "replace")))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; None is empty."""
        if not text:
            return b""
        parts = by_spaces(text)
        if parts is None:
            return b"".join(map(self.first.__getitem__, chunks(text)))
        return self.first[parts[0]] + b"".join(map(self.after.__getitem__, parts[1:]))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids, which may break off within a code point."""
        numbers = np.frombuffer(ids, "<u4")
        sizes = self.sizes[numbers]
        places = np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes)
        places += np.arange(len(places))
        return self.pool[places].tobytes()

    def stream(self, ids: bytes, step: int = 1) -> Iterator[str]:
        """Text as far as whole code points have come, after each `step` of the packed ids."""
        machine = Utf8Machine()
        for k in range(0, len(ids), 4 * step):
            yield machine.feed(self.decode(ids[k : k + 4 * step]))
        yield machine.finish()


class Utf8Machine:
    """An incremental decoder of UTF-8: state is how many bytes are to come, and within which bounds the next must lie.

    Between code points, as long as bytes are sound, it takes them at once.
    """

    def __init__(self):
        self.to_come, self.low, self.high, self.held = 0, 0x80, 0xBF, bytearray()

    def feed(self, data: bytes) -> str:
        out, at, view = [], 0, memoryview(data)
        while at < len(data):
            if not self.to_come:
                try:
                    out.append(str(view[at:], "utf-8"))
                    break
                except UnicodeDecodeError as e:
                    out.append(str(view[at : at + e.start], "utf-8"))
                    at += e.start
            out.append(self._byte(data[at]))
            at += 1
        return "".join(out)

    def _byte(self, b: int) -> str:
        bad = ""
        if self.to_come:
            if self.low <= b <= self.high:
                self.held.append(b)
                self.to_come, self.low, self.high = self.to_come - 1, 0x80, 0xBF
                if self.to_come:
                    return ""
                out = self.held.decode("utf-8")
                self.held.clear()
                return out
            bad = "\ufffd"
            self.held.clear()
            self.to_come, self.low, self.high = 0, 0x80, 0xBF
        if b < 0x80:
            return bad + chr(b)
        if 0xC2 <= b <= 0xF4:
            self.to_come = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
            self.low = 0xA0 if b == 0xE0 else 0x90 if b == 0xF0 else 0x80
            self.high = 0x9F if b == 0xED else 0x8F if b == 0xF4 else 0xBF
            self.held.append(b)
            return bad
        return bad + "\ufffd"

    def finish(self) -> str:
        left, self.to_come = bool(self.to_come), 0
        self.held.clear()
        return "\ufffd" if left else ""


def load(path: str, pattern: str, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS) -> Tokenizer:
    """The tokenizer of this process for the vocabulary at path."""
    return held(("bpe", path, pattern, max_states, max_chunks), lambda: Tokenizer(read_ranks(path), pattern, max_states, max_chunks))


def unpack(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", with_ids: bool = False, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of every whole text, and with with_ids the ids themselves.

    Null and empty texts have no ids; null keys stay; repeated rows are encoded one by one; other columns are ignored.
    max_states and max_chunks bound the tables of a worker: fewer cost time, and change no result.
    """
    narrow = docs.select(key, "text")
    schema = narrow.select(key).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    schema = schema.add("ids", T.ArrayType(T.LongType())) if with_ids else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, pattern, max_states, max_chunks)
        for batch in batches:
            n, one, two, all_ids = [], [], [], []
            for text in batch.column(1):
                ids = tok.encode(text.as_py())
                digest = hashlib.sha256()
                for part in tok.stream(ids, STEP):
                    digest.update(part.encode("utf-8"))
                n.append(len(ids) // 4)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(digest.hexdigest())
                all_ids.append(unpack(ids) if with_ids else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([list(x) for x in all_ids], pa.list_(pa.int64()))] if with_ids else []), names=schema.names)

    return narrow.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """key and text from the column ids; null ids give null; ids run through the incremental decoder."""
    narrow = encoded.select(key, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x.as_py() is None else "".join(tok.stream(struct.pack(f"<{len(x)}I", *x.as_py()), STEP)) for x in batch.column(1)], pa.string())], names=[key, "text"])

    return narrow.mapInArrow(run, narrow.select(key).schema.add("text", "string"))
