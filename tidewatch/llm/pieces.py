"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over a model's pieces reads a text once; at each
position the output links name the pieces that end there, and each relaxes the
best score of a segmentation up to that position (Viterbi).  Of equal scores
the longest last piece wins.  Characters that no piece covers fall back to
byte pieces, or to the unknown id.  A model's character map is applied first.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, trimmed

#: The public model that the queries encode with.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CHUNK_CHARS = 1 << 19
#: Distinct units whose ids a worker remembers, in each of two generations.
CACHE_UNITS = 150_000
#: Transitions that an automaton remembers beyond its own.
MAX_STEPS = 200_000
# Kinds of pieces, and what an unknown character costs beyond the worst piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a serialised protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: bytes | int = varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + n]
            at += n
        yield tag >> 3, value


@dataclass
class Model:
    """Pieces, scores, kinds and white-space rules of a serialised model."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    strip_spaces: bool = True
    byte_fallback: bool = False
    char_map: bytes = b""

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls([], [], [])
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                model.pieces.append(own.get(1, b"").decode())
                model.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                model.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                model.byte_fallback = bool(dict(_fields(value)).get(35, 0))
            elif number == 3:
                own = dict(_fields(value))
                model.char_map = own.get(2, b"")
                model.dummy_prefix = bool(own.get(3, 1))
                model.strip_spaces = bool(own.get(4, 1))
        return model


class CharMap:
    """A model's character map: the longest entry that starts at a position is replaced.

    The map is a double-array trie over UTF-8 bytes, whose values are offsets
    into replacements that end in a zero byte.  ``kept`` strings (pieces that
    the user defined) stay as they are.
    """

    def __init__(self, data: bytes, kept: list[str] = ()):
        size = struct.unpack_from("<I", data)[0]
        self.units = np.frombuffer(data, "<u4", size // 4, 4).tolist()
        self.texts = data[4 + size :]
        self.kept = re.compile("|".join(re.escape(k) for k in sorted(kept, key=len, reverse=True))) if kept else None
        #: Characters that start no entry, and so stay.
        self.plain: set[str] = set()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, int, int]:
        """Length and value of the longest entry at a byte (length 0: none), and how many bytes the trie followed."""
        units, length, value = self.units, 0, 0
        node, end = self._offset(units[0]), at
        while end < len(data):
            node ^= data[end]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[end]:
                break
            end += 1
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                length, value = end - at, units[node] & 0x7FFFFFFF
        return length, value, end - at

    def apply(self, text: str) -> str:
        if not text:
            return text
        if self.kept:
            out, done = [], 0
            for m in self.kept.finditer(text):
                out += [self._replace(text[done : m.start()]), m.group()]
                done = m.end()
            return "".join([*out, self._replace(text[done:])])
        return self._replace(text)

    def _replace(self, text: str) -> str:
        data, out, at, plain = text.encode("utf-8", "replace"), [], 0, self.plain
        i = 0
        while i < len(text):
            c = text[i]
            width = len(c.encode("utf-8", "replace"))
            if c not in plain:
                length, value, followed = self.longest(data, at)
                if length:
                    out.append(self.texts[value : self.texts.index(0, value)].decode())
                    i += len(data[at : at + length].decode())
                    at += length
                    continue
                if followed < width:  # no entry starts with this character
                    plain.add(c)
            out.append(c)
            i, at = i + 1, at + width
        return "".join(out)


class Automaton:
    """Aho-Corasick automaton over pieces, with output links and a Viterbi pass."""

    def __init__(self, model: Model):
        self.model = model
        usable = [i for i, k in enumerate(model.kinds) if k in (NORMAL, USER_DEFINED) and model.pieces[i]]
        normal = [model.scores[i] for i in usable if model.kinds[i] == NORMAL] or [0.0]
        self.unknown_score = min(normal) - UNKNOWN_PENALTY
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(model.pieces[i][3:5], 16): i for i, k in enumerate(model.kinds) if k == BYTE}
        self.go: list[dict[str, int]] = [{}]
        self.piece, self.depth, self.score = [-1], [0], [0.0]
        for i in usable:
            node = 0
            for c in model.pieces[i]:
                if c not in self.go[node]:
                    self.go[node][c] = len(self.go)
                    self.go.append({})
                    self.piece.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.score.append(0.0)
                node = self.go[node][c]
            self.piece[node] = i
            pinned = model.kinds[i] == USER_DEFINED
            self.score[node] = len(model.pieces[i]) * max(normal) - 0.1 if pinned else model.scores[i]
        pinned = [model.pieces[i] for i in usable if model.kinds[i] == USER_DEFINED]
        self.char_map = CharMap(model.char_map, pinned) if model.char_map else None
        self.lengths = [len(p) for p in model.pieces]
        self.fail, self.link = [0] * len(self.go), [0] * len(self.go)
        level = list(self.go[0].values())
        while level:
            following = []
            for node in level:
                f = self.fail[node]
                self.link[node] = f if self.piece[f] >= 0 else self.link[f]
                for c, child in self.go[node].items():
                    g = f
                    while g and c not in self.go[g]:
                        g = self.fail[g]
                    self.fail[child] = self.go[g].get(c, 0) if node else 0
                    following.append(child)
            level = following
        #: Outputs as they are found.  Resolved transitions join the goto table, where they stay right.
        self.added = 0
        self.outputs: list[tuple] = [()] * len(self.go)
        #: True if no piece holds a space mark behind another character: words are then coded apart.
        self.by_word = all(SPACE not in model.pieces[i].lstrip(SPACE) for i in usable)
        # A character that no piece holds parts the text as well; only byte pieces keep its neighbours apart.
        held = set("".join(model.pieces[i] for i in usable)) | {SPACE}
        loose = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in held) if model.byte_fallback else ""
        self.units = re.compile(f"{SPACE}*[^{SPACE}{loose}]+|{SPACE}+" + (f"|[{loose}]+" if loose else ""))
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _advance(self, state: int, c: str) -> int:
        node = state
        while node and c not in self.go[node]:
            node = self.fail[node]
        node = self.go[node].get(c, 0)
        if self.added < MAX_STEPS:
            self.go[state][c] = node
            self.added += 1
        return node

    def _outputs(self, state: int) -> tuple:
        """Length, score and id of the pieces that end here, along the output links: the longest first."""
        found, node = [], state if self.piece[state] >= 0 else self.link[state]
        while node:
            found.append((self.depth[node], self.score[node], self.piece[node]))
            node = self.link[node]
        self.outputs[state] = tuple(found)
        return self.outputs[state]

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of normalised text.

        A position keeps the best score and the last piece as plain numbers, 12
        bytes in all: a text of one endless word needs memory in proportion.
        """
        outputs, step, worst = self.outputs, self.go, float("-inf")
        best, back = array("d", [0.0]), array("i", [-1])
        state = before = end = 0
        for c in text:
            end += 1
            state = step[state].get(c, -1)
            if state < 0:  # seen for the first time: follow the fail links once
                state = self._advance(before, c)
            top, last, single = worst, -1, False
            for length, score, piece in outputs[state] or self._outputs(state):
                single = length == 1  # the shortest comes last
                value = best[end - length] + score
                if value > top:
                    top, last = value, piece
            if not single and (value := best[end - 1] + self.unknown_score) > top:
                top, last = value, -1
            best.append(top)
            back.append(last)
            before = state
        ids: list[int] = []
        end, run = len(text), False
        while end:
            i = back[end]
            start = end - (self.lengths[i] if i >= 0 else 1)
            if i >= 0:
                ids.append(i)
            elif self.model.byte_fallback:
                ids += [self.bytes[b] for b in reversed(text[start].encode())]
            elif not run:
                ids.append(self.unknown)  # a run of unknown characters is one unknown piece
            run = i < 0
            end = start
        ids.reverse()
        return ids

    def tidied(self, text: str) -> str:
        """The text that is encoded: characters mapped, surplus spaces gone."""
        if self.char_map:
            text = self.char_map.apply(text)
        return re.sub(" {2,}", " ", text).strip(" ") if self.model.strip_spaces else text

    def normalise(self, text: str) -> str:
        text = self.tidied(text)
        if not text:
            return ""
        return (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as 32-bit integers."""
        marked = self.normalise(text)
        if not self.by_word:
            return np.array(self.viterbi(marked), np.int32)
        cache, parts = self.cache, []
        for unit in self.units.findall(marked):
            got = cache.get(unit)
            if got is None:
                got = self.older.get(unit) or np.array(self.viterbi(unit), np.int32).tobytes()
                if len(unit) <= 64:
                    if len(cache) >= CACHE_UNITS:  # what is not used again in a generation goes
                        self.older, self.cache = cache, {}
                        cache = self.cache
                    cache[unit] = got
            parts.append(got)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode_table(self) -> list[bytes]:
        """The bytes that each id stands for; control ids stand for none."""
        table = []
        for text, kind in zip(self.model.pieces, self.model.kinds, strict=True):
            if kind == BYTE:
                table.append(bytes([int(text[3:5], 16)]))
            elif kind == CONTROL:
                table.append(b"")
            elif kind == UNKNOWN:
                table.append(" ⁇ ".encode())
            else:
                table.append(text.replace(SPACE, " ").encode())
        return table

    def decode(self, ids, table: list[bytes]) -> str:
        """The text of ids, without the space that encoding put in front; wrong bytes become U+FFFD."""
        text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.model.dummy_prefix else text


#: The automaton that this worker process has built for its task, by the model's hash.
_BUILT: dict[int, tuple[Automaton, list[bytes]]] = {}


def automaton(data: bytes) -> tuple[Automaton, list[bytes]]:
    key = hash(data)
    if key not in _BUILT:
        built = Automaton(Model.parse(data))
        _BUILT[key] = built, built.decode_table()
    return _BUILT[key]


def read_model(path: str = MODEL_PATH) -> bytes:
    """A model file's bytes (on the driver; they travel to the executors with the function, under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    sizes = np.nan_to_num(np.array(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), float))
    ends = (np.cumsum(sizes) // CHUNK_CHARS).astype(int)
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def encode_documents(docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Piece ids of every whole text, and whether decoding them gives the text back.

    Returns one row per input row: ``doc_id``, ``n_tokens``, ``ids`` and
    ``round_trip`` (decoded ids equal the text; a space mark U+2581 in the text
    itself comes back as a space and counts as equal; under a model that maps
    characters or drops surplus spaces, the text is the one so tidied).  A null or empty text
    has no ids; null ids and repeated rows stay; other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = automaton(shared.value)
        for batch in batches:
            for part in _slices(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                each = [coder.encode(t) for t in texts]
                counts = np.array([len(x) for x in each], np.int64)
                same = [_same(coder, t, coder.decode(x.tolist(), table)) for t, x in zip(texts, each, strict=True)]
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, np.concatenate(each))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), ids, pa.array(same)], names=["doc_id", "n_tokens", "ids", "round_trip"])
        del coder
        _BUILT.clear()  # the worker may serve other stages next, which need its memory

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(trimmed(run), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def _same(coder: Automaton, text: str, decoded: str) -> bool:
    text = coder.tidied(text)
    return decoded == text or decoded == text.replace(SPACE, " ")


def decode_documents(encoded: DataFrame, data: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of piece ids: ``doc_id`` and ``text``; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = automaton(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts = [coder.decode(x or [], table) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
