"""SentencePiece BPE models: reading the model file, normalising with alignment, merging, decoding.

Supports BPE models with byte fallback and without user-defined pieces, that
is what the public model files here hold; others raise ValueError.
"""

from __future__ import annotations

import heapq
import re
import struct

SPACE = "▁"  # stands for a space in pieces
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at:at + n], at + n
        else:
            n = {1: 8, 5: 4}[kind]
            value, at = data[at:at + n], at + n
        yield tag >> 3, value


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 bytes and its replacement texts."""

    def __init__(self, blob: bytes):
        n = struct.unpack_from("<I", blob)[0]
        self.units = struct.unpack_from(f"<{n // 4}I", blob, 4)
        self.texts = blob[4 + n:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at ``at``, and its replacement."""
        units, best = self.units, None
        # a unit holds: bits 0-7 the label, 8 whether a value follows, 9 whether the offset is in units of 256, 10-30 the offset
        step = lambda u: (u >> 10) << ((u >> 6) & 8)
        node = step(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                best = i + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        end = self.texts.index(b"\0", best[1])
        return best[0], self.texts[best[1]:end]


class Normalizer:
    """Rewrites a text by longest prefixes and records where each character came from."""

    def __init__(self, spec: bytes):
        got = dict(_fields(spec))
        self.chars = CharMap(got[2]) if got.get(2) else None
        self.prefix, self.squeeze, self.escape = (bool(got.get(k, 1)) for k in (3, 4, 5))

    @property
    def plain(self) -> bool:
        """True if only spaces are marked and a space is put in front."""
        return self.chars is None and self.prefix and not self.squeeze and self.escape

    def _units(self, text: str):
        """(begin, end, replacement) in source bytes, one after the other."""
        data = text.encode("utf-8")
        at = 0
        while at < len(data):
            hit = self.chars.longest(data, at) if self.chars else None
            if hit:
                n, new = hit[0], hit[1].decode("utf-8")
            else:
                n = 1 + sum(data[at] >= x for x in (0xC0, 0xE0, 0xF0))
                new = data[at:at + n].decode("utf-8")
            yield at, at + n, new
            at += n

    def __call__(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The normalised text and, for each of its characters, the span of source bytes behind it."""
        units = list(self._units(text))
        if self.squeeze:
            while units and set(units[0][2]) <= {" "}:
                units.pop(0)
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        if not units:
            return "", []
        if self.prefix:
            out.append(" ")
            spans.append((units[0][0], units[0][0]))
        spaced = self.squeeze  # the last character was a space that swallows further ones
        for begin, end, new in units:
            if self.squeeze and spaced:
                new = new.lstrip(" ")
            for c in new:
                out.append(c)
                spans.append((begin, end))
            if new:
                spaced = self.squeeze and new[-1] == " "
        if self.squeeze:
            while out and out[-1] == " ":
                out.pop()
                spans.pop()
        return "".join(out).replace(" ", SPACE) if self.escape else "".join(out), spans


class Model:
    """Pieces, scores and settings of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        trainer, spec = {}, b""
        for field, value in _fields(data):
            if field == 1:
                got = dict(_fields(value))
                piece, kind = got.get(1, b"").decode("utf-8"), got.get(3, NORMAL)
                if kind in (NORMAL, UNUSED):
                    self.score[piece] = struct.unpack("<f", got[2])[0] if 2 in got else 0.0
                self.id_of[piece] = len(self.pieces)
                self.pieces.append(piece)
                self.kinds.append(kind)
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                spec = value
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only BPE models with byte fallback and without user-defined pieces are supported")
        self.normalizer = Normalizer(spec)
        self.byte_ids = [self.id_of[f"<0x{b:02X}>"] for b in range(256)]
        self.eos = trainer.get(42, 2)
        self.longest = max(map(len, self.score))
        #: no piece holds a space after another character: a merge never crosses such a place
        self.chunked = not any(SPACE in p.lstrip(SPACE) for p in self.score)

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge neighbours, best score first, leftmost first among equals."""
        if len(symbols) > 24:
            return self._merge_long(symbols)
        score, symbols = self.score, list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        score, text = self.score, list(symbols)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(text):
                s = score.get(text[i] + text[j])
                if s is not None:
                    heapq.heappush(heap, (-s, i, j, text[i], text[j]))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if text[i] != a or j >= len(text) or text[j] != b or after[i] != j:
                continue
            text[i], text[j] = a + b, ""
            after[i] = after[j]
            if after[j] < len(text):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [t for t in text if t]

    def encode_symbols(self, text: str):
        """(ids, begins, ends) in characters of a normalised chunk; of a character's
        bytes the last one covers the character, as the library has it."""
        ids, begins, ends, at = [], [], [], 0
        for piece in self.merge(list(text)):
            if piece in self.score:
                ids.append(self.id_of[piece])
                begins.append(at)
                ends.append(at + len(piece))
            else:  # one character that has no piece
                raw = [self.byte_ids[b] for b in piece.encode("utf-8")]
                ids += raw
                begins += [at] * len(raw)
                ends += [at] * (len(raw) - 1) + [at + len(piece)]
            at += len(piece)
        return ids, begins, ends

    def decode(self, ids: list[int]) -> str:
        """Text of whole pieces with the space in front of the first one taken off."""
        return self.surface(ids).removeprefix(" ") if self.normalizer.prefix else self.surface(ids)

    def surface(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in [*ids, -1]:
            kind = self.kinds[i] if i >= 0 else CONTROL
            if kind == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self.pieces[i].replace(SPACE, " "))
        return "".join(out)


CHUNK = re.compile(f"[ {SPACE}]+[^ {SPACE}]*|[^ {SPACE}]+")
