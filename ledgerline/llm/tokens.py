"""Token ids of public tokenizer files, with a bounded memory of pieces per worker.

A text is cut where the tokenizer's own rules never look across: at white
space (word_bpe) or before a single space between two other characters
(byte_bpe), and around single full stops, commas and line breaks of plain
texts, which leaves fewer different pieces. Each piece is encoded by the
tokenizers library and remembered as little-endian 32-bit ids. Texts with added-token strings or rare control spaces go to the
library whole, so ids always equal the library's.
"""

from __future__ import annotations

import codecs
import re
import struct

import numpy as np
import pandas as pd

from ledgerline.llm.common import Memo, mix64

KEEP = 300_000   # pieces remembered by a worker, in each of two generations
JOINT = 1 << 22  # code points of plain texts that are cut and looked up together

# Latin-1 letters and ASCII: one code point in lower case, unchanged by NFC
_PLAIN = re.compile(r"[!-~À-ÖØ-Þß-öø-ÿ]+\Z")
_LOW_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")
# for byte_bpe also single line breaks between such runs
_GPT_PLAIN = re.compile(r" ?[!-~À-ÖØ-öø-ÿ]+(?:\n[!-~À-ÖØ-öø-ÿ]+)*\Z")
_GPT_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \nA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\n")
# plain texts: ASCII and Latin-1 letters only
_PLAIN_TEXT = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*\Z")
# a full stop or comma beside another mark belongs to a run of marks
_RUN = re.compile(r"[.,][^\sA-Za-z0-9À-ÖØ-öø-ÿ]|[^\sA-Za-z0-9À-ÖØ-öø-ÿ][.,]")
# for byte_bpe the same of Latin-1 bytes, each rule a bit: of what may not stand first, and of what may not follow it
_LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + bytes(x for x in range(0xC0, 0x100) if x not in (0xD7, 0xF7)))
_MARKS = frozenset(range(0x21, 0x7F)) - _LETTERS
_FIRST = bytes((x in b".,\n") | (x in _MARKS or x in b" \n") << 1 | (x in b" \n") << 2 for x in range(256))
_THEN = bytes((x in _MARKS) | (x in b".,") << 1 | (x in b" \n") << 2 for x in range(256))
_ALONE = np.isin(np.arange(256), list(b".,\n"))
_NAME = mix64(np.arange(1, 257, dtype=np.uint64), 0x9E3779B97F4A7C15)
_OTHER = bytes(x for x in range(256) if x not in _LETTERS and x not in _MARKS and x not in b" \n")
_TWO_SPACES = re.compile(r"\s\s|^\s|\s\Z")
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")


def byte_chars() -> list[str]:
    """The 256 printable stand-ins of byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in same}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(same))
    return [out[b] for b in range(256)]


_BYTE = byte_chars()
_STAND_INS = "".join(_BYTE)


def stand_ins(piece: str) -> str:
    return codecs.charmap_decode(piece.encode("utf-8"), "strict", _STAND_INS)[0]


def _ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _lone_marks(text: str) -> bool:
    """Whether a text is plain and its full stops, commas, spaces and line breaks stand alone."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    if len(raw.translate(None, _OTHER)) != len(raw) or raw[:1] in (b" ", b"\n") or raw[-1:] in (b" ", b"\n"):
        return False
    first, then = (np.frombuffer(raw.translate(x), np.uint8) for x in (_FIRST, _THEN))
    return not (first[:-1] & then[1:]).any()


class _Encoder:
    """Common parts; ``kind``: 'word' or 'byte'."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.known = Memo(self.piece, KEEP)

    def piece(self, p: str) -> bytes:
        raise NotImplementedError

    def cut(self, text: str) -> list[str]:
        raise NotImplementedError

    def whole(self, text: str) -> bytes:
        return _ids(self.tok.encode(text, add_special_tokens=False).ids)

    def odd(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def unit(self, piece: str) -> bytes:
        """Ids of one pre-token of plain characters, by the library's model."""
        word = piece[1:] if piece[0] == " " else piece
        if word.isascii() and word.isalnum():
            piece = piece.replace(" ", _BYTE[32])
        else:
            piece = stand_ins(piece)
        return _ids([t.id for t in self.model.tokenize(piece)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without special tokens added."""
        get = self.known.__getitem__
        return [self.whole(t) if self.odd(t) else b"".join(map(get, self.cut(t))) for t in texts]


class WordEncoder(_Encoder):
    """Lower case, NFC, white space dropped, word ends (word_bpe_49k.json)."""

    def odd(self, text: str) -> bool:
        return super().odd(text) or _CONTROL_SPACE.search(text) is not None

    def cut(self, text: str) -> list[str]:
        if _PLAIN_TEXT.match(text):
            text = text.lower()
            if not _RUN.search(text):
                text = text.replace(".", " . ").replace(",", " , ")
        return text.split()

    def piece(self, p: str) -> bytes:
        if p.isascii() and p.isalpha():
            return self.unit(p.lower())
        if _PLAIN.match(p):
            return b"".join([self.unit(x) for x in _LOW_PIECES.findall(p.lower())])
        return self.whole(p)


class ByteEncoder(_Encoder):
    """Byte-level, nothing dropped (byte_bpe_50k.json)."""

    def odd(self, text: str) -> bool:
        return super().odd(text) or _CONTROL_SPACE.search(text) is not None

    def cut(self, text: str) -> list[str]:
        if _lone_marks(text):
            text = text.replace(" ", "\0 ").replace(".", "\0.\0").replace(",", "\0,\0").replace("\n", "\0\n\0")
            return text.replace("\0\0", "\0").strip("\0").split("\0") if text else []
        if _TWO_SPACES.search(text):
            parts = re.split(r"(?<=\S)(?= \S)", text)
            return parts if text else []
        parts = text.split(" ")
        return [parts[0], *[" " + p for p in parts[1:]]] if text else []

    def encode(self, texts: list[str]) -> list[bytes]:
        out, joint, size = [b""] * len(texts), [], 0
        for k, t in enumerate(texts):
            if not t or self.odd(t) or not _lone_marks(t):
                out[k] = super().encode([t])[0]
                continue
            if joint and size + len(t) > JOINT:
                self._together(texts, joint, out)
                joint, size = [], 0
            joint.append(k)
            size += len(t)
        if joint:
            self._together(texts, joint, out)
        return out

    def _together(self, texts: list[str], which: list[int], out: list[bytes]) -> None:
        """Ids of plain texts with lone marks. Each different piece of them all is looked up
        once; pieces are told apart by a hash and then held against the first one byte by byte."""
        joined = "".join([texts[k] for k in which])
        data = np.frombuffer(joined.encode("latin-1"), np.uint8)
        ends = np.cumsum([len(texts[k]) for k in which])
        mark = _ALONE[data]
        start = mark | (data == 32)
        start[1:] |= mark[:-1]
        start[0] = start[ends[:-1]] = True
        at = np.flatnonzero(start)
        size = np.diff(np.append(at, len(data)))
        within = np.arange(len(data)) - np.repeat(at, size)
        power = np.full(int(size.max()), 0xD1342543DE82EF95, np.uint64)
        power[0] = 1
        code, names = pd.factorize(np.add.reduceat(_NAME[data] * np.multiply.accumulate(power)[within], at))
        first = np.zeros(len(names), np.int64)
        first[code[::-1]] = np.arange(len(at) - 1, -1, -1)
        like = first[code]
        if (size[like] != size).any() or (data[np.repeat(at[like], size) + within] != data).any():
            for k in which:  # two pieces of one hash
                out[k] = super().encode([texts[k]])[0]
            return
        begin = at[first]
        ids = [self.known[joined[a:z]] for a, z in zip(begin.tolist(), (begin + size[first]).tolist())]
        count = np.array([len(x) // 4 for x in ids])
        n = count[code]
        upto = np.append(0, np.cumsum(n))
        flat = np.frombuffer(b"".join(ids), "<u4")
        flat = flat[np.repeat((np.cumsum(count) - count)[code] - upto[:-1], n) + np.arange(upto[-1])]
        to = upto[np.searchsorted(at, ends)].tolist()
        for k, a, z in zip(which, [0, *to], to):
            out[k] = flat[a:z].tobytes()

    def piece(self, p: str) -> bytes:
        word = p[1:] if p[0] == " " else p
        if word.isalpha() and (word.isascii() or _LATIN.match(word)):
            return self.unit(p)
        if _GPT_PLAIN.match(p):
            parts = _GPT_PIECES.findall(p)
            if len(parts) == 1:
                return self.unit(p)
            # short parts, as marks are, come often
            return b"".join([self.known[x] if len(x) < 5 else self.known.get(x) or self.unit(x) for x in parts])
        return self.whole(p)


_LOADED: dict = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, kind: str) -> _Encoder:
    """One encoder per worker process; ``path`` is read on the executors."""
    key = (path, kind)
    if key not in _LOADED:
        _LOADED[key] = (WordEncoder if kind == "word" else ByteEncoder)(path)
    return _LOADED[key]
