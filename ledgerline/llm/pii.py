"""Personal data, also where it is disguised, with offsets into the source text.

1. The base patterns (e-mail, IPv4 address, payment card with its check digit,
   international phone number) run over the text as it stands.
2. Transducers rewrite the text and remember, for every code point they put
   out, the source span it stands for: look-alike letters and digits (Cyrillic,
   Greek, full-width, mathematical) become ASCII and zero-width characters
   vanish; spelled digits in four languages become digits; "at" and "dot" in
   brackets, or spelled beside each other as in an address, become @ and ".".
   The rewritten text is searched with the same patterns and what is found is
   mapped back to the source. Base spans stay as they are; a found span is left
   out where it touches one of its kind without covering it and more.

Each stage is a list of (start, end, replacement) edits of its input; composed
edits keep the map exact. A stage whose triggers a text lacks costs one search.

All scans are linear in the text, so a text is read whole whatever its length.

Defined cases: a null text is empty and has no spans; repeated rows each get
theirs; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, text_of, texts_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


# -- base patterns -----------------------------------------------------------------------
def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match runs through an @: the local part is the run before it, at most
    back to the last match's end; the domain is matched from it on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    if "." in text:
        out += [(1, a, b) for a, b in ips(text)]
    out += [(2, a, b) for a, b in cards(text)]
    if "+" in text:
        out += [(3, a, b) for a, b in phones(text)]
    return out


# -- transducers ---------------------------------------------------------------------------
# Look-alikes of Latin letters among Cyrillic, Greek and Armenian
_LOOK = dict(zip(
    "АВЕКМНОРСТХаеорсухіїјѕԁԛԝһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυχιօոսց",
    "ABEKMHOPCTXaeopcyxiijsdqwhlABEZHIKMNOPTYXavopuxionug"))
# marks that stand for those of addresses and numbers, by code point
_LOOK |= dict.fromkeys(map(chr, (0xFF20, 0xFE6B)), "@")
_LOOK |= dict.fromkeys(map(chr, (0xFF0E, 0xFE52, 0x2024, 0x3002, 0xFF61)), ".")
_LOOK |= dict.fromkeys(map(chr, (0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2212, 0xFE63, 0xFF0D)), "-")
_LOOK |= dict.fromkeys(map(chr, (0xFF0B, 0xFE62)), "+")
_LOOK |= {chr(0xFF08): "(", chr(0xFF09): ")"}
_LOOK |= dict.fromkeys(map(chr, (0xA0, 0x2007, 0x2009, 0x202F, 0x3000)), " ")
_GONE = dict.fromkeys(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD, 0x180E)), "")


def _fold(c: str) -> str | None:
    """ASCII for one code point, '' to drop it, None to keep it."""
    got = _GONE.get(c, _LOOK.get(c))
    if got is None and ord(c) > 0x2000 or got is None and c in "０１２３４５６７８９":
        plain = unicodedata.normalize("NFKC", c)  # full-width, circled and mathematical forms
        got = plain if len(plain) == 1 and plain.isascii() and plain.isalnum() else None
    if got is None and not c.isascii() and c.isdecimal():
        got = str(unicodedata.digit(c))
    return got


_FOLDS: dict[str, str | None] = {}
_WIDE = re.compile(r"[^\x00-\xac\xae-ɏ‘-‟…]|[ ­·]")

# Digits in English, German, French and Spanish
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "ein": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9"}
_ONE = "(?:" + "|".join(sorted(_DIGITS, key=len, reverse=True)) + ")"
_TWO_SPELLED = re.compile(rf"(?i)\b{_ONE}(?:[ ,.\-]{{1,2}}|\s(?:dot|point|punkt|punto)\s){_ONE}\b")
# spelled digits, plain digits and the marks of numbers, at least one spelled
_RUN = re.compile(rf"(?i)(?<![\w])(?:(?:plus\s|\+\s?)?(?:{_ONE}|[0-9]++)(?![\w])(?:\s(?:dot|point|punkt|punto|dash)\s|\s?[,.\-() ]\s?)?){{4,}}")
_ITEM = re.compile(rf"(?i)(?P<plus>plus)\s|(?P<d>\b{_ONE}\b)|(?P<dot>\s(?:dot|point|punkt|punto)\s)|(?P<dash>\sdash\s)|(?P<gap>[ ,]+)")
_BRACKET_AT = re.compile(r"(?i)\s*(?:[\[({<]\s*(?:at|@|arroba|chez|a t)\s*[\])}>]|(?<=[\w])_at_(?=[\w]))\s*")
_BRACKET_DOT = re.compile(r"(?i)\s*(?:[\[({<]\s*(?:dot|\.|point|punkt|punto|d o t)\s*[\])}>]|(?<=[\w])_dot_(?=[\w]))\s*")
# "name at host dot tld": words alone, as far as an address goes
# both sides of an "at": the local part is read backwards, on the reversed text
_BEFORE_AT = re.compile(r"(?i)[a-z0-9_%+-]++(?:(?:\.| (?:tod|tknup|tniop|otnup) )[a-z0-9_%+-]++)*+(?![\w.%+-])")
_AFTER_AT = re.compile(r"(?i)[a-z0-9-]+(?:(?: ?\. ?| (?:dot|punkt|point|punto) )[a-z0-9-]+)+")
_SPELLED_DOT = re.compile(r"(?i) (?:dot|punkt|point|punto) | \. ?|(?<=[a-z0-9])\. (?=[a-z])")
_TRIGGER = re.compile(r"(?i)[\[({<]\s*(?:at|@|arroba|chez|a t|dot|\.|point|punkt|punto|d o t)\s*[\])}>]|_at_|_dot_| at | arroba | ?@ ")
_NEAR_DOT = re.compile(r"(?i) (?:dot|punkt|point|punto) |[\[({<]\s*(?:dot|\.|d o t|point|punkt|punto)|_dot_")


def _homoglyphs(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _WIDE.finditer(text):
        c = m[0]
        if c not in _FOLDS:
            _FOLDS[c] = _fold(c)
        if _FOLDS[c] is not None:
            out.append((m.start(), m.end(), _FOLDS[c]))
    return out


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits for words within runs of at least four digits; spaces between spelled digits go."""
    out = []
    if not _TWO_SPELLED.search(text):
        return out
    for run in _RUN.finditer(text):
        words = [m for m in _ITEM.finditer(text, run.start(), run.end())]
        if sum(1 for m in words if m["d"]) < 2:
            continue
        last = run.start() + len(run[0].rstrip(" ,.-()"))
        for m in words:
            if m.end() > last:
                break
            if m["d"]:
                out.append((*m.span(), _DIGITS[m["d"].lower()]))
            elif m["dot"]:
                out.append((*m.span(), "."))
            elif m["plus"]:
                out.append((*m.span(), "+"))
            elif m["dash"]:
                out.append((*m.span(), "-"))
            else:
                left, right = text[m.start() - 1:m.start()], text[m.end():m.end() + 1]
                if left.isalpha() or right.isalpha() or "," in m[0]:  # a gap beside a spelled digit
                    out.append((*m.span(), ""))
    return out


def _at_dot(text: str) -> list[tuple[int, int, str]]:
    if not _TRIGGER.search(text):
        return []
    out = [(*m.span(), "@") for m in _BRACKET_AT.finditer(text)]
    out += [(*m.span(), ".") for m in _BRACKET_DOT.finditer(text)]
    return _apart(out)


def _word_address(text: str) -> list[tuple[int, int, str]]:
    if " at " not in text.lower() and " arroba " not in text.lower() and "@" not in text:
        return []
    if not (_NEAR_DOT.search(text) or " @" in text or "@ " in text):
        return []
    out, back = [], text[::-1]
    for at in re.finditer(r"(?i) (?:at|arroba) | ?@ ?", text):
        # from the "at" on both sides up to the first word that cannot belong: whole addresses, linear time
        left, right = _BEFORE_AT.match(back, len(text) - at.start()), _AFTER_AT.match(text, at.end())
        if not left or not right or not _SPELLED_DOT.search(right[0]) and at[0] == "@":
            continue
        if "@" not in at[0] and not re.search(r"(?i) (?:dot|punkt|point|punto) ", right[0]):
            continue  # "look at foo.bar" is prose
        out.append((at.start(), at.end(), "@"))
        for a, b in ((len(text) - left.end(), at.start()), right.span()):
            out += [(x.start(), x.end(), ".") for x in _SPELLED_DOT.finditer(text, a, b)]
    return _apart(out)


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """In order, without those that overlap an earlier one."""
    out = []
    for e in sorted(set(edits)):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class Mapped:
    """A text and, by its edits, the source span of each of its code points."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | None = None  # None: as in the source
        self.ends: list[int] = []

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        if not edits:
            return
        if self.starts is None:
            self.starts = list(range(len(self.text)))
            self.ends = list(range(1, len(self.text) + 1))
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text.append(self.text[at:a])
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            text.append(new)
            starts += [self.starts[a]] * len(new)
            ends += [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])


STAGES = (_homoglyphs, _at_dot, _spelled, _word_address)


def disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the rewritten text, mapped back, beyond the base spans."""
    m = Mapped(text)
    found: list[tuple[int, int, int]] = []
    for stage in STAGES:
        edits = stage(m.text)
        if edits:
            m.apply(edits)
            found += [(k, *m.source(a, b)) for k, a, b in find(m.text)]
    out: list[tuple[int, int, int]] = []
    held = {k: sorted((a, b) for z, a, b in base if z == k) for k in range(len(KINDS))}  # apart from each other
    new: dict[int, list[tuple[int, int]]] = {k: [] for k in held}
    for k, a, b in sorted(set(found) - set(base), key=lambda x: (x[0], x[1] - x[2], x[1])):  # longer ones first
        over = touched(held[k], a, b)
        if all(a <= x and y <= b for x, y in over) and not touched(new[k], a, b):
            insort(new[k], (a, b))
            out.append((k, a, b))
    return out


def touched(spans: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """The first and the last of sorted disjoint spans that overlap [a, b)."""
    lo = bisect_left(spans, (a,))
    lo -= lo > 0 and spans[lo - 1][1] > a
    hi = bisect_left(spans, (b,))
    return [spans[lo], spans[hi - 1]] if lo < hi else []


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("doc_id")
        for i, j, texts in texts_of(b, "_q_text"):
            counts, sha, spans = [[], [], [], []], [], []
            for t in texts:
                base = find(t)
                for k in range(len(KINDS)):
                    counts[k].append(sum(1 for x in base if x[0] == k))
                sha.append(hashlib.sha256(digest(base).encode()).hexdigest())
                spans.append(digest(base + disguised(t, base)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base counts of each kind, base_sha256, and all spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_q_text"))
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op1_personal_data(spark, sf_dir):
    return personal_data(documents(spark, sf_dir))
