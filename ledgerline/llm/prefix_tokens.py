"""Token counts at every prefix of a text, by dynamic programming.

For a pre-token (a run the tokenizer never looks across) of bytes b1..bn let
``last(i)`` be the last token of the encoding of its first i bytes. A byte-pair
encoding is the right one exactly if each two neighbouring tokens are the
encoding of their joint text, so last(i) is the one vocabulary entry t that
ends at i and is compatible with last(i - |t|), and count(i) = count(i - |t|) + 1.
Vocabulary entries with a word end are tried separately, as the end of the
prefix, on top of the open prefix before them. A worker remembers the table of each
pre-token: last token and count at every prefix. The counts before each run of a
text are summed once. Total, count at any code point and longest prefix within a
budget are look-ups in these tables (closing a prefix is one step more): no text is encoded again.

A text with added-token strings is cut at them (one token each, as the library's default
has it); only a prefix that ends inside such a string reads its beginning as plain text.

Defined cases: a null text is empty and has no tokens; the control characters 0x1C to 0x1F are
no white space to the tokenizer; runs with combining marks or jamo, where normalisation looks
across code points, are counted by the library, a prefix from the start of its last pre-token.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, documents, text_of, texts_of
from ledgerline.llm.tokens import _CONTROL_SPACE, _PLAIN, default_path, stand_ins

KEEP = 250_000    # pre-tokens, and runs, remembered by a worker in each of two generations
PAIRS = 1_000_000
LIMIT = 2048
END = "</w>"
_RUN = re.compile(r"[\S\x1c-\x1f]+")
_LOW = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class PrefixCounter:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        ids, n = self.vocab, len(self.vocab)
        # how each entry is made: merge number, left and right part (none for single bytes)
        self.made = [(-1, -1, -1)] * n
        self.pair: dict[int, int] = {}
        for k, m in enumerate(model["merges"]):
            x, y = m.split(" ") if isinstance(m, str) else m
            self.pair[ids[x] * n + ids[y]] = k
            self.made[ids[x + y]] = (k, ids[x], ids[y])
        self.size = n
        self.longest = max(len(t.removesuffix(END)) for t in ids)
        self.closed = {t[:-len(END)]: i for t, i in ids.items() if t.endswith(END)}
        self.open = {t: i for t, i in ids.items() if not t.endswith(END)}
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|(?:[^\s\p{L}\p{N}]|[\x1c-\x1f])+")
        self.fits: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.words = Memo(self.piece, KEEP)
        self.chunks = Memo(self.run_total, KEEP)

    def fit(self, a: int, b: int) -> bool:
        """Whether entry a followed by entry b is the encoding of their joint text,
        that is, whether no merge across the border comes before the merges that
        make them. Looks back from the end: the part made last is undone, and
        the border pair of the moment before is tried."""
        made, pair, n = self.made, self.pair, self.size
        limit = 1 << 60
        while True:
            if pair.get(a * n + b, limit) < limit:
                return False
            (x, _, inner), (y, outer, _) = made[a], made[b]
            if x < 0 and y < 0:
                return True
            if x > y:   # equal merges go from left to right: one across the border would come later
                limit, a = x, inner
            else:       # ... or earlier
                limit, b = y + 1, outer

    def table(self, s: str) -> tuple[str, array, array, int]:
        """A pre-token (byte stand-ins), last token and count at each of its prefixes, and its tokens as a whole."""
        fits, n, entry = self.fits, self.size, self.open.get
        last, count = [-1], [0]
        if len(fits) > PAIRS:
            fits.clear()
        for i in range(1, len(s) + 1):
            j = i
            while j:
                j -= 1
                t = entry(s[j:i])
                if t is None:
                    continue
                before = last[j]
                if before >= 0:
                    key = before * n + t
                    ok = fits.get(key)
                    if ok is None:
                        ok = fits[key] = self.fit(before, t)
                else:
                    ok = self.made[t][0] < 0 or self.whole(t)
                if ok:
                    last.append(t)
                    count.append(count[j] + 1)
                    break
            else:
                raise ValueError(f"no encoding of {s[:i]!r}")
        held = s, array("i", last), array("i", count)
        return *held, self.closed_at(*held, len(s))

    def closed_at(self, s: str, last, count, i: int) -> int:
        """Tokens of the first ``i`` bytes as a pre-token of their own: a step from the open prefixes."""
        fits, n, entry = self.fits, self.size, self.closed.get
        for j in range(i - 1, -1, -1):
            t = entry(s[j:i])
            if t is None:
                continue
            before = last[j]
            if before >= 0:
                key = before * n + t
                ok = fits.get(key)
                if ok is None:
                    ok = fits[key] = self.fit(before, t)
            else:
                ok = self.made[t][0] < 0 or self.whole(t)
            if ok:
                return count[j] + 1
        raise ValueError(f"no encoding of {s[:i]!r}")

    def piece(self, p: str) -> tuple:
        return self.table(p if p.isascii() and p.isalnum() else stand_ins(p))

    def at(self, p: str, n: int, held: tuple | None = None) -> int:
        """Tokens of the first ``n`` code points of a pre-token; ``held``: its table, if at hand."""
        s, last, count, total = held or self.words[p]
        if n == len(p):
            return total
        if p in ("'re", "'ve", "'ll"):  # cut short it is an apostrophe and a letter
            return n
        return self.closed_at(s, last, count, n if p.isascii() else len(p[:n].encode()))

    def longest_start(self, p: str, budget: int) -> int:
        """Code points of the longest beginning of a pre-token of at most ``budget`` tokens."""
        held = self.words[p]  # long ones are not remembered
        count = held[2]
        reach = max((j for j in range(len(count)) if count[j] < budget), default=0) + self.longest  # closing spans one entry
        return next((n for n in range(min(len(p), reach), 0, -1) if self.at(p, n, held) <= budget), 0)

    def run_total(self, c: str) -> int:
        if c.isascii() and c.isalpha():
            return self.words[c.lower()][-1]
        if c[-1] in ".," and c[:-1].isascii() and c[:-1].isalpha():
            return self.words[c[:-1].lower()][-1] + self.words[c[-1]][-1]
        if _PLAIN.match(c):
            return sum([self.words[p][-1] for p in _LOW.findall(c.lower())])
        return len(self.tok.encode(c, add_special_tokens=False))

    def whole(self, t: int) -> bool:
        """Whether an entry is the encoding of its own text."""
        got = self.alone.get(t)
        if got is None:
            _, x, y = self.made[t]
            ok = self.made[x][0] < 0 or self.whole(x)
            ok = ok and (self.made[y][0] < 0 or self.whole(y))
            # no merge across the border of its parts before theirs
            got = self.alone[t] = ok and self.meets(x, y, self.made[t][0])
        return got

    def meets(self, a: int, b: int, final: int) -> bool:
        """Like :meth:`fit`, where the last merge of all joins a and b."""
        made, pair, n = self.made, self.pair, self.size
        limit = final
        while True:
            if pair.get(a * n + b, limit) < limit:
                return False
            (x, _, inner), (y, outer, _) = made[a], made[b]
            if x < 0 and y < 0:
                return True
            if x > y:
                limit, a = min(limit, x), inner
            else:
                limit, b = min(limit, y + 1), outer

    def split(self, c: str) -> list[str] | None:
        """Pre-tokens of a run without white space; None where a prefix's normal form depends on what follows."""
        if c.isascii() and c.isalpha():
            return [c.lower()]
        if _PLAIN.match(c):
            return _LOW.findall(c.lower())
        if any(unicodedata.category(x)[0] == "M" or 0x1100 <= ord(x) <= 0x11FF for x in c) \
                or unicodedata.normalize("NFC", c) != c or any(len(x.lower()) != 1 for x in c):
            return None
        pieces = self.pieces.findall("".join(x.lower() for x in c))
        if sum(map(len, pieces)) != len(c) or sum(self.words[p][-1] for p in pieces) != len(self.tok.encode(c, add_special_tokens=False)):
            return None
        return pieces

    def index(self, text: str) -> PrefixIndex:
        return PrefixIndex(self, text)


class PrefixIndex:
    """Counts at every code-point prefix of one text: its runs, where they start, and the tokens before each.
    Added-token strings are runs of their own."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.added: set[int] = set()
        self.starts: list[int] | None = None
        if any(s in text for s in counter.special) or _CONTROL_SPACE.search(text):
            self.runs, self.starts, at = [], [], 0
            for k, part in enumerate(counter.added.split(text) if counter.added else [text]):
                if k % 2:
                    self.added.add(len(self.runs))
                for m in [re.match(r"(?s).*", part)] if k % 2 else _RUN.finditer(part):
                    self.runs.append(m[0])
                    self.starts.append(at + m.start())
                at += len(part)
            totals = (1 if k in self.added else counter.chunks[r] for k, r in enumerate(self.runs))
        else:
            self.runs = text.split()
            totals = map(counter.chunks.__getitem__, self.runs)
        self.before = list(accumulate(totals, initial=0))
        self.total = self.before[-1]
        self._held: tuple = (None, None)

    def _at(self) -> list[int]:
        if self.starts is None:
            self.starts = [m.start() for m in re.finditer(r"\S+", self.text)]
        return self.starts

    def _inside(self, k: int, n: int) -> int:
        """Tokens of the first ``n`` code points of run ``k``, and of what is before them."""
        run = self.runs[k]
        if n >= len(run):
            return self.before[k + 1]
        if not n:
            return self.before[k]
        if k in self.added:  # a part of such a string is plain text, joined with the run it touches
            touches = k and k - 1 not in self.added and self.starts[k - 1] + len(self.runs[k - 1]) == self.starts[k]
            head = self.runs[k - 1] if touches else ""
            text = head + run[:n]
            return self.before[k - 1 if touches else k] + len(self.counter.tok.encode(text, add_special_tokens=False))
        return self.before[k] + self._tokens(run, n)

    def _parts(self, run: str) -> tuple[list, list, bool]:
        """Where the pre-tokens of a run start, the tokens before each, and whether the library has to count inside them."""
        c = self.counter
        pieces = c.split(run)
        if pieces is not None:
            return [0, *accumulate(map(len, pieces))], [0, *accumulate(c.words[p][-1] for p in pieces)], False
        e, starts, tokens, end = c.tok.encode(run, add_special_tokens=False), [0], [0], 0
        for i, (a, z) in enumerate(e.offsets):
            if i and e.word_ids[i] != e.word_ids[i - 1] and a >= end and run[a - 1] != "'":  # no code point is shared, no contraction can arise
                starts.append(a)
                tokens.append(i)
            end = max(end, z)
        return [*starts, len(run)], [*tokens, len(e.ids)], True

    def _part(self, run: str, a: int, n: int, z: int, by_library: bool) -> int:
        """Tokens of ``run[a:n]``, the beginning of the pre-token ``run[a:z]``."""
        c = self.counter
        return len(c.tok.encode(run[a:n], add_special_tokens=False)) if by_library else c.at("".join(x.lower() for x in run[a:z]), n - a)

    def _look(self, run: str) -> tuple[list, list, bool]:
        if self._held[0] is not run:
            self._held = run, self._parts(run)
        return self._held[1]

    def _tokens(self, run: str, n: int) -> int:
        """Tokens of the first ``n`` code points of a run."""
        starts, tokens, by_library = self._look(run)
        k = min(bisect_right(starts, n - 1), len(starts) - 1) - 1
        return tokens[k] + (self._part(run, starts[k], n, starts[k + 1], by_library) if n < starts[k + 1] or by_library else tokens[k + 1] - tokens[k])

    def _longest(self, run: str, budget: int) -> int:
        """Code points of the longest beginning of a run of at most ``budget`` tokens; the run has more."""
        starts, tokens, by_library = self._look(run)
        k = bisect_right(tokens, budget) - 1  # the first pre-token that does not fit whole
        a, z, left = starts[k], starts[k + 1], budget - tokens[k]
        if by_library:
            return next(n for n in range(z, a - 1, -1) if n == a or self._part(run, a, n, z, True) <= left)
        return a + self.counter.longest_start("".join(x.lower() for x in run[a:z]), left)

    def count(self, i: int) -> int:
        """Tokens of ``text[:i]``."""
        if i >= len(self.text):
            return self.total
        k = bisect_right(self._at(), i - 1) - 1
        return self._inside(k, i - self.starts[k]) if k >= 0 else 0

    def fit(self, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        k, starts = bisect_right(self.before, budget) - 1, self._at()  # the first run that does not fit whole
        if k + 1 in self.added:  # cut short, the string after it may leave fewer tokens
            for n in range(len(self.runs[k + 1]) - 1, 0, -1):
                if self._inside(k + 1, n) <= budget:
                    return starts[k + 1] + n
        if k in self.added:
            return starts[k] + next(n for n in range(len(self.runs[k]), -1, -1) if self._inside(k, n) <= budget)
        return starts[k] + self._longest(self.runs[k], budget - self.before[k])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _count(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            total, size, fit = [], [], []
            for _, _, texts in texts_of(b, "_q_text"):
                for t in texts:
                    x = c.index(t)
                    total.append(x.total)
                    size.append(len(t.encode("utf-8")))
                    fit.append(x.fit(limit))
            new = {"n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(total, pa.int64()),
                   "over_limit": pa.array([n > limit for n in total], pa.bool_()), "fit_chars": pa.array(fit, pa.int64())}
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *new.values()], ["doc_id", *new])

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and fit_chars: code points of the
    longest prefix of at most ``limit`` tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_q_text"))
    return rows.mapInArrow(_count(path or default_path("word_bpe_49k.json"), limit),
                           "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op3_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir))
