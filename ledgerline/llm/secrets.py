"""Secret scan with a random forest against false positives.

Rules find candidates: provider formats, values assigned to a telling name, and any
long run of key characters. Each candidate is measured: its length, how likely
its character transitions are in the corpus, the share of it that dictionary
words cover, digits, capitals and character switches, the kind of path it comes
from and the words beside it. A random forest trained on labelled findings
gives the probability that it is a secret; findings under one half are false
positives.

Transitions (a 128 x 128 table) and the dictionary (the ``DICTIONARY`` most frequent
short words) are counted over all documents. The forest is fitted on at most
``TRAIN_FINDINGS`` labelled findings, those of the smallest hash. :func:`scan` takes
any labelled findings. The query has no table of them, so :func:`planted` makes them: into
copies of at most ``PLANT_ROWS`` documents it writes secrets (keys in the providers'
formats, random keys and passwords, with and without a telling name) and harmless look-alikes
(words run together, names and paths, placeholders, digests and ids that are named as such).
What is a secret is known from the planting alone, from none of the measures.

The fitted forest is saved to the shared folder and loaded again: only its trees, and not
the session its training summary holds, reach the tasks.

Defined cases: a null text is empty and has no candidate; a null path counts as
an unknown one; repeated rows each get their findings; without labelled
findings of both kinds every candidate stays, with score 1; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, saved, text_of
from ledgerline.session import scratch_dir

DICTIONARY = 4000
TRAIN_FINDINGS = 4000
PLANT_ROWS = 1500         # documents that findings are planted in
TREES, DEPTH = 20, 6
WORDS_HELD = 400_000   # words a map task counts before it sends them on

# No run has an upper bound. Possessive quantifiers keep the scan linear, as does the
# jwt rule's one try for each run of its characters, at the first eyJ in it.
RULES = (
    ("aws_key", re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"), 0),
    ("github_token", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{30,}+\b"), 0),
    ("slack_token", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}+"), 0),
    ("jwt", re.compile(r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=\beyJ))"
                       r"(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"), 1),
    ("private_key", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0),
    ("assigned", re.compile(r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
                            r"([^\s\"',;]{8,}+)"), 1),
    ("long_run", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"), 0),
)
PROVIDERS = ("aws_key", "github_token", "slack_token", "jwt", "private_key")
_TELLING = ("password", "passwd", "pwd", "secret", "token", "key", "auth", "credential")
_HARMLESS = re.compile(r"(?<![a-z])(example|sample|test|dummy|hash|sha|md5|uuid|commit|checksum)(?![a-z])")
_WORD = re.compile(r"[a-z]{2,8}")
FEATURES = ("length", "transition", "coverage", "digits", "capitals", "distinct", "hexadecimal", "switches", "telling", "harmless",
            "assigned", "path_kind", "path_depth")


# -- statistics of the corpus ---------------------------------------------------------------
def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = np.zeros(128 * 128, np.int64)
    words: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["k", "n"])
        words.clear()
        return out

    for b in batches:
        for text in b.column(0).to_pylist():
            low = text.lower()
            raw = np.frombuffer(low.encode("ascii", "replace"), np.uint8).astype(np.int64)
            if len(raw) > 1:
                pairs += np.bincount(raw[:-1] * 128 + raw[1:], minlength=len(pairs))
            words.update(_WORD.findall(low))
        if len(words) > WORDS_HELD:
            yield flush()
    if words:
        yield flush()
    some = np.flatnonzero(pairs)
    if len(some):  # transitions under their number, apart from words
        yield pa.RecordBatch.from_arrays([pa.array([f"#{k}" for k in some.tolist()], pa.string()), pa.array(pairs[some])], ["k", "n"])


def statistics(docs: DataFrame, size: int = DICTIONARY) -> tuple[np.ndarray, frozenset]:
    """Log-probabilities of character transitions, and the dictionary; from all documents."""
    counts = saved(docs.select(text_of().alias("t")).mapInArrow(_tally, "k string, n long")
                   .groupBy("k").agg(F.sum("n").alias("n")), "tally")
    table = np.ones((128, 128))
    for r in counts.where(F.col("k").startswith("#")).collect():  # 128 x 128 at most
        table[divmod(int(r.k[1:]), 128)] += r.n
    top = counts.where(~F.col("k").startswith("#") & (F.length("k") > 2)).orderBy(F.desc("n"), "k").limit(size)
    return np.log(table / table.sum(axis=1, keepdims=True)), frozenset(r.k for r in top.collect())


# -- candidates -------------------------------------------------------------------------------
def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule); a later rule leaves out what an earlier one has found."""
    out: list[tuple[int, int, str]] = []
    taken = np.zeros(0, np.int64)
    for name, pattern, group in RULES:
        new = []
        for m in pattern.finditer(text):
            a, b = m.span(group)
            k = int(np.searchsorted(taken, a, side="right"))
            # taken holds start, end, start, end ...: an odd place lies inside a span
            if k % 2 or k < len(taken) and taken[k] < b:
                continue
            new.append((a, b, name))
        if new:
            out += new
            taken = np.array([x for s in sorted((a, b) for a, b, _ in out) for x in s], np.int64)
    return sorted(out)


def coverage(value: str, words: frozenset) -> float:
    """Share of the characters in dictionary words, longest first from the left."""
    low, i, hit = value.lower(), 0, 0
    while i < len(low):
        for n in range(min(8, len(low) - i), 2, -1):
            if low[i:i + n] in words:
                hit += n
                i += n
                break
        else:
            i += 1
    return hit / max(1, len(low))


def path_kind(path: str | None) -> int:
    """A small number for the ending of a path, or for its first part."""
    name = (path or "").rstrip("/").rpartition("/")[2]
    ending = name.rpartition(".")[2] if "." in name else re.sub(r"[0-9]+", "", name)
    return zlib.crc32(ending.encode()) % 16 if path else 16


def measures(text: str, path: str | None, a: int, b: int, rule: str, table: np.ndarray, words: frozenset) -> list[float]:
    value = text[a:b]
    raw = np.frombuffer(value.lower().encode("ascii", "replace"), np.uint8).astype(np.int64)
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
    before = text[max(0, a - 60):a].lower()
    beside = " ".join(before.split()[-4:]) + " " + " ".join(text[b:b + 40].lower().split()[:2])
    n = len(value)
    return [math.log(n), float(table[raw[:-1], raw[1:]].mean()) if n > 1 else 0.0, coverage(value, words), kinds.count(0) / n,
            kinds.count(1) / n, len(set(value)) / n, float(all(c in "0123456789abcdefABCDEF" for c in value)),
            sum(x != y for x, y in zip(kinds, kinds[1:])) / n, float(sum(w in beside for w in _TELLING)),
            float(len(set(_HARMLESS.findall(beside)))), float(rule == "assigned" or bool(re.search(r"[=:][ \"']*$", before))),
            float(path_kind(path)), float((path or "").count("/"))]


# -- labelled findings ------------------------------------------------------------------------
_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ANY = _UPPER + _UPPER.lower() + _DIGITS
_NAMES = ("token", "password", "api_key", "secret", "auth", "access_key", "db_password", "client-secret")


def _of(rng: random.Random, letters: str, n: int) -> str:
    return "".join(rng.choices(letters, k=n))


def a_secret(rng: random.Random) -> tuple[str, bool]:
    """A made-up secret, and whether its own form tells what it is."""
    kind = rng.randrange(10)
    if kind == 0:
        return rng.choice(("AKIA", "ASIA")) + _of(rng, _UPPER + "234567", 16), True
    if kind == 1:
        return f"gh{rng.choice('pousr')}_" + _of(rng, _ANY, rng.choice((36, 40, 76))), True
    if kind == 2:
        return f"xox{rng.choice('abp')}-{_of(rng, _DIGITS, 11)}-{_of(rng, _ANY, 24)}", True
    if kind == 3:
        part = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
        return f"eyJ{part(18)}.eyJ{part(rng.randrange(20, 90))}.{part(32)}", True
    if kind == 4:
        return f"-----BEGIN {rng.choice(('', 'RSA ', 'EC '))}PRIVATE KEY-----", True
    if kind < 7:
        return rng.randbytes(rng.choice((12, 16, 20, 24, 32))).hex(), False
    if kind == 7:
        return base64.b64encode(rng.randbytes(rng.randrange(18, 60))).decode(), False
    if kind == 8:
        return _of(rng, _ANY, rng.randrange(20, 48)), False
    return _of(rng, _ANY + "!#$%&*+-?@^_~", rng.randrange(10, 20)), False


def _wordy(rng: random.Random, words: list[str], least: int, joint: str) -> str:
    out = rng.choice(words)
    while len(out) < least:
        out += joint + rng.choice(words)
    return out


def a_lookalike(rng: random.Random, words: list[str]) -> str:
    """A harmless value, in its surroundings."""
    kind = rng.randrange(9)
    run = _wordy(rng, words, rng.randrange(20, 34), "")
    if kind < 3:
        return run if rng.random() < 0.7 else run.capitalize() if rng.random() < 0.5 else run.upper()
    if kind == 3:
        return _wordy(rng, words, 20, rng.choice("_-/"))
    if kind == 4:
        return f"{rng.choice(_NAMES)} = {rng.choice(('get_', 'read-', ''))}{_wordy(rng, words, 8, rng.choice('_-'))}"
    if kind == 5:
        return f"{rng.choice(_NAMES)}: {rng.choice(('x' * rng.randrange(8, 40), '*' * 12, 'changeme', 'your-' + rng.choice(words) + '-here', '12345678', '<' + run + '>'))}"
    if kind == 6:
        return rng.choice(("=", "-", "_", "0", "A")) * rng.randrange(20, 80)
    if kind == 7:
        return f"{rng.choice(('commit', 'sha', 'md5', 'checksum', 'hash'))} {rng.randbytes(rng.choice((16, 20, 32))).hex()}"
    h = rng.randbytes(16).hex()
    return f"uuid {h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def plant(text: str, rng: random.Random, words: list[str]) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with a secret and a look-alike between its words, and (start, end, label) of both."""
    spans, pieces, at = [], [], 0
    gaps = [0, *[m.end() for m in re.finditer(r"\s", text)]]
    for place, label in sorted(zip((rng.choice(gaps), rng.choice(gaps)), rng.sample((0, 1), 2))):
        if label:
            value, plain = a_secret(rng)
            if not plain and (len(value) < 20 or rng.random() < 0.6):
                value = f"{rng.choice(_NAMES)}{rng.choice((' = ', '=', ': '))}" + rng.choice(("{}", "'{}'", '"{}"')).format(value)
        else:
            value = a_lookalike(rng, words)
        pieces += [text[at:place], value, " "]
        start = sum(map(len, pieces[:-2]))
        spans.append((start, start + len(value), label))
        at = place
    return "".join([*pieces, text[at:]]), spans


def _plant(table: np.ndarray, words: frozenset, rounds: int):
    own = sorted(w for w in words if len(w) > 2) or ["alpha", "beta", "gamma", "delta", "river", "table"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, text, path in zip(*(b.column(c).to_pylist() for c in ("doc_id", "_q_text", "path"))):
                for k in range(rounds):
                    rng = random.Random(zlib.crc32(f"{d}:{k}".encode()))
                    new, spans = plant(text, rng, own)
                    for s, e, rule in candidates(new):
                        label = next((y for a, z, y in spans if a <= s and e <= z), None)
                        if label is not None:
                            rows.append((d, s, e, rule, label, *measures(new, path, s, e, rule, table, words)))
            yield _batch(rows, label=True)

    return run


# -- scan -------------------------------------------------------------------------------------
_SPAN = "doc_id long, start long, `end` long, rule string"
_MEASURES = ", ".join(f"{f} double" for f in FEATURES)


def _batch(rows: list[tuple], label: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int32()] * label, *[pa.float64()] * len(FEATURES)]
    cols = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "start", "end", "rule", *["label"] * label, *FEATURES])


def _find(table: np.ndarray, words: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, text, path in zip(*(b.column(c).to_pylist() for c in ("doc_id", "_q_text", "path"))):
                for s, e, rule in candidates(text):
                    rows.append((d, s, e, rule, *measures(text, path, s, e, rule, table, words)))
            yield _batch(rows, label=False)

    return run


def _rows(docs: DataFrame, path: str) -> DataFrame:
    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_q_text"), where.alias("path"))


def find(docs: DataFrame, stats: tuple[np.ndarray, frozenset], path: str = "source") -> DataFrame:
    """Candidates of all documents with their measures; ``stats`` from :func:`statistics`."""
    return saved(_rows(docs, path).mapInArrow(_find(*stats), f"{_SPAN}, {_MEASURES}"), "candidates")


def planted(docs: DataFrame, stats: tuple[np.ndarray, frozenset], path: str = "source", limit: int = PLANT_ROWS) -> DataFrame:
    """Labelled findings planted in copies of the ``limit`` documents of the smallest hash (of fewer, each several times)."""
    rows = _rows(docs, path)
    chosen = saved(rows.select(F.xxhash64("doc_id", "_q_text").alias("h")).distinct().orderBy("h").limit(limit), "hosts")
    rounds = min(200, -(-TRAIN_FINDINGS // (2 * max(1, chosen.count()))))
    hosts = rows.withColumn("h", F.xxhash64("doc_id", "_q_text")).join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # 8 bytes a row
    return saved(hosts.select("doc_id", "_q_text", "path").mapInArrow(_plant(*stats, rounds), f"{_SPAN}, label int, {_MEASURES}"), "planted")


def scan(found: DataFrame, labelled: DataFrame, limit: int = TRAIN_FINDINGS) -> DataFrame:
    """``found`` with score and is_secret, by a forest fitted on ``labelled`` (with column ``label``)."""
    half = [labelled.where(F.col("label") == y).orderBy(F.xxhash64("doc_id", "start", "end"), "doc_id", "start").limit(limit // 2)
            for y in (0, 1)]
    sample = saved(half[0].unionByName(half[1]), "findings")
    out = ["doc_id", "start", "end", "rule"]
    if sample.select("label").distinct().count() < 2:
        return found.select(*out, F.lit(1.0).alias("score"), F.lit(1).alias("is_secret"))
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_q_x")
    forest = RandomForestClassifier(featuresCol="_q_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7)
    path = scratch_dir(found.sparkSession, "forest")
    forest.fit(vector.transform(sample.withColumn("label", F.col("label").cast("double")))).save(path)
    model = RandomForestClassificationModel.load(path)
    scored = model.transform(vector.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*out, "score", (F.col("score") >= 0.5).cast("int").alias("is_secret"))


def op2_secret_scan(spark, sf_dir):
    docs = documents(spark, sf_dir)
    stats = statistics(docs)
    return scan(find(docs, stats), planted(docs, stats))
