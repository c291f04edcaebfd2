"""Merkle manifest of a table: one tree a source, one tree over the sources.

A leaf is the SHA-256 of a row's fields (``-`` for null, else the UTF-8 byte count,
``:`` and the value). Within a source leaves ascend by doc_id; every ``FANOUT``
consecutive nodes of a level become one node of the next, the digest of their
hex digests. Digests of sources, ordered by source (null first, bytewise), are
the leaves of the upper tree, whose top is the root.

Every level is one equijoin of the level with itself: the node in slot 0 of a run
computes the indices of its siblings (its own index plus the slot offsets 0, 1, ...),
joins them, and emits the parent. Runs hold at most ``FANOUT`` nodes, so no join
key is hot whatever the sizes of the sources. Proofs go down the same way: a run takes
the path of its parent's run, so a path of many levels is held once a run, and a row
cuts its own digest out of its run. Levels shrink by the factor ``FANOUT``; each is
written to the shared folder.

Places of rows come from a range partitioning by (source, doc_id, leaf): the
place within the sorted partition plus the rows of the partitions before. A source
with a third of all rows spans many partitions; the row's number of the scan is the
last sort key, so equal rows are spread too.

Defined cases: fields are null or not as they stand (a null text is ``-``, an empty
one ``0:``); a null doc_id comes first and is never tampered with; rows of one doc_id
and source are ordered by their leaves (equal rows have equal leaves, so their
order changes nothing); a lone row is its source's digest, a lone source the root;
a row without siblings has the empty proof; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, saved

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<l:string,r:string>"


@dataclass(frozen=True)
class Manifest:
    """``rows``: the leaves' rows with k, idx and n; ``levels``: runs of the sources' trees,
    lowest first; ``tops``: those of the tree over sources, whose leaves are ``sources``."""

    rows: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    tops: list[DataFrame]


# -- leaves ---------------------------------------------------------------------------
def field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields.values()]), 256)


def lowered(c: Column) -> Column:
    """A-Z as a-z, nothing else."""
    return F.translate(c, _UPPER, _LOWER)


# -- places ---------------------------------------------------------------------------
def numbered(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` with idx, the place among the rows of ``key`` (from 0), and n, their number."""
    placed = saved(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
                   .withColumn("_q_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftrightunsigned("_q_at", 33)  # the upper bits are the partition
    blocks = (placed.groupBy(key, part.alias("_q_part")).agg(F.min("_q_at").alias("first"), F.count("*").alias("rows")))
    of_key = Window.partitionBy(key)
    starts = blocks.select(
        key, "_q_part", (F.sum("rows").over(of_key.orderBy("_q_part")) - F.col("rows") - F.col("first")).alias("_q_shift"),
        F.sum("rows").over(of_key).alias("n"))
    return (placed.withColumn("_q_part", part).join(starts, [key, "_q_part"])
            .withColumn("idx", F.col("_q_at") + F.col("_q_shift")).drop("_q_at", "_q_part", "_q_shift"))


# -- trees ----------------------------------------------------------------------------
def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Runs (k, run, n, text, digest) of the nodes (k, idx, n, digest) of a level:
    ``text`` holds the digests of the run, ``digest`` is the parent's. A tree that has
    come to one node passes it on, without a text."""
    level = nodes.where("n > 1")
    heads = level.where(F.col("idx") % fanout == 0).select(
        "k", "n", F.col("idx").alias("head"), F.explode(F.sequence(F.lit(0), F.least(F.lit(fanout - 1), F.col("n") - 1 - F.col("idx")).cast("int"))).alias("slot"))
    met = (heads.withColumn("sibling", F.col("head") + F.col("slot"))
           .join(level.select("k", F.col("idx").alias("sibling"), "digest"), ["k", "sibling"]))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", "digest"))), lambda s: s["digest"]), "")
    runs = met.groupBy("k", "head", "n").agg(text.alias("text"))
    return runs.select("k", F.floor(F.col("head") / fanout).alias("run"), "n", "text", F.sha2("text", 256).alias("digest")).unionByName(
        nodes.where("n = 1").select("k", F.col("idx").alias("run"), "n", F.lit(None).cast("string").alias("text"), "digest"))


def grow(nodes: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of all trees, until each has one node; none for no nodes."""
    most, levels = nodes.agg(F.max("n")).first()[0], []
    while most and (most > 1 or not levels):
        levels.append(saved(parents(nodes, fanout), "level"))
        most = -(-most // fanout)
        nodes = levels[-1].select("k", F.col("run").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), "digest")
    return levels


def siblings(text: Column, slot: Column) -> Column:
    """What stands left and right of a slot's digest in its run."""
    left = slot * HEX
    return F.struct(text.substr(F.lit(1), left.cast("int")).alias("l"),
                    text.substr((left + HEX + 1).cast("int"), F.length(text)).alias("r"))


def onto(rows: DataFrame, place: str, runs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``rows`` with the path above them: joined with their runs, whose ``path`` is that above the run."""
    up = runs.select("k", F.col("run").alias("_q_run"), F.col("text").alias("_q_text"), F.col("path").alias("_q_path"),
                     *[c for c in runs.columns if c not in ("k", "run", "n", "text", "digest", "path")])
    own = siblings(F.col("_q_text"), F.col(place) % fanout)
    path = F.when(F.col("_q_text").isNull(), F.col("_q_path")).otherwise(F.concat(F.array(own), F.col("_q_path")))
    return (rows.withColumn("_q_run", F.floor(F.col(place) / fanout)).join(up, ["k", "_q_run"])
            .withColumn("path", path).drop("_q_run", "_q_text", "_q_path"))


def descend(levels: list[DataFrame], tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The lowest runs with their ``path``. ``tops(k, path, ...)``: what stands above the tree of each key."""
    runs = levels[-1].join(tops, "k")
    for below in reversed(levels[:-1]):
        runs = onto(below, "run", runs, fanout)
    return runs


# -- manifest -------------------------------------------------------------------------
def build(rows: DataFrame, fanout: int = FANOUT) -> Manifest | None:
    """From rows with ``k`` (a key that is not null), ``leaf`` and the sort columns
    doc_id and _q_row; None for no rows."""
    placed = saved(numbered(rows, "k", "doc_id", "leaf", "_q_row"), "leaves")
    levels = grow(placed.select("k", "idx", "n", F.col("leaf").alias("digest")), fanout)
    if not levels:
        return None
    named = levels[-1].select(F.lit("").alias("k"), F.col("k").alias("name"), F.col("digest").alias("subroot"))
    sources = saved(numbered(named, "k", "name"), "sources")
    return Manifest(placed, levels, sources, grow(sources.select("k", "idx", "n", F.col("subroot").alias("digest")), fanout))


def proofs(m: Manifest, fanout: int = FANOUT) -> DataFrame:
    """``m.rows`` with subroot, root and path: the digests left and right of the row's own, level by level."""
    apex = m.tops[-1].select("k", F.array().cast(f"array<{_STEP}>").alias("path"), F.col("digest").alias("root"))
    over = onto(m.sources, "idx", descend(m.tops, apex, fanout), fanout).select(F.col("name").alias("k"), "path", "subroot", "root")
    return onto(m.rows, "idx", descend(m.levels, over, fanout), fanout)


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda a, s: F.sha2(F.concat(s["l"], a, s["r"]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """k, doc_id, leaf and the leaf after tampering (null where nothing is tampered with)."""
    own = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    source = F.col("source").cast("string")
    return docs.select(
        F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("s"), source)).alias("k"),  # "-" sorts before "s"
        F.col("doc_id").cast("long").alias("doc_id"), leaf_of(own).alias("leaf"),
        F.when(hit, leaf_of(own | {"text": lowered(F.col("text").cast("string"))})).alias("tampered"),
        F.monotonically_increasing_id().alias("_q_row"))


def manifest(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: digests, the proof and the check of the tampered row."""
    rows = saved(leaves(docs), "rows")
    m = build(rows)
    if m is None:
        return rows.select("doc_id", "leaf", *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
                           F.lit(None).cast("boolean").alias("verified"))
    folded = proofs(m).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256).alias("proof_sha256"),
        fold(F.col("path"), F.coalesce("tampered", "leaf")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir):
    return manifest(documents(spark, sf_dir))


def _field_sql(c: str) -> str:
    return f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')"


_LEAF = "sha256(" + " || ".join(_field_sql(f"CAST({c} AS VARCHAR)") for c in FIELDS) + ")"
_TAMPERED = "sha256(" + " || ".join(_field_sql(f"translate(text, '{_UPPER}', '{_LOWER}')" if c == "text" else f"CAST({c} AS VARCHAR)") for c in FIELDS) + ")"
# CRC-32 of the decimal digits, bit by bit
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")

SQL = {"op11_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, {_LEAF} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN {_TAMPERED} END AS tampered FROM documents
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
),
trees AS (
    SELECT 0 AS level, source, idx, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM placed
    UNION ALL
    SELECT level + 1, source, idx // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + {FANOUT - 1}) // {FANOUT})
    FROM trees WHERE n > 1 GROUP BY level, source, idx // {FANOUT}
),
sources AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx
    FROM trees WHERE n = 1
),
tops AS (
    SELECT 0 AS level, idx, subroot AS digest, count(*) OVER () AS n FROM sources
    UNION ALL
    SELECT level + 1, idx // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + {FANOUT - 1}) // {FANOUT})
    FROM tops WHERE n > 1 GROUP BY level, idx // {FANOUT}
),
runs AS (
    SELECT level, source, idx // {FANOUT} AS run, string_agg(digest, '' ORDER BY idx) AS text FROM trees WHERE n > 1 GROUP BY ALL
),
top_runs AS (
    SELECT level, idx // {FANOUT} AS run, string_agg(digest, '' ORDER BY idx) AS text FROM tops WHERE n > 1 GROUP BY ALL
),
steps AS (
    SELECT p.doc_id, p.leaf, p.source, p.idx AS row, r.level AS step,
           r.text[1 : p.idx // CAST(power({FANOUT}, r.level) AS BIGINT) % {FANOUT} * {HEX}] AS l,
           r.text[(p.idx // CAST(power({FANOUT}, r.level) AS BIGINT) % {FANOUT} + 1) * {HEX} + 1 :] AS r
    FROM placed p JOIN runs r ON r.source IS NOT DISTINCT FROM p.source AND r.run = p.idx // CAST(power({FANOUT}, r.level + 1) AS BIGINT)
    UNION ALL
    SELECT p.doc_id, p.leaf, p.source, p.idx, 100 + r.level,
           r.text[1 : s.idx // CAST(power({FANOUT}, r.level) AS BIGINT) % {FANOUT} * {HEX}],
           r.text[(s.idx // CAST(power({FANOUT}, r.level) AS BIGINT) % {FANOUT} + 1) * {HEX} + 1 :]
    FROM placed p JOIN sources s ON s.source IS NOT DISTINCT FROM p.source
    JOIN top_runs r ON r.run = s.idx // CAST(power({FANOUT}, r.level + 1) AS BIGINT)
),
paths AS (
    SELECT source, row, list({{'l': l, 'r': r}} ORDER BY step) AS path FROM steps GROUP BY ALL
),
folded AS (
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
           sha256(coalesce(array_to_string(list_transform(t.path, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
           list_reduce(list_prepend({{'l': coalesce(p.tampered, p.leaf), 'r': ''}}, coalesce(t.path, [])),
                       lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root
    FROM placed p JOIN sources s ON s.source IS NOT DISTINCT FROM p.source
    LEFT JOIN paths t ON t.source IS NOT DISTINCT FROM p.source AND t.row = p.idx
)
SELECT *, folded_root = root AS verified FROM folded
"""}
