"""Near-duplicates by SimHash fingerprints, found through a grid over segment popcounts.

A fingerprint's 64 bits are cut into 32 segments of two bits; its embedding is the vector of
the segments' bit counts. A differing bit moves one count by at most one, so the Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints. Counts are
kept in unary (two bits each), so that Manhattan distance is one xor and one bit count.

The range join: the 32 coordinates form BLOCKS groups. Within distance r at most r groups
differ, hence two fingerprints that link share the grid cell of some choice of BLOCKS - r
groups. Pairs of one cell pass the Manhattan bound, then the exact comparison. Cells of more
than CELL_LIMIT fingerprints are not paired: their members are linked through the fingerprints
one flipped bit away, of which any two members within two bits share one, at a cost linear in
the members. Both ways give the same components.

Edge cases: texts without words (missing ones too) have fingerprint zero and link like any
other. Rows of one id are separate rows, each in the class of its text. Rows without id take part like all
others; a class without any id has no component_id (NULL). `keep_one` keeps one row of every class, one
with an id if there is any; of rows equal in id and text, one. Other columns are carried or ignored, never read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark.llm.common import documents, spread_lookup
from sensorspark.llm.components import components
from sensorspark.plans.shared import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 5
CELL_LIMIT = 32
_CHUNK = 1 << 15
_EVEN = 0x5555555555555555


def simhash(text: str) -> int:
    """64-bit fingerprint, as a signed integer."""
    words = text.encode().lower().split()  # ASCII lower case, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    firsts, lasts = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(firsts), _CHUNK):  # a long text needs no more memory than a chunk
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(firsts[at: at + _CHUNK], lasts[at: at + _CHUNK],
                                                                       strict=True)])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(firsts)).tobytes(), "big", signed=True)


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([simhash(t.as_py() or "") for t in texts], pa.int64())


def fingerprints(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): one row per row of the input."""
    return documents(df, text, doc_id).select("doc_id", _fingerprints("text").alias("fp"))


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, in unary: 0, 1, 2 become 00, 01, 11."""
    next_bit = F.shiftrightunsigned(fp, 1)
    even = F.lit(_EVEN).cast("bigint")
    some, both = fp.bitwiseOR(next_bit).bitwiseAND(even), fp.bitwiseAND(next_bit).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _masks(blocks: int) -> list[int]:
    """One mask over the embedding per choice of blocks that stay equal; as signed integers."""
    cuts = [round(i * 32 / blocks) for i in range(blocks + 1)]
    groups = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = (sum(chosen) for chosen in combinations(groups, blocks - DISTANCE))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(points: DataFrame, blocks: int = BLOCKS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints `points` (fp, node) as their distance says.

    Every pair within DISTANCE bits is linked directly or over links of its crowded cell.
    """
    emb = points.withColumn("e", embedding(F.col("fp")))
    cells = emb.select("fp", "e", "node", F.posexplode(F.array(
        *[F.col("e").bitwiseAND(F.lit(m).cast("bigint")) for m in _masks(blocks)])).alias("choice", "cell"))
    sizes = cells.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(cells.join(sizes, ["choice", "cell"]), "cells")
    few = members.filter(F.col("n") <= cell_limit)
    near = lambda x: F.bit_count(F.col(f"l.{x}").bitwiseXOR(F.col(f"r.{x}"))) <= DISTANCE
    paired = few.alias("l").join(few.alias("r"), (F.col("l.choice") == F.col("r.choice")) & (F.col("l.cell") == F.col("r.cell"))
                                 & (F.col("l.node") < F.col("r.node")) & near("e") & near("fp"))
    direct = paired.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    crowd = members.filter(F.col("n") > cell_limit).select("fp", "node").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)])
    around = crowd.select("fp", "node", F.explode(flips).alias("flip")).select(
        "fp", "node", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    # Members of one middle are two bits apart at most, so each is rightly linked to the least of them.
    centre = around.groupBy("mid").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = around.join(centre, "mid").filter("node <> a").select("a", F.col("node").alias("b"))
    return direct.unionByName(starred).distinct()


def _rooted(df: DataFrame, text: str, doc_id: str, blocks: int, cell_limit: int) -> DataFrame:
    """(doc_id, fp, t, root, component_id) per row: hash of the text, least fingerprint and least id of the row's class."""
    known = documents(df, text, doc_id).select("doc_id", _fingerprints("text").alias("fp"), F.xxhash64("text").alias("t"))
    rows = materialize(known, "fingerprints")
    counts = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    points = counts.select("fp", F.col("fp").alias("node"), "least")
    found = components(links(points.select("fp", "node"), blocks, cell_limit))
    rooted = materialize(points.join(found, "node", "left").select("fp", F.coalesce("component", "fp").alias("root"), "least"), "roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return spread_lookup(rows, rooted.join(ids, "root").select("fp", "root", "component_id"), "fp", counts, rows.count())


def classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", blocks: int = BLOCKS,
            cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of the input, with the least id reachable over links."""
    return _rooted(df, text, doc_id, blocks, cell_limit).select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id", blocks: int = BLOCKS,
             cell_limit: int = CELL_LIMIT) -> DataFrame:
    """The input with one row per class: the one with the least id (none is last), then the least hash of its text."""
    rows = _rooted(df, text, doc_id, blocks, cell_limit)
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("b"))
    chosen = best.select(F.col("b.doc_id").alias("_kept"), F.col("b.t").alias("_t"))
    key, content = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Rows of one id and one text are in one class, of which one row stays.
    first = W.partitionBy("_kept", "_t").orderBy(content)
    kept = df.withColumn("_hash", F.xxhash64(content)).join(chosen, key.eqNullSafe(F.col("_kept")) & (F.col("_hash") == F.col("_t")))
    kept = kept.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
