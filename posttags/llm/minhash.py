"""Near-duplicates by circulant MinHash, banding and exact verification.

All coordinates of a signature come from two permutations: one scatters the shingles, the
other, shifted round by one place more for each coordinate, ranks them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from posttags.llm.common import few, join_hot, lean, whole_text
from posttags.llm.components import components
from posttags.llm.shingles import WIDTH, shingle_set
from posttags.session import materialise

# 32 bands of 4 rows propose a pair at similarity 0.75 except once in 190,000.
BANDS, ROWS = 32, 4
SIMILAR = 75  # per cent
# Chance at most that a link at the threshold shows too few equal coordinates for its whole sets
# to be compared, in buckets whose first comparison left them apart: that of the bands.
ESCAPES = 1 / 190_000
# Share of the members still apart that must join for another round of best partners.
JOINING = 0.2
# Members of a bucket compared with each other in one task.
TILE = 1500
_SCATTER = np.uint64(0xBF58476D1CE4E5B9)
_RANK_A, _RANK_B = np.uint32(0x7FEB352D), np.uint32(0x846CA68B)


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Least rank of the ``shingles`` under each shift of the second permutation."""
    places = shingles ^ (shingles >> np.uint64(31))
    places = ((places * _SCATTER) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(1, coordinates + 1, dtype=np.uint32)
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), 256):
        rank = places[at : at + 256, None] + shifts
        rank *= _RANK_A
        rank ^= rank >> np.uint32(15)
        rank *= _RANK_B
        np.minimum(least, rank.min(axis=0), out=least)
    return least


def promising(similar: int, coordinates: int = BANDS * ROWS) -> int:
    """Equal coordinates that a link at ``similar`` per cent has, but for ESCAPES of all."""
    share, below = similar / 100, 0.0
    for equal in range(coordinates + 1):
        below += math.comb(coordinates, equal) * share**equal * (1 - share) ** (coordinates - equal)
        if below > ESCAPES:
            return equal
    return coordinates


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, signature`` of each row; the last two null for empty sets.

    ``set_id`` is a 128-bit digest of the whole set.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, signatures = [], [], []
            for text in few(batch.column(1)):
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                ids.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()), pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "signature"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lean(sign), "doc_id long, n_shingles long, set_id binary, signature binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the whole set as sorted 64-bit numbers."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text).tobytes() for text in few(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["doc_id", "shingles"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lean(sets), "doc_id long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The ``a, b`` pairs whose whole sets share at least ``similar`` per cent of their union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep = []
            for x, y in zip(left, right):
                keep.append(_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similar))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a long, b long")


def band_keys(signature: Column) -> Column:
    """One key per band: its number with its rows."""
    size = 4 * ROWS
    parts = [F.xxhash64(F.lit(i), F.substring(signature, i * size + 1, size)) for i in range(BANDS)]
    return F.array(*parts)


def _linked(left: np.ndarray, right: np.ndarray, similar: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= similar * (len(left) + len(right) - both)


def cross_pairs(
    members: DataFrame, best: bool, tile: int = TILE, similar: int = SIMILAR
) -> DataFrame:
    """Pairs between members of different components within a bucket, as ``a, b``.

    ``members`` has ``key, band, doc_id, component, n_shingles, signature``. A bucket is dealt
    into tiles, each pair of tiles is one task's work, and only pairs whose signatures agree
    on ``promising`` coordinates are looked at. With ``best`` the most promising partner of
    each member comes out, to be verified. Without, ``members`` also has ``shingles``: pairs
    are verified in place, each in its first common band alone, and only links come out.
    """
    tiles = members.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    mine = F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    dealt = (
        members.join(tiles, "key")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(others))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
    )

    def compare(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_numpy()
        parts, sizes = group.column("component").to_numpy(), group.column("n_shingles").to_numpy()
        rows = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32)
        rows = rows.reshape(len(ids), -1)
        first = group.column("mine").to_numpy() == group.column("low")[0].as_py()
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        bands, band = rows.reshape(len(ids), -1, ROWS), group.column("band")[0].as_py()
        sets = [] if best else [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        found = []
        for i in range(len(ids)):
            near = right if first[i] and len(right) else left
            near = near[parts[near] != parts[i]]
            small, large = np.minimum(sizes[near], sizes[i]), np.maximum(sizes[near], sizes[i])
            near = near[100 * small >= similar * large]
            equal = (rows[near] == rows[i]).sum(axis=1)
            hit = equal >= promising(similar, rows.shape[1])
            near, equal = near[hit], equal[hit]
            if best and len(near):
                top = np.lexsort((ids[near], -equal))[:1]
                near, equal = near[top], equal[top]
            if not best and len(near):
                once = (ids[near] > ids[i]) & ((bands[near] == bands[i]).all(axis=2).argmax(axis=1) == band)
                linked = [j for j in near[once] if _linked(sets[i], sets[j], similar)]
                near, equal = np.array(linked, np.int64), np.zeros(len(linked), np.int64)
            found.append((np.full(len(near), ids[i]), ids[near], equal))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(["one", "other", "equal"], map(pa.array, columns))))

    pairs = dealt.groupBy("key", "low", "high").applyInArrow(compare, "one long, other long, equal long")
    if best:
        top = F.max(F.struct("equal", (-F.col("other")).alias("minus"))).alias("top")
        pairs = pairs.groupBy("one").agg(top).select("one", (-F.col("top.minus")).alias("other"))
    return pairs.select(F.greatest("one", "other").alias("a"), F.least("one", "other").alias("b")).distinct()


def _still_apart(stars: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with their signatures, of buckets that hold several components."""
    labelled = stars.join(found.withColumnRenamed("node", "member"), "member", "left")
    labelled = labelled.select("key", "band", "member", F.coalesce("component", "member").alias("component"))
    labelled = materialise(labelled, "band-components")
    apart = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("key")
    )
    signed = classes.select(F.col("rep").alias("member"), "n_shingles", "signature")
    members = labelled.join(apart, "key").join(signed, "member").withColumnRenamed("member", "doc_id")
    return materialise(members, "apart")


def near_duplicates(docs: DataFrame, similar: int = SIMILAR, tile: int = TILE) -> DataFrame:
    """Components of documents linked at Jaccard ``similar`` per cent of 5-word shingles.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``. Equal sets are
    one class and are compared once. In every bucket of a band each member meets the bucket's
    least doc_id first. While a bucket's members are in several components, each meets its
    most promising partner in another one; once that joins few any more, all promising pairs
    across components are compared. Links hold on whole sets only.

    Words are cut at ASCII white space, A-Z lower-cased. A null or empty text, or one without
    words, has no shingles and is linked with nothing; so is a row without doc_id, whose
    component_id is null. Rows that share a doc_id have one
    fate: the links of each hold for all. An empty table gives an empty
    result. Other columns are not looked at.
    """
    rows = materialise(signed(docs), "signed")
    classes = materialise(
        rows.where("set_id is not null and doc_id is not null")
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("size"),
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        ),
        "set-classes",
    )
    bands = classes.select(
        F.col("rep").alias("member"), F.posexplode(band_keys(F.col("signature"))).alias("band", "key")
    )
    buckets = bands.groupBy("key").agg(F.min("member").alias("pivot"), F.count("*").alias("n"))
    stars = materialise(
        bands.join(buckets.where("n > 1").drop("n"), "key"), "band-stars"
    )
    first = (
        stars.where("member != pivot")
        .groupBy(F.col("member").alias("a"))
        .agg(F.min("pivot").alias("b"))
    )
    first = materialise(first, "first-pairs")
    shared = stars.select(F.col("member").alias("doc_id")).distinct()
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = whole.join(shared, "doc_id", "left_semi")
    sets = materialise(shingle_sets(whole), "shingle-sets")
    links = materialise(verified(first, sets, similar), "verified")
    tested, best = first, True
    while best:
        members = _still_apart(stars, classes, components(links))
        pairs = cross_pairs(members, True, tile, similar).join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "cross-pairs")
        more = materialise(verified(pairs, sets, similar), "verified")
        tested, links = tested.unionByName(pairs), links.unionByName(more)
        # once few members find a partner, all promising pairs left are compared
        best = more.count() > JOINING * members.select("doc_id").distinct().count()
    members = _still_apart(stars, classes, components(links)).join(sets, "doc_id")
    more = materialise(cross_pairs(members, False, tile, similar), "verified")
    links = links.unionByName(more)
    found = components(links).withColumnRenamed("node", "rep")
    judged = materialise(
        classes.select("set_id", "rep", "size")
        .join(found, "rep", "left")
        .select("set_id", "size", F.coalesce("component", "rep").alias("component_id")),
        "set-components",
    )
    total = judged.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    linked = rows.where("set_id is not null and doc_id is not null").select("doc_id", "n_shingles", "set_id")
    alone = rows.where("set_id is null or doc_id is null")
    return (
        join_hot(linked, judged, "set_id", "size", total)
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
