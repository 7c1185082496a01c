"""Near duplicates by SimHash, found with anchor points of a covering code.

A fingerprint's 64 bits are cut into blocks so that two fingerprints within the distance agree in
some block up to that block's share of it, 0 or 1. In a block with share 1 the anchors are the
words of a covering code: the Hamming code of 15 bits, whose words are within 1 of every
point, with the block's other bits as they are. Every fingerprint is sent to all anchors within
radius plus share, 2; one of them, within the radius, is its home. Of two fingerprints that
differ in at most one bit of the block, each is found at the other's home. In a block with share
0 every point is its own anchor. Only at anchors are fingerprints compared, home against all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import byte_view, lower_ascii, ragged, slices, stored, with_id
from martloom.llm.components import connected_components, join_per_key

BITS = 64
CODE_BITS = 15
SEED = 42
#: Fingerprints at one anchor that are compared in one cell; more are dealt to several.
MOST_AT_ANCHOR = 20_000
#: Pairs compared by one numpy step.
PAIRS = 1 << 20


def shingle_hashes(words: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words of a text whose words are joined by spaces."""
    if not words:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    begins = np.concatenate([[0], gaps + 1])
    ends = np.append(gaps, len(words))
    n = max(1, len(begins) - shingle + 1)
    ends = ends[shingle - 1 :] if len(begins) >= shingle else ends[-1:]
    digest = xxhash.xxh64_digest
    joined = b"".join(
        [
            digest(words[a:b], SEED)
            for a, b in zip(begins[:n].tolist(), ends.tolist(), strict=True)
        ]
    )
    return np.frombuffer(joined, ">u8")


def fingerprint(words: bytes, shingle: int) -> int:
    """A bit is set if it is in more than half of the shingles' hashes; no words: 0."""
    hashes = shingle_hashes(words, shingle)
    if not len(hashes):
        return 0
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8)).reshape(-1, BITS)
        votes += some.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = byte_view(batch.column(1))
        found = np.zeros(batch.num_rows, np.uint64)
        for first, last in slices(starts):
            raw = lower_ascii(data[starts[first] : starts[last]]).tobytes()
            for k in range(first, last):
                text = raw[starts[k] - starts[first] : starts[k + 1] - starts[first]]
                found[k] = fingerprint(b" ".join(text.split()), shingle)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"]
        )


def blocks(distance: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, share of the distance): shares of 1, and one of 0 if that suffices.

    Were two fingerprints further apart than its share in every block, they would differ in at least
    the sum of all shares plus one each, distance + 1.
    """
    ones, zeros = (distance + 1) // 2, (distance + 1) % 2
    n = ones + zeros
    if not 0 <= distance <= 7:
        raise ValueError("distances of 0 to 7 bits are supported")
    edges = [BITS * k // n for k in range(n + 1)]
    shares = [1] * ones + [0] * zeros
    return [(a, b - a, t) for a, b, t in zip(edges[:-1], edges[1:], shares, strict=True)]


def _errors() -> list[np.ndarray]:
    """For each syndrome of the Hamming code, the error patterns of weight up to 2 that have it.

    Bit k of a point stands for the column k + 1 of the check matrix.
    """
    by: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    by[0].append(0)
    for i in range(1, CODE_BITS + 1):
        by[i].append(1 << (i - 1))
        for j in range(i + 1, CODE_BITS + 1):
            by[i ^ j].append(1 << (i - 1) | 1 << (j - 1))
    return [np.array(sorted(x, key=lambda e: (bin(e).count("1"), e))) for x in by]


def _syndromes() -> np.ndarray:
    points = np.arange(1 << CODE_BITS)
    out = np.zeros(1 << CODE_BITS, np.int64)
    for k in range(CODE_BITS):
        out ^= np.where(points >> k & 1, k + 1, 0)
    return out


def anchors(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, number of the fingerprint, whether it is at home), for all anchors of all."""
    errors, syndrome = _errors(), _syndromes()
    numbers = np.arange(len(fps))
    for block, (first, width, share) in enumerate(blocks(distance)):
        mask = (1 << width) - 1 if width < 64 else 0xFFFFFFFFFFFFFFFF
        point = (fps >> np.uint64(first)) & np.uint64(mask)
        name = np.uint64(block << 58)
        if not share:
            # A whole fingerprint is as good a name as a block of it.
            yield (point | name if width < 58 else point), numbers, np.ones(len(fps), bool)
            continue
        point = point.astype(np.int64)
        coded, free = point & ((1 << CODE_BITS) - 1), point >> CODE_BITS
        # All changes of the other bits by their weight, up to 2.
        n_free = width - CODE_BITS
        flips = {
            0: np.array([0]),
            1: 1 << np.arange(n_free),
            2: np.array([1 << i | 1 << j for i in range(n_free) for j in range(i)] or [], np.int64),
        }
        by_syndrome = syndrome[coded]
        for s, patterns in enumerate(errors):
            some = np.flatnonzero(by_syndrome == s)
            for place, pattern in enumerate(patterns.tolist()):
                weight = bin(pattern).count("1")
                for more in range(3 - weight):
                    changes = flips[more]
                    if not len(changes) or not len(some):
                        continue
                    code = (coded[some] ^ pattern)[:, None]
                    rest = free[some][:, None] ^ changes[None, :]
                    anchor = (code | rest << CODE_BITS).astype(np.uint64).ravel()
                    home = np.full(len(anchor), place == 0 and more == 0)
                    yield anchor | name, np.repeat(some, len(changes)), home


def _replicate(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for anchor, number, home in anchors(fps, distance):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array(fps[number].view(np.int64)),
                    pa.array(home),
                ],
                names=["anchor", "fp", "home"],
            )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest of its component, instead of all given edges."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (jumped := new[new]).tolist() != new.tolist():
            new = jumped
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def compare(
    groups: np.ndarray, fps: np.ndarray, home: np.ndarray, distance: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is linked within the groups, which are runs of equal numbers."""
    edges = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1)) if len(groups) else groups
    sizes = np.diff(np.append(edges, len(groups)))
    first, size = np.repeat(edges, sizes), np.repeat(sizes, sizes)
    homes = np.flatnonzero(home & (size > 1))
    at = 0
    work = np.cumsum(size[homes])
    while at < len(homes):
        done = work[at - 1] if at else 0
        last = max(at + 1, int(np.searchsorted(work, done + PAIRS, "right")))
        some = homes[at:last]
        right = ragged(first[some], size[some])
        left = np.repeat(some, size[some])
        near = np.bitwise_count(fps[left] ^ fps[right]) <= distance
        near &= fps[left] != fps[right]
        if near.any():
            yield forest(fps[left[near]], fps[right[near]])
        at = last


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; a cell that a batch does not end is held until it does."""
    held = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)

    def linked(groups, fps, home) -> Iterator[pa.RecordBatch]:
        for a, b in compare(groups, fps, home, distance):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

    for batch in batches:
        cell, fps, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = cell, fps.view(np.uint64), home.astype(bool)
        cell, fps, home = (np.concatenate(x) for x in zip(held, new, strict=True))
        whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
        yield from linked(cell[:whole], fps[:whole], home[:whole])
        held = cell[whole:], fps[whole:], home[whole:]
    yield from linked(*held)


def near_fingerprints(fps: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) over the distinct values of ``fp`` that connect all within ``distance``.

    They connect what all links together would connect; copies of a link are left out.
    """
    placed = fps.mapInArrow(partial(_replicate, distance=distance), "anchor long, fp long, home boolean")
    crowded = (
        placed.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MOST_AT_ANCHOR)
    )
    crowded = stored(crowded, "crowded")
    cell = F.col("anchor")
    if not crowded.isEmpty():
        # A crowded anchor has parts x parts cells: homes of one part against all of another.
        parts = F.ceil(F.col("n") / MOST_AT_ANCHOR).cast("long")
        own = F.pmod(F.xxhash64("fp"), F.col("parts"))
        every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        spread = (
            placed.join(crowded.withColumn("parts", parts).drop("n"), "anchor", "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
            .withColumn("own", own)
        )
        as_home = spread.where("home").select(
            F.explode(F.transform(every, lambda k: F.xxhash64("anchor", "own", k))).alias("cell"),
            "fp",
            F.lit(True).alias("home"),
        )
        as_other = spread.select(
            F.explode(F.transform(every, lambda k: F.xxhash64("anchor", k, "own"))).alias("cell"),
            "fp",
            F.lit(False).alias("home"),
        )
        placed, cell = as_home.unionAll(as_other), F.col("cell")
    return (
        placed.select(cell.alias("cell"), "fp", "home")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(partial(_links, distance=distance), "a long, b long")
    )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 4,
    distance: int = 4,
) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Words are what stands between ASCII white space, A-Z lowered; fingerprints are linked if they
    differ in at most ``distance`` bits. component_id is the smallest id that links lead to, the row's
    own included. Whole texts are read. A text with fewer words than a shingle has one
    shingle; one without words, NULL too, has fingerprint 0. Rows with a NULL id are linked
    like others, and NULL is a component's id only if it has no other. No rows give no rows.
    """
    marked = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            partial(_fingerprints, shingle=shingle), with_id(docs, id_col, "fp long")
        ),
        "fingerprints",
    )
    # Copies share a fingerprint: from here on it stands for all of them.
    classes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = connected_components(near_fingerprints(classes.select("fp"), distance))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("n")
    )
    named = join_per_key(rooted, smallest, "root", "fp", rooted.count()).select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
