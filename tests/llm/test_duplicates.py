from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martloom.llm import components, simhash_anchors, substring_sketch
from martloom.llm.components import connected_components
from martloom.llm.simhash_anchors import (
    anchors,
    blocks,
    compare,
    forest,
    near_fingerprints,
    simhash_groups,
)
from martloom.llm.substring_sketch import remove_repeated_windows
from tests.llm.data import CLASHES, edge_docs, empty_docs, texts, words

WORD = re.compile("[^\x20\x09-\x0d]+")


def roots(n: int, edges) -> list[int]:
    parent = list(range(n))

    def find(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(a) for a in range(n)]


def simhash(text: str | None, shingle: int = 4) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = WORD.findall(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + shingle]) for k in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clustered(seed: int, n: int) -> np.ndarray:
    """Fingerprints of which many lie close together."""
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        x = r.choice(out)
        for _ in range(r.randrange(1, 6)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("distance", range(8))
def test_close_fingerprints_meet_at_a_home(distance):
    r = random.Random(distance)
    pairs = []
    for _ in range(300):
        x = y = r.getrandbits(64)
        for bit in r.sample(range(64), distance):
            y ^= 1 << bit
        pairs.append((x, y))
    fps = np.array([x for pair in pairs for x in pair], np.uint64)
    homes, all_ = {}, {}
    for anchor, number, home in anchors(fps, distance):
        for a, k, h in zip(anchor.tolist(), number.tolist(), home.tolist(), strict=True):
            all_.setdefault(k, set()).add(a)
            if h:
                homes.setdefault(k, set()).add(a)
    for k in range(0, len(fps), 2):
        assert homes[k] & all_[k + 1]
        assert homes[k + 1] & all_[k]
    assert all(len(h) == len(blocks(distance)) for h in homes.values())


def test_larger_distances_are_refused():
    with pytest.raises(ValueError, match="0 to 7"):
        blocks(8)


def test_forest_connects_the_same():
    r = np.random.default_rng(2)
    for _ in range(30):
        a, b = r.integers(0, 40, (2, 30))
        x, y = forest(a, b)
        both = zip(a.tolist(), b.tolist(), strict=True), zip(x.tolist(), y.tolist(), strict=True)
        assert roots(40, both[0]) == roots(40, both[1])
        assert len(x) <= 39


def test_comparing_in_small_steps_finds_the_same(monkeypatch):
    fps = clustered(1, 300)
    groups, home = np.sort(np.arange(len(fps)) % 3), np.ones(len(fps), bool)
    found = []
    for step in (1 << 20, 100):
        monkeypatch.setattr(simhash_anchors, "PAIRS", step)
        edges = [(int(a), int(b)) for x, y in compare(groups, fps, home, 4) for a, b in zip(x, y, strict=True)]
        place = {int(f): k for k, f in enumerate(fps)}
        found.append(roots(len(fps), [(place[a], place[b]) for a, b in edges]))
    assert found[0] == found[1]


@pytest.mark.parametrize("crowd", [20_000, 5])
def test_components_equal_brute_force_also_with_crowded_anchors(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash_anchors, "MOST_AT_ANCHOR", crowd)
    fps = clustered(7, 600)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = connected_components(near_fingerprints(table, 4)).collect()
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = roots(len(fps), [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b])
    place = {int(f): k for k, f in enumerate(fps.view(np.int64))}
    got = list(range(len(fps)))
    for r in found:
        got[place[r.node]] = place[r.root]
    groups = [
        sorted({k: [j for j in range(len(x)) if x[j] == x[k]] for k in range(len(x))}.values())
        for x in (want, got)
    ]
    assert groups[0] == groups[1]


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(90)]
    edges += [(k, k + 1) for k in range(200, 260)] + [(300, k) for k in range(301, 340)]
    table = spark.createDataFrame([*edges, (5, 5), *edges[:5], (None, 3)], "a long, b long")
    found = {r.node: r.root for r in connected_components(table).collect()}
    want = roots(400, edges)
    assert found == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert connected_components(table.limit(0)).count() == 0


def test_simhash_groups_of_edge_rows(spark):
    rows = simhash_groups(edge_docs(spark)).collect()
    some = texts()
    fps = [simhash(t) for _, t in some]
    edges = [
        (a, b)
        for a in range(len(some))
        for b in range(a)
        if bin(fps[a] ^ fps[b]).count("1") <= 4
    ]
    root = roots(len(some), edges)
    least = {
        r: min((i for k, (i, _) in enumerate(some) if root[k] == r and i is not None), default=None)
        for r in root
    }
    want = [(i, f"{fps[k]:016x}", least[root[k]]) for k, (i, _) in enumerate(some)]
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert simhash_groups(empty_docs(spark)).count() == 0


def without_repeats(some: list[str | None], window: int) -> list[tuple[str, int, int]]:
    found = [WORD.findall(t or "") for t in some]
    counts: dict[tuple, int] = {}
    for w in found:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            counts[key] = counts.get(key, 0) + 1
    out = []
    for w in found:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((kept, len(w), sum(gone)))
    return out


@pytest.fixture(params=["broadcast", "partitioned"])
def sketch(request, monkeypatch):
    """The sketch as a broadcast, or left where its segments were merged."""
    if request.param == "partitioned":
        monkeypatch.setattr(substring_sketch, "MOST_BROADCAST", 0)
        monkeypatch.setattr(substring_sketch, "sketch_segments", lambda docs: 8)
    return request.param


@pytest.fixture(params=["whole", "in stretches"])
def cut(request, monkeypatch):
    """Texts as they are, or gone through in stretches of some hundred bytes."""
    if request.param != "whole":
        monkeypatch.setattr(substring_sketch, "SLICE", 300)


def in_order(rows) -> list[tuple]:
    return sorted((r.doc.doc_id, r.kept, r.n_words, r.n_removed) for r in rows)


def test_repeated_windows_of_edge_rows(spark, sketch, cut):
    rows = remove_repeated_windows(edge_docs(spark)).collect()
    some = texts()
    want = [(i, *x) for (i, _), x in zip(some, without_repeats([t for _, t in some], 35), strict=True)]
    found = [(r.doc.doc_id, r.kept, r.n_words, r.n_removed) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert all(r.doc[c] == "c" for r in rows for c in CLASHES)
    assert remove_repeated_windows(empty_docs(spark)).count() == 0


@pytest.mark.parametrize(("seed", "vocabulary", "window"), [(0, 2, 5), (1, 3, 9), (2, 8, 4), (3, 2, 12)])
def test_repeated_windows_of_very_repetitive_texts(spark, sketch, cut, seed, vocabulary, window):
    r = random.Random(seed)
    some = [words(r.random(), r.randrange(200), vocabulary) for _ in range(60)]
    some += [" ".join(["x"] * 50), " ".join(["p", "q"] * 130), " ".join(["p", "q", "r"] * 9)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(5)
    rows = remove_repeated_windows(docs, window=window).collect()
    assert in_order(rows) == [(i, *x) for i, x in enumerate(without_repeats(some, window))]


def test_a_full_sketch_loses_nothing(spark, sketch, monkeypatch):
    """With far too few cells nearly all windows are suspects, and the result is the same."""
    monkeypatch.setattr(
        substring_sketch, "cells", lambda a: ((a & np.uint64(1)).astype(np.int64) for _ in range(3))
    )
    some = [words(k % 50, 80) for k in range(70)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    rows = remove_repeated_windows(docs).collect()
    assert in_order(rows) == [(i, *x) for i, x in enumerate(without_repeats(some, 35))]


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join((a, b)[k.bit_count() & 1] for k in range(n))


def test_words_with_one_polynomial_hash_are_different_words(spark, sketch):
    base = words(1, 34).split()
    some = [
        " ".join([*base[:k], thue_morse(n, *letters), *base[k:]])
        for n in (1024, 2048)
        for k in (0, 17, 34)
        for letters in ("ab", "ba")
    ]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(3)
    want = [(i, *x) for i, x in enumerate(without_repeats(some, 35))]
    assert in_order(remove_repeated_windows(docs).collect()) == want
    assert all(n == 0 for *_, n in want)


def test_kept_words_may_keep_their_white_space(spark, cut):
    passage = "\n".join(words(5, 60).split())
    some = [
        f"  first line\n\n\tindented  twice\n{passage}\n\nafter\tit \n",
        f"{words(6, 40)}\n\n{passage}",
        f"{passage}  ",
        " nothing \n repeated ",
        "",
        words(7, 90).replace(" ", "\n\n") + f" {passage} " + words(8, 90).replace(" ", "   "),
    ]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(2)
    rows = sorted(remove_repeated_windows(docs, keep_space=True).collect(), key=lambda r: r.doc.doc_id)
    plain = without_repeats(some, 35)
    for r, text, (kept, n_words, n_removed) in zip(rows, some, plain, strict=True):
        assert (" ".join(r.kept.split()), r.n_words, r.n_removed) == (kept, n_words, n_removed)
    assert [r.kept for r in rows][:5] == [
        "first line\n\n\tindented  twice\nafter\tit \n",
        words(6, 40),
        "",
        "nothing \n repeated ",
        "",
    ]
    assert rows[5].kept == words(7, 90).replace(" ", "\n\n") + " " + words(8, 90).replace(" ", "   ")


def passed(spark, monkeypatch, n: int) -> float:
    """The share of windows that stand alone and are suspects all the same."""
    some = [words(k, 120, 100_000) for k in range(n)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(4)
    seen = []
    store = substring_sketch.stored

    def counted(df, name):
        out = store(df, name)
        if name == "lone-windows":
            seen.append(out.selectExpr("sum(size(alone)) AS n").first().n or 0)
        return out

    monkeypatch.setattr(substring_sketch, "stored", counted)
    remove_repeated_windows(docs).count()
    monkeypatch.setattr(substring_sketch, "stored", store)
    return seen[0] / (n * (120 - 34))


def test_lone_windows_pass_as_rarely_beyond_the_broadcast(spark, monkeypatch):
    """With segments of 256 cells, of which two may be broadcast, both sizes are far beyond."""
    monkeypatch.setattr(substring_sketch, "MOST_BROADCAST", 2)
    monkeypatch.setattr(substring_sketch, "SEGMENT_BITS", 8)
    small, large = (passed(spark, monkeypatch, n) for n in (300, 1200))
    assert small < 0.05 and large < 0.05


def test_hubs_are_split(spark, monkeypatch):
    """One node has a third of all edges; no task of the join gets many of them, with broadcasts off."""
    n = 3000
    edges = [(0, k) for k in range(1, n)] + [(10_000 + k, 10_001 + k) for k in range(0, 2 * n, 2)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(8)
    monkeypatch.setattr(components, "LEAST_ROWS", 50)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        least = table.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        joined = components.join_per_key(table, least, "a", "b", len(edges))
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        assert sum(r.n for r in tasks) == len(edges)
        assert max(r.n for r in tasks) < n / 3  # the hub has n
        want = {a: min(y for x, y in edges if x == a) for a in (0, 10_000, 10_002)}
        some = joined.where(F.col("a").isin(list(want))).select("a", "m").distinct().collect()
        assert {r.a: r.m for r in some} == want
        found = {r.node: r.root for r in connected_components(table).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {found[k] for k in range(n)} == {0}
    assert all(found[10_000 + k] == 10_000 + k - k % 2 for k in range(2 * n))


def test_one_component_may_hold_a_third_of_all_fingerprints(spark):
    """A chain of fingerprints a bit apart, among others that are far from everything."""
    r = np.random.default_rng(3)
    chain, at = [], r.integers(0, 1 << 62)
    for k in range(400):
        chain.append(int(at))
        at ^= 1 << int(r.integers(0, 62))
    others = [int(x) for x in r.integers(0, 1 << 62, 800)]
    table = spark.createDataFrame([(x,) for x in chain + others], "fp long").distinct()
    found = {x.node: x.root for x in connected_components(near_fingerprints(table, 1)).collect()}
    assert len({found[x] for x in chain}) == 1
