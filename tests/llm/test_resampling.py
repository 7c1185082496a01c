from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from martloom.llm import importance_resampling, source_divergence
from martloom.llm.common import word_slices
from martloom.llm.importance_resampling import WORD, Features, Slots, resample
from martloom.llm.source_divergence import audit_sources
from martloom.llm.spans import SpanTable, hash_spans, lanes, same_spans
from tests.llm.data import CLASHES, edge_docs, empty_docs, texts, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spans_of(seed: int, longest: int):
    r = np.random.default_rng(seed)
    data = r.integers(97, 100, 4000).astype(np.uint8)
    lengths = r.integers(0, longest, 2500)
    return data, r.integers(0, 4000 - longest, 2500), lengths


@pytest.mark.parametrize("seed", [0, 42])
def test_spans_have_the_hashes_of_the_library(seed):
    data, begins, lengths = spans_of(seed, 90)
    found = hash_spans(data, lanes(data), begins, lengths, seed)
    for k, h in enumerate(found.tolist()):
        raw = data[begins[k] : begins[k] + lengths[k]].tobytes()
        assert h == xxhash.xxh64_intdigest(raw, seed)


def test_spans_are_compared_to_their_last_byte():
    data, begins, lengths = spans_of(1, 90)
    for change in range(90):
        other = data.copy()
        at = begins + change
        other[at] ^= 1
        whole, changed = (data, lanes(data)), (other, lanes(other))
        same = same_spans(whole, begins, changed, begins, lengths)
        assert same.tolist() == [
            data[a : a + n].tobytes() == other[a : a + n].tobytes()
            for a, n in zip(begins.tolist(), lengths.tolist(), strict=True)
        ]


class Colliding(SpanTable):
    def _hashes(self, lane):
        return super()._hashes(lane) & np.uint64(3)


@pytest.mark.parametrize("kind", [SpanTable, Colliding])
def test_spans_with_one_hash_are_told_apart(kind):
    data, begins, lengths = spans_of(2, 7)
    table = kind(data, begins, lengths)
    values = list(table.values())
    raw = [data[a : a + n].tobytes() for a, n in zip(begins.tolist(), lengths.tolist(), strict=True)]
    assert sorted(values) == sorted(set(raw))
    assert [values[k] for k in table.found.tolist()] == raw
    joined, edges = table.joined()
    assert [joined[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)] == values


@pytest.mark.parametrize("carry", [0, 1, 3])
@pytest.mark.parametrize("most", [7, 40, 1000])
def test_words_of_long_texts_come_once_but_for_those_carried(carry, most):
    long = [words(1, 300), "x" * 200 + " " + words(2, 20), "", "  ", "one", words(3, 90) + "  "]
    raw = np.frombuffer("".join(long).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, long)])
    found = defaultdict(list)
    for first, some, seen in word_slices(raw, starts, WORD, carry, most):
        for k in range(len(some) - 1):
            here = raw[some[k] : some[k + 1]].tobytes().decode().split()
            before = found[first + k]
            assert not seen or before[-seen:] == here[:seen]
            before += here[seen:]
    assert [found[k] for k in range(len(long))] == [x.split() for x in long]


def features(text, longest=2):
    found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    runs = [
        " ".join(found[i : i + n])
        for n in range(1, longest + 1)
        for i in range(len(found) - n + 1)
    ]
    return len(found), runs


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute_resample(rows, target, percent, least, seed, longest, buckets):
    held, wanted = (
        Counter(bucket(f, buckets) for t in some for f in features(t, longest)[1])
        for some in ([t for _, t in rows], target)
    )
    all_s, all_t = sum(held.values()), sum(wanted.values())

    def gain(b):
        ratio = (wanted[b] + 1) * (all_s + buckets) / ((held[b] + 1) * (all_t + buckets))
        return math.floor(1000 * math.log(ratio))

    out = []
    for i, text in rows:
        n, runs = features(text, longest)
        weight = sum(gain(bucket(f, buckets)) for f in runs) // max(1, len(runs))
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, n, len(runs), weight, weight + noise))
    some = [r for r in out if r[1] >= least]
    some.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = some[: percent * len(some) // 100]
    ranked = [(r[0], *r[2:], k) for k, r in enumerate(drawn, 1)]
    for r in drawn:
        out.remove(r)
    return ranked + [(r[0], *r[2:], None) for r in out]


@pytest.mark.parametrize(
    ("percent", "least", "longest", "buckets"), [(25, 20, 2, 10_000), (100, 0, 3, 50), (60, 1, 1, 997)]
)
def test_draws_as_brute_force_does(spark, monkeypatch, percent, least, longest, buckets):
    cut = importance_resampling.word_slices
    monkeypatch.setattr(
        importance_resampling, "word_slices", lambda *a: cut(*a, most=5000)
    )
    target = [words(3, 50), words(9, 300), "The THE", None, ""]
    docs = edge_docs(spark)
    docs = docs.unionAll(docs.where("doc_id = 3")).unionAll(docs.where("doc_id = 3"))
    found = resample(
        docs,
        spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string"),
        percent=percent,
        least_words=least,
        features=Features(longest, buckets),
    )
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = texts() + [t for t in texts() if t[0] == 3] * 2
    want = brute_resample(rows, target, percent, least, 7, longest, buckets)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_hot_rows_get_every_rank_once(spark):
    """A third of the rows are alike; their ranks still come from many tasks."""
    docs = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "repeat('one two three ', 10) AS text"
    )
    empty = spark.createDataFrame([], "text string")
    found = resample(docs, empty, percent=100).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 3001))
    by_rank = sorted(found, key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in by_rank] == sorted((-r.score, r.doc_id) for r in found)


def test_slots_hold_buckets_and_counts():
    text = b"a b a b c A"
    slots = Slots(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 0, Features(2, 1000))
    want = Counter(bucket(f, 1000) for f in features(text.decode())[1])
    assert {k: n for k, n in enumerate(slots.by_bucket(1000).tolist()) if n} == want
    assert slots.count.sum() == len(slots.slot) == 11
    assert len(slots.count) == len(set(features(text.decode())[1]))


def test_nothing_to_draw_from(spark):
    empty = spark.createDataFrame([], "text string")
    assert resample(empty_docs(spark), empty).collect() == []


def brute_audit(rows, least=3, most=200):
    found = [
        (lang or "", source or "", Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER))))
        for lang, source, t in rows
    ]
    out = []
    for lang in {x[0] for x in found}:
        own = [x for x in found if x[0] == lang]
        frequency = Counter(t for _, _, c in own for t in c)
        kept = [t for t, n in frequency.items() if n >= least]
        sources = {x[1] for x in own}
        counts = {s: Counter() for s in sources}
        for _, s, c in own:
            counts[s] += c
        counts[None] = sum((c for _, _, c in own), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}

        def share(s, t):
            return 1 + 10**9 * (counts[s][t] + 1) // (total[s] + len(kept))

        def f(p, q):
            return (p - q) ** 2 // q

        for s in sources:
            pairs = [
                (-sum(f(share(s, t), share(o, t)) for t in kept), o) for o in sources if o != s
            ]
            terms = [
                (-f(share(s, t), share(None, t)), t)
                for t in kept
                if counts[s][t] and share(s, t) > share(None, t)
            ]
            for part, items, limit in (("pair", pairs, None), ("term", terms, most)):
                items.sort(key=lambda x: (x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items[:limit], 1):
                    out.append((lang, s, part, item, -value, rank))
    return sorted(out)


def sourced(seed: int = 5):
    r = np.random.default_rng(seed)
    rows = [
        (("en", "de", None)[k % 3], f"s{k % 11}", words(k % 40, int(r.integers(1, 60)), 60).replace("0", "é"))
        for k in range(300)
    ]
    hot = [("en", "s1", "same Words here " * 3)] * 100
    edges = [
        ("en", "none", None), ("en", None, ""), ("", "", "alone"), ("xx", "a", "rare"), ("xx", "b", "1 2"),
        ("de", "s1", words(1, 3000, 50)), ("yy", "only", "one one one"),
    ]
    return rows + hot + edges


SOURCED = "lang string, source string, text string"


@pytest.mark.parametrize("most", [200, 7])
@pytest.mark.parametrize("block", [32, 2])
def test_audits_as_brute_force_does(spark, monkeypatch, most, block):
    monkeypatch.setattr(source_divergence, "BLOCK", block)
    monkeypatch.setattr(source_divergence, "PART_TERMS", 20)
    monkeypatch.setattr(source_divergence, "_TOGETHER", 4000)
    rows = sourced()
    docs = spark.createDataFrame(rows, SOURCED).repartition(5)
    for c in CLASHES:
        docs = docs.selectExpr("*", f"'x' AS {c}")
    found = audit_sources(docs, most_terms=most).collect()
    assert sorted(map(tuple, found)) == brute_audit(rows, most=most)


def test_audit_of_edge_documents(spark):
    rows = [(r.lang, r.source, r.text) for r in edge_docs(spark).collect()]
    assert sorted(map(tuple, audit_sources(edge_docs(spark), least_docs=2).collect())) == brute_audit(
        rows, 2
    )
    assert audit_sources(empty_docs(spark)).collect() == []
