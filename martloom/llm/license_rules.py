"""Licence detection with ordered signature rules.

A rule is a hand-written regular expression over a text's lower-cased words, joined by single
spaces (``license_signatures``). It is tried only on texts that contain its keywords. Overlapping
detections are settled by interval containment and priority: one that lies inside another goes; of
two equal intervals, and of two that overlap in part, the one whose rule comes first stays.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import with_id
from martloom.llm.license_signatures import signatures

#: Phrases that are always looked for, and their labels. Fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

@dataclass(frozen=True)
class Rule:
    label: str
    #: Sets of words; a text needs all of one set.
    keywords: tuple[frozenset[bytes], ...]
    pattern: bytes
    certainty: float


def rules() -> list[Rule]:
    """All rules in the order of their priority, base phrases first."""
    base = [(label, 0.8, phrase.replace(" ", "+"), phrase) for phrase, label in BASE.items()]
    return [
        Rule(
            label,
            tuple(frozenset(k.split(b"+")) for k in keywords.encode().split(b"|")),
            f"(?<= )(?:{pattern})(?= )".encode(),
            certainty,
        )
        for label, certainty, keywords, pattern in [*base, *signatures()]
    ]


#: A-Z to a-z; ASCII letters, digits and all bytes of other characters stay; the rest is space.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Scan:
    n_words: int
    base_starts: tuple[int, ...]  # word numbers
    base_labels: tuple[str, ...]
    detections: tuple[tuple[int, int, str, float], ...]  # first word, words, label, certainty


def settle(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, rule) detections that are left once no two overlap.

    Those inside no other one are looked at by priority, and kept if they overlap none that was kept.
    What lay only inside a detection that had to go gets its turn then.
    """
    kept: list[tuple[int, int, int]] = []
    left = sorted(set(found), key=lambda x: (x[0], -x[1], x[2]))
    while left:
        outer = []
        for one in left:
            if not outer or one[1] > outer[-1][1]:
                outer.append(one)
        for one in sorted(outer, key=lambda x: (x[2], x[0])):
            at = bisect_left(kept, one)
            before, after = kept[at - 1 : at], kept[at : at + 1]
            if not (before and before[0][1] > one[0]) and not (after and after[0][0] < one[1]):
                kept.insert(at, one)
        gone = set(outer)
        left = [x for x in left if x not in gone and not _covered(kept, x)]
    return kept


def _covered(kept: list[tuple[int, int, int]], one: tuple[int, int, int]) -> bool:
    """Whether a detection overlaps any of those kept, which are in order and apart."""
    at = bisect_left(kept, (one[1],))
    return at > 0 and kept[at - 1][1] > one[0]


class Scanner:
    """The rules by keyword. A rule is compiled when a text first has its keywords."""

    def __init__(self) -> None:
        self.rules = rules()
        self.compiled: dict[int, re.Pattern[bytes]] = {}
        #: Of each set of keywords the longest word leads to the set and its rule.
        self.by_keyword: dict[bytes, list[tuple[frozenset[bytes], int]]] = {}
        for k, rule in enumerate(self.rules):
            for keywords in rule.keywords:
                first = max(keywords, key=lambda w: (len(w), w))
                self.by_keyword.setdefault(first, []).append((keywords, k))

    def gated(self, words: set[bytes]) -> set[int]:
        """The rules whose keywords are among a text's words."""
        return {
            k
            for w in self.by_keyword.keys() & words
            for keywords, k in self.by_keyword[w]
            if keywords <= words
        }

    def _detections(self, line: bytes, words: list[bytes]) -> list[tuple[int, int, int]]:
        found = []
        for k in self.gated(set(words)):
            if k not in self.compiled:
                self.compiled[k] = re.compile(self.rules[k].pattern)
            found += [(m.start(), m.end(), k) for m in self.compiled[k].finditer(line)]
        return settle(found)

    def scan(self, text: str) -> Scan:
        """Everything found in one text, all of which is read."""
        words = text.encode().translate(_WORDS).split()
        line = b" ".join([b"", *words, b""]) if words else b""
        base: list[tuple[int, str]] = []
        for phrase, label in BASE.items():
            wanted = f" {phrase} ".encode()
            at = line.find(wanted)
            while at >= 0:
                base.append((at, label))
                at = line.find(wanted, at + 1)
        found = self._detections(line, words)
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if base or found else ()

        def word(at: int) -> int:
            return int(np.searchsorted(gaps, at))

        spots = []
        for a, b, k in found:
            rule = self.rules[k]
            spots.append((word(a) - 1, word(b) - word(a) + 1, rule.label, rule.certainty))
        return Scan(
            len(words),
            tuple(sorted(word(at) for at, _ in base)),
            tuple(sorted({label for _, label in base})),
            tuple(spots),
        )


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spot = pa.struct(
        [
            ("first_word", pa.int64()),
            ("n_words", pa.int64()),
            ("label", pa.string()),
            ("certainty", pa.float64()),
        ]
    )
    scanner = Scanner()
    for batch in batches:
        found = [scanner.scan(x) for x in pc.fill_null(batch.column(1), "").to_pylist()]
        score = []
        for x in found:
            doubt = 1.0
            for *_, certainty in x.detections:
                doubt *= 1 - certainty
            score.append(1 - doubt)
        columns = [
            batch.column(0),
            pa.array([x.n_words for x in found], pa.int64()),
            pa.array([x.base_starts for x in found], pa.list_(pa.int64())),
            pa.array([x.base_labels for x in found], pa.list_(pa.string())),
            pa.array(
                [[dict(zip(spot.names, d, strict=True)) for d in x.detections] for x in found],
                pa.list_(spot),
            ),
            pa.array(score, pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, names=["id", "n_words", "base_starts", "base_labels", "detections", "score"]
        )


FOUND = (
    "n_words long, base_starts array<long>, base_labels array<string>, "
    "detections array<struct<first_word:long,n_words:long,label:string,certainty:double>>, "
    "score double"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, places of base phrases (word numbers from 0), detections and a score of every text.

    A detection has its first word, its number of words, label and certainty. The score is the
    chance that any detection is right, each taken with its rule's certainty; 0 without any. NULL and
    empty texts have no words and empty lists. Repeated rows give repeated results, NULL
    ids stay, no rows give no rows, and columns besides id and text are not looked at.
    """
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(
            _scan_batches,
            with_id(docs, id_col, FOUND),
        )
        .withColumnRenamed("id", id_col)
    )
