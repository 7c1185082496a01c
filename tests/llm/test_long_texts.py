"""Memory that one very long text adds, measured in a process of its own."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]

PROGRAM = """
import random, resource, sys
import numpy as np
import pyarrow as pa
from martloom.llm import bpe_automaton, importance_resampling, source_divergence, substring_sketch, toxicity_nnpu
from martloom.llm.chunk_encoder import ChunkEncoder, byte_bpe, word_bpe
from martloom.llm.common import byte_view

name, n = sys.argv[1], int(sys.argv[2])
r = random.Random(1)
words = ["".join(r.choice("etaoinshrdlucm") for _ in range(r.randrange(2, 9))) for _ in range(100_000)]
text = (" ".join(words) + " ") * 80


def batch(some, *names):
    columns = {"id": pa.array([1]), "lang": pa.array(["x"]), "source": pa.array(["y"]), "mark": pa.array([5])}
    columns |= {"text": pa.array([some]), "alone": pa.nulls(1, pa.list_(pa.int32()))}
    columns["doc"] = pa.StructArray.from_arrays([columns["id"]], ["id"])
    return iter([pa.RecordBatch.from_arrays([columns[x] for x in names], names=list(names))])


def encoded(some, vocabulary):
    yield ChunkEncoder(vocabulary).encode_bytes(*byte_view(pa.array([some])))


def windows(some):
    class Full:
        value = np.full((8, 3, (1 << substring_sketch.SEGMENT_BITS) // 8), 255, np.uint8)

    marks = substring_sketch.Sketch(Full)
    yield from substring_sketch._sketch(batch(some, "text"), 35, 8)
    yield from substring_sketch._suspects(batch(some, "id", "mark", "text"), 35, marks)
    yield from substring_sketch._removal(batch(some, "doc", "text", "alone"), 35, marks, True)


model = toxicity_nnpu.ToxicityModel(np.arange(100), np.ones(100), -1.0, 0.1)
gain = np.zeros(10_000, np.int64)
run = {
    "byte ids": lambda x: encoded(x, byte_bpe()),
    "word ids": lambda x: encoded(x, word_bpe()),
    "automaton": lambda x: bpe_automaton._encode(batch(x, "id", "text"), byte_bpe(), True),
    "windows": windows,
    "toxicity": lambda x: toxicity_nnpu._score(batch(x, "id", "text"), model),
    "weights": lambda x: importance_resampling._weights(
        batch(x, "id", "text"), importance_resampling.Features(), gain
    ),
    "terms": lambda x: source_divergence._terms(batch(x, "lang", "source", "text")),
}[name]
for _ in run("a b c " * 50):
    pass
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for _ in run(text[:n]):
    pass
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024)
"""


@pytest.mark.parametrize(
    "name", ["byte ids", "word ids", "automaton", "windows", "toxicity", "weights", "terms"]
)
def test_a_long_text_adds_a_bounded_multiple_of_itself(name):
    n = 40_000_000
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, name, str(n)], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    # The stretches' own arrays, and a few bytes for a byte of text: results, ids, their text.
    assert int(done.stdout) < 200_000_000 + 6 * n
