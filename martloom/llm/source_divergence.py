"""How the sources of a language differ from it and from each other, term by term.

Terms are counted for each (lang, source) group; a language keeps those that enough of its
documents have. Shares of kept terms, smoothed and in billionths, are whole numbers, and so is the
divergence f of one share from another: all arithmetic is exact.

f depends on two counts only, so it is evaluated for *cells* of terms with equal counts. For a
group's terms the cells are (count in the group, count in the language): cells of equal f are
merged, cumulative multiplicities say which of them reach the wanted ranks, and only those are
expanded into terms. For two sources the cells are (count in one, count in the other). Sources
are dealt into blocks and terms into parts; a task gets one part for two blocks, as a table of counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import byte_view, lower_ascii, ragged, runs, stored, word_slices
from martloom.llm.spans import SpanTable

SHARE = 1_000_000_000
#: Sources in a block, and terms of a part: a task's table has so many columns twice and so many rows.
BLOCK = 32
PART_TERMS = 20_000
#: Bytes of texts whose terms are counted together.
_TOGETHER = 1 << 22
#: Bytes of terms once A-Z are lowered: letters and all of other characters; and before that.
TERM = np.zeros(256, bool)
TERM[97:123] = TERM[128:] = True
_ANY_TERM = TERM.copy()
_ANY_TERM[65:91] = True


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences and documents: a row for each term of a group in some texts."""
    for batch in batches:
        langs, sources = (batch.column(k).dictionary_encode() for k in range(2))
        n_sources = max(1, len(sources.dictionary))
        code = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
        data, starts = byte_view(batch.column(2))
        # Documents of the rows at hand for each term of a long text: it counts once.
        long_terms: dict[int, set[bytes]] = {}
        for first, some, _ in word_slices(data, starts, _ANY_TERM, 0, _TOGETHER):
            a = int(some[0])
            lowered = lower_ascii(data[a : int(some[-1])])
            begins, ends = runs(TERM[lowered], some - a)
            if not len(begins):
                continue
            row = first + np.searchsorted(some - a, begins, "right") - 1
            table = SpanTable(lowered, begins, ends - begins)
            n = len(table)
            # Occurrences of a term in a row, then rows of a term in a group.
            in_row, times = np.unique(row * n + table.found, return_counts=True)
            owner, term = code[in_row // n], in_row % n
            fresh = np.ones(len(in_row), np.int64)
            if len(some) == 2 and int(some[1]) - a < starts[first + 1] - starts[first]:
                known = long_terms.setdefault(first, set())
                values = list(table.values())
                for k, t in enumerate(term.tolist()):
                    fresh[k] = values[t] not in known
                    known.add(values[t])
            cell, place = np.unique(owner * n + term, return_inverse=True)
            occurrences = np.bincount(place, times).astype(np.int64)
            documents = np.bincount(place, fresh).astype(np.int64)
            joined, edges = table.joined()
            lengths = np.diff(edges)[cell % n]
            raw = joined[ragged(edges[cell % n], lengths)]
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            spelt = pa.Array.from_buffers(
                pa.large_string(), len(cell), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
            )
            owner = cell // n
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(owner // n_sources)),
                    sources.dictionary.take(pa.array(owner % n_sources)),
                    spelt.cast(pa.string()),
                    pa.array(occurrences),
                    pa.array(documents),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it); added up ahead of the shuffle."""
    return (
        docs.select("lang", "source", "text")
        .mapInArrow(_terms, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), exactly; NULL where nothing is kept."""
    wide = (count + 1).cast("decimal(28,0)") * F.lit(SHARE).cast("decimal(10,0)")
    whole = F.call_function("div", wide, F.nullif(total + kept, F.lit(0)).cast("decimal(28,0)"))
    return whole + 1


def _divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q): shares are 10^9 + 1 at most, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    return np.array([1 + SHARE * (c + 1) // (total + kept) for c in counts.tolist()], np.int64)


def _paired(key: tuple, table: pa.Table) -> pa.Table:
    """Every pair of a source of one block and another of the other, with the sum of f over a part's
    terms; the terms that neither block has count in part 0."""
    lang, one, two, part = (k.as_py() for k in key)
    heads = table.filter(pc.is_valid(table["number"])).select(list(_HEAD)).to_pylist()
    heads.sort(key=lambda r: r["number"])
    kept = heads[0]["kept"]
    rows = table.filter(pc.is_valid(table["term"]))
    terms = rows["term"].combine_chunks().dictionary_encode()
    lists = rows["counts"].combine_chunks()
    held = lists.flatten()
    column = np.searchsorted([r["number"] for r in heads], held.field("number").to_numpy())
    row = np.repeat(terms.indices.to_numpy(), lists.value_lengths().to_numpy())
    counts = np.zeros((len(heads), len(terms.dictionary)), np.int64)
    counts[column, row] = held.field("n").to_numpy()
    n_terms = counts.shape[1]
    missing = (kept if part == 0 else 0) - n_terms
    # Counts of a source as numbers of its distinct values, and the share of each.
    values, codes, shares = [], [], []
    for k, r in enumerate(heads):
        some, code = np.unique(np.append(counts[k], 0), return_inverse=True)
        values.append(some)
        codes.append(code[:-1])
        shares.append(_shares(some, r["total"], kept) if kept else np.zeros(len(some), np.int64))
    out: list[tuple[str, str, int]] = []

    def value(a: int, b: int) -> int:
        if not kept:
            return 0
        cell, times = np.unique(codes[a] * len(values[b]) + codes[b], return_counts=True)
        p, q = shares[a][cell // len(values[b])], shares[b][cell % len(values[b])]
        f = (p - q) ** 2 // q
        # The two halves of a long, so that no sum of up to 2**31 of them overflows.
        low, high = f & 0xFFFFFFFF, f >> 32
        p0, q0 = int(shares[a][0]), int(shares[b][0])
        both = (p0 - q0) ** 2 // q0
        return (int((high * times).sum()) << 32) + int((low * times).sum()) + missing * both

    for a, x in enumerate(heads):
        for b, y in enumerate(heads):
            blocks = x["number"] // BLOCK, y["number"] // BLOCK
            if a != b and blocks in ((one, two), (two, one)):
                out.append((x["source"], y["source"], value(a, b)))
    sources, items, sums = ([r[k] for r in out] for k in range(3))
    return pa.table(
        {
            "lang": pa.array([lang] * len(out), pa.string()),
            "source": pa.array(sources, pa.string()),
            "item": pa.array(items, pa.string()),
            "value": pa.array([str(x) for x in sums], pa.string()),
        }
    )


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item and value for every ordered pair of sources of a language.

    ``groups``: lang, source, total, kept; ``kept``: lang, source, term, n. A row for a term and a
    block of sources, and one for each source, goes to every pair of blocks that its block is in.
    """
    of_lang = Window.partitionBy("lang")
    numbered = (
        groups.withColumn("number", F.row_number().over(of_lang.orderBy("source")) - 1)
        .withColumn("parts", F.ceil(F.greatest("kept", F.lit(1)) / PART_TERMS).cast("long"))
        .withColumn("block", F.expr(f"number div {BLOCK}"))
        .withColumn("blocks", F.max("block").over(of_lang) + 1)
    )
    numbered = stored(numbered, "numbered")
    place = ["lang", "block", "blocks"]
    by_block = (
        kept.join(numbered.select(*place, "source", "number", "parts"), ["lang", "source"])
        .groupBy(*place, "term", "parts")
        .agg(F.collect_list(F.struct("number", "n")).alias("counts"))  # BLOCK entries at most
        .select(*place, F.pmod(F.xxhash64("term"), "parts").alias("part"), "term", "counts")
    )
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    heads = numbered.select(
        *place, every_part.alias("part"), *(F.col(c).cast(t).alias(c) for c, t in _HEAD.items())
    )
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = (
        by_block.unionByName(heads, allowMissingColumns=True)
        .withColumn("other", every_block)
        .withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
        .select("lang", "one", "two", "part", "term", "counts", *_HEAD)
    )
    summed = paired.groupBy("lang", "one", "two", "part").applyInArrow(
        _paired, "lang string, source string, item string, value string"
    )
    return summed.groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(28,0)")).cast("long").alias("value")
    )


_HEAD = {"number": "long", "source": "string", "total": "long", "kept": "long"}


def _term_ranks(kept: DataFrame, groups: DataFrame, langs: DataFrame, most: int) -> DataFrame:
    """The first ``most`` terms of each group that are more frequent in it than in its language."""
    with_cell = kept.select("lang", "source", "term", "n", "lang_n")
    cells = with_cell.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms"))
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    rated = (
        cells.join(groups, ["lang", "source"])
        .join(langs.select("lang", "lang_total"), "lang")
        .withColumns({"p": p, "q": q})
        .where("p > q")
        .withColumn("value", _divergence(F.col("p"), F.col("q")))
        .select("lang", "source", "n", "lang_n", "terms", "value")
    )
    rated = stored(rated, "cells")
    # Cells of equal value are one; at most ``most`` values can reach the wanted ranks.
    down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    merged = (
        rated.groupBy("lang", "source", "value")
        .agg(F.sum("terms").alias("terms"))
        .withColumn("place", F.row_number().over(down))
        .where(F.col("place") <= most)
    )
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    reached = merged.withColumn("ahead", F.coalesce(F.sum("terms").over(before), F.lit(0))).where(
        F.col("ahead") < most
    )
    chosen = rated.join(reached.select("lang", "source", "value", "ahead"), ["lang", "source", "value"])
    chosen = stored(chosen.select("lang", "source", "n", "lang_n", "value", "ahead"), "chosen")
    expanded = with_cell.join(chosen, ["lang", "source", "n", "lang_n"])
    spelt = Window.partitionBy("lang", "source", "value", "ahead").orderBy("term")
    return (
        expanded.withColumn("place", F.row_number().over(spelt))
        .where(F.col("place") <= most)  # what one value can add; kept by each task before the shuffle
        .withColumn("rank", F.col("ahead") + F.col("place"))
        .where(F.col("rank") <= most)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def audit_sources(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    *,
    least_docs: int = 3,
    most_terms: int = 200,
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` ranks the other sources of the language by their divergence from the source, all of
    them; part ``term`` the terms that the source has more of than its language, up to
    ``most_terms``. Ranks go by value, descending, then by the item's UTF-8 bytes. Whole texts are
    read, A-Z lowered; each row is a document of its own, repeated rows too. NULL text, lang and
    source are empty strings; a group without terms is compared like any other, and if a language
    keeps no term its pairs have value 0. No rows give no rows; other columns are not looked at.
    """
    rows = docs.select(
        *(
            F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        )
    )
    counts = stored(term_counts(rows), "terms")
    in_lang = (
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_docs)
    )
    kept = stored(
        counts.join(in_lang.select("lang", "term", "lang_n"), ["lang", "term"]).select(
            "lang", "source", "term", "n", "lang_n"
        ),
        "kept",
    )
    langs = in_lang.groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")
    )
    langs = stored(langs, "langs")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs.select("lang", "kept"), "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("kept", F.lit(0)).alias("kept"),
        ),
        "groups",
    )
    down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pairs = _pairs(groups, kept.select("lang", "source", "term", "n")).select(
        "lang",
        "source",
        F.lit("pair").alias("part"),
        "item",
        "value",
        F.row_number().over(down).alias("rank"),
    )
    terms = _term_ranks(kept, groups, langs, most_terms)
    return pairs.unionByName(terms.withColumn("rank", F.col("rank").cast("int")))
