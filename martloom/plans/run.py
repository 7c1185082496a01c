"""Publishing marts: build, write, check, register; one mart's failure stops no other."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from martloom.contracts import check_contract, check_input
from martloom.operators.measures import Scale
from martloom.operators.sinks import (
    register_mart,
    release_run,
    remove_old_runs,
    report_path,
    write_mart,
    write_run,
)
from martloom.plans.marts import MARTS, PUBLISHABLE, SORT_KEYS
from martloom.settings import apply_settings
from martloom.sources.tables import read_table, table_path

Option = TypeVar("Option")

#: Marts that grow with the data: files sorted inside, without a shuffle for the order of all.
GROWING = ("lineitems", "lineitems_core")
#: For how long replaced runs stay if nothing else is said.
RETAIN_SECONDS = 3600.0


@dataclass(frozen=True)
class MartStatus:
    mart: str
    published: bool
    path: str
    table: str | None
    seconds: float
    error: str | None = None


def run_marts(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    *,
    marts: Sequence[str] = tuple(MARTS),
    suffix: str = ".parquet",
    load: Callable[[SparkSession, str, str], DataFrame] | None = None,
    database: str | None = None,
    register: bool = True,
    layout: str | None = None,
    scale: Scale | Mapping[str, Scale] = None,
    order: str | Mapping[str, str] | None = None,
    num_files: int | Mapping[str, int] | None = None,
    file_bytes: int | Mapping[str, int] | None = None,
    retain_seconds: float = RETAIN_SECONDS,
    shuffle_partitions: int | None = None,
    concurrent: int | None = None,
) -> list[MartStatus]:
    """Publish marts from the raw tables under ``in_dir`` and report on each.

    A mart's table is pointed to new files only after these were written and their schema
    equals the contract; a write that fails leaves the old files and table as they were.
    ``layout="runs"``, the default with a table, writes each run to a new folder under
    ``<mart>_report`` and points the table there; runs that it replaced are deleted by a later run,
    ``retain_seconds`` after they were replaced, so that readers can end. ``"flat"``, the default without
    a table, replaces the folder itself. Several publishers of one mart leave each other's work alone. The marts are independent: ``concurrent`` of them, by default
    all, run at the same time, so the tail of one leaves no executor idle. ``load``
    replaces the plain table reader.

    ``scale``, ``order``, ``num_files`` and ``file_bytes`` take one value or a mapping by mart.
    ``order`` is ``"file"`` for the line marts if not given, else ``"global"``. Files that are too many or
    not within half and double of ``file_bytes`` are merged after they were written, which keeps
    their order. ``num_files`` has to name a line mart to bound its files, since a bound that does not
    grow with the data makes ever larger files.

    Runs in a session of its own with the caller's settings, UTC, and the advice of
    ``martloom.settings`` where nothing else was set; ``shuffle_partitions`` is for the largest
    shuffle, AQE merges them for the small ones.
    """
    if unknown := set(marts) - set(PUBLISHABLE):
        raise ValueError(f"unknown marts {sorted(unknown)}; known are {sorted(PUBLISHABLE)}")
    if len(set(marts)) < len(marts):
        raise ValueError(f"a mart is named twice in {list(marts)}")
    if isinstance(num_files, int) and (growing := [m for m in marts if m in GROWING]):
        raise ValueError(
            f"{growing} grow with the data: give num_files by mart, as in {{'orders': {num_files}}}"
        )
    layout = layout or ("runs" if register else "flat")
    if layout not in ("runs", "flat"):
        raise ValueError(f"layout must be runs or flat, not {layout!r}")
    session = _session(spark, shuffle_partitions)
    tables = _open(session, marts, lambda name: _load(session, in_dir, name, suffix, load))

    def publish(mart: str) -> MartStatus:
        path, started = report_path(out_dir, mart), time.monotonic()
        served = f"{database}.{mart}" if database else mart
        error = None
        try:
            inputs = {n: check_input(_opened(tables[n]), n, mart) for n in PUBLISHABLE[mart].inputs}
            laid_out = _for_mart(order, mart) or ("file" if mart in GROWING else "global")
            built = PUBLISHABLE[mart](inputs, scale=_for_mart(scale, mart), order=laid_out)
            check_contract(built.schema, mart)
            options = {
                "num_files": _for_mart(num_files, mart),
                "file_bytes": _for_mart(file_bytes, mart),
                "sort": SORT_KEYS[mart] if laid_out == "file" else (),
                "inputs": [table_path(in_dir, name, suffix) for name in inputs],
            }
            if layout == "flat":
                write_mart(built, path, **options)
                if register:
                    register_mart(spark, mart, path, served)
            else:
                path = write_run(built, path, **options)
                try:
                    if register:
                        register_mart(spark, mart, path, served)  # the caller's, which may know the old
                finally:
                    # A run that could not be served is an old one to the next publisher.
                    release_run(session, path)
                remove_old_runs(
                    spark,
                    report_path(out_dir, mart),
                    path,
                    table=served if register else None,
                    retain=retain_seconds,
                )
        except Exception as failure:
            error = f"{type(failure).__name__}: {failure}"
        seconds = time.monotonic() - started
        published = error is None
        return MartStatus(
            mart, published, path, served if register and published else None, seconds, error
        )

    with ThreadPoolExecutor(max_workers=concurrent or max(1, len(marts))) as pool:
        return list(pool.map(inheritable_thread_target(session)(publish), marts))


def _session(spark: SparkSession, shuffle_partitions: int | None) -> SparkSession:
    """A session of the same application, so that settings for the marts stay with them."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    apply_settings(session, keep=spark.conf.getAll)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    if shuffle_partitions:
        session.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return session


def _load(session, in_dir, name, suffix, load) -> DataFrame:
    return load(session, in_dir, name) if load else read_table(session, in_dir, name, suffix)


def _open(
    session: SparkSession, marts: Sequence[str], load: Callable[[str], DataFrame]
) -> dict[str, DataFrame | Exception]:
    """Every table once, ahead of all marts; what goes wrong is kept for the marts that need it."""
    tables: dict[str, DataFrame | Exception] = {}
    for name in dict.fromkeys(n for m in marts for n in PUBLISHABLE[m].inputs):
        try:
            tables[name] = load(name)
        except Exception as failure:
            tables[name] = failure
    return tables


def _opened(table: DataFrame | Exception) -> DataFrame:
    if isinstance(table, Exception):
        raise table
    return table


def _for_mart(option: Option | Mapping[str, Option], mart: str) -> Option | None:
    """The mart's own value of an option that may be given by mart."""
    if isinstance(option, Mapping) and option.keys() <= PUBLISHABLE.keys():
        return option.get(mart)
    return option
