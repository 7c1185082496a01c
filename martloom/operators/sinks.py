"""Publishing a mart: write its parquet files, then serve them as a table.

What was published before stays whole until the new files are complete, and can be had back until
they are in its place: a write or a move that fails leaves it as it was.
"""

from __future__ import annotations

import atexit
import posixpath
import shutil
import tempfile
import threading
import time
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import urlsplit

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.contracts import CONTRACTS, ContractError, schema_issues


#: Begins the names of run folders.
RUN = "run-"
#: Folders beside the runs, with a small file for each run that is being published or was replaced.
PUBLISHING, SUPERSEDED = "_publishing", "_superseded"
#: Seconds after which a publisher that has said nothing more is taken for dead: in the
#: middle of a swap, and with a run not yet served.
SWAP_SECONDS, LEASE_SECONDS = 600.0, 86_400.0


_CREATING = threading.Lock()


class PublishError(OSError):
    """A folder could not be replaced; the message says where old and new files are."""


def report_path(out_dir: str, mart: str) -> str:
    return f"{out_dir.rstrip('/')}/{mart}_report"


def write_mart(
    df: DataFrame,
    path: str,
    *,
    num_files: int | None = None,
    file_bytes: int | None = None,
    sort: Sequence[str] = (),
    inputs: Iterable[str] = (),
) -> None:
    """Replace the parquet directory ``path`` with the mart.

    The files are written beside the target. Then the old folder is moved aside, the new one to its
    place, and the old one is deleted; if the second move fails, the old folder goes back. A
    journal beside the target says what is being moved: publishers of one target swap one after
    another, and ``recover_mart`` puts right what a publisher that died in between has left, which
    the next publisher does by itself after ``SWAP_SECONDS``.

    ``num_files`` or ``file_bytes`` bound the number of files or say how large they should be. The
    last stage of the mart stays as wide as it is; its files are merged afterwards, in their order, or
    sorted by ``sort`` inside each. ``inputs`` are paths that must not overlap the target. Where a
    move copies (object stores), use ``write_run``.
    """
    spark = df.sparkSession
    _refuse_overlap(spark, path, inputs)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        _write(df, staging, num_files, file_bytes, sort)
        _swap(spark, staging, path)
    except PublishError:
        raise  # The journal knows both folders.
    except BaseException:
        remove(spark, staging)
        raise
    spark.catalog.refreshByPath(path)


def _swap(spark: SparkSession, staging: str, path: str) -> None:
    files, target = _files(spark, path)
    previous = f"{path.rstrip('/')}.previous-{uuid.uuid4().hex}"
    aside, new = _files(spark, previous)[1], _files(spark, staging)[1]
    _begin_swap(spark, path, previous, staging)
    try:
        if files.exists(target):
            _move(files, target, aside)
        try:
            _move(files, new, target)
        except BaseException:
            try:
                if files.exists(aside) and not files.exists(target):
                    _move(files, aside, target)
            except Exception as worse:
                raise PublishError(
                    f"could not replace {path}: what was there is in {previous}, the new files in {staging}"
                ) from worse
            raise
    except PublishError:
        raise
    except BaseException:
        _end_swap(spark, path)
        raise
    try:
        files.delete(aside, True)
    finally:
        _end_swap(spark, path)


def _move(files: JavaObject, source: JavaObject, target: JavaObject) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not move {source.toString()} to {target.toString()}")


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}.swap"


def _begin_swap(spark: SparkSession, path: str, previous: str, staging: str) -> None:
    """Write the journal; while another publisher's is there (FileAlreadyExists,
    AlreadyBeingCreated), wait for it to end its swap."""
    files, journal = _files(spark, _journal(path))
    while True:
        try:
            # A local file system looks and creates in two steps; others do it in one.
            with _CREATING:
                out = files.create(journal, False)
        except Py4JJavaError as failure:
            if "Already" not in failure.java_exception.getClass().getSimpleName():
                raise
            if _age(files, journal) > SWAP_SECONDS:
                recover_mart(spark, path)
            else:
                time.sleep(0.2)
            continue
        out.write(f"{previous}\n{staging}\n".encode())
        out.close()
        return


def _end_swap(spark: SparkSession, path: str) -> None:
    files, journal = _files(spark, _journal(path))
    files.delete(journal, False)


def recover_mart(spark: SparkSession, path: str) -> bool:
    """Put right a swap of ``path`` that was broken off; whether there was one.

    Without new files in its place the old folder goes back, else it is deleted. To be called
    when no publisher of this target is running.
    """
    files, journal = _files(spark, _journal(path))
    if not files.exists(journal):
        return False
    text = spark.read.text(journal.toString(), wholetext=True).first()
    names = text.value.split("\n") if text else []
    if len(names) == 3:  # else the publisher died before it moved anything
        target = _files(spark, path)[1]
        aside, staging = (_files(spark, n)[1] for n in names[:2])
        if files.exists(aside):
            if files.exists(target):
                files.delete(aside, True)
            else:
                _move(files, aside, target)
        files.delete(staging, True)
    files.delete(journal, False)
    spark.catalog.refreshByPath(path)
    return True


def break_off_swap(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Do what a publisher of ``df`` has done that dies between its two moves: a rehearsal."""
    staging, previous = (f"{path.rstrip('/')}.{x}-{uuid.uuid4().hex}" for x in ("staging", "previous"))
    df.write.parquet(staging)
    _begin_swap(spark, path, previous, staging)
    files, target = _files(spark, path)
    _move(files, target, _files(spark, previous)[1])


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the data files of a parquet folder."""
    files, folder = _files(spark, path)
    return [s.getLen() for s in _listed(files, folder) if s.getPath().getName().startswith("part-")]


def _age(files: JavaObject, path: JavaObject) -> float:
    """Seconds since a file was written; 0 if it has gone meanwhile."""
    try:
        return time.time() - files.getFileStatus(path).getModificationTime() / 1000
    except Py4JJavaError:
        return 0.0


def write_run(
    df: DataFrame,
    path: str,
    *,
    num_files: int | None = None,
    file_bytes: int | None = None,
    sort: Sequence[str] = (),
    inputs: Iterable[str] = (),
) -> str:
    """Write the mart to a new folder under ``path`` and return it; older runs stay.

    Nothing is moved or deleted, so it suits object stores. The run is leased to its publisher until
    ``release_run``, at most ``LEASE_SECONDS``: meanwhile no other publisher's ``remove_old_runs`` takes
    it for an old one. ``num_files``, ``file_bytes`` and ``sort`` are those of ``write_mart``.
    """
    spark = df.sparkSession
    _refuse_overlap(spark, path, inputs)
    name = f"{RUN}{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{name}"
    _touch(spark, f"{path.rstrip('/')}/{PUBLISHING}/{name}")
    try:
        _write(df, target, num_files, file_bytes, sort)
    except BaseException:
        remove(spark, target)
        release_run(spark, target)
        raise
    return target


def release_run(spark: SparkSession, run: str) -> None:
    """The run is served, or given up: its publisher needs it no longer."""
    base, name = posixpath.split(run.rstrip("/"))
    remove(spark, f"{base}/{PUBLISHING}/{name}")


def remove_old_runs(
    spark: SparkSession, path: str, keep: str, *, table: str | None = None, retain: float = 0.0
) -> None:
    """Delete runs under ``path`` that ``keep`` has replaced, ``retain`` seconds after that.

    Runs that other publishers are still at stay. If ``table`` points to another run by now, a later
    publisher has replaced ``keep`` and tidies up itself. Without a table runs newer than
    ``keep`` stay too.
    """
    base = path.rstrip("/")
    files, root = _files(spark, base)
    kept = posixpath.basename(keep.rstrip("/"))
    # Leases are read before the table: a run without one was served before the table was looked at.
    runs = {s.getPath().getName(): s.getModificationTime() for s in _listed(files, root)}
    old = {n: t for n, t in runs.items() if n.startswith(RUN) and n != kept}
    old = {n: t for n, t in old.items() if not _leased(spark, f"{base}/{PUBLISHING}/{n}")}
    if table and _place(spark, table_location(spark, table)) != _place(spark, keep):
        return
    for name, written in old.items():
        if not table and written > runs.get(kept, written):
            continue
        marker = f"{base}/{SUPERSEDED}/{name}"
        if not files.exists(_files(spark, marker)[1]):
            _touch(spark, marker)
        if retain <= 0 or _age(files, _files(spark, marker)[1]) >= retain:
            for place in (f"{base}/{name}", f"{base}/{PUBLISHING}/{name}", marker):
                remove(spark, place)


def _listed(files: JavaObject, folder: JavaObject) -> list[JavaObject]:
    return list(files.listStatus(folder)) if files.exists(folder) else []


def _leased(spark: SparkSession, lease: str) -> bool:
    files, place = _files(spark, lease)
    return files.exists(place) and _age(files, place) < LEASE_SECONDS


def _touch(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def _write(
    df: DataFrame,
    path: str,
    num_files: int | None = None,
    file_bytes: int | None = None,
    sort: Sequence[str] = (),
) -> None:
    if num_files is None and file_bytes is None:
        df.write.parquet(path)
        return
    spark = df.sparkSession
    base, name = posixpath.split(path)
    wide = f"{base}/_{name}-wide"
    try:
        df.write.parquet(wide)
        sizes = file_sizes(spark, wide)
        n = len(sizes)
        if file_bytes and any(not file_bytes / 2 <= x <= 2 * file_bytes for x in sizes):
            n = max(1, round(sum(sizes) / file_bytes))
        if num_files is not None:
            n = min(n, num_files)
        if n == len(sizes):
            files, folder = _files(spark, wide)
            _move(files, folder, _files(spark, path)[1])
        else:
            _merged(spark.read.schema(df.schema).parquet(wide), n, sort).write.parquet(path)
    finally:
        remove(spark, wide)


def _merged(rows: DataFrame, n: int, sort: Sequence[str]) -> DataFrame:
    """Stored rows dealt to ``n`` tasks, neighbours together: in the order of files and of rows in them."""
    taken = {c.lower() for c in rows.columns}
    names = ("file", "place")
    while taken & set(names):
        names = tuple(f"_{x}" for x in names)
    order = [F.col(x) for x in names]
    numbered = rows.select(
        "*",
        F.col("_metadata.file_name").alias(names[0]),
        F.col("_metadata.row_index").alias(names[1]),
    )
    inside = [F.col(f"`{c}`") for c in sort] or order
    return numbered.repartitionByRange(n, *order).sortWithinPartitions(*inside).drop(*names)


def register_table(spark: SparkSession, table: str, path: str, schema: T.StructType) -> None:
    """Serve parquet files as an external table, keeping the files.

    A table with these columns is pointed to the new files in one catalog call, so readers find it at
    any time. Only one with other columns is dropped and created; if that fails, the old one is put
    back. The files' schema is compared first, because a wrong declared type would only fail
    when someone reads the table. A managed table of that name is left alone: dropping it
    would delete its data.
    """
    if issues := schema_issues(spark.read.parquet(path).schema, schema):
        raise ContractError(f"{path}: " + "; ".join(issues))
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
        return
    kind = spark.catalog.getTable(table).tableType
    if kind != "EXTERNAL":
        raise ContractError(f"{table} is a {kind} table, not an external one")
    described = _described(spark, table)
    served = spark.table(table).schema
    if described.get("Provider") == "parquet" and not schema_issues(served, schema):
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION '{place}'", args={"name": table})
        return
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": table})
    try:
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    except BaseException:
        spark.catalog.createTable(
            table, path=described["Location"], source=described["Provider"], schema=served
        )
        raise


def table_location(spark: SparkSession, table: str) -> str:
    """The folder that an external table points to."""
    return _described(spark, table)["Location"]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": table}).collect()
    # Columns come first: what is said of the table stands below its heading.
    heading = next(k for k, r in enumerate(rows) if r.col_name == "# Detailed Table Information")
    return {r.col_name: r.data_type for r in rows[heading + 1 :]}


def register_mart(spark: SparkSession, mart: str, path: str, table: str) -> None:
    register_table(spark, table, path, CONTRACTS[mart])


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``shared_dir``, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    files, folder = _files(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application that every executor can reach.

    Below the cluster's ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder on this machine, removed at exit.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return f"{base.rstrip('/')}/{context.applicationId}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


_LOCAL: list[str] = []


def _local_dir() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="martloom-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _refuse_overlap(spark: SparkSession, path: str, inputs: Iterable[str]) -> None:
    target = _place(spark, path)
    for source in inputs:
        place = _place(spark, source)
        if target[:2] == place[:2] and (
            target[2].startswith(place[2]) or place[2].startswith(target[2])
        ):
            raise ValueError(f"refusing to overwrite {path}: it overlaps the input {source}")


def _place(spark: SparkSession, path: str) -> tuple[str, str, str]:
    """Store, authority and folder of a path, however it is spelt.

    A path without a scheme is completed as Spark would, with the default file system and
    working folder; ``.`` and ``..`` are resolved; all schemes of one store count as one.
    """
    if not urlsplit(path).scheme:
        files, target = _files(spark, path)
        path = files.makeQualified(target).toString()
    parts = urlsplit(path)
    scheme = "s3" if parts.scheme in ("s3", "s3a", "s3n") else parts.scheme
    folder = posixpath.normpath("/" + parts.path.lstrip("/"))
    return scheme, parts.netloc, folder.rstrip("/") + "/"
