"""Writing, registering and publishing marts."""

from __future__ import annotations

import os
import shutil
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Event

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom import CONTRACTS, MARTS, ContractError, run_marts
from martloom.__main__ import main
from martloom.operators import sinks
from martloom.operators.sinks import (
    PublishError,
    _refuse_overlap,
    recover_mart,
    register_mart,
    register_table,
    release_run,
    remove_old_runs,
    report_path,
    scratch_dir,
    shared_dir,
    table_location,
    write_mart,
    write_run,
)
from martloom.plans.catalogue import catalogue, mart
from martloom.settings import SETTINGS, apply_settings
from martloom.sources.testdata import load
from tests.conftest import SF_DIR

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture
def same_settings_after(spark):
    before = {key: spark.conf.get(key) for key in SETTINGS}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def runs_of(out: str, name: str) -> list[str]:
    return [str(p) for p in Path(report_path(out, name)).glob("run-*")]


def data_files(path: str) -> list[Path]:
    return list(Path(path).glob("part-*.parquet"))


def test_overwrite_replaces_and_never_appends(spark, out):
    built = mart(spark, SMALL, "suppliers")
    write_mart(built, out)
    write_mart(built, out)
    assert sorted(spark.read.parquet(out).collect()) == sorted(built.collect())
    write_mart(built.limit(0), out)
    assert spark.read.parquet(out).count() == 0


def test_file_count_is_bounded_only_on_request(spark, out):
    spread = mart(spark, SF_DIR, "orders", order="none").repartition(6)
    write_mart(spread, out)
    assert len(data_files(out)) == 6
    write_mart(spread, out, num_files=4)
    assert len(data_files(out)) == 4
    assert spark.read.parquet(out).count() == 7628


def test_few_files_keep_the_global_order(spark, out):
    write_mart(mart(spark, SF_DIR, "lineitems"), out, num_files=2)
    files = sorted(data_files(out))
    assert 1 <= len(files) <= 2
    keys = [r.L_ORDERKEY for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(keys) == 14743 and keys == sorted(keys)


def test_target_may_not_overlap_an_input(spark, tmp_path):
    df = spark.range(3)
    source = f"{tmp_path}/orders"
    df.write.parquet(source)
    for target in (
        source,
        f"{source}/",
        f"{source}/mart",
        str(tmp_path),
        f"file://{source}",
        f"file:{source}",
        f"{tmp_path}/./orders",
        f"{tmp_path}/other/../orders",
        os.path.relpath(source),
    ):
        with pytest.raises(ValueError, match="overlaps"):
            write_mart(df, target, inputs=[source])
    write_mart(df, f"{tmp_path}/orders_report", inputs=[source])
    assert spark.read.parquet(source).count() == 3


def test_registering_again_and_dropping_keeps_the_files(spark, out):
    write_mart(mart(spark, SMALL, "suppliers"), out)
    for _ in range(2):
        register_mart(spark, "suppliers", out, "t_suppliers")
    assert spark.catalog.getTable("t_suppliers").tableType == "EXTERNAL"
    served = spark.table("t_suppliers")
    assert [(f.name, f.dataType) for f in served.schema] == [
        (f.name, f.dataType) for f in CONTRACTS["suppliers"]
    ]
    assert served.count() == 10
    spark.sql("DROP TABLE t_suppliers")
    assert spark.read.parquet(out).count() == 10


def test_registered_table_serves_the_files_written_last(spark, out):
    built = mart(spark, SMALL, "suppliers")
    write_mart(built.limit(4), out)
    register_mart(spark, "suppliers", out, "t_rewritten")
    assert spark.table("t_rewritten").count() == 4
    write_mart(built, out)
    register_mart(spark, "suppliers", out, "t_rewritten")
    assert spark.table("t_rewritten").count() == 10


def test_files_that_break_the_contract_are_not_registered(spark, out):
    write_mart(mart(spark, SMALL, "suppliers").withColumnRenamed("R_NAME", "region"), out)
    with pytest.raises(ContractError, match="missing column R_NAME"):
        register_mart(spark, "suppliers", out, "t_broken")
    assert not spark.catalog.tableExists("t_broken")


def test_managed_table_is_not_dropped(spark, out):
    spark.range(3).write.saveAsTable("t_managed")
    try:
        spark.range(5).write.parquet(out)
        with pytest.raises(ContractError, match="MANAGED"):
            register_table(spark, "t_managed", out, spark.range(1).schema)
        assert spark.table("t_managed").count() == 3
    finally:
        spark.sql("DROP TABLE t_managed")


def test_scratch_lies_in_the_folder_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == f"{base}/{spark.sparkContext.applicationId}"
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second
    assert first.startswith(shared_dir(spark))


def test_run_publishes_every_mart(spark, out):
    spark.sql("CREATE DATABASE IF NOT EXISTS dm")
    zone = spark.conf.get("spark.sql.session.timeZone")
    statuses = run_marts(spark, SMALL, out, load=load, database="dm", scale=2, concurrent=3)
    assert [(s.mart, s.published, s.table, s.error) for s in statuses] == [
        (m, True, f"dm.{m}", None) for m in MARTS
    ]
    for status in statuses:
        assert status.path.startswith(report_path(out, status.mart) + "/run-")
        expected = mart(spark, SMALL, status.mart)
        assert sorted(map(str, spark.table(status.table).collect())) == sorted(
            map(str, expected.collect())
        )
    assert spark.conf.get("spark.sql.session.timeZone") == zone


def failing(df, after: int):
    """Raises in a task once ``after`` rows have been written."""
    bad = F.when(F.monotonically_increasing_id() >= after, F.raise_error(F.lit("disk on fire")))
    return df.withColumn(df.columns[-1], F.coalesce(bad.cast("double"), F.col(df.columns[-1])))


def test_a_write_that_fails_half_way_leaves_the_old_files(spark, out):
    built = mart(spark, SMALL, "suppliers")
    write_mart(built, out)
    register_mart(spark, "suppliers", out, "t_half")
    many = built.crossJoin(spark.range(50_000)).select(*built.columns).coalesce(1)
    with pytest.raises(PySparkException, match="disk on fire"):
        write_mart(failing(many, 400_000), out)
    assert spark.table("t_half").count() == 10
    assert spark.read.parquet(out).count() == 10
    assert [p.name for p in Path(out).parent.iterdir()] == ["out"]


def test_a_run_that_fails_leaves_the_old_table(spark, out):
    options = {"marts": ["suppliers"], "load": load, "database": "default", "retain_seconds": 0}
    (first,) = run_marts(spark, SMALL, out, **options)
    assert first.published

    def broken(session, base, name):
        df = load(session, base, name)
        if name != "supplier":
            return df
        return failing(df.select("s_suppkey", "s_nationkey", "s_acctbal"), 5)

    (second,) = run_marts(spark, SMALL, out, **options | {"load": broken})
    assert "disk on fire" in second.error
    assert spark.table("suppliers").count() == 10
    assert runs_of(out, "suppliers") == [first.path]
    (third,) = run_marts(spark, SMALL, out, **options)
    assert third.path != first.path
    assert not Path(first.path).exists()
    assert spark.table("suppliers").count() == 10
    spark.sql("DROP TABLE suppliers")


@pytest.mark.parametrize(
    ("target", "source"),
    [
        ("s3://b/raw/orders", "s3a://b/raw/orders"),
        ("s3a://b/raw/x/../orders/", "s3n://b/raw"),
        ("hdfs://n:1/a/./b", "hdfs://n:1/a/b/c"),
        ("file:/data/a", "file:///data/a"),
        ("file:/data/a", "/data/a/b"),
    ],
)
def test_one_place_spelt_in_two_ways(spark, target, source):
    with pytest.raises(ValueError, match="overlaps"):
        write_mart(spark.range(1), target, inputs=[source])
    with pytest.raises(ValueError, match="overlaps"):
        write_run(spark.range(1), target, inputs=[source])


def test_other_places_are_not_refused(spark):
    for target, source in (
        ("s3://b/raw", "s3://c/raw"),
        ("s3://b/raw2", "s3://b/raw"),
        ("hdfs://n/a", "s3://n/a"),
        ("/data/orders_report", "/data/orders"),
    ):
        _refuse_overlap(spark, target, [source])


def test_options_by_mart(spark, out, monkeypatch):
    statuses = run_marts(
        spark,
        SMALL,
        out,
        marts=["orders", "lineitems"],
        load=load,
        register=False,
        scale={"orders": 2, "lineitems": {"l_extendedprice": 2}},
        num_files={"orders": 2},
        shuffle_partitions=5,
    )
    assert all(s.published for s in statuses), statuses
    assert len(data_files(report_path(out, "orders"))) <= 2
    # Sorted inside each file, which takes no second shuffle.
    for file in data_files(report_path(out, "lineitems")):
        keys = [r.L_ORDERKEY for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)
    with pytest.raises(ValueError, match="grow with the data"):
        run_marts(spark, SMALL, out, num_files=3)
    with pytest.raises(ValueError, match="layout"):
        run_marts(spark, SMALL, out, layout="tarball")


def test_published_line_mart_has_one_shuffle(spark):
    built = mart(spark, SMALL, "lineitems", order="file")
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_tables_are_opened_once_and_checked_by_mart(spark, out):
    """Each mart needs its own columns only; every table is read once for all marts."""
    narrow = {
        "customer": ["c_custkey", "c_nationkey"],
        "nation": ["n_nationkey", "n_name"],
        "supplier": ["s_suppkey", "s_nationkey"],
    }
    opened = []

    def loads(session, base, name):
        opened.append(name)
        df = load(session, base, name)
        if name == "lineitem":
            df = df.drop("l_receiptdate", "l_shipdate")
        return df.select(*narrow.get(name, df.columns))

    marts = ["orders", "parts", "lineitems_core", "customers", "suppliers", "lineitems"]
    statuses = {
        s.mart: s for s in run_marts(spark, SMALL, out, marts=marts, load=loads, register=False)
    }
    assert {m for m, s in statuses.items() if s.published} == {"orders", "parts", "lineitems_core"}
    assert "missing column s_acctbal" in statuses["suppliers"].error
    assert "missing column c_mktsegment" in statuses["customers"].error
    assert "missing column l_receiptdate" in statuses["lineitems"].error
    assert sorted(opened) == sorted(set(opened))
    core = spark.read.parquet(statuses["lineitems_core"].path)
    assert core.columns == CONTRACTS["lineitems_core"].names
    assert core.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").select("l_orderkey").distinct().count()


def test_the_callers_session_is_left_alone(spark, out):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    before = spark.conf.getAll
    seen = {}

    def loads(session, base, name):
        seen.update(session.conf.getAll)
        return load(session, base, name)

    try:
        run_marts(
            spark, SMALL, out, marts=["suppliers"], load=loads, register=False, shuffle_partitions=3
        )
        assert spark.conf.getAll == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen["spark.sql.session.timeZone"] == "UTC"
    assert seen["spark.sql.shuffle.partitions"] == "3"
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert seen[key] == before.get(key, SETTINGS[key])


def test_one_failing_mart_stops_no_other(spark, out):
    """Without stand-ins two marts lack inputs; the others are published."""
    write_mart(mart(spark, SMALL, "parts"), report_path(out, "parts"))
    statuses = {s.mart: s for s in run_marts(spark, SMALL, out, register=False)}
    assert {m for m, s in statuses.items() if s.published} == {"orders", "customers", "suppliers"}
    assert "l_receiptdate" in statuses["lineitems"].error
    assert "p_container" in statuses["parts"].error
    assert not Path(statuses["lineitems"].path).exists()
    # The mart published earlier is still there.
    assert spark.read.parquet(statuses["parts"].path).count() == 1421


def test_wrong_mart_names_are_refused_before_anything_runs(spark, out):
    with pytest.raises(ValueError, match="nonsense"):
        run_marts(spark, SMALL, out, marts=["orders", "nonsense"])
    with pytest.raises(ValueError, match="twice"):
        run_marts(spark, SMALL, out, marts=["orders", "orders"])
    assert not Path(out).exists()


def test_settings_leave_the_deployers_alone(spark, same_settings_after, monkeypatch):
    zone, size = "spark.sql.session.timeZone", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    monkeypatch.setitem(SETTINGS, zone, "Asia/Tokyo")
    apply_settings(spark)
    assert spark.conf.get(zone) == "UTC"
    assert spark.conf.get(size) == SETTINGS[size]


def test_command_line(spark, same_settings_after, out, capsys):
    arguments = ["--input", SMALL, "--output", out, "--suffix", ".parquet", "--no-register"]
    assert main([*arguments, "--marts", "suppliers,customers", "--num-files", "1"]) == 0
    assert "suppliers: published" in capsys.readouterr().out
    assert len(data_files(report_path(out, "customers"))) == 1
    assert main([*arguments, "--marts", "parts"]) == 1
    assert "parts: failed" in capsys.readouterr().out
    by_mart = ["--marts", "orders,lineitems_core", "--num-files", "orders=3", "--order", "orders=none"]
    assert main([*arguments, *by_mart, "--scale", "o_totalprice=2", "--shuffle-partitions", "4"]) == 0
    assert len(data_files(report_path(out, "orders"))) <= 3


@pytest.mark.parametrize("name", ["serve_suppliers", "sink_coalesce_roundtrip", "sink_overwrite_roundtrip"])
def test_two_calls_of_a_query_do_not_disturb_each_other(spark, name):
    query = catalogue()[name]
    first, second = query(spark, SMALL), query(spark, SF_DIR)
    expected = {"serve_suppliers": (10, 25)}.get(name, (1383, 7628))
    assert (first.count(), second.count()) == expected
    if "n_files" in first.columns:
        assert {r.n_files for r in first.unionByName(second).select("n_files").distinct().collect()} == {4}


def refuse_moves(monkeypatch, *refused: int) -> None:
    """Moves of these numbers fail, counted from 1."""
    move, calls = sinks._move, []

    def moved(files, source, target):
        calls.append(target)
        if len(calls) in refused:
            raise OSError("move refused")
        move(files, source, target)

    monkeypatch.setattr(sinks, "_move", moved)


def beside(out: str) -> list[str]:
    return sorted(p.name for p in Path(out).parent.iterdir())


@pytest.mark.parametrize("refused", [1, 2])
def test_a_refused_move_leaves_the_old_mart_whole(spark, out, monkeypatch, refused):
    write_mart(spark.range(10), out)
    refuse_moves(monkeypatch, refused)
    with pytest.raises(OSError, match="move refused"):
        write_mart(spark.range(3), out)
    assert spark.read.parquet(out).count() == 10
    assert beside(out) == ["out"]
    write_mart(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3


def test_a_mart_that_cannot_be_put_back_is_not_lost(spark, out, monkeypatch):
    write_mart(spark.range(10), out)
    with monkeypatch.context() as patch:
        refuse_moves(patch, 2, 3)
        with pytest.raises(PublishError, match="what was there is in .*previous.*the new files in .*staging"):
            write_mart(spark.range(3), out)
    assert not Path(out).exists()
    assert recover_mart(spark, out)
    assert spark.read.parquet(out).count() == 10
    assert beside(out) == ["out"]
    assert not recover_mart(spark, out)


@pytest.mark.parametrize("swapped", [False, True])
def test_the_next_publisher_puts_right_what_a_dead_one_left(spark, out, monkeypatch, swapped):
    """Died between its two moves, or after them and before it deleted the old files."""
    write_mart(spark.range(10), f"{out}.previous-x")
    spark.range(4).write.parquet(out if swapped else f"{out}.staging-x")
    Path(f"{out}.swap").write_text(f"{out}.previous-x\n{out}.staging-x\n")
    seen = []
    recover = sinks.recover_mart

    def recovered(session, path):
        recover(session, path)
        seen.append(spark.read.parquet(out).count())

    monkeypatch.setattr(sinks, "recover_mart", recovered)
    monkeypatch.setattr(sinks, "SWAP_SECONDS", -1.0)
    write_mart(spark.range(3), out)
    assert seen == [4 if swapped else 10]
    assert spark.read.parquet(out).count() == 3
    assert beside(out) == ["out"]


def test_a_publisher_that_died_before_its_moves_left_the_mart(spark, out):
    write_mart(spark.range(10), out)
    Path(f"{out}.swap").write_text("")
    assert recover_mart(spark, out)
    assert spark.read.parquet(out).count() == 10


def test_publishers_of_one_folder_swap_one_after_another(spark, out):
    def publish(n):
        for _ in range(4):
            write_mart(spark.range(n), out)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(publish, (5, 6, 7)))
    assert spark.read.parquet(out).count() in (5, 6, 7)
    assert beside(out) == ["out"]


def test_readers_find_the_table_at_any_time(spark, out):
    def publish(n):
        run = write_run(spark.range(n, n + 50), out)
        register_table(spark, "t_polled", run, spark.range(1).schema)
        release_run(spark, run)
        remove_old_runs(spark, out, run, table="t_polled", retain=60)

    publish(0)
    done, seen = Event(), set()

    def poll():
        while not done.is_set():
            rows = spark.sql("SELECT min(id) AS low, count(*) AS n FROM t_polled").first()
            assert rows.n == 50
            seen.add(rows.low)

    with ThreadPoolExecutor(1) as pool:
        polling = pool.submit(poll)
        for n in range(1, 21):
            publish(n)
        done.set()
        polling.result()
    assert len(seen) > 3
    assert spark.table("t_polled").agg(F.min("id")).first()[0] == 20
    spark.sql("DROP TABLE t_polled")


def test_a_table_that_cannot_be_created_anew_is_put_back(spark, out, monkeypatch):
    old, new = f"{out}/old", f"{out}/new"
    spark.range(4).write.parquet(old)
    spark.range(5).selectExpr("id", "id AS more").write.parquet(new)
    register_table(spark, "t_put_back", old, spark.range(1).schema)
    create, calls = type(spark.catalog).createTable, []

    def created(self, *args, **options):
        calls.append(options)
        if len(calls) == 1:
            raise RuntimeError("catalog is away")
        return create(self, *args, **options)

    monkeypatch.setattr(type(spark.catalog), "createTable", created)
    schema = spark.read.parquet(new).schema
    with pytest.raises(RuntimeError, match="away"):
        register_table(spark, "t_put_back", new, schema)
    assert spark.table("t_put_back").count() == 4
    register_table(spark, "t_put_back", new, schema)
    assert spark.table("t_put_back").columns == ["id", "more"]
    spark.sql("DROP TABLE t_put_back")


def test_a_table_is_pointed_to_any_path(spark, out):
    for name in ("it's", "a b", "c=d"):
        spark.range(len(name)).write.parquet(f"{out}/{name}")
        register_table(spark, "t_spelt", f"{out}/{name}", spark.range(1).schema)
        assert spark.table("t_spelt").count() == len(name)
    spark.sql("DROP TABLE t_spelt")


@pytest.mark.parametrize("order", ["abAB", "aAbB", "abBA", "bBaA", "baAB"])
def test_interleaved_publishers_leave_a_readable_table(spark, out, order):
    """Small letter: a publisher has written its run; large letter: it serves it and tidies up."""
    runs, schema = {}, spark.range(1).schema
    first = write_run(spark.range(1), out)
    register_table(spark, "t_two", first, schema)
    release_run(spark, first)
    for step in order:
        name = step.lower()
        if step == name:
            runs[name] = write_run(spark.range(2 if name == "a" else 3), out)
        else:
            register_table(spark, "t_two", runs[name], schema)
            release_run(spark, runs[name])
            remove_old_runs(spark, out, runs[name], table="t_two")
        assert spark.table("t_two").count() in (1, 2, 3)
    assert spark.table("t_two").count() == (3 if order.endswith("B") else 2)
    assert Path(table_location(spark, "t_two").removeprefix("file:")).exists()
    assert not Path(first).exists()
    spark.sql("DROP TABLE t_two")


def test_a_slow_publisher_leaves_what_a_later_one_serves(spark, out):
    schema = spark.range(1).schema
    slow, fast = write_run(spark.range(2), out), write_run(spark.range(3), out)
    register_table(spark, "t_slow", slow, schema)
    register_table(spark, "t_slow", fast, schema)
    release_run(spark, fast)
    remove_old_runs(spark, out, fast, table="t_slow")
    assert Path(slow).exists()  # its publisher is still at it
    release_run(spark, slow)
    remove_old_runs(spark, out, slow, table="t_slow")
    assert spark.table("t_slow").count() == 3
    remove_old_runs(spark, out, fast, table="t_slow")
    assert [str(p) for p in Path(out).glob("run-*")] == [fast]
    spark.sql("DROP TABLE t_slow")


def test_replaced_runs_stay_for_a_while(spark, out):
    first, second = write_run(spark.range(2), out), write_run(spark.range(3), out)
    for run in (first, second):
        release_run(spark, run)
    remove_old_runs(spark, out, second, retain=3600)
    assert Path(first).exists()
    marker = f"{out}/_superseded/{Path(first).name}"
    os.utime(marker, (0, 0))
    remove_old_runs(spark, out, second, retain=3600)
    assert not Path(first).exists() and not Path(marker).exists()
    third = write_run(spark.range(4), out)
    release_run(spark, third)
    os.utime(third, (2e9, 2e9))
    remove_old_runs(spark, out, second)  # without a table to say so, a newer run is no old one
    assert Path(third).exists()


def test_a_dead_publishers_run_is_removed_in_the_end(spark, out):
    dead, live = write_run(spark.range(2), out), write_run(spark.range(3), out)
    release_run(spark, live)
    os.utime(dead, (0, 0))
    remove_old_runs(spark, out, live)
    assert Path(dead).exists()
    os.utime(f"{out}/_publishing/{Path(dead).name}", (0, 0))
    remove_old_runs(spark, out, live)
    assert not Path(dead).exists()


def sized(spark, n: int = 200_000):
    """Sorted rows in 40 uneven tasks; the text keeps files from shrinking."""
    rows = spark.range(n).selectExpr("id", "sha2(cast(id AS string), 256) AS text", "id % 7 AS file")
    bounds = rows.repartitionByRange(40, F.sqrt("id")).sortWithinPartitions("id")
    return bounds


@pytest.mark.parametrize("target", [1 << 20, 3 << 20])
def test_files_have_the_wanted_size_and_the_rows_their_order(spark, out, monkeypatch, target):
    merged, widths = sinks._merged, []

    def counted(rows, n, sort):
        widths.append(len(rows.inputFiles()))
        return merged(rows, n, sort)

    monkeypatch.setattr(sinks, "_merged", counted)
    df = sized(spark)
    write_mart(df, out, file_bytes=target)
    assert widths == [40]  # the last stage was as wide as its shuffle
    files = sorted(data_files(out))
    assert len(files) > 1
    assert all(target / 2 <= f.stat().st_size <= 2 * target for f in files)
    keys = [r.id for f in files for r in spark.read.parquet(str(f)).collect()]
    assert keys == list(range(200_000))
    assert spark.read.parquet(out).columns == df.columns
    write_mart(spark.read.parquet(out), f"{out}-again", file_bytes=target)
    assert beside(out) == ["out", "out-again"]


def test_merged_files_are_sorted_inside_if_asked(spark, out):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k").repartition(9).sortWithinPartitions("k")
    run = write_run(df, out, num_files=2, sort=["k"])
    files = data_files(run)
    assert len(files) == 2
    found = []
    for file in files:
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)
        found += keys
    assert sorted(found) == list(range(5000))
    assert sorted(p.name for p in Path(out).iterdir()) == sorted(["_publishing", Path(run).name])
    shutil.rmtree(out)
    empty = write_run(df.limit(0), out, num_files=2, file_bytes=100)
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


@pytest.mark.parametrize("layout", ["runs", "flat"])
def test_publishing_through_a_file_system_that_is_not_local(spark, tmp_path, layout):
    """Paths that only Hadoop's file systems can resolve, as in an object store."""
    (tmp_path / "marts").mkdir()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    lake = f"lake{layout}"
    conf.set(f"fs.viewfs.mounttable.{lake}.link./raw", f"file://{SMALL}")
    conf.set(f"fs.viewfs.mounttable.{lake}.link./marts", f"file://{tmp_path}/marts")
    options = {"load": load, "database": "default", "layout": layout, "retain_seconds": 0}
    names = ["suppliers", "orders"]
    for _ in range(3):
        statuses = run_marts(spark, f"viewfs://{lake}/raw", f"viewfs://{lake}/marts", marts=names, **options)
        assert [s.error for s in statuses] == [None, None]
    for status in statuses:
        assert status.path.startswith(f"viewfs://{lake}/marts/{status.mart}_report")
        expected = mart(spark, SMALL, status.mart)
        assert spark.table(status.table).count() == expected.count()
        assert table_location(spark, status.table) == status.path
    if layout == "runs":
        assert len(list((tmp_path / "marts" / "orders_report").glob("run-*"))) == 1
    with pytest.raises(ValueError, match="overlaps"):
        write_mart(spark.range(1), f"viewfs://{lake}/raw/orders.parquet", inputs=[f"viewfs://{lake}/raw"])
    for name in names:
        spark.sql(f"DROP TABLE {name}")
