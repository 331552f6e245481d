"""Archiving, leases, statistics and compaction beside hops that crash, stop and go on."""

import json
import threading
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_streaming import CrashOnce, expected, send, sessions, topic

from eventlayers.operators import gold, ledger
from eventlayers.sources import files, layers, manifests
from eventlayers.streaming import jobs, leases


def filled(spark, tmp_path, n=12, batches=1, **options):
    layout = jobs.Layout(str(tmp_path / "layers"), archive_root=str(tmp_path / "archive"), **options)
    for k in range(batches):
        send(spark, tmp_path / "topic", k * n, n)
        jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    return layout


def statuses(spark, layout):
    tasks = ledger.current_tasks(jobs.read_log(spark, layout, "tasks"))
    return {(r.layer, r.status): r["count"] for r in tasks.groupBy("layer", "status").count().collect()}


def test_archive_waits_for_the_checkpoint(spark, tmp_path):
    """A crash after the hand-over, an archive run, a restart: the replay finds its files and loses nothing."""
    layout = filled(spark, tmp_path)
    with pytest.raises(Exception, match="crash after write"):
        jobs.finish(jobs.bronze_to_silver(spark, layout, after_write=CrashOnce()))
    assert list(statuses(spark, layout)) == [("bronze", "PENDING")]
    assert jobs.settle_archive(spark, layout).first().taken == 0
    total = sessions(spark, 12).count()
    assert jobs.finish(jobs.bronze_to_silver(spark, layout)).total("silver_count") == total
    assert jobs.settle_archive(spark, layout).first().archived == statuses(spark, layout)[("bronze", "DONE")] > 0
    assert jobs.run_full(spark, layout)["loaded_page_views_count"] == expected(sessions(spark, 12))[0]


def test_moves_that_were_begun_are_completed(spark, tmp_path):
    """Files that are in the archive already, whole, cut short, or all of them, with the source still there."""
    layout = filled(spark, tmp_path, 6, batches=3)
    jobs.finish(jobs.bronze_to_silver(spark, layout))
    active, archive = Path(layout.layer("bronze")), Path(layout.archive("bronze"))
    due = sorted(active.glob("writer=*/batch_id=*/route=rows/**/*.parquet"))
    sizes = {str(f.relative_to(active)): f.stat().st_size for f in due}
    by_batch = {str(f.relative_to(active)).split("/")[1]: f for f in due}
    for k, f in enumerate(by_batch.values()):
        there = archive / f.relative_to(active)
        there.parent.mkdir(parents=True)
        if k != 2:
            there.write_bytes(f.read_bytes()[: None if k == 0 else 50])
    report = jobs.settle_archive(spark, layout).first()
    assert (report.archived, report.failed, report.skipped) == (len(due), 0, 0)
    assert {str(f.relative_to(archive)): f.stat().st_size for f in archive.rglob("*.parquet")} == sizes
    assert not list(active.glob("writer=*/batch_id=*/route=rows/**/*.parquet"))


def test_a_move_that_fails_is_noted_and_tried_again(spark, tmp_path, monkeypatch):
    layout = filled(spark, tmp_path)
    jobs.finish(jobs.bronze_to_silver(spark, layout))
    whole = jobs._move_folder
    monkeypatch.setattr(jobs, "_move_folder", lambda *_: "no room left")
    assert jobs.settle_archive(spark, layout).first().failed > 0
    task = ledger.current_tasks(jobs.read_log(spark, layout, "tasks")).first()
    assert (task.status, task.attempts, task.last_error) == ("FAILED", 1, "no room left")
    monkeypatch.setattr(jobs, "_move_folder", whole)
    assert jobs.settle_archive(spark, layout).first().archived > 0
    task = ledger.current_tasks(jobs.read_log(spark, layout, "tasks")).first()
    assert (task.status, task.attempts) == ("DONE", 2)


def test_one_run_at_a_time(spark, tmp_path):
    layout = filled(spark, tmp_path)
    with jobs.leased(spark, layout, "run", "another"):
        with pytest.raises(leases.LeaseHeld):
            jobs.run_full(spark, layout)
    assert not Path(layout.layer("silver")).exists()
    got, failed = [], []

    def run():
        try:
            got.append(jobs.run_full(spark, layout)["silver_count"])
        except leases.LeaseHeld as error:
            failed.append(error)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    # The second stops, or begins when the first is through and finds nothing to do.
    assert sorted(got)[-1] == sessions(spark, 12).count() and len(got) + len(failed) == 2 and sum(got) == got[-1] or 0 in got


def test_a_lease_is_taken_over_only_when_it_ran_out(spark, tmp_path):
    folder = str(tmp_path / "lease")
    first = leases.acquire(spark, folder, "a", seconds=60)
    with pytest.raises(leases.LeaseHeld):
        leases.acquire(spark, folder, "b")
    first.release()
    second = leases.acquire(spark, folder, "b", seconds=0)
    third = leases.acquire(spark, folder, "c", seconds=60)
    assert (first.number, second.number, third.number) == (1, 2, 3)
    third.check()
    for stale in (first.check, second.check, second.renew):
        with pytest.raises(leases.LeaseLost):
            stale()
    second.release()
    with pytest.raises(leases.LeaseHeld):
        leases.acquire(spark, folder, "d")


def test_a_run_that_was_taken_over_cannot_commit(spark, tmp_path, monkeypatch):
    """It stops between its write and its commit; its successor commits the batch from a folder of its own."""
    layout = filled(spark, tmp_path)
    folder = layout.layer("_leases/run")
    stale = leases.acquire(spark, folder, "a", seconds=0)
    batch_lines = layers.batch_lines

    def paused(*args):
        leases.acquire(spark, folder, "b", seconds=0)
        return batch_lines(*args)

    monkeypatch.setattr(layers, "batch_lines", paused)
    with pytest.raises(Exception, match="lease 1 of a was followed by 2"):
        jobs.finish(jobs.bronze_to_silver(spark, layout, lease=stale))
    monkeypatch.undo()
    assert not list(Path(layout.layer("silver")).glob("_commits/*.json")) and not Path(layout.layer("tasks")).exists()
    total = sessions(spark, 12).count()
    done = jobs.run_full(spark, layout)
    assert done["silver_count"] == total
    writers = {p.name.rsplit(".", 1)[1] for p in Path(layout.layer("silver")).glob("writer=*")}
    assert writers == {"1", "3"}
    from eventlayers import schemas

    assert layers.read_layer(spark, layout.layer("silver"), schemas.SILVER, jobs.ROWS, "event_date").count() == total


def test_statistics_open_no_data_file(spark, tmp_path):
    layout = filled(spark, tmp_path, batches=2)
    jobs.run_full(spark, layout)
    want = {}
    for layer, (folder, route) in jobs.FILES.items():
        found = list(Path(layout.layer(folder)).glob(f"writer=*/batch_id=*/route={route}/**/*.parquet"))
        want[layer] = (len(found), sum(pq.ParquetFile(f).metadata.num_rows for f in found))
    want["gold"] = tuple(a + b for a, b in zip(want[gold.PAGE_VIEWS], want[gold.PRODUCT_EVENTS]))
    for f in Path(layout.root).glob("*/writer=*/batch_id=*/route=*/**/*.parquet"):
        f.unlink()
    assert {r.layer: (r.files, r.rows) for r in jobs.stats(spark, layout).collect()} == want


def test_entries_have_the_bounds_of_each_file(spark, tmp_path):
    layout = filled(spark, tmp_path, batches=2)
    jobs.finish(jobs.bronze_to_silver(spark, layout))
    lines = [r for r in layers.read_entries(spark, layout.layer("silver")).collect() if r.file]
    for r in lines:
        rows = spark.read.parquet(f"{layout.layer('silver')}/{r.file}").agg(F.count("*"), F.min("event_time"), F.max("event_time")).first()
        assert (r.rows, datetime.fromisoformat(r.first_time), datetime.fromisoformat(r.last_time)) == tuple(rows)
    sources = {r.source for r in layers.read_entries(spark, layout.layer("silver")).collect() if r.source}
    assert sources == {p.stem for p in Path(layout.layer("bronze")).glob("_commits/*.json")}


def test_compaction_beside_hops_that_go_on(spark, tmp_path, monkeypatch):
    """Logs are compacted while one reader is behind; it misses nothing, and what is shown stays the same."""
    monkeypatch.setattr(manifests, "FAN", 2)
    layout = filled(spark, tmp_path, 5, batches=3)
    # Nothing has read the layer: its entries stay.
    assert jobs.compact(spark, layout, least=1) == {}
    jobs.finish(jobs.bronze_to_silver(spark, layout))
    with pytest.raises(Exception, match="crash after write"):
        jobs.finish(jobs.silver_to_gold(spark, layout, after_write=CrashOnce()))
    done = jobs.compact(spark, layout, least=1)
    assert done == {"bronze": 3, "tasks": 1}

    def shown():
        tasks = ledger.current_tasks(jobs.read_log(spark, layout, "tasks"))
        stats = {tuple(r) for r in jobs.stats(spark, layout).collect()}
        return stats, {tuple(r) for r in tasks.collect()}

    send(spark, tmp_path / "topic", 15, 5)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    before = shown()
    assert jobs.compact(spark, layout, least=1) == {} and shown() == before
    total = sessions(spark, 20).count()
    assert jobs.run_full(spark, layout)["silver_count"] == total
    before = shown()
    for _ in range(2):
        jobs.compact(spark, layout, least=1)
        assert shown() == before
    # Parts go with the switch after the one that replaced them.
    assert jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count() == expected(sessions(spark, 20))[0]
    send(spark, tmp_path / "topic", 20, 4)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    assert jobs.run_full(spark, layout)["silver_count"] == sessions(spark, 4).count()
    jobs.compact(spark, layout, least=1)
    assert jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count() == expected(sessions(spark, 24))[0]
    assert jobs.settle_archive(spark, layout).first().failed == 0
    assert {r.rows for r in jobs.stats(spark, layout).collect()} == {0}


def test_ten_thousand_entries_become_tens_of_objects(spark, tmp_path):
    """A mart's log of ten thousand commits: levels of a few folders, and every line kept."""
    layout = jobs.Layout(str(tmp_path / "layers"))
    root = Path(layout.layer("mart_page_views"))
    (root / "_commits").mkdir(parents=True)
    place = Path(jobs.checkpoint(layout, "load_mart_page_views"))
    (place / "commits").mkdir(parents=True)
    (place / "metadata").write_text(json.dumps({"id": "q"}))
    (place / "commits" / "9998").write_text("v1\n{}")
    for k in range(10_000):
        line = {"file": f"writer=q/batch_id={k}/route=rows/part.parquet", "bytes": 1, "route": "rows", "rows": k}
        (root / "_commits" / f"q-{k}.json").write_text(json.dumps(line) + "\n")

    def lines():
        return layers.read_entries(spark, str(root)).agg(F.count("file"), F.sum("rows"), F.count_distinct("entry")).first()

    before = tuple(lines())
    assert jobs.compact(spark, layout) == {"mart_page_views": 9999}
    assert tuple(lines()) == before and jobs.compact(spark, layout) == {}
    # The next switch removes what the last one replaced.
    for k in range(10_000, 10_020):
        (root / "_commits" / f"q-{k}.json").write_text(json.dumps({"file": f"f{k}", "route": "rows", "rows": k}) + "\n")
    (place / "commits" / "10019").write_text("v1\n{}")
    assert jobs.compact(spark, layout) == {"mart_page_views": 21}
    assert len(list((root / "_commits").glob("*.json"))) == 21
    assert len([p for p in (root / "_manifests").rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]) < 30
    assert lines()[2] == 10_020


def test_manifests_merge_levels_and_switch_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifests, "FAN", 3)
    root = str(tmp_path / "log")
    for k in range(10):
        manifests.add(root, spark.createDataFrame([(k,)], "n int"), [], lambda rows: rows.coalesce(1))
        got = sorted(r.n for r in manifests.read(spark, root, spark.createDataFrame([], "n int").schema).collect())
        assert got == list(range(k + 1))
    number, manifest = manifests.current(spark, root)
    assert number == 10 and sorted(level for level, _ in manifest["levels"]) == [1, 3]
    assert not files.create_once(spark, f"{root}/_manifests/10.json", "{}")

    def refuse():
        raise leases.LeaseLost("gone")

    with pytest.raises(leases.LeaseLost):
        manifests.add(root, spark.createDataFrame([(99,)], "n int"), [], lambda rows: rows, refuse)
    assert manifests.current(spark, root)[0] == 10


def test_lookups_open_only_the_files_that_entries_name(spark, tmp_path):
    """Key filters and time bounds of the entries choose the files; all others may be gone."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout = filled(spark, tmp_path, 40, batches=2)
        jobs.run_full(spark, layout)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    root = Path(layout.layer("mart_page_views"))
    rows = jobs.read_mart(spark, layout, gold.PAGE_VIEWS).cache()
    users = sorted({r.user_id for r in rows.select("user_id").collect()})[:3]
    middle = rows.agg(F.percentile_approx(F.col("event_time").cast("timestamp"), 0.5)).first()[0]
    want = {}
    for user in users:
        own = rows.filter(F.col("user_id") == user)
        later = own.filter(F.col("event_time") >= F.lit(middle).cast("timestamp_ntz"))
        earlier = own.filter(F.col("event_time") < F.lit(middle).cast("timestamp_ntz"))
        want[user] = [sorted(map(tuple, x.collect()), key=repr) for x in (own, later, earlier)]
        assert want[user][0]
    # The session's zone is UTC, so the wall clock is the time.
    at = datetime.fromisoformat(spark.range(1).select(F.lit(middle).cast("string")).first()[0])
    every = {str(f.relative_to(root)) for f in root.rglob("*.parquet")}

    def found(user, **bounds):
        return sorted(map(tuple, jobs.lookup(spark, layout, gold.PAGE_VIEWS, user, **bounds).collect()), key=repr)

    named = {u: jobs.lookup(spark, layout, gold.PAGE_VIEWS, u).inputFiles() for u in users}
    for user in users:
        assert 0 < len(named[user]) < len(every)
        assert [found(user), found(user, since=at), found(user, before=at)] == want[user]
    assert len(jobs.lookup(spark, layout, gold.PAGE_VIEWS, users[0], since=at).inputFiles()) < len(every)
    assert found("nobody") == []
    rows.unpersist()
    keep = {f.split(str(root) + "/", 1)[1] for f in named[users[0]]}
    for f in every - keep:
        (root / f).unlink()
    assert found(users[0]) == want[users[0]][0]


def test_lookups_read_files_of_entries_without_key_parts(spark, tmp_path):
    layout = filled(spark, tmp_path, 12)
    jobs.run_full(spark, layout)
    rows = jobs.read_mart(spark, layout, gold.PAGE_VIEWS)
    user = rows.first().user_id
    for entry in Path(layout.layer("mart_page_views")).glob("_commits/*.json"):
        lines = [json.loads(x) for x in entry.read_text().splitlines()]
        assert all(x["parts"] == sorted(set(x["parts"])) for x in lines if "file" in x)
        crc = entry.with_name(f".{entry.name}.crc")
        if crc.exists():
            crc.unlink()
        entry.write_text("".join(json.dumps({k: v for k, v in x.items() if k not in ("parts", "last_time", "first_time")}) + "\n" for x in lines))
    got = jobs.lookup(spark, layout, gold.PAGE_VIEWS, user, since=datetime(2000, 1, 1), before=datetime(2100, 1, 1))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, rows.filter(F.col("user_id") == user).collect()), key=repr)
    jobs.compact(spark, layout, least=1)
    assert jobs.lookup(spark, layout, gold.PAGE_VIEWS, user).count() == got.count()
    empty = jobs.Layout(str(tmp_path / "none"))
    assert jobs.lookup(spark, empty, gold.PAGE_VIEWS, user).count() == 0
