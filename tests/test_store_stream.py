"""Snapshot store, drift-tolerant lake reads, and the streaming refresh."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.plans import batch, refresh, store
from cartwheel.schemas import ITEMS_TABLE, LAKE_EDITS, LAKE_ITEMS, ORDER_TABLES, PRODUCT_TABLE, TRENDING_TABLE
from cartwheel.session import scratch_path
from cartwheel.sources import files, lake
from cartwheel.streaming import refresh as stream


def _lake_rows(spark, order_ids):
    rows = [(o, 1, 1, 0, 5, None, "prior", o * 10, f"p{o}", 1, "a", 1, "d", 1, 0, None)
            for o in order_ids]
    return spark.createDataFrame(rows, LAKE_ITEMS).withColumn(
        "ingested_at", F.lit("2024-01-01 00:00:00.123").cast("timestamp_ntz"))


def _files(spark, folder):
    return files.input_paths(spark.read.schema(LAKE_ITEMS).parquet(folder)) if files.exists(spark, folder) else []


def test_publish_then_failed_refresh_keeps_previous(spark):
    root = scratch_path(spark, "wh")
    v1 = refresh.refresh_orders(spark, _lake_rows(spark, [1, 2, 3]), root, register_catalog=False)
    assert store.current_version(spark, root) == v1

    bad = _lake_rows(spark, [4]).withColumn(
        "order_id", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception):
        refresh.refresh_orders(spark, bad, root, register_catalog=False)
    assert store.current_version(spark, root) == v1
    assert refresh.load_orders(spark, root).items.count() == 3


def test_catalog_tables_follow_the_snapshot(spark):
    root = scratch_path(spark, "wh")
    refresh.refresh_orders(spark, _lake_rows(spark, [1, 2]), root)
    assert spark.table(f"{store.DATABASE}.{ITEMS_TABLE}").count() == 2
    refresh.refresh_orders(spark, _lake_rows(spark, [1, 2, 3, 4]), root)
    assert spark.table(f"{store.DATABASE}.{ITEMS_TABLE}").count() == 4
    names = {r.tableName for r in store.list_tables(spark, "orders*").collect()}
    assert {ITEMS_TABLE, PRODUCT_TABLE} <= names


def test_written_tables_are_sorted_files(spark):
    root = scratch_path(spark, "wh")
    refresh.refresh_orders(spark, _lake_rows(spark, [5, 3, 9, 1]), root, register_catalog=False)
    items = refresh.load_orders(spark, root).items
    per_file = items.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.collect_list("order_id").alias("ids")).collect()
    for r in per_file:
        assert r.ids == sorted(r.ids)


def _drifting(spark, d):
    """Files of one lake whose types disagree; one of pandas with a column of nulls."""
    spark.createDataFrame([(1, 10, "a")], "order_id long, product_id long, product_name string").coalesce(1).write.parquet(d)
    spark.createDataFrame([(2, 20.0, "b")], "order_id long, product_id double, product_name string").coalesce(1) \
         .write.mode("append").parquet(d)
    spark.createDataFrame([("3", 30)], "order_id string, product_id int").coalesce(1).write.mode("append").parquet(d)
    import pandas as pd
    pd.DataFrame({"order_id": [4], "product_id": [40], "product_name": [None], "reordered": [1.0]}) \
      .to_parquet(d.replace("file:", "") + "/pandas.parquet", index=False)


def test_drifting_lake_is_one_table(spark):
    d = scratch_path(spark, "drift")
    _drifting(spark, d)
    df, paths = lake.read_lake(spark, d)
    assert len(paths) == 4 and df.schema == LAKE_ITEMS
    got = sorted((r.order_id, r.product_id, r.product_name, r.reordered) for r in df.collect())
    assert got == [(1, 10, "a", None), (2, 20, "b", None), (3, 30, None, None), (4, 40, None, 1)]
    some, _ = lake.read_lake(spark, d, names=["pandas.parquet", "not there"])
    assert [r.order_id for r in some.collect()] == [4]
    rest, _ = lake.read_lake(spark, d, skip={p for p in paths if p.endswith("pandas.parquet")})
    assert sorted(r.order_id for r in rest.collect()) == [1, 2, 3]


def test_drifting_lake_through_batch_and_stream(spark):
    base = scratch_path(spark, "drift")
    _drifting(spark, f"{base}/lake")
    batch.run_orders_batch(spark, f"{base}/lake", f"{base}/wh", register_catalog=False)
    stream.start_order_refresh(spark, f"{base}/lake", f"{base}/wh2", f"{base}/ckpt", register_catalog=False).awaitTermination()
    rows = [sorted((r.order_id, r.product_id) for r in refresh.load_orders(spark, f"{base}/{wh}").items.collect()) for wh in ("wh", "wh2")]
    assert rows[0] == rows[1] == [(1, 10), (2, 20), (3, 30), (4, 40)]


def test_files_that_land_after_the_listing_are_not_read(spark):
    d = scratch_path(spark, "late")
    lake.land_items(_lake_rows(spark, [1]), d)
    df, paths = lake.read_lake(spark, d)
    lake.land_items(_lake_rows(spark, [2]), d)
    assert paths and [r.order_id for r in df.collect()] == [1]


def test_footers_of_a_store_unknown_to_tasks(spark, monkeypatch):
    def nowhere():
        def place(path):
            raise ValueError(path)
        return place
    d = scratch_path(spark, "strange")
    _drifting(spark, d)
    monkeypatch.setattr(files, "_opener", nowhere)
    df, _ = lake.read_lake(spark, d)
    assert sorted(r.order_id for r in df.collect()) == [1, 2, 3, 4]


def test_absent_lake_has_no_rows(spark):
    df, paths = lake.read_lake(spark, scratch_path(spark, "nothing"))
    assert df.count() == 0 and paths == []


def test_stream_batches_replace_the_snapshot(spark):
    base = scratch_path(spark, "stream")
    lake_dir, root, ckpt = f"{base}/lake", f"{base}/wh", f"{base}/ckpt"
    lake.land_items(_lake_rows(spark, [1, 2, 3]), lake_dir)
    stream.start_order_refresh(spark, lake_dir, root, ckpt, register_catalog=False).awaitTermination()
    first = store.current_version(spark, root)
    assert refresh.load_orders(spark, root).items.count() == 3

    # no new file: no batch, snapshot unchanged
    stream.start_order_refresh(spark, lake_dir, root, ckpt, register_catalog=False).awaitTermination()
    assert store.current_version(spark, root) == first

    # new files only: the next snapshot holds just them
    lake.land_items(_lake_rows(spark, [7, 8]), lake_dir)
    stream.start_order_refresh(spark, lake_dir, root, ckpt, register_catalog=False).awaitTermination()
    assert store.current_version(spark, root) != first
    ids = sorted(r.order_id for r in refresh.load_orders(spark, root).items.collect())
    assert ids == [7, 8]


def test_retry_of_a_committed_batch_runs_nothing(spark):
    root = scratch_path(spark, "wh")
    df = _lake_rows(spark, [1, 2])
    version = refresh.refresh_orders(spark, df, root, register_catalog=False, batch="ckpt#0")
    bad = df.withColumn("order_id", F.raise_error(F.lit("boom")).cast("long"))
    assert refresh.refresh_orders(spark, bad, root, register_catalog=False, batch="ckpt#0") == version
    with pytest.raises(Exception):
        refresh.refresh_orders(spark, bad, root, register_catalog=False, batch="ckpt#1")
    assert refresh.load_orders(spark, root).items.count() == 2
    assert store.is_committed(spark, root, "ckpt#0") and not store.is_committed(spark, root, "ckpt#1")


def _catalog(spark):
    return sorted(r.order_id for r in spark.table(f"{store.DATABASE}.{ITEMS_TABLE}").collect())


def _failing(monkeypatch, name, after=False):
    """Make one step of the store fail once, before or after it is done."""
    real, calls = getattr(store, name), []

    def step(*args, **kwargs):
        calls.append(name)
        if len(calls) == 1:
            if after:
                real(*args, **kwargs)
            raise RuntimeError("the process ends here")
        return real(*args, **kwargs)
    monkeypatch.setattr(store, name, step)


@pytest.mark.parametrize("step, after", [("note_written", False), ("note_written", True), ("commit", False),
                                         ("show_newest", False), ("show_newest", True), ("note_switched", False)])
def test_batch_that_fails_anywhere_is_carried_on(spark, monkeypatch, step, after):
    root = scratch_path(spark, "wh")
    refresh.refresh_orders(spark, _lake_rows(spark, [1]), root, batch="ckpt#0")
    assert _catalog(spark) == [1]
    with monkeypatch.context() as m:
        _failing(m, step, after)
        with pytest.raises(RuntimeError):
            refresh.refresh_orders(spark, _lake_rows(spark, [2, 3]), root, batch="ckpt#1")
    written = []
    monkeypatch.setattr(store, "write_sorted", lambda *a, real=store.write_sorted, **k: (written.append(a[1]), real(*a, **k)))
    version = refresh.refresh_orders(spark, _lake_rows(spark, [2, 3]), root, batch="ckpt#1")
    assert store.current_version(spark, root) == store.live_version(spark) == version
    assert _catalog(spark) == [2, 3] and refresh.load_orders(spark, root).items.count() == 2
    assert len(list(store.commits(spark, root))) == 2
    assert bool(written) == (step == "note_written" and not after)  # tables that are written are not written again


@pytest.mark.parametrize("fails", ["show_newest", "note_switched"])
def test_replay_after_a_later_commit_does_not_publish_older_data(spark, monkeypatch, fails):
    root = scratch_path(spark, "wh")
    with monkeypatch.context() as m:
        _failing(m, fails)
        with pytest.raises(RuntimeError):
            refresh.refresh_orders(spark, _lake_rows(spark, [1]), root, batch="ckpt#0")
    later = refresh.refresh_orders(spark, _lake_rows(spark, [5, 6]), root)          # a batch run in between
    refresh.refresh_orders(spark, _lake_rows(spark, [1]), root, batch="ckpt#0")     # the replay
    assert store.current_version(spark, root) == store.live_version(spark) == later
    assert _catalog(spark) == [5, 6]


def test_commit_order_rests_on_numbers(spark):
    root = scratch_path(spark, "wh")
    assert [store.commit(spark, root, v, register_catalog=False) for v in ("z", "a", "m")] == [0, 1, 2]
    assert store.current_version(spark, root) == "m"
    # a record that a writer has begun holds its number and is not read
    fs, path = store._fs(spark, f"{root}/commits/orders/{3:012d}")
    fs.create(path, False).close()
    assert store.current_version(spark, root) == "m"
    assert store.create_record(spark, f"{root}/commits/orders/{2:012d}", {}) is False
    assert store.commit(spark, root, "n", register_catalog=False) == 4
    assert store.current_version(spark, root) == "n"


def test_readers_never_see_two_snapshots(spark, monkeypatch):
    """Read all four tables through the catalog after every catalog statement of a commit."""
    root = scratch_path(spark, "wh")
    refresh.refresh_orders(spark, _lake_rows(spark, [1, 2]), root)
    seen = []

    def sizes():
        counts = [spark.table(f"{store.DATABASE}.{t}") for t in ORDER_TABLES]
        items, product, department, _ = counts
        return (items.count(), product.count(), department.agg(F.sum("total_order_lines")).first()[0])

    class Watched:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            out = spark.sql(text)
            seen.append(sizes())
            return out
    assert sizes() == (2, 2, 2)
    refresh.refresh_orders(spark, _lake_rows(spark, [1, 2, 3, 4, 5]), root, register_catalog=False)
    store.show_newest(Watched(), root)
    assert set(seen) == {(2, 2, 2), (5, 5, 5)} and seen == sorted(seen) and sizes() == (5, 5, 5)


def test_new_checkpoint_publishes_again(spark):
    base = scratch_path(spark, "again")
    lake_dir, root = f"{base}/lake", f"{base}/wh"
    lake.land_items(_lake_rows(spark, [1, 2]), lake_dir)
    stream.start_order_refresh(spark, lake_dir, root, f"{base}/c1", register_catalog=False).awaitTermination()
    first = store.current_version(spark, root)
    assert store.is_committed(spark, root, f"{base}/c1#0")
    assert not store.is_committed(spark, root, f"{base}/c1#1") and not store.is_committed(spark, root, f"{base}/c2#0")
    old = refresh.load_orders(spark, root)
    # a new checkpoint over an old root starts at batch 0 again, in folders of its own
    stream.start_order_refresh(spark, lake_dir, root, f"{base}/c2", register_catalog=False).awaitTermination()
    assert store.current_version(spark, root) != first
    assert old.items.count() == 2 and refresh.load_orders(spark, root).items.count() == 2


def test_orders_and_edits_share_a_root(spark):
    root = scratch_path(spark, "wh")
    edits = spark.createDataFrame([(1, "A", "u", False, 3, "t")], LAKE_EDITS)
    refresh.refresh_orders(spark, _lake_rows(spark, [1]), root)
    refresh.refresh_edits(spark, edits, root)
    assert refresh.load_orders(spark, root).items.count() == 1
    assert spark.table(f"{store.DATABASE}.{TRENDING_TABLE}").first().title == "A" and _catalog(spark) == [1]


def test_failed_delete_neither_fails_the_run_nor_is_forgotten(spark, monkeypatch):
    base = scratch_path(spark, "clean")
    lake_dir, root = f"{base}/lake", f"{base}/wh"
    lake.land_items(_lake_rows(spark, [1, 2]), lake_dir)
    with monkeypatch.context() as m:
        m.setattr(files, "deleted", lambda paths: paths.select("path", F.lit("locked").alias("error")))
        m.setattr(batch, "_delete", lambda *a: False)
        version = batch.run_orders_batch(spark, lake_dir, root, cleanup=True, register_catalog=False)
        assert version == store.current_version(spark, root) and _files(spark, lake_dir)
        assert batch.run_orders_batch(spark, lake_dir, root, cleanup=True, register_catalog=False) is None  # not read twice
        assert batch.pending_files(spark, root) == set(_files(spark, lake_dir))
        lake.land_items(_lake_rows(spark, [3]), lake_dir)
        batch.run_orders_batch(spark, lake_dir, root, cleanup=True, register_catalog=False)
        assert [r.order_id for r in refresh.load_orders(spark, root).items.collect()] == [3]
        assert store.retain(spark, root, 1) == []  # a commit with files to delete stays
    assert batch.remove_consumed(spark, root) == 0
    assert _files(spark, lake_dir) == [] and batch.pending_files(spark, root) == set()


def test_files_not_yet_published_are_not_deleted(spark, monkeypatch):
    base = scratch_path(spark, "clean")
    lake_dir, root = f"{base}/lake", f"{base}/wh"
    lake.land_items(_lake_rows(spark, [1]), lake_dir)
    _failing(monkeypatch, "commit")
    with pytest.raises(RuntimeError):
        batch.run_orders_batch(spark, lake_dir, root, cleanup=True, register_catalog=False)
    assert batch.remove_consumed(spark, root) == 0 and len(_files(spark, lake_dir)) >= 1
    assert batch.run_orders_batch(spark, lake_dir, root, cleanup=True, register_catalog=False)
    assert refresh.load_orders(spark, root).items.count() == 1 and _files(spark, lake_dir) == []


def test_retention_keeps_the_last_and_the_live_snapshots(spark, monkeypatch):
    root = scratch_path(spark, "wh")
    versions = [refresh.refresh_orders(spark, _lake_rows(spark, range(n)), root) for n in (1, 2, 3)]
    with monkeypatch.context() as m:
        _failing(m, "show_newest")
        with pytest.raises(RuntimeError):
            refresh.refresh_orders(spark, _lake_rows(spark, range(4)), root)   # committed, not shown
    assert store.live_version(spark) == versions[2]
    assert store.retain(spark, root, 1) == [versions[1], versions[0]]
    assert _catalog(spark) == [0, 1, 2]
    assert refresh.load_orders(spark, root).items.count() == 4
    assert not files.exists(spark, store.table_path(root, ITEMS_TABLE, versions[0]))
    store.show_newest(spark, root)
    assert store.retain(spark, root, 1) == [versions[2]] and _catalog(spark) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        store.retain(spark, root, 0)


def test_stream_archives_consumed_files(spark):
    base = scratch_path(spark, "stream")
    lake_dir, root, ckpt, arch = f"{base}/lake", f"{base}/wh", f"{base}/ckpt", f"{base}/archive"
    lake.land_items(_lake_rows(spark, [1]), lake_dir)
    stream.start_order_refresh(spark, lake_dir, root, ckpt, clean_source="archive",
                               archive_dir=arch, register_catalog=False).awaitTermination()
    lake.land_items(_lake_rows(spark, [2]), lake_dir)
    stream.start_order_refresh(spark, lake_dir, root, ckpt, clean_source="archive",
                               archive_dir=arch, register_catalog=False).awaitTermination()
    # archiving lags one batch: the first batch's files have moved by now
    assert _files(spark, lake_dir)
    archived = (spark.read.schema(LAKE_ITEMS).option("recursiveFileLookup", "true")
                .parquet(arch))
    assert archived.filter(F.col("order_id") == 1).count() >= 1


def test_batch_run_lists_reads_and_cleans(spark):
    base = scratch_path(spark, "batch")
    lake_dir, root = f"{base}/lake", f"{base}/wh"
    assert batch.run_orders_batch(spark, lake_dir, root) is None          # S5
    lake.land_items(_lake_rows(spark, [1, 2]), lake_dir)
    lake.land_items(_lake_rows(spark, [2, 3]), lake_dir)
    version = batch.run_orders_batch(spark, lake_dir, root, cleanup=True,
                                           register_catalog=False)
    assert version == store.current_version(spark, root)
    assert refresh.load_orders(spark, root).items.count() == 4                   # T24
    assert _files(spark, lake_dir) == []                       # S13
    assert batch.run_orders_batch(spark, lake_dir, root) is None
    assert store.current_version(spark, root) == version


def test_land_documents_refuses_an_empty_payload(spark):
    from cartwheel.sources import documents as D
    base = scratch_path(spark, "docs")
    spark.createDataFrame([('{"orders": []}',)], "value string").coalesce(1) \
         .write.text(f"{base}/empty")
    with pytest.raises(ValueError):
        D.land_order_documents(spark, f"{base}/empty", f"{base}/lake")
    spark.createDataFrame([('[{"order_id": 1, "products": [{"product_id": 2}]}]',)],
                          "value string").coalesce(1).write.text(f"{base}/one")
    D.land_order_documents(spark, f"{base}/one", f"{base}/lake")
    rows = lake.read_lake(spark, f"{base}/lake")[0].collect()
    assert [(r.order_id, r.product_id) for r in rows] == [(1, 2)]
    assert rows[0].ingested_at is not None


def test_edit_documents_land_and_refresh(spark):
    import json
    from cartwheel.sources import documents as D
    base = scratch_path(spark, "edits")
    docs = [json.dumps({"query": {"recentchanges": [
        {"rcid": i, "title": "A" if i % 3 else "B", "newlen": i, "oldlen": 0,
         **({"bot": ""} if i % 2 else {})} for i in range(1, 7)]}})]
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(f"{base}/docs")
    rejects = D.land_edit_documents(spark, f"{base}/docs", f"{base}/lake")
    assert rejects.count() == 0
    version = batch.run_edits_batch(spark, f"{base}/lake", f"{base}/wh", cleanup=True,
                                          register_catalog=False)
    rows = {r.title: r for r in store.read_published(spark, f"{base}/wh", TRENDING_TABLE, version).collect()}
    assert (rows["A"].total_edits, rows["A"].total_bytes_changed) == (4, 1 + 2 + 4 + 5)
    assert (rows["B"].total_edits, rows["B"].bot_edits) == (2, 1)
    assert _files(spark, f"{base}/lake") == []


def test_cli_land_refresh_question(spark, capsys):
    import json
    from cartwheel.__main__ import main
    base = scratch_path(spark, "cli")
    doc = json.dumps([{"order_id": 1, "user_id": 7, "order_number": 1, "order_dow": 0,
                       "order_hour_of_day": 9, "products": [{"product_id": 11, "reordered": 0}]},
                      {"order_id": 2, "user_id": 7, "order_number": 2, "order_dow": 1,
                       "order_hour_of_day": 9, "products": []}])
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(f"{base}/docs")
    main(["land-orders", f"{base}/docs", f"{base}/lake"])
    main(["refresh-orders", f"{base}/lake", f"{base}/wh", "--cleanup", "--keep", "1"])
    main(["question", "q15_freshness", f"{base}/wh", "--out", f"{base}/q15"])
    row = spark.read.parquet(f"{base}/q15").first()
    assert (row.total_orders_in_current_load, row.total_order_lines_in_current_load) == (2, 2)
    assert _files(spark, f"{base}/lake") == []


def test_land_whole_file_documents(spark):
    import json
    import os
    from cartwheel.sources import documents as D
    base = scratch_path(spark, "wholefile")
    local = base.replace("file:", "")
    os.makedirs(f"{local}/docs", exist_ok=True)
    doc = {"total_orders": 2, "orders": [
        {"order_id": 1, "user_id": 3, "products": [{"product_id": 4}, {"product_id": 5}]},
        {"order_id": 2, "user_id": 3, "products": None}]}
    with open(f"{local}/docs/response.json", "w") as fh:
        fh.write(json.dumps(doc, indent=2))            # spans many lines
    D.land_order_documents(spark, f"{base}/docs", f"{base}/lake", whole_file=True)
    rows = sorted((r.order_id, r.product_id) for r in lake.read_lake(spark, f"{base}/lake")[0].collect())
    assert rows == [(1, 4), (1, 5), (2, None)]


def test_scheduled_trigger_picks_up_new_files(spark):
    import time
    base = scratch_path(spark, "scheduled")
    lake_dir, root, ckpt = f"{base}/lake", f"{base}/wh", f"{base}/ckpt"
    lake.land_items(_lake_rows(spark, [1]), lake_dir)
    q = stream.start_order_refresh(spark, lake_dir, root, ckpt, processing_time="1 second",
                                   register_catalog=False)
    try:
        q.processAllAvailable()
        assert refresh.load_orders(spark, root).items.count() == 1
        lake.land_items(_lake_rows(spark, [2, 3]), lake_dir)     # lands while running
        deadline = time.time() + 60
        while time.time() < deadline:
            q.processAllAvailable()
            if store.current_version(spark, root) and \
                    refresh.load_orders(spark, root).items.count() == 2:
                break
            time.sleep(1)
        ids = sorted(r.order_id for r in refresh.load_orders(spark, root).items.collect())
        assert ids == [2, 3]
    finally:
        q.stop()


def test_loading_an_unpublished_warehouse_fails_clearly(spark):
    root = scratch_path(spark, "never-published")
    assert store.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        refresh.load_orders(spark, root)
