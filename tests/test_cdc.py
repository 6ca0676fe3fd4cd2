"""CDC compaction (ST-1, ST-2, A-7) on a hand-written change log."""
from ledgerflow.operators import cdc

LOG_SCHEMA = ("client_id long, birth_number long, district_id long, __op string, __lsn long, "
              "__source_ts_ms long, __deleted string")


def test_upsert_delete_recreate(spark):
    log = spark.createDataFrame([
        (1, 700101, 1, "c", 1, 10, "false"), (1, 700101, 2, "u", 2, 20, "false"),
        (1, 700101, 3, "u", 3, 30, "false"), (1, None, None, "d", 4, 40, "true"),   # key-only delete
        (2, 755502, 5, "c", 5, 50, "false"), (2, 755502, 6, "u", 7, 70, "false"),
        (2, 755502, 9, "u", 6, 60, "false"),                                         # late, older
        (3, 700101, 1, "c", 8, 80, "false"), (3, None, None, "d", 9, 90, "true"),
        (3, 700101, 4, "c", 10, 100, "false"),                                       # re-create
        (4, 700101, 7, "u", None, 5, "false"), (4, 700101, 8, "u", 11, 1, "false"),  # NULL lsn oldest
        (None, 1, 1, "c", 12, 1, "false"),
    ], LOG_SCHEMA)
    live = {r["client_id"]: r for r in cdc.compact(log, "client_id").collect()}
    assert set(live) == {2, 3, 4}
    assert live[2]["district_id"] == 6
    assert live[3]["district_id"] == 4
    assert live[4]["district_id"] == 8
    counts = cdc.state_counts("client", log, "client_id").first()
    assert (counts["log_rows"], counts["keys_seen"], counts["live_rows"], counts["tombstones"]) == \
        (13, 4, 3, 1)


def test_owner_link_type_change_and_delete(spark):
    log = spark.createDataFrame([
        (10, 100, 1, "OWNER", "c", 1, 1, "false"),
        (10, 100, 1, "DISPONENT", "u", 2, 2, "false"),   # OWNER -> DISPONENT removes the link
        (11, 101, 2, "OWNER", "c", 3, 3, "false"),
        (11, None, None, None, "d", 4, 4, "true"),       # key-only delete
        (12, 102, 3, "OWNER", "c", 5, 5, "false"),
        (13, 103, 3, "OWNER", "c", 6, 6, "false"),       # newer owner of account 3 wins
    ], "disp_id long, client_id long, account_id long, type string, __op string, __lsn long, "
       "__source_ts_ms long, __deleted string")
    links = {r["account_id"]: r["client_id"] for r in cdc.owner_links(log).collect()}
    assert links == {3: 103}


def test_compaction_is_order_and_partition_independent(spark):
    rows = [(i % 7, 700101, i, "u", i, i, "true" if i % 11 == 0 else "false") for i in range(200)]
    a = cdc.compact(spark.createDataFrame(rows, LOG_SCHEMA).repartition(5), "client_id")
    b = cdc.compact(spark.createDataFrame(list(reversed(rows)), LOG_SCHEMA).coalesce(1), "client_id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
