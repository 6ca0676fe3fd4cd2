"""Structured Streaming: enrichment over several micro-batches equals the batch
join; replays are idempotent; the profile state stream equals compaction."""
from pyspark.sql import functions as F

from ledgerflow.operators import cdc, enrich
from ledgerflow.operators import profile as profile_ops
from ledgerflow.plans.catalog import staged
from ledgerflow.schemas import CDC_TRANS
from ledgerflow.sources import cdc as cdc_src
from ledgerflow.sources import testdata as td
from ledgerflow.streaming import enrich_stream, profile_stream

from .conftest import SMALL


def _profile(spark):
    st = staged(spark, SMALL)
    return profile_ops.stream_profile(st.account, st.disposition, st.client, st.district)


def test_multi_batch_stream_equals_batch(spark, tmp_dir):
    log = td.cdc_trans(spark, SMALL)
    src = f"{tmp_dir}/src"
    log.repartitionByRange(3, "__lsn").write.parquet(src)
    stream = cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=1)
    out = enrich_stream.run_to_completion(spark, stream, lambda *_: _profile(spark), f"{tmp_dir}/out")
    batch = enrich.route(log, _profile(spark))
    e_stream = sorted(map(tuple, out["enriched"].drop("batch_id").collect()))
    e_batch = sorted(map(tuple, enrich.enriched(batch).collect()))
    assert e_stream == e_batch
    n_dlq = out["dead_letters"].count()
    assert len(e_stream) + n_dlq == log.count()
    m = out["metrics"].agg(F.sum("processed"), F.sum("enriched"), F.sum("dlq")).first()
    assert tuple(m) == (log.count(), len(e_stream), n_dlq)
    assert out["metrics"].select("batch_id").distinct().count() == 3
    assert out["dead_letters"].where(F.col("dlq_published_at").isNull()).count() == 0


def test_batch_replay_overwrites(spark, tmp_dir):
    batch = td.cdc_trans(spark, SMALL)
    outs = enrich_stream.StreamOutputs(f"{tmp_dir}/o")
    writer = enrich_stream.make_batch_writer(spark, lambda *_: _profile(spark), outs)
    writer(batch, 0)
    writer(batch, 0)  # a replay of the same batch id
    assert spark.read.parquet(outs.enriched).count() == enrich.enriched(
        enrich.route(batch, _profile(spark))).count()


def test_json_envelope_with_tombstones(spark, tmp_dir):
    import json
    lines = [json.dumps({"trans_id": 1, "account_id": 5, "amount": 1.5, "__op": "c", "__lsn": 1}),
             json.dumps({"trans_id": 2, "account_id": None, "amount": 2.0, "__op": "u", "__lsn": 2})]
    msgs = spark.createDataFrame([("cdc.public.trans", lines[0]), ("cdc.public.trans", None),
                                  ("cdc.public.trans", lines[1])], "topic string, value string")
    from ledgerflow.schemas import CDC_TRANS
    parsed = cdc_src.parse_envelope(msgs, CDC_TRANS).collect()
    assert [r["trans_id"] for r in parsed] == [1, 2]
    assert all(r["__table"] == "trans" for r in parsed)
    rec = cdc_src.json_records(spark.createDataFrame([(1, None)], "trans_id long, k string")).first()
    assert rec["key"] == "1" and json.loads(rec["value"]) == {"trans_id": 1, "k": None}


def test_profile_state_stream_equals_compaction(spark, tmp_dir):
    log = td.cdc_client(spark, SMALL).withColumn("__table", F.lit("client"))
    src = f"{tmp_dir}/clients"
    log.repartitionByRange(3, "__lsn").write.parquet(src)
    q = profile_stream.start_profile_stream(
        spark, cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=1),
        f"{tmp_dir}/state")
    enrich_stream.drained(q)
    got = profile_stream.ProfileStore(f"{tmp_dir}/state").read_live(spark, "client")
    want = cdc.compact(log.drop("__table"), "client_id")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))


def test_dead_letter_rerun_after_late_profile(spark, tmp_dir):
    log = td.cdc_trans(spark, SMALL)
    prof = _profile(spark)
    dead = enrich.dead_letters(enrich.route(log, prof))
    n_ref = dead.where("dlq_reason = 'referential_violation'").count()
    assert n_ref > 0
    # The late profile rows arrive: every missing account now has a profile.
    missing = dead.where("account_id IS NOT NULL").select("account_id").distinct()
    late = missing.select(*[
        F.col("account_id") if c == "account_id" else
        F.lit(1).cast("bigint").alias(c) if c == "client_id" else
        F.lit(None).cast(prof.schema[c].dataType).alias(c) for c in prof.columns])
    rerun = enrich.rerun_dead_letters(dead, prof.unionByName(late))
    assert enrich.enriched(rerun).count() == n_ref
    assert enrich.dead_letters(rerun).count() == dead.count() - n_ref


def test_snapshot_changes_shape(spark):
    raw = td.raw_tables(spark, SMALL)
    snap = cdc_src.snapshot_changes({"account": raw.account, "district": raw.district})
    from ledgerflow.schemas import CDC_PROFILE
    assert snap.schema.fieldNames() == CDC_PROFILE.fieldNames()
    counts = {r["__table"]: r["count"] for r in snap.groupBy("__table").count().collect()}
    assert counts == {"account": raw.account.count(), "district": raw.district.count()}
    assert snap.where("__lsn <> -1 OR __op <> 'r'").count() == 0


def test_json_file_stream_with_tombstones(spark, tmp_dir):
    import json
    import os
    from ledgerflow.schemas import CDC_TRANS
    src = os.path.join(tmp_dir, "topic")
    os.makedirs(src)
    recs = [{"trans_id": i, "account_id": (None if i == 3 else i % 4), "date": 930101,
             "type": "PRIJEM", "operation": "VKLAD", "amount": 1.0 + i, "__op": "c", "__lsn": i,
             "__source_ts_ms": 1700000000000 + i} for i in range(8)]
    for part in range(2):
        with open(os.path.join(src, f"part-{part}.json"), "w") as f:
            for r in recs[part * 4:(part + 1) * 4]:
                f.write(json.dumps(r) + "\n")
    msgs = cdc_src.json_stream(spark, src, max_files_per_trigger=1)
    parsed = cdc_src.parse_envelope(msgs, CDC_TRANS)
    prof = spark.createDataFrame([(k, 100 + k, 700101, "M", "D", "R", 1.0) for k in range(3)],
                                 "account_id long, client_id long, birth_number long, "
                                 "account_frequency string, district_name string, "
                                 "district_region string, avg_salary double")
    out = enrich_stream.run_to_completion(spark, parsed, lambda *_: prof, os.path.join(tmp_dir, "o"))
    assert out["enriched"].count() + out["dead_letters"].count() == 8
    reasons = {r["dlq_reason"]: r["records"] for r in enrich.dlq_by_reason(out["dead_letters"]).collect()}
    assert reasons == {"missing_account_id": 1, "referential_violation": 1}


def test_warmup_gate_times_out_and_opens(spark, tmp_dir):
    root = f"{tmp_dir}/state"
    assert profile_stream.wait_for_profile(spark, root, min_accounts=1, timeout_s=0) is False
    raw = td.raw_tables(spark, SMALL)
    changes = cdc_src.snapshot_changes({"account": raw.account})
    profile_stream.make_state_writer(spark, profile_stream.ProfileStore(root))(changes, 0)
    n = raw.account.count()
    assert profile_stream.wait_for_profile(spark, root, min_accounts=n, timeout_s=0) is True
    assert profile_stream.wait_for_profile(spark, root, min_accounts=n + 1, timeout_s=0) is False


def test_pluggable_sinks_receive_both_outputs(spark, tmp_dir):
    written = {}

    class Capture:
        def enriched(self, df, batch_id):
            written["enriched"] = df.count()

        def dead_letters(self, df, batch_id):
            written["dlq"] = df.count()
            assert "dlq_published_at" in df.columns and "original_transaction" in df.columns

    batch = td.cdc_trans(spark, SMALL)
    outs = enrich_stream.StreamOutputs(f"{tmp_dir}/o")
    enrich_stream.make_batch_writer(spark, lambda *_: _profile(spark), outs, Capture())(batch, 0)
    assert written["enriched"] + written["dlq"] == batch.count()
    m = spark.read.parquet(outs.metrics).first()
    assert (m["enriched"], m["dlq"]) == (written["enriched"], written["dlq"])


def test_no_message_is_lost(spark, tmp_dir):
    """Enriched and dead letters together are all messages but the tombstones."""
    import json
    from ledgerflow.schemas import CDC_TRANS
    good = json.dumps({"trans_id": 1, "account_id": 1, "amount": 1.5, "__op": "c", "__lsn": 1})
    values = [good, "{broken", json.dumps({"amount": 2.0}), json.dumps({"trans_id": 4, "account_id": None}),
              "[1, 2]", "null", "", json.dumps({"trans_id": "x", "account_id": 1}), None, None]
    src = f"{tmp_dir}/messages"
    spark.createDataFrame([("cdc.public.trans", v) for v in values], "topic string, value string").write.parquet(src)
    stream = cdc_src.parse_envelope(spark.readStream.schema("topic string, value string").parquet(src), CDC_TRANS)
    prof = spark.createDataFrame([(1, 101, 700101, "M", "D", "R", 1.0)], PROFILE)
    out = enrich_stream.run_to_completion(spark, stream, lambda *_: prof, f"{tmp_dir}/o")
    reasons = {r["dlq_reason"]: r["records"] for r in enrich.dlq_by_reason(out["dead_letters"]).collect()}
    assert out["enriched"].count() == 1
    assert reasons == {"unreadable_message": 5, "missing_account_id": 2}
    texts = {r[0] for r in out["dead_letters"].select("original_transaction.__unreadable").collect()}
    assert {"{broken", "[1, 2]", ""} <= texts


PROFILE = ("account_id long, client_id long, birth_number long, account_frequency string, district_name string, "
           "district_region string, avg_salary double")


def test_each_batch_sees_the_profile_as_it_is_then(spark, tmp_dir):
    src, prof = f"{tmp_dir}/src", f"{tmp_dir}/profile"
    log = td.cdc_trans(spark, SMALL).where("account_id IS NOT NULL").limit(40).withColumn("account_id", F.lit(7).cast("long"))
    log.repartition(2, "__lsn").write.parquet(src)
    spark.createDataFrame([], PROFILE).write.parquet(prof)
    calls = []

    def load(keys, batch_id):
        calls.append(1)
        if len(calls) == 2:
            spark.createDataFrame([(7, 70, 700101, "M", "D", "R", 1.0)], PROFILE).write.mode("append").parquet(prof)
        return spark.read.parquet(prof)
    out = enrich_stream.run_to_completion(
        spark, cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=1), load, f"{tmp_dir}/o")
    by_batch = {r["batch_id"]: (r["enriched"], r["dlq"]) for r in out["metrics"].collect()}
    assert by_batch[0][0] == 0 and by_batch[1][1] == 0 and by_batch[1][0] > 0


def test_drained_empty_source_and_cold_state(spark, tmp_dir):
    log = td.cdc_trans(spark, SMALL)
    src = f"{tmp_dir}/none"
    log.limit(0).write.parquet(src)
    profile, version = profile_stream.load_stream_profile(spark, f"{tmp_dir}/nothing")
    assert profile.count() == 0 and version is None
    out = enrich_stream.run_to_completion(spark, cdc_src.parquet_stream(spark, src, log.schema), lambda *_: (profile, version), f"{tmp_dir}/o")
    assert out["enriched"].count() == out["dead_letters"].count() == 0
    assert all(m["processed"] == 0 for m in out["metrics"].collect())
    # A cold state dead-letters what it can't enrich.
    writer = enrich_stream.make_batch_writer(spark, lambda *_: profile_stream.load_stream_profile(spark, f"{tmp_dir}/nothing"),
                                             enrich_stream.StreamOutputs(f"{tmp_dir}/p"), warm=False)
    writer(log, 0)
    m = enrich_stream.read_outputs(spark, f"{tmp_dir}/p")["metrics"].first()
    assert m["enriched"] == 0 and m["dlq"] == log.count() and m["profile_warm"] is False and m["profile_version"] is None


def _client(k, district, op="u", lsn=1, ts=1, **more):
    return {"client_id": k, "birth_number": 700101, "district_id": district, "__op": op, "__lsn": lsn, "__source_ts_ms": ts,
            "__deleted": "true" if op == "d" else "false", "__table": "client", **more}


def _changes(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in CLIENT_FIELDS) for r in rows],
                                 "client_id long, birth_number long, district_id long, __op string, __lsn long, "
                                 "__source_ts_ms long, __deleted string, __table string, partition long, offset long")


CLIENT_FIELDS = ["client_id", "birth_number", "district_id", "__op", "__lsn", "__source_ts_ms", "__deleted", "__table", "partition", "offset"]


def test_state_over_many_versions(spark, tmp_dir):
    store = profile_stream.ProfileStore(f"{tmp_dir}/state")
    batches = [[_client(1, 1), _client(2, 1)], [_client(1, None, "d", 2)], [_client(1, 5, "c", 3), _client(2, 9, lsn=0)],
               [_client(3, 1, ts=1, lsn=4, offset=7), _client(3, 2, ts=1, lsn=4, offset=8)], [_client(2, 4, lsn=5)], [_client(4, 4, "d", 9)]]
    for i, rows in enumerate(batches):
        profile_stream.publish(spark, store, _changes(spark, rows), i)
        profile_stream.publish(spark, store, _changes(spark, rows), i)  # a replay
        assert store.newest(spark) == i
    live = {r.client_id: r.district_id for r in store.read_live(spark, "client").collect()}
    assert live == {1: 5, 2: 4, 3: 2}  # re-created; late change ignored; tie by offset
    assert {r.client_id: r.district_id for r in store.read_live(spark, "client", 1).collect()} == {2: 1}
    # A crash before a version is published leaves the state as it was.
    _changes(spark, [_client(9, 9)]).write.parquet(store.folder(99))
    assert {r.client_id for r in store.read_live(spark, "client").collect()} == {1, 2, 3}


def test_a_table_without_changes_in_a_batch_stays(spark, tmp_dir):
    """A later batch that lacks a table's key column leaves that table as it was."""
    raw, store = td.raw_tables(spark, SMALL), profile_stream.ProfileStore(f"{tmp_dir}/state")
    profile_stream.publish(spark, store, cdc_src.snapshot_changes({"account": raw.account, "client": raw.client}), 0)
    profile_stream.publish(spark, store, _changes(spark, [_client(10**9, 1)]), 1)
    assert store.read_live(spark, "account").count() == raw.account.count()
    assert store.read_live(spark, "client").count() == raw.client.count() + 1


def test_keyed_profile_is_the_whole_one_cut_to_its_keys(spark, tmp_dir):
    raw, root = td.raw_tables(spark, SMALL), f"{tmp_dir}/state"
    tables = {t: getattr(raw, t) for t in ("account", "client", "disposition", "district")}
    profile_stream.publish(spark, profile_stream.ProfileStore(root), cdc_src.snapshot_changes(tables), 0)
    whole, version = profile_stream.load_stream_profile(spark, root)
    keys = spark.createDataFrame([(k,) for k in (0, 3, 5, 8, 10**9)], "account_id long")
    some, same = profile_stream.keyed_profile(spark, root, keys)
    assert version == same == 0
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.join(keys, "account_id", "left_semi").collect())) != []
    # The state is looked up, not put together again: no aggregate but the owners', and keys cut both account tables.
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 2 and plan.count("LeftSemi") == 2
    assert all(f"__table#" in line for line in plan.splitlines() if "Relation" in line and "__key" in line)


def test_gate_opens_at_the_first_version_with_enough(spark, tmp_dir):
    raw, root = td.raw_tables(spark, SMALL), f"{tmp_dir}/state"
    n = raw.account.count()
    for v in range(3):
        part = raw.account.where(F.col("account_id") % 3 == v)
        profile_stream.publish(spark, profile_stream.ProfileStore(root), cdc_src.snapshot_changes({"account": part}), v)
    assert profile_stream.opening_version(spark, root, n // 2, timeout_s=0) == 1
    assert profile_stream.opening_version(spark, root, n, timeout_s=0) == 2
    assert profile_stream.opening_version(spark, root, n + 1, timeout_s=0) is None
    assert profile_stream.wait_for_version(spark, root, 1) == 1
    assert profile_stream.wait_for_version(spark, root, 7, alive=lambda: False) == 2  # its stream has ended


def test_recovery_goes_on_from_the_broken_batch(spark, tmp_dir):
    import os

    import pytest
    from pyspark.errors import StreamingQueryException
    log, src, out = td.cdc_trans(spark, SMALL), f"{tmp_dir}/src", f"{tmp_dir}/out"
    files = cdc_src.arrivals(log.withColumn("a", F.col("trans_id") % 4), "a", 4, src)
    stream = cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=files)

    class Broken(enrich_stream.ParquetSinks):
        def dead_letters(self, df, batch_id):
            if batch_id == 1:
                raise RuntimeError("sink lost")
            super().dead_letters(df, batch_id)
    load = lambda *_: _profile(spark)
    with pytest.raises(StreamingQueryException):
        enrich_stream.start_enrichment(spark, stream, load, out, sinks=Broken(enrich_stream.StreamOutputs(out))).awaitTermination()
    logged = lambda kind: sorted(int(x) for x in os.listdir(f"{out}/_checkpoint/{kind}") if x.isdigit())
    assert logged("offsets") == [0, 1] and logged("commits") == [0]
    got = enrich_stream.run_to_completion(spark, stream, load, out)
    assert logged("commits") == [0, 1, 2, 3]
    ids = [r[0] for r in got["enriched"].select("trans_id").unionByName(got["dead_letters"].select("trans_id")).collect()]
    assert sorted(ids) == sorted(r.trans_id for r in log.select("trans_id").collect())
    assert [r.processed for r in got["metrics"].orderBy("batch_id").collect()] == [
        log.where(F.col("trans_id") % 4 == i).count() for i in range(4)]


def test_deduplication_in_the_stream(spark, tmp_dir):
    schema = "trans_id long, account_id long, ts timestamp"
    rows = [(1, 1, 0), (1, 2, 1), (2, 1, 0), (None, 7, 0), (None, 7, 1), (2, 9, 2), (3, 3, 2), (1, 1, 2)]
    import datetime as dt
    log = spark.createDataFrame([(i, a, dt.datetime(2024, 1, 1, 0, n), n) for i, a, n in rows], schema + ", a int")
    files = cdc_src.arrivals(log, "a", 3, f"{tmp_dir}/src", files=1)
    for name, args in (("whole", {}), ("bounded", {"event_time": "ts", "within": "10 minutes"})):
        stream = cdc_src.parquet_stream(spark, f"{tmp_dir}/src", log.drop("a").schema, max_files_per_trigger=files)
        kept = enrich_stream.deduplicated(stream, **args)
        q = (kept.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/{name}-c")
             .option("path", f"{tmp_dir}/{name}").trigger(availableNow=True).start())
        enrich_stream.drained(q)
        got = sorted((r.trans_id or -1, r.account_id) for r in spark.read.parquet(f"{tmp_dir}/{name}").collect())
        assert got == [(-1, 7), (-1, 7), (1, 1), (2, 1), (3, 3)]


def test_equal_order_gives_one_survivor_in_any_arrangement(spark):
    rows = [_client(1, d) for d in range(6)]
    got = {cdc.compact(_changes(spark, rows[i:] + rows[:i]).repartition(3), "client_id").first().district_id for i in range(6)}
    assert len(got) == 1


def test_two_owners_give_one_enriched_record(spark):
    st = staged(spark, SMALL)
    more = st.disposition.where("disposition_type = 'OWNER'").limit(5)
    both = st.disposition.unionByName(more.withColumn("disp_id", F.col("disp_id") + 1_000_000))
    prof = profile_ops.stream_profile(st.account, both, st.client, st.district)
    assert prof.count() == prof.select("account_id").distinct().count()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    import pytest
    from ledgerflow import session

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(Spark())
    assert session.is_local("local[4]") and session.is_local("local[*]") and not session.is_local("yarn")


def test_large_arrivals_come_in_more_files(spark, tmp_dir, monkeypatch):
    """Two files of an arrival were two tasks, however many rows it had."""
    monkeypatch.setattr(cdc_src, "FILE_ROWS", 100)
    log = spark.range(0, 2000, 1, 4).selectExpr("id", "cast(id % 2 as int) a")
    files = cdc_src.arrivals(log, "a", 2, f"{tmp_dir}/src")
    assert files == 10
    written = spark.read.parquet(f"{tmp_dir}/src")
    assert written.count() == 2000 and len(written.inputFiles()) == 20
    assert cdc_src.arrivals(log.where("id < 900"), "a", 2, f"{tmp_dir}/few") == 4
    assert cdc_src.arrivals(log.where("id < 20"), "a", 2, f"{tmp_dir}/two") == 2


def test_state_of_a_stream_is_on_disk(spark, tmp_dir):
    """Keys of the deduplication were maps in executor memory; the session's settings stay as they were."""
    log = spark.createDataFrame([(i % 5, i % 2) for i in range(10)], "trans_id long, account_id long")
    src = f"{tmp_dir}/src"
    log.write.parquet(src)
    key = enrich_stream.STATE_STORE

    def provider(root):
        stream = enrich_stream.deduplicated(cdc_src.parquet_stream(spark, src, log.schema))
        query = enrich_stream.start_enrichment(spark, _transactions(stream), lambda *_: _profile(spark), root)
        enrich_stream.drained(query)
        assert enrich_stream.read_outputs(spark, root)["metrics"].agg(F.sum("processed")).first()[0] == 5
        return query.lastProgress["stateOperators"][0]["customMetrics"]

    assert any("rocksdb" in m for m in provider(f"{tmp_dir}/out"))
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert not any("rocksdb" in m for m in provider(f"{tmp_dir}/own"))
        assert "HDFSBacked" in spark.conf.get(key)
    finally:
        spark.conf.unset(key)


def _transactions(rows):
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in CDC_TRANS.fields])
