"""Stream-table enrichment queries, run through Structured Streaming.

Each builder drains the ``events`` file stream with ``availableNow`` through
the two-output ``foreachBatch`` writer into a fresh folder below the shared
work directory, then returns the written output.
"""

from __future__ import annotations

import math

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators import enrich
from ..operators import profile as profile_ops
from ..schemas import CDC_PROFILE, CDC_TRANS, STATE_COLUMNS, STATE_KEYS
from ..session import scratch_path
from ..sources import cdc as cdc_src
from ..streaming import enrich_stream, metrics, profile_stream
from ..sources import testdata as td
from . import oracle as O
from .catalog import register, staged



def _routed(log: str, profile: str) -> str:
    """A log's records with the profile of their account and the reason of those without one."""
    return f"""
    SELECT t.*, p.client_id, p.birth_number, p.account_frequency, p.district_name,
      p.district_region, p.avg_salary,
      CASE WHEN t.account_id IS NULL THEN 'missing_account_id'
           WHEN p.client_id IS NULL THEN 'referential_violation' END AS dlq_reason
    FROM {log} t LEFT JOIN {profile} p ON t.account_id = p.account_id"""


def _profile(owners: str, clients: str, accounts: str = "raw_account") -> str:
    """One row for each account with an owner: the district is the client's, else the account's."""
    return f"""
    WITH held AS (
      SELECT o.account_id, c.client_id, c.birth_number, c.district_id AS own_district
      FROM {owners} o, {clients} c WHERE c.client_id = o.client_id)
    SELECT a.account_id, held.client_id, held.birth_number, a.frequency AS account_frequency,
      d.name AS district_name, d.region AS district_region, d.avg_salary
    FROM held INNER JOIN {accounts} a USING (account_id)
    LEFT JOIN raw_district d ON d.district_id = ifnull(held.own_district, a.district_id)"""


_OWNERS = """
    SELECT account_id, arg_max(client_id, disp_id) AS client_id
    FROM raw_disposition WHERE type = 'OWNER' GROUP BY account_id"""
PROFILE_CTE = {"owner_now": _OWNERS, "stream_profile": _profile("owner_now", "raw_client"),
                "routed": _routed("cdc_trans_log", "stream_profile")}


CHANGE_FILES = 6         # files of a change log in these queries, one micro-batch each


def _profile_loader(spark, sf_dir):
    """Built anew for each micro-batch, so that it sees the tables as they are then."""
    def load(keys, batch_id):
        st = staged(spark, sf_dir)
        return profile_ops.stream_profile(st.account, st.disposition, st.client, st.district, keys)
    return load


def _both_sides(out):
    """Records of both outputs with the reason of those that are dead."""
    rest = [c for c in ("trans_id", "account_id", "date", "amount", "k_symbol")]
    dead = out["dead_letters"].select(*[F.col(f"original_transaction.{c}").alias(c) for c in rest],
                                      F.lit(None).cast("long").alias("client_id"), "dlq_reason")
    return out["enriched"].select(*rest, "client_id", F.lit(None).cast("string").alias("dlq_reason")).unionByName(dead)


def run_stream(spark, sf_dir) -> dict:
    out = scratch_path(spark, "enrich-stream")
    return enrich_stream.run_to_completion(
        spark, cdc_src.events_stream(spark, sf_dir), _profile_loader(spark, sf_dir), out)


@register("stream_enriched", O.with_base("""
    SELECT trans_id, account_id, date, type, operation, amount, balance, k_symbol, client_id,
      birth_number, account_frequency, district_name, district_region, avg_salary,
      __op, __lsn, __source_ts_ms, true AS __enriched
    FROM routed WHERE dlq_reason IS NULL""", PROFILE_CTE))
def stream_enriched(spark, sf_dir):
    return run_stream(spark, sf_dir)["enriched"].drop("batch_id")


_ORIG = ["trans_id", "account_id", "date", "type", "operation", "amount", "balance", "k_symbol",
         "bank", "account", "__op", "__table", "__lsn", "__source_ts_ms", "__deleted"]


@register("stream_dlq", O.with_base(
    "SELECT dlq_reason, trans_id, account_id, __source_ts_ms, "
    + ", ".join(f"{c} AS orig_{c}" for c in _ORIG)
    + " FROM routed WHERE dlq_reason IS NOT NULL", PROFILE_CTE))
def stream_dlq(spark, sf_dir):
    dl = run_stream(spark, sf_dir)["dead_letters"]
    orig = dl.schema["original_transaction"].dataType.fieldNames()
    return dl.select("dlq_reason", "trans_id", "account_id", "__source_ts_ms",
                     *[F.col(f"original_transaction.{c}").alias(f"orig_{c}") for c in orig])


@register("dlq_by_reason", O.with_base("""
    SELECT dlq_reason, CAST(count(*) AS BIGINT) AS records
    FROM routed WHERE dlq_reason IS NOT NULL GROUP BY dlq_reason""", PROFILE_CTE))
def dlq_by_reason(spark, sf_dir):
    return enrich.dlq_by_reason(run_stream(spark, sf_dir)["dead_letters"])


@register("stream_metrics", O.with_base("""
    SELECT CAST(count(*) AS BIGINT) AS processed,
      CAST(count(*) FILTER (WHERE dlq_reason IS NULL) AS BIGINT) AS enriched,
      CAST(count(*) FILTER (WHERE dlq_reason IS NOT NULL) AS BIGINT) AS dlq,
      CAST(count(*) FILTER (WHERE dlq_reason = 'missing_account_id') AS BIGINT)
        AS dlq_missing_account,
      CAST(count(*) FILTER (WHERE dlq_reason IS NULL) AS DOUBLE) * 100.0
        / CAST(count(*) AS DOUBLE) AS success_rate_pct
    FROM routed""", PROFILE_CTE))
def stream_metrics(spark, sf_dir):
    m = run_stream(spark, sf_dir)["metrics"]
    s = m.agg(*[F.sum(c).cast("bigint").alias(c)
                for c in ("processed", "enriched", "dlq", "dlq_missing_account")])
    return s.withColumn("success_rate_pct", F.when(
        F.col("processed") > 0,
        F.col("enriched").cast("double") * F.lit(100.0) / F.col("processed").cast("double")))


@register("enrich_batch", O.with_base("""
    SELECT dlq_reason, CAST(count(*) AS BIGINT) AS records FROM routed GROUP BY dlq_reason""",
    PROFILE_CTE))
def enrich_batch(spark, sf_dir):
    """J-5 in batch form over the whole CDC log (the re-run path for late profiles, ST-7)."""
    st = staged(spark, sf_dir)
    prof = profile_ops.stream_profile(st.account, st.disposition, st.client, st.district)
    routed = enrich.route(td.cdc_trans(spark, sf_dir), prof)
    return routed.groupBy("dlq_reason").agg(F.count(F.lit(1)).cast("bigint").alias("records"))


@register("stream_profile_state", O.with_base("""
    SELECT client_id, birth_number, district_id, __op, __lsn, __source_ts_ms, __deleted
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id
                                       ORDER BY __lsn DESC, __source_ts_ms DESC) AS rn
          FROM cdc_client_log WHERE client_id IS NOT NULL)
    WHERE rn = 1 AND NOT (__deleted = 'true' OR __op = 'd')"""))
def stream_profile_state(spark, sf_dir):
    """ST-1 as a stream: the client change log, cut into lsn-ordered files, is
    merged batch by batch into the bucketed state table; live rows returned."""
    log = td.cdc_client(spark, sf_dir).withColumn("__table", F.lit("client"))
    src = scratch_path(spark, "client-cdc")
    log.repartition(CHANGE_FILES, "client_id").write.mode("overwrite").parquet(src)
    root = scratch_path(spark, "profile-state")
    changes = cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=1)
    q = profile_stream.start_profile_stream(spark, changes, root)
    enrich_stream.drained(q)
    return profile_stream.ProfileStore(root).read_live(spark, "client")


_E2E_CTES = {
    "client_changes": """
      SELECT client_id, birth_number, district_id, 'r' AS __op, CAST(-1 AS BIGINT) AS __lsn,
        CAST(0 AS BIGINT) AS __source_ts_ms, 'false' AS __deleted FROM raw_client
      UNION ALL
      SELECT client_id, birth_number, district_id, __op, __lsn, __source_ts_ms, __deleted
      FROM cdc_client_log""",
    "client_live": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_id
                                                 ORDER BY __lsn DESC, __source_ts_ms DESC) AS rn
                     FROM client_changes WHERE client_id IS NOT NULL)
      WHERE rn = 1 AND NOT (__deleted = 'true' OR __op = 'd')""",
    "owner_e2e": """
      SELECT account_id, client_id FROM (
        SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY disp_id DESC) AS rn
        FROM raw_disposition WHERE type = 'OWNER') WHERE rn = 1""",
    "profile_e2e": _profile("owner_e2e", "client_live"),
    "routed_e2e": _routed("cdc_trans_log", "profile_e2e"),
}


@register("stream_end_to_end", O.with_base("""
    SELECT trans_id, account_id, date, type, operation, amount, balance, k_symbol, client_id,
      birth_number, account_frequency, district_name, district_region, avg_salary,
      __op, __lsn, __source_ts_ms, true AS __enriched
    FROM routed_e2e WHERE dlq_reason IS NULL""", _E2E_CTES))
def stream_end_to_end(spark, sf_dir):
    """ST-1 ... ST-4 + J-5: snapshot + client change log -> incremental profile
    state (stream 1) -> warm-up gate -> enrichment of the transaction stream
    against the newest state (stream 2)."""
    raw = td.raw_tables(spark, sf_dir)
    changes = cdc_src.snapshot_changes(
        {"account": raw.account, "client": raw.client, "disposition": raw.disposition,
         "district": raw.district}).unionByName(
        cdc_src.as_profile_changes(td.cdc_client(spark, sf_dir), "client"))
    src = scratch_path(spark, "profile-changes")
    # Files by table and key, not by lsn: all snapshot rows have the same one.
    key = F.coalesce(*[F.when(F.col("__table") == t, F.col(k)) for t, k in STATE_KEYS.items()])
    changes.repartition(CHANGE_FILES, "__table", key).write.mode("overwrite").parquet(src)
    root = scratch_path(spark, "profile-state")
    q = profile_stream.start_profile_stream(
        spark, cdc_src.parquet_stream(spark, src, changes.schema, max_files_per_trigger=1), root)
    enrich_stream.drained(q)
    # ST-4: enrichment goes on where the gate stays closed, too; misses go to the dead letters,
    # and each batch's metrics tell whether the gate was open and which version it used.
    warm = profile_stream.wait_for_profile(spark, root, timeout_s=0)
    stream = _transaction_arrivals(spark, td.cdc_trans(spark, sf_dir), 3)
    out = enrich_stream.run_to_completion(
        spark, stream, lambda keys, _: profile_stream.keyed_profile(spark, root, keys), scratch_path(spark, "e2e"), warm=warm)
    return out["enriched"].drop("batch_id")


def _transaction_arrivals(spark, log, count, order=None):
    """The transaction log as a file stream of ``count`` micro-batches, by ``trans_id`` modulo their number."""
    src = scratch_path(spark, "trans-arrivals")
    order = F.pmod(F.coalesce("trans_id", F.lit(0)), F.lit(count)) if order is None else order
    files = cdc_src.arrivals(log.withColumn("__arrival", order), "__arrival", count, src)
    return cdc_src.parquet_stream(spark, src, log.schema, max_files_per_trigger=files)


PROFILE_ARRIVALS, TRANS_ARRIVALS, GATE_SHARE = 8, 6, 0.3

_GATE_CTES = {
    "client_log": f"""
      SELECT client_id, district_id, __lsn, __source_ts_ms, __deleted = 'true' OR __op = 'd' AS gone,
        __lsn % {PROFILE_ARRIVALS} AS arrival FROM cdc_client_log WHERE client_id IS NOT NULL
      UNION ALL SELECT client_id, district_id, -1, 0, false, 0 FROM raw_client""",
    "opening": f"""
      SELECT min(v) AS g FROM range({PROFILE_ARRIVALS}) r(v)
      WHERE (SELECT count(*) FROM raw_account WHERE account_id % {PROFILE_ARRIVALS} <= v)
        >= (SELECT ceil({GATE_SHARE}::DOUBLE * count(*)) FROM raw_account)""",
    "batches": f"""
      SELECT b AS batch_id, least(g + b, {PROFILE_ARRIVALS - 1}) AS v FROM range({TRANS_ARRIVALS}) r(b), opening""",
    "client_at": """
      SELECT v, client_id, arg_max(district_id, (__lsn, __source_ts_ms)) AS district_id
      FROM client_log JOIN (SELECT DISTINCT v FROM batches) ON arrival <= v
      GROUP BY v, client_id HAVING NOT arg_max(gone, (__lsn, __source_ts_ms))""",
    "profile_at": f"""
      SELECT c.v, a.account_id, c.client_id, d.avg_salary
      FROM owner_now o JOIN raw_account a ON a.account_id = o.account_id
      JOIN client_at c ON c.client_id = o.client_id AND a.account_id % {PROFILE_ARRIVALS} <= c.v
      LEFT JOIN raw_district d ON d.district_id = coalesce(c.district_id, a.district_id)""",
}


@register("stream_gate", O.with_base(f"""
    SELECT b.batch_id, b.v AS profile_version, true AS profile_warm, CAST(count(*) AS BIGINT) AS processed,
      CAST(count(p.client_id) AS BIGINT) AS enriched, CAST(count(*) - count(p.client_id) AS BIGINT) AS dlq,
      CAST(count(*) FILTER (WHERE t.account_id IS NULL) AS BIGINT) AS dlq_missing_account,
      CAST(sum(p.client_id) AS BIGINT) AS client_sum, CAST(sum(p.avg_salary) AS BIGINT) AS salary_sum
    FROM batches b JOIN cdc_trans_log t ON t.trans_id % {TRANS_ARRIVALS} = b.batch_id
    LEFT JOIN profile_at p ON p.v = b.v AND p.account_id = t.account_id
    GROUP BY b.batch_id, b.v""", {"owner_now": _OWNERS, **_GATE_CTES}))
def stream_gate(spark, sf_dir):
    """ST-4, ST-1, ST-3 and SRC-5 at once: the profile stream takes a limited number of files at each trigger; the
    gate is polled while it works, and when it opens the transaction stream starts beside it.  Batch b asks for the
    version that is b after the opening one, and waits for it where the profile stream isn't there yet."""
    raw = td.raw_tables(spark, sf_dir)
    snapshot = cdc_src.snapshot_changes({t: getattr(raw, t) for t in STATE_COLUMNS})
    log = cdc_src.as_profile_changes(td.cdc_client(spark, sf_dir), "client")
    n = F.lit(PROFILE_ARRIVALS)
    first = F.when(F.col("__table") == "account", F.pmod("account_id", n)).otherwise(F.lit(0))
    changes = snapshot.withColumn("__arrival", first).unionByName(log.withColumn("__arrival", F.pmod("__lsn", n)))
    src, root = scratch_path(spark, "profile-arrivals"), scratch_path(spark, "profile-state")
    files = cdc_src.arrivals(changes, "__arrival", PROFILE_ARRIVALS, src)
    transactions = _transaction_arrivals(spark, td.cdc_trans(spark, sf_dir), TRANS_ARRIVALS)
    least = math.ceil(GATE_SHARE * raw.account.count())

    profiles = profile_stream.start_profile_stream(
        spark, cdc_src.parquet_stream(spark, src, changes.drop("__arrival").schema, max_files_per_trigger=files), root)
    opened = profile_stream.opening_version(spark, root, least, poll_s=0.2)

    def load(keys, batch_id):
        version = profile_stream.wait_for_version(spark, root, (opened or 0) + batch_id, lambda: profiles.isActive)
        return profile_stream.keyed_profile(spark, root, keys, version)

    out = enrich_stream.run_to_completion(spark, transactions, load, scratch_path(spark, "gate"), warm=opened is not None)
    enrich_stream.drained(profiles)
    sums = out["enriched"].groupBy("batch_id").agg(F.sum("client_id").alias("client_sum"), F.sum("avg_salary").cast("long").alias("salary_sum"))
    return out["metrics"].join(sums, "batch_id", "left").withColumn("batch_id", F.col("batch_id").cast("long"))


RECOVERY_ARRIVALS, BROKEN_BATCH = 5, 2


class _BrokenSinks(enrich_stream.ParquetSinks):
    """Fails after the enriched records of a batch are written and before its dead letters are."""

    def dead_letters(self, df, batch_id):
        if batch_id == BROKEN_BATCH:
            raise RuntimeError("sink lost")
        super().dead_letters(df, batch_id)


@register("stream_recovery", O.with_base(
    "SELECT trans_id, account_id, date, amount, k_symbol, client_id, dlq_reason FROM routed", PROFILE_CTE))
def stream_recovery(spark, sf_dir):
    """ST-5: the stream fails between its two sinks in a middle batch and is started again; Spark's offset and commit
    logs lead it to that batch, whose first output is replaced, so each record is in one output once."""
    stream = _transaction_arrivals(spark, td.cdc_trans(spark, sf_dir), RECOVERY_ARRIVALS)
    root, load = scratch_path(spark, "recovery"), _profile_loader(spark, sf_dir)
    broken = enrich_stream.start_enrichment(spark, stream, load, root, sinks=_BrokenSinks(enrich_stream.StreamOutputs(root)))
    try:
        broken.awaitTermination()
    except StreamingQueryException:
        pass
    if broken.exception() is None:
        raise AssertionError("the stream was to fail")
    again = enrich_stream.start_enrichment(spark, stream, load, root)
    enrich_stream.drained(again)
    done = [p["batchId"] for p in again.recentProgress if p["numInputRows"]]
    if done and min(done) != BROKEN_BATCH:
        raise AssertionError(f"went on from batch {min(done)}, not from {BROKEN_BATCH}")
    return _both_sides(enrich_stream.read_outputs(spark, root))


@register("stream_deduplicated", O.with_base("""
    SELECT t.trans_id, t.account_id, t.date, t.amount, t.k_symbol, p.client_id,
      CASE WHEN t.account_id IS NULL THEN 'missing_account_id' WHEN p.client_id IS NULL THEN 'referential_violation' END AS dlq_reason
    FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY ingest_seq) AS rn FROM raw_trans) t
    LEFT JOIN stream_profile p ON p.account_id = t.account_id WHERE t.rn = 1""",
    {k: PROFILE_CTE[k] for k in ("owner_now", "stream_profile")}))
def stream_deduplicated(spark, sf_dir):
    """ST-5 with W-1: deliveries repeated in later micro-batches (copies that differ, and a whole batch again) are
    cleaned in the stream by Spark's state store before the join; the first one wins."""
    raw = td.raw_tables(spark, sf_dir).trans
    meta = {"__op": F.lit("c"), "__table": F.lit("trans"), "__lsn": F.col("trans_id"), "__source_ts_ms": F.lit(0).cast("long"),
            "__deleted": F.lit("false")}
    rows = raw.withColumns(meta).withColumn("__arrival", (F.col("trans_id") % 4 + F.col("ingest_seq")).cast("int"))
    again = rows.where("__arrival = 1 and ingest_seq = 0").withColumn("__arrival", F.lit(5))
    log = rows.unionByName(again).select(*CDC_TRANS.fieldNames(), "__arrival")
    src = scratch_path(spark, "repeated-deliveries")
    files = cdc_src.arrivals(log, "__arrival", 6, src)
    stream = cdc_src.parquet_stream(spark, src, CDC_TRANS, max_files_per_trigger=files)
    out = enrich_stream.run_to_completion(spark, enrich_stream.deduplicated(stream), _profile_loader(spark, sf_dir),
                                          scratch_path(spark, "deduplicated"))
    return _both_sides(out)


# --------------------------------------------------------------------------
# The same records as JSON messages, as a broker delivers and takes them.
# --------------------------------------------------------------------------

def _messages(log, topic: str):
    """Change records as messages: key text, JSON value with NULL fields kept, and after each delete a
    tombstone (NULL value)."""
    fields = [c for c in log.columns if c != "__table"]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    records = log.select(F.lit(topic).alias("topic"), F.col(log.columns[0]).cast("string").alias("key"),
                         value.alias("value"), F.col("__deleted").alias("_d"))
    tombstones = records.where("_d = 'true'").withColumn("value", F.lit(None).cast("string"))
    return records.unionByName(tombstones).drop("_d")


@register("cdc_envelope", O.with_base("SELECT * FROM cdc_trans_log"))
def cdc_envelope(spark, sf_dir):
    """SRC-7, FL-3, F-12: the transaction topic's messages, tombstones among them, parsed back."""
    messages = _messages(td.cdc_trans(spark, sf_dir), cdc_src.TRANS_TOPIC)
    return cdc_src.parse_envelope(messages, CDC_TRANS).select(*CDC_TRANS.fieldNames())


def _routed_sql() -> str:
    data = [f.name for f in CDC_PROFILE.fields if not f.name.startswith("__")]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS __table, " + ", ".join(c if c in cols else f"NULL AS {c}" for c in data) + f" FROM raw_{t}"
        for t, cols in STATE_COLUMNS.items())


@register("profile_topics_routed", O.with_base(_routed_sql()))
def profile_topics_routed(spark, sf_dir):
    """SRC-6, FL-4: messages of the four profile topics in one subscription; the table of a record is
    its topic's last part, as the messages don't carry it."""
    raw = td.raw_tables(spark, sf_dir)
    changes = cdc_src.snapshot_changes({t: getattr(raw, t) for t in STATE_COLUMNS})
    parts = [_messages(changes.where(F.col("__table") == t).select(key, *[c for c in changes.columns if c != key]), topic)
             for (t, key), topic in zip(STATE_KEYS.items(), cdc_src.PROFILE_TOPICS)]
    messages = parts[0]
    for p in parts[1:]:
        messages = messages.unionByName(p)
    parsed = cdc_src.parse_envelope(messages, CDC_PROFILE)
    return parsed.select("__table", *[f.name for f in CDC_PROFILE.fields if not f.name.startswith("__")])


def _json_outputs(spark, sf_dir) -> dict:
    """The enrichment stream over a file dump of the transaction topic."""
    dump = scratch_path(spark, "trans-topic")
    messages = _messages(td.cdc_trans(spark, sf_dir), cdc_src.TRANS_TOPIC)
    messages.write.parquet(dump)
    stream = cdc_src.parse_envelope(cdc_src.parquet_stream(spark, dump, messages.schema), CDC_TRANS)
    return enrich_stream.run_to_completion(spark, stream, _profile_loader(spark, sf_dir), scratch_path(spark, "json-stream"))


def _read_back(records, schema):
    """Sink records, read as a consumer does: key, fields, and how many fields the JSON object has."""
    return records.select("key", F.from_json("value", schema).alias("r"),
                          F.size(F.json_object_keys("value")).cast("bigint").alias("n_fields"))


@register("enriched_json", O.with_base("""
    SELECT CAST(trans_id AS VARCHAR) AS key, CAST(18 AS BIGINT) AS n_fields, trans_id, account_id, date, type, operation,
      amount, balance, k_symbol, client_id, birth_number, account_frequency, district_name, district_region, avg_salary,
      __op, __lsn, __source_ts_ms, true AS __enriched
    FROM routed WHERE dlq_reason IS NULL""", PROFILE_CTE))
def enriched_json(spark, sf_dir):
    """SNK-1 as JSON records, from JSON messages."""
    rows = _json_outputs(spark, sf_dir)["enriched"].drop("batch_id")
    return _read_back(cdc_src.json_records(rows), rows.schema).select("key", "n_fields", "r.*")


@register("dlq_json", O.with_base("""
    SELECT CAST(trans_id AS VARCHAR) AS key, CAST(6 AS BIGINT) AS n_fields, dlq_reason, trans_id, account_id, __source_ts_ms,
    """ + ", ".join(f"{c} AS orig_{c}" for c in _ORIG) + " FROM routed WHERE dlq_reason IS NOT NULL", PROFILE_CTE))
def dlq_json(spark, sf_dir):
    """SNK-2 as JSON records; the publication time is a field, not compared."""
    rows = _json_outputs(spark, sf_dir)["dead_letters"].drop("batch_id")
    back = _read_back(cdc_src.json_records(rows), rows.schema)
    return back.select("key", "n_fields", "r.dlq_reason", "r.trans_id", "r.account_id", "r.__source_ts_ms",
                       *[F.col(f"r.original_transaction.{c}").alias(f"orig_{c}") for c in _ORIG])


@register("dlq_rerun", O.with_base("""
    SELECT coalesce(reason_now, 'enriched') AS outcome, CAST(count(*) AS BIGINT) AS records
    FROM (SELECT CASE WHEN t.account_id IS NULL THEN 'missing_account_id'
                           WHEN p.account_id IS NULL THEN 'referential_violation' END AS reason_now
          FROM (SELECT * FROM routed WHERE dlq_reason IS NOT NULL) t
          LEFT JOIN (SELECT DISTINCT account_id FROM routed WHERE account_id % 2 = 0) p ON t.account_id = p.account_id) r
    GROUP BY 1""", PROFILE_CTE))
def dlq_rerun(spark, sf_dir):
    """ST-7: stored dead letters are routed again after profiles of the even accounts have arrived."""
    dead = run_stream(spark, sf_dir)["dead_letters"]
    late = (td.cdc_trans(spark, sf_dir).where("account_id % 2 = 0").select("account_id").distinct()
            .withColumn("client_id", F.col("account_id")))
    profile = _profile_loader(spark, sf_dir)(None, 0)
    filled = late.select(*[F.col(c) if c in late.columns else F.lit(None).cast(profile.schema[c].dataType).alias(c)
                           for c in profile.columns])
    now = profile.join(filled.select("account_id"), "account_id", "left_anti").unionByName(filled)
    again = enrich.rerun_dead_letters(dead, now)
    return (again.groupBy(F.coalesce("dlq_reason", F.lit("enriched")).alias("outcome"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("records")))


@register("stream_replay", O.with_base("""
    SELECT dlq_reason, CAST(count(*) AS BIGINT) AS records FROM routed GROUP BY dlq_reason""", PROFILE_CTE))
def stream_replay(spark, sf_dir):
    """ST-5: a batch that is delivered twice replaces its own output in both sinks."""
    outputs = enrich_stream.StreamOutputs(scratch_path(spark, "replay"))
    writer = enrich_stream.make_batch_writer(spark, _profile_loader(spark, sf_dir), outputs)
    for _ in range(2):
        writer(td.cdc_trans(spark, sf_dir), 0)
    read = enrich_stream.read_outputs(spark, outputs.root)
    both = (read["enriched"].select(F.lit(None).cast("string").alias("dlq_reason"))
            .unionByName(read["dead_letters"].select("dlq_reason")))
    return both.groupBy("dlq_reason").agg(F.count(F.lit(1)).cast("bigint").alias("records"))


@register("stream_listener_metrics", O.with_base(f"""
    SELECT CAST(trans_id % {RECOVERY_ARRIVALS} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS processed,
      CAST(count(*) FILTER (WHERE account_id IS NULL) AS BIGINT) AS missing_account,
      CAST(count(*) FILTER (WHERE __deleted = 'true') AS BIGINT) AS deleted,
      CAST(count(*) FILTER (WHERE dlq_reason IS NULL) AS BIGINT) AS enriched,
      CAST(count(*) FILTER (WHERE dlq_reason IS NOT NULL) AS BIGINT) AS dlq
    FROM routed GROUP BY 1""", PROFILE_CTE))
def stream_listener_metrics(spark, sf_dir):
    """A-6 over the life of a stream: what a listener has gathered of all micro-batches until the stop, beside the
    figures that each batch wrote with its outputs."""
    stream = _transaction_arrivals(spark, td.cdc_trans(spark, sf_dir), RECOVERY_ARRIVALS)
    heard, root = metrics.RunningMetrics(), scratch_path(spark, "listened")
    spark.streams.addListener(heard)
    try:
        query = enrich_stream.start_enrichment(spark, metrics.arriving(stream), _profile_loader(spark, sf_dir), root)
        enrich_stream.drained(query)
        heard.wait(query)
    finally:
        spark.streams.removeListener(heard)
    gathered = heard.table(spark, f"{root}/running").drop("run_id")
    written = enrich_stream.read_outputs(spark, root)["metrics"].select(F.col("batch_id").cast("long").alias("batch_id"), "enriched", "dlq")
    return gathered.join(written, "batch_id")
