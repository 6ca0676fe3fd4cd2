"""Data-quality queries: the declared 31 tests, FK enforcement, domain rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mart, quality, synth
from ..operators import profile as profile_ops
from ..operators.quality import Rule
from ..session import scratch_path
from ..sources import testdata as td
from . import oracle as O
from .catalog import register

# Name of each checked table -> its CTE in the oracle.
ORACLE_TABLE = {
    "trans": "raw_trans", "account": "raw_account", "client": "raw_client",
    "disposition": "raw_disposition", "district": "raw_district",
    "stg_trans": "stg_trans", "stg_account": "stg_account", "stg_client": "stg_client",
    "stg_disposition": "stg_disposition", "stg_district": "stg_district",
    "fct_enriched_transactions": "fct_enriched_transactions",
}


def check_tables(spark, sf_dir) -> dict:
    raw = td.raw_tables(spark, sf_dir)
    st = mart.stage_all(raw)
    # The fact is deduplicated once; the tests of the staged table and of the mart both read the result.
    path = scratch_path(spark, "staged-trans")
    st.trans.write.parquet(path)
    st.trans = spark.read.parquet(path)
    return {
        "trans": raw.trans, "account": raw.account, "client": raw.client,
        "disposition": raw.disposition, "district": raw.district,
        "stg_trans": st.trans, "stg_account": st.account, "stg_client": st.client,
        "stg_disposition": st.disposition, "stg_district": st.district,
        "fct_enriched_transactions": mart.enriched_transactions(st.trans, mart.profile_of(st)),
    }


def _rule_sql(r: Rule) -> str:
    t = ORACLE_TABLE[r.table]
    c = r.column
    if r.kind == "not_null":
        fail = f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
    elif r.kind == "unique":
        fail = (f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1))")
    elif r.kind == "accepted_values":
        vals = ", ".join("'" + v + "'" for v in r.values)
        fail = f"(SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({vals}))"
    else:
        p = ORACLE_TABLE[r.to_table]
        fail = (f"(SELECT count(*) FROM {t} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} pa WHERE pa.{r.to_column} = ch.{c}))")
    status = (f"CASE WHEN {fail} = 0 THEN 'PASS' WHEN '{r.severity}' = 'warn' THEN 'WARN' "
              "ELSE 'ERROR' END")
    return (f"SELECT '{r.name}' AS test, '{r.table}' AS table_name, '{c}' AS column_name, "
            f"'{r.severity}' AS severity, CAST({fail} AS BIGINT) AS failures, {status} AS status")


def _union_sql(rules: list[Rule]) -> str:
    return "\nUNION ALL\n".join(_rule_sql(r) for r in rules)


def _rules_sql(rules: list[Rule]) -> str:
    return O.with_base(_union_sql(rules))


def _of_kind(kind: str) -> list[Rule]:
    return [r for r in quality.DECLARED_RULES if r.kind == kind]


def _register_kind(name: str, kind: str) -> None:
    rules = _of_kind(kind)

    @register(name, _rules_sql(rules))
    def _q(spark, sf_dir):
        return quality.run_checks(check_tables(spark, sf_dir), rules)


_register_kind("dq_not_null", "not_null")
_register_kind("dq_unique", "unique")
_register_kind("dq_accepted_values", "accepted_values")
_register_kind("dq_relationships", "relationships")


@register("dq_summary", O.with_base(
    "SELECT status, CAST(count(*) AS BIGINT) AS tests FROM ("
    + _union_sql(quality.DECLARED_RULES) + ") GROUP BY status"))
def dq_summary(spark, sf_dir):
    return quality.summarize(quality.run_checks(check_tables(spark, sf_dir), quality.DECLARED_RULES))


@register("dq_foreign_keys", _rules_sql(quality.FOREIGN_KEY_RULES))
def dq_foreign_keys(spark, sf_dir):
    return quality.run_checks(check_tables(spark, sf_dir), quality.FOREIGN_KEY_RULES)


_TRANS_DOMAIN_SQL = [
    ("trans_id_not_null", "trans_id IS NOT NULL"),
    ("account_id_not_null", "account_id IS NOT NULL"),
    ("amount_not_null", "amount IS NOT NULL"),
    ("amount_non_negative", "coalesce(amount >= 0, true)"),
    ("type_in_domain", "coalesce(type IN ('PRIJEM', 'VYDAJ', 'VYBER'), false)"),
    ("date_in_range", "coalesce(date >= 0 AND date <= 999999, false)"),
    ("date_parses", "try_strptime((CASE WHEN lpad(CAST(date AS VARCHAR), 6, '0') LIKE '0%' "
                    "THEN '20' ELSE '19' END) || lpad(CAST(date AS VARCHAR), 6, '0'), '%Y%m%d') "
                    "IS NOT NULL"),
]
_DISP_DOMAIN_SQL = [("type_in_domain", "coalesce(type IN ('OWNER', 'DISPONENT'), false)")]
_CLIENT_DOMAIN_SQL = [(
    "birth_number_parses",
    "try_strptime('19' || lpad(CAST((CASE WHEN (birth_number % 10000) / 100 > 50 "
    "THEN birth_number - 5000 ELSE birth_number END) AS VARCHAR), 6, '0'), '%Y%m%d') IS NOT NULL")]


def _domain_sql(table: str, cte: str, rules) -> list[str]:
    return [f"SELECT '{table}' AS table_name, '{name}' AS rule, "
            f"CAST(count(*) FILTER (WHERE NOT ({pred})) AS BIGINT) AS rejected_rows FROM {cte}"
            for name, pred in rules]


@register("dq_domain_rejects", O.with_base("\nUNION ALL\n".join(
    _domain_sql("trans", "raw_trans", _TRANS_DOMAIN_SQL)
    + _domain_sql("disposition", "raw_disposition", _DISP_DOMAIN_SQL)
    + _domain_sql("client", "raw_client", _CLIENT_DOMAIN_SQL))))
def dq_domain_rejects(spark, sf_dir):
    raw = td.raw_tables(spark, sf_dir)
    return (quality.domain_reject_counts("trans", raw.trans, quality.trans_domain_rules())
            .unionByName(quality.domain_reject_counts(
                "disposition", raw.disposition, quality.disposition_domain_rules()))
            .unionByName(quality.domain_reject_counts(
                "client", raw.client, quality.client_domain_rules())))


# --------------------------------------------------------------------------
# The same rules on rows that break them: values of some ids are made invalid.
# --------------------------------------------------------------------------

_DIRTY_TRANS_SQL = """
    SELECT * REPLACE (
      CASE WHEN trans_id % 101 = 0 THEN NULL ELSE account_id END AS account_id,
      CASE WHEN trans_id % 103 = 0 THEN 991332 WHEN trans_id % 107 = 0 THEN -1 ELSE date END AS date,
      CASE WHEN trans_id % 109 = 0 THEN 'OTHER' ELSE type END AS type,
      CASE WHEN trans_id % 113 = 0 THEN 0.0 WHEN trans_id % 127 = 0 THEN -5.0 WHEN trans_id % 131 = 0 THEN NULL ELSE amount END AS amount)
    FROM raw_trans"""
_DIRTY = {"dirty_trans": _DIRTY_TRANS_SQL,
          "dirty_client": "SELECT * REPLACE (CASE WHEN client_id % 7 = 0 THEN NULL ELSE district_id END AS district_id, "
                          "CASE WHEN client_id % 11 = 0 THEN 5001 ELSE birth_number END AS birth_number) FROM raw_client",
          "dirty_disposition": "SELECT * REPLACE (CASE WHEN disp_id % 13 = 0 THEN 'USER' ELSE type END AS type) FROM raw_disposition"}


def _dirty_trans(spark, sf_dir):
    i = F.col("trans_id")
    none, amount = F.lit(None), F.col("amount")
    return (td.raw_trans(spark, sf_dir)
            .withColumn("account_id", F.when(i % 101 == 0, none.cast("bigint")).otherwise(F.col("account_id")))
            .withColumn("date", F.when(i % 103 == 0, F.lit(991332).cast("bigint")).when(i % 107 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("date")))
            .withColumn("type", F.when(i % 109 == 0, F.lit("OTHER")).otherwise(F.col("type")))
            .withColumn("amount", F.when(i % 113 == 0, F.lit(0.0)).when(i % 127 == 0, F.lit(-5.0))
                        .when(i % 131 == 0, none.cast("double")).otherwise(amount)))


def _dirty_client(spark, sf_dir):
    k = F.col("client_id")
    return (td.raw_client(spark, sf_dir)
            .withColumn("district_id", F.when(k % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("district_id")))
            .withColumn("birth_number", F.when(k % 11 == 0, F.lit(5001).cast("bigint")).otherwise(F.col("birth_number"))))


def _dirty_disposition(spark, sf_dir):
    return td.raw_disposition(spark, sf_dir).withColumn(
        "type", F.when(F.col("disp_id") % 13 == 0, F.lit("USER")).otherwise(F.col("type")))


@register("dq_dirty_rejects", O.with_base("\nUNION ALL\n".join(
    _domain_sql("trans", "dirty_trans", _TRANS_DOMAIN_SQL)
    + _domain_sql("disposition", "dirty_disposition", _DISP_DOMAIN_SQL)
    + _domain_sql("client", "dirty_client", _CLIENT_DOMAIN_SQL)), _DIRTY))
def dq_dirty_rejects(spark, sf_dir):
    """FL-5 on rows that break each rule."""
    parts = [("trans", _dirty_trans, quality.trans_domain_rules()),
             ("disposition", _dirty_disposition, quality.disposition_domain_rules()),
             ("client", _dirty_client, quality.client_domain_rules())]
    out = None
    for name, rows, rules in parts:
        counts = quality.domain_reject_counts(name, rows(spark, sf_dir), rules)
        out = counts if out is None else out.unionByName(counts)
    return out


@register("domain_split", O.with_base("""
    SELECT coalesce(reason, 'accepted') AS outcome, CAST(count(*) AS BIGINT) AS records FROM (
      SELECT CASE """ + " ".join(f"WHEN NOT ({p}) THEN '{n}'" for n, p in _TRANS_DOMAIN_SQL)
    + """ END AS reason FROM dirty_trans) GROUP BY 1""", _DIRTY))
def domain_split(spark, sf_dir):
    """FL-5: accepted rows and rejected rows by the first rule that they break."""
    accepted, rejected = quality.split_domain(_dirty_trans(spark, sf_dir), quality.trans_domain_rules())
    both = (accepted.select(F.lit("accepted").alias("outcome"))
            .unionByName(rejected.select(F.col("reject_reason").alias("outcome"))))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).cast("bigint").alias("records"))


_DIRTY_RULES = [Rule("not_null", "trans", "account_id"), Rule("not_null", "trans", "amount"), Rule("unique", "trans", "trans_id"),
                Rule("accepted_values", "trans", "type", values=("PRIJEM", "VYDAJ", "VYBER")),
                Rule("accepted_values", "disposition", "type", values=("OWNER", "DISPONENT")),
                Rule("not_null", "client", "district_id"), Rule("unique", "client", "client_id")]


@register("dq_dirty_rules", O.with_base("\nUNION ALL\n".join(
    _rule_sql(r).replace(" raw_", " dirty_") for r in _DIRTY_RULES), _DIRTY))
def dq_dirty_rules(spark, sf_dir):
    """DQ-1 ... DQ-3 on rows that break them."""
    tables = {"trans": _dirty_trans(spark, sf_dir), "client": _dirty_client(spark, sf_dir),
              "disposition": _dirty_disposition(spark, sf_dir)}
    return quality.run_checks(tables, _DIRTY_RULES)


@register("fit_dirty_scalars", O.with_base("""
    SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE amount > 0) AS BIGINT) AS fit_rows,
      CAST(count(*) FILTER (WHERE NOT (amount > 0) OR amount IS NULL) AS BIGINT) AS dropped_rows,
      CAST(count(*) FILTER (WHERE account_id IS NOT NULL) AS BIGINT) AS account_rows
    FROM dirty_trans""", _DIRTY))
def fit_dirty_scalars(spark, sf_dir):
    """FL-2 on amounts that are zero, negative or missing."""
    return synth.fit_scalars(_dirty_trans(spark, sf_dir)).select("rows", "fit_rows", "dropped_rows", "account_rows")


@register("profile_district_fallback", O.with_base("""
    SELECT a.account_id, c.client_id, c.district_id AS client_district_id, a.district_id AS account_district_id,
      d.name AS district_name
    FROM (SELECT account_id, arg_max(client_id, disp_id) AS client_id FROM raw_disposition WHERE type = 'OWNER' GROUP BY 1) o
    JOIN raw_account a USING (account_id) JOIN dirty_client c ON c.client_id = o.client_id
    LEFT JOIN raw_district d ON d.district_id = ifnull(c.district_id, a.district_id)""", _DIRTY))
def profile_district_fallback(spark, sf_dir):
    """J-7 where clients have no district of their own."""
    raw = td.raw_tables(spark, sf_dir)
    st = mart.stage_all(raw)
    return (profile_ops.stream_profile(st.account, st.disposition, _dirty_client(spark, sf_dir),
                                       raw.district.withColumnRenamed("name", "district_name"))
            .select("account_id", "client_id", "client_district_id", "account_district_id", "district_name"))
