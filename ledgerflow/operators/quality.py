"""Declarative data-quality checks (DQ-1 ... DQ-4, J-10, FL-5).

A rule set is a list of ``Rule``; ``run_checks`` turns it into one result
DataFrame ``(test, table_name, column_name, severity, failures, status)``.

``run_checks`` is one job: every table is projected to the columns its rules
use, and a table feeding several passes is persisted in that narrow form for
the run (so the deduplicated fact and the mart are computed once, not once per
rule).  Per table, all ``not_null`` rules are one aggregation and all
``accepted_values`` rules are another;
each ``unique`` rule is a grouped count (map-side partial aggregation, so a hot
key costs one row per map task) and each ``relationships`` rule is a left-anti
join on non-NULL keys.  Failure counts follow the usual definitions:
not_null = NULL rows; unique = duplicated values; accepted_values = distinct
values outside the set (NULL excluded); relationships = child rows without a
parent.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates
from ..schemas import DQ_RESULT

PASS, WARN, ERROR = "PASS", "WARN", "ERROR"


@dataclass(frozen=True)
class Rule:
    kind: str                 # not_null | unique | accepted_values | relationships
    table: str
    column: str
    severity: str = "error"   # error | warn
    values: tuple = field(default_factory=tuple)
    to_table: str | None = None
    to_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.table}_{self.column}__{self.to_table}_{self.to_column}"
        return f"{self.kind}_{self.table}_{self.column}"


def _result(rule: Rule, failures: Column) -> Column:
    f = failures.cast("bigint")
    status = (F.when(f == 0, F.lit(PASS))
              .when(F.lit(rule.severity) == "warn", F.lit(WARN)).otherwise(F.lit(ERROR)))
    return F.struct(F.lit(rule.name).alias("test"), F.lit(rule.table).alias("table_name"),
                    F.lit(rule.column).alias("column_name"), F.lit(rule.severity).alias("severity"),
                    f.alias("failures"), status.alias("status"))


def _explode_results(agg: DataFrame) -> DataFrame:
    return agg.select(F.explode(F.array(*[F.col(c) for c in agg.columns])).alias("r")).select("r.*")


def _per_table(rules: list[Rule], tables: dict[str, DataFrame], kind: str) -> list[DataFrame]:
    groups: OrderedDict[str, list[Rule]] = OrderedDict()
    for r in rules:
        if r.kind == kind:
            groups.setdefault(r.table, []).append(r)
    out = []
    for table, rs in groups.items():
        df = tables[table]
        exprs = []
        for i, r in enumerate(rs):
            c = F.col(r.column)
            if kind == "not_null":
                fail = F.count_if(c.isNull())
            else:  # accepted_values: distinct failing values, NULL excluded
                fail = F.count_distinct(F.when(~c.isin(*r.values), c))
            exprs.append(_result(r, fail).alias(f"r{i}"))
        out.append(_explode_results(df.agg(*exprs)))
    return out


def _unique(rule: Rule, df: DataFrame) -> DataFrame:
    dupes = (df.select(F.col(rule.column).alias("k")).where(F.col("k").isNotNull())
             .groupBy("k").count().where(F.col("count") > 1))
    return _explode_results(dupes.agg(_result(rule, F.count(F.lit(1))).alias("r0")))


def _relationship(rule: Rule, child: DataFrame, parent: DataFrame) -> DataFrame:
    """Child rows whose key has no parent.  Child keys are counted first (map-side
    combine), so a hot key crosses the shuffle as one row per map task and the
    anti join runs over distinct keys only."""
    keys = (child.select(F.col(rule.column).alias("k")).where(F.col("k").isNotNull())
            .groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    parents = parent.select(F.col(rule.to_column).alias("k"))
    orphans = keys.join(parents, "k", "left_anti")
    failures = F.coalesce(F.sum("n"), F.lit(0))
    return _explode_results(orphans.agg(_result(rule, failures).alias("r0")))


def failing_rows(tables: dict[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows of the rule's table that fail it, as they are (for ``unique``: all rows of a repeated value)."""
    df, column = tables[rule.table], F.col(rule.column)
    if rule.kind == "not_null":
        return df.where(column.isNull())
    if rule.kind == "unique":
        repeated = df.where(column.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        return df.join(repeated, rule.column, "left_semi")
    if rule.kind == "accepted_values":
        return df.where(~column.isin(*rule.values))
    parents = tables[rule.to_table].select(F.col(rule.to_column).alias(rule.column)).distinct()
    return df.where(column.isNotNull()).join(parents, rule.column, "left_anti")


def check_plan(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All rule results as one lazy union (one small row per rule)."""
    parts = _per_table(rules, tables, "not_null") + _per_table(rules, tables, "accepted_values")
    for r in rules:
        if r.kind == "unique":
            parts.append(_unique(r, tables[r.table]))
        elif r.kind == "relationships":
            parts.append(_relationship(r, tables[r.table], tables[r.to_table]))
    return reduce(DataFrame.unionByName, parts)


def _columns_used(rules: list[Rule]) -> dict[str, list[str]]:
    used: dict[str, list[str]] = {}
    for r in rules:
        for t, c in ((r.table, r.column), (r.to_table, r.to_column)):
            if t is not None and c not in used.setdefault(t, []):
                used[t].append(c)
    return used


def _groups_per_table(rules: list[Rule]) -> dict[str, int]:
    """How many separate passes each table would get (fused kinds count once)."""
    n: dict[str, int] = {}
    kinds: dict[str, set] = {}
    for r in rules:
        for t in (r.table, r.to_table):
            if t is None:
                continue
            if r.kind in ("not_null", "accepted_values") and t == r.table:
                if r.kind in kinds.setdefault(t, set()):
                    continue
                kinds[t].add(r.kind)
            n[t] = n.get(t, 0) + 1
    return n


def run_checks(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Run the rule set as one job and return its (small) result table.

    Each table is first projected to the columns its rules use; a table that
    feeds more than one pass is persisted in that narrow form for the
    duration of the run, so an expensive input (a deduplicated fact, the
    mart) is computed once instead of once per rule.
    """
    from pyspark import StorageLevel

    used = _columns_used(rules)
    passes = _groups_per_table(rules)
    narrow, held = {}, []
    for name, cols in used.items():
        df = tables[name].select(*cols)
        if passes.get(name, 0) > 1:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(df)
        narrow[name] = df
    try:
        rows = check_plan(narrow, rules).collect()
    finally:
        for df in held:
            df.unpersist()
    spark = next(iter(tables.values())).sparkSession
    order = {r.name: i for i, r in enumerate(rules)}
    rows = sorted(rows, key=lambda r: order.get(r["test"], len(order)))
    return spark.createDataFrame([tuple(r) for r in rows], DQ_RESULT)


def summarize(results: DataFrame) -> DataFrame:
    """Status counts of a result set; the run fails only on ERROR."""
    return results.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("tests"))


class ChecksFailed(Exception):
    """A data test of severity ERROR has failed; the message names the tests."""


def require_passing(results: DataFrame) -> DataFrame:
    """The results, or ChecksFailed where one has the status ERROR; warnings pass."""
    failed = [f"{r['test']}: {r['failures']}" for r in results.where(F.col("status") == "ERROR").collect()]
    if failed:
        raise ChecksFailed("; ".join(failed))
    return results


# ---------------------------------------------------------------------------
# The declared test suite of the batch build (31 tests).
# ---------------------------------------------------------------------------

def _nn(t, c):
    return Rule("not_null", t, c)


def _uq(t, c):
    return Rule("unique", t, c)


# The declared tests, in declaration order.
DECLARED_RULES: list[Rule] = [
    # sources
    _nn("trans", "trans_id"), _nn("trans", "account_id"), _nn("trans", "amount"),
    _nn("account", "account_id"), _uq("account", "account_id"),
    _nn("client", "client_id"), _uq("client", "client_id"),
    _nn("disposition", "disp_id"), _uq("disposition", "disp_id"),
    _nn("district", "district_id"), _uq("district", "district_id"),
    # staging
    _uq("stg_trans", "trans_id"), _nn("stg_trans", "trans_id"),
    Rule("relationships", "stg_trans", "account_id", "warn",
         to_table="stg_account", to_column="account_id"),
    _nn("stg_trans", "amount"),
    _uq("stg_account", "account_id"), _nn("stg_account", "account_id"),
    _uq("stg_client", "client_id"), _nn("stg_client", "client_id"),
    Rule("accepted_values", "stg_client", "gender", values=tuple(codes.GENDERS)),
    _uq("stg_disposition", "disp_id"), _nn("stg_disposition", "disp_id"),
    Rule("accepted_values", "stg_disposition", "disposition_type",
         values=tuple(codes.DISPOSITION_TYPES)),
    _uq("stg_district", "district_id"), _nn("stg_district", "district_id"),
    # mart
    _uq("fct_enriched_transactions", "trans_id"), _nn("fct_enriched_transactions", "trans_id"),
    _nn("fct_enriched_transactions", "account_id"),
    _nn("fct_enriched_transactions", "transaction_date"),
    _nn("fct_enriched_transactions", "amount"), _nn("fct_enriched_transactions", "client_id"),
]

# Foreign keys declared for the dimension tables (J-10).
FOREIGN_KEY_RULES: list[Rule] = [
    Rule("relationships", "account", "district_id", to_table="district", to_column="district_id"),
    Rule("relationships", "client", "district_id", to_table="district", to_column="district_id"),
    Rule("relationships", "disposition", "client_id", to_table="client", to_column="client_id"),
    Rule("relationships", "disposition", "account_id", to_table="account", to_column="account_id"),
]


# ---------------------------------------------------------------------------
# Domain checks with an accepted / rejected split (FL-5).
# ---------------------------------------------------------------------------

def trans_domain_rules() -> "OrderedDict[str, Column]":
    """Predicates that must hold for a transaction row (True = valid)."""
    d = F.col("date")
    return OrderedDict([
        ("trans_id_not_null", F.col("trans_id").isNotNull()),
        ("account_id_not_null", F.col("account_id").isNotNull()),
        ("amount_not_null", F.col("amount").isNotNull()),
        ("amount_non_negative", F.coalesce(F.col("amount") >= 0, F.lit(True))),
        ("type_in_domain", F.coalesce(F.col("type").isin(*codes.TRANSACTION_TYPES), F.lit(False))),
        ("date_in_range", F.coalesce((d >= 0) & (d <= 999999), F.lit(False))),
        ("date_parses", dates.transaction_date(d, strict=False).isNotNull()),
    ])


def disposition_domain_rules() -> "OrderedDict[str, Column]":
    return OrderedDict([
        ("type_in_domain",
         F.coalesce(F.col("type").isin(*codes.DISPOSITION_TYPES), F.lit(False))),
    ])


def client_domain_rules() -> "OrderedDict[str, Column]":
    return OrderedDict([
        ("birth_number_parses", dates.birth_date("birth_number", strict=False).isNotNull()),
    ])


def reject_reason(rules: "OrderedDict[str, Column]") -> Column:
    """Name of the first violated rule, NULL when the row is valid."""
    expr = None
    for name, ok in rules.items():
        expr = (F.when(~ok, F.lit(name)) if expr is None else expr.when(~ok, F.lit(name)))
    return expr


def split_domain(df: DataFrame, rules: "OrderedDict[str, Column]") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reject_reason``) from one pass of predicates."""
    tagged = df.withColumn("reject_reason", reject_reason(rules))
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def domain_reject_counts(table: str, df: DataFrame,
                         rules: "OrderedDict[str, Column]") -> DataFrame:
    """One row per rule: how many rows violate it (a row may violate several)."""
    exprs = [F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("rule"),
                      F.count_if(~ok).cast("bigint").alias("rejected_rows")).alias(f"r{i}")
             for i, (name, ok) in enumerate(rules.items())]
    return _explode_results(df.agg(*exprs))
