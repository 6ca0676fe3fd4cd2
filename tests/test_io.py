"""Delimited files and loads (SRC-1/2, SNK-3 ... SNK-5, SNK-7, J-9)."""
import os

from pyspark.sql import functions as F

from ledgerflow.operators import load
from ledgerflow.sources import delimited


def test_csv_null_tokens(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trans.csv")
    with open(p, "w") as f:
        f.write("trans_id;account_id;date;type;operation;amount;balance;k_symbol;bank;account\n")
        f.write('1;5;930101;PRIJEM;VKLAD;1.5;2.0;"";;\n')
        f.write("2;5;930101;PRIJEM;;1.5;;;;\n")
        f.write('3;5;930101;PRIJEM;VKLAD;1.5;2.0;" ";AB;"123"\n')
    rows = {r["trans_id"]: r for r in delimited.read_delimited(spark, p, "trans").collect()}
    assert rows[1]["k_symbol"] == "" and rows[2]["k_symbol"] is None
    assert rows[2]["operation"] is None and rows[3]["k_symbol"] == " "
    d = os.path.join(tmp_dir, "district.csv")
    with open(d, "w") as f:
        f.write("district_id;name;region;num_inhabitants;num_municipalities_lt_499;"
                "num_municipalities_500_1999;num_municipalities_2000_9999;"
                "num_municipalities_gt_10000;num_cities;ratio_urban;avg_salary;"
                "unemployment_rate_95;unemployment_rate_96;num_entrepreneurs_per_1000;"
                "num_crimes_95;num_crimes_96\n")
        f.write("1;A;R;100;1;2;3;4;5;50.5;8000;?;1.5;100;?;7\n")
    r = delimited.read_delimited(spark, d, "district").first()
    assert r["unemployment_rate_95"] is None and r["num_crimes_95"] is None and r["num_crimes_96"] == 7


def test_csv_round_trip_keeps_empty_and_null(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, 5, 101, "PRIJEM", None, 1.25, None, "", None, None),
         (2, None, 930101, "VYDAJ", "VYBER", 2.5, 3.0, None, "AB", "77"),
         (3, 6, 930101, "VYDAJ", "VYBER", 2.5, 3.0, " ", "AB", "77")],
        "trans_id long, account_id long, date long, type string, operation string, amount double, "
        "balance double, k_symbol string, bank string, account string")
    path = os.path.join(tmp_dir, "out")
    delimited.write_delimited(df, path, "trans_loadtest")
    back = delimited.read_delimited(spark, path, "trans_loadtest")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_insert_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "trans_id long, v string")
    batch = spark.createDataFrame([(2, "x", 0), (3, "c", 0), (3, "d", 1), (4, "e", 0)],
                                  "trans_id long, v string, seq long")
    ins = load.insert_if_absent(target, batch, "trans_id", ["seq"])
    assert sorted(map(tuple, ins.select("trans_id", "v").collect())) == [(3, "c"), (4, "e")]
    after = target.unionByName(ins.select("trans_id", "v"))
    again = load.insert_if_absent(after, batch, "trans_id", ["seq"])
    assert again.count() == 0


def test_append_is_stored_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "target")
    spark.createDataFrame([(1, "a"), (2, "b")], "trans_id long, v string").write.parquet(path)
    batch = spark.createDataFrame([(2, "x", 0), (3, "c", 0), (3, "d", 1), (4, "e", 0)],
                                  "trans_id long, v string, seq long")
    assert tuple(load.append_if_absent(spark, path, batch, "trans_id", ["seq"]).first()) == (2, 4, 2, 4)
    assert tuple(load.append_if_absent(spark, path, batch, "trans_id", ["seq"]).first()) == (4, 4, 0, 4)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "e")]


def test_full_refresh_rejects_orphans(spark, tmp_dir):
    tables = {
        "district": spark.createDataFrame([(1,)], "district_id long"),
        "account": spark.createDataFrame([(10, 1), (11, 2)], "account_id long, district_id long"),
        "client": spark.createDataFrame([(20, 1), (21, None)], "client_id long, district_id long"),
        "disposition": spark.createDataFrame([(1, 20, 10), (2, 20, 11), (3, 99, 10)],
                                             "disp_id long, client_id long, account_id long"),
    }
    def write(name, df):
        df.write.parquet(os.path.join(tmp_dir, name))
        return spark.read.parquet(os.path.join(tmp_dir, name))
    loaded, counts = load.full_refresh(tables, write)
    got = {r["table_name"]: (r["loaded_rows"], r["rejected_rows"]) for r in counts.collect()}
    assert got == {"district": (1, 0), "account": (1, 1), "client": (2, 0), "disposition": (1, 2)}


def test_mart_written_by_month(spark, tmp_dir):
    import datetime as dt
    from ledgerflow.operators import mart
    fact = spark.createDataFrame([(1, dt.date(1999, 1, 5)), (2, dt.date(1999, 2, 1)),
                                  (3, dt.date(1999, 1, 30))], "trans_id long, transaction_date date")
    path = os.path.join(tmp_dir, "mart")
    mart.write_mart(fact, path)
    months = sorted(d for d in os.listdir(path) if d.startswith("transaction_month="))
    assert months == ["transaction_month=1999-01", "transaction_month=1999-02"]
    back = spark.read.parquet(path).where("transaction_month = '1999-01'")
    assert sorted(r["trans_id"] for r in back.collect()) == [1, 3]


def test_broken_lines_are_kept_apart(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trans.csv")
    head = "trans_id;account_id;date;type;operation;amount;balance;k_symbol;bank;account"
    lines = ["1;5;930101;PRIJEM;VKLAD;1.5;2.0;\"\";;", "2;5;930101;PRIJEM;VKLAD;n/a;2.0;;;", "3;5;930101", "x;5;930101;PRIJEM;;1.5;;;;",
             "4;5;930101;PRIJEM;;1.5;;;;;;9", "5;;930101;PRIJEM;;2.5;;SIPO;;"]
    with open(p, "w") as f:
        f.write("\n".join([head, *lines]) + "\n")
    good, bad = delimited.read_with_rejects(spark, p, "trans")
    assert sorted(r.trans_id for r in good.select("trans_id").collect()) == [1, 5]   # also where few columns are asked for
    assert {r.line for r in bad.collect()} == set(lines[1:5])
    rows = {r.trans_id: r for r in good.collect()}
    assert rows[1].k_symbol == "" and rows[5].account_id is None and good.columns == delimited.CANONICAL["trans"]


def test_readers_see_whole_loads_only(spark, tmp_dir):
    store = load.LoadedTables(tmp_dir)
    assert store.read(spark) == {}
    tables = lambda n: {"district": spark.createDataFrame([(i,) for i in range(n)], "district_id long"),
                        "account": spark.createDataFrame([(i, i) for i in range(9)], "account_id long, district_id long")}
    store.refresh(tables(4), 1)
    assert {t: df.count() for t, df in store.read(spark).items()} == {"district": 4, "account": 4}

    def refuse(loaded):
        assert loaded["district"].count() == 7          # written by now, and not seen yet
        assert store.read(spark)["district"].count() == 4
        raise ValueError("refused")
    try:
        store.refresh(tables(7), 2, refuse)
    except ValueError:
        pass
    assert store.read(spark)["account"].count() == 4
    store.refresh(tables(7), 3)
    assert store.create_views(spark, "loaded_") == ["account", "district"] and spark.table("loaded_account").count() == 7


def test_mart_as_catalog_table(spark, tmp_dir):
    import datetime as dt
    from ledgerflow.operators import mart
    fact = spark.createDataFrame([(i, i % 5, dt.date(1999, 1 + i % 3, 5)) for i in range(60)], "trans_id long, account_id long, transaction_date date")
    mart.save_mart(fact, "test_mart", os.path.join(tmp_dir, "mart"), buckets=4)
    again = fact.where("trans_id < 30 and month(transaction_date) = 2").withColumn("trans_id", F.col("trans_id") + 1000)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    mart.replace_months(again, "test_mart", 4)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    kept = fact.where("month(transaction_date) <> 2").select("trans_id").union(again.select("trans_id"))
    assert sorted(spark.table("test_mart").select("trans_id").collect()) == sorted(kept.collect())
    profile = spark.createDataFrame([(i, f"d{i}") for i in range(5)], "account_id long, district_name string")
    mart.save_bucketed(profile, "test_profile", os.path.join(tmp_dir, "profile"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("test_mart").join(spark.table("test_profile"), "account_id").groupBy("account_id").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan or "ShuffledHashJoin" in plan and "Exchange" not in plan
        assert joined.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table test_mart")
        spark.sql("drop table test_profile")
