"""Export files, contract records, seeds and the streaming jobs."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from ledgermill.operators import contract, materialize
from ledgermill.plans import derived
from ledgermill.sources import exports, tables
from ledgermill.streaming import ingest as stream_ingest
from ledgermill.streaming import metrics as stream_metrics

AT = datetime(2024, 3, 1, 8, 0, 0)

CHASE = """Transaction Date,Post Date,Description,Category,Type,Amount,Memo
2024-02-13,2024-02-14,STARBUCKS #1,Food,Sale,"$1,234.50",coffee online
02/13/2024,,AMAZON,Shopping,Sale,-20.00,
2024-02-13,2024-02-14,STARBUCKS #1,Food,Sale,"$1,234.50",coffee online
,02/15/2024,POST DATED,Misc,Debit card,5.00,
bad-date,,NOWHERE,Misc,Sale,5.00,
2024-02-13,,NOTHING,Misc,Sale,,
2024-02-13,,ZERO,Misc,Sale,0,
"""
AMEX = """Date,Description,Category,Amount,Reference
13/02/2024,UBER,Travel,30.00,ref 1
02/14/2024,REFUND,Travel,-7.50,ref 2
"""
WELLS = """Date,Description,Amount,Type,Balance
2024-02-13,RENT,-900.00,ACH,"1,100.00"
"""
GENERIC = """Date,Description,Amount,Category
2024-02-13,CORNER SHOP,-3.20,Food
"""


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture()
def files(folder):
    return exports.group_files(
        [
            write(folder, "Chase_2024.csv", CHASE),
            write(folder, "amex_feb.csv", AMEX),
            write(folder, "wells_fargo.csv", WELLS),
            write(folder, "other.csv", GENERIC),
        ]
    )


def test_specs_by_file_name():
    assert exports.spec_for("CHASE-01.csv").institution == "Chase"
    assert exports.spec_for("american_express.csv").is_credit
    assert not exports.SPECS["chase"].is_credit
    assert exports.spec_for("bank_of_america.csv").institution == "Bank of America"
    assert exports.spec_for("x.csv").institution == "Unknown"


def test_ingest_valid_and_rejected(spark, files):
    loaded = exports.ingest(spark, files, AT)
    valid, rejected = loaded.valid, loaded.rejected
    assert loaded.failures.count() == 0
    got = rows_of(valid, "institution", "merchant_raw", "amount", "posted_at", "description", "channel")
    assert got == sorted(
        [
            ("American Express", "REFUND", Decimal("-7.50"), datetime(2024, 2, 14), "ref 2", "unknown"),
            ("American Express", "UBER", Decimal("-30.00"), datetime(2024, 2, 13), "ref 1", "unknown"),
            ("Chase", "AMAZON", Decimal("-20.00"), datetime(2024, 2, 13), "Sale", "unknown"),
            ("Chase", "POST DATED", Decimal("5.00"), datetime(2024, 2, 15), "Debit card", "pos"),
            ("Chase", "STARBUCKS #1", Decimal("1234.50"), datetime(2024, 2, 13), "coffee online", "ecom"),
            ("Unknown", "CORNER SHOP", Decimal("-3.20"), datetime(2024, 2, 13), "", "unknown"),
            ("Wells Fargo", "RENT", Decimal("-900.00"), datetime(2024, 2, 13), "ACH", "ach"),
        ],
        key=repr,
    )
    assert rows_of(rejected, "merchant_raw", "reject_reason") == [
        ("NOTHING", "unreadable amount"),
        ("NOWHERE", "unreadable date"),
        ("ZERO", "zero amount"),
    ]
    assert valid.select("import_batch_id").distinct().count() == 4
    balance = valid.filter("institution = 'Wells Fargo'").first()["balance_after"]
    assert balance == Decimal("1100.00")


def test_ids_are_repeatable(spark, files):
    first = exports.ingest(spark, files, AT).valid
    again = exports.ingest(spark, files, datetime(2025, 1, 1)).valid
    assert rows_of(first, "txn_id") == rows_of(again, "txn_id")
    assert all(len(t) == 64 for (t,) in rows_of(first, "txn_id"))


def test_malformed_rows_do_not_stop_a_file(spark, folder):
    path = write(folder, "amex_bad.csv", AMEX + "2024-02-13,too,few\n")
    loaded = exports.ingest(spark, {"amex": path}, AT)
    assert loaded.valid.count() == 2
    assert rows_of(loaded.rejected, "reject_reason") == [("malformed row",)]


QUOTED = """Date,Description,Amount,Type,Balance
2024-02-13,"JOE ""THE"" CAFE, NYC",-4.50,debit,10
2024-02-14,"TWO
LINES, ""AND"" QUOTES",-5.50,"debit
card",20
2024-02-15,PLAIN,-6.50,debit,30
"""


@pytest.mark.parametrize("limit", ["128m", "40b"])
def test_quotes_and_line_ends_in_cells(spark, folder, limit):
    """As one task would read the file, and as a file larger than a split."""
    path = write(folder, "wells_q.csv", QUOTED)
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    try:
        loaded = exports.ingest(spark, {"wells_fargo": path}, AT)
        assert loaded.rejected.count() == 0
        assert rows_of(loaded.valid, "merchant_raw", "amount", "description") == [
            ('JOE "THE" CAFE, NYC', Decimal("-4.50"), "debit"),
            ("PLAIN", Decimal("-6.50"), "debit"),
            ('TWO\nLINES, "AND" QUOTES', Decimal("-5.50"), "debit\ncard"),
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_files_without_line_ends_in_cells_are_split(spark, folder):
    rows = "".join(f'2024-02-13,"SHOP ""{i}"", x",-{i}.50,debit,1\n' for i in range(1, 200))
    path = write(folder, "wells_l.csv", WELLS.splitlines()[0] + "\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert exports.whole_files(spark, [path]) == ([], [path])
        loaded = exports.ingest(spark, {"wells_fargo": path}, AT)
        assert loaded.valid.count() == 199 and loaded.rejected.count() == 0
        assert loaded.valid.filter("""merchant_raw = 'SHOP "7", x'""").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_columns_are_bound_by_name(spark, folder):
    """Another order, another column, a byte-order mark and quoted names."""
    path = write(folder, "wells.csv", '\ufeffDate,Type,"Amount",Branch,Description,Balance\n2024-02-13,debit,-4.50,7,COFFEE SHOP,10\n')
    (row,) = exports.ingest(spark, {"wells_fargo": path}, AT).valid.collect()
    assert (row.merchant_raw, row.description, row.amount, row.balance_after) == ("COFFEE SHOP", "debit", Decimal("-4.50"), Decimal("10.00"))


def test_unreadable_files_stop_nothing(spark, folder):
    files = {
        "amex": [write(folder, "amex good.csv", AMEX), write(folder, "amex_short.csv", "Date,Description,Category\n"), f"{folder}/gone.csv"],
        "chase": [f"{folder}/none*.csv", write(folder, "chase_empty.csv", ""), write(folder, "chase_twice.csv", "Amount,Amount\n")],
        "wells_fargo": write(folder, "wells.csv", WELLS),
    }
    loaded = exports.ingest(spark, files, AT)
    assert loaded.valid.count() == 3
    assert sorted((r.institution, r.file.rsplit("/", 1)[-1], r.reason) for r in loaded.failures.collect()) == [
        ("American Express", "amex_short.csv", "missing columns: amount, description"),
        ("American Express", "gone.csv", "missing file"),
        ("Chase", "chase_empty.csv", "no header"),
        ("Chase", "chase_twice.csv", "repeated column names"),
        ("Chase", "none*.csv", "missing file"),
    ]
    nothing = exports.ingest(spark, {"chase": f"{folder}/gone.csv"}, AT)
    assert (nothing.valid.count(), nothing.rejected.count(), nothing.failures.count()) == (0, 0, 1)


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("2024-01-01",)], "Date string")
    with pytest.raises(ValueError, match="amount"):
        exports.map_columns(df, exports.SPECS["amex"])
    with pytest.raises(ValueError, match="txn_id"):
        contract.check_columns(["amount"])
    with pytest.raises(ValueError, match="extra"):
        contract.check_columns([*contract.REQUIRED_RAW_COLUMNS, "extra"])


def test_ingested_rows_meet_the_contract(spark, files):
    valid = exports.ingest(spark, files, AT).valid
    good, bad = contract.split_valid(exports.to_contract(valid))
    assert good.count() == 7 and bad.count() == 0


def test_append_adds_only_new_ids(spark, files, folder):
    valid = exports.ingest(spark, files, AT).valid
    path = f"{folder}/raw"
    for _ in range(2):
        target = spark.read.parquet(path) if _ else valid.limit(0)
        materialize.append_new(target, valid, "txn_id").write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 7


def test_seed_files(spark, folder):
    categories = write(folder, "c.csv", "category_id,parent_id,name,budget_group,is_income\n1,,Income,Income,true\n")
    rates = write(folder, "f.csv", "date,usd_to_eur,usd_to_gbp,usd_to_cad,usd_to_aud\n2024-01-01,0.92,0.79,1.35,1.48\n")
    rules = write(
        folder, "m.csv", "rule_id,pattern,merchant_clean,mcc,category_std,risk_flag,priority\n1,AMAZON,Amazon,5999,Shop,false,1\n"
    )
    assert tables.read_categories(spark, categories).first()["is_income"] is True
    assert tables.read_fx_rates(spark, rates).first()["usd_to_eur"] == Decimal("0.920000")
    assert tables.read_merchant_rules(spark, rules) == [(1, "AMAZON", "Amazon", "5999", "Shop", False, 1)]


def _send(spark, df, path):
    df.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def test_stream_equals_batch(spark, small, folder):
    """Newer files first, then an older backfill, corrections, repeats and broken records, at default settings."""
    raw = derived.raw_ledger(spark, small).withColumn("balance_after", F.lit(None).cast("decimal(15,2)"))
    broken = raw.limit(3).withColumn("currency", F.lit("usd"))
    corrected = raw.orderBy("txn_id").limit(20).withColumn("merchant_raw", F.lit("CORRECTED"))
    inbox, target, quarantine, state = (f"{folder}/{n}" for n in ("in", "out", "bad", "state"))
    _send(spark, raw.filter("posted_at >= '1999-01-01'"), inbox)
    stream_ingest.run_ingest(spark, inbox, target, quarantine, state).awaitTermination()
    first = stream_ingest.current_rows(spark, target).count()
    _send(spark, raw, inbox)
    stream_ingest.run_ingest(spark, inbox, target, quarantine, state, files_per_trigger=1).awaitTermination()
    _send(spark, corrected, inbox)
    _send(spark, broken, inbox)
    stream_ingest.run_ingest(spark, inbox, target, quarantine, state, files_per_trigger=1).awaitTermination()
    twin = stream_ingest.batch_twin(tables.read_contract_json(spark, inbox))
    got = stream_ingest.current_rows(spark, target)
    assert first < got.count() == twin.count() == raw.count()
    assert got.filter("merchant_raw = 'CORRECTED'").count() == 20
    assert rows_of(got, "txn_id", "amount", "merchant_raw") == rows_of(twin, "txn_id", "amount", "merchant_raw")
    assert rows_of(spark.read.parquet(quarantine).select(F.explode("reasons"))) == [("currency pattern",)] * 3


@pytest.mark.parametrize("files", [None, 1])
def test_metric_stream_equals_batch(spark, small, folder, files):
    from ledgermill.operators.metrics import windowed_summary

    events = derived.read(spark, small, "events")
    events.repartitionByRange(3, "ts").write.parquet(f"{folder}/in")
    reader = spark.readStream.schema(events.schema)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(f"{folder}/in")
    stream_metrics.run_summary(spark, stream, f"{folder}/out", f"{folder}/state", "1 day").awaitTermination()
    batch = windowed_summary(stream_metrics.event_points(events), "1 day")
    columns = ["window_start", "name", "count", "min", "max", "first", "latest"]
    assert rows_of(stream_metrics.current_windows(spark, f"{folder}/out"), *columns) == rows_of(batch, *columns)


def test_late_events_count(spark, folder):
    """An event of a window that closed long ago, in a later run."""
    from ledgermill.operators.metrics import windowed_summary

    schema = "event_id long, ts timestamp, event_type string, value double"
    def send(*rows):
        spark.createDataFrame([(i, datetime.fromisoformat(t), "a", v) for i, (t, v) in enumerate(rows)], schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        stream_metrics.run_summary(spark, stream, f"{folder}/out", f"{folder}/state", "1 day").awaitTermination()

    send(("2024-01-01T10:00:00", 1.0), ("2024-01-03T10:00:00", 5.0))
    send(("2024-01-01T09:00:00", 100.0), ("2024-01-01T11:00:00", None))
    batch = windowed_summary(stream_metrics.event_points(spark.read.schema(schema).parquet(f"{folder}/in")), "1 day")
    got = stream_metrics.current_windows(spark, f"{folder}/out")
    assert rows_of(got, *batch.columns) == rows_of(batch)
    assert [(r["count"], r["max"], r["avg"], r["first"], r["latest"]) for r in got.orderBy("window_start").collect()][0] == (3, 100.0, 50.5, 100.0, None)


def test_merges_that_die_hide_nothing(spark, small, folder):
    """Merged batches, a merge without its marker, moved keys, and batches removed."""
    from ledgermill.operators.materialize import PartitionedMart
    from ledgermill.streaming import compaction

    inbox, target, quarantine, state = (f"{folder}/{n}" for n in ("in", "out", "bad", "state"))
    raw = derived.raw_ledger(spark, small).limit(200).withColumn("balance_after", F.lit(None).cast("decimal(15,2)")).cache()

    def arrive(df):
        _send(spark, df, inbox)
        stream_ingest.run_ingest(spark, inbox, target, quarantine, state).awaitTermination()

    def whole():
        twin = stream_ingest.batch_twin(tables.read_contract_json(spark, inbox))
        got = stream_ingest.current_rows(spark, target)
        return rows_of(got, "txn_id", "posted_at", "amount") == rows_of(twin, "txn_id", "posted_at", "amount")

    moved = raw.filter("txn_id < '4'").withColumn("posted_at", F.col("posted_at") + F.expr("INTERVAL 40 DAYS"))
    arrive(raw)
    assert stream_ingest.merge_batches(spark, target) == 0 and whole()
    arrive(moved)
    assert whole()
    # a merge that wrote the months and died before its marker
    rows = stream_ingest.newest(compaction._batches(spark, target, [1]), ["txn_id"], stream_ingest._version())
    PartitionedMart(spark, f"{target}/_base", "posted_at").upsert(rows, ["txn_id"], stream_ingest._version())
    assert whole()
    assert stream_ingest.merge_batches(spark, target) == 1 and whole()
    assert compaction.discard_merged(spark, target) == 2 and whole()
    assert stream_ingest.merge_batches(spark, target) == 1 and whole()
    arrive(raw.limit(5))
    assert whole()
    # a folder that is not complete is not read
    raw.withColumn("amount", F.lit(0)).write.parquet(f"{target}/batch_id=99")
    import os

    os.remove(f"{target}/batch_id=99/_SUCCESS")
    assert compaction.finished_batches(spark, target) == [2]
    raw.unpersist()


def test_audit_log(spark, folder):
    import os

    from ledgermill.operators.privacy import AuditLog

    log = AuditLog(spark, f"{folder}/log")
    with pytest.raises(ValueError, match="no audit events"):
        log.read()
    events = spark.createDataFrame([("u", 1), ("v", 2)], "user_id string, n int")
    assert log.append(events, "load 1") and not log.append(events, "load 1") and log.append(events.withColumn("more", F.lit(1)), "load 2")
    assert log.read().count() == 4
    name = next(n for n in os.listdir(f"{folder}/log"))
    os.remove(f"{folder}/log/{name}/_SUCCESS")  # died before the commit
    assert log.read().count() == 2
    assert log.append(events, "load 1") or log.append(events, "load 2")
    assert log.read().count() == 4


def test_measured_load(spark, folder):
    from ledgermill.operators import metrics

    points = metrics.measured(spark.range(1000), lambda df: df.write.parquet(f"{folder}/t"), "t", datetime(2024, 1, 1))
    got = {r["name"]: r.value for r in points.collect()}
    assert got["data_processing_rows"] == 1000 and got["data_processing_duration_ms"] > 0
    assert got["data_processing_throughput"] == pytest.approx(1000 / (got["data_processing_duration_ms"] / 1000))
    assert spark.read.parquet(f"{folder}/t").count() == 1000
    stream = spark.readStream.schema("id long").parquet(f"{folder}/t").writeStream.foreachBatch(lambda df, _: df.count())
    query = stream.option("checkpointLocation", f"{folder}/s").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = {r["name"]: r.value for r in metrics.stream_points(query, "t", datetime(2024, 1, 1)).collect()}
    assert rows["data_processing_rows"] == 1000 and rows["data_processing_duration_ms"] > 0


def test_partitioned_mart(spark, folder):
    """First load, second load and replay touch only the partitions of their rows."""
    import glob
    import os

    def batch(rows, schema="date date, n int"):
        return spark.createDataFrame([(datetime.fromisoformat(d).date() if d else None, *r) for d, *r in rows], schema)

    def files():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/m/*/*/*.parquet")}

    mart = materialize.PartitionedMart(spark, f"{folder}/m", "date")
    assert mart.newer(batch([("2024-01-05", 1)])).count() == 1
    mart.upsert(batch([("2024-01-05", 1), ("2024-01-06", 2), ("2024-02-01", 3), (None, 9)]), ["date"])
    january = {f: t for f, t in files().items() if "part_month=1/" in f}
    for _ in range(2):
        mart.upsert(batch([("2024-02-01", 30, "x"), ("2024-03-01", 4, "y"), (None, 90, None)], "date date, n int, extra string"), ["date"])
        assert {f: t for f, t in files().items() if "part_month=1/" in f} == january
        got = sorted(((str(r.date), r.n, r.extra) for r in mart.read().collect()))
        assert got == [("2024-01-05", 1, None), ("2024-01-06", 2, None), ("2024-02-01", 30, "x"), ("2024-03-01", 4, "y"), ("None", 90, None)]
    newer = mart.newer(batch([("2024-03-01", 5), ("2024-03-02", 6), ("2024-01-31", 7)]))
    assert [r.n for r in newer.collect()] == [6]
    with pytest.raises(ValueError, match="part_year"):
        materialize.with_partitions(batch([("2024-01-05", 1)]).withColumn("part_year", F.lit(1)), "date")


def test_moved_keys(spark, folder):
    """A key whose row moves to another month stands once, through replays, appends and an interrupted load."""
    from datetime import date

    def batch(*rows):
        return spark.createDataFrame([(k, d and date.fromisoformat(d), n) for k, d, n in rows], "k string, date date, n int")

    def stored():
        return sorted((str(r.k), str(r.date), r.n) for r in mart.read().collect())

    mart = materialize.PartitionedMart(spark, f"{folder}/m", "date")
    mart.upsert(batch(("x", "2024-01-05", 1), ("y", "2024-01-06", 2), ("z", "2024-02-01", 3), (None, None, 4)), ["k"])
    moved = batch(("z", "2024-03-01", 30), ("x", "2024-02-02", 10), (None, "2024-03-03", 40))
    want = [("None", "2024-03-03", 40), ("x", "2024-02-02", 10), ("y", "2024-01-06", 2), ("z", "2024-03-01", 30)]
    for _ in range(2):
        mart.upsert(moved, ["k"])
        assert stored() == want
    mart.append(batch(("x", "2024-05-01", 5), ("z", "2024-01-01", 6), (None, "2024-01-01", 7), ("w", "2024-01-09", 8), ("w", "2024-01-09", 8)), "k")
    want = sorted([*want, ("w", "2024-01-09", 8)])
    assert stored() == want
    # noted in the index, never written: the replay adds it
    lost = batch(("v", "2024-07-07", 9), ("y", "2024-07-08", 20))
    mart._note(materialize.with_partitions(lost, "date"), ["k"])
    mart.append(lost, "k")
    assert stored() == sorted([*want, ("v", "2024-07-07", 9)])
    mart.upsert(lost, ["k"])
    assert ("y", "2024-07-08", 20) in stored() and len(stored()) == 6


def test_a_month_that_empties(spark, folder):
    from datetime import date

    mart = materialize.PartitionedMart(spark, f"{folder}/m", "date")
    one = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", None)], "k string, date date")
    mart.upsert(one, ["k"])
    two = spark.createDataFrame([("a", date(2024, 2, 1)), ("b", date(2024, 2, 2))], "k string, date date")
    mart.upsert(two, ["k"])
    assert rows_of(mart.read()) == rows_of(two)


def _shared_folders(spark):
    import os

    from ledgermill.session import shared_dir

    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_loads_leave_only_the_mart(spark, folder, monkeypatch):
    """Loads in several shares of the keys give the rows of a whole one, and nothing but the mart stays on disk."""
    import os

    day = F.date_add(F.lit("2024-01-15").cast("date"), (F.col("n") % 90).cast("int"))
    rows = spark.range(400).select(F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    rows = rows.unionByName(rows.filter("n < 20")).withColumn("date", F.when(F.col("n") % 7 > 0, day))
    moved = rows.filter("n % 4 = 1").withColumns({"date": F.date_add("date", 40), "n": -F.col("n")})
    newer = rows.filter("n % 10 = 3").withColumn("n", F.col("n") + 500)
    old = _shared_folders(spark)

    def load(name):
        mart = materialize.PartitionedMart(spark, f"{folder}/{name}", "date")
        for batch in (rows, moved, moved):
            mart.upsert(batch, ["k"])
        mart.append(rows.unionByName(rows.filter("n < 9").withColumn("k", F.concat("k", F.lit("x")))), "k")
        mart.upsert(newer.unionByName(newer.withColumn("n", F.lit(0))), ["k"], F.col("n"))
        left = {n.split("=")[0] for n in os.listdir(f"{folder}/{name}") if n[0] != "."}
        assert left == {"part_year", "_keys", "_SUCCESS"} and _shared_folders(spark) == old
        return rows_of(mart.read())

    whole = load("whole")
    monkeypatch.setattr(materialize, "ROWS_PER_TURN", 100)
    assert len(materialize.shares(["k"], rows, None)) == 5
    assert load("shared") == whole and len(whole) > 400


def test_streams_leave_only_their_table(spark, small, folder, monkeypatch):
    """Batches taken and merged in several shares of the keys give the rows of whole ones; arrivals and copies do not stay."""
    from ledgermill.plans.registry import QUERIES

    def run():
        before = _shared_folders(spark)
        rows = rows_of(QUERIES["stream_compacted"](spark, small))
        return rows, sorted(n.rsplit("-", 1)[0] for n in _shared_folders(spark) - before)

    whole, left = run()
    assert left == ["ingest-state", "ledger", "quarantine"]
    monkeypatch.setattr(materialize, "ROWS_PER_TURN", 400)
    assert run() == (whole, left) and len(whole) == 1500
    # a batch that died between its shares is not there, and its replay is whole
    raw = derived.raw_ledger(spark, small).withColumn("balance_after", F.lit(None).cast("decimal(15,2)"))
    _send(spark, raw, f"{folder}/in")
    raw.limit(9).write.parquet(f"{folder}/out/_batch_id=0")
    assert stream_ingest.compaction.finished_batches(spark, f"{folder}/out") == []
    stream_ingest.run_ingest(spark, f"{folder}/in", f"{folder}/out", f"{folder}/bad", f"{folder}/state").awaitTermination()
    assert stream_ingest.compaction.finished_batches(spark, f"{folder}/out") == [0]
    got, want = (rows_of(df, "txn_id", "posted_at", "amount") for df in (stream_ingest.current_rows(spark, f"{folder}/out"), raw))
    assert got == want


def test_partition_columns(spark, folder):
    """A whole-number month is no calendar month; small marts are one folder, large ones are cut by month."""
    day = F.lit("2024-01-05").cast("date")
    assert materialize.partition_column(spark.range(1).select(F.lit(3).alias("month"), day.alias("transaction_date"))) == "transaction_date"
    assert materialize.partition_column(spark.range(1).select(F.lit(3).alias("month"))) is None
    assert materialize.partition_column(spark.range(1).select(F.lit("2024-01").alias("month"))) == "month"
    assert materialize.partition_column(spark.range(1).select(F.lit("x").alias("date"), day.alias("month"))) == "month"
    df = spark.range(30).select("id", F.date_add(day, F.col("id").cast("int")).alias("date"))
    assert materialize.export_mart(df, f"{folder}/small") == []
    assert materialize.export_mart(df, f"{folder}/large", 15) == ["part_year", "part_month"]
    assert rows_of(spark.read.parquet(f"{folder}/small")) == rows_of(spark.read.parquet(f"{folder}/large"), "id", "date") == rows_of(df)
    materialize.export_mart(df.limit(0), f"{folder}/small")
    assert spark.read.parquet(f"{folder}/small").count() == 0


def test_exports_keep_their_columns(spark, folder):
    daily = spark.createDataFrame([("2001-06-01", "2001-06", 1), ("2002-06-01", "2002-06", 2)], "date string, month string, n int")
    daily = daily.withColumn("date", F.col("date").cast("date"))
    paths = materialize.export_marts({"daily": daily, "plain": daily.select("n")}, f"{folder}/marts")
    assert rows_of(spark.read.parquet(paths["daily"]), *daily.columns) == rows_of(daily)
    assert rows_of(spark.read.parquet(paths["plain"])) == rows_of(daily, "n")


def test_free_dates(spark):
    from ledgermill.functions import clean

    texts = ["Jan 5, 2024", "January 5, 2024", "5-Jan-2024", "5 January 2024", "20240105", "01/05/24", "2024/1/5", "5.1.2024", " 2024-01-05 "]
    df = spark.createDataFrame([(t,) for t in [*texts, "20241345", "2024", "soon", None]], "t string")
    got = [r.d for r in df.select(clean.std_date(F.col("t")).alias("d")).collect()]
    assert got == [datetime(2024, 1, 5)] * len(texts) + [None] * 4
