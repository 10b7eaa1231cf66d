"""What the shared steps shuffle and write, and how much of it one task gets."""

from __future__ import annotations

import glob
import hashlib
import re
from collections import Counter
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from harness import landing, queries
from harness.bridge import order_line_versions
from tallygate.contract import RECORD_HASH
from tallygate.operators.classify import accepted_lines, classify
from tallygate.operators.versions import FileNames, rank_versions, with_hash_bytes, with_hash_text
from tallygate.plans import publish as publish_plan
from tallygate.plans.publish import publish_snapshot
from tallygate.session import settings, shuffles_for
from tallygate.sources.runs import read_order_lines, read_quarantine, read_superseded
from tallygate.sources.snapshot_csv import read_snapshot
from tests.shapes import HEADER, csv_line


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty line items of ten orders, with an order, a customer and a part that come twice."""
    folder = tmp_path_factory.mktemp("tables")
    moment = datetime(1996, 5, 6)
    made = {
        "nation": (
            [(n, f"N{n}", n % 2) for n in range(3)],
            "n_nationkey int, n_name string, n_regionkey int",
        ),
        "customer": ([(k, k % 3) for k in [0, 1, 2, 3, 3]], "c_custkey long, c_nationkey int"),
        "orders": (
            [(k, k % 5, moment) for k in [*range(10), 4]],
            "o_orderkey long, o_custkey long, o_orderdate timestamp",
        ),
        "part": (
            [(k, "SMALL", 30 + k, 900.0 + k) for k in [0, 1, 2, 3, 2]],
            "p_partkey long, p_type string, p_size int, p_retailprice double",
        ),
        "lineitem": (
            [(n % 11, n % 4, n % 4 + 1, 1.0 + n, 0.05, 0.02, "NR"[n % 2], moment) for n in range(40)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, "
            "l_tax double, l_returnflag string, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_customers_join_the_orders_before_the_line_items(spark, tables):
    """Line items are shuffled by two keys; with customers joined last it was by three."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        versions = order_line_versions(spark, tables)
        plan = versions._jdf.queryExecution().optimizedPlan().toString()
        rows = versions.count()
    relations = [line for line in plan.splitlines() if "Relation" in line]
    depth = {
        key: next(line.index("Relation") for line in relations if key in line)
        for key in ("c_custkey", "o_orderkey", "l_orderkey")
    }
    assert min(depth["c_custkey"], depth["o_orderkey"]) > depth["l_orderkey"]
    # orders 4 and customer 3 (of orders 3 and 8) and part 2 come twice, customer 4 and order 10 are missing
    orders = Counter([*range(10), 4])
    customers, parts = Counter([0, 1, 2, 3, 3]), Counter([0, 1, 2, 3, 2])
    assert rows == sum(orders[n % 11] * customers[n % 11 % 5] * parts[n % 4] for n in range(40))


def test_hashes_are_bytes_in_shuffles_and_keep_their_order(spark):
    texts = [hashlib.sha256(str(n).encode()).hexdigest() for n in range(50)]
    moment = datetime(2024, 1, 1)
    lines = spark.createDataFrame(
        [("o", "1", moment, text, "f") for text in [*texts, texts[0]]],
        f"order_id string, line_id string, updated_at timestamp, {RECORD_HASH} string, _source_file string",
    )
    packed = with_hash_bytes(lines)
    assert packed.schema[RECORD_HASH].dataType.simpleString() == "binary"
    assert all(len(row[0]) == 32 for row in packed.select(RECORD_HASH).collect())
    ranks = [
        sorted((row.dedup_rank, row[RECORD_HASH]) for row in frame.collect())
        for frame in (rank_versions(lines), with_hash_text(rank_versions(packed)))
    ]
    assert ranks[0] == ranks[1]
    assert with_hash_text(lines) is lines


def test_runs_are_written_in_a_codec_that_halves_hashes(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [csv_line(order_id=f"K{n % 9}", quantity=str(1 + n)) for n in range(20)]
    (raw / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    root = str(tmp_path / "lake")
    publish_snapshot(spark, str(raw), root, "run-1")
    for dataset in ("silver/order_lines", "audit/duplicates", "gold/daily_sales"):
        found = glob.glob(f"{root}/{dataset}/run_id=run-1/**/*.parquet", recursive=True)
        codecs = {
            pq.ParquetFile(path).metadata.row_group(0).column(0).compression
            for path in found
            if pq.ParquetFile(path).metadata.num_row_groups
        }
        assert codecs == {"ZSTD"}
    hashes = [
        row[0]
        for read in (read_order_lines, read_superseded)
        for row in read(spark, root, "run-1").select(RECORD_HASH).collect()
    ]
    assert len(hashes) == 20 and all(len(h) == 64 and h == h.lower() for h in hashes)


def test_shuffles_follow_the_size_in_pieces_that_a_task_can_sort(spark):
    name = "spark.sql.shuffle.partitions"
    assert shuffles_for(spark, 100 << 30)[name] == "1600"
    assert shuffles_for(spark, 0)[name] == spark.conf.get(name)


def test_a_line_number_is_dealt_over_many_headed_files(spark, tables, tmp_path):
    """Before, all lines of a number were sorted and written by one task."""
    raw = landing.write_headed_files(order_line_versions(spark, tables), f"{tmp_path}/raw", shares=5)
    lines = spark.read.text(raw).select("value", F.input_file_name().alias("file"))
    first = glob.glob(f"{raw}/file=2/*/*.txt")
    assert len(first) > 1
    for path in first:  # file 2 opens with a byte order mark, the header and two blank lines
        with open(path, encoding="utf-8") as opened:
            held = opened.read().split("\n")
        assert held[0] == "﻿" + landing._HEADER and held[1:3] == ["", "   "] and len(held) > 4
    data = lines.filter(F.col("value").startswith("O")).count()
    assert data == order_line_versions(spark, tables).count()


def test_header_contract_is_the_same_over_shares(spark, tables, monkeypatch):
    whole = sorted(queries.header_contract(spark, tables).collect())
    monkeypatch.setattr(queries, "LINES_A_SHARE", 7)
    dealt = sorted(queries.header_contract(spark, tables).collect())
    assert dealt == whole and [row.file for row in whole] == [1, 2, 3, 4, 1000]


def test_landed_files_are_compressed_and_hold_the_same_lines(spark, tables, tmp_path):
    versions = order_line_versions(spark, tables)
    raw = landing.write_snapshot_csv(versions, f"{tmp_path}/raw")
    names = glob.glob(f"{raw}/part-*")
    assert names and all(name.endswith(".csv.gz") for name in names)
    lines = [row.value for row in spark.read.text(raw).collect()]
    given = [row[0] for row in versions.select(landing.damaged_line()).collect()]
    assert sorted(lines) == sorted([*given, *[landing._HEADER] * len(names)])


def test_derived_columns_are_not_staged_and_come_back(spark, tmp_path, monkeypatch):
    """Amounts and dates follow from other columns, so neither staging nor shuffles carry them."""
    staged = {}
    write = publish_plan.Staged.write.__func__

    def noted(cls, frame, path, split):
        staged[split] = set(frame.columns)
        return write(cls, frame, path, split)

    monkeypatch.setattr(publish_plan.Staged, "write", classmethod(noted))
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [
        csv_line(order_id=f"D{n % 7}", quantity=str(2 + n), status="cancelled" if n % 3 else "completed")
        for n in range(21)
    ]
    (raw / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    root = str(tmp_path / "lake")
    publish_snapshot(spark, str(raw), root, "run-1")
    assert not staged[publish_plan.OUTCOME] & {"typed_gross_amount", "typed_net_amount"}
    assert not staged[publish_plan.CURRENT] & {"gross_amount", "net_amount", "order_date"}
    whole = accepted_lines(classify(read_snapshot(spark, str(raw))))
    names = whole.columns
    written = read_order_lines(spark, root, "run-1").select(*names).unionByName(
        read_superseded(spark, root, "run-1").select(*names)
    )
    assert sorted(map(str, written.collect())) == sorted(map(str, whole.collect()))


def test_hashes_are_neither_staged_nor_shuffled_and_come_back(spark, tmp_path, monkeypatch):
    """Hashes follow from the values of a line, and from its texts where the values don't spell them."""
    staged, shuffled = {}, []
    write, rank = publish_plan.Staged.write.__func__, publish_plan.rank_at_scale

    def noted(cls, frame, path, split):
        staged[split] = set(frame.columns)
        return write(cls, frame, path, split)

    def ranked(lines, *args, **kwargs):
        shuffled.append(set(lines.columns))
        return rank(lines, *args, **kwargs)

    monkeypatch.setattr(publish_plan.Staged, "write", classmethod(noted))
    monkeypatch.setattr(publish_plan, "rank_at_scale", ranked)
    raw = tmp_path / "raw"
    raw.mkdir()
    odd = [
        {"quantity": "007"}, {"unit_price": "8"}, {"unit_price": "8.5", "discount_amount": "00.40"}, {"category": "Étagère"},
        {"quantity": "x"}, {"unit_price": "07.x"}, {"order_timestamp": "2023-02-30T00:00:00"}, {"customer_id": ""}, {},
    ]
    # every change once as a line of its own and once as a version of the same line: ties of updated_at
    lines = [csv_line(**{"order_id": f"H{n}", **c}) for n, c in enumerate(odd)]
    lines += [csv_line(**{"order_id": "H", **c}) for c in odd]
    (raw / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    whole = classify(read_snapshot(spark, str(raw)))
    wanted = {
        accepted: sorted(row[0] for row in whole.filter(F.col("accepted") == accepted).select(RECORD_HASH).collect())
        for accepted in (True, False)
    }
    assert (len(wanted[True]), len(wanted[False])) == (10, 8)
    for crowd in (1, 1000):
        root = str(tmp_path / f"lake-{crowd}")
        publish_snapshot(spark, str(raw), root, "run-1", max_reject_ratio=0.5, crowd=crowd)
        current, older = read_order_lines(spark, root, "run-1"), read_superseded(spark, root, "run-1")
        held = [row[0] for frame in (current, older) for row in frame.select(RECORD_HASH).collect()]
        assert sorted(held) == wanted[True]
        assert sorted(row[0] for row in read_quarantine(spark, root, "run-1").select(RECORD_HASH).collect()) == wanted[False]
        tied = [row[0] for row in older.orderBy("dedup_rank").select(RECORD_HASH).collect()]
        assert tied == sorted(tied, reverse=True) and len(tied) == 4
        assert current.filter("order_id = 'H'").first()[RECORD_HASH] > tied[0]
    assert all(RECORD_HASH not in columns for columns in [*staged.values(), *shuffled])


@pytest.mark.parametrize(
    "texts",
    [["x/a-1.csv", "x/a-22.csv", None], ["x/a.csv"], ["aa", "a", "aaa"], ["é/ü.csv", "é/ö.csv"], ["", "b"], [None], []],
)
def test_what_file_names_have_in_common_is_left_out_and_comes_back(spark, texts):
    lines = spark.createDataFrame([(text,) for text in texts], "_source_file string")
    names = FileNames.of(lines)
    short = [row[0] for row in names.cut(lines).collect()]
    assert sorted(map(str, (row[0] for row in names.whole(names.cut(lines)).collect()))) == sorted(map(str, texts))
    wanted = {"x/a-1.csv": ["1", "22", None], "x/a.csv": [""], "é/ü.csv": ["ü", "ö"]}
    assert not texts or texts[0] not in wanted or short == wanted[texts[0]]


def test_cancelled_lines_are_made_from_the_landed_ones(spark, tables, tmp_path):
    """The tables were joined a second time for them."""
    versions = order_line_versions(spark, tables)
    cut = F.when(F.col("line_id") == "2", "extra").when(F.col("line_id") == "3", "quote").alias("damage")
    odd = F.when(F.col("line_id") == "4", " complETED ").when(F.col("line_id") == "1", "on hold").otherwise(F.col("status"))
    versions = versions.select(*versions.drop("damage", "status").columns, odd.alias("status"), cut)
    completed = F.upper(F.trim("status")) == "COMPLETED"
    swapped = versions.withColumn("status", F.when(completed, "cancelled").otherwise(F.col("status")))
    landing.write_snapshot_csv(versions, f"{tmp_path}/raw")
    landing.write_snapshot_csv(swapped, f"{tmp_path}/wanted")
    lines = landing.landed_lines(spark, f"{tmp_path}/raw").select(landing.cancelled_line())
    landing.write_csv_lines(lines, f"{tmp_path}/cancelled")

    def rows(name):
        return sorted(map(str, landing.landed_lines(spark, f"{tmp_path}/{name}").collect()))

    assert rows("cancelled") == rows("wanted") != rows("raw")
    assert sorted(map(str, read_snapshot(spark, f"{tmp_path}/cancelled").drop("_source_file").collect())) == sorted(
        map(str, read_snapshot(spark, f"{tmp_path}/wanted").drop("_source_file").collect())
    )


def test_partitions_are_counted_by_lines_as_well_as_by_bytes(spark, tmp_path, monkeypatch):
    """Lines that compress well take few bytes on storage, but as many as others where they are sorted."""
    sizes = []
    monkeypatch.setattr(publish_plan, "shuffles_for", lambda spark, size: sizes.append(size) or shuffles_for(spark, size))
    monkeypatch.setattr(publish_plan, "_LINE_BYTES", 1 << 20)
    (tmp_path / "raw").mkdir()
    lines = [csv_line(order_id=f"O{n}") for n in range(300)]
    (tmp_path / "raw" / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    publish_snapshot(spark, f"{tmp_path}/raw", f"{tmp_path}/lake", "run-1")
    assert sizes == [300 << 20]


def test_the_method_for_a_landed_line_is_small_enough_for_the_jvm(spark, tables):
    """The JVM leaves methods of 8,000 bytes and more uncompiled."""
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):  # else the plan is not yet compiled
        lines = order_line_versions(spark, tables).select(landing.damaged_line())
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = lines._jdf.queryExecution().explainString(mode)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, max(sizes)


def test_names_of_files_are_counted_before_their_ends_are_compared(spark):
    """Least texts are not aggregated in place, so each line was sorted and compared one by one."""
    lines = spark.range(9).select(F.concat(F.lit("part-"), F.col("id") % 3).alias("_source_file"))
    plan = FileNames.ends(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.count("Aggregate [_source_file") == 1, plan
    assert FileNames.of(lines) == FileNames("part-", "")


def test_outcomes_are_read_once_from_raw_files_and_once_from_the_run(spark, tmp_path, monkeypatch):
    """The raw lines were parsed a second time to count those of each file."""
    (tmp_path / "raw").mkdir()
    for part in range(2):
        lines = [csv_line(order_id=f"O{part}{n}", status="?" if n == 3 else "COMPLETED") for n in range(9)]
        (tmp_path / "raw" / f"{part}.csv").write_text("\n".join([HEADER, *lines, lines[0]]) + "\n")
    place = landing.Landed(f"{tmp_path}/lake", f"{tmp_path}/raw", f"{tmp_path}/mart")
    publish_snapshot(spark, place.raw, place.root, place.run_id)
    monkeypatch.setattr(queries, "published", lambda spark, sf_dir: place)
    found = queries.exhaustive_outcomes(spark, "")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" text") == 1 and plan.count(" parquet") == 3, plan
    assert [tuple(row) for row in found.collect()] == [(20, True, 0)]
    other = f"{tmp_path}/raw/0.csv"
    with open(other, "a") as file:
        file.write(csv_line(order_id="O9") + "\n")
    assert [tuple(row) for row in queries.exhaustive_outcomes(spark, "").collect()] == [(20, False, 1)]


def test_outcomes_are_staged_without_a_sort():
    """A task that opens as many files as this sorts all rows that follow."""
    outcomes = ("accepted", "rejected", "skipped")
    assert int(publish_plan._STAGING["spark.sql.maxConcurrentOutputFileWriters"]) > len(outcomes)
