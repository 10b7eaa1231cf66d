"""Registered queries: each runs an operator of the engine over the whole bridged snapshot."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from harness.bridge import order_line_versions, roomy_joins
from harness.landing import (
    BATCH_DATE,
    LINES_A_SHARE,
    MOST_REJECTED,
    RUN_ID,
    cancelled_line,
    in_lake,
    landed,
    landed_lines,
    promoted,
    published,
    shared_folder,
    write_csv_lines,
    write_headed_files,
)
from tallygate.contract import CORRUPT, DAILY_SALES, RUN_METRICS, SOURCE_COLUMNS, SOURCE_FILE
from tallygate.operators import reports
from tallygate.operators.classify import ACCEPTED, accepted_lines, classify, rejected_rows
from tallygate.operators.daily import daily_sales, overflowed, summary
from tallygate.operators.quality import QualityError, RowCounts, daily_totals, digest_columns
from tallygate.operators.versions import (
    RANK,
    current_lines,
    latest_lines,
    rank_at_scale,
    rank_versions,
    superseded_lines,
    with_hash_bytes,
    with_hash_text,
)
from tallygate.plans.attempts import begin_attempt, live_staging, recover_attempts
from tallygate.plans.lake import run_sql
from tallygate.plans.lease import LeaseLostError
from tallygate.plans.promote import (
    begin_load,
    current_mart,
    load_audit,
    mart_after_load,
    misfits,
    promote_run,
    resume_run,
    show_mart,
)
from tallygate.plans.publish import publish_snapshot
from tallygate.session import settings, use_contract_time
from tallygate.sources import files
from tallygate.sources.registry import published_runs
from tallygate.sources.runs import (
    MANIFEST,
    data_files,
    read_daily_sales,
    read_listed_daily_sales,
    read_manifest,
    read_order_lines,
    read_quarantine,
    read_superseded,
    RunLayout,
    success_marker,
)
from tallygate.sources.snapshot_csv import (
    HeaderError,
    SnapshotFiles,
    check_headers,
    is_data,
    parse_lines,
    read_snapshot,
    snapshot_lines,
    sound_files,
)

Query = Callable[[SparkSession, str], DataFrame]
_NOT_COMPARED = ("_source_file", CORRUPT, "loaded_at", "completed_at")


def plain(frame: DataFrame) -> DataFrame:
    """Dates and times as text; provenance that depends on the file names left out."""

    def shown(name: str) -> Column:
        kind = frame.schema[name].dataType
        if isinstance(kind, TimestampType):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name).cast("string").alias(name) if isinstance(kind, DateType) else F.col(name)

    return frame.select(*(shown(name) for name in frame.columns if name not in _NOT_COMPARED))


def rows_as_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot's rows as the CSV reader hands them on, without a trip through files."""
    use_contract_time(spark)
    versions = order_line_versions(spark, sf_dir)
    quote = F.coalesce(F.col("damage") == "quote", F.lit(False))
    return versions.select(
        *(F.when(~quote, F.col(name)).alias(name) for name in SOURCE_COLUMNS),
        F.col("damage").alias(CORRUPT),
    )


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_versions(accepted_lines(classify(rows_as_landed(spark, sf_dir))))


def _with_malformed(frame: DataFrame) -> DataFrame:
    return frame.withColumn("malformed", F.col(CORRUPT).isNotNull())


def _with_provenance(frame: DataFrame) -> DataFrame:
    """The damaged line itself, and whether the row names a file of the snapshot."""
    named = F.col(SOURCE_FILE).endswith(".csv.gz") & F.contains(SOURCE_FILE, F.lit("batch_date="))
    return frame.withColumns(
        {"damaged_line": F.col(CORRUPT), "from_a_file": F.coalesce(named, F.lit(False))}
    )


def _quarantine(frame: DataFrame) -> DataFrame:
    reasons = F.array_join("validation_errors", ",")
    return plain(_with_malformed(frame).withColumn("reasons", reasons)).drop("validation_errors")


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_with_provenance(_with_malformed(read_snapshot(spark, landed(spark, sf_dir).raw))))


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejects_by_reason(rejected_rows(classify(rows_as_landed(spark, sf_dir))))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(rejected_rows(classify(rows_as_landed(spark, sf_dir)))).select(
        *SOURCE_COLUMNS, "malformed", "_record_hash", "reasons"
    )


def record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(rows_as_landed(spark, sf_dir)).select(
        "order_id", "line_id", "_record_hash", ACCEPTED
    )


def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published run splits its input into three disjoint outputs."""
    place = published(spark, sf_dir)
    outputs = {
        "rejected": read_quarantine(spark, place.root, RUN_ID),
        "current": read_order_lines(spark, place.root, RUN_ID),
        "superseded": read_superseded(spark, place.root, RUN_ID),
    }
    marked = [frame.select(F.lit(name).alias("outcome")) for name, frame in outputs.items()]
    whole = marked[0].unionByName(marked[1]).unionByName(marked[2])
    return whole.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))


def exhaustive_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a run's three outputs together, as a multiset, against those of its raw files.

    Both are read once, to a digest of each file; those of all files add up to the whole one.
    """
    place = published(spark, sf_dir)
    key = ["_record_hash", SOURCE_FILE]
    given = classify(read_snapshot(spark, place.raw)).select(*key)
    outputs = [read(spark, place.root, RUN_ID).select(*key) for read in (read_quarantine, read_order_lines, read_superseded)]
    together = outputs[0].unionByName(outputs[1]).unionByName(outputs[2])
    names = ("row_count", "first_sum", "second_sum")
    raw_of, files_of = (
        frame.groupBy(SOURCE_FILE).agg(*digest_columns()).select(SOURCE_FILE, F.struct(*names).alias(side))
        for side, frame in (("raw", given), ("output", together))
    )

    def whole(side: str) -> Column:
        return F.struct(*(F.coalesce(F.sum(f"{side}.{name}"), F.lit(0)).cast("decimal(38,0)") for name in names))

    apart = ~F.col("raw.row_count").eqNullSafe(F.col("output.row_count"))
    return raw_of.join(files_of, SOURCE_FILE, "full").agg(
        F.coalesce(F.sum("output.row_count"), F.lit(0)).alias("row_count"),
        (whole("raw") == whole("output")).alias("same_rows"),
        F.count_if(apart).alias("files_apart"),
    )


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(current_lines(_ranked(spark, sf_dir)))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(latest_lines(accepted_lines(classify(rows_as_landed(spark, sf_dir)))))


def _staged_lines(spark: SparkSession, sf_dir: str, scratch: str) -> tuple[DataFrame, int]:
    """Accepted lines written once and read back, and their number."""
    accepted = with_hash_bytes(accepted_lines(classify(rows_as_landed(spark, sf_dir))))
    with roomy_joins(spark, sf_dir):
        accepted.write.parquet(f"{scratch}/accepted", compression="zstd")
    lines = spark.read.schema(accepted.schema).parquet(f"{scratch}/accepted")
    return lines, lines.count()


def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ranks are needed here, so keys with very many versions are looked for first."""
    scratch = shared_folder(spark, sf_dir, "superseded_lines")
    lines, rows = _staged_lines(spark, sf_dir, scratch)
    return plain(with_hash_text(superseded_lines(rank_at_scale(lines, rows, scratch))))


def crowded_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks with the category as key; most categories are too large for one task."""
    scratch = shared_folder(spark, sf_dir, "crowded_versions")
    lines, rows = _staged_lines(spark, sf_dir, scratch)
    crowd = max(1, rows // 16)
    with settings(spark, {"spark.sql.parquet.compression.codec": "zstd"}):
        ranked = rank_at_scale(lines, rows, scratch, crowd, keys=("category",))
    return plain(with_hash_text(ranked))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(daily_sales(current_lines(_ranked(spark, sf_dir))))


def snapshot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the landed snapshot under a new run and return the metrics of that run."""
    place, run_id = landed(spark, sf_dir), "metrics-run"
    root = shared_folder(spark, sf_dir, "snapshot_metrics")
    metrics = publish_snapshot(spark, place.raw, root, run_id, BATCH_DATE, MOST_REJECTED)
    row = tuple(metrics.as_dict()[name] for name in RUN_METRICS.fieldNames())
    return spark.createDataFrame([row], RUN_METRICS).drop("run_id")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(published_runs(spark, published(spark, sf_dir).root))


def _published(read: Callable[[SparkSession, str, str], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(read(spark, published(spark, sf_dir).root, RUN_ID).drop("run_id"))

    return query


def published_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantine = read_quarantine(spark, published(spark, sf_dir).root, RUN_ID)
    return _quarantine(_with_provenance(quarantine)).select(
        *SOURCE_COLUMNS, "malformed", "_record_hash", "reasons", "damaged_line", "from_a_file"
    )


def manifest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = published(spark, sf_dir)
    entries = read_manifest(spark, place.root, RUN_ID)
    return plain(read_listed_daily_sales(spark, place.root, RUN_ID, entries))


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a run's manifest: its order, its files, and the rows that it lists."""
    place = published(spark, sf_dir)
    entries = read_manifest(spark, place.root, RUN_ID)  # refuses lengths that have changed
    layout = RunLayout(place.root, RUN_ID)
    there = data_files(spark, layout.daily_sales).withColumnRenamed("path", "url")
    missing = there.join(entries, "url", "left_anti").agg((F.count(F.lit(1)) == 0).alias("none"))
    # parts follow one another by name, lines by their place in a part
    named = spark.read.schema(MANIFEST).json(layout.load_manifest).select("url", F.col("_metadata.file_name").alias("part"))
    parts = named.withColumn("at", F.monotonically_increasing_id()).groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("at", "url"))).alias("lines"), F.min("url").alias("least"), F.max("url").alias("most")
    )
    own = F.transform("lines", lambda line: line["url"])
    before = F.lag("most").over(Window.orderBy("part"))
    apart = F.coalesce(before < F.col("least"), F.lit(True))
    ordered = parts.select(((F.array_sort(F.array_distinct(own)) == own) & apart).alias("ok")).agg(F.every("ok").alias("all"))
    held = read_listed_daily_sales(spark, place.root, RUN_ID, entries).agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(28,2)").alias("net_revenue"),
    )
    listed = entries.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    return held.select(
        F.coalesce(ordered.scalar(), F.lit(True)).alias("sorted_and_unique"),
        (missing.scalar() & (listed.scalar() == F.col("gold_rows"))).alias("lists_all_files"),
        "gold_rows",
        "net_revenue",
    )


LIMITS_TRIED = [step / 20 for step in range(21)]


def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which reject limits the rows of each category would pass."""
    judged = classify(rows_as_landed(spark, sf_dir))
    ranked = rank_versions(accepted_lines(judged))
    category = F.coalesce("category", F.lit(""))
    rejected = rejected_rows(judged).select(category.alias("category"), F.lit(1).alias("r"))
    counts = (
        ranked.select(category.alias("category"), F.lit(0).alias("r"), (F.col(RANK) == 1).alias("c"))
        .unionByName(rejected.withColumn("c", F.lit(False)))
        .groupBy("category")
        .agg(F.count(F.lit(1)), F.count_if(F.col("r") == 1), F.count_if(F.col("c")))
    )
    rows = []
    for name, given, turned_away, kept in counts.collect():  # one row for each category
        gate = RowCounts(given, turned_away, kept, given - turned_away - kept)
        gate.reconcile()
        for most in LIMITS_TRIED:
            try:
                rows.append((name, most, True, gate.reject_ratio(most)))
            except QualityError:
                rows.append((name, most, False, None))
    return spark.createDataFrame(rows, "category string, most double, passes boolean, ratio double")


def overflow_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily groups whose totals no longer fit when every line is worth nine thousand billions."""
    worth = F.lit(9_000_000_000_000_000).cast("decimal(18,2)")
    lines = current_lines(_ranked(spark, sf_dir)).withColumns(
        {"gross_amount": worth, "net_amount": worth}
    )
    daily_rows = daily_sales(lines)
    return plain(
        daily_rows.select("order_date", "country", "category", "line_count", overflowed().alias("overflows"))
    )


def overflow_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate on totals says of daily sales in which every line is worth nine thousand billions."""
    worth = F.lit(9_000_000_000_000_000).cast("decimal(18,2)")
    lines = current_lines(_ranked(spark, sf_dir)).withColumns({"gross_amount": worth, "net_amount": worth})
    place = f"{shared_folder(spark, sf_dir, 'overflow_refusal')}/daily"
    daily_sales(lines).write.parquet(place)  # as a run stages them
    rows, refusal = spark.read.schema(DAILY_SALES).parquet(place), None
    try:
        daily_totals(rows).check()
    except QualityError as error:
        refusal = str(error)
    return rows.agg(F.count(F.lit(1)).alias("gold_rows")).withColumn("refusal", F.lit(refusal))


def broken_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales broken on purpose, each group in a way that its counts choose, and counted."""
    place = published(spark, sf_dir)
    rows = read_daily_sales(spark, place.root, RUN_ID).drop("run_id")
    kind = F.pmod(F.col("line_count") * 5 + F.col("units"), F.lit(11))
    cent = F.lit("0.01").cast("decimal(18,2)")
    broken = rows.withColumns(
        {
            "net_amount": F.when(kind == 0, F.col("net_amount") + cent).otherwise(F.col("net_amount")),
            "order_count": F.when(kind == 1, F.col("line_count") + 1).otherwise(F.col("order_count")),
            "units": F.when(kind == 2, F.col("line_count") - 1).otherwise(F.col("units")),
            "gross_amount": F.when(kind == 3, -F.col("gross_amount")).otherwise(F.col("gross_amount")),
            "country": F.when(kind != 4, F.col("country")),
        }
    ).withColumn("net_amount", F.col("net_amount").cast("decimal(18,2)"))
    found = broken.withColumn("source_run_id", F.lit(RUN_ID))
    checks = summary(found).select("gold_rows", "invalid_rows")
    marts = reports.mart_integrity(found).select("inconsistent_rows")
    unfit = misfits(found).agg(F.count(F.lit(1)).alias("misfits"))
    return checks.select(
        "*", marts.scalar().alias("inconsistent_rows"), unfit.scalar().alias("misfits")
    )


def _positions(report: DataFrame, path: str) -> DataFrame:
    """A sorted report's rows with their places in its order: places within the files that it is
    written to, behind the rows of the files before."""
    report.write.parquet(path)
    at = F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("id")
    rows = report.sparkSession.read.schema(report.schema).parquet(path).select("*", *at)
    # one row for each file of the report
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("file", "first", before.alias("before"))
    return rows.join(offsets, "file").withColumn("position", F.col("before") + F.col("id") - F.col("first") + 1)


def ordered_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of an ascending, a mixed and a descending report, with the places that their own order
    gives them."""
    place, folder = promoted(spark, sf_dir), shared_folder(spark, sf_dir, "ordered_reports")
    daily_rows = read_daily_sales(spark, place.root, RUN_ID)
    made = {
        "ascending": (reports.sales_by_day_country(daily_rows), ("order_date", "country")),
        "mixed": (reports.category_performance(daily_rows), ("country", "category")),
        "descending": (reports.category_revenue_share(current_mart(spark, place.mart)), ("category", None)),
    }
    shown = []
    for name, (report, keys) in made.items():
        first, second = (F.lit("") if key is None else F.col(key).cast("string") for key in keys)
        placed = _positions(report, f"{folder}/{name}")
        shown.append(placed.select(F.lit(name).alias("report"), first.alias("first"), second.alias("second"), "position"))
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


def guarded_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guards that no other query shows, over the bridged snapshot and its published run."""
    place, root = promoted(spark, sf_dir), shared_folder(spark, sf_dir, "guarded_inputs")
    rows = rows_as_landed(spark, sf_dir)

    def refused(attempt: Callable[[], object], kind: type[Exception], words: str) -> bool:
        try:
            attempt()
        except kind as refusal:
            return words in str(refusal)
        return False

    def publish(**change: object) -> Callable[[], object]:
        given = {"run_id": "guarded", "batch_date": BATCH_DATE, "max_reject_ratio": MOST_REJECTED, **change}
        return lambda: publish_snapshot(spark, place.raw, root, **given)

    lines = RunLayout(place.root, RUN_ID).superseded
    with settings(spark, {"spark.sql.parquet.int96AsTimestamp": "false"}):
        stored = dict(spark.read.parquet(lines).dtypes)  # the older form reads as binary so
    zone = "spark.sql.session.timeZone"
    with settings(spark, {zone: "Asia/Tokyo"}):
        use_contract_time(spark)
        in_utc = spark.conf.get(zone) == "UTC"
    mart, folder = f"{root}/mart", shared_folder(spark, sf_dir, "guarded_inputs_mart")
    began = datetime.now(UTC)
    load = promote_run(spark, place.root, folder, RUN_ID)
    times = current_mart(spark, folder).agg(F.min("loaded_at"), F.max("loaded_at")).first()
    audited = load_audit(spark, folder).first().loaded_at
    held = {
        "missing columns are named in order": refused(
            lambda: classify(rows.drop("status", "country")), ValueError, "columns: country, status"
        ),
        "run ids have one form": refused(publish(run_id="a/b"), ValueError, "run_id"),
        "batch dates are real dates": refused(publish(batch_date="2026-02-30"), ValueError, ""),
        "ratios are numbers up to one": all(
            refused(publish(max_reject_ratio=r), ValueError, "max_reject_ratio") for r in (True, float("nan"), 1.01)
        ),
        "nothing is left of refused runs": not files.exists(spark, root) and not files.exists(spark, mart),
        "times are stored as micros": stored["updated_at"] == "timestamp",
        "sessions read times in utc": in_utc,
        "rows carry the time of their load": times[0] == times[1] == audited
        and began <= audited.astimezone(UTC) <= datetime.now(UTC)
        and load["loaded_at"] == audited.astimezone(UTC),
    }
    shown = F.explode(F.create_map(*[F.lit(x) for item in held.items() for x in item])).alias("guard", "held")
    counted = rows.agg(F.count(F.lit(1)).alias("snapshot_rows"))
    return counted.select(shown, "snapshot_rows")


def refused_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a published run refuses: its own id again, another batch, and too many rejects."""
    place, root = published(spark, sf_dir), shared_folder(spark, sf_dir, "refused_runs")
    tries = {
        "taken id": lambda: publish_snapshot(spark, place.raw, place.root, RUN_ID, BATCH_DATE),
        "other batch": lambda: publish_snapshot(spark, place.raw, root, "other", "2026-01-16"),
        "too many rejects": lambda: publish_snapshot(spark, place.raw, root, "strict", BATCH_DATE, 0.0),
        "not published": lambda: read_daily_sales(spark, root, "strict"),
        "other marker": lambda: success_marker(spark, place.root, RUN_ID, "2026-01-16"),
    }
    rows = []
    for name, attempt in tries.items():
        try:
            attempt()
            rows.append((name, None))
        except Exception as refusal:  # noqa: BLE001 - its kind is the result
            rows.append((name, type(refusal).__name__))
    kept = read_quarantine(spark, root, "strict").agg(F.count(F.lit(1)).alias("evidence_rows"))
    refused = spark.createDataFrame(rows, "attempt string, refusal string")
    return refused.withColumn("evidence_rows", kept.scalar())


def recovered_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt that a gate turns down keeps its staged lines for a second one; a third dies. What
    staged data stands after each step, and the second one's metrics."""
    place, root = landed(spark, sf_dir), shared_folder(spark, sf_dir, "recovered_attempts")
    standing = []

    def note(step: str) -> None:
        standing.append((step, live_staging(spark, root).count()))

    try:
        publish_snapshot(spark, place.raw, root, "strict", BATCH_DATE, 0.0, keep_staging=True)
    except QualityError:
        note("turned down")
    kept = live_staging(spark, root).first().attempt
    metrics = publish_snapshot(spark, place.raw, root, "loose", BATCH_DATE, MOST_REJECTED, reuse=kept)
    note("used again")
    begin_attempt(spark, RunLayout(root, "dead"), "", "")
    note("died")
    recover_attempts(spark, root, older_than=0)
    note("recovered")
    row = tuple(metrics.as_dict()[name] for name in RUN_METRICS.fieldNames())
    found = spark.createDataFrame([row], RUN_METRICS).drop("run_id")
    steps = F.explode(F.create_map(*[F.lit(x) for item in standing for x in item]))
    return found.select(steps.alias("step", "standing"), "*").withColumn("standing", F.col("standing").cast("long"))


def header_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files break the header contract, and the rows of those that keep it."""
    root = shared_folder(spark, sf_dir, "header_contract")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the footers
    shares = math.ceil(max(1, items) / LINES_A_SHARE)
    with roomy_joins(spark, sf_dir):
        raw = write_headed_files(order_line_versions(spark, sf_dir), f"{root}/raw", shares)
    number = F.regexp_extract(SOURCE_FILE, "file=([0-9]+)", 1).cast("int").alias("file")
    lines, refused = snapshot_lines(spark, raw), None
    try:
        check_headers(lines, SnapshotFiles(spark, raw), f"{root}/bad")
    except HeaderError as error:
        refused = error.unsound.select(number, F.lit(None).cast("long").alias("data_rows")).distinct()
    kept = lines.join(sound_files(lines), SOURCE_FILE, "left_semi")
    sound = parse_lines(kept.filter(is_data())).groupBy(number).agg(F.count(F.lit(1)).alias("data_rows"))
    every = sound if refused is None else sound.unionByName(refused)
    return every.withColumn("sound", F.col("data_rows").isNotNull())


def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run checked again and promoted by resuming it, twice."""
    place, mart = published(spark, sf_dir), shared_folder(spark, sf_dir, "resumed_run")
    outcomes = [resume_run(spark, place.root, RUN_ID, BATCH_DATE, mart) for _ in range(2)]
    rows = [
        (n, o["reconciled"]["gold_rows"], o["reconciled"]["net_revenue"], o["load"]["loaded"], o["load"]["row_count"])
        for n, o in enumerate(outcomes)
    ]
    kinds = "attempt int, gold_rows long, net_revenue decimal(28,2), loaded boolean, row_count long"
    return spark.createDataFrame(rows, kinds)


def catalog_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that is shown in the catalog before its first load, and follows two loads by itself."""
    place, mart = promoted(spark, sf_dir), shared_folder(spark, sf_dir, "catalog_mart")
    database = f"mart_{uuid.uuid5(uuid.NAMESPACE_URL, mart).hex}"
    show_mart(spark, database, mart)
    view = f"{database}.daily_sales"
    before = spark.table(view).count()
    promote_run(spark, place.root, mart, RUN_ID)
    promote_run(spark, place.root, mart, RUN_ID)
    shown = spark.table(f"{database}.pipeline_runs").agg(F.max("row_count").alias("loaded_rows"))
    checks = spark.table(f"{database}.daily_sales_checks")
    refused = checks.select((F.col("null_rows") + F.col("long_texts") + F.col("bad_counts") + F.col("unbalanced")).alias("refused"))
    return spark.table(view).agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(28,2)").alias("net_revenue"),
    ).select(
        "*", shown.scalar().alias("loaded_rows"), F.lit(before).cast("long").alias("rows_before"),
        refused.scalar().alias("refused_rows"),
    )


def raced_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two interleaved loads: the first loses its lease to the second, tries to commit, and then commits
    without looking, as a writer that was held up would; readers don't follow it."""
    place, mart = published(spark, sf_dir), shared_folder(spark, sf_dir, "raced_loads")
    first = begin_load(spark, place.root, mart, RUN_ID, seconds=0)
    second = begin_load(spark, place.root, mart, RUN_ID)
    steps = [("second", second.commit()["loaded"])]
    try:
        first.commit()
        steps.append(("first", True))
    except LeaseLostError:
        steps.append(("first", False))
    files.write_once(spark, first.path, {**first.record(0), "row_count": -1})
    steps.append(("replay", promote_run(spark, place.root, mart, RUN_ID)["loaded"]))
    loads = load_audit(spark, mart).agg(F.count(F.lit(1)).alias("loads"))
    audited = load_audit(spark, mart).agg(F.sum("row_count").alias("audited_rows"))
    held = current_mart(spark, mart).agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast("decimal(28,2)").alias("net_revenue"),
    )
    committed = F.explode(F.create_map(*[F.lit(x) for step in steps for x in step])).alias("attempt", "committed")
    return held.select(
        committed, "mart_rows", "net_revenue", loads.scalar().alias("loads"), audited.scalar().alias("audited_rows")
    )


def _report(report: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        place = published(spark, sf_dir)
        return plain(report(read_daily_sales(spark, place.root, RUN_ID)))

    return query


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = published(spark, sf_dir)
    return plain(reports.orders_by_day(read_order_lines(spark, place.root, RUN_ID)))


def _mart_report(report: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(report(current_mart(spark, promoted(spark, sf_dir).mart)))

    return query


def promote_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after a first load and a replay of it into a new mart."""
    place, mart = published(spark, sf_dir), shared_folder(spark, sf_dir, "promote_snapshot")
    for _ in range(2):
        promote_run(spark, place.root, mart, RUN_ID)
    return plain(current_mart(spark, mart))


def replayed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a query: what a replay of a load leaves, from mart, stage and audit."""
    place = promoted(spark, sf_dir)
    mart, audit = current_mart(spark, place.mart), load_audit(spark, place.mart)
    stage = read_daily_sales(spark, place.root, RUN_ID)
    moment = audit.first().loaded_at
    return plain(mart_after_load(mart, stage, audit, RUN_ID, moment))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(load_audit(spark, promoted(spark, sf_dir).mart))


def cancelled_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot whose completed lines are all cancelled: it empties the mart it replaces."""
    place, root = promoted(spark, sf_dir), shared_folder(spark, sf_dir, "cancelled_snapshot")
    mart = f"{root}/mart"
    # The landed lines again, so that the tables are joined once and not twice.
    raw = write_csv_lines(landed_lines(spark, place.raw).select(cancelled_line()), f"{root}/raw")
    metrics = publish_snapshot(spark, raw, root, "cancelled-1", BATCH_DATE, MOST_REJECTED)
    promote_run(spark, place.root, mart, RUN_ID)
    promote_run(spark, root, mart, "cancelled-1")
    newest = load_audit(spark, mart).limit(1).select(F.col("row_count").alias("audit_row_count"))
    return (
        current_mart(spark, mart)
        .agg(F.count(F.lit(1)).alias("mart_rows"))
        .select(
            F.lit(metrics.valid_rows).cast("long").alias("valid_rows"),
            F.lit(metrics.gold_rows).cast("long").alias("gold_rows"),
            "mart_rows",
            newest.scalar().alias("audit_row_count"),
        )
    )


def lake_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
      SELECT CAST(order_date AS STRING) AS order_date, count(*) AS order_lines,
        sum(net_amount) AS net_revenue
      FROM IDENTIFIER(:lines)
      WHERE run_id = :run_id AND order_date BETWEEN DATE '2020-01-01' AND DATE '2035-12-31'
      GROUP BY order_date
    """
    table = f"{in_lake(spark, sf_dir)}.order_lines"
    return run_sql(spark, text, {"lines": table}, run_id=RUN_ID)


def lake_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
      SELECT country, count(*) AS gold_rows, sum(units) AS units
      FROM IDENTIFIER(:daily) WHERE run_id = :run_id GROUP BY country
    """
    table = f"{in_lake(spark, sf_dir)}.daily_sales"
    return run_sql(spark, text, {"daily": table}, run_id=RUN_ID)


QUERIES: dict[str, Query] = {
    "daily_sales": daily,
    "csv_ingest": csv_ingest,
    "record_hash": record_hash,
    "rejects_by_reason": rejects_by_reason,
    "quarantine_rows": quarantine_rows,
    "current_lines": current,
    "latest_lines": latest,
    "superseded_lines": superseded,
    "crowded_versions": crowded_versions,
    "snapshot_metrics": snapshot_metrics,
    "published_runs": runs,
    "published_order_lines": _published(read_order_lines),
    "published_superseded": _published(read_superseded),
    "published_quarantine": published_quarantine,
    "published_daily_sales": _published(read_daily_sales),
    "row_outcomes": row_outcomes,
    "exhaustive_outcomes": exhaustive_outcomes,
    "file_manifest": file_manifest,
    "gate_outcomes": gate_outcomes,
    "overflow_gate": overflow_gate,
    "overflow_refusal": overflow_refusal,
    "broken_gold": broken_gold,
    "ordered_reports": ordered_reports,
    "guarded_inputs": guarded_inputs,
    "refused_runs": refused_runs,
    "recovered_attempts": recovered_attempts,
    "header_contract": header_contract,
    "resumed_run": resumed_run,
    "catalog_mart": catalog_mart,
    "raced_loads": raced_loads,
    "manifest_load": manifest_load,
    "lake_order_lines": lake_order_lines,
    "lake_daily_sales": lake_daily_sales,
    "reconciliation": _report(summary),
    "sales_by_day_country": _report(reports.sales_by_day_country),
    "orders_by_day": orders_by_day,
    "category_performance": _report(reports.category_performance),
    "mart_sales_by_day": _mart_report(reports.sales_by_day),
    "category_revenue_share": _mart_report(reports.category_revenue_share),
    "mart_integrity": _mart_report(reports.mart_integrity),
    "promote_snapshot": promote_snapshot,
    "replayed_load": replayed_load,
    "load_audit": audit,
    "cancelled_snapshot": cancelled_snapshot,
}
