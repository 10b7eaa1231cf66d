"""The same results in plain SQL, from the supplied tables, for a second engine.

The text states the contract once more and on its own: nothing here is generated from the
engine's rules.
"""

from __future__ import annotations

from harness.bridge import TABLES, versions_sql

_CONTRACT = """
WITH versions AS ({versions}),
landed AS (
  SELECT * EXCLUDE (damage),
    CASE WHEN damage IS NOT NULL THEN TRUE ELSE FALSE END AS corrupt,
    CASE WHEN damage = 'extra' THEN {line} || ',surplus' END AS damaged_line
  FROM versions WHERE damage IS NULL OR damage <> 'quote'
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE, '"' || {line}
  FROM versions WHERE damage = 'quote'
),
tidy AS (
  SELECT corrupt, damaged_line, trim(order_id) AS order_id, trim(line_id) AS line_id,
    trim(customer_id) AS customer_id, trim(product_id) AS product_id,
    trim(category) AS category, upper(trim(country)) AS country, trim(quantity) AS quantity,
    trim(unit_price) AS unit_price, trim(discount_amount) AS discount_amount,
    trim(order_timestamp) AS order_timestamp, trim(updated_at) AS updated_at,
    upper(trim({status})) AS status
  FROM landed
),
parsed AS (
  SELECT *,
    sha256(CAST(json_object('order_id', order_id, 'line_id', line_id,
      'customer_id', customer_id, 'product_id', product_id, 'category', category,
      'country', country, 'quantity', quantity, 'unit_price', unit_price,
      'discount_amount', discount_amount, 'order_timestamp', order_timestamp,
      'updated_at', updated_at, 'status', status) AS VARCHAR)) AS record_hash,
    CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN TRY_CAST(quantity AS INTEGER)
      END AS q,
    TRY_CAST(unit_price AS DECIMAL(18, 2)) AS p,
    TRY_CAST(discount_amount AS DECIMAL(18, 2)) AS d,
    try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%S') AS ot,
    try_strptime(updated_at, '%Y-%m-%dT%H:%M:%S') AS ut
  FROM tidy
),
priced AS (
  SELECT *, TRY_CAST(CAST(q AS DECIMAL(20, 0)) * p AS DECIMAL(18, 2)) AS g FROM parsed
),
netted AS (
  SELECT *, TRY_CAST(CAST(g AS DECIMAL(20, 2)) - d AS DECIMAL(18, 2)) AS n FROM priced
),
judged AS (
  SELECT *, [reason FOR reason IN [
    CASE WHEN corrupt THEN 'malformed_csv' END,
    CASE WHEN coalesce(order_id, '') = '' THEN 'missing_order_id' END,
    CASE WHEN coalesce(line_id, '') = '' THEN 'missing_line_id' END,
    CASE WHEN coalesce(customer_id, '') = '' THEN 'missing_customer_id' END,
    CASE WHEN coalesce(product_id, '') = '' THEN 'missing_product_id' END,
    CASE WHEN coalesce(category, '') = '' THEN 'missing_category' END,
    CASE WHEN category IS NULL OR strlen(category) > 100 THEN 'category_too_long' END,
    CASE WHEN NOT coalesce(regexp_full_match(country, '[A-Z][A-Z]'), FALSE)
      THEN 'invalid_country' END,
    CASE WHEN NOT coalesce(regexp_full_match(quantity, '[0-9]+') AND q > 0, FALSE)
      THEN 'invalid_quantity' END,
    CASE WHEN NOT coalesce(regexp_full_match(unit_price, '[0-9]+([.][0-9][0-9]?)?')
      AND p IS NOT NULL, FALSE) THEN 'invalid_unit_price' END,
    CASE WHEN NOT coalesce(regexp_full_match(discount_amount, '[0-9]+([.][0-9][0-9]?)?')
      AND d IS NOT NULL, FALSE) THEN 'invalid_discount_amount' END,
    CASE WHEN ot IS NULL THEN 'invalid_order_timestamp' END,
    CASE WHEN ut IS NULL THEN 'invalid_updated_at' END,
    CASE WHEN status IS NULL OR status NOT IN ('COMPLETED', 'CANCELLED')
      THEN 'invalid_status' END,
    CASE WHEN CAST(ot AS DATE) NOT BETWEEN DATE '2020-01-01' AND DATE '2035-12-31'
      THEN 'order_date_out_of_range' END,
    CASE WHEN ut < ot THEN 'updated_before_order' END,
    CASE WHEN d > g THEN 'discount_exceeds_gross' END,
    CASE WHEN q IS NOT NULL AND p IS NOT NULL AND (g IS NULL OR n IS NULL)
      THEN 'amount_overflow' END
  ] IF reason IS NOT NULL] AS reasons
  FROM netted
),
ranked AS (
  SELECT order_id, line_id, customer_id, product_id, category, country, q AS quantity,
    p AS unit_price, d AS discount_amount,
    strftime(ot, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
    strftime(ut, '%Y-%m-%d %H:%M:%S') AS updated_at, status,
    CASE WHEN status = 'COMPLETED' THEN g ELSE CAST(0 AS DECIMAL(18, 2)) END AS gross_amount,
    CASE WHEN status = 'COMPLETED' THEN n ELSE CAST(0 AS DECIMAL(18, 2)) END AS net_amount,
    CAST(CAST(ot AS DATE) AS VARCHAR) AS order_date, record_hash AS _record_hash,
    CAST(row_number() OVER (PARTITION BY {keys} ORDER BY ut DESC, record_hash DESC)
      AS INTEGER) AS dedup_rank
  FROM judged WHERE len(reasons) = 0
),
daily AS (
  SELECT order_date, country, category, count(DISTINCT order_id) AS order_count,
    count(*) AS line_count, CAST(sum(quantity) AS BIGINT) AS units,
    CAST(sum(gross_amount) AS DECIMAL(18, 2)) AS gross_amount,
    CAST(sum(discount_amount) AS DECIMAL(18, 2)) AS discount_amount,
    CAST(sum(net_amount) AS DECIMAL(18, 2)) AS net_amount
  FROM ranked WHERE dedup_rank = 1 AND status = 'COMPLETED'
  GROUP BY order_date, country, category
)
"""

SOURCE = (
    "order_id, line_id, customer_id, product_id, category, country, quantity, unit_price, "
    "discount_amount, order_timestamp, updated_at, status"
)
LINE = f"{SOURCE}, gross_amount, net_amount, order_date, _record_hash"
DAILY = (
    "order_date, country, category, order_count, line_count, units, gross_amount, "
    "discount_amount, net_amount"
)


# A value with a comma stands in quotes in its line; no other character of the snapshot needs them.
_FIELDS = [f"CASE WHEN contains({c}, ',') THEN '\"' || {c} || '\"' ELSE {c} END" for c in SOURCE.split(", ")]
_CSV_LINE = "concat_ws(',', " + ", ".join(_FIELDS) + ")"


def over_snapshot(select: str, keys: str = "order_id, line_id", status: str = "status") -> str:
    """A query over the tables of the snapshot named in the text above."""
    versions = versions_sql("duckdb", {name: name for name in TABLES})
    return _CONTRACT.format(versions=versions, keys=keys, status=status, line=_CSV_LINE) + select


# A published row that breaks an invariant, stated once more in full.
INVALID = " OR ".join(
    [f"{c} IS NULL" for c in DAILY.split(", ")]
    + ["order_count <= 0", "order_count > line_count", "line_count > units"]
    + [f"{c} < 0" for c in ("gross_amount", "discount_amount", "net_amount")]
    + ["net_amount <> gross_amount - discount_amount"]
)

_BROKEN = """
, broken AS (
  SELECT order_date, category, line_count, discount_amount,
    CASE WHEN kind <> 4 THEN country END AS country,
    CASE WHEN kind = 1 THEN line_count + 1 ELSE order_count END AS order_count,
    CASE WHEN kind = 2 THEN line_count - 1 ELSE units END AS units,
    CASE WHEN kind = 3 THEN -gross_amount ELSE gross_amount END AS gross_amount,
    CASE WHEN kind = 0 THEN CAST(net_amount + 0.01 AS DECIMAL(18, 2)) ELSE net_amount END
      AS net_amount
  FROM (SELECT *, (line_count * 5 + units) % 11 AS kind FROM daily)
)
"""

_GATES = """
, category_counts AS (
  SELECT coalesce(category, '') AS category, count(*) AS given,
    count_if(len(reasons) > 0) AS rejected
  FROM judged GROUP BY 1
),
category_current AS (
  SELECT category, count(*) AS kept FROM ranked WHERE dedup_rank = 1 GROUP BY 1
),
tried AS (
  SELECT c.category, CAST(step / 20.0 AS DOUBLE) AS most,
    CAST(c.rejected AS DOUBLE) / c.given AS share, coalesce(k.kept, 0) AS kept
  FROM category_counts c LEFT JOIN category_current k USING (category), range(21) AS t(step)
)
"""


def sql() -> dict[str, str]:
    counts = (
        "SELECT count(*) AS input_rows, "
        "CAST(count_if(len(reasons) > 0) AS BIGINT) AS rejected_rows, "
        "(SELECT count(*) FROM ranked WHERE dedup_rank > 1) AS duplicate_rows, "
        "(SELECT count(*) FROM ranked WHERE dedup_rank = 1) AS valid_rows, "
        "(SELECT count(*) FROM daily) AS gold_rows, "
        "CAST(count_if(len(reasons) > 0) AS DOUBLE) / count(*) AS reject_ratio, "
        "(SELECT CAST(CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) AS VARCHAR) "
        "FROM daily) AS net_amount FROM judged"
    )
    texts = {
        "csv_ingest": (
            f"SELECT {SOURCE}, corrupt AS malformed, damaged_line, TRUE AS from_a_file FROM landed"
        ),
        "rejects_by_reason": (
            "SELECT reason, count(*) AS rejected_rows "
            "FROM (SELECT unnest(reasons) AS reason FROM judged) GROUP BY reason"
        ),
        "quarantine_rows": (
            f"SELECT {SOURCE}, corrupt AS malformed, record_hash AS _record_hash, "
            "array_to_string(reasons, ',') AS reasons FROM judged WHERE len(reasons) > 0"
        ),
        "record_hash": (
            "SELECT order_id, line_id, record_hash AS _record_hash, len(reasons) = 0 AS accepted "
            "FROM judged"
        ),
        "row_outcomes": (
            "SELECT outcome, count(*) AS row_count FROM ("
            "SELECT 'rejected' AS outcome FROM judged WHERE len(reasons) > 0 UNION ALL "
            "SELECT CASE WHEN dedup_rank = 1 THEN 'current' ELSE 'superseded' END FROM ranked"
            ") GROUP BY outcome"
        ),
        "current_lines": f"SELECT {LINE} FROM ranked WHERE dedup_rank = 1",
        "latest_lines": f"SELECT {LINE} FROM ranked WHERE dedup_rank = 1",
        "superseded_lines": f"SELECT {LINE}, dedup_rank FROM ranked WHERE dedup_rank > 1",
        "daily_sales": f"SELECT {DAILY} FROM daily",
        "snapshot_metrics": counts,
        "recovered_attempts": (
            "SELECT step, CAST(standing AS BIGINT) AS standing, * EXCLUDE (step, standing) "
            f"FROM ({counts}), (VALUES ('turned down', 1), ('used again', 0), ('died', 1), "
            "('recovered', 0)) AS t(step, standing)"
        ),
        "published_runs": f"SELECT 'snapshot-1' AS run_id, '2026-01-15' AS batch_date, * "
        f"FROM ({counts})",
        "published_order_lines": f"SELECT {LINE} FROM ranked WHERE dedup_rank = 1",
        "published_superseded": f"SELECT {LINE}, dedup_rank FROM ranked WHERE dedup_rank > 1",
        "published_quarantine": (
            f"SELECT {SOURCE}, corrupt AS malformed, record_hash AS _record_hash, "
            "array_to_string(reasons, ',') AS reasons, damaged_line, TRUE AS from_a_file "
            "FROM judged WHERE len(reasons) > 0"
        ),
        "published_daily_sales": f"SELECT {DAILY} FROM daily",
        "manifest_load": f"SELECT {DAILY} FROM daily",
        "file_manifest": (
            "SELECT TRUE AS sorted_and_unique, TRUE AS lists_all_files, count(*) AS gold_rows, "
            "CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) AS net_revenue FROM daily"
        ),
        "gate_outcomes": (
            _GATES + "SELECT category, most, share <= most AND kept > 0 AS passes, "
            "CASE WHEN share <= most AND kept > 0 THEN share END AS ratio FROM tried"
        ),
        "overflow_gate": (
            "SELECT order_date, country, category, line_count, "
            "line_count * 9000000000000000 > 9999999999999999.99 AS overflows FROM daily"
        ),
        "broken_gold": (
            _BROKEN + "SELECT count(*) AS gold_rows, "
            f"CAST(count_if({INVALID}) AS BIGINT) AS invalid_rows, "
            "CAST(count_if(net_amount <> gross_amount - discount_amount) AS BIGINT) "
            "AS inconsistent_rows, CAST(count_if(country IS NULL) AS BIGINT) AS misfits FROM broken"
        ),
        "ordered_reports": (
            "SELECT 'ascending' AS report, order_date AS first, country AS second, "
            "row_number() OVER (ORDER BY order_date, country) AS position "
            "FROM (SELECT DISTINCT order_date, country FROM daily) UNION ALL "
            "SELECT 'mixed', country, category, row_number() OVER (ORDER BY country, sum(net_amount) DESC) "
            "FROM daily GROUP BY country, category UNION ALL "
            "SELECT 'descending', category, '', row_number() OVER (ORDER BY sum(net_amount) DESC) "
            "FROM daily GROUP BY category"
        ),
        "exhaustive_outcomes": (
            "SELECT count(*) AS row_count, TRUE AS same_rows, CAST(0 AS BIGINT) AS files_apart FROM judged"
        ),
        "overflow_refusal": (
            "SELECT count(*) AS gold_rows, 'Totals of ' || "
            "count_if(line_count * 9000000000000000 > 9999999999999999.99) || "
            "' daily groups are out of range' AS refusal FROM daily"
        ),
        "guarded_inputs": (
            "SELECT guard, TRUE AS held, (SELECT count(*) FROM landed) AS snapshot_rows FROM (VALUES "
            "('missing columns are named in order'), ('run ids have one form'), "
            "('batch dates are real dates'), ('ratios are numbers up to one'), "
            "('nothing is left of refused runs'), ('times are stored as micros'), "
            "('sessions read times in utc'), ('rows carry the time of their load')) AS t(guard)"
        ),
        "refused_runs": (
            "SELECT attempt, refusal, (SELECT count(*) FROM judged WHERE len(reasons) > 0) "
            "AS evidence_rows FROM (VALUES ('taken id', 'AlreadyExistsError'), "
            "('other batch', 'ValueError'), ('too many rejects', 'QualityError'), "
            "('not published', 'MarkerError'), ('other marker', 'MarkerError')) AS t(attempt, refusal)"
        ),
        "header_contract": (
            "SELECT file, file % 5 NOT IN (1, 3) AS sound, "
            "CASE WHEN file % 5 NOT IN (1, 3) THEN count(*) END AS data_rows "
            "FROM (SELECT coalesce(TRY_CAST(line_id AS INTEGER), 0) AS file FROM versions) GROUP BY file "
            "UNION ALL SELECT 1000, FALSE, NULL"
        ),
        "resumed_run": (
            "SELECT CAST(attempt AS INTEGER) AS attempt, gold_rows, net_revenue, attempt = 0 AS loaded, "
            "gold_rows AS row_count FROM (SELECT count(*) AS gold_rows, "
            "CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) AS net_revenue FROM daily), "
            "range(2) AS t(attempt)"
        ),
        "catalog_mart": (
            "SELECT count(*) AS gold_rows, CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) "
            "AS net_revenue, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS rows_before, "
            "CAST(0 AS BIGINT) AS refused_rows FROM daily"
        ),
        "raced_loads": (
            "SELECT attempt, attempt = 'second' AS committed, mart_rows, net_revenue, "
            "CAST(1 AS BIGINT) AS loads, mart_rows AS audited_rows FROM (SELECT count(*) AS mart_rows, "
            "CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) AS net_revenue FROM daily), "
            "(VALUES ('first'), ('second'), ('replay')) AS t(attempt)"
        ),
        "reconciliation": (
            "SELECT count(*) AS gold_rows, CAST(coalesce(sum(line_count), 0) AS BIGINT) "
            "AS line_count, CAST(coalesce(sum(units), 0) AS BIGINT) AS units, "
            "CAST(coalesce(sum(net_amount), 0) AS DECIMAL(28, 2)) AS net_revenue, "
            f"CAST(count_if({INVALID}) AS BIGINT) AS invalid_rows FROM daily"
        ),
        "sales_by_day_country": (
            "SELECT order_date, country, CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue, "
            "CAST(sum(units) AS BIGINT) AS units FROM daily GROUP BY order_date, country"
        ),
        "orders_by_day": (
            "SELECT order_date, count(DISTINCT order_id) AS orders, count(*) AS order_lines, "
            "CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue "
            "FROM ranked WHERE dedup_rank = 1 GROUP BY order_date"
        ),
        "category_performance": (
            "SELECT country, category, CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue, "
            "CAST(sum(discount_amount) AS DECIMAL(28, 2)) AS discounts, "
            "CAST(round(100.0 * sum(discount_amount) / nullif(sum(gross_amount), 0), 2) "
            "AS DECIMAL(18, 2)) AS discount_percent FROM daily GROUP BY country, category"
        ),
        "mart_sales_by_day": (
            "SELECT order_date, CAST(sum(line_count) AS BIGINT) AS line_count, "
            "CAST(sum(units) AS BIGINT) AS units, "
            "CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue FROM daily GROUP BY order_date"
        ),
        "category_revenue_share": (
            "SELECT category, CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue, "
            "CAST(round(100.0 * sum(net_amount) / nullif(sum(sum(net_amount)) OVER (), 0), 2) "
            "AS DECIMAL(18, 2)) AS revenue_share_percent FROM daily GROUP BY category"
        ),
        "mart_integrity": (
            "SELECT count(*) AS gold_rows, "
            "CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS BIGINT) AS snapshot_count, "
            "CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue, "
            "CAST(count_if(net_amount <> gross_amount - discount_amount) AS BIGINT) "
            "AS inconsistent_rows FROM daily"
        ),
        "promote_snapshot": f"SELECT {DAILY}, 'snapshot-1' AS source_run_id FROM daily",
        "replayed_load": f"SELECT {DAILY}, 'snapshot-1' AS source_run_id FROM daily",
        "load_audit": "SELECT 'snapshot-1' AS run_id, count(*) AS row_count FROM daily",
        "lake_order_lines": (
            "SELECT order_date, count(*) AS order_lines, "
            "CAST(sum(net_amount) AS DECIMAL(28, 2)) AS net_revenue FROM ranked "
            "WHERE dedup_rank = 1 GROUP BY order_date"
        ),
        "lake_daily_sales": (
            "SELECT country, count(*) AS gold_rows, CAST(sum(units) AS BIGINT) AS units "
            "FROM daily GROUP BY country"
        ),
    }
    oracle = {name: over_snapshot(text) for name, text in texts.items()}
    # One key for all lines of a category: some keys then hold very many versions.
    oracle["crowded_versions"] = over_snapshot(
        f"SELECT {LINE}, dedup_rank FROM ranked", keys="category"
    )
    oracle["cancelled_snapshot"] = over_snapshot(
        "SELECT (SELECT count(*) FROM ranked WHERE dedup_rank = 1) AS valid_rows, "
        "count(*) AS gold_rows, count(*) AS mart_rows, count(*) AS audit_row_count FROM daily",
        status="CASE WHEN upper(trim(status)) = 'COMPLETED' THEN 'cancelled' ELSE status END",
    )
    return oracle
