"""Small inputs shared by the tests."""

from __future__ import annotations

from decimal import Decimal

from tallygate.contract import SOURCE_COLUMNS

HEADER = ",".join(SOURCE_COLUMNS)

BOOK = {
    "order_id": "N1",
    "line_id": "1",
    "customer_id": "K1",
    "product_id": "A1",
    "category": "Lamps",
    "country": "PT",
    "quantity": "4",
    "unit_price": "7.35",
    "discount_amount": "2.40",
    "order_timestamp": "2023-05-17T18:04:09",
    "updated_at": "2023-05-17T18:04:09",
    "status": "COMPLETED",
}

_TEXTS = ", ".join(f"{name} string" for name in SOURCE_COLUMNS)


def frame(spark, *changes):
    """One row per set of changes to the sound base row."""
    rows = [tuple({**BOOK, **change}[name] for name in SOURCE_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, _TEXTS)


def csv_line(**change):
    return ",".join({**BOOK, **change}[name] for name in SOURCE_COLUMNS)


# A snapshot made by rule: 26 lines of 13 orders over three days, newer versions of every
# seventh line, and a row for each of a few defects. What a run makes of it is worked out in
# plain Python below.
def _line(n, **change):
    moment = f"2024-06-{3 + n % 3:02d}T{6 + n % 12:02d}:15:00"
    return {
        "order_id": f"S{n // 2}",
        "line_id": str(n % 2 + 1),
        "customer_id": f"C{n % 5}",
        "product_id": f"G{n}",
        "category": ("Garden", "Lamps", "Music")[n % 4 % 3],
        "country": ("NO", "PT", "JP")[n % 3],
        "quantity": str(1 + n * n % 6),
        "unit_price": f"{3 + n}.{(n * 17) % 100:02d}",
        "discount_amount": f"{n % 3}.{n % 10}5",
        "order_timestamp": moment,
        "updated_at": moment,
        "status": "CANCELLED" if n % 9 == 4 else "COMPLETED",
        **change,
    }


SOUND = [_line(n) for n in range(26)]
NEWER = [
    {**line, "quantity": str(int(line["quantity"]) + 5), "updated_at": "2024-06-09T01:02:03"}
    for line in SOUND[::7]
]
# (change, reasons)
REJECTED = [
    ({"category": ""}, ["missing_category"]),
    ({"country": "N0"}, ["invalid_country"]),
    ({"status": "LOST"}, ["invalid_status"]),
    ({"quantity": "six", "updated_at": "2024-06-01T00:00:00"}, ["invalid_quantity", "updated_before_order"]),
    ({"discount_amount": "9999.5"}, ["discount_exceeds_gross"]),
]
_BAD = [_line(100 + n, order_id=f"R{n}", **change) for n, (change, _) in enumerate(REJECTED)]

SAMPLE = [",".join(row[name] for name in SOURCE_COLUMNS) for row in [*SOUND, *_BAD, *NEWER]]
SAMPLE.append(SAMPLE[0].replace("S0,1", "R9,1") + ",more")
SAMPLE_REASONS = {f"R{n}": reasons for n, (_, reasons) in enumerate(REJECTED)} | {"R9": ["malformed_csv"]}
CURRENT = [next((v for v in NEWER if v["product_id"] == line["product_id"]), line) for line in SOUND]


def _money(row):
    gross = Decimal(row["quantity"]) * Decimal(row["unit_price"])
    return gross, Decimal(row["discount_amount"]), gross - Decimal(row["discount_amount"])


def day_of(row):
    return row["order_timestamp"][:10]


def totals(rows, key):
    """orders, lines, units, gross, discount and net of the completed rows of each key."""
    found = {}
    for row in rows:
        if row["status"] == "COMPLETED":
            orders, sums = found.setdefault(key(row), (set(), [0, 0, Decimal(0), Decimal(0), Decimal(0)]))
            orders.add(row["order_id"])
            for at, value in enumerate((1, int(row["quantity"]), *_money(row))):
                sums[at] += value
    return {key: (len(orders), *sums) for key, (orders, sums) in found.items()}


# date, country, category, orders, lines, units, gross, discount, net
SAMPLE_DAILY = {
    (*key, *sums[:3], *map(str, sums[3:]))
    for key, sums in totals(CURRENT, lambda r: (day_of(r), r["country"], r["category"])).items()
}
SAMPLE_NET = sum(sums[5] for sums in totals(CURRENT, lambda r: ()).values())
SAMPLE_METRICS = {
    "input_rows": len(SAMPLE),
    "rejected_rows": len(SAMPLE_REASONS),
    "duplicate_rows": len(NEWER),
    "valid_rows": len(SOUND),
    "gold_rows": len(SAMPLE_DAILY),
    "reject_ratio": len(SAMPLE_REASONS) / len(SAMPLE),
    "net_amount": str(SAMPLE_NET),
}


def write_csv(folder, name, lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(folder)
