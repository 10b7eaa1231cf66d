"""Validation rules as data: an ordered list of reasons and the condition behind each.

A row carries the outcome of all rules as a bit mask: an array of bigints with ``WORD_BITS``
rules each, bit *k* of word *w* for rule ``WORD_BITS`` * *w* + *k*.  The column's metadata names
the reasons, so a mask always reads as the rules that made it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.contract import CORRUPT, DEFAULT_LIMITS, MONEY, Limits

#: Rules in one bigint; its sign stays clear.
WORD_BITS = 63
REASONS = "reasons"

# Patterns of the data contract.  They use [0-9] and \z so that neither
# other digits nor a trailing line break can slip through.
TWO_LETTERS = r"\A[A-Z]{2}\z"
DIGITS = r"\A[0-9]+\z"
AMOUNT = r"\A[0-9]+(?:\.[0-9]{1,2})?\z"
TIMESTAMP = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"
# Times that a cast reads just as the usual format does; only a cast knows a year 0.
_CAST_TIME = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"


@dataclass(frozen=True)
class Rule:
    """``reason`` is reported for a row when ``broken`` holds; a null counts as unbroken."""

    reason: str
    broken: Column


def required(reason: str, condition: Column) -> Rule:
    """The condition has to hold; an unknown (null) condition breaks the rule."""
    return Rule(reason, ~F.coalesce(condition, F.lit(False)))


def forbidden(reason: str, condition: Column) -> Rule:
    """The condition must not hold; an unknown (null) condition is let through."""
    return Rule(reason, F.coalesce(condition, F.lit(False)))


def typed(name: str) -> str:
    """Name of the column that holds the parsed value of a source column."""
    return f"typed_{name}"


def parsed_columns(limits: Limits = DEFAULT_LIMITS) -> dict[str, Column]:
    """Typed counterparts of the text columns; null where the text does not parse."""

    def instant(name: str) -> Column:
        text = F.col(name)
        by_format = F.try_to_timestamp(text, F.lit(limits.timestamp_format))
        if limits.timestamp_format != DEFAULT_LIMITS.timestamp_format:
            return by_format
        # A cast takes a fraction of the time that a format takes.
        return F.when(text.rlike(_CAST_TIME), text.try_cast("timestamp")).otherwise(by_format)

    return {
        typed("quantity"): F.col("quantity").try_cast("int"),
        typed("unit_price"): F.col("unit_price").try_cast(MONEY),
        typed("discount_amount"): F.col("discount_amount").try_cast(MONEY),
        typed("order_timestamp"): instant("order_timestamp"),
        typed("updated_at"): instant("updated_at"),
    }


def gross_amount(named: Callable[[str], str] = typed) -> Column:
    return (F.col(named("quantity")) * F.col(named("unit_price"))).try_cast(MONEY)


def net_amount(named: Callable[[str], str] = typed) -> Column:
    return (F.col(named("gross_amount")) - F.col(named("discount_amount"))).try_cast(MONEY)


def contract_rules(limits: Limits = DEFAULT_LIMITS) -> list[Rule]:
    """The rules of the data contract, in the order their reasons are reported."""
    raw = F.col
    quantity, price, discount = (
        F.col(typed(name)) for name in ("quantity", "unit_price", "discount_amount")
    )
    ordered, updated = F.col(typed("order_timestamp")), F.col(typed("updated_at"))
    gross, net = F.col(typed("gross_amount")), F.col(typed("net_amount"))
    filled = [
        required(f"missing_{name}", raw(name) != "")
        for name in ("order_id", "line_id", "customer_id", "product_id", "category")
    ]
    in_range = F.to_date(ordered).between(
        F.lit(limits.first_order_date).cast("date"), F.lit(limits.last_order_date).cast("date")
    )
    return [
        forbidden("malformed_csv", raw(CORRUPT).isNotNull()),
        *filled,
        required("category_too_long", F.octet_length("category") <= limits.category_bytes),
        required("invalid_country", raw("country").rlike(TWO_LETTERS)),
        required("invalid_quantity", raw("quantity").rlike(DIGITS) & (quantity > 0)),
        required("invalid_unit_price", raw("unit_price").rlike(AMOUNT) & price.isNotNull()),
        required(
            "invalid_discount_amount", raw("discount_amount").rlike(AMOUNT) & discount.isNotNull()
        ),
        required(
            "invalid_order_timestamp",
            raw("order_timestamp").rlike(TIMESTAMP) & ordered.isNotNull(),
        ),
        required("invalid_updated_at", raw("updated_at").rlike(TIMESTAMP) & updated.isNotNull()),
        required("invalid_status", raw("status").isin(*limits.statuses)),
        forbidden("order_date_out_of_range", ~in_range),
        forbidden("updated_before_order", updated < ordered),
        forbidden("discount_exceeds_gross", discount > gross),
        forbidden(
            "amount_overflow",
            quantity.isNotNull() & price.isNotNull() & (gross.isNull() | net.isNull()),
        ),
    ]


def computed_once(value: Column) -> Column:
    """The same value, but filters on it stay above the projection that computes it.

    The optimizer moves a filter below a projection by copying the expression into it, and
    does so level by level.  For a value built from many parsed columns that means parsing
    every row twice, in code too large to compile.  It leaves expressions alone that
    depend on the task, so the value is tied to the task number, which is never negative.
    (User filters on other columns don't pass below such a projection either.)

    The test is a function over an array, which whole-stage code can't hold: the projection is
    compiled on its own, where Spark splits long expressions into methods that the JVM compiles.
    """
    here = F.exists(F.array(F.spark_partition_id()), lambda task: task >= 0)
    return F.when(here, value)


def rule_mask(rules: Sequence[Rule]) -> Column:
    """One bit per broken rule, in as many bigints as the rules need."""

    def word(part: Sequence[Rule]) -> Column:
        bits = (
            F.when(rule.broken, F.lit(1 << at).cast("long")).otherwise(F.lit(0).cast("long"))
            for at, rule in enumerate(part)
        )
        return reduce(Column.bitwiseOR, bits, F.lit(0).cast("long"))

    parts = [rules[at : at + WORD_BITS] for at in range(0, max(1, len(rules)), WORD_BITS)]
    return computed_once(F.array(*map(word, parts)))


def mask_metadata(rules: Sequence[Rule]) -> dict[str, list[str]]:
    return {REASONS: [rule.reason for rule in rules]}


def nothing_broken(mask: Column) -> Column:
    return F.array_max(mask) == 0


def reasons(frame: DataFrame, mask: str) -> Column:
    """The reasons behind a frame's mask column, in the order of the rules that made it."""
    names = frame.schema[mask].metadata[REASONS]

    def broken(at: int) -> Column:
        word, bit = divmod(at, WORD_BITS)
        return F.get(mask, F.lit(word)).bitwiseAND(F.lit(1 << bit).cast("long")) != 0

    return F.array_compact(F.array(*(F.when(broken(at), name) for at, name in enumerate(names))))
