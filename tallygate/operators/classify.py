"""Normalise source rows, parse them, and record which rules each one breaks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.contract import (
    CORRUPT,
    DEFAULT_LIMITS,
    MONEY,
    ORDER_LINES,
    QUARANTINE,
    RECORD_HASH,
    SOURCE_COLUMNS,
    SOURCE_FILE,
    Limits,
)
from tallygate.functions.rules import (
    Rule,
    contract_rules,
    gross_amount,
    mask_metadata,
    net_amount,
    nothing_broken,
    parsed_columns,
    reasons,
    rule_mask,
    typed,
)
from tallygate.operators.versions import TIED
from tallygate.session import use_contract_time

BROKEN_RULES = "broken_rules"
ACCEPTED = "accepted"

UPPER_CASED = ("country", "status")
AMOUNTS = ("gross_amount", "net_amount")

#: Source columns with a parsed value, and the texts of an order line that its values don't spell.
PARSED = ("quantity", "unit_price", "discount_amount", "order_timestamp", "updated_at")
SPELLING = "spelling"


def record_hash(text: Callable[[str], Column] = F.col) -> Column:
    """SHA-256 over the JSON form of the twelve normalised values, nulls included."""
    row = F.struct(*(text(name).alias(name) for name in SOURCE_COLUMNS))
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def spelled(name: str, value: Column) -> Column:
    """The usual text of a parsed value."""
    if name in ("order_timestamp", "updated_at"):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    return value.cast("string")


def _normalised(source: DataFrame, keep: Sequence[str]) -> DataFrame:
    absent = sorted(set(SOURCE_COLUMNS) - set(source.columns))
    if absent:
        raise ValueError(f"Missing required source columns: {', '.join(absent)}")

    def tidy(name: str) -> Column:
        text = F.trim(F.col(name).cast("string"))
        return (F.upper(text) if name in UPPER_CASED else text).alias(name)

    def optional(name: str) -> Column:
        value = F.col(name) if name in source.columns else F.lit(None)
        return value.cast("string").alias(name)

    return source.select(
        *map(tidy, SOURCE_COLUMNS), optional(CORRUPT), optional(SOURCE_FILE), *keep
    )


def with_typed_amounts(parsed: DataFrame) -> DataFrame:
    return parsed.withColumns({typed("gross_amount"): gross_amount()}).withColumns(
        {typed("net_amount"): net_amount()}
    )


def without_typed_amounts(classified: DataFrame) -> DataFrame:
    """What need not be stored of classified rows: ``with_typed_amounts`` gives it back."""
    return classified.drop(*map(typed, AMOUNTS))


def classify(
    source: DataFrame,
    rules: Sequence[Rule] | None = None,
    limits: Limits = DEFAULT_LIMITS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every source row with its parsed values, amounts, record hash and broken rules.

    Columns named in ``keep`` are carried along as they are.

    The result is a chain of projections without a shuffle.  Where several consumers need
    it, write it once and read it back (see ``plans.publish``).
    """
    use_contract_time(source.sparkSession)
    rules = contract_rules(limits) if rules is None else rules
    return (
        _normalised(source, keep)
        .withColumns({RECORD_HASH: record_hash(), **parsed_columns(limits)})
        .transform(with_typed_amounts)
        .withColumns({BROKEN_RULES: rule_mask(rules)})
        .withMetadata(BROKEN_RULES, mask_metadata(rules))
        .withColumns({ACCEPTED: nothing_broken(F.col(BROKEN_RULES))})
    )


def without_hash(classified: DataFrame) -> DataFrame:
    """Classified rows as they are staged: accepted ones with their parsed values, and only those texts
    that the values don't spell; rejected ones with their texts. ``with_hash`` works the hash out again."""
    accepted = F.col(ACCEPTED)
    texts, values = {}, {}
    for name in PARSED:
        value = F.col(typed(name))
        usual = accepted & F.col(name).eqNullSafe(spelled(name, value))
        texts[name] = F.when(~usual, F.col(name))
        values[typed(name)] = F.when(accepted, value)
    return classified.withColumns(texts | values).drop(RECORD_HASH)


def with_hash(staged: DataFrame) -> DataFrame:
    """Rows of ``without_hash`` with their record hash."""

    def text(name: str) -> Column:
        if name not in PARSED:
            return F.col(name)
        return F.coalesce(F.col(name), spelled(name, F.col(typed(name))))

    return staged.withColumn(RECORD_HASH, record_hash(text))


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Quarantine: the untyped values of rejected rows with every reason, in rule order."""
    return (
        classified.filter(~F.col(ACCEPTED))
        .withColumn("validation_errors", reasons(classified, BROKEN_RULES))
        .select(*QUARANTINE.fieldNames())
    )


def _recognised(amount: Column) -> Column:
    return F.when(F.col("status") == "COMPLETED", amount).otherwise(F.lit(0).cast(MONEY))


def slim_lines(staged: DataFrame) -> DataFrame:
    """Order lines as they are shuffled and staged: the accepted rows of ``without_hash``, without what
    follows from other columns, and with the texts that a line's values don't spell, null where none."""
    spelling = F.when(F.coalesce(*PARSED).isNotNull(), F.struct(*PARSED)).alias(SPELLING)
    derived = {*AMOUNTS, "order_date", RECORD_HASH}
    return staged.filter(ACCEPTED).select(
        *(
            F.col(typed(name) if name in PARSED else name).alias(name)
            for name in ORDER_LINES.fieldNames()
            if name not in derived
        ),
        spelling,
    )


def _added(lines: DataFrame, name: str, value: Column) -> DataFrame:
    return lines if name in lines.columns else lines.withColumn(name, value)


def with_amounts(lines: DataFrame) -> DataFrame:
    """Order lines with their amounts again; those that are there stay as they are."""
    lines = _added(lines, "gross_amount", _recognised(gross_amount(str)))
    return _added(lines, "net_amount", _recognised(net_amount(str)))


def with_derived(lines: DataFrame) -> DataFrame:
    """Order lines with their amounts, date and hash again; those that are there stay as they are."""

    def text(name: str) -> Column:
        if name not in PARSED:
            return F.col(name)
        return F.coalesce(F.col(SPELLING)[name], spelled(name, F.col(name)))

    lines = _added(with_amounts(lines), "order_date", F.to_date("order_timestamp"))
    return lines if RECORD_HASH in lines.columns else lines.withColumn(RECORD_HASH, record_hash(text))


def with_hash_to_rank(lines: DataFrame) -> DataFrame:
    """Slim lines with what their version order needs: the hash, of tied lines alone where those are marked."""
    value = F.unhex(RECORD_HASH)
    if TIED in lines.columns:
        value = F.when(F.col(TIED), value)
    return with_derived(lines).select(*lines.columns, value.alias(RECORD_HASH))


def accepted_lines(classified: DataFrame) -> DataFrame:
    """Accepted rows in the order-line schema; cancelled lines count for no money."""
    values = {
        "quantity": F.col(typed("quantity")),
        "unit_price": F.col(typed("unit_price")),
        "discount_amount": F.col(typed("discount_amount")),
        "order_timestamp": F.col(typed("order_timestamp")),
        "updated_at": F.col(typed("updated_at")),
        "gross_amount": _recognised(F.col(typed("gross_amount"))),
        "net_amount": _recognised(F.col(typed("net_amount"))),
        "order_date": F.to_date(typed("order_timestamp")),
    }
    return classified.filter(ACCEPTED).select(
        *(values.get(name, F.col(name)).alias(name) for name in ORDER_LINES.fieldNames())
    )
