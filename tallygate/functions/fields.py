"""Column expressions that split one physical CSV line into fields.

The contract's CSV dialect is strict: comma separated, fields optionally wrapped in
double quotes, a quote inside a quoted field doubled, nothing allowed between a closing
quote and the next comma, and no line breaks inside a field.  Spark's own CSV parser is
more forgiving (it accepts an unterminated quote), so the dialect is spelled out here as
built-in string functions that stay on the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "﻿"

# The grammar of the dialect.  Quantifiers are possessive, so that a long
# line is matched in one pass without backtracking.
QUOTED_FIELD = r'"[^"]*+(?:""[^"]*+)*+"'
PLAIN_FIELD = r'(?:[^",][^,]*+)?+'
FIELD = f"(?:{QUOTED_FIELD}|{PLAIN_FIELD})"
LINE = rf"\A{FIELD}(?:,{FIELD})*+\z"


def without_byte_order_mark(line: Column) -> Column:
    return F.ltrim(line, F.lit(BYTE_ORDER_MARK))


def is_blank(line: Column) -> Column:
    """Only spaces count as blank; a line holding a tab is data."""
    return F.trim(line) == ""


def is_header(line: Column, columns: Sequence[str]) -> Column:
    """True for a line whose fields are exactly the column names, quoted or not.

    Hardly any line names the first column, so hardly any is matched against the pattern.
    """
    choices = ",".join(f'(?:{name}|"{name}")' for name in columns)
    return F.contains(line, F.lit(columns[0])) & line.rlike(rf"\A{BYTE_ORDER_MARK}*+{choices}\z")


def split_fields(line: Column) -> Column:
    """The fields of a line without byte order mark, or null where quoting is broken.

    Lines without a quote are the common case and are split at the commas.  The others
    are matched against the grammar first; the pattern then walks over the fields, each
    led by a comma, so that no match is ever empty.
    """
    quoted = F.contains(line, F.lit('"'))
    pieces = F.regexp_extract_all(
        F.concat(F.lit(","), line), F.lit(f",({QUOTED_FIELD}|[^,]*+)"), F.lit(1)
    )
    unquoted = F.transform(
        pieces,
        lambda piece: F.when(
            F.startswith(piece, F.lit('"')),
            F.replace(F.substring(piece, F.lit(2), F.length(piece) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(piece),
    )
    fields = F.when(~quoted, F.split(line, ",", -1)).when(line.rlike(LINE), unquoted)
    return F.when(F.length(line) > 0, fields)
