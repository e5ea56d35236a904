"""Expressions over raw lines of a delimited lake file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemark.constants import FIRST_SERIES_TOKEN, TOKENS_PER_LINE

QUOTE = '"'


def has_indicator(line: Column, code: str) -> Column:
    """The code occurs anywhere in the line."""
    return line.contains(code)


def key_first_comma(line: Column) -> Column:
    """Text before the first comma, quotes removed.

    A quoted name with a comma inside is cut at that comma, which is what
    makes "Name, Qualifier" spellings match a plain "Name".
    """
    return F.replace(F.substring_index(line, ",", 1), F.lit(QUOTE), F.lit(""))


def key_plain(line: Column, index: int, sep: str = ";", strict: bool = True) -> Column:
    """Field ``index`` of a plain split; quotes are kept."""
    # The limit stops splitting right behind the wanted field.
    fields = F.split(line, rf"\Q{sep}\E", index + 2)
    return _present(F.get(fields, F.lit(index)), index, strict)


def key_quoted(line: Column, index: int, sep: str = ",", strict: bool = True) -> Column:
    """Field ``index`` of a quote-aware split, quotes removed.

    A delimiter separates fields when an even number of quotes follows it. So
    quoted text pairs up from the end of the line: where the number of quotes
    is odd, all before the first quote belongs to the first field.

    One pattern reads up to the wanted field and no further. It never steps
    back, so its time is linear and long lines are safe, where a look-ahead
    pattern would scan to the end of the line at every delimiter.
    """
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(QUOTE), F.lit("")))
    odd = F.pmod(quotes, F.lit(2)) == 1
    behind_first = F.substr(line, F.instr(line, QUOTE) + 1)
    field = rf'\Q{sep}\E(?:[^"\Q{sep}\E]++|"[^"]*+")*+'
    wanted = f"^(?:{field}){{{index}}}+({field})"

    def read(text: Column) -> Column:
        # With its delimiter in front, a blank field differs from a missing one.
        found = F.nullif(F.regexp_extract(F.concat(F.lit(sep), text), wanted, 1), F.lit(""))
        return F.replace(F.substr(found, F.lit(len(sep) + 1)), F.lit(QUOTE), F.lit(""))

    if index == 0:
        first = F.concat(F.substring_index(line, QUOTE, 1), read(behind_first))
        return _present(F.when(odd, first).otherwise(read(line)), index, strict)
    return _present(read(F.when(odd, behind_first).otherwise(line)), index, strict)


def _present(field: Column, index: int, strict: bool) -> Column:
    if index < 0:
        raise ValueError(f"field index must not be negative: {index}")
    if not strict:
        return field
    # The last value is never reached; it tells Spark that the key is not null,
    # which saves a second evaluation of the key in a null filter.
    failed = F.raise_error(F.lit(f"line has no field {index}"))
    return F.coalesce(field, failed.cast("string"), F.lit(""))


def series_mean(line: Column, empty: str = "zero", bad: str = "error") -> Column:
    """Mean of the yearly cells of a wide indicator line.

    Only quoted tokens are counted; token numbers start over after each full
    line width, and the first tokens of each width are labels. Blank cells are
    left out. A series without values, or one that adds up to zero, gives 0.0
    (``empty="null"`` gives null for a series without values).

    A cell that is no number fails the query; ``bad="null"`` makes the mean of
    that series null instead.
    """
    if empty not in ("zero", "null") or bad not in ("error", "null"):
        raise ValueError(f"unknown option: empty={empty!r}, bad={bad!r}")
    tokens = F.regexp_extract_all(line, F.lit('"([^"]*)"'), 1)
    cells = F.filter(
        tokens,
        lambda text, at: (F.pmod(at, F.lit(TOKENS_PER_LINE)) >= FIRST_SERIES_TOKEN)
        & (text != ""),
    )

    def number(text: Column) -> Column:
        value = text.try_cast("double")
        if bad == "null":
            return value
        failed = F.raise_error(F.concat(F.lit("not a number: "), text))
        return F.coalesce(value, failed.cast("double"))

    def finish(total: Column) -> Column:
        mean = F.when(total.sum == 0, F.lit(0.0)).otherwise(total.sum / total.cells)
        if empty == "null":
            return F.when(total.cells > 0, mean)
        return mean

    return F.aggregate(
        cells,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("cells")),
        lambda total, text: F.struct(
            (total.sum + number(text)).alias("sum"), (total.cells + 1).alias("cells")
        ),
        finish,
    )
