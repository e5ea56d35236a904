"""Join the event collection to lines of a lake file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.constants import COMMA, COUNTRY_FIELD, DOCUMENT, DOCUMENT_FIELDS, SEMICOLON
from lakemark.functions.events import document_text, event_text, quoted_name, row_text
from lakemark.functions.lines import (
    has_indicator,
    key_first_comma,
    key_plain,
    key_quoted,
    series_mean,
)
from lakemark.operators import profile
from lakemark.operators.counts import part_number
from lakemark.operators.places import with_places
from lakemark.sources.fields import clashes, find_field
from lakemark.sources.lake import plain_bytes, read_lines, strip_header

# A side is broadcast only when it was measured to be at most this large.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 64
# Rows of the table of bits that stands for the keys of the lines beyond that.
KEY_WORDS = 1 << 18
# Different texts in a list of matches.
LIST_SIZE = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows in a hash table, from one aggregation; one number returned.

    Values count as text, and every row has a fixed cost on top, so many tiny
    rows are not taken for a small table.
    """
    width = sum(
        (F.coalesce(F.octet_length(quoted_name(c).cast("string")), F.lit(0)) for c in df.columns),
        F.lit(ROW_BYTES),
    )
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def bit_of(key: Column) -> tuple[Column, Column]:
    """Row and bit of a key in a table of ``KEY_WORDS`` rows of 64 bits."""
    digest = F.xxhash64(key)
    return F.pmod(F.shiftright(digest, 6), F.lit(KEY_WORDS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), digest.bitwiseAND(F.lit(63)).cast("int"))


def with_partner(events: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """The events whose key may be among those of the lines: all that are, and few others.

    The keys of the lines are brought down to a table of bits that has ``KEY_WORDS`` rows at most
    however many there are, so it may be broadcast at any size; the events are held against
    it where they are read, before anything is shuffled.
    """
    word, bit = bit_of(quoted_name(key))
    keys = lines.filter(quoted_name(key).isNotNull()).select(word.alias("word_"), bit.alias("bit_"))
    table = keys.groupBy("word_").agg(F.bit_or("bit_").alias("bits_"))
    met = (word == F.col("word_")) & (bit.bitwiseAND(F.col("bits_")) != 0)
    return events.filter(quoted_name(key).isNotNull()).join(F.broadcast(table), met, "left_semi")


def match_on_key(
    events: DataFrame, lines: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES, known_bytes: int | None = None
) -> DataFrame:
    """Inner equi-join that keeps every pair; null keys pair with nothing.

    Measured small, ``lines`` is broadcast and the events are not shuffled; ``known_bytes`` is a
    size that they surely do not exceed, which saves the measuring where it is small, as
    a negative ``broadcast_bytes`` does where they are surely large.
    Beyond that limit events without a line are left out by ``with_partner``, then both sides are
    shuffled and joined by sort and merge, and AQE splits a key that is hot on either side. The
    result has the same columns and rows either way. It holds all pairs of a key, so it grows
    with the product of a key's events and lines.
    """
    clash = clashes(events, lines, key)
    if clash:
        raise ValueError(f"rename these event fields, the result has its own: {clash}")
    if known_bytes is not None and 0 <= known_bytes <= broadcast_bytes:
        return events.join(F.broadcast(lines), key)
    if broadcast_bytes >= 0 and measured_bytes(lines) <= broadcast_bytes:
        return events.join(F.broadcast(lines), key)
    return with_partner(events, lines, key).join(lines, key)


def with_late_text(events: DataFrame) -> tuple[DataFrame, Column]:
    """The events under names that clash with none, and the text of an event made of these.

    So typed values are shuffled, of events that have a partner, and their text is made behind
    the join. Of documents without a schema only the document is kept.
    """
    if {DOCUMENT, DOCUMENT_FIELDS} <= set(events.columns):
        packed = events.select(quoted_name(COUNTRY_FIELD), F.col(DOCUMENT).alias("event_0_"), F.col(DOCUMENT_FIELDS).alias("event_1_"))
        return packed, document_text(F.col("event_0_"), F.col("event_1_"))
    country = find_field(events, COUNTRY_FIELD)
    names = [COUNTRY_FIELD if c == country else f"event_{i}_" for i, c in enumerate(events.columns)]
    packed = events.select(*[quoted_name(c).alias(n) for c, n in zip(events.columns, names)])
    return packed, row_text(packed)


def keyed_indicator_lines(lines: DataFrame, code: str, key: str = "first_comma") -> DataFrame:
    """Distinct lines with the indicator, as ``(country_txt, line, copies)``."""
    if key not in ("first_comma", "quoted"):
        raise ValueError(f"unknown key rule: {key!r}")
    line = F.col("value")
    country = key_first_comma(line) if key == "first_comma" else key_quoted(line, 0)
    return (
        lines.filter(has_indicator(line, code))
        .groupBy("value")
        .agg(F.count("*").alias("copies"))
        .select(country.alias(COUNTRY_FIELD), line.alias("line"), "copies")
    )


def indicator_means(
    lines: DataFrame, code: str, key: str = "first_comma", empty: str = "zero", bad: str = "error"
) -> DataFrame:
    """One row per distinct line with the indicator: ``(country_txt, line, mean)``."""
    keyed = keyed_indicator_lines(lines, code, key)
    return keyed.select(
        COUNTRY_FIELD, "line", series_mean(F.col("line"), empty, bad).alias("mean")
    )


def indicator_matches(
    events: DataFrame, lines: DataFrame, code: str, key: str = "first_comma", **limits
) -> DataFrame:
    """Every event next to every indicator line of its country.

    ``(country_txt, line, event, copies)``: one row per event and distinct
    line, ``copies`` being how often the line occurs. This is the group of a
    (country, line) pair in rows, so a hot country is never one group; of course
    there are as many rows as pairs.
    """
    packed, text = with_late_text(events)
    keyed = keyed_indicator_lines(lines, code, key)
    return match_on_key(packed, keyed, COUNTRY_FIELD, **limits).select(
        COUNTRY_FIELD, "line", text.alias("event"), "copies"
    )


def indicator_match_lists(
    events: DataFrame,
    lines: DataFrame,
    code: str,
    key: str = "first_comma",
    parts: int | None = None,
    part_size: int = LIST_SIZE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same matches, nested per (country, line), in lists of a bounded size.

    ``(country_txt, line, copies, part, events ARRAY<STRUCT<event, times>>)``.
    Equal texts are counted first. The different texts of a country are cut into lists of
    ``part_size`` in their order, the last one shorter. With ``parts`` every country has
    that many lists instead, one for instance, over which a hash spreads the texts.
    ``indicator_matches`` is the form without lists. Events of countries without a line are left
    out before anything is shuffled; the events are read once; a list is built once per
    country part, before the join, not once per line.
    """
    keyed = keyed_indicator_lines(lines, code, key)
    # Measured once; their keys are no more than they are.
    small = broadcast_bytes >= 0 and measured_bytes(keyed) <= broadcast_bytes
    keyed = F.broadcast(keyed) if small else keyed
    if small:
        located = events.filter(quoted_name(COUNTRY_FIELD).isNotNull())
        located = located.join(F.broadcast(keyed.select(COUNTRY_FIELD).distinct()), COUNTRY_FIELD, "left_semi")
    else:
        located = with_partner(events, keyed, COUNTRY_FIELD)
    located = located.select(*[quoted_name(c) for c in events.columns])
    texts = (
        located.select(quoted_name(COUNTRY_FIELD).alias(COUNTRY_FIELD), event_text(located).alias("event"))
        .groupBy(COUNTRY_FIELD, "event")
        .agg(F.count("*").alias("times"))
    )
    if parts is None:
        part = F.expr(f"place_ div {int(part_size)}")
        texts = with_places(texts, [COUNTRY_FIELD], ["event"], "place_")
    else:
        part = part_number(F.col("event"), F.lit(parts))
    lists = (
        texts.withColumn("part", part)
        .repartition(COUNTRY_FIELD, "part")
        .groupBy(COUNTRY_FIELD, "part")
        .agg(F.array_sort(F.collect_list(F.struct("event", "times"))).alias("events"))
    )
    return lists.join(keyed, COUNTRY_FIELD).select(
        COUNTRY_FIELD, "line", "copies", "part", "events"
    )


def keyed_lines(lines: DataFrame, sep: str, index: int, strict: bool = True) -> DataFrame:
    """Lines with their key field, as ``(country_txt, line)``.

    Comma lines are split with regard to quotes, which are then removed;
    semicolon lines are split plainly and keep them.
    """
    if sep == COMMA:
        country = key_quoted(F.col("value"), index, COMMA, strict)
    elif sep == SEMICOLON:
        country = key_plain(F.col("value"), index, SEMICOLON, strict)
    else:
        raise ValueError(f"delimiter must be {COMMA!r} or {SEMICOLON!r}, not {sep!r}")
    return lines.select(country.alias(COUNTRY_FIELD), F.col("value").alias("line"))


def parametric_join(
    events: DataFrame,
    lines: DataFrame,
    sep: str,
    index: int,
    strict: bool = True,
    as_text: bool = False,
    **limits,
) -> DataFrame:
    """Join the events to the lines whose field ``index`` is their country.

    Gives the event columns and ``line``; with ``as_text`` it gives
    ``(country_txt, event, line)``, the whole event as one text. ``strict``
    fails on a line without that field, otherwise the line joins nothing. The text is
    made after the join, so that typed columns are shuffled and not their text. Without
    ``as_text`` an event field that the session takes for ``line`` is refused.
    """
    keyed = keyed_lines(lines, sep, index, strict)
    if as_text:
        packed, text = with_late_text(events)
        joined = match_on_key(packed, keyed, COUNTRY_FIELD, **limits)
        return joined.select(COUNTRY_FIELD, text.alias("event"), "line")
    return match_on_key(events, keyed, COUNTRY_FIELD, **limits)


def join_profiled(
    spark: SparkSession,
    events: DataFrame,
    lake_path: str,
    metadata_path: str,
    dataset: str,
    sep: str,
    header: str | None = None,
    **options,
) -> DataFrame:
    """Join the events to a lake file on the key column its profile names.

    ``header`` is the file's first line if it is known, which saves reading it. A file whose size
    shows that its lines are few is not read to be measured.
    """
    index = profile.load_key(spark, metadata_path, dataset)
    lines = strip_header(read_lines(spark, lake_path), header)
    return parametric_join(events, lines, sep, index, known_bytes=most_bytes(spark, lake_path), **options)


def most_bytes(spark: SparkSession, path: str) -> int | None:
    """What the keyed lines of a file take at most, by ``measured_bytes``: a line is a byte at
    least, and its key no longer than it. None for compressed files."""
    size = plain_bytes(spark, path)
    return None if size is None else 2 * size + ROW_BYTES * (size + 1)
