"""Column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from platewise.contracts import EVENT_LABELS, USER_TAGS

DATE_PATTERNS = ("M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yy", "MMMM d, yyyy", "MMM d, yyyy")
UNIX_EPOCH_SERIAL = 25569  # spreadsheet day number of 1970-01-01, counted from 1899-12-30
SECONDS_PER_DAY = 86400


def col_of(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def not_blank(column: Column | str) -> Column:
    return F.length(F.trim(col_of(column))) > 0


def or_default(column: Column | str, default: str) -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(F.nullif(col_of(column), F.lit("")), F.lit(default))


def epoch_seconds(text: Column | str) -> Column:
    """Date text to whole epoch seconds; text that is no date becomes null."""
    value = F.trim(col_of(text))
    patterns = [F.try_to_timestamp(value, F.lit(p)) for p in DATE_PATTERNS]
    return F.unix_seconds(F.coalesce(F.try_to_timestamp(value), *patterns))


def serial_to_epoch(serial: Column | str) -> Column:
    """Spreadsheet day number to whole epoch seconds."""
    return F.floor((col_of(serial) - UNIX_EPOCH_SERIAL) * SECONDS_PER_DAY).cast("bigint")


def epoch_to_date(seconds: Column | str) -> Column:
    return F.to_date(F.timestamp_seconds(col_of(seconds)))


def int_prefix(text: Column | str) -> Column:
    """The whole number the text starts with, else null ('4.7' and '4abc' give 4)."""
    found = F.regexp_extract(F.ltrim(col_of(text)), r"^[+-]?\d+", 0)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def float_prefix(text: Column | str) -> Column:
    """The decimal number the text starts with, else null."""
    found = F.regexp_extract(F.ltrim(col_of(text)), r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", 0)
    return F.nullif(found, F.lit("")).try_cast("double")


def strip_quoted_commas(line: Column | str) -> Column:
    """Remove commas between a pair of double quotes; linear in the length of the line."""
    parts = F.split(col_of(line), '"', -1)
    last = F.size(parts) - 1

    def clean(part: Column, index: Column) -> Column:
        quoted = (index % 2 == 1) & (index < last)
        return F.when(quoted, F.replace(part, F.lit(","), F.lit(""))).otherwise(part)

    return F.array_join(F.transform(parts, clean), '"')


def comma_to_space(text: Column | str) -> Column:
    return F.translate(col_of(text), ",", " ")


def split_list(text: Column | str, separator: str = "|") -> Column:
    return F.split(col_of(text), "\\" + separator if separator == "|" else separator)


def in_list(text: Column | str, value: Column | str) -> Column:
    """Is the value one of the '|'-separated entries?"""
    return F.array_contains(split_list(text), col_of(value))


def interest_tags(available: list[str]) -> Column:
    """City, state and locale (empty when null), then one tag per flag equal to '1'."""
    places = [F.coalesce(F.col(c), F.lit("")) if c in available else F.lit("")
              for c in ("shipping_city", "shipping_state", "locale")]
    flags = [F.when(F.col(flag) == "1", F.lit(tag)) for flag, tag in USER_TAGS if flag in available]
    return F.array_compact(F.array(*places, *flags))


def passage_text(name, roles, description) -> Column:
    """Text that stands for a menu in the vector index; nulls count as empty."""
    parts = [F.coalesce(col_of(c), F.lit("")) for c in (name, *roles)]
    return F.concat_ws(" ", *parts, F.coalesce(F.array_join(col_of(description), " "), F.lit("")))


def query_text(name, ingredients) -> Column:
    return F.concat_ws(",", col_of(name), F.array_join(col_of(ingredients), ","))


def event_label(event_type: Column | str) -> Column:
    source = col_of(event_type)
    label = source
    for event, shown in EVENT_LABELS.items():
        label = F.when(source == event, F.lit(shown)).otherwise(label)
    return label


def score_pct(score: Column | str) -> Column:
    """A 0..1 score as a percentage with two decimals."""
    return F.round(col_of(score) * 100, 2)


def whole_pct(part: Column, total: Column) -> Column:
    """Nearest whole percentage, halves up; 0 where the total is 0."""
    share = F.floor(100 * part / total + 0.5).cast("bigint")
    return F.when(total > 0, share).otherwise(F.lit(0).cast("bigint"))
