"""Column functions on texts. All of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from agoralens import fixed_values as fv


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    The value is bound as a lambda variable. A filter that the optimizer pushes below a
    projection then copies the whole expression, never a part of it into a loop.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_length(text) -> Column:
    """Characters of a text, null for a null text."""
    return F.length(text)


def word_count(text) -> Column:
    """Runs of characters other than white space; 0 for a blank text.

    The common characters are tried first, which spares most of the long class.
    """
    return F.regexp_count(text, F.lit(f"(?:[!-~]|[^{fv.SPACE_CLASS}])++"))


def is_blank(text) -> Column:
    """True for a text that is empty or white space only, null for a null text."""
    return ~F.rlike(text, F.lit(f"[^{fv.SPACE_CLASS}]"))


def with_text_counts(df, text="text"):
    return df.withColumns({"text_length": text_length(text), "word_count": word_count(text)})


def preview(text, length=fv.PREVIEW_LENGTH) -> Column:
    """The head of a text for display, always followed by an ellipsis."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def bullet_list(samples, length=fv.PREVIEW_LENGTH) -> Column:
    """One bullet line per sample, long ones cut for display, or a fixed sentence."""

    def bullet(s):
        cut = F.concat(F.lit("  - "), F.substring(s, 1, length), F.lit("..."))
        return F.when(F.length(s) > length, cut).otherwise(F.concat(F.lit("  - "), s))

    lines = F.array_join(F.transform(samples, bullet), "\n")
    return F.when(F.size(F.coalesce(samples, F.array())) == 0, F.lit(fv.NO_SAMPLES)).otherwise(lines)


def tokens(text) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(fv.TOKEN_PATTERN), F.lit(0))


def sentences(text) -> Column:
    """Trimmed sentences of a text without the blank ones."""
    edge = f"^[{fv.SPACE_CLASS}]+|[{fv.SPACE_CLASS}]+$"
    parts = F.regexp_extract_all(text, F.lit(fv.SENTENCE_PATTERN), F.lit(0))
    return F.filter(
        F.transform(parts, lambda s: F.regexp_replace(s, edge, "")), lambda s: s != ""
    )


def normal_label(label) -> Column:
    """A label in lower case without outer spaces."""
    return F.lower(F.trim(label))


def percent_text(value) -> Column:
    """A percentage with one decimal, halves rounded to even on the exact binary value."""
    return F.call_function("format_number", value, F.lit("0.0"))
