"""Statistics of a text as one Spark column expression, computed inside the row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import WORD_CHAR, let, words_of

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_upper")


def repeated_words(hashes: Column) -> Column:
    """Words inside windows of eight words that occur twice or more, given the words' hashes.

    Only a text with a repeated window is sorted, so the cost is linear for most and
    n log n at worst. Windows are compared by a 64-bit hash.
    """

    def windows(h: Column) -> Column:
        last = F.size(h) - (WINDOW - 1)
        return F.when(
            last >= 1,
            F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get(places, k - 1))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeats(grams: Column) -> Column:
        def twice(ordered: Column) -> Column:
            return F.filter(
                ordered,
                lambda e, k: F.coalesce(F.get(ordered, k - 1)["gram"] == e["gram"], F.lit(False))
                | F.coalesce(F.get(ordered, k + 1)["gram"] == e["gram"], F.lit(False)),
            )

        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))
        places = F.sort_array(F.transform(let(ordered, twice), lambda e: e["at"]))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(let(places, covered))

    return let(let(hashes, windows), repeats)


def counts(text: Column) -> Column:
    """Struct of the COUNTS of a text (bigint); a null text counts as empty.

    ``n_lines`` are lines with a word, ``n_dup_lines`` those equal to an earlier one.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD_CHAR))

    def of(words: Column, hashes: Column, lines: Column) -> Column:
        fields = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(hashes),
            "n_lines": F.size(lines),
            "n_distinct_words": F.size(F.array_distinct(hashes)),
            "n_digits": F.regexp_count(whole, F.lit("[0-9]")),
            "n_upper": F.regexp_count(whole, F.lit(r"\p{Lu}")),
        }
        return F.struct(*[fields[name].cast("bigint").alias(name) for name in COUNTS])

    return let(
        words_of(whole),
        lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(lines, lambda ls: of(w, h, ls))),
    )


RATIOS = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "digit_share", "upper_share", "words_per_line")


def ratios(c: Column) -> dict[str, Column]:
    """Scale-free statistics from a struct of counts; all finite, 0 for an empty text."""

    def share(part: str, whole: str) -> Column:
        return c[part].cast("double") / F.greatest(c[whole], F.lit(1))

    columns = (
        F.log1p(c["n_words"].cast("double")),
        share("word_chars", "n_words"),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_distinct_words", "n_words"),
        share("n_digits", "word_chars"),
        share("n_upper", "word_chars"),
        share("n_words", "n_lines"),
    )
    return dict(zip(RATIOS, columns, strict=True))
