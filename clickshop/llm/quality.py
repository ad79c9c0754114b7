"""Quality rules: a threshold table compiled into one projection of built-in functions.

``TEXT_FIGURES`` are counts of one text; ``RULES`` bounds ratios of two of them.  Both
become columns of a single ``select``: no shuffle, no Python, one pass over the text.

A null text has no words and no lines; it fails ``n_words``.  An empty table gives an
empty result.  Rows are judged one by one, so repeated rows and ids change nothing, and
input columns of the same names as the figures are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.llm.common import let

SPACE = r"\x20\x09-\x0D"
# Where words end when stop words are counted: white space and plain punctuation.
PLAIN_END = r"[\x20\x09-\x0D.,;:!?\"'()]+"
WINDOW = 5

# Very frequent short words of the four languages the rules know.
STOP_WORDS = {
    "en": "the of and to in is that it for was on are as with be by at this from or an not have",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans par pas au sur avec aux ne se",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}


TEXT_FIGURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_stop_words",
    "n_lines",
    "n_dup_lines",
    "n_bullet_lines",
    "n_ellipsis_lines",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high`` must hold where ``whole`` is ``least`` or more."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    least: int = 1

    def fails(self, figure: dict[str, Column]) -> Column:
        part, whole = 100 * figure[self.part], figure[self.whole]
        checks = []
        if self.low is not None:
            checks.append(part < self.low * whole)
        if self.high is not None:
            checks.append(part > self.high * whole)
        return (whole >= self.least) & reduce(Column.__or__, checks)


#: Percentages.  Mean word length, symbols a word, stop words, kinds of lines.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbol_ratio", "n_symbols", "n_words", high=10),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=2, least=50),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", high=50),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", high=90),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", high=30),
)


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more in the text.

    Hashes of the windows tell texts without any repeat; only the others sort the
    windows themselves, so a hash collision changes nothing.
    """
    starts = F.when(
        F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - F.lit(WINDOW))
    ).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(words, i + F.lit(k)) for k in range(WINDOW)])
    )
    windows = F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                F.concat_ws(" ", *[F.get(words, i + F.lit(k)) for k in range(WINDOW)]).alias("w"),
                i.alias("i"),
            ),
        )
    )

    def twice(sorted_windows: Column) -> Column:
        def same(e: Column, i: Column) -> Column:
            before = F.get(sorted_windows, i - F.lit(1)).getField("w")
            after = F.get(sorted_windows, i + F.lit(1)).getField("w")
            w = e.getField("w")
            return F.coalesce(before == w, F.lit(False)) | F.coalesce(after == w, F.lit(False))

        return F.sort_array(
            F.transform(F.filter(sorted_windows, same), lambda e: e.getField("i"))
        )

    def covered(at: Column) -> Column:
        steps = F.transform(
            at,
            lambda p, k: F.coalesce(
                F.least(F.lit(WINDOW), p - F.get(at, k - F.lit(1))), F.lit(WINDOW)
            ),
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, x: s + x)

    return let(
        hashes,
        lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), let(let(windows, twice), covered)
        ).otherwise(F.lit(0).cast("bigint")),
    )


def figures(text: Column) -> Column:
    """All counts of one text, as one struct of longs."""
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})

    def long(x: Column, name: str) -> Column:
        return x.cast("bigint").alias(name)

    def of_words(words: Column, lines: Column) -> Column:
        return F.struct(
            long(F.size(words), "n_words"),
            long(F.length(F.array_join(words, "")), "word_chars"),
            long(
                F.length(text) - F.length(F.translate(text, "#*$%&|<>", "")), "n_symbols"
            ),
            long(
                F.size(F.filter(F.split(F.lower(text), PLAIN_END), lambda w: w.isin(stop))),
                "n_stop_words",
            ),
            long(F.size(lines), "n_lines"),
            long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
            long(F.size(F.filter(lines, lambda x: x.rlike(rf"^[{SPACE}]*[-*•]"))), "n_bullet_lines"),
            long(
                F.size(F.filter(lines, lambda x: x.rlike(rf"(\.\.\.|…)[{SPACE}]*$"))),
                "n_ellipsis_lines",
            ),
            repeat_words(words).alias("n_repeat_words"),
        )

    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return let(words, lambda w: let(lines, lambda x: of_words(w, x)))


def judge(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """``documents`` with one added struct column ``quality``.

    It holds the figures, ``base_failed``, the names of the failed rules and ``kept``.
    An input column called ``quality`` is replaced.
    """
    counts = figures(F.coalesce(F.col(text), F.lit("")))
    return documents.withColumn("quality", let(counts, lambda c: _verdict(c, rules)))


def keep_good(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``documents`` whose text passes every rule, in their own columns."""
    counts = figures(F.coalesce(F.col("text"), F.lit("")))
    return documents.filter(let(counts, lambda c: _verdict(c, rules)).getField("kept"))


def _verdict(counts: Column, rules: tuple[Rule, ...]) -> Column:
    figure = {name: counts.getField(name) for name in TEXT_FIGURES}
    base = (figure["n_words"] < 10) | (100 * figure["n_repeat_words"] > 20 * figure["n_words"])
    failed = F.array_compact(
        F.array(*[F.when(rule.fails(figure), F.lit(rule.name)) for rule in rules])
    )
    return F.struct(
        *[x.alias(n) for n, x in figure.items()],
        base.alias("base_failed"),
        failed.alias("failed_rules"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )
