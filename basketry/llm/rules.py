"""Quality rules: one threshold table, compiled into one projection of native functions.

Nulls and empty texts have no words, so they fail the base test on length.  Texts of any
length are measured whole; repeated rows are measured one by one; other columns of the input
are carried along by `judge`, which names its own with a prefix of the caller's choice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import whole, words

# Frequent function words of the four languages.
STOP_WORDS = (
    "a an and are as at be by for from has have he in is it its not of on or that the this to was were will with "
    "als auch auf aus bei das dem den der des die ein eine einen für im in ist mit nicht sich sie und von zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il la le les ou par pas pour que qui sur un une "
    "al como con de del el en es la las lo los no para pero por que se su un una y"
).split()

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A bound on the ratio of two measures; a text without the denominator passes."""

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None

    def passes(self, prefix: str) -> Column:
        share = F.col(prefix + self.top) / F.greatest(F.col(prefix + self.bottom), F.lit(1)).cast("double")
        tests = [share >= self.least] if self.least is not None else []
        tests += [share <= self.most] if self.most is not None else []
        return reduce(Column.__and__, tests)


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=2.0, most=20.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.06),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("lines_cut_short", "n_ellipsis_lines", "n_lines", most=0.3),
    Rule("listed_lines", "n_bullet_lines", "n_lines", most=0.9),
)


def _following(values: Column, step: int) -> Column:
    """The array without its first entries; zipped with the whole it pairs neighbours."""
    return F.slice(values, F.lit(step + 1), F.greatest(F.size(values), F.lit(1)))


def _repeat_words(rows: DataFrame, tokens: str, name: str) -> DataFrame:
    """Add how many words stand in 3-word windows that the text has twice or more.

    Windows are hashed and sorted with their place; equal neighbours mark repeated places, and
    neighbouring places share words, so each adds the gap to the next one, three at most.
    Each step is a column of its own, so that it is worked out once.
    """
    column = F.col(name)
    pairs = F.zip_with(tokens, _following(F.col(tokens), 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = rows.withColumn(name, F.zip_with(pairs, _following(F.col(tokens), 2), lambda p, c: F.xxhash64(p["a"], p["b"], c)))
    windows = F.slice(column, F.lit(1), F.greatest(F.size(column) - 2, F.lit(0)))
    rows = rows.withColumn(name, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    twins = F.zip_with(column, _following(column, 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    rows = rows.withColumn(name, F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda pair: pair.isNotNull())))))
    gaps = F.zip_with(column, _following(column, 1), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return rows.withColumn(name, F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
            "n_ellipsis_lines", "n_bullet_lines")


def measure(docs: DataFrame, text: str = "text", prefix: str = "quality_") -> DataFrame:
    """Add the counts the rules are made of, each under the prefix and its name."""
    tokens, lines = f"{prefix}tokens", f"{prefix}lines"
    body, token, line = whole(F.col(text)), F.col(tokens), F.col(lines)
    count = lambda values: F.size(values).cast("long")
    split = docs.withColumns({
        tokens: words(F.col(text)),
        lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    counted = split.withColumns({f"{prefix}{name}": value for name, value in {
        "n_words": count(token),
        "word_chars": F.char_length(F.array_join(token, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_lines": count(line),
        "n_dup_lines": (F.size(line) - F.size(F.array_distinct(line))).cast("long"),
        "n_stop_words": count(F.filter(token, lambda word: F.lower(word).isin(*STOP_WORDS))),
        "n_ellipsis_lines": count(F.filter(line, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
        "n_bullet_lines": count(F.filter(line, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
    }.items()})
    return _repeat_words(counted, tokens, f"{prefix}n_repeat_words").drop(tokens, lines)


def base_failed(prefix: str = "quality_") -> Column:
    n_words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n_words < 50) | (100 * repeated > 50 * n_words)


def judge(docs: DataFrame, text: str = "text", prefix: str = "quality_", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the counts, base_failed, and kept: the text passes the base test and every rule."""
    verdict = reduce(Column.__and__, [rule.passes(prefix) for rule in rules], ~base_failed(prefix))
    return measure(docs, text, prefix).withColumns({f"{prefix}base_failed": base_failed(prefix), f"{prefix}kept": verdict})
