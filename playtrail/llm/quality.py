"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.text import SPACE, WORD, bound, whole
from playtrail.operators.once import computed_once

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not this are or an at from "
    "der die das und in zu den mit von ist im für auf ein eine dem des nicht sich auch "
    "le la les de des et en un une que pour dans qui sur au du par pas est il elle "
    "el los las y del se por con una su para como es al lo"
)

N_GRAM = 5


@dataclass(frozen=True)
class Rule:
    """A measure that must lie within bounds; `None` leaves a side open. Without the measure's base it passes."""

    name: str
    top: str
    base: str | None
    least: float | None = None
    most: float | None = None
    slack: int = 0  # so many units may be short of `least`, for short texts


# A text is kept if every rule holds. Ratios are measured against the column in `base`.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 1.5, 25),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.2),
    Rule("exclamations_per_word", "n_exclamations", "n_words", None, 0.5),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.02, None, slack=1),
    Rule("repeated_line_share", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", None, 0.3),
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def _share(values: Column, test) -> Column:
    return F.size(F.filter(values, test)).cast("bigint")


def _twins(ordered: Column, key: str) -> Column:
    """The rows of a sorted array whose key is also that of a neighbour."""

    def twin(row: Column, k: Column) -> Column:
        same = lambda other: F.coalesce(other[key] == row[key], F.lit(False))
        return same(F.get(ordered, k - 1)) | same(F.get(ordered, k + 1))

    return F.filter(ordered, twin)


def _repeated_words(words: Column, n: int) -> Column:
    """Words in n-word windows that occur twice or more in the text."""
    later = lambda at: [F.get(words, at + j) for j in range(n)]
    starts = F.sequence(F.lit(0), F.size(words) - n)
    hashes = F.transform(starts, lambda at: F.xxhash64(*later(at)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda at, k: F.least(F.lit(n), F.coalesce(F.get(places, k + 1) - at, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def compared(found: Column) -> Column:
        """Windows with equal hashes, compared word by word."""
        hashed = F.sort_array(F.transform(found, lambda hash, at: F.struct(hash.alias("hash"), at.alias("at"))))
        alike = bound(hashed, lambda ordered: _twins(ordered, "hash"))
        spelled = F.transform(
            alike, lambda row: F.struct(F.concat_ws(" ", *later(row["at"])).alias("words"), row["at"].alias("at"))
        )
        repeated = bound(F.sort_array(spelled), lambda ordered: _twins(ordered, "words"))
        return bound(F.sort_array(F.transform(repeated, lambda row: row["at"])), covered)

    # Equal windows have equal hashes: a text whose hashes all differ repeats none, and most texts are such.
    counted = bound(
        hashes, lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(compared(found))
    )
    return F.when(F.size(words) < n, F.lit(0)).otherwise(counted).cast("bigint")


_SPACED, _WORDS, _LINES = (f"__quality_{name}" for name in ("spaced", "words", "lines"))


def _forms(stop_words: str) -> list[str]:
    """The words as they stand in a text: also at the start of a sentence and before a mark."""
    plain = {form for word in stop_words.split() for form in (word, word.capitalize())}
    return sorted(word + mark for word in plain for mark in ("", ",", "."))


def measures(text: Column, stop_words: str = STOP_WORDS, n: int = N_GRAM) -> dict[str, Column]:
    """Every count that rules can refer to, over the columns that `quality` prepares."""
    words, lines = F.col(_WORDS), F.col(_LINES)
    word_count = F.size(words)
    return {
        "n_words": word_count.cast("bigint"),
        "word_chars": (F.length(_SPACED) - F.greatest(word_count - 1, F.lit(0))).cast("bigint"),
        "n_symbols": _count(text, r"[#*$%&|<>]"),
        "n_exclamations": _count(text, r"!"),
        "n_stop_words": _share(words, lambda word: word.isin(_forms(stop_words))),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_bullet_lines": _share(lines, lambda line: line.rlike(r"^[\x20\t]*[-*•][\x20\t]")),
        "n_ellipsis_lines": _share(lines, lambda line: line.endswith("...") | line.endswith("…")),
        "n_repeat_words": _repeated_words(words, n),
    }


def holds(rule: Rule) -> Column:
    top = F.col(rule.top)
    base = F.lit(1) if rule.base is None else F.col(rule.base)
    checks = F.lit(True)
    if rule.least is not None:
        checks = checks & (top + rule.slack >= base * rule.least)
    if rule.most is not None:
        checks = checks & (top <= base * rule.most)
    return checks


def quality(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", min_words: int = 10) -> DataFrame:
    """All columns of `df`, the measures, `base_failed`, `failed_rules` and `kept`.

    Null counts as empty text; empty texts have no words and fail. Columns of `df` with the name of an
    added one give way to it. Every row is judged by itself: repeated rows stay repeated, an empty
    table stays empty. Nothing is shuffled. A row needs about ten times the memory of its text.
    """
    found = measures(whole(text))
    kept_columns = [c for c in df.columns if c not in {*found, "base_failed", "failed_rules", "kept"}]
    spaced = F.trim(F.regexp_replace(whole(text), SPACE, " "))
    no_words = F.array().cast("array<string>")
    prepared = (
        df.withColumn(_SPACED, spaced)
        .withColumn(_WORDS, F.when(F.col(_SPACED) == "", no_words).otherwise(F.split(_SPACED, " ")))
        .withColumn(_LINES, F.filter(F.split(whole(text), "\n"), lambda line: line.rlike(WORD)))
    )
    measured = prepared.select(*kept_columns, *(column.alias(name) for name, column in found.items()))
    few_or_repeated = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.array_compact(F.array(*(F.when(~holds(rule), F.lit(rule.name)) for rule in rules)))
    judged = measured.withColumns({"base_failed": few_or_repeated, "failed_rules": broken})
    # A filter on the verdict must not be pushed below the columns it is made of, which would compute them
    # again inside each other.
    return computed_once(judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
