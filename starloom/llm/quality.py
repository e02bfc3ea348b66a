"""Quality rules as one Spark projection (operator 9).

A table of thresholds over counts of a text - words, characters, symbols, stop
words, repeated lines, repeated word windows - is compiled into one projection
of built-in functions: no user function, no shuffle, one pass over the text.
Ratios are compared as products of whole numbers, so the same rules can be
written in SQL and give the same verdict to the last row.

Words are runs of characters other than ASCII white space; lines are split at
line feeds and count if they hold a word. Repeated windows are found in two
steps: 64-bit hashes of all windows show whether any could repeat; only then
are they sorted, and windows with equal hashes are compared word by word.

Defined results: a null or empty text has no words, all counts are 0 and it
fails ``few_words``; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import NON_GAP, WORD_GAP, only

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of the languages in the corpus.
STOP_WORDS = (
    "the of and to a in is it that for was on are as with be this by at from or "
    "le la les de du des et un une en que qui est dans pour par sur pas au ce il elle "
    "der die das und ein eine ist nicht mit von zu den im auf sich dem es für "
    "el los las del y una por con para se lo como su al más no"
).split()
STOP_WORD_LANGUAGES = ("en", "fr", "de", "es")


@dataclass(frozen=True)
class Threshold:
    """A text fails if (``part`` + ``plus``) / ``whole`` is below ``low`` or
    above ``high`` (both as numerator and denominator). ``plus`` spares short
    texts a rule about something that they may lack by chance. Base thresholds
    decide base_failed."""

    name: str
    part: str
    whole: str | None = None
    low: tuple[int, int] | None = None
    high: tuple[int, int] | None = None
    plus: int = 0
    base: bool = False


THRESHOLDS = (
    Threshold("few_words", "n_words", low=(10, 1), base=True),
    Threshold("repeated_windows", "n_repeat_words", "n_words", high=(20, 100), base=True),
    Threshold("word_length", "word_chars", "n_words", low=(2, 1), high=(15, 1)),
    Threshold("symbols", "n_symbols", "n_words", high=(1, 10)),
    Threshold("stop_words", "n_stop_words", "n_words", low=(1, 50), plus=1),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", high=(1, 2)),
)


def _fails(t: Threshold) -> Column:
    part = F.col(t.part) + t.plus if t.plus else F.col(t.part)
    whole = F.col(t.whole) if t.whole else F.lit(1).cast("long")
    sides = []
    if t.low:
        sides.append(part * t.low[1] < whole * t.low[0])
    if t.high:
        sides.append(part * t.high[1] > whole * t.high[0])
    return sides[0] if len(sides) == 1 else sides[0] | sides[1]


def _window_hash(i: Column) -> Column:
    return F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])


def _counts(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    words, lines, windows = F.col("_words"), F.col("_lines"), F.col("_windows")
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn("_words", F.array_remove(F.split(F.col("_text"), WORD_GAP, -1), ""))
    docs = docs.withColumn("_lines", F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike(NON_GAP)))
    docs = docs.withColumn("n_words", F.size(words).cast("long"))
    docs = docs.withColumn("_hashes", F.when(F.col("n_words") >= WINDOW, F.transform(starts, _window_hash)).otherwise(none))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    docs = docs.withColumn("_windows", F.when(repeats, F.sort_array(F.transform(F.col("_hashes"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def repeated(x: Column, k: Column) -> Column:
        def same(other: Column) -> Column:
            y = F.get(windows, other)
            return F.coalesce((y["h"] == x["h"]) & (F.slice(words, y["i"] + 1, F.lit(WINDOW)) == F.slice(words, x["i"] + 1, F.lit(WINDOW))), F.lit(False))

        return same(k - 1) | same(k + 1)

    at = F.sort_array(F.transform(F.filter(windows, repeated), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(at, start, lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")), lambda s: s["n"])
    # Always n_words, but not foldable: a filter on the verdict stays above the
    # counts. Pushed down, it would split the text anew for each use of a word.
    n_words = F.when(F.monotonically_increasing_id() >= 0, F.col("n_words"))
    symbols = F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", ""))
    return docs.withColumns({
        "n_words": n_words,
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))).cast("long"),
    })


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def quality_rules(docs: DataFrame, keep: Sequence[str] = ("doc_id",), thresholds: Sequence[Threshold] = THRESHOLDS, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The columns ``keep`` of docs, the counts, ``base_failed``, ``failed``
    (names of all thresholds that the text fails) and ``kept``."""
    clash = set(keep) & {*COUNTS, "base_failed", "failed", "kept"}
    if clash:
        raise ValueError(f"columns to keep that the rules set themselves: {sorted(clash)}")
    rows = only(docs, *keep, "text") if "text" not in keep else only(docs, *keep)
    rows = rows.withColumn("_text", F.coalesce("text", F.lit("")))
    counted = _counts(rows, stop_words).select(*[F.col(f"`{k}`") for k in keep], *COUNTS)
    base = F.lit(False)
    for t in thresholds:
        base = base | _fails(t) if t.base else base
    failed = F.array_compact(F.array(*[F.when(_fails(t), t.name) for t in thresholds]))
    return counted.withColumn("base_failed", base).withColumn("failed", failed).withColumn("kept", F.size("failed") == 0)
