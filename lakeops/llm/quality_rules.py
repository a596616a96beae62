"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Defined results
- null text has no words and fails; so does empty text.
- a line is what ``\\n`` separates; only lines with a word count.
- words found in repeated windows are counted once, however many windows hold them.
- two 8-word windows are equal if 64-bit hashes of their words are.
- other columns pass through; clashing result columns are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import SPACES, WORD

WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Very frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in that is it for on with as be at by this are was from or an have not they which you".split()
    + "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er".split()
    + "le la les de des du et un une en que qui dans pour est sur par au il ne pas plus ce se".split()
    + "el la los las de del que y en un una por con para es se su al lo como más o pero sus".split()
)


class Rule(NamedTuple):
    """A metric must lie between ``least`` and ``most``, both included; None is open."""

    name: str
    metric: str
    least: float | None
    most: float | None


#: The thresholds. ``metric`` names a column of :func:`metrics` or a ratio of them.
RULES = (
    Rule("words", "n_words", 20, 200_000),
    Rule("word_length", "word_chars / n_words", 2, 12),
    Rule("symbols", "n_symbols / n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("stop_word_share", "n_stop_words / n_words", 0.02, None),
    Rule("capital_words", "n_capital_words / n_words", None, 0.5),
    Rule("letter_words", "n_letter_words / n_words", 0.7, None),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.3),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("repeated_words", "n_repeat_words / n_words", None, 0.3),
)


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in windows of 8 words that occur twice or more in ``_words``, each word once.

    Hashes of all windows are sorted with their places only if a hash repeats;
    a repeated window adds as many words as lie before the next one, 8 at most.
    Each step is a column of its own, so that no step runs again for each element of the next.
    """
    words, hashes, ordered, places = (F.col(c) for c in ("_words", "_hashes", "_ordered", "_places"))
    windows = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashed = F.when(F.size(words) > WINDOW, F.transform(windows, lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    last = F.size(ordered) - 1

    def is_twin(x: Column, k: Column) -> Column:
        before, after = F.get(ordered, F.greatest(k - 1, F.lit(0))), F.get(ordered, F.least(k + 1, last))
        return ((k > 0) & (before["h"] == x["h"])) | ((k < last) & (after["h"] == x["h"]))

    twins = F.array_sort(F.transform(F.filter(ordered, is_twin), lambda x: x["i"]))
    steps = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    rows = rows.withColumn("_hashes", hashed)
    rows = rows.withColumn("_ordered", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.array_sort(placed)))
    rows = rows.withColumn("_places", twins)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_hashes", "_ordered", "_places")


def metrics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the counts that the rules use.

    Higher-order functions work on the words of one row; the plan is a scan and projections.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    out = docs.drop("n_repeat_words").withColumns({"_words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), "_lines": lines})
    out = _with_repeat_words(out)
    words, lines = F.col("_words"), F.col("_lines")
    stop = [F.lit(w) for w in dict.fromkeys(STOP_WORDS)]

    def count(array: Column, holds) -> Column:
        return F.size(F.filter(array, holds)).cast("long")

    return out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_stop_words": count(words, lambda w: F.lower(F.translate(w, ".,;:!?", "")).isin(*stop)),
            "n_capital_words": count(words, lambda w: (F.length(w) > 1) & w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}")),
            "n_letter_words": count(words, lambda w: w.rlike(r"\p{L}")),
            "n_ellipsis_lines": count(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")),
            "n_bullet_lines": count(lines, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•")),
        }
    ).drop("_words", "_lines")


def _holds(rule: Rule) -> Column:
    parts = rule.metric.split(" / ")
    value = F.col(parts[0]).cast("double")
    if len(parts) == 2:
        value = F.when(F.col(parts[1]) > 0, value / F.col(parts[1])).otherwise(F.lit(0.0))
    out = F.lit(True)
    if rule.least is not None:
        out = out & (value >= F.lit(float(rule.least)))
    if rule.most is not None:
        out = out & (value <= F.lit(float(rule.most)))
    return out


def judge(docs: DataFrame, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the metrics, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    failed = F.filter(F.array(*[F.when(~_holds(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = metrics(docs, text=text).withColumns({"base_failed": base, "failed_rules": failed})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
