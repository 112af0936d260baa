"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Each rule is a ratio of counts with a least and a greatest allowed value. All counts of a text are made
in a few nested projections, without user functions and without a shuffle.

Words are runs of characters other than blanks (U+0020, U+0009 to U+000D). A repeated word is one in a
five-word window that stands twice or more in its text. Windows are compared by a 64-bit hash within
one text.

Defined results: a NULL text counts as empty and fails; ratios over zero words or lines are 0; texts of
any length are taken whole; repeated rows are judged alike; further columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake.llm.shared import whole_text

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Frequent words of English, French, German and Spanish, in lower case.
STOP_WORDS = (
    "a and are as at be by for from has in is it of on or that the this to was with "
    "au avec dans de des du en est et la le les ne pas pour que qui sur un une "
    "auf das dem den der die ein eine im ist mit nicht sich sie und von zu "
    "como con del el es los mi no para por se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """`name` must lie between `least` and `most`; None is no bound. Applies from `words` words on."""

    name: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("n_words", least=10),
    Rule("repeat_ratio", most=0.2),
    Rule("word_length", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.25),
    Rule("shout_ratio", most=0.5),
    Rule("dup_line_ratio", most=0.5),
    Rule("stop_ratio", least=0.01, words=50),
)


def _per(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


RATIOS = {
    "n_words": lambda: F.col("__words"),
    "repeat_ratio": lambda: _per(F.col("__repeats"), F.col("__words")),
    "word_length": lambda: _per(F.col("__chars"), F.col("__words")),
    "symbol_ratio": lambda: _per(F.col("__symbols"), F.col("__words")),
    "shout_ratio": lambda: _per(F.col("__shouts"), F.col("__words")),
    "dup_line_ratio": lambda: _per(F.col("__dup_lines"), F.col("__lines")),
    "stop_ratio": lambda: _per(F.col("__stops"), F.col("__words")),
}


def _count_of(text: Column, characters: str) -> Column:
    """How often the characters stand in the text. Most texts have none, which a search finds fastest."""
    rest = F.length(F.translate(text, characters, ""))
    found = text.rlike(f"[{characters}]")
    return F.when(found, F.length(text) - rest).otherwise(0).cast("long")


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with the counts `__words`, `__chars`, `__symbols`, `__shouts`, `__lines`, `__dup_lines`,
    `__repeats` and `__stops`."""
    text, w = F.col("__text"), F.col("__w")
    last = F.size(w) - WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    )
    with_text = docs.withColumn("__text", whole_text(text_column))
    split = with_text.withColumns({
        "__w": F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""),
        "__l": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    windowed = split.withColumns({
        "__h": F.when(last >= 0, windows).otherwise(F.array().cast("array<bigint>")),
        "__words": F.size(w).cast("long"),
        "__chars": F.length(F.array_join(w, "")).cast("long"),
        "__symbols": _count_of(text, SYMBOLS),
        "__shouts": _count_of(text, "!"),
        "__lines": F.size("__l").cast("long"),
        "__dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "__stops": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long"),
    }).drop("__w", "__l", "__text")
    # Sorting brings equal windows together; only texts that repeat any window get that far.
    sorted_windows = windowed.withColumn(
        "__s",
        F.when(
            F.size(F.array_distinct("__h")) < F.size("__h"),
            F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("__s")
    twice = F.filter(
        s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])
    )
    placed = sorted_windows.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__s", "__h")
    p = F.col("__p")
    covered = F.aggregate(
        F.transform(p, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(at - F.get(p, i - 1), F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    return placed.withColumn("__repeats", F.coalesce(covered, F.lit(0).cast("long"))).drop("__p")


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One condition for the whole table of rules."""
    result = F.lit(True)
    for rule in rules:
        value, fine = RATIOS[rule.name](), F.lit(True)
        if rule.least is not None:
            fine = fine & (value >= rule.least)
        if rule.most is not None:
            fine = fine & (value <= rule.most)
        result = result & (fine | (F.col("__words") < rule.words) if rule.words else fine)
    return result


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """`docs` with the counts of `measures`, `__base_failed` and `__kept`."""
    base_failed = (F.col("__words") < 10) | (100 * F.col("__repeats") > 20 * F.col("__words"))
    return measures(docs, text_column).withColumns(
        {"__base_failed": base_failed, "__kept": ~base_failed & passes(rules)}
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The documents that pass, with their own columns, whatever their names: here they go by number.

    The row number keeps the filter above the projections: below them it would hold each count's whole
    expression once for every use.
    """
    numbered = [f"c{i}" for i in range(len(docs.columns))]
    judged = judge(docs.toDF(*numbered), rules, numbered[docs.columns.index(text_column)]).withColumn("__row", F.monotonically_increasing_id())
    good = judged.filter(F.col("__kept") & (F.col("__row") >= 0))
    return good.select(*[F.col(n).alias(c) for n, c in zip(numbered, docs.columns)])
