"""Quality rules: a threshold table compiled into one Spark projection.

All measures come from built-in functions over each row; nothing is shuffled and no
Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: The most frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be this by are at from "
    "de la le et les des en un du une que est pour dans qui au sur par pas avec "
    "der die und den von zu das mit sich auf für im ist dem nicht ein eine als "
    "el y los se del las por con una no su para es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= value <= high; texts of fewer words than min_words always do."""

    name: str
    value: str
    low: float = float("-inf")
    high: float = float("inf")
    min_words: int = 1

    def sql(self) -> str:
        bounds = [f"{self.value} {op} {x}D" for op, x in ((">=", self.low), ("<=", self.high)) if abs(x) != float("inf")]
        return f"(n_words < {self.min_words} OR ({' AND '.join(bounds)}))"


#: The threshold table. Values are SQL over the measures.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2, 20),
    Rule("symbols_per_word", "n_symbols / n_words", high=0.25),
    Rule("stop_words_per_word", "n_stop_words / n_words", low=0.04, min_words=100),
    Rule("duplicate_lines", "n_dup_lines / n_lines", high=0.5, min_words=100),
    Rule("words_per_line", "n_words / n_lines", low=1.5, min_words=100),
)


def repeat_words(w: Column, k: int = WINDOW) -> Column:
    """How many words stand in a window of k words that the array holds twice or more."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))

    def covered(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = F.transform(
            F.array(by_hash),
            lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])),
        )[0]
        reach = F.transform(F.array(twice), lambda p: F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - x, F.lit(k)))))[0]
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    counted = F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))[0]
    return F.when(F.size(w) <= k, F.lit(0).cast("long")).otherwise(counted)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the measures of each whole text. They are generated rather than
    projected, so that a filter on a verdict doesn't compute them again."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    n = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    row = F.transform(
        F.array(F.struct(words(text).alias("w"), lines.alias("l"))),
        lambda x: F.struct(
            n(F.size(x["w"])).alias("n_words"),
            n(F.length(F.translate(text, SPACE_CHARS, ""))).alias("word_chars"),
            n(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
            n(F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).alias("n_dup_lines"),
            F.transform(F.array(x["w"]), lambda w: repeat_words(w))[0].alias("n_repeat_words"),
            n(F.size(x["l"])).alias("n_lines"),
            n(F.size(F.filter(x["w"], lambda w: F.lower(w).isin(STOP_WORDS)))).alias("n_stop_words"),
        ),
    )
    return docs.select("*", F.inline(row))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict of every document.

    Returns the id column, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lines, n_stop_words and failed_rules. A null or empty text has
    no words and fails the base rules; null ids and repeated rows are kept as they are;
    an empty table gives no rows; other columns of docs are ignored, whatever their names.
    """
    base = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    failed = F.expr("filter(array(" + ", ".join(f"CASE WHEN NOT {r.sql()} THEN '{r.name}' END" for r in rules) + "), x -> x IS NOT NULL)")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured(base, "__text").select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & (F.size(failed) == 0)).alias("kept"), "n_lines", "n_stop_words", failed.alias("failed_rules"),
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of docs that pass, with their own columns only.

    Each row is judged by its own text: null, empty and wordless texts have too few words
    and go; null ids and repeated rows are rows like others; an empty table gives no rows;
    columns of any name stay as they are.
    """
    inner = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text"))
    passed = " AND ".join([f"n_words >= {MIN_WORDS}", f"100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words", *(r.sql() for r in rules)])
    return measured(inner, "__text").filter(passed).select("__row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("failed_rules")


def op3_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    space = r"[ \t\n\x0B\f\r]+"
    verdict = " AND ".join(r.sql().replace("D)", ")").replace("D AND", " AND") for r in RULES)
    return rf"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '{space}'), lambda x: x <> '') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM d),
    g AS (SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
    k AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS n FROM g),
    p AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM k WHERE n > 1),
    q AS (SELECT r, CAST(sum(least(8, coalesce(nxt - i, 8))) AS BIGINT) AS n FROM p GROUP BY r),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(t, '{space}', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                 coalesce(q.n, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
                 CAST(len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words
          FROM w LEFT JOIN q USING (r)),
    b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           (NOT base_failed AND {verdict}) AS kept, n_lines, n_stop_words FROM b
    """
