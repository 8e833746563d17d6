"""Operator 10, quality rules: a short-circuit cascade ordered by measured rejection per cost.

Every rule is a DataFrame expression over the text. On a bounded sample the cascade measures
what each rule costs and how often it rejects, and then tests the rules in the order of
rejections per second. The order only saves work: a row is kept if no rule rejects it.

Defined results: a NULL text is an empty text (no words, so the base rule rejects it); repeated
rows and equal ids are judged row by row; an empty table gives an empty table; other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import BLANKS, documents, query, words_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Rows on which costs and selectivities are measured; a bound for the sample, not for the result.
SAMPLE_ROWS = 1_000
#: Longest text of the sample.
SAMPLE_CHARS = 20_000
#: Runs of every rule on the sample, whose fastest counts.
REPEATS = 3


#: Gives the column of a measure by its name, computed beforehand or from the text.
Measures = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over the measures of a text, under which the text is rejected."""

    name: str
    rejects: Callable[[Measures], Column]


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(_without(text, characters))


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(_without(text, BLANKS)).cast("bigint")


def symbols(text: Column) -> Column:
    return _count(text, SYMBOLS).cast("bigint")


def word_lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return F.transform(F.array(word_lines(text)), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("bigint")


#: Texts of up to 2^PLACE_BITS words have the place of a window packed beside 50 bits of its hash.
PLACE_BITS = 14


def with_repeated_words(df: DataFrame, words: str, out: str = "n_repeat_words") -> DataFrame:
    """Add the count of words that lie in a window of three words found twice or more in the text.

    Windows are hashed; where two are equal, they are sorted together with their places, so equal
    ones are neighbours: n log n steps for n words, whatever repeats. Short texts sort packed
    numbers, longer ones pairs. Each step is a column of its own, so that nothing inside a lambda
    is computed again for every element. Names starting with ``_rw`` are used on the way.
    """
    code, gram, ordered, place = (F.col(f"_rw_{name}") for name in ("code", "gram", "ordered", "place"))
    starts = F.slice(code, 1, F.greatest(F.size(code) - 2, F.lit(0)))
    grams = F.transform(starts, lambda c, i: F.xxhash64(c, F.get(code, i + 1), F.get(code, i + 2)))
    again = F.size(F.array_distinct(gram)) < F.size(gram)
    short = F.size(gram) <= 1 << PLACE_BITS

    def packed(g: Column, i: Column) -> Column:
        return g.bitwiseAND(F.lit(-(1 << PLACE_BITS))).bitwiseOR(i.cast("bigint"))

    def twins(values: Column, key: Callable[[Column], Column]) -> Column:
        def has_twin(x: Column, i: Column) -> Column:
            return F.coalesce(key(F.get(values, i + 1)) == key(x), F.lit(False)) | F.coalesce(key(F.get(values, i - 1)) == key(x), F.lit(False))

        return F.filter(values, has_twin)

    pairs, long_ordered = F.transform(gram, lambda g, i: F.struct(g.alias("h"), i.alias("p"))), F.col("_rw_pairs")
    places = F.when(
        ordered.isNotNull(),
        F.sort_array(F.transform(twins(ordered, lambda x: F.shiftright(x, PLACE_BITS)), lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))),
    ).otherwise(F.sort_array(F.transform(twins(long_ordered, lambda x: x["h"]), lambda x: x["p"])))
    widths = F.transform(place, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(place, i + 1) - p, F.lit(3))))
    covered = F.coalesce(F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, w: total + w), F.lit(0).cast("bigint"))
    df = df.withColumn("_rw_code", F.transform(words, lambda w: F.xxhash64(w))).withColumn("_rw_gram", grams)
    df = df.withColumns({
        "_rw_ordered": F.when(again & short, F.sort_array(F.transform(gram, packed))),
        "_rw_pairs": F.when(again & ~short, F.sort_array(pairs)),
    })
    return df.withColumn("_rw_place", places).withColumn(out, covered).drop("_rw_code", "_rw_gram", "_rw_ordered", "_rw_pairs", "_rw_place")


#: Every measure as an expression over a text that is not NULL.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: F.size(words_of(text)).cast("bigint"),
    "word_chars": word_chars,
    "n_symbols": symbols,
    "n_lines": lambda text: F.size(word_lines(text)).cast("bigint"),
    "n_dup_lines": repeated_lines,
    "has_letter": lambda text: text.rlike(r"\p{L}"),
    "n_letters": lambda text: F.regexp_count(text, F.lit(r"\p{L}")).cast("bigint"),
    "longest_word": lambda text: F.coalesce(F.array_max(F.transform(words_of(text), F.length)), F.lit(0)).cast("bigint"),
}

#: Lenient limits: prose, lists and tables pass, symbol noise and boilerplate do not.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", lambda m: ~(m("word_chars") / F.greatest(m("n_words"), F.lit(1))).between(2.0, 15.0)),
    Rule("symbol_share", lambda m: m("n_symbols") > m("n_words")),
    Rule("duplicate_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("no_letters", lambda m: ~m("has_letter")),
    Rule("letter_share", lambda m: 100 * m("n_letters") < 25 * m("word_chars")),
    Rule("endless_word", lambda m: m("longest_word") > 1000),
)


def measures(text: Column, ready: Sequence[str] = ()) -> Measures:
    """Measures by name: columns of that name where ``ready``, else computed from ``text``."""
    return lambda name: F.col(name) if name in ready else MEASURES[name](text)


def measure(df: DataFrame, text: str, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Per rule (seconds per row, share of rows that it rejects) on at most ``sample_rows`` rows.

    A rule's cost is the fastest of REPEATS runs less that of a rule without work, so the fixed cost of a job does not
    count; all rules run on as many copies of the sample as make about a megabyte. The sample is the head of the table: ``limit`` with a collect reads a few blocks only and moves
    at most ``sample_rows`` texts, none longer than SAMPLE_CHARS, to the driver. It steers the order
    of the rules and cannot change a verdict.
    """
    spark = df.sparkSession
    value = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = df.select(value).where(F.length("text") <= SAMPLE_CHARS).limit(sample_rows).collect()
    copies = max(1, min(64, (1 << 20) // max(1, sum(len(row.text) for row in rows))))
    sample = spark.createDataFrame(rows, "text string").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    count = max(1, len(rows) * copies)

    def run(condition: Column) -> tuple[float, int]:
        """Fastest run, and rows for which the condition holds."""
        asked, times, rejected = sample.agg(F.coalesce(F.sum(condition.cast("int")), F.lit(0))), [], 0
        for _ in range(REPEATS):
            start = time.perf_counter()
            rejected = asked.first()[0]
            times.append(time.perf_counter() - start)
        return min(times), rejected

    idle, _ = run(F.length("text") < 0)
    found = {}
    for rule in rules:
        seconds, rejected = run(rule.rejects(measures(F.col("text"))))
        found[rule.name] = (max(0.0, seconds - idle) / count, rejected / count)
    return found


def cascade_order(rules: Sequence[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per second, best first; ties by name."""
    return sorted(rules, key=lambda rule: (-measured[rule.name][1] / max(measured[rule.name][0], 1e-9), rule.name))


def first_rejection(of: Measures, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, NULL if none does; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(of), F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_cascade(
    df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = DEFAULT_RULES,
    sample_rows: int = SAMPLE_ROWS, ready: Sequence[str] = (), unless: Column | None = None,
) -> DataFrame:
    """Columns of ``keep``, ``rejected_by`` (NULL if kept) and ``kept``.

    ``ready`` names measures that ``df`` already holds as columns, for example because the
    caller reports them; the others are computed from the text, for the rows where the cascade gets to them.
    Rows for which ``unless`` holds are rejected by ``base`` and enter no rule.
    """
    ordered = cascade_order(rules, measure(df, text, rules, sample_rows))
    of = measures(F.coalesce(F.col(text), F.lit("")), ready)
    verdict = first_rejection(of, ordered)
    if unless is not None:
        verdict = F.when(unless, F.lit("base")).otherwise(verdict)
    return df.select(*keep, verdict.alias("rejected_by")).withColumn("kept", F.col("rejected_by").isNull())


OP10_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
i AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 1, 1))) AS i, words FROM w),
g AS (SELECT doc_id, i, concat_ws(chr(32), words[i], words[i + 1], words[i + 2]) AS gram FROM i),
r AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
p AS (SELECT g.doc_id, unnest([i, i + 1, i + 2]) AS p FROM g JOIN r ON r.doc_id = g.doc_id AND r.gram = g.gram),
n AS (SELECT doc_id, count(DISTINCT p) AS n FROM p GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines, coalesce(n.n, 0)::BIGINT AS n_repeat_words,
  regexp_matches(text, '\p{L}') AS letters, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
  coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS longest_word
  FROM w LEFT JOIN n ON n.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 15 AND n_symbols <= n_words AND n_dup_lines <= 0.5 * n_lines
  AND letters AND 100 * n_letters >= 25 * word_chars AND longest_word <= 1000 AS kept FROM b"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base verdict and the verdict of the cascade for every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    reported = documents(spark, folder).select("doc_id", "text", words_of(text).alias("_words"))
    reported = reported.select("*", F.size("_words").cast("bigint").alias("n_words"), word_chars(text).alias("word_chars"), symbols(text).alias("n_symbols"))
    reported = reported.withColumn("_lines", word_lines(text)).withColumns(
        {"n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"), "n_lines": F.size("_lines").cast("bigint")}
    )
    reported = with_repeated_words(reported, "_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = quality_cascade(reported, ["doc_id", *counts], ready=[*counts, "n_lines"], unless=failed)
    return judged.select("doc_id", *counts, failed.alias("base_failed"), "kept")
