"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

``measures`` turns a text into counts with built-in array and string functions; ``verdict`` turns rows of the threshold
table (measure, least, most) into one boolean expression. A ratio whose base is zero passes.

Null and empty texts have no words and fail. Texts of any length are read whole: words and their windows are sorted, not
compared pairwise. Repeated rows are kept; an empty table gives an empty table. Columns of
the input don't clash: measures are fields of one struct under a name of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = {
    "en": "the of and to in a is that it was for on are as with his they at be this have from or had by but not what all were we when your can said there use an each which she do how their if".split(),
    "fr": "le la les de des du un une et est en que qui dans pour sur pas au par avec ce il elle ne se".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "es": "el la los las de del y a en que un una se no con por su para es lo como al".split(),
}

#: (measure, least, most); None: no bound. Ratios are of words unless named otherwise.
THRESHOLDS = [
    ("n_words", 50, 1_000_000),
    ("mean_word_chars", 2.0, 14.0),
    ("symbol_ratio", None, 0.3),
    ("bar_ratio", None, 0.3),
    ("exclaim_ratio", None, 0.4),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.6),
    ("repeat_ratio", None, 0.5),
]


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than the six ASCII white-space ones."""
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def repeat_words(grams: Column) -> Column:
    """Words in three-word windows that occur twice or more, from the window hashes in text order.

    Repeated hashes are found in the sorted array; windows at positions p stand for the words p to p + 2, so the count
    is the sum of min(3, distance to the next such window). Where many hashes repeat, positions come from a sort of
    (hash, position) instead of looking each up.
    """
    ordered = F.sort_array(grams)
    twice = lambda s: F.array_distinct(F.filter(F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull()))
    covered = lambda at: F.when(F.size(at) == 0, 0).otherwise(F.aggregate(F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))), F.lit(0), lambda s, x: s + x))
    few = lambda d: F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(d, g), i)), lambda i: i.isNotNull())
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    # one pass over neighbours: a pair counts if it equals the one before or after
    many = lambda p: F.sort_array(F.array_distinct(F.flatten(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))))
    bind = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  evaluates x once
    return bind(twice(ordered), lambda d: F.when(F.size(d) == 0, 0).when(F.size(d) <= 24, bind(few(d), covered)).otherwise(bind(many(pairs), covered)))


def measures(text: Column) -> Column:
    """A struct of the counts and ratios of one text."""
    text = F.coalesce(text, F.lit(""))
    bind = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    bare = F.translate(text, SPACE, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})

    def counts(w: Column) -> Column:
        n = F.size(w)
        grams = F.when(n >= 3, F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.length(text) - F.length(F.translate(text, "|", ""))).cast("long").alias("n_bars"),
            (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_exclaims"),
            bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            F.size(F.filter(F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r.,;:!?]+"), lambda x: x.isin(stop))).cast("long").alias("n_stop"),
            bind(grams, repeat_words).cast("long").alias("n_repeat_words"),
        )

    return bind(words_of(text), counts)


def ratios(m: Column) -> dict[str, Column]:
    part = lambda a, b: F.when(b > 0, a / b)
    n = m["n_words"]
    return {
        "n_words": n, "mean_word_chars": part(m["word_chars"], n), "symbol_ratio": part(m["n_symbols"], n), "bar_ratio": part(m["n_bars"], n), "exclaim_ratio": part(m["n_exclaims"], n),
        "stop_ratio": part(m["n_stop"], n), "dup_line_ratio": part(m["lines"]["dup"], m["lines"]["n"]), "repeat_ratio": part(m["n_repeat_words"], n),
    }


def verdict(m: Column, thresholds: list[tuple[str, float | None, float | None]]) -> Column:
    """True where every measure is within its bounds."""
    of, out = ratios(m), F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            out = out & (of[name].isNull() | (of[name] >= least))
        if most is not None:
            out = out & (of[name].isNull() | (of[name] <= most))
    return out


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def quality_report(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Counts and verdict of each document."""
    m = F.col("pw_measures")
    return docs.select(F.col("doc_id").cast("long"), measures(F.col("text")).alias("pw_measures")).select(
        "doc_id", m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"), m["lines"]["dup"].alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"),
        m["n_stop"].alias("n_stop"), m["lines"]["n"].alias("n_lines"), base_failed(m).alias("base_failed"), (~base_failed(m) & verdict(m, thresholds)).alias("kept"),
    )


def keep_good(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that pass, with their own columns."""
    m = F.col("pw_measures")
    return docs.withColumn("pw_measures", measures(F.col("text"))).where(~base_failed(m) & verdict(m, thresholds)).drop("pw_measures")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return quality_report(table(spark, sf_dir, "documents"))


_STOP = ", ".join("'" + w + "'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g) WHERE n > 1),
p AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM t) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D.,;:!?]+'), lambda x: x IN ({_STOP})))::BIGINT AS n_stop, len(l)::BIGINT AS n_lines,
    length(text) - length(replace(text, '|', '')) AS n_bars, length(text) - length(replace(text, '!', '')) AS n_exclaims
  FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop, n_lines, base_failed,
  NOT base_failed AND n_words <= 1000000 AND word_chars >= 2.0 * n_words AND word_chars <= 14.0 * n_words AND n_symbols / n_words <= 0.3 AND n_bars / n_words <= 0.3 AND n_exclaims / n_words <= 0.4
    AND n_stop / n_words >= 0.02 AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.6) AND n_repeat_words / n_words <= 0.5 AS kept
FROM b
"""
