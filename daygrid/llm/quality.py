"""Quality rules: line-first cleaning (native).

Every line is judged on its own first: navigation (few words and no sentence
end, or menu separators), boilerplate (fixed phrases that make up a fifth of it) and punctuation (no word
characters, or mostly symbols). Failing lines are removed; a document that
loses more than ``max_lost`` of its words is then rejected. Document-level base
measures (symbols, duplicate lines, repeated three-word windows) are computed
beside it.

Defined results: a null text counts as empty (no words: base fails); blank
lines are neither judged nor counted; equal rows get equal results; extra
columns of the input pass through ``line_clean`` untouched unless they bear the
name of a result column, which is then replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, let, ranges, words

# Phrases of page furniture, matched in lower case as whole words.
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "click here", "read more", "sign in", "log in", "sign up", "subscribe to our", "share this",
    "enable javascript", "lorem ipsum", "back to top", "skip to content", "follow us",
)
#: A line is boilerplate if one in so many of its characters belongs to such a phrase.
BOILERPLATE_SHARE = 5
#: A line of at most so many words without a sentence end is navigation.
NAV_WORDS = 2
#: A line is navigation with so many menu separators, and one for every three words.
NAV_SEPARATORS = 3
#: The symbols of the base measure.
SYMBOLS = "#*$%&|<>"


def line_failures(line: Column, nav_words: int = NAV_WORDS) -> Column:
    """True if a non-blank line fails a rule."""
    n = F.size(words(line))
    ends = F.rtrim(line).rlike(r"""[.!?:;…。！？]["'”’»)\]#*$%&]*$""")
    bars = F.char_length(line) - F.char_length(F.translate(line, "|>»•·", ""))
    visible = F.char_length(F.regexp_replace(line, f"[{SPACE_CLASS}]", ""))
    letters = F.char_length(F.regexp_replace(line, r"[^\p{L}\p{N}]", ""))
    navigation = ((n <= nav_words) & ~ends) | ((bars >= NAV_SEPARATORS) & (bars * 3 >= n))
    phrases = r"(?<![a-z0-9_])(" + "|".join(BOILERPLATE) + ")(?![a-z0-9_])"
    low = F.lower(line)
    theirs = F.char_length(low) - F.char_length(F.regexp_replace(low, phrases, ""))
    boilerplate = low.rlike(phrases) & (theirs * BOILERPLATE_SHARE >= F.char_length(F.trim(low)))
    punctuation = letters * 2 < visible
    return navigation | boilerplate | punctuation


def repeated_window_words(w: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Windows are compared by their 64-bit hash. Without a repeated hash the
    answer is 0; otherwise (hash, position) pairs are sorted, positions whose
    neighbour has the same hash are kept, and each contributes the words up to
    the next kept position, three at most.
    """
    grams = F.transform(ranges(n - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(
            s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]).eqNullSafe(True) | ((i > 0) & (x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"]))
        )
        places = let(pairs, lambda s: F.sort_array(F.transform(again(s), lambda x: x["i"])))
        counted = let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("int"), lambda a, b: a + b
            ),
        )
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(counted)

    return let(grams, covered)


def line_clean(docs: DataFrame, max_lost: float = 0.5, nav_words: int = NAV_WORDS) -> DataFrame:
    """``docs`` with ``clean_text`` and the measures and verdicts named below.

    ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` base measures,
    ``base_failed``; ``n_lines n_bad_lines lost_words`` of the line rules and
    ``kept`` (base passed and at most ``max_lost`` of the words lost).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    step = docs.withColumns(
        {
            "_w": words(F.col("text")),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")),
            "word_chars": F.char_length(F.replace(flat, F.lit(" "), F.lit(""))).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_window_words(F.col("_w"), F.size("_w")).cast("long"),
            "_good": F.filter("_lines", lambda x: ~line_failures(x, nav_words)),
        }
    )
    step = step.withColumns(
        {
            "clean_text": F.concat_ws("\n", "_good"),
            "n_lines": F.size("_lines").cast("long"),
            "n_bad_lines": (F.size("_lines") - F.size("_good")).cast("long"),
            "lost_words": F.col("n_words") - F.size(words(F.concat_ws("\n", "_good"))),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    verdict = F.col("lost_words") <= F.col("n_words") * F.lit(max_lost)
    return step.withColumn("kept", ~F.col("base_failed") & verdict).drop("_w", "_lines", "_good")


RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines", "lost_words")


def op4(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return line_clean(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*RESULT)


def _sql() -> str:
    ws = " \t\n\x0b\x0c\r"
    flat = f"translate(t, '{ws[1:]}', '     ')"
    count = lambda x: f"len(list_filter(string_split(translate({x}, '{ws[1:]}', '     '), ' '), lambda w: w <> ''))"
    phrases = r"\b(" + "|".join(BOILERPLATE) + r")\b"
    bars = "(length(x) - length(translate(x, '|>»•·', '')))"
    ends = r"""regexp_matches(rtrim(x), '[.!?:;…。！？]["''”’»)\]#*$%&]*$')"""
    bad = (
        f"(({count('x')} <= {NAV_WORDS} AND NOT {ends}) OR ({bars} >= {NAV_SEPARATORS} AND {bars} * 3 >= {count('x')})"
        f" OR (regexp_matches(lower(x), '{phrases}') AND (length(lower(x)) - length(regexp_replace(lower(x), '{phrases}', '', 'g'))) * {BOILERPLATE_SHARE} >= length(trim(lower(x))))"
        r" OR length(regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')) * 2 < length(translate(x, '" + ws + "', '')))"
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, list_filter(string_split({flat}, ' '), lambda w: w <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: length(translate(x, '{ws}', '')) > 0) AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM s WHERE len(w) >= 3),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k WHERE n > 1) GROUP BY doc_id),
f AS (SELECT doc_id, t, w, l, list_filter(l, lambda x: NOT {bad}) AS good FROM s),
m AS (SELECT f.doc_id, len(w)::BIGINT AS n_words, length(translate(t, '{ws}', ''))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(l)::BIGINT AS n_lines, (len(l) - len(good))::BIGINT AS n_bad_lines,
             (len(w) - {count("coalesce(array_to_string(good, ' '), '')")})::BIGINT AS lost_words
      FROM f LEFT JOIN c USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_words <= n_words * 0.5 AS kept FROM m
"""


SQL = _sql()
