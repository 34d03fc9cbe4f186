"""Line-first quality rules, in DataFrame functions only.

Every line is judged by itself: its last character, its symbols and exclamation marks, navigation and boilerplate
wording. Failing lines are taken out, and a document that loses too much of its text with them is rejected. Before
that, a document with too few words or too much repetition is rejected as it stands.

Everything is a function of one row, so nothing is shuffled and a lost executor costs its unfinished tasks only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.store import set_aside

WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Characters that may end a line, wording of navigation and boilerplate lines.
LINE_ENDS = ".!?:;\"')]}…”’»。！？"
NAVIGATION = ["back to top", "skip to content", "previous page", "next page", "read more", "click here", "log in",
              "sign in", "sign up", "home |", "home >"]
BOILERPLATE = ["lorem ipsum", "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "use cookies", "subscribe to our"]

ENDED = "[" + "".join("\\" + c if c in "]}" else c for c in LINE_ENDS) + r"][\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class Rules:
    """Limits; shares are per cent."""

    least_words: int = 10
    repeated_share: int = 20     # of words in repeated five-word windows, at most
    symbol_share: int = 30       # symbols for each hundred words of a line, at most
    exclaimed_share: int = 30    # exclamation marks for each hundred words of a line, at most
    navigation_words: int = 12   # a line with navigation wording fails up to this length
    lost_share: int = 50         # of the characters in words, at most


def count(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(characters))


def word_characters(text: Column) -> Column:
    return F.length(text) - count(text, r"[\x20\x09-\x0D]")


def line_fails(line: Column, rules: Rules = Rules()) -> Column:
    """Whether a line with words breaks a rule; lines without words never do.

    Cheap tests stand first: words are counted only in lines that hold symbols, marks or navigation wording.
    """
    words = count(line, WORD)
    marks = F.length(line) - F.length(F.replace(line, F.lit("!"), F.lit("")))
    ends = (F.instr(F.lit(LINE_ENDS), F.right(line, F.lit(1))) > 0) | F.rlike(line, F.lit(ENDED))
    return F.rlike(line, F.lit(WORD)) & (
        ~ends | (F.rlike(line, F.lit(SYMBOLS)) & (count(line, SYMBOLS) * 100 > words * rules.symbol_share))
        | (F.contains(line, F.lit("!")) & (marks * 100 > words * rules.exclaimed_share))
        | bound(F.lower(line), lambda low: says(low, BOILERPLATE) | (
            says(low, NAVIGATION) & (words <= rules.navigation_words))))


def says(text: Column, phrases: list[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(p)) for p in phrases])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row."""
    return F.transform(F.array(value), use)[0]


def windows(hashes: Column) -> Column:
    """64-bit hashes of all five-word windows, in order."""
    last = F.size(hashes) - 5
    return F.when(last < 1, F.lit(None)).otherwise(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)])))


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more.

    Windows are sorted by hash, where any hash repeats; equal neighbours are repeats. The words covered follow from
    the sorted starts: each start adds five words, or as many as lie before the next start.
    """
    def starts(ordered: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(ordered, at)["h"] == x["h"], F.lit(False))
        repeats = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.array_sort(F.transform(repeats, lambda x: x["i"]))

    def covered(begun: Column) -> Column:
        each = F.transform(begun, lambda i, k: F.least(F.lit(5), F.coalesce(F.get(begun, k + 1) - i, F.lit(5))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.coalesce(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(True)), F.lit(0)).otherwise(
        bound(bound(F.array_sort(placed), starts), covered)).cast("long")


ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "lost_chars",
         "base_failed", "kept", "clean_text"]


def assess(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents with their figures, verdict and cleaned text.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_failed_lines``,
    ``lost_chars`` (characters of words in failing lines), ``base_failed``, ``kept`` and ``clean_text``. Columns of
    these names that the input already has are replaced. A null text counts as empty and is rejected; its cleaned
    text is empty. A document is rejected if it has too few words, too many repeated words, or loses more than
    ``lost_share`` per cent of its word characters with its failing lines. Repeated rows are judged alike.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = lambda lines: F.aggregate(
        F.transform(lines, word_characters), F.lit(0), lambda a, x: a + x)
    out = docs.drop(*ADDED).select(
        "*",
        F.array_remove(F.split(text, WORD_BREAKS), "").alias("__words"),
        F.split(text, "\n", -1).alias("__lines"),
        word_characters(text).cast("long").alias("word_chars"),
        count(text, SYMBOLS).cast("long").alias("n_symbols"))
    out = out.select("*", F.filter("__lines", lambda line: F.rlike(line, F.lit(WORD))).alias("__spoken"),
                     F.filter("__lines", lambda line: ~line_fails(line, rules)).alias("__good"))
    # bound, so that no optimiser rule can put the arrays' expressions inside the loops over them
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    out = out.select(
        "*", F.size("__words").cast("long").alias("n_words"),
        (F.size("__spoken") - F.size(F.array_distinct("__spoken"))).cast("long").alias("n_dup_lines"),
        bound(hashes, lambda h: bound(windows(h), repeated_words)).alias("n_repeat_words"),
        (F.size("__lines") - F.size("__good")).cast("long").alias("n_failed_lines"),
        (F.col("word_chars") - chars(F.col("__good"))).cast("long").alias("lost_chars"),
        F.array_join("__good", "\n").alias("clean_text"))
    out = out.withColumn("base_failed", (F.col("n_words") < rules.least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeated_share))
    out = out.withColumn("kept", ~F.col("base_failed") & (
        F.col("lost_chars") * 100 <= F.col("word_chars") * rules.lost_share))
    return out.drop("__words", "__lines", "__spoken", "__good")


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The accepted documents with failing lines taken out of ``text``; ``n_chars`` follows where there is one."""
    safe, back = set_aside(docs, ADDED)
    # the row number keeps the filter above the verdict: pushed down it would work out every figure twice
    out = assess(safe, rules).withColumn("__row", F.monotonically_increasing_id()).filter("kept AND __row >= 0")
    changed = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean_text").cast("long")
    return back(out.withColumns(changed))


def figures_sql(rules: Rules = Rules()) -> str:
    """The verdicts of ``assess`` over table documents as DuckDB SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    space = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    blank = "'      '"
    no_space = lambda x: f"regexp_replace({x}, '[\\x20\\x09-\\x0D]+', '', 'g')"
    words = lambda x: f"len(list_filter(regexp_split_to_array({x}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))"
    says = lambda phrases: "(" + " OR ".join(f"contains(lower(line), {quoted(p)})" for p in phrases) + ")"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
  list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM d),
f AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS five
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
again AS (SELECT doc_id, i FROM f QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
r AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
l AS (SELECT doc_id, line, {words('line')} AS n, length({no_space('line')}) AS chars,
    rtrim(translate(line, {space}, {blank})) AS trimmed
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (SELECT *, n > 0 AND (NOT contains({quoted(LINE_ENDS)}, right(trimmed, 1))
    OR 100 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > n * {rules.symbol_share}
    OR 100 * (length(line) - length(replace(line, '!', ''))) > n * {rules.exclaimed_share}
    OR {says(BOILERPLATE)} OR ({says(NAVIGATION)} AND n <= {rules.navigation_words})) AS fails FROM l),
g AS (SELECT doc_id, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost,
    count(CASE WHEN n > 0 THEN 1 END) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS dup FROM j GROUP BY doc_id),
b AS (SELECT doc_id, len(ws) AS n_words, length({no_space('text')}) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
t AS (SELECT b.*, g.dup AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words, g.lost
  FROM b JOIN g USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < {rules.least_words}
    OR 100 * n_repeat_words > {rules.repeated_share} * n_words AS base_failed FROM t)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= {rules.lost_share} * word_chars AS kept
FROM v"""
