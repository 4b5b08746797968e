"""Line-first cleaning: rules for single lines, then documents are judged by what the lines left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.tables import WORDS_SQL, boxed, read, with_field, words_of

BREAK, BREAKS = r"[\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
#: Signs that close a sentence, perhaps before a closing quote or bracket.
CLOSED = r"[.!?:;…][\"'»”’)\]]{0,3}$"
SYMBOL = r"[#*$%&<>]"
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie", "javascript", "lorem ipsum",
    "sign up", "log in to", "licensed under", "released under", "public license",
]
#: A line of so many words or more is prose, whatever phrase it holds.
PROSE_WORDS = 20
WINDOW = 8


def has_word(text):
    return text.rlike(r"[^\x20\x09-\x0D]")


def word_chars(text):
    """Characters of words: all but the six breaks, which are searched for one by one."""
    for sign in BREAKS:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return F.char_length(text)


def has_boilerplate(text):
    low, found = F.lower(text), F.lit(False)
    for phrase in BOILERPLATE:
        found = found | F.contains(low, F.lit(phrase))
    return found


def may_fail_by_symbols(text):
    """Whether some line holds two symbols, or one among few characters: no other line can hold too many."""
    gap, char = r"[\x20\x09\x0B-\x0D]*", r"(?:[^\x20\x09-\x0D][\x20\x09\x0B-\x0D]*){0,2}"
    return text.rlike(SYMBOL) & (text.rlike(f"{SYMBOL}[^\n]*{SYMBOL}") | text.rlike(f"(?:^|\n){gap}{char}{SYMBOL}{gap}{char}(?:\n|$)"))


def line_fails(line, boilerplate, symbols, fewest_words: int = 10):
    """Whether a line is removed: navigation, symbols, capitals alone, no closing sign on a short line, or boilerplate
    on a line that is short enough to be nothing else.

    boilerplate and symbols say for the whole text whether looking for them in its lines is worth while.
    """
    navigation = line.rlike(r"[|»›•].*[|»›•].*[|»›•]")
    unclosed = ~F.substring(F.rtrim(line, F.lit(BREAKS)), -4, 4).rlike(CLOSED) & (F.size(words_of(line)) < fewest_words)
    shouting = ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}") & (F.size(words_of(line)) >= 5)
    full_of_symbols = symbols & (F.regexp_count(line, F.lit(SYMBOL)) * 4 > word_chars(line))
    return unclosed | shouting | navigation | full_of_symbols | (boilerplate & has_boilerplate(line) & (F.size(words_of(line)) < PROSE_WORDS))


def clean_lines(docs: DataFrame, most_lost: float = 0.5) -> DataFrame:
    """docs with cleaned (the text without failing lines) and kept (false where too large a share of text was lost).

    Lines are parts between `\\n`; empty ones stay. The share counts characters of words. A null text
    stays null, counts as empty and is not kept; so is a text without words. Very long texts are judged whole; rows are judged
    alone, repeated ones alike. Columns of docs named cleaned or kept are replaced; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn("_boilerplate", has_boilerplate(text)).withColumn("_symbols", may_fail_by_symbols(text))
    marked = marked.withColumn("_lines", F.split(text, "\n", -1))
    usual = F.filter("_lines", lambda line: ~has_word(line) | ~line_fails(line, F.lit(False), F.lit(False)))
    odd = F.filter("_lines", lambda line: ~has_word(line) | ~line_fails(line, F.col("_boilerplate"), F.col("_symbols")))
    marked = marked.withColumn("_left", F.when(F.col("_boilerplate") | F.col("_symbols"), odd).otherwise(usual))
    whole = F.size("_left") == F.size("_lines")
    cleaned = F.when(whole, F.col("text")).when(F.col("text").isNotNull(), F.array_join("_left", "\n"))
    rest = F.when(whole, has_word(text)).otherwise(has_word(text) & (word_chars(F.array_join("_left", "\n")) >= word_chars(text) * (1 - most_lost)))
    return marked.withColumn("cleaned", cleaned).withColumn("kept", rest).drop("_boilerplate", "_symbols", "_lines", "_left")


def window_hashes(hashes):
    """A hash for each window of eight words, from an array of one long for each word: halves of halves, joined."""

    def joined(x, step):
        n = F.greatest(F.size(x) - step, F.lit(0))
        return F.zip_with(F.slice(x, 1, n), F.slice(x, step + 1, n), lambda a, b: F.xxhash64(a, b))

    return joined(joined(joined(hashes, 1), 2), 4)


def document_stats(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null text counts as empty. Rows are judged alone, so repeated rows and ids change nothing. Columns of docs with these
    names are replaced; an empty table gives no rows; very long texts are judged whole. Only texts
    that have fewer distinct windows than windows are looked at closely: windows are sorted by hash, and those
    equal to a neighbour give the places where a repeat starts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), has_word)
    sized = docs.withColumn("_words", F.transform(words_of(text), lambda w: F.xxhash64(w))).withColumn("_lines", lines)
    sized = sized.withColumn("_windows", window_hashes(F.col("_words")))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    sized = sized.withColumn("_order", F.when(again, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    starts = F.array_sort(
        F.filter(
            F.transform(
                "_order",
                lambda x, k: F.when(
                    F.coalesce(x["h"] == F.get("_order", k + 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_order", k - 1)["h"], F.lit(False)),
                    x["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )
    )
    sized = sized.withColumn("_starts", starts)
    covered = F.aggregate(
        F.transform("_starts", lambda i, k: F.least(F.coalesce(F.get("_starts", k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    stats = (
        sized.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", word_chars(text).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).drop("_words", "_lines", "_windows", "_order", "_starts")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass both, with cleaned text, in the columns of docs; n_chars follows where there is one.

    Null and empty texts and texts without words are rejected, as all with fewer than 20 words. Very long texts are judged whole. Rows are judged alone, so repeated rows
    and ids each stay or go. All other columns stay as they are, whatever their names; an empty table gives no rows.
    """
    judged = clean_lines(document_stats(boxed(docs).withColumn("text", F.col("row.text"))))
    # a filter on row numbers stays above the rules; pushed below, it would work them out again inside their own loops
    judged = judged.withColumn("_row", F.monotonically_increasing_id()).where(~F.col("base_failed") & F.col("kept") & (F.col("_row") >= 0))
    row = with_field(docs, F.col("row"), "text", F.col("cleaned"))
    if "n_chars" in docs.columns:
        changed = ~F.col("cleaned").eqNullSafe(F.col("text"))
        row = with_field(docs, row, "n_chars", F.when(changed, F.char_length("cleaned")).otherwise(F.col("row.n_chars")))
    return judged.select(row.alias("row")).select("row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(document_stats(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("kept")).alias("kept"),
    )


def _line_fails_sql() -> str:
    """line_fails() for a line l with words in ws, in DuckDB; its dot takes other line breaks than Java's, so classes stand for it."""
    any_, end = r"[^\n\r\x{85}\x{2028}\x{2029}]*", r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
    bar = "[|»›•]"
    closed = CLOSED.removesuffix("$").replace("'", "''") + end
    phrases = " OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    return rf"""(NOT regexp_matches(right(rtrim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 4), '{closed}') AND len(ws) < 10)
    OR (NOT regexp_matches(l, '\p{{Ll}}') AND regexp_matches(l, '\p{{Lu}}') AND len(ws) >= 5) OR regexp_matches(l, '{bar}{any_}{bar}{any_}{bar}')
    OR len(regexp_extract_all(l, '{SYMBOL}')) * 4 > length(regexp_replace(l, '{BREAK}', '', 'g')) OR (({phrases}) AND len(ws) < {PROSE_WORDS})"""


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL.format(text="text")} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d) t),
again AS (SELECT doc_id, s FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows JOIN again USING (doc_id, s), range(0, {WINDOW}) r(k) GROUP BY 1),
lines AS (SELECT doc_id, l, {WORDS_SQL.format(text="l")} AS ws, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM d) t),
judged AS (SELECT doc_id, l, len(ws) > 0 AS worded, len(ws) = 0 OR NOT ({_line_fails_sql()}) AS stays FROM lines),
per AS (SELECT doc_id, count(*) FILTER (WHERE worded) - count(DISTINCT l) FILTER (WHERE worded) AS n_dup_lines, bool_and(stays) AS whole,
  coalesce(sum(length(regexp_replace(l, '{BREAK}', '', 'g'))) FILTER (WHERE stays), 0) AS chars_left FROM judged GROUP BY 1),
stats AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '{BREAK}', '', 'g')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, len(ws) < 20 OR 100 * coalesce(n, 0) > 30 * len(ws) AS base_failed, whole, chars_left FROM d JOIN per USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND n_words > 0 AND (whole OR chars_left >= word_chars * 0.5) AS kept FROM stats"""
