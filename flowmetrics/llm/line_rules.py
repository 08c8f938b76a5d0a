"""Line-first cleaning, in DataFrame operations only.

Each line with a word is judged on its own, failing lines are removed, and a
document that loses more than half of its words with them is rejected:

* punctuation: a line passes if it ends in a closing mark and carries fewer
  runs of doubled marks and symbols than half its words;
* navigation: a line fails if a fifth or more of its words are bare
  separators (``|``, ``>``, ``»``, ``·``), or if it has at most four words
  and one of the fixed menu phrases;
* boilerplate: a line fails if it holds one of the fixed phrases.

Everything is computed inside the row from arrays of its words and lines: no
shuffle, so neither hot sources nor groups of copies matter. Windows of five
words are compared by 64-bit hash within one document.

Defined results: a null text counts as none (all counts 0, not kept, because
it has fewer than 10 words). Repeated rows give repeated rows. Only the text
is read; other columns ride along in ``clean_lines`` and are not read in
``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATOR_BYTES, SEPARATORS, WORD, let, text_or_empty, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
# Closing marks, bare separators, menu phrases, boilerplate phrases.
CLOSING = "[.!?:;…\"'”’»)\\]]"
CLUTTER = "[#*$%&|<>!?]{2,}"
BARE = "[|>»·]"
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "next", "previous", "about us",
        "contact us", "site map", "search", "read more", "back to top")
BOILERPLATE = ("all rights reserved", "cookie policy", "use of cookies", "accept cookies", "privacy policy",
               "terms of use", "terms of service", "enable javascript", "subscribe to our newsletter",
               "click here to", "lorem ipsum", "powered by")
MENU_PATTERN = f"(?i)(^|[{SEPARATOR_BYTES}])({'|'.join(MENU)})([.:!?]?)([{SEPARATOR_BYTES}]|$)"
BOILERPLATE_PATTERN = f"(?i)({'|'.join(BOILERPLATE)})"
BARE_PATTERN = f"(^|[{SEPARATOR_BYTES}]){BARE}+($|[{SEPARATOR_BYTES}])"
END_PATTERN = f"{CLOSING}[{SEPARATOR_BYTES}]*$"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _bare_words(line: Column) -> Column:
    # two neighbouring bare words share a separator, so the separators are doubled first
    return _count(F.regexp_replace(line, f"[{SEPARATOR_BYTES}]", "  "), BARE_PATTERN)


def line_fails(line: Column, n_words: Column) -> Column:
    """Verdict on a line with ``n_words`` > 0 words."""
    punctuation = ~line.rlike(END_PATTERN) | (_count(line, CLUTTER) * 2 >= n_words)
    navigation = (_bare_words(line) * 5 >= n_words) | ((n_words <= 4) & line.rlike(MENU_PATTERN))
    return punctuation | navigation | line.rlike(BOILERPLATE_PATTERN)


def _word_count(text: Column) -> Column:
    return _count(text, WORD + "+")


def lost_words(lines: Column) -> Column:
    """Words in failing lines."""
    def lost(line):
        return let(_word_count(line), lambda n: F.when((n > 0) & line_fails(line, n), n).otherwise(F.lit(0).cast("long")))
    return F.aggregate(F.transform(lines, lost), F.lit(0).cast("long"), lambda a, x: a + x)


def kept_lines(lines: Column) -> Column:
    """Lines without the failing ones; lines without a word stay."""
    return F.filter(lines, lambda line: ~let(_word_count(line), lambda n: (n > 0) & line_fails(line, n)))


def repeat_words(words: Column) -> Column:
    """Words inside windows of five that are found twice or more in ``words``."""
    zero = F.lit(0).cast("long")

    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s):
            same = lambda x, y: F.coalesce(x.getField("h") == y.getField("h"), F.lit(False))
            twins = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            starts = F.sort_array(F.transform(twins, lambda x: x.getField("i")))
            return let(starts, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                zero, lambda a, x: a + x))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(let(ordered, repeated))

    def of(w):
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                             lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
        return F.when(F.size(w) <= WINDOW, zero).otherwise(let(hashes, covered))
    return let(words, of)


def measures(text: Column) -> list[Column]:
    words = words_of(text)

    def dup_lines(lines):
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return [_word_count(text).alias("n_words"),
            F.char_length(F.regexp_replace(text, SEPARATORS, "")).cast("long").alias("word_chars"),
            _count(text, SYMBOLS).alias("n_symbols"),
            let(with_word, dup_lines).alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
            let(F.split(text, "\n"), lost_words).alias("n_lost_words")]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document."""
    m = docs.select("doc_id", *measures(text_or_empty()))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return (m.withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("n_lost_words") * 100 <= F.col("n_words") * MAX_LOST_PERCENT)))


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with failing lines removed from ``text``."""
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), F.array_join(
        let(F.split(F.col("text"), "\n"), kept_lines), "\n")))
