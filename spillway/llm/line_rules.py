"""Quality rules: line-first cleaning, in DataFrame functions only.

1. Each line is judged on its own (punctuation, navigation, boilerplate, run-on rules).
2. Failing lines are removed.
3. A document that loses more than ``max_lost`` of its word characters is rejected,
   as is one that fails the base rules on its whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .secret_ledger import PEM_BEGIN, PEM_END

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50  # words; percent of words inside repeated 3-word windows
MAX_LOST = 0.5

# Phrases that mark a boilerplate line (lower case).
BOILERPLATE = [
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "sign in", "log in", "subscribe to our newsletter", "click here", "read more", "share this", "skip to content",
    "enable javascript", "is licensed under", "licensed under the", "copyright ©", "powered by",
]
_LETTER = r"[\p{L}\p{M}\p{N}]"
# the phrases as whole words (one that ends in a sign may be followed by anything)
_WHOLE = f"(?<!{_LETTER})(?:" + "|".join(p + (f"(?!{_LETTER})" if p[-1].isalnum() else "") for p in BOILERPLATE) + ")"

# Sentence ends in a line: the usual ones, then those of other scripts (Unicode's Sentence_Terminal, its semicolons and colons,
# ellipsis and shad); Thai and Lao letters count, as these scripts have no mark for it.
ENDS = "[.!?;:。！？]"
OTHER_ENDS = (
    "[\u037e\u0387\u0589\u055c\u055e\u061b\u061d-\u061f\u06d4\u0700-\u070a\u07f9\u0837\u0839\u083d\u083e\u0964\u0965\u0f0d-\u0f12"
    "\u104a\u104b\u1362-\u1368\u166e\u1735\u1736\u17d4-\u17d6\u1802-\u1804\u1808\u1809\u1944\u1945\u1aa8-\u1aab\u1b5a\u1b5b\u1b5e\u1b5f"
    "\u1b7d\u1b7e\u1c3b\u1c3c\u1c7e\u1c7f\u2026\u203c\u203d\u2047-\u2049\u2cf9-\u2cfb\u2e2e\u2e3c\u2e53\u2e54\ua4fe\ua4ff\ua60e\ua60f\ua6f3-\ua6f7"
    "\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d-\uaa5f\uaaf0\uaaf1\uabeb\ufe12\ufe13-\ufe16\ufe52\ufe54-\ufe57\uff0e\uff1a\uff1b\uff61"
    "\U00010a56\U00010a57\U00010f55-\U00010f59\U00010f86-\U00010f89\U00011047\U00011048\U000110be-\U000110c1\U00011141-\U00011143"
    "\U000111c5\U000111c6\U000111cd\U000111de\U000111df\U00011238\U00011239\U0001123b\U0001123c\U000112a9\U0001144b\U0001144c"
    "\U000115c2\U000115c3\U000115c9-\U000115d7\U00011641\U00011642\U0001173c-\U0001173e\U00011944\U00011946\U00011a42\U00011a43"
    "\U00011a9b\U00011a9c\U00011c41\U00011c42\U00011ef7\U00011ef8\U00016a6e\U00016a6f\U00016af5\U00016b37\U00016b38\U00016b44\U00016e98"
    "\U0001bc9f\U0001da88\u0e01-\u0e30\u0e81-\u0eb0]")


def failing_line(line: Column) -> Column:
    """TRUE for a line that a rule removes. Lines without a word are neutral (kept).

    punctuation: at least 6 marks (no letter, digit or space) that make up over 15 % of the
    line's characters; navigation: at least 3 separators ``|``, ``»``, ``•``, ``·`` and one for
    each 4 words or fewer; boilerplate: under 30 words with a listed phrase as whole words; run-on: 40 or
    more words without any ``.``, ``!``, ``?``, ``;``, ``:`` or sentence end of another script. The header and END lines of a private
    key stay, for the secret scan to find the key between them.
    """
    chars = F.length(F.regexp_replace(line, SPACE, ""))
    marks = F.length(F.regexp_replace(line, r"[\p{L}\p{M}\p{N}\s]+", ""))
    words = F.size(F.split(F.trim(F.regexp_replace(line, SPACE, " ")), " "))
    bars = F.length(F.regexp_replace(line, "[^|»•·]+", ""))
    phrase = F.lower(line).rlike("|".join(BOILERPLATE)) & F.lower(line).rlike(_WHOLE)
    run_on = (words >= 40) & ~line.rlike(ENDS) & ~line.rlike(OTHER_ENDS)
    failing = ((marks >= 6) & (marks * 100 > chars * 15)) | ((bars >= 3) & (bars * 4 >= words)) | \
        (phrase & (words < 30)) | run_on
    return failing & ~line.rlike(f"{PEM_BEGIN}|{PEM_END}")


def judge(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` (its columns as one struct ``doc``) with the measures, the cleaned text and the verdict.

    Columns: doc, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines_removed, lost_chars, cleaned, kept.

    Defined cases: a NULL text counts as empty; an empty text has no words, fails the base
    rules and is not kept; repeated rows are judged alike; an empty table gives no rows;
    any further column is carried in ``doc`` untouched, whatever its name. Very long texts stay one
    row: all steps are linear but for one sort of its repeated windows.
    """
    t = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                    F.coalesce(docs[text_col], F.lit("")).alias("t"))
    t = t.select("doc", "t", F.filter(F.split("t", SPACE), lambda w: w != "").alias("w"),
                 F.split("t", "\n").alias("lines"))
    t = t.select(
        "doc", "t", F.size("w").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        F.filter("lines", lambda x: x.rlike(WORD)).alias("full"),
        F.filter("lines", lambda x: ~failing_line(x)).alias("good"), F.size("lines").alias("n_lines"),
        F.expr("""CASE WHEN size(w) < 3 THEN cast(array() AS array<bigint>)
                  ELSE transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END""").alias("h"))
    t = t.select(
        "doc", "n_words", "word_chars", "n_symbols", "h", "n_lines", "good",
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        F.array_join("good", "\n").alias("cleaned"),
        # windows sorted by hash, only where one repeats
        F.expr("""CASE WHEN size(array_distinct(h)) < size(h)
                  THEN sort_array(transform(h, (x, i) -> struct(x AS h, i AS i))) END""").alias("s"))
    t = t.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "good", "cleaned",
        F.expr("""CASE WHEN s IS NULL THEN 0L ELSE cast(size(array_distinct(flatten(transform(
                    filter(s, (x, k) -> (k > 0 AND get(s, k - 1).h = x.h) OR (get(s, k + 1).h <=> x.h)),
                    x -> array(x.i, x.i + 1, x.i + 2))))) AS bigint) END""").alias("n_repeat_words"))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    lost = F.col("word_chars") - F.length(F.regexp_replace("cleaned", SPACE, ""))
    t = t.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                 (F.col("n_lines") - F.size("good")).cast("bigint").alias("n_lines_removed"),
                 lost.cast("bigint").alias("lost_chars"), "cleaned")
    # The row number keeps the optimiser from moving a later filter on these columns below the measures,
    # where it would work them out anew for every element that a lambda visits.
    t = t.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= F.col("word_chars") * max_lost))
    t = t.withColumn("at", F.monotonically_increasing_id())
    return t.withColumn("kept", F.col("kept") & (F.col("at") >= 0)).drop("at")


def keep_clean(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """The kept documents, with their failing lines removed from ``text`` (and n_chars brought in line)."""
    kept = judge(docs, max_lost=max_lost).where("kept")
    columns = []
    for c in docs.columns:
        own = F.col("doc").getField(c)
        if c == "text":
            own = F.col("cleaned")
        elif c == "n_chars":
            own = F.when(own.isNotNull(), F.length("cleaned").cast(docs.schema[c].dataType))
        columns.append(own.alias(c))
    return kept.select(*columns)
