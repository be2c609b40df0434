"""String predicates shared by the operators, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand in for a missing value, in lower case.
STAND_INS = ["empty", "missing", "n.a.", "n/a", "na", "nan", "nil", "no caption", "no data", "no error", "no family", "no value", "none", "not available", "null", "tba", "tbd", "todo", "undefined", "unknown", "untitled"]

#: Code points that show nothing: format characters, combining joiners, variation selectors, fillers.
INVISIBLE = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}]"
#: Blanks: separators and control characters.
BLANKS = r"[\p{Z}\p{Cc}\x{2800}]"



def _any_of(words: list[str]) -> str:
    return "^(" + "|".join(w.replace(".", r"\.") for w in words) + r")\z"


def _more_than(words: list[str]) -> str:
    """More letters and digits than the longest word has: no stand-in, whatever stands between them."""
    return r"^(?:[^\p{L}\p{N}]*+[\p{L}\p{N}&&[^\x{115F}\x{1160}\x{17B4}\x{17B5}\x{3164}\x{FFA0}]]){" + str(max(map(len, words), default=0) + 1) + "}"


def bare(c: Column) -> Column:
    """Lower case, without invisible characters, runs of blanks as one space, no blanks or brackets around."""
    s = F.lower(F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), BLANKS + "+", " "))
    return F.regexp_replace(s, r"^[ \[\](){}<>\"']+|[ \[\](){}<>\"']+\z", "")


def is_blank(c: Column) -> Column:
    """Nothing to see: empty, or blanks and invisible characters only. Null for null."""
    return F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), BLANKS, "") == ""


def is_stand_in(c: Column, words: list[str] = STAND_INS) -> Column:
    """A word for a missing value, or no letter and no digit at all (blank included). Null for null."""
    return bare(c).rlike(_any_of(words)) | ~c.rlike(r"[\p{L}\p{N}]")


def is_real(c: Column, words: list[str] = STAND_INS) -> Column:
    """Neither null nor blank nor a stand-in for a missing value. Never null. Texts with enough letters are settled at the first of them."""
    return F.coalesce(F.when(c.rlike(_more_than(words)), True).otherwise(~is_stand_in(c, words)), F.lit(False))


def real_sql(c: str) -> str:
    """is_real for the check, said another way: the words of the text, trimmed, are not in the list and hold a letter or digit."""
    words = f"list_filter(regexp_split_to_array(regexp_replace(lower({c}), '{INVISIBLE}', '', 'g'), '{BLANKS}+'), lambda x: x <> '')"
    listed = ", ".join(f"'{w}'" for w in STAND_INS)
    around = " []<>(){}\"''"
    return f"({c} IS NOT NULL AND regexp_matches({c}, '[\\p{{L}}\\p{{N}}]') AND trim(array_to_string({words}, ' '), '{around}') NOT IN ({listed}))"
