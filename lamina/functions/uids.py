"""Object ids: validity, and the object that a damaged or decorated uid spells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions.text import INVISIBLE

VALID = r"^([0-9a-f]{32}|[0-9a-f]{64})\z"
_WIDE = "".join(map(chr, [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]))
_NARROW = "0123456789" + "abcdefghijklmnopqrstuvwxyz" * 2
#: A word with a letter that is no hex digit: wrapping such as a folder, a prefix or a file ending.
_WORD = r"[\p{L}\p{N}]*[^\P{L}a-f][\p{L}\p{N}]*"


def is_valid_uid(c: Column) -> Column:
    return c.rlike(VALID)


def object_of(c: Column) -> Column:
    """The 32 or 64 lowercase hex digits that a uid spells, else null.

    Left aside are letter case, full character width, blanks, invisible characters, separators between the
    digits and wrapping: brackets, quotes, and words that hold a letter beyond f (folders, prefixes, file
    endings). Null, empty, shorter and longer values have no object.
    """
    plain = F.lower(F.translate(F.regexp_replace(c, INVISIBLE, ""), _WIDE, _NARROW))
    digits = F.regexp_replace(F.regexp_replace(plain, _WORD, " "), "[^0-9a-f]", "")
    return F.when(c.rlike(VALID), c).when(digits.rlike(VALID), digits)


def object_sql(c: str) -> str:
    """object_of for the check, said another way: split into words, drop those with a letter beyond f, join the hex digits of the rest."""
    wide = f"array_to_string(list_transform(string_split({c}, ''), lambda x: CASE WHEN unicode(x) BETWEEN 65281 AND 65374 THEN chr(CAST(unicode(x) - 65248 AS integer)) ELSE x END), '')"
    words = f"regexp_split_to_array(lower(regexp_replace({wide}, '{INVISIBLE}', '', 'g')), '[^\\p{{L}}\\p{{N}}]+')"
    kept = f"list_filter({words}, lambda x: NOT regexp_matches(regexp_replace(x, '[a-f]', '', 'g'), '\\p{{L}}'))"
    digits = f"regexp_replace(array_to_string({kept}, ''), '[^0-9a-f]', '', 'g')"
    return f"CASE WHEN length({digits}) IN (32, 64) THEN {digits} END"
