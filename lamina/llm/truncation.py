"""Texts cut off by field limits or in transfer.

A stack automaton reads the signs of each text: brackets, typed quotes of several languages, elements of markup and
code fences are pushed and popped; escapes, characters and tags broken at the end and marks of omission are its
final states. What is left open is cut. What merely ends without a terminator is held against its source first
(where nearly every text has one, its absence is a cut), then against the corpus: how often the last word, after
the word before it, is followed by a gap (comma, stop, end of text) elsewhere; ends without a stop count only from
other sources, so that a source cannot vouch for its own cuts. Last, lengths at which a source piles up unfinished
texts, and ranges of lengths that a limit at whole words leaves, are its limits; there, a text needs a terminator or
a closing phrase.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.text import is_real
from lamina.session import fits, settled

DONE, OPEN, CUT = 0, 1, 2

#: Brackets and what closes them, quotes that open and the signs that close each, stops, marks of omission at the end.
BRACKETS = {")": "(", "]": "[", "}": "{", "」": "「", "』": "『", "）": "（", "】": "【"}
QUOTES = {"„": "“”\"", "“": "”\"", "”": "”", "«": "»", "»": "«", "‹": "›", "›": "‹", "‚": "‘’", "‘": "’", '"': '"'}
STOPS = ".!?。！？"
CLOSERS = set(BRACKETS) | {q for c in QUOTES.values() for q in c}
OMITTED = re.compile(r"(?:…|\.\.\.?|\[(?:…|\.\.\.|truncated|cut)\]|\((?:…|\.\.\.)\)|<(?:truncated|cut)>)\s*\Z", re.I)
#: Elements that must be ended; others (paragraphs, list items, line breaks) end by themselves.
ENDED = frozenset("a abbr article aside b big blockquote body button cite code del details dfn div em figcaption figure font footer form h1 h2 h3 h4 h5 h6 header html i ins kbd label main mark nav ol pre q s samp script section select small span strong style sub summary sup table textarea title u ul var".split())
_TAG = r"""<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s+[A-Za-z_:@][\w:.@-]*(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=]+))?)*\s*(/?)>"""
#: A tag that never ends, an entity or escape that breaks off, half a character, a joiner with nothing to join.
BROKEN_END = re.compile(
    r"(?:[\ufffd\ud800-\udfff]+|\u200d|\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?|U[0-9a-fA-F]{0,7})?|&(?:a|am|amp|ap|apo|apos|lt?|gt?|q|qu|quo|quot|n|nb|nbs|nbsp|#[0-9]{0,6}|#x[0-9A-Fa-f]{0,5})?"
    r"|</?[A-Za-z][A-Za-z0-9]*\s*|<[A-Za-z][A-Za-z0-9]*\s+[A-Za-z_:@][\w:.@-]*\s*=[^<>]*|â€|ðŸ.?|(?<=[a-z])[ÃÂ])\Z"
)
#: The signs the automaton reads; faces and other signs between them are none.
SIGNS = re.compile(_TAG + r"""|```|(?<!\S)[:;=][-'^o]?[(\[{]+(?!\S)|[()\[\]{}「」『』（）【】„“”«»‹›‚‘’"]""")
_ANY_SIGN = re.compile(r"""[<`()\[\]{}「」『』（）【】„“”«»‹›‚‘’"]""")
GAP = re.compile(r"[,.;:!?…)\]}。！？、，；：）】]")
#: Lengths below a limit at which a text may end that is cut back to whole words.
SPAN = 12
#: Texts with a terminator to each without one from which on a source is one that always has one.
USUAL = 9
#: Words of a text that may be a bare name.
BRIEF = 4


@functools.lru_cache(1 << 17)
def _token(token: str) -> tuple[str, bool]:
    """(a word without signs around it, in lower case, numbers as 0; whether a gap follows)."""
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return re.sub(r"\d+", "0", token[a:b].casefold()), bool(GAP.match(token[-1]))


def word_steps(text: str) -> list[tuple[str, str, bool]]:
    """(word before, word, gap after) of every word; ^ before the first, ^, after a gap. Signs alone are a gap."""
    out: list[tuple[str, str, bool]] = []
    before = "^"
    for core, gap in map(_token, text.split()):
        if core:
            out.append((before, core, gap))
            before = "^," if gap else core
        elif out and before != "^,":
            out[-1] = (out[-1][0], out[-1][1], True)
            before = "^,"
    return out


def left_open(text: str) -> list[str]:
    """What the stack holds at the end of a text: signs and names of elements that nothing closes."""
    stack: list[str] = []

    def close(opener: str) -> bool:
        """What was opened after it is no longer awaited: stray signs do not hide the close of an outer pair."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] == opener:
                del stack[k:]
                return True
        return False

    for m in SIGNS.finditer(text):
        sign, at, end = m.group(), m.start(), m.end()
        if m[2]:
            name = m[2].lower()
            if name in ENDED and not m[3]:
                close(f"<{name}>") if m[1] else stack.append(f"<{name}>")
            continue
        if sign == "```":
            close(sign) or stack.append(sign)
            continue
        if len(sign) > 1 or "```" in stack:
            continue  # a face, or a sign in a block of code
        if sign in BRACKETS:
            close(BRACKETS[sign])
            continue
        if sign not in CLOSERS and sign not in QUOTES:
            stack.append(sign)
            continue
        before, after = text[at - 1 : at], text[end : end + 1]
        opens = (not before or before.isspace() or before in "([{<（「-–—/" or before in QUOTES) and after != "" and not after.isspace()
        if sign == "’" and before.isalnum() and after.isalnum():
            continue  # an apostrophe
        if sign == '"' and before.isdigit() and '"' not in stack:
            continue  # a measure in inches
        if sign == '"' and opens:
            stack.append(sign)
            continue
        waiting = next((q for q in reversed(stack) if sign in QUOTES.get(q, "")), None)
        if waiting:
            close(waiting)
        elif sign == "’" or (sign == "”" and not opens) or (sign == "‘" and after.isdigit()):
            continue  # an apostrophe, a stray close, the short form of a year
        elif sign != '"' or not before.isalnum():
            stack.append(sign)
    return stack


def structure(text: str) -> int:
    """DONE, OPEN or CUT by the signs of the text alone. A blank left after a word announces another."""
    tail = text.rstrip()
    if OMITTED.search(tail, max(0, len(tail) - 20)) and not re.search(r"(?<![.])\b(?:etc|usw)\.\Z", tail[-8:]):
        return CUT
    last, end = tail[-1:], tail[-12:]
    if (not end.isascii() or "\\" in end or "&" in end or "<" in tail) and BROKEN_END.search(tail):
        return CUT
    if _ANY_SIGN.search(tail) and left_open(tail):
        return CUT
    if last in STOPS or last in CLOSERS:
        return DONE
    if last.isalnum():
        return CUT if text[-1:] == " " else OPEN
    # a gap, a hyphen or a joining sign announces more; any other sign ends the text
    return CUT if last in ",;:-–—/&+=、，；：" else DONE


def _last_step(text: str) -> tuple[str, str, bool]:
    """(word before, last word, whether the text is BRIEF words without a gap), from the end of the text where that is enough."""
    parts = text.rsplit(None, 4 * BRIEF)
    steps = word_steps(" ".join(parts[1:]) if len(parts) > 4 * BRIEF else text)
    if len(parts) > 4 * BRIEF and len(steps) <= BRIEF:
        steps = word_steps(text)
    before, word = (steps[-1][0], steps[-1][1]) if steps else ("^", "")
    return before, word, 0 < len(steps) <= BRIEF and not any(gap for _, _, gap in steps)


def _scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        texts = b.column("text").to_pylist()
        before, word, brief = zip(*map(_last_step, texts)) if texts else ((), (), ())
        numbers = [pa.array(x, pa.int32()) for x in ([len(t) for t in texts], [structure(t) for t in texts])]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("source"), b.column("copy"), *numbers, pa.array(before, pa.string()), pa.array(word, pa.string()), pa.array(brief, pa.bool_())], ["id", "source", "copy", "size", "state", "before", "word", "brief"])


def _steps(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(before, word, n, gaps, ends) counted a batch at a time; the last word of a cut text counts for nothing."""
    for b in it:
        codes: dict[str, int] = {"^": 0, "^,": 1}
        befores, words, kinds = array("q"), array("q"), array("b")
        for t in b.column("text").to_pylist():
            before, n = 0, len(words)
            for core, gap in map(_token, t.split()):
                if core:
                    word = codes.setdefault(core, len(codes))
                    befores.append(before)
                    words.append(word)
                    kinds.append(gap)
                    before = 1 if gap else word
                elif len(words) > n and before != 1:
                    kinds[-1], before = 1, 1
            if len(words) > n:
                s = structure(t)
                # the end of a text: nothing where it is cut, an end where it is open, else a gap
                kinds[-1] = 3 if s == CUT else 2 if s == OPEN and not kinds[-1] else 1
        at, w, k = (np.frombuffer(x, t) if len(x) else np.empty(0, t) for x, t in ((befores, np.int64), (words, np.int64), (kinds, np.int8)))
        at, w, k = at[k < 3], w[k < 3], k[k < 3]
        pair, which = np.unique(at * len(codes) + w, return_inverse=True)
        names = pa.array(list(codes), pa.string())
        counts = [np.bincount(which, x, len(pair)).astype(np.int64) for x in (np.ones(len(k)), k == 1, k == 2)]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(pair // len(codes))), names.take(pa.array(pair % len(codes))), *map(pa.array, counts)], ["before", "word", "n", "gaps", "ends"])


def _finished(n: Column, gaps: Column, ends: Column, own: Column) -> Column:
    """Share of the occurrences that are followed by a gap, smoothed, without the `own` ends."""
    return (gaps + ends - own + 0.05) / (n - own + 1)


def _ranges(rows: DataFrame) -> DataFrame:
    """(source, size, limit): sizes that a limit at whole words leaves, up to SPAN below it; of several limits the least.

    There a source has twice as many texts without a terminator as in the spans below and above, two in five of them
    are cut by their last word, three times the share of its other lengths, and so many more than expected look
    whole that most of these are cut as well. Bare names are left out: their lengths lie close together by nature.
    rows are those at no exact limit.
    """
    loose = (F.col("state") != DONE) & ~F.col("brief")
    left = loose & ~F.col("cut") & ~F.col("closing")
    count = lambda c: F.sum(c.cast("int"))
    sizes = rows.groupBy("source", "size").agg(count(loose).alias("loose"), count(loose & F.col("cut")).alias("cuts"), count(left).alias("left"))
    at = Window.partitionBy("source").orderBy("size")
    span = lambda c, a, b: F.coalesce(F.sum(c).over(at.rangeBetween(a, b)), F.lit(0))
    w = sizes.select("source", "size", *[span(c, 1 - SPAN, 0).alias(c) for c in ("loose", "cuts", "left")], *[F.greatest(span(c, 1 - 2 * SPAN, -SPAN), span(c, 1, SPAN)).alias(f"{c}_near") for c in ("loose", "left")], *[F.sum(c).over(Window.partitionBy("source")).alias(f"{c}_all") for c in ("loose", "cuts")])
    other = F.col("loose_all") - F.col("loose")
    found = w.filter((F.col("loose") >= 25) & (F.col("loose") >= 2 * F.col("loose_near")) & (F.col("cuts") * 5 >= F.col("loose") * 2) & (F.col("cuts") * other >= 3 * (F.col("cuts_all") - F.col("cuts")) * F.col("loose")) & (F.col("left") >= 2 * F.col("left_near")))
    return found.select("source", F.col("size").alias("limit"), F.explode(F.sequence(F.col("size") - SPAN + 1, F.col("size"))).alias("size")).groupBy("source", "size").agg(F.min("limit").alias("limit"))


def verdicts(df: DataFrame, id_col: str, text_col: str, source_col: str, subject: Column, least_share: float = 0.012, enough: int = 12, few: int = 5) -> DataFrame:
    """(id, source, size, state, limit, cut) of every real text, rows stored twice once.

    `subject` is what a text is about: a text that was copied for one subject counts once in the statistics.
    Null, blank and stand-in texts are left out. `state` is the automaton's; `limit` the length at which the
    source cuts, where the text has just that length or one that whole words leave below it; `cut` the verdict. A
    null source is a source of its own. A source with more than two thirds of the texts has too few others beside it
    and is held against all texts.
    """
    real = df.filter(is_real(F.col(text_col))).select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(text_col).alias("text"), F.xxhash64(subject, text_col).alias("copy"))
    real = settled(real, "texts")  # read twice, tested once
    src = real.groupBy("id", "source", "text").agg(F.min("copy").alias("copy"))
    kind = src.schema["id"].dataType.simpleString()
    rows = settled(src.mapInArrow(_scan, f"id {kind}, source string, copy long, size int, state int, before string, word string, brief boolean"), "tails")
    sums = [F.sum(c).alias(c) for c in ("n", "gaps", "ends")]
    pairs = settled(real.select("copy", "text").distinct().select("text").mapInArrow(_steps, "before string, word string, n long, gaps long, ends long").groupBy("before", "word").agg(*sums), "steps")
    single = pairs.groupBy("word").agg(*sums)
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # words that make up a 250th of the corpus: at most 250
    frequent = single.filter(F.col("n") * 250 >= total).select(F.col("word").alias("before"), F.col("word").alias("group"))
    group = F.when(F.col("before").startswith("^"), F.col("before")).otherwise(F.coalesce("group", F.lit("*"))).alias("group")
    # beginnings of known words, of just the lengths that last words have: their set is one row
    vocabulary = single.filter(F.col("n") - F.col("ends") >= few).select("word", (F.col("n") - F.col("ends")).alias("inner"))
    lengths = rows.filter(F.col("state") == OPEN).agg(F.collect_set(F.length("word")).alias("lengths"))
    starts = vocabulary.crossJoin(F.broadcast(lengths)).select(F.explode(F.transform(F.filter("lengths", lambda n: (n > 0) & (n < F.length("word"))), lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("word"), "inner").groupBy("word").agg(F.max("inner").alias("longer"))

    # words that are followed by a joining word (one in a hundred of the corpus) wherever the text goes on: a name may end with them
    joining = single.filter(F.col("n") * 100 >= total).select("word", F.lit(1).alias("joins"))
    goes_on = pairs.filter(~F.col("before").startswith("^")).join(F.broadcast(joining), "word", "left").groupBy(F.col("before").alias("word")).agg(F.sum("n").alias("on"), F.sum(F.coalesce("joins", F.lit(0)) * F.col("n")).alias("joined"))
    nouns = goes_on.filter((F.col("on") >= few) & (F.col("joined") * 10 >= F.col("on") * 7)).select("word", F.lit(True).alias("noun"))

    # ends of a source, each text once for a subject; they are no evidence about the source itself
    per = rows.groupBy("source").agg(F.count("*").alias("texts"))
    texts = per.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    alone = per.filter(F.col("texts") * 3 > 2 * texts).select("source", F.lit(True).alias("alone"))
    ends = rows.filter(F.col("state") == OPEN).select("source", "copy", "before", "word").distinct().groupBy("source", "before", "word").agg(F.count("*").alias("own"))
    # a word is looked up with the word before it, with the group of that word, and alone: three keys, joined as one
    def keyed(df: DataFrame) -> DataFrame:
        one = lambda level, before: F.struct(F.lit(level).alias("level"), before.alias("key"))
        return df.withColumn("_k", F.explode(F.array(one("p", F.col("before")), one("g", F.col("group")), one("w", F.lit(""))))).select("*", "_k.*").drop("_k")

    by = ["level", "key", "word"]
    own = keyed(ends.join(F.broadcast(frequent), "before", "left").withColumn("group", group)).groupBy("source", *by).agg(F.sum("own").alias("own"))
    stats = keyed(pairs.join(F.broadcast(frequent), "before", "left").withColumn("group", group)).groupBy(*by).agg(*sums)
    tails = rows.filter(F.col("state") == OPEN).select("source", "before", "word", "brief").distinct().join(F.broadcast(frequent), "before", "left").withColumn("group", group)
    tails = keyed(tails).join(stats, by, "left").join(own, ["source", *by], "left").join(F.broadcast(alone), "source", "left")
    tails = tails.withColumn("own", F.when(F.coalesce("alone", F.lit(False)), 1).otherwise(F.col("own")))
    tails = tails.withColumn("share", _finished(F.col("n"), F.col("gaps"), F.col("ends"), F.col("own")))
    of = lambda level, c: F.max(F.when(F.col("level") == level, F.col(c))).alias(f"{level}_{c}")
    tails = tails.groupBy("source", "before", "word", "brief").agg(*[of(level, c) for level in "pgw" for c in ("n", "ends", "own", "share")])
    tails = tails.join(starts, "word", "left").join(nouns, "word", "left")
    known = lambda a: F.coalesce(F.col(f"{a}_n") - F.col(f"{a}_own"), F.lit(0)) >= enough
    stump = F.col("longer").isNotNull() & ((F.col("w_n") - 1 < few) | ((F.col("w_n") == F.col("w_ends")) & (F.col("longer") > F.col("w_n"))))
    unfinished = (
        F.when(F.col("brief") & F.col("noun"), False)
        .when((F.col("w_n") - F.col("w_own") >= 500) & (F.col("w_share") < least_share / 3), True)
        .when(stump, True)
        .when(known("p"), F.col("p_share") < least_share)
        .when(known("g"), F.col("g_share") < least_share)
        .when(F.col("w_n") - F.col("w_own") >= few, F.col("w_share") < least_share)
        .otherwise(False)
    )
    closing = (F.col("p_n") - F.col("p_own") >= 20) & ((F.col("p_ends") - F.col("p_own")) * 2 >= F.col("p_n") - F.col("p_own"))
    judged = tails.select("source", "before", "word", "brief", F.coalesce(unfinished, F.lit(False)).alias("unfinished"), F.coalesce(closing, F.lit(False)).alias("closing")).filter("unfinished or closing")
    judged = settled(judged, "judged")
    if fits(judged, 100_000):
        judged = F.broadcast(judged)
    rows = rows.join(judged, ["source", "before", "word", "brief"], "left").select("id", "source", "size", "state", "brief", ((F.col("state") == CUT) | ((F.col("state") == OPEN) & F.coalesce("unfinished", F.lit(False)))).alias("cut"), F.coalesce("closing", F.lit(False)).alias("closing"))
    rows = settled(rows, "verdicts")

    # lengths at which a source piles up unfinished texts; lengths and sources are few, the counts merge before the shuffle
    sizes = rows.groupBy("source", "size").agg(F.count("*").alias("here"), F.sum(F.col("cut").cast("int")).alias("cuts"))
    near = Window.partitionBy("source").orderBy("size").rangeBetween(-10, 10)
    around = (F.sum("here").over(near) - F.col("here")) / 20.0
    limits = sizes.withColumn("around", around).filter((F.col("here") >= 5) & (F.col("here") >= 4 * F.greatest(F.col("around"), F.lit(0.5))) & (F.col("cuts") * 5 >= F.col("here") * 2)).select("source", "size", F.col("size").alias("limit"))
    limits = limits.unionByName(_ranges(rows.join(limits, ["source", "size"], "left_anti")).join(limits, ["source", "size"], "left_anti"))
    limits = F.broadcast(limits) if fits(limits, 100_000) else limits
    out = rows.join(limits, ["source", "size"], "left")
    at_limit = F.col("limit").isNotNull() & (F.col("state") == OPEN) & ~F.col("closing")
    # the terminator baseline of each source, over the texts that nothing else calls cut
    ended = rows.groupBy("source").agg(F.count_if(F.col("state") == DONE).alias("done"), F.count_if((F.col("state") == OPEN) & ~F.col("cut")).alias("open"))
    strict = ended.filter((F.col("done") >= 50) & (F.col("done") >= USUAL * F.col("open"))).select("source", F.lit(True).alias("strict"))
    out = out.join(F.broadcast(strict) if fits(strict, 100_000) else strict, "source", "left")
    missing = F.coalesce("strict", F.lit(False)) & (F.col("state") == OPEN) & ~F.col("brief")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "state", "limit", (F.col("cut") | at_limit | missing).alias("cut"))


def report(judged: DataFrame, source_col: str) -> DataFrame:
    """One row per source: texts, cut texts, their share, the share that ends with a terminator, and the limits found."""
    return judged.groupBy(source_col).agg(
        F.count("*").alias("n_texts"),
        F.sum(F.col("cut").cast("int")).cast("long").alias("n_cut"),
        F.round(F.avg(F.col("cut").cast("double")), 4).alias("share"),
        F.round(F.avg((F.col("state") == DONE).cast("double")), 4).alias("terminated"),
        F.array_sort(F.collect_set("limit")).alias("limits"),
    )
