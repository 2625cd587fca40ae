"""Line-first cleaning with column functions only.

Each line of a text is judged by rules on symbols, navigation, shouting, punctuation and
boilerplate. Lines that fail are removed, and a document that would lose more than half of
its characters by them is rejected, as are very short and very repetitive ones. Every rule
is a share of the line's own words, so lines of any length are judged alike.

Counts are taken in the document's own row with arrays of hashes, so nothing is
shuffled. Windows of words are compared by 64-bit hashes within a document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import WORD, read_table

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words
MOST_LOST = 50  # per cent of characters

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
SEPARATOR = "[|»›•·]"
UPPER, LOWER = r"\p{Lu}", r"\p{Ll}"
# a mark that closes a clause, before white space or at the end; those of scripts without spaces stand anywhere
PUNCTUATION = r"[.!?,;:…؟،؛।॥։።][\"'”’»)]?([\x20\x09-\x0D]|$)|[。！？，、；：｡]"
# a copyright line of any language, and fixed phrases in lower case
NOTICE = r"(©|\(c\)|copyright)[\x20]*(19|20)[0-9][0-9]"
BOILERPLATE = f"{NOTICE}|all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|subscribe to our|sign up for our"
BOILERPLATE_WORDS = 40  # of a line for each phrase found, at most


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


#: One of these stands in every boilerplate line, in lower case: plain texts are told apart by them at little cost.
HINTS = ("©", "(c)", "copyright", "rights reserved", "licensed", "released", "terms of", "policy", "cookies", "javascript", "subscribe", "sign up")


def line_fails(line: Column, hinted: Column) -> Column:
    """A line with a word breaks one of the rules; lines without words never do.

    ``hinted``: the line's text has one of ``HINTS``; without one no line is boilerplate.
    """
    words = _count(line, WORD)
    small = F.lower(line)
    plate = hinted & small.rlike(BOILERPLATE) & (_count(small, BOILERPLATE) * BOILERPLATE_WORDS >= words)

    def dense(pattern: str) -> Column:
        """Found more than once in five words; words are counted only where it is found at all."""
        return line.rlike(pattern) & (_count(line, pattern) * 5 > words)

    capitals = line.rlike(UPPER * 2) & (_count(line, UPPER) > _count(line, LOWER)) & (words >= 5)
    return line.rlike(WORD) & (dense(SYMBOL) | dense(SEPARATOR) | dense("!!") | ~line.rlike(PUNCTUATION) | capitals | plate)


def _let(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(hashes: Column, size: int) -> Column:
    """Words in windows of ``size`` that occur twice or more; ``hashes`` has one hash a window."""

    def of_sorted(s: Column) -> Column:
        def same(j: Column, step: int) -> Column:
            return F.coalesce(F.get(s, j + step)["h"] == F.get(s, j)["h"], F.lit(False))

        at = F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(same(j, -1) | same(j, 1), F.get(s, j)["p"])), lambda p: p.isNotNull())
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

        def add(acc: Column, p: Column) -> Column:
            return F.struct((p + size).alias("end"), (acc["n"] + (p + size - F.greatest(acc["end"], p))).alias("n"))

        return F.aggregate(F.sort_array(at), start, add, lambda acc: acc["n"])

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeated, _let(placed, of_sorted)).otherwise(F.lit(0)).cast("long")


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_lines_removed", "lost_chars", "kept", "clean_text")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts, verdict and cleaned text.

    The columns of ``ADDED`` are added, in place of any that had their names. A null text
    counts as empty: no words, base_failed, not kept, clean_text empty. Each row is
    judged by itself, so repeated rows agree and there are no ties; a very long text is
    judged whole, all its lines in its row; an empty table stays empty.
    """
    names = ["_row"]  # the columns as they came, so that none clashes with those made here
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    small = F.lower(t)
    hinted = reduce(lambda a, b: a | b, [F.contains(small, F.lit(h)) for h in HINTS])
    one = docs.select(row, t.alias("_t"), hinted.alias("_hinted"), F.split(t, "\n").alias("_lines"), F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("_words"))
    windows = F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]))
    windows = F.when(F.size("_words") > WINDOW, windows).otherwise(F.array().cast("array<bigint>"))
    two = one.select(*names, "_t", "_lines", F.size("_words").cast("long").alias("n_words"), windows.alias("_windows"), F.filter("_lines", lambda x: ~line_fails(x, F.col("_hinted"))).alias("_kept"))
    full = F.filter("_lines", lambda x: x.rlike(WORD))
    three = two.select(
        *names,
        "n_words",
        (F.length("_t") - _count(F.col("_t"), SPACE)).cast("long").alias("word_chars"),
        _count(F.col("_t"), SYMBOL).cast("long").alias("n_symbols"),
        _let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_windows"), WINDOW).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_lines_removed"),
        (F.length("_t") - F.size("_lines") + 1).cast("long").alias("_chars"),
        F.array_join("_kept", "\n").alias("clean_text"),
        F.size("_kept").alias("_n_kept"),
    )
    lost = F.col("_chars") - (F.length("clean_text") - F.greatest(F.col("_n_kept") - 1, F.lit(0)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    four = three.withColumns({"base_failed": failed, "lost_chars": lost.cast("long")})
    left = F.col("_chars") > F.col("lost_chars")
    kept = ~F.col("base_failed") & left & (100 * F.col("lost_chars") <= MOST_LOST * F.col("_chars"))
    given = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ADDED]
    return four.withColumn("kept", kept).select(*given, *ADDED)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that pass, with their failing lines removed; columns as they were."""
    # the row number keeps the optimizer from pushing the filter below the counts, where
    # it would repeat them inside each other
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_given")
    out = measured(docs.select(row, F.col(f"`{text}`").alias("_text")), "_text").withColumn("_at", F.monotonically_increasing_id())
    out = out.where(F.col("kept") & (F.col("_at") >= 0))
    return out.select(*[(F.col("clean_text") if c == text else F.col(f"_given.`{c}`")).alias(c) for c in docs.columns])


def op2_line_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict for every whole text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed", "lost_chars")
    return measured(docs).select(*names)


def _sql_count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern.replace(chr(39), chr(39) * 2)}'))"


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{WORD}') AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s
        FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM
        (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win), (SELECT unnest(range({WINDOW})) AS k)
        WHERE c > 1 GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
j AS (SELECT r, x, regexp_matches(x, '{WORD}') AS has, {_sql_count("x", WORD)} AS nw, {_sql_count("x", SYMBOL)} AS ns,
        {_sql_count("x", SEPARATOR)} AS nv, {_sql_count("x", "!!")} AS nb, {_sql_count("x", UPPER)} AS nu, {_sql_count("x", LOWER)} AS nl,
        regexp_matches(x, '{PUNCTUATION.replace(chr(39), chr(39) * 2)}') AS p, {_sql_count("lower(x)", BOILERPLATE)} AS np, regexp_matches(x, '{UPPER * 2}') AS uu FROM l),
f AS (SELECT r, x, has,
        has AND (ns * 5 > nw OR nv * 5 > nw OR nb * 5 > nw OR (uu AND nu > nl AND nw >= 5) OR NOT p OR (np > 0 AND np * {BOILERPLATE_WORDS} >= nw)) AS bad FROM j),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (bad) AS n_lines_removed,
        coalesce(sum(length(x)) FILTER (bad), 0)::BIGINT AS lost_chars, coalesce(sum(length(x)), 0)::BIGINT AS chars, count(*) FILTER (has) - count(DISTINCT x) FILTER (has) AS n_dup_lines FROM f GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, (length(t) - {_sql_count("t", SPACE)})::BIGINT AS word_chars, {_sql_count("t", SYMBOL)}::BIGINT AS n_symbols,
        n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, n_lines, n_lines_removed, lost_chars, chars
      FROM d JOIN w USING (r) JOIN g USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND chars > lost_chars AND 100 * lost_chars <= {MOST_LOST} * chars AS kept,
  n_lines, n_lines_removed, lost_chars
FROM m
"""
