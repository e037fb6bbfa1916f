"""Quality rules from repetition within a text and from distance to its language's usual histograms.

Written in DataFrame functions alone. Words are runs of anything but ASCII white space, as in
``[^\\x20\\x09-\\x0D]+``. A text is compared with its language on two histograms, of character classes
and of common words, by Jensen-Shannon distance (base 2, so from 0 to 1). A language's reference is
the sum of the histograms of all its texts. Character classes are summed for every language found; texts
without a language, or of one with too little text for a reference, are compared with all texts together.
Common words are known for the languages of ``COMMON_WORDS``. A text too short for a steady histogram is
not compared; each distance has its own guard, as a histogram of characters is steady sooner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.sources.tables import settle

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
# Least length of a text for the distance of classes, in word characters, and for that of words, in words.
GUARD_CHARS = 200
GUARD_WORDS = 100
# Word characters that a language needs for a reference of its own.
REFERENCE_CHARS = 100_000
CLASS_LIMIT = 0.3
WORD_LIMIT = 0.32
LISTED = 64
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
# Rare character classes; what is left of a text's words is the class of other characters.
CLASSES = (r"\p{Lu}", r"\p{Nd}", r"[.!?…]", r"[,;:]")
# Frequent function words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit ist des auf".split(),
    "en": "the of and to in a is that for was with on".split(),
    "es": "de la que el en y los del se las por un".split(),
    "fr": "de la le et les des en un du une que est".split(),
}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null or blank text."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words stand in a window of ``width`` words that the text holds twice or more.

    Windows are told apart by a 64-bit hash; words covered by several repeated windows count once.
    Most texts repeat few windows, which are looked up in a short list. In the others, hashes are
    sorted together with their places.
    """

    def windows(w: Column) -> Column:
        starts = F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - width))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def neighbours(values: Column, body: Callable[[Column, Column], Column]) -> Column:
        return bound(values, lambda v: F.zip_with(v, F.slice(v, F.lit(2), F.size(v)), body))

    def present(values: Column) -> Column:
        return F.filter(values, lambda x: x.isNotNull())

    def listed(hashes: Column, twice: Column) -> Column:
        return present(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)))

    def sorted_out(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        pairs = neighbours(ordered, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(present(pairs))))

    def covered(found: Column) -> Column:
        gaps = neighbours(found, lambda a, b: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def counted(hashes: Column) -> Column:
        twice = F.array_distinct(present(neighbours(F.sort_array(hashes), lambda a, b: F.when(a == b, a))))
        found = bound(
            twice,
            lambda t: F.when(F.size(t) == 0, F.array().cast("array<int>"))
            .when(F.size(t) <= LISTED, listed(hashes, t))
            .otherwise(sorted_out(hashes)),
        )
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(found)).otherwise(F.lit(0))

    return F.coalesce(bound(bound(words, windows), counted), F.lit(0)).cast("long")


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def occurrences(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def common_counts(words: Column, listed: Column) -> Column:
    """How often each listed word occurs, whatever its case; the last number is all other words.

    Every short word is written as a letter, ``a`` for the first listed word and so on, and the letters
    are counted.
    """
    longest = max(len(w.encode()) for v in COMMON_WORDS.values() for w in v)
    width = max(map(len, COMMON_WORDS.values()))
    letters = "".join(chr(ord("a") + k) for k in range(width))
    short = F.filter(words, lambda w: F.octet_length(w) <= longest)
    marks = F.transform(short, lambda w: F.substring(F.lit(f"-{letters}"), F.array_position(listed, F.lower(w)).cast("int") + 1, F.lit(1)))

    def counts(text: Column) -> Column:
        each = [F.length(text) - F.length(F.replace(text, F.lit(x), F.lit(""))) for x in letters]
        return F.array(*[n.cast("long") for n in each])

    def with_rest(n: Column) -> Column:
        rest = F.size(words).cast("long") - F.aggregate(n, F.lit(0).cast("long"), lambda t, x: t + x)
        return F.concat(n, F.array(rest))

    return bound(bound(F.array_join(marks, ""), counts), with_rest)


def measure(documents: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """One row per document with its counts and both histograms, and without its text."""
    listed = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    split = documents.select(
        F.col(key), F.col(lang), F.coalesce(F.col(text), F.lit("")).alias("text"), words_of(F.col(text)).alias("words")
    )
    counted = split.select(
        key,
        lang,
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array(*[occurrences(F.col("text"), c) for c in CLASSES]).alias("rare"),
        F.when(F.col(lang).isin(*COMMON_WORDS), common_counts(F.col("words"), listed[F.col(lang)])).alias("common"),
    )
    counted = counted.withColumn("classes", F.concat("rare", F.array("n_symbols")))
    other = F.col("word_chars") - F.aggregate("classes", F.lit(0).cast("long"), lambda t, x: t + x)
    return counted.withColumn("classes", F.concat("classes", F.array(F.greatest(other, F.lit(0))))).drop("rare")


def summed(rows: DataFrame, name: str, *by: str) -> DataFrame:
    """``usual_<name>``: the sum of the histograms of each group, or of all rows, which gives one row."""
    totals = rows.select(*by, F.posexplode(name).alias("k", "n")).groupBy(*by, "k").agg(F.sum("n").alias("n"))
    return totals.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]).alias(f"usual_{name}")
    )


def references(measured: DataFrame, lang: str) -> DataFrame:
    """One row per language with its summed histograms; those of words are null without a list of words.

    A language with less than ``REFERENCE_CHARS`` word characters has no row, unless it has a list of words.
    Then its row has no histogram of classes.
    """
    spoken = measured.where(F.col(lang).isNotNull()).withColumnRenamed(lang, "of")
    enough = F.aggregate("usual_classes", F.lit(0).cast("long"), lambda t, x: t + x) >= REFERENCE_CHARS
    classes = summed(spoken, "classes", "of").where(enough)
    return classes.join(summed(spoken.where(F.col("of").isin(*COMMON_WORDS)), "common", "of"), "of", "full")


def jensen_shannon(left: Column, right: Column) -> Column:
    """The distance of two histograms of counts, 0 to 1; null if either is null or has no counts."""

    def share(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("double"), lambda t, x: t + x)
        return bound(total, lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n)))

    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    parts = bound(
        F.struct(share(left).alias("p"), share(right).alias("q")),
        lambda s: F.zip_with(s["p"], s["q"], lambda p, q: F.when(p.isNotNull() & q.isNotNull(), term(p, q) + term(q, p))),
    )
    whole = F.aggregate(parts, F.lit(0.0), lambda t, x: t + x) / 2
    return bound(whole, lambda d: F.sqrt(F.when(d < 0, 0.0).otherwise(d)))


def judge(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, distances and verdict per document.

    Null and blank texts have no words and fail. A text of a null or rare language has the distance of classes
    to all texts together, and one of a language that is not in ``COMMON_WORDS`` has a null distance of words. A
    distance is null below its guard, ``GUARD_CHARS`` or ``GUARD_WORDS``, and does not count. Repeated rows are
    judged each by itself. Columns besides the three are not read.
    """
    measured = settle(measure(documents, key, text, lang), "quality")
    # Languages grow with the input only as far as each has text enough, so the size decides how they are joined.
    usual = settle(references(measured, lang), "quality-usual")
    whole = summed(measured, "classes").withColumnRenamed("usual_classes", "all_classes")  # one short row
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    strange = (F.col("class_distance") > CLASS_LIMIT) | (F.col("word_distance") > WORD_LIMIT)
    class_distance = jensen_shannon(F.col("classes"), F.coalesce("usual_classes", "all_classes"))
    word_distance = jensen_shannon(F.col("common"), F.col("usual_common"))
    return (
        measured.join(usual, F.col(lang) == F.col("of"), "left")
        .join(F.broadcast(whole), F.lit(True), "left")
        .withColumn("class_distance", F.when(F.col("word_chars") >= GUARD_CHARS, class_distance))
        .withColumn("word_distance", F.when(F.col("n_words") >= GUARD_WORDS, word_distance))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strange, F.lit(False)))
        .select(
            key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"),
            F.round("word_distance", 6).alias("word_distance"),
        )
    )


def op10_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every whole document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))


def _sql() -> str:
    """DuckDB SQL for :func:`op10_quality_divergence`, with the same patterns, word lists and limits."""
    listed = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in COMMON_WORDS.items()
    )
    languages = ", ".join(f"'{lang}'" for lang in COMMON_WORDS)
    width = max(map(len, COMMON_WORDS.values()))
    classes = ", ".join(f"len(regexp_extract_all(t, '{c}'))" for c in CLASSES)
    distance = """list_sum(list_transform(range(1, len(p) + 1), lambda k:
        CASE WHEN p[k] > 0 THEN p[k] * log2(2 * p[k] / (p[k] + q[k])) ELSE 0 END
        + CASE WHEN q[k] > 0 THEN q[k] * log2(2 * q[k] / (p[k] + q[k])) ELSE 0 END)) / 2"""

    def shares(counts: str) -> str:
        return f"list_transform({counts}, lambda x: x / list_sum({counts}))"

    def apart(left: str, right: str) -> str:
        both = f"SELECT {shares(left)} AS p, {shares(right)} AS q"
        return f"(SELECT sqrt(CASE WHEN d < 0 THEN 0 ELSE d END) FROM (SELECT {distance} AS d FROM ({both})))"

    return f"""
WITH words AS (
    SELECT doc_id, lang, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
        CASE lang {listed} END AS listed
    FROM documents
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS times
    FROM (SELECT doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS i, w FROM words WHERE len(w) >= {WINDOW}),
        LATERAL (SELECT array_to_string(w[i:i + {WINDOW - 1}], ' ') AS five)
), covered AS (
    SELECT doc_id, sum(least(coalesce(after - i, {WINDOW}), {WINDOW})) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM windows WHERE times > 1)
    GROUP BY doc_id
), measured AS (
    SELECT words.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols,
        len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
        - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))))
            AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        [{classes}] AS rare,
        list_transform(range(1, {width + 1}),
            lambda k: len(list_filter(w, lambda x: lower(x) = listed[k]))) AS found
    FROM words LEFT JOIN covered USING (doc_id)
), histograms AS (
    SELECT *, list_concat(list_concat(rare, [n_symbols]), [greatest(word_chars - n_symbols - list_sum(rare), 0)]) AS classes,
        CASE WHEN lang IN ({languages}) THEN list_concat(found, [n_words - list_sum(found)]) END AS common
    FROM measured
), usual AS (
    SELECT lang, list(c ORDER BY k) AS usual_classes FROM (
        SELECT lang, k, sum(classes[k]) AS c FROM histograms, range(1, {len(CLASSES) + 3}) r(k)
        WHERE lang IS NOT NULL GROUP BY lang, k) GROUP BY lang HAVING sum(c) >= {REFERENCE_CHARS}
), whole AS (
    SELECT list(c ORDER BY k) AS all_classes FROM (
        SELECT k, sum(classes[k]) AS c FROM histograms, range(1, {len(CLASSES) + 3}) r(k) GROUP BY k)
), usual_words AS (
    SELECT lang, list(c ORDER BY k) AS usual_common FROM (
        SELECT lang, k, sum(common[k]) AS c FROM histograms, range(1, {width + 2}) r(k)
        WHERE lang IN ({languages}) GROUP BY lang, k) GROUP BY lang
), nearest AS (
    SELECT h.*, usual_common, coalesce(usual_classes, all_classes) AS usual_classes
    FROM histograms h LEFT JOIN usual USING (lang) LEFT JOIN usual_words USING (lang) LEFT JOIN whole ON true
), compared AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
        CASE WHEN word_chars >= {GUARD_CHARS} THEN {apart('classes', 'usual_classes')} END AS class_far,
        CASE WHEN n_words >= {GUARD_WORDS} THEN {apart('common', 'usual_common')} END AS word_far
    FROM nearest
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(class_far > {CLASS_LIMIT} OR word_far > {WORD_LIMIT}, false) AS kept,
    round(class_far, 6) AS class_distance, round(word_far, 6) AS word_distance
FROM compared
"""


OP10_SQL = _sql()
