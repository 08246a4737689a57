"""Quality rules: word and line statistics, and cross-document line frequency. DataFrame functions only.

A line that stands in more than ``limit`` distinct documents of one host is
boilerplate there and taken out; documents left with too few words are rejected. Identical texts count as one document, so copies of a page
do not make its lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SPACE_CLASS, text_or_empty
from tarmac.plans.layers import materialise

# Rules of the contract.
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

LINE_DOCS = 10
LEFT_SHARE = 0.3


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by a ``window``-word sequence found twice or more in ``words``.

    Windows are compared by 64-bit hash. Their sorted (hash, place) pairs show
    which places repeat; the union of the windows there is then summed up.
    """
    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (window - 1)),
                           lambda i: F.xxhash64(*[F.get(hashes, i + (j - 1)) for j in range(window)]))

    def places(found: Column) -> Column:
        def repeats(s: Column) -> Column:
            last = F.size(s) - 1
            return F.sort_array(F.transform(
                F.filter(F.sequence(F.lit(0), last), lambda j: F.coalesce(F.get(s, j)["h"] == F.get(s, j - 1)["h"], F.lit(False))
                         | F.coalesce(F.get(s, j)["h"] == F.get(s, j + 1)["h"], F.lit(False))),
                lambda j: F.get(s, j)["i"]))

        return let(F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeats)

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("upto"))
        return F.aggregate(at, start, lambda acc, i: F.struct(
            (acc["sum"] + (i + window) - F.greatest(acc["upto"], i)).cast("long").alias("sum"), (i + window).alias("upto")),
            lambda acc: acc["sum"])

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(places(found)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(let(let(hashed, windows), count))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus text, host and the key of the text."""
    t = text_or_empty()
    return docs.withColumns({"__t": t, "__host": F.col("source").cast("string"), "__k": F.xxhash64(t), "__bytes": F.octet_length(t)})


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS + "+", " ")))


def statistics(docs: DataFrame) -> DataFrame:
    """Rows of _keyed() plus the contract's counts."""
    base = docs.withColumn("__w", words_of(F.col("__t")))
    base = base.withColumn("__ls", F.filter(_lines(F.col("__t")), lambda x: x.rlike(HAS_WORD)))
    return base.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.aggregate("__w", F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)),
        "n_symbols": F.regexp_count("__t", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("__ls") - F.size(F.array_distinct("__ls"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__w"))}).drop("__w", "__ls")


def frequent_lines(keyed: DataFrame, line_docs: int, line_share: float) -> DataFrame:
    """(host, text key, hashes of the text's frequent lines) of the distinct texts that hold any."""
    key = ["__host", "__k", "__bytes"]
    lines = (keyed.select(*key, F.explode(F.array_distinct(F.transform(F.filter(_lines(F.col("__t")), lambda x: x.rlike(HAS_WORD)), _line_hash))).alias("h"))
             .distinct())
    lines = materialise(lines, "lines")
    # distinct documents per line, then counts: both combined before the shuffle
    frequent = lines.groupBy("__host", "h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > line_docs)
    if line_share > 0:
        hosts = keyed.select(*key).distinct().groupBy("__host").agg(F.count(F.lit(1)).alias("docs")).withColumnRenamed("__host", "host")
        frequent = frequent.join(hosts, F.col("__host").eqNullSafe(F.col("host"))).where(F.col("c") > line_share * F.col("docs"))
    frequent = frequent.select(F.col("__host").alias("fh"), F.col("h").alias("fl"))
    gone = lines.join(frequent, lines["__host"].eqNullSafe(frequent["fh"]) & (F.col("h") == F.col("fl")))
    return gone.groupBy(*key).agg(F.collect_set("h").alias("__gone"))


def cleaned(docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = 0.0,
            left_share: float = LEFT_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` plus the counts and verdicts of line_rules() and __clean: the text without its frequent lines.

    The other lines stay as they are, joined by line ends; a text without a frequent line is unchanged.
    """
    keyed = _keyed(docs)
    gone = frequent_lines(keyed, line_docs, line_share).withColumnsRenamed({"__host": "__gh", "__k": "__gk", "__bytes": "__gb"})
    rows = statistics(keyed).join(gone, F.col("__host").eqNullSafe(F.col("__gh")) & (F.col("__k") == F.col("__gk")) & (F.col("__bytes") == F.col("__gb")), "left")
    stays = F.filter(_lines(F.col("__t")), lambda x: ~(x.rlike(HAS_WORD) & F.array_contains("__gone", _line_hash(x))))
    rows = rows.withColumn("__clean", F.when(F.col("__gone").isNull(), F.col("__t")).otherwise(F.array_join(stays, "\n")))
    left = F.when(F.col("__gone").isNull(), F.col("n_words")).otherwise(F.size(words_of(F.col("__clean")))).cast("long")
    rows = rows.withColumn("boilerplate_words", F.col("n_words") - left)
    left = F.col("n_words") - F.col("boilerplate_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (rows.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (left >= min_words) & (left >= left_share * F.col("n_words")))
            .drop("__t", "__host", "__k", "__bytes", "__gh", "__gk", "__gb", "__gone"))


def line_rules(docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = 0.0,
               left_share: float = LEFT_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """The counts per document with base_failed, boilerplate_words and kept, from the cleaned texts.

    A line is frequent in more than ``line_docs`` distinct documents of its host, however
    large that is; ``line_share`` can ask for a share of them as well.

    Null text has no words and fails; a null host is a host of its own;
    repeated rows are judged each; an empty table gives an empty result.
    """
    return cleaned(docs.select("doc_id", "source", "text"), line_docs, line_share, left_share, min_words).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "boilerplate_words", "kept")


def clean_documents(docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = 0.0,
                    left_share: float = LEFT_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """The kept documents, all columns, their texts without frequent lines and n_chars up to date."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "boilerplate_words", "kept")
    own = docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in counts})
    kept = cleaned(own, line_docs, line_share, left_share, min_words).where("kept").withColumn("text", F.col("__clean"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("boilerplate_words") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"__own_{c}").alias(c) if c in counts else F.col(c) for c in docs.columns])
