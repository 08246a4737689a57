"""Secret scan: candidate strings judged by a random forest, DataFrame functions only.

Candidates are long runs of key characters with a digit, dotted tokens, and values
assigned to a credential-like name: quoted ones up to the closing quote, others up to
white space. Features: length, character classes and their transitions, other symbols, dictionary coverage (letters inside words of the corpus's most
frequent words), path shape, and the neighbouring words. The forest is fit on
a bounded sample of labelled findings and removes the false positives
(numbers, paths, slugs, identifiers).

``labelled_findings`` derives such labels from the corpus where no table of
judged findings is at hand; ``scan`` accepts any table of the same columns.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SPACE_CLASS, UID, fresh, text_or_empty, with_row_ids
from tarmac.llm.line_rules import let
from tarmac.plans.layers import materialise
from tarmac.session import work_dir

# What a credential is called, and what a candidate looks like.
NAMES = r"token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|auth|authorization|credential|private[_-]?key"
GIVEN = rf"(?i)(?:{NAMES})[\"']?\s{{0,3}}[:=]\s{{0,3}}"
LONG_RUN = r"(?<![\w+/-])(?=[A-Za-z+/_-]*\d)[\w+/-]{16,}={0,2}"
DOTTED = r"(?<![\w+/.-])(?=[A-Za-z_.-]*\d)(?=[\w.-]{16})[\w-]{6,}(?:\.[\w-]{6,}){1,8}"
# a quoted value goes up to its closing quote, any other up to white space
ASSIGNED = [GIVEN + r'"(?=[^\n]{8})([^"\\\n]*+(?:\\.[^"\\\n]*+){0,200}+)"',
            GIVEN + r"'(?=[^\n]{8})([^'\\\n]*+(?:\\.[^'\\\n]*+){0,200}+)'",
            GIVEN + r"(?:\"(?![^\"\n]*\")|'(?![^'\n]*'))?+([^\s\"']\S{7,})",
            r"(?i)\bbearer\s{1,3}([\w+/.~-]{8,}={0,2})"]
NAME_BEFORE = GIVEN + r"(?:bearer\s{1,3})?[\"']?$|(?i)\bbearer\s{1,3}$"
# surely no secret: numbers, and slugs, paths and versions of plain words and short numbers
NO_SECRET = r"^(?:[\d/_.-]*|/?(?:[A-Za-z]?[a-z]+|v?\d{1,6})(?:[/_.-](?:[A-Za-z]?[a-z]+|v?\d{1,6}))+)$"
REDACTED = "[SECRET]"

CONTEXT = 40
REACH = 5
DICTIONARY_WORDS = 20_000
SAMPLE = 4_000
TREES = 30
DEPTH = 6
THRESHOLD = 0.5
FEATURES = ["f_length", "f_digits", "f_upper", "f_lower", "f_moves", "f_distinct", "f_hex", "f_covered", "f_path",
            "f_named", "f_quoted", "f_words_near", "f_symbols"]


def candidates(rows: DataFrame, text: Column, key: str) -> DataFrame:
    """(key, candidate, start, occurrences, contexts) per distinct candidate of a text.

    ``start`` is the code point of the first occurrence; ``contexts`` are the
    distinct (before, after) of all occurrences.
    """
    found = F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (LONG_RUN, DOTTED)],
                                      *[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in ASSIGNED]))
    found = F.filter(found, lambda c: F.length(c) >= 8)
    spot = rows.select(key, text.alias("__text"), found.alias("__found")).where(F.size("__found") > 0)
    t = F.col("__text")

    def described(c: Column) -> Column:
        # what stands between the occurrences; a candidate has 8 characters or more, so REACH of them fill a context
        literal = F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))

        def around(ends: Column) -> Column:
            return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(ends["tails"]) - 1), lambda i: F.struct(
                F.right(F.call_function("array_join", F.slice(ends["tails"], F.greatest(i - REACH, F.lit(1)), F.least(i, F.lit(REACH + 1))), c), F.lit(CONTEXT)).alias("before"),
                F.left(F.call_function("array_join", F.slice(ends["heads"], i + 1, F.lit(REACH + 1)), c), F.lit(CONTEXT)).alias("after"))))

        def whole(pieces: Column) -> Column:
            ends = F.struct(F.transform(pieces, lambda x: F.right(x, F.lit(CONTEXT))).alias("tails"),
                            F.transform(pieces, lambda x: F.left(x, F.lit(CONTEXT))).alias("heads"))
            return F.struct(c.alias("candidate"), F.length(pieces[0]).cast("long").alias("start"),
                            (F.size(pieces) - 1).cast("long").alias("occurrences"), let(ends, around).alias("contexts"))

        return let(F.split(t, literal, -1), whole)

    return spot.select(key, F.explode(F.transform("__found", described)).alias("c")).select(key, "c.*")


def in_contexts(found: DataFrame) -> DataFrame:
    """``found`` with one row per context (before, after)."""
    return found.withColumn("__context", F.explode("contexts")).drop("contexts").select("*", "__context.*").drop("__context")


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The ``size`` most frequent all-letter words (three letters or more) of the whole corpus."""
    words = docs.select(F.explode(F.split(F.lower(text_or_empty()), SPACE_CLASS + "+")).alias("w")).where(r"w rlike '^[a-z]{3,20}[.,]?$'")
    counted = words.select(F.rtrim(F.lit(".,"), F.col("w")).alias("w")).groupBy("w").count()
    return counted.orderBy(F.desc("count"), "w").limit(size).select("w")


def _chars(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, ""))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` plus the forest's features; ``words`` is the bounded dictionary."""
    c, n = F.col("candidate"), F.length("candidate").cast("double")
    classes = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
                          "A" * 26 + "a" * 26 + "0" * 10)
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    found = found.withColumn("__part", F.monotonically_increasing_id())
    found = materialise(found, "candidates")
    parts = (found.select("__part", F.explode(F.split(F.lower("candidate"), "[^a-z]+")).alias("w")).where("length(w) >= 3")
             .join(F.broadcast(words), "w").groupBy("__part").agg(F.sum(F.length("w")).alias("covered")))
    return (found.join(parts, "__part", "left").drop("__part")
            .withColumn("f_length", F.least(n, F.lit(200.0)))
            .withColumn("f_digits", _chars(c, "[^0-9]") / n).withColumn("f_upper", _chars(c, "[^A-Z]") / n)
            .withColumn("f_lower", _chars(c, "[^a-z]") / n).withColumn("f_moves", runs / n)
            .withColumn("f_distinct", F.size(F.array_distinct(F.split(c, ""))) / n)
            .withColumn("f_hex", (_chars(c, "[^0-9a-fA-F]") == n).cast("double"))
            .withColumn("f_covered", F.coalesce(F.col("covered"), F.lit(0)) / n)
            .withColumn("f_path", _chars(c, "[^/_.-]") / n)
            .withColumn("f_symbols", _chars(c, r"[\w/.+=-]") / n)
            .withColumn("f_named", F.col("before").rlike(NAME_BEFORE).cast("double"))
            .withColumn("f_quoted", (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"))
            .withColumn("f_words_near", F.size(F.split(F.concat_ws(" ", F.regexp_replace("before", r"[^\p{L}\s]+\S*", ""),
                                                                   F.regexp_replace("after", r"[^\p{L}\s]+\S*", "")), r"\s+")).cast("double"))
            .drop("covered"))


def labelled_findings(docs: DataFrame, found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Labelled findings (candidate, before, after, label) derived from the corpus.

    Secrets: named candidates with a digit, unless of a shape in NO_SECRET, and digests,
    base64 strings, dotted tokens and passwords computed from texts. Not secrets:
    candidates of a shape in NO_SECRET, named or not, and slugs, paths, numbers, versions
    and phrases made of the corpus's own words. What is computed stands in every
    context alike, so that a name alone says nothing about it (passwords only named:
    nothing else makes a bare one a candidate). Other candidates nobody names have no label. Bounded at a few
    times ``sample`` rows, picked by hash among distinct texts and distinct candidates.
    """
    def picked(df: DataFrame, label: float) -> DataFrame:
        # a candidate counts once, however many rows hold it
        one = df.groupBy("candidate").agg(F.min(F.struct(F.xxhash64("before", "after"), "before", "after")).alias("c"))
        return one.orderBy(F.xxhash64("candidate", F.lit(5)), "candidate").limit(sample).select("candidate", "c.before", "c.after", F.lit(label).alias("label"))

    named = F.col("before").rlike(NAME_BEFORE)
    harmless = F.col("candidate").rlike(NO_SECRET)
    real = found.select("candidate", "before", "after")
    seen = [picked(real.where(named & ~harmless & F.col("candidate").rlike(r"\d")), 1.0),
            picked(real.where(harmless), 0.0)]
    h = F.sha2(F.col("text").cast("binary"), 256)
    texts = docs.select(text_or_empty().alias("text")).where("length(text) > 100").withColumn("k", F.xxhash64("text"))
    chosen = texts.select("k").distinct().orderBy(F.xxhash64("k", F.lit(5)), "k").limit(sample)  # copies count once
    pieces = (texts.join(F.broadcast(chosen), "k").select("k", F.substring("text", 1, 400).alias("text"), h.alias("h"))
              .groupBy("k").agg(F.min(F.struct("h", "text")).alias("t")).select("t.*"))
    w = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^a-z\s]+", ""), r"\s+"), lambda x: F.length(x) > 2)
    number = F.substring(F.conv(F.substring("h", 1, 15), 16, 10), 1, 6)
    pieces = pieces.withColumn("w", w).withColumn("number", number).where("size(w) >= 6")
    near = F.concat_ws(" ", F.slice("w", 5, 2))
    context = {"plain": (F.concat(near, F.lit(" ")), F.concat(F.lit(" "), near)),
               "named": (F.concat(near, F.lit(" api_key = \"")), F.concat(F.lit("\" "), near)),
               "quoted": (F.concat(near, F.lit(" \"")), F.concat(F.lit("\" "), near))}
    base64 = F.regexp_replace(F.base64(F.unhex("h")), "=+$", "")
    word, cased = F.get("w", F.lit(0)), F.initcap(F.get("w", F.lit(1)))
    everywhere, behind = ("plain", "named", "quoted"), ("named",)
    made = {"hex": (F.substring("h", 1, 40), 1.0, everywhere), "b64": (F.substring(base64, 2, 36), 1.0, everywhere),
            "short": (F.substring(base64, 5, 22), 1.0, everywhere),
            "dotted": (F.concat(F.substring(base64, 1, 14), F.lit("."), F.substring(base64, 15, 14), F.lit("."), F.substring(base64, 29, 14)), 1.0, everywhere),
            "password": (F.concat(cased, F.lit("!"), word, F.substring("number", 1, 4)), 1.0, behind),
            "symbols": (F.concat(F.substring(base64, 1, 6), F.lit("#"), F.substring(base64, 9, 5), F.lit("&"), F.substring("number", 1, 2)), 1.0, behind),
            "slug": (F.concat(F.concat_ws("-", F.slice("w", 1, 4)), F.lit("-"), "number"), 0.0, everywhere),
            "path": (F.concat(F.concat_ws("/", F.slice("w", 1, 4)), F.lit("/v"), F.substring("number", 1, 2)), 0.0, everywhere),
            "number": (F.concat(F.lit("4"), F.conv(F.substring("h", 1, 12), 16, 10), "number"), 0.0, everywhere),
            "joined": (F.concat(F.concat_ws("", F.slice("w", 1, 4)), F.substring("number", 1, 2)), 0.0, everywhere),
            "host": (F.concat(F.concat_ws(".", F.slice("w", 1, 3)), F.lit(".v"), F.substring("number", 1, 1)), 0.0, everywhere),
            "phrase": (F.concat_ws(" ", F.slice("w", 1, 4)), 0.0, behind), "plain": (F.concat(cased, word, F.lit(",")), 0.0, behind),
            "junk": (F.concat(word, F.lit("#%"), F.get("w", F.lit(2)), F.lit("*")), 0.0, behind)}
    rows = [F.struct(value.alias("candidate"), context[k][0].alias("before"), context[k][1].alias("after"), F.lit(label).alias("label"))
            for value, label, kinds in made.values() for k in kinds]
    derived = pieces.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("length(candidate) >= 8")
    return seen[0].unionByName(seen[1]).unionByName(derived)


def train(findings: DataFrame, words: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (bounded by their maker); None without both labels."""
    rows = with_features(findings, words).select("label", *FEATURES)
    # one sorted partition: bagging does not depend on how the rows were dealt
    rows = materialise(rows.coalesce(1).sortWithinPartitions("label", *FEATURES), "findings")
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    points = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, maxMemoryInMB=64).fit(points)
    # kept in the shared folder and read back: without the training summary, which holds the session
    path = work_dir(findings.sparkSession, "forest")
    model.write().overwrite().save(path)
    return RandomForestClassificationModel.load(path)


def judge(found: DataFrame, words: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` plus score (0 to 1). Without a model only named candidates score 1."""
    rows = with_features(found, words)
    if model is None:
        return rows.withColumn("score", F.col("f_named")).drop(*FEATURES)
    points = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(rows)
    model = model.setFeaturesCol("__features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__p")
    return model.transform(points).withColumn("score", vector_to_array("__p")[1]).drop(*FEATURES, "__features", "__p")


def scan(tagged: DataFrame, findings: DataFrame | None = None, key: str = UID) -> DataFrame:
    """Judged findings (key, candidate, start, occurrences, score): one per distinct candidate of a row.

    Every occurrence is judged where it stands; the highest score counts.
    """
    own = fresh("found")
    found = in_contexts(materialise(candidates(tagged, text_or_empty(), key).withColumn(own, F.monotonically_increasing_id()), "found"))
    words = materialise(dictionary(tagged), "dictionary")
    model = train(labelled_findings(tagged, found) if findings is None else findings, words)
    return judge(found, words, model).groupBy(own, key, "candidate", "start", "occurrences").agg(F.max("score").alias("score")).drop(own)


def secret_table(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct candidate of a document: doc_id, start (code points), length,
    occurrences, candidate_sha256, score, is_secret. Null and empty texts have none;
    repeated rows are reported each; an empty table gives an empty result."""
    judged = scan(docs.select("doc_id", "text"), findings, key="doc_id")
    return judged.select(
        "doc_id", "start", F.length("candidate").cast("long").alias("length"), "occurrences",
        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"), "score", (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every secret replaced by a mark (all its occurrences) and n_chars brought up to date.

    No row is dropped; texts without a secret are unchanged, null texts stay null.
    """
    tagged = with_row_ids(docs, "secrets")
    judged = scan(tagged, findings).where(F.col("score") >= threshold)
    # longest first, so that a secret inside a longer one does not break it up
    secrets = judged.groupBy(UID).agg(F.sort_array(F.collect_list(F.struct(F.length("candidate"), "candidate")), asc=False)["candidate"].alias("__secrets"))
    joined = tagged.join(secrets, UID, "left")
    text = F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(
        F.aggregate("__secrets", F.col("text"), lambda t, s: F.replace(t, s, F.lit(REDACTED))))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__secrets").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)
