"""Secret scan whose false positives a random forest removes; DataFrame functions and Spark ML only.

Every run of 16 or more characters of base64, hex or identifier kind is a candidate, and so is whatever is assigned
to a secret's name (``password = "hunter2!x"``) or stands as the password of an address (``user:hunter2@host``), of
any length and with any signs.  The forest sees its length, its character transitions, how far the corpus's own
dictionary covers it, its path and its neighbouring words, and is trained on labelled findings.  ``review`` labels the findings whose nature their form gives away; callers with
reviewed findings pass those.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import scratch_path, stored, table
from medallion.llm.registry import query

SHORTEST_VALUE = 16
# Names whose value is a candidate whatever it looks like.
ASSIGNED_NAMES = ["password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private_key", "credential"]
# What stands before such a value.  Looked for behind signs that few words have before them, so prose costs little.
SIGN = r"(?<=[=:\s\"'])(?<=[=:]\s{0,2}[\"']{0,1})"
ASSIGNMENT = SIGN + r"(?<=(?i:" + "|".join(ASSIGNED_NAMES) + r")[\"']{0,1}\s{0,2}[=:]\s{0,2}[\"']{0,1})"
VALUE = r"[^\s\"'`,;&<>(){}\[\]]*[^\s\"'`,;&<>(){}\[\].:!?]"
LOGIN = r"(?<=:)(?<=://[^\s/:@]{1,64}:)"
CANDIDATE = rf"((?:{ASSIGNMENT}{VALUE}|{LOGIN}[^\s/@]+(?=@)|[A-Za-z0-9+/_\-]{{{SHORTEST_VALUE},}}={{0,2}}))"
# A gap and the value after it are this long on average: an assigned value has its name before it.
SHORTEST_PAIR = 4
BEFORE, AFTER = 64, 32
# Words of the dictionary: this long, this often in the corpus.
SHORTEST, LONGEST, LEAST_COUNT = 3, 15, 5
# Bound of the labelled findings that the forest is fitted on, chosen by hash.
MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 20, 6, 17
MASK = "[secret]"

# Words that stand beside a secret, words that stand beside a harmless value, parts of harmless paths.
SECRET_NAMES = ["secret", "token", "password", "passwd", "pwd", "key", "apikey", "api", "auth", "credential", "private", "bearer", "access"]
HARMLESS_NAMES = ["example", "sample", "dummy", "test", "fake", "placeholder", "checksum", "sha", "md5", "digest", "commit", "uuid", "revision"]
HARMLESS_PATHS = ["test", "example", "sample", "doc", "fixture", "vendor"]
# The forms in which issuers write keys.
ISSUED = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^(sk|rk|pk)_(live|test)_[A-Za-z0-9]{16,}$"
          r"|^xox[abprs]-[A-Za-z0-9-]{16,}$|^AIza[A-Za-z0-9_-]{35}$|^eyJ[A-Za-z0-9_-]{16,}$")

# A path: two segments or more that are words, each this long at most.  What stands before a value in its path, back
# to a sign that no path has.
SEGMENT = r"^[A-Z]?[a-z]{3,}+(?:[._-]?[A-Z][a-z]++|[._-][a-z]++|[._-]?[0-9]{1,4}+(?![0-9])[a-z]*+)*+$"
LONGEST_SEGMENT = 64
# E-mail addresses and host names, whose parts are no words beside a value.
ADDRESS = r"\S*@\S*|(?:[A-Za-z0-9-]+\.)+[A-Za-z0-9-]+"
LEAD = r"([^\s=:?&,;()<>\[\]{}\"'`|]*)$"

FEATURES = ["length", "switches", "switch_share", "digit_share", "upper_share", "distinct_share", "transition",
            "coverage", "in_path", "harmless_path", "secret_name", "harmless_name", "assigned"]


def _any_of(names: list[str]) -> str:
    return r"(?i)(^|[^a-z])(" + "|".join(names) + r")"


def _whole(names: list[str]) -> str:
    return r"(?i)(^|[^\p{L}])(" + "|".join(names) + r")s?([^\p{L}]|$)"


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``finding, doc_id, path, line, column, value, before, after`` of every candidate; lines and columns from 1.

    Contexts stay in the line.  Repeated rows give repeated findings once; null and empty texts give none.
    """
    docs = docs.select("doc_id", "text", (F.col(path) if path else F.lit("")).cast("string").alias("path"))
    lines = (docs.where(F.col("text").rlike(CANDIDATE))
             .select("doc_id", "path", F.posexplode(F.split("text", "\n")).alias("at", "text")).where(F.col("text").rlike(CANDIDATE)))
    # A line is cut once: gap, value, gap, ..., gap.  Columns are running lengths of the pieces, and contexts come from
    # the pieces next to a value, so a line of many candidates costs as much as as many lines.
    lines = lines.select("doc_id", "path", "at", F.monotonically_increasing_id().alias("row"),
                         F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(1)).alias("values"), F.split("text", CANDIDATE).alias("gaps"))
    near = BEFORE // SHORTEST_PAIR + 1

    def context(i):
        back = F.sequence(F.greatest(F.lit(0), i - near), i)
        ahead = F.sequence(i + 1, F.least(i + 1 + AFTER // SHORTEST_PAIR + 1, F.size("gaps") - 1))
        before = F.array_join(F.transform(back, lambda j: F.concat(
            F.when(j > i - near, F.right(F.coalesce(F.get("values", j - 1), F.lit("")), F.lit(BEFORE))).otherwise(""),
            F.right(F.get("gaps", j), F.lit(BEFORE)))), "")
        after = F.array_join(F.transform(ahead, lambda j: F.concat(
            F.left(F.get("gaps", j), F.lit(AFTER)), F.left(F.coalesce(F.get("values", j), F.lit("")), F.lit(AFTER)))), "")
        return F.struct(F.get("values", i).alias("value"), F.length(F.get("gaps", i)).alias("gap"),
                        F.right(before, F.lit(BEFORE)).alias("before"), F.left(after, F.lit(AFTER)).alias("after"))

    hits = lines.select("doc_id", "path", "at", "row", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("values") - 1), context)).alias("i", "hit"))
    until = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)  # the candidates of one line
    passed = F.coalesce(F.sum(F.col("hit.gap") + F.length("hit.value")).over(until), F.lit(0))
    found = hits.select(
        "doc_id", F.coalesce("path", F.lit("")).alias("path"), (F.col("at") + 1).alias("line"),
        (passed + F.col("hit.gap") + 1).cast("int").alias("column"), F.col("hit.value").alias("value"), "hit.before", "hit.after")
    return stored(found.distinct().withColumn("finding", F.monotonically_increasing_id()))


def dictionary(docs: DataFrame) -> DataFrame:
    """``word, n``: lower-case words of the whole corpus with their counts, without rare ones."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")).alias("word")
    return (docs.select(word).where(F.length("word").between(SHORTEST, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def _pieces(value, size: int):
    """All runs of ``size`` characters of a value, lower-cased; digits count as one."""
    plain = F.regexp_replace(F.lower(value), "[0-9]", "0")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(plain) - size + 1)), lambda i: F.substring(plain, i, F.lit(size)))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``; ``words`` is the corpus's dictionary.

    ``transition``: mean log10 probability of each character after the one before it, in dictionary words.
    ``coverage``: share of the value's characters in letter runs that are dictionary words or made of two.
    """
    words = stored(words)
    pairs = words.select("n", F.explode(_pieces(F.col("word"), 2)).alias("pair")).where("length(pair) = 2")
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    firsts = pairs.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    chance = stored(pairs.join(firsts, F.substring("pair", 1, 1) == F.col("first")).select("pair", F.log10((F.col("n") + 1) / (F.col("total") + 64)).alias("p")))
    moves = (found.select("finding", F.explode(_pieces(F.col("value"), 2)).alias("pair"))
             .join(chance, "pair", "left").groupBy("finding").agg(F.avg(F.coalesce("p", F.lit(-6.0))).alias("transition")))

    runs = found.select("finding", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(r"([a-z]{3,})"), F.lit(1))).alias("run"))
    cuts = F.transform(F.sequence(F.lit(SHORTEST), F.greatest(F.lit(SHORTEST), F.length("run") - SHORTEST)), lambda i: F.struct(
        F.substring(F.col("run"), F.lit(1), i).alias("left"), F.substring(F.col("run"), i + 1, F.length("run")).alias("right")))
    runs = runs.where(F.length("run") <= 2 * LONGEST).distinct()
    known = words.select("word")
    cut = runs.select("finding", "run", F.explode(cuts).alias("cut")).select("finding", "run", "cut.*")
    whole = runs.join(known, runs.run == known.word, "left_semi")
    double = cut.join(known, cut.left == known.word, "left_semi").join(known, cut.right == known.word, "left_semi").select("finding", "run")
    covered = whole.union(double).distinct().groupBy("finding").agg(F.sum(F.length("run")).alias("covered"))

    size = F.length("value")
    closest = F.regexp_extract("before", r"(\S*\s*\S*\s*\S*)$", 1)
    following = F.regexp_extract("after", r"^(\s*\S*\s*\S*\s*\S*)", 1)
    beside = F.regexp_replace(F.concat(closest, F.lit(" "), following), ADDRESS, " ")
    segments = F.split(F.concat(F.regexp_extract("before", LEAD, 1), "value"), "/")
    is_word = lambda x: (F.length(x) <= LONGEST_SEGMENT) & x.rlike(SEGMENT)
    switch = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_=-])(?=[^+/_=-])"
    return (found.join(moves, "finding", "left").join(covered, "finding", "left")
            .withColumn("length", size.cast("double"))
            .withColumn("switches", F.regexp_count("value", F.lit(switch)).cast("double"))
            .withColumn("switch_share", F.col("switches") / size)
            .withColumn("digit_share", F.regexp_count("value", F.lit("[0-9]")) / size)
            .withColumn("upper_share", F.regexp_count("value", F.lit("[A-Z]")) / size)
            .withColumn("distinct_share", F.size(F.array_distinct(_pieces(F.col("value"), 1))) / size)
            .withColumn("transition", F.coalesce("transition", F.lit(-6.0)))
            .withColumn("coverage", F.coalesce("covered", F.lit(0)) / size)
            .withColumn("in_path", (F.size(F.filter(segments, is_word)) >= 2).cast("double"))
            .withColumn("harmless_path", F.col("path").rlike(_any_of(HARMLESS_PATHS)).cast("double"))
            .withColumn("secret_name", (closest.rlike(_any_of(SECRET_NAMES)) | F.col("before").rlike(LOGIN + "$")).cast("double"))
            .withColumn("harmless_name", beside.rlike(_whole(HARMLESS_NAMES)).cast("double"))
            .withColumn("assigned", F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double")).drop("covered"))


def review(found: DataFrame) -> DataFrame:
    """``finding, label`` of findings whose nature is plain: issued forms and assigned mixed values are secrets;
    values of letters or digits alone, in paths, or beside a harmless name are not.  Others get no label, nor do
    assigned values that are paths."""
    value, in_path = F.col("value"), F.col("in_path") == 1
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    named = (F.col("assigned") == 1) & (F.col("secret_name") == 1) & mixed
    label = (F.when(value.rlike(ISSUED), 1).when(named & in_path, F.lit(None)).when((F.col("harmless_name") == 1) & ~named, 0)
             .when(named, 1).when(value.rlike(r"^[A-Za-z]+$|^[0-9+_\-]+$") | in_path, 0))
    return found.select("finding", label.cast("double").alias("label")).where("label is not null")


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """Findings with ``probability`` and ``is_secret`` (0.5 or more), and the features they were judged by.

    ``labelled``: reviewed findings ``doc_id, value, label``; by default ``review`` labels them.  With labels of
    one kind only (or none), findings take that kind (or count as secrets, to be looked at).
    """
    found = stored(features(candidates(docs, path), dictionary(docs)))
    if labelled is None:
        labels = review(found)
    else:
        labels = found.join(labelled.select("doc_id", "value", "label"), ["doc_id", "value"]).select("finding", F.col("label").cast("double").alias("label"))
    labels = stored(labels.groupBy("finding").agg(F.max("label").alias("label")))
    kinds = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    if len(kinds) < 2:
        return found.withColumn("probability", F.lit(float(next(iter(kinds), 1.0)))).withColumn("is_secret", F.col("probability") >= 0.5)
    total = sum(kinds.values())
    share = MAX_TRAIN / max(total, MAX_TRAIN)
    chosen = labels.where(F.pmod(F.xxhash64("finding"), F.lit(1_000_000)) < round(share * 1_000_000))
    weight = F.when(F.col("label") == 1, total / kinds[1.0]).otherwise(total / kinds[0.0])
    fitted = stored(found.join(chosen, "finding").withColumn("weight", weight).repartition(4).sort("doc_id", "line", "column"))
    if fitted.select("label").distinct().count() < 2:
        fitted = stored(found.join(labels, "finding").withColumn("weight", weight))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    # Saved and loaded, for a fitted model holds its training summary and with it the session, which cannot be
    # sent to executors once an Observation has been used in it.
    path = scratch_path(docs.sparkSession)
    forest.fit(vectors.transform(fitted)).save(path)
    judged = RandomForestClassificationModel.load(path).transform(vectors.transform(found))
    judged = (judged.withColumn("probability", vector_to_array("probability")[1]).withColumn("is_secret", F.col("probability") >= 0.5)
              .drop("features", "rawPrediction", "prediction"))
    return stored(judged)


def redact(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by a mask, its columns and rows unchanged otherwise; ``n_chars`` follows.

    A secret is masked wherever its document holds it; one of fewer than ``SHORTEST_VALUE`` characters only where no
    letter or digit stands beside it.  Rows without an id are known by a hash of their text.
    """
    key, own, held = "_medallion_key", "_medallion_id", "_medallion_values"
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))
    found = scan(keyed.withColumn("doc_id", F.col(key)), path=path)
    values = found.where("is_secret").groupBy(F.col("doc_id").alias(own)).agg(F.collect_set("value").alias(held))
    longest_first = F.array_sort(held, lambda a, b: F.length(b) - F.length(a))

    def masked(text, value):
        quoted = F.concat(F.lit(r"\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        alone = F.concat(F.lit(r"(?<![\p{L}\p{N}])"), quoted, F.lit(r"(?![\p{L}\p{N}])"))
        return F.when(F.length(value) < SHORTEST_VALUE, F.regexp_replace(text, alone, F.lit(MASK))).otherwise(F.replace(text, value, F.lit(MASK)))

    clean = F.aggregate(longest_first, F.col("text"), masked)
    joined = keyed.join(values, F.col(key) == F.col(own), "left")
    fixed = joined.withColumn("text", F.when(F.col(held).isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        fixed = fixed.withColumn("n_chars", F.when(F.col(held).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return fixed.select(docs.columns)


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), path="source")
    return found.select("doc_id", "line", "column", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("int").alias("n_chars"),
                        *[x for x in FEATURES if x != "length"], "probability", "is_secret")
