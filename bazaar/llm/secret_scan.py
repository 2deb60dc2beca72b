"""Secret scans with a random forest that removes false positives.

Candidates are long runs of key characters. What each finding looks like is measured by built-in functions: its length
and character classes, the transitions between its characters (how much likelier they are in labelled secrets than in
other labelled findings), how much of it dictionary words cover (the most frequent words of the corpus), its path, and
the words beside it. A random forest is trained on labelled findings and scores all.

Labelled findings come from the caller as (doc_id, candidate, label). Where there are none, `seeded` labels the plain
cases: assigned to a key word and mixed of letters and digits, against words, numbers and findings that name a checksum.
Everything runs as DataFrame functions and Spark ML; training uses a bounded sample, everything else all rows.

Defined cases: null and empty texts have no finding; equal candidates of a document are one finding, with its first
position (from 1) and its count; rows that share a doc_id are read each; without labels of both classes the seed rule
decides; only doc_id, text and source are read; an empty table gives none.
"""

import math
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common

CANDIDATE = r"[A-Za-z0-9_+/=-]{16,}+"
KEY_WORDS = r"(?i)(token|secret|passw|passphrase|api.?key|access.?key|private|auth|bearer|credential)"
BENIGN_WORDS = r"(?i)(sha-?\d|md5|commit|checksum|digest|integrity|uuid|revision|example|placeholder)"
BENIGN_PATHS = r"(?i)(test|example|fixture|sample|doc|lock)"
#: Characters of candidates; others of a text never get here.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/=-"
FOLDS, HELD = 5, 0
LABELLED = 5_000  # learning findings of each class, about
WORDS = 256  # dictionary words

FEATURES = (
    "length", "digits", "capitals", "others", "class_changes", "transitions", "coverage", "benign_path", "path_depth",
    "key_word", "assigned", "quoted", "benign_word", "n",
)


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, source, candidate, start, n, and the text before and after its first occurrence."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").filter(F.col("text").rlike(CANDIDATE))
    rows = rows.select(
        "doc_id", "source", F.monotonically_increasing_id().alias("row"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.transform(F.split("text", CANDIDATE, -1), lambda g: F.struct(F.right(g, F.lit(48)).alias("end"), F.left(g, F.lit(16)).alias("begin"), F.length(g).alias("len"))).alias("gaps"),
    )
    rows = rows.select("doc_id", "source", "row", F.posexplode(F.arrays_zip("found", F.slice("gaps", 1, F.size("found")).alias("gap"), F.slice("gaps", 2, F.size("found")).alias("next"))).alias("i", "f"))
    return rows.select(
        "doc_id", "source", "row", "i", F.col("f.found").alias("candidate"), F.col("f.gap.len").alias("gap"),
        F.col("f.gap.end").alias("before"), F.col("f.next.begin").alias("after"),
    )


def located(rows: DataFrame) -> DataFrame:
    """One row per distinct candidate of a document row, with its first start and its count."""
    upto = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("candidate")).over(upto) - F.length("candidate") + 1
    placed = rows.withColumn("start", start)
    of = Window.partitionBy("row", "candidate")
    placed = placed.withColumn("n", F.count("*").over(of)).withColumn("first", F.min("i").over(of))
    return placed.filter("i = first").drop("i", "gap", "first", "row")


def dictionary(docs: DataFrame, words: int = WORDS) -> list[str]:
    """The most frequent words of the corpus, longest first."""
    every = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![a-z])[a-z]{3,6}(?![a-z])"), F.lit(0))).alias("word"))
    top = every.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words).collect()
    return sorted((r["word"] for r in top), key=lambda w: (-len(w), w))


def seeded() -> Column:
    """1 or 0 for plain cases, null for the rest."""
    c = F.col("candidate")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    plain = ~c.rlike("[0-9]") | ~c.rlike("[A-Za-z]") | F.col("before").rlike(BENIGN_WORDS)
    return F.when(plain, 0).when(mixed & F.col("before").rlike(KEY_WORDS + r"[^\n]{0,8}[=:]\s*.?$"), 1)


def _share(pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def described(rows: DataFrame, words: list[str], table: list[float]) -> DataFrame:
    """The findings with their FEATURES."""
    c, side = F.col("candidate"), len(ALPHABET) + 1
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    odds = F.array(*[F.lit(v) for v in table])
    code = lambda i: F.instr(F.lit(ALPHABET), F.substr(c, i, F.lit(1)))
    sum_ = F.aggregate(F.sequence(F.lit(1), F.length(c) - 1), F.lit(0.0), lambda s, i: s + F.element_at(odds, code(i) * side + code(i + 1) + 1))
    covered = F.regexp_replace(F.lower(c), "|".join(words), "") if words else F.lower(c)
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    values = {
        "length": F.length(c).cast("double"), "digits": _share("[0-9]"), "capitals": _share("[A-Z]"), "others": _share("[^A-Za-z0-9]"),
        "class_changes": (F.length(classes) - 1) / F.length(c), "transitions": sum_ / (F.length(c) - 1),
        "coverage": 1 - F.length(covered) / F.length(c), "benign_path": flag(F.col("source").rlike(BENIGN_PATHS)),
        "path_depth": F.coalesce(F.length(F.regexp_replace("source", "[^/]", "")), F.lit(0)).cast("double"),
        "key_word": flag(F.col("before").rlike(KEY_WORDS)), "assigned": flag(F.col("before").rlike(r"[=:]\s*.?$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        "benign_word": flag(F.col("before").rlike(BENIGN_WORDS)), "n": F.col("n").cast("double"),
    }
    return rows.select("doc_id", "candidate", "start", F.col("n").alias("occurrences"), *[v.alias(k) for k, v in values.items()])


def transition_odds(labelled: DataFrame) -> list[float]:
    """Per pair of characters, log odds of labelled secrets against other findings; a table of fixed size."""
    side = len(ALPHABET) + 1
    c = F.col("candidate")
    pairs = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substr(c, i, F.lit(2)))
    counts = labelled.select("label", F.explode(pairs).alias("pair")).groupBy("pair").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("yes"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("no")
    ).collect()  # pairs of ALPHABET
    yes, no = sum(r["yes"] for r in counts) + side * side, sum(r["no"] for r in counts) + side * side
    table = [0.0] * (side * side)
    for r in counts:
        a, b = (ALPHABET.find(x) + 1 for x in r["pair"])
        table[a * side + b] = math.log((r["yes"] + 1) / yes) - math.log((r["no"] + 1) / no)
    return table


def scan(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, candidate, start, occurrences, score, is_secret of every finding.

    labels: (doc_id, candidate, label). Documents of the held-out fold do not teach.
    """
    rows = common.saved(located(findings(docs)), "findings")
    labelled = rows.withColumn("label", seeded())
    if labels is not None:
        known = labels.select(F.col("doc_id").cast("long"), "candidate", F.col("label").cast("int")).dropna().groupBy("doc_id", "candidate").agg(F.max("label").alias("label"))
        labelled = rows.join(known, ["doc_id", "candidate"])
    labelled = labelled.filter(F.col("label").isNotNull() & (common.split_of(F.col("doc_id"), FOLDS) != HELD))
    n = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        score = F.coalesce(seeded(), F.lit(0)).cast("double")
        return rows.select("doc_id", "candidate", "start", F.col("n").alias("occurrences"), score.alias("score"), (score >= 0.5).alias("is_secret"))
    draw = F.pmod(F.xxhash64("doc_id", "candidate"), F.lit(1 << 20)) / float(1 << 20)
    drawn = reduce(lambda x, y: x | y, [(F.col("label") == v) & (draw < min(1.0, LABELLED / n[v])) for v in (0, 1)])
    sample = common.saved(labelled.filter(drawn), "labelled-findings")
    words, table = dictionary(docs), transition_odds(sample)
    train = common.saved(described(sample, words, table).join(sample.select("doc_id", "candidate", "label").distinct(), ["doc_id", "candidate"]), "training")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=40, maxDepth=6, seed=5, featureSubsetStrategy="sqrt")
    model = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(train)
    scored = model.transform(described(rows, words, table))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "candidate", "start", "occurrences", score.alias("score"), (score >= 0.5).alias("is_secret"))


def secrets(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The findings that stay, as positions and fingerprints instead of the secrets themselves."""
    kept = scan(docs, labels).filter("is_secret")
    return kept.select(
        "doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("fingerprint"), "occurrences", "score"
    )
