"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of twelve or more key characters with a digit in it, or ``LEAST_ASSIGNED`` or more characters of
any kind that a key word assigns; a word may hold several, told apart by their ``offset`` in it. The forest, trained on a labelled
findings table, sees its length, the mix of its characters and how often their class changes, how much of
it dictionary words cover, whether it looks like a path or address, and the words around it. The
dictionary is the most frequent plain words of the whole corpus, ``DICTIONARY`` of them.

Only DataFrame operations run here, and Spark's own forest; training takes at most ``MOST_FINDINGS`` findings, those of
the smallest hash.

Defined results: null and empty texts have no candidates; a null doc_id stays null; repeated rows are found as
often as they are there; labels that are null are left out; without findings of both labels nothing is
removed (probability 1); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.common import WHITESPACE, save, text_or_empty

CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+"
DICTIONARY, LEAST_LETTERS = 200, 3
MOST_FINDINGS = 20_000
NEIGHBOURS = 64
TREES, DEPTH, SEED = 40, 8, 17
LIKELY = 0.5

SHAPES = [
    "length",
    "digits",
    "upper",
    "lower",
    "hex",
    "distinct",
    "runs",
    "covered",
    "slashes",
    "is_path",
    "quoted",
    "assigned",
]

# Formats that are secrets wherever they stand, and key words before a value that make it one: fixed values.
KNOWN_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{24})$"
KEY_WORDS = r"(?i:pass(?:word|wd)?|secret|token|api_?key|access_?key|auth|credential)"
QUOTES = r"[\"'`\\]{0,2}"
ASSIGNS = rf"{KEY_WORDS}(?i:orization|key|id|s)?(?:[_0-9-][A-Za-z0-9_-]{{0,32}})?{QUOTES}\s?[=:]{{1,2}}>?\s?{QUOTES}"
LEAST_ASSIGNED = 4
PART = r"[^\s\"'`,;=&?(){}\[\]\\]"
# Bounded, and up to what ends a value in text, JSON, URLs and CSV.
VALUE = rf"(?![=:])[^\s\"'`,;&<>(){{}}\[\]\\]{{{LEAST_ASSIGNED},}}+"
ANY_CANDIDATE = rf"{CANDIDATE}|(?<={ASSIGNS}){VALUE}"
# The same without looking back, to find words worth a look; words may be further apart.
MAYBE = f"{CANDIDATE}|{ASSIGNS}{VALUE}".replace(r"\s?", r"\s*")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, place, word, before, before_2, after, value, offset): each candidate with its word, where it begins in
    it, and the words around."""
    found = docs.select("doc_id", text_or_empty().alias("text")).filter(F.col("text").rlike(MAYBE))
    words = found.select("doc_id", F.split("text", WHITESPACE).alias("words"))

    def word(place: Column) -> Column:
        return F.coalesce(F.get("words", place), F.lit(""))

    def ahead(place: Column) -> Column:
        return F.concat(word(place - 2), F.lit(" "), word(place - 1), F.lit(" "))

    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.rlike(F.concat(ahead(i), word(i)), F.lit(MAYBE))
    )
    at = words.select("doc_id", "words", F.explode(places).alias("place"))
    place = F.col("place")
    near = at.select(
        "doc_id",
        place.cast("long").alias("place"),
        word(place).alias("word"),
        F.lower(word(place - 1)).alias("before"),
        F.lower(word(place - 2)).alias("before_2"),
        F.lower(word(place + 1)).alias("after"),
        ahead(place).alias("ahead"),
    )
    # What stands between the candidates tells where each begins.
    said = F.concat("ahead", "word")
    parts = near.withColumns({"all": F.regexp_extract_all(said, F.lit(ANY_CANDIDATE), F.lit(0)), "rest": F.split(said, ANY_CANDIDATE)})
    each = parts.select("*", F.posexplode("all").alias("k", "value"))
    begin = F.length(F.array_join(F.slice("rest", 1, F.col("k") + 1), "")) + F.length(F.array_join(F.slice("all", 1, F.col("k")), ""))
    each = each.withColumn("offset", begin - F.length("ahead")).filter("offset >= 0")
    return each.select("doc_id", "place", "word", "before", "before_2", "after", "value", "offset")


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent plain words of the corpus; ``size`` of them reach the driver."""
    words = docs.select(F.explode(F.split(text_or_empty(), WHITESPACE)).alias("word"))
    plain = words.filter(F.col("word").rlike(f"^[a-z]{{{LEAST_LETTERS},}}$"))
    most = plain.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r.word for r in most.collect()]


def _left() -> Column:
    """What stands before the value in its word."""
    return F.expr("substr(word, 1, offset)")


def _share(pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def described(found: DataFrame, known_words: list[str]) -> DataFrame:
    """Adds the numbers and neighbouring words that the forest sees."""
    classes = reduce(
        lambda column, x: F.regexp_replace(column, *x), [("[A-Z]", "A"), ("[a-z]", "b"), ("[0-9]", "1")], F.col("value")
    )
    left = reduce(lambda column, w: F.replace(column, F.lit(w), F.lit("")), sorted(known_words, key=len, reverse=True), F.lower("value"))
    letters = F.split("value", "")
    ahead, behind = _left(), F.expr("substr(word, offset + length(value) + 1)")
    # Of a word with several values, the part that this one stands in.
    value = F.concat(F.regexp_extract(ahead, rf"{PART}*$", 0), "value", F.regexp_extract(behind, rf"^{PART}*", 0))
    value = F.regexp_replace(value, r"[\"'`,;.*#$%&!|<>]+$", "")
    assigns = r"[=:]>?[\"'`\\]*$"
    return found.withColumns(
        {
            "length": F.length("value").cast("double"),
            "digits": _share("[0-9]"),
            "upper": _share("[A-Z]"),
            "lower": _share("[a-z]"),
            "hex": _share("[0-9a-fA-F]"),
            "distinct": F.size(F.array_distinct(letters)) / F.size(letters),
            "runs": F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / F.length("value"),
            "covered": 1 - F.length(left) / F.length("value"),
            "slashes": _share("[/]"),
            "is_path": (value.rlike(r"://|^/|\.[a-z]{2,4}$|@")).cast("double"),
            "quoted": (ahead.rlike("[\"'`]$") | behind.rlike("^\\\\?[\"'`]")).cast("double"),
            "assigned": (ahead.rlike(assigns) | (ahead.rlike("^[\"'`]*$") & F.col("before").rlike("[=:]$"))).cast("double"),
            "around": F.array(
                F.concat(F.lit("b:"), "before"),
                F.concat(F.lit("c:"), "before_2"),
                F.concat(F.lit("a:"), "after"),
                F.concat(F.lit("k:"), F.regexp_extract(ahead, r"([A-Za-z_]+)[\"'`\\]*[=:]+>?[\"'`\\]*$", 1)),
            ),
        }
    )


def labelled_by_rule(found: DataFrame) -> DataFrame:
    """A findings table where there is none: known formats, and values that a key word is assigned, are secrets."""
    assigned = F.concat_ws(" ", "before_2", "before", _left()).rlike(f"{ASSIGNS}$")
    return found.withColumn("label", (F.col("value").rlike(KNOWN_FORMATS) | assigned).cast("double"))


class SecretForest:
    """The forest, trained on (value, word, before, before_2, after, label) findings, and the value's
    offset in the word if there is one; else it is where the value first stands in it."""

    def __init__(self, findings: DataFrame, known_words: list[str], most: int = MOST_FINDINGS):
        self.words = known_words
        if "offset" not in findings.columns:
            findings = findings.withColumn("offset", F.greatest(F.expr("instr(word, value)") - 1, F.lit(0)))
        order = F.xxhash64("value", "word", "before", "before_2", "after", "offset")
        # Equal findings say the same, however often they are found.
        kept = findings.filter("label is not null").select("value", "word", "before", "before_2", "after", "offset", "label")
        sample = save(kept.distinct().orderBy(order, "label").limit(most), "secret-findings")
        self.model: PipelineModel | None = None
        if sample.select("label").distinct().count() > 1:
            around = HashingTF(inputCol="around", outputCol="neighbours", numFeatures=NEIGHBOURS, binary=True)
            assembled = VectorAssembler(inputCols=[*SHAPES, "neighbours"], outputCol="features")
            forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
            self.model = Pipeline(stages=[around, assembled, forest]).fit(described(sample, known_words))

    def scored(self, found: DataFrame) -> DataFrame:
        """Adds ``probability`` and ``is_secret`` to candidates."""
        columns = found.columns
        if self.model is None:
            scored = found.withColumn("chance", F.lit(1.0))
        else:
            scored = self.model.transform(described(found, self.words)).withColumn("chance", vector_to_array("probability")[1])
        return scored.select(*columns, F.col("chance").alias("probability"), (F.col("chance") >= LIKELY).alias("is_secret"))


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``docs`` with its probability and verdict; ``findings`` are labelled by rule if not given."""
    found = save(candidates(docs), "secret-candidates")
    forest = SecretForest(labelled_by_rule(found) if findings is None else findings, dictionary(docs))
    return forest.scored(found)
