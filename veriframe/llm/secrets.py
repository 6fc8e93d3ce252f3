"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are long runs of key characters with a digit, and values of any length
and alphabet that are assigned to a credential's name. Each is described by its length, its changes between character classes, how much of it common words cover,
whether it stands in a path, and the words beside it. A random forest trained on
labelled findings decides. Everything runs as built-in functions and Spark ML in
the JVM; texts are cut at their candidates, never looped over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.llm.common import col
from veriframe.session import durable

#: Names of credentials; in one place, as candidates, features and labels go by them.
_NAMES = r"token|passw(?:or)?d|pwd|secret|credential|api[_-]?key|access[_-]?key|auth|bearer"
CUE = rf"(?i)({_NAMES})"
#: Runs of at least 16 key characters with a digit, whole; possessive, so linear in the text.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: What follows a credential's name and ``=`` or ``:``, up to a blank, quote, bracket, comma or semicolon. Looks back 20 characters or so.
ASSIGNED = (
    r"(?<=[=:]\s{0,3}[\"'`]?)(?<=(?i:" + _NAMES + r")[\"'`]?\s{0,3}[=:]\s{0,3}[\"'`]?)"
    r"[^\s\"'`,;=:<>()\[\]{}][^\s\"'`,;<>()\[\]{}]*+"
)
CANDIDATE = f"{ASSIGNED}|{RUN}"
NEAR = 48  # characters of context on either side
SAMPLE = 5_000  # labelled findings the forest is trained on at most
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5

#: Published formats of access keys.
PROVIDERS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"
#: Parts of ordinary words and placeholders.
DICTIONARY = (
    "the", "and", "ing", "tion", "ment", "able", "com", "example", "test", "sample", "dummy", "change", "your",
    "here", "name", "page", "file", "data", "http", "www", "html", "user", "order", "item", "content", "index",
)
FEATURES = (
    "length", "digit_share", "upper_share", "changes", "case_changes", "distinct_share", "hex", "digits_only",
    "covered", "slashes", "dashes", "in_path", "extension", "cue_before", "assigned", "quoted", "cue_after", "words_before",
)
#: Where labels come from a name and an assignment, a forest that sees these would only learn the rule again.
_LABELLING = ("cue_before", "assigned", "quoted")


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: id, ``ordinal`` in its text (from 0), ``value``, ``before``, ``after``."""
    pattern = F.lit(CANDIDATE)
    cut = (
        df.select(col(id_col).alias("_id"), col(text_col).cast("string").alias("_text"))
        .filter(F.col("_text").rlike(CANDIDATE))
        .withColumns({
            "_values": F.regexp_extract_all("_text", pattern, F.lit(0)),
            # One piece more than values: what stands before, between and after them.
            "_pieces": F.split("_text", CANDIDATE, -1),
        })
    )
    return cut.select(
        "_id",
        F.posexplode(F.arrays_zip(
            F.col("_values").alias("value"),
            F.transform("_pieces", lambda p: F.right(p, F.lit(NEAR))).alias("before"),
            F.transform(
                F.slice("_pieces", F.lit(2), F.size("_values")), lambda p: F.left(p, F.lit(NEAR))
            ).alias("after"),
        )).alias("ordinal", "_c"),
    ).filter(F.col("_c.value").isNotNull()).select("_id", "ordinal", "_c.*")


def described(found: DataFrame) -> DataFrame:
    """Candidates with the forest's features, all plain expressions."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    n = F.length(v).cast("double")

    def times(pattern: str, c: Column = v) -> Column:
        return F.regexp_count(c, F.lit(pattern)).cast("double")

    def flag(c: Column) -> Column:
        return c.cast("double")

    plain = F.regexp_replace(F.lower(v), "|".join(DICTIONARY), "")
    return found.withColumns({
        "length": F.least(n, F.lit(256.0)),
        "digit_share": times("[0-9]") / n,
        "upper_share": times("[A-Z]") / n,
        "changes": times("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])") / n,
        "case_changes": times("[a-z](?=[A-Z])|[A-Z](?=[a-z])") / n,
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))).cast("double") / F.least(n, F.lit(64.0)),
        "hex": flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "digits_only": flag(v.rlike("^[0-9-]+$")),
        "covered": (n - F.length(plain)) / n,
        "slashes": times("/") / n,
        "dashes": times("[_-]") / n,
        "in_path": flag(before.rlike(r"[/\\.]$") | after.rlike(r"^[/\\]")),
        "extension": flag(after.rlike(r"^\.[a-z]{2,4}\b")),
        "cue_before": flag(before.rlike(CUE + r"\W*\w*\W*$")),
        "assigned": flag(before.rlike(r"[=:]\s{0,3}[\"']?$")),
        "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        "cue_after": flag(after.rlike(r"^\W*" + CUE)),
        "words_before": times(r"\p{L}+", before),
    })


def silver_label(found: DataFrame) -> Column:
    """Label of a finding that needs no reviewer: a published format, or a value assigned to a credential's name.

    Values of few different characters are placeholders, and numbers alone are no secrets.
    """
    named = F.col("value").rlike(PROVIDERS) | F.col("before").rlike(CUE + r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?$")
    varied = F.size(F.array_distinct(F.split("value", ""))) >= 7
    return (named & varied & ~F.col("value").rlike("^[0-9-]+$")).cast("double")


def fitted(
    labelled: DataFrame, sample: int = SAMPLE, features: Sequence[str] = FEATURES
) -> RandomForestClassificationModel | None:
    """A forest trained on ``features`` of findings and their ``label`` (0.0 or 1.0).

    At most ``sample`` findings, half of either label as far as there are, chosen by hash
    over all of them; rows without a label are left out. None if one label is missing: then
    there is nothing to learn. The sample is put in order in one partition, so that the same
    findings give the same forest.
    """
    known = labelled.filter(F.col("label").isNotNull()).select("label", "value", "before", *features)
    key = [F.xxhash64("value", "before"), F.col("value"), F.col("before")]
    half = [known.filter(F.col("label") == x).orderBy(*key).limit(sample // 2) for x in (0.0, 1.0)]
    chosen = durable(half[0].unionByName(half[1]).coalesce(1).sortWithinPartitions(*key), "findings")
    if chosen.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(features), outputCol="_features").transform(chosen)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        featureSubsetStrategy="sqrt",
    )
    return forest.fit(rows)


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per candidate: id, ``ordinal``, ``value``, ``before``, ``after``, ``probability``, ``secret``.

    ``labelled`` are reviewed findings (see :func:`fitted`); without them the table's own
    findings are labelled by :func:`silver_label`, and the forest judges by all features but
    those that this rule reads off the name and the assignment. Without two labels to learn from, the
    silver label is the verdict. Candidates the forest refuses stay in the result, with
    ``secret`` false, so that nothing vanishes.

    Null and empty texts have no candidates; repeated rows repeat theirs; other columns are
    not read; an empty table gives an empty one.
    """
    # Written once: training and judging then read the findings, not the texts again.
    found = durable(described(candidates(df, id_col, text_col)), "findings")
    known = labelled if labelled is not None else found.withColumn("label", silver_label(found))
    features = FEATURES if labelled is not None else tuple(f for f in FEATURES if f not in _LABELLING)
    model = fitted(known, features=features)
    if model is None:
        judged = found.withColumn("probability", silver_label(found))
    else:
        model.setFeaturesCol("_features")
        rows = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep").transform(found)
        judged = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    return judged.select(
        F.col("_id").alias(id_col), "ordinal", "value", "before", "after", "probability",
        (F.col("probability") >= threshold).alias("secret"),
    )
