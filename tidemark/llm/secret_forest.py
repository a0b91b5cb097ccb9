"""Secrets in texts: candidates by pattern, false positives removed by random forests.

Everything runs on DataFrame functions. One pass finds the candidates of all whole
texts with the words around them: values of any length that are assigned to a
credential's name, headers of private keys, and runs of 16 or more characters. A second
counts in how many documents each word occurs; the DICTIONARY_WORDS commonest are the
dictionary, and how their letters follow each other is the table of transitions.

Two forests look at two views. The first sees the candidate alone: its length, how
likely its character transitions are by that table, its variety and kinds of characters,
how much of it the dictionary covers, and its shape as a path. It learns from labelled
findings. The second sees what is around: a name, an assignment, quotes, a path that
leads there, and the CONTEXT_WORDS commonest neighbouring words of findings. It learns
from the findings, labelled or not, that the first is sure of. The odds of both are
multiplied, so that a value of a secret's form needs no name beside it, and a name
beside a path or a word is not enough.

`labelled_by_format` labels by what stands around a finding: values assigned to a
credential's name are secrets, and so are headers of private keys (which always score
1); what follows a path or a harmless word is none, and neither are plain numbers,
hosts, placeholders and runs of words. Findings in between are judged by what the
forests have learnt. Another source of labelled findings can be passed instead.

Defined results: null and empty texts have no candidates. A candidate that repeats is
a finding each time. Without labelled findings of both kinds nothing is removed and
the score is 0.5. Offsets and lengths are in code points. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

_MARK = "\x01"
BEFORE, AFTER = 48, 24
DICTIONARY_WORDS, WORD_DOCUMENTS = 2_000, 3
# Labelled findings of each kind that the forest is fitted on at most.
SAMPLE_ROWS = 4_000
TREES, DEPTH = 40, 8
# The first forest is sure of a finding at this score or above, or at as little below.
SURE_AT = 0.9
CONTEXT_WORDS = 48
SECRET_AT = 0.5

# Names of credentials, and words beside what is none.
CREDENTIAL_WORDS = "token|secret|password|passwd|pwd|api_?key|apikey|access_?key|auth|bearer|credential"
HARMLESS_WORDS = "example|sample|dummy|placeholder|test|checksum|commit|uuid|sha|isbn|version|call|card"


# Candidates: headers of private keys, values assigned to a credential's name, and runs
# of at least 16 such characters. What is before a value is its name, up to =.
_RUN = "[A-Za-z0-9+/_=.-]"
_PART = "[A-Za-z0-9+/_.-]"
PEM = "-----BEGIN (?:[A-Z0-9]++ ){0,4}PRIVATE KEY(?: BLOCK)?-----"
_CREDENTIAL = (
    f"(?<![A-Za-z0-9_.-])(?>[A-Za-z0-9_.-]*?(?i:{CREDENTIAL_WORDS})(?!(?i:ors?)\\b))"
    "[A-Za-z0-9_.-]*+[\"'`]?+\\s{0,4}(?::=|=>|[:=])\\s{0,4}(?i:(?:bearer|basic)\\s{1,4})?+[\"'`]?+"
)
_VALUE = "|".join(
    [f"(?<={q})[^\\n]+?(?<!\\\\)(?={q})" for q in "\"'`"]
    + ["[^\\s\"'`,;]+?(?=[\\s\"'`,;]|&\\w+=|\\z)"]
)
# A name of 16 or more characters that holds a digit may itself be what is looked for.
_NAMES = (
    "(?:(?:[A-Za-z_][A-Za-z_.-]*+|"
    f"(?!{_PART}{{16}})[A-Za-z_][A-Za-z0-9_.-]*+)=++(?={_PART})){{0,4}}+"
)
# Groups 1, 3 and 6 go before the candidate, which is group 2, 4, 5 or 7.
CANDIDATE = (
    f"({_CREDENTIAL})({_VALUE})"
    f"|(?<!{_RUN})(?={_RUN}{{16}})(?={_RUN}*[0-9])({_NAMES})({_RUN}+)"
    f"|({PEM})"
    f"|(?<!{_RUN})({_NAMES})({_RUN}{{16,}})"
)


def candidates(docs: DataFrame) -> DataFrame:
    """Stored candidates: row, doc_id, start, candidate, before, after."""
    text = F.translate(F.col("text").cast("string"), _MARK, " ")
    marked = F.regexp_replace(text, CANDIDATE, f"$1$3$6{_MARK}$2$4$5$7{_MARK}")
    parts = F.split("marked", _MARK)

    def one(k: Column) -> Column:
        gap, own, rest = F.get("parts", 2 * k), F.get("parts", 2 * k + 1), F.get("parts", 2 * k + 2)
        # A name before = can be a candidate of its own.
        near = [F.coalesce(F.get("parts", 2 * k - j), F.lit("")) for j in (2, 1)] + [gap]
        before = F.concat(*[F.right(p, F.lit(BEFORE)) for p in near])
        return F.struct(
            k.alias("nth"),
            F.char_length(gap).alias("gap"),
            own.alias("candidate"),
            F.right(before, F.lit(BEFORE)).alias("before"),
            F.left(rest, F.lit(AFTER)).alias("after"),
        )

    found = F.floor(F.size("parts") / 2).cast("int")
    earlier = Window.partitionBy("row").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("gap") + F.char_length("candidate")
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            marked.alias("marked"),
        )
        .withColumn("parts", parts)
        .filter(F.size("parts") > 1)
        .select("row", "doc_id", F.explode(F.transform(F.sequence(F.lit(0), found - 1), one)).alias("c"))
        .select("row", "doc_id", "c.*")
        .withColumn("start", F.col("gap") + F.coalesce(F.sum(step).over(earlier), F.lit(0)))
        .drop("nth", "gap"),
        "candidates",
    )


def dictionary(docs: DataFrame) -> list[tuple[str, int]]:
    """The words that occur in most documents, DICTIONARY_WORDS at most, and in how many.

    What occurs in fewer than WORD_DOCUMENTS may be a piece of a candidate.
    """
    words = F.regexp_extract_all(
        F.lower("text"), F.lit("(?<![a-z])[a-z]{4,12}(?![a-z])"), F.lit(0)
    )
    top = (
        docs.select(F.explode(F.array_distinct(words)).alias("word"))
        .groupBy("word")
        .count()
        .filter(F.col("count") >= WORD_DOCUMENTS)
        .orderBy(F.desc("count"), "word")
        .limit(DICTIONARY_WORDS)
    )
    return [(r["word"], r["count"]) for r in top.collect()]


# Letters are 1 to 26, all other characters 0.
_KINDS = 27


def transitions(words: list[tuple[str, int]]) -> list[float]:
    """Logarithms of how often a character follows another in the words, all pairs."""
    counts = [[1.0] * _KINDS for _ in range(_KINDS)]
    for word, n in words:
        kinds = [ord(c) - 96 for c in word]
        for a, b in zip(kinds, kinds[1:]):
            counts[a][b] += n
    return [math.log(n / sum(row)) for row in counts for n in row]


def _likelihood(candidate: Column, table: list[float]) -> Column:
    """Mean logarithm of the likelihood of a candidate's character transitions."""
    kind = F.transform(
        F.split(F.lower(candidate), ""),
        lambda c: F.when(c.between("a", "z"), F.ascii(c) - 96).otherwise(0),
    )
    likely = F.array(*[F.lit(x) for x in table])
    pairs = F.zip_with(kind, F.slice(kind, 2, F.greatest(F.size(kind) - 1, F.lit(0))),
                       lambda a, b: F.get(likely, a * _KINDS + b))
    total = F.aggregate(
        pairs, F.lit(0.0), lambda x, y: x + F.coalesce(y, F.lit(0.0))
    )
    return total / F.greatest(F.size(kind) - 1, F.lit(1))


# What the second forest sees besides the neighbouring words; the first sees the rest.
AROUND = ["f_after_path", "f_credential", "f_harmless", "f_assigned", "f_quoted",
          "f_words_before", "f_words_after"]


def features(found: DataFrame, counted: list[tuple[str, int]]) -> tuple[DataFrame, list[str]]:
    """The findings with their features, and the features' names."""
    words = [word for word, _ in counted]
    candidate, before, after = F.col("candidate"), F.lower("before"), F.lower("after")
    length = F.char_length(candidate)

    def share(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(candidate, f"[^{pattern}]", "")) / length

    kinds = F.regexp_replace(candidate, "[a-z]", "a")
    kinds = F.regexp_replace(F.regexp_replace(kinds, "[A-Z]", "A"), "[0-9]", "0")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    letters = F.filter(F.split(F.lower(candidate), "[^a-z]+"), lambda w: F.char_length(w) >= 3)
    known = F.array(*[F.lit(w) for w in words]) if words else F.lit(None).cast("array<string>")
    covered = F.aggregate(
        F.filter(letters, lambda w: F.coalesce(F.array_contains(known, w), F.lit(False))),
        F.lit(0),
        lambda total, w: total + F.char_length(w),
    )
    columns = {
        "f_length": length,
        "f_transitions": _likelihood(candidate, transitions(counted)),
        "f_changes": (F.char_length(runs) - 1) / length,
        "f_longest_run": F.array_max(
            F.transform(F.split(kinds, "(?<=(.))(?!\\1)"), lambda s: F.char_length(s))
        ),
        "f_variety": F.size(F.array_distinct(F.split(candidate, ""))),
        "f_digits": share("0-9"),
        "f_upper": share("A-Z"),
        "f_hex": share("0-9a-f"),
        "f_symbols": share("+/_=."),
        "f_dictionary": covered / length,
        "f_slashes": length - F.char_length(F.replace(candidate, F.lit("/"), F.lit(""))),
        "f_dashes": length - F.char_length(F.replace(candidate, F.lit("-"), F.lit(""))),
        "f_dots": length - F.char_length(F.replace(candidate, F.lit("."), F.lit(""))),
        "f_after_path": before.rlike("(://|[/@~])$").cast("int"),
        "f_credential": before.rlike(f"({CREDENTIAL_WORDS})[^\\n]{{0,12}}$").cast("int"),
        "f_harmless": before.rlike(f"\\b({HARMLESS_WORDS})\\b[^\\n]{{0,12}}$").cast("int"),
        "f_assigned": before.rlike("[=:]>?\\s*(bearer |basic )?[\"'`]?$").cast("int"),
        "f_quoted": (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("int"),
        "f_words_before": F.size(F.filter(F.split(before, "[^a-z]+"), lambda w: w != "")),
        "f_words_after": F.size(F.filter(F.split(after, "[^a-z]+"), lambda w: w != "")),
    }
    return found.withColumns({n: c.cast("double") for n, c in columns.items()}), list(columns)


def labelled_by_format(described: DataFrame) -> DataFrame:
    """Findings with a label (1 secret, 0 none) where the format leaves no doubt."""
    secret = (F.col("f_credential") == 1) & (F.col("f_assigned") == 1) & (F.col("f_harmless") == 0)
    quoted = (F.col("f_quoted") == 1) & (F.col("f_length") >= 20) & (F.col("f_variety") >= 8)
    mixed = F.col("candidate").rlike(r"^(?=.*[A-Za-z])(?=.*[0-9])[^\s(){}\[\]$<>]+$")
    secret &= quoted | (mixed & (F.col("f_length") >= 8) & (F.col("f_variety") >= 6))
    secret |= F.col("candidate").rlike(PEM)
    harmless = (F.col("f_digits") == 1) | (F.col("f_after_path") == 1) | (F.col("f_variety") <= 4)
    harmless |= (F.col("f_dictionary") >= 0.6) | (F.col("f_harmless") == 1)
    harmless |= F.col("candidate").rlike(r"\.[a-z]{2,6}$|^[0-9.:-]+$")
    label = F.when(secret & ~harmless, 1).when(harmless & ~secret, 0)
    return described.withColumn("label", label).filter("label is not null")


def context_words(found: DataFrame) -> list[str]:
    """The words that stand beside most different findings, CONTEXT_WORDS at most."""
    different = found.select("candidate", _near_words().alias("words")).distinct()
    top = (
        different.select(F.explode("words").alias("word"))
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(CONTEXT_WORDS)
    )
    return [r["word"] for r in top.collect()]


def _near_words() -> Column:
    near = F.split(F.lower(F.concat_ws(" ", "before", "after")), "[^a-z]+")
    return F.array_distinct(F.filter(near, lambda w: F.char_length(w) >= 3))


def _different(known: DataFrame, names: list[str]) -> DataFrame:
    """SAMPLE_ROWS labelled findings of each kind at most; copies count once."""
    sample = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).groupBy("label", "candidate", "before")
        part = part.agg(F.min(F.struct(*names)).alias("f")).select("label", "candidate", "before", "f.*")
        part = part.orderBy(F.xxhash64("candidate", "before"), "candidate", "before").limit(SAMPLE_ROWS)
        sample = part if sample is None else sample.unionByName(part)
    return sample.withColumn("label", F.col("label").cast("double"))


def _scored(findings: DataFrame, sample: DataFrame, names: list[str], score: str) -> DataFrame | None:
    """The findings with the score of a forest fitted on the sample, if it has both kinds."""
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_view", numTrees=TREES, maxDepth=DEPTH, seed=7
    )
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="_view"), forest]).fit(sample)
    scored = model.transform(findings).withColumn(score, F.get(vector_to_array("probability"), F.lit(1)))
    return scored.drop("_view", "rawPrediction", "probability", "prediction")


def _odds(probability: Column) -> Column:
    """Logarithm of the odds; no forest is surer than one in fifty."""
    bounded = F.greatest(F.least(probability, F.lit(0.98)), F.lit(0.02))
    return F.log(bounded) - F.log(1 - bounded)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All findings: doc_id, start, length, finding, score, is_secret.

    `labelled` holds findings as `candidates` gives them, with a label.
    """
    words = dictionary(docs)
    described, names = features(candidates(docs), words)
    described = materialize(described, "findings")
    own = [n for n in names if n not in AROUND]
    if labelled is None:
        known = labelled_by_format(described)
    else:
        known = features(labelled, words)[0].filter("label is not null")
    alone = _scored(described, materialize(_different(known, own), "sample"), own, "by_form")
    if alone is None:
        scored = described.withColumn("score", F.lit(SECRET_AT))
    else:
        beside = context_words(described)
        near = [f"w_{word}" for word in beside]
        alone = alone.withColumns(
            {f"w_{w}": F.array_contains(_near_words(), w).cast("double") for w in beside}
        )
        alone = materialize(alone, "by-form")
        sure = F.when(F.col("by_form") >= SURE_AT, 1).when(F.col("by_form") <= 1 - SURE_AT, 0)
        taught = alone.withColumn("label", sure).filter("label is not null")
        around = [*AROUND, *near]
        sample = materialize(_different(taught, around), "second-sample")
        both = _scored(alone, sample, around, "by_context")
        if both is None:
            scored = alone.withColumn("score", F.col("by_form"))
        else:
            share = sample.agg(F.avg("label")).first()[0]
            odds = _odds(F.col("by_form")) + _odds(F.col("by_context")) - _odds(F.lit(share))
            scored = both.withColumn("score", 1 / (1 + F.exp(-odds)))
    # The header of a private key is one, however few the forests have seen.
    score = F.when(F.col("candidate").rlike(f"^{PEM}$"), F.lit(1.0)).otherwise(F.col("score"))
    return scored.withColumn("score", score).select(
        "doc_id",
        F.col("start").cast("long").alias("start"),
        F.char_length("candidate").cast("long").alias("length"),
        F.col("candidate").alias("finding"),
        "score",
        (F.col("score") >= SECRET_AT).alias("is_secret"),
    )
