"""Toxicity by weak supervision.

1. Voters look at whole texts: curated lexicons, lexicons mined from a bounded
   sample of labelled rows, and patterns. Each votes or not: VOTERS bits.
2. All documents are read once. What is kept of each is its vote pattern and the
   terms that the classifier may use; the patterns are counted over all of them,
   at most 2 ** VOTERS different ones.
3. A generative label model explains the counts: on toxic and on clean documents every
   voter votes with a rate of its own, or, where voters still agree inside a class, with
   rates that depend on the vote of the one it agrees with most (a forest of pairs, laid
   by conditional mutual information). EM estimates shares, rates and pairs from all
   documents; it starts from the annotator's rows, and the annotator is one more voter
   on them while it runs.
4. A linear classifier over voters and terms is trained on the model's posteriors of a
   bounded hash sample of all documents outside the held-out fold, labelled or not.
   There the annotator is silent: what it said of a document counts through the rates
   alone. It scores every document.

Defined results: a null or empty text has no votes and gets the score of its bias.
Without labelled rows of both kinds, or terms that tell them apart, there is no
classifier and the score is the posterior of the label model. A sampled id that repeats counts once per vote pattern. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import WordHashes, column_bytes, shingles, text_or_empty
from tidemark.llm.common import words_of
from tidemark.session import materialize

SAMPLE_ROWS = 4_000
FOLDS, HELD_OUT = 3, 1
PREDICT_AT = 0.7
# Terms that the classifier may use, and the least evidence for one: documents of
# the sample (near copies count about once) and standard deviations.
MAX_TERMS = 512
MIN_DOCUMENTS = 6
MIN_DEVIATIONS = 4.0
MINED = 8
PREFIX_BYTES = 6
RIDGE = 0.05

# Words of abuse, by kind.
INSULTS = """idiot idiots moron morons stupid dumb scum trash garbage loser losers pathetic
worthless disgusting clown clowns imbecile cretin fool vermin filth pig coward freak""".split()
THREATS = """kill murder hang burn destroy hurt beat strangle stab shoot rape""".split()
PROFANITY = """damn crap hell shit fuck fucking bitch bastard asshole arse bollocks""".split()
_CURATED = [frozenset(w.encode() for w in kind) for kind in (INSULTS, THREATS, PROFANITY)]
_ANY = frozenset().union(*_CURATED)

# Patterns on lower-cased text, each behind a string that must occur.
_PATTERNS = [
    (b"you", re.compile(rb"\byou(?:'re| are| re)? (?:\w+ ){0,2}(?:" + b"|".join(sorted(_CURATED[0])) + rb")\b")),
    (b"go ", re.compile(rb"\bgo (?:to hell|die|kill|away and)\b")),
    (b"**", re.compile(rb"\b[a-z]\*{2,}[a-z]*\b")),
]
VOTERS = MINED + len(_CURATED) + len(_PATTERNS) + 2

_hashes = WordHashes()


def terms_of(text: bytes) -> set[bytes]:
    """Words of a text; the beginnings of longer words, marked by ^; and those that
    begin several different words, marked by ^^.

    Beginnings find inflected and compound forms that are too rare alone.
    """
    words = set(words_of(text))
    once: set[bytes] = set()
    again: set[bytes] = set()
    for word in words:
        if len(word) > PREFIX_BYTES:
            start = word[:PREFIX_BYTES]
            (again if start in once else once).add(start)
    return words | {b"^" + s for s in once} | {b"^^" + s for s in again}


def mined_terms(sample: DataFrame) -> list[tuple[bytes, float]]:
    """Terms that mark one label in the sample, with their evidence (the logarithm of
    how much likelier they are in documents of label 1), greatest first."""

    def seen(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            terms_out: list[bytes] = []
            labels_out: list[int] = []
            keys_out: list[int] = []
            for label, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                words = words_of(text)
                found = shingles(_hashes.of(words), min(5, max(1, len(words))))
                key = int(found.min() >> np.uint64(1)) if len(found) else 0
                own = [t for t in terms_of(text) if len(t) <= 64]
                terms_out += own
                labels_out += [label] * len(own)
                keys_out += [key] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms_out, pa.binary()), pa.array(labels_out, pa.int32())]
                + [pa.array(keys_out, pa.int64())],
                names=["term", "label", "key"],
            )

    # Near copies share their smallest shingle most of the time and count once.
    rows = sample.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(
        seen, "term binary, label int, key long"
    )
    rows = materialize(rows.distinct(), "terms")
    sizes = {
        r["label"]: r["n"]
        for r in rows.groupBy("label").agg(F.countDistinct("key").alias("n")).collect()
    }
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return []
    of_one = F.sum("label")
    of_zero = F.count(F.lit(1)) - F.sum("label")
    pooled = (F.col("ones") + F.col("zeros")) / (ones + zeros)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / ones + 1 / zeros) + 1e-12)
    strongest = (
        rows.groupBy("term")
        .agg(of_one.alias("ones"), of_zero.alias("zeros"))
        .filter(F.col("ones") + F.col("zeros") >= MIN_DOCUMENTS)
        .withColumn("z", (F.col("ones") / ones - F.col("zeros") / zeros) / spread)
        .filter(F.abs("z") >= MIN_DEVIATIONS)
        .orderBy(F.abs("z").desc(), "term")
        .limit(MAX_TERMS)
        .withColumn(
            "evidence",
            F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("zeros") + 0.5) / (zeros + 1)),
        )
        .orderBy(F.desc("evidence"), "term")
    )
    return [(bytes(r["term"]), r["evidence"]) for r in strongest.collect()]


def votes_of(text: bytes, place: dict[bytes, int], lexicon: dict[bytes, int]) -> tuple[int, list]:
    """Vote pattern of a text and the places of its known terms."""
    lower = text.lower()
    words = terms_of(text)
    known = words & place.keys()
    votes = 0
    for word in known:
        if word in lexicon:
            votes |= 1 << lexicon[word]
    at = MINED
    for kind in _CURATED:
        votes |= (not words.isdisjoint(kind)) << at
        at += 1
    for needle, pattern in _PATTERNS:
        votes |= (needle in lower and pattern.search(lower) is not None) << at
        at += 1
    marks = [w for w in known if w in lexicon]
    whole = {w for w in marks if not w.startswith(b"^")}
    # A beginning is no second mark beside a marked word that begins so.
    begun = {w.lstrip(b"^") for w in marks} - whole - {w[:PREFIX_BYTES] for w in whole}
    votes |= (len(whole) + len(begun) + len((words & _ANY) - known) >= 2) << at
    letters = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    votes |= (len(text) >= 40 and 2 * letters > len(text)) << (at + 1)
    return votes, sorted(place[w] for w in known)


def read_votes(docs: DataFrame, mined: list[tuple[bytes, float]]) -> DataFrame:
    """Stored rows of all documents: doc_id, votes, words (places of known terms)."""
    place = {term: i for i, (term, _) in enumerate(mined)}
    # One lexicon a tier of evidence, so that a single strong term can be enough.
    toxic = [term for term, evidence in mined if evidence > 0]
    lexicon = {term: i * MINED // len(toxic) for i, term in enumerate(toxic)}

    def voted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [votes_of(t, place, lexicon) for t in column_bytes(batch.column(1))]
            columns = [batch.column(0), pa.array([v for v, _ in found], pa.int64())]
            columns.append(pa.array([w for _, w in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "votes", "words"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text"))
    return materialize(
        source.mapInArrow(voted, "doc_id long, votes long, words array<int>"), "votes"
    )


def bits(votes: np.ndarray) -> np.ndarray:
    return ((votes[:, None] >> np.arange(VOTERS)) & 1).astype(np.float64)


class LabelModel:
    """Votes on clean (0) and toxic (1) documents.

    `rates` are those of single voters, the last of which is the annotator, who votes on
    rows for training only. A voter with a `parent` votes by the rates `given` the class
    and the parent's vote instead.
    """

    def __init__(self, share: float):
        self.share = share
        self.rates = np.empty((2, VOTERS + 1))
        self.rates[0], self.rates[1] = 0.02, 0.3
        self.rates[:, -1] = 0.05, 0.95
        self.parent = np.full(VOTERS, -1)
        self.given = np.repeat(self.rates[:, :-1, None], 2, axis=2)
        self.correlations = np.zeros((VOTERS, VOTERS))

    def likelihood(self, seen: np.ndarray) -> np.ndarray:
        """Log-probability of votes (rows of 0 and 1) in both classes, as columns."""
        out = np.empty((len(seen), 2))
        rooted = np.where(self.parent < 0, 0, self.parent)
        leading = np.where(self.parent < 0, 0, seen[:, rooted]).astype(np.int64)
        for y in (0, 1):
            rate = np.take_along_axis(self.given[y].T, leading, axis=0)
            out[:, y] = np.where(seen > 0, np.log(rate), np.log1p(-rate)).sum(axis=1)
        return out

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Probability of toxic; label is 1, 0, or -1 where the annotator is silent."""
        evidence = self.likelihood(bits(votes))
        said = np.log(np.where(label[:, None] == 1, self.rates[:, -1], 1 - self.rates[:, -1]))
        evidence += np.where(label[:, None] >= 0, said, 0.0)
        odds = np.log(self.share) - np.log1p(-self.share) + evidence[:, 1] - evidence[:, 0]
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    def fit(self, votes: np.ndarray, label: np.ndarray, count: np.ndarray, rounds: int = 25):
        """EM over counted patterns; one pattern per pair of votes and label.

        The pairs are laid anew in the first half of the rounds, so that the others
        improve one likelihood.
        """
        seen = bits(votes)
        taught = float(count[label >= 0].sum())
        untaught = float(count.sum()) - taught
        if taught and untaught > taught:
            # Together the others weigh as much as the annotator's rows, so that however
            # many they are, the classes stay those that the annotator means.
            count = np.where(label >= 0, count, count * (taught / untaught))
        annotated = np.column_stack([seen, label == 1]).astype(np.float64)
        says = np.ones_like(annotated)
        says[:, -1] = label >= 0
        for round_ in range(rounds):
            if round_ == 0 and (label >= 0).any():
                toxic, weight = np.where(label == 1, 0.95, 0.05), count * (label >= 0)
            else:
                toxic, weight = self.posterior(votes, label), count
            parts = ((1 - toxic) * weight, toxic * weight)
            for y, part in enumerate(parts):
                voted = (part[:, None] * says * annotated).sum(axis=0)
                asked = (part[:, None] * says).sum(axis=0)
                # One imagined document per class and a weak prior keep rates inside (0, 1).
                prior = self.rates[y]
                self.rates[y] = np.clip((voted + 2 * prior) / (asked + 2), 1e-5, 1 - 1e-5)
            if round_:
                self.share = float(np.clip((toxic * count).sum() / count.sum(), 1e-3, 0.999))
            if round_ <= rounds // 2:
                self._lay_pairs(seen, parts)
            self._fit_pairs(seen, parts)
        return self

    def _lay_pairs(self, seen: np.ndarray, parts: tuple[np.ndarray, np.ndarray]) -> None:
        """The forest of pairs that tell most about each other inside the classes."""
        total, strongest = np.zeros((VOTERS, VOTERS)), np.zeros((VOTERS, VOTERS))
        everything = max(sum(part.sum() for part in parts), 1e-9)
        for part in parts:
            size = part.sum()
            if size <= 0:
                continue
            mean = (part[:, None] * seen).sum(axis=0) / size
            both = (seen * part[:, None]).T @ seen / size
            spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
            link = (both - np.outer(mean, mean)) / np.outer(spread, spread)
            strongest = np.maximum(strongest, link)
            for ours in (0, 1):
                for theirs in (0, 1):
                    one = mean if ours else 1 - mean
                    other = mean if theirs else 1 - mean
                    joint = {
                        (1, 1): both,
                        (1, 0): mean[:, None] - both,
                        (0, 1): mean[None, :] - both,
                        (0, 0): 1 - mean[:, None] - mean[None, :] + both,
                    }[ours, theirs]
                    joint = np.maximum(joint, 1e-12)
                    apart = np.maximum(np.outer(one, other), 1e-12)
                    total += size / everything * joint * np.log(joint / apart)
        self.correlations = np.clip(strongest - np.diag(np.diag(strongest)), 0, 1)
        # Chance correlations among few votes are left alone.
        usable = (np.abs(self.correlations) > 0.1) & (2 * everything * total > 12)
        self.parent = np.full(VOTERS, -1)
        group = np.arange(VOTERS)
        ranked = np.argsort(-total, axis=None, kind="stable")
        edges = [[] for _ in range(VOTERS)]
        for a, b in zip(*np.unravel_index(ranked, total.shape)):
            if a < b and usable[a, b] and group[a] != group[b]:
                group[group == group[b]] = group[a]
                edges[a].append(b)
                edges[b].append(a)
        reached: set[int] = set()
        for root in range(VOTERS):
            ahead = [] if root in reached else [root]
            while ahead:
                at = ahead.pop()
                reached.add(at)
                for other in edges[at]:
                    if other not in reached:
                        self.parent[other] = at
                        ahead.append(other)

    def _fit_pairs(self, seen: np.ndarray, parts: tuple[np.ndarray, np.ndarray]) -> None:
        """Rates given the parent's vote, drawn towards those without it."""
        for y, part in enumerate(parts):
            for voter, parent in enumerate(self.parent):
                alone = self.rates[y, voter]
                for vote in (0, 1):
                    rate = alone
                    if parent >= 0:
                        asked = part * (seen[:, parent] == vote)
                        voted = (asked * seen[:, voter]).sum()
                        rate = (voted + 2 * alone) / (asked.sum() + 2)
                    self.given[y, voter, vote] = np.clip(rate, 1e-5, 1 - 1e-5)


def train_linear(
    features: np.ndarray, target: np.ndarray, weight: np.ndarray, signs: np.ndarray
) -> np.ndarray:
    """Logistic regression on soft labels by projected gradients; the last weight is the bias.

    A voter or term only ever counts for the label that it marks (`signs`), so that a
    chance pattern of the sample cannot turn one mark against another.
    """
    x = np.column_stack([features, np.ones(len(features))])
    ridge = np.append(np.full(features.shape[1], RIDGE), 0.0)
    low = np.append(np.where(signs < 0, -np.inf, 0.0), -np.inf)
    high = np.append(np.where(signs < 0, 0.0, np.inf), np.inf)
    # The largest curvature bounds the step: power iteration on the data's moments.
    direction = np.ones(x.shape[1])
    for _ in range(30):
        direction = x.T @ (weight * (x @ direction))
        direction /= np.linalg.norm(direction)
    step = 1 / (np.linalg.norm(x.T @ (weight * (x @ direction))) / 4 + RIDGE)
    w = ahead = np.zeros(x.shape[1])
    pace = 1.0
    for _ in range(600):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (weight * (p - target)) + ridge * ahead)
        new = np.clip(new, low, high)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / faster * (new - w)
        w, pace = new, faster
    return w


def _features(votes: np.ndarray, words: list, n_words: int) -> np.ndarray:
    out = np.zeros((len(votes), VOTERS + n_words))
    out[:, :VOTERS] = bits(votes)
    sizes = [len(w) for w in words]
    if sum(sizes):
        row = np.repeat(np.arange(len(words)), sizes)
        out[row, VOTERS + np.concatenate([w for w in words if len(w)]).astype(np.int64)] = 1
    return out


def training_rows(read: DataFrame, rows: int) -> tuple[list, np.ndarray]:
    """Votes and terms of at most `rows` documents outside the held-out fold, and weights.

    Half of them come from documents with votes, half from those without, where there
    are as many, chosen by hashes of their ids; the weights (1 on average) undo that.
    """
    open_ = read.filter(labelled.fold("doc_id", FOLDS) != HELD_OUT).withColumn(
        "voted", F.col("votes") != 0
    )
    sizes = {r["voted"]: r["count"] for r in open_.groupBy("voted").count().collect()}
    few = min([*sizes.values(), rows // 2]) if len(sizes) == 2 else 0
    taught, weight = [], []
    for voted, size in sorted(sizes.items()):
        take = min(size, rows - few)
        # Four times as many ids as wanted are looked at, or all there are.
        share = min(1.0, 4 * take / size)
        limit = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
        chosen = (
            open_.filter((F.col("voted") == voted) & (F.xxhash64("doc_id") <= limit))
            .dropDuplicates(["doc_id", "votes", "words"])
            .orderBy(F.xxhash64("doc_id"), "doc_id", "votes", "words")
            .limit(take)
            .select("doc_id", "votes", "words")
            .collect()
        )
        taught += chosen
        weight += [size / max(1, len(chosen))] * len(chosen)
    scale = np.array(weight)
    return taught, scale / scale.mean() if len(scale) else scale


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    texts, share = labelled.sample(docs, labels, "toxic", rows, FOLDS, HELD_OUT)
    sample = materialize(texts, "sample")
    mined = mined_terms(sample)
    read = read_votes(docs, mined)

    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").alias("label"), F.max("toxic").alias("most"))
        .filter("label = most")
        .filter(labelled.fold("doc_id", FOLDS) != HELD_OUT)
        .select("doc_id", "label")
    )
    # At most 3 * 2 ** VOTERS patterns, however many documents there are.
    patterns = (
        read.select("doc_id", "votes")
        .join(known, "doc_id", "left")
        .groupBy("votes", F.coalesce("label", F.lit(-1)).alias("label"))
        .count()
        .collect()
    )
    label_model = LabelModel(float(np.clip(share, 0.01, 0.99)))
    if patterns:
        columns = [np.array([p[c] for p in patterns]) for c in ("votes", "label", "count")]
        label_model.fit(columns[0], columns[1], columns[2].astype(np.float64))

    linear = None
    if mined:
        taught, weight = training_rows(read, rows)
        votes = np.array([t["votes"] for t in taught], dtype=np.int64)
        linear = train_linear(
            _features(votes, [t["words"] for t in taught], len(mined)),
            label_model.posterior(votes, np.full(len(votes), -1)),
            weight,
            np.concatenate([np.ones(VOTERS), [np.sign(evidence) for _, evidence in mined]]),
        )

    def scored(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            votes = batch.column(2).to_numpy().astype(np.int64)
            if linear is None:
                result = label_model.posterior(votes, np.full(len(votes), -1))
            else:
                odds = bits(votes) @ linear[:VOTERS] + linear[-1]
                words = batch.column(3)
                bounds = words.offsets.to_numpy()
                own = linear[VOTERS + words.values.to_numpy(zero_copy_only=False).astype(np.int64)]
                total = np.concatenate([[0.0], np.cumsum(own)])
                odds += total[bounds[1:]] - total[bounds[:-1]]
                result = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            columns = [batch.column(0), batch.column(1), pa.array(result, pa.float64())]
            columns.append(pa.array((result >= PREDICT_AT).astype(np.int32)))
            names = ["doc_id", "held_out", "score", "predicted"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return read.select(
        "doc_id", (labelled.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "votes", "words"
    ).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
