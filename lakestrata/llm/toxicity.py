"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored, whole
from lakestrata.llm.repeats import drop_rows

shipped(__name__)

#: Bound of the labelled sample that lexicon and classifier are fitted on: rows of either class.
SAMPLE_PER_CLASS = 6000
#: Bounds of the lexicon and of its voters.
LEXICON = 400
LEXICON_VOTERS = 24
#: Score from which a document counts as toxic.
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)
# Patterns that shout or mask a word; each is a voter of its own.
_PATTERNS = (re.compile(r"[!?]{2,}"), re.compile(r"\b[^\W\d_]+[*@#$]+[^\W\d_]+"), re.compile(r"(?:\b[A-Z]{4,}\b\W+){2}"))
_PATTERN_VOTERS = len(_PATTERNS) + 4


def features(words: set[str]) -> set[str]:
    """The stems (first letters) of the words, and the words themselves as ``word$``."""
    found = {w[:n] for n in _STEMS for w in words if len(w) >= n}
    return found | {f"{w}$" for w in words}


def is_held_out(id_col: str) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """doc_id, toxic, text of at most ``per_class`` labelled documents of either class, none held out.

    Which ones a hash of the id decides. Null labels and ids are left out, of
    contradicting labels the toxic one counts, and of rows with one id the
    smallest text. The chosen ids, bounded by ``per_class``, are broadcast.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic is not null").filter(~is_held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Labels may name documents that are not there, so the ids are matched first.
    there = known.join(docs.select(F.col(id_col).alias("doc_id")).distinct(), "doc_id")
    there = stored(there, "toxicity-labels")
    classes = [there.filter(F.col("toxic") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    chosen = stored(classes[0].unionByName(classes[1]), "toxicity-chosen")
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id")
    return stored(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")


def _sketch(text: str) -> list[int]:
    """Two min-hashes of the runs of five words, equal for most near copies."""
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    return [min(xxhash.xxh64_intdigest(run, seed) for run in runs) >> 1 for seed in (1, 2)]


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample with one text of each set of near copies, lest a copied text's words look like marks."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([_sketch(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, 2)
            columns = [batch.column(0), batch.column(1), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "text", "one", "two"])

    rows = sample.select("toxic", "text").mapInArrow(sketch, "toxic int, text string, one long, two long")
    once = rows.groupBy("toxic", "one").agg(F.min(F.struct("two", "text")).alias("row")).select("toxic", "row.*")
    return once.groupBy("toxic", "two").agg(F.min("text").alias("text")).select("toxic", "text")


def mine_lexicon(sample: DataFrame, size: int = LEXICON) -> list[str]:
    """The stems and words that mark toxic texts of the sample, strongest first.

    A feature needs at least eight times its rate in clean texts and a count that
    chance would give to less than one feature in 150,000 (a Poisson bound on
    the clean rate). One in less than 1 % of the toxic texts needs as much again
    given how often it occurs at all (a Chernoff bound on the toxic share of its
    texts), since the clean rate of a rare feature is hardly known; its number
    of texts decides, not their share. Of a stem and a longer one the one that
    tells the classes apart better is kept. When more than ``size`` are left,
    those go that are not needed to cover toxic texts. To the driver come four
    times ``size`` features, and four of each toxic text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(features(set(_WORD.findall(text.lower()))))
            names = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(names, pa.string())]
            columns += [pa.array([c[n] for n in names], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    binary = sample.select(F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"), "text")
    totals = {row["toxic"]: row["n"] for row in binary.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    counted = binary.mapInArrow(count, "feature string, clean long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    expected = (F.col("clean") + 0.5) / (clean + 1) * (toxic + 1)
    strength = F.col("toxic") * F.log(F.col("toxic") / expected) - F.col("toxic")
    both, share = F.col("clean") + F.col("toxic"), toxic / max(toxic + clean, 1)
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0.0)
    surprise = F.col("toxic") * F.log(F.col("toxic") / (both * share)) + rest
    marked = counted.filter((F.col("toxic") >= 8 * expected) & ((F.col("toxic") >= 0.01 * toxic) | (surprise > 12)))
    marked = stored(marked.withColumn("strength", strength).filter("strength > 12"), "toxicity-marked")
    order = [F.col("strength").desc(), F.col("feature")]
    candidates = marked.orderBy(*order).limit(4 * size)
    hits = _marks(binary, marked)
    if marked.count() > 4 * size:
        hits = stored(hits, "toxicity-marks")
        nth = F.row_number().over(Window.partitionBy("text").orderBy(*order))
        own = hits.withColumn("nth", nth).filter("nth <= 4").select(*marked.columns)
        candidates = candidates.unionByName(own).distinct()
    best = candidates.orderBy(*order).collect()
    best = _best_stems({row["feature"]: (row["toxic"], row["clean"]) for row in best})
    if len(best) <= size:
        return best
    names = sample.sparkSession.createDataFrame([(name,) for name in best], "feature string")
    found = hits.join(F.broadcast(names), "feature").groupBy("feature").agg(F.collect_set("text").alias("texts"))
    return _covering(best, {row["feature"]: set(row["texts"]) for row in found.collect()}, size)


def _marks(sample: DataFrame, marked: DataFrame) -> DataFrame:
    """One row for each marked feature of each toxic text. The features, fewer than those of the sample, are broadcast."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names = list(features(set(_WORD.findall(text.lower()))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(names), pa.int64()), pa.array(names, pa.string())], ["text", "feature"]
                )

    toxic = sample.filter("toxic = 1").select(F.xxhash64("text").alias("number"), "text")
    return toxic.mapInArrow(spread, "text long, feature string").join(F.broadcast(marked), "feature")


def _covering(names: list[str], texts: dict[str, set[int]], size: int) -> list[str]:
    """``size`` of the names in their given order: first those that cover most texts not yet covered, over and over.

    Once all texts are covered, they are covered again with the names that are left.
    """
    chosen: set[str] = set()
    while len(chosen) < size:
        left = [name for name in names if name not in chosen]
        missing = set().union(*(texts.get(name, set()) for name in left))
        if not missing:
            chosen.update(left[: size - len(chosen)])
            break
        # What a name adds never grows, so an old count is an upper bound.
        heap = [(-len(texts.get(name, ())), at, name) for at, name in enumerate(left)]
        heapq.heapify(heap)
        while missing and len(chosen) < size:
            _, at, name = heapq.heappop(heap)
            adds = len(texts.get(name, set()) & missing)
            if heap and (-adds, at) > heap[0][:2]:
                heapq.heappush(heap, (-adds, at, name))
                continue
            chosen.add(name)
            missing -= texts[name]
    return [name for name in names if name in chosen]


def _best_stems(counts: dict[str, tuple[int, int]]) -> list[str]:
    """Features without those that a shorter or longer one makes needless, in their given order.

    A shorter feature goes when a longer one has nearly all its toxic texts, or
    nine tenths of them and fewer clean ones; else the longer one goes when it
    has no fewer clean texts.
    """
    gone = set()
    for name, (toxic, clean) in counts.items():
        stem = name.rstrip("$")
        shorter = [stem[:n] for n in _STEMS if n < len(stem)] + ([stem] if name.endswith("$") else [])
        for other in shorter:
            if other == name or other not in counts:
                continue
            share = toxic / counts[other][0]
            if share >= 0.97 or (share >= 0.9 and clean < counts[other][1]):
                gone.add(other)
            elif counts[other][1] <= clean:
                gone.add(name)
    return [name for name in counts if name not in gone]


def pattern_votes(hits, words, forms) -> np.ndarray:
    """The votes that look at the number and density of hits, at their absence, and at form."""
    hits, words, forms = (np.asarray(x, np.int64) for x in (hits, words, forms))
    counts = [hits >= 1, hits >= 3, hits * 200 >= np.maximum(words, 1), hits == 0]
    return np.stack([*counts, *(forms >> k & 1 for k in range(len(_PATTERNS)))], axis=1).astype(float)


@dataclass
class Voters:
    """Lexicon and pattern voters: each fires on a text or abstains.

    A lexicon voter fires on a word of its family, the lexicon entries with one
    4-letter stem; the smallest families share the last voter. Pattern voters
    look at how many words hit, how dense they are, that none does, and at form.
    """

    lexicon: list[str]
    place: dict[str, int] = field(init=False)
    voter: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.place = {name: i for i, name in enumerate(self.lexicon)}
        families = list(dict.fromkeys(name.rstrip("$")[:4] for name in self.lexicon))
        number = {f: min(i, LEXICON_VOTERS - 1) for i, f in enumerate(families)}
        self.voter = np.array([number[name.rstrip("$")[:4]] for name in self.lexicon], np.int64)
        self.heads = {name.rstrip("$")[:4] for name in self.lexicon}

    @property
    def count(self) -> int:
        return LEXICON_VOTERS + _PATTERN_VOTERS

    def signals(self, text: str) -> tuple[list[int], int, int, int]:
        """Lexicon entries found, words that hit, all words, and a bit per form pattern."""
        words = _WORD.findall(text.lower())
        heads = self.heads
        near = [w for w in words if w[:4] in heads]
        hits, found = 0, set()
        for word in near:
            own = [self.place[f] for f in features({word}) if f in self.place]
            hits += bool(own)
            found.update(own)
        forms = sum(1 << k for k, pattern in enumerate(_PATTERNS) if pattern.search(text))
        return sorted(found), hits, len(words), forms

    def votes(self, entries: Sequence[Sequence[int]], hits, words, forms) -> np.ndarray:
        """One row per text, one column per voter."""
        out = np.zeros((len(hits), LEXICON_VOTERS))
        for row, own in enumerate(entries):
            if len(own):
                out[row, self.voter[np.asarray(own, np.int64)]] = 1
        return np.c_[out, pattern_votes(hits, words, forms)]


@dataclass
class LabelModel:
    """A generative model of the votes: how often each voter fires in either class, and how voters hang together.

    Means, pair moments and the share of toxic texts are those of the whole
    corpus. The rates are fitted to the moments of pairs that look independent
    within the classes; what the classes leave unexplained of the other pairs is
    their correlation. A text's log odds weigh the votes by the inverse of the
    within-class covariance, so voters that repeat one another count once.
    """

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, mean: np.ndarray, pairs: np.ndarray, toxic: np.ndarray, clean: np.ndarray, steps: int = 400):
        """``mean``, ``pairs``: corpus moments; ``toxic``, ``clean``: first guesses of the rates."""
        a, b = toxic.copy(), clean.copy()
        gap = a - b
        share = float(np.clip(np.sum(gap * (mean - b)) / max(np.sum(gap * gap), 1e-9), 0.005, 0.6))

        def rest(p, a, b):
            return pairs - p * np.outer(a, a) - (1 - p) * np.outer(b, b)

        off = ~np.eye(len(mean), dtype=bool)
        spread = np.sqrt(np.outer(mean * (1 - mean), mean * (1 - mean))) + 1e-6
        tied = (np.abs(rest(share, a, b)) > 0.1 * spread) & off
        free = off & ~tied
        for _ in range(steps):
            left = np.where(free, rest(share, a, b), 0.0)
            first = mean - share * a - (1 - share) * b
            step_a = share * (2 * left @ a + first)
            step_b = (1 - share) * (2 * left @ b + first)
            a = np.clip(a + 0.05 * step_a, 1e-4, 1 - 1e-4)
            b = np.clip(b + 0.05 * step_b, 1e-4, 1 - 1e-4)
        covariance = np.where(tied, rest(share, a, b), 0.0)
        covariance[~off] = share * a * (1 - a) + (1 - share) * b * (1 - b)
        values, vectors = np.linalg.eigh(covariance)
        inverse = (vectors / np.maximum(values, 1e-3)) @ vectors.T
        weights = inverse @ (a - b)
        bias = float(np.log(share / (1 - share)) - 0.5 * (a + b) @ weights)
        return cls(weights, bias)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that each text is toxic, given its votes."""
        return 1 / (1 + np.exp(-np.clip(votes @ self.weights + self.bias, -30, 30)))


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.02, steps: int = 30) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    weights = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - target) + pull * weights
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(bend, slope)
        weights -= move
        if np.abs(move).max() < 1e-6:
            break
    return weights


def _signals(docs: DataFrame, id_col: str, text_col: str, voters: Voters) -> DataFrame:
    """What the voters look at, for every document: the only pass over all texts."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.signals(text.as_py()) for text in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int32()))]
            columns += [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]
            names = ["doc_id", "text_hash", "entries", "hits", "words", "forms"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, text_hash long, entries array<int>, hits long, words long, forms long"
    return stored(rows.mapInArrow(look, schema), "toxicity-signals")


def _moments(signals: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Means of the votes and of their products over all documents; a few hundred sums come back."""
    size = voters.count

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            entries, hits, words, forms = (batch.column(i).to_pylist() for i in range(4))
            votes = np.c_[voters.votes(entries, hits, words, forms), np.ones(batch.num_rows)]
            total += votes.T @ votes
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "sum"])

    sums = signals.select("entries", "hits", "words", "forms").mapInArrow(add, "at long, sum double")
    total = np.zeros((size + 1) ** 2)
    for row in sums.groupBy("at").agg(F.sum("sum").alias("sum")).collect():
        total[row["at"]] = row["sum"]
    total = total.reshape(size + 1, size + 1)
    n = max(total[-1, -1], 1.0)
    return total[-1, :-1] / n, total[:-1, :-1] / n


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """doc_id, text_hash, score."""
    sample = labelled_sample(docs, labels, id_col, text_col, per_class)
    voters = Voters(mine_lexicon(stored(without_copies(sample), "toxicity-texts")))
    signals = _signals(docs, id_col, text_col, voters)
    chosen = sample.select("doc_id", "toxic", F.xxhash64("text").alias("text_hash"))
    known = signals.join(F.broadcast(chosen), ["doc_id", "text_hash"]).dropDuplicates(["doc_id"])
    rows = known.orderBy("doc_id").collect()
    gold = np.array([row["toxic"] > 0 for row in rows], bool)
    if not voters.lexicon or gold.all() or not gold.any():
        return signals.select("doc_id", "text_hash", F.lit(0.0).alias("score"))

    votes = voters.votes(*([row[c] for row in rows] for c in ("entries", "hits", "words", "forms")))
    rates = [(votes[part].sum(axis=0) + 0.5) / (part.sum() + 1) for part in (gold, ~gold)]
    model = LabelModel.fit(*_moments(signals, voters), *rates)
    # The classifier's inputs are the lexicon entries found and the pattern votes.
    found = np.zeros((len(rows), len(voters.lexicon)))
    for n, row in enumerate(rows):
        found[n, row["entries"]] = 1
    weights = fit_linear(np.c_[found, votes[:, LEXICON_VOTERS:]], model.posterior(votes))
    of_entry, of_pattern, bias = np.split(weights, [len(voters.lexicon), len(weights) - 1])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column(2)
            flat = entries.flatten().to_numpy(zero_copy_only=False)
            sizes = entries.value_lengths().to_numpy(zero_copy_only=False)
            sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), of_entry[flat], len(sizes)) + bias
            sums += pattern_votes(*(batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))) @ of_pattern
            value = pa.array(1 / (1 + np.exp(-np.clip(sums, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), value], ["doc_id", "text_hash", "score"])

    kind = signals.schema["doc_id"].dataType.simpleString()
    return signals.mapInArrow(score, f"doc_id {kind}, text_hash long, score double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    per_class: int = SAMPLE_PER_CLASS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    Labels of held-out rows are never read. A score depends on the text alone;
    null and empty texts get the score of a text in which nothing was found, and
    without labels of both classes, or words that tell them apart, every score
    is 0. Repeated rows each keep their row, an empty table gives no rows, and
    other columns are not looked at. A null id is not held out.
    """
    scored = _scored(docs, labels, id_col, text_col, per_class)
    return scored.select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    per_class: int = SAMPLE_PER_CLASS,
) -> DataFrame:
    """The documents scored below ``threshold``, all columns kept."""
    gone = _scored(docs, labels, id_col, text_col, per_class).filter(F.col("score") >= threshold)
    gone = stored(gone.select("doc_id", "text_hash"), "toxic").distinct()
    return drop_rows(docs, {"doc_id": F.col(id_col), "text_hash": F.xxhash64(whole(text_col))}, gone)
