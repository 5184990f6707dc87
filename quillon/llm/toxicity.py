"""Toxicity scores from gradient-boosted trees over dense text features.

A bounded sample of labelled texts teaches a lexicon of words and word
beginnings that mark toxic texts, boosted trees over dense features, and an
isotonic map from the trees' output to a probability.  The three are
cross-fitted over two halves of the sample: the features of a half come from
the lexicon of the other, and the calibration from trees of the other, so that
each learns from all texts and none from its own answers.

All features but one are sums over tokens (runs without white space), and what a
token adds is a property of the token alone, which a worker works out once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled texts of each class that are used at most; drawn by a hash of the id.
SAMPLE = 6_000
#: A learned term is kept from so many toxic texts on, above these log-odds; the strongest ``TERMS`` stay.
TERM_TEXTS, TERM_ODDS, TERMS = 4, 2.0, 20_000
#: Word beginnings that are learned beside whole words.
STEMS = (4, 5, 6)
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 4

#: Abusive words of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons scum trash garbage loser losers stupid dumb worthless pathetic disgusting clown clowns jerk fool fools imbecile filthy vermin"
    " idiota imbécil estúpido estúpida basura asqueroso payaso inútil patético"
    " dumm dummkopf trottel abschaum müll wertlos erbärmlich widerlich versager"
    " imbécile débile ordure minable dégoûtant pathétique crétin abruti raclure".split()
)
#: Words that address the reader.
SECOND_PERSON = frozenset("you your yours yourself youre ur u tu te ti tus tuyo usted ustedes vosotros du dich dir dein deine ihr euch toi ton ta tes vous votre vos".split())
_WORD = re.compile(r"[^\W_]+")
#: Words with other marks between letters, letters followed by digits or marks, and digits before letters; each tried once per run of letters or digits.
_DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:(?:[0-9@$!*|.\-_+]++[^\W\d_]++)++|[0-9@$!*]++[^\W_]++)|(?<![0-9@$])[0-9@$]++[^\W\d_]{2,}")
_PLAIN = str.maketrans("013457@$!|", "oieastasil", "*.-_+")
#: Longer tokens are worked out anew each time they occur, which bounds the memo.
MEMO_CHARS = 48

#: What a token adds to the sums of its text.
TOKEN = ("words", "letters", "chars", "capitals", "shouted", "insults", "marked", "weight", "strongest", "second", "exclamations", "hidden", "unmasked")
FEATURES = (
    "log_words", "insult_density", "insult_count", "term_density", "term_count", "term_strongest", "term_weight", "second_person_density",
    "near_second_person", "capital_rate", "shouted_rate", "punctuation_rate", "exclamation_rate", "disguised_rate", "disguised_insults", "word_length",
)


def terms_of(text: str) -> set[str]:
    """Words and word beginnings (marked by a trailing ``-``) of a text."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "-" for w in words for n in STEMS if len(w) > n}


class Lexicon:
    """Weights of words, and what each token of a worker's texts adds to their sums."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.words: dict[str, tuple[float, bool, bool]] = {}
        self.memo: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(TOKEN)), np.float32)

    def weight(self, word: str) -> float:
        w = self.weights
        found = max([w.get(word, 0.0), *(w.get(word[:n] + "-", 0.0) for n in STEMS if len(word) > n)])
        return found or (8.0 if word in INSULTS else 0.0)

    def word(self, low: str) -> tuple[float, bool, bool]:
        """Weight of a lower-case word, and whether it is an insult or addresses the reader."""
        if (found := self.words.get(low)) is None:
            found = self.weight(low), low in INSULTS, low in SECOND_PERSON
            if len(low) <= MEMO_CHARS:
                self.words[low] = found
        return found

    def token(self, token: str) -> tuple[float, ...]:
        """What a token adds, in the order of TOKEN."""
        chars, exclamations = len(token), token.count("!")
        if token.isalpha():
            words, hidden = [token], []
        else:
            words = _WORD.findall(token)
            plain = len(words) == 1 and (token.startswith(words[0]) or token.endswith(words[0])) and words[0].isalpha() and not any(c in "0123456789@$*" for c in token)
            hidden = [] if plain else _DISGUISED.findall(token)
        letters = capitals = shouted = insults = marked = second = 0
        total = strongest = 0.0
        for w in words:
            low = w.lower()
            weight, insult, spoken = self.word(low)
            letters += len(w)
            if low != w:
                capitals += 1 if w[1:].islower() else sum(map(str.isupper, w))
                shouted += len(w) > 1 and w.isupper()
            insults += insult
            marked += weight > 0
            total += weight
            strongest = max(strongest, weight)
            second += spoken
        unmasked = sum(self.weight(h.lower().translate(_PLAIN)) > 0 for h in hidden)
        return len(words), letters, chars, capitals, shouted, insults, marked, total, strongest, second, exclamations, len(hidden), unmasked

    def _rows(self, tokens: list[list[str]]) -> np.ndarray:
        """Table rows of all tokens, in order."""
        if len(self.memo) > common.MEMO_ENTRIES:
            self.memo.clear()
            self.words.clear()
        memo = self.memo
        new = sorted(set().union(*tokens).difference(memo), key=len)
        if new:
            base = len(memo)
            if base + len(new) > len(self.table):
                self.table = np.resize(self.table, (2 * (base + len(new)), len(TOKEN)))
            self.table[base : base + len(new)] = [self.token(t) for t in new]
            memo.update(zip(new, range(base, base + len(new)), strict=True))
        found = self.table[np.fromiter((i for t in tokens for i in map(memo.__getitem__, t)), np.int64, sum(map(len, tokens)))]
        # long tokens are the last rows, and are forgotten
        while new and len(new[-1]) > MEMO_CHARS:
            del memo[new.pop()]
        return found

    def features(self, texts: list[str]) -> np.ndarray:
        """A row of FEATURES per text; all 0 where a text has no words."""
        tokens = [t.split() for t in texts]
        count = np.array(list(map(len, tokens)), np.int64)
        out = np.zeros((len(texts), len(FEATURES)))
        if not count.sum():
            return out
        x = self._rows(tokens)
        filled = np.flatnonzero(count)
        first = (np.cumsum(count) - count)[filled]
        sums = dict(zip(TOKEN, np.add.reduceat(x, first, axis=0, dtype=np.float64).T, strict=True))
        strongest = np.maximum.reduceat(x[:, TOKEN.index("strongest")], first)
        # marked tokens with a second-person token at most NEAR tokens away in their text
        owner = np.repeat(np.arange(len(filled)), count[filled])
        marked, spoken = (np.flatnonzero(x[:, TOKEN.index(c)] > 0) for c in ("marked", "second"))
        near = np.zeros(len(filled))
        if len(marked) and len(spoken):
            right = np.searchsorted(spoken, marked)
            close = np.zeros(len(marked), bool)
            for at in (np.maximum(right - 1, 0), np.minimum(right, len(spoken) - 1)):
                close |= (np.abs(spoken[at] - marked) <= NEAR) & (owner[spoken[at]] == owner[marked])
            near = np.bincount(owner[marked[close]], minlength=len(filled)).astype(float)
        n, letters, chars = np.maximum(sums["words"], 1.0), np.maximum(sums["letters"], 1.0), sums["chars"]
        columns = [
            np.log1p(n), sums["insults"] / n, np.log1p(sums["insults"]), sums["marked"] / n, np.log1p(sums["marked"]), strongest, sums["weight"] / n, sums["second"] / n,
            near / n, sums["capitals"] / letters, sums["shouted"] / n, (chars - sums["letters"]) / chars,
            sums["exclamations"] / chars, sums["hidden"] / n, np.log1p(sums["unmasked"]), sums["letters"] / n,
        ]
        out[filled] = np.where(sums["words"][:, None] > 0, np.stack(columns, axis=1), 0.0)
        return out


@dataclass
class Model:
    """A lexicon, trees over the features, and the calibration; without trees, the share of toxic labels."""

    weights: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def _featured(docs: DataFrame, lexicons: list[dict[str, float]], *keep: str) -> DataFrame:
    """``keep`` and the features ``x`` of each text; a text of half h is read with ``lexicons[h]`` where there are several."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Lexicon(w) for w in shared.value]
        for group in common.text_groups(batches):
            texts = [t or "" for t in group.column("text").to_pylist()]
            x = own[0].features(texts)
            if len(own) > 1:
                x = np.where(group.column("half").to_numpy()[:, None] == 0, x, own[1].features(texts))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(group.column(c) for c in keep), flat], names=[*keep, "x"])

    fields = [docs.schema[c] for c in keep]
    return docs.select(*keep, "text").mapInArrow(measured, T.StructType([*fields, T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, clean0, toxic0, clean1, toxic1): texts of each class and half that hold a term."""
    for group in common.text_groups(batches):
        sums: dict[str, list[int]] = {}
        for y, half, text in zip(*(group.column(c).to_pylist() for c in ("y", "half", "text")), strict=True):
            for term in terms_of(text):
                sums.setdefault(term, [0, 0, 0, 0])[2 * half + y] += 1
        counts = np.array(list(sums.values()), np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *(pa.array(counts[:, i]) for i in range(4))], names=["term", "clean0", "toxic0", "clean1", "toxic1"])


def _lexicon(terms: DataFrame, halves: tuple[int, ...], clean: int, toxic: int) -> dict[str, float]:
    """The strongest terms of the given halves, which have ``clean`` and ``toxic`` texts."""
    total = lambda kind: sum((F.col(f"{kind}{h}") for h in halves[1:]), F.col(f"{kind}{halves[0]}"))
    odds = F.log((total("toxic") + 0.5) / (toxic + 1.0)) - F.log((total("clean") + 0.5) / (clean + 1.0))
    strongest = terms.where(total("toxic") >= TERM_TEXTS).withColumn("w", odds).where(F.col("w") >= TERM_ODDS).orderBy(F.desc("w"), "term").limit(TERMS)
    return {r.term: r.w for r in strongest.select("term", "w").collect()}


def train(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn from the labelled rows where ``learn``, a condition on ``id_col``, holds.

    At most ``sample`` ids of each class are drawn by hash; only these are joined
    to their texts.  An id with several labels has the highest; labels other than
    0 and 1 and null texts teach nothing.  With fewer than ten texts of a class
    the model is the share of label 1.
    """
    marked = labels.where(learn & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    order = F.xxhash64(F.lit("toxicity"), F.col("id").cast("string"))
    chosen = marked.where("y = 1").orderBy(order, "id").limit(sample).unionByName(marked.where("y = 0").orderBy(order, "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("id").cast("string")), F.lit(2)).cast("int")
    rows = common.written(texts.join(F.broadcast(chosen), "id").select("y", "text", half.alias("half")), "toxicity-sample")

    n = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("half", "y").agg(F.count("*").alias("n")).collect():
        n[r.half, r.y] = r.n
    prior = float(n[:, 1].sum() / max(1, n.sum()))
    if n.sum(axis=0).min() < 10 or n.min() == 0:
        return Model({}, None, None, prior)

    spread = rows.repartition(8)
    found = spread.select("y", "half", "text").mapInArrow(_terms, "term string, clean0 bigint, toxic0 bigint, clean1 bigint, toxic1 bigint")
    terms = common.written(found.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("clean0", "toxic0", "clean1", "toxic1"))).where(F.col("toxic0") + F.col("toxic1") >= TERM_TEXTS), "toxicity-terms")
    lexicon = _lexicon(terms, (0, 1), *n.sum(axis=0).tolist())
    # each half is measured with what the other half teaches
    other = [_lexicon(terms, (1 - h,), *n[1 - h].tolist()) for h in (0, 1)]
    measured = common.written(_featured(spread, other, "y", "half").select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "half"), "toxicity-features").coalesce(4)
    fit = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.2, maxBins=32, seed=7, cacheNodeIds=False).fit
    guesses = [fit(measured.where(F.col("half") == h)).transform(measured.where(F.col("half") == 1 - h)) for h in (0, 1)]
    rest = guesses[0].union(guesses[1]).select(vector_to_array("probability")[1].alias("p"), "label")
    # the sample holds the classes in other shares than the labels; weights restore them
    whole = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    balance = {y: whole[y] / int(n[:, y].sum()) for y in (0, 1)}
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="w").fit(rest.withColumn("w", F.when(F.col("label") == 1, balance[1]).otherwise(balance[0])))
    return Model(lexicon, fit(measured), calibration, whole[1] / (whole[0] + whole[1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``score`` (0 to 1) and ``predicted`` (score >= 0.5) of each whole text.

    Null and empty texts have all features 0 and are scored like any other.
    Repeated rows, and texts of equal features, score alike; a text of any length
    is read whole.  Other columns are never read, so their names cannot clash.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if model.trees is None:
        p = rows.select(F.col("id").alias(id_col), F.lit(float(model.prior)).alias("score"))
    else:
        x = _featured(rows, [model.weights], "id").select("id", array_to_vector("x").alias("features"))
        raw = model.trees.transform(x).select("id", vector_to_array("probability")[1].alias("p"))
        p = model.calibration.transform(raw).select(F.col("id").alias(id_col), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction"))).alias("score"))
    return p.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
