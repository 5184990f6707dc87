"""Logistic regression on the exact terms of texts, fitted without a coefficient per term in one place.

Starting from zero, every step of a quasi-Newton fit is a sum of the rows of X,
the matrix of rows by terms, so the fit works with one number per row in place
of one per term: coefficients are X' a, and the scores of the rows are K a with
K = X X'.  X is stored once by terms, as the latent space stores it.  A step
multiplies K with one vector: a task reads a part of the terms, one chunk after
another, and gives up one number per row.  Rows lie in blocks with what the last
steps left of them; the driver sees sums over blocks alone, of the size of the
number of steps that are kept.

A model is its terms in the chunks of the fit.  Texts are scored in blocks that
send their terms to the buckets of the model, which answer with two numbers per
text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import text_or_empty
from quillon.sources.work import Work, saved, shared_folder, tasks_apart

from .latent import _MATRIX, BLOCK_WORDS, _cells, _in_turn, _one_task, _stored
from .numbering import numbered
from .retrieval import spread
from .term_columns import buckets_for, counted, packed, terms_of, unpacked

#: Rows of a block.
BLOCK_ROWS = 16_384
#: Buckets of terms in a part, which one task multiplies; a part more has one number per row shuffled in each step.
PART_BUCKETS = 8
#: Cores for which a field has a part more: a step is planned anew, which takes a while per part.
PART_CORES = 4
#: Steps that the next direction is made from.
HISTORY = 8
#: Multiples of a direction at which the loss and its slope are looked at.
STEPS = np.array([0.0, *(2.0**-i for i in range(24, 0, -1)), 0.75, 1.0, 1.5, 2.0, 4.0, 8.0])

_STREAM = {"what": "string", "base": "bigint", "n": "int", "a": "binary", "b": "binary", "keys": "array<bigint>", "bucket": "int", "kind": "string", "sizes": "binary", "letters": "binary", "times": "binary", "df": "binary", "docs": "binary", "tf": "binary"}
_STATE = "base bigint, n int, fixed binary, vectors binary, facts array<double>"
_MODEL = "of int, n int, buckets int, bucket int, sizes binary, letters binary, times binary, df binary, found binary"


def _said(what: str, df: DataFrame, /, **own: str) -> DataFrame:
    """Rows of a stream: the named columns, the others null."""
    given = {"what": f"'{what}'", **own}
    return df.selectExpr(*(f"CAST({given.get(c, 'NULL')} AS {t}) AS {c}" for c, t in _STREAM.items()))


class _Field:
    """A column's matrix: ``parts`` of chunks over ``n`` rows, which it numbers in its own way."""

    def __init__(self, rows: DataFrame, text: str, number: int, work: Work) -> None:
        self.number = number
        self.n, self.buckets = buckets_for(rows, text)
        self.parts = min(self.buckets, max(-(-self.buckets // PART_BUCKETS), -(-rows.sparkSession.sparkContext.defaultParallelism // PART_CORES)))
        made, names = _stored(self.parts, pa.int64())
        sent = counted(rows, "number", text, self.buckets, BLOCK_WORDS).repartitionById(self.buckets, "bucket").groupBy("bucket").applyInArrow(made, f"{_MATRIX}, keys array<bigint>").select(*names)
        self.matrix = work.written(sent, f"matrix-{text}", "part", "kind")

    def over(self, part: int, kinds: tuple[str, ...], *given: tuple[str, DataFrame, dict[str, str]]) -> DataFrame:
        """A stream for one task: vectors of the rows, where the rows lie in the matrix, and a part of its chunks."""

        return self.read(part, kinds, *(_said(what, df, base="base", n="n", **columns) for what, df, columns in given), self.placed())

    def placed(self) -> DataFrame:
        """Where the rows lie in the matrix, as rows of a stream."""
        return _said("keys", self.matrix.where("kind = 'keys'"), base="base", n="n", keys="keys")

    def read(self, part: int, kinds: tuple[str, ...], *streams: DataFrame) -> DataFrame:
        """The streams and then a part of the chunks, for one task."""
        chunks = self.matrix.where(F.col("part") == part).where(F.col("kind").isin(*kinds))
        held = {c: c for c in ("bucket", "kind", "times", "df", "docs", "tf", *(("sizes", "letters") if "lone" in kinds else ()))}
        return _one_task(*streams, _said("chunk", chunks, **held))


class _Placed:
    """The vectors of a stream in the order of a matrix's rows; ``made`` takes a row of the first one to its vector."""

    def __init__(self, batches: Iterator[pa.RecordBatch], n: int, names: tuple[str, ...], made: Callable[[dict], np.ndarray] | None = None) -> None:
        self.n, self.batches, self.names, self.made = n, batches, names, made
        self.given = {name: np.zeros(n) for name in names}
        self.at, self.places = np.zeros(n, np.int64), []

    def chunks(self, number: int = 0) -> Iterator[dict]:
        """The chunks, after all vectors; one that holds several vectors per row gives that of ``number``."""
        for row in _in_turn(self.batches, self.n, (*self.names, "keys")):
            what = row["what"]
            if what == "chunk":
                yield row
                continue
            here = slice(row["base"], row["base"] + row["n"])
            if what == "keys":
                self.at[here] = row["keys"]
                continue
            if what == self.names[0]:
                self.places.append(here)
                if self.made:
                    self.given[what][here] = self.made(row)
                    continue
            vectors = _vectors(row["a"], row["n"])
            self.given[what][here] = vectors[number if len(vectors) > 1 else 0]


def _vectors(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(-1, n)


def _sent(**columns) -> pa.RecordBatch:
    kinds = {"base": pa.int64(), "facts": pa.list_(pa.float64()), **dict.fromkeys(("n", "of", "buckets", "bucket"), pa.int32())}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(c, pa.binary())) for c, v in columns.items()], names=list(columns))


def _moved(vectors: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The point (a, K a) and the step (s, K s), which is a sum of the gradient and of the steps kept; and these."""
    point, basis = vectors[:2], vectors[2:].reshape(-1, 2, vectors.shape[1])
    step = np.tensordot(move, basis, 1) if len(move) else np.zeros_like(point)
    return point + step, step, basis


def _residual(y: np.ndarray, weight: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return weight * (np.exp(-np.logaddexp(0, -scores)) - y)


def _direction(gram: np.ndarray) -> np.ndarray:
    """Minus the gradient, turned by the steps kept: factors of the gradient (0) and of each step and its change of the gradient (1, 2 and on)."""
    q, kept = np.zeros(len(gram)), [i for i in range(1, len(gram), 2) if gram[i, i + 1] > 0]
    q[0] = 1.0
    back = {}
    for i in reversed(kept):
        back[i] = float(q @ gram[i]) / gram[i, i + 1]
        q[i + 1] -= back[i]
    if kept:
        q *= gram[kept[-1], kept[-1] + 1] / gram[kept[-1] + 1, kept[-1] + 1]
    for i in kept:
        q[i] += back[i] - float(q @ gram[i + 1]) / gram[i, i + 1]
    return -q


def _lowest(loss: np.ndarray, slope: np.ndarray) -> float:
    """Where a convex function is lowest, from its values and slopes at ``STEPS``; 0 if it only rises."""
    if slope[0] >= 0:
        return 0.0
    rising = np.flatnonzero(slope >= 0)
    if not len(rising):
        return float(STEPS[-1])
    j = int(rising[0])
    width, (f0, f1), (g0, g1) = STEPS[j] - STEPS[j - 1], loss[j - 1 : j + 1], slope[j - 1 : j + 1]
    d1 = g0 + g1 - 3 * (f1 - f0) / width
    d2 = np.sqrt(max(0.0, d1 * d1 - g0 * g1))
    share = 1 - (g1 + d2 - d1) / (g1 - g0 + 2 * d2) if g1 - g0 + 2 * d2 > 0 else 1.0
    return float(STEPS[j - 1] + width * min(max(share, 0.0), 1.0))


def _key_of(column: str) -> Column:
    return F.md5(text_or_empty(F.col(column)))


class TextLogistic(Estimator, HasInputCols, HasLabelCol):
    """Logistic regression on the tf-idf of ``inputCols`` side by side, each column with its own terms.

    Labels are 0 and 1.  Classes have equal weight, the penalty is half the
    squared coefficients against ``C`` times the summed loss, the intercept has
    none.  The fit ends when the gradient is shorter than ``tol``, by which the
    coefficients are then at most wrong, or after ``maxIter`` steps.
    """

    C = Param(Params._dummy(), "C", "weight of the loss against the penalty", typeConverter=TypeConverters.toFloat)

    def __init__(self, inputCols: list[str] | None = None, C: float = 4.0, labelCol: str = "label", maxIter: int = 100, tol: float = 1e-3) -> None:
        super().__init__()
        self.maxIter, self.tol = maxIter, tol
        self._set(C=C, labelCol=labelCol)
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> TextLogisticModel:
        spark, columns, label = dataset.sparkSession, self.getInputCols(), self.getLabelCol()
        with Work(spark) as work, tasks_apart(spark):
            texts = {f"text{i}": text_or_empty(F.col(c)) for i, c in enumerate(columns)}
            rows = numbered(spread(dataset.select(F.col(label).cast("double").alias("y"), *(c.alias(t) for t, c in texts.items()))), [], work)
            classes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
            if not classes or not set(classes) <= {0.0, 1.0}:
                raise ValueError(f"labels are 0 and 1, not {sorted(classes, key=str)}")
            n = sum(classes.values())
            weights = {y: self.getOrDefault(self.C) * n / (len(classes) * size) for y, size in classes.items()}
            fields = [_Field(rows, t, i, work) for i, t in enumerate(texts)]
            a, inverse, intercept = self._solve(rows, fields, n, weights, work)
            chunks = reduce(DataFrame.union, [self._coefficients(f, part, a, inverse) for f in fields for part in range(f.parts)])
            model = saved(chunks, f"{shared_folder(spark, 'logistic')}/chunks")
        return self._copyValues(TextLogisticModel(model, intercept))

    def _solve(self, rows: DataFrame, fields: list[_Field], n: int, weights: dict[float, float], work: Work) -> tuple[DataFrame, DataFrame, float]:
        """In blocks, the rows' numbers a (base, n, a) and one by the length of each field's row (base, n, inverse); and the intercept."""

        width = len(fields)

        def begun(group: pa.Table, squares: pa.Table) -> pa.Table:
            order = np.argsort(group.column("number").to_numpy())
            y = group.column("y").to_numpy()[order].astype("<f8")
            base = int(group.column("number").to_numpy().min())
            lone, inverse = np.zeros(len(y)), np.zeros((width, len(y)))
            for f in range(width):
                own, shared = sum(_vectors(x, len(y)) for x, of in zip(squares.column("a").to_pylist(), squares.column("of").to_pylist(), strict=True) if of == f)
                length = np.sqrt(own + shared)
                np.divide(1, length, out=inverse[f], where=length > 0)
                lone += own * inverse[f] ** 2
            weight = np.where(y == 1, weights.get(1.0, 0.0), weights.get(0.0, 0.0))
            made = _sent(base=base, n=len(y), fixed=np.stack([y, weight, lone]).tobytes(), vectors=np.zeros((2, len(y))).tobytes(), facts=[], inverse=inverse.tobytes())
            return pa.Table.from_batches([made])

        def squared(field: _Field):
            of = field.number

            def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                read, out = _Placed(batches, n, ("rows",)), {"lone": np.zeros(n), "shared": np.zeros(n)}
                for row in read.chunks():
                    times, df, docs, w = _cells(row, n)
                    np.add.at(out[row["kind"]], docs, w * w * np.repeat(times, df))
                found = np.zeros((2, n))
                found[:, read.at] = np.stack(list(out.values()))
                for at in read.places:
                    yield _sent(base=at.start, of=of, a=found[:, at].tobytes())

            return task

        def residual(row: dict, move: np.ndarray, intercept: float) -> np.ndarray:
            (y, weight, _), (point, _, _) = _vectors(row["b"], row["n"]), _moved(_vectors(row["a"], row["n"]), move)
            return _residual(y, weight, point[1] + intercept)

        def multiplied(field: _Field, move: np.ndarray, intercept: float):
            """K times the residuals of the stream's rows, of this part."""
            number = field.number

            def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                read, own, out = _Placed(batches, n, ("rows", "inverse"), lambda row: residual(row, move, intercept)), None, np.zeros(n)
                for row in read.chunks(number):
                    if own is None:
                        own = (read.given["rows"] * read.given["inverse"])[read.at]
                    times, df, docs, w = _cells(row, n)
                    sums = np.add.reduceat(own[docs] * w, np.cumsum(df) - df) * times
                    np.add.at(out, docs, w * np.repeat(sums, df))
                found = np.zeros(n)
                found[read.at] = out
                found *= read.given["inverse"]
                for at in read.places:
                    yield _sent(base=at.start, n=at.stop - at.start, a=found[at].tobytes())

            return task

        def product(state: DataFrame, move: np.ndarray, intercept: float) -> DataFrame:
            rows = _said("rows", state, base="base", n="n", a="vectors", b="fixed")
            each = [f.read(p, ("shared",), rows, still[f.number]).mapInArrow(multiplied(f, move, intercept), "base bigint, n int, a binary") for f in fields for p in range(f.parts)]
            return reduce(DataFrame.union, each)

        def advanced(move: np.ndarray, intercept: float):
            def made(group: pa.Table, products: pa.Table) -> pa.Table:
                (row,), n = group.to_pylist(), group.column("n")[0].as_py()
                fixed = _vectors(row["fixed"], n)
                y, weight, lone = fixed
                point, step, basis = _moved(_vectors(row["vectors"], n), move)
                r = _residual(y, weight, point[1] + intercept)
                gradient = point + np.stack([r, lone * r + sum(np.frombuffer(x, "<f8") for x in products.column("a").to_pylist())])
                kept = [gradient[None]]
                if len(basis):
                    kept += [basis[1:][-2 * (HISTORY - 1) :], step[None], (gradient - basis[0])[None]]
                basis = np.concatenate(kept)
                facts = [float(r.sum()), *(basis[:, 0] @ basis[:, 1].T).ravel().tolist()]
                return pa.Table.from_batches([_sent(base=row["base"], n=n, fixed=row["fixed"], vectors=np.concatenate([point, basis.reshape(-1, n)]).tobytes(), facts=facts)])

            return made

        def searched(move: np.ndarray, intercept: float, along: float):
            """Loss and slope at each of ``STEPS`` times the direction."""

            def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in batch.to_pylist():
                        y, weight, _ = _vectors(row["fixed"], row["n"])
                        vectors = _vectors(row["vectors"], row["n"])
                        _, step, _ = _moved(vectors, move)
                        (a, ka), (d, kd) = vectors[:2], step
                        kd_all, loss, slope = kd + along, [], []
                        for t in STEPS:
                            scores = ka + intercept + t * kd_all
                            loss.append(float(weight @ (np.logaddexp(0, scores) - y * scores)) + 0.5 * float(a @ ka + t * (a @ kd + d @ ka) + t * t * (d @ kd)))
                            slope.append(float(_residual(y, weight, scores) @ kd_all) + 0.5 * float(a @ kd + d @ ka) + t * float(d @ kd))
                        yield _sent(facts=[*loss, *slope])

            return task

        summed = lambda df: np.sum([r.facts for r in df.select("facts").collect()], axis=0)
        base = (F.floor(F.col("number") / BLOCK_ROWS) * BLOCK_ROWS).cast("bigint")
        sizes = work.written(rows.groupBy(base.alias("base")).agg(F.count("*").cast("int").alias("n")).withColumn("a", F.unhex(F.repeat(F.lit("00"), F.col("n") * 8))), "sizes")
        squares = [f.over(p, ("lone", "shared"), ("rows", sizes, {"a": "a"})).mapInArrow(squared(f), "base bigint, of int, a binary") for f in fields for p in range(f.parts)]
        labelled = rows.select("number", "y", base.alias("base")).groupBy("base")
        blocks = work.written(labelled.cogroup(reduce(DataFrame.union, squares).groupBy("base")).applyInArrow(begun, f"{_STATE}, inverse binary"), "blocks")
        inverse, state = blocks.select("base", "n", "inverse"), blocks.drop("inverse")
        # what every step reads again of a field, as one table
        of_rows = _said("inverse", inverse, base="base", n="n", a="inverse")
        still = [work.written(of_rows.union(f.placed()), f"still-{f.number}") for f in fields]
        move, intercept, along = np.zeros(0), 0.0, 0.0
        of_basis: list[float] = []
        for number in range(self.maxIter + 1):
            moved = state.groupBy("base").cogroup(product(state, move, intercept).groupBy("base")).applyInArrow(advanced(move, intercept), _STATE)
            state = work.written(moved, f"state-{number}")
            work.ended(f"state-{number - 1}")
            facts = summed(state)
            # the intercept's part of the gradient and of the steps kept
            of_basis = [facts[0], *([*of_basis[1:][-2 * (HISTORY - 1) :], along, facts[0] - of_basis[0]] if of_basis else [])]
            gram = facts[1:].reshape(len(of_basis), -1)
            gram = (gram + gram.T) / 2 + np.outer(of_basis, of_basis)
            if gram[0, 0] <= self.tol**2 or number == self.maxIter:
                break
            direction = _direction(gram)
            turn = float(direction @ of_basis)
            found = summed(state.mapInArrow(searched(direction, intercept, turn), "facts array<double>"))
            t = _lowest(found[: len(STEPS)], found[len(STEPS) :])
            if t == 0.0:
                break
            move, along = t * direction, t * turn
            intercept += along

        def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _sent(base=row["base"], n=row["n"], a=_vectors(row["vectors"], row["n"])[0].tobytes())

        return state.mapInArrow(point, "base bigint, n int, a binary"), inverse, intercept

    @staticmethod
    def _coefficients(field: _Field, part: int, a: DataFrame, inverse: DataFrame) -> DataFrame:
        """The terms of a part, in its chunks, and the coefficient of each column."""
        n, number, buckets = field.n, field.number, field.buckets

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read, own = _Placed(batches, n, ("rows", "inverse")), None
            for row in read.chunks(number):
                if own is None:
                    own = (read.given["rows"] * read.given["inverse"])[read.at]
                _, df, docs, w = _cells(row, n)
                found = np.add.reduceat(own[docs] * w, np.cumsum(df) - df)
                yield _sent(of=number, n=n, buckets=buckets, **{c: row[c] for c in ("bucket", "sizes", "letters", "times", "df")}, found=packed(found, "<f8"))

        return field.over(part, ("lone", "shared"), ("rows", a, {"a": "a"}), ("inverse", inverse, {"a": "inverse"})).mapInArrow(task, _MODEL)


def _terms_and_values(row: dict) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The terms of a model's chunk, how many rows of the fit hold each, and their coefficients."""
    times = unpacked(row["times"])
    return terms_of(row), np.repeat(unpacked(row["df"]), times), np.repeat(unpacked(row["found"], "<f8"), times)


class TextLogisticModel(Model, HasInputCols, HasLabelCol, MLReadable, MLWritable):
    """``chunks`` of the input columns' terms, ``table`` (of, term, df, coefficient) of them by the column's place, and ``intercept``."""

    def __init__(self, chunks: DataFrame, intercept: float) -> None:
        super().__init__()
        self.chunks, self.intercept = chunks, intercept

    @property
    def table(self) -> DataFrame:
        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    terms, df, found = _terms_and_values(row)
                    yield from pa.Table.from_arrays([pa.array([row["of"]] * len(terms), pa.int32()), terms, pa.array(df, pa.int64()), pa.array(found)], names=["of", "term", "df", "coefficient"]).to_batches(65_536)

        return self.chunks.mapInArrow(made, "of int, term string, df bigint, coefficient double")

    @property
    def coefficients(self) -> DenseVector:
        """All coefficients in the order of columns and terms, brought to the driver; nothing else here does so."""
        return DenseVector([r.coefficient for r in self.table.orderBy("of", "term").select("coefficient").collect()])

    def _scores(self, dataset: DataFrame, column: str, number: int, n: int, buckets: int) -> DataFrame:
        """(_key, _score) of the column's distinct texts, told apart by their md5."""

        def met(texts: pa.Table, model: pa.Table) -> pa.Table:
            rows = texts.to_pylist()
            said = pa.chunked_array([terms_of(r) for r in rows], pa.string()).combine_chunks()
            # terms are numbered over both sides; those that the fit did not see have weight 0
            known = [_terms_and_values(r) for r in model.to_pylist()]
            coded = pa.chunked_array([said, *(k[0] for k in known)]).combine_chunks().dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            idf, coefficient = np.zeros(len(coded.dictionary)), np.zeros(len(coded.dictionary))
            if known:
                idf[codes[len(said) :]] = np.log((1 + n) / (1 + np.concatenate([k[1] for k in known]))) + 1
                coefficient[codes[len(said) :]] = np.concatenate([k[2] for k in known])
            out, at = [], 0
            for r in rows:
                held = unpacked(r["held"])
                code = np.repeat(codes[at : at + len(held)], held)
                at += len(held)
                docs, w = unpacked(r["docs"]), unpacked(r["tf"]) * idf[code]
                out.append(np.stack([np.bincount(docs, w * coefficient[code], r["n"]), np.bincount(docs, w * w, r["n"])]).tobytes())
            return pa.table({"block": texts.column("block"), "keys": texts.column("keys"), "parts": pa.array(out, pa.binary())})

        def summed(group: pa.Table) -> pa.Table:
            keys = next(k for k in group.column("keys").to_pylist() if k is not None)
            dot, square = sum(_vectors(x, len(keys)) for x in group.column("parts").to_pylist())
            return pa.table({"_key": keys, "_score": np.divide(dot, np.sqrt(square), out=np.zeros(len(keys)), where=square > 0)})

        texts = dataset.select(_key_of(column).alias("_key"), text_or_empty(F.col(column)).alias("_text")).dropDuplicates(["_key"])
        sent = counted(texts, "_key", "_text", buckets, BLOCK_WORDS).groupBy("bucket").cogroup(self.chunks.where(F.col("of") == number).groupBy("bucket"))
        each = sent.applyInArrow(lambda a, b: met(a, b) if a.num_rows else pa.table({"block": pa.array([], pa.int64()), "keys": pa.array([], pa.list_(pa.string())), "parts": pa.array([], pa.binary())}), "block bigint, keys array<string>, parts binary")
        return each.groupBy("block").applyInArrow(summed, "_key string, _score double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        facts = {r.of: r for r in self.chunks.select("of", "n", "buckets").distinct().collect()}
        scores = F.lit(self.intercept)
        for i, column in enumerate(self.getInputCols()):
            if i in facts:
                scored = self._scores(dataset, column, i, facts[i].n, facts[i].buckets).withColumnRenamed("_score", f"_score{i}")
                dataset = dataset.withColumn("_key", _key_of(column)).join(scored, "_key", "left").drop("_key")
                scores = scores + F.coalesce(F.col(f"_score{i}"), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.col("_score")))
        made = {"rawPrediction": array_to_vector(F.array(-F.col("_score"), F.col("_score"))), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (p > 0.5).cast("double")}
        return dataset.withColumn("_score", scores).withColumns(made).drop("_score", *(f"_score{i}" for i in facts))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: TextLogisticModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"intercept": self.model.intercept})
        self.model.chunks.write.parquet(f"{path}/chunks")


class _ModelReader(MLReader):
    def load(self, path: str) -> TextLogisticModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TextLogisticModel(self.sparkSession.read.parquet(f"{path}/chunks"), metadata["intercept"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
