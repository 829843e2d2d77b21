"""Model training (I1-I5, I3, J7) with Spark ML estimators; fused models by gradients of sparse rows (``_fit_perceptron``).

Every fit is distributed: gradient steps and tree statistics are aggregated
over partitions, only model parameters and gradients reach the driver. The
training frame is checkpointed first so iterations never recompute the
feature plan (and survive executor loss).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import scores_of_counts
from ..session import cut_lineage, spread


def _n_classes(df: DataFrame, label_col: str) -> int:
    return int(df.agg(F.max(label_col)).first()[0]) + 1


def train_logistic(df: DataFrame, features_col: str = "features", label_col: str = "label", max_iter: int = 1000,
                   n_rows: int | None = None, checkpoint: bool = True):
    """Multinomial logistic regression, L2 with C = 1 (regParam = 1 / n), no standardisation."""
    train = spread(cut_lineage(df.select(features_col, label_col))) if checkpoint else df
    n = n_rows or train.count()
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, family="multinomial",
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return lr.fit(train)


def train_forest(df: DataFrame, features_col: str = "features", label_col: str = "label", n_trees: int = 100,
                 max_depth: int = 20, seed: int = 42, checkpoint: bool = True, max_memory_mb: int = 512):
    """Random forest, sqrt features per split, depth capped at Spark's 30."""
    train = spread(cut_lineage(df.select(features_col, label_col))) if checkpoint else df
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=n_trees,
                                maxDepth=min(max_depth, 30), featureSubsetStrategy="sqrt", seed=seed,
                                maxMemoryInMB=max_memory_mb, cacheNodeIds=True, checkpointInterval=10)
    return rf.fit(train)


def top_importances(model, names: DataFrame, k: int = 10) -> DataFrame:
    """The k largest feature importances joined to feature names (names: (idx, name)).

    The importance vector has one entry per feature (bounded by the vocabulary
    size), so it is turned into a small table.
    """
    spark = names.sparkSession
    imp = model.featureImportances
    rows = [(int(i), float(v)) for i, v in zip(imp.indices, imp.values)] if hasattr(imp, "indices") else \
        [(i, float(v)) for i, v in enumerate(imp.toArray())]
    t = spark.createDataFrame(rows, "idx int, importance double")
    top = t.orderBy(F.desc("importance"), F.desc("idx")).limit(k)
    return top.join(F.broadcast(names), "idx", "left").select("idx", "name", "importance")


def feature_names(vocab_terms: list[str], extra=("vendor_idx", "gl_idx", "amount_scaled")):
    """(idx, name) pairs for the assembled feature vector: vocabulary terms, then the extra columns."""
    return [(i, t) for i, t in enumerate(list(vocab_terms) + list(extra))]


def training_history(model) -> list[tuple[int, float]]:
    """Per-iteration objective of a fitted logistic regression or perceptron."""
    summary = model.summary() if callable(model.summary) else model.summary
    return [(i, float(v)) for i, v in enumerate(summary.objectiveHistory)]


def train_epochs(train: DataFrame, val: DataFrame, features_col: str, label_col: str, layers: list[int],
                 epochs: int = 20, steps: int = 5, seed: int = 42):
    """A perceptron trained ``steps`` iterations an epoch, each epoch from the last one's weights.

    Returns (best model by validation F1, earlier on ties; rows of (epoch, train_loss,
    val_loss, val_accuracy, val_f1)). Both frames are checkpointed once.
    """
    train, val = spread(cut_lineage(train)), cut_lineage(val)
    weights, best, rows = None, None, []
    for epoch in range(1, epochs + 1):
        mlp = MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col, layers=layers, maxIter=steps,
                                             seed=seed)
        if weights is not None:
            mlp = mlp.setInitialWeights(weights)
        model = mlp.fit(train)
        weights = model.weights
        p = F.element_at(vector_to_array("probability"), F.col(label_col).cast("int") + 1)
        scored = model.transform(val).select(F.col(label_col).alias("t"), F.col("prediction").alias("p"),
                                             (-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"))
        got = scored.groupBy("t", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")).collect()
        acc, f1 = scores_of_counts({(r["t"], r["p"]): r["n"] for r in got})
        loss = sum(r["loss"] for r in got) / max(1, sum(r["n"] for r in got))
        rows.append((epoch, training_history(model)[-1][1], float(loss), acc, f1))
        if best is None or f1 > best[0]:
            best = (f1, model)
    return best[1], rows


@dataclass
class FusedModel:
    """I4/I5 result: the branches, their widths and the fitted perceptron."""

    inputs: list[str]
    model: object
    widths: list[int] | None = None
    scaling: dict[str, tuple[list[float], list[float]]] = field(default_factory=dict)  # means and deviations of a branch

    def assemble(self, df: DataFrame) -> DataFrame:
        """Add the concatenated branch vector ``_fused`` (array branches become vectors, null ones zeros)."""
        lacking = [c for c in self.inputs if c not in df.columns]
        if lacking:
            raise ValueError(f"the model was fitted with branches that the table lacks: {', '.join(lacking)}")
        return _assemble(df, self.inputs, self.widths, self.scaling)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classify(self.assemble(df)).drop("_fused")

    def classify(self, df: DataFrame) -> DataFrame:
        """``rawPrediction``, ``probability`` and ``prediction`` of every ``_fused``, as the perceptron's own transform gives them.

        That one multiplies each row by itself, zeros included; here a batch of rows is one matrix.
        """
        run = F.arrow_udf(_perceptron(self.model.weights.toArray(), list(self.model.getLayers())),
                          "struct<raw:array<double>,probability:array<double>,prediction:double>")
        x = df.withColumn("_out", run(F.unwrap_udt(F.col("_fused"))))
        x = x.withColumn("rawPrediction", array_to_vector("_out.raw")).withColumn("probability", array_to_vector("_out.probability"))
        return x.withColumn("prediction", F.col("_out.prediction")).drop("_out")


def _affine(w, layers: list[int]) -> list:
    """(weights, bias) of every layer of a perceptron's flat weights."""
    parts, at = [], 0
    for n_in, n_out in zip(layers[:-1], layers[1:]):
        parts.append((w[at:at + n_in * n_out].reshape(n_in, n_out), w[at + n_in * n_out:at + (n_in + 1) * n_out]))
        at += (n_in + 1) * n_out
    return parts


BATCH_CELLS = 1 << 18  # entries of the matrix that a batch of vectors becomes, at most


def _perceptron(weights, layers: list[int]):
    """Scores of ML vectors (as ``unwrap_udt`` gives them: type, size, indices, values), for ``arrow_udf``."""
    parts, dim, cells = _affine(weights, layers), layers[0], BATCH_CELLS

    def run(vectors: pa.Array) -> pa.Array:
        n = len(vectors)
        _, size, indices, values = vectors.flatten()
        if (bad := size.drop_null().unique().to_pylist()) and bad != [dim]:
            raise ValueError(f"a vector has {bad} entries, the model {dim}")
        lists = [(x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for x in (indices, values)]
        (at, idx), (v_at, val) = lists
        sparse = indices.is_valid().to_numpy(zero_copy_only=False)
        raw, step = np.empty((n, layers[-1])), max(1, cells // dim)
        for a in range(0, n, step):
            b = min(a + step, n)
            x = np.zeros((b - a, dim))
            mine = np.repeat(np.arange(b - a), np.diff(v_at[a:b + 1]))
            entry = np.repeat(sparse[a:b], np.diff(v_at[a:b + 1]))
            got = val[v_at[a]:v_at[b]]
            x[mine[entry], idx[at[a]:at[b]]] = got[entry]
            if not sparse[a:b].all():
                if (np.diff(v_at[a:b + 1])[~sparse[a:b]] != dim).any():
                    raise ValueError(f"a vector has another number of entries than the model's {dim}")
                x[~sparse[a:b]] = got[~entry].reshape(-1, dim)
            for w, bias in parts[:-1]:
                x = 0.5 + 0.5 * np.tanh((x @ w + bias) / 2)  # the logistic function, without overflow
            raw[a:b] = x @ parts[-1][0] + parts[-1][1]
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        rows = np.arange(0, (n + 1) * layers[-1], layers[-1], dtype=np.int32)
        out = [pa.ListArray.from_arrays(rows, x.ravel()) for x in (raw, e / e.sum(axis=1, keepdims=True))]
        return pa.StructArray.from_arrays([*out, pa.array(raw.argmax(axis=1).astype(float))], ["raw", "probability", "prediction"])
    return run


def _assemble(df: DataFrame, inputs: list[str], widths: list[int] | None, scaling: dict) -> DataFrame:
    x = df
    for c, n in zip(inputs, widths or [None] * len(inputs)):
        if c in scaling:
            mean, std = (F.array(*[F.lit(float(v)) for v in part]) for part in scaling[c])
            away = F.zip_with(F.col(c), mean, lambda v, m: v.cast("double") - m)
            x = x.withColumn(c, F.zip_with(away, std, lambda v, d: v / d))
        x = _as_vector(x, c, n)
    return VectorAssembler(inputCols=inputs, outputCol="_fused").transform(x)


def _as_vector(df: DataFrame, col: str, width: int | None = None) -> DataFrame:
    """The branch as a vector column; with ``width`` a null becomes zeros."""
    v = array_to_vector(F.col(col)) if dict(df.dtypes)[col].startswith("array") else F.col(col)
    if width:
        v = F.when(F.col(col).isNull(), array_to_vector(F.array_repeat(F.lit(0.0), width))).otherwise(v)
    return df.withColumn(col, v)


def _width(df: DataFrame, col: str) -> int:
    """Entries of a branch, read from one row that has it."""
    row = df.where(F.col(col).isNotNull()).select(col).first()
    if row is None:
        raise ValueError(f"branch {col} is null in every row")
    return len(row[0])


def _scaling(df: DataFrame, col: str, width: int) -> tuple[list[float], list[float]]:
    """Mean and population deviation (0 -> 1) of every entry of an array branch, from one aggregate."""
    row = df.agg(*[f(F.col(col)[i].cast("double")).alias(f"{n}{i}") for i in range(width)
                   for n, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    return [float(row[f"m{i}"] or 0.0) for i in range(width)], [float(row[f"d{i}"] or 1.0) for i in range(width)]


def train_fused(df: DataFrame, label_col: str = "label", text_col: str | None = None,
                numeric_col: str | None = None, embedding_col: str | None = None, use_text: bool | None = None,
                use_numeric: bool | None = None, use_embedding: bool | None = None, hidden=(256, 128), max_iter: int = 100,
                seed: int = 42, n_classes: int | None = None, scale_numeric: bool = False) -> FusedModel:
    """I4: concatenate the chosen branches (text vector, numeric vector, embedding) into one perceptron.

    Layers: [input, 256, 128, classes] (sigmoid hidden layers, softmax output). A branch is used if it is named, unless
    its switch is off; a switch that is on without a named column of the table is an error, and so is no branch at all.
    Branches of several tables are joined by key first (see ``join_branches``); a row's null branch counts as zeros.
    ``scale_numeric`` centres and scales the numeric branch (an array) by what the training rows hold.
    """
    named = {"text": (text_col, use_text), "numeric": (numeric_col, use_numeric), "embedding": (embedding_col, use_embedding)}
    for name, (c, use) in named.items():
        if (use and not c) or (c and use is not False and c not in df.columns):
            raise ValueError(f"the {name} branch is to be used, but the table has no column {c or 'for it'}")
    chosen = [c for c, use in named.values() if c and use is not False]
    if not chosen:
        raise ValueError("at least one branch (text, numeric or embedding) must be used")
    rows = spread(cut_lineage(df.select(*chosen, label_col)))
    widths = [_width(rows, c) for c in chosen]
    scaling = {numeric_col: _scaling(rows, numeric_col, widths[chosen.index(numeric_col)])} if scale_numeric and numeric_col in chosen else {}
    layers = [sum(widths), *hidden, n_classes or _n_classes(rows, label_col)]
    x = _assemble(rows, chosen, widths, scaling).select("_fused", F.col(label_col).cast("double").alias("_label"))
    weights = _fit_perceptron(x, rows.count(), layers, max_iter, seed)
    # Spark's model around these weights: no iteration, so one row is enough.
    mlp = MultilayerPerceptronClassifier(featuresCol="_fused", labelCol="_label", layers=layers, maxIter=0, initialWeights=Vectors.dense(weights))
    return FusedModel(chosen, mlp.fit(x.limit(1)), widths, scaling)


BLOCK_ROWS = 256  # rows of a block, see ``_blocks``
STEP_CELLS = 1 << 21  # entries of the matrix that rows of blocks become in a step, at most
TASK_CELLS = 1 << 22  # entries (zeros too) for which a step takes one more task
GRADIENT_BYTES = 256 << 20  # that the tasks of a step send to the driver, at most


def _blocks(dim: int, k: int):
    """For ``mapInArrow`` over (vector as ``unwrap_udt`` gives it, label): blocks of rows as (ends, indices, values, labels) in bytes."""
    most = BLOCK_ROWS

    def pack(batches):
        for batch in batches:
            n, label = len(batch), batch.column(1).to_numpy(zero_copy_only=False)
            if not n:
                continue
            if not np.isin(label, np.arange(k)).all():
                raise ValueError(f"labels must be whole numbers from 0 to {k - 1}, none null")
            _, size, indices, values = batch.column(0).flatten()
            sparse = indices.is_valid().to_numpy(zero_copy_only=False)
            (at, idx), (v_at, val) = ((x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for x in (indices, values))
            many = np.diff(v_at)
            if (many[~sparse] != dim).any() or size.drop_null().unique().to_pylist() not in ([], [dim]):
                raise ValueError(f"a vector has another number of entries than {dim}")
            column, entry = np.empty(v_at[-1] - v_at[0], np.int32), np.repeat(sparse, many)
            column[entry] = idx[at[0]:at[-1]]
            column[~entry] = np.tile(np.arange(dim, dtype=np.int32), int((~sparse).sum()))
            val, v_at = val[v_at[0]:v_at[-1]], v_at - v_at[0]
            for a in range(0, n, most):
                b = min(a + most, n)
                part = [v_at[a:b + 1] - v_at[a], column[v_at[a]:v_at[b]], val[v_at[a]:v_at[b]], label[a:b]]
                kinds = (np.int64, np.int32, np.float64, np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip(part, kinds)],
                                                 names=["ends", "idx", "val", "label"])
    return pack


def _gradient(weights, layers: list[int]):
    """For ``mapInArrow`` over blocks: (summed cross-entropy, rows, summed gradient) of a task's rows.

    ``weights`` is a broadcast of the flat weights. The products with the first layer, nearly all of the work where vectors are long, are
    taken in single precision; all else, and every sum over batches of rows, in double.
    """
    cells, dim = STEP_CELLS, layers[0]

    def run(batches):
        w, at, parts = weights.value, 0, []
        g = np.zeros(len(w))
        for n_in, n_out in zip(layers[:-1], layers[1:]):
            mid, end = at + n_in * n_out, at + (n_in + 1) * n_out
            parts.append([(v[at:mid].reshape(n_in, n_out), v[mid:end]) for v in (w, g)])
            at = end
        first, loss, rows = parts[0][0][0].astype(np.float32), 0.0, 0
        for batch in batches:
            for k in range(len(batch)):
                ends, idx, val, label = (np.frombuffer(batch.column(i)[k].as_buffer(), t) for i, t in enumerate(
                    (np.int64, np.int32, np.float64, np.float64)))
                step = max(1, cells // dim)
                for a in range(0, len(label), step):
                    b = min(a + step, len(label))
                    x = np.zeros((b - a, dim), np.float32)
                    x[np.repeat(np.arange(b - a), np.diff(ends[a:b + 1])), idx[ends[a]:ends[b]]] = val[ends[a]:ends[b]]
                    hidden, z = [x], (x @ first).astype(np.float64) + parts[0][0][1]
                    for (m, bias), _ in parts[1:]:
                        hidden.append(0.5 + 0.5 * np.tanh(z / 2))  # the logistic function, without overflow
                        z = hidden[-1] @ m + bias
                    z -= z.max(axis=1, keepdims=True)
                    e = np.exp(z)
                    total, y = e.sum(axis=1, keepdims=True), (np.arange(b - a), label[a:b].astype(int))
                    loss += float((np.log(total[:, 0]) - z[y]).sum())
                    rows += b - a
                    d = e / total
                    d[y] -= 1
                    for i in range(len(parts) - 1, -1, -1):
                        (m, _), (gm, gb) = parts[i]
                        gm += hidden[i].T @ (d if i else d.astype(np.float32))
                        gb += d.sum(axis=0)
                        if i:
                            d = (d @ m.T) * hidden[i] * (1 - hidden[i])
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([rows], pa.int64()), pa.array([g.astype(np.float32).tobytes()], pa.binary())],
                                         names=["loss", "n", "g"])
    return run


def _fit_perceptron(x: DataFrame, n: int, layers: list[int], max_iter: int, seed: int) -> np.ndarray:
    """Flat weights that minimise the mean cross-entropy of all ``n`` rows of ``x`` (``_fused``, ``_label``), by L-BFGS.

    The rows are packed once, sparse as they are; a step is one job whose tasks send their gradients to the driver. (Spark's
    own fit keeps every row as a dense one.)
    """
    spark = x.sparkSession
    sc = spark.sparkContext
    size = sum((i + 1) * o for i, o in zip(layers[:-1], layers[1:]))
    tasks = max(1, min(sc.defaultParallelism, n * layers[0] // TASK_CELLS, GRADIENT_BYTES // (4 * size)))
    rows = x.select(F.unwrap_udt(F.col("_fused")).alias("v"), "_label")
    blocks = rows.mapInArrow(_blocks(layers[0], layers[-1]), "ends binary, idx binary, val binary, label binary")
    blocks = cut_lineage(blocks.repartition(tasks))

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        sent = sc.broadcast(w)
        got = blocks.mapInArrow(_gradient(sent, layers), "loss double, n long, g binary").collect()
        sent.destroy()
        many, g = max(1, sum(r["n"] for r in got)), np.zeros(size)
        for r in got:
            g += np.frombuffer(r["g"], np.float32)
        return sum(r["loss"] for r in got) / many, g / many

    rng = np.random.default_rng(seed)
    start = np.concatenate([rng.uniform(-2.4, 2.4, (i + 1) * o) / np.sqrt(i) for i, o in zip(layers[:-1], layers[1:])])
    return _lbfgs(value, start, max_iter)


def _lbfgs(value, w: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> np.ndarray:
    """Minimum of ``value`` (loss and gradient of weights) from ``w``: steps of limited memory, each found by bisection until both
    Wolfe conditions hold; values that are no finite numbers count as too far."""
    f, g = value(w)
    losses, past = [f], []
    for _ in range(max_iter):
        d, held = -g, []
        for s, y, rho in reversed(past):
            held.append(rho * (s @ d))
            d = d - held[-1] * y
        d = d * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, float(np.linalg.norm(g))))
        for (s, y, rho), a in zip(past, reversed(held)):
            d = d + (a - rho * (y @ d)) * s
        slope = float(g @ d)
        if not slope < 0:
            break
        low, high, t = 0.0, np.inf, 1.0
        for _ in range(30):
            f_new, g_new = value(w + t * d)
            if not np.isfinite(f_new) or f_new > f + 1e-4 * t * slope:
                high = t
            elif g_new @ d < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if np.isfinite(high) else 2 * low
        if not f_new < f:
            break
        s, y = t * d, g_new - g
        if s @ y > 0:
            past = [*past, (s, y, 1 / (s @ y))][-memory:]
        w, f, g = w + s, f_new, g_new
        losses = [*losses, f][-memory:]
        if max(losses) - f <= tol * max(losses[0], f) and len(losses) > 1 or np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            break
    return w


def join_branches(base: DataFrame, key: str, *branches: DataFrame) -> DataFrame:
    """I4: ``base`` with the columns of each branch table of that key; a key that a branch lacks gets nulls.

    Each branch must hold one row a key. Nothing is broadcast by force: a branch can be as large as the base.
    """
    out = base
    for b in branches:
        out = out.join(b, key, "left")
    return out


def forward(weights: list[float], layers: list[int]):
    """A perceptron's class probabilities from its weights, as a batch model for ``score_with``."""
    parts = _affine(np.asarray(weights), layers)

    def make():
        def predict(x):
            x = np.asarray(x, dtype=np.float64)
            for a, b in parts[:-1]:
                x = 0.5 + 0.5 * np.tanh((x @ a + b) / 2)  # the logistic function, without overflow
            z = x @ parts[-1][0] + parts[-1][1]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return (e / e.sum(axis=1, keepdims=True)).astype(np.float32)
        return predict
    return make


def train_embedding_only(df: DataFrame, embedding_col: str = "embedding", label_col: str = "label",
                         hidden: int = 256, max_iter: int = 100, seed: int = 42) -> FusedModel:
    """Precomputed embedding -> 256 -> classes."""
    return train_fused(df, label_col, embedding_col=embedding_col, hidden=(hidden,), max_iter=max_iter, seed=seed)
