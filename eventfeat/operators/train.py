"""Training and batch scoring with Spark ML.

Training is distributed: L-BFGS on the driver steps over weights only, and each of its
values and gradients is one pass over all rows, which workers hold in blocks and multiply
in numpy (in double precision, as the library does it far more slowly in the JVM).  Start
weights, layout and the fitted model are MultilayerPerceptronClassifier's; scoring is a
plain ``transform``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.operators.lbfgs import minimize

# --- fixed values: hidden layers and optimiser settings of the two MLP variants
ARCH = {
    "mlp1": {"hidden": (128, 64), "step_size": 0.01},
    "mlp2": {"hidden": (32,), "step_size": 0.005},
}
MAX_ITER, BLOCK_SIZE, SEED, TOL = 100, 128, 42, 1e-6
# rows of one training task: TASK_ROWS at least and FULL_ROWS at most; from MAX_TASKS on, tasks get more rows
TASK_ROWS, FULL_ROWS, MAX_TASKS = 8192, 262_144, 1024
# bytes of a held block at most; rows multiplied at once (their activations stay in a core's cache);
# bytes of partial gradients that may meet on the driver at once
BLOCK_BYTES, CHUNK_ROWS, DRIVER_BYTES = 4 << 20, 384, 32 << 20


def spread_rows(train: DataFrame) -> DataFrame:
    """``train`` dealt evenly over tasks by its number of rows, in as many tasks as keep all cores at
    work to the end.  The trainer passes over its input's partitions once or more per iteration, so a
    small file (one partition) would be trained on by one core, however many rows it holds."""
    rows, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    tasks = min(MAX_TASKS, -(-rows // TASK_ROWS), cores * max(1, -(-rows // (FULL_ROWS * cores))))
    return train.repartition(tasks) if tasks > 1 else train


def train_mlp(train: DataFrame, features: str, label: str, hidden: Sequence[int] = (128, 64), n_classes: int = 2,
              max_iter: int = MAX_ITER, step_size: float = 0.01, block_size: int = BLOCK_SIZE, seed: int = SEED,
              tol: float = TOL, input_dim: int | None = None) -> MultilayerPerceptronClassificationModel:
    """Fit an MLP ``[d, *hidden, n_classes]``; ``d`` is read from the vector
    column's ML attribute metadata (no data pass) unless given.  Rows are dealt anew
    first (``spread_rows``).

    Minimises the mean loss of the rows.  The library weighs blocks of ``block_size`` rows, so there
    the short last block of each partition counts as much as a full one; here each row counts the same
    for any ``block_size``, which is only kept with the model, as is ``step_size`` (L-BFGS has none)."""
    if input_dim is None:
        meta = train.schema[features].metadata.get("ml_attr", {})
        input_dim = meta.get("num_attrs")
        if input_dim is None:
            input_dim = len(train.select(features).first()[0])
    layers = [int(input_dim), *hidden, n_classes]
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers,
                                         maxIter=max_iter, stepSize=step_size, blockSize=block_size, seed=seed, tol=tol)
    rows = spread_rows(train.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y")))
    blocks = rows.mapInArrow(_pack(layers[0], n_classes), "block binary").rdd.map(lambda r: bytes(r[0]))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        weights, history = minimize(lambda w: _mean_loss(blocks, layers, w), _start_weights(mlp, train, features, label), max_iter, tol)
    finally:
        blocks.unpersist()
    return _fitted(mlp, weights, history, train.withColumn(label, F.col(label).cast("double")))


def _start_weights(mlp: MultilayerPerceptronClassifier, train: DataFrame, features: str, label: str) -> np.ndarray:
    """The library's random weights for the layers and the seed: a fit of no iterations."""
    zeros = F.array_repeat(F.lit(0.0), mlp.getLayers()[0])
    one = train.sparkSession.range(1).select(array_to_vector(zeros).alias(features), F.lit(0.0).alias(label))
    return mlp.copy({mlp.maxIter: 0}).fit(one).weights.toArray()


def _fitted(mlp: MultilayerPerceptronClassifier, weights: np.ndarray, history: Sequence[float],
            train: DataFrame) -> MultilayerPerceptronClassificationModel:
    """The library's model of these weights, with its summary over the training rows."""
    name = "org.apache.spark.ml.classification.MultilayerPerceptronClassification"
    model = MultilayerPerceptronClassificationModel(JavaWrapper._new_java_obj(f"{name}Model", mlp.uid, DenseVector(weights)))
    model = mlp._copyValues(model)
    sc = train.sparkSession.sparkContext
    values = JavaWrapper._new_java_array([float(v) for v in history], sc._gateway.jvm.double)
    summary = JavaWrapper._new_java_obj(f"{name}TrainingSummaryImpl", model.transform(train)._jdf, model.getPredictionCol(),
                                        model.getLabelCol(), "", values)
    model._java_obj.setSummary(sc._jvm.scala.Some(summary))
    return model


def _pack(width: int, n_classes: int) -> Callable:
    """Rows to blocks, a line of doubles for each feature, one of ones and one of labels.  What the
    library refuses is refused: labels that are no class, vectors with NULL or not finite values."""
    def pack(batches: Iterable) -> Iterator:
        import pyarrow as pa

        step = max(1, BLOCK_BYTES // (8 * (width + 2)))
        for b in batches:
            if b.column("x").null_count or any(n != width for n in b.column("x").value_lengths().unique().to_pylist()):
                raise ValueError(f"Vectors MUST have {width} values and MUST NOT be Null")
            y = b.column("y").to_numpy(zero_copy_only=False)
            if b.num_rows and not (odd := (y >= 0) & (y < n_classes) & (y == np.floor(y))).all():
                raise ValueError(f"Labels MUST be integers in [0, {n_classes}) and not Null, but got {y[~odd][0]}")
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not np.isfinite(x).all():
                raise ValueError("Vector values MUST NOT be NaN or Infinity")
            for at in range(0, b.num_rows, step):
                block = np.ones((width + 2, len(y[at:at + step])))
                block[:-2], block[-1] = x[at:at + step].T, y[at:at + step]
                yield pa.RecordBatch.from_pydict({"block": pa.array([block.tobytes()], pa.binary())})

    return pack


def _mean_loss(blocks: RDD, layers: Sequence[int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross-entropy of all rows and its gradient, in one pass.  Partial sums meet on the
    driver, or over a tree of tasks first if they are large."""
    depth = 1 if blocks.getNumPartitions() * weights.nbytes <= DRIVER_BYTES else 2
    total = blocks.mapPartitions(_sums(layers, weights)).treeAggregate(np.zeros(2 + len(weights)), np.add, np.add, depth)
    rows = total[1] or math.nan
    return float(total[0] / rows), total[2:] / rows


def _sums(layers: Sequence[int], weights: np.ndarray) -> Callable:
    """Blocks to one vector of loss, rows and gradient, summed.  Each layer's weights are
    ``(inputs + 1) x outputs`` with the bias last, so a line of ones under the inputs carries it.
    The softmax is taken of the outputs less the first class's, which leaves it the same."""
    def sums(blocks: Iterable[bytes]) -> Iterator[np.ndarray]:
        out = np.zeros(2 + len(weights))
        ends, last = np.cumsum([0, *((a + 1) * b for a, b in zip(layers, layers[1:]))]), len(layers) - 2
        shaped = lambda v: [v[s:e].reshape(-1, b) for s, e, b in zip(ends, ends[1:], layers[1:])]
        w, gradient = shaped(weights), shaped(out[2:])
        w[last] = w[last][:, 1:] - w[last][:, :1]
        # minus the weights below a sigmoid, as 1 / (1 + exp(-z)) needs -z
        up = [np.ascontiguousarray(v.T if i == last else -v.T) for i, v in enumerate(w)]
        down = [np.ascontiguousarray(v[:-1]) for v in w]
        held = [None, *(np.ones((n + 1, CHUNK_ROWS)) for n in layers[1:-1])]
        back, part, total = [np.empty((n, CHUNK_ROWS)) for n in layers[:-1]], [np.empty_like(v) for v in w], [np.zeros_like(v) for v in w]
        for raw in blocks:
            x = np.frombuffer(raw).reshape(layers[0] + 2, -1)
            hit = (x[-1] == np.arange(1, layers[-1])[:, None]).astype(float)
            out[1] += x.shape[1]
            for at in range(0, x.shape[1], CHUNK_ROWS):
                ins, y = [x[:-1, at:at + CHUNK_ROWS]], hit[:, at:at + CHUNK_ROWS]
                m = y.shape[1]
                for i in range(last):
                    ins.append(held[i + 1][:, :m])
                    z = np.matmul(up[i], ins[i], out=ins[-1][:-1])
                    np.exp(z, out=z)
                    z += 1
                    np.reciprocal(z, out=z)
                z = up[last] @ ins[last]
                top = np.maximum(z.max(axis=0), 0)
                out[0] += top.sum() - (z * y).sum()
                z -= top
                np.exp(z, out=z)
                q = z.sum(axis=0) + np.exp(-top)
                out[0] += np.log(q).sum()
                z /= q
                z -= y
                for i in range(last, -1, -1):
                    total[i] += np.matmul(ins[i], z.T, out=part[i])
                    if i:
                        a, z = ins[i][:-1], (np.multiply if len(z) == 1 else np.matmul)(down[i], z, out=back[i][:, :m])
                        z *= a
                        np.subtract(1, a, out=a)
                        z *= a
        for g, t in zip(gradient, total):
            g[:, -t.shape[1]:] = t
        gradient[last][:, 0] = -total[last].sum(axis=1)
        yield out

    def quiet(blocks: Iterable[bytes]) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):  # exp of a far negative sum: its sigmoid is 0
            yield from sums(blocks)

    return quiet


def training_loss(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str, label: str) -> DataFrame:
    """E11 check: one row ``rows, loss, gradient`` of a fitted two-class model on ``df``:
    mean cross-entropy, and the largest partial derivative of the loss that the output
    layer has in closed form (``mean((p - y) * input)``): all weights and biases of a model
    without hidden layers, the biases of any other.  Both come from Spark expressions over
    the scored rows; at an optimum the gradient is zero."""
    x = score(model, df).select("prob_pos", F.col(label).cast("double").alias("_y"), vector_to_array(F.col(features)).alias("_x"))
    p = F.greatest(F.lit(1e-300), F.when(F.col("_y") == 1, F.col("prob_pos")).otherwise(1 - F.col("prob_pos")))
    miss = F.col("prob_pos") - F.col("_y")
    layers = model.getLayers()
    parts = [F.abs(F.avg(miss))] + ([F.abs(F.avg(miss * F.get("_x", F.lit(i)))) for i in range(layers[0])] if len(layers) == 2 else [])
    return x.agg(F.count(F.lit(1)).alias("rows"), F.avg(-F.log(p)).alias("loss"), F.greatest(*parts, F.lit(0.0)).alias("gradient"))


def score(model, df: DataFrame, prob_col: str = "prob_pos") -> DataFrame:
    """E12 (+D2): transform and expose P(class 1) as a double column, without a
    Python UDF (``vector_to_array(probability)[1]``)."""
    out = model.transform(df)
    return out.withColumn(prob_col, vector_to_array(F.col("probability"))[1])


def train_per_fold(windows: DataFrame, spec, label: str, arch: str = "mlp1", fold_col: str = "fold",
                   role_col: str = "role", features: str = "log_scaled_features", threshold: float = 0.5,
                   max_iter: int = MAX_ITER) -> DataFrame:
    """E11 + E13 per fold: for every fold of a ``(fold, role)``-tagged table, fit the
    feature pipeline and the MLP on its train rows (refit per fold), score its train
    and val rows, and compute all metrics for every (fold, role) in one grouped
    aggregate over the union of scored rows.  Only the fold ids (a handful) reach
    the driver."""
    from eventfeat.functions.numeric import classify
    from eventfeat.operators.evaluate import classification_metrics
    from eventfeat.operators.features import feature_pipeline

    a = ARCH[arch]
    fold_ids = sorted(r[0] for r in windows.select(fold_col).distinct().collect())
    scored = None
    for f in fold_ids:
        part = windows.filter(F.col(fold_col) == f)
        tr = part.filter(F.col(role_col) == "train")
        va = part.filter(F.col(role_col) == "val")
        pm = feature_pipeline(spec).fit(tr)
        model = train_mlp(pm.transform(tr), features, label, hidden=a["hidden"], step_size=a["step_size"], max_iter=max_iter)
        for role, d in (("train", tr), ("val", va)):
            s = score(model, pm.transform(d)).select(F.lit(f).alias(fold_col), F.lit(role).alias(role_col),
                                                     F.col(label).cast("double").alias(label), "prob_pos")
            scored = s if scored is None else scored.unionByName(s)
    if scored is None:
        return windows.sparkSession.createDataFrame([], f"{fold_col} int, {role_col} string")
    scored = scored.withColumn("_pred", classify("prob_pos", threshold))
    return classification_metrics(scored, label, "_pred", "prob_pos", by=[fold_col, role_col])
