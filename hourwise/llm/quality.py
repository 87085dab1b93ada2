"""Quality classifier: Naive Bayes support vectors.

A document is the set of its n-grams: byte 1- to 3-grams of the text as it stands, and runs of 2, 3 and 4 equal
words (n-grams of the pattern of words), hashed to ``GRAMS`` numbers. Each indicator is scaled by its class
log-count ratio, the scaled vector is brought to length 1, and a linear hinge-loss model is fitted by dual
coordinate descent. The descent runs on blocks of rows in parallel: in each round every block improves its own dual
variables against the shared weights, and the changes of all blocks are added up (the quadratic term is scaled by the
number of blocks, so that adding is safe). Rows are dealt to their blocks once and kept there; a round shuffles changes only. Platt's sigmoid turns the margin into a score; it is fitted on the margins that each row
has under a model that did not see it: besides the model of all rows there is one for each of ``FOLDS`` parts left out, and all are
fitted in the same jobs.

Bounds: training reads at most about ``per_label`` rows a label, chosen by a hash of (doc_id, text) of the labelled rows;
the sigmoid weighs them back to the shares of all labelled rows. The model is ``GRAMS`` numbers. All documents are
scored, each from its whole text.

Defined cases: a null text counts as empty; an empty text has no n-gram, so its score is that of a margin of the bias
alone. A null doc_id is not held out and has no label. Labels other than 0 and 1 are no labels; a document labelled both ways
counts once for each. Repeated rows are scored each; identical (doc_id, text) are learned from once. Without labels every score is 0.5, with
rows of only one label it is the smoothed share of label 1. An empty table gives no rows. Only doc_id and
text are read of documents, and doc_id and quality of labels; other columns, whatever their names, are not looked at.
Long texts are read in pieces of 1 MiB.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.llm.common import travels
from hourwise.llm.text import PIECE, texts_of
from hourwise.session import discard, materialize

travels(__name__)

#: Rows a label that training reads at most (as an expected number, the choice being by a hash).
PER_LABEL = 10_000
BITS = 18
GRAMS = 1 << BITS
SMOOTHING, COST = 1.0, 10.0
BLOCKS, ROUNDS, EPOCHS = 4, 6, 4
#: Partitions that the blocks are dealt to; in 5 the hashes of 4 blocks are all apart (two in one only cost time).
PARTITIONS = 5
#: Parts of the rows that are left out in turn for the sigmoid.
FOLDS = 3
THRESHOLD = 0.3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAD = b" "


def _hashed(codes: np.ndarray) -> np.ndarray:
    return ((codes + np.uint64(1)) * _MIX) >> np.uint64(64 - BITS)


def _piece_grams(piece: bytes) -> list[np.ndarray]:
    b = np.frombuffer(piece, dtype=np.uint8).astype(np.uint64)
    two = b[:-1] << np.uint64(8) | b[1:]
    three = two[:-1] << np.uint64(8) | b[2:]
    sized = lambda x, n: x | np.uint64(n << 24)
    return [np.unique(_hashed(x)) for x in (sized(np.unique(b), 1), sized(two, 2), sized(three, 3))]


def _equal_runs(raw: bytes, longest: int, last: bytes, run: int) -> tuple[int, bytes, int]:
    """Longest run of equal words so far, the last word and the length of its run."""
    for word in raw.split():
        run = run + 1 if word == last else 1
        longest, last = max(longest, run), word
    return longest, last, run


def grams_of(raw: bytes | None) -> np.ndarray:
    """Sorted numbers of the n-grams of a text."""
    if not raw:
        return np.zeros(0, dtype=np.int32)
    found, longest, last, run, cut = [], 0, b"", 0, 0
    for at in range(0, len(raw), PIECE):
        piece = raw[max(0, at - 2):at + PIECE]  # pieces share two bytes, so that no n-gram is lost
        found += _piece_grams((_PAD if at == 0 else b"") + piece + (_PAD if at + PIECE >= len(raw) else b""))
        if at + PIECE >= len(raw):
            end = len(raw)
        elif (end := max(raw.rfind(c, cut, at + PIECE) for c in b" \n\t\r\x0b\x0c")) < cut:
            continue  # no word ends here
        longest, last, run = _equal_runs(raw[cut:end], longest, last, run)
        cut = end
    runs = np.array([4 << 24 | n for n in (2, 3, 4) if longest >= n], dtype=np.uint64)
    return np.unique(np.concatenate([*found, _hashed(runs)])).astype(np.int32)


def held_out(docs: DataFrame):
    """True for the documents whose labels training may not read."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _features(batches):
    for batch in batches:
        grams = [grams_of(raw) for raw in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("y"), batch.column("fold"), pa.array(grams, pa.list_(pa.int32()))],
            names=["row", "y", "fold", "grams"])


def _count(batches):
    counts = np.zeros((FOLDS, 2, GRAMS), dtype=np.int32)
    for batch in batches:
        for y, fold, grams in zip(batch.column("y").to_pylist(), batch.column("fold").to_pylist(), batch.column("grams")):
            counts[fold, y, grams.values.to_numpy()] += 1
    fold, at = np.nonzero(counts.sum(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(fold, pa.int32()), pa.array(at, pa.int64()), pa.array(counts[fold, 0, at], pa.int64()),
                                      pa.array(counts[fold, 1, at], pa.int64())], names=["fold", "gram", "n0", "n1"])


def log_ratio(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log-count ratio of every gram."""
    p0, p1 = n0 + SMOOTHING, n1 + SMOOTHING
    return np.log(p1 / p1.sum()) - np.log(p0 / p0.sum())


def scaled(grams: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The values of a document's indicators: log-count ratios, of length 1 together."""
    x = ratio[grams]
    return x / max(1e-9, float(np.sqrt(x @ x)))


def descend(rows, weights: np.ndarray, ratio: np.ndarray, duals: dict[int, float], cost, blocks: int, epochs: int):
    """One round of a block: (changes of the weights, new dual variables). ``rows``: (row, y, grams); the last weight
    is the bias."""
    rows = sorted(rows, key=lambda r: r[0])
    x = [scaled(g, ratio) for _, _, g in rows]
    sizes = [blocks * (float(v @ v) + 1.0) for v in x]
    a = np.array([duals.get(r[0], 0.0) for r in rows])
    local, bias, change = weights.copy(), weights[-1], np.zeros_like(weights)
    order = np.random.default_rng(len(rows))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            _, y, g = rows[i]
            s = 2.0 * y - 1.0
            new = min(max(a[i] - (s * (local[g] @ x[i] + bias) - 1.0) / sizes[i], 0.0), cost[y])
            if (d := (new - a[i]) * s):
                local[g] += blocks * d * x[i]
                bias += blocks * d
                change[g] += d * x[i]
                change[-1] += d
                a[i] = new
    return change, {r[0]: float(v) for r, v in zip(rows, a)}


def _round(shared, blocks: int, epochs: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(r), int(y), np.asarray(g)) for r, y, g in zip(pdf["row"], pdf["y"], pdf["grams"])]
        found = []
        for model, (weights, ratio, duals, cost) in enumerate(zip(*shared.value)):
            if not (own := [r for r, fold in zip(rows, pdf["fold"]) if fold != model]):
                continue
            change, new = descend(own, weights, ratio, duals, cost, blocks, epochs)
            at = np.flatnonzero(change)
            found.append(pd.DataFrame({"model": model, "kind": np.r_[np.zeros(len(at), np.int32), np.ones(len(new), np.int32)],
                                       "at": np.r_[at, np.fromiter(new, np.int64, len(new))],
                                       "value": np.r_[change[at], np.fromiter(new.values(), float, len(new))]}))
        return pd.concat(found)
    return run


def dealt(x: DataFrame) -> DataFrame:
    """``x`` with the block of each row, kept by block, so that groups by block need no shuffle."""
    return x.withColumn("block", F.pmod(F.col("row"), F.lit(BLOCKS))).repartition(PARTITIONS, "block").persist()


def _margins(shared):
    def run(batches):
        weights, ratio = shared.value
        for batch in batches:
            m = [margin(g.values.to_numpy(), weights[k], ratio[k]) for k, g in zip(batch.column("fold").to_pylist(), batch.column("grams"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(m, pa.float64())], names=["y", "margin"])
    return run


def margin(grams: np.ndarray, weights: np.ndarray, ratio: np.ndarray) -> float:
    return float(weights[grams] @ scaled(grams, ratio) + weights[-1])


def platt(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b), by Newton's method on smoothed targets."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.c_[margins, np.ones_like(margins)]
    ab = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    loss = lambda v: float((weight * (np.logaddexp(0, z @ v) - goal * (z @ v))).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ ab, -500, 500)))
        slope = z.T @ (weight * (p - goal))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(ab - size * step) > loss(ab):
            size /= 2
        ab = ab - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return float(ab[0]), float(ab[1])


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL):
    """(weights, ratio, a, b), or a plain share of label 1 if there are not rows of both labels."""
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
             .filter(~held_out(labels)).distinct())
    sizes = {r.y: r.n for r in docs.select("doc_id").join(known, "doc_id").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        n1, n = sizes.get(1, 0), sum(sizes.values())
        return (n1 + 1) / (n + 2)
    share = {y: min(1.0, per_label / n) for y, n in sizes.items()}
    one = float(1 << 30)
    at = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / one
    same = F.xxhash64("text").alias("same")
    d = docs.select("doc_id", same, at(1).alias("at"), F.floor(at(2) * FOLDS).cast("int").alias("fold")).filter(F.col("at") < max(share.values()))
    picked = (d.join(known, "doc_id").filter(F.col("at") < F.when(F.col("y") == 0, share[0]).otherwise(share[1]))
              .select("doc_id", "same", "y", "fold").distinct())
    # ids and hashes of about per_label rows a label go to the texts, so that no text is shuffled
    rows = (docs.select("doc_id", "text", same).join(F.broadcast(picked), ["doc_id", "same"])
            .select(F.xxhash64("doc_id", "y", "same").alias("row"), "y", "fold", "text"))
    x = materialize(rows.mapInArrow(_features, "row long, y int, fold int, grams array<int>")
                    .groupBy("row").agg(*[F.first(c).alias(c) for c in ("y", "fold", "grams")]), "quality_rows")
    # model k leaves part k out, the last one none; a row for each part and gram at most comes back
    sums = x.mapInArrow(_count, "fold int, gram long, n0 long, n1 long").groupBy("fold", "gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts = np.zeros((FOLDS + 1, 2, GRAMS))
    counts[sums["fold"], 0, sums["gram"]], counts[sums["fold"], 1, sums["gram"]] = sums["n0"], sums["n1"]
    counts[:FOLDS], counts[FOLDS] = counts[:FOLDS].sum(axis=0) - counts[:FOLDS], counts[:FOLDS].sum(axis=0)
    ratio = [log_ratio(*c) for c in counts]
    # the bounds of the dual variables give both labels the same say
    n = np.zeros((FOLDS + 1, 2))
    for r in x.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect():
        n[[k for k in range(FOLDS + 1) if k != r.fold], r.y] += r.n
    cost = [{y: COST * own.sum() / (2 * max(1, own[y])) for y in (0, 1)} for own in n]
    weights, duals = [np.zeros(GRAMS + 1) for _ in n], [{} for _ in n]
    sc = docs.sparkSession.sparkContext
    blocks = dealt(x)
    for _ in range(ROUNDS):
        shared = sc.broadcast((weights, ratio, duals, cost))
        out = (blocks.groupBy("block").applyInPandas(_round(shared, BLOCKS, EPOCHS), "model int, kind int, at long, value double")
               .groupBy("model", "kind", "at").agg(F.sum("value").alias("value")).toPandas())
        for (model, kind), own in out.groupby(["model", "kind"]):
            if kind == 0:
                weights[model][own["at"].to_numpy()] += own["value"].to_numpy()
            else:
                duals[model] = dict(zip(own["at"].to_numpy().tolist(), own["value"].to_numpy().tolist()))
        shared.destroy()
    blocks.unpersist()
    shared = sc.broadcast((weights, ratio))
    seen = x.mapInArrow(_margins(shared), "y int, margin double").toPandas()  # two numbers for each row of the sample
    shared.destroy()
    discard(x)
    y = seen["y"].to_numpy(dtype=float)
    own = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weight = np.where(y == 1, sizes[1] / own[1], sizes[0] / own[0]) * (len(y) / sum(sizes.values()))
    return (weights[FOLDS], ratio[FOLDS], *platt(seen["margin"].to_numpy(), y, weight))


def scored(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document (doc_id, text)."""
    model = learn(docs, labels, per_label)
    d = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    schema = T.StructType([d.schema["doc_id"], d.schema["held_out"], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    if isinstance(model, float):
        return d.select("doc_id", "held_out", F.lit(model).alias("score"), F.lit(int(model >= threshold)).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, ratio, a, b = shared.value
        for batch in batches:
            m = np.array([margin(grams_of(raw), weights, ratio) for raw in texts_of(batch.column("text"))])
            score = 1 / (1 + np.exp(-np.clip(a * m + b, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return d.mapInArrow(run, schema)
