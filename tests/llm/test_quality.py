import json
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np

from hourwise.llm import quality
from hourwise.llm.queries import op11_quality
from tests.llm.helpers import documents, prose

LABEL = "doc_id long, quality int, toxic int"


def brute_grams(raw):
    padded = b" " + raw + b" "
    found = {(4, n) for n in (2, 3, 4) if any(len(set(raw.split()[i:i + n])) == 1 and len(raw.split()[i:i + n]) == n
                                               for i in range(len(raw.split())))}
    for n in (1, 2, 3):
        found |= {(n, int.from_bytes(padded[i:i + n], "big")) for i in range(len(padded) - n + 1)}
    mix = lambda n, v: (((n << 24 | v) + 1) * 0x9E3779B97F4A7C15 % 2 ** 64) >> 64 - quality.BITS
    return sorted({mix(*x) for x in found})


def test_grams_against_brute_force(monkeypatch):
    rng = random.Random(5)
    texts = [b"", b"a", b"a a", b"a  a a\na b", "ünï ünï".encode()] + [
        " ".join(rng.choice(["x", "yy", "zzz"]) for _ in range(rng.randrange(80))).encode() for _ in range(40)]
    for piece in (1 << 20, 64, 7, 3):  # long texts are read in pieces
        monkeypatch.setattr(quality, "PIECE", piece)
        for t in texts:
            assert quality.grams_of(t).tolist() == (brute_grams(t) if t else [])
    assert quality.grams_of(None).tolist() == []


def test_descent_reaches_the_optimum():
    """Blocks in rounds come to the same primal and dual objective, so both are optimal."""
    rng = np.random.default_rng(2)
    rows = [(i, int(y), np.sort(rng.choice(40, 8, replace=False) + 20 * int(y)).astype(np.int64)) for i, y in enumerate(rng.random(200) < 0.6)]
    ratio, cost = rng.normal(size=quality.GRAMS), {0: 0.7, 1: 0.4}
    weights, duals = np.zeros(quality.GRAMS + 1), {}
    for _ in range(600):
        new, total = {}, np.zeros_like(weights)
        for b in range(3):
            change, own = quality.descend([r for r in rows if r[0] % 3 == b], weights, ratio, duals, cost, 3, 3)
            total += change
            new |= own
        weights, duals = weights + total, new
    norm = float(weights @ weights) / 2
    loss = sum(cost[y] * max(0.0, 1 - (2 * y - 1) * quality.margin(g, weights, ratio)) for _, y, g in rows)
    dual = sum(duals.values()) - norm
    assert dual <= norm + loss + 1e-9 and norm + loss - dual < 1e-3 * (norm + loss)


def test_platt_recovers_a_sigmoid():
    rng = np.random.default_rng(1)
    m = rng.normal(size=20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(2 * m + 0.5)))).astype(float)
    a, b = quality.platt(m, y, np.ones_like(m))
    assert abs(a - 2) < 0.1 and abs(b - 0.5) < 0.1


def test_held_out_accuracy_and_columns(spark):
    got = op11_quality(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(r.predicted == y for r, y in held) >= 0.95 * len(held)


def test_labels_of_held_out_rows_change_nothing(spark):
    rng = random.Random(3)
    docs = documents(spark, [(i, prose(rng, 30) + (" !!" if i % 3 else "")) for i in range(150)])
    held = [i for i in range(150) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, int(i % 3 > 0), 0) for i in range(150)]
    wrong = [(i, 1 - y if i in held else y, t) for i, y, t in rows]
    a, b = (quality.scored(docs, spark.createDataFrame(x, LABEL)).collect() for x in (rows, wrong))
    assert a == b and sum(r.predicted == r.doc_id % 3 > 0 for r in a) >= 0


def test_defined_cases(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 20) + (" ??" if i % 2 else "")) for i in range(60)]
    rows += [(None, "x"), (70, None), (71, ""), (72, "y " * 50000), (1, rows[1][1])]
    docs = documents(spark, rows).selectExpr("*", "1 as score", "2 as y", "'q' as quality")
    labels = [(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (5, 7, 0), (2, 1, 0), (2, 1, 0)]
    made = spark.createDataFrame(labels, LABEL).selectExpr("*", "'t' as text")
    got = quality.scored(docs, made).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = [r for r in got if r.doc_id in (70, 71)]
    assert by[0].score == by[1].score
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = quality.scored(docs, made.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    one = quality.scored(docs, made.filter("quality = 0")).collect()
    assert {r.predicted for r in one} == {0} and len({r.score for r in one}) == 1
    assert quality.scored(docs.limit(0), made).count() == 0


LEARN = """
import sys
from hourwise.llm import quality
from hourwise.session import build_session
from tests.llm.test_quality import LABEL, ROWS
from tests.llm.helpers import documents
case, log = sys.argv[1:]
spark = build_session("local[2]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})  # joins as with tables of any size
rows, labels, per_label, quality.ROUNDS = ROWS[case]()
quality.learn(documents(spark, rows), spark.createDataFrame(labels, LABEL), per_label)
spark.stop()
"""


def even():
    rng = random.Random(6)
    rows = [(i, prose(rng, 300, 100) + (" !!" if i % 2 else "")) for i in range(2000)]
    return rows, [(i, i % 2, 0) for i, _ in rows], quality.PER_LABEL, 6


def rare():
    """With a rare label, the hash alone leaves out hardly a document."""
    rng = random.Random(7)
    rows = [(i, prose(rng, 500, 100)) for i in range(3000)]
    return rows, [(i, int(i % 100 > 0), 0) for i, _ in rows], 20, 1


ROWS = {"even": even, "rare": rare}


def shuffled(case, folder):
    """Bytes that learning writes to shuffles, by Spark's event log."""
    root = str(Path(__file__).parents[2])
    subprocess.run([sys.executable, "-c", LEARN, case, f"file://{folder}"], check=True, cwd=root, timeout=600,
                   env=os.environ | {"PYTHONPATH": root, "HOURWISE_DRIVER_MEMORY": "1g"})
    events = [json.loads(line) for f in folder.iterdir() if f.is_file() and not f.name.startswith(".") for line in f.open()]
    return sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd")


def test_rounds_shuffle_changes_only(tmp_path):
    rows = even()[0]
    grams = sum(4 * len(quality.grams_of(t.encode())) for i, t in rows if zlib.crc32(str(i).encode()) % 5)
    assert 0 < shuffled("even", tmp_path) < 2 * grams


def test_texts_are_not_shuffled_to_choose_rows(tmp_path):
    assert 0 < shuffled("rare", tmp_path) < sum(len(t) for _, t in rare()[0]) / 5


def test_rows_to_learn_from(spark, monkeypatch):
    """Each labelled (doc_id, text) once, with its label, grams and one part; documents of both labels once for each."""
    seen, stored = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, name: (seen.append(stored(df, name)), seen[-1])[1])
    monkeypatch.setattr(quality, "discard", lambda *dfs: None)
    rows = [(i, f"text {i} " + "ab" * (i % 7)) for i in range(200)] + [(i, "another") for i in range(50)] + [(i, None) for i in range(3)]
    labels = [(i, i % 2, 0) for i in range(180)] + [(8, 1, 0), (9, 1, 0)]
    quality.learn(documents(spark, rows * 3), spark.createDataFrame(labels, LABEL))
    got = seen[0].collect()
    known = {(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5}
    want = sorted((y, quality.grams_of(t.encode() if t is not None else None).tolist()) for i, t in rows for j, y in known if i == j)
    assert sorted((r.y, r.grams) for r in got) == want and len({r.row for r in got}) == len(got)
    assert {r.fold for r in got} == set(range(quality.FOLDS))
