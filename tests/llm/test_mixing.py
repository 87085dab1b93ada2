from collections import defaultdict

from hourwise.llm import mixing
from hourwise.llm.common import numbered

from .helpers import documents, prose, rng


def mixed(spark, rows, **options):
    return mixing.mix(numbered(documents(spark, rows), "test_mix"), **options).collect()


def targets(sizes):
    """Water filling, written out."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: fixed.get(s, weight[s] * level) for s in names}
        fixed |= {s: 3 * sizes[s] for s in over}


def corpus():
    r = rng()
    rows, k = [], 0
    for source, n in (("a", 30), ("b", 300), ("c", 5), ("é", 40), (None, 20), ("z", 100)):
        for _ in range(n):
            k += 1
            rows.append((k, prose(r, r.choice([1, 10, 50, 400])), "en", source))
    return rows + [(900, None, "en", "a"), (901, "", "en", "b"), (902, " \t\n", "en", "only empty"), (1, rows[0][1], "en", "a")]


def test_targets_taken_and_limits(spark):
    rows = corpus()
    got = mixed(spark, rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    by_id = {r[0]: r[3] for r in rows}
    for x in got:
        s = by_id[x.doc_id]
        size[s] += x.size
        taken[s] += x.taken
        target[s] = x.target
        assert x.taken <= 3 * x.size
    expected = targets(size)
    assert all(abs(target[s] - expected[s]) < 1e-6 and abs(taken[s] - expected[s]) <= 1 for s in expected)
    assert all(x.source_size == size[by_id[x.doc_id]] for x in got)
    assert len(got) == len(rows) and sorted(map(tuple, [x[1:] for x in mixed(spark, rows)])) == sorted(map(tuple, [x[1:] for x in got]))


def test_block_size_does_not_change_what_is_taken(spark):
    key = lambda rows: sorted((x.doc_id, x.size, x.taken) for x in rows)
    assert key(mixed(spark, corpus(), block_tokens=7)) == key(mixed(spark, corpus(), block_tokens=4096))


def test_schedule_is_low_discrepancy(spark):
    docs = numbered(documents(spark, corpus()), "test_mix")
    sources = mixing.targets(mixing.sized(docs), block_tokens=16)
    want = {r.sid: r.slots for r in sources.collect()}
    slots = mixing.schedule(sources).orderBy("slot").collect()
    ranks = defaultdict(list)
    for x in slots:
        ranks[x.sid].append(x.rank)
    assert {s: len(v) for s, v in ranks.items()} == {s: n for s, n in want.items() if n}
    assert all(v == list(range(len(v))) for v in ranks.values())
    total = len(slots)
    for s, n in want.items():  # in every prefix, a source is close to its share
        seen = 0
        for i, x in enumerate(slots, 1):
            seen += x.sid == s
            assert abs(seen - i * n / total) < 12


def test_stage_keeps_columns_and_empty(spark):
    rows = corpus()
    out = mixing.mixed(documents(spark, rows).withColumnRenamed("n_chars", "sid"))
    assert out.columns == ["doc_id", "text", "lang", "source", "sid", "size", "source_size", "target", "taken"]
    assert out.filter("taken = 0").count() == 0
    assert mixed(spark, []) == [] and [tuple(x)[2:] for x in mixed(spark, [(1, None)])] == [(0, 0, 0.0, 0)]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(numbered(documents(spark, corpus()), "test_mix"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_one_id_in_a_third_of_all_rows_is_split(spark, monkeypatch):
    """Rows without an id, or of one id, are dealt over partitions; the result follows the written-out order."""
    from hourwise.llm import mixing as mx
    r = rng(9)
    rows = [(None if i % 3 else 7 if i % 2 else i, prose(r, r.randrange(1, 9)), "en", "s") for i in range(3000)]
    docs = numbered(documents(spark, rows).select("doc_id", "source", "text"), "t")
    sizes = mx.sized(docs)
    got = mx.placed(sizes, mx.targets(sizes)).collect()
    order = sorted(sizes.collect(), key=lambda x: (x.order, x["size"], x[mx.ROW]))
    start, want = 0, {}
    for x in order:
        want[x[mx.ROW]] = start
        start += x["size"]
    assert {x[mx.ROW]: x.start for x in got} == want
