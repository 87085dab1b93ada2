from hypothesis import HealthCheck, given, settings, strategies as st

from hourwise.llm import line_dedup

from .helpers import documents, prose, rng


def brute(texts, min_words):
    """Deletes every line within a run of at least min_words words that occurs earlier."""
    solid = [[(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip()] for t in texts]
    seen, gone = set(), [set() for _ in texts]
    for d, lines in enumerate(solid):
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b][1].split())
                if words >= min_words:
                    run = tuple(x for _, x in lines[a:b + 1])
                    if run in seen:
                        gone[d] |= set(range(a, b + 1))
                    seen.add(run)
    out = []
    for d, t in enumerate(texts):
        if not gone[d]:
            out.append(t)
            continue
        cut, at = set(), [i for i, _ in solid[d]]
        for k in gone[d]:
            cut.add(at[k])
            if k + 1 in gone[d]:
                cut |= set(range(at[k], at[k + 1]))
        out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut))
    return out


def dedup(spark, texts, min_words):
    docs = documents(spark, list(enumerate(texts)))
    return [r.text for r in line_dedup.without_later_copies(docs, min_words).orderBy("doc_id").collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b b", "c c c", "", " ", "d"]), max_size=9).map("\n".join), max_size=5))
def test_against_brute_force(spark, texts):
    assert dedup(spark, texts, 4) == brute(texts, 4)


def test_passages_and_clean_documents(spark):
    r = rng()
    passage, short = prose(r, 60), "same short line"
    texts = ["\n".join([prose(r, 30), passage, short]), "\n".join([short, prose(r, 30), passage, prose(r, 5)]), prose(r, 200), short, None, "", "\n\n"]
    got = dedup(spark, texts, line_dedup.MIN_WORDS)
    assert got[0] == texts[0] and got[2:] == texts[2:]
    assert passage not in got[1] and got[1] == texts[1].replace(passage + "\n", "")


def test_repeated_rows_ties_and_extra_columns(spark):
    r = rng(3)
    text = "\n".join(prose(r, 20) for _ in range(300))  # a long document: several levels of doubling
    docs = documents(spark, [(5, text), (5, text), (None, text), (9, "\n".join(text.split("\n")[100:200]))])
    docs = docs.withColumnRenamed("n_chars", "seq").withColumnRenamed("source", "line")
    got = line_dedup.without_later_copies(docs)
    assert got.columns[:5] == docs.columns
    rows = [(x.doc_id, x.text, x["__hw_lines"], x["__hw_removed"]) for x in got.collect()]
    assert sorted(rows, key=repr) == sorted([(5, text, 300, 0), (5, "", 300, 300), (None, "", 300, 300), (9, "", 100, 100)], key=repr)


def test_runs_of_one_line_short_lines(spark):
    texts = ["\n".join(["x"] * 120), "\n".join(f"l{i}" for i in range(120)), "\n".join(f"l{i}" for i in range(60, 120))]
    got = dedup(spark, texts, 50)
    assert got == brute(texts, 50) and got[2] == ""


def test_empty_table(spark):
    assert line_dedup.without_later_copies(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = line_dedup.without_later_copies(documents(spark, [(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
