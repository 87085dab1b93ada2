import hashlib
import re

from hourwise.llm import secret_scan as ss

from .helpers import documents, prose, rng

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    """The contract, written out."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


LIVE, SHARED = "Zq8rT1vLx0PwK3mYb7NcD5e", "Ab3dEf6hIj9lMn2pQr5tUv8"
HEX = "0123456789abcdef0123456789abcdef"


def test_spans_and_ownership(spark):
    r = rng()
    texts = [
        (0, prose(r, 20), "o1"), (1, None, "o1"), (2, "", None), (3, f'é password = "{HEX}" x', "o1"),
        (4, "Token:abcde secret=abcdef API_KEY : 'a/b+c=d' apikey=x", "o2"), (5, "AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 9, "o2"),
        (6, f"key {LIVE} here", "o3"), (7, f"also {LIVE}", "o3"), (8, f"é {SHARED}", "o1"), (9, SHARED, "o2"), (10, SHARED, "o3"),
        (11, "password: token: abcdefgh", "o1"), (12, "pa\u017f\u017fword=abcdefg to\u212aen=abcdefg", "o1"), (13, HEX.upper(), "o1"),
        (3, f'é password = "{HEX}" x', "o1")]
    docs = documents(spark, [(i, t, "en", o) for i, t, o in texts]).withColumnRenamed("lang", "owner").withColumnRenamed("n_chars", "found")
    got = [(x.doc_id, x) for x in ss.scanned(docs).collect()]
    assert len(got) == len(texts)
    by = {i: t for i, t, _ in texts}
    for i, x in got:
        spans = base(by[i])
        assert x.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in x.spans.split(",") if s and not s.startswith("token")] == spans
        assert (x.n_assign, x.n_access, x.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))
    x = dict(got)
    assert x[6].spans == "token:4:27" and x[7].spans == "token:5:28" and x[6].n_live == 1
    assert x[8].spans == x[9].spans == "" and x[8].n_shared == 1 and x[8].n_live == 0
    assert x[3].spans == "assign:2:46,hex:14:46" and x[0].spans == ""
    assert x[4].spans.count("assign") == 2 and x[11].spans == "" and x[12].spans == ""


def test_long_texts_and_empty(spark):
    text = " ".join(f"secret={i:06d}" for i in range(60_000))
    x = ss.scanned(documents(spark, [(1, text)])).first()
    assert x.n_assign == 60_000 and x.spans == ",".join(base(text))
    assert ss.scanned(documents(spark, [])).collect() == []


def test_copied_texts_and_repositories_are_told_apart(spark):
    """A live token whose document has been copied to many sources is no example; counts are of distinct owners, repositories and texts."""
    rows = [(i, f"the key {LIVE} of it", "en", f"o{i}") for i in range(4)]
    rows += [(10 + i, f"see {SHARED} {'again ' * i}", "en", f"o{i}") for i in range(3)]
    rows += [(20, f"mine {LIVE}x", "en", None), (21, f"mine {LIVE}x", "en", None)]
    got = {x.doc_id: x for x in ss.scanned(documents(spark, rows + rows)).collect()}
    assert got[0].n_live == 1 and got[0].spans == "token:8:31" and got[0].frequency == "token:8:31:4:4:1"
    assert got[10].n_shared == 1 and got[10].spans == "" and got[10].frequency == "token:4:27:3:3:3"
    assert got[20].frequency.endswith(":1:2:1") and got[20].n_live == 1
    values = ss.ownership(ss.candidates(documents(spark, rows), *map(__import__("pyspark").sql.functions.col, ("source", "doc_id"))))
    assert sorted((x.owners, x.repositories, x.texts) for x in values.collect()) == [(1, 2, 1), (3, 3, 3), (4, 4, 1)]
