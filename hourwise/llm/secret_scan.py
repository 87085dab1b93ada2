"""Secret scans with corpus-wide ownership frequency.

Base detectors find assignments, access keys and hex strings in each text; a further detector finds long
tokens of high entropy. Every candidate value is hashed, and Spark counts the distinct owners, repositories and texts
that hold it. A value of ``shared_owners`` owners or more that also stands in ``shared_texts`` different texts or more is a
widely copied example; any other is specific to its owner and looks live, also if one text with it has been copied to many
owners and repositories. Base spans always stay; a token is a span only if it looks live. Values
never leave the tasks, only their 128-bit hashes do.

The counts are distinct aggregates, which are first reduced by (value, owner), (value, repository) and (value, text), so that an
example in a third of all rows is summed up before it meets in one task.

Defined cases: null and empty texts have no spans; a null owner is an owner of its own, and so is a null repository; spans are in code
points, end exclusive, by start and then kind; rows that repeat are scanned on their own but count as one
repository; a token that overlaps a base span is none; an empty table gives no rows; texts are scanned whole, however long; only
doc_id, text and the columns of owner and repository are read, other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.llm.common import ROW, fresh_join, travels
from hourwise.llm.text import texts_of
from hourwise.session import materialize

travels(__name__)

KINDS = ("assign", "access", "hex", "token")
#: Owners, and different texts, from which a value counts as a copied example.
SHARED_OWNERS, SHARED_TEXTS = 3, 2
#: Least length, and bits a character, of a token.
TOKEN_CHARS, TOKEN_BITS = 20, 3.5

# Fixed patterns
_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                     r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % TOKEN_CHARS)
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
_HEX_RUN = b"x" * 24
_HEX_MAP = bytes(0x78 if c in b"0123456789abcdef" else 0x20 for c in range(256))
_RUN_MAP = bytes(0x78 if chr(c).isascii() and (chr(c).isalnum() or chr(c) in "+/_=-") else 0x20 for c in range(256))
_RUN = b"x" * TOKEN_CHARS


def entropy(value: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def _is_token(value: str) -> bool:
    return (any("0" <= c <= "9" for c in value) and any("a" <= c <= "z" for c in value)
            and any("A" <= c <= "Z" for c in value) and entropy(value) >= TOKEN_BITS)


def find(raw: bytes | None) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of all candidates of a text, in order."""
    if not raw:
        return []
    low = raw.lower()
    is_assign = any(w in low for w in _WORDS)
    is_access = b"AKIA" in raw
    is_hex = _HEX_RUN in raw.translate(_HEX_MAP)
    is_token = _RUN in raw.translate(_RUN_MAP)
    if not (is_assign or is_access or is_hex or is_token):
        return []
    text = raw.decode("utf-8", "replace")
    found = []
    if is_assign:
        found += [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if is_access:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if is_hex:
        found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    if is_token:
        taken = sorted((a, b) for a, _, b, _ in found)
        k = 0
        for m in _TOKEN.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if not any(a < m.end() and b > m.start() for a, b in taken[max(0, k - 2):k + 3]) and _is_token(m[0]):
                found.append((m.start(), 3, m.end(), m[0]))
    return sorted(found)


def _scan(batches):
    for batch in batches:
        out = {c: [] for c in ("start", "kind", "end", "h1", "h2")}
        for raw in texts_of(batch.column("text")):
            found = find(raw)
            hashes = [hashlib.blake2b(v.encode(), digest_size=16).digest() for *_, v in found]
            for c, values in zip(out, ([x[0] for x in found], [x[1] for x in found], [x[2] for x in found],
                                       [int.from_bytes(h[:8], "big", signed=True) for h in hashes],
                                       [int.from_bytes(h[8:], "big", signed=True) for h in hashes])):
                out[c].append(values)
        arrays = [pa.array(v, pa.list_(pa.int64())) for v in out.values()]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "owner", "repository", "same")] + arrays,
                                         names=["doc_id", "owner", "repository", "same", *out])


def candidates(docs: DataFrame, owner, repository) -> DataFrame:
    """(row, doc_id, owner, repository, same, found) of every document, written once; same: a hash of the text; found: array of
    (start, kind, end, h1, h2)."""
    d = docs.select("doc_id", owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
                    F.xxhash64("text").alias("same"), "text")
    longs = ", ".join(f"{c} array<long>" for c in ("start", "kind", "end", "h1", "h2"))
    x = d.mapInArrow(_scan, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, owner string, repository string, same long, {longs}")
    return materialize(x.select(F.monotonically_increasing_id().alias(ROW), "doc_id", "owner", "repository", "same",
                                F.arrays_zip("start", "kind", "end", "h1", "h2").alias("found")), "secret_candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(h1, h2, owners, repositories, texts) of every candidate value."""
    x = found.select("owner", "repository", "same", F.explode("found").alias("f"))
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    return x.groupBy("f.h1", "f.h2").agg(
        F.count_distinct(named("owner")).alias("owners"), F.count_distinct(named("repository")).alias("repositories"),
        F.count_distinct("same").alias("texts"))


def scanned(docs: DataFrame, owner="source", repository="doc_id", shared_owners: int = SHARED_OWNERS,
            shared_texts: int = SHARED_TEXTS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_shared, frequency) of every document; frequency:
    kind:start:end:owners:repositories:texts of all candidates, joined like spans."""
    all_ = candidates(docs, F.col(owner), F.col(repository))
    values = ownership(all_).withColumn("shared", (F.col("owners") >= shared_owners) & (F.col("texts") >= shared_texts))
    one = all_.select(ROW, F.explode("found").alias("f")).select(ROW, "f.start", "f.kind", "f.end", "f.h1", "f.h2")
    judged = fresh_join(one, values, ["h1", "h2"]).groupBy(ROW).agg(
        F.count_if(~F.col("shared")).alias("n_live"), F.count_if("shared").alias("n_shared"),
        F.collect_list(F.when(~F.col("shared") & (F.col("kind") == 3), F.struct("start", "kind", "end"))).alias("tokens"),
        F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", "texts")).alias("counts"))
    base = F.filter(F.transform("found", lambda f: F.struct(f["start"].alias("start"), f["kind"].alias("kind"), f["end"].alias("end"))),
                    lambda f: f["kind"] < 3)
    names = F.array(*map(F.lit, KINDS))
    listed = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda f: F.concat_ws(
        ":", F.element_at(names, (f["kind"] + 1).cast("int")), f["start"], f["end"])), ",")
    kind_of = lambda f: F.element_at(names, (f["kind"] + 1).cast("int"))
    counted = F.array_join(F.transform(F.array_sort("counts"), lambda f: F.concat_ws(
        ":", kind_of(f), f["start"], f["end"], f["owners"], f["repositories"], f["texts"])), ",")
    x = all_.withColumn("base", base).drop("found").join(judged, ROW, "left")
    count = lambda k: F.size(F.filter("base", lambda f: f["kind"] == k)).cast("long")
    both = F.concat("base", F.coalesce("tokens", F.array().cast(x.schema["base"].dataType)))
    return x.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(both).alias("spans"),
                    F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_shared", F.lit(0)).alias("n_shared"),
                    F.coalesce(counted, F.lit("")).alias("frequency"))
