"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. The automaton of all items is
built over words; every document is streamed through it once, and the length of the longest item substring
that ends at each word is tracked. A match of ``window`` words or more is an occurrence of an item's
window, so its words are hit; an item of fewer words is one window and is found through the suffix links.
A document is contaminated if at least one word and one in ``share`` of its words are hit. ``kept`` drops such
documents, or with ``cut`` removes the hit spans from every document.

The automaton goes to the executors as a broadcast of at most ``shard_bytes`` of item text. A larger
benchmark is dealt into shards of that size; each has a pass of its own over the documents and the spans
of a document are joined up afterwards, so the result is the same.

Defined cases: null and empty texts have no words and are clean; empty items have no window; repeated items
count once by item_id; an item without id marks words but is not counted; an empty benchmark leaves
everything clean. Very long texts are read in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.llm.common import ROW, numbered, travels
from hourwise.llm.text import FOLD, texts_of, words_in
from hourwise.session import materialize

travels(__name__)

WINDOW = 13
#: A document is contaminated if n_hit * SHARE >= n_words.
SHARE = 20
SHARD_BYTES = 1 << 20


class Automaton:
    """Generalised suffix automaton of word sequences, for windows of ``window`` words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        by_length = sorted(range(len(self.length)), key=self.length.__getitem__)
        # the state that stands for the last `window` words of a match
        self.gram = [0] * len(self.length)
        for v in by_length:
            if self.length[v] >= window:
                self.gram[v] = v if self.length[self.link[v]] < window else self.gram[self.link[v]]
        self.items: dict[int, set] = {}
        whole: dict[int, list] = {}
        for item, words in items:
            v = 0
            for i, w in enumerate(words):
                v = self.next[v][w]
                if i + 1 >= window:
                    self.items.setdefault(self.gram[v], set()).add(item)
            if 0 < len(words) < window:
                whole.setdefault(v, []).append((len(words), item))
        # short items that end where a state's strings end
        self.short: dict[int, list] = {}
        for v in by_length:
            if found := (self.short.get(self.link[v], []) if v else []) + whole.get(v, []):
                self.short[v] = found

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(w)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        new = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of state q for its strings of up to length[p] + 1 words."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(length)
        length.append(length[p] + 1)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Words of a text, its hit spans [first, last] in words, the items whose windows occur."""
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        root, spans, grams, found, n, state, matched = nxt[0], [], set(), set(), 0, 0, 0
        for words in words_in(raw):
            for i, w in enumerate(words, n):
                if state:
                    to = nxt[state].get(w)
                    while to is None and state:
                        state = link[state]
                        matched = length[state]
                        to = nxt[state].get(w)
                else:
                    to = root.get(w)
                if to is None:
                    state = matched = 0
                    continue
                state, matched = to, matched + 1
                if matched >= window:
                    grams.add(self.gram[state])
                    _cover(spans, i - matched + 1, i)
                if state in short:
                    for size, item in short[state]:
                        if size <= matched:
                            found.add(item)
                            _cover(spans, i - size + 1, i)
            n += len(words)
        for g in grams:
            found |= self.items[g]
        return n, spans, found - {None}


def _cover(spans: list, first: int, last: int) -> None:
    while spans and spans[-1][1] >= first - 1:
        a, b = spans.pop()
        first, last = min(a, first), max(b, last)
    spans.append((first, last))


def merged(spans) -> list[tuple[int, int]]:
    out: list = []
    for a, b in sorted(spans):
        _cover(out, a, b)
    return out


def is_contaminated(n_hit: int, n_words: int, share: int = SHARE) -> bool:
    return n_hit > 0 and n_hit * share >= n_words


def without(raw: bytes, spans) -> bytes:
    """The text without the words of the spans and what stands between them."""
    out, at, todo = [], 0, iter(spans)
    span = next(todo, None)
    for i, m in enumerate(re.finditer(rb"[^ ]+", raw.translate(FOLD))):
        if span and i == span[0]:
            out.append(raw[at:m.start()])
        if span and i == span[1]:
            at, span = m.end(), next(todo, None)
    return b"".join([*out, raw[at:]])


def _shards(benchmark: DataFrame, window: int, shard_bytes: int):
    """Automata of at most about ``shard_bytes`` of item text each, one at a time."""
    b = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    for k in range(n):
        part = b if n == 1 else b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        # bounded: about shard_bytes of text
        items = [(r.item_id, [w for ws in words_in(r.text.encode()) for w in ws]) for r in part.toLocalIterator()]
        yield Automaton(items, window), n


def _shared(spark, automaton: Automaton):
    return spark.sparkContext.broadcast(vars(automaton))  # plain lists and dicts: no class by reference


def _received(shared) -> Automaton:
    automaton = Automaton.__new__(Automaton)
    vars(automaton).update(shared.value)
    return automaton


def _scanner(shared, columns):
    """mapInArrow function: the given columns, n_words, spans and items of every row."""
    def run(batches):
        automaton = _received(shared)
        for batch in batches:
            n, first, last, items = [], [], [], []
            for raw in texts_of(batch.column("text")):
                words, spans, found = automaton.scan(raw or b"")
                n.append(words)
                first.append([a for a, _ in spans])
                last.append([b for _, b in spans])
                items.append(sorted(found))
            more = [pa.array(n, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(last, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *more],
                                             names=[*columns, "n_words", "first", "last", "items"])
    return run


def hits(docs: DataFrame, benchmark: DataFrame, id_column: str, window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, n_words, first, last, items): hit spans and items of every row of ``docs`` (id, text)."""
    d = docs.select(id_column, "text")
    schema = T.StructType([d.schema[id_column], T.StructField("n_words", T.LongType()),
                           *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("first", "last")),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    parts, columns, id_schema = None, [id_column], schema
    for automaton, n in _shards(benchmark, window, shard_bytes):
        shared = _shared(docs.sparkSession, automaton)
        if n == 1:
            return d.mapInArrow(_scanner(shared, columns), schema)
        if parts is None and id_column != ROW:
            d, columns = numbered(d, "decontaminate_docs"), [ROW, id_column]
            schema = T.StructType([T.StructField(ROW, T.LongType()), *schema.fields])
        part = materialize(d.mapInArrow(_scanner(shared, columns), schema), "decontaminate_part")
        parts = part if parts is None else parts.unionByName(part)
    joined = parts.groupBy(ROW).agg(*(F.first(c).alias(c) for c in columns if c != ROW), F.first("n_words").alias("n_words"), *(
        F.flatten(F.collect_list(c)).alias(c) for c in ("first", "last", "items"))).select(*id_schema.names)

    def join_up(batches):
        for batch in batches:
            rows = batch.to_pydict()
            spans = [merged(zip(a, b)) for a, b in zip(rows["first"], rows["last"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("n_words"),
                 pa.array([[a for a, _ in x] for x in spans], pa.list_(pa.int64())),
                 pa.array([[b for _, b in x] for x in spans], pa.list_(pa.int64())),
                 pa.array([sorted(set(x)) for x in rows["items"]], pa.list_(pa.string()))],
                names=[id_column, "n_words", "first", "last", "items"])
    return joined.mapInArrow(join_up, id_schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    x = hits(docs, benchmark, "doc_id", window, shard_bytes)
    n_hit = F.aggregate(F.zip_with("first", "last", lambda a, b: b - a + 1), F.lit(0).cast("long"), lambda s, v: s + v)
    x = x.withColumn("n_hit", n_hit)
    return x.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"))


def kept(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
         shard_bytes: int = SHARD_BYTES, cut: bool = False) -> DataFrame:
    """The documents that are not contaminated, with their own columns. ``cut``: hit spans are removed from
    the text instead, and every document stays."""
    shards = _shards(benchmark, window, shard_bytes)
    automaton, n = next(shards)
    if n > 1:
        d = numbered(docs, "decontaminate_docs")
        found = hits(d, benchmark, ROW, window, shard_bytes)
        found = found.select(ROW, *(F.col(c).alias(f"__hw_{c}") for c in ("n_words", "first", "last")))
        return _apply(d.join(found, ROW).drop(ROW), docs.schema, share, cut, None)
    return _apply(docs, docs.schema, share, cut, _shared(docs.sparkSession, automaton))


def _apply(docs: DataFrame, schema, share: int, cut: bool, shared) -> DataFrame:
    names = schema.names

    def run(batches):
        automaton = shared and _received(shared)
        for batch in batches:
            texts, keep = texts_of(batch.column("text")), []
            for k, raw in enumerate(texts):
                if automaton is None:
                    n, first, last = (batch.column(f"__hw_{c}")[k].as_py() for c in ("n_words", "first", "last"))
                    spans = list(zip(first, last))
                else:
                    n, spans, _ = automaton.scan(raw or b"")
                keep.append(cut or not is_contaminated(sum(b - a + 1 for a, b in spans), n, share))
                if cut and spans:
                    texts[k] = without(raw, spans)
            out = [pa.array(texts, pa.large_binary()).cast(batch.column(c).type) if cut and c == "text" else batch.column(c)
                   for c in names]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, schema)


def sha256_of(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
