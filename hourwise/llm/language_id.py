"""Language ID by multilingual mixture inference.

Training counts byte trigrams of the folded text (see ``GRAMS``) for each language, over at most
``train_docs`` documents a language, chosen by a hash of doc_id and text; that is the only sample. A word's
likelihood under a language is the product of its trigrams' smoothed frequencies. Each document is a
mixture: expectation-maximisation over all of its words estimates the share of each language. Of the sets of the one, two,
three, ... largest shares, the one with the highest log-likelihood less ``PENALTY`` log(words + 1) for each language is
taken (larger sets are tried until no document gains by two more); its largest share is the prediction, with that share as the score, and all of its
languages are returned with their shares.

Any number of languages can be learned: the model takes GRAMS * 4 bytes (256 KiB) for each, and texts are worked on in chunks
whose size goes down as that number goes up.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and no shares, and so is every text if nothing
could be learned; ties go to the language first by code point; a null doc_id counts as not held out; rows that repeat get a row
each; an empty table gives no rows; only doc_id, text and lang are read, other columns, whatever their names, are not looked at.
Longer documents than a chunk are worked on one at a time, their text in pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.llm.common import fresh_join, travels
from hourwise.llm.text import folded_pieces, texts_of
from hourwise.session import discard, materialize

travels(__name__)

#: Documents that training reads for each language.
TRAIN_DOCS = 5000
GRAMS = 1 << 16
#: Languages up to which their table (some dozen bytes each) is broadcast.
BROADCAST_LANGUAGES = 100_000
SMOOTHING = 0.5
#: Likelihood that any word has besides, relative to its best language: odd words decide nothing.
ODD_WORD = 1e-4
EM_ROUNDS, REFIT_ROUNDS, PENALTY = 8, 3, 2.0
#: Bytes of text of a chunk for up to CHUNK_LANGUAGES languages; fewer for more.
CHUNK, CHUNK_LANGUAGES = 1 << 21, 8
UNKNOWN = "und"

_LETTERS_OUT = bytes(c for c in range(256) if not (0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A))
# class of a folded byte: separator, digit, a-z, and 36 classes of non-ASCII bytes
_CLASS = np.array([0 if c < 0x30 else 1 if c < 0x61 else c - 0x61 + 2 if c < 0x80 else 28 + c % 36
                   for c in range(256)], dtype=np.uint32)


def has_letter(raw: bytes) -> bool:
    if raw.translate(None, _LETTERS_OUT):
        return True
    return not raw.isascii() and any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def word_grams(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Gram numbers of all letters and digits of a folded text, and where each word begins among them."""
    kinds = _CLASS[np.frombuffer(b" " + folded + b" ", dtype=np.uint8)]
    # the high bits of the product depend on all 18 bits of the trigram
    grams = ((kinds[:-2] << 12 | kinds[1:-1] << 6 | kinds[2:]) * np.uint32(2654435769)) >> np.uint32(16)
    inside = kinds[1:-1] != 0
    begins = inside & (kinds[:-2] == 0)
    return grams[inside].astype(np.int64), np.flatnonzero(begins[inside])


def _normal(raw: bytes) -> bytes:
    return b" ".join(b" ".join(p.split()) for p in folded_pieces(raw))


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, raw in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
            have = counts.setdefault(lang, np.zeros(GRAMS, dtype=np.int32))
            for piece in folded_pieces(raw):
                have += np.bincount(word_grams(piece)[0], minlength=GRAMS).astype(np.int32)
    for lang, have in counts.items():
        found = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found, pa.int64()), pa.array(have[found], pa.int64())],
                                         names=["lang", "gram", "n"])


def held_out(docs: DataFrame):
    """True for the documents that training may not read."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and the log-frequency of every gram, from (doc_id, text, lang) not held out."""
    d = docs.select("doc_id", "text", "lang").filter(~held_out(docs) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # a document is read if its hash is under its language's share
    share = materialize(d.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(train_docs)) / F.count(F.lit(1))).alias("share")),
                        "language_shares")
    # a row for each language: texts are not shuffled unless there are very many
    known = d.join(F.broadcast(share), "lang") if share.count() <= BROADCAST_LANGUAGES else fresh_join(d, share, ["lang"])
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    n = (known.filter(at < F.col("share")).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
         .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    found = n.toPandas()  # at most one row for each language and gram
    discard(share)
    langs = sorted(set(found["lang"]))
    table = np.full((GRAMS, len(langs)), SMOOTHING, dtype=np.float32)
    places = {lang: k for k, lang in enumerate(langs)}
    np.add.at(table, (found["gram"].to_numpy(), found["lang"].map(places).to_numpy(dtype=np.int64)), found["n"].to_numpy(dtype=np.float32))
    table /= table.sum(axis=0, dtype=np.float64).astype(np.float32)
    return langs, np.log(table)


def word_likelihoods(folded: bytes, logs: np.ndarray) -> np.ndarray:
    """Likelihood of each word under each language, the best being 1."""
    grams, begins = word_grams(folded)
    ll = np.add.reduceat(logs[grams], begins, axis=0)
    return np.exp(ll - ll.max(axis=1, keepdims=True)) + np.float32(ODD_WORD)


def _em(words, shares, of, begins, n, rounds):
    for _ in range(rounds):
        r = words * shares[of]
        r /= r.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(r, begins, axis=0) / n[:, None]
    return shares


def infer(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Language shares of documents of ``counts`` words each (all over 0), whose words stand one after another."""
    begins, of = np.r_[0, np.cumsum(counts)[:-1]], np.repeat(np.arange(len(counts)), counts)
    n, langs = counts.astype(np.float32), words.shape[1]
    full = _em(words, np.full((len(counts), langs), 1 / langs, np.float32), of, begins, n, EM_ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    best, best_score = None, np.full(len(counts), -np.inf)
    stale = 0
    for size in range(1, langs + 1):
        shares = np.zeros_like(full)
        np.put_along_axis(shares, order[:, :size], np.take_along_axis(full, order[:, :size], axis=1) + 1e-6, axis=1)
        shares /= shares.sum(axis=1, keepdims=True)
        if size > 1:
            shares = _em(words, shares, of, begins, n, REFIT_ROUNDS)
        ll = np.add.reduceat(np.log((words * shares[of]).sum(axis=1)), begins)
        score = ll - PENALTY * size * np.log(n + 1)
        better = score > best_score
        best = shares if best is None else np.where(better[:, None], shares, best)
        best_score = np.where(better, score, best_score)
        stale = 0 if better.any() else stale + 1
        if stale == 2:
            break
    return best


def mixtures(texts: list[bytes | None], langs: list[str], logs: np.ndarray) -> list[np.ndarray | None]:
    """Shares of all languages of each text (0 for those not in its set), or None for a text of no language."""
    out: list[np.ndarray | None] = [None] * len(texts)
    if not langs:
        return out
    chunk = max(1, CHUNK * CHUNK_LANGUAGES // max(CHUNK_LANGUAGES, len(langs)))
    todo: list[int] = []
    words: list[np.ndarray] = []
    pieces: list[bytes] = []
    counts: list[int] = []
    room = chunk

    def close():
        nonlocal todo, words, pieces, counts, room
        if pieces:
            words.append(word_likelihoods(b" ".join(pieces), logs))
        if todo:
            for i, shares in zip(todo, infer(np.concatenate(words), np.array(counts))):
                out[i] = shares
        todo, words, pieces, counts, room = [], [], [], [], chunk

    for i, raw in enumerate(texts):
        if not raw or not has_letter(raw):
            continue
        if len(raw) > chunk:  # a document of its own: likelihoods piece by piece
            close()
            own = [word_likelihoods(p, logs) for piece in folded_pieces(raw) if (p := b" ".join(piece.split()))]
            words, todo, counts = own, [i], [sum(map(len, own))]
            close()
            continue
        p = _normal(raw)
        todo.append(i)
        pieces.append(p)
        counts.append(p.count(b" ") + 1)
        room -= len(p)
        if room < 0:
            close()
    close()
    return out


def predict(texts: list[bytes | None], langs: list[str], logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    found = mixtures(texts, langs, logs)
    return ([UNKNOWN if s is None else langs[int(s.argmax())] for s in found],
            np.array([0.0 if s is None else min(1.0, float(s.max())) for s in found]))


def _model(docs: DataFrame, train_docs: int):
    return docs.sparkSession.sparkContext.broadcast(learn(docs, train_docs))


def languages(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, langs, shares) of every document (doc_id, text, lang): the languages of its mixture and their
    shares, the largest first; empty if there is none."""
    shared = _model(docs, train_docs)

    def run(batches):
        for batch in batches:
            langs, logs = shared.value
            sets, shares = [], []
            for s in mixtures(texts_of(batch.column("text")), langs, logs):
                order = [] if s is None else [k for k in np.argsort(-s, kind="stable") if s[k] > 0]
                sets.append([langs[k] for k in order])
                shares.append([min(1.0, float(s[k])) for k in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(sets, pa.list_(pa.string())),
                 pa.array(shares, pa.list_(pa.float64()))], names=["doc_id", "held_out", "langs", "shares"])
    d = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return d.mapInArrow(run, T.StructType([d.schema["doc_id"], d.schema["held_out"], T.StructField("langs", T.ArrayType(T.StringType())),
                                           T.StructField("shares", T.ArrayType(T.DoubleType()))]))


def main_language() -> list:
    """(lang_pred, score) from a document's languages and shares."""
    return [F.coalesce(F.get("langs", F.lit(0)), F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(F.get("shares", F.lit(0)), F.lit(0.0)).alias("score")]


def identified(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document (doc_id, text, lang)."""
    return languages(docs, train_docs).select("doc_id", "held_out", *main_language())


def kept(docs: DataFrame, languages=None, min_score: float = 0.0, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The documents with an identified language (one of ``languages``, if given) and at least ``min_score``."""
    shared, names = _model(docs, train_docs), docs.columns
    wanted = None if languages is None else set(languages)

    def run(batches):
        for batch in batches:
            langs, scores = predict(texts_of(batch.column("text")), *shared.value)
            keep = [x != UNKNOWN and (wanted is None or x in wanted) and s >= min_score for x, s in zip(langs, scores)]
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
