"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-gram buckets per language inside the tasks, sums them by
aggregation, and turns them into a log-probability matrix (buckets x languages)
whose size is fixed by its parameters, so it can be broadcast.  Scoring gathers the
matrix rows of a batch's n-grams and sums them per document in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.llm.common import materialize, pick, slices

ORDERS = (1, 2, 3)
BITS = 16
MAX_MODEL_BYTES = 256 << 20
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_CHUNK = 1 << 19


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    prior: np.ndarray      # log share of the training documents, per language
    logp: np.ndarray       # (2**BITS + 1, languages); the last row is 0, for n-grams that don't count


def one_language(lang: str = "any") -> LanguageModel:
    """A model of one language, which every text with a letter is then of."""
    return LanguageModel([lang], np.zeros(1), np.zeros(((1 << BITS) + 1, 1), np.float32))


def held_out(id_: Column, folds: int = 5) -> Column:
    """The fold that is never learned from; a null id is held out."""
    text = F.coalesce(id_.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def _pieces(texts: list[str]):
    """(document, code points) in pieces of at most a chunk; pieces of one text overlap by the
    longest n-gram less one, so that no n-gram is lost, and starts say which are new."""
    for i, t in enumerate(texts):
        c = np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        for a in range(0, len(c), _CHUNK):
            yield i, c[max(0, a - max(ORDERS) + 1):a + _CHUNK], min(a, max(ORDERS) - 1)


def _chunks(texts: list[str]):
    group, size = [], 0
    for p in _pieces(texts):
        group.append(p)
        size += len(p[1])
        if size >= _CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def _buckets(group):
    """Per order: buckets of all n-grams of a group of pieces, dummy where one crosses pieces."""
    c = np.concatenate([p[1] for p in group])
    lengths = np.array([len(p[1]) for p in group])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    for n in ORDERS:
        h = np.full(len(c), np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF))
        for k in range(n):
            h[:len(c) - k] += c[k:] * _MULT[k]
        h ^= h >> np.uint32(15)
        h *= _MULT[0]
        b = (h >> np.uint32(32 - BITS)).astype(np.int64)
        for k in range(1, n):  # the last n - 1 places of a piece begin no n-gram
            b[np.maximum(ends - k, starts)] = 1 << BITS
        for s, (_, _, seen) in zip(starts, group, strict=True):
            if seen:  # n-grams that the piece before had already
                b[s:s + max(0, seen - n + 1)] = 1 << BITS
        yield b, starts


def train_language_model(docs: DataFrame, text_col: str = "text", label_col: str = "lang",
                         max_train_docs: int = 50_000, alpha: float = 0.5, id_col: str = "doc_id",
                         least: int = 100) -> LanguageModel:
    """Learns from the labelled rows of ``docs``; null texts and labels are passed over.

    Of more than ``max_train_docs`` labelled rows, a sample of about that many is
    drawn by a hash of id and text, so that copies of a text are drawn each on their own.
    Every language keeps about ``least`` rows (or all it has; fewer if languages are
    many), one at any rate; priors are of all labelled rows.
    """
    draw = F.pmod(F.xxhash64("id", "text", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    src = (pick(docs, id=id_col, text=text_col, lang=label_col).where("text is not null and lang is not null")
           .select("text", F.col("lang").cast("string").alias("lang"), draw.alias("draw")))
    most = MAX_MODEL_BYTES >> (BITS + 2)
    rows = src.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("first")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} languages: the model would pass its size bound")
    of_lang = {r["lang"]: r["n"] for r in rows}
    total = sum(of_lang.values())
    if total > max_train_docs:
        least = min(least, max_train_docs // (2 * len(rows)))
        share = (max_train_docs - least * len(rows)) / total
        limits = F.create_map(*[F.lit(x) for r in rows for x in (
            r["lang"], max(share + least / r["n"], r["first"]))])
        src = src.where(F.col("draw") <= limits[F.col("lang")])
    src = src.select("text", "lang")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in slices(batches):
            langs = batch.column(1).to_pylist()
            for lang in langs:
                n_docs[lang] = n_docs.get(lang, 0) + 1
            for group in _chunks(batch.column(0).to_pylist()):
                for b, starts in _buckets(group):
                    for (i, _, _), part in zip(group, np.split(b, starts[1:]), strict=True):
                        s = sums.setdefault(langs[i], np.zeros((1 << BITS) + 1, np.int64))
                        np.add.at(s, part, 1) if len(part) < 512 else s.__iadd__(np.bincount(part, minlength=len(s)))
        for lang, s in sums.items():
            s[-1] = n_docs[lang]
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(s[at])],
                                             names=["lang", "bucket", "n"])

    # written once (a row for each language and bucket at most): two reads follow, the corpus is not scanned again
    rows = materialize(src.mapInArrow(count, "lang string, bucket bigint, n bigint")
                       .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    counts = np.zeros(((1 << BITS) + 1, len(langs)))
    at = {x: i for i, x in enumerate(langs)}
    for lang, bucket, n in rows.toLocalIterator():
        counts[bucket, at[lang]] = n
    n_docs, counts = np.array([of_lang[x] for x in langs], float), counts[:-1] + alpha
    logp = np.vstack([np.log(counts / counts.sum(axis=0)), np.zeros(len(langs))]).astype(np.float32)
    return LanguageModel(langs, np.log(n_docs / n_docs.sum()) if len(langs) else n_docs, logp)


def score_texts(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    with_letters = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model.langs else []
    sums = np.tile(model.prior, (len(with_letters), 1))
    for group in _chunks([texts[i] for i in with_letters]):
        docs = np.array([p[0] for p in group])
        for b, starts in _buckets(group):
            np.add.at(sums, docs, np.add.reduceat(model.logp[b], starts, axis=0, dtype=np.float64))
    lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if len(with_letters):
        best = sums.argmax(axis=1)
        p = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for k, i in enumerate(with_letters):
            lang[i], score[i] = model.langs[best[k]], float(p[k])
    return lang, score


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                     lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the most probable language and its posterior (0 to 1); map-only.

    ``und`` with score 0 if the text is null or has no letter.  Columns of the
    output names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prior, model.logp))
    rest = docs.drop(lang_out, score_out)
    names = rest.columns
    schema = T.StructType([*rest.schema.fields, T.StructField(lang_out, T.StringType()),
                           T.StructField(score_out, T.DoubleType())])
    at = names.index(text_col)

    def run(batches):
        model = LanguageModel(*shared.value)
        for b in slices(batches):
            lang, score = score_texts(b.column(at).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*names, lang_out, score_out])

    return rest.mapInArrow(run, schema)


__all__ = ["LanguageModel", "held_out", "one_language", "predict_language", "score_texts", "train_language_model"]
