"""Language ID by multilingual mixture inference.

Every language gets a byte-trigram model (a byte given the two before it, inside
padded words) from the counts of all training rows; rare trigrams are smoothed by
the counts of all languages together.  A document is a mixture of languages: each
word is drawn from one of them.  Expectation-maximisation estimates the
document's proportions from its words' likelihoods under every language.  The
language set is chosen by penalised likelihood: languages join in order of their
share under the full mixture, as long as the likelihood gains more than
``PENALTY / 2 * ln(words)`` for each.  The answer is the language with the largest
proportion, and that proportion is the score.

Training counts are summed by Spark over all rows (written to the shared folder), and
so are the models' probabilities; driver and tasks get those of every counted trigram.
Folded text has 155 different bytes, so that is at most 155^3 trigrams a language,
whatever the size of the corpus, and each has a cell of its own.

A text that is null or has no letter is ``und`` with score 0, as is any text when
nothing was learnt.  Null languages are not learnt from; a null doc_id counts as
the empty string in the split.  Repeated rows count as often as they occur, ties
go to the language that sorts first, other columns are not read, and an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import raw, slices, written

#: Pseudo-counts that the shared model has in each language's.
SHARED = 4.0
PENALTY = 2.0
ROUNDS = 6
#: Text bytes looked at at once: each takes some forty bytes of arrays.
SLICE = 2 << 20
#: Letters to themselves (A-Z to a-z), bytes of other scripts too, all else to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LETTER = regex.compile(r"\p{L}")
#: Folded bytes and the number of each among them.
BYTES = sorted(set(FOLD))
PLACE = np.zeros(256, np.int32)
PLACE[BYTES] = np.arange(len(BYTES))
CELLS = len(BYTES) ** 3
#: Log-probability of what no training row has.
UNSEEN = np.float32(-np.log(256.0))


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all trigrams of the texts' words, where each word's begin, and words by text.

    A word ends with the space behind it; its first byte sees two spaces.
    """
    folded = [b"  " + t.translate(FOLD) + b" " for t in texts]
    at = np.frombuffer(b"".join(folded), np.uint8)
    space = at == 32
    mine = np.flatnonzero(~space[1:] | ~space[:-1]) + 1  # not the second of two spaces
    before = np.where(space[mine - 1], 32, at[mine - 2]).astype(np.uint32)
    codes = before << 16 | at[mine - 1].astype(np.uint32) << 8 | at[mine]
    first = np.flatnonzero(space[mine - 1])
    ends = np.cumsum([len(t) for t in folded])
    of = np.searchsorted(ends, mine[first], side="right")
    return codes, first, np.bincount(of, minlength=len(texts))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), raw(part.column("text")), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                codes, n = np.unique(trigrams(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])


def counts(rows: DataFrame) -> DataFrame:
    """lang, code, n over all rows of text, lang."""
    rows = rows.where("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(_counted, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def cell(codes: np.ndarray) -> np.ndarray:
    """The cell of each trigram: one for every three folded bytes, shared by none."""
    k = np.int32(len(BYTES))
    return (PLACE[codes >> 16] * k + PLACE[codes >> 8 & 255]) * k + PLACE[codes & 255]


class Model:
    """Log-probabilities of all counted trigrams by language."""

    def __init__(self, langs: list[str], codes: np.ndarray, logs: np.ndarray) -> None:
        self.langs = langs
        self.row = np.zeros(CELLS, np.int32)  # by cell; 0 is for trigrams not counted
        self.row[cell(codes)] = np.arange(1, len(codes) + 1)
        self.logs = np.full((len(langs), len(codes) + 1), UNSEEN, np.float32)
        self.logs[:, 1:] = logs

    @property
    def table(self) -> np.ndarray:
        """Log-probabilities of all cells: languages x CELLS."""
        return self.logs[:, self.row]

    def words(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word: languages x words."""
        at = self.row[cell(codes)]
        return np.stack([np.add.reduceat(t[at], first) for t in self.logs]) if len(first) else np.zeros((len(self.langs), 0), np.float32)


def log_probabilities(counted: DataFrame, totals: dict[str, int]) -> DataFrame:
    """code and p0, p1, ...: of each language in the order of ``totals`` (trigrams by language).

    The shared model weighs languages alike.  All sums are over a trigram or over the at
    most 256 trigrams of one context.
    """
    seen = counted.groupBy("code").pivot("lang", list(totals)).agg(F.sum("n"))
    n = [f"n{i}" for i in range(len(totals))]
    seen = seen.toDF("code", *n).na.fill(0)
    share = sum((F.col(c) / F.lit(float(t)) for c, t in zip(n, totals.values(), strict=True)), F.lit(0.0))
    context = Window.partitionBy(F.shiftright("code", 8))
    seen = seen.withColumn("share", share)
    shared = (F.col("share") + 1e-9) / (F.sum("share").over(context) + 256e-9)
    seen = seen.select("code", *n, shared.alias("shared"), *[F.sum(c).over(context).alias(f"of_{c}") for c in n])
    logs = [F.log((F.col(c) + SHARED * F.col("shared")) / (F.col(f"of_{c}") + SHARED)).cast("float").alias(f"p{i}") for i, c in enumerate(n)]
    return seen.select("code", *logs)


def fit(rows: DataFrame) -> Model:
    """The model of all rows' text and lang; the driver gets a row a counted trigram, at most CELLS."""
    counted = written(counts(rows), "trigrams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}  # languages
    if not totals:
        return Model([], np.zeros(0, np.int32), np.zeros((0, 0), np.float32))
    found = log_probabilities(counted, totals).toArrow()
    return Model(list(totals), found.column("code").to_numpy(), np.stack([found.column(f"p{i}").to_numpy() for i in range(len(totals))]))


def _sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=-1, dtype=np.float64)


def _em(likelihood: np.ndarray, n: np.ndarray, theta: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (languages x texts), and the log-likelihood of each text's mixture.

    likelihood: of each word, languages x words; n: words by text (at least one).
    """
    starts = np.cumsum(n) - n
    top = likelihood.max(0)
    p = np.exp(likelihood - top)
    for _ in range(rounds):
        r = p * np.repeat(theta.astype(np.float32), n, axis=1)
        r /= np.maximum(r.sum(0), 1e-30)
        theta = _sums(r, starts) / n
    mixed = (p * np.repeat(theta.astype(np.float32), n, axis=1)).sum(0)
    return theta, _sums(np.log(np.maximum(mixed, 1e-30)) + top, starts)


def infer(likelihood: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Proportions, languages x texts, of texts with ``n`` words each (at least one)."""
    k, starts = len(likelihood), np.cumsum(n) - n
    alone = _sums(likelihood, starts)
    out = np.zeros((k, len(n)))
    out[alone.argmax(0), np.arange(len(n))] = 1
    cost = penalty / 2 * np.log(np.maximum(n, 2))
    value = alone.max(0)
    live = np.flatnonzero(_sums(likelihood.max(0), starts) - value > cost) if k > 1 else np.zeros(0, np.int64)  # no mixture is above its words' best
    if not len(live):
        return out
    keep = np.repeat(np.isin(np.arange(len(n)), live), n)
    likelihood, n = likelihood[:, keep], n[live]
    share, _ = _em(likelihood, n, np.full((k, len(n)), 1 / k))
    order = np.argsort(-share, axis=0, kind="stable")
    for size in range(2, k + 1):
        chosen = order[:size]
        own = np.take_along_axis(likelihood, np.repeat(chosen, n, axis=1), 0)
        theta = np.take_along_axis(share, chosen, 0) + 1e-6
        theta, total = _em(own, n, theta / theta.sum(0))
        gain = total - (size - 1) * cost[live]
        better = gain > value[live]
        if not better.any():
            break
        at = np.flatnonzero(better)
        out[:, live[at]] = 0
        out[chosen[:, at], live[at]] = theta[:, at]
        value[live[at]] = gain[at]
        words = np.repeat(better, n)  # a text whose set no longer grows is done
        likelihood, n, live, order, share = likelihood[:, words], n[at], live[at], order[:, at], share[:, at]
    return out


def predict(model: Model, texts: list[bytes], detail: bool = False) -> tuple[list[str], list[float], list[list[float]] | None]:
    """Language and its proportion (and all proportions) of each text."""
    found, score = ["und"] * len(texts), [0.0] * len(texts)
    mixture: list[list[float]] = [[] for _ in texts]
    some = [i for i, t in enumerate(texts) if LETTER.search(t.decode())] if model.langs else []
    codes, first, n = trigrams([texts[i] for i in some])
    if some:
        share = infer(model.words(codes, first), n)
        for i, best, row in zip(some, share.argmax(0).tolist(), share.T.tolist(), strict=True):
            found[i], score[i] = model.langs[best], min(1.0, row[best])
            if detail:
                mixture[i] = row
    return found, score, mixture if detail else None


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                found, score, _ = predict(model.value, raw(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts == part


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows not held out."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).withColumn("held_out", held_out())
    model = docs.sparkSession.sparkContext.broadcast(model or fit(rows.where("not held_out")))
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")


def _kept(model, wanted: list[str] | None, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value.langs
        use = [i for i, x in enumerate(langs) if wanted is None or x in wanted]
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                texts = raw(part.column("text"))
                if langs:
                    keep = [bool(m) and sum(m[i] for i in use) >= least for m in predict(model.value, texts, True)[2]]
                else:  # nothing was learnt: what has a letter stays
                    keep = [bool(LETTER.search(t.decode())) for t in texts]
                yield part.filter(pa.array(keep, pa.bool_()))
    return run


def keep_identified(docs: DataFrame, wanted: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, of whose words the ``wanted`` languages (all that were
    learnt, if not given) have a share of ``least`` or more by the inferred mixture.

    A null text, or one without a letter, goes.  When nothing was learnt, all rows whose text has a letter stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out()).select(F.col("text"), F.col("lang"))))
    return docs.mapInArrow(_kept(model, wanted, least), docs.schema)
