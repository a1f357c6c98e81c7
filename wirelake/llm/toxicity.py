"""Toxicity by compression distance: which of two dictionaries makes a window shorter.

Two zstandard dictionaries are trained on labelled text, one on ordinary and one on toxic texts;
they hold what repeats in each, phrases too. Two more are lists of words: those of ordinary texts,
the more frequent the nearer, and the same with the words that toxic texts have and ordinary ones
lack. Both lists hold the same ordinary words at the same distances, so a window differs in length
only by what toxic text alone explains. How much a text's windows save, set against thresholds calibrated
on labelled rows that the dictionaries have not seen, gives its score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import blocks, common

#: Labelled texts of each class that the model is fitted on, at most; the least hashes of doc_id.
#: Every third of them calibrates, the others fill the dictionaries.
LABELLED_ROWS = 5_000
#: Bytes of a window, which ends at the next space; a word longer than a window is cut.
WINDOW = 44
#: Ordinary words of the dictionaries, and the compression level.
ORDINARY_WORDS, LEVEL = 100_000, 9
#: Bytes of a trained dictionary.
TRAINED_BYTES = 1 << 15
#: A word speaks for toxic text if it is in this many toxic texts and so many times likelier there.
LEAST_TEXTS, LEAST_RATIO = 8, 60.0
#: Bytes saved by a window that count as a sign, and as a strong one.
SIGNS = (3, 5)


def windows(text: bytes) -> list[bytes]:
    """The whole text in runs of whole words; an empty text has none."""
    out, at, end = [], 0, len(text)
    while at < end:
        to = text.find(b" ", at + WINDOW, at + 4 * WINDOW)
        to = to if to >= 0 else min(end, at + 4 * WINDOW)
        out.append(text[max(at - 1, 0) : to + 1])
        at = to + 1 if text[to : to + 1] == b" " else to
    return out


def lowered(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode()


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...] = (0.0,) * 7
    trained: tuple[bytes, bytes] = (b"", b"")  # of ordinary and of toxic text

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "weights": self.weights, "trained": self.trained}

    @cached_property
    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in (self.ordinary, self.toxic, *self.trained):
            raw = zstandard.DICT_TYPE_AUTO if data in self.trained else zstandard.DICT_TYPE_RAWCONTENT
            book = zstandard.ZstdCompressionDict(data, dict_type=raw)
            book.precompute_compress(level=LEVEL)
            out.append(
                zstandard.ZstdCompressor(dict_data=book, write_checksum=False, write_content_size=False, write_dict_id=False)
            )
        return out

    def distances(self, text: bytes) -> np.ndarray:
        """For each window, the bytes that the toxic list and the toxic trained dictionary save."""
        ordinary, toxic, plain, bad = (c.compress for c in self.compressors)
        saved = [(len(ordinary(w)) - len(toxic(w)), len(plain(w)) - len(bad(w))) for w in windows(lowered(text))]
        return np.array(saved, np.float64).reshape(-1, 2)

    def features(self, text: bytes) -> tuple[float, ...]:
        """The list's greatest saving, windows with a sign and a strong sign, and windows at all;
        the greatest and the mean saving of the trained dictionary."""
        both = self.distances(text) if self.toxic else np.zeros((0, 2))
        found, learnt = both[:, 0], both[:, 1]
        signs = [math.log1p(int((found >= s).sum())) for s in SIGNS]
        mean = float(learnt.mean()) if len(learnt) else 0.0
        return float(min(found.max(initial=0), 12)), *signs, math.log1p(len(found)), float(min(learnt.max(initial=0), 24)), mean

    def score(self, text: bytes) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def dictionaries(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """The contents of both dictionaries; what is most frequent stands last, where it is cheapest."""
    theirs = Counter(w for t in toxic for w in set(t.split()))
    ours = Counter(w for t in ordinary for w in set(t.split()))
    share = max(len(ordinary), 1) / max(len(toxic), 1)
    least = min(LEAST_TEXTS, max(2, len(toxic) // 10))
    tells = [w for w, n in theirs.items() if n >= least and n * share >= LEAST_RATIO * (ours[w] + 0.5)]
    tells.sort(key=lambda w: (theirs[w], w))
    most = Counter(w for t in ordinary for w in t.split())
    everyday = sorted(most, key=lambda w: (-most[w], w))[:ORDINARY_WORDS]
    base = b" " + b" ".join(reversed(everyday)) + b" "
    return base, b" " + b" ".join(tells) + base


def trained(texts: list[bytes]) -> bytes:
    """A dictionary trained on the windows of some texts; too few to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(TRAINED_BYTES, [w for t in texts for w in windows(t)]).as_bytes()
    except zstandard.ZstdError:
        return b" " + b" ".join(texts)[-TRAINED_BYTES:] + b" "


def fit(rows: list[tuple[bytes, int]], share: float) -> Model:
    """Dictionaries and calibration from labelled texts; ``share`` of all labelled ones are toxic.

    Without both classes every text gets the share as its score.
    """
    by_class = {y: [lowered(t) for t, label in rows if label == y] for y in (0, 1)}
    share = min(max(share, 1e-3), 1 - 1e-3)
    prior = math.log(share / (1 - share))
    if min(map(len, by_class.values())) < 3:
        return Model(b"", b"", (prior, *(0.0,) * 6))
    parts = [[t for i, t in enumerate(by_class[y]) if i % 3] for y in (0, 1)]
    ordinary, toxic = dictionaries(*parts)
    model = Model(toxic=toxic, ordinary=ordinary, trained=(trained(parts[0]), trained(parts[1])))
    test = [(t, y) for y in (0, 1) for t in by_class[y][::3]]
    x, y = np.array([model.features(t) for t, _ in test]), np.array([label for _, label in test], np.float64)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    middle, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    design, ridge = np.column_stack([np.ones(len(x)), (x - middle) / scale]), np.array([1e-6, *[0.5] * x.shape[1]])
    beta = np.zeros(design.shape[1])
    for _ in range(50):  # Newton steps of a weighted logistic fit with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge * beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge), slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    slopes = beta[1:] / scale
    model.weights = (float(beta[0] - slopes @ middle), *slopes.tolist())
    return model


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def learned(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Model:
    """Fit on up to ``most`` labelled texts of each class that are not held out."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    counts = {r["_toxic"]: r["n"] for r in usable.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [usable.filter(F.col("_toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # twice `most` rows at most
    texts = docs.filter("text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("_text")).join(picked, "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min("_text").alias("_text"), F.max("_toxic").alias("_toxic")).collect()
    rows = sorted((r["doc_id"], bytes(r["_text"]), int(r["_toxic"])) for r in rows)
    return fit([(t, y) for _, t, y in rows], counts.get(1, 0) / max(sum(counts.values()), 1))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the score of each whole text.

    Null and empty texts have no window and get the score of a text without any toxic saving;
    repeated rows score alike; an empty table gives no rows; other columns are ignored.
    """

    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [own.score(t) for t in blocks.texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    done = scored(docs, learned(docs, common.table(spark, sf_dir, "labels")))
    return done.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
