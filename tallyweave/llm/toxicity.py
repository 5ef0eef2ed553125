"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, and one that has in front of the same
ordinary text what is trained on toxic text. A text is cut into overlapping windows, each window is compressed with either
dictionary, and the bytes that the toxic one saves are the window's evidence. The savings of the best
windows give a document's evidence; its threshold and slope are calibrated on labelled documents that
the dictionaries have not seen.

What toxic text has and ordinary text has not are strings of six bytes that are common in toxic training
documents and rare in ordinary ones; the toxic dictionary is trained on the stretches that they cover.
What it then still shares with ordinary training text is cut out, so that ordinary windows save nothing.

The classifier is fitted in the driver on a bounded sample: at most ``SAMPLE_DOCS`` documents per class for the
dictionaries and as many for the calibration, the first by a hash of their ids, none over ``SAMPLE_BYTES``. Every
document is scored over its whole text. Texts are lower-cased (ASCII) and runs of ASCII white space become one space. A NULL
text is empty, and an empty text has no evidence. Without documents of both classes to learn from, every score is 0.
Labels that are NULL or name no document are not used; a document with several labels is toxic if one says so. Repeated rows get
equal scores, a NULL id is kept, no rows give no rows, and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.common import text_or_empty

SAMPLE_DOCS, SAMPLE_BYTES = 1200, 65_536
WINDOW, STRIDE, GRAM = 60, 48, 6
ORDINARY_BYTES, TOXIC_BYTES = 1024, 3072
COMMON, RATIO = 0.01, 20.0  # share of toxic documents that have a string, and how many times that of ordinary ones
_HEADER = 200  # entropy tables at the head of a trained dictionary
_PAD = b"@0123456789abcdef#ZYXWVUTSRQPONM"  # in both dictionaries and behind every window: makes each block compress


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def grams(text: bytes) -> np.ndarray:
    """The strings of six bytes of a text, as numbers."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | raw[i:i + n]
    return out


def document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings and the number of texts that have each."""
    found = [np.unique(grams(text)) for text in texts]
    return np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)


def covered(text: bytes, chosen: np.ndarray) -> list[bytes]:
    """The longest stretches of a text whose every string is among the chosen (sorted) ones."""
    own = grams(text)
    if not len(own) or not len(chosen):
        return []
    at = np.searchsorted(chosen, own)
    at[at == len(chosen)] = 0
    hit = np.concatenate([[False], chosen[at] == own, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    return [text[a:b + GRAM - 1] for a, b in zip(edges[::2], edges[1::2])]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_GREEDY, window_log=13, hash_log=12, chain_log=12,
        search_log=5, min_match=GRAM, target_length=16, write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = zstandard.ZstdCompressionDict(content + _PAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)


def _trained(size: int, samples: list[bytes]) -> bytes:
    """The content of a dictionary trained on the samples; of very few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size + _HEADER, samples).as_bytes()[_HEADER:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: float = 0.0
    slope: float = 0.0

    def savings(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """For each text, the bytes that the toxic dictionary saves in each window."""
        plain, toxic = _compressor(self.ordinary).compress, _compressor(self.toxic + self.ordinary).compress
        for text in texts:
            text = normal(text)
            windows = [text[at:at + WINDOW] + _PAD for at in range(0, max(1, len(text) - (WINDOW - STRIDE)), STRIDE)] if text else []
            yield np.fromiter((len(plain(w)) - len(toxic(w)) for w in windows), np.int64, len(windows))

    def evidence(self, texts: Iterable[bytes]) -> np.ndarray:
        """The best window's savings, and half of the next ones', which tell one odd window from several."""
        out = []
        for saved in self.savings(texts):
            best = np.sort(saved)[::-1][:3]
            out.append(float(np.dot(best, [1.0, 0.5, 0.25][:len(best)])) if len(best) else 0.0)
        return np.array(out)

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        if not self.slope:
            return np.zeros(len(list(texts)))
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.evidence(texts) - self.threshold), -30, 30)))


def trained_model(ordinary: list[bytes], toxic: list[bytes], held_ordinary: list[bytes], held_toxic: list[bytes],
                  toxic_share: float) -> ToxicityModel:
    """Dictionaries from the first two samples, threshold and slope from the other two, weighted so that the classes have
    the given shares."""
    if not (ordinary and toxic and held_ordinary and held_toxic):
        return ToxicityModel(b"", b"")
    ordinary, toxic = [normal(t) for t in ordinary], [normal(t) for t in toxic]
    strings, found = document_counts(toxic)
    known, seen = document_counts(ordinary)
    at = np.minimum(np.searchsorted(known, strings), max(len(known) - 1, 0))
    usual = np.where(known[at] == strings, seen[at], 0) if len(known) else np.zeros(len(strings))
    telling = strings[(found >= max(3, COMMON * len(toxic))) & (found / len(toxic) > RATIO * (usual + 0.5) / len(ordinary))]
    plain = _trained(ORDINARY_BYTES, [t[i:i + 64] for t in ordinary for i in range(0, len(t), 64)])
    stretches = [s for t in toxic for s in covered(t, telling)]
    content = _trained(TOXIC_BYTES, stretches * 2) if stretches else b""
    rare = strings[~np.isin(strings, known[seen > max(1, 0.002 * len(ordinary))])] if len(known) else strings
    model = ToxicityModel(plain, b"\0".join(covered(content, rare)))

    values = np.concatenate([model.evidence(held_ordinary), model.evidence(held_toxic)])
    is_toxic = np.append(np.zeros(len(held_ordinary), bool), np.ones(len(held_toxic), bool))
    weight = np.where(is_toxic, toxic_share / len(held_toxic), (1 - toxic_share) / len(held_ordinary))
    cuts = np.unique(np.append(values, 0))
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts + 0.5
    wrong = [float(weight[(values > cut) != is_toxic].sum()) for cut in cuts]
    least = [c for c, w in zip(cuts, wrong) if w <= min(wrong) + 1e-12]
    spread = max(float(values[is_toxic].std()), 1.0)
    return ToxicityModel(model.ordinary, model.toxic, float(np.median(least)), 4.0 / spread)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Learn from the labelled documents in ``labels`` (ids and labels); leave out there what must not be learned from."""
    known = (labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).cast("long").alias("_id")).agg(F.max(F.col(label_column).cast("int")).alias("_toxic")))
    shares = known.agg(F.avg("_toxic")).first()[0] or 0.0
    texts = docs.select(F.col(id_column).cast("long").alias("_doc"), text_or_empty(text_column).alias("_text")).filter(
        F.octet_length("_text").between(1, SAMPLE_BYTES))
    order = F.xxhash64("_id", F.lit("toxicity"))
    samples: dict[int, list[bytes]] = {}
    for value in (0, 1):  # ids first, so that only the chosen texts are moved
        spare = known.filter(F.col("_toxic") == value).orderBy(order, "_id").limit(3 * sample_docs).select("_id")
        chosen = texts.join(F.broadcast(spare), F.col("_doc") == F.col("_id")).orderBy(order, "_id", "_text").limit(2 * sample_docs)
        samples[value] = [row[0].encode() for row in chosen.select("_text").toLocalIterator()]
    return trained_model(samples[0][::2], samples[1][::2], samples[0][1::2], samples[1][1::2], float(shares))


def scored(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and the score (0 to 1, from 0.5 toxic) of every document."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(texts), pa.float64())], [id_column, "score"])

    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])
    return docs.select(id_column, text_or_empty(text_column)).mapInArrow(score, schema)


def keep_clean(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that are not toxic, as they came."""

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"" if text is None else text for text in batch.column(text_column).cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array(model.scores(texts) < 0.5))

    return docs.mapInArrow(clean, docs.schema)
