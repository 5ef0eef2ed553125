"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

The order and place of a document depend on its length alone, so the packing is computed from the
histogram of lengths, which has at most ``capacity`` rows at any data size. A segment tree over
the remaining capacities gives the tightest open sequence in logarithmic time; equal documents are
placed as runs, so the plan holds runs of sequences and not sequences. Every document then
finds its place from its rank among those of its length. Ranks are made from running counts per
task, and no length is gathered in one task.

Documents longer than ``capacity`` are cut into pieces of ``capacity`` tokens; the last may be
shorter. NULL text counts as empty and has the end token alone. Repeated rows are packed as often as
they occur, NULL ids stay NULL, and no rows give no rows. Further columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyweave.llm.common import byte_steps, text_or_empty
from tallyweave.sources.staging import stage

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 100_000  # in each of two generations, some 20 MB; a worker keeps them between tasks
STEP_ROWS, STEP_BYTES = 1250, 6 << 20  # of texts that are split at once, at most
_MARKS = ".,;:!?\"()[]{}|*#%&$@+=/-"  # ASCII characters that are neither letters nor digits and begin nothing special
_KEEP_CASE = re.compile(r"<\||[\u0300-\u037f]").search  # special tokens and, among others, combining marks
_SMALL_LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+").fullmatch  # of Latin-1
# Byte-level models spell a byte as the character of Latin-1 if that is visible, else as one of U+0100 and on, in order.
_HIDDEN = {byte: chr(256 + i) for i, byte in enumerate([*range(33), *range(127, 161), 173])}
_SPELLED = {code: "".join(_HIDDEN.get(byte, chr(byte)) for byte in chr(code).encode()) for code in range(0xDF, 0x100)}

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
])
WITH_IDS = T.StructType([*PIECES.fields, T.StructField("ids", T.BinaryType())])


@lru_cache(maxsize=1 << 16)
def stays_letter(letter: str) -> bool:
    """Whether composing and lower-casing a letter leave a letter at its end."""
    return unicodedata.normalize("NFC", letter).lower()[-1].isalpha()


class WordEncoder:
    """Token ids of a text, word by word.

    The tokenizer ignores case and drops white space, and no token crosses it, so the ids of a text are those of its
    lower-cased words put together. ASCII white space alone is split at here; other white space stays inside a
    "word" and is left to the tokenizer. Words that may spell a special token keep their case, and so do those that may hold
    combining marks, because some compose with a small letter only. Small letters of Latin-1 alone skip the tokenizer's
    normalizer and splitting, which leave them as they are, and go to its model in the model's spelling of bytes.
    Texts are split a step at a time, and a word is looked up once a step. Words that a step repeats are kept, in two
    generations, so that frequent ones stay when room is made.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.model = self.tokenizer.model
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def find(self, words: list[str], counts: list[int]) -> list[bytes]:
        """Ids of different words; those of words that occur more than once are kept."""
        known, older, packed, tokenize, stems, out = self.known, self.older, self.packed, self.model.tokenize, {}, []
        for word, count in zip(words, counts):
            ids = known.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    stem = word.rstrip(_MARKS)
                    if _SMALL_LETTERS(stem):
                        ids = stems.get(stem)
                        if ids is None:
                            letters = stem if stem.isascii() else stem.translate(_SPELLED)
                            ids = stems[stem] = b"".join([packed[token.id] for token in tokenize(letters)])
                        if len(stem) < len(word):
                            ids += self.ids(word[len(stem):])
                    else:
                        ids = self.other(word, stem)
                if count > 1:
                    known[word] = ids
            out.append(ids)
        return out

    def ids(self, word: str) -> bytes:
        return self.find([word], [2])[0]

    def other(self, word: str, stem: str) -> bytes:
        """Ids of a word that begins with something else than small letters of Latin-1."""
        if not _KEEP_CASE(word):
            lower = word.encode().lower().decode()  # A to Z alone
            if lower != word:
                return self.ids(lower)
        if len(stem) < len(word) and stem.isalpha() and stays_letter(stem[-1]):  # letters and marks are split by the tokenizer, too
            return self.ids(stem) + self.ids(word[len(stem):])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for first, last in byte_steps(texts, STEP_BYTES):
            words = pc.ascii_split_whitespace(pa.array(texts[first:last], pa.string()))
            bounds, coded = words.offsets.to_numpy(), words.values.dictionary_encode()
            del words
            counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
            if len(self.known) > self.cached:
                self.known, self.older = {}, self.known
            found = self.find(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), counts)
            ids = pa.array(found, pa.large_binary()).take(coded.indices)
            del coded, counts, found
            ends = np.frombuffer(ids.buffers()[1], np.int64)[bounds]
            whole = memoryview(ids.buffers()[2] or b"")
            for start, end in zip(ends, ends[1:]):
                yield whole[start:end].tobytes()


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """Each document's pieces, numbered within their task and length: ``part`` and ``nth``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = word_encoder(tokenizer), {}, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for batch in (batch.slice(at, STEP_ROWS) for batch in batches for at in range(0, batch.num_rows, STEP_ROWS)):
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode(batch.column(1).cast(pa.binary()).to_pylist())):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    own = tokens[at:at + 4 * capacity]
                    length = len(own) // 4
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(own), part, nth, *([own] if with_ids else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    schema = WITH_IDS if with_ids else PIECES
    names = schema.fieldNames()
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()][:len(names)]
    return docs.select(F.col(id_column).cast("long"), text_or_empty(text_column)).mapInArrow(cut, schema)


class CapacityTree:
    """A segment tree over remaining capacities: which of them have open sequences."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        node = self.leaves + room
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest open capacity that holds ``length``."""
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1:  # up to the first open subtree on the right, then down its left edge
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs ``(length, first rank, count, first sequence, documents per sequence, offset)`` that place
    ``histogram[length]`` documents of each length, longest first, each in the tightest sequence."""
    tree, rooms, runs, sequences = CapacityTree(capacity), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not rooms.get(room):
                tree.set(room, True)
            rooms.setdefault(room, []).append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                each = room // length
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            placed = min(left, n * each)
            full, rest = divmod(placed, each)
            runs.append((length, rank, placed, first, each, capacity - room))
            put(room - each * length, first, full)
            put(room - rest * length, first + full, int(rest > 0))
            put(room, first + full + (rest > 0), n - full - (rest > 0))
            left, rank = left - placed, rank + placed
    return np.array(runs, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They must come from a written table: their numbers
    were given by the tasks that made them."""
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select(F.col("length").alias("_length"), F.col("part").alias("_part"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    histogram = {row[0]: row[1] for row in per_part.groupBy("length").agg(F.sum("_n")).collect()}  # one row per length
    runs = best_fit_decreasing(histogram, capacity)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    starts = {length: i for i, length in reversed(list(enumerate(runs[:, 0].tolist())))}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = (batch.column("nth").to_numpy(zero_copy_only=False) + batch.column("_base").to_numpy(zero_copy_only=False))
            at = np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                first = starts[int(length)]
                last = first + int(np.searchsorted(runs[first:, 0], length, "right"))
                at[own] = first + np.searchsorted(runs[first:last, 1], ranks[own], "right") - 1
            into, within = np.divmod(ranks - runs[at, 1], runs[at, 4])
            kept = batch.select([n for n in batch.schema.names if n != "_base"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(runs[at, 3] + into), pa.array(runs[at, 5] + within * lengths)],
                [*kept.schema.names, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    joined = pieces.join(bases, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part"))).drop("_length", "_part")
    return joined.mapInArrow(place, schema)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: its place in its document, in its sequence, and on request its ids
    as little-endian unsigned 32-bit numbers."""
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids), "token-pieces")
    return pack(pieces, capacity).drop("part", "nth")
