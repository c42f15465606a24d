"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Method: a text is cut into marked words (spaces belong to the word they
precede, one space is put before the text). The distinct marked words of a batch
are sorted, which walks their trie depth-first: the best scores of all prefixes
that a word shares with its predecessor are kept, and the Viterbi forward step
runs only over its remaining letters. The segmentation maximises the sum of the
piece scores; of equal sums the one whose last piece starts first wins. A letter that is no piece becomes byte pieces.

No piece holds a space after another letter, a line break or a letter outside
the vocabulary, so words can be segmented apart from each other.

Scale: a map; the vocabulary (a fixed file) is broadcast, and the memory of
words already segmented is emptied when it reaches CACHE entries or 16 letters
for each.

Defined results: a null text has null ids and decodes to null; an empty text has
no ids; the letter U+2581 in a text stands for itself and is written as bytes,
so decoding gives back every text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, ship, values, with_row

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 400_000
#: Words of texts whose ids are gathered at once.
ENCODE_STEP = 1 << 16
DECODE_STEP = 1 << 18

_WORD = re.compile(r" +[^ \n]*|\n|[^ \n]+")


class Pieces:
    """Vocabulary of a model file: normal pieces with scores, byte pieces."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.raw: list[bytes] = []
        self.byte = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.scores.append(sp.get_score(i))
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                text = piece.replace(MARK, " ")
                self.ids[text] = i
                self.raw.append(text.encode())
        # Every ending of a piece; the score where the ending is a piece itself.
        self.endings: dict[str, float | None] = {p[k:]: None for p in self.ids for k in range(len(p))}
        self.endings.update((p, self.scores[i]) for p, i in self.ids.items())
        self.unknown = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.bytes = PieceBytes(self.raw)

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[str]:
        return self.bytes.decode_all(ids, counts)


class PieceBytes:
    """All that decoding needs, without the vocabulary's dicts: the bytes of all
    pieces one behind the other, where each starts, its size."""

    def __init__(self, raw: list[bytes]):
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.cumsum(self.size) - self.size

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[str]:
        """`decode` of texts whose ids are laid end to end; counts: how many each
        has. Bytes are gathered for DECODE_STEP ids at once."""
        parts, size = [], self.size[ids]
        for at in range(0, len(ids), DECODE_STEP):
            own, n = ids[at:at + DECODE_STEP], size[at:at + DECODE_STEP]
            end = np.cumsum(n)
            parts.append(self.flat[np.arange(end[-1]) + np.repeat(self.start[own] - (end - n), n)].tobytes())
        data, end = b"".join(parts), np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
        for s, e in zip(end[:-1], end[1:], strict=True):
            yield data[s + (data[s:s + 1] == b" " and e > s):e].decode("utf-8", "replace")


def segment(words: list[str], pieces: Pieces) -> Iterator[tuple[int, ...]]:
    """The ids of each of the sorted distinct `words`. best[j] and start[j] hold
    the best score of the first j letters and where its last piece starts; they
    depend on these letters alone and stay for the next word's shared prefix."""
    ids, endings, unknown = pieces.ids, pieces.endings, pieces.unknown
    best, start, before = [0.0], [0], ""
    for word in words:
        shared, end = 0, min(len(word), len(before))
        while shared < end and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1:], start[shared + 1:]
        for j in range(shared + 1, len(word) + 1):
            letter = word[j - 1]
            top, at = (None, 0) if letter in ids else (best[j - 1] + unknown, j - 1)
            for i in range(j - 1, -1, -1):
                part = word[i:j]
                if part not in endings:
                    break
                score = endings[part]
                if score is not None:
                    score += best[i]
                    if top is None or score >= top:
                        top, at = score, i
            best.append(top)
            start.append(at)
        out, j = [], len(word)
        while j:
            i = start[j]
            piece = ids.get(word[i:j])
            if piece is None:
                out.extend(pieces.byte[v] for v in reversed(word[i:j].encode()))
            else:
                out.append(piece)
            j = i
        before = word
        yield tuple(reversed(out))


class Known(dict):
    """word -> its number; words not met before get the next one."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Ids of words are kept one behind the other in one array, `start` and
    `size` by the word's number; a text's ids are gathered from there."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._clear()

    def _clear(self):
        self.known, self.letters = Known(), 0
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self):
        """Segment the new words, in sorted order."""
        new = self.known.new
        if not new:
            return
        order = sorted(range(len(new)), key=new.__getitem__)
        found: list[tuple[int, ...]] = [()] * len(new)
        for at, ids in zip(order, segment([new[i] for i in order], self.pieces), strict=True):
            found[at] = ids
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32)])
        self.letters += sum(map(len, new))
        self.known.new = []

    def _gather(self, numbers: list[int], words: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has; words: how many
        words each text has."""
        self._learn()
        at = np.array(numbers, np.int64)
        size = self.size[at]
        end = np.cumsum(size)
        ids = self.flat[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[at] - (end - size), size)]
        ends = np.append(0, end)[np.cumsum(np.array(words, np.int64))]
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: Iterable[str | None]) -> pa.ListArray:
        ids, sizes, valid, numbers, words = [], [], [], [], []

        def flush():
            if words:
                i, n = self._gather(numbers, words)
                ids.append(i)
                sizes.append(n)
                numbers.clear()
                words.clear()
            if len(self.known) > CACHE or self.letters > 16 * CACHE:
                self._clear()

        for text in texts:
            valid.append(text is not None)
            own = _WORD.findall(" " + text) if text else ()
            numbers.extend(map(self.known.__getitem__, own))
            words.append(len(own))
            if len(numbers) >= ENCODE_STEP:
                flush()
        flush()
        ends = np.append(0, np.cumsum(np.concatenate(sizes or [np.zeros(0, np.int64)]))).astype(np.int32)
        flat = np.concatenate(ids or [np.zeros(0, np.int32)])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=pa.array([not v for v in valid], pa.bool_()))


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """row (the whole input row as a struct) and ids (array<int>)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Pieces(model))

    at = docs.columns.index(text_col)

    def run(batches):
        encoder = Encoder(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), encoder.encode(values(b.column("row").field(at)))], ["row", "ids"])

    whole = docs.select(F.struct(*columns(docs)).alias("row"))
    return whole.mapInArrow(run, with_row(whole, "ids array<int>"))


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """row (the whole input row as a struct) and decoded (text of the ids)."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Pieces(model).bytes)

    at = encoded.columns.index(ids_col)

    def run(batches):
        for b in batches:
            ids = b.column("row").field(at)
            counts = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            found = shared.value.decode_all(ids.flatten().to_numpy(zero_copy_only=False), counts)
            texts = [text if ok else None for text, ok in zip(found, ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], ["row", "decoded"])

    whole = encoded.select(F.struct(*columns(encoded)).alias("row"))
    return whole.mapInArrow(run, with_row(whole, "decoded string"))
