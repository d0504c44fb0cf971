"""SentencePiece encoding and decoding by streaming Viterbi.

The vocabulary is a SentencePiece model's pieces. Each piece has a log probability (by default 1/rank of its score,
normalised); a character that no piece covers is spelled in byte pieces. The best segmentation has the largest sum.

``Stream`` reads marked text chunk by chunk. It keeps characters and path scores for a window as long as the longest
piece: no later piece can start before it. Whenever the paths of all live positions of the window lead back through one
boundary, the ids before it are committed and forgotten. No piece has a mark of a blank after another character, so
every such place is a boundary where all paths converge; what lies between two of them is one unit. A unit goes through
a stream when it is met first; its ids are remembered (up to ``CACHE`` units, then forgotten) for the next time.

A run that no path decides (of one letter, say) has its backpointers and ids kept, six bytes a character, until it is
decided or ends; scores and characters are never kept beyond the window. Texts of any length are read whole.

A blank is written as the mark U+2581, and one mark is put before the text. A U+2581 of the text itself is spelled in
bytes, so decoding gives back every text exactly.

Defined cases: null and empty texts have no ids and decode to an empty text; any Unicode text round-trips; unknown ids
decode to nothing; repeated rows are encoded alike; empty tables give empty results; extra columns pass through.
The vocabulary file is read on the driver and sent to tasks as a list of pieces (a few hundred kB).
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packed import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 500_000
CHUNK = 256
_NEVER = -math.inf


def load_pieces(path: str = MODEL) -> list[tuple[str, float, int]]:
    """Piece, score and kind (0 plain, 1 byte, 2 never produced) by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i),
             1 if sp.is_byte(i) else 2 if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else 0)
            for i in range(sp.get_piece_size())]


class Vocabulary:
    def __init__(self, pieces: list[tuple[str, float, int]]):
        import ahocorasick

        plain = sorted((-score, i) for i, (_, score, kind) in enumerate(pieces) if kind == 0)
        norm = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
        self.find = ahocorasick.Automaton()
        self.longest, self.chars, self.alphabet = 1, set(), set()
        for rank, (_, i) in enumerate(plain, 1):
            p = pieces[i][0]
            self.find.add_word(p, (len(p), -math.log(rank) - norm, i))
            self.longest = max(self.longest, len(p))
            self.alphabet.update(p)
            if len(p) == 1:
                self.chars.add(p)
            if MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} has a blank inside; units would not end at blanks")
        self.find.make_automaton()
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary needs all 256 byte pieces")
        self.byte_score = -math.log(len(plain)) - norm - 10.0
        value = {i: b for b, i in self.byte_ids.items()}
        self.bytes_of = [bytes([value[i]]) if i in value else b"" if kind == 2 else
                         p.replace(MARK, " ").encode() for i, (p, _, kind) in enumerate(pieces)]

    def spelled(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


class Stream:
    """Viterbi over a stream of characters (blanks already marks); positions count from the last committed boundary.

    ``text`` holds the last characters, fewer than the longest piece has, and ``score`` and ``root`` the positions
    before, between and after them: no later piece can start before. ``root`` tells through which position of the last
    check's window each path came: when all live paths came through one, they have converged there.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text, self.score, self.root = "", [0.0], [0]
        # of each position since the boundary: characters of its last piece, and the id, or for a spelled character
        # the code point as a number below 0
        self.step, self.ids = array("H"), array("i")

    def feed(self, chunk: str, literal: bool = False, last: bool = False) -> list[int]:
        """Ids committed after reading ``chunk``; ``literal``: the chunk is one character to spell in bytes; ``last``:
        ``close`` follows, so nothing is committed before."""
        v, old = self.v, len(self.text)
        text = self.text = self.text + ("\x00" if literal else chunk)  # which no piece has
        n = len(text)
        score, step, ids = self.score, self.step, self.ids
        score += [_NEVER] * (n - old)
        none = bytes(4 * (n - old))
        ids.frombytes(none)
        step.frombytes(none[:2 * (n - old)])
        base = len(step) - n - 1  # of position k of the window
        if literal:
            self._spell(old, n, base, chunk)
        else:
            done = old  # positions up to here have their final score
            for end, (size, p, i) in v.find.iter(text):
                if end < old:
                    continue
                if end > done:
                    self._spell(done, end, base)
                    done = end
                s = score[end + 1 - size] + p
                end += 1
                if s > score[end]:
                    score[end], step[base + end], ids[base + end] = s, size, i
            self._spell(done, n, base)
        return [] if last else self._check(old, base)

    def _check(self, old: int, base: int) -> list[int]:
        """Commits what all live paths agree on, and moves the window on."""
        n, keep = len(self.text), self.v.longest - 1
        root, step, score = self.root, self.step, self.score
        for k in range(old + 1, n + 1):
            root.append(root[k - step[base + k]] if score[k] > _NEVER else -1)
        first = max(0, n - keep)
        roots = {root[k] for k in range(first, n + 1) if score[k] > _NEVER}
        out = self._commit(roots.pop()) if len(roots) == 1 else None
        self.text = self.text[first:]
        self.score = score[first:]
        if out is None:
            self.root = root[first:]
            return []
        top = max(self.score)
        self.score = [s - top for s in self.score]
        at = len(self.step)
        # a boundary inside the window: nothing can start before it
        self.root = [max(0, at - len(self.text) + k) for k in range(len(self.text) + 1)]
        return out

    def _spell(self, a: int, b: int, base: int, literal: str = "") -> None:
        """Spells in bytes the characters at a..b that no piece covers, or the literal character."""
        for k in range(a, b):
            c = literal or self.text[k]
            if (literal or c not in self.v.chars) and self.score[k] > _NEVER:
                s = self.score[k] + len(self.v.spelled(c)) * self.v.byte_score
                if s > self.score[k + 1]:
                    self.score[k + 1], self.step[base + k + 1], self.ids[base + k + 1] = s, 1, -1 - ord(c)

    def _commit(self, at: int) -> list[int]:
        """Ids of the path to the boundary ``at``, which becomes position 0."""
        step, ids = self.step, self.ids
        out, k = [], at - 1
        while k >= 0:
            out.append(ids[k])
            k -= step[k]
        del step[:at], ids[:at]
        out.reverse()
        if out and min(out) < 0:
            out = [y for x in out for y in (self.v.spelled(chr(-1 - x)) if x < 0 else (x,))]
        return out

    def close(self) -> list[int]:
        """Ids of the rest; the stream is as new."""
        out = self._commit(len(self.step))
        self.text, self.score, self.root = "", [0.0], [0]
        return out

    def read(self, unit: str, chunk: int = CHUNK) -> list[int]:
        """Ids of a stretch of marked text, read in chunks, to its end."""
        out: list[int] = []
        for a in range(0, len(unit) - chunk, chunk):
            out += self.feed(unit[a:a + chunk])
        rest = len(unit) % chunk or min(chunk, len(unit))
        self.feed(unit[len(unit) - rest:] if rest < len(unit) else unit, last=True)
        return out + self.close() if out else self.close()


def segment(vocabulary: Vocabulary, unit: str, chunk: int = CHUNK) -> list[int]:
    """Ids of a stretch of marked text, read in chunks by a stream of its own."""
    return Stream(vocabulary).read(unit, chunk)


class _Units(dict):
    """Ids, as bytes, of each word after a blank; ``streamed`` counts those that went through a stream."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.stream, self.streamed = Stream(vocabulary), 0

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self.streamed += 1
        ids = self[word] = array("i", self.stream.read(MARK + word)).tobytes()
        return ids


class Codec:
    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.vocabulary = Vocabulary(pieces)
        self.units = _Units(self.vocabulary)

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        if MARK in text:
            return self._with_marks(text)
        words = text.split(" ")
        if "" not in words:
            return b"".join(map(self.units.__getitem__, words))
        out, blanks = [], 0
        for w in words[:-1]:
            if w:
                out.append(self.units[MARK * blanks + w])
                blanks = 0
            else:
                blanks += 1
        out.append(self.units[MARK * blanks + words[-1]])
        return b"".join(out)

    def _with_marks(self, text: str) -> bytes:
        stream, out = Stream(self.vocabulary), []
        out += stream.feed(MARK)
        for k, part in enumerate(text.split(MARK)):
            if k:
                out += stream.feed(MARK, literal=True)
            part = part.replace(" ", MARK)
            for a in range(0, len(part), CHUNK):
                out += stream.feed(part[a:a + CHUNK])
        return np.array(out + stream.close(), dtype=np.int32).tobytes()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32).tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The text as UTF-8."""
        known = self.vocabulary.bytes_of
        if ids and not 0 <= min(ids) <= max(ids) < len(known):
            ids = [i for i in ids if 0 <= i < len(known)]
        return b"".join(map(known.__getitem__, ids))[1:]

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def _codec(pieces) -> Codec:
    """The codec of a broadcast vocabulary, built once a worker."""
    if pieces.value[0] not in _codecs:
        _codecs.clear()
        _codecs[pieces.value[0]] = Codec(pieces.value[1])
    return _codecs[pieces.value[0]]


def _vocabulary(spark: SparkSession, model: str):
    pieces = load_pieces(model)
    return spark.sparkContext.broadcast((hash(tuple(pieces)), pieces))


def _replaced(batch: pa.RecordBatch, keep: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + list(more.values()), [*keep, *more])


def encode(docs: DataFrame, text: str = "text", out: str = "ids", model: str = MODEL,
           decoded: str | None = None) -> DataFrame:
    """Adds the ids of every text as array<int>; ``decoded`` names a column for the SHA-256 of what they decode to."""
    keep = [c for c in docs.columns if c not in (out, decoded)]
    pieces = _vocabulary(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for b in (part for batch in batches for part in slices(batch, text)):
            found = [codec.encode_bytes(t) for t in pc.fill_null(b.column(b.schema.get_field_index(text)), "").to_pylist()]
            ends = np.cumsum([0, *map(len, found)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                           pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))
            more = {out: ids}
            if decoded:
                more[decoded] = pa.array([sha256(codec.decode_bytes(array("i", x).tolist())).hexdigest() for x in found],
                                         pa.string())
            yield _replaced(b, keep, more)

    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))
    schema = T.StructType([*docs.select(*keep).schema, *fields])
    return docs.select(*keep).mapInArrow(run, schema)


def decode(coded: DataFrame, ids: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """Adds the text of every row's ids; null ids give an empty text."""
    keep = [c for c in coded.columns if c != out]
    pieces = _vocabulary(coded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(pieces)
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            flat = pc.fill_null(lists.flatten(), -1).to_numpy()
            texts = [codec.decode(flat[a:z].tolist()) for a, z in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
            yield _replaced(b, keep, {out: pa.array(texts, pa.string())})

    schema = T.StructType([*coded.select(*keep).schema, T.StructField(out, T.StringType())])
    return coded.select(*keep).mapInArrow(run, schema)
