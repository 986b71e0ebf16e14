"""Token ids in wavelet-matrix files.

Documents are sorted by id and written as blocks of consecutive documents, each one compressed
record: the block's ids as bit planes of a wavelet matrix, with counts of ones for rank and
select. From a record alone one can read any token, count an id in a range, or find its
occurrences; a whole block decodes plane by plane.
"""

from __future__ import annotations

import json
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.llm.common import checkpoint_dir, give_back

#: Tokens gathered for a block before it is written; a document is never parted.
BLOCK_TOKENS = 1_000_000
#: Bytes of text in a partition of the files, as far as the session's number of partitions isn't larger.
PARTITION_BYTES = 256 << 20
#: Word pieces whose ids a worker remembers; once it has so many it learns no more, and the frequent ones come early.
KNOWN_PIECES = 300_000
#: Bytes of text encoded at a time, a longer document by itself.
SPAN_BYTES = 2_000_000
#: A span with a new piece of more bytes isn't remembered.
LONG_PIECE = 400
#: Marks that are no part of a word and never begin a contraction.
MARKS = ".,;:!?|*#$%&"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct word piece encoded once.

    The byte-level pre-tokenizer always parts a text between a character that isn't white space
    and a space after it, so a text's ids are those of its pieces between such places. It also parts a run of
    letters from marks behind it, so the library's model takes the letters of such a piece alone.
    A piece that ends in white space doesn't part there; a text with one is encoded as a whole.

    With ``literal``, a special token's wording in a text is ordinary letters; without, it gets the
    token's id, the library's default. A text with an added token's wording is encoded as a whole,
    and so is every text where the tokenizer normalises it or parts it by another rule.
    """

    def __init__(self, path: str, literal: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (literal and t.special)]
        self.top = max(self.tokenizer.get_vocab().values(), default=0)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.parted = self._parts_at_spaces(json.loads(self.tokenizer.to_str()))
        self.letters = _byte_letters()
        #: Known units by number, and by number where a unit's ids are in ``flat`` and how many. A unit is a run of letters, or
        #: any other piece, with a space before it, or, after a space as their sign, marks without one. Number 0 is no unit.
        self.known = pa.array([""], pa.string())
        self.flat, self.start, self.size = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    @staticmethod
    def _parts_at_spaces(how: dict) -> bool:
        """Whether a piece's ids depend on the piece alone: the texts are taken as they are, and parted by the byte-level pattern."""
        before, model = how.get("pre_tokenizer") or {}, how.get("model") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        return how.get("normalizer") is None and plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))

    @classmethod
    def shared(cls, path: str, literal: bool = True) -> Encoder:
        """This worker's encoder: it outlives a task, so later tasks of a reused worker know its pieces."""
        state = sys.modules.setdefault("_corvina_worker", types.ModuleType("_corvina_worker"))
        encoders = state.__dict__.setdefault("encoders", {})
        if (path, literal) not in encoders:
            encoders[path, literal] = cls(path, literal)
        return encoders[path, literal]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new units one after the other, and how many each has; ``plain`` says which are runs of letters.

        A run of letters has a space before it, and so has a piece for the library; marks have only their sign.
        """
        tokenize, letter, space = self.model.tokenize, self.letters.__getitem__, self.letters[0x20]
        library = iter(self._ids([" " + units[i] for i in np.flatnonzero(~plain) if units[i][0] != " "]))
        got = []
        for w, known in zip(units, plain.tolist()):
            if not known and w[0] != " ":
                got.append(next(library).tolist())
            else:
                head, w = (space, w) if known else ("", w[1:])
                got.append([t.id for t in tokenize(head + (w if w.isascii() else "".join(map(letter, w.encode()))))])
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum())), sizes

    def _remember(self, units: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        n = min(len(units), KNOWN_PIECES - len(self.known))
        if n > 0:
            self.known = pa.concat_arrays([self.known, units.slice(0, n)])
            self.start = np.append(self.start, len(self.flat) + np.cumsum(sizes[:n]) - sizes[:n])
            self.size = np.append(self.size, sizes[:n])
            self.flat = np.append(self.flat, ids[: int(sizes[:n].sum())])

    def _units(self, pieces: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the wanted pieces one after the other, and how many each of all pieces has."""
        core = pc.utf8_rtrim(pieces, MARKS)
        plain = pc.utf8_is_alpha(core).to_numpy(zero_copy_only=False)
        marked = plain & pc.not_equal(core, pieces).to_numpy(zero_copy_only=False)
        units = pc.if_else(pa.array(plain), core, pieces).filter(pa.array(wanted))
        some = marked & wanted
        tails, tail = _tails(pieces.filter(pa.array(some)), core.filter(pa.array(some)))
        both = pa.concat_arrays([units, pa.array(tails, units.type)]).dictionary_encode()
        names, at = both.dictionary, both.indices.to_numpy()
        letters = np.zeros(len(names), bool)
        letters[at[: len(units)]] = plain[wanted]
        number = pc.fill_null(pc.index_in(names, value_set=self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(number < 0)
        words = names.take(pa.array(new))
        ids, sizes = self._learn(words.to_pylist(), letters[new])
        number[new] = len(self.known) + np.arange(len(new))
        starts = np.concatenate((self.start, len(self.flat) + np.cumsum(sizes) - sizes))
        size = np.concatenate((self.size, sizes))
        flat = np.concatenate((self.flat, ids))
        # Two places for each wanted piece: its letters or all of it, and the marks behind.
        places = np.zeros((len(units), 2), np.int64)
        places[:, 0] = number[at[: len(units)]]
        places[marked[wanted], 1] = number[at[len(units) :]][tail]
        out, lengths = _gather(flat, starts, size, places.ravel())
        each = np.zeros(len(pieces), np.int64)
        each[wanted] = lengths.reshape(-1, 2).sum(axis=1)
        if len(words) and pc.max(pc.binary_length(words)).as_py() <= LONG_PIECE:
            self._remember(words, ids, sizes)
        return out, each

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has; a null text has none."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if not self.parted:
            own = self._ids(texts.to_pylist())
            return np.concatenate(own), np.array([len(x) for x in own], np.int64)
        parts = pc.split_pattern(texts, " ")
        first = parts.offsets.to_numpy().astype(np.int64)
        count, first = np.diff(first), first[:-1] - first[0]
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        code, pieces = coded.indices.to_numpy().copy(), coded.dictionary
        # A piece is tied to what follows it if it is empty or ends in white space.
        tied = (pc.equal(pc.utf8_rtrim_whitespace(pieces), pieces).to_numpy(zero_copy_only=False) ^ True) | (pc.binary_length(pieces).to_numpy() == 0)
        inner = np.ones(len(code), bool)
        inner[first] = False
        whole = np.logical_or.reduceat(tied[code] & (inner | np.repeat(count > 1, count)), first)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        used = inner & ~np.repeat(whole, count)
        wanted = np.zeros(len(pieces), bool)
        wanted[code[used]] = True
        ids, sizes = self._units(pieces, wanted)
        # The first piece of a text has no space before it; it or the whole text is encoded by itself.
        alone = pc.if_else(pa.array(whole), texts, flat.take(pa.array(first)))
        own = self._ids(alone.to_pylist())
        own_sizes = np.array([len(x) for x in own], np.int64)
        starts = np.concatenate((np.cumsum(sizes) - sizes, len(ids) + np.cumsum(own_sizes) - own_sizes))
        code[~used] = -1
        code[first] = len(pieces) + np.arange(n)
        out, lengths = _gather(np.concatenate((ids, *own)), np.append(starts, 0), np.concatenate((sizes, own_sizes, [0])), code)
        return out, np.add.reduceat(lengths, first)


def _tails(pieces: pa.Array, cores: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct marks behind the cores, each after a space, and which of them each piece has."""
    n = pc.subtract(pc.binary_length(pieces), pc.binary_length(cores)).to_numpy()
    tails = [" " + m for m in MARKS]
    if not len(pieces):
        return tails, np.empty(0, np.int64)
    # A mark is one byte, so the last byte says which it is.
    table = np.zeros(256, np.int64)
    table[list(MARKS.encode())] = np.arange(len(MARKS))
    ends = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, 4 * pieces.offset)[1:]
    which = table[np.frombuffer(pieces.buffers()[2], np.uint8)[ends - 1]]
    several = np.flatnonzero(n > 1)
    if len(several):
        longer = [" " + w[-k:] for w, k in zip(pieces.take(pa.array(several)).to_pylist(), n[several].tolist())]
        place = {w: i for i, w in enumerate(dict.fromkeys(longer), len(tails))}
        which[several] = [place[w] for w in longer]
        tails += place
    return tails, which


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` that ``which`` names, one after the other, and their sizes."""
    size = sizes[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts[which] - (ends - size)).astype(kind), size)
    return flat[at], size


def spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """From where to where to encode at a time: as many texts as SPAN_BYTES hold, one at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SPAN_BYTES, "right")))
        yield a, b
        a = b


@dataclass
class WaveletMatrix:
    """Bit planes from the highest bit down; ``zeros`` counts the 0 bits of each; ``ranks`` the 1 bits before every 512th place."""

    n: int
    planes: np.ndarray  # uint8, depth x ceil(n / 8)
    zeros: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, depth: int) -> WaveletMatrix:
        n = len(ids)
        planes = np.zeros((depth, -(-n // 8)), np.uint8)
        zeros = np.zeros(depth, np.int64)
        ranks = np.zeros((depth, n // 512 + 1), np.uint32)
        for k in range(depth):
            bits = (ids & ids.dtype.type(1 << (depth - 1 - k))).astype(bool)
            planes[k] = np.packbits(bits)
            ones = np.bitwise_count(planes[k, : n // 512 * 64].view(np.uint64)).reshape(-1, 8).sum(axis=1)
            ranks[k, 1:] = np.cumsum(ones)
            # Places picked by number go several times faster than by a mask.
            low = ids.take(np.flatnonzero(~bits))
            zeros[k] = len(low)
            ids = np.concatenate((low, ids.take(np.flatnonzero(bits))))
        return cls(n, planes, zeros, ranks)

    def rank(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        at = i // 512
        return int(self.ranks[k, at]) + int(np.unpackbits(self.planes[k, at * 64 : -(-i // 8)])[: i - at * 512].sum())

    def select(self, k: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit of that value in plane k."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            r = self.rank(k, mid + 1)
            if (r if bit else mid + 1 - r) > j:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The id at place i."""
        out = 0
        for k in range(len(self.planes)):
            bit = int(self.planes[k, i // 8] >> (7 - i % 8)) & 1
            r = self.rank(k, i)
            i = int(self.zeros[k]) + r if bit else i - r
            out = out << 1 | bit
        return out

    def _narrow(self, token: int, a: int, b: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            ra, rb = self.rank(k, a), self.rank(k, b)
            a, b = (int(self.zeros[k]) + ra, int(self.zeros[k]) + rb) if token >> (len(self.planes) - 1 - k) & 1 else (a - ra, b - rb)
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of the id in places a to b, b excluded."""
        low, high = self._narrow(token, a, self.n if b is None else b)
        return high - low

    def locate(self, token: int, a: int = 0, b: int | None = None) -> list[int]:
        """Places of the id in a to b, b excluded."""
        low, high = self._narrow(token, a, self.n if b is None else b)
        out = []
        for i in range(low, high):
            for k in range(len(self.planes) - 1, -1, -1):
                bit = token >> (len(self.planes) - 1 - k) & 1
                i = self.select(k, bit, i - int(self.zeros[k]) if bit else i)
            out.append(i)
        return out

    def decode(self) -> np.ndarray:
        """All ids, rebuilt from the lowest plane up."""
        depth = len(self.planes)
        ids = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for k in range(depth - 1, -1, -1):
            bits = np.unpackbits(self.planes[k], count=self.n).view(bool)
            up = np.empty_like(ids)
            up[np.flatnonzero(~bits)] = ids[: self.zeros[k]]
            up[np.flatnonzero(bits)] = ids[self.zeros[k] :] | ids.dtype.type(1 << (depth - 1 - k))
            ids = up
        return ids

    def tobytes(self) -> bytes:
        return b"".join((np.array([self.n, len(self.planes)], "<i8"), self.zeros.astype("<i8"), self.ranks.astype("<u4"), self.planes))

    @classmethod
    def frombytes(cls, data: bytes) -> WaveletMatrix:
        n, depth = (int(x) for x in np.frombuffer(data, "<i8", 2))
        at = 16
        zeros = np.frombuffer(data, "<i8", depth, at)
        at += 8 * depth
        ranks = np.frombuffer(data, "<u4", depth * (n // 512 + 1), at).reshape(depth, -1)
        at += 4 * ranks.size
        return cls(n, np.frombuffer(data, np.uint8, depth * -(-n // 8), at).reshape(depth, -1), zeros, ranks)


def _writer(path: str, end: int, depth: int, block_tokens: int, literal: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encoder = Encoder.shared(path, literal)
        if max(encoder.top, end) >> depth:
            raise ValueError(f"ids up to {max(encoder.top, end)} need more than {depth} bits")
        ids: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, tokens, held, seq
            block = WaveletMatrix.build(np.concatenate(tokens), depth).tobytes()
            keys, n = pa.concat_arrays(ids), np.concatenate(lengths)
            of = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([held], pa.int64()), of(keys), of(pa.array(n, pa.int64())), pa.array([block], pa.binary())]
            ids, lengths, tokens, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "n_tokens", "ids", "lengths", "block"])

        kind = np.uint16 if depth <= 16 else np.uint32
        for batch in batches:
            for a, b in spans(batch.column(1)):
                got, size = encoder.encode(batch.column(1).slice(a, b - a))
                stops = np.cumsum(size + 1)
                out = np.full(stops[-1], end, kind)
                word = np.ones(stops[-1], bool)
                word[stops - 1] = False
                out[word] = got
                at = 0
                # Blocks end with the document that fills them.
                while at < b - a:
                    before = int(stops[at - 1]) if at else 0
                    to = min(b - a, int(np.searchsorted(stops, before + block_tokens - held, "left")) + 1)
                    ids.append(batch.column(0).slice(a + at, to - at))
                    lengths.append(size[at:to] + 1)
                    tokens.append(out[before : stops[to - 1]])
                    held += int(stops[to - 1]) - before
                    at = to
                    if held >= block_tokens:
                        yield flush()
        if lengths:
            yield flush()
        give_back()

    return run


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end: int = 0, depth: int = 16, partitions: int | None = None, block_tokens: int = BLOCK_TOKENS, literal: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text of ``docs``, and ``end`` after each, as wavelet blocks under ``path``.

    Rows are in ascending order of the id, null first, then of the text's hash; a null text is empty. ``depth``
    is the number of bits of the largest id; a vocabulary that needs more is an error. A special token's wording
    gets its id unless ``literal``. Files are Parquet with one zstd-compressed record a block. Without
    ``partitions`` the text's bytes decide their number; rows that repeat an id are dealt over several too.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mine = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(mine.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PARTITION_BYTES))
    # Equal rows are told apart by where they are read, so that they needn't meet in one partition.
    order = ["id", "hash", "at"]
    parted = mine.withColumn("hash", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    parted = parted.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")
    kind = mine.schema["id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("block", T.BinaryType())])
    parted.mapInArrow(_writer(tokenizer, end, depth, block_tokens, literal), schema).write.option("compression", "zstd").parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            part, seq = batch.column(0)[i], batch.column(1)[i]
            ids, lengths = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
            tokens = WaveletMatrix.frombytes(batch.column(4)[i].as_py()).decode()
            stops = np.cumsum(lengths)
            crc = [zlib.crc32(tokens[b - n : b].astype("<u4").tobytes()) for b, n in zip(stops, lengths)]
            m = len(lengths)
            yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * m, pa.int32()), pa.array([seq.as_py()] * m, pa.int32()), ids, pa.array(stops - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], ["part", "seq", "id", "within", "n_tokens", "ids_crc32"])
    give_back()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per written document: id, start (tokens of all documents before it), n_tokens, ids_crc32, decoded from the files."""
    files = spark.read.parquet(path)
    kind = files.schema["ids"].dataType.elementType.simpleString()
    # Two small running sums, over the partitions and over each one's blocks, place every block.
    blocks = files.select("part", "seq", "n_tokens")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before("n", Window.orderBy("part")).alias("base"))
    blocks = blocks.join(parts, "part").select("part", "seq", (F.col("base") + before("n_tokens", Window.partitionBy("part").orderBy("seq"))).alias("base"))
    docs = files.select("part", "seq", "ids", "lengths", "block").mapInArrow(_reader, f"part int, seq int, id {kind}, within long, n_tokens long, ids_crc32 long")
    return docs.join(blocks, ["part", "seq"]).select("id", (F.col("base") + F.col("within")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def _asker(ask):
    """Runs ``ask`` on each block's matrix; it gives the places in the block and their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places, tokens = ask(WaveletMatrix.frombytes(batch.column(3)[i].as_py()), batch.column(2)[i].as_py())
                m = len(places)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).take(pa.array([0] * m, pa.int32())), batch.column(1).slice(i, 1).take(pa.array([0] * m, pa.int32())), pa.array(places, pa.int64()), pa.array(tokens, pa.int64())], ["part", "seq", "within", "token"])

    return run


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, within, token): every place of an id in the written blocks, by select on the bit planes alone."""
    files = spark.read.parquet(path).select("part", "seq", F.lit(0).cast("long").alias("at"), "block")
    return files.mapInArrow(_asker(lambda w, _: ((p := w.locate(token)), [token] * len(p))), "part int, seq int, within long, token long")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, n): how often an id occurs in each written block, by rank on the bit planes alone."""
    files = spark.read.parquet(path).select("part", "seq", F.lit(0).cast("long").alias("at"), "block")
    return files.mapInArrow(_asker(lambda w, _: ([w.count(token)], [token])), "part int, seq int, within long, token long").select("part", "seq", F.col("within").alias("n"))


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """(part, seq, within, token) of the places (part, seq, within), read by rank without decoding a block."""
    files = spark.read.parquet(path).select("part", "seq", "block").join(places, ["part", "seq"]).select("part", "seq", F.col("within").cast("long").alias("at"), "block")
    return files.mapInArrow(_asker(lambda w, i: ([i], [w.access(i)]) if i is not None and 0 <= i < w.n else ([], [])), "part int, seq int, within long, token long")


def encode_and_read(docs: DataFrame, **how) -> DataFrame:
    """``docs`` written to a new folder in the shared checkpoint folder, and read back."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, **how)
    return read_tokens(spark, path).withColumnRenamed("id", "doc_id")


def byte_bpe() -> str:
    """The file of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the written files: where its ids start, how many they are, their CRC."""
    return encode_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer=byte_bpe())


QUERIES = {"op7_token_store": op7_token_store}
ORACLES: dict[str, str] = {}
