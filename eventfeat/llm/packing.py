"""Packing by concatenate and cut.

1. Every task tokenizes its documents and writes them with the running token total inside
   its partition (one written table, so no text is tokenized twice and a lost executor
   costs a re-read).
2. Prefix sums over the partition totals, one row per partition, give every document its
   global offset.  The stream is cut at every multiple of ``length``; a document that
   crosses cuts becomes several boundary records (pieces).

All sequences but the last are full, so padding is below one sequence for any input.

Defined results: a null or empty text is a document of the end id alone; repeated rows
and null ids are documents of their own; an empty table gives an empty result; extra
columns are ignored; a document longer than a sequence is cut freely.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventfeat.llm.common import written

PUNCTUATION = ".,;:!?|#$%&*()[]{}<>-+=/\"_~"
CACHE_WORDS = 300_000  # pieces and odd words that a worker remembers, each
CHUNK = 1 << 23  # bytes of text that a worker encodes at a time
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Remembered(dict):
    """Ids by string, computed at the first use.  Past ``CACHE_WORDS`` strings those of the
    time before the last turnover are forgotten; strings still in use are taken over."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, s: str) -> bytes:
        got = self.old.get(s)
        if got is None:
            got = self.compute(s)
        self[s] = got
        return got

    def turn_over(self) -> None:
        if len(self) > CACHE_WORDS // 2:
            self.old = dict(self)
            self.clear()


class WordEncoder:
    """Ids of texts by a tokenizer whose tokens never cross white space, as little-endian
    16-bit numbers.  The words of many texts are numbered first, so that each distinct word
    is looked up once.  A word of plain Latin letters with punctuation at its end is two
    pieces by the tokenizer's own split rule; its lower-case letters go straight to the merge
    model.  Any other word takes the tokenizer's full path.  Both are remembered."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        size = self.full.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.tokenize = self.full.model.tokenize
        self.packed = [i.to_bytes(2, "little") for i in range(size)]
        self.words, self.pieces = _Remembered(self._word), _Remembered(self._piece)

    def _piece(self, s: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(s)])

    def _word(self, w: str) -> bytes:
        packed = self.packed
        return b"".join([packed[i] for i in self.full.encode(w, add_special_tokens=False).ids])

    def _distinct(self, words):
        """Ids of an Arrow array of words."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def looked_up(found, strings):
            return pa.array([found[s] for s in strings.to_numpy(zero_copy_only=False).tolist()], pa.binary())

        core = pc.utf8_rtrim(words, characters=PUNCTUATION)
        plain = pc.ascii_is_alpha(core)
        letters = pc.ascii_lower(core.filter(plain))
        tails = pc.replace_substring_regex(words.filter(plain), pattern="^[A-Za-z]+", replacement="")
        pieces = pa.concat_arrays([letters, tails]).dictionary_encode()
        ids = looked_up(self.pieces, pieces.dictionary).take(pieces.indices)
        ids = pc.binary_join_element_wise(ids.slice(0, len(letters)), ids.slice(len(letters)), pa.scalar(b""))
        # the plain words first, then the others; each word at its place again
        is_plain = plain.to_numpy(zero_copy_only=False)
        at = np.where(is_plain, np.cumsum(is_plain), len(letters) + np.cumsum(~is_plain)) - 1
        return pa.concat_arrays([ids, looked_up(self.words, words.filter(pc.invert(plain)))]).take(pa.array(at))

    def encode_array(self, texts):
        """Ids of an Arrow array of texts, as an Arrow array of bytes."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(texts):
            return pa.array([], pa.binary())
        self.words.turn_over()
        self.pieces.turn_over()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        numbered = split.flatten().dictionary_encode()
        ids = self._distinct(numbered.dictionary).take(numbered.indices)
        _, starts, data = ids.buffers()
        starts = np.frombuffer(starts, "<i4")[ids.offset:ids.offset + len(ids) + 1]
        ends = split.offsets.to_numpy()
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(starts[ends - ends[0]].tobytes()), data])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        import pyarrow as pa

        return self.encode_array(pa.array(texts, pa.string())).to_pylist()


_ENCODERS: dict[str, WordEncoder] = {}  # of this worker process


def _chunks(texts):
    """(start, length) of stretches of texts of about ``CHUNK`` bytes: bounded memory."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK)) + 1
    edges = [0, *cuts.tolist(), len(sizes)]
    return [(x, y - x) for x, y in zip(edges, edges[1:]) if y > x]


def _tokenized(path: str):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        enc = _ENCODERS.get(path) or _ENCODERS.setdefault(path, WordEncoder(path))
        part, at = TaskContext.get().partitionId(), 0
        end = END_ID.to_bytes(2, "little")
        schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
        for b in batches:
            for k, m in _chunks(b.column(1)):
                some = b.slice(k, m)
                ids = pc.binary_join_element_wise(enc.encode_array(some.column(1)), pa.scalar(end), pa.scalar(b""))
                n = pc.binary_length(ids).to_numpy().astype("i8") // 2
                after = at + np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array(np.full(m, part, "i4")), pa.array(after - n), pa.array(n), ids], schema=schema)
                at = int(after[-1])

    return run


def _cut(length: int):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        for b in batches:
            for k in range(0, b.num_rows, 512):
                some = b.slice(k, 512)
                out = [[] for _ in schema]
                for doc, at, n, raw in zip(*(some.column(c).to_pylist() for c in range(4))):
                    ids, start = np.frombuffer(raw, "<u2").astype("<u4"), 0
                    while start < n:
                        seq, off = divmod(at + start, length)
                        m = min(n - start, length - off)
                        for col, v in zip(out, (doc, start, m, ids[start:start + m].tobytes(), n, seq, off)):
                            col.append(v)
                        start += m
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
         tokenizer: str | None = None) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` holds
    little-endian unsigned 32-bit numbers, the end id closes each document."""
    tokens = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _tokenized(tokenizer or default_tokenizer()), "doc_id long, part int, at long, n long, ids binary"), "tokens")
    totals = tokens.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # one row per input split (16 bytes for each split read): small at any scale
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("at")).alias("at"), "n", "ids")
    return placed.mapInArrow(_cut(length), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def piece_report(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
