"""SentencePiece encoding with byte spans of the original text, and decoding.

1. Normalisation.  The model's compiled character map (a double array over UTF-8 bytes)
   is searched for the longest prefix at each place of the text; the unit found is
   replaced, a character that no entry begins with stays.  Every normalised byte keeps the
   source byte at which its unit began.  A map without entries leaves all but the spaces,
   and its alignment comes from one cumulative sum.
2. Segmentation.  No piece of a byte-pair model holds the space sign behind another
   character (checked when the model is loaded; other models are segmented in whole), so
   no merge crosses from a word to the next space sign.  Each distinct word goes through
   the library's merges once per worker.
3. Projection.  Running piece lengths over the normalised bytes, looked up in the
   alignment, give each piece its span ``[start, stop)`` of source bytes.  The spans of a
   text follow each other without gap from its first kept byte.  A piece whose bytes all
   come from the inside of a unit has an empty span.

Nothing is shuffled: a text is encoded where it was read, in groups of bounded size.

Defined results: a null or empty text has no pieces; repeated rows and null ids are rows
of their own; an empty table gives an empty result; extra columns are ignored; texts of
any length are encoded in whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_WORDS = 200_000  # words that a worker remembers
GROUP_BYTES = 1 << 21  # texts of about so many bytes are encoded together
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class CharMap:
    """Longest-prefix search in a compiled character map: four bytes of size, the units of
    a double array, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        import numpy as np

        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int]:
        """Replacement of the unit at ``at`` and its length in source bytes."""
        units, found, node = self.units, None, 0
        if units:
            node = _child(units[0])
            for k in range(at, len(raw)):
                node ^= raw[k]
                unit = units[node]
                if unit & 0x800000FF != raw[k]:
                    break
                node ^= _child(unit)
                if unit >> 8 & 1:
                    found = units[node] & 0x7FFFFFFF, k + 1 - at
        if found:
            return self.texts[found[0]:self.texts.index(0, found[0])], found[1]
        first = raw[at]
        size = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return raw[at:at + size], size


def _child(unit: int) -> int:
    return unit >> 10 << ((unit & 512) >> 6)


class PieceEncoder:
    """Ids and source spans by the model whose serialized bytes are ``proto``."""

    def __init__(self, proto: bytes):
        import numpy as np
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        spec, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
        if any(p.type == kind.USER_DEFINED for p in model.pieces) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined pieces and spaces as suffix are not supported")
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = (SPACE if spec.escape_whitespaces else " ").encode()
        self.plain = not self.map.units and not self.squeeze and spec.escape_whitespaces
        self.by_word = model.trainer_spec.model_type == model.trainer_spec.BPE and spec.escape_whitespaces and not any(
            SPACE in p.piece.lstrip(SPACE) for p in model.pieces)
        self.sizes = np.array([1 if p.type == kind.BYTE else len(p.piece.encode()) for p in model.pieces], "i8")
        self.unknown = next((k for k, p in enumerate(model.pieces) if p.type == kind.UNKNOWN), -1)
        # the library's merges alone: the text that it gets is normalised already
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.words: dict[str, tuple[bytes, bytes | None]] = {}

    def normalise(self, raw: bytes):
        """Normalised bytes, and for each of them and their end the source byte where its
        unit begins."""
        import numpy as np

        if not raw:
            return b"", np.zeros(1, "i8")
        if self.plain:
            src = np.frombuffer(raw, "u1")
            width = np.where(src == 32, len(self.space), 1)
            align = np.append(np.repeat(np.arange(len(raw)), width), len(raw))
            head = self.space if self.prefix else b""
            return head + raw.replace(b" ", self.space), np.concatenate((np.zeros(len(head), "i8"), align))
        out, align, at, blank = bytearray(), [], 0, self.squeeze
        while self.squeeze and at < len(raw):
            unit, size = self.map.longest(raw, at)
            if unit != b" ":
                break
            at += size
        if at < len(raw) and self.prefix:
            out += self.space
            align += [at] * len(self.space)
        while at < len(raw):
            unit, size = self.map.longest(raw, at)
            if blank:
                unit = unit.lstrip(b" ")
            if unit:
                blank = self.squeeze and unit.endswith(b" ")
                unit = unit.replace(b" ", self.space)
                out += unit
                align += [at] * len(unit)
            at += size
        align.append(at)
        while self.squeeze and out.endswith(self.space):
            del out[-len(self.space):], align[len(out) + 1:]
        return bytes(out), np.array(align, "i8")

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of new words.  They go through the merges joined, which is
        exact as no merge crosses to a next space sign, and are cut apart by length."""
        import numpy as np

        alone = [w for w in new if w.endswith(SPACE) or not w.startswith(SPACE)]
        if len(new) > 1 and alone:
            for w in alone:
                self._learn([w])
            new = [w for w in new if w not in set(alone)]
        ids = self.merges.encode("".join(new), num_threads=1) if new else []
        if self.unknown in ids:  # their lengths differ: one by one, with the pieces' own texts
            for w in new:
                pieces = self.merges.encode(w, return_type="proto").pieces
                sizes = [len(p.piece.encode()) if p.id == self.unknown else self.sizes[p.id] for p in pieces]
                self.words[w] = np.array([p.id for p in pieces], "<i4").tobytes(), np.array(sizes, "<i8").tobytes()
            return
        raw, done = np.array(ids, "<i4").tobytes(), np.cumsum(self.sizes[ids] if ids else [])
        cuts = 4 * np.searchsorted(done, np.cumsum([len(w.encode()) for w in new]), side="right")
        at = 0
        for w, cut in zip(new, cuts.tolist()):
            self.words[w] = raw[at:cut], None
            at = cut

    def encode(self, texts: list[str | None]) -> list[tuple]:
        """``(ids, starts, stops)`` arrays of each text."""
        import numpy as np

        if len(self.words) > CACHE_WORDS:
            self.words = {}
        words, norms, parts = self.words, [], []
        for t in texts:
            norm, align = self.normalise((t or "").encode())
            s = norm.decode()
            if not self.by_word:
                some = [s] if s else []
            elif self.prefix and self.plain and SPACE * 2 not in s:
                some = [SPACE + w for w in s.split(SPACE)[1:]]
            else:
                some = _CHUNK.findall(s)
            norms.append(align)
            parts.append(some)
            self._learn(list(set(some).difference(words)))
        out = []
        for align, some in zip(norms, parts):
            ids = np.frombuffer(b"".join([words[w][0] for w in some]), "<i4")
            if self.unknown in ids:
                sizes = np.concatenate([np.frombuffer(words[w][1], "<i8") if words[w][1] is not None
                                        else self.sizes[np.frombuffer(words[w][0], "<i4")] for w in some])
            else:
                sizes = self.sizes[ids]
            ends = np.cumsum(sizes)
            out.append((ids, align[ends - sizes].astype("i4"), align[ends].astype("i4")))
        return out


_ENCODERS: dict = {}  # of this worker process


def _encoder(proto: bytes, kind):
    """One encoder or decoder for each model of this worker."""
    key = kind, hash(proto)
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(proto)
    return _ENCODERS[key]


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Slices of neighbouring rows with about ``GROUP_BYTES`` together, or one row."""
    at, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > GROUP_BYTES:
            yield slice(at, k)
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield slice(at, len(sizes))


def _encoded(proto: bytes):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        enc = _encoder(proto, PieceEncoder)
        for b in batches:
            for some in _groups(pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()):
                rows = b.slice(some.start, some.stop - some.start)
                got = enc.encode(rows.column(1).to_pylist())
                offsets = pa.array(np.cumsum([0, *(len(x[0]) for x in got)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[k] for x in got]), pa.int32())) for k in range(3)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *lists], names=["doc_id", "ids", "starts", "stops"])

    return run


def _model_bytes(model: str | bytes | None) -> bytes:
    if isinstance(model, bytes):
        return model
    with open(model or default_model(), "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | bytes | None = None) -> DataFrame:
    """``doc_id, ids, starts, stops``: the pieces of each whole text and their source spans
    in UTF-8 bytes.  ``model`` is a file on the driver or a serialized model (half a
    megabyte, sent with the tasks)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(_model_bytes(model)), "doc_id long, ids array<int>, starts array<int>, stops array<int>")


def _library(proto: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def _decoded(proto: bytes, at: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        lib = _encoder(proto, _library)
        for b in batches:
            ids = b.column(at)
            for some in _groups([8 * (n.as_py() or 0) for n in ids.value_lengths()]):
                rows = b.slice(some.start, some.stop - some.start)
                texts = lib.decode([x or [] for x in rows.column(at).to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(rows.columns) if k != at), pa.array(texts, pa.string())],
                                                 names=[*(n for k, n in enumerate(rows.schema.names) if k != at), "decoded"])

    return run


def decode_pieces(encoded: DataFrame, ids_col: str = "ids", model: str | bytes | None = None) -> DataFrame:
    """The other columns of ``encoded`` and ``decoded``, the text of the ids by the library
    (a null array counts as empty)."""
    left = [f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema if f.name != ids_col]
    return encoded.mapInArrow(_decoded(_model_bytes(model), encoded.columns.index(ids_col)), ", ".join([*left, "decoded string"]))


def piece_digest(encoded: DataFrame, model: str | bytes | None = None) -> DataFrame:
    """Counts and digests of ``encode_pieces``; ``span_bytes`` is the sum of all spans."""
    rows = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.when(F.size("ids") > 0, F.element_at("stops", -1) - F.element_at("starts", 1)).otherwise(0).cast("long").alias("span_bytes"), "ids")
    return decode_pieces(rows, model=model).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "span_bytes")
