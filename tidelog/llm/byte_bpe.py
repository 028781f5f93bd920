"""Byte-level BPE encoding and decoding through a sentencepiece BPE model.

The model is serialised directly from a rank file: every byte string becomes a
piece by the usual byte-to-printable-character map, its score is the negative
rank (so the lowest rank merges first, as the ranks demand), and the
normaliser is the identity. Text is cut into pre-tokens by the tokenizer's
pattern; a pre-token that is itself in the vocabulary is that id, any other is
encoded by the model. Decoding is the inverse map from ids to byte strings.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Kept, lean, small_batches

# Entries of a task's pre-token cache (some 200 bytes each); it is emptied beyond that.
CACHE_ENTRIES = 200_000
LONG_TEXT = 1_000_000


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself, or the next code point from 256 on."""
    own = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    extra = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(extra)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for piece, rank in pairs:
        out[int(rank)] = base64.b64decode(piece)
    return out


def model_bytes(vocab: list[bytes]) -> bytes:
    """The serialised sentencepiece model; piece id = rank, the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    alphabet = byte_alphabet()
    m = pb.ModelProto()
    for rank, piece in enumerate(vocab):
        m.pieces.add(piece="".join(map(alphabet.__getitem__, piece)), score=-float(rank), type=1)
    m.pieces.add(piece="⁇unknown⁇", score=-float(len(vocab)), type=2)
    t = m.trainer_spec
    t.model_type, t.vocab_size, t.byte_fallback = 2, len(m.pieces), False
    t.unk_piece, t.unk_id, t.bos_id, t.eos_id, t.pad_id = "⁇unknown⁇", len(vocab), -1, -1, -1
    n = m.normalizer_spec
    n.name, n.precompiled_charsmap = "identity", b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = n.escape_whitespaces = False
    return m.SerializeToString()


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, vocab: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.pattern = regex.compile(pattern)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.vocab = vocab
        self.whole = {p.decode(): np.uint32(i).tobytes() for i, p in enumerate(vocab) if _is_text(p)}
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self.cache = dict(self.whole)

    def _learn(self, missing: list[str]) -> None:
        mapped = [w.encode().decode("latin-1").translate(self.alphabet) for w in missing]
        for w, ids in zip(missing, self.processor.encode(mapped, num_threads=1)):
            self.cache[w] = np.asarray(ids, dtype="<u4").tobytes()

    def _chunk(self, tokens: list[str]) -> bytes:
        missing = [w for w in set(tokens) if w not in self.cache]
        if missing:
            if len(self.cache) + len(missing) > CACHE_ENTRIES + len(self.whole):
                self.cache = dict(self.whole)
                missing = [w for w in set(tokens) if w not in self.cache]
            self._learn(missing)
        return b"".join(map(self.cache.__getitem__, tokens))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) <= LONG_TEXT:
            return self._chunk(self.pattern.findall(text))
        tokens = (m.group() for m in self.pattern.finditer(text))
        parts = []
        while chunk := list(islice(tokens, LONG_TEXT // 8)):
            parts.append(self._chunk(chunk))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _is_text(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:
        return False
    return True


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str],
                  text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``n_tokens``, ``ids`` (binary, little-endian uint32) and
    ``decoded`` (binary: the bytes that the ids stand for).

    A null or empty text has no tokens; repeated rows are encoded each; an
    empty table gives an empty result; columns not named in ``keep`` are not
    read. Special tokens are ordinary text. The model and vocabulary (about
    1 MB, fixed by the tokenizer) travel to the workers as one broadcast.
    """
    small_batches(docs.sparkSession)
    vocab = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((model_bytes(vocab), vocab, pattern))
    kept = Kept(docs, keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(*shared.value)
        for batch in batches:
            texts = batch.pop("__text")
            ids = [codec.encode(t) if t else b"" for t in texts]
            batch["__n"] = np.fromiter((len(x) // 4 for x in ids), dtype=np.int64, count=len(ids))
            batch["__ids"] = ids
            batch["__decoded"] = [codec.decode(x) for x in ids]
            yield batch

    df = docs.select(*kept.sent, F.col(text_col).cast("string").alias("__text")) \
        .mapInPandas(lean(run), kept.schema("__n bigint, __ids binary, __decoded binary"))
    return kept.back(df).withColumnsRenamed({"__n": "n_tokens", "__ids": "ids", "__decoded": "decoded"})


def ids_array(df: DataFrame, ids_col: str = "ids", out: str = "token_ids") -> DataFrame:
    """The ids as ``array<int>`` (ids fit 31 bits), from the binary column, on the JVM."""
    h = F.hex(ids_col)
    n = (F.octet_length(ids_col) / F.lit(4)).cast("int")
    nibble = lambda i, at: F.substr(h, i * F.lit(8) + F.lit(at), F.lit(2))
    return df.withColumn(out, F.when(n == 0, F.array().cast("array<int>")).otherwise(F.transform(
        F.sequence(F.lit(0), n - F.lit(1)),
        lambda i: F.conv(F.concat(nibble(i, 7), nibble(i, 5), nibble(i, 3), nibble(i, 1)), 16, 10).cast("int"))))
