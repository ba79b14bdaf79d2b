"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed once on the driver (``spm_model``). From it the normaliser, the white-space mark, the unigram
scores or the BPE merges, and byte fallback are rebuilt. ``build`` gives the complete tokenizer. The batch path
normalises a text, cuts it where no piece can reach across (in front of a mark that follows another character, if the
vocabulary has no piece with a mark there), and encodes every distinct part once per task, multithreaded.

Parity is verified on the way: each distinct part is also encoded by the sentencepiece library. Where the two differ (BPE
ties between equal pieces inside repetitive strings), the library's own ids are used and the row's ``parity`` is false.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm import spm_model
from paylens.llm.common import pick, small_batches
from paylens.llm.spm_model import BPE, BYTE, CONTROL, MARK, NORMAL, UNIGRAM, UNUSED, USER_DEFINED, Model

CACHE_PARTS = 400_000
ROWS_AT_ONCE = 512
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def merges(model: Model) -> list[tuple[str, str]]:
    """BPE merges from piece scores: every cut of a piece into two pieces, best score first."""
    score = {p: s for p, s, t in zip(model.pieces, model.scores, model.types, strict=True) if t in (NORMAL, USER_DEFINED)}
    number = {p: k for k, p in enumerate(model.pieces)}
    cuts = [(-s, number[p[:at]], number[p[at:]], p[:at], p[at:]) for p, s in score.items() for at in range(1, len(p))
            if p[:at] in score and p[at:] in score]
    return [(left, right) for *_, left, right in sorted(cuts)]


def core(model: Model):
    """The tokenizers model: unigram or BPE with byte fallback."""
    from tokenizers import models

    if UNUSED in model.types:
        raise ValueError("models with unused pieces are not supported")
    if model.model_type == UNIGRAM:
        return models.Unigram(list(zip(model.pieces, model.scores, strict=True)), model.unk_id, model.byte_fallback)
    if model.model_type == BPE:
        return models.BPE({p: k for k, p in enumerate(model.pieces)}, merges(model), unk_token=model.pieces[model.unk_id],
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    raise ValueError(f"model type {model.model_type} is not supported")


def build(model: Model):
    """The complete tokenizer with normaliser and decoder."""
    from tokenizers import Regex, Tokenizer, decoders, normalizers

    tokenizer = Tokenizer(core(model))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    strip = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


@dataclass
class Codec:
    """What tasks need; built on the driver, unpacked by ``open``."""

    proto: bytes
    model: Model
    threads: int = 2

    def open(self) -> Coder:
        return Coder(self)


def load(path: str = spm_model.VOCABULARY, threads: int = 2) -> Codec:
    """Read a model file on the driver."""
    with open(path, "rb") as file:
        proto = file.read()
    return Codec(proto, spm_model.parse(proto), threads)


class Coder:
    def __init__(self, codec: Codec) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(codec.threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if codec.threads > 1 else "false"
        import sentencepiece
        from tokenizers import Tokenizer, normalizers

        model = self.model = codec.model
        self.threads = codec.threads
        self.fast = Tokenizer(core(model))
        self.exact = sentencepiece.SentencePieceProcessor(model_proto=codec.proto)
        self.precompiled = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        self.separable = not model.suffix_mark and not any(
            MARK in p.lstrip(MARK) for p, t in zip(model.pieces, model.types, strict=True) if t in (NORMAL, USER_DEFINED)
        ) and USER_DEFINED not in model.types
        self.parts: dict[str, bytes] = {}
        self.odd: set[str] = set()
        self.bytes = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else
                      p.replace(MARK, " ").encode() if t != spm_model.UNKNOWN else " ⁇ ".encode()
                      for p, t in zip(model.pieces, model.types, strict=True)]

    def normalise(self, text: str) -> str:
        if self.precompiled is not None:
            text = self.precompiled.normalize_str(text)
        if self.model.remove_extra_whitespaces:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if text and self.model.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _by_library(self, parts: list[str]) -> list[list[int] | None]:
        """The sentencepiece library's ids of every part; it has no way to give those of a lone mark."""
        prefixed = self.model.add_dummy_prefix
        plain = [p.replace(MARK, " ") for p in parts]
        ids = self.exact.encode([p[1:] if prefixed and p[0] == " " else p for p in plain], num_threads=self.threads)
        return [None if prefixed and p == " " else i for p, i in zip(plain, ids, strict=True)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of every text, and whether both libraries agree on all its parts."""
        whole = [self.normalise(t) for t in texts]
        cut = [_PART.findall(t) if self.separable else [t] if t else [] for t in whole]
        wanted = set(chain.from_iterable(cut))
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
            self.odd.clear()
        if new := [p for p in wanted if p not in self.parts]:
            coded = self.fast.encode_batch_fast(new, add_special_tokens=False)
            for part, fast, exact in zip(new, coded, self._by_library(new), strict=True):
                ids = fast.ids
                if exact is not None and ids != exact:
                    self.odd.add(part)
                    ids = exact
                self.parts[part] = array("i", ids).tobytes()
        out = []
        for parts in cut:
            ids = np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), np.int32)
            out.append((ids, not self.odd or self.odd.isdisjoint(parts)))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: byte pieces join to characters, broken ones become U+FFFD, the dummy prefix goes."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.add_dummy_prefix and text.startswith(" ") else text

    def plain(self, text: str) -> str:
        """What decoding must give back: the normalised text without marks."""
        whole = self.normalise(text).replace(MARK, " ")
        return whole[1:] if self.model.add_dummy_prefix and whole.startswith(" ") else whole


def encode(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids, parity, round_trip.

    A null or empty text has no ids. Texts are encoded whole, however long. ``parity`` is true if both libraries give the
    same ids; ``round_trip`` if decoding the ids gives the (normalised) text, which fails only for texts that hold the
    mark itself. Control pieces in a text are ordinary characters. Repeated rows give repeated results; an empty table
    gives an empty one; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value.open()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                texts = [t or "" for t in some.column(1).to_pylist()]
                coded = coder.encode(texts)
                ids = [i for i, _ in coded]
                sizes = np.array([len(i) for i in ids], np.int64)
                back = [coder.decode(i.tolist()) == coder.plain(t) for i, t in zip(ids, texts, strict=True)]
                offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32)),
                     pa.array([p for _, p in coded]), pa.array(back)],
                    ["doc_id", "n_tokens", "ids", "parity", "round_trip"])

    thin = small_batches(pick(docs, doc_id=doc_id, text=text))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, codec: Codec, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of encoded rows; null ids count as none, an id outside the vocabulary is an error."""
    sent = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value.open()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([coder.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])

    thin = small_batches(pick(encoded, doc_id=doc_id, ids=ids))
    return thin.mapInArrow(run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, text string")
