"""Token counts and token ids of whole texts, with the public tokenizer libraries.

The encoder is called on batches of distinct pieces, balanced by bytes. Texts are cut at
safe boundaries only: for a byte-level vocabulary without normalizer, the pre-tokenizer
starts a new token at a single blank or line break between two solid characters wherever
it stands, so the pieces encoded alone give exactly the ids of the whole. Equal pieces
are encoded once; a bounded table of known pieces is kept by each Python worker. Other
vocabularies (with a normalizer, or sentencepiece) get their texts whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed
from paytide.llm.text import chunk_hashes, row_slices, utf8

#: Bytes of text per encoder batch.
BATCH_BYTES = 4 << 20
#: Pieces a worker remembers at most; beyond that its table starts afresh.
KNOWN_PIECES = 2_000_000

# A byte that can stand on both sides of a boundary: ASCII other than white space and
# control characters, or the first byte of a character that is surely not white space
# (C2, E1, E2 and E3 begin the multi-byte blanks).
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_OPENS = _SOLID.copy()
_OPENS[0xC3:0xF5] = True
_OPENS[[0xE1, 0xE2, 0xE3]] = False


def vocabulary_path(vocabulary: str) -> str:
    """A vocabulary file's place: an existing path as it is, else a public file's name."""
    if os.path.exists(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: every row start, and every boundary that is surely safe."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        opens, solid = _OPENS[data], _SOLID[data]
        begins[1 : len(data) - 1] = (data[1:-1] == 0x20) & opens[2:]
        breaks = np.flatnonzero((data[1:-1] == 0x0A) & solid[:-2] & opens[2:]) + 1
        begins[breaks] = True
        begins[breaks + 1] = True
    begins[offsets] = True
    return np.flatnonzero(begins)


class Encoder:
    """One vocabulary in one worker. `lengths_only` skips keeping the ids."""

    def __init__(self, vocabulary: str, lengths_only: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = vocabulary_path(vocabulary)
        self.lengths_only = lengths_only
        self.cuttable = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
            self._count = lambda texts: [len(x) for x in self._encode(texts)]
        else:
            import tokenizers

            model = tokenizers.Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            run = getattr(model, "encode_batch_fast", model.encode_batch)
            self._encode = lambda texts: [x.ids for x in run(texts, add_special_tokens=False)]
            self._count = lambda texts: [len(x) for x in run(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                self.cuttable = _byte_level(json.load(f))
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)
        self._length = np.zeros(0, np.int64)
        self._begin = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token count of every row, and the ids of all rows in order (if kept)."""
        if not self.cuttable:
            return self._whole(data, offsets)
        cuts = safe_cuts(data, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        if len(starts) == 0:
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        hashes = chunk_hashes(data, starts, ends)
        which, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        at = self._places(data, starts, ends, distinct, first)
        lengths = self._length[at][which]
        total = np.concatenate([[0], np.cumsum(lengths)])
        rows = total[np.searchsorted(starts, offsets)]
        ids = np.zeros(0, np.uint32)
        if not self.lengths_only:
            begin = self._begin[at][which]
            ids = self._pool[np.repeat(begin - total[:-1], lengths) + np.arange(total[-1])]
        return np.diff(rows), ids

    def _places(self, data, starts, ends, distinct, first) -> np.ndarray:
        """Where the distinct pieces stand in the table, after encoding the new ones."""
        if len(self._known) > KNOWN_PIECES:
            self._forget()
        at = np.searchsorted(self._known, distinct)
        at[at == len(self._known)] = 0
        new = self._known[at] != distinct if len(self._known) else np.ones(len(distinct), bool)
        if new.any():
            raw = data.tobytes()
            pieces = [
                raw[s:e].decode("utf-8", "replace")
                for s, e in zip(starts[first[new]], ends[first[new]], strict=True)
            ]
            counts, ids = self._run(pieces)
            begin = len(self._pool) + np.cumsum(counts) - counts
            self._pool = np.concatenate([self._pool, ids])
            order = np.argsort(distinct[new])
            put = np.searchsorted(self._known, distinct[new][order])
            self._known = np.insert(self._known, put, distinct[new][order])
            self._length = np.insert(self._length, put, counts[order])
            self._begin = np.insert(self._begin, put, begin[order])
            at = np.searchsorted(self._known, distinct)
        return at

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.lengths_only:
            return np.array(self._count(texts), np.int64), np.zeros(0, np.uint32)
        lists = self._encode(texts)
        counts = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum()))
        return counts, flat

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        return self._run(
            [
                raw[s:e].decode("utf-8", "replace")
                for s, e in zip(offsets[:-1], offsets[1:], strict=True)
            ]
        )


def _byte_level(spec: dict) -> bool:
    """Whether the cuts of `safe_cuts` hold for this vocabulary."""
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and spec.get("post_processor") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or set(t["content"]) & set(" \n")
            for t in spec.get("added_tokens", [])
        )
    )


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str, lengths_only: bool) -> Encoder:
    """The worker's encoder; loaded once and reused by later tasks of the worker."""
    key = (vocabulary, lengths_only)
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary, lengths_only)
    return _encoders[key]


def encoded_slices(
    column: pa.Array, vocabulary: str, lengths_only: bool
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes per row, tokens per row, ids), slice by slice."""
    run = encoder(vocabulary, lengths_only)
    data, offsets = utf8(column)
    for lo, hi in row_slices(offsets, BATCH_BYTES):
        at = offsets[lo : hi + 1]
        part = data[at[0] : at[-1]]
        counts, ids = _in_pieces(run, part, at - at[0])
        yield lo, hi, np.diff(at), counts, ids


def _in_pieces(run: Encoder, data: np.ndarray, offsets: np.ndarray):
    """A single text longer than a batch is encoded piece by piece."""
    if len(data) <= 2 * BATCH_BYTES or not run.cuttable or len(offsets) > 2:
        return run.batch(data, offsets)
    cuts = safe_cuts(data, offsets)
    total, kept, begin = 0, [], 0
    while begin < len(data):
        upto = int(np.searchsorted(cuts, begin + BATCH_BYTES, side="right")) - 1
        end = int(cuts[upto])
        if end <= begin:  # no safe boundary within a batch: up to the next one
            end = int(cuts[upto + 1])
        counts, ids = run.batch(data[begin:end], np.array([0, end - begin]))
        total, begin = total + int(counts[0]), end
        kept.append(ids)
    return np.array([total]), np.concatenate(kept)


def token_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    limit: int = 512,
) -> DataFrame:
    """Tokens of every whole text: `(doc_id, n_bytes, n_tokens, over_limit)`.

    One row per input row, repeated ids included; a null text counts as empty (0, 0,
    false). No special tokens are added; strings of special tokens inside a text are
    handled as the library does by default. There is no shuffle: each task encodes what
    it scans and returns lengths only. Other columns of `df` are not read.
    """

    def count(batches):
        for batch in batches:
            n_bytes, n_tokens = [], []
            for _, _, size, tokens, _ in encoded_slices(batch["text"], vocabulary, True):
                n_bytes.append(size)
                n_tokens.append(tokens)
            joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_bytes, n_tokens)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(joined[0], pa.int64()), pa.array(joined[1], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = narrowed(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
