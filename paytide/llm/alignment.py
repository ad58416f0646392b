"""Alignment of two tokenizers over a corpus of exact copies.

1. Rows are shuffled by their full text and counted, so that each distinct text is encoded
   and aligned once; its multiplicity weighs its pair counts.
2. Both token sequences of a text cover the same bytes. Where a token of A and one of B end
   at the same byte, the two are linked, and the text is cut into groups there.
3. Links are counted per pair of ids over the corpus, and the highest count of every B id
   is found. The counts go back to the texts, and measures go back to the rows by the
   SHA-256 of the text; texts with many copies travel under a hash of their row's id.

Within a worker a text is cut before single blanks at which both tokenizers surely begin a
new token, and equal pieces are encoded and aligned once.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed, staged
from paytide.llm.text import chunk_hashes, row_slices, utf8
from paytide.llm.tokens import vocabulary_path
from paytide.operators.lookup import attach

SLICE_BYTES = 1 << 19
#: Pieces a worker remembers at most; beyond that its table starts afresh.
KNOWN_PIECES = 1_000_000
#: Pairs of a lookup that is sent to all tasks: 16 bytes each. More of them are joined.
BROADCAST_PAIRS = 1_000_000

_BLANK = 0x20
#: What may stand after a cut: printable ASCII other than the blank.
_OPENS = np.zeros(256, bool)
_OPENS[0x21:0x7F] = True


def byte_level_table() -> dict[str, int]:
    """Byte of every character of a byte-level vocabulary: printable bytes stand for
    themselves, the others for characters from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """Ids of both vocabularies for the pieces a worker has met, found by the piece's hash."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.good = np.zeros(0, bool)
        self.count = [np.zeros(0, np.int64)] * 2
        self.begin = [np.zeros(0, np.int64)] * 2
        self.pool = [np.zeros(0, np.int32)] * 2

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hashes stand, and which of them are not there."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        new = self.hashes[at] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        return at, new

    def add(self, hashes: np.ndarray, good: np.ndarray, counts: list, ids: list) -> None:
        order = np.argsort(hashes)
        put = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, put, hashes[order])
        self.good = np.insert(self.good, put, good[order])
        for v in (0, 1):
            begin = len(self.pool[v]) + np.cumsum(counts[v]) - counts[v]
            self.pool[v] = np.concatenate([self.pool[v], ids[v]])
            self.count[v] = np.insert(self.count[v], put, counts[v][order])
            self.begin[v] = np.insert(self.begin[v], put, begin[order])


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges that begin at `begins`, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


class Tokens:
    """The bytes of every id of a vocabulary, in one buffer."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(x) for x in entries], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_spread(self.begin[ids], self.size[ids])]


class Pair:
    """Both vocabularies in one worker, and the pieces it has encoded."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(vocabulary_path(vocabulary_a))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary_b))
        letters = byte_level_table()
        entries = self.a.get_vocab(with_added_tokens=False)
        own_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for entry, i in entries.items():
            own_a[i] = bytes(letters[c] for c in entry if c in letters)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        own_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.tokens = [Tokens(own_a), Tokens(own_b)]
        #: Ids as decimal text.
        self.digits = Tokens([str(i).encode() for i in range(max(len(own_a), len(own_b)))])
        #: A blank only begins pieces of B, so B never joins what stands on both sides of one.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known = Pieces()

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin: at rows, and at single blanks before a printable character
        and not after another blank."""
        begins = np.zeros(len(data) + 1, bool)
        if self.cuttable and len(data) > 2:
            begins[1:-2] = (data[1:-1] == _BLANK) & _OPENS[data[2:]] & (data[:-2] != _BLANK)
        begins[offsets] = True
        return np.flatnonzero(begins)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        """Encode pieces, each of which begins with the blank that B adds by itself."""
        texts = [x.decode("utf-8") for x in raw]
        lists = [
            [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)],
            self.b.encode([t[1:] for t in texts], num_threads=1),
        ]
        sizes = np.array([len(x) for x in raw], np.int64)
        ends = np.cumsum(sizes)
        whole = np.frombuffer(b"".join(raw), np.uint8)
        good = np.ones(len(raw), bool)
        counts, ids = [], []
        for own, tokens in zip(lists, self.tokens, strict=True):
            n = np.array([len(x) for x in own], np.int64)
            flat = np.fromiter((i for x in own for i in x), np.int32, int(n.sum()))
            piece = np.repeat(np.arange(len(raw)), n)
            same = np.bincount(piece, tokens.size[flat], len(raw)).astype(np.int64) == sizes
            # Bytes are compared where the lengths agree.
            kept = same[piece]
            wrong = tokens.joined(flat[kept]) != whole[_spread((ends - sizes)[same], sizes[same])]
            at = np.flatnonzero(same)[np.searchsorted(np.cumsum(sizes[same]), np.flatnonzero(wrong), side="right")]
            same[at] = False
            good &= same
            counts.append(n)
            ids.append(flat)
        self.known.add(hashes, good, counts, ids)

    def batch(self, column: pa.Array):
        """Slices of `column`, aligned: see `_slice`."""
        data, offsets = utf8(column)
        for lo, hi in row_slices(offsets, SLICE_BYTES):
            yield self._slice(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])

    def _slice(self, part: np.ndarray, at: np.ndarray) -> tuple:
        """Per text: tokens of A and of B, groups, SHA-256 of the groups; and of all links the
        text they are in and their pair of ids."""
        # A blank before each text, as A is asked for and B adds by itself.
        n, sizes = len(at) - 1, np.diff(at)
        data = np.insert(part, at[:-1], np.uint8(_BLANK))
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        cuts = self.cuts(data, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        which, distinct = pd.factorize(chunk_hashes(data, starts, ends))
        if len(self.known.hashes) > KNOWN_PIECES:
            self.known = Pieces()
        place, new = self.known.places(distinct)
        if new.any():
            first = np.empty(len(distinct), np.int64)
            first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            whole = data.tobytes()
            raw = [whole[s:e] for s, e in zip(starts[first[new]], ends[first[new]], strict=True)]
            self._learn(distinct[new], raw)
            place, _ = self.known.places(distinct)
        place = place[which]
        text = np.searchsorted(offsets, starts, side="right") - 1
        good = sizes > 0
        good[text[~self.known.good[place]]] = False
        kept = good[text]
        place, starts, text = place[kept], starts[kept], text[kept]
        ids, ending, owner = [], [], []
        for v, tokens in enumerate(self.tokens):
            counts = self.known.count[v][place]
            own = self.known.pool[v][_spread(self.known.begin[v][place], counts)]
            length = tokens.size[own]
            piece = np.repeat(np.arange(len(place)), counts)
            before = np.concatenate([[0], np.cumsum(length)])
            at_piece = before[np.cumsum(counts) - counts]
            ids.append(own)
            ending.append(before[1:] - at_piece[piece] + starts[piece])
            owner.append(text[piece])
        # No token is empty, so ends rise and a link is the one pair that ends at a cut.
        to = np.searchsorted(ending[1], ending[0])
        linked = np.flatnonzero(ending[1][to] == ending[0]) if len(to) else to
        cut = [linked, to[linked]]
        pairs = (ids[0][cut[0]].astype(np.int64) << 32) | ids[1][cut[1]]
        link_text = owner[0][cut[0]]
        shas = self._digests(ids, cut, link_text, n)
        return (
            np.bincount(owner[0], minlength=n),
            np.bincount(owner[1], minlength=n),
            np.bincount(link_text, minlength=n),
            shas,
            link_text,
            pairs,
        )

    def _digests(self, ids: list, cut: list, link_text: np.ndarray, n: int) -> list[str]:
        """SHA-256 of `a1,a2|b1;a3|b2,b3` of every text; empty where it has no tokens."""
        groups = len(link_text)
        shas = [""] * n
        if not groups:
            return shas
        taken = [np.diff(c, prepend=-1) for c in cut]  # tokens of each group
        # Both sides in one row: a group's tokens of A, then its tokens of B.
        ends = np.cumsum(taken[0] + taken[1])
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        sign = np.full(len(order), ord(","), np.uint8)
        order[_spread(ends - taken[1] - taken[0], taken[0])] = ids[0]
        order[_spread(ends - taken[1], taken[1])] = ids[1]
        sign[ends - taken[1] - 1] = ord("|")
        sign[ends - 1] = ord(";")
        size = self.digits.size[order] + 1
        stop = np.cumsum(size)
        out = np.empty(int(stop[-1]), np.uint8)
        out[stop - 1] = sign
        plain = np.ones(len(out), bool)
        plain[stop - 1] = False
        out[plain] = self.digits.joined(order)
        last = np.flatnonzero(np.append(link_text[1:] != link_text[:-1], True))
        begin = 0
        for g in last.tolist():
            end = int(stop[ends[g] - 1])
            shas[link_text[g]] = hashlib.sha256(out[begin : end - 1]).hexdigest()
            begin = end
        return shas


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(vocabulary_a: str, vocabulary_b: str) -> Pair:
    key = (vocabulary_a, vocabulary_b)
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


def aligned_texts(texts: DataFrame, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """`(print, copies, n_a, n_b, n_groups, groups_sha256, pairs, counts)` for `(text, copies)`:
    the distinct linked pairs of ids as one long each, A's id above, and how often each is."""

    def run(batches):
        both = pair_of(vocabulary_a, vocabulary_b)
        for batch in batches:
            first = 0
            # A record batch per slice, so that only the links of one slice are held.
            for *sizes, shas, text, links in both.batch(batch["text"]):
                order = np.lexsort((links, text))
                text, links = text[order], links[order]
                new = np.ones(len(links), bool)
                new[1:] = (links[1:] != links[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                counts = np.diff(np.append(at, len(links)))
                held = np.bincount(text[at], minlength=len(shas))
                offsets = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["print"].slice(first, len(shas)),
                        batch["copies"].slice(first, len(shas)),
                        *[pa.array(x, pa.int64()) for x in sizes],
                        pa.array(shas, pa.string()),
                        *[pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (links[at], counts)],
                    ],
                    names=["print", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "counts"],
                )
                first += len(shas)

    return texts.select(F.sha2("text", 256).alias("print"), "copies", "text").mapInArrow(
        run,
        "print string, copies long, n_a long, n_b long, n_groups long, groups_sha256 string,"
        " pairs array<long>, counts array<long>",
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """`(pair, count, best)`: links of every pair over the corpus, copies included, and
    whether no pair of the same B id has more. Counts are added up per batch first."""

    def run(batches):
        for batch in batches:
            lists = batch["pairs"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            weight = batch["counts"].flatten().to_numpy() * np.repeat(batch["copies"].to_numpy(), sizes)
            pairs, which = np.unique(flat, return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, which, weight)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], names=["pair", "n"])

    parts = aligned.select("pairs", "counts", "copies").mapInArrow(run, "pair long, n long")
    counted = parts.groupBy("pair").agg(F.sum("n").alias("count"))
    # Pairs of one B id: no more than A has ids.
    highest = F.max("count").over(Window.partitionBy(F.expr("pair & 4294967295")))
    return counted.select("pair", "count", (F.col("count") == highest).alias("best"))


def _measured(aligned: DataFrame, counted: DataFrame, broadcast_pairs: int) -> DataFrame:
    """`aligned` with `n_links`, `n_best` and `count_sum` in place of its pairs."""
    spark = aligned.sparkSession
    kept = ["print", "copies", "n_a", "n_b", "n_groups", "groups_sha256"]
    if counted.count() <= broadcast_pairs:
        rows = counted.orderBy("pair").toPandas()
        table = spark.sparkContext.broadcast(
            (rows["pair"].to_numpy(np.int64), rows["count"].to_numpy(np.int64), rows["best"].to_numpy(bool))
        )

        def run(batches):
            known, count, best = table.value
            for batch in batches:
                sizes = np.diff(batch["pairs"].offsets.to_numpy())
                times = batch["counts"].flatten().to_numpy()
                at = np.searchsorted(known, batch["pairs"].flatten().to_numpy())
                begin = np.concatenate([[0], np.cumsum(sizes)])
                sums = [
                    np.diff(np.concatenate([[0], np.cumsum(x)])[begin])
                    for x in ((times, times * best[at], times * count[at]) if len(at) else [times] * 3)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch[c] for c in kept], *[pa.array(x, pa.int64()) for x in sums]],
                    names=[*kept, "n_links", "n_best", "count_sum"],
                )

        return aligned.select(*kept, "pairs", "counts").mapInArrow(
            run,
            "print string, copies long, n_a long, n_b long, n_groups long, groups_sha256 string,"
            " n_links long, n_best long, count_sum long",
        )
    each = aligned.select("print", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "print", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("times")
    )
    found = attach(each, counted, ["pair"], weight="count", spread_by=["print", "pair"], broadcast_bytes=0)
    sums = found.groupBy("print").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    names = ["n_links", "n_best", "count_sum"]
    return (
        aligned.select(*kept)
        .join(sums, "print", "left")
        .select(*kept, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])
    )


def align_tokenizers(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_a: str = "byte_bpe_50k.json",
    vocabulary_b: str = "piece_bpe_32k.model",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """`(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`, one row per
    input row, repeated and null ids included.

    A is a byte-level vocabulary and gets a blank and the text, B is a sentencepiece model
    that adds the blank itself; strings of special tokens are plain text. `n_links` counts
    the pairs of a token of A and one of B that end at the same byte; `n_best` those whose
    count over the corpus is the highest of their B id (ties included); `count_sum` adds up
    the links' counts; `groups_sha256` is the SHA-256 of the groups written as
    `a1,a2|b1;a3|b2,b3`. A text that is null, empty, or does not come back byte for byte
    from both tokenizers has no tokens: zeros and an empty string. Long texts are read
    whole; an empty table gives an empty table; other columns are not read.
    """
    rows = narrowed(df, doc_id=id_col, text=text_col)
    texts = rows.filter("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = staged(aligned_texts(texts, vocabulary_a, vocabulary_b))
    counted = staged(pair_counts(aligned))
    measures = _measured(aligned, counted, broadcast_pairs)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    keyed = rows.filter("text != ''").select("doc_id", F.sha2("text", 256).alias("print"))
    found = attach(keyed, measures, ["print"], weight="copies", spread_by=["doc_id"])
    # Rows without a text have no key, so they are not brought together under a null one.
    empty = rows.filter("text IS NULL OR text = ''").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in names], F.lit("").alias("groups_sha256")
    )
    return found.select("doc_id", *names, "groups_sha256").union(empty)
