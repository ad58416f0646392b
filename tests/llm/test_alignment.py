"""The alignment of two tokenizers, token by token over whole texts."""

import hashlib
import random
from collections import Counter

import pytest

from paytide.llm.alignment import Pair, align_tokenizers, byte_level_table
from paytide.llm.frames import importable, staged

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SIGNS = [*"ab AB 01 \n\n\t  '.,; é ñ 　\x1c\x85漢\r\x0b ▁", "<|endoftext|>", " it's", "  \n", "<0x41>", "</s>", "ﬁ", "é"]
ODD = [None, "", " ", "  x", "▁", "a▁b", "\u0000", "x" * 60_000, "word " * 30_000, "<|endoftext|> <s>", "don't  stop\n now "]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(1, 9))) for _ in range(300)]
    out = [" ".join(draw.choices(words, k=draw.randint(1, 80))) for _ in range(60)]
    out += ["".join(draw.choices(SIGNS, k=draw.randint(0, 40))) for _ in range(400)]
    return ODD + out + out[:20] + [out[3]] * 150


def by_hand(texts):
    """Whole texts through both libraries, links by the end of every token."""
    import public_tokenizers
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(public_tokenizers.path(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))
    names = {i: entry for entry, i in a.get_vocab().items()}
    letters = byte_level_table()
    kept = []
    for text in texts:
        if not text:
            kept.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(letters[c] for c in names[i]) for i in ids_a]
        raw_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids_b, b.id_to_piece(ids_b), strict=True)
        ]
        whole = (" " + text).encode()
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            kept.append(None)
            continue
        ends_a, ends_b, at = {}, {}, 0
        for i, raw in enumerate(raw_a):
            at += len(raw)
            ends_a[at] = i
        at = 0
        for i, raw in enumerate(raw_b):
            at += len(raw)
            ends_b[at] = i
        cuts = sorted(ends_a.keys() & ends_b.keys())
        links = [(ids_a[ends_a[c]], ids_b[ends_b[c]]) for c in cuts]
        groups, i, j = [], 0, 0
        for c in cuts:
            x, y = ends_a[c] + 1, ends_b[c] + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        kept.append((len(ids_a), len(ids_b), links, ";".join(groups)))
    counts = Counter(link for k in kept if k for link in k[2])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for k in kept:
        if k is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, links, groups = k
        yield (
            n_a,
            n_b,
            len(links),
            len(links),
            sum(counts[link] == most[link[1]] for link in links),
            sum(counts[link] for link in links),
            hashlib.sha256(groups.encode()).hexdigest(),
        )


@pytest.mark.parametrize("broadcast_pairs", [0, 1_000_000])
def test_equals_whole_texts(spark, texts, broadcast_pairs):
    importable(spark)
    rows = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = staged(spark.createDataFrame(rows, "doc_id long, text string, print string, n_a int").repartition(3))
    got = align_tokenizers(docs, broadcast_pairs=broadcast_pairs).collect()
    want = [(r[0], *m) for r, m in zip(rows, by_hand(texts), strict=True)]
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert sum(m[0] == 0 for m in by_hand(texts)) < len(texts) / 2


def test_pieces_join_to_whole_texts(texts):
    import pyarrow as pa

    both = Pair(A, B)
    whole = Pair(A, B)
    whole.cuttable = False
    column = pa.array(texts, pa.string())
    for x, y in zip(both.batch(column), whole.batch(column), strict=True):
        assert x[3] == y[3] and all((a == b).all() for a, b in zip(x[:3] + x[4:], y[:3] + y[4:], strict=True))


def test_empty_table(spark):
    importable(spark)
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert align_tokenizers(docs).count() == 0
