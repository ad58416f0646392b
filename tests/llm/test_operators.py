"""The operators against brute force, and on awkward rows: nulls, empty and long texts,
repeated rows, empty tables, extra columns of clashing names."""

import base64
import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from paytide.llm import licenses, quality, secrets, vectors
from paytide.llm.components import connected_components
from paytide.llm.decontaminate import common_subsequence, find_leaks
from paytide.llm.frames import importable, scratch_path, staged
from paytide.llm.minhash import near_duplicates
from paytide.llm.packing import pack
from paytide.llm.shards import communication_matrix, hypergeometric, uniform_shards
from paytide.llm.tokens import encoded_slices, token_counts
from paytide.llm.vectors import near_duplicate_vectors
from paytide.llm.warc import finish_archive, read_archive, write_archive

AWKWARD = [None, "", "  \n\t ", "one", "one two three four", "É ñ 漢字  x", "a b c d e " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    draw = random.Random(4)
    base = [" ".join(draw.choice("abcdefghij") * draw.randint(1, 4) for _ in range(60)) for _ in range(30)]
    texts = AWKWARD + base
    for text in base[:12]:
        words = text.split()
        words[draw.randrange(60)] = "changed"
        texts.append(" ".join(words))  # a near copy
        texts.append(text.upper())  # a copy but for the case
    rows = [(i, t, "src", "own", 7) for i, t in enumerate(texts)]
    rows.append(rows[10])  # a repeated row
    schema = "doc_id long, text string, source string, shard string, n_links int"
    return staged(spark.createDataFrame(rows, schema))


def empty(docs):
    return staged(docs.filter("false"))


def test_tokens_equal_the_library(docs):
    import public_tokenizers
    import tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(1)
    signs = [*"ab AB 01 \n\n\t  '.,; é ñ 　\x1c\x85漢\r\x0b", "<|endoftext|>", " it's", "  \n"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    got = []
    for _, _, _, counts, ids in encoded_slices(pa.array(texts), "byte_bpe_50k.json", False):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]

    rows = {r.doc_id: r for r in token_counts(docs).collect()}
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (rows[r.doc_id].n_tokens, rows[r.doc_id].over_limit) == (n, n > 512)
    assert token_counts(docs).count() == docs.count()
    assert token_counts(docs, vocabulary="piece_bpe_32k.model").count() == docs.count()
    assert token_counts(empty(docs)).count() == 0


def test_packing_is_a_partition_of_all_ids(docs):
    tokens = token_counts(docs).groupBy("doc_id").sum("n_tokens").collect()
    packed = pack(docs, capacity=64, max_open=8).toPandas()
    want = {r[0]: r[1] for r in tokens}
    copies = docs.groupBy("doc_id").count().collect()
    for r in copies:
        own = packed[packed.doc_id == r[0]]
        assert own.length.sum() == want[r[0]] + r[1]
    fill = packed.groupby("sequence_id").length.sum()
    assert fill.max() <= 64
    assert (fill < 64).sum() <= docs.rdd.getNumPartitions()
    ordered = packed.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
    assert pack(empty(docs)).count() == 0


def test_shards_are_exact(docs):
    out = uniform_shards(docs, shards=5, block_rows=4)
    assert sorted(out.columns) == sorted(docs.columns + ["slot"])  # the own `shard` is replaced
    rows = out.toPandas()
    sizes = rows.groupby("shard").size()
    assert len(rows) == docs.count() and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    assert uniform_shards(empty(docs), shards=3).count() == 0
    matrix = communication_matrix([7, 0, 9], [6, 5, 5], 1)
    assert matrix.sum(axis=0).tolist() == [6, 5, 5] and matrix.sum(axis=1).tolist() == [7, 0, 9]
    rng = np.random.default_rng(2)
    many = [hypergeometric(rng, 10**9, 2 * 10**9, 3000) for _ in range(400)]
    assert abs(np.mean(many) - 1000) < 8 and 20 < np.std(many) < 32


def sets(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_near_duplicates_equal_brute_force(docs):
    rows = {r.doc_id: sets(r.text) for r in docs.collect()}
    label = {i: i for i in rows}
    for _ in range(len(rows)):
        for a in rows:
            for b in rows:
                if rows[a] and 100 * len(rows[a] & rows[b]) >= 75 * len(rows[a] | rows[b]):
                    label[a] = min(label[a], label[b])
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(rows[r.doc_id]),
            label[r.doc_id],
            label[r.doc_id] == r.doc_id,
        )
    assert near_duplicates(empty(docs)).count() == 0
    lost = near_duplicates(docs.selectExpr("if(doc_id = 8, null, doc_id) AS doc_id", "text"))
    assert [r.kept for r in lost.filter("doc_id IS NULL").collect()] == [True]


def test_near_duplicates_of_repeated_ids(spark):
    """An id that names two texts: a near copy of each is linked."""
    importable(spark)
    draw = random.Random(21)
    a, b = ([f"{p}{draw.randint(0, 10**6)}" for _ in range(60)] for p in "ab")
    near_a, near_b = ([*x[:50], "other", *x[51:]] for x in (a, b))
    rows = [(1, a), (1, b), (2, near_a), (3, near_b), (None, a)]
    docs = staged(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True)]


def test_near_duplicates_in_one_large_bucket(spark, monkeypatch):
    """Copies of a common text with other changes each: similar to some, not to others."""
    importable(spark)
    monkeypatch.setattr("paytide.llm.minhash.PART", 16)
    draw = random.Random(22)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(120)]
    texts = []
    for _ in range(150):
        words = list(base)
        for at in draw.sample(range(120), draw.choice([1, 2, 3, 4, 5])):
            words[at] = f"x{draw.randint(0, 10**6)}"
        texts.append(" ".join(words))
    docs = staged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = [sets(t) for t in texts]
    label = list(range(len(texts)))
    for i, x in enumerate(found):
        for j in range(i):
            if 100 * len(x & found[j]) >= 75 * len(x | found[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if v == old else v for v in label]
    assert len(set(label)) > 2
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_components(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(40, 60)] + [(7, i) for i in range(8, 30)]
    links += [(draw.randint(100, 140), draw.randint(100, 140)) for _ in range(25)] + [(5, 5), (None, 3)]
    label = {x: x for a, b in links if a is not None and a != b for x in (a, b)}
    for _ in links:
        for a, b in links:
            if a is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = connected_components(spark.createDataFrame(links, "p long, q long"), "p", "q").collect()
    assert {r.node: r.component for r in found} == label and len(found) == len(label)


def test_vectors_equal_brute_force(spark):
    importable(spark)
    draw = np.random.default_rng(5)
    base = draw.normal(size=(40, 16))
    near = base[:15] + 0.1 * draw.normal(size=(15, 16))
    all_rows = [list(map(float, v)) for v in np.concatenate([base, near, base[:4], 3 * base[:2]])]
    all_rows += [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0]]
    df = spark.createDataFrame(
        [(i, v, "x") for i, v in enumerate(all_rows)], "vec_id long, embedding array<double>, n_links string"
    )
    got = {r.vec_id: r for r in near_duplicate_vectors(staged(df)).collect()}
    x = np.array(all_rows[:61])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    assert [got[i].n_links for i in range(61)] == linked.sum(axis=1).tolist()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(61, 67))
    assert near_duplicate_vectors(staged(df.filter("false"))).count() == 0


def test_vectors_of_clusters_equal_brute_force(spark, monkeypatch):
    """Clusters whose cosines lie around the threshold, in buckets of several blocks."""
    importable(spark)
    monkeypatch.setattr(vectors, "BLOCK", 48)
    draw = np.random.default_rng(11)
    base = np.repeat(draw.normal(size=(3, 32)), [300, 100, 60], axis=0)
    x = base + 0.32 * draw.normal(size=base.shape)
    x = np.concatenate([x, x[:5], x[:1], draw.normal(size=(200, 32))]).astype(np.float32)
    ids = list(range(len(x)))
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
    rows += [rows[0], (0, x[500].tolist()), (None, x[0].tolist())]  # repeated and null ids
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = near_duplicate_vectors(staged(df)).collect()
    assert len(got) == len(rows)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    of = np.append(np.arange(len(x)), [500])  # the last vector stands for id 0 as well
    ids.append(0)
    linked = unit[of] @ unit[of].T >= 0.9
    np.fill_diagonal(linked, False)
    assert 10_000 < linked.sum() < 0.8 * (300**2 + 100**2 + 60**2)
    component = np.array(ids)
    while True:
        low = np.minimum(component, np.where(linked, component, len(x)).min(axis=1))
        if (low == component).all():
            break
        component = low
    want = [(i, int(n), c, i == c) for i, n, c in zip(ids, linked.sum(axis=1), component.tolist(), strict=True)]
    assert sorted(map(tuple, (r for r in got if r.vec_id is not None))) == sorted([*want, want[0]])
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]


def test_vector_buckets_stay_level():
    for n in (10, 500, 3_000, 10_256, 51_282, 300_000, 1_000_000):
        parts, last, tables = vectors.plan(n, 64, 0.9, 1e-3, 7)
        held = 128 ** (parts - 1) * 2 * last
        assert held >= n / 1.5 and tables >= 1
    # A low threshold takes as many tables as its hits ask for.
    assert vectors.plan(1_000_000, 64, 0.5, 1e-3, 7)[2] > 342


def test_whole_groups_over_batches():
    values = np.repeat(np.arange(9), [1, 5, 2, 40, 1, 1, 7, 3, 4])
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + 6])], names=["k"]) for i in range(0, len(values), 6)]
    seen = []
    for table, starts in vectors.whole_groups(iter(batches), ["k"], 8):
        k = table["k"].to_numpy()
        assert k[starts].tolist() == np.unique(k).tolist()
        assert len(k) <= 8 or len(starts) == 1
        seen += k.tolist()
    assert seen == values.tolist()


def test_warc_round_trip(spark):
    importable(spark)
    html = ["<p>ä</p>", None, "", "same", "same", "x" * 300_000, "\r\n\r\n"]
    rows = [(i, None if i == 3 else f"http://a/{i}\r\nX", h) for i, h in enumerate(html)]
    pages = staged(spark.createDataFrame([*rows, (None, "u", "same")], "page_id long, url string, html string"))
    paths = [scratch_path(spark, "warc") for _ in range(2)]
    listed = [write_archive(pages, p, shard_bytes=1000, roll_bytes=100).collect() for p in paths]
    assert sorted(listed[0]) == sorted(listed[1])  # the same bytes again
    got = {r.page_id: r for r in read_archive(spark, paths[0], with_payload=True).collect()}
    first = {}
    for i, h in enumerate(html):
        payload = (h or "").encode()
        r, low = got[i], first.setdefault(payload, i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest)
        assert (r.record_type, r.refers_to) == (("response", None) if low == i else ("revisit", low))
        assert low != i or bytes(r.payload) == payload
    assert got[None].record_type == "response"
    # A driver lost before the last renames: the archive is completed, and completed again.
    left = spark.read.parquet(f"{paths[1]}/_manifest").first()
    os.makedirs(f"{paths[1]}/_temporary")
    os.rename(f"{paths[1]}/{left.file}", f"{paths[1]}/{left.temporary}")
    for _ in range(2):
        assert sorted(finish_archive(spark, paths[1]).collect()) == sorted(listed[1])
        assert sorted(map(tuple, read_archive(spark, paths[1]).fillna(-1).collect())) == sorted(
            map(tuple, read_archive(spark, paths[0]).fillna(-1).collect())
        )
    path = scratch_path(spark, "warc")
    write_archive(staged(pages.filter("false")), path)
    assert read_archive(spark, path).count() == 0


def test_secrets(spark):
    importable(spark)
    draw = random.Random(6)
    texts = AWKWARD + [
        "password:token: abcdefgh",
        "x API_KEY = 'Zz9+/=abc' AKIAABCDEFGHIJKL " + "ab" * 16,
        "toKen=short ſecret=abcdefghijk " + "abcdef" * 6,
    ]
    texts += [f"word {i} token = \"{draw.getrandbits(160):040x}\" more words here" for i in range(40)]
    docs = staged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    model = secrets.fit(secrets.labelled_findings(docs))
    got = {r.doc_id: r for r in secrets.find_secrets(docs, model).collect()}
    low = "".join  # the rules once more, spelled out
    word = "|".join(
        low(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")
    )
    assign = re.compile(f"({word}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for i, text in enumerate(texts):
        text = text or ""
        spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        assert got[i].base_spans == secrets.joined(spans)
        assert set(got[i].base_spans.split(",")) <= set(got[i].spans.split(","))
        assert 0 <= got[i].n_confirmed <= len(spans)
    clean = {r.doc_id: r.text for r in secrets.redact(docs, model).collect()}
    assert all(clean[i] == t for i, t in enumerate(AWKWARD)) and "[secret]" in clean[20]
    assert model.recall >= 0.99 and len(got) == len(texts)
    assert sum(r.n_confirmed for r in got.values()) >= 0.9 * sum(
        r.n_assign + r.n_access + r.n_hex for r in got.values()
    )
    none = secrets.fit(secrets.labelled_findings(docs.filter("false")))
    assert secrets.find_secrets(docs.filter("false"), none).count() == 0


def test_network_finds_what_the_rules_miss(spark):
    """Secrets of shapes that no rule knows, beside names and words, after learning from
    texts that hold findings of the rules only."""
    importable(spark)
    draw = random.Random(31)
    words = ["".join(draw.choices("aeioulnrst", k=draw.randint(3, 14))) for _ in range(400)]

    def of(signs, k):
        return "".join(draw.choices(signs, k=k))

    def prose(n):
        return " ".join(draw.choices(words, k=n))

    low = "abcdefghijklmnopqrstuvwxyz"
    alnum = low + low.upper() + "0123456789"
    known = [f'{prose(30)} token = "{draw.getrandbits(160):040x}" {prose(20)}' for _ in range(150)]
    known += [f"{prose(20)} AKIA{of(alnum[26:], 16).upper()} {prose(9)}" for _ in range(50)]
    known += [prose(60) for _ in range(400)]
    train = staged(spark.createDataFrame(list(enumerate(known)), "doc_id long, text string"))
    model = secrets.fit(secrets.labelled_findings(train))
    assert secrets.charcnn.SLOPES[0] <= model.slope <= secrets.charcnn.SLOPES[1]
    assert 0 < model.threshold < 1 and model.recall >= 0.95 and model.precision >= 0.9

    planted = []
    for i in range(200):
        value = [
            lambda: "ghp_" + of(alnum, 36),
            lambda: of(low + low.upper(), 32),
            lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(of(alnum + "+/", 64) for _ in range(4)),
            lambda: of(alnum, 14) + "1",
            lambda: of(alnum, 16) + "9!",
        ][i % 5]()
        shown = f"http://{of(low, 5)}:{value}@host.example" if i % 5 == 4 else value
        planted.append((i, f"{prose(25)} {shown} {prose(15)}", value))
    plain = [prose(20) + f" {draw.choice(words)}{draw.choice(words).title()}{draw.randrange(50)} " + prose(30) for _ in range(200)]
    plain += [f"{prose(10)} {draw.choice(words)}-{draw.choice(words)}-{draw.randrange(2000)} {prose(10)}" for _ in range(100)]
    plain += [f"{prose(9)} see https://host.example/{draw.choice(words)}/{draw.choice(words)}/{draw.randrange(9999)} {prose(9)}" for _ in range(100)]
    rows = [(i, t) for i, t, _ in planted] + [(1000 + i, t) for i, t in enumerate(plain)]
    docs = staged(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in secrets.find_secrets(docs, model).collect()}
    found = 0
    for i, text, value in planted:
        begin = text.index(value)
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[i].spans.split(",") if x.startswith("model:")]
        found += any(s <= begin + 4 and e >= begin + len(value) - 4 for s, e in spans)
    wrong = sum(r.n_model for i, r in got.items() if i >= 1000)
    assert found >= 0.9 * len(planted)
    assert found / (found + wrong) > 0.9


def test_calibration_of_separable_logits():
    from paytide.llm import charcnn

    logit = np.concatenate([np.linspace(7, 30, 40), np.linspace(-20, -2, 900)])
    y = np.array([1] * 40 + [0] * 900)
    slope, offset = charcnn.calibrate(logit, y)
    p = 1 / (1 + np.exp(-(slope * logit + offset)))
    assert charcnn.SLOPES[0] <= slope <= charcnn.SLOPES[1] and p[:40].min() > 0.5 > p[40:].max()
    threshold = charcnn.recall_threshold(p, y, 0.99)
    assert (p >= threshold).sum() == 40
    assert charcnn.calibrate(-logit, y) == (1.0, 0.0)


def test_quality(spark):
    importable(spark)
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(50)]
    rows = []
    for i in range(400):
        text, grade = draw.choices(words, k=30), i % 3
        text += {0: ["awful"], 1: ["dull&&&"], 2: []}[grade]
        rows.append((i, " ".join(text), grade, "x"))
    rated = staged(spark.createDataFrame(rows, "doc_id long, text string, grade int, expected_grade string"))
    model = quality.fit(rated.filter("doc_id < 300"), ridge=1e-4)
    assert model.thresholds[0] <= model.thresholds[1]
    got = quality.scored(rated.filter("doc_id >= 300"), model).toPandas()
    assert ((got.tail_probability >= 0.5) == (got.grade == 2)).mean() > 0.95
    assert got.expected_grade.between(0, 2).all()
    odd = spark.createDataFrame([(t,) for t in AWKWARD], "text string")
    assert quality.scored(odd, model).count() == len(AWKWARD)
    untrained = quality.fit(rated.filter("false"))
    assert {r.tail_probability for r in quality.scored(odd, untrained).collect()} == {1.0}


def test_leaks(spark):
    importable(spark)
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(900)]
    items = [" ".join(draw.choices(words, k=draw.randint(15, 60))) for _ in range(12)]
    texts = [" ".join(draw.choices(words, k=200)) for _ in range(40)]
    want = set()
    for i, item in enumerate(items):
        parts = item.split()
        if i % 2:
            parts[len(parts) // 3] = "other"  # a paraphrase of one word
        texts.append(" ".join([*draw.choices(words, k=70), *parts, *draw.choices(words, k=70)]))
        want.add((len(texts) - 1, i))
    texts += AWKWARD
    docs = staged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    bench = [*enumerate(items), (90, None), (91, " ")]
    benchmark = staged(spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()} == want
    in_blocks = find_leaks(docs, benchmark, block_bytes=1000)
    assert {(r.doc_id, r.item_id) for r in in_blocks.collect()} == want
    assert find_leaks(empty(docs), benchmark).count() == 0
    assert find_leaks(docs, empty(benchmark)).count() == 0
    a, b = np.array([1, 2, 3, 4, 5, 2]), np.array([2, 9, 4, 5, 1, 2])
    assert common_subsequence(a, b) == 4


def test_leaks_without_the_end_of_an_item(spark):
    importable(spark)
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(900)]
    items = [" ".join(draw.choices(words, k=40)) for _ in range(6)]
    texts = []
    for i, item in enumerate(items):  # the first 80 %, cut off or reworded
        ending = [] if i % 2 else [f"other{j}" for j in range(8)]
        texts.append(" ".join([*draw.choices(words, k=50), *item.split()[:32], *ending]))
    docs = staged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = [(i, item, " ".join(item.split()[32:])) for i, item in enumerate(items)]
    benchmark = staged(spark.createDataFrame(rows, "item_id long, text string, answer string"))
    got = {(r.doc_id, r.item_id, r.common_words >= 32) for r in find_leaks(docs, benchmark).collect()}
    assert got == {(i, i, True) for i in range(6)}
    assert find_leaks(docs, benchmark, answer_col="answer").count() == 0  # a given answer is asked for


def test_leaks_of_loose_copies_equal_brute_force(spark):
    importable(spark)
    draw = random.Random(12)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(900)]
    common = [1 / (k + 1) for k in range(900)]  # some words are far more frequent
    items = [draw.choices(words, common, k=draw.choice([15, 32, 33, 48, 59, 130])) for _ in range(24)]
    texts = []
    for item in items:
        replaced = list(item)
        for j in draw.sample(range(len(item)), int(0.29 * len(item))):
            replaced[j] = f"other{j}"
        spread = [x for w in item for x in (w, draw.choice(words))]
        for copy in (replaced, spread, draw.sample(item, len(item)), item[: len(item) // 2]):
            texts.append([*draw.choices(words, k=draw.randint(0, 90)), *copy, *draw.choices(words, k=90)])
    number = {w: i for i, w in enumerate(sorted({w for t in texts + items for w in t}))}
    coded = [np.array([number[w] for w in t]) for t in texts]
    want = set()
    for i, item in enumerate(items):
        a, span = np.array([number[w] for w in item]), 2 * len(item) + 32
        for d, t in enumerate(coded):
            if any(
                common_subsequence(a, t[s : s + span]) >= 0.7 * len(a) for s in range(max(1, len(t) - span + 1))
            ):
                want.add((d, i))
    assert len(want) >= 48
    rows = [(d, " ".join(t)) for d, t in enumerate(texts)]
    docs = staged(spark.createDataFrame(rows, "doc_id long, text string"))
    bench = [(i, " ".join(t)) for i, t in enumerate(items)]
    benchmark = staged(spark.createDataFrame(bench, "item_id long, text string"))
    for rank in (256, 6):  # in six dimensions most of the weight is outside of the space
        got = {(r.doc_id, r.item_id): r.overlap for r in find_leaks(docs, benchmark, rank=rank).collect()}
        assert want <= set(got) and min(got.values()) >= 0.7
        assert len(got) <= 1.05 * len(want)  # windows are a little longer than the stretches


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/code", "nothing of note"),
        (3, "a/b/own", "much else " * 40 + "\nLicensed under the Apache License, Version 2.0."),
        (4, "c/code", None),
        (5, None, ""),
        (2, "a/b/code", "nothing of note"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = sorted((r.doc_id, r.license, r.inherited_from) for r in licenses.license_scan(df).collect())
    assert got == [
        (1, "MIT", "a"),
        (2, "MIT", "a"),
        (2, "MIT", "a"),
        (3, "Apache-2.0", "a"),
        (4, None, None),
        (5, None, None),
    ]
    assert licenses.license_scan(df.filter("false")).count() == 0


def test_licenses_dotted_capital_i_follows_the_sql(spark, tmp_path):
    rows = [
        (1, "a/LICENSE", "RELEASED UNDER THE M\u0130T L\u0130CENSE"),
        (2, "a/code", "L\u0130CENSED UNDER CC BY-NC 4.0\nmuch else"),
        (3, "b/code", "nothing of note"),
        (4, "b/none", ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    n, counts = licenses._frequencies(df.select("text"), ["license", "mit", "under"])
    assert (n, counts) == (4, {"license": 1, "mit": 1, "under": 2})
    df.write.parquet(str(tmp_path / "documents"))
    want = duckdb.sql(licenses.oracle(f"SELECT * FROM '{tmp_path}/documents/*.parquet'")).fetchall()
    got = licenses.license_scan(df)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sorted((r[0], r[2]) for r in want if r[2]) == [(1, "MIT"), (2, "CC-BY-NC-4.0")]


def test_secrets_fit_takes_every_finding(spark):
    """More distinct findings of each label than the 2,048 of a sample: all are fitted on,
    every fourth of a label held out."""
    importable(spark)
    draw = random.Random(12)
    texts = [f"key {draw.getrandbits(128):032x} here" for _ in range(2100)]
    texts += [f"plain {''.join(draw.choices('abcdefghij', k=12))} word" for _ in range(2100)]
    rows = [(secrets.charcnn.window(t, 4, 4 + (32 if i < 2100 else 18)), int(i < 2100)) for i, t in enumerate(texts)]
    findings = spark.createDataFrame(rows, "window binary, label int")
    distinct = {label: len({w for w, y in rows if y == label}) for label in (0, 1)}
    model = secrets.fit(findings)
    for label in (0, 1):
        assert model.counts[(label, False)] + model.counts[(label, True)] == distinct[label] > 2048
        assert model.counts[(label, True)] == -(-distinct[label] // 4)
    assert model.weights is not None and model.recall >= 0.99
