"""Secrets in whole texts: three fixed rules, and a character network over candidates.

The rules decide their own spans. Candidates of the network are the rules' spans and all
other opaque tokens: runs of 16 or more letters, digits and `+/_=-` that hold a letter and a
digit or change their case like no word does, runs of 12 or more with a letter and a digit,
passwords in URLs, and private key blocks. Each is read with its surroundings by a network, and a token
beyond the threshold is added as a span of kind `model`.

The network learns from the rules' findings with what the rules go by taken away: values
without their keyword, and values of other shapes put in their places. Counter-examples are
words of the same texts, and names, slugs, paths and numbers made of them. An opaque token
that no rule takes has no label: it may be a secret.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytide.llm import charcnn
from paytide.llm.frames import narrowed, staged
from paytide.llm.text import row_slices, utf8, word_ranges

SLICE_BYTES = 4 << 20
REDACT_BYTES = 1 << 20

# The patterns, their least lengths and the order of the kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole, so its length can be asked for
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "model")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Runs that may be opaque tokens, passwords in URLs, and private keys.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
URL_PASSWORD = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?")
#: Changes from a lower to an upper-case letter that a word or a name does not have.
CASE_CHANGES = 3

_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_DIGIT, _LOW, _HIGH = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = _LOW[97:123] = _HIGH[65:91] = True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the three rules, by start and then kind as listed."""
    low = text.lower()
    spans = []
    if any(w in low for w in WORDS):
        spans += [
            ("assign", *m.span())
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _opaque(token: str) -> bool:
    if any(c.isalpha() for c in token) and any(c.isdigit() for c in token):
        return True
    changes = sum(a.islower() and b.isupper() for a, b in zip(token, token[1:], strict=False))
    return len(token) >= 16 and changes >= CASE_CHANGES


def opaque_tokens(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Candidates that no span touches, in order and without overlap."""
    taken = [(s, e) for _, s, e in spans]
    out: list[tuple[int, int]] = []

    def add(s: int, e: int) -> None:
        if not any(a < e and s < b for a, b in taken):
            out.append((s, e))
            taken.append((s, e))

    if "-----BEGIN" in text:
        for m in PRIVATE_KEY.finditer(text):
            add(*m.span())
    if "://" in text and "@" in text:
        for m in URL_PASSWORD.finditer(text):
            add(*m.span(1))
    for m in RUN.finditer(text):
        if _opaque(m[0]):
            add(*m.span())
    return sorted(out)


def _run_of(flags: np.ndarray, least: int) -> np.ndarray:
    """Where a run of `least` flags begins."""
    held = 1
    while held < least:
        step = min(held, least - held)
        flags = flags[:-step] & flags[step:] if len(flags) > step else flags[:0]
        held += step
    return np.flatnonzero(flags)


def suspects(column: pa.Array):
    """(row, text, longest word's span) of each row; the text only where a rule or the
    network may find something. Rows that surely hold nothing are told by bytes alone."""
    data, offsets = utf8(column)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        at = offsets[lo : hi + 1]
        part, at = data[at[0] : at[-1]], at - at[0]
        marked = np.zeros(hi - lo, bool)
        runs = _run_of(_TOKEN[part], 12)
        marked[np.searchsorted(at, runs, side="right") - 1] = True
        # An opaque token has a digit, or changes its case.
        signs = np.zeros(len(part) + 1, np.int64)
        np.cumsum(_DIGIT[part], out=signs[1:])
        turns = np.zeros(len(part) + 1, np.int64)
        np.cumsum(_LOW[part[:-1]] & _HIGH[part[1:]], out=turns[1:-1])
        turns[-1] = turns[-2] if len(part) else 0
        marked &= (signs[at[1:]] > signs[at[:-1]]) | (turns[at[1:]] - turns[at[:-1]] >= CASE_CHANGES)
        marked[np.searchsorted(at, _run_of(_HEX[part], 32), side="right") - 1] = True
        raw = part.tobytes()
        low = raw.lower()
        for word in (*(w.encode() for w in WORDS), b"akia", b"-----begin", b"://"):
            found = low.find(word)
            while found >= 0:
                row = int(np.searchsorted(at, found, side="right")) - 1
                marked[row] = True
                found = low.find(word, int(at[row + 1]))
        for row in range(hi - lo):
            text = raw[at[row] : at[row + 1]].decode("utf-8", "replace") if marked[row] else ""
            yield lo + row, text


def _longest_words(column: pa.Array) -> list[str]:
    """The longest word of each text: ordinary tokens, as counter-examples."""
    data, offsets = utf8(column)
    out = []
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        at = offsets[lo : hi + 1]
        part, at = data[at[0] : at[-1]], at - at[0]
        starts, ends, rows = word_ranges(part, at)
        sizes = ends - starts
        for row in range(hi - lo):
            a, b = rows[row], rows[row + 1]
            if a == b:
                out.append(b"")
                continue
            k = a + int(sizes[a:b].argmax())
            left, right = max(at[row], starts[k] - 64), min(at[row + 1], ends[k] + 64)
            text = part[left:right].tobytes().decode("utf-8", "ignore")
            word = part[starts[k] : ends[k]].tobytes().decode("utf-8", "ignore")
            i = text.find(word)
            out.append(charcnn.window(text, i, i + len(word)))
    return out


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_BASE64 = _LETTERS + _LETTERS.upper() + "0123456789+/"


def _other_value(draw: random.Random) -> str:
    """A random value of one of the shapes that secrets have."""

    def of(signs: str, low: int, high: int) -> str:
        return "".join(draw.choices(signs, k=draw.randint(low, high)))

    shape = draw.randrange(8)
    if shape == 0:
        return of("0123456789abcdef", 24, 64)
    if shape == 1:
        return of(_BASE64, 20, 48) + "=" * draw.randrange(3)
    if shape == 2:
        return of(_LETTERS + _LETTERS.upper(), 16, 40)
    if shape == 3:
        return of(_LETTERS, 2, 5) + "_" + of(_BASE64[:62], 20, 40)
    if shape == 4:
        return of(_BASE64[:62], 12, 24)
    if shape == 5:
        return "://" + of(_LETTERS, 3, 8) + ":" + of(_BASE64[:62] + "!$%&*", 8, 20) + "@"
    if shape == 6:
        kind = draw.choice(["RSA ", "EC ", "", "OPENSSH "])
        return f"-----BEGIN {kind}PRIVATE KEY-----\n" + "\n".join(of(_BASE64, 64, 64) for _ in range(3))
    return "-".join(of("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12))


def _ordinary(draw: random.Random, words: list[str]) -> str:
    """A name, slug, path or number of ordinary words."""
    picked = [draw.choice(words) for _ in range(draw.randint(2, 4))]
    shape = draw.randrange(6)
    if shape == 0:
        return picked[0] + "".join(w.capitalize() for w in picked[1:]) + str(draw.randrange(100))
    if shape == 1:
        return "-".join(picked) + f"-{draw.randrange(3000)}"
    if shape == 2:
        return "/".join(picked) + f"/{draw.randrange(10**6)}"
    if shape == 3:
        return "_".join(picked) + f"_{draw.randrange(100)}"
    if shape == 4:
        return f"{draw.randint(1990, 2040)}-{draw.randint(10, 12)}-{draw.randint(10, 28)}T{draw.randint(10, 23)}-{draw.randint(10, 59)}"
    return "".join(w.upper() for w in picked) + str(draw.randrange(10**4))


def _examples(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[bytes, int]]:
    """Labelled windows from the findings of one text."""
    draw = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    words = [w for w in re.findall(r"[a-z]{3,12}", text[:20_000].lower()) if w not in WORDS] or ["word"]
    out = []
    for kind, s, e in spans:
        value = ASSIGN.fullmatch(text[s:e])[2] if kind == "assign" else text[s:e]
        if kind == "access":
            value = value[4:]
        # What the rule goes by gives way to ordinary words.
        left, right = text[max(0, s - 64) : s], text[e : e + 64]
        for v in (value, _other_value(draw), _other_value(draw)):
            lead = left + draw.choice(["", draw.choice(words) + draw.choice([" ", ": ", " = ", '="', " is "])])
            whole = f"{lead}{v}{right}"
            begin, end = len(lead), len(lead) + len(v)
            if v.startswith("://"):
                begin, end = begin + v.index(":", 3) + 1, end - 1
            out.append((charcnn.window(whole, begin, end), 1))
        name = _ordinary(draw, words)
        lead = left + draw.choice(["", draw.choice(WORDS) + draw.choice([" ", " of "])])
        out.append((charcnn.window(f"{lead}{name}{right}", len(lead), len(lead) + len(name)), 0))
    if not spans:
        name, at = _ordinary(draw, words), draw.randrange(len(text) + 1)
        whole = f"{text[max(0, at - 64) : at]} {name} {text[at : at + 64]}"
        begin = len(text[max(0, at - 64) : at]) + 1
        out.append((charcnn.window(whole, begin, begin + len(name)), 0))
    return out


def labelled_findings(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`(window, label)`: the rules' findings, and values of other shapes in their places,
    as 1; the longest word of each text, and names, slugs, paths and numbers made of its
    words, as 0. What is drawn follows from the text."""

    def run(batches):
        for batch in batches:
            windows, labels = [], []
            for _, text in suspects(batch["text"]):
                if text:
                    for window, label in _examples(text, base_spans(text)):
                        windows.append(window)
                        labels.append(label)
            plain = [w for w in _longest_words(batch["text"]) if w]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(windows + plain, pa.binary()),
                    pa.array(labels + [0] * len(plain), pa.int32()),
                ],
                names=["window", "label"],
            )

    return narrowed(df, text=text_col).mapInArrow(run, "window binary, label int")


class Model:
    """A trained network, its calibration and its threshold. Without labelled findings of
    both kinds there is no network and nothing is added."""

    def __init__(self, weights=None, slope=1.0, offset=0.0, threshold=float("inf"), recall=0.0, precision=0.0, counts=None):
        self.weights, self.slope, self.offset = weights, slope, offset
        self.threshold, self.recall, self.precision = threshold, recall, precision
        #: Distinct findings by (label, held out), all of which the model was fitted on.
        self.counts = counts or {}

    def _scaled(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30)))

    def probability(self, windows: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(windows))
        x = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), charcnn.WIDTH)
        return self._scaled(charcnn.logits(self.weights, x.astype(np.int64)))


#: Findings a training task holds, rounds of averaging, and windows of a batch.
PART_ROWS, ROUNDS, BATCH = 50_000, 6, 128


def _steps(y: np.ndarray) -> int:
    """Adam steps of a task in a round: all rounds together draw as many of each label as
    its larger label holds, and a whole training takes `charcnn.STEPS` at the least."""
    return max(charcnn.STEPS // ROUNDS, -(-max((y == 1).sum(), (y == 0).sum()) // (ROUNDS * BATCH // 2)))


def _arrays(rows) -> tuple[np.ndarray, np.ndarray]:
    rows = [(bytes(r["window"]), r["label"]) for r in sorted(rows, key=lambda r: r["rank"])]
    x = np.frombuffer(b"".join(w for w, _ in rows), np.uint8).reshape(len(rows), charcnn.WIDTH)
    return x.astype(np.int64), np.array([label for _, label in rows], np.int64)


def _sum(rdd, part) -> np.ndarray:
    """The sum over partitions of numpy vectors that `part` makes of their rows; one
    vector a partition comes back."""
    return np.sum(rdd.mapPartitions(lambda rows: [part(list(rows))]).collect(), axis=0)


def fit(findings: DataFrame, recall: float = 0.99, seed: int = 5) -> Model:
    """Fit on all distinct findings of each label; every fourth of a label in order of hash
    is held out for calibration and the threshold. Tasks train on their own findings from the same weights,
    one round after another, and their weights are averaged by rows; sums, not rows, come
    back to the driver."""
    rows = findings.select("window", "label").distinct()
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if min(n.get(0, 0), n.get(1, 0)) < 8:
        return Model()
    # Findings in order of label, hash and bytes, by a distributed sort; of each label every
    # fourth from its first is held out.
    keyed = rows.select("label", F.xxhash64("window").alias("hash"), "window").rdd.map(
        lambda r: ((r["label"], r["hash"], bytes(r["window"])), None)
    )
    ranked = keyed.sortByKey().keys().zipWithIndex().map(
        lambda r: (r[0][2], r[0][0], r[1], (r[1] - (n[0] if r[0][0] else 0)) % 4 == 0)
    )
    ordered = staged(findings.sparkSession.createDataFrame(ranked, "window binary, label int, rank long, held boolean"))
    counts = {(r["label"], r["held"]): r["count"] for r in ordered.groupBy("label", "held").count().collect()}
    n_train = sum(k for (_, h), k in counts.items() if not h)
    parts = max(1, -(-n_train // PART_ROWS))
    train = staged(ordered.filter(~F.col("held")).repartitionByRange(parts, "rank"))
    spark = findings.sparkSession
    w = charcnn.start_weights(seed)
    keys = sorted(w)
    moments, done, draws = None, 0, {}
    # Weights and Adam's moments are averaged by rows after each round; the steps of a round
    # are those of its busiest task.
    for step in range(ROUNDS):
        shared = spark.sparkContext.broadcast((w, moments, done, draws))

        def trained(index, part, shared=shared, step=step):
            x, y = _arrays(part)
            size = sum(3 * w[k].size for k in keys)
            if not len(y):
                return [(index, None, np.zeros(2 + size))]
            steps = _steps(y)
            start, held_moments, before, states = shared.value
            got, (mean, square), state = charcnn.adam(
                x, y, seed + 7919 * index, steps, BATCH, start, held_moments, before, states.get(index)
            )
            parts = [got[k].ravel() for k in keys] + [mean[k].ravel() for k in keys] + [square[k].ravel() for k in keys]
            return [(index, state, np.concatenate([[len(y), 0], *[len(y) * v for v in parts]]))]

        def busiest(part):
            y = np.array([r["label"] for r in part])
            return [_steps(y)]

        got = train.rdd.mapPartitionsWithIndex(trained).collect()
        total = np.sum([v for _, _, v in got], axis=0)
        draws = {i: state for i, state, _ in got if state is not None}
        steps = max(train.select("label").rdd.mapPartitions(lambda rows: busiest(list(rows))).collect())
        shared.destroy()
        flat, at = total[2:] / total[0], 0
        mean, square = {}, {}
        for table in (w, mean, square):
            for k in keys:
                size = w[k].size
                table[k] = flat[at : at + size].reshape(w[k].shape)
                at += size
        moments, done = (mean, square), done + steps
    shared = spark.sparkContext.broadcast(w)

    def scored(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch["window"].to_pylist()), np.uint8).reshape(batch.num_rows, charcnn.WIDTH)
            logit = charcnn.logits(shared.value, x.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(logit, pa.float64()), batch["label"]], names=["logit", "label"])

    judged = staged(ordered.filter("held").select("window", "label").mapInArrow(scored, "logit double, label int")).rdd
    slope, offset = _calibrated(judged, counts.get((1, True), 0), counts.get((0, True), 0))
    return _thresholded(judged, Model(w, slope, offset, counts=counts), recall)


def _calibrated(judged, pos: int, neg: int) -> tuple[float, float]:
    """`charcnn.calibrate` on the held findings, its sums taken by Spark: one pass gives the
    gradient and Hessian, one the losses of all the steps of the line search."""
    rates = [0.5**k for k in range(21) if 0.5**k > 1e-6]

    def part_of(a: float, b: float, trials: list[tuple[float, float]]):
        def part(rows):
            z = np.array([r["logit"] for r in rows], float)
            y = np.array([r["label"] for r in rows])
            t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
            v = p * (1 - p)
            sums = [((p - t) * z).sum(), (p - t).sum(), (v * z * z).sum(), (v * z).sum(), v.sum()]
            losses = [(np.logaddexp(0, ta * z + tb) - t * (ta * z + tb)).sum() for ta, tb in trials]
            return np.array(sums + losses, float)

        return part

    a, b = 1.0, 0.0
    for _ in range(100):
        s = _sum(judged, part_of(a, b, [(a, b)]))
        g = np.array([s[0] + 1e-3 * a, s[1]])
        h = np.array([[s[2] + 1e-3, s[3]], [s[3], s[4]]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        now = s[5] + 5e-4 * a * a
        trials = [(a - r * step[0], b - r * step[1]) for r in rates]
        losses = _sum(judged, part_of(a, b, trials))[5:] + [5e-4 * ta * ta for ta, _ in trials]
        better = [i for i, x in enumerate(losses) if x < now]
        if not better:
            break
        a, b = trials[better[0]]
    if not a > 0:
        return 1.0, 0.0
    return float(np.clip(a, *charcnn.SLOPES)), float(b)


def _thresholded(judged, model: Model, recall: float) -> Model:
    """`charcnn.recall_threshold` on the held findings by a distributed sort: the
    probability that keeps `recall` of the positives at the best precision."""
    p = judged.map(lambda r: (float(model._scaled(np.array([r["logit"]]))[0]), int(r["label"]))).cache()
    positives = p.filter(lambda r: r[1] == 1).map(lambda r: r[0])
    n = positives.count()
    if not n:
        return model
    k = int(np.floor((1 - recall) * n))
    highest = positives.sortBy(lambda v: v).zipWithIndex().filter(lambda r: r[1] == k).first()[0]
    # Rows at or above each probability, from the top: sums of the partitions before, then within.
    levels = p.map(lambda r: (r[0], (r[1], 1))).reduceByKey(lambda u, v: (u[0] + v[0], u[1] + v[1]))
    ordered = levels.sortByKey(ascending=False).cache()
    def total(i, rows):
        out = np.zeros(2)
        for _, c in rows:
            out += c
        return [(i, out)]

    before, run = {}, np.zeros(2)
    for i, t in sorted(ordered.mapPartitionsWithIndex(total).collect(), key=lambda x: x[0]):
        before[i], run = run.copy(), run + t

    def precisions(i, rows):
        run = before[i].copy()
        for value, c in rows:
            run = run + c
            if value <= highest:
                yield value, float(run[0] / run[1])

    options = ordered.mapPartitionsWithIndex(precisions).cache()
    best = options.map(lambda r: r[1]).max()
    model.threshold = options.filter(lambda r: r[1] >= best - 1e-12).map(lambda r: r[0]).max()
    s = p.map(lambda r: np.array([r[1] == 1 and r[0] >= model.threshold, r[0] >= model.threshold, r[1] == 1], float)).treeReduce(np.add)
    model.recall, model.precision = float(s[0] / s[2]), float(s[0] / s[1]) if s[1] else 0.0
    for cached in (p, ordered, options):
        cached.unpersist()
    return model


def _judged(model: Model, found: list[tuple[str, list]]) -> list[tuple[list, int]]:
    """For each (text, base spans) of a batch: the spans the network adds, and how many of
    the base spans it takes for secrets too."""
    places, windows = [], []
    for i, (text, spans) in enumerate(found):
        if not text:
            continue
        for s, e in opaque_tokens(text, spans):
            places.append((i, True, s, e))
            windows.append(charcnn.window(text, s, e))
        for _, s, e in spans:
            places.append((i, False, s, e))
            windows.append(charcnn.window(text, s, e))
    added: list[list] = [[] for _ in found]
    confirmed = [0] * len(found)
    if windows:
        for (i, new, s, e), p in zip(places, model.probability(windows), strict=True):
            if p >= model.threshold:
                if new:
                    added[i].append(("model", s, e))
                else:
                    confirmed[i] += 1
    return list(zip(added, confirmed, strict=True))


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered)


def find_secrets(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, n_assign, n_access, n_hex, n_model, n_confirmed, base_spans, spans)`, one
    row per row.

    The network reads every candidate: `n_model` spans are its own, and of the rules' spans,
    which stay whatever it says, it takes `n_confirmed` for secrets. Spans are `kind:start:end` in code points, end exclusive, joined by commas in order of
    start and then kind. A null or empty text has none. There is no shuffle; repeated rows
    give repeated results, and other columns are not read.
    """

    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_model", "n_confirmed", "base_spans", "spans"]

    def run(batches):
        for batch in batches:
            found = []
            for _, text in suspects(batch["text"]):
                found.append((text, base_spans(text) if text else []))
            judged = _judged(model, found)
            counts = [[sum(k == kind for k, _, _ in s) for _, s in found] for kind in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([len(a) for a, _ in judged], pa.int64()),
                    pa.array([n for _, n in judged], pa.int64()),
                    pa.array([joined(s) for _, s in found], pa.string()),
                    pa.array(
                        [joined(s + a) for (_, s), (a, _) in zip(found, judged, strict=True)],
                        pa.string(),
                    ),
                ],
                names=names,
            )

    rows = narrowed(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_model long,"
        " n_confirmed long, base_spans string, spans string",
    )


def masked(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """`text` with every span, or union of overlapping spans, replaced by `mask`."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1:]):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _redacted(batch: pa.RecordBatch, place: int, model: Model, mask: str) -> pa.RecordBatch:
    column = batch.column(place)
    found = [(text, base_spans(text) if text else []) for _, text in suspects(column)]
    changed = {
        i: masked(text, spans + more, mask)
        for i, ((text, spans), (more, _)) in enumerate(zip(found, _judged(model, found), strict=True))
        if spans or more
    }
    if not changed:
        return batch
    # Unchanged texts stay in Arrow; changed ones take their places.
    flags = np.zeros(len(column), bool)
    flags[list(changed)] = True
    texts = pc.replace_with_mask(column, pa.array(flags), pa.array(list(changed.values()), column.type))
    columns = [texts if i == place else c for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def redact(df: DataFrame, model: Model, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """`df` with all found spans of `text_col` replaced by `mask`; other texts unchanged,
    a null text stays null. All columns keep their names and order."""
    place = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            # A record batch per slice: what is decoded and judged is bounded by its bytes.
            _, offsets = utf8(batch.column(place))
            for lo, hi in row_slices(offsets, REDACT_BYTES):
                yield _redacted(batch.slice(lo, hi - lo), place, model, mask)

    return df.mapInArrow(run, T.StructType(df.schema.fields))


def digest(spans: str | None) -> str:
    """Lower-case hex SHA-256 of joined spans (in Spark: `sha2(spans, 256)`)."""
    return hashlib.sha256((spans or "").encode()).hexdigest()
