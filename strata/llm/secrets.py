"""Secret scans with a character convolutional network (operator 5).

Three fixed patterns give the base findings.  Every other candidate (a run of 12
or more value characters with a digit, or of 20 or more of any kind) is judged
by a small convolutional network over all its characters and the context on both
sides: one-hot characters, ``FILTERS`` filters of width ``TAPS``, rectifier,
maximum over the characters, the context before and the context after, logistic
output.  A candidate longer than ``VALUE`` is read in windows of ``VALUE``
characters, a new one every ``STRIDE``; its best window counts.  The network is
NumPy, trained on labelled findings: the base findings of all documents
against runs that are no candidates in them, and, in the
contexts of both, values drawn under a fixed seed (``secret_forms`` against
``ordinary_forms`` such as dates, versions, paths and numbers), so that it learns the look of a
random value and not that of the patterns.  It is calibrated by Platt scaling on a quarter that it
was not trained on, and cut at the largest threshold that is expected to keep
``RECALL`` of new base findings and ``FORM_RECALL`` of each drawn form (fewer
than 99 findings cannot vouch for 0.99, then at 0.5 or their lowest score).

Defined results: null and empty texts have no findings; repeated rows are scanned
alike; spans are code points, end exclusive; whole texts are scanned; without
findings, or without ordinary runs, to learn from the method adds no span; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_texts
from strata.session import materialize, release

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Runs of value characters; 12 or more with a digit or 20 or more are candidates.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
DIGIT = re.compile(r"[0-9]")

BEFORE, VALUE, AFTER, TAPS, FILTERS = 16, 40, 16, 5, 32
#: Characters from one window of a long candidate to the next.
STRIDE = 10
RECALL, FORM_RECALL = 0.99, 0.97
#: Values drawn of each side, in contexts of the sample.
DRAWN = 6_000
#: Windows of findings and of ordinary words that the first network is fitted to.
SAMPLE_SPANS = 4_000
#: Windows of a task that goes on with all of them, its rate, the weight of a row at most and of
#: a drawn one; steps of the calibration.
GROUP_WINDOWS, REFINE_RATE, MOST_WEIGHT, DRAWN_WEIGHT, NEWTON_STEPS = 65_536, 0.0003, 10.0, 4.0, 12
_ALPHABET = np.full(256, 67, np.uint8)
for _i, _c in enumerate(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"):
    _ALPHABET[_c] = min(_i, 66)
for _c in b" \t\r\n":
    _ALPHABET[_c] = 68
for _c in b"\"':;,.!?":
    _ALPHABET[_c] = 69
_ALPHABET[ord("=")], _ALPHABET[ord(":")] = 65, 70
SYMBOLS, PAD = 72, 71
#: First filter places: in the context before, the value, the context after; the end.
CUTS = (0, BEFORE - TAPS + 1, BEFORE + VALUE - TAPS + 1, BEFORE + VALUE + AFTER - TAPS + 1)


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, kind index as a sort key, end) of the fixed patterns."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            out.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            out.append((m.start(), 1, m.end()))
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def candidates(text: str, base: list, words: bool = False) -> list[tuple[int, int]]:
    """Candidates outside the base findings; ``words``: the runs that are none instead."""
    out, k, ends = [], 0, sorted((s, e) for s, _, e in base)
    for m in RUN.finditer(text):
        a, z = m.span()
        while k < len(ends) and ends[k][1] <= a:
            k += 1
        if any(s < z and a < e for s, e in ends[k:k + 4]):
            continue
        value = (z - a >= 20) or DIGIT.search(text, a, z) is not None
        if value != words:
            out.append((a, z))
    return out


def windows(spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Span and first character of every window: one each ``STRIDE`` characters
    until a window ends the span, the last one flush with its end."""
    a, z = np.array(spans, np.int64).reshape(-1, 2).T
    n = 1 + -(-np.maximum(z - a - VALUE, 0) // STRIDE)
    owner = np.repeat(np.arange(len(a)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return owner, np.minimum(a[owner] + k * STRIDE, np.maximum(z - VALUE, a)[owner])


def codes(text: str, spans: list[tuple[int, int]], most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Span and character codes of every window, at most ``most`` at once: ``BEFORE``
    characters before the span, ``VALUE`` of the window, ``AFTER`` after the span."""
    if not spans:
        return
    raw = _ALPHABET[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    a, z = np.array(spans, np.int64).T
    owners, firsts = windows(spans)
    for c in range(0, len(owners), most):
        owner, first = owners[c:c + most], firsts[c:c + most]
        out = np.full((len(owner), BEFORE + VALUE + AFTER), PAD, np.uint8)
        for place, begin, end in ((BEFORE - np.minimum(a, BEFORE)[owner], np.maximum(a - BEFORE, 0)[owner], a[owner]),
                                  (BEFORE, first, np.minimum(first + VALUE, z[owner])),
                                  (BEFORE + VALUE, z[owner], np.minimum(z + AFTER, len(raw))[owner])):
            n = end - begin
            row = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            out[row, np.broadcast_to(place, n.shape)[row] + k] = raw[begin[row] + k]
        yield owner, out


def widened(x: np.ndarray) -> np.ndarray:
    """Codes that end before the context after them, with that context empty."""
    return np.pad(x, ((0, 0), (0, BEFORE + VALUE + AFTER - x.shape[1])), constant_values=PAD)


@dataclass
class Network:
    """Filters as tables (tap, character, filter), output weights, calibration."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = x.shape[1] - TAPS + 1
        conv = self.bias + sum(self.table[t][x[:, t:t + n]] for t in range(TAPS))
        where = np.stack([a + conv[:, a:z].argmax(1) for a, z in zip(CUTS, CUTS[1:])], 1)
        top = np.take_along_axis(conv, where, 1)
        valid = (x[:, BEFORE:BEFORE + VALUE] != PAD).sum(1, keepdims=True) / VALUE
        means = np.maximum(conv[:, CUTS[1]:CUTS[2]], 0).mean(1)
        flat = np.concatenate([np.maximum(top, 0).reshape(len(x), -1), means, valid], 1)
        return flat, conv, where

    def logit(self, x: np.ndarray) -> np.ndarray:
        x = widened(x)
        return np.concatenate([self.hidden(x[a:a + 2048])[0] @ self.out + self.out_bias
                               for a in range(0, len(x), 2048)] or [np.empty(0)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logit(x) + self.shift, -35, 35)))


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _of(rng: np.random.Generator, letters: str, low: int, high: int | None = None) -> str:
    return "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(low, (high or low) + 1)))


def _one(rng: np.random.Generator, *values: str) -> str:
    return values[rng.integers(len(values))]


def _word(rng: np.random.Generator, words: list[str], low: int = 2, high: int = 9) -> str:
    """A piece of an ordinary run of the sample, or syllables."""
    n = int(rng.integers(low, high + 1))
    if words and rng.random() < 0.5:
        w = words[rng.integers(len(words))]
        a = int(rng.integers(0, max(1, len(w) - n)))
        return w[a:a + n]
    return "".join(_of(rng, "bcdfghjklmnprstvw", 1) + _of(rng, "aeiou", 1) + _one(rng, "", "", "n", "s", "r")
                   for _ in range(n // 2 + 1))[:n]


def secret_forms(rng: np.random.Generator, words: list[str]) -> list[str]:
    """One random value of each form: letters and digits, base64, hexadecimal, behind a
    short prefix, capitals and digits, in groups, and URL-safe."""
    both = LOWER + UPPER + DIGITS
    prefix = _of(rng, LOWER, 2, 6) + _one(rng, "", "_" + _of(rng, LOWER, 3, 5)) + _one(rng, "_", "-")
    group = _one(rng, "_", "-")
    return [_of(rng, both, 20, 64),
            _of(rng, both + "+/", 24, 64) + _one(rng, "", "=", "=="),
            _of(rng, _one(rng, DIGITS + "ABCDEF", DIGITS + "abcdefABCDEF"), 20, 64),
            prefix + _of(rng, both + _one(rng, "", "-_"), 16, 40),
            _of(rng, UPPER + _one(rng, DIGITS, "234567"), 20, 40),
            _of(rng, LOWER, 3, 5) + group + _of(rng, DIGITS, 6, 13) + group + _one(rng, "", _of(rng, DIGITS, 6, 13) + group) + _of(rng, both, 20, 32),
            _of(rng, both + "-_", 24, 60)]


def ordinary_forms(rng: np.random.Generator, words: list[str]) -> list[str]:
    """One ordinary candidate of each form: dates and times, versions, identifiers in
    groups of hexadecimal digits, numbers in groups, paths, names with digits in several
    spellings, document numbers, long words, rules, and file names."""
    w = lambda: _word(rng, words)
    d = lambda low, high=None: _of(rng, DIGITS, low, high)
    year, month, day = f"{rng.integers(1950, 2040)}", f"{rng.integers(1, 13):02d}", f"{rng.integers(1, 29):02d}"
    time = [f"{rng.integers(0, 24):02d}", f"{rng.integers(0, 60):02d}", f"{rng.integers(0, 60):02d}"]
    dash, mark = _one(rng, "-", "/", "_"), _one(rng, "_", "-")
    date = dash.join([year, month, day] if rng.random() < 0.7 else [day, month, year])
    h = lambda n: _of(rng, DIGITS + "abcdef", n)
    stem = [w() for _ in range(rng.integers(2, 5))]
    part = lambda: _one(rng, w(), w(), _of(rng, LOWER, 2, 4), _of(rng, "bcdfglmnprstvx", 2, 4), w() + d(1))
    number = str(rng.integers(0, 3000))
    cut = rng.integers(len(stem) + 1)
    return [_one(rng, date + _one(rng, "T", "-", "_") + "-".join(time), year + month + day + _one(rng, "T", "-", "_") + "".join(time),
                 date + "-" + w() + "-" + w(), w() + "-" + date, date + _one(rng, "/", "_", "--") + date),
            mark.join([_one(rng, "v", "version", "release", w()) + _one(rng, "", mark) + d(1, 2), d(1, 2), d(1, 4),
                       *([_one(rng, "beta", "rc", "final", w()) + d(1)] * int(rng.integers(0, 2))), *([d(6, 10)] * int(rng.integers(0, 2)))]),
            "-".join((h if rng.random() < 0.8 else lambda n: h(n).upper())(n) for n in (8, 4, 4, 4, 12)),
            _one(rng, "+", "", "00") + _one(rng, "-", "/", "-").join(d(2, 8) for _ in range(rng.integers(2, 6))) + d(2, 6),
            _one(rng, "/", "") + "/".join(part() for _ in range(rng.integers(3, 10))) + _one(rng, "", "/", f"/{year}/{month}"),
            "/".join(part() for _ in range(rng.integers(2, 7))) + "/" + "".join(w().capitalize() for _ in range(rng.integers(1, 4))),
            mark.join([*stem[:cut], number, *stem[cut:]]),
            "".join(_one(rng, x.capitalize(), x.capitalize(), x.upper()) for x in stem[:-1]) + number + stem[-1].capitalize(),
            "_".join(x.upper() for x in stem) + "_" + d(1, 4),
            mark.join([_of(rng, UPPER, 2, 4), year, d(4, 8)]) if rng.random() < 0.6 else _of(rng, UPPER, 1, 3) + d(11, 15),
            "".join(_word(rng, words, 6, 9) for _ in range(rng.integers(3, 6))),
            _of(rng, _one(rng, "-", "=", "_", "-=", "+-"), 20, 60),
            _one(rng, "img", "IMG", "file", "scan", w()) + mark + year + month + day + mark + d(4, 6)]


def drawn(x: np.ndarray, y: np.ndarray, count: int, seed: int = 23) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``count`` secrets and as many ordinary candidates in contexts of the sample's
    windows ``x``: codes, labels and forms (numbered from 1)."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(LOWER.encode(), np.uint8)
    plain = x[y == 0][:, BEFORE:BEFORE + VALUE]
    words = [bytes(letters[np.minimum(r[r < 26], 25)]).decode() for r in plain[:2000]]
    words = [w for w in words if len(w) >= 10]
    rows, labels, forms, first = [], [], [], 1
    for label, make in ((1, secret_forms), (0, ordinary_forms)):
        made, some = 0, 0
        while made < count:
            values = make(rng, words)
            some = len(values)
            for f, value in enumerate(values):
                if len(value) < 12:
                    value += "-" + value + "2024"
                raw = _ALPHABET[np.frombuffer(value.encode(), np.uint8)]
                at = max(0, len(raw) - VALUE)                       # a secret may stand at the end
                if label == 0 and at:
                    at = int(rng.integers(0, at + 1))
                raw, near = raw[at:at + VALUE], x[rng.integers(len(x))]
                row = np.full(BEFORE + VALUE + AFTER, PAD, np.uint8)
                row[:BEFORE], row[BEFORE:BEFORE + len(raw)], row[BEFORE + VALUE:] = near[:BEFORE], raw, near[BEFORE + VALUE:]
                rows.append(row)
                labels.append(label)
                forms.append(first + f)
            made += some
        first += some
    return np.array(rows), np.array(labels), np.array(forms)


class Adam:
    """Steps of a network's filters and output weights."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.count, self.names = net, rate, 0, ("table", "bias", "out")
        self.m = {k: np.zeros_like(getattr(net, k)) for k in self.names}
        self.v = {k: np.zeros_like(getattr(net, k)) for k in self.names}

    def step(self, xb: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        net, n, m, v = self.net, len(xb), self.m, self.v
        flat, conv, where = net.hidden(xb)
        g = ((1 / (1 + np.exp(-np.clip(flat @ net.out + net.out_bias, -35, 35))) - y) * weight).astype(net.out.dtype)
        back = g[:, None] * net.out[None]
        dconv = np.zeros_like(conv)
        top = back[:, :3 * FILTERS].reshape(n, 3, FILTERS) * (flat[:, :3 * FILTERS].reshape(n, 3, FILTERS) > 0)
        np.put_along_axis(dconv, where, top, 1)
        value = slice(CUTS[1], CUTS[2])
        dconv[:, value] += (back[:, None, 3 * FILTERS:4 * FILTERS] / (CUTS[2] - CUTS[1])) * (conv[:, value] > 0)
        grad = {"out": flat.T @ g + 1e-4 * net.out, "bias": dconv.sum((0, 1)),
                "table": np.zeros_like(net.table)}
        flat_d = dconv.reshape(-1, FILTERS)
        for t in range(TAPS):
            seen = xb[:, t:t + conv.shape[1]].ravel()
            order_s = np.argsort(seen, kind="stable")
            s = seen[order_s]
            starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            grad["table"][t][s[starts]] = np.add.reduceat(flat_d[order_s], starts)
        net.out_bias -= self.rate * g.sum()
        self.count += 1
        for k in self.names:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
            setattr(net, k, getattr(net, k) - self.rate * (m[k] / (1 - 0.9 ** self.count))
                    / (np.sqrt(v[k] / (1 - 0.999 ** self.count)) + 1e-8))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.01, seed: int = 11,
        form: np.ndarray | None = None) -> Network:
    """Adam on three quarters of the findings; calibration and threshold on the rest.
    ``form``: 0 for findings of documents, else the drawn form."""
    form = np.zeros(len(y), int) if form is None else form
    x, rng = widened(x), np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.15, (TAPS, SYMBOLS, FILTERS)), np.zeros(FILTERS),
                  rng.normal(0, 0.1, 4 * FILTERS + 1), 0.0)
    mix = rng.permutation(len(y))
    held, train = mix[::4], np.setdiff1d(mix, mix[::4])
    if min((y[held] == 1).sum(), (y[held] == 0).sum(), (y[train] == 1).sum()) == 0:
        return net
    adam = Adam(net, rate)
    for _ in range(epochs):
        order = rng.permutation(train)
        for a in range(0, len(order), 128):
            at = order[a:a + 128]
            adam.step(x[at], y[at], np.full(len(at), 1 / len(at)))
    z, t = net.logit(x[held]), y[held].astype(float)
    goal = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))   # Platt's targets
    scale, shift = 1.0, 0.0
    for _ in range(2000):
        p = 1 / (1 + np.exp(-np.clip(scale * z + shift, -35, 35)))
        d = p - goal
        scale, shift = scale - 0.05 * (d * z).mean(), shift - 0.05 * d.mean()
    net.scale, net.shift = float(scale), float(shift)
    cuts = []
    for f in np.unique(form[held][t == 1]):
        found = np.sort(net.probability(x[held][(t == 1) & (form[held] == f)]))
        # Of n + 1 exchangeable findings, on average at most 1 in 100 scores below the rank-th of n.
        rank = int((1 - (FORM_RECALL if f else RECALL)) * (len(found) + 1) + 1e-9)
        cuts.append(float(found[rank - 1] if rank else min(found[0], 0.5)))
    net.threshold = min(cuts)
    return net


def training_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every distinct window ``(y, x)`` of all documents: base findings (1) and ordinary runs
    (0), written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ys, xs, have = [], [], 0

        def rows() -> pa.RecordBatch:
            x = np.concatenate(xs)
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(x.tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ys), pa.int32()), raw.cast(pa.binary())], names=["y", "x"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                base = base_findings(text)
                for y, spans in ((1, [(s + _value_at(text, s, k), e) for s, k, e in base]), (0, candidates(text, base, words=True))):
                    for _, x in codes(text, spans):
                        ys.append(np.full(len(x), y))
                        xs.append(x)
                        have += len(x)
                        if have >= 8192:
                            yield rows()
                            ys, xs, have = [], [], 0
        if have:
            yield rows()

    return materialize(docs.select(text_col).mapInArrow(run, "y int, x binary").distinct(), "secret-windows")


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), BEFORE + VALUE + AFTER)


def _held() -> F.Column:
    """The quarter of the windows that no network is trained on."""
    return F.crc32("x") % 4 == 0


def refined(net: Network, spans: DataFrame, counts: dict[int, int], x: np.ndarray, y: np.ndarray) -> Network:
    """``net`` trained on over all windows but a quarter (``_held``), calibrated and cut on that.

    Each task takes one pass of Adam over ``GROUP_WINDOWS`` windows, with drawn values among
    them; the networks are averaged by their windows.  Either side weighs alike (a row ``MOST_WEIGHT``
    at most).  Groups and orders are by hash, so the result does not depend on the partitions."""
    spark, total = spans.sparkSession, sum(counts.values())
    weight = np.array([min(MOST_WEIGHT, total / (2 * counts[c])) for c in (0, 1)], np.float32)
    more, labels, _ = drawn(x, y, DRAWN)
    held_x, held_y, held_form = drawn(x, y, DRAWN // 3, seed=29)
    held, groups = _held(), -(-total // GROUP_WINDOWS)
    shared = spark.sparkContext.broadcast((net, more, labels, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, dx, dy, w = shared.value
        f = np.float32
        mine = Network(start.table.astype(f), start.bias.astype(f), start.out.astype(f), f(start.out_bias))
        adam, rng, seen = Adam(mine, REFINE_RATE), np.random.default_rng(31), 0
        for b in batches:
            bx, by = _matrix(b.column("x")), b.column("y").to_numpy()
            seen += len(bx)
            some = rng.integers(0, len(dx), max(16, len(bx) // 4))
            ax, ay = np.concatenate([bx, dx[some]]), np.concatenate([by, dy[some]])
            aw = np.concatenate([w[by], np.full(len(some), DRAWN_WEIGHT, f)])
            order = rng.permutation(len(ax))
            for a in range(0, len(order), 128):
                at = order[a:a + 128]
                adam.step(ax[at], ay[at], aw[at] / len(at))
        if seen:
            vec = np.concatenate([mine.table.ravel(), mine.bias, mine.out, [mine.out_bias]]).astype(float) * seen
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(vec), dtype=np.int32), "w": vec, "n": np.full(len(vec), seen)})

    group = F.pmod(F.xxhash64("x", "y"), F.lit(groups)).cast("int")
    dealt = (spans.where(~held).withColumn("g", group).repartitionById(groups, F.col("g"))
             .sortWithinPartitions(F.xxhash64("y", "x"), "x", "y").select("y", "x"))
    # A row a weight and group, added as exact decimals so that their order does not matter.
    got = (dealt.mapInArrow(run, "at int, w double, n long").groupBy("at")
           .agg((F.sum(F.col("w").cast("decimal(38,12)")).cast("double") / F.sum("n")).alias("w")).orderBy("at").toArrow())
    shared.destroy()
    vec, a, z = got.column("w").to_numpy(), net.table.size, net.table.size + FILTERS
    out = Network(vec[:a].reshape(net.table.shape), vec[a:z], vec[z:-1], float(vec[-1]))
    model = spark.sparkContext.broadcast(out)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(model.value.logit(_matrix(b.column("x"))))], names=["y", "z"])

    scored = materialize(spans.where(held).mapInArrow(logits, "y int, z double"), "secret-logits")
    dz = out.logit(held_x)
    n = {r["y"]: r["n"] for r in scored.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = n.get(1, 0) + int(held_y.sum()), n.get(0, 0) + int((1 - held_y).sum())
    goals = (1 / (zeros + 2), (ones + 1) / (ones + 2))                            # Platt's targets
    scale, shift = 1.0, 0.0
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + F.exp(-(F.lit(scale) * F.col("z") + F.lit(shift))))
        d, h = p - F.when(F.col("y") == 1, goals[1]).otherwise(goals[0]), p * (1 - p)
        sums = scored.agg(*(F.coalesce(F.sum(c), F.lit(0.0)) for c in (d * F.col("z"), d, h * F.col("z") ** 2, h * F.col("z"), h))).first()
        p = 1 / (1 + np.exp(-np.clip(scale * dz + shift, -35, 35)))
        d, h = p - np.where(held_y == 1, goals[1], goals[0]), p * (1 - p)
        g0, g1, h00, h01, h11 = (s + float(t.sum()) for s, t in zip(sums, (d * dz, d, h * dz ** 2, h * dz, h)))
        step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-9 * (h00 + h11) * np.eye(2), [g0, g1])
        step *= min(1.0, 1.0 / np.abs(step).max())                               # at most 1 a step
        scale, shift = scale - float(step[0]), shift - float(step[1])
    out.scale, out.shift = scale, shift
    lowest = {}
    for f in np.unique(held_form[held_y == 1]):
        some = np.sort(dz[held_form == f])
        rank = int((1 - FORM_RECALL) * (len(some) + 1) + 1e-9)
        lowest[int(f)] = (rank, float(some[max(rank, 1) - 1]))
    rank = int((1 - RECALL) * (n.get(1, 0) + 1) + 1e-9)
    lowest[0] = (rank, scored.where("y = 1").orderBy("z").offset(max(rank, 1) - 1).first()["z"] if n.get(1) else np.inf)
    chance = lambda z: float(1 / (1 + np.exp(-np.clip(scale * z + shift, -35, 35))))
    out.threshold = min(chance(z) if rank else min(chance(z), 0.5) for rank, z in lowest.values())
    release(scored)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_spans: int = SAMPLE_SPANS) -> Network:
    """Train on the findings and ordinary runs of all documents.

    Their windows are cut out on the executors.  The driver fits a first network to at most
    ``sample_spans`` of either side, the first by md5; where there are more, ``refined`` goes on with
    all of them on the executors, and its calibration and threshold replace those of the first.
    """
    spans = training_windows(docs, text_col)
    counts = {r["y"]: r["n"] for r in spans.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    more_than_fit = len(counts) == 2 and max(counts.values()) > sample_spans
    first = spans.where(~_held()) if more_than_fit else spans
    some = [r for y in (0, 1) for r in
            first.where(F.col("y") == y).orderBy(F.md5("x"), "x").limit(sample_spans).collect()]
    x = np.array([np.frombuffer(r["x"], np.uint8) for r in some]).reshape(len(some), BEFORE + VALUE + AFTER)
    y = np.array([r["y"] for r in some], int)
    if not y.any() or y.all():
        net = fit(x, y)                                  # nothing to learn from
    else:
        more, labels, forms = drawn(x, y, DRAWN)
        net = fit(np.concatenate([x, more]), np.concatenate([y, labels]), form=np.concatenate([np.zeros(len(y), int), forms]))
        if more_than_fit:
            net = refined(net, spans, counts, x, y)
    release(spans)
    return net


def _value_at(text: str, start: int, kind: int) -> int:
    """Offset of the value in a base finding (the key of an assignment is context)."""
    return ASSIGN.match(text, start).start(2) - start if kind == 0 else 0


def scan(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """Replace the text by ``findings``: kind, start, end and calibrated score
    of every base finding and of every candidate above the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(col: pa.Array) -> dict:
        model, texts = shared.value, col.to_pylist()
        rows, spans, own, p, x, have = [], [], [], [], [], 0
        for i, text in enumerate(texts):
            base = base_findings(text) if text else []
            rows.append([(s, k, e, 1.0) for s, k, e in base])
            more = candidates(text, base) if text and model.threshold <= 1 else []
            for owner, c in codes(text, more):
                own.append(len(spans) + owner)
                x.append(c)
                have += len(c)
                if have >= 4096:
                    p.append(model.probability(np.concatenate(x)))
                    x, have = [], 0
            spans += [(i, a, z) for a, z in more]
        if x:
            p.append(model.probability(np.concatenate(x)))
        best = np.zeros(len(spans))
        if p:
            np.maximum.at(best, np.concatenate(own), np.concatenate(p))
        for j in np.flatnonzero(best >= model.threshold):
            i, a, z = spans[j]
            rows[i].append((a, 3, z, float(best[j])))
        return {"findings": [[{"kind": KINDS[k], "start": s, "end": e, "score": p}
                              for s, k, e, p in sorted(r)] for r in rows]}

    return map_texts(docs, {"findings": "array<struct<kind: string, start: long, end: long, score: double>>"},
                     run, text_col)


def joined(findings: str, base_only: bool = False) -> F.Column:
    """kind:start:end of the findings by start, then kind as listed, comma-joined."""
    some = F.filter(findings, lambda f: f.kind != KINDS[3]) if base_only else F.col(findings)
    return F.array_join(F.transform(some, lambda f: F.concat_ws(
        ":", f.kind, f.start.cast("string"), f.end.cast("string"))), ",")
