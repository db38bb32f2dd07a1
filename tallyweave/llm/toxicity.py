"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

The corpus labels whole documents, so tokens are labelled from them: in a toxic
document, a token counts as toxic if one of its features is far commoner in
toxic documents. Features are the token and its beginnings. The field is fitted
on one half of a bounded sample; on the other half a logistic curve learns to
turn a document's marginals into a probability. Both weigh the sample's rows by
how many labels each stands for, so that the labels' shares are those of the
whole table at any size. Fitting is small and is done on the driver; scoring
covers every text, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import textops

#: Labelled documents that fitting reads at most, of each label; characters of one text, in chunks, from which on it is sampled too.
SAMPLE_ROWS, SAMPLE_TEXT, SAMPLE_CHUNK = 1_000, 65_536, 1_024

#: Beginnings of a token that are features, in bytes; the whole token is one too.
PREFIXES = (3, 4, 5, 6, 7, 8)

#: A chain ends with a sentence, or after so many tokens.
CHAIN = 64

#: How clearly, in standard deviations, and how many times commoner a feature is in toxic documents.
CLEAR, TIMES, LEAST_DOCS = 3.0, 2.5, 3

RESULT = "doc_id long, score double, spans array<struct<start:int,end:int>>"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


class Tokens:
    """Letter runs of a batch of texts, the chains they form, and the codes of their features."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        low = textops.lower_ascii(buf)
        wide = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)) + 1
        low[wide] += 0x20  # Latin capitals with accents
        self.offs = offs
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        inside = _LETTER[buf]
        self.start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        self.end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        stops = np.concatenate(([0], np.cumsum(_STOP[buf])))[self.start] if len(self.start) else np.zeros(0, np.int64)
        new = np.ones(len(self.start), bool)
        new[1:] = (self.doc[1:] != self.doc[:-1]) | (stops[1:] != stops[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        new |= (np.arange(len(new)) - head) % CHAIN == 0
        self.chain = np.flatnonzero(new)
        self.size = np.diff(np.append(self.chain, len(new)))
        self.sums = textops.byte_sums(low)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tokens, codes) for the whole token and for each beginning."""
        every = np.arange(len(self.start))
        yield every, self.sums.hash(self.start, self.end) ^ np.uint64(1)
        for n in PREFIXES:
            at = every[self.end - self.start >= n]
            yield at, self.sums.hash(self.start[at], self.start[at] + n)


@dataclass
class Model:
    codes: np.ndarray  # of the chosen features, sorted
    weights: np.ndarray
    bias: float
    moves: np.ndarray  # 2 x 2 transition scores
    curve: np.ndarray  # logistic weights of a document's summary
    base: float  # share of toxic labels, the score where nothing could be fitted

    def hits(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Which token has which chosen feature."""
        who, what = [], []
        if len(self.codes):
            for at, code in tokens.features():
                k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                good = self.codes[k] == code
                who.append(at[good])
                what.append(k[good])
        none = np.zeros(0, np.int64)
        return np.concatenate(who or [none]), np.concatenate(what or [none])

    def emissions(self, n: int, who: np.ndarray, what: np.ndarray) -> np.ndarray:
        return self.bias + np.bincount(who, weights=self.weights[what], minlength=n) if n else np.zeros(0)


def forward_backward(emit: np.ndarray, size: np.ndarray, moves: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For chains as padded rows of emission scores: marginals of the toxic tag, and summed marginals of tag pairs, weighted by chain."""
    n, length = emit.shape
    weight = np.ones(n) if weight is None else weight
    step = np.exp(moves)
    node = np.stack([np.ones_like(emit), np.exp(np.clip(emit, -30, 30))], 2)
    ahead, back = np.zeros((n, length, 2)), np.ones((n, length, 2))
    ahead[:, 0] = node[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        ahead[:, t] = (ahead[:, t - 1] @ step) * node[:, t]
        ahead[:, t] /= ahead[:, t].sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (node[:, t + 1] * back[:, t + 1]) @ step.T
        b /= b.sum(1, keepdims=True)
        back[:, t] = np.where((t < size - 1)[:, None], b, 1)
    both = ahead * back
    both /= both.sum(2, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(1, length):
        live = t < size
        x = ahead[live, t - 1][:, :, None] * step * (node[live, t] * back[live, t])[:, None, :]
        pairs += (x * (weight[live] / x.sum((1, 2)))[:, None, None]).sum(0)
    return both[:, :, 1], pairs


def _padded(values: np.ndarray, chain: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Values of the given chains as rows, and where each value stands."""
    row = np.repeat(np.arange(len(chain)), size)
    col = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(chain), int(size.max())))
    out[row, col] = values[np.repeat(chain, size) + col]
    return out, (row, col)


def marginals(model: Model, tokens: Tokens) -> np.ndarray:
    """The toxic tag's probability for each token; chains without a chosen feature share one answer for each length."""
    n = len(tokens.start)
    p = np.zeros(n)
    if not n:
        return p
    who, what = model.hits(tokens)
    emit = model.emissions(n, who, what)
    of = np.repeat(np.arange(len(tokens.chain)), tokens.size)
    plain = np.ones(len(tokens.chain), bool)
    plain[of[who]] = False
    for length in np.unique(tokens.size[plain]):
        row, _ = forward_backward(np.full((1, length), model.bias), np.array([length]), model.moves)
        at = tokens.chain[plain & (tokens.size == length)]
        p[(at[:, None] + np.arange(length)).ravel()] = np.tile(row[0], len(at))
    rest = np.flatnonzero(~plain)
    rest = rest[np.argsort(tokens.size[rest], kind="stable")]
    for s in range(0, len(rest), 4096):
        chain, size = tokens.chain[rest[s : s + 4096]], tokens.size[rest[s : s + 4096]]
        rows, (r, c) = _padded(emit, chain, size)
        p[np.repeat(chain, size) + c] = forward_backward(rows, size, model.moves)[0][r, c]
    return p


def _summary(p: np.ndarray, tokens: Tokens) -> np.ndarray:
    """What the score of a document rests on: its largest marginal, their sum, and their sum against its length."""
    n = len(tokens.offs) - 1
    count = np.diff(tokens.first)
    total = np.bincount(tokens.doc, weights=p, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, tokens.doc, p)
    return np.column_stack([np.ones(n), top, np.log1p(total), total / np.sqrt(count + 1.0), total / (count + 1.0)])


def _choose(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Codes of features that are clearly commoner in toxic documents."""
    chosen = []
    n1, n0 = toxic.sum(), (~toxic).sum()
    for at, code in tokens.features():
        key = textops.mix(code) ^ textops.mix(tokens.doc[at].astype(np.uint64) + np.uint64(7))
        _, one = np.unique(key, return_index=True)  # once a document
        distinct, which = np.unique(code[one], return_inverse=True)
        in1 = np.bincount(which, weights=toxic[tokens.doc[at[one]]], minlength=len(distinct))
        in0 = np.bincount(which, minlength=len(distinct)) - in1
        p1, p0 = (in1 + 0.5) / (n1 + 1), (in0 + 0.5) / (n0 + 1)
        clear = (p1 - p0) / np.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
        chosen.append(distinct[(clear >= CLEAR) & (p1 >= TIMES * p0) & (in1 >= LEAST_DOCS)])
    return np.unique(np.concatenate(chosen))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        while loss(w - d) > loss(w) and np.abs(d).max() >= 1e-8:  # a rare label's first steps may go too far
            d /= 2
        w -= d
        if np.abs(d).max() < 1e-8:
            break
    return w


def _kinds(size: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One chain of each length and weight, and how many it stands for: without a chosen feature chains differ in nothing else."""
    _, first, times = np.unique(np.stack([size, weight], 1), axis=0, return_index=True, return_counts=True)
    return first, times


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 60, weight: np.ndarray | None = None) -> Model:
    """Fit the field on the even rows of a sample and the curve on the odd ones; each row counts by its weight."""
    empty = np.zeros(0)
    weight = np.ones(len(texts)) if weight is None else weight
    base = float(np.average(toxic, weights=weight)) if len(toxic) else 0.0
    model = Model(np.zeros(0, np.uint64), empty, 0.0, np.zeros((2, 2)), empty, base)
    half = np.arange(len(texts)) % 2 == 0
    if any(x.all() or not x.any() for x in (toxic[half], toxic[~half])):  # also where there is none
        return model
    part = lambda m: Tokens(*textops.batch(pa.array([t for t, k in zip(texts, m, strict=True) if k], pa.string())))
    tokens = part(half)
    model.codes = _choose(tokens, toxic[half])
    model.weights = np.zeros(len(model.codes))
    n = len(tokens.start)
    who, what = model.hits(tokens)
    tag = np.zeros(n)
    tag[who] = toxic[half][tokens.doc[who]]
    of_token = weight[half][tokens.doc]
    of = np.repeat(np.arange(len(tokens.chain)), tokens.size)
    mixed = np.unique(of[who])
    plain = np.setdiff1d(np.arange(len(tokens.chain)), mixed)
    first, times = _kinds(tokens.size[plain], of_token[tokens.chain[plain]])
    chains = [(mixed, np.ones(len(mixed))), (plain[first], times)]
    observed = np.zeros((2, 2))
    same = np.flatnonzero(of[1:] == of[:-1])
    np.add.at(observed, (tag[same].astype(int), tag[same + 1].astype(int)), of_token[same])
    size_w = len(model.codes)
    theta = np.concatenate([np.zeros(size_w), [-3.0], np.zeros(4)])
    mean, power = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        model.weights, model.bias, model.moves = theta[:size_w], float(theta[size_w]), theta[size_w + 1 :].reshape(2, 2)
        emit = model.emissions(n, who, what)
        p, pairs, bias = np.zeros(n), np.zeros((2, 2)), 0.0
        for chosen, times in chains:
            if not len(chosen):
                continue
            chain, size = tokens.chain[chosen], tokens.size[chosen]
            rows, (r, c) = _padded(emit, chain, size)
            got, two = forward_backward(rows, size, model.moves, of_token[chain] * times)
            at = np.repeat(chain, size) + c
            p[at] = got[r, c]
            pairs += two
            bias += (of_token[at] * np.repeat(times, size) * (p[at] - tag[at])).sum()
        g = np.concatenate([np.bincount(what, weights=of_token[who] * (p[who] - tag[who]), minlength=size_w), [bias], (pairs - observed).ravel()]) / max(1.0, of_token @ tag) + 1e-3 * theta
        mean, power = 0.9 * mean + 0.1 * g, 0.99 * power + 0.01 * g * g
        theta = theta - 0.3 * (mean / (1 - 0.9**i)) / (np.sqrt(power / (1 - 0.99**i)) + 1e-8)
    model.weights, model.bias, model.moves = theta[:size_w], float(theta[size_w]), theta[size_w + 1 :].reshape(2, 2)
    del tokens  # the halves' arrays need not stand side by side
    held = part(~half)
    model.curve = _logistic(_summary(marginals(model, held), held), toxic[~half].astype(float), weight[~half])
    return model


def _sampled(text: Column, key: Column) -> Column:
    """A text of more than SAMPLE_TEXT characters as the chunks, from all over it, whose hash falls in a share of that size."""
    share = F.ceil(F.length(text) / SAMPLE_TEXT)
    places = F.sequence(F.lit(0), F.ceil(F.length(text) / SAMPLE_CHUNK).cast("int") - 1)
    chosen = F.filter(places, lambda i: F.pmod(F.xxhash64(key, i), share) == 0)
    return F.when(share > 1, F.array_join(F.transform(chosen, lambda i: F.substr(text, i * SAMPLE_CHUNK + 1, F.lit(SAMPLE_CHUNK))), "\n")).otherwise(text)


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `rows` labelled documents of each label: those with the smallest hash of their doc_id.

    usable, on the labels' doc_id, says which may be learnt from. Of several
    labels of one document the largest counts; null labels, ids and texts don't.
    Where a label has more than `rows` documents, each drawn one counts for all
    it stands for, relative to the other label's. Documents of one id are each
    an example, but 2 * rows in all at most. Of a text of more than SAMPLE_TEXT
    characters about so many are learnt from, in chunks from all over it. So
    what comes to the driver is bounded by rows and characters. Empty tables
    give a model that says the labels' share, or 0.
    """
    marks = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(toxic).cast("int").alias("toxic")).where("id is not null and toxic is not null")
    if usable is not None:
        marks = marks.where(usable)
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    ids = [r for t in ("toxic > 0", "toxic <= 0") for r in marks.where(t).orderBy(F.xxhash64("id"), "id").limit(rows).collect()]
    total = {r["bad"]: r["n"] for r in marks.groupBy((F.col("toxic") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()}
    if not ids:
        return fit([], np.zeros(0, bool))
    chosen = docs.sparkSession.createDataFrame(ids, "id long, toxic int")
    found = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body")).where("body is not null").join(F.broadcast(chosen), "id")
    found = found.select("id", "toxic", _sampled(F.col("body"), F.col("id")).alias("text"))
    sample = found.orderBy(F.xxhash64("id"), F.xxhash64("text")).limit(2 * rows).toArrow()
    sample = sample.sort_by([("id", "ascending"), ("text", "ascending")])
    bad = np.array(sample["toxic"].to_pylist(), int) > 0
    stands = {k: n / min(n, rows) for k, n in total.items()}  # labels for each drawn one
    least = min(stands.values())
    texts = sample["text"].to_pylist()
    del sample
    try:
        return fit(texts, bad, weight=np.array([stands[k] / least for k in bad.tolist()]))
    finally:  # else the driver keeps what fitting took
        del texts
        textops.give_back()


def scores(model: Model, p: np.ndarray, tokens: Tokens) -> np.ndarray:
    """Each text's probability of label 1, from its tokens' marginals."""
    if not len(model.curve):
        return np.full(len(tokens.offs) - 1, model.base)
    return 1 / (1 + np.exp(-np.clip(_summary(p, tokens) @ model.curve, -30, 30)))


def below(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below a limit, each judged as by score()."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textops.slices(batch):
                tokens = Tokens(*textops.batch(b.column(b.schema.get_field_index(text))))
                yield b.filter(pa.array(scores(model, marginals(model, tokens), tokens) < limit))

    return docs.mapInArrow(textops.light(keep), docs.schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and the toxic spans (code points, ends exclusive) of every text.

    A null or empty text has no tokens and no spans; its score is that of an
    empty summary. Every row is scored by itself from its text alone, whether
    its doc_id is null or repeated; a long text is scored whole. An empty table
    gives an empty result, and columns other than id and text are ignored.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textops.slices(batch):
                buf, offs = textops.batch(b.column(1))
                tokens = Tokens(buf, offs)
                p = marginals(model, tokens)
                spans = [[] for _ in range(b.num_rows)]
                at = np.flatnonzero(p >= 0.5)
                point = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))  # code points before each byte
                base = point[offs[tokens.doc[at]]]
                for d, s, e in zip(tokens.doc[at].tolist(), (point[tokens.start[at]] - base).tolist(), (point[tokens.end[at]] - base).tolist(), strict=True):
                    spans[d].append({"start": s, "end": e})
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(model, p, tokens)), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textops.light(mark), RESULT)
