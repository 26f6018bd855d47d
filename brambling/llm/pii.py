"""Personal data: exact patterns, and a character BiLSTM with CRF transitions that adds what they miss.

The network is written and trained in numpy on labelled spans: windows of a bounded sample of documents,
tagged by the patterns, and spelling variants of the spans found (other separators, other prefixes, new
digits and letters).  Every place with a digit or an at-sign, without which no kind can be written, is seen in
overlapping windows; tags are decoded per window, spans from all windows of a document are merged, checked for
form, and reconciled at once: patterns stay, and of the rest the heaviest set without overlap is taken.

Defined cases: a null or empty text has no spans; ties between equal weights go to the earlier span; with no
labelled span in the sample only the patterns speak; copies get equal spans; an empty table gives no rows; extra
columns are ignored.  Patterns run in time linear in the text; offsets are code points.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brambling.llm.common import col, settle

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_WINDOWS = 800, 1_500     # bounds of what is learned from
WIDTH, STRIDE = 64, 32
MIN_SCORE = 0.9
_TAGS = 1 + 2 * len(KINDS)                   # outside, then begin and inside of each kind
Span = tuple[str, int, int]

# ---- patterns ----

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """An address begins where its run of local characters begins, so each at-sign is looked at once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start."""
    if not text or not _TRIGGER.search(text):
        return []
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def plausible(kind: str, text: str) -> bool:
    """Whether a span the network proposes has the form of its kind."""
    digits = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        parts = re.split(r"[. ]+", text)
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9][0-9 ./_-]+[0-9]", text)) and 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 2
    groups = re.split(r"[^0-9]+", text.strip("+("))
    return bool(re.fullmatch(r"(?:\+|00|\()[0-9 ()./-]+[0-9]", text)) and 8 <= len(digits) <= 15 and len(groups) >= 3


# ---- the network ----

_CHARS = 128


def _codes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < _CHARS, code, 1).astype(np.int32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class Network:
    """Embedding, one LSTM in each direction, a linear layer, and CRF transitions."""
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 3, d: int = 12, h: int = 16) -> "Network":
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float64)
        p = {"embed": rng.normal(0, 0.3, (_CHARS, d)), "out": draw(2 * h, _TAGS), "bias": np.zeros(_TAGS), "step": np.zeros((_TAGS, _TAGS)), "first": np.zeros(_TAGS)}
        for side in "fb":
            p[f"x{side}"], p[f"h{side}"], p[f"c{side}"] = draw(d, 4 * h), draw(h, 4 * h), np.zeros(4 * h)
            p[f"c{side}"][h:2 * h] = 1.0          # remember at first
        return Network(p)

    def _lstm(self, x: np.ndarray, side: str):
        """(N, T, d) -> states (N, T, h) and what the way back needs."""
        p, n, length = self.p, x.shape[0], x.shape[1]
        h = p[f"h{side}"].shape[0]
        z = x @ p[f"x{side}"] + p[f"c{side}"]
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        states, kept = np.empty((n, length, h)), []
        for t in range(length):
            a = z[:, t] + state @ p[f"h{side}"]
            gate = _sigmoid(a[:, :3 * h])
            i, f, o, g = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:], np.tanh(a[:, 3 * h:])
            before, cell = cell, f * cell + i * g
            out = np.tanh(cell)
            kept.append((i, f, o, g, before, out, state))
            state = o * out
            states[:, t] = state
        return states, kept

    def _lstm_back(self, x, side, kept, grad, into):
        p = self.p
        h = p[f"h{side}"].shape[0]
        dz = np.empty((*grad.shape[:2], 4 * h))
        dstate, dcell = np.zeros((len(x), h)), np.zeros((len(x), h))
        for t in range(grad.shape[1] - 1, -1, -1):
            i, f, o, g, before, out, state = kept[t]
            ds = grad[:, t] + dstate
            dcell = dcell + ds * o * (1 - out * out)
            step = dz[:, t]
            step[:, :h], step[:, h:2 * h] = dcell * g * i * (1 - i), dcell * before * f * (1 - f)
            step[:, 2 * h:3 * h], step[:, 3 * h:] = ds * out * o * (1 - o), dcell * i * (1 - g * g)
            into[f"h{side}"] += state.T @ step
            dstate, dcell = step @ p[f"h{side}"].T, dcell * f
        flat = dz.reshape(-1, 4 * h)
        into[f"x{side}"] += x.reshape(-1, x.shape[2]).T @ flat
        into[f"c{side}"] += flat.sum(0)
        return dz @ p[f"x{side}"].T

    def emissions(self, codes: np.ndarray, keep: bool = False):
        x = self.p["embed"][codes]
        ahead, kept_f = self._lstm(x, "f")
        back, kept_b = self._lstm(x[:, ::-1], "b")
        both = np.concatenate([ahead, back[:, ::-1]], 2)
        scores = both @ self.p["out"] + self.p["bias"]
        return (scores, (x, both, kept_f, kept_b)) if keep else scores

    def _forward_backward(self, e):
        step, length = self.p["step"], e.shape[1]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.p["first"]
        for t in range(1, length):
            alpha[:, t] = e[:, t] + _lse(alpha[:, t - 1][:, :, None] + step, 1)
        for t in range(length - 2, -1, -1):
            beta[:, t] = _lse(step + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        return alpha, beta, _lse(alpha[:, -1], 1)

    def loss_and_gradient(self, codes, tags):
        """Mean negative log-likelihood of the tags, and its gradient."""
        e, (x, both, kept_f, kept_b) = self.emissions(codes, True)
        alpha, beta, whole = self._forward_backward(e)
        n, length = tags.shape
        rows, places = np.arange(n)[:, None], np.arange(length)[None]
        right = e[rows, places, tags].sum(1) + self.p["first"][tags[:, 0]] + self.p["step"][tags[:, :-1], tags[:, 1:]].sum(1)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(alpha + beta - whole[:, None, None])
        grad["first"] += de[:, 0].sum(0)
        pair = np.exp(alpha[:, :-1, :, None] + self.p["step"] + (e + beta)[:, 1:, None, :] - whole[:, None, None, None])
        grad["step"] += pair.sum((0, 1))
        np.add.at(grad["step"], (tags[:, :-1], tags[:, 1:]), -1)
        np.add.at(grad["first"], tags[:, 0], -1)
        de[rows, places, tags] -= 1
        grad["out"] += both.reshape(-1, both.shape[2]).T @ de.reshape(-1, _TAGS)
        grad["bias"] += de.sum((0, 1))
        dboth = de @ self.p["out"].T
        h = both.shape[2] // 2
        dx = self._lstm_back(x, "f", kept_f, dboth[:, :, :h], grad)
        dx = dx + self._lstm_back(x[:, ::-1], "b", kept_b, dboth[:, ::-1, h:], grad)[:, ::-1]
        np.add.at(grad["embed"], codes, dx)
        return float((whole - right).mean()), {k: v / n for k, v in grad.items()}

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tag sequence of every window and the posterior of each of its tags."""
        e = self.emissions(codes)
        alpha, beta, whole = self._forward_backward(e)
        best, came = e[:, 0] + self.p["first"], np.empty(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            ways = best[:, :, None] + self.p["step"]
            came[:, t] = ways.argmax(1)
            best = ways.max(1) + e[:, t]
        tags = np.empty(e.shape[:2], np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(e.shape[1] - 1, 0, -1):
            tags[:, t - 1] = came[np.arange(len(e)), t, tags[:, t]]
        sure = np.exp(np.take_along_axis(alpha + beta, tags[:, :, None], 2)[:, :, 0] - whole[:, None])
        return tags, sure


def train(codes: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 48, rate: float = 0.012, seed: int = 9) -> Network:
    """Adam over shuffled batches; the rate falls linearly."""
    net, rng = Network.fresh(), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    steps = max(1, epochs * -(-len(codes) // batch))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            _, grad = net.loss_and_gradient(codes[rows], tags[rows])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            t += 1
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.p[k] -= rate * (1 - t / (steps + 1)) * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return net


# ---- windows ----

def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at-sign."""
    at = np.array([m.start() for m in _TRIGGER.finditer(text)], np.int64)
    if not len(at):
        return []
    last = at // STRIDE
    blocks = np.unique(np.concatenate([last, last - 1]))
    return [int(b) * STRIDE for b in blocks if b >= 0]


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WIDTH, np.int32)
    part = codes[start:start + WIDTH]
    out[:len(part)] = part
    return out


def _tagged(spans: list[Span], start: int) -> np.ndarray:
    tags = np.zeros(WIDTH, np.int64)
    for kind, lo, hi in spans:
        a, b = max(lo - start, 0), min(hi - start, WIDTH)
        if a < b:
            k = 1 + 2 * KINDS.index(kind)
            tags[a:b] = k + 1
            if lo >= start:
                tags[a] = k
    return tags


def _variant(kind: str, span: str, rng) -> str:
    """Another spelling of a span, still of its kind to a reader."""
    fresh = "".join(rng.choice(list("0123456789")) if c.isdigit() else rng.choice(list("abcdefghijklmnopqrstuvwxyz")) if c.islower() else c for c in span)
    if kind == "email":
        return fresh.replace("@", rng.choice(["@", " @ ", "@"]), 1)
    if kind == "card":
        digits = _digits(fresh)[:int(rng.choice([13, 15, 16, 16]))]
        sep = str(rng.choice([" ", "-", ".", "  ", "/", ""]))
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "phone":
        lead = str(rng.choice(["+", "00", "("]))
        rest = fresh[1:]
        if lead == "(":
            rest = rest[:2] + ") " + rest[2:].lstrip(" )")
        return lead + rest.replace(" ", str(rng.choice([" ", ".", "-", "/"])))
    return fresh


def examples(texts: list[str], limit: int = SAMPLE_WINDOWS, seed: int = 21) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags from the patterns, as found and with one varied spelling per span."""
    rng = np.random.default_rng(seed)
    codes, tags = [], []
    for text in texts:
        spans = base_spans(text)
        flat = sorted((lo, hi, kind) for kind, lo, hi in spans)
        clear = [s for i, s in enumerate(flat) if all(s[1] <= o[0] or o[1] <= s[0] for o in flat[:i])]   # tags need one kind a place
        plain = [(k, lo, hi) for lo, hi, k in clear]
        code = _codes(text)
        starts = window_starts(text)
        for start in starts[:12]:
            codes.append(_window(code, start))
            tags.append(_tagged(plain, start))
        for lo, hi, kind in clear[:6]:
            other = _variant(kind, text[lo:hi], rng)
            start = max(0, lo - int(rng.integers(4, 24)))
            changed = text[start:lo] + other + text[hi:hi + WIDTH]
            codes.append(_window(_codes(changed), 0))
            # spans next to it are left out of the changed window's tags only if they are not in it
            shift = len(other) - (hi - lo)
            moved = [(k, a - start, b - start) if b <= lo else (k, a - start + shift, b - start + shift) for k, a, b in plain if (k, a, b) != (kind, lo, hi)]
            tags.append(_tagged([*moved, (kind, lo - start, lo - start + len(other))], 0))
        if len(codes) >= limit:
            break
    if not codes or not any(t.any() for t in tags):
        return np.zeros((0, WIDTH), np.int32), np.zeros((0, WIDTH), np.int64)
    return np.stack(codes[:limit]), np.stack(tags[:limit])


def _proposals(net: Network, texts: list[str], batch: int = 256) -> list[list[tuple[str, int, int, float]]]:
    """Spans read off the decoded windows of each text, with their mean posterior."""
    places = [(i, s) for i, t in enumerate(texts) for s in window_starts(t)]
    coded = {i: _codes(texts[i]) for i in {i for i, _ in places}}
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for at in range(0, len(places), batch):
        part = places[at:at + batch]
        tags, sure = net.decode(np.stack([_window(coded[i], s) for i, s in part]))
        for row in np.flatnonzero(tags.any(1)):
            i, start = part[row]
            t, t_len = tags[row], min(WIDTH, len(texts[i]) - start)
            pos = 0
            while pos < t_len:
                if not t[pos]:
                    pos += 1
                    continue
                kind = (t[pos] - 1) // 2
                end = pos + 1
                while end < t_len and t[end] == 2 + 2 * kind:
                    end += 1
                out[i].append((KINDS[kind], start + pos, start + end, float(sure[row, pos:end].mean())))
                pos = end
    return out


def reconcile(text: str, base: list[Span], proposed: list[tuple[str, int, int, float]]) -> list[Span]:
    """Merge what neighbouring windows saw of one span, drop what the patterns hold or forbid, keep the heaviest set."""
    merged: list[list] = []
    for kind, lo, hi, score in sorted(proposed, key=lambda s: (s[0], s[1], s[2])):
        if merged and merged[-1][0] == kind and lo < merged[-1][2]:
            merged[-1][2], merged[-1][3] = max(hi, merged[-1][2]), max(score, merged[-1][3])
        else:
            merged.append([kind, lo, hi, score])
    taken = sorted((lo, hi) for _, lo, hi in base)
    reach = list(np.maximum.accumulate([hi for _, hi in taken])) if taken else []

    def free(lo: int, hi: int) -> bool:
        k = bisect.bisect_left(taken, (hi,))
        return not k or reach[k - 1] <= lo

    new = []
    for kind, lo, hi, score in merged:
        while lo < hi and not (text[lo].isalnum() or text[lo] in "+("):
            lo += 1
        while lo < hi and not text[hi - 1].isalnum():
            hi -= 1
        edge = (not lo or not text[lo - 1].isalnum()) and (hi == len(text) or not text[hi].isalnum())
        if lo < hi and score >= MIN_SCORE and edge and free(lo, hi) and plausible(kind, text[lo:hi]):
            new.append((hi, lo, kind, score * (hi - lo)))
    new.sort()
    ends, best = [s[0] for s in new], [(0.0, None, -1)]
    for k, (hi, lo, kind, weight) in enumerate(new):
        before = bisect.bisect_right(ends, lo, 0, k)
        with_it = best[before][0] + weight
        best.append((with_it, k, before) if with_it > best[k][0] else (best[k][0], None, k))
    out, k = list(base), len(new)
    while k > 0:
        _, used, before = best[k]
        if used is not None:
            out.append((new[used][2], new[used][1], new[used][0]))
        k = before
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


# ---- tables ----

def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Train on windows of at most ``sample_docs`` different texts with a digit or an at-sign; None if no span is labelled."""
    some = docs.filter(col(text).rlike("[0-9@]")).select(F.xxhash64(col(text)).alias("h"), col(text).alias("text"))
    # the keys are chosen first, so that no task sends whole texts that are not in the sample; copies count once
    keys = settle(some.select("h").distinct().orderBy("h").limit(sample_docs))
    some = some.join(keys, "h").groupBy("h").agg(F.min("text").alias("text")).orderBy("h", "text").select("text")

    def windows(batches):
        texts = [t for b in batches for t in b.column(0).to_pylist()]
        codes, tags = examples(texts)
        yield pa.RecordBatch.from_arrays([pa.array([c.astype("<i4").tobytes() for c in codes], pa.binary()), pa.array([t.astype("i1").tobytes() for t in tags], pa.binary())], names=["codes", "tags"])

    got = some.coalesce(1).mapInArrow(windows, "codes binary, tags binary").collect()       # SAMPLE_WINDOWS rows at most
    if not got:
        return None
    read = lambda name, kind: np.stack([np.frombuffer(r[name], kind) for r in got]).astype(np.int64)
    return train(read("codes", "<i4"), read("tags", "i1"))


def find(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``row`` (the input row as a struct), ``base`` and ``spans``: arrays of (kind, start, end), by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"struct<base:{kind},spans:{kind}>")
    def spans_of(texts):
        import pandas as pd
        return pd.DataFrame(_spans(texts.tolist(), shared.value), columns=["base", "spans"])

    # only texts with a digit or an at-sign can hold anything
    none = F.array().cast(kind)
    given = docs.select(F.struct("*").alias("row"), F.when(col(text).rlike("[0-9@]"), col(text)).alias("t"))
    seen = given.select("row", spans_of("t").alias("s"))
    return seen.select("row", F.coalesce("s.base", none).alias("base"), F.coalesce("s.spans", none).alias("spans"))


def _spans(texts: list[str | None], net: Network | None) -> list[tuple[list[dict], list[dict]]]:
    texts = [t if isinstance(t, str) else "" for t in texts]
    proposed = _proposals(net, texts) if net is not None else [[]] * len(texts)
    shape = lambda spans: [{"kind": k, "start": int(a), "end": int(b)} for k, a, b in spans]
    out = []
    for text, more in zip(texts, proposed):
        base = base_spans(text)
        out.append((shape(base), shape(reconcile(text, base, more) if more else base)))
    return out


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, spans: list[dict]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the name of its first kind."""
    out, at, end = [], 0, 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= end:
            out += [text[end:s["start"]], f"[{s['kind'].upper()}]"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, net: Network | None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with personal data replaced; ``length``, if there, follows the new text."""
    @F.pandas_udf("string")
    def clean(texts, spans):
        import pandas as pd
        return pd.Series([t if t is None or s is None else redact(t, s) for t, s in zip(texts, spans)], dtype=object)

    found = find(docs, net, text)
    some = F.size("spans") > 0
    done = found.withColumn("clean", F.coalesce(clean(F.when(some, F.col("row")[text]), F.when(some, F.col("spans"))), F.col("row")[text]))
    new = {text: F.col("clean"), length: F.coalesce(F.length("clean").cast("long"), F.lit(0).cast("long"))}
    return done.select(*[new[c].cast(t).alias(c) if c in new else F.col("row")[c].alias(c) for c, t in docs.dtypes])
