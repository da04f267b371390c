"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased, and everything but letters becomes one blank. Per language, 4-gram counts give the full interpolated
probabilities of all seen 4-, 3-, 2- and 1-grams and the backoff weights of their contexts, each in an array sorted by
the packed n-gram. A text goes to the language with the least cross-entropy per character; all characters count.
Rejection is calibrated: a language accepts a text if its cross-entropy is at most the ``quantile`` of that language's own
texts, taken on labelled texts that the counts have not seen.

The fit uses about ``sample`` labelled texts per language (chosen by a hash of the id, so reruns agree); that bounds the
work and the model, which is sent to the workers: at most ``sample`` times the n-grams of a text per language, in practice
some 100,000 n-grams. Every text is scored whole.
Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text if nothing was learnt; labels that are
null are not learnt from; ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import map_texts

SAMPLE, QUANTILE = 4000, 0.999
#: Fewest texts a language is learnt from while others of its texts are kept for its rejection limit.
FEW = 20
ORDER, SHARPNESS = 4, 10.0
_BLANK, _PAD = 0x20, 3
_CHARS = 4_000_000
#: Bytes of known 4-grams and their log probabilities that a worker keeps: a key and a number per language each.
_CACHE = 120_000_000
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def symbols(text: str) -> np.ndarray:
    """Letters of a text in lower case with one blank for anything between, padded with blanks at both ends; empty without a
    letter. Code points beyond 16 bits are folded into 16."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[cp]
    if not letter.any():
        return np.zeros(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    s = np.where(letter, cp & 0xFFFF, _BLANK)[keep]
    return np.concatenate([np.full(_PAD, _BLANK), s if s[-1] == _BLANK else np.append(s, _BLANK)]).astype(np.uint64)


def grams(s: np.ndarray) -> np.ndarray:
    """The packed 4-gram that ends at each character after the padding."""
    return s[:-3] << np.uint64(48) | s[1:-2] << np.uint64(32) | s[2:-1] << np.uint64(16) | s[3:]


@dataclass
class Level:
    """Probabilities of seen n-grams and backoff weights of their contexts, both in sorted arrays."""
    keys: np.ndarray
    prob: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


@dataclass
class KneserNey:
    levels: list[Level]  # from the longest n-grams down to pairs
    singles: np.ndarray
    single_prob: np.ndarray
    floor: float

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        """Natural log of p(last | the three before) of packed 4-grams."""
        return np.log(self._prob(keys, 0))

    def _prob(self, keys: np.ndarray, depth: int) -> np.ndarray:
        if depth == len(self.levels):
            at, seen = _find(self.singles, keys)
            return np.where(seen, self.single_prob[at], self.floor)
        level = self.levels[depth]
        at, seen = _find(level.keys, keys)
        out = level.prob[at]
        rest = keys[~seen]
        if len(rest):
            ctx, known = _find(level.contexts, rest >> np.uint64(16))
            weight = np.where(known, level.weight[ctx], 1.0)
            out[~seen] = weight * self._prob(rest & np.uint64((1 << 16 * (ORDER - 1 - depth)) - 1), depth + 1)
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> KneserNey:
    """The model from distinct packed 4-grams and their counts. Lower orders count in how many contexts an n-gram was seen."""
    tables, n = [], counts.astype(float)
    for order in range(ORDER, 1, -1):
        sort = np.argsort(keys, kind="stable")
        keys, n = keys[sort], n[sort]
        tables.append((keys, n))
        keys, n = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)
        n = n.astype(float)
    uniform = 1.0 / 65536
    discount = _discount(n)
    total = n.sum()
    floor = discount * len(n) / total * uniform
    single = np.maximum(n - discount, 0) / total + floor
    singles, lower_keys, lower = keys, keys, single
    levels: list[Level] = []
    for k, (keys, n) in enumerate(reversed(tables)):
        order = k + 2
        d = _discount(n)
        context, first, size = np.unique(keys >> np.uint64(16), return_index=True, return_counts=True)
        total = np.add.reduceat(n, first)
        weight = d * size / total
        at, _ = _find(lower_keys, keys & np.uint64((1 << 16 * (order - 1)) - 1))
        prob = np.maximum(n - d, 0) / np.repeat(total, size) + np.repeat(weight, size) * lower[at]
        levels.insert(0, Level(keys, prob, context, weight))
        lower_keys, lower = keys, prob
    return KneserNey(levels, singles, single, floor)


def _discount(n: np.ndarray) -> float:
    ones, twos = (n == 1).sum(), (n == 2).sum()
    return float(min(0.95, max(0.1, ones / (ones + 2 * twos)))) if ones else 0.5


@dataclass
class Model:
    languages: list[str]
    models: list[KneserNey]
    limits: list[float] = field(default_factory=list)
    _known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    _values: np.ndarray | None = None

    def _logs(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of distinct keys under each language; keys met before come from a bounded cache."""
        if self._values is None or self._known.nbytes + self._values.nbytes > _CACHE:
            self._known, self._values = np.zeros(0, np.uint64), np.zeros((0, len(self.models)))
        at, seen = _find(self._known, keys) if len(self._known) else (None, np.zeros(len(keys), bool))
        new = keys[~seen]
        if len(new):
            values = np.stack([m.log_prob(new) for m in self.models], axis=1)
            known = np.concatenate([self._known, new])
            sort = np.argsort(known, kind="stable")
            self._known, self._values = known[sort], np.concatenate([self._values, values])[sort]
            at, _ = _find(self._known, keys)
        return self._values[at]

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of non-empty symbol arrays under each language."""
        lens = np.array([len(t) - _PAD for t in texts])
        keys, back = _distinct(np.concatenate([grams(t) for t in texts]))
        logs, starts = self._logs(keys), np.cumsum(lens) - lens
        return np.stack([-np.add.reduceat(logs[:, k][back], starts) / lens for k in range(len(self.models))], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, confidence and acceptance of each text."""
        names, scores, accepted = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
        for at, rows in _groups(texts) if self.models else ():
            h = self.entropies(rows)
            best = h.argmin(axis=1)
            least = h[np.arange(len(h)), best]
            conf = 1 / np.exp(-SHARPNESS * (h - least[:, None])).sum(axis=1)
            for i, b, e, c in zip(at, best.tolist(), least.tolist(), conf.tolist()):
                names[i], scores[i] = self.languages[b], round(c, 9)
                accepted[i] = not self.limits or e <= self.limits[b]
        return names, scores, accepted


def _groups(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts with a letter as symbols, in groups of bounded length."""
    at, rows, size = [], [], 0
    for i, t in enumerate(texts):
        s = symbols(t) if t else ()
        if len(s):
            at.append(i)
            rows.append(s)
            size += len(s)
            if size > _CHARS:
                yield at, rows
                at, rows, size = [], [], 0
    if at:
        yield at, rows


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse; with a small alphabet by a direct table instead of sorting."""
    alphabet = np.flatnonzero(np.bincount((keys & np.uint64(0xFFFF)).astype(np.int64), minlength=_BLANK + 1) + (np.arange(
        max(_BLANK + 1, int((keys & np.uint64(0xFFFF)).max()) + 1)) == _BLANK))
    a = len(alphabet)
    if a ** ORDER > 2 * _CHARS:
        return np.unique(keys, return_inverse=True)
    rank = np.zeros(65536, np.int64)
    rank[alphabet] = np.arange(a)
    code = np.zeros(len(keys), np.int64)
    for k in range(ORDER - 1, -1, -1):
        code = code * a + rank[(keys >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64)]
    there = np.zeros(a ** ORDER, bool)
    there[code] = True
    found = np.flatnonzero(there)
    place = np.zeros(a ** ORDER, np.int32)
    place[found] = np.arange(len(found))
    out = np.zeros(len(found), np.uint64)
    for k in range(ORDER):
        out |= alphabet[found // a ** k % a].astype(np.uint64) << np.uint64(16 * k)
    return out, place[code]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE,
          quantile: float = QUANTILE) -> Model:
    """Fit on a sample of the labelled texts of ``docs``; a fifth of the sample calibrates the rejection. A language with fewer
    than ``FEW`` texts outside that fifth is learnt from all of them, and nothing is rejected by it."""
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"),
                       F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(1_000_000)).alias("spot")).where("lang is not null and text is not null")
    sizes = [(r.lang, min(1.0, sample / r.n)) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not sizes:
        return Model([], [])
    rate = F.element_at(F.create_map(*[F.lit(v) for pair in sizes for v in pair]), F.col("lang"))
    drawn = rows.where(F.col("spot") < rate * 1_000_000)
    tune = F.col("spot") % 5 == 0
    enough = {r.lang for r in drawn.where(~tune).groupBy("lang").agg(F.count("*").alias("n")).collect() if r.n >= min(FEW, sample // 2)}
    few = [(name, share) for name, share in sizes if name not in enough]
    if few:
        # Repeated ids share one spot: where the draw thins out such a language, its first texts by spot and hash are taken.
        thinned = [name for name, share in few if share < 1]
        drawn = drawn.where(~F.col("lang").isin(thinned)) if thinned else drawn
        for name in thinned:
            drawn = drawn.unionByName(rows.where(F.col("lang") == name).orderBy("spot", F.xxhash64("text")).limit(sample))
        tune &= ~F.col("lang").isin([name for name, _ in few])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name in sorted(set(langs)):
                for _, parts in _groups([t for t, own in zip(texts, langs) if own == name]):
                    keys, n = np.unique(np.concatenate([grams(p) for p in parts]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                                                     ["lang", "gram", "n"])

    counts = (drawn.where(~tune).select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        model = kneser_ney(pdf["gram"].to_numpy(np.int64).view(np.uint64), pdf["n"].to_numpy())
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "model": [pickle.dumps(model)]})

    found = sorted(counts.groupBy("lang").applyInPandas(build, "lang string, model binary").collect())
    model = Model([r.lang for r in found], [pickle.loads(bytes(r.model)) for r in found])
    place = {name: k for k, name in enumerate(model.languages)}
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, parts in _groups(texts):
                h = sent.value.entropies(parts)
                mine = [(langs[i], h[k, place[langs[i]]]) for k, i in enumerate(at) if langs[i] in place]
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in mine], pa.string()), pa.array([m[1] for m in mine], pa.float64())],
                                                 ["lang", "h"])

    limits = {r.lang: r.top for r in drawn.where(tune).select("lang", "text").mapInArrow(own, "lang string, h double")
              .groupBy("lang").agg(F.percentile_approx("h", quantile, 10_000).alias("top")).collect()} if model.models else {}
    model.limits = [limits.get(name, float("inf")) for name in model.languages]
    return model


def with_language(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``lang_pred string, score double, accepted boolean`` of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.languages, model.models, model.limits))

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        names, scores, accepted = sent.value.predict([t if t is None else t.decode("utf-8", "surrogatepass") for t in texts])
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]

    return map_texts(docs, text, "lang_pred string, score double, accepted boolean", run, keep)
