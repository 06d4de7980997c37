"""Toxicity by noisy-channel deobfuscation.

Writers hide words by digits and symbols for letters, by letters set apart and by letters repeated. Each such place is a
lattice: every character may stand for itself, for letters that look like it, or for nothing. Viterbi decoding finds the
likeliest letters under the channel's costs and a character language model, which is counted over the whole corpus. The
restored words are scored with the plain ones: log odds of words and of their beginnings, learned from labelled texts,
then a logistic function of a text's highest and summed word scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, hashed, map_arrow

#: Threshold of predicted; least documents of a word; weight against rare words; score from which a word counts.
THRESHOLD, LEAST_DOCS, SHRINK, STRONG = 0.7, 2, 5.0, 1.5
#: Bytes of a word's beginning that has a score of its own, and how much of it counts.
BEGINNING, BEGINNING_PART = 6, 0.8
#: Letters that a character may stand for (fixed values).
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "&": "aeiou",
}
#: Natural logs of the channel: a letter as itself, a look-alike, a mark that stands for nothing, a letter that is repeated, a gap.
SAME, ALIKE, NOTHING, AGAIN, GAP = 0.0, -1.0, -7.0, -0.7, -0.1
#: Letter classes of the language model: the edge, a to z, and classes that all other letters share.
CLASSES = 64
#: Characters of a place that are decoded together, repeats beyond three left out. Words aren't longer; a longer place is decoded in such pieces.
LONGEST = 64
#: Decodings of a place that are scored, and how far below the best in log probability.
BEST, MARGIN = 4, 10.0

_LETTER = r"[^\W\d_]"
_SIGNS = re.escape("".join(LOOKALIKE))
_MARKS = " .-_*|/"  # between letters that are set apart
_UNIT, _GAP = rf"(?:{_LETTER}|[0-9@$!+(#%&])", rf"[{re.escape(_MARKS)}]+"
#: Letters or signs set apart; tokens of letters and signs, of which those with a sign or a doubled letter hide something.
_SPACED = re.compile(rf"(?<!\w){_UNIT}(?:{_GAP}{_UNIT}){{2,}}(?!\w)")
_TOKEN = re.compile(rf"(?:{_LETTER}|[{_SIGNS}])+")
_OFTEN = re.compile(r"(.)\1{3,}", re.S)  # a character more often than it can be meant
_TWICE = re.compile(rf"({_LETTER})\1", re.I)
_SPREAD = re.compile(rf"^{_UNIT}(?:{_GAP}{_UNIT})+$")
_PUNCTUATION = "".join(c for c in LOOKALIKE if not c.isdigit())


def hides(token: str) -> bool:
    """Whether a token has letters, and a sign among them or a letter twice in a row."""
    if token.isalpha():
        return bool(_TWICE.search(token))
    return any(map(str.isalpha, token))


def letter_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


def count_trigrams(texts: list[str]) -> np.ndarray:
    """Counts of letter trigrams of lower-cased texts; whatever isn't a letter is the edge of a word."""
    points = np.frombuffer("\n".join(["", *texts, ""]).lower().encode("utf-32-le", "replace"), dtype="<u4")
    c = _class_table()[points]
    keep = c != 0
    keep[1:] |= c[:-1] != 0
    keep[0] = True
    c = c[keep].astype(np.int64)  # words between single edges
    first = c[1:][(c[:-1] == 0) & (c[1:] != 0)]  # a word's first letter follows two edges
    inside = c[1:-1] != 0
    return np.bincount(first, minlength=CLASSES**3) + np.bincount(((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:])[inside], minlength=CLASSES**3)


_tables: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    if not _tables:
        t = np.zeros(0x110000, dtype=np.uint8)
        for k in range(0x110000):
            c = chr(k)
            if c.isalpha():
                t[k] = letter_class(c)
        _tables.append(t)
    return _tables[0]


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a letter after two others, from all rows: tasks count, one aggregate adds, CLASSES ** 3 cells at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                apart = np.insert(block.data, block.offsets[1:-1], 10)  # texts are words apart, however rows come in batches
                total += count_trigrams([apart.tobytes().decode("utf-8", "replace")])
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    got = map_arrow(rows, run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES**3)
    counts[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return smoothed(counts)


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Witten-Bell smoothing of trigrams by bigrams by single letters."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
    one = three.sum((0, 1)) + 1
    one /= one.sum()
    two = three.sum(0)
    kinds = (two > 0).sum(1, keepdims=True) + 1.0
    p2 = (two + kinds * one) / (two.sum(1, keepdims=True) + kinds)
    kinds = (three > 0).sum(2, keepdims=True) + 1.0
    return np.log((three + kinds * p2) / (three.sum(2, keepdims=True) + kinds))


def decode(shown: str, lm: np.ndarray, memo: dict | None = None) -> list[str]:
    """The likeliest words behind ``shown``, at most BEST and within MARGIN, by Viterbi: exact under the channel and the language model.

    Letters before the first sign or repeat leave one state, so what follows depends on the last two of them only; ``memo`` keeps that.
    """
    spread, lowered = bool(_SPREAD.match(shown)), shown.lower()
    n = 0
    while n < len(lowered) and lowered[n].isalpha() and (n == 0 or lowered[n] != lowered[n - 1]):
        n += 1
    a, b = ([0, 0] + [letter_class(c) for c in lowered[max(0, n - 2) : n]])[-2:]
    key = (a, b, lowered[max(0, n - 1) : n], lowered[n:], spread)
    ends = memo.get(key) if memo is not None else None
    if ends is None:
        ends = _ends(*key, lm)
        if memo is not None:
            if len(memo) > 200_000:
                memo.clear()
            memo[key] = ends
    found = [(cost, lowered[:n] + text) for cost, text in ends]
    return [text for cost, text in found if text and cost >= found[0][0] - MARGIN]


def _ends(a: int, b: int, last: str, rest: str, spread: bool, lm) -> list[tuple[float, str]]:
    """What ``rest`` may stand for behind the letters of classes a and b, of which the second is ``last``: log probability and letters, best first.

    What may follow depends on the last two classes and the last letter alone. Every such state keeps its BEST ways of
    reading the signs, so the BEST of all are found, whatever else there is.
    """
    states: dict[tuple[int, int, str], list[tuple[float, str, str]]] = {(a, b, last): [(0.0, "", last)]}
    for c in rest:
        letter = c.isalpha()
        letters = [(c, letter_class(c), SAME)] if letter else [(x, letter_class(x), ALIKE) for x in LOOKALIKE.get(c, "")]
        nothing = None if letter else GAP if spread and c in _MARKS else NOTHING
        after: dict[tuple[int, int, str], dict[str, tuple[float, str]]] = {}
        for (a, b, before), ways in states.items():
            ahead = lm[a][b]
            for x, k, how in letters:
                found, step = after.setdefault((b, k, x), {}), how + ahead[k]
                for cost, signs, text in ways:
                    read = signs if letter else signs + x
                    if read not in found or cost + step > found[read][0]:
                        found[read] = (cost + step, text + x)
            step = nothing if nothing is not None else AGAIN if before == c else None
            if step is not None:
                found = after.setdefault((a, b, before), {})
                for cost, signs, text in ways:
                    if signs not in found or cost + step > found[signs][0]:
                        found[signs] = (cost + step, text)
        if after:
            states = {key: _best([(cost, signs, text) for signs, (cost, text) in found.items()]) for key, found in after.items()}
    ends = [(float(cost + lm[a][b][0]), text) for (a, b, _), ways in states.items() for cost, _, text in ways]
    return [(cost, text[len(last) :]) for cost, text in sorted(ends, reverse=True)[:BEST]]


def _best(ways: list[tuple[float, str, str]]) -> list[tuple[float, str, str]]:
    return ways if len(ways) <= BEST else sorted(ways, reverse=True)[:BEST]


class Restorer:
    """Words restored from a text, each hidden place decoded once a worker."""

    def __init__(self, lm: np.ndarray):
        self.lm, self.seen, self.memo = lm.tolist(), {}, {}

    def decoded(self, shown: str) -> list[str]:
        shown = _OFTEN.sub(r"\1\1\1", shown)
        return [w for k in range(0, len(shown), LONGEST) for w in decode(shown[k : k + LONGEST], self.lm, self.memo)]

    def opened(self, token: str) -> list[str]:
        """What a token hides, without the words that it shows. Signs at its ends may be punctuation."""
        if not hides(token) or _SPREAD.match(token):
            return []
        found = self.decoded(token)
        core = token.strip(_PUNCTUATION)
        if core != token and hides(core):
            found = found + self.decoded(core)
        shown = {w for w in re.split(r"[\W\d_]+", token.lower()) if w}
        return [w for w in dict.fromkeys(found) if w not in shown]

    def kept(self, key, shown: str, what) -> list[str]:
        if key not in self.seen:
            if len(self.seen) > 200_000:
                self.seen.clear()
            self.seen[key] = what(shown)
        return self.seen[key]

    def __call__(self, text: str) -> list[str]:
        out, seen = [], self.seen
        for token in _TOKEN.findall(text):
            words = seen.get(token)
            if words is None:
                words = self.kept(token, token, self.opened)
            if words:
                out += words
        for m in _SPACED.finditer(text):
            shown = m.group()
            if any(map(str.isalpha, shown)):
                out += self.kept((shown,), shown, self.decoded)  # what a spaced run and a token hide is kept apart
        return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (runs of letters, lower case) and of their beginnings, and each text's first word."""
    lowered = pa.array([t.lower() for t in texts], pa.large_string())
    every = [b for b in blocks(lowered, 1 << 62)]
    if not every:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64)
    block = every[0]
    block.data = _WORDS[block.data]
    starts, ends, bounds = block.words()
    return hashed(block.data, starts, ends), hashed(block.data, starts, np.minimum(ends, starts + BEGINNING)), bounds


_WORDS = np.full(256, 32, dtype=np.uint8)
_WORDS[97:123] = np.arange(97, 123)
_WORDS[128:] = np.arange(128, 256)


class Lexicon:
    """Scores of words and of beginnings by hash."""

    def __init__(self, words: dict[int, float], beginnings: dict[int, float]):
        self.tables = []
        for t in (words, beginnings):
            keys = np.array(sorted(t), dtype=np.uint64)
            self.tables.append((keys, np.array([t[int(k)] for k in keys])))

    def scores(self, words: np.ndarray, beginnings: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words))
        for (keys, values), h, part in zip(self.tables[::-1], (beginnings, words), (BEGINNING_PART, 1.0), strict=True):
            if len(keys) and len(h):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                out = np.where(keys[at] == h, part * values[at], out)
        return out


def log_odds(keys: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[int, float]:
    """Log odds of a key's documents, label 1 against 0, drawn to 0 where documents are few."""
    owner = np.repeat(np.arange(len(y)), np.diff(bounds))
    pairs = np.unique(np.stack([keys, owner.astype(np.uint64)]), axis=1)
    key, at = np.unique(pairs[0], return_inverse=True)
    label = y[pairs[1].astype(np.int64)]
    d1, d0 = np.bincount(at, weights=label, minlength=len(key)), np.bincount(at, weights=1 - label, minlength=len(key))
    s = np.log((d1 + 0.5) / (y.sum() + 1)) - np.log((d0 + 0.5) / ((1 - y).sum() + 1))
    s *= (d1 + d0) / (d1 + d0 + SHRINK)
    use = d1 + d0 >= LEAST_DOCS
    return dict(zip(key[use].tolist(), s[use].tolist(), strict=True))


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Per restored text: highest word score, logs of the sum and of the number of strong words, and their share."""
    words, beginnings, bounds = word_hashes(texts)
    s = lexicon.scores(words, beginnings)
    x = np.zeros((len(texts), 4))
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    if len(full):
        at = bounds[:-1][full]
        x[full, 0] = np.maximum(0, np.maximum.reduceat(s, at))
        strong = s > STRONG
        x[full, 1] = np.log1p(np.add.reduceat(np.where(strong, s, 0), at))
        x[full, 2] = np.log1p(np.add.reduceat(strong.astype(np.float64), at))
        x[full, 3] = np.minimum(5.0, 100 * np.add.reduceat(strong.astype(np.float64), at) / n[full])
    return x


class Model:
    def __init__(self, prior: float, lm: np.ndarray, lexicon: Lexicon | None = None, weights: np.ndarray | None = None):
        self.prior, self.lm, self.lexicon, self.weights = prior, lm, lexicon, weights

    def scores(self, texts: list[str], restore: Restorer) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        z = np.c_[features([f"{t} {' '.join(restore(t))}" for t in texts], self.lexicon), np.ones(len(texts))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge @ w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, g)
    return w


def fit(sample: list[tuple[str, int]], lm: np.ndarray) -> Model:
    """Learn from (text, label) pairs. Words that weigh a text come from the other half, so no text vouches for its own."""
    y = np.array([label for _, label in sample], dtype=np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y)) < 2:
        return Model(prior, lm)
    restore = Restorer(lm)
    texts = [f"{t} {' '.join(restore(t))}" for t, _ in sample]

    def lexicon(rows):
        words, beginnings, bounds = word_hashes([texts[k] for k in rows])
        return Lexicon(log_odds(words, bounds, y[rows]), log_odds(beginnings, bounds, y[rows]))

    halves = np.arange(len(y)) % 2
    x = np.zeros((len(y), 4))
    for h in (0, 1):
        rows = np.flatnonzero(halves == h)
        x[rows] = features([texts[k] for k in rows], lexicon(np.flatnonzero(halves != h)))
    return Model(prior, lm, lexicon(np.arange(len(y))), _logistic(x, y))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text. Returns the id, the columns in ``keep``, score and predicted (score >= threshold).

    Null and empty texts have no words and get the score that the model gives that, as does every text of equal words, so
    repeated rows give repeated results and there are no ties to break. Long texts are read whole, in time linear in their
    length. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    columns = [id_col, *keep]
    told = docs.sparkSession.sparkContext.broadcast(model)  # a language model of CLASSES ** 3 cells and the sample's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        restore = Restorer(model.lm)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            score, at = [], 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (size == 0 or size + len(texts[upto]) <= 2_000_000):
                    size += len(texts[upto]) + 1
                    upto += 1
                score.append(model.scores(texts[at:upto], restore))
                at = upto
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=[*[f"c{k}" for k in range(len(columns))], "score"])

    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)], F.col(f"`{text_col}`").cast("string").alias("text"))
    out = map_arrow(rows, run, ", ".join([*[f"c{k} {kind}" for k, kind in enumerate(kinds)], "score double"]))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
