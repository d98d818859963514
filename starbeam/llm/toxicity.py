"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton over folded text.

Folding maps a text to lower-case words separated by single blanks: look-alike letters of other
alphabets and accented letters become the Latin letter, digits become the letter they stand in for,
``@`` and ``$`` do so between letters, and characters without width vanish.

The lexicon holds whole words and word beginnings (stems, of which the word goes on) with weights. It is learned from labelled
rows: features that at least ``support`` toxic rows have and hardly any clean row, chosen greedily
so that every toxic row is covered up to ``COVER`` times, weighted by their log odds. A match
inside an exception phrase does not count. The score of a text is a logistic function of the
summed weights and of that sum over the number of words, fitted on the same rows.

Learning uses a bounded sample, ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean labelled rows with the
smallest hashes of their ids, and never a row whose crc32(id as text) mod 5 is 0. Everything else,
the scoring above all, runs over all rows; language, source and id are no inputs.

Defined results: a null or empty text has no match and gets the score of a text without matches; an
unlabelled or empty table falls back to ``DEFAULT_WORDS``; rows repeated in ``labels`` count as toxic
if any of them is; null ids are scored and are not held out.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starbeam.llm import common
from starbeam.llm import textscan as ts

TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
CANDIDATES, LEXICON = 50_000, 512
COVER, LEAST_SUPPORT = 3, 3
STEMS = (3, 4, 5, 6, 7, 8, 9)

#: Greek and Cyrillic letters drawn like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ς": "s", "σ": "o",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ø": "o", "đ": "d", "ł": "l", "ß": "s",
}
#: Digits and signs written for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "2": "z"}
SIGNS = {"@": "a", "$": "s"}
DEFAULT_WORDS = ("idiot", "moron", "scum", "stupid", "pathetic", "worthless", "disgusting", "loser")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "stupid simple", "class clown school")


@functools.cache
def fold_table() -> np.ndarray:
    """Folded code point of each code point: 0x20 for separators, 0 for characters that vanish."""
    out = np.full(0x110000, 0x20, np.uint32)
    for p in range(0x110000):
        c = chr(p)
        kind = unicodedata.category(c)
        if kind in ("Mn", "Me", "Cf"):
            out[p] = 0
        elif kind[0] == "L" or c in STAND_INS:
            low = c.lower()
            base = unicodedata.normalize("NFKD", low)[:1] or low
            base = base.lower()[:1]
            out[p] = ord(STAND_INS.get(base) or LOOK_ALIKES.get(base) or base)
    return out


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray]:
    """(folded text of all rows, one blank around every word and a line feed between rows; offset of each row's first blank)."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    # a border of blank, line feed, blank before every row and after the last: nothing is read across it
    border = np.repeat(place[offsets], 3)
    mark = np.tile(np.array([0x20, 0x0A, 0x20], np.uint32), len(offsets))
    points = np.insert(points, border, np.uint32(0x20))
    folded = fold_table()[points]
    rows = place[offsets] + 3 * np.arange(len(offsets)) + 2
    inner = np.ones(len(points), bool)
    inner[rows], inner[rows - 1], inner[rows - 2] = False, False, False
    for sign, letter in SIGNS.items():
        at = np.flatnonzero((points == ord(sign)) & inner)
        at = at[(folded[at - 1] != 0x20) & (folded[at + 1] != 0x20)]
        folded[at] = ord(letter)
    folded[~inner] = mark
    keep = folded != 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    folded, rows = folded[keep], kept[rows]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    kept = np.concatenate([[0], np.cumsum(keep)])
    return folded[keep].astype("<u4").tobytes().decode("utf-32-le"), kept[rows + 1] - 1


@dataclass
class Model:
    """Weights by pattern (" stem" or " word "), exception phrases, and the logistic function's three numbers."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, float, float]

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            out.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            pattern = f" {phrase} "
            if pattern not in self.weights:
                out.add_word(pattern, (len(pattern), None))
        out.make_automaton()
        return out


def default_model() -> Model:
    return Model({f" {w} ": 4.0 for w in DEFAULT_WORDS}, EXCEPTIONS, (-4.0, 4.0, 0.5))


def evidence(automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(summed weights of matches outside exception phrases, number of words) of each row."""
    n = len(offsets) - 1
    text, rows = fold(data, offsets)
    ends, sizes, weights, excepted = [], [], [], []
    for end, (size, weight) in automaton.iter(text) if len(automaton) else ():
        if weight is None:
            excepted.append((end - size + 1, end))
        else:
            ends.append(end)
            sizes.append(size)
            weights.append(weight)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blanks = np.concatenate([[0], np.cumsum(points == 0x20)])
    words = np.maximum(blanks[rows[1:]] - blanks[rows[:-1]] - 1, 0)
    total = np.zeros(n)
    if ends:
        end, size, weight = np.array(ends), np.array(sizes), np.array(weights)
        if excepted:
            # a match lies inside a phrase if one that begins no later ends no earlier
            begin, stop = np.array(sorted(excepted)).T
            before = np.searchsorted(begin, end - size + 1, "right") - 1
            weight[(before >= 0) & (np.maximum.accumulate(stop)[np.maximum(before, 0)] >= end)] = 0.0
        # a stem counts where its word goes on; of stems and words that start together, the heaviest counts
        start = end - size + 1
        weight[points[np.minimum(end + 1, len(points) - 1)] == np.where(points[end] == 0x20, 0xFFFFFFFF, 0x20)] = 0.0
        order = np.lexsort((-weight, start))
        first = np.concatenate([[True], start[order][1:] != start[order][:-1]])
        chosen = order[first]
        row = np.searchsorted(rows, start[chosen], "right") - 1
        np.add.at(total, np.minimum(row, n - 1), weight[chosen])
    return total, words


def features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(100.0 * total / np.maximum(words, 1))], axis=1)


def probability(coefficients, total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(features(total, words) @ np.array(coefficients), -30, 30)))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_rows: int, clean_rows: int) -> DataFrame:
    """(text, toxic) of the bounded sample, distinct texts only, stored."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("labelled_id")).agg(F.max("toxic").alias("toxic"))
    sample = None
    for value, most in ((1, toxic_rows), (0, clean_rows)):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most)
        sample = part if sample is None else sample.unionByName(part)
    # at most toxic_rows + clean_rows ids: 16 bytes each
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("row_id") == F.col("labelled_id"))
    return common.stored(rows.where("text is not null").select("text", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["text"]))


def _row_features(text: str) -> set[str]:
    out = set()
    for word in set(text.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in STEMS if n < len(word))
    return out


def _folded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    for batch in batches:
        for part, data, offsets in ts.text_groups(batch, "text"):
            text, rows = fold(data, offsets)
            for a, b, y in zip(rows[:-1].tolist(), rows[1:].tolist(), part.column("toxic").to_pylist()):
                yield text[a:b], y


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Lexicon, weights and logistic function from the bounded sample of labelled rows."""
    rows = training_rows(docs, labels, id_col, text_col, toxic_rows, clean_rows)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return default_model()
    support = max(LEAST_SUPPORT, n_toxic // 250)

    def counted(known: frozenset | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for text, _ in _folded_rows(batches):
                own = _row_features(text)
                seen.update(own if known is None else own & known)
            pairs = list(seen.items())
            for i in range(0, len(pairs), 1 << 14):
                part = pairs[i : i + (1 << 14)]
                yield pa.record_batch({"feature": pa.array([p[0] for p in part], pa.string()), "n": pa.array([p[1] for p in part], pa.int64())})

        return run

    def totals(value: int, known: frozenset | None = None) -> DataFrame:
        return common.map_arrow(rows.where(F.col("toxic") == value), counted(known), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))

    toxic = {r.feature: r.n for r in totals(1).where(F.col("n") >= support).orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()}
    clean = {r.feature: r.n for r in totals(0, frozenset(toxic)).collect()}
    ratio = n_toxic / n_clean
    pure = [f for f, t in toxic.items() if t >= 8 * clean.get(f, 0) * ratio]
    lexicon = _cover(rows, pure, {f: n * ratio for f, n in clean.items()}, support)
    if not lexicon:
        return default_model()
    weights = {f: float(np.log((toxic[f] + 0.5) / (n_toxic + 1)) - np.log((clean.get(f, 0) + 0.5) / (n_clean + 1))) for f in lexicon}
    model = Model({f: max(w, 0.5) for f, w in weights.items()}, EXCEPTIONS, (0.0, 0.0, 0.0))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, "text"):
                total, words = evidence(automaton, data, offsets)
                yield pa.record_batch([pa.array(total), pa.array(words), part.column("toxic")], names=["total", "words", "toxic"])

    got = common.map_arrow(rows, measured, "total double, words long, toxic int").toPandas()
    model.coefficients = _fit(features(got.total.to_numpy(), got.words.to_numpy()), got.toxic.to_numpy())
    return model


def _cover(rows: DataFrame, pure: list[str], clean: dict[str, float], support: int) -> list[str]:
    """Features chosen greedily until every toxic row of the sample has ``COVER`` of them or no feature adds ``support`` rows."""
    place = {f: i for i, f in enumerate(pure)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, _ in _folded_rows(batches):
            yield pa.record_batch({"own": pa.array([sorted(place[f] for f in _row_features(text) if f in place)], pa.list_(pa.int32()))})

    owned = [np.array(r.own, np.int64) for r in common.map_arrow(rows.where("toxic = 1"), held, "own array<int>").collect()]
    row = np.repeat(np.arange(len(owned)), [len(o) for o in owned])
    feature = np.concatenate([*owned, np.zeros(0, np.int64)])
    penalty = np.array([5 * clean.get(f, 0) for f in pure], np.float64)
    length = np.array([len(f) for f in pure], np.float64)
    left, chosen = np.full(len(owned), COVER), []
    while len(chosen) < LEXICON and len(feature):
        open_pairs = left[row] > 0
        gain = np.bincount(feature[open_pairs], minlength=len(pure)) - penalty
        gain[chosen] = -np.inf
        best = int(np.argmax(gain + length * 1e-3))
        if gain[best] < support:
            break
        chosen.append(best)
        own = np.unique(row[feature == best])
        left[own] -= 1
        # a longer stem or word with the same beginning adds nothing to a row that has this one
        same = np.array([f.startswith(pure[best].rstrip()) or pure[best].startswith(f.rstrip()) for f in pure])
        drop = same[feature] & np.isin(row, own)
        row, feature = row[~drop], feature[~drop]
    return [pure[i] for i in chosen]


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; slopes stay non-negative."""
    w = np.full(len(y), 1.0 / max(1, len(y)))
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (w * (p - y)) + ridge * b
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        b = b - np.linalg.solve(hessian, gradient)
    if (b[1:] < 0).any():
        b[1:] = np.maximum(b[1:], 0.0)
    return tuple(float(v) for v in b)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, ``held_out``, ``score`` and ``predicted`` (1 if the score reaches the threshold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, text_col):
                p = probability(model.coefficients, *evidence(automaton, data, offsets))
                yield pa.record_batch([part.column(id_col), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[id_col, "score", "predicted"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    scored = common.map_arrow(docs.select(id_col, text_col), run, schema)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is under the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, text_col):
                p = probability(model.coefficients, *evidence(automaton, data, offsets))
                yield part.filter(pc.less(pa.array(p), threshold))

    return common.map_arrow(docs, run, docs.schema)
