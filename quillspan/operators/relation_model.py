"""Relations learned from gold pairs: multinomial logistic regression over hashed words of a pair's context, and a judge of its answers.

Loss and gradient are summed over partitions (see training); the probabilities are set right on pairs that the weights were not
fitted on, so that the judge's threshold means what it says.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import Words, crc32_each, stretches
from ..schemas import NO_RELATION
from ..session import materialise, ship
from .training import minimise, partition_sum

BUCKETS = 1 << 15
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_ANSWER = "struct<predicate:string,justification:string,probability:double,given:double>"


def features(context: str | None, subject: str | None, obj: str | None) -> dict[str, str]:
    """Each feature of a pair, with the word it is of: words and pairs of neighbours, both with their place (before, between or after the
    first mentions of the two names, the names left out), and which name comes first.  Without a context there is one for all."""
    text = (context or "").lower()
    names = [(text.find(x), len(x), who) for x, who in (((subject or "").lower(), "S"), ((obj or "").lower(), "O")) if x]
    found = sorted(x for x in names if x[0] >= 0)
    out = {"*": "", "order " + "".join(who for _, _, who in found): ""}
    last = ("", "")
    for m in _WORD.finditer(text):
        place = sum(m.start() >= at for at, _, _ in found)
        inside = [who for at, n, who in found if at <= m.start() < at + n]
        word = inside[0] if inside else m.group()
        if not inside:
            out.setdefault(f"w {word}", word)
            out.setdefault(f"{place} {word}", word)
        if last[0] and not (inside and last[0] == word):
            out.setdefault(f"2 {last[0]} {word}", f"{last[1]} {m.group()}")
        last = (word, m.group())
    return out


def buckets(names: list[str], n: int) -> np.ndarray:
    return np.array([zlib.crc32(x.encode("utf-8", "replace")) % n for x in names], np.int32)


@dataclass
class Hashed:
    """The features of some pairs, as features() and buckets() tell them one by one."""

    words: Words
    row: np.ndarray  # of each feature that is of a word, in their order
    at: np.ndarray  # its bucket
    word: np.ndarray  # its word
    double: np.ndarray  # whether it is of the word before, too
    all_row: np.ndarray  # of each distinct bucket of a pair, those without a word too
    all_at: np.ndarray

    @staticmethod
    def of(contexts: list[str | None], subjects: list[str | None], objects: list[str | None], n: int) -> Hashed:
        """All pairs at once: some numbers for each character are in memory, so longer batches are cut by stretches() first."""
        texts = [(c or "").lower() for c in contexts]
        words, rows = Words.of(texts), len(texts)
        places, orders = np.full((2, rows), 1 << 40), []
        lengths, who = np.zeros((2, rows), np.int64), np.zeros((2, rows), np.int64)
        for i, (text, subject, obj) in enumerate(zip(texts, subjects, objects, strict=True)):
            names = [(text.find(x), len(x), w) for x, w in (((subject or "").lower(), "S"), ((obj or "").lower(), "O")) if x]
            found = sorted(x for x in names if x[0] >= 0)
            for k, (at, size, w) in enumerate(found):
                places[k, i], lengths[k, i], who[k, i] = at, size, 1 if w == "S" else 2
            orders.append("order " + "".join(w for _, _, w in found))
        place, row = words.s - words.begin[words.row], words.row
        after = [place >= places[k][row] for k in (0, 1)]
        within = [after[k] & (place < (places[k] + lengths[k])[row]) for k in (0, 1)]
        name = np.where(within[0], who[0][row], np.where(within[1], who[1][row], 0))
        data = np.concatenate([words.data, np.frombuffer(b"SO ", np.uint8)])
        end = len(words.data)
        at, size = np.where(name > 0, end + name - 1, words.at), np.where(name > 0, 1, words.size)
        own = np.flatnonzero(name == 0)
        second = np.flatnonzero((row[1:] == row[:-1]) & ~((name[1:] > 0) & (name[1:] == name[:-1]))) + 1
        told = np.zeros((len(row), 3), np.int64)
        told[own, 0] = crc32_each(data, at[own], size[own], zlib.crc32(b"w "))
        whence = np.array([zlib.crc32(x) for x in (b"0 ", b"1 ", b"2 ")], np.uint32)
        told[own, 1] = crc32_each(data, at[own], size[own], whence[(after[0].astype(np.int8) + after[1])[own]])
        first = crc32_each(data, at[second - 1], size[second - 1], zlib.crc32(b"2 "))
        first = crc32_each(data, np.full(len(second), end + 2), np.ones(len(second), np.int64), first)
        told[second, 2] = crc32_each(data, at[second], size[second], first)
        there = np.zeros((len(row), 3), bool)
        there[own, :2], there[second, 2] = True, True
        word, kind = np.nonzero(there)
        bucket, of = told[word, kind] % n, row[word]
        known = {x: zlib.crc32(x.encode()) % n for x in {"*", *orders}}
        every = np.arange(rows) * n
        keys = np.sort(np.concatenate([of * n + bucket, every + known["*"], every + np.array([known[x] for x in orders], np.int64)]))
        keys = keys[np.append(True, keys[1:] != keys[:-1])]  # np.unique hashes, which takes ten times as long
        return Hashed(words, of, bucket, word, kind == 2, keys // n, keys % n)

    def said(self, i: int) -> str:
        """The part of the context that a feature is of."""
        w, k = self.words, self.word[i]
        last = w.joined[w.s[k] : w.e[k]]
        return f"{w.joined[w.s[k - 1] : w.e[k - 1]]} {last}" if self.double[i] else last


def _logits(at: np.ndarray, sizes: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The summed weights of pairs whose buckets, one at least, follow each other."""
    starts = np.cumsum(sizes) - sizes
    return np.stack([np.add.reduceat(one[at], starts) for one in np.ascontiguousarray(w.T)], 1)


def _entries(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows, and how many each has."""
    return np.frombuffer(b"".join(frame["at"]), np.int32).astype(np.intp), np.fromiter(map(len, frame["at"]), np.int64, len(frame)) // 4


def _log_shares(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _loss(frame: pd.DataFrame, w: np.ndarray) -> np.ndarray:
    """Loss and its gradient, one after the other."""
    (flat, sizes), told, row = _entries(frame), frame["label"].to_numpy(), np.arange(len(frame))
    log_share = _log_shares(_logits(flat, sizes, w))
    share = np.exp(log_share)
    share[row, told] -= 1
    grad = np.stack([np.bincount(flat, np.repeat(one, sizes), len(w)) for one in np.ascontiguousarray(share.T)], 1)
    return np.concatenate([[-log_share[row, told].sum()], grad.ravel()])


@dataclass
class RelationModel:
    labels: list[str]
    weights: np.ndarray  # a row for each bucket
    scale: float  # what scores are multiplied with to be calibrated
    loss: float

    def answers(self, pairs: DataFrame, allowed: dict[str, list[str]] | None = None) -> DataFrame:
        """pairs (context, subj, obj; category if ``allowed`` is given) with predicate, justification and probability.

        The justification is the part of the context that speaks most for the predicate.  ``allowed`` names the predicates of each
        category; "no relation" is always one, and a category that it doesn't name may have all.  Columns of these names are replaced.
        """
        answer = self._asked(pairs, allowed)
        some = {c: F.col(f"_answer.{c}") for c in ("predicate", "justification", "probability")}
        return pairs.withColumn("_answer", answer).withColumns(some).drop("_answer")

    def predictor(self, allowed: dict[str, list[str]] | None = None):
        """A RelationPredictor (see providers)."""
        return lambda pairs: self.answers(pairs, allowed).drop("probability")

    def judge(self, least: float = 0.5):
        """A RelationJudge (see providers): yes to a predicate of the context whose calibrated probability is at least ``least``; no to one that is unknown."""

        def judged(relations: DataFrame) -> DataFrame:
            sure = F.coalesce(self._asked(relations, None, "predicate")["given"] >= least, F.lit(False))
            return relations.withColumn("decision", F.when(sure, "yes").otherwise("no"))

        return judged

    def _asked(self, pairs: DataFrame, allowed: dict[str, list[str]] | None, given: str | None = None):
        spark = pairs.sparkSession
        ship(spark)
        sent, labels, scale, number = spark.sparkContext.broadcast(self.weights), self.labels, self.scale, {x: i for i, x in enumerate(self.labels)}
        masks = {k: np.array([0.0 if x == NO_RELATION or x in v else -np.inf for x in labels]) for k, v in (allowed or {}).items()}

        @F.pandas_udf(_ANSWER)
        def ask(contexts: pd.Series, subjects: pd.Series, objects: pd.Series, groups: pd.Series, told: pd.Series) -> pd.DataFrame:
            w, lists = sent.value, [x.tolist() for x in (contexts, subjects, objects, groups, told)]
            out = [y for part in stretches([c or "" for c in lists[0]]) for y in answered(w, *[x[part] for x in lists])]
            return pd.DataFrame(out, columns=["predicate", "justification", "probability", "given"], index=contexts.index)

        def answered(w: np.ndarray, contexts: list, subjects: list, objects: list, groups: list, told: list) -> list[tuple]:
            h, rows = Hashed.of(contexts, subjects, objects, len(w)), np.arange(len(contexts))
            score = _logits(h.all_at, np.bincount(h.all_row, minlength=len(rows)), w) * scale
            for i, group in enumerate(groups if masks else []):
                if group in masks and np.isfinite(masks[group]).any():
                    score[i] += masks[group]
            share = np.exp(_log_shares(score))
            best = share.argmax(axis=1)
            why = {}
            if given is None:  # a judge needs no justification
                lead, most = w[h.at, best[h.row]] - w.mean(axis=1)[h.at], np.full(len(rows), -np.inf)
                np.maximum.at(most, h.row, lead)
                first = np.flatnonzero(lead == most[h.row])
                spoken, where = np.unique(h.row[first], return_index=True)
                why = dict(zip(spoken.tolist(), first[where].tolist(), strict=True))
            return [
                (labels[c], h.said(why[i]) if i in why else "", share[i, c], share[i, number[known]] if known in number else None)
                for i, (c, known) in enumerate(zip(best.tolist(), told, strict=True))
            ]

        none = F.lit(None).cast("string")
        return ask("context", "subj", "obj", F.col("category").cast("string") if masks else none, F.col(given) if given else none)


def learn_relations(gold: DataFrame, l2: float = 1.0, rounds: int = 60, n: int = BUCKETS, tolerance: float = 1e-4) -> RelationModel:
    """Learns from pairs with their context (context, subj, obj, actual).

    Pairs without a label are not learned from; null contexts and names are empty ones, repeated rows count each.  A fifth of the
    contexts, by their hash, only sets the probabilities right.  Features are written once; the driver has n weights for each label.
    """
    spark = gold.sparkSession
    ship(spark)
    known = gold.where("actual IS NOT NULL").select("context", "subj", "obj", "actual")
    labels = sorted(r[0] for r in known.select("actual").distinct().collect()) or [NO_RELATION]  # predicates, not pairs
    number = {x: i for i, x in enumerate(labels)}

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lists = [frame[c].tolist() for c in ("context", "subj", "obj")]
            for part in stretches([c or "" for c in lists[0]]):
                h, texts = Hashed.of(*[x[part] for x in lists], n), lists[0][part]
                ends, flat = np.cumsum(4 * np.bincount(h.all_row, minlength=len(texts))).tolist(), h.all_at.astype(np.int32).tobytes()
                at = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                aside = [zlib.crc32((c or "").encode("utf-8", "replace")) % 5 == 0 for c in texts]
                yield pd.DataFrame({"at": at, "label": [number[x] for x in frame["actual"].iloc[part]], "aside": aside})

    hashed = known.mapInPandas(measure, "at binary, label int, aside boolean")
    rows = materialise(hashed.repartition(spark.sparkContext.defaultParallelism))  # each round has so many sums, however long the input is
    size, k = n * len(labels), len(labels)

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast(w.reshape(n, k))
        total = partition_sum(rows.where("NOT aside"), lambda frame: _loss(frame, sent.value), 1 + size)
        sent.unpersist()
        return total[0] + l2 / 2 * (w @ w), total[1:] + l2 * w

    w, loss = minimise(value, np.zeros(size), rounds, tolerance=tolerance)
    sent = spark.sparkContext.broadcast(w.reshape(n, k))

    def spread_of(frame: pd.DataFrame, power: float) -> np.ndarray:
        score = _logits(*_entries(frame), sent.value)
        told, row = frame["label"].to_numpy(), np.arange(len(frame))
        log_share = _log_shares(score * np.exp(power))
        slope = np.exp(power) * ((np.exp(log_share) * score).sum() - score[row, told].sum())
        return np.array([-log_share[row, told].sum(), slope])

    def scaled(power: np.ndarray) -> tuple[float, np.ndarray]:
        total = partition_sum(rows.where("aside"), lambda frame: spread_of(frame, power[0]), 2)
        return total[0] + power[0] ** 2 / 2, total[1:] + power  # so that few pairs do not move it far

    power, _ = minimise(scaled, np.zeros(1), 10, tolerance=1e-3)
    return RelationModel(labels, w.reshape(n, k), float(np.exp(power[0])), loss)
