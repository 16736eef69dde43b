"""What models and services do, as batch functions that can be replaced; the defaults work offline.

A provider takes a DataFrame and returns it with its answers, so a model can run wherever it likes: in
mapInPandas with one model a worker, behind a service, or, as the defaults do, as plain expressions.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import sentences
from ..functions.vectors import embedder
from ..schemas import NO_RELATION
from .mentions import locate_all
from .relations import judge


class Extractor(Protocol):
    """passages (doc_id, passage_idx, u_start, text) to names (doc_id, passage_idx, entity_type, entity_idx, name)."""

    def __call__(self, passages: DataFrame) -> DataFrame: ...


class RelationPredictor(Protocol):
    """pairs with context to predicate and justification."""

    def __call__(self, pairs: DataFrame) -> DataFrame: ...


class RelationJudge(Protocol):
    """relations to relations with decision, yes or no."""

    def __call__(self, relations: DataFrame) -> DataFrame: ...


class Embedder(Protocol):
    """A column of names to a column of vectors."""

    def __call__(self, name: Column | str) -> Column: ...


class SentenceSplitter(Protocol):
    """A column of texts to array<struct<s, text>>."""

    def __call__(self, text: Column) -> Column: ...


class CompoundClassifier(Protocol):
    """Distinct keys to keys with classes."""

    def __call__(self, keys: DataFrame) -> DataFrame: ...


def lexicon_extractor(lexicon: DataFrame) -> Extractor:
    """Proposes the names of a list that occur in a passage."""

    def extract(passages: DataFrame) -> DataFrame:
        found = locate_all(passages, lexicon).where(F.size("spans") > 0)
        return found.select("doc_id", "passage_idx", "entity_type", "entity_idx", "name")

    return extract


# Phrases of our own that give a relation away, the first that occurs counts.
CUES = [
    ("accumulat", "accumulates_in"),
    ("biosynthesi", "made_in"),
    ("produced by", "made_by"),
    ("degrad", "degraded_by"),
    ("positively correlat", "positively_correlates_with"),
    ("negatively correlat", "negatively_correlates_with"),
    ("correlat", "correlates_with"),
    ("regulat", "modulates"),
    ("found in", "present_in"),
    ("associated with", "associated_with"),
]


def cue_predictor(cues: list[tuple[str, str]] = CUES) -> RelationPredictor:
    """Predicts by the first cue in the context; the justification is the cue."""

    def predict(pairs: DataFrame) -> DataFrame:
        predicate, reason = F.lit(NO_RELATION), F.lit("")
        for cue, name in reversed(cues):
            here = F.contains(F.lower("context"), F.lit(cue))
            predicate, reason = F.when(here, name).otherwise(predicate), F.when(here, cue).otherwise(reason)
        return pairs.withColumns({"predicate": predicate, "justification": reason})

    return predict


containment_judge: RelationJudge = judge
rule_splitter: SentenceSplitter = sentences


def hashed_embedder(size: int = 64) -> Embedder:
    return embedder(size)


_WAIT = re.compile(r"(?:(\d+)h)?(?:(\d+)m(?!s))?(?:(\d+(?:\.\d+)?)s)?")


def asked_wait(text: str) -> float | None:
    """Seconds that a service asks to wait for, as a number or as hours, minutes and seconds (1h2m3.5s); None if it doesn't."""
    text = (text or "").strip()
    if re.fullmatch(r"\d+(\.\d+)?", text):
        return float(text)
    found = next((m for m in _WAIT.finditer(text) if m.group()), None)
    return None if found is None else sum(float(x or 0) * unit for x, unit in zip(found.groups(), (3600, 60, 1), strict=True))


class Busy(Exception):
    """A service's answer that it has had too many requests; wait: what it asks for, a number or 1h2m3.5s."""

    def __init__(self, wait: str = ""):
        super().__init__(wait)
        self.wait = wait


def with_retries(call: Callable, attempts: int = 5, wait: float = 0.5, retry_on: tuple = (OSError, TimeoutError, Busy), sleep: Callable[[float], None] = time.sleep) -> Callable:
    """call, tried again after a growing pause, or the one that a Busy service asks for; the last failure is raised."""

    def tried(*args):
        for k in range(attempts):
            try:
                return call(*args)
            except retry_on as e:
                if k + 1 == attempts:
                    raise
                asked = asked_wait(e.wait) if isinstance(e, Busy) else None
                sleep(wait * 2**k if asked is None else asked)

    return tried


def lookup(keys: DataFrame, key: str, call: Callable[[list], list[dict]], schema: str, batch: int = 10, at_once: int | None = None) -> DataFrame:
    """Asks a service about each distinct key once, in batches; call gets keys and returns a dict for each answer.

    A key without an answer has no row.  Partitions are the parallelism, ``at_once`` of them if given; a task that
    runs again asks again.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in schema.split(",")]
        for frame in frames:
            values = frame[key].tolist()
            answers = [a for i in range(0, len(values), batch) for a in call(values[i : i + batch])]
            yield pd.DataFrame(answers, columns=names)

    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return (distinct.repartition(at_once) if at_once else distinct).mapInPandas(work, schema)


_PYTHON = {"string": str, "int": int, "bigint": int, "double": (int, float), "float": (int, float), "boolean": bool}


def fits(text: str, kind: T.DataType, values: dict[str, list[str]] | None = None) -> bool:
    """Whether a text is JSON of a kind: every field there with its type, at any depth, and of ``values`` where they are given."""

    def of(value, kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return isinstance(value, dict) and all(f.name in value and of(value[f.name], f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return isinstance(value, list) and all(of(x, kind.elementType) for x in value)
        return isinstance(value, _PYTHON.get(kind.simpleString(), object))

    try:
        found = json.loads(text)
    except (TypeError, ValueError):
        return False
    return of(found, kind) and all(found.get(k) in allowed for k, allowed in (values or {}).items())


def answer(
    df: DataFrame, prompt: Column, generate: Callable[[list[str]], list[str]], kind: str, batch: int = 32, attempts: int = 5, values: dict[str, list[str]] | None = None
) -> DataFrame:
    """df with answer: what generate() makes of the prompts, parsed as kind.

    Prompts whose answer doesn't fit (see fits()) are asked again, ``attempts`` times in all; then its fields are null.
    """
    schema = T.StructType.fromDDL(kind)

    def work(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in frames:
            prompts, out = series.tolist(), [None] * len(series)
            left = list(range(len(prompts)))
            for _ in range(attempts):
                for i in range(0, len(left), batch):
                    some = left[i : i + batch]
                    for k, text in zip(some, generate([prompts[k] for k in some]), strict=True):
                        out[k] = text if fits(text, schema, values) else None
                left = [k for k in left if out[k] is None]
            yield pd.Series(["none" if x is None else x for x in out], dtype=object)  # which is no JSON of any kind

    asked = F.pandas_udf(work, T.StringType(), functionType=F.PandasUDFType.SCALAR_ITER)
    return df.withColumn("answer", F.from_json(asked(prompt), kind, {"mode": "PERMISSIVE"}))
