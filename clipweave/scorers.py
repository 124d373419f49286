"""Models as plug-ins: a scorer maps batches of rows to new columns; each Python worker loads it once."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class Scorer(Protocol):
    """A model: the columns it reads, the columns it adds as DDL, and the scores of a batch, a row for each row given."""

    inputs: tuple[str, ...]
    outputs: str

    def load(self) -> None: ...

    def score(self, batch: pd.DataFrame) -> pd.DataFrame: ...


_registry: dict[str, Callable[[], Scorer]] = {}


def register(name: str, make: Callable[[], Scorer]) -> None:
    """Make a scorer known by a name."""
    _registry[name] = make


def scorer(name: str) -> Scorer:
    """A new scorer by its name."""
    if name not in _registry:
        raise KeyError(f"no scorer {name!r}; known: {', '.join(sorted(_registry)) or 'none'}")
    return _registry[name]()


def apply(rows: DataFrame, model: Scorer, *, key: str = "id", order_by: str | None = None, attempts: int = 2) -> DataFrame:
    """(`key`, outputs, error): rows scored in Arrow batches, in order of `order_by` within a partition (a length, so that
    batches are even). A batch that fails is halved down to single rows; a row that fails alone has null scores and its
    error, as often as `attempts` allow."""
    spec = StructType.fromDDL(model.outputs)
    ddl = f"`{key}` {rows.schema[key].dataType.simpleString()}, {model.outputs}, error string"
    names = [f.name for f in spec]
    needed = list(dict.fromkeys([key, *model.inputs]))
    given = rows.select(*dict.fromkeys([*needed, *([order_by] if order_by else [])]))
    if order_by:
        given = given.sortWithinPartitions(order_by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.load()

        def scored(b: pd.DataFrame) -> pd.DataFrame:
            error = None
            for _ in range(attempts):
                try:
                    out = model.score(b[list(model.inputs)]).reset_index(drop=True)[names]
                    return pd.concat([b[[key]].reset_index(drop=True), out], axis=1).assign(error=None)
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                    if len(b) > 1:
                        half = len(b) // 2
                        return pd.concat([scored(b.iloc[:half]), scored(b.iloc[half:])], ignore_index=True)
            return b[[key]].reset_index(drop=True).assign(**dict.fromkeys(names), error=error)

        for b in batches:
            if len(b):
                yield scored(b)

    return given.mapInPandas(run, ddl)


class TextLengthScorer:
    """A stand-in without a model, for tests and dry runs: characters and words of a text."""

    inputs = ("text",)
    outputs = "chars bigint, words bigint"

    def load(self) -> None:
        pass

    def score(self, batch: pd.DataFrame) -> pd.DataFrame:
        text = batch["text"].fillna("")
        return pd.DataFrame({"chars": text.str.len().astype("int64"), "words": text.str.split().str.len().astype("int64")})


class HttpScorer:
    """A model behind HTTP that gets a JSON document per row and answers with one: several requests at a time, and up to `attempts` for each, with
    pauses that double in between. An answer is cleaned of fences, labels and quotes, and its tags are made canonical."""

    inputs: tuple[str, ...] = ("text",)
    outputs = "text string, text_tagged string, tags array<string>"

    def __init__(self, url: str, *, attempts: int = 4, pause: float = 1.0, at_once: int = 8, timeout: float = 120.0, answer: str = "text"):
        self.url, self.attempts, self.pause, self.at_once, self.timeout, self.answer = url, attempts, pause, at_once, timeout, answer

    def load(self) -> None:
        pass

    def ask(self, document: dict) -> str:
        """The answer's text; the last error if all attempts fail."""
        for k in range(self.attempts):
            try:
                request = urllib.request.Request(self.url, json.dumps(document).encode(), {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=self.timeout) as response:
                    return json.load(response)[self.answer]
            except (OSError, ValueError, KeyError):
                if k + 1 == self.attempts:
                    raise
                time.sleep(self.pause * 2**k)
        raise RuntimeError("no attempt was allowed")

    def score(self, batch: pd.DataFrame) -> pd.DataFrame:
        from concurrent.futures import ThreadPoolExecutor

        from clipweave.functions.text import clean_answer, cleaned_tags, without_tags

        with ThreadPoolExecutor(self.at_once) as pool:
            answers = list(pool.map(self.ask, batch.to_dict("records")))
        tagged = [cleaned_tags(clean_answer(a)) for a in answers]
        return pd.DataFrame({"text": [without_tags(t) for t, _ in tagged], "text_tagged": [t for t, _ in tagged], "tags": [n for _, n in tagged]})


register("text_length", TextLengthScorer)
