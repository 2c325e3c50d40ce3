"""Model calls behind one interface: each turns request rows into response rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.session import ship


class Backend(Protocol):
    """Adds a nullable column ``response`` to rows of requests."""

    name: str
    supports_tables: bool
    supports_bbox: bool
    supports_formulas: bool

    def answer(self, requests: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class TableBackend:
    """Answers from a table with the same keys; no call leaves the cluster."""

    responses: DataFrame
    keys: tuple[str, ...]
    name: str = "table"
    supports_tables: bool = True
    supports_bbox: bool = False
    supports_formulas: bool = True

    def answer(self, requests: DataFrame) -> DataFrame:
        return requests.join(self.responses.select(*self.keys, "response"), list(self.keys), "left")


@dataclass(frozen=True)
class FunctionBackend:
    """Answers from a Python function of a request text, called in Arrow batches.

    ``call`` must be picklable; a failure gives a null response, so one request never
    ends the job. Partitions bound how many calls run at once.
    """

    call: Callable[[str], str]
    column: str = "request"
    name: str = "function"
    supports_tables: bool = False
    supports_bbox: bool = False
    supports_formulas: bool = False

    def answer(self, requests: DataFrame) -> DataFrame:
        call, column = self.call, self.column

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def tried(text: str) -> str | None:
                try:
                    return call(text)
                except Exception:  # any failure of a remote model is an empty answer
                    return None

            for frame in frames:
                yield frame.assign(response=frame[column].map(tried))

        ship(requests.sparkSession)
        schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema], "response string"])
        return requests.mapInPandas(run, schema)


def http_backend(host: str, model: str, timeout: float = 120.0) -> FunctionBackend:
    """A text-generation service at ``host``; used only where one is named."""

    def call(prompt: str) -> str:
        import json
        import urllib.request

        body = json.dumps({"model": model, "prompt": prompt, "stream": False}).encode()
        request = urllib.request.Request(f"{host.rstrip('/')}/api/generate", body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return json.load(reply).get("response", "").strip()

    return FunctionBackend(call, name=model)


def only_missing(requests: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """Requests without a cached answer. Must come before the call: no filter is pushed below one."""
    return requests.join(cached.select(*keys).distinct(), keys, "left_anti")


#: What each kind of picture is asked for.
PROMPTS = {
    "chart": "Describe the chart: its kind, title, axes and what the data show.",
    "table": "Describe the table: its title, columns and main findings.",
    "formula": "Write the formula as LaTeX and say what it states.",
    "figure": "Describe the figure and its main parts.",
}


def picture_prompt(type: str = "type", context: str | None = None) -> Column:
    """The request for a picture; up to 300 characters of context go with it."""
    table = F.create_map(*[F.lit(x) for pair in PROMPTS.items() for x in pair])
    asked = F.coalesce(F.try_element_at(table, F.lower(F.col(type))), F.lit("Describe the picture."))
    if context is None:
        return asked
    near = F.substring(F.coalesce(F.col(context), F.lit("")), 1, 300)
    return F.when(near != "", F.concat(asked, F.lit("\n\nText near it: "), near)).otherwise(asked)


def encoded_image(content: str = "content") -> Column:
    return F.base64(F.col(content))


def fitted(width: Column | str, height: Column | str, most: int = 1024) -> Column:
    """struct(width, height) of a picture no side of which is longer than ``most``, in proportion; the backend resizes to it."""
    w, h = (F.col(c) if isinstance(c, str) else c for c in (width, height))
    share = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(w, h))
    return F.struct(F.greatest(F.lit(1), F.floor(w * share)).cast("int").alias("width"), F.greatest(F.lit(1), F.floor(h * share)).cast("int").alias("height"))


#: What tables and charts are asked for when their data are wanted rather than a description; without an answer a comment stands in.
EXTRACTIONS = {"table": "Give the table as markdown, every row and column.", "chart": "Give the chart's title and kind, then its axes and ranges, then its data points as a markdown table."}


def extraction(type: Column | str, answer: Column | str) -> Column:
    """Data of a table or chart as markdown: the model's answer, or a comment that there is none; null for other pictures."""
    t, a = (F.col(c) if isinstance(c, str) else c for c in (type, answer))
    missing = F.concat(F.lit("<!-- "), F.lower(t), F.lit(" data not extracted -->"))
    chart = F.when(F.lower(t) == "chart", F.concat(F.lit("**[Chart]**\n"), a)).otherwise(a)
    return F.when(F.lower(t).isin(*EXTRACTIONS), F.coalesce(F.when(a != "", chart), missing))
