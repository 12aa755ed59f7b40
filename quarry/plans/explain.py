"""What a plan pushes to its scans, which joins it uses and where it shuffles."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Report:
    pushed_filters: list[str]
    read_columns: list[list[str]]
    joins: list[str]
    exchanges: int
    python: bool
    text: str


def report(df: DataFrame) -> Report:
    """Read off the physical plan; nothing is run."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = [f.strip() for m in re.findall(r"PushedFilters: \[(.*?)\]\n", text) for f in re.split(r", (?![^(]*\))", m) if f.strip()]
    columns = [re.findall(r"(\w+):", m) for m in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]
    joins = re.findall(r"(?m)^\(\d+\) (\w*Join\w*|CartesianProduct)", text)
    return Report(filters, columns, joins, len(re.findall(r"(?m)^\(\d+\) Exchange", text)), bool(re.search(r"(?m)^\(\d+\) \w*(?:Python|Pandas|Arrow)", text)), text)
