"""Cover-density rank of a document for a query all of whose words it holds."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The weight of a word by the part of the document it stands in (lines: brand, title, category, specs, description).
PART_WEIGHTS = (1.0, 1.0, 0.4, 0.2, 0.2)


def density(query: list[str], document: str) -> float:
    """The sum over the shortest spans that hold all query words of (words / sum of 1 / weight) / (1 + other words within the span).

    Spans don't start before the one ahead of them; positions run on through the parts.
    """
    wanted, at, hits = set(query), 0, []
    for weight, part in zip(PART_WEIGHTS, document.split("\n")):
        for word in part.split():
            at += 1
            if word in wanted:
                hits.append((at, word, weight))
    if not wanted:
        return 0.0
    total, begin = 0.0, 0
    while True:
        seen: set[str] = set()
        end = begin
        while end < len(hits) and len(seen) < len(wanted):
            seen.add(hits[end][1])
            end += 1
        if len(seen) < len(wanted):
            return total
        seen, start = set(), end
        while len(seen) < len(wanted):
            start -= 1
            seen.add(hits[start][1])
        span = hits[start:end]
        noise = span[-1][0] - span[0][0] - (len(span) - 1)
        total += len(span) / sum(1 / w for _, _, w in span) / (1 + noise)
        begin = start + 1


@F.pandas_udf(DoubleType())
def cover_density(query: pd.Series, document: pd.Series) -> pd.Series:
    return pd.Series([density(list(q), d) for q, d in zip(query, document)], dtype="float64")
