"""JSON of unknown shape as text: keys and values in their order, which only a parser that keeps it can give."""

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType

# Workers get this module's code with the function; it needs no install on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KIND = StructType().add("flat", StringType()).add("bad", BooleanType()).add("entries", ArrayType(StructType().add("k", StringType()).add("v", StringType())))


def flat(item) -> list[str]:
    """Keys and scalars, depth first; nulls are skipped."""
    if item is None:
        return []
    if isinstance(item, dict):
        return [x for k, v in item.items() for x in (str(k), *flat(v))]
    if isinstance(item, list):
        return [x for v in item for x in flat(v)]
    return [str(item)]


def parsed(text: str | None) -> tuple[str | None, bool, list]:
    """(flat text, null where there is no JSON; whether it was broken; the top-level entries with a value)."""
    if not text or not text.strip():
        return None, False, []
    try:
        item = json.loads(text)
    except (ValueError, RecursionError):
        return None, True, []
    entries = [{"k": str(k), "v": str(v)} for k, v in item.items() if v] if isinstance(item, dict) else []
    return None if item is None else " ".join(flat(item)), False, entries


_ARROW = pa.struct([("flat", pa.string()), ("bad", pa.bool_()), ("entries", pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())])))])


@F.arrow_udf(_KIND)
def json_text(texts: pa.Array) -> pa.Array:
    """flat, bad and entries of each text; each text of a batch is read once."""
    known = texts.fill_null("").dictionary_encode()
    rows = [dict(zip(("flat", "bad", "entries"), parsed(t))) for t in known.dictionary.to_pylist()]
    return pa.array(rows, _ARROW).take(known.indices)
