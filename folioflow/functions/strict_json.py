"""Bounded, strict JSON objects as VARIANT values.

Good rows never leave the JVM: a size check, a UTF-8 check and Spark's own parser, which refuses repeated keys and numbers that are
no JSON.  The text is parsed as one member of a larger object whose last key is drawn for the query, so text after the
value cannot hide.  Only rows that this refuses, or whose numbers may leave double precision or that hold an unpaired surrogate, go to an Arrow
batch function, which names what is wrong with them.  ``beyond_limits`` are valid texts that a VARIANT cannot hold: integers
beyond double precision's range, and values nested deeper than Spark's parser goes.
"""

from __future__ import annotations

import json
import math
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What can be wrong, in the order in which it is asked.
PROBLEMS = ("too_large", "not_utf8", "duplicate_key", "not_finite", "not_json", "not_object", "unpaired_surrogate", "beyond_limits")
#: Numbers that may be infinite as doubles, and escapes of surrogates.
_DOUBTFUL = r"[0-9]{300}|[eE]\+?[0-9]{3}|\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F]"


class _Refused(ValueError):
    pass


def _pairs(items):
    if len({k for k, _ in items}) < len(items):
        raise _Refused("duplicate_key")
    return dict(items)


def _no_number(_):
    raise _Refused("not_finite")


def _finite(text):
    value = float(text)
    if not math.isfinite(value):
        raise _Refused("not_finite")
    return value


def _whole(text):
    if len(text) > 308:
        raise _Refused("beyond_limits")
    return int(text)


def _problem(text: str) -> str | None:
    try:
        value = json.loads(text, object_pairs_hook=_pairs, parse_constant=_no_number, parse_float=_finite, parse_int=_whole)
        if not isinstance(value, dict):
            return "not_object"
        json.dumps(value, ensure_ascii=False).encode()
    except _Refused as refused:
        return str(refused)
    except UnicodeEncodeError:
        return "unpaired_surrogate"
    except (ValueError, RecursionError):
        return "not_json"
    return None


def strict_value(text: Column) -> Column:
    """The text as VARIANT; null if it is not one JSON value or repeats a key."""
    end = f"end-{uuid.uuid4().hex}"
    parsed = F.try_parse_json(F.concat(F.lit('{"value":'), text, F.lit(f',"{end}":0}}')))
    members = F.try_variant_get(parsed, "$", "map<string,variant>")
    return F.when((F.size(members) == 2) & F.map_contains_key(members, end), members["value"])


def read_objects(frame: DataFrame, raw: str, max_bytes: int, value: str = "value", problem: str = "problem") -> DataFrame:
    """``frame`` with the JSON object in the binary or string column ``raw`` as VARIANT, or null and what is wrong with it.

    A null is not JSON.  Columns ``value`` and ``problem`` replace columns of these names."""
    if max_bytes < 1:
        raise ValueError("the limit must be positive")
    text = F.col(raw).cast("binary").cast("string")
    known = F.when(F.octet_length(F.col(raw).cast("binary")) > max_bytes, "too_large").when(~F.is_valid_utf8(text), "not_utf8")
    whole = F.when(known.isNull(), strict_value(text))
    is_object = F.try_variant_get(whole, "$", "map<string,variant>").isNotNull()
    doubtful = known.isNull() & (~F.coalesce(is_object, F.lit(False)) | text.rlike(_DOUBTFUL))

    def judge(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _problem(t) for t in batch.to_pylist()], pa.string())

    asked = frame.withColumns({problem: known, value: whole, "__asked": F.when(doubtful, F.coalesce(text, F.lit("")))})
    told = F.arrow_udf(judge, "string")(F.col("__asked"))
    judged = asked.withColumn(problem, F.coalesce(F.col(problem), told))
    judged = judged.withColumn(problem, F.when(F.col(problem).isNull() & F.col(value).isNull(), "beyond_limits").otherwise(F.col(problem)))
    return judged.withColumn(value, F.when(F.col(problem).isNull(), F.col(value))).drop("__asked")
