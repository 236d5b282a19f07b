"""Replies of a model as data: JSON out of prose and fences."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

ID = re.compile(r"^[0-9a-f]{12}$")


def arrays(text: str) -> list[str]:
    """The outermost [...] of a text that balance, outside of strings."""
    out, depth, start, quoted, escaped = [], 0, 0, False, False
    for i, c in enumerate(text):
        if quoted:
            escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
            continue
        if c == '"' and depth:
            quoted = True
        elif c == "[":
            start, depth = (i if not depth else start), depth + 1
        elif c == "]" and depth:
            depth -= 1
            if not depth:
                out.append(text[start : i + 1])
    return out


def listed(reply: str | None) -> list | None:
    """The first list in a reply, the reply itself if it is one; None if there is none."""
    if not reply:
        return None
    bare = re.sub(r"^\s*```[a-z]*\s*|\s*```\s*$", "", reply)
    for candidate in (bare, *arrays(bare)):
        try:
            found = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(found, list):
            return found
    return None


@pandas_udf(T.ArrayType(T.StringType()))
def reply_ids(reply: pd.Series) -> pd.Series:
    """The ids (12 hex digits) of a reply's list, its elements being ids or objects with an id, in order; null if no list."""

    def ids(r: str | None) -> list[str] | None:
        found = listed(r)
        if found is None:
            return None
        raw = [x.get("id") if isinstance(x, dict) else x for x in found]
        return [x.strip().lower() for x in raw if isinstance(x, str) and ID.match(x.strip().lower())]

    return reply.map(ids)


def understood(ids: Column) -> Column:
    return ids.isNotNull()
