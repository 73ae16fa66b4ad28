"""Repair of JSON texts that break off."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"')
_ATOM = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null")
_SPACE = re.compile(r"[ \t\n\r]*")


def closed(text: str | None) -> str | None:
    """The longest start of ``text`` that closing its open brackets makes a JSON object or array, so closed.

    One pass with a stack of open brackets: the text is cut after the last complete value, member or opening bracket. A
    number that ends the text counts as complete. Null where the text doesn't begin with a bracket.
    """
    if text is None:
        return None
    stack: list[str] = []
    good, at, expect = -1, 0, "value"  # or: first (of an array), key, first key, colon, more
    while (at := _SPACE.match(text, at).end()) < len(text):
        c = text[at]
        if (expect == "more" or expect.startswith("first")) and stack and c == stack[-1]:
            stack.pop()
            at, expect = at + 1, "more"
        elif expect in ("value", "first"):
            if c in "{[":
                stack.append("}" if c == "{" else "]")
                at, expect = at + 1, "first key" if c == "{" else "first"
            elif stack and (m := (_STRING if c == '"' else _ATOM).match(text, at)):
                at, expect = m.end(), "more"
            else:
                break
        elif expect in ("key", "first key"):
            if not (m := _STRING.match(text, at)):
                break
            at, expect = m.end(), "colon"
            continue
        elif expect == "colon":
            if c != ":":
                break
            at, expect = at + 1, "value"
            continue
        elif c == "," and stack:
            at, expect = at + 1, "key" if stack[-1] == "}" else "value"
            continue
        else:
            break
        good = at
        if not stack:
            break
    return None if good < 0 else text[:good] + "".join(reversed(stack))


def repair_json(text: Column) -> Column:
    """``text`` itself if it is JSON, else its longest start that can be closed to an object or array; null without one."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(closed)

    whole = F.try_parse_json(text).isNotNull()
    return F.when(whole, text).otherwise(run(F.when(~whole, text)))
