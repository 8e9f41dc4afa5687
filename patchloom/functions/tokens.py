"""Token offsets of code, in Arrow-batched workers."""

import re

import pandas as pd
from patchloom.functions.udf import arrow_udf

_SIGN = re.compile(r"\w+|[^\w\s]")
OFFSETS = "array<struct<start:int,end:int>>"


def sign_offsets(code: str | None) -> list[dict] | None:
    """Places of words and single signs: what approx_tokens counts."""
    return None if code is None else [{"start": m.start(), "end": m.end()} for m in _SIGN.finditer(code)]


@arrow_udf(OFFSETS)
def approx_offsets(code: pd.Series) -> pd.Series:
    return code.map(sign_offsets, na_action="ignore")
