"""Canonical JSON bytes and document identities."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, functions as F


def canonical_text(value: object) -> str:
    """Sorted keys, no spaces, ASCII; NaN and infinities are rejected."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False)


def _drop(value: dict, dropped: tuple[str, ...]) -> dict:
    return {k: v for k, v in value.items() if k not in dropped}


def canonical_json(doc: Column, dropped: tuple[str, ...] = ()) -> Column:
    """Canonical form of a JSON object column, without the ``dropped`` root keys.

    Uses Python's number formatting, which Spark's JSON writer does not share. NULL where the
    text is no JSON object.
    """
    def one(text):
        try:
            value = json.loads(text)
            return canonical_text(_drop(value, dropped)) if isinstance(value, dict) else None
        except (TypeError, ValueError):
            return None

    @F.pandas_udf("string")
    def convert(docs: pd.Series) -> pd.Series:
        return docs.map(one)

    return convert(doc)


def document_identity(doc: Column, dropped: tuple[str, ...] = ()) -> Column:
    """SHA-256 of the canonical form without the ``dropped`` root keys."""
    return F.sha2(canonical_json(doc, dropped), 256)


#: Root keys that are no part of a work item's identity.
WORK_DROPPED = ("$schema", "work_id", "created_at_utc")


def work_id(doc: Column, stage: Column) -> Column:
    return F.concat(F.coalesce(stage, F.lit("work")), F.lit("-"), F.substring(document_identity(doc, WORK_DROPPED), 1, 24))


def text_identity(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
