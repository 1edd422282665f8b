"""Token counts of the parts of a document, from one encoding of the whole.

A text is encoded once; every token has the span of characters that its bytes stand for. Spans are joined with
the spans of sections (by default lines, each with its line end) by their positions. A token that crosses a
boundary belongs to one section by an explicit rule:

``start``     the section of the token's first character
``end``       the section of its last character
``majority``  the section that holds most of its characters, the earlier one in a tie

A token inside a character (a byte of several) has the span of that character. Fields are sections too:
``field_spans`` gives them for fields that were put together with a separator, which belongs to the field before.

Null and empty texts have no tokens and no sections; texts may have any length. Rows are independent of each other:
repeated rows, and rows without a key, give results alike, an empty table an empty one; columns other than the two
that are named are not read, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import at_end, by_batch, texts

RULES = ("start", "end", "majority")


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    widths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        widths[rank] = len(token)
    return tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), widths


at_end(_encoding.cache_clear)


def line_starts(text: str) -> list[int]:
    """Where each line begins; a line ends behind its line feed."""
    out, at = [0] if text else [], text.find("\n")
    while 0 <= at < len(text) - 1:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return out


def field_spans(fields: list[str], separator: str = "\n") -> tuple[str, list[int]]:
    """Fields as one text, and where each begins."""
    ends = np.cumsum([len(x) + len(separator) for x in fields])
    return separator.join(fields), [0, *ends[:-1].tolist()] if fields else []


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token."""
    tool, widths = _encoding(path, pattern)
    ends = np.cumsum(widths[np.array(tool.encode_ordinary(text), dtype=np.int64)])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) > len(text):
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1]
    return starts, ends - 1


def attribute(first: np.ndarray, last: np.ndarray, sections: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """The section of each token by the rule, and whether the token crosses a boundary.

    sections: where each section begins, from 0 upwards; empty sections share a begin and hold nothing.
    """
    low, high = np.searchsorted(sections, first, "right") - 1, np.searchsorted(sections, last, "right") - 1
    if rule == "majority":
        out = low.copy()
        for t in np.flatnonzero(high > low):
            edges = np.clip(np.append(sections[low[t] : high[t] + 1], last[t] + 1), first[t], None)
            out[t] = low[t] + np.diff(edges).argmax()
        return out, high > low
    return {"start": low, "end": high}[rule], high > low


def token_counts(docs: DataFrame, path: str, pattern: str, rule: str = "start", sections: Callable[[str], list[int]] = line_starts, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_sections, n_crossing, section_starts, section_tokens) for every row of docs."""
    if rule not in RULES:
        raise ValueError(f"no rule {rule}")

    def rows(batch):
        out = {c: [] for c in ("n_tokens", "n_sections", "n_crossing", "section_starts", "section_tokens")}
        for x in texts(batch, text):
            begin = np.array(sections(x), np.int64)
            first, last = token_spans(x, path, pattern)
            owner, crossing = attribute(first, last, begin, rule) if len(begin) else (np.zeros(0, np.int64), np.zeros(0, bool))
            for c, v in zip(out, (len(first), len(begin), int(crossing.sum()), begin, np.bincount(owner, minlength=len(begin))), strict=True):
                out[c].append(v)
        lists = {c: pa.array(out[c], pa.list_(pa.int64())) for c in ("section_starts", "section_tokens")}
        return {key: batch.column(key)} | out | lists

    return by_batch(docs.select(key, text), rows, f"{key} long, n_tokens long, n_sections long, n_crossing long, section_starts array<long>, section_tokens array<long>")
