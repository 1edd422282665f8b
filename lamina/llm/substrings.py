"""Removal of repeated lines, and of repeated passages inside lines, by hashing units of the text.

There are two levels of units. The first are whole lines: a line that repeats goes, whatever its length. The second
are the parts of lines, as passages that many documents share also stand behind other text on a line, where no whole
line repeats. A line is cut into parts behind each token whose hash is the least of ``REACH`` tokens on either side,
so equal passages are cut alike whatever stands around them; a passage spliced into a line spoils the parts at its
two ends only; where tokens recur within the reach, every ``MOST`` tokens are a part. Parts are short, and chance
repeats some: a run of consecutive repeats is a passage if its parts add up to ``least_words`` words; shorter runs
stay (but for lines of the first level, which count towards the run).

A token is a run without white space, in lower case; in scripts without blanks, and in runs of more than ``WIDE``
characters, every character is a token, and ``LETTERS`` of them count as a word. A unit is the sequence of its tokens,
hashed to 96 bits; lines and parts have digests of their own. Digests are grouped over all documents: the occurrence
of least rank (doc_id, offset) stays, all others are repeats. The result keeps the offsets, in characters of the
original text, of what was removed, white space behind it included.

Texts are read once for their units, which are written to the shared folder, and once more, compressed for the way
to their marks, to take out the repeats.

Null texts stay null, and have no units, as have empty ones and those of white space. doc_id names a document: rows
that repeat one rank alike, so what the least doc_id holds stays in all of its rows, and texts that differ under one
doc_id are cleaned each by its own marks. A row without doc_id loses only repeats inside its own text, and is no
earlier occurrence to others. Texts may have any length; a document is held whole by one task. An empty table gives
an empty result. Other columns of the input are handed on, whatever their names; n_lines, n_passages, removed_starts
and removed_ends are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, by_batch, prepare, task, written
from .graph import redealt

#: Words that a run of repeated parts needs, and tokens on either side of one that ends a part.
LEAST_WORDS, REACH = 20, 4
#: Tokens of a part without such a token: a multiple of all periods that have none.
MOST = 24
#: A longer token, and text in scripts without blanks, is taken by characters; so many of them count as a word.
WIDE, LETTERS = 64, 2
#: Characters whose units are found at a time; a longer text is taken alone.
AT_ONCE = 1 << 19
#: Scripts that are written without blanks, as ranges of code points.
DENSE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    """For each code point: 1 white space, 2 a script without blanks, 0 others."""
    out = np.zeros(0x110000, np.uint8)
    out[[c for c in range(0x3001) if chr(c).isspace()]] = 1
    for a, b in DENSE:
        out[a : b + 1] = 2
    return out


_KIND = _kinds()
#: Words whose hashes a task remembers.
REMEMBERED = 150_000


class Words(dict):
    """64-bit hashes of words; forgets them when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word.encode())
        return out


_WORDS = Words()
at_end(_WORDS.clear)


def lower(text: str) -> str:
    """The text in lower case, with every character at its place."""
    out = text.lower()
    return out if len(out) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * _ODD


def tokens(text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, whether it is a single character of a longer run) of each token of a text in lower case."""
    kind = _KIND[codes]
    ink = np.concatenate([[False], kind != 1, [False]])
    edges = np.flatnonzero(ink[1:] != ink[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = text.split()
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    dense = kind == 2
    parted = ends - starts > WIDE
    if dense.any():
        before = np.concatenate([[0], np.cumsum(dense)])
        parted |= before[ends] > before[starts]
    single = np.zeros(len(starts), bool)
    if parted.any():
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[starts[parted]] += 1
        inside[ends[parted]] -= 1
        places = np.flatnonzero(np.cumsum(inside[:-1]))
        starts = np.concatenate([starts[~parted], places])
        hashes = np.concatenate([hashes[~parted], _mix(codes[places].astype(np.uint64) * _ODD)])
        single = np.concatenate([single[~parted], np.ones(len(places), bool)])
        order = np.argsort(starts, kind="stable")
        starts, hashes, single = starts[order], hashes[order], single[order]
    return starts, hashes, single


def _ends(hashes: np.ndarray, single: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Whether a part ends behind each token: its value is the least of REACH tokens of its line on either side."""
    n, value = len(hashes), hashes
    if single.any():  # one character says too little to be rare
        two = _mix(hashes[:-2] + _mix(hashes[1:-1] + _mix(hashes[2:])))
        value = np.where(single, np.concatenate([two, hashes[n - min(n, 2) :]]), hashes)
    out = np.zeros(n, bool)
    if n > 2 * REACH:
        x = value[REACH : n - REACH]
        least = line[: n - 2 * REACH] == line[2 * REACH :]
        for k in range(1, REACH + 1):
            least &= (x < value[REACH - k : n - REACH - k]) & (x <= value[REACH + k : n - REACH + k])
        out[REACH : n - REACH] = least
    return out


def units(texts: list[str]) -> dict[str, np.ndarray]:
    """All units of some texts: the text's number; span up to the next unit; words; line or part; digest; whether the text has it before."""
    begins = np.cumsum([0, *(len(x) + 1 for x in texts)])
    joined = lower("\n".join(texts))
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    starts, hashes, single = tokens(joined, codes)
    n = len(starts)
    if not n:
        return {}
    line = np.searchsorted(np.flatnonzero(codes == 10), starts)
    new_line = np.concatenate([[True], line[1:] != line[:-1]])
    new_part = new_line.copy()
    new_part[1:] |= _ends(hashes, single, line)[:-1]
    heads = np.flatnonzero(new_part)
    sizes = np.diff(np.append(heads, n))
    if (sizes > MOST).any():
        pieces = -(-sizes // MOST)
        heads = np.repeat(heads, pieces) + MOST * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    firsts = np.searchsorted(heads, np.flatnonzero(new_line))  # the first part of each line
    lasts = np.append(firsts[1:], len(heads)) - 1
    bounds, weight = np.append(heads, n), np.concatenate([[0], np.cumsum(np.where(single, 1, LETTERS))])
    text = np.searchsorted(begins, starts[heads], "right") - 1
    stops = np.append(starts[heads[1:]], len(joined))
    last_of_text = np.append(text[1:] != text[:-1], True)
    stops[last_of_text] = begins[text[last_of_text] + 1] - 1  # white space at a text's end belongs to its last unit
    data = memoryview(hashes.tobytes())
    part, of_line = range(len(heads)), zip(firsts.tolist(), lasts.tolist(), strict=True)
    edges = (bounds * 8).tolist()
    found = [xxhash.xxh3_128_digest(data[edges[i] : edges[i + 1]]) for i in part]
    found += [xxhash.xxh3_128_digest(data[edges[a] : edges[b + 1]], 1) for a, b in of_line]
    first, last = np.concatenate([np.arange(len(heads)), firsts]), np.concatenate([np.arange(len(heads)), lasts])
    owner, seen, again = text[first], set(), np.zeros(len(found), bool)
    for i, name in enumerate(zip(owner.tolist(), found, strict=True)):
        if name in seen:
            again[i] = True
        else:
            seen.add(name)
    pairs = np.frombuffer(b"".join(found), np.dtype([("hi", "<i8"), ("lo", "<i4"), ("rest", "<i4")]))
    return {
        "text": owner, "start": starts[heads[first]] - begins[owner], "stop": stops[last] - begins[owner],
        "words": np.maximum(1, (weight[bounds[last + 1]] - weight[bounds[first]]) // LETTERS), "line": np.arange(len(found)) >= len(heads), "hi": pairs["hi"].copy(), "lo": pairs["lo"].copy(), "again": again,
    }


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts one behind the other, some at a time."""
    at, held = 0, 0
    for i, x in enumerate(texts):
        if held and held + len(x or "") > AT_ONCE:
            yield at, [x or "" for x in texts[at:i]]
            at, held = i, 0
        held += len(x or "")
    if texts:
        yield at, [x or "" for x in texts[at:]]


def unit_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hash, span, weight, hi, lo, again): every unit of every document.

    hash is that of the text; span holds the start and the end, 32 bits each, weight twice the words, and one for lines.
    """

    def rows(batch):
        ids, hashes = (batch.column(c).combine_chunks() if isinstance(batch.column(c), pa.ChunkedArray) else batch.column(c) for c in ("doc_id", "hash"))
        for at, many in _groups(batch.column("text").to_pylist()):
            if u := units(many):
                own = pa.array(u["text"] + at)
                yield {
                    "doc_id": ids.take(own), "hash": hashes.take(own), "span": (u["start"] << 32) | u["stop"], "weight": pa.array(u["words"] * 2 + u["line"]).cast(pa.int32()),
                    "hi": u["hi"], "lo": u["lo"], "again": u["again"],
                }

    named = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("hash"), F.col(f"`{text}`").alias("text"))
    return by_batch(named, rows, "doc_id long, hash long, span long, weight int, hi long, lo int, again boolean")


def removed(marks: list, least_words: int) -> tuple[list[tuple[int, int]], int, int]:
    """The spans that go, and the numbers of lines and of passages, from the marked units of a text: (span, weight).

    Units follow each other if one begins where the other ends.
    """
    runs: list[list] = []
    at = -1
    # of a line and its first part, the line comes first
    for a, _, b, weight in sorted((span >> 32, -(weight & 1), span & 0xFFFFFFFF, weight) for span, weight in marks):
        if a >= at:  # else a part of a line that goes
            if a > at:
                runs.append([])
            runs[-1].append((a, b, weight >> 1, weight & 1))
            at = b
    out, lines, passages = [], 0, 0
    for run in runs:
        passage = sum(words for _, _, words, _ in run) >= least_words
        passages += passage
        for a, b, _, line in run:
            lines += line
            if line or passage:
                out.append((out.pop()[0] if out and out[-1][1] == a else a, b))
    return out, lines, passages


def without(text: str, gone: list[tuple[int, int]]) -> str:
    """The text without some spans."""
    ends = [0, *(b for _, b in gone)]
    return "".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)], strict=True))


def drop_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the text left over, and n_lines, n_passages, removed_starts, removed_ends in place of such columns.

    n_lines counts repeated whole lines, n_passages repeated runs of at least ``least_words`` words; both are removed.
    """
    prepare(docs.sparkSession)
    found = written(unit_table(docs, key, text), "units")
    fresh = found.where("not again and doc_id is not null")
    firsts = fresh.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"), F.count("*").alias("many")).where("many > 1").select("hi", "lo", "first")
    facts = ("span", "weight")
    repeats = fresh.join(redealt(firsts, "hi", "lo"), ["hi", "lo"]).where("doc_id <> first").select("doc_id", "hash", *facts)
    marked = repeats.unionByName(found.where("again").select("doc_id", "hash", *facts))
    marks = marked.groupBy(F.col("doc_id").alias("marked doc"), F.col("hash").alias("marked hash")).agg(F.collect_set(F.struct(*facts)).alias("marks"))

    new = ("n_lines", "n_passages", "removed_starts", "removed_ends")

    @F.pandas_udf("binary")
    def squeezed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for many in task(parts):
            yield many.map(lambda x: None if x is None else pa.compress(x.encode(), "zstd", asbytes=True))

    @F.pandas_udf("text string, n_lines long, n_passages long, removed_starts array<long>, removed_ends array<long>")
    def clean(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for many, sizes, marked in task(parts):
            out = []
            for x, size, own in zip(many, sizes, marked, strict=True):
                x = None if x is None else pa.decompress(x, int(size), "zstd", asbytes=True).decode()
                gone, *counts = removed([(m["span"], m["weight"]) for m in own], least_words) if x is not None and own is not None else ([], 0, 0)
                out.append((without(x, gone) if gone else x, *counts, [a for a, _ in gone], [b for _, b in gone]))
            yield pd.DataFrame(out, columns=["text", *new])

    # other columns travel in one, so that their names, whatever they are, meet none of those used here
    others = [c for c in docs.columns if c != text and c not in new]
    packed = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.xxhash64(f"`{text}`").alias("own hash"), squeezed(F.col(f"`{text}`")).alias("body"), F.octet_length(f"`{text}`").alias("body size"), F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest"))
    same = F.col("doc").eqNullSafe(F.col("marked doc")) & (F.col("own hash") == F.col("marked hash"))
    joined = packed.join(redealt(marks, "marked doc", "marked hash"), same, "left")
    cleaned = joined.select("rest", clean(F.col("body"), F.col("body size"), F.col("marks")).alias("cleaned"))
    own = [F.col("cleaned.text").alias(c) if c == text else F.col(f"rest.`{c}`") for c in docs.columns if c not in new]
    return cleaned.select(*own, *(F.col(f"cleaned.{c}").alias(c) for c in new))
