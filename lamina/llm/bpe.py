"""Byte-level BPE encoding and decoding with DuckDB recursive queries, one connection per Python worker.

A text is cut by the tokenizer's pattern; each distinct piece of a batch that is not in the vocabulary as a
whole becomes rows (word, position, token id). A recursive query joins neighbouring tokens with the merge
table, contracts the leftmost pair of least rank of each word, and goes on with the words that had one; a
word's rows at its last step are its tokens. Decoding joins token rows with the vocabulary and concatenates
their bytes in order of position.

The recursion keeps the rows of every step, as many as the square of a word's length, so words go into queries by
the sum of these squares, which bounds memory; nothing is spilled. One step contracts one pair of a word. Pieces of
more than ``LONG`` bytes without a blank would take steps by the thousand, each over the whole piece; these are
contracted with a heap instead, to the same result. Long token lists are decoded in slices.

Null and empty texts have no tokens; texts may have any length. Rows are independent of each other: repeated rows,
and rows without a key, give results alike; ties of rank go to the leftmost pair, as the method says; an empty table
gives an empty one; columns other than the two that are named are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import at_end, by_batch, texts

LONG = 512
#: Rows that a query may hold: of all steps of its words, and of the tokens that it decodes.
STEP_ROWS, TOKEN_ROWS = 3_000_000, 400_000
#: Pieces that a worker remembers; it forgets them all beyond that.
REMEMBERED = 500_000

_STEPS = """
WITH RECURSIVE walk(step, w, p, id) AS (
  SELECT 0, w, p, id FROM start
  UNION ALL
  (WITH neighbours AS (
     SELECT step, w, p, id, lead(id) OVER by_place AS next_id, lead(p) OVER by_place AS next_p
     FROM walk WINDOW by_place AS (ORDER BY w, p)),
   least AS (
     SELECT w, min(m.rank * 4294967296 + p) AS first, arg_min(next_p, m.rank * 4294967296 + p) AS gone
     FROM neighbours AS n JOIN merges AS m ON m.pair = n.id * 4294967296 + n.next_id
     WHERE next_p > p GROUP BY w)
   SELECT step + 1, n.w, n.p, CASE WHEN n.p = (first & 4294967295) THEN first >> 32 ELSE n.id END
   FROM neighbours AS n JOIN least USING (w) WHERE n.p <> gone)
)
SELECT w, list(id ORDER BY p) AS ids
FROM walk JOIN (SELECT w, max(step) AS step FROM walk GROUP BY w) USING (w, step) GROUP BY w ORDER BY w
"""
_DECODE = "SELECT doc, string_agg(piece, '' ORDER BY place) AS text FROM tokens JOIN vocabulary USING (id) GROUP BY doc"


class Codec:
    """The vocabulary of a rank file, its merge table in DuckDB, and the pieces met so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)])
        merges = [(a, b, r) for t, r in self.ranks.items() for i in range(1, len(t)) if (a := self.ranks.get(t[:i])) is not None and (b := self.ranks.get(t[i:])) is not None]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        pairs = np.array(merges, dtype=np.int64).reshape(-1, 3)
        self._table("merges", pair=(pairs[:, 0] << 32) + pairs[:, 1], rank=pairs[:, 2].copy())
        # DuckDB concatenates text, not blobs: a byte stands as the character of its number
        self._table("vocabulary", id=np.array([*self.ranks.values()], dtype=np.int64), piece=[t.decode("latin-1") for t in self.ranks])

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self.db.register(name, pa.table(columns))
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _by_heap(self, data: bytes) -> list[int]:
        parts: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        after, before = [*range(1, len(parts) + 1)], [*range(-1, len(parts) - 1)]
        pair = lambda i: self.ranks.get(parts[i] + parts[after[i]]) if after[i] < len(parts) else None
        heap = [(r, i) for i in range(len(parts)) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if parts[i] is None or pair(i) != rank:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = parts[i] + parts[gone], None, after[gone]
            if after[i] < len(parts):
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (r := pair(j)) is not None:
                    heapq.heappush(heap, (r, j))
        return [self.ranks[x] for x in parts if x is not None]

    def learn(self, pieces: set[str]) -> None:
        """Contract the pieces that are not known yet."""
        words = []
        for piece in pieces:
            data = piece.encode()
            if (whole := self.ranks.get(data)) is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(data) > LONG:
                self.known[piece] = np.array(self._by_heap(data), dtype="<u4").tobytes()
            else:
                words.append((piece, data))
        held, rows = [], 0
        for word in words:
            steps = len(word[1]) ** 2 // 2 + 1
            if held and rows + steps > STEP_ROWS:
                self._contract(held)
                held, rows = [], 0
            held.append(word)
            rows += steps
        if held:
            self._contract(held)

    def _contract(self, words: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(b) for _, b in words])
        flat = np.frombuffer(b"".join(b for _, b in words), np.uint8)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = self._query(_STEPS, "start", w=np.repeat(np.arange(len(words)), lengths), p=place, id=self.byte_ids[flat])
        ids = out.column("ids").combine_chunks()
        flat, ends = ids.flatten().to_numpy().astype("<u4").tobytes(), (ids.offsets.to_numpy() * 4).tolist()
        for (piece, _), a, b in zip(words, ends, ends[1:], strict=False):
            self.known[piece] = flat[a:b]

    def encode(self, documents: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self.pattern.findall(x) for x in documents]
        self.learn({p for pieces in cut for p in pieces if p not in self.known})
        known = self.known
        return [b"".join([known[p] for p in pieces]) for pieces in cut]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes that token ids, given as by ``encode``, stand for."""
        ids = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(encoded)), [len(x) // 4 for x in encoded])
        out: list[list[bytes]] = [[] for _ in encoded]
        for a in range(0, len(ids), TOKEN_ROWS):
            part = slice(a, a + TOKEN_ROWS)
            found = self._query(_DECODE, "tokens", doc=doc[part], place=np.arange(len(ids))[part], id=ids[part])
            for i, text in zip(found.column("doc").to_pylist(), found.column("text").to_pylist(), strict=True):
                out[i].append(text.encode("latin-1"))
        return [b"".join(x) for x in out]


_CODECS: dict[tuple[str, str], Codec] = {}


@at_end
def _forget() -> None:
    for tool in _CODECS.values():
        tool.db.close()
    _CODECS.clear()


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_column(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids): each text's token ids."""

    def rows(batch):
        encoded = codec(path, pattern).encode(texts(batch, text))
        return {key: batch.column(key), "n_tokens": [len(x) // 4 for x in encoded], "ids": [np.frombuffer(x, "<i4") for x in encoded]}

    return by_batch(docs.select(key, text), rows, f"{key} long, n_tokens long, ids array<int>")


def decode_column(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, data): the bytes of each list of token ids; a null list has none."""

    def rows(batch):
        lists = [np.array(x or [], dtype="<u4").tobytes() for x in batch.column(ids).to_pylist()]
        return {key: batch.column(key), "data": codec(path, pattern).decode(lists)}

    return by_batch(encoded.select(key, ids), rows, f"{key} long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of the token ids and of what they decode to; ids on demand."""

    def rows(batch):
        # all new pieces of a batch in one query; decoded a few texts at a time, as that takes rows for every token
        tool = codec(path, pattern)
        whole = tool.encode(texts(batch, text))
        for i in range(0, len(whole), 250):
            encoded = whole[i : i + 250]
            decoded = tool.decode(encoded)
            digest = lambda many: [hashlib.sha256(x).hexdigest() for x in many]
            out = {key: batch.column(key).slice(i, 250), "n_tokens": [len(x) // 4 for x in encoded], "ids_sha256": digest(encoded), "decoded_sha256": digest(decoded)}
            yield out | ({"ids": [np.frombuffer(x, "<i4") for x in encoded]} if with_ids else {})

    return by_batch(docs.select(key, text), rows, f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
