"""Operators on texts, against brute force."""

import base64
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import attribution, bpe, media, minhash, mixing, substrings
from lamina.llm import queries as q

from .helpers import awkward, edited, frame, text

RANKS = q.RANKS


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("reference", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(x):
    return hashlib.sha256(x).hexdigest()


# bpe ---------------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_reference(spark, reference):
    rows = [*awkward(), (90, "x" * 5000 + " aaaa" * 50), (91, "don't we'll  \n\n  12345 ...!? <|endoftext|>")]
    out = bpe.round_trip(frame(spark, rows, True), RANKS, P.PATTERN, with_ids=True).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        for r in by[i]:
            assert (r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256) == (len(ids), ids, sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()))
    encoded = bpe.encode_column(frame(spark, rows), RANKS, P.PATTERN)
    decoded = {r.doc_id: bytes(r.data) for r in bpe.decode_column(encoded, RANKS, P.PATTERN).collect()}
    assert decoded == {i: (t or "").encode() for i, t in rows}
    assert bpe.round_trip(frame(spark, []), RANKS, P.PATTERN).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=80))
def test_bpe_both_ways_agree(reference, t):
    codec = bpe.codec(RANKS, P.PATTERN)
    ids = np.array(reference.encode_ordinary(t), "<u4").tobytes()
    assert codec.encode([t]) == [ids] and codec.decode([ids]) == [t.encode()]
    for piece in codec.pattern.findall(t):
        if piece.encode() not in codec.ranks:
            assert codec._by_heap(piece.encode()) == reference.encode_ordinary(piece)


def test_bpe_in_small_queries(reference, monkeypatch):
    monkeypatch.setattr(bpe, "STEP_ROWS", 500)
    monkeypatch.setattr(bpe, "TOKEN_ROWS", 7)
    rng, codec = random.Random(2), bpe.Codec(RANKS, P.PATTERN)
    many = [text(i, 6) + " " + "".join(rng.choices("abcdefgh", k=n)) for i, n in enumerate((3, 40, 255, 256, 257, 511, 512, 513, 700))]
    encoded = codec.encode(many)
    assert encoded == [np.array(reference.encode_ordinary(t), "<u4").tobytes() for t in many] and codec.decode(encoded) == [t.encode() for t in many]


def test_bpe_query(spark, reference):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in q.op7_byte_bpe(spark, d).collect():
        assert r.ids_sha256 == sha(np.array(reference.encode_ordinary(docs[r.doc_id]), "<u4").tobytes()) and r.decoded_sha256 == sha(docs[r.doc_id].encode())


# token counts ------------------------------------------------------------------------------------------------------


def test_token_counts_add_up(spark, reference):
    rows = awkward()
    for rule in attribution.RULES:
        out = attribution.token_counts(frame(spark, rows, True), RANKS, P.PATTERN, rule).collect()
        assert len(out) == len(rows)
        expected = {i: len(reference.encode_ordinary(t or "")) for i, t in rows}
        assert all(r.n_tokens == expected[r.doc_id] == sum(r.section_tokens) and len(r.section_tokens) == r.n_sections for r in out)
        assert all(r.n_sections == 0 for r in out if r.doc_id in (2, 3))
    assert attribution.token_counts(frame(spark, []), RANKS, P.PATTERN).count() == 0


def brute_owner(first, last, sections, rule):
    place = lambda c: max(i for i, s in enumerate(sections) if s <= c)
    if rule == "start":
        return place(first)
    if rule == "end":
        return place(last)
    inside = [sum(place(c) == i for c in range(first, last + 1)) for i in range(len(sections))]
    return inside.index(max(inside))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=8), st.sets(st.integers(1, 30), max_size=6), st.sampled_from(attribution.RULES))
def test_attribution_rules(widths, cuts, rule):
    ends = np.cumsum(widths)
    first, last = ends - widths, ends - 1
    sections = np.array(sorted({0, *(c for c in cuts if c < ends[-1])}))
    owner, crossing = attribution.attribute(first, last, sections, rule)
    assert owner.tolist() == [brute_owner(a, b, sections.tolist(), rule) for a, b in zip(first, last, strict=True)]
    assert crossing.tolist() == [any(a < s <= b for s in sections) for a, b in zip(first, last, strict=True)]


def test_spans_count_characters_and_fields():
    t = "Größe 東京 \U0001f600x"
    first, last = attribution.token_spans(t, RANKS, P.PATTERN)
    assert first[0] == 0 and last[-1] == len(t) - 1 and (first <= last).all()
    joined, starts = attribution.field_spans(["ab", "", "c"], "\n")
    assert joined == "ab\n\nc" and starts == [0, 3, 4]
    assert attribution.line_starts("a\nb\n") == [0, 2] and attribution.line_starts("") == []


# minhash -----------------------------------------------------------------------------------------------------------


def brute_components(rows, n, percent):
    def shingles(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        k = min(n, len(words))
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()

    sets = [(i, shingles(t)) for i, t in rows]
    least = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for (i, a), (j, b) in itertools.combinations(sets, 2):
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b) and least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return {i: (len(s), least[i]) for i, s in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, n):
    rows = awkward()
    out = minhash.near_duplicates(frame(spark, rows, True), n).collect()
    assert len(out) == len(rows)
    expected = brute_components(rows, n, 80)
    for r in out:
        assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, minhash.near_duplicates(frame(spark, rows).repartition(7), n).collect()), key=str)
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("block", "hub", "centres"), [(4, 3, 1), (128, 256, 3)])
def test_large_buckets_are_compared_in_blocks(spark, monkeypatch, block, hub, centres):
    for name, value in (("BLOCK", block), ("HUB", hub), ("CENTRES", centres)):
        monkeypatch.setattr(minhash, name, value)
    base = text(7, 6)
    rows = [(i, edited(base, i, 0.01 * (i % 9))) for i in range(40)]
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), 2).collect()}
    assert out == {i: c for i, (_, c) in brute_components(rows, 2, 80).items()}


def test_chained_documents_link_where_they_are_similar(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    # each document shares half to nine tenths of its words with the next, so that buckets chain all of them
    rows, at = [], 0
    for i in range(400):
        rows.append((i, " ".join(words[at % 3800 : at % 3800 + 60])))
        at += rng.choice((3, 6, 14, 20))
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), 2).collect()}
    assert out == {i: c for i, (_, c) in brute_components(rows, 2, 80).items()} and 50 < len(set(out.values())) < 400


def test_many_rows_of_one_document_and_rows_without_one(spark):
    one = text(1)
    rows = [(5, one)] * 20_000 + [(5, f"{text(2)} {i}") for i in range(300)] + [(3, text(2)), (9, one), (7, text(3)), (None, one), (None, one), (None, text(9))]
    out = minhash.near_duplicates(frame(spark, rows)).groupBy("doc_id", "component_id", "kept").count().collect()
    assert {(r.doc_id, r.component_id, r.kept, r["count"]) for r in out} == {(5, 3, False, 20_300), (3, 3, True, 1), (9, 3, False, 1), (7, 7, True, 1), (None, None, True, 3)}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=13, max_size=20))
def test_links_of_many_equal_those_of_pairs(found):
    sets = [np.array(sorted(s), np.uint64) for s in found]
    assert sorted(minhash.links(sets, 80)) == [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if minhash.similar(sets[i], sets[j], 80)]


def test_signature_estimates_similarity():
    a, b = (minhash.shingles(t, 2) for t in (text(1, 60), edited(text(1, 60), 1, 0.1)))
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash.signature(a) == minhash.signature(b)).mean() - j) < 0.15


def test_minhash_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    expected = brute_components(rows, 2, 80)
    out = q.op2_minhash(spark, d).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected


# substrings --------------------------------------------------------------------------------------------------------


def plain_parts(line, reach=4, most=24):
    """The parts of a line of words, word by word."""
    words = line.lower().split()
    value = [xxhash.xxh3_64_intdigest(w.encode()) for w in words]
    out = [[]]
    for i, w in enumerate(words):
        out[-1].append(w)
        near = value[max(0, i - reach) : i], value[i + 1 : i + 1 + reach]
        if len(near[0]) == len(near[1]) == reach and value[i] < min(near[0]) and value[i] <= min(near[1]):
            out.append([])
    return [tuple(p[k : k + most]) for p in out for k in range(0, len(p), most)]


def brute_repeats(rows, least):
    """The words of each row that are left, from lines and parts as tuples of words; shares nothing with the operator."""
    named = lambda t: [(("line", *line.lower().split()), [("part", *p) for p in plain_parts(line)]) for line in (t or "").split("\n") if line.strip()]
    first = {}
    for i, t in rows:
        for line, parts in named(t) if i is not None else ():
            for u in (line, *parts):
                first[u] = min(first.get(u, i), i)
    out = []
    for i, t in rows:
        seen, flat = set(), []
        for line, parts in named(t):
            hit = {}
            for u in (line, *parts):
                hit[u] = hit.get(u) or u in seen or (i is not None and first[u] != i)
            marked = []
            for p in parts:
                marked.append(hit[line] or p in seen or (i is not None and first[p] != i))
                seen.add(p)
            flat += [(p[1:], m, hit[line]) for p, m in zip(parts, marked, strict=True)]
            seen.add(line)
        words = []
        for marked, run in itertools.groupby(flat, key=lambda x: x[1]):
            run = [*run]
            goes = marked and sum(len(p) for p, _, _ in run) >= least
            words += [w for p, _, whole in run if not (goes or whole) for w in p]
        out.append(words)
    return out


def rebuilt(t, r):
    spans = [*zip(r.removed_starts, r.removed_ends, strict=True)]
    assert all(a < b for a, b in spans) and all(b <= c for (_, b), (c, _) in itertools.pairwise(spans))
    return "".join(t[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(t)], strict=True))


def test_repeats_go_and_offsets_stay(spark):
    passage = " ".join(text(99, 6).split())
    rows = [*awkward(), (60, text(60) + " " + passage), (61, "Own words here. " + passage + "\n" + text(61)), (62, passage.upper() + "  xyzzy"), (63, "Short one. Short one. " + text(63)), (64, "a b c " * 100 + text(64)), (65, "again\n" * 5 + "behind")]
    out = substrings.drop_repeats(frame(spark, rows, True)).collect()
    assert len(out) == len(rows) and "kept" in out[0].asDict()
    texts = dict(rows)
    for r in out:
        if r.text is not None:
            assert r.text == rebuilt(texts[r.doc_id], r)
        assert (r.n_lines + r.n_passages > 0) == bool(r.removed_starts)
    by = {r.doc_id: r for r in out}
    left = brute_repeats(rows, substrings.LEAST_WORDS)
    assert all((by[i].text or "").lower().split() == words for (i, _), words in zip(rows, left, strict=True) if i != 9)
    assert passage in by[60].text and len(by[61].text) < len(texts[61]) - 0.8 * len(passage) and by[61].text.startswith("Own words here. ") and by[62].n_passages == 1
    assert by[63].text == texts[63] and by[40].text == texts[40] and by[1].text == texts[1] and by[6].text == "" and by[65].text == "again\nbehind"
    assert len(by[64].text) < len(text(64)) + 160
    assert substrings.drop_repeats(frame(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab.!\n \u4e00\u4e01\xa0\u0130", max_size=60), min_size=1, max_size=4))
def test_units_cover_all_but_white_space(many):
    found = substrings.units(many)
    for k, t in enumerate(many):
        at = 0
        for i in np.flatnonzero((found["text"] == k) & ~found["line"]) if found else ():
            a, b = int(found["start"][i]), int(found["stop"][i])
            assert a >= at and b > a and not t[at:a].strip() and t[a:b].strip()
            assert at == 0 or a == at
            at = b
        assert not t[at:].strip()
        if found:
            lines = [(int(found["start"][i]), int(found["stop"][i])) for i in np.flatnonzero((found["text"] == k) & found["line"])]
            assert [t[a:b].strip() for a, b in lines] == [x.strip() for x in t.split("\n") if x.strip()]


def test_units_do_not_hang_on_other_texts_of_a_batch():
    many = [text(i, 9) + ("\u4e00\u4e8c\u4e09" * 40 if i % 2 else "") + "z" * 100 * (i % 3) for i in range(8)]
    whole = substrings.units(many)
    for k, t in enumerate(many):
        alone, own = substrings.units([t]), whole["text"] == k
        assert all((alone[c] == whole[c][own]).all() for c in whole if c != "text")


def test_units_equal_plain_ones(spark):
    t = text(5, 30) + "\n" + " ".join(text(6, 30).split()) + "\n" + "x y " * 70
    found = substrings.units([t])
    parts = [t[a:b].lower().split() for a, b, line in zip(found["start"], found["stop"], found["line"], strict=True) if not line]
    assert parts == [list(p) for line in t.split("\n") for p in plain_parts(line)]
    assert found["words"][~found["line"]].tolist() == [len(p) for p in parts]


def test_lines_that_repeat_go_at_any_length(spark):
    rng = random.Random(8)
    pool = ["Les.", "Licensed under the Apache License, version 2.0.", "Tion was. Es heon thou the.", "a b c. d. e", "one two three four five six seven eight nine"]
    rows = [(i, "\n".join(f"own{i}x{j}" if rng.random() < 0.4 else rng.choice(pool).replace(" ", " " * rng.randrange(1, 3)) for j in range(8))) for i in range(30)]
    met, expected = set(), {}
    for i, t in rows:  # lines alone, without any of the operator's own functions
        left = []
        for line in t.split("\n"):
            name = " ".join(line.lower().split())
            left += [] if name in met else [line]
            met.add(name)
        expected[i] = "\n".join(left)
    out = {r.doc_id: r.text for r in substrings.drop_repeats(frame(spark, rows)).collect()}
    assert {i: t.rstrip("\n") for i, t in out.items()} == expected
    # a few words inside other lines stay
    out = substrings.drop_repeats(frame(spark, [(1, "Les."), (2, "Les. Other words"), (3, "And more. Les.")])).collect()
    assert {r.doc_id: r.text for r in out} == {1: "Les.", 2: "Les. Other words", 3: "And more. Les."}


def test_rows_that_share_a_doc_id_and_hot_rows(spark):
    rows = [(5, "one line\nown words of the first"), (5, "one line\nown words of the second"), (7, "x\none line"), *[(9, "hot line\nhot again\nhot line")] * 3000, (11, "hot again")]
    out = defaultdict(set)
    for r in substrings.drop_repeats(frame(spark, rows)).collect():
        out[r.doc_id].add(r.text)
    assert out == {5: {t for i, t in rows if i == 5}, 7: {"x\n"}, 9: {"hot line\nhot again\n"}, 11: {""}}


@pytest.mark.parametrize("size", [30, 40, 100_000])
def test_spliced_passages_and_text_without_blanks_go(spark, size):
    rng = random.Random(size)

    def running(n, at):  # sentences of a size, from any word of the first
        return " ".join("".join(rng.choices("abcdefgh", k=7)) + ("." if (at + k) % size == size - 1 else "") for k in range(n))

    shared = [running(51, rng.randrange(size)) for _ in range(40)]
    rows = [(2 * k + j, f"{running(20, 0)} {x} {running(20, 0)}") for k, x in enumerate(shared) for j in (0, 1)]
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120))
    other = lambda: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(40))
    rows += [(200, han), (201, other() + "\u3002" + han), (202, other() + han + other())]
    out = {r.doc_id: r for r in substrings.drop_repeats(frame(spark, rows)).collect()}
    # parts at both ends of a passage are cut with what surrounds it, and stay
    assert all(out[2 * k].n_passages == 0 for k in range(40)) and sum(out[2 * k + 1].n_passages for k in range(40)) >= 39
    assert sum(len(out[2 * k + 1].text.split()) for k in range(40)) < 40 * 62
    assert len(out[201].text) <= 70 and len(out[202].text) <= 120 and out[200].text == han


# media -------------------------------------------------------------------------------------------------------------


def test_media_round_trip(spark):
    rows = [*awkward(), (80, "y" * 576), (81, "z" * 575)]
    out = media.media_features(media.media_column(frame(spark, rows, True))).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        data = (texts[r.doc_id] or "").encode()
        body = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(body), sha(body), zlib.crc32(body[-32:]))
        assert r.samples == len(body) and r.sample_rate == 16000 and len(r.seek_offsets) == len(body) // 576
        assert r.media_sha256 == sha(media.encode(data))
    assert len({r.feature for r in out if r.doc_id in (1, 6)}) == 1
    assert media.media_column(frame(spark, [])).count() == 0 and media.media_features(media.media_column(frame(spark, []))).count() == 0


def test_parser_resynchronises_and_checks():
    data = media.encode(b"a" * 3000)
    clean = media.parse(data)
    assert clean.table["frames"] == len(clean.offsets) == 6 and clean.failed == clean.resyncs == 0 and float(clean.duration) == 6 * 576 / 16000
    assert clean.tags["bytes"] == "3000" and clean.table["bytes"] == len(data) - 128 - (clean.offsets[0] - 144)
    at = clean.offsets[2]
    broken = media.parse(data[:at] + b"\xff\xfb garbage \xff" + data[at:])
    assert broken.resyncs == 1 and len(broken.offsets) == 6 and broken.skipped == 12
    damaged = bytearray(data)
    damaged[at + 7] ^= 1  # in the side information, which the checksum covers
    assert media.parse(bytes(damaged)).failed == 1
    damaged = bytearray(data)
    damaged[at + 100] ^= 1
    with pytest.raises(ValueError):
        media.payload(bytes(damaged), media.parse(bytes(damaged)))
    assert media.parse(b"").offsets == [] and media.parse(b"no audio").skipped == 8


def test_parser_reads_other_streams():
    frame1 = b"\xff\xfb\x90\x00".ljust(417, b"\0")  # MPEG-1 layer III, 128 kbit/s, 44.1 kHz
    layer2 = b"\xff\xfd\x84\x00".ljust(384, b"\0")  # MPEG-1 layer II, 128 kbit/s, 48 kHz
    vbri = bytearray(frame1)
    vbri[36:62] = b"VBRI" + b"\0" * 6 + (1000).to_bytes(4, "big") + (3).to_bytes(4, "big") + (2).to_bytes(2, "big") + (1).to_bytes(2, "big") + (2).to_bytes(2, "big") + b"\0\0"
    vbri[62:66] = b"\0\5\0\7"
    s = media.parse(bytes(vbri) + frame1 * 3)
    assert s.table["kind"] == "VBRI" and s.table["seek"] == (5, 7) and s.samples == 3 * 1152 and s.rate == 44100
    assert media.parse(layer2 * 2).samples == 2304
    assert media.header(b"\xff\xff\xff\xff") is None and media.header(b"\xff\xe8\x90\x00") is None


def divided(bits):
    """The remainder of a string of bits, by long division."""
    register = [1] * 16
    for b in bits:
        out = register.pop(0) ^ b
        register.append(0)
        if out:
            for i in (0, 13, 15):
                register[i] ^= 1
    return int("".join(map(str, register)), 2)


def bits_of(data):
    return [b >> (7 - i) & 1 for b in data for i in range(8)]


@pytest.mark.parametrize(("start", "size", "widths", "channels", "bound", "layer"), [
    ("fffc8400", 384, [4] * 11 + [3] * 12 + [2] * 4, 2, 32, 2),  # 128 kbit/s, 48 kHz, stereo
    ("fffca0c0", 626, [4] * 11 + [3] * 12 + [2] * 7, 1, 32, 2),  # 192 kbit/s, 44.1 kHz, mono
    ("fffc1040", 104, [4] * 2 + [3] * 6, 2, 4, 2),  # 32 kbit/s, 44.1 kHz, joint stereo from band 4
    ("fffc2840", 216, [4] * 2 + [3] * 10, 2, 4, 2),  # 48 kbit/s, 32 kHz, joint stereo
    ("fff48400", 384, [4] * 4 + [3] * 7 + [2] * 19, 2, 32, 2),  # MPEG-2, 64 kbit/s, 24 kHz
    ("fffe4400", 128, [4] * 32, 2, 32, 1),  # layer I, 128 kbit/s, 48 kHz
    ("fffe4460", 128, [4] * 32, 2, 12, 1),  # joint stereo from band 12
])
def test_checksums_of_layers_one_and_two(start, size, widths, channels, bound, layer):
    rng, lead = random.Random(start), bytes.fromhex(start)
    frames = []
    for _ in range(4):
        body = bytearray(rng.randrange(256) if rng.random() < 0.6 else 0 for _ in range(size - 6))
        flat, at, chosen = bits_of(body), 0, 0
        for band, width in enumerate(widths):
            shared = band >= bound
            for _ in range(1 if shared else channels):
                chosen += (channels if shared else 1) * any(flat[at : at + width])
                at += width
        covered = at + (2 * chosen if layer == 2 else 0)
        frames.append(lead + divided(bits_of(lead[2:]) + flat[:covered]).to_bytes(2, "big") + bytes(body))
    found = media.parse(b"".join(frames))
    assert (len(found.offsets), found.checked, found.failed, found.skipped) == (4, 4, 0, 0)
    frames[1] = frames[1][:4] + bytes(2) + frames[1][6:]
    frames[2] = frames[2][:6] + bytes([frames[2][6] ^ 0x10]) + frames[2][7:]
    assert media.parse(b"".join(frames)).failed == 2


# mixing ------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights):
    out, left, open_ = [0.0] * len(sizes), 1.5 * sum(sizes), [*range(len(sizes))]
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        full = [i for i in open_ if share[i] > 2 * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i], left = 2.0 * sizes[i], left - 2 * sizes[i]
        open_ = [i for i in open_ if i not in full]
    return out


def test_targets_are_reshared_by_weight(spark):
    rng = random.Random(7)
    for sizes in ([5], [0, 0], [10, 1000, 10], *([rng.randrange(10 ** rng.randrange(1, 7)) for _ in range(rng.randrange(1, 30))] for _ in range(12))):
        df = spark.createDataFrame([(f"s{i:03}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        found = [r.target for r in mixing.targets(df).orderBy("rank").collect()]
        assert np.allclose(found, brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]), rtol=1e-12), sizes
    names = [r.source for r in mixing.targets(spark.createDataFrame([(x, 1) for x in ("b", None, "Z", "\U0001f600", "\uffee", "")], "source string, source_size long")).orderBy("rank").collect()]
    assert names == ["", "Z", "b", "\uffee", "\U0001f600", None]


def test_many_rows_of_one_document_are_spread(spark):
    rows = [(7, "a b c", "s")] * 30_000 + [(None, "a b", "s")] * 9_000 + [(i, "w " * (i % 50), "tu"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    began = time.time()
    out = mixing.mixed(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.count("*").alias("rows")).collect()
    assert time.time() - began < 120 and sum(r["rows"] for r in out) == len(rows)
    assert all(abs(r.taken - r.target) <= 60 for r in out)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=3, max_size=80), st.floats(0.05, 0.95), st.integers(0, 99))
def test_flight_keeps_totals(sizes, chance, seed):
    size, start = np.array(sizes), np.full(len(sizes), chance)
    p = mixing.flight(start, size, np.random.default_rng(seed), False)
    assert ((p > 0) & (p < 1)).sum() <= 2 and math.isclose(p.sum(), start.sum(), abs_tol=1e-5)
    assert math.isclose((p * size).sum(), (start * size).sum(), abs_tol=1e-2)
    assert set(mixing.flight(p, size, np.random.default_rng(seed), True)) <= {0.0, 1.0}


def test_flight_is_unbiased():
    size = np.arange(1, 21)
    mean = np.mean([mixing.flight(np.full(20, 0.3), size, np.random.default_rng(s), True) for s in range(600)], axis=0)
    assert abs(mean - 0.3).max() < 0.08


@pytest.mark.parametrize("block", [4096, 8])
def test_mix_meets_targets_and_reruns_agree(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(i, " ".join(["w"] * (i % 37)), ("b", "a", "é", None)[min(i % 7, 3)], "x") for i in range(400)] + [(7, "w w", "a", "x"), (None, None, "a", "x"), (900, "", "empty", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mixed(docs).collect()
    assert len(out) == len(rows) and sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mixed(docs.repartition(7)).collect()), key=str)
    sources = ["a", "b", "empty", "é", None]
    sizes = [sum(len((t or "").split()) for _, t, s, _ in rows if s == x) for x in sources]
    aims = brute_targets(sizes, [5, 2, 1, 5, 2])
    assert {(r.source_size, round(r.target, 6)) for r in out} == {(n, round(a, 6)) for n, a in zip(sizes, aims, strict=True)}
    for n, aim in zip(sizes, aims, strict=True):
        assert abs(sum(r.taken for r in out if r.source_size == n) - aim) <= 40
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_mixing_query(spark):
    out = q.op10_mixing(spark, "/root/testdata/sf0.01").groupBy("source_size", "target").sum("taken").collect()
    assert out and all(abs(r[2] - r[1]) <= 0.02 * r[1] + 60 for r in out)
