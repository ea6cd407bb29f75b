import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import mixing, packing, token_files
from ledgermatch.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, h string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", "y") for i, t, s in rows], SCHEMA)


def some(n=60):
    rows = [(i, " ".join(f"w{i}x{j} and, the" for j in range(1 + i * 7 % 40)), f"s{i % 3}") for i in range(n)]
    return rows + [(900, None, "s0"), (901, "", None), (902, "ein Wort " * 5000, "s1"), (903, "same", "s2"), (903, "same", "s2"), (None, "no id", None)]


@pytest.mark.parametrize(("path", "lower"), [(WORD, True), (BYTE, False)])
@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from(list("ab cdE éßÑ\n\t'.,!&#|-12À́İς漢😀 <|endoftext|>")), max_size=60))
def test_encoder_equals_library(path, lower, text):
    e = _encoders.setdefault((path, lower), Encoder(path, lower))
    assert next(iter(e.encode(pa.array([text])))).tolist() == e.whole.encode(text, add_special_tokens=False).ids


_encoders: dict = {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_bin_completion(lengths):
    plan = packing.complete_bins(np.bincount(lengths, minlength=65), 64, steps=9_000)
    used = sorted(x for items, n in plan.patterns for _ in range(n) for x in items)
    assert used == sorted(lengths) and all(sum(items) <= 64 for items, _ in plan.patterns)
    assert plan.bound <= plan.bins <= sum(n for _, n in packing.best_fit_decreasing(np.bincount(lengths, minlength=65), 64))


def test_bin_completion_beats_best_fit():
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    assert packing.complete_bins(np.bincount(lengths, minlength=61), 60).bins == 3


def fewest_bins(lengths, capacity):
    """By trying every bin for each item."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(3, 30), min_size=1, max_size=11))
def test_bin_completion_is_optimal(lengths):
    plan = packing.complete_bins(np.bincount(lengths, minlength=41), 40, steps=10_000_000)
    assert plan.proven and plan.bins == fewest_bins(lengths, 40)


def test_fillings():
    counts = np.zeros(21, np.int64)
    counts[[3, 5, 7, 12]] = [4, 2, 1, 1]
    got = list(packing.fillings(counts, 17))
    assert got[0] == (12, 5) and (7, 5, 5) not in got
    counts[12] = 0
    got = list(packing.fillings(counts, 17))
    assert got[0] == (7, 5, 5) and len(set(got)) == len(got)
    assert all(sum(f) <= 17 and all(f.count(x) <= counts[x] for x in f) for f in got)
    assert list(packing.fillings(counts, 2)) == [()]


def test_packing(spark):
    rows = some()
    out = packing.pack_documents(docs(spark, rows), WORD).collect()
    e = Encoder(WORD, True)
    want = {}
    for i, t, _ in rows:
        ids = np.array(e.ids(t or "") + [0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            want.setdefault((i, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())), []).append(1)
    got = {}
    places = {}
    for r in out:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == -(-sum(r.length for r in out) // 2048)
    assert packing.pack_documents(docs(spark, []), WORD).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    assert token_files.unpack(token_files.pack(ids, bits), bits, len(ids)).tolist() == ids.tolist()


def test_token_file_random_access():
    documents = [np.arange(n, dtype=np.uint32) % 5000 for n in (3, 0, 700, 41)]
    f = token_files.TokenFile(token_files.encode_file(documents, [4, None, -7, 9], 5000, block=64))
    assert f.bits == 13 and f.doc_ids == [4, None, -7, 9]
    assert [f.document(i).tolist() for i in range(4)] == [d.tolist() for d in documents]
    assert f.ids(60, 70).tolist() == np.concatenate(documents)[60:70].tolist()
    crc = [zlib.crc32(d.astype("<u4").tobytes()) for d in documents]
    assert all(list(f.checksums(span)) == crc for span in (1, 50, 64, 10_000))
    with pytest.raises(ValueError, match="not a token file"):
        token_files.TokenFile(b"short")
    with pytest.raises(ValueError, match="beyond the vocabulary"):
        token_files.encode_file([np.array([5000])], [1], 5000)


def test_token_files(spark):
    rows = some()
    written = token_files.write(docs(spark, rows), BYTE, files=3)
    got = sorted(token_files.read(spark, written).collect(), key=lambda r: r.start)
    e = Encoder(BYTE, False)
    ordered = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    at = 0
    for r, (i, t, _) in zip(got, ordered, strict=True):
        ids = np.array(e.ids(t or "") + [0], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.read(spark, token_files.write(docs(spark, []), BYTE)).count() == 0


def test_files_follow_the_volume(spark, monkeypatch):
    rows = [(i, "some words and more " * 50, "x") for i in range(300)]
    monkeypatch.setattr(token_files, "FILE_BYTES", 30_000)
    written = token_files.write(docs(spark, rows), BYTE)
    made = written.manifest.collect()
    assert 8 <= len(made) <= 12 and sum(r.n_docs for r in made) == 300 and len({r.file for r in made}) == len(made)
    ids = np.array(Encoder(BYTE, False).ids(rows[0][1]) + [0], dtype="<u4")
    assert {(r.n_tokens, r.ids_crc32) for r in token_files.read(spark, written).collect()} == {(len(ids), zlib.crc32(ids.tobytes()))}


def test_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 100, None: 50}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight, total = {"a": 1.0, "b": 2.0, "c": 3.0, None: 1.0}, 1160.0
    want, live = {}, dict(weight)
    while True:
        left = total - sum(want.values())
        share = {k: left * w / sum(live.values()) for k, w in live.items()}
        over = [k for k in live if share[k] > 3 * sizes[k]]
        if not over:
            want |= share
            break
        for k in over:
            want[k] = 3.0 * sizes[k]
            del live[k]
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}


def test_mix(spark):
    rows = [(i, "word " * (1 + i * 13 % 97), ["a", "b", "c", "c", "c", "c", "c", None][i % 8]) for i in range(800)] + [(5000, None, "a"), (5001, "", "z"), (5002, "two words", "a"), (5002, "two words", "a")]
    df = docs(spark, rows)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    source = {i: s for i, _, s in rows}
    taken, target = {}, {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= max(4, 0.01 * target[s]) for s in target)
    copies = {}
    for r in mixing.mixed_documents(df).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.copies == "x" and r.h == "y"
    want = {}
    for r in out:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert copies == {k: v for k, v in want.items() if v}
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mixed_documents(docs(spark, [])).count() == 0


def test_mix_of_one_text_in_several_sources(spark):
    rows = [(1, "one two three", "x"), (1, "one two three", "y"), (1, "one two three", None), (1, "one two three", "x"), (2, "four five", "x"), (2, None, "y"), (2, None, None)]
    out = mixing.mix(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.size) for r in out) == sorted((i, len((t or "").split())) for i, t, _ in rows)
    want = {}
    for r in out:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = mixing.mixed_documents(docs(spark, rows)).collect()
    assert len(got) == sum(want.values())


def test_dual_with_very_long_documents(spark):
    sizes = {
        "one": {230 + i: 250 for i in range(40)} | {1_000_000: 1},
        "ten": {230 + i: 2500 for i in range(40)} | {2_000_000: 10},
        "five": {230 + i: 250 for i in range(40)} | {300_000: 5},
        "few words": {1: 3, 2: 2},
    }
    counts, goals = [], []
    for name, by_size in sizes.items():
        total, squares = sum(s * n for s, n in by_size.items()), float(sum(s * s * n for s, n in by_size.items()))
        for part in (0.001, 0.2, 1 / 3, 1.0, 2.5, 2.9, 2.999999):
            counts += [(f"{name} {part}", s, n) for s, n in by_size.items()]
            goals.append((f"{name} {part}", total, squares, part * total))
    got = mixing.dual(spark.createDataFrame(counts, "sid string, size long, n long"), spark.createDataFrame(goals, "sid string, source_size long, source_squares double, target double")).collect()
    assert len(got) == len(goals)
    target = {sid: t for sid, _, _, t in goals}
    for r in got:
        taken = sum(n * s * min(3.0, float(np.exp(min(r.lam * s / r.scale, 2.0)))) for sid, s, n in counts if sid == r.sid)
        assert abs(taken - target[r.sid]) <= 1e-6 * target[r.sid], r.sid


def test_dual_without_solution(spark):
    counts, goals = spark.createDataFrame([("a", 5, 1)], "sid string, size long, n long"), spark.createDataFrame([("a", 10, 50.0, 20.0)], "sid string, source_size long, source_squares double, target double")
    with pytest.raises(ArithmeticError, match="'a'"):
        mixing.dual(counts, goals)
