"""Each stage of the pipeline against a plain version, on the rows that the stage before it kept."""

import collections
import re

import corpus_pipeline
import pytest
from ledgermatch.llm import pii, quality
from ledgermatch.llm.common import cut

from test_text_operators import PLAIN, holds, shingles

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # repeated rows, near copies, nulls, empty and short texts, and personal data beside the table's own
    first = docs.where("text is not null").orderBy("doc_id").first().text
    more = [(9001, None, "en", "src1", 0), (9002, "", "en", "src1", 0), (9003, "few words", None, None, 9), (9004, first, "en", None, len(first)), (9005, first + " more", "en", "src2", len(first) + 5)]
    more += [(9006, " ".join(f"word{i}" for i in range(60)) + " by jo@x.org and 10.0.0.1.", "en", "src3", 1)] * 2
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(cut(stage(spark, frames[-1], SF), f"test-{name}"))
    return [sorted(map(tuple, f.collect()), key=str) for f in frames], frames


def test_columns(stages):
    rows, frames = stages
    assert all(f.columns == frames[0].columns for f in frames[1:5]) and all(rows)


def test_quality_rules(stages):
    before, after = stages[0][:2]
    kept = [r for r in before if all(not eval(rule.fails.replace("OR", "or").replace("AND", "and"), {}, dict(zip(quality.MEASURES, quality.measure_text(r[1]), strict=True))) for rule in quality.RULES)]
    assert after == kept


def test_near_duplicates(stages):
    before, after = stages[0][1:3]
    sets = [shingles(r[1]) for r in before]
    group = list(range(len(before)))
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= 80 * (len(a) + len(sets[j]) - o) and group[i] != group[j]:
                x, y = max(group[i], group[j]), min(group[i], group[j])
                group = [y if g == x else g for g in group]
    of = collections.defaultdict(list)
    for r, g, s in zip(before, group, sets, strict=True):
        of[g if s else ("none", id(r))].append(r)
    left = collections.Counter(after)
    for members in of.values():
        least = min(r[0] for r in members)
        stay = [r for r in set(members) if left[r]]
        assert sum(left[r] for r in set(members)) == 1 and stay[0][0] == least
    assert len(after) == len(of) < len(before)


def test_personal_data(stages, spark):
    rows, frames = stages
    before, after = rows[2], {r[0]: r for r in rows[3]}
    terms = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term")] for r in pii.report(frames[2]).collect()}
    assert len(after) == len(before) and sum("[email]" in (r[1] or "") for r in after.values())
    for doc_id, text, *others, n in before:
        spans = [(m.start(), m.end(), k) for k, (_, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if holds(pii.KINDS[k], m[0])] + [(a, b, 4) for a, b in terms[doc_id]]
        want, at = "", 0
        for a, b, k in sorted(spans, key=lambda s: (s[0], s[1], s[2])):
            if a >= at:
                want += text[at:a] + f"[{pii.KINDS[k]}]"
            at = max(at, b)
        want = None if text is None else want + text[at:]
        assert after[doc_id][:4] == (doc_id, want, *others) and after[doc_id][4] == (None if want is None else len(want))


def test_mix(stages):
    before, after = stages[0][3:5]
    size = lambda r: len(WORDS.findall(r[1] or ""))
    total = collections.Counter()
    for r in before:
        total[r[3]] += size(r)
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    want, full = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        level = rest / max(1, sum(weight[s] for s in order if s not in full))
        want = {s: 3 * total[s] if s in full else level * weight[s] for s in order}
        over = {s for s in order if s not in full and want[s] > 3 * total[s]}
        if not over:
            break
        full |= over
    known, copies, taken = collections.Counter(before), collections.Counter(after), collections.Counter()
    for r, n in copies.items():
        assert r in known and n <= 3 * known[r]
        taken[r[3]] += n * size(r)
    for s in order:
        smallest = sorted(size(r) for r in before if r[3] == s and size(r))
        assert abs(taken[s] - want[s]) <= max(smallest, default=0), s
    assert len(after) > 0.5 * len(before)


def test_packing(stages, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, frames = stages
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = collections.Counter()
    for r in rows[4]:
        n = len(made.encode(r[1] or "", add_special_tokens=False).ids) + 1
        for k in range(0, n, 2048):
            lengths[r[0], k // 2048, k, min(2048, n - k)] += 1
    pieces = frames[5].collect()
    assert collections.Counter((p.doc_id, p.piece, p.start, p.length) for p in pieces) == lengths
    filled = collections.defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= 1.05 * sum(p.length for p in pieces) / 2048 + 1


def test_run_and_empty_tables(spark, tmp_path, stages):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == stages[1][5].columns and out.count() > 0
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    none = corpus_pipeline.run(spark, str(tmp_path))
    assert none.columns == out.columns and none.count() == 0
