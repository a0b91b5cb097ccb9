"""Exact dedup, packing and token files on awkward rows and against direct computation."""

import bisect
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge_rows import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dedup, packing, token_orc, tokens
from tidemark.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_dedup_of_awkward_rows(spark):
    rows = exact_dedup.assign(documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    groups = defaultdict(list)
    for doc_id, text in TEXTS:
        groups[_sha(text)].append(doc_id)
    for row in rows:
        ids = groups[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (max(known) if known else None)
    for digest in groups:
        assert sum(r.kept for r in rows if r.text_sha256 == digest) == 1


def test_exact_dedup_keeps_whole_rows(spark):
    docs = documents(spark)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(_sha(r.text) for r in rows) == sorted({_sha(t) for _, t in TEXTS})
    assert {r["_digest"] for r in rows} == {"extra"}


def test_exact_dedup_with_a_frequent_text(spark):
    texts = [(i, "copied" if i % 3 else f"own {i}") for i in range(3000)]
    rows = exact_dedup.assign(documents(spark, texts)).collect()
    copied = [r for r in rows if r.group_size > 1]
    assert {(r.keep_id, r.group_size) for r in copied} == {(2999, 2000)}
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1001


def test_empty_documents(spark):
    none = documents(spark).limit(0)
    assert exact_dedup.assign(none).collect() == []
    assert exact_dedup.deduplicate(none).collect() == []
    assert packing.place(packing.cut(none, BYTE_BPE, 64, 0), 64).collect() == []
    path = scratch_path(spark, "orc")
    token_orc.write(none, path, WORD_BPE, 1)
    assert token_orc.summary(token_orc.read(spark, path)).collect() == []


def test_packing_gives_back_every_document(spark):
    limit = 64
    pieces = packing.cut(documents(spark), BYTE_BPE, limit, end_id=0)
    rows = packing.place(pieces, limit, shard_pieces=4).collect()
    library = tokens.load(BYTE_BPE)
    expected = sorted(
        tuple(library.encode(t or "", add_special_tokens=False).ids + [0]) for _, t in TEXTS
    )
    by_doc = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.tag):
        assert r.length == len(r.ids) // 4 <= limit
        if r.piece == 0:
            current = r.tag
        by_doc[current].append(r)
    for parts in by_doc.values():
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert all(p.length == limit for p in parts[1:])
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
    found = [
        tuple(np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist())
        for parts in by_doc.values()
    ]
    assert sorted(found) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=200))
def test_fill_is_gapless_and_never_opens_without_need(lengths):
    lengths = sorted(lengths, reverse=True)
    number, offset = packing.fill(lengths, 40)
    used = defaultdict(int)
    for n, o, size in zip(number, offset, lengths):
        if n not in used:  # a new sequence: nothing open had room
            assert all(total + size > 40 for total in used.values())
        assert o == used[n]
        used[n] += size
    assert max(used.values()) <= 40


def test_fill_follows_the_sum_of_squares():
    # Open gaps are 3, 4 and 4. A piece of 2 in gap 3 leaves squares of 1 + 4, in a gap
    # of 4 only 1 + 1 + 1, though gap 3 is the tighter fit.
    number, offset = packing.fill([7, 6, 6, 2], 10)
    assert number[3] in (1, 2) and offset[3] == 6


def test_fill_wastes_little():
    lengths = np.sort(np.random.default_rng(3).integers(1, 2048, 8000))[::-1].tolist()
    number, _ = packing.fill(lengths, 2048)
    gaps, opened = [], 0  # best fit, for comparison
    for length in lengths:
        i = bisect.bisect_left(gaps, length)
        opened += i == len(gaps)
        bisect.insort(gaps, (gaps.pop(i) if i < len(gaps) else 2048) - length)
    assert number.max() + 1 <= opened + 3


TRICKY = ["a  b   c \n\n d\t \te", "don't we'll I'M 'S", "É T̈ naïve É", " lead", "trail ",
          "", "x\n\ny .\nStart 'tis", "<|endoftext|>", "a\x1cb \x85 c", "×÷ a×b", "ΑΣ Σ word's,foo",
          "123abc 4,5-6", "a" * 300, "ab　cd 　 ef"]


@pytest.mark.parametrize(
    "path, kind", [(BYTE_BPE, tokens.SpacePrefixed), (WORD_BPE, tokens.SpaceFree)]
)
def test_ids_are_those_of_the_library(path, kind):
    library, encoder = tokens.load(path), kind(tokens.load(path))

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="ab É́' \n\tsSt.1#ß　Σ", max_size=40))
    def check(text):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == expected

    check()
    for text in TRICKY:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == expected


def test_token_files_round_trip(spark):
    path = scratch_path(spark, "orc")
    token_orc.write(documents(spark), path, WORD_BPE, end_id=1)
    stored = token_orc.read(spark, path).orderBy("row_id").collect()
    library = tokens.load(WORD_BPE)
    expected = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in expected]
    assert [r.doc_id for r in stored] == [i for i, _ in expected]
    assert [list(r.ids) for r in stored] == ids
    found = token_orc.summary(token_orc.read(spark, path)).orderBy("start").collect()
    starts = np.cumsum([0] + [len(x) for x in ids[:-1]]).tolist()
    assert [r.start for r in found] == starts
    assert [r.n_tokens for r in found] == [len(x) for x in ids]
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def test_token_files_skip_by_metadata(spark):
    # ORC looks at a stripe's size every 5,000 rows.
    texts = [(i, " ".join(str(i * j % 9973) for j in range(9))) for i in range(24_000)]
    path = scratch_path(spark, "orc")
    token_orc.write(documents(spark, texts), path, WORD_BPE, 1, stripe_bytes=1 << 14)
    few = token_orc.read_documents(spark, path, [17, 3999])
    assert sorted(r.doc_id for r in few.collect()) == [17, 3999]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [17,3999])]" in plan
    import glob

    from pyarrow import orc

    files = glob.glob(f"{path.removeprefix('file:')}/*.orc")
    assert sum(orc.ORCFile(f).nstripes for f in files) > len(files)
    assert any(b"doc_id" in open(f, "rb").read() for f in files)
