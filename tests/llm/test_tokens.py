"""Packing under several limits and alignment of two tokenizers, against the plain way to both."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyroom.llm import alignment, units, vector_packing
from tests.llm.conftest import SMALL, rows_of

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WHOLE = Tokenizer.from_file(BYTES)
ODD = [
    "", None, " ", "a  b ", " a", "tab\there\r\n", "x<|endoftext|>y <s> z", "▁x", "x ▁", "a\xa0b", "é é", "日本 語。", "a\x00b \x1c d", "it's 3.5, ²½", "  a 　b",
    "word " * 900, "\n" * 3000 + "a", "🙂 🙂", "</s> <0x41> A", "x" * 3000, "ﬁ ①", " \x85 b",
]


def odd_frame(spark, odd_documents):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, "short")], "doc_id long, text string")
    return more.unionByName(odd_documents.select("doc_id", "text")).withColumn("tokens", F.lit("clash")).withColumn("ids", F.lit(1)).withColumn("links", F.lit(1))


def split(found):
    ids, begin = found
    return [ids[b:e].tolist() for b, e in zip(begin, begin[1:])]


@given(st.lists(st.text(st.sampled_from(list("ab Z1é's\n\t\xa0 ́<|endoftext|>▁日🙂\x1c\x85à²")), max_size=30), max_size=8), st.integers(3, 9))
@settings(max_examples=300, deadline=None)
def test_ids_of_parts_are_those_of_whole_texts(texts, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(units.parts_of, "__defaults__", (size,))
        plain, special, pieces = units.byte_level(BYTES, True), units.byte_level(BYTES, False), units.piece_model(PIECES)
        whole = WHOLE
        whole.encode_special_tokens = False
        assert split(special.ids(texts)) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
        whole.encode_special_tokens = True
        assert split(plain.ids(texts, " ")) == [e.ids for e in whole.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        assert split(pieces.ids(texts)) == pieces.model.encode(texts, num_threads=1)


def check_cut(placed, sizes, limits):
    pieces, used = defaultdict(list), defaultdict(list)
    for row, begin, tokens, sequence, offset in placed:
        pieces[row].append((begin, tokens))
        used[sequence].append((offset, tokens))
    for row, size in enumerate(sizes):
        ends = [0, *(b + t for b, t in sorted(pieces[row]))]
        assert [b for b, _ in sorted(pieces[row])] == ends[:-1] and ends[-1] == size
    lengths = []
    for held in used.values():
        ends = [0, *(o + t for o, t in sorted(held))]
        assert [o for o, _ in sorted(held)] == ends[:-1] and len(held) <= limits[1] and ends[-1] - len(held) <= limits[2]
        lengths.append(ends[-1])
    return lengths


@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 9), st.sampled_from([32, 40]))
@settings(max_examples=150, deadline=None)
def test_cut_documents_leave_no_padding(sizes, segments, capacity):
    limits = (capacity, segments, capacity - 1)
    lengths = check_cut(vector_packing.fill_cut(np.array(sizes, np.int64), limits), sizes, limits)
    assert all(n == capacity or n & (n - 1) == 0 for n in lengths) and sum(lengths) == sum(sizes)


@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 4), st.integers(0, 12)), max_size=50))
@settings(max_examples=150, deadline=None)
def test_whole_examples_follow_the_dot_product(rows):
    limits = (20, 4, 12)
    got = {row: (sequence, offset) for row, sequence, offset in vector_packing.fill_whole(np.array(rows, np.int64).reshape(-1, 3), limits)}
    left, want, sequence = dict(enumerate(rows)), {}, 0
    while left:
        free, held = list(limits), 0
        while fits := [i for i, r in left.items() if all(x <= y for x, y in zip(r, free))]:
            value = {i: np.float64(np.array(rows[i]) / np.array(limits) @ (np.array(free) / np.array(limits))) for i in fits}
            top = max(value.values())
            i = min((i for i in fits if value[i] >= top - 1e-12), key=lambda i: ([-x for x in rows[i]], i))
            want[i] = (sequence, limits[0] - free[0])
            free = [x - y for x, y in zip(free, left.pop(i))]
            held += 1
        sequence += 1
    assert {i: rows[i] for i in got} == dict(enumerate(rows))
    by_kind = [sorted((rows[i], *place) for i, place in found.items()) for found in (got, want)]
    assert len(set(p[1] for p in by_kind[0])) <= len(set(p[1] for p in by_kind[1])) + 1
    sums = defaultdict(lambda: np.zeros(3, int))
    for i, (sequence, _) in got.items():
        sums[sequence] += rows[i]
    assert all((s <= limits).all() for s in sums.values())


def pieces_are_right(rows, frame):
    whole = Tokenizer.from_file(BYTES)
    texts = defaultdict(list)
    for doc, text in rows_of(frame.select("doc_id", "text")):
        texts[doc].append([*whole.encode(text or "", add_special_tokens=False).ids, 1])
    covered, sequences = defaultdict(Counter), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        fits = [n for n, ids in enumerate(texts[r.doc_id]) if len(ids) == r.doc_tokens and zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert fits
        covered[r.doc_id][r.doc_tokens, r.start, r.length] += 1
    assert sum(r.length for r in rows) == sum(len(ids) for found in texts.values() for ids in found)
    for doc, found in texts.items():
        if len(found) == 1:
            ends = [0, *(b + n for _, b, n in sorted(covered[doc]))]
            assert [b for _, b, _ in sorted(covered[doc])] == ends[:-1] and ends[-1] == len(found[0])
    for held in sequences.values():
        ends = [0, *(o + n for o, n in sorted(held))]
        assert [o for o, _ in sorted(held)] == ends[:-1] and (ends[-1] == 2048 or ends[-1] & (ends[-1] - 1) == 0) and len(held) <= 256
    return len(sequences)


def test_documents_in_sequences(documents, spark, odd_documents):
    rows = vector_packing.pack_documents(documents, BYTES).collect()
    assert pieces_are_right(rows, documents) <= sum(r.length for r in rows) / 2048 + 11
    odd = odd_frame(spark, odd_documents)
    pieces_are_right(vector_packing.pack_documents(odd, BYTES).collect(), odd)
    assert vector_packing.pack_documents(odd.limit(0), BYTES).count() == 0
    with pytest.raises(ValueError, match="loss"):
        vector_packing.pack_documents(odd, BYTES, (64, 4, 10))


def test_conversations_under_three_limits(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    examples = vector_packing.instruction_examples(turns, BYTES)
    whole = Tokenizer.from_file(BYTES)
    want = defaultdict(lambda: [0, 0, 0])
    for r in turns.collect():
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1
        for k, x in enumerate((n, 1, n if r.role == "assistant" else 0)):
            want[r.conv_id][k] += x
    assert {r.conv_id: [r.tokens, r.segments, r.loss] for r in examples.collect()} == want
    top = [max(v[k] for v in want.values()) for k in range(3)]
    limits = (2 * top[0], 2 * top[1], int(1.5 * top[2]))
    rows = vector_packing.pack_examples(examples.withColumn("key", F.lit("k")), limits).collect()
    sums, held = defaultdict(lambda: np.zeros(3, int)), defaultdict(list)
    for r in rows:
        sums[r.sequence_id] += (r.tokens, r.segments, r.loss)
        held[r.sequence_id].append((r.offset, r.tokens))
    assert len(rows) == len(want) and all((s <= limits).all() for s in sums.values())
    least = max(-(-sum(v[k] for v in want.values()) // limits[k]) for k in range(3))
    assert len(sums) <= 1.25 * least + 1
    for places in held.values():
        ends = [0, *(o + n for o, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1]


def test_examples_that_cannot_be_packed(spark):
    frame = spark.createDataFrame([("x", 5, 1, 5), ("x", 5, 1, 5), ("y", 8, 2, 0)], "name string, tokens int, segments int, loss int")
    assert vector_packing.pack_examples(frame, (8, 2, 8)).count() == 3
    assert vector_packing.pack_examples(frame.limit(0), (8, 2, 8)).count() == 0
    for bad, limits in ((frame, (8, 1, 8)), (frame.withColumn("loss", F.lit(None).cast("int")), (8, 2, 8)), (frame.withColumn("tokens", F.lit(0)), (8, 2, 8))):
        with pytest.raises(ValueError, match="within the limits"):
            vector_packing.pack_examples(bad, limits)
    with pytest.raises(ValueError, match="rename"):
        vector_packing.pack_examples(frame.withColumn("offset", F.lit(1)), (8, 2, 8))


def plain_alignment(docs):
    tokenizer, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True
    letters = units.byte_values()
    per_doc, counts = [], Counter()
    for doc, text in docs:
        wanted = (" " + text).encode() if text else b""
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        sides = [[(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in a]]
        names = [model.id_to_piece(i) for i in b]
        sides.append([(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()) for i, p in zip(b, names)])
        if not text or any(b"".join(x for _, x in side) != wanted for side in sides):
            per_doc.append((doc, 0, 0, [], []))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        common = sorted(set(ends[0]) & set(ends[1]))
        shared, written = set(common), []
        for side, own in zip(sides, ends):
            written.append([[]])
            for (i, _), e in zip(side, own):
                written[-1][-1].append(str(i))
                if e in shared:
                    written[-1].append([])
        groups = ["|".join(map(",".join, both)) for both in zip(*written)][:-1]
        at = dict(zip(ends[1], b))
        links = [(i, at[e]) for i, e in zip(a, ends[0]) if e in at]
        counts.update(links)
        per_doc.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (a, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, n_a, n_b, groups, links in per_doc:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest))
    return Counter(out)


def test_alignment_is_that_of_the_plain_way(documents, spark, odd_documents):
    odd = odd_frame(spark, odd_documents)
    for frame in (documents, odd):
        got = alignment.align_documents(frame, BYTES, PIECES)
        assert Counter(rows_of(got)) == plain_alignment(rows_of(frame.select("doc_id", "text")))
    assert alignment.align_documents(odd.limit(0), BYTES, PIECES).count() == 0


def test_alignment_in_parts(documents, monkeypatch):
    texts = [t for _, t in rows_of(documents.select("doc_id", "text"))][:60] + ["", None, "x ▁ y", "a  b c"]
    both = alignment.aligner(BYTES, PIECES)
    whole = list(both.rows(list(range(len(texts))), texts))
    monkeypatch.setattr(units.parts_of, "__defaults__", (64,))
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    assert list(both.rows(list(range(len(texts))), texts)) == whole
