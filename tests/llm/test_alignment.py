"""Alignment of two tokenizers against a plain pass over byte offsets, with the tokenizer files themselves."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from engage.llm import alignment, common, queries

EDGES = [
    None, "", " ", "a", "  two  spaces ", "▁", "x▁y", "<|endoftext|> and <s> <unk>", "tab\tnew\nline", "naïve \U0001f600 中文 ᄀ",
    "é", "\x00\x01", "<0x41>", "a" * 5000, "word " * 4000, "中" * 3000,
]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens_by_force(encoders, text):
    """Ids and end offsets of both, none unless the joined bytes are those of a space and the text."""
    if not text:
        return [], []
    file, model = encoders
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    byte = {chr(b) if b in shown else chr(next(rest)): b for b in range(256)}
    coded = file.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(byte[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def by_force(encoders, rows):
    """Digests of each row, from all pairs of tokens that end together."""
    told, corpus = [], Counter()
    for doc_id, text in rows:
        a, b = tokens_by_force(encoders, text)
        ends = []
        for side in (a, b):
            at, out = 0, {}
            for i, t in side:
                at += len(t)
                out[at] = i
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, before = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for at, i in side.items() if before < at <= cut) for side in ends]
            groups.append("|".join(sides))
            before = cut
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        corpus.update(links)
        told.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, b), n in corpus.items():
        most[b] = max(most[b], n)
    return sorted(
        (doc_id or -1, n_a, n_b, len(links), len(links), sum(corpus[x] == most[x[1]] for x in links), sum(corpus[x] for x in links), sha)
        for doc_id, n_a, n_b, links, sha in told
    )


NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def found(df):
    return sorted(((r.doc_id or -1), *[r[c] for c in NAMES[1:]]) for r in df.select(*NAMES).collect())


def test_query(spark, data_dir, encoders):
    docs = common.table(spark, data_dir, "documents").collect()
    assert found(queries.op12_alignment(spark, data_dir)) == by_force(encoders, [(r.doc_id, r.text) for r in docs])


@pytest.mark.parametrize("chunk", [1, 700, 1 << 19])
def test_edges_repeats_and_chunks(spark, monkeypatch, encoders, chunk):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", chunk)
    monkeypatch.setattr(alignment, "TEXT_BYTES", 3000)
    rows = [*enumerate(EDGES), (3, "a"), (None, "a b c"), (None, None), (4, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_a", "2 AS chunk", "3 AS pair")
    assert found(alignment.linked(alignment.align(docs, lane=50))) == by_force(encoders, rows)
    assert alignment.linked(alignment.align(docs.limit(0))).count() == 0
    assert found(alignment.linked(alignment.align(docs.where("text IS NULL")))) == [(-1, *[0] * 6, "")] * 2


@pytest.mark.parametrize("lane", [1, 3, 17, 1000])
def test_lockstep_finds_all_common_ends(monkeypatch, lane):
    monkeypatch.setattr(alignment, "SEARCH", 4)
    r = np.random.default_rng(lane)
    a, b = [], []
    for _ in range(80):
        size = int(r.integers(0, 400))
        sides = [np.unique(np.append(r.integers(1, size + 1, size=int(r.integers(0, size + 1))), size)) if size else np.zeros(0, dtype=np.int64) for _ in range(2)]
        a.append(sides[0])
        b.append(sides[1])
    bounds = [np.concatenate([[0], np.cumsum([len(x) for x in side])]) for side in (a, b)]
    cuts = alignment.lockstep(np.concatenate(a), np.concatenate(b), *bounds, lane)
    for side, place, own in zip((a, b), cuts, bounds):
        want = [own[k] + np.searchsorted(side[k], np.intersect1d(a[k], b[k])) + 1 for k in range(len(a))]
        assert np.array_equal(place, np.concatenate(want))


def test_spans_give_the_text_back(spark, data_dir, encoders):
    own = alignment.Tokenizers()
    docs = common.table(spark, data_dir, "documents").where("doc_id < 40")
    for row in alignment.align(docs).join(docs, "doc_id").collect():
        if row.a_ids:
            groups = zip([0, *row.a_cuts], row.a_cuts, [0, *row.b_cuts], row.b_cuts)
            spans = [(b"".join(own.a_bytes[t] for t in row.a_ids[a:c]), b"".join(own.b_bytes[t] for t in row.b_ids[b:d])) for a, c, b, d in groups]
            assert all(x == y for x, y in spans) and b"".join(x for x, _ in spans) == (" " + row.text).encode()


def test_ranks_give_the_ids_of_the_tokenizer_file(encoders):
    own, r = alignment.Tokenizers(), random.Random(1)
    parts = ["a", " ", "  ", "\n", "<|endoftext|>", "1", "'s", "É", "中", "!", "the", "\U0001f600", " "]
    for _ in range(300):
        text = "".join(r.choices(parts, k=40))
        assert own.a.encode_ordinary(" " + text) == encoders[0].encode(" " + text, add_special_tokens=False).ids


def test_ids_are_python_numbers_of_a_few_texts_at_a_time(monkeypatch):
    own, sizes = alignment.Tokenizers(), []
    encode = own.encode
    monkeypatch.setattr(own, "encode", lambda texts: sizes.append(sum(len(t or "") for t in texts)) or encode(texts))
    texts = ["some words " * 500] * 100 + [None, ""]
    coded = alignment._coded(own, pa.array(texts))
    assert max(sizes) <= alignment.CODED_BYTES < sum(sizes) == 100 * 5500
    assert [(a.tolist(), b.tolist()) for a, b in coded] == encode(texts)
