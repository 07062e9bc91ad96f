"""The streaming encoder and decoder against the tokenizers library, and the lookahead against brute force."""

import hashlib
import itertools
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from engage.llm import common, queries, transducer

# Marks that combine, special tokens whole and cut, letters with odd lower case, code points of many classes, contractions.
PARTS = [
    "a", "b", "in", "th", "'", "'s", "'re", "'ve", "'ll", "R", "É", "é", "́", "̣", "中", "文", "한",
    "ᄀ", "ᅡ", "ᆨ", "!", "!!", "1", "٣", " ", "\n", "\x1c", " ", " ", "<|endoftext|>", "<|endof",
    "<|startoftext|>", "Σ", "İ", "\U0001f600", "՘", "ſ", "K", "‍",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(transducer.TOKENIZER))


def wanted(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def unpacked(ids):
    return [i[0] for i in struct.iter_unpack("<I", ids)]


@pytest.mark.parametrize("long", [transducer.LONG, 8])
def test_any_text_is_encoded_and_decoded_as_by_the_library(library, long):
    own, decoder, r = transducer.Tokenizer(long=long), transducer.Decoder(), random.Random(long)
    texts = ["", " ", "́", "'", "<|endoftext|>", "Hello, World's 1234 naïve!!'re"]
    texts += ["".join(r.choices(r.sample(PARTS, r.randint(1, len(PARTS))), k=r.choice([3, 30, 300]))) for _ in range(1500)]
    texts += ["a" * 30_000, "ab'" * 9000, "!" * 20_000, "中文" * 9000, "ẹ́" * 5000]
    for text in texts:
        ids, back = wanted(library, text)
        assert unpacked(own.encode(text.encode())) == ids
        assert decoder.decode(own.encode(text.encode()), run=7) == back


def test_slices_do_not_matter(library):
    own, r = transducer.Tokenizer(), random.Random(5)
    for _ in range(60):
        text = "".join(r.choices(r.sample(PARTS, r.randint(1, 9)), k=r.choice([20, 900, 9000])))
        cuts = sorted(r.choices(range(len(text) + 1), k=r.choice([1, 5, 80])))
        slices = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        assert list(itertools.chain.from_iterable(own.stream(slices))) == wanted(library, text)[0]


def trained(r, symbols, rules):
    """A merge list in the order of the counts of pairs in a random text."""
    words = [r.choices(symbols, k=r.randint(2, 12)) for _ in range(60)]
    merges = []
    for _ in range(rules):
        pairs = sorted(p for w in words for p in zip(w, w[1:]) if "".join(p) not in {a + b for a, b in merges})
        if not pairs:
            break
        pair = max(pairs, key=lambda p: (pairs.count(p), p))
        merges.append(pair)
        for w in words:
            k = 0
            while k < len(w) - 1:
                if (w[k], w[k + 1]) == pair:
                    w[k : k + 2] = ["".join(pair)]
                k += 1
    return merges


@pytest.mark.parametrize("seed", range(12))
def test_lookahead_is_sufficient(seed):
    """Tokens that end before the lookahead are those of every continuation, and streaming in blocks gives those of the whole."""
    r = random.Random(seed)
    merges = trained(r, "abc", r.choice([3, 8, 15]))
    names = [*"abc", *dict.fromkeys(a + b for a, b in merges)]
    rules = transducer.Merges({t: k for k, t in enumerate(names)}, merges)
    ahead = rules.lookahead
    assert ahead is not None
    for _ in range(300):
        text = "".join(r.choices("abc", k=r.randint(1, 40)))
        seen, sizes = rules.merged(rules.symbols(text))
        more = rules.merged(rules.symbols(text + "".join(r.choices("abc", k=r.randint(0, 20)))))
        stable = [k for k in range(len(sizes)) if sum(sizes[: k + 1]) <= len(text) - ahead]
        assert more[0][: len(stable)] == seen[: len(stable)]
    long = "".join(r.choices("abc", k=2000)) + "ab" * 300
    piece, out, most = transducer.PieceEncoder(rules, block=5), [], 0
    for k in range(0, len(long), 3):
        out += piece.push(rules.symbols(long[k : k + 3]))
        most = max(most, len(piece.held))
    assert most <= 2 * 5 + ahead + 12 + 3  # memory is bounded by the lookahead, a block and the longest token
    assert out + piece.close() == rules.merged(rules.symbols(long))[0]


def test_lookahead_of_the_given_lists():
    assert transducer.sufficient_lookahead([("a", "b")]) == 1
    assert transducer.sufficient_lookahead([("b", "c"), ("a", "b")]) == 2  # abc: c decides about b, which decides about a
    assert transducer.sufficient_lookahead([("ab", "c"), ("a", "b")]) is None
    held = transducer.PieceEncoder(transducer.Merges({"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}, [("ab", "c"), ("a", "b")]), 1)
    assert held.push([0, 1] * 50) == [] and held.close() == [3] * 50
    assert transducer.Tokenizer().merges.lookahead < 1000


def test_short_and_long_merging_agree():
    own, r = transducer.Tokenizer(), random.Random(2)
    for _ in range(200):
        symbols = own.merges.symbols("".join(r.choices("etaoinshrdl", k=r.randint(1, 90))))
        assert own.merges._short(symbols) == own.merges._long(symbols)


def test_batches_of_words_are_encoded_as_one_by_one(library):
    own, r = transducer.Tokenizer(), random.Random(9)
    texts = ["".join(r.choices(r.sample(PARTS + list("etaoinshrdl"), r.randint(1, 20)), k=r.randint(0, 120))) for _ in range(2000)]
    texts += ["x" * n for n in range(1, 70)]
    got = own.encode_all([t.encode() for t in texts])
    assert [unpacked(g) for g in got] == [wanted(library, t)[0] for t in texts]
    assert own.encode_all([]) == [] and own.encode_all([b""]) == [b""]


def test_bytes_become_text_when_characters_are_complete():
    name = "byte_bpe_50k.json"
    library, decoder = Tokenizer.from_file(public_tokenizers.path(name)), transducer.Decoder(name)
    for text in ("naïve \U0001f600中文 <|endoftext|> x", "ஸ்ரீ \U0001f468‍\U0001f469"):
        ids = library.encode(text).ids
        assert "".join([decoder.feed([i]) for i in ids] + [decoder.close()]) == text
        for part in (ids[1:], ids[:-1], ids[::-1]):  # cut and turned round: not UTF-8 any more
            assert "".join([decoder.feed([i]) for i in part] + [decoder.close()]) == library.decode(part, skip_special_tokens=False)


def test_query(spark, data_dir, library):
    texts = common.table(spark, data_dir, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op13_bpe(spark, data_dir).collect()}
    assert len(got) == len(texts)
    for row in texts:
        ids, back = wanted(library, row.text or "")
        found = got[row.doc_id]
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert found.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_rows_without_text_and_columns_of_the_same_names(spark):
    rows = [(1, None), (None, ""), (2, " \n"), (2, "same"), (2, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS n_tokens")
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in transducer.round_trip(docs).collect()]
    assert [g[0] for g in got] == [1, None, 2, 2, 2]
    assert all(g[1:] == (0, b"", "") for g in got[:3]) and got[3] == got[4] and got[3][3] == "same</w>"
    assert transducer.round_trip(docs.limit(0)).count() == 0
