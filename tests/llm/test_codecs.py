import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from scorelab.llm import bpe_codec, huffman_ids, length_histogram
from scorelab.llm.bytewords import text_buffers
from scorelab.llm.pretokens import PreTokens, classes_of_json, classes_of_ranks

public = pytest.importorskip("public_tokenizers")
RANKS, JSON = public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json")
ALPHABET = " \n\t　'stmdrevl  'aZé9½!#_- 漢\U0001d518\U0001f600é\0"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    return [*made, "", " ", "\n\n x", "it's 'tis we'll 'llama 'S don't've", "a" * 5000, " " * 3000 + "x", "ab " * 2000, "1234567 ½½", "naïve café \U0001f600\U0001f600"]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "own", "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")


def test_classes_agree_between_libraries():
    assert classes_of_ranks() == classes_of_json()


def test_cuts_equal_the_pattern(texts):
    import regex

    rule = regex.compile(public.PATTERN)
    data, offs = text_buffers(pa.array(texts))
    at, first = PreTokens(classes_of_ranks()).cut(data, offs)
    for i, t in enumerate(texts):
        edges = [*at[first[i] : first[i + 1]], offs[i + 1]]
        assert [bytes(data[a:b]).decode() for a, b in zip(edges, edges[1:])] == rule.findall(t)


def test_encode_and_decode_equal_the_library(spark, texts, library):
    df = rows(spark, [*texts, None])
    coded = bpe_codec.encode(df, RANKS)
    got = {r["doc_id"]: r for r in bpe_codec.decode(coded.withColumn("kept", coded["ids"]), RANKS).collect()}
    for i, t in enumerate([*texts, None]):
        assert got[i]["kept"] == library.encode_ordinary(t or "")
        assert bytes(got[i]["decoded"]) == (t or "").encode()


def test_small_table_evicts_without_harm(texts, library):
    merger = bpe_codec.Merger(bpe_codec.load_ranks(RANKS))
    enc = bpe_codec.SliceEncoder(classes_of_ranks(), merger.merge, slots=16)
    for _ in range(2):
        ids, first = enc.encode(*text_buffers(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [library.encode_ordinary(t) for t in texts]


def test_empty_table(spark):
    df = rows(spark, []).select("doc_id", "text")
    assert bpe_codec.digests(df, RANKS).count() == 0
    assert huffman_ids.digests(df, JSON).count() == 0
    assert length_histogram.histogram(df, RANKS).count() == 0


def test_huffman_files_round_trip(spark, texts):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(JSON)
    lib.encode_special_tokens = True
    some = [*texts[-40:], None, "same", "same"]
    ids = [3 * i - 20 for i in range(len(some))]
    ids[-1] = ids[-2]
    df = spark.createDataFrame([(d, t, "x") for d, t in zip(ids, some)], "doc_id long, text string, start string").repartition(3)
    got = sorted(huffman_ids.digests(df, JSON).collect(), key=lambda r: r["start"])
    start = 0
    for r, (d, t) in zip(got, zip(ids, some), strict=True):
        want = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d, start, len(want))
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)


def test_huffman_ids_of_added_tokens_equal_the_library(spark):
    from tokenizers import Tokenizer

    lib, end = Tokenizer.from_file(JSON), "<|endoftext|>"
    some = [f"a {end} b", end, end * 3, f" {end}\n\n{end} x", "<|endof", "text|>", "", f"{end[:-1]}{end}é", f"naïve  {end}  {end[1:]}", "plain text", None, end.upper()]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(2)
    got = sorted(huffman_ids.digests(df, JSON).collect(), key=lambda r: r["start"])
    start = 0
    for r, (d, t) in zip(got, enumerate(some), strict=True):
        want = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes())), t
        start += len(want)
    assert lib.encode(some[0], add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 50, 300):
        counts = (rng.pareto(0.3, size) * 10).astype(np.int64) + 1
        n = huffman_ids.code_lengths(counts, 9)
        assert n.max() <= 9 and (size == 1 or abs(sum(2.0 ** -n) - 1) < 1e-12)
        import heapq

        heap = [(int(c), i, (i,)) for i, c in enumerate(counts)]
        plain = np.zeros(size, int)
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            plain[list(x + y)] += 1
            heapq.heappush(heap, (a + b, i, x + y))
        if size > 1 and plain.max() <= 9:
            assert (n * counts).sum() == (plain * counts).sum()
    assert huffman_ids.code_lengths(np.zeros(4, np.int64)).sum() == 0


def test_blocks_decode_by_themselves():
    rng = np.random.default_rng(2)
    blocks = [rng.zipf(1.4, n).clip(0, 999).astype(np.uint32) for n in (1, 255, 256, 257, 5000)]
    counts = np.bincount(np.concatenate(blocks), minlength=1000)
    n = huffman_ids.code_lengths(counts)
    packed = [huffman_ids.pack_bits(b, huffman_ids.canonical(n), n) for b in blocks]
    back = huffman_ids.unpack_bits([p for p, _ in packed], [m for _, m in packed], [len(b) for b in blocks], huffman_ids.decode_table(n))
    assert all((a == b).all() for a, b in zip(back, blocks, strict=True))
    alone = huffman_ids.unpack_bits([packed[3][0]], [packed[3][1]], [257], huffman_ids.decode_table(n))
    assert (alone[0] == blocks[3]).all()


def test_length_histogram_against_brute_force(spark, texts, library):
    some = [*texts[:300], *texts[-9:], None, "same", "same"]
    df = spark.createDataFrame([(t,) for t in some], "text string")
    n = np.array([len(library.encode_ordinary(t or "")) for t in some])
    sums = length_histogram.histogram(df, RANKS).cache()
    got = {r["length"]: r for r in sums.collect()}
    assert set(got) == set(n.tolist())
    for length, r in got.items():
        assert r["n_docs"] == (n == length).sum() and r["docs_at_least"] == (n >= length).sum()
        assert r["tokens_at_least"] == n[n >= length].sum() and r["tokens_cut_here"] == np.minimum(n, length).sum()
        assert r["share_up_to"] == pytest.approx((n <= length).mean())
    for limit in (0, 1, 7, 1500, 10**6):
        assert tuple(length_histogram.at_limit(sums, limit).first()) == (len(n), (n > limit).sum(), np.minimum(n, limit).sum())
    assert length_histogram.quantile(sums, 0.5).first()[0] == np.sort(n)[-(-len(n) // 2) - 1]


def test_new_slices_go_through_the_library_in_one_text():
    """A call's slices are words of one text, told apart by their bytes; other tokenizers get a text for each."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    lib = Tokenizer.from_file(JSON)
    lib.encode_special_tokens = True
    slices = [" über".encode(), b"  ", b"don", b"'t", "日本語".encode(), b"<|endoftext|>", b"\n\n", b" a", b"0" * 40]
    alone = [lib.encode(s.decode(), add_special_tokens=False).ids for s in slices]
    texts = []

    class Counted:
        normalizer, pre_tokenizer = None, pre_tokenizers.ByteLevel(add_prefix_space=False)
        get_vocab = lib.get_vocab

        def encode_batch_fast(self, inputs, **kw):
            texts.append(len(inputs))
            return lib.encode_batch_fast(inputs, **kw)

    ids, count = huffman_ids.slice_merger(Counted())(slices)
    assert texts == [1]
    assert ids.tolist() == [i for a in alone for i in a] and count.tolist() == [len(a) for a in alone]
    assert [len(x) for x in huffman_ids.slice_merger(lib)([])] == [0, 0]

    words = Tokenizer(models.WordLevel({"?": 0, "ab": 1}, unk_token="?"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    ids, count = huffman_ids.slice_merger(words)([b"ab", b" ", b"xyz"])
    assert ids.tolist() == [1, 0] and count.tolist() == [1, 0, 1]


def test_parts_count_their_ids_while_they_are_encoded(spark, texts):
    """op4's CPU budget: ids are not read again for their counts, and take two bytes where all ids fit."""
    some = [*texts[:50], None, "", "<|endoftext|> x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string").repartition(3)
    assert [huffman_ids.id_type(JSON, end) for end in (2, 65535, 65536)] == ["<u2", "<u2", "<u4"]
    for end, kind in ((2, "<u2"), (70_000, "<u4")):
        parts = {}
        for r in huffman_ids.encode_ordered(df, JSON, end).collect():
            parts.setdefault(r["part"], []).append(r)
        assert sum(len(p) - 1 for p in parts.values()) == len(some)
        for rows_ in parts.values():
            ids = [np.frombuffer(r["ids"], kind) for r in rows_[:-1]]
            assert all(r["tally"] is None and r["n"] == len(x) and x[-1] == end for r, x in zip(rows_, ids))
            last, counts = rows_[-1], np.bincount(np.concatenate(ids))
            assert (last["n"], last["doc_id"], last["ids"], last["rel"]) == (None, None, None, counts.sum())
            assert [(t["id"], t["n"]) for t in last["tally"]] == [(i, counts[i]) for i in np.flatnonzero(counts)]
    got = sorted(huffman_ids.digests(df, JSON, 70_000).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == list(range(len(some)))
    want = np.append(huffman_ids._encoder(JSON, classes_of_ranks()).encode(*text_buffers(pa.array([some[0]])))[0], 70_000)
    assert (got[0]["n_tokens"], got[0]["ids_crc32"]) == (len(want), zlib.crc32(want.astype("<u4").tobytes()))
