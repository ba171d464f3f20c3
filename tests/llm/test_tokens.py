import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stormledger.llm import huffman, near_copies, packing, token_files, tokens
from stormledger.llm.tokens import byte_encoder, word_encoder
from tests.llm import cases

ODD = [
    "", " ", "  a  b\n\nc \n d", "it's IT'S don't 'S 'll\n'T", "\t x", "é É ñ ß ẞ İ ﬁ", "12 3a4 5.6", "<|endoftext|> x",
    "x<|startoftext|>y", "!!  ??", "a b", "café", "a\x1cb", "€uro…", "''s", "O’Brien", "_a_b__ 'd've", "Ω漢字かな  ",
]


@pytest.mark.parametrize("encoder", [word_encoder, byte_encoder])
def test_ids_are_those_of_the_tokenizer(encoder):
    random.seed(1)
    alphabet = "aB é'sÑ.!\n  12_-<|\tßÿÀd"
    texts = ODD + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(1500)]
    own = encoder()
    for text in texts:
        assert own.ids(text).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("stormledger.llm.tokens.REMEMBERED", 10)
    own = word_encoder()
    own.memory.clear()
    for text in ("a b c d e f g", "h i j k l m", "a b h", "n"):
        assert own.ids(text).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(own.memory) <= 10


def fewest_bins(lengths, capacity):
    """By trying all; for a handful of lengths."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                bins[k] += lengths[i]
                place(i + 1, bins)
                bins[k] -= lengths[i]
        place(i + 1, bins + [lengths[i]])

    place(0, [])
    return best[0]


def test_bounds_never_exceed_the_fewest_bins():
    random.seed(2)
    for _ in range(200):
        lengths = sorted((random.randint(1, 20) for _ in range(random.randint(1, 7))), reverse=True)
        need = fewest_bins(lengths, 20)
        assert packing.lower_bound(np.array(lengths), 20) <= need <= packing.best_fit(np.array(lengths), 20)[2].size
    assert packing.lower_bound(np.array([11] * 6), 20) == 6 and packing.lower_bound(np.array([7] * 6), 20) == 3


def expected_pieces(encoder, rows, end, capacity):
    out = []
    for r in rows:
        ids = np.array(encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [end], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((r[0], k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(map(str, out))


@pytest.mark.parametrize("per_group", [20, 10_000])
def test_packing_holds_every_piece_without_gaps(spark, tmp_path, per_group):
    docs = cases.docs(spark, tmp_path)
    rows = packing.pack(packing.pieces(docs), per_group=per_group).collect()
    assert sorted(str((r.id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == expected_pieces(word_encoder(), cases.rows(), 1, 4096)
    bins = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 4096
    assert len(bins) <= packing.lower_bound(np.array([r.length for r in rows]), 4096) + 1


@pytest.mark.parametrize("rounds", [1, 2, 64])
def test_packing_of_equal_lengths_loses_no_piece(spark, rounds):
    cut = spark.range(3000).selectExpr("id", "0 as piece", "0L as start", "1300L as length", "id as ids_crc32", "id as ticket")
    rows = packing.pack(cut, per_group=50, rounds=rounds).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    bins = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 4096 and len(bins) <= 1000 + 60
    assert max(r.sequence_id >> 56 for r in rows) < min(rounds, 30)


def test_packing_of_an_empty_table(spark, tmp_path):
    assert packing.best_fit_packing(cases.empty(spark, tmp_path)).count() == 0


def test_codes_are_complete_limited_and_as_short_as_huffmans():
    import heapq

    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 50, 3000):
        counts = np.zeros(65536, np.int64)
        counts[rng.choice(65536, k, replace=False)] = (rng.pareto(0.5, k) + 1).clip(max=1e12).astype(np.int64)
        lengths = huffman.code_lengths(counts)
        used = lengths[lengths > 0].astype(int)
        assert len(used) == k and used.max() <= huffman.LIMIT
        if k > 1:
            assert (2.0**-used).sum() == 1.0
            heap, best = counts[counts > 0].tolist(), 0
            heapq.heapify(heap)
            while len(heap) > 1:
                both = heapq.heappop(heap) + heapq.heappop(heap)
                best += both
                heapq.heappush(heap, both)
            assert best <= int((counts * lengths).sum()) <= best * 1.02
        ids = rng.choice(np.flatnonzero(counts), 999)
        payload, ends = huffman.pack_bits(ids, huffman.canonical_codes(lengths), lengths)
        starts = np.r_[0, ends][:999:7]
        back = huffman.unpack_segments(payload, starts, np.minimum(7, 999 - 7 * np.arange(len(starts))), huffman.decoding_table(lengths))
        assert (back == ids).all()


def test_a_limit_below_huffmans_depth_holds():
    counts = np.zeros(65536, np.int64)
    counts[:40] = 2 ** np.arange(40)
    lengths = huffman.code_lengths(counts)
    used = lengths[:40].astype(int)
    assert used.max() == huffman.LIMIT and (2.0**-used).sum() == 1.0


@pytest.mark.parametrize("file_ids,block_ids", [(8_000_000, 65_536), (3000, 200), (1, 1)])
def test_token_files_give_back_every_id(spark, tmp_path, file_ids, block_ids):
    docs, path = cases.docs(spark, tmp_path), str(tmp_path / f"files{file_ids}")
    token_files.write_token_files(docs, path, file_ids=file_ids, block_ids=block_ids)
    rows = token_files.read_token_files(spark, path, with_ids=True).collect()
    own = byte_encoder()
    want = sorted(str((r[0], own.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in cases.rows())
    assert sorted(str((r.id, list(r.ids))) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    order = [(r.id is not None, r.id or 0) for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)


def test_damaged_block_is_noticed(spark, tmp_path):
    docs, path = cases.docs(spark, tmp_path), str(tmp_path / "files")
    token_files.write_token_files(docs, path)
    data = bytes(spark.read.parquet(f"{path}/blocks").first().data)
    broken = data[:-9] + bytes([data[-9] ^ 1]) + data[-8:]
    with pytest.raises(ValueError):
        list(token_files.decode_blocks([broken], np.zeros(1 << huffman.LIMIT, np.uint32)))


def test_token_files_of_an_empty_table(spark, tmp_path):
    assert token_files.through_files(cases.empty(spark, tmp_path)).count() == 0


def test_only_the_bound_settles_equal_lengths():
    """1,300 of 4,096: three to a bin with room to spare; only the dual-feasible bound shows that no packing has fewer."""
    table = pa.table({"length": pa.array([1300] * 300), "ticket": pa.array(range(300))})
    packed = packing._packed_group(table, 4096, packing.LOOSE)
    assert packed.column("bins")[0].as_py() == packed.column("bound")[0].as_py() == 100
    assert -(-1300 * 300 // 4096) < 100  # the volume alone does not
    assert sum(not x for x in packed.column("settled").to_pylist()) == 3  # the pieces of one bin
    short = pa.table({"length": pa.array([2000, 1500, 1400, 1300, 1200, 600, 500] * 3), "ticket": pa.array(range(21))})
    packed = packing._packed_group(short, 4096, packing.LOOSE)
    if packed.column("bins")[0].as_py() > packed.column("bound")[0].as_py():
        assert sum(not x for x in packed.column("settled").to_pylist()) > 1


def test_certificates_come_with_the_result(spark):
    cut = spark.range(2000).selectExpr("id", "0 as piece", "0L as start", "cast(1 + id * 37 % 3000 as long) as length", "0L as ids_crc32", "id as ticket")
    rows = packing.pack(cut, per_group=300).collect()
    assert len(rows) == 2000 and all(r.bound <= r.bins for r in rows)
    assert any(r.bound == r.bins for r in rows)


def test_a_worker_remembers_one_operator_at_a_time():
    """Workers live on from stage to stage of the pipeline, so memories would add up."""
    words, plain = word_encoder(), byte_encoder()
    first = words.ids("some words here").tolist()
    assert words.memory
    other = plain.ids("other words").tolist()
    assert plain.memory and not words.memory
    assert words.ids("some words here").tolist() == first and not plain.memory
    assert plain.ids("other words").tolist() == other


def test_near_copies_empty_the_memory_of_pieces():
    class Table:
        def mapInArrow(self, run, schema):
            return list(run(iter([pa.RecordBatch.from_pydict({"node": [1], "text": ["a b c"]})])))

    word_encoder().ids("some words here")
    assert word_encoder().memory and near_copies._sets(Table(), 2)
    assert not word_encoder().memory


@pytest.mark.parametrize("encoder", [word_encoder, byte_encoder])
def test_pieces_are_encoded_by_the_model_alone(encoder):
    """A piece needs no more cutting, so no whole call of the tokenizer is made for it; every byte that a piece may hold is read."""
    own = encoder()
    letters = "".join(map(chr, range(33, 127))) + "ÀÖØöøÿßÑé"
    texts = [f"{a}{b} {b}{a}\n{a}" for a in letters for b in "aé'!7"] + ["plain words, and 12 more."]
    texts = [t for t in texts if own.pieces(t) is not None]
    expected = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    own.memory.clear()
    whole, own.tokenizer = own.tokenizer, None
    try:
        assert len(texts) > 500 and [x.tolist() for x in own.stream(texts)] == expected
    finally:
        own.tokenizer = whole


def test_pieces_of_many_texts_are_cut_as_one_text_alone():
    draw = random.Random(11)
    texts = ["".join(draw.choice("ab slrtvmdeD''' \n\n  9 0.,!éÿÖ") for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    texts += ["", "'", "'s", "it's 's 'sx \n's 9's !'s", "we'll 'llama", "a \n", " \n a", "''re", "x" * 70]
    raw = tokens.END.join([*[t.encode("latin-1") for t in texts], b""])
    starts = [*tokens.byte_starts(raw).tolist(), len(raw)]
    want = [p.encode("latin-1") for t in texts for p in [*tokens.BYTE.findall(t), tokens.END.decode()]]
    assert [raw[a:b] for a, b in zip(starts, starts[1:])] == want


def test_a_piece_that_many_texts_share_is_looked_up_once(monkeypatch):
    asked, encoder = [], byte_encoder()
    ids = encoder.memory.__missing__

    class Asked(dict):
        def __missing__(self, piece):
            asked.append(piece)
            return ids(piece)

    monkeypatch.setattr(encoder, "memory", Asked())
    texts = ["one two one two one", None, "two one", "one two"] * 20
    own = [x.tolist() for x in encoder.stream([*texts, "日本 it's"])]
    assert own == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in [*texts, "日本 it's"]]
    assert sorted(asked) == [b" one", b" two", b"one", b"two"]
